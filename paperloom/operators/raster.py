"""Quality measures over grey rasters.

``rasters(image_id, width, height, pixels)`` holds one image or crop per row, pixels row by row.
A row holds all that its measures need, so nothing here explodes pixels or shuffles them.  Full
passes over the pixels are vectorised kernels on Arrow batches (see ``functions.pixels``); boxes,
flags and verdicts are column expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom import constants as K
from paperloom.functions.pixels import dark_ratios, laplacian_variance, measure, page_measures, trim_passes, trimmer
from paperloom.functions.text import literal_array, present
from paperloom.operators.templates import clamped_box, region_rules

EDGES = ("left", "right", "top", "bottom")
MARK_KINDS = ("quality", "checkbox")


def blur(rasters: DataFrame, threshold: float = K.BLUR_THRESHOLD) -> DataFrame:
    """Variance of the four-neighbour Laplacian with wrap-around."""
    return rasters.select("image_id", laplacian_variance("pixels", "width", "height").alias("blur_score")).withColumn(
        "blurry", F.col("blur_score") < threshold
    )


def marks(rasters: DataFrame, kinds: tuple[str, ...] = MARK_KINDS) -> DataFrame:
    """One row per image and mark region: share of dark pixels and whether it reaches the minimum.

    ``rasters`` also carries ``template_id``.
    """
    keys = [c for c in rasters.columns if c not in ("width", "height", "pixels")]

    found = _mark_array(rasters, kinds)
    # the outer form: an inner explode makes Spark test the array first, that is measure twice
    rows = found.select(*keys, F.posexplode_outer("found").alias("ordinal", "mark")).filter("mark IS NOT NULL")
    return rows.select(*keys, "ordinal", "mark.*")


def checkboxes(mark_rows: DataFrame, keys: tuple[str, ...] = ("image_id",)) -> DataFrame:
    """Number of marked boxes per checkbox field and whether all of them are marked."""
    return mark_rows.filter("kind = 'checkbox'").groupBy(*keys, F.col("name").alias("field_name")).agg(
        F.count_if("marked").alias("checked_count"), F.every("marked").alias("all_checked")
    )


def document_checks(rasters: DataFrame) -> DataFrame:
    """Add the mark flags of a page to its row, without a shuffle.

    A template has at most one mark of each name; its checkbox field is true when every box is.
    Rows without a raster or a template keep null flags.
    """
    keys = [c for c in rasters.columns if c not in ("width", "height", "pixels")]
    return _mark_array(rasters, keep=("width", "height")).select(*keys, "width", "height", *_mark_flags(F.col("found")))


def page_checks(rasters: DataFrame) -> DataFrame:
    """``image_id, width, height, blur_score`` and ``found``, the marks of every template's regions.

    One pass over the pixels where they lie: the template of a page is known only after its text is,
    so the marks of all templates, some sixteen boxes, go to the join in place of the pixels.
    """
    rules = F.expr("array(" + ", ".join(
        f"named_struct('template_id', '{t}', 'kind', '{kind}', 'name', '{name}', 'left', {left}D, 'top', {top}D, 'right', {right}D, 'bottom', {bottom}D, 'min_dark_ratio', {least}D)"
        for t, kind, name, left, top, right, bottom, least in K.TEMPLATE_REGIONS if kind in MARK_KINDS
    ) + ")")
    measured = rasters.withColumn("m", page_measures("pixels", "width", "height", _boxes(rules)))
    found = F.zip_with(rules, F.col("m.ratios"), lambda rule, ratio: F.struct(
        rule["template_id"].alias("template_id"), rule["kind"].alias("kind"), rule["name"].alias("name"), (ratio >= rule["min_dark_ratio"]).alias("marked")
    ))
    return measured.select("image_id", "width", "height", F.col("m.blur_score").alias("blur_score"), F.when(F.col("m.ratios").isNotNull(), found).alias("found"))


def with_page_checks(papers: DataFrame) -> DataFrame:
    """Mark flags of papers that carry ``template_id`` and the ``found`` of ``page_checks``."""
    own = F.filter("found", lambda m: m["template_id"] == F.col("template_id"))
    return papers.select(*[c for c in papers.columns if c != "found"], *_mark_flags(own))


def _mark_flags(found: Column) -> list[Column]:
    marked = lambda name: F.filter(found, lambda m: m["name"] == name)
    boxes = F.filter(found, lambda m: m["kind"] == "checkbox")
    return [
        F.get(marked("seal_present"), F.lit(0))["marked"].alias("seal_present"),
        F.get(marked("signature_present"), F.lit(0))["marked"].alias("signature_present"),
        F.when(F.size(boxes) > 0, F.forall(boxes, lambda m: m["marked"])).alias("all_no_boxes_checked"),
        F.when(F.size(boxes) > 0, F.size(F.filter(boxes, lambda m: m["marked"]))).alias("checked_no_box_count"),
    ]


def _boxes(rules: Column) -> Column:
    """The corners of all boxes one after another, for the kernel."""
    corners = ("left", "top", "right", "bottom")

    def of(rule: Column) -> Column:
        box = clamped_box(F.col("width"), F.col("height"), rule)
        return F.array(*[box[c] for c in corners])

    return F.flatten(F.transform(rules, of))


def _mark_array(
    rasters: DataFrame, kinds: tuple[str, ...] = MARK_KINDS, keep: tuple[str, ...] = ()
) -> DataFrame:
    keys = [c for c in rasters.columns if c not in ("width", "height", "pixels")]
    rules = F.when(F.col("pixels").isNotNull(), region_rules(F.col("template_id"), kinds))
    measured = rasters.withColumn("rules", rules).withColumn("ratios", dark_ratios("pixels", "width", "height", _boxes(F.col("rules"))))
    found = F.zip_with("rules", "ratios", lambda rule, ratio: F.struct(
        rule["kind"].alias("kind"), rule["name"].alias("name"), ratio.alias("dark_ratio"), (ratio >= rule["min_dark_ratio"]).alias("marked"),
    ))
    return measured.select(*keys, *keep, found.alias("found"))


def _foreground_ratio(m: Column) -> Column:
    area = (m["right"] - m["left"] + 1) * (m["bottom"] - m["top"] + 1)
    return F.coalesce(area / F.greatest(F.lit(1), m["width"] * m["height"]), F.lit(0.0))


def _flags(
    m: Column, min_width: int = K.MIN_WIDTH, min_height: int = K.MIN_HEIGHT, min_dark: float = K.MIN_DARK_RATIO,
    min_contrast: float = K.MIN_CONTRAST, max_foreground: float = K.MAX_FOREGROUND_RATIO,
    dense: float = K.DENSE_EDGE_RATIO,
) -> Column:
    edges = F.lit(0)
    for edge in EDGES:
        edges = edges + (m[f"edge_{edge}"] >= dense).cast("int")
    return present(
        (m["width"] < min_width, "too_narrow"),
        (m["height"] < min_height, "too_short"),
        (m["dark_ratio"] < min_dark, "low_dark_ratio"),
        (m["contrast"] < min_contrast, "low_contrast"),
        ((_foreground_ratio(m) > max_foreground) & (m["dark_ratio"] >= K.FILLED_DARK_RATIO), "foreground_fills_crop"),
        (edges >= K.DENSE_EDGE_COUNT, "dense_edge_content"),
    )


def _quality(m: Column, flags: Column) -> Column:
    """The quality record of a manifest row, rounded as written."""
    box = F.struct(*[m[e].cast("int").alias(e) for e in ("left", "top", "right", "bottom")])
    return F.struct(
        m["width"].cast("int").alias("width"), m["height"].cast("int").alias("height"),
        F.round(m["width"] / F.greatest(F.lit(1), m["height"]), 4).alias("aspect_ratio"),
        F.round(m["dark_ratio"], 6).alias("dark_ratio"), F.round(m["contrast"], 4).alias("contrast"),
        F.round(_foreground_ratio(m), 6).alias("foreground_bbox_ratio"),
        F.when(m["left"].isNotNull(), box).alias("foreground_bbox"),
        present(
            (m["left"] == 0, "left"), (m["right"] == m["width"] - 1, "right"),
            (m["top"] == 0, "top"), (m["bottom"] == m["height"] - 1, "bottom"),
        ).alias("touched_edges"),
        F.map_from_arrays(
            F.array(*[F.lit(e) for e in EDGES]), F.array(*[F.round(m[f"edge_{e}"], 6) for e in EDGES])
        ).alias("edge_dark_ratios"),
        flags.alias("quality_flags"), (F.size(flags) == 0).alias("accepted"),
    )


def crop_quality(rasters: DataFrame, **thresholds: float) -> DataFrame:
    """Add the ``quality`` record of each crop: measures, flags and verdict."""
    keys = [c for c in rasters.columns if c != "pixels"]
    measured = rasters.select(*keys, measure("pixels", "width", "height").alias("m"))
    flagged = measured.withColumn("flags", _flags(F.col("m"), **thresholds))
    return flagged.select(*keys, _quality(F.col("m"), F.col("flags")).alias("quality"))


def flags(metrics: DataFrame, **thresholds: float) -> DataFrame:
    """Flags and verdict from already measured columns (``crop_quality`` in flat form)."""
    m = F.struct(*[c for c in metrics.columns])
    return metrics.withColumn("quality_flags", _flags(m, **thresholds)).withColumn(
        "accepted", F.size("quality_flags") == 0
    )


def edge_trim(rasters: DataFrame, dense: float = K.DENSE_EDGE_RATIO, share: float = K.MAX_TRIM_RATIO) -> DataFrame:
    """Rows and columns to cut from each side."""
    keys = [c for c in rasters.columns if c != "pixels"]
    trimmed = rasters.select(*keys, trimmer(dense, share)("pixels", "width", "height").alias("trim"))
    return trimmed.select(*keys, *[F.col(f"trim.{e}").alias(f"trim_{e}") for e in EDGES])


def salvage(
    rasters: DataFrame, passes: int = K.TRIM_PASSES, share: float = K.MAX_TRIM_RATIO, **thresholds: float
) -> DataFrame:
    """Measure each crop and try to save the dense or filled ones by trimming dense edges.

    Only crops with such a flag send their pixels to the trimming kernel; the first pass whose
    measures pass every threshold wins.  Output adds ``quality`` (of the saved crop when it was
    saved) and ``salvaged``.
    """
    least = thresholds.get("min_width", K.MIN_WIDTH), thresholds.get("min_height", K.MIN_HEIGHT)
    follow = trim_passes(thresholds.get("dense", K.DENSE_EDGE_RATIO), share, *least, passes)
    keys = [c for c in rasters.columns if c not in ("pixels", "width", "height")]
    first = rasters.select("*", measure("pixels", "width", "height").alias("m")).withColumn("flags", _flags(F.col("m"), **thresholds))
    doubtful = F.arrays_overlap("flags", literal_array(["foreground_fills_crop", "dense_edge_content"]))
    tried = first.withColumn("steps", follow(F.when(doubtful, F.col("pixels")), "width", "height")).select(
        *keys, "m", "flags", F.transform("steps", lambda s: s.withField("flags", _flags(s["m"], **thresholds))).alias("steps")
    )
    saved = tried.withColumn("saved", F.get(F.filter("steps", lambda s: F.size(s["flags"]) == 0), F.lit(0)))
    done = F.col("saved").isNotNull()
    final = saved.select(
        *keys, done.alias("salvaged"), F.col("flags").alias("flags_before"), F.col("saved.cut").alias("cut"),
        F.coalesce("saved.m", "m").alias("m"), F.coalesce("saved.flags", "flags").alias("flags"),
    )
    quality = _quality(F.col("m"), F.col("flags"))
    extra = {
        "salvage_applied": F.lit(True), "original_quality_flags": F.col("flags_before"),
        "salvage_strategy": F.lit("trim_dense_edges"), "trim_pixels": F.col("cut"),
    }
    for name, value in extra.items():
        quality = quality.withField(name, F.when(F.col("salvaged"), value))
    return final.select(*keys, "salvaged", quality.alias("quality"))


def confidence_sums() -> tuple[Column, Column]:
    """Aggregates over pages: sum and number of the known word confidences.

    Words are summed inside their page first, so two numbers per page are shuffled, not the words.
    """
    known = F.filter(F.transform("words", lambda w: w["confidence"]), lambda c: c.isNotNull())
    total = F.aggregate(known, F.lit(0.0), lambda s, c: s + c)
    return F.sum(total).alias("confidence_total"), F.sum(F.size(known)).alias("confidence_words")


def with_confidence(summed: DataFrame, threshold: float = K.CONFIDENCE_THRESHOLD) -> DataFrame:
    average = F.when(F.col("confidence_words") > 0, F.col("confidence_total") / F.col("confidence_words"))
    return summed.withColumn("average_ocr_confidence", average).withColumn(
        "low_ocr_confidence", F.col("average_ocr_confidence") < threshold
    ).drop("confidence_total", "confidence_words")


def avg_confidence(
    pages: DataFrame, keys: list[str], threshold: float = K.CONFIDENCE_THRESHOLD, order: str | None = None
) -> DataFrame:
    """Mean word confidence of a document over all its pages; null when no word has one.

    Sums of doubles depend on the order of the words in their last bits, which decide ties of the threshold.
    With ``order``, a column that numbers the pages, words are added one after another, page by page,
    whatever the partitions are; a document's confidences then meet in one row.
    """
    if order is None:
        return with_confidence(pages.groupBy(*keys).agg(*confidence_sums()), threshold)
    known = F.filter(F.transform("words", lambda w: w["confidence"]), lambda c: c.isNotNull())
    listed = pages.select(*keys, F.struct(F.col(order).alias("order"), known.alias("known")).alias("page"))
    ordered = listed.groupBy(*keys).agg(F.array_sort(F.collect_list("page")).alias("pages"))
    inside = lambda total, page: F.aggregate(F.coalesce(page["known"], F.array().cast("array<double>")), total, lambda s, c: s + c)
    sizes = lambda n, page: n + F.coalesce(F.size(page["known"]), F.lit(0))
    return with_confidence(ordered.select(
        *keys, F.aggregate("pages", F.lit(0.0), inside).alias("confidence_total"), F.aggregate("pages", F.lit(0), sizes).alias("confidence_words")
    ), threshold)
