"""Training-set curation: crops, hard cases, caps, profiles and synthetic rows."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paperloom import constants as K
from paperloom.functions.predicates import field_group, is_accepted
from paperloom.functions.text import literal_array, nonempty, present, stable_number
from paperloom.operators.templates import pixel_box, region_rules, template_of
from paperloom.session import broadcast_if_small, cut_lineage, with_index

HARD, BASE = "hard_case", "base"
#: Crops of a bucket in which a selection ranks rows, as a power of two.
CHUNK_BITS = 12
READABLE_TEMPLATES = tuple(dict.fromkeys(r[0] for r in K.TEMPLATE_REGIONS if r[1] == "ocr"))


# --- eligibility and crop manifest -------------------------------------------

def eligibility(labels: DataFrame, files: DataFrame) -> DataFrame:
    """Add ``skip_reason`` (null when usable), ``template_id`` and the image size.

    ``files``: one row per known file with ``path``, ``width``, ``height``; a file without a size
    could not be read.  The reasons are tested in a fixed order and the first one holds.
    """
    known = files.select(
        F.col("path").alias("source_path"), F.col("width"), F.col("height"), F.lit(True).alias("exists")
    )
    joined = labels.join(known, "source_path", "left").withColumn(
        "template_id", template_of(F.col("document_type"), F.col("source_path"), F.lit(None).cast("string"))
    )
    source, template = F.col("source_path"), F.col("template_id")
    no_fields = F.coalesce(F.size("expected_fields"), F.lit(0)) <= 0
    reason = (
        F.when(source.isNull() | (source == ""), "missing_source_path")
        .when(source.contains("://"), "non_file_source")
        .when(F.col("exists").isNull(), "source_missing")
        .when(~F.coalesce(F.col("document_type").isin(*K.DOCUMENT_TYPES), F.lit(False)), "document_type_invalid")
        .when(no_fields, "missing_expected_fields")
        .when(~F.coalesce(template.isin(*READABLE_TEMPLATES), F.lit(False)), "template_without_regions")
        .when(F.col("width").isNull(), "source_unreadable")
    )
    return joined.withColumn("skip_reason", reason).drop("exists")


def skip_counts(rows: DataFrame) -> DataFrame:
    return rows.filter("skip_reason IS NOT NULL").groupBy("skip_reason").agg(F.count(F.lit(1)).alias("rows"))


def crop_candidates(eligible: DataFrame, output_root: str = "field_crops") -> DataFrame:
    """One row per region of the template that has a non-empty expected field, with its pixel box.

    ``eligible`` carries ``split`` already (a broadcast of the few moved sources, see splits).
    ``box`` is null where the region is empty at this image size.
    """
    usable = eligible.filter("skip_reason IS NULL")
    region = F.col("region")
    rows = usable.select(
        "case_id", "document_type", "template_id", "split", "source_path", "label_path", "width", "height", "expected_fields",
        F.explode(region_rules(F.col("template_id"), ("ocr",))).alias("region"),
    ).withColumn("text", nonempty(F.try_element_at("expected_fields", region["name"]))).filter("text IS NOT NULL")
    box = pixel_box(F.col("width"), F.col("height"), region)
    rows = rows.select(
        "case_id", "document_type", "template_id", region["name"].alias("field_name"),
        field_group(region["name"]).alias("field_group"), "text", "split", "source_path", "label_path", box.alias("box"),
    )
    suffix = F.lower(F.regexp_extract("source_path", r"[^/.](\.[^./]+)$", 1))
    path = F.concat_ws(
        "/", F.lit(output_root), "split", "field_group", "field_name",
        F.concat("case_id", F.lit("__"), "field_name", F.coalesce(nonempty(suffix), F.lit(".png"))),
    )
    valid = (F.col("box.left") < F.col("box.right")) & (F.col("box.top") < F.col("box.bottom"))
    return rows.withColumn("crop_path", path).withColumn("box", F.when(valid, F.col("box")))


def crop_manifest(eligible: DataFrame, output_root: str = "field_crops") -> DataFrame:
    return crop_candidates(eligible, output_root).filter("box IS NOT NULL")


def invalid_boxes(eligible: DataFrame) -> DataFrame:
    """Skip count of regions that vanish at the image size."""
    empty = crop_candidates(eligible).filter("box IS NULL")
    return empty.groupBy(F.lit("invalid_region_box").alias("skip_reason")).agg(F.count(F.lit(1)).alias("rows"))


def crop_summary(manifest: DataFrame) -> DataFrame:
    """Counts of a manifest as (section, key, rows), in one scan.

    Every row names the counters it belongs to; the counters are few, so partial aggregation
    leaves almost nothing to shuffle.
    """
    ok = is_accepted(F.col("quality.accepted"))
    entry = lambda section, key: F.struct(F.lit(section).alias("section"), key.alias("key"))
    flags = F.transform(
        F.when(~ok, F.col("quality.quality_flags")), lambda f: F.struct(F.lit("quality_flag").alias("section"), f.alias("key"))
    )
    empty = F.array().cast("array<struct<section:string,key:string>>")
    entries = F.concat(
        F.array(
            entry("total", F.lit("crops")),
            entry("verdict", F.when(ok, "accepted").otherwise("rejected")),
            entry("field_group", F.col("field_group")), entry("split", F.col("split")),
            entry("document_type", F.col("document_type")),
        ),
        F.coalesce(flags, empty),
        F.when(F.coalesce("quality.salvage_applied", F.lit(False)), F.array(entry("salvage", F.lit("salvaged")))).otherwise(empty),
    )
    counted = manifest.select(F.explode(entries).alias("e")).groupBy("e.section", "e.key").agg(F.count(F.lit(1)).alias("rows"))
    sources = manifest.agg(F.count_distinct("source_path").alias("rows")).select(
        F.lit("total").alias("section"), F.lit("unique_sources").alias("key"), "rows"
    )
    return counted.unionByName(sources)


# --- hard cases ----------------------------------------------------------------

def variants_of(group: Column) -> Column:
    chosen = literal_array(K.DEFAULT_VARIANTS)
    for name, variants in K.VARIANTS.items():
        chosen = F.when(group == name, literal_array(variants)).otherwise(chosen)
    return chosen


def hard_case_plan(manifest: DataFrame, output_root: str = "hard_cases") -> DataFrame:
    """One row per train crop and variant of its field group; a plain fan-out, no join."""
    kept = [c for c in manifest.columns if c not in ("crop_path", "augmentation_type", "base_crop_path")]
    name = F.regexp_extract("crop_path", r"([^/]+)$", 1)
    stem, suffix = F.regexp_extract(name, r"^(.+?)(?:\.[^.]*)?$", 1), F.regexp_extract(name, r"^.+(\.[^.]+)$", 1)
    fanned = manifest.filter(F.col("split") == K.TRAIN).select(
        *kept, "crop_path", F.explode(variants_of(F.col("field_group"))).alias("augmentation_type")
    )
    path = F.concat_ws(
        "/", F.lit(output_root), "field_group", "augmentation_type", F.concat(stem, F.lit("__"), "augmentation_type", suffix)
    )
    return fanned.select(*kept, "augmentation_type", F.col("crop_path").alias("base_crop_path"), path.alias("crop_path"))


DONOR_POOLS = {"overlay_patch": (K.DEFAULT_GROUP,), "edge_overlap": (K.DEFAULT_GROUP, K.ENGLISH_GROUP)}


def assign_donors(plan: DataFrame, manifest: DataFrame, seed: int = K.HARD_CASE_SEED) -> DataFrame:
    """Add ``donor_crop_path`` to the variants that paste another crop.

    A pool is the concatenation of whole field groups, its own group last.  The draw is a number
    derived from the row, so it needs the pool size (a handful of counts) and then one equi-join on
    (group, position), whose keys are spread evenly by the draw.
    """
    donors = manifest.filter(F.col("split") == K.TRAIN).select(
        F.col("field_group").alias("donor_group"), F.col("crop_path").alias("donor_crop_path")
    )
    numbered = with_index(donors, ["donor_group"], ["donor_crop_path"], "donor_index")
    sizes = broadcast_if_small(numbered.groupBy("donor_group").agg(F.count(F.lit(1)).alias("donors")))
    pools = F.when(F.lit(False), literal_array([]))
    for variant, groups in DONOR_POOLS.items():
        pools = F.when(F.col("augmentation_type") == variant, F.array(*[F.lit(g) for g in groups], F.col("field_group"))).otherwise(pools)
    # rows of variants without a donor join nothing, so only the others are shuffled
    pastes = F.coalesce(F.col("augmentation_type").isin(*DONOR_POOLS), F.lit(False))
    drawn = plan.filter(pastes).withColumn("pool", pools)
    for i in range(3):
        slot = sizes.select(F.col("donor_group").alias(f"group_{i}"), F.col("donors").alias(f"size_{i}"))
        drawn = drawn.withColumn(f"group_{i}", F.get("pool", F.lit(i))).join(slot, f"group_{i}", "left").withColumn(
            f"size_{i}", F.coalesce(f"size_{i}", F.lit(0))
        )
    total = F.col("size_0") + F.col("size_1") + F.col("size_2")
    draw = F.when(total > 0, F.pmod(stable_number(seed, F.col("base_crop_path"), F.col("augmentation_type")), total))
    drawn = drawn.withColumn("draw", draw)
    first, second = F.col("size_0"), F.col("size_0") + F.col("size_1")
    placed = drawn.withColumns({
        "donor_group": F.when(F.col("draw") < first, F.col("group_0")).when(F.col("draw") < second, F.col("group_1")).when(
            F.col("draw") < total, F.col("group_2")
        ),
        "donor_index": F.when(F.col("draw") < first, F.col("draw")).when(F.col("draw") < second, F.col("draw") - first).when(
            F.col("draw") < total, F.col("draw") - second
        ),
    })
    # rows without a draw join nothing; their numbers are spread so that no task gets them all
    none = -1 - F.pmod(F.xxhash64("base_crop_path", "augmentation_type"), F.lit(1 << 40))
    placed = placed.withColumn("donor_index", F.coalesce(F.col("donor_index").cast("bigint"), none))
    given = placed.join(numbered, ["donor_group", "donor_index"], "left").select(*plan.columns, "donor_group", "donor_crop_path")
    return given.unionByName(plan.filter(~pastes), allowMissingColumns=True)


def _current_bases(manifest: DataFrame, include_rejected: bool) -> DataFrame:
    rows = manifest.filter(F.col("split") == K.TRAIN)
    if not include_rejected:
        rows = rows.filter(is_accepted(F.col("quality.accepted")))
    return rows.select(F.col("crop_path").alias("base_crop_path"))


def current_hard_cases(manifest: DataFrame, hard: DataFrame, include_rejected: bool = False) -> DataFrame:
    """Hard cases whose base crop is still an accepted train crop."""
    return hard.join(_current_bases(manifest, include_rejected), "base_crop_path", "left_semi")


def stale_hard_cases(manifest: DataFrame, hard: DataFrame, include_rejected: bool = False) -> DataFrame:
    """Dropped hard cases per field group."""
    stale = hard.join(_current_bases(manifest, include_rejected), "base_crop_path", "left_anti")
    return stale.groupBy(F.coalesce(nonempty(F.col("field_group")), F.lit(K.UNKNOWN)).alias("field_group")).agg(
        F.count(F.lit(1)).alias("stale")
    )


def hard_case_status(manifest: DataFrame, hard: DataFrame | None, include_rejected: bool = False) -> DataFrame:
    """generated, refreshed or current, with the stale count and the size the manifest will have."""
    look = None if hard is None else (F.lit(True), include_rejected)
    return hard_case_statuses(manifest, hard, {"": look}).drop("given")


def hard_case_statuses(manifest: DataFrame, hard: DataFrame | None, looks: dict[str, tuple[Column, bool] | None]) -> DataFrame:
    """``hard_case_status`` of several looks at the hard cases, named in ``given``, in one pass over both tables.

    A look is a condition on the hard cases and ``include_rejected``, or None where there are none yet.
    Both tables meet once by base crop; only sums are kept of a crop.
    """
    chosen = {f"__rows_{i}": look for i, look in enumerate(looks.values()) if look}
    train = manifest.filter(F.col("split") == K.TRAIN)
    facts = train.select(
        F.col("crop_path").alias("__key"), F.size(variants_of(F.col("field_group"))).cast("bigint").alias("planned"),
        F.col("crop_path").isNotNull().alias("__any"), (F.col("crop_path").isNotNull() & F.coalesce(is_accepted(F.col("quality.accepted")), F.lit(False))).alias("__accepted"),
    )
    if chosen:
        rows = hard.select(F.col("base_crop_path").alias("__key"), *[F.when(look[0], 1).otherwise(0).cast("bigint").alias(n) for n, look in chosen.items()])
        facts = facts.unionByName(rows, allowMissingColumns=True).groupBy("__key").agg(
            F.sum("planned").alias("planned"), *[F.coalesce(F.bool_or(c), F.lit(False)).alias(c) for c in ("__any", "__accepted")],
            *[F.sum(n).alias(n) for n in chosen])
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint")
    summed = facts.agg(
        total("planned").alias("planned"), *[total(n).alias(n) for n in chosen],
        *[total(F.when(~F.col("__any" if look[1] else "__accepted"), F.col(n))).alias(f"{n}_stale") for n, look in chosen.items()])
    told = []
    for i, (name, look) in enumerate(looks.items()):
        if look is None:
            told.append(F.struct(F.lit(name).alias("given"), F.lit("generated").alias("status"), F.lit(0).cast("bigint").alias("stale_entry_count"), F.col("planned").alias("total_augmented_crops")))
            continue
        stale = F.col(f"__rows_{i}_stale")
        told.append(F.struct(
            F.lit(name).alias("given"), F.when(stale > 0, "refreshed").otherwise("current").alias("status"), stale.alias("stale_entry_count"),
            F.when(stale > 0, F.col("planned")).otherwise(F.col(f"__rows_{i}")).alias("total_augmented_crops")))
    return summed.select(F.explode(F.array(*told)).alias("s")).select("s.*")


# --- caps, quotas, selection -----------------------------------------------------

def with_source_type(df: DataFrame) -> DataFrame:
    return df.withColumn(
        "source_type", F.when(F.coalesce("augmentation_type", F.lit("")) != "", HARD).otherwise(BASE)
    )


def hard_case_cap(train: DataFrame, ratio: float | None = 0.5) -> DataFrame:
    """Allowed number of hard cases per field group of a train set (with ``source_type``)."""
    if ratio is not None and ratio < 0:
        raise ValueError("the hard case ratio must not be negative")
    return _caps_from(profile_counts(train), ratio)


def _caps_from(counts: DataFrame, ratio: float | None) -> DataFrame:
    is_hard = F.col("source_type") == HARD
    rows = lambda test: F.coalesce(F.sum(F.when(test, F.col("rows"))), F.lit(0)).cast("bigint")
    counted = counts.groupBy("field_group").agg(
        rows(~is_hard).alias("base_count"), rows(is_hard).alias("hard_count"),
        F.count_distinct(F.when(is_hard, F.col("augmentation_type"))).alias("variant_count"),
    )
    if ratio is None or ratio >= 1.0:
        allowed, floor = F.col("hard_count"), F.lit(0)
        plain = counted.withColumn("plain", allowed)
    else:
        plain = counted.withColumn(
            "plain", F.floor(F.col("base_count") * F.lit(float(ratio)) / F.lit(1.0 - ratio)).cast("bigint")
        )
        floor = F.least(F.lit(3), F.col("variant_count"), F.col("hard_count"))
    floored = (F.col("base_count") == 1) & (F.col("plain") > 0) & (floor > F.col("plain")) & (F.col("hard_count") > 0)
    allowed = F.when(floored, floor).otherwise(F.col("plain"))
    return plain.select(
        "field_group", "base_count", "hard_count", "variant_count", allowed.cast("bigint").alias("allowed"),
        floored.alias("floor_applied"), F.when(floored, K.FLOOR_STRATEGY).otherwise(K.BALANCED_STRATEGY).alias("strategy"),
        (F.col("hard_count") > allowed).alias("capped"),
    )


def quotas(train: DataFrame, caps: DataFrame) -> DataFrame:
    """Share of the allowance per document type: largest remainder, limited by what is available.

    Each type starts with the whole part of its proportional share.  Spare seats are dealt in rounds
    over the types that still have rows, in a fixed order of remainder, so the number of full rounds
    and the last partial round have closed forms: no row per seat.  All windows run over one row per
    (field group, document type).
    """
    return _quotas_from(profile_counts(train), caps)


def _quotas_from(counts: DataFrame, caps: DataFrame) -> DataFrame:
    is_hard = F.col("source_type") == HARD
    rows = lambda test: F.coalesce(F.sum(F.when(test, F.col("rows"))), F.lit(0)).cast("bigint")
    sides = counts.groupBy("field_group", "document_type").agg(
        rows(~is_hard).alias("base"), rows(is_hard).alias("available")
    ).join(
        caps.filter("capped AND allowed > 0").select(F.col("field_group").alias("__g"), "allowed", "base_count"), F.col("field_group").eqNullSafe(F.col("__g"))
    ).drop("__g")
    group = Window.partitionBy("field_group")
    ideal = F.col("allowed").cast("double") * F.col("base") / F.col("base_count")
    started = sides.withColumn("ideal", ideal).withColumn(
        "start", F.least(F.col("available"), F.floor("ideal").cast("bigint"))
    ).withColumns({"room": F.col("available") - F.col("start"), "remainder": F.col("ideal") - F.col("start")})
    spare = started.withColumn("spare", F.col("allowed") - F.sum("start").over(group))
    by_room = group.orderBy("room", "document_type")
    open_ = spare.filter("room > 0").withColumns({
        "smaller": F.coalesce(F.sum("room").over(by_room.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        "sharing": F.count(F.lit(1)).over(by_room.rowsBetween(Window.currentRow, Window.unboundedFollowing)),
    }).withColumn("rounds", F.max(F.floor((F.col("spare") - F.col("smaller")) / F.col("sharing"))).over(group))
    dealt = open_.withColumn("whole", F.least("room", F.col("rounds"))).withColumns({
        "left": F.col("spare") - F.sum("whole").over(group), "wants": F.col("room") > F.col("rounds"),
    })
    turn = F.row_number().over(
        Window.partitionBy("field_group", "wants").orderBy(F.desc("remainder"), F.desc("base"), "document_type")
    )
    extra = dealt.withColumn("turn", turn).select(
        "field_group", "document_type",
        (F.col("whole") + F.when(F.col("wants") & (F.col("turn") <= F.col("left")), 1).otherwise(0)).alias("extra"),
    )
    extra = extra.select(F.col("field_group").alias("__g"), F.col("document_type").alias("__d"), "extra")
    return started.join(extra, F.col("field_group").eqNullSafe(F.col("__g")) & (F.col("document_type") == F.col("__d")), "left").select(
        "field_group", "document_type", "base", "available",
        (F.col("start") + F.coalesce("extra", F.lit(0))).cast("bigint").alias("quota"),
    )


def select_hard_cases(hard: DataFrame, quota: DataFrame) -> DataFrame:
    """Fill each (field group, document type) quota by taking the variants in turn.

    A round takes one hard case of every variant that has one left, in the order of their names, until
    the quota is full; so a variant gives the rounds before the last, or all it has, and the last round
    goes to the first names.  Within a variant every base crop gives one hard case before any gives a
    second, and crops begin where the variants before it ended: at level m the i-th crop gives the
    variant m places after its own.  Up to as many seats as crops this picks the least used crop for
    every seat; beyond, a crop may differ from that where crops lack variants.

    Counts of variants decide before rows are placed; counts of places tell which rows a variant gives, and
    only the crops of the ``2 ** CHUNK_BITS`` about the cut are ranked.
    """
    placed = _placed(_numbered(_keyed(hard, F.lit(True)), hard.columns), quota)
    return _first_of_each(placed, SIDE, ["__entry", "__level", "__chunk"], "__crop", "__take").select(*hard.columns)


SIDE = ["__group", "__kind", "__variant"]


def _keyed(hard: DataFrame, open_: Column) -> DataFrame:
    """Hard cases with the key of their base crop and ``__open``: whether a selection may choose among them.

    The key takes the place of ``base_crop_path``: a path is shuffled once.
    """
    named = F.col("base_crop_path")
    spare = F.coalesce(nonempty(F.col("crop_path")), nonempty(F.col("case_id")) if "case_id" in hard.columns else F.lit(None), F.lit(K.UNKNOWN))
    return hard.withColumns({
        "__key": F.coalesce(named, spare), "__named": named.isNotNull(), "__spare": F.when(named == "", spare),
        "__open": F.coalesce(open_, F.lit(False)),
    }).drop("base_crop_path")


def _running():
    """Running count of the true flags of a partition."""
    @F.pandas_udf("bigint")
    def running(flags: Iterator[pd.Series]) -> Iterator[pd.Series]:
        total = 0
        for part in flags:
            counts = part.cumsum() + total
            total = counts.iloc[-1] if len(counts) else total
            yield counts

    return running


def _numbered(keyed: DataFrame, keep: list[str], bases: DataFrame | None = None) -> DataFrame:
    """The rows as a written table, dealt once by ranges of the base crop; all later steps read it without a shuffle.

    A crop's rows lie together: its entries are numbered there (``__entry``), and the open crops of a
    partition are counted in order (``__run``).  ``bases``, crops to be matched, travel in the same shuffle
    and give ``__current``: whether a row's base crop is one of them (a row with null ``__current`` counts
    as current).  Of the rows' columns the table holds ``keep``.
    """
    crop = ["__open", "__group", "__kind", "__key", "__base"]
    entry = Window.partitionBy(*crop, "__variant").orderBy("field_name", "crop_path")
    any_ = Window.partitionBy(*crop).orderBy("__variant", "field_name", "crop_path")
    if bases is None:
        dealt = keyed.repartitionByRange("__key").withColumn("__current", F.lit(True))
    else:
        marks = bases.select(F.col("base_crop_path").alias("__key"), F.lit(True).alias("__mark"))
        both = keyed.unionByName(marks, allowMissingColumns=True).repartitionByRange("__key")
        seen = F.coalesce(F.bool_or("__mark").over(Window.partitionBy("__key")), F.lit(False))
        dealt = both.withColumn("__current", F.coalesce("__current", seen & F.col("__named"))).where("__mark IS NULL").withColumn(
            "__open", F.col("__open") & F.col("__current"))
    sided = dealt.withColumns({
        "__group": F.coalesce("field_group", F.lit(K.UNKNOWN)), "__kind": F.coalesce(nonempty(F.col("document_type")), F.lit(K.UNKNOWN)),
        "__variant": F.coalesce(nonempty(F.col("augmentation_type")), F.lit(K.UNKNOWN)), "__base": F.coalesce("__spare", "__key"),
    })
    rows = sided.withColumns({"__entry": F.row_number().over(entry), "__first": F.row_number().over(any_) == 1})
    counted = rows.withColumn("__run", _running()(F.col("__first"))).withColumn("__part", F.spark_partition_id())
    named = counted.withColumn("base_crop_path", F.when(F.col("__named"), F.col("__key")))
    state = [c for c in ("__usable", "__current", "__open", *SIDE, "__entry", "__run", "__part") if c in named.columns]
    return cut_lineage(named.select(*dict.fromkeys([*[c for c in keep if c in named.columns], *state])))


def _placed(numbered: DataFrame, quota: DataFrame) -> DataFrame:
    """The open rows of the sides with a quota: their crop's number, level and bucket, and the seats of their variant."""
    open_ = numbered.where("__open")
    shares = _variant_shares(open_, quota)
    sides = ["__group", "__kind"]
    runs = open_.groupBy("__part", *sides).agg(F.min("__run").alias("__low"), (F.max("__run") - F.min("__run") + 1).alias("__crops"))
    before = Window.partitionBy(*sides).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = runs.select("__part", *sides, (F.coalesce(F.sum("__crops").over(before), F.lit(0)) - F.col("__low")).alias("__shift"))
    found = open_.join(broadcast_if_small(cut_lineage(shares)), SIDE).join(broadcast_if_small(cut_lineage(shifts), 100_000), ["__part", *sides])
    placed = found.withColumn("__crop", F.col("__run") + F.col("__shift"))
    return placed.withColumns({
        "__level": F.pmod(F.col("__number") - F.col("__crop"), F.col("__variants")), "__chunk": F.shiftright("__crop", CHUNK_BITS),
    })


def _first_of_each(rows: DataFrame, side: list[str], digits: list[str], last: str, take: str) -> DataFrame:
    """The first ``take`` rows of each ``side`` in the order of ``digits`` and ``last``, without sorting a side.

    Counts of the digits tell in which bucket the cut falls: rows of the buckets before it are taken
    whole, and only those of the bucket itself are ranked.  ``rows`` is a written table.
    """
    counts = rows.groupBy(*side, *digits, take).agg(F.count(F.lit(1)).alias("__rows"))
    before = F.coalesce(F.sum("__rows").over(Window.partitionBy(*side).orderBy(*digits).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    cuts = cut_lineage(counts.withColumn("__room", F.col(take) - before).where("__room > 0").select(*side, *digits, "__rows", "__room"))
    found = rows.join(broadcast_if_small(cuts), [*side, *digits])
    bucket = Window.partitionBy(*side, *digits).orderBy(last)
    ranked = found.where("__rows > __room").withColumn("__rank", F.row_number().over(bucket)).where("__rank <= __room").drop("__rank")
    return found.where("__rows <= __room").unionByName(ranked)


def _variant_shares(keyed: DataFrame, quota: DataFrame) -> DataFrame:
    """Seats of each variant, its place among the names and how many there are: windows over counts."""
    wanted = quota.filter("quota > 0").select(
        F.coalesce("field_group", F.lit(K.UNKNOWN)).alias("__group"), F.col("document_type").alias("__kind"), "quota"
    )
    counts = keyed.groupBy("__group", "__kind", "__variant").agg(F.count(F.lit(1)).alias("__rows")).join(wanted, ["__group", "__kind"])
    side = Window.partitionBy("__group", "__kind")
    by_rows = side.orderBy("__rows", "__variant")
    sharing = F.count(F.lit(1)).over(by_rows.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    smaller = F.coalesce(F.sum("__rows").over(by_rows.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # full rounds: the largest r with sum(min(rows, r)) within the quota lies on one of these pieces
    rounds = F.when(F.sum("__rows").over(side) <= F.col("quota"), F.max("__rows").over(side)).otherwise(F.max("__piece").over(side))
    leveled = counts.withColumn("__piece", F.floor((F.col("quota") - smaller) / sharing)).withColumn("__rounds", rounds)
    dealt = leveled.withColumn("__whole", F.least("__rows", "__rounds")).withColumns({
        "__left": F.col("quota") - F.sum("__whole").over(side), "__more": F.col("__rows") > F.col("__rounds"),
    })
    turn = F.row_number().over(Window.partitionBy("__group", "__kind", "__more").orderBy("__variant"))
    return dealt.select(
        "__group", "__kind", "__variant",
        (F.col("__whole") + F.when(F.col("__more") & (turn <= F.col("__left")), 1).otherwise(0)).alias("__take"),
        (F.row_number().over(side.orderBy("__variant")) - 1).alias("__number"), F.count(F.lit(1)).over(side).alias("__variants"),
    )


def training_set(
    manifest: DataFrame, hard: DataFrame | None = None, include_rejected: bool = False, ratio: float | None = 0.5
) -> DataFrame:
    """Crops and current hard cases, without rejected rows, hard cases capped within train."""
    return training_set_and_caps(manifest, hard, include_rejected, ratio)[0]


def training_set_and_caps(
    manifest: DataFrame, hard: DataFrame | None = None, include_rejected: bool = False, ratio: float | None = 0.5
) -> tuple[DataFrame, DataFrame]:
    """The training set and the caps applied to it."""
    rows, _, caps, _ = _training_parts(manifest, hard, include_rejected, ratio)
    return rows, caps


def selected_hard_cases(
    manifest: DataFrame, hard: DataFrame, include_rejected: bool = False, ratio: float = 0.5
) -> DataFrame:
    """The hard cases that a training set keeps of the field groups over their cap (``ratio`` below 1)."""
    return _training_parts(manifest, hard, include_rejected, ratio)[1]


def training_set_and_stale(
    manifest: DataFrame, hard: DataFrame | None = None, include_rejected: bool = False, ratio: float | None = 0.5,
    keep: list[str] | None = None,
) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """The training set, its caps and the dropped hard cases per field group (:func:`stale_hard_cases`).

    ``keep``: the columns of the training set, all by default.
    """
    rows, _, caps, stale = _training_parts(manifest, hard, include_rejected, ratio, keep)
    return rows, caps, stale


def _training_parts(
    manifest: DataFrame, hard: DataFrame | None, include_rejected: bool, ratio: float | None, keep: list[str] | None = None
) -> tuple[DataFrame, DataFrame | None, DataFrame, DataFrame | None]:
    """(training set, hard cases chosen under the caps, caps, stale hard cases per group).

    The hard cases are shuffled and written once, by base crop (:func:`_numbered`): the same table tells
    which are current, and gives counts, stale rows and the selection.  Base rows are read where they lie.
    """
    usable = F.lit(True) if include_rejected else is_accepted(F.col("quality.accepted"))
    columns = list(dict.fromkeys([*manifest.columns, *(hard.columns if hard is not None else [])]))
    extra = [c for c in ("augmentation_type", "base_crop_path") if c not in columns]
    own = manifest.filter(usable)
    for name in ("augmentation_type", "base_crop_path"):
        if name not in own.columns:
            own = own.withColumn(name, F.lit(None).cast("string"))
    own = with_source_type(own)
    names = keep or [*columns, *extra, "source_type"]
    if ratio is None or ratio >= 1.0:
        rows = own if hard is None else own.unionByName(
            with_source_type(current_hard_cases(manifest, hard, include_rejected).filter(usable)), allowMissingColumns=True)
        stale = None if hard is None else stale_hard_cases(manifest, hard, include_rejected)
        return rows.select(*names), None, hard_case_cap(rows.filter(F.col("split") == K.TRAIN), ratio), stale
    # a row without group or split is a row like any other: it falls under the cap of the unknown group, or under none
    train_hard = F.coalesce((F.col("split") == K.TRAIN) & (F.col("source_type") == HARD), F.lit(False))
    # a manifest that names variants holds hard cases itself
    mixed = "augmentation_type" in manifest.columns
    held = own.filter(F.col("source_type") == HARD).withColumns({"__usable": F.lit(True), "__current": F.lit(True)}) if mixed else None
    base = own.filter(F.col("source_type") == BASE) if mixed else own
    given = None if hard is None else with_source_type(hard).withColumns({"__usable": usable, "__current": F.lit(None).cast("boolean")})
    parts = [p for p in (given, held) if p is not None]
    if not parts:
        return own.select(*names), None, hard_case_cap(own.filter(F.col("split") == K.TRAIN), ratio), None
    offered = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1], allowMissingColumns=True)
    keyed = _keyed(offered, train_hard & F.col("__usable"))
    needed = list(dict.fromkeys([*names, "field_group", "split", "document_type", "source_type", "augmentation_type"]))
    order = ["field_name", "crop_path"]
    marks = [c for c in keyed.columns if c.startswith("__")]
    narrow = keyed.select(*[c for c in keyed.columns if c in {*needed, *order, *marks}])
    numbered = _numbered(narrow, needed, _current_bases(manifest, include_rejected))
    kept = numbered.where("__usable AND __current")
    train = F.col("split") == K.TRAIN
    counts = cut_lineage(profile_counts(base.filter(train)).unionByName(profile_counts(kept.filter(train))))
    caps = _caps_from(counts, ratio)
    over = cut_lineage(caps.filter("capped").select(F.coalesce("field_group", F.lit(K.UNKNOWN)).alias("__over")).distinct())
    joined = kept.join(F.broadcast(over), F.col("__group") == F.col("__over"), "left")
    free = joined.where(~(F.col("__open") & F.col("__over").isNotNull()))
    quota = cut_lineage(_quotas_from(counts, caps))
    chosen = _first_of_each(_placed(numbered, quota), SIDE, ["__entry", "__level", "__chunk"], "__crop", "__take")
    free, chosen = (r.select(*[c for c in names if c in r.columns]) for r in (free, chosen))
    rows = base.unionByName(free, allowMissingColumns=True).unionByName(chosen, allowMissingColumns=True).select(*names)
    stale = None
    if hard is not None:
        stale = numbered.where("NOT __current").groupBy(F.coalesce(nonempty(F.col("field_group")), F.lit(K.UNKNOWN)).alias("field_group")).agg(
            F.count(F.lit(1)).alias("stale"))
    return rows, chosen, caps, stale


# --- profiles, warnings, readiness --------------------------------------------------

def profile_counts(rows: DataFrame) -> DataFrame:
    """Rows per field group, split, document type, source type and variant: a small table."""
    kind = F.coalesce(nonempty(F.col("document_type")), F.lit(K.UNKNOWN)).alias("document_type")
    return rows.groupBy("field_group", "split", kind, "source_type", "augmentation_type").agg(F.count(F.lit(1)).alias("rows"))


def char_dictionary(rows: DataFrame) -> DataFrame:
    """Distinct characters of the texts per field group."""
    characters = F.array_distinct(F.split("text", ""))
    return rows.select("field_group", F.explode(characters).alias("character")).filter("character <> ''").distinct()


def _map_of(keys: str, value: Column, when: Column) -> Column:
    return F.map_from_entries(F.array_sort(F.collect_list(F.when(when, F.struct(F.col(keys), value)))))


def source_of(columns: list[str]) -> Column:
    """Where a row comes from: its source, else its base crop, else itself."""
    return F.coalesce(*[nonempty(F.col(c)) for c in ("source_path", "base_crop_path", "crop_path") if c in columns], F.lit(K.UNKNOWN))


def data_profile(rows: DataFrame, caps: DataFrame, stale: DataFrame | None = None) -> DataFrame:
    """Profile of each field group of a training set.

    Counts come from one small table of counts, distinct sources from one distinct aggregate and
    the dictionary size from the distinct characters.
    """
    counts = profile_counts(rows.filter(F.col("split").isin(K.TRAIN, K.VAL)))
    train, val = F.col("split") == K.TRAIN, F.col("split") == K.VAL
    hard = F.col("source_type") == HARD
    n = F.col("rows")
    total = lambda test: F.coalesce(F.sum(F.when(test, n)), F.lit(0)).cast("bigint")
    variants = lambda test: F.count_distinct(F.when(test & hard, F.col("augmentation_type")))
    profile = counts.groupBy("field_group").agg(
        total(train).alias("train_count"), total(val).alias("val_count"),
        total(train & ~hard).alias("train_base_count"), total(train & hard).alias("train_hard_count"),
        total(val & ~hard).alias("val_base_count"), total(val & hard).alias("val_hard_count"),
        variants(train).alias("train_variant_count"), variants(val).alias("val_variant_count"),
    )
    by_type = counts.groupBy("field_group", "split", "document_type").agg(F.sum("rows").alias("rows"))
    by_variant = counts.filter(hard).groupBy("field_group", "split", "augmentation_type").agg(F.sum("rows").alias("rows"))
    maps = by_type.groupBy("field_group").agg(
        _map_of("document_type", n, train).alias("train_by_document_type"), _map_of("document_type", n, val).alias("val_by_document_type")
    ).join(
        by_variant.groupBy("field_group").agg(
            _map_of("augmentation_type", n, train).alias("train_by_variant"), _map_of("augmentation_type", n, val).alias("val_by_variant")
        ), "field_group", "left",
    )
    source = source_of(rows.columns)
    # de-duplicate (group, split, source) first: its shuffle spreads a group over its sources
    distinct = rows.filter(F.col("split").isin(K.TRAIN, K.VAL)).select("field_group", "split", source.alias("source")).distinct()
    sources = distinct.groupBy("field_group").agg(
        F.count_if(train).alias("train_source_count"), F.count_if(val).alias("val_source_count")
    )
    letters = char_dictionary(rows.filter(F.col("split").isin(K.TRAIN, K.VAL))).groupBy("field_group").agg(
        F.count(F.lit(1)).alias("character_count")
    )
    limits = caps.select(
        "field_group", F.col("floor_applied").alias("hard_case_variant_floor_applied"),
        F.col("strategy").alias("hard_case_selection_strategy"), F.col("hard_count").alias("offered"),
    )
    joined = profile.join(sources, "field_group").join(letters, "field_group", "left").join(maps, "field_group").join(
        limits, "field_group", "left"
    )
    joined = joined.join(stale, "field_group", "left") if stale is not None else joined.withColumn("stale", F.lit(0))
    return joined.select(
        *profile.columns, "train_source_count", "val_source_count",
        F.coalesce("character_count", F.lit(0)).cast("bigint").alias("character_count"),
        F.when(F.col("train_count") > 0, F.round(F.col("train_hard_count") / F.col("train_count"), 4)).otherwise(0.0).alias(
            "hard_case_train_ratio"
        ),
        (F.coalesce("offered", F.lit(0)) - F.col("train_hard_count")).cast("bigint").alias("filtered_hard_case_train_count"),
        F.coalesce("stale", F.lit(0)).cast("bigint").alias("filtered_stale_hard_case_count"),
        F.coalesce("hard_case_selection_strategy", F.lit(K.BALANCED_STRATEGY)).alias("hard_case_selection_strategy"),
        F.coalesce("hard_case_variant_floor_applied", F.lit(False)).alias("hard_case_variant_floor_applied"),
        "train_by_document_type", "val_by_document_type", "train_by_variant", "val_by_variant",
    )


def warnings(profile: DataFrame) -> DataFrame:
    """Add the ordered warnings of a profile."""
    n = F.col("train_count")
    return profile.withColumn("warnings", present(
        (n == 0, "no_train_samples"),
        ((n > 0) & (n < 20), "low_train_sample_count"),
        (F.col("val_count") == 0, "no_val_samples"),
        (F.col("hard_case_train_ratio") > 0.5, "hard_case_dominant_train_split"),
        (F.col("filtered_hard_case_train_count") > 0, "hard_case_train_capped"),
        (F.col("filtered_stale_hard_case_count") > 0, "stale_hard_cases_filtered"),
        (F.col("hard_case_variant_floor_applied"), "hard_case_variant_floor_applied"),
        ((F.col("train_hard_count") > 0) & (F.col("train_variant_count") < 2), "low_hard_case_variant_diversity"),
        (F.col("val_source_count") < 2, "low_val_source_diversity"),
    ))


BLOCKING = ("no_train_samples", "no_val_samples")


def readiness(profile: DataFrame) -> DataFrame:
    """Add readiness status, blocking and advisory warnings."""
    blocking = literal_array(BLOCKING)
    implied = present(
        ((F.col("train_count") <= 0) | (F.col("character_count") <= 0), BLOCKING[0]), (F.col("val_count") <= 0, BLOCKING[1])
    )
    listed = F.array_intersect(F.array_distinct("warnings"), blocking)
    # when only the dictionary is empty, the train warning comes after the listed ones
    result = profile.withColumns({
        "blocking_warnings": F.array_union(listed, implied),
        "advisory_warnings": F.array_except("warnings", blocking),
    })
    status = F.when(F.size("blocking_warnings") > 0, "blocked").when(
        F.size("advisory_warnings") > 0, "review_required"
    ).otherwise("ready")
    return result.withColumns({
        "training_readiness_status": status, "ready_for_execution": F.size("blocking_warnings") == 0,
        "unique_hard_case_variant_count": F.col("train_variant_count"),
    })


# --- planned and synthetic rows -------------------------------------------------------

def augment_plan(
    files: DataFrame, copies: int = K.AUGMENTATION_COPIES, seed: int = K.AUGMENTATION_SEED,
    choices: dict[str, dict[str, tuple[float, ...]]] = K.AUGMENTATION, output_root: str = "augmented",
) -> DataFrame:
    """N augmented copies of every train image, each with one choice from every parameter list.

    ``files``: ``path``, ``document_type``, ``split``.  A choice is drawn from the row itself, so
    a rerun or another layout gives the same plan.
    """
    rows = files.filter((F.col("split") == K.TRAIN) & F.col("document_type").isin(*choices)).select(
        "path", "document_type", "split", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("copy")
    )
    chosen = {}
    for name in K.AUGMENTATION_PARAMETERS:
        value = F.lit(None).cast("double")
        for kind, lists in choices.items():
            values = F.array(*[F.lit(float(v)) for v in lists[name]])
            pick = F.pmod(stable_number(seed, F.col("path"), F.col("copy"), name), F.lit(len(lists[name]))).cast("int")
            value = F.when(F.col("document_type") == kind, F.get(values, pick)).otherwise(value)
        chosen[name] = value
    stem = F.regexp_extract("path", r"([^/]+?)(?:\.[^./]*)?$", 1)
    target = F.concat_ws(
        "/", F.lit(output_root), "split", "document_type",
        F.concat(stem, F.lit("__aug_"), F.lpad(F.col("copy").cast("string"), 2, "0"), F.lit(".jpg")),
    )
    return rows.select(
        target.alias("path"), "document_type", "split", F.col("path").alias("source_path"), "copy",
        *[value.alias(name) for name, value in chosen.items()],
    )


def _synthetic_text(field: Column, seed: int, copy: Column) -> Column:
    draw = lambda what, size: F.pmod(stable_number(seed, F.col("crop_path"), copy, what), F.lit(size)).cast("int")
    year, month, day = draw("year", 16) + 2014, draw("month", 12), draw("day", 28) + 1
    name = F.get(literal_array(K.MONTHS), month)
    month_number, day_number = F.lpad((month + 1).cast("string"), 2, "0"), F.lpad(day.cast("string"), 2, "0")
    ending = F.when(day.between(10, 20), "TH").when(day % 10 == 1, "ST").when(day % 10 == 2, "ND").when(day % 10 == 3, "RD").otherwise("TH")
    style = draw("format", 100)
    iso = F.concat_ws("-", year.cast("string"), month_number, day_number)
    dotted = F.concat_ws(".", year.cast("string"), month_number, day_number)
    korean = F.concat(year.cast("string"), F.lit("년 "), month_number, F.lit("월 "), day_number, F.lit("일"))
    ordinal = F.concat(day.cast("string"), ending, F.lit(" DAY OF "), F.upper(name), F.lit(", "), year.cast("string"))
    english = F.concat(name, F.lit(" "), day.cast("string"), F.lit(", "), year.cast("string"))
    return F.when(field == "issued_on", ordinal).when(
        field == "signature_date", F.when(style < 60, iso).when(style < 85, dotted).otherwise(korean)
    ).otherwise(english)


def synthetic_dates(manifest: DataFrame, copies: int = 8, seed: int = K.DATE_SEED, output_root: str = "hard_cases") -> DataFrame:
    """Synthetic date texts for every accepted train date crop."""
    base = manifest.filter(
        (F.col("split") == K.TRAIN) & (F.col("field_group") == K.DATE_GROUP) & F.col("field_name").isin(*K.DATE_FIELDS)
        & is_accepted(F.col("quality.accepted"))
    )
    kept = [c for c in manifest.columns if c not in ("text", "crop_path", "base_crop_path", "augmentation_type", "quality")]
    rows = base.select(*kept, "crop_path", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("copy"))
    stem = F.regexp_extract("crop_path", r"([^/]+?)(?:\.[^./]*)?$", 1)
    path = F.concat(
        F.lit(f"{output_root}/date/{K.SYNTHETIC_DATE}/"), stem, F.lit(f"__{K.SYNTHETIC_DATE}_"),
        F.lpad(F.col("copy").cast("string"), 2, "0"), F.lit(".png"),
    )
    return rows.select(
        *kept, _synthetic_text(F.col("field_name"), seed, F.col("copy")).alias("text"), path.alias("crop_path"),
        F.col("crop_path").alias("base_crop_path"), F.lit(K.SYNTHETIC_DATE).alias("augmentation_type"),
        F.struct(F.lit(True).alias("accepted"), F.lit(True).alias("synthetic")).alias("quality"),
    )


def replace_synthetic(hard: DataFrame, synthetic: DataFrame) -> DataFrame:
    """A hard-case manifest with its earlier synthetic rows exchanged for the new ones."""
    kept = hard.filter(~F.coalesce("augmentation_type", F.lit("")).startswith(K.SYNTHETIC_DATE))
    return kept.unionByName(synthetic, allowMissingColumns=True)


def regression_cases(indexes: DataFrame) -> DataFrame:
    """Label and expected rows of three types for every ``index`` (1, 2, ...), by arithmetic."""
    i = F.col("index")
    text = lambda c: c.cast("string")
    # like a zero-padded number: longer numbers keep all their digits
    pad = lambda c, width: F.lpad(text(c), F.greatest(F.lit(width), F.length(text(c))), F.lit("0"))
    tin = lambda a, b, m, c: F.concat(pad(i + a, 3), F.lit("-"), pad(F.lit(b) + i % m, 2), F.lit("-"), pad(i + c, 4))
    middle = F.substring(F.lit("ABCDEFGHIJKLMNOPQRST"), ((i - 1) % 20 + 1).cast("int"), F.lit(1))
    values = {
        K.RESIDENCY: {
            "taxpayer_name": F.concat(F.lit("Sample "), text(i), F.lit(" User")), "tin": tin(100, 10, 80, 1000),
            "tax_year": F.concat(F.lit("20"), pad(10 + i % 10, 2)),
            "issue_date": F.concat(F.lit("January "), text(1 + i % 28), F.lit(", 2026")),
            "residency_country": F.lit("United States of America"), "residency_country_code": F.lit("US"),
        },
        K.WITHHOLDING: {
            "first_name": F.concat(F.lit("SAMPLE"), text(i)), "last_name": F.lit("USER"), "middle_name": middle,
            "tin": tin(200, 20, 70, 2000),
            "address": F.concat(text(i), F.lit(" Main Street Suite "), text(i), F.lit(" New York NY 10001 United States of America")),
            "residency_country": F.lit("United States of America"), "residency_country_code": F.lit("US"),
            "dividend_tax_rate": F.lit("15%"), "signature_date": F.concat(F.lit("2026-01-"), pad(1 + i % 28, 2)),
            "applicant_name": F.concat(F.lit("SAMPLE"), text(i), F.lit(" "), middle, F.lit(" USER")),
        },
        K.APOSTILLE: {
            "issuing_country": F.lit("UNITED STATES OF AMERICA"), "signed_by": F.concat(F.lit("NOTARY SAMPLE "), text(i)),
            "signer_capacity": F.lit("NOTARY PUBLIC"), "seal_owner": F.lit("COUNTY OF SAMPLE, STATE OF SAMPLE"),
            "issued_at": F.concat(F.lit("Capital City, Sample State "), text(i)),
            "issued_on": F.concat(text(1 + i % 28), F.lit("TH DAY OF APRIL, 202"), text(i % 10)),
            "issuing_authority": F.lit("Secretary of State State of Sample"), "certificate_number": text(i + 5000),
        },
    }
    prefixes = {K.RESIDENCY: "residency", K.WITHHOLDING: "withholding", K.APOSTILLE: "apostille"}
    marks = {K.WITHHOLDING: "all_no_boxes_checked"}
    cases = []
    for kind, fields in values.items():
        case_id = F.concat(F.lit(f"{prefixes[kind]}_regression_"), pad(i, 3))
        cases.append(F.struct(
            case_id.alias("case_id"), F.lit(kind).alias("document_type"),
            F.concat(F.lit(f"synthetic://{kind}/"), case_id).alias("source_path"),
            F.lit("synthetic_regression").alias("dataset_split"), F.lit(K.PASS).alias("expected_status"),
            F.map_from_arrays(literal_array(list(fields)), F.array(*fields.values())).alias("expected_fields"),
            F.map_from_arrays(
                literal_array([marks.get(kind, "seal_present"), "signature_present"]), F.array(F.lit(True), F.lit(True))
            ).alias("expected_quality_checks"),
            F.lit(True).alias("synthetic"),
        ))
    return indexes.select(F.explode(F.array(*cases)).alias("case")).select("case.*")


def synthetic_labels(indexes: DataFrame, seed: int = K.LABEL_SEED) -> DataFrame:
    """Withholding labels with drawn tax numbers for every ``index``."""
    i = F.col("index")
    draw = lambda what, low, high: (F.pmod(stable_number(seed, i, what), F.lit(high - low + 1)) + low).cast("string")
    number = F.lpad(i.cast("string"), F.greatest(F.lit(3), F.length(i.cast("string"))), F.lit("0"))
    fields = {
        "first_name": F.concat(F.lit("Sample"), i.cast("string")), "last_name": F.lit("User"),
        "tin": F.concat_ws("-", draw("prefix", 100, 999), draw("middle", 10, 99), draw("suffix", 1000, 9999)),
        "address": F.concat(i.cast("string"), F.lit(" Main Street")),
        "residency_country": F.lit("United States of America"), "residency_country_code": F.lit("US"),
        "dividend_tax_rate": F.lit("15%"),
    }
    return indexes.select(
        F.concat(F.lit("synthetic_"), number).alias("case_id"), F.lit(K.WITHHOLDING).alias("document_type"),
        F.lit(K.PASS).alias("expected_status"),
        F.map_from_arrays(literal_array(list(fields)), F.array(*fields.values())).alias("fields"),
    )
