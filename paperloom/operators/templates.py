"""Template tables, template choice and region boxes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom import constants as K

REGION_SCHEMA = (
    "template_id string, kind string, name string, left double, top double, right double, bottom double, "
    "min_dark_ratio double, ordinal int"
)


def template_regions(spark: SparkSession, kind: str | None = None) -> DataFrame:
    """The fixed region rules: some fifty rows, safe to broadcast whatever the data size."""
    rows = [(*r, i) for i, r in enumerate(K.TEMPLATE_REGIONS) if kind in (None, r[1])]
    return spark.createDataFrame(rows, REGION_SCHEMA)


def region_rules(template_id: Column, kinds: tuple[str, ...]) -> Column:
    """The rules of a template as a literal array of structs, so that no join is needed."""
    names = ("left", "top", "right", "bottom", "min_dark_ratio")
    number = lambda v: "CAST(NULL AS DOUBLE)" if v is None else f"{v}D"
    chosen = F.array().cast(f"array<struct<kind:string,name:string,{','.join(f'{n}:double' for n in names)}>>")
    for template in dict.fromkeys(r[0] for r in K.TEMPLATE_REGIONS):
        rules = [
            f"named_struct('kind', '{kind}', 'name', '{name}', " + ", ".join(f"'{n}', {number(v)}" for n, v in zip(names, values)) + ")"
            for t, kind, name, *values in K.TEMPLATE_REGIONS
            if t == template and kind in kinds
        ]
        if rules:
            chosen = F.when(template_id == template, F.expr(f"array({', '.join(rules)})")).otherwise(chosen)
    return chosen


def template_of(document_type: Column, path: Column, text: Column) -> Column:
    """Best scoring template of the document type; ties and zero go to the first declared."""
    low_path, low_text = F.lower(path), F.lower(F.coalesce(text, F.lit("")))

    def score(files: tuple[str, ...], texts: tuple[str, ...]) -> Column:
        total = F.lit(0)
        for marker in files:
            total = total + F.when(low_path.contains(marker.lower()), K.FILE_MARKER_SCORE).otherwise(0)
        for marker in texts:
            total = total + F.when(low_text.contains(marker.lower()), K.TEXT_MARKER_SCORE).otherwise(0)
        return total

    best = F.lit(None).cast("string")
    for kind in K.DOCUMENT_TYPES:
        ranked = [
            F.struct(score(files, texts).alias("score"), F.lit(-i).alias("order"), F.lit(name).alias("id"))
            for i, (name, of, files, texts) in enumerate(K.TEMPLATES)
            if of == kind
        ]
        winner = ranked[0]["id"] if len(ranked) == 1 else F.array_max(F.array(*ranked))["id"]
        best = F.when(document_type == kind, winner).otherwise(best)
    return best


def classify(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add ``template_id`` from the source path and the page text."""
    return docs.withColumn("template_id", template_of(F.col("document_type"), F.col("source_path"), F.col(text)))


def pixel_box(width: Column, height: Column, rule: Column) -> Column:
    """Relative box in whole pixels, cut towards zero."""
    return F.struct(
        (width * rule["left"]).cast("int").alias("left"), (height * rule["top"]).cast("int").alias("top"),
        (width * rule["right"]).cast("int").alias("right"), (height * rule["bottom"]).cast("int").alias("bottom"),
    )


def clamped_box(width: Column, height: Column, rule: Column) -> Column:
    """Relative box kept inside the image and at least one pixel wide and high."""
    left = F.greatest(F.lit(0), F.least(width - 1, (width * rule["left"]).cast("int")))
    top = F.greatest(F.lit(0), F.least(height - 1, (height * rule["top"]).cast("int")))
    return F.struct(
        left.alias("left"), top.alias("top"),
        F.greatest(left + 1, F.least(width, (width * rule["right"]).cast("int"))).alias("right"),
        F.greatest(top + 1, F.least(height, (height * rule["bottom"]).cast("int"))).alias("bottom"),
    )


def region_boxes(images: DataFrame, kinds: tuple[str, ...] = ("ocr",), clamp: bool = False) -> DataFrame:
    """One row per image and region of its template; empty boxes are dropped."""
    box = clamped_box if clamp else pixel_box
    rule = F.col("rule")
    boxed = images.select(
        *[c for c in images.columns if c != "pixels"], F.explode(region_rules(F.col("template_id"), kinds)).alias("rule")
    ).withColumn("box", box(F.col("width"), F.col("height"), rule))
    return boxed.filter("box.left < box.right AND box.top < box.bottom").select(
        *[c for c in images.columns if c != "pixels"], rule["kind"].alias("kind"), rule["name"].alias("name"), "box",
        rule["min_dark_ratio"].alias("min_dark_ratio"),
    )
