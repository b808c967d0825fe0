"""Raster quality."""

from pyspark.sql import functions as F

from paperloom import constants as K
from paperloom.operators import raster as R
from workload import views as V
from workload.q_extract import TEMPLATE_CASE, _mark_values
from workload.query import Query

SMALL = "WITH " + V.RASTERS_CHECK
BIG = "WITH " + V.BIG_RASTERS_CHECK


def blur(spark, folder):
    return R.blur(V.rasters(spark, folder)).select("image_id", F.round("blur_score", 6).alias("blur_score"), "blurry")


BLUR_SQL = SMALL + """, px AS (SELECT image_id, i, pixels, i // 8 AS y, i % 8 AS x FROM rasters_v, generate_series(0, 63) g(i)),
lap AS (SELECT image_id, -4 * pixels[i + 1] + pixels[((y + 7) % 8) * 8 + x + 1] + pixels[((y + 1) % 8) * 8 + x + 1]
  + pixels[y * 8 + (x + 7) % 8 + 1] + pixels[y * 8 + (x + 1) % 8 + 1] AS v FROM px)
SELECT image_id, round(var_pop(v), 6) AS blur_score, var_pop(v) < 100.0 AS blurry FROM lap GROUP BY image_id"""


def _with_template(df):
    names = F.array(*[F.lit(t[0]) for t in K.TEMPLATES])
    return df.withColumn("template_id", F.get(names, (F.col("image_id") % 5).cast("int")))


def marks(spark, folder):
    rows = R.marks(_with_template(V.big_rasters(spark, folder)))
    return rows.groupBy("image_id", "kind", "name").agg(
        F.round(F.sum("dark_ratio"), 6).alias("dark_ratio"), F.count_if("marked").alias("marked"), F.count(F.lit(1)).alias("boxes")
    )


def checkboxes(spark, folder):
    return R.checkboxes(R.marks(_with_template(V.big_rasters(spark, folder))))


def page_checks(spark, folder):
    rows = R.document_checks(_with_template(V.big_rasters(spark, folder)))
    return rows.select("image_id", "seal_present", "signature_present", "all_no_boxes_checked", F.col("checked_no_box_count").cast("bigint").alias("checked_no_box_count"))


MARK_BODY = f""", q(template_id, kind, name, l, t, r, b, d) AS (VALUES {_mark_values()}),
ru AS (SELECT *, row_number() OVER () AS id, greatest(0, least(31, trunc(32 * l)::INT)) AS x0, greatest(0, least(31, trunc(32 * t)::INT)) AS y0 FROM q),
bx AS (SELECT *, greatest(x0 + 1, least(32, trunc(32 * r)::INT)) AS x1, greatest(y0 + 1, least(32, trunc(32 * b)::INT)) AS y1 FROM ru),
im AS (SELECT image_id, {TEMPLATE_CASE.format('image_id')} AS template_id, pixels FROM big_v),
mk AS (SELECT image_id, kind, name, id, d, (SELECT avg(CASE WHEN pixels[i + 1] < 200 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) FROM generate_series(0, 1023) g(i)
   WHERE i % 32 >= x0 AND i % 32 < x1 AND i // 32 >= y0 AND i // 32 < y1) AS ratio FROM im JOIN bx USING (template_id))"""

EDGE_SQL = BIG + """, px AS (SELECT image_id, i // 32 AS y, i % 32 AS x, pixels[i + 1] AS v FROM big_v, generate_series(0, 1023) g(i)),
m AS (SELECT image_id, avg((v < 200)::INT) AS dark, stddev_pop(v) AS contrast, min(x) FILTER (v < 200) AS l, max(x) FILTER (v < 200) AS r, min(y) FILTER (v < 200) AS t, max(y) FILTER (v < 200) AS b,
  avg((v < 200)::INT) FILTER (x < 2) AS el, avg((v < 200)::INT) FILTER (x >= 30) AS er, avg((v < 200)::INT) FILTER (y < 2) AS et, avg((v < 200)::INT) FILTER (y >= 30) AS eb FROM px GROUP BY image_id),
f AS (SELECT *, coalesce((r - l + 1) * (b - t + 1) / 1024.0::DOUBLE, 0.0) AS fg FROM m),
g AS (SELECT *, concat_ws(',', CASE WHEN dark < 0.01 THEN 'low_dark_ratio' END, CASE WHEN contrast < 8 THEN 'low_contrast' END,
  CASE WHEN fg > 0.85 AND dark >= 0.35 THEN 'foreground_fills_crop' END,
  CASE WHEN (el >= 0.45)::INT + (er >= 0.45)::INT + (et >= 0.45)::INT + (eb >= 0.45)::INT >= 3 THEN 'dense_edge_content' END) AS flags FROM f)"""


def crop_quality(spark, folder):
    q = F.col("quality")
    rows = R.crop_quality(V.big_rasters(spark, folder))
    return rows.select(
        "image_id", q["dark_ratio"].alias("dark_ratio"), q["contrast"].alias("contrast"), q["aspect_ratio"].alias("aspect_ratio"),
        q["foreground_bbox_ratio"].alias("foreground"), F.array_join(q["touched_edges"], ",").alias("touched"),
        q["foreground_bbox"]["left"].cast("bigint").alias("box_left"), q["foreground_bbox"]["bottom"].cast("bigint").alias("box_bottom"),
        *[q["edge_dark_ratios"][e].alias(f"edge_{e}") for e in R.EDGES],
    )


def crop_flags(spark, folder):
    rows = R.crop_quality(V.big_rasters(spark, folder))
    return rows.select("image_id", F.array_join("quality.quality_flags", ",").alias("flags"), F.col("quality.accepted").alias("accepted"))


def small_crop_flags(spark, folder):
    rows = R.crop_quality(V.rasters(spark, folder))
    return rows.select("image_id", F.array_contains("quality.quality_flags", "too_narrow").alias("narrow"), F.array_contains("quality.quality_flags", "too_short").alias("short"), F.col("quality.accepted").alias("accepted"))


def edge_trim(spark, folder):
    rows = R.edge_trim(V.big_rasters(spark, folder))
    return rows.select("image_id", *[F.col(f"trim_{e}").cast("bigint").alias(f"trim_{e}") for e in R.EDGES])


TRIM_SQL = EDGE_SQL + """, lines AS (SELECT image_id, 'left' AS e, x AS o, avg((v < 200)::INT) AS ratio FROM px WHERE x < 5 GROUP BY ALL
  UNION ALL SELECT image_id, 'right', 31 - x, avg((v < 200)::INT) FROM px WHERE 31 - x < 5 GROUP BY ALL
  UNION ALL SELECT image_id, 'top', y, avg((v < 200)::INT) FROM px WHERE y < 5 GROUP BY ALL
  UNION ALL SELECT image_id, 'bottom', 31 - y, avg((v < 200)::INT) FROM px WHERE 31 - y < 5 GROUP BY ALL),
st AS (SELECT image_id, e, coalesce(min(o) FILTER (ratio < 0.45), 5) AS n FROM lines GROUP BY ALL)
SELECT image_id, max(n) FILTER (e = 'left') AS trim_left, max(n) FILTER (e = 'right') AS trim_right, max(n) FILTER (e = 'top') AS trim_top, max(n) FILTER (e = 'bottom') AS trim_bottom FROM st GROUP BY image_id"""


def _measured(n: int) -> str:
    """Measures and flags of the crops in the boxes ``b{n}``."""
    band = "greatest(1, least(x1 - x0, y1 - y0) // 12)"
    return f"""
p{n} AS (SELECT px.image_id, x, y, v, x0, y0, x1, y1 FROM px JOIN b{n} USING (image_id) WHERE x >= x0 AND x < x1 AND y >= y0 AND y < y1),
m{n} AS (SELECT image_id, any_value(x1 - x0) AS w, any_value(y1 - y0) AS h, avg((v < 200)::INT) AS dark, stddev_pop(v) AS contrast,
  coalesce((max(x) FILTER (v < 200) - min(x) FILTER (v < 200) + 1) * (max(y) FILTER (v < 200) - min(y) FILTER (v < 200) + 1) / any_value((x1 - x0) * (y1 - y0))::DOUBLE, 0.0) AS fg,
  avg((v < 200)::INT) FILTER (x < x0 + {band}) AS el, avg((v < 200)::INT) FILTER (x >= x1 - {band}) AS er,
  avg((v < 200)::INT) FILTER (y < y0 + {band}) AS et, avg((v < 200)::INT) FILTER (y >= y1 - {band}) AS eb FROM p{n} GROUP BY image_id),
f{n} AS (SELECT *, concat_ws(',', CASE WHEN w < {K.MIN_WIDTH} THEN 'too_narrow' END, CASE WHEN h < {K.MIN_HEIGHT} THEN 'too_short' END, CASE WHEN dark < {K.MIN_DARK_RATIO} THEN 'low_dark_ratio' END,
  CASE WHEN contrast < {K.MIN_CONTRAST} THEN 'low_contrast' END, CASE WHEN fg > {K.MAX_FOREGROUND_RATIO} AND dark >= {K.FILLED_DARK_RATIO} THEN 'foreground_fills_crop' END,
  CASE WHEN (el >= {K.DENSE_EDGE_RATIO})::INT + (er >= {K.DENSE_EDGE_RATIO})::INT + (et >= {K.DENSE_EDGE_RATIO})::INT + (eb >= {K.DENSE_EDGE_RATIO})::INT >= {K.DENSE_EDGE_COUNT} THEN 'dense_edge_content' END) AS flags FROM m{n})"""


def _trimmed(n: int) -> str:
    """The boxes of pass ``n``: those of the pass before, cut by the dense lines of each side, where that leaves enough."""
    sides = (("l", "x", "x - x0", "x1 - x0"), ("r", "x", "x1 - 1 - x", "x1 - x0"), ("t", "y", "y - y0", "y1 - y0"), ("b", "y", "y1 - 1 - y", "y1 - y0"))
    lines = " UNION ALL ".join(
        f"SELECT image_id, '{side}' AS e, {place} AS o, avg((v < 200)::INT) AS ratio, any_value(trunc(({length}) * {K.MAX_TRIM_RATIO}::DOUBLE)::INT) AS most FROM p{n - 1} GROUP BY image_id, {place}"
        for side, _, place, length in sides)
    return f"""
e{n} AS (SELECT image_id, e, coalesce(min(o) FILTER (ratio < {K.DENSE_EDGE_RATIO} AND o < most), any_value(most)) AS cut FROM ({lines}) GROUP BY image_id, e),
c{n} AS (SELECT image_id, max(cut) FILTER (e = 'l') AS l, max(cut) FILTER (e = 'r') AS r, max(cut) FILTER (e = 't') AS t, max(cut) FILTER (e = 'b') AS b FROM e{n} GROUP BY image_id),
b{n} AS (SELECT image_id, x0 + l AS x0, y0 + t AS y0, x1 - r AS x1, y1 - b AS y1 FROM b{n - 1} JOIN c{n} USING (image_id)
  WHERE l + r + t + b > 0 AND x1 - x0 - l - r >= {K.MIN_WIDTH} AND y1 - y0 - t - b >= {K.MIN_HEIGHT})"""


def _salvage_sql() -> str:
    """Up to the given passes, unrolled; the first whose crop has no flag wins."""
    steps = ["px AS (SELECT image_id, i // 32 AS y, i % 32 AS x, pixels[i + 1] AS v FROM big_v, generate_series(0, 1023) g(i))",
             "ba AS (SELECT image_id, 0 AS x0, 0 AS y0, 32 AS x1, 32 AS y1 FROM big_v)", _measured(0).replace("b0", "ba").replace("p0 AS", "pa AS").replace("FROM p0", "FROM pa"),
             "b0 AS (SELECT ba.* FROM ba JOIN f0 USING (image_id) WHERE contains(flags, 'foreground_fills_crop') OR contains(flags, 'dense_edge_content'))",
             "p0 AS (SELECT px.image_id, x, y, v, x0, y0, x1, y1 FROM px JOIN b0 USING (image_id))"]
    for n in range(1, K.TRIM_PASSES + 1):
        steps += [_trimmed(n), _measured(n)]
    tried = " UNION ALL ".join(f"SELECT {n} AS n, f{n}.*, x0, y0, x1, y1 FROM f{n} JOIN b{n} USING (image_id) WHERE flags = ''" for n in range(1, K.TRIM_PASSES + 1))
    steps.append(f"won AS (SELECT * FROM ({tried}) QUALIFY row_number() OVER (PARTITION BY image_id ORDER BY n) = 1)")
    return BIG + ", " + ",\n".join(steps) + """
SELECT image_id, won.n IS NOT NULL AS salvaged, coalesce(won.flags, f0.flags) AS flags, CASE WHEN won.n IS NOT NULL THEN f0.flags END AS original_flags, coalesce(won.w, f0.w)::INT AS width, coalesce(won.h, f0.h)::INT AS height,
  x0::INT AS cut_left, y0::INT AS cut_top, (32 - x1)::INT AS cut_right, (32 - y1)::INT AS cut_bottom FROM f0 LEFT JOIN won USING (image_id)"""


def salvage(spark, folder):
    rows = R.salvage(V.big_rasters(spark, folder))
    return rows.select(
        "image_id", "salvaged", F.array_join("quality.quality_flags", ",").alias("flags"), F.array_join("quality.original_quality_flags", ",").alias("original_flags"),
        F.col("quality.width").alias("width"), F.col("quality.height").alias("height"), F.col("quality.trim_pixels.left").alias("cut_left"),
        F.col("quality.trim_pixels.top").alias("cut_top"), F.col("quality.trim_pixels.right").alias("cut_right"), F.col("quality.trim_pixels.bottom").alias("cut_bottom"),
    )


def confidence(spark, folder):
    c = V.table(spark, folder, "conversations")
    words = F.transform(F.split("text", " "), lambda w: F.struct(w.alias("text"), F.when(F.length(w) > 1, F.least(F.lit(1.0), 0.6 + F.length(w) / 30.0)).alias("confidence")))
    pages = c.select(F.col("conv_id").alias("doc_id"), F.col("turn").alias("page_number"), words.alias("words"))
    rows = R.avg_confidence(pages, ["doc_id"], order="page_number")
    return rows.select("doc_id", F.round("average_ocr_confidence", 6).alias("average_ocr_confidence"), "low_ocr_confidence")


QUERIES = [
    Query("Q1_blur", blur, BLUR_SQL),
    Query("Q2_marks", marks, BIG + MARK_BODY + " SELECT image_id, kind, name, round(sum(ratio), 6) AS dark_ratio, count(*) FILTER (ratio >= d) AS marked, count(*) AS boxes FROM mk GROUP BY ALL"),
    Query("Q2_page_checks", page_checks, BIG + MARK_BODY + """ SELECT image_id, bool_or(ratio >= d) FILTER (name = 'seal_present') AS seal_present, bool_or(ratio >= d) FILTER (name = 'signature_present') AS signature_present,
        bool_and(ratio >= d) FILTER (kind = 'checkbox') AS all_no_boxes_checked, CASE WHEN count(*) FILTER (kind = 'checkbox') > 0 THEN count(*) FILTER (kind = 'checkbox' AND ratio >= d) END AS checked_no_box_count FROM mk GROUP BY image_id"""),
    Query("Q3_checkboxes", checkboxes, BIG + MARK_BODY + " SELECT image_id, name AS field_name, count(*) FILTER (ratio >= d) AS checked_count, bool_and(ratio >= d) AS all_checked FROM mk WHERE kind = 'checkbox' GROUP BY ALL"),
    Query("Q4_crop_quality", crop_quality, EDGE_SQL + """ SELECT image_id, round(dark, 6) AS dark_ratio, round(contrast, 4) AS contrast, 1.0::DOUBLE AS aspect_ratio, round(fg, 6) AS foreground,
        concat_ws(',', CASE WHEN l = 0 THEN 'left' END, CASE WHEN r = 31 THEN 'right' END, CASE WHEN t = 0 THEN 'top' END, CASE WHEN b = 31 THEN 'bottom' END) AS touched, l AS box_left, b AS box_bottom,
        round(el, 6) AS edge_left, round(er, 6) AS edge_right, round(et, 6) AS edge_top, round(eb, 6) AS edge_bottom FROM g"""),
    Query("Q5_crop_flags", crop_flags, EDGE_SQL + " SELECT image_id, flags, flags = '' AS accepted FROM g"),
    Query("Q5_small_crops", small_crop_flags, SMALL + " SELECT image_id, TRUE AS narrow, TRUE AS short, FALSE AS accepted FROM rasters_v"),
    Query("Q6_edge_trim", edge_trim, TRIM_SQL),
    Query("Q7_salvage", salvage, _salvage_sql()),
    Query("Q8_confidence", confidence, """WITH w AS (SELECT conv_id AS doc_id, unnest(string_split(text, ' ')) AS w FROM conversations),
        a AS (SELECT doc_id, avg(least(1.0::DOUBLE, 0.6::DOUBLE + length(w) / 30.0::DOUBLE)) FILTER (length(w) > 1) AS c FROM w GROUP BY doc_id)
        SELECT d.doc_id, round(c, 6) AS average_ocr_confidence, c < 0.75 AS low_ocr_confidence FROM (SELECT DISTINCT conv_id AS doc_id FROM conversations) d LEFT JOIN a USING (doc_id)"""),
]
