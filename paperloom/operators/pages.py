"""From recognised lines to one text per document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.functions.text import nonempty, squash, strip


def flatten_lines(raw: DataFrame) -> DataFrame:
    """Pages from nested recognition output.

    ``raw`` has ``doc_id`` and ``pages``: an array (pages) of arrays (lines) of
    ``struct<points, text, confidence>``.  A row holds one document, so this is pure expression
    work: no shuffle.
    """
    pages = raw.select("doc_id", F.posexplode("pages").alias("page_index", "lines"))
    words = F.filter(
        F.transform(
            F.coalesce(F.col("lines"), F.array()),
            lambda line: F.struct(
                strip(line["text"]).alias("text"), line["confidence"].alias("confidence"), line["points"].alias("points")
            ),
        ),
        lambda word: word["text"] != "",
    )
    return pages.select("doc_id", (F.col("page_index") + 1).alias("page_number"), words.alias("words")).select(
        "doc_id", "page_number", F.array_join(F.transform("words", lambda w: w["text"]), "\n").alias("raw_text"), "words"
    )


def document_text(pages: DataFrame, keys: list[str], *more: Column) -> DataFrame:
    """Join the page texts of each document in page order; also on a single line.

    Only key, page number and text are shuffled.  The gathered value is the text of one paper.
    ``more`` are further aggregates to take in the same shuffle.
    """
    ordered = F.array_sort(F.collect_list(F.struct("page_number", "raw_text")))
    joined = pages.groupBy(*keys).agg(ordered.alias("ordered"), *more)
    texts = F.filter(F.transform("ordered", lambda p: p["raw_text"]), lambda t: t.isNotNull() & (t != ""))
    extra = [c for c in joined.columns if c not in (*keys, "ordered")]
    return joined.select(*keys, strip(F.array_join(texts, "\n")).alias("text"), *extra).withColumn(
        "single_line", squash(F.col("text"))
    )


def region_map(regions: DataFrame, keys: list[str]) -> DataFrame:
    """Region texts of a document as a map; blank regions are left out.

    Region names are a closed set, so the map stays small; a name given twice keeps the smaller text.
    """
    named = regions.withColumn("raw_text", nonempty(strip(F.col("raw_text")))).filter("raw_text IS NOT NULL")
    single = named.groupBy(*keys, "name").agg(F.min("raw_text").alias("raw_text"))
    return single.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("name", "raw_text"))).alias("regions"))


def region_text(pages: DataFrame, regions: DataFrame, keys: list[str]) -> DataFrame:
    """Words of the first page whose centre lies inside a relative box, in reading order.

    Everything about a page is in its row, so page size, centres and order are array expressions
    and the boxes (a fixed rule table, or one checked for size by the caller) join by template:
    the containment test never becomes a join of words with boxes.
    """
    first = pages.filter("page_number = 1").select(*keys, "template_id", "words")
    points = F.flatten(F.transform("words", lambda w: F.coalesce(w["points"], F.array())))
    usable = F.filter(points, lambda p: F.size(p) >= 2)
    sized = first.select(
        *keys, "template_id", "words",
        F.array_max(F.transform(usable, lambda p: p[0])).alias("page_width"),
        F.array_max(F.transform(usable, lambda p: p[1])).alias("page_height"),
    ).filter("page_width IS NOT NULL")

    def mean(points_of_word, axis):
        kept = F.filter(points_of_word, lambda p: F.size(p) >= 2)
        total = F.aggregate(kept, F.lit(0.0), lambda s, p: s + p[axis])
        return F.when(F.size(kept) > 0, total / F.size(kept))

    placed = sized.select(
        *keys, "template_id",
        F.transform(
            "words",
            lambda w: F.struct(
                (mean(w["points"], 1) / F.col("page_height")).alias("y"),
                (mean(w["points"], 0) / F.col("page_width")).alias("x"),
                strip(w["text"]).alias("text"),
            ),
        ).alias("placed"),
    )
    boxed = placed.join(
        regions.select(F.col("template_id").alias("rule_template"), "name", "left", "top", "right", "bottom"),
        F.col("template_id") == F.col("rule_template"),
    )
    inside = F.filter(
        "placed",
        lambda w: w["x"].between(F.col("left"), F.col("right")) & w["y"].between(F.col("top"), F.col("bottom")),
    )
    ordered = F.array_sort(
        F.transform(inside, lambda w: F.struct(F.round(w["y"], 3).alias("y"), w["x"].alias("x"), w["text"].alias("text")))
    )
    texts = F.filter(F.transform(ordered, lambda w: w["text"]), lambda t: t != "")
    return boxed.select(*keys, "name", nonempty(squash(F.array_join(texts, " "))).alias("raw_text")).filter(
        "raw_text IS NOT NULL"
    )
