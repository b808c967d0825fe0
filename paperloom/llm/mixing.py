"""Mix sources to target weights: hash-random order, prefix sums of sizes, one exact cut a source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paperloom.llm.common import running
from paperloom.session import cut_lineage

#: Weights of the sources in code point order, repeating; a source gives at most so many times its size.
WEIGHTS = (5, 2, 1)
MOST_EPOCHS = 3
SEED = "mix"
#: A word: anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def n_words(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("bigint")


def targets(totals: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_EPOCHS) -> DataFrame:
    """``source, source_size`` -> those and ``target``, the words that the mix takes of the source.

    All sizes together are shared by weight.  A source stops at ``most`` times its size; what it leaves
    goes to the others by weight until none is above.  In closed form: in the order of cap over weight,
    the sources up to some place take their caps and the rest share what remains by weight.  One row a
    source is ranked here, never one a document.
    """
    named = Window.orderBy(F.col("source").asc_nulls_last())
    place = (F.row_number().over(named) - 1) % len(weights)
    weighed = totals.withColumn("w", F.element_at(F.array(*[F.lit(w).cast("bigint") for w in weights]), (place + 1).cast("int")))
    capped = weighed.withColumn("cap", F.col("source_size") * most).withColumn("ratio", F.col("cap") / F.col("w"))
    order = [F.col("ratio"), F.col("source").asc_nulls_last()]
    before = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    rest = Window.orderBy(*order).rowsBetween(Window.currentRow, Window.unboundedFollowing)
    every = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(before), F.lit(0))) / F.sum("w").over(rest)
    leveled = capped.withColumn("level", level)
    # the first source in this order that stays under its cap sets the level for all after it
    share = F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "level"))).over(every)["level"]
    target = F.least(F.col("cap").cast("double"), F.col("w") * F.coalesce(share, F.lit(0.0)))
    return leveled.select("source", "source_size", target.alias("target"))


def mix(docs: DataFrame, size: Column, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_EPOCHS, seed: str = SEED) -> DataFrame:
    """``doc_id, source, size, source_size, target, taken``: a row for each row of ``docs``.

    Every source is walked in the order of a hash of ``doc_id``, as often as its target needs; the last
    round stops at the exact budget, inside a document if need be (``taken`` counts words, so whole
    rounds times the size and the part of the last).  Null ``doc_id`` counts as an empty text in the
    hash, null ``source`` is a source of its own, rows repeated are rows, a table without words takes
    nothing.  Columns beyond ``doc_id``, ``source`` and what ``size`` reads don't matter.
    """
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    # texts are read once: what follows reads the sizes three times
    rows = cut_lineage(docs.select("doc_id", "source", size.alias("size"), key.alias("key")))
    totals = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("rows"))
    n = totals.agg(F.sum("rows")).first()[0] or 0
    goals = targets(totals.select("source", "source_size"), weights, most).withColumnRenamed("source", "of")
    placed = running(rows, ["source"], ["doc_id", "size"], "key", n, F.col("size"), "before")
    joined = placed.join(goals, F.col("source").eqNullSafe(F.col("of")))
    whole = F.floor(F.col("target")).cast("bigint")
    rounds = F.when(F.col("source_size") > 0, F.floor(whole / F.col("source_size"))).otherwise(0).cast("bigint")
    left = whole - rounds * F.col("source_size") - F.col("before")
    taken = rounds * F.col("size") + F.greatest(F.lit(0), F.least(left, F.col("size")))
    return joined.select("doc_id", "source", "size", "source_size", "target", taken.cast("bigint").alias("taken"))


def mixed_texts(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_EPOCHS, seed: str = SEED) -> DataFrame:
    """The mixed corpus with the columns of ``docs``: a row for each round that takes a document.

    The document at the cut keeps its first words.  Documents without words cost nothing and stay once.
    """
    sized = docs.withColumn("__size", n_words(F.col("text")))
    shares = mix(sized, F.col("__size"), weights, most, seed).select(
        F.col("doc_id").alias("__id"), F.col("source").alias("__of"), F.col("size").alias("__n"), F.col("taken").alias("__taken"))
    # rows with the same id, source and size are interchangeable: number both sides
    same = Window.partitionBy("__id", "__of", "__n").orderBy(F.col("__taken").desc())
    twin = Window.partitionBy("doc_id", "source", "__size").orderBy(F.xxhash64("text"), "text")
    left, right = sized.withColumn("__k", F.row_number().over(twin)), shares.withColumn("__j", F.row_number().over(same))
    on = F.col("doc_id").eqNullSafe(F.col("__id")) & F.col("source").eqNullSafe(F.col("__of")) & (F.col("__size") == F.col("__n")) & (F.col("__k") == F.col("__j"))
    joined = left.join(right, on)
    rounds = F.expr("CASE WHEN __size = 0 THEN 1 ELSE CAST(ceil(__taken / __size) AS INT) END")
    copies = joined.where("__taken > 0 OR __size = 0").withColumn("__round", F.explode(F.sequence(F.lit(1), rounds)))
    here = F.col("__taken") - (F.col("__round") - 1) * F.col("__size")
    pieces = F.regexp_extract_all(F.col("text"), F.lit(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"), 0)
    first = F.array_join(F.slice(pieces, 1, here.cast("int")), "")
    text = F.when(here >= F.col("__size"), F.col("text")).otherwise(first)
    return copies.select(*[text.alias("text") if c == "text" else F.col(c) for c in docs.columns])
