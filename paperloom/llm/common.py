"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from contextlib import suppress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from paperloom.session import cut_lineage

#: Rows of a rank bucket that one window is meant to sort.
BUCKET_ROWS = 20_000
#: Rows of an Arrow batch of texts.
BATCH_ROWS = 1000
#: Bits of a membership table.
MEMBER_BITS = 1 << 23


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of at most ``BATCH_ROWS`` rows from here on in this session, unless it asks for fewer.

    Spark's 10,000 documents a batch stand in the memory of the JVM and of a worker at once, for every
    task and Python step.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key, "0")) <= BATCH_ROWS:
        spark.conf.set(key, BATCH_ROWS)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def byte_texts(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of each text, none for null."""
    return [x or b"" for x in column.cast(pa.large_binary()).to_pylist()]


def give_back() -> None:
    """Return freed memory to the system: a worker lives on from stage to stage, beside others of its executor."""
    pa.default_memory_pool().release_unused()
    with suppress(OSError, AttributeError):  # other C libraries have no such call
        ctypes.CDLL(None).malloc_trim(0)


def slices(batches: Iterator[pa.RecordBatch], *columns: str, most: int = 1_000_000) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that a slice holds about ``most`` bytes in ``columns``, or one longer row."""
    for batch in batches:
        lengths = [pc.fill_null(pc.binary_length(batch.column(c)), 0).to_numpy(zero_copy_only=False) for c in columns]
        sizes = np.sum(lengths, axis=0, dtype=np.int64)
        start, held = 0, 0
        for i, size in enumerate(sizes):
            if held and held + size > most:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += size
        if start < batch.num_rows:
            yield batch.slice(start)
        give_back()


def buckets_for(rows: int) -> int:
    """A power of 16 of at most 16^6 buckets, so that about ``BUCKET_ROWS`` rows share one."""
    digits = 0
    while digits < 6 and rows > BUCKET_ROWS * 16**digits:
        digits += 1
    return digits


def running(df: DataFrame, groups: list[str], order: list[str], key: str, rows: int, value: Column, name: str) -> DataFrame:
    """Add ``name``: the sum of ``value`` over the rows of the same group before this one, in ``order``.

    ``key`` holds evenly spread hexadecimal digits and leads the order.  Its first digits deal every
    group into ranges of equal width, so a group that holds a third of all rows is ranked by many
    tasks; the sums of the ranges, a few for each group, supply what lies before each.  Rows that
    agree in the whole order may swap places, which leaves the same set of results.
    """
    digits = buckets_for(rows)
    dealt = df.withColumn("__range", F.substring(key, 1, digits)).withColumn("__value", value)
    sums = dealt.groupBy(*groups, "__range").agg(F.sum("__value").alias("__sum"))
    earlier = Window.partitionBy(*groups).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    named = {g: f"__group_{i}" for i, g in enumerate(groups)}
    before = sums.select(
        *[F.col(g).alias(a) for g, a in named.items()],
        F.col("__range").alias("__in"),
        F.coalesce(F.sum("__sum").over(earlier), F.lit(0)).alias("__before"),
    )
    within = Window.partitionBy(*groups, "__range").orderBy(key, *order).rowsBetween(Window.unboundedPreceding, -1)
    counted = dealt.withColumn("__inside", F.coalesce(F.sum("__value").over(within), F.lit(0)))
    same = F.col("__range") == F.col("__in")
    for group, alias in named.items():
        same = same & F.col(group).eqNullSafe(F.col(alias))
    return counted.join(before, same).select(*df.columns, (F.col("__before") + F.col("__inside")).alias(name))


def membership(ids: DataFrame, column: str) -> bytes:
    """A bit table of fixed size over the ids: absent ones are mostly, present ones never, told absent."""
    slot = F.pmod(F.col(column), F.lit(MEMBER_BITS))
    words = ids.select(slot.alias("slot")).groupBy(F.shiftright("slot", 6).alias("word")).agg(F.expr("bit_or(shiftleft(1L, CAST(slot & 63 AS INT)))").alias("bits"))
    out = np.zeros(MEMBER_BITS // 64, np.uint64)
    for row in words.collect():  # MEMBER_BITS / 64 rows at most
        out[row["word"]] = np.uint64(row["bits"] % (1 << 64))
    return out.tobytes()


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` of every node of ``edges`` (``a, b`` long): root is the smallest node reachable.

    Large and small stars in turn: every round replaces the neighbours of a node by links to the
    smallest one, so paths halve.  Only minima are grouped, hence a node with very many links costs
    one row a task.  Every round is a written table.
    """
    links = cut_lineage(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    while True:
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        floor = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(floor, "a").select("b", "m").where("b <> m").union(floor).toDF("a", "b").distinct()
        after = cut_lineage(small)
        # settled: every node hangs on one root and no root hangs on another
        loose = after.groupBy("a").agg(F.count(F.lit(1)).alias("n")).where("n > 1").limit(1).count()
        if not loose and not after.join(after.select(F.col("a").alias("b")), "b", "left_semi").limit(1).count():
            roots = after.select("b").distinct().select("b", "b")
            return after.union(roots).toDF("node", "root")
        links = after
