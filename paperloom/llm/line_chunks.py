"""Line dedup on content-defined chunks: runs of lines that stand elsewhere too are kept once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paperloom.llm.common import MEMBER_BITS, byte_texts, membership, slices, small_batches
from paperloom.session import cut_lineage

#: Multiplier of the rolling hash over the hashes of two lines, and words of a line that is a passage by itself.
FACTOR, LONG_WORDS = 0x9E3779B97F4A7C15, 50
LONG_SALT = 0x5851F42D4C957F2D
#: Names of columns that the operator adds, for itself or to its result, in lower case.
ADDED = ("n_lines", "n_removed_lines")
RESERVED = frozenset(("row", "drop", "of", *ADDED))


def windows(lines: list[bytes], long_words: int = LONG_WORDS) -> list[tuple[int, int, int]]:
    """First line, last line and rolling hash of every place where a chunk can begin to recur.

    These are two neighbouring lines with words, with the blank ones between them, and single lines of
    ``long_words`` words or more.  A hash depends on those lines alone, so lines added or lost before
    shift nothing.  A chunk is a run of windows that recur, each sharing a line with the next; its
    boundaries lie where the rolling hash stops recurring.
    """
    out, before, hashed = [], -1, 0
    for i, line in enumerate(lines):
        words = len(line.split())
        if not words:
            continue
        value = xxhash.xxh3_64_intdigest(line)
        if before >= 0:
            out.append((before, i, (hashed * FACTOR + value) & (1 << 64) - 1))
        if words >= long_words:
            out.append((i, i, value ^ LONG_SALT))
        before, hashed = i, value
    return out


def _places(texts: list[bytes], long_words: int) -> Iterator[tuple[int, int, int, int, list[bytes]]]:
    """Number of the text, first and last line, hash, and all lines, of every window."""
    for t, text in enumerate(texts):
        lines = text.split(b"\n")
        for start, last, value in windows(lines, long_words):
            yield t, start, last, value, lines


def signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _hashes(long_words: int):
    """The hashes of all windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            values = [x[3] for x in _places(byte_texts(batch.column("text")), long_words)]
            yield pa.RecordBatch.from_arrays([pa.array(np.array(values, np.uint64).view(np.int64))], names=["hash"])

    return run


def _found(long_words: int, members):
    """Windows whose hash may be listed in ``members``, with their bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        listed = np.frombuffer(members.value, np.uint64)
        names = ["hash", "row", "doc_id", "start", "last", "bytes"]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]
        for batch in slices(batches, "text"):
            rows, ids = batch.column("row").to_pylist(), batch.column("doc_id").to_pylist()
            out: list[list] = [[] for _ in kinds]
            for t, start, last, value, lines in _places(byte_texts(batch.column("text")), long_words):
                slot = value % MEMBER_BITS
                if int(listed[slot >> 6]) >> (slot & 63) & 1:
                    for column, x in zip(out, (signed(value), rows[t], ids[t], start, last, b"\n".join(lines[start:last + 1]))):
                        column.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds)], names=names)

    return run


def _split(members, inside: bool):
    """The rows that may be listed, or the others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        listed = np.frombuffer(members.value, np.uint64)
        for batch in batches:
            slot = np.mod(batch.column("row").to_numpy(), MEMBER_BITS)
            told = (listed[slot >> 6] >> (slot & 63).astype(np.uint64)) & np.uint64(1) > 0
            yield batch.filter(pa.array(told == inside))

    return run


def _cut(names: list[str], text_type: pa.DataType = pa.string()):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            texts, counts, gone = [], [], []
            for data, null, drop in zip(byte_texts(batch.column("text")), batch.column("text").is_null().to_pylist(), batch.column("drop").to_pylist()):
                lines = data.split(b"\n") if data else []
                kept = lines
                if drop:
                    cut = {i for place in drop for i in range(place >> 32, (place & 0xFFFFFFFF) + 1)}
                    kept = [x for i, x in enumerate(lines) if i not in cut]
                texts.append(None if null else b"\n".join(kept).decode())
                counts.append(len(lines))
                gone.append(len(lines) - len(kept))
            columns = [pa.array(texts, text_type) if c == "text" else batch.column(c) for c in names]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(counts, pa.int64()), pa.array(gone, pa.int64())], names=[*names, "n_lines", "n_removed_lines"])

    return run


def dedup_lines(docs: DataFrame, long_words: int = LONG_WORDS) -> DataFrame:
    """``docs`` with the repeated chunks cut out of ``text``, and ``n_lines``, ``n_removed_lines``.

    Lines end at ``\\n``.  A window, two neighbouring lines with words and the blank ones between them or
    one line of ``long_words`` words or more, whose bytes stand in several places stays in the first one,
    by ``doc_id`` (null last) and line; the lines of all others go, be they in the same text.  So every
    run of two lines or more that stands earlier goes whole, whatever lines surround it, and the first
    place of each different line stays.
    Null texts stay null, an empty text has no lines, a text can end up empty.  Rows that repeat both
    ``doc_id`` and text are one document and all keep what it keeps.  Columns of ``docs`` beside
    ``doc_id`` and ``text`` are carried along under their names, but for own ``n_lines`` and ``n_removed_lines``, whatever
    their case, which give way to those added.  An empty table gives an empty table.
    """
    prefix = "__own"
    while any(c.lower().startswith(prefix) for c in docs.columns):
        prefix += "_"
    inner = [f"{prefix}{i}" if c.lower() in RESERVED else c for i, c in enumerate(docs.columns)]
    cut = _dedup_lines(docs.toDF(*inner), long_words)
    kept = [F.col(i).alias(c) for i, c in zip(inner, docs.columns) if c.lower() not in ADDED]
    return cut.select(*kept, *ADDED)


def _dedup_lines(docs: DataFrame, long_words: int) -> DataFrame:
    """The operator over tables without reserved names."""
    small_batches(docs.sparkSession)
    spark = docs.sparkSession
    keyed = docs.withColumn("row", F.xxhash64("doc_id", "text"))
    texts = keyed.select("row", F.col("doc_id").cast("bigint").alias("doc_id"), "text")

    # 1. rolling hashes that occur in more than one place
    places = texts.select("text").mapInArrow(_hashes(long_words), "hash bigint")
    often = cut_lineage(places.groupBy("hash").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("hash"))
    # 2. the bytes of those windows alone; equal bytes are one class, whose first place stays
    members = spark.sparkContext.broadcast(membership(often, "hash"))
    found = texts.mapInArrow(_found(long_words, members), "hash bigint, row bigint, doc_id bigint, start int, last int, bytes binary")
    at = F.struct(F.col("doc_id").isNull().alias("a"), F.col("doc_id").alias("b"), F.col("start").alias("c"))
    found = cut_lineage(found.join(often, "hash", "left_semi").select("*", at.alias("at")))
    first = found.groupBy("hash", "bytes").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    later = found.join(first, ["hash", "bytes"]).where(~F.col("at").eqNullSafe(F.col("first")))
    place = F.shiftleft(F.col("start").cast("bigint"), 32) + F.col("last")
    drops = cut_lineage(later.groupBy("row", F.col("doc_id").alias("of")).agg(F.collect_set(place).alias("drop")))
    # 3. cut them out; texts that lose nothing aren't shuffled
    touched = spark.sparkContext.broadcast(membership(drops, "row"))
    columns = docs.columns
    out = T.StructType([*docs.schema.fields, T.StructField("n_lines", T.LongType()), T.StructField("n_removed_lines", T.LongType())])
    maybe = keyed.mapInArrow(_split(touched, True), keyed.schema)
    own = (maybe["row"] == drops["row"]) & maybe["doc_id"].cast("bigint").eqNullSafe(drops["of"])
    maybe = maybe.join(drops, own, "left").drop(drops["row"], drops["of"])
    alone = keyed.mapInArrow(_split(touched, False), keyed.schema).withColumn("drop", F.lit(None).cast("array<bigint>"))
    return maybe.select(*columns, "drop").unionByName(alone.select(*columns, "drop")).mapInArrow(_cut(columns), out)
