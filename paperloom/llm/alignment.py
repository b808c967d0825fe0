"""Alignment of two tokenizers' tokens: products of sparse token-byte incidence matrices.

Row i of A's incidence matrix marks the bytes that token i of the one tokenizer covers, B's the same of the
other.  Row i of A B' then holds the B tokens that share bytes with i, and how many; the product of
the two token-group incidence matrices holds the tokens that share a group.  The matrices are compressed
sparse rows and are multiplied row by row, as Gustavson does, in blocks of rows of bounded size.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paperloom.llm.common import slices, small_batches
from paperloom.llm.packing import Spare, default_tokenizer, load
from paperloom.session import cut_lineage

#: Products of entries that are held at once; bytes of text that a batch aligns together.
PRODUCTS, BATCH_BYTES = 1 << 20, 500_000
#: Pairs whose counts a task holds before it hands them on; pairs up to which counts are broadcast (16 bytes each).
HELD_PAIRS, FEW_PAIRS = 1 << 19, 2_000_000


class Rows(NamedTuple):
    """A matrix of zeros and ones in compressed sparse rows: where each row's entries begin, and their columns."""

    starts: np.ndarray
    columns: np.ndarray
    width: int


def ascending(x: np.ndarray) -> bool:
    return bool(np.all(x[1:] >= x[:-1]))


def transposed(m: Rows) -> Rows:
    counts = np.bincount(m.columns, minlength=m.width)
    of = np.repeat(np.arange(len(m.starts) - 1), np.diff(m.starts))
    if not ascending(m.columns):
        of = of[np.argsort(m.columns, kind="stable")]
    return Rows(np.append(0, np.cumsum(counts)), of, len(m.starts) - 1)


def tallied(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys in order, and how often each stands there; sorted keys aren't sorted again."""
    if not ascending(keys):
        keys = np.sort(keys)
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.diff(first, append=len(keys))


def incidence(lengths: np.ndarray) -> Rows:
    """Each token with the bytes that it covers, tokens one after another."""
    starts = np.append(0, np.cumsum(lengths)).astype(np.int64)
    return Rows(starts, np.arange(starts[-1]), int(starts[-1]))


def product(a: Rows, b: Rows, most: int = PRODUCTS) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The product of ``a`` and ``b`` as rows, columns and values, sorted, block by block.

    A row of the result is the sum of the rows of ``b`` that the row of ``a`` names.  As many rows are summed
    at once as have ``most`` products, or one longer row.
    """
    sizes = np.diff(b.starts)[a.columns]
    work = np.append(0, np.cumsum(sizes))[a.starts]  # products before each row
    row, rows = 0, len(a.starts) - 1
    while row < rows:
        end = max(row + 1, int(np.searchsorted(work, work[row] + most, "right")) - 1)
        entries = slice(a.starts[row], a.starts[end])
        named, many = a.columns[entries], sizes[entries]
        of = np.repeat(np.repeat(np.arange(row, end), np.diff(a.starts[row:end + 1])), many)
        at = np.arange(len(of)) + np.repeat(b.starts[named] - (np.cumsum(many) - many), many)
        keys, values = tallied(of * max(1, b.width) + b.columns[at])
        yield keys // max(1, b.width), keys % max(1, b.width), values
        row = end


def n_products(a: Rows, b: Rows) -> np.ndarray:
    """Products of each row, which for groups, that don't overlap, is how many entries the row of the product has."""
    return np.diff(np.append(0, np.cumsum(np.diff(b.starts)[a.columns]))[a.starts])


class Pair:
    """The two tokenizers, and the bytes of every token."""

    def __init__(self, a_path: str | None = None, b_path: str | None = None) -> None:
        import public_tokenizers
        import sentencepiece

        self.plain = load(a_path or default_tokenizer())
        self.spare = Spare(specials_as_text=True) if a_path is None else None
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path or public_tokenizers.path("piece_bpe_32k.model"))
        with open(a_path or default_tokenizer(), "rb") as lines:
            ranks = {int(r): base64.b64decode(t) for t, r in map(bytes.split, lines)}
        self.a_bytes = [ranks.get(i, b"") for i in range(max(ranks) + 1)]
        self.b_bytes = [
            bytes([int(self.b.id_to_piece(i)[3:5], 16)]) if self.b.is_byte(i) else self.b.id_to_piece(i).replace("▁", " ").encode()
            for i in range(len(self.b))]
        self.a_sizes, self.b_sizes = (np.array(list(map(len, x)), np.int64) for x in (self.a_bytes, self.b_bytes))
        # an id of A before another one of its group, or as the last one; the same of B
        kinds = ((self.a_bytes, b","), (self.a_bytes, b"|"), (self.b_bytes, b","), (self.b_bytes, b";"))
        self.written = [b"%d%s" % (i, mark) for ids, mark in kinds for i in range(len(ids))]
        self.pairs = np.uint32 if len(self.a_bytes) * len(self.b_bytes) < 1 << 32 else np.uint64

    def a_ids(self, text: str) -> list[int]:
        """Ids by the byte-level vocabulary, its special tokens' strings as plain text."""
        try:
            return self.plain.encode(text, disallowed_special=())
        except ValueError:
            if self.spare is None:
                raise
            return self.spare(text)

    def tokens(self, texts: list[str | None]) -> list[tuple[list[int], list[int]]]:
        """Ids of both for each text; none, if the bytes of either aren't those of the text after a space."""
        out = []
        shown = [i for i, t in enumerate(texts) if t]
        by_b = dict(zip(shown, self.b.encode([texts[i] for i in shown], num_threads=1)))
        for i, text in enumerate(texts):
            pair: tuple[list[int], list[int]] = ([], [])
            if text:
                a, b, whole = self.a_ids(" " + text), by_b[i], (" " + text).encode()
                if b"".join(map(self.a_bytes.__getitem__, a)) == whole == b"".join(map(self.b_bytes.__getitem__, b)):
                    pair = (a, b)
            out.append(pair)
        return out


class Aligned(NamedTuple):
    """The tokens of a batch of texts end to end, with the groups and the text that each is of."""

    a: np.ndarray
    b: np.ndarray
    a_of: np.ndarray
    a_rows: Rows
    b_rows: Rows
    a_group: np.ndarray
    b_group: np.ndarray
    n_groups: np.ndarray


def align(pair: Pair, tokens: list[tuple[list[int], list[int]]]) -> Aligned:
    a, b = (np.array([x for p in tokens for x in p[k]], np.int64) for k in (0, 1))
    a_rows, b_rows = incidence(pair.a_sizes[a]), incidence(pair.b_sizes[b])
    a_of = np.repeat(np.arange(len(tokens)), [len(p[0]) for p in tokens])
    # texts lie end to end, so both have an end where a text ends
    ends, others = a_rows.starts[1:], b_rows.starts[1:]
    both = ends[others[np.minimum(np.searchsorted(others, ends), len(others) - 1)] == ends] if len(others) else ends
    a_group, b_group = (np.searchsorted(both, m.starts[1:]) for m in (a_rows, b_rows))
    last = np.flatnonzero(np.append(a_group[1:] != a_group[:-1], True)) if len(a) else np.zeros(0, np.int64)
    return Aligned(a, b, a_of, a_rows, b_rows, a_group, b_group, np.bincount(a_of[last], minlength=len(tokens)))


def group_rows(group: np.ndarray) -> Rows:
    """Each token with its group."""
    return Rows(np.arange(len(group) + 1), group, int(group[-1]) + 1 if len(group) else 0)


def shown(pair: Pair, x: Aligned) -> list[bytes]:
    """The groups of each text as ``a1,a2|b1;a3|b2,b3``."""
    va, vb = len(pair.a_bytes), len(pair.b_bytes)
    a_last, b_last = (np.append(g[1:] != g[:-1], True) if len(g) else np.zeros(0, bool) for g in (x.a_group, x.b_group))
    groups = int(a_last.sum())
    # tokens of A come before those of B in a group
    a_at = np.arange(len(x.a)) + np.searchsorted(x.b_group, x.a_group)
    b_at = np.arange(len(x.b)) + np.searchsorted(x.a_group, x.b_group, "right")
    codes = np.zeros(len(x.a) + len(x.b), np.int64)
    codes[a_at], codes[b_at] = x.a + a_last * va, x.b + 2 * va + b_last * vb
    listed = codes.tolist()
    ends = np.append(0, b_at[b_last] + 1)[np.append(0, np.minimum(np.cumsum(x.n_groups), groups))].tolist()
    return [b"".join(map(pair.written.__getitem__, listed[s:e]))[:-1] for s, e in zip(ends, ends[1:])]


LINKS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("n_a", T.LongType()), T.StructField("n_b", T.LongType()), T.StructField("n_groups", T.LongType()),
    T.StructField("n_links", T.LongType()), T.StructField("n_shared", T.LongType()), T.StructField("groups_sha256", T.StringType()),
    T.StructField("pairs", T.BinaryType()), T.StructField("times", T.BinaryType()),
    T.StructField("pair", T.LongType()), T.StructField("docs", T.LongType()),
])


def _parts(texts: list[str | None], most: int) -> Iterator[slice]:
    """Ranges of texts of about ``most`` characters, or one longer text."""
    start, held = 0, 0
    for i, text in enumerate(texts):
        if held and held + len(text or "") > most:
            yield slice(start, i)
            start, held = i, 0
        held += len(text or "")
    yield slice(start, len(texts))


def _merged(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, at = np.unique(np.concatenate([k for k, _ in held]), return_inverse=True)
    return keys, np.bincount(at, weights=np.concatenate([n for _, n in held]), minlength=len(keys)).astype(np.int64)


def _links(a_path: str | None, b_path: str | None):
    """A row for each text with its distinct pairs, and rows ``pair, docs`` with the counts of a task so far."""

    def counts(held: list[tuple[np.ndarray, np.ndarray]], schema: pa.Schema) -> pa.RecordBatch:
        pairs, docs = _merged(held)
        none = [pa.nulls(len(pairs), f.type) for f in schema][:9]
        return pa.RecordBatch.from_arrays([*none, pa.array(pairs), pa.array(docs)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = Pair(a_path, b_path)
        schema = pa.schema([
            *[(n, pa.int64()) for n in ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_shared")], ("groups_sha256", pa.string()),
            ("pairs", pa.binary()), ("times", pa.binary()), ("pair", pa.int64()), ("docs", pa.int64())])
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in slices(batches, "text", most=BATCH_BYTES):
            tokens = pair.tokens(batch.column("text").to_pylist())
            n, x = len(tokens), align(pair, tokens)
            links, every = np.zeros(n, np.int64), len(pair.a_bytes) * len(pair.b_bytes)
            many = n_products(group_rows(x.a_group), transposed(group_rows(x.b_group)))
            shared = np.bincount(x.a_of, weights=many, minlength=n).astype(np.int64)
            keys = [np.zeros(0, np.int64)]
            for i, j, _ in product(x.a_rows, transposed(x.b_rows)):
                links += np.bincount(x.a_of[i], minlength=n)
                keys.append(x.a_of[i] * every + x.a[i] * len(pair.b_bytes) + x.b[j])
            own, times = tallied(np.concatenate(keys))
            ends = np.searchsorted(own, np.arange(n + 1) * every)
            own %= every
            held.append(tallied(own))
            pairs, times = own.astype(pair.pairs), times.astype(np.uint32)
            cells = [[c[s:e].tobytes() for s, e in zip(ends, ends[1:])] for c in (pairs, times)]
            sha = [hashlib.sha256(g).hexdigest() if g else "" for g in shown(pair, x)]
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array([len(a) for a, _ in tokens], pa.int64()), pa.array([len(b) for _, b in tokens], pa.int64()), pa.array(x.n_groups),
                pa.array(links), pa.array(shared), pa.array(sha, pa.string()), *[pa.array(c, pa.binary()) for c in cells],
                pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64())], schema=schema)
            if sum(len(k) for k, _ in held) > 2 * HELD_PAIRS:
                held = [_merged(held)]
                if len(held[0][0]) > HELD_PAIRS:
                    yield counts(held, schema)
                    held = []
        if held:
            yield counts(held, schema)

    return run


SCORED = "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_shared bigint, n_best bigint, count_sum bigint, groups_sha256 string"


def _unpacked(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, pair and how often, of all pairs of a batch."""
    pairs, times = (batch.column(c).to_pylist() for c in ("pairs", "times"))
    many = np.array([len(t) // 4 for t in times], np.int64)
    kind = np.uint32 if sum(map(len, pairs)) == 4 * many.sum() else np.uint64
    return np.repeat(np.arange(batch.num_rows), many), np.frombuffer(b"".join(pairs), kind).astype(np.int64), np.frombuffer(b"".join(times), np.uint32).astype(np.int64)


def _scored(table):
    """Sums over a text's links from the broadcast counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, docs, best = (np.frombuffer(x, k) for x, k in zip(table.value, (np.int64, np.int64, np.bool_)))
        names = [c.split()[0] for c in SCORED.split(", ")]
        for batch in batches:
            of, own, times = _unpacked(batch)
            k = np.searchsorted(pairs, own)
            bests = np.bincount(of[best[k]], weights=times[best[k]], minlength=batch.num_rows).astype(np.int64)
            total = np.append(0, np.cumsum(times * docs[k]))[np.searchsorted(of, np.arange(batch.num_rows + 1))]
            more = {"n_best": pa.array(bests), "count_sum": pa.array(np.diff(total))}
            yield pa.RecordBatch.from_arrays([more[c] if c in more else batch.column(c) for c in names], names=names)

    return run


def _exploded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        of, own, times = _unpacked(batch)
        yield pa.RecordBatch.from_arrays([batch.column("row").take(pa.array(of)), pa.array(own), pa.array(times)], names=["row", "pair", "times"])


def _pieces(path: str | None) -> int:
    import public_tokenizers
    import sentencepiece

    return len(sentencepiece.SentencePieceProcessor(model_file=path or public_tokenizers.path("piece_bpe_32k.model")))


def alignment(docs: DataFrame, a_path: str | None = None, b_path: str | None = None, few_pairs: int = FEW_PAIRS) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_shared, n_best, count_sum, groups_sha256`` for every row of ``docs``.

    A is the byte-level vocabulary over a space and the text, B the piece model over the text, to which it
    adds the space itself.  A link is a pair of token occurrences that share bytes, ``n_shared`` counts the
    pairs that share a group.  How many rows hold a pair of ids linked is its count: ``count_sum`` is
    its sum over the row's links, ``n_best`` the number of links whose count is the largest of their
    A id.  Null and empty texts, and texts that a tokenizer doesn't give back, have no tokens.  Rows
    repeated count as often as they come; other columns don't matter; an empty table gives no rows.
    """
    small_batches(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    written = cut_lineage(texts.mapInArrow(_links(a_path, b_path), LINKS))
    rows = written.where("pair IS NULL").drop("pair", "docs")
    counts = written.where("pair IS NOT NULL").groupBy("pair").agg(F.sum("docs").alias("docs"))
    counts = cut_lineage(counts.withColumn("a", F.expr(f"pair div {_pieces(b_path)}")))
    most = counts.groupBy("a").agg(F.max("docs").alias("most")).withColumnRenamed("a", "of")
    known = counts.join(most, F.col("a") == F.col("of")).select("pair", "docs", (F.col("docs") == F.col("most")).alias("best"))
    if counts.count() <= few_pairs:
        table = known.sort("pair").toArrow()
        columns = [table.column("pair").to_numpy(), table.column("docs").to_numpy(), table.column("best").to_numpy()]
        return rows.mapInArrow(_scored(docs.sparkSession.sparkContext.broadcast([c.tobytes() for c in columns])), SCORED)
    # too many to send: every text's pairs go where their counts are
    keyed = cut_lineage(rows.withColumn("row", F.monotonically_increasing_id()))
    own = keyed.select("row", "pairs", "times").mapInArrow(_exploded, "row bigint, pair bigint, times bigint")
    sums = own.join(known, "pair").groupBy("row").agg(
        F.sum(F.col("times") * F.col("best").cast("bigint")).alias("n_best"), F.sum(F.col("times") * F.col("docs")).alias("count_sum"))
    joined = keyed.join(sums, "row", "left")
    return joined.select(*[F.coalesce(c, F.lit(0)).alias(c) if c in ("n_best", "count_sum") else F.col(c) for c in (x.split()[0] for x in SCORED.split(", "))])
