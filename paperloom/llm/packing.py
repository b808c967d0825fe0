"""Pack token sequences of documents into as few training sequences as possible: best-two-fit."""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom.llm.common import running, slices, small_batches
from paperloom.session import cut_lineage

LENGTH = 2048
#: Id that ends every document.
END = 0
#: The added token of ``byte_bpe_50k.json``, which is one id wherever it stands in a text.
ADDED = {"<|endoftext|>": 50256}

PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


def default_tokenizer() -> str:
    """Ranks of the byte-level vocabulary whose ids ``byte_bpe_50k.json`` gives too."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def load(path: str, pattern: str | None = None):
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("packing", pat_str=pattern or public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={} if set(ADDED.values()) & set(ranks.values()) else ADDED)


class Spare:
    """The JSON file's library, loaded when the fast one gives up, as it does on a million blanks."""

    def __init__(self, specials_as_text: bool = False) -> None:
        self.specials_as_text, self.tokenizer = specials_as_text, None

    def __call__(self, text: str) -> list[int]:
        if self.tokenizer is None:
            import public_tokenizers
            from tokenizers import Tokenizer

            self.tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
            self.tokenizer.encode_special_tokens = self.specials_as_text
        return self.tokenizer.encode(text, add_special_tokens=False).ids


def encoder(encoding, spare: Spare | None = None):
    """The ids of a text, added tokens found inside it; ``spare`` encodes what ``encoding`` can't."""
    fast = partial(encoding.encode, allowed_special=encoding.special_tokens_set, disallowed_special=())

    def ids(text: str) -> list[int]:
        try:
            return fast(text)
        except ValueError:
            if spare is None:
                raise
            return spare(text)

    return ids


def cut(n: int, length: int) -> list[tuple[int, int]]:
    """Start and length of the pieces of ``n`` ids: whole ones, but for the first, which takes the rest."""
    first = n % length or min(n, length)
    return [(0, first)] + [(s, length) for s in range(first, n, length)]


def _tokens(path: str | None, length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(load(path or default_tokenizer()), Spare() if path is None else None)
        names = [c.split()[0] for c in PIECES.split(", ")]
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
        for batch in slices(batches, "text"):
            rows: list[tuple] = []
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                ids = np.array([*encode(text or ""), END], "<u4")
                rows += [(doc, k, s, n, zlib.crc32(ids[s:s + n])) for k, (s, n) in enumerate(cut(len(ids), length))]
            columns = zip(*rows) if rows else [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=names)

    return run


def best_two_fit(counts: dict[int, int], length: int = LENGTH) -> list[tuple[tuple[int, ...], int]]:
    """Bins as (lengths of the pieces, how many such bins), from the number of pieces of each length.

    A bin opens with the longest piece left and takes the longest one that fits, again and again.  If
    a gap remains, its shortest piece goes back for the two that together come closest to filling the
    wider gap, as long as that helps.  The same bin is filled as often as the counts allow; each kind
    of bin uses up some length, so there are about as many kinds as lengths, whatever the corpus.
    """
    left = np.zeros(length + 1, np.int64)
    for n, c in counts.items():
        left[n] += c
    bins = []
    while (lengths := np.flatnonzero(left)).size:
        bin_, gap = [], length
        while gap and (k := np.searchsorted(lengths, gap, "right")):
            n = int(lengths[k - 1])
            bin_.append(n)
            gap -= n
            left[n] -= 1
            if not left[n]:
                lengths = np.delete(lengths, k - 1)
        while gap and len(bin_) > 1:
            smallest = bin_[-1]
            wide = gap + smallest
            small = lengths[lengths < wide]
            if not small.size:
                break
            partner = np.searchsorted(lengths, wide - small, "right") - 1
            other = np.where(partner >= 0, lengths[np.maximum(partner, 0)], 0)
            twice = (other == small) & (left[small] < 2)  # the only piece of its length can't be both
            below = np.searchsorted(lengths, small, "left") - 1
            other = np.where(twice, np.where(below >= 0, lengths[np.maximum(below, 0)], 0), other)
            sums = np.where(other > 0, small + other, 0)
            best = int(np.argmax(sums))
            if sums[best] <= smallest:
                break
            pair = sorted((int(small[best]), int(other[best])), reverse=True)
            bin_[-1:] = pair
            bin_.sort(reverse=True)
            left[smallest] += 1
            for n in pair:
                left[n] -= 1
            lengths = np.flatnonzero(left)
            gap = length - sum(bin_)
        kinds, uses = np.unique(bin_, return_counts=True)
        again = int((left[kinds] // uses).min())
        left[kinds] -= uses * again
        bins.append((tuple(bin_), 1 + again))
    return bins


def _seats(bins: list[tuple[tuple[int, ...], int]], length: int) -> tuple[np.ndarray, ...]:
    """For each length, ranges of ranks that take the same seat of a kind of bin.

    Sorted arrays: length, first rank, first sequence, offset.  Rank r of a range sits in sequence
    first sequence + (r - first rank).
    """
    taken = np.zeros(length + 1, np.int64)
    rows, sequence = [], 0
    for lengths, times in bins:
        offset = 0
        for n in lengths:
            rows.append((n, taken[n], sequence, offset))
            taken[n] += times
            offset += n
        sequence += times
    rows.sort()
    return tuple(np.array(c, np.int64) for c in zip(*rows)) if rows else tuple(np.zeros(0, np.int64) for _ in range(4))


def pack(docs: DataFrame, length: int = LENGTH, tokenizer: str | None = None) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset``: a row for each piece of a document.

    A document is its ids, ``<|endoftext|>`` in it being one, and one ``END``; null text is empty, so it is one piece of length 1.  How
    many pieces have each length, at most ``length`` numbers, decides the bins on the driver; the
    pieces of one length are then interchangeable, and their rank picks sequence and place.  Ranks come
    from ranges of a hash of document and piece, so a length that a third of all pieces have is spread
    over many tasks.  Rows repeated are packed as often as they come; other columns don't matter; an
    empty table gives no rows.
    """
    small_batches(docs.sparkSession)
    pieces = cut_lineage(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(_tokens(tokenizer, length), PIECES))
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    seats = docs.sparkSession.sparkContext.broadcast(_seats(best_two_fit(counts, length), length))
    key = F.md5(F.concat_ws(":", F.lit("pack"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("piece"), F.col("ids_crc32")))
    ranked = running(pieces.withColumn("key", key), ["length"], ["doc_id", "piece", "ids_crc32"], "key", sum(counts.values()), F.lit(1), "rank")

    def seat(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths, ranks, sequences, offsets = seats.value
        wide = 1 << 48
        keys = lengths * wide + ranks
        for batch in batches:
            n, r = (batch.column(c).to_numpy() for c in ("length", "rank"))
            k = np.searchsorted(keys, n * wide + r, "right") - 1
            places = [pa.array(sequences[k] + r - ranks[k], pa.int64()), pa.array(offsets[k], pa.int64())]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in names] + places, names=[*names, "sequence_id", "offset"])

    columns = ["doc_id", "piece", "start", "length", "ids_crc32", F.col("rank").cast("bigint").alias("rank")]
    return ranked.select(*columns).mapInArrow(seat, PIECES + ", sequence_id bigint, offset bigint")
