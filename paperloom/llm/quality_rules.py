"""Quality rules around repetition inside a text, measured on a suffix array of its words."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom.llm.common import byte_texts, slices, small_batches

#: Base limits: fewest words, shortest repeat in words, most percent of words inside repeats.
FEWEST_WORDS, SHORTEST, MOST_PERCENT = 10, 5, 20
#: The method's limit on one repeat, in words.
LONGEST = 100
SPACE = b" \t\n\r\x0b\x0c"
SYMBOLS = b"#*$%&|<>"

OUT = "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, longest_repeat bigint"


def suffix_array(keys: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Rank of every suffix (each ending at its text's ``end``) and the ranks by 1, 2, 4... leading words.

    Prefix doubling in which only suffixes that still share their leading words are sorted again.
    """
    n = len(keys)
    order = np.argsort(keys, kind="stable")
    fresh = np.empty(n, bool)
    fresh[0] = True
    np.not_equal(keys[order[1:]], keys[order[:-1]], out=fresh[1:])
    first = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
    rank = np.empty(n, np.int64)
    rank[order] = first
    levels = [rank.copy()]
    lonely = fresh & np.append(fresh[1:], True)
    active, h = order[~lonely], 1
    while active.size:
        inside = active + h < end[active]
        after = np.where(inside, rank[np.where(inside, active + h, 0)], -1)
        by = np.lexsort((after, rank[active]))
        active, after = active[by], after[by]
        group = rank[active]
        new_group = np.append(True, group[1:] != group[:-1])
        fresh = new_group.copy()
        fresh[1:] |= after[1:] != after[:-1]
        index = np.arange(active.size)
        start = np.maximum.accumulate(np.where(new_group, index, 0))
        rank[active] = group + np.maximum.accumulate(np.where(fresh, index, 0)) - start
        active = active[~(fresh & np.append(fresh[1:], True))]
        levels.append(rank.copy())
        h *= 2
    return rank, levels


def longest_shared(keys: np.ndarray, end: np.ndarray, shortest: int) -> np.ndarray:
    """For every word, how many words from it on also stand elsewhere in its text, 0 below ``shortest``.

    The longest common prefixes of neighbours in suffix order: an interval of them is a maximal
    repeat, and the larger of a suffix's two is the longest repeat that begins there.
    """
    best = np.zeros(len(keys), np.int64)
    if not len(keys):
        return best
    rank, levels = suffix_array(keys, end)
    by_rank = np.empty(len(keys), np.int64)
    by_rank[rank] = np.arange(len(keys))
    a, b = by_rank[:-1], by_rank[1:]
    least = min(len(levels) - 1, shortest.bit_length() - 1)
    close = levels[least][a] == levels[least][b]
    a, b = a[close], b[close]
    shared = np.zeros(a.size, np.int64)
    for k in range(len(levels) - 1, -1, -1):
        i, j = a + shared, b + shared
        inside = (i < end[a]) & (j < end[b])
        same = inside & (levels[k][np.where(inside, i, 0)] == levels[k][np.where(inside, j, 0)])
        shared[same] += 1 << k
    np.maximum.at(best, a, shared)
    np.maximum.at(best, b, shared)
    best[best < shortest] = 0
    return best


def repetition(texts: list[list[bytes]], shortest: int) -> tuple[np.ndarray, np.ndarray]:
    """For each text, given as words: words inside the union of its repeats, and its longest repeat."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    number = defaultdict(count().__next__).__getitem__
    ids = np.fromiter((number(w) for words in texts for w in words), np.int64, int(sizes.sum()))
    doc = np.repeat(np.arange(len(texts)), sizes)
    ends = np.cumsum(sizes)
    keys = doc * (ids.max(initial=0) + 1) + ids
    best = longest_shared(keys, ends[doc], shortest)
    where = np.flatnonzero(best)
    edge = np.zeros(len(keys) + 1, np.int64)
    np.add.at(edge, where, 1)
    np.subtract.at(edge, where + best[where], 1)
    covered = np.bincount(doc[np.cumsum(edge[:-1]) > 0], minlength=len(texts))
    longest = np.zeros(len(texts), np.int64)
    np.maximum.at(longest, doc[where], best[where])
    return covered, longest


def _measure(shortest: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([(c.split()[0], pa.int64()) for c in OUT.split(", ")])
        for batch in slices(batches, "text"):
            texts = byte_texts(batch.column("text"))
            words = [t.split() for t in texts]
            chars = [len(t) - len(t.translate(None, bytes(range(0x80, 0xC0)) + SPACE)) for t in texts]
            lines = [[x for x in t.split(b"\n") if x.strip()] for t in texts]
            covered, longest = repetition(words, shortest)
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id").cast(pa.int64()),
                pa.array(map(len, words), pa.int64()),
                pa.array((len(t) - c for t, c in zip(texts, chars)), pa.int64()),
                pa.array((len(t) - len(t.translate(None, SYMBOLS)) for t in texts), pa.int64()),
                pa.array((len(x) - len(set(x)) for x in lines), pa.int64()),
                pa.array(covered, pa.int64()),
                pa.array(longest, pa.int64()),
            ], schema=schema)

    return run


def judge(docs: DataFrame, longest: int = LONGEST, shortest: int = SHORTEST) -> DataFrame:
    """``doc_id``, the measures, ``base_failed`` and ``kept`` of every row.

    Repeats are maximal runs of at least ``shortest`` words that stand twice or more in the text; their
    spans are united.  A text goes if it has under ten words, if more than a fifth of its words lie in
    repeats, or if one repeat is longer than ``longest`` words.  A null text is an empty one: no words,
    rejected.  Rows are judged alone, so ties, repeated rows and other columns don't matter.
    """
    measured = docs.select("doc_id", "text").mapInArrow(_measure(shortest), OUT)
    failed = (F.col("n_words") < FEWEST_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MOST_PERCENT)
    return measured.withColumn("base_failed", failed).withColumn("kept", ~failed & (F.col("longest_repeat") <= longest))


def keep_good(docs: DataFrame, longest: int = LONGEST, shortest: int = SHORTEST) -> DataFrame:
    """The rows of ``docs`` that ``judge`` keeps, unchanged and in one pass."""
    small_batches(docs.sparkSession)
    columns = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            words = [t.split() for t in byte_texts(batch.column("text"))]
            covered, longest_run = repetition(words, shortest)
            n = np.fromiter(map(len, words), np.int64, len(words))
            kept = (n >= FEWEST_WORDS) & (covered * 100 <= n * MOST_PERCENT) & (longest_run <= longest)
            yield batch.filter(pa.array(kept))

    return docs.mapInArrow(run, docs.schema).select(*columns)
