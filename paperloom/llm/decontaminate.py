"""Benchmark passages in training texts by a distributed positional inverted index.

1. The terms of the benchmark are counted over all training texts.
2. Every window of an item is looked up by its rarest terms.  Postings of these terms alone, with text and
   position, are stored: an index of everything that a lookup can ask for.
3. The lists are intersected by offset: a window can start only where each of its rarest terms stands
   at its own distance.  What is left is compared with the text word by word; a window whose rarest
   terms stand there out of place, amid most of its words, is a proximity match.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left, insort
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom.llm.common import MEMBER_BITS, byte_texts, membership, slices, small_batches
from paperloom.llm.jaccard import mixed
from paperloom.llm.line_chunks import _split
from paperloom.session import broadcast_if_small, cut_lineage, with_index

#: Words of a window; terms by which it is looked up.
WINDOW, RAREST = 10, 2
#: A proximity match has this share of a window's words within so many words more to either side.
NEAR_SHARE, SLOP = 0.8, 5

#: A-Z become a-z, what is no word character becomes a space; bytes from 0x80 on are part of words.
WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(WORD_BYTES).split()


def _powers(factor: int, n: int) -> np.ndarray:
    out = np.full(n, factor % (1 << 64), np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


#: Bytes that are hashed at once; powers of an odd factor and of its inverse, modulo 2^64.
SPAN, FACTOR = 1 << 20, 0x9E3779B97F4A7C15
POWERS, INVERSE = _powers(FACTOR, SPAN), _powers(pow(FACTOR, -1, 1 << 64), SPAN)


def _terms(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit number of each word: the sum of its bytes times powers of the factor, mixed.

    Differences of one running sum, moved back by the inverse; words that meet in a number would only
    be looked up in vain.
    """
    out = np.zeros(len(starts), np.uint64)
    k = 0
    while k < len(starts):
        low = starts[k]
        if ends[k] - low > SPAN:  # a word beyond the tables, block by block
            for at in range(int(low), int(ends[k]), SPAN):
                block = data[at:min(at + SPAN, int(ends[k]))]
                whole = int(out[k]) + int((block * POWERS[: len(block)]).sum(dtype=np.uint64)) * pow(FACTOR, at - int(low), 1 << 64)
                out[k] = whole % (1 << 64)
            k += 1
            continue
        z = k + int(np.searchsorted(ends[k:], low + SPAN, "right"))
        block = data[low:ends[z - 1]]
        sums = np.zeros(len(block) + 1, np.uint64)
        np.cumsum(block * POWERS[: len(block)], out=sums[1:])
        out[k:z] = (sums[ends[k:z] - low] - sums[starts[k:z] - low]) * INVERSE[starts[k:z] - low]
        k = z
    return mixed(out, 5).view(np.int64)


def terms_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The terms of all words, text after text, and how many each text has."""
    data = np.frombuffer(b" ".join(texts).translate(WORD_BYTES) + b" ", np.uint8)
    inside = np.zeros(len(data) + 1, np.int8)
    inside[1:] = data != 32
    step = np.diff(inside)
    starts, ends = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
    last = np.cumsum([len(t) + 1 for t in texts], dtype=np.int64)
    counts = np.diff(np.searchsorted(starts, last), prepend=0) if texts else np.zeros(0, np.int64)
    return _terms(data, starts, ends), counts


def _listed(terms: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Where a term may be in the membership table."""
    slot = np.mod(terms, MEMBER_BITS)
    return np.flatnonzero((table[slot >> 6] >> (slot & 63).astype(np.uint64)) & np.uint64(1))


def _counted(members):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.frombuffer(members.value, np.uint64)
        for batch in slices(batches, "text"):
            terms, _ = terms_of(byte_texts(batch.column("text")))
            listed, n = np.unique(terms[_listed(terms, table)], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(listed), pa.array(n)], names=["term", "n"])

    return run


def _postings(members):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.frombuffer(members.value, np.uint64)
        for batch in slices(batches, "text"):
            terms, counts = terms_of(byte_texts(batch.column("text")))
            found = _listed(terms, table)
            ends = np.cumsum(counts)
            of = np.searchsorted(ends, found, "right")
            named = batch.select(["row", "doc_id"]).take(pa.array(of))
            at = found - (ends - counts)[of] if len(of) else found
            yield pa.RecordBatch.from_arrays([pa.array(terms[found]), *named.columns, pa.array(at)], names=["term", "row", "doc_id", "at"])

    return run


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        terms, counts = terms_of(byte_texts(batch.column("text")))
        of = np.repeat(np.arange(len(counts)), counts)
        first = np.cumsum(counts) - counts
        columns = [batch.column("item").take(pa.array(of)), pa.array(np.arange(len(terms)) - first[of] if len(of) else of), pa.array(terms)]
        yield pa.RecordBatch.from_arrays(columns, names=["item", "place", "term"])


def lookups(counts: list[int], window: int, rarest: int) -> list[tuple[int, list[int]]]:
    """Start of each window that can occur, and the places of its rarest terms, rarest first, ties to the left."""
    out, many = [], min(window, len(counts))
    held: list[tuple[int, int]] = []  # the window's (count, place), in order
    for i, n in enumerate(counts):
        insort(held, (n, i))
        start = i + 1 - many
        if start < 0:
            continue
        if held[0][0] > 0:
            out.append((start, [p for _, p in held[:rarest]]))
        del held[bisect_left(held, (counts[start], start))]
    return out


def _windows(window: int, rarest: int):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by("place")
        terms = table.column("term").to_pylist()
        found = lookups(table.column("n").to_pylist(), window, rarest)
        return pa.table({
            "item": pa.array([key[0].as_py()] * len(found), pa.int64()), "start": pa.array([s for s, _ in found], pa.int64()),
            "places": pa.array([p for _, p in found], pa.list_(pa.int64())), "terms": pa.array([[terms[p] for p in ps] for _, ps in found], pa.list_(pa.int64()))})

    return run


def occurrences(words: list[bytes], item: list[bytes], windows: list[tuple[int, list[int]]], hits: list[tuple[int, int]], window: int) -> set[tuple[int, int]]:
    """(start in the item, start in the text) of the windows that stand in the text.

    ``hits`` are (place in the item, position in the text) of rarest terms.
    """
    many = min(window, len(item))
    lists: dict[int, set[int]] = defaultdict(set)  # positions less places: where the item would begin
    for place, at in hits:
        lists[place].add(at - place)
    out = set()
    for start, places in windows:
        begins = set.intersection(*(lists.get(p, set()) for p in sorted(places, key=lambda p: len(lists.get(p, ())))))
        for b in begins:
            if b + start >= 0 and words[b + start:b + start + many] == item[start:start + many]:
                out.add((start, b + start))
    return out


def is_near(words: list[bytes], item: list[bytes], windows: list[tuple[int, list[int]]], hits: list[tuple[int, int]], window: int, share: float, slop: int) -> bool:
    """Whether a window's rarest terms each stand within ``slop`` words of their places by the rarest one, amid
    ``share`` of the window's words within ``slop`` words of where it would stand."""
    many = min(window, len(item))
    begins: dict[int, list[int]] = defaultdict(list)
    for place, at in sorted(hits):
        begins[place].append(at - place)
    for start, places in windows:
        wanted = None
        for begin in begins.get(places[0], ()):
            others = (begins.get(p, ()) for p in places[1:])
            if not all((k := bisect_left(x, begin - slop)) < len(x) and x[k] <= begin + slop for x in others):
                continue
            wanted = wanted or Counter(item[start:start + many])
            around = Counter(words[max(0, begin + start - slop):max(0, begin + start + many + slop)])
            if (wanted & around).total() >= share * many:
                return True
    return False


#: The digest of no items.
NOTHING = hashlib.sha256(b"").hexdigest()

FOUND = "doc_id bigint, n_words bigint, n_hit bigint, n_items bigint, n_near bigint, items array<string>, items_sha256 string, contaminated boolean"


def _judged(window: int, share: float, slop: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in FOUND.split(", ")]
        kinds = [pa.int64()] * 5 + [pa.list_(pa.string()), pa.string(), pa.bool_()]
        for batch in slices(batches, "text"):
            texts = byte_texts(batch.column("text"))
            rows = []
            for data, listed in zip(texts, batch.column("items").to_pylist()):
                if not listed:
                    rows.append((0, 0, 0, [], NOTHING, False))
                    continue
                words = words_of(data)
                hit, exact, near = bytearray(len(words)), set(), set()
                for x in listed:
                    item = words_of(x["text"].encode())
                    windows = [(w["start"], w["places"]) for w in x["windows"]]
                    hits = [(h["place"], h["at"]) for h in x["hits"]]
                    stands = occurrences(words, item, windows, hits, window)
                    many = min(window, len(item))
                    for _, at in stands:
                        hit[at:at + many] = b"\x01" * many
                    if stands:
                        exact.add(x["item_id"] or "")
                    elif is_near(words, item, windows, hits, window, share, slop):
                        near.add(x["item_id"] or "")
                ids = sorted(exact, key=str.encode)
                n_hit = sum(hit)
                rows.append((n_hit, len(ids), len(near - exact), ids, hashlib.sha256(",".join(ids).encode()).hexdigest(), n_hit > 0))
            columns = [batch.column("doc_id"), terms_of(texts)[1], *(zip(*rows) if rows else [[]] * 6)]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) if i else c for i, (c, t) in enumerate(zip(columns, kinds))], names=names)

    return run


def contamination(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, rarest: int = RAREST, share: float = NEAR_SHARE, slop: int = SLOP
) -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, n_near, items, items_sha256, contaminated`` for every row of ``docs``.

    Words are runs of letters, digits and non-ASCII characters after A-Z are lower-cased; ``window``
    consecutive words of an item, or all of a shorter one, are a window.  ``n_hit`` counts the words inside
    occurrences of windows, ``items`` lists the items of these, as sorted strings; ``n_near`` counts items that
    only have a proximity match.  Null and empty texts have no words, on either side.  Items with the same
    ``item_id`` are one item, those without are one named by the empty text; rows repeated get equal
    results; other columns don't matter; empty tables give no rows, or rows without hits.
    """
    small_batches(docs.sparkSession)
    spark = docs.sparkSession
    own = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text").where("text IS NOT NULL").distinct()
    items = cut_lineage(with_index(own, [], ["item_id", "text"], "item"))
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").withColumn("row", F.xxhash64("doc_id", "text"))

    # 1. how often the items' terms occur
    terms = cut_lineage(items.select("item", "text").mapInArrow(_item_terms, "item bigint, place bigint, term bigint"))
    asked = spark.sparkContext.broadcast(membership(terms.select("term").distinct(), "term"))
    counts = texts.mapInArrow(_counted(asked), "term bigint, n bigint").groupBy("term").agg(F.sum("n").alias("n"))
    # a term that many items hold is joined to its one count
    known = terms.join(cut_lineage(counts), "term", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    windows = cut_lineage(known.groupBy("item").applyInArrow(
        _windows(window, rarest), "item bigint, start bigint, places array<bigint>, terms array<bigint>"))

    # 2. postings of the terms that windows are looked up by
    pairs = windows.select("item", F.size("places").alias("need"), F.explode(F.arrays_zip("places", "terms")).alias("x"))
    keys = cut_lineage(pairs.groupBy("item", F.col("x.places").alias("place"), F.col("x.terms").alias("term")).agg(F.min("need").alias("need")))
    posted = spark.sparkContext.broadcast(membership(keys.select("term").distinct(), "term"))
    postings = cut_lineage(texts.mapInArrow(_postings(posted), "term bigint, row bigint, doc_id bigint, at bigint"))

    # 3. where the item would begin, by each posting: two places of an item have to agree, but for the slop
    hits = postings.join(broadcast_if_small(keys), "term").groupBy("row", "doc_id", "item").agg(
        F.sort_array(F.collect_list(F.struct((F.col("at") - F.col("place")).alias("begin"), "place", "at"))).alias("hits"), F.min("need").alias("need"))
    agree = F.expr(f"exists(sequence(1, size(hits) - 1), i -> hits[i].begin - hits[i - 1].begin <= {slop} AND hits[i].place <> hits[i - 1].place)")
    hits = hits.where((F.col("need") < 2) | ((F.size("hits") > 1) & agree)).select("row", "doc_id", "item", "hits")
    looked = windows.groupBy("item").agg(F.collect_list(F.struct("start", "places")).alias("windows"))
    about = cut_lineage(items.join(looked, "item").select("item", "item_id", "text", "windows"))
    found = hits.join(broadcast_if_small(about, 1000), "item").groupBy("row", F.col("doc_id").alias("of")).agg(
        F.collect_list(F.struct("item_id", "text", "windows", "hits")).alias("items"))
    found = cut_lineage(found)

    # 4. compare; texts without candidates aren't shuffled
    touched = spark.sparkContext.broadcast(membership(found.select("row").distinct(), "row"))
    maybe = texts.mapInArrow(_split(touched, True), texts.schema)
    same = (maybe["row"] == found["row"]) & maybe["doc_id"].eqNullSafe(found["of"])
    maybe = maybe.join(found, same, "left").select("doc_id", "text", "items")
    alone = texts.mapInArrow(_split(touched, False), texts.schema).select("doc_id", "text", F.lit(None).cast(found.schema["items"].dataType).alias("items"))
    return maybe.unionByName(alone).mapInArrow(_judged(window, share, slop), FOUND)
