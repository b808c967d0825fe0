"""Exact Jaccard join of documents on word shingles: prefix tiles in size bands, bitmaps, exact check.

1. Every text becomes the set of its hashed shingles; equal sets are one class from here on.
2. Shingles are ordered from rare to frequent by a fixed-size count table over all documents.  Two sets
   of Jaccard t or more share a shingle among the first n - ceil(t n) + 1 of either, so only those
   enter the tiles, keyed by shingle and size band.  Any order is right; this one keeps passages that
   many documents share out of the tiles.
3. In a tile, every class meets one pivot.  A pair passes if the bits in which its bitmaps differ, each
   of which needs a shingle that only one side has, leave room for the overlap; then the sorted arrays
   are intersected.  Links give components.
4. Tiles that still hold several components have their remaining pairs compared the same way, in blocks,
   so no link is lost, and a group of thousands of copies costs one comparison a copy and tile.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paperloom.llm.common import MEMBER_BITS, byte_texts, components, membership, slices, small_batches
from paperloom.session import cut_lineage, discard

#: Slots of the count table, in chunks; bits of a bitmap, and of the longest one.
SLOTS, CHUNKS, BITS, MOST_BITS = 1 << 22, 64, 1024, 1 << 15
#: Rows of a tile block; blocks of a larger tile are compared pair by pair.
BLOCK = 2048
#: Rows and pairs of a group of blocks, on average; passing pairs that are held before doubles are dropped.
GROUP, GROUP_PAIRS, HELD = 20_000, 1_000_000, 1 << 19
#: Classes that a task remembers, so as to list a copy's prefix once.
SEEN = 200_000

MARKS = "doc_id bigint, n bigint, node bigint, check bigint, bits binary, chunk int, counts binary"


def mixed(x: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit finaliser."""
    x = x + np.uint64((0x9E3779B97F4A7C15 * (2 * seed + 1)) % (1 << 64))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: bytes, width: int) -> np.ndarray:
    """Sorted distinct hashes of the text's shingles; fewer words than ``width`` are one shingle."""
    words = text.lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return np.zeros(0, np.uint64)
    hashed = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    many = min(width, len(words))
    last = len(words) - many + 1
    value = np.full(last, many, np.uint64)
    for j in range(many):
        value = mixed(value ^ hashed[j:j + last], j)
    return np.unique(value)


def digests(shingles: np.ndarray, seed: int) -> tuple[int, int]:
    """Two signed 64-bit digests of a set."""
    sized = np.append(shingles, np.uint64(len(shingles)))
    return tuple(int(mixed(sized, seed + k).sum(dtype=np.uint64).astype(np.int64)) for k in (11, 23))


def bitmap(shingles: np.ndarray) -> bytes:
    """Bit i tells whether an odd number of shingles fall on i, so each differing bit needs a differing shingle.

    There are ``BITS`` bits, doubled until a set has at most two shingles a bit or there are ``MOST_BITS``.
    """
    bits = BITS
    while 2 * bits < len(shingles) and bits < MOST_BITS:
        bits *= 2
    slots = (shingles >> np.uint64(32)).astype(np.int64) & (bits - 1)
    return np.packbits(np.bincount(slots, minlength=bits).astype(np.uint8) & 1).tobytes()


def folded(bits: bytes, size: int) -> np.ndarray:
    """A bitmap brought to ``size`` bits, the same that the set would have had at once."""
    words = np.frombuffer(bits, np.uint64)
    while 64 * len(words) > size:
        words = words[: len(words) // 2] ^ words[len(words) // 2:]
    return words


def _marks(width: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in MARKS.split(", ")]
        schema = pa.schema(list(zip(names, [pa.int64()] * 4 + [pa.binary(), pa.int32(), pa.binary()])))
        counts = np.zeros(SLOTS, np.uint32)
        for batch in slices(batches, "text"):
            sets = [shingle_set(t, width) for t in byte_texts(batch.column("text"))]
            for s in sets:
                np.add.at(counts, (s & np.uint64(SLOTS - 1)).astype(np.int64), np.uint32(1))
            keys = [digests(s, seed) for s in sets]
            none = pa.nulls(len(sets), pa.int32())
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id").cast(pa.int64()), pa.array(map(len, sets), pa.int64()), pa.array((a for a, _ in keys), pa.int64()),
                pa.array((b for _, b in keys), pa.int64()), pa.array(map(bitmap, sets), pa.binary()), none, pa.nulls(len(sets), pa.binary()),
            ], schema=schema)
        parts = [zlib.compress(np.minimum(p, 65535).astype("<u2").tobytes(), 1) for p in np.split(counts, CHUNKS)]
        empty = [pa.nulls(CHUNKS, pa.int64())] * 4 + [pa.nulls(CHUNKS, pa.binary())]
        yield pa.RecordBatch.from_arrays([*empty, pa.array(range(CHUNKS), pa.int32()), pa.array(parts, pa.binary())], schema=schema)

    return run


def _added(table: pa.Table) -> pa.Table:
    """One chunk's counts over all tasks, as levels of a byte: 16 steps a doubling."""
    total = np.zeros(SLOTS // CHUNKS, np.int64)
    for part in table.column("counts").to_pylist():
        total += np.frombuffer(zlib.decompress(part), "<u2")
    levels = np.minimum(255, np.log2(1.0 + total) * 10).astype(np.uint8).tobytes()
    return pa.table({"chunk": table.column("chunk")[:1], "levels": pa.array([levels], pa.binary())})


def _prefixes(width: int, seed: int, num: int, den: int, levels):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level = np.frombuffer(levels.value, np.uint8)
        seen: set[int] = set()
        for batch in slices(batches, "text"):
            shingles, nodes, sizes = [], [], []
            for text in byte_texts(batch.column("text")):
                s = shingle_set(text, width)
                node = digests(s, seed)[0]
                if not len(s) or node in seen:
                    continue
                if len(seen) >= SEEN:
                    seen.clear()
                seen.add(node)
                first = len(s) - -(-num * len(s) // den) + 1
                by = np.argsort(level[(s & np.uint64(SLOTS - 1)).astype(np.int64)], kind="stable")[:first]
                shingles.append(s[by])
                nodes.append(np.full(len(by), node, np.int64))
                sizes.append(np.full(len(by), len(s), np.int32))
            if shingles:
                columns = (np.concatenate(shingles).view(np.int64), np.concatenate(nodes), np.concatenate(sizes))
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["token", "node", "n"])

    return run


def _arrays(width: int, seed: int, members):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.frombuffer(members.value, np.uint64)
        for batch in slices(batches, "text"):
            ids = batch.column("doc_id").cast(pa.int64())
            slot = np.mod(ids.fill_null(0).to_numpy(zero_copy_only=False), MEMBER_BITS)
            told = (table[slot >> 6] >> (slot & 63).astype(np.uint64)) & np.uint64(1) > 0
            batch = batch.filter(pa.array(told | ids.is_null().to_numpy(zero_copy_only=False)))
            sets = [shingle_set(t, width) for t in byte_texts(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([
                pa.array((digests(s, seed)[0] for s in sets), pa.int64()), pa.array((s.tobytes() for s in sets), pa.binary())], names=["node", "shingles"])

    return run


def _room(na, nb, differ, num: int, den: int):
    """Whether sets of these sizes that differ in at least ``differ`` shingles can reach num / den."""
    most = np.minimum((na + nb - differ) // 2, np.minimum(na, nb))
    return den * most >= num * (na + nb - most)


def _close(num: int, den: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "bits_a", "bits_b"):
            differ = []
            for a, b in zip(batch.column("bits_a").to_pylist(), batch.column("bits_b").to_pylist()):
                size = 8 * min(len(a), len(b))
                differ.append(int(np.bitwise_count(folded(a, size) ^ folded(b, size)).sum()))
            na, nb = (batch.column(c).to_numpy() for c in ("n_a", "n_b"))
            fits = _room(na, nb, np.array(differ, np.int64), num, den)
            yield batch.select(["a", "b"]).filter(pa.array(fits))

    return run


def _exact(num: int, den: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "x", "y"):
            linked = []
            for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist()):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                linked.append(den * both >= num * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(linked, pa.bool_()))

    return run


def _block_pairs(num: int, den: int):
    """Pairs inside a tile block that are in different components and pass size and bitmap.

    A group holds many tile blocks, sorted one after another; rows at distance 1, 2... in it are paired
    as long as they share their block, for all blocks at once.
    """

    def run(table: pa.Table) -> pa.Table:
        columns = {c: table.column(c).to_numpy() for c in ("token", "tile", "i", "j", "node", "root", "n", "block")}
        order = np.lexsort([columns[c] for c in ("j", "i", "tile", "token")])
        token, tile, i, j, node, root, n, block = (c[order] for c in columns.values())
        bits = np.stack([folded(x, BITS) for x in table.column("bits").to_pylist()])[order]
        fresh = np.append(True, (token[1:] != token[:-1]) | (tile[1:] != tile[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1]))
        same = np.cumsum(fresh)
        names, own = np.unique(node, return_inverse=True)
        found, held = [np.zeros(0, np.int64)], 0
        x = np.arange(len(order))
        for step in range(1, len(order)):
            x = x[x + step < len(order)]
            x = x[same[x] == same[x + step]]
            if not x.size:
                break
            a, b = x, x + step
            # two blocks: only pairs across them, those inside are another group's
            use = (root[a] != root[b]) & (node[a] != node[b]) & ((i[a] == j[a]) | (block[a] != block[b]))
            a, b = a[use], b[use]
            use = _room(n[a], n[b], np.abs(n[a] - n[b]), num, den)
            a, b = a[use], b[use]
            use = _room(n[a], n[b], np.bitwise_count(bits[a] ^ bits[b]).sum(axis=1, dtype=np.int64), num, den)
            a, b = own[a[use]], own[b[use]]
            # numbers of names are in the order of names
            found.append(np.minimum(a, b) * len(names) + np.maximum(a, b))
            held += len(a)
            if held > max(HELD, len(found[0])):  # as many new ones as there were: merging stays in proportion
                found, held = [np.unique(np.concatenate(found))], 0
        both = np.unique(np.concatenate(found))
        return pa.table({"a": names[both // max(1, len(names))], "b": names[both % max(1, len(names))]})

    return run


class ShingleJoin:
    """The steps of the join over one table; ``num / den`` is the least Jaccard similarity."""

    def __init__(self, docs: DataFrame, width: int, num: int, den: int) -> None:
        self.docs, self.width, self.num, self.den = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"), width, num, den
        self.spark = docs.sparkSession
        small_batches(self.spark)
        self.seed = 0
        while True:
            written = cut_lineage(self.docs.mapInArrow(_marks(width, self.seed), MARKS))
            self.marks = written.where("chunk IS NULL").select("doc_id", "n", "node", "check", "bits")
            # classes are named by one digest; another seed is taken should two sets ever share it
            if not self.marks.groupBy("node").agg(F.min("check").alias("a"), F.max("check").alias("b")).where("a <> b").limit(1).count():
                break
            self.seed += 1
        self.counts = written.where("chunk IS NOT NULL").select("chunk", "counts")
        self.classes = self.marks.where("n > 0").groupBy("node").agg(F.min("doc_id").alias("first"), F.first("n").alias("n"), F.first("bits").alias("bits"))

    def tiles(self) -> DataFrame:
        """``token, tile, node, n, pivot`` where a tile holds two classes or more.

        Tile number b of a token holds its classes in the size bands b and b - 1, which are num / den
        wide: a pair that links lies in one band or two neighbours, so it meets in a tile.  A token
        whose classes lie in one band needs that tile alone.  The pivot is the least class of a tile
        for one half of the tokens, the greatest for the other.
        """
        summed = self.counts.groupBy("chunk").applyInArrow(_added, "chunk int, levels binary").collect()  # SLOTS bytes in all
        table = b"".join(bytes(r["levels"]) for r in sorted(summed, key=lambda r: r["chunk"])) or bytes(SLOTS)
        levels = self.spark.sparkContext.broadcast(table)
        entries = cut_lineage(self.docs.mapInArrow(_prefixes(self.width, self.seed, self.num, self.den, levels), "token bigint, node bigint, n int"))

        def band(n: str) -> Column:
            return F.floor(F.log(F.col(n).cast("double")) / float(np.log(self.den / self.num)) + 1e-6).cast("int")

        # a class can come from several tasks, so this is a superset; tiles of one class go below
        often = entries.groupBy("token").agg(F.count(F.lit(1)).alias("rows"), F.min("n").alias("low"), F.max("n").alias("high"))
        often = often.where("rows > 1").select("token", (band("low") == band("high")).alias("one"))
        own = F.when(F.col("one"), F.array(band("n"))).otherwise(F.array(band("n"), band("n") + 1))
        held = entries.join(often, "token").dropDuplicates(["token", "node"])
        held = cut_lineage(held.select("token", F.explode(own).alias("tile"), "node", "n"))
        discard(entries)
        ends = held.groupBy("token", "tile").agg(F.min("node").alias("a"), F.max("node").alias("b")).where("a <> b")
        pivot = F.when(F.col("token") % 2 == 0, F.col("a")).otherwise(F.col("b"))
        tiles = cut_lineage(held.join(ends.select("token", "tile", pivot.alias("pivot")), ["token", "tile"]))
        discard(held)
        return tiles

    def linked(self, pairs: DataFrame) -> DataFrame:
        """The pairs ``a, b`` of classes that link: bitmaps first, then the arrays themselves."""
        a, b = (self.classes.select(F.col("node").alias(x), F.col("n").alias(f"n_{x}"), F.col("bits").alias(f"bits_{x}"), F.col("first").alias(f"first_{x}")) for x in "ab")
        near = cut_lineage(pairs.join(a, "a").join(b, "b").where(
            (F.col("n_a") * self.den >= F.col("n_b") * self.num) & (F.col("n_b") * self.den >= F.col("n_a") * self.num)
        ).select("a", "b", "n_a", "n_b", "bits_a", "bits_b").mapInArrow(_close(self.num, self.den), "a bigint, b bigint"))
        wanted = near.select(F.col("a").alias("node")).union(near.select("b")).distinct()
        firsts = wanted.join(self.classes.select("node", "first"), "node").where("first IS NOT NULL").select("first")
        members = self.spark.sparkContext.broadcast(membership(firsts, "first"))
        arrays = self.docs.mapInArrow(_arrays(self.width, self.seed, members), "node bigint, shingles binary")
        arrays = cut_lineage(arrays.join(wanted, "node", "left_semi").dropDuplicates(["node"]))
        x, y = arrays.toDF("a", "x"), arrays.toDF("b", "y")
        return near.join(x, "a").join(y, "b").select("a", "b", "x", "y").mapInArrow(_exact(self.num, self.den), "a bigint, b bigint")

    def stars(self, tiles: DataFrame) -> DataFrame:
        """Every class of a tile with the tile's pivot."""
        edges = tiles.where("node <> pivot")
        return edges.select(F.least("node", "pivot").alias("a"), F.greatest("node", "pivot").alias("b")).distinct()

    def rest(self, tiles: DataFrame, roots: DataFrame) -> DataFrame:
        """Pairs of different components in tiles that hold several, in blocks of bounded size."""
        def named(rows: DataFrame) -> DataFrame:
            return rows.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))

        counts = named(tiles.select("token", "tile", "node")).groupBy("token", "tile").agg(F.min("root").alias("x"), F.max("root").alias("y"), F.count(F.lit(1)).alias("size"))
        open_ = cut_lineage(counts.where("x <> y").select("token", "tile", "size", F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks")))
        rows, pairs = open_.agg(F.sum(F.col("size") * F.col("blocks")), F.sum((F.col("size") / F.lit(1000.0)) * F.col("size"))).first()
        groups = max((rows or 0) // GROUP, int((pairs or 0) * 500 // GROUP_PAIRS)) + 1
        rows = named(tiles.drop("pivot").join(open_.drop("size"), ["token", "tile"])).join(self.classes.select("node", "bits"), "node")
        rows = rows.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
        pair = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda k: F.struct(F.least("block", k).alias("i"), F.greatest("block", k).alias("j")))
        dealt = rows.withColumn("pair", F.explode(pair)).select("token", "tile", "pair.i", "pair.j", "node", "root", "n", "block", "bits")
        dealt = dealt.withColumn("group", F.pmod(F.xxhash64("token", "tile", "i", "j"), F.lit(groups)))
        return dealt.groupBy("group").applyInArrow(_block_pairs(self.num, self.den), "a bigint, b bigint").distinct()

    def pairs(self) -> DataFrame:
        """All pairs ``a, b`` of classes that link: every pair of a tile is compared, whatever its component."""
        alone = self.spark.createDataFrame([], "node bigint, root bigint")
        return cut_lineage(self.linked(cut_lineage(self.rest(self.tiles(), alone))))

    def run(self) -> DataFrame:
        """``doc_id, n_shingles, component_id``, a row for each row."""
        tiles = self.tiles()
        stars = cut_lineage(self.stars(tiles))
        links = cut_lineage(self.linked(stars))
        roots = cut_lineage(components(links))
        more = self.linked(self.rest(tiles, roots).join(stars, ["a", "b"], "left_anti"))
        roots = components(links.union(cut_lineage(more)))
        members = self.classes.select("node", "first").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        least = members.groupBy("root").agg(F.min("first").alias("component_id"))
        named = members.join(least, "root").select("node", "component_id")
        return self.marks.join(named, "node", "left").select(
            "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def link(docs: DataFrame, width: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row of ``docs``.

    Words are split at ASCII white space after A-Z are lower-cased; two rows link when their sets of
    ``width``-word shingles have Jaccard similarity num / den or more.  ``component_id`` is the smallest
    ``doc_id`` reachable by links.  A null, empty or blank text has no shingles and links with nothing; a
    null ``doc_id`` takes part but names no component (null, if no other does).  Repeated rows link with
    each other; other columns don't matter; an empty table gives no rows.
    """
    return ShingleJoin(docs, width, num, den).run()


def links(docs: DataFrame, width: int = 5, num: int = 80, den: int = 100) -> tuple[DataFrame, DataFrame]:
    """All links under the rules of ``link``: ``doc_id, n_shingles, class, n_links`` for every row, and ``a, b``.

    Rows of equal shingle sets are one class; a row links with the others of its class and with all rows of
    the classes that a pair ``a < b`` joins to its own, ``n_links`` rows together.  Rows without shingles
    have no class and no links.  There are as many pairs as different texts link, so a group of n near
    copies can cost n squared; ``link`` doesn't.
    """
    join = ShingleJoin(docs, width, num, den)
    pairs = join.pairs()
    sizes = join.marks.where("n > 0").groupBy("node").agg(F.count(F.lit(1)).alias("size"))
    both = pairs.union(pairs.select("b", "a")).toDF("node", "other")
    near = both.join(sizes.withColumnRenamed("node", "other"), "other").groupBy("node").agg(F.sum("size").alias("others"))
    counted = sizes.join(near, "node", "left").select("node", (F.col("size") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"))
    rows = join.marks.withColumn("node", F.when(F.col("n") > 0, F.col("node"))).join(counted, "node", "left")
    return rows.select("doc_id", F.col("n").alias("n_shingles"), F.col("node").alias("class"), F.coalesce("n_links", F.lit(0)).alias("n_links")), pairs


def one_of_each(docs: DataFrame, width: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """The rows of ``docs`` with the smallest ``doc_id`` of their component, repeated rows once.

    Rows without ``doc_id`` stay where no row of their component has one.
    """
    found = link(docs, width, num, den)
    firsts = found.where("doc_id = component_id").select("doc_id").distinct()
    same = Window.partitionBy("doc_id", "__text").orderBy(F.lit(1))
    kept = docs.join(firsts, "doc_id", "left_semi").withColumn("__text", F.xxhash64("text"))
    once = kept.withColumn("__row", F.row_number().over(same)).where("__row = 1").select(*docs.columns)
    nameless = docs.where("doc_id IS NULL")
    if found.where("doc_id IS NULL AND component_id IS NULL").limit(1).count():
        once = once.unionByName(nameless.dropDuplicates(["text"]))
    return once
