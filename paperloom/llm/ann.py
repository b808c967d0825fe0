"""Nearest neighbours by learned partitions: a balanced cut of a neighbour graph, and a classifier that routes.

A bounded sample of the distinct vectors gives the graph, its balanced partition, the classifier and the
number of partitions that a query visits; every vector is then indexed by the classifier's first choice.
Equal vectors are one class all the way: a class keeps its ``k + 1`` smallest ids and how often each stands
there, up to ``k``; a list of ``k`` neighbours, ties to smaller ids, can hold no other.  A query stands for all
ids of its class; an id of several rows is a query of its own, to which classes of that id alone don't exist.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paperloom.session import cut_lineage

#: Distinct vectors that the model is fitted on; sample vectors of a partition; most partitions.
SAMPLE, PER_PARTITION, MOST_PARTITIONS = 8192, 256, 32
#: Neighbours in the graph, and recall on the sample that sets the partitions visited.
GRAPH, RECALL = 10, 0.95
#: Rows of a block of vectors and of queries, pairs scored exactly at once, and the rounding of a matrix product per length.
VECTORS, QUERIES, PAIRS, ROUNDING = 4096, 1024, 1 << 15, 1e-10


def nearest(x: np.ndarray, k: int, rows: np.ndarray | None = None) -> np.ndarray:
    """Indices of the k vectors of largest inner product with each row, itself excluded, nearest first."""
    rows = np.arange(len(x)) if rows is None else rows
    out = np.empty((len(rows), k), np.int64)
    for s in range(0, len(rows), 512):
        own = rows[s:s + 512]
        score = x[own] @ x.T
        score[np.arange(len(own)), own] = -np.inf
        best = np.argpartition(-score, k - 1, axis=1)[:, :k]
        order = np.argsort(-np.take_along_axis(score, best, 1), axis=1, kind="stable")
        out[s:s + 512] = np.take_along_axis(best, order, 1)
    return out


def balanced_cut(a: np.ndarray, b: np.ndarray, n: int, parts: int, rng: np.random.Generator) -> np.ndarray:
    """Part of each of ``n`` nodes: halves along the second eigenvector, swapped while edges are saved.

    ``a, b`` hold every edge in both directions.  The parts differ by rounding alone.
    """
    part = np.zeros(n, np.int64)

    def halve(ids: np.ndarray, a: np.ndarray, b: np.ndarray, parts: int, first: int) -> None:
        if parts == 1:
            part[ids] = first
            return
        m = len(ids)
        root = np.sqrt(np.bincount(a, minlength=m) + 1.0)
        top = root / np.linalg.norm(root)
        x = rng.standard_normal(m)
        for _ in range(80):
            y = x / root
            x = x + (np.bincount(a, weights=y[b], minlength=m) + y) / root
            x -= top * (top @ x)
            x /= np.linalg.norm(x) or 1.0
        few = parts // 2
        left = np.zeros(m, bool)
        left[np.argsort(x / root, kind="stable")[: m * few // parts]] = True
        for _ in range(10):
            cross = left[a] != left[b]
            gain = np.bincount(a, weights=np.where(cross, 1.0, -1.0), minlength=m)
            inside, outside = np.flatnonzero(left), np.flatnonzero(~left)
            inside = inside[np.argsort(-gain[inside], kind="stable")]
            outside = outside[np.argsort(-gain[outside], kind="stable")]
            pairs = min(len(inside), len(outside))
            swap = int((gain[inside[:pairs]] + gain[outside[:pairs]] > 0).sum()) // 2
            if not swap:
                break
            left[inside[:swap]], left[outside[:swap]] = False, True
        for side, count, start in ((left, few, first), (~left, parts - few, first + few)):
            renamed = np.cumsum(side) - 1
            edge = side[a] & side[b]
            halve(ids[side], renamed[a[edge]], renamed[b[edge]], count, start)

    halve(np.arange(n), a, b, parts, 0)
    return part


def with_bias(x: np.ndarray) -> np.ndarray:
    """Unit vectors and a constant."""
    return np.hstack([x / np.linalg.norm(x, axis=1, keepdims=True), np.ones((len(x), 1))])


def classifier(x: np.ndarray, shares: np.ndarray, steps: int = 150, rate: float = 0.2) -> np.ndarray:
    """Weights of a softmax regression towards ``shares``, by full-batch Adam."""
    inputs = with_bias(x)
    w = np.zeros((inputs.shape[1], shares.shape[1]))
    m, v = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, steps + 1):
        z = inputs @ w
        e = np.exp(z - z.max(axis=1, keepdims=True))
        g = inputs.T @ (e / e.sum(axis=1, keepdims=True) - shares) / len(x)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w


def fit(x: np.ndarray, k: int, recall: float = RECALL, per_partition: int = PER_PARTITION, most: int = MOST_PARTITIONS) -> tuple[np.ndarray, int]:
    """Routing weights and the partitions that a query visits, from a sample of distinct vectors.

    The visits are the fewest with which the sample's own rows find ``recall`` of their ``k`` nearest
    in the sample, which are farther away, and so harder to route to, than those among all rows.
    """
    parts = max(1, min(most, len(x) // per_partition))
    if parts == 1:
        return np.zeros((x.shape[1] + 1, 1)), 1
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = nearest(unit, GRAPH)
    one = np.repeat(np.arange(len(x)), GRAPH)
    part = balanced_cut(np.concatenate([one, near.ravel()]), np.concatenate([near.ravel(), one]), len(x), parts, np.random.default_rng(7))
    shares = np.zeros((len(x), parts))
    shares[np.arange(len(x)), part] += 1
    np.add.at(shares, (one, part[near.ravel()]), 1.0 / GRAPH)
    weights = classifier(x, shares / shares.sum(axis=1, keepdims=True))
    scores = with_bias(x) @ weights
    home = scores.argmax(axis=1)
    tried = np.arange(0, len(x), max(1, len(x) // 1024))
    place = np.argsort(np.argsort(-scores[tried], axis=1, kind="stable"), axis=1)
    needed = np.take_along_axis(place, home[nearest(x, k, tried)], 1)
    reached = np.cumsum(np.bincount(needed.ravel(), minlength=parts)) / needed.size
    return weights, int(np.searchsorted(reached, recall) + 1)


def matrix(column: pa.Array) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(flat), -1)


def _fit(k: int, recall: float):
    def run(table: pa.Table) -> pa.Table:
        return pa.table({"model": pa.array([pickle.dumps(fit(matrix(table.column("embedding")), k, recall))], pa.binary())})

    return run


def _routes(model, home: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, visits = model.value
        for batch in batches:
            if batch.num_rows:
                scores = with_bias(matrix(batch.column("embedding"))) @ weights
                best = np.argsort(-scores, axis=1, kind="stable")[:, : 1 if home else visits].astype(np.int32)
                offsets = pa.array(np.arange(len(best) + 1, dtype=np.int32) * best.shape[1], pa.int32())
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.ListArray.from_arrays(offsets, pa.array(best.ravel()))], names=[*batch.schema.names, "parts"])

    return run


def best_pairs(q: np.ndarray, own: np.ndarray, x: np.ndarray, ids: np.ndarray, most: int) -> tuple[np.ndarray, ...]:
    """Row of ``q``, row of ``x``, exact score and deciding id of each query's ``most`` nearest, ties to smaller ids.

    ``ids`` holds each vector's two smallest ids, ``own`` an id that a query must not find, nan for none;
    the smallest other one decides, and a vector without one is passed over.  The matrix product
    only tells which pairs can't be among the nearest, those below the last by more than its rounding; all
    others are scored exactly, so equal scores stay until the ids decide.
    """
    rough = q @ x.T
    barred = np.flatnonzero(~np.isnan(own))
    rough[barred] = np.where((own[barred][:, None] == ids[:, 0]) & np.isnan(ids[:, 1]), -np.inf, rough[barred])
    k = min(most, len(x))
    last = np.partition(rough, len(x) - k, axis=1)[:, len(x) - k]
    margin = ROUNDING * np.linalg.norm(q, axis=1) * np.linalg.norm(x, axis=1).max()
    one, two = np.nonzero((rough >= (last - margin)[:, None]) & (rough > -np.inf))
    exact = np.empty(len(one))
    for at in range(0, len(one), PAIRS):
        exact[at:at + PAIRS] = (q[one[at:at + PAIRS]] * x[two[at:at + PAIRS]]).sum(axis=1)
    tie = np.where(own[one] == ids[two, 0], ids[two, 1], ids[two, 0])
    order = np.lexsort((tie, -exact, one))
    one, two, exact, tie = one[order], two[order], exact[order], tie[order]
    kept = np.arange(len(one)) - np.searchsorted(one, one) < most
    return one[kept], two[kept], exact[kept], tie[kept]


def _ids(table: pa.Table, name: str, ranks: np.ndarray) -> np.ndarray:
    """Places of the ids among ``ranks``, nan for null, so that they compare exactly whatever their size."""
    column = table.column(name).combine_chunks()
    return np.where(column.is_null().to_numpy(zero_copy_only=False), np.nan, np.searchsorted(ranks, column.fill_null(0).to_numpy()))


def _scored(most: int):
    """The ``most`` nearest classes of a block for each query of a block, exact scores."""

    def run(vectors: pa.Table, queries: pa.Table) -> pa.Table:
        if not vectors.num_rows or not queries.num_rows:
            return pa.table({n: pa.array([], t) for n, t in (("query", pa.int64()), ("own", pa.int64()), ("class", pa.int64()), ("tie", pa.int64()), ("score", pa.float64()))})
        own = queries.column("own").combine_chunks()
        ranks = np.unique(np.concatenate([c.fill_null(0).to_numpy() for c in (own, *(vectors.column(n).combine_chunks() for n in ("least", "second")))]))
        ids = np.stack([_ids(vectors, "least", ranks), _ids(vectors, "second", ranks)], axis=1)
        one, two, exact, tie = best_pairs(matrix(queries.column("embedding")), _ids(queries, "own", ranks), matrix(vectors.column("embedding")), ids, most)
        return pa.table({"query": queries.column("class").to_numpy()[one], "own": own.take(pa.array(one)), "class": vectors.column("class").to_numpy()[two],
                         "tie": ranks[tie.astype(np.int64)], "score": exact})

    return run


def _first(df: DataFrame, by: list[str], order: list[Column], most: int) -> DataFrame:
    return df.withColumn("__n", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("__n") <= most).drop("__n")


def search(vectors: DataFrame, asked: Column, k: int = 20, sample: int = SAMPLE, recall: float = RECALL) -> DataFrame:
    """``query_id, rank, vec_id, score``: the nearest rows found for each row that ``asked`` holds for.

    Nearness is the inner product in double precision; a row is no neighbour of itself; ties go to the
    smaller ``vec_id``.  Rows whose ``embedding`` is null, zero, of another length than most rows', or holds
    a null or non-finite component take no part; nor does a null ``vec_id``.  Repeated ids are rows of
    their own, but none is a neighbour of its own id.  Other columns don't matter; an empty table, or one
    vector, gives no rows.
    """
    spark = vectors.sparkSession
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & finite & F.exists("embedding", lambda x: x != 0)
    rows = vectors.where(usable).select(F.col("vec_id").cast("bigint").alias("vec_id"), "embedding", asked.alias("asked"))
    length = rows.groupBy(F.size("embedding").alias("length")).count().orderBy(F.desc("count"), "length").first()
    rows = rows.where(F.size("embedding") == (length["length"] if length else 0))

    # equal vectors: the smallest ids of each class; window limits cut before the shuffle
    rank = F.dense_rank().over(Window.partitionBy("embedding").orderBy("vec_id"))
    kept = rows.select("embedding", "vec_id", rank.alias("__n")).where(F.col("__n") <= k + 1)
    kept = kept.groupBy("embedding", "vec_id").agg(F.least(F.count(F.lit(1)), F.lit(k)).cast("int").alias("n"))
    flagged = rows.groupBy("embedding").agg(F.max("asked").alias("asked"))
    classes = kept.groupBy("embedding").agg(F.sort_array(F.collect_list(F.struct("vec_id", "n"))).alias("ids")).join(flagged, "embedding")
    two = F.element_at("ids.vec_id", 1).alias("least"), F.try_element_at("ids.vec_id", F.lit(2)).alias("second")
    classes = cut_lineage(classes.select(F.monotonically_increasing_id().alias("class"), *two, "ids", "embedding", "asked"))
    # asked ids and their classes; an id of several rows is its class's query for itself alone
    again = rows.groupBy("vec_id").agg(F.count(F.lit(1)).alias("n"), F.max("asked").alias("asked")).where("n > 1 AND asked").select("vec_id", F.col("vec_id").alias("own"))
    members = rows.where("asked").join(again, "vec_id", "left").join(classes.where("asked").select("class", "embedding"), "embedding")
    members = cut_lineage(members.select("vec_id", "class", "own"))

    drawn = classes.select("least", "embedding").orderBy(F.xxhash64("least", "embedding"), "least").limit(sample)
    fitted = drawn.withColumn("all", F.lit("sample")).groupBy("all").applyInArrow(_fit(k, recall), "model binary").first()
    if fitted is None:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    model = spark.sparkContext.broadcast(pickle.loads(bytes(fitted["model"])))
    schema = "class bigint, {}, embedding " + vectors.schema["embedding"].dataType.simpleString() + ", parts array<int>"
    indexed = classes.select("class", "least", "second", "embedding").mapInArrow(_routes(model, True), schema.format("least bigint, second bigint"))
    wanted = members.select("class", "own").distinct().join(classes.select("class", "embedding"), "class")
    routed = wanted.select("class", "own", "embedding").mapInArrow(_routes(model, False), schema.format("own bigint"))
    indexed = cut_lineage(indexed.select("class", "least", "second", "embedding", F.explode("parts").alias("part")))
    routed = cut_lineage(routed.select("class", "own", "embedding", F.explode("parts").alias("part")))

    # blocks of bounded size: vectors of a part by queries of a part; the counts are one row a part
    sizes = indexed.groupBy("part").agg(F.ceil(F.count(F.lit(1)) / VECTORS).cast("int").alias("across"))
    loads = routed.groupBy("part").agg(F.ceil(F.count(F.lit(1)) / QUERIES).cast("int").alias("down"))
    grid = F.broadcast(sizes.join(loads, "part"))  # at most MOST_PARTITIONS rows
    hashed = F.xxhash64("class")
    left = indexed.join(grid, "part").select(
        "class", "least", "second", "embedding", "part", F.pmod(hashed, F.col("across")).cast("int").alias("i"), F.explode(F.sequence(F.lit(0), F.col("down") - 1)).alias("j"))
    right = routed.join(grid, "part").select(
        "class", "own", "embedding", "part", F.explode(F.sequence(F.lit(0), F.col("across") - 1)).alias("i"), F.pmod(F.xxhash64("class", "own"), F.col("down")).cast("int").alias("j"))
    key = ["part", "i", "j"]
    found = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(_scored(k + 1), "query bigint, own bigint, class bigint, tie bigint, score double")
    query = ["query", "own"]
    best = _first(found, query, [F.desc("score"), F.col("tie")], k + 1)
    ids = classes.select("class", F.flatten(F.transform("ids", lambda x: F.array_repeat(x["vec_id"], x["n"]))).alias("ids"))
    spread = best.join(ids, "class").select(*query, F.explode("ids").alias("vec_id"), "score").where(~F.col("vec_id").eqNullSafe(F.col("own")))
    spread = _first(spread, query, [F.desc("score"), F.col("vec_id")], k + 1)
    lists = spread.groupBy(*query).agg(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("down"), "vec_id", "score"))).alias("near"))
    named = members.join(lists, (members["class"] == lists["query"]) & members["own"].eqNullSafe(lists["own"])).select(members["vec_id"].alias("query_id"), "near")
    others = F.slice(F.filter("near", lambda x: x["vec_id"] != F.col("query_id")), 1, k)
    ranked = named.select("query_id", F.posexplode(others).alias("place", "hit"))
    return ranked.select("query_id", (F.col("place") + 1).cast("int").alias("rank"), F.col("hit.vec_id").alias("vec_id"), F.col("hit.score").alias("score"))
