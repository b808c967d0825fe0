"""Quality classifier: a linear support vector machine on n-gram indicators scaled by naive Bayes ratios."""

from __future__ import annotations

import pickle
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.llm.common import byte_texts, slices

#: Hashed features, byte n-grams of one to three bytes, in chunks for counting.
FEATURES, CHUNKS, ORDERS = 1 << 18, 16, (1, 2, 3)
#: Labelled rows that the margin is fitted on at most; the ratios count all labelled rows.
SAMPLE = 12_000
#: Labels up to which they are broadcast, 12 bytes each; beyond, texts and labels are shuffled.
FEW_LABELS = 1_000_000
#: Smoothing of the counts, cost of a margin error, passes, weight of the fitted against the mean weight.
SMOOTHING, COST, PASSES, TRUST = 1.0, 1.0, 15, 0.9
FOLDS = 5


class Grams:
    """Distinct hashed byte n-grams of a text; the scratch table spares a sort."""

    def __init__(self) -> None:
        self.last = np.zeros(FEATURES, np.int32)

    def __call__(self, text: bytes) -> np.ndarray:
        data = np.frombuffer(text, np.uint8).astype(np.uint64)
        parts, value = [], np.zeros(len(data), np.uint64)
        for n in range(1, max(ORDERS) + 1):
            if len(data) < n:
                break
            value = (value[: len(data) - n + 1] << np.uint64(8)) | data[n - 1:]
            if n in ORDERS:
                mixed = (value + np.uint64(n << 32)) * np.uint64(0x9E3779B97F4A7C15)
                parts.append((mixed >> np.uint64(46)).astype(np.int32))
        if not parts:
            return np.zeros(0, np.int32)
        grams = np.concatenate(parts)
        index = np.arange(len(grams), dtype=np.int32)
        self.last[grams] = index
        return grams[self.last[grams] == index]


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS == 0


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many texts of each class have each feature, as packed chunks; chunk -1 has the texts."""
    grams, seen, texts = Grams(), np.zeros((2, FEATURES), np.int64), np.zeros(2, np.int64)
    for batch in slices(batches, "text"):
        for label, text in zip(batch.column("label").to_pylist(), byte_texts(batch.column("text"))):
            seen[label, grams(text)] += 1
            texts[label] += 1
    parts = [zlib.compress(np.ascontiguousarray(p).tobytes(), 1) for p in np.split(seen, CHUNKS, axis=1)]
    yield pa.RecordBatch.from_arrays([pa.array([-1, *range(CHUNKS)], pa.int32()), pa.array([zlib.compress(texts.tobytes()), *parts], pa.binary())], names=["chunk", "counts"])


def _added(table: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(zlib.decompress(x), np.int64) for x in table.column("counts").to_pylist())
    return pa.table({"chunk": table.column("chunk")[:1], "counts": pa.array([zlib.compress(total.tobytes(), 1)], pa.binary())})


def log_ratios(seen: np.ndarray, smoothing: float = SMOOTHING) -> np.ndarray:
    """Log of the smoothed share of a feature in class 1 over that in class 0; features never seen give 0."""
    p, q = seen[1] + smoothing, seen[0] + smoothing
    ratio = np.log(p / p.sum()) - np.log(q / q.sum())
    return np.where(seen.sum(axis=0) > 0, ratio, 0.0)


def dual_descent(rows: list[tuple[np.ndarray, np.ndarray]], sign: np.ndarray, size: int, cost: float = COST, passes: int = PASSES) -> np.ndarray:
    """Weights, the bias last, of the hinge-loss machine: one dual variable at a time, in random order.

    A variable moves to the minimum of the dual along itself, kept between 0 and ``cost``; ``w`` follows.
    """
    w = np.zeros(size + 1)
    alpha = np.zeros(len(rows))
    square = np.array([float(v @ v) + 1.0 for _, v in rows])
    rng = np.random.default_rng(3)
    for _ in range(passes):
        for i in rng.permutation(len(rows)):
            at, value = rows[i]
            gradient = sign[i] * (w[at] @ value + w[-1]) - 1.0
            new = min(max(alpha[i] - gradient / square[i], 0.0), cost)
            step = (new - alpha[i]) * sign[i]
            if step:
                alpha[i] = new
                w[at] += step * value
                w[-1] += step
    return w


def scaled(at: np.ndarray, ratio: np.ndarray) -> np.ndarray:
    value = ratio[at]
    return value / (np.sqrt(value @ value) or 1.0)


def sigmoid_fit(margin: np.ndarray, label: np.ndarray, steps: int = 50) -> tuple[float, float]:
    """Slope and offset of the label's log odds in the margin, by Newton steps on smoothed labels."""
    ones = label.sum()
    goal = np.where(label > 0, (ones + 1) / (ones + 2), 1 / (len(label) - ones + 2))
    a, b = 1.0, 0.0
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a * margin + b, -30, 30)))
        s = p * (1 - p) + 1e-9
        g = np.array([((p - goal) * margin).sum(), (p - goal).sum()])
        h = np.array([[(s * margin * margin).sum() + 1e-6, (s * margin).sum()], [(s * margin).sum(), s.sum() + 1e-6]])
        da, db = np.linalg.solve(h, g)
        a, b = a - np.clip(da, -2, 2), b - np.clip(db, -2, 2)
    return float(a), float(b)


def train(features: list[np.ndarray], labels: np.ndarray, ratio: np.ndarray, trust: float = TRUST) -> tuple[np.ndarray, float, float, float]:
    """Weight of each feature before scaling, bias, and the sigmoid of the margin.

    The sigmoid is fitted on every fifth row, with weights fitted on the others.
    """
    rows = [(at, scaled(at, ratio)) for at in features]
    sign = np.where(labels > 0, 1.0, -1.0)

    def fitted(use: np.ndarray) -> np.ndarray:
        w = dual_descent([rows[i] for i in use], sign[use], len(ratio))
        used = w[:-1]
        mean = np.abs(used[used != 0]).mean() if (used != 0).any() else 0.0
        w[:-1] = np.where(ratio != 0, trust * used + (1 - trust) * mean, 0.0)
        return w

    if len(set(labels.tolist())) < 2:
        share = (labels.sum() + 1) / (len(labels) + 2)
        return np.zeros(len(ratio)), 0.0, 1.0, float(np.log(share / (1 - share)))
    index = np.arange(len(rows))
    tried = index[index % FOLDS == 0]
    w = fitted(index[index % FOLDS != 0])
    margin = np.array([w[at] @ value + w[-1] for at, value in (rows[i] for i in tried)])
    a, b = sigmoid_fit(margin, labels[tried])
    w = fitted(index)
    return w[:-1], float(w[-1]), a, b


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Features in place of texts, so that what the one task of the fit reads is bounded."""
    grams = Grams()
    for batch in slices(batches, "text"):
        found = [np.asarray(grams(t), np.int32).tobytes() for t in byte_texts(batch.column("text"))]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", "label", "chance", "other")), pa.array(found, pa.binary())], names=["doc_id", "label", "chance", "other", "at"])


def _train(counts):
    def run(table: pa.Table) -> pa.Table:
        ratio = log_ratios(counts.value)
        table = table.sort_by([("chance", "ascending"), ("doc_id", "ascending"), ("other", "ascending")])
        labels = table.column("label").to_numpy().astype(np.int64)
        features = [np.frombuffer(x, np.int32).astype(np.int64) for x in table.column("at").to_pylist()]
        weights, bias, a, b = train(features, labels, ratio)
        model = (ratio.astype(np.float32), (weights * ratio).astype(np.float32), bias, a, b)
        return pa.table({"model": pa.array([zlib.compress(pickle.dumps(model), 1)], pa.binary())})

    return run


def _score(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = Grams()
        ratio, weights, bias, a, b = model.value
        square = ratio.astype(np.float64) ** 2
        for batch in slices(batches, "text"):
            out = np.zeros(batch.num_rows)
            for i, text in enumerate(byte_texts(batch.column("text"))):
                at = grams(text)
                norm = np.sqrt(square[at].sum()) or 1.0
                out[i] = a * (weights[at].sum(dtype=np.float64) / norm + bias) + b
            score = 1 / (1 + np.exp(-np.clip(out, -30, 30)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(score)], names=["doc_id", "score"])

    return run


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple | None:
    """The model, or None without a labelled row; ``labels`` has ``doc_id, label`` and only rows to learn from."""
    context = docs.sparkSession.sparkContext
    known = labels.where("doc_id IS NOT NULL AND label IN (0, 1)").groupBy("doc_id").agg(F.max("label").cast("int").alias("label"))
    texts = docs.select("doc_id", "text")
    few = known.limit(FEW_LABELS + 1).count() <= FEW_LABELS
    packed = texts.join(F.broadcast(known) if few else known, "doc_id").select("text", "label").mapInArrow(_counts, "chunk int, counts binary")
    summed = packed.groupBy("chunk").applyInArrow(_added, "chunk int, counts binary").collect()  # 16 bytes a feature
    parts = {r["chunk"]: np.frombuffer(zlib.decompress(bytes(r["counts"])), np.int64) for r in summed}
    if not parts or not parts[-1].sum():
        return None
    seen = context.broadcast(np.concatenate([parts[c].reshape(2, -1) for c in range(CHUNKS)], axis=1))
    chance = F.xxhash64("doc_id")
    # drawn among the labels that have a document
    held = known.join(texts.select("doc_id"), "doc_id", "left_semi")
    drawn = F.broadcast(held.orderBy(chance, "doc_id").limit(sample))  # ``sample`` rows at most
    rows = texts.join(drawn, "doc_id").select("doc_id", "label", chance.alias("chance"), F.xxhash64("text").alias("other"), "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = rows.mapInArrow(_features, f"doc_id {kind}, label int, chance bigint, other bigint, at binary").orderBy("chance", "doc_id", "other").limit(sample)
    model = rows.withColumn("all", F.lit("sample")).groupBy("all").applyInArrow(_train(seen), "model binary").first()
    return pickle.loads(zlib.decompress(bytes(model["model"])))


def quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, sample: int = SAMPLE) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs``.

    ``labels`` has ``doc_id, quality``.  Rows whose crc32 of ``doc_id`` as text is divisible by five are held
    out of everything learnt: ratios, margin and sigmoid.  Several labels of an id count as the largest;
    null labels and others than 0 and 1 are no labels.  Scores depend on the text alone; a null text is an
    empty one, which has only the bias.  Without a label to learn from every score is 0.5.  Repeated rows
    count as often as they come; other columns don't matter; an empty table gives no rows.
    """
    usable = labels.where(~held_out(F.col("doc_id"))).select("doc_id", F.col("quality").alias("label"))
    model = fit(docs, usable, sample)
    if model is None:
        scored = docs.select("doc_id", F.lit(0.5).alias("score"))
    else:
        shared = docs.sparkSession.sparkContext.broadcast(model)
        scored = docs.select("doc_id", "text").mapInArrow(_score(shared), f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, score double")
    predicted = F.when(F.col("score") >= threshold, 1).otherwise(0)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", predicted.alias("predicted"))
