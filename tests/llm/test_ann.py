"""Neighbour search against brute force."""

import numpy as np
from pyspark.sql import functions as F

from paperloom.llm import ann


def brute(rows, k):
    out = {}
    for q, v in rows:
        if q % 20 == 0:
            near = sorted((-float((np.array(v) * np.array(x)).sum()), i) for i, x in rows if i != q)[:k]
            out[q] = [(i, -s) for s, i in near]
    return out


def search(spark, rows, **more):
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("class", F.lit("clash")).withColumn("part", F.lit(1))
    got = {}
    for r in ann.search(table, F.col("vec_id") % 20 == 0, **more).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    return {q: [(i, s) for _, i, s in sorted(x)] for q, x in got.items()}


def test_small_and_awkward(spark):
    rng = np.random.default_rng(0)
    good = [(i, [float(x) for x in np.float32(rng.standard_normal(8))]) for i in range(60)]
    good += [(i, good[0][1]) for i in range(60, 100)]  # forty copies: ties by id
    bad = [(200, None), (220, [0.0] * 8), (240, [float("nan")] * 8), (260, [None] + [1.0] * 7), (280, [float("inf")] + [1.0] * 7), (300, [1.0, 2.0])]
    got = search(spark, good + bad)
    want = brute(good, 20)
    assert {q: [i for i, _ in x] for q, x in got.items()} == {q: [i for i, _ in x] for q, x in want.items()}
    assert all(abs(a[1] - b[1]) < 1e-12 for q in want for a, b in zip(got[q], want[q]))
    assert search(spark, good[:1]) == {} and search(spark, []) == {} and search(spark, bad) == {}
    assert [i for i, _ in search(spark, good[:3])[0]] == [i for i, _ in brute(good[:3], 20)[0]]


def test_ties_go_to_smaller_ids(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.integers(-2, 3, 6)]) for i in range(500)]  # one partition: nothing is missed
    rows = [(i, v) for i, v in rows if any(v)]
    assert search(spark, rows) == {q: [(i, s) for i, s in x] for q, x in brute(rows, 20).items()}
    q, x = np.array([v for _, v in rows[:50]]), np.array([v for _, v in rows])
    ids = np.stack([np.arange(len(x)), np.full(len(x), np.nan)], axis=1)
    one, two, score, _ = ann.best_pairs(q, np.full(50, np.nan), x, ids, 21)
    for r in range(50):
        want = sorted((-float((q[r] * v).sum()), i) for i, v in enumerate(x))[:21]
        assert [(-s, i) for i, s in zip(two[one == r], score[one == r])] == want


def test_repeated_ids_leave_room_for_others(spark):
    rng = np.random.default_rng(4)
    draw = lambda: [float(x) for x in np.float32(rng.standard_normal(6))]
    rows = [(i, draw()) for i in range(200)]
    rows += [(0, [9.0 * x for x in rows[0][1]])] + [(0, draw()) for _ in range(30)]  # one id in many classes
    rows += [(20, rows[20][1])] * 40 + [(21, rows[20][1])] * 3 + [(40, rows[60][1]), (60, rows[40][1])]  # in one class; two ids in both
    got = {}
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    for r in ann.search(table, F.col("vec_id") % 20 == 0, k=5).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    # an id of several rows asks once for each
    want = {}
    for q, v in rows:
        if q % 20 == 0:
            near = sorted((-float((np.array(v) * np.array(x)).sum()), i) for i, x in rows if i != q)[:5]
            want.setdefault(q, []).extend((n + 1, i, -s) for n, (s, i) in enumerate(near))
    assert set(got) == set(want)
    assert all([x[:2] for x in sorted(got[q])] == [x[:2] for x in sorted(want[q])] for q in want)


def test_recall_of_learned_partitions(spark):
    rng = np.random.default_rng(1)
    centres = rng.standard_normal((24, 16)) * 2
    rows = [(i, [float(x) for x in np.float32(centres[i % 24] + rng.standard_normal(16))]) for i in range(3000)]
    got, want = search(spark, rows, k=10), brute(rows, 10)
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.9 * 10 * len(want)


def test_balanced_cut():
    n = 64
    near = np.array([[(i + 1) % 32, (i + 2) % 32] if i < 32 else [32 + (i + 1) % 32, 32 + (i + 2) % 32] for i in range(n)])
    a, b = np.repeat(np.arange(n), 2), near.ravel()
    part = ann.balanced_cut(np.concatenate([a, b]), np.concatenate([b, a]), n, 2, np.random.default_rng(0))
    assert len(set(part[:32])) == 1 and len(set(part[32:])) == 1 and part[0] != part[40]
    four = ann.balanced_cut(np.concatenate([a, b]), np.concatenate([b, a]), n, 4, np.random.default_rng(0))
    assert np.bincount(four).tolist() == [16] * 4
