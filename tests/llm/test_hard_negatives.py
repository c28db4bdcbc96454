import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import hard_negatives as H

from .test_topk import vectors

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def brute(rows, step, n_pos=5, n_neg=10):
    """{(anchor, positive rank, positive, rank, negative, positive score, negative score)}."""
    rows = [(i, [math.floor(256 * float(np.float32(x))) for x in v], c) for i, v, c in rows
            if i is not None and v is not None and c is not None
            and all(x is not None and math.isfinite(x) for x in v)]
    out, done = set(), set()
    for q, a, label in sorted(rows, key=lambda r: (r[0], r[2])):
        if q % step or q in done:
            continue
        done.add(q)
        scores = sorted((-sum(x * y for x, y in zip(a, b)), i, c) for i, b, c in rows
                        if len(a) == len(b))
        best = [(-s, i) for s, i, c in scores if c == label and i != q][:n_pos]
        for r, (p, i) in enumerate(best):
            fit = [(-s, j) for s, j, c in scores if c != label and 30 * p <= -100 * s <= 90 * p]
            out |= {(q, r + 1, i, t + 1, j, p, s) for t, (s, j) in enumerate(fit[:n_neg])}
    return out


def result(df):
    return {tuple(r) for r in df.select("anchor_id", "positive_rank", "positive_id", "rank",
                                        "negative_id", "positive_score", "negative_score").collect()}


def small(monkeypatch):
    for name, v in (("BLOCK", 37), ("CHUNK", 6), ("STEP", 4), ("CENTRES", 5), ("FIT", 30)):
        monkeypatch.setattr(H, name, v)


@pytest.mark.parametrize("kind", ["plain", "lengths", "clusters", "ties"])
def test_equals_brute_force(spark, monkeypatch, kind):
    small(monkeypatch)
    rows = [(i, v, i % 4 if i % 5 else 0) for i, v in vectors(kind)]
    got = result(H.mine(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 6 == 0))
    assert got == brute(rows, 6) and len(got) > 1000


def test_walk_ends_early():
    """Members stop where the shared list can no longer change their results."""
    rng = np.random.default_rng(4)
    x = np.floor(256 * rng.normal(size=(3000, 16)) * rng.exponential(size=(3000, 1)) ** 3)
    q = x[:8] + np.floor(rng.normal(size=(8, 16)))
    members = {"vec_id": np.arange(8), "label": np.zeros(8, int), "length": H._length(q)}
    seen = []

    class Fixed(H.Chunk):
        def __init__(self):
            self.ids, self.labels, self.x, self.lengths = *(members[k] for k in ("vec_id", "label")), q, members["length"]
            self.centre = H._unit(q.sum(axis=0)[None])[0]
            self.radius = float(H._angles(H._unit(q), self.centre).max())
            self.member, self.slot = np.arange(8), np.zeros(8, int)
            self.low = np.array([-np.inf] * 8, dtype=object)
            self.high = np.array([np.inf] * 8, dtype=object)

    made = H._products
    H._products = lambda a, b: seen.append(a.shape[0] * b.shape[0]) or made(a, b)
    try:
        a, _, i, s = Fixed().walk(np.arange(100, 3100), np.zeros(3000, int), x, True, 5)
    finally:
        H._products = made
    scores = (q @ x.T).astype(int)
    for m in range(8):
        best = sorted((-v, j + 100) for j, v in enumerate(scores[m]))[:5]
        assert sorted((-v, j) for k, j, v in zip(a, i, s) if k == m) == best
    assert sum(seen) < 0.6 * 8 * 3000


def test_odd_vectors(spark, monkeypatch):
    small(monkeypatch)
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0], 1), (1, [2.0, 1.0], 1), (2, [.5, 1.0], 2), (3, [.5, .5], None),
            (4, None, 1), (5, [1.0, None], 2), (6, [nan, 1.0], 2), (7, [inf, 1.0], 2),
            (8, [1.0, 2.0, 3.0], 1), (10, [1.0, 2.0, 2.0], 1), (11, [.5, 1.0, 1.0], 3),
            (20, [0.0, 0.0], 1), (21, [0.0, 0.0], 2), (30, [], 1), (31, [], 2), (33, [], 1),
            (40, [-1.0, -2.0], 1), (50, [3.0, 3.0], 9), (None, [1.0, 1.0], 2),
            (12, [.5, 1.0], 2), (13, [.5, 1.0], 2), (13, [.5, 1.0], 2)]
    df = spark.createDataFrame(rows, SCHEMA)
    for c in ("dim", "raw", "score", "cell", "slot", "anchor_id", "rank", "v", "draw", "_x"):
        df = df.withColumn(c, F.lit("x"))
    got = result(H.mine(df, F.col("vec_id") % 10 == 0))
    assert got == brute(rows, 10) and got
    assert H.mine(df.limit(0), F.col("vec_id") % 10 == 0).count() == 0
    assert H.mine(df, F.col("vec_id") == 999).count() == 0


def test_large_components(spark):
    """Components beyond 32 bits stay, and their scores are exact."""
    rows = [(0, [1.0, 3e6], 1), (1, [5.0, 4e6], 1), (2, [1e7, 2e6], 2), (3, [0.0, 1.5e6], 2),
            (4, [0.0, 2.0], 3)]
    got = result(H.mine(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") == 0))
    assert got == {r for r in brute(rows, 5)} and got
    assert H._products(np.array([[2.0 ** 70, 1]]), np.array([[3.0, 1]])).tolist() == [[3 * 2 ** 70 + 1]]
    with pytest.raises(Exception, match="64 bits"):
        H.mine(spark.createDataFrame([(0, [1e30], 0), (1, [1e30], 0)], SCHEMA),
               F.col("vec_id") == 0).count()


def test_one_common_vector(spark, monkeypatch):
    """A third of all rows are one vector, under few ids."""
    small(monkeypatch)
    rows = [(i, v, i % 3) for i, v in vectors("plain", 120)]
    rows += [(500 + i % 5, rows[6][1], i % 2) for i in range(60)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = H.mine(df, F.col("vec_id") % 6 == 0)
    assert result(got) == brute(rows, 6)
