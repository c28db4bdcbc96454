import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import topk as T

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def brute(rows, k, step):
    vectors = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v in rows
               if i is not None and v is not None
               and all(x is not None and math.isfinite(x) for x in v)]
    out = set()
    for q, a in vectors:
        if q % step == 0:
            scores = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in vectors
                            if i != q and len(a) == len(b))[:k]
            out |= {(q, r + 1, i, -s) for r, (s, i) in enumerate(scores)}
    return out


def result(df):
    return {tuple(r) for r in df.select("query_id", "rank", "vec_id", "score").collect()}


def vectors(kind, n=400, dim=12, seed=2):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        v = [rng.gauss(0, 1) for _ in range(dim)]
        if kind == "lengths":
            f = 2.0 ** rng.randrange(-5, 5)
            v = [x * f for x in v]
        elif kind == "clusters":
            c = random.Random(i % 9)
            v = [5 * c.gauss(0, 1) + .1 * x for x in v]
        elif kind == "ties":
            v = [float(rng.randrange(2)) for _ in range(dim)] if rng.random() < .5 else [1.0] * dim
        out.append((i, v))
    return out


@pytest.mark.parametrize("kind", ["plain", "lengths", "clusters", "ties"])
def test_equals_brute_force(spark, monkeypatch, kind):
    monkeypatch.setattr(T, "BLOCK", 37)
    monkeypatch.setattr(T, "QUERY_BLOCK", 11)
    rows = vectors(kind)
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)
    assert result(T.top_k(df, F.col("vec_id") % 7 == 0)) == brute(rows, 5, 7)


def test_odd_vectors(spark):
    rows = [(0, [1.0, 2.0]), (1, None), (2, [1.0, None]), (3, [float("nan"), 1.0]),
            (4, [float("inf"), 1.0]), (5, [1.0, 2.0, 3.0]), (7, [-1.0, 0.5]), (8, [0.0, 0.0]),
            (None, [9.0, 9.0]), (50, [0.0, 0.0]), (100, []), (150, [3.0, -2.0, 1.0])]
    df = spark.createDataFrame([(i, v, None) for i, v in rows], SCHEMA) \
        .withColumn("dim", F.lit("x")).withColumn("raw", F.lit(1)).withColumn("score", F.lit(2))
    assert result(T.top_k(df, F.col("vec_id") % 50 == 0)) == brute(rows, 5, 50)
    assert T.top_k(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0
    with pytest.raises(Exception, match="too large"):
        T.top_k(spark.createDataFrame([(0, [1e30], 0), (1, [1.0], 0)], SCHEMA),
                F.col("vec_id") == 0).count()


def test_large_components_stay_exact():
    q, p = np.array([[2 ** 31 - 1] * 3]), np.array([[2 ** 31 - 1, -5, 1]])
    assert T._products(q, p).tolist() == [[(2 ** 31 - 1) * (2 ** 31 - 5)]]


def test_repeated_rows(spark):
    rows = [(0, [1.0]), (0, [1.0]), (1, [2.0]), (1, [2.0]), (2, [1.5])]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)
    got = sorted(result(T.top_k(df, F.col("vec_id") == 0)))
    assert got == [(0, 1, 1, 131072), (0, 2, 1, 131072), (0, 3, 2, 98304)]


def test_components_beyond_32_bits_stay(spark):
    """One very long vector is scored like any other; the other queries keep their results."""
    rows = [(0, [1.0, 2.0]), (50, [3.0, -1.0]), (1, [2e7, 1.0]), (2, [0.5, 0.5]), (3, [-3e7, 9e6])]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)
    assert result(T.top_k(df, F.col("vec_id") % 50 == 0)) == brute(rows, 5, 50)
