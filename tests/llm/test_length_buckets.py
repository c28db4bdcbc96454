import random
from collections import Counter
from itertools import combinations

from pyspark.sql import functions as F

from ledgerline.llm import length_buckets as B


def padding(histogram, ends):
    return sum(n * (min(e for e in ends if e >= length) - length) for length, n in histogram.items())


def test_boundaries_are_optimal():
    for seed in range(20):
        histogram = {(i * i * 7 + seed * 13) % 97 + 1: (i * 31 + seed) % 11 + 1 for i in range(11)}
        lengths = sorted(histogram)
        for k in (1, 2, 3, 4):
            got = B.optimal_boundaries(histogram, k)
            best = min(padding(histogram, [*some, lengths[-1]])
                       for some in combinations(lengths[:-1], k - 1))
            assert len(got) == k and got[-1] == lengths[-1]
            assert padding(histogram, got) == best
    assert B.optimal_boundaries({}, 3) == [] and B.optimal_boundaries({5: 2}, 3) == [5]


def test_batches(spark, documents, texts, sf_dir):
    from ledgerline.llm.queries import QUERIES
    rows = QUERIES["op8_packing"](spark, sf_dir).collect()
    assert {r["doc_id"]: r["n_tokens"] for r in rows} == \
        {i: len(t.split()) + 1 for i, t in texts.items()}
    histogram = Counter(r["n_tokens"] for r in rows)
    ends = B.optimal_boundaries(histogram, 8)
    assert sum(r["padding"] for r in rows) == padding(histogram, ends)
    batches = Counter((r["bucket"], r["cell"], r["batch"]) for r in rows)
    for r in rows:
        assert batches[r["bucket"], r["cell"], r["batch"]] <= max(1, 16384 // r["bucket_len"])
        assert 0 <= r["place"] < batches[r["bucket"], r["cell"], r["batch"]]
    assert len({(r["bucket"], r["cell"], r["batch"], r["place"]) for r in rows}) == len(rows)


def plain_boundaries(histogram, n_buckets):
    """Every cut of every layer tried; the earliest of equally good ones."""
    lengths = sorted(histogram)
    n = len(lengths)
    cost = lambda i, j: sum((lengths[j - 1] - x) * histogram[x] for x in lengths[i:j])
    best, back = [0] + [cost(0, j) for j in range(1, n + 1)], []
    for used in range(2, min(n_buckets, n) + 1):
        found = {j: min((best[i] + cost(i, j), i) for i in range(used - 1, j))
                 for j in range(used, n + 1)}
        best = [found[j][0] if j in found else best[j] for j in range(n + 1)]
        back.append({j: i for j, (_, i) in found.items()})
    ends, j = [], n
    for cut in reversed(back):
        ends.append(j)
        j = cut[j]
    return [lengths[e - 1] for e in reversed([*ends, j])]


def test_boundaries_equal_the_plain_programme_with_ties():
    rng = random.Random(3)
    for _ in range(150):
        top, most = rng.choice(((12, 2), (40, 5), (100_000, 50), (10 ** 12, 10 ** 9)))
        histogram = {rng.randrange(top): rng.randint(1, most) for _ in range(rng.randint(1, 30))}
        for k in (1, 2, 5, 8):
            assert B.optimal_boundaries(histogram, k) == plain_boundaries(histogram, k)


def test_boundaries_of_many_long_lengths():
    ends = B.optimal_boundaries({x: 1 for x in range(1, 100_001)}, 8)
    assert ends == [12500 * i for i in range(1, 9)]


def test_long_lengths_keep_their_own_bins(spark):
    df = spark.createDataFrame([(i, 3_000_001 + i // 3) for i in range(24)],
                               "doc_id bigint, n_tokens bigint")
    assert {r["padding"] for r in B.pack(df, n_buckets=8).collect()} == {0}


def test_hot_ids_are_split_over_cells(spark, monkeypatch):
    monkeypatch.setattr(B, "CELL_ROWS", 50)
    monkeypatch.setattr(B, "CELL_BATCHES", 2)
    ids = [None] * 1000 + [7] * 1000 + list(range(100, 1100))
    df = spark.createDataFrame([(i, 4000) for i in ids], "doc_id bigint, n_tokens bigint") \
        .repartition(8)
    rows = B.pack(df, n_buckets=2, budget=16000).collect()
    assert Counter(r["doc_id"] for r in rows) == Counter(ids)
    cells = Counter((r["bucket"], r["cell"]) for r in rows)
    assert max(cells.values()) <= 2 * 50 and len(cells) >= 60
    batches = Counter((r["bucket"], r["cell"], r["batch"]) for r in rows)
    assert max(batches.values()) == 4
    assert len({(r["bucket"], r["cell"], r["batch"], r["place"]) for r in rows}) == len(rows)


def test_cells_bound_a_bucket(spark, monkeypatch):
    monkeypatch.setattr(B, "CELL_ROWS", 10)
    monkeypatch.setattr(B, "CELL_BATCHES", 2)
    df = spark.range(500).select(F.col("id").alias("doc_id"), F.lit(8192).alias("n_tokens"))
    rows = B.pack(df, n_buckets=3).collect()
    assert max(Counter((r["bucket"], r["cell"]) for r in rows).values()) < 40
    assert max(Counter((r["cell"], r["batch"]) for r in rows).values()) == 2


def test_odd_rows(odd, nothing):
    lengths = odd.withColumn("n_tokens", B.word_count(F.col("text")))
    got = B.pack(lengths)
    assert got.count() == odd.count()
    assert got.where("padding < 0 or n_tokens is null").count() == 0
    assert B.pack(nothing.withColumn("n_tokens", F.lit(1))).count() == 0
    longest = got.orderBy(F.desc("n_tokens")).first()
    assert longest["n_tokens"] == 40000
