from collections import Counter

import pytest
from pyspark.sql import functions as F

from ledgerline.llm import mixing as M


def brute_rake(cells, targets, sweeps=200):
    total = sum(cells.values())
    w = {k: v / total for k, v in cells.items()}
    for _ in range(sweeps):
        for d in range(3):
            sums = Counter()
            for k, v in w.items():
                sums[k[d]] += v
            w = {k: v * targets[d][k[d]] / sums[k[d]] for k, v in w.items()}
    return w


@pytest.mark.parametrize("in_one_task", [50_000, 0])
def test_rake_reaches_all_marginals(spark, monkeypatch, in_one_task):
    monkeypatch.setattr(M, "CELLS_A_TASK", in_one_task)
    cells = {("a", "x", "p"): 100, ("a", "y", "q"): 30, ("b", "x", "q"): 50, ("b", "y", "p"): 10,
             (None, "x", "p"): 5, (None, "y", "q"): 7}
    goals = ({"a": .3, "b": .5, None: .2}, {"x": .6, "y": .4}, {"p": .5, "q": .5})
    df = spark.createDataFrame([(*k, v) for k, v in cells.items()],
                               "source string, lang string, topic string, tokens bigint")
    tables = {d: spark.createDataFrame(list(g.items()), f"{d} string, target double")
              for d, g in zip(M.DIMENSIONS, goals)}
    got = {(r["source"], r["lang"], r["topic"]): r["weight"]
           for r in M.rake(df, tables, sweeps=40).collect()}
    want = brute_rake(cells, goals)
    assert got.keys() == want.keys()
    assert all(abs(got[k] - want[k]) < 1e-6 for k in want)
    for d, goal in enumerate(goals):
        for v, share in goal.items():
            assert abs(sum(w for k, w in got.items() if k[d] == v) - share) < 1e-6


def test_rate_spends_the_budget(spark):
    cells = spark.createDataFrame([(.5, .2), (.3, .3), (.2, .5)], "share double, weight double")
    for budget in (.1, .5, .9):
        k = M.calibrated_rate(cells, budget)
        spent = sum(s * min(1, k * w / s) for s, w in ((.5, .2), (.3, .3), (.2, .5)))
        assert abs(spent - budget) < 1e-9
    assert M.calibrated_rate(cells, 2.0) * .2 / .5 >= 1 - 1e-12


def test_sample_follows_probabilities(spark, documents):
    big = documents.crossJoin(spark.range(20)).withColumn("doc_id", F.col("doc_id") * 20 + F.col("id"))
    r = M.mix(big.drop("id")).agg(F.sum(F.col("probability") * F.col("n_tokens")),
                                  F.sum(F.when(F.col("sampled"), F.col("n_tokens"))),
                                  F.sum("n_tokens")).first()
    assert abs(r[0] / r[2] - 0.5) < 1e-6 and abs(r[1] / r[2] - 0.5) < 0.05


def test_odd_rows(odd, nothing):
    got = M.mix(odd)
    assert got.count() == odd.count()
    assert got.where("probability < 0 or probability > 1 or probability is null").count() == 0
    left = M.sampled(odd)
    assert left.columns == odd.columns and left.count() == got.where("sampled").count()
    assert M.mix(nothing).count() == 0 and M.sampled(nothing).count() == 0


def test_rake_goes_on_until_skewed_marginals_hold(spark):
    """Source nearly determines language and one source is hot: 12 sweeps leave marginals off."""
    cells = {(f"s{s}", f"l{v}", f"t{t}"): (100 if s == 0 else 1) * (200 if s == v else 1)
             * (1 + (s * 7 + v * 3 + t) % 5) for s in range(20) for v in range(20)
             for t in range(5)}
    df = spark.createDataFrame([(*k, n) for k, n in cells.items()],
                               "source string, lang string, topic string, tokens bigint")
    power, goals = (.5, .5, .8), []
    for d in range(3):
        sums = Counter()
        for k, n in cells.items():
            sums[k[d]] += n
        whole = sum(n ** power[d] for n in sums.values())
        goals.append({v: n ** power[d] / whole for v, n in sums.items()})
    rows = M.rake(df, dict(zip(M.DIMENSIONS, power))).collect()
    got = {(r["source"], r["lang"], r["topic"]): r["weight"] for r in rows}
    for d, goal in enumerate(goals):
        for v, share in goal.items():
            assert abs(sum(w for k, w in got.items() if k[d] == v) / share - 1) < 1e-8
    want = brute_rake(cells, goals)
    assert all(abs(got[k] - want[k]) < 1e-9 for k in want)
    assert max(r["error"] for r in rows) < 1e-8


def test_contradictory_targets_are_told(spark):
    df = spark.createDataFrame([("a", "x", "p", 5), ("b", "y", "p", 5)],
                               "source string, lang string, topic string, tokens bigint")
    goals = {"source": spark.createDataFrame([("a", .9), ("b", .1)], "source string, target double"),
             "lang": spark.createDataFrame([("x", .5), ("y", .5)], "lang string, target double"),
             "topic": 1.0}
    with pytest.warns(UserWarning, match="marginal is off"):
        rows = M.rake(df, goals).collect()
    assert {r["weight"] for r in rows} == {.5} and rows[0]["error"] > 0.1
