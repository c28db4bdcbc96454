"""Signed batches: distinct sums and survivors equal those of the rows that are there."""

import random

from pyspark.sql import functions as F

from ledgerline.streaming import maintained as MT

ROWS = "k bigint, turn int, id bigint, amount decimal(18,2)"


def test_any_split_into_batches(spark, tmp_path):
    """Inserts, deletes, updates, repeated rows, a NULL key, deletes before inserts, a batch that
    is applied twice, and one key with most rows."""
    from decimal import Decimal as D
    rng = random.Random(6)
    there, batches = [], []
    pool = [(rng.choice([None, 1, 1, 1, 1, 2, 3]), rng.randrange(1, 4), i, D(rng.randrange(5)))
            for i in range(120)]
    for _ in range(4):
        new = [rng.choice(pool) for _ in range(60)]
        gone = [there.pop(rng.randrange(len(there))) for _ in range(min(len(there), 25))]
        there += new
        batches.append((new, gone))
    df = lambda rows: spark.createDataFrame(rows, ROWS)
    state = MT.MultisetState(spark, f"file:{tmp_path}/state")
    order = list(enumerate(batches))
    rng.shuffle(order)                                   # deletes may come before their inserts
    for n, (new, gone) in order:
        assert state.apply(f"b{n}", df(new), df(gone) if gone else None)
        assert not state.apply(f"b{n}", df(new))         # again: nothing happens
    assert state.batches() == ["b0", "b1", "b2", "b3"]
    now = state.current()
    got = {r["k"]: r["s"] for r in MT.distinct_sums(now, ["k"], "amount", "s").collect()}
    assert got == {k: sum({r[3] for r in there if r[0] == k}) for k in {r[0] for r in there}}
    kept = MT.survivors(now.drop(MT.COUNT), "k", [F.col("turn"), F.col("id"), F.col("amount")])
    best = {k: min((r[1], r[2], r[3]) for r in there if r[0] == k) for k in {r[0] for r in there}}
    assert {r["k"]: (r["turn"], r["id"], r["amount"]) for r in kept.collect()} == best
    whole = state.compact(f"file:{tmp_path}/compact")
    assert sorted(map(str, whole.current().collect())) == sorted(map(str, now.collect()))
    assert "WindowGroupLimit" in kept._jdf.queryExecution().executedPlan().toString()


def test_survivor_gives_way(spark, tmp_path):
    """The surviving copy changes its turn, then leaves."""
    from decimal import Decimal as D
    df = lambda *rows: spark.createDataFrame(rows, ROWS)
    state = MT.MultisetState(spark, f"file:{tmp_path}/state")
    first, second = (7, 1, 10, D(5)), (7, 2, 11, D(6))

    def kept():
        return [r["id"] for r in MT.survivors(state.current(), "k", [F.col("turn"), F.col("id")]).collect()]
    state.apply("a", df(first, second))
    assert kept() == [10]
    state.apply("b", df((7, 3, 10, D(0))), df(first))
    assert kept() == [11]
    state.apply("c", None, df(second))
    assert kept() == [10]
