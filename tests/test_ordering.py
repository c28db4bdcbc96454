"""Positions without a one-task sort; sorted files."""

import random
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from ledgerline.operators.ordering import read_sorted, with_position, write_sorted
from ledgerline.params import ReportParams
from ledgerline.plans import reports as RP
from ledgerline.plans.registry import QUERIES, catalog_for

SF = "/root/testdata/sf0.001"


def test_positions_follow_the_order(spark):
    rng = random.Random(1)
    ids = [rng.randrange(10 ** 6) for _ in range(500)]
    rows = [(i, f"r{n}") for n, i in enumerate(set(ids))] + [(None, "last")]
    df = spark.createDataFrame(rows, "id bigint, other string").repartition(7)
    for desc in (False, True):
        down = lambda c: c.desc_nulls_first() if desc else c.asc_nulls_last()  # noqa: B023, E731
        got = with_position(df, [down(F.col("id"))], F.floor(F.col("id") / 1000), down).collect()
        want = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0), reverse=desc)
        assert [(r["id"], r["other"]) for r in sorted(got, key=lambda r: r["position"])] == want
        assert sorted(r["position"] for r in got) == list(range(1, len(rows) + 1))
    empty = with_position(df.limit(0), [F.col("id").asc()], F.col("id"), lambda c: c.asc())
    assert empty.count() == 0


def test_only_counts_meet_in_one_task(spark):
    """Above the days' shuffle nothing goes to a single partition but a row for each month, and
    ranks and counts read that shuffle once."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = QUERIES["order_desc_nulls_first"](spark, SF)._jdf.queryExecution() \
            .executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    lines = plan.split("\n")
    single = [i for i, line in enumerate(lines) if "Exchange SinglePartition" in line]
    assert len(single) == 1
    below = next(line for line in lines[single[0] + 1:] if "Aggregate" in line or "Window" in line)
    assert "HashAggregate" in below and "_span" in below
    assert "ReusedExchange" in plan


def test_sorted_files(spark, tmp_path):
    """File names ascend with the order, and positions are those of a sort."""
    cat, params = catalog_for(spark, SF), ReportParams.for_fixture()
    path = str(tmp_path / "report")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        RP.write_order_level(cat, params, path)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    got = read_sorted(spark, path).orderBy("position").collect()
    want = RP.order_level_positions(cat, params).orderBy("position").collect()
    assert [(r["id"], r["position"]) for r in got] == [(r["id"], r["position"]) for r in want]
    files = spark.read.parquet(path).groupBy(F.col("_metadata.file_name").alias("f")).agg(
        F.min("id").alias("a"), F.max("id").alias("b")).orderBy("f").collect()
    assert len(files) > 1 and all(x["b"] < y["a"] for x, y in zip(files, files[1:]))


@pytest.mark.parametrize("strict", [False, True])
def test_bad_shipping_cost(frames, strict):
    """A shipping cost that is no number is NULL and listed; the strict reports end."""
    from dataclasses import replace

    from ledgerline.functions.json_fields import rejected_fields
    from test_edge_cases import DIMS, PARAMS, order
    rows = [order(1, "SHOPEE", 10, id_mp=1, ongkir="1500"), order(2, "SHOPEE", 10, id_mp=2, ongkir="12rb"),
            order(3, "MANUAL", 10, id_mp=3, ongkir=""), order(4, "SHOPEE", 10, id_mp=4, ongkir=None),
            order(5, "SHOPEE", 10, id_mp=5, ongkir=" 7.5 "), order(6, "SHOPEE", 10, id_mp=6, ongkir=900)]
    broken = list(order(7, "SHOPEE", 10, id_mp=7))
    broken[-1], broken[-2] = "{not json", "[1, 2]"
    nulls = list(order(8, "SHOPEE", 10, id_mp=8))
    nulls[-1] = nulls[-2] = None
    cat = frames({**DIMS, "pesanan": [*rows, tuple(broken), tuple(nulls)],
                  "pesanan_pembentuk_harga_shopee": [(i, D(100), D(100), D(0), D(0)) for i in range(1, 9)]})
    params = replace(PARAMS, strict_json=strict)
    if strict:
        with pytest.raises(Exception, match="CAST_INVALID_INPUT|12rb"):
            RP.order_level_numeric(cat, params).collect()
        with pytest.raises(Exception, match="CAST_INVALID_INPUT|12rb"):
            RP.monthly_pnl(cat, params).collect()
        return
    cost = {r["id"]: r["ongkir"] for r in RP.order_level_numeric(cat, params).collect()}
    assert cost == {1: 1500.0, 2: None, 3: None, 4: None, 5: 7.5, 6: 900.0, 7: None, 8: None}
    assert [r["total_ongkir"] for r in RP.monthly_pnl(cat, params).collect()] == [2407.5]
    listed = sorted(tuple(r) for r in rejected_fields(cat["pesanan"]).drop("created_at").collect())
    assert listed == [(2, "data.ongkir", "12rb", "number"), (3, "data.ongkir", "", "number"),
                      (7, "customer", "[1, 2]", "json"), (7, "data", "{not json", "json")]
