"""Rule tables compile to the same decisions in Spark and in SQL; first match wins."""

import duckdb
from pyspark.sql import functions as F

from ledgerline.operators import rules as R

NAMES = ["Habbie Telon 100 ml", "Habbie Telon 60 ml", "habbie telon widget", "Paramorina Madu x",
         "Vitabumin Madu 130 ring", "Vitabumin Madu 60", "Protabumin Careos 60 ml",
         "Protabumin Nutrimom", "Yayle bolt", "Cessa gear", "Lega", "GM. TP", "Gm.Md Banner",
         "Habbie Box Isi 3", "nothing", None]


def test_cogs_index_spark_equals_sql(spark):
    df = spark.createDataFrame([(n,) for n in NAMES], "nama STRING")
    got = [r[0] for r in df.select(R.cogs_rule_index(F.col("nama"))).collect()]
    con = duckdb.connect()
    want = [con.execute(f"SELECT {R.sql_cogs_rule_index('n')} FROM (SELECT ?::VARCHAR AS n)",
                        [n]).fetchall()[0][0] for n in NAMES]
    assert got == want
    # first match wins: "Habbie Telon 100 ml" is rule 1, not the later Habbie rules
    assert got[0] == 1 and got[1] == 10 and got[2] == 0 and got[-1] == 0


def test_fee_factor(spark):
    df = spark.createDataFrame([(n,) for n in NAMES], "nama STRING")
    with_fallback = [r[0] for r in df.select(R.tiktok_fee_factor(F.col("nama"), "0.1425")).collect()]
    no_fallback = [r[0] for r in df.select(R.tiktok_fee_factor(F.col("nama"), None)).collect()]
    assert float(with_fallback[0]) == 83.5          # Habbie 16.5 %
    assert float(with_fallback[4]) == 85.75         # Vitabumin Madu 130: 14.25 %
    assert float(with_fallback[6]) == 84.0          # Protabumin: 16 %
    assert float(with_fallback[14]) == 85.75        # no rule: fallback 14.25 %
    assert float(no_fallback[14]) == 0.0            # funnel report: amount 0


def test_packing_tiers(spark):
    qs = [0, 1, 3, 4, 10, 11, 39, 40, 60, 61, None]
    df = spark.createDataFrame([(q,) for q in qs], "q BIGINT")
    old = [r[0] for r in df.select(R.tier_cost(F.col("q"), R.PACKING_TIERS_DAILY_OLD)).collect()]
    new = [r[0] for r in df.select(R.tier_cost(F.col("q"), R.PACKING_TIERS_MONTHLY_NEW)).collect()]
    assert old == [0, 2000, 2000, 2800, 2800, 3000, 3000, 3000, 3000, 10000, 0]
    assert new == [0, 2000, 2000, 2000, 2000, 2000, 2000, 10000, 10000, 10000, 0]
