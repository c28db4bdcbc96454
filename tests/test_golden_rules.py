"""Expected amounts typed by hand, independent of the rule tables (both the Spark plans and the
oracle SQL compile those)."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import costs as C
from ledgerline.operators import rules as R
from ledgerline.operators.orders import cogs_numerator, sku_order_vector

# product, net cost of goods of one unit at order level (times 111), TikTok share kept (times 100)
PRODUCTS = [
    ("Habbie Telon 100 ml", 3100000, "83.5"),
    ("Paramorina Madu", 2997000 + 500 * 111, "85.75"),
    ("Paramorina Tetes", 2997000 + 500 * 111, "85.75"),
    ("Vitabumin Madu 130", 2997000, "85.75"),
    ("Vitabumin Madu 60", 1776000, "84"),
    ("Protabumin Careos 60 ml", 6330000 + 7500 * 111, "84"),
    ("Protabumin Nutrimom", 4330000 + 5500 * 111, "84"),
    ("Yayle", 22500 * 111, "85.75"),
    ("Habbie MKP", 3500000, "83.5"),
    ("Habbie Telon 60 ml", 2320000, "83.5"),
    ("GM. TP", 490000, "85.75"),
    ("Habbie Tester", 870000, "83.5"),
    ("Gm.Md Banner", 1600000, "85.75"),
    ("Habbie Box Isi 3", 2000000, "83.5"),
    ("Habbie Box Isi 5", 2100000, "83.5"),
    ("Cessa", 2700000, "85.75"),
    ("Lega", 1850000, "85.75"),
    ("anything else", 0, "85.75"),
]


@pytest.fixture()
def shop(frames):
    return frames({
        "pesanan_detail": [(i, i) for i in range(len(PRODUCTS))],
        "pesanan_detail_sku": [(i, name, 2) for i, (name, _, _) in enumerate(PRODUCTS)]})


def test_unit_costs_and_fees(shop):
    rows = {r["pesanan_id"]: r for r in sku_order_vector(
        shop, R.COGS_ORDER_LEVEL, "0.1425").withColumn("n", cogs_numerator()).collect()}
    for i, (name, cost, kept) in enumerate(PRODUCTS):
        assert rows[i]["n"] == 2 * cost, name
        assert rows[i]["fee_max"] == rows[i]["fee_min"] == Decimal(kept), name
        assert rows[i]["total_qty"] == 2


# product, date, shop is special, surcharge of one unit; the unit itself costs 1000 gross of VAT
DATED = [("Protabumin Careos", "2025-12-31", True, 7500), ("Protabumin Careos", "2026-01-01", True, 18000),
         ("Protabumin Careos", "2026-01-01", False, 7000), ("Protabumin Nutrimom", "2025-12-31", False, 5500),
         ("Protabumin Nutrimom", "2026-01-01", True, 12500), ("Protabumin Nutrimom", "2026-06-01", False, 5000),
         ("Habbie Telon 100 ml", "2026-06-01", True, 0)]


def test_dated_surcharge(spark, frames):
    cat = frames({"pesanan_detail": [(i, i) for i in range(len(DATED))],
                  "pesanan_detail_sku": [(i, d[0], 3) for i, d in enumerate(DATED)]})
    orders = spark.createDataFrame([(i, d[1], 3 if d[2] else 4) for i, d in enumerate(DATED)],
                                   "id bigint, day string, toko_id int") \
        .withColumn("created_at", F.col("day").cast("timestamp"))
    rows = C.with_vector(cat, orders, R.COGS_PLACEHOLDER_DATED) \
        .select("id", C.cogs_num_dated(3).alias("n")).collect()
    for r in rows:
        assert r["n"] == 3 * (1000 * 100 + DATED[r["id"]][3] * 111), DATED[r["id"]]


# quantity -> order level; monthly before and from 2026-04-01; daily before and from 2026-04-01
PACKING = {0: (0, 0, 0, 0, 0), 1: (2300, 2000, 2000, 2000, 1000), 3: (2300, 2000, 2000, 2000, 1000),
           4: (2800, 3000, 2000, 2800, 1000), 10: (2800, 3000, 2000, 2800, 1000),
           11: (7400, 10000, 2000, 3000, 1000), 39: (7400, 10000, 2000, 3000, 1000),
           40: (7400, 10000, 10000, 3000, 1000), 60: (7400, 10000, 10000, 3000, 1000),
           61: (11400, 12000, 10000, 10000, 1000)}


def test_packing_tiers(spark):
    df = spark.createDataFrame([(q,) for q in PACKING], "q bigint")
    day = lambda s: F.lit(s).cast("timestamp")
    monthly = (R.PACKING_TIERS_MONTHLY_OLD, R.PACKING_TIERS_MONTHLY_NEW)
    daily = (R.PACKING_TIERS_DAILY_OLD, R.PACKING_TIERS_DAILY_NEW)
    q = F.col("q")
    rows = df.select("q", R.tier_cost(q, R.PACKING_TIERS_ORDER_LEVEL),
                     C.packing_cost(q, day("2026-03-31"), *monthly),
                     C.packing_cost(q, day("2026-04-01"), *monthly),
                     C.packing_cost(q, day("2026-03-31"), *daily),
                     C.packing_cost(q, day("2026-04-01"), *daily)).collect()
    assert {r[0]: tuple(r)[1:] for r in rows} == PACKING


def test_budget_and_sample_rates(spark):
    df = spark.createDataFrame([("x PROTABUMIN nutrimom",), ("Protabumin Careos 60",), ("Yayle",)], "n string")
    rows = df.select(R.rate_per_unit(F.col("n"), R.BUDGET_RATES),
                     R.rate_per_unit(F.col("n"), R.SAMPLE_RATES)).collect()
    assert [tuple(r) for r in rows] == [(5000, 65000), (7000, 85000), (0, 0)]


def test_nakama_customers_leave_the_june_matrix_only(frames):
    import datetime as dt

    from test_edge_cases import PARAMS, order

    from ledgerline.operators.marketing import budget_by_product_month
    rows = [order(i, "MANUAL", 10, id_mp=i, nama=name, ts=dt.datetime(2025, month, 5))
            for i, month, name in ((1, 6, "Nakama A"), (2, 6, "B"), (3, 7, "Nakama A"))]
    cat = frames({"pesanan": rows, "pesanan_detail": [(i, i) for i in (1, 2, 3)],
                  "pesanan_detail_sku": [(i, "Protabumin Careos", 1) for i in (1, 2, 3)]})
    got = {r["bulan"]: int(r["total_biaya"])
           for r in budget_by_product_month(cat, PARAMS).collect()}
    assert got == {6: 7000, 7: 7000}


def test_sample_stores(frames):
    import datetime as dt

    from test_edge_cases import PARAMS, order

    from ledgerline.operators.marketing import budget_and_samples
    at = dt.datetime(2025, 6, 5)
    rows = [order(1, "MANUAL", 10, toko=221, tipe="ENDORSE", nama_toko="Protabumin Official Shop", ts=at),
            order(2, "MANUAL", 10, toko=221, tipe="ENDORSE", nama_toko="ProtabuminOfficial", ts=at),
            order(3, "MANUAL", 10, toko=363, nama_toko="x", ts=at),
            order(4, "MANUAL", 10, toko=1, tipe="ENDORSE", nama_toko="Protabumin Official Shop", ts=at)]
    cat = frames({"pesanan": rows, "pesanan_detail": [(i, i) for i in (1, 2, 3, 4)],
                  "pesanan_detail_sku": [(1, "Protabumin Careos", 1), (2, "Protabumin Nutrimom", 2),
                                         (3, "Protabumin Careos", 3), (4, "Protabumin Careos", 9)]})
    r = budget_and_samples(cat, PARAMS).first()
    assert (int(r["s"]), int(r["t"])) == (85000, 2 * 65000 + 3 * 85000)


def test_several_price_rows_of_one_order(frames):
    """Two different TikTok price rows and one that repeats: each different one counts."""
    from test_edge_cases import order

    from ledgerline.operators.orders import TiktokRevenueRule, order_fact
    price = lambda p, s: (1, Decimal(p), Decimal(p), Decimal(s))
    cat = frames({"pesanan": [order(1, "TIKTOK_SHOP", 10, id_mp=7)], "pesanan_detail": [(1, 1)],
                  "pesanan_detail_sku": [(1, "Cessa", 1), (1, "Habbie MKP", 1)],
                  "pesanan_pembentuk_harga_tiktok_shop": [price(1000, 100), price(1000, 100),
                                                          price(500, 0)]})
    o = cat["pesanan"].select("id", "id_marketplace", "marketplace")
    r = order_fact(cat, o, R.COGS_ORDER_LEVEL, TiktokRevenueRule(),
                   F.col("marketplace") == R.TIKTOK).first()
    assert r["tt_omni_num"] == (900 + 500) * Decimal("85.75") and r["tt_fat_num"] == 140000
    low = order_fact(cat, o, R.COGS_ORDER_LEVEL, TiktokRevenueRule(per_order="min"),
                     F.col("marketplace") == R.TIKTOK).first()
    assert low["tt_omni_num"] == 500 * Decimal("85.75")
