"""
their different rules call for."""

import datetime as dt
import json
from decimal import Decimal as D

from pyspark.sql import functions as F

from ledgerline.operators import costs as C
from ledgerline.operators import rules as R
from ledgerline.operators.orders import clean_orders
from ledgerline.params import ReportParams, ShopCodes
from ledgerline.plans import reports as RP

CODES = ShopCodes()
P5 = ReportParams(date_from=dt.date(2025, 6, 1), date_to=dt.date(2025, 6, 30),
                  as_of=dt.date(2026, 2, 15), codes=CODES)
DIMS = {"gudang": [(1, "G1")], "toko": [(1, "TOKO A"), (221, "TOKO RIVA"), (232, "TOKO B")],
        "users_omni": [(1, "someone")]}


def order(id_, mp, harga, ts, toko=1, nama="Budi", id_mp=None):
    return (id_, toko, mp, ts, 1, id_mp if id_mp is not None else id_, D(str(harga)), 1,
            "SELESAI", json.dumps({"nama": nama, "tipe": "UMUM"}),
            json.dumps({"platform": "OFFLINE", "ongkir": "0"}))


def test_d3_settlement_gross_in_order_level_net_in_shop_day(frames):
    ts = dt.datetime(2025, 6, 10)
    cat = frames({**DIMS, "pesanan": [order(1, "TIKTOK_SHOP", 100, ts, id_mp=77)],
                  "pesanan_pembentuk_harga_tiktok_shop": [(1, D("100"), D("100"), D("0"))],
                  "pesanan_detail": [(10, 1)], "pesanan_detail_sku": [(10, "Cessa", 1)],
                  "tiktok_pencairan": [(77, D("100"), 1, None, None)]})
    r5 = RP.order_level_numeric(cat, P5).collect()[0]
    r7 = [r for r in RP.shop_day_tiktok(cat, P5).collect() if r.toko_id == 1][0]
    assert r5.omni == 100.0                      # settlement kept gross
    assert r7.total_omni == 90.09                # 100 * 100 / 111


def test_d4_d5_unit_costs_and_dated_surcharge(frames):
    before, after = dt.datetime(2025, 12, 31, 12), dt.datetime(2026, 1, 2, 12)
    rows = [order(1, "SHOPEE", 10, before), order(2, "SHOPEE", 10, after, toko=232),
            order(3, "SHOPEE", 10, after)]
    cat = frames({**DIMS, "pesanan": rows, "pesanan_detail": [(10, 1), (20, 2), (30, 3)],
                  "pesanan_detail_sku": [(10, "Protabumin Careos", 1),
                                         (20, "Protabumin Careos", 1),
                                         (30, "Protabumin Careos", 1)]})
    daily = {(r.toko, r.tanggal): r.hpp_num for r in C.cogs_by_shop_day(cat, P5).collect()}
    per_day = {k[1]: float(v) / 111 for k, v in daily.items() if k[0] in (1, 232)}
    # placeholder unit 1000 net of VAT plus the dated surcharge (7500 before, 18000 at the
    # special shop after the switch, 7000 elsewhere)
    assert round(per_day[dt.date(2025, 12, 31)], 2) == round(1000 * 100 / 111 + 7500, 2)
    shop232 = [float(v) / 111 for k, v in daily.items() if k[0] == 232][0]
    shop1_after = [float(v) / 111 for k, v in daily.items()
                   if k[0] == 1 and k[1] == dt.date(2026, 1, 2)][0]
    assert round(shop232, 2) == round(1000 * 100 / 111 + 18000, 2)
    assert round(shop1_after, 2) == round(1000 * 100 / 111 + 7000, 2)
    # the order-level report uses the real unit price and a fixed surcharge
    p = ReportParams(date_from=dt.date(2026, 1, 1), date_to=dt.date(2026, 1, 31),
                     as_of=dt.date(2026, 2, 15), codes=CODES)
    r5 = {r.id: r.hpp for r in RP.order_level_numeric(cat, p).collect()}
    assert r5[2] == round(63300 * 100 / 111 + 7500, 2)


def test_d6_packing_tiers_per_report(spark):
    df = spark.createDataFrame([(5,)], "q BIGINT")
    q = F.col("q")
    got = df.select(R.tier_cost(q, R.PACKING_TIERS_ORDER_LEVEL).alias("r5"),
                    R.tier_cost(q, R.PACKING_TIERS_MONTHLY_OLD).alias("r3_old"),
                    R.tier_cost(q, R.PACKING_TIERS_MONTHLY_NEW).alias("r3_new"),
                    R.tier_cost(q, R.PACKING_TIERS_DAILY_OLD).alias("daily_old"),
                    R.tier_cost(q, R.PACKING_TIERS_DAILY_NEW).alias("daily_new")).collect()[0]
    assert tuple(got) == (2800, 3000, 2000, 2800, 1000)


def test_d9_kiriminaja_is_manual_only_in_the_monthly_report(frames):
    ts = dt.datetime(2025, 6, 10)
    rows = [order(1, "KIRIMINAJA", 10, ts, toko=221, nama="Gudang Pusat")]
    cat = frames({**DIMS, "pesanan": rows})
    monthly = ReportParams(date_from=dt.date(2025, 6, 1), date_to=dt.date(2025, 6, 30),
                           as_of=dt.date(2026, 2, 15), codes=CODES)
    assert clean_orders(cat, P5, "order_level").count() == 1      # not MANUAL: no name test
    assert clean_orders(cat, monthly, "monthly").count() == 0     # treated like MANUAL


def test_d10_roas_credit_cutoff_only_in_the_monthly_report(frames):
    early = dt.datetime(2026, 3, 1, 9)
    cat = frames({"tiktok_proteksi_roas": [(early, 1, D("40"))]})
    monthly = {r.periode: r.total_iklan for r in C.ad_spend_by_period(cat).collect()}
    daily = C.tiktok_ads_by_day(cat).collect()
    assert monthly == {}                                          # before 2026-03-24: left out
    assert [float(r.total_iklan) for r in daily] == [-40.0]      # the shop-day report keeps it
