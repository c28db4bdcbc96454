"""Hand-made rows for cases the synthetic data does not reach (FIXTURES.md section 2)."""

import datetime as dt
import json
from decimal import Decimal

from pyspark.sql import functions as F

from ledgerline.operators import costs as C
from ledgerline.operators import marketing as M
from ledgerline.operators import rules as R
from ledgerline.operators.orders import clean_orders
from ledgerline.operators.revenue import settlement_per_order, tiktok_order_revenue
from ledgerline.params import ReportParams, ShopCodes, add_months
from ledgerline.plans import reports as RP

D = Decimal
TS = dt.datetime(2025, 6, 10, 12, 0)
PARAMS = ReportParams(date_from=dt.date(2025, 6, 1), date_to=dt.date(2025, 6, 30),
                      as_of=dt.date(2026, 2, 15), codes=ShopCodes())
DIMS = {"gudang": [(1, "G1")], "toko": [(1, "TOKO A"), (221, "TOKO RIVA")],
        "users_omni": [(1, "someone")]}


def order(id_, mp, harga, id_mp=None, toko=1, status="SELESAI", nama="Budi", tipe="UMUM",
          nama_toko=None, platform="OFFLINE", ongkir="1000", ts=TS):
    cust = {k: v for k, v in (("nama", nama), ("tipe", tipe), ("nama_toko", nama_toko))
            if v is not None}
    data = {k: v for k, v in (("platform", platform), ("ongkir", ongkir)) if v is not None}
    return (id_, toko, mp, ts, 1, id_mp, None if harga is None else D(str(harga)), 1, status,
            json.dumps(cust), json.dumps(data))


def survivors(frames, rows):
    cat = frames({**DIMS, "pesanan": rows})
    return sorted(r.id for r in clean_orders(cat, PARAMS, "order_level").collect())


def test_null_marketplace_ids_keep_one(frames):
    rows = [order(i, "SHOPEE", 10, id_mp=None) for i in (3, 1, 2)]
    assert survivors(frames, rows) == [1]


def test_manual_copy_wins_over_unpriced_marketplace_copy(frames):
    rows = [order(1, "SHOPEE", 0, id_mp=7), order(2, "MANUAL", 10, id_mp=7)]
    assert survivors(frames, rows) == [2]


def test_tie_goes_to_lowest_id(frames):
    rows = [order(6, "SHOPEE", 10, id_mp=7), order(5, "TIKTOK_SHOP", 10, id_mp=7)]
    assert survivors(frames, rows) == [5]


def test_null_price_loses_to_priced_manual(frames):
    rows = [order(1, "SHOPEE", None, id_mp=7), order(2, "MANUAL", 10, id_mp=7)]
    assert survivors(frames, rows) == [2]


def test_missing_customer_name_three_valued(frames):
    # MANUAL without a name: at the warehouse shop the exclusion is NULL -> dropped; elsewhere kept
    rows = [order(1, "MANUAL", 10, id_mp=1, toko=221, nama=None),
            order(2, "MANUAL", 10, id_mp=2, toko=1, nama=None),
            order(3, "MANUAL", 10, id_mp=3, toko=221, nama="Gudang Pusat")]
    assert survivors(frames, rows) == [2]


def test_settlement_distinct_and_plain(frames):
    cat = frames({"tiktok_pencairan": [(9, D("100"), 1, None, None), (9, D("100"), 1, None, None),
                                       (9, D("50"), 1, None, None)]})
    assert settlement_per_order(cat, True).collect()[0].settlement == D("150")
    assert settlement_per_order(cat, False).collect()[0].settlement == D("250")


def test_tiktok_fee_fallback_per_report(frames):
    cat = frames({"pesanan": [order(1, "TIKTOK_SHOP", 1000, id_mp=5)],
                  "pesanan_pembentuk_harga_tiktok_shop": [(1, D("1000"), D("1000"), D("0"))],
                  "pesanan_detail": [(10, 1)],
                  "pesanan_detail_sku": [(10, "unknown product", 1)]})
    o = cat["pesanan"].select("id", "id_marketplace")
    elsewhere = tiktok_order_revenue(cat, o, R.TIKTOK_FEE_FALLBACK, None).collect()[0]
    funnel = tiktok_order_revenue(cat, o, None, None).collect()[0]
    assert elsewhere.omni_num == D("85750.0000")   # 1000 * (1 - 0.1425) * 100
    assert funnel.omni_num == 0


def test_first_cogs_rule_wins(spark):
    df = spark.createDataFrame([("Protabumin Careos Cessa",)], "n STRING")
    assert df.select(R.cogs_rule_index(F.col("n"))).collect()[0][0] == 6


def test_packing_switch_date(frames):
    rows = [order(1, "SHOPEE", 10, id_mp=1, ts=dt.datetime(2026, 3, 31, 23, 0)),
            order(2, "SHOPEE", 10, id_mp=2, ts=dt.datetime(2026, 4, 1, 0, 0))]
    cat = frames({"pesanan": rows, "pesanan_detail": [(10, 1), (20, 2)],
                  "pesanan_detail_sku": [(10, "Cessa", 3), (20, "Cessa", 3)]})
    got = {r.tanggal: r.total_packing for r in C.packing_by_shop_day(cat).collect()}
    assert got == {dt.date(2026, 3, 31): 2000, dt.date(2026, 4, 1): 1000}


def test_day_one_prorata_differs(frames):
    cat = frames({"beban": [(1, 1, "LIVE", 2026, 3, D("3100"))], "beban_toko": [(1, 1)],
                  "kelontong": [(dt.date(2026, 3, 5), 1, D("3100"))]})
    as_of = dt.date(2026, 3, 1)
    b = C.overhead_by_period(cat, as_of).collect()[0]
    rc = C.ratecard_by_period(cat, as_of).collect()[0]
    assert b.beban_num == 0                                   # (1 - 1) / 31
    assert rc.rc_num / rc.rc_den == D("3100") * 28 / 31       # day(2026-02-28) / 31


def test_prior_window_clamps_month_end():
    p = PARAMS.with_window(dt.date(2025, 3, 1), dt.date(2025, 3, 31))
    assert p.prior_month_bounds() == (dt.date(2025, 2, 1), dt.date(2025, 3, 1))
    assert add_months(dt.date(2025, 3, 31), -1) == dt.date(2025, 2, 28)
    assert p.previous_calendar_month() == (dt.date(2025, 2, 1), dt.date(2025, 3, 1))


def test_null_shop_rows_stay_apart(frames):
    d = dt.date(2025, 6, 1)
    cat = frames({"tiktok_ads_manager": [(d, None, D("5"))],
                  "tiktok_iklan_gmv_max": [(d, None, D("7"))],
                  "tiktok_iklan_booster": [(d, 3, D("1"))]})
    rows = C.tiktok_ads_by_day(cat).collect()
    nulls = sorted(float(r.total_iklan) for r in rows if r.toko_id is None)
    assert nulls == [5.0, 7.0] and len(rows) == 3


def test_rounded_ad_source_half_away(frames):
    d = dt.date(2025, 6, 1)
    cat = frames({"shopee_iklan_toko": [(d, 1, D("0.25")), (d, 1, D("0.25")),
                                        (dt.date(2025, 7, 1), 1, D("-0.50"))]})
    got = {r.periode: r.total_iklan for r in C.ad_spend_by_period(cat).collect()}
    assert got == {"2025-06": D("1.00"), "2025-07": D("-1.00")}


def test_funnel_null_propagation(frames):
    d = dt.date(2025, 6, 2)
    cat = frames({"sheet2_kol_ig": [(d, 10, 1, None, 1, 2), (d, 20, 1, 1, 1, 3)],
                  "sheet2_internal": [(d, 5, None, 1, None, None, None, None, None, None)]})
    t = M.funnel_totals(cat, PARAMS).collect()[0]
    assert (t.kol_awareness, t.kol_interest, t.kol_desire) == (30, 3, 5)   # NULL like: no interest
    assert (t.internal_awareness, t.internal_interest, t.internal_desire) == (5, 1, 0)  # NULL as 0
    assert (t.am_awareness, t.am_interest, t.am_desire) == (0, 0, 0)       # empty group gives 0


def test_affiliate_with_repeated_and_null_rows(frames):
    part = lambda id_, fee: (id_, None, None, None, None if fee is None else D(fee))
    cat = frames({
        "pesanan": [order(1, "SHOPEE", 10), order(1, "SHOPEE", 10), order(2, "MANUAL", 10, toko=2),
                    order(3, "SHOPEE", 10, toko=None), order(4, "SHOPEE", 10, toko=4),
                    order(None, "SHOPEE", 10, toko=5)],
        "pesanan_pembentuk_harga_shopee": [part(1, "1.50"), part(1, "2.00"), part(1, None),
                                           part(2, None), part(3, "4"), part(None, "9"),
                                           part(99, "9")],
        "shopee_iklan": [(TS.date(), 1, D("5")), (TS.date(), None, D("6"))]})
    got = sorted((r.toko or 0, r.tanggal, r.total_iklan, r.total_aff)
                 for r in C.shopee_ads_and_affiliate(cat).collect())
    day = TS.date()
    assert got == [(0, day, 0, 4), (0, day, 6, 0), (1, day, 5, 7), (2, day, 0, 0)]


def large_funnel(frames):
    d = dt.date(2025, 6, 2)
    return frames({"sheet2_kol_ig": [(d, 10 ** 9, 8 * 10 ** 10, 10 ** 10, 0, 5 * 10 ** 8)],
                   "sheet2_internal": [(d, 10 ** 17, 3 * 10 ** 17, 0, 0, 7, 0, 0, 0, 0)]})


def test_funnel_ratios_of_large_totals(frames):
    f = RP.funnel_numeric(large_funnel(frames), PARAMS).collect()[0]
    assert (f.kol_interest, f.kol_interest_pct, f.kol_desire_pct) == (9 * 10 ** 10, 900000, 5000)
    assert (f.internal_interest_pct, f.internal_desire_pct) == (30000, 0)
    assert f.am_interest_pct is None and f.action_pct == 0


def test_funnel_report_of_large_totals(frames):
    whole, pct = (r.asDict() for r in RP.funnel_report(large_funnel(frames), PARAMS).collect())
    assert ">90000000000<" in whole["KOL I"] and ">500000000<" in whole["KOL D"]
    assert ">9000.00%<" in pct["KOL I"] and ">300.00%<" in pct["INTERNAL I"]


def test_funnel_report_of_totals_beyond_bigint(frames):
    d = dt.date(2025, 6, 2)
    cat = frames({"sheet2_kol_ig": [(d, 9 * 10 ** 18, 8 * 10 ** 18, 0, 0, 1)] * 2})
    f = RP.funnel_numeric(cat, PARAMS).collect()[0]
    assert (f.kol_awareness, f.kol_interest) == (18 * 10 ** 18, 16 * 10 ** 18)
    whole, pct = (r.asDict() for r in RP.funnel_report(cat, PARAMS).collect())
    assert ">18000000000000000000<" in whole["KOL A"] and ">2<" in whole["KOL D"]
    assert ">16000000000000000000<" in whole["KOL I"] and ">0<" in whole["AM I"]
    assert ">88.89%<" in pct["KOL I"] and ">0.00%<" in pct["KOL D"] and pct["AM I"] is None


def test_budget_without_previous_month_orders(frames):
    cat = frames({"marketing": [("AM", D("1000"), "SHOPEE", dt.date(2025, 6, 5)),
                                ("LAINNYA", D("5"), "SHOPEE", dt.date(2025, 6, 5))]})
    rows = {r.pengeluaran: r for r in M.budget_use(cat, PARAMS).collect()}
    assert "LAINNYA" not in rows                               # outside the category list
    assert rows["TOTAL SEMUA"].total == D("1000.00")           # ... and outside the total
    assert rows["AM"].pct_tenths is None                       # no accrued budget: NULL
    rep = {r["PENGELUARAN"]: r for r in RP.budget_use_report(cat, PARAMS).collect()}
    assert rep["AM"]["% TOTAL"] is None and rep["SAMPEL"]["TOTAL"] == "Rp 0"


def test_empty_budget_matrix_keeps_total_row(frames):
    cat = frames({})
    rows = RP.budget_matrix_report(cat, PARAMS).collect()
    assert len(rows) == 1 and rows[0]["PRODUK"] == "<b>TOTAL</b>" and rows[0]["JULI"] is None


def test_daily_ratecard_month_lengths(frames):
    rows = [(dt.date(2025, m, 3), 1, D("2900")) for m in (2, 4, 5)] + [(dt.date(2024, 2, 3), 1, D("2900"))]
    cat = frames({"kelontong": rows})
    got = {r.bulan: r.days for r in C.ratecard_daily(cat).collect()}
    assert got == {"2025-02": 28, "2025-04": 30, "2025-05": 31, "2024-02": 29}


def test_tiktok_shop_day_null_shop_keeps_measures_apart(frames):
    """An order without a shop: revenue, packing and cost of goods stay three rows (the source
    full-joins them on the shop, and NULL never joins); a normal order gives one row."""
    rows = [order(1, "TIKTOK_SHOP", 1000, id_mp=5, toko=None),
            order(2, "TIKTOK_SHOP", 1000, id_mp=6, toko=1)]
    cat = frames({"pesanan": rows,
                  "pesanan_pembentuk_harga_tiktok_shop": [(1, D("111"), D("111"), D("0")),
                                                          (2, D("111"), D("111"), D("0"))],
                  "pesanan_detail": [(10, 1), (20, 2)],
                  "pesanan_detail_sku": [(10, "Cessa", 2), (20, "Cessa", 2)]})
    out = RP.shop_day_tiktok(cat, PARAMS).collect()
    null_rows = sorted((r.total_omni, r.total_packing, r.total_hpp) for r in out if r.toko_id is None)
    normal = [(r.total_omni, r.total_packing, r.total_hpp) for r in out if r.toko_id == 1]
    # 111 * (1 - 0.1425) * 100 / 111 = 85.75; packing 2000 (qty 2, before the switch);
    # cost 2 * 1000 * 100 / 111 = 1801.80
    assert null_rows == [(0.0, 0, 1801.8), (0.0, 2000, 0.0), (85.75, 0, 0.0)]
    assert normal == [(85.75, 2000, 1801.8)]


def test_monthly_pnl_months_from_revenue_rows(frames):
    """A month is reported when any revenue source has a row, even one worth 0 (only ENDORSE
    manual orders) or NULL (a TikTok order whose price is unknown and not settled)."""
    p = ReportParams(as_of=dt.date(2026, 2, 15), codes=ShopCodes())
    rows = [order(1, "MANUAL", 500, id_mp=1, tipe="ENDORSE", ts=dt.datetime(2025, 7, 3)),
            order(2, "TIKTOK_SHOP", 100, id_mp=2, ts=dt.datetime(2025, 8, 3))]
    cat = frames({**DIMS, "pesanan": rows,
                  "pesanan_pembentuk_harga_tiktok_shop": [(2, D("1"), None, D("0"))],
                  "pesanan_detail": [(20, 2)], "pesanan_detail_sku": [(20, "Cessa", 1)]})
    got = {r.periode: (r.total_omni, r.total_fat) for r in RP.monthly_pnl(cat, p).collect()}
    assert got == {"2025-07": (0.0, 0.0), "2025-08": (None, None)}
