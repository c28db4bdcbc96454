"""Named queries over the driver tables: ``name -> (spark, sf_dir) -> DataFrame``.

Each query reads the whole synthetic tables (through the source mapping) and runs one operator
family or one full report with the fixture parameters (``ReportParams.for_fixture``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.dates import period
from ..functions.json_fields import amount, rejected_fields, with_order_fields
from ..functions.money import cents, from_cents
from ..operators import costs as C
from ..operators import marketing as M
from ..operators import rules as R
from ..operators.ordering import with_position
from ..operators.orders import (clean_orders, cross_posted_ids, dedup_candidates,
                                dedup_priority)
from ..operators.predicates import in_window, valid_status
from ..operators.revenue import (settlement_by_order, settlement_per_order,
                                  tiktok_order_revenue)
from ..params import ReportParams
from ..sources import Catalog
from ..streaming import maintained as MT
from . import reports as RP

Query = Callable[[SparkSession, str], DataFrame]


def catalog_for(spark: SparkSession, sf_dir: str) -> Catalog:
    """The source tables of a data directory, derived lazily inside each query's plan."""
    return Catalog.from_driver_tables(spark, sf_dir)


def _ctx(spark: SparkSession, sf_dir: str):
    return catalog_for(spark, sf_dir), ReportParams.for_fixture()


def _money(c):
    return from_cents(c)


def q_rupiah_format(spark, sf_dir):
    """Gross and net revenue per month and channel after de-duplication, as rupiah text."""
    from ..functions.money import ratio_round
    from ..operators import present as P
    cat, params = _ctx(spark, sf_dir)
    pb = clean_orders(cat, params, "monthly")
    g = pb.groupBy(period(F.col("created_at")).alias("periode"), F.col("mp").alias("marketplace")) \
        .agg(F.sum("harga").alias("gross"))
    net = F.translate(F.format_number(ratio_round(F.col("gross") * 100, R.VAT_DIVISOR, 0), 0),
                      ",", ".")
    return g.select("periode", "marketplace", P.rp(F.col("gross")).alias("gross_text"),
                    F.concat(F.lit("Rp "), net).alias("net_text"))


def q_clean_orders_dedup(spark, sf_dir):
    cat, params = _ctx(spark, sf_dir)
    return clean_orders(cat, params, "order_level").select(
        "id", "tanggal", "mp", "id_marketplace", F.col("toko_id").cast("bigint").alias("toko_id"),
        "nama_toko", "gudang", F.col("harga").cast("double").alias("harga"))


def q_clean_orders_dedup_monthly(spark, sf_dir):
    cat, params = _ctx(spark, sf_dir)
    return clean_orders(cat, params, "monthly").select(
        "id", "tanggal", "mp", "id_marketplace", F.col("toko_id").cast("bigint").alias("toko_id"))


def q_cross_posted_ids(spark, sf_dir):
    cat, _ = _ctx(spark, sf_dir)
    return cross_posted_ids(cat).select("id_marketplace", "n_channels")


def q_net_revenue_month(spark, sf_dir):
    """Flagship: net revenue per month after cross-channel de-duplication."""
    cat, params = _ctx(spark, sf_dir)
    pb = clean_orders(cat, params, "monthly")
    return pb.groupBy(period(F.col("created_at")).alias("periode")).agg(
        F.count(F.lit(1)).alias("n_orders"),
        _money(cents(F.sum("harga") * 100, R.VAT_DIVISOR)).alias("net_revenue"))


def q_shopee_revenue_day(spark, sf_dir):
    cat, _ = _ctx(spark, sf_dir)
    r = RP.shopee_revenue_by_shop_day(cat)
    return r.select(F.col("toko").cast("bigint").alias("toko"), "tanggal",
                    _money(cents(F.col("omni_n"), R.VAT_DIVISOR)).alias("omset"),
                    _money(cents(F.col("fat_n"), R.VAT_DIVISOR)).alias("omset_fat"))


def q_tiktok_revenue_order(spark, sf_dir):
    cat, _ = _ctx(spark, sf_dir)
    p = cat["pesanan"].where((F.col("marketplace") == R.TIKTOK) & valid_status())
    o = p.select("id", "id_marketplace", F.col("toko_id").cast("bigint").alias("toko"),
                 F.col("created_at").cast("date").alias("tanggal"))
    r = tiktok_order_revenue(cat, o, R.TIKTOK_FEE_FALLBACK,
                             settlement_by_order(cat, distinct=False), 100)
    return r.select("id", "toko", "tanggal",
                    _money(cents(F.col("omni_num"), R.VAT_DIVISOR)).alias("total_omni"),
                    _money(cents(F.col("fat_num"), R.VAT_DIVISOR)).alias("total_fat"))


def q_tiktok_revenue_month(spark, sf_dir):
    cat, params = _ctx(spark, sf_dir)
    r = RP.tiktok_revenue_by_period(cat, params)
    return r.select("periode", _money(F.col("omni_c")).alias("total_omni"),
                    _money(F.col("fat_c")).alias("total_fat"))


def _settlement(distinct):
    def q(spark, sf_dir):
        cat, _ = _ctx(spark, sf_dir)
        return settlement_per_order(cat, distinct).select(
            "order_id", F.col("settlement").cast("double").alias("total_settlement_amount"))
    return q


def q_settlement_sum_maintained(spark, sf_dir):
    """``SUM(DISTINCT)`` of the settlements from signed batches: the shops' rows come in two
    batches, the second with all rows of the first once more, which a third takes out again."""
    cat, _ = _ctx(spark, sf_dir)
    paid = cat["tiktok_pencairan"].select("order_id", "total_settlement_amount", "toko_id")
    first = F.coalesce(F.col("toko_id") < 12, F.lit(False))
    one, two = paid.where(first).drop("toko_id"), paid.where(~first).drop("toko_id")
    batches = MT.signed(one).unionByName(MT.signed(two.unionByName(one))).unionByName(MT.signed(None, one))
    return MT.distinct_sums(MT.merged(batches), ["order_id"], "total_settlement_amount", "s").select(
        "order_id", F.col("s").cast("double").alias("total_settlement_amount"))


def q_clean_orders_maintained(spark, sf_dir):
    """The de-duplicated orders of the monthly report from signed batches of candidates: first
    every copy as if it had no price yet, then an update to what it is."""
    cat, params = _ctx(spark, sf_dir)
    now = dedup_candidates(cat, params, "monthly").select(
        "id", F.col("created_at").cast("date").alias("tanggal"), F.col("marketplace").alias("mp"),
        "id_marketplace", F.col("toko_id").cast("bigint").alias("toko_id"),
        dedup_priority(F.col("marketplace"), F.col("harga")).alias("turn"))
    early = now.withColumn("turn", F.lit(3))
    state = MT.merged(MT.signed(early).unionByName(MT.signed(now, early)))
    kept = MT.survivors(state, "id_marketplace", [F.col("turn"), F.col("id")])
    return kept.select("id", "tanggal", "mp", "id_marketplace", "toko_id")


def q_manual_revenue_endorse_zero(spark, sf_dir):
    cat, params = _ctx(spark, sf_dir)
    m = RP.manual_revenue_by_period(cat, params)
    return m.select("tipe", "periode",
                    _money(cents(F.col("omni_n"), R.VAT_DIVISOR)).alias("total_omni"),
                    _money(F.col("fat_c")).alias("total_fat"))


def _orders_in_r5_window(cat, params, status: bool):
    start, end = params.bounds()
    p = cat["pesanan"].where(in_window(F.col("created_at"), start, end))
    if status:
        p = p.where(valid_status())
    return p.select("id")


def q_cogs_order(spark, sf_dir):
    cat, params = _ctx(spark, sf_dir)
    o = _orders_in_r5_window(cat, params, status=True)
    j = C.with_vector(cat, o, R.COGS_ORDER_LEVEL, selective=True)
    from ..operators.orders import cogs_numerator
    return j.select("id", _money(cents(cogs_numerator(), R.VAT_DIVISOR)).alias("total_hpp"))


def q_cogs_shop_day(spark, sf_dir):
    cat, params = _ctx(spark, sf_dir)
    r = C.cogs_by_shop_day(cat, params)
    return r.select(F.col("toko").cast("bigint").alias("toko"), "tanggal",
                    _money(cents(F.col("hpp_num"), R.VAT_DIVISOR)).alias("total_hpp"))


def q_cogs_month(spark, sf_dir):
    cat, params = _ctx(spark, sf_dir)
    r = RP.cogs_by_period(cat, params)
    return r.select("periode", _money(cents(F.col("hpp_num"), R.VAT_DIVISOR)).alias("total_hpp"))


def q_packing_order(spark, sf_dir):
    cat, params = _ctx(spark, sf_dir)
    o = _orders_in_r5_window(cat, params, status=False)
    j = C.with_vector(cat, o, R.COGS_ORDER_LEVEL, selective=True)
    return j.select("id", F.col("total_qty").cast("bigint").alias("total_qty"),
                    R.tier_cost(F.col("total_qty"), R.PACKING_TIERS_ORDER_LEVEL)
                    .cast("bigint").alias("biaya_packing"))


def q_packing_shop_day(spark, sf_dir):
    cat, _ = _ctx(spark, sf_dir)
    r = C.packing_by_shop_day(cat)
    return r.select(F.col("toko").cast("bigint").alias("toko"), "tanggal",
                    F.col("total_packing").cast("bigint").alias("total_packing"))


def q_packing_month(spark, sf_dir):
    cat, params = _ctx(spark, sf_dir)
    r = RP.packing_by_period(cat, params)
    return r.select("periode", F.col("total_packing").cast("bigint").alias("total_packing"))


def q_ad_spend_union_month(spark, sf_dir):
    cat, _ = _ctx(spark, sf_dir)
    r = C.ad_spend_by_period(cat)
    return r.select("periode", F.col("total_iklan").cast("double").alias("total_iklan"))


def q_ad_spend_fullouter_day(spark, sf_dir):
    cat, _ = _ctx(spark, sf_dir)
    r = C.tiktok_ads_by_day(cat)
    return r.select("tanggal", F.col("toko_id").cast("bigint").alias("toko_id"),
                    *[F.col(c).cast("double").alias(c) for c in
                      ("iklan_gmv", "total_iklan", "total_affiliator", "proteksi_roas")])


def q_affiliate_shop_day(spark, sf_dir):
    cat, _ = _ctx(spark, sf_dir)
    r = C.shopee_ads_and_affiliate(cat)
    return r.select(F.col("toko").cast("bigint").alias("toko"), "tanggal",
                    F.col("total_iklan").cast("double").alias("total_iklan"),
                    F.col("total_aff").cast("double").alias("total_aff"))


def q_overhead_allocation(spark, sf_dir):
    cat, _ = _ctx(spark, sf_dir)
    r = C.overhead_allocation(cat)
    return r.select(F.col("toko").cast("bigint").alias("toko"),
                    F.col("tahun").cast("bigint").alias("tahun"),
                    F.col("bulan").cast("bigint").alias("bulan"),
                    *[_money(F.col(n)).alias(n) for _, n in R.OVERHEAD_KINDS])


def q_overhead_prorata(spark, sf_dir):
    cat, params = _ctx(spark, sf_dir)
    r = C.overhead_by_period(cat, params.as_of)
    return r.select("periode", _money(cents(F.col("beban_num"), F.col("beban_den")))
                    .alias("total_beban"))


def q_ratecard_prorata(spark, sf_dir):
    cat, params = _ctx(spark, sf_dir)
    r = C.ratecard_by_period(cat, params.as_of)
    return r.select("periode", _money(cents(F.col("rc_num"), F.col("rc_den")))
                    .alias("total_ratecard"))


def q_ratecard_daily(spark, sf_dir):
    cat, _ = _ctx(spark, sf_dir)
    r = C.ratecard_daily(cat)
    return r.select(F.col("toko").cast("bigint").alias("toko"), "bulan",
                    _money(cents(F.col("total_bulanan"), F.col("days"))).alias("nilai_harian"))


def q_shipping_json_month(spark, sf_dir):
    cat, params = _ctx(spark, sf_dir)
    r = RP.shipping_by_period(cat, params)
    return r.select("periode", F.col("total_ongkir").cast("double").alias("total_ongkir"))


def q_funnel_totals(spark, sf_dir):
    cat, params = _ctx(spark, sf_dir)
    t = M.funnel_totals(cat, params)
    return t.select(*[F.col(c).cast("double" if c.endswith("_desire") else "bigint").alias(c)
                      for c in t.columns])


def q_funnel_ratios(spark, sf_dir):
    cat, params = _ctx(spark, sf_dir)
    f = RP.funnel_numeric(cat, params)
    pct = [c for c in f.columns if c.endswith("_pct")]
    return f.select("total_orders", *[(F.col(c).cast("double") / 100).alias(c) for c in pct])


def q_order_delta_prior_month(spark, sf_dir):
    cat, params = _ctx(spark, sf_dir)
    return M.order_counts(cat, params)


def q_budget_matrix_with_total(spark, sf_dir):
    cat, params = _ctx(spark, sf_dir)
    return RP.budget_matrix_numeric(cat, params)


def q_budget_use_by_category(spark, sf_dir):
    cat, params = _ctx(spark, sf_dir)
    return RP.budget_use_numeric(cat, params)


def q_key_spine_union(spark, sf_dir):
    """Every (shop, day) with Shopee turnover, ad spend, affiliate cost, packing or cost of goods."""
    cat, params = _ctx(spark, sf_dir)
    keys = ["toko", "tanggal"]
    # turnover days are among the days with price parts, packing days among those with cost of
    # goods (both read every valid order's lines); ads and affiliate keep every price part's day
    spine = (C.shopee_ads_and_affiliate(cat).select(*keys)
             .union(C.cogs_by_shop_day(cat, params).select(*keys))
             .distinct())
    return spine.select(F.col("toko").cast("bigint").alias("toko"), "tanggal")


def q_date_window_param(spark, sf_dir):
    """Valid orders per channel in a report window given as named SQL parameters."""
    cat, params = _ctx(spark, sf_dir)
    cat["pesanan"].createOrReplaceTempView("ledgerline_pesanan")
    start, end = params.bounds()
    return spark.sql(
        f"""SELECT marketplace, count(*) AS n_orders, CAST(sum(harga) AS DOUBLE) AS gross
           FROM ledgerline_pesanan
           WHERE created_at >= :start_date AND created_at < :end_date
             AND status NOT IN {R.sql_in(R.INVALID_STATUSES)}
           GROUP BY marketplace""",
        args={"start_date": start, "end_date": end})


#: months of the incremental refresh query
REFRESH_MONTHS = [(2025, 6), (2026, 2)]


def q_shop_day_a_month(spark, sf_dir):
    """The Shopee shop-day facts of two months, as the month refresh computes them."""
    cat, params = _ctx(spark, sf_dir)
    return RP.shop_day_shopee(cat, params, REFRESH_MONTHS)


def q_order_desc_nulls_first(spark, sf_dir):
    """The days of the TikTok shop-day report in its order: newest first, the unknown day before
    all, with the position as a column (ranked month by month)."""
    cat, params = _ctx(spark, sf_dir)
    days = RP.shop_day_tiktok(cat, params).groupBy("tanggal").agg(F.count("*").alias("n_shops"))
    return with_position(days, [F.col("tanggal").desc_nulls_first()], F.trunc("tanggal", "month"),
                         lambda c: c.desc_nulls_first())


def q_order_asc_nulls_last(spark, sf_dir):
    """The rows of the order-level report in its order, with the position as a column."""
    cat, params = _ctx(spark, sf_dir)
    return RP.order_level_positions(cat, params)


def q_json_quality_month(spark, sf_dir):
    """Orders per month by the state of their JSON fields: how many lack a name, a type or a
    platform, give a shipping cost, and have a field that cannot be read."""
    cat, _ = _ctx(spark, sf_dir)
    bad = rejected_fields(cat["pesanan"]).groupBy(F.col("id").alias("bad_id")).agg(
        F.count("*").alias("n_bad"))
    o = with_order_fields(cat["pesanan"])
    missing = lambda c: F.sum(F.when(F.col(c).isNull(), 1).otherwise(0))
    return o.join(bad, o["id"] == bad["bad_id"], "left").groupBy(
        period(F.col("created_at")).alias("periode")).agg(
        F.count("*").alias("n_orders"), missing("cust_nama").alias("no_name"),
        missing("cust_tipe").alias("no_type"), missing("platform").alias("no_platform"),
        F.count(amount(F.col("ongkir_text"))).alias("with_shipping"),
        F.coalesce(F.sum("n_bad"), F.lit(0)).cast("bigint").alias("unreadable"))


def q_order_total_last(spark, sf_dir):
    """The product rows of the budget matrix in its order, the total row pinned to the end."""
    cat, params = _ctx(spark, sf_dir)
    m = M.budget_matrix(cat, params)
    at = F.row_number().over(Window.orderBy(F.when(F.col("is_total"), 1).otherwise(0),
                                            F.col("PRODUK").asc_nulls_last()))
    return m.select(F.when(F.col("is_total"), F.lit("TOTAL")).otherwise(F.col("PRODUK"))
                    .alias("PRODUK"), at.alias("position"))


def q_order_category_total_last(spark, sf_dir):
    """The spend categories of the budget-use report in its order, the total row pinned to the
    end (a fixed list of categories, so the window is small)."""
    cat, params = _ctx(spark, sf_dir)
    b = M.budget_use(cat, params)
    at = F.row_number().over(Window.orderBy(F.when(F.col("is_total"), 1).otherwise(0),
                                            F.col("pengeluaran").asc_nulls_last()))
    return b.select("pengeluaran", at.alias("position"))


def _report(fn):
    def q(spark, sf_dir):
        cat, params = _ctx(spark, sf_dir)
        return fn(cat, params)
    return q


QUERIES: dict[str, Query] = {
    "net_revenue_month": q_net_revenue_month,
    "clean_orders_dedup": q_clean_orders_dedup,
    "rupiah_format": q_rupiah_format,
    "clean_orders_dedup_monthly": q_clean_orders_dedup_monthly,
    "cross_posted_ids": q_cross_posted_ids,
    "shopee_revenue_day": q_shopee_revenue_day,
    "tiktok_revenue_order": q_tiktok_revenue_order,
    "tiktok_revenue_month": q_tiktok_revenue_month,
    "settlement_sum_distinct": _settlement(True),
    "settlement_sum": _settlement(False),
    "settlement_sum_maintained": q_settlement_sum_maintained,
    "clean_orders_maintained": q_clean_orders_maintained,
    "manual_revenue_endorse_zero": q_manual_revenue_endorse_zero,
    "cogs_order": q_cogs_order,
    "cogs_shop_day": q_cogs_shop_day,
    "cogs_month": q_cogs_month,
    "packing_order": q_packing_order,
    "packing_shop_day": q_packing_shop_day,
    "packing_month": q_packing_month,
    "ad_spend_union_month": q_ad_spend_union_month,
    "ad_spend_fullouter_day": q_ad_spend_fullouter_day,
    "affiliate_shop_day": q_affiliate_shop_day,
    "overhead_allocation": q_overhead_allocation,
    "overhead_prorata": q_overhead_prorata,
    "ratecard_prorata": q_ratecard_prorata,
    "ratecard_daily": q_ratecard_daily,
    "shipping_json_month": q_shipping_json_month,
    "funnel_totals": q_funnel_totals,
    "funnel_ratios": q_funnel_ratios,
    "order_delta_prior_month": q_order_delta_prior_month,
    "budget_matrix_with_total": q_budget_matrix_with_total,
    "budget_use_by_category": q_budget_use_by_category,
    "key_spine_union": q_key_spine_union,
    "date_window_param": q_date_window_param,
    "distinct_on_first": _report(RP.order_level_numeric),
    "report_order_level": _report(RP.order_level_report),
    "report_monthly_pnl": _report(RP.monthly_pnl),
    "report_shop_day_a": _report(RP.shop_day_shopee),
    "report_shop_day_b": _report(RP.shop_day_tiktok),
    "shop_day_a_month": q_shop_day_a_month,
    "order_desc_nulls_first": q_order_desc_nulls_first,
    "order_asc_nulls_last": q_order_asc_nulls_last,
    "order_total_last": q_order_total_last,
    "order_category_total_last": q_order_category_total_last,
    "json_quality_month": q_json_quality_month,
    "report_budget_matrix": _report(RP.budget_matrix_report),
    "report_budget_use": _report(RP.budget_use_report),
    "report_funnel": _report(RP.funnel_report),
}

