"""The seven reports, each in a numeric form (what tests compare) and a presentation form.

R1 ``funnel``            marketing funnel, two rows
R2 ``budget_matrix``     product x month marketing budget with a total row
R3 ``monthly_pnl``       monthly profit and loss
R4 ``budget_use``        budget use by spend category
R5 ``order_level``       one row per order
R6 ``shop_day_shopee``   Shopee shop x day facts
R7 ``shop_day_tiktok``   TikTok shop x day facts
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import period
from ..functions.money import (cents, div_round_half_away, fixed_text, from_cents, ratio_round)
from ..operators import costs as C
from ..operators import marketing as M
from ..operators import present as P
from ..operators import rules as R
from ..operators.ordering import with_position, write_sorted
from ..operators.orders import (TiktokRevenueRule, clean_orders, cogs_numerator, order_fact,
                                orders_with_fields)
from ..operators.predicates import (channel_valid, in_months, in_window, not_name_at,
                                    valid_status)
from ..operators.revenue import settlement_with_commissions, shopee_parts_per_order
from ..params import ReportParams
from ..sources import Catalog


def _add_nullable(a: Column, b: Column) -> Column:
    """``a + b`` where a NULL side counts as 0 unless both are NULL (SUM over a union)."""
    return F.when(a.isNull() & b.isNull(), F.lit(None)).otherwise(
        F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0)))


def _money(c: Column) -> Column:
    return from_cents(c)


# --- R5 order level ----------------------------------------------------------------------------

def order_level_values(cat: Catalog, params: ReportParams) -> DataFrame:
    """One row per de-duplicated order with revenue, cost of goods, packing and shipping.

    The source joins revenue rows (one per Shopee price row) and keeps the first row per order
    without a deciding order; here the smallest revenue row wins.  Every input is reduced to one
    row per order before it is joined (SKU vector, price rows, Shopee parts, settlement), so the
    plan is one pass over the SKU lines and only 1:1 joins.
    """
    codes = params.codes
    pb = clean_orders(cat, params, "order_level")
    start, end = params.bounds()
    window = cat["pesanan"].where(in_window(F.col("created_at"), start, end) & valid_status()) \
        .select("id", "id_marketplace", "marketplace")    # cheap superset of the survivors
    u = cat["users_omni"].select(F.col("id").alias("u_id"), F.col("name").alias("user_name"))
    pb = pb.join(u, pb["atur_by"] == u["u_id"], "left")
    f = order_fact(cat, pb.withColumn("marketplace", F.col("mp")), R.COGS_ORDER_LEVEL,
                   TiktokRevenueRule(settlement_distinct=True, settlement_factor=R.VAT_DIVISOR,
                                     per_order="min"),
                   tiktok_eligible=F.col("mp") == R.TIKTOK, how="left", prefilter=window)
    parts = shopee_parts_per_order(cat, orders=window.where(F.col("marketplace") == R.SHOPEE)) \
        .select(F.col("pesanan_id").alias("s_id"), "escrow_min")
    f = f.join(parts, (f["id"] == parts["s_id"]) & (f["mp"] == R.SHOPEE), "left")
    manual_ok = ((F.col("mp") == R.MANUAL) & F.col("u_id").isNotNull()
                 & ~F.col("user_name").isin(*codes.denied_users)
                 & not_name_at(F.col("nama_cust"), R.WAREHOUSE_NAME_KEYWORDS_LOOSE,
                               F.col("toko_id") == F.lit(codes.warehouse_shop)))
    num = "decimal(38,6)"       # one explicit type for the three channels' numerators
    omni = (F.when(F.col("mp") == R.SHOPEE, (F.col("escrow_min") * 100).cast(num))
            .when(F.col("mp") == R.TIKTOK, F.col("tt_omni_num").cast(num))
            .when(manual_ok, (F.col("harga") * 100).cast(num)))
    toko = F.when(F.col("nama_toko") == F.lit(codes.warehouse_shop_name), F.col("nama_toko2")) \
        .otherwise(F.col("nama_toko"))
    return f.select(
        "id", "tanggal", F.col("id_marketplace").alias("id_mp"), "mp", "nama_cust", "gudang",
        "platform", toko.alias("toko"),
        omni.alias("omni_num"), cogs_numerator().alias("hpp_num"),
        F.when(F.col("total_qty").isNotNull(),   # no SKU line: no packing row (NULL)
               R.tier_cost(F.col("total_qty"), R.PACKING_TIERS_ORDER_LEVEL)).alias("packing"),
        C.shipping_value(F.col("ongkir_text"), params).alias("ongkir"))


def order_level_numeric(cat: Catalog, params: ReportParams) -> DataFrame:
    v = order_level_values(cat, params)
    return v.select("id", "tanggal", "id_mp", "mp", "nama_cust", "gudang", "platform", "toko",
                    _money(cents(F.col("omni_num"), R.VAT_DIVISOR)).alias("omni"),
                    _money(cents(F.col("hpp_num"), R.VAT_DIVISOR)).alias("hpp"),
                    F.col("packing").cast("bigint").alias("packing"),
                    F.col("ongkir").cast("double").alias("ongkir"))


#: order ids that share a range where positions are counted
POSITION_RANGE = 1 << 16


def order_level_positions(cat: Catalog, params: ReportParams) -> DataFrame:
    """``id, tanggal, position`` of the order-level rows in the report's order.

    Positions follow from the surviving orders alone (the report adds one row to each), so
    nothing but two numbers of an order is counted and ranked.
    """
    pb = clean_orders(cat, params, "order_level").select("id", "tanggal")
    return with_position(pb, [F.col("id").asc_nulls_last(), F.col("tanggal").asc_nulls_last()],
                         F.floor(F.col("id") / POSITION_RANGE), lambda c: c.asc_nulls_last())


def write_order_level(cat: Catalog, params: ReportParams, path: str) -> None:
    """The order-level report as sorted files (``operators.ordering.read_sorted`` numbers them)."""
    write_sorted(order_level_numeric(cat, params), path,
                 [F.col("id").asc_nulls_last(), F.col("tanggal").asc_nulls_last()])


def _rupiah_ratio(num: Column, den: int = 1) -> Column:
    return F.translate(F.format_number(ratio_round(num, den, 0), 0), ",", ".")


def order_level_report(cat: Catalog, params: ReportParams) -> DataFrame:
    v = order_level_values(cat, params)
    return v.orderBy(F.col("id").asc_nulls_last(), F.col("tanggal").asc_nulls_last()).select(
        F.col("id").alias("ID ORDER"), F.col("tanggal").alias("TANGGAL"),
        F.col("id_mp").alias("ID MP"), F.col("mp").alias("MARKETPLACE"),
        F.col("nama_cust").alias("NAMA CUSTOMER"), F.col("gudang").alias("GUDANG"),
        F.col("platform").alias("PLATFORM"), F.col("toko").alias("TOKO"),
        _rupiah_ratio(F.col("omni_num"), R.VAT_DIVISOR).alias("OMNI"),
        _rupiah_ratio(F.col("hpp_num"), R.VAT_DIVISOR).alias("HPP"),
        _rupiah_ratio(F.col("packing")).alias("PACKING"),
        _rupiah_ratio(F.col("ongkir")).alias("ONGKIR"))


# --- R3 monthly profit and loss ----------------------------------------------------------------

def shopee_revenue_by_period(cat: Catalog, params: ReportParams) -> DataFrame:
    pb = clean_orders(cat, params, "monthly").where(F.col("mp") == R.SHOPEE)
    parts = shopee_parts_per_order(cat)
    j = pb.join(parts, pb["id"] == parts["pesanan_id"])
    return j.groupBy(period(F.col("created_at")).alias("periode")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        (F.sum("escrow_sum") * 100).alias("omni_n"),
        cents(F.sum("fat_sum") * 100, R.VAT_DIVISOR).alias("fat_c"))


MONTHLY_TIKTOK = TiktokRevenueRule(settlement_distinct=True, keep_total_amount=True)


def monthly_orders(cat: Catalog, params: ReportParams) -> DataFrame:
    """Valid orders since the history start, each with one flag per measure of the monthly report
    (``cogs_ok, pack_ok, manual_ok``): the order filter of the measure's source query."""
    codes = params.codes
    p = orders_with_fields(cat).where(
        (F.col("created_at") >= F.lit(params.history_start)) & valid_status())
    t = cat["toko"].select(F.col("id").alias("t_id"), F.col("nama").alias("t_nama"))
    u = cat["users_omni"].select(F.col("id").alias("u_id"), F.col("name").alias("user_name"))
    p = p.join(t, p["toko_id"] == t["t_id"], "left").join(u, p["atur_by"] == u["u_id"], "left")
    at_wh = F.col("toko_id") == F.lit(codes.warehouse_shop)
    at_riva = F.col("t_nama") == F.lit(codes.warehouse_shop_name)
    excluded_day = (F.col("created_at").cast("date") == F.lit(R.EXCLUDED_MANUAL_DAY)) & \
        F.upper(F.col("platform")).isin(*R.MANUAL_PLATFORMS)
    cogs_ok = (~F.col("toko_id").isin(*codes.test_shops)
               & not_name_at(F.col("cust_nama"), R.WAREHOUSE_NAME_KEYWORDS, at_wh) & ~excluded_day)
    pack_ok = F.col("t_id").isNotNull() & channel_valid(
        F.col("marketplace"), (R.MANUAL,),
        not_name_at(F.col("cust_nama"), R.WAREHOUSE_NAME_KEYWORDS, at_riva))
    manual_ok = (F.col("marketplace").isin(R.MANUAL, R.KIRIMINAJA) & F.col("t_id").isNotNull()
                 & F.col("u_id").isNotNull() & ~F.col("user_name").isin(*codes.denied_users)
                 & ~F.col("platform").isin(*R.MANUAL_PLATFORMS)
                 & not_name_at(F.col("cust_nama"), R.WAREHOUSE_NAME_KEYWORDS_LOOSE, at_riva))
    return p.select("id", "id_marketplace", "marketplace", "created_at", "toko_id", "harga",
                    F.col("cust_tipe").alias("tipe"), C.shipping_value(F.col("ongkir_text"), params).alias("ongkir"),
                    cogs_ok.alias("cogs_ok"), pack_ok.alias("pack_ok"), manual_ok.alias("manual_ok"))


def _monthly_packing():
    return C.packing_cost(F.col("total_qty"), F.col("created_at"),
                          R.PACKING_TIERS_MONTHLY_OLD, R.PACKING_TIERS_MONTHLY_NEW)


def _manual_value(harga):
    """Numerator and net cents of a customer type's manual revenue; ENDORSE counts 0."""
    endorse = F.col("tipe") == R.ENDORSE
    return (F.when(endorse, F.lit(0)).otherwise(harga * 100),
            F.when(endorse, F.lit(0)).otherwise(cents(harga * 100, R.VAT_DIVISOR)))


def tiktok_revenue_by_period(cat: Catalog, params: ReportParams) -> DataFrame:
    """The TikTok revenue of ``monthly_order_measures`` alone."""
    o = monthly_orders(cat, params).where(F.col("marketplace") == R.TIKTOK)
    f = order_fact(cat, o, R.COGS_PLACEHOLDER_DATED, MONTHLY_TIKTOK).where("tt_has")
    return f.groupBy(period(F.col("created_at")).alias("periode")).agg(
        cents(F.sum("tt_omni_num"), R.VAT_DIVISOR).alias("omni_c"),
        cents(F.sum("tt_fat_num"), R.VAT_DIVISOR).alias("fat_c"))


def manual_revenue_by_period(cat: Catalog, params: ReportParams) -> DataFrame:
    """Manual and KIRIMINAJA orders per customer type and month; ENDORSE customers count 0."""
    o = monthly_orders(cat, params).where("manual_ok")
    g = o.groupBy("tipe", period(F.col("created_at")).alias("periode")).agg(F.sum("harga").alias("s"))
    omni, fat = _manual_value(F.col("s"))
    return g.select("tipe", "periode", omni.alias("omni_n"), fat.alias("fat_c"))


def cogs_by_period(cat: Catalog, params: ReportParams) -> DataFrame:
    """The cost of goods of ``monthly_order_measures`` alone."""
    f = order_fact(cat, monthly_orders(cat, params).where("cogs_ok"), R.COGS_PLACEHOLDER_DATED)
    return f.groupBy(period(F.col("created_at")).alias("periode")) \
        .agg(F.sum(C.cogs_num_dated(params.codes.funnel_shopee_shop)).alias("hpp_num"))


def packing_by_period(cat: Catalog, params: ReportParams) -> DataFrame:
    """The packing cost of ``monthly_order_measures`` alone."""
    f = order_fact(cat, monthly_orders(cat, params).where("pack_ok"), R.COGS_PLACEHOLDER_DATED)
    return f.groupBy(period(F.col("created_at")).alias("periode")) \
        .agg(F.sum(_monthly_packing()).alias("total_packing"))


def shipping_by_period(cat: Catalog, params: ReportParams) -> DataFrame:
    """The shipping cost of ``monthly_order_measures`` alone."""
    return monthly_orders(cat, params).groupBy(period(F.col("created_at")).alias("periode")) \
        .agg(F.sum("ongkir").alias("total_ongkir"))


def monthly_order_measures(cat: Catalog, params: ReportParams) -> DataFrame:
    """Everything the monthly report takes from valid orders since the history start, in one
    pass over the order header and one over the SKU lines: TikTok revenue, manual revenue (per
    customer type, ENDORSE counting 0), cost of goods, packing and shipping.

    Each measure keeps the order filter of its source query as a flag.  Orders without SKU
    lines stay in (shipping and manual revenue do not need lines).  The first aggregate is per
    (month, customer type) because manual revenue is rounded per type; the second sums the
    types of a month, carrying exact numerators for the month-level rounding.
    """
    f = order_fact(cat, monthly_orders(cat, params), R.COGS_PLACEHOLDER_DATED, MONTHLY_TIKTOK,
                   tiktok_eligible=F.col("marketplace") == R.TIKTOK, how="left")
    has_lines = F.col("pesanan_id").isNotNull()
    by_type = f.groupBy(period(F.col("created_at")).alias("periode"), "tipe").agg(
        F.count(F.when(F.col("tt_has"), 1)).alias("n_tiktok"),
        F.sum("tt_omni_num").alias("tt_omni_num"), F.sum("tt_fat_num").alias("tt_fat_num"),
        F.sum(F.when(F.col("cogs_ok") & has_lines,
                     C.cogs_num_dated(params.codes.funnel_shopee_shop))).alias("hpp_num"),
        F.sum(F.when(F.col("pack_ok") & has_lines, _monthly_packing())).alias("total_packing"),
        F.count(F.when(F.col("manual_ok"), 1)).alias("n_manual"),
        F.sum(F.when(F.col("manual_ok"), F.col("harga"))).alias("manual_harga"),
        F.sum("ongkir").alias("total_ongkir"))
    has_manual = F.col("n_manual") > 0
    manual_omni, manual_fat = _manual_value(F.col("manual_harga"))
    return by_type.groupBy("periode").agg(
        F.sum("n_tiktok").alias("n_tiktok"),
        cents(F.sum("tt_omni_num"), R.VAT_DIVISOR).alias("tt_omni_c"),
        cents(F.sum("tt_fat_num"), R.VAT_DIVISOR).alias("tt_fat_c"),
        F.sum(F.when(has_manual, 1).otherwise(0)).alias("n_manual_groups"),
        F.sum(F.when(has_manual, manual_omni)).alias("manual_omni_n"),
        F.sum(F.when(has_manual, manual_fat)).alias("manual_fat_c"),
        F.sum("hpp_num").alias("hpp_num"), F.sum("total_packing").alias("total_packing"),
        F.sum("total_ongkir").alias("total_ongkir"))


def monthly_pnl(cat: Catalog, params: ReportParams) -> DataFrame:
    """Monthly profit and loss: months with revenue, each cost zero-filled.

    Two passes over the order header: the de-duplicated Shopee revenue (a window over order
    copies) and ``monthly_order_measures`` (everything else taken from orders, with one pass
    over the SKU lines).  The other costs are one row per month each.
    """
    dec = "decimal(38,2)"
    s = shopee_revenue_by_period(cat, params).select(
        F.col("periode").alias("s_p"), F.col("n_rows").alias("n_shopee"),
        F.col("omni_n").cast(dec).alias("shopee_omni_n"), F.col("fat_c").alias("shopee_fat_c"))
    mo = monthly_order_measures(cat, params)
    j = mo.join(s, mo["periode"] == s["s_p"], "full")
    j = j.select(F.coalesce(mo["periode"], s["s_p"]).alias("periode"),
                 *[c for c in j.columns if c not in ("periode", "s_p")])
    # a month is reported when any revenue source has a row for it
    has_revenue = ((F.coalesce(F.col("n_shopee"), F.lit(0)) > 0)
                   | (F.coalesce(F.col("n_tiktok"), F.lit(0)) > 0)
                   | (F.coalesce(F.col("n_manual_groups"), F.lit(0)) > 0))
    j = j.where(has_revenue)
    # only months from the history start can have revenue, so no cost is read before it
    first = params.history_start.replace(day=1)
    ads = C.ad_spend_by_period(cat, first).select(F.col("periode").alias("i_p"), "total_iklan")
    bb = C.overhead_by_period(cat, params.as_of, first).select(
        F.col("periode").alias("b_p"), cents(F.col("beban_num"), F.col("beban_den")).alias("beban_c"))
    rc = C.ratecard_by_period(cat, params.as_of, first).select(
        F.col("periode").alias("r_p"), cents(F.col("rc_num"), F.col("rc_den")).alias("rc_c"))
    for df, key in ((ads, "i_p"), (bb, "b_p"), (rc, "r_p")):
        j = j.join(df, j["periode"] == df[key], "left")
    z = lambda c: F.coalesce(c, F.lit(0))
    omni_n = _add_nullable(F.col("shopee_omni_n"), F.col("manual_omni_n").cast(dec))
    omni = _add_nullable(cents(omni_n, R.VAT_DIVISOR), F.col("tt_omni_c"))
    fat = _add_nullable(_add_nullable(F.col("shopee_fat_c"), F.col("tt_fat_c")),
                        F.col("manual_fat_c"))
    return j.select(
        "periode",
        _money(omni).alias("total_omni"),
        _money(fat).alias("total_fat"),
        z(F.col("total_ongkir")).cast("double").alias("total_ongkir"),
        _money(z(cents(F.col("hpp_num"), R.VAT_DIVISOR))).alias("total_hpp"),
        _money(z(F.col("beban_c"))).alias("total_beban"),
        z(F.col("total_iklan")).cast("double").alias("total_iklan"),
        z(F.col("total_packing")).cast("bigint").alias("total_packing"),
        _money(z(F.col("rc_c"))).alias("total_ratecard"),
    ).orderBy(F.col("periode").desc_nulls_first())


# --- R6 Shopee shop x day ---------------------------------------------------------------------

def shopee_revenue_by_shop_day(cat: Catalog) -> DataFrame:
    p = cat["pesanan"].where((F.col("marketplace") == R.SHOPEE) & valid_status())
    parts = shopee_parts_per_order(cat)
    j = p.join(parts, p["id"] == parts["pesanan_id"])
    return j.groupBy(F.col("toko_id").alias("toko"),
                     F.col("created_at").cast("date").alias("tanggal")).agg(
        (F.sum("escrow_sum") * 100).alias("omni_n"), (F.sum("fat_sum") * 100).alias("fat_n"))


def shopee_costs_by_shop_day(cat: Catalog, params: ReportParams,
                             months: C.Months = None) -> DataFrame:
    """Packing and cost of goods per (shop, day) in one pass over the SKU lines (valid orders;
    packing leaves out manual orders of warehouse / consignment customers)."""
    in_scope = valid_status() & in_months(F.col("created_at"), months)
    p = orders_with_fields(cat).where(in_scope)
    few = None if months is None else cat["pesanan"].where(in_scope).select("id")
    pack_ok = channel_valid(F.col("marketplace"), (R.MANUAL,),
                            not_name_at(F.col("cust_nama"), R.WAREHOUSE_NAME_KEYWORDS))
    o = p.select("id", "id_marketplace", "toko_id", "created_at", pack_ok.alias("pack_ok"))
    f = order_fact(cat, o, R.COGS_PLACEHOLDER_DATED, prefilter=few)
    pack = C.packing_cost(F.col("total_qty"), F.col("created_at"),
                          R.PACKING_TIERS_DAILY_OLD, R.PACKING_TIERS_DAILY_NEW)
    return f.groupBy(F.col("toko_id").alias("toko"),
                     F.col("created_at").cast("date").alias("tanggal")).agg(
        F.sum(F.when(F.col("pack_ok"), pack)).alias("total_packing"),
        F.sum(C.cogs_num_dated(params.codes.funnel_shopee_shop)).alias("hpp_num"))


def shop_day_shopee(cat: Catalog, params: ReportParams, months: C.Months = None) -> DataFrame:
    """Shopee shop-day facts for days with turnover; the three overhead columns stay NULL when a
    shop has no allocation that month, every other measure is zero-filled.

    The source unions the keys of all measures and then keeps days with Shopee turnover.  Here
    the price parts are read once for both turnover (Shopee, valid orders) and affiliate
    commission (every order), merged with the seven ad sources in one aggregate per (shop, day);
    turnover > 0 then drives, and the SKU-based costs and overhead are left joins.

    ``months`` (pairs of year and month): only these months' days.  The bounds reach every dated
    scan, and the SKU lines and price parts are semi-joined to the months' orders.
    """
    p = cat["pesanan"].where(in_months(F.col("created_at"), months)) \
        .select("id", "toko_id", "created_at", "marketplace", "status")
    parts = shopee_parts_per_order(cat, orders=None if months is None else p)
    j = parts.join(p, parts["pesanan_id"] == p["id"])
    counted = (F.col("marketplace") == R.SHOPEE) & valid_status()
    dec = "decimal(38,2)"
    part_rows = j.select(F.col("toko_id").alias("toko"),
                         F.col("created_at").cast("date").alias("tanggal"),
                         F.when(counted, F.col("escrow_sum")).cast(dec).alias("escrow"),
                         F.when(counted, F.col("fat_sum")).cast(dec).alias("fat"),
                         F.col("commission_sum").cast(dec).alias("aff"))
    u = part_rows.unionByName(C.shopee_ads(cat, months), allowMissingColumns=True)
    om = u.groupBy("toko", "tanggal").agg(
        (F.sum("escrow") * 100).alias("omni_n"), (F.sum("fat") * 100).alias("fat_n"),
        F.coalesce(C.ad_cost(), F.lit(0)).alias("total_iklan"),
        F.coalesce(F.sum("aff"), F.lit(0)).alias("total_aff"))
    om = om.where((F.col("omni_n") > 0) & F.col("toko").isNotNull() & F.col("tanggal").isNotNull())
    costs = shopee_costs_by_shop_day(cat, params, months)
    bb = C.overhead_allocation(cat, months)
    toko = cat["toko"].select(F.col("id").alias("t_id"), F.col("nama").alias("nama_toko"))
    keys = ["toko", "tanggal"]
    j = (om.join(costs, keys, "left")
         .withColumn("tahun", F.year("tanggal")).withColumn("bulan", F.month("tanggal"))
         .join(bb, ["toko", "tahun", "bulan"], "left")
         .join(toko, F.col("toko") == F.col("t_id")))
    z = lambda c: F.coalesce(F.col(c), F.lit(0))
    return j.select(
        F.col("toko").cast("bigint").alias("toko"), "tanggal",
        F.col("tahun").cast("bigint").alias("tahun"), F.col("bulan").cast("bigint").alias("bulan"),
        _money(cents(F.col("omni_n"), R.VAT_DIVISOR)).alias("omset"),
        _money(cents(F.col("fat_n"), R.VAT_DIVISOR)).alias("omset_fat"),
        z("total_packing").cast("bigint").alias("packing"),
        z("total_iklan").cast("double").alias("iklan"),
        z("total_aff").cast("double").alias("affiliator"),
        _money(cents(z("hpp_num"), R.VAT_DIVISOR)).alias("hpp"),
        *[_money(F.col(name)).alias(name) for _, name in R.OVERHEAD_KINDS],
        "nama_toko")


# --- R7 TikTok shop x day ---------------------------------------------------------------------


#: tag of order measures without a day or shop, until they are split
SPLIT_TAG = -1


def tiktok_order_rows(cat: Catalog, params: ReportParams) -> DataFrame:
    """Rows per (day, shop) from the orders: revenue numerators, packing and cost of goods of each
    valid order with SKU lines, and the affiliate commissions of each order that was settled.

    One pass over the order header, the SKU lines and the settlements serves all of them; an
    order gives one row of its own and one for each shop with a commission.
    """
    p = cat["pesanan"].select("id", "id_marketplace", "marketplace", "created_at", "toko_id",
                              valid_status().alias("valid"))
    f = order_fact(cat, p, R.COGS_PLACEHOLDER_DATED, TiktokRevenueRule(settlement_distinct=False),
                   tiktok_eligible=(F.col("marketplace") == R.TIKTOK) & F.col("valid"), how="left",
                   settled=settlement_with_commissions(cat))
    pack = C.packing_cost(F.col("total_qty"), F.col("created_at"),
                          R.PACKING_TIERS_DAILY_OLD, R.PACKING_TIERS_DAILY_NEW)
    day, money = F.col("created_at").cast("date"), "decimal(38,2)"
    kinds = {"toko": "int", "tag": "int", "n_tt": "int", "omni_num": "decimal(38,6)",
             "fat_num": "decimal(38,6)", "pack": "bigint", "hpp": "decimal(38,0)",
             "aff_a": money, "aff_b": money}

    def row(**given: Column) -> Column:
        return F.struct(*[given.get(n, F.lit(None)).cast(t).alias(n) for n, t in kinds.items()])

    def missing(toko: Column) -> Column:
        return day.isNull() | toko.isNull()
    counted = F.col("valid") & F.col("pesanan_id").isNotNull()
    own = row(toko=F.col("toko_id"), tag=F.when(missing(F.col("toko_id")), F.lit(SPLIT_TAG)),
              n_tt=F.when(F.col("tt_has"), 1).otherwise(0), omni_num=F.col("tt_omni_num"),
              fat_num=F.col("tt_fat_num"), pack=pack,
              hpp=C.cogs_num_dated(params.codes.funnel_shopee_shop))
    none = F.array().cast(f"array<struct<{','.join(f'{n}:{t}' for n, t in kinds.items())}>>")
    paid = F.transform(F.col("commissions"), lambda c: row(
        toko=c["toko_id"], tag=F.when(missing(c["toko_id"]), F.lit(C.AFFILIATE_TAG)),
        aff_a=c["aff_a"], aff_b=c["aff_b"]))
    return f.select(day.alias("tanggal"), F.explode(F.concat(
        F.when(counted, F.array(own)).otherwise(none), F.coalesce(paid, none))).alias("r")) \
        .select("tanggal", "r.*")


def shop_day_tiktok(cat: Catalog, params: ReportParams) -> DataFrame:
    """TikTok shop-day facts: order measures and the five ad sources merged by (day, shop).

    One union and one aggregate replace the source's chain of full outer joins (same rows: every
    side is one row per key, and NULL keys stay apart through ``tag``).  The source joins revenue,
    packing and cost of goods as well, so with a NULL day or shop each of the three keeps a row of
    its own; such groups are split after the aggregate.
    """
    u = tiktok_order_rows(cat, params).unionByName(
        C.tiktok_ads(cat).withColumnRenamed("toko_id", "toko"), allowMissingColumns=True)
    sums = {"omni_c": cents(F.sum("omni_num"), R.VAT_DIVISOR),
            "fat_c": cents(F.sum("fat_num"), R.VAT_DIVISOR),
            "total_packing": F.sum("pack"), "hpp_num": F.sum("hpp")}
    g = u.groupBy("tanggal", "toko", "tag").agg(
        F.sum("n_tt").alias("n_tt"), *[c.alias(n) for n, c in sums.items()],
        *C.tiktok_ad_measures())
    types = dict(g.dtypes)

    def part(*own):
        return F.struct(*[(F.col(n) if n in own else F.lit(None)).cast(types[n]).alias(n)
                          for n in sums])
    split = F.filter(F.array(F.when(F.col("n_tt") > 0, part("omni_c", "fat_c")),
                             part("total_packing"), part("hpp_num")), lambda x: x.isNotNull())
    rows = F.when(F.col("tag") == SPLIT_TAG, split).otherwise(F.array(part(*sums)))
    g = g.select(*[c for c in g.columns if c not in sums], F.explode(rows).alias("m")) \
        .select("*", "m.*")
    rc = C.ratecard_daily(cat).select(F.col("toko").alias("r_toko"), F.col("bulan").alias("r_bulan"),
                                      cents(F.col("total_bulanan"), F.col("days")).alias("rc_c"))
    j = g.join(rc, (F.col("toko") == F.col("r_toko"))
               & (period(F.col("tanggal")) == F.col("r_bulan")), "left")
    z = lambda c: F.coalesce(F.col(c), F.lit(0))
    return j.select(
        "tanggal", F.col("toko").cast("bigint").alias("toko_id"),
        _money(z("omni_c")).alias("total_omni"), _money(z("fat_c")).alias("total_fat"),
        z("total_iklan").cast("double").alias("total_iklan"),
        z("iklan_gmv").cast("double").alias("iklan_gmv"),
        z("total_affiliator").cast("double").alias("total_affiliator"),
        z("total_packing").cast("bigint").alias("total_packing"),
        _money(cents(z("hpp_num"), R.VAT_DIVISOR)).alias("total_hpp"),
        _money(z("rc_c")).alias("ratecard_harian"),
    ).orderBy(F.col("tanggal").desc_nulls_first())


# --- R1 funnel -------------------------------------------------------------------------------

def funnel_numeric(cat: Catalog, params: ReportParams) -> DataFrame:
    return M.funnel_ratios(M.funnel_totals(cat, params), M.order_counts(cat, params))


def funnel_report(cat: Catalog, params: ReportParams) -> DataFrame:
    """Two rows of dashboard HTML: absolute numbers, then percentages.

    Both rows come from one pass over the one-row aggregate (``inline`` of two structs); a
    union of two projections would compute the whole funnel twice.
    """
    f = funnel_numeric(cat, params)

    def whole(c: Column) -> Column:   # ROUND(x)::text of a decimal with up to 4 places
        return div_round_half_away((c * 10000).cast("decimal(38,0)"), 10000).cast("string")

    def pct(c: str) -> Column:
        return F.concat(fixed_text(F.col(c), 2), F.lit("%"))

    labels, row1, row2 = [], [], []
    for label, p in M.FUNNEL_GROUPS:
        labels += [f"{label} A", f"{label} I", f"{label} D"]
        row1 += [P.span(F.col(f"{p}_awareness").cast("string"), label, 500),
                 P.span(F.col(f"{p}_interest").cast("string"), label, 500),
                 P.span(whole(F.col(f"{p}_desire")), label, 500)]
        row2 += [F.lit(None).cast("string"),
                 P.span(pct(f"{p}_interest_pct"), label, 400),
                 P.span(pct(f"{p}_desire_pct"), label, 400)]
    labels.append("ACTION")
    row1.append(P.span(F.col("total_orders").cast("string"), "ACTION", 500))
    row2.append(P.span(pct("action_pct"), "ACTION", 400))

    def as_row(cols):
        return F.struct(*[c.alias(n) for c, n in zip(cols, labels)])
    return f.select(F.inline(F.array(as_row(row1), as_row(row2))))


# --- R2 budget matrix ----------------------------------------------------------------------------

def budget_matrix_numeric(cat: Catalog, params: ReportParams) -> DataFrame:
    m = M.budget_matrix(cat, params)
    labels = [lab for _, lab in R.BUDGET_MONTH_LABELS]
    return m.select("PRODUK", *[F.col(lab).cast("bigint").alias(lab) for lab in labels])


def budget_matrix_report(cat: Catalog, params: ReportParams) -> DataFrame:
    m = M.budget_matrix(cat, params)
    labels = [lab for _, lab in R.BUDGET_MONTH_LABELS]
    tot = F.col("is_total")

    def cell(lab):
        txt = P.rp(F.col(lab).cast("decimal(38,0)"))
        return F.when(tot, P.bold(txt)).otherwise(txt).alias(lab)
    produk = F.when(tot, P.bold(F.lit("TOTAL"))).otherwise(F.col("PRODUK")).alias("PRODUK")
    return m.orderBy(F.when(tot, 1).otherwise(0), F.col("PRODUK").asc_nulls_last()) \
        .select(produk, *[cell(lab) for lab in labels])


# --- R4 budget use -------------------------------------------------------------------------------

def budget_use_numeric(cat: Catalog, params: ReportParams) -> DataFrame:
    b = M.budget_use(cat, params)
    return b.select(F.col("pengeluaran"), F.col("shopee").cast("double").alias("shopee"),
                    F.col("tiktok").cast("double").alias("tiktok"),
                    F.col("total").cast("double").alias("total"),
                    (F.col("pct_tenths").cast("double") / 10).alias("pct_total"),
                    F.col("total_budget_marketing").cast("bigint").alias("total_budget_marketing"))


def budget_use_report(cat: Catalog, params: ReportParams) -> DataFrame:
    b = M.budget_use(cat, params)
    tot = F.col("is_total")
    name = F.when(tot, P.bold(F.lit("TOTAL SEMUA"))).otherwise(F.col("pengeluaran"))

    def cell(c):
        txt = P.rp(F.col(c))
        return F.when(tot, P.bold(txt)).otherwise(txt)
    bar = F.when(tot, P.percent_bar(F.col("total_budget_marketing"), F.col("pct_tenths"), True)) \
        .otherwise(P.percent_bar(F.col("total_budget_marketing"), F.col("pct_tenths"), False))
    return b.orderBy(F.when(tot, 1).otherwise(0), F.col("pengeluaran").asc_nulls_last()).select(
        name.alias("PENGELUARAN"), cell("shopee").alias("SHOPEE"), cell("tiktok").alias("TIKTOK"),
        cell("total").alias("TOTAL"), bar.alias("% TOTAL"))

