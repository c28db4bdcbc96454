"""Cost measures: cost of goods, packing, ad spend, affiliate commission, overhead, rate card,
shipping.  All aggregates are exact decimals or integers; see ``functions.money`` for rounding."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import overhead_prorata, period, ratecard_prorata
from ..functions.json_fields import amount
from ..params import ReportParams
from ..sources import AD_SOURCES, Catalog
from . import rules as R
from .orders import (cogs_numerator, dated_surcharge_gross, orders_with_fields,
                     sku_order_vector)
from .predicates import channel_valid, in_months, not_name_at, valid_status

TIKTOK_AD_SOURCES = AD_SOURCES[:4]
SHOPEE_AD_SOURCES = AD_SOURCES[4:]
CREDIT_SOURCES = ("tiktok_proteksi_roas", "shopee_proteksi_roas")   # ROAS protection: a credit
ROUNDED_SOURCES = ("shopee_iklan_toko",)                            # summed, then rounded to int


def with_vector(cat: Catalog, orders: DataFrame, variant: R.CogsVariant,
                selective: bool = False) -> DataFrame:
    """Orders (with ``id``) joined to their per-order SKU vector; orders without lines drop out.
    ``selective``: the orders are few (a report window), so the detail table is semi-joined to
    them first; callers over the whole history leave it off."""
    vec = sku_order_vector(cat, variant, orders=orders if selective else None)
    return orders.join(vec, orders["id"] == vec["pesanan_id"])


def cogs_num_dated(special_shop: int) -> Column:
    """Cost-of-goods numerator (/111) with the dated surcharge schedule of the order."""
    sur = dated_surcharge_gross(F.col("created_at"), F.col("toko_id"), F.col("careos_qty"),
                                F.col("nutrimom_qty"), special_shop)
    return cogs_numerator(surcharge=sur)


def packing_cost(q: Column, created_at: Column, old_tiers, new_tiers) -> Column:
    """Packing tier of the order quantity; the tier table switches on the order date."""
    return F.when(created_at >= F.lit(R.PACKING_SWITCH), R.tier_cost(q, new_tiers)) \
        .otherwise(R.tier_cost(q, old_tiers))


# --- ad spend ----------------------------------------------------------------------------------

Months = list[tuple[int, int]] | None


def ad_cost() -> Column:
    """Sum of an ad ledger's rows: credits count negative, and the sum of a source that is
    rounded to whole rupiah is rounded before it is added."""
    money = "decimal(38,2)"
    rounded = F.col("source").isin(*ROUNDED_SOURCES)
    signed = F.when(F.col("source").isin(*CREDIT_SOURCES), -F.col("amt")).otherwise(F.col("amt"))
    exact = F.sum(F.when(~rounded, signed)).cast(money)
    whole = F.round(F.sum(F.when(rounded, F.col("amt"))), 0).cast(money)
    return F.when(exact.isNull() & whole.isNull(), F.lit(None)).otherwise(
        F.coalesce(exact, F.lit(0)) + F.coalesce(whole, F.lit(0))).cast(money)


def ad_spend_by_period(cat: Catalog, month_start: dt.date | None = None) -> DataFrame:
    """All 11 ad sources per month; credits negative, TikTok credit only from its cutoff date.
    One ledger and one aggregate (map-side partial sums) instead of one aggregate per source.
    ``month_start``: the first day of the first month that the caller can show."""
    ledger = cat.ad_ledger(AD_SOURCES, None if month_start is None
                           else lambda d: d >= F.lit(month_start))
    counted = (F.col("source") != "tiktok_proteksi_roas") | (
        F.col("d") >= F.lit(R.TIKTOK_ROAS_CREDIT_FROM))
    return ledger.where(counted).groupBy(period(F.col("d")).alias("periode")) \
        .agg(ad_cost().alias("total_iklan"))


def shopee_ads(cat: Catalog, months: Months = None) -> DataFrame:
    """The ledger of the 7 Shopee ad sources as ``toko, tanggal, source, amt``."""
    return cat.ad_ledger(SHOPEE_AD_SOURCES, lambda d: in_months(d, months)).select(
        F.col("toko_id").alias("toko"), F.col("d").cast("date").alias("tanggal"), "source", "amt")


def shopee_affiliate_rows(cat: Catalog) -> DataFrame:
    """Shopee affiliate commission (every order, no status filter), one row a price part, keyed
    by (shop, order day).  The parts are not summed per order first: the caller sums them per
    day anyhow, and a sum per order would hold every order of a task a second time."""
    p = cat["pesanan"].select("id", "toko_id", "created_at")
    parts = cat["pesanan_pembentuk_harga_shopee"].select("pesanan_id", "order_ams_commission_fee")
    j = parts.join(p, parts["pesanan_id"] == p["id"])
    return j.select(F.col("toko_id").alias("toko"),
                    F.col("created_at").cast("date").alias("tanggal"),
                    F.col("order_ams_commission_fee").cast("decimal(28,2)").alias("aff"))


def shopee_ads_and_affiliate(cat: Catalog) -> DataFrame:
    """Ad spend and affiliate cost per (shop, day), zero-filled.

    The source full-joins the two aggregates; here both are one union and one aggregate, with
    NULL keys kept apart per side (``null_key_tag``) as the full join does.
    """
    ads = shopee_ads(cat).withColumn("tag", null_key_tag(1, "toko", "tanggal"))
    aff = shopee_affiliate_rows(cat).withColumn("tag", null_key_tag(2, "toko", "tanggal"))
    u = ads.unionByName(aff, allowMissingColumns=True)
    g = u.groupBy("toko", "tanggal", "tag").agg(
        F.coalesce(ad_cost(), F.lit(0)).alias("total_iklan"),
        F.coalesce(F.sum("aff"), F.lit(0)).alias("total_aff"))
    return g.drop("tag")


def null_key_tag(tag: int, *keys: str) -> Column:
    """Grouping tag that keeps rows with a NULL key apart per source (NULL otherwise).

    Used where the source merges sides with full outer joins: a NULL key never joins there, so
    each side keeps its own row; grouping by (keys, tag) reproduces that, and for non-NULL keys
    the tag is NULL so all sides merge into one row.
    """
    cond = None
    for k in keys:
        c = F.col(k).isNull()
        cond = c if cond is None else (cond | c)
    return F.when(cond, F.lit(tag))


TIKTOK_AD_NAMES = ("am", "gm", "bo", "tpr")       # of TIKTOK_AD_SOURCES, in their order


def tiktok_ads(cat: Catalog) -> DataFrame:
    """The ledger of the TikTok ad sources, one amount column each, keyed by (day, shop)."""
    day, source = F.col("d").cast("date"), F.col("source")
    names = [t for t, _, _ in TIKTOK_AD_SOURCES]
    return cat.ad_ledger(TIKTOK_AD_SOURCES).select(
        day.alias("tanggal"), "toko_id",
        *[F.when(source == t, F.col("amt")).alias(n) for t, n in zip(names, TIKTOK_AD_NAMES)],
        F.when(day.isNull() | F.col("toko_id").isNull(),
               F.element_at(F.create_map(*[F.lit(x) for i, t in enumerate(names) for x in (t, 10 + i)]),
                            source)).alias("tag"))


AFFILIATE_TAG = 20


def tiktok_ad_rows(cat: Catalog) -> DataFrame:
    """Raw rows of the TikTok ad sources and of the affiliate commission, keyed by (day, shop).

    The affiliate commission comes from settlements joined to orders by marketplace id; the
    settlements are summed per (order id, shop) first so only one row per order crosses the join.
    """
    tp = cat["tiktok_pencairan"].groupBy("order_id", "toko_id").agg(
        F.sum("affiliate_commission").alias("aff_a"),
        F.sum("affiliate_shop_ads_commission").alias("aff_b"))
    p = cat["pesanan"].select("id_marketplace", "created_at")
    af = tp.join(p, tp["order_id"] == p["id_marketplace"]).select(
        F.col("created_at").cast("date").alias("tanggal"), "toko_id", "aff_a", "aff_b")
    return tiktok_ads(cat).unionByName(
        af.withColumn("tag", null_key_tag(AFFILIATE_TAG, "tanggal", "toko_id")),
        allowMissingColumns=True)


def tiktok_ad_measures() -> list[Column]:
    """Aggregates over ``tiktok_ad_rows``: GMV ads, total ads (ROAS credit negative), affiliate
    commission ``-sum(a) - sum(b)`` (NULL if either is NULL), and the credit itself."""
    z = lambda c: F.coalesce(c, F.lit(0))
    am, gm, bo = F.sum("am"), F.sum("gm"), F.sum("bo")
    tpr = -F.sum("tpr")
    return [z(gm).alias("iklan_gmv"), (z(am) + z(gm) + z(bo) + z(tpr)).alias("total_iklan"),
            z((-F.sum("aff_a")) + (-F.sum("aff_b"))).alias("total_affiliator"),
            z(tpr).alias("proteksi_roas")]


def tiktok_ads_by_day(cat: Catalog) -> DataFrame:
    """TikTok ad sources, affiliate commission and ROAS credit per (day, shop): one aggregate
    over the union of the sources (the source's five-way full outer join, same rows)."""
    g = tiktok_ad_rows(cat).groupBy("tanggal", "toko_id", "tag").agg(*tiktok_ad_measures())
    return g.drop("tag")


# --- overhead ----------------------------------------------------------------------------------

def overhead_by_period(cat: Catalog, as_of: dt.date,
                       month_start: dt.date | None = None) -> DataFrame:
    """Monthly overhead entries linked to any shop; the running month pro-rated to ``as_of``.

    The source de-duplicates the entry x shop fan-out with ``MAX`` per entry; a semi join does
    the same without producing the fan-out.  Output numerator ``beban_num`` over
    ``beban_den`` (exact; the pro-rating is linear so it is applied to the monthly sum).
    """
    b = cat["beban"]
    if month_start is not None:
        b = b.where((F.col("tahun") > month_start.year) | (
            (F.col("tahun") == month_start.year) & (F.col("bulan") >= month_start.month)))
    bt = cat["beban_toko"]
    linked = b.join(bt, b["id"] == bt["beban_id"], "left_semi")
    num, den = overhead_prorata(as_of)
    current = (F.col("tahun") == as_of.year) & (F.col("bulan") == as_of.month)
    per = linked.groupBy("tahun", "bulan").agg(F.sum("nilai").alias("s"))
    return per.select(
        F.concat(F.col("tahun").cast("string"), F.lit("-"),
                 F.lpad(F.col("bulan").cast("string"), 2, "0")).alias("periode"),
        F.when(current, F.col("s") * num).otherwise(F.col("s") * den).alias("beban_num"),
        F.lit(den).alias("beban_den"))


def overhead_allocation(cat: Catalog, months: Months = None) -> DataFrame:
    """Monthly overhead per shop by its share of orders, per overhead kind (AM, CC, LIVE).

    share = Shopee orders of the shop / orders of all shops linked to the same import and kind,
    times the import's monthly total linked to the shop, rounded to cents.  Orders are counted
    per (shop, year, month) *before* they meet the overhead bridge, once for the shop's share
    and the import's whole; the import's whole is a sum over its linked shops' counts, in the
    months that the import has entries for.  ``months`` limits the months that are returned;
    every share still counts the whole month over all linked shops.
    """
    from ..functions.money import div_round_half_away
    links = cat["beban"].join(cat["beban_toko"], F.col("id") == F.col("beban_id")) \
        .groupBy("import_id", "toko_id", "jenis", "tahun", "bulan").agg(F.sum("nilai").alias("total"))
    # one row an import and kind: its shops, and the months that have entries
    wanted = F.lit(True) if months is None else F.struct("tahun", "bulan").isin(
        *[F.struct(F.lit(y), F.lit(m)) for y, m in sorted(set(months))])
    when = F.struct("tahun", "bulan")
    imports = links.groupBy("import_id", "jenis").agg(
        F.collect_set("toko_id").alias("shops"),
        F.collect_set(F.when(wanted, when)).alias("entry_months"))
    pairs = imports.select("import_id", "jenis", "entry_months", F.explode("shops").alias("toko_id")) \
        .select("import_id", "jenis", "toko_id", F.explode("entry_months").alias("e")) \
        .select("import_id", "jenis", "toko_id", "e.tahun", "e.bulan")
    counts = cat["pesanan"].where(valid_status() & in_months(F.col("created_at"), months)).groupBy(
        "toko_id", F.year("created_at").alias("tahun"), F.month("created_at").alias("bulan")
    ).agg(F.count(F.lit(1)).alias("n_all"),
          F.sum(F.when(F.col("marketplace") == R.SHOPEE, 1).otherwise(0)).alias("n_shopee"))
    whole = Window.partitionBy("import_id", "jenis", "tahun", "bulan")
    shares = pairs.join(counts, ["toko_id", "tahun", "bulan"]) \
        .withColumn("n_import", F.sum("n_all").over(whole)).where("n_shopee > 0 and n_import <> 0")
    alloc = shares.join(links, ["import_id", "toko_id", "jenis", "tahun", "bulan"]) \
        .select("toko_id", "jenis", "tahun", "bulan",
                div_round_half_away(F.col("n_shopee") * F.col("total") * 100,
                                    F.col("n_import")).alias("cents"))
    aggs = [F.sum(F.when(F.col("jenis") == kind, F.col("cents"))).alias(name)
            for kind, name in R.OVERHEAD_KINDS]
    return alloc.groupBy(F.col("toko_id").alias("toko"), "tahun", "bulan").agg(*aggs)


# --- rate card, shipping -------------------------------------------------------------------

def ratecard_by_period(cat: Catalog, as_of: dt.date,
                       month_start: dt.date | None = None) -> DataFrame:
    """Rate card per month; the running month pro-rated by ``day(as_of - 1) / days``."""
    k = cat["kelontong"]
    if month_start is not None:
        k = k.where(F.col("tanggal") >= F.lit(month_start))
    num, den = ratecard_prorata(as_of)
    cur = as_of.strftime("%Y-%m")
    per = k.groupBy(period(F.col("tanggal")).alias("periode")).agg(F.sum("nominal").alias("s"))
    return per.select("periode",
                      F.when(F.col("periode") == cur, F.col("s") * num)
                      .otherwise(F.col("s") * den).alias("rc_num"),
                      F.lit(den).alias("rc_den"))


def ratecard_daily(cat: Catalog) -> DataFrame:
    """Monthly rate card of a shop spread evenly over the days of that month."""
    k = cat["kelontong"]
    per = k.groupBy(F.col("toko_id").alias("toko"), period(F.col("tanggal")).alias("bulan")) \
        .agg(F.sum("nominal").alias("total_bulanan"))
    days = F.dayofmonth(F.last_day(F.to_date(F.concat(F.col("bulan"), F.lit("-01")))))
    return per.select("toko", "bulan", "total_bulanan", days.alias("days"))


def shipping_value(ongkir_text: Column, params: ReportParams) -> Column:
    return amount(ongkir_text, params.strict_json)


# --- cost of goods and packing per grain ----------------------------------------------------------

def cogs_by_shop_day(cat: Catalog, params: ReportParams) -> DataFrame:
    o = cat["pesanan"].where(valid_status()).select("id", "toko_id", "created_at")
    j = with_vector(cat, o, R.COGS_PLACEHOLDER_DATED)
    return j.groupBy(F.col("toko_id").alias("toko"),
                     F.col("created_at").cast("date").alias("tanggal")) \
        .agg(F.sum(cogs_num_dated(params.codes.funnel_shopee_shop)).alias("hpp_num"))


def packing_by_shop_day(cat: Catalog) -> DataFrame:
    """Daily packing per shop; manual orders filtered by customer name only."""
    p = orders_with_fields(cat)
    keep = channel_valid(F.col("marketplace"), (R.MANUAL,),
                         not_name_at(F.col("cust_nama"), R.WAREHOUSE_NAME_KEYWORDS))
    j = with_vector(cat, p.where(keep).select("id", "toko_id", "created_at"), R.COGS_ORDER_LEVEL)
    cost = packing_cost(F.col("total_qty"), F.col("created_at"),
                        R.PACKING_TIERS_DAILY_OLD, R.PACKING_TIERS_DAILY_NEW)
    return j.groupBy(F.col("toko_id").alias("toko"),
                     F.col("created_at").cast("date").alias("tanggal")) \
        .agg(F.sum(cost).alias("total_packing"))
