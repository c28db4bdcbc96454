"""Order-level building blocks: cleaned and de-duplicated orders, the order x SKU trunk and the
per-order rule vectors that replace SKU-level rows before any join with the order header.

Scale notes
-----------
* ``pesanan_detail_sku`` is the largest table (one row per SKU line).  Every measure that the
  reports compute per SKU line is linear in the quantity, so it is reduced to *one row per order*
  (``sku_order_vector``) by a hash aggregate with map-side partial aggregation, before the result
  meets the order header.  Lines cross the join with the detail table as numbers (quantity, cost
  rule, fee class): the product name is read on the scan only (``classified_lines``).
* The cross-channel de-duplication ranks copies of one marketplace order id.  Spark plans
  ``row_number() = 1`` with a partial ``WindowGroupLimit`` before the shuffle, so even the NULL
  id (all orders without a marketplace id form one group) ships at most one row per input
  partition.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.json_fields import with_order_fields
from ..params import ReportParams
from ..sources import Catalog
from . import rules as R
from .predicates import channel_valid, in_window, not_name_at
from .products import with_codes


def orders_with_fields(cat: Catalog) -> DataFrame:
    return with_order_fields(cat["pesanan"])


def sku_lines(cat: Catalog, orders: DataFrame | None = None) -> DataFrame:
    """``pesanan_detail JOIN pesanan_detail_sku``: one row per SKU line with its order id.

    With ``orders`` (a frame with an ``id`` column) the detail table is first semi-joined to
    those orders, so a selective report window shrinks the build side early (AQE can then
    broadcast it instead of shuffling the SKU table).
    """
    if cat.order_lines is not None:
        return _of_orders(cat.order_lines.select("pesanan_id", "nama", "qty"), orders)
    pd = _of_orders(_details(cat), orders)
    pds = cat["pesanan_detail_sku"]
    return pds.join(pd, pds["pesanan_detail_id"] == pd["detail_id"]) \
        .select("pesanan_id", "nama", "qty")


def _details(cat: Catalog) -> DataFrame:
    return cat["pesanan_detail"].select(F.col("id").alias("detail_id"), "pesanan_id")


def _of_orders(rows: DataFrame, orders: DataFrame | None) -> DataFrame:
    if orders is None:
        return rows
    ids = orders.select(F.col("id").alias("o_id"))
    return rows.join(ids, rows["pesanan_id"] == ids["o_id"], "left_semi")


def classified_lines(cat: Catalog, fee_fallback: str | None,
                     orders: DataFrame | None = None) -> DataFrame:
    """SKU lines as ``pesanan_id, qty, rule, fee``: the product name becomes the cost rule and the
    fee class on the scan, so no string crosses the join's shuffle.

    ``orders`` as in ``sku_lines``: only for callers whose order set is selective.
    """
    qty = F.col("qty").cast("bigint").alias("qty")
    if cat.order_lines is not None:
        lines = _of_orders(cat.order_lines.select("pesanan_id", "nama", qty), orders)
        return with_codes(cat, lines, fee_fallback)
    lines = with_codes(cat, cat["pesanan_detail_sku"].select("pesanan_detail_id", "nama", qty),
                       fee_fallback)
    pd = _of_orders(_details(cat), orders)
    return lines.join(pd, lines["pesanan_detail_id"] == pd["detail_id"]) \
        .select("pesanan_id", "qty", "rule", "fee")


def _lookup(idx: Column, values, default) -> Column:
    """Value of rule ``idx`` (1-based; 0 = no rule) from a small literal array."""
    return F.element_at(F.array(*[F.lit(v) for v in (default, *values)]), idx + 1)


def sku_order_vector(cat: Catalog, variant: R.CogsVariant, fee_fallback: str | None = None,
                     orders: DataFrame | None = None) -> DataFrame:
    """Per order: quantity, cost-of-goods parts and TikTok fee factors, from its SKU lines.

    Columns: ``pesanan_id, total_qty, cogs_net_num, cogs_gross, careos_qty, nutrimom_qty,
    fee_max, fee_min``.  Cost of goods of the order is
    ``cogs_net_num / 111 + cogs_gross`` plus the dated surcharges (``careos_qty``,
    ``nutrimom_qty`` times the per-order rate).  ``fee_*`` are (1 - fee) * 100 of the best/worst
    product; with a non-negative price the per-order maximum of ``price * factor`` is
    ``price * fee_max``.
    """
    src = classified_lines(cat, fee_fallback, orders)
    idx, qty = F.col("rule"), F.col("qty")
    units = [r[1] if variant.unit_override is None else variant.unit_override for r in R.COGS_RULES]
    is_net = [r[2] for r in R.COGS_RULES]
    fixed = [0 if (variant.dated_surcharge and r[4]) else r[3] for r in R.COGS_RULES]
    unit = _lookup(idx, units, 0)
    net = _lookup(idx, is_net, False)
    sched = _lookup(idx, [r[4] or "" for r in R.COGS_RULES], "") if variant.dated_surcharge \
        else F.lit("")
    return src.groupBy("pesanan_id").agg(
        F.sum("qty").alias("total_qty"),
        F.sum(F.when(net, qty * unit * 100).otherwise(0)).alias("cogs_net_num"),
        F.sum(F.when(net, 0).otherwise(qty * unit) + qty * _lookup(idx, fixed, 0))
        .alias("cogs_gross"),
        F.sum(F.when(sched == "careos", qty).otherwise(0)).alias("careos_qty"),
        F.sum(F.when(sched == "nutrimom", qty).otherwise(0)).alias("nutrimom_qty"),
        F.max("fee").alias("fee_max"),
        F.min("fee").alias("fee_min"),
    )


def dated_surcharge_gross(created_at: Column, toko_id: Column, careos_qty: Column,
                          nutrimom_qty: Column, special_shop: int) -> Column:
    """Surcharge of the dated schedule: rate by order date and shop, times the product quantity."""
    after = created_at >= F.lit(R.SURCHARGE_SWITCH)
    special = after & (toko_id == F.lit(special_shop))

    def rate(kind):
        sp, other, before = R.SURCHARGE_SCHEDULE[kind]
        return F.when(special, sp).when(after, other).otherwise(before)
    return careos_qty * rate("careos") + nutrimom_qty * rate("nutrimom")


def cogs_numerator(vec_prefix: str = "", surcharge: Column | None = None) -> Column:
    """Exact numerator N of the cost of goods, cost = N / 111 (all parts are integers)."""
    gross = F.col(vec_prefix + "cogs_gross")
    if surcharge is not None:
        gross = gross + surcharge
    return F.col(vec_prefix + "cogs_net_num") + gross * R.VAT_DIVISOR


# --- de-duplication ----------------------------------------------------------------------------

def dedup_priority(marketplace: Column, harga: Column) -> Column:
    """1: marketplace copy with a price; 2: manual copy with a price; 3: the rest."""
    return (F.when((marketplace != R.MANUAL) & (harga > 0), 1)
            .when((marketplace == R.MANUAL) & (harga > 0), 2).otherwise(3))


def dedup_candidates(cat: Catalog, params: ReportParams, variant: str = "order_level") -> DataFrame:
    """Valid orders of the window, all copies.

    ``variant='order_level'``: window ``[from, to]``, only MANUAL gets the manual extras.
    ``variant='monthly'``: everything since ``history_start``, KIRIMINAJA treated like MANUAL.
    """
    codes = params.codes
    p = orders_with_fields(cat)
    g = cat["gudang"].select(F.col("id").alias("g_id"), F.col("nama").alias("gudang"))
    t = cat["toko"].select(F.col("id").alias("t_id"), F.col("nama").alias("nama_toko"))
    if variant == "order_level":
        start, end = params.bounds()
        manual = (R.MANUAL,)
    else:
        start, end = params.history_start, None
        manual = (R.MANUAL, R.KIRIMINAJA)
    at_warehouse = F.col("toko_id") == F.lit(codes.warehouse_shop)
    keep = (in_window(F.col("created_at"), start, end)
            & channel_valid(F.col("marketplace"), manual,
                            not_name_at(F.col("cust_nama"), R.WAREHOUSE_NAME_KEYWORDS, at_warehouse))
            & ~F.col("toko_id").isin(*codes.test_shops))
    return (p.where(keep)
            .join(g, p["gudang_id"] == g["g_id"])
            .join(t, p["toko_id"] == t["t_id"]))


def clean_orders(cat: Catalog, params: ReportParams, variant: str = "order_level") -> DataFrame:
    """The candidates (``dedup_candidates``), one survivor per marketplace order id.

    The survivor is the copy with the best priority; ties go to the lowest order id (the source
    leaves them arbitrary).  The NULL marketplace id is one group with one survivor.
    """
    rows = dedup_candidates(cat, params, variant)
    w = Window.partitionBy("id_marketplace").orderBy(
        dedup_priority(F.col("marketplace"), F.col("harga")), F.col("id"))
    return (rows.withColumn("urutan", F.row_number().over(w))
            .where(F.col("urutan") == 1)
            .select("id", F.col("created_at").cast("date").alias("tanggal"), "created_at",
                    F.col("marketplace").alias("mp"), "id_marketplace", "nama_toko", "toko_id",
                    "platform", "atur_by", "gudang", F.col("cust_nama").alias("nama_cust"),
                    "harga", "status", F.col("cust_nama_toko").alias("nama_toko2"),
                    F.col("cust_tipe").alias("tipe"), "ongkir_text"))


def cross_posted_ids(cat: Catalog) -> DataFrame:
    """Marketplace ids that occur in exactly two of the three channels."""
    p = cat["pesanan"].where(F.col("marketplace").isin(R.MANUAL, R.TIKTOK, R.SHOPEE))
    return (p.groupBy("id_marketplace")
            .agg(F.countDistinct("marketplace").alias("n_channels"))
            .where(F.col("n_channels") == 2))



# --- one pass over the SKU lines per report ----------------------------------------------------

@dataclass(frozen=True)
class TiktokRevenueRule:
    """How a report values TikTok orders (see ``revenue.tiktok_order_revenue``)."""

    fee_fallback: str | None = R.TIKTOK_FEE_FALLBACK
    settlement_distinct: bool = False
    settlement_factor: int = 100          # 100: settlement net of VAT; 111: kept gross
    keep_total_amount: bool = False       # the monthly report also groups by total_amount
    per_order: str = "sum"                # "sum" over price rows, or "min" (one row is shown)


def order_fact(cat: Catalog, orders: DataFrame, variant: R.CogsVariant,
               tiktok: TiktokRevenueRule | None = None, tiktok_eligible: Column | None = None,
               how: str = "inner", prefilter: DataFrame | None = None,
               settled: DataFrame | None = None) -> DataFrame:
    """Orders joined 1:1 to everything the reports compute from SKU lines and price rows.

    ``orders`` needs ``id, id_marketplace`` (and whatever the caller groups by).  Adds the SKU
    vector (``total_qty, cogs_*, careos_qty, nutrimom_qty, fee_*``) and, with ``tiktok``, the
    TikTok revenue numerators ``tt_omni_num`` / ``tt_fat_num`` (value = N / 111) for rows where
    ``tiktok_eligible`` holds, and ``tt_has``: the order has a TikTok revenue row (price rows and
    SKU lines), even when its amounts are NULL.  One pass over the SKU table serves revenue, cost of goods and
    packing, and every join is one row per order, so nothing fans out.

    The settlement belongs to a marketplace id.  It is looked up for the narrow rows of TikTok
    orders that have one and joined back by order id (``revenue.settlement_by_order``), so the
    NULL id -- one group that may hold a large share of all orders -- never meets in one task.

    ``prefilter``: for a report window, a cheap superset of the orders (``id, id_marketplace,
    marketplace``; a filtered scan of the order header, no shuffle).  The detail table, the price
    rows and the settlements are semi-joined to it before they are read on.  A superset is
    enough because the joins with ``orders`` decide; it avoids recomputing an expensive order
    set (e.g. after de-duplication) once per semi join.  Whole-history reports leave it off.

    ``settled``: ``settle_id, settlement`` and what else the caller wants of an order's
    settlements, where ``settlement_by_order`` is not enough.
    """
    from .revenue import settlement_by_order, tiktok_price_per_order
    fee_fallback = tiktok.fee_fallback if tiktok else None
    vec = sku_order_vector(cat, variant, fee_fallback, orders=prefilter)
    f = orders.join(vec, orders["id"] == vec["pesanan_id"], how)
    if tiktok is None:
        return f
    elig = F.lit(True) if tiktok_eligible is None else tiktok_eligible
    subset = None if prefilter is None else prefilter.where(F.col("marketplace") == R.TIKTOK)
    price = tiktok_price_per_order(cat, tiktok.keep_total_amount, orders=subset)
    f = f.join(price, f["id"] == price["price_order_id"], "left")
    settle = settlement_by_order(cat, tiktok.settlement_distinct, subset) \
        if settled is None else settled
    f = f.join(settle, f["id"] == settle["settle_id"], "left") \
        .withColumn("settlement", F.when(elig, F.col("settlement")))
    # money numerators keep 6 decimals explicitly: left to type coercion, a COALESCE of a
    # wide decimal(38,2) and a (.., 6) operand can come out as (38, 2) and round every order
    num = "decimal(38,6)"
    fmax, fmin = F.col("fee_max"), F.col("fee_min")
    if tiktok.per_order == "min":
        a = F.col("p_min_pos") * fmax
        b = F.col("p_min_neg") * fmin
        best = F.when(a.isNull(), b).when(b.isNull(), a).otherwise(F.least(a, b))
        settled = F.col("settlement").cast(num) * tiktok.settlement_factor
    else:
        a = F.col("p_pos") * fmax
        b = F.col("p_neg") * fmin
        best = F.when(a.isNull() & b.isNull(), F.lit(None)).otherwise(
            F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0)))
        settled = (F.col("settlement").cast(num) * tiktok.settlement_factor
                   * F.col("n_price_rows").cast("int"))
    has_price = elig & F.col("n_price_rows").isNotNull() & F.col("pesanan_id").isNotNull()
    return f.select("*", has_price.alias("tt_has"),
                    F.when(has_price, F.coalesce(settled.cast(num), best.cast(num)))
                    .alias("tt_omni_num"),
                    F.when(has_price, (F.col("p_sum") * 100).cast(num)).alias("tt_fat_num"))
