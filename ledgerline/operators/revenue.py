"""Net revenue per channel (Shopee price parts, TikTok settlement or fee rule, manual price).

Revenue values are carried as exact decimal numerators ``N`` with ``value = N / 111`` and turned
into cents once, after the last sum (``functions.money``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources import Catalog
from . import rules as R
from .orders import sku_order_vector


def _only_for(df: DataFrame, key: str, orders: DataFrame | None, order_key: str) -> DataFrame:
    """Semi-join ``df`` to a (selective) order set before aggregating it; AQE broadcasts a small
    order set, so the large table is filtered map-side without a shuffle."""
    if orders is None:
        return df
    ids = orders.select(F.col(order_key).alias("_only_id"))
    return df.join(ids, df[key] == ids["_only_id"], "left_semi")


def settlement_per_order(cat: Catalog, distinct: bool, orders: DataFrame | None = None) -> DataFrame:
    """Settled amount per marketplace order: ``SUM(DISTINCT)`` or plain ``SUM`` (per report).
    With ``orders`` only their marketplace ids are aggregated."""
    tp = _only_for(cat["tiktok_pencairan"], "order_id", orders, "id_marketplace")
    agg = F.sum_distinct if distinct else F.sum
    return tp.groupBy("order_id").agg(agg("total_settlement_amount").alias("settlement"))


def settlement_by_order(cat: Catalog, distinct: bool,
                        orders: DataFrame | None = None) -> DataFrame:
    """``settle_id, settlement``: the settled amount of every TikTok order that has one.

    Two numbers of each TikTok order with a marketplace id meet the settlements; callers join
    the result by order id.  ``orders``: a selective set of TikTok orders to look up.
    """
    header = cat["pesanan"].where(F.col("marketplace") == R.TIKTOK) if orders is None else orders
    header = header.where(F.col("id_marketplace").isNotNull()) \
        .select(F.col("id").alias("settle_id"), F.col("id_marketplace").alias("_mp"))
    settled = settlement_per_order(cat, distinct, orders)
    return header.join(settled, header["_mp"] == settled["order_id"]) \
        .select("settle_id", "settlement")


def settlement_with_commissions(cat: Catalog) -> DataFrame:
    """``settle_id, settlement, commissions`` of every order whose marketplace id was settled.

    One pass over the settlements serves both the settled amount of TikTok orders (plain sum) and
    the affiliate commissions of orders of any channel, an array of ``toko_id, aff_a, aff_b`` with
    one entry a settled shop.
    """
    per_shop = cat["tiktok_pencairan"].groupBy("order_id", "toko_id").agg(
        F.sum("total_settlement_amount").alias("amount"),
        F.sum("affiliate_commission").alias("aff_a"),
        F.sum("affiliate_shop_ads_commission").alias("aff_b"))
    per_order = per_shop.groupBy("order_id").agg(
        F.sum("amount").alias("settlement"),
        F.collect_list(F.struct("toko_id", "aff_a", "aff_b")).alias("commissions"))
    def narrow(channel):
        return cat["pesanan"].where(channel & F.col("id_marketplace").isNotNull()) \
            .select(F.col("id").alias("settle_id"), F.col("id_marketplace").alias("_mp"))
    tiktok = F.col("marketplace") == R.TIKTOK
    header = narrow(tiktok).withColumn("_own", F.lit(True)).unionAll(
        narrow(~tiktok | F.col("marketplace").isNull()).withColumn("_own", F.lit(False)))
    return header.join(per_order, header["_mp"] == per_order["order_id"]).select(
        "settle_id", F.when(F.col("_own"), F.col("settlement")).alias("settlement"), "commissions")


def shopee_parts_per_order(cat: Catalog, orders: DataFrame | None = None) -> DataFrame:
    """Shopee price parts reduced to one row per order before any join (parts may repeat).
    With ``orders`` (a selective set with ``id``) only their parts are read on."""
    ph = _only_for(cat["pesanan_pembentuk_harga_shopee"], "pesanan_id", orders, "id")
    return ph.groupBy("pesanan_id").agg(
        F.count(F.lit(1)).alias("n_parts"),
        F.sum("escrow_amount").alias("escrow_sum"),
        F.sum(F.col("order_selling_price") - F.col("voucher_from_seller")).alias("fat_sum"),
        F.sum("order_ams_commission_fee").alias("commission_sum"),
        F.min("escrow_amount").alias("escrow_min"),
    )


def tiktok_order_revenue(cat: Catalog, orders: DataFrame, fee_fallback: str | None,
                         settlement: DataFrame | None, settlement_factor: int = 100,
                         keep_total_amount: bool = False) -> DataFrame:
    """TikTok revenue per order and price row.

    ``orders`` must have ``id, id_marketplace``; its other columns are carried along.
    ``omni_num = coalesce(settlement * settlement_factor, max over SKUs of price * (1-fee)*100)``
    and ``fat_num = price * 100`` where price = original price - seller discount; both / 111.
    ``settlement``: ``settlement_by_order``, or None to leave it out.
    ``settlement_factor`` 100 nets the settlement of VAT, 111 keeps it gross.
    Orders without SKU lines or price rows drop out (inner joins, as in the source).
    """
    keys = ["pesanan_id", "original_total_product_price", "seller_discount"]
    if keep_total_amount:
        keys.append("total_amount")
    price_rows = cat["pesanan_pembentuk_harga_tiktok_shop"].select(*keys).distinct()
    vec = sku_order_vector(cat, R.COGS_ORDER_LEVEL, fee_fallback) \
        .select(F.col("pesanan_id").alias("v_id"), "fee_max", "fee_min")
    j = (orders.join(price_rows, orders["id"] == price_rows["pesanan_id"])
         .join(vec, F.col("id") == F.col("v_id")))
    if settlement is not None:
        j = j.join(settlement, j["id"] == settlement["settle_id"], "left")
    price = F.col("original_total_product_price") - F.col("seller_discount")
    best = F.when(price >= 0, price * F.col("fee_max")).otherwise(price * F.col("fee_min"))
    num = "decimal(38,6)"       # explicit: type coercion could drop decimals in the COALESCE
    omni = F.coalesce((F.col("settlement") * settlement_factor).cast(num), best.cast(num)) \
        if settlement is not None else best.cast(num)
    return j.select(*orders.columns, *[c for c in keys if c != "pesanan_id"],
                    omni.alias("omni_num"), (price * 100).alias("fat_num"))


def tiktok_price_per_order(cat: Catalog, keep_total_amount: bool = False,
                           orders: DataFrame | None = None) -> DataFrame:
    """TikTok price rows reduced to one row per order (distinct price rows first, as the source
    groups by them).  ``price = original price - seller discount``; sums and minima are split by
    sign so that "best fee-adjusted amount per price row" aggregates exactly without the rows.

    Both steps are hash aggregates with map-side partial aggregation: the distinct shuffles by
    the whole price row, so even an order with a very large share of all price rows is spread
    over many tasks, and the per-order sums then combine partial results.
    """
    keys = ["pesanan_id", "original_total_product_price", "seller_discount"]
    if keep_total_amount:
        keys.append("total_amount")
    ph = _only_for(cat["pesanan_pembentuk_harga_tiktok_shop"], "pesanan_id", orders, "id")
    rows = ph.select(*keys).distinct()
    price = F.col("original_total_product_price") - F.col("seller_discount")
    return rows.groupBy(F.col("pesanan_id").alias("price_order_id")).agg(
        F.count(F.lit(1)).alias("n_price_rows"),
        F.sum(F.when(price >= 0, price)).alias("p_pos"),
        F.sum(F.when(price < 0, price)).alias("p_neg"),
        F.min(F.when(price >= 0, price)).alias("p_min_pos"),
        F.min(F.when(price < 0, price)).alias("p_min_neg"),
        F.sum(price).alias("p_sum"))
