"""Marketing measures: funnel stages, period-over-period orders, budget accrual and use."""

from __future__ import annotations

from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.money import ratio_round
from ..params import ReportParams
from ..sources import Catalog
from . import rules as R
from .orders import orders_with_fields, sku_lines
from .predicates import in_window, not_name_at, valid_status

DESIRE = "decimal(38,4)"
COUNT = "decimal(20,0)"     # holds any bigint


# --- funnel --------------------------------------------------------------------------------------

def funnel_stages(cat: Catalog, params: ReportParams) -> DataFrame:
    """Awareness, interest and desire rows of the five content sources, labelled by group.

    ``+`` propagates NULL on the influencer and affiliate sheets (a missing like drops the
    interest of that row); the internal sheet treats missing counts as 0.
    """
    start, end = params.bounds()

    def src(table, date_col, group, aw, it, de):
        t = cat[table].where(in_window(F.col(date_col), start, end))
        return t.select(F.lit(group).alias("grp"), aw.cast("bigint").alias("awareness"),
                        it.cast("bigint").alias("interest"), de.cast(DESIRE).alias("desire"))

    c = F.col
    z = lambda n: F.coalesce(c(n), F.lit(0))
    parts = [
        src("sheet2_kol_ig", "posting_tanggal_posting", "KOL", c("week1_views"),
            c("week1_koment") + c("week1_like") + c("week1_share"), c("week1_komen_brand")),
        src("sheet2_kol_tt", "tanggal_posting", "KOL", c("views"), c("koment") + c("like"),
            c("views") * c("ctr")),
        src("sheet2_am_tasya", "tanggal_upload", "AM", c("average_views_video_1_pekan"),
            c("comment") + c("likes"),
            F.round(c("average_views_video_1_pekan") * c("ctr"), 0)),
        src("sheet2_am_tama", "tanggal_upload", "AM", c("average_views_video_1_pekan"),
            c("comment") + c("likes"), c("average_views_video_1_pekan") * c("ctr")),
        src("sheet2_internal", "tanggal", "INTERNAL",
            z("week1_views") + z("week1_yellowcart_avg_views"),
            z("week1_comment") + z("week1_like") + z("week1_share") + z("week1_yellowcart_comment")
            + z("week1_yellowcart_likes"),
            z("week1_comment_brand") + z("week1_yellowcart_clicks")),
    ]
    return reduce(DataFrame.unionByName, parts)


FUNNEL_GROUPS = (("KOL", "kol"), ("AM", "am"), ("INTERNAL", "internal"))
FUNNEL_STAGES = ("awareness", "interest", "desire")


def funnel_totals(cat: Catalog, params: ReportParams) -> DataFrame:
    """One row: ``<group>_<stage>`` for groups kol, am, internal and stages awareness,
    interest, desire; an empty group gives 0.

    Counts are summed as decimals (the source's sum of bigints is numeric): a total may pass
    the bigint range.
    """
    s = funnel_stages(cat, params)
    s = s.withColumns({n: F.col(n).cast(COUNT) for n in ("awareness", "interest")})
    aggs = []
    for grp, p in FUNNEL_GROUPS:
        for stage in FUNNEL_STAGES:
            aggs.append(F.coalesce(F.sum(F.when(F.col("grp") == grp, F.col(stage))),
                                   F.lit(0)).alias(f"{p}_{stage}"))
    return s.agg(*aggs)


def _pct(num: Column, den: Column) -> Column:
    """``round(num / nullif(den, 0) * 100, 2)`` in hundredths (bigint)."""
    return F.when(den != 0, ratio_round(num * F.lit(Decimal(100)), den, 2))


def order_counts(cat: Catalog, params: ReportParams) -> DataFrame:
    """Orders of the three funnel shops in the window and in the same window a month earlier.

    Shopee and manual orders count one per Shopee price row (the join rows of the source), TikTok
    orders one per distinct price row when the order has SKU lines.  One flagged pass over the
    orders of both windows; price parts, TikTok price rows and line existence are each reduced
    to one row per order (after a semi join to a cheap, filter-only superset of the orders) and
    joined 1:1.
    """
    codes = params.codes
    cur_s, cur_e = params.bounds()
    pre_s, pre_e = params.prior_month_bounds()
    ts = F.col("created_at")
    in_cur, in_pre = in_window(ts, cur_s, cur_e), in_window(ts, pre_s, pre_e)
    shops = (codes.funnel_shopee_shop, codes.funnel_manual_shop, codes.funnel_tiktok_shop)
    scope = (in_cur | in_pre) & valid_status() & F.col("toko_id").isin(*shops)
    candidates = cat["pesanan"].where(scope).select("id", "marketplace")

    p = orders_with_fields(cat).where(scope)
    t = cat["toko"].select(F.col("id").alias("t_id"), F.col("nama").alias("t_nama"))
    p = p.join(t, p["toko_id"] == t["t_id"], "left")
    mp, shop = F.col("marketplace"), F.col("toko_id")
    at_riva = F.col("t_nama") == F.lit(codes.warehouse_shop_name)
    by_parts = (((mp == R.SHOPEE) & (shop == codes.funnel_shopee_shop))
                | ((mp == R.MANUAL) & (shop == codes.funnel_manual_shop) & F.col("t_id").isNotNull()
                   & ~shop.isin(*codes.test_shops)
                   & not_name_at(F.col("cust_nama"), R.WAREHOUSE_NAME_KEYWORDS_LOOSE, at_riva)))
    by_rows = (mp == R.TIKTOK) & (shop == codes.funnel_tiktok_shop)
    o = p.select("id", in_cur.alias("in_cur"), in_pre.alias("in_pre"),
                 by_parts.alias("by_parts"), by_rows.alias("by_rows"))

    def only(df, key, channels):
        ids = candidates.where(F.col("marketplace").isin(*channels)).select(F.col("id").alias("_c"))
        return df.join(ids, df[key] == ids["_c"], "left_semi")

    parts = only(cat["pesanan_pembentuk_harga_shopee"], "pesanan_id", (R.SHOPEE, R.MANUAL)) \
        .groupBy(F.col("pesanan_id").alias("parts_id")).agg(F.count(F.lit(1)).alias("n_parts"))
    rows = only(cat["pesanan_pembentuk_harga_tiktok_shop"], "pesanan_id", (R.TIKTOK,)) \
        .select("pesanan_id", "original_total_product_price", "seller_discount").distinct() \
        .groupBy(F.col("pesanan_id").alias("rows_id")).agg(F.count(F.lit(1)).alias("n_rows"))
    lined = sku_lines(cat, candidates.where(F.col("marketplace") == R.TIKTOK)) \
        .select(F.col("pesanan_id").alias("lines_id")).distinct()
    j = (o.join(parts, o["id"] == parts["parts_id"], "left")
         .join(rows, F.col("id") == F.col("rows_id"), "left")
         .join(lined, F.col("id") == F.col("lines_id"), "left"))
    n = (F.when(F.col("by_parts"), F.col("n_parts"))
         .when(F.col("by_rows") & F.col("lines_id").isNotNull(), F.col("n_rows"))).cast("bigint")
    cur = F.coalesce(F.sum(F.when(F.col("in_cur"), n)), F.lit(0))
    pre = F.coalesce(F.sum(F.when(F.col("in_pre"), n)), F.lit(0))
    return j.agg(cur.alias("orders_current"), pre.alias("orders_prior"),
                 (cur - pre).alias("total_orders"))


def funnel_ratios(totals: DataFrame, orders: DataFrame) -> DataFrame:
    """Conversion percents (hundredths): interest and desire over awareness; action over desire.

    ``orders`` is a one-row global aggregate; its delta enters as a scalar subquery.
    """
    j = totals.withColumn("total_orders", orders.select("total_orders").scalar())
    cols = []
    for _, p in FUNNEL_GROUPS:
        cols.append(_pct(F.col(f"{p}_interest"), F.col(f"{p}_awareness"))
                    .alias(f"{p}_interest_pct"))
        cols.append(_pct(F.col(f"{p}_desire"), F.col(f"{p}_awareness")).alias(f"{p}_desire_pct"))
    desire = F.col("kol_desire") + F.col("am_desire") + F.col("internal_desire")
    cols.append(_pct(F.col("total_orders"), desire).alias("action_pct"))
    return j.select(*totals.columns, "total_orders", *cols)


# --- budget accrual ------------------------------------------------------------------------------

def budget_by_product_month(cat: Catalog, params: ReportParams) -> DataFrame:
    """Budget accrual per product name and sales month over the budget window.

    One pass over the three channels (the source runs three copies and re-aggregates).  The rate
    depends on the product only, so it multiplies the summed quantity per group.
    """
    codes = params.codes
    start, end = params.budget_bounds()
    p = orders_with_fields(cat)
    mp = F.col("marketplace")
    at_wh = F.col("toko_id") == F.lit(codes.warehouse_shop)
    manual = ((mp == R.MANUAL) & (F.col("cust_tipe") != R.ENDORSE)
              & ~F.col("toko_id").isin(*codes.test_shops) & (F.col("harga") > 0)
              & not_name_at(F.col("cust_nama"), R.WAREHOUSE_NAME_KEYWORDS_LOOSE, at_wh)
              & ~((F.month("created_at") == 6) & F.col("cust_nama").ilike(f"%{R.NAKAMA}%")))
    keep = in_window(F.col("created_at"), start, end) & valid_status() & (
        mp.isin(R.SHOPEE, R.TIKTOK) | manual)
    o = p.where(keep).select("id", F.month("created_at").alias("bulan"))
    lines = sku_lines(cat, o).where(R.matches_any(F.col("nama"), R.BUDGET_PRODUCT_KEYWORDS))
    j = lines.join(o, lines["pesanan_id"] == o["id"])
    g = j.groupBy(F.col("nama").alias("produk"), "bulan").agg(F.sum("qty").alias("qty"))
    return g.select("produk", "bulan", "qty",
                    (F.col("qty") * R.rate_per_unit(F.col("produk"), R.BUDGET_RATES))
                    .alias("total_biaya"))


def budget_matrix(cat: Catalog, params: ReportParams) -> DataFrame:
    """Product x month matrix plus a total row (always present, NULL sums when empty).

    Detail rows and the total come from one aggregate with grouping sets ((product), ()), so
    the SKU lines are read once.  Grouping sets give no total row on empty input, so one marker
    row is added that contributes NULL to every sum (its own product group is dropped).
    """
    r = budget_by_product_month(cat, params).select(
        "produk", "bulan", "total_biaya", F.lit(False).alias("marker"))
    marker = cat.spark.range(1).select(
        F.lit(None).cast("string").alias("produk"), F.lit(None).cast("int").alias("bulan"),
        F.lit(None).cast(r.schema["total_biaya"].dataType).alias("total_biaya"),
        F.lit(True).alias("marker"))
    u = r.unionByName(marker)
    cols = [F.sum(F.when(F.col("marker"), F.lit(None))
                  .when(F.col("bulan") == m, F.col("total_biaya")).otherwise(0)).alias(label)
            for m, label in R.BUDGET_MONTH_LABELS]
    g = u.groupingSets([["produk"], []], "produk").agg(*cols, F.grouping_id().alias("gid"))
    is_total = F.col("gid") == 1
    # products are never NULL here (the keyword filter drops them): a NULL detail key is the marker
    g = g.where(is_total | F.col("produk").isNotNull())
    return g.select(F.when(is_total, F.lit("TOTAL")).otherwise(F.col("produk")).alias("PRODUK"),
                    *[label for _, label in R.BUDGET_MONTH_LABELS], is_total.alias("is_total"))


def budget_and_samples(cat: Catalog, params: ReportParams) -> DataFrame:
    """One row from one pass over the SKU lines: the accrued budget of the calendar month before
    the window (``total_budget_marketing``, NULL when nothing) and the sample costs of the
    window for Shopee (``s``) and TikTok (``t``)."""
    codes = params.codes
    prev_s, prev_e = params.previous_calendar_month()
    start, end = params.bounds()
    p = orders_with_fields(cat)
    mp = F.col("marketplace")
    wh = F.col("toko_id") == F.lit(codes.warehouse_shop)
    manual_ok = ((F.col("cust_tipe") != R.ENDORSE) & ~F.col("toko_id").isin(*codes.test_shops)
                 & (F.col("harga") > 0)
                 & not_name_at(F.col("cust_nama"), (*R.WAREHOUSE_NAME_KEYWORDS_LOOSE, R.NAKAMA), wh))
    in_budget = (in_window(F.col("created_at"), prev_s, prev_e) & valid_status()
                 & mp.isin(R.SHOPEE, R.TIKTOK, R.MANUAL) & ((mp != R.MANUAL) | manual_ok))
    in_win = in_window(F.col("created_at"), start, end) & valid_status()
    is_s = in_win & (F.col("cust_tipe") == R.ENDORSE) & wh \
        & F.col("cust_nama_toko").ilike(f"%{R.SAMPLE_SHOPEE_STORE}%")
    is_t = in_win & ((F.col("toko_id") == F.lit(codes.sample_tiktok_shop))
                     | (wh & F.col("cust_nama_toko").ilike(f"%{R.SAMPLE_TIKTOK_STORE}%")))
    o = p.where(in_budget | is_s | is_t).select(
        "id", in_budget.alias("in_budget"), is_s.alias("is_s"), is_t.alias("is_t"))
    lines = sku_lines(cat, o)
    j = lines.join(o, lines["pesanan_id"] == o["id"])
    budget_line = F.col("in_budget") & R.matches_any(F.col("nama"), R.BUDGET_PRODUCT_KEYWORDS)
    b = F.col("qty") * R.rate_per_unit(F.col("nama"), R.BUDGET_RATES)
    v = F.col("qty") * R.rate_per_unit(F.col("nama"), R.SAMPLE_RATES)
    return j.agg(F.sum(F.when(budget_line, b)).alias("total_budget_marketing"),
                 F.coalesce(F.sum(F.when(F.col("is_s"), v)), F.lit(0)).alias("s"),
                 F.coalesce(F.sum(F.when(F.col("is_t"), v)), F.lit(0)).alias("t"))


def budget_previous_month(cat: Catalog, params: ReportParams) -> DataFrame:
    """Accrued budget of the calendar month before the window (one row, NULL when nothing)."""
    return budget_and_samples(cat, params).select("total_budget_marketing")


def spend_by_category(cat: Catalog, params: ReportParams) -> DataFrame:
    """Spend rows (category, shopee, tiktok, total, src): marketing table per category, samples,
    Facebook ads; ``src`` tells the three apart (a category may come from more than one).  The
    sample row also carries the accrued budget (``total_budget_marketing``, NULL elsewhere):
    both come from the same pass over the SKU lines."""
    codes = params.codes
    start, end = params.bounds()
    money = "decimal(38,2)"
    nb = F.lit(None).cast("bigint").alias("total_budget_marketing")
    m = cat["marketing"].where(in_window(F.col("tanggal"), start, end))
    mk = m.groupBy(F.col("jenis_pengeluaran").alias("pengeluaran")).agg(
        F.sum(F.when(F.col("platform") == R.SHOPEE, F.col("nominal"))).cast(money).alias("shopee"),
        F.sum(F.when(F.col("platform") == R.TIKTOK, F.col("nominal"))).cast(money).alias("tiktok"),
        F.sum("nominal").cast(money).alias("total")).select("*", F.lit("marketing").alias("src"), nb)
    bs = budget_and_samples(cat, params)
    sample = bs.select(
        F.lit("SAMPEL").alias("pengeluaran"), F.col("s").cast(money).alias("shopee"),
        F.col("t").cast(money).alias("tiktok"), (F.col("s") + F.col("t")).cast(money).alias("total"),
        F.lit("sample").alias("src"),
        F.col("total_budget_marketing").cast("bigint").alias("total_budget_marketing"))
    fb = cat["facebook_iklan"].where(
        in_window(F.col("awal_pelaporan"), start, end)
        & (F.col("imported_by") == codes.facebook_importer)
        & (F.col("toko_id") == codes.funnel_manual_shop))
    s = F.sum("jumlah_yang_dibelanjakan").cast(money)
    face = fb.agg(s.alias("shopee"), F.lit(0).cast(money).alias("tiktok"), s.alias("total")) \
        .select(F.lit("IKLAN FACEBOOK").alias("pengeluaran"), "shopee", "tiktok", "total",
                F.lit("facebook").alias("src"), nb)
    return mk.unionByName(sample).unionByName(face)


def budget_use(cat: Catalog, params: ReportParams) -> DataFrame:
    """Spend per category of the fixed list (empty categories kept) plus the total row,
    with the percent of the previous month's accrued budget in tenths.

    Detail rows (one per category and spend source) and the total are one aggregate with
    grouping sets; the SKU lines are read once for samples and budget together.  The budget
    rides on the sample row and is spread over the result rows with a window over that small,
    already aggregated result (one row per spend category, plus the total).
    """
    spark = cat.spark
    cats = spark.createDataFrame([(c,) for c in R.SPEND_CATEGORIES], "pengeluaran STRING")
    g = spend_by_category(cat, params)
    z = lambda c: F.coalesce(F.col(c), F.lit(0))
    detail = cats.join(g, "pengeluaran", "left").select(
        "pengeluaran", "src", z("shopee").alias("shopee"), z("tiktok").alias("tiktok"),
        z("total").alias("total"), "total_budget_marketing")
    a = detail.groupingSets([["pengeluaran", "src"], []], "pengeluaran", "src").agg(
        F.sum("shopee").alias("shopee"), F.sum("tiktok").alias("tiktok"),
        F.sum("total").alias("total"), F.max("total_budget_marketing").alias("b"),
        F.grouping_id().alias("gid"))
    is_total = F.col("gid") != 0
    everything = Window.partitionBy(F.lit(0))   # the handful of report rows
    rows = a.select(F.when(is_total, F.lit("TOTAL SEMUA")).otherwise(F.col("pengeluaran"))
                    .alias("pengeluaran"), "shopee", "tiktok", "total",
                    is_total.alias("is_total"),
                    F.max("b").over(everything).alias("total_budget_marketing"))
    b = F.col("total_budget_marketing")
    tenths = ratio_round(F.col("total") * 100, b, 1)
    return rows.select("*", F.when(b.isNotNull() & (b != 0), tenths).alias("pct_tenths"))


__all__ = ["funnel_stages", "funnel_totals", "order_counts", "funnel_ratios",
           "budget_by_product_month", "budget_matrix", "budget_and_samples", "budget_previous_month",
           "spend_by_category", "budget_use"]
