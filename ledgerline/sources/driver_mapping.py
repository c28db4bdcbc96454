"""Source tables derived from the synthetic driver tables (TPC-H-like star schema + events).

Test adapter only: production reads the real tables with ``Catalog.from_parquet``.  Each table is
defined twice from one specification (the table in ``FIXTURES.md`` section 3): as DataFrame code
(``DriverMapping``) and as SQL views (``SQL_VIEWS``) that the DuckDB oracle runs.  Dates of orders
move by +30 years and of events by +17 months so that the report constants fall inside the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .schemas import AD_SOURCES, SCHEMAS

# fixed values of the fixture mapping
PRIORITY_CHANNEL = (("2-HIGH", "TIKTOK_SHOP"), ("3-MEDIUM", "MANUAL"),
                    ("4-NOT SPECIFIED", "KIRIMINAJA"))          # else SHOPEE
STATUS_BY_FLAG = (("F", "SELESAI"), ("O", "DIKIRIM"))
PENDING_STATUS = ("BARU", "DIBATALKAN", "GAGAL_KIRIM", "DIKEMBALIKAN")   # by orderkey % 4
BRANDS = (("red", "Habbie Telon"), ("blue", "Paramorina Madu"), ("large", "Vitabumin Madu 130"),
          ("new", "Vitabumin Madu 60"), ("cold", "Protabumin Careos"),
          ("hot", "Protabumin Nutrimom"), ("old", "Yayle"))         # else Cessa
SIZES = (("ring", "100 ml"), ("bolt", "60 ml"))                     # else the word itself
SEGMENT_SPEND = (("BUILDING", "AM"), ("MACHINERY", "KOL"), ("FURNITURE", "EVENT"),
                 ("HOUSEHOLD", "PROMOSI"))                          # else LAINNYA
OVERHEAD_KIND = ("AFFILIATOR", "CONTENT_CREATOR", "LIVE")           # by suppkey % 3
SHEET_EVENT = (("sheet2_kol_ig", "click"), ("sheet2_kol_tt", "error"),
               ("sheet2_am_tasya", "purchase"), ("sheet2_am_tama", "signup"),
               ("sheet2_internal", "view"))


def _case(col: Column, pairs, default) -> Column:
    expr = None
    for k, v in pairs:
        expr = F.when(col == k, v) if expr is None else expr.when(col == k, v)
    return expr.otherwise(default)


def _money(c: Column) -> Column:
    return c.cast("decimal(18,2)")


def conform(df: DataFrame, name: str) -> DataFrame:
    """Select the declared columns of ``name`` in order, cast to their declared types."""
    from pyspark.sql.types import StructType
    schema = StructType.fromDDL(SCHEMAS[name])
    return df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema.fields])


class DriverMapping:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._raw: dict[str, DataFrame] = {}

    def raw(self, name: str) -> DataFrame:
        """Driver table, read once per mapping (file listing and footers are not repeated)."""
        if name not in self._raw:
            self._raw[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._raw[name]

    def table(self, name: str) -> DataFrame:
        """The derived table, cast to the declared schema of the source table."""
        ad_index = {t: i for i, (t, _, _) in enumerate(AD_SOURCES)}
        if name in ad_index:
            df = self._ad_table(ad_index[name])
        elif name.startswith("sheet2_"):
            df = self._sheet(name)
        else:
            df = getattr(self, "_" + name)()
        return conform(df, name)

    # --- orders ------------------------------------------------------------------------------
    def _orders_customer(self) -> DataFrame:
        o = self.raw("orders")
        c = self.raw("customer")
        return o.join(c, o["o_custkey"] == c["c_custkey"])

    @staticmethod
    def _shifted(c: str = "o_orderdate") -> Column:
        return F.col(c) + F.expr("INTERVAL '30' YEAR")

    def _pesanan(self) -> DataFrame:
        k, ck = F.col("o_orderkey"), F.col("o_custkey")
        pending = _case(k % 4, [(i, s) for i, s in enumerate(PENDING_STATUS)], None)
        nama = (F.when(ck % 13 == 0, F.lit(None).cast("string"))
                .when(ck % 17 == 0, "Gudang A").when(ck % 19 == 0, "Shopee Konsi")
                .otherwise(F.col("c_name")))
        tipe = F.when(ck % 7 == 0, "ENDORSE").when(ck % 5 == 0, F.lit(None).cast("string")) \
            .otherwise("UMUM")
        platform = (F.when(k % 6 == 0, "TIKTOK_SHOP_MANUAL").when(k % 6 == 1, "SHOPEE_MANUAL")
                    .when(k % 6 == 2, F.lit(None).cast("string")).otherwise("OFFLINE"))
        return self._orders_customer().select(
            k.alias("id"),
            F.col("c_nationkey").cast("int").alias("toko_id"),
            _case(F.col("o_orderpriority"), PRIORITY_CHANNEL, "SHOPEE").alias("marketplace"),
            self._shifted().alias("created_at"),
            (ck % 10).cast("int").alias("atur_by"),
            F.when(k % 20 == 0, F.lit(None).cast("bigint")).otherwise(F.floor(k / 2))
            .alias("id_marketplace"),
            _money(F.when(k % 11 == 0, F.lit(0.0)).otherwise(F.col("o_totalprice"))).alias("harga"),
            (k % 6).cast("int").alias("gudang_id"),
            _case(F.col("o_orderstatus"), STATUS_BY_FLAG, pending).alias("status"),
            F.to_json(F.struct(nama.alias("nama"), tipe.alias("tipe"),
                               F.col("c_mktsegment").alias("nama_toko"))).alias("customer"),
            F.to_json(F.struct(platform.alias("platform"),
                               ((k % 50) * 1000).cast("string").alias("ongkir"))).alias("data"),
        )

    def _pesanan_detail(self) -> DataFrame:
        li = self.raw("lineitem")
        return li.select((F.col("l_orderkey") * 100 + F.col("l_linenumber")).alias("id"),
                         F.col("l_orderkey").alias("pesanan_id")).distinct()

    @staticmethod
    def _product_name() -> Column:
        w1 = F.split_part(F.col("p_name"), F.lit(" "), F.lit(1))
        w2 = F.split_part(F.col("p_name"), F.lit(" "), F.lit(2))
        return F.concat(_case(w1, BRANDS, "Cessa"), F.lit(" "), _case(w2, SIZES, w2))

    def product_names(self) -> DataFrame:
        """``Catalog.product_names``: the parts have every name of the lines."""
        return self.raw("part").select(self._product_name().alias("nama"))

    def _pesanan_detail_sku(self) -> DataFrame:
        li, p = self.raw("lineitem"), self.raw("part")
        return li.join(p, li["l_partkey"] == p["p_partkey"]).select(
            (F.col("l_orderkey") * 100 + F.col("l_linenumber")).alias("pesanan_detail_id"),
            self._product_name().alias("nama"),
            F.col("l_quantity").cast("int").alias("qty"))

    def _toko(self) -> DataFrame:
        return self.raw("nation").select(F.col("n_nationkey").cast("int").alias("id"),
                                         F.col("n_name").alias("nama"))

    def _gudang(self) -> DataFrame:
        return self.raw("region").select(F.col("r_regionkey").cast("int").alias("id"),
                                         F.col("r_name").alias("nama"))

    def _users_omni(self) -> DataFrame:
        return self.raw("supplier").select(F.col("s_suppkey").cast("int").alias("id"),
                                           F.col("s_name").alias("name"))

    def _lines_orders(self) -> DataFrame:
        li, o = self.raw("lineitem"), self.raw("orders")
        return li.join(o, li["l_orderkey"] == o["o_orderkey"])

    def _pesanan_pembentuk_harga_shopee(self) -> DataFrame:
        prio, k = F.col("o_orderpriority"), F.col("o_orderkey")
        keep = prio.isin("1-URGENT", "5-LOW") | ((prio == "3-MEDIUM") & (k % 3 == 0))
        sell = _money(F.col("l_extendedprice"))
        qty = _money(F.col("l_quantity"))
        return self._lines_orders().where(keep).select(
            F.col("l_orderkey").alias("pesanan_id"),
            (sell - qty * 10).alias("escrow_amount"),
            sell.alias("order_selling_price"),
            qty.alias("voucher_from_seller"),
            _money(F.col("l_linenumber")).alias("order_ams_commission_fee"))

    def _pesanan_pembentuk_harga_tiktok_shop(self) -> DataFrame:
        price = _money(F.col("o_totalprice"))
        return self.raw("orders").where(F.col("o_orderpriority") == "2-HIGH").select(
            F.col("o_orderkey").alias("pesanan_id"),
            price.alias("total_amount"),
            price.alias("original_total_product_price"),
            _money(F.col("o_orderkey") % 1000).alias("seller_discount"))

    def _lines_orders_customer(self) -> DataFrame:
        c = self.raw("customer")
        lo = self._lines_orders()
        return lo.join(c, lo["o_custkey"] == c["c_custkey"])

    def _tiktok_pencairan(self) -> DataFrame:
        return self._lines_orders_customer().where(F.col("l_returnflag") == "R").select(
            F.floor(F.col("l_orderkey") / 2).alias("order_id"),
            _money(F.col("l_quantity") * 1000).alias("total_settlement_amount"),
            F.col("c_nationkey").cast("int").alias("toko_id"),
            _money(-F.col("l_linenumber")).alias("affiliate_commission"),
            _money(-F.col("l_quantity")).alias("affiliate_shop_ads_commission"))

    def _ad_table(self, i: int) -> DataFrame:
        name, date_col, amount_col = AD_SOURCES[i]
        ts = self._shifted()
        when = ts if name in ("tiktok_proteksi_roas", "shopee_proteksi_roas") else ts.cast("date")
        return self._lines_orders_customer().where(F.col("l_partkey") % 11 == i).select(
            when.alias(date_col),
            F.col("c_nationkey").cast("int").alias("toko_id"),
            _money(F.col("l_quantity")).alias(amount_col))

    def ad_ledger(self, sources, keep) -> DataFrame:
        """``Catalog.ad_ledger`` over the lines that hold all ad tables: the part decides the
        source, so one scan of the lines serves any number of them."""
        index = {t: i for i, (t, _, _) in enumerate(AD_SOURCES)}
        wanted = [(index[t], t) for t, _, _ in sources]
        exact = [t for _, t in wanted if t in ("tiktok_proteksi_roas", "shopee_proteksi_roas")]
        tag, ts = F.col("l_partkey") % 11, self._shifted()
        return self._lines_orders_customer().where(tag.isin(*[i for i, _ in wanted])).select(
            _case(tag, wanted, None).alias("source"),
            F.col("c_nationkey").cast("int").alias("toko_id"),
            ts.cast("timestamp_ntz").alias("at"),
            _money(F.col("l_quantity")).alias("amt")) \
            .select("source", "toko_id", F.when(F.col("source").isin(*exact), F.col("at"))
                    .otherwise(F.col("at").cast("date").cast("timestamp_ntz")).alias("d"), "amt") \
            .where(keep(F.col("d")))

    # --- overhead, rate card, marketing ------------------------------------------------------
    def _beban(self) -> DataFrame:
        s = F.col("s_suppkey")
        return self.raw("supplier").select(
            s.cast("int").alias("id"),
            (s % 5).cast("int").alias("import_id"),
            _case(s % 3, list(enumerate(OVERHEAD_KIND)), None).alias("jenis"),
            (2025 + s % 2).cast("int").alias("tahun"),
            (1 + s % 12).cast("int").alias("bulan"),
            _money(F.abs(F.col("s_acctbal"))).alias("nilai"))

    def _beban_toko(self) -> DataFrame:
        s = self.raw("supplier")
        a = s.select(F.col("s_suppkey").cast("int").alias("beban_id"),
                     F.col("s_nationkey").cast("int").alias("toko_id"))
        b = s.select(F.col("s_suppkey").cast("int").alias("beban_id"),
                     ((F.col("s_nationkey") + 1) % 25).cast("int").alias("toko_id"))
        return a.unionByName(b)

    def _kelontong(self) -> DataFrame:
        return self._orders_customer().where(F.col("o_orderkey") % 13 == 0).select(
            self._shifted().cast("date").alias("tanggal"),
            F.col("c_nationkey").cast("int").alias("toko_id"),
            _money(F.col("o_totalprice")).alias("nominal"))

    def _marketing(self) -> DataFrame:
        k = F.col("o_orderkey")
        return self._orders_customer().where(k % 17 == 0).select(
            _case(F.col("c_mktsegment"), SEGMENT_SPEND, "LAINNYA").alias("jenis_pengeluaran"),
            _money(F.col("o_totalprice")).alias("nominal"),
            _case(k % 3, [(0, "SHOPEE"), (1, "TIKTOK_SHOP")], "LAIN").alias("platform"),
            self._shifted().cast("date").alias("tanggal"))

    def _facebook_iklan(self) -> DataFrame:
        k = F.col("o_orderkey")
        return self._orders_customer().where(k % 19 == 0).select(
            self._shifted().cast("date").alias("awal_pelaporan"),
            F.col("c_nationkey").cast("int").alias("toko_id"),
            (k % 8).cast("int").alias("imported_by"),
            _money(F.col("o_totalprice")).alias("jumlah_yang_dibelanjakan"))

    def _sheet(self, name: str) -> DataFrame:
        event = dict(SHEET_EVENT)[name]
        e = self.raw("events").where(F.col("event_type") == event)
        eid = F.col("event_id")
        d = (F.col("ts") + F.expr("INTERVAL '17' MONTH")).cast("date")
        views = F.floor(F.col("value") * 10).cast("bigint")
        c_user = F.when(eid % 9 == 0, F.lit(None).cast("bigint")).otherwise(F.col("user_id"))
        c_b = F.when(eid % 7 == 0, F.lit(None).cast("bigint")).otherwise(eid % 50)
        c_c = eid % 13
        ctr = (F.col("value") / 100).cast("decimal(9,4)")
        if name == "sheet2_kol_ig":
            cols = [d.alias("posting_tanggal_posting"), views.alias("week1_views"),
                    c_user.alias("week1_koment"), c_b.alias("week1_like"),
                    c_c.alias("week1_share"), (eid % 5).alias("week1_komen_brand")]
        elif name == "sheet2_kol_tt":
            cols = [d.alias("tanggal_posting"), views.alias("views"), c_user.alias("koment"),
                    c_b.alias("like"), ctr.alias("ctr")]
        elif name in ("sheet2_am_tasya", "sheet2_am_tama"):
            cols = [d.alias("tanggal_upload"), views.alias("average_views_video_1_pekan"),
                    c_user.alias("comment"), c_b.alias("likes"), ctr.alias("ctr")]
        else:
            cols = [d.alias("tanggal"), views.alias("week1_views"), c_user.alias("week1_comment"),
                    c_b.alias("week1_like"), c_c.alias("week1_share"),
                    (eid % 5).alias("week1_comment_brand"),
                    F.when(eid % 4 == 0, F.lit(None).cast("bigint")).otherwise(views)
                    .alias("week1_yellowcart_avg_views"),
                    c_user.alias("week1_yellowcart_comment"), c_b.alias("week1_yellowcart_likes"),
                    c_c.alias("week1_yellowcart_clicks")]
        return e.select(*cols)


# ---------------------------------------------------------------------------------------------
# The same tables as DuckDB SQL views (oracle side).
# ---------------------------------------------------------------------------------------------

def _sql_case(col: str, pairs, default: str) -> str:
    def lit(v):
        return f"'{v}'" if isinstance(v, str) else str(v)
    return "CASE " + " ".join(f"WHEN {col} = {lit(k)} THEN {lit(v)}" for k, v in pairs) + \
        f" ELSE {default} END"


_SHIFT = "(o_orderdate + INTERVAL 30 YEAR)"
_OC = "orders JOIN customer ON o_custkey = c_custkey"
_LOC = "lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey"


def _sql_ad(i: int) -> str:
    name, date_col, amount_col = AD_SOURCES[i]
    when = _SHIFT if name in ("tiktok_proteksi_roas", "shopee_proteksi_roas") \
        else f"CAST({_SHIFT} AS DATE)"
    return (f"SELECT {when} AS {date_col}, CAST(c_nationkey AS INTEGER) AS toko_id, "
            f"CAST(l_quantity AS DECIMAL(18,2)) AS {amount_col} FROM {_LOC} "
            f"WHERE l_partkey % 11 = {i}")


def _sql_sheet(name: str) -> str:
    event = dict(SHEET_EVENT)[name]
    d = "CAST(ts + INTERVAL 17 MONTH AS DATE)"
    views = "CAST(floor(value * 10) AS BIGINT)"
    c_user = "CASE WHEN event_id % 9 = 0 THEN NULL ELSE user_id END"
    c_b = "CASE WHEN event_id % 7 = 0 THEN NULL ELSE event_id % 50 END"
    c_c = "event_id % 13"
    ctr = "CAST(value / 100 AS DECIMAL(9,4))"
    if name == "sheet2_kol_ig":
        cols = [f"{d} AS posting_tanggal_posting", f"{views} AS week1_views",
                f"{c_user} AS week1_koment", f"{c_b} AS week1_like", f"{c_c} AS week1_share",
                "event_id % 5 AS week1_komen_brand"]
    elif name == "sheet2_kol_tt":
        cols = [f"{d} AS tanggal_posting", f"{views} AS views", f"{c_user} AS koment",
                f'{c_b} AS "like"', f"{ctr} AS ctr"]
    elif name in ("sheet2_am_tasya", "sheet2_am_tama"):
        cols = [f"{d} AS tanggal_upload", f"{views} AS average_views_video_1_pekan",
                f"{c_user} AS comment", f"{c_b} AS likes", f"{ctr} AS ctr"]
    else:
        cols = [f"{d} AS tanggal", f"{views} AS week1_views", f"{c_user} AS week1_comment",
                f"{c_b} AS week1_like", f"{c_c} AS week1_share",
                "event_id % 5 AS week1_comment_brand",
                f"CASE WHEN event_id % 4 = 0 THEN NULL ELSE {views} END AS week1_yellowcart_avg_views",
                f"{c_user} AS week1_yellowcart_comment", f"{c_b} AS week1_yellowcart_likes",
                f"{c_c} AS week1_yellowcart_clicks"]
    return f"SELECT {', '.join(cols)} FROM events WHERE event_type = '{event}'"


_PENDING = _sql_case("o_orderkey % 4", list(enumerate(PENDING_STATUS)), "NULL")

SQL_VIEWS: dict[str, str] = {
    "pesanan": f"""
SELECT o_orderkey AS id, CAST(c_nationkey AS INTEGER) AS toko_id,
  {_sql_case('o_orderpriority', PRIORITY_CHANNEL, "'SHOPEE'")} AS marketplace,
  {_SHIFT} AS created_at,
  CAST(o_custkey % 10 AS INTEGER) AS atur_by,
  CASE WHEN o_orderkey % 20 = 0 THEN NULL ELSE CAST(o_orderkey // 2 AS BIGINT) END AS id_marketplace,
  CAST(CASE WHEN o_orderkey % 11 = 0 THEN 0 ELSE o_totalprice END AS DECIMAL(18,2)) AS harga,
  CAST(o_orderkey % 6 AS INTEGER) AS gudang_id,
  {_sql_case('o_orderstatus', STATUS_BY_FLAG, _PENDING)} AS status,
  CAST(json_object(
    'nama', CASE WHEN o_custkey % 13 = 0 THEN NULL WHEN o_custkey % 17 = 0 THEN 'Gudang A'
                 WHEN o_custkey % 19 = 0 THEN 'Shopee Konsi' ELSE c_name END,
    'tipe', CASE WHEN o_custkey % 7 = 0 THEN 'ENDORSE' WHEN o_custkey % 5 = 0 THEN NULL
                 ELSE 'UMUM' END,
    'nama_toko', c_mktsegment) AS VARCHAR) AS customer,
  CAST(json_object(
    'platform', CASE WHEN o_orderkey % 6 = 0 THEN 'TIKTOK_SHOP_MANUAL'
                     WHEN o_orderkey % 6 = 1 THEN 'SHOPEE_MANUAL'
                     WHEN o_orderkey % 6 = 2 THEN NULL ELSE 'OFFLINE' END,
    'ongkir', CAST((o_orderkey % 50) * 1000 AS VARCHAR)) AS VARCHAR) AS data
FROM {_OC}""",
    "pesanan_detail": """
SELECT DISTINCT l_orderkey * 100 + l_linenumber AS id, l_orderkey AS pesanan_id FROM lineitem""",
    "pesanan_detail_sku": f"""
SELECT l_orderkey * 100 + l_linenumber AS pesanan_detail_id,
  {_sql_case("split_part(p_name, ' ', 1)", BRANDS, "'Cessa'")} || ' ' ||
  {_sql_case("split_part(p_name, ' ', 2)", SIZES, "split_part(p_name, ' ', 2)")} AS nama,
  CAST(l_quantity AS INTEGER) AS qty
FROM lineitem JOIN part ON l_partkey = p_partkey""",
    "toko": "SELECT CAST(n_nationkey AS INTEGER) AS id, n_name AS nama FROM nation",
    "gudang": "SELECT CAST(r_regionkey AS INTEGER) AS id, r_name AS nama FROM region",
    "users_omni": "SELECT CAST(s_suppkey AS INTEGER) AS id, s_name AS name FROM supplier",
    "pesanan_pembentuk_harga_shopee": """
SELECT l_orderkey AS pesanan_id,
  CAST(l_extendedprice AS DECIMAL(18,2)) - CAST(l_quantity AS DECIMAL(18,2)) * 10 AS escrow_amount,
  CAST(l_extendedprice AS DECIMAL(18,2)) AS order_selling_price,
  CAST(l_quantity AS DECIMAL(18,2)) AS voucher_from_seller,
  CAST(l_linenumber AS DECIMAL(18,2)) AS order_ams_commission_fee
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
WHERE o_orderpriority IN ('1-URGENT', '5-LOW')
   OR (o_orderpriority = '3-MEDIUM' AND o_orderkey % 3 = 0)""",
    "pesanan_pembentuk_harga_tiktok_shop": """
SELECT o_orderkey AS pesanan_id, CAST(o_totalprice AS DECIMAL(18,2)) AS total_amount,
  CAST(o_totalprice AS DECIMAL(18,2)) AS original_total_product_price,
  CAST(o_orderkey % 1000 AS DECIMAL(18,2)) AS seller_discount
FROM orders WHERE o_orderpriority = '2-HIGH'""",
    "tiktok_pencairan": f"""
SELECT CAST(l_orderkey // 2 AS BIGINT) AS order_id,
  CAST(l_quantity * 1000 AS DECIMAL(18,2)) AS total_settlement_amount,
  CAST(c_nationkey AS INTEGER) AS toko_id,
  CAST(-l_linenumber AS DECIMAL(18,2)) AS affiliate_commission,
  CAST(-l_quantity AS DECIMAL(18,2)) AS affiliate_shop_ads_commission
FROM {_LOC} WHERE l_returnflag = 'R'""",
    "beban": f"""
SELECT CAST(s_suppkey AS INTEGER) AS id, CAST(s_suppkey % 5 AS INTEGER) AS import_id,
  {_sql_case('s_suppkey % 3', list(enumerate(OVERHEAD_KIND)), 'NULL')} AS jenis,
  CAST(2025 + s_suppkey % 2 AS INTEGER) AS tahun, CAST(1 + s_suppkey % 12 AS INTEGER) AS bulan,
  CAST(abs(s_acctbal) AS DECIMAL(18,2)) AS nilai
FROM supplier""",
    "beban_toko": """
SELECT CAST(s_suppkey AS INTEGER) AS beban_id, CAST(s_nationkey AS INTEGER) AS toko_id FROM supplier
UNION ALL
SELECT CAST(s_suppkey AS INTEGER), CAST((s_nationkey + 1) % 25 AS INTEGER) FROM supplier""",
    "kelontong": f"""
SELECT CAST({_SHIFT} AS DATE) AS tanggal, CAST(c_nationkey AS INTEGER) AS toko_id,
  CAST(o_totalprice AS DECIMAL(18,2)) AS nominal
FROM {_OC} WHERE o_orderkey % 13 = 0""",
    "marketing": f"""
SELECT {_sql_case('c_mktsegment', SEGMENT_SPEND, "'LAINNYA'")} AS jenis_pengeluaran,
  CAST(o_totalprice AS DECIMAL(18,2)) AS nominal,
  {_sql_case('o_orderkey % 3', [(0, 'SHOPEE'), (1, 'TIKTOK_SHOP')], "'LAIN'")} AS platform,
  CAST({_SHIFT} AS DATE) AS tanggal
FROM {_OC} WHERE o_orderkey % 17 = 0""",
    "facebook_iklan": f"""
SELECT CAST({_SHIFT} AS DATE) AS awal_pelaporan, CAST(c_nationkey AS INTEGER) AS toko_id,
  CAST(o_orderkey % 8 AS INTEGER) AS imported_by,
  CAST(o_totalprice AS DECIMAL(18,2)) AS jumlah_yang_dibelanjakan
FROM {_OC} WHERE o_orderkey % 19 = 0""",
}
SQL_VIEWS.update({t: _sql_ad(i) for i, (t, _, _) in enumerate(AD_SOURCES)})
SQL_VIEWS.update({t: _sql_sheet(t) for t, _ in SHEET_EVENT})


def sql_with_views(select: str, ctes: str = "") -> str:
    """``WITH <views used>, <ctes> <select>``: DuckDB runs it on the driver tables."""
    import re
    text = ctes + select
    used = [n for n in SQL_VIEWS if re.search(rf"\b{n}\b", text)]
    parts = [f"{n} AS ({SQL_VIEWS[n].strip()})" for n in used]
    if ctes.strip():
        parts.append(ctes.strip())
    return ("WITH " + ",\n".join(parts) + "\n" + select) if parts else select
