"""Which months of the shop-day fact have changed: fingerprints of its inputs.

Every input table is reduced to one row a month: how many rows it has there, and the sum and the
exclusive-or of the rows' hashes.  Both are independent of order and merge by addition, so they
are plain aggregates with partial sums.  Rows without a date of their own (SKU lines, price parts)
count in the month of their order; tables that every month reads (shops, parameters) are kept
under the month ``EVERY``.  A month whose fingerprints differ from those of the last refresh is
computed anew; a row that moved to another month changes both.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.costs import SHOPEE_AD_SOURCES
from ..operators.orders import sku_lines
from ..params import ReportParams
from ..sources import Catalog

EVERY = (0, 0)
PRINT = "source string, tahun int, bulan int, n bigint, total decimal(38,0), mixed bigint"


def _printed(rows: DataFrame, source: str, hashed: Column, year: Column, month: Column,
             n: Column | None = None) -> DataFrame:
    h = rows.select(year.cast("int").alias("tahun"), month.cast("int").alias("bulan"),
                    hashed.alias("h"), (F.lit(1) if n is None else n).cast("bigint").alias("k"))
    return h.where("tahun IS NOT NULL AND bulan IS NOT NULL").groupBy("tahun", "bulan").agg(
        F.sum("k").alias("n"), F.sum(F.col("h").cast("decimal(38,0)")).alias("total"),
        F.bit_xor("h").alias("mixed")).select(
        F.lit(source).alias("source"), "tahun", "bulan", "n", "total", "mixed")


def _row_hash(df: DataFrame) -> Column:
    """Of all columns; NULLs count by their place."""
    return F.xxhash64(*[x for c in df.columns for x in (F.col(f"`{c}`"), F.col(f"`{c}`").isNull())])


def shopee_fact_fingerprints(cat: Catalog, params: ReportParams) -> DataFrame:
    """``source, tahun, bulan, n, total, mixed`` of everything the Shopee shop-day fact reads."""
    orders = cat["pesanan"]
    at = F.col("created_at")
    year, month = F.year(at), F.month(at)
    out = [_printed(orders, "pesanan", _row_hash(orders), year, month)]
    # rows of an order are summed up by order first, so one row an order meets the header
    header = orders.select("id", "created_at")
    lines, parts = sku_lines(cat), cat["pesanan_pembentuk_harga_shopee"]
    for name, rows in (("pesanan_detail_sku", lines), ("pesanan_pembentuk_harga_shopee", parts)):
        # (a sum that overflows would end the job: decimals, and their low digits as the hash)
        by_order = rows.groupBy("pesanan_id").agg(
            F.count("*").alias("k"), F.bit_xor(_row_hash(rows)).alias("x"),
            F.sum(_row_hash(rows).cast("decimal(38,0)")).alias("s"))
        j = by_order.join(header, by_order["pesanan_id"] == header["id"])
        out.append(_printed(j, name, F.xxhash64("pesanan_id", "k", "x", "s"), year, month, F.col("k")))
    for table, day, _ in SHOPEE_AD_SOURCES:
        rows = cat[table]
        out.append(_printed(rows, table, _row_hash(rows), F.year(day), F.month(day)))
    # an import's whole counts the orders of all its shops, whichever month linked them
    links = cat["beban"].join(cat["beban_toko"], F.col("id") == F.col("beban_id")) \
        .groupBy("import_id", "jenis", "toko_id", "tahun", "bulan").agg(
            F.sum("nilai").alias("nilai"))
    out.append(_printed(links, "beban", _row_hash(links), F.col("tahun"), F.col("bulan")))
    shops = links.groupBy("import_id", "jenis").agg(
        F.collect_set(F.struct("tahun", "bulan")).alias("entries"),
        F.sort_array(F.collect_set("toko_id")).alias("shops"))
    months = shops.select("import_id", "jenis", "shops", F.explode("entries").alias("e"))
    out.append(_printed(months, "beban_toko", F.xxhash64("import_id", "jenis", "shops"),
                        F.col("e.tahun"), F.col("e.bulan")))
    every = [F.lit(x) for x in EVERY]
    toko = cat["toko"]
    out.append(_printed(toko, "toko", _row_hash(toko), *every))
    one = cat.spark.range(1).select(F.lit(repr((params.codes, params.strict_json))).alias("p"))
    out.append(_printed(one, "params", F.xxhash64("p"), *every))
    return reduce(DataFrame.unionByName, out)


def changed_months(old: DataFrame | None, new: DataFrame) -> list[tuple[int, int]] | None:
    """Months whose fingerprints differ, in order; None if every month may differ.

    The months of a fact are few, so the list is collected.
    """
    if old is None:
        return None
    keys = ["source", "tahun", "bulan"]
    values = ["n", "total", "mixed"]
    a = old.select(*keys, F.struct(*values).alias("a"))
    b = new.select(*keys, F.struct(*values).alias("b"))
    differ = a.join(b, keys, "full").where(~F.col("a").eqNullSafe(F.col("b")))
    found = sorted({(r["tahun"], r["bulan"]) for r in differ.select("tahun", "bulan").distinct().collect()})
    return None if EVERY in found else found
