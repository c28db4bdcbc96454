"""Source tables stored so that the reports' largest joins need no shuffle.

The order header, the price tables and the SKU lines meet on the order id.  ``store`` writes them
as tables bucketed by it (and sorted within a bucket), with one number of buckets, so a join or an
aggregate by order reads matching buckets side by side.  The SKU table itself knows only the
detail row, so its lines are stored with the order id that the detail table gives them: that join
runs once, where the lines are written, instead of in every report.

``Catalog.from_database`` reads the tables back; the reports are the same code on either catalog.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .catalog import Catalog
from .schemas import SCHEMAS

ORDER_LINES = "order_lines"
#: column that holds the order id, of each table that is bucketed by it
BY_ORDER = {
    "pesanan": "id",
    "pesanan_detail": "pesanan_id",
    "pesanan_pembentuk_harga_shopee": "pesanan_id",
    "pesanan_pembentuk_harga_tiktok_shop": "pesanan_id",
    ORDER_LINES: "pesanan_id",
}


def _write(df: DataFrame, database: str, name: str, n_buckets: int, mode: str) -> None:
    out = df.write.mode(mode).format("parquet")
    key = BY_ORDER.get(name)
    if key is not None:
        # one task a bucket, so that a bucket is one file of each run
        out = df.repartition(n_buckets, key).write.mode(mode).format("parquet") \
            .bucketBy(n_buckets, key).sortBy(key)
    out.saveAsTable(f"{database}.{name}")


def order_lines(cat: Catalog) -> DataFrame:
    """``pesanan_id, nama, qty`` of every SKU line that has a detail row."""
    detail, sku = cat["pesanan_detail"], cat["pesanan_detail_sku"]
    return sku.join(detail, sku["pesanan_detail_id"] == detail["id"]) \
        .select("pesanan_id", "nama", "qty")


def store(cat: Catalog, database: str, n_buckets: int, tables: list[str] | None = None) -> None:
    """Write the tables of ``cat`` (all, or those named) into ``database``, replacing them.

    ``n_buckets``: so many that a bucket of the SKU lines is a few hundred megabytes.  The order
    lines are written whenever the detail or the SKU table is.  NULL order ids share a bucket;
    they match no order.
    """
    spark = cat.spark
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    names = list(SCHEMAS) if tables is None else tables
    for name in names:
        _write(cat[name], database, name, n_buckets, "overwrite")
    if {"pesanan_detail", "pesanan_detail_sku"} & set(names):
        _write(order_lines(cat), database, ORDER_LINES, n_buckets, "overwrite")


def add_orders(spark: SparkSession, batch: Catalog, database: str, n_buckets: int) -> None:
    """Append the order tables of a batch (new orders with all their rows) to stored ones.  A
    bucket has one more file for each batch until ``store`` writes it anew."""
    for name in BY_ORDER:
        rows = order_lines(batch) if name == ORDER_LINES else batch[name]
        _write(rows, database, name, n_buckets, "append")
    _write(batch["pesanan_detail_sku"], database, "pesanan_detail_sku", n_buckets, "append")
