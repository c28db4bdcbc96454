"""Typed access to the JSON text columns of the order header.

``from_json`` parses once per row and Catalyst prunes the schema to the fields a query uses;
a missing key or malformed text gives NULL, which the three-valued filters rely on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CUSTOMER_SCHEMA = "nama STRING, tipe STRING, nama_toko STRING"
DATA_SCHEMA = "platform STRING, ongkir STRING"


def with_order_fields(orders: DataFrame) -> DataFrame:
    """Add ``cust_nama, cust_tipe, cust_nama_toko, platform, ongkir_text`` to ``pesanan``."""
    cust = F.from_json("customer", CUSTOMER_SCHEMA)
    data = F.from_json("data", DATA_SCHEMA)
    return orders.select(
        "*",
        cust["nama"].alias("cust_nama"),
        cust["tipe"].alias("cust_tipe"),
        cust["nama_toko"].alias("cust_nama_toko"),
        data["platform"].alias("platform"),
        data["ongkir"].alias("ongkir_text"),
    )


def amount(text: Column, strict: bool = False, kind: str = "decimal(18,2)") -> Column:
    """A JSON text as a number.  Text that is no number gives NULL; ``strict``: it ends the job, as
    a cast does in the source's database."""
    return text.cast(kind) if strict else text.try_cast(kind)


def rejected_fields(orders: DataFrame) -> DataFrame:
    """``id, created_at, field, value, reason`` of the JSON fields that the reports cannot read.

    Each JSON column is parsed once (to a VARIANT).  ``reason``: ``json`` for text that is no JSON
    object (value: the text), ``number`` for a shipping cost that is no number (value: it).  A
    missing or null field is no fault, neither is a NULL column.
    """
    parsed = orders.select("id", "created_at", "customer", "data",
                           F.try_parse_json("customer").alias("c"), F.try_parse_json("data").alias("d"))

    def broken(field: str, text: str, v: str) -> Column:
        whole = F.schema_of_variant(v).startswith("OBJECT")
        bad = F.col(text).isNotNull() & ~F.coalesce(whole, F.lit(False))
        return F.when(bad, F.struct(F.lit(field).alias("field"), F.col(text).alias("value"),
                                    F.lit("json").alias("reason")))
    shipping = F.try_variant_get("d", "$.ongkir", "string")
    no_number = F.when(shipping.isNotNull() & amount(shipping).isNull(), F.struct(
        F.lit("data.ongkir").alias("field"), shipping.alias("value"), F.lit("number").alias("reason")))
    faults = F.filter(F.array(broken("customer", "customer", "c"), broken("data", "data", "d"),
                              no_number), lambda x: x.isNotNull())
    return parsed.select("id", "created_at", F.explode(faults).alias("f")) \
        .select("id", "created_at", "f.*")
