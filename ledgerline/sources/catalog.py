"""Where the report operators get their tables from.

A ``Catalog`` hands out one DataFrame per source table.  In production the tables are Parquet
datasets (ideally the order facts partitioned by month and bucketed by order id); for the
synthetic test tables ``from_driver_tables`` derives the same tables with DataFrame
transformations (see ``driver_mapping``).  Reading is lazy: Catalyst prunes columns and pushes
filters into each scan.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .schemas import AD_SOURCES, SCHEMAS

AdSource = tuple[str, str, str]
Keep = Callable[[Column], Column]


class Catalog:
    """The source tables, and what a catalog knows beyond them:

    ``ad_ledger``: how ad tables that share one base are read in one scan.
    ``order_lines``: SKU lines stored with their order id (``pesanan_id, nama, qty``), so that no
    report joins them with the detail table again.
    ``product_names``: a small relation that has every product name of the SKU lines.
    ``products``: a stored product dictionary (``operators.products``), which may lack new names.
    """

    def __init__(self, spark: SparkSession, loader: Callable[[str], DataFrame],
                 ad_ledger: Callable[[Sequence[AdSource], Keep], DataFrame] | None = None,
                 order_lines: DataFrame | None = None,
                 product_names: Callable[[], DataFrame] | None = None,
                 products: DataFrame | None = None):
        self.spark = spark
        self._loader = loader
        self._ad_ledger = ad_ledger
        self.order_lines = order_lines
        self.product_names = product_names
        self.products = products
        self._cache: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in SCHEMAS:
            raise KeyError(f"unknown source table {name!r}")
        if name not in self._cache:
            self._cache[name] = self._loader(name)
        return self._cache[name]

    __getitem__ = table

    def ad_ledger(self, sources: Sequence[AdSource] = AD_SOURCES,
                  keep: Keep | None = None) -> DataFrame:
        """``source, toko_id, d, amt``: the rows of several ad tables as one tagged relation.

        Reports aggregate it once, with the source as a condition, instead of once a table.
        ``keep`` gives a condition on a date column; it is applied to each table's own column, so
        that it reaches the scan.  ``d`` is a timestamp (midnight where the table has days).
        """
        keep = keep or (lambda d: F.lit(True))
        if self._ad_ledger is not None:
            return self._ad_ledger(sources, keep)
        return reduce(DataFrame.unionAll, [
            self[table].where(keep(F.col(day))).select(
                F.lit(table).alias("source"), "toko_id",
                F.col(day).cast("timestamp_ntz").alias("d"), F.col(amount).alias("amt"))
            for table, day, amount in sources])

    @staticmethod
    def from_parquet(spark: SparkSession, root: str, products: str | None = None) -> "Catalog":
        """One Parquet dataset per table under ``root/<table>``, read with the fixed schema.
        ``products``: path of a stored product dictionary."""
        return Catalog(spark, lambda n: spark.read.schema(SCHEMAS[n]).parquet(f"{root}/{n}"),
                       products=None if products is None else spark.read.parquet(products))

    @staticmethod
    def from_database(spark: SparkSession, database: str) -> "Catalog":
        """Tables that ``sources.bucketed.store`` wrote."""
        from .bucketed import ORDER_LINES
        return Catalog(spark, lambda n: spark.table(f"{database}.{n}"),
                       order_lines=spark.table(f"{database}.{ORDER_LINES}"))

    @staticmethod
    def from_frames(spark: SparkSession, frames: dict[str, DataFrame]) -> "Catalog":
        """Tables given as DataFrames (tests with hand-made rows); missing tables are empty."""
        def load(n: str) -> DataFrame:
            if n in frames:
                return frames[n]
            return spark.createDataFrame([], SCHEMAS[n])
        return Catalog(spark, load)

    @staticmethod
    def from_driver_tables(spark: SparkSession, sf_dir: str) -> "Catalog":
        """Source tables derived from the synthetic driver tables, lazily: every query derives
        the tables that it reads inside its own plan, nothing is written or run beforehand."""
        from .driver_mapping import DriverMapping
        mapping = DriverMapping(spark, sf_dir)
        return Catalog(spark, mapping.table, mapping.ad_ledger,
                       product_names=mapping.product_names)
