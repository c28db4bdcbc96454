"""Global order without one task that sees all rows.

``with_position`` numbers rows: each range of the order is ranked by itself, and a range starts
after the rows of all ranges before it.  Only one row a range (its count) is summed in one place.
``write_sorted`` stores rows as files whose names follow the order; ``read_sorted`` numbers them
from the files' own row counts.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def with_position(df: DataFrame, order: Sequence[Column], span: Column,
                  span_order: Callable[[Column], Column], name: str = "position") -> DataFrame:
    """``df`` with the 1-based position of each row in ``order``.

    ``span`` is an expression (a day's month, an id's block) that cuts the order into ranges: in
    ``span_order`` (such as ``lambda c: c.desc_nulls_first()``) its values follow ``order``.  A
    range is ranked in one task, whose rows it must fit.  Ties take any order, so ``order`` should
    be total.  The counts look at the same columns as the ranks, so that both read one shuffle.
    """
    columns = [F.col(f"`{c}`") for c in df.columns]
    ranged = df.withColumn("_span", span)
    seen = F.count(F.when(F.xxhash64(*columns).isNotNull(), 1))
    before = F.sum("_n").over(Window.orderBy(span_order(F.col("_span")))
                              .rowsBetween(Window.unboundedPreceding, -1))
    starts = ranged.groupBy("_span").agg(seen.alias("_n")).select(
        F.col("_span").alias("_of"), F.coalesce(before, F.lit(0)).alias("_start"))
    inside = F.row_number().over(Window.partitionBy("_span").orderBy(*order))
    return ranged.withColumn("_inside", inside).join(
        starts, F.col("_span").eqNullSafe(F.col("_of"))) \
        .select(*columns, (F.col("_start") + F.col("_inside")).cast("int").alias(name))


def write_sorted(df: DataFrame, path: str, order: Sequence[Column]) -> None:
    """Write ``df`` as Parquet files that follow ``order``: ranges of it, each sorted, in files
    whose names ascend with them."""
    df.repartitionByRange(*order).sortWithinPartitions(*order).write.parquet(path)


def read_sorted(spark: SparkSession, path: str, name: str = "position") -> DataFrame:
    """Rows of ``write_sorted`` with their position: the rows of all files before, and the row's
    own place in its file."""
    rows = spark.read.parquet(path).select(
        "*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    before = F.sum("_n").over(Window.orderBy("_of").rowsBetween(Window.unboundedPreceding, -1))
    starts = rows.groupBy(F.col("_file").alias("_of")).agg(F.count("*").alias("_n")) \
        .select("_of", F.coalesce(before, F.lit(0)).alias("_start"))
    return rows.join(starts, F.col("_file") == F.col("_of")) \
        .withColumn(name, F.col("_start") + F.col("_row") + 1) \
        .drop("_file", "_row", "_of", "_start")
