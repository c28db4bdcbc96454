"""Month-partitioned, idempotent materialisation of the Shopee shop-day fact (report R6)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..params import ReportParams
from ..plans.reports import shop_day_shopee
from ..sources import Catalog
from .changes import EVERY, PRINT, changed_months, shopee_fact_fingerprints

PARTITIONS = ("tahun", "bulan")
#: fingerprints of the inputs, beside the month partitions (readers skip the folder)
PRINTS = "_fingerprints"
Months = list[tuple[int, int]]


def _filesystem(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def write_partitioned(df: DataFrame, path: str, months: Months | None = None,
                      spread_by: tuple[str, ...] = ("toko",)) -> None:
    """Replace month partitions of ``path`` by the rows of ``df``.

    ``months``: exactly these are replaced; one without rows in ``df`` is emptied, and a frame
    with rows of another month is refused before anything is changed.  Without ``months`` the
    months that ``df`` has are replaced.

    ``df`` runs once, into a folder beside the partitions (``_refresh-...``, which readers skip):
    from there its months are known and the partitions are overwritten by the writer's own
    dynamic mode, without a change to the session.  Rows are spread by ``spread_by``, so several
    tasks write a month.  A run that fails can be repeated; it has replaced a month or left it.
    """
    spark = df.sparkSession
    staged_at = f"{path}/_refresh-{uuid.uuid4().hex[:12]}"
    keys = [*PARTITIONS, *[c for c in spread_by if c in df.columns]]
    try:
        df.repartition(*keys).write.parquet(staged_at)
        staged = spark.read.parquet(staged_at)
        found = {(r[0], r[1]) for r in staged.select(*PARTITIONS).distinct().collect()}
        if months is not None and not found <= set(months):
            raise ValueError(f"rows of months that are not refreshed: {sorted(found - set(months))}")
        staged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
            .partitionBy(*PARTITIONS).parquet(path)
        for year, month in set(months or ()) - found:
            at, fs = _filesystem(spark, f"{path}/tahun={year}/bulan={month}")
            fs.delete(at, True)
    finally:
        at, fs = _filesystem(spark, staged_at)
        fs.delete(at, True)


def refresh_shopee_daily_fact(cat: Catalog, params: ReportParams, path: str,
                              months: Months | None = None) -> None:
    """Recompute the shop-day fact of the given ``(year, month)`` months and replace them (all
    months that occur when ``months`` is None).  The months bound every dated scan."""
    write_partitioned(shop_day_shopee(cat, params, months), path, months)


def _last_prints(spark: SparkSession, path: str) -> tuple[DataFrame | None, list[str]]:
    """The fingerprints of the last refresh, and the folders of all kept ones."""
    at, fs = _filesystem(spark, f"{path}/{PRINTS}")
    if not fs.exists(at):
        return None, []
    runs = sorted(x.getPath().getName() for x in fs.listStatus(at)
                  if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(x.getPath(), "_SUCCESS")))
    if not runs:
        return None, []
    return spark.read.schema(PRINT).parquet(f"{path}/{PRINTS}/{runs[-1]}"), runs


def refresh_changed(cat: Catalog, params: ReportParams, path: str) -> list[tuple[int, int]] | None:
    """Bring the fact up to date: computes the months whose inputs changed since the last call,
    and returns them (None: all months, as after a change of shops, parameters or the first time).

    The inputs' fingerprints are taken before the months are computed and kept beside the fact
    after they are replaced: what changes in between, or a run that fails, is seen again by the
    next call.
    """
    spark = cat.spark
    old, runs = _last_prints(spark, path)
    number = int(runs[-1].removeprefix("run-")) + 1 if runs else 0
    staged = f"{path}/_prints-{uuid.uuid4().hex[:12]}"
    at, fs = _filesystem(spark, staged)
    try:
        shopee_fact_fingerprints(cat, params).write.parquet(staged)
        new = spark.read.schema(PRINT).parquet(staged)
        months = changed_months(old, new)
        if old is None:
            refresh_shopee_daily_fact(cat, params, path)
        elif months is None:
            # every month that inputs or the fact have, so that months without rows are emptied
            known = {(r[0], r[1]) for r in new.unionByName(old).select("tahun", "bulan")
                     .distinct().collect()} - {EVERY}
            refresh_shopee_daily_fact(cat, params, path, sorted(known))
        elif months:
            refresh_shopee_daily_fact(cat, params, path, months)
        if months is None or months:
            keep, _ = _filesystem(spark, f"{path}/{PRINTS}/run-{number:012d}")
            fs.mkdirs(keep.getParent())
            fs.rename(at, keep)
            for run in runs:
                fs.delete(spark._jvm.org.apache.hadoop.fs.Path(keep.getParent(), run), True)
    finally:
        fs.delete(at, True)
    return months


def read_daily_fact(spark: SparkSession, path: str, year: int | None = None,
                    month: int | None = None) -> DataFrame:
    """Read the fact back; year/month filters prune partitions (directory listing only)."""
    df = spark.read.parquet(path)
    if year is not None:
        df = df.where(F.col("tahun") == year)
    if month is not None:
        df = df.where(F.col("bulan") == month)
    return df
