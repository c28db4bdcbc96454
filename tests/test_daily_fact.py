"""The materialised shop-day fact refreshes single months idempotently."""

import pytest
from pyspark.sql import functions as F

from ledgerline.params import ReportParams
from ledgerline.plans.registry import catalog_for
from ledgerline.plans.reports import shop_day_shopee
from ledgerline.streaming import read_daily_fact, refresh_shopee_daily_fact
from ledgerline.streaming.daily_fact import write_partitioned

SF = "/root/testdata/sf0.001"
FACT = "toko bigint, tanggal date, tahun bigint, bulan bigint, omset double"


def test_refresh_replaces_only_given_months(spark, tmp_path):
    cat = catalog_for(spark, SF)
    params = ReportParams.for_fixture()
    path = str(tmp_path / "fact")
    refresh_shopee_daily_fact(cat, params, path)
    rows = lambda df: sorted(map(str, df.select(sorted(df.columns)).collect()))
    full = rows(read_daily_fact(spark, path))
    assert full == rows(shop_day_shopee(cat, params))
    month = read_daily_fact(spark, path).groupBy("tahun", "bulan").count() \
        .orderBy(F.desc("count")).first()
    for _ in range(2):
        refresh_shopee_daily_fact(cat, params, path, months=[(month.tahun, month.bulan)])
    assert rows(read_daily_fact(spark, path)) == full           # the same rows, no duplicates
    one = read_daily_fact(spark, path, month.tahun, month.bulan)
    assert one.count() == month["count"]
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(tahun" in plan


def test_month_without_rows_is_emptied(spark, tmp_path):
    path = str(tmp_path / "fact")
    mode = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    make = lambda *days: spark.sql(" UNION ALL ".join(
        f"SELECT 1L AS toko, DATE '2025-{m:02}-01' AS tanggal, 2025L AS tahun, {m}L AS bulan, 1D AS omset"
        for m in days)) if days else spark.createDataFrame([], FACT)
    months = lambda: sorted(r[0] for r in spark.read.parquet(path).select("bulan").collect())
    write_partitioned(make(2, 3, 4), path)
    assert months() == [2, 3, 4]
    write_partitioned(make(4), path, months=[(2025, 3), (2025, 4)])
    assert months() == [2, 4]
    write_partitioned(make(), path, months=[(2025, 4)])
    assert months() == [2]
    with pytest.raises(ValueError, match="not refreshed"):
        write_partitioned(make(2, 5), path, months=[(2025, 5)])
    assert months() == [2]
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == mode
