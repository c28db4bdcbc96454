"""Guards on the physical plans: the properties the design relies on at scale."""

import pytest

from ledgerline.operators.orders import clean_orders
from ledgerline.params import ReportParams
from ledgerline.plans import reports as RP
from ledgerline.plans.registry import QUERIES, catalog_for
from ledgerline.sources import AD_SOURCES, SCHEMAS, Catalog

SF = "/root/testdata/sf0.001"
PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas",
                "PythonUDF")


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cartesian_no_python(spark, name):
    p = _plan(QUERIES[name](spark, SF))
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p
    assert not any(n in p for n in PYTHON_NODES)


def test_dedup_limits_groups_before_the_shuffle(spark):
    cat = catalog_for(spark, SF)
    p = _plan(clean_orders(cat, ReportParams.for_fixture(), "order_level"))
    assert "WindowGroupLimit" in p and "Partial" in p and "Final" in p


def test_window_reaches_parquet_scan(spark, tmp_path):
    cat = catalog_for(spark, SF)
    for n in ("pesanan", "gudang", "toko"):
        cat[n].write.parquet(str(tmp_path / n))
    real = Catalog.from_parquet(spark, str(tmp_path))
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    try:
        p = _plan(clean_orders(real, ReportParams.for_fixture(), "order_level"))
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "GreaterThanOrEqual(created_at,2025-06-01" in p and "LessThan(created_at,2026-01-01" in p


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_forced_broadcast(spark, name):
    """Broadcasts are left to Spark's size checks (static statistics, AQE runtime sizes)."""
    analyzed = QUERIES[name](spark, SF)._jdf.queryExecution().analyzed().toString()
    assert "strategy=broadcast" not in analyzed.lower()


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """The source tables as Parquet, as a deployment has them: scans show what is pushed."""
    root = tmp_path_factory.mktemp("tables")
    derived = catalog_for(spark, SF)
    for n in SCHEMAS:
        derived[n].write.parquet(str(root / n))
    return Catalog.from_parquet(spark, str(root))


def _full_plan(spark, df) -> str:
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    spark.conf.set("spark.sql.debug.maxToStringFields", "1000")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")     # the plan of large sides
    try:
        return df._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
        spark.conf.unset("spark.sql.debug.maxToStringFields")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def _scans(plan: str) -> list[str]:
    """The details of each Parquet scan."""
    return [part for part in plan.split("\n\n") if "Scan parquet" in part]


def test_queries_are_lazy(spark, monkeypatch):
    """Building a query writes nothing and makes no temporary folder."""
    import tempfile

    from pyspark.sql import DataFrame
    monkeypatch.setattr(tempfile, "mkdtemp", lambda *a, **k: pytest.fail("temporary folder"))
    monkeypatch.setattr(DataFrame, "write", property(lambda s: pytest.fail("write")))
    monkeypatch.setattr(DataFrame, "collect", lambda s: pytest.fail("collect"))
    for query in QUERIES.values():
        query(spark, SF)


REPORTS = {"monthly_pnl": RP.monthly_pnl, "order_level": RP.order_level_numeric,
           "shop_day_a": RP.shop_day_shopee, "shop_day_b": RP.shop_day_tiktok}


@pytest.mark.parametrize("name", sorted(REPORTS))
def test_product_names_stay_on_the_scan(spark, stored, name):
    """Only numbers of a SKU line cross the join with the detail table."""
    df = REPORTS[name](stored, ReportParams.for_fixture())
    exchanges = [p for p in _full_plan(spark, df).split("\n\n")
                 if "Exchange" in p.split("\n")[0] and "pesanan_detail_id" in p]
    assert exchanges
    for e in exchanges:
        given = next(line for line in e.split("\n") if line.startswith("Input"))
        assert "nama#" not in given, given


@pytest.mark.parametrize("name", ["monthly_pnl", "order_level", "shop_day_b"])
def test_settlement_meets_narrow_orders(spark, stored, name):
    """Settlements join orders that have a marketplace id, two numbers each."""
    plan = _full_plan(spark, REPORTS[name](stored, ReportParams.for_fixture()))
    header = [s for s in _scans(plan) if "id_marketplace" in s and "EqualTo(marketplace,TIKTOK_SHOP)"
              in s and "IsNotNull(id_marketplace)" in s]
    assert header or name == "order_level"
    assert "settle_key" not in plan


def test_monthly_report_reads_costs_from_its_first_month(spark, stored):
    plan = _full_plan(spark, RP.monthly_pnl(stored, ReportParams.for_fixture()))
    tables = [t for t, _, _ in AD_SOURCES] + ["kelontong"]
    for t in tables:
        scans = [s for s in _scans(plan) if f"/{t}]" in s]
        assert scans and all("GreaterThanOrEqual(" in s for s in scans), t


def test_month_refresh_bounds_every_dated_scan(spark, stored):
    plan = _full_plan(spark, RP.shop_day_shopee(stored, ReportParams.for_fixture(), [(2025, 6)]))
    dated = ["pesanan", *[t for t, _, _ in AD_SOURCES[4:]]]
    for t in dated:
        scans = [s for s in _scans(plan) if f"/{t}]" in s]
        assert scans, t
        for s in scans:
            assert "2025-06-01" in s and "2025-07-01" in s, (t, s)


def test_tiktok_days_split_after_the_aggregate(spark, stored):
    """The split of rows without a day or shop stands above the orders' aggregate."""
    plan = _plan(RP.shop_day_tiktok(stored, ReportParams.for_fixture()))
    lines = plan.split("\n")
    at = next(i for i, line in enumerate(lines) if "Generate explode" in line)
    below = next(line for line in lines[at + 1:] if "Aggregate" in line or "Scan" in line)
    assert "Aggregate" in below


def _reads(spark, name: str) -> dict[str, int]:
    """Scans of each driver table in a query's plan for large sides."""
    import re
    from collections import Counter
    plan = _full_plan(spark, QUERIES[name](spark, SF))
    return Counter(re.findall(rf"{SF}/(\w+)\.parquet\]", "\n".join(_scans(plan))))


@pytest.mark.parametrize("name, lines", [
    ("ad_spend_union_month", 1), ("ad_spend_fullouter_day", 2), ("affiliate_shop_day", 2),
    ("report_monthly_pnl", 5), ("report_shop_day_a", 4), ("report_shop_day_b", 4)])
def test_ad_sources_are_one_scan(spark, name, lines):
    """All ad sources of a report come from one ledger; the rest of its line reads are the detail
    table, the SKU lines, the price parts and the settlements."""
    assert _reads(spark, name)["lineitem"] <= lines


def test_affiliate_holds_no_sum_per_order(spark):
    """The commissions go from the joins straight into the one sum per shop and day."""
    plan = _plan(QUERIES["affiliate_shop_day"](spark, SF))
    assert plan.count("HashAggregate") == 2 and "keys=[pesanan_id" not in plan
