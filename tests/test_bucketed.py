"""Tables bucketed by order id: the same rows, without the shuffles of the order joins."""

import re

import pytest

from ledgerline.operators.orders import sku_order_vector
from ledgerline.operators.rules import COGS_ORDER_LEVEL
from ledgerline.params import ReportParams
from ledgerline.plans import reports as RP
from ledgerline.plans.registry import catalog_for
from ledgerline.sources import SCHEMAS, Catalog
from ledgerline.sources.bucketed import BY_ORDER, add_orders, store

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def database(spark, tmp_path_factory):
    at = tmp_path_factory.mktemp("db")
    spark.sql(f"CREATE DATABASE ledgerline_bucketed LOCATION 'file:{at}'")
    store(catalog_for(spark, SF), "ledgerline_bucketed", 6)
    yield "ledgerline_bucketed"
    spark.sql("DROP DATABASE ledgerline_bucketed CASCADE")


def rows(df):
    return sorted(map(repr, df.select(*sorted(df.columns)).collect()))


@pytest.fixture
def large_facts(spark):
    """Dimensions are broadcast, order tables are not."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "4096")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def exchanges(df) -> list[str]:
    plan = df._jdf.queryExecution().executedPlan().toString()
    return re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)


def test_order_tables_are_bucketed(spark, database):
    for name, key in BY_ORDER.items():
        made = "\n".join(r[0] for r in spark.sql(f"SHOW CREATE TABLE {database}.{name}").collect())
        assert f"CLUSTERED BY ({key})" in made and "INTO 6 BUCKETS" in made, name
    cat = Catalog.from_database(spark, database)
    for name in SCHEMAS:
        assert rows(cat[name]) == rows(catalog_for(spark, SF)[name]), name


def test_vector_and_its_join_do_not_shuffle(spark, database, large_facts):
    cat = Catalog.from_database(spark, database)
    vector = sku_order_vector(cat, COGS_ORDER_LEVEL)
    assert exchanges(vector) == []
    joined = cat["pesanan"].join(vector, cat["pesanan"]["id"] == vector["pesanan_id"], "left")
    assert exchanges(joined) == []
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "SelectedBucketsCount" in plan


def test_monthly_report_joins_lines_in_place(spark, database, large_facts):
    """Nothing moves by the order id but the Shopee orders that de-duplication has kept."""
    params = ReportParams.for_fixture()
    measures = RP.monthly_order_measures(Catalog.from_database(spark, database), params)
    assert not [e for e in exchanges(measures) if re.match(r"(pesanan_id|id|price_order_id)#", e)]
    whole = exchanges(RP.monthly_pnl(Catalog.from_database(spark, database), params))
    assert not [e for e in whole if e.startswith("pesanan_id#")]
    assert len([e for e in whole if e.startswith("id#")]) <= 1
    derived = exchanges(RP.monthly_pnl(catalog_for(spark, SF), params))
    assert len(whole) < len(derived)


@pytest.mark.parametrize("report", [RP.monthly_pnl, RP.order_level_numeric, RP.shop_day_shopee,
                                    RP.shop_day_tiktok])
def test_reports_are_the_same(spark, database, report):
    params = ReportParams.for_fixture()
    assert rows(report(Catalog.from_database(spark, database), params)) == \
        rows(report(catalog_for(spark, SF), params))


def test_batches_are_appended_to_buckets(spark, tmp_path):
    spark.sql(f"CREATE DATABASE ledgerline_batches LOCATION 'file:{tmp_path}/db'")
    try:
        whole = catalog_for(spark, SF)

        def part(k):
            detail = whole["pesanan_detail"].where(f"pesanan_id % 2 = {k}")
            tables = {n: whole[n] for n in SCHEMAS}
            tables["pesanan_detail"] = detail
            for n, key in BY_ORDER.items():
                if n in tables:
                    tables[n] = whole[n].where(f"{key} % 2 = {k}")
            tables["pesanan_detail_sku"] = whole["pesanan_detail_sku"].join(
                detail.selectExpr("id AS pesanan_detail_id"), "pesanan_detail_id", "left_semi") \
                .select(*whole["pesanan_detail_sku"].columns)
            return Catalog.from_frames(spark, tables)
        store(part(0), "ledgerline_batches", 3)
        add_orders(spark, part(1), "ledgerline_batches", 3)
        got = sku_order_vector(Catalog.from_database(spark, "ledgerline_batches"), COGS_ORDER_LEVEL)
        assert rows(got) == rows(sku_order_vector(whole, COGS_ORDER_LEVEL))
        assert exchanges(got) == []
    finally:
        spark.sql("DROP DATABASE ledgerline_batches CASCADE")
