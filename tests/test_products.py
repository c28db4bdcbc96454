"""Product dictionary: names are classified once, lines look them up."""

import re

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import products as PD
from ledgerline.operators import rules as R
from ledgerline.operators.orders import classified_lines
from ledgerline.params import ReportParams
from ledgerline.plans import reports as RP
from ledgerline.plans.registry import catalog_for
from ledgerline.sources import SCHEMAS, Catalog

from test_plans import SF, _full_plan

NAMES = ["Habbie Telon 100 ml", "HABBIE telon 60 ML", "vitabumin madu 130 x", "Protabumin Careos",
         "no rule at all", "", "Cessa % _", "Lega", None, "Yayle Paramorina", "Vitabumin Madu 60"]


@pytest.fixture(scope="module")
def lines(spark):
    """Every name, and one name on nine of ten lines."""
    names = NAMES + ["Protabumin Nutrimom"] * 99
    return spark.createDataFrame([(i, n, i % 7) for i, n in enumerate(names)],
                                 SCHEMAS["pesanan_detail_sku"])


def catalog(spark, lines, **known):
    detail = lines.select(F.col("pesanan_detail_id").alias("id"),
                          (F.col("pesanan_detail_id") % 5).alias("pesanan_id"))
    tables = {"pesanan_detail_sku": lines, "pesanan_detail": detail}
    return Catalog(spark, lambda n: tables[n], **known)


def rows(df):
    return sorted(map(repr, df.select("pesanan_id", "qty", "rule", F.col("fee").cast("double")).collect()))


@pytest.mark.parametrize("fallback", [R.TIKTOK_FEE_FALLBACK, None])
def test_dictionary_equals_direct_rules(spark, lines, tmp_path, fallback):
    want = rows(classified_lines(catalog(spark, lines), fallback))
    whole = catalog(spark, lines, product_names=lambda: lines.select("nama"))
    assert rows(classified_lines(whole, fallback)) == want and len(want) == len(NAMES) + 99
    # a stored dictionary that lacks some names: their lines are classified directly
    stored = PD.refresh(spark, str(tmp_path / "names"), lines.where("nama LIKE '%a%'"))
    assert 0 < stored.count() < len(NAMES)
    assert rows(classified_lines(catalog(spark, lines, products=stored), fallback)) == want


def test_refresh_adds_new_names_only(spark, lines, tmp_path):
    path = str(tmp_path / "names")
    first = PD.refresh(spark, path, lines.where("pesanan_detail_id < 4"))
    assert first.count() == 4
    seen = set(spark.read.parquet(path).inputFiles())
    again = PD.refresh(spark, path, lines)
    assert again.count() == len(set(NAMES) - {None}) + 1
    assert seen < set(spark.read.parquet(path).inputFiles())
    assert PD.refresh(spark, path, lines).count() == again.count()          # nothing new
    known = {r["nama"]: (r["rule"], r["fee_class"]) for r in again.collect()}
    assert known["no rule at all"] == (0, 0) == known[""] and known["Cessa % _"] == (16, 1)
    assert known["HABBIE telon 60 ML"] == (10, 3) and None not in known


def test_no_substring_tests_on_lines(spark):
    """Substring tests of product names run on the distinct names, not on lines."""
    cat, params = catalog_for(spark, SF), ReportParams.for_fixture()
    for report in (RP.monthly_pnl, RP.order_level_numeric, RP.shop_day_shopee, RP.shop_day_tiktok):
        parts = _full_plan(spark, report(cat, params)).split("\n\n")
        tests = [p for p in parts if re.search(r"Contains\(lower\(nama#\d+\)", p)]
        assert tests, report
        assert not any(re.search(r"(?<!\w)qty#|l_quantity#", p) for p in tests), report


def test_frequent_name_needs_no_shuffle(spark, lines, tmp_path):
    """The stored dictionary is broadcast by its size; lines of a hot name stay where they are."""
    stored = PD.refresh(spark, str(tmp_path / "names"), lines)
    stored = spark.read.parquet(str(tmp_path / "names"))
    cat = catalog(spark, lines, products=stored)
    plan = PD.with_codes(cat, lines.select("pesanan_detail_id", "nama", "qty"), None) \
        ._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning(nama" not in plan
