"""A refresh without a list of months finds the months whose inputs changed."""

import datetime as dt
from dataclasses import replace
from decimal import Decimal as D

from ledgerline.plans.reports import shop_day_shopee
from ledgerline.sources.schemas import AD_SOURCES
from ledgerline.streaming import read_daily_fact, refresh_changed
from ledgerline.streaming.changes import changed_months, shopee_fact_fingerprints

from test_edge_cases import PARAMS, order


def inputs():
    day = lambda m, d=10: dt.datetime(2025, m, d, 9, 30)
    orders = [order(1, "SHOPEE", 10, id_mp=1, ts=day(3)), order(2, "SHOPEE", 10, id_mp=2, ts=day(3, 11)),
              order(3, "SHOPEE", 10, id_mp=3, ts=day(4)), order(4, "MANUAL", 10, ts=day(4)),
              order(5, "SHOPEE", 10, id_mp=5, toko=221, ts=day(5))]
    return {
        "toko": [(1, "TOKO A"), (221, "TOKO RIVA")], "pesanan": orders,
        "pesanan_detail": [(10 * i, i) for i in range(1, 6)],
        "pesanan_detail_sku": [(10 * i, "Cessa", i) for i in range(1, 6)],
        "pesanan_pembentuk_harga_shopee": [(i, D(1110 * i), D(2000), D(5), D(7)) for i in (1, 2, 3, 5)],
        "shopee_iklan": [(dt.date(2025, 3, 10), 1, D(9)), (dt.date(2025, 5, 10), 221, D(8))],
        "beban": [(1, 1, "LIVE", 2025, 3, D(100)), (2, 1, "LIVE", 2025, 4, D(50))],
        "beban_toko": [(1, 1), (2, 1)]}


def moved(rows, i, **columns):
    """``rows`` with other values at the given places of row ``i``."""
    row = list(rows[i])
    for place, v in columns.items():
        row[int(place[1:])] = v
    return [*rows[:i], tuple(row), *rows[i + 1:]]


def test_exactly_the_changed_months(spark, frames, tmp_path):
    path = str(tmp_path / "fact")
    tables = inputs()

    def rows(df):
        return sorted(map(repr, df.select(*sorted(df.columns)).collect()))

    def refreshed(params=PARAMS):
        cat = frames(tables)
        before = {f: f.stat().st_mtime_ns for f in (tmp_path / "fact").rglob("tahun=*/**/part-*")}
        months = refresh_changed(cat, params, path)
        after = {f: f.stat().st_mtime_ns for f in (tmp_path / "fact").rglob("tahun=*/**/part-*")}
        assert rows(read_daily_fact(spark, path)) == rows(shop_day_shopee(cat, params))
        assert len(list((tmp_path / "fact/_fingerprints").iterdir())) == 1
        touched = {f.parent.name for f in set(before.items()) ^ set(after.items()) for f in [f[0]]}
        assert months is None or touched <= {f"bulan={m}" for _, m in months}
        return months

    assert refreshed() is None and refreshed() == []
    parts = tables["pesanan_pembentuk_harga_shopee"]
    tables["pesanan_pembentuk_harga_shopee"] = moved(parts, 2, _1=D(9990))          # an update
    assert refreshed() == [(2025, 4)]
    tables["pesanan"] = tables["pesanan"][:-1]                                        # a delete
    assert refreshed() == [(2025, 5)]
    assert not read_daily_fact(spark, path, 2025, 5).count()
    tables["pesanan"] = moved(tables["pesanan"], 1, _3=dt.datetime(2025, 6, 1))       # another date
    assert refreshed() == [(2025, 3), (2025, 6)]
    tables["pesanan_detail_sku"] = moved(tables["pesanan_detail_sku"], 0, _2=50)      # a line
    tables["shopee_iklan"] = moved(tables["shopee_iklan"], 0, _2=D(19))
    assert refreshed() == [(2025, 3)]
    tables["beban"] = moved(tables["beban"], 1, _5=D(60))                             # overhead
    assert refreshed() == [(2025, 4)]
    tables["beban_toko"] = tables["beban_toko"] + [(2, 221)]      # a shop joins the import's whole
    assert refreshed() == [(2025, 3), (2025, 4)]
    tables["toko"] = moved(tables["toko"], 0, _1="NEW NAME")
    assert refreshed() is None and refreshed() == []
    codes = replace(PARAMS.codes, funnel_shopee_shop=1)
    assert refreshed(replace(PARAMS, codes=codes)) is None


def test_fingerprints_are_independent_of_order_and_mergeable(frames):
    tables = inputs()
    a = shopee_fact_fingerprints(frames(tables), PARAMS)
    tables = {n: rows[::-1] for n, rows in tables.items()}
    b = shopee_fact_fingerprints(frames(tables), PARAMS)
    assert changed_months(a, b) == []
    assert {r["source"] for r in a.collect()} >= {"pesanan", "pesanan_detail_sku", "beban", "params"}
    assert len(AD_SOURCES) == 11
    # repeated rows do not cancel out
    tables["pesanan_pembentuk_harga_shopee"] += [tables["pesanan_pembentuk_harga_shopee"][0]] * 2
    assert changed_months(a, shopee_fact_fingerprints(frames(tables), PARAMS)) == [(2025, 5)]
