from pyspark.sql import functions as F

import corpus_pipeline as P
from ledgerline.llm.storage import written

from .test_cuckoo_dedup import BLANK
from .test_jaccard_join import brute as near


def test_stages_against_brute_force(spark, sf_dir, documents):
    kept = [documents]
    for name, stage in P.STAGES:
        kept.append(written(spark, stage(spark, kept[-1], sf_dir), f"test-{name}"))
    for df in kept[1:-1]:
        assert df.columns == documents.columns
    ids = [[r["doc_id"] for r in df.select("doc_id").collect()] for df in kept]
    texts = [{r["doc_id"]: r["text"] for r in df.select("doc_id", "text").collect()}
             for df in kept[:-1]]
    assert len(ids[1]) > 0.97 * len(ids[0])
    best = {}
    for i, t in texts[1].items():
        key = BLANK.sub("", t)
        best[key] = min(best.get(key, (0, 1 << 60)), (-len(t), i))
    assert sorted(ids[2]) == sorted(i for _, i in best.values())
    part = near(texts[2], 5, 80)
    assert sorted(ids[3]) == sorted({c for _, c in part.values()})
    assert set(ids[4]) < set(ids[3]) and 0.3 < sum(len(t) for t in texts[4].values()) / sum(
        len(t) for t in texts[3].values()) < 0.7
    assert sorted(ids[5]) == sorted(ids[4])
    run = P.run(spark, sf_dir)
    assert sorted(map(tuple, run.collect())) == sorted(map(tuple, kept[-1].collect()))


def test_odd_rows(spark, sf_dir, odd, nothing):
    for start in (odd, nothing):
        docs = written(spark, start, "odd")
        for name, stage in P.STAGES[:-1]:
            docs = written(spark, stage(spark, docs, sf_dir), f"odd-{name}")
            assert docs.columns == start.columns
            extra = start.columns[5:]                 # names like the stages' own: untouched
            assert {tuple(r) for r in docs.select(*extra).collect()} <= {("x",) * len(extra)}
        P.STAGES[-1][1](spark, docs, sf_dir).count()
    assert docs.count() == 0


def test_entry_lists_queries_and_sql():
    import __spark_entry__ as e
    names = e.queries()
    for n in range(1, 11):
        assert sum(q.startswith(f"op{n}_") for q in names) == 1
    assert "pipeline" in names and set(e.oracle_sql()) <= set(names)


def test_sql_matches(spark, sf_dir):
    import duckdb

    import __spark_entry__ as e
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    for name, sql in e.oracle_sql().items():
        if name.startswith("op"):
            got = e.queries()[name](spark, sf_dir)
            cols = sorted(got.columns)
            want = con.sql(sql).project(", ".join(cols)).fetchall()
            assert sorted(map(tuple, got.select(*map(F.col, cols)).collect())) == sorted(want), name


def test_near_copies_go_by_row(spark, sf_dir, documents):
    """An id that repeats with another text, or a null id, loses only what a kept row stands for."""
    a = " ".join(f"alpha{i}" for i in range(80))
    b = " ".join(f"beta{i}" for i in range(80))
    c = " ".join(f"gamma{i}" for i in range(80))
    rows = [(3, a + " end"), (5, a), (5, b), (7, c), (7, c + " end"), (None, c + " more"),
            (None, b + " more"), (None, "of its own " + " ".join(f"delta{i}" for i in range(80))),
            (9, "ten " * 9), (9, "ten " * 9), (11, None), (11, "")]
    docs = spark.createDataFrame([(*r, "en", "s", 1) for r in rows], documents.schema)
    got = [(r["doc_id"], r["text"]) for r in P.drop_near_copies(spark, docs, sf_dir).collect()]
    assert sorted(i for i, t in got if i is not None) == [3, 5, 7, 9, 11, 11]
    assert (3, rows[0][1]) in got and (5, b) in got
    assert [t for i, t in got if i is None] == [rows[7][1]]
