import zlib

from pyspark.sql import functions as F

from ledgerline.llm import language_id as L


def test_held_out_accuracy(spark, sf_dir, documents):
    from ledgerline.llm.queries import QUERIES
    got = QUERIES["op1_language_id"](spark, sf_dir)
    rows = {r["doc_id"]: r for r in got.collect()}
    lang = {r["doc_id"]: r["lang"] for r in documents.select("doc_id", "lang").collect()}
    assert rows.keys() == lang.keys()
    for i, r in rows.items():
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1 and r["lang_pred"] in {"en", "de", "fr", "es", "und"}
    held = [i for i, r in rows.items() if r["held_out"]]
    assert sum(rows[i]["lang_pred"] == lang[i] for i in held) / len(held) > 0.93


def test_labels_of_held_out_rows_do_not_matter(documents):
    fold = L.remainder("doc_id", 4)
    a = L.fit(documents, train=fold != 2)
    b = L.fit(documents.withColumn("lang", F.when(fold == 2, "xx").otherwise(F.col("lang"))),
              train=fold != 2)
    assert a.dictionaries == b.dictionaries
    assert all(len(d) <= 131072 for d in a.dictionaries.values())


def test_odd_rows(odd, nothing):
    model = L.fit(odd)
    rows = L.identify(odd, model, keep=("doc_id", "text")).collect()
    assert len(rows) == odd.count()
    for r in rows:
        none = r["text"] is None or not any(c.isalpha() for c in r["text"])
        assert (r["lang_pred"] == "und") == none and r["rejected"] >= none
    left = L.accepted(odd, model)
    assert left.columns == odd.columns and left.where("text is null").count() == 0
    assert L.identify(nothing, model).count() == 0
    empty = L.fit(nothing)
    assert {r["lang_pred"] for r in L.identify(odd, empty).collect()} == {"und"}


def test_narrow_margin_is_rejected():
    model = L.LanguageModel({"a": b"the same words in both", "b": b"the same words in both"})
    assert L.classify("the same words", L._encoders(model), model) == ("a", 0.5, 0.0, True)
