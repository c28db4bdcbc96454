from collections import Counter

from ledgerline.llm import token_rollup as T
from ledgerline.llm.storage import new_folder
from ledgerline.llm.token_shards import tokenizer_path


def as_dict(df):
    return {(r["source"], r["lang"], r["tokenizer"]): (r["n_docs"], r["n_tokens"])
            for r in df.collect()}


def test_load_equals_direct_counts(spark, sf_dir, documents):
    from tokenizers import Tokenizer

    from ledgerline.llm.queries import QUERIES
    tokenizer = Tokenizer.from_file(tokenizer_path())
    docs, n = Counter(), Counter()
    for r in documents.collect():
        for v, k in (("words-1", len(r["text"].split())),
                     ("word-bpe-49k", len(tokenizer.encode(r["text"], add_special_tokens=False).ids))):
            docs[r["source"], r["lang"], v] += 1
            n[r["source"], r["lang"], v] += k
    assert as_dict(QUERIES["op3_token_rollup"](spark, sf_dir)) == {k: (docs[k], n[k]) for k in docs}


def test_deltas_and_idempotent_batches(spark):
    schema = "doc_id bigint, text string, lang string, source string"
    make = lambda *rows: spark.createDataFrame(list(rows), schema)
    r = T.TokenRollup(spark, new_folder(spark, "rollup"), ("words-1",))
    first = make((1, "a b c", "en", "x"), (2, "a b", "en", "x"), (3, "a", None, None))
    assert r.commit("1", inserts=first)
    assert not r.commit("1", inserts=first)                     # delivered twice
    assert as_dict(r.totals()) == {("x", "en", "words-1"): (2, 5), (None, None, "words-1"): (1, 1)}
    r.commit("2", deletes=first.where("doc_id = 2"), revisions=make((1, "a b c d e", "de", "x")))
    assert as_dict(r.totals()) == {("x", "de", "words-1"): (1, 5), (None, None, "words-1"): (1, 1)}
    r.commit("3", deletes=first, inserts=make((4, "q", "en", "y")))
    assert as_dict(r.totals()) == {("y", "en", "words-1"): (1, 1)}
    r.commit("4", deletes=make((99, "", "", "")))               # unknown: nothing happens
    r.commit("5")
    assert as_dict(r.totals()) == {("y", "en", "words-1"): (1, 1)}
    assert r.committed() == ["1", "2", "3", "4", "5"]


def test_uncommitted_batch_is_not_seen(spark):
    folder = new_folder(spark, "rollup")
    r = T.TokenRollup(spark, folder, ("words-1",))
    df = spark.createDataFrame([(1, "a b", "en", "x")],
                               "doc_id bigint, text string, lang string, source string")
    T.counted(df, ("words-1",)).write.parquet(f"{folder}/entries/batch=1")  # died before totals
    assert as_dict(r.totals()) == {}
    assert r.commit("1", inserts=df) and as_dict(r.totals()) == {("x", "en", "words-1"): (1, 2)}


def test_odd_rows(spark, odd, nothing):
    r = T.TokenRollup(spark, new_folder(spark, "rollup"))
    r.commit("1", inserts=odd)
    assert sum(v[0] for k, v in as_dict(r.totals()).items() if k[2] == "words-1") == odd.count()
    r.commit("2", inserts=nothing, deletes=odd, revisions=nothing)
    left = as_dict(r.totals())
    assert {k: v for k, v in left.items() if k[2] == "words-1"} == \
        {(None, None, "words-1"): (1, 9)}                       # the null id stays


def test_repeated_and_deleted_revisions(spark):
    import pytest
    make = lambda *rows: spark.createDataFrame(
        list(rows), "doc_id bigint, text string, lang string, source string")
    r = T.TokenRollup(spark, new_folder(spark, "rollup"), ("words-1",))
    r.commit("1", inserts=make((1, "a b", "en", "x"), (2, "a", "en", "x")))
    one = (1, "a b c d", "en", "x")
    with pytest.raises(ValueError, match="document 1 is revised more than once"):
        r.commit("2", revisions=make(one, one))
    assert r.committed() == ["1"] and as_dict(r.totals()) == {("x", "en", "words-1"): (2, 3)}
    r.commit("2", deletes=make(one), revisions=make(one, (None, "q", "en", "x")))
    assert as_dict(r.totals()) == {("x", "en", "words-1"): (3, 6)}
