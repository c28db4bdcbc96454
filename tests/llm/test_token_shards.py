import os
import zlib

import numpy as np
import pytest

from ledgerline.llm import token_shards as T
from ledgerline.llm.storage import new_folder


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(T.tokenizer_path())


def test_perfect_hash_is_minimal():
    for n in (0, 1, 2, 63, 1000, 20000):
        keys = T.key_hash(np.arange(n), np.zeros(n))
        h = T.PerfectHash.build(keys)
        assert sorted(h(keys).tolist()) == list(range(n))
    with pytest.raises(ValueError):
        T.PerfectHash.build(np.array([5, 5], dtype=np.uint64))


def test_index_finds_its_keys_only():
    ids, n = np.arange(0, 5000, 5), np.arange(1000) % 7
    index = T.Index(T.pack_index(ids, np.zeros(1000, int), n, 2))
    at, length = index.find(ids, np.zeros(1000, int))
    assert (length == n).all() and (at == np.cumsum(n) - n).all()
    at, _ = index.find(np.arange(1, 50000, 5), np.zeros(10000, int))
    assert (at < 0).all()


def test_encoder_equals_library(tokenizer, texts):
    encoder = T.WordEncoder(T.tokenizer_path(), 2)
    special = ["It's the dog's <|endoftext|>a<|startoftext|> don't 'll", "ﬁne É É x́ Ω Σς İ",
               "a\x1cb c d e\x85f", "x" * 5000, "一二三 😀😀 ..!!?? a.b,c 12ab", "\t\n\r\x0b", ""]
    for t in [*special, *texts.values()]:
        got = np.frombuffer(encoder.encode(t), "<u2").tolist()
        assert got == tokenizer.encode(t, add_special_tokens=False).ids, t[:60]


def test_small_memory_gives_the_same_ids(monkeypatch, tokenizer):
    monkeypatch.setattr(T, "CACHE_WORDS", 8)
    encoder = T.WordEncoder(T.tokenizer_path(), 2)
    for t in ("a b c d e f g", "h i j a b", "a b c d e f g h i j k l m n", "a"):
        got = np.frombuffer(encoder.encode(t), "<u2").tolist()
        assert got == tokenizer.encode(t, add_special_tokens=False).ids


def test_known_pieces_need_no_library(monkeypatch, tokenizer):
    """A new spelling of a known piece costs two lookups: no array is built, nothing is merged."""
    encoder = T.WordEncoder(T.tokenizer_path(), 2)
    encoder.encode("hello, world.")
    monkeypatch.setattr(encoder, "_tokenize", None)
    monkeypatch.setattr(encoder, "tokenizer", None)
    monkeypatch.setattr(T, "np", None)
    raw = encoder.encode("Hello HELLO. World, wOrld")
    want = tokenizer.encode("Hello HELLO. World, wOrld", add_special_tokens=False).ids
    assert np.frombuffer(raw, "<u2").tolist() == want
    assert encoder.learn("World") is encoder.pieces["world"]


def check(rows, texts, tokenizer):
    start = 0
    assert len(rows) == len(texts)
    for r, i in zip(rows, sorted(texts)):
        ids = tokenizer.encode(texts[i], add_special_tokens=False).ids + [1]
        assert (r["doc_id"], r["start"], r["n_tokens"]) == (i, start, len(ids))
        assert r["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)


def test_table(spark, sf_dir, texts, tokenizer):
    from ledgerline.llm.queries import QUERIES
    check(QUERIES["op6_token_shards"](spark, sf_dir).orderBy("doc_id").collect(), texts, tokenizer)


def test_many_shards_and_four_byte_ids(spark, documents, texts, tokenizer, monkeypatch):
    monkeypatch.setattr(T, "RANGE_BYTES", 40_000)
    folder = new_folder(spark, "shards")
    keys = T.write_shards(documents, folder, T.tokenizer_path(), vocabulary=1 << 17)
    assert keys.select("part", "seq").distinct().count() > 3
    check(T.read_documents(spark, folder, keys).orderBy("doc_id").collect(), texts, tokenizer)
    one = keys.first()
    ids = T.get_ids(folder, one["part"], one["seq"], one["doc_id"])
    assert ids.tolist() == tokenizer.encode(texts[one["doc_id"]],
                                            add_special_tokens=False).ids + [1]
    assert T.get_ids(folder, one["part"], one["seq"], 10 ** 9) is None
    # nothing but whole files is left
    names = os.listdir(folder.removeprefix("file://") + "/shards")
    assert all(n.endswith((".ids", ".idx", ".crc")) for n in names)


def test_odd_rows(spark, odd, nothing, tokenizer):
    folder = new_folder(spark, "shards")
    got = T.read_documents(spark, folder, T.write_shards(odd, folder, T.tokenizer_path())) \
        .orderBy("start").collect()
    assert len(got) == odd.count()
    assert [r["doc_id"] for r in got] == [None, 1, 2, 3, 4, 5, 6, 7, 8, 8, 9, 10, 11, 12, 13]
    assert got[0]["start"] == 0 and all(
        b["start"] == a["start"] + a["n_tokens"] for a, b in zip(got, got[1:]))
    assert [r["n_tokens"] for r in got if r["doc_id"] in (4, 5, 6)] == [1, 1, 1]
    folder = new_folder(spark, "shards")
    keys = T.write_shards(nothing, folder, T.tokenizer_path())
    assert T.read_documents(spark, folder, keys).count() == 0


def test_lookup_by_id_alone(spark, documents, tmp_path, monkeypatch):
    """Every document's ids by its id; rows that share an id all come, an unknown id none."""
    monkeypatch.setattr(T, "RANGE_BYTES", 50_000)
    monkeypatch.setattr(T, "RUN_IDS", 3000)
    folder = f"file:{tmp_path}/shards"                      # as Hadoop writes it
    twice = documents.where("doc_id = 17")
    keys = T.write_shards(documents.unionByName(twice), folder, T.tokenizer_path())
    assert keys.select("part").distinct().count() > 3
    found = {r["doc_id"]: r for r in T.read_documents(spark, folder, keys).collect()}
    for i in (0, 17, 63, 199):
        rows = T.lookup(folder, i)
        assert len(rows) == (2 if i == 17 else 1)
        for ids in rows:
            assert len(ids) == found[i]["n_tokens"]
            assert zlib.crc32(ids.astype("<u4").tobytes()) == found[i]["ids_crc32"]
    assert T.lookup(folder, 10 ** 9) == []


def test_memory_of_words_is_bounded(monkeypatch):
    monkeypatch.setattr(T, "CACHE_WORDS", 5)
    e = T.WordEncoder(T.tokenizer_path(), 2)
    text = "alpha beta Gamma, delta x1 " * 3 + "one two three four five six seven, alpha"
    want = e.tokenizer.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(e.encode(text), "<u2").tolist() == want and len(e.known) <= 6
