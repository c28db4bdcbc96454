import math
import re
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from ledgerline.llm import backoff_lm as L

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def toks(text):
    return WORD.findall((text or "").translate(LOWER)) + ["\n"]


def model(texts, contexts):
    """Counts and the smoothed bigram model, written down directly."""
    c, follow = Counter(), Counter()
    for t in texts:
        w = toks(t)
        c.update(w)
        follow.update(zip(["\n", *w], w))
    n, v = sum(c.values()), len(c)
    p = lambda w: (c[w] + 1) / (n + v + 1)
    arcs = {h: {w: (k - L.DISCOUNT) / c[h] for (g, w), k in follow.items()
                if g == h and w in contexts} for h in contexts}
    back = {h: (1 - sum(a.values())) / (1 - sum(p(w) for w in a)) for h, a in arcs.items()}

    def score(text):
        out, h = 0.0, "\n"
        for w in toks(text):
            out += math.log10(arcs[h][w] if h in arcs and w in arcs[h] else
                              back.get(h, 1.0) * p(w))
            h = w
        return out
    return c, n, v, p, arcs, back, score


def check(spark, monkeypatch, texts, got, contexts):
    train = [t for i, t in texts.items() if zlib.crc32(str(i).encode()) % 7 != 2]
    c, n, v, p, _, _, score = model(train, contexts(Counter(w for t in train for w in toks(t))))
    for r in got:
        t = texts[r["doc_id"]]
        w = toks(t)
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 7 == 2)
        assert (r["n_tokens"], r["train_tokens"]) == (len(w), n)
        assert r["n_known"] == sum(c[x] > 0 for x in w)
        assert math.isclose(r["base_score"], sum(math.log10(p(x)) for x in w), rel_tol=1e-9)
        assert math.isclose(r["score"], score(t), rel_tol=1e-9)


def top(k):
    def choose(c):
        words = [w for w in c if w != "\n"]
        hashes = {w: int(L.word_hashes(w.encode())[0]) for w in words}
        words.sort(key=lambda w: (-c[w], hashes[w]))
        return {"\n", *words[:k - 1]}
    return choose


def test_table(spark, sf_dir, texts, monkeypatch):
    from ledgerline.llm.queries import QUERIES
    got = QUERIES["op10_lm_score"](spark, sf_dir).collect()
    assert len(got) == len(texts)
    check(spark, monkeypatch, texts, got, top(L.CONTEXTS))
    held = [r for r in got if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_words_outside_the_head_score_the_same(spark, documents, texts, monkeypatch):
    want = {r["doc_id"]: r for r in L.score(documents, L.remainder("doc_id", 7) != 2).collect()}
    monkeypatch.setattr(L, "HEAD", 1500)
    for r in L.score(documents, L.remainder("doc_id", 7) != 2).collect():
        w = want[r["doc_id"]]
        assert r["n_known"] == w["n_known"]
        assert math.isclose(r["base_score"], w["base_score"], rel_tol=1e-9)
        assert math.isclose(r["score"], w["score"], rel_tol=1e-9)


def test_probabilities_sum_to_one():
    texts = ["a b a c", "a b b", "c a d", ""]
    c, n, v, p, arcs, back, _ = model(texts, {"\n", "a", "b"})
    for h, a in arcs.items():
        rest = sum(back[h] * p(w) for w in [*c, "unseen"] if w not in a)
        assert math.isclose(sum(a.values()) + rest, 1.0)


def test_end_mark_is_no_word():
    assert L.END not in L.word_hashes(" ".join(f"w{i}" for i in range(1000)).encode())
    assert len(np.unique(L.word_hashes(" ".join(f"w{i}" for i in range(100000)).encode()))) == 100000


def test_odd_rows(odd, nothing):
    train = L.remainder("doc_id", 7) != 2
    got = L.score(odd, train)
    assert got.count() == odd.count()
    by = {r["doc_id"]: r for r in got.collect()}
    assert by[4]["n_tokens"] == by[5]["n_tokens"] == by[6]["n_tokens"] == 1
    assert by[4]["score"] == by[5]["score"] < 0 and by[9]["n_tokens"] == 40001
    assert not by[None]["held_out"]
    assert L.score(nothing, train).count() == 0
    untrained = L.score(odd, F.lit(False)).collect()
    assert {(r["n_known"], r["train_tokens"], r["base_score"], r["score"]) for r in untrained} == \
        {(0, 0, 0.0, 0.0)}


def test_every_training_bigram_is_an_arc(spark, monkeypatch):
    """A rare pair scores by its own count, whatever the tasks hold; rows that repeat count each."""
    rare = [f"x{i} y{i} the z{i % 7}" for i in range(3000)]
    texts = dict(enumerate([*rare, *rare[:40], "x1 z1 the q", "q q x5 y5", None]))
    df = spark.createDataFrame([*texts.items(), (0, rare[0])], "doc_id bigint, text string")
    train = F.col("doc_id") % 5 != 3
    seen = [t for i, t in texts.items() if i % 5 != 3] + [rare[0]]
    c, follow = Counter(), Counter()
    for t in seen:
        c.update(toks(t))
        follow.update(zip(["\n", *toks(t)], toks(t)))
    n, v = sum(c.values()), len(c)
    arcs = {}
    for h, w in follow:
        arcs.setdefault(h, []).append(w)
    p = lambda w: (c[w] + 1) / (n + v + 1)
    back = {h: L.DISCOUNT * len(a) / c[h] / (1 - sum(map(p, a))) for h, a in arcs.items()}
    for head, hot in ((200_000, 1024), (50, 8)):
        monkeypatch.setattr(L, "HEAD", head)
        monkeypatch.setattr(L, "HOT", hot, raising=False)
        got = L.score(df, train).collect()
        assert len(got) == len(texts) + 1
        for r in got:
            w = toks(texts[r["doc_id"]])
            want = sum(math.log10((follow[h, x] - L.DISCOUNT) / c[h] if follow[h, x] else
                                  back.get(h, 1.0) * p(x)) for h, x in zip(["\n", *w], w))
            assert math.isclose(r["score"], want, rel_tol=1e-9)
            assert math.isclose(r["base_score"], sum(math.log10(p(x)) for x in w), rel_tol=1e-9)
            assert r["n_known"] == sum(c[x] > 0 for x in w)


def test_chunks_and_ranges_do_not_change_scores(spark, documents, monkeypatch):
    """Many chunks, many ranges, states split over ranges: the same scores."""
    train = L.remainder("doc_id", 7) != 2
    want = {r["doc_id"]: r for r in L.score(documents, train).collect()}
    for name, v in (("CHUNK", 5000), ("RANGE", 9000), ("HEAD", 40)):
        monkeypatch.setattr(L, name, v)
    got = L.score(documents, train).collect()
    assert len(got) == len(want)
    for r in got:
        w = want[r["doc_id"]]
        assert (r["n_known"], r["n_tokens"]) == (w["n_known"], w["n_tokens"])
        assert math.isclose(r["base_score"], w["base_score"], rel_tol=1e-12)
        assert math.isclose(r["score"], w["score"], rel_tol=1e-12)


def test_blobs():
    columns = [np.array([], dtype=np.int64), np.array([-1, 2 ** 62, 0]), np.arange(70000)]
    for a, b in zip(columns, L.unpack(L.pack(*columns))):
        assert a.tolist() == b.tolist()
