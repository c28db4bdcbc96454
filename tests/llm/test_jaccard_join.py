import random
import re

import numpy as np
import pytest

from ledgerline.llm import jaccard_join as J

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, k):
    w = WORD.findall((text or "").translate(LOWER))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1)))


def brute(texts, k, percent):
    """id -> (set size, component)."""
    sets = {i: shingles(t, k) for i, t in texts.items()}
    up = {i: i for i in texts}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = sorted(i for i in sets if sets[i])
    for a in ids:
        for b in ids:
            if a < b:
                both = len(sets[a] & sets[b])
                if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                    x, y = find(a), find(b)
                    up[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in texts}


def result(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in df.collect()}


def near_copies(n, seed=3):
    """Families of edited copies that share passages, of all lengths, with chains of links."""
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(4000)}"
    passage = " ".join(word() for _ in range(60))
    out, i = {}, 0
    while i < n:
        base = [word() for _ in range(rng.choice([2, 3, 5, 12, 40, 120, 400]))]
        if rng.random() < .5:
            base[1:1] = passage.split()
        for _ in range(rng.randrange(1, 7)):
            out[i] = " ".join(base)
            i += 1
            for _ in range(rng.choice([0, 1, 1, 2, 4])):
                base[rng.randrange(len(base))] = word()
    return out


@pytest.mark.parametrize("k, percent", [(3, 90), (5, 80), (1, 100), (2, 50)])
def test_components_equal_brute_force(spark, k, percent):
    texts = near_copies(160)
    df = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string").repartition(5)
    assert result(J.components(df, words=k, percent=percent)) == brute(texts, k, percent)


def test_chunked_blocks_lose_no_link(spark, monkeypatch):
    """Blocks cut to a few classes: links across chunks come from the second search."""
    monkeypatch.setattr(J, "BLOCK_CLASSES", 4)
    rng = random.Random(9)
    common = [f"c{i}" for i in range(90)]
    texts = {}
    for i in range(120):      # one large group around a common text, at all distances
        words = list(common)
        for _ in range(rng.randrange(0, 7)):
            words[rng.randrange(90)] = f"x{rng.randrange(9)}"
        texts[i] = " ".join(words)
    df = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string").repartition(3)
    for percent in (80, 90):
        assert result(J.components(df, words=3, percent=percent)) == brute(texts, 3, percent)


def test_table(spark, sf_dir, texts):
    from ledgerline.llm.queries import QUERIES
    assert result(QUERIES["op5_jaccard_join"](spark, sf_dir)) == brute(texts, 3, 90)


def test_divide_skip_links_span_the_components():
    rng = np.random.default_rng(1)
    sets = []
    for _ in range(60):
        base = rng.choice(5000, 80, replace=False)
        for _ in range(3):
            sets.append(np.unique(np.concatenate([base[rng.random(80) > .04],
                                                  rng.integers(9000, 9999, 3)])))
    links = J.divide_skip(sets, np.arange(len(sets)), 80)
    groups = J.Groups(np.arange(len(sets)))
    for a, b in links:
        both = len(np.intersect1d(sets[a], sets[b]))
        assert 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both)
        groups.join(a, b)
    for a in range(len(sets)):
        for b in range(a):
            both = len(np.intersect1d(sets[a], sets[b]))
            if 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                assert groups.find(a) == groups.find(b)
    assert len(links) == len(sets) - groups.parts


def test_heap_merge():
    assert list(J._merged([[1, 4, 9], [2, 4], [9]])) == [1, 2, 4, 9]


def test_odd_rows(odd, nothing):
    got = J.components(odd, words=3, percent=90).collect()
    assert len(got) == odd.count()
    by = {r["doc_id"]: r for r in got}
    assert by[4]["n_shingles"] == by[5]["n_shingles"] == by[6]["n_shingles"] == 0
    assert [by[i]["component_id"] for i in (4, 5, 6)] == [4, 5, 6]
    assert by[2]["component_id"] == by[3]["component_id"] == by[1]["component_id"] == 1
    assert by[13]["component_id"] == 12 and by[10]["component_id"] == 9
    assert by[None]["component_id"] is None
    assert J.components(nothing).count() == 0
