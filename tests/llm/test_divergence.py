import random
import re
from collections import Counter
from itertools import product

import numpy as np

from ledgerline.llm import divergence as D

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least, top=50):
    """{(lang, source, part, item, value, rank)} of rows (lang, source, text)."""
    docs = [(l or "", s or "", TERM.findall((t or "").translate(UPPER))) for l, s, t in rows]
    out = set()
    for lang in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == lang]
        df = Counter(t for d in mine for t in set(d[2]))
        kept = [t for t, n in df.items() if n >= least]
        count = {s: Counter(t for d in mine if d[1] == s for t in d[2] if df[t] >= least)
                 for s in {d[1] for d in mine}}
        whole = sum(count.values(), Counter())

        def p(c, t):
            return 1 + 10 ** 9 * (c[t] + 5) // (sum(c.values()) + 5 * len(kept))

        found = {s: {"pair": [], "term": []} for s in count}
        for a, b in product(count, count):
            if a != b:
                found[a]["pair"].append((-sum(abs(p(count[a], t) - p(count[b], t))
                                              for t in kept), b.encode(), b))
        for a in count:
            for t in kept:
                f = p(count[a], t) - p(whole, t)
                if count[a][t] and f > 0:
                    found[a]["term"].append((-f, t.encode(), t))
        for s, parts in found.items():
            for part, items in parts.items():
                for r, (f, _, item) in enumerate(sorted(items)):
                    if part == "pair" or r < top:
                        out.add((lang, s, part, item, -f, r + 1))
    return out


def result(df):
    return {tuple(r) for r in df.select("lang", "source", "part", "item", "value", "rank").collect()}


def rows_of(df):
    return [tuple(r) for r in df.select("lang", "source", "text").collect()]


def test_equals_brute_force(documents, monkeypatch):
    monkeypatch.setattr(D, "SEGMENT", 7)
    monkeypatch.setattr(D, "HELD", 100)
    want = brute(rows_of(documents), 10)
    assert result(D.audit(documents, least_docs=10)) == want and len(want) > 500


def test_odd_rows(odd, nothing):
    for least in (1, 2, 30):
        assert result(D.audit(odd, least_docs=least)) == brute(rows_of(odd), least)
    assert D.audit(nothing).count() == 0


def test_ties_and_repeats(spark):
    """Equal counts, equal values (item order decides), repeated rows, non-ASCII order."""
    rng = random.Random(3)
    words = ["é", "z", "Z", "ß", "the", "a-b", "x9y", "日本"]
    rows = [(rng.choice(["", "en", None]), rng.choice("abc"),
             " ".join(rng.choice(words) for _ in range(rng.randrange(6)))) for _ in range(120)]
    rows += [("en", s, "same same") for s in "abc" for _ in range(3)] + [("xx", "only", "one")]
    df = spark.createDataFrame(rows * 2, "lang string, source string, text string")
    assert result(D.audit(df, least_docs=4, top=3)) == brute(rows * 2, 4, 3)


def test_runs_are_exact_beyond_64_bits():
    starts, counts = D._runs(np.array([0, 0, 3, 3, 0]), np.array([2, 1, 4, 1, 9]))
    assert starts.tolist() == [0, 3, 8] and counts.tolist() == [0, 3, 0]
    big = 10 ** 12
    columns = {"a": (np.array([0, 5]), np.array([big, 0])), "b": (np.array([0, 2]), np.array([1, 7]))}
    (found,) = D.pair_sums(9, columns, [("a", 5 * big), ("b", 51)], 9)

    def p(c, n):
        return 1 + 10 ** 9 * (c + 5) // (n + 45)

    want = sum(abs(p(big if i < 5 else 0, 5 * big) - p(1 if i < 2 else 7, 51)) for i in range(9))
    assert found == ("a", "b", want)
