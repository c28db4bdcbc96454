import hashlib
import re

from ledgerline.llm import cuckoo_dedup as C
from ledgerline.llm.storage import new_folder

BLANK = re.compile(r"[\x20\x09-\x0D]")


def brute(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(BLANK.sub("", t or ""), []).append((-len(t or ""), i is None, i or 0, i))
    out = []
    for i, t in rows:
        key = BLANK.sub("", t or "")
        n, _, _, keep = min(groups[key])
        out.append((i, keep, len(groups[key]), i == keep and -len(t or "") == n,
                    hashlib.sha256(key.encode()).hexdigest()))
    return sorted(out, key=str)


def result(df):
    return sorted((tuple(r)[:5] for r in df.collect()), key=str)


def test_table(spark, sf_dir, texts):
    from ledgerline.llm.queries import QUERIES
    assert result(QUERIES["op9_exact_dedup"](spark, sf_dir)) == brute(list(texts.items()))


def test_filter_inserts_deletes_and_resizes():
    digests = [hashlib.sha256(str(i).encode()).digest() for i in range(5000)]
    s = C.Shard()
    for i, d in enumerate(digests):
        s.add(d, i, 1, 1, 1)
        s.add(d, i + 9000, 2, 1, 1)
    assert s.filter.bits > 6 and all(d in s.filter for d in digests)
    assert all(s.content[d] == [i + 9000, 2, 2, 1] for i, d in enumerate(digests))
    for d in digests[::2]:
        s.remove(d)
    assert all(d in s.filter for d in digests[1::2])
    assert sum(d in s.filter for d in digests[::2]) < 50         # false hits only
    again = C.CuckooFilter(s.filter.bits, s.filter.table.tobytes())
    assert all(d in again for d in digests[1::2])


def test_full_table_keeps_what_it_has():
    f, inside = C.CuckooFilter(1), []
    for i in range(40):
        d = hashlib.sha256(str(i).encode()).digest()
        if f.insert(d):
            inside.append(d)
    assert 6 <= len(inside) <= 8 and all(d in f for d in inside)


def test_false_hits_are_told_apart():
    a = bytes(32)
    b = bytes(18) + b"x" * 14                   # same fingerprint and bucket, another digest
    s = C.Shard()
    s.add(a, 1, 1, 1, 1)
    s.add(b, 2, 1, 1, 1)
    assert s.false_hits == 1 and len(s.content) == 2


def test_index_versions(spark):
    make = lambda rows: spark.createDataFrame(rows, "doc_id bigint, text string")
    rows = [(i, f"text {i % 7}" + " " * (i % 3)) for i in range(60)]
    one = C.update_index(spark, new_folder(spark, "x"), make(rows[:40]))
    two = C.update_index(spark, new_folder(spark, "x"), make(rows[40:]), before=one)
    gone = [r for r in rows if r[0] % 4 == 2 or r[0] % 7 == 3]
    three = C.update_index(spark, new_folder(spark, "x"), make([(99, "new")]), make(gone), two)
    left = [r for r in rows if r not in gone] + [(99, "new")]

    def content(path):
        return sorted((bytes(r["digest"]).hex(), r["keep_id"], r["n_rows"])
                      for r in C.groups(spark, path).collect())

    want = lambda rows: sorted({(h, k, n) for _, k, n, _, h in brute(rows)})
    assert content(one) == want(rows[:40])
    assert content(two) == want(rows)
    assert content(three) == want(left)
    assert spark.read.parquet(f"{three}/rows").count() == len(left)


def test_odd_rows(odd, nothing):
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    assert result(C.dedup(odd)) == brute(rows)
    left = C.keep_first(odd)
    assert left.columns == odd.columns
    ids = sorted((r["doc_id"] for r in left.collect()), key=str)
    assert ids == sorted([2, 6, 7, 8, 9, 10, 11, 12], key=str)
    assert C.dedup(nothing).count() == 0 and C.keep_first(nothing).count() == 0


def test_keep_first_where_an_id_is_kept_and_dropped(spark):
    rows = [(1, "a b"), (1, "c"), (2, "ab"), (3, "c "), (3, "c ")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert sorted(map(tuple, C.keep_first(df).collect())) == [(1, "a b"), (3, "c ")]
