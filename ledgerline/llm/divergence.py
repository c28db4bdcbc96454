"""Source divergence audit over run-length columns.

How far do the sources of one language differ in the words they use?  Every (language, source)
group is a column of counts over the language's vocabulary, and the distance of two groups is the
sum of ``f(count, count)`` over all terms.  Most counts of a column are equal (most are zero), so

* the vocabulary is reordered by the terms' count vectors, which puts equal counts side by side;
* a segment of the reordered vocabulary keeps each group as runs (start, count);
* for a pair of groups the boundaries of their runs are intersected; between two boundaries both
  counts are constant, so ``f`` is evaluated once and multiplied by the run's length.

Terms with equal vectors are one entry with a multiplicity before they move, so a segment spans
far more terms than it has entries.  Segments are independent; a pair's sums over them are added
up by Spark.  All arithmetic is in integers.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .storage import written

#: fixed values of the measure: smoothing, scale, documents a kept term is in
SMOOTH = 5
SCALE = 1_000_000_000
LEAST_DOCS = 30
#: entries (distinct count vectors) of a segment
SEGMENT = 2048
#: distinct (group, term) counts that a task holds before it passes them on
HELD = 1 << 19
#: largest count whose product with SCALE fits 64 bits
_FITS = 9_000_000_000

_LETTERS = bytes(b if 0x61 <= b <= 0x7A or b >= 0x80 else b + 0x20 if 0x41 <= b <= 0x5A else 0x20
                 for b in range(256))


def terms_of(text: str) -> list[bytes]:
    """The matches of ``[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+``, A-Z lower-cased, in UTF-8."""
    return text.encode("utf-8", "replace").translate(_LETTERS).split(b" ") if text else []


def _count(limit: int):
    """Rows (lang, source, text) to partial (lang, source, term, n, docs)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], tuple[Counter, Counter]] = {}

        def out() -> pa.RecordBatch:
            cols: tuple[list, ...] = ([], [], [], [], [])
            for (lang, source), (n, docs) in held.items():
                cols[0].extend([lang] * len(n))
                cols[1].extend([source] * len(n))
                cols[2].extend(t.decode("utf-8") for t in n)
                cols[3].extend(n.values())
                cols[4].extend(docs[t] for t in n)
            held.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, (pa.string(),) * 3 + (pa.int64(),) * 2)],
                names=["lang", "source", "term", "n", "docs"])

        for batch in batches:
            for lang, source, text in zip(*(c.to_pylist() for c in batch.columns)):
                found = Counter(terms_of(text))
                found.pop(b"", None)
                n, docs = held.setdefault((lang, source), (Counter(), Counter()))
                n.update(found)
                docs.update(found.keys())
            if sum(len(n) for n, _ in held.values()) > limit:
                yield out()
        yield out()
    return run


def vocabulary(docs: DataFrame, least_docs: int = LEAST_DOCS) -> DataFrame:
    """(lang, term, counts): kept terms with their counts by source, sources ascending.

    Takes rows (lang, source, text) without nulls.
    """
    partial = docs.mapInArrow(_count(HELD), "lang string, source string, term string, n bigint, "
                              "docs bigint")
    return partial.groupBy("lang", "term", "source").agg(
        F.sum("n").alias("n"), F.sum("docs").alias("docs")).groupBy("lang", "term").agg(
        F.sum("docs").alias("docs"), F.array_sort(F.collect_list(F.struct("source", "n")))
        .alias("counts")).where(F.col("docs") >= least_docs).select("lang", "term", "counts")


def _runs(values: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts, values) of the runs of a column whose entries repeat ``lengths`` times."""
    first = np.flatnonzero(np.append(True, values[1:] != values[:-1]))
    return (np.cumsum(lengths) - lengths)[first], values[first]


RUNS = "lang string, length bigint, columns array<struct<source:string,starts:array<bigint>," \
       "counts:array<bigint>>>"


def _encode(size: int):
    """Sorted entries (lang, counts, times) to run-length columns, a row each segment.

    Groups without an occurrence in the segment are left out: their one run is zero.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("source", pa.string()), ("starts", pa.list_(pa.int64())),
                                   ("counts", pa.list_(pa.int64()))]))
        lang, entries, times = None, [], []

        def out() -> pa.RecordBatch:
            at: dict[str, list[tuple[int, int]]] = {}
            for i, counts in enumerate(entries):
                for c in counts:
                    at.setdefault(c["source"], []).append((i, c["n"]))
            lengths = np.array(times, dtype=np.int64)
            columns = []
            for source, cells in sorted(at.items()):
                values = np.zeros(len(entries), dtype=np.int64)
                place, n = zip(*cells)
                values[list(place)] = n
                starts, values = _runs(values, lengths)
                columns.append({"source": source, "starts": starts.tolist(),
                                "counts": values.tolist()})
            return pa.RecordBatch.from_arrays(
                [pa.array([lang], pa.string()), pa.array([int(lengths.sum())], pa.int64()),
                 pa.array([columns], kind)], names=["lang", "length", "columns"])

        for batch in batches:
            for l, counts, n in zip(*(c.to_pylist() for c in batch.columns)):
                if entries and (l != lang or len(entries) == size):
                    yield out()
                    entries, times = [], []
                lang = l
                entries.append(counts)
                times.append(n)
        if entries:
            yield out()
    return run


def share(count: np.ndarray, n: int, v: int) -> np.ndarray:
    """1 + floor(SCALE * (count + SMOOTH) / (n + SMOOTH * v)), exact."""
    if count.max(initial=0) > _FITS or n + SMOOTH * v >= 1 << 62:
        return 1 + SCALE * (count.astype(object) + SMOOTH) // (n + SMOOTH * v)
    return 1 + SCALE * (count + SMOOTH) // (n + SMOOTH * v)


def pair_sums(length: int, columns: dict[str, tuple[np.ndarray, np.ndarray]],
              groups: list[tuple[str, int]], v: int) -> Iterator[tuple[str, str, int]]:
    """(a, b, sum of f) of one segment for each pair of groups, a before b."""
    zero = (np.zeros(1, dtype=np.int64), np.zeros(1, dtype=np.int64))
    runs = []
    for source, n in groups:
        starts, counts = columns.get(source, zero)
        runs.append((source, starts, share(counts, n, v)))
    for i, (a, a_starts, a_share) in enumerate(runs):
        for b, b_starts, b_share in runs[i + 1:]:
            starts = np.union1d(a_starts, b_starts)
            f = np.abs(a_share[np.searchsorted(a_starts, starts, "right") - 1]
                       - b_share[np.searchsorted(b_starts, starts, "right") - 1])
            yield a, b, int((f * np.diff(np.append(starts, length))).sum())


def _intersect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments with their language's groups to partial sums (lang, a, b, value)."""
    for batch in batches:
        sums: dict[tuple[str, str, str], int] = {}
        for i in range(batch.num_rows):
            row = batch.slice(i, 1).to_pylist()[0]
            columns = {c["source"]: (np.array(c["starts"], dtype=np.int64),
                                     np.array(c["counts"], dtype=np.int64))
                       for c in row["columns"]}
            groups = [(g["source"], g["tokens"]) for g in row["groups"]]
            for a, b, x in pair_sums(row["length"], columns, groups, row["terms"]):
                key = (row["lang"], a, b)
                sums[key] = sums.get(key, 0) + x
        keys = list(sums)
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[i] for k in keys], pa.string()) for i in range(3)]
            + [pa.array(list(sums.values()), pa.int64())], names=["lang", "a", "b", "value"])


def _share(count: str, n: str) -> Column:
    """``share`` as a Column; decimals, as a product with SCALE may pass 64 bits."""
    return F.expr(f"1 + (cast({count} + {SMOOTH} as decimal(20,0)) * cast({SCALE} as decimal(10,0)))"
                  f" div cast({n} + {SMOOTH} * terms as decimal(20,0))")


def audit(docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang",
          source_col: str = "source", least_docs: int = LEAST_DOCS, top: int = 50) -> DataFrame:
    """lang, source, part, item, value, rank of every (language, source) group.

    Part ``pair``: the distance to each other source of the language, all of them.  Part
    ``term``: the ``top`` terms that the group uses most above its language's share.  Ranks go by
    value descending, then item.  Nulls in text, language or source read as ''.  A group without
    kept terms has the smoothed share everywhere; a language without kept terms gives distances
    of 0 and no terms; one with a single source gives no pairs.  Rows that repeat count each.
    Other columns are not read.  An empty table gives no rows.
    """
    spark = docs.sparkSession
    rows = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(a) for c, a in (
        (lang_col, "lang"), (source_col, "source"), (text_col, "text"))])
    kept = written(spark, vocabulary(rows, least_docs), "audit-vocabulary")
    cells = kept.select("lang", "term", F.explode("counts").alias("c")) \
        .select("lang", "term", "c.source", "c.n")
    # every occurring group, and what its language holds
    tokens = cells.groupBy("lang", "source").agg(F.sum("n").alias("tokens"))
    groups = rows.groupBy("lang", "source").agg(F.lit(0).cast("bigint").alias("tokens")) \
        .unionByName(tokens).groupBy("lang", "source").agg(F.sum("tokens").alias("tokens"))
    langs = groups.groupBy("lang").agg(
        F.sum("tokens").alias("lang_tokens"),
        F.array_sort(F.collect_list(F.struct("source", "tokens"))).alias("groups")).join(
        kept.groupBy("lang").agg(F.count("*").alias("terms")), "lang", "left") \
        .withColumn("terms", F.coalesce("terms", F.lit(0).cast("bigint")))
    langs = written(spark, langs, "audit-groups")
    of = langs.select("lang", "lang_tokens", "terms", F.explode("groups").alias("g")) \
        .select("lang", "lang_tokens", "terms", "g.source", "g.tokens")

    # equal vectors are one entry; entries in vector order make the segments.  Ranges go by the
    # first count and a hash, so that the sample which cuts them holds no whole vectors
    entries = kept.groupBy("lang", "counts").agg(F.count("*").alias("times")) \
        .repartitionByRange("lang", F.col("counts")[0], F.xxhash64("counts")) \
        .sortWithinPartitions("lang", "counts") \
        .select("lang", "counts", "times")
    segments = written(spark, entries.mapInArrow(_encode(SEGMENT), RUNS), "audit-runs")
    sums = segments.join(langs.select("lang", "groups", "terms"), "lang") \
        .mapInArrow(_intersect, "lang string, a string, b string, value bigint") \
        .groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    both = sums.select("lang", F.explode(F.array(
        F.struct(F.col("a").alias("source"), F.col("b").alias("item")),
        F.struct(F.col("b").alias("source"), F.col("a").alias("item")))).alias("p"), "value") \
        .select("lang", "p.source", "p.item", "value")
    others = of.select("lang", "source").join(
        of.select("lang", F.col("source").alias("item")), "lang") \
        .where("source <> item")
    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = others.join(both, ["lang", "source", "item"], "left").select(
        "lang", "source", F.lit("pair").alias("part"), "item",
        F.coalesce("value", F.lit(0).cast("bigint")).alias("value")) \
        .withColumn("rank", F.row_number().over(best))

    total = kept.select("lang", "term", F.expr("aggregate(counts, 0L, (s, c) -> s + c.n)")
                        .alias("total"), F.explode("counts").alias("c")) \
        .select("lang", "term", "total", "c.source", "c.n")
    terms = total.join(of, ["lang", "source"]).select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
        (_share("n", "tokens") - _share("total", "lang_tokens")).alias("value")) \
        .where("value > 0").withColumn("rank", F.row_number().over(best)) \
        .where(F.col("rank") <= top)
    return pairs.unionByName(terms)


def op12_source_audit(spark, sf_dir: str) -> DataFrame:
    return audit(spark.read.parquet(f"{sf_dir}/documents.parquet"))


ORACLE_SQL = """
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS words
  FROM documents),
t AS (SELECT r, lang, source, unnest(words) AS term FROM d),
kept AS MATERIALIZED (SELECT lang, term FROM t GROUP BY lang, term HAVING count(DISTINCT r) >= 30),
c AS MATERIALIZED (
  SELECT lang, source, term, count(*) AS n FROM t SEMI JOIN kept USING (lang, term) GROUP BY ALL),
g AS MATERIALIZED (
  SELECT lang, source, coalesce(sum(n), 0)::BIGINT AS big_n
  FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN c USING (lang, source) GROUP BY ALL),
v AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
l AS (
  SELECT lang, sum(big_n)::BIGINT AS lang_n, coalesce(any_value(v), 0) AS v
  FROM g LEFT JOIN v USING (lang) GROUP BY lang),
p AS MATERIALIZED (
  SELECT g.lang, g.source, kept.term, coalesce(n, 0) AS n,
    (1 + (1000000000 * (coalesce(n, 0) + 5)::HUGEINT) // (big_n + 5 * v))::BIGINT AS p
  FROM g JOIN kept USING (lang) JOIN l USING (lang) LEFT JOIN c USING (lang, source, term)),
q AS (
  SELECT lang, term, (1 + (1000000000 * (sum(n) + 5)::HUGEINT) // (any_value(lang_n) + 5 * any_value(v)))::BIGINT AS q
  FROM p JOIN l USING (lang) GROUP BY lang, term),
f AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p))::BIGINT AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
r AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, p - q FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q)
SELECT *, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INT AS rank
FROM r QUALIFY part = 'pair' OR rank <= 50
"""
