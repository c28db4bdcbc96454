"""Packing by optimal length buckets.

The histogram of all sequence lengths goes to a dynamic programme that chooses the bucket
boundaries with the least padding; inside each bucket sequences form batches under a token
budget, every batch padded to its bucket's boundary.

The histogram has one bin for each length that occurs, at any length: as many rows as there are
distinct lengths reach the driver, however many documents there are.  Batches are formed in
cells: a bucket is split by a hash of the id into cells of bounded size, and cells that many rows
of one id (or of the null id) fill beyond that are split again, so no bucket and no id ever meets
in one task.  Only the last batch of a cell can be part empty.
"""

from __future__ import annotations

from bisect import bisect_left

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .storage import written

#: sequences a cell is planned for, in full batches and in rows
CELL_BATCHES = 16
CELL_ROWS = 1024
#: a cell with more than this many times its planned rows is split
OVERFULL = 2

#: fixed value: words are runs of anything but these bytes' characters
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Number of words; 0 for a null text."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def optimal_boundaries(histogram: dict[int, int], n_buckets: int) -> list[int]:
    """At most ``n_buckets`` ascending boundaries with the least total padding.

    Padding: the sum over sequences of (boundary of their bucket - length).  Of equally good
    choices the last bucket starts as early as it can, and so on down.  Empty: no boundary.
    """
    lengths = sorted(histogram)
    if not lengths:
        return []
    rows, total = [0], [0]
    for x in lengths:
        rows.append(rows[-1] + histogram[x])
        total.append(total[-1] + histogram[x] * x)
    n = len(lengths)
    # best[j]: least padding of the first j bins in the buckets so far; one bucket ends at j
    best = [0] + [x * r - t for x, r, t in zip(lengths, rows[1:], total[1:])]
    back = []
    for used in range(2, min(n_buckets, n) + 1):
        # A bucket from bin i to bin j costs lengths[j-1] * (rows[j] - rows[i]) less what its rows
        # hold: for each i a line over the boundary length, falling faster the larger i is.  The
        # hull keeps the lines that are lowest somewhere; boundaries ascend, so the walk does too.
        new, cut, hull, at = list(best), [0] * (n + 1), [], 0
        for j in range(used, n + 1):
            line = (best[j - 1] + total[j - 1], rows[j - 1], j - 1)
            while len(hull) > 1 and not _needed(hull[-2], hull[-1], line):
                hull.pop()
            hull.append(line)
            at, x = min(at, len(hull) - 1), lengths[j - 1]
            while at + 1 < len(hull) and (hull[at + 1][0] - x * hull[at + 1][1]
                                          < hull[at][0] - x * hull[at][1]):
                at += 1
            base, slope, cut[j] = hull[at]
            new[j] = base - x * slope + x * rows[j] - total[j]
        best = new
        back.append(cut)
    ends, j = [], n
    for cut in reversed(back):
        ends.append(j)
        j = cut[j]
    ends.append(j)
    return [lengths[e - 1] for e in reversed(ends)]


def _needed(a: tuple, b: tuple, c: tuple) -> bool:
    """Whether line b lies below a somewhere before c does (lines: base, slope, bin)."""
    return (c[0] - a[0]) * (b[1] - a[1]) > (b[0] - a[0]) * (c[1] - a[1])


def draw(id_col: Column) -> Column:
    """A number from 0 to 2 ** 32 - 1 that the id alone decides."""
    key = F.md5(F.coalesce(id_col.cast("string"), F.lit("null")).cast("binary"))
    return F.conv(F.substring(key, 1, 8), 16, 10).cast("bigint")


def pack(lengths: DataFrame, *, id_col: str = "doc_id", length_col: str = "n_tokens",
         n_buckets: int = 8, budget: int = 16384) -> DataFrame:
    """id, n_tokens, bucket, bucket_len, cell, batch, place, padding: one row for each row.

    A batch (bucket, cell, batch) holds up to ``budget // bucket_len`` sequences, one at least:
    a sequence longer than the budget is a batch of its own bucket's capacity of one.  A null
    length counts as 0; sequences of length 0 go to the shortest bucket.  ``bucket_len`` is the
    longest length of the bucket.  Rows that repeat get places of their own.  A cell that rows of
    one id, or of the null id, fill to more than OVERFULL times its plan is split into cells that
    are numbered after the bucket's planned ones.  Other columns are not read.  An empty table
    gives no rows.
    """
    spark = lengths.sparkSession
    rows = written(spark, lengths.select(
        F.col(id_col).alias("_id"), F.greatest(F.coalesce(F.col(length_col), F.lit(0)), F.lit(0))
        .cast("bigint").alias("_n")), "lengths")
    histogram = {r["_n"]: r["n"] for r in rows.groupBy("_n").agg(F.count("*").alias("n")).collect()}
    ends = optimal_boundaries(histogram, n_buckets) or [0]
    held = [0] * len(ends)
    for length, n in histogram.items():
        held[bisect_left(ends, length)] += n
    room = [max(1, budget // max(e, 1)) for e in ends]
    plan = [max(CELL_ROWS, CELL_BATCHES * r) for r in room]
    cells = [max(1, -(-n // p)) for n, p in zip(held, plan)]
    pick = lambda values: F.element_at(F.array(*[F.lit(v).cast("bigint") for v in values]),
                                       F.col("bucket") + 1)
    bucket = sum((F.when(F.col("_n") > e, 1).otherwise(0) for e in ends[:-1]), F.lit(0)).cast("int")
    placed = rows.withColumn("bucket", bucket).select(
        "_id", "_n", "bucket", pick(ends).alias("bucket_len"), pick(room).alias("_room"),
        draw(F.col("_id")).alias("_draw"), pick(cells).alias("_cells")) \
        .withColumn("cell", F.col("_draw") % F.col("_cells"))
    overfull = written(spark, placed.groupBy("bucket", "cell").agg(F.count("*").alias("_in"))
                       .where(F.col("_in") > OVERFULL * pick(plan))
                       .withColumn("_parts", F.ceil(F.col("_in") / pick(plan))), "overfull")
    if not overfull.isEmpty():
        # the files of ``rows`` do not change, so a task that runs again numbers its rows alike
        part = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.col("_parts"))
        placed = placed.join(overfull, ["bucket", "cell"], "left").withColumn(
            "cell", F.when(F.col("_parts").isNull(), F.col("cell"))
            .otherwise(F.col("_cells") * (part + 1) + F.col("cell")))
    turn = F.row_number().over(Window.partitionBy("bucket", "cell").orderBy("_draw", "_id", "_n"))
    return placed.withColumn("_turn", turn.cast("bigint") - 1).select(
        F.col("_id").alias(id_col), F.col("_n").alias("n_tokens"), "bucket", "bucket_len", "cell",
        F.floor(F.col("_turn") / F.col("_room")).cast("bigint").alias("batch"),
        (F.col("_turn") % F.col("_room")).alias("place"),
        (F.col("bucket_len") - F.col("_n")).alias("padding"))


def op8_packing(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    # words and one end mark
    lengths = docs.select("doc_id", (word_count(F.col("text")) + 1).alias("n_tokens"))
    return pack(lengths)


def oracle_sql(documents: str = "documents", n_buckets: int = 8, budget: int = 16384) -> str:
    """DuckDB SQL of ``op8_packing``: the dynamic programme as one CTE for each bucket."""
    steps, chosen = [], []
    steps.append("dp1 AS (SELECT j, len * rows - tot AS cost FROM bins)")
    for k in range(2, n_buckets + 1):
        steps.append(f"""dp{k} AS (
  SELECT b.j, min(p.cost + b.len * (b.rows - a.rows) - (b.tot - a.tot)) AS cost,
    arg_min(a.j, (p.cost + b.len * (b.rows - a.rows) - (b.tot - a.tot)) * 1000000 + a.j) AS cut
  FROM bins b JOIN bins a ON a.j < b.j AND a.j >= {k - 1} JOIN dp{k - 1} p ON p.j = a.j
  GROUP BY b.j)""")
    steps.append(f"e{n_buckets} AS (SELECT max(j) AS j FROM bins)")
    for k in range(n_buckets, 1, -1):
        steps.append(f"e{k - 1} AS (SELECT cut AS j FROM dp{k} JOIN e{k} USING (j))")
    for k in range(1, n_buckets + 1):
        chosen.append(f"SELECT {k - 1} AS bucket, len FROM bins JOIN e{k} USING (j)")
    return f"""
WITH w AS (
  SELECT doc_id, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT + 1 AS n
  FROM {documents}),
r AS (
  SELECT *, n AS b,
    ('0x' || substr(md5(coalesce(doc_id::VARCHAR, 'null')), 1, 8))::BIGINT AS draw FROM w),
bins AS (
  SELECT row_number() OVER (ORDER BY b) AS j, b AS len,
    (sum(count(*)) OVER (ORDER BY b))::BIGINT AS rows,
    (sum(count(*) * b) OVER (ORDER BY b))::BIGINT AS tot FROM r GROUP BY b),
{",".join(steps)},
ends AS ({" UNION ALL ".join(chosen)}),
z AS (
  SELECT r.*, e.bucket, e.len AS bucket_len FROM r
  JOIN ends e ON r.b <= e.len LEFT JOIN ends f ON f.bucket = e.bucket - 1
  WHERE f.len IS NULL OR r.b > f.len),
c AS (
  SELECT *, greatest(1, {budget} // greatest(bucket_len, 1)) AS room,
    count(*) OVER (PARTITION BY bucket) AS held FROM z),
d AS (
  SELECT *, draw % greatest(1, ceil(held / greatest({CELL_ROWS}, {CELL_BATCHES} * room)))::BIGINT AS cell FROM c),
t AS (SELECT *, row_number() OVER (PARTITION BY bucket, cell ORDER BY draw, doc_id, n) - 1 AS turn FROM d)
SELECT doc_id, n AS n_tokens, bucket::INT AS bucket, bucket_len, cell, (turn // room)::BIGINT AS batch,
  (turn % room)::BIGINT AS place, bucket_len - n AS padding FROM t
"""
