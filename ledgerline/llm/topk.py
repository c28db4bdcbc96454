"""Exact top-k inner products by norm-bucketed retrieval.

Vectors are grouped by length into buckets, and large buckets into blocks.  Every query first
meets one block of long vectors; its k-th score there is a lower bound.  With that bound:

* a bucket whose longest vector cannot reach it (``|q| |p| < bound``) is dropped for the query
  before anything moves;
* within a block the bound gives a local cosine threshold ``t = bound / (|q| max |p|)``.  Where
  ``t`` is high, coordinate pruning keeps the vectors whose unit coordinates lie in the range
  that ``t`` leaves around the query's largest coordinates; where it is low, length pruning
  keeps the vectors that are long enough;
* what is left is verified by the integer product.

Queries and candidates meet block by block (a task holds one block of each); the number of
results that leave a block is at most k a query.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .storage import written

#: candidates and queries that one task holds
BLOCK = 4096
QUERY_BLOCK = 1024
#: norm buckets
BUCKETS = 32
#: cosine threshold from which coordinates prune; coordinates that are looked at
COORDINATE_FROM = 0.5
FOCUS = 4
#: rounding allowance of the bounds, always on the side of keeping
SLACK = 1e-9

INTEGERS = "vec_id bigint, dim int, raw binary, norm2 double"
RESULT = "query_id bigint, vec_id bigint, score bigint"


def integer_vectors(vectors: DataFrame, *, id_col: str, vector_col: str,
                    scale: int = 256) -> DataFrame:
    """vec_id, dim, floor(scale * x) as bytes of float64 (whole numbers of any size), squared
    length.

    Rows with a null id, a null vector, a null or non-finite component take no part.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, dims, raws, norms = [], [], [], []
            for i, v in zip(batch.column(0).to_pylist(), batch.column(1)):
                if i is None or not v.is_valid or v.values.null_count:
                    continue
                x = v.values.to_numpy(zero_copy_only=False).astype(np.float64)
                if not np.isfinite(x).all():
                    continue
                x = np.floor(scale * x)
                ids.append(i)
                dims.append(len(x))
                raws.append(x.tobytes())
                norms.append(float(x @ x))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(dims, pa.int32()),
                 pa.array(raws, pa.binary()), pa.array(norms, pa.float64())],
                names=["vec_id", "dim", "raw", "norm2"])

    return vectors.select(F.col(id_col).cast("bigint").alias("i"),
                          F.col(vector_col).cast("array<double>").alias("v")) \
        .mapInArrow(run, INTEGERS)


def _matrix(raw: pa.ChunkedArray, dim: int) -> np.ndarray:
    data = b"".join(raw.to_pylist())
    return np.frombuffer(data, np.float64).reshape(len(raw), dim)


def _products(q: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Exact products of whole numbers, by the narrowest arithmetic in which every sum is exact;
    Python's integers beyond 64 bits."""
    most = float(np.abs(q).max(initial=0)) * float(np.abs(p).max(initial=0)) * max(q.shape[-1], 1)
    if most < 1 << 53:
        return (q.astype(np.float64) @ p.astype(np.float64).T).astype(np.int64)
    if most < 1 << 62 and max(np.abs(q).max(), np.abs(p).max()) < 1 << 62:
        return q.astype(np.int64) @ p.astype(np.int64).T
    whole = np.frompyfunc(int, 1, 1)
    return whole(q).astype(object) @ whole(p).astype(object).T


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best, ties to the smaller id; ids ascend."""
    if len(scores) <= k or scores.dtype == object:
        return np.argsort(-scores, kind="stable")[:k]
    least = np.partition(scores, len(scores) - k)[len(scores) - k]
    over = np.flatnonzero(scores > least)
    tied = np.flatnonzero(scores == least)[:k - len(over)]
    return np.concatenate([over[np.argsort(-scores[over], kind="stable")], tied])


def search_block(query_ids, queries, bounds, ids, vectors, k) -> tuple[list, list, list]:
    """Scores that can be among a query's k best, from one block; ``bounds``: NaN if none yet."""
    order = np.argsort(ids, kind="stable")
    ids, vectors = ids[order], vectors[order]
    p = vectors.astype(np.float64)
    length = np.sqrt((p * p).sum(axis=1))
    q = queries.astype(np.float64)
    q_length = np.sqrt((q * q).sum(axis=1))
    longest = length.max(initial=0.0)
    with np.errstate(divide="ignore", invalid="ignore"):
        t = bounds / (q_length * longest)
    limited = ~np.isnan(bounds) & (bounds > 0)
    dead = limited & (q_length * longest * (1 + SLACK) < bounds)
    by_coordinate = limited & ~dead & (t >= COORDINATE_FROM)
    out: tuple[list, list, list] = ([], [], [])

    def take(j: int, scores: np.ndarray, those: np.ndarray) -> None:
        ok = those != query_ids[j]
        if not np.isnan(bounds[j]):
            ok &= scores >= bounds[j]
        scores, those = scores[ok], those[ok]
        for x in _best(scores, those, k):
            if abs(int(scores[x])) >= 1 << 63:
                raise ValueError(f"query {query_ids[j]}: a score is too large for 64 bits")
            out[0].append(int(query_ids[j]))
            out[1].append(int(those[x]))
            out[2].append(int(scores[x]))

    unit = None
    for j in np.flatnonzero(by_coordinate):
        if unit is None:
            unit = np.ascontiguousarray((p / np.where(length > 0, length, 1.0)[:, None]).T)
        # a vector of length |p| must reach the cosine bound / (|q| |p|), at least t
        left = length * q_length[j] * (1 + SLACK) >= bounds[j]
        cos = min(float(t[j]), 1.0)
        mine = q[j] / q_length[j]
        for c in np.argsort(-np.abs(mine))[:FOCUS]:
            # p lies within arccos(cos) of q: its coordinate lies between the cosines of the
            # angles to this axis that are so far from q's own, up to the axis itself
            reach = np.sqrt(max(0.0, (1 - cos * cos) * (1 - mine[c] * mine[c]))) + 1e-7
            if mine[c] > -cos:
                left &= unit[c] >= mine[c] * cos - reach
            if mine[c] < cos:
                left &= unit[c] <= mine[c] * cos + reach
        some = np.flatnonzero(left)
        if len(some):
            take(j, _products(queries[j:j + 1], vectors[some])[0], ids[some])
    # length pruning: the vectors in order of length, long enough for the least demanding query
    rest = np.flatnonzero(~dead & ~by_coordinate)
    for a in range(0, len(rest), 256):
        some = rest[a:a + 256]
        need = np.where(limited[some], bounds[some] / np.where(q_length[some] > 0,
                                                               q_length[some], 1.0), 0.0)
        long = np.flatnonzero(length * (1 + SLACK) >= need.min())
        scores = _products(queries[some], vectors[long])
        for row, j in enumerate(some):
            take(j, scores[row], ids[long])
    return out


def _search(k: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        found: tuple[list, list, list] = ([], [], [])
        if left.num_rows and right.num_rows:
            dim = left.column("dim")[0].as_py()
            found = search_block(
                left.column("vec_id").to_numpy(), _matrix(left.column("raw"), dim),
                left.column("bound").to_numpy().astype(np.float64),
                right.column("vec_id").to_numpy(), _matrix(right.column("raw"), dim), k)
        return pa.table({"query_id": pa.array(found[0], pa.int64()),
                         "vec_id": pa.array(found[1], pa.int64()),
                         "score": pa.array(found[2], pa.int64())})
    return run


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, *, id_col: str = "vec_id",
          vector_col: str = "embedding", scale: int = 256) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k best of every query, all if there are fewer.

    ``is_query`` is a condition on ``vec_id``.  Ties go to the smaller id.  Vectors that are null
    or hold null or non-finite components take no part, as query or candidate; vectors are
    compared with those of the same dimension only.  A score beyond 64 bits among the results
    ends the job.  Rows that share the query's id are not its
    candidates; a query id that repeats is searched once (its smallest vector); repeated
    candidate rows count each.  Other columns are not read.  An empty table gives no rows.
    """
    spark = vectors.sparkSession
    base = written(spark, integer_vectors(vectors, id_col=id_col, vector_col=vector_col,
                                          scale=scale), "integer-vectors")
    n, nq = base.agg(F.count("*"), F.count(F.when(is_query, 1))).first()
    if not n or not nq:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    # buckets: ranges of squared length, longest first; equal lengths share a bucket
    cuts = base.agg(F.percentile_approx("norm2", [i / BUCKETS for i in range(1, BUCKETS)], 2000)
                    .alias("c")).first()["c"]
    bucket = sum((F.when(F.col("norm2") < c, 1).otherwise(0) for c in sorted(set(cuts))),
                 F.lit(0)).cast("int")
    placed = base.withColumn("bucket", bucket)
    sizes = {(r["dim"], r["bucket"]): r for r in placed.groupBy("dim", "bucket").agg(
        F.count("*").alias("n"), F.max("norm2").alias("m")).collect()}
    blocks = spark.createDataFrame(
        [(d, b, -(-r["n"] // BLOCK), float(r["m"])) for (d, b), r in sorted(sizes.items())],
        "dim int, bucket int, n_blocks int, longest2 double")
    first = {d: min(b for e, b in sizes if e == d) for d, _ in sizes}
    q_blocks = -(-nq // QUERY_BLOCK)
    queries = placed.where(is_query).groupBy("vec_id").agg(
        F.min(F.struct("dim", "raw", "norm2")).alias("v")).select(
        F.col("vec_id").alias("vec_id"), "v.*", F.pmod(F.xxhash64("vec_id"), F.lit(q_blocks)).cast("int").alias("q"))
    members = placed.join(blocks, ["dim", "bucket"]).select(
        *[F.col(c).alias(c) for c in ("dim", "bucket", "vec_id", "raw", "n_blocks")]).withColumn(
        "block", F.pmod(F.xxhash64("vec_id", F.lit("block")), F.col("n_blocks")).cast("int"))
    every_q = F.explode(F.sequence(F.lit(0), F.lit(q_blocks - 1))).alias("q")
    is_first = F.col("block") == 0
    is_first &= F.col("bucket") == sum(
        (F.when(F.col("dim") == d, b).otherwise(0) for d, b in first.items()), F.lit(0))
    run = _search(k)
    lead = members.where(is_first)
    seed = written(spark, queries.withColumn("bound", F.lit(None).cast("double"))
                   .groupBy("dim", "q").cogroup(
                       lead.select("dim", every_q, "vec_id", "raw").groupBy("dim", "q"))
                   .applyInArrow(run, RESULT), "seed")
    bounds = seed.groupBy("query_id").agg(
        F.when(F.count("*") >= k, F.min("score")).cast("double").alias("bound"))
    bounded = queries.join(bounds, queries["vec_id"] == bounds["query_id"], "left")
    # a bucket meets a query only if its longest vector can reach the query's bound
    reach = F.sqrt(F.col("norm2") * F.col("longest2")) * (1 + SLACK)
    asked = bounded.join(blocks, "dim").where(
        F.col("bound").isNull() | (F.col("bound") <= 0) | (reach >= F.col("bound"))) \
        .select("vec_id", "dim", "raw", "bound", "q", "bucket",
                F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)).alias("block")) \
        .where(~is_first)
    keys = ["dim", "q", "bucket", "block"]
    rest = asked.groupBy(*keys).cogroup(
        members.where(~is_first).select("dim", every_q, "bucket", "block", "vec_id", "raw")
        .groupBy(*keys)).applyInArrow(run, RESULT)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return seed.unionByName(rest).withColumn("rank", F.row_number().over(best)) \
        .where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op7_topk(spark, sf_dir: str) -> DataFrame:
    return top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 50 == 0)


ORACLE_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, p.vec_id,
    list_sum(list_transform(list_zip(q.e, p.e), lambda z: z[1] * z[2]))::BIGINT AS score
  FROM v q JOIN v p ON q.vec_id % 50 = 0 AND p.vec_id <> q.vec_id AND len(p.e) = len(q.e)),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank::INT AS rank, vec_id, score FROM r WHERE rank <= 5
"""
