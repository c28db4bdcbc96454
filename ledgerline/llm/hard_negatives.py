"""Hard negatives from lists that the anchors of a cluster share (in the manner of MAXIMUS).

Anchors are clustered by direction (spherical k-means, fitted on a bounded sample).  Let ``a`` be
a cluster's centre and ``r`` its largest angle to a member.  No member ``q`` can score more than

    |q| |x| cos(max(0, angle(x, a) - r))

with a candidate ``x``: the angle between them is at least that much.  Without ``|q|`` the bound
is the same for all members, so candidates are sorted by it once a cluster, and every member walks
down that list, scoring exactly, until what it still needs is above the bound of all that follows.

Members walk twice: for their positives (the best rows of the same label), and for the negatives
under the ceiling that each positive sets.  Lists are cut by blocks of candidates, so that tasks
stay small: candidates lie in cells (nearest centre), cells in blocks.  A walk starts in a block
of the cluster's own cell; what is found there is a lower bound, and the cluster's members go only
to cells whose longest and nearest row could still reach it.  Members move to blocks (they are
few); a block moves to no one.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .storage import written

#: anchors that the centres are fitted on, and centres
FIT = 16_384
CENTRES = 128
#: candidates of a block, anchors of a chunk (on average)
BLOCK = 4096
CHUNK = 512
#: list entries of a walk's first step; each step doubles
STEP = 256
#: allowances for rounding, always on the side of walking on
SLACK = 1e-9
RADIANS = 1e-6

ROWS = "vec_id bigint, label bigint, dim int, raw binary, length double, cell int, angle double"
FOUND = "anchor_id bigint, slot int, found_id bigint, score bigint"


# -- rows and centres -----------------------------------------------------------------------

def _integers(batch: pa.RecordBatch, scale: int) -> Iterator[tuple[int, int, np.ndarray]]:
    for i, label, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                           batch.column(2)):
        if i is None or label is None or not v.is_valid or v.values.null_count:
            continue
        x = v.values.to_numpy(zero_copy_only=False).astype(np.float64)
        if np.isfinite(x).all():
            # whole numbers in float64: exact at every size
            x = np.floor(scale * x)
            if np.isfinite(x).all():
                yield i, label, x


def _length(x: np.ndarray) -> np.ndarray:
    """Lengths of rows; large components are scaled first so that squares stay finite."""
    most = np.abs(x).max(axis=-1, initial=0.0)
    by = np.where(most > 0, most, 1.0)
    return by * np.sqrt(np.square(x / by[..., None]).sum(axis=-1))


def _unit(x: np.ndarray) -> np.ndarray:
    n = _length(x)
    return x / np.where(n > 0, n, 1.0)[..., None]


def _angles(unit: np.ndarray, centre: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(unit @ centre, -1.0, 1.0))


def fit_centres(sample: np.ndarray, k: int, rounds: int = 8, seed: int = 1) -> np.ndarray:
    """Unit centres of at most ``k`` clusters of the sample's directions."""
    unit = _unit(sample)
    unit = unit[np.abs(unit).max(axis=1, initial=0) > 0]
    if not len(unit):
        return np.zeros((1, sample.shape[1]))
    centres = unit[np.random.default_rng(seed).permutation(len(unit))[:k]]
    for _ in range(rounds):
        near = (unit @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, unit)
        moved = _unit(sums)
        centres = np.where(np.abs(moved).max(axis=1, keepdims=True) > 0, moved, centres)
    return centres


def _rows(scale: int, centres: dict[int, np.ndarray]):
    """Rows (id, label, vector) to ROWS; dimensions without a centre have one cell of any angle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            by_dim: dict[int, list[tuple[int, int, np.ndarray]]] = {}
            for row in _integers(batch, scale):
                by_dim.setdefault(len(row[2]), []).append(row)
            for dim, rows in by_dim.items():
                x = np.array([r[2] for r in rows]).reshape(len(rows), dim)
                cell, angle = np.zeros(len(rows), np.int32), np.full(len(rows), np.pi)
                if dim in centres:
                    near = np.clip(_unit(x) @ centres[dim].T, -1.0, 1.0)
                    cell = near.argmax(axis=1).astype(np.int32)
                    angle = np.arccos(near[np.arange(len(rows)), cell])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[0] for r in rows], pa.int64()),
                     pa.array([r[1] for r in rows], pa.int64()),
                     pa.array([dim] * len(rows), pa.int32()),
                     pa.array([r[2].tobytes() for r in rows], pa.binary()),
                     pa.array(_length(x), pa.float64()), pa.array(cell), pa.array(angle)],
                    names=["vec_id", "label", "dim", "raw", "length", "cell", "angle"])
    return run


def _products(q: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Exact inner products of whole numbers: int64, or Python integers where those are larger."""
    most = float(np.abs(q).max(initial=0)) * float(np.abs(p).max(initial=0)) * max(q.shape[-1], 1)
    if most < 1 << 53:
        return (q @ p.T).astype(np.int64)
    if most < 1 << 62 and max(np.abs(q).max(), np.abs(p).max()) < 1 << 62:
        return q.astype(np.int64) @ p.astype(np.int64).T
    whole = np.frompyfunc(int, 1, 1)
    return whole(q).astype(object) @ whole(p).astype(object).T


# -- walking --------------------------------------------------------------------------------

def _fields(rows: pa.StructScalar) -> dict[str, pa.Array]:
    s = rows.values
    return {s.type.field(i).name: s.field(i) for i in range(s.type.num_fields)}


def _matrix(raw: pa.Array, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(raw.to_pylist()), np.float64).reshape(len(raw), dim)


class Chunk:
    """Members of one cluster; ``slots`` are what they look for, ``need`` their lower bounds.

    A slot is (member, number, low, high): scores from low to high count; with ``same`` only rows
    of the member's label, else only rows of other labels.
    """

    def __init__(self, members: dict[str, pa.Array], dim: int, centre: np.ndarray | None):
        self.ids = members["vec_id"].to_numpy()
        self.labels = members["label"].to_numpy()
        self.x = _matrix(members["raw"], dim)
        self.lengths = members["length"].to_numpy()
        self.centre = centre
        real = self.lengths > 0
        angles = _angles(_unit(self.x), centre) if centre is not None else np.full(len(real), np.pi)
        self.radius = float(angles[real].max(initial=0.0)) + RADIANS
        slots = members["slots"].to_pylist()
        flat = [(m, s["slot"], s["low"], s["high"]) for m, mine in enumerate(slots) for s in mine]
        flat = flat or [(0, 0, 1, 0)]
        self.member = np.array([s[0] for s in flat])
        self.slot = np.array([s[1] for s in flat])
        self.low = np.array([s[2] if s[2] is not None else -np.inf for s in flat], dtype=object)
        self.high = np.array([s[3] if s[3] is not None else np.inf for s in flat], dtype=object)

    def bounds(self, x: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Of candidates, without the member's length."""
        if self.centre is None:
            return lengths.copy()
        apart = _angles(_unit(x), self.centre) - self.radius - RADIANS
        return lengths * np.cos(np.clip(apart, 0.0, np.pi))

    def open(self, bound: float, need: np.ndarray) -> np.ndarray:
        """Slots whose need a candidate with this bound may still meet."""
        most = self.lengths[self.member] * bound
        room = SLACK * (np.abs(most) + np.where(np.isfinite(need), np.abs(need), 0.0))
        return np.flatnonzero(most + room >= need)

    def walk(self, ids: np.ndarray, labels: np.ndarray, x: np.ndarray, same: bool,
             k: int) -> tuple[list, list, list, list]:
        """(anchor_id, slot, found_id, score): what may be among the first k of each slot."""
        lengths = _length(x)
        bounds = self.bounds(x, lengths)
        order = np.lexsort((ids, -bounds))                   # the shared list
        ids, labels, x, bounds = ids[order], labels[order], x[order], bounds[order]
        held: list[tuple[np.ndarray, np.ndarray] | None] = [None] * len(self.member)
        need = np.array([float(v) for v in self.low])
        at, step = 0, STEP
        while at < len(ids):
            # certified: nothing from here on reaches what the other slots still need
            live = self.open(bounds[at], need)
            if not len(live):
                break
            part = slice(at, at + step)
            members, place = np.unique(self.member[live], return_inverse=True)
            scores = _products(self.x[members], x[part])
            fits = (labels[part][None, :] == self.labels[members][:, None]) == same
            if same:
                fits &= ids[part][None, :] != self.ids[members][:, None]
            for j, row in zip(live, place):
                s = scores[row]
                ok = np.flatnonzero(fits[row] & (s >= self.low[j]) & (s <= self.high[j]))
                if not len(ok):
                    continue
                s, i = s[ok], ids[part][ok]
                if held[j] is not None:
                    s, i = np.concatenate([held[j][0], s]), np.concatenate([held[j][1], i])
                if len(s) >= k:
                    best = np.argsort(i, kind="stable")
                    best = best[np.argsort(-s[best], kind="stable")][:k]
                    s, i = s[best], i[best]
                    self.low[j] = max(self.low[j], s[-1])
                    need[j] = float(self.low[j])
                held[j] = (s, i)
            at, step = at + step, 2 * step
        out: tuple[list, list, list, list] = ([], [], [], [])
        for j in (j for j, h in enumerate(held) if h is not None):
            s, i = held[j]
            out[0].extend([int(self.ids[self.member[j]])] * len(s))
            out[1].extend([int(self.slot[j])] * len(s))
            out[2].extend(i.tolist())
            out[3].extend(int(v) for v in s)
        return out


def _centre(centres: dict[int, np.ndarray], dim: int, cell: int) -> np.ndarray | None:
    found = centres.get(dim)
    return found[cell] if found is not None and np.abs(found[cell]).max(initial=0) > 0 else None


def _walk(centres, same: bool, k: int):
    """Rows (dim, own, members, candidates) to FOUND rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                dim, own = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
                chunk = Chunk(_fields(batch.column(2)[i]), dim, _centre(centres.value, dim, own))
                c = _fields(batch.column(3)[i])
                found = chunk.walk(c["vec_id"].to_numpy(), c["label"].to_numpy(),
                                   _matrix(c["raw"], dim), same, k)
                if found[3] and max(map(abs, found[3])) >= 1 << 63:
                    raise OverflowError("a score exceeds 64 bits")
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found[0], pa.int64()), pa.array(found[1], pa.int32()),
                     pa.array(found[2], pa.int64()), pa.array(found[3], pa.int64())],
                    names=["anchor_id", "slot", "found_id", "score"])
    return run


def _ask(centres, cells):
    """Chunks (dim, own, chunk, members) to (dim, own, chunk, cell): where a member's need may
    still be met."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: tuple[list, list, list, list] = ([], [], [], [])
            for i in range(batch.num_rows):
                dim, own, number = (batch.column(j)[i].as_py() for j in range(3))
                chunk = Chunk(_fields(batch.column(3)[i]), dim, _centre(centres.value, dim, own))
                need = np.array([float(v) for v in chunk.low])
                for (d, cell), (_, longest, angle) in cells.value.items():
                    if d != dim:
                        continue
                    other = _centre(centres.value, dim, cell)
                    near = 0.0
                    if other is not None and chunk.centre is not None:
                        near = float(_angles(other, chunk.centre)) - chunk.radius - angle - 2 * RADIANS
                    # the longest row if the cell faces the members, else (a negative bound) none
                    most = longest * max(0.0, math.cos(min(max(near, 0.0), math.pi)))
                    if len(chunk.open(most, need)):
                        for column, v in zip(out, (dim, own, number, cell)):
                            column.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int32()) for c in out],
                                             names=["dim", "own", "chunk", "cell"])
    return run


# -- the operator ---------------------------------------------------------------------------

def mine(vectors: DataFrame, is_anchor: Column, *, id_col: str = "vec_id",
         label: Column | str = "label", vector_col: str = "embedding", scale: int = 256,
         n_positives: int = 5, n_negatives: int = 10, low_percent: int = 30,
         high_percent: int = 90) -> DataFrame:
    """anchor_id, positive_rank, positive_id, rank, negative_id, positive_score, negative_score.

    A row's score is the inner product of ``floor(scale * x)`` with the anchor.  An anchor's
    positives are its best ``n_positives`` other rows of the same label; for each the best
    ``n_negatives`` rows of other labels with ``low_percent * p <= 100 * n <= high_percent * p``.
    Ties go to the smaller id; fewer where there are fewer.  ``is_anchor`` is a condition on
    ``vec_id``, ``label`` an expression over the input's columns that gives an integer.

    Rows with a null id, label or vector, or a null or non-finite component take no part; rows are
    compared with those of the same dimension.  An anchor id that repeats is mined once (smallest
    label, then smallest bytes), and rows with its id are not its positives; other rows that
    repeat count each.  A zero vector scores 0 with all rows.  A score beyond 64 bits among the
    results ends the job.  Other columns are not read.  An empty table gives no rows.
    """
    spark = vectors.sparkSession
    label = F.col(label) if isinstance(label, str) else label
    given = vectors.select(F.col(id_col).cast("bigint").alias("vec_id"),
                           label.cast("bigint").alias("label"),
                           F.col(vector_col).cast("array<double>").alias("v"))
    # the centres see at most FIT anchors, those with the smallest hashes of their id
    drawn = given.where(is_anchor).select("*", F.xxhash64("vec_id").alias("draw")) \
        .orderBy("draw", "vec_id", "label").limit(FIT).select("vec_id", "label", "v")
    sample: dict[int, list[bytes]] = {}
    for r in drawn.mapInArrow(_rows(scale, {}), ROWS).select("dim", "raw").collect():
        sample.setdefault(r["dim"], []).append(bytes(r["raw"]))
    centres = {}
    for dim, raws in sorted(sample.items()):
        if dim:
            x = np.frombuffer(b"".join(sorted(raws)), np.float64).reshape(len(raws), dim)
            centres[dim] = fit_centres(x, min(CENTRES, round(math.sqrt(len(raws)))))
    base = written(spark, given.mapInArrow(_rows(scale, centres), ROWS), "hard-rows")
    # a row each dimension and centre
    sizes = {(r["dim"], r["cell"]): (r["n"], r["longest"], r["angle"]) for r in base.groupBy(
        "dim", "cell").agg(F.count("*").alias("n"), F.max("length").alias("longest"),
                           F.max("angle").alias("angle")).collect()}
    if not sizes:
        return spark.createDataFrame([], "anchor_id bigint, positive_rank int, positive_id bigint, "
                                     "rank int, negative_id bigint, positive_score bigint, "
                                     "negative_score bigint")
    cells = spark.createDataFrame([(d, c, max(1, -(-n // BLOCK)))
                                   for (d, c), (n, _, _) in sorted(sizes.items())],
                                  "dim int, cell int, n_blocks int")
    # rows are dealt by their place in the written table, so rows that share an id spread too
    blocks = written(spark, base.join(cells, ["dim", "cell"]).withColumn("block", F.pmod(
        F.xxhash64(F.monotonically_increasing_id()), F.col("n_blocks")).cast("int"))
        .groupBy("dim", "cell", "block").agg(
            F.collect_list(F.struct("vec_id", "label", "raw")).alias("candidates")),
        "hard-blocks")
    anchors = base.where(is_anchor).groupBy("vec_id").agg(
        F.min(F.struct("label", "raw", "dim", "length", "cell")).alias("a")) \
        .select("vec_id", "a.*")
    n_chunks = anchors.groupBy("dim", "cell").agg(
        F.greatest(F.lit(1), F.expr(f"count(*) div {CHUNK}")).cast("int").alias("n_chunks"))
    anchors = written(spark, anchors.join(n_chunks, ["dim", "cell"]).select(
        "vec_id", "label", "raw", "length", "dim", F.col("cell").alias("own"),
        F.pmod(F.xxhash64("vec_id"), F.col("n_chunks")).cast("int").alias("chunk")),
        "hard-anchors")
    shared, asked = spark.sparkContext.broadcast(centres), spark.sparkContext.broadcast(sizes)

    def search(slots: DataFrame, same: bool, k: int, name: str) -> DataFrame:
        """The first k of each slot (vec_id, slot, low, high), low and high null if open."""
        def chunks(rows: DataFrame) -> DataFrame:
            by_anchor = rows.groupBy("vec_id").agg(F.collect_list(F.struct(
                "slot", "low", "high")).alias("slots"))
            return anchors.join(by_anchor, "vec_id").groupBy("dim", "own", "chunk").agg(
                F.collect_list(F.struct("vec_id", "label", "raw", "length", "slots"))
                .alias("members"))

        def walked(pairs: DataFrame) -> DataFrame:
            return pairs.join(blocks, ["dim", "cell", "block"]) \
                .select("dim", "own", "members", "candidates") \
                .mapInArrow(_walk(shared, same, k), FOUND)

        seed = written(spark, walked(chunks(slots).withColumn("cell", F.col("own"))
                                     .withColumn("block", F.lit(0))), f"{name}-seed")
        kth = seed.groupBy("anchor_id", "slot").agg(
            F.when(F.count("*") >= k, F.min("score")).alias("kth"))
        raised = slots.join(kth.withColumnRenamed("anchor_id", "vec_id"), ["vec_id", "slot"], "left") \
            .select("vec_id", "slot", F.greatest("low", "kth").alias("low"), "high")
        ready = written(spark, chunks(raised), f"{name}-chunks")
        asks = ready.select("dim", "own", "chunk", "members").mapInArrow(
            _ask(shared, asked), "dim int, own int, chunk int, cell int") \
            .join(cells, ["dim", "cell"]).withColumn(
                "block", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1))) \
            .where("not (cell = own and block = 0)").drop("n_blocks")
        rest = walked(asks.join(ready, ["dim", "own", "chunk"]))
        best = Window.partitionBy("anchor_id", "slot").orderBy(F.desc("score"), "found_id")
        return seed.unionByName(rest).withColumn("rank", F.row_number().over(best)) \
            .where(F.col("rank") <= k)

    none = F.lit(None).cast("bigint")
    positives = written(spark, search(anchors.select(
        "vec_id", F.lit(0).alias("slot"), none.alias("low"), none.alias("high")),
        True, n_positives, "hard-positives").select(
        F.col("anchor_id").alias("vec_id"), F.col("rank").alias("slot"),
        F.col("found_id").alias("positive_id"), F.col("score").alias("positive_score")),
        "hard-positives")
    # 100 n between low_percent p and high_percent p, in whole numbers
    p = F.col("positive_score").cast("decimal(38,0)")
    ceilings = positives.select(
        "vec_id", "slot", F.ceil(p * low_percent / 100).cast("bigint").alias("low"),
        F.floor(p * high_percent / 100).cast("bigint").alias("high")).where("low <= high")
    negatives = search(ceilings, False, n_negatives, "hard-negatives")
    return negatives.join(positives.withColumnRenamed("vec_id", "anchor_id"), ["anchor_id", "slot"]) \
        .select("anchor_id", F.col("slot").alias("positive_rank"), "positive_id", "rank",
                F.col("found_id").alias("negative_id"), "positive_score",
                F.col("score").alias("negative_score"))


def op11_hard_negatives(spark, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 100 == 0,
                label=label)


ORACLE_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
a AS (SELECT * FROM v WHERE vec_id % 100 = 0
  QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY label) = 1),
s AS MATERIALIZED (
  SELECT a.vec_id AS anchor_id, v.vec_id AS id, a.label = v.label AS same,
    list_sum(list_transform(list_zip(a.e, v.e), lambda z: z[1] * z[2]))::BIGINT AS score
  FROM a JOIN v ON len(a.e) = len(v.e)),
p AS (
  SELECT anchor_id, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) AS positive_rank,
    id AS positive_id, score AS positive_score
  FROM s WHERE same AND id <> anchor_id),
n AS (
  SELECT p.anchor_id, positive_rank, positive_id, id AS negative_id, positive_score, score AS negative_score,
    row_number() OVER (PARTITION BY p.anchor_id, positive_rank ORDER BY score DESC, id) AS rank
  FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT same
    AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
  WHERE positive_rank <= 5)
SELECT anchor_id, positive_rank::INT AS positive_rank, positive_id, rank::INT AS rank, negative_id,
  positive_score, negative_score
FROM n WHERE rank <= 10
"""
