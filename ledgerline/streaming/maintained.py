"""Aggregates that are not additive, kept up to date by signed batches.

``SUM(DISTINCT amount)`` per order and the survivor of a marketplace id cannot be corrected by
adding a number.  Both follow from a counted multiset: which rows are there, and how often.  A
batch brings rows with a sign (+1 inserted, -1 deleted; an update is both), so multisets merge by
adding counts, in any order and split.

* ``distinct_sums``: the amounts of an order that are there at least once, summed up.  An amount
  that is settled twice counts once, and still counts after one of the two is deleted.
* ``survivors``: of the copies of a marketplace id that are there, the best.  A copy that changes
  or leaves gives way to the next, which is still in the state.

``MultisetState`` keeps the batches as Parquet.  A batch is committed by the rename of its folder,
under its own name: one that is applied again changes nothing, one that fails leaves nothing.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

COUNT = "_times"


def signed(inserted: DataFrame | None, deleted: DataFrame | None = None) -> DataFrame:
    """Rows of a batch with their count: +1 for each inserted one, -1 for each deleted one."""
    parts = [df.withColumn(COUNT, F.lit(s).cast("bigint"))
             for df, s in ((inserted, 1), (deleted, -1)) if df is not None]
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def merged(deltas: DataFrame) -> DataFrame:
    """The rows of signed deltas that are there, once each, with their count.

    The counts are added up with partial sums, so one row that repeats very often is one number
    of each task.  A row whose count is not positive is not there (a delete may come first).
    """
    keys = [c for c in deltas.columns if c != COUNT]
    return deltas.groupBy(*[F.col(f"`{c}`") for c in keys]).agg(F.sum(COUNT).alias(COUNT)) \
        .where(F.col(COUNT) > 0)


def distinct_sums(state: DataFrame, keys: Sequence[str], amount: str, name: str) -> DataFrame:
    """``SUM(DISTINCT amount)`` per key of a merged state; NULL for a key whose amounts are all
    NULL.  (A state of keys and amounts alone has each once, the others may repeat them.)"""
    return state.groupBy(*keys).agg(F.sum_distinct(amount).alias(name))


def survivors(state: DataFrame, key: str, order: Sequence[Column]) -> DataFrame:
    """The first row of each key in ``order``; the NULL key is one group.  Ranks are limited before
    the shuffle, so a very large group sends one row of each task."""
    first = Window.partitionBy(key).orderBy(*order)
    return state.withColumn("_turn", F.row_number().over(first)).where(F.col("_turn") == 1) \
        .drop("_turn")


class MultisetState:
    """Signed batches under ``path``, and what they add up to."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _at(self, name: str):
        at = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        return at, at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def batches(self) -> list[str]:
        """Names of the committed batches."""
        at, fs = self._at("")
        if not fs.exists(at):
            return []
        return sorted(n.removeprefix("batch-") for n in
                      (x.getPath().getName() for x in fs.listStatus(at)) if n.startswith("batch-"))

    def _put(self, name: str, deltas: DataFrame) -> bool:
        done, fs = self._at(name)
        if fs.exists(done):
            return False
        staged, _ = self._at(f"_staged-{uuid.uuid4().hex[:12]}")
        try:
            keys = [c for c in deltas.columns if c != COUNT]
            deltas.groupBy(*[F.col(f"`{c}`") for c in keys]).agg(F.sum(COUNT).alias(COUNT)) \
                .where(F.col(COUNT) != 0).write.parquet(staged.toString())
            return fs.rename(staged, done)
        finally:
            fs.delete(staged, True)

    def apply(self, batch: str, inserted: DataFrame | None,
              deleted: DataFrame | None = None) -> bool:
        """Commit a batch; False if one of this name is committed already (it changes nothing)."""
        return self._put(f"batch-{batch}", signed(inserted, deleted))

    def deltas(self) -> DataFrame:
        names = self.batches()
        if not names:
            raise ValueError(f"no batch under {self.path}")
        return self.spark.read.parquet(*[f"{self.path}/batch-{n}" for n in names])

    def current(self) -> DataFrame:
        return merged(self.deltas())

    def compact(self, into: str) -> "MultisetState":
        """The same state with all batches summed into one, under another path."""
        out = MultisetState(self.spark, into)
        out._put("batch-" + "+".join(self.batches()), self.deltas())
        return out
