"""Exact de-duplication with a cuckoo-filter index over content digests.

Documents are equal when their texts are identical after deleting white space.  The digest space
is split into shards by digest prefix.  A shard holds a cuckoo filter (16-bit fingerprints, four
to a bucket) and its bucketed content: the full digests that are live, each with the row that
stays, the number of rows and the number of rows that tie with the one that stays.  An arriving
digest is looked up in the filter; a miss inserts it, a hit is verified against the content, and
a false hit inserts too.  A digest whose last row is deleted leaves the filter and the content.
When an insert finds no place after ``MAX_KICKS`` moves, the table doubles and is filled again
from the stored keys.

Skew: copies are combined inside every input partition before they move, so one digest costs at
most one row for each partition, however many copies there are.  Texts never move.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .storage import as_named, by_place, new_folder, written
from .texts import SPACE

SLOTS = 4
MAX_KICKS = 200
#: digests a shard is planned for; its filter grows beyond that
SHARD_DIGESTS = 8192
#: distinct digests a task combines before it passes them on
COMBINE = 65536


class CuckooFilter:
    """Approximate set of digests with deletion; ``2 ** bits`` buckets of four fingerprints."""

    def __init__(self, bits: int = 6, table: bytes | None = None):
        self.mask = (1 << bits) - 1
        self.bits = bits
        self.table = array("H", bytes(2 * SLOTS << bits))
        if table is not None:
            self.table = array("H")
            self.table.frombytes(table)
        self.turn = 0

    @staticmethod
    def _print(digest: bytes) -> int:
        return int.from_bytes(digest[16:18], "little") or 1

    def _first(self, digest: bytes) -> int:
        return int.from_bytes(digest[8:16], "little") & self.mask

    def _other(self, bucket: int, fingerprint: int) -> int:
        return (bucket ^ (fingerprint * 0x5BD1E995 >> 5)) & self.mask

    def _slots(self, bucket: int) -> range:
        return range(bucket * SLOTS, bucket * SLOTS + SLOTS)

    def __contains__(self, digest: bytes) -> bool:
        f, b = self._print(digest), self._first(digest)
        t = self.table
        return f in t[b * SLOTS:b * SLOTS + SLOTS] or \
            f in t[(o := self._other(b, f)) * SLOTS:o * SLOTS + SLOTS]

    def insert(self, digest: bytes) -> bool:
        """False if no place was found: the filter must be resized."""
        f, b = self._print(digest), self._first(digest)
        path: list[tuple[int, int]] = []
        for bucket in (b, self._other(b, f)):
            for s in self._slots(bucket):
                if not self.table[s]:
                    self.table[s] = f
                    return True
        for _ in range(MAX_KICKS):
            self.turn = (self.turn * 5 + 1) & 0xFFFF
            s = b * SLOTS + (self.turn >> 8) % SLOTS
            path.append((s, self.table[s]))
            f, self.table[s] = self.table[s], f
            b = self._other(b, f)
            for s in self._slots(b):
                if not self.table[s]:
                    self.table[s] = f
                    return True
        for s, was in reversed(path):            # nothing that was in it is lost
            self.table[s] = was
        return False

    def delete(self, digest: bytes) -> bool:
        """Only for digests that were inserted."""
        f, b = self._print(digest), self._first(digest)
        for bucket in (b, self._other(b, f)):
            for s in self._slots(bucket):
                if self.table[s] == f:
                    self.table[s] = 0
                    return True
        return False


class Shard:
    """One shard's filter and content.  A content entry: [keep_id, keep_len, rows, keep_rows]."""

    def __init__(self):
        self.filter = CuckooFilter()
        self.content: dict[bytes, list] = {}
        self.false_hits = 0

    def load(self, content: dict[bytes, list], bits: int | None, table: bytes | None) -> None:
        self.content = content
        if table is not None:
            self.filter = CuckooFilter(bits, table)
        else:
            self._resize(self.filter.bits)

    def _resize(self, bits: int) -> None:
        while True:
            self.filter = CuckooFilter(bits)
            if all(self.filter.insert(d) for d in self.content):
                return
            bits += 1

    def add(self, digest: bytes, keep_id, keep_len: int, rows: int, keep_rows: int) -> None:
        if digest in self.filter:
            old = self.content.get(digest)       # verifies the hit
            if old is not None:
                self.content[digest] = better(old, [keep_id, keep_len, rows, keep_rows])
                return
            self.false_hits += 1
        if len(self.content) > 0.95 * SLOTS * (self.filter.mask + 1) or \
                not self.filter.insert(digest):
            self.content[digest] = [keep_id, keep_len, rows, keep_rows]
            self._resize(self.filter.bits + 1)
            return
        self.content[digest] = [keep_id, keep_len, rows, keep_rows]

    def remove(self, digest: bytes) -> None:
        if digest in self.filter and digest in self.content:
            self.filter.delete(digest)
            del self.content[digest]


def better(a: list, b: list) -> list:
    """Merge two summaries: more code points first, then the smaller id; a null id comes last."""
    def key(x):
        return (-x[1], x[0] is None, x[0] if x[0] is not None else 0)
    ka, kb = key(a), key(b)
    best = a if ka <= kb else b
    return [best[0], best[1], a[2] + b[2], a[3] + b[3] if ka == kb else best[3]]


ROWS = "doc_id bigint, digest binary, n_chars bigint"
STATE = ("shard int, digest binary, keep_id bigint, keep_len bigint, n_rows bigint, "
         "keep_rows bigint, bits int, filter binary")


def digest_rows(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, digest, n_chars) of every row: SHA-256 of the UTF-8 text without white space."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = pc.fill_null(batch.column(1), "")
            digests = [hashlib.sha256(t.as_py().translate(None, SPACE)).digest()
                       for t in text.cast(pa.binary())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(digests, pa.binary()),
                 pc.utf8_length(text).cast(pa.int64())], names=["doc_id", "digest", "n_chars"])

    return docs.select(F.col(id_col).cast("bigint").alias("i"),
                       F.col(text_col).cast("string").alias("t")).mapInArrow(run, ROWS)


def _combined(rows: DataFrame) -> DataFrame:
    """Copies combined within each input partition, a bounded number of digests at a time."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, list] = {}

        def flush():
            return pa.RecordBatch.from_arrays(
                [pa.array(list(held), pa.binary()),
                 *[pa.array([v[i] for v in held.values()], pa.int64()) for i in range(4)]],
                names=["digest", "keep_id", "keep_len", "n_rows", "keep_rows"])

        for batch in batches:
            for i, d, n in zip(*(c.to_pylist() for c in batch.columns)):
                new = [i, n, 1, 1]
                held[d] = better(held[d], new) if d in held else new
            if len(held) >= COMBINE:
                yield flush()
                held.clear()
        yield flush()

    return rows.mapInArrow(run, "digest binary, keep_id bigint, keep_len bigint, n_rows bigint, "
                                "keep_rows bigint")


def _shard_of(n_shards: int):
    return (F.conv(F.hex(F.substring("digest", 1, 4)), 16, 10).cast("bigint")
            % n_shards).cast("int")


def _apply(n_shards: int):
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        shard = Shard()
        number = int(frame["shard"].iloc[0])
        stored = frame[frame["op"] == 0]
        saved = frame[frame["op"] == 3]
        usable = len(saved) == 1 and int(saved["n_rows"].iloc[0]) == n_shards
        if len(stored):
            shard.load({bytes(d): [_id(i), int(n), int(r), int(k)] for d, i, n, r, k in zip(
                stored["digest"], stored["keep_id"], stored["keep_len"], stored["n_rows"],
                stored["keep_rows"])},
                int(saved["bits"].iloc[0]) if usable else None,
                bytes(saved["filter"].iloc[0]) if usable else None)
        for d in frame.loc[frame["op"] == 1, "digest"]:
            shard.remove(bytes(d))
        new = frame[frame["op"] == 2]
        for d, i, n, r, k in zip(new["digest"], new["keep_id"], new["keep_len"], new["n_rows"],
                                 new["keep_rows"]):
            shard.add(bytes(d), _id(i), int(n), int(r), int(k))
        out = [(number, d, *v, None, None) for d, v in shard.content.items()]
        # the filter's own row: n_rows says for how many shards it was built
        out.append((number, None, None, None, n_shards, None, shard.filter.bits,
                    shard.filter.table.tobytes()))
        frame = pd.DataFrame(out, columns=["shard", "digest", "keep_id", "keep_len", "n_rows",
                                           "keep_rows", "bits", "filter"])
        for c in ("keep_id", "keep_len", "n_rows", "keep_rows"):
            frame[c] = frame[c].astype("Int64")
        frame["bits"] = frame["bits"].astype("Int32")
        return frame

    return run


def _id(x):
    return None if pd.isna(x) else int(x)


def update_index(spark: SparkSession, path: str, inserts: DataFrame | None = None,
                 deletes: DataFrame | None = None, before: str | None = None, *,
                 id_col: str = "doc_id", text_col: str = "text") -> str:
    """Write the index version that follows ``before`` to ``path`` (a new folder); returns it.

    ``path/rows`` has the live rows (doc_id, digest, n_chars), ``path/state`` the shards.  Old
    versions are never changed, so a run that dies part way can start again.  ``deletes`` has
    documents to take out (matched by id and digest; all rows that repeat such a document go).
    The digests they touch leave the index and come back from the rows that remain, so a group
    whose kept row is deleted gets the next best row.
    """
    new = digest_rows(inserts, id_col=id_col, text_col=text_col) if inserts is not None \
        else spark.createDataFrame([], ROWS)
    state = spark.read.parquet(f"{before}/state") if before else None
    empty = spark.createDataFrame([], "op int, " + STATE.replace("shard int, ", ""))
    if before and deletes is not None:
        live = spark.read.parquet(f"{before}/rows")
        gone = digest_rows(deletes, id_col=id_col, text_col=text_col).select(
            F.col("doc_id").alias("g"), F.col("digest").alias("h")).distinct()
        left = live.join(gone, F.col("doc_id").eqNullSafe(F.col("g"))
                         & (F.col("digest") == F.col("h")), "left_anti")
        touched = gone.select(F.col("h").alias("digest")).distinct()
        back = left.join(touched, "digest", "left_semi").select("doc_id", "digest", "n_chars")
        new.unionByName(left).write.parquet(f"{path}/rows")
        removed = touched.select(F.lit(1).alias("op"), "digest")
        added = new.unionByName(back)
    else:
        fresh = new if not before else new.unionByName(spark.read.parquet(f"{before}/rows"))
        fresh.write.parquet(f"{path}/rows")
        removed = None
        # a first load takes its digests from the rows just written, not from the texts again
        added = new if before else spark.read.parquet(f"{path}/rows")
    n_rows = spark.read.parquet(f"{path}/rows").count()
    n_shards = max(16, -(-n_rows // SHARD_DIGESTS))
    deltas = empty.unionByName(_combined(added).withColumn("op", F.lit(2)),
                               allowMissingColumns=True)
    if removed is not None:
        deltas = deltas.unionByName(removed, allowMissingColumns=True)
    if state is not None:
        deltas = deltas.unionByName(state.where("digest is not null").drop("shard")
                                    .withColumn("op", F.lit(0)), allowMissingColumns=True)
    deltas = deltas.withColumn("shard", _shard_of(n_shards))
    if state is not None:
        deltas = deltas.unionByName(state.where("digest is null and n_rows = %d" % n_shards)
                                    .withColumn("op", F.lit(3)), allowMissingColumns=True)
    out = deltas.groupBy("shard").applyInPandas(_apply(n_shards), STATE)
    out.write.parquet(f"{path}/state")
    return path


def groups(spark: SparkSession, path: str) -> DataFrame:
    """digest, keep_id, keep_len, n_rows, keep_rows of every live digest."""
    return spark.read.parquet(f"{path}/state").where("digest is not null").select(
        "digest", "keep_id", "keep_len", "n_rows", "keep_rows")


def dedup(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256, keep_rows.

    Of equal texts, the row with the most code points stays, then the smallest id (a null id
    comes last).  A null text counts as an empty one; all texts without anything but white space
    form one group.  Rows that repeat both id and text agree in everything: each is marked kept
    when the document stays, and ``keep_rows`` (over 1) tells how many they are.  Other columns
    are not read.  An empty table gives an empty result.
    """
    spark = docs.sparkSession
    path = update_index(spark, new_folder(spark, "cuckoo"), docs, id_col=id_col,
                        text_col=text_col)
    rows = spark.read.parquet(f"{path}/rows")
    return rows.join(groups(spark, path), "digest", "left").select(
        F.col("doc_id").alias(id_col), "keep_id", F.col("n_rows").alias("group_size"),
        (F.col("doc_id").eqNullSafe(F.col("keep_id"))
         & (F.col("n_chars") == F.col("keep_len"))).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"), "keep_rows")


def keep_first(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; one of rows that repeat.

    Other columns, whatever they are called, pass through.
    """
    spark = docs.sparkSession
    found = written(spark, dedup(docs, id_col=id_col, text_col=text_col), "dedup").withColumnRenamed(
        id_col, "doc_id")
    at = [f"_{docs.columns.index(c)}" for c in (id_col, text_col)]
    return as_named(_kept_rows(by_place(docs), found, *at), docs)


def _kept_rows(rows: DataFrame, found: DataFrame, id_at: str, text_at: str) -> DataFrame:
    """The rows (by position) that ``found`` (``dedup``) keeps."""
    gone = found.where("not kept").select(F.col("doc_id").alias("_gone"),
                                          F.col("text_sha256").alias("_sha")).distinct()
    digest = F.sha2(F.translate(F.coalesce(text_at, F.lit("")), SPACE.decode(), ""), 256)
    repeats = found.where("kept and keep_rows > 1").select(F.col("doc_id").alias("_again")).distinct()
    if gone.join(found.where("kept"), F.col("_gone").eqNullSafe(F.col("doc_id")),
                 "left_semi").isEmpty():
        # no id is both kept and dropped: ids alone decide
        left = rows.join(gone.select("_gone").distinct(),
                         F.col(id_at).eqNullSafe(F.col("_gone")), "left_anti")
    else:
        left = rows.join(found.where("kept").select(
            F.col("doc_id").alias("_id"), F.col("text_sha256").alias("_sha")).distinct(),
            F.col(id_at).eqNullSafe(F.col("_id")) & (digest == F.col("_sha")), "left_semi")
    if repeats.isEmpty():
        return left
    again = F.col(id_at).eqNullSafe(F.col("_again"))
    once = left.join(repeats, again, "left_anti")
    some = left.join(repeats, again, "left_semi")
    first = F.row_number().over(Window.partitionBy(F.col(id_at), digest)
                                .orderBy(F.length(text_at).desc_nulls_last()))
    return once.unionByName(some.withColumn("_n", first).where("_n = 1").drop("_n"))


def op9_exact_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return dedup(docs).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


ORACLE_SQL = """
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
    sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id, first(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size,
  doc_id = first(doc_id) OVER w AS kept, text_sha256
FROM d
WINDOW w AS (PARTITION BY text_sha256 ORDER BY n DESC, doc_id
             ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)
"""
