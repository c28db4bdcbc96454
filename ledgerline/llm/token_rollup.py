"""Delta-maintained token counts by source, language and tokenizer version.

Changes arrive in batches.  A batch becomes signed entries: an inserted document adds its counts,
a deleted one takes away what is on record for it, a revised one does both.  Totals of a batch
are additive and signed too, so the rollup is the sum of the committed batches' totals: no
document is counted again because others changed, and a hot source is one row a batch.

A batch commits by its totals, which are written last and by Spark's own job commit: a batch
without them does not exist for readers, and running it again replaces its entries.  A batch
that is committed is left as it is, so delivering it twice changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .storage import new_folder
from .token_shards import WordEncoder, tokenizer_path

ENTRY = "doc_id bigint, source string, lang string, tokenizer string, n_tokens bigint, sign int"
TOTAL = "source string, lang string, tokenizer string, n_docs bigint, n_tokens bigint"
INSERT, DELETE, REVISE = "insert", "delete", "revise"


def _words() -> Callable[[str], int]:
    space = str.maketrans("\t\n\x0b\x0c\r", "     ")
    return lambda text: len([w for w in text.translate(space).split(" ") if w])


def _word_bpe() -> Callable[[str], int]:
    encoder = WordEncoder(tokenizer_path("word_bpe_49k.json"), 2)
    return lambda text: len(encoder.encode(text)) // 2


#: tokenizer version -> what makes its counter on an executor
TOKENIZERS = {"words-1": _words, "word-bpe-49k": _word_bpe}
_COUNTERS: dict[str, Callable[[str], int]] = {}


def counted(docs: DataFrame, versions: tuple[str, ...], *, id_col: str = "doc_id",
            text_col: str = "text", source_col: str = "source",
            lang_col: str = "lang") -> DataFrame:
    """One entry (sign 1) for each document and tokenizer version; a null text has 0 tokens."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for v in versions:
            _COUNTERS[v] = _COUNTERS.get(v) or TOKENIZERS[v]()
        for batch in batches:
            texts = ["" if t is None else t for t in batch.column(3).to_pylist()]
            for v in versions:
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:3], pa.array([v] * len(texts), pa.string()),
                     pa.array([_COUNTERS[v](t) for t in texts], pa.int64()),
                     pa.array([1] * len(texts), pa.int32())],
                    names=["doc_id", "source", "lang", "tokenizer", "n_tokens", "sign"])

    return docs.select(F.col(id_col).cast("bigint").alias("i"),
                       F.col(source_col).cast("string").alias("s"),
                       F.col(lang_col).cast("string").alias("l"),
                       F.col(text_col).cast("string").alias("t")).mapInArrow(run, ENTRY)


class TokenRollup:
    """The rollup in ``folder``; ``versions`` are the tokenizers that new text is counted by."""

    def __init__(self, spark: SparkSession, folder: str,
                 versions: tuple[str, ...] = tuple(TOKENIZERS)):
        self.spark, self.folder, self.versions = spark, folder, versions

    def committed(self) -> list[str]:
        """Ids of the committed batches (names of a folder listing, not data)."""
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        at = jvm.org.apache.hadoop.fs.Path(f"{self.folder}/totals")
        fs = at.getFileSystem(conf)
        if not fs.exists(at):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(at)]
        return sorted(n.split("=", 1)[1] for n in names if n.startswith("batch=") and
                      fs.exists(jvm.org.apache.hadoop.fs.Path(f"{self.folder}/totals/{n}/_SUCCESS")))

    def _read(self, kind: str, schema: str) -> DataFrame:
        paths = [f"{self.folder}/{kind}/batch={b}" for b in self.committed()]
        return self.spark.read.parquet(*paths) if paths else \
            self.spark.createDataFrame([], schema)

    def live(self) -> DataFrame:
        """Entries on record: what inserts and revisions added and nothing took away."""
        return self._read("entries", ENTRY).groupBy(
            "doc_id", "source", "lang", "tokenizer", "n_tokens").agg(
            F.sum("sign").cast("int").alias("sign")).where("sign <> 0")

    def totals(self) -> DataFrame:
        """source, lang, tokenizer, n_docs, n_tokens; groups without documents are left out."""
        return self._read("totals", TOTAL).groupBy("source", "lang", "tokenizer").agg(
            F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens")) \
            .where("n_docs <> 0 or n_tokens <> 0")

    def commit(self, batch: str, inserts: DataFrame | None = None,
               deletes: DataFrame | None = None, revisions: DataFrame | None = None,
               **columns) -> bool:
        """Apply one batch; False if it was committed before (nothing happens then).

        ``inserts`` and ``revisions`` are documents, ``deletes`` has their ids.  A revision
        replaces all of a document's entries, its source, language and tokenizer versions too;
        one of an unknown document inserts it, and one of a document that the same batch deletes
        stays.  Two revisions of one document in a batch have no order: they are refused
        (ValueError) before anything is written.  A delete of an unknown document does nothing.  An
        insert counts as it is, also for an id on record (repeated rows count each).  Ids that
        are null can be inserted, not deleted or revised.  Null source or language form groups
        of their own.  Empty tables, or none at all, commit an empty batch.
        """
        if batch in self.committed():
            return False
        id_col = columns.get("id_col", "doc_id")
        if revisions is not None:
            twice = revisions.where(F.col(id_col).isNotNull()).groupBy(id_col).count() \
                .where("count > 1").select(id_col).head(1)
            if twice:
                raise ValueError(f"document {twice[0][0]} is revised more than once in batch {batch}")
        parts = [counted(d, self.versions, **columns) for d in (inserts, revisions)
                 if d is not None]
        changed = [d.select(F.col(id_col).cast("bigint").alias("_gone"))
                   for d in (deletes, revisions) if d is not None]
        if changed:
            gone = changed[0] if len(changed) == 1 else changed[0].union(changed[1])
            parts.append(self.live().join(gone.distinct(), F.col("doc_id") == F.col("_gone"),
                                          "left_semi").withColumn("sign", -F.col("sign")))
        entries = self.spark.createDataFrame([], ENTRY)
        for p in parts:
            entries = entries.unionByName(p)
        at = f"{self.folder}/entries/batch={batch}"
        entries.write.mode("overwrite").parquet(at)
        self.spark.read.parquet(at).groupBy("source", "lang", "tokenizer").agg(
            F.sum("sign").cast("bigint").alias("n_docs"),
            F.sum(F.col("sign") * F.col("n_tokens")).alias("n_tokens")) \
            .write.mode("overwrite").parquet(f"{self.folder}/totals/batch={batch}")
        return True


def op3_token_rollup(spark, sf_dir: str) -> DataFrame:
    """The rollup after the load of all documents as one batch of inserts."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rollup = TokenRollup(spark, new_folder(spark, "token-rollup"))
    rollup.commit("load", inserts=docs)
    return rollup.totals()
