"""A training-data pipeline over ``documents``: five stages, each one of the llm operators.

Every stage gets what its predecessor kept (written as Parquet and read again) and works on all
of it; all but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import cuckoo_dedup, jaccard_join, language_id, length_buckets, mixing
from ledgerline.llm.storage import as_named, by_place, ship, written


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without letters and those whose two best languages are about equal.

    Null, empty and blank texts have no letters and go; rows that repeat share their fate.  A
    table without labelled rows gives an empty model, which rejects every document.  Other
    columns, whatever they are called, pass through.  An empty table stays empty.
    """
    ship(spark)
    return language_id.accepted(docs, language_id.fit(docs))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts (white space apart) stays: the longest, then the
    smallest id, a null id last; of rows that repeat one.  Null texts count as empty and form one
    group with blank ones.  Other columns pass through.  An empty table stays empty.
    """
    ship(spark)
    return cuckoo_dedup.keep_first(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component linked on five-word shingles at 0.8 stays: the first id's.

    Rows are told apart by id and text, so an id that repeats with another text, or a null id,
    is a document like any other (a null id comes last).  Rows without a shingle (null, empty and
    blank texts) all stay.  Other columns pass through.  An empty table stays empty.
    """
    ship(spark)
    at, text_at = (f"_{docs.columns.index(c)}" for c in ("doc_id", "text"))
    keyed = by_place(docs).withColumn(
        "_row", F.xxhash64(at, F.coalesce(text_at, F.lit(""))))
    found = written(spark, jaccard_join.components(keyed, id_col="_row", text_col=text_at, words=5,
                                                   percent=80), "near-copies").where("n_shingles > 0")
    ids = keyed.select(F.col("_row").alias("_of"), F.col(at).alias("doc_id")).distinct()
    first = found.join(ids, F.col("_row") == F.col("_of")).groupBy("component_id").agg(
        F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "_row")).alias("first"))
    gone = found.join(first.select(F.col("first._row").alias("_row")), "_row", "left_anti") \
        .select("_row").distinct()
    left = keyed.join(gone, "_row", "left_anti")
    again = written(spark, found.groupBy("_row").count().where("count > 1").select("_row"), "again")
    if not again.isEmpty():
        left = left.join(again, "_row", "left_anti").unionByName(
            left.join(again, "_row", "left_semi").dropDuplicates(["_row"]))
    return as_named(left, docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample of half the tokens whose sources, languages and topics are evened out.

    Null sources and languages are values of their own; texts without words take their cell's
    probability; rows that repeat an id are drawn together.  Other columns pass through.  An
    empty table stays empty.
    """
    ship(spark)
    return mixing.sampled(docs)


def pack_batches(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The batches that the documents left are packed into, one row a document.

    A null or empty text is its end mark alone; rows that repeat get places of their own, null
    ids too.  An empty table gives no rows.
    """
    ship(spark)
    return length_buckets.pack(docs.select(
        "doc_id", (length_buckets.word_count(F.col("text")) + 1).alias("n_tokens")))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", identify_language),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_batches),
]

#: zstandard sizes decide the first stage, which SQL cannot express
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(spark, stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
