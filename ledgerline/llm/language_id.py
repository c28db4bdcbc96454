"""Language identification by compression.

Each language owns a raw-content zstandard dictionary made of sampled texts.  A text is encoded
once with every language's dictionary; the language whose dictionary gives the fewest bytes wins,
and the document is rejected when the runner-up comes too close.

Before encoding, texts are reduced to lower-case letters with single spaces between them, so that
markup, digits and shouting do not decide.  The whole text is encoded, in blocks that each start
from the dictionary (one long frame would learn the text's own language after some kilobytes and
blur the difference).
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StringType, StructField, StructType

UNKNOWN = "und"
_NOT_LETTERS = re.compile(r"[\W\d_]+")
#: ends every block: with it even a block of one word is compressed, never stored as it is, so
#: that its matches in the dictionary count
_FILL = b" " * 64

_RESULT = StructType([StructField("lang_pred", StringType()), StructField("score", DoubleType()),
                      StructField("margin", DoubleType()), StructField("rejected", BooleanType())])


@dataclass(frozen=True)
class LanguageModel:
    """Dictionaries by language; at most ``dictionary_bytes`` each."""

    dictionaries: dict[str, bytes]
    block_bytes: int = 4096
    level: int = 5
    min_margin: float = 0.002


def letters(text: str) -> bytes:
    return _NOT_LETTERS.sub(" ", text.lower()).strip().encode("utf-8", "replace")


def has_letter(text: str | None) -> bool:
    return text is not None and any(c.isalpha() for c in text)


def fit(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
        lang_col: str = "lang", train: Column | None = None, sample_docs: int = 400,
        dictionary_bytes: int = 131072, **settings) -> LanguageModel:
    """Learn one dictionary a language from a bounded sample of labelled rows.

    The bound: of each language, about ``sample_docs`` labelled documents, chosen by a hash of
    their id over the whole table, and of their letters at most ``dictionary_bytes``.  Rows with
    a null text, language or id do not teach.  A table without labelled rows gives an empty
    model, which answers ``und`` for every text.
    """
    rows = docs.select(F.col(id_col).cast("string").alias("i"), F.col(text_col).alias("t"),
                       F.col(lang_col).alias("l"),
                       (F.lit(True) if train is None else train).alias("u"))
    rows = rows.where("u and l is not null and t is not null and i is not null").drop("u")
    counts = {r["l"]: r["n"] for r in rows.groupBy("l").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return LanguageModel({}, **settings)
    # Every row draws a uniform number from its id; the share that fits the sample is taken
    # before anything moves, so no task sees more than a few thousand texts of a language.
    draw = F.pmod(F.xxhash64(F.lit("language sample"), "i"), F.lit(1 << 40)) / float(1 << 40)
    share = F.lit(0.0)
    for lang, n in sorted(counts.items()):
        share = F.when(F.col("l") == lang, F.lit(min(1.0, sample_docs / n))).otherwise(share)
    sample = rows.withColumn("d", draw).where(F.col("d") < share)
    texts: dict[str, bytes] = {lang: b"" for lang in sorted(counts)}
    for r in sample.select("l", "t", "d").orderBy("d", "i").toLocalIterator():
        if len(texts[r["l"]]) < dictionary_bytes:
            texts[r["l"]] += letters(r["t"]) + b" "
    return LanguageModel({k: v[:dictionary_bytes] for k, v in texts.items() if v.strip()},
                         **settings)


def _encoders(model: LanguageModel) -> list[tuple[str, zstandard.ZstdCompressor]]:
    out = []
    for lang, raw in sorted(model.dictionaries.items()):
        d = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        d.precompute_compress(level=model.level)
        out.append((lang, zstandard.ZstdCompressor(
            dict_data=d, level=model.level, write_content_size=False, write_checksum=False,
            write_dict_id=False)))
    return out


def classify(text: str | None, encoders, model: LanguageModel) -> tuple:
    """(lang_pred, score, margin, rejected) of one text."""
    if not encoders or not has_letter(text):
        return UNKNOWN, 0.0, 0.0, True
    raw = letters(text)
    size, step = len(raw), model.block_bytes
    blocks = [raw[i:i + step] + _FILL for i in range(0, size, step)]
    sizes = sorted((sum(len(c.compress(b)) for b in blocks), lang) for lang, c in encoders)
    best, lang = sizes[0]
    # A byte saved over the best language counts as one bit of evidence.
    score = 1.0 / sum(2.0 ** -min(n - best, 1000) for n, _ in sizes)
    margin = (sizes[1][0] - best) / best if len(sizes) > 1 else 1.0
    return lang, score, margin, margin < model.min_margin


def _judged(docs: DataFrame, model: LanguageModel, text_at: int) -> DataFrame:
    """``docs`` by position (_0, _1, ...) and the four result columns."""
    source = docs.toDF(*[f"_{i}" for i in range(len(docs.columns))])
    schema = StructType([*source.schema.fields, *_RESULT.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoders = _encoders(model)
        for batch in batches:
            found = [classify(t.as_py(), encoders, model) for t in batch.column(text_at)]
            lang, score, margin, rejected = zip(*found) if found else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(lang, pa.string()), pa.array(score, pa.float64()),
                 pa.array(margin, pa.float64()), pa.array(rejected, pa.bool_())],
                names=[*batch.schema.names, *_RESULT.names])

    return source.mapInArrow(run, schema)


def identify(docs: DataFrame, model: LanguageModel, *, text_col: str = "text",
             keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns of ``docs`` plus ``lang_pred, score, margin, rejected``, row by row.

    A null text, an empty text and one without a letter get ``und`` with score 0 and are
    rejected; so is every text when the model is empty.  Equal sizes go to the first language
    in alphabetical order (margin 0, rejected).  Repeated rows each get their own result.  Other
    columns, whatever they are called, are neither read nor returned.
    """
    out = _judged(docs.select(*keep, F.col(text_col).cast("string")), model, len(keep))
    return out.select(*[F.col(f"_{i}").alias(c) for i, c in enumerate(keep)], *_RESULT.names)


def accepted(docs: DataFrame, model: LanguageModel, *, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are not rejected, with all their columns."""
    out = _judged(docs, model, docs.columns.index(text_col)).where("not rejected")
    return out.select(*[F.col(f"_{i}").alias(c) for i, c in enumerate(docs.columns)])


def remainder(id_col: str, modulus: int) -> Column:
    """crc32 of the id written as text, modulo ``modulus``: the fold of a document."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % modulus


def op1_language_id(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    fold = remainder("doc_id", 4)
    model = fit(docs, train=fold != 2)
    return identify(docs, model).select(
        "doc_id", (fold == 2).alias("held_out"), "lang_pred", "score", "margin", "rejected")
