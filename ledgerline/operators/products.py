"""Product dictionary: every product name is classified once, lines look their name up.

The cost rule and the fee class of a line follow from its product name by some 25 substring
tests.  A shop has few names and very many lines, so the distinct names are classified and a line
meets its two codes by an equality join: the dictionary is small, so Spark's size check broadcasts
it and lines of one very frequent name need no shuffle.

A catalog that has every name in a small relation (``Catalog.product_names``) gives a complete
dictionary.  A stored one (``refresh``) may lack the names of the newest lines; lines whose name
it lacks are classified directly.  A catalog with neither classifies every line.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import Catalog
from . import rules as R


def fee_class(name: Column) -> Column:
    """Number (from 1) of the first TikTok fee rule that matches, 0 if none."""
    numbered = [(r[0], i + 1) for i, r in enumerate(R.TIKTOK_FEE_RULES)]
    return R.first_match(name, numbered, lambda r: F.lit(r[1]), F.lit(0), any_keyword=True)


def fee_of(number: Column, fallback: str | None) -> Column:
    """(1 - fee) * 100 of a fee class; ``fallback`` as in ``rules.tiktok_fee_factor``."""
    default = R.fee_factor(fallback) if fallback is not None else R.fee_factor("1")
    values = [default, *[R.fee_factor(r[1]) for r in R.TIKTOK_FEE_RULES]]
    return F.element_at(F.array(*[F.lit(v).cast("decimal(9,4)") for v in values]), number + 1)


def classify(names: DataFrame) -> DataFrame:
    """``nama, rule, fee_class`` of the distinct names; NULL is no name."""
    return names.select("nama").where("nama IS NOT NULL").distinct().select(
        "nama", R.cogs_rule_index(F.col("nama")).cast("int").alias("rule"),
        fee_class(F.col("nama")).cast("int").alias("fee_class"))


def refresh(spark: SparkSession, path: str, lines: DataFrame) -> DataFrame:
    """Add the names of ``lines`` that the dictionary at ``path`` lacks; returns the dictionary.

    Only new names are classified and written, as one more file.  A run that fails leaves the
    dictionary as it was and can be repeated.  After a change of the rules, write to a new path.
    """
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    there = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)
    new = lines.select("nama").where("nama IS NOT NULL").distinct()
    if there:
        new = new.join(spark.read.parquet(path).select("nama"), "nama", "left_anti")
    classify(new).coalesce(1).write.mode("append").parquet(path)
    return spark.read.parquet(path).dropDuplicates(["nama"])


def with_codes(cat: Catalog, lines: DataFrame, fee_fallback: str | None) -> DataFrame:
    """``lines`` (with ``nama``) without the name, with ``rule`` and ``fee``.

    A NULL name has no rule and the fallback's fee, like a name that no rule matches.
    """
    rest = [c for c in lines.columns if c != "nama"]
    rule, number = R.cogs_rule_index(F.col("nama")).cast("int"), fee_class(F.col("nama")).cast("int")
    if cat.product_names is None and cat.products is None:
        return lines.select(*rest, rule.alias("rule"),
                            R.tiktok_fee_factor(F.col("nama"), fee_fallback).alias("fee"))
    if cat.product_names is not None:
        codes, missing = classify(cat.product_names()), (F.lit(0), F.lit(0))
    else:
        codes, missing = cat.products, (rule, number)
    codes = codes.select(F.col("nama").alias("_name"), F.col("rule").alias("_rule"),
                         F.col("fee_class").alias("_fee"))
    j = lines.join(codes, lines["nama"] == codes["_name"], "left")
    return j.select(*rest, F.coalesce("_rule", missing[0]).alias("rule"),
                    fee_of(F.coalesce("_fee", missing[1]), fee_fallback).alias("fee"))
