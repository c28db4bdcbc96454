"""Written intermediate tables in the folder that all executors share."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session.  Where none is set, a folder is made for a session
    that is one process (tests); hosts of a cluster would each see a folder of their own."""
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all hosts share")
        d = tempfile.mkdtemp(prefix="ledgerline-ckpt-")
        spark.sparkContext.setCheckpointDir(d)
    return d.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that no other call uses."""
    return f"{shared_dir(spark)}/ledgerline-llm/{name}-{uuid.uuid4().hex[:12]}"


def written(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet once and read it back.

    Cuts the lineage: what comes later recomputes from files, not from the executors' memory.
    The schema comes from the files, so a folder without part files fails instead of reading as
    an empty table.
    """
    path = new_folder(spark, name)
    df.write.parquet(path)
    return spark.read.parquet(path)


def by_place(docs: DataFrame, *columns: Column) -> DataFrame:
    """``docs`` with its columns named by position (_0, _1, ...), and ``columns`` after them.

    ``columns`` are (aliased) expressions over the names of ``docs``.  An operator that passes
    whole rows on works on these names, so no name of the caller's can meet one of its own.
    """
    own = docs.select(*columns).columns
    return docs.select("*", *columns).toDF(*[f"_{i}" for i in range(len(docs.columns))], *own)


def as_named(found: DataFrame, docs: DataFrame) -> DataFrame:
    """The rows of ``found`` (from ``by_place``) with the columns of ``docs`` alone."""
    return found.select(*[f"_{i}" for i in range(len(docs.columns))]).toDF(*docs.columns)


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors this package through Spark (once an application)."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    at = os.path.join(tempfile.mkdtemp(prefix="ledgerline-"), "ledgerline.zip")
    with zipfile.ZipFile(at, "w") as z:
        for folder, _, names in os.walk(root):
            for n in sorted(names):
                if n.endswith(".py"):
                    path = os.path.join(folder, n)
                    z.write(path, os.path.relpath(path, os.path.dirname(root)))
    spark.sparkContext.addPyFile(at)
    _SHIPPED.add(app)
