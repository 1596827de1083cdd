"""Shared helpers of the training-data operators."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import tidesync
from tidesync.session import fresh_dir

#: Words of every operator here: runs of characters other than ASCII white space.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers once per application, as ``--py-files`` would."""
    sc = spark.sparkContext
    if getattr(sc, "_tidesync_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(tidesync.__file__))
    if os.path.isdir(root):  # else it came in a zip with --py-files
        target = os.path.join(tempfile.mkdtemp(prefix="tidesync-"), "tidesync.zip")
        with zipfile.ZipFile(target, "w") as z:
            for folder, _, names in os.walk(root):
                for name in sorted(names):
                    if name.endswith(".py"):
                        path = os.path.join(folder, name)
                        z.write(path, os.path.relpath(path, os.path.dirname(root)))
        sc.addPyFile(target)
    sc._tidesync_shipped = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table; only Spark's readers touch the path."""
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def land(df: DataFrame, label: str) -> DataFrame:
    """``df`` written as Parquet in the shared work folder and read back.

    Cuts the lineage: the rows survive lost executors and are never
    recomputed by later jobs or iterations.
    """
    spark = df.sparkSession
    path = fresh_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def identified(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The id as ``doc_id`` and the text (null: empty) as ``text``; every other column is dropped."""
    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def packed(docs: DataFrame, host_col: str | None = None) -> DataFrame:
    """``doc_id``, ``text`` (null: empty), optionally ``host``, and the whole row as ``row``.

    An operator that keeps other columns works on this, so that no column of
    the input can clash with one of its own.
    """
    row = F.struct(*[docs[c] for c in docs.columns]).alias("row")
    host = [docs[host_col].cast("string").alias("host")] if host_col else []
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), F.coalesce(docs["text"], F.lit("")).alias("text"), *host, row)


def unpacked(rows: DataFrame, columns: list[str], replaced: dict | None = None) -> DataFrame:
    """The rows that :func:`packed` took in, some columns replaced by expressions over ``rows``."""
    return rows.select(*[(replaced or {}).get(c, F.col("row").getField(c)).alias(c) for c in columns])
