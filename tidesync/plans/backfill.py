"""Backfills that read only the days they load, from a ``year=/month=/day=`` layout.

The slices to load (months, or single days) are a frame; which of them are done
already is another, the log of earlier loads. What is left is joined to the
partition columns of the layout, so Spark prunes partitions at run time
(dynamic partition pruning): the days' values, known only once the slices have
been compared with the log, become a filter on the scan's folders, and files of
other days are never opened. The days of a backfill are few (366 a year), so
the join's side is bounded by the range and is broadcast at any table size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_LAST_MOMENT = "INTERVAL '23:59:59.999999' HOUR TO SECOND"


def day_slices(slices: DataFrame) -> DataFrame:
    """Slices cut into days: ``(year, slice_start, slice_end)``, the first and last cut as their slice was."""
    days = slices.select("slice_start", "slice_end", F.explode(F.sequence(F.to_date("slice_start"), F.to_date("slice_end"))).alias("_day"))
    start = F.greatest("slice_start", F.col("_day").cast("timestamp_ntz"))
    end = F.least("slice_end", F.col("_day").cast("timestamp_ntz") + F.expr(_LAST_MOMENT))
    return days.select(F.year("_day").alias("year"), start.alias("slice_start"), end.alias("slice_end"))


def pending_slices(slices: DataFrame, done: DataFrame) -> DataFrame:
    """The days of ``slices`` that no slice of ``done`` (slice_start, slice_end) covers as far as they reach."""
    days, log = day_slices(slices), day_slices(done)
    log = log.select(F.to_date("slice_start").alias("_day"), F.col("slice_start").alias("_from"), F.col("slice_end").alias("_to"))
    covered = (F.to_date(days["slice_start"]) == log["_day"]) & (days["slice_start"] >= log["_from"]) & (days["slice_end"] <= log["_to"])
    return days.join(log, covered, "left_anti")


def read_slices(spark: SparkSession, path: str, slices: DataFrame, ts_col: str) -> DataFrame:
    """Rows of the layout at ``path`` inside ``slices``, each with its ``slice_start``; other days' files are not read.

    A row inside several slices comes once for each of them. Rows without a
    time are in no slice.
    """
    days = slices.select("slice_start", "slice_end", F.explode(F.sequence(F.to_date("slice_start"), F.to_date("slice_end"))).alias("_day"))
    # A comparison on the days' side: Spark prunes by a side only if that side was filtered. A slice that ends before it starts holds no row.
    days = days.select("slice_start", "slice_end", F.year("_day").alias("_year"), F.month("_day").alias("_month"), F.dayofmonth("_day").alias("_dom")).where("slice_start <= slice_end")
    rows = spark.read.parquet(path)
    same_day = (rows["year"] == days["_year"]) & (rows["month"] == days["_month"]) & (rows["day"] == days["_dom"])
    inside = rows[ts_col].between(days["slice_start"], days["slice_end"])
    return rows.join(F.broadcast(days), same_day & inside).drop("_year", "_month", "_dom", "slice_end")
