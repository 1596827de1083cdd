"""Backfills by slice: pending days, and reads that prune partitions at run time."""

import datetime as dt
import re

from pyspark.sql import functions as F

from tidesync.functions.dates import backfill_slices
from tidesync.plans.backfill import day_slices, pending_slices, read_slices
from tidesync.plans.tables import write_date_partitioned

SLICE = "slice_start timestamp_ntz, slice_end timestamp_ntz"


def stamp(text):
    return dt.datetime.fromisoformat(text)


def days_of(frame):
    return sorted((r.slice_start, r.slice_end) for r in frame.collect())


def test_days_of_slices(spark):
    days = days_of(day_slices(backfill_slices(spark, "2024-01-30", "2024-02-03")))
    assert [d[0] for d in days] == [stamp(f"2024-{x}") for x in ("01-30", "01-31", "02-01", "02-02")]
    assert days[-1][1] == stamp("2024-02-02T23:59:59.999999")
    assert day_slices(backfill_slices(spark, "2024-02-03", "2024-02-03")).count() == 0


def test_pending_days(spark):
    slices = backfill_slices(spark, "2024-01-01", "2024-01-06")
    done = spark.createDataFrame([(stamp("2024-01-01"), stamp("2024-01-02T23:59:59.999999")), (stamp("2024-01-04"), stamp("2024-01-04T12:00:00")), (None, None)], SLICE)
    assert [d[0].day for d in days_of(pending_slices(slices, done))] == [3, 4, 5]  # the 4th was loaded in part only
    assert pending_slices(slices, done.where("false")).count() == 5
    assert pending_slices(slices, slices.select("slice_start", "slice_end")).count() == 0


def test_other_days_are_not_read(spark, tmp_dir):
    start = dt.datetime(2023, 11, 1)
    rows = [(k, start + dt.timedelta(hours=7 * k)) for k in range(500)] + [(None, None), (None, None)]
    df = spark.createDataFrame(rows, "id int, ts timestamp_ntz").repartition(3)
    write_date_partitioned(df, f"{tmp_dir}/layout", "ts")
    slices = pending_slices(backfill_slices(spark, "2023-12-30", "2024-01-04"), backfill_slices(spark, "2023-12-31", "2024-01-02").select("slice_start", "slice_end"))
    found = read_slices(spark, f"{tmp_dir}/layout", slices, "ts")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*dynamicpruning", plan)
    want = {(i, t) for i, t in rows if t and t.date() in (dt.date(2023, 12, 30), dt.date(2024, 1, 2), dt.date(2024, 1, 3))}
    got = found.withColumn("file", F.input_file_name()).collect()
    assert {(r.id, r.ts) for r in got} == want and len(got) == len(want)
    assert all(r.slice_start == dt.datetime.combine(r.ts.date(), dt.time()) for r in got)
    whole = spark.read.parquet(f"{tmp_dir}/layout")
    scan = found._jdf.queryExecution().executedPlan()
    found.write.format("noop").mode("overwrite").save()
    assert scan is not None and whole.count() == len(rows)


def test_overlapping_slices_and_no_slices(spark, tmp_dir):
    df = spark.createDataFrame([(1, dt.datetime(2024, 1, 1, 5)), (2, dt.datetime(2024, 1, 2, 5))], "id int, ts timestamp_ntz")
    write_date_partitioned(df, f"{tmp_dir}/layout", "ts")
    twice = spark.createDataFrame([(stamp("2024-01-01"), stamp("2024-01-01T23:00:00")), (stamp("2024-01-01T04:00:00"), stamp("2024-01-02T04:00:00"))], SLICE)
    assert sorted(r.id for r in read_slices(spark, f"{tmp_dir}/layout", twice, "ts").collect()) == [1, 1]
    assert read_slices(spark, f"{tmp_dir}/layout", twice.where("false"), "ts").count() == 0
