"""Date slices, yesterday window, audit rows and metrics."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidesync.functions.dates import (
    backfill_slices,
    in_yesterday,
    rows_per_slice,
    slices_by_year,
    yesterday_range,
)
from tidesync.plans.audit import append_audit, append_metrics, audit_row, read_audit, stable_id, table_counts


def test_backfill_from_start_of_year(spark):
    rows = backfill_slices(spark, "2022-01-01", as_of="2024-03-10").orderBy("slice_start").collect()
    assert rows[0].slice_start == dt.datetime(2022, 1, 1)
    assert rows[0].slice_end == dt.datetime(2022, 1, 31, 23, 59, 59, 999999)
    assert rows[-1].slice_start == dt.datetime(2024, 3, 1)
    assert rows[-1].slice_end == dt.datetime(2024, 3, 9, 23, 59, 59, 999999)
    assert sorted({r.year for r in rows}) == [2022, 2023, 2024]
    assert len(rows) == 27


def test_backfill_first_slice_starts_on_start_day(spark):
    rows = backfill_slices(spark, "2024-01-15", as_of="2024-03-01").orderBy("slice_start").collect()
    assert [(r.slice_start.date(), r.slice_end.date()) for r in rows] == [
        (dt.date(2024, 1, 15), dt.date(2024, 1, 31)),
        (dt.date(2024, 2, 1), dt.date(2024, 2, 29)),
    ]
    grouped = {r.year: len(r.slices) for r in slices_by_year(backfill_slices(spark, "2024-01-15", "2024-03-01")).collect()}
    assert grouped == {2024: 2}


def test_backfill_empty_and_invalid(spark):
    assert backfill_slices(spark, "2024-05-01", as_of="2024-05-01").count() == 0
    with pytest.raises(ValueError):
        backfill_slices(spark, "not a date", as_of="2024-05-01")


def test_rows_per_slice_and_yesterday(spark):
    df = spark.sql(
        "SELECT * FROM VALUES (TIMESTAMP_NTZ'2024-01-15 00:00:00'), (TIMESTAMP_NTZ'2024-01-15 23:59:59'),"
        " (TIMESTAMP_NTZ'2024-01-15 23:59:59.5'), (TIMESTAMP_NTZ'2024-02-02 08:00:00'),"
        " (TIMESTAMP_NTZ'2023-01-01 00:00:00') AS t(ts)"
    )
    counts = {r.slice_start.date(): r.rows for r in rows_per_slice(df, "ts", "2024-01-10", "2024-03-05").collect()}
    assert counts == {dt.date(2024, 1, 10): 3, dt.date(2024, 2, 1): 1, dt.date(2024, 3, 1): 0}
    assert df.filter(in_yesterday(F.col("ts"), "2024-01-16")).count() == 2
    assert df.filter(in_yesterday(F.col("ts"), "2024-01-16", half_open=True)).count() == 3
    assert yesterday_range("2024-01-16") == (dt.datetime(2024, 1, 15), dt.datetime(2024, 1, 15, 23, 59, 59))


def test_audit_append_is_idempotent_by_id(spark, tmp_dir):
    path = f"{tmp_dir}/audit"
    rid = stable_id("run1", "materials_query")
    row = audit_row("F1", "api", "materials_query", 3, 0, "2024-01-01T00:00:00+00:00", rid)
    assert append_audit(spark, path, [row]) == 1
    assert append_audit(spark, path, [row]) == 0
    got = read_audit(spark, path).collect()
    assert len(got) == 1 and got[0].inserted_count == 3 and got[0].id == rid
    # default clock and id are filled in
    auto = audit_row("F1", "api", "t", 1, 2)
    assert auto[2].endswith("+00:00") and len(auto[6]) == 36


def test_metrics_are_lowercased(spark, tmp_dir):
    append_metrics(spark, f"{tmp_dir}/m", {"RunTime": 1.5, "Flow": "x"})
    row = spark.read.parquet(f"{tmp_dir}/m").first().asDict()
    assert row == {"runtime": "1.5", "flow": "x"}


def test_table_counts(spark):
    a = spark.range(3)
    b = spark.range(0)
    rows = {r.table_name: (r.inserted_count, r.updated_count) for r in table_counts({"a": a, "b": b}, "F1", "api").collect()}
    assert rows == {"a": (3, 0), "b": (0, 0)}
