"""Date slices for backfills and daily loads.

``backfill_slices`` gives the month slices from a start day to the end of the
day before ``as_of``: the first slice starts on the start day, later ones on
the 1st; each ends at 23:59:59.999999 of its last day; the last one ends at the
end of yesterday. ``yesterday_range`` gives the day before ``as_of`` from
00:00:00 to 23:59:59 (inclusive, whole seconds, as the daily load asks for).

Assigning rows to slices needs no range join: a row's slice follows from its
own timestamp (``slice_bounds``), so it is a plain projection, and counting
per slice is a partial aggregate on the slice start. The slice list itself is
generated by ``sequence`` from one row and is bounded by the number of months
in the range.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_END_OF_DAY = "INTERVAL '23:59:59.999999' HOUR TO SECOND"


def _day(value) -> _dt.date:
    if isinstance(value, _dt.datetime):
        return value.date()
    if isinstance(value, _dt.date):
        return value
    try:
        return _dt.datetime.fromisoformat(str(value)).date()
    except ValueError as e:
        raise ValueError(f"start date invalid: {value!r}") from e


def yesterday_of(as_of=None) -> _dt.date:
    base = _day(as_of) if as_of is not None else _dt.date.today()
    return base - _dt.timedelta(days=1)


def backfill_slices(spark: SparkSession, start, as_of=None) -> DataFrame:
    """``(year, slice_start, slice_end)`` rows, one per month, in order.

    Empty when the start day is after yesterday.
    """
    start_day = _day(start)
    last_day = yesterday_of(as_of)
    q = f"""
    SELECT year(m) AS year,
           CAST(greatest(m, DATE'{start_day.isoformat()}') AS TIMESTAMP_NTZ) AS slice_start,
           least(CAST(last_day(m) AS TIMESTAMP_NTZ), CAST(DATE'{last_day.isoformat()}' AS TIMESTAMP_NTZ))
             + {_END_OF_DAY} AS slice_end
    FROM (SELECT explode(sequence(trunc(DATE'{start_day.isoformat()}', 'MM'),
                                  greatest(trunc(DATE'{start_day.isoformat()}', 'MM'),
                                           trunc(DATE'{last_day.isoformat()}', 'MM')),
                                  INTERVAL 1 MONTH)) AS m)
    WHERE DATE'{start_day.isoformat()}' <= DATE'{last_day.isoformat()}'
    """
    return spark.sql(q)


def slices_by_year(slices: DataFrame) -> DataFrame:
    """Slices grouped by year, in order: ``(year, slices ARRAY<STRUCT<start, end>>)``.

    A year holds at most twelve slices, so the collected list is bounded.
    """
    return slices.groupBy("year").agg(
        F.array_sort(F.collect_list(F.struct(F.col("slice_start").alias("start"), F.col("slice_end").alias("end")))).alias("slices")
    )


def slice_bounds(ts: Column, start, as_of=None) -> tuple[Column, Column]:
    """The (start, end) of the backfill slice holding ``ts`` (null outside)."""
    start_day = _day(start)
    last_day = yesterday_of(as_of)
    lo = F.lit(start_day).cast("timestamp_ntz")
    hi = F.lit(last_day).cast("timestamp_ntz") + F.expr(_END_OF_DAY)
    inside = (ts >= lo) & (ts <= hi)
    month = F.date_trunc("month", ts).cast("timestamp_ntz")
    s = F.greatest(month, lo)
    e = F.least(F.add_months(month, 1).cast("timestamp_ntz") - F.expr("INTERVAL '0.000001' SECOND"), hi)
    return F.when(inside, s), F.when(inside, e)


def rows_per_slice(df: DataFrame, ts_col: str, start, as_of=None) -> DataFrame:
    """Every backfill slice with the number of rows of ``df`` inside it
    (zero for empty slices)."""
    s, e = slice_bounds(F.col(ts_col), start, as_of)
    counts = (
        df.select(s.alias("slice_start"))
        .filter(F.col("slice_start").isNotNull())
        .groupBy("slice_start")
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    slices = backfill_slices(df.sparkSession, start, as_of)
    # Both sides hold one row per month of the range: a bounded, tiny join.
    return (
        slices.join(counts, "slice_start", "left")
        .select("year", "slice_start", "slice_end", F.coalesce(F.col("rows"), F.lit(0)).cast("long").alias("rows"))
    )


def yesterday_range(as_of=None) -> tuple[_dt.datetime, _dt.datetime]:
    """00:00:00 and 23:59:59 of the day before ``as_of`` (default: today)."""
    d = yesterday_of(as_of)
    return (
        _dt.datetime(d.year, d.month, d.day, 0, 0, 0),
        _dt.datetime(d.year, d.month, d.day, 23, 59, 59),
    )


def in_yesterday(ts: Column, as_of=None, half_open: bool = False) -> Column:
    """Predicate for rows of yesterday. Default: ``BETWEEN 00:00:00 AND
    23:59:59``; ``half_open`` uses ``>= day AND < day + 1`` instead, which
    also keeps the fractional last second."""
    lo, hi = yesterday_range(as_of)
    lo_c = _ts_literal(lo)
    if half_open:
        return (ts >= lo_c) & (ts < _ts_literal(lo + _dt.timedelta(days=1)))
    return ts.between(lo_c, _ts_literal(hi))


def _ts_literal(v: _dt.datetime) -> Column:
    """A TIMESTAMP_NTZ literal (no session time zone involved)."""
    return F.expr(f"TIMESTAMP_NTZ'{v.isoformat(sep=' ')}'")
