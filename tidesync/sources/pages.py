"""Landed page envelopes -> records.

A snapshot arrives as pages ``{Succeed, IsLastPage, Response: [record]}``, one
JSON object per line, optionally with their number (``Page``). The rules kept
from the source system:

* only pages with ``Succeed`` true contribute records; a failed page is skipped
  (not retried) and later pages still count;
* the snapshot ends at the first successful page flagged ``IsLastPage``; pages
  after it are ignored;
* detail snapshots (one per request key, e.g. per receipt) also end at a
  successful page whose ``Response`` is null, and every record is tagged with
  the key that fetched it, overwriting any such field in the record.

Page order is the page number where pages carry one. Pages without a number
are ordered by the file they landed in (its name, numbers in it by value), then
by their line; :func:`read_envelopes` adds that position. A page with neither
can't be placed, and a snapshot that mixes numbered and unnumbered pages can't
be ordered: both fail the run.

Plan shape: for one snapshot the end page is a scalar subquery. For many, it
is a per-snapshot ``min`` (partial aggregation, one row per snapshot) joined
back on the snapshot key. AQE measures that side at
run time and broadcasts it only when it is small; otherwise a sort-merge join
on the key runs, whose skewed partitions AQE splits. No window over a whole
snapshot is used, so one huge snapshot never lands in a single task. The flags
are a second, narrow read of the pages: land pages as Parquet first
(:func:`land_pages`), so that it reads the flag columns alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidesync.session import fresh_dir
from tidesync.spec import TableSpec, envelope_schema

PAGE = "Page"
POSITION = "_position"
NO_RESPONSE = "_no_response"
REQUEST_KEY = "_request_key"
_POSITION_TYPE = "struct<file:string,block:bigint,line:bigint>"


def file_order(path: Column) -> Column:
    """A path that sorts as its last number does (``page-2`` before ``page-10``)."""
    part = lambda n: F.regexp_extract(path, r"^(.*?)([0-9]*)([^0-9]*)$", n)
    return F.concat(part(1), F.lpad(part(2), 24, "0"), part(3))


def with_position(pages: DataFrame, path: Column, block: Column) -> DataFrame:
    """``pages`` with where each landed: file, block and line within the task that reads it."""
    # The number grows along a file's lines within one task; only its order is used.
    line = F.monotonically_increasing_id()
    return pages.withColumn(POSITION, F.struct(file_order(path).alias("file"), block.cast("long").alias("block"), line.alias("line")))


def page_order(env: DataFrame) -> Column:
    """What pages are ordered by: the page number, else where they landed; fails for a page without either."""
    numbered = F.struct(F.col(PAGE).cast("long").alias("page"), F.lit(None).cast(_POSITION_TYPE).alias("position"))
    if POSITION not in env.columns:
        unplaced = F.raise_error(F.lit("a page has neither a number nor a landing position")).cast("long")
        return F.struct(F.coalesce(F.col(PAGE).cast("long"), unplaced).alias("page"), F.lit(None).cast(_POSITION_TYPE).alias("position"))
    return F.when(F.col(PAGE).isNotNull(), numbered).otherwise(F.struct(F.lit(None).cast("long").alias("page"), F.col(POSITION).alias("position")))


def _end_of(env: DataFrame, closes: Column) -> Column:
    """Aggregate: the order of the first closing page (null if none); fails where orders are mixed."""
    end = F.min(F.when(closes, page_order(env)))
    mixed = F.raise_error(F.lit("a snapshot mixes numbered and unnumbered pages")).cast(f"struct<page:bigint,position:{_POSITION_TYPE}>")
    return F.when(F.count(PAGE).isin(0) | (F.count(PAGE) == F.count(F.lit(1))), end).otherwise(mixed)


def read_envelopes(
    spark: SparkSession,
    path: str | list[str],
    spec: TableSpec,
    key_field: str | None = None,
    values: str = "variant",
    mode: str = "FAILFAST",
) -> DataFrame:
    """Read landed pages with the declared envelope schema (no inference).

    ``values`` selects how record values land: ``variant`` (default, keeps
    the JSON type of each value for the lax type rules) or ``text``.
    ``mode='FAILFAST'`` (default) fails the read on a malformed page instead
    of silently turning it into an empty one; ``PERMISSIVE`` tolerates it.
    """
    reader = spark.read.schema(envelope_schema(spec, key_field, values)).option("mode", mode)
    return with_position(reader.json(path), F.col("_metadata.file_path"), F.col("_metadata.file_block_start"))


def land_pages(env: DataFrame, folder: str | None = None) -> DataFrame:
    """``env`` written as Parquet (under ``folder``, or the shared work folder) and read back.

    Pages are parsed or built once; the flags that end a snapshot are then
    read from their own columns, without the records."""
    path = folder or fresh_dir(env.sparkSession, "pages")
    env = env.withColumn(NO_RESPONSE, F.col("Response").isNull())
    env.write.parquet(path)
    return env.sparkSession.read.schema(env.schema).parquet(path)


def page_closes(env: DataFrame, key_field: str | None) -> Column:
    """Whether a page ends its snapshot."""
    ends = F.coalesce(F.col("IsLastPage"), F.lit(False))
    if key_field:
        ends = ends | (F.col(NO_RESPONSE) if NO_RESPONSE in env.columns else F.col("Response").isNull())
    return F.coalesce(F.col("Succeed"), F.lit(False)) & ends


def _scoped(env: DataFrame, closes: Column, group: list[str]) -> DataFrame:
    """Every row, with whether its page is at or before its snapshot's end (``_in_scope``)."""
    if not group:
        # One snapshot: its end page is one value, a scalar subquery (a
        # partial min per task, one row shuffled); no join, no driver action.
        # One reference to it, so it is planned and run once; without an end every page counts.
        end = env.select(_end_of(env, closes)).scalar()
        return env.withColumn("_in_scope", F.coalesce(page_order(env) <= end, F.lit(True)))
    ends = env.groupBy(*group).agg(_end_of(env, closes).alias("_end_page"))
    marked = env.join(ends, on=group, how="left")
    return marked.withColumn("_in_scope", F.col("_end_page").isNull() | (page_order(env) <= F.col("_end_page"))).drop("_end_page")


def within_end(env: DataFrame, closes: Column, group: list[str]) -> DataFrame:
    """Rows whose page is at or before the first page of its snapshot that ``closes``."""
    return _scoped(env, closes, group).where("_in_scope").drop("_in_scope")


def usable_pages(env: DataFrame, key_field: str | None = None, snapshot_cols: tuple[str, ...] = ()) -> DataFrame:
    """Pages that contribute records: successful and not after the end page."""
    group = ([key_field] if key_field else []) + list(snapshot_cols)
    return within_end(env, page_closes(env, key_field), group).filter(F.col("Succeed") == F.lit(True))


def records_from_envelopes(
    env: DataFrame,
    key_field: str | None = None,
    snapshot_cols: tuple[str, ...] = (),
    keep_page: bool = True,
) -> DataFrame:
    """Explode usable pages into one row per record (source-named columns).

    A null ``Response`` yields no rows. With ``key_field`` the record's own
    value of that field is replaced by the request key of its page.
    """
    pages = usable_pages(env, key_field, snapshot_cols)
    lead = [F.col(c) for c in snapshot_cols]
    if keep_page:
        lead.append(F.col(PAGE))
    if key_field:
        lead.append(F.col(key_field).alias(REQUEST_KEY))
    rows = pages.select(*lead, F.inline("Response"))
    if key_field:
        rows = rows.withColumn(key_field, F.col(REQUEST_KEY)).drop(REQUEST_KEY)
    return rows


def read_pages(
    spark: SparkSession,
    path: str | list[str],
    spec: TableSpec,
    key_field: str | None = None,
    snapshot_cols: tuple[str, ...] = (),
    values: str = "variant",
) -> DataFrame:
    """Landed snapshot pages at ``path`` -> raw records of ``spec``; the JSON is parsed once."""
    env = land_pages(read_envelopes(spark, path, spec, key_field, values))
    return records_from_envelopes(env, key_field, snapshot_cols)


def page_status(env: DataFrame, key_field: str | None = None, snapshot_cols: tuple[str, ...] = ()) -> DataFrame:
    """One row per landed page: its flags, record count and whether it was used."""
    group = ([key_field] if key_field else []) + list(snapshot_cols)
    records = F.greatest(F.coalesce(F.size("Response"), F.lit(0)), F.lit(0)).alias("records")
    succeed = F.coalesce(F.col("Succeed"), F.lit(False))
    return _scoped(env, page_closes(env, key_field), group).select(*group, PAGE, "Succeed", "IsLastPage", records, (succeed & F.col("_in_scope")).alias("used"))


class FailedPagesError(Exception):
    """Strict page mode: a page before the end of its snapshot did not succeed."""


def check_pages(env: DataFrame, key_field: str | None = None, snapshot_cols: tuple[str, ...] = ()) -> DataFrame:
    """Strict mode for failed pages: raise if any page that would have been
    read (at or before its snapshot's end page) did not succeed.

    Returns ``env`` unchanged when every such page succeeded. The check is
    one aggregate over the page flags; a bounded sample is reported.
    """
    group = ([key_field] if key_field else []) + list(snapshot_cols)
    where = [POSITION] if POSITION in env.columns else []
    failed = _scoped(env, page_closes(env, key_field), group).filter(F.col("_in_scope") & ~F.coalesce(F.col("Succeed"), F.lit(False)))
    sample = failed.select(*group, PAGE, *where).limit(5).collect()
    if sample:
        raise FailedPagesError(f"failed pages: {[r.asDict(recursive=True) for r in sample]}")
    return env
