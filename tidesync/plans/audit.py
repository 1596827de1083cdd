"""Audit and metric rows: one row per loaded table, appended, never updated.

An audit row records ``(f_number, api, inserted_at, inserted_count,
updated_count, table_name, id)``. Clock and id are parameters so a run is
reproducible; the defaults are UTC now (ISO text) and a random uuid. The row
id can instead be derived from ``(run_id, table, batch)`` so a replayed
micro-batch appends nothing twice.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidesync.session import delete_path, fresh_dir, path_exists

#: Rows of one file of an append, about.
SMALL_APPEND = 100_000

AUDIT_SCHEMA = T.StructType(
    [
        T.StructField("f_number", T.StringType(), False),
        T.StructField("api", T.StringType(), False),
        T.StructField("inserted_at", T.StringType(), False),
        T.StructField("inserted_count", T.LongType(), False),
        T.StructField("updated_count", T.LongType(), False),
        T.StructField("table_name", T.StringType(), False),
        T.StructField("id", T.StringType(), False),
    ]
)


def utc_now_iso() -> str:
    return _dt.datetime.now(_dt.timezone.utc).isoformat()


def stable_id(*parts) -> str:
    """Deterministic uuid for a (run, table, batch) triple."""
    return str(uuid.uuid5(uuid.NAMESPACE_URL, "/".join(str(p) for p in parts)))


def audit_row(f_number: str, api: str, table_name: str, inserted: int, updated: int, inserted_at: str | None = None, row_id: str | None = None) -> tuple:
    return (f_number, api, inserted_at or utc_now_iso(), int(inserted), int(updated), table_name, row_id or str(uuid.uuid4()))


def audit_frame(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(rows, AUDIT_SCHEMA)


def append_audit(spark: SparkSession, path: str, rows: list[tuple] | DataFrame, skip_existing_ids: bool = True) -> int:
    """Append audit rows at ``path``; ids already present are skipped.

    Returns the number of rows appended. The id check is an anti join on a
    single string column of the audit log. The rows are written to a folder
    of their own first and moved into the log from there by a second, plain
    write: the log is never read while it is written, and no row passes
    through the driver, however many a frame holds.
    """
    df = (rows if isinstance(rows, DataFrame) else audit_frame(spark, rows)).select(*AUDIT_SCHEMA.fieldNames())
    if skip_existing_ids and path_exists(spark, path):
        have = spark.read.schema(AUDIT_SCHEMA).parquet(path).select("id")
        df = df.join(have, "id", "left_anti").select(*AUDIT_SCHEMA.fieldNames())
    staging = fresh_dir(spark, "audit-rows")
    df.write.parquet(staging)
    fresh = spark.read.schema(AUDIT_SCHEMA).parquet(staging)
    count = fresh.count()
    if count:
        fresh.coalesce(1 if count <= SMALL_APPEND else max(1, count // SMALL_APPEND)).write.mode("append").parquet(path)
    delete_path(spark, staging)
    return count


def read_audit(spark: SparkSession, path: str) -> DataFrame:
    if not path_exists(spark, path):
        return spark.createDataFrame([], AUDIT_SCHEMA)
    return spark.read.schema(AUDIT_SCHEMA).parquet(path)


def metric_frame(spark: SparkSession, payload: dict) -> DataFrame:
    """A free-form metric dict -> one row, keys lowercased, values as text."""
    lowered = {}
    for k, v in payload.items():
        lk = str(k).lower()
        if lk in lowered:
            raise ValueError(f"metric keys collide when lowercased: {lk}")
        lowered[lk] = None if v is None else str(v)
    schema = T.StructType([T.StructField(k, T.StringType(), True) for k in lowered])
    return spark.createDataFrame([tuple(lowered.values())], schema)


def append_metrics(spark: SparkSession, path: str, payload: dict) -> None:
    """Append one metric row (compute usage, run metrics) at ``path``."""
    metric_frame(spark, payload).write.mode("append").option("mergeSchema", "true").parquet(path)


def table_counts(tables: dict[str, DataFrame], f_number: str = "", api: str = "", inserted_at: str = "", ids: bool = False) -> DataFrame:
    """Audit-shaped row count per table (inserted = count, updated = 0).

    Each count is a global aggregate with partial counts per task; the
    per-table rows are unioned, so only one row per table is ever shuffled.
    """
    frames = []
    for name, df in tables.items():
        cols = [
            F.lit(f_number).alias("f_number"),
            F.lit(api).alias("api"),
            F.lit(inserted_at).alias("inserted_at"),
            F.count(F.lit(1)).cast("long").alias("inserted_count"),
            F.lit(0).cast("long").alias("updated_count"),
            F.lit(name).alias("table_name"),
        ]
        if ids:
            cols.append(F.lit(stable_id(f_number, api, name, inserted_at)).alias("id"))
        frames.append(df.agg(*cols))
    return reduce(lambda a, b: a.unionByName(b), frames)
