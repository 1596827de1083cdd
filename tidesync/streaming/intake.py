"""Incremental intake: merge newly arrived files into a keyed table.

The source system lists a bounded number of new objects per step, carries a
continuation token, loads them, and moves processed files to another prefix.
The Spark form is a file stream:

* ``maxFilesPerTrigger`` bounds each step, the stream checkpoint is the token;
* ``trigger(availableNow=True)`` processes everything present, in bounded
  micro-batches, then stops (a scheduled job, not a long-running service);
* ``foreachBatch`` runs the keyed merge of each micro-batch; the query's id (kept
  in its checkpoint) and the batch id are stored with the table's commit, so a
  micro-batch replayed after a failure is skipped instead of merged twice, and
  another stream, or one whose checkpoint was reset, is never taken for a replay;
* ``cleanSource=archive`` moves processed files to ``archive_dir``. Spark
  archives the files of a batch once a later batch commits, so the files of
  the final batch stay until the next run.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidesync.plans.tables import VersionedTable, ordered_batch

LANDED_FILE, LANDED_BLOCK = "_landed_file", "_landed_block"


def query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id of the streaming query that owns ``checkpoint`` (written when the query first starts)."""
    return json.loads(spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first()[0])["id"]


def incremental_merge(
    spark: SparkSession,
    landing: str,
    schema: T.StructType,
    table: VersionedTable,
    keys: list[str],
    checkpoint: str,
    fmt: str = "parquet",
    max_files_per_trigger: int = 100,
    archive_dir: str | None = None,
    transform: Callable[[DataFrame, int], DataFrame] | None = None,
    on_duplicate: str = "error",
    order_by: list[str] | None = None,
    stream_id: str = "intake",
    on_batch: Callable[[int, object], None] | None = None,
    reader_options: dict | None = None,
):
    """Run the intake stream to completion over the files present now.

    Returns the finished ``StreamingQuery``. JSON landings are read
    ``FAILFAST`` (a malformed page stops the stream rather than vanish);
    ``reader_options`` overrides any reader option.
    """
    options = {"mode": "FAILFAST"} if fmt == "json" else {}
    options.update(reader_options or {})
    reader = spark.readStream.format(fmt).schema(schema).options(**options).option("maxFilesPerTrigger", max_files_per_trigger)
    if archive_dir:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    stream = reader.load(landing)
    if transform:  # where each row landed, for transforms that order pages by it
        stream = stream.withColumns({LANDED_FILE: F.col("_metadata.file_path"), LANDED_BLOCK: F.col("_metadata.file_block_start")})

    def merge_batch(batch: DataFrame, batch_id: int) -> None:
        key = ordered_batch(f"{stream_id}:{query_id(spark, checkpoint)}", batch_id)
        rows = transform(batch, batch_id) if transform else batch
        result = table.merge(rows, keys, on_duplicate=on_duplicate, order_by=order_by, batch_key=key)
        if on_batch:
            on_batch(batch_id, result)

    query = (
        stream.writeStream.foreachBatch(merge_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    return query


def page_records_transform(
    spec, key_field: str | None = None, snapshot_cols: tuple[str, ...] = (), on_error: str = "fail", quarantine: str | None = None
):
    """A micro-batch transform for landed pages: records -> validated,
    deduplicated (when the spec asks for it) and cast to the target types.

    Each micro-batch is treated as its own set of snapshots; name a
    ``snapshot_cols`` column (e.g. the landing file) when pages of one
    snapshot may arrive in different batches. The records of a batch are
    projected and written once, under the work folder; strict check, good rows
    and bad rows read that copy. With ``on_error="quarantine"`` the rejected
    rows and their reasons go to ``<quarantine>/batch=<id>`` (a replayed batch
    writes the same folder again).
    """
    from tidesync.operators.dedup import full_dedup
    from tidesync.operators.validate import ERRORS, ValidationError, cast_to_target, project_records
    from tidesync.session import fresh_dir
    from tidesync.sources.pages import records_from_envelopes, with_position

    if on_error not in ("fail", "quarantine"):
        raise ValueError(f"on_error must be 'fail' or 'quarantine', not {on_error!r}")
    if on_error == "quarantine" and not quarantine:
        raise ValueError("on_error='quarantine' needs the folder that keeps the rejected rows")

    def transform(batch: DataFrame, batch_id: int) -> DataFrame:
        spark = batch.sparkSession
        if LANDED_FILE in batch.columns:
            batch = with_position(batch, F.col(LANDED_FILE), F.col(LANDED_BLOCK)).drop(LANDED_FILE, LANDED_BLOCK)
        projected = project_records(records_from_envelopes(batch, key_field, snapshot_cols, keep_page=False), spec)
        path = fresh_dir(spark, "intake-batch")
        projected.write.parquet(path)
        rows = spark.read.schema(projected.schema).parquet(path)
        bad = rows.filter(F.size(ERRORS) > 0)
        if on_error == "quarantine":
            bad.write.mode("overwrite").parquet(f"{quarantine.rstrip('/')}/batch={batch_id}")
        elif sample := bad.limit(5).collect():
            raise ValidationError(spec.name, bad.count(), [r.asDict(recursive=True) for r in sample])
        good = rows.filter(F.size(ERRORS) == 0).drop(ERRORS)
        if spec.dedup_rows:
            good = full_dedup(good)
        return cast_to_target(good, spec)

    return transform
