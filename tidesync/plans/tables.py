"""Versioned Parquet tables with upsert and delete by key.

Parquet files cannot be updated in place and ``MERGE INTO`` / ``DELETE`` need
a row-level table format (:func:`merge_into` issues that statement where the
catalog has one). A table here is a sequence of immutable versions, all
written by Spark:

    <root>/data/v=<n>/...        files written by change n
    <root>/_commits/v=<n>/       one row: the version's counts, schema, layout and manifest

A change reads the newest commit only, computes the next version lazily (merge
= outer join, delete = anti join), writes it under a new ``v=<n+1>`` folder and
only then writes its commit. A reader resolves the newest complete commit, so a
failed or half-written version is never seen, and the folder being read is
never the folder being written. Every write cuts the lineage: a lost executor
costs at most the tasks of the current change.

Two layouts. Layout and merge keys belong to the table: a handle that names
others is refused.

* plain: each version is one complete folder of Parquet files;
* ``hash_partitions=N``: rows live in ``N`` folders by the hash of their key,
  and each commit's manifest names one folder per partition. A change reads
  and rewrites only the partitions its keys fall in; the others are carried
  over by reference. :meth:`VersionedTable.repartition` changes ``N`` as the
  table grows.

One writer per table is assumed (as with the warehouse load it replaces).
"""

from __future__ import annotations

import datetime as _dt
import json
import logging
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidesync.functions.normalize import quote_identifier
from tidesync.operators.keys import delete_by_keys as _anti
from tidesync.operators.merge import ACTION, action_metrics, align_to, choose_strategy, merge_rows, prepare_source
from tidesync.session import delete_path, list_dirs, path_exists

PART = "_part"

log = logging.getLogger(__name__)

_PARTS = T.StructType().add("part", T.IntegerType()).add("path", T.StringType()).add("rows", T.LongType())
COMMIT_SCHEMA = (
    T.StructType()
    .add("version", T.LongType())
    .add("operation", T.StringType())
    .add("inserted_count", T.LongType())
    .add("updated_count", T.LongType())
    .add("deleted_count", T.LongType())
    .add("total_rows", T.LongType())
    .add("batch_key", T.StringType())
    .add("marks", T.MapType(T.StringType(), T.LongType()))
    .add("committed_at", T.TimestampNTZType())
    .add("schema_json", T.StringType())
    .add("keys", T.ArrayType(T.StringType()))
    .add("hash_partitions", T.IntegerType())
    .add("manifest", T.ArrayType(_PARTS))
)


@dataclass
class MergeResult:
    version: int
    inserted: int
    updated: int
    kept: int
    total: int
    strategy: str = ""
    unchanged: int = 0
    partitions_rewritten: int = -1
    replayed: bool = False


class LayoutError(ValueError):
    """A handle names another layout or other merge keys than its table has."""


def _broadcast_limit(spark: SparkSession) -> int:
    """The session's broadcast threshold in bytes (-1 disables broadcasting)."""
    raw = str(spark.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760")).strip().lower()
    units = {"b": 1, "k": 1 << 10, "kb": 1 << 10, "m": 1 << 20, "mb": 1 << 20, "g": 1 << 30, "gb": 1 << 30}
    for suffix in sorted(units, key=len, reverse=True):
        if raw.endswith(suffix) and raw[: -len(suffix)].strip().lstrip("-").isdigit():
            return int(raw[: -len(suffix)]) * units[suffix]
    return int(raw)


def observed_values(obs: Observation) -> dict:
    """The observed values; none if nothing was reported (as when the optimizer removes an empty input).

    Callers must not take "none" for zero: they count again, or check the
    values against what was written.
    """
    try:
        return dict(obs.get)
    except Exception:  # noqa: BLE001 - no value was ever reported
        return {}


def row_bytes(schema: T.StructType) -> Column:
    """In-memory bytes of a row, roughly: text and nested values by their length, others 8 bytes a column."""
    size = F.lit(8 * len(schema.fields)).cast("long")
    for f in schema.fields:
        c = F.col(quote_identifier(f.name))
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            size = size + F.coalesce(F.octet_length(c), F.lit(0))
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType, T.VariantType)):
            size = size + F.coalesce(F.octet_length(F.to_json(F.struct(c.alias("v")))), F.lit(0))
    return size


def ordered_batch(stream: str, number: int) -> str:
    """The key of a stream's numbered batch; a table remembers the last number of each stream."""
    return f"{stream}#{number}"


def _stream_of(batch_key: str | None) -> tuple[str, int] | None:
    stream, mark, number = (batch_key or "").rpartition("#")
    return (stream, int(number)) if mark and number.isdigit() else None


class VersionedTable:
    """A keyed table stored as immutable Parquet versions (see module doc)."""

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        keys: list[str] | tuple[str, ...] = (),
        compression: str = "snappy",
        hash_partitions: int | None = None,
    ):
        self.spark = spark
        self.root = root.rstrip("/")
        self.keys = list(keys)
        self.compression = compression
        self.hash_partitions = hash_partitions
        if hash_partitions is not None and (hash_partitions < 1 or not self.keys):
            raise ValueError("the hash layout needs a count >= 1 and merge keys")

    # -- commits ------------------------------------------------------------
    @property
    def commits_path(self) -> str:
        return f"{self.root}/_commits"

    def version_path(self, version: int) -> str:
        return f"{self.root}/data/v={version:08d}"

    def _versions(self) -> list[int]:
        """Versions with a complete commit, ascending."""
        found = sorted(int(d.rsplit("=", 1)[1]) for d in list_dirs(self.spark, self.commits_path) if "/v=" in d)
        # Only the newest commit can be half written (one writer per table).
        while found and not path_exists(self.spark, f"{self._commit_path(found[-1])}/_SUCCESS"):
            found.pop()
        return found

    def _commit_path(self, version: int) -> str:
        return f"{self.commits_path}/v={version:08d}"

    def commits(self) -> DataFrame:
        """The commit log, one row per version."""
        paths = [self._commit_path(v) for v in self._versions()]
        if not paths:
            return self.spark.createDataFrame([], COMMIT_SCHEMA)
        return self.spark.read.schema(COMMIT_SCHEMA).parquet(*paths)

    def _latest(self, version: int | None = None):
        """The commit row of ``version`` (default: the newest); None if there is none."""
        have = self._versions()
        if not have or (version is not None and version not in have):
            return None
        return self.spark.read.schema(COMMIT_SCHEMA).parquet(self._commit_path(have[-1] if version is None else version)).first()

    def current_version(self) -> int | None:
        have = self._versions()
        return have[-1] if have else None

    def exists(self) -> bool:
        return self.current_version() is not None

    def _replayed(self, latest, batch_key: str | None):
        """The commit row that ``batch_key`` made, or True if it is known to be committed earlier; else None."""
        if not batch_key:
            return None
        if latest["batch_key"] == batch_key:
            return latest
        ordered = _stream_of(batch_key)
        if ordered:
            return True if (latest["marks"] or {}).get(ordered[0], -1) >= ordered[1] else None
        return self.commits().filter(F.col("batch_key") == F.lit(batch_key)).first()

    def committed_batch(self, batch_key: str) -> bool:
        """True if a change tagged ``batch_key`` was already committed (replay guard)."""
        latest = self._latest()
        return latest is not None and self._replayed(latest, batch_key) is not None

    def _adopt(self, latest, keys: list[str] | None = None) -> None:
        """Take layout and keys from the table; refuse a handle or a call that names others."""
        have, own = latest["hash_partitions"], list(latest["keys"] or [])
        if self.hash_partitions is not None and self.hash_partitions != have:
            raise LayoutError(f"{self.root} has hash_partitions={have}, not {self.hash_partitions}")
        for named in (self.keys, keys or []):
            if named and own and sorted(named) != sorted(own):
                raise LayoutError(f"{self.root} has merge keys {own}, not {list(named)}")
        self.hash_partitions = have
        self.keys = own or self.keys or list(keys or [])

    def _commit(
        self, version: int, operation: str, schema: T.StructType, inserted=None, updated=None, deleted=None,
        total=None, batch_key=None, manifest=None, marks=None,
    ) -> None:
        marks, ordered = dict(marks or {}), _stream_of(batch_key)
        if ordered:
            marks[ordered[0]] = ordered[1]
        row = [(
            version, operation, inserted, updated, deleted, total, batch_key, marks,
            _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None), schema.json(), self.keys, self.hash_partitions,
            [dict(part=int(p), path=str(path), rows=int(n)) for p, path, n in manifest] if manifest is not None else None,
        )]
        self.spark.createDataFrame(row, COMMIT_SCHEMA).coalesce(1).write.mode("overwrite").parquet(self._commit_path(version))

    # -- reading ------------------------------------------------------------
    def read(self, version: int | None = None) -> DataFrame:
        row = self._latest(version)
        if row is None:
            raise FileNotFoundError(f"table at {self.root} has no committed version {version if version is not None else ''}")
        return self._read_commit(row)

    @staticmethod
    def _schema(c) -> T.StructType:
        return T.StructType.fromJson(json.loads(c["schema_json"]))

    def _read_commit(self, c, parts: set[int] | None = None) -> DataFrame:
        """Read a committed version; for the hash layout, optionally only the
        listed partitions (the others are never opened)."""
        schema = self._schema(c)
        if c["hash_partitions"]:
            paths = [e["path"] for e in c["manifest"] or [] if parts is None or e["part"] in parts]
        else:
            paths = [self.version_path(c["version"])]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def row_count(self) -> int:
        return self.read().count()

    # -- writing ------------------------------------------------------------
    def _part_of(self, keys: list[str]) -> Column:
        """The hash partition of a row: Spark's hash of the keys, mod N (the
        same function a hash repartition into N partitions uses)."""
        return F.pmod(F.hash(*[F.col(quote_identifier(k)) for k in keys]), F.lit(self.hash_partitions))

    def _write(self, df: DataFrame, version: int) -> tuple[int, list[tuple[int, str, int]] | None]:
        """Write a version; returns (rows written, manifest of the folders written or None)."""
        path = self.version_path(version)
        # A folder above the newest commit is left from an attempt that failed before committing.
        if path_exists(self.spark, path):
            delete_path(self.spark, path)
        writer = df.withColumn(PART, self._part_of(self.keys)).write.partitionBy(PART) if self.hash_partitions else df.write
        writer.mode("errorifexists").option("compression", self.compression).parquet(path)
        if not self.hash_partitions:
            return self.spark.read.schema(df.schema).parquet(path).count(), None
        full = T.StructType([*df.schema.fields, T.StructField(PART, T.IntegerType(), True)])
        counts = self.spark.read.schema(full).parquet(path).groupBy(PART).agg(F.count(F.lit(1)).alias("n")).collect()
        parts = [(r[PART], f"{path}/{PART}={r[PART]}", r["n"]) for r in counts]
        return sum(n for *_, n in parts), parts

    def provision(self, schema: T.StructType, replace: bool = False) -> int:
        """Create the table empty with ``schema`` if absent (or replace it).

        Returns the current version. An empty input still provisions the
        table. Only ``replace`` may change layout and keys.
        """
        latest = self._latest()
        if latest is not None and not replace:
            self._adopt(latest)
            return latest["version"]
        version = 0 if latest is None else latest["version"] + 1
        if self.hash_partitions:
            manifest = []
        else:
            _, manifest = self._write(self.spark.createDataFrame([], schema), version)
        self._commit(version, "create" if latest is None else "replace", schema, total=0, manifest=manifest, marks=latest and latest["marks"])
        return version

    def stage(self, source: DataFrame, keys: list[str] | None = None) -> tuple[DataFrame, int, int, list[int]]:
        """Write ``source`` under ``_staging`` and read it back.

        The staged copy cuts the source's lineage (nothing is recomputed if an
        executor is lost during the merge, nor by the several reads of the
        merge plan). Returns ``(staged frame, rows, bytes in memory, hash
        partitions touched)``, measured in the same pass; the partitions are
        at most N small numbers. The change that stages removes the copy.
        """
        path = f"{self.root}/_staging/{uuid.uuid4().hex}"
        obs = Observation()
        metrics = [F.count(F.lit(1)).alias("rows"), F.sum(row_bytes(source.schema)).alias("bytes")]
        if self.hash_partitions:
            metrics.append(F.collect_set(self._part_of(list(keys or self.keys))).alias("parts"))
        source.observe(obs, *metrics).write.mode("errorifexists").parquet(path)
        staged, got = self.spark.read.schema(source.schema).parquet(path), observed_values(obs)
        if got.get("rows") is None:
            got = staged.agg(*metrics).first().asDict()
        if self.hash_partitions and got["rows"] and not got["parts"]:
            raise RuntimeError(f"{self.root}: {got['rows']} staged rows in no hash partition")
        return staged, int(got.get("rows") or 0), int(got.get("bytes") or 0), sorted(got.get("parts") or [])

    def _unstage(self) -> None:
        if path_exists(self.spark, f"{self.root}/_staging"):
            delete_path(self.spark, f"{self.root}/_staging")

    def merge(
        self,
        source: DataFrame,
        keys: list[str] | tuple[str, ...] | None = None,
        on_duplicate: str = "error",
        order_by: list[str] | None = None,
        batch_key: str | None = None,
        strategy: str = "auto",
        broadcast_limit_bytes: int | None = None,
        changed_only: bool = False,
        allow_new_columns: bool = False,
        staged: bool = False,
    ) -> MergeResult:
        """Upsert ``source`` by the table's keys into a new version; returns the counts.

        The source is staged first (see :meth:`stage`), unless ``staged`` says
        that it reads files that stay as they are until the merge is over.
        ``strategy='auto'`` broadcasts it only when its measured size in
        memory is within ``broadcast_limit_bytes`` (default: the session's
        ``spark.sql.autoBroadcastJoinThreshold``), so the target is read
        without any shuffle; larger sources use the shuffled full outer join.
        With the hash layout only the partitions the source's keys fall in
        are read and rewritten. A source column the table lacks is refused (as
        a warehouse MERGE would) unless ``allow_new_columns`` adds it. Counts
        come from ``observe`` on the pass that writes the version. A
        ``batch_key`` already committed changes nothing and gives the counts
        of its commit.
        """
        latest = self._latest()
        if latest is None:
            raise FileNotFoundError(f"provision {self.root} before merging")
        self._adopt(latest, list(keys or []))
        keys = list(self.keys)
        if not keys:
            raise ValueError("merge keys are required")
        done = self._replayed(latest, batch_key)
        if done is not None:
            known = done is not True
            return MergeResult(
                done["version"] if known else latest["version"], done["inserted_count"] if known else 0,
                done["updated_count"] if known else 0, 0, done["total_rows"] if known else -1, replayed=True,
            )
        full_target = self._read_commit(latest)
        new_cols = [c for c in source.columns if c not in full_target.columns]
        if new_cols and not allow_new_columns:
            raise ValueError(f"{self.root}: source columns not in the table: {new_cols}")
        aligned = align_to(source, full_target)
        if staged:
            parts = [F.collect_set(self._part_of(keys)).alias("parts")] if self.hash_partitions else []
            got = aligned.agg(F.sum(row_bytes(aligned.schema)).alias("bytes"), *parts).first()
            rows, size, touched = aligned, int(got["bytes"] or 0), sorted(got["parts"]) if parts else []
        else:
            rows, _, size, touched = self.stage(aligned, keys)
        src = prepare_source(rows, keys, on_duplicate, order_by)
        if strategy == "auto":
            strategy = choose_strategy(size, broadcast_limit_bytes if broadcast_limit_bytes is not None else _broadcast_limit(self.spark))
        version, target, carried = latest["version"] + 1, full_target, []
        if self.hash_partitions:
            target = self._read_commit(latest, set(touched))
            carried = [(e["part"], e["path"], e["rows"]) for e in latest["manifest"] or [] if e["part"] not in set(touched)]
            if strategy == "shuffle":
                # Both sides hashed into the table's N partitions on the keys: the
                # join needs no other exchange and each task writes one partition.
                target, src = (d.repartition(self.hash_partitions, *[F.col(quote_identifier(k)) for k in keys]) for d in (target, src))
        obs = Observation()
        merged = merge_rows(target, src, keys, strategy=strategy, changed_only=changed_only, null_keys=not self.hash_partitions)
        written, manifest = self._write(merged.observe(obs, *action_metrics()).drop(ACTION), version)
        m, held = self._counted(observed_values(obs), merged, written), sum(n for *_, n in carried)
        res = MergeResult(
            version, int(m.get("inserted_count") or 0), int(m.get("updated_count") or 0), int(m.get("kept_count") or 0) + held,
            written + held, strategy, int(m.get("unchanged_count") or 0), len(touched) if self.hash_partitions else -1,
        )
        schema = merged.drop(ACTION).schema
        self._commit(
            version, "merge", schema, res.inserted, res.updated, 0, res.total, batch_key,
            sorted(carried + manifest) if manifest is not None else None, latest["marks"],
        )
        if not staged:
            self._unstage()
        if res.inserted == 0 and res.updated == 0:
            log.warning("no rows inserted or updated in %s; the source may be empty", self.root)
        return res

    def _counted(self, observed: dict, merged: DataFrame, written: int) -> dict:
        """The counts by action of the rows written; counted again if what was observed doesn't add up to them."""
        adds_up = lambda m: sum(int(m.get(f"{a}_count") or 0) for a in ("inserted", "updated", "kept", "unchanged")) == written
        found = observed if adds_up(observed) else merged.agg(*action_metrics()).first().asDict()
        if not adds_up(found):
            raise RuntimeError(f"{self.root}: {written} rows written, but the merge counts {found}; nothing is committed")
        return found

    def delete_keys(self, keys_df: DataFrame, key_col: str, target_key: str | None = None) -> int:
        """Delete rows whose key is in ``keys_df[key_col]``; returns the count.

        The count is what the committed row totals differ by, so re-run tasks
        cannot change it. With the hash layout (and a single-column merge
        key) only the partitions holding listed keys are rewritten.
        """
        latest = self._latest()
        if latest is None:
            raise FileNotFoundError(f"table at {self.root} does not exist")
        self._adopt(latest)
        tkey, version = target_key or key_col, latest["version"] + 1
        schema = self._schema(latest)
        listed = keys_df.select(F.col(quote_identifier(key_col)).cast(schema[tkey].dataType).alias(tkey)).where(F.col(quote_identifier(tkey)).isNotNull())
        touched, carried = None, []
        if self.hash_partitions and self.keys == [tkey]:
            # At most N numbers reach the driver, whatever the size of the list.
            touched = {r[0] for r in listed.select(self._part_of([tkey]).alias("p")).distinct().collect()}
            carried = [(e["part"], e["path"], e["rows"]) for e in latest["manifest"] or [] if e["part"] not in touched]
        kept = _anti(self._read_commit(latest, touched), listed, tkey, tkey)
        written, manifest = self._write(kept, version)
        total = written + sum(n for *_, n in carried)
        deleted = int(latest["total_rows"]) - total
        self._commit(
            version, "delete", schema, 0, 0, deleted, total,
            manifest=sorted(carried + manifest) if manifest is not None else None, marks=latest["marks"],
        )
        return deleted

    def repartition(self, hash_partitions: int | None) -> int:
        """Rewrite the table into ``hash_partitions`` folders (None: the plain layout) as a new version.

        The way to a wider layout when partitions have grown too large to
        rewrite for small changes. Returns the version.
        """
        latest = self._latest()
        if latest is None:
            raise FileNotFoundError(f"table at {self.root} does not exist")
        self._adopt(latest)
        rows, self.hash_partitions = self._read_commit(latest), hash_partitions
        if hash_partitions:
            rows = rows.repartition(hash_partitions, *[F.col(quote_identifier(k)) for k in self.keys])
        written, manifest = self._write(rows, latest["version"] + 1)
        self._commit(latest["version"] + 1, "repartition", self._schema(latest), 0, 0, 0, written, manifest=manifest, marks=latest["marks"])
        return latest["version"] + 1

    # -- maintenance ----------------------------------------------------------
    def vacuum(self, keep_versions: int = 2, keep_commits: int = 1000) -> list[str]:
        """Delete data no longer needed by the last ``keep_versions`` versions.

        A version folder (or, in the hash layout, a partition folder) is
        removed only when none of the kept versions references it; staging
        left by failed changes is removed too, and so are commits before the
        last ``keep_commits``. Run it between changes (one writer per table).
        Returns the folders deleted.
        """
        if keep_versions < 1 or keep_commits < keep_versions:
            raise ValueError("keep at least one version, and the commit of every version kept")
        versions = self._versions()
        live: set[str] = set()
        for v in versions[-keep_versions:]:
            c = self._latest(v)
            live.update([e["path"].rstrip("/") for e in c["manifest"] or []] if c["hash_partitions"] else [self.version_path(v)])
        deleted: list[str] = []

        def drop(folder: str) -> None:
            delete_path(self.spark, folder)
            deleted.append(folder)

        for d in list_dirs(self.spark, f"{self.root}/data") if versions else []:
            local = f"{self.root}/data/{d.rsplit('/', 1)[1]}"
            if local in live:
                continue
            parts = [p for p in list_dirs(self.spark, d) if f"{local}/{p.rsplit('/', 1)[1]}" in live]
            for p in list_dirs(self.spark, d) if parts else []:
                if p not in parts:
                    drop(p)
            if not parts:
                drop(d)
        for v in versions[:-keep_commits]:
            drop(self._commit_path(v))
        for d in list_dirs(self.spark, f"{self.root}/_staging"):
            drop(d)
        return deleted


def merge_into_sql(table: str, source_view: str, columns: list[str], keys: list[str] | tuple[str, ...]) -> str:
    """The ``MERGE INTO`` statement of the upsert: all columns overwritten, unmatched source rows inserted."""
    q = quote_identifier
    on = " AND ".join(f"t.{q(k)} = s.{q(k)}" for k in keys)
    sets = ", ".join(f"t.{q(c)} = s.{q(c)}" for c in columns if c not in keys)
    names = ", ".join(q(c) for c in columns)
    update = f" WHEN MATCHED THEN UPDATE SET {sets}" if sets else ""
    values = ", ".join(f"s.{q(c)}" for c in columns)
    return f"MERGE INTO {table} t USING {source_view} s ON {on}{update} WHEN NOT MATCHED THEN INSERT ({names}) VALUES ({values})"


def merge_into(spark: SparkSession, table: str, source: DataFrame, keys: list[str] | tuple[str, ...], on_duplicate: str = "error", order_by: list[str] | None = None) -> None:
    """Upsert into a catalog table whose format has row-level changes; the same rules as :meth:`VersionedTable.merge`."""
    view = f"merge_source_{uuid.uuid4().hex}"
    prepare_source(source, keys, on_duplicate, order_by).createOrReplaceTempView(view)
    try:
        spark.sql(merge_into_sql(table, view, source.columns, keys))
    finally:
        spark.catalog.dropTempView(view)


def parquet_file_name(table: str, when: _dt.datetime | None = None) -> str:
    """``<table>-<YYYY-MM-DD_HH_MM_SS>.parquet``: the name a table's load file
    gets (local clock unless ``when`` is given)."""
    return f"{table}-{(when or _dt.datetime.now()).strftime('%Y-%m-%d_%H_%M_%S')}.parquet"


def write_parquet(df: DataFrame, path: str, compression: str = "gzip", mode: str = "errorifexists") -> str:
    """Write a frame as Parquet (gzip by default); returns the path."""
    df.write.mode(mode).option("compression", compression).parquet(path)
    return path


# Spark's JSON defaults keep milliseconds only; these keep every microsecond.
JSON_TIME_OPTIONS = {
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
}


def write_json(df: DataFrame, path: str, mode: str = "errorifexists") -> str:
    """Line-delimited JSON sink, timestamps kept to the microsecond."""
    df.write.mode(mode).options(**JSON_TIME_OPTIONS).json(path)
    return path


def read_json(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Read what :func:`write_json` wrote, with a declared schema."""
    return spark.read.schema(schema).options(**JSON_TIME_OPTIONS).json(path)


def with_date_parts(df: DataFrame, ts_col: str) -> DataFrame:
    """Add integer ``year``, ``month``, ``day`` columns from a timestamp.

    Written with ``partitionBy('year', 'month', 'day')`` they give the
    unpadded layout ``year=2024/month=1/day=3``.
    """
    ts = F.col(ts_col)
    return df.withColumns({"year": F.year(ts), "month": F.month(ts), "day": F.dayofmonth(ts)})


def write_date_partitioned(df: DataFrame, path: str, ts_col: str, mode: str = "errorifexists", max_records_per_file: int = 5_000_000) -> str:
    """Write with a ``year=/month=/day=`` folder layout.

    No shuffle: each task writes the days present in its own input split
    (Spark sorts rows by the partition values inside the task), so one day
    holding a large share of the rows is still spread over all the tasks that
    read it, and ``maxRecordsPerFile`` bounds the size of each file.
    """
    parts = with_date_parts(df, ts_col)
    (
        parts.write.mode(mode)
        .option("maxRecordsPerFile", max_records_per_file)
        .partitionBy("year", "month", "day")
        .parquet(path)
    )
    return path
