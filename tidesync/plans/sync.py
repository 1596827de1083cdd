"""The nine-table sync run: landed snapshots in, keyed tables and audit rows out.

Landing layout (one folder per snapshot, JSON pages, one object per line)::

    <landing>/<table>/                    eight plain snapshots
    <landing>/inventory_query/active/     the active inventory snapshot
    <landing>/inventory_query/depleted/   the depleted inventory snapshot
    <landing>/inventory_usage/            usage pages, one page sequence per
                                          receipt, each page carrying the
                                          receipt number it was fetched for

Order of work, as in the source system: every table is read and validated
before anything is loaded (a bad record anywhere stops the run with nothing
written); then tables load one after another: provision the table (also when
the input is empty), skip empty inputs, merge by key, append one audit row.

Per table the plan is: JSON scan -> one row per record, with its page's order
and flags -> projection and validation (narrow, codegen), written once to a
staging folder -> where the snapshot ends, read from the staged flag columns
-> optional row dedup (partial aggregate) -> load cast -> merge with the
current version on the merge keys, straight from the staged files -> new
version written, counts observed in the same pass. The landed JSON is parsed
once, each record is staged once, and staging is removed when the run is over.
A run id makes a run repeatable: a table that a failed run already merged is
not merged again, and its audit row gets the counts of that merge.
"""

from __future__ import annotations

import logging
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidesync.models import ALL_SPECS, INVENTORY, INVENTORY_USAGE
from tidesync.operators.dedup import full_dedup, union_snapshots
from tidesync.operators.keys import detail_lookup
from tidesync.operators.validate import ERRORS, ValidationError, cast_to_target, project_records
from tidesync.plans.audit import append_audit, audit_row, stable_id
from tidesync.plans.tables import VersionedTable, observed_values
from tidesync.session import delete_path, fresh_dir, path_exists
from tidesync.sources.pages import PAGE, POSITION, page_closes, read_envelopes, within_end
from tidesync.spec import TableSpec

USAGE_KEY = "InventoryReceiptNumber"
USAGE_KEY_FIELD = "inventory_receipt_number"

log = logging.getLogger(__name__)


@dataclass
class LoadResult:
    table: str
    inserted: int
    updated: int
    skipped_empty: bool
    missing: bool = False


class MissingSnapshotError(FileNotFoundError):
    """Strict landing: a snapshot folder is absent."""


def _folders(name: str) -> dict[str, str]:
    """Landing folders of a table, by the part of its rows they hold."""
    return {part: f"{name}/{part}" for part in ("active", "depleted")} if name == INVENTORY.name else {"": name}


def landed(spark: SparkSession, landing: str, missing: str = "report") -> dict[str, dict[str, str]]:
    """Existing snapshot folders per table and part.

    The landing folder itself must exist. A snapshot folder that does not is
    logged, and fails the run with ``missing="fail"``; errors while looking
    always do. Usage is read for active receipts only, so without the active
    inventory it is reported too.
    """
    if missing not in ("report", "fail"):
        raise ValueError(f"missing must be 'report' or 'fail', not {missing!r}")
    landing = landing.rstrip("/")
    if not path_exists(spark, landing):
        raise MissingSnapshotError(f"no landing folder {landing}")
    found: dict[str, dict[str, str]] = {}
    absent = []
    for name in ALL_SPECS:
        for part, folder in _folders(name).items():
            if path_exists(spark, f"{landing}/{folder}"):
                found.setdefault(name, {})[part] = f"{landing}/{folder}"
            else:
                absent.append(folder)
    if INVENTORY_USAGE.name in found and "active" not in found.get(INVENTORY.name, {}):
        del found[INVENTORY_USAGE.name]
        absent.append(f"{INVENTORY_USAGE.name} (needs {INVENTORY.name}/active)")
    if absent and missing == "fail":
        raise MissingSnapshotError(f"missing under {landing}: {', '.join(absent)}")
    for folder in absent:
        log.warning("no snapshot %s under %s", folder, landing)
    return found


@dataclass(frozen=True)
class Staging:
    """What the pass that staged a snapshot saw of its bad records.

    ``known`` is false where that can't be told without reading the staged
    rows (a bad record beside ends of several requests, or nothing reported);
    ``first`` describes the first bad record that counts, if there is one.
    """

    known: bool
    first: dict | None = None


def _seen(observed: dict, per_key: bool) -> Staging:
    if observed.get("rows") is None:
        return Staging(False)
    bad, end = observed["bad"], observed["end"]
    if bad is None:
        return Staging(True)
    if per_key or end is not None and (end["page"] is None) != (bad["place"]["page"] is None):
        return Staging(False)
    # Records after the end of the snapshot don't count; the least place of a bad one decides.
    return Staging(True, None if end is not None and end < bad["place"] else {ERRORS: bad["errors"], "record": bad["record"], "page": bad["place"]["page"]})


def stage_records(
    spark: SparkSession, path: str, spec: TableSpec, folder: str, key_field: str | None = None, seen: list[Staging] | None = None
) -> DataFrame:
    """Landed pages at ``path`` -> projected records with ``_errors``, staged once under ``folder``.

    Every page leaves at least one row, so the flags of pages without records
    are staged as well; the rows returned are the records of successful pages
    up to the snapshot's end. The pass that writes them also finds the end and
    the first bad record (observed aggregates), for the check of
    :func:`validated`; what it saw is appended to ``seen``.
    """
    env = read_envelopes(spark, path, spec, key_field)
    key = [F.col(key_field).alias("_key")] if key_field else []
    rows = env.select(
        PAGE, POSITION, *key, F.coalesce("Succeed", F.lit(False)).alias("_ok"), page_closes(env, key_field).alias("_closes"),
        F.posexplode_outer("Response").alias("_at", "_record"),
    )
    kept = [PAGE, POSITION, "_ok", "_closes", "_at", *(["_key"] if key_field else [])]
    fields = [F.col("_key" if f.source == key_field else f"_record.{f.source}").alias(f.source) for f in spec.fields]
    projected = project_records(rows.select(*kept, *fields), spec, keep=kept)
    place = F.struct(F.col(PAGE).cast("long").alias("page"), F.when(F.col(PAGE).isNull(), F.col(POSITION)).alias("position"))
    bad = F.col("_ok") & F.col("_at").isNotNull() & (F.size(ERRORS) > 0)
    about = F.struct(place.alias("place"), F.col("_at").alias("at"), F.col(ERRORS).alias("errors"), F.to_json(F.struct(*spec.names)).alias("record"))
    pass_ = Observation()
    projected.observe(
        pass_, F.count(F.lit(1)).alias("rows"), F.min(F.when(F.col("_ok") & F.col("_closes"), place)).alias("end"), F.min(F.when(bad, about)).alias("bad")
    ).write.parquet(folder)
    if seen is not None:
        seen.append(_seen(observed_values(pass_), bool(key_field)))
    staged = spark.read.schema(projected.schema).parquet(folder)
    used = within_end(staged, F.col("_closes"), ["_key"] if key_field else [])
    return used.where(F.col("_ok") & F.col("_at").isNotNull()).drop(*kept)


def records(
    spark: SparkSession, landing: str, staging: str, missing: str = "report", seen: dict[str, list[Staging]] | None = None
) -> dict[str, DataFrame]:
    """Projected records (with ``_errors``) per landed table, incl. the union of the two
    inventory snapshots and the usage rows of the active receipts. ``seen`` gets
    what staging saw of each table's bad records."""
    out: dict[str, DataFrame] = {}
    active: DataFrame | None = None
    for name, parts in landed(spark, landing, missing).items():
        spec = ALL_SPECS[name]
        key_field = USAGE_KEY if name == INVENTORY_USAGE.name else None
        found: list[Staging] = []
        frames = {part: stage_records(spark, path, spec, f"{staging}/{name}/{part or 'all'}", key_field, found) for part, path in parts.items()}
        if seen is not None:
            seen[name] = found
        out[name] = union_snapshots(*frames.values())
        if name == INVENTORY.name:
            active = frames.get("active")
        if name == INVENTORY_USAGE.name:
            # Keys come from the active snapshot only and are not deduplicated.
            out[name] = detail_lookup(active.select(USAGE_KEY_FIELD), USAGE_KEY_FIELD, out[name])
    return out


def validated(
    projected: dict[str, DataFrame], on_error: str = "fail", seen: dict[str, list[Staging]] | None = None
) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """Check every table before any load. Returns (load-ready, quarantined);
    only tables with rejected rows appear in the quarantine map.

    In strict mode a bad record in any table stops the run here, before any
    table is touched; the error names the first one. What staging ``seen``
    already settles costs no pass: tables without a bad record are not read
    again. For others the staged error column alone is counted.
    """
    if on_error not in ("fail", "quarantine"):
        raise ValueError(f"on_error must be 'fail' or 'quarantine', not {on_error!r}")
    ready: dict[str, DataFrame] = {}
    quarantine: dict[str, DataFrame] = {}
    for name, df in projected.items():
        bad = df.filter(F.size(ERRORS) > 0)
        found = (seen or {}).get(name)
        settled = bool(found) and all(x.known for x in found)
        first = [x.first for x in found or [] if x.first]
        if settled and not first:
            count = 0
        else:
            count = bad.count()
        if count and on_error == "fail":
            raise ValidationError(name, count, first + [r.asDict(recursive=True) for r in bad.limit(5).collect()])
        if count:
            quarantine[name] = bad
        good = df.filter(F.size(ERRORS) == 0).drop(ERRORS)
        if ALL_SPECS[name].dedup_rows:
            good = full_dedup(good)
        ready[name] = cast_to_target(good, ALL_SPECS[name])
    return ready, quarantine


def load_tables(
    spark: SparkSession,
    ready: dict[str, DataFrame],
    warehouse: str,
    audit_path: str,
    f_number: str,
    api: str = "records",
    run_id: str | None = None,
    inserted_at: str | None = None,
    on_duplicate: str = "error",
    hash_partitions: dict[str, int] | None = None,
    staged: bool = False,
) -> list[LoadResult]:
    """Provision, merge and audit each table in turn.

    ``hash_partitions`` maps the names of tables loaded with small deltas to a
    partition count, for their creation (only the touched partitions are
    rewritten). With a ``run_id`` a table's merge is done once per run, and
    its audit row has the counts of that merge. ``staged`` says that the
    frames read files that stay until the load is over. See
    :class:`VersionedTable`.
    """
    results = []
    for name, df in ready.items():
        spec = ALL_SPECS[name]
        table = VersionedTable(spark, f"{warehouse.rstrip('/')}/{name}", spec.keys, hash_partitions=(hash_partitions or {}).get(name))
        table.provision(spec.target_schema())
        if df.isEmpty():
            results.append(LoadResult(name, 0, 0, True))
            continue
        # Usage rows come out of a lookup join: staged again, so that it runs once.
        in_place = staged and name != INVENTORY_USAGE.name and not spec.dedup_rows
        batch_key = f"{run_id}:{name}" if run_id else None
        res = table.merge(df, spec.keys, on_duplicate=on_duplicate, batch_key=batch_key, staged=in_place)
        row_id = stable_id(run_id, name) if run_id else None
        append_audit(spark, audit_path, [audit_row(f_number, api, name, res.inserted, res.updated, inserted_at, row_id)])
        results.append(LoadResult(name, res.inserted, res.updated, False))
    return results


def sync(
    spark: SparkSession,
    landing: str,
    warehouse: str,
    f_number: str,
    api: str = "records",
    on_error: str = "fail",
    run_id: str | None = None,
    inserted_at: str | None = None,
    hash_partitions: dict[str, int] | None = None,
    missing: str = "report",
) -> list[LoadResult]:
    """Run the whole sync: read, validate all, then load table by table.

    In quarantine mode, rejected rows (with their error reasons) are kept
    under ``<warehouse>/_quarantine/<table>/run_id=<run>``. Tables without a
    landed snapshot come last in the results, marked ``missing``; with
    ``missing="fail"`` they fail the run before anything is read.
    """
    warehouse, run_tag = warehouse.rstrip("/"), run_id or uuid.uuid4().hex
    staging = fresh_dir(spark, "sync-staging")
    try:
        seen: dict[str, list[Staging]] = {}
        ready, quarantine = validated(records(spark, landing, staging, missing, seen), on_error, seen)
        for name, bad in quarantine.items():
            bad.write.mode("overwrite").parquet(f"{warehouse}/_quarantine/{name}/run_id={run_tag}")
        results = load_tables(
            spark, ready, warehouse, f"{warehouse}/_audit", f_number, api, run_id, inserted_at,
            hash_partitions=hash_partitions, staged=True,
        )
    finally:
        if path_exists(spark, staging):
            delete_path(spark, staging)
    return results + [LoadResult(name, 0, 0, False, True) for name in ALL_SPECS if name not in ready]


def seed_counts(
    spark: SparkSession,
    warehouse: str,
    tables: list[str],
    f_number: str,
    api: str = "records",
    inserted_at: str | None = None,
    run_id: str | None = None,
) -> DataFrame:
    """Row count of each loaded table, appended to the audit log as
    ``(inserted = count, updated = 0)``; returns the rows appended.

    One aggregate per table (Parquet counts come from file metadata), unioned
    into a single small frame.
    """
    from tidesync.plans.audit import audit_frame, table_counts, utc_now_iso

    clock = inserted_at or utc_now_iso()
    frames = {name: VersionedTable(spark, f"{warehouse.rstrip('/')}/{name}").read() for name in tables}
    counts = table_counts(frames, f_number, api, clock).collect()
    rows = [
        audit_row(f_number, api, r.table_name, r.inserted_count, 0, clock, stable_id(run_id, r.table_name) if run_id else None)
        for r in counts
    ]
    append_audit(spark, f"{warehouse.rstrip('/')}/_audit", rows)
    return audit_frame(spark, rows)
