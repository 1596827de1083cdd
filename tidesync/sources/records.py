"""Landed records: one row per record, the record a shredded VARIANT, request filters on its fields in the scan.

Pages are parsed once and exploded where they are read. A landed row has its
page's order and flags in narrow columns and the record as one VARIANT. Parquet
stores it shredded: Spark infers the fields of the records it writes and gives
each a typed column of its own (values of another type stay beside it, so
nothing is lost). A reader that asks for three fields of forty then reads the
columns of those three: ``variant_get`` on the record becomes part of the
scan's ``ReadSchema``.

:func:`filtered_records` makes use of it in two steps inside one scan. The
fields that a request filter names are checked first, by the same rules the
load applies to them; only rows that pass have their other fields validated
and cast. With ``fields`` the scan reads no other columns at all.

Where a snapshot ends is found from the flag columns alone, as for pages.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidesync.operators.filters import filter_meanings, request_conditions
from tidesync.operators.validate import cast_to_target, project_records, projection_barrier, split_valid
from tidesync.session import fresh_dir
from tidesync.sources.pages import PAGE, POSITION, REQUEST_KEY, page_closes, read_envelopes, within_end
from tidesync.spec import TableSpec

RECORD, AT = "_record", "_at"
_OK, _CLOSES = "_ok", "_closes"

# The settings under which Spark writes VARIANT columns shredded, with the fields it infers.
_SHREDDED = {"spark.sql.variant.writeShredding.enabled": "true", "spark.sql.variant.inferShreddingSchema": "true"}


@contextmanager
def shredded_variants(spark: SparkSession) -> Iterator[None]:
    """Within it, VARIANT columns are written shredded; the session's own settings come back after."""
    before = {k: spark.conf.get(k, None) for k in _SHREDDED}
    try:
        for k, v in _SHREDDED.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def record_rows(env: DataFrame, key_field: str | None = None) -> DataFrame:
    """Pages -> a row per record with its page's order and flags; a page without records leaves one row."""
    order = [c for c in (PAGE, POSITION) if c in env.columns]
    key = [F.col(key_field).alias(REQUEST_KEY)] if key_field else []
    return env.select(
        *order, *key, F.coalesce("Succeed", F.lit(False)).alias(_OK), page_closes(env, key_field).alias(_CLOSES),
        F.posexplode_outer("Response").alias(AT, RECORD),
    )


def land_records(env: DataFrame, folder: str | None = None, key_field: str | None = None) -> DataFrame:
    """The records of ``env`` (``Response`` an array of VARIANT) written shredded and read back."""
    spark, rows = env.sparkSession, record_rows(env, key_field)
    path = folder or fresh_dir(spark, "records")
    with shredded_variants(spark):
        rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def read_records(
    spark: SparkSession, path: str | list[str], spec: TableSpec, key_field: str | None = None, folder: str | None = None
) -> DataFrame:
    """Landed JSON pages at ``path`` -> landed rows of :func:`land_records`; the JSON is parsed once."""
    return land_records(read_envelopes(spark, path, spec, key_field, "record"), folder, key_field)


def of_keys(env: DataFrame, keys: DataFrame, key_col: str, key_field: str) -> DataFrame:
    """Detail pages that were fetched for one of ``keys``; repeated and null keys make no difference.

    The pages are filtered before their records are taken apart. Few keys are
    broadcast; for many, Spark builds a Bloom filter of them at run time and
    drops pages in the scan, so that only pages of asked keys are shuffled
    (from the scan size that ``build_session`` sets).
    """
    wanted = keys.select(F.col(key_col).alias("_wanted")).where(F.col("_wanted").isNotNull())
    return env.join(wanted, env[key_field] == wanted["_wanted"], "left_semi")


def read_detail_records(
    spark: SparkSession, path: str | list[str], spec: TableSpec, key_field: str, keys: DataFrame, key_col: str, folder: str | None = None
) -> DataFrame:
    """Landed rows of the detail pages of ``keys`` alone; pages of other keys are not taken apart."""
    return land_records(of_keys(read_envelopes(spark, path, spec, key_field, "record"), keys, key_col, key_field), folder, key_field)


def usable_records(landed: DataFrame) -> DataFrame:
    """Records of successful pages up to the end of their snapshot (of each request key's, where there is one)."""
    group = [REQUEST_KEY] if REQUEST_KEY in landed.columns else []
    return within_end(landed, F.col(_CLOSES), group).where(F.col(_OK) & F.col(AT).isNotNull())


def _member(source: str) -> Column:
    return F.variant_get(RECORD, "$['" + source.replace("'", "\\'") + "']", "variant")


def record_fields(rows: DataFrame, spec: TableSpec, key_field: str | None = None, keep: list[str] | tuple[str, ...] = ()) -> DataFrame:
    """The declared fields of every record, source-named; ``key_field`` is the key that fetched the page."""
    fields = [(F.col(REQUEST_KEY) if f.source == key_field else _member(f.source)).alias(f.source) for f in spec.fields]
    return rows.select(*[F.col(k) for k in keep], *fields)


def narrowed(spec: TableSpec, names: list[str]) -> TableSpec:
    """``spec`` with the fields of ``names`` and its merge keys only, in declared order."""
    unknown = [n for n in names if n not in spec.names]
    if unknown:
        raise KeyError(f"{spec.name}: no such fields: {unknown}")
    return replace(spec, fields=tuple(f for f in spec.fields if f.name in names or f.name in spec.keys))


def passing(rows: DataFrame, spec: TableSpec, filters: dict) -> DataFrame:
    """Rows of :func:`record_fields` whose filtered fields pass ``filters``, each validated and cast as the load would.

    All columns are kept. A value that the load would refuse is let through, so
    that the load refuses it. Only the filtered fields are decoded for it; a
    projection barrier keeps the test above that, so they are decoded once.
    """
    tests = filter_meanings(spec, filters)
    names = {name for found in tests.values() for name in found}
    if not names:
        return rows
    part = replace(spec, fields=tuple(f for f in spec.fields if f.name in names), keys=tuple(sorted(names)))
    kept = {f"_c{k}": c for k, c in enumerate(rows.columns)}  # a field's name may be another column's in other letters
    fields = rows.select(*[F.col(f"`{c}`").alias(k) for k, c in kept.items()], *[F.col(f"`{f.source}`") for f in part.fields])
    checked = projection_barrier(project_records(fields, part, keep=list(kept)))
    values = {n: F.col(n).try_cast(part.field(n).target_type) for n in names}
    refused = reduce(lambda a, b: a | b, [F.col(n).isNotNull() & values[n].isNull() for n in names], F.size("_errors") > 0)
    conditions = request_conditions(tests, values, {f.name: f.target_type for f in part.fields})
    found = checked.where((refused | reduce(lambda a, b: a & b, conditions)) & (F.col("_task") >= 0))
    return found.select(*[F.col(k).alias(c) for k, c in kept.items()])


def filtered_records(
    landed: DataFrame, spec: TableSpec, filters: dict | None = None, fields: list[str] | None = None, key_field: str | None = None
) -> DataFrame:
    """Typed records of ``spec`` that pass request ``filters``; with ``fields`` only those and the merge keys are read.

    Records that fail validation (of the fields read) are left out.
    """
    part = narrowed(spec, fields) if fields else spec
    asked = {name for found in filter_meanings(spec, filters or {}).values() for name in found}
    read = narrowed(spec, [*part.names, *asked])
    rows = passing(record_fields(usable_records(landed), read, key_field), spec, filters or {})
    good, _ = split_valid(project_records(rows.select(*[f.source for f in part.fields]), part))
    out = cast_to_target(good, part)
    return out.select(*fields) if fields else out
