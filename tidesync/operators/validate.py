"""Project records to a declared spec and validate them (one pass, no UDF).

``project_records`` renames source keys to field names, drops undeclared keys,
fills missing optional keys with null, applies the blank / zero-date rules and
the lax type rules, and collects one error array per row. Everything is a
column expression, so the whole validation is a single narrow ``select``:
no shuffle, no Python, partition-parallel at any scale.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidesync.functions.normalize import accepted, clean_text, declared_value, raw_parts, variant_kind_column
from tidesync.spec import TableSpec

ERRORS = "_errors"


class ValidationError(Exception):
    """Raised by strict validation; carries a bounded sample of bad rows."""

    def __init__(self, table: str, bad_rows: int, sample: list):
        self.table = table
        self.bad_rows = bad_rows
        self.sample = sample
        super().__init__(f"{table}: {bad_rows} invalid record(s); first: {sample}")


def _validated_type(spec_field) -> T.DataType:
    """Type of a field right after validation (before the load cast)."""
    if spec_field.kind == "datetime" or spec_field.is_text_union:
        return T.StringType()
    return spec_field.target_type


_PARTS_BY_KIND = {
    "str": ("null", "is_text", "raw"),
    "datetime": ("null", "is_text", "raw", "num"),
    "int": ("null", "is_text", "raw", "num", "bool", "whole"),
    "float": ("null", "is_text", "raw", "num", "cents"),
    "Decimal": ("null", "is_text", "raw", "num"),
    "bool": ("null", "is_text", "raw", "num", "bool"),
    "list": ("null", "is_text", "raw", "arr"),
}


def _parts_needed(fs) -> tuple[str, ...]:
    return _PARTS_BY_KIND["datetime"] if fs.is_text_union else _PARTS_BY_KIND[fs.kind]


def project_records(df: DataFrame, spec: TableSpec, keep: list[str] | tuple[str, ...] = ()) -> DataFrame:
    """Records with source-named columns -> declared fields plus ``_errors``.

    ``keep`` lists extra input columns carried through unchanged (e.g. the
    page number or file of origin, for quarantine reports).

    The rules run as a chain of narrow projections: runtime type of each
    VARIANT; typed parts (text / number / boolean / list); cleaned text;
    converted value; then acceptance and the error array. Each step reads
    the previous one's columns, so every value is decoded, cleaned and
    matched once per row (Catalyst does not merge projections when that
    would repeat non-trivial expressions). All of it stays in whole-stage
    codegen; there is no shuffle and no Python.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    present = [fs for fs in spec.fields if fs.source in types]
    ref = {fs.name: f"_in{i}" for i, fs in enumerate(present)}
    kept = [F.col(f"`{k}`") for k in keep]

    def carry(names):
        return [F.col(n) for n in names]

    # 1: inputs under internal names; runtime type of each VARIANT.
    s1_cols, s1_names = [], []
    for fs in present:
        r = ref[fs.name]
        s1_cols.append(F.col(f"`{fs.source}`").alias(r))
        s1_names.append(r)
        if isinstance(types[fs.source], T.VariantType):
            s1_cols.append(variant_kind_column(F.col(f"`{fs.source}`")).alias(r + "_k"))
            s1_names.append(r + "_k")
    s1 = df.select(*kept, *s1_cols)

    # 2: typed parts.
    s2_cols = []
    for fs in present:
        r = ref[fs.name]
        dtype = types[fs.source]
        kcol = F.col(r + "_k") if isinstance(dtype, T.VariantType) else None
        parts = raw_parts(F.col(r), dtype, kcol)
        for pn in _parts_needed(fs):
            s2_cols.append(parts[pn].alias(f"{r}_{pn}"))
    s2 = s1.select(*kept, *s2_cols)

    # 3: cleaned text (blank and zero-date rules).
    s3_cols = []
    for fs in present:
        r = ref[fs.name]
        for pn in _parts_needed(fs):
            if pn == "raw":
                s3_cols.append(clean_text(F.col(f"{r}_raw"), spec.zero_date_to_null).alias(f"{r}_text"))
            else:
                s3_cols.append(F.col(f"{r}_{pn}"))
    s3 = s2.select(*kept, *s3_cols)

    # 4: converted value.
    s4_cols = []
    null_n, null_b = F.lit(None).cast(T.DecimalType(38, 10)), F.lit(None).cast(T.BooleanType())
    null_w, null_c = F.lit(None).cast(T.DecimalType(38, 0)), F.lit(None).cast(T.DecimalType(38, 2))
    for fs in present:
        r = ref[fs.name]
        need = _parts_needed(fs)
        num = F.col(f"{r}_num") if "num" in need else null_n
        boolean = F.col(f"{r}_bool") if "bool" in need else null_b
        arr = F.col(f"{r}_arr") if "arr" in need else F.lit(None).cast(T.ArrayType(T.StringType()))
        whole = F.col(f"{r}_whole") if "whole" in need else null_w
        cents = F.col(f"{r}_cents") if "cents" in need else null_c
        value = declared_value(fs.kind, fs.is_text_union, F.col(f"{r}_text"), num, boolean, arr, whole, cents)
        s4_cols += [value.cast(_validated_type(fs)).alias(f"{r}_val"), F.col(f"{r}_null"), F.col(f"{r}_is_text"), F.col(f"{r}_text")]
        if "num" in need:
            s4_cols.append(F.col(f"{r}_num"))
    s4 = s3.select(*kept, *s4_cols)

    # 5: output fields and the error array.
    cols = list(kept)
    errors = []
    for fs in spec.fields:
        if fs.name in ref:
            r = ref[fs.name]
            value = F.col(f"{r}_val")
            num = F.col(f"{r}_num") if "num" in _parts_needed(fs) else F.lit(None).cast(T.DecimalType(38, 10))
            ok = accepted(fs.kind, fs.is_text_union, F.col(f"{r}_null"), F.col(f"{r}_is_text"), F.col(f"{r}_text"), num, value)
        else:
            value, ok = F.lit(None).cast(_validated_type(fs)), F.lit(True)
        cols.append(value.alias(fs.name))
        errors.append(F.when(~ok, F.lit(f"{fs.name}: type not accepted")))
        if fs.required:
            errors.append(F.when(ok & value.isNull(), F.lit(f"{fs.name}: required")))
    cols.append(F.array_compact(F.array(*errors)).alias(ERRORS))
    return s4.select(*cols)


def projection_barrier(projected: DataFrame) -> DataFrame:
    """Keep the split filter above the conversions.

    A filter on ``_errors`` would otherwise be pushed below the projection
    that computes it, with the whole conversion inlined into the filter, so
    every value would be decoded twice. A projection holding a
    non-deterministic column (the task's partition id) that the filter
    references is not crossed by filter pushdown (nor pruned away), so the
    conversion runs once per row.
    """
    return projected.withColumn("_task", F.spark_partition_id())


def split_valid(projected: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows without ``_errors``, quarantined rows with it)."""
    marked = projection_barrier(projected)
    live = F.col("_task") >= 0
    bad = marked.filter((F.size(ERRORS) > 0) & live).drop("_task")
    good = marked.filter((F.size(ERRORS) == 0) & live).drop(ERRORS, "_task")
    return good, bad


def require_valid(projected: DataFrame, table: str = "records", sample: int = 5) -> DataFrame:
    """Strict mode: any invalid record fails the run before anything is loaded.

    The check is one filtered count plus a bounded sample; only that sample
    reaches the driver. It is a pass of its own over ``projected``: stage
    records that are dear to compute first, as the sync run and the stream do.
    """
    bad = projection_barrier(projected).filter((F.size(ERRORS) > 0) & (F.col("_task") >= 0)).drop("_task")
    rows = bad.limit(sample).collect()
    if rows:
        raise ValidationError(table, bad.count(), [r.asDict(recursive=True) for r in rows])
    return projected.drop(ERRORS)


def validate(df: DataFrame, spec: TableSpec, on_error: str = "fail", keep=()) -> tuple[DataFrame, DataFrame | None]:
    """Project + validate. ``on_error='fail'`` raises on the first bad record
    (returns ``(good, None)``); ``'quarantine'`` returns ``(good, bad)``."""
    projected = project_records(df, spec, keep)
    if on_error == "fail":
        return require_valid(projected, spec.name), None
    if on_error == "quarantine":
        return split_valid(projected)
    raise ValueError(f"on_error must be 'fail' or 'quarantine', not {on_error!r}")


def error_counts(projected: DataFrame, with_valid: bool = False) -> DataFrame:
    """Quarantine report: one row per error reason with its row count, in one pass.

    ``with_valid`` counts the rows without any error as ``valid``."""
    reasons = F.col(ERRORS)
    if with_valid:
        reasons = F.when(F.size(ERRORS) == 0, F.array(F.lit("valid"))).otherwise(reasons)
    return projected.select(F.explode(reasons).alias("reason")).groupBy("reason").agg(F.count(F.lit(1)).alias("rows"))


def cast_to_target(df: DataFrame, spec: TableSpec, strict: bool = True) -> DataFrame:
    """Cast validated fields to the table's target types (the load-time cast).

    ``strict`` uses the ANSI cast, so text that is not a date in a TIMESTAMP
    field fails the load, as the warehouse cast does; otherwise ``try_cast``
    turns it into null. Extra columns pass through.
    """
    names = set(spec.names)
    out = []
    for c in df.columns:
        if c in names:
            t = spec.field(c).target_type
            col = F.col(f"`{c}`")
            out.append((col.cast(t) if strict else col.try_cast(t)).alias(c))
        else:
            out.append(F.col(f"`{c}`"))
    return df.select(*out)
