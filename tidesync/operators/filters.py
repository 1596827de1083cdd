"""Projection, tagging and snapshot predicates.

Predicates are plain column expressions; a blank filter value means "no
filter", as in the snapshot requests. Applied to a Parquet scan, Catalyst
pushes equality and range predicates into the reader (``PushedFilters``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidesync.functions.normalize import unescape_name


def _blank(v) -> bool:
    return v is None or v == ""


def snapshot_filter(
    df: DataFrame,
    equals: dict | None = None,
    contains: dict | None = None,
    between: dict | None = None,
    flags: dict | None = None,
) -> DataFrame:
    """Filter rows as a snapshot request would.

    ``equals`` / ``flags``: column == value; ``contains``: case-sensitive
    substring; ``between``: ``(low, high)`` with inclusive ends, either end
    may be blank. Blank values are skipped.
    """
    columns = [*(equals or {}), *(flags or {}), *(contains or {}), *(between or {})]
    values = {c: F.col(c) for c in columns}
    types = {c: df.schema[c].dataType for c in (between or {})}
    for cond in _conditions(values, types, equals, contains, between, flags):
        df = df.filter(cond)
    return df


def _conditions(values: dict[str, Column], types: dict, equals=None, contains=None, between=None, flags=None) -> list[Column]:
    conds = [values[c] == F.lit(v) for c, v in (equals or {}).items() if not _blank(v)]
    conds += [values[c] == F.lit(v) for c, v in (flags or {}).items() if v is not None]
    conds += [values[c].contains(F.lit(v)) for c, v in (contains or {}).items() if not _blank(v)]
    for c, (low, high) in (between or {}).items():
        if not _blank(low):
            conds.append(values[c] >= F.lit(low).cast(types[c]))
        if not _blank(high):
            conds.append(values[c] <= F.lit(high).cast(types[c]))
    return conds


def rename_project(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Keep only ``mapping``'s source columns, renamed; missing ones become null."""
    have = set(df.columns)
    return df.select(
        *[(F.col(f"`{src}`") if src in have else F.lit(None)).alias(dst) for src, dst in mapping.items()]
    )


def tag(df: DataFrame, column: str, value) -> DataFrame:
    """Set ``column`` to a constant, overwriting any existing value."""
    return df.withColumn(column, value if isinstance(value, Column) else F.lit(value))


def unescape_columns(df: DataFrame) -> DataFrame:
    """Restore escaped column names (``__dot__`` -> ``.``, ``underscore____`` -> ``__``)."""
    return df.toDF(*[unescape_name(c) for c in df.columns])


def lower_columns(df: DataFrame, override: bool = False) -> DataFrame:
    """Lowercase every column name unless ``override`` keeps the given case."""
    if override:
        return df
    lowered = [c.lower() for c in df.columns]
    if len(set(lowered)) != len(lowered):
        raise ValueError("column names collide when lowercased")
    return df.toDF(*lowered)


class RequestFilterError(KeyError):
    """A request filter that no field of the records can answer."""


def filter_meanings(spec, filters: dict) -> dict[str, dict]:
    """Non-blank request filters by what they test: ``equals``, ``contains``, ``from`` and ``to``, each field -> value."""
    from tidesync.models import REFUSED_FILTERS, REQUEST_FILTERS
    from tidesync.spec import snake_name

    by_source = {f.source: f.name for f in spec.fields}
    aliases, refused = REQUEST_FILTERS.get(spec.name, {}), REFUSED_FILTERS.get(spec.name, {})

    def meaning(key: str) -> tuple[str, str]:
        if key in aliases:
            return aliases[key]
        if key in refused:
            raise RequestFilterError(f"{spec.name}: {key} can't be applied: {refused[key]}")
        for test, token in (
            ("contains", key.removesuffix("Contains") if key.endswith("Contains") else ""),
            ("from", key.removeprefix("From") if key.startswith("From") else ""),
            ("to", key.removeprefix("To") if key.startswith("To") and key[2:3].isupper() else ""),
            ("equals", key),
        ):
            field = by_source.get(token) or (snake_name(token) if token and snake_name(token) in spec.names else None)
            if field:
                return test, field
        raise RequestFilterError(f"{spec.name}: no field for request filter {key!r}")

    found: dict[str, dict] = {"equals": {}, "contains": {}, "from": {}, "to": {}}
    for key, value in filters.items():
        if not _blank(value):
            test, field = meaning(key)
            found[test][field] = value
    return found


def _ranges(found: dict[str, dict]) -> dict[str, tuple]:
    return {c: (found["from"].get(c, ""), found["to"].get(c, "")) for c in [*found["from"], *found["to"]]}


def request_conditions(found: dict[str, dict], values: dict[str, Column], types: dict) -> list[Column]:
    """The conditions of :func:`filter_meanings` over ``values`` (field -> column of its type)."""
    return _conditions(values, types, found["equals"], found["contains"], _ranges(found))


def request_filter(df: DataFrame, spec, filters: dict) -> DataFrame:
    """Apply snapshot request filters by name to a frame of ``spec`` fields.

    Names follow the request convention: ``<Field>Contains`` is a
    case-sensitive substring test, ``From<Field>`` / ``To<Field>`` an inclusive
    range end, any other name equality on the field. A field is found by its
    source key or its field name; ``models.REQUEST_FILTERS`` maps the names
    that depart from that. Blank values mean "no filter" and are skipped
    without a lookup; a non-blank filter that the records can't answer is
    refused with the reason.
    """
    found = filter_meanings(spec, filters)
    return snapshot_filter(df, equals=found["equals"], contains=found["contains"], between=_ranges(found))
