"""Field and table specs: the declared shape of every record type.

A record type is declared once, as a list of :class:`FieldSpec`, and every
Spark schema the library needs is derived from it:

* the *landing* schema (source names, every value a ``VARIANT`` so the JSON
  reader keeps the difference between the text ``"5"`` and the number ``5``),
* the *target* schema (snake_case names, warehouse types).

Type resolution follows the declared annotation: for a union only the first
member decides the target type, so ``datetime | str`` lands in a TIMESTAMP
column while ``str | datetime`` stays text.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import types as T

# Declared member type -> target Spark type. These mirror the
# warehouse type map (BOOLEAN, TIMESTAMP, VARCHAR, NUMBER, NUMBER(38,2),
# NUMBER(38,10), ARRAY) and must stay as they are for results to agree.
TYPE_MAP: dict[str, T.DataType] = {
    "bool": T.BooleanType(),
    "datetime": T.TimestampNTZType(),
    "str": T.StringType(),
    "int": T.DecimalType(38, 0),
    "float": T.DecimalType(38, 2),
    "Decimal": T.DecimalType(38, 10),
    "list": T.ArrayType(T.StringType()),
}

_ACRONYM_SPLIT = re.compile(r"([A-Z]+)([A-Z][a-z])")
_CAMEL_SPLIT = re.compile(r"([a-z0-9])([A-Z])")


def snake_name(source: str) -> str:
    """PascalCase source key -> snake_case field name.

    ``PartNumber`` -> ``part_number``, ``MPRVersionId`` -> ``mpr_version_id``,
    ``FulfillmentDate2Nd`` -> ``fulfillment_date_2nd``.
    """
    s = _ACRONYM_SPLIT.sub(r"\1_\2", source)
    s = _CAMEL_SPLIT.sub(r"\1_\2", s)
    return s.lower()


@dataclass(frozen=True)
class FieldSpec:
    """One declared field.

    ``declared`` lists the union members in declaration order, e.g.
    ``("datetime", "str")``; ``required`` fields may not be missing or null.
    """

    source: str
    declared: tuple[str, ...] = ("str",)
    required: bool = False
    name: str = ""

    def __post_init__(self):
        if not self.name:
            object.__setattr__(self, "name", snake_name(self.source))
        for member in self.declared:
            if member not in TYPE_MAP:
                # A type outside the map has no target column; refuse it rather
                # than dropping the column silently.
                raise ValueError(f"{self.source}: unsupported declared type {member!r}")

    @property
    def kind(self) -> str:
        """The member that decides the target type (the first one)."""
        return self.declared[0]

    @property
    def target_type(self) -> T.DataType:
        return TYPE_MAP[self.kind]

    @property
    def is_text_union(self) -> bool:
        """A datetime/str union keeps text input as text during validation."""
        return set(self.declared) == {"datetime", "str"}


@dataclass(frozen=True)
class TableSpec:
    """A record type plus how it is loaded: merge keys and cleaning rules."""

    name: str
    fields: tuple[FieldSpec, ...]
    keys: tuple[str, ...]
    zero_date_to_null: bool = True
    dedup_rows: bool = False
    api: str = "records"
    extra: dict = field(default_factory=dict, compare=False, hash=False)

    def __post_init__(self):
        names = [f.name for f in self.fields]
        if len(set(names)) != len(names):
            raise ValueError(f"{self.name}: duplicate field names")
        missing = [k for k in self.keys if k not in names]
        if missing:
            raise ValueError(f"{self.name}: merge keys not declared: {missing}")
        if not self.keys:
            raise ValueError(f"{self.name}: merge keys must not be empty")

    @property
    def names(self) -> list[str]:
        return [f.name for f in self.fields]

    def field(self, name: str) -> FieldSpec:
        for f in self.fields:
            if f.name == name:
                return f
        raise KeyError(name)

    def target_schema(self) -> T.StructType:
        """Schema of the loaded table (keys never null after validation)."""
        return T.StructType(
            [T.StructField(f.name, f.target_type, f.name not in self.keys) for f in self.fields]
        )

    def record_schema(self, values: str = "variant") -> T.StructType:
        """Schema of one landed record: source names, every value a VARIANT.

        ``values='text'`` reads every value as its JSON text instead: faster
        to parse, but a number can then no longer be told from the same
        digits written as text (so a text field accepts ``5``, and an int
        field refuses ``true``).
        """
        if values not in ("variant", "text"):
            raise ValueError(values)
        vt = T.VariantType() if values == "variant" else T.StringType()
        return T.StructType([T.StructField(f.source, vt, True) for f in self.fields])

    def type_groups(self) -> dict[str, list[str]]:
        """Declared kind -> field names, in declaration order."""
        groups: dict[str, list[str]] = {k: [] for k in TYPE_MAP}
        for f in self.fields:
            groups[f.kind].append(f.name)
        return groups


def envelope_schema(spec: TableSpec, key_field: str | None = None, values: str = "variant") -> T.StructType:
    """Schema of one landed page: ``{Page, Succeed, IsLastPage, Response: [record]}``.

    ``key_field`` names the request key stored next to a detail page (the key
    that fetched it), e.g. ``InventoryReceiptNumber``. ``values="record"`` has
    each record as one VARIANT, with all the fields it came with.
    """
    fields = [
        T.StructField("Page", T.LongType(), True),
        T.StructField("Succeed", T.BooleanType(), True),
        T.StructField("IsLastPage", T.BooleanType(), True),
        T.StructField("Response", T.ArrayType(T.VariantType() if values == "record" else spec.record_schema(values), True), True),
    ]
    if key_field:
        fields.insert(0, T.StructField(key_field, T.StringType(), True))
    return T.StructType(fields)


def ddl(spec: TableSpec, table: str | None = None, override: bool = False) -> str:
    """``CREATE TABLE`` text for the spec (Spark SQL, Parquet-backed).

    The table name follows :func:`tidesync.functions.normalize.table_identifier`.
    """
    from tidesync.functions.normalize import quote_identifier, table_identifier

    cols = ", ".join(f"{quote_identifier(f.name)} {f.target_type.simpleString().upper()}" for f in spec.fields)
    return f"CREATE TABLE IF NOT EXISTS {table_identifier(table or spec.name, override)} ({cols}) USING parquet"


def replace_ddl(spec: TableSpec, table: str | None = None, override: bool = False) -> list[str]:
    """Statements that replace the table, to be run in order (Spark has no REPLACE for Parquet tables)."""
    from tidesync.functions.normalize import table_identifier

    return [f"DROP TABLE IF EXISTS {table_identifier(table or spec.name, override)}", ddl(spec, table, override)]
