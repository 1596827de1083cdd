"""Column-level cleaning rules, as native Spark expressions.

Every function here takes and returns :class:`pyspark.sql.Column` so the rules
stay inside whole-stage codegen; there is no Python UDF on this path.

Input columns may be typed (STRING, numeric, BOOLEAN, TIMESTAMP) or VARIANT
(landed JSON). For a VARIANT the rule looks at the runtime type of the value
(``schema_of_variant``), so the text ``"5"`` and the number ``5`` stay apart.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values.
ZERO_DATE = "0000-00-00"
# A whole number written as text: optional sign, digits, an optional ".0..."
# tail, surrounding blanks allowed ("12", " 12 ", "12.0"; not "12.7").
INT_TEXT_PATTERN = r"^\s*[+-]?[0-9]+(\.0+)?\s*$"
BOOL_TRUE_TEXT = ("1", "on", "t", "true", "y", "yes")
BOOL_FALSE_TEXT = ("0", "f", "false", "n", "no", "off")


def _null(t: T.DataType) -> Column:
    return F.lit(None).cast(t)


def blank_to_null(c: Column) -> Column:
    """Exactly ``""`` becomes null; ``" "`` is kept."""
    return F.when(c != F.lit(""), c)


def zero_date_to_null(c: Column) -> Column:
    """Any text *containing* ``0000-00-00`` becomes null (not only dates)."""
    return F.when(~c.contains(ZERO_DATE), c)


def clean_text(c: Column, zero_dates: bool = True) -> Column:
    """The record-level rule applied before type checks: blanks, then zero dates."""
    c = blank_to_null(c)
    return zero_date_to_null(c) if zero_dates else c


def is_int_text(c: Column) -> Column:
    return c.rlike(INT_TEXT_PATTERN)


def lax_int_from_text(c: Column) -> Column:
    """Text -> DECIMAL(38,0) when it is a whole number, else null.

    A plain cast would round ``'12.7'`` to 13; the pattern guard rejects it.
    """
    return F.when(is_int_text(c), F.trim(c).try_cast(T.DecimalType(38, 0)))


class Converted:
    """Result of converting one input value: the value and whether it was accepted."""

    def __init__(self, value: Column, ok: Column):
        self.value = value
        self.ok = ok


_WHOLE_KINDS = ("BIGINT", "INT", "SMALLINT", "TINYINT")
_NUMBER_KINDS = ("BIGINT", "INT", "SMALLINT", "TINYINT", "DOUBLE", "FLOAT")
_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FRACTIONAL = (T.FloatType, T.DoubleType, T.DecimalType)
_ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
# Epoch seconds of 0001-01-01 and 9999-12-31 23:59:59.
_MIN_EPOCH_SECONDS = -62135596800
_MAX_EPOCH_SECONDS = 253402300799


def variant_kind_column(c: Column) -> Column:
    """Runtime type name of a VARIANT value: STRING, BIGINT, DECIMAL(p,s), ..."""
    return F.schema_of_variant(c)


def raw_parts(c: Column, dtype: T.DataType, kind_col: Column | None = None) -> dict[str, Column]:
    """Split one input value into typed parts, whatever its column type.

    ``null``: missing / JSON null; ``is_text``: the value is text; ``raw``:
    the text as given; ``num``: DECIMAL(38,10) when a number (null if it has
    more than 28 integer digits); ``whole``: DECIMAL(38,0) when its type has
    no fraction, so with all its digits; ``cents``: DECIMAL(38,2) when a
    number, rounded once; ``bool``; and ``arr`` (ARRAY<STRING>) when a list. For a VARIANT, ``kind_col`` is its
    runtime type name, computed once beforehand.
    """
    parts = _raw_parts(c, dtype, kind_col)
    return {"whole": _null(T.DecimalType(38, 0)), "cents": _null(T.DecimalType(38, 2)), **parts}


def _raw_parts(c: Column, dtype: T.DataType, kind_col: Column | None) -> dict[str, Column]:
    null_t, null_n, null_b = _null(T.StringType()), _null(T.DecimalType(38, 10)), _null(T.BooleanType())
    if isinstance(dtype, T.VariantType):
        k = kind_col if kind_col is not None else variant_kind_column(c)
        is_text = k == F.lit("STRING")
        return {
            "null": c.isNull() | F.coalesce(k.isin("VOID", "NULL"), F.lit(True)),  # a JSON null is a VARIANT of type VOID
            "is_text": F.coalesce(is_text, F.lit(False)),
            "raw": F.when(is_text, F.try_variant_get(c, "$", "string")),
            "num": F.when(k.isin(*_NUMBER_KINDS) | k.startswith("DECIMAL"), F.try_variant_get(c, "$", "decimal(38,10)")),
            "whole": F.when(k.isin(*_WHOLE_KINDS) | k.rlike(r"^DECIMAL\([0-9]+,0\)"), F.try_variant_get(c, "$", "decimal(38,0)")),
            "cents": F.when(k.isin(*_NUMBER_KINDS) | k.startswith("DECIMAL"), F.try_variant_get(c, "$", "decimal(38,2)")),
            "bool": F.when(k == F.lit("BOOLEAN"), F.try_variant_get(c, "$", "boolean")),
            "arr": F.when(k.startswith("ARRAY"), F.try_variant_get(c, "$", "array<string>")),
        }
    if isinstance(dtype, T.StringType):
        return {"null": c.isNull(), "is_text": c.isNotNull(), "raw": c, "num": null_n, "bool": null_b, "arr": _null(T.ArrayType(T.StringType()))}
    if isinstance(dtype, _INTEGRAL + _FRACTIONAL):
        whole = isinstance(dtype, _INTEGRAL) or isinstance(dtype, T.DecimalType) and dtype.scale == 0
        return {
            "null": c.isNull(), "is_text": F.lit(False), "raw": null_t, "num": c.try_cast(T.DecimalType(38, 10)), "bool": null_b,
            "arr": _null(T.ArrayType(T.StringType())), "cents": c.try_cast(T.DecimalType(38, 2)),
            **({"whole": c.try_cast(T.DecimalType(38, 0))} if whole else {}),
        }
    if isinstance(dtype, T.BooleanType):
        return {"null": c.isNull(), "is_text": F.lit(False), "raw": null_t, "num": null_n, "bool": c, "arr": _null(T.ArrayType(T.StringType()))}
    if isinstance(dtype, (T.TimestampNTZType, T.TimestampType, T.DateType)):
        # A typed date arrives as its ISO text, as a datetime would be dumped.
        return {"null": c.isNull(), "is_text": c.isNotNull(), "raw": F.date_format(c, _ISO_MICROS), "num": null_n, "bool": null_b, "arr": _null(T.ArrayType(T.StringType()))}
    if isinstance(dtype, T.ArrayType):
        return {"null": c.isNull(), "is_text": F.lit(False), "raw": null_t, "num": null_n, "bool": null_b, "arr": c.cast(T.ArrayType(T.StringType()))}
    raise TypeError(f"unsupported input type {dtype.simpleString()}")


def declared_value(
    kind: str, text_union: bool, text: Column, num: Column, boolean: Column, arr: Column, whole: Column, cents: Column
) -> Column:
    """The converted value from typed parts (``text`` already cleaned)."""
    if kind == "list":
        return arr
    if kind == "str" and not text_union:
        return text
    if text_union or kind == "datetime":
        # Text stays text; a number is read as an epoch time (seconds, or
        # milliseconds when too large for seconds).
        return F.coalesce(text, F.when(num.isNotNull(), _number_to_timestamp_text(num)))
    if kind == "int":
        from_bool = F.when(boolean, F.lit(1)).when(~boolean, F.lit(0)).cast(T.DecimalType(38, 0))
        return F.coalesce(lax_int_from_text(text), whole, _whole_number(num), from_bool)
    if kind in ("float", "Decimal"):
        target = T.DecimalType(38, 2) if kind == "float" else T.DecimalType(38, 10)
        return F.coalesce(F.trim(text).try_cast(target), cents if kind == "float" else num)
    if kind == "bool":
        low = F.lower(F.trim(text))
        from_text = F.when(low.isin(*BOOL_TRUE_TEXT), F.lit(True)).when(low.isin(*BOOL_FALSE_TEXT), F.lit(False))
        from_num = F.when(num == 1, F.lit(True)).when(num == 0, F.lit(False))
        return F.coalesce(boolean, from_text, from_num)
    raise ValueError(kind)


def accepted(kind: str, text_union: bool, is_null: Column, is_text: Column, text: Column, num: Column, value: Column) -> Column:
    """Whether the input was acceptable, given the converted ``value``.

    A missing value is fine (required-ness is checked separately); text that
    cleaning turned into null is a missing value; otherwise the input is
    accepted exactly when it converted.
    """
    if kind == "str" and not text_union:
        return is_null | is_text
    if text_union:
        # Text is kept as text; the load cast decides later. A number must
        # be a representable epoch time.
        return is_null | is_text | (num.isNotNull() & value.isNotNull())
    if kind == "datetime":
        # A datetime-only field must hold a readable date-time.
        readable = text.try_cast(T.TimestampNTZType()).isNotNull()
        return is_null | (is_text & (text.isNull() | readable)) | (num.isNotNull() & value.isNotNull())
    return is_null | (is_text & text.isNull()) | value.isNotNull()


def convert(c: Column, dtype: T.DataType, declared: tuple[str, ...], zero_dates: bool) -> Converted:
    """Convert one input column to the value of a declared field (one-shot form).

    :func:`tidesync.operators.validate.project_records` applies the same rules
    in stages so that nothing is evaluated twice per row.
    """
    kind = declared[0]
    text_union = set(declared) == {"datetime", "str"}
    p = raw_parts(c, dtype)
    text = clean_text(p["raw"], zero_dates)
    value = declared_value(kind, text_union, text, p["num"], p["bool"], p["arr"], p["whole"], p["cents"])
    return Converted(value, accepted(kind, text_union, p["null"], p["is_text"], text, p["num"], value))


def _whole_number(d: Column) -> Column:
    """DECIMAL(38,10) -> DECIMAL(38,0) when it has no fraction, else null."""
    return F.when(d == F.floor(d), d.cast(T.DecimalType(38, 0)))


def _number_to_timestamp_text(d: Column) -> Column:
    """A number given for a date field: seconds since the epoch, or
    milliseconds when it is too large for seconds; rendered as ISO text."""
    secs = F.when(F.abs(d) > F.lit(20_000_000_000), d / F.lit(1000)).otherwise(d)
    # Epoch time is UTC: add it to 1970-01-01 as a wall-clock (NTZ) value, so
    # the session time zone plays no part. Values outside years 1..9999 give
    # null (the input is then refused), never an overflow error.
    in_range = (secs > F.lit(_MIN_EPOCH_SECONDS)) & (secs < F.lit(_MAX_EPOCH_SECONDS))
    ts = F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'") + F.make_dt_interval(secs=secs.try_cast(T.DecimalType(18, 6)))
    return F.when(in_range, F.date_format(ts, _ISO_MICROS))


def unescape_name(name: str) -> str:
    """Escaped column name -> original: ``__dot__`` -> ``.``, then
    ``underscore____`` -> ``__``."""
    return name.replace("__dot__", ".").replace("underscore____", "__")


# Characters that force an identifier to be quoted.
SPECIAL_IDENTIFIER_CHARS = " &%$#@!*()-+=,/\\?.:;[]{}<>|\"'"


def needs_quoting(name: str) -> bool:
    return any(ch in name for ch in SPECIAL_IDENTIFIER_CHARS)


def quote_identifier(name: str) -> str:
    """Backtick-quote a Spark identifier (doubling embedded backticks)."""
    return "`" + name.replace("`", "``") + "`"


def table_identifier(name: str, override: bool = False) -> str:
    """Table name as written in DDL: a name with a special character is
    quoted and uppercased; with ``override`` it is quoted and keeps its case;
    any other name is used as it is."""
    if override:
        return quote_identifier(name)
    if needs_quoting(name):
        return quote_identifier(name.upper())
    return name


def json_member(json: Column | str, path: str, kind: str = "string") -> Column:
    """The member at ``path`` (``$.a.b[0]``, ``$['odd name']``) of a JSON text column, as ``kind``.

    Null where there is no such member, where the text is no JSON, or where
    the value can't be read as ``kind``: one bad row never fails the run.
    :func:`json_members` takes several members of a text parsed once.
    """
    return F.try_variant_get(F.try_parse_json(F.col(json) if isinstance(json, str) else json), path, kind)


def json_members(df: DataFrame, json_col: str, members: dict[str, tuple[str, str]]) -> DataFrame:
    """``df`` with a column for each of ``members`` (name -> path and type) of a JSON text or VARIANT column, parsed once a row."""
    doc = F.col(f"`{json_col}`")
    if not isinstance(df.schema[json_col].dataType, T.VariantType):
        df, doc = df.withColumn("_json_doc", F.try_parse_json(doc)), F.col("_json_doc")
    return df.withColumns({name: F.try_variant_get(doc, path, kind) for name, (path, kind) in members.items()}).drop("_json_doc")
