"""CSV files whose types differ: one aggregate over text finds, for every column, the type that holds all values.

The files are parsed once, as text, and staged; lines that don't fit the header
(too many or too few fields) go to the bad-row split instead of failing the
read. One aggregate over the staged text then says of each column which types
all its values have, so the result does not depend on which file or line came
first, and no sample can miss the one value that differs. It is a partial
aggregate: one small row a task is shuffled, whatever the number of files.

Types, the first that holds every value: BOOLEAN, INT, BIGINT, DECIMAL(38,0),
DECIMAL(38,s) with the largest scale met, DOUBLE, DATE, TIMESTAMP_NTZ (dates
and times mixed), STRING. Whole numbers with leading zeros are codes and stay
text; so does a column without any value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidesync.session import fresh_dir
from tidesync.sources.files import CORRUPT, SOURCE_FILE

_WHOLE = r"^[+-]?(0|[1-9][0-9]*)$"
_EXACT = r"^[+-]?(0|[1-9][0-9]*)(\.[0-9]+)?$"
_FLOAT = r"^[+-]?(0|[1-9][0-9]*)(\.[0-9]+)?([eE][+-]?[0-9]+)?$|^NaN$|^[+-]?Infinity$"
_DAY = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
_MOMENT = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([ T][0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]{1,6})?)?)?$"


def _facts(c: Column) -> Column:
    """Aggregate over one text column: what holds for all its values."""
    v = F.when(F.trim(c) != "", F.trim(c))
    every = lambda test: F.coalesce(F.bool_and(F.when(v.isNotNull(), test)), F.lit(False))
    return F.struct(
        F.count(v).alias("values"),
        every(F.lower(v).isin("true", "false")).alias("boolean"),
        every(v.rlike(_WHOLE)).alias("whole"),
        every(v.rlike(_EXACT)).alias("exact"),
        every(v.rlike(_FLOAT)).alias("float"),
        every(v.rlike(_DAY) & v.try_cast("date").isNotNull()).alias("day"),
        every(v.rlike(_MOMENT) & v.try_cast("timestamp_ntz").isNotNull()).alias("moment"),
        F.coalesce(F.max(F.length(F.regexp_extract(v, r"^[+-]?([0-9]+)", 1))), F.lit(0)).alias("digits"),
        F.coalesce(F.max(F.length(F.regexp_extract(v, r"\.([0-9]+)$", 1))), F.lit(0)).alias("scale"),
    )


def _type_of(facts) -> T.DataType:
    if not facts["values"]:
        return T.StringType()
    if facts["boolean"]:
        return T.BooleanType()
    if facts["whole"] and facts["digits"] <= 38:
        return T.IntegerType() if facts["digits"] <= 9 else T.LongType() if facts["digits"] <= 18 else T.DecimalType(38, 0)
    if facts["exact"] and facts["digits"] + facts["scale"] <= 38:
        return T.DecimalType(38, facts["scale"])
    if facts["float"]:
        return T.DoubleType()
    if facts["day"]:
        return T.DateType()
    return T.TimestampNTZType() if facts["moment"] else T.StringType()


def column_types(rows: DataFrame, columns: list[str] | None = None) -> T.StructType:
    """The type of each text column of ``rows`` that holds all its values, from one aggregate."""
    names = columns or rows.columns
    found = rows.agg(*[_facts(F.col(f"`{c}`")).alias(f"c{k}") for k, c in enumerate(names)]).first()
    return T.StructType([T.StructField(c, _type_of(found[k]), True) for k, c in enumerate(names)])


def typed(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """``rows`` of text cast to ``schema``; blanks of other types are null, text stays as it is."""
    def value(f: T.StructField) -> Column:
        c = F.col(f"`{f.name}`")
        return c if isinstance(f.dataType, T.StringType) else F.when(F.trim(c) != "", F.trim(c).cast(f.dataType))

    kept = [F.col(f"`{c}`") for c in rows.columns if c not in schema.fieldNames()]
    return rows.select(*[value(f).alias(f.name) for f in schema.fields], *kept)


def read_csv_typed(spark: SparkSession, paths: str | list[str], multi_line: bool = False) -> tuple[DataFrame, DataFrame, T.StructType]:
    """UTF-8 CSV files with a header row -> (rows, bad rows, schema).

    ``rows``: the fields in the types that hold all their values, and
    ``source_file``. ``bad``: ``record`` and ``source_file`` of lines with
    another number of fields. A file whose header differs fails the read, so
    that no value comes under another file's name.
    """
    reader = lambda: spark.read.option("header", True).option("encoding", "UTF-8").option("multiLine", multi_line)
    names = reader().csv(paths).columns  # the header of one file
    schema = T.StructType([T.StructField(c, T.StringType(), True) for c in [*names, CORRUPT]])
    text = reader().schema(schema).option("enforceSchema", False).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).csv(paths)
    staged, text = fresh_dir(spark, "csv-text"), text.withColumn(SOURCE_FILE, F.col("_metadata.file_path"))
    text.write.parquet(staged)
    rows = spark.read.schema(text.schema).parquet(staged)
    good = rows.where(F.col(CORRUPT).isNull()).drop(CORRUPT)
    found = column_types(good, names)
    bad = rows.where(F.col(CORRUPT).isNotNull()).select(F.col(CORRUPT).alias("record"), SOURCE_FILE)
    return typed(good, found), bad, found
