"""File sources: CSV sets, Parquet, XML documents, and file listings.

Every reader is a Spark file scan, so files are split over executors and the
schema, filters and column selection reach the reader. Provenance (the file a
row came from) comes from the hidden ``_metadata`` column, at no extra cost.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SOURCE_FILE = "source_file"
CORRUPT = "_corrupt_record"


def base_name(path_col) -> "F.Column":
    """Last path segment of a file path (``a/b/c.csv`` -> ``c.csv``)."""
    c = F.col(path_col) if isinstance(path_col, str) else path_col
    return F.element_at(F.split(c, "/"), -1)


def read_csv_files(
    spark: SparkSession,
    paths: str | list[str],
    schema: T.StructType | str | None = None,
    with_source: bool = True,
    sampling_ratio: float = 1.0,
    multi_line: bool = False,
) -> DataFrame:
    """UTF-8 CSV files with a header row -> one frame, each row tagged with its file.

    Types are inferred when no ``schema`` is given (an extra pass over the
    data; ``sampling_ratio`` bounds it). ``FAILFAST`` makes any malformed file
    fail the read, as one bad file fails the batch in the source system. So
    does a file whose header has other names, or the same in another order,
    than the schema: values are never put under another file's names.
    ``multi_line`` reads quoted line breaks (such files are then not split).
    """
    reader = spark.read.option("header", True).option("encoding", "UTF-8").option("mode", "FAILFAST")
    reader = reader.option("enforceSchema", False).option("multiLine", multi_line)
    if schema is not None:
        reader = reader.schema(schema)
    else:
        reader = reader.option("inferSchema", True).option("samplingRatio", sampling_ratio)
    df = reader.csv(paths)
    if with_source:
        df = df.withColumn(SOURCE_FILE, F.col("_metadata.file_path"))
    return df


def read_parquet(spark: SparkSession, paths: str | list[str], with_source: bool = False) -> DataFrame:
    """Self-described Parquet (schema from the files)."""
    df = spark.read.parquet(*([paths] if isinstance(paths, str) else paths))
    if with_source:
        df = df.withColumn(SOURCE_FILE, F.col("_metadata.file_path"))
    return df


def list_files(spark: SparkSession, path: str, glob: str | None = None, recursive: bool = True) -> DataFrame:
    """``(path, name, length, modificationTime)`` of the files under ``path``.

    The ``content`` column of the binary-file source is never selected, so no
    file body is read; directory placeholders do not appear.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", recursive)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path).select("path", base_name("path").alias("name"), "length", "modificationTime")


def xml_options(attribute_prefix: str = "@", value_tag: str = "#text") -> dict:
    return {
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": CORRUPT,
        "attributePrefix": attribute_prefix,
        "valueTag": value_tag,
    }


def parse_xml_column(df: DataFrame, text_col: str, schema: T.StructType, options: dict | None = None) -> DataFrame:
    """Parse one XML document per row of ``text_col`` into ``doc`` (+ ``broken``).

    Leaf values should be declared STRING to keep the text as written; a
    document that is not well-formed leaves ``doc`` fields null and sets
    ``broken``. Empty documents are marked ``empty``.
    """
    full = T.StructType(list(schema.fields) + [T.StructField(CORRUPT, T.StringType(), True)])
    parsed = df.withColumn("doc", F.from_xml(F.col(text_col), full, options or xml_options()))
    return parsed.withColumns(
        {
            "broken": F.col(f"doc.{CORRUPT}").isNotNull(),
            "empty": F.trim(F.col(text_col)) == F.lit(""),
        }
    )


def infer_xml_schema(spark: SparkSession, path: str, row_tag: str, sampling_ratio: float = 1.0) -> T.StructType:
    """Infer the nested structure of XML documents whose root is ``row_tag``.

    Uses Spark's XML source (one pass over the sampled files) with
    ``inferSchema`` off, so every leaf stays text as written; attributes get
    the ``@`` prefix, mixed text the ``#text`` tag, namespace prefixes stay
    part of the names. Broken documents do not contribute.
    """
    reader = (
        spark.read.format("xml")
        .option("rowTag", row_tag)
        .option("inferSchema", False)
        .option("attributePrefix", "@")
        .option("valueTag", "#text")
        .option("samplingRatio", sampling_ratio)
        .option("mode", "DROPMALFORMED")
    )
    schema = reader.load(path).schema
    return T.StructType([f for f in schema.fields if f.name != CORRUPT])


def read_xml_documents(
    spark: SparkSession, path: str, schema: T.StructType | None = None, options: dict | None = None, row_tag: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """One XML document per file -> (loaded, broken).

    ``loaded``: ``(source_file, doc)`` for parsed, non-empty documents.
    ``broken``: ``(source_file)`` of files that failed to parse; it is always
    returned, even when nothing loaded. Without a ``schema`` it is inferred
    from the documents (``row_tag`` names their root element).
    """
    if schema is None:
        if not row_tag:
            raise ValueError("give a schema, or the root element name to infer one")
        schema = infer_xml_schema(spark, path, row_tag)
    raw = spark.read.text(path, wholetext=True).withColumn(SOURCE_FILE, F.col("_metadata.file_path"))
    parsed = parse_xml_column(raw, "value", schema, options)
    loaded = parsed.filter(~F.col("broken") & ~F.col("empty")).select(SOURCE_FILE, F.col("doc").dropFields(CORRUPT).alias("doc"))
    broken = parsed.filter(F.col("broken") & ~F.col("empty")).select(SOURCE_FILE)
    return loaded, broken


def read_xml_records(
    spark: SparkSession, path: str, row_tag: str, schema: T.StructType | None = None
) -> tuple[DataFrame, DataFrame]:
    """Many records per XML file, one row per ``row_tag`` element -> (loaded, broken).

    For large files holding many records: Spark's XML source splits them
    into records across tasks (a whole-file read would put one file in one
    row). Leaves stay text unless a schema says otherwise; malformed records
    land in ``broken`` with the file they came from. The parsed records are
    written once to the shared work folder and both halves read that copy.
    """
    if schema is None:
        schema = infer_xml_schema(spark, path, row_tag)
    full = T.StructType(list(schema.fields) + [T.StructField(CORRUPT, T.StringType(), True)])
    rows = (
        spark.read.format("xml")
        .option("rowTag", row_tag)
        .options(**xml_options())
        .schema(full)
        .load(path)
        .withColumn(SOURCE_FILE, F.col("_metadata.file_path"))
    )
    # Spark refuses queries on a raw file scan whose only data column is the
    # corrupt-record column (e.g. counting the good rows). The parsed records
    # are therefore written once to the shared work folder, as Spark advises;
    # both halves read that copy, which also cuts the lineage to the XML.
    from tidesync.session import fresh_dir

    staged_path = fresh_dir(spark, "xml-records")
    rows.write.parquet(staged_path)
    parsed = spark.read.parquet(staged_path)
    loaded = parsed.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)
    broken = parsed.filter(F.col(CORRUPT).isNotNull()).select(SOURCE_FILE, F.col(CORRUPT).alias("record"))
    return loaded, broken
