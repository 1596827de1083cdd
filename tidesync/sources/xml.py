"""XML documents of any structure as VARIANT, in one pass.

A declared or inferred schema fits one structure; documents of mixed structure
need none. Each document becomes ``{root: {...}}``: elements by their name,
repeated ones as arrays, attributes with the prefix ``@``, text beside
attributes or elements as ``#text``, namespace prefixes kept in the names, an
empty element as null. Every leaf is the text as written (``007`` stays
``007``), without the white space around it. Members are then read by path with
:func:`xml_text`, for example ``$.order.line[0]['@sku']``.

Nothing is inferred and no file is read twice: it is one projection, and broken
documents are told apart in it. A document is broken if it is not well-formed,
has no single root element, or needs entities that a document type declares
(the declaration itself is skipped).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidesync.session import fresh_dir
from tidesync.sources.files import CORRUPT, SOURCE_FILE, xml_options

# A VARIANT made of XML holds numbers for text that looks like one; this mark,
# a code point that is no character, in front of every text keeps it as it is.
_MARK = "\ufdd0"
_PROLOG = r"^\uFEFF?\s*(<\?xml[^>]*\?>)?(?:\s++|<!--(?s:.*?)-->)*+(<!DOCTYPE[^\[>]*(\[[^\]]*\])?\s*>)?"
_WRAP = "tidesync_document"


def _marked(xml: Column) -> Column:
    body = F.regexp_replace(F.translate(xml, _MARK, ""), _PROLOG, "")
    body = F.regexp_replace(body, r"(<!\[CDATA\[|>)(\s*)(?=[^\s<])", "$1$2" + _MARK)  # text of elements
    return F.regexp_replace(body, r"(=\s*[\"'])", "$1" + _MARK)  # and of attributes


def parse_xml_variant(df: DataFrame, text_col: str, doc_col: str = "doc") -> DataFrame:
    """``df`` with one XML document per row of ``text_col`` parsed into VARIANT ``doc_col`` (null if broken), ``broken`` and ``empty``.

    Null and blank documents are ``empty`` and not broken.
    """
    wrapped = F.concat(F.lit(f"<r><{_WRAP}>"), _marked(F.col(text_col)), F.lit(f"</{_WRAP}></r>"))
    schema = f"{_WRAP} VARIANT, {CORRUPT} STRING"
    found = df.withColumn("_parsed", F.from_xml(wrapped, schema, xml_options()))
    json = F.translate(F.to_json(F.col(f"_parsed.{_WRAP}")), _MARK, "")
    found = found.withColumns({"_json": json, "empty": F.coalesce(F.trim(F.col(text_col), F.lit(" \t\r\n")) == "", F.lit(True))})
    roots = F.json_object_keys("_json")
    whole = F.col(f"_parsed.{CORRUPT}").isNull() & (F.size(roots) == 1) & (roots[0] != "#text")
    found = found.withColumn("broken", ~F.col("empty") & ~F.coalesce(whole, F.lit(False)))
    doc = F.when(~F.col("broken") & ~F.col("empty"), F.parse_json("_json"))
    return found.withColumn(doc_col, doc).drop("_parsed", "_json")


def xml_text(doc: Column | str, path: str) -> Column:
    """Text at ``path`` of a document of :func:`parse_xml_variant`; null where there is none (an object or array gives its JSON)."""
    return F.try_variant_get(doc, path, "string")


def xml_root(doc: Column | str) -> Column:
    """Name of a document's root element."""
    return F.json_object_keys(F.to_json(F.col(doc) if isinstance(doc, str) else doc))[0]


def _halves(parsed: DataFrame, label: str) -> tuple[DataFrame, DataFrame]:
    """(loaded, broken) of parsed documents, both read from one copy in the shared work folder."""
    spark = parsed.sparkSession
    staged = fresh_dir(spark, label)
    parsed = parsed.where("NOT empty").select(SOURCE_FILE, "doc", F.when(F.col("broken"), F.col("value")).alias("text"))
    parsed.write.parquet(staged)
    rows = spark.read.schema(parsed.schema).parquet(staged)
    return rows.where("text IS NULL").select(SOURCE_FILE, "doc"), rows.where("text IS NOT NULL").select(SOURCE_FILE, "text")


def read_xml_variants(spark: SparkSession, path: str | list[str], per_line: bool = False) -> tuple[DataFrame, DataFrame]:
    """XML documents of any structure -> (loaded, broken), each read and parsed once.

    One document a file, or one a line with ``per_line`` (files are then split
    over tasks, and a million small documents are no million small files).
    ``loaded``: (source_file, doc); ``broken``: (source_file, text). Empty
    documents are in neither. Both halves read one copy in the shared work
    folder, so nothing is parsed again.
    """
    raw = spark.read.text(path, wholetext=not per_line).withColumn(SOURCE_FILE, F.col("_metadata.file_path"))
    return _halves(parse_xml_variant(raw, "value"), "xml-variants")


def read_xml_record_variants(spark: SparkSession, path: str | list[str], row_tag: str) -> tuple[DataFrame, DataFrame]:
    """Many ``row_tag`` elements a file, one row each -> (loaded, broken) as :func:`read_xml_variants`.

    The files are cut at the end tags while they are read, so a large file is
    split over tasks and no more than a record is held. Each record is parsed
    by itself: one that is not well-formed costs no other (Spark's XML source
    gives up the rest of the file). What stands between records, the root
    element among it, is skipped; prefixes must be declared in the record.
    Records are not nested in each other, not self-closing, and hold no end
    tag of theirs as text. A last record without an end is broken.
    """
    end, start = f"</{row_tag}>", rf"(?s)<{row_tag}(?=[\s>]).*"
    raw = spark.read.text(path, lineSep=end).withColumn(SOURCE_FILE, F.col("_metadata.file_path"))
    # What follows the last end tag of a file is a record only if it begins one; without an end it can't be parsed.
    pieces = raw.select(SOURCE_FILE, F.regexp_extract("value", start, 0).alias("piece")).where("piece <> ''")
    records = pieces.select(SOURCE_FILE, F.concat("piece", F.lit(end)).alias("value"))
    return _halves(parse_xml_variant(records, "value"), "xml-record-variants")
