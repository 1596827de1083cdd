"""Fill-in-middle transformation: two cuts between units, found by one match that keeps every repetition.

A text is cut into units (runs of ASCII letters, or one other character). One
``fullmatch`` of ``(unit)*`` by the ``regex`` library retains all captures of
the group; ``ends(1)`` is then the list of places where a unit ends, so its
length is the number of units and two look-ups give both cuts. The quantifiers
are possessive: nothing is tried again, and time is in proportion to the text.
Everything else (hashes, forms, putting together, taking apart) is expressions.

Where the cuts are depends on the document's id alone: the first four 8-digit
groups of the hash of ``1:`` and the id choose both cuts, whether the text is
transformed at all, and in which of two forms.

Narrow, no shuffle. A Python worker holds one Arrow batch of texts and the
captures of one text: about 60 bytes a unit.

Defined cases: null text counts as empty; an empty text, and one that holds a
sentinel itself, stays plain with no cuts; a null id is hashed as no digits;
repeated rows each keep a row; an empty table gives an empty table; extra
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import identified, ship, table

#: One unit of a text, without groups of its own; possessive, so that no repetition is tried again.
UNIT = r"[A-Za-z]++|[^A-Za-z]"
#: Sentinels before prefix, suffix and middle.
SENTINELS = ("<P>", "<S>", "<M>")
#: Percent of texts that are transformed, and percent of those that have the suffix first.
RATE, SUFFIX_FIRST = 90, 20


def ends_of(text: str, unit: str = UNIT) -> list[int]:
    """Where each unit of ``text`` ends."""
    import regex

    match = regex.fullmatch(f"({unit})*+", text)
    if match is None:
        raise ValueError("the units don't cover the text")
    return match.ends(1)


def cuts(text: Column, first: Column, second: Column, unit: str = UNIT) -> Column:
    """Struct of the number of units ``n`` and the code points up to both cuts, ``low`` and ``high``."""

    @F.arrow_udf("struct<n:long,low:long,high:long>")
    def cut(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, ones, twos in batches:
            found = np.zeros((3, len(texts)), np.int64)
            for k, (text, one, two) in enumerate(zip(texts, ones.to_pylist(), twos.to_pylist(), strict=True)):
                ends = ends_of(text.as_py(), unit)
                n = len(ends)
                low, high = sorted((one % (n + 1), two % (n + 1)))
                found[:, k] = n, ends[low - 1] if low else 0, ends[high - 1] if high else 0
            yield pa.StructArray.from_arrays([pa.array(x) for x in found], ["n", "low", "high"])

    return cut(text, first, second)


def rebuilt(output: Column, form: Column, sentinels: tuple[str, str, str] = SENTINELS) -> Column:
    """The text that ``output`` was made of."""
    pieces = F.split(output, "|".join("\\Q" + s + "\\E" for s in sentinels), -1)
    order = lambda *at: F.concat(*[pieces[k] for k in at])
    return F.when(form == "psm", order(1, 3, 2)).when(form == "spm", order(2, 3, 1)).otherwise(output)


def fill_in_middle(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", unit: str = UNIT, sentinels: tuple[str, str, str] = SENTINELS,
    rate: int = RATE, suffix_first: int = SUFFIX_FIRST,
) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, output and restored (the text rebuilt from output and form) of every row.

    The sentinels have to differ, start with a character that none of them has
    elsewhere, and hold no unit of another's; so they are found again.
    """
    ship(docs.sparkSession)
    digest = F.sha2(F.concat(F.lit("1:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    rows = identified(docs, id_col, text_col).withColumn("digest", digest)
    rows = rows.select("doc_id", "text", *[F.conv(F.substring("digest", 8 * k + 1, 8), 16, 10).cast("long").alias(f"h{k + 1}") for k in range(4)])
    rows = rows.withColumn("cut", cuts(F.col("text"), F.col("h1"), F.col("h2"), unit))
    held = reduce(lambda a, b: a | b, [F.contains("text", F.lit(s)) for s in sentinels])
    plain = (F.col("text") == "") | held | (F.col("h3") % 100 >= rate)
    form = F.when(plain, F.lit("plain")).when(F.col("h4") % 100 < suffix_first, F.lit("spm")).otherwise(F.lit("psm"))
    low, high = F.col("cut.low").cast("int"), F.col("cut.high").cast("int")
    rows = rows.select("doc_id", "text", F.col("cut.n").alias("n"), form.alias("form"), low.alias("low"), (high - low).alias("between"))
    prefix, middle = F.substring("text", F.lit(1), F.col("low")), F.substring("text", F.col("low") + 1, F.col("between"))
    suffix = F.substring("text", F.col("low") + F.col("between") + 1, F.length("text"))
    p, s, m = map(F.lit, sentinels)
    output = F.when(F.col("form") == "psm", F.concat(p, prefix, s, suffix, m, middle)).when(F.col("form") == "spm", F.concat(s, suffix, p, prefix, m, middle)).otherwise(F.col("text"))
    chars = lambda c: F.when(F.col("form") != "plain", F.col(c).cast("long"))
    rows = rows.select("doc_id", "n", "form", chars("low").alias("prefix_chars"), chars("between").alias("middle_chars"), output.alias("output"))
    return rows.withColumn("restored", rebuilt(F.col("output"), F.col("form"), sentinels))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cuts, form and digests of every document."""
    made = fill_in_middle(table(spark, sf_dir, "documents"))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2("restored", 256).alias("restored_sha256"))


ORACLE_SQL = r"""
WITH units AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS unit,
         sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS digest
  FROM documents
), drawn AS (
  SELECT doc_id, text, unit, len(unit) AS n,
         [CAST('0x' || substr(digest, 8 * k + 1, 8) AS BIGINT) FOR k IN [0, 1, 2, 3]] AS h
  FROM units
), placed AS (
  SELECT *, least(h[1] % (n + 1), h[2] % (n + 1)) AS low, greatest(h[1] % (n + 1), h[2] % (n + 1)) AS high,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h[3] % 100 >= 90 THEN 'plain'
              WHEN h[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM drawn
), pieces AS (
  SELECT *, array_to_string(unit[1:low], '') AS prefix, array_to_string(unit[low + 1:high], '') AS middle, array_to_string(unit[high + 1:], '') AS suffix
  FROM placed
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        WHEN 'spm' THEN '<S>' || suffix || '<P>' || prefix || '<M>' || middle ELSE text END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM pieces
"""
