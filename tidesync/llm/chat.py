"""Chat formatting: cumulative snapshots collapse into maximal conversations, which are rendered.

Chat logs often store a conversation again after every turn, so shorter logged
conversations are prefixes of longer ones. Every turn gets the hash of its
place, role and text; the running sums of two such hashes along a conversation
identify each of its turn prefixes (sums of 64-bit hashes in decimals, so
nothing overflows). A conversation whose whole hash is a proper prefix hash of
another one goes, by an anti-join; of equal conversations the least id stays.

Running sums go by blocks of ``BLOCK`` turns, then over the sums of the blocks,
so a conversation that holds a third of all turns is spread over tasks. Both
sides of the anti-join are made distinct first: thousands of copies of one
conversation meet as one row.

A turn's place is its rank by turn number; a missing number counts as least,
ties are ordered by role, then text. Defined cases: a null role renders as
``unknown`` and a null text as empty, and both compare as what they render;
repeated rows (equal in id, turn, role and text) are one turn; rows with a null
conversation id belong to no conversation and go; an empty table gives an empty
table; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import land, table

#: Turn numbers of a block.
BLOCK = 1024


def turns(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text (nulls replaced), each once, and its block of turn numbers."""
    plain = rows.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("unknown")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    ).distinct()
    return plain.withColumn("block", F.floor(F.coalesce(F.col("turn"), F.lit(-(1 << 62))) / BLOCK))


def prefixes(said: DataFrame) -> DataFrame:
    """conv_id, n (turns up to here), h1, h2 (hash sums of this prefix) and total (turns of the conversation)."""
    small = said.select("conv_id", "block", "turn", F.xxhash64("role").alias("role"), F.xxhash64("text").alias("h"), F.xxhash64(F.lit(1), "text").alias("g"), F.col("role").alias("by"), "text")
    sizes = small.groupBy("conv_id", "block").agg(F.count("*").alias("size"))
    in_order = Window.partitionBy("conv_id").orderBy("block")
    starts = sizes.select("conv_id", "block", (F.sum("size").over(in_order) - F.col("size")).alias("before"), F.sum("size").over(Window.partitionBy("conv_id")).alias("total"))
    within = Window.partitionBy("conv_id", "block").orderBy(F.col("turn").asc_nulls_first(), "by", "text")
    placed = small.withColumn("at", F.row_number().over(within)).join(starts, ["conv_id", "block"])
    hashed = placed.select(
        "conv_id", "block", "total", (F.col("before") + F.col("at")).alias("n"),
        *[F.xxhash64(F.lit(seed), F.col("before") + F.col("at"), "role", "h", "g").cast("decimal(20,0)").alias(name) for seed, name in ((11, "a"), (23, "b"))],
    )
    hashed = land(hashed, "chat-turns")
    sums = hashed.groupBy("conv_id", "block").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    so_far = sums.select("conv_id", "block", *[(F.sum(c).over(in_order) - F.col(c)).alias(f"{c}0") for c in "ab"])
    running = Window.partitionBy("conv_id", "block").orderBy("n")
    local = hashed.select("conv_id", "block", "n", "total", *[F.sum(c).over(running).alias(c) for c in "ab"])
    return local.join(so_far, ["conv_id", "block"]).select(
        "conv_id", "n", "total", *[(F.col(c) + F.col(f"{c}0")).cast("decimal(38,0)").alias(h) for c, h in (("a", "h1"), ("b", "h2"))]
    )


def maximal(rows: DataFrame) -> DataFrame:
    """(conv_id, n_turns, n_same) of the conversations that no longer one continues; the least id of equal ones."""
    found = land(prefixes(turns(rows)), "chat-prefixes")
    ends = found.where("n = total").groupBy("n", "h1", "h2").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_same"))
    inner = found.where("n < total").select("n", "h1", "h2").distinct()
    return ends.join(inner, ["n", "h1", "h2"], "left_anti").select("conv_id", F.col("n").alias("n_turns"), "n_same")


def rendered_turn(role: Column, text: Column) -> Column:
    return F.concat(F.lit("<|im_start|>"), role, F.lit("\n"), text, F.lit("<|im_end|>\n"))


def render(rows: DataFrame) -> DataFrame:
    """conv_id, n_turns, n_same and rendered text of the maximal conversations (one row each, as training takes them)."""
    kept = land(maximal(rows), "chat-kept")
    said = turns(rows).join(kept.select("conv_id"), "conv_id", "left_semi")
    ordered = F.sort_array(F.collect_list(F.struct("turn", "role", "text")))
    texts = said.groupBy("conv_id").agg(F.array_join(F.transform(ordered, lambda t: rendered_turn(t["role"], t["text"])), "").alias("rendered"))
    return texts.join(kept, "conv_id").select("conv_id", F.col("n_turns").cast("long").alias("n_turns"), "n_same", "rendered")


def op6_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every maximal conversation, rendered."""
    return render(table(spark, sf_dir, "conversations"))


ORACLE_SQL = """
WITH said AS (
  SELECT DISTINCT conv_id, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL
), whole AS (
  SELECT conv_id, count(*) AS n_turns,
         list(role || chr(0) || text ORDER BY turn NULLS FIRST, role, text) AS parts,
         string_agg('<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS rendered
  FROM said GROUP BY conv_id
), distinct_ones AS (
  SELECT min(conv_id) AS conv_id, any_value(n_turns) AS n_turns, count(*) AS n_same, parts, any_value(rendered) AS rendered
  FROM whole GROUP BY parts
)
SELECT a.conv_id, a.n_turns, a.n_same, a.rendered
FROM distinct_ones a
WHERE NOT EXISTS (
  SELECT 1 FROM distinct_ones b
  WHERE b.parts[1] = a.parts[1] AND b.n_turns > a.n_turns AND b.parts[1:a.n_turns] = a.parts)
"""
