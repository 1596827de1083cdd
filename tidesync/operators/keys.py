"""Key-driven row operators: detail lookup and delete-by-keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


#: Copies of a detail row made from one array.
REPEAT_BLOCK = 4096


def detail_lookup(keys: DataFrame, key_col: str, details: DataFrame, detail_key: str | None = None) -> DataFrame:
    """Detail rows for every key in ``keys``, repeated as often as the key is.

    The key list is not deduplicated by the source system, so a repeated key
    repeats its detail rows. Here the keys are first counted (a partial
    aggregate, so a hot key is one row before the shuffle), joined once, and
    the multiplicity restored by two nested short sequences (no array longer
    than about ``REPEAT_BLOCK`` or ``times / REPEAT_BLOCK``). The join is an
    inner equi-join: AQE broadcasts the key counts when they measure small,
    else sort-merges and splits skewed detail partitions.
    """
    detail_key = detail_key or key_col
    counts = keys.filter(F.col(key_col).isNotNull()).groupBy(F.col(key_col).alias("_lookup_key")).agg(
        F.count(F.lit(1)).alias("_times")
    )
    joined = details.join(counts, details[detail_key] == counts["_lookup_key"], "inner")
    last_block = F.floor((F.col("_times") - 1) / REPEAT_BLOCK)
    blocks = joined.withColumn("_block", F.explode(F.sequence(F.lit(0).cast("long"), last_block)))
    in_block = F.least(F.lit(REPEAT_BLOCK).cast("long"), F.col("_times") - F.col("_block") * REPEAT_BLOCK)
    repeated = blocks.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), in_block)))
    return repeated.drop("_lookup_key", "_times", "_block", "_copy")


def delete_by_keys(target: DataFrame, keys: DataFrame, key_col: str, target_key: str | None = None) -> DataFrame:
    """``DELETE FROM target WHERE key IN (keys)``: rows of ``target`` kept.

    Null keys never match. The key list is deduplicated first (partial
    aggregate), then a left anti join runs.
    """
    target_key = target_key or key_col
    k = keys.select(F.col(key_col).alias("_del_key")).distinct()
    return target.join(k, target[target_key] == k["_del_key"], "left_anti")


def deleted_rows(target: DataFrame, keys: DataFrame, key_col: str, target_key: str | None = None) -> DataFrame:
    """Rows of ``target`` that a delete by ``keys`` removes."""
    target_key = target_key or key_col
    k = keys.select(F.col(key_col).alias("_del_key")).distinct()
    return target.join(k, target[target_key] == k["_del_key"], "left_semi")
