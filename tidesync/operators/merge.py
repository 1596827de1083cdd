"""Upsert by key (MERGE) and its action counts, as one full outer join.

Semantics kept from the warehouse MERGE the source system issues:

* rows match on equality of **all** key columns (AND); ``=`` is not null-safe,
  so a null key never matches;
* a matched row is overwritten in every source column, also with null, and
  also when nothing changed (it still counts as updated);
* an unmatched source row is inserted; an unmatched target row is kept;
* target columns the source does not carry are kept on update and null on
  insert.

Plan shapes (``strategy``): for a source of measured small size the target is
never shuffled (broadcast source, see :func:`merge_rows`); otherwise one
shuffle of each side on the key columns, then a sort-merge full outer join.
Rows whose key has a null can never match; they are split off before the join
(where a key column may be null at all) and added to its result, so they are
not shuffled and cannot pile up in one partition. Each key has at most one row
per side once the source is checked for duplicates, so the join itself cannot
skew. The action column lets counts be taken in the same pass as the write
(``observe``).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidesync.functions.normalize import quote_identifier

ACTION = "_action"
INSERTED, UPDATED, KEPT, UNCHANGED = "inserted", "updated", "kept", "unchanged"


class DuplicateKeyError(Exception):
    """The source holds more than one row for a merge key."""


def has_null_key(df: DataFrame, keys) -> Column | None:
    """Whether a row's key has a null; None if no key column of ``df`` can hold one."""
    nullable = [k for k in keys if df.schema[k].nullable]
    return reduce(lambda a, b: a | b, [F.col(quote_identifier(k)).isNull() for k in nullable]) if nullable else None


def split_null_keys(df: DataFrame, keys) -> tuple[DataFrame, DataFrame | None]:
    """(rows with a whole key, rows whose key has a null or None if there can't be any)."""
    null = has_null_key(df, keys)
    return (df, None) if null is None else (df.where(~null), df.where(null))


def duplicate_keys(source: DataFrame, keys: list[str] | tuple[str, ...]) -> DataFrame:
    """Keys that occur more than once, with their counts (partial aggregation).

    Keys with a null never match anything, so they are no duplicates."""
    return (
        split_null_keys(source, keys)[0].groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("rows"))
        .filter(F.col("rows") > 1)
    )


def check_unique_keys(source: DataFrame, keys) -> None:
    """Raise :class:`DuplicateKeyError` if any key repeats (bounded sample shown)."""
    sample = duplicate_keys(source, keys).limit(5).collect()
    if sample:
        raise DuplicateKeyError(f"duplicate merge keys {list(keys)}: {[r.asDict() for r in sample]}")


def unique_or_raise(source: DataFrame, keys) -> DataFrame:
    """``source``, failing while it runs where a key repeats.

    Checked in the partitions and order the join on ``keys`` needs anyway, so
    it adds no shuffle, no sort and no separate job. Keys must not be null.
    """
    by_key = Window.partitionBy(*keys).orderBy(*keys)
    shown = F.concat_ws(", ", *[F.col(quote_identifier(k)).cast("string") for k in keys])
    failed = F.raise_error(F.concat(F.lit(f"duplicate merge keys {list(keys)}: "), shown)).cast("boolean")
    marked = source.withColumn("_nth", F.row_number().over(by_key))
    return marked.where(F.when(F.col("_nth") > 1, failed).otherwise(F.lit(True))).drop("_nth")


def latest_by_key(source: DataFrame, keys, order_by: list[str] | tuple[str, ...], null_keys: bool = True) -> DataFrame:
    """One row per key: the one with the greatest ``order_by`` values.

    Rows whose key has a null never match each other; every one is kept
    (``null_keys=False`` says that there are none).

    Expressed as ``max(struct(order..., rest...))`` grouped by key, an
    aggregate with a map-side partial step (a sort aggregate where the struct
    holds text), so a key holding a large share of the rows is reduced before
    the shuffle instead of sorted in one task. Ties
    on ``order_by`` are broken by the remaining columns, so the pick is
    deterministic.
    """
    keys = list(keys)
    rest = [c for c in source.columns if c not in keys]
    ordered = list(order_by) + [c for c in rest if c not in order_by]
    packed = F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(ordered)])
    keyed, nulls = split_null_keys(source, keys) if null_keys else (source, None)
    best = keyed.groupBy(*keys).agg(F.max(packed).alias("_best"))
    best = best.select(*keys, *[F.col(f"_best.c{ordered.index(c)}").alias(c) for c in rest]).select(*source.columns)
    return best if nulls is None else best.unionByName(nulls)


def prepare_source(source: DataFrame, keys, on_duplicate: str = "error", order_by=None, null_keys: bool = True) -> DataFrame:
    """Apply the duplicate-key policy: ``error`` (default), ``latest`` or ``allow``."""
    if on_duplicate == "error":
        check_unique_keys(source, keys)
        return source
    if on_duplicate == "latest":
        if not order_by:
            raise ValueError("on_duplicate='latest' needs order_by")
        return latest_by_key(source, keys, order_by, null_keys)
    if on_duplicate == "allow":
        return source
    raise ValueError(f"unknown on_duplicate {on_duplicate!r}")


def align_to(source: DataFrame, target: DataFrame) -> DataFrame:
    """Cast source columns shared with the target to the target's types (ANSI)."""
    return _align(source, target)


def _align(source: DataFrame, target: DataFrame) -> DataFrame:
    """Cast source columns shared with the target to the target's types (ANSI)."""
    ttypes = {f.name: f.dataType for f in target.schema.fields}
    return source.select(
        *[
            (F.col(f"`{c}`").cast(ttypes[c]) if c in ttypes and source.schema[c].dataType != ttypes[c] else F.col(f"`{c}`")).alias(c)
            for c in source.columns
        ]
    )


def _project_merged(
    j: DataFrame, keys, t_cols, s_cols, in_t: Column, in_s: Column, with_action: bool, changed_only: bool = False
) -> DataFrame:
    s_only = [c for c in s_cols if c not in t_cols]
    out = []
    for c in t_cols:
        if c in keys:
            out.append(F.when(in_t, F.col(f"_t_{c}")).otherwise(F.col(f"_s_{c}")).alias(c))
        elif c in s_cols:
            out.append(F.when(in_s, F.col(f"_s_{c}")).otherwise(F.col(f"_t_{c}")).alias(c))
        else:
            out.append(F.col(f"_t_{c}").alias(c))
    for c in s_only:
        out.append(F.col(f"_s_{c}").alias(c))
    if with_action:
        matched = F.lit(UPDATED)
        if changed_only:
            compared = [c for c in s_cols if c in t_cols and c not in keys]
            same = F.lit(True)
            for c in compared:
                same = same & F.col(f"_t_{c}").eqNullSafe(F.col(f"_s_{c}"))
            matched = F.when(same, F.lit(UNCHANGED)).otherwise(F.lit(UPDATED))
        out.append(F.when(in_s & in_t, matched).when(in_s, F.lit(INSERTED)).otherwise(F.lit(KEPT)).alias(ACTION))
    return j.select(*out)


def _key_cond(keys) -> Column:
    cond: Column | None = None
    for k in keys:
        eq = F.col(f"_t_{k}") == F.col(f"_s_{k}")
        cond = eq if cond is None else cond & eq
    return cond


def merge_rows(
    target: DataFrame,
    source: DataFrame,
    keys,
    with_action: bool = True,
    strategy: str = "shuffle",
    changed_only: bool = False,
    on_duplicate: str = "allow",
    null_keys: bool = True,
) -> DataFrame:
    """The table after ``MERGE source INTO target ON keys`` (+ ``_action``).

    A matched row is ``updated`` whether or not its values changed (as the
    warehouse MERGE counts it). ``changed_only`` instead marks matched rows
    whose source columns all equal the target's (null-safe) ``unchanged``;
    the rows written are the same either way.

    ``strategy``:

    * ``"shuffle"`` (default): one full outer join; both sides are shuffled
      on the keys. Right when the source is comparable in size to the target.
    * ``"broadcast"``: for a source of checked, small size. The target is
      never shuffled: its rows go through a left join against the broadcast
      source (updated / kept), its key columns alone through a semi join
      against the broadcast source keys (which keys matched), and the source
      rows without a match (an anti join of two small sides) are inserted.
      The caller must have bounded the source size; see
      :func:`choose_strategy`.

    ``on_duplicate="error"`` fails while the join runs if a source key
    repeats; see :func:`unique_or_raise`. The default trusts the caller.
    ``null_keys=False`` says that keys are never null, or that both sides are
    hashed by them already: they then go through the join whole (the rows that
    come out are the same).
    """
    keys = list(keys)
    if not keys:
        raise ValueError("merge keys must not be empty")
    for k in keys:
        if k not in target.columns or k not in source.columns:
            raise ValueError(f"merge key {k!r} missing from target or source")
    if on_duplicate not in ("allow", "error"):
        raise ValueError(f"unknown on_duplicate {on_duplicate!r}")
    source = _align(source, target)
    t_nulls = s_nulls = None
    if strategy == "shuffle" and null_keys:
        target, t_nulls = split_null_keys(target, keys)
        source, s_nulls = split_null_keys(source, keys)
    if on_duplicate == "error":
        source = unique_or_raise(source, keys)
    t_cols = list(target.columns)
    s_cols = list(source.columns)
    t = target.select(*[F.col(f"`{c}`").alias(f"_t_{c}") for c in t_cols], F.lit(True).alias("_in_t"))
    s = source.select(*[F.col(f"`{c}`").alias(f"_s_{c}") for c in s_cols], F.lit(True).alias("_in_s"))
    in_s, in_t = F.col("_in_s").isNotNull(), F.col("_in_t").isNotNull()

    if strategy == "shuffle":
        j = t.join(s, _key_cond(keys), "full_outer")
        out = _project_merged(j, keys, t_cols, s_cols, in_t, in_s, with_action, changed_only)
        for rows, action in ((t_nulls, KEPT), (s_nulls, INSERTED)):
            if rows is not None:
                missing = [F.lit(None).cast(f.dataType).alias(f.name) for f in out.schema.fields if f.name not in rows.columns and f.name != ACTION]
                rows = rows.select("*", *missing, *([F.lit(action).alias(ACTION)] if with_action else []))
                out = out.unionByName(rows)
        return out
    if strategy != "broadcast":
        raise ValueError(f"unknown merge strategy {strategy!r}")

    # Existing rows: stream the target, probe the broadcast source.
    existing = t.join(F.broadcast(s), _key_cond(keys), "left")
    # Matched keys: key columns of the target only (column-pruned scan).
    t_keys = target.select(*[F.col(f"`{k}`").alias(f"_t_{k}") for k in keys])
    s_keys = source.select(*[F.col(f"`{k}`").alias(f"_s_{k}") for k in keys])
    matched = t_keys.join(F.broadcast(s_keys), _key_cond(keys), "left_semi")
    # New rows: source rows whose key did not match (both sides small).
    new = s.join(matched, _key_cond(keys), "left_anti")
    new = new.select(
        *[F.lit(None).cast(target.schema[c].dataType).alias(f"_t_{c}") for c in t_cols],
        F.lit(None).cast("boolean").alias("_in_t"),
        *[F.col(f"_s_{c}") for c in s_cols],
        F.col("_in_s"),
    )
    j = existing.unionByName(new)
    return _project_merged(j, keys, t_cols, s_cols, in_t, in_s, with_action, changed_only)


def choose_strategy(source_bytes: int, limit_bytes: int, expansion: float = 2.0) -> str:
    """``broadcast`` when the source's measured size is within the limit.

    ``source_bytes`` is the size of its values in memory; ``expansion`` adds
    the hash relation's own share (the rows and, again, their keys are sent).
    """
    return "broadcast" if 0 <= source_bytes * expansion <= limit_bytes else "shuffle"


def action_counts(merged: DataFrame) -> DataFrame:
    """One row: inserted / updated / kept / total rows of a merged frame."""
    a = F.col(ACTION)
    return merged.agg(
        F.count_if(a == INSERTED).alias("inserted_count"),
        F.count_if(a == UPDATED).alias("updated_count"),
        F.count_if(a == KEPT).alias("kept_count"),
        F.count_if(a == UNCHANGED).alias("unchanged_count"),
        F.count(F.lit(1)).alias("total_rows"),
    )


def action_metrics() -> list[Column]:
    """The same counts as aggregate expressions, for ``DataFrame.observe``."""
    a = F.col(ACTION)
    return [
        F.count_if(a == INSERTED).alias("inserted_count"),
        F.count_if(a == UPDATED).alias("updated_count"),
        F.count_if(a == KEPT).alias("kept_count"),
        F.count_if(a == UNCHANGED).alias("unchanged_count"),
        F.count(F.lit(1)).alias("total_rows"),
    ]
