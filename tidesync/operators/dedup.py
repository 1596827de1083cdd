"""Snapshot union and duplicate handling.

All dedup here is an aggregation keyed on the compared columns. Spark runs it
as a partial (map-side) hash aggregate before the shuffle, so identical rows
are collapsed where they are read and a hot group never reaches one task whole.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def union_snapshots(*frames: DataFrame, allow_missing: bool = False) -> DataFrame:
    """Bag union by column name (no dedup): the active and depleted snapshots."""
    if not frames:
        raise ValueError("nothing to union")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), frames)


def full_dedup(df: DataFrame) -> DataFrame:
    """Whole-row dedup; nulls compare equal."""
    return df.dropDuplicates()


def row_digest(df: DataFrame) -> list[Column]:
    """128 bits of every row, equal for rows that grouping holds equal (0.0 and -0.0, all NaN)."""
    same = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.FloatType, T.DoubleType)):
            c = F.when(F.isnan(c), F.lit(float("nan"))).when(c == 0, F.lit(0.0)).otherwise(c)
        same.append(c)
    return [F.xxhash64(*same), F.xxhash64(F.lit(1), *same)]


def _digestible(t: T.DataType, top: bool = True) -> bool:
    """Whether equal values of ``t`` surely have equal digests (plain collation, no floats inside others)."""
    if isinstance(t, T.StructType):
        return all(_digestible(f.dataType, False) for f in t.fields)
    if isinstance(t, T.ArrayType):
        return _digestible(t.elementType, False)
    if isinstance(t, (T.FloatType, T.DoubleType)):
        return top
    if isinstance(t, T.StringType):
        return t == T.StringType()
    return not isinstance(t, (T.MapType, T.VariantType))


def digest_dedup(df: DataFrame) -> DataFrame:
    """Whole-row dedup that moves wide rows only where their digest repeats.

    Digests (16 bytes) are counted first. Rows whose digest is alone are
    distinct and stay where they were read; the others are compared in full,
    so rows that share a digest by chance both stay. ``df`` is read twice: give
    a scan or a written copy, not a costly plan. Where more digests repeat than
    can be broadcast, rows are shuffled once, by digest, and compared there.
    """
    if not df.columns or not all(_digestible(f.dataType) for f in df.schema.fields):
        return full_dedup(df)
    names = df.columns
    plain = df.toDF(*[f"c{k}" for k in range(len(names))])
    marked = plain.withColumns(dict(zip(("_d1", "_d2"), row_digest(plain), strict=True)))
    again = marked.groupBy("_d1", "_d2").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(F.col("_d1").alias("_r1"), F.col("_d2").alias("_r2"))
    same = (marked["_d1"] == again["_r1"]) & (marked["_d2"] == again["_r2"])
    alone = marked.join(again, same, "left_anti")
    equal = marked.join(again, same, "left_semi").dropDuplicates()
    return alone.unionByName(equal).drop("_d1", "_d2").toDF(*names)


def duplicate_count(df: DataFrame) -> DataFrame:
    """One row: rows beyond the first of each identical group (nulls equal)."""
    groups = df.groupBy(*[F.col(f"`{c}`") for c in df.columns]).agg(F.count(F.lit(1)).alias("_n"))
    return groups.agg(
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("long").alias("duplicate_rows"),
        F.count(F.lit(1)).cast("long").alias("distinct_rows"),
    )


def _comparable(c: str, dtype: T.DataType):
    """A grouping expression for any column type.

    Map columns cannot be grouped; they are compared as their entries sorted
    by key, which makes two maps with the same pairs equal.
    """
    col = F.col(f"`{c}`")
    if isinstance(dtype, T.MapType):
        return F.array_sort(F.map_entries(col))
    return col


def dedup_except(df: DataFrame, ignore: list[str] | tuple[str, ...] = ("mapped_fields",), keep_first_by: list[str] | None = None) -> DataFrame:
    """Dedup comparing all columns but ``ignore``; nested values allowed.

    From each group the row with the least ``keep_first_by`` values is kept
    (ties broken by the other columns), via ``min(struct(...))`` so the pick
    is a partial aggregate. Without ``keep_first_by`` the least row of the
    ignored columns is kept, which is deterministic too.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    compare = [c for c in df.columns if c not in ignore]
    rest = [c for c in df.columns if c not in compare]
    if not rest:
        return df.dropDuplicates()
    order = list(keep_first_by or []) + [c for c in rest if c not in (keep_first_by or [])]
    if any(isinstance(types[c], T.MapType) for c in order):
        raise TypeError("map columns cannot order the kept row; pass keep_first_by")
    keyed = df.select(
        *[_comparable(c, types[c]).alias(f"_k{i}") for i, c in enumerate(compare)],
        *[F.col(f"`{c}`").alias(f"_v_{c}") for c in compare if isinstance(types[c], T.MapType)],
        F.struct(*[F.col(f"`{c}`").alias(f"o{i}") for i, c in enumerate(order)]).alias("_pick"),
    )
    kcols = [f"_k{i}" for i in range(len(compare))]
    map_vals = [F.first(f"_v_{c}").alias(f"_v_{c}") for c in compare if isinstance(types[c], T.MapType)]
    best = keyed.groupBy(*kcols).agg(F.min("_pick").alias("_pick"), *map_vals)
    out = []
    for i, c in enumerate(df.columns):
        if c in compare:
            j = compare.index(c)
            out.append((F.col(f"_v_{c}") if isinstance(types[c], T.MapType) else F.col(f"_k{j}")).alias(c))
        else:
            out.append(F.col(f"_pick.o{order.index(c)}").alias(c))
    return best.select(*out)
