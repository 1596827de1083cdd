"""SQL text -> DataFrame with every value as nullable text, over views and loaded tables.

The source system runs SQL in a named database and returns every value as a
string. Here the query runs on the session catalog (tables or temp views that
the caller registers); all columns are cast to STRING after the query, so the
query itself still gets Catalyst's pushdown and pruning. A failing query
raises Spark's analysis or runtime error with its reason.
"""

from __future__ import annotations

from contextlib import contextmanager
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def register_views(views: dict[str, DataFrame]) -> None:
    for name, df in views.items():
        df.createOrReplaceTempView(name)


@contextmanager
def _database(spark: SparkSession, database: str | None) -> Iterator[None]:
    previous = spark.catalog.currentDatabase() if database else None
    if database:
        spark.catalog.setCurrentDatabase(database)
    try:
        yield
    finally:
        if previous:
            spark.catalog.setCurrentDatabase(previous)


@contextmanager
def loaded_tables(spark: SparkSession, warehouse: str | None, versions: dict[str, int] | None = None) -> Iterator[list[str]]:
    """Within it, the loaded tables under ``warehouse`` are temporary views by their names; yields these.

    A view is the table's newest complete commit as of entering (or the version
    that ``versions`` names); a query analysed inside keeps reading that one,
    whatever is loaded later. A name that is a temporary view already is
    refused rather than replaced. The views are gone afterwards.
    """
    from tidesync.plans.tables import VersionedTable
    from tidesync.session import list_dirs

    made: list[str] = []
    folders = list_dirs(spark, warehouse.rstrip("/")) if warehouse else []
    taken = {t.name for t in spark.catalog.listTables() if t.isTemporary} if folders else set()
    try:
        for name in sorted(folder.rstrip("/").rsplit("/", 1)[1] for folder in folders):
            table = VersionedTable(spark, f"{warehouse.rstrip('/')}/{name}")
            if name.startswith("_") or not table.exists():
                continue
            if name.lower() in taken:
                raise ValueError(f"{name} is a temporary view already")
            table.read((versions or {}).get(name)).createTempView(f"`{name}`")
            made.append(name)
        yield made
    finally:
        for name in made:
            spark.catalog.dropTempView(name)


def sql_to_strings(
    spark: SparkSession, query: str, views: dict[str, DataFrame] | None = None, database: str | None = None,
    args: dict | list | None = None, warehouse: str | None = None,
) -> DataFrame:
    """Run ``query`` and return every column as STRING (nullable).

    ``args`` are the values of its parameter markers (``:name`` or ``?``); they
    are never part of the text, so a quote in a value is just a quote.
    ``warehouse`` makes every loaded table there a name that the query can use
    (see :func:`loaded_tables`). ``database`` names the database unqualified tables resolve in; the
    session's current database is restored once the query is analysed.
    """
    if views:
        register_views(views)
    with loaded_tables(spark, warehouse), _database(spark, database):
        df = spark.sql(query, args=args)
    return df.select(*[F.col(f"`{f.name}`").cast(T.StringType()).alias(f.name) for f in df.schema.fields])
