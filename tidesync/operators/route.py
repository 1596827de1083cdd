"""Database routing: decide the target database of each row.

The source system picks one database per run: the tenant's own (``f_number``)
when asked to, else the restricted one for protected data, else the shared
one. As a column expression the same rule routes rows of many tenants in a
single pass, and :func:`write_routed` writes each database's rows to its own
folder without a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def database_for(tenant: Column, protected: Column, own_database: Column, restricted: str, shared: str) -> Column:
    """``own_database`` -> tenant id; else ``protected`` -> restricted; else shared."""
    return (
        F.when(own_database, tenant)
        .when(protected, F.lit(restricted))
        .otherwise(F.lit(shared))
    )


DATABASE = "database"


def write_routed(df: DataFrame, path: str, database: Column, mode: str = "errorifexists", max_records_per_file: int = 5_000_000) -> str:
    """Write each row under ``<path>/database=<its database>``.

    Tasks keep their input and write the databases they meet, so a tenant with
    a third of all rows is written by as many tasks as read it."""
    (
        df.withColumn(DATABASE, database)
        .write.mode(mode)
        .option("maxRecordsPerFile", max_records_per_file)
        .partitionBy(DATABASE)
        .parquet(path)
    )
    return path


def read_routed(spark, path: str, database: str) -> DataFrame:
    """The rows of one database (its folder alone is read)."""
    return spark.read.parquet(f"{path.rstrip('/')}/{DATABASE}={database}")
