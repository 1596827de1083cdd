"""Every registered query against its SQL oracle (DuckDB) on sf0.001.

The same comparison the driver runs at sf0.01: row count, column names and
types, and an order-insensitive hash of the values.
"""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(__file__), "..", "tools"))
import __spark_entry__ as E  # noqa: E402
from check_oracle import TABLES, digest, spark_to_duck  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    sql = E.oracle_sql()[name]
    res = duck.execute(sql)
    orows = res.fetchall()
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    stypes = {f.name: spark_to_duck(f.dataType) for f in df.schema.fields}
    otypes = {d[0]: str(d[1]) for d in res.description}
    assert stypes == otypes
    assert len(rows) == len(orows)
    assert digest(df.columns, rows)[0] == digest(ocols, orows)[0]
