"""The registered SQL of the operators gives the rows of the queries, on the given tables and on odd rows."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(__file__))
sys.path.insert(0, os.path.join(os.path.dirname(__file__), "..", "..", "tools"))
from check_oracle import digest, spark_to_duck  # noqa: E402
from odd_rows import no_documents, odd_documents  # noqa: E402

from tidesync.llm import queries  # noqa: E402


def compare(spark, name, folder, glob=""):
    con = duckdb.connect()
    for t in ("documents", "conversations"):
        if os.path.exists(f"{folder}/{t}.parquet"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet{glob}'")
    df = queries.QUERIES[name](spark, folder)
    result = con.execute(queries.ORACLE_SQL[name])
    names, kinds = [d[0] for d in result.description], {d[0]: str(d[1]) for d in result.description}
    assert sorted(df.columns) == sorted(names)
    assert {f.name: spark_to_duck(f.dataType) for f in df.schema.fields} == kinds
    want = result.fetchall()
    got = [tuple(r) for r in df.collect()]
    assert digest(df.columns, got)[1] == digest(names, want)[1]


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_sql_on_given_tables(spark, name):
    compare(spark, name, "/root/testdata/sf0.01")


@pytest.mark.parametrize("name", [n for n in sorted(queries.ORACLE_SQL) if n != "op6_chat"])
def test_sql_on_odd_rows(spark, tmp_dir, name):
    for k, docs in enumerate((odd_documents(spark), no_documents(spark))):
        docs.coalesce(1).write.parquet(f"{tmp_dir}/{k}/documents.parquet")
        compare(spark, name, f"{tmp_dir}/{k}", "/*.parquet")
