"""CSV types from one aggregate over all files."""

import datetime as dt
import os
from decimal import Decimal

import pytest
from pyspark.sql import types as T

from tidesync.sources.csv_types import column_types, read_csv_typed


def _write(folder, files):
    os.makedirs(folder, exist_ok=True)
    for name, text in files.items():
        with open(f"{folder}/{name}", "w", encoding="utf-8") as f:
            f.write(text)
    return folder


def test_files_whose_types_differ(spark, tmp_dir):
    path = _write(f"{tmp_dir}/csv", {
        "a.csv": "id,amount,at,code,flag,note,big\n1,5,2024-01-02,007,true,x,1\n2,,,010,False,,2\n",
        "b.csv": "id,amount,at,code,flag,note,big\n3,7.25,2024-01-02 03:04:05,011,,12,99999999999\n",
        "c.csv": "id,amount,at,code,flag,note,big\n4,1,,,TRUE,é,5\n",
    })
    rows, bad, schema = read_csv_typed(spark, path)
    assert [f.dataType.simpleString() for f in schema] == ["int", "decimal(38,2)", "timestamp_ntz", "string", "boolean", "string", "bigint"]
    got = {r.id: r for r in rows.collect()}
    assert got[1].amount == Decimal("5.00") and got[3].amount == Decimal("7.25") and got[2].amount is None
    assert got[1].at == dt.datetime(2024, 1, 2) and got[3].at == dt.datetime(2024, 1, 2, 3, 4, 5) and got[2].code == "010"
    assert got[2].flag is False and got[4].flag is True and os.path.basename(got[4].source_file) == "c.csv" and bad.count() == 0


def test_lines_that_do_not_fit_go_to_the_bad_rows(spark, tmp_dir):
    path = _write(f"{tmp_dir}/bad", {"a.csv": "p,q\n1,2\n3\n4,5,6\n", "b.csv": "p,q\n7,8\n"})
    rows, bad, schema = read_csv_typed(spark, path)
    assert sorted((r.p, r.q) for r in rows.collect()) == [(1, 2), (7, 8)] and schema["p"].dataType == T.IntegerType()
    assert sorted(r.record for r in bad.collect()) == ["3", "4,5,6"]


def test_another_header_fails(spark, tmp_dir):
    path = _write(f"{tmp_dir}/other", {"a.csv": "p,q\n1,2\n", "b.csv": "q,p\n1,2\n"})
    with pytest.raises(Exception):  # noqa: B017
        read_csv_typed(spark, path)[0].collect()


def test_empty_files(spark, tmp_dir):
    rows, bad, schema = read_csv_typed(spark, _write(f"{tmp_dir}/none", {"a.csv": "p,q\n"}))
    assert rows.count() == 0 and bad.count() == 0 and {f.dataType for f in schema} == {T.StringType()}


@pytest.mark.parametrize("values,kind", [
    (["1", " 2 ", ""], "int"), (["1234567890"], "bigint"), (["1" * 19, "-5"], "decimal(38,0)"), (["1" * 39], "double"), (["1.5", "-2.125"], "decimal(38,3)"),
    (["1e5", "2"], "double"), (["NaN", "1.0"], "double"), (["007", "1"], "string"), (["0", "0.5"], "decimal(38,1)"), (["true", "1"], "string"), (["2024-02-30"], "string"),
    (["2024-02-29", "2024-01-01"], "date"), (["2024-02-29T01:02", "2024-01-01"], "timestamp_ntz"), ([None, None], "string"), (["1", "x"], "string"), (["-0", "+3"], "int"),
])
def test_type_that_holds_all_values(spark, values, kind):
    rows = spark.createDataFrame([(v,) for v in values], "c string").repartition(2)
    assert column_types(rows)["c"].dataType.simpleString() == kind
