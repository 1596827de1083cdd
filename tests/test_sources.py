"""File sources (CSV, Parquet, XML, listing), SQL to strings, names."""

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidesync.functions.normalize import json_member, json_members, needs_quoting, quote_identifier, unescape_name
from tidesync.operators.filters import lower_columns, rename_project, snapshot_filter, unescape_columns
from tidesync.sources.files import list_files, read_csv_files, read_parquet, read_xml_documents
from tidesync.plans.tables import VersionedTable
from tidesync.sources.sql import loaded_tables, sql_to_strings


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


def test_csv_files_with_provenance(spark, tmp_dir):
    _write(f"{tmp_dir}/csv/a.csv", "id,name\n1,x\n2,y\n")
    _write(f"{tmp_dir}/csv/b.csv", "id,name\n3,é\n")
    df = read_csv_files(spark, f"{tmp_dir}/csv")
    assert dict(df.dtypes)["id"] == "int"
    files = {os.path.basename(r.source_file): r.id for r in df.collect() if r.id in (1, 3)}
    assert files == {"a.csv": 1, "b.csv": 3}
    typed = read_csv_files(spark, f"{tmp_dir}/csv", schema="id long, name string", with_source=False)
    assert typed.count() == 3 and typed.columns == ["id", "name"]


def test_csv_files_with_other_headers_fail(spark, tmp_dir):
    _write(f"{tmp_dir}/two/a.csv", "p,q\n1,x\n")
    _write(f"{tmp_dir}/two/b.csv", "q,p\ny,2\n")
    for schema in (None, "p string, q string"):
        with pytest.raises(Exception):
            read_csv_files(spark, f"{tmp_dir}/two", schema=schema).collect()


def test_csv_with_quoted_line_breaks(spark, tmp_dir):
    _write(f"{tmp_dir}/ml/a.csv", 'id,name\n1,"x\ny"\n2,z\n')
    assert {r.id: r.name for r in read_csv_files(spark, f"{tmp_dir}/ml", multi_line=True).collect()} == {1: "x\ny", 2: "z"}


def test_csv_malformed_fails(spark, tmp_dir):
    _write(f"{tmp_dir}/bad/a.csv", "id,name\n1,x\nnot-a-number,y\n")
    with pytest.raises(Exception):
        read_csv_files(spark, f"{tmp_dir}/bad", schema="id int, name string").collect()


def test_parquet_and_listing(spark, tmp_dir):
    spark.range(5).write.parquet(f"{tmp_dir}/pq")
    assert read_parquet(spark, f"{tmp_dir}/pq").count() == 5
    assert "source_file" in read_parquet(spark, f"{tmp_dir}/pq", with_source=True).columns
    listed = list_files(spark, f"{tmp_dir}/pq", glob="*.parquet")
    assert listed.columns == ["path", "name", "length", "modificationTime"]
    assert listed.count() >= 1 and all(r.name.endswith(".parquet") for r in listed.collect())


def test_xml_documents_good_and_broken(spark, tmp_dir):
    _write(f"{tmp_dir}/xml/a.xml", '<order id="1"><item>bolt</item><qty>3</qty></order>')
    _write(f"{tmp_dir}/xml/b.xml", '<order id="2"><item>nut</item>')
    _write(f"{tmp_dir}/xml/c.xml", "   ")
    schema = T.StructType([T.StructField("@id", T.StringType()), T.StructField("item", T.StringType()), T.StructField("qty", T.StringType())])
    loaded, broken = read_xml_documents(spark, f"{tmp_dir}/xml", schema)
    docs = loaded.collect()
    assert len(docs) == 1 and docs[0].doc["@id"] == "1" and docs[0].doc["item"] == "bolt"
    assert [os.path.basename(r.source_file) for r in broken.collect()] == ["b.xml"]


def test_sql_to_strings(spark):
    df = spark.createDataFrame([(1, 2.5, None)], "a int, b double, c string")
    out = sql_to_strings(spark, "SELECT a, b, c, a + 1 AS d FROM t_sql", {"t_sql": df})
    assert all(t == "string" for _, t in out.dtypes)
    assert out.first().asDict() == {"a": "1", "b": "2.5", "c": None, "d": "2"}


def test_names_and_projection(spark):
    assert unescape_name("a__dot__b") == "a.b"
    assert unescape_name("x_underscore____y") == "x___y"
    assert needs_quoting("my col") and not needs_quoting("my_col")
    assert quote_identifier("a`b") == "`a``b`"
    df = spark.createDataFrame([(1, 2)], "`A__dot__B` int, Other int")
    assert unescape_columns(df).columns == ["A.B", "Other"]
    assert lower_columns(df).columns == ["a__dot__b", "other"]
    assert lower_columns(df, override=True).columns == ["A__dot__B", "Other"]
    out = rename_project(df, {"Other": "other", "Missing": "missing"})
    assert out.columns == ["other", "missing"] and out.first().missing is None


def test_snapshot_filter_blank_means_no_filter(spark):
    df = spark.createDataFrame([("a", "hello", 1), ("b", "world", 5)], "k string, t string, n int")
    assert snapshot_filter(df, equals={"k": ""}, contains={"t": ""}).count() == 2
    assert snapshot_filter(df, contains={"t": "orl"}).count() == 1
    assert snapshot_filter(df, between={"n": (1, 4)}).count() == 1
    assert snapshot_filter(df, between={"n": ("", 5)}).count() == 2


def test_xml_schema_inferred_with_prefixes_and_text(spark, tmp_dir):
    _write(f"{tmp_dir}/x/a.xml", '<ns:order xmlns:ns="urn:x" ns:id="7"><ns:item code="A">bolt</ns:item><qty>3</qty></ns:order>')
    _write(f"{tmp_dir}/x/b.xml", '<ns:order xmlns:ns="urn:x" ns:id="8"><ns:item code="B">nut</ns:item>')
    loaded, broken = read_xml_documents(spark, f"{tmp_dir}/x", row_tag="ns:order")
    doc = loaded.first().doc
    assert doc["@ns:id"] == "7" and doc["qty"] == "3"
    assert doc["ns:item"]["#text"] == "bolt" and doc["ns:item"]["@code"] == "A"
    assert [os.path.basename(r.source_file) for r in broken.collect()] == ["b.xml"]


def test_sql_in_named_database(spark, tmp_dir):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS tidesync_test_db LOCATION '{tmp_dir}/db'")
    spark.createDataFrame([(1,)], "a int").createOrReplaceTempView("plain_view")
    before = spark.catalog.currentDatabase()
    out = sql_to_strings(spark, "SELECT a FROM plain_view", database="tidesync_test_db")
    assert out.first().a == "1"
    assert spark.catalog.currentDatabase() == before


def test_xml_records_in_one_large_file(spark, tmp_dir):
    from tidesync.sources.files import read_xml_records

    body = "".join(f'<item id="{i}"><name>n{i}</name></item>' for i in range(50))
    _write(f"{tmp_dir}/big/a.xml", f"<items>{body}<item id=\"x\"><name>bad</item></items>")
    loaded, broken = read_xml_records(spark, f"{tmp_dir}/big", "item",
                                      T.StructType([T.StructField("@id", T.StringType()), T.StructField("name", T.StringType())]))
    assert loaded.count() == 50
    assert broken.count() == 1


def _loaded(spark, root, name, rows, schema):
    df = spark.createDataFrame(rows, schema)
    tbl = VersionedTable(spark, f"{root}/{name}", [df.columns[0]])
    tbl.provision(df.schema)
    tbl.merge(df)
    return tbl


def test_sql_text_over_loaded_tables(spark, tmp_dir):
    one = _loaded(spark, tmp_dir, "sql one", [(1, "O'Neil"), (2, "x; DROP")], "id int, name string")
    _loaded(spark, tmp_dir, "sql_two", [(1, 2.5), (2, None)], "id int, v double")
    os.makedirs(f"{tmp_dir}/_audit")
    text = "SELECT o.name, t.v FROM `sql one` o JOIN sql_two t ON o.id = t.id WHERE o.name = :name"
    out = sql_to_strings(spark, text, args={"name": "O'Neil"}, warehouse=tmp_dir)
    assert [tuple(r) for r in out.collect()] == [("O'Neil", "2.5")] and all(t == "string" for _, t in out.dtypes)
    # Markers by position; a table loaded again is read anew, the query analysed before is not.
    before = sql_to_strings(spark, "SELECT name FROM `sql one` WHERE id = ?", args=[1], warehouse=tmp_dir)
    version = one.current_version()
    one.merge(spark.createDataFrame([(1, "later")], "id int, name string"))
    assert before.first()[0] == "O'Neil"
    assert sql_to_strings(spark, "SELECT name FROM `sql one` WHERE id = ?", args=[1], warehouse=tmp_dir).first()[0] == "later"
    with loaded_tables(spark, tmp_dir, {"sql one": version}) as names:
        assert names == ["sql one", "sql_two"] and spark.table("`sql one`").where("id = 1").first()["name"] == "O'Neil"
    with pytest.raises(Exception, match="TABLE_OR_VIEW_NOT_FOUND"):
        spark.sql("SELECT * FROM sql_two")  # the views are gone
    spark.range(1).createOrReplaceTempView("sql_two")
    with pytest.raises(ValueError, match="sql_two"):
        sql_to_strings(spark, "SELECT 1", warehouse=tmp_dir)
    assert spark.table("sql_two").columns == ["id"]  # and the caller's own view is untouched
    spark.catalog.dropTempView("sql_two")


def test_json_members(spark):
    rows = [('{"a": {"b": [1, "2"]}, "odd name": 5}',), ("not json",), (None,), ("[]",), ('{"a": {"b": ["x"]}}',)]
    df = spark.createDataFrame(rows, "j string")
    members = {"one": ("$.a.b[0]", "int"), "two": ("$.a.b[1]", "string"), "odd": ("$['odd name']", "bigint")}
    got = [tuple(r) for r in json_members(df, "j", members).select("one", "two", "odd").collect()]
    assert got == [(1, "2", 5), (None,) * 3, (None,) * 3, (None,) * 3, (None, None, None)]
    assert json_members(df, "j", members).columns == ["j", "one", "two", "odd"]
    variant = df.select(F.try_parse_json("j").alias("j"))
    assert [r.odd for r in json_members(variant, "j", members).collect()] == [5, None, None, None, None]
    assert [r[0] for r in df.select(json_member("j", "$.a.b[1]")).collect()] == ["2", None, None, None, None]


def test_supplier_documents_are_written_by_many_tasks(spark, tmp_dir):
    """One small file of suppliers must not leave all documents to one task; every row still gives its file."""
    from tidesync.plans import workloads

    rows = [(k if k % 97 else None, f"n<{k % 500}>", k % 25, -1.0 if k % 10 == 0 else 5.0) for k in range(900)]
    df = spark.createDataFrame(rows, "s_suppkey long, s_name string, s_nationkey int, s_acctbal double")
    df.coalesce(1).write.parquet(f"{tmp_dir}/supplier.parquet")
    names = [f for f in os.listdir(workloads._supplier_documents(spark, tmp_dir)) if f.endswith(".txt")]
    by_task = {}
    for name in names:
        by_task[name.split("-")[1]] = by_task.get(name.split("-")[1], 0) + 1
    assert len(names) == 900 and len(by_task) > 1 and max(by_task.values()) < 2 * workloads.TASK_DOCUMENTS
    assert workloads.q_file_listing(spark, tmp_dir).first().files == 900
    got = workloads.q_xml_documents(spark, tmp_dir).collect()
    whole = [r for r in rows if r[0] is not None and r[3] >= 0]
    assert sorted((r.s_suppkey, r.name) for r in got if not r.broken and r.s_suppkey is not None) == sorted((r[0], r[1]) for r in whole)
