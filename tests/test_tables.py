"""Versioned Parquet tables: provision, merge, delete, replay guard, sinks."""

import os

import pytest

from tidesync.models import MATERIALS
from tidesync.plans import tables
from tidesync.plans.tables import (
    LayoutError,
    VersionedTable,
    merge_into_sql,
    ordered_batch,
    with_date_parts,
    write_date_partitioned,
    write_json,
    write_parquet,
)
from tidesync.spec import ddl, replace_ddl


def test_provision_merge_delete(spark, tmp_dir):
    t = VersionedTable(spark, f"{tmp_dir}/t", ["k"])
    assert not t.exists()
    assert t.provision(spark.createDataFrame([], "k long, v string").schema) == 0
    assert t.read().count() == 0
    # provisioning again is a no-op
    assert t.provision(spark.createDataFrame([], "k long, v string").schema) == 0
    r = t.merge(spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k long, v string"))
    assert (r.version, r.inserted, r.updated, r.kept, r.total) == (1, 3, 0, 0, 3)
    r = t.merge(spark.createDataFrame([(3, "C"), (4, "d")], "k long, v string"))
    assert (r.inserted, r.updated, r.kept) == (1, 1, 2)
    assert {x.k: x.v for x in t.read().collect()} == {1: "a", 2: "b", 3: "C", 4: "d"}
    # older versions stay readable
    assert t.read(1).count() == 3
    keys = spark.createDataFrame([(1,), (4,), (None,), (9,)], "key long")
    assert t.delete_keys(keys, "key", "k") == 2
    assert sorted(x.k for x in t.read().collect()) == [2, 3]
    ops = [x.operation for x in t.commits().orderBy("version").collect()]
    assert ops == ["create", "merge", "merge", "delete"]


def test_batch_key_replay_is_skipped(spark, tmp_dir):
    t = VersionedTable(spark, f"{tmp_dir}/t", ["k"])
    t.provision(spark.createDataFrame([], "k long, v string").schema)
    src = spark.createDataFrame([(1, "a")], "k long, v string")
    assert t.merge(src, batch_key="s:0").inserted == 1
    again = t.merge(src, batch_key="s:0")
    assert again.replayed and (again.version, again.inserted, again.updated) == (1, 1, 0)
    assert t.current_version() == 1 and t.committed_batch("s:0") and not t.committed_batch("s:1")
    # later changes do not make it forget; numbered batches of a stream are remembered by their last number
    t.merge(spark.createDataFrame([(2, "b")], "k long, v string"), batch_key=ordered_batch("s", 4))
    assert t.merge(src, batch_key="s:0").replayed and t.merge(src, batch_key=ordered_batch("s", 3)).replayed
    assert not t.committed_batch(ordered_batch("other", 3)) and t.current_version() == 2


def test_merge_needs_provisioned_table(spark, tmp_dir):
    t = VersionedTable(spark, f"{tmp_dir}/none", ["k"])
    with pytest.raises(FileNotFoundError):
        t.merge(spark.createDataFrame([(1,)], "k long"))


def test_gzip_parquet_and_json_sinks(spark, tmp_dir):
    df = spark.createDataFrame([(1, "a")], "k long, v string")
    p = write_parquet(df, f"{tmp_dir}/pq")
    assert any(f.endswith(".gz.parquet") for f in os.listdir(p))
    assert spark.read.parquet(p).count() == 1
    j = write_json(df, f"{tmp_dir}/js")
    assert spark.read.json(j).first().v == "a"


def test_date_partition_layout(spark, tmp_dir):
    df = spark.sql("SELECT 1 AS id, TIMESTAMP_NTZ'2024-01-03 10:00:00' AS ts")
    p = write_date_partitioned(df, f"{tmp_dir}/dp", "ts")
    assert os.path.isdir(os.path.join(p, "year=2024", "month=1", "day=3"))
    back = spark.read.parquet(p).first()
    assert (back.year, back.month, back.day) == (2024, 1, 3)
    assert with_date_parts(df, "ts").columns[-3:] == ["year", "month", "day"]


def test_ddl_text():
    text = ddl(MATERIALS)
    assert text.startswith("CREATE TABLE IF NOT EXISTS materials_query (")
    assert "`order_lead_time` DECIMAL(38,0)" in text
    assert ddl(MATERIALS, "my-table").startswith("CREATE TABLE IF NOT EXISTS `MY-TABLE` (")
    assert ddl(MATERIALS, "my-table", override=True).startswith("CREATE TABLE IF NOT EXISTS `my-table` (")


def test_replacing_ddl_runs(spark):
    for statement in replace_ddl(MATERIALS) * 2:
        spark.sql(statement)
    assert spark.table("materials_query").columns == MATERIALS.names
    spark.sql("DROP TABLE materials_query")


def test_merge_into_statement():
    assert merge_into_sql("cat.t", "s", ["k", "odd name"], ["k"]) == (
        "MERGE INTO cat.t t USING s s ON t.`k` = s.`k` WHEN MATCHED THEN UPDATE SET t.`odd name` = s.`odd name`"
        " WHEN NOT MATCHED THEN INSERT (`k`, `odd name`) VALUES (s.`k`, s.`odd name`)"
    )


def test_layout_and_keys_come_from_the_table(spark, tmp_dir):
    schema = spark.createDataFrame([], "k long, v string").schema
    base = spark.createDataFrame([(i, "a") for i in range(100)], "k long, v string")
    delta = spark.createDataFrame([(i, "b") for i in range(5)], "k long, v string")
    VersionedTable(spark, f"{tmp_dir}/t", ["k"], hash_partitions=8).provision(schema)
    VersionedTable(spark, f"{tmp_dir}/t").merge(base)
    other = VersionedTable(spark, f"{tmp_dir}/t", ["k"], hash_partitions=16)
    for change in (lambda: other.merge(delta), lambda: other.provision(schema), lambda: other.delete_keys(delta, "k")):
        with pytest.raises(LayoutError):
            change()
    with pytest.raises(LayoutError):
        VersionedTable(spark, f"{tmp_dir}/t").merge(delta, keys=["v"])
    t = VersionedTable(spark, f"{tmp_dir}/t")
    r = t.merge(delta)
    assert (r.inserted, r.updated, r.total) == (0, 5, 100) and t.read().select("k").distinct().count() == 100


def test_a_table_can_be_partitioned_anew(spark, tmp_dir):
    t = VersionedTable(spark, f"{tmp_dir}/t", ["k"], hash_partitions=2)
    t.provision(spark.createDataFrame([], "k long, v string").schema)
    t.merge(spark.createDataFrame([(i, "a") for i in range(50)], "k long, v string"))
    t.repartition(8)
    wide = VersionedTable(spark, f"{tmp_dir}/t", ["k"], hash_partitions=8)
    assert wide.merge(spark.createDataFrame([(1, "b"), (99, "c")], "k long, v string")).total == 51
    wide.repartition(None)
    plain = VersionedTable(spark, f"{tmp_dir}/t")
    assert plain.merge(spark.createDataFrame([(2, "d")], "k long, v string")).partitions_rewritten == -1
    assert plain.row_count() == 51


def test_deletes_on_empty_inputs(spark, tmp_dir):
    schema = spark.createDataFrame([], "k long, v string").schema
    some, none = spark.createDataFrame([(1, "a")], "k long, v string"), spark.createDataFrame([], "k long")
    for name, layout in (("p", {}), ("h", {"hash_partitions": 4})):
        t = VersionedTable(spark, f"{tmp_dir}/{name}", ["k"], **layout)
        t.provision(schema)
        assert t.delete_keys(some, "k") == 0 and t.delete_keys(none, "k") == 0
        t.merge(some)
        assert t.delete_keys(none, "k") == 0 and t.row_count() == 1
        assert t.delete_keys(some, "k") == 1 and t.row_count() == 0
        assert (t.merge(some.where("false")).inserted, t.row_count()) == (0, 0)


def test_merge_without_effect_warns_in_every_layout(spark, tmp_dir, caplog):
    for name, layout in (("p", {}), ("h", {"hash_partitions": 4})):
        t = VersionedTable(spark, f"{tmp_dir}/{name}", ["k"], **layout)
        t.provision(spark.createDataFrame([], "k long, v string").schema)
        caplog.clear()
        t.merge(spark.createDataFrame([], "k long, v string"))
        assert "no rows inserted or updated" in caplog.text


def test_hash_partitioned_table_rewrites_only_touched_partitions(spark, tmp_dir):
    schema = spark.createDataFrame([], "k long, v string").schema
    plain = VersionedTable(spark, f"{tmp_dir}/plain", ["k"])
    hp = VersionedTable(spark, f"{tmp_dir}/hp", ["k"], hash_partitions=16)
    base = spark.createDataFrame([(i, f"v{i}") for i in range(400)], "k long, v string")
    delta = spark.createDataFrame([(3, "x"), (1000, "new")], "k long, v string")
    for t in (plain, hp):
        t.provision(schema)
        t.merge(base)
    r_plain = plain.merge(delta)
    r_hp = hp.merge(delta)
    assert (r_hp.inserted, r_hp.updated, r_hp.kept, r_hp.total) == (r_plain.inserted, r_plain.updated, r_plain.kept, r_plain.total)
    assert 1 <= r_hp.partitions_rewritten <= 2
    assert sorted(plain.read().collect()) == sorted(hp.read().collect())
    last = hp.commits().orderBy("version").collect()[-1]
    assert sum(e["rows"] for e in last["manifest"]) == 401
    # folders of untouched partitions are carried over from the earlier version
    assert {e["path"].split("/data/")[1].split("/")[0] for e in last["manifest"]} == {"v=00000001", "v=00000002"}
    # a reader that names no layout reads the manifest
    assert VersionedTable(spark, f"{tmp_dir}/hp").read().count() == 401


def test_hash_partitioned_shuffle_merge_and_delete(spark, tmp_dir):
    schema = spark.createDataFrame([], "k long, v string").schema
    hp = VersionedTable(spark, f"{tmp_dir}/hp", ["k"], hash_partitions=8)
    hp.provision(schema)
    hp.merge(spark.createDataFrame([(i, "a") for i in range(100)], "k long, v string"), strategy="shuffle")
    r = hp.merge(spark.createDataFrame([(i, "b") for i in range(50, 150)], "k long, v string"), strategy="shuffle")
    assert (r.inserted, r.updated, r.kept, r.total, r.partitions_rewritten) == (50, 50, 50, 150, 8)
    assert hp.delete_keys(spark.createDataFrame([(1,), (149,), (999,)], "key long"), "key", "k") == 2
    last = hp.commits().orderBy("version").collect()[-1]
    assert last["total_rows"] == 148 and sum(e["rows"] for e in last["manifest"]) == 148
    got = {x.k: x.v for x in hp.read().collect()}
    assert len(got) == 148 and got[60] == "b" and got[10] == "a" and 1 not in got


def test_date_partitions_are_pruned_on_read(spark, tmp_dir):
    df = spark.sql(
        "SELECT * FROM VALUES (1, TIMESTAMP_NTZ'2024-01-03 10:00:00'), (2, TIMESTAMP_NTZ'2024-02-04 11:00:00') AS t(id, ts)"
    )
    p = write_date_partitioned(df, f"{tmp_dir}/dp2", "ts")
    q = spark.read.parquet(p).filter("year = 2024 AND month = 2")
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan and "(month#" in plan
    assert [r.id for r in q.collect()] == [2]


def test_parquet_file_name():
    import datetime as dt

    from tidesync.plans.tables import parquet_file_name

    assert parquet_file_name("materials_query", dt.datetime(2024, 1, 3, 4, 5, 6)) == "materials_query-2024-01-03_04_05_06.parquet"


def test_vacuum_keeps_what_recent_versions_reference(spark, tmp_dir):
    schema = spark.createDataFrame([], "k long, v string").schema
    plain = VersionedTable(spark, f"{tmp_dir}/plain", ["k"])
    hp = VersionedTable(spark, f"{tmp_dir}/hp", ["k"], hash_partitions=8)
    for t in (plain, hp):
        t.provision(schema)
        t.merge(spark.createDataFrame([(i, "a") for i in range(100)], "k long, v string"))
        t.merge(spark.createDataFrame([(1, "b")], "k long, v string"))
        t.merge(spark.createDataFrame([(2, "c")], "k long, v string"))
        before = sorted(map(str, t.read().collect()))
        gone = t.vacuum(keep_versions=1)
        assert gone
        assert sorted(map(str, t.read().collect())) == before
        assert not os.path.exists(f"{t.root}/_staging")
    assert sorted(os.listdir(f"{tmp_dir}/plain/data")) == ["v=00000003"]
    # the hash layout still holds folders from older versions that the latest manifest references
    assert len(os.listdir(f"{tmp_dir}/hp/data")) >= 2


def test_retry_after_a_crash_before_commit(spark, tmp_dir):
    schema = spark.createDataFrame([], "k long, v string").schema
    for layout in ({}, {"hash_partitions": 4}):
        t = VersionedTable(spark, f"{tmp_dir}/t{len(layout)}", ["k"], **layout)
        t.provision(schema)
        # a version folder written by an attempt that died before its commit row
        spark.createDataFrame([(99, "orphan")], "k long, v string").write.parquet(t.version_path(1) + ("/_part=0" if layout else ""))
        r = t.merge(spark.createDataFrame([(1, "a")], "k long, v string"))
        assert (r.version, r.inserted) == (1, 1)
        assert [(x.k, x.v) for x in t.read().collect()] == [(1, "a")]


def test_a_change_reads_the_newest_commit_only(spark, tmp_dir):
    t = VersionedTable(spark, f"{tmp_dir}/c", ["k"])
    t.provision(spark.createDataFrame([], "k long, v string").schema)
    for i in range(1, 4):
        t.merge(spark.createDataFrame([(i, "x")], "k long, v string"))
    assert [r.version for r in t.commits().orderBy("version").collect()] == [0, 1, 2, 3]
    t.vacuum(keep_versions=1, keep_commits=2)
    assert [r.version for r in t.commits().orderBy("version").collect()] == [2, 3]
    # a commit without its marker is half written: the table stays at the version before
    os.makedirs(f"{tmp_dir}/c/_commits/v=00000004")
    assert t.current_version() == 3
    assert t.merge(spark.createDataFrame([(9, "y")], "k long, v string")).version == 4
    assert t.read().count() == 4 and not os.path.exists(f"{tmp_dir}/c/_staging")


def test_unknown_source_columns_are_refused_unless_allowed(spark, tmp_dir):
    for name, layout in (("p", {}), ("h", {"hash_partitions": 4})):
        t = VersionedTable(spark, f"{tmp_dir}/{name}", ["k"], **layout)
        t.provision(spark.createDataFrame([], "k long, v string").schema)
        t.merge(spark.createDataFrame([(k, "old") for k in range(20)], "k long, v string"))
        src = spark.createDataFrame([(1, "a", "extra")], "k long, v string, w string")
        with pytest.raises(ValueError):
            t.merge(src)
        assert t.merge(src, allow_new_columns=True).updated == 1
        rows = {r.k: r for r in t.read().collect()}
        assert t.read().columns == ["k", "v", "w"] and rows[1].w == "extra" and rows[2].w is None and len(rows) == 20
        t.merge(spark.createDataFrame([(2, "b")], "k long, v string"))
        assert {r.k: r.w for r in t.read().collect()}[1] == "extra"


def test_small_delta_rewrites_few_partitions(spark):
    from tidesync.plans.workloads import small_delta_table

    t = small_delta_table(spark, "/root/testdata/sf0.001")
    last = t.commits().orderBy("version").collect()[-1]
    rewritten = {e["path"] for e in last["manifest"] if "/v=00000002/" in e["path"]}
    assert last["updated_count"] == 1 and len(rewritten) == 1 and len(last["manifest"]) == 32


@pytest.mark.parametrize("layout", [None, 8])
def test_a_lost_observation_is_counted_again(spark, tmp_dir, monkeypatch, layout):
    """Observations that report nothing must not pass for empty: in the hash layout, keys would be written twice."""
    tbl = VersionedTable(spark, f"{tmp_dir}/lost", ["k"], hash_partitions=layout)
    df = spark.range(40).selectExpr("id AS k", "id * 2 AS v")
    tbl.provision(df.schema)
    monkeypatch.setattr(tables, "observed_values", lambda obs: {})
    tbl.merge(df)
    res = tbl.merge(df.where("k < 10").unionByName(spark.range(40, 45).selectExpr("id AS k", "id AS v")))
    assert (res.inserted, res.updated, res.total) == (5, 10, 45)
    assert tbl.read().count() == 45 and tbl.read().select("k").distinct().count() == 45
    assert tbl.merge(df.where("false")).total == 45


def test_counts_that_do_not_add_up_commit_nothing(spark, tmp_dir, monkeypatch):
    tbl = VersionedTable(spark, f"{tmp_dir}/wrong", ["k"])
    df = spark.range(4).selectExpr("id AS k", "id AS v")
    tbl.provision(df.schema)
    before = tbl.current_version()
    write = tbl._write
    monkeypatch.setattr(tbl, "_write", lambda d, v: (write(d, v)[0] + 1, None))
    with pytest.raises(RuntimeError, match="nothing is committed"):
        tbl.merge(df)
    assert tbl.current_version() == before
