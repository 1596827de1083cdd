"""Upsert by key: semantics, counts, duplicate policy, and properties."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tidesync.operators.merge import (
    ACTION,
    DuplicateKeyError,
    action_counts,
    latest_by_key,
    merge_rows,
    prepare_source,
)


def _counts(df):
    r = action_counts(df).first()
    return r.inserted_count, r.updated_count, r.kept_count, r.total_rows


def test_merge_semantics(spark):
    target = spark.createDataFrame([(1, "a", "t1"), (2, "b", "t2"), (3, "c", "t3")], "k long, v string, extra string")
    source = spark.createDataFrame([(2, None), (3, "c"), (4, "d")], "k long, v string")
    out = {r.k: r for r in merge_rows(target, source, ["k"]).collect()}
    assert out[1].v == "a" and out[1][ACTION] == "kept"
    assert out[2].v is None and out[2][ACTION] == "updated"       # null overwrites
    assert out[3].v == "c" and out[3][ACTION] == "updated"        # unchanged still counts
    assert out[4].v == "d" and out[4][ACTION] == "inserted"
    assert out[2].extra == "t2" and out[4].extra is None          # target-only column


def test_reload_counts(spark):
    src = spark.createDataFrame([(i, f"v{i}") for i in range(5)], "k long, v string")
    empty = spark.createDataFrame([], "k long, v string")
    first = merge_rows(empty, src, ["k"])
    assert _counts(first)[:2] == (5, 0)
    second = merge_rows(first.drop(ACTION), src, ["k"])
    assert _counts(second)[:2] == (0, 5)
    assert sorted(second.drop(ACTION).collect()) == sorted(src.collect())


def test_null_keys_never_match(spark):
    target = spark.createDataFrame([(None, "t")], "k long, v string")
    source = spark.createDataFrame([(None, "s")], "k long, v string")
    assert _counts(merge_rows(target, source, ["k"]))[:3] == (1, 0, 1)


def test_composite_key(spark):
    target = spark.createDataFrame([(1, 1, "a"), (1, 2, "b")], "a long, b long, v string")
    source = spark.createDataFrame([(1, 2, "B"), (2, 1, "c")], "a long, b long, v string")
    out = {(r.a, r.b): (r.v, r[ACTION]) for r in merge_rows(target, source, ["a", "b"]).collect()}
    assert out == {(1, 1): ("a", "kept"), (1, 2): ("B", "updated"), (2, 1): ("c", "inserted")}


def test_source_is_cast_to_target_types(spark):
    from decimal import Decimal
    target = spark.createDataFrame([(Decimal(1), "a")], "k decimal(38,0), v string")
    source = spark.createDataFrame([(1, "b")], "k long, v string")
    out = merge_rows(target, source, ["k"])
    assert dict(out.dtypes)["k"] == "decimal(38,0)"
    assert _counts(out)[:2] == (0, 1)


def test_duplicate_keys(spark):
    src = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (2, "c", 1)], "k long, v string, ver int")
    with pytest.raises(DuplicateKeyError):
        prepare_source(src, ["k"], "error")
    latest = {r.k: r.v for r in prepare_source(src, ["k"], "latest", ["ver"]).collect()}
    assert latest == {1: "b", 2: "c"}
    assert prepare_source(src, ["k"], "allow").count() == 3


def test_latest_by_key_keeps_schema_and_breaks_ties(spark):
    src = spark.createDataFrame([(1, "a", 1), (1, "b", 1)], "k long, v string, ver int")
    out = latest_by_key(src, ["k"], ["ver"])
    assert out.columns == src.columns
    assert [r.v for r in out.collect()] == ["b"]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    tkeys=st.sets(st.integers(0, 30), max_size=15),
    skeys=st.sets(st.integers(0, 30), max_size=15),
)
def test_merge_properties(spark, tkeys, skeys):
    target = spark.createDataFrame([(k, "t") for k in tkeys], "k long, v string")
    source = spark.createDataFrame([(k, "s") for k in skeys], "k long, v string")
    merged = merge_rows(target, source, ["k"])
    ins, upd, kept, total = _counts(merged)
    assert ins == len(skeys - tkeys)
    assert upd == len(skeys & tkeys)
    assert kept == len(tkeys - skeys)
    assert ins + upd + kept == total == len(tkeys | skeys)
    # idempotence: merging the same source again changes no row
    again = merge_rows(merged.drop(ACTION), source, ["k"])
    assert sorted(again.drop(ACTION).collect()) == sorted(merged.drop(ACTION).collect())


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    tkeys=st.sets(st.integers(0, 25), max_size=12),
    skeys=st.sets(st.integers(0, 25), max_size=12),
)
def test_broadcast_strategy_equals_shuffle(spark, tkeys, skeys):
    target = spark.createDataFrame([(k, f"t{k}", "x") for k in tkeys], "k long, v string, extra string")
    source = spark.createDataFrame([(k, None if k % 3 == 0 else f"s{k}") for k in skeys], "k long, v string")
    a = sorted(merge_rows(target, source, ["k"], strategy="shuffle").collect())
    b = sorted(merge_rows(target, source, ["k"], strategy="broadcast").collect())
    assert a == b


def test_broadcast_plan_does_not_shuffle_target(spark, tmp_dir):
    spark.range(1000).selectExpr("id AS k", "cast(id AS string) AS v").write.parquet(f"{tmp_dir}/t")
    target = spark.read.parquet(f"{tmp_dir}/t")
    source = spark.createDataFrame([(1, "a"), (5000, "b")], "k long, v string")
    plan = merge_rows(target, source, ["k"], strategy="broadcast")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
    assert "SortMergeJoin" not in plan or plan.count("SortMergeJoin") <= 1  # only the small anti join may sort-merge
    got = {r.k: r[ACTION] for r in merge_rows(target, source, ["k"], strategy="broadcast").filter("k IN (1, 5000)").collect()}
    assert got == {1: "updated", 5000: "inserted"}


def test_table_merge_picks_strategy_by_measured_size(spark, tmp_dir):
    from tidesync.plans.tables import VersionedTable

    t = VersionedTable(spark, f"{tmp_dir}/tbl", ["k"])
    t.provision(spark.createDataFrame([], "k long, v string").schema)
    src = spark.createDataFrame([(i, "v") for i in range(50)], "k long, v string")
    assert t.merge(src).strategy == "broadcast"
    r = t.merge(src, broadcast_limit_bytes=0)
    assert (r.strategy, r.inserted, r.updated) == ("shuffle", 0, 50)


def test_changed_only_counts(spark):
    target = spark.createDataFrame([(1, "a", None), (2, "b", "x")], "k long, v string, w string")
    source = spark.createDataFrame([(1, "a", None), (2, "B", "x"), (3, "c", None)], "k long, v string, w string")
    plain = action_counts(merge_rows(target, source, ["k"])).first()
    assert (plain.updated_count, plain.unchanged_count) == (2, 0)
    changed = merge_rows(target, source, ["k"], changed_only=True)
    r = action_counts(changed).first()
    assert (r.inserted_count, r.updated_count, r.unchanged_count) == (1, 1, 1)
    assert sorted(changed.drop(ACTION).collect()) == sorted(merge_rows(target, source, ["k"]).drop(ACTION).collect())


def test_null_key_rows_stay_out_of_the_join(spark):
    target = spark.createDataFrame([(None, f"t{i}") for i in range(50)] + [(1, "a")], "k long, v string")
    source = spark.createDataFrame([(None, f"s{i}", 1) for i in range(20)] + [(1, "b", 2)], "k long, v string, w int")
    merged = merge_rows(target, source, ["k"])
    r = action_counts(merged).first()
    assert (r.inserted_count, r.updated_count, r.kept_count) == (20, 1, 50)
    for other in (merge_rows(target, source, ["k"], null_keys=False), merge_rows(target, source, ["k"], strategy="broadcast")):
        assert sorted(map(str, merged.collect())) == sorted(map(str, other.select(merged.columns).collect()))
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert "isnotnull(k" in plan and "isnull(k" in plan and "Union" in plan


def test_null_keys_survive_every_duplicate_policy(spark):
    source = spark.createDataFrame([(None, "a", 1), (None, "a", 1), (None, "b", 2), (1, "c", 3), (1, "d", 4)], "k long, v string, o int")
    latest = prepare_source(source, ["k"], "latest", ["o"]).collect()
    assert sorted((r.k is None, r.v) for r in latest) == [(False, "d"), (True, "a"), (True, "a"), (True, "b")]
    whole = source.where("k IS NULL OR o = 3")
    assert prepare_source(whole, ["k"], "error").count() == 4
    with pytest.raises(DuplicateKeyError):
        prepare_source(source, ["k"], "error")


def test_duplicates_fail_inside_the_join_without_another_shuffle(spark, tmp_dir):
    spark.range(100).selectExpr("id AS k", "'x' AS v").write.parquet(f"{tmp_dir}/t")
    target = spark.read.parquet(f"{tmp_dir}/t")
    spark.range(50, 150).selectExpr("id AS k", "'y' AS v").write.parquet(f"{tmp_dir}/s")
    source = spark.read.parquet(f"{tmp_dir}/s")
    merged = merge_rows(target, source, ["k"], on_duplicate="error", null_keys=False)
    assert merged.count() == 150
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2
    with pytest.raises(Exception, match="duplicate merge keys"):
        merge_rows(target, source.unionByName(source.limit(1)), ["k"], on_duplicate="error").collect()


def test_composite_merge_shuffles_twice(spark):
    from tidesync.plans.workloads import q_merge_composite

    plan = q_merge_composite(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2, plan
