"""Incremental intake stream, the nine-table sync run, and the entry contract."""

import json
import os

import pytest
from conftest import write_pages

from tidesync.models import ALL_SPECS, BATCH_PRODUCTION_RECORD, INVENTORY, INVENTORY_USAGE
from tidesync.operators.validate import ValidationError
from tidesync.plans.audit import read_audit
from tidesync.plans.sync import sync
from tidesync.plans.tables import VersionedTable
from tidesync.streaming.intake import incremental_merge


def test_incremental_merge_with_archive(spark, tmp_dir):
    schema = "k long, v string"
    land, arch = f"{tmp_dir}/land", f"{tmp_dir}/archive"
    for i in range(5):
        spark.createDataFrame([(i, f"v{i}"), (i + 100, "x")], schema).coalesce(1).write.mode("append").parquet(land)
    t = VersionedTable(spark, f"{tmp_dir}/t", ["k"])
    t.provision(spark.createDataFrame([], schema).schema)
    batches = []
    q = incremental_merge(spark, land, spark.createDataFrame([], schema).schema, t, ["k"], f"{tmp_dir}/ckpt",
                          max_files_per_trigger=2, archive_dir=arch, on_batch=lambda b, r: batches.append((b, r.inserted)))
    assert q.lastProgress is not None
    assert len(batches) == 3 and sum(n for _, n in batches) == 10
    assert t.read().count() == 10
    # a second run over the same checkpoint finds nothing new
    incremental_merge(spark, land, spark.createDataFrame([], schema).schema, t, ["k"], f"{tmp_dir}/ckpt", max_files_per_trigger=2, archive_dir=arch)
    assert t.read().count() == 10
    # Spark archives processed files from a background cleaner thread, and
    # the files of the last batch only once a later batch commits.
    import time

    deadline = time.time() + 20
    while True:
        archived = [f for _, _, fs in os.walk(arch) for f in fs if f.endswith(".parquet")]
        if len(archived) >= 3 or time.time() > deadline:
            break
        time.sleep(0.5)
    assert len(archived) >= 3


def _value(fs, i):
    if fs.kind == "int":
        return str(i)
    if fs.kind == "datetime":
        return f"2024-01-{(i % 27) + 1:02d} 10:00:00"
    if fs.is_text_union:
        return "2024-01-01"
    return f"{fs.name}-{i}"


def _record(spec, i, **over):
    rec = {fs.source: _value(fs, i) for fs in spec.fields}
    rec.update(over)
    return rec


def _land(root, n=4):
    for name, spec in ALL_SPECS.items():
        if name in (INVENTORY.name, INVENTORY_USAGE.name):
            continue
        recs = [_record(spec, i) for i in range(n)]
        if name == BATCH_PRODUCTION_RECORD.name:
            recs.append(dict(recs[0]))  # identical duplicate: removed by row dedup
        write_pages(f"{root}/{name}", [
            {"Page": 1, "Succeed": True, "IsLastPage": False, "Response": recs[:2]},
            {"Page": 2, "Succeed": False, "IsLastPage": False, "Response": None},
            {"Page": 3, "Succeed": True, "IsLastPage": True, "Response": recs[2:]},
        ])
    active = [_record(INVENTORY, i, InventoryReceiptNumber=f"R{i}") for i in range(n)]
    depleted = [_record(INVENTORY, i, InventoryReceiptNumber=f"D{i}") for i in range(2)]
    write_pages(f"{root}/{INVENTORY.name}/active", [{"Page": 1, "Succeed": True, "IsLastPage": True, "Response": active}])
    write_pages(f"{root}/{INVENTORY.name}/depleted", [{"Page": 1, "Succeed": True, "IsLastPage": True, "Response": depleted}])
    usage_pages = []
    for i in range(n):
        usage_pages.append({"InventoryReceiptNumber": f"R{i}", "Page": 1, "Succeed": True, "IsLastPage": True,
                            "Response": [_record(INVENTORY_USAGE, s, UsageSequence=s) for s in (1, 2)]})
    usage_pages.append({"InventoryReceiptNumber": "D0", "Page": 1, "Succeed": True, "IsLastPage": True,
                        "Response": [_record(INVENTORY_USAGE, 1, UsageSequence=1)]})
    write_pages(f"{root}/{INVENTORY_USAGE.name}", usage_pages)


def test_nine_table_sync_and_reload(spark, tmp_dir):
    land, wh = f"{tmp_dir}/landing", f"{tmp_dir}/warehouse"
    _land(land)
    first = {r.table: (r.inserted, r.updated) for r in sync(
        spark, land, wh, "F1", run_id="run-1", inserted_at="t1",
        hash_partitions={INVENTORY_USAGE.name: 4},
    )}
    assert first[INVENTORY.name] == (6, 0)              # active + depleted
    assert first[INVENTORY_USAGE.name] == (8, 0)        # usage of active receipts only
    assert first[BATCH_PRODUCTION_RECORD.name] == (4, 0)
    assert all(v == (4, 0) for k, v in first.items() if k not in (INVENTORY.name, INVENTORY_USAGE.name))
    second = {r.table: (r.inserted, r.updated) for r in sync(spark, land, wh, "F1", run_id="run-2", inserted_at="t2")}
    assert second == {k: (0, v[0]) for k, v in first.items()}
    audit = read_audit(spark, f"{wh}/_audit")
    assert audit.count() == 18
    inv = VersionedTable(spark, f"{wh}/{INVENTORY.name}").read()
    assert dict(inv.dtypes)["received_date"] == "timestamp_ntz"


def test_sync_stops_before_loading_on_bad_record(spark, tmp_dir):
    land, wh = f"{tmp_dir}/landing", f"{tmp_dir}/warehouse"
    _land(land)
    bad = [_record(ALL_SPECS["materials_query"], 9, PartNumber="")]
    write_pages(f"{land}/materials_query", [{"Page": 0, "Succeed": True, "IsLastPage": False, "Response": bad}], name="late.json")
    with pytest.raises(ValidationError):
        sync(spark, land, wh, "F1")
    assert not os.path.exists(wh)


def test_entry_contract(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    assert df.count() > 0
    assert set(E.oracle_sql()) <= set(E.queries())
    assert "action" in df.columns


def test_incremental_pages_intake(spark, tmp_dir):
    from tidesync.models import MATERIALS
    from tidesync.spec import envelope_schema
    from tidesync.streaming.intake import page_records_transform

    land = f"{tmp_dir}/pages"
    for i in range(3):
        write_pages(land, [{"Page": 1, "Succeed": True, "IsLastPage": True,
                            "Response": [{"PartNumber": f"P{i}", "OrderLeadTime": str(i)}, {"PartNumber": "P0", "Unit": f"u{i}"}]}],
                    name=f"batch-{i}.json")
    t = VersionedTable(spark, f"{tmp_dir}/materials", list(MATERIALS.keys))
    t.provision(MATERIALS.target_schema())
    incremental_merge(spark, land, envelope_schema(MATERIALS), t, list(MATERIALS.keys), f"{tmp_dir}/ck",
                      fmt="json", max_files_per_trigger=1, transform=page_records_transform(MATERIALS), on_duplicate="latest",
                      order_by=["unit"])
    rows = {r.part_number: r for r in t.read().collect()}
    assert set(rows) == {"P0", "P1", "P2"}
    assert rows["P2"].order_lead_time == 2


def _land_one(root, spec_name, records):
    write_pages(f"{root}/{spec_name}", [{"Page": 1, "Succeed": True, "IsLastPage": True, "Response": records}])


def test_empty_input_provisions_without_merge_or_audit(spark, tmp_dir):
    land, wh = f"{tmp_dir}/landing", f"{tmp_dir}/warehouse"
    _land_one(land, "materials_query", [])
    res = sync(spark, land, wh, "F1")
    assert [(r.table, r.skipped_empty) for r in res if not r.missing] == [("materials_query", True)]
    assert sum(r.missing for r in res) == 8
    t = VersionedTable(spark, f"{wh}/materials_query")
    assert t.exists() and t.read().count() == 0
    assert read_audit(spark, f"{wh}/_audit").count() == 0


def test_same_receipt_in_both_inventory_snapshots_fails(spark, tmp_dir):
    from tidesync.operators.merge import DuplicateKeyError

    land, wh = f"{tmp_dir}/landing", f"{tmp_dir}/warehouse"
    rec = _record(INVENTORY, 1, InventoryReceiptNumber="R1")
    write_pages(f"{land}/{INVENTORY.name}/active", [{"Page": 1, "Succeed": True, "IsLastPage": True, "Response": [rec]}])
    write_pages(f"{land}/{INVENTORY.name}/depleted", [{"Page": 1, "Succeed": True, "IsLastPage": True, "Response": [rec]}])
    with pytest.raises(DuplicateKeyError):
        sync(spark, land, wh, "F1")


def test_batch_records_dedup_then_key_conflict(spark, tmp_dir):
    from tidesync.operators.merge import DuplicateKeyError

    land, wh = f"{tmp_dir}/landing", f"{tmp_dir}/warehouse"
    a = _record(BATCH_PRODUCTION_RECORD, 1)
    _land_one(land, BATCH_PRODUCTION_RECORD.name, [a, dict(a)])
    assert [(r.inserted, r.updated) for r in sync(spark, land, wh, "F1") if not r.missing] == [(1, 0)]
    b = dict(a, ProductName="changed")
    land2 = f"{tmp_dir}/landing2"
    _land_one(land2, BATCH_PRODUCTION_RECORD.name, [a, b])
    with pytest.raises(DuplicateKeyError):
        sync(spark, land2, wh, "F1")


def test_command_line_sync_and_counts(spark, tmp_dir, capsys):
    from tidesync.__main__ import main

    land, wh = f"{tmp_dir}/landing", f"{tmp_dir}/warehouse"
    _land_one(land, "materials_query", [_record(ALL_SPECS["materials_query"], i) for i in range(3)])
    assert main(["sync", "--landing", land, "--warehouse", wh, "--f-number", "F1"]) == 0
    out = [json.loads(x) for x in capsys.readouterr().out.splitlines()]
    assert out[0] == {"table": "materials_query", "inserted": 3, "updated": 0, "skipped_empty": False, "missing": False}
    assert len(out) == 9 and all(r["missing"] for r in out[1:])
    assert main(["counts", "--warehouse", wh, "--f-number", "F1", "--tables", "materials_query"]) == 0
    counted = [json.loads(x) for x in capsys.readouterr().out.splitlines()]
    assert counted[0]["inserted_count"] == 3 and counted[0]["updated_count"] == 0
    assert read_audit(spark, f"{wh}/_audit").count() == 2
    assert main(["backfill", "--start", "2024-01-15", "--as-of", "2024-03-01"]) == 0
    assert len(capsys.readouterr().out.splitlines()) == 2


def test_quarantine_mode_loads_good_rows_and_keeps_bad_ones(spark, tmp_dir):
    land, wh = f"{tmp_dir}/landing", f"{tmp_dir}/warehouse"
    spec = ALL_SPECS["materials_query"]
    _land_one(land, spec.name, [_record(spec, 1), _record(spec, 2, PartNumber=""), _record(spec, 3, OrderLeadTime="1.5")])
    res = sync(spark, land, wh, "F1", on_error="quarantine", run_id="r1")
    assert [(r.inserted, r.updated) for r in res if not r.missing] == [(1, 0)]
    bad = spark.read.parquet(f"{wh}/_quarantine/{spec.name}").collect()
    assert sorted(tuple(r["_errors"]) for r in bad) == [("order_lead_time: type not accepted",), ("part_number: required",)]
    assert {r.run_id for r in bad} == {"r1"}


def test_command_line_vacuum(spark, tmp_dir, capsys):
    from tidesync.__main__ import main

    land, wh = f"{tmp_dir}/landing", f"{tmp_dir}/warehouse"
    _land_one(land, "materials_query", [_record(ALL_SPECS["materials_query"], i) for i in range(3)])
    main(["sync", "--landing", land, "--warehouse", wh, "--f-number", "F1"])
    main(["sync", "--landing", land, "--warehouse", wh, "--f-number", "F1"])
    capsys.readouterr()
    assert main(["vacuum", "--warehouse", wh, "--tables", "materials_query", "--keep-versions", "1"]) == 0
    out = [json.loads(x) for x in capsys.readouterr().out.splitlines()]
    assert out[0]["table"] == "materials_query" and out[0]["deleted"] >= 2
    assert VersionedTable(spark, f"{wh}/materials_query").read().count() == 3


def test_two_streams_and_a_reset_checkpoint_are_no_replays(spark, tmp_dir):
    schema = "k long, v string"
    t = VersionedTable(spark, f"{tmp_dir}/t", ["k"])
    t.provision(spark.createDataFrame([], schema).schema)
    for n in range(2):
        spark.range(n * 100, n * 100 + 100).selectExpr("id AS k", "'x' AS v").write.parquet(f"{tmp_dir}/land{n}")
        incremental_merge(spark, f"{tmp_dir}/land{n}", spark.createDataFrame([], schema).schema, t, ["k"], f"{tmp_dir}/ck{n}")
    assert t.read().count() == 200
    spark.createDataFrame([(1, "new")], schema).write.mode("append").parquet(f"{tmp_dir}/land0")
    incremental_merge(spark, f"{tmp_dir}/land0", spark.createDataFrame([], schema).schema, t, ["k"], f"{tmp_dir}/ck-reset",
                      on_duplicate="latest", order_by=["v"])
    assert t.read().count() == 200


def test_stream_keeps_rejected_rows(spark, tmp_dir):
    from tidesync.models import MATERIALS
    from tidesync.spec import envelope_schema
    from tidesync.streaming.intake import page_records_transform

    land = write_pages(f"{tmp_dir}/pages", [{"Succeed": True, "IsLastPage": True, "Response": [{"PartNumber": "a"}, {"PartNumber": ""}, {"PartNumber": "b"}]}])
    t = VersionedTable(spark, f"{tmp_dir}/t", list(MATERIALS.keys))
    t.provision(MATERIALS.target_schema())
    transform = page_records_transform(MATERIALS, on_error="quarantine", quarantine=f"{tmp_dir}/bad")
    incremental_merge(spark, land, envelope_schema(MATERIALS), t, list(MATERIALS.keys), f"{tmp_dir}/ck", fmt="json", transform=transform)
    assert t.read().count() == 2
    assert [tuple(r["_errors"]) for r in spark.read.parquet(f"{tmp_dir}/bad").collect()] == [("part_number: required",)]
    with pytest.raises(ValueError):
        page_records_transform(MATERIALS, on_error="quarantine")


def test_retry_after_a_crash_between_merge_and_audit(spark, tmp_dir, monkeypatch):
    from tidesync.plans import sync as module

    land, wh = f"{tmp_dir}/landing", f"{tmp_dir}/warehouse"
    _land_one(land, "materials_query", [_record(ALL_SPECS["materials_query"], i) for i in range(2)])
    real = module.append_audit

    def crash(*args, **kwargs):
        raise RuntimeError("lost")

    monkeypatch.setattr(module, "append_audit", crash)
    with pytest.raises(RuntimeError):
        sync(spark, land, wh, "F1", run_id="r1")
    monkeypatch.setattr(module, "append_audit", real)
    sync(spark, land, wh, "F1", run_id="r1")
    sync(spark, land, wh, "F1", run_id="r1")
    assert [(r.inserted_count, r.updated_count) for r in read_audit(spark, f"{wh}/_audit").collect()] == [(2, 0)]
    assert VersionedTable(spark, f"{wh}/materials_query").current_version() == 1


def test_missing_snapshots_are_reported_or_fail(spark, tmp_dir, caplog):
    from tidesync.plans.sync import MissingSnapshotError

    land, wh = f"{tmp_dir}/landing", f"{tmp_dir}/warehouse"
    with pytest.raises(MissingSnapshotError):
        sync(spark, land, wh, "F1")
    _land_one(land, INVENTORY_USAGE.name, [])
    sync(spark, land, wh, "F1")
    assert "no snapshot inventory_query/active" in caplog.text and "needs inventory_query/active" in caplog.text
    with pytest.raises(MissingSnapshotError):
        sync(spark, land, wh, "F1", missing="fail")


def test_sync_leaves_no_staging(spark, tmp_dir):
    from tidesync.session import work_dir

    land, wh = f"{tmp_dir}/landing", f"{tmp_dir}/warehouse"
    _land(land)
    sync(spark, land, wh, "F1")
    assert not [d for d in os.listdir(work_dir(spark)) if d.startswith("sync-staging")]
    assert not any(os.path.exists(f"{wh}/{name}/_staging") for name in ALL_SPECS)
