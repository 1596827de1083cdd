"""Landed records: shredded VARIANT columns, request filters in the scan, detail pages of asked keys only."""

import glob
import json
import os
import re

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from conftest import write_pages
from tidesync.models import INVENTORY_USAGE, REQUISITIONS
from tidesync.operators.filters import RequestFilterError, request_filter
from tidesync.operators.validate import cast_to_target, project_records, split_valid
from tidesync.session import delete_path
from tidesync.sources.pages import read_pages
from tidesync.sources.records import (
    AT, filtered_records, land_records, of_keys, passing, read_detail_records, read_records, record_fields, usable_records,
)


def record(k, **more):
    return {
        "RequisitionNumber": f"R{k}", "PartNumber": f"P{k % 7}", "Version": "1", "StatusId": [1, "2", " 3 ", "1.0", True][k % 5], "StatusName": "AB"[k % 2],
        "POnumber": f"PO-{k}", "MaterialName": "m" * (k % 9), "ItemQuantity": str(k), "ApprovedByDateTime": f"199{k % 10}-01-02 03:04:05", **more,
    }


def pages_of(count, per_page=20):
    pages = [{"Page": p + 1, "Succeed": p != 1, "IsLastPage": False, "Response": [record(k) for k in range(p * per_page, (p + 1) * per_page)]} for p in range(count)]
    pages.append({"Page": count + 1, "Succeed": True, "IsLastPage": True, "Response": []})
    pages.append({"Page": count + 2, "Succeed": True, "IsLastPage": False, "Response": [record(99_999)]})
    return pages


FILTERS = [
    {},
    {"Status": "A", "POnumberContains": "7"},
    {"FromApprovalDate": "1993-01-01 00:00:00", "ToApprovalDate": "1996-06-01 00:00:00", "PartNumber": ""},
    {"RequisitionNumber": "R44"},
]


def test_filtered_records_equal_filtering_after_the_load(spark, tmp_dir):
    write_pages(f"{tmp_dir}/pages", pages_of(6))
    landed = read_records(spark, f"{tmp_dir}/pages", REQUISITIONS)
    good, _ = split_valid(project_records(read_pages(spark, f"{tmp_dir}/pages", REQUISITIONS).drop("Page"), REQUISITIONS))
    cast_to_target(good, REQUISITIONS).write.parquet(f"{tmp_dir}/loaded")
    loaded = spark.read.parquet(f"{tmp_dir}/loaded")
    for filters in FILTERS:
        want = request_filter(loaded, REQUISITIONS, filters)
        for fields in (want.columns, ["requisition_number", "item_quantity"]):
            got = filtered_records(landed, REQUISITIONS, filters, None if fields == want.columns else fields)
            assert got.columns == fields and dict(got.dtypes) == dict(want.select(*fields).dtypes)
            rows = sorted(map(str, got.collect()))
            assert rows and rows == sorted(map(str, want.select(*fields).collect()))


def test_scan_reads_the_asked_fields_only(spark, tmp_dir):
    write_pages(f"{tmp_dir}/pages", pages_of(40))
    landed = read_records(spark, f"{tmp_dir}/pages", REQUISITIONS, folder=f"{tmp_dir}/landed")

    def scan_of(frame):
        before = spark.conf.get("spark.sql.maxMetadataStringLength")
        spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
        try:
            plan = spark._jvm.PythonSQLUtils.explainString(frame._jdf.queryExecution(), "formatted")
        finally:
            spark.conf.set("spark.sql.maxMetadataStringLength", before)
        return max(len(s.split(",")) for s in re.findall(r"_record:struct<([^>]*)>", plan))

    whole = filtered_records(landed, REQUISITIONS, {"Status": "A"})
    narrow = filtered_records(landed, REQUISITIONS, {"Status": "A"}, ["requisition_number"])
    assert scan_of(whole) >= len(REQUISITIONS.fields)
    assert scan_of(narrow) <= len(REQUISITIONS.keys) + 1  # the keys and the filtered field
    # What those columns take of the files, from the footers: shredded fields are columns of their own.
    sizes = {}
    for name in glob.glob(f"{tmp_dir}/landed/*.parquet"):
        meta = pq.ParquetFile(name).metadata
        for g in range(meta.num_row_groups):
            for c in range(meta.num_columns):
                column = meta.row_group(g).column(c)
                sizes[column.path_in_schema] = sizes.get(column.path_in_schema, 0) + column.total_compressed_size
    asked = sum(n for p, n in sizes.items() if any(f"typed_value.{f}." in p for f in ("StatusName", "RequisitionNumber", "PartNumber", "Version")))
    assert any("typed_value.StatusName.typed_value" in p for p in sizes)
    assert asked < sum(n for p, n in sizes.items() if p.startswith("_record")) / 2


def test_refused_values_reach_the_load(spark, tmp_dir):
    bad = [record(1), record(2, ApprovedByDateTime="not a date"), record(3, ApprovedByDateTime=""), "no record", None, record(4, Extra={"x": 1}), {"RequisitionNumber": None}]
    write_pages(f"{tmp_dir}/pages", [{"Page": 1, "Succeed": True, "IsLastPage": True, "Response": bad}, {"Page": 2, "Succeed": None, "IsLastPage": None, "Response": None}])
    landed = read_records(spark, f"{tmp_dir}/pages", REQUISITIONS)
    assert landed.count() == 8 and usable_records(landed).count() == 7
    rows = passing(record_fields(usable_records(landed), REQUISITIONS, keep=[AT]), REQUISITIONS, {"FromApprovalDate": "1994-01-01 00:00:00"})
    assert sorted(r[0] for r in rows.select(AT).collect()) == [1, 5]  # the unreadable date is not filtered away
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        filtered_records(landed, REQUISITIONS, {"FromApprovalDate": "1994-01-01 00:00:00"}).collect()
    with pytest.raises(RequestFilterError):
        filtered_records(landed, REQUISITIONS, {"Nothing": 1})
    with pytest.raises(KeyError):
        filtered_records(landed, REQUISITIONS, {}, ["nothing"])
    assert record_fields(usable_records(landed), REQUISITIONS).columns == [f.source for f in REQUISITIONS.fields]


def test_empty_landing(spark, tmp_dir):
    write_pages(f"{tmp_dir}/pages", [{"Page": 1, "Succeed": True, "IsLastPage": True, "Response": []}])
    landed = read_records(spark, f"{tmp_dir}/pages", REQUISITIONS)
    assert landed.count() == 1 and filtered_records(landed, REQUISITIONS, {"Status": "A"}).count() == 0
    assert spark.conf.get("spark.sql.variant.writeShredding.enabled", None) is None


KEY = "InventoryReceiptNumber"


def usage_pages(keys):
    for key in keys:
        row = lambda k: {KEY: "WRONG", "UsageSequence": k, "Purpose": key}  # noqa: E731, B023
        yield {KEY: key, "Page": 1, "Succeed": True, "IsLastPage": False, "Response": [row(1), row(2)]}
        yield {KEY: key, "Page": 2, "Succeed": True, "IsLastPage": False, "Response": None}
        yield {KEY: key, "Page": 3, "Succeed": True, "IsLastPage": False, "Response": [row(3)]}


def test_detail_pages_of_asked_keys(spark, tmp_dir):
    write_pages(f"{tmp_dir}/usage", list(usage_pages([f"K{k}" for k in range(50)])))
    keys = spark.createDataFrame([("K3",), ("K3",), (None,), ("K49",), ("absent",)], "receipt string")
    landed = read_detail_records(spark, f"{tmp_dir}/usage", INVENTORY_USAGE, KEY, keys, "receipt", folder=f"{tmp_dir}/landed")
    assert landed.count() == 2 * 4  # two keys: two records, a page without any, a stray record
    rows = record_fields(usable_records(landed), INVENTORY_USAGE, KEY)
    assert sorted((r[KEY], json.loads(str(r.UsageSequence.toJson()))) for r in rows.select(KEY, "UsageSequence").collect()) == [("K3", 1), ("K3", 2), ("K49", 1), ("K49", 2)]
    assert read_detail_records(spark, f"{tmp_dir}/usage", INVENTORY_USAGE, KEY, keys.where("false"), "receipt").count() == 0


def test_many_keys_become_a_bloom_filter_on_the_pages(spark, tmp_dir):
    """Where keys can't be broadcast, the pages' scan drops those of other keys before they are shuffled."""
    write_pages(f"{tmp_dir}/usage", list(usage_pages([f"K{k}" for k in range(400)])))
    spark.read.json(f"{tmp_dir}/usage").select(KEY).distinct().withColumn("status", F.substring(KEY, 2, 1)).write.parquet(f"{tmp_dir}/receipts")
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "1",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        keys = spark.read.parquet(f"{tmp_dir}/receipts").where("status = '1'").select(KEY)
        schema = "InventoryReceiptNumber string, Page long, Succeed boolean, IsLastPage boolean, Response array<variant>"
        pages = of_keys(spark.read.schema(schema).json(f"{tmp_dir}/usage"), keys.withColumnRenamed(KEY, "receipt"), "receipt", KEY)
        plan = pages._jdf.queryExecution().optimizedPlan().toString()
        assert "might_contain" in plan or "mightcontain" in plan.lower()
        landed = land_records(pages, key_field=KEY)
        wanted = [k for k in range(400) if str(k)[0] == "1"]
        assert landed.count() == 4 * len(wanted)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert os.path.exists(f"{tmp_dir}/receipts") and delete_path(spark, f"{tmp_dir}/receipts")


def test_usage_pages_of_lines_take_one_shuffle(spark, tmp_dir):
    """Pages, end pages and late copies of a receipt come from its lines shuffled once; odd keys and numbers keep their pages."""
    import datetime as dt
    import json
    import math

    from tidesync.plans import workloads

    keys = [1, 1, 1, 1, 1, 1, 1, 2, 2, 2, 3, 4, 4, None, None, 5]
    numbers = [1, 2, 3, 4, 5, 6, 7, 1, 1, 2, 4, None, 1, 1, 5, None]
    lines = [(k, n, float(i), "R", dt.datetime(2024, 1, 1)) for i, (k, n) in enumerate(zip(keys, numbers, strict=True))]
    df = spark.createDataFrame(lines, "l_orderkey long, l_linenumber int, l_quantity double, l_returnflag string, l_shipdate timestamp_ntz")
    df.write.parquet(f"{tmp_dir}/lineitem.parquet")
    pages = workloads.usage_pages(spark, tmp_dir)
    assert pages._jdf.queryExecution().sparkPlan().toString().count("collect_list") and pages._jdf.queryExecution().executedPlan().toString().count("Exchange ") == 1
    number = lambda n: None if n is None else math.floor((n - 1) / workloads.USAGE_LINES)
    want, last = {}, {}
    for k, n, q, _, _ in lines:
        want.setdefault((k, number(n)), []).append(q)
        last[k] = max((x for x in (last.get(k), number(n)) if x is not None), default=None)
    again = [(k, last[k] + 2, v) for (k, n), v in want.items() if n == 0 and k is not None]
    ends = [(k, None if n is None else n + 1, None) for k, n in last.items()]
    rows = [json.loads(r.json) for r in pages.collect()]
    found = [(r.get("InventoryReceiptNumber"), r.get("Page"), None if r.get("Response") is None else sorted(float(x["UsedQuantity"]) for x in r["Response"])) for r in rows]
    expected = [(None if k is None else f"R{k}", n, v and sorted(v)) for k, n, v in [*((k, n, v) for (k, n), v in want.items()), *again, *ends]]
    assert sorted(found, key=repr) == sorted(expected, key=repr)
