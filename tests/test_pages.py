"""Landed page envelopes: success filter, last page, detail pages."""

import re

from conftest import write_pages

from tidesync.models import INVENTORY_USAGE, MATERIALS
from tidesync.sources.pages import page_status, read_envelopes, read_pages


def _names(df, col="PartNumber"):
    from pyspark.sql import functions as F
    return sorted(r[0] for r in df.select(F.try_variant_get(F.col(col), "$", "string")).collect())


def test_failed_page_in_the_middle(spark, tmp_dir):
    land = write_pages(f"{tmp_dir}/p", [
        {"Page": 1, "Succeed": True, "IsLastPage": False, "Response": [{"PartNumber": "a"}]},
        {"Page": 2, "Succeed": False, "IsLastPage": False, "Response": [{"PartNumber": "lost"}]},
        {"Page": 3, "Succeed": True, "IsLastPage": True, "Response": [{"PartNumber": "c"}]},
    ])
    assert _names(read_pages(spark, land, MATERIALS)) == ["a", "c"]


def test_pages_after_the_last_page_are_ignored(spark, tmp_dir):
    land = write_pages(f"{tmp_dir}/p", [
        {"Page": 1, "Succeed": True, "IsLastPage": True, "Response": [{"PartNumber": "a"}]},
        {"Page": 2, "Succeed": True, "IsLastPage": False, "Response": [{"PartNumber": "late"}]},
    ])
    assert _names(read_pages(spark, land, MATERIALS)) == ["a"]


def test_failed_last_page_does_not_end(spark, tmp_dir):
    land = write_pages(f"{tmp_dir}/p", [
        {"Page": 1, "Succeed": False, "IsLastPage": True, "Response": []},
        {"Page": 2, "Succeed": True, "IsLastPage": True, "Response": [{"PartNumber": "b"}]},
    ])
    assert _names(read_pages(spark, land, MATERIALS)) == ["b"]


def test_no_last_page_keeps_all_successful(spark, tmp_dir):
    land = write_pages(f"{tmp_dir}/p", [
        {"Page": 1, "Succeed": True, "IsLastPage": False, "Response": [{"PartNumber": "a"}]},
        {"Page": 2, "Succeed": True, "IsLastPage": False, "Response": [{"PartNumber": "b"}]},
    ])
    assert _names(read_pages(spark, land, MATERIALS)) == ["a", "b"]


def test_usage_pages_per_key(spark, tmp_dir):
    land = write_pages(f"{tmp_dir}/u", [
        {"InventoryReceiptNumber": "R1", "Page": 1, "Succeed": True, "IsLastPage": False,
         "Response": [{"UsageSequence": 1, "InventoryReceiptNumber": "WRONG"}]},
        {"InventoryReceiptNumber": "R1", "Page": 2, "Succeed": True, "IsLastPage": True,
         "Response": [{"UsageSequence": 2}]},
        {"InventoryReceiptNumber": "R2", "Page": 1, "Succeed": True, "IsLastPage": False, "Response": None},
        {"InventoryReceiptNumber": "R2", "Page": 2, "Succeed": True, "IsLastPage": True,
         "Response": [{"UsageSequence": 9}]},
    ])
    rows = read_pages(spark, land, INVENTORY_USAGE, key_field="InventoryReceiptNumber")
    got = sorted((r.InventoryReceiptNumber, r.Page) for r in rows.collect())
    # R1 rows are tagged with the key that fetched them; R2 ends at the null page.
    assert got == [("R1", 1), ("R1", 2)]


def test_page_status(spark, tmp_dir):
    land = write_pages(f"{tmp_dir}/p", [
        {"Page": 1, "Succeed": True, "IsLastPage": False, "Response": [{"PartNumber": "a"}, {"PartNumber": "b"}]},
        {"Page": 2, "Succeed": False, "IsLastPage": False, "Response": None},
        {"Page": 3, "Succeed": True, "IsLastPage": True, "Response": []},
    ])
    st = {r.Page: (r.records, r.used) for r in page_status(read_envelopes(spark, land, MATERIALS)).collect()}
    assert st == {1: (2, True), 2: (0, False), 3: (0, True)}


def test_text_landing_mode(spark, tmp_dir):
    from tidesync.operators.validate import ERRORS, project_records

    land = write_pages(f"{tmp_dir}/p", [
        {"Page": 1, "Succeed": True, "IsLastPage": True, "Response": [{"PartNumber": 5, "OrderLeadTime": "12.0"}]},
    ])
    r = project_records(read_pages(spark, land, MATERIALS, values="text"), MATERIALS).first()
    assert r.part_number == "5" and r.order_lead_time == 12 and r[ERRORS] == []
    strict = project_records(read_pages(spark, land, MATERIALS), MATERIALS).first()
    assert strict[ERRORS] == ["part_number: type not accepted"]


def test_strict_failed_pages(spark, tmp_dir):
    import pytest

    from tidesync.sources.pages import FailedPagesError, check_pages

    ok = write_pages(f"{tmp_dir}/ok", [
        {"Page": 1, "Succeed": True, "IsLastPage": True, "Response": [{"PartNumber": "a"}]},
        {"Page": 2, "Succeed": False, "IsLastPage": False, "Response": None},   # after the end: ignored
    ])
    check_pages(read_envelopes(spark, ok, MATERIALS))
    bad = write_pages(f"{tmp_dir}/bad", [
        {"Page": 1, "Succeed": False, "IsLastPage": False, "Response": None},
        {"Page": 2, "Succeed": True, "IsLastPage": True, "Response": [{"PartNumber": "a"}]},
    ])
    with pytest.raises(FailedPagesError):
        check_pages(read_envelopes(spark, bad, MATERIALS))


def test_malformed_page_fails_the_read(spark, tmp_dir):
    import os

    import pytest

    folder = f"{tmp_dir}/m"
    os.makedirs(folder)
    with open(f"{folder}/p.json", "w") as f:
        f.write('{"Page": 1, "Succeed": true, "IsLastPage": true, "Response": [{"PartNumber": "a"}]}\n')
        f.write('{"Page": 2, "Succeed": tru\n')
    with pytest.raises(Exception):
        read_pages(spark, folder, MATERIALS).count()
    tolerant = read_envelopes(spark, folder, MATERIALS, mode="PERMISSIVE")
    assert tolerant.filter("Page = 1").count() == 1


def test_pages_without_a_number_are_ordered_by_file_then_line(spark, tmp_dir):
    page = lambda name, last=False, ok=True: {"Succeed": ok, "IsLastPage": last, "Response": [{"PartNumber": name}]}
    land = write_pages(f"{tmp_dir}/p", [page("a"), page("b", ok=False), page("c")], name="page-2.json")
    write_pages(land, [page("d"), page("e", last=True), page("late")], name="page-10.json")
    write_pages(land, [page("later")], name="page-11.json")
    assert _names(read_pages(spark, land, MATERIALS)) == ["a", "c", "d", "e"]
    status = {r.n: r.used for r in page_status(read_envelopes(spark, land, MATERIALS)).selectExpr("used", "records AS n").collect()}
    assert status


def test_strict_mode_sees_failed_pages_without_a_number(spark, tmp_dir):
    import pytest

    from tidesync.sources.pages import FailedPagesError, check_pages

    land = write_pages(f"{tmp_dir}/p", [{"Succeed": False, "IsLastPage": False, "Response": None}, {"Succeed": True, "IsLastPage": True, "Response": []}])
    with pytest.raises(FailedPagesError):
        check_pages(read_envelopes(spark, land, MATERIALS))
    late = write_pages(f"{tmp_dir}/q", [{"Succeed": True, "IsLastPage": True, "Response": []}, {"Succeed": False, "IsLastPage": False, "Response": None}])
    assert check_pages(read_envelopes(spark, late, MATERIALS)).count() == 2


def test_pages_that_cannot_be_ordered_fail(spark, tmp_dir):
    import pytest

    from tidesync.sources.pages import records_from_envelopes
    from tidesync.spec import envelope_schema

    mixed = write_pages(f"{tmp_dir}/m", [{"Page": 1, "Succeed": True, "IsLastPage": True, "Response": []}, {"Succeed": True, "IsLastPage": False, "Response": []}])
    with pytest.raises(Exception, match="mixes numbered"):
        read_pages(spark, mixed, MATERIALS).collect()
    env = spark.createDataFrame([(None, True, True, [])], envelope_schema(MATERIALS, values="text"))
    with pytest.raises(Exception, match="neither a number"):
        records_from_envelopes(env).collect()


def test_one_scan_of_the_pages_with_their_records(spark, tmp_dir):
    from tidesync.sources.pages import land_pages, records_from_envelopes

    land = write_pages(f"{tmp_dir}/p", [{"Page": 1, "Succeed": True, "IsLastPage": True, "Response": [{"PartNumber": "a"}]}])
    rows = records_from_envelopes(land_pages(read_envelopes(spark, land, MATERIALS)))
    rows.collect()
    plan = rows._jdf.queryExecution().executedPlan().toString()
    scans = {re.sub(r"#\d+L?", "", x) for x in re.findall(r"FileScan (\w+ \[[^\]]*\])", plan)}
    # the records once; where the snapshot ends from the flag columns alone
    assert scans == {"parquet [Page,Succeed,Response,_position]", "parquet [Page,Succeed,IsLastPage,_position]"}
