"""Minimum slice: landed pages -> validate -> merge -> counts."""

from conftest import write_pages

from tidesync.models import MATERIALS
from tidesync.operators.validate import cast_to_target, validate
from tidesync.plans.tables import VersionedTable
from tidesync.sources.pages import read_pages


def _pages():
    return [
        {"Page": 1, "Succeed": True, "IsLastPage": False, "Response": [
            {"PartNumber": "P1", "MaterialName": "salt", "OrderLeadTime": "12", "Extra": 1},
            {"PartNumber": "P2", "MaterialName": "", "OrderLeadTime": " 7 "},
        ]},
        {"Page": 2, "Succeed": False, "IsLastPage": False, "Response": [{"PartNumber": "LOST"}]},
        {"Page": 3, "Succeed": True, "IsLastPage": True, "Response": [
            {"PartNumber": "P3", "Cost": "0000-00-00", "MaterialHidden": 1.0},
        ]},
        {"Page": 4, "Succeed": True, "IsLastPage": True, "Response": [{"PartNumber": "AFTER"}]},
    ]


def test_pages_to_table(spark, tmp_dir):
    land = write_pages(f"{tmp_dir}/land", _pages())
    raw = read_pages(spark, land, MATERIALS)
    good, _ = validate(raw, MATERIALS, on_error="fail")
    rows = {r.part_number: r for r in good.collect()}
    assert set(rows) == {"P1", "P2", "P3"}
    assert rows["P2"].material_name is None
    assert rows["P2"].order_lead_time == 7
    # materials keep zero-date text (the rule is not applied to this table)
    assert rows["P3"].cost == "0000-00-00"
    assert rows["P3"].material_hidden == 1

    t = VersionedTable(spark, f"{tmp_dir}/materials", MATERIALS.keys)
    t.provision(MATERIALS.target_schema())
    src = cast_to_target(good, MATERIALS)
    r1 = t.merge(src)
    assert (r1.inserted, r1.updated) == (3, 0)
    r2 = t.merge(src)
    assert (r2.inserted, r2.updated) == (0, 3)
    assert t.read().count() == 3
    assert t.read().schema == MATERIALS.target_schema() or set(t.read().columns) == set(MATERIALS.names)
