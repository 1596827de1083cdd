"""Specs: names, type resolution, schemas, request filters."""

import pytest
from pyspark.sql import types as T

from tidesync.models import ALL_SPECS, BATCH_PRODUCTION_RECORD, INVENTORY, MATERIALS, MATERIALS_PLANNED, SPECIFICATIONS
from tidesync.operators.filters import RequestFilterError, request_filter
from tidesync.spec import FieldSpec, TableSpec, envelope_schema, snake_name


def test_snake_names():
    assert snake_name("PartNumber") == "part_number"
    assert snake_name("MPRVersionId") == "mpr_version_id"
    assert snake_name("MFGRetestDate") == "mfg_retest_date"
    assert snake_name("DMS") == "dms"


def test_nine_specs():
    sizes = {k: len(v.fields) for k, v in ALL_SPECS.items()}
    assert sizes == {
        "materials_query": 17, "specifications_query": 7, "materials_planned_query": 10,
        "requisitions_query": 20, "pending_receipts_query": 19, "inventory_query": 40,
        "inventory_usage": 28, "batch_production_record": 24, "master_production_record": 24,
    }
    for spec in ALL_SPECS.values():
        for k in spec.keys:
            assert spec.field(k).required
            assert not spec.target_schema()[k].nullable


def test_union_order_decides_type():
    """First union member decides: datetime|str -> TIMESTAMP, str|datetime -> STRING."""
    assert SPECIFICATIONS.field("effective_date").target_type == T.TimestampNTZType()
    assert BATCH_PRODUCTION_RECORD.field("creation_date").target_type == T.StringType()
    assert MATERIALS.field("order_lead_time").target_type == T.DecimalType(38, 0)


def test_type_reflection_example():
    spec = TableSpec(
        name="example",
        keys=("mock_column",),
        fields=(
            FieldSpec("MockColumn", ("str",), required=True, name="mock_column"),
            FieldSpec("IsActive", ("bool",), name="is_active"),
            FieldSpec("HasPermission", ("bool",), name="has_permission"),
            FieldSpec("HasOptions", ("bool", "int"), name="has_options"),
            FieldSpec("Today", ("datetime",), name="today"),
            FieldSpec("Tomorrow", ("datetime", "str"), name="tomorrow"),
            FieldSpec("Infinity", ("datetime", "str"), name="infinity"),
        ),
    )
    groups = spec.type_groups()
    assert groups["bool"] == ["is_active", "has_permission", "has_options"]
    assert groups["datetime"] == ["today", "tomorrow", "infinity"]
    assert groups["str"] == ["mock_column"]
    assert groups["int"] == []


def test_unknown_type_is_refused():
    with pytest.raises(ValueError):
        FieldSpec("X", ("date",))


def test_envelope_schema():
    env = envelope_schema(MATERIALS)
    assert env.fieldNames() == ["Page", "Succeed", "IsLastPage", "Response"]
    assert isinstance(env["Response"].dataType.elementType["PartNumber"].dataType, T.VariantType)
    assert envelope_schema(MATERIALS, "InventoryReceiptNumber").fieldNames()[0] == "InventoryReceiptNumber"


def test_request_filter(spark):
    df = spark.createDataFrame(
        [("P1", "salt", "raw"), ("P2", "sugar", "raw"), ("P3", "salt block", "pack")],
        "part_number string, material_name string, material_type string",
    )
    assert request_filter(df, MATERIALS, {"PartNumber": "", "MaterialNameContains": "salt"}).count() == 2
    assert request_filter(df, MATERIALS, {"Type": "raw", "MaterialNameContains": "salt"}).count() == 1
    assert request_filter(df, MATERIALS, {"TypesContains": ""}).count() == 3
    assert request_filter(df, MATERIALS, {"TypesContains": "a"}).count() == 3
    with pytest.raises(RequestFilterError):
        request_filter(df, MATERIALS, {"Nonsense": "x"})
    with pytest.raises(RequestFilterError, match="depleted"):
        request_filter(df, INVENTORY, {"ShowDepletedInventory": True})
    planned = spark.sql("SELECT 'M1' AS material_planned_id, TIMESTAMP_NTZ'2024-01-05 00:00:00' AS order_by")
    assert request_filter(planned, MATERIALS_PLANNED, {"FromOrderBy": "2024-01-01", "ToOrderBy": "2024-01-31"}).count() == 1
    assert request_filter(planned, MATERIALS_PLANNED, {"FromOrderBy": "2024-02-01"}).count() == 0
