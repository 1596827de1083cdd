"""Validation rules on landed records (FIXTURES.md section 4 edge rows)."""

import pytest
from conftest import write_pages
from pyspark.errors import ArithmeticException, SparkRuntimeException
from pyspark.sql.utils import AnalysisException  # noqa: F401

from tidesync.models import BATCH_PRODUCTION_RECORD, MATERIALS, SPECIFICATIONS
from tidesync.operators.validate import (
    ERRORS,
    ValidationError,
    cast_to_target,
    error_counts,
    project_records,
    split_valid,
    validate,
)
from tidesync.sources.pages import read_pages


def _project(spark, tmp_dir, spec, records):
    land = write_pages(f"{tmp_dir}/land", [{"Page": 1, "Succeed": True, "IsLastPage": True, "Response": records}])
    return project_records(read_pages(spark, land, spec), spec)


def test_blank_and_zero_dates(spark, tmp_dir):
    rows = _project(spark, tmp_dir, SPECIFICATIONS, [
        {"PartNumber": "A", "Version": "1", "MaterialName": "", "Unit": " ", "Type": "see 0000-00-00",
         "EffectiveDate": "0000-00-00 00:00:00", "Hidden": "3"},
    ]).collect()
    r = rows[0]
    assert r.material_name is None          # "" -> null
    assert r.unit == " "                    # blank kept
    assert r.specification_type is None     # any text containing the zero date
    assert r.effective_date is None
    assert r.hidden == 3
    assert r[ERRORS] == []


def test_materials_keep_zero_date_text(spark, tmp_dir):
    r = _project(spark, tmp_dir, MATERIALS, [{"PartNumber": "A", "Cost": "0000-00-00", "Unit": ""}]).first()
    assert r.cost == "0000-00-00"
    assert r.unit is None


def test_required_and_missing(spark, tmp_dir):
    rows = _project(spark, tmp_dir, SPECIFICATIONS, [
        {"PartNumber": "", "Version": "1"},
        {"Version": "2"},
        {"PartNumber": "B", "Version": "3", "Extra": "dropped"},
    ]).orderBy("version").collect()
    assert rows[0][ERRORS] == ["part_number: required"]
    assert rows[1][ERRORS] == ["part_number: required"]
    assert rows[2][ERRORS] == [] and rows[2].material_name is None
    assert "Extra" not in rows[2].asDict()


@pytest.mark.parametrize("given,expected", [
    ("12", 12), (" 12 ", 12), ("12.0", 12), (12, 12), (12.0, 12), (True, 1), ("-7", -7), ("", None),
])
def test_lax_int_accepts(spark, tmp_dir, given, expected):
    r = _project(spark, tmp_dir, MATERIALS, [{"PartNumber": "A", "OrderLeadTime": given}]).first()
    assert r[ERRORS] == []
    assert r.order_lead_time == expected


@pytest.mark.parametrize("given", ["12.7", 12.5, "twelve", " ", [1]])
def test_lax_int_refuses(spark, tmp_dir, given):
    r = _project(spark, tmp_dir, MATERIALS, [{"PartNumber": "A", "OrderLeadTime": given}]).first()
    assert r[ERRORS] == ["order_lead_time: type not accepted"]


def test_text_field_refuses_number(spark, tmp_dir):
    r = _project(spark, tmp_dir, MATERIALS, [{"PartNumber": 5}]).first()
    assert "part_number: type not accepted" in r[ERRORS]


def test_text_union_stays_text(spark, tmp_dir):
    """Text in a datetime/str field passes validation; the load cast decides."""
    proj = _project(spark, tmp_dir, SPECIFICATIONS, [
        {"PartNumber": "A", "Version": "1", "EffectiveDate": "2024-01-03 10:00:00"},
        {"PartNumber": "B", "Version": "1", "EffectiveDate": "not a date"},
    ])
    good, bad = split_valid(proj)
    assert good.count() == 2 and bad.count() == 0
    soft = cast_to_target(good, SPECIFICATIONS, strict=False).orderBy("part_number").collect()
    assert str(soft[0].effective_date) == "2024-01-03 10:00:00"
    assert soft[1].effective_date is None
    with pytest.raises((SparkRuntimeException, ArithmeticException, Exception)):
        cast_to_target(good, SPECIFICATIONS, strict=True).collect()


def test_str_first_union_stays_string(spark, tmp_dir):
    proj = _project(spark, tmp_dir, BATCH_PRODUCTION_RECORD, [
        {"BprId": "1", "MPRNumber": "M", "MPRVersionNumber": "1", "CreationDate": "2024-01-03"},
    ])
    out = cast_to_target(proj.drop(ERRORS), BATCH_PRODUCTION_RECORD)
    assert dict(out.dtypes)["creation_date"] == "string"
    assert dict(out.dtypes)["bpr_id"] == "decimal(38,0)"


def test_strict_mode_raises_with_sample(spark, tmp_dir):
    land = write_pages(f"{tmp_dir}/land", [{"Page": 1, "Succeed": True, "IsLastPage": True,
                                            "Response": [{"PartNumber": ""}, {"PartNumber": "ok"}]}])
    raw = read_pages(spark, land, MATERIALS)
    with pytest.raises(ValidationError) as e:
        validate(raw, MATERIALS, on_error="fail")
    assert e.value.bad_rows == 1


def test_quarantine_split_and_reasons(spark, tmp_dir):
    land = write_pages(f"{tmp_dir}/land", [{"Page": 1, "Succeed": True, "IsLastPage": True,
                                            "Response": [{"PartNumber": ""}, {"PartNumber": "ok"}, {"PartNumber": "x", "MaterialHidden": "1.5"}]}])
    raw = read_pages(spark, land, MATERIALS)
    good, bad = validate(raw, MATERIALS, on_error="quarantine")
    assert [r.part_number for r in good.collect()] == ["ok"]
    assert bad.count() == 2
    reasons = {r.reason: r.rows for r in error_counts(project_records(raw, MATERIALS)).collect()}
    assert reasons == {"part_number: required": 1, "material_hidden: type not accepted": 1}


def test_typed_inputs(spark):
    """CSV / Parquet frames with typed columns go through the same rules."""
    df = spark.createDataFrame([("A", 3, "x"), ("", None, "0000-00-00")], "PartNumber string, OrderLeadTime int, Cost string")
    rows = project_records(df, MATERIALS).orderBy("part_number").collect()
    assert rows[0].part_number is None and rows[0][ERRORS] == ["part_number: required"]
    assert rows[1].order_lead_time == 3


def test_datetime_only_field_needs_a_readable_value(spark):
    from tidesync.spec import FieldSpec, TableSpec

    spec = TableSpec(name="t", keys=("k",), fields=(FieldSpec("K", required=True), FieldSpec("When", ("datetime",))))
    df = spark.createDataFrame([("a", "2024-01-02 03:04:05"), ("b", "soon"), ("c", "")], "K string, When string")
    errs = {r.k: r[ERRORS] for r in project_records(df, spec).collect()}
    assert errs == {"a": [], "b": ["when: type not accepted"], "c": []}


def test_epoch_number_for_a_date_field(spark, tmp_dir):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        r = _project(spark, tmp_dir, SPECIFICATIONS, [
            {"PartNumber": "A", "Version": "1", "EffectiveDate": 1704067200},
            {"PartNumber": "B", "Version": "1", "EffectiveDate": 1704067200500},
        ]).orderBy("part_number").collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert r[0].effective_date == "2024-01-01T00:00:00.000000"
    assert r[1].effective_date == "2024-01-01T00:00:00.500000"


from hypothesis import HealthCheck, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

_values = st.one_of(st.none(), st.just(""), st.just("0000-00-00"), st.text(alphabet=st.characters(blacklist_categories=("Cs",)), max_size=4), st.integers(-5, 5), st.floats(allow_nan=False, allow_infinity=False, width=32), st.booleans())


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.fixed_dictionaries({"PartNumber": _values, "Version": _values, "Hidden": _values, "EffectiveDate": _values}), max_size=12))
def test_good_plus_quarantined_is_input(spark, tmp_dir, records):
    import uuid

    land = write_pages(f"{tmp_dir}/h-{uuid.uuid4().hex[:8]}", [{"Page": 1, "Succeed": True, "IsLastPage": True, "Response": records}])
    raw = read_pages(spark, land, SPECIFICATIONS)
    good, bad = split_valid(project_records(raw, SPECIFICATIONS))
    assert good.count() + bad.count() == len(records)
    for r in good.collect():
        assert r.part_number is not None and r.version is not None


def test_out_of_range_epoch_is_refused(spark, tmp_dir):
    r = _project(spark, tmp_dir, SPECIFICATIONS, [
        {"PartNumber": "A", "Version": "1", "EffectiveDate": 1.1653562949959680e15 * 1000},
    ]).first()
    assert r.effective_date is None and r[ERRORS] == ["effective_date: type not accepted"]


def test_numbers_keep_all_their_digits(spark):
    from pyspark.sql import functions as F
    from pyspark.sql import types as T

    from tidesync.functions.normalize import convert, variant_kind_column  # noqa: F401

    big = "9" * 38
    rows = spark.createDataFrame([(big,), ("-" + "8" * 30,), ("12.0",), ("12.5",)], "j string").select("j", F.expr("parse_json(j)").alias("v"))
    whole = convert(F.col("v"), T.VariantType(), ("int",), True)
    got = {r.j: (r.value, r.ok) for r in rows.select("j", whole.value.alias("value"), whole.ok.alias("ok")).collect()}
    assert str(got[big][0]) == big and str(got["-" + "8" * 30][0]) == "-" + "8" * 30
    assert got["12.0"][1] and not got["12.5"][1]
    typed = spark.sql(f"SELECT CAST('{big}' AS DECIMAL(38,0)) AS d")
    assert str(typed.select(convert(F.col("d"), T.DecimalType(38, 0), ("int",), True).value).first()[0]) == big


def test_float_numbers_are_rounded_once(spark):
    from pyspark.sql import functions as F
    from pyspark.sql import types as T

    from tidesync.functions.normalize import convert

    d = spark.sql("SELECT CAST('0.0149999999999' AS DECIMAL(20,15)) AS d")
    assert str(d.select(convert(F.col("d"), T.DecimalType(20, 15), ("float",), True).value).first()[0]) == "0.01"


def test_json_null_is_a_missing_value(spark, tmp_dir):
    """An explicit null is as good as no member: fine in optional fields, an error of required ones."""
    for spec in (BATCH_PRODUCTION_RECORD, SPECIFICATIONS):
        given = {f.source: ("1" if f.required else None) for f in spec.fields}
        folder = write_pages(f"{tmp_dir}/{spec.name}", [{"Page": 1, "Succeed": True, "IsLastPage": True, "Response": [given, dict.fromkeys(given)]}])
        rows = project_records(read_pages(spark, folder, spec).drop("Page"), spec).collect()
        assert sorted(sorted(r[ERRORS]) for r in rows) == [[], sorted(f"{f.name}: required" for f in spec.fields if f.required)]
