"""Registered workloads for the record types: landed pages in, typed records out.

Each case derives one record type's snapshot from a test table by expressions
that Spark and the oracle's SQL both understand, lands it as JSON pages (some
failed, a stray page after the last one), reads it back and loads it. Filter
cases apply request filters by their own names to the loaded records.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidesync import models as M
from tidesync.operators.dedup import full_dedup, union_snapshots
from tidesync.operators.validate import cast_to_target, project_records, split_valid
from tidesync.session import fresh_dir
from tidesync.sources.records import filtered_records, passing, read_records, record_fields, usable_records
from tidesync.spec import TableSpec


@dataclass(frozen=True)
class Case:
    """A snapshot of ``spec`` made of ``table``: field expressions, the page of a row, which rows make a page fail."""

    spec: TableSpec
    table: str
    key: str
    fields: dict[str, str]
    failed: str
    per_page: int = 40
    where: str = "true"
    twice: str = "false"  # rows that the snapshot repeats
    numbered: bool = True
    filters: dict = field(default_factory=dict)
    passes: str = "true"  # the filters, over the loaded columns


def _text(column: str) -> str:
    return f"CAST({column} AS STRING)"


_MONEY = "CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS STRING)"

CASES = {
    "specifications": Case(
        M.SPECIFICATIONS, "part", "p_partkey",
        {
            "PartNumber": f"'P' || {_text('p_partkey')}", "MaterialName": "p_name", "Version": _text("p_size"),
            "Unit": "CASE WHEN p_size < 10 THEN '' ELSE 'EA' END", "Type": "p_type",
            "EffectiveDate": "CASE WHEN p_size < 5 THEN '0000-00-00 00:00:00' ELSE '2020-01-02 03:04:05' END",
            "Hidden": "CASE WHEN p_size > 25 THEN '1' ELSE ' 0 ' END",
        },
        failed="p_size = 50", numbered=False,
        filters={"TypesContains": "S", "Hidden": 1, "PartNumber": ""}, passes="contains(specification_type, 'S') AND hidden = 1",
    ),
    "materials_planned": Case(
        M.MATERIALS_PLANNED, "orders", "o_orderkey",
        {
            "MaterialPlannedId": f"'MP' || {_text('o_orderkey')}", "PartNumber": _text("o_custkey"), "Version": "'1'",
            "QuantityNeeded": _MONEY, "OrderBy": _text("o_orderdate"),
            "NeedBy": f"CASE WHEN o_orderstatus = 'F' THEN '' ELSE {_text('o_orderdate')} END", "VendorId": _text("o_custkey"), "VendorName": "o_orderpriority",
        },
        failed="o_orderpriority = '1-URGENT' AND o_totalprice > 480000",
        filters={"FromOrderBy": "1996-01-01 00:00:00", "ToNeedBy": "1997-06-30 00:00:00"},
        passes="order_by >= TIMESTAMP '1996-01-01 00:00:00' AND need_by <= TIMESTAMP '1997-06-30 00:00:00'",
    ),
    "requisitions": Case(
        M.REQUISITIONS, "orders", "o_orderkey",
        {
            "RequisitionNumber": f"'RQ' || {_text('o_orderkey')}", "StatusId": "CASE WHEN o_orderstatus = 'F' THEN 2 ELSE 1 END",
            "StatusName": "o_orderstatus", "PartNumber": _text("o_custkey"), "Version": "'2'", "POnumber": f"'PO-' || {_text('o_orderkey')}",
            "MaterialName": "o_orderpriority", "ItemQuantity": _MONEY, "ApprovedByDateTime": _text("o_orderdate"), "VendorName": "''",
        },
        failed="o_orderpriority = '5-LOW' AND o_totalprice > 480000",
        filters={"Status": "O", "FromApprovalDate": "1995-01-01 00:00:00", "ToApprovalDate": "1998-01-01 00:00:00", "POnumberContains": "7"},
        passes="status_name = 'O' AND contains(po_number, '7') AND approved_by_date_time >= TIMESTAMP '1995-01-01 00:00:00' "
        "AND approved_by_date_time <= TIMESTAMP '1998-01-01 00:00:00'",
    ),
    "pending_receipts": Case(
        M.PENDING_RECEIPTS, "customer", "c_custkey",
        {
            "ReceiptNumber": f"'RC' || {_text('c_custkey')}", "PartNumber": _text("c_nationkey"), "MaterialName": "c_name",
            "VendorName": "CASE WHEN c_acctbal < 0 THEN '' ELSE c_mktsegment END", "Status": "c_mktsegment",
            "NeededBy": "CASE WHEN c_acctbal < 0 THEN '0000-00-00' ELSE '2021-03-04 00:00:00' END", "Project": "c_mktsegment",
        },
        failed="c_acctbal > 9990",
        filters={"Project": "BUILDING", "MaterialNameContains": "1"}, passes="project = 'BUILDING' AND contains(material_name, '1')",
    ),
    "inventory": Case(
        M.INVENTORY, "part", "p_partkey",
        {
            "InventoryReceiptNumber": f"'IR' || {_text('p_partkey')}", "PartNumber": _text("p_partkey"), "MaterialName": "p_name",
            "MaterialType": "p_type", "VendorName": "p_brand", "QuantityRemain": "CASE WHEN p_size > 25 THEN '0' ELSE CAST(p_size AS STRING) END",
            "ReceivedDate": "'2019-05-06 07:08:09'", "InventoryStatusId": "CASE WHEN p_size > 25 THEN '9' ELSE '1' END", "Cost": "''",
        },
        failed="p_size = 24",
        filters={"StatusId": "9", "MaterialNameContains": "ring"}, passes="inventory_status_id = '9' AND contains(material_name, 'ring')",
    ),
    "batch_records": Case(
        M.BATCH_PRODUCTION_RECORD, "orders", "o_orderkey",
        {
            "BprId": "o_orderkey", "ProjectTitle": "o_orderpriority", "StatusId": "CASE WHEN o_orderstatus = 'F' THEN '3' ELSE '1.0' END",
            "CreationDate": _text("o_orderdate"), "IssueDate": "CASE WHEN o_orderstatus = 'P' THEN '0000-00-00' ELSE '' END",
            "MPRNumber": f"'M' || {_text('o_custkey')}", "MPRVersionNumber": "'1'", "BatchSize": _MONEY,
        },
        failed="o_totalprice > 490000", twice="o_orderpriority = '1-URGENT'",
        filters={"From": "1996", "To": "1997", "StatusId": 1}, passes="creation_date >= '1996' AND creation_date <= '1997' AND status_id = 1",
    ),
    "master_records": Case(
        M.MASTER_PRODUCTION_RECORD, "part", "p_partkey",
        {
            "ProjectTitle": "p_brand", "StatusId": "p_size", "ProductName": "p_name", "MPRNumber": f"'M' || {_text('p_partkey')}",
            "MPRVersionNumber": _text("p_size"), "CreationDate": "'2018-01-01 00:00:00'", "MaterialTypeName": "p_type", "PartNumber": _text("p_partkey"),
        },
        failed="p_size = 37",
        filters={"MaterialTypeNameContains": "A", "StatusId": 12}, passes="contains(material_type_name, 'A') AND status_id = 12",
    ),
}


def landed_pages(spark: SparkSession, sf_dir: str, case: Case, where: str = "true") -> str:
    """The case's pages, landed as JSON files; returns the folder."""
    rows = spark.read.parquet(f"{sf_dir.rstrip('/')}/{case.table}.parquet").where(f"({case.where}) AND ({where})")
    rows = rows.withColumn("_copies", F.expr(f"sequence(1, IF({case.twice}, 2, 1))")).withColumn("_copy", F.explode("_copies"))
    record = F.struct(*[F.expr(e).alias(f) for f, e in case.fields.items()])
    page = F.floor(F.col(case.key) / case.per_page).cast("long")
    pages = rows.select(page.alias("Page"), record.alias("r"), F.expr(case.failed).alias("bad"))
    pages = pages.groupBy("Page").agg((~F.max("bad")).alias("Succeed"), F.collect_list("r").alias("Response"))
    pages = pages.select("Page", "Succeed", F.lit(False).alias("IsLastPage"), "Response")
    # The last page closes the snapshot; the stray page after it repeats records that must not count.
    last = pages.select(F.max("Page")).first()[0] or 0
    end = spark.createDataFrame([(last + 1, True, True)], "Page long, Succeed boolean, IsLastPage boolean")
    end = end.withColumn("Response", F.array().cast(pages.schema["Response"].dataType))
    stray = pages.where("Succeed").orderBy("Page").limit(1).select(F.lit(last + 2).alias("Page"), "Succeed", "IsLastPage", "Response")
    landed = pages.unionByName(end).unionByName(stray)
    columns = ["Page", "Succeed", "IsLastPage", "Response"] if case.numbered else ["Succeed", "IsLastPage", "Response"]
    folder = fresh_dir(spark, f"landed-{case.spec.name}")
    # Unnumbered pages land in order, as files written one after another would.
    landed = landed if case.numbered else landed.orderBy("Page")
    landed.select(F.to_json(F.struct(*columns)).alias("value")).write.text(folder)
    return folder


def landed_records(spark: SparkSession, sf_dir: str, case: Case) -> list[DataFrame]:
    """The case's records as landed rows, a frame for each of its snapshots."""
    parts = ["p_size <= 25", "p_size > 25"] if case.spec is M.INVENTORY else ["true"]  # active and depleted snapshots
    return [read_records(spark, landed_pages(spark, sf_dir, case, p), case.spec) for p in parts]


def loaded(spark: SparkSession, sf_dir: str, case: Case, filters: dict | None = None) -> DataFrame:
    """Pages -> records that pass the filters -> validation -> row dedup where the type asks for it -> load cast."""
    rows = [record_fields(usable_records(landed), case.spec) for landed in landed_records(spark, sf_dir, case)]
    raw = union_snapshots(*[passing(r, case.spec, filters or {}) for r in rows])
    good, _ = split_valid(project_records(raw, case.spec))
    return cast_to_target(full_dedup(good) if case.spec.dedup_rows else good, case.spec)


def _snapshot_query(case: Case):
    return lambda spark, sf_dir: loaded(spark, sf_dir, case)


def _filter_query(case: Case):
    return lambda spark, sf_dir: loaded(spark, sf_dir, case, case.filters)


def _fields_query(case: Case, fields: list[str]):
    """Some fields of the records that pass: the scan reads the columns of these and of the filtered fields only."""
    return lambda spark, sf_dir: union_snapshots(*[filtered_records(x, case.spec, case.filters, fields) for x in landed_records(spark, sf_dir, case)])


#: Fields that some cases are asked for, beside their filters.
FIELDS = {
    "requisitions": ["requisition_number", "part_number", "version", "item_quantity", "approved_by_date_time"],
    "materials_planned": ["material_planned_id", "vendor_id", "need_by"],
    "inventory": ["inventory_receipt_number", "vendor_name", "received_date"],
}

QUERIES = {f"q_{name}_snapshot": _snapshot_query(case) for name, case in CASES.items()}
QUERIES |= {f"q_{name}_filter": _filter_query(case) for name, case in CASES.items()}
QUERIES |= {f"q_{name}_fields": _fields_query(CASES[name], fields) for name, fields in FIELDS.items()}

_SQL_TYPES = {"str": "VARCHAR", "int": "DECIMAL(38,0)", "datetime": "TIMESTAMP"}


def _loaded_sql(case: Case) -> str:
    """The loaded records in plain SQL over the test table: the rules of every field, the failed pages left out."""
    columns = []
    for f in case.spec.fields:
        raw = f"CAST({case.fields[f.source]} AS VARCHAR)" if f.source in case.fields else "CAST(NULL AS VARCHAR)"
        zero = f" OR contains({raw}, '0000-00-00')" if case.spec.zero_date_to_null else ""
        clean = f"CASE WHEN {raw} = ''{zero} THEN NULL ELSE {raw} END"
        kind = _SQL_TYPES[f.kind]
        columns.append(f"{clean} AS {f.name}" if kind == "VARCHAR" else f"CAST(trim({clean}) AS {kind}) AS {f.name}")
    part = "p_size > 25" if case.spec is M.INVENTORY else "false"
    return f"""
WITH placed AS (
  SELECT *, CAST(floor({case.key} / {case.per_page}.0) AS BIGINT) AS page, {part} AS part FROM {case.table} WHERE {case.where}
), failed AS (
  SELECT page, part FROM placed GROUP BY page, part HAVING bool_or({case.failed})
)
SELECT {', '.join(columns)} FROM placed
WHERE NOT EXISTS (SELECT 1 FROM failed f WHERE f.page = placed.page AND f.part = placed.part)
"""


ORACLE_SQL = {f"q_{name}_snapshot": _loaded_sql(case) for name, case in CASES.items()}
ORACLE_SQL |= {f"q_{name}_filter": f"SELECT * FROM ({_loaded_sql(case)}) AS loaded WHERE {case.passes}" for name, case in CASES.items()}
ORACLE_SQL |= {f"q_{name}_fields": f"SELECT {', '.join(fields)} FROM ({_loaded_sql(CASES[name])}) AS loaded WHERE {CASES[name].passes}" for name, fields in FIELDS.items()}
