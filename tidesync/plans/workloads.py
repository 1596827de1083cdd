"""Registered workloads over the driver's test tables, with SQL oracles.

Each ``q_*`` takes ``(spark, sf_dir)`` and returns a lazy DataFrame built with
this library's operators over whole tables (no id subsets, no row caps). The
matching entry in :data:`ORACLE_SQL` computes the same result in plain SQL on
the same Parquet tables, for an independent check. Every computed column is
aliased identically on both sides.

Where a workload needs data in a form the test tables do not have (snapshot
pages, XML, CSV files, a landing folder), it derives that form from the
tables with Spark, by rules on the data values, so the work grows with them.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidesync.functions.dates import backfill_slices, in_yesterday, rows_per_slice, slices_by_year
from tidesync.functions.normalize import clean_text, convert, json_members, quote_identifier
from tidesync.operators.dedup import dedup_except, digest_dedup, duplicate_count, full_dedup, union_snapshots
from tidesync.operators.filters import lower_columns, rename_project, request_filter, snapshot_filter, tag, unescape_columns
from tidesync.operators.keys import delete_by_keys, deleted_rows, detail_lookup
from tidesync.operators.merge import ACTION, action_counts, latest_by_key, merge_rows, prepare_source
from tidesync.operators.route import database_for, read_routed, write_routed
from tidesync.operators.validate import ERRORS, cast_to_target, error_counts, project_records, split_valid
from tidesync.plans import snapshots
from tidesync.plans.backfill import pending_slices, read_slices
from tidesync.plans.audit import append_audit, append_metrics, read_audit, stable_id, table_counts
from tidesync.plans.sync import sync
from tidesync.plans.tables import VersionedTable, read_json, write_date_partitioned, write_json, write_parquet
from tidesync.session import fresh_dir
from tidesync.sources.csv_types import read_csv_typed
from tidesync.sources.files import base_name, list_files, parse_xml_column, read_csv_files, read_parquet, read_xml_documents
from tidesync.sources.pages import land_pages, records_from_envelopes
from tidesync.sources.records import land_records, of_keys, record_fields, usable_records
from tidesync.sources.sql import sql_to_strings
from tidesync.sources.xml import read_xml_record_variants, read_xml_variants, xml_root, xml_text
from tidesync.spec import FieldSpec, TableSpec, envelope_schema
from tidesync.models import INVENTORY_USAGE, MATERIALS, SPECIFICATIONS
from tidesync.streaming.intake import incremental_merge

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# ---------------------------------------------------------------------------
# Specs for records derived from the test tables
# ---------------------------------------------------------------------------

TURN_SPEC = TableSpec(
    name="conversation_turns",
    keys=("conv_id", "turn"),
    fields=(
        FieldSpec("ConvId", ("int",), required=True, name="conv_id"),
        FieldSpec("Turn", ("int",), required=True),
        FieldSpec("Role"),
        FieldSpec("Text"),
    ),
)

ORDER_SPEC = TableSpec(
    name="orders_snapshot",
    keys=("order_key",),
    fields=(
        FieldSpec("OrderKey", ("int",), required=True),
        FieldSpec("CustKey", ("int",)),
        FieldSpec("OrderStatus", required=True),
        FieldSpec("TotalPrice", ("float",)),
        FieldSpec("OrderDate", ("datetime", "str")),
        FieldSpec("OrderPriority"),
    ),
)

CUSTOMER_SPEC = TableSpec(
    name="customer_records",
    keys=("cust_key",),
    fields=(
        FieldSpec("CustKey", ("int",), required=True),
        FieldSpec("Name", required=True),
        FieldSpec("Segment", required=True),
        FieldSpec("AcctBal", ("float",)),
    ),
)

PART_SPEC = TableSpec(
    name="part_records",
    keys=("part_key",),
    fields=(
        FieldSpec("PartKey", ("int",), required=True),
        FieldSpec("Name"),
        FieldSpec("Brand"),
        FieldSpec("Size", ("int",)),
    ),
)

LINE_SPEC = TableSpec(
    name="line_records",
    keys=("order_key", "line_number"),
    fields=(
        FieldSpec("OrderKey", ("int",), required=True),
        FieldSpec("LineNumber", ("int",), required=True),
        FieldSpec("Quantity", ("int",)),
        FieldSpec("ExtendedPrice", ("float",)),
        FieldSpec("Discount", ("Decimal",)),
        FieldSpec("Returned", ("bool",)),
        FieldSpec("ShipDate", ("datetime", "str")),
        FieldSpec("ReturnFlag"),
        FieldSpec("Flags", ("list",)),
    ),
)

# Fixed parameters of the workloads (shared with the oracle SQL below).
MERGE_TARGET_BEFORE = "1998-01-01 00:00:00"
MERGE_SOURCE_FROM = "1997-01-01 00:00:00"
LINE_TARGET_BEFORE = "2000-01-01 00:00:00"
LINE_SOURCE_FROM = "1999-01-01 00:00:00"
BACKFILL_START = "2023-12-15"
BACKFILL_AS_OF = "2024-03-20"
LOADED_FROM = "2024-01-04"
LOADED_AS_OF = "2024-01-23"
YESTERDAY_AS_OF = "2024-01-16"
AUDIT_CLOCK = "2024-01-01T00:00:00+00:00"


def _ts(s: str):
    return F.expr(f"TIMESTAMP_NTZ'{s}'")


# ---------------------------------------------------------------------------
# Sources
# ---------------------------------------------------------------------------


def conversation_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed-page envelopes (as JSON text) built from ``conversations``.

    One snapshot per conversation; a page holds the turns ``4(p-1) .. 4p-1``
    (so at most four records). A page holding a system turn failed; a page
    from page 2 on holding a user turn is flagged as the last page.
    """
    conv = table(spark, sf_dir, "conversations")
    rec = F.struct(
        F.col("conv_id").alias("ConvId"),
        F.col("turn").alias("Turn"),
        F.col("role").alias("Role"),
        F.col("text").alias("Text"),
    )
    pages = (
        conv.withColumn("page", F.floor(F.col("turn") / 4).cast("long") + 1)
        .groupBy("conv_id", "page")
        .agg(
            F.collect_list(rec).alias("Response"),
            F.max(F.col("role") == "system").alias("has_system"),
            F.max(F.col("role") == "user").alias("has_user"),
        )
    )
    env = F.struct(
        F.col("conv_id"),
        F.col("page").alias("Page"),
        (~F.col("has_system")).alias("Succeed"),
        (F.col("has_user") & (F.col("page") >= 2)).alias("IsLastPage"),
        F.col("Response"),
    )
    return pages.select(F.to_json(env).alias("json"))


def q_page_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1 + P14: parse pages, keep successful pages up to the last page, explode."""
    schema = envelope_schema(TURN_SPEC)
    schema = T.StructType([T.StructField("conv_id", T.LongType())] + list(schema.fields))
    env = land_pages(conversation_pages(spark, sf_dir).select(F.from_json("json", schema).alias("e")).select("e.*"))
    rows = records_from_envelopes(env, snapshot_cols=("conv_id",)).drop("conv_id")
    good = project_records(rows, TURN_SPEC, keep=["Page"])
    return good.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("Page").alias("page"),
        "turn",
        "role",
        "text",
        (F.size(ERRORS) == 0).alias("valid"),
    )


def q_detail_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J1 + S2 + P12: detail rows for the active keys, repeats kept, tagged."""
    orders = table(spark, sf_dir, "orders")
    active = orders.filter(F.col("o_orderstatus") == "O").select("o_orderkey")
    again = orders.filter((F.col("o_orderstatus") == "O") & (F.col("o_orderpriority") == "1-URGENT")).select("o_orderkey")
    keys = union_snapshots(active, again)
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")
    out = detail_lookup(keys, "o_orderkey", li, "l_orderkey")
    return tag(out, "request_key", F.col("l_orderkey"))


def q_union_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bag union of two overlapping snapshots."""
    orders = table(spark, sf_dir, "orders")
    active = orders.filter(F.col("o_orderstatus").isin("O", "P")).withColumn("snapshot", F.lit("active"))
    depleted = orders.filter(F.col("o_orderstatus").isin("F", "P")).withColumn("snapshot", F.lit("depleted"))
    return union_snapshots(active, depleted)


def q_rename_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Aliased projection; undeclared columns dropped, missing ones null."""
    part = table(spark, sf_dir, "part")
    out = rename_project(
        part,
        {"p_partkey": "part_number", "p_name": "material_name", "p_type": "material_type", "p_brand": "brand", "Unit": "unit"},
    )
    return out.withColumn("unit", F.col("unit").cast("string"))


def _customer_text(c: DataFrame) -> DataFrame:
    seg = F.col("c_mktsegment")
    raw = (
        F.when(seg == "BUILDING", F.lit(""))
        .when(seg == "MACHINERY", F.concat(F.lit("0000-00-00 "), F.col("c_name")))
        .when(seg == "HOUSEHOLD", F.lit(" "))
        .otherwise(F.col("c_name"))
    )
    return c.withColumn("raw", raw)


def q_blank_to_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P2 + P3: blanks and zero-date text to null (and the blank-only rule)."""
    c = _customer_text(table(spark, sf_dir, "customer"))
    return c.select(
        "c_custkey",
        "raw",
        clean_text(F.col("raw"), zero_dates=True).alias("cleaned"),
        clean_text(F.col("raw"), zero_dates=False).alias("blank_only"),
    )


def _customer_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _customer_text(table(spark, sf_dir, "customer"))
    return c.select(
        F.col("c_custkey").alias("CustKey"),
        F.when(F.col("c_mktsegment") == "MACHINERY", F.col("raw")).otherwise(F.col("c_name")).alias("Name"),
        F.when(F.col("c_mktsegment") == "BUILDING", F.col("raw")).otherwise(F.col("c_mktsegment")).alias("Segment"),
        F.col("c_acctbal").alias("AcctBal"),
    )


def q_required_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P4 + P7: required-field check; valid rows and quarantine counts by reason."""
    return error_counts(project_records(_customer_records(spark, sf_dir), CUSTOMER_SPEC), with_valid=True)


def q_lax_int(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P5: whole numbers written as text are accepted, fractions refused."""
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey").cast("string")
    text = (
        F.when(F.col("o_orderpriority") == "1-URGENT", F.concat(k, F.lit(".7")))
        .when(F.col("o_orderstatus") == "O", k)
        .when(F.col("o_orderstatus") == "F", F.concat(F.lit(" "), k, F.lit(" ")))
        .otherwise(F.concat(k, F.lit(".0")))
    )
    t = o.select("o_orderkey", text.alias("text"))
    conv = convert(F.col("text"), T.StringType(), ("int",), zero_dates=True)
    return t.select("o_orderkey", "text", conv.value.alias("value"), conv.ok.alias("ok"))


def q_cast_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P11 (+ P5): typed validation then the load cast to seven target types."""
    li = table(spark, sf_dir, "lineitem")
    src = li.select(
        F.col("l_orderkey").alias("OrderKey"),
        F.col("l_linenumber").alias("LineNumber"),
        F.col("l_quantity").alias("Quantity"),
        F.col("l_extendedprice").alias("ExtendedPrice"),
        F.col("l_discount").alias("Discount"),
        F.when(F.col("l_returnflag") == "R", F.lit("true")).otherwise(F.lit("false")).alias("Returned"),
        F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss").alias("ShipDate"),
        F.col("l_returnflag").alias("ReturnFlag"),
        F.array("l_returnflag", "l_linestatus").alias("Flags"),
    )
    projected = project_records(src, LINE_SPEC)
    return cast_to_target(projected.drop(ERRORS), LINE_SPEC)


def q_snapshot_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Equality, containment and inclusive date range; blank filters skipped."""
    o = table(spark, sf_dir, "orders")
    return snapshot_filter(
        o,
        equals={"o_orderstatus": "O", "o_custkey": ""},
        contains={"o_orderpriority": "HIGH"},
        between={"o_orderdate": ("1996-01-01 00:00:00", "1997-12-31 23:59:59")},
    )


def q_json_member(spark: SparkSession, sf_dir: str) -> DataFrame:
    """member access on JSON text."""
    e = table(spark, sf_dir, "events")
    return json_members(e, "props", {"k": ("$.k", "bigint")}).select("event_id", "k")


def _dup_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return union_snapshots(li, li.filter(F.col("l_returnflag") == "R"))


def q_full_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole-row dedup."""
    return full_dedup(_dup_input(spark, sf_dir))


def q_digest_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole-row dedup of wide rows that seldom repeat: digests first, rows move only where theirs repeats."""
    documents = table(spark, sf_dir, "documents")
    return digest_dedup(union_snapshots(documents, documents.where("lang = 'es'")))


def q_duplicate_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3: rows beyond the first of each identical group."""
    return duplicate_count(_dup_input(spark, sf_dir))


def q_subset_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dedup on all columns but the id, nested values allowed, least id kept."""
    e = table(spark, sf_dir, "embeddings")
    copies = e.filter(F.col("label") == 0).withColumn("vec_id", F.col("vec_id") - F.lit(1_000_000))
    d = dedup_except(union_snapshots(e, copies), ignore=["vec_id"], keep_first_by=["vec_id"])
    return d.select("vec_id", "label", F.size("embedding").alias("dims"))


def _merge_inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    o = table(spark, sf_dir, "orders")
    target = o.filter(F.col("o_orderdate") < _ts(MERGE_TARGET_BEFORE)).select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"
    )
    source = o.filter(F.col("o_orderdate") >= _ts(MERGE_SOURCE_FROM)).select(
        "o_orderkey",
        F.when(F.col("o_orderpriority") == "5-LOW", F.lit(None).cast("string")).otherwise(F.col("o_orderstatus")).alias("o_orderstatus"),
        (F.col("o_totalprice") + F.lit(1.0)).alias("o_totalprice"),
    )
    return target, source


def q_merge_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table after the upsert, with each row's action."""
    target, source = _merge_inputs(spark, sf_dir)
    return merge_rows(target, source, ["o_orderkey"], on_duplicate="error").withColumnRenamed(ACTION, "action")


def q_merge_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J2 + J3 with null keys on both sides: they match nothing, are no duplicates, and all stay."""
    target, source = _merge_inputs(spark, sf_dir)
    target = target.withColumn("o_orderkey", F.when(F.col("o_orderpriority") != "3-MEDIUM", F.col("o_orderkey")))
    source = source.withColumn("o_orderkey", F.when(F.col("o_orderstatus").isNotNull(), F.col("o_orderkey")))
    src = prepare_source(source, ["o_orderkey"], "latest", ["o_totalprice"])
    return merge_rows(target, src, ["o_orderkey"], on_duplicate="error").withColumnRenamed(ACTION, "action")


def q_merge_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J2 + A1: inserted / updated / kept counts of the upsert."""
    target, source = _merge_inputs(spark, sf_dir)
    return action_counts(merge_rows(target, source, ["o_orderkey"]))


def q_merge_composite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J2 on a two-column key, never null; both sides made unique by latest ship date."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_shipdate", "l_quantity", "l_extendedprice", "l_returnflag"
    )
    keys = ["l_orderkey", "l_linenumber"]
    target = latest_by_key(li.filter(F.col("l_shipdate") < _ts(LINE_TARGET_BEFORE)), keys, ["l_shipdate"], null_keys=False)
    src = li.filter(F.col("l_shipdate") >= _ts(LINE_SOURCE_FROM)).withColumn("l_quantity", F.col("l_quantity") + F.lit(1.0))
    src = prepare_source(src, keys, "latest", ["l_shipdate"], null_keys=False)
    return merge_rows(target, src, keys, null_keys=False).withColumnRenamed(ACTION, "action")


def q_merge_duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A source with repeated keys, reduced to the latest row per key, merged."""
    target, _ = _merge_inputs(spark, sf_dir)
    o = table(spark, sf_dir, "orders").filter(F.col("o_orderdate") >= _ts(MERGE_SOURCE_FROM))
    base = o.select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    later = o.filter(F.col("o_orderstatus") == "P").select(
        "o_orderkey",
        F.lit("F").alias("o_orderstatus"),
        (F.col("o_totalprice") + F.lit(5.0)).alias("o_totalprice"),
        (F.col("o_orderdate") + F.expr("INTERVAL 30 DAYS")).alias("o_orderdate"),
    )
    src = prepare_source(union_snapshots(base, later), ["o_orderkey"], "latest", ["o_orderdate"], null_keys=False)
    return merge_rows(target, src, ["o_orderkey"], null_keys=False).withColumnRenamed(ACTION, "action")


def _width(spark: SparkSession) -> int:
    """Folders of a hash layout: as wide as the session's shuffles, so it grows with the cluster's setting."""
    return max(4, int(spark.conf.get("spark.sql.shuffle.partitions")))


def q_table_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J2 + K3 on a versioned table: provision, load the target snapshot,
    upsert the source snapshot (strategy chosen by measured source size),
    read the latest version back."""
    target, source = _merge_inputs(spark, sf_dir)
    tbl = VersionedTable(spark, fresh_dir(spark, "upsert"), ["o_orderkey"])
    tbl.provision(target.schema)
    tbl.merge(target)
    tbl.merge(source)
    return tbl.read()


def small_delta_table(spark: SparkSession, sf_dir: str) -> VersionedTable:
    """``orders`` in the hash layout after a delta of the largest orders, which fall in few of its partitions."""
    orders = table(spark, sf_dir, "orders")
    tbl = VersionedTable(spark, fresh_dir(spark, "delta"), ["o_orderkey"], hash_partitions=4 * _width(spark))
    tbl.provision(orders.schema)
    tbl.merge(orders)
    # One delta row per 10,000 order keys: the largest order among them.
    top = orders.groupBy(F.floor(F.col("o_orderkey") / 10000).alias("block")).agg(F.max(F.struct("o_totalprice", "o_orderkey")).alias("t"))
    tbl.merge(top.select(F.col("t.o_orderkey").alias("o_orderkey"), F.lit("X").alias("o_orderstatus")))
    return tbl


def q_small_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J2 on the hash layout: a small delta rewrites only the partitions its keys fall in."""
    return small_delta_table(spark, sf_dir).read()


def q_table_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J4 on a versioned table: rows by key list deleted, the count of the change beside each row left."""
    orders = table(spark, sf_dir, "orders")
    tbl = VersionedTable(spark, fresh_dir(spark, "delete"), ["o_orderkey"], hash_partitions=_width(spark))
    tbl.provision(orders.schema)
    tbl.merge(orders)
    deleted = tbl.delete_keys(orders.where("o_orderpriority = '5-LOW'").select("o_orderkey"), "o_orderkey")
    return tbl.read().withColumn("deleted_count", F.lit(deleted).cast("long"))


def _delete_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return c.filter(F.col("c_mktsegment") == "AUTOMOBILE").select(F.col("c_custkey").alias("key"))


def q_delete_by_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table after deleting every row whose key is listed."""
    return delete_by_keys(table(spark, sf_dir, "orders"), _delete_keys(spark, sf_dir), "key", "o_custkey")


def q_delete_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The deleted-row count."""
    gone = deleted_rows(table(spark, sf_dir, "orders"), _delete_keys(spark, sf_dir), "key", "o_custkey")
    return gone.agg(F.count(F.lit(1)).alias("deleted_count"))


def q_table_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2: audit-shaped row count per table."""
    tables = {name: table(spark, sf_dir, name) for name in TABLES}
    return table_counts(tables, f_number="F0001", api="testdata", inserted_at=AUDIT_CLOCK)


def q_tenant_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K4: target database per row (tenant, restricted or shared)."""
    c = table(spark, sf_dir, "customer")
    tenant = F.concat(F.lit("F"), F.lpad(F.col("c_nationkey").cast("string"), 4, "0"))
    db = database_for(tenant, F.col("c_acctbal") < 0, F.col("c_mktsegment") == "BUILDING", "RESTRICTED_DB", "SHARED_DB")
    return c.select("c_custkey", db.alias("database"))


def q_date_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2: write with a year=/month=/day= layout, read back, count per day."""
    path = fresh_dir(spark, "date-partition")
    write_date_partitioned(table(spark, sf_dir, "events"), path, "ts")
    back = spark.read.parquet(path)
    return back.groupBy("year", "month", "day").agg(F.count(F.lit(1)).alias("rows"))


def q_backfill_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D1 + A4: monthly backfill slices with the rows that fall in each."""
    return rows_per_slice(table(spark, sf_dir, "events"), "ts", BACKFILL_START, BACKFILL_AS_OF)


def q_backfill_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2 + D1: the events of the days that a backfill still has to load, read from the partitioned layout by those days alone."""
    path = fresh_dir(spark, "backfill")
    write_date_partitioned(table(spark, sf_dir, "events"), path, "ts")
    loaded = backfill_slices(spark, LOADED_FROM, LOADED_AS_OF)
    pending = pending_slices(backfill_slices(spark, BACKFILL_START, BACKFILL_AS_OF), loaded)
    return read_slices(spark, path, pending, "ts").select("event_id", "ts", "event_type", "value", "slice_start")


def q_yesterday(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the day before a fixed as-of date (00:00:00 .. 23:59:59)."""
    e = table(spark, sf_dir, "events")
    return e.filter(in_yesterday(F.col("ts"), YESTERDAY_AS_OF)).select("event_id", "ts", "user_id", "event_type", "value")


def q_slices_by_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4: backfill slices with their rows, grouped by year in order."""
    per_slice = rows_per_slice(table(spark, sf_dir, "events"), "ts", BACKFILL_START, BACKFILL_AS_OF)
    grouped = slices_by_year(per_slice)
    rows = per_slice.groupBy("year").agg(F.sum("rows").cast("long").alias("rows"))
    return grouped.join(rows, "year").select(
        "year",
        F.size("slices").alias("slices"),
        F.col("slices")[0]["start"].alias("first_start"),
        F.element_at("slices", -1)["end"].alias("last_end"),
        "rows",
    )


def q_merge_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1 + K5: the audit row of an upsert (counts from the merge itself), appended twice with one id."""
    target, source = _merge_inputs(spark, sf_dir)
    counts = action_counts(merge_rows(target, source, ["o_orderkey"]))
    row = counts.select(
        F.lit("F0001").alias("f_number"),
        F.lit("testdata").alias("api"),
        F.lit(AUDIT_CLOCK).alias("inserted_at"),
        "inserted_count",
        "updated_count",
        F.lit("orders").alias("table_name"),
        F.lit(stable_id("run-1", "orders")).alias("id"),
    )
    path = fresh_dir(spark, "audit")
    for _ in range(2):
        append_audit(spark, path, row)
    return read_audit(spark, path)


def q_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K6: a metric row with lower-cased names, values as text."""
    o = table(spark, sf_dir, "orders").agg(F.count("*").alias("Rows"), F.countDistinct("o_custkey").alias("Customers")).first()
    path = fresh_dir(spark, "metrics")
    append_metrics(spark, path, o.asDict())
    return spark.read.parquet(path)


def q_unescape_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P9 + P10: escaped column names restored, then lowercased."""
    p = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("PartKey"),
        F.col("p_name").alias("Part_underscore____Name"),
        F.col("p_brand").alias("Brand__dot__Name"),
    )
    return lower_columns(unescape_columns(p))


def q_quoted_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P10: names that need quoting, in DDL and in statements."""
    t, c = quote_identifier(f"odd-name {uuid.uuid4().hex}"), quote_identifier("Part `Name`")
    table(spark, sf_dir, "part").select(F.col("p_partkey"), F.col("p_name").alias("Part `Name`")).createOrReplaceTempView(t)
    return spark.sql(f"SELECT p_partkey, {c} AS part_name FROM {t}")


def q_request_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1a + P13: request filters by name (contains, range, blank skipped)."""
    p = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("part_key"),
        F.col("p_name").alias("name"),
        F.col("p_brand").alias("brand"),
        F.col("p_size").alias("size"),
    )
    return request_filter(p, PART_SPEC, {"NameContains": "ring", "Brand": "", "FromSize": 10, "ToSize": 30})


def q_json_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K7: rows written as line-delimited JSON and read back with their schema."""
    e = table(spark, sf_dir, "events")
    path = write_json(e, fresh_dir(spark, "json"))
    return read_json(spark, path, e.schema)


def q_parquet_gzip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1 + S4: rows written as gzip Parquet and read back."""
    li = table(spark, sf_dir, "lineitem")
    return read_parquet(spark, write_parquet(li, fresh_dir(spark, "gzip")))


def _xml_text(c):
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(c, "&", "&amp;"), "<", "&lt;"), ">", "&gt;")


def q_xml_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One XML document per part; SMALL parts arrive truncated (broken)."""
    p = table(spark, sf_dir, "part")
    doc = F.concat(
        F.lit('<part id="'), F.col("p_partkey").cast("string"), F.lit('"><name>'), _xml_text(F.col("p_name")),
        F.lit("</name><brand>"), _xml_text(F.col("p_brand")), F.lit("</brand><size>"),
        F.col("p_size").cast("string"), F.lit("</size>"),
    )
    doc = F.when(F.col("p_type") == "SMALL", doc).otherwise(F.concat(doc, F.lit("</part>")))
    schema = T.StructType(
        [
            T.StructField("@id", T.StringType()),
            T.StructField("name", T.StringType()),
            T.StructField("brand", T.StringType()),
            T.StructField("size", T.StringType()),
        ]
    )
    parsed = parse_xml_column(p.select("p_partkey", doc.alias("xml")), "xml", schema)
    return parsed.select(
        "p_partkey",
        F.col("doc.`@id`").cast("long").alias("doc_id"),
        F.col("doc.name").alias("name"),
        F.col("doc.brand").alias("brand"),
        F.col("doc.size").alias("size"),
        "broken",
    )


def q_csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3: write ``supplier`` as CSV files, read them back with file provenance."""
    s = table(spark, sf_dir, "supplier")
    path = fresh_dir(spark, "csv")
    s.write.option("header", True).csv(path)
    back = read_csv_files(spark, path, schema=s.schema)
    return back.withColumn("file_kind", F.element_at(F.split(base_name("source_file"), r"\."), -1)).drop("source_file")


def q_sql_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SQL text over registered views, every value returned as text."""
    views = {"ts_nation": table(spark, sf_dir, "nation"), "ts_region": table(spark, sf_dir, "region")}
    q = """
        SELECT n.n_nationkey, n.n_name, r.r_name, n.n_regionkey
        FROM ts_nation n JOIN ts_region r ON n.n_regionkey = r.r_regionkey
    """
    return sql_to_strings(spark, q, views)


def q_sql_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S8 + K3: SQL text over two loaded tables by their names, with parameter values (one holds a quote)."""
    root = fresh_dir(spark, "sql-tables")
    orders = table(spark, sf_dir, "orders")
    customers = table(spark, sf_dir, "customer").select("c_custkey", F.concat("c_mktsegment", F.lit("'s")).alias("segment"), "c_nationkey")
    for name, rows, key in (("loaded_orders", orders, "o_orderkey"), ("loaded_customers", customers, "c_custkey")):
        tbl = VersionedTable(spark, f"{root}/{name}", [key])
        tbl.provision(rows.schema)
        tbl.merge(rows)
    query = """
        SELECT c.c_nationkey, o.o_orderstatus, count(*) AS orders, sum(CAST(o.o_totalprice AS DECIMAL(18,2))) AS total
        FROM loaded_orders o JOIN loaded_customers c ON o.o_custkey = c.c_custkey
        WHERE c.segment = :segment AND o.o_orderdate >= :since
        GROUP BY c.c_nationkey, o.o_orderstatus
    """
    return sql_to_strings(spark, query, args={"segment": "BUILDING's", "since": dt.datetime(1996, 1, 1)}, warehouse=root)


def q_archive_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S7 + K8: events landed as files, merged by key in bounded micro-batches
    into a hash-partitioned table (each batch rewrites only the partitions
    its keys fall in), processed files archived."""
    events = table(spark, sf_dir, "events")
    root, width = fresh_dir(spark, "intake"), _width(spark)
    landing = f"{root}/landing"
    events.repartition(width, "event_id").write.parquet(landing)
    tbl = VersionedTable(spark, f"{root}/table", ["event_id"], hash_partitions=width)
    tbl.provision(events.schema)
    incremental_merge(
        spark,
        landing,
        events.schema,
        tbl,
        ["event_id"],
        checkpoint=f"{root}/checkpoint",
        max_files_per_trigger=-(-width // 3),
        archive_dir=f"{root}/archive",
    )
    return tbl.read()


def q_csv_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3: several CSV files with a header each, types inferred."""
    path = fresh_dir(spark, "csv-inferred")
    table(spark, sf_dir, "customer").repartition(_width(spark)).write.option("header", True).csv(path)
    return read_csv_files(spark, path, with_source=False)


def q_csv_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3: files whose types differ, read in the types that hold all values; lines that don't fit counted apart."""
    p = table(spark, sf_dir, "part")
    small, text = F.col("p_size") < 20, lambda c: F.col(c).cast("string")
    fields = {
        "id": text("p_partkey"),
        "code": F.lpad(text("p_partkey"), 7, "0"),
        "amount": F.when(small, text("p_size")).otherwise(F.format_string("%d.%d5", "p_size", F.col("p_size") % 10)),
        "at": F.when(small, F.lit("2024-01-02")).otherwise(F.format_string("2024-01-02 03:04:%02d", "p_size")),
        "flag": F.when(F.col("p_size") == 7, F.lit("")).otherwise((F.col("p_size") % 2 == 0).cast("string")),
        "note": F.when(small, text("p_size")).otherwise(F.col("p_brand")),
        "count": F.when(small, text("p_size")).otherwise((F.col("p_partkey") + 3_000_000_000).cast("string")),
    }
    line = F.concat_ws(",", *fields.values())
    line = F.when(F.col("p_size") == 50, F.concat(line, F.lit(",one more"))).otherwise(line)
    path = fresh_dir(spark, "csv-types")
    for rows in (p.where(small), p.where(~small)):  # files of either kind; the separator keeps the lines as they are
        rows.select(line.alias(",".join(fields))).write.mode("append").option("header", True).option("sep", "\u0001").csv(path)
    rows, bad, _ = read_csv_typed(spark, path)
    return rows.drop("source_file").withColumn("bad_rows", F.lit(bad.count()).cast("long"))


#: Documents that one task writes as files of their own.
TASK_DOCUMENTS = 200


def _supplier_documents(spark: SparkSession, sf_dir: str) -> str:
    """One XML file per supplier; those of negative balance are broken. Returns the folder."""
    s = table(spark, sf_dir, "supplier")
    doc = F.concat(F.lit('<supplier id="'), F.col("s_suppkey").cast("string"), F.lit('"><name>'), _xml_text(F.col("s_name")), F.lit("</name>"))
    path = fresh_dir(spark, "xml")
    doc = F.when(F.col("s_acctbal") < 0, doc).otherwise(F.concat(doc, F.lit("</supplier>")))
    # A file costs milliseconds however small it is: tasks are cut by documents, since a table of many rows may be one small file.
    docs = s.select(doc.alias("value"))
    docs = docs.repartition(-(-max(s.count(), 1) // TASK_DOCUMENTS))
    # Each task moves its own files into the folder; by version 1 the driver moves all of them, one by one.
    docs.write.option("maxRecordsPerFile", 1).option("mapreduce.fileoutputcommitter.algorithm.version", 2).text(path)
    return path


def q_xml_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One XML document per file, loaded and broken ones counted apart."""
    schema = T.StructType([T.StructField("@id", T.StringType()), T.StructField("name", T.StringType())])
    loaded, broken = read_xml_documents(spark, _supplier_documents(spark, sf_dir), schema)
    rows = loaded.select(F.col("doc.`@id`").cast("long").alias("s_suppkey"), F.col("doc.name").alias("name"), F.lit(False).alias("broken"))
    gone = broken.groupBy().agg(F.lit(None).cast("long").alias("s_suppkey"), F.count("*").cast("string").alias("name"), F.lit(True).alias("broken"))
    return rows.unionByName(gone)


def _mixed_documents(spark: SparkSession, sf_dir: str) -> str:
    """Parts, suppliers and customers as XML documents of three structures, one a line; customers of negative balance are broken."""
    text = lambda c: F.col(c).cast("string")
    part = F.concat(
        F.lit('<part sku="'), F.lpad(text("p_partkey"), 8, "0"), F.lit('"><name>'), _xml_text(F.col("p_name")), F.lit('</name><size unit="cm">'),
        text("p_size"), F.lit("</size><tag>"), _xml_text(F.col("p_brand")), F.lit("</tag><tag><![CDATA["), F.col("p_type"), F.lit("]]></tag></part>"),
    )
    supplier = F.concat(
        F.lit('<?xml version="1.0"?><!-- a > b --><s:supplier xmlns:s="urn:s" s:key="'), text("s_suppkey"), F.lit('"><s:name> '), _xml_text(F.col("s_name")),
        F.lit(" </s:name><s:nation><code>0"), text("s_nationkey"), F.lit("</code></s:nation></s:supplier>"),
    )
    customer = F.concat(F.lit("<customer><id>"), F.lpad(text("c_custkey"), 9, "0"), F.lit("</id><segment>"), _xml_text(F.col("c_mktsegment")), F.lit("</segment><note/>"))
    customer = F.when(F.col("c_acctbal") < 0, customer).otherwise(F.concat(customer, F.lit("</customer>")))
    path = fresh_dir(spark, "xml-mixed")
    for k, (name, doc) in enumerate((("part", part), ("supplier", supplier), ("customer", customer))):
        table(spark, sf_dir, name).select(doc.alias("value")).write.mode("append" if k else "error").text(path)
    return path


def q_xml_variant(spark: SparkSession, sf_dir: str) -> DataFrame:
    """XML documents of unknown and mixed structure in one pass; members by path, text as written, broken ones counted."""
    loaded, broken = read_xml_variants(spark, _mixed_documents(spark, sf_dir), per_line=True)
    first = lambda *paths: F.coalesce(*[xml_text("doc", p) for p in paths])
    rows = loaded.select(
        xml_root("doc").alias("root"),
        first("$.part['@sku']", "$['s:supplier']['@s:key']", "$.customer.id").alias("key"),
        first("$.part.name", "$['s:supplier']['s:name']", "$.customer.segment").alias("name"),
        first("$.part.size['#text']", "$['s:supplier']['s:nation'].code").alias("code"),
        xml_text("doc", "$.part.tag[1]").alias("second_tag"),
        F.lit(1).cast("long").alias("documents"),
    )
    text = F.lit(None).cast("string")
    return rows.unionByName(broken.groupBy().agg(F.lit("broken").alias("root"), *[text.alias(c) for c in ("key", "name", "code", "second_tag")], F.count("*").alias("documents")))


def q_xml_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many records a file, cut and split over tasks; those of negative balance are not well-formed and are counted apart."""
    s = table(spark, sf_dir, "supplier")
    name = F.concat(F.lit("<name>"), _xml_text(F.col("s_name")), F.when(F.col("s_acctbal") < 0, "</nam>").otherwise("</name>"))
    record = F.concat(F.lit('  <supplier id="'), F.col("s_suppkey").cast("string"), F.lit('">\n    '), name, F.lit("\n    <nation>"), F.col("s_nationkey").cast("string"), F.lit("</nation>\n  </supplier>"))
    path = fresh_dir(spark, "xml-records-in")
    s.select(record.alias("value")).write.text(path)
    loaded, broken = read_xml_record_variants(spark, path, "supplier")
    rows = loaded.select(
        xml_text("doc", "$.supplier['@id']").cast("long").alias("s_suppkey"), xml_text("doc", "$.supplier.name").alias("name"),
        xml_text("doc", "$.supplier.nation").cast("long").alias("nation"), F.lit(1).cast("long").alias("records"),
    )
    none = lambda t: F.lit(None).cast(t)
    return rows.unionByName(broken.groupBy().agg(none("long").alias("s_suppkey"), F.lit("broken").alias("name"), none("long").alias("nation"), F.count("*").alias("records")))


def q_file_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files under a folder by extension, without reading them."""
    files = list_files(spark, _supplier_documents(spark, sf_dir), glob="*.txt")
    return files.groupBy(F.element_at(F.split("name", r"\."), -1).alias("extension")).agg(F.count("*").alias("files"), F.min(F.col("length") > 0).alias("filled"))


def q_routed_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K4: rows written to the folder of their database, one database read back."""
    c = table(spark, sf_dir, "customer")
    tenant = F.concat(F.lit("F"), F.lpad(F.col("c_nationkey").cast("string"), 4, "0"))
    db = database_for(tenant, F.col("c_acctbal") < 0, F.col("c_mktsegment") == "BUILDING", "RESTRICTED_DB", "SHARED_DB")
    return read_routed(spark, write_routed(c, fresh_dir(spark, "routed"), db), "RESTRICTED_DB")


def q_skip_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An empty snapshot provisions its table, merges and audits nothing."""
    root = fresh_dir(spark, "skip-empty")
    materials_pages(spark, sf_dir).write.text(f"{root}/landing/{MATERIALS.name}")
    table(spark, sf_dir, "part").groupBy().agg(F.lit('{"Succeed": true, "IsLastPage": true, "Response": []}').alias("value")).write.text(f"{root}/landing/{SPECIFICATIONS.name}")
    results = sync(spark, f"{root}/landing", f"{root}/warehouse", "F0001", run_id="run-1", inserted_at=AUDIT_CLOCK)
    audit = read_audit(spark, f"{root}/warehouse/_audit").select("table_name", F.lit(True).alias("audited"))
    rows = spark.createDataFrame([(r.table, r.inserted, r.skipped_empty) for r in results if not r.missing], "table_name string, inserted long, skipped boolean")
    return rows.join(audit, "table_name", "left").withColumn("audited", F.coalesce("audited", F.lit(False)))


def orders_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as landed snapshot pages (JSON text), at most 50 records a page.

    Numbers arrive as text or numbers as a real feed would send them; a page
    holding an urgent, finished order over 450000 failed.
    """
    o = table(spark, sf_dir, "orders")
    rec = F.struct(
        F.col("o_orderkey").alias("OrderKey"),
        F.col("o_custkey").cast("string").alias("CustKey"),
        F.col("o_orderstatus").alias("OrderStatus"),
        F.col("o_totalprice").alias("TotalPrice"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("OrderDate"),
        F.col("o_orderpriority").alias("OrderPriority"),
    )
    bad = (F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") == "F") & (F.col("o_totalprice") > 450000)
    pages = (
        o.withColumn("page", F.floor(F.col("o_orderkey") / 50).cast("long") + 1)
        .groupBy("page")
        .agg(F.collect_list(rec).alias("Response"), F.max(bad).alias("failed"))
    )
    env = F.struct(F.col("page").alias("Page"), (~F.col("failed")).alias("Succeed"), F.lit(False).alias("IsLastPage"), "Response")
    return pages.select(F.to_json(env).alias("json"))


def _records(pages: DataFrame, spec: TableSpec) -> DataFrame:
    """JSON pages -> landed rows -> the declared fields of the records that count."""
    env = pages.select(F.from_json("json", envelope_schema(spec, values="record")).alias("e")).select("e.*")
    return record_fields(usable_records(land_records(env)), spec)


def q_snapshot_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: pages -> records -> validation -> load cast -> upsert with actions."""
    projected = project_records(_records(orders_pages(spark, sf_dir), ORDER_SPEC), ORDER_SPEC)
    good, _ = split_valid(projected)
    source = cast_to_target(good, ORDER_SPEC)
    o = table(spark, sf_dir, "orders").filter(F.col("o_orderdate") < _ts(MERGE_TARGET_BEFORE))
    target = o.select(
        F.col("o_orderkey").cast("decimal(38,0)").alias("order_key"),
        F.col("o_custkey").cast("decimal(38,0)").alias("cust_key"),
        F.col("o_orderstatus").alias("order_status"),
        (F.col("o_totalprice") - F.lit(1.0)).cast("decimal(38,2)").alias("total_price"),
        F.col("o_orderdate").alias("order_date"),
        F.col("o_orderpriority").alias("order_priority"),
    )
    return merge_rows(target, source, ["order_key"]).withColumnRenamed(ACTION, "action")


def materials_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``part`` as landed materials snapshot pages (20 parts a page).

    A page holding a part of size 50 failed (its records never arrive).
    Lead time arrives as a JSON number, the hidden flag as text, the unit
    blank for larger parts.
    """
    p = table(spark, sf_dir, "part")
    rec = F.struct(
        F.col("p_partkey").cast("string").alias("PartNumber"),
        F.col("p_name").alias("MaterialName"),
        F.col("p_type").alias("Type"),
        F.when(F.col("p_size") < 10, F.lit("EA")).otherwise(F.lit("")).alias("Unit"),
        F.col("p_brand").alias("MaterialId"),
        F.col("p_retailprice").cast("string").alias("Cost"),
        F.col("p_size").alias("OrderLeadTime"),
        F.when(F.col("p_size") > 45, F.lit("1")).otherwise(F.lit("0")).alias("MaterialHidden"),
    )
    pages = (
        p.withColumn("page", F.floor(F.col("p_partkey") / 20).cast("long") + 1)
        .groupBy("page")
        .agg(F.collect_list(rec).alias("Response"), F.max(F.col("p_size") == 50).alias("failed"))
    )
    env = F.struct(F.col("page").alias("Page"), (~F.col("failed")).alias("Succeed"), F.lit(False).alias("IsLastPage"), "Response")
    return pages.select(F.to_json(env).alias("json"))


def q_materials_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1a end to end with the materials spec: pages -> validation -> load
    cast -> upsert into an older materials table, with each row's action."""
    good, _ = split_valid(project_records(_records(materials_pages(spark, sf_dir), MATERIALS), MATERIALS))
    source = cast_to_target(good, MATERIALS)
    p = table(spark, sf_dir, "part").filter(F.col("p_size") <= 25)
    schema = MATERIALS.target_schema()
    older = p.select(
        *[
            (
                F.col("p_partkey").cast("string") if f.name == "part_number"
                else F.upper(F.col("p_name")) if f.name == "material_name"
                else F.col("p_size").cast(f.dataType) if f.name == "order_lead_time"
                else F.lit(None).cast(f.dataType)
            ).alias(f.name)
            for f in schema.fields
        ]
    )
    return merge_rows(older, source, list(MATERIALS.keys)).withColumnRenamed(ACTION, "action")


USAGE_LINES = 3


def usage_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lineitem`` as landed usage pages, the lines of an order (a receipt) in
    pages of ``USAGE_LINES`` line numbers, each page carrying the receipt
    number it was fetched for; the records themselves carry a wrong receipt
    number, which the reader must overwrite. No page is flagged as the last:
    a page without ``Response`` ends a receipt, and the page after it (its
    first page again) must not count."""
    li = table(spark, sf_dir, "lineitem")
    rec = F.struct(
        F.lit("WRONG").alias("InventoryReceiptNumber"),
        F.col("l_linenumber").alias("UsageSequence"),
        F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss").alias("UsedDate"),
        F.col("l_quantity").cast("string").alias("UsedQuantity"),
        F.col("l_returnflag").alias("Purpose"),
    )
    page = F.floor((F.col("l_linenumber") - 1) / USAGE_LINES).cast("long")
    # The lines are shuffled once, by order: groups of its pages and the window over them need no other shuffle.
    lines = li.select("l_orderkey", page.alias("Page"), rec.alias("rec")).repartition("l_orderkey")
    pages = lines.groupBy("l_orderkey", "Page").agg(F.collect_list("rec").alias("Response"))
    none = F.lit(None).cast(pages.schema["Response"].dataType)
    landed = lambda c, number, response: F.when(c, F.array(F.struct(number.alias("Page"), response.alias("Response")))).otherwise(F.array())
    last, own = F.col("last"), F.col("Page")
    copies = F.concat(
        landed(F.lit(True), own, F.col("Response")),
        landed(own.eqNullSafe(last), last + 1, none),
        landed((own == 0) & F.col("l_orderkey").isNotNull(), last + 2, F.col("Response")),
    )
    marked = pages.withColumn("last", F.max("Page").over(Window.partitionBy("l_orderkey")))
    pages = marked.select("l_orderkey", F.inline(copies))
    env = F.struct(
        F.concat(F.lit("R"), F.col("l_orderkey").cast("string")).alias("InventoryReceiptNumber"),
        "Page",
        F.lit(True).alias("Succeed"),
        F.lit(False).alias("IsLastPage"),
        "Response",
    )
    return pages.select(F.to_json(env).alias("json"))


def q_usage_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S2 + J1 + P12 with the usage spec: usage pages of the active receipts
    only, tagged with the fetching key, validated and cast."""
    key = "InventoryReceiptNumber"
    active = table(spark, sf_dir, "orders").filter(F.col("o_orderstatus") == "O").select(
        F.concat(F.lit("R"), F.col("o_orderkey").cast("string")).alias("receipt")
    )
    env = usage_pages(spark, sf_dir).select(F.from_json("json", envelope_schema(INVENTORY_USAGE, key, "record")).alias("e")).select("e.*")
    landed = land_records(of_keys(env, active, "receipt", key), key_field=key)
    rows = detail_lookup(active, "receipt", record_fields(usable_records(landed), INVENTORY_USAGE, key), key)
    good, _ = split_valid(project_records(rows, INVENTORY_USAGE))
    return cast_to_target(good, INVENTORY_USAGE).select(
        "inventory_receipt_number", "usage_sequence", "used_date", "used_quantity", "purpose"
    )


def q_sync_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sync run end to end: materials pages landed as JSON files, read
    fail-fast, validated once into staging, merged into a fresh warehouse,
    audited; returns the loaded table with the audit row's counts."""
    root = fresh_dir(spark, "sync-run")
    materials_pages(spark, sf_dir).write.text(f"{root}/landing/{MATERIALS.name}")
    sync(spark, f"{root}/landing", f"{root}/warehouse", "F0001", api="testdata", run_id="run-1", inserted_at=AUDIT_CLOCK)
    loaded = VersionedTable(spark, f"{root}/warehouse/{MATERIALS.name}").read()
    # The run wrote one audit row; its two counts are attached as constants.
    row = read_audit(spark, f"{root}/warehouse/_audit").first()
    return loaded.withColumns(
        {
            "audit_inserted": F.lit(row["inserted_count"]).cast("long"),
            "audit_updated": F.lit(row["updated_count"]).cast("long"),
        }
    )


QUERIES = {
    "q_snapshot_merge": q_snapshot_merge,
    "q_page_envelope": q_page_envelope,
    "q_detail_lookup": q_detail_lookup,
    "q_union_snapshots": q_union_snapshots,
    "q_rename_project": q_rename_project,
    "q_blank_to_null": q_blank_to_null,
    "q_required_split": q_required_split,
    "q_lax_int": q_lax_int,
    "q_cast_types": q_cast_types,
    "q_snapshot_filter": q_snapshot_filter,
    "q_json_member": q_json_member,
    "q_full_dedup": q_full_dedup,
    "q_duplicate_count": q_duplicate_count,
    "q_subset_dedup": q_subset_dedup,
    "q_merge_rows": q_merge_rows,
    "q_merge_counts": q_merge_counts,
    "q_merge_composite": q_merge_composite,
    "q_merge_duplicate_keys": q_merge_duplicate_keys,
    "q_table_upsert": q_table_upsert,
    "q_delete_by_keys": q_delete_by_keys,
    "q_delete_count": q_delete_count,
    "q_table_counts": q_table_counts,
    "q_tenant_route": q_tenant_route,
    "q_date_partition": q_date_partition,
    "q_backfill_slices": q_backfill_slices,
    "q_yesterday": q_yesterday,
    "q_xml_split": q_xml_split,
    "q_csv_round_trip": q_csv_round_trip,
    "q_sql_strings": q_sql_strings,
    "q_archive_stream": q_archive_stream,
    "q_slices_by_year": q_slices_by_year,
    "q_merge_audit": q_merge_audit,
    "q_unescape_names": q_unescape_names,
    "q_request_filter": q_request_filter,
    "q_json_sink": q_json_sink,
    "q_parquet_gzip": q_parquet_gzip,
    "q_materials_snapshot": q_materials_snapshot,
    "q_usage_detail": q_usage_detail,
    "q_sync_run": q_sync_run,
    "q_merge_null_keys": q_merge_null_keys,
    "q_small_delta": q_small_delta,
    "q_table_delete": q_table_delete,
    "q_metrics": q_metrics,
    "q_quoted_names": q_quoted_names,
    "q_csv_inferred": q_csv_inferred,
    "q_xml_documents": q_xml_documents,
    "q_file_listing": q_file_listing,
    "q_routed_write": q_routed_write,
    "q_skip_empty": q_skip_empty,
    "q_backfill_read": q_backfill_read,
    "q_sql_tables": q_sql_tables,
    "q_xml_variant": q_xml_variant,
    "q_csv_types": q_csv_types,
    "q_digest_dedup": q_digest_dedup,
    "q_xml_records": q_xml_records,
    **snapshots.QUERIES,
}
