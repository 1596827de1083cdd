"""Write PLANS.md: physical plans of the main workloads, with scale notes.

Usage: python tools/dump_plans.py [sf_dir]
"""

import os
import re
import sys

sys.path.insert(0, os.path.join(os.path.dirname(__file__), ".."))

from tidesync.operators.merge import merge_rows  # noqa: E402
from tidesync.plans import workloads as W  # noqa: E402
from tidesync.session import build_session  # noqa: E402

NOTES = {
    "q_snapshot_merge": "Pages -> records -> staged validation -> load cast -> full outer join on the key. "
    "The end page is a scalar subquery (partial min, one row). Validation is a chain of Projects "
    "inside one codegen stage; the only Exchanges are the page grouping that builds the test pages "
    "and the two sides of the merge join.",
    "q_merge_rows": "Shuffle strategy: each side hash-partitioned once on the key, SortMergeJoin FullOuter. "
    "Pushed date filters and pruned columns reach both Parquet scans.",
    "merge_broadcast": "Broadcast strategy (VersionedTable.merge picks it when the staged source measures small): "
    "the target is scanned with no Exchange; a LeftOuter and a LeftSemi BroadcastHashJoin against the "
    "broadcast source, and a LeftAnti between two small sides.",
    "merge_hash_partitioned": "Shuffle strategy on a hash-partitioned table (VersionedTable(hash_partitions=N)): "
    "only the partitions the source's keys touch are scanned (here all 8), both sides are hash-repartitioned "
    "into the same N partitions, and the join adds no further exchange; each task writes one partition folder. "
    "With a small source the broadcast strategy applies instead and untouched partitions are never opened.",
    "q_detail_lookup": "Key multiplicities are a partial aggregate (HashAggregate partial -> Exchange -> final), "
    "then one equi-join and two nested short sequences to restore repeats. AQE broadcasts the counted "
    "keys when they measure small.",
    "q_full_dedup": "Whole-row dedup is a HashAggregate with a partial step before the Exchange, so repeated "
    "rows collapse map-side.",
    "q_merge_duplicate_keys": "latest-per-key is max(struct(order, rest)) grouped by key: a partial "
    "(sort-based) aggregate before the shuffle, no window over a whole key.",
    "q_page_envelope": "Per-snapshot end page: partial min grouped by snapshot key, joined back on the key "
    "(AQE: broadcast when small, else sort-merge with skew splits).",
    "q_backfill_slices": "No range join: each row's slice start comes from its own timestamp; counting is a "
    "partial aggregate; the slice list (one row per month) is joined on equality.",
    "q_requisitions_fields": "Landed records are shredded VARIANT: the scan's ReadSchema has the keys, the filtered and the asked "
    "fields of the record only; the filter is tested above a projection barrier, so its fields are decoded once.",
    "q_usage_detail": "Pages of receipts that nobody asked for are dropped before they land, so the plan below reads rows of asked "
    "receipts only; key counts, one join, repeats restored.",
    "q_backfill_read": "The days still to load come out of an anti join at run time and become dynamic pruning filters on the "
    "partition columns: files of other days are not opened.",
    "q_digest_dedup": "Digests are counted first; rows whose digest is alone pass an anti join without being moved, the others "
    "are compared in full.",
    "q_date_partition": "The write keeps the input partitioning (no Exchange before the write).",
}


SCALE = {
    "q_snapshot_merge": "JSON pages parsed with a declared schema; validation is narrow; the end page is one scalar; the merge is one join keyed on unique keys (or none: see the table layouts).",
    "q_page_envelope": "Per-snapshot end pages are a partial min joined back; a huge snapshot is split by AQE on the page side, never windowed into one task.",
    "q_detail_lookup": "Repeated keys are counted before the shuffle; the lookup join is inner, so a hot receipt is split by AQE skew handling.",
    "q_union_snapshots": "No shuffle.",
    "q_rename_project": "No shuffle; only the projected columns are read.",
    "q_blank_to_null": "No shuffle; expressions in codegen.",
    "q_required_split": "Reason counts are partial aggregates; only a handful of rows are shuffled.",
    "q_lax_int": "No shuffle; regex guard plus try_cast in codegen.",
    "q_cast_types": "No shuffle; one staged projection.",
    "q_snapshot_filter": "Predicates pushed into the Parquet scan.",
    "q_json_member": "No shuffle; one JSON path extraction per row.",
    "q_full_dedup": "Partial aggregate collapses copies map-side; a row repeated a billion times shuffles once per task.",
    "q_duplicate_count": "Two partial aggregates; the second is one row.",
    "q_subset_dedup": "min(struct) partial aggregate per group: hot groups reduce map-side.",
    "q_merge_rows": "Shuffle of both sides on a unique key; rows with a null key stay out of the join; repeated keys fail inside it. With a small source nothing moves.",
    "q_merge_counts": "Same join; counts are a one-row aggregate (observe in the table path).",
    "q_merge_composite": "max(struct) reduction per key before the join: a key copied many times never sorts in one task.",
    "q_merge_duplicate_keys": "Same as composite: latest-per-key is a partial aggregate.",
    "q_table_upsert": "Source staged once with its size; broadcast or one shuffle of each side by that size.",
    "q_delete_by_keys": "Key list deduplicated before the anti join; AQE splits a hot target key.",
    "q_delete_count": "Semi join plus a one-row count.",
    "q_table_counts": "Parquet counts come from footers; one row per table.",
    "q_tenant_route": "No shuffle; partitionBy(database) writes each tenant in the same pass.",
    "q_date_partition": "Write keeps input partitioning (a hot day spreads over all tasks); reads prune by year/month/day.",
    "q_backfill_slices": "No range join; slice from the row's timestamp; one row per month joined.",
    "q_yesterday": "Timestamp range pushed into the scan.",
    "q_xml_split": "Per-row parse, no shuffle; large multi-record files use the splittable XML source.",
    "q_csv_round_trip": "Declared schema: no inference pass; FAILFAST per file.",
    "q_sql_strings": "Plain Spark SQL, cast at the end; pushdown unaffected.",
    "q_archive_stream": "Bounded micro-batches; each rewrites only the hash partitions its keys touch; replays skipped by batch id.",
    "q_slices_by_year": "Months per year bounded (12) before collect_list.",
    "q_merge_audit": "One-row aggregate of the merge actions.",
    "q_unescape_names": "Metadata only.",
    "q_request_filter": "Predicates pushed into the scan; blank filters dropped before planning.",
    "q_json_sink": "Write and read back with declared schema; no inference.",
    "q_parquet_gzip": "Write without shuffle.",
    "q_materials_snapshot": "As q_snapshot_merge, with the 17-field materials spec.",
    "q_sync_run": "The whole sync: JSON parsed and records staged once, merge straight from staging by measured size, one audit row, staging removed.",
    "q_usage_detail": "Pages of asked receipts only (broadcast keys, or a run-time Bloom filter); per-receipt end pages (partial min + join), key counts before the lookup join, validation narrow.",
    "q_backfill_read": "Folders pruned at run time by the pending days, a few rows whatever the table's size.",
    "q_sql_tables": "As any SQL; tables resolved to their newest commit when the text is analysed.",
    "q_xml_variant": "One projection a document, no inference pass; one document a line, so files are split.",
    "q_xml_records": "Files cut at end tags while they are read: large files are split, a broken record costs no other.",
    "q_csv_types": "Types from one partial aggregate over the staged text: one small row a task.",
    "q_digest_dedup": "16 bytes a row are shuffled, and the rows whose digest repeats.",
    "q_requisitions_fields": "Columns of the keys, filtered and asked fields only.",
    "q_materials_planned_fields": "As q_requisitions_fields.",
    "q_inventory_fields": "As q_requisitions_fields, over two snapshots.",
}


def tree(plan_text: str) -> str:
    lines = plan_text.splitlines()
    out = []
    for ln in lines:
        if ln.startswith("== Physical Plan =="):
            continue
        if re.match(r"^\(\d+\)", ln):
            break
        out.append(ln)
    return "\n".join(x for x in out if x.strip())


def details(plan_text: str) -> list[str]:
    keep = []
    for ln in plan_text.splitlines():
        if ln.startswith(("PushedFilters", "PartitionFilters", "ReadSchema")):
            keep.append(ln if len(ln) < 220 else ln[:217] + "...")
    seen, uniq = set(), []
    for k in keep:
        if k not in seen:
            seen.add(k)
            uniq.append(k)
    return uniq[:8]


def explain(df) -> str:
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session("local[8]", 16)
    sections = []
    for name, note in NOTES.items():
        if name == "merge_broadcast":
            target, source = W._merge_inputs(spark, sf)
            df = merge_rows(target, source, ["o_orderkey"], strategy="broadcast")
        elif name == "merge_hash_partitioned":
            from tidesync.plans.tables import VersionedTable
            from tidesync.session import fresh_dir

            target, source = W._merge_inputs(spark, sf)
            tbl = VersionedTable(spark, fresh_dir(spark, "plan-hash"), ["o_orderkey"], hash_partitions=8)
            tbl.provision(target.schema)
            tbl.merge(target, strategy="shuffle")
            t = tbl.read().repartition(8, "o_orderkey")
            df = merge_rows(t, source.repartition(8, "o_orderkey"), ["o_orderkey"], strategy="shuffle", null_keys=False)
        elif name == "q_date_partition":
            continue
        else:
            df = W.QUERIES[name](spark, sf)
        text = explain(df)
        body = tree(text)
        exchanges = body.count("Exchange")
        info = "\n".join(details(text))
        sections.append(
            f"## {name}\n\n{note}\n\nExchanges in plan: {exchanges}\n\n```\n{body}\n```\n\n```\n{info}\n```\n"
        )
    # Summary of every registered query's static plan.
    rows = []
    for name, fn in W.QUERIES.items():
        if name in ("q_archive_stream", "q_table_upsert", "q_date_partition", "q_csv_round_trip", "q_json_sink", "q_parquet_gzip", "q_sync_run"):
            kind = "writes first"
        else:
            kind = ""
        df = fn(spark, sf)
        body = tree(explain(df))
        shuffles = body.count("Exchange") - body.count("BroadcastExchange")
        rows.append(
            f"| `{name}` | {shuffles} | {body.count('BroadcastExchange')} | {body.count('SortMergeJoin')} | "
            f"{body.count('BroadcastHashJoin')} | {body.count('HashAggregate') + body.count('SortAggregate')} | {kind} | {SCALE.get(name, '')} |"
        )
    summary = (
        "## All registered queries (static plan counts)\n\n"
        "| Query | Shuffle exchanges | Broadcast exchanges | Sort-merge joins | Broadcast hash joins | Aggregate nodes | Note | At 100 TB |\n"
        "|---|---|---|---|---|---|---|---|\n" + "\n".join(rows) + "\n\n"
        "Broadcasts in these plans are chosen by Spark's planner from its size estimate "
        "(`spark.sql.autoBroadcastJoinThreshold` against the scanned file size, scaled to the selected "
        "columns and never reduced by filters), and re-checked by AQE from the measured shuffle output, "
        "or, in the merge, from the measured size of the staged source. "
        "\"writes first\" queries write data and read it back, so the plan shown is the read.\n\n"
    )
    sections.insert(0, summary)
    head = (
        "# Physical plans\n\nGenerated by `tools/dump_plans.py` on "
        f"`{os.path.basename(sf)}` (initial adaptive plans; AQE may still turn a sort-merge "
        "join into a broadcast join or coalesce partitions at run time).\n\n"
    )
    with open(os.path.join(os.path.dirname(__file__), "..", "PLANS.md"), "w") as f:
        f.write(head + "\n".join(sections))
    spark.stop()


if __name__ == "__main__":
    main()
