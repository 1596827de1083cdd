"""Command line: ``python -m tidesync <command> ...``.

Commands:

* ``sync``   -- read landed snapshots, validate every table, then merge each
  into its versioned table and append audit rows;
* ``counts`` -- append the current row count of each table to the audit log;
* ``vacuum`` -- delete table data that the last versions no longer reference;
* ``backfill`` -- print the monthly backfill slices from a start date.

The session comes from the environment (``spark-submit`` settings, or a local
session when run directly). On a cluster, ``spark.checkpoint.dir`` must name a
shared folder.
"""

from __future__ import annotations

import argparse
import json
import sys

from tidesync.models import ALL_SPECS


def _session(master: str | None):
    from pyspark.sql import SparkSession

    from tidesync.session import build_session

    if master:
        return build_session(master)
    active = SparkSession.getActiveSession()
    # Without --master the launcher (spark-submit) decides master and widths.
    return active if active is not None else build_session(master=None, shuffle_partitions=None)


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="tidesync")
    ap.add_argument("--master", default=None, help="Spark master for a local run, e.g. local[8]")
    sub = ap.add_subparsers(dest="command", required=True)

    s = sub.add_parser("sync", help="validate and merge landed snapshots")
    s.add_argument("--landing", required=True)
    s.add_argument("--warehouse", required=True)
    s.add_argument("--f-number", required=True)
    s.add_argument("--api", default="records")
    s.add_argument("--on-error", choices=["fail", "quarantine"], default="fail")
    s.add_argument("--run-id", default=None)
    s.add_argument("--hash-partitions", default="{}", help="JSON map of table -> hash partition count, for tables that the run creates")
    s.add_argument("--missing", choices=["report", "fail"], default="report", help="what a snapshot folder that is absent does")

    c = sub.add_parser("counts", help="append the row count of each table to the audit log")
    c.add_argument("--warehouse", required=True)
    c.add_argument("--f-number", required=True)
    c.add_argument("--api", default="records")
    c.add_argument("--tables", default=",".join(ALL_SPECS), help="comma-separated table names")

    v = sub.add_parser("vacuum", help="delete table data no longer referenced by recent versions")
    v.add_argument("--warehouse", required=True)
    v.add_argument("--tables", default=",".join(ALL_SPECS), help="comma-separated table names")
    v.add_argument("--keep-versions", type=int, default=2)

    b = sub.add_parser("backfill", help="print monthly backfill slices")
    b.add_argument("--start", required=True)
    b.add_argument("--as-of", default=None)

    args = ap.parse_args(argv)
    spark = _session(args.master)
    if args.command == "sync":
        from tidesync.plans.sync import sync

        results = sync(
            spark, args.landing, args.warehouse, args.f_number, args.api, args.on_error, args.run_id,
            hash_partitions=json.loads(args.hash_partitions), missing=args.missing,
        )
        for r in results:
            print(json.dumps(r.__dict__))
    elif args.command == "counts":
        from tidesync.plans.sync import seed_counts

        for r in seed_counts(spark, args.warehouse, [t for t in args.tables.split(",") if t], args.f_number, args.api).collect():
            print(json.dumps(r.asDict()))
    elif args.command == "vacuum":
        from tidesync.plans.tables import VersionedTable

        for name in [t for t in args.tables.split(",") if t]:
            gone = VersionedTable(spark, f"{args.warehouse.rstrip('/')}/{name}").vacuum(args.keep_versions)
            print(json.dumps({"table": name, "deleted": len(gone)}))
    elif args.command == "backfill":
        from tidesync.functions.dates import backfill_slices

        for r in backfill_slices(spark, args.start, args.as_of).orderBy("slice_start").collect():
            print(json.dumps({"year": r.year, "start": r.slice_start.isoformat(), "end": r.slice_end.isoformat()}))
    return 0


if __name__ == "__main__":
    sys.exit(main())
