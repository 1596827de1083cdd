"""tidesync: keep analytical tables in step with snapshot extracts, on Spark.

Read landed snapshot pages, CSV, Parquet and XML; project and validate every
record against a declared spec; dedup; upsert or delete by key in versioned
Parquet tables with action counts; append audit rows; slice history by month
or day; and run the same merge incrementally over newly arrived files.
"""

from tidesync.models import ALL_SPECS
from tidesync.operators.dedup import dedup_except, duplicate_count, full_dedup, union_snapshots
from tidesync.operators.keys import delete_by_keys, detail_lookup
from tidesync.operators.merge import action_counts, merge_rows, prepare_source
from tidesync.operators.validate import cast_to_target, project_records, split_valid, validate
from tidesync.plans.sync import sync
from tidesync.plans.tables import VersionedTable
from tidesync.session import build_session, work_dir
from tidesync.sources.pages import read_pages
from tidesync.spec import FieldSpec, TableSpec

__version__ = "0.1.0"

__all__ = [
    "ALL_SPECS",
    "FieldSpec",
    "TableSpec",
    "VersionedTable",
    "action_counts",
    "build_session",
    "cast_to_target",
    "dedup_except",
    "delete_by_keys",
    "detail_lookup",
    "duplicate_count",
    "full_dedup",
    "merge_rows",
    "prepare_source",
    "project_records",
    "read_pages",
    "split_valid",
    "sync",
    "union_snapshots",
    "validate",
    "work_dir",
]
