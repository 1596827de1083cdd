"""Plain-SQL oracles for :mod:`tidesync.plans.workloads` (DuckDB dialect).

Written independently of the Spark code: the same rules stated in SQL over
the same Parquet tables (registered as views named like the tables).
"""

from __future__ import annotations

import datetime as _dt

from tidesync.plans import snapshots
from tidesync.plans import workloads as W

_SNAPSHOT_SOURCE = """
WITH pg AS (
  SELECT CAST(floor(o_orderkey / 50) AS BIGINT) + 1 AS page,
         bool_or(o_orderpriority = '1-URGENT' AND o_orderstatus = 'F' AND o_totalprice > 450000) AS failed
  FROM orders GROUP BY 1
),
s AS (
  SELECT CAST(o.o_orderkey AS DECIMAL(38,0)) AS order_key,
         CAST(o.o_custkey AS DECIMAL(38,0)) AS cust_key,
         o.o_orderstatus AS order_status,
         CAST(o.o_totalprice AS DECIMAL(38,2)) AS total_price,
         o.o_orderdate AS order_date,
         o.o_orderpriority AS order_priority
  FROM orders o JOIN pg ON CAST(floor(o.o_orderkey / 50) AS BIGINT) + 1 = pg.page
  WHERE NOT pg.failed
),
t AS (
  SELECT CAST(o_orderkey AS DECIMAL(38,0)) AS order_key,
         CAST(o_custkey AS DECIMAL(38,0)) AS cust_key,
         o_orderstatus AS order_status,
         CAST(o_totalprice - 1.0 AS DECIMAL(38,2)) AS total_price,
         o_orderdate AS order_date,
         o_orderpriority AS order_priority
  FROM orders WHERE o_orderdate < TIMESTAMP '{before}'
)
SELECT coalesce(t.order_key, s.order_key) AS order_key,
       CASE WHEN s.order_key IS NOT NULL THEN s.cust_key ELSE t.cust_key END AS cust_key,
       CASE WHEN s.order_key IS NOT NULL THEN s.order_status ELSE t.order_status END AS order_status,
       CASE WHEN s.order_key IS NOT NULL THEN s.total_price ELSE t.total_price END AS total_price,
       CASE WHEN s.order_key IS NOT NULL THEN s.order_date ELSE t.order_date END AS order_date,
       CASE WHEN s.order_key IS NOT NULL THEN s.order_priority ELSE t.order_priority END AS order_priority,
       CASE WHEN s.order_key IS NOT NULL AND t.order_key IS NOT NULL THEN 'updated'
            WHEN s.order_key IS NOT NULL THEN 'inserted' ELSE 'kept' END AS action
FROM t FULL OUTER JOIN s ON t.order_key = s.order_key
""".format(before=W.MERGE_TARGET_BEFORE)

_PAGE_ENVELOPE = """
WITH c AS (SELECT *, CAST(floor(turn / 4) AS BIGINT) + 1 AS page FROM conversations),
p AS (
  SELECT conv_id, page,
         NOT bool_or(role = 'system') AS succeed,
         bool_or(role = 'user') AND page >= 2 AS is_last
  FROM c GROUP BY conv_id, page
),
e AS (SELECT conv_id, min(page) AS end_page FROM p WHERE succeed AND is_last GROUP BY conv_id)
SELECT c.conv_id, c.page,
       CAST(c.turn AS DECIMAL(38,0)) AS turn,
       CASE WHEN c.role = '' OR contains(c.role, '0000-00-00') THEN NULL ELSE c.role END AS role,
       CASE WHEN c.text = '' OR contains(c.text, '0000-00-00') THEN NULL ELSE c.text END AS text,
       TRUE AS valid
FROM c JOIN p ON c.conv_id = p.conv_id AND c.page = p.page
LEFT JOIN e ON e.conv_id = c.conv_id
WHERE p.succeed AND (e.end_page IS NULL OR c.page <= e.end_page)
"""

_DETAIL_LOOKUP = """
SELECT l.l_orderkey, l.l_linenumber, l.l_quantity, l.l_extendedprice, l.l_orderkey AS request_key
FROM lineitem l
JOIN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'O'
      UNION ALL
      SELECT o_orderkey FROM orders WHERE o_orderstatus = 'O' AND o_orderpriority = '1-URGENT') k
  ON l.l_orderkey = k.o_orderkey
"""

_UNION = """
SELECT *, 'active' AS snapshot FROM orders WHERE o_orderstatus IN ('O', 'P')
UNION ALL
SELECT *, 'depleted' AS snapshot FROM orders WHERE o_orderstatus IN ('F', 'P')
"""

_RENAME = """
SELECT p_partkey AS part_number, p_name AS material_name, p_type AS material_type,
       p_brand AS brand, CAST(NULL AS VARCHAR) AS unit
FROM part
"""

_CUSTOMER_RAW = """
SELECT c_custkey, c_mktsegment, c_name,
       CASE WHEN c_mktsegment = 'BUILDING' THEN ''
            WHEN c_mktsegment = 'MACHINERY' THEN '0000-00-00 ' || c_name
            WHEN c_mktsegment = 'HOUSEHOLD' THEN ' '
            ELSE c_name END AS raw
FROM customer
"""

_BLANK = f"""
WITH c AS ({_CUSTOMER_RAW})
SELECT c_custkey, raw,
       CASE WHEN raw = '' OR contains(raw, '0000-00-00') THEN NULL ELSE raw END AS cleaned,
       CASE WHEN raw = '' THEN NULL ELSE raw END AS blank_only
FROM c
"""

_REQUIRED = """
SELECT reason, count(*) AS rows FROM (
  SELECT CASE WHEN c_mktsegment = 'BUILDING' THEN 'segment: required'
              WHEN c_mktsegment = 'MACHINERY' THEN 'name: required'
              ELSE 'valid' END AS reason
  FROM customer
) GROUP BY reason
"""

_INT_RE = r"^\s*[+-]?[0-9]+(\.0+)?\s*$"

_LAX_INT = f"""
WITH t AS (
  SELECT o_orderkey,
         CASE WHEN o_orderpriority = '1-URGENT' THEN CAST(o_orderkey AS VARCHAR) || '.7'
              WHEN o_orderstatus = 'O' THEN CAST(o_orderkey AS VARCHAR)
              WHEN o_orderstatus = 'F' THEN ' ' || CAST(o_orderkey AS VARCHAR) || ' '
              ELSE CAST(o_orderkey AS VARCHAR) || '.0' END AS text
  FROM orders
)
SELECT o_orderkey, text,
       CASE WHEN regexp_matches(text, '{_INT_RE}')
            THEN CAST(trim(text) AS DECIMAL(38,0)) END AS value,
       regexp_matches(text, '{_INT_RE}') AS ok
FROM t
"""

_CAST = """
SELECT CAST(l_orderkey AS DECIMAL(38,0)) AS order_key,
       CAST(l_linenumber AS DECIMAL(38,0)) AS line_number,
       CAST(l_quantity AS DECIMAL(38,0)) AS quantity,
       CAST(l_extendedprice AS DECIMAL(38,2)) AS extended_price,
       CAST(l_discount AS DECIMAL(38,10)) AS discount,
       l_returnflag = 'R' AS returned,
       l_shipdate AS ship_date,
       l_returnflag AS return_flag,
       [l_returnflag, l_linestatus] AS flags
FROM lineitem
"""

_FILTER = """
SELECT * FROM orders
WHERE o_orderstatus = 'O'
  AND contains(o_orderpriority, 'HIGH')
  AND o_orderdate >= TIMESTAMP '1996-01-01 00:00:00'
  AND o_orderdate <= TIMESTAMP '1997-12-31 23:59:59'
"""

_JSON = "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events"

_DUP_INPUT = "SELECT * FROM lineitem UNION ALL SELECT * FROM lineitem WHERE l_returnflag = 'R'"

_FULL_DEDUP = f"SELECT DISTINCT * FROM ({_DUP_INPUT})"

_DUP_COUNT = f"""
SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS duplicate_rows, count(*) AS distinct_rows
FROM (
  SELECT count(*) AS n FROM ({_DUP_INPUT})
  GROUP BY l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice,
           l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate
)
"""

_SUBSET = """
WITH u AS (
  SELECT vec_id, embedding, label FROM embeddings
  UNION ALL
  SELECT vec_id - 1000000 AS vec_id, embedding, label FROM embeddings WHERE label = 0
)
SELECT min(vec_id) AS vec_id, label, CAST(len(embedding) AS INTEGER) AS dims
FROM u GROUP BY embedding, label
"""

_MERGE_TS = f"""
t AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority
  FROM orders WHERE o_orderdate < TIMESTAMP '{W.MERGE_TARGET_BEFORE}'
),
s AS (
  SELECT o_orderkey,
         CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_orderstatus END AS o_orderstatus,
         o_totalprice + 1.0 AS o_totalprice
  FROM orders WHERE o_orderdate >= TIMESTAMP '{W.MERGE_SOURCE_FROM}'
)
"""

_ACTION = """CASE WHEN s.o_orderkey IS NOT NULL AND t.o_orderkey IS NOT NULL THEN 'updated'
            WHEN s.o_orderkey IS NOT NULL THEN 'inserted' ELSE 'kept' END AS action"""

_MERGE_ROWS = f"""
WITH {_MERGE_TS}
SELECT coalesce(t.o_orderkey, s.o_orderkey) AS o_orderkey,
       t.o_custkey,
       CASE WHEN s.o_orderkey IS NOT NULL THEN s.o_orderstatus ELSE t.o_orderstatus END AS o_orderstatus,
       CASE WHEN s.o_orderkey IS NOT NULL THEN s.o_totalprice ELSE t.o_totalprice END AS o_totalprice,
       t.o_orderpriority,
       {_ACTION}
FROM t FULL OUTER JOIN s ON t.o_orderkey = s.o_orderkey
"""

_TABLE_UPSERT = f"""
WITH {_MERGE_TS}
SELECT coalesce(t.o_orderkey, s.o_orderkey) AS o_orderkey,
       t.o_custkey,
       CASE WHEN s.o_orderkey IS NOT NULL THEN s.o_orderstatus ELSE t.o_orderstatus END AS o_orderstatus,
       CASE WHEN s.o_orderkey IS NOT NULL THEN s.o_totalprice ELSE t.o_totalprice END AS o_totalprice,
       t.o_orderpriority
FROM t FULL OUTER JOIN s ON t.o_orderkey = s.o_orderkey
"""

_MERGE_COUNTS = f"""
WITH {_MERGE_TS}
SELECT count(*) FILTER (WHERE s.o_orderkey IS NOT NULL AND t.o_orderkey IS NULL) AS inserted_count,
       count(*) FILTER (WHERE s.o_orderkey IS NOT NULL AND t.o_orderkey IS NOT NULL) AS updated_count,
       count(*) FILTER (WHERE s.o_orderkey IS NULL) AS kept_count,
       count(*) FILTER (WHERE false) AS unchanged_count,
       count(*) AS total_rows
FROM t FULL OUTER JOIN s ON t.o_orderkey = s.o_orderkey
"""

_LATEST_LINE = """row_number() OVER (PARTITION BY l_orderkey, l_linenumber
  ORDER BY l_shipdate DESC, l_quantity DESC, l_extendedprice DESC, l_returnflag DESC)"""

_MERGE_COMPOSITE = f"""
WITH li AS (
  SELECT l_orderkey, l_linenumber, l_shipdate, l_quantity, l_extendedprice, l_returnflag FROM lineitem
),
t AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, {_LATEST_LINE} AS rn FROM li WHERE l_shipdate < TIMESTAMP '{W.LINE_TARGET_BEFORE}'
  ) WHERE rn = 1
),
s0 AS (
  SELECT l_orderkey, l_linenumber, l_shipdate, l_quantity + 1.0 AS l_quantity, l_extendedprice, l_returnflag
  FROM li WHERE l_shipdate >= TIMESTAMP '{W.LINE_SOURCE_FROM}'
),
s AS (SELECT * EXCLUDE (rn) FROM (SELECT *, {_LATEST_LINE} AS rn FROM s0) WHERE rn = 1)
SELECT coalesce(t.l_orderkey, s.l_orderkey) AS l_orderkey,
       coalesce(t.l_linenumber, s.l_linenumber) AS l_linenumber,
       CASE WHEN s.l_orderkey IS NOT NULL THEN s.l_shipdate ELSE t.l_shipdate END AS l_shipdate,
       CASE WHEN s.l_orderkey IS NOT NULL THEN s.l_quantity ELSE t.l_quantity END AS l_quantity,
       CASE WHEN s.l_orderkey IS NOT NULL THEN s.l_extendedprice ELSE t.l_extendedprice END AS l_extendedprice,
       CASE WHEN s.l_orderkey IS NOT NULL THEN s.l_returnflag ELSE t.l_returnflag END AS l_returnflag,
       CASE WHEN s.l_orderkey IS NOT NULL AND t.l_orderkey IS NOT NULL THEN 'updated'
            WHEN s.l_orderkey IS NOT NULL THEN 'inserted' ELSE 'kept' END AS action
FROM t FULL OUTER JOIN s ON t.l_orderkey = s.l_orderkey AND t.l_linenumber = s.l_linenumber
"""

_MERGE_DUP = f"""
WITH t AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority
  FROM orders WHERE o_orderdate < TIMESTAMP '{W.MERGE_TARGET_BEFORE}'
),
o AS (SELECT * FROM orders WHERE o_orderdate >= TIMESTAMP '{W.MERGE_SOURCE_FROM}'),
u AS (
  SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderdate FROM o
  UNION ALL
  SELECT o_orderkey, 'F' AS o_orderstatus, o_totalprice + 5.0 AS o_totalprice,
         o_orderdate + INTERVAL 30 DAY AS o_orderdate
  FROM o WHERE o_orderstatus = 'P'
),
s AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY o_orderkey
      ORDER BY o_orderdate DESC, o_orderstatus DESC, o_totalprice DESC) AS rn FROM u
  ) WHERE rn = 1
)
SELECT coalesce(t.o_orderkey, s.o_orderkey) AS o_orderkey,
       t.o_custkey,
       CASE WHEN s.o_orderkey IS NOT NULL THEN s.o_orderstatus ELSE t.o_orderstatus END AS o_orderstatus,
       CASE WHEN s.o_orderkey IS NOT NULL THEN s.o_totalprice ELSE t.o_totalprice END AS o_totalprice,
       t.o_orderpriority,
       s.o_orderdate,
       {_ACTION}
FROM t FULL OUTER JOIN s ON t.o_orderkey = s.o_orderkey
"""

_DEL_KEYS = "SELECT 1 FROM customer c WHERE c.c_mktsegment = 'AUTOMOBILE' AND c.c_custkey = o.o_custkey"
_DELETE = f"SELECT * FROM orders o WHERE NOT EXISTS ({_DEL_KEYS})"
_DELETE_COUNT = f"SELECT count(*) AS deleted_count FROM orders o WHERE EXISTS ({_DEL_KEYS})"

_TABLE_COUNTS = "\nUNION ALL\n".join(
    f"SELECT 'F0001' AS f_number, 'testdata' AS api, '{W.AUDIT_CLOCK}' AS inserted_at, "
    f"count(*) AS inserted_count, CAST(0 AS BIGINT) AS updated_count, '{name}' AS table_name FROM {name}"
    for name in W.TABLES
)

_ROUTE = """
SELECT c_custkey,
       CASE WHEN c_mktsegment = 'BUILDING' THEN 'F' || lpad(CAST(c_nationkey AS VARCHAR), 4, '0')
            WHEN c_acctbal < 0 THEN 'RESTRICTED_DB'
            ELSE 'SHARED_DB' END AS database
FROM customer
"""

_DATE_PARTITION = """
SELECT CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month,
       CAST(day(ts) AS INTEGER) AS day, count(*) AS rows
FROM events GROUP BY 1, 2, 3
"""


def _backfill_sql() -> str:
    start = _dt.date.fromisoformat(W.BACKFILL_START)
    last = _dt.date.fromisoformat(W.BACKFILL_AS_OF) - _dt.timedelta(days=1)
    first_month = start.replace(day=1)
    last_month = last.replace(day=1)
    return f"""
WITH m AS (
  SELECT unnest(generate_series(TIMESTAMP '{first_month} 00:00:00', TIMESTAMP '{last_month} 00:00:00', INTERVAL 1 MONTH)) AS m
),
sl AS (
  SELECT CAST(year(m) AS INTEGER) AS year,
         greatest(m, TIMESTAMP '{start} 00:00:00') AS slice_start,
         least(m + INTERVAL 1 MONTH - INTERVAL 1 MICROSECOND, TIMESTAMP '{last} 23:59:59.999999') AS slice_end
  FROM m
)
SELECT sl.year, sl.slice_start, sl.slice_end, count(e.event_id) AS rows
FROM sl LEFT JOIN events e ON e.ts BETWEEN sl.slice_start AND sl.slice_end
GROUP BY 1, 2, 3
"""


def _slices_by_year_sql() -> str:
    per_slice = _backfill_sql()
    return f"""
WITH ps AS ({per_slice})
SELECT year, CAST(count(*) AS INTEGER) AS slices, min(slice_start) AS first_start,
       max(slice_end) AS last_end, CAST(sum(rows) AS BIGINT) AS rows
FROM ps GROUP BY year
"""


def _merge_audit_sql() -> str:
    from tidesync.plans.audit import stable_id

    return f"""
WITH {_MERGE_TS}
SELECT 'F0001' AS f_number, 'testdata' AS api, '{W.AUDIT_CLOCK}' AS inserted_at,
       count(*) FILTER (WHERE s.o_orderkey IS NOT NULL AND t.o_orderkey IS NULL) AS inserted_count,
       count(*) FILTER (WHERE s.o_orderkey IS NOT NULL AND t.o_orderkey IS NOT NULL) AS updated_count,
       'orders' AS table_name, '{stable_id("run-1", "orders")}' AS id
FROM t FULL OUTER JOIN s ON t.o_orderkey = s.o_orderkey
"""


def _yesterday_sql() -> str:
    d = _dt.date.fromisoformat(W.YESTERDAY_AS_OF) - _dt.timedelta(days=1)
    return f"""
SELECT event_id, ts, user_id, event_type, value FROM events
WHERE ts BETWEEN TIMESTAMP '{d} 00:00:00' AND TIMESTAMP '{d} 23:59:59'
"""


_XML = """
SELECT p_partkey,
       CASE WHEN p_type = 'SMALL' THEN NULL ELSE p_partkey END AS doc_id,
       CASE WHEN p_type = 'SMALL' THEN NULL ELSE p_name END AS name,
       CASE WHEN p_type = 'SMALL' THEN NULL ELSE p_brand END AS brand,
       CASE WHEN p_type = 'SMALL' THEN NULL ELSE CAST(p_size AS VARCHAR) END AS size,
       p_type = 'SMALL' AS broken
FROM part
"""

_CSV = "SELECT *, 'csv' AS file_kind FROM supplier"

_SQL_STRINGS = """
SELECT CAST(n.n_nationkey AS VARCHAR) AS n_nationkey, n.n_name, r.r_name,
       CAST(n.n_regionkey AS VARCHAR) AS n_regionkey
FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey
"""

_STREAM = "SELECT * FROM events"

_UNESCAPE = 'SELECT p_partkey AS partkey, p_name AS part___name, p_brand AS "brand.name" FROM part'

_REQUEST_FILTER = """
SELECT CAST(p_partkey AS BIGINT) AS part_key, p_name AS name, p_brand AS brand, p_size AS size
FROM part WHERE contains(p_name, 'ring') AND p_size >= 10 AND p_size <= 30
"""

_MATERIALS = """
WITH pg AS (
  SELECT CAST(floor(p_partkey / 20) AS BIGINT) + 1 AS page, bool_or(p_size = 50) AS failed
  FROM part GROUP BY 1
),
s AS (
  SELECT CAST(p.p_partkey AS VARCHAR) AS part_number, p.p_name AS material_name, p.p_type AS material_type,
         CASE WHEN p.p_size < 10 THEN 'EA' END AS unit, p.p_brand AS material_id,
         CAST(NULL AS VARCHAR) AS description, CAST(p.p_retailprice AS VARCHAR) AS cost,
         CAST(p.p_size AS DECIMAL(38,0)) AS order_lead_time,
         CAST(CASE WHEN p.p_size > 45 THEN 1 ELSE 0 END AS DECIMAL(38,0)) AS material_hidden
  FROM part p JOIN pg ON CAST(floor(p.p_partkey / 20) AS BIGINT) + 1 = pg.page
  WHERE NOT pg.failed
),
t AS (
  SELECT CAST(p_partkey AS VARCHAR) AS part_number, upper(p_name) AS material_name,
         CAST(p_size AS DECIMAL(38,0)) AS order_lead_time
  FROM part WHERE p_size <= 25
)
SELECT coalesce(t.part_number, s.part_number) AS part_number,
       CASE WHEN s.part_number IS NOT NULL THEN s.material_name ELSE t.material_name END AS material_name,
       s.material_type, s.unit, s.material_id, s.description, s.cost,
       CAST(NULL AS VARCHAR) AS account, CAST(NULL AS VARCHAR) AS storage_condition,
       CAST(NULL AS VARCHAR) AS recomended_shelf_life, CAST(NULL AS VARCHAR) AS retest_period,
       CAST(NULL AS VARCHAR) AS expiry_period, CAST(NULL AS VARCHAR) AS alert_level_quantity,
       CAST(NULL AS VARCHAR) AS reorder_level_quantity,
       CASE WHEN s.part_number IS NOT NULL THEN s.order_lead_time ELSE t.order_lead_time END AS order_lead_time,
       s.material_hidden,
       CAST(NULL AS DECIMAL(38,0)) AS material_master_data,
       CASE WHEN s.part_number IS NOT NULL AND t.part_number IS NOT NULL THEN 'updated'
            WHEN s.part_number IS NOT NULL THEN 'inserted' ELSE 'kept' END AS action
FROM t FULL OUTER JOIN s ON t.part_number = s.part_number
"""

_USAGE = """
SELECT 'R' || CAST(l.l_orderkey AS VARCHAR) AS inventory_receipt_number,
       CAST(l.l_linenumber AS DECIMAL(38,0)) AS usage_sequence,
       l.l_shipdate AS used_date,
       CAST(l.l_quantity AS VARCHAR) AS used_quantity,
       l.l_returnflag AS purpose
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
WHERE o.o_orderstatus = 'O'
"""

_SYNC_RUN = """
WITH pg AS (
  SELECT CAST(floor(p_partkey / 20) AS BIGINT) + 1 AS page, bool_or(p_size = 50) AS failed
  FROM part GROUP BY 1
),
s AS (
  SELECT CAST(p.p_partkey AS VARCHAR) AS part_number, p.p_name AS material_name, p.p_type AS material_type,
         CASE WHEN p.p_size < 10 THEN 'EA' END AS unit, p.p_brand AS material_id,
         CAST(NULL AS VARCHAR) AS description, CAST(p.p_retailprice AS VARCHAR) AS cost,
         CAST(NULL AS VARCHAR) AS account, CAST(NULL AS VARCHAR) AS storage_condition,
         CAST(NULL AS VARCHAR) AS recomended_shelf_life, CAST(NULL AS VARCHAR) AS retest_period,
         CAST(NULL AS VARCHAR) AS expiry_period, CAST(NULL AS VARCHAR) AS alert_level_quantity,
         CAST(NULL AS VARCHAR) AS reorder_level_quantity,
         CAST(p.p_size AS DECIMAL(38,0)) AS order_lead_time,
         CAST(CASE WHEN p.p_size > 45 THEN 1 ELSE 0 END AS DECIMAL(38,0)) AS material_hidden,
         CAST(NULL AS DECIMAL(38,0)) AS material_master_data
  FROM part p JOIN pg ON CAST(floor(p.p_partkey / 20) AS BIGINT) + 1 = pg.page
  WHERE NOT pg.failed
)
SELECT s.*, (SELECT count(*) FROM s) AS audit_inserted, CAST(0 AS BIGINT) AS audit_updated FROM s
"""

_MERGE_NULLS = f"""
WITH {_MERGE_TS},
tn AS (SELECT * REPLACE (CASE WHEN o_orderpriority <> '3-MEDIUM' THEN o_orderkey END AS o_orderkey) FROM t),
sn AS (SELECT * REPLACE (CASE WHEN o_orderstatus IS NOT NULL THEN o_orderkey END AS o_orderkey), 1 AS there FROM s)
SELECT coalesce(t.o_orderkey, s.o_orderkey) AS o_orderkey,
       t.o_custkey,
       CASE WHEN s.there = 1 THEN s.o_orderstatus ELSE t.o_orderstatus END AS o_orderstatus,
       CASE WHEN s.there = 1 THEN s.o_totalprice ELSE t.o_totalprice END AS o_totalprice,
       t.o_orderpriority,
       CASE WHEN s.there = 1 AND t.here = 1 THEN 'updated' WHEN s.there = 1 THEN 'inserted' ELSE 'kept' END AS action
FROM (SELECT *, 1 AS here FROM tn) t FULL OUTER JOIN sn s ON t.o_orderkey = s.o_orderkey
"""

_SMALL_DELTA = """
WITH top AS (
  SELECT max({'p': o_totalprice, 'k': o_orderkey}).k AS o_orderkey FROM orders GROUP BY floor(o_orderkey / 10000.0)
)
SELECT * REPLACE (CASE WHEN o_orderkey IN (SELECT o_orderkey FROM top) THEN 'X' ELSE o_orderstatus END AS o_orderstatus) FROM orders
"""

_TABLE_DELETE = """
SELECT *, (SELECT count(*) FROM orders WHERE o_orderpriority = '5-LOW') AS deleted_count
FROM orders WHERE o_orderpriority <> '5-LOW'
"""

_METRICS = "SELECT CAST(count(*) AS VARCHAR) AS rows, CAST(count(DISTINCT o_custkey) AS VARCHAR) AS customers FROM orders"

_CSV_INFERRED = """
SELECT CAST(c_custkey AS INTEGER) AS c_custkey, c_name, CAST(c_nationkey AS INTEGER) AS c_nationkey,
       CAST(c_acctbal AS DOUBLE) AS c_acctbal, c_mktsegment
FROM customer
"""

_XML_DOCUMENTS = """
SELECT CAST(s_suppkey AS BIGINT) AS s_suppkey, s_name AS name, false AS broken FROM supplier WHERE s_acctbal >= 0
UNION ALL
SELECT CAST(NULL AS BIGINT), CAST(count(*) AS VARCHAR), true FROM supplier WHERE s_acctbal < 0
"""

_ROUTED = "SELECT * FROM customer WHERE c_mktsegment <> 'BUILDING' AND c_acctbal < 0"

_SKIP_EMPTY = """
WITH pg AS (SELECT CAST(floor(p_partkey / 20) AS BIGINT) AS page, bool_or(p_size = 50) AS failed FROM part GROUP BY 1)
SELECT 'materials_query' AS table_name, count(*) AS inserted, false AS skipped, true AS audited
FROM part JOIN pg ON CAST(floor(p_partkey / 20) AS BIGINT) = pg.page WHERE NOT pg.failed
UNION ALL
SELECT 'specifications_query', CAST(0 AS BIGINT), true, false
"""

_BACKFILL_READ = f"""
SELECT event_id, ts, event_type, value, date_trunc('day', ts)::TIMESTAMP AS slice_start FROM events
WHERE ts >= TIMESTAMP '{W.BACKFILL_START} 00:00:00' AND ts < TIMESTAMP '{W.BACKFILL_AS_OF} 00:00:00'
  AND NOT (ts >= TIMESTAMP '{W.LOADED_FROM} 00:00:00' AND ts < TIMESTAMP '{W.LOADED_AS_OF} 00:00:00')
"""

_SQL_TABLES = """
SELECT CAST(c_nationkey AS VARCHAR) AS c_nationkey, o_orderstatus, CAST(count(*) AS VARCHAR) AS orders,
       CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS VARCHAR) AS total
FROM orders JOIN customer ON o_custkey = c_custkey
WHERE c_mktsegment = 'BUILDING' AND o_orderdate >= TIMESTAMP '1996-01-01 00:00:00'
GROUP BY c_nationkey, o_orderstatus
"""

_XML_VARIANT = """
SELECT 'part' AS root, lpad(CAST(p_partkey AS VARCHAR), 8, '0') AS key, p_name AS name, CAST(p_size AS VARCHAR) AS code, p_type AS second_tag, CAST(1 AS BIGINT) AS documents FROM part
UNION ALL SELECT 's:supplier', CAST(s_suppkey AS VARCHAR), s_name, '0' || CAST(s_nationkey AS VARCHAR), NULL, 1 FROM supplier
UNION ALL SELECT 'customer', lpad(CAST(c_custkey AS VARCHAR), 9, '0'), c_mktsegment, NULL, NULL, 1 FROM customer WHERE NOT coalesce(c_acctbal < 0, false)
UNION ALL SELECT 'broken', NULL, NULL, NULL, NULL, count(*) FROM customer WHERE c_acctbal < 0
"""

_CSV_TYPES = """
SELECT CAST(p_partkey AS INTEGER) AS id, lpad(CAST(p_partkey AS VARCHAR), 7, '0') AS code,
       CAST(CASE WHEN p_size < 20 THEN CAST(p_size AS VARCHAR) ELSE p_size || '.' || (p_size % 10) || '5' END AS DECIMAL(38,2)) AS amount,
       CASE WHEN p_size < 20 THEN TIMESTAMP '2024-01-02 00:00:00' ELSE TIMESTAMP '2024-01-02 03:04:00' + to_seconds(p_size) END AS at,
       CASE WHEN p_size <> 7 THEN p_size % 2 = 0 END AS flag,
       CASE WHEN p_size < 20 THEN CAST(p_size AS VARCHAR) ELSE p_brand END AS note,
       CAST(CASE WHEN p_size < 20 THEN p_size ELSE p_partkey + 3000000000 END AS BIGINT) AS count,
       (SELECT count(*) FROM part WHERE p_size = 50) AS bad_rows
FROM part WHERE p_size <> 50
"""

_XML_RECORDS = """
SELECT s_suppkey, s_name AS name, CAST(s_nationkey AS BIGINT) AS nation, CAST(1 AS BIGINT) AS records FROM supplier WHERE NOT coalesce(s_acctbal < 0, false)
UNION ALL SELECT NULL, 'broken', NULL, count(*) FROM supplier WHERE s_acctbal < 0
"""

ORACLE_SQL: dict[str, str] = {
    "q_digest_dedup": "SELECT DISTINCT * FROM documents",
    "q_xml_records": _XML_RECORDS,
    "q_csv_types": _CSV_TYPES,
    "q_backfill_read": _BACKFILL_READ,
    "q_sql_tables": _SQL_TABLES,
    "q_xml_variant": _XML_VARIANT,
    "q_snapshot_merge": _SNAPSHOT_SOURCE,
    "q_page_envelope": _PAGE_ENVELOPE,
    "q_detail_lookup": _DETAIL_LOOKUP,
    "q_union_snapshots": _UNION,
    "q_rename_project": _RENAME,
    "q_blank_to_null": _BLANK,
    "q_required_split": _REQUIRED,
    "q_lax_int": _LAX_INT,
    "q_cast_types": _CAST,
    "q_snapshot_filter": _FILTER,
    "q_json_member": _JSON,
    "q_full_dedup": _FULL_DEDUP,
    "q_duplicate_count": _DUP_COUNT,
    "q_subset_dedup": _SUBSET,
    "q_merge_rows": _MERGE_ROWS,
    "q_merge_counts": _MERGE_COUNTS,
    "q_merge_composite": _MERGE_COMPOSITE,
    "q_merge_duplicate_keys": _MERGE_DUP,
    "q_table_upsert": _TABLE_UPSERT,
    "q_delete_by_keys": _DELETE,
    "q_delete_count": _DELETE_COUNT,
    "q_table_counts": _TABLE_COUNTS,
    "q_tenant_route": _ROUTE,
    "q_date_partition": _DATE_PARTITION,
    "q_backfill_slices": _backfill_sql(),
    "q_yesterday": _yesterday_sql(),
    "q_xml_split": _XML,
    "q_csv_round_trip": _CSV,
    "q_sql_strings": _SQL_STRINGS,
    "q_archive_stream": _STREAM,
    "q_slices_by_year": _slices_by_year_sql(),
    "q_merge_audit": _merge_audit_sql(),
    "q_unescape_names": _UNESCAPE,
    "q_request_filter": _REQUEST_FILTER,
    "q_json_sink": "SELECT * FROM events",
    "q_parquet_gzip": "SELECT * FROM lineitem",
    "q_materials_snapshot": _MATERIALS,
    "q_usage_detail": _USAGE,
    "q_sync_run": _SYNC_RUN,
    "q_merge_null_keys": _MERGE_NULLS,
    "q_small_delta": _SMALL_DELTA,
    "q_table_delete": _TABLE_DELETE,
    "q_metrics": _METRICS,
    "q_quoted_names": "SELECT p_partkey, p_name AS part_name FROM part",
    "q_csv_inferred": _CSV_INFERRED,
    "q_xml_documents": _XML_DOCUMENTS,
    "q_file_listing": "SELECT 'txt' AS extension, count(*) AS files, true AS filled FROM supplier",
    "q_routed_write": _ROUTED,
    "q_skip_empty": _SKIP_EMPTY,
    **snapshots.ORACLE_SQL,
}
