"""DuckDB statements that compute, from the raw generated tables, what each
registered query returns. Column names and types follow the Spark result
(DuckDB ``year()`` is BIGINT, so it is cast to INTEGER like Spark's)."""

from __future__ import annotations

_RN_EVENTS = ("row_number() OVER (PARTITION BY user_id, event_type "
              "ORDER BY ts DESC NULLS LAST, event_id DESC NULLS LAST) = 1")
_YMD = ('CAST(year({c}) AS INTEGER) AS "year", CAST(month({c}) AS INTEGER) AS "month", '
        'CAST({c} AS DATE) AS "date"')
_DEDUP_EVENTS = f"SELECT * FROM events QUALIFY {_RN_EVENTS}"
_NEWEST_HOURS = ("SELECT DISTINCT date_trunc('hour', ts) AS hr FROM events "
                 "ORDER BY hr DESC LIMIT {n}")
_LOOKUP = ("SELECT o_custkey AS shop_id, o_totalprice AS lp FROM orders "
           "WHERE o_custkey % 3 <> 0 QUALIFY row_number() OVER "
           "(PARTITION BY o_custkey ORDER BY o_orderdate DESC NULLS LAST, "
           "o_orderkey DESC NULLS LAST) = 1")


def _upsert_sql(op: str, with_action: bool = True) -> str:
    side = ("SELECT event_id, ts, CASE WHEN user_id % 10 <> 0 THEN user_id END AS user_id, "
            "event_type, value, props FROM ({src})")
    t = side.format(src=f"SELECT * FROM events WHERE ts < TIMESTAMP '2024-01-20' QUALIFY {_RN_EVENTS}")
    s = side.format(src=f"SELECT * FROM events WHERE ts >= TIMESTAMP '2024-01-19' QUALIFY {_RN_EVENTS}")
    key = "t.user_id = s.user_id AND t.event_type = s.event_type"
    a = (lambda v: f", '{v}' AS action") if with_action else (lambda v: "")
    return f"""WITH t AS ({t}), s AS ({s})
SELECT s.*{a('insert')} FROM s WHERE NOT EXISTS (SELECT 1 FROM t WHERE {key})
UNION ALL
SELECT t.*{a('keep')} FROM t WHERE NOT EXISTS (SELECT 1 FROM s WHERE {key} AND s.ts {op} t.ts)
UNION ALL
SELECT s.*{a('update')} FROM s JOIN t ON {key} WHERE s.ts {op} t.ts"""


_LOADED = f"SELECT *, {_YMD.format(c='ts')} FROM ({_DEDUP_EVENTS}) d"

_HISTORY = f"""WITH t AS (SELECT * FROM events WHERE ts < TIMESTAMP '2024-01-20' QUALIFY {_RN_EVENTS}),
s AS (SELECT *, EXISTS (SELECT 1 FROM t WHERE t.user_id = e.user_id AND t.event_type = e.event_type) AS known
  FROM events e WHERE ts > (SELECT max(ts) FROM t) QUALIFY {_RN_EVENTS})
SELECT 'CREATE' AS operation, count(*) AS source_rows, count(*) AS inserted,
  CAST(0 AS BIGINT) AS updated, CAST(0 AS BIGINT) AS deleted FROM t
UNION ALL
SELECT 'MERGE', count(*), count(*) FILTER (WHERE NOT known), count(*) FILTER (WHERE known), CAST(0 AS BIGINT) FROM s"""

_FACT_REVENUE = f"""WITH f AS (
  SELECT event_id, ts AS created_at, user_id AS shop_id, event_type, value AS daily_sales
  FROM events QUALIFY {_RN_EVENTS}),
p AS ({_LOOKUP})
SELECT f.shop_id, f.event_id, f.created_at, f.event_type, f.daily_sales,
       {_YMD.format(c='f.created_at')},
       coalesce(p.lp, 0) AS price, f.daily_sales * coalesce(p.lp, 0) AS revenue
FROM f LEFT JOIN p ON p.shop_id = f.shop_id"""

ORACLE_SQL: dict[str, str] = {
    "scan_projection": "SELECT event_id, ts, user_id, event_type, value FROM events",
    "schema_enforced_read": (
        "SELECT event_id, ts, CAST(user_id AS DECIMAL(20,0)) AS user_id, event_type, value, "
        "CAST(NULL AS VARCHAR) AS channel FROM events"),
    "landing_latest_folders": (
        "SELECT event_id, ts, user_id, event_type, value, props FROM events "
        f"WHERE date_trunc('hour', ts) IN ({_NEWEST_HOURS.format(n=2)})"),
    "landing_full_snapshot": (
        "SELECT event_id, ts, user_id, event_type, value, props FROM events "
        "WHERE date_trunc('hour', ts) = (SELECT max(date_trunc('hour', ts)) FROM events)"),
    "landing_corrupt_tolerance": "SELECT event_id, ts, user_id, event_type, value, props FROM events",
    "landing_schema_drift": f"""SELECT * FROM (VALUES
  ('drift_excluded', 'SUCCESS', (SELECT count(*) FROM (SELECT * FROM events
     WHERE date_trunc('hour', ts) IN ({_NEWEST_HOURS.format(n=2)}) QUALIFY {_RN_EVENTS}) d),
   CAST(1 AS BIGINT)),
  ('drift_fatal', 'FAILED', CAST(0 AS BIGINT), CAST(0 AS BIGINT)))
  AS r(table_name, status, row_count, skipped_files)""",
    "cast_columns": (
        "SELECT o_orderkey, CAST(o_custkey AS INTEGER) AS o_custkey, o_orderstatus, o_totalprice, "
        "o_orderdate, TRY_CAST(o_orderpriority AS INTEGER) AS o_orderpriority FROM orders"),
    "alias_columns": (
        "SELECT o_orderkey, o_orderkey AS o_custkey, o_orderstatus, o_totalprice, o_orderdate, "
        "o_orderpriority, o_totalprice AS price, o_totalprice AS list_price FROM orders"),
    "derive_ymd": f"SELECT *, {_YMD.format(c='ts')} FROM events",
    "transform_chain": (
        "SELECT o_orderkey, CAST(o_custkey AS INTEGER) AS o_custkey, o_orderstatus, o_totalprice, "
        f"o_orderdate, o_orderpriority, {_YMD.format(c='o_orderdate')}, o_orderdate AS order_ts "
        "FROM orders"),
    "dedup_latest": _DEDUP_EVENTS,
    "dedup_no_timestamp": "SELECT * FROM nation UNION ALL SELECT * FROM nation",
    "dedup_exact_copies": "SELECT * FROM nation",
    "dedup_date_timestamp": (
        "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, "
        "CAST(o_orderdate AS TIMESTAMP) AS o_orderdate, o_orderpriority FROM orders "
        "QUALIFY row_number() OVER (PARTITION BY o_custkey "
        "ORDER BY o_orderdate DESC NULLS LAST, o_orderkey DESC NULLS LAST) = 1"),
    "latest_price": (
        "SELECT o_custkey, o_totalprice AS listing_price FROM orders WHERE o_custkey IS NOT NULL "
        "QUALIFY row_number() OVER (PARTITION BY o_custkey "
        "ORDER BY o_orderdate DESC NULLS LAST, o_orderkey DESC NULLS LAST) = 1"),
    "dedup_dirty_keys": (
        "SELECT * FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber "
        "ORDER BY l_shipdate DESC NULLS LAST, l_partkey DESC NULLS LAST, l_suppkey DESC NULLS LAST, "
        "l_quantity DESC NULLS LAST, l_extendedprice DESC NULLS LAST, l_discount DESC NULLS LAST, "
        "l_tax DESC NULLS LAST, l_returnflag DESC NULLS LAST, l_linestatus DESC NULLS LAST) = 1"),
    "price_revenue": f"""WITH p AS ({_LOOKUP})
SELECT e.user_id AS shop_id, e.event_id, e.ts, e.event_type, e.value AS daily_sales, e.props,
       coalesce(p.lp, 0) AS price, e.value * coalesce(p.lp, 0) AS revenue
FROM events e LEFT JOIN p ON p.shop_id = e.user_id""",
    "watermark_max": "SELECT max(ts) AS watermark FROM events WHERE ts < TIMESTAMP '2024-01-20'",
    "incremental_filter": (
        "SELECT * FROM events WHERE ts > "
        "(SELECT max(ts) FROM events WHERE ts < TIMESTAMP '2024-01-20')"),
    "incremental_filter_pruned": (
        "SELECT * FROM events WHERE ts > "
        "(SELECT max(ts) FROM events WHERE ts < TIMESTAMP '2024-01-20')"),
    "date_watermark_filter": (
        'SELECT event_id, ts, user_id, event_type, value, props, CAST(ts AS DATE) AS "date" '
        "FROM events WHERE CAST(ts AS DATE) > "
        "(SELECT max(CAST(ts AS DATE)) FROM events WHERE ts < TIMESTAMP '2024-01-20')"),
    "upsert_gt": _upsert_sql(">"),
    "upsert_ge": _upsert_sql(">="),
    "upsert_metrics": f"SELECT action, count(*) AS n FROM ({_upsert_sql('>')}) u GROUP BY action",
    "upsert_fixed_partition": """WITH t AS (
  SELECT *, CAST(year(o_orderdate) AS INTEGER) AS o_year, CAST(o_orderdate AS TIMESTAMP) AS version_ts
  FROM orders WHERE o_orderdate < DATE '1998-01-01'),
s AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice * 1.1 AS o_totalprice, o_orderdate,
         o_orderpriority, CAST(year(o_orderdate) AS INTEGER) AS o_year,
         CAST(o_orderdate + INTERVAL 30 DAY AS TIMESTAMP) AS version_ts
  FROM orders WHERE o_orderstatus = 'O' OR o_orderdate >= DATE '1998-01-01')
SELECT * FROM t WHERE o_orderkey NOT IN (SELECT o_orderkey FROM s)
UNION ALL SELECT * FROM s""",
    "upsert_key_index": """SELECT o_orderkey, o_custkey, o_orderstatus,
  CASE WHEN hit THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice, o_orderdate, o_orderpriority,
  CAST(year(o_orderdate) AS INTEGER) AS o_year,
  CAST(CASE WHEN hit THEN o_orderdate + INTERVAL 1 DAY ELSE o_orderdate END AS TIMESTAMP) AS version_ts
FROM (SELECT *, o_orderdate >= DATE '1998-01-01' OR (o_orderkey % 50 = 1 AND year(o_orderdate) IN (1994, 1996)) AS hit
      FROM orders)""",
    "upsert_hash_ranges": """SELECT o_orderkey, o_custkey, o_orderstatus,
  CASE WHEN hit THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice, o_orderdate, o_orderpriority,
  CAST(CASE WHEN hit THEN o_orderdate + INTERVAL 1 DAY ELSE o_orderdate END AS TIMESTAMP) AS version_ts
FROM (SELECT *, o_orderdate >= DATE '1998-01-01' OR o_orderkey % 50 = 1 AS hit FROM orders)""",
    "stable_view_switch": (
        "SELECT *, CAST(ts AS DATE) AS day FROM events "
        "QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id DESC NULLS LAST) = 1"),
    "latest_load_history": (
        "SELECT o_orderpriority AS table_name, o_orderdate AS ts, o_orderstatus AS operation, "
        "o_orderkey AS load_id, o_totalprice AS rows_written FROM orders "
        "QUALIFY row_number() OVER (PARTITION BY o_orderpriority "
        "ORDER BY o_orderdate DESC NULLS LAST, o_orderkey DESC NULLS LAST) = 1"),
    "create_on_missing": _DEDUP_EVENTS,
    "full_overwrite_partitioned": f"SELECT *, {_YMD.format(c='ts')} FROM events",
    "raw_incremental_e2e": _LOADED,
    "raw_full_e2e": (
        "SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_acctbal, "
        "c_mktsegment FROM customer"),
    "clean_incremental_e2e": f"SELECT *, {_YMD.format(c='ts')} FROM ({_DEDUP_EVENTS}) d",
    "clean_full_e2e": _FACT_REVENUE,
    "run_report": f"""SELECT * FROM (VALUES
  ('report_events_latest', 'SUCCESS', (SELECT count(*) FROM ({_DEDUP_EVENTS}) d), 'FULL', 'FACT'),
  ('report_missing_source', 'FAILED', CAST(0 AS BIGINT), 'FULL', 'DIMENSION'),
  ('report_bad_type', 'FAILED', CAST(0 AS BIGINT), 'DELTA', 'DIMENSION'))
  AS r(table_name, status, row_count, load_type, category)""",
    "run_outcomes": ("SELECT count(*) + 2 AS total, count(n.k) AS success, count(*) - count(n.k) + 2 AS failed "
                     "FROM region LEFT JOIN (SELECT DISTINCT n_regionkey AS k FROM nation) n ON n.k = r_regionkey"),
    "clean_incremental_enriched": _FACT_REVENUE,
    "load_history": _HISTORY,
    "landing_missing_base": f"""SELECT * FROM (VALUES
  ('present', 'SUCCESS', (SELECT count(*) FROM (SELECT * FROM events
     WHERE date_trunc('hour', ts) IN ({_NEWEST_HOURS.format(n=1)}) QUALIFY {_RN_EVENTS}) d)),
  ('missing', 'FAILED', CAST(0 AS BIGINT)))
  AS r(table_name, status, row_count)""",
    "custom_transform": f"SELECT *, value > 50 AS high_value FROM ({_DEDUP_EVENTS}) d",
    "run_two_hops": _LOADED,
    "stream_upsert": f"SELECT *, {_YMD.format(c='ts')} FROM ({_DEDUP_EVENTS}) d",
    "stream_redelivery": f"SELECT *, CAST(0 AS BIGINT) AS replay_rewrote FROM ({_LOADED})",
    "stream_restart": _LOADED,
    "landing_late_files": f"SELECT *, CAST(0 AS BIGINT) AS rows_read_again FROM ({_LOADED})",
    "landing_snapshot_complete": "SELECT * FROM customer",
    "clean_arrival_watermark": _LOADED,
    "landing_schema_widen": f"""SELECT event_id, ts, user_id, event_type, CASE WHEN ts < TIMESTAMP '2024-01-20'
  THEN CAST(CAST(value AS FLOAT) AS DOUBLE) ELSE value END AS value, props, "year", "month", "date"
FROM ({_LOADED}) l""",
    "version_restore": f"""SELECT *, {_YMD.format(c='ts')}, 'first' AS state FROM (SELECT * FROM events
  WHERE ts < TIMESTAMP '2024-01-20' QUALIFY {_RN_EVENTS}) f
UNION ALL SELECT *, 'restored' FROM ({_LOADED}) l""",
    "run_resume": f"""SELECT * FROM (VALUES
  ('resume_events', 'SUCCESS', (SELECT count(*) FROM ({_DEDUP_EVENTS}) d), CAST(1 AS BIGINT)),
  ('resume_orders', 'SUCCESS', (SELECT count(*) FROM orders), CAST(1 AS BIGINT)),
  ('resume_reader', 'SUCCESS', (SELECT count(*) FROM orders), CAST(1 AS BIGINT)))
  AS r(table_name, status, row_count, loads)""",
    "revenue_latest_facts": _FACT_REVENUE,
}
