"""DuckDB twins of ``provtrail.sources.fixtures``."""

from __future__ import annotations


def uuid_of(n: str) -> str:
    h = f"md5(CAST({n} AS VARCHAR))"
    return " || '-' || ".join(f"substr({h}, {i}, {w})" for i, w in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12)))


RUN_EVENTS = f"""SELECT {uuid_of('event_id // 2')} AS run_id, event_id // 2 AS run_no,
    CASE WHEN event_id % 2 = 0 THEN 'START' WHEN event_type = 'error' THEN 'FAIL' ELSE 'COMPLETE' END AS event_type,
    'job_' || ((event_id // 2) % 50) AS job_name, ts AS event_time, event_id % 1000 AS row_count,
    event_id % 3 * 100 AS size_bytes, props AS message
    FROM events"""
ORPHANED_EVENTS = f"{RUN_EVENTS} WHERE NOT (event_id % 2 = 1 AND event_type = 'click')"

DATASET_PATHS = """SELECT page_id, CASE WHEN page_id % 25 = 0 THEN ''
    WHEN page_id % 9 = 0 THEN 's3://' || rest WHEN page_id % 9 = 1 THEN 's3a://' || rest
    WHEN page_id % 9 = 2 THEN 'gs://' || rest WHEN page_id % 9 = 3 THEN 'abfss://' || rest
    WHEN page_id % 9 = 4 THEN 'wasbs://' || rest WHEN page_id % 9 = 5 THEN 'hdfs://' || rest
    WHEN page_id % 9 = 6 THEN 'file:///' || rest WHEN page_id % 9 = 7 THEN '/' || rest ELSE url END AS path
    FROM (SELECT page_id, url, regexp_replace(url, '^https?://', '') AS rest FROM pages) p"""

CATALOG_PATHS = """SELECT s_suppkey, s_nationkey, CASE s_suppkey % 8
    WHEN 0 THEN 'postgres:dbname=db' || s_suppkey || ' host=h' || s_nationkey || ' port=5432 user=u password=secret'
    WHEN 1 THEN 'host=h' || s_nationkey || ' port=1 password=secret' WHEN 2 THEN 's3://bucket/' || s_name
    WHEN 3 THEN 'mysql:' || s_name WHEN 4 THEN '/data/' || s_name || '.db' WHEN 5 THEN ':memory:'
    WHEN 6 THEN '/tmp/host=a/port=b/' || s_name ELSE '' END AS path FROM supplier"""

# What the connection strings above become.
REDACTED = """CASE s_suppkey % 8 WHEN 0 THEN 'postgres://h' || s_nationkey || ':5432/db' || s_suppkey
    WHEN 1 THEN 'postgres://h' || s_nationkey || ':1' ELSE path END"""
SOURCE_URI = f"CASE WHEN s_suppkey % 8 IN (3, 4, 6) THEN 'file://' || path ELSE {REDACTED} END"
METADATA_URI = f"CASE WHEN s_suppkey % 8 IN (4, 6) THEN 'file://' || path ELSE {REDACTED} END"

TABLE_LOCATIONS = """SELECT p_partkey, 't' || p_partkey AS tbl, lower(p_type) AS schema,
    's3://wh/' || replace(p_brand, '#', '_') AS base FROM part"""

COLUMN_EDGES = """SELECT l_orderkey AS query_id, 'c' || (l_linenumber % 4) AS out_col, l_linenumber AS ordinal,
    'memory.main.s' || l_suppkey AS name, 'p' || (l_partkey % 20) AS field, l_returnflag = 'A' AS breaks FROM lineitem"""

OPERATIONS = """SELECT o_orderkey AS op_id, CASE o_orderkey % 9 WHEN 0 THEN 'CREATE_TABLE' WHEN 1 THEN 'INSERT'
    WHEN 2 THEN 'UPDATE' WHEN 3 THEN 'DELETE' WHEN 4 THEN 'COPY' WHEN 5 THEN 'CREATE_VIEW' WHEN 6 THEN 'ALTER'
    WHEN 7 THEN 'RENAME' ELSE CASE WHEN o_orderkey % 2 = 0 THEN 'DROP' ELSE 'FROBNICATE' END END AS operation,
    CASE WHEN o_orderkey % 4 <> 0 THEN 'lake' END AS catalog, 's' || (o_custkey % 10) AS schema,
    't' || (o_custkey % 40) AS tbl, o_orderdate AS event_time FROM orders"""

QUERY_INPUTS = """SELECT l_orderkey AS query_id, CAST(l_linenumber AS BIGINT) * 1000000 + l_partkey AS position,
    'spark' AS namespace, CASE WHEN l_suppkey % 10 = 0 THEN '__meta_' ELSE 'lake.s.' END || l_suppkey AS name
    FROM lineitem"""

QUERY_OUTPUTS = """SELECT o_orderkey AS query_id, 'spark' AS namespace, 'lake.out.c' || o_custkey AS name
    FROM orders"""

PLAN_NODES = """SELECT o_orderkey AS query_id, CAST(0 AS BIGINT) AS node_id, CAST(NULL AS BIGINT) AS parent_id,
        CASE o_orderpriority WHEN '1-URGENT' THEN 'INSERT' WHEN '2-HIGH' THEN 'CREATE_TABLE'
            WHEN '5-LOW' THEN 'SET' ELSE 'PROJECTION' END AS operator, NULL AS table_name FROM orders
    UNION ALL SELECT l_orderkey, CAST(l_linenumber AS BIGINT) * 1000000 + l_partkey,
        CASE WHEN l_linenumber = 1 THEN 0 ELSE 1 END,
        ['GET', 'COMPARISON_JOIN', 'AGGREGATE', 'WINDOW', 'DISTINCT', 'UNION', 'MATERIALIZED_CTE'][k + 1],
        CASE WHEN k = 0 THEN 'tbl-' || (l_partkey % 100) || '.' || l_suppkey END
    FROM (SELECT *, CASE WHEN l_partkey % 11 < 5 THEN 0 WHEN l_partkey % 11 < 7 THEN 1
        WHEN l_quantity > 45 THEN l_linenumber - 1 ELSE 0 END AS k FROM lineitem) l"""

DIRTY_NAMES = """SELECT p_partkey AS id, '-' || p_name || '.. ' || p_brand || ';é,' || p_type || '_' AS raw FROM part"""

TABLE_OPERATIONS = """SELECT o_orderkey AS op_id, CASE WHEN o_orderkey % 5 < 2 THEN 'CREATE_TABLE' WHEN o_orderkey % 5 = 2 THEN 'RENAME'
        WHEN o_orderkey % 5 = 3 THEN 'DROP' ELSE 'INSERT' END AS operation,
    't' || CASE WHEN o_orderkey % 5 = 2 THEN (o_custkey * 7 + o_orderkey) % 40 ELSE o_custkey % 40 END AS name,
    CASE WHEN o_orderkey % 5 = 2 THEN 't' || (o_custkey % 40) END AS previous_name, o_orderdate AS event_time FROM orders"""

VIEW_LOG = """SELECT CAST(o_orderkey AS VARCHAR) AS query_id, 'v' || (o_custkey % 20) AS view_name,
    o_orderdate + to_seconds(o_orderkey % 86400) AS event_time,
    CASE WHEN o_orderkey % 4 = 0 THEN 'CREATE_VIEW' WHEN o_orderkey % 31 = 1 THEN 'DROP_VIEW' END AS sink_op,
    CAST((o_orderkey // 4) % 3 AS INTEGER) AS turn FROM orders"""
