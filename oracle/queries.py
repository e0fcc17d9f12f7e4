"""Oracle SQL of the registered queries other than the shapes."""

from __future__ import annotations

from oracle import fixtures as fx
from oracle.lineage import REJECTED, UNTRACEABLE, VIEW_BASES, expected_columns, expected_fates, expected_inputs, expected_statements
from oracle.shapes import shape_sql
from provtrail.plans.shapes import shape_queries
from provtrail.plans.traced import traced_names

NAMES = traced_names()
TABLE_COLUMNS = {
    "orders": "o_orderkey bigint,o_custkey bigint,o_orderstatus string,o_totalprice double,"
              "o_orderdate timestamp_ntz,o_orderpriority string",
    "customer": "c_custkey bigint,c_name string,c_nationkey int,c_acctbal double,c_mktsegment string",
    "nation": "n_nationkey int,n_name string,n_regionkey int", "region": "r_regionkey int,r_name string",
    "supplier": "s_suppkey bigint,s_name string,s_nationkey int,s_acctbal double",
    "part": "p_partkey bigint,p_name string,p_brand string,p_type string,p_size int,p_retailprice double",
    "lineitem": "l_orderkey bigint,l_partkey bigint,l_suppkey bigint,l_linenumber int,l_quantity double,"
                "l_extendedprice double,l_discount double,l_tax double,l_returnflag string,l_linestatus string,"
                "l_shipdate timestamp_ntz",
    "events": "event_id bigint,ts timestamp_ntz,user_id bigint,event_type string,value double,props string",
    "documents": "doc_id bigint,text string,lang string,source string,n_chars bigint",
}
LOG = f"""SELECT CAST(o_orderkey AS VARCHAR) AS query_id, o_orderkey % {len(NAMES)} AS t,
    '_' || (o_custkey // 20) AS tenant FROM orders"""


def _log_counts() -> list[tuple]:
    """For each traced query: inputs and traced columns when nothing of the nations is told."""
    columns, inputs = expected_columns(), expected_inputs() | {"q29_series": {"Range"}}
    return [(i, n, len(inputs.get(n, set()) - {"nation"}), sum(
        1 for _, sources in columns.get(n, {}).values() if any(not s.startswith("nation.") for s in sources))) for i, n in enumerate(NAMES)]


def values(rows) -> str:
    def lit(v):
        return str(v) if isinstance(v, int) else "'" + v.replace("'", "''") + "'"

    return ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)


def _resolved_columns() -> str:
    rows = [
        (NAMES.index(q), col, kind, *source.split("."))
        for q, cols in expected_columns().items() for col, (kind, sources) in cols.items() for source in sorted(sources)]
    return f"""SELECT query_id, out_col, transformation_type,
        CASE WHEN tbl = 'Range' THEN tbl ELSE tbl || tenant END AS name, field FROM ({LOG}) log
        JOIN (VALUES {values(rows)}) e(t, out_col, transformation_type, tbl, field) USING (t)"""


def _scans() -> str:
    rows = []
    for q, names in expected_inputs().items():
        for n in names:
            base = VIEW_BASES.get(n, n)
            rows.append((NAMES.index(q), "spark", base, TABLE_COLUMNS[base]))
    rows.append((NAMES.index("q29_series"), "file", "Range", "id bigint"))
    return f"""SELECT query_id, namespace, CASE WHEN tbl = 'Range' THEN tbl ELSE tbl || tenant END AS name, fields
        FROM ({LOG}) log JOIN (VALUES {values(rows)}) e(t, namespace, tbl, fields) USING (t)"""


def _inputs() -> str:
    rows = [(NAMES.index(q), "spark", n, "VIEW" if n in VIEW_BASES else "TABLE")
            for q, names in expected_inputs().items() for n in names]
    rows.append((NAMES.index("q29_series"), "file", "Range", "TABLE"))
    return f"""SELECT query_id, namespace, CASE WHEN tbl = 'Range' THEN tbl ELSE tbl || tenant END AS name, dataset_type
        FROM ({LOG}) log JOIN (VALUES {values(rows)}) e(t, namespace, tbl, dataset_type) USING (t)"""


def _views() -> str:
    rows = [(NAMES.index(q), n, VIEW_BASES[n]) for q, names in expected_inputs().items() for n in names if n in VIEW_BASES]
    return f"""SELECT query_id, v || tenant AS view_name, b || tenant AS name
        FROM ({LOG}) log JOIN (VALUES {values(rows)}) e(t, v, b) USING (t)"""


def _statements() -> str:
    rows = [(NAMES.index(q), s) for q, s in expected_statements(NAMES).items()]
    return f"SELECT query_id, statement FROM ({LOG}) log JOIN (VALUES {values(rows)}) e(t, statement) USING (t)"


SPLIT = """CASE WHEN path = '' THEN {empty} WHEN strpos(path, '://') = 0 THEN {local}
    WHEN regexp_matches(path, '^(s3a?|gs|abfss|wasbs|hdfs)://') THEN {store}
    WHEN path LIKE 'file://%' THEN {file} ELSE {local} END"""
NAMESPACE = SPLIT.format(empty="'file'", local="'file'", file="'file'",
                         store="regexp_replace(regexp_extract(path, '^[a-z0-9]+://[^/]*'), '^s3a:', 's3:')")
NAME = SPLIT.format(empty="'unknown'", local="path", file="substr(path, 8)",
                    store="regexp_replace(path, '^[a-z0-9]+://[^/]*/?', '')")

REGISTRY = f"""SELECT *, 'cat_' || s_suppkey AS name, CASE s_suppkey % 7 WHEN 0 THEN 'system' WHEN 1 THEN 'temporary'
        WHEN 2 THEN 'lake' WHEN 3 THEN 'postgres' WHEN 4 THEN NULL ELSE 'native' END AS kind, {fx.METADATA_URI} AS uri,
        s_suppkey % 2 = 0 AS is_initial, s_suppkey % 3 = 0 AS is_read_only FROM ({fx.CATALOG_PATHS}) p"""
CATALOGS = f"""SELECT *, CASE WHEN type = 'system' THEN 'spark:system' WHEN type IN ('temporary', 'memory') THEN 'spark:memory'
        WHEN type <> 'unknown' THEN uri END AS metadata_uri FROM (SELECT *, CASE WHEN s_suppkey % 7 IN (0, 1) THEN kind
            WHEN s_suppkey % 8 IN (5, 7) THEN 'memory' WHEN kind IS NULL THEN 'unknown' WHEN kind <> 'native' THEN kind
            WHEN is_initial THEN 'native' WHEN is_read_only THEN 'attached_readonly' ELSE 'attached' END AS type
        FROM ({REGISTRY}) r) c"""
OP_NAMES = f"SELECT *, concat_ws('.', catalog, schema, tbl) AS name FROM ({fx.OPERATIONS}) o"
OP_STATE = """CASE WHEN operation IN ('INSERT', 'UPDATE', 'DELETE', 'COPY') THEN 'OVERWRITE'
    WHEN operation LIKE 'CREATE%' THEN 'CREATE' ELSE operation END"""
ISO = "strftime({}, '%Y-%m-%dT%H:%M:%S.%fZ')"
MERGED = f"""SELECT query_id, out_col, max(ordinal) AS ordinal FROM ({fx.COLUMN_EDGES}) e GROUP BY ALL"""
LAST_EDGES = f"SELECT e.* FROM ({fx.COLUMN_EDGES}) e JOIN ({MERGED}) m USING (query_id, out_col, ordinal)"
KINDS = f"""SELECT query_id, out_col, CASE WHEN bool_or(breaks) THEN 'INDIRECT' ELSE 'DIRECT' END AS transformation_type,
    COUNT(DISTINCT name || '/' || field) AS n_sources FROM ({LAST_EDGES}) x GROUP BY ALL"""

PROFILE = f"""SELECT query_id, arg_min(operator, node_id) AS root,
        count(*) FILTER (WHERE operator = 'COMPARISON_JOIN') AS join_count, count(*) AS node_count,
        list_sort(list(DISTINCT operator)) AS ops,
        array_to_string(list_transform(list_sort(list(struct_pack(a := node_id, b := table_name))
            FILTER (WHERE table_name IS NOT NULL))[1:3], lambda x: x.b), ',') AS tables FROM ({fx.PLAN_NODES}) n GROUP BY query_id"""
STATEMENT = f"""SELECT *, CASE WHEN root = 'INSERT' THEN 'INSERT' WHEN root = 'CREATE_TABLE' THEN 'CREATE_TABLE'
        WHEN list_contains(ops, 'UNION') THEN 'SELECT_UNION' WHEN list_contains(ops, 'MATERIALIZED_CTE') THEN 'SELECT_CTE'
        WHEN list_contains(ops, 'AGGREGATE') AND join_count > 0 THEN 'SELECT_AGG_JOIN'
        WHEN list_contains(ops, 'AGGREGATE') THEN 'SELECT_AGG' WHEN join_count > 1 THEN 'SELECT_MULTIJOIN'
        WHEN join_count > 0 THEN 'SELECT_JOIN' WHEN list_contains(ops, 'WINDOW') THEN 'SELECT_WINDOW'
        WHEN list_contains(ops, 'DISTINCT') THEN 'SELECT_DISTINCT' ELSE 'SELECT' END AS statement FROM ({PROFILE}) p"""
HASHED = "substr(sha256(CASE WHEN o_orderkey % 7 <> 0 THEN 'select ' || o_custkey ELSE 'plan ' || o_orderkey END), 1, 8)"
CLEAN = "trim(regexp_replace(regexp_replace({}, '[^A-Za-z0-9_ .,;-]', '', 'g'), '[_ .,;-]+', '_', 'g'), '_')"
# Table parts here are at most 12 characters, so all three fit into 55 behind a statement type.
JOB_NAMES = f"""SELECT query_id, statement, concat_ws('_', statement,
        CASE WHEN tables <> '' THEN replace(replace(replace(tables, '-', '_'), '.', '_'), ',', '_') END, {HASHED}) AS job_name
    FROM ({STATEMENT}) s JOIN orders ON query_id = o_orderkey"""

STARTS = f"""SELECT o_orderkey AS query_id, {fx.uuid_of('o_orderkey')} AS run_id, 'job_' || (o_custkey % 10) AS job_name,
    o_orderdate, o_custkey, o_orderstatus, o_orderpriority, CASE WHEN o_orderkey % 7 <> 0 THEN 'select ' || o_custkey END AS query,
    coalesce(i.n, 0) AS n_inputs, coalesce(i.names, '') AS input_names, 1 AS n_outputs, 'lake.out.c' || o_custkey AS output_name
    FROM orders LEFT JOIN (SELECT query_id, count(*) AS n, string_agg(name, ',' ORDER BY position, name) AS names FROM (
        SELECT query_id, name, min(position) AS position FROM ({fx.QUERY_INPUTS}) q GROUP BY ALL) d
        GROUP BY query_id) i ON query_id = o_orderkey"""
ENDS = f"""SELECT *, CASE WHEN o_orderstatus = 'O' THEN 'FAIL' ELSE 'COMPLETE' END AS eventType,
    o_orderstatus <> 'O' AS has_stats FROM ({STARTS}) s"""

BROKEN = f"""SELECT *, CASE WHEN n % 17 = 0 THEN 'runId is required' WHEN n % 19 = 0 THEN 'eventTime is required'
    WHEN n % 23 = 0 THEN 'job is required' WHEN n % 29 = 0 THEN 'runId is not a UUID' END AS reason
    FROM (SELECT *, run_no * 2 + CASE WHEN event_type = 'START' THEN 0 ELSE 1 END AS n FROM ({fx.RUN_EVENTS}) r) b"""
RUN_STATE = f"""SELECT run_id, max(job_name) AS job_name, min(event_time) FILTER (WHERE event_type = 'START') AS started,
    max(event_time) FILTER (WHERE event_type <> 'START') AS ended,
    coalesce(max(event_type) FILTER (WHERE event_type <> 'START'), 'START') AS state,
    max(row_count) FILTER (WHERE event_type <> 'START') AS row_count FROM ({fx.ORPHANED_EVENTS}) r GROUP BY run_id"""

# Names on a time line: what an operation ends comes before what it begins.
SPANS = f"""WITH RECURSIVE ops AS ({fx.TABLE_OPERATIONS}),
    line AS (
        SELECT op_id, name, event_time, operation, operation <> 'DROP' AS begins, CASE WHEN operation = 'DROP' THEN 1 ELSE 2 END AS place
        FROM ops WHERE operation <> 'INSERT'
        UNION ALL SELECT op_id, previous_name, event_time, 'RENAMED', false, 1 FROM ops WHERE operation = 'RENAME'),
    nexts AS (SELECT *, lead(event_time) OVER w AS valid_to, lead(operation) OVER w AS ended_as, lead(op_id) OVER w AS ended_by
        FROM line WINDOW w AS (PARTITION BY name ORDER BY event_time, op_id, place)),
    parts AS (SELECT * FROM nexts WHERE begins),
    linked AS (SELECT p.op_id, p.name, p.event_time AS valid_from, p.valid_to, p.ended_by, q.op_id AS renamed_from
        FROM parts p LEFT JOIN parts q ON p.operation = 'RENAME' AND q.ended_as = 'RENAMED' AND q.ended_by = p.op_id),
    up(op_id, cur) AS (SELECT op_id, op_id FROM linked
        UNION ALL SELECT up.op_id, l.renamed_from FROM up JOIN linked l ON l.op_id = up.cur WHERE l.renamed_from IS NOT NULL),
    roots AS (SELECT up.op_id, up.cur AS dataset FROM up JOIN linked l ON l.op_id = up.cur WHERE l.renamed_from IS NULL),
    spans AS (SELECT l.*, r.dataset FROM linked l JOIN roots r ON r.op_id = l.op_id)"""

# Sources of the columns of the views in the view log, by turn.
VIEW_COLUMNS = ((0, "id", "DIRECT", "orders", "o_orderkey"), (0, "label", "INDIRECT", "orders", "o_orderpriority"),
                (1, "id", "DIRECT", "customer", "c_custkey"), (1, "label", "DIRECT", "customer", "c_name"),
                (2, "id", "DIRECT", "orders", "o_orderkey"), (2, "label", "INDIRECT", "customer", "c_name"),
                (2, "label", "INDIRECT", "nation", "n_name"))
VIEW_INPUTS = ((0, "orders"), (1, "customer"), (2, "orders"), (2, "customer"), (2, "nation"))

# The layers of the traced pipeline and what each reads.
PIPELINE = {
    "line_waits": ("lineitem", "orders"), "supplier_places": ("supplier", "nation", "region"),
    "place_waits": ("line_waits", "supplier_places"), "brand_waits": ("line_waits", "supplier_places", "part"),
    "area_report": ("place_waits", "brand_waits")}

SQL: dict[str, str] = {
    "i01_normalize_paths": f"SELECT page_id, {NAMESPACE} AS namespace, {NAME} AS name FROM ({fx.DATASET_PATHS}) p",
    "i02_qualified_names": f"SELECT op_id, catalog || '.' || schema || '.' || tbl AS name FROM ({fx.OPERATIONS}) o",
    "i03_qualified_names_dropping": f"SELECT op_id, name FROM ({OP_NAMES}) n",
    "i04_source_uris": f"SELECT s_suppkey, {fx.SOURCE_URI} AS uri FROM ({fx.CATALOG_PATHS}) p",
    "i05_metadata_uris": f"SELECT s_suppkey, {fx.METADATA_URI} AS uri FROM ({fx.CATALOG_PATHS}) p",
    "i06_redacted_connections": f"""SELECT s_suppkey, s_suppkey % 8 < 2 AS is_connection, {fx.REDACTED} AS uri
        FROM ({fx.CATALOG_PATHS}) p""",
    "i07_table_locations": f"""SELECT p_partkey, CASE p_partkey % 6 WHEN 3 THEN base || '/other' WHEN 4 THEN '/' || tbl
            WHEN 5 THEN 'hdfs://nn' ELSE base END AS namespace, CASE p_partkey % 6 WHEN 0 THEN schema || '.db/' || tbl
            WHEN 1 THEN schema || '/' || tbl WHEN 2 THEN schema || '.db/' || tbl WHEN 3 THEN tbl || '_v2' ELSE tbl END AS name
        FROM ({fx.TABLE_LOCATIONS}) t""",
    "i08_namespaces": """SELECT 'cat_' || s_suppkey AS catalog,
        CASE WHEN s_suppkey % 2 = 0 THEN 's3://lake/' || s_suppkey ELSE 'spark' END AS namespace FROM supplier""",
    "i09_catalog_types": f"""SELECT name, 'spark' AS framework, type, metadata_uri, CASE
            WHEN type IN ('native', 'attached', 'attached_readonly') THEN metadata_uri
            WHEN type = 'lake' AND s_suppkey % 2 = 0 THEN 's3://lake/' || s_suppkey END AS warehouse_uri FROM ({CATALOGS}) c""",
    "i10_excluded_datasets": f"""SELECT name, count(*) AS n FROM ({fx.QUERY_INPUTS}) q
        WHERE NOT starts_with(name, '__meta_') AND NOT starts_with(name, 'lake.s.7') GROUP BY name""",
    "i10_excluded_by_table": f"""SELECT name, count(*) AS n FROM ({fx.QUERY_INPUTS}) q WHERE NOT EXISTS (
        SELECT 1 FROM supplier WHERE starts_with(name, 'lake.s.' || s_suppkey)) GROUP BY name""",
    "i11_dedup_inputs": f"SELECT query_id, name, min(position) AS position FROM ({fx.QUERY_INPUTS}) q GROUP BY ALL",
    "i12_drop_empty": f"""SELECT job_name, count(*) AS n FROM ({STARTS}) s
        WHERE (query_id % 3 <> 0 AND n_inputs > 0) OR query_id % 5 <> 0 GROUP BY job_name""",
    "c02_c15_c16_merge_columns": f"""SELECT DISTINCT query_id, out_col, ordinal, transformation_type, name, field
        FROM ({LAST_EDGES}) e JOIN ({KINDS}) k USING (query_id, out_col)""",
    "c_closure_of_bindings": """WITH RECURSIVE up(src, cur, breaks) AS (
            SELECT c_custkey, c_custkey, false FROM customer
            UNION ALL SELECT src, cur // 2, breaks OR c_mktsegment = 'BUILDING' FROM up JOIN customer ON cur = c_custkey
            WHERE cur > 0)
        SELECT src, breaks FROM up WHERE cur = 0""",
    "c01_c16_resolve_columns": _resolved_columns(),
    "c17_rejects": f"""SELECT query_id, 'untraceable node ' || node AS reason FROM ({LOG}) log
        JOIN (VALUES {values((NAMES.index(q), n) for q, n in UNTRACEABLE.items())}) e(t, node) USING (t)""",
    "c17_rejected_columns": f"""SELECT query_id, out_col, 'untraceable node ' || node AS reason FROM ({LOG}) log
        JOIN (VALUES {values((NAMES.index(q), c, UNTRACEABLE[q]) for q, cs in REJECTED.items() for c in cs)}) e(t, out_col, node) USING (t)""",
    "c17_conservation": f"""SELECT query_id, n AS columns, traced, sourceless, rejected, true AS conserved FROM ({LOG}) log
        JOIN (VALUES {values((NAMES.index(q), *c) for q, c in expected_fates(NAMES).items())}) e(t, n, traced, sourceless, rejected) USING (t)""",
    "c_distinct_plans": f"""SELECT name AS template, o_custkey // 20 AS tenant, count(*) AS executions, 1 AS plans FROM orders
        JOIN (VALUES {values(enumerate(NAMES))}) e(t, name) ON o_orderkey % {len(NAMES)} = t GROUP BY ALL""",
    "s01_scan_datasets": _scans(),
    "s02_file_scan_datasets": f"""SELECT DISTINCT CAST(page_id // 3 AS VARCHAR) AS query_id, {NAMESPACE} AS namespace, {NAME} AS name
        FROM ({fx.DATASET_PATHS}) p""",
    "s07_g03_view_dependencies": _views(),
    "s07_create_view": f"""SELECT query_id, view_name, out_col, transformation_type, name, field FROM ({fx.VIEW_LOG}) v
        JOIN (VALUES {values(VIEW_COLUMNS)}) e(turn, out_col, transformation_type, name, field) USING (turn) WHERE sink_op = 'CREATE_VIEW'""",
    "s07_views_over_time": f"""SELECT r.query_id, r.view_name, d.query_id AS definition, e.name
        FROM (SELECT * FROM ({fx.VIEW_LOG}) v WHERE sink_op IS NULL) r
        ASOF JOIN (SELECT view_name, event_time, max(query_id) AS query_id, arg_max(sink_op, query_id) AS sink_op, arg_max(turn, query_id) AS turn
            FROM ({fx.VIEW_LOG}) v WHERE sink_op IS NOT NULL GROUP BY ALL) d
            ON r.view_name = d.view_name AND r.event_time >= d.event_time
        JOIN (VALUES {values(VIEW_INPUTS)}) e(turn, name) ON e.turn = d.turn WHERE d.sink_op = 'CREATE_VIEW'""",
    "r14_rename_chain": f"""{SPANS} SELECT op_id, name, dataset, {ISO.format('valid_from')} AS valid_from,
        {ISO.format('valid_to')} AS valid_to, renamed_from FROM spans""",
    "r14_datasets_of_inserts": f"""{SPANS}
        SELECT i.op_id, s.dataset FROM ops i JOIN spans s ON s.name = i.name
        WHERE i.operation = 'INSERT' AND (s.valid_from, s.op_id) < (i.event_time, i.op_id)
          AND (s.valid_to IS NULL OR (i.event_time, i.op_id) < (s.valid_to, s.ended_by))
        QUALIFY row_number() OVER (PARTITION BY i.op_id ORDER BY s.valid_from DESC, s.op_id DESC) = 1""",
    "g02_g04_plan_inputs": _inputs(),
    "j01_j02_traced_statements": _statements(),
    "j01_profile": f"""SELECT query_id, root, join_count, node_count, array_to_string(ops, ',') AS operators,
        coalesce(tables, '') AS tables FROM ({PROFILE}) p""",
    "j02_j03_statement_type": f"SELECT query_id, statement FROM ({STATEMENT}) s",
    "j04_sanitized_names": f"SELECT id, {CLEAN.format('raw')} AS part FROM ({fx.DIRTY_NAMES}) d",
    "j05_query_hash": "SELECT doc_id, substr(sha256(text), 1, 8) AS hash8 FROM documents",
    "j06_job_names": JOB_NAMES,
    "j07_drop_utility": f"SELECT query_id, root FROM ({PROFILE}) p WHERE root <> 'SET'",
    "j08_hash_fallback": f"SELECT o_orderkey AS query_id, {HASHED} AS hash8 FROM orders",
    "r01_start_events": f"""SELECT 'START' AS "eventType", {ISO.format('o_orderdate')} AS "eventTime", run_id, job_name, n_inputs,
        n_outputs, input_names, output_name, query, '1.0' AS engine FROM ({STARTS}) s""",
    "r01_log_events": f"""SELECT {fx.uuid_of('o_orderkey')} AS run_id, event_type, CASE WHEN event_type = 'START' THEN n_inputs ELSE 0 END AS n_inputs,
        's3://lake' AS out_namespace, 'lake.out.' || template || '_' || (o_custkey // 20) AS out_name, n_columns, 'lake' AS catalog_type,
        'nightly' AS parent, CASE WHEN event_type = 'COMPLETE' THEN o_custkey END AS row_count,
        CASE WHEN event_type = 'FAIL' THEN 'bad ' || o_orderpriority END AS error
        FROM (SELECT *, unnest(['START', CASE WHEN o_orderstatus = 'O' THEN 'FAIL' ELSE 'COMPLETE' END]) AS event_type FROM orders) o
        JOIN (VALUES {values(_log_counts())}) e(t, template, n_inputs, n_columns) ON o_orderkey % {len(NAMES)} = t""",
    "r02_r05_terminal_events": f"""SELECT eventType AS "eventType", {ISO.format('o_orderdate + INTERVAL 1 DAY')} AS "eventTime",
        run_id, job_name, 0 AS n_inputs, output_name, CASE WHEN has_stats THEN o_custkey END AS row_count,
        CASE WHEN has_stats AND o_custkey % 3 > 0 THEN o_custkey % 3 * 10 END AS size_bytes,
        CASE WHEN eventType = 'FAIL' THEN 'bad ' || o_orderpriority END AS error, query,
        CASE WHEN eventType = 'FAIL' THEN 'SQL' END AS language, CAST(NULL AS VARCHAR) AS engine FROM ({ENDS}) e""",
    "r06_r08_run_facets": f"""SELECT run_no, event_type AS "eventType",
        CASE WHEN run_no % 4 <> 0 THEN {fx.uuid_of('(run_no // 10)')} END AS parent_run,
        CASE WHEN run_no % 4 <> 0 AND run_no % 3 <> 0 THEN 'dag_' || (run_no // 10) END AS parent_job,
        CASE WHEN event_type = 'START' THEN '4.1' END AS engine, CAST(NULL AS VARCHAR) AS adapter, message AS query
        FROM ({fx.RUN_EVENTS}) r""",
    "r09_r12_dataset_facets": f"""SELECT name, CASE WHEN is_initial THEN 'id' END AS first_field,
        CASE WHEN path <> '' THEN {fx.SOURCE_URI} END AS source_uri, type AS catalog_type,
        nullif(metadata_uri, '') AS metadata_uri, 'TABLE' AS dataset_type, CASE WHEN is_read_only THEN 'parquet' END AS sub_type
        FROM ({CATALOGS}) c""",
    "r13_r14_lifecycle": f"""SELECT op_id, CASE WHEN operation = 'RENAME' THEN name || '_new' ELSE name END AS name,
        {OP_STATE} AS state, CASE WHEN operation = 'RENAME' THEN name END AS previous_name FROM ({OP_NAMES}) n
        WHERE operation <> 'FROBNICATE'""",
    "r13_lifecycle_rejects": f"SELECT op_id, operation FROM ({OP_NAMES}) n WHERE operation = 'FROBNICATE'",
    "r15_symlinks": """SELECT CAST(o_custkey AS VARCHAR) AS customer, string_agg(name, ',' ORDER BY name) AS links FROM (
        SELECT DISTINCT o_custkey, 'o' || (o_orderkey % 5) AS name FROM orders) l GROUP BY o_custkey""",
    "r16_column_facet": f"SELECT CAST(query_id AS VARCHAR) AS query_id, out_col, n_sources, transformation_type FROM ({KINDS}) k",
    "r17_validate": f"SELECT n, reason FROM ({BROKEN}) b",
    "r18_iso_time": f"SELECT event_id, {ISO.format('ts')} AS event_time FROM events",
    "r19_run_state": f"""SELECT run_id, job_name, {ISO.format('started')} AS started, {ISO.format('ended')} AS ended, state,
        row_count FROM ({RUN_STATE}) s""",
    "r19_orphans": f"SELECT run_id, job_name FROM ({RUN_STATE}) s WHERE state = 'START'",
    "r20_latest_job_state": f"""SELECT job_name, event_type, run_id FROM (SELECT *, row_number() OVER (
        PARTITION BY job_name ORDER BY event_time DESC, run_id DESC, event_type DESC) AS k FROM ({fx.RUN_EVENTS}) r) x WHERE k = 1""",
    "r20_latest_dataset_state": f"""SELECT name, op_id, {OP_STATE} AS state FROM (SELECT *, row_number() OVER (
        PARTITION BY name ORDER BY event_time DESC, op_id DESC) AS k FROM ({OP_NAMES}) n WHERE operation <> 'FROBNICATE') x
        WHERE k = 1""",
    "r20_latest_schema": """SELECT 'd' || o_custkey AS name, 'c' || (o_orderkey % 7) AS first_field FROM (
        SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS k FROM orders) o
        WHERE k = 1""",
    "r21_required_facets": f"""SELECT 'START' AS "eventType", count(*) AS with_producer, count(*) AS with_engine,
        count(query) AS with_sql FROM ({STARTS}) s""",
    "s04_s06_traced_writes": """SELECT 'COPY' AS sink_op, 'COMPLETE' AS event_type, count(*) AS row_count, true AS has_bytes FROM orders
        UNION ALL SELECT 'CREATE_TABLE', 'COMPLETE', count(*), true FROM customer
        UNION ALL SELECT 'INSERT', 'COMPLETE', count(*), true FROM supplier""",
    "s04_r14_traced_statements": f"""SELECT 'COMPLETE' AS "eventType", name, state, previous, fields FROM (VALUES
        ('old', 'CREATE', NULL, 'o_orderkey,o_orderpriority'), ('new', 'RENAME', 'old', NULL), ('view', 'CREATE', NULL, 'o_orderkey'),
        ('view', 'CREATE', NULL, 'priority'), ('view', 'DROP', NULL, NULL), ('new', 'DROP', NULL, NULL)) e(name, state, previous, fields)""",
    "s04_r01_traced_events": """SELECT 'START' AS "eventType", 'orders' AS input, CAST(NULL AS BIGINT) AS row_count,
            CAST(NULL AS BOOLEAN) AS has_bytes, 'INDIRECT' AS total_type, 'customer bigint,total double' AS fields, 'OVERWRITE' AS state
        UNION ALL SELECT 'COMPLETE', NULL, count(DISTINCT o_custkey), true, 'INDIRECT', 'customer bigint,total double', 'OVERWRITE'
        FROM orders""",
    "s09_s10_event_round_trip": f"""SELECT eventType AS "eventType", job_name, count(*) AS n,
        CAST(sum(CASE WHEN has_stats THEN o_custkey END) AS BIGINT) AS row_count FROM ({ENDS}) e GROUP BY ALL""",
    "g01_dataset_edges": f"""SELECT DISTINCT i.name AS in_name, o.name AS out_name FROM ({fx.QUERY_INPUTS}) i
        JOIN ({fx.QUERY_OUTPUTS}) o USING (query_id)""",
    "g01_event_edges": f"""SELECT DISTINCT i.name AS in_name, o.name AS out_name FROM ({fx.QUERY_INPUTS}) i
        JOIN ({fx.QUERY_OUTPUTS}) o USING (query_id)""",
    "g01_pipeline_edges": f"""SELECT * FROM (VALUES {values(
        (i if i in ("lineitem", "orders", "supplier", "nation", "region", "part") else f"spark_catalog.default.{i}", f"spark_catalog.default.{o}")
        for o, inputs in PIPELINE.items() for i in inputs)}) e(in_name, out_name)""",
    "g02_collapse_views": """WITH scans AS (SELECT l_orderkey AS query_id, l_suppkey,
            CAST(l_linenumber AS BIGINT) * 1000000 + l_partkey AS position, l_returnflag = 'R' AS viewed FROM lineitem),
        hidden AS (SELECT DISTINCT query_id, position FROM scans WHERE viewed)
        SELECT DISTINCT query_id, CASE WHEN l_suppkey % 10 = 0 THEN '__meta_' ELSE 'lake.s.' END || l_suppkey AS name,
            'TABLE' AS dataset_type FROM scans ANTI JOIN hidden USING (query_id, position)
        UNION ALL SELECT DISTINCT query_id, 'view_' || (l_suppkey % 10), 'VIEW' FROM scans WHERE viewed""",
    "t01_stream_intake": f"SELECT coalesce(reason, 'valid') AS reason, count(*) AS n FROM ({BROKEN}) b GROUP BY 1",
    "t02_stream_dedup": f"SELECT run_id, event_type, row_count FROM ({fx.RUN_EVENTS}) r",
    "t02_late_deliveries": f"""SELECT event_type, count(*) AS first, count(DISTINCT run_id) AS runs, CAST(sum(row_count) AS BIGINT) AS row_count,
        count(*) FILTER (WHERE run_no % 3 = 0) AS repeats FROM ({fx.RUN_EVENTS}) r GROUP BY event_type""",
    "t03_compacted_run_state": f"""SELECT run_id, job_name, {ISO.format('started')} AS started, {ISO.format('ended')} AS ended, state
        FROM ({RUN_STATE}) s""",
    "t03_stream_run_state": f"""SELECT run_id, job_name, {ISO.format('started')} AS started, {ISO.format('ended')} AS ended, state
        FROM ({RUN_STATE}) s""",
    "t04_intake_counters": f"SELECT count(*) AS seen, count(reason) AS rejected FROM ({BROKEN}) b",
}


def all_sql() -> dict[str, str]:
    return {**SQL, **shape_sql(shape_queries())}
