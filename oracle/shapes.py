"""Oracle SQL of the traced query shapes."""

from __future__ import annotations

from provtrail.plans.traced import TRACED

WORDS = "SELECT doc_id, unnest(string_split(text, ' ')) AS word FROM documents"
UNPIVOTED = """SELECT l_orderkey, l_linenumber, 'quantity' AS measure, l_quantity AS amount FROM lineitem WHERE l_quantity IS NOT NULL
    UNION ALL SELECT l_orderkey, l_linenumber, 'discount', l_discount FROM lineitem WHERE l_discount IS NOT NULL"""

DIALECT = {
    "q16_array_agg": """SELECT o_custkey, array_to_string(list_sort(list(DISTINCT o_orderpriority)), ',') AS priorities
        FROM orders GROUP BY o_custkey""",
    "q17_row_number": """SELECT o_orderkey,
        ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn,
        CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) OVER (
            PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS DOUBLE) AS running FROM orders""",
    "q18_rank": """SELECT c_mktsegment, CAST(total AS DOUBLE) AS total, RANK() OVER (ORDER BY total DESC) AS rnk FROM (
        SELECT c_mktsegment, SUM(CAST(c_acctbal AS DECIMAL(18,2))) AS total FROM customer GROUP BY c_mktsegment) t""",
    "q24_pivot": """SELECT l_suppkey, SUM(l_quantity) FILTER (WHERE l_returnflag = 'A') AS flag_a,
        SUM(l_quantity) FILTER (WHERE l_returnflag = 'N') AS flag_n,
        SUM(l_quantity) FILTER (WHERE l_returnflag = 'R') AS flag_r FROM lineitem GROUP BY l_suppkey""",
    "q24_unpivot": """SELECT l_orderkey, l_linenumber, 'quantity' AS measure, l_quantity AS amount FROM lineitem
        UNION ALL SELECT l_orderkey, l_linenumber, 'discount', l_discount FROM lineitem""",
    "q25_unnest": WORDS,
    "q25_case_unnest": f"SELECT doc_id, CASE WHEN word = '' THEN 'blank' ELSE word END AS label FROM ({WORDS}) w",
    "q25_window_unnest": f"SELECT doc_id, word, COUNT(word) OVER (PARTITION BY doc_id, word) AS n FROM ({WORDS}) w",
    "q27_asof": """SELECT l_suppkey AS key, l_orderkey, l_linenumber, l_partkey, o_orderkey FROM lineitem
        ASOF JOIN (SELECT o_custkey, o_orderdate, MAX(o_orderkey) AS o_orderkey FROM orders GROUP BY 1, 2) o
        ON l_suppkey = o_custkey AND l_shipdate >= o_orderdate""",
    "q28_recursive": TRACED["q28_recursive"].replace("c.c_custkey DIV 2", "c.c_custkey // 2"),
    "q29_series_join": "SELECT s_name, seq FROM supplier, (SELECT unnest(range(1, 3)) AS seq) g",
    "q34_struct": "SELECT s.id, s.name FROM (SELECT {'id': c_custkey, 'name': c_name} AS s FROM customer) t",
    "q35_view": "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'O'",
    "q35_view_expr": "SELECT o_orderkey, o_totalprice * CAST(1.1 AS DOUBLE) AS gross FROM orders",
    "q37_csv": "SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority FROM orders",
    "q37_parquet": "SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority FROM orders",
    "q38_multi_layer": """WITH waits AS (SELECT r_name AS area, n_name AS place, p_brand,
            datediff('day', o_orderdate, l_shipdate) AS days
            FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
            JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
            JOIN region ON n_regionkey = r_regionkey),
        whole AS (SELECT area, count(*) AS n_lines, sum(days) AS days, avg(days) AS mean FROM waits GROUP BY area),
        slow AS (SELECT area, place, p_brand, avg(days) AS mean FROM waits
            GROUP BY GROUPING SETS ((area, place), (area, p_brand)))
        SELECT area, n_lines, CAST(days AS BIGINT) AS days,
            count(*) FILTER (WHERE place IS NOT NULL AND slow.mean > whole.mean) AS slow_places,
            count(*) FILTER (WHERE p_brand IS NOT NULL AND slow.mean > whole.mean) AS slow_brands
        FROM whole JOIN slow USING (area) GROUP BY area, n_lines, days""",
    "q41_lateral_explode": WORDS,
    "q41_lateral_select": WORDS,
    "q41_lateral_stack": UNPIVOTED,
    "q42_unpivot": UNPIVOTED,
    "q42_unpivot_frame": """SELECT l_orderkey, l_linenumber, 'l_quantity' AS measure, l_quantity AS amount FROM lineitem
        UNION ALL SELECT l_orderkey, l_linenumber, 'l_discount', l_discount FROM lineitem""",
    "q41_lateral_outer": """SELECT s_suppkey, s_name || n_name AS home, s_name AS owner FROM supplier
        JOIN nation ON n_nationkey = s_nationkey""",
    "q41_lateral_join": """SELECT c_custkey, n_name, lower(r_name) AS area, upper(c_name) AS owner FROM customer
        JOIN nation ON n_nationkey = c_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "q41_lateral_nested": """SELECT c_custkey, n_name, n_name || r_name AS label FROM customer
        JOIN nation ON n_nationkey = c_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "q42_cube": """SELECT l_returnflag, l_linestatus, CAST(GROUPING(l_linestatus) AS TINYINT) AS all_status, COUNT(l_orderkey) AS n
        FROM lineitem GROUP BY CUBE (l_returnflag, l_linestatus)""",
    "q44_pipe": """SELECT lower(o_orderpriority) AS priority, COUNT(*) AS n, MAX(o_totalprice) AS high FROM orders
        WHERE o_orderstatus = 'F' GROUP BY 1""",
    "q40_nested": """SELECT doc_id, lang, n_chars AS chars, array_to_string(string_split(source, '_'), '|') AS parts
        FROM documents""",
}


def shape_sql(names) -> dict[str, str]:
    """SQL per shape: the traced text where it is plain ANSI, else the dialect's own."""
    return {n: DIALECT.get(n) or TRACED[n] for n in names}
