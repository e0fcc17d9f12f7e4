"""Traced queries: the SQL shapes whose plans the resolver is run on.

Each is plain Spark SQL over the tables of ``sources.tables``. They are also the data
queries, except where ``shapes`` has a form that stands up to hot keys.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, functions as F

from provtrail.plans.capture import capture, plan_log
from provtrail.sources.tables import TABLES, register

PRICE = "CAST(o_totalprice AS DECIMAL(18,2))"

TRACED: dict[str, str] = {
    "q01_select": "SELECT o_orderkey, o_custkey FROM orders",
    "q02_arithmetic": """SELECT l_orderkey, l_linenumber, l_extendedprice * l_discount AS rebate,
        l_extendedprice * (1 - l_discount) * (1 + l_tax) AS charge FROM lineitem""",
    "q03_alias_cast": "SELECT o_orderkey AS order_id, CAST(o_custkey AS STRING) AS cust FROM orders",
    "q03_star": "SELECT * FROM customer",
    "q04_filter": "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 100000 AND o_orderstatus = 'F'",
    "q04_subquery": """SELECT id, total FROM (SELECT o_orderkey AS id, o_totalprice AS total FROM orders
        WHERE o_totalprice > 1000) t WHERE total < 400000""",
    "q04_subquery3": """SELECT id, name FROM (SELECT id, name FROM (SELECT id, name FROM (
        SELECT c_custkey AS id, c_name AS name FROM customer) a) b) c""",
    "q05_join": """SELECT o.o_orderkey, c.c_name, c.c_mktsegment FROM orders o
        JOIN customer c ON o.o_custkey = c.c_custkey""",
    "q05_same_names": """SELECT a.name AS cust_name, b.name AS nation_name
        FROM (SELECT c_nationkey AS id, c_name AS name FROM customer) a
        JOIN (SELECT n_nationkey AS id, n_name AS name FROM nation) b ON a.id = b.id""",
    "q06_three_way": """SELECT o_orderkey, c_name, n_name FROM orders
        JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey""",
    "q06_five_way": """SELECT l_orderkey, l_linenumber, o_orderpriority, c_name, n_name, r_name FROM lineitem
        JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
        JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "q07_self_join": """SELECT a.o_orderkey AS first_key, b.o_orderkey AS next_key, b.o_totalprice AS next_price
        FROM orders a JOIN orders b ON a.o_orderkey + 1 = b.o_orderkey""",
    "q08_left_join": """SELECT c_custkey, c_name, o_orderkey FROM customer
        LEFT JOIN orders ON c_custkey = o_custkey""",
    "q08_right_join": """SELECT o_orderkey, c_custkey, c_name FROM orders
        RIGHT JOIN customer ON o_custkey = c_custkey""",
    "q08_full_join": """SELECT c_custkey, c_name, s_suppkey, s_name FROM customer
        FULL OUTER JOIN supplier ON c_custkey = s_suppkey + 50""",
    "q09_cross_join": "SELECT c_custkey, r_name FROM customer CROSS JOIN region",
    "q10_exists": """SELECT c_custkey, c_name FROM customer
        WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 400000)""",
    "q10_in": """SELECT c_custkey, c_name FROM customer
        WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')""",
    "q10_anti": """SELECT c_custkey, c_name FROM customer
        WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)""",
    "q11_scalar_subquery": """SELECT c_custkey, c_name,
        (SELECT MAX(o_totalprice) FROM orders WHERE o_custkey = c_custkey) AS top_order FROM customer""",
    "q12_group_by": f"""SELECT o_orderstatus, CAST(SUM({PRICE}) AS DOUBLE) AS total, COUNT(o_orderkey) AS n,
        MIN(o_totalprice) AS low, MAX(o_totalprice) AS high FROM orders GROUP BY o_orderstatus""",
    "q12_ten_aggregates": """SELECT l_suppkey, SUM(l_quantity) AS a1, AVG(l_quantity) AS a2, MIN(l_quantity) AS a3,
        MAX(l_quantity) AS a4, COUNT(l_quantity) AS a5, MIN(l_extendedprice) AS a6, MAX(l_extendedprice) AS a7,
        MIN(l_discount) AS a8, MAX(l_tax) AS a9, AVG(l_linenumber) AS a10 FROM lineitem GROUP BY l_suppkey""",
    "q13_count_star": "SELECT o_custkey, COUNT(*) AS n FROM orders GROUP BY o_custkey",
    "q13_count_distinct": """SELECT o_orderpriority, COUNT(DISTINCT o_custkey) AS customers
        FROM orders GROUP BY o_orderpriority""",
    "q14_having": f"""SELECT o_custkey, CAST(SUM({PRICE}) AS DOUBLE) AS total FROM orders
        GROUP BY o_custkey HAVING COUNT(o_orderkey) > 10""",
    "q15_conditional_agg": f"""SELECT o_custkey,
        CAST(SUM(CASE WHEN o_orderstatus = 'F' THEN {PRICE} ELSE 0 END) AS DOUBLE) AS closed,
        SUM(CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END) AS open_orders FROM orders GROUP BY o_custkey""",
    "q16_array_agg": """SELECT o_custkey, array_join(array_sort(collect_set(o_orderpriority)), ',') AS priorities
        FROM orders GROUP BY o_custkey""",
    "q17_row_number": f"""SELECT o_orderkey,
        ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn,
        SUM({PRICE}) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS running FROM orders""",
    "q18_rank_lag_frame": """SELECT event_id,
        LAG(value) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev_value,
        AVG(event_id) OVER (PARTITION BY user_id ORDER BY ts, event_id
            ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS moving FROM events""",
    "q18_rank": f"""SELECT c_mktsegment, total, RANK() OVER (ORDER BY total DESC) AS rnk FROM (
        SELECT c_mktsegment, SUM(CAST(c_acctbal AS DECIMAL(18,2))) AS total FROM customer GROUP BY c_mktsegment) t""",
    "q19_qualify": """SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT o_custkey, o_orderkey, o_totalprice,
        ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rn FROM orders) t
        WHERE rn = 1""",
    "q20_share": """SELECT l_orderkey, l_linenumber, l_quantity,
        l_quantity / SUM(l_quantity) OVER (PARTITION BY l_suppkey) AS share FROM lineitem""",
    "q21_union2": "SELECT o_custkey AS id FROM orders UNION ALL SELECT c_custkey AS id FROM customer",
    "q21_union3": """SELECT c_custkey AS id, c_name AS label FROM customer
        UNION ALL SELECT s_suppkey, s_name FROM supplier UNION ALL SELECT p_partkey, p_name FROM part""",
    "q21_union4": """SELECT c_custkey AS id FROM customer UNION ALL SELECT s_suppkey FROM supplier
        UNION ALL SELECT p_partkey FROM part UNION ALL SELECT o_orderkey FROM orders""",
    "q22_intersect": "SELECT o_custkey AS id FROM orders INTERSECT SELECT c_custkey FROM customer",
    "q22_except": "SELECT c_custkey AS id FROM customer EXCEPT SELECT o_custkey FROM orders",
    "q22_mixed": """(SELECT c_custkey AS id FROM customer UNION ALL SELECT p_partkey FROM part)
        INTERSECT SELECT o_custkey FROM orders""",
    "q23_distinct": "SELECT DISTINCT l_suppkey, l_returnflag FROM lineitem",
    "q23_top_n": "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25",
    "q24_pivot": """SELECT * FROM (SELECT l_suppkey, l_returnflag, l_quantity FROM lineitem)
        PIVOT (SUM(l_quantity) FOR l_returnflag IN ('A' AS flag_a, 'N' AS flag_n, 'R' AS flag_r))""",
    "q24_unpivot": """SELECT l_orderkey, l_linenumber, measure, amount FROM lineitem
        LATERAL VIEW stack(2, 'quantity', l_quantity, 'discount', l_discount) AS measure, amount""",
    "q25_unnest": "SELECT doc_id, word FROM documents LATERAL VIEW explode(split(text, ' ')) w AS word",
    "q25_case_unnest": """SELECT doc_id, CASE WHEN word = '' THEN 'blank' ELSE word END AS label
        FROM documents LATERAL VIEW explode(split(text, ' ')) w AS word""",
    "q25_window_unnest": """SELECT doc_id, word, COUNT(word) OVER (PARTITION BY doc_id, word) AS n
        FROM documents LATERAL VIEW explode(split(text, ' ')) w AS word""",
    "q26_cte": """WITH t AS (SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'O')
        SELECT o_orderkey, o_totalprice FROM t""",
    "q26_cte_chain": """WITH s1 AS (SELECT c_custkey, c_name FROM customer), s2 AS (SELECT c_custkey, c_name FROM s1),
        s3 AS (SELECT c_custkey, c_name FROM s2) SELECT c_custkey, c_name FROM s3""",
    "q26_cte_join": """WITH a AS (SELECT c_custkey, c_name FROM customer), b AS (SELECT o_custkey, o_orderkey FROM orders)
        SELECT a.c_name, b.o_orderkey FROM a JOIN b ON a.c_custkey = b.o_custkey""",
    "q26_cte_twice": """WITH t AS (SELECT o_orderkey AS k, o_custkey AS c FROM orders)
        SELECT a.k AS k1, b.c AS c2 FROM t a JOIN t b ON a.k = b.k""",
    "q27_asof": """SELECT e.event_id, max_by(o.o_orderkey, o.o_orderdate) AS o_orderkey FROM events e
        JOIN orders o ON e.user_id = o.o_custkey AND e.ts >= o.o_orderdate GROUP BY e.event_id""",
    "q28_recursive": """WITH RECURSIVE chain(id, name, depth) AS (
        SELECT c_custkey, c_name, 1 FROM customer WHERE c_custkey = 1
        UNION ALL SELECT c.c_custkey, c.c_name, ch.depth + 1 FROM customer c
        JOIN chain ch ON c.c_custkey DIV 2 = ch.id) SELECT id, name, depth FROM chain""",
    "q28_recursive_constant": """WITH RECURSIVE cnt(x) AS (SELECT 1 UNION ALL SELECT x + 1 FROM cnt WHERE x < 5)
        SELECT x FROM cnt""",
    "q29_series": "SELECT id AS seq FROM range(10)",
    "q29_series_join": "SELECT s_name, seq FROM supplier LATERAL VIEW explode(sequence(1, 2)) t AS seq",
    "q30_strings": """SELECT c_custkey, UPPER(c_name) AS up, LOWER(c_name) AS low, SUBSTRING(c_name, 1, 4) AS head,
        TRIM(LOWER(REPLACE(c_name, 'C', 'k'))) AS clean, CONCAT(c_name, CAST(c_custkey AS STRING)) AS tagged
        FROM customer""",
    "q31_dates": """SELECT o_orderkey, CAST(DATE_TRUNC('month', o_orderdate) AS DATE) AS month,
        EXTRACT(YEAR FROM o_orderdate) AS year FROM orders""",
    "q32_case": """SELECT o_orderkey, CASE WHEN o_totalprice > 200000 THEN o_orderpriority ELSE 'low' END AS label,
        CASE WHEN o_totalprice > 200000 THEN UPPER(o_orderpriority) ELSE 'low' END AS shout FROM orders""",
    "q32_coalesce": """SELECT c_custkey, COALESCE(s_name, c_name) AS label, NULLIF(c_nationkey, 0) AS nation
        FROM customer LEFT JOIN supplier ON c_custkey = s_suppkey""",
    "q33_constants": """SELECT 1 AS const_col, o_orderkey, o_totalprice * 2 AS doubled, o_totalprice + 100 AS shifted
        FROM orders""",
    "q34_struct": "SELECT named_struct('id', c_custkey, 'name', c_name) AS s FROM customer",
    "q35_view": "SELECT o_orderkey, o_totalprice FROM open_orders",
    "q35_view_expr": "SELECT o_orderkey, gross FROM priced_orders",
    "q36_cte_join_agg_window": f"""WITH base AS (SELECT c_mktsegment, o_totalprice FROM orders
            JOIN customer ON o_custkey = c_custkey),
        agg AS (SELECT c_mktsegment, SUM({PRICE}) AS total FROM base GROUP BY c_mktsegment)
        SELECT c_mktsegment, CAST(total AS DOUBLE) AS total, RANK() OVER (ORDER BY total DESC) AS rnk FROM agg""",
    "q39_null_safe": """SELECT c_custkey, COALESCE(s_name, 'none') AS supplier FROM customer
        LEFT JOIN supplier ON c_custkey = s_suppkey WHERE c_name IS NOT NULL""",
    "q40_nested": """SELECT doc_id, named_struct('lang', lang, 'chars', n_chars) AS meta,
        split(source, '_') AS parts FROM documents""",
    "q41_lateral": """SELECT o_orderkey, t.top FROM orders,
        LATERAL (SELECT MAX(l_quantity) AS top FROM lineitem WHERE l_orderkey = o_orderkey) t""",
    "q41_lateral_explode": "SELECT doc_id, word FROM documents, LATERAL explode(split(text, ' ')) AS t(word)",
    "q41_lateral_select": "SELECT doc_id, word FROM documents, LATERAL (SELECT explode(split(text, ' ')) AS word)",
    "q41_lateral_stack": """SELECT l_orderkey, l_linenumber, measure, amount FROM lineitem,
        LATERAL stack(2, 'quantity', l_quantity, 'discount', l_discount) AS t(measure, amount)""",
    "q41_lateral_outer": """SELECT s_suppkey, t.home, t.owner FROM supplier,
        LATERAL (SELECT concat(s_name, n_name) AS home, s_name AS owner FROM nation WHERE n_nationkey = s_nationkey) t""",
    "q41_lateral_join": """SELECT c_custkey, t.n_name, t.area, t.owner FROM customer,
        LATERAL (SELECT n_name, lower(r_name) AS area, upper(c_name) AS owner FROM nation
            JOIN region ON n_regionkey = r_regionkey WHERE n_nationkey = c_nationkey) t""",
    "q41_lateral_nested": """SELECT c_custkey, t.n_name, t.label FROM customer,
        LATERAL (SELECT n_name, u.label FROM nation,
            LATERAL (SELECT concat(n_name, r_name) AS label FROM region WHERE r_regionkey = n_regionkey) u
            WHERE n_nationkey = c_nationkey) t""",
    "q42_rollup": """SELECT l_returnflag, l_linestatus, SUM(l_quantity) AS quantity FROM lineitem
        GROUP BY ROLLUP (l_returnflag, l_linestatus)""",
    "q42_cube": """SELECT l_returnflag, l_linestatus, GROUPING(l_linestatus) AS all_status, COUNT(l_orderkey) AS n
        FROM lineitem GROUP BY CUBE (l_returnflag, l_linestatus)""",
    "q42_grouping_sets": """SELECT o_orderstatus, o_orderpriority, MAX(o_totalprice) AS high FROM orders
        GROUP BY GROUPING SETS ((o_orderstatus), (o_orderpriority), ())""",
    "q42_rollup_joined": """SELECT c_custkey, c_mktsegment, top FROM customer JOIN (
        SELECT o_custkey, o_orderstatus, MAX(o_totalprice) AS top FROM orders GROUP BY ROLLUP (o_custkey, o_orderstatus)) t
        ON c_custkey = o_custkey WHERE o_orderstatus IS NULL""",
    "q42_unpivot": """SELECT l_orderkey, l_linenumber, measure, amount FROM lineitem
        UNPIVOT (amount FOR measure IN (l_quantity AS quantity, l_discount AS discount))""",
    "q44_pipe": """FROM orders |> WHERE o_orderstatus = 'F' |> EXTEND lower(o_orderpriority) AS priority
        |> AGGREGATE COUNT(*) AS n, MAX(o_totalprice) AS high GROUP BY priority""",
}


def _asof_frame(spark: SparkSession) -> DataFrame:
    orders = spark.table("orders").select("o_orderkey", "o_orderdate")
    return spark.table("events").select("event_id", "ts")._joinAsOf(
        orders, leftAsOfColumn="ts", rightAsOfColumn="o_orderdate", how="left").select("event_id", "o_orderkey")


def _unpivoted_frame(spark: SparkSession) -> DataFrame:
    return spark.table("lineitem").unpivot(
        ["l_orderkey", "l_linenumber"], ["l_quantity", "l_discount"], "measure", "amount")


def _python_beside(spark: SparkSession) -> DataFrame:
    """A side that Python makes, whose columns no plan text can tell, beside one that is traced."""
    scored = spark.table("customer").mapInArrow(lambda batches: batches, "c_custkey long, c_name string, c_nationkey long, c_acctbal double, c_mktsegment string")
    return spark.table("orders").join(scored, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey", "c_name", F.concat("o_orderpriority", "c_mktsegment").alias("label"), F.lit(1).alias("one"))


# Traced through the DataFrame API: SQL has no words for them.
TRACED_FRAMES = {
    "q42_unpivot_frame": _unpivoted_frame, "q43_asof_frame": _asof_frame, "q45_python_beside": _python_beside}


def traced_names() -> list[str]:
    return sorted([*TRACED, *TRACED_FRAMES])

VIEWS = {
    "open_orders": "SELECT o_orderkey, o_totalprice, o_orderdate FROM orders WHERE o_orderstatus = 'O'",
    "priced_orders": "SELECT o_orderkey, o_totalprice * 1.1D AS gross FROM orders",
}


def traced_frame(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark, sf_dir, "events orders lineitem customer")
    return TRACED_FRAMES[name](spark)


def prepare(spark: SparkSession, sf_dir: str, text: str | None = None) -> None:
    """Register the tables and views that ``text``, or any traced query, reads."""
    words = None if text is None else set(re.findall(r"\w+", text))
    views = {n: v for n, v in VIEWS.items() if words is None or n in words}
    if words is not None:
        words.update(w for v in views.values() for w in re.findall(r"\w+", v))
    register(spark, sf_dir, [t for t in TABLES if words is None or t in words])
    for name, view in views.items():
        spark.sql(view).createOrReplaceTempView(name)


def traced(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark, sf_dir, TRACED[name])
    return spark.sql(TRACED[name])


_CAPTURED: dict[tuple[str, str, int], list[tuple]] = {}


def traced_plan_log(spark: SparkSession, sf_dir: str, fresh: int = 0) -> DataFrame:
    """Captured plans of all traced queries: one plan-log row each, captured once per application
    and number ``fresh``."""
    key = (spark.sparkContext.applicationId, sf_dir, fresh)
    if key not in _CAPTURED:
        prepare(spark, sf_dir, " ".join([*TRACED.values(), *VIEWS, "events", "orders", "lineitem", "customer"]))
        _CAPTURED[key] = [
            capture(spark.sql(text), name, text, "CREATE_TABLE", None, f"{name}_out") for name, text in TRACED.items()]
        _CAPTURED[key] += [
            capture(frame(spark), name, None, "CREATE_TABLE", None, f"{name}_out") for name, frame in TRACED_FRAMES.items()]
    return plan_log(spark, _CAPTURED[key])
