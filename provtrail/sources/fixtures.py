"""Lineage inputs derived from the relational tables, as large as those tables are.

Each function has a twin of the same name in ``oracle.fixtures`` for DuckDB.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from provtrail.plans.capture import capture, plan_log as plan_log_of
from provtrail.plans.traced import traced_names, traced_plan_log
from provtrail.session import materialize
from provtrail.sources.tables import parts_of, register, table


def uuid_of(n: Column) -> Column:
    """A UUID-shaped id from a number."""
    h = F.md5(n.cast("string"))
    return F.concat_ws("-", *[F.substring(h, i, w) for i, w in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])


def run_events(spark: SparkSession, sf_dir: str, orphans: bool = False) -> DataFrame:
    """START / COMPLETE / FAIL rows from ``events``; with ``orphans`` odd clicks are missing, so some
    runs never end."""
    e = table(spark, sf_dir, "events")
    run = F.expr("event_id div 2")
    kind = F.when(F.col("event_id") % 2 == 0, "START").when(F.col("event_type") == "error", "FAIL").otherwise("COMPLETE")
    return (e.filter("not (event_id % 2 = 1 and event_type = 'click')") if orphans else e).select(
        uuid_of(run).alias("run_id"), run.alias("run_no"), kind.alias("event_type"),
        F.concat(F.lit("job_"), run % 50).alias("job_name"), F.col("ts").alias("event_time"),
        (F.col("event_id") % 1000).alias("row_count"), (F.col("event_id") % 3 * 100).alias("size_bytes"),
        F.col("props").alias("message"))


def dataset_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw dataset paths from ``pages``: object stores, local files, unknown schemes, empty."""
    rest = F.regexp_replace("url", "^https?://", "")
    n = F.col("page_id") % 9
    path = F.when(F.col("page_id") % 25 == 0, "")
    for i, scheme in enumerate(("s3", "s3a", "gs", "abfss", "wasbs", "hdfs")):
        path = path.when(n == i, F.concat(F.lit(f"{scheme}://"), rest))
    path = path.when(n == 6, F.concat(F.lit("file:///"), rest)).when(n == 7, F.concat(F.lit("/"), rest)).otherwise(F.col("url"))
    return table(spark, sf_dir, "pages").select("page_id", path.alias("path"))


def catalog_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalog paths from ``supplier``: connection strings, URIs, ``x:`` forms, files, memory."""
    n, name = F.col("s_suppkey") % 8, F.col("s_name")
    path = (
        F.when(n == 0, F.concat(F.lit("postgres:dbname=db"), F.col("s_suppkey"), F.lit(" host=h"), F.col("s_nationkey"),
                                F.lit(" port=5432 user=u password=secret")))
        .when(n == 1, F.concat(F.lit("host=h"), F.col("s_nationkey"), F.lit(" port=1 password=secret")))
        .when(n == 2, F.concat(F.lit("s3://bucket/"), name))
        .when(n == 3, F.concat(F.lit("mysql:"), name))
        .when(n == 4, F.concat(F.lit("/data/"), name, F.lit(".db")))
        .when(n == 5, F.lit(":memory:"))
        .when(n == 6, F.concat(F.lit("/tmp/host=a/port=b/"), name))
        .otherwise("")
    )
    return table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey", path.alias("path"))


def catalog_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalog records from ``supplier``."""
    n = F.col("s_suppkey")
    kind = F.when(n % 7 == 0, "system").when(n % 7 == 1, "temporary").when(n % 7 == 2, "lake").when(
        n % 7 == 3, "postgres").when(n % 7 == 4, F.lit(None)).otherwise("native")
    return catalog_paths(spark, sf_dir).select(
        F.concat(F.lit("cat_"), n).alias("name"), kind.alias("kind"), F.col("path").alias("db_path"),
        (n % 8 == 5).alias("in_memory"), (n % 2 == 0).alias("is_initial"), (n % 3 == 0).alias("is_read_only"),
        F.when(n % 2 == 0, F.concat(F.lit("s3://lake/"), n, F.lit("/"))).otherwise("").alias("data_path"))


def table_locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Warehouse locations from ``part``: with a database folder, a slash or a placeholder at the end."""
    n = F.col("p_partkey")
    tbl = F.concat(F.lit("t"), n)
    schema = F.lower("p_type")
    base = F.concat(F.lit("s3a://wh/"), F.regexp_replace("p_brand", "#", "_"))
    location = (
        F.when(n % 6 == 0, F.concat(base, F.lit("/"), schema, F.lit(".db/"), tbl))
        .when(n % 6 == 1, F.concat(base, F.lit("/"), schema, F.lit("/"), tbl, F.lit("/")))
        .when(n % 6 == 2, F.concat(base, F.lit("/"), schema, F.lit(".db/"), tbl, F.lit("-__PLACEHOLDER__")))
        .when(n % 6 == 3, F.concat(base, F.lit("/other/"), tbl, F.lit("_v2")))
        .when(n % 6 == 4, F.concat(F.lit("/"), tbl))
        .otherwise(F.concat(F.lit("hdfs://nn/"), tbl))
    )
    return table(spark, sf_dir, "part").select("p_partkey", location.alias("location"), tbl.alias("table"), schema.alias("schema"))


def column_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges of output columns from ``lineitem``: one query per order, one output per line number.

    The return flag stands for the expression: A a function, N a column, R a cast.
    """
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("query_id"), F.concat(F.lit("c"), F.col("l_linenumber") % 4).alias("out_col"),
        F.col("l_linenumber").alias("ordinal"), F.lit("spark").alias("namespace"),
        F.concat(F.lit("memory.main.s"), F.col("l_suppkey")).alias("name"),
        F.concat(F.lit("p"), F.col("l_partkey") % 20).alias("field"), (F.col("l_returnflag") == "A").alias("breaks"))


def binding_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A binding forest from ``customer``: every key points to half of itself, 0 is the end."""
    c = table(spark, sf_dir, "customer")
    down = c.filter("c_custkey > 0").select(
        F.col("c_custkey").alias("src"), F.expr("c_custkey div 2").alias("dst"),
        (F.col("c_mktsegment") == "BUILDING").alias("breaks"), F.lit(False).alias("terminal"))
    end = c.filter("c_custkey = 0").select(
        F.col("c_custkey").alias("src"), F.col("c_custkey").alias("dst"), F.lit(False).alias("breaks"),
        F.lit(True).alias("terminal"))
    return down.unionByName(end)


# Operator of a plan node by line number, root of a plan by order priority.
NODE_OPERATORS = ("GET", "COMPARISON_JOIN", "AGGREGATE", "WINDOW", "DISTINCT", "UNION", "MATERIALIZED_CTE")
ROOT_OPERATORS = {"1-URGENT": "INSERT", "2-HIGH": "CREATE_TABLE", "3-MEDIUM": "PROJECTION",
                  "4-NOT SPECIFIED": "PROJECTION", "5-LOW": "SET"}


def plan_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plan nodes from ``orders`` (roots) and ``lineitem`` (nodes below)."""
    root = F.when(F.lit(False), "")
    for k, v in ROOT_OPERATORS.items():
        root = root.when(F.col("o_orderpriority") == k, v)
    roots = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("query_id"), F.lit(0).cast("bigint").alias("node_id"),
        F.lit(None).cast("bigint").alias("parent_id"), root.alias("operator"), F.lit(None).cast("string").alias("table_name"))
    op = F.lit(NODE_OPERATORS[-1])
    for i, name in enumerate(NODE_OPERATORS[:-1]):
        op = F.when(F.col("k") == i, name).otherwise(op)
    # Rarer operators get fewer line numbers, so that every statement type occurs.
    k = F.when(F.col("l_partkey") % 11 < 5, 0).when(F.col("l_partkey") % 11 < 7, 1).otherwise(
        F.when(F.col("l_quantity") > 45, F.col("l_linenumber") - 1).otherwise(0))
    below = table(spark, sf_dir, "lineitem").withColumn("k", k).select(
        F.col("l_orderkey").alias("query_id"),
        (F.col("l_linenumber") * 1000000 + F.col("l_partkey")).cast("bigint").alias("node_id"),
        F.when(F.col("l_linenumber") == 1, 0).otherwise(1).cast("bigint").alias("parent_id"), op.alias("operator"),
        F.when(F.col("k") == 0, F.concat(F.lit("tbl-"), F.col("l_partkey") % 100, F.lit("."), F.col("l_suppkey"))).alias("table_name"))
    return roots.unionByName(below)


def dirty_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names with separators and other characters, from ``part``."""
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("id"),
        F.concat(F.lit("-"), "p_name", F.lit(".. "), "p_brand", F.lit(";é,"), "p_type", F.lit("_")).alias("raw"))


def datasets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operations on qualified datasets from ``orders``, joined with ``customer`` for the schema part."""
    n = F.col("o_orderkey")
    op = F.when(n % 9 == 0, "CREATE_TABLE").when(n % 9 == 1, "INSERT").when(n % 9 == 2, "UPDATE").when(
        n % 9 == 3, "DELETE").when(n % 9 == 4, "COPY").when(n % 9 == 5, "CREATE_VIEW").when(
        n % 9 == 6, "ALTER").when(n % 9 == 7, "RENAME").otherwise(F.when(n % 2 == 0, "DROP").otherwise("FROBNICATE"))
    return table(spark, sf_dir, "orders").select(
        n.alias("op_id"), op.alias("operation"), F.when(n % 4 != 0, "lake").alias("catalog"),
        F.concat(F.lit("s"), F.col("o_custkey") % 10).alias("schema"),
        F.concat(F.lit("t"), F.col("o_custkey") % 40).alias("table"), F.lit("spark").alias("namespace"),
        F.col("o_orderdate").alias("event_time"))


def table_operations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables that are created, renamed and dropped, from ``orders``: names by customer, few and reused."""
    n = F.col("o_orderkey")
    op = F.when(n % 5 < 2, "CREATE_TABLE").when(n % 5 == 2, "RENAME").when(n % 5 == 3, "DROP").otherwise("INSERT")
    own = F.concat(F.lit("t"), F.col("o_custkey") % 40)
    return table(spark, sf_dir, "orders").select(
        n.alias("op_id"), op.alias("operation"),
        F.when(n % 5 == 2, F.concat(F.lit("t"), (F.col("o_custkey") * 7 + n) % 40)).otherwise(own).alias("name"),
        F.when(n % 5 == 2, own).alias("previous_name"), F.col("o_orderdate").alias("event_time"))


# Queries that the views of the view log are defined by, in turn.
VIEW_QUERIES = (
    "SELECT o_orderkey AS id, upper(o_orderpriority) AS label FROM orders",
    "SELECT c_custkey AS id, c_name AS label FROM customer WHERE c_acctbal > 0",
    "SELECT o_orderkey AS id, concat(c_name, n_name) AS label FROM orders JOIN customer ON o_custkey = c_custkey "
    "JOIN nation ON c_nationkey = n_nationkey")


def view_log(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Views that are defined anew, dropped and read, from ``orders``: (log, reads, plans).

    ``log`` has the CREATE VIEW and DROP VIEW statements as a plan log without texts (plan_id stands for
    them), ``reads`` query_id, view_name and event_time, ``plans`` the captured text of each statement.
    """
    register(spark, sf_dir, ["orders", "customer", "nation"])
    rows = [capture(spark.sql(f"CREATE OR REPLACE TEMP VIEW defined_{i} AS {q}"), str(i)) for i, q in enumerate(VIEW_QUERIES)]
    plans = plan_log_of(spark, rows).select(F.col("query_id").alias("plan_id"), "plan_json", "files")
    n = F.col("o_orderkey")
    rows = table(spark, sf_dir, "orders").select(
        n.cast("string").alias("query_id"), F.concat(F.lit("v"), F.col("o_custkey") % 20).alias("view_name"),
        F.expr("timestampadd(SECOND, cast(o_orderkey % 86400 AS int), o_orderdate)").alias("event_time"),
        F.when(n % 4 == 0, "CREATE_VIEW").when(n % 31 == 1, "DROP_VIEW").alias("sink_op"), (F.expr("o_orderkey div 4") % 3).alias("turn"))
    log = rows.filter("sink_op is not null").select(
        "query_id", F.when(F.col("sink_op") == "CREATE_VIEW", F.col("turn").cast("string")).alias("plan_id"),
        "sink_op", F.col("view_name").alias("sink_name"), "event_time")
    return log, rows.filter("sink_op is null").select("query_id", "view_name", "event_time"), plans


def query_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scans per query from ``lineitem``: query = order, dataset = supplier, position = line."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("query_id"),
        (F.col("l_linenumber") * 1000000 + F.col("l_partkey")).cast("bigint").alias("position"),
        F.lit("spark").alias("namespace"),
        F.concat(F.when(F.col("l_suppkey") % 10 == 0, "__meta_").otherwise("lake.s."), F.col("l_suppkey")).alias("name"))


def query_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One output per query from ``orders``."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("query_id"), F.lit(0).cast("bigint").alias("position"), F.lit("spark").alias("namespace"),
        F.concat(F.lit("lake.out.c"), F.col("o_custkey")).alias("name"))


def plan_log(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """A query log as long as ``orders``: (queries, plans).

    Each order is one execution of one of the traced queries (by key) on the tables of a
    tenant (by customer). ``plans`` holds each distinct plan text once: the captured plan
    with its table names moved to the tenant's. Plans grow with the number of customers.
    """
    templates = traced_plan_log(spark, sf_dir).select(F.col("query_id").alias("template"), "query", _between_tables())
    names = traced_names()
    number = F.map_from_arrays(F.array(*[F.lit(i) for i in range(len(names))]), F.array(*[F.lit(n) for n in names]))
    queries = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("query_id"),
        number[(F.col("o_orderkey") % len(names)).cast("int")].alias("template"),
        F.expr("o_custkey div 20").alias("tenant"), F.col("o_orderdate").alias("event_time"),
    ).withColumn("plan_id", F.concat_ws("@", "template", "tenant"))
    # Plan texts are thousands of times larger than their keys: spread the keys first, over a number of
    # tasks that follows the table. Without one, keys are put together by their own size, into a task a core.
    spread = queries.select("template", "tenant", "plan_id").distinct().repartition(_text_tasks(spark, sf_dir), "plan_id")
    plans = spread.join(F.broadcast(templates), "template").select(
        "plan_id", "query",
        _of_tenant().alias("plan_json"))
    return queries, plans


def raw_log(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The query log as a plan log with the text of each execution, and its runs: (plan log, runs).

    Each order is a query that creates a table of the lake, and a run that ends a day later. Only the executions
    are written; their texts, a thousand times as large, are made for whoever reads them.
    """
    templates = traced_plan_log(spark, sf_dir).select(
        F.col("query_id").alias("template"), "query", "sink_fields", _between_tables())
    none = F.lit(None).cast("string")
    # In small files, or the texts of a log would be made and cut in as few tasks as there are row groups of orders.
    executions = materialize(plan_log(spark, sf_dir)[0].select("query_id", "template", "tenant", "event_time"), "executions", 16384)
    # Each execution makes its own text: no text is shuffled.
    log = executions.join(F.broadcast(templates), "template").select(
        "query_id", "query", _of_tenant().alias("plan_json"), F.lit(None).cast("array<struct<leaf: int, paths: array<string>>>").alias("files"),
        F.lit("CREATE_TABLE").alias("sink_op"), none.alias("sink_ns"),
        F.concat(F.lit("lake.out."), "template", F.lit("_"), F.col("tenant").cast("string")).alias("sink_name"),
        F.col("event_time").cast("timestamp").alias("event_time"), "sink_fields", none.alias("prev_ns"), none.alias("prev_name"))
    o = table(spark, sf_dir, "orders")
    runs = o.select(
        F.col("o_orderkey").cast("string").alias("query_id"), uuid_of(F.col("o_orderkey")).alias("run_id"),
        F.col("o_orderdate").cast("timestamp").alias("started"), F.date_add("o_orderdate", 1).cast("timestamp").alias("ended"),
        F.when(F.col("o_orderstatus") == "O", "FAIL").otherwise("COMPLETE").alias("event_type"),
        F.col("o_custkey").alias("row_count"), F.lit(None).cast("bigint").alias("size_bytes"),
        F.concat(F.lit("bad "), "o_orderpriority").alias("error"))
    return log, runs


def recaptured_plan_log(spark: SparkSession, sf_dir: str, captures: int = 3) -> tuple[DataFrame, DataFrame]:
    """As ``plan_log``, but each query text is analyzed anew ``captures`` times: (queries, variants).

    Each execution has the text of one capture; ``variants`` has each (template, variant, tenant) once.
    """
    logs = [traced_plan_log(spark, sf_dir, fresh=i).select(
        F.col("query_id").alias("template"), F.lit(i).alias("variant"), _between_tables(),
        F.lit(None).cast("array<struct<leaf: int, paths: array<string>>>").alias("files")) for i in range(captures)]
    templates = logs[0]
    for log in logs[1:]:
        templates = templates.union(log)
    queries = plan_log(spark, sf_dir)[0].withColumn("variant", (F.col("query_id").cast("bigint") % captures).cast("int"))
    # In another order than they are told apart by, or that shuffle would be taken for this one.
    spread = queries.select("template", "variant", "tenant").distinct().repartition(
        _text_tasks(spark, sf_dir), "tenant", "variant", "template")
    return queries, spread.join(F.broadcast(templates), ["template", "variant"]).withColumn("plan_json", _of_tenant()).drop("between")


def _text_tasks(spark: SparkSession, sf_dir: str) -> int:
    """Tasks that plan texts are made in: as many orders in each, however long the log is."""
    return parts_of(table(spark, sf_dir, "orders"), 512 << 10)


def _between_tables():
    """A captured plan text, cut behind each table name."""
    cut = F.regexp_replace("plan_json", '"table":"([a-z_]+)"', '"table":"$1\ue000"')
    return F.split(cut, "\ue000").alias("between")


def _of_tenant():
    """The plan text with its table names moved to the tenant's."""
    return F.expr("array_join(between, concat('_', tenant))")
