"""Statement classification and job names of whole plan logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from provtrail.functions.naming import job_name, short_hash
from provtrail.plans.parse import DEFINITION

# Operator of the root node to statement type.
STATEMENTS = {
    "INSERT": "INSERT", "DELETE": "DELETE", "UPDATE": "UPDATE", "MERGE_INTO": "MERGE",
    "CREATE_TABLE": "CREATE_TABLE", "CREATE_INDEX": "CREATE_INDEX", "CREATE_VIEW": "CREATE_VIEW",
    "CREATE_SCHEMA": "CREATE_SCHEMA", "CREATE_SEQUENCE": "CREATE_SEQUENCE", "CREATE_MACRO": "CREATE_MACRO",
    "CREATE_TYPE": "CREATE_TYPE", "DROP": "DROP", "ALTER": "ALTER", "COPY_TO_FILE": "COPY",
    "VACUUM": "VACUUM", "EXPLAIN": "EXPLAIN", "ATTACH": "ATTACH", "DETACH": "DETACH", "EXPORT": "EXPORT",
}
# Statements that carry no lineage.
UTILITY = ("SET", "RESET", "PRAGMA", "EXPLAIN", "TRANSACTION", "LOAD", "PREPARE",
           "UPDATE_EXTENSIONS", "CREATE_SECRET")
# Catalyst node classes to the operator kinds above and in statement_type.
CATALYST_OPERATORS = {
    "Aggregate": "AGGREGATE", "Window": "WINDOW", "Union": "UNION", "Except": "EXCEPT",
    "Intersect": "INTERSECT", "Distinct": "DISTINCT", "Deduplicate": "DISTINCT", "WithCTE": "MATERIALIZED_CTE",
    "UnionLoop": "RECURSIVE_CTE", "AsOfJoin": "ASOF_JOIN", "InsertIntoStatement": "INSERT",
    "InsertIntoHadoopFsRelationCommand": "INSERT", "AppendData": "INSERT", "OverwriteByExpression": "INSERT",
    "CreateTableAsSelect": "CREATE_TABLE", "CreateDataSourceTableAsSelectCommand": "CREATE_TABLE",
    "CreateViewCommand": "CREATE_VIEW", "DeleteFromTable": "DELETE", "UpdateTable": "UPDATE",
    "MergeIntoTable": "MERGE_INTO", "DropTable": "DROP", "SetCommand": "SET", "ResetCommand": "RESET",
    "ExplainCommand": "EXPLAIN",
}
MAX_TABLES = 3


def lookup(mapping: dict[str, str], key: Column) -> Column:
    """Constant map lookup, NULL when absent."""
    return F.create_map(*[F.lit(v) for kv in mapping.items() for v in kv])[key]


def operator_of(cls: Column, join_type: Column, has_condition: Column | None = None) -> Column:
    """Operator kind of a Catalyst node class; other classes keep their name."""
    join = F.when(join_type.contains("Cross"), "CROSS_PRODUCT").otherwise("COMPARISON_JOIN")
    return F.when(cls == "Join", join).otherwise(F.coalesce(lookup(CATALYST_OPERATORS, cls), cls))


def profile_plans(nodes: DataFrame, salts: int = 1) -> DataFrame:
    """One row per query: root, child_types, operators, counts of joins, first tables.

    ``nodes``: query_id, node_id (pre-order, root first), parent_id (0 below the root),
    operator, table_name. A plan has few nodes, so one aggregate does. For queries with very
    many nodes set ``salts``: each is then first reduced in so many parts; what is merged per
    query is of bounded size (sets of operator kinds, at most three tables a part).
    """
    op = F.col("operator")

    def first_tables(lists):
        return F.slice(F.sort_array(lists), 1, MAX_TABLES)

    part = (
        nodes.groupBy("query_id", *([F.pmod(F.xxhash64("node_id"), F.lit(salts)).alias("_salt")] if salts > 1 else []))
        .agg(
            F.min(F.struct("node_id", "operator")).alias("_root"),
            F.collect_set(F.when(F.col("parent_id") == 0, op)).alias("_children"),
            F.collect_set(op).alias("_operators"),
            F.count_if(op.isin("JOIN", "COMPARISON_JOIN")).alias("_joins"),
            F.count("node_id").alias("_nodes"),
            first_tables(F.collect_list(
                F.when(F.col("table_name").isNotNull(), F.struct("node_id", "table_name")))).alias("_tables"),
        )
    )
    if salts == 1:
        return part.select(
            "query_id", F.col("_root.operator").alias("root"), F.col("_children").alias("child_types"),
            F.sort_array("_operators").alias("operators"), F.col("_joins").alias("join_count"),
            F.col("_nodes").alias("node_count"), F.transform("_tables", lambda t: t["table_name"]).alias("tables"))
    return (
        part.groupBy("query_id")
        .agg(
            F.min("_root")["operator"].alias("root"),
            F.array_distinct(F.flatten(F.collect_list("_children"))).alias("child_types"),
            F.sort_array(F.array_distinct(F.flatten(F.collect_list("_operators")))).alias("operators"),
            F.sum("_joins").alias("join_count"), F.sum("_nodes").alias("node_count"),
            F.transform(first_tables(F.flatten(F.collect_list("_tables"))), lambda t: t["table_name"]).alias("tables"),
        )
    )


def statement_type(profile: DataFrame) -> DataFrame:
    """Add ``statement``: the type of each profiled query."""
    def has(*ops):
        return F.arrays_overlap("operators", F.array(*[F.lit(o) for o in ops]))

    join = has("JOIN", "COMPARISON_JOIN", "CROSS_PRODUCT", "ASOF_JOIN")
    aggregate = has("AGGREGATE")
    select = (
        F.when(has("UNION"), "SELECT_UNION")
        .when(has("EXCEPT"), "SELECT_EXCEPT")
        .when(has("INTERSECT"), "SELECT_INTERSECT")
        .when(has("MATERIALIZED_CTE", "RECURSIVE_CTE"), "SELECT_CTE")
        .when(aggregate & join, "SELECT_AGG_JOIN")
        .when(aggregate, "SELECT_AGG")
        .when(join & (F.col("join_count") > 1), "SELECT_MULTIJOIN")
        .when(join, "SELECT_JOIN")
        .when(has("WINDOW"), "SELECT_WINDOW")
        .when(has("DISTINCT"), "SELECT_DISTINCT")
        .otherwise("SELECT")
    )
    child_write = F.when(F.array_contains("child_types", "INSERT"), "INSERT").when(
        F.array_contains("child_types", "CREATE_TABLE"), "CREATE_TABLE")
    return profile.withColumn("statement", F.coalesce(lookup(STATEMENTS, F.col("root")), child_write, select))


def job_names(profile: DataFrame, queries: DataFrame) -> DataFrame:
    """Job name of every query: query_id, statement, job_name.

    ``queries``: query_id, query, plan_json (hashed where the text is missing).
    """
    texts = queries.select("query_id", short_hash("query", "plan_json").alias("hash8"))
    return statement_type(profile).join(texts, "query_id").select(
        "query_id", "statement", job_name("statement", "tables", "hash8").alias("job_name"))


def drop_utility(profile: DataFrame) -> DataFrame:
    """Leave out queries whose root is a utility statement."""
    return profile.filter(~F.col("root").isin(*UTILITY))


def plan_log_nodes(parsed_nodes: DataFrame, scans: DataFrame) -> DataFrame:
    """Nodes of parsed plans in the layout ``profile_plans`` reads (query_id = plan_id).

    A subquery in an expression, the right side of a lateral join too, counts as a join of its plan
    with the outer query. The joins below are on the node's full key, so their keys are unique and even.
    """
    key = ["plan_id", "scope", "nid"]
    parents = parsed_nodes.select("plan_id", "scope", F.col("nid").alias("parent_id"), F.explode("kids").alias("nid"))
    named = scans.select(*key, F.element_at(F.split("known_as", "\\."), -1).alias("table_name"))
    inner = F.col("scope") != "0"
    # Subplans sort behind the top-level plan.
    node_id = F.struct(inner.alias("inner"), F.col("scope"), F.col("nid"))
    nodes = parsed_nodes.join(parents, key, "left").join(named, key, "left").select(
        F.col("plan_id").alias("query_id"), node_id.alias("node_id"),
        F.when(~inner, F.col("parent_id")).alias("parent_id"),
        operator_of(F.col("cls"), F.col("join_type")).alias("operator"), "table_name")
    # The query of a view definition is joined with nothing.
    subqueries = parsed_nodes.filter(inner & (F.col("nid") == 0) & ~F.col("scope").endswith(f"/{DEFINITION}")).select(
        F.col("plan_id").alias("query_id"), node_id.alias("node_id"), F.lit(None).cast("int").alias("parent_id"),
        F.lit("COMPARISON_JOIN").alias("operator"), F.lit(None).cast("string").alias("table_name"))
    return nodes.unionByName(subqueries)
