"""Data queries for the traced shapes.

Most run the traced SQL as it is. Those below use a form that also stands up to hot keys,
large recursions or global ranks; their results are those of the traced SQL (q27 asks the same of other tables).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from provtrail.operators.recursive import recurse
from provtrail.operators.windows import asof_join, first_per_key, global_rank, ordered_prefix, with_halo
from provtrail.plans.traced import TRACED, traced, traced_frame
from provtrail.session import work_dir
from provtrail.sources.tables import parts_of, register, small_side, table
from provtrail.sources.traced_io import TraceLog

MONEY = "decimal(18,2)"
# Bytes of text, as stored, that one task counts the words of.
PART_BYTES = 2 << 20


def cross_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    region = table(spark, sf_dir, "region").select("r_name")
    return table(spark, sf_dir, "customer").select("c_custkey").crossJoin(small_side(region))


def row_number_running(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        "o_custkey", "o_orderkey", "o_orderdate", F.trunc("o_orderdate", "month").alias("month"),
        F.col("o_totalprice").cast(MONEY).alias("price"))
    out = ordered_prefix(orders, ["o_custkey"], "month", ["o_orderdate", "o_orderkey"], "rn", {"running": "price"})
    return out.select("o_orderkey", "rn", F.col("running").cast("double").alias("running"))


def rank_lag_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select(
        "user_id", F.to_date("ts").alias("day"), "ts", "event_id", "value")
    rows = with_halo(events, ["user_id"], "day", ["ts", "event_id"], 2)
    w = Window.partitionBy("user_id", "day").orderBy("ts", "event_id")
    return rows.select(
        "event_id", "is_halo", F.lag("value").over(w).alias("prev_value"),
        F.avg("event_id").over(w.rowsBetween(-2, 0)).alias("moving"),
    ).filter("not is_halo").drop("is_halo")


def ranked_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = table(spark, sf_dir, "customer").groupBy("c_mktsegment").agg(
        F.sum(F.col("c_acctbal").cast(MONEY)).alias("total"))
    return global_rank(totals, "total").select("c_mktsegment", F.col("total").cast("double").alias("total"), "rnk")


def qualify_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return first_per_key(orders, ["o_custkey"], [-F.col("o_totalprice"), F.col("o_orderkey")])


def share_of_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_quantity")
    totals = lines.groupBy("l_suppkey").agg(F.sum("l_quantity").alias("total"))
    return lines.join(totals, "l_suppkey").select(
        "l_orderkey", "l_linenumber", "l_quantity", (F.col("l_quantity") / F.col("total")).alias("share"))


def window_over_unnest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    # Texts are shuffled, not their words, in parts of a size that does not grow with the table.
    words = docs.repartition(parts_of(docs, PART_BYTES), "doc_id").select("doc_id", F.explode(F.split("text", " ")).alias("word"))
    # COUNT(...) OVER the full key gives each of n equal rows the count n.
    return words.groupBy("doc_id", "word").agg(F.count("word").alias("n")).select(
        "doc_id", "word", "n", F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))).alias("_i")).drop("_i")


def asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("key"), "l_orderkey", "l_linenumber", "l_partkey", "l_shipdate")
    orders = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("key"), "o_orderdate", "o_orderkey")
    return asof_join(lines, orders, ["key"], "l_shipdate", "o_orderdate", ["o_orderkey"],
                     lambda t: F.trunc(t, "month")).drop("l_shipdate", "o_orderdate")


def recursive_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name", F.expr("c_custkey div 2").alias("parent"))
    seed = customer.filter("c_custkey = 1").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.lit(1).alias("depth"))

    def step(level):
        up = level.select(F.col("id").alias("parent"), (F.col("depth") + 1).alias("depth"))
        return customer.join(up, "parent").select(
            F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), "depth")

    return recurse(seed, step)


def struct_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return traced(spark, sf_dir, "q34_struct").select("s.id", "s.name")


def nested_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return traced(spark, sf_dir, "q40_nested").select(
        "doc_id", "meta.lang", "meta.chars", F.array_join("parts", "|").alias("parts"))


def cte_join_agg_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = table(spark, sf_dir, "orders").join(
        table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    totals = base.groupBy("c_mktsegment").agg(F.sum(F.col("o_totalprice").cast(MONEY)).alias("total"))
    return global_rank(totals, "total").select("c_mktsegment", F.col("total").cast("double").alias("total"), "rnk")


def file_round_trip(spark: SparkSession, sf_dir: str, fmt: str, **options) -> DataFrame:
    """Export a table and read the files back."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority")
    path = f"{work_dir(spark)}/provtrail/export-{uuid.uuid4().hex}"
    orders.write.format(fmt).options(**options).save(path)
    return spark.read.format(fmt).options(**options).schema(orders.schema).load(path)


WAITS = "datediff(l_shipdate, o_orderdate)"
# A pipeline over how long lines wait for their shipment: (table, query), layer by layer.
WAITING: tuple[tuple[str, str], ...] = (
    ("line_waits", f"""SELECT l_suppkey, l_partkey, l_quantity, {WAITS} AS days
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""),
    ("supplier_places", """SELECT s_suppkey, n_name AS place, r_name AS area FROM supplier
        JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""),
    ("place_waits", """SELECT area, place, count(*) AS n_lines, sum(days) AS days FROM {line_waits}
        JOIN {supplier_places} ON l_suppkey = s_suppkey GROUP BY area, place"""),
    ("brand_waits", """SELECT area, p_brand, count(*) AS n_lines, sum(days) AS days FROM {line_waits}
        JOIN {supplier_places} ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey GROUP BY area, p_brand"""),
    ("area_report", """WITH areas AS (SELECT area, sum(n_lines) AS n_lines, sum(days) AS days FROM {place_waits} GROUP BY area),
        places AS (SELECT p.area, count_if(p.days * a.n_lines > a.days * p.n_lines) AS slow_places
            FROM {place_waits} p JOIN areas a ON p.area = a.area GROUP BY p.area),
        brands AS (SELECT b.area, count_if(b.days * a.n_lines > a.days * b.n_lines) AS slow_brands
            FROM {brand_waits} b JOIN areas a ON b.area = a.area GROUP BY b.area)
        SELECT areas.area, n_lines, days, slow_places, slow_brands FROM areas
        JOIN places ON areas.area = places.area JOIN brands ON areas.area = brands.area"""),
)


def waiting_pipeline(spark: SparkSession, sf_dir: str) -> tuple[TraceLog, dict[str, str]]:
    """Run the pipeline as traced writes: the log, and the table that each layer became."""
    register(spark, sf_dir, ["orders", "lineitem", "part", "supplier", "nation", "region"])
    base, run = f"{work_dir(spark)}/provtrail/waiting-{uuid.uuid4().hex}", uuid.uuid4().hex
    log, made = TraceLog(spark, f"{base}/log"), {}
    for name, text in WAITING:
        query = text.format(**made)
        log.create(spark.sql(query), f"{name}_{run}", query=query, path=f"{base}/{name}")
        made[name] = f"{name}_{run}"
    return log, made


def multi_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last layer of the pipeline."""
    return spark.table(waiting_pipeline(spark, sf_dir)[1]["area_report"])


# Lateral joins whose output has columns of the outer side: Spark would pair the sides to tell these apart.
AS_JOINS = {
    "q41_lateral_outer": """SELECT s_suppkey, concat(s_name, n_name) AS home, s_name AS owner FROM supplier
        JOIN nation ON n_nationkey = s_nationkey""",
    "q41_lateral_join": """SELECT c_custkey, n_name, lower(r_name) AS area, upper(c_name) AS owner FROM customer
        JOIN nation ON n_nationkey = c_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "q41_lateral_nested": """SELECT c_custkey, n_name, concat(n_name, r_name) AS label FROM customer
        JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey""",
}


def lateral_as_join(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    register(spark, sf_dir, ["supplier", "customer", "nation", "region"])
    return spark.sql(AS_JOINS[name])


# Plan-only shapes: they read no table, or SQL gives their data in a form of their own here.
PLAN_ONLY = ("q28_recursive_constant", "q29_series")
OWN_FORM: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "q09_cross_join": cross_join,
    "q17_row_number": row_number_running,
    "q18_rank_lag_frame": rank_lag_frame,
    "q18_rank": ranked_segments,
    "q19_qualify": qualify_first,
    "q20_share": share_of_total,
    "q25_window_unnest": window_over_unnest,
    "q27_asof": asof,
    "q28_recursive": recursive_chain,
    "q34_struct": struct_fields,
    "q36_cte_join_agg_window": cte_join_agg_window,
    "q37_csv": partial(file_round_trip, fmt="csv", header="true"),
    "q37_parquet": partial(file_round_trip, fmt="parquet"),
    "q38_multi_layer": multi_layer,
    "q40_nested": nested_fields,
    **{name: partial(lateral_as_join, name=name) for name in AS_JOINS},
    "q42_unpivot_frame": partial(traced_frame, name="q42_unpivot_frame"),
}


def shape_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    names = [n for n in TRACED if n not in PLAN_ONLY and n not in OWN_FORM]
    plain = {n: partial(traced, name=n) for n in names}
    return dict(sorted({**plain, **OWN_FORM}.items()))
