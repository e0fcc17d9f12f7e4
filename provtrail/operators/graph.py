"""The dataset graph of many runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def dataset_edges(inputs: DataFrame, outputs: DataFrame, key: str = "query_id", parts: int | None = None) -> DataFrame:
    """Distinct direct edges input -> output of all queries; not transitive.

    Inputs and outputs are first reduced to distinct (key, dataset) pairs. One query's
    datasets are bounded by its plan, so the join cannot blow up on a hot query. Given ``parts``,
    both sides meet in as many partitions, which bounds the edges that one task holds.
    """
    i = inputs.select(key, F.col("namespace").alias("in_namespace"), F.col("name").alias("in_name"))
    o = outputs.select(key, F.col("namespace").alias("out_namespace"), F.col("name").alias("out_name"))
    if parts:
        i, o = i.repartition(parts, key), o.repartition(parts, key)
    i, o = i.distinct(), o.distinct()
    return i.join(o, key).select("in_namespace", "in_name", "out_namespace", "out_name").distinct()


def event_edges(events: DataFrame) -> DataFrame:
    """As ``dataset_edges`` from START events, which hold both lists in one row: no join."""
    return (
        events.filter("eventType = 'START'")
        .select(F.explode("inputs").alias("i"), "outputs")
        .select("i", F.explode("outputs").alias("o"))
        .select(F.col("i.namespace").alias("in_namespace"), F.col("i.name").alias("in_name"),
                F.col("o.namespace").alias("out_namespace"), F.col("o.name").alias("out_name"))
        .distinct()
    )


def collapse_views(inputs: DataFrame, reached: DataFrame, key: str = "query_id") -> DataFrame:
    """Put referenced views in place of the scans beneath them.

    ``inputs``: key, position, namespace, name (one row per scan). ``reached``: key,
    position, view_namespace, view_name: the scan at that position was reached through the
    view. A table also scanned directly keeps its direct row.
    """
    direct = inputs.join(reached.select(key, "position"), [key, "position"], "left_anti").select(
        key, "namespace", "name", F.lit("TABLE").alias("dataset_type"))
    views = reached.select(key, F.col("view_namespace").alias("namespace"), F.col("view_name").alias("name"),
                           F.lit("VIEW").alias("dataset_type"))
    return direct.unionByName(views).distinct()
