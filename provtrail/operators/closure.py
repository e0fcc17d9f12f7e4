"""Transitive closure of edge tables by pointer doubling."""

from __future__ import annotations

from math import log2

from pyspark.sql import DataFrame, functions as F

from provtrail.session import materialize


#: Rounds before the sources are counted: paths of up to 2 ** 8 steps need no count.
PATIENCE = 8


def close_edges(edges: DataFrame, keys: list[str], flag: str = "breaks") -> DataFrame:
    """All (src, terminal) pairs of an acyclic edge table.

    ``edges``: ``keys`` + src, dst, flag, terminal. A row with ``terminal`` set has reached
    an end; the others continue at ``dst``. Each round joins the table with itself, so a
    path of length n takes log2(n) rounds, and pairs met over several paths are merged
    before the next round (flag: true if any path has it). Rounds are written tables: each
    one starts from compact, durable rows, and the loop's only driver-side knowledge is
    whether an open row is left. ``edges`` is read twice, so it should be cheap to read.

    A path has fewer steps than there are sources. After ``PATIENCE`` rounds these are counted;
    rows still open after as many rounds as a path of that length takes are a cycle.
    """
    group = [*keys, "src", "dst", "terminal"]
    reach = edges.select(*group, flag)
    rounds, most = 0, None
    while True:
        still_open = reach.filter(~F.col("terminal"))
        if still_open.isEmpty():
            return reach.drop("terminal")
        if rounds == PATIENCE:
            most = log2(edges.select(*keys, "src").distinct().count() + 1) + 1
        if most is not None and rounds > most:
            raise ValueError("the graph has a cycle")
        rounds += 1
        left = still_open.select(*keys, F.col("src").alias("from"), F.col("dst").alias("via"), F.col(flag).alias("f"))
        right = reach.withColumnRenamed("src", "via")
        stepped = left.join(right, [*keys, "via"]).select(
            *keys, F.col("from").alias("src"), "dst", "terminal", (F.col("f") | F.col(flag)).alias(flag))
        reach = materialize(
            reach.filter("terminal").select(*group, flag).unionByName(stepped)
            .groupBy(*group).agg(F.max(flag).alias(flag)), "closure")
