"""The relational tables behind the traced queries."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def register(spark: SparkSession, sf_dir: str, names: Iterable[str] = TABLES) -> None:
    """Register tables as temporary views of their own names."""
    for name in names:
        table(spark, sf_dir, name).createOrReplaceTempView(name)


def plan_bytes(df: DataFrame) -> int:
    """The optimizer's size estimate of a DataFrame."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def parts_of(df: DataFrame, part_bytes: int) -> int:
    """Shuffle partitions of about ``part_bytes`` each by the optimizer's estimate, at least the session's:
    a task's share does not grow with the table. For rows of a table as it is; joins are estimated far too high."""
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), plan_bytes(df) // part_bytes + 1)


def small_side(df: DataFrame, max_bytes: int = 64 << 20) -> DataFrame:
    """Broadcast hint if the estimated size allows it; otherwise the join shuffles."""
    return F.broadcast(df) if plan_bytes(df) <= max_bytes else df
