"""Session helpers: a tuned local session and durable intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = 8, memory: str = "16g") -> SparkSession:
    """A session for tests and the benchmark. Clusters bring their own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("provtrail")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.files.maxPartitionBytes", "16m")
        # Collecting aggregates otherwise sort once a task has seen 128 keys.
        .config("spark.sql.objectHashAggregate.sortBased.fallbackThreshold", "65536")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="provtrail-ckpt-"))
        .getOrCreate()
    )


def work_dir(spark: SparkSession) -> str:
    """Shared folder for intermediate tables, from ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder: on a cluster such a
    folder would be invisible to the other executors.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if base:
        return base
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    base = tempfile.mkdtemp(prefix="provtrail-ckpt-")
    spark.sparkContext.setCheckpointDir(base)
    return base


def materialize(df: DataFrame, label: str, file_rows: int = 0) -> DataFrame:
    """Write ``df`` to the shared folder and read it back, cutting its lineage.

    A written table survives the loss of any executor, is columnar (later stages read
    only the columns they need) and gives the optimizer real sizes. Files of at most ``file_rows`` rows
    each let later stages have more tasks than this one.
    """
    path = f"{work_dir(df.sparkSession)}/provtrail/{label}-{uuid.uuid4().hex}"
    (df.write.option("maxRecordsPerFile", file_rows) if file_rows else df.write).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
