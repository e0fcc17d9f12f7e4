"""Reading and writing run events and plan logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from provtrail.schema import EVENT_DDL, PLAN_LOG_DDL


def event_json(events: DataFrame) -> Column:
    """An event row as a JSON document; NULL facets vanish."""
    return F.to_json(F.struct(*events.columns), {"ignoreNullFields": "true"})


def events_to_json(events: DataFrame) -> DataFrame:
    """One column ``value``: the JSON document of each event."""
    return events.select(event_json(events).alias("value"))


def events_from_json(df: DataFrame, col: str = "value") -> DataFrame:
    return df.select(F.from_json(col, EVENT_DDL).alias("e")).select("e.*")


def write_events(events: DataFrame, path: str, mode: str = "append") -> None:
    """Write events as JSON lines, compressed: their names and schema URLs repeat in each."""
    events_to_json(events).write.mode(mode).text(path, compression="gzip")


def read_events(spark: SparkSession, path: str) -> DataFrame:
    """Read events back with the fixed schema: no inference pass over the data."""
    return spark.read.schema(EVENT_DDL).json(path)


def stream_events(spark: SparkSession, path: str, max_files_per_trigger: int = 100) -> DataFrame:
    """Stream event files. A full intake makes batches wait instead of dropping events."""
    return spark.readStream.schema(EVENT_DDL).option("maxFilesPerTrigger", max_files_per_trigger).json(path)


def read_plan_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PLAN_LOG_DDL).parquet(path)
