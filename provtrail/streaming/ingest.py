"""Continuous intake of run events: validation, duplicates, run state."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from provtrail.operators.events import with_reason
from provtrail.session import work_dir


@dataclass
class IntakeTables:
    """Folders an intake writes to."""

    root: str

    @property
    def events(self) -> str:
        return f"{self.root}/events"

    @property
    def rejects(self) -> str:
        return f"{self.root}/rejects"

    @property
    def partials(self) -> str:
        return f"{self.root}/run_partials"

    @property
    def counters(self) -> str:
        return f"{self.root}/counters"


def flat_events(events: DataFrame) -> DataFrame:
    """Event rows to run_id, job_name, event_type, event_time, row_count."""
    return events.select(
        F.col("run.runId").alias("run_id"), F.col("job.name").alias("job_name"), F.col("eventType").alias("event_type"),
        # Event times are UTC; without a zone they read the same in every session time zone.
        F.to_timestamp_ntz(F.regexp_replace("eventTime", "Z$", "")).alias("event_time"),
        F.get("outputs.outputFacets.outputStatistics.rowCount", F.lit(0)).alias("row_count"))


def _into(df: DataFrame, folder: str, batch_id: int) -> None:
    # A batch that is run again after a failure overwrites its own folder.
    df.write.mode("overwrite").parquet(f"{folder}/batch={batch_id}")


def ingest(
    stream: DataFrame, tables: IntakeTables, checkpoint: str, strict: bool = False, **trigger,
) -> StreamingQuery:
    """Split a stream into valid events and rejects, and keep the run state.

    ``trigger`` as for ``DataStreamWriter.trigger``: what is available now by default, or for a
    continuous intake ``processingTime="1 minute"``.

    Each batch also leaves a small mergeable summary per run and its counts (events taken,
    rejected). Run state is merged from the summaries when read, so no state store grows
    with the number of runs and late or missing ends are never dropped.
    """
    checked = with_reason(stream, strict)

    def batch(df: DataFrame, batch_id: int) -> None:
        df.persist()
        try:
            valid = df.filter("reason is null").drop("reason")
            _into(valid, tables.events, batch_id)
            _into(df.filter("reason is not null"), tables.rejects, batch_id)
            _into(run_partials(flat_events(valid)), tables.partials, batch_id)
            _into(df.groupBy().agg(
                F.count(F.lit(1)).alias("seen"), F.count("reason").alias("rejected")), tables.counters, batch_id)
        finally:
            df.unpersist()

    return (checked.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())


def read_valid_events(spark: SparkSession, tables: IntakeTables) -> DataFrame:
    """Valid events, each once: of deliveries of one run and event type the first by event time stays.

    The summaries behind ``read_run_state`` are the same for repeated deliveries.
    """
    rows = spark.read.parquet(tables.events).drop("batch")
    key = ["run.runId", "eventType"]
    return rows.groupBy(*[F.col(k).alias(f"_{i}") for i, k in enumerate(key)]).agg(
        F.min_by(F.struct(*rows.columns), F.struct("eventTime", F.xxhash64(*[F.to_json(c) if c in (
            "run", "job", "inputs", "outputs") else c for c in rows.columns]))).alias("e")).select("e.*")


def run_partials(events: DataFrame) -> DataFrame:
    """Mergeable summary per run of one batch."""
    end = F.col("event_type").isin("COMPLETE", "FAIL")
    return events.groupBy("run_id").agg(
        F.max("job_name").alias("job_name"),
        F.min(F.when(F.col("event_type") == "START", F.col("event_time"))).alias("started"),
        F.max(F.when(end, F.struct("event_time", "event_type", "row_count"))).alias("last_end"))


def merge_partials(partials: DataFrame) -> DataFrame:
    """Run state from summaries of any number of batches; equals ``operators.events.run_state``."""
    return (
        partials.groupBy("run_id")
        .agg(F.max("job_name").alias("job_name"), F.min("started").alias("started"), F.max("last_end").alias("e"))
        .select("run_id", "job_name", "started", F.col("e.event_time").alias("ended"),
                F.coalesce("e.event_type", F.lit("START")).alias("state"), F.col("e.row_count").alias("row_count"),
                F.col("e").isNull().alias("orphan"))
    )


def read_run_state(spark: SparkSession, tables: IntakeTables) -> DataFrame:
    return merge_partials(read_batches(spark, tables.partials))


def read_batches(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of all batches of a folder: those merged by the last finished ``compact``, and later ones."""
    upto, path = _compacted(spark, folder)
    rows = spark.read.parquet(folder)
    if path is None:
        return rows.drop("batch")
    return rows.filter(F.col("batch") > upto).drop("batch").unionByName(spark.read.schema(rows.drop("batch").schema).parquet(path))


def compact(spark: SparkSession, folder: str, merge=None, files: int = 8) -> None:
    """Merge the batches of a folder into ``files`` files, reduced by ``merge`` if given.

    The merged rows are written aside and become valid by one row of the folder's manifest, so readers
    see the old batches or the merged ones, and a compaction that breaks off changes nothing. Batches
    that arrive meanwhile are read as before. What the manifest has replaced can be deleted once no
    reader that began before is left.
    """
    last = spark.read.parquet(folder).agg(F.max("batch")).first()[0]
    if last is None or last <= _compacted(spark, folder)[0]:
        return
    upto, path = _compacted(spark, folder)
    batches = spark.read.parquet(folder).filter((F.col("batch") > upto) & (F.col("batch") <= last)).drop("batch")
    rows = batches if path is None else batches.unionByName(spark.read.schema(batches.schema).parquet(path))
    made = f"{folder}/_compacted/{uuid.uuid4().hex}"
    (rows if merge is None else merge(rows)).coalesce(files).write.parquet(made)
    manifest = spark.createDataFrame([(int(last), made)], MANIFEST_DDL)
    manifest.coalesce(1).write.mode("append").parquet(f"{folder}/_manifest")


MANIFEST_DDL = "upto bigint, path string"


def _compacted(spark: SparkSession, folder: str) -> tuple[int, str | None]:
    """The last merged batch and where the merged rows are; (-1, None) before any compaction."""
    try:
        row = spark.read.schema(MANIFEST_DDL).parquet(f"{folder}/_manifest").orderBy(F.desc("upto"), "path").first()
    except AnalysisException:  # no manifest yet
        row = None
    return (-1, None) if row is None else (row["upto"], row["path"])


def merge_summaries(partials: DataFrame) -> DataFrame:
    """Summaries of several batches as one per run; they merge on like those of a batch."""
    return partials.groupBy("run_id").agg(
        F.max("job_name").alias("job_name"), F.min("started").alias("started"), F.max("last_end").alias("last_end"))


@dataclass
class DedupTables:
    """Folders of ``dedup_keeping_late``."""

    root: str

    @property
    def first(self) -> str:
        return f"{self.root}/first"

    @property
    def progress(self) -> str:
        return f"{self.root}/progress"


def dedup_keeping_late(
    stream: DataFrame, tables: DedupTables, checkpoint: str, delay: str = "2 days",
    keys: tuple[str, ...] = ("run_id", "event_type"), **trigger,
) -> StreamingQuery:
    """Keep the first delivery of each event, however late it comes, and count the others.

    A row whose event time is more than ``delay`` before the newest one of all earlier batches is late:
    it is kept with ``late`` set, for a consumer that has closed those times. What was written is looked
    up among the rows of the batch's own days, since deliveries of one event have one event time; so
    there is no state that grows with the stream, and no row is lost. A batch that is run again finds
    what it found before.
    """
    spark = stream.sparkSession

    micros = F.unix_micros(F.col("event_time").cast("timestamp"))

    def batch(df: DataFrame, batch_id: int) -> None:
        df.persist()
        try:
            take(df, batch_id)
        finally:
            df.unpersist()

    def take(df: DataFrame, batch_id: int) -> None:
        day = F.to_date("event_time").alias("day")
        earlier = F.col("batch") < batch_id
        newest = None
        if batch_id and (done := _read_if_any(spark, tables.progress)) is not None:
            newest = done.filter(earlier).agg(F.max("newest")).first()[0]
        rest = [c for c in df.columns if c not in keys]
        once = df.withColumn("day", day).groupBy(*keys, "day").agg(
            F.min_by(F.struct(*rest), F.struct("event_time", F.xxhash64(*rest))).alias("_r"), F.count(F.lit(1)).alias("deliveries"))
        once = once.select(*[F.col(f"_r.{c}").alias(c) if c in rest else F.col(c) for c in df.columns], "day", "deliveries")
        days = df.agg(F.min(day), F.max(day), F.max(micros), F.count(F.lit(1))).first()
        fresh = once
        if batch_id and days[0] is not None and (known := _read_if_any(spark, tables.first)) is not None:
            known = known.filter(earlier & F.col("day").between(days[0], days[1])).select("day", *keys)
            fresh = once.join(known, ["day", *keys], "left_anti")
        late = F.lit(False) if newest is None else F.coalesce(
            micros < F.expr(f"unix_micros(timestamp_micros({newest}) - INTERVAL {delay})"), F.lit(False))
        _into(fresh.drop("deliveries").withColumn("late", late), tables.first, batch_id)
        _into(spark.createDataFrame([(days[2], days[3])], "newest bigint, deliveries bigint").coalesce(1), tables.progress, batch_id)

    return (stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())


def _read_if_any(spark: SparkSession, folder: str) -> DataFrame | None:
    try:
        return spark.read.parquet(folder)
    except AnalysisException:  # nothing written yet
        return None


def dedup_stream(events: DataFrame, delay: str = "2 days") -> DataFrame:
    """Drop events delivered twice: same run and type within ``delay`` of event time.

    Watermarks need TIMESTAMP, so a zone-less time is cast (session zone UTC). State is
    bounded by ``delay``; the watermark drops no first delivery unless it is later than that.
    """
    return events.withColumn("event_time", F.col("event_time").cast("timestamp")).withWatermark(
        "event_time", delay).dropDuplicatesWithinWatermark(["run_id", "event_type"])


def pair_stream(starts: DataFrame, ends: DataFrame, bound: str = "2 days") -> DataFrame:
    """START events with their end, and orphans once ``bound`` has passed, for time-ordered logs.

    A watermarked stream-stream join: state is bounded by ``bound``.
    """
    s = starts.select("run_id", F.col("event_time").cast("timestamp").alias("started")).withWatermark("started", bound)
    e = ends.select(F.col("run_id").alias("end_run"), F.col("event_type").alias("state"),
                    F.col("event_time").cast("timestamp").alias("ended")).withWatermark("ended", bound)
    return s.join(e, F.expr(
        f"run_id = end_run and ended >= started and ended <= started + interval {bound}"), "leftOuter").drop("end_run")


def run_to_table(stream: DataFrame, label: str, output_mode: str = "append") -> DataFrame:
    """Run a stream over what is available now and read the result back."""
    spark = stream.sparkSession
    root = f"{work_dir(spark)}/provtrail/{label}-{uuid.uuid4().hex}"
    query = (stream.writeStream.format("parquet").option("path", f"{root}/out")
             .option("checkpointLocation", f"{root}/checkpoint").outputMode(output_mode)
             .trigger(availableNow=True).start())
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{root}/out")


class LateRows(StreamingQueryListener):
    """Rows that watermarks dropped, by query id: ``spark.streams.addListener(LateRows())``.

    Counts every report, so also those of streams that run for long.
    """

    def __init__(self):
        self.dropped: dict[str, int] = {}
        self.ended: set[str] = set()

    def onQueryStarted(self, event) -> None:
        self.dropped.setdefault(str(event.id), 0)

    def onQueryProgress(self, event) -> None:
        late = sum(op.numRowsDroppedByWatermark for op in event.progress.stateOperators)
        self.dropped[str(event.progress.id)] = self.dropped.get(str(event.progress.id), 0) + late

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.ended.add(str(event.id))


def late_rows(query: StreamingQuery) -> int:
    """Rows the watermark dropped in the last 100 batches; ``LateRows`` counts all."""
    return sum(
        op.get("numRowsDroppedByWatermark", 0) for p in query.recentProgress for op in p["stateOperators"])
