"""Streams against their batch twins, late data, orphans."""

import time
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from provtrail.operators import events
from provtrail.streaming import ingest as intake

DDL = "run_id string, job_name string, event_type string, event_time timestamp, row_count int"
T0 = datetime(2024, 1, 1)


def at(hours):
    return T0 + timedelta(hours=hours)


@pytest.fixture
def files(spark, tmp_path):
    def write(batches):
        for i, rows in enumerate(batches):
            spark.createDataFrame(rows, DDL).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in/{i:03d}")
        return spark.readStream.schema(DDL).option("maxFilesPerTrigger", 1).option(
            "recursiveFileLookup", "true").parquet(f"{tmp_path}/in/*")

    return write


def test_partials_merge_to_the_batch_state(spark):
    rows = [(f"r{i % 40}", "j", ("START", "COMPLETE", "FAIL")[i % 3], at(i), i) for i in range(200)]
    e = spark.createDataFrame(rows, DDL)
    parts = [intake.run_partials(e.filter(f"row_count % 7 = {k}")) for k in range(7)]
    merged = parts[0]
    for p in parts[1:]:
        merged = merged.unionByName(p)
    cols = ["run_id", "job_name", "started", "ended", "state", "row_count", "orphan"]
    a = sorted(map(str, intake.merge_partials(merged).select(*cols).collect()))
    assert a == sorted(map(str, events.run_state(e).select(*cols).collect()))


def test_duplicates_go_and_late_rows_are_counted(spark, files, tmp_path):
    stream = files([
        [("r1", "j", "START", at(0), 1), ("r1", "j", "START", at(0), 1)],
        [("r1", "j", "START", at(0), 1), ("r2", "j", "START", at(100), 1)],
        [("r3", "j", "START", at(101), 1)],
        [("late", "j", "START", at(1), 1)],
    ])
    counter = intake.LateRows()
    spark.streams.addListener(counter)
    query = (intake.dedup_stream(stream, "2 hours").writeStream.format("parquet").option("path", f"{tmp_path}/out")
             .option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start())
    query.awaitTermination()
    got = sorted(r.run_id for r in spark.read.parquet(f"{tmp_path}/out").collect())
    assert got == ["r1", "r2", "r3"]
    assert intake.late_rows(query) == 1
    for _ in range(100):
        if str(query.id) in counter.ended:
            break
        time.sleep(0.1)
    spark.streams.removeListener(counter)
    assert counter.dropped == {str(query.id): 1}


def test_stream_join_pairs_and_reports_orphans(spark, files):
    stream = files([
        [("r1", "j", "START", at(0), 1), ("r2", "j", "START", at(0), 1)],
        [("r1", "j", "COMPLETE", at(1), 1)],
        [("r9", "j", "START", at(500), 1), ("r9", "j", "FAIL", at(500), 1)],
        [("r10", "j", "START", at(900), 1), ("r10", "j", "FAIL", at(900), 1)],
    ])
    pairs = intake.run_to_table(intake.pair_stream(
        stream.filter("event_type = 'START'"), stream.filter("event_type <> 'START'"), "2 days"), "pairs")
    got = {r.run_id: r.state for r in pairs.collect()}
    assert got["r1"] == "COMPLETE" and got["r9"] == "FAIL"
    assert "r2" in got and got["r2"] is None


def test_rerun_batch_overwrites_itself(spark, tmp_path):
    df = spark.createDataFrame([(1,)], "x int")
    for _ in range(2):
        intake._into(df, f"{tmp_path}/t", 0)
    assert spark.read.parquet(f"{tmp_path}/t").count() == 1


def test_repeated_deliveries_of_an_intake(spark, sf_dir, tmp_path):
    """Each file delivered twice: the same events and run state as delivered once."""
    from provtrail.registry import _maybe_broken
    from provtrail.sources import event_io

    rows = _maybe_broken(spark, sf_dir).drop("n")
    results = []
    for times in (1, 2):
        root = f"{tmp_path}/{times}"
        for i in range(times):
            event_io.write_events(rows, f"{root}/incoming/{i}")
        tables = intake.IntakeTables(f"{root}/tables")
        stream = spark.readStream.schema(event_io.stream_events(spark, f"{root}/incoming/0", 4).schema).option(
            "recursiveFileLookup", "true").json(f"{root}/incoming")
        intake.ingest(stream, tables, f"{root}/checkpoint", strict=True, availableNow=True).awaitTermination()
        valid = intake.read_valid_events(spark, tables)
        results.append((sorted(map(str, valid.select("eventType", "eventTime", "run.runId").collect())),
                        sorted(map(str, intake.read_run_state(spark, tables).collect()))))
    assert results[0] == results[1] and results[0][0]


def test_late_first_deliveries_are_kept(spark, files, tmp_path):
    """Accepted, late and repeated rows add up to what was delivered."""
    batches = [
        [("r1", "j", "START", at(0), 1), ("r1", "j", "START", at(0), 1)],
        [("r1", "j", "START", at(0), 1), ("r2", "j", "START", at(100), 1)],
        [("r3", "j", "START", at(101), 1), ("r1", "j", "START", at(0), 1)],
        [("late", "j", "START", at(1), 1), ("soon", "j", "START", at(100), 1)],
        [("late", "j", "START", at(1), 1), (None, "j", "START", at(200), 1)],
    ]
    tables = intake.DedupTables(f"{tmp_path}/dedup")
    intake.dedup_keeping_late(files(batches), tables, f"{tmp_path}/cp", "2 hours").awaitTermination()
    rows = spark.read.parquet(tables.first).collect()
    assert {r.run_id for r in rows if r.late} == {"late"}
    assert sorted(str(r.run_id) for r in rows) == ["None", "late", "r1", "r2", "r3", "soon"]
    assert spark.read.parquet(tables.progress).agg({"deliveries": "sum"}).first()[0] == sum(map(len, batches))


def test_compaction_changes_nothing_for_readers(spark, tmp_path):
    rows = [(f"r{i % 30}", "j", ("START", "COMPLETE", "FAIL")[i % 3], at(i), i) for i in range(120)]
    e = spark.createDataFrame(rows, DDL)
    folder = f"{tmp_path}/partials"
    state = lambda: sorted(map(str, intake.merge_partials(intake.read_batches(spark, folder)).collect()))
    for batch in range(3):
        intake._into(intake.run_partials(e.filter(f"row_count % 4 = {batch}")), folder, batch)
    before = state()

    def broken(df):
        return df.withColumn("job_name", F.raise_error(F.lit("lost")))

    with pytest.raises(Exception, match="lost"):
        intake.compact(spark, folder, broken)
    assert state() == before
    intake.compact(spark, folder, intake.merge_summaries)
    assert state() == before and intake._compacted(spark, folder)[0] == 2
    intake._into(intake.run_partials(e.filter("row_count % 4 = 3")), folder, 3)
    whole = sorted(map(str, intake.merge_partials(intake.run_partials(e)).collect()))
    assert state() == whole
    intake.compact(spark, folder, intake.merge_summaries)
    intake.compact(spark, folder, intake.merge_summaries)
    assert state() == whole
