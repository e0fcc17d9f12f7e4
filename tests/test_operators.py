"""Windows, closure, events and traced writes on small data with hot keys."""

import random
from datetime import datetime

import pytest
from pyspark.sql import Window, functions as F

from provtrail.operators import events, graph, history
from provtrail.operators.closure import close_edges
from provtrail.operators.recursive import recurse
from provtrail.operators.windows import asof_join, first_per_key, global_rank, ordered_prefix, with_halo
from provtrail.plans import assemble
from provtrail.sources import event_io
from provtrail.sources.traced_io import TraceLog


@pytest.fixture(scope="module")
def hot(spark):
    rng = random.Random(7)
    rows = [(0 if rng.random() < 0.5 else rng.randrange(20), rng.randrange(300), i, rng.randrange(9)) for i in range(1500)]
    return spark.createDataFrame(rows, "k int, t int, i int, v int").withColumn("b", F.expr("t div 25"))


def same(a, b):
    return sorted(map(tuple, a.collect()), key=str) == sorted(map(tuple, b.collect()), key=str)


def test_ordered_prefix_equals_plain_window(hot):
    w = Window.partitionBy("k").orderBy("t", "i")
    want = hot.select("i", F.row_number().over(w).alias("rn"), F.sum("v").over(w).alias("s"))
    got = ordered_prefix(hot, ["k"], "b", ["t", "i"], "rn", {"s": "v"}).select("i", "rn", "s")
    assert same(got, want)


@pytest.mark.parametrize("rows", [1, 2, 5])
def test_halo_equals_plain_window(hot, rows):
    w = Window.partitionBy("k").orderBy("t", "i")
    want = hot.select("i", F.lag("v", rows).over(w).alias("p"), F.sum("v").over(w.rowsBetween(-rows, 0)).alias("s"))
    h = Window.partitionBy("k", "b").orderBy("t", "i")
    got = with_halo(hot, ["k"], "b", ["t", "i"], rows).select(
        "i", F.lag("v", rows).over(h).alias("p"), F.sum("v").over(h.rowsBetween(-rows, 0)).alias("s"), "is_halo",
    ).filter("not is_halo").drop("is_halo")
    assert same(got, want)


def test_first_and_rank(hot):
    w = Window.partitionBy("k").orderBy(F.desc("v"), "i")
    want = hot.withColumn("r", F.row_number().over(w)).filter("r = 1").select("k", "i", "v")
    assert same(first_per_key(hot.select("k", "i", "v"), ["k"], [-F.col("v"), F.col("i")]), want)
    ranked = hot.select("i", F.rank().over(Window.orderBy(F.desc("t"))).alias("rnk"))
    assert same(global_rank(hot, "t").select("i", "rnk"), ranked)


def test_asof_join_against_brute_force(spark, hot):
    right = hot.filter("i % 3 = 0").select("k", F.col("t").alias("rt"), F.col("i").alias("ri"))
    left = hot.filter("i % 3 = 1").select("k", "t", "i")
    pairs = left.join(right, "k").filter("rt <= t")
    want = pairs.groupBy("i").agg(F.max(F.struct("rt", "ri")).alias("m")).select("i", "m.rt", "m.ri")
    got = asof_join(left, right, ["k"], "t", "rt", ["ri"], lambda t: F.floor(t / 25)).select("i", "rt", "ri")
    assert same(got, want)


def test_closure_merges_paths_and_flags(spark):
    rows = [("a", "b", False, False), ("a", "c", False, False), ("b", "d", True, False), ("c", "d", False, False),
            ("d", "e", False, False), ("e", "e", False, True), ("x", "y", True, False)]
    edges = spark.createDataFrame(rows, "src string, dst string, breaks boolean, terminal boolean")
    got = {(r.src, r.dst): r.breaks for r in close_edges(edges, []).collect()}
    # Several paths from a to e: one breaks. x ends nowhere and vanishes.
    assert got == {("a", "e"): True, ("b", "e"): True, ("c", "e"): False, ("d", "e"): False, ("e", "e"): False}


def test_closure_refuses_cycles(spark):
    edges = spark.createDataFrame([("a", "b", False, False), ("b", "a", False, False)],
                                  "src string, dst string, breaks boolean, terminal boolean")
    with pytest.raises(ValueError, match="cycle"):
        close_edges(edges, [])


def test_recursion_ends(spark):
    seed = spark.range(1).select(F.col("id").alias("n"))
    out = recurse(seed, lambda level: level.select((F.col("n") + 1).alias("n")).filter("n < 5"))
    assert sorted(r.n for r in out.collect()) == [0, 1, 2, 3, 4]
    around = recurse(seed, lambda level: level.select(((F.col("n") + 1) % 3).alias("n")), keys=["n"])
    assert sorted(r.n for r in around.collect()) == [0, 1, 2]


def test_closure_of_a_long_path(spark):
    edges = spark.range(600).select(
        F.col("id").alias("src"), (F.col("id") + 1).alias("dst"), (F.col("id") == 599).alias("breaks"),
        (F.col("id") == 599).alias("terminal"))
    assert {(r.dst, r.breaks) for r in close_edges(edges, []).collect()} == {(600, True)}


def test_event_times_are_utc_in_every_zone(spark):
    df = spark.sql("SELECT TIMESTAMP'2024-01-01T00:00:00.000001Z' AS t, TIMESTAMP_NTZ'2024-01-01 00:00:00.000001' AS n")
    rows = spark.sql("SELECT explode(array(1704067200000001, 1730617200000000, -1)) AS us").selectExpr("timestamp_micros(us) AS t")
    try:
        for zone in ("UTC", "America/Los_Angeles", "Asia/Kolkata"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            got = df.select(events.iso_time("t"), events.iso_time("n")).first()
            assert set(got) == {"2024-01-01T00:00:00.000001Z"}
            assert [r[0] for r in rows.select(events.iso_time("t")).collect()] == [
                "2024-01-01T00:00:00.000001Z", "2024-11-03T07:00:00.000000Z", "1969-12-31T23:59:59.999999Z"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_lifecycle_states_and_rejects(spark):
    rows = [("INSERT", "t", None), ("CREATE_VIEW", "v", None), ("RENAME", "t", "u"), ("TRUNCATE", "t", None),
            ("ALTER", "t", None), ("NONSENSE", "t", None)]
    df = spark.createDataFrame([("ns", *r) for r in rows], "namespace string, operation string, name string, new_name string")
    good, bad = events.lifecycle(df)
    got = {(r.operation, r.name): (r.state, r.lifecycle.previousIdentifier) for r in good.collect()}
    assert got[("INSERT", "t")] == ("OVERWRITE", None)
    assert got[("CREATE_VIEW", "v")] == ("CREATE", None)
    assert got[("RENAME", "u")][0] == "RENAME" and got[("RENAME", "u")][1].name == "t"
    assert got[("TRUNCATE", "t")][0] == "TRUNCATE"
    assert [r.operation for r in bad.collect()] == ["NONSENSE"]


def test_run_state_in_any_order_with_duplicates(spark):
    rows = [("r1", "j", "COMPLETE", 5, 10), ("r1", "j", "START", 1, None), ("r1", "j", "START", 1, None),
            ("r2", "j", "START", 2, None), ("r3", "j", "FAIL", 9, None)]
    e = spark.createDataFrame(rows, "run_id string, job_name string, event_type string, event_time int, row_count int")
    got = {r.run_id: (r.started, r.ended, r.state, r.row_count, r.orphan) for r in events.run_state(e).collect()}
    assert got == {"r1": (1, 5, "COMPLETE", 10, False), "r2": (2, None, "START", None, True),
                   "r3": (None, 9, "FAIL", None, False)}
    assert events.latest_state(e).first().event_type == "FAIL"


def test_collapse_views_keeps_direct_reads(spark):
    inputs = spark.createDataFrame([(1, 1, "ns", "t"), (1, 2, "ns", "t"), (1, 3, "ns", "u")],
                                   "query_id int, position int, namespace string, name string")
    reached = spark.createDataFrame([(1, 2, "ns", "v")], "query_id int, position int, view_namespace string, view_name string")
    got = {(r.name, r.dataset_type) for r in graph.collapse_views(inputs, reached).collect()}
    assert got == {("t", "TABLE"), ("u", "TABLE"), ("v", "VIEW")}


def test_traced_writes_and_their_events(spark, tmp_path):
    log = TraceLog(spark, f"{tmp_path}/log")
    spark.createDataFrame([(i, f"n{i}") for i in range(7)], "id int, name string").createOrReplaceTempView("people")
    good = spark.sql("SELECT id, UPPER(name) AS shout FROM people WHERE id > 1")
    assert log.write(good, f"{tmp_path}/out", query="q1")["row_count"] == 5
    log.write(good, f"{tmp_path}/csv", fmt="csv", header=True)
    broken = spark.sql("SELECT id, CAST(raise_error('boom') AS INT) AS x FROM people")
    with pytest.raises(Exception):
        log.write(broken, f"{tmp_path}/bad")
    start, end = assemble.log_events(
        log.plans(), log.runs(), parent=(F.lit("p-1"), F.lit("ns"), F.lit("dag")))
    assert start.count() == end.count() == 3
    path = f"{tmp_path}/events"
    event_io.write_events(start.unionByName(end), path)
    back = event_io.read_events(spark, path)
    assert events.validate_events(back, strict=True)[1].count() == 0
    ends = {r.outputs[0].name.rsplit("/", 1)[1]: r for r in back.filter("eventType <> 'START'").collect()}
    assert ends["out"].outputs[0].outputFacets.outputStatistics.rowCount == 5
    assert ends["out"].inputs == [] and ends["out"].run.facets.processing_engine is None
    assert ends["out"].run.facets.parent.job.name == "dag"
    assert ends["bad"].eventType == "FAIL" and "boom" in ends["bad"].run.facets.errorMessage.message
    assert ends["bad"].outputs[0].outputFacets.outputStatistics is None
    first = {r.outputs[0].name.rsplit("/", 1)[1]: r for r in back.filter("eventType = 'START'").collect()}["out"]
    assert [i.name for i in first.inputs] == ["people"]
    assert [(f.name, f.type) for f in first.inputs[0].facets.schema.fields] == [("id", "int"), ("name", "string")]
    facets = first.outputs[0].facets
    assert facets.lifecycleStateChange.lifecycleStateChange == "OVERWRITE"
    assert facets.columnLineage.fields["shout"].transformationType == "INDIRECT"
    assert first.job.name.startswith("COPY_people_") and first.job.facets.sql.query == "q1"
    assert {r.run.runId for r in start.collect()} == {r.run.runId for r in end.collect()}


def test_excluded_datasets_leave_no_event(spark, tmp_path):
    log = TraceLog(spark, f"{tmp_path}/log")
    spark.createDataFrame([(1,)], "id int").createOrReplaceTempView("tmp_secret")
    log.write(spark.table("tmp_secret"), f"{tmp_path}/out")
    start, _ = assemble.log_events(log.plans(), log.runs(), exclude="tmp_")
    row = start.first()
    assert row.inputs == [] and row.outputs[0].facets.columnLineage is None
    assert assemble.log_events(log.plans(), log.runs(), exclude=f"tmp_, {tmp_path}")[0].count() == 0


def test_catalogs_give_namespaces_and_facets(spark, tmp_path):
    log = TraceLog(spark, f"{tmp_path}/log")
    spark.range(3).write.mode("overwrite").option("path", f"{tmp_path}/src").saveAsTable("catalog_src")
    log.write(spark.sql("SELECT id + 1 AS next FROM catalog_src"), f"{tmp_path}/out")
    catalogs = spark.createDataFrame(
        [("spark_catalog", "lake", "postgres:dbname=m host=h port=1 password=x", False, False, False, "s3://wh/")],
        "name string, kind string, db_path string, in_memory boolean, is_initial boolean, is_read_only boolean, data_path string")
    start, _ = assemble.log_events(log.plans(), log.runs(), catalogs=catalogs)
    row = start.first()
    spark.sql("DROP TABLE catalog_src")
    assert len(row.inputs) == 1, row.inputs
    source = row.inputs[0]
    assert (source.namespace, source.name) == ("s3://wh", "spark_catalog.default.catalog_src")
    assert source.facets.catalog.metadataUri == "postgres://h:1/m" and source.facets.catalog.type == "lake"
    assert source.facets.dataSource.uri == "s3://wh/"
    (field,) = row.outputs[0].facets.columnLineage.fields["next"].inputFields
    assert (field.namespace, field.name, field.field) == (source.namespace, source.name, "id")
    assert row.outputs[0].namespace == "file" and row.outputs[0].facets.catalog is None


def test_statements_are_traced_with_previous_names(spark, tmp_path):
    log = TraceLog(spark, f"{tmp_path}/log")
    made = log.create(spark.range(5).selectExpr("id", "id * 2 AS twice"), "ddl_old", path=f"{tmp_path}/t")
    assert made["row_count"] == 5 and made["size_bytes"] > 0
    assert log.append(spark.range(3).selectExpr("id", "id AS twice"), "ddl_old")["size_bytes"] > 0
    log.rename("ddl_old", "ddl_new")
    log.create_view("ddl_view", "SELECT twice AS x FROM ddl_new")
    with pytest.raises(Exception):
        log.delete("ddl_new", "id = 1")  # Parquet tables cannot
    log.drop("ddl_view", view=True)
    log.drop("ddl_new")
    start, end = assemble.log_events(log.plans(), log.runs())
    rows = {(r.outputs[0].name.rsplit(".", 1)[1], r.outputs[0].facets.lifecycleStateChange.lifecycleStateChange, r.eventType): r.outputs[0].facets
            for r in end.collect()}
    assert set(rows) == {("ddl_old", "CREATE", "COMPLETE"), ("ddl_old", "OVERWRITE", "COMPLETE"), ("ddl_new", "RENAME", "COMPLETE"),
                         ("ddl_view", "CREATE", "COMPLETE"), ("ddl_new", "OVERWRITE", "FAIL"), ("ddl_view", "DROP", "COMPLETE"),
                         ("ddl_new", "DROP", "COMPLETE")}
    renamed = rows["ddl_new", "RENAME", "COMPLETE"]
    assert renamed.lifecycleStateChange.previousIdentifier.name == "spark_catalog.default.ddl_old"
    assert [f.name for f in renamed.schema.fields] == ["id", "twice"] and renamed.columnLineage is None
    (source,) = rows["ddl_view", "CREATE", "COMPLETE"].columnLineage.fields["x"].inputFields
    assert (source.name, source.field) == ("spark_catalog.default.ddl_new", "twice")
    assert rows["ddl_view", "CREATE", "COMPLETE"].datasetType.datasetType == "VIEW"


def test_names_that_change_hands(spark):
    day = lambda n: datetime(2024, 1, n)
    ops = spark.createDataFrame([
        (1, "CREATE_TABLE", "a", None, day(1)), (2, "RENAME", "b", "a", day(2)), (3, "CREATE_TABLE", "a", None, day(3)),
        (4, "RENAME", "c", "b", day(4)), (5, "DROP", "c", None, day(5)), (6, "RENAME", "d", "c", day(6)), (7, "INSERT", "a", None, day(7)),
        (8, "CREATE_TABLE", "a", None, day(8)), (9, "RENAME", "a", "a", day(9)), (10, "CREATE_TABLE", None, None, day(9)),
    ], "op_id long, operation string, name string, previous_name string, event_time timestamp")
    got = {r.op_id: (r.name, r.dataset, r.ended_by, r.renamed_from) for r in history.dataset_spans(ops).collect()}
    assert got == {1: ("a", 1, 2, None), 2: ("b", 1, 4, 1), 3: ("a", 3, 8, None), 4: ("c", 1, 5, 2), 6: ("d", 6, None, None),
                   8: ("a", 8, 9, None), 9: ("a", 8, None, 8)}
    rows = spark.createDataFrame([("a", day(1), 1), ("a", day(2), 50), ("b", day(3), 51), ("c", day(4), 52), ("c", day(7), 53), ("a", day(7), 7)],
                                 "name string, event_time timestamp, op_id long")
    found = {r.op_id: r.dataset for r in history.datasets_at(rows, history.dataset_spans(ops)).collect()}
    assert found == {1: 1, 51: 1, 52: 1, 7: 3}


def test_views_over_time(spark):
    day = lambda n: datetime(2024, 1, n)
    log = spark.createDataFrame([("d1", "CREATE_VIEW", "v", day(2)), ("d2", "CREATE_VIEW", "v", day(4)), ("d3", "DROP_VIEW", "v", day(6)),
                                 ("d4", "CREATE_VIEW", "w", day(1)), ("t", "CREATE_TABLE", "v", day(5))],
                                "query_id string, sink_op string, sink_name string, event_time timestamp")
    reads = spark.createDataFrame([("q1", "v", day(1)), ("q2", "v", day(3)), ("q3", "v", day(4)), ("q4", "v", day(7)), ("q5", "w", day(30))],
                                  "query_id string, view_name string, event_time timestamp")
    got = {r.query_id: r.definition for r in history.definitions_at(reads, history.view_definitions(log)).collect()}
    assert got == {"q2": "d1", "q3": "d2", "q5": "d4"}


def test_edges_in_parts_are_those_of_the_plain_join(spark):
    inputs = spark.createDataFrame([(i % 5, "ns", f"t{i % 3}") for i in range(40)] + [(9, "ns", "t0")], "query_id int, namespace string, name string")
    outputs = spark.createDataFrame([(i % 5, "ns", f"o{i % 2}") for i in range(20)] + [(8, "ns", "o9")], "query_id int, namespace string, name string")
    plain, parts = graph.dataset_edges(inputs, outputs), graph.dataset_edges(inputs, outputs, parts=7)
    assert sorted(plain.collect()) == sorted(parts.collect()) and plain.count() == 6


def test_written_events_are_compressed_and_read_back(spark, tmp_path):
    rows = spark.range(50).select(
        F.col("id").cast("string").alias("run_id"), F.lit("START").alias("event_type"),
        F.lit("2024-01-01 00:00:00").cast("timestamp").alias("event_time"), F.lit("spark").alias("job_namespace"), F.lit("j\u00e9").alias("job_name"))
    event_io.write_events(events.build_events(rows), str(tmp_path / "e"))
    files = [p.name for p in (tmp_path / "e").glob("part-*")]
    assert files and all(f.endswith(".gz") for f in files)
    back = event_io.read_events(spark, str(tmp_path / "e")).select("run.runId", "job.name").collect()
    assert sorted((int(r[0]), r[1]) for r in back) == [(i, "j\u00e9") for i in range(50)]


def test_outcomes_meet_runs_before_events(spark):
    when = "2024-01-01 00:00:00"
    runs = spark.sql(f"""SELECT query_id, run_id, timestamp'{when}' AS event_time, query FROM VALUES
        (1, 'a', 'x'), (1, 'a', 'x'), (2, 'b', 'y'), (3, NULL, 'z'), (4, 'c', NULL), (5, 'b', 'w') AS r(query_id, run_id, query)""")
    ends = spark.sql(f"""SELECT run_id, event_type, timestamp'{when}' AS event_time, rows AS row_count, 7L AS size_bytes, error
        FROM VALUES ('a', 'COMPLETE', 3L, 'no'), ('b', 'FAIL', 4L, 'boom'), ('b', 'COMPLETE', 5L, NULL), (NULL, 'FAIL', 6L, 'lost')
        AS e(run_id, event_type, rows, error)""")
    jobs = runs.select("query_id", F.concat(F.lit("j"), "query_id").alias("job_name")).distinct()
    outputs = jobs.select("query_id", F.lit(0).alias("position"), F.lit("ns").alias("namespace"), F.col("job_name").alias("name"))

    def starts(rows):
        return events.start_events(rows, jobs, outputs, outputs, engine_version="1")

    plain = events.terminal_events(starts(runs), ends)
    early = events.terminal_events(starts(events.with_outcomes(runs, ends)))
    assert early.schema == plain.schema
    assert sorted(map(str, early.collect())) == sorted(map(str, plain.collect())) and plain.count() == 6
