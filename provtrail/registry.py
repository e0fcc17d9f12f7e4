"""Every registered query: name -> callable(spark, sf_dir) -> DataFrame."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from provtrail.functions import ids, naming
from provtrail.operators import datasets, events, graph, history, profile
from provtrail.operators.closure import close_edges
from provtrail.plans import assemble, parse, resolve, skeleton
from provtrail.plans.shapes import shape_queries, waiting_pipeline
from provtrail.plans.traced import traced_plan_log
from provtrail.session import materialize, work_dir
from provtrail.sources import event_io, fixtures as fx
from provtrail.sources.tables import parts_of, register, small_side, table
from provtrail.sources.traced_io import TraceLog
from provtrail.streaming import ingest as intake

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


# -- dataset identity -----------------------------------------------------------------

@query
def i01_normalize_paths(spark, sf_dir):
    return ids.normalize_paths(fx.dataset_paths(spark, sf_dir), "path").select("page_id", "namespace", "name")


@query
def i02_qualified_names(spark, sf_dir):
    rows = fx.datasets(spark, sf_dir)
    return ids.qualify(rows, "catalog", "schema", "table").select("op_id", "name")


@query
def i03_qualified_names_dropping(spark, sf_dir):
    return ids.qualify(fx.datasets(spark, sf_dir), "catalog", "schema", "table", drop_null_catalog=True).select(
        "op_id", "name")


@query
def i04_source_uris(spark, sf_dir):
    return ids.format_source_uri(fx.catalog_paths(spark, sf_dir), "path").select("s_suppkey", "uri")


@query
def i05_metadata_uris(spark, sf_dir):
    return ids.format_metadata_uri(fx.catalog_paths(spark, sf_dir), "path").select("s_suppkey", "uri")


@query
def i06_redacted_connections(spark, sf_dir):
    rows = ids.redact_conn_strings(fx.catalog_paths(spark, sf_dir), "path")
    return rows.select("s_suppkey", ids.is_connection_string("path").alias("is_connection"), "uri")


@query
def i07_table_locations(spark, sf_dir):
    rows = ids.split_table_location(fx.table_locations(spark, sf_dir), "location", "table", "schema")
    return rows.select("p_partkey", "namespace", "name")


@query
def i08_namespaces(spark, sf_dir):
    rows = ids.resolve_namespace(fx.catalog_registry(spark, sf_dir).withColumnRenamed("name", "catalog"), "data_path", "spark")
    return rows.select("catalog", "namespace")


@query
def i09_catalog_types(spark, sf_dir):
    return ids.classify_catalogs(fx.catalog_registry(spark, sf_dir)).select(
        "name", "framework", "type", "metadata_uri", "warehouse_uri")


@query
def i10_excluded_datasets(spark, sf_dir):
    kept = datasets.exclude_datasets(fx.query_inputs(spark, sf_dir), " __meta_ , , lake.s.7")
    return kept.groupBy("name").agg(F.count(F.lit(1)).alias("n"))


@query
def i10_excluded_by_table(spark, sf_dir):
    # Prefixes from data: the datasets of every supplier.
    prefixes = table(spark, sf_dir, "supplier").select(F.concat(F.lit("lake.s."), "s_suppkey").alias("prefix"))
    return datasets.exclude_by_table(fx.query_inputs(spark, sf_dir), prefixes).groupBy("name").agg(
        F.count(F.lit(1)).alias("n"))


@query
def i11_dedup_inputs(spark, sf_dir):
    return datasets.dedup_inputs(fx.query_inputs(spark, sf_dir)).select("query_id", "name", "position")


@query
def i12_drop_empty(spark, sf_dir):
    # Every third query reads nothing, every fifth writes nothing: those without either go.
    e = _start_events(spark, sf_dir, fx.query_inputs(spark, sf_dir).filter("query_id % 3 <> 0"),
                      fx.query_outputs(spark, sf_dir).filter("query_id % 5 <> 0"))
    return e.groupBy("job.name").agg(F.count(F.lit(1)).alias("n")).select(
        F.col("name").alias("job_name"), "n")


# -- column lineage -------------------------------------------------------------------

@query
def c02_c15_c16_merge_columns(spark, sf_dir):
    merged = datasets.merge_columns(fx.column_edges(spark, sf_dir))
    return merged.select(
        "query_id", "out_col", F.col("ordinal").cast("int").alias("ordinal"), "transformation_type",
        F.explode("input_fields").alias("s")).select("query_id", "out_col", "ordinal", "transformation_type", "s.name", "s.field")


@query
def c_closure_of_bindings(spark, sf_dir):
    return close_edges(fx.binding_edges(spark, sf_dir), []).select("src", "breaks")


def _resolved(spark, sf_dir, columns=False):
    """Executions with the skeleton (as plan_id) and names of their plan, and the skeletons parsed."""
    queries, plans = fx.plan_log(spark, sf_dir)
    found = skeleton.skeletons(plans.withColumn("files", F.lit(None).cast(parse.FILES)), ["plan_id"])
    executed = queries.select("query_id", "template", "plan_id").join(found.members, "plan_id").select(
        "query_id", "template", F.col("skeleton_id").alias("plan_id"), "names")
    return executed, found.plans, resolve.parse_log(found.plans, "spark", columns=columns)


@query
def c01_c16_resolve_columns(spark, sf_dir):
    """Columns of every execution in the log: one row per source column."""
    executed, plans, parsed = _resolved(spark, sf_dir, columns=True)
    sources = resolve.resolve_plans(plans, parsed=parsed).select(
        "plan_id", "out_col", "transformation_type", F.explode("input_fields").alias("s"))
    per_plan = sources.groupBy("plan_id").agg(F.collect_list(
        F.struct("out_col", "transformation_type", "s.name", "s.field")).alias("cols"))
    return resolve.at_queries(executed, per_plan).select("query_id", "names", F.explode("cols").alias("c")).select(
        "query_id", "c.out_col", "c.transformation_type", skeleton.filled("c.name").alias("name"), "c.field")


@query
def s01_scan_datasets(spark, sf_dir):
    executed, _, parsed = _resolved(spark, sf_dir)
    scans = resolve.scan_datasets(parsed).select("plan_id", "namespace", "name", F.array_join(
        F.transform("fields", lambda f: F.concat_ws(" ", f["name"], f["type"])), ",").alias("fields")).distinct()
    return resolve.at_queries(executed, scans).select("query_id", "namespace", skeleton.filled("name").alias("name"), "fields")


@query
def s02_file_scan_datasets(spark, sf_dir):
    paths = fx.dataset_paths(spark, sf_dir).select(
        F.expr("page_id div 3").cast("string").alias("query_id"), F.lit(0).alias("leaf"), "path")
    log = paths.groupBy("query_id", "leaf").agg(F.collect_list("path").alias("paths")).select(
        "query_id", F.array(F.struct("leaf", "paths")).alias("files"))
    return resolve.file_scan_datasets(log)


@query
def s07_g03_view_dependencies(spark, sf_dir):
    executed, _, parsed = _resolved(spark, sf_dir)
    deps = resolve.view_dependencies(parsed).select("plan_id", "view_name", "name").distinct()
    return resolve.at_queries(executed, deps).select(
        "query_id", skeleton.filled("view_name").alias("view_name"), skeleton.filled("name").alias("name"))


@query
def s07_create_view(spark, sf_dir):
    """Columns of the views that CREATE VIEW statements define, and their sources."""
    log, _, plans = fx.view_log(spark, sf_dir)
    per_plan = resolve.columns_per_plan(resolve.resolve_plans(plans))
    return log.join(per_plan, "plan_id").select("query_id", F.col("sink_name").alias("view_name"), F.explode("cols").alias("c")).select(
        "query_id", "view_name", "c.out_col", "c.transformation_type", F.explode("c.input_fields").alias("s")).select(
        "query_id", "view_name", "out_col", "transformation_type", "s.name", "s.field")


@query
def s07_views_over_time(spark, sf_dir):
    """What each read of a view read in the end, by the definition that held at its time."""
    log, reads, plans = fx.view_log(spark, sf_dir)
    seen = history.definitions_at(reads, history.view_definitions(log))
    inputs = log.select(F.col("query_id").alias("definition"), "plan_id").join(
        resolve.plan_inputs(resolve.parse_log(plans, columns=False)), "plan_id")
    return seen.join(inputs, "definition").select("query_id", "view_name", "definition", "name")


@query
def g02_g04_plan_inputs(spark, sf_dir):
    executed, _, parsed = _resolved(spark, sf_dir)
    return resolve.at_queries(executed, resolve.plan_inputs(parsed)).select(
        "query_id", "namespace", skeleton.filled("name").alias("name"), "dataset_type")


@query
def j01_j02_traced_statements(spark, sf_dir):
    """Statement type of every execution in the log."""
    executed, _, parsed = _resolved(spark, sf_dir)
    nodes = profile.plan_log_nodes(parsed.nodes, parsed.scans)
    types = profile.statement_type(profile.profile_plans(nodes)).select(F.col("query_id").alias("plan_id"), "statement")
    return resolve.at_queries(executed, types).select("query_id", "statement")


@query
def c17_rejects(spark, sf_dir):
    """Executions of the log whose plan has a node of unknown column flow."""
    executed, _, parsed = _resolved(spark, sf_dir)
    return resolve.at_queries(executed, resolve.rejects_of(parsed.levels)).select("query_id", "reason")


@query
def c17_rejected_columns(spark, sf_dir):
    """Output columns in which a node of unknown column flow has a part."""
    executed, plans, parsed = _resolved(spark, sf_dir, columns=True)
    fates = resolve.column_fates(plans, parsed=parsed).filter("fate = 'rejected'")
    return resolve.at_queries(executed, fates).select("query_id", "out_col", "reason")


@query
def c17_conservation(spark, sf_dir):
    """No column is lost: traced, sourceless and rejected ones are all that the query put out."""
    executed, plans, parsed = _resolved(spark, sf_dir, columns=True)
    n = [F.count_if(F.col("fate") == f).cast("int").alias(f) for f in ("traced", "sourceless", "rejected")]
    per_plan = resolve.column_fates(plans, parsed=parsed).groupBy("plan_id").agg(*n)
    # How many columns there are is what the query's own schema says, not the parsed plan.
    schemas = traced_plan_log(spark, sf_dir).select(F.col("query_id").alias("template"), F.size("sink_fields").alias("columns"))
    executed = executed.join(small_side(materialize(per_plan, "of-skeletons")), "plan_id", "left")
    return executed.join(F.broadcast(schemas), "template").select(
        "query_id", "columns", "traced", "sourceless", "rejected",
        (F.col("traced") + F.col("sourceless") + F.col("rejected") == F.col("columns")).alias("conserved"))


@query
def c_distinct_plans(spark, sf_dir):
    """Each order runs one of three fresh captures of its query: executions and plan keys of each."""
    queries, variants = fx.recaptured_plan_log(spark, sf_dir)
    of = ["template", "variant", "tenant"]
    keyed = skeleton.skeletons(variants, of, canonical=resolve.plan_key).members
    # A tenant's executions of a query meet in one row, with the keys of at most three captures.
    runs = queries.groupBy(*of).agg(F.count(F.lit(1)).alias("n")).join(keyed, of)
    return runs.groupBy("template", "tenant").agg(
        F.sum("n").alias("executions"), F.size(F.collect_set(F.struct("skeleton_id", "names"))).cast("bigint").alias("plans"))


# -- statements and names -------------------------------------------------------------

@query
def j01_profile(spark, sf_dir):
    p = profile.profile_plans(fx.plan_nodes(spark, sf_dir))
    return p.select("query_id", "root", "join_count", "node_count", F.array_join("operators", ",").alias("operators"),
                    F.array_join("tables", ",").alias("tables"))


@query
def j02_j03_statement_type(spark, sf_dir):
    return profile.statement_type(profile.profile_plans(fx.plan_nodes(spark, sf_dir))).select("query_id", "statement")


@query
def j04_sanitized_names(spark, sf_dir):
    return naming.sanitize(fx.dirty_names(spark, sf_dir), "raw").select("id", "part")


@query
def j05_query_hash(spark, sf_dir):
    return naming.query_hash(table(spark, sf_dir, "documents"), "text").select("doc_id", "hash8")


def _texts(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return o.select(F.col("o_orderkey").alias("query_id"),
                    F.when(F.col("o_orderkey") % 7 != 0, F.concat(F.lit("select "), "o_custkey")).alias("query"),
                    F.concat(F.lit("plan "), "o_orderkey").alias("plan_json"))


@query
def j06_job_names(spark, sf_dir):
    return profile.job_names(profile.profile_plans(fx.plan_nodes(spark, sf_dir)), _texts(spark, sf_dir))


@query
def j07_drop_utility(spark, sf_dir):
    return profile.drop_utility(profile.profile_plans(fx.plan_nodes(spark, sf_dir))).select("query_id", "root")


@query
def j08_hash_fallback(spark, sf_dir):
    return naming.query_hash(_texts(spark, sf_dir), "query", "plan_json").select("query_id", "hash8")


# -- runs and facets ------------------------------------------------------------------

def _start_events(spark, sf_dir, inputs=None, outputs=None):
    """START events of one run per order."""
    o = table(spark, sf_dir, "orders")
    runs = o.select(F.col("o_orderkey").alias("query_id"), fx.uuid_of(F.col("o_orderkey")).alias("run_id"),
                    F.col("o_orderdate").alias("event_time"),
                    F.when(F.col("o_orderkey") % 7 != 0, F.concat(F.lit("select "), "o_custkey")).alias("query"))
    jobs = o.select(F.col("o_orderkey").alias("query_id"), F.concat(F.lit("job_"), F.col("o_custkey") % 10).alias("job_name"))
    inputs = fx.query_inputs(spark, sf_dir) if inputs is None else inputs
    outputs = fx.query_outputs(spark, sf_dir) if outputs is None else outputs
    return events.start_events(runs, jobs, inputs, outputs, engine_version="1.0")


def _terminal_events(spark, sf_dir):
    outcomes = table(spark, sf_dir, "orders").select(
        fx.uuid_of(F.col("o_orderkey")).alias("run_id"),
        F.when(F.col("o_orderstatus") == "O", "FAIL").otherwise("COMPLETE").alias("event_type"),
        F.date_add("o_orderdate", 1).cast("timestamp").alias("event_time"), F.col("o_custkey").alias("row_count"),
        (F.col("o_custkey") % 3 * 10).alias("size_bytes"), F.concat(F.lit("bad "), "o_orderpriority").alias("error"))
    return events.terminal_events(_start_events(spark, sf_dir), outcomes)


@query
def r01_start_events(spark, sf_dir):
    e = _start_events(spark, sf_dir)
    return e.select(
        "eventType", "eventTime", F.col("run.runId").alias("run_id"), F.col("job.name").alias("job_name"),
        F.size("inputs").alias("n_inputs"), F.size("outputs").alias("n_outputs"),
        F.array_join(F.transform("inputs", lambda d: d["name"]), ",").alias("input_names"),
        F.get("outputs.name", F.lit(0)).alias("output_name"), F.col("job.facets.sql.query").alias("query"),
        F.col("run.facets.processing_engine.version").alias("engine"))


@query
def r01_log_events(spark, sf_dir):
    """Events of the whole plan log, one run per order: inputs without the nations, a catalog, a parent."""
    log, runs = fx.raw_log(spark, sf_dir)
    catalogs = spark.sql("""SELECT 'lake' AS name, 'lake' AS kind, '/meta.db' AS db_path, false AS in_memory,
        false AS is_initial, false AS is_read_only, 's3://lake/' AS data_path""")
    start, end = assemble.log_events(
        log, runs, exclude="nation_", parent=(F.lit("p-1"), F.lit("scheduler"), F.lit("nightly")), catalogs=catalogs)
    out = F.get("outputs", F.lit(0))
    return start.unionByName(end).select(
        F.col("run.runId").alias("run_id"), F.col("eventType").alias("event_type"), F.size("inputs").alias("n_inputs"),
        out["namespace"].alias("out_namespace"), out["name"].alias("out_name"),
        F.coalesce(F.size(F.map_keys(out["facets"]["columnLineage"]["fields"])), F.lit(0)).alias("n_columns"),
        out["facets"]["catalog"]["type"].alias("catalog_type"), F.col("run.facets.parent.job.name").alias("parent"),
        out["outputFacets"]["outputStatistics"]["rowCount"].alias("row_count"),
        F.col("run.facets.errorMessage.message").alias("error"))


@query
def r02_r05_terminal_events(spark, sf_dir):
    e = _terminal_events(spark, sf_dir)
    stats = F.get("outputs.outputFacets.outputStatistics", F.lit(0))
    return e.select(
        "eventType", "eventTime", F.col("run.runId").alias("run_id"), F.col("job.name").alias("job_name"),
        F.size("inputs").alias("n_inputs"), F.get("outputs.name", F.lit(0)).alias("output_name"),
        stats["rowCount"].alias("row_count"), stats["sizeInBytes"].alias("size_bytes"),
        F.col("run.facets.errorMessage.message").alias("error"), F.col("job.facets.sql.query").alias("query"),
        F.col("run.facets.errorMessage.programmingLanguage").alias("language"),
        F.col("run.facets.processing_engine.version").alias("engine"))


@query
def r06_r08_run_facets(spark, sf_dir):
    """Parent, engine and SQL facets read back from JSON."""
    rows = fx.run_events(spark, sf_dir).withColumn("job_namespace", F.lit("spark")).withColumn(
        "parent_no", F.when(F.col("run_no") % 4 != 0, F.expr("run_no div 10")))
    e = events.build_events(rows)
    ns = F.when(F.col("run_no") % 3 == 0, F.lit("")).otherwise(F.lit("scheduler"))
    parent = F.when(F.col("parent_no").isNotNull(), fx.uuid_of(F.col("parent_no")))
    e = events.attach_parent(e, parent, ns, F.concat(F.lit("dag_"), F.col("parent_no")))
    e = events.attach_engine(e, F.lit("4.1"), F.lit("spark"), F.lit(""))
    e = events.attach_sql(e, "message")
    doc = e.select("run_no", "eventType", event_io.event_json(e.drop("run_no", "parent_no", "row_count", "size_bytes", "message")).alias("j"))

    def at(path):
        return F.get_json_object("j", path)

    return doc.select(
        "run_no", "eventType", at("$.run.facets.parent.run.runId").alias("parent_run"),
        at("$.run.facets.parent.job.name").alias("parent_job"),
        at("$.run.facets.processing_engine.version").alias("engine"),
        at("$.run.facets.processing_engine.openlineageAdapterVersion").alias("adapter"),
        at("$.job.facets.sql.query").alias("query"))


@query
def r09_r12_dataset_facets(spark, sf_dir):
    """Schema, source, catalog and type facets of one dataset per catalog."""
    cat = ids.classify_catalogs(fx.catalog_registry(spark, sf_dir))
    rows = cat.select(
        F.col("name").alias("run_id"), F.lit("START").alias("event_type"), F.lit(None).cast("timestamp").alias("event_time"),
        F.lit("spark").alias("job_namespace"), F.lit("j").alias("job_name"), "db_path",
        F.array(F.struct(F.lit("spark").alias("namespace"), F.col("name"), events.dataset_facets().alias("facets"))).alias("inputs"),
        F.array(F.struct(
            F.lit("spark").alias("namespace"), "name", F.col("db_path").alias("path"),
            F.struct("framework", "type", "name", "metadata_uri", "warehouse_uri", "source").alias("catalog"),
            F.when(F.col("is_initial"), F.array(F.struct(F.lit("id").alias("name"), F.lit("bigint").alias("type")))).otherwise(
                F.array().cast("array<struct<name: string, type: string>>")).alias("fields"),
            F.lit("TABLE").alias("dataset_type"), F.when(F.col("is_read_only"), "parquet").otherwise("").alias("sub_type"),
        )).alias("info"))
    e = events.build_events(rows)
    for attach in (events.attach_schema, events.attach_source, events.attach_catalog, events.attach_type):
        e = attach(e, "info")
    f = F.get("inputs.facets", F.lit(0))
    return e.select(
        F.col("run.runId").alias("name"), F.get(f["schema"]["fields"], F.lit(0))["name"].alias("first_field"),
        f["dataSource"]["uri"].alias("source_uri"), f["catalog"]["type"].alias("catalog_type"),
        f["catalog"]["metadataUri"].alias("metadata_uri"), f["datasetType"]["datasetType"].alias("dataset_type"),
        f["datasetType"]["subType"].alias("sub_type"))


@query
def r13_r14_lifecycle(spark, sf_dir):
    ops = ids.qualify(fx.datasets(spark, sf_dir), "catalog", "schema", "table", True).withColumn(
        "new_name", F.when(F.col("operation") == "RENAME", F.concat("name", F.lit("_new"))))
    good, _ = events.lifecycle(ops)
    return good.select("op_id", "name", F.col("lifecycle.lifecycleStateChange").alias("state"),
                       F.col("lifecycle.previousIdentifier.name").alias("previous_name"))


@query
def r13_lifecycle_rejects(spark, sf_dir):
    ops = ids.qualify(fx.datasets(spark, sf_dir), "catalog", "schema", "table", True).withColumn("new_name", F.lit(None).cast("string"))
    return events.lifecycle(ops)[1].select("op_id", "operation")


@query
def r14_rename_chain(spark, sf_dir):
    """Spans of all names, each with the dataset it stands for through all renames."""
    spans = history.dataset_spans(fx.table_operations(spark, sf_dir))
    return spans.select("op_id", "name", "dataset", events.iso_time("valid_from").alias("valid_from"),
                        events.iso_time("valid_to").alias("valid_to"), "renamed_from")


@query
def r14_datasets_of_inserts(spark, sf_dir):
    """The dataset that each insert went to, whatever its name was then."""
    ops = fx.table_operations(spark, sf_dir)
    inserts = ops.filter("operation = 'INSERT'").select("op_id", "name", "event_time")
    return history.datasets_at(inserts, history.dataset_spans(ops)).select("op_id", "dataset")


@query
def r15_symlinks(spark, sf_dir):
    """Every customer dataset with links to its orders' datasets."""
    links = table(spark, sf_dir, "orders").select(
        F.col("o_custkey"), F.struct(F.lit("hive").alias("namespace"), F.concat(
            F.lit("o"), F.col("o_orderkey") % 5).alias("name"), F.lit("TABLE").alias("type")).alias("link"))
    per = links.groupBy("o_custkey").agg(F.sort_array(F.collect_set("link")).alias("identifiers"))
    rows = per.select(
        F.col("o_custkey").cast("string").alias("run_id"), F.lit("START").alias("event_type"),
        F.lit(None).cast("timestamp").alias("event_time"), F.lit("spark").alias("job_namespace"), F.lit("j").alias("job_name"),
        F.array(F.struct(F.lit("spark").alias("namespace"), F.lit("d").alias("name"), events.dataset_facets().alias("facets"))).alias("inputs"),
        F.array(F.struct(F.lit("spark").alias("namespace"), F.lit("d").alias("name"), "identifiers")).alias("links"))
    e = events.attach_symlinks(events.build_events(rows), "links")
    ident = F.get("inputs.facets.symlinks.identifiers", F.lit(0))
    return e.select(F.col("run.runId").alias("customer"), F.array_join(F.transform(ident, lambda i: i["name"]), ",").alias("links"))


@query
def r16_column_facet(spark, sf_dir):
    """Column lineage facets on outputs, read back from JSON."""
    cols = datasets.merge_columns(fx.column_edges(spark, sf_dir)).groupBy("query_id").agg(F.collect_list(
        F.struct("out_col", "input_fields", "transformation_type")).alias("cols"))
    rows = cols.select(
        F.col("query_id").cast("string").alias("run_id"), F.lit("START").alias("event_type"), "cols",
        F.lit(None).cast("timestamp").alias("event_time"), F.lit("spark").alias("job_namespace"), F.lit("j").alias("job_name"),
        F.array(F.struct(F.lit("spark").alias("namespace"), F.lit("out").alias("name"), events.dataset_facets().alias("facets"),
                         F.lit(None).alias("outputFacets"))).alias("outputs"))
    e = events.attach_columns(events.build_events(rows), "cols").drop("cols")
    back = event_io.events_from_json(event_io.events_to_json(e))
    f = F.get("outputs.facets", F.lit(0))["columnLineage"]["fields"]
    # An inner explode would put a filter on the size of the map below it, which reads the documents once more.
    read = back.select(F.col("run.runId").alias("query_id"), F.explode_outer(f).alias("out_col", "v"))
    return read.filter("out_col is not null").select(
        "query_id", "out_col", F.size("v.inputFields").alias("n_sources"), F.col("v.transformationType").alias("transformation_type"))


def _maybe_broken(spark, sf_dir):
    rows = fx.run_events(spark, sf_dir).withColumn("n", F.col("run_no") * 2 + F.when(F.col("event_type") == "START", 0).otherwise(1))
    rows = rows.withColumns({
        "run_id": F.when(F.col("n") % 17 == 0, F.lit(None)).when(F.col("n") % 29 == 0, "not-a-uuid").otherwise(F.col("run_id")),
        "event_time": F.when(F.col("n") % 19 == 0, F.lit(None)).otherwise(F.col("event_time")),
        "job_namespace": F.lit("spark"),
        "job_name": F.when(F.col("n") % 23 == 0, F.lit(None)).otherwise(F.col("job_name"))})
    return events.build_events(rows).select("n", "eventType", "eventTime", "run", "job", "inputs", "outputs")


@query
def r17_validate(spark, sf_dir):
    return events.with_reason(_maybe_broken(spark, sf_dir), strict=True).select("n", "reason")


@query
def r18_iso_time(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", events.iso_time("ts").alias("event_time"))


@query
def r19_run_state(spark, sf_dir):
    s = events.run_state(fx.run_events(spark, sf_dir, orphans=True))
    return s.select("run_id", "job_name", events.iso_time("started").alias("started"),
                    events.iso_time("ended").alias("ended"), "state", "row_count")


@query
def r19_orphans(spark, sf_dir):
    return events.run_state(fx.run_events(spark, sf_dir, orphans=True)).filter("orphan").select("run_id", "job_name")


@query
def r20_latest_job_state(spark, sf_dir):
    return events.latest_state(fx.run_events(spark, sf_dir)).select("job_name", "event_type", "run_id")


@query
def r20_latest_dataset_state(spark, sf_dir):
    ops = ids.qualify(fx.datasets(spark, sf_dir), "catalog", "schema", "table", True).withColumn("new_name", F.col("name"))
    good, _ = events.lifecycle(ops)
    return events.latest_by(good, ["name"], ["event_time", "op_id"], ["op_id", "state"])


@query
def r20_latest_schema(spark, sf_dir):
    """Latest columns of every customer's dataset, one event per order."""
    fields = F.array(F.struct(F.concat(F.lit("c"), F.col("o_orderkey") % 7).alias("name"), F.lit("bigint").alias("type")))
    rows = table(spark, sf_dir, "orders").select(
        F.lit("COMPLETE").alias("event_type"), F.col("o_orderdate").alias("event_time"),
        F.lpad(F.col("o_orderkey").cast("string"), 12, "0").alias("run_id"), F.lit("spark").alias("job_namespace"),
        F.lit("j").alias("job_name"), F.array(F.struct(
            F.lit("spark").alias("namespace"), F.concat(F.lit("d"), F.col("o_custkey")).alias("name"),
            events.dataset_facets(schema=events.schema_facet(fields)).alias("facets"),
            F.lit(None).alias("outputFacets"))).alias("outputs"))
    return events.latest_schema(events.build_events(rows)).select("name", F.get("fields.name", F.lit(0)).alias("first_field"))


@query
def r21_required_facets(spark, sf_dir):
    """START events and the facets they carry, counted: every event names producer and schema."""
    e = _start_events(spark, sf_dir)
    return e.groupBy("eventType").agg(
        F.count_if(F.col("producer").isNotNull() & F.col("schemaURL").isNotNull()).alias("with_producer"),
        F.count("run.facets.processing_engine").alias("with_engine"), F.count("job.facets.sql").alias("with_sql"))


# -- sources and sinks ----------------------------------------------------------------

@query
def s04_s06_traced_writes(spark, sf_dir):
    """Export, create and append, each traced: rows written per operation."""
    base = f"{work_dir(spark)}/provtrail/traced-{uuid.uuid4().hex}"
    log = TraceLog(spark, f"{base}/log")
    orders, customer = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    name = f"traced_{uuid.uuid4().hex}"
    log.write(orders, f"{base}/export")
    log.create(customer.select("c_custkey", "c_name"), name, path=f"{base}/table")
    log.append(table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("c_custkey"), F.col("s_name").alias("c_name")), name)
    return log.runs().join(log.plans().select("query_id", "sink_op"), "query_id").select(
        "sink_op", "event_type", "row_count", (F.col("size_bytes") > 0).alias("has_bytes"))


@query
def s04_r14_traced_statements(spark, sf_dir):
    """A table that is created, renamed and dropped and a view that is defined anew: states and previous names."""
    log, made = TraceLog(spark, f"{work_dir(spark)}/provtrail/statements-{uuid.uuid4().hex}"), uuid.uuid4().hex
    register(spark, sf_dir, ["orders", "customer"])
    old, new, view = f"old_{made}", f"new_{made}", f"view_{made}"
    log.create(spark.sql("SELECT o_orderkey, upper(o_orderpriority) AS priority FROM orders"), old, path=f"{log.root}/table")
    log.rename(old, new)
    log.create_view(view, f"SELECT o_orderkey AS id FROM {new}")
    log.create_view(view, f"SELECT priority AS id FROM {new}")
    log.drop(view, view=True)
    log.drop(new)
    end = assemble.log_events(log.plans(), log.runs())[1]
    out = F.get("outputs", F.lit(0))
    state = out["facets"]["lifecycleStateChange"]
    own = lambda c: F.regexp_replace(F.element_at(F.split(c, "[.]"), -1), "_[0-9a-f]{32}$", "")
    return end.select(
        "eventType", own(out["name"]).alias("name"), state["lifecycleStateChange"].alias("state"),
        own(state["previousIdentifier"]["name"]).alias("previous"),
        F.array_join(F.array_sort(F.transform(F.flatten(F.transform(
            F.map_values(out["facets"]["columnLineage"]["fields"]), lambda v: v["inputFields"])), lambda f: f["field"])), ",").alias("fields"))


@query
def s04_r01_traced_events(spark, sf_dir):
    """Events of a traced export, assembled from its log: input, output, columns, statistics."""
    base = f"{work_dir(spark)}/provtrail/assembled-{uuid.uuid4().hex}"
    log = TraceLog(spark, f"{base}/log")
    register(spark, sf_dir, ["orders"])
    log.write(spark.sql("SELECT o_custkey AS customer, SUM(o_totalprice) AS total FROM orders GROUP BY o_custkey"),
              f"{base}/export", query="select")
    start, end = assemble.log_events(log.plans(), log.runs())
    stats = F.get("outputs.outputFacets.outputStatistics", F.lit(0))
    columns = F.get("outputs.facets.columnLineage.fields", F.lit(0))
    both = start.unionByName(end)
    return both.select(
        "eventType", F.get("inputs.name", F.lit(0)).alias("input"), stats["rowCount"].alias("row_count"),
        (stats["sizeInBytes"] > 0).alias("has_bytes"),
        columns["total"]["transformationType"].alias("total_type"),
        F.array_join(F.transform(F.get("outputs.facets.schema.fields", F.lit(0)), lambda f: F.concat_ws(" ", f["name"], f["type"])), ",").alias("fields"),
        F.get("outputs.facets.lifecycleStateChange.lifecycleStateChange", F.lit(0)).alias("state"))


@query
def s09_s10_event_round_trip(spark, sf_dir):
    """Events written as JSON files and read back."""
    path = f"{work_dir(spark)}/provtrail/events-{uuid.uuid4().hex}"
    event_io.write_events(_terminal_events(spark, sf_dir), path)
    return event_io.read_events(spark, path).groupBy("eventType", F.col("job.name").alias("job_name")).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.get("outputs.outputFacets.outputStatistics.rowCount", F.lit(0))).alias("row_count"))


# -- dataset graph --------------------------------------------------------------------

@query
def g01_dataset_edges(spark, sf_dir):
    inputs = fx.query_inputs(spark, sf_dir)
    return graph.dataset_edges(inputs, fx.query_outputs(spark, sf_dir), parts=parts_of(inputs, 2 << 20)).select("in_name", "out_name")


@query
def g01_pipeline_edges(spark, sf_dir):
    """The dataset graph of the traced pipeline, from its plan log; run ids taken off the names."""
    log, _ = waiting_pipeline(spark, sf_dir)
    plans = resolve.distinct_plans(log.plans())
    keyed = log.plans().select("query_id", resolve.plan_key().alias("plan_id"))
    inputs = keyed.join(resolve.plan_inputs(resolve.parse_log(plans)), "plan_id")
    edges = graph.dataset_edges(inputs, resolve.sink_datasets(log.plans()))
    return edges.select(*[F.regexp_replace(c, "_[0-9a-f]{32}$", "").alias(c) for c in ("in_name", "out_name")])


@query
def g01_event_edges(spark, sf_dir):
    return graph.event_edges(_start_events(spark, sf_dir)).select("in_name", "out_name")


@query
def g02_collapse_views(spark, sf_dir):
    scans = fx.query_inputs(spark, sf_dir)
    reached = table(spark, sf_dir, "lineitem").filter("l_returnflag = 'R'").select(
        F.col("l_orderkey").alias("query_id"),
        (F.col("l_linenumber") * 1000000 + F.col("l_partkey")).cast("bigint").alias("position"),
        F.lit("spark").alias("view_namespace"), F.concat(F.lit("view_"), F.col("l_suppkey") % 10).alias("view_name")).distinct()
    return graph.collapse_views(scans, reached).select("query_id", "name", "dataset_type")


# -- streaming ------------------------------------------------------------------------

def _event_files(spark, sf_dir, df, label):
    """Events as time-ordered files for a stream to read."""
    path = f"{work_dir(spark)}/provtrail/{label}-{uuid.uuid4().hex}"
    df.repartitionByRange("event_time").write.parquet(path)
    return path


@query
def t01_stream_intake(spark, sf_dir):
    """Valid and rejected events of a stream, counted by reason."""
    root = f"{work_dir(spark)}/provtrail/intake-{uuid.uuid4().hex}"
    event_io.write_events(_maybe_broken(spark, sf_dir).drop("n"), f"{root}/incoming")
    tables = intake.IntakeTables(f"{root}/tables")
    intake.ingest(event_io.stream_events(spark, f"{root}/incoming", 4), tables, f"{root}/checkpoint", strict=True).awaitTermination()
    good = spark.read.parquet(tables.events).select(F.lit("valid").alias("reason"))
    return good.unionByName(spark.read.parquet(tables.rejects).select("reason")).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


@query
def t02_stream_dedup(spark, sf_dir):
    """A stream in which every third event is delivered twice."""
    e = fx.run_events(spark, sf_dir)
    path = _event_files(spark, sf_dir, e.unionByName(e.filter("run_no % 3 = 0")), "twice")
    stream = spark.readStream.schema(e.schema).option("maxFilesPerTrigger", 2).parquet(path)
    return intake.run_to_table(intake.dedup_stream(stream, "40 days"), "dedup").select("run_id", "event_type", "row_count")


@query
def t02_late_deliveries(spark, sf_dir):
    """A stream far out of order in which every third event comes twice, with a delay shorter than the
    data: first deliveries, late ones among them, and repeats by type; nothing is lost."""
    e = fx.run_events(spark, sf_dir).select("run_id", "run_no", "event_type", "event_time", "row_count")
    root = f"{work_dir(spark)}/provtrail/late-{uuid.uuid4().hex}"
    twice = e.unionByName(e.filter("run_no % 3 = 0"))
    twice.repartition(6, "run_no", "row_count").write.parquet(f"{root}/incoming")
    stream = spark.readStream.schema(e.schema).option("maxFilesPerTrigger", 2).parquet(f"{root}/incoming")
    tables = intake.DedupTables(f"{root}/tables")
    intake.dedup_keeping_late(stream, tables, f"{root}/checkpoint", "2 hours").awaitTermination()
    first = spark.read.parquet(tables.first).groupBy("event_type").agg(
        F.count(F.lit(1)).alias("first"), F.count_distinct("run_id").alias("runs"), F.sum("row_count").alias("row_count"))
    taken = twice.groupBy("event_type").agg(F.count(F.lit(1)).alias("deliveries"))
    return first.join(taken, "event_type").select(
        "event_type", "first", "runs", "row_count", (F.col("deliveries") - F.col("first")).alias("repeats"))


@query
def t03_compacted_run_state(spark, sf_dir):
    """Run state of a stream whose batches are merged half-way and again at the end."""
    e = fx.run_events(spark, sf_dir, orphans=True).select("run_id", "job_name", "event_type", "event_time", "row_count")
    folder = f"{work_dir(spark)}/provtrail/compacted-{uuid.uuid4().hex}"
    part = F.pmod(F.xxhash64("run_id", "event_type"), F.lit(4))
    for batch in range(4):
        intake._into(intake.run_partials(e.filter(part == batch)), folder, batch)
        if batch % 2:
            intake.compact(spark, folder, intake.merge_summaries)
    return intake.merge_partials(intake.read_batches(spark, folder)).select(
        "run_id", "job_name", events.iso_time("started").alias("started"), events.iso_time("ended").alias("ended"), "state")


@query
def t03_stream_run_state(spark, sf_dir):
    """Run state from a stream; equals the batch result."""
    e = fx.run_events(spark, sf_dir, orphans=True)
    root = f"{work_dir(spark)}/provtrail/runs-{uuid.uuid4().hex}"
    rows = e.withColumn("job_namespace", F.lit("spark")).withColumn("outputs", F.array(F.struct(
        F.lit("spark").alias("namespace"), F.lit("d").alias("name"), events.dataset_facets().alias("facets"),
        F.lit(None).alias("outputFacets"))))
    event_io.write_events(events.attach_stats(events.build_events(rows), "row_count").drop("run_no", "row_count", "size_bytes", "message"), f"{root}/incoming")
    tables = intake.IntakeTables(f"{root}/tables")
    intake.ingest(event_io.stream_events(spark, f"{root}/incoming", 3), tables, f"{root}/checkpoint").awaitTermination()
    return intake.read_run_state(spark, tables).select(
        "run_id", "job_name", events.iso_time("started").alias("started"), events.iso_time("ended").alias("ended"), "state")


@query
def t04_intake_counters(spark, sf_dir):
    """Events seen and rejected by a stream."""
    root = f"{work_dir(spark)}/provtrail/count-{uuid.uuid4().hex}"
    event_io.write_events(_maybe_broken(spark, sf_dir).drop("n"), f"{root}/incoming")
    tables = intake.IntakeTables(f"{root}/tables")
    intake.ingest(event_io.stream_events(spark, f"{root}/incoming", 4), tables, f"{root}/checkpoint", strict=True).awaitTermination()
    return spark.read.parquet(tables.counters).agg(F.sum("seen").alias("seen"), F.sum("rejected").alias("rejected"))


def all_queries() -> dict[str, Query]:
    return {**QUERIES, **shape_queries()}



