"""Run events of a whole plan log: everything a query's plan tells, as START and end events."""

from __future__ import annotations

from pyspark import __version__ as spark_version
from pyspark.sql import Column, DataFrame, functions as F

from provtrail.functions.ids import classify_catalogs
from provtrail.operators import events, profile
from provtrail.operators.datasets import exclude_datasets
from provtrail.plans import resolve, skeleton
from provtrail.schema import DATASET_FACETS, DEFAULT_NAMESPACE
from provtrail.session import materialize
from provtrail.sources.tables import parts_of, small_side


def log_events(
    plan_log: DataFrame, runs: DataFrame, default_namespace: str = DEFAULT_NAMESPACE, exclude: str = "",
    keep_excluded_sources: bool = False, parent: tuple[Column, Column, Column] | None = None,
    catalogs: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(START events, end events) of the runs of a plan log.

    Plans are resolved once per distinct plan and joined back to their queries; a log with a column
    ``plan_id`` is taken at its word which plans are equal. Utility statements have no events. Excluded
    name prefixes apply to inputs, outputs and, unless kept, column sources. ``parent``:
    run id, job namespace and job name of the run that started these. ``catalogs`` (see
    ``functions.ids.classify_catalogs``) adds namespaces, catalog and source facets.
    """
    if catalogs is not None:
        catalogs = materialize(catalogs, "catalogs")
    # A temporary view may have the name of a catalog: such names are looked up as they are.
    members, plans = resolve.log_skeletons(plan_log, None if catalogs is None else catalogs.select("name"))
    parsed = resolve.parse_log(plans, default_namespace, catalogs)

    # All that is known of a query meets on its id. What is shuffled for that are the rows of the log and of the
    # runs, once; schemas, facets and column lineage are many times as wide and are only put to them afterwards.
    parts = parts_of(runs, 2 << 20)
    keyed = members.repartition(parts, "query_id")

    scans = resolve.plan_inputs(parsed, default_namespace).withColumn("position", F.lit(0))
    schemas = resolve.scan_datasets(parsed).select("plan_id", "namespace", "name", "fields").groupBy(
        "plan_id", "namespace", "name").agg(F.first("fields").alias("fields"))
    described, catalog_facets = _with_catalogs(scans.join(schemas, ["plan_id", "namespace", "name"], "left"), catalogs)
    facets = events.dataset_facets(
        schema=events.schema_facet(F.col("fields")), datasetType=events.type_facet(F.col("dataset_type")), **catalog_facets)
    # Facets have no names in them, so they are made once for a plan and not for each of its queries.
    described = described.select("plan_id", "position", "namespace", "name", facets.cast(DATASET_FACETS).alias("facets"))
    inputs = resolve.at_queries(keyed, described).select(
        "query_id", "position", "namespace", skeleton.filled("name").alias("name"), "facets")
    inputs = exclude_datasets(inputs, exclude)

    sinks = exclude_datasets(resolve.sink_datasets(plan_log, default_namespace), exclude).repartition(parts, "query_id")
    if catalogs is not None:
        sinks = resolve.in_catalogs(sinks, catalogs, default_namespace)
    sinks, catalog_facets = _with_catalogs(sinks, catalogs)
    state = events.lifecycle_state(F.col("operation"))
    outputs = sinks.select("query_id", F.lit(0).alias("position"), "namespace", "name", events.dataset_facets(
        schema=events.schema_facet(F.col("fields")), datasetType=events.type_facet(F.col("dataset_type")),
        lifecycleStateChange=events.lifecycle_facet(state, F.col("prev_namespace"), F.col("prev_name")),
        **catalog_facets).alias("facets"))

    # Column lineage only where there is an output to attach it to.
    per_query = resolve.at_queries(
        keyed.join(sinks.select("query_id"), "query_id", "left_semi"),
        resolve.columns_per_plan(resolve.resolve_plans(plans, default_namespace, parsed)))

    def of_query(column):
        sources = skeleton.filled_sources(column["input_fields"])
        if exclude and not keep_excluded_sources:
            sources = resolve.kept_sources(sources, exclude)
        return column.withField("input_fields", sources)

    per_query = per_query.select("query_id", F.filter(
        F.transform("cols", of_query), lambda c: F.size(c["input_fields"]) > 0).alias("cols"))

    # Utility statements have no lineage, so no events either.
    profiles = profile.drop_utility(profile.profile_plans(profile.plan_log_nodes(parsed.nodes, parsed.scans)))
    shapes = profile.statement_type(profiles)
    jobs = _job_names(plan_log, members, shapes)

    def started(run_rows):
        run_rows = run_rows.repartition(parts, "query_id").join(plan_log.select("query_id", "query"), "query_id")
        start = events.start_events(run_rows, jobs, inputs, outputs, per_query, default_namespace, spark_version)
        return start if parent is None else events.attach_parent(start, *parent)

    run_rows = runs.select("query_id", "run_id", F.col("started").alias("event_time"))
    ends = runs.select("run_id", "event_type", F.col("ended").alias("event_time"), "row_count", "size_bytes", "error")
    # Runs meet their outcomes before they are events.
    return started(run_rows), events.terminal_events(started(events.with_outcomes(run_rows, ends)))


def _with_catalogs(datasets: DataFrame, catalogs: DataFrame | None) -> tuple[DataFrame, dict[str, Column]]:
    """Datasets with their catalog's record, and the facets it gives."""
    if catalogs is None:
        return datasets, {}
    records = classify_catalogs(catalogs).select(
        F.col("name").alias("_catalog"), F.col("data_path").alias("_path"),
        F.struct("framework", "type", "name", "metadata_uri", "warehouse_uri", "source").alias("_record"))
    joined = datasets.withColumn("_catalog", F.substring_index("name", ".", 1)).join(
        small_side(records), "_catalog", "left")
    return joined, {"catalog": events.catalog_facet(F.col("_record")), "dataSource": events.source_facet(F.col("_path"))}


def _job_names(plan_log: DataFrame, keyed: DataFrame, shapes: DataFrame) -> DataFrame:
    """Job names; a query with a sink is named after what it does to the sink."""
    operation = F.col("sink_op")
    sink_table = F.element_at(F.split("sink_name", "[./]"), -1)
    # Texts are hashed before the join, so no plan text is shuffled, and once for START and end events.
    named = materialize(plan_log.select(
        "query_id", profile.short_hash("query", "plan_json").alias("hash8"), "sink_op", "sink_name"), "job-hashes")
    joined = resolve.at_queries(keyed, shapes.withColumnRenamed("query_id", "plan_id")).join(named, "query_id")
    own = F.transform("tables", lambda t: skeleton.filled(t))
    tables = F.slice(F.concat(
        F.when(operation.isin("INSERT", "CREATE_TABLE"), F.array(sink_table)).otherwise(F.array().cast("array<string>")),
        own), 1, profile.MAX_TABLES)
    return joined.select("query_id", profile.job_name(
        F.coalesce(operation, "statement"), tables, F.col("hash8")).alias("job_name"))
