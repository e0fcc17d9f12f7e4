"""Run events: building, facets, validation, run state.

Events are rows of ``schema.EVENT_DDL``; facets are struct columns, NULL when absent, and
NULLs vanish when events become JSON.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from provtrail.functions.ids import source_uri
from provtrail.operators.datasets import dedup_inputs, drop_empty
from provtrail.operators.profile import lookup
from provtrail.schema import (
    EVENT_SCHEMA_URL, EVENT_TYPES, FACET_SCHEMA_URLS, INPUT_DATASET, JOB_FACETS, OUTPUT_DATASET, PRODUCER,
    RUN_FACETS)


# Legal lifecycle states, and the state each operation leads to.
LIFECYCLE_STATES = ("CREATE", "DROP", "ALTER", "OVERWRITE", "RENAME", "TRUNCATE")
OPERATION_STATES = {
    "INSERT": "OVERWRITE", "UPDATE": "OVERWRITE", "DELETE": "OVERWRITE", "COPY": "OVERWRITE",
    "CREATE_TABLE": "CREATE", "CREATE_VIEW": "CREATE", "DROP": "DROP", "DROP_VIEW": "DROP",
    "RENAME": "RENAME", "ALTER": "ALTER",
}
# The forms of run ids and event times.
UUID_PATTERN = "^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$"
ISO_PATTERN = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d+)?Z$"


def iso_time(ts: Column | str) -> Column:
    """ISO-8601 UTC text with microseconds and a trailing ``Z``, in every session time zone.

    Times with a zone are converted to UTC; times without one (TIMESTAMP_NTZ) are UTC already.
    """
    ts = F.col(ts) if isinstance(ts, str) else ts
    seconds = (F.unix_micros(ts.cast("timestamp")).cast("decimal(24,0)") / 1_000_000).cast("decimal(18,6)")
    zero = F.lit(0)
    utc = F.when(F.typeof(ts) == "timestamp_ntz", ts.cast("timestamp_ntz")).otherwise(
        F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'") + F.make_dt_interval(zero, zero, zero, seconds))
    return F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def facet(kind: str, **fields: Column) -> Column:
    """A facet struct with its producer and schema URL."""
    return F.struct(
        F.lit(PRODUCER).alias("_producer"), F.lit(FACET_SCHEMA_URLS[kind]).alias("_schemaURL"),
        *[c.alias(n) for n, c in fields.items()])


def null_if_empty(c: Column | str) -> Column:
    return F.nullif(F.col(c) if isinstance(c, str) else c, F.lit(""))


# -- facets as columns ---------------------------------------------------------------

def sql_facet(query: Column) -> Column:
    return F.when(query.isNotNull(), facet("sql", query=query))


def parent_facet(run_id: Column, namespace: Column, name: Column) -> Column:
    """Job part only if both its namespace and name are given."""
    ns, nm = null_if_empty(namespace), null_if_empty(name)
    job = F.when(ns.isNotNull() & nm.isNotNull(), F.struct(ns.alias("namespace"), nm.alias("name")))
    return F.when(null_if_empty(run_id).isNotNull(), facet("parent", run=F.struct(run_id.alias("runId")), job=job))


def error_facet(event_type: Column, message: Column) -> Column:
    return F.when(event_type == "FAIL", facet(
        "errorMessage", message=message, programmingLanguage=F.lit("SQL")))


def engine_facet(version: Column, name: Column | None = None, adapter: Column | None = None) -> Column:
    empty = F.lit(None).cast("string")
    return facet("processing_engine", version=version,
                 name=empty if name is None else null_if_empty(name),
                 openlineageAdapterVersion=empty if adapter is None else null_if_empty(adapter))


def schema_facet(fields: Column) -> Column:
    return F.when(F.size(fields) > 0, facet("schema", fields=fields))


def source_facet(path: Column) -> Column:
    return F.when(null_if_empty(path).isNotNull(), facet("dataSource", name=source_uri(path), uri=source_uri(path)))


def catalog_facet(catalog: Column) -> Column:
    """From a catalog record (see ``classify_catalogs``); empty optionals become NULL."""
    return F.when(catalog.isNotNull(), facet(
        "catalog", framework=catalog["framework"], type=catalog["type"], name=catalog["name"],
        metadataUri=null_if_empty(catalog["metadata_uri"]), warehouseUri=null_if_empty(catalog["warehouse_uri"]),
        source=null_if_empty(catalog["source"])))


def type_facet(dataset_type: Column, sub_type: Column | None = None) -> Column:
    sub = F.lit(None).cast("string") if sub_type is None else null_if_empty(sub_type)
    return F.when(dataset_type.isNotNull(), facet("datasetType", datasetType=dataset_type, subType=sub))


def lifecycle_state(operation: Column) -> Column:
    """State an operation leads to; an operation that is itself a legal state stays."""
    return F.coalesce(lookup(OPERATION_STATES, operation), F.when(operation.isin(*LIFECYCLE_STATES), operation))


def lifecycle_facet(state: Column, prev_namespace: Column, prev_name: Column) -> Column:
    previous = F.when(
        (state == "RENAME") & null_if_empty(prev_namespace).isNotNull() & null_if_empty(prev_name).isNotNull(),
        F.struct(prev_namespace.alias("namespace"), prev_name.alias("name")))
    return F.when(state.isNotNull(), facet(
        "lifecycleStateChange", lifecycleStateChange=state, previousIdentifier=previous))


def symlinks_facet(identifiers: Column) -> Column:
    return F.when(F.size(identifiers) > 0, facet("symlinks", identifiers=identifiers))


def columns_facet(entries: Column) -> Column:
    """From an array of (out_col, input_fields, transformation_type)."""
    fields = F.map_from_entries(F.transform(entries, lambda e: F.struct(e["out_col"], F.struct(
        e["input_fields"].alias("inputFields"), e["transformation_type"].alias("transformationType")))))
    return F.when(F.size(entries) > 0, facet("columnLineage", fields=fields))


def statistics_facet(event_type: Column, rows: Column, size: Column) -> Column:
    return F.when((event_type != "FAIL") & rows.isNotNull(), facet(
        "outputStatistics", rowCount=rows, sizeInBytes=F.when(size > 0, size)))


def dataset_facets(**parts: Column) -> Column:
    """Facets struct of a dataset, with NULL for every facet not given."""
    names = ("schema", "dataSource", "catalog", "datasetType", "lifecycleStateChange", "symlinks", "columnLineage")
    unknown = set(parts) - set(names)
    if unknown:
        raise ValueError(f"unknown dataset facets: {sorted(unknown)}")
    return F.struct(*[parts.get(n, F.lit(None)).alias(n) for n in names])


# -- facets attached to event rows ----------------------------------------------------

def _set(df: DataFrame, column: str, path: str, value: Column) -> DataFrame:
    typed = df.schema[column].dataType
    for part in path.split("."):
        typed = typed[part].dataType
    return df.withColumn(column, F.col(column).withField(path, value.cast(typed)))


def attach_sql(events: DataFrame, query: str) -> DataFrame:
    return _set(events, "job", "facets.sql", sql_facet(F.col(query)))


def attach_parent(events: DataFrame, run_id: Column, namespace: Column, name: Column) -> DataFrame:
    """From literals (one parent for all) or columns joined from a parent-run table."""
    return _set(events, "run", "facets.parent", parent_facet(run_id, namespace, name))


def attach_error(events: DataFrame, message: str) -> DataFrame:
    return _set(events, "run", "facets.errorMessage", error_facet(F.col("eventType"), F.col(message)))


def attach_engine(events: DataFrame, version: Column, name: Column | None = None, adapter: Column | None = None) -> DataFrame:
    """Only START events carry the engine."""
    return _set(events, "run", "facets.processing_engine", F.when(
        F.col("eventType") == "START", engine_facet(version, name, adapter)))


def attach_stats(events: DataFrame, rows: str, size: str | None = None) -> DataFrame:
    """Row count and size on every output; never on FAIL."""
    stats = statistics_facet(F.col("eventType"), F.col(rows), F.col(size) if size else F.lit(None).cast("bigint"))
    typed = events.schema["outputs"].dataType.elementType["outputFacets"].dataType
    return events.withColumn("outputs", F.transform("outputs", lambda o: o.withField(
        "outputFacets", F.struct(stats.alias("outputStatistics")).cast(typed))))


def _attach_dataset(events: DataFrame, side: str, name: str, value) -> DataFrame:
    """Set facet ``name`` on each dataset of ``side``; ``value`` maps a dataset to its facet."""
    typed = events.schema[side].dataType.elementType["facets"].dataType[name].dataType
    return events.withColumn(side, F.transform(side, lambda d: d.withField(f"facets.{name}", value(d).cast(typed))))


def _by_key(values: str, field: str):
    """Look up a dataset's entry in an array column of (namespace, name, value...)."""
    return lambda d: F.get(F.filter(values, lambda v: (v["namespace"] == d["namespace"]) & (
        v["name"] == d["name"])), F.lit(0))[field]


def attach_schema(events: DataFrame, schemas: str, side: str = "inputs") -> DataFrame:
    """``schemas``: array column of (namespace, name, fields)."""
    return _attach_dataset(events, side, "schema", lambda d: schema_facet(_by_key(schemas, "fields")(d)))


def attach_source(events: DataFrame, paths: str, side: str = "inputs") -> DataFrame:
    """``paths``: array column of (namespace, name, path)."""
    return _attach_dataset(events, side, "dataSource", lambda d: source_facet(_by_key(paths, "path")(d)))


def attach_catalog(events: DataFrame, catalogs: str, side: str = "inputs") -> DataFrame:
    """``catalogs``: array column of (namespace, name, catalog record)."""
    return _attach_dataset(events, side, "catalog", lambda d: catalog_facet(_by_key(catalogs, "catalog")(d)))


def attach_type(events: DataFrame, types: str, side: str = "inputs") -> DataFrame:
    """``types``: array column of (namespace, name, dataset_type, sub_type)."""
    return _attach_dataset(events, side, "datasetType", lambda d: type_facet(
        _by_key(types, "dataset_type")(d), _by_key(types, "sub_type")(d)))


def attach_symlinks(events: DataFrame, links: str, side: str = "inputs") -> DataFrame:
    """``links``: array column of (namespace, name, identifiers)."""
    return _attach_dataset(events, side, "symlinks", lambda d: symlinks_facet(_by_key(links, "identifiers")(d)))


def attach_columns(events: DataFrame, entries: str) -> DataFrame:
    """Column lineage on every output. ``entries``: array of (out_col, input_fields, transformation_type)."""
    return _attach_dataset(events, "outputs", "columnLineage", lambda d: columns_facet(F.col(entries)))


def lifecycle(outputs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Add ``state`` and ``lifecycle`` to rows with an ``operation``; second: rejected rows.

    Columns: operation, namespace, name, new_name (for RENAME), passed through. A rename is
    reported on the new name, with the old one as the previous identifier.
    """
    renamed = F.col("operation") == "RENAME"
    rows = outputs.withColumn("state", lifecycle_state(F.col("operation")))
    good = rows.filter("state is not null").select(
        *[c for c in outputs.columns if c not in ("name", "new_name")], "state",
        F.when(renamed, F.col("new_name")).otherwise(F.col("name")).alias("name"),
        F.when(renamed, F.col("name")).alias("previous_name"))
    good = good.withColumn("lifecycle", lifecycle_facet(F.col("state"), F.col("namespace"), F.col("previous_name")))
    return good, rows.filter("state is null").drop("state")


# -- building -------------------------------------------------------------------------

def build_events(rows: DataFrame) -> DataFrame:
    """Event rows from flat columns.

    Columns: event_type, event_time (timestamp), run_id, job_namespace, job_name, inputs and
    outputs (arrays of datasets; missing facets are filled with NULL); others pass through.
    """
    def typed(name, ddl):
        if name in rows.columns:
            return F.col(name).cast(f"array<{ddl}>")
        return F.array().cast(f"array<{ddl}>")

    core = {"event_type", "event_time", "run_id", "job_namespace", "job_name", "inputs", "outputs"}
    others = [c for c in rows.columns if c not in core]
    run_facets = F.struct(*[F.lit(None).alias(f"f{i}") for i in range(3)]).cast(RUN_FACETS)
    job_facets = F.struct(F.lit(None).alias("sql")).cast(JOB_FACETS)
    return rows.select(
        F.col("event_type").alias("eventType"), iso_time("event_time").alias("eventTime"),
        F.lit(PRODUCER).alias("producer"), F.lit(EVENT_SCHEMA_URL).alias("schemaURL"),
        F.struct(F.col("run_id").alias("runId"), run_facets.alias("facets")).alias("run"),
        F.struct(F.col("job_namespace").alias("namespace"), F.col("job_name").alias("name"),
                 job_facets.alias("facets")).alias("job"),
        typed("inputs", INPUT_DATASET).alias("inputs"), typed("outputs", OUTPUT_DATASET).alias("outputs"), *others)


def start_events(
    runs: DataFrame, jobs: DataFrame, inputs: DataFrame, outputs: DataFrame, columns: DataFrame | None = None,
    job_namespace: str = "spark", engine_version: str | None = None,
) -> DataFrame:
    """START events of all runs at once.

    ``runs``: query_id, run_id, event_time, query. ``jobs``: query_id, job_name. ``inputs``
    and ``outputs``: query_id, position, namespace, name, optionally facets. ``columns``:
    query_id, out_col, input_fields, transformation_type, or these as an array ``cols``. Dataset lists are built per query,
    bounded by its plan. Queries without a dataset give no event.
    """
    def listed(df, out):
        ddl = INPUT_DATASET if out == "inputs" else OUTPUT_DATASET
        facets = F.col("facets") if "facets" in df.columns else dataset_facets()
        extra = () if out == "inputs" else (F.lit(None).alias("outputFacets"),)
        dataset = F.struct("namespace", "name", facets.alias("facets"), *extra).cast(ddl)
        # Facets hold maps, which do not sort, so the comparison names what does.
        by_position = F.array_sort(
            F.collect_list(F.struct("position", dataset.alias("d"))),
            lambda a, b: F.when(a["position"] < b["position"], -1).when(a["position"] > b["position"], 1)
            .when(a["d"]["name"] < b["d"]["name"], -1).when(a["d"]["name"] > b["d"]["name"], 1).otherwise(0))
        return df.groupBy("query_id").agg(by_position.alias("_l")).select(
            "query_id", F.transform("_l", lambda x: x["d"]).alias(out))

    base = runs.join(jobs.select("query_id", "job_name"), "query_id").join(
        listed(dedup_inputs(inputs), "inputs"), "query_id", "left").join(
        listed(outputs, "outputs"), "query_id", "left")
    if columns is not None:
        if "cols" not in columns.columns:
            columns = columns.groupBy("query_id").agg(F.collect_list(F.struct(
                "out_col", "input_fields", "transformation_type")).alias("cols"))
        per_query = columns.select("query_id", F.col("cols").alias("_cols"))
        base = base.join(per_query, "query_id", "left")
    base = base.withColumns({
        "event_type": F.lit("START"), "job_namespace": F.lit(job_namespace),
        "inputs": F.coalesce("inputs", F.array().cast(f"array<{INPUT_DATASET}>")),
        "outputs": F.coalesce("outputs", F.array().cast(f"array<{OUTPUT_DATASET}>")),
    })
    events = drop_empty(attach_sql(build_events(base), "query"))
    if columns is not None:
        events = attach_columns(events, "_cols").drop("_cols")
    if engine_version is not None:
        events = attach_engine(events, F.lit(engine_version), F.lit("spark"))
    return events.drop("query_id", "query")


def with_outcomes(rows: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Rows with a ``run_id`` joined with the outcomes (see ``terminal_events``) of their runs."""
    return rows.join(outcomes.select(
        "run_id", F.col("event_type").alias("_type"), F.col("event_time").alias("_time"), "row_count", "size_bytes", "error"), "run_id")


def terminal_events(starts: DataFrame, outcomes: DataFrame | None = None) -> DataFrame:
    """COMPLETE and FAIL events: the run, job, parent, SQL and outputs of their START.

    ``outcomes``: run_id, event_type, event_time, row_count, size_bytes, error. Inputs and
    the engine stay with START. The join is on the run, whose rows are few and even. Without
    ``outcomes``, ``starts`` were made of runs ``with_outcomes``: no event is shuffled for that join.
    """
    joined = starts.filter("eventType = 'START'")
    if outcomes is not None:
        joined = with_outcomes(joined.withColumn("run_id", F.col("run.runId")), outcomes)
    out = joined.withColumns({
        "eventType": F.col("_type"), "eventTime": iso_time("_time"),
        "run": F.col("run").withField("facets.processing_engine", F.lit(None).cast(
            joined.schema["run"].dataType["facets"].dataType["processing_engine"].dataType)),
        "inputs": F.array().cast(joined.schema["inputs"].dataType),
    })
    out = attach_error(attach_stats(out, "row_count", "size_bytes"), "error")
    own = starts.columns if outcomes is not None else [
        c for c in starts.columns if c not in ("_type", "_time", "row_count", "size_bytes", "error")]
    return out.select(*own)


# -- checking and state ---------------------------------------------------------------

def validity(event_type: Column, run_id: Column, event_time: Column, job_namespace: Column, job_name: Column,
             strict: bool = False) -> Column:
    """Reason an event is invalid, or NULL. Run id, event time and job are required."""
    reason = (
        F.when(run_id.isNull(), "runId is required")
        .when(event_time.isNull(), "eventTime is required")
        .when(job_namespace.isNull() | job_name.isNull(), "job is required")
        .when(event_type.isNull() | ~event_type.isin(*EVENT_TYPES), "unknown eventType")
    )
    if strict:
        reason = reason.when(~run_id.rlike(UUID_PATTERN), "runId is not a UUID").when(
            ~event_time.rlike(ISO_PATTERN), "eventTime is not ISO-8601 UTC")
    return reason


def with_reason(events: DataFrame, strict: bool = False) -> DataFrame:
    return events.withColumn("reason", validity(
        F.col("eventType"), F.col("run.runId"), F.col("eventTime"), F.col("job.namespace"), F.col("job.name"), strict))


def validate_events(events: DataFrame, strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """Valid events, and rejects with a ``reason``."""
    checked = with_reason(events, strict)
    return checked.filter("reason is null").drop("reason"), checked.filter("reason is not null")


def run_state(events: DataFrame) -> DataFrame:
    """State of every run: run_id, job_name, started, ended, state, row_count, orphan.

    ``events``: run_id, job_name, event_type, event_time, row_count. One aggregation with
    map-side combine pairs START with its end in any order and ignores duplicates. The
    last end counts; a run without an end is an orphan, state START.
    """
    end = F.col("event_type").isin("COMPLETE", "FAIL")
    at_end = F.when(end, F.struct("event_time", "event_type", "row_count"))
    return (
        events.groupBy("run_id")
        .agg(
            F.max("job_name").alias("job_name"),
            F.min(F.when(F.col("event_type") == "START", F.col("event_time"))).alias("started"),
            F.max(at_end).alias("_e"),
        )
        .select(
            "run_id", "job_name", "started", F.col("_e.event_time").alias("ended"),
            F.coalesce("_e.event_type", F.lit("START")).alias("state"), F.col("_e.row_count").alias("row_count"),
            F.col("_e").isNull().alias("orphan"))
    )


def latest_by(df: DataFrame, keys: list[str], order: list[str], values: list[str]) -> DataFrame:
    """The values of the row that comes last by ``order`` for each key.

    max over a struct: partial aggregates shrink a hot key before the shuffle.
    """
    rest = [v for v in values if v not in order]
    return df.groupBy(*keys).agg(F.max(F.struct(*order, *rest)).alias("_m")).select(
        *keys, *[F.col(f"_m.{v}").alias(v) for v in values])


def latest_state(events: DataFrame) -> DataFrame:
    """Latest state of every job: job_name, event_time, event_type, run_id."""
    return latest_by(events, ["job_name"], ["event_time", "run_id", "event_type"],
                     ["event_time", "run_id", "event_type"])


def latest_schema(events: DataFrame) -> DataFrame:
    """Latest known columns of every output dataset: namespace, name, fields."""
    seen = events.select("eventTime", F.col("run.runId").alias("run_id"), F.explode("outputs").alias("o")).select(
        "eventTime", "run_id", "o.namespace", "o.name", F.col("o.facets.schema.fields").alias("fields"))
    return latest_by(seen.filter("fields is not null"), ["namespace", "name"], ["eventTime", "run_id"], ["fields"])
