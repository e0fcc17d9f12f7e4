"""Column lineage and dataset inputs of all plans of a plan log at once."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from provtrail.functions.binding import let
from provtrail.functions.ids import namespace_of, parse_prefixes
from provtrail.operators.closure import close_edges
from provtrail.plans import parse, skeleton
from provtrail.schema import DEFAULT_NAMESPACE
from provtrail.session import materialize
from provtrail.sources.tables import small_side


@dataclass
class Parsed:
    """Parsed plans: ``levels`` (one row per subplan), ``nodes`` and ``scans``."""

    levels: DataFrame
    nodes: DataFrame
    scans: DataFrame


# Ids of expressions, common tables and results in a plan text: fresh numbers on each analysis.
# Those of expressions and of common tables may be the same number, so the kind belongs to the token.
ID = r'(?:ExprId",)?"(?:id|cteId|loopId)":\d+'


def plan_key():
    """128-bit fingerprint of the plan and of the files that it names as inputs.

    A plan gets new expression ids and a session id each time it is analyzed, and views the time
    of their registration; ids are numbered by first appearance and the others are left out, so
    that equal queries have one key. Work and memory are bounded by the text of one plan.
    """
    text = F.regexp_replace("plan_json", r'"jvmId":"[^"]*"|"(?:createTime|lastAccessTime)":-?\d+', "")
    found = F.regexp_extract_all(text, F.lit(f"({ID})"), F.lit(1))
    numbers = let(F.array_distinct(found), lambda known: F.transform(
        found, lambda x: F.concat(F.lit("#"), F.array_position(known, x).cast("string"))))
    between = F.split(text, ID)
    plain = F.array_join(F.zip_with(between, numbers, lambda t, n: F.concat(t, F.coalesce(n, F.lit("")))), "")
    return F.md5(F.concat_ws("\u0001", plain, F.to_json("files")))


def keyed_log(plan_log: DataFrame) -> DataFrame:
    """Queries of a plan log and their plans: query_id, plan_id, by fingerprint unless the log has its own."""
    key = F.col("plan_id") if "plan_id" in plan_log.columns else plan_key()
    return plan_log.select("query_id", key.alias("plan_id"))


def distinct_plans(plan_log: DataFrame) -> DataFrame:
    """Each distinct plan once: plan_id, plan_json, files. Scheduled jobs repeat their plans;
    resolving one copy and joining back also removes the skew of a plan that makes up much of the
    log.

    Only keys and query ids are grouped; then the text of one query per key is fetched.
    """
    keyed = keyed_log(plan_log)
    chosen = materialize(keyed.groupBy("plan_id").agg(F.min("query_id").alias("query_id")), "plan-keys")
    texts = plan_log.select("query_id", "plan_json", "files")
    return texts.join(small_side(chosen), "query_id").select("plan_id", "plan_json", "files").dropDuplicates(["plan_id"])


def log_skeletons(plan_log: DataFrame, kept: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Queries of a plan log and what to parse: (query_id, plan_id, names) and (plan_id, plan_json, files).

    A plan is the skeleton of one or more texts here; ``skeleton.filled`` puts a query's names into
    what is found out about it. Each text is read once. Plans with a table of a name in ``kept`` are
    plans of their own.
    """
    if "plan_id" not in plan_log.columns:
        found = skeleton.skeletons(plan_log, ["query_id"], kept, plan_key)
        return found.members.withColumnRenamed("skeleton_id", "plan_id"), found.plans
    found = skeleton.skeletons(distinct_plans(plan_log), ["plan_id"], kept)
    return plan_log.select("query_id", "plan_id").join(found.members, "plan_id").select(
        "query_id", F.col("skeleton_id").alias("plan_id"), "names"), found.plans


def at_queries(keyed: DataFrame, results: DataFrame) -> DataFrame:
    """What a skeleton gives, with ``names``, once per query; small if the log's plans are alike."""
    return keyed.join(small_side(materialize(results, "of-skeletons")), "plan_id").drop("plan_id")


def parse_log(
    plans: DataFrame, default_namespace: str = DEFAULT_NAMESPACE, catalogs: DataFrame | None = None, columns: bool = True,
) -> Parsed:
    """Parse plans once for all the functions below; without ``columns`` for all but ``resolve_plans``.

    ``catalogs`` (name, data_path): scans of tables of a catalog with a data path get that
    path as their namespace, here and so in inputs and column sources alike.
    """
    levels = parse.parse_plans(plans, keep_broken=True, wanted=parse.RESULTS if columns else ("nodes", "scans"))
    nodes = parse.plan_nodes(levels)
    scans = parse.scan_leaves(levels, default_namespace)
    if catalogs is not None:
        scans = scans.withColumns({"namespace": F.col("dataset.namespace"), "name": F.col("dataset.name")})
        scans = in_catalogs(scans, catalogs, default_namespace).withColumn(
            "dataset", F.struct("namespace", "name")).drop("namespace", "name")
    return Parsed(levels, nodes, scans)


def in_catalogs(datasets: DataFrame, catalogs: DataFrame, default_namespace: str) -> DataFrame:
    """Namespaces of datasets from their catalogs' data paths.

    ``datasets`` has namespace and name; the catalog is the first part of the name. Files
    keep their own namespace.
    """
    paths = catalogs.select(F.col("name").alias("_catalog"), F.col("data_path").alias("_path"))
    joined = datasets.withColumn("_catalog", F.substring_index("name", ".", 1)).join(
        small_side(paths), "_catalog", "left")
    return joined.withColumn("namespace", F.when(
        F.col("namespace") == default_namespace, namespace_of("_path", default_namespace)).otherwise(
        F.col("namespace"))).drop("_catalog", "_path")


def resolve_plans(
    plans: DataFrame, default_namespace: str = DEFAULT_NAMESPACE, parsed: Parsed | None = None
) -> DataFrame:
    """Column lineage of distinct plans.

    Returns plan_id, ordinal, out_col, input_fields (sorted array of namespace, name,
    field), transformation_type. Columns without a source and columns that a node of unknown
    column flow has a part in are left out; of outputs with the same name the last one stays.
    """
    parsed = parsed or parse_log(plans, default_namespace)
    by_output = _sources_by_output(parsed)
    last = by_output.groupBy("plan_id", "out_col").agg(
        F.max(F.struct("ordinal", "input_fields", "breaks", "reason")).alias("r"))
    return last.filter("r.reason is null").select(
        "plan_id", F.col("r.ordinal").alias("ordinal"), "out_col", F.col("r.input_fields").alias("input_fields"),
        F.when(F.col("r.breaks"), "INDIRECT").otherwise("DIRECT").alias("transformation_type"))


def _sources_by_output(parsed: Parsed) -> DataFrame:
    """Outputs with a source: plan_id, ordinal, out_col, input_fields, breaks, reason (null unless tainted)."""
    broken = parsed.levels.filter("not readable").select("plan_id").distinct()
    roots = parse.root_columns(parsed.levels).join(broken, "plan_id", "left_anti")
    reach = close_edges(parse.column_edges(parsed.levels), ["plan_id"])
    # An output that only hands a scanned column on ends there; the others follow their paths.
    ends = F.substring("v", 1, 1).isin(parse.LEAF, parse.TAINT)
    direct = roots.filter(ends).withColumn("breaks", F.lit(False))
    traced = roots.join(reach.withColumnRenamed("src", "v"), ["plan_id", "v"]).drop("v").withColumnRenamed("dst", "v")
    tainted = F.when(F.col("v").startswith(parse.TAINT), F.concat(F.lit("untraceable node "), F.split("v", ":")[1]))
    return (
        direct.unionByName(traced)
        .join(parse.leaf_sources(parsed.scans), ["plan_id", "v"], "left")
        .groupBy("plan_id", "ordinal", "out_col")
        .agg(F.sort_array(F.collect_set("source")).alias("input_fields"), F.max("breaks").alias("breaks"),
             F.min(tainted).alias("reason"))
    )


def column_fates(
    plans: DataFrame, default_namespace: str = DEFAULT_NAMESPACE, parsed: Parsed | None = None
) -> DataFrame:
    """What became of every output column: plan_id, ordinal, out_col, fate, reason.

    ``fate`` is ``traced`` (all its sources are known), ``sourceless`` (it has none, such as a constant)
    or ``rejected`` (a node of unknown column flow has a part in it, which ``reason`` names). Each
    output column of each readable plan is one row.
    """
    parsed = parsed or parse_log(plans, default_namespace)
    found = _sources_by_output(parsed).select("plan_id", "ordinal", "reason", F.lit(True).alias("_found"))
    return parse.root_columns(parsed.levels).select("plan_id", "ordinal", "out_col").join(
        found, ["plan_id", "ordinal"], "left").select(
        "plan_id", "ordinal", "out_col",
        F.when(F.col("reason").isNotNull(), "rejected").when(F.col("_found"), "traced").otherwise("sourceless").alias("fate"), "reason")


def columns_per_plan(resolved: DataFrame) -> DataFrame:
    """One row per plan: plan_id, cols. Small to join with a long query log."""
    return resolved.groupBy("plan_id").agg(F.collect_list(
        F.struct("ordinal", "out_col", "input_fields", "transformation_type")).alias("cols"))


def resolve_columns(plan_log: DataFrame, default_namespace: str = DEFAULT_NAMESPACE) -> DataFrame:
    """Column lineage of every query of a plan log: query_id + columns of ``resolve_plans``.

    Plans that could not be traced are in ``rejected_plans`` instead.
    """
    keyed, plans = log_skeletons(plan_log)
    per_plan = columns_per_plan(resolve_plans(plans, default_namespace))
    return at_queries(keyed, per_plan).select("query_id", "names", F.explode("cols").alias("c")).select(
        "query_id", "c.*", "names").withColumn("input_fields", skeleton.filled_sources("input_fields")).drop("names")


def rejected_columns(plan_log: DataFrame, default_namespace: str = DEFAULT_NAMESPACE) -> DataFrame:
    """Output columns that ``resolve_columns`` leaves out because their sources are not all known:
    query_id, ordinal, out_col, reason. The other columns of the same queries are traced."""
    keyed, plans = log_skeletons(plan_log)
    fates = column_fates(plans, default_namespace).filter("fate = 'rejected'")
    return at_queries(keyed, fates).select("query_id", "ordinal", "out_col", "reason")


def rejected_plans(plan_log: DataFrame) -> DataFrame:
    """Queries that were not traced as a whole, with the reason: query_id, reason.

    A plan text, or one embedded in it, is broken; or a node of unknown column flow is in it, of which
    ``rejected_columns`` tells the columns. Each distinct plan is looked at once.
    """
    keyed, plans = log_skeletons(plan_log)
    levels = parse.parse_plans(plans, keep_broken=True, wanted=())
    return at_queries(keyed, rejects_of(levels)).select("query_id", "reason")


def rejects_of(levels: DataFrame) -> DataFrame:
    """Plans with a part that cannot be traced, from their parsed levels: plan_id, reason."""
    reason = F.when(~F.coalesce("readable", F.lit(False)), "malformed plan").when(
        F.col("unknown").isNotNull(), F.concat(F.lit("untraceable node "), F.col("unknown")))
    bad = levels.select("plan_id", "scope", reason.alias("reason")).filter("reason is not null")
    return bad.groupBy("plan_id").agg(F.min_by("reason", "scope").alias("reason"))


def scan_datasets(parsed: Parsed) -> DataFrame:
    """Input datasets of every plan: plan_id, scope, position, namespace, name, fields (name, type)."""
    return parsed.scans.select(
        "plan_id", "scope", F.col("nid").alias("position"),
        F.col("dataset.namespace").alias("namespace"), F.col("dataset.name").alias("name"),
        "fields")


def file_scan_datasets(plan_log: DataFrame) -> DataFrame:
    """Every file a query scanned is its own input: query_id, namespace, name."""
    return (
        plan_log.select("query_id", F.explode("files").alias("f"))
        .select("query_id", F.explode("f.paths").alias("path"))
        .select("query_id", parse.split_path("path").alias("d"))
        .select("query_id", "d.namespace", "d.name").distinct()
    )


def sink_datasets(plan_log: DataFrame, default_namespace: str = DEFAULT_NAMESPACE) -> DataFrame:
    """Output dataset of every query that writes: query_id, namespace, name, operation, dataset_type, fields,
    prev_namespace, prev_name (the last three null where the log has none)."""
    def held(name, kind):
        return F.col(name) if name in plan_log.columns else F.lit(None).cast(kind)

    return plan_log.filter("sink_name is not null").select(
        "query_id", F.coalesce("sink_ns", F.lit(default_namespace)).alias("namespace"), F.col("sink_name").alias("name"),
        F.col("sink_op").alias("operation"),
        F.when(F.col("sink_op").isin("CREATE_VIEW", "DROP_VIEW"), "VIEW").otherwise("TABLE").alias("dataset_type"),
        held("sink_fields", "array<struct<name: string, type: string>>").alias("fields"),
        F.when(held("prev_name", "string").isNotNull(), F.coalesce(held("prev_ns", "string"), F.lit(default_namespace))).alias("prev_namespace"),
        held("prev_name", "string").alias("prev_name"))


def exclude_sources(columns: DataFrame, prefixes) -> DataFrame:
    """Drop excluded datasets from column sources, and columns left without a source."""
    return columns.withColumn("input_fields", kept_sources(F.col("input_fields"), prefixes)).filter(F.size("input_fields") > 0)


def kept_sources(fields: Column, prefixes) -> Column:
    """Column sources without those of excluded datasets."""
    wanted = parse_prefixes(prefixes)

    def keep(source):
        hit = F.lit(False)
        for prefix in wanted:
            hit = hit | source["name"].startswith(prefix)
        return ~hit

    return F.filter(fields, keep)


def with_target_columns(columns: DataFrame, targets: DataFrame, keys: tuple[str, ...] = ("query_id",)) -> DataFrame:
    """Add ``target_col``: the sink's own column at the same position.

    ``targets``: keys + target_cols (array of the sink table's column names).
    """
    return columns.join(targets.select(*keys, "target_cols"), list(keys), "left").withColumn(
        "target_col", F.get("target_cols", F.col("ordinal"))).drop("target_cols")


def view_dependencies(parsed: Parsed) -> DataFrame:
    """Views and the datasets found beneath them: plan_id, view_name, namespace, name.

    A view that only stands for its scan is that dataset and not a view of it.
    """
    views = parsed.nodes.filter(F.col("view_name").isNotNull()).select(
        "plan_id", "scope", F.col("nid").alias("vid"), F.col("size").alias("vsize"), "view_name")
    scans = parsed.scans.select("plan_id", "scope", F.col("nid").alias("position"), "dataset")
    beneath = (
        views.join(scans, ["plan_id", "scope"])
        .filter((F.col("position") > F.col("vid")) & (F.col("position") < F.col("vid") + F.col("vsize")))
        .filter(F.col("view_name") != F.col("dataset.name"))
    )
    # Of nested views the outermost one stands for the scan.
    return beneath.groupBy("plan_id", "scope", "position", "dataset").agg(
        F.min_by("view_name", "vid").alias("view_name")).select(
        "plan_id", "view_name", "scope", "position",
        F.col("dataset.namespace").alias("namespace"), F.col("dataset.name").alias("name"))


def plan_inputs(parsed: Parsed, default_namespace: str = DEFAULT_NAMESPACE) -> DataFrame:
    """Inputs per plan with each view in place of the scans beneath it.

    A table read both directly and through a view stays: only scans beneath a view go. Each
    file of a scan without a name is an input of its own.
    """
    deps = view_dependencies(parsed)
    unnamed = F.col("known_as").isNull() & (F.size("paths") > 0)
    scans = parsed.scans.select("plan_id", "scope", F.col("nid").alias("position"), F.when(
        unnamed, F.transform("paths", parse.split_path)).otherwise(F.array("dataset")).alias("datasets"))
    direct = scans.join(deps, ["plan_id", "scope", "position"], "left_anti").select(
        "plan_id", F.explode("datasets").alias("d")).select("plan_id", "d.namespace", "d.name")
    views = deps.select("plan_id", F.lit(default_namespace).alias("namespace"), F.col("view_name").alias("name"))
    return direct.select("plan_id", "namespace", "name", F.lit("TABLE").alias("dataset_type")).unionByName(
        views.withColumn("dataset_type", F.lit("VIEW"))).distinct()

