"""Tables of datasets per query: exclusion, deduplication, facets' raw material."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, functions as F

from provtrail.functions.ids import parse_prefixes
from provtrail.sources.tables import small_side


def exclude_datasets(df: DataFrame, prefixes: str | Iterable[str], name: str = "name") -> DataFrame:
    """Leave out datasets whose qualified name starts with one of the prefixes.

    Case-sensitive. An empty list leaves everything in. The same call serves inputs,
    outputs and column sources.
    """
    wanted = parse_prefixes(prefixes)
    if not wanted:
        return df
    hit = F.lit(False)
    for prefix in wanted:
        hit = hit | F.col(name).startswith(prefix)
    return df.filter(~F.coalesce(hit, F.lit(False)))


def exclude_by_table(df: DataFrame, prefixes: DataFrame, name: str = "name") -> DataFrame:
    """As ``exclude_datasets`` with the prefixes in a table (column ``prefix``).

    Distinct names are cut to every length up to that of the longest prefix, which turns the
    starts-with test into an equi-join whose right side is the prefix table.
    """
    clean = prefixes.select(F.trim("prefix").alias("prefix")).filter("prefix <> ''").distinct()
    longest = clean.agg(F.max(F.length("prefix")).alias("n")).first()["n"]
    if not longest:
        return df
    most = F.least(F.length(name), F.lit(longest))
    cuts = F.transform(F.sequence(F.lit(1), most), lambda n: F.substring(F.col(name), F.lit(1), n))
    hits = (
        df.select(name).filter(F.length(name) > 0).distinct().select(name, F.explode(cuts).alias("prefix"))
        .join(small_side(clean), "prefix").select(name).distinct()
    )
    return df.join(hits, name, "left_anti")


def dedup_inputs(df: DataFrame, keys: tuple[str, ...] = ("query_id",), position: str = "position") -> DataFrame:
    """One row per query and (namespace, name): the one at the lowest position.

    An aggregate with map-side combine, so many mentions of a dataset meet no single task.
    """
    group = [*keys, "namespace", "name"]
    rest = [c for c in df.columns if c not in (*group, position)]
    return df.groupBy(*group).agg(
        F.min(position).alias(position), *[F.min_by(c, position).alias(c) for c in rest])


def drop_empty(events: DataFrame) -> DataFrame:
    """Leave out events without any dataset."""
    def count(c):
        return F.coalesce(F.size(c), F.lit(0))

    return events.filter(count("inputs") + count("outputs") > 0)


def merge_columns(edges: DataFrame, keys: tuple[str, ...] = ("query_id",)) -> DataFrame:
    """Merge edge rows into one row per output column.

    ``edges``: keys + out_col, ordinal, namespace, name, field, breaks. Sources are a sorted
    set; a column is DIRECT if no edge breaks it; of outputs with one name the last stays.
    Edges are reduced to distinct sources before they meet per column.
    """
    per_output = edges.groupBy(*keys, "out_col", "ordinal", "namespace", "name", "field").agg(
        F.max("breaks").alias("breaks"))
    # Distinct sources of one name meet in one task, for both steps that follow.
    merged = per_output.repartition(*keys, "out_col").groupBy(*keys, "out_col", "ordinal").agg(
        F.sort_array(F.collect_set(F.struct("namespace", "name", "field"))).alias("input_fields"),
        F.max("breaks").alias("breaks"))
    last = merged.groupBy(*keys, "out_col").agg(
        F.max(F.struct("ordinal", "input_fields", "breaks")).alias("r"))
    return last.select(
        *keys, "out_col", "r.ordinal", "r.input_fields",
        F.when(F.col("r.breaks"), "INDIRECT").otherwise("DIRECT").alias("transformation_type"))
