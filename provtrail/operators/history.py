"""Names over time: datasets that are renamed, and views that are defined anew.

A name stands for one dataset from the operation that created or renamed it until the next operation
that drops it, renames it or creates it again. Renames link such spans; closed by pointer doubling they
give every span its dataset, so that a history is one node of the graph whatever its names were.
All lookups by time are as-of joins along (name, time bucket), so a name of very many operations is
spread over tasks and no pairs are formed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from provtrail.operators.closure import close_edges
from provtrail.operators.windows import asof_join
from provtrail.session import materialize

# Operations that begin and end the span of a name.
BEGIN = ("CREATE_TABLE", "CREATE_VIEW", "COPY", "RENAME")
END = ("DROP", "DROP_VIEW")
#: Places in the order of one operation: what it ends comes before what it begins.
_ENDS, _BEGINS = 1, 2


def by_month(at: Column) -> Column:
    """Bucket of a point in time (struct of event_time, op_id, ..)."""
    return F.date_trunc("month", at["event_time"])


def dataset_spans(operations: DataFrame, bucket: Callable[[Column], Column] = by_month) -> DataFrame:
    """Spans of names: op_id (that began it), name, dataset (op_id that began its history), valid_from,
    valid_to and ended_by (op_id; both null while it lasts), renamed_from (op_id of the span before a rename).

    ``operations``: op_id, operation, name, previous_name (of a RENAME), event_time; op_ids are unique and
    order operations of one time. A rename of a name that nothing is known of, or whose dataset is gone,
    begins a history. Operations that neither begin nor end a span play no part, nor do those without a name.
    """
    at = F.struct("event_time", "op_id")

    def events(df: DataFrame, name: str, place: int) -> DataFrame:
        return df.filter(F.col(name).isNotNull()).select(
            "op_id", F.col(name).alias("name"), F.col("operation"), "event_time",
            at.withField("place", F.lit(place)).alias("at"))

    ops = materialize(operations.select("op_id", "operation", "name", "previous_name", "event_time"), "operations")
    begins = events(ops.filter(F.col("operation").isin(*BEGIN)), "name", _BEGINS)
    ends = events(ops.filter(F.col("operation").isin(*END)), "name", _ENDS).unionByName(
        events(ops.filter("operation = 'RENAME'"), "previous_name", _ENDS))
    # Whatever begins or ends a span of a name ends the one before it; the earliest such does.
    line = ends.withColumn("begins", F.lit(False)).unionByName(begins.withColumn("begins", F.lit(True)))
    line = line.withColumn("at", F.col("at").withField("place", F.lit(_ENDS)))
    spans = begins.select("name", F.col("at").alias("began"), F.col("op_id").alias("span"))
    met = materialize(asof_join(line, spans, ["name"], "at", "began", ["span"], bucket), "spans-met")
    over = met.groupBy("span").agg(F.min(F.struct("at", "begins", "op_id", "event_time")).alias("_over"))
    over = over.select(F.col("span").alias("op_id"), F.col("_over.event_time").alias("valid_to"),
                       F.col("_over.op_id").alias("ended_by"), F.col("_over.begins").alias("replaced"))
    spans = begins.select("op_id", "name", "operation", F.col("event_time").alias("valid_from")).join(over, "op_id", "left")
    renamed = spans.filter("not replaced").select(F.col("ended_by").alias("op_id"), F.col("op_id").alias("renamed_from"))
    spans = materialize(spans.join(renamed, "op_id", "left").withColumn(
        "renamed_from", F.when(F.col("operation") == "RENAME", F.col("renamed_from"))), "spans")
    edges = spans.select(
        F.col("op_id").alias("src"), F.coalesce("renamed_from", "op_id").alias("dst"), F.lit(False).alias("breaks"),
        F.col("renamed_from").isNull().alias("terminal"))
    datasets = close_edges(edges, []).select(F.col("src").alias("op_id"), F.col("dst").alias("dataset"))
    return spans.join(datasets, "op_id").select(
        "op_id", "name", "dataset", "valid_from", "valid_to", "ended_by", "renamed_from")


def datasets_at(rows: DataFrame, spans: DataFrame, bucket: Callable[[Column], Column] = by_month) -> DataFrame:
    """``rows`` (name, event_time, op_id and any others) with ``dataset``, the one that the name stood for.

    What an operation itself begins counts, what it ends does not any more. Rows whose name stood for
    nothing known are left out.
    """
    here = rows.withColumn("_at", F.struct("event_time", "op_id"))
    over = F.when(F.col("ended_by").isNotNull(), F.struct(F.col("valid_to").alias("event_time"), F.col("ended_by").alias("op_id")))
    began = spans.select(
        "name", F.struct(F.col("valid_from").alias("event_time"), "op_id").alias("_began"), "dataset", over.alias("_over"))
    found = asof_join(here, began, ["name"], "_at", "_began", ["dataset", "_over"], bucket)
    return found.filter(F.coalesce(F.col("_at") < F.col("_over"), F.lit(True))).select(*rows.columns, "dataset")


def view_definitions(plan_log: DataFrame) -> DataFrame:
    """Statements of a plan log that define or drop a view: view_name, event_time, definition (query_id), dropped."""
    return plan_log.filter(F.col("sink_op").isin("CREATE_VIEW", "DROP_VIEW")).select(
        F.col("sink_name").alias("view_name"), "event_time", F.col("query_id").alias("definition"),
        (F.col("sink_op") == "DROP_VIEW").alias("dropped"))


def definitions_at(
    reads: DataFrame, definitions: DataFrame, bucket: Callable[[Column], Column] = by_month,
) -> DataFrame:
    """The definition that each read of a view saw: query_id, view_name, definition.

    ``reads``: query_id, view_name, event_time. The definition is the last one up to that time (of one
    time the greatest); reads before the first definition or after a drop are left out.
    """
    left = reads.select("query_id", "view_name", F.struct("event_time").alias("_at"))
    right = definitions.select("view_name", F.struct("event_time").alias("_since"), "definition", "dropped")
    found = asof_join(left, right, ["view_name"], "_at", "_since", ["definition", "dropped"], bucket)
    return found.filter(~F.col("dropped")).select("query_id", "view_name", "definition")
