"""Capture the analyzed plan of a DataFrame as a plan-log row."""

from __future__ import annotations

import json
from collections.abc import Iterator
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession

from provtrail.schema import PLAN_LOG_DDL


def plan_text(df: DataFrame) -> str:
    """JSON text of the analyzed plan. Only this module reaches into the JVM plan."""
    plan = df._jdf.queryExecution().analyzed()
    text = plan.toJSON()
    if '"projections":null' not in text:
        return text
    nodes = json.loads(text)
    _complete(plan, iter(nodes))
    return json.dumps(nodes, separators=(",", ":"), ensure_ascii=False)


def _complete(plan, nodes: Iterator[dict]) -> None:
    """Fill in the projection lists that the text of an Expand lacks, as that of ``df.unpivot`` does.

    ``nodes`` are the text's nodes in pre-order, from that of ``plan`` on; plans embedded in expressions
    lie inside their node, in the order in which the JVM plan gives them.
    """
    node = next(nodes)
    if node["class"].endswith(".Expand") and node.get("projections") is None:
        node["projections"] = [[json.loads(e.toJSON()) for e in _each(p)] for p in _each(plan.projections())]
    for child, text in zip(_each(plan.subqueries()), _embedded(node)):
        _complete(child, iter(text))
    for child in _each(plan.children()):
        _complete(child, nodes)


def _each(seq) -> list:
    return [seq.apply(i) for i in range(seq.size())]


def _embedded(value) -> Iterator[list]:
    """Texts of the plans embedded in a node's expressions."""
    for v in value.values() if isinstance(value, dict) else value if isinstance(value, list) else ():
        if isinstance(value, dict) and v is value.get("plan") and isinstance(v, list):
            yield v
        else:
            yield from _embedded(v)


def scanned_files(df: DataFrame) -> list[tuple[int, list[str]]]:
    """Files behind each scan leaf that no catalog names, by the leaf's place in plan order.

    A table of a catalog goes by its name, so its files are not listed however many they are.
    """
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    out = []
    for i in range(leaves.size()):
        leaf = leaves.apply(i)
        if leaf.getClass().getSimpleName() != "LogicalRelation":
            continue
        if leaf.catalogTable().isDefined():
            continue
        relation = leaf.relation()
        if relation.getClass().getSimpleName() == "HadoopFsRelation":
            out.append((i, [_plain(p) for p in relation.location().inputFiles()]))
    return out


def _plain(path: str) -> str:
    return path if "://" in path else path.removeprefix("file:")


def capture(
    df: DataFrame, query_id: str, query: str | None = None, sink_op: str | None = None,
    sink_ns: str | None = None, sink_name: str | None = None, event_time: datetime | None = None,
    prev_ns: str | None = None, prev_name: str | None = None,
) -> tuple:
    """One plan-log row (see ``PLAN_LOG_DDL``) for the query behind ``df``."""
    when = event_time or datetime.now(timezone.utc)
    fields = [(f.name, f.dataType.simpleString()) for f in df.schema] if sink_op else None
    return (query_id, query, plan_text(df), scanned_files(df), sink_op, sink_ns, sink_name, when, fields, prev_ns, prev_name)


def plan_log(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """A plan log of rows as ``capture`` gives them; what later columns a row lacks is null."""
    return spark.createDataFrame([(*r, *[None] * (11 - len(r))) for r in rows], PLAN_LOG_DDL)
