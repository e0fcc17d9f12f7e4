"""Physical plans: what has to hold at any scale."""

import contextlib
import io
import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_module
from provtrail.operators import events, profile
from provtrail.plans import parse
from provtrail.plans.traced import traced_names
from provtrail.session import work_dir
from provtrail.sources import fixtures as fx
from provtrail.sources.tables import parts_of, table

QUERIES = entry_module.queries()


def explained(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


@pytest.mark.parametrize("name", [n for n in QUERIES if n[0] in "qijrg" and n not in (
    "q09_cross_join", "q38_multi_layer", "q28_recursive", "g02_g04_plan_inputs", "j01_j02_traced_statements")])
def test_no_products_and_no_python(name, spark, sf_dir):
    plan = explained(QUERIES[name](spark, sf_dir))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEvalPython", "MapInPandas"):
        assert bad not in plan


def test_filters_and_columns_reach_the_scan(spark, sf_dir):
    plan = explained(QUERIES["q04_filter"](spark, sf_dir))
    assert "GreaterThan(o_totalprice,100000.0)" in plan and "EqualTo(o_orderstatus,F)" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string,o_totalprice:double>" in plan


def test_parsing_needs_no_shuffle(spark):
    plans = spark.createDataFrame([("p", "[]")], "plan_id string, plan_json string").select(
        "plan_id", F.lit("0").alias("scope"), "plan_json", F.lit(None).cast(parse.FILES).alias("files"),
        F.lit(None).cast(parse.INNER).alias("inner"))
    assert "Exchange" not in explained(parse._parse(plans))
    # What only nodes and scans are wanted of binds no columns.
    assert "breaks" in explained(parse._parse(plans)) and "breaks" not in explained(parse._parse(plans, ("nodes", "scans")))


def test_run_state_is_one_shuffle_with_partial_aggregation(spark, sf_dir):
    plan = explained(events.run_state(fx.run_events(spark, sf_dir)))
    assert plan.split("== Initial Plan ==")[-1].count("Exchange (") == 1
    assert "partial_min" in plan and "partial_max" in plan


def test_profile_spreads_a_query_over_salts(spark):
    rows = [(1, 0, None, "PROJECTION", None)] + [(1, i, 0 if i == 1 else 1, "GET", f"t{i}") for i in range(1, 2000)]
    nodes = spark.createDataFrame(rows, "query_id int, node_id int, parent_id int, operator string, table_name string")
    got = profile.profile_plans(nodes).first()
    assert (got.root, got.child_types, got.node_count, got.tables) == ("PROJECTION", ["GET"], 2000, ["t1", "t2", "t3"])


def test_column_facets_are_read_from_json_once(spark, sf_dir):
    # A filter derived from an inner explode would read each document twice more.
    plan = QUERIES["r16_column_facet"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json(") == 1


def test_texts_are_shuffled_and_not_their_words(spark, sf_dir):
    plan = QUERIES["q25_window_unnest"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    # Lines go from the result down to the scan: the only shuffle lies below the words' Generate.
    assert plan.count("Exchange") == 1 and plan.rindex("Generate explode(split(") < plan.index("Exchange hashpartitioning(doc_id")


def test_edges_meet_in_parts_that_do_not_grow(spark, sf_dir):
    plan = QUERIES["g01_dataset_edges"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("REPARTITION_BY_NUM") == 2
    lines = table(spark, sf_dir, "lineitem")
    assert parts_of(lines, 1 << 40) == 8 and parts_of(lines, 1 << 10) > 32


def test_a_log_writes_and_shuffles_no_texts(spark, sf_dir):
    """Neither the texts of a log nor what is found in them is written or shuffled once for each run."""
    root = Path(work_dir(spark)) / "provtrail"
    before = set(root.glob("*"))
    df = QUERIES["r01_log_events"](spark, sf_dir)
    written = [spark.read.parquet(str(p)) for p in set(root.glob("*")) - before]
    texts = [t.count() for t in written if "plan_json" in t.columns]
    assert texts and max(texts) <= len(traced_names())
    shuffled = re.findall(r"^\(\d+\) Exchange\nInput \[\d+\]: \[(.*)\]$", explained(df), re.M)
    assert shuffled and not [c for c in shuffled if re.search("facets|cols|buf|inputs|outputs|plan_json|min", c)]
