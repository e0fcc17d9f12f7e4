"""Column lineage of captured plans, exact per output column."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from oracle.lineage import VIEW_BASES, expected_columns, expected_inputs
from provtrail.plans import resolve
from provtrail.plans.capture import capture, plan_log
from provtrail.plans.traced import TRACED, traced_plan_log


def columns_of(log):
    out = {}
    for r in resolve.resolve_columns(log).collect():
        out.setdefault(r.query_id, {})[r.out_col] = (
            r.transformation_type, frozenset(f"{s.name}.{s.field}" for s in r.input_fields))
    return out


@pytest.fixture(scope="module")
def base(spark):
    a = spark.createDataFrame([(1, "x", 1.0)], "id int, name string, value double")
    b = spark.createDataFrame([(1, "y", 2.0)], "id int, category string, score double")
    c = spark.createDataFrame([(1, "k", [1, 2])], "id int, grp string, tags array<int>")
    for n, d in (("a", a), ("b", b), ("c", c)):
        d.createOrReplaceTempView(n)
    return spark


def resolved(spark, **queries):
    rows = [capture(spark.sql(q) if isinstance(q, str) else q, n, None) for n, q in queries.items()]
    return columns_of(plan_log(spark, rows))


def test_traced_queries(spark, sf_dir):
    got = columns_of(traced_plan_log(spark, sf_dir))
    want = expected_columns()
    for name in TRACED:
        if name == "q29_series":
            assert got[name] == {"seq": ("DIRECT", frozenset({"Range.id"}))}
        else:
            assert got.get(name, {}) == want.get(name, {}), name


def test_traced_inputs(spark, sf_dir):
    log = traced_plan_log(spark, sf_dir)
    parsed = resolve.parse_log(log.select(F.col("query_id").alias("plan_id"), "plan_json"))
    got = {}
    for r in resolve.plan_inputs(parsed).collect():
        assert r.dataset_type == ("VIEW" if r.name in VIEW_BASES else "TABLE")
        got.setdefault(r.plan_id, set()).add(r.name)
    want = expected_inputs()
    assert {n: got[n] for n in want} == want


def test_expression_rules(base):
    got = resolved(
        base,
        e=""" SELECT id IN (1, 2) AS isin, name IS NULL AS isnull, NOT (value > 1) AS negated, value BETWEEN 0 AND id AS btw,
            CASE name WHEN 'x' THEN value ELSE 0 END AS simple_case, CAST(CAST(value AS INT) AS STRING) AS recast,
            COALESCE(name, CURRENT_USER()) AS no_source_function, COUNT(*) OVER () AS counted, 1 + 1 AS two FROM a""",
    )["e"]
    assert got == {
        "isin": ("DIRECT", frozenset({"a.id"})), "isnull": ("DIRECT", frozenset({"a.name"})),
        "negated": ("DIRECT", frozenset({"a.value"})), "btw": ("DIRECT", frozenset({"a.value", "a.id"})),
        "simple_case": ("DIRECT", frozenset({"a.name", "a.value"})), "recast": ("DIRECT", frozenset({"a.value"})),
        "no_source_function": ("INDIRECT", frozenset({"a.name"})),
    }


def test_flag_of_a_sourceless_column_does_not_cross_a_projection(base):
    got = resolved(base, q="SELECT COALESCE(name, u) AS c FROM (SELECT name, CURRENT_USER() AS u FROM a) t")
    assert got["q"]["c"] == ("DIRECT", frozenset({"a.name"}))


def test_aggregate_filter_and_order_add_nothing(base):
    got = resolved(base, q="SELECT SUM(value) FILTER (WHERE name = 'x') AS s, COUNT(*) AS n FROM a GROUP BY id")["q"]
    assert got == {"s": ("INDIRECT", frozenset({"a.value"}))}


def test_union_reuses_ids_of_its_first_branch(base):
    t = base.table("a").select("id", "name")
    u = t.union(base.table("b").select("id", "category"))
    both = u.groupBy("id").agg(F.max("name").alias("m")).join(base.table("c").select("id", "grp"), "id")
    got = resolved(base, q=both, n=u.union(base.table("c").select("id", "grp")))
    assert got["q"]["m"] == ("INDIRECT", frozenset({"a.name", "b.category"}))
    assert got["q"]["id"] == ("DIRECT", frozenset({"a.id", "b.id"}))
    assert got["n"]["name"] == ("DIRECT", frozenset({"a.name", "b.category", "c.grp"}))


def test_union_over_a_bare_join_goes_by_position(base):
    a, b, c = (base.table(t) for t in "abc")
    left = a.join(b, a.id == b.id)
    right = a.join(c, a.id == c.id).select(c.id, c.grp, a.value, a.id, a.name, a.value)
    got = resolved(base, q=left.union(right).toDF("i1", "n", "v", "i2", "cat", "s"))["q"]
    assert got["n"] == ("DIRECT", frozenset({"a.name", "c.grp"}))
    assert got["s"] == ("DIRECT", frozenset({"b.score", "a.value"}))


def test_semi_join_keeps_the_left_side(base):
    a, b = base.table("a"), base.table("b")
    q = a.join(b, a.id == b.id, "left_semi").union(a.join(b, a.id == b.id, "left_anti"))
    assert resolved(base, q=q)["q"]["name"] == ("DIRECT", frozenset({"a.name"}))


def test_self_join_tells_sides_apart(base):
    a, b = base.table("a").alias("l"), base.table("a").alias("r")
    q = a.join(b, F.col("l.id") == F.col("r.id")).select(F.col("l.name").alias("x"), F.col("r.value").alias("y"))
    assert resolved(base, q=q)["q"] == {
        "x": ("DIRECT", frozenset({"a.name"})), "y": ("DIRECT", frozenset({"a.value"}))}


def test_long_chains_of_projections(base):
    df = base.table("a").select("id", "value")
    for i in range(40):
        df = df.select("id", (F.col("value") if i else F.col("value") * 2).alias("value"))
    assert resolved(base, q=df)["q"] == {
        "id": ("DIRECT", frozenset({"a.id"})), "value": ("INDIRECT", frozenset({"a.value"}))}


def test_last_of_equal_names_wins(base):
    got = resolved(base, q="SELECT id AS c, UPPER(name) AS c FROM a")["q"]
    assert got == {"c": ("INDIRECT", frozenset({"a.name"}))}


def test_pivots(base):
    two = base.table("a").groupBy("id").pivot("name", ["x", "y"]).agg(F.sum("value").alias("s"), F.max("value").alias("m"))
    got = resolved(base, q=two)["q"]
    assert got["id"] == ("DIRECT", frozenset({"a.id"}))
    for c in ("x_s", "y_m"):
        assert got[c] == ("INDIRECT", frozenset({"a.value"}))


def test_unnest_and_stack(base):
    got = resolved(
        base, u="SELECT id, tag FROM c LATERAL VIEW OUTER explode(tags) t AS tag",
        s="SELECT id, m FROM b LATERAL VIEW stack(2, CAST(id AS DOUBLE), score) t AS m", p="SELECT posexplode(tags) FROM c")
    assert got["u"] == {"id": ("DIRECT", frozenset({"c.id"})), "tag": ("INDIRECT", frozenset({"c.tags"}))}
    assert got["s"]["m"] == ("INDIRECT", frozenset({"b.id", "b.score"}))
    assert got["p"]["pos"] == ("INDIRECT", frozenset({"c.tags"}))


def test_nested_scalar_subqueries(base):
    got = resolved(base, q="""SELECT id, (SELECT MAX(score + (SELECT MIN(id) FROM c)) FROM b) AS deep,
        (SELECT b.category FROM b LIMIT 1) AS plain FROM a""")["q"]
    assert got["deep"] == ("INDIRECT", frozenset({"b.score", "c.id"}))
    assert got["plain"] == ("DIRECT", frozenset({"b.category"}))


def test_cte_inside_a_subquery(base):
    got = resolved(base, q="""WITH t AS (SELECT id, score FROM b) SELECT name,
        (SELECT MAX(score) FROM t WHERE t.id = a.id) AS m FROM a WHERE id IN (SELECT id FROM t)""")["q"]
    assert got["m"] == ("INDIRECT", frozenset({"b.score"}))


def test_python_functions_are_functions(base):
    f = F.udf(lambda v: v, "double")
    assert resolved(base, q=base.table("a").select(f("value").alias("v")))["q"]["v"] == ("INDIRECT", frozenset({"a.value"}))


def test_files_stand_for_unnamed_scans(spark, base, tmp_path):
    for part in ("p1", "p2"):
        base.table("a").coalesce(1).write.parquet(f"{tmp_path}/{part}")
    df = spark.read.parquet(f"{tmp_path}/p1", f"{tmp_path}/p2")
    log = plan_log(spark, [capture(df.select("id"), "q")])
    files = [f.removeprefix("file://") for _, fs in df_files(log) for f in fs]
    assert len(files) == 2
    row = resolve.resolve_columns(log).first()
    assert (row.input_fields[0].namespace, row.input_fields[0].name) == ("file", files[0])
    assert {r.name for r in resolve.file_scan_datasets(log).collect()} == set(files)


def df_files(log):
    return [(f.leaf, f.paths) for r in log.collect() for f in r.files]


def test_rejects(base):
    log = plan_log(base, [
        ("bad", "x", "{nope", [], None, None, None, datetime(2024, 1, 1)),
        ("other", "x", "[{\"foo\": 1}]", [], None, None, None, datetime(2024, 1, 1)),
        capture(base.table("a").mapInArrow(lambda b: b, "id int"), "python"), capture(base.table("a"), "good")])
    assert {r.query_id: r.reason for r in resolve.rejected_plans(log).collect()} == {
        "bad": "malformed plan", "other": "malformed plan", "python": "untraceable node MapInArrow"}
    assert set(columns_of(log)) == {"good"}


def fates_of(log):
    plans = log.select(F.col("query_id").alias("plan_id"), "plan_json", "files")
    out = {}
    for r in resolve.column_fates(plans).collect():
        out.setdefault(r.plan_id, {})[r.out_col] = (r.fate, r.reason)
    return out


def test_only_columns_that_touch_an_unknown_node_are_rejected(base):
    made = base.table("b").mapInPandas(lambda b: b, "id int, category string, score double").withColumnRenamed("id", "b_id")
    df = base.table("a").join(made, F.col("id") == F.col("b_id")).select(
        "id", "name", F.lit(1).alias("one"), "category", (F.col("value") + F.col("score")).alias("both"))
    both = df.select("id", "category").union(base.table("b").select("id", "category"))
    log = plan_log(base, [capture(df, "q"), capture(both, "u")])
    bad = ("rejected", "untraceable node MapInPandas")
    assert fates_of(log) == {
        "q": {"id": ("traced", None), "name": ("traced", None), "one": ("sourceless", None), "category": bad, "both": bad},
        "u": {"id": ("traced", None), "category": bad}}
    assert set(columns_of(log)["q"]) == {"id", "name"} and set(columns_of(log)["u"]) == {"id"}
    assert {(r.query_id, r.out_col) for r in resolve.rejected_columns(log).collect()} == {
        ("q", "category"), ("q", "both"), ("u", "category")}


def test_references_that_nothing_defines_are_rejected(base):
    """A plan text with a reference to a column of nowhere: no column vanishes."""
    row = list(capture(base.table("a").select("id", F.upper("name").alias("up")), "q"))
    nodes = json.loads(row[2])
    (name,) = [e for e in nodes[0]["projectList"][1] if e["class"].endswith("AttributeReference")]
    name["exprId"]["id"] += 900_000
    row[2] = json.dumps(nodes)
    assert fates_of(plan_log(base, [tuple(row)]))["q"] == {"id": ("traced", None), "up": ("rejected", "untraceable node unbound")}


def test_grouping_sets_and_unpivots(base):
    got = resolved(
        base, cube="SELECT id, name, GROUPING_ID() AS g, SUM(value) AS s FROM a GROUP BY CUBE (id, name)",
        sets="SELECT UPPER(name) AS up, MAX(id) AS m FROM a GROUP BY GROUPING SETS ((UPPER(name)), ())",
        unpivot="SELECT * FROM b UNPIVOT (v FOR n IN (id, score))",
        frame=base.table("b").unpivot(["category"], ["id", "score"], "n", "v").filter("v > 0"),
        many="SELECT * FROM b UNPIVOT ((x, y) FOR n IN ((id, score) AS p, (score, id) AS q))")
    assert got["cube"] == {"id": ("DIRECT", frozenset({"a.id"})), "name": ("DIRECT", frozenset({"a.name"})),
                           "s": ("INDIRECT", frozenset({"a.value"}))}
    assert got["sets"] == {"up": ("INDIRECT", frozenset({"a.name"})), "m": ("INDIRECT", frozenset({"a.id"}))}
    two = frozenset({"b.id", "b.score"})
    for q in ("unpivot", "frame"):
        assert {k: v[1] for k, v in got[q].items()} == {"category": frozenset({"b.category"}), "v": two}
    assert {k: v[1] for k, v in got["many"].items()} == {"category": frozenset({"b.category"}), "x": two, "y": two}


def test_unpivot_inside_a_subquery(base):
    base.table("b").unpivot(["category"], ["id", "score"], "n", "v").createOrReplaceTempView("long_b")
    got = resolved(base, q="SELECT name, (SELECT MAX(v) FROM long_b) AS top FROM a")["q"]
    assert got["top"] == ("INDIRECT", frozenset({"b.id", "b.score"}))


def test_lateral_outputs_and_outer_columns(base):
    got = resolved(
        base, explode="SELECT id, x FROM c, LATERAL explode(tags) AS t(x)",
        star="SELECT * FROM c, LATERAL (SELECT explode(tags) AS x)",
        outer="SELECT a.name, t.z, t.w FROM a, LATERAL (SELECT a.value + b.score AS z, a.id AS w FROM b) t",
        joined="""SELECT a.id, t.grp, t.s FROM a, LATERAL (SELECT c.grp, b.score + a.value AS s FROM b
            JOIN c ON b.id = c.id WHERE b.id = a.id) t""",
        deep="""SELECT a.id, t.u FROM a, LATERAL (SELECT u FROM b,
            LATERAL (SELECT concat(b.category, c.grp) AS u FROM c WHERE c.id = b.id) WHERE b.id = a.id) t""",
        unions="SELECT id, x FROM c, LATERAL (SELECT explode(tags) AS x UNION ALL SELECT id AS x) t",
        frame=base.sql("SELECT * FROM a, LATERAL (SELECT score FROM b WHERE b.id = a.id)"))
    one = frozenset
    assert got["explode"] == {"id": ("DIRECT", one({"c.id"})), "x": ("INDIRECT", one({"c.tags"}))}
    assert got["star"]["x"] == ("INDIRECT", one({"c.tags"})) and set(got["star"]) == {"id", "grp", "tags", "x"}
    assert got["outer"] == {"name": ("DIRECT", one({"a.name"})), "z": ("INDIRECT", one({"a.value", "b.score"})),
                            "w": ("DIRECT", one({"a.id"}))}
    assert got["joined"]["s"] == ("INDIRECT", one({"a.value", "b.score"})) and got["joined"]["grp"] == ("DIRECT", one({"c.grp"}))
    assert got["deep"]["u"] == ("INDIRECT", one({"b.category", "c.grp"}))
    assert got["unions"]["x"] == ("INDIRECT", one({"c.tags", "c.id"}))
    assert got["frame"]["score"] == ("DIRECT", one({"b.score"}))


def test_outer_columns_of_a_filter_add_nothing(base):
    got = resolved(base, q="SELECT name, (SELECT MAX(score) FROM b WHERE b.id = a.id) AS m FROM a")["q"]
    assert got["m"] == ("INDIRECT", frozenset({"b.score"}))


def test_view_statements_are_traced(base):
    statement = base.sql("CREATE OR REPLACE TEMP VIEW named AS SELECT id, UPPER(name) AS up FROM a")
    log = plan_log(base, [capture(statement, "v")])
    assert inputs_of(log) == {"a"} and resolve.rejected_plans(log).count() == 0
    assert columns_of(log)["v"] == {"id": ("DIRECT", frozenset({"a.id"})), "up": ("INDIRECT", frozenset({"a.name"}))}


def test_pipes(base):
    got = resolved(base, q="FROM a |> EXTEND value * 2 AS d |> AGGREGATE MAX(d) AS m GROUP BY name |> ORDER BY name")["q"]
    assert got == {"name": ("DIRECT", frozenset({"a.name"})), "m": ("INDIRECT", frozenset({"a.value"}))}


def test_repeated_plans_are_resolved_once(base):
    """Fresh captures of one text are one plan; another text or constant is another."""
    text = """WITH t AS (SELECT id, value FROM a) SELECT t.id, (SELECT max(score) FROM b WHERE b.id = t.id) AS m
        FROM t JOIN t AS u ON t.id = u.id"""
    log = plan_log(base, [capture(base.sql(text), f"q{i}") for i in range(5)] + [
        capture(base.sql("SELECT id FROM a WHERE id > 1"), "r1"), capture(base.sql("SELECT id FROM a WHERE id > 2"), "r2")])
    assert resolve.distinct_plans(log).count() == 3
    got = columns_of(log)
    assert len(got) == 7 and all(got[f"q{i}"] == got["q0"] for i in range(5))
    assert got["q0"]["id"] == ("DIRECT", frozenset({"a.id"})) and got["q0"]["m"] == ("INDIRECT", frozenset({"b.score"}))


def inputs_of(log):
    parsed = resolve.parse_log(log.select(F.col("query_id").alias("plan_id"), "plan_json", "files"))
    return {r.name for r in resolve.plan_inputs(parsed).collect()}


def test_lateral_joins(base):
    log = plan_log(base, [capture(base.sql("""SELECT a.name, t.m, t.twice FROM a,
        LATERAL (SELECT max(score) AS m, max(score) * 2 AS twice FROM b WHERE b.id = a.id) t"""), "q")])
    assert columns_of(log)["q"] == {
        "name": ("DIRECT", frozenset({"a.name"})), "m": ("INDIRECT", frozenset({"b.score"})),
        "twice": ("INDIRECT", frozenset({"b.score"}))}
    assert inputs_of(log) == {"a", "b"} and resolve.rejected_plans(log).count() == 0


def test_as_of_joins(base):
    left, right = base.table("a"), base.table("b").withColumnRenamed("id", "other")
    df = left._joinAsOf(right, leftAsOfColumn="id", rightAsOfColumn="other", how="left")
    log = plan_log(base, [capture(df.select("name", "score"), "q")])
    assert columns_of(log)["q"] == {"name": ("DIRECT", frozenset({"a.name"})), "score": ("DIRECT", frozenset({"b.score"}))}


def test_subqueries_in_generators_and_sort_orders(base):
    log = plan_log(base, [
        capture(base.sql("SELECT name, x FROM a LATERAL VIEW explode(array((SELECT max(score) FROM b))) g AS x"), "q"),
        capture(base.sql("SELECT name FROM a ORDER BY (SELECT max(score) FROM b) + id"), "s")])
    assert columns_of(log)["q"]["x"] == ("INDIRECT", frozenset({"b.score"}))
    for q in ("q", "s"):
        assert inputs_of(log.filter(F.col("query_id") == q)) == {"a", "b"}


def test_unknown_nodes_are_rejected_at_every_level(base):
    a = base.table("a")
    base.table("b").mapInArrow(lambda x: x, "score double").createOrReplaceTempView("made")
    cogrouped = a.groupBy("id").cogroup(base.table("b").groupBy("id")).applyInArrow(lambda x, y: x, a.schema)
    log = plan_log(base, [
        capture(cogrouped, "cogroup"), capture(a.select("id"), "good"),
        capture(base.sql("SELECT name, (SELECT max(score) FROM made) AS n FROM a"), "inner")])
    assert {r.query_id: r.reason for r in resolve.rejected_plans(log).collect()} == {
        "cogroup": "untraceable node FlatMapCoGroupsInArrow", "inner": "untraceable node MapInArrow"}
    got = columns_of(log)
    assert set(got) == {"good", "inner"} and set(got["inner"]) == {"name"}


def test_names_under_many_aliases(base):
    df = base.table("a")
    for i in range(6):
        df = df.alias(f"x{i}")
    assert columns_of(plan_log(base, [capture(df.select("id"), "q")]))["q"] == {"id": ("DIRECT", frozenset({"a.id"}))}


def test_views_of_views_and_direct_reads(base):
    base.sql("SELECT id, name FROM a WHERE id > 0").createOrReplaceTempView("v1")
    base.sql("SELECT name FROM v1 WHERE name <> ''").createOrReplaceTempView("v2")
    log = plan_log(base, [capture(base.sql("SELECT v2.name, a.value FROM v2 JOIN a ON v2.name = a.name"), "q")])
    parsed = resolve.parse_log(log.select(F.col("query_id").alias("plan_id"), "plan_json", "files"))
    assert {(r.name, r.dataset_type) for r in resolve.plan_inputs(parsed).collect()} == {("v2", "VIEW"), ("a", "TABLE")}
    assert columns_of(log)["q"]["name"] == ("DIRECT", frozenset({"a.name"}))


def test_excluded_sources_and_target_columns(base):
    log = plan_log(base, [capture(base.sql("SELECT a.name, b.score FROM a JOIN b ON a.id = b.id"), "q")])
    cols = resolve.resolve_columns(log)
    assert [r.out_col for r in resolve.exclude_sources(cols, "b").collect()] == ["name"]
    targets = base.createDataFrame([("q", ["n", "s"])], "query_id string, target_cols array<string>")
    assert {r.out_col: r.target_col for r in resolve.with_target_columns(cols, targets).collect()} == {
        "name": "n", "score": "s"}
