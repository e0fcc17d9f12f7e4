"""Plans that differ only in table names are parsed once, with the results of each plan by itself."""

import json

import pytest
from pyspark.sql import functions as F

from provtrail.plans import parse, resolve, skeleton
from provtrail.plans.capture import capture, plan_log
from provtrail.sources import fixtures as fx


def renamed(text, old, new):
    return text.replace(f'"table":"{old}"', f'"table":"{new}"')


@pytest.fixture(scope="module")
def texts(spark):
    """Texts of one query on the tables of three tenants, and odd ones."""
    for name in ("sk_a", "sk_b"):
        spark.createDataFrame([(1, "x")], "id int, name string").createOrReplaceTempView(name)
    text = capture(spark.sql("SELECT x.id, upper(y.name) AS up FROM sk_a x JOIN sk_b y ON x.id = y.id"), "q")[2]
    rows = [(f"t{i}", renamed(renamed(text, "sk_a", f"left_{i}"), "sk_b", f"right_{9 - i}")) for i in range(3)]
    rows += [
        ("same", renamed(renamed(text, "sk_a", "one"), "sk_b", "one")),  # both sides one table
        ("elsewhere", text),  # the aliases have the names too
        ("marks", renamed(text, "sk_a", "a.b")), ("broken", text[:-9]), ("null", None)]
    return spark.createDataFrame(rows, "plan_id string, plan_json string").withColumn("files", F.lit(None).cast(parse.FILES))


def rows_of(df):
    return sorted(map(json.dumps, (r.asDict(recursive=True) for r in df.collect())))


def test_skeletons_and_names(texts):
    found = skeleton.skeletons(texts, ["plan_id"])
    of = {r.plan_id: (r.skeleton_id, list(r.names)) for r in found.members.collect()}
    assert len({of[f"t{i}"][0] for i in range(3)}) == 1 and found.plans.count() == 6
    assert of["t1"][1] == ["left_1", "right_8"] and of["same"][1] == ["one"]
    assert of["elsewhere"][1] == of["marks"][1] == of["null"][1] == []


def test_results_are_those_of_the_single_plans(texts):
    found = skeleton.skeletons(texts, ["plan_id"])
    one, all_ = resolve.parse_log(texts), resolve.parse_log(found.plans)
    members = found.members.select(F.col("plan_id").alias("key"), F.col("skeleton_id").alias("plan_id"), "names")

    def back(results, **values):
        return members.join(results, "plan_id").withColumns(values).drop("plan_id", "names").withColumnRenamed("key", "plan_id")

    name = {"name": skeleton.filled("name")}
    assert rows_of(back(resolve.plan_inputs(all_), **name)) == rows_of(resolve.plan_inputs(one))
    assert rows_of(back(resolve.scan_datasets(all_), **name)) == rows_of(resolve.scan_datasets(one))
    columns = back(resolve.resolve_plans(found.plans, parsed=all_), input_fields=skeleton.filled_sources("input_fields"))
    assert rows_of(columns) == rows_of(resolve.resolve_plans(texts, parsed=one))
    assert rows_of(back(resolve.rejects_of(all_.levels))) == rows_of(resolve.rejects_of(one.levels))


def test_kept_names_stay_in_the_text(spark, texts):
    kept = spark.createDataFrame([("left_1",)], "name string")
    found = skeleton.skeletons(texts, ["plan_id"], kept)
    of = {r.plan_id: (r.skeleton_id, list(r.names)) for r in found.members.collect()}
    assert of["t1"][1] == [] and of["t0"][0] == of["t2"][0] != of["t1"][0] and of["t0"][1] == ["left_0", "right_9"]
    assert "left_1" in {r.name for r in resolve.plan_inputs(resolve.parse_log(found.plans)).collect()}


def test_one_tenant_of_a_skeleton_stays_whole(spark, texts):
    """A name that stands elsewhere in one text of a skeleton, or marks in it, keep that text whole and no other."""
    text = texts.filter("plan_id = 't0'").first().plan_json
    odd = {"alias": renamed(text, "left_0", "sk_a"), "part": renamed(text, "left_0", "upp"), "newline": renamed(text, "left_0", "up\n"),
           "mark": renamed(text, "left_0", skeleton.OPEN + "1" + skeleton.CLOSE)}
    odd["marks"] = text.replace('"sk_a"', f'"{skeleton.OPEN}1{skeleton.CLOSE}"')
    odd["marks too"] = odd["marks"].replace("left_0", "left_3")
    rows = spark.createDataFrame(list(odd.items()), "plan_id string, plan_json string").withColumn("files", F.lit(None).cast(parse.FILES))
    found = skeleton.skeletons(texts.filter("plan_id like 't_'").unionByName(rows), ["plan_id"])
    of = {r.plan_id: (r.skeleton_id, list(r.names)) for r in found.members.collect()}
    assert all(of[k][1] == [] for k in odd) and [of[f"t{i}"][1][0] for i in range(3)] == ["left_0", "left_1", "left_2"]
    held = {r.plan_id: r.plan_json for r in found.plans.collect()}
    assert len(held) == 7 and all(held[of[k][0]] == odd[k] for k in odd)


def test_names_are_not_looked_for_in_each_text(texts):
    """The text of a plan is searched for marks and names once a skeleton."""
    plan = skeleton.cut(texts)._jdf.queryExecution().optimizedPlan().toString()
    assert "Contains(" not in plan and "forall" in plan


def test_the_plan_log_is_parsed_by_template(spark, sf_dir):
    """One skeleton for each of the traced queries, however many tenants run it."""
    _, plans = fx.plan_log(spark, sf_dir)
    found = skeleton.skeletons(plans.withColumn("files", F.lit(None).cast(parse.FILES)), ["plan_id"])
    templates = plans.select(F.substring_index("plan_id", "@", 1)).distinct().count()
    assert found.plans.count() == templates < plans.count()


def test_texts_are_made_in_as_many_tasks_as_asked(spark, sf_dir):
    """Keys are small and their texts are not: tasks are not put together by the size of the keys."""
    _, plans = fx.plan_log(spark, sf_dir)
    _, variants = fx.recaptured_plan_log(spark, sf_dir)
    for texts in (plans, variants):
        sizes = texts.groupBy(F.spark_partition_id()).count().select("count").collect()
        assert len(sizes) == int(spark.conf.get("spark.sql.shuffle.partitions")) and max(s[0] for s in sizes) * 4 < texts.count()
