"""Dataset identity and naming on hand-picked texts."""

import hashlib

import pytest
from pyspark.sql import functions as F

from provtrail.functions import ids, naming
from provtrail.operators import datasets


def apply(spark, fn, values):
    df = spark.createDataFrame([(i, *(v if isinstance(v, tuple) else (v,))) for i, v in enumerate(values)])
    cols = df.columns[1:]
    return [r[0] for r in df.select("_1", fn(*cols).alias("out")).orderBy("_1").select("out").collect()]


def test_split_path(spark):
    want = {
        "": ("file", "unknown"), "/a/b.csv": ("file", "/a/b.csv"), "rel/b": ("file", "rel/b"),
        "s3a://bkt/k/x": ("s3://bkt", "k/x"), "s3://bkt": ("s3://bkt", ""), "s3://bkt/": ("s3://bkt", ""),
        "gs://b/a": ("gs://b", "a"), "abfss://c@acc.dfs/x/y": ("abfss://c@acc.dfs", "x/y"),
        "wasbs://c@a/x": ("wasbs://c@a", "x"), "hdfs://nn:8020/x": ("hdfs://nn:8020", "x"),
        "file:///a/b": ("file", "/a/b"), "https://h/x": ("file", "https://h/x"), "S3://b/k": ("file", "S3://b/k"),
    }
    got = apply(spark, ids.split_path, list(want))
    assert [tuple(g) for g in got] == list(want.values())


def test_connection_strings(spark):
    secret = "password=hunter2"
    want = {
        f"postgres:dbname=d host=h port=5 user=u {secret}": "postgres://h:5/d",
        f"host=h port=5 {secret}": "postgres://h:5",
        "port=5 host=h dbname=d": "postgres://h:5/d",
        "postgres:host=h": "postgres://h",
        "postgres:host=a host=b": "postgres://b",
        "postgres:dbname=only": "postgres:dbname=only",
        "postgres:host= port=1": "postgres:host= port=1",
        "/x/host=a/port=b": "file:///x/host=a/port=b",
        "ahost=1 port=2": "file://ahost=1 port=2",
    }
    want |= {
        f"postgres:dbname=d user=u {secret}": "postgres:dbname=d ",
        "postgres:password='a hunter2 b' dbname=d": "postgres: dbname=d",
        "postgres://u:hunter2@h/d": "postgres://h/d", "postgresql://u@h/d": "postgresql://h/d",
        "postgres://u:p@hunter2@h/d": "postgres://h/d", "https://u:hunter2@h/x@y": "https://h/x@y",
        "abfss://c@acc.dfs/x": "abfss://c@acc.dfs/x",
    }
    for fn in (ids.source_uri, ids.metadata_uri):
        got = dict(zip(want, apply(spark, fn, list(want))))
        assert not any("hunter2" in g for g in got.values())
        if fn is ids.source_uri:
            assert {k: v.rstrip() for k, v in got.items()} == {k: v.rstrip() for k, v in want.items()}


def test_metadata_uris(spark):
    want = {"": "", "mysql:db": "mysql:db", "sqlite:/a": "sqlite:/a", "/a:b/c": "file:///a:b/c", "s3://x": "s3://x",
            "plain.db": "file://plain.db"}
    assert apply(spark, ids.metadata_uri, list(want)) == list(want.values())


def test_split_location(spark):
    want = {
        ("s3a://b/wh/sales.db/orders", "orders", "x"): ("s3://b/wh", "sales.db/orders"),
        ("s3://b/wh/sales/orders/", "orders", "sales"): ("s3://b/wh", "sales/orders"),
        ("s3://b/wh/sales/orders", "orders", "other"): ("s3://b/wh/sales", "orders"),
        ("s3://b/wh/zzz", "orders", ""): ("s3://b/wh/zzz", ""),
        ("s3://b/sales.db/orders-__PLACEHOLDER__", "orders", "x"): ("s3://b", "sales.db/orders"),
        ("s3://b/orders_v2", "orders", "x"): ("s3://b", "orders_v2"),
        ("/orders", "orders", "x"): ("/orders", "orders"),
    }
    got = apply(spark, ids.split_location, list(want))
    assert [tuple(g) for g in got] == list(want.values())


def test_sanitize_and_hash(spark):
    want = {"my-special-table": "my_special_table", "a..b  c": "a_b_c", "__x__": "x", "é": "", "a-é-b": "a_b", "": "",
            "a\tb": "ab", "A1;B,2": "A1_B_2"}
    assert apply(spark, naming.sanitized, list(want)) == list(want.values())
    text = "SELECT 1"
    assert apply(spark, naming.short_hash, [text]) == [hashlib.sha256(text.encode()).hexdigest()[:8]]


@pytest.mark.parametrize("tables,want", [
    (["a", "b-c"], "SELECT_a_b_c_12345678"),
    (["", "é", "x"], "SELECT_x_12345678"),
    # The first part that does not fit ends the list, even if a later one would.
    (["x" * 60, "y"], "SELECT_12345678"),
    (["x" * 48], "SELECT_" + "x" * 48 + "_12345678"),
    (["x" * 49], "SELECT_12345678"),
    ([], "SELECT_12345678"),
])
def test_job_name(spark, tables, want):
    df = spark.createDataFrame([(tables,)], "tables array<string>")
    got = df.select(naming.job_name(F.lit("SELECT"), "tables", F.lit("12345678"))).first()[0]
    assert got == want
    assert len(got) <= naming.MAX_LENGTH


def test_exclusion(spark):
    df = spark.createDataFrame([("__meta_x.s.t",), ("lake.s.t",), ("Lake.s.t",), ("other__meta_",)], "name string")

    def kept(prefixes):
        return {r.name for r in datasets.exclude_datasets(df, prefixes).collect()}

    assert kept("") == kept(" , ") == {"__meta_x.s.t", "lake.s.t", "Lake.s.t", "other__meta_"}
    assert kept("__meta_, lake.") == {"Lake.s.t", "other__meta_"}
    table = spark.createDataFrame([("__meta_",), (" lake. ",), ("",)], "prefix string")
    assert {r.name for r in datasets.exclude_by_table(df, table).collect()} == {"Lake.s.t", "other__meta_"}
