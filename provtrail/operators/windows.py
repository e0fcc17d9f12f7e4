"""Ordered windows that survive a hot key.

A plain window sends all rows of one key to one task. Here each key is cut along its order
column into buckets (say, months), the window runs per (key, bucket), and what crosses a
bucket border is carried by a small per-bucket summary. A key holding a third of all rows
is thus spread over as many tasks as it has buckets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from provtrail.session import materialize


def ordered_prefix(
    df: DataFrame, keys: list[str], bucket: str, order: list[Column | str],
    number: str | None = None, sums: dict[str, str] | None = None,
) -> DataFrame:
    """``row_number`` (as ``number``) and running sums ({new column: summed column}).

    ``bucket`` must not decrease along ``order`` within a key.
    """
    sums = sums or {}
    inside = Window.partitionBy(*keys, bucket).orderBy(*order)
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cols = {out: F.sum(src).over(upto) for out, src in sums.items()}
    if number:
        cols[number] = F.row_number().over(inside)
    before = Window.partitionBy(*keys).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    totals = df.groupBy(*keys, bucket).agg(
        F.count(F.lit(1)).alias("_n"), *[F.sum(src).alias(f"_s_{out}") for out, src in sums.items()])
    carried = totals.select(
        *keys, bucket, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_n"),
        *[F.sum(f"_s_{out}").over(before).alias(f"_s_{out}") for out in sums])
    joined = df.withColumns(cols).join(carried, [*keys, bucket])
    out = {c: F.coalesce(F.col(f"_s_{c}") + F.col(c), F.col(c), F.col(f"_s_{c}")) for c in sums}
    if number:
        out[number] = F.col("_n") + F.col(number)
    return joined.withColumns(out).drop("_n", *[f"_s_{c}" for c in sums])


def with_halo(df: DataFrame, keys: list[str], bucket: str, order: list[str], rows: int) -> DataFrame:
    """Add to each (key, bucket) the ``rows`` rows of the key just before it.

    Added rows have ``is_halo`` set: compute a frame of at most ``rows`` preceding rows over
    (keys, bucket), then drop them. A non-empty bucket has at least one row, so the rows
    just before a bucket lie in its ``rows`` predecessors.
    """
    payload = [c for c in df.columns if c not in (*keys, bucket)]
    last = Window.partitionBy(*keys, bucket).orderBy(*[F.col(c).desc() for c in order])
    tails = (
        df.withColumn("_r", F.row_number().over(last)).filter(F.col("_r") <= rows)
        .groupBy(*keys, bucket)
        .agg(F.sort_array(F.collect_list(F.struct(
            *[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)], *payload))).alias("_t"))
    )
    earlier = Window.partitionBy(*keys).orderBy(bucket).rowsBetween(-rows, -1)
    carried = tails.select(*keys, bucket, F.flatten(F.collect_list("_t").over(earlier)).alias("_t")).select(
        *keys, bucket, F.explode(F.slice("_t", F.greatest(F.size("_t") - rows + 1, F.lit(1)), rows)).alias("_t"))
    halo = carried.select(*keys, bucket, *[F.col(f"_t.{c}").alias(c) for c in payload], F.lit(True).alias("is_halo"))
    return df.select(*keys, bucket, *payload, F.lit(False).alias("is_halo")).unionByName(halo)


def first_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key by ``order`` (structs compare field by field, ascending).

    An aggregate, so hot keys are reduced before the shuffle, unlike row_number() = 1.
    """
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_row")).select(
        *keys, *[F.col(f"_row.{c}").alias(c) for c in rest])


def asof_join(
    left: DataFrame, right: DataFrame, keys: list[str], left_time: str, right_time: str,
    values: list[str], bucket,
) -> DataFrame:
    """Latest ``right`` row of the same keys with right_time <= left_time, else dropped.

    Both sides are laid into one time line per (key, bucket); the last right row seen is
    taken from there, or from the last right row of an earlier bucket. ``bucket`` maps a
    time column to its bucket, so no pair of rows is ever formed. Of right rows with the
    same keys and time the one with the greatest values is taken.
    """
    match = F.struct(F.col(right_time), *values)
    r = right.select(*keys, F.col(right_time).alias("_t"), F.lit(0).alias("_side"), match.alias("_m"))
    payload = F.struct(*left.columns)
    lft = left.select(*keys, F.col(left_time).alias("_t"), F.lit(1).alias("_side"), payload.alias("_l"))
    line = r.unionByName(lft, allowMissingColumns=True).withColumn("_b", bucket(F.col("_t")))
    here = Window.partitionBy(*keys, "_b").orderBy("_t", "_side", "_m").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    before = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    carried = line.groupBy(*keys, "_b").agg(F.max("_m").alias("_last")).select(
        *keys, "_b", F.max("_last").over(before).alias("_c"))
    found = line.withColumn("_f", F.last("_m", ignorenulls=True).over(here)).filter("_side = 1").join(
        carried, [*keys, "_b"])
    return found.withColumn("_f", F.coalesce("_f", "_c")).filter("_f is not null").select(
        "_l.*", *[F.col(f"_f.{c}").alias(c) for c in (right_time, *values)])


def global_rank(df: DataFrame, order: str, out: str = "rnk", descending: bool = True) -> DataFrame:
    """RANK() over all rows without sending them to one task.

    Rows are range-partitioned by ``order`` (equal values share a partition), ranked inside
    their partition and shifted by the row counts of the partitions before it. Only that
    count table, one row per partition, is ranked in one place.
    """
    key = F.col(order).desc() if descending else F.col(order).asc()
    parts = materialize(df.repartitionByRange(key).withColumn("_p", F.spark_partition_id()), "ranked")
    counts = parts.groupBy("_p").agg(F.count(F.lit(1)).alias("_n"))
    shift = counts.select("_p", F.coalesce(F.sum("_n").over(
        Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_shift"))
    inside = Window.partitionBy("_p").orderBy(key)
    return parts.withColumn("_r", F.rank().over(inside)).join(shift, "_p").withColumn(
        out, F.col("_r") + F.col("_shift")).drop("_p", "_r", "_shift")
