"""Mixing sources to target weights by Pfair scheduling, in DataFrame functions only.

Target weights are whole shares of a period of D slots. Block j of a source with w shares is released
at floor(j D / w) and due by ceil((j + 1) D / w); earliest deadline first among the released blocks
fills one slot after the other. All windows are kept, so at every slot each source is less than
one block from its target, as long as no source has run out. The schedule repeats after D slots:
one period is placed once, on the driver, and all blocks take their slots from it by arithmetic.
"""

from __future__ import annotations

import heapq
import json
import math
from fractions import Fraction

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from provtrail.llm.common import free_names, number, small
from provtrail.session import materialize

#: Slots of a period, and slots for each source, at least.
PERIOD = 1000
SLOTS_A_SOURCE = 4
#: Slots of a period that are placed, at most: a table of five numbers each, which is broadcast.
MAX_PERIOD = 1 << 20
BLOCK_ROWS = 16
_LONG = (1 << 62) - 1


def target_shares(sizes: dict, weights: dict | None = None, period: int = PERIOD) -> dict:
    """Shares of the period by source: whole numbers, whose sum is the period.

    Without weights a source weighs the square root of its rows, which flattens hot sources; the period
    has ``period`` slots, or SLOTS_A_SOURCE for each source if that is more, and each source has one
    share at least (by largest remainder). Given weights are taken as they are written, in decimals, and
    the period is as long as it takes to make them whole; a source without a weight, or of weight 0,
    has no share. If all weights are 0 they count as equal.
    """
    if not sizes:
        return {}
    if weights is not None:
        return _whole_shares(sizes, weights)
    period = max(period, SLOTS_A_SOURCE * len(sizes))
    want = {s: n ** 0.5 for s, n in sizes.items()}
    total = sum(want.values()) or 1.0
    spare = period - len(sizes)
    exact = {s: x / total * spare for s, x in want.items()}
    return _rounded(exact, period, least=1)


def _rounded(exact: dict, period: int, least: int = 0) -> dict:
    """Whole shares by largest remainder, ties by name."""
    shares = {s: least + int(x) for s, x in exact.items()}
    order = sorted(exact, key=lambda s: (int(exact[s]) - exact[s], s is not None, s or ""))
    for s in order[:period - sum(shares.values())]:
        shares[s] += 1
    return shares


def _whole_shares(sizes: dict, weights: dict) -> dict:
    if any(not (math.isfinite(w) and w >= 0) for w in weights.values()):
        raise ValueError("weights are finite and not negative")
    want = {s: Fraction(str(weights.get(s, 0))) for s in sizes}
    if not any(want.values()):
        want = dict.fromkeys(want, Fraction(1))
    scale = math.lcm(*(w.denominator for w in want.values()))
    whole = {s: int(w * scale) for s, w in want.items()}
    factor = math.gcd(*whole.values())
    return {s: w // factor for s, w in whole.items()}


def place_period(shares: list[int], slots: int | None = None) -> list[tuple[int, int, int, int]]:
    """(source index, block, release, deadline) of each slot of a period, earliest deadline first; or of
    its first ``slots``."""
    period = sum(shares)
    waiting, ready, out = [(0, i, 0) for i, w in enumerate(shares) if w], [], []
    for t in range(min(period, slots or period)):
        while waiting and waiting[0][0] <= t:
            _, i, j = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-(j + 1) * period // shares[i]), i, j))
        # Windows released so far always are more than the slots filled: one is ready.
        deadline, i, j = heapq.heappop(ready)
        out.append((i, j, j * period // shares[i], deadline))
        heapq.heappush(waiting, ((j + 1) * period // shares[i], i, j + 1))
    return out


def _slot_table(spark: SparkSession, placed: list[tuple[int, int, int, int]]) -> DataFrame:
    """Rows (_t, _of, _k, _release, _deadline): slot t of a period is for block k of a source."""
    text = ",".join(":".join(map(str, p)) for p in placed)
    rows = spark.range(1).select(F.posexplode(F.split(F.lit(text), ",")).alias("_t", "_p")).filter("_p <> ''")
    names = ("_of", "_k", "_release", "_deadline")
    return rows.select(F.col("_t").cast("long").alias("_t"), *[F.split("_p", ":")[i].cast("long").alias(n) for i, n in enumerate(names)])


def _source_table(spark: SparkSession, rows: list[dict]) -> DataFrame:
    """Rows (_source, _i, _w): the index and the shares of each source."""
    kind = "array<struct<_source: string, _i: int, _w: long>>"
    return spark.range(1).select(F.explode(F.from_json(F.lit(json.dumps(rows)), kind)).alias("r")).select("r.*")


def _order(id_column: Column) -> Column:
    return F.md5(F.coalesce(id_column.cast("string"), F.lit("")))


def mix(
    docs: DataFrame, weights: dict | None = None, id_col: str = "doc_id", source_col: str = "source",
    period: int = PERIOD, block_rows: int = BLOCK_ROWS, keep: tuple[str, ...] = (),
) -> DataFrame:
    """One row per document row: doc_id, source, rank, block, release, deadline, slot, mixed, ``keep`` columns.

    A source's rows are shuffled by the md5 of their id and cut into blocks of ``block_rows``;
    ``slot`` is the block's place in the mixture, so sorting by (slot, rank) writes it. Shares are
    those of ``target_shares``, for any number of sources; only the sources' names and counts and one
    period reach the driver. Null is a source of its own; a source without a share follows after all
    others, in turn with its like. Rows of one id, null too, are ranked in any way, which gives the same
    rows. ``mixed`` is false from the slot at which the first source has run out: those rows follow in
    the order of their slots, and no row is dropped. An empty table gives no rows.

    Given weights whose period has more than MAX_PERIOD slots, all of which are needed, are rounded to
    that many shares: after t slots that is another t / MAX_PERIOD blocks at most.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"), *keep)
    sizes = {r["source"]: r["count"] for r in rows.groupBy("source").count().collect()}
    shares = target_shares(sizes, weights, period)
    names = sorted(shares, key=lambda s: (s is not None, s or ""))
    blocks = {s: -(-sizes[s] // block_rows) for s in names}
    period = sum(shares.values())

    def ends() -> list[int]:
        return [-(-blocks[s] * period // shares[s]) for s in names if shares[s]]

    if period > MAX_PERIOD and max(ends()) > MAX_PERIOD:
        period, exact = MAX_PERIOD, {s: Fraction(w * MAX_PERIOD, period) for s, w in shares.items()}
        shares = _rounded(exact, period)
    horizon, last = min(ends(), default=0), max(ends(), default=0)
    idle = [s for s in names if not shares[s]]
    sources = _source_table(spark, [{"_source": s, "_i": i, "_w": min(shares[s], _LONG)} for i, s in enumerate(names)])
    rows = rows.join(F.broadcast(sources), F.col("source").eqNullSafe(F.col("_source"))).withColumn("_md5", _order(F.col("doc_id")))
    rows = materialize(rows.drop("_source"), "mixing-rows").withColumn("_tie", F.monotonically_increasing_id())
    held = ("doc_id", "source", "_w", *keep)
    rows = number(rows, "_i", ("_md5", "doc_id", "_tie"), held, "mixing").withColumn("block", F.floor(F.col("nth") / block_rows))
    slots = _slot_table(spark, place_period([shares[s] for s in names], last))
    timed = rows.filter("_w > 0").join(F.broadcast(slots), (F.col("_i") == F.col("_of")) & (F.expr("block % _w") == F.col("_k")))
    # A period too long for a number is placed in part: all blocks are in the first one.
    before = F.expr("block div _w") * min(period, _LONG)
    release = before + F.col("_release")
    timed = timed.select(
        *held, "nth", "block", release.alias("release"), (before + F.col("_deadline")).alias("deadline"),
        (before + F.col("_t")).alias("slot"), (release < min(horizon, _LONG)).alias("mixed"))
    turn = F.lit(0)
    if idle:
        turn = F.array_position(F.array(*[F.lit(names.index(s)) for s in idle]), F.col("_i")) - 1
    slot = F.lit(last) + F.col("block") * len(idle) + turn
    after = rows.filter("_w = 0").select(
        *held, "nth", "block", slot.alias("release"), (slot + 1).alias("deadline"), slot.alias("slot"), F.lit(False).alias("mixed"))
    return timed.union(after).select(
        "doc_id", "source", F.col("nth").alias("rank"), "block", "release", "deadline", "slot", "mixed", *keep)


def mixed_order(docs: DataFrame, weights: dict | None = None, period: int = PERIOD, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``docs`` with its own columns, laid out in the order of the mixture.

    The rows are written once with a number each, by which they take their places: a join of unique
    keys and one range shuffle. Written files follow each other in the order of the mixture.
    """
    own, of, slot, rank = free_names(docs, "_own", "_of_row", "_slot", "_rank")
    rows = materialize(docs.withColumn(own, F.monotonically_increasing_id()), "mixing-docs")
    placed = mix(rows, weights, period=period, block_rows=block_rows, keep=(own,))
    places = materialize(placed.select(F.col(own).alias(of), F.col("slot").alias(slot), F.col("rank").alias(rank)), "mixing-places")
    out = rows.join(small(places), F.col(own) == F.col(of))
    return out.repartitionByRange(slot, rank, own).sortWithinPartitions(slot, rank, own).drop(own, of, slot, rank)


def oracle(period: int = PERIOD, block_rows: int = BLOCK_ROWS) -> str:
    """DuckDB SQL for the rows of ``mix`` over documents with its default weights.

    The schedule is stepped slot by slot with one list of the blocks that each source has placed.
    """
    return f"""
WITH RECURSIVE n AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
d AS (SELECT greatest({period}, {SLOTS_A_SOURCE} * count(*)) AS d FROM n),
exact AS (SELECT source, n, sqrt(n) / (SELECT sum(sqrt(n)) FROM n) * ((SELECT d FROM d) - (SELECT count(*) FROM n)) AS x FROM n),
part AS (SELECT source, n, 1 + floor(x)::INT AS w0, row_number() OVER (ORDER BY floor(x) - x, source NULLS FIRST) AS r FROM exact),
sh AS (SELECT source, n, row_number() OVER (ORDER BY source NULLS FIRST) AS i,
  w0 + CASE WHEN r <= (SELECT d FROM d) - (SELECT sum(w0) FROM part) THEN 1 ELSE 0 END AS w FROM part),
ws AS (SELECT list(w ORDER BY i) AS w FROM sh),
step(t, p, done) AS (
  SELECT -1, 0, (SELECT list_transform(w, lambda x: 0) FROM ws)
  UNION ALL SELECT t + 1, q, list_transform(range(1, len(done) + 1), lambda j: done[j] + CASE WHEN j = q THEN 1 ELSE 0 END)
  FROM (SELECT t, done, list_min(list_transform(list_filter(range(1, len(done) + 1),
      lambda j: done[j] * d // w[j] <= t + 1),
      lambda j: (((done[j] + 1) * d + w[j] - 1) // w[j]) * 1000000 + j)) % 1000000 AS q FROM step, ws, d WHERE t < d - 1)),
sched AS (SELECT t, p AS i, row_number() OVER (PARTITION BY p ORDER BY t) - 1 AS k FROM step WHERE t >= 0),
b AS (SELECT d.doc_id, d.source, s.i, s.w::BIGINT AS w, row_number() OVER (PARTITION BY d.source
  ORDER BY md5(coalesce(d.doc_id::VARCHAR, '')), d.doc_id) - 1 AS rank
  FROM documents d JOIN sh s ON d.source IS NOT DISTINCT FROM s.source),
c AS (SELECT *, rank // {block_rows} AS block FROM b)
SELECT c.doc_id, c.source, c.rank, c.block, c.block * d.d // c.w AS release,
  ((c.block + 1) * d.d + c.w - 1) // c.w AS deadline, (c.block // c.w) * d.d + sched.t AS slot,
  (c.block * d.d // c.w) < (SELECT min(((n + {block_rows} - 1) // {block_rows} * d.d + w - 1) // w) FROM sh, d) AS mixed
FROM d, c JOIN sched ON sched.i = c.i AND sched.k = c.block % c.w"""
