"""A Merkle manifest of a table of documents, with a proof for each row.

Leaves of a group (the language) are numbered in order; runs of ``fanout`` consecutive nodes hash to
their parent until one node, the group's subroot, remains. The subroots hash to the root the same way.

Tree steps are slot pivots: one conditional aggregate for each slot spreads the children of a node
into columns, concatenated columns hash to the parent, and the columns but the own slot are the
siblings. One pivot spreads ``fanout ** depth`` children, so that a step climbs ``depth`` levels with
one shuffle; the levels between are expressions over its columns. Going down again, each step joins
its pivot with the proofs of its parents, one row a pivot on both sides.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from provtrail.llm.common import fold, number
from provtrail.session import materialize

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Slots of one pivot, at most.
SLOTS = 32
#: Steps of a proof: siblings left and right of the own slot, from the leaf to the root.
PROOF = "array<struct<left:string,right:string>>"


def digest(*parts: Column) -> Column:
    """Lowercase hex sha256 of concatenated strings; null ones are left out."""
    return F.sha2(F.concat_ws("", *parts), 256)


def leaf_digest(*values: Column) -> Column:
    """Digest of values as text: ``-`` if null, else the byte count, a colon and the value."""
    texts = [v.cast("string") for v in values]
    return digest(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts])


def manifest(
    docs: DataFrame, leaf: Column | None = None, group: str = "lang", order: str = "doc_id", fanout: int = 2,
    extra: dict[str, Column] | None = None,
) -> DataFrame:
    """One row per row of ``docs``: order column, group column, leaf, subroot, root, proof, ``extra`` columns.

    ``leaf`` is the digest of a row (of FIELDS by default). Groups and rows come in ascending order, null
    first, text bytewise; rows of one order value go by their digests, and equal rows are leaves each.
    Null and empty texts and other null values are leaves like any other. Other columns of ``docs`` play
    no part, whatever their names. An empty table gives no rows. Any number of groups is allowed, and a
    group of any size is spread over tasks.
    """
    if fanout < 2:
        raise ValueError("fanout is at least 2")
    depth = 1
    while fanout ** (depth + 1) <= SLOTS:
        depth += 1
    extra = extra or {}
    leaves = materialize(docs.select(
        F.col(group).alias("_group"), F.col(order).alias("_order"),
        (leaf_digest(*map(F.col, FIELDS)) if leaf is None else leaf).alias("_hash"),
        *[c.alias(f"_x{i}") for i, c in enumerate(extra.values())]), "merkle-leaves")
    # Whole equal rows are parted by a number of their own, so that they can lie in different ranges.
    leaves = leaves.withColumn("_tie", F.monotonically_increasing_id())
    held = ["_order", "_hash", *[f"_x{i}" for i in range(len(extra))]]
    nodes = _placed(leaves, ["_order", "_hash", "_tie"], held)
    steps, subroots = climb(nodes, held, fanout, depth)
    tops = _placed(subroots.select(F.lit(0).alias("_group"), F.col("_group").alias("_of"), "_hash"), ["_of"], ["_of", "_hash"])
    top_steps, roots = climb(tops, ["_of", "_hash"], fanout, depth)
    none = F.array().cast(PROOF)
    down = descend(top_steps, roots.select("_group", F.lit(0).cast("long").alias("_i"), none.alias("_proof"), F.struct(F.col("_hash").alias("root")).alias("_top")), fanout, depth)
    above = down.select(F.col("_node._of").alias("_group"), F.lit(0).cast("long").alias("_i"), "_proof",
                        F.struct("_top.root", F.col("_node._hash").alias("subroot")).alias("_top"))
    rows = descend(steps, above, fanout, depth)
    return rows.select(
        F.col("_node._order").alias(order), F.col("_group").alias(group), F.col("_node._hash").alias("leaf"),
        F.col("_top.subroot").alias("subroot"), F.col("_top.root").alias("root"), F.col("_proof").alias("proof"),
        *[F.col(f"_node._x{i}").alias(name) for i, name in enumerate(extra)])


def _placed(rows: DataFrame, order: Sequence[str], held: Sequence[str]) -> DataFrame:
    """Rows (_group, _i, _n, _node): place in the group, nodes of the group, the ``held`` columns."""
    numbered = number(rows.select("_group", *order, F.struct(*held).alias("_node")), "_group", order, ("_node",), "merkle")
    return numbered.select("_group", F.col("nth").alias("_i"), F.col("of").alias("_n"), "_node")


def climb(nodes: DataFrame, held: Sequence[str], fanout: int, depth: int) -> tuple[list[DataFrame], DataFrame]:
    """Written pivots (_group, _i, _n, c0, c1, ..) from the leaves on, and the last nodes (_group, _hash).

    ``_i`` and ``_n`` of a pivot are its own place and its children's number in the group.
    """
    width, steps = fanout ** depth, []
    most = nodes.agg(F.max("_n")).first()[0] or 1
    while True:
        slot = F.col("_i") % width
        pivots = materialize(
            nodes.groupBy("_group", F.floor(F.col("_i") / width).alias("_i"), "_n")
            .agg(*[F.max(F.when(slot == s, F.col("_node"))).alias(f"c{s}") for s in range(width)]), "merkle-pivots")
        steps.append(pivots)
        most = -(-most // width)
        parents = _inner(pivots, fanout, depth).select(
            "_group", "_i", F.ceil(F.col("_n") / width).cast("long").alias("_n"), F.struct(F.col(f"h{depth}_0").alias("_hash")).alias("_node"))
        if most <= 1:
            return steps, materialize(parents.select("_group", "_node._hash"), "merkle-roots")
        nodes = parents


def _inner(pivots: DataFrame, fanout: int, depth: int) -> DataFrame:
    """Pivots with hashes of all levels, h<level>_<place>. A single node of a group is handed on as it is."""
    width = fanout ** depth
    out = pivots.withColumns({f"h0_{s}": F.col(f"c{s}._hash") for s in range(width)})
    for level in range(depth):
        columns = {}
        for place in range(width // fanout ** (level + 1)):
            run = [F.col(f"h{level}_{place * fanout + k}") for k in range(fanout)]
            columns[f"h{level + 1}_{place}"] = F.when(
                run[0].isNotNull(), F.when(F.col("_n") <= fanout ** level, run[0]).otherwise(digest(*run)))
        out = out.withColumns(columns)
    return out


def descend(steps: list[DataFrame], above: DataFrame, fanout: int, depth: int) -> DataFrame:
    """Nodes of the lowest step (_group, _i, _node, _proof, _top) from those above its top (_group, _i, _proof, _top)."""
    width = fanout ** depth
    for pivots in reversed(steps):
        known = above.select(F.col("_group").alias("_of_group"), F.col("_i").alias("_of_i"), "_proof", "_top")
        same = F.col("_group").eqNullSafe(F.col("_of_group")) & (F.col("_i") == F.col("_of_i"))
        joined = _inner(pivots, fanout, depth).join(known, same)
        levels = sum((F.col("_n") > fanout ** level).cast("int") for level in range(depth))
        children = []
        for s in range(width):
            siblings = []
            for level in range(depth):
                place = s // fanout ** level
                run = place - place % fanout
                siblings.append(F.struct(
                    F.concat_ws("", *[F.col(f"h{level}_{k}") for k in range(run, place)]).alias("left"),
                    F.concat_ws("", *[F.col(f"h{level}_{k}") for k in range(place + 1, run + fanout)]).alias("right")))
            children.append(F.when(F.col(f"c{s}").isNotNull(), F.struct(
                (F.col("_i") * width + s).alias("i"), F.col(f"c{s}").alias("node"),
                F.concat(F.slice(F.array(*siblings), F.lit(1), levels), F.col("_proof")).alias("proof"))))
        rows = joined.select("_group", "_top", F.explode(F.array_compact(F.array(*children))).alias("_c")).select(
            "_group", F.col("_c.i").alias("_i"), F.col("_c.node").alias("_node"), F.col("_c.proof").alias("_proof"), "_top")
        above = rows if pivots is steps[0] else materialize(rows, "merkle-proofs")
    return above


def proof_digest(proof: Column) -> Column:
    """Digest of all siblings of a proof, from the leaf to the root and left to right."""
    return F.sha2(F.array_join(F.transform(proof, lambda p: F.concat(p["left"], p["right"])), ""), 256)


def folded(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and its proof give."""
    return F.aggregate(proof, leaf, lambda h, p: F.sha2(F.concat(p["left"], h, p["right"]), 256))


def verify_tampered(docs: DataFrame, modulus: int = 7) -> DataFrame:
    """The manifest of ``docs``, and the roots after n_chars of some rows was raised by one.

    Tampered are the rows whose crc32 of the decimal doc_id is divisible by ``modulus``; a null doc_id
    is not, and a null n_chars stays null, so that its row still verifies.
    """
    more = F.col("n_chars").cast("decimal(38,0)") + 1
    changed = leaf_digest(F.col("doc_id"), F.col("source"), F.col("lang"), more, F.col("text"))
    rows = manifest(docs, extra={"changed": F.when(fold(F.col("doc_id"), modulus) == 0, changed)})
    root = folded(F.coalesce("changed", "leaf"), F.col("proof"))
    return rows.select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("proof")).alias("proof_sha256"),
                       root.alias("folded_root")).withColumn("verified", F.col("folded_root") == F.col("root"))


def oracle() -> str:
    """The result in SQL: trees and folds are recursive queries, crc32 goes digit by digit."""
    def field(value: str) -> str:
        return f"coalesce(strlen({value}::varchar)::varchar || ':' || {value}::varchar, '-')"

    def leaf(chars: str) -> str:
        return "sha256(" + " || ".join(field(chars if f == "n_chars" else f) for f in FIELDS) + ")"

    def tree(name: str, base: str) -> str:
        return f"""
{name} AS (
  SELECT 0 AS lvl, g, i, h, n FROM {base}
  UNION ALL
  SELECT lvl + 1, g, i // 2, sha256(string_agg(h, '' ORDER BY i)), (n + 1) // 2
  FROM {name} WHERE n > 1 GROUP BY lvl, g, i // 2, n
)"""

    def walk(name: str, base: str, nodes: str) -> str:
        # Up one level at a time: siblings so far, and the hash of the folded leaf.
        sibling = "CASE WHEN {0} THEN coalesce(s.h, '') ELSE '' END"
        left, right = sibling.format("w.i % 2 = 1"), sibling.format("w.i % 2 = 0")
        return f"""
{name} AS (
  SELECT id, g, 0 AS lvl, i, n, h, changed, proof FROM {base}
  UNION ALL
  SELECT w.id, w.g, w.lvl + 1, w.i // 2, (w.n + 1) // 2, w.h,
    sha256({left} || w.changed || {right}), w.proof || coalesce(s.h, '')
  FROM {name} w LEFT JOIN {nodes} s
    ON s.g = w.g AND s.lvl = w.lvl AND s.i = CASE WHEN w.i % 2 = 0 THEN w.i + 1 ELSE w.i - 1 END
  WHERE w.n > 1
)"""

    return f"""
WITH RECURSIVE crc_table AS (
  SELECT list(list_reduce(list_concat([b], range(8)), lambda c, k:
    CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY b) AS t
  FROM (SELECT range::bigint AS b FROM range(256))
),
rows AS (
  SELECT row_number() OVER () AS id, doc_id, coalesce('=' || lang, '') AS g, {leaf('n_chars')} AS h,
    {leaf('(n_chars::hugeint + 1)')} AS tampered,
    xor(list_reduce(list_concat([4294967295::bigint], list_transform(string_split(doc_id::varchar, ''), lambda c: ascii(c)::bigint)),
      lambda a, c: xor(a >> 8, t[1 + (xor(a, c) & 255)])), 4294967295) % 7 = 0 AS chosen
  FROM documents, crc_table
),
leaves AS (
  SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, h, id) - 1 AS i, count(*) OVER (PARTITION BY g) AS n,
    CASE WHEN chosen THEN tampered ELSE h END AS changed, '' AS proof
  FROM rows
),{tree('lang_nodes', 'leaves')},{walk('lang_walk', 'leaves', 'lang_nodes')},
subroots AS (
  SELECT g AS lang, 0 AS g, h, row_number() OVER (ORDER BY encode(g)) - 1 AS i, count(*) OVER () AS n
  FROM lang_nodes WHERE n = 1
),{tree('top_nodes', 'subroots')},
tops AS (
  SELECT w.id, s.g, s.i, s.n, w.h, w.changed, w.proof FROM lang_walk w JOIN subroots s ON s.lang = w.g WHERE w.n = 1
),{walk('top_walk', 'tops', 'top_nodes')}
SELECT l.doc_id, l.h AS leaf, s.h AS subroot, r.h AS root, sha256(w.proof) AS proof_sha256,
  w.changed AS folded_root, w.changed = r.h AS verified
FROM top_walk w JOIN leaves l ON l.id = w.id JOIN subroots s ON s.lang = l.g, (SELECT h FROM top_nodes WHERE n = 1) r
WHERE w.n = 1
"""
