"""N-gram Jaccard join with signature trees.

1.  Each document becomes its set of word shingles (64-bit hashes). Documents with equal sets are
    one class and only its smallest id goes on.
2.  Keys: of the 64 smallest hashes of a set (of all, for a smaller one) a linked pair has 20 or
    more in common, or 5 in 16 of a smaller set: it has 48 on average, and fewer than 20 with a
    probability of 3e-14 at similarity 0.75, less above. So one common hash is left if each set
    goes without the 19 that most classes have. Those 45 are its keys. Keys that only one class
    has are dropped, and with them most documents; passages that many documents share drop out
    unless they make up a third of a document.
3.  Cells: classes chained by keys. A linked pair is always in one cell, so a set is shipped once.
4.  In a cell a signature tree is built and traversed against itself. A cell too large for a task
    is cut into blocks. Blocks are joined inside first; a second pass then joins only the members
    outside the largest component of their cell with all others, block by block.
5.  Components of the links, and members of a class get its component.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from provtrail.llm.common import components, free_names, map_batches, map_rows, mixed, small, space_words, utf8
from provtrail.session import materialize

SHINGLE = 5
#: Similarity as a fraction.
SIM = (75, 100)
SKETCH = 64
#: Of a sketch of m hashes, two linked sets share m * 5 // 16 at least.
SHARED = (5, 16)
#: Shingles that a task holds of one block.
BLOCK_SHINGLES = 2_000_000
FANOUT = 16
_MEMORY = 100_000


class Hasher:
    """Shingle sets of texts; remembers word hashes, up to a bound."""

    def __init__(self, size: int):
        self.size, self.known = size, {}
        self.factors = mixed(np.arange(101, 101 + size, dtype=np.uint64)) | np.uint64(1)

    def shingles(self, text: bytes | None) -> np.ndarray:
        """Sorted distinct hashes."""
        words = space_words(text)
        if not words:
            return np.zeros(0, dtype=np.uint64)
        if len(self.known) > _MEMORY:
            self.known = {}
        known = self.known
        for w in set(words):
            if w not in known:
                known[w] = xxhash.xxh3_64_intdigest(w)
        codes = np.fromiter(map(known.__getitem__, words), dtype=np.uint64, count=len(words))
        size = min(self.size, len(codes))
        n = len(codes) - size + 1
        total = np.full(n, size, dtype=np.uint64)
        with np.errstate(over="ignore"):
            for j in range(size):
                total += codes[j:j + n] * self.factors[j]
        return np.unique(mixed(total))


def _sets(docs: DataFrame, size: int) -> DataFrame:
    """doc_id, n_shingles, set_key (null for an empty set), keys."""
    state: dict = {}

    def scan(batch):
        hasher = state.setdefault("hasher", Hasher(size))
        out = {k: [] for k in ("n_shingles", "set_key", "keys")}
        for text in utf8(batch.column(1)):
            found = hasher.shingles(text)
            out["n_shingles"].append(len(found))
            out["set_key"].append(xxhash.xxh3_128_digest(found.tobytes()) if len(found) else None)
            out["keys"].append(found[:SKETCH].view(np.int64).tolist())
        return {"doc_id": batch.column(0), **out}

    return map_rows(docs, scan, "doc_id long, n_shingles long, set_key binary, keys array<long>")


class Tree:
    """A signature tree over sets: leaves of FANOUT sets in order of size and smallest hashes, inner
    nodes of FANOUT nodes; a node has the OR of its bitmaps and its ranges of size."""

    def __init__(self, sets: list[np.ndarray]):
        self.sets = sets
        self.sizes = np.array([len(s) for s in sets], dtype=np.int64)
        # Near sets share their smallest hashes, so sorting by them brings near sets together.
        order = sorted(range(len(sets)), key=lambda i: (int(sets[i][0]), int(sets[i][min(1, len(sets[i]) - 1)]), len(sets[i])))
        self.order = np.array(order)
        bits = 256
        while bits < 8192 and bits < 4 * int(np.median(self.sizes)):
            bits *= 2
        self.bitmaps = np.zeros((len(sets), bits // 64), dtype=np.uint64)
        for i, s in enumerate(sets):
            place = (s >> np.uint64(7)) % np.uint64(bits)
            np.bitwise_or.at(self.bitmaps[i], (place // np.uint64(64)).astype(np.int64), np.uint64(1) << (place % np.uint64(64)))
        own = np.bitwise_count(self.bitmaps).sum(axis=1, dtype=np.int64)
        # Hashes of a set beyond its distinct bits: they may all be shared unseen.
        self.hidden = self.sizes - own
        # Levels from the leaves up: rows of (bitmap, smallest, largest, most hidden), children in order.
        ordered = self.order
        maps, low, high, hidden = self.bitmaps[ordered], self.sizes[ordered], self.sizes[ordered], self.hidden[ordered]
        self.levels = []
        while True:
            cuts = np.arange(0, len(maps), FANOUT)
            maps = np.bitwise_or.reduceat(maps, cuts, axis=0)
            low, high = np.minimum.reduceat(low, cuts), np.maximum.reduceat(high, cuts)
            hidden = np.maximum.reduceat(hidden, cuts)
            self.levels.append((maps, low, high, hidden))
            if len(maps) == 1:
                break

    def may_link(self, level: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether node pairs can hold a link, by size ranges and the largest possible overlap."""
        maps, low, high, hidden = self.levels[level]
        return _possible(maps[a], maps[b], low[a], low[b], high[a], high[b], np.minimum(hidden[a], hidden[b]))


def _possible(map_a, map_b, low_a, low_b, high_a, high_b, hidden) -> np.ndarray:
    most = np.bitwise_count(map_a & map_b).sum(axis=-1, dtype=np.int64) + hidden
    p, q = SIM
    # |x & y| / |x | y| >= p / q  <=>  (p + q) |x & y| >= p (|x| + |y|)
    return (q * high_a >= p * low_b) & (q * high_b >= p * low_a) & ((p + q) * most >= p * (low_a + low_b))


class Links:
    """Dual traversal of a tree with itself; keeps one link for each two components it joins."""

    def __init__(self, tree: Tree, side: np.ndarray | None = None, label: np.ndarray | None = None):
        """side: link only pairs of which one member has side 1. label: components known before."""
        self.tree, self.side = tree, side
        self.root = np.arange(len(tree.sets)) if label is None else np.unique(label, return_inverse=True)[1]
        self.found: list[tuple[int, int]] = []

    def run(self) -> list[tuple[int, int]]:
        top = len(self.tree.levels) - 1
        pairs = (np.zeros(1, dtype=np.int64), np.zeros(1, dtype=np.int64))
        self._visit(top, *pairs)
        return self.found

    def _visit(self, level: int, a: np.ndarray, b: np.ndarray) -> None:
        # Few node pairs at once, so that memory stays small however large the block.
        for i in range(0, len(a), 4096):
            x, y = a[i:i + 4096], b[i:i + 4096]
            keep = self.tree.may_link(level, x, y)
            x, y = x[keep], y[keep]
            if not len(x):
                continue
            if level == 0:
                for u, v in zip(x.tolist(), y.tolist()):
                    self._leaves(u, v)
                continue
            n = len(self.tree.levels[level - 1][0])
            steps = np.arange(FANOUT)
            u = np.repeat(x * FANOUT, FANOUT * FANOUT) + np.tile(np.repeat(steps, FANOUT), len(x))
            v = np.repeat(y * FANOUT, FANOUT * FANOUT) + np.tile(steps, FANOUT * len(x))
            good = (u <= v) & (v < n) & (u < n)
            self._visit(level - 1, u[good], v[good])

    def _leaves(self, u: int, v: int) -> None:
        tree = self.tree
        a = tree.order[u * FANOUT:(u + 1) * FANOUT]
        b = tree.order[v * FANOUT:(v + 1) * FANOUT]
        open_ = self.root[a][:, None] != self.root[b][None, :]
        if u == v:
            open_ &= np.arange(len(a))[:, None] < np.arange(len(b))[None, :]
        if self.side is not None:
            open_ &= (self.side[a][:, None] | self.side[b][None, :]).astype(bool)
        if not open_.any():
            return
        i, j = np.nonzero(open_)
        x, y = a[i], b[j]
        keep = _possible(tree.bitmaps[x], tree.bitmaps[y], tree.sizes[x], tree.sizes[y], tree.sizes[x], tree.sizes[y],
                         np.minimum(tree.hidden[x], tree.hidden[y]))
        for p, q in zip(x[keep].tolist(), y[keep].tolist()):
            if self.root[p] != self.root[q] and linked(tree.sets[p], tree.sets[q]):
                self.found.append((p, q))
                self.root[self.root == self.root[q]] = self.root[p]


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    """Exact similarity of two sorted sets of hashes."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = len(b) - 1
    common = int((b[at] == a).sum())
    return SIM[1] * common >= SIM[0] * (len(a) + len(b) - common)


def _join_blocks(rows: DataFrame) -> DataFrame:
    """Links inside each (cell, block): rows are cell, block, doc_id, side, label, shingles.

    Rows stream sorted by block, so one block is in memory at a time.
    """
    ordered = rows.select("cell", "block", "doc_id", "side", "label", "shingles").repartition("cell", "block")
    ordered = ordered.sortWithinPartitions("cell", "block", "doc_id")

    def join(held) -> pa.RecordBatch | None:
        if len(held) < 2:
            return None
        ids = [h[0] for h in held]
        found = Links(Tree([h[3] for h in held]), np.array([h[1] for h in held]), np.array([h[2] for h in held])).run()
        return pa.RecordBatch.from_arrays(
            [pa.array([ids[p] for p, _ in found], pa.int64()), pa.array([ids[q] for _, q in found], pa.int64())], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []
        for batch in batches:
            cells, blocks, ids, sides, labels = (batch.column(i).to_pylist() for i in range(5))
            for i, shingles in enumerate(batch.column(5).to_pylist()):
                if (cells[i], blocks[i]) != key:
                    if (out := join(held)) is not None:
                        yield out
                    key, held = (cells[i], blocks[i]), []
                held.append((ids[i], sides[i], labels[i], np.frombuffer(shingles, dtype=np.uint64)))
        if (out := join(held)) is not None:
            yield out

    return map_batches(ordered, run, "a long, b long")


def jaccard_components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE,
    block_shingles: int = BLOCK_SHINGLES,
) -> DataFrame:
    """One row per document row: doc_id, n_shingles, component_id.

    Null and empty texts and texts without words have no shingles and are alone. A null id is never
    linked and has a null component. Rows that repeat an id are one document if their texts agree;
    if not, the id links what either text links. An empty table gives no rows.
    """
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    sets = materialize(_sets(texts, size), "jaccard-sets")
    usable = sets.filter("set_key is not null and doc_id is not null")
    classes = usable.groupBy("set_key").agg(F.min("doc_id").alias("rep"))
    members = materialize(
        usable.select("doc_id", "set_key").join(classes, "set_key").select("doc_id", "rep"), "jaccard-members")
    reps = members.filter("doc_id = rep").select("rep").distinct()
    # Hashes that two classes have; of those, each class keeps the rarest as keys.
    sketch = usable.join(reps, F.col("doc_id") == F.col("rep"), "left_semi").select("doc_id", "set_key", F.explode("keys").alias("key"))
    often = sketch.groupBy("key").agg(F.count("*").alias("df")).filter("df > 1")
    common = F.array_sort(F.collect_list(F.struct("df", "key")))
    held = F.floor(F.least(F.max("n_shingles"), F.lit(SKETCH)) * SHARED[0] / SHARED[1])
    kept = sketch.join(often, "key").join(usable.select("doc_id", "set_key", "n_shingles").distinct(), ["doc_id", "set_key"])
    kept = kept.groupBy("doc_id", "set_key").agg(common.alias("common"), F.greatest(held, F.lit(1)).cast("int").alias("held"))
    kept = materialize(kept.filter("size(common) >= held").select(
        "doc_id", F.explode(F.slice("common", 1, F.expr("size(common) - held + 1"))).alias("c")).select("doc_id", "c.key"), "jaccard-keys")
    low = kept.groupBy("key").agg(F.min("doc_id").alias("low"))
    chains = kept.join(low, "key").filter("low <> doc_id").select("doc_id", "low").distinct()
    chains = materialize(chains, "jaccard-chains")
    cells = components(chains.select(F.col("doc_id").alias("a"), F.col("low").alias("b")), "jaccard-cells").select(
        F.col("node").alias("doc_id"), F.col("component").alias("cell"))
    sized = materialize(cells.join(usable.groupBy("doc_id").agg(F.max("n_shingles").alias("n")), "doc_id"), "jaccard-sized")
    # The sets of the classes that share a key, made anew from their texts and shipped once.
    state: dict = {}

    def again(batch):
        hasher = state.setdefault("hasher", Hasher(size))
        return {"doc_id": batch.column(0), "shingles": [hasher.shingles(t).tobytes() for t in utf8(batch.column(1))]}

    wanted = texts.join(small(sized.select("doc_id")), "doc_id", "left_semi")
    full = map_rows(wanted, again, "doc_id long, shingles binary").filter("length(shingles) > 0")
    blocks = sized.groupBy("cell").agg(F.ceil(F.sum("n") / block_shingles).cast("int").alias("n_blocks"))
    placed = sized.join(blocks, "cell").withColumn("block", F.pmod(F.xxhash64("doc_id"), "n_blocks"))
    large = placed.filter("n_blocks > 1").limit(1).count() > 0
    if large:
        full = materialize(full, "jaccard-full")
    first = full.join(small(placed.select("doc_id", "cell", "block")), "doc_id").select(
        "cell", "block", "doc_id", F.lit(1).alias("side"), F.col("doc_id").alias("label"), "shingles")
    links = materialize(_join_blocks(first), "jaccard-links")
    if large:
        links = _across(full, placed.filter("n_blocks > 1"), links, block_shingles)
    joined = components(links.union(members.filter("doc_id <> rep").select("doc_id", "rep")), "jaccard-components")
    out = sets.select("doc_id", "n_shingles").join(
        joined.select(F.col("node").alias("doc_id"), F.col("component")), "doc_id", "left")
    return out.select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))


def _across(full: DataFrame, placed: DataFrame, links: DataFrame, block_shingles: int) -> DataFrame:
    """Links between the blocks of cells that are too large for one.

    First one member of each component and block meets the others of its cell, which joins the
    components that the blocks cut. Then each member outside the largest component of its cell
    meets all others: those members in blocks (R), each with every block of the rest (M) and with
    every other block of R. Pairs inside the largest component need no test.
    """
    def labelled(found: DataFrame) -> DataFrame:
        known = components(found, "jaccard-known")
        return placed.join(known.select(F.col("node").alias("doc_id"), "component"), "doc_id", "left").select(
            "doc_id", "cell", "block", "n", F.coalesce("component", "doc_id").alias("label"))

    while True:
        now = materialize(labelled(links), "jaccard-labelled")
        heads = now.groupBy("cell", "block", "label").agg(F.min(F.struct("doc_id", "n")).alias("h"), F.count("*").alias("m"))
        heads = heads.filter("m > 1").select("cell", "label", F.col("h.doc_id").alias("doc_id"), F.col("h.n").alias("n"))
        split = heads.groupBy("cell").agg(F.ceil(F.sum("n") / block_shingles).alias("n_blocks"), F.count_distinct("label").alias("k"))
        heads = heads.join(split.filter("k > 1"), "cell").withColumn("block", F.pmod(F.xxhash64("label"), "n_blocks"))
        more = materialize(_join_blocks(full.join(heads, "doc_id").select(
            "cell", "block", "doc_id", F.lit(1).alias("side"), "label", "shingles")), "jaccard-links")
        links = links.union(more)
        if not more.limit(1).count():
            break
    sizes = now.groupBy("cell", "label").agg(F.sum("n").alias("n"))
    largest = sizes.groupBy("cell").agg(F.max(F.struct("n", "label")).alias("top")).select(
        "cell", F.col("top.label").alias("main"), F.col("top.n").alias("main_n"))
    rest_n = sizes.join(largest, "cell").filter("label <> main").groupBy("cell").agg(F.sum("n").alias("rest_n"))
    plan = largest.join(rest_n, "cell").select(
        "cell", "main", F.ceil(F.col("main_n") / block_shingles).cast("int").alias("n_main"),
        F.ceil(F.col("rest_n") / block_shingles).cast("int").alias("n_rest"))
    spots = now.join(plan, "cell").withColumn("rest", (F.col("label") != F.col("main")).cast("int"))
    spots = spots.withColumn("own", F.pmod(F.xxhash64("doc_id", F.lit(7)), F.when(F.col("rest") == 1, F.col("n_rest")).otherwise(F.col("n_main"))).cast("int"))
    # Blocks of a pass: (R own, M other) and (R low, R high).
    with_main = F.when(
        F.col("rest") == 1, F.transform(F.sequence(F.lit(0), F.col("n_main") - 1), lambda m: F.format_string("m%d-%d", F.col("own"), m))
    ).otherwise(F.transform(F.sequence(F.lit(0), F.col("n_rest") - 1), lambda r: F.format_string("m%d-%d", r, F.col("own"))))
    with_rest = F.when(F.col("rest") == 1, F.transform(
        F.sequence(F.lit(0), F.col("n_rest") - 1),
        lambda r: F.format_string("r%d-%d", F.least(F.col("own"), r), F.greatest(F.col("own"), r)))).otherwise(F.array().cast("array<string>"))
    spread = spots.select("doc_id", "cell", "label", F.col("rest").alias("side"), F.explode(F.concat(with_main, with_rest)).alias("block"))
    more = materialize(_join_blocks(full.join(spread, "doc_id").select(
        "cell", "block", "doc_id", "side", "label", "shingles")), "jaccard-links")
    return links.union(more)


def keep_first(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with its own columns, one document of each component: that of the smallest id.

    Rows with a null id and rows without shingles stay. Of rows that repeat an id all stay or none.
    """
    gone = free_names(docs, "_gone")[0]
    found = materialize(jaccard_components(docs, **options).filter("component_id <> doc_id").select(
        F.col("doc_id").alias(gone)).distinct(), "jaccard-gone")
    return docs.join(small(found), F.col("doc_id") == F.col(gone), "left_anti")


def oracle() -> str:
    """DuckDB SQL for the rows of ``jaccard_components``: shared shingles of all pairs, then
    components by recursion."""
    return r"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array(
  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
s AS MATERIALIZED (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
  ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS g FROM w),
n AS (SELECT doc_id, len(g) AS n FROM s),
classes AS MATERIALIZED (SELECT min(doc_id) OVER (PARTITION BY list_sort(g)) AS rep, doc_id, g FROM s WHERE len(g) > 0),
u AS MATERIALIZED (SELECT doc_id, hash(unnest(g)) AS x FROM classes WHERE doc_id = rep),
often AS (SELECT x FROM u GROUP BY x HAVING count(*) > 1),
v AS MATERIALIZED (SELECT doc_id, x FROM u WHERE x IN (SELECT x FROM often)),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM v a JOIN v b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY ALL),
e AS MATERIALIZED (SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * c >= 75 * (na.n + nb.n - c)
  UNION SELECT rep, doc_id FROM classes WHERE rep <> doc_id),
e2 AS MATERIALIZED (SELECT a, b FROM e UNION SELECT b, a FROM e),
r(node, low) AS (SELECT a, a FROM e2 UNION SELECT e2.b, r.low FROM r JOIN e2 ON e2.a = r.node WHERE r.low < e2.b)
SELECT n.doc_id, CAST(n.n AS BIGINT) AS n_shingles, coalesce((SELECT min(low) FROM r WHERE r.node = n.doc_id), n.doc_id) AS component_id
FROM n"""
