"""Benchmark decontamination: find test n-grams in training text, drop documents or cut spans.

The normalised windows of the benchmark are a hash set that is broadcast to the scan of the
documents: their 64-bit hashes in order, and for each the place of the window in the normalised text,
against which a hit is verified word by word. That is about three times the text. A benchmark larger
than ``max_bytes`` is taken in blocks of that size, one scan each, whose hits are merged by document
row, so what is broadcast never grows with the data.
"""

from __future__ import annotations

import re
from functools import reduce

import numpy as np
import xxhash
from pyspark.sql import DataFrame, functions as F

from provtrail.llm.common import free_names, map_batches, map_rows, mixed, plain_words, slices, small, utf8
from provtrail.session import materialize

WIDTH = 10
#: Bytes of benchmark text in a block.
BLOCK_BYTES = 32 << 20
_MEMORY = 100_000
_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")


class Windows:
    """Hash set of benchmark windows. ``items`` are pairs (item id, UTF-8 text)."""

    def __init__(self, items, width: int):
        self.ids, texts, self.firsts, at = [], [], [], 0
        found: dict[int, list] = {}
        for item, text in items:
            words = plain_words(text)
            if not words:
                continue
            size = min(width, len(words))
            lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
            # Words stand behind one another with a space between, items with a line feed.
            places = at + np.cumsum(lengths + 1) - lengths - 1
            found.setdefault(size, []).append((_hashes(_codes(words), size), places[:len(words) - size + 1].astype(np.uint32)))
            self.ids.append(item)
            self.firsts.append(at)
            texts.append(b" ".join(words) + b"\n")
            at += len(texts[-1])
        self.text, self.firsts = b"".join(texts), np.array(self.firsts, dtype=np.int64)
        #: By window size: hashes in order, their places, and bits of the hashes in use.
        self.sets = {}
        for size, parts in found.items():
            hashes, places = (np.concatenate(column) for column in zip(*parts))
            order = np.argsort(hashes, kind="stable")
            hashes, places = hashes[order], places[order]
            bits = 1 << 20
            while bits < 8 * len(hashes):
                bits *= 2
            used = np.zeros(bits >> 6, dtype=np.uint64)
            slots = hashes & np.uint64(bits - 1)
            np.bitwise_or.at(used, (slots >> np.uint64(6)).astype(np.int64), np.uint64(1) << (slots & np.uint64(63)))
            self.sets[size] = (hashes, places, used)

    def nbytes(self) -> int:
        return len(self.text) + sum(a.nbytes for arrays in self.sets.values() for a in arrays)

    def hits(self, words: list[bytes]) -> list[tuple[int, int, set]]:
        """Occurrences: (first word, number of words, items)."""
        codes, found = _codes(words), []
        for size, (hashes, places, used) in self.sets.items():
            if len(words) < size:
                continue
            own = _hashes(codes, size)
            slots = own & np.uint64(len(used) * 64 - 1)
            maybe = np.flatnonzero(used[(slots >> np.uint64(6)).astype(np.int64)] >> (slots & np.uint64(63)) & np.uint64(1))
            low, high = (np.searchsorted(hashes, own[maybe], side) for side in ("left", "right"))
            for i, a, b in zip(maybe.tolist(), low.tolist(), high.tolist()):
                if a < b:
                    window = b" ".join(words[i:i + size])
                    same = [p for p in places[a:b].tolist() if self._stands(window, p)]
                    if same:
                        of = np.searchsorted(self.firsts, same, side="right") - 1
                        found.append((i, size, {self.ids[k] for k in of.tolist()}))
        return found

    def _stands(self, window: bytes, place: int) -> bool:
        end = place + len(window)
        return self.text[place:end] == window and self.text[end:end + 1] in (b" ", b"\n")


_KNOWN: dict[bytes, int] = {}


def _codes(words: list[bytes]) -> np.ndarray:
    """64-bit hashes of words; some are remembered."""
    if len(_KNOWN) > _MEMORY:
        _KNOWN.clear()
    for w in set(words).difference(_KNOWN):
        _KNOWN[w] = xxhash.xxh3_64_intdigest(w)
    return np.fromiter(map(_KNOWN.__getitem__, words), dtype=np.uint64, count=len(words))


def _hashes(codes: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all windows of ``size`` words."""
    n = len(codes) - size + 1
    total = np.zeros(n, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for j in range(size):
            total += codes[j:j + n] * np.uint64(2 * j * j + 6 * j + 0x9E3779B97F4A7C15)
    return mixed(total)


class _blocks:
    """The benchmark's (item id, UTF-8 text) in parts of about ``max_bytes``, one read at a time."""

    def __init__(self, benchmark: DataFrame, item_col: str, text_col: str, max_bytes: int):
        self.items = benchmark.select(F.col(item_col).alias("i"), F.col(text_col).alias("t")).filter("t is not null")
        size = self.items.agg(F.coalesce(F.sum(F.octet_length("t")), F.lit(0))).first()[0]
        self.n = max(1, -(-size // max_bytes))

    def __len__(self) -> int:
        return self.n

    def __iter__(self):
        for b in range(self.n):
            part = self.items.filter(F.pmod(F.hash("i", "t"), F.lit(self.n)) == b) if self.n > 1 else self.items
            yield [(r["i"], r["t"].encode()) for r in part.toLocalIterator()]


def find_hits(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text", width: int = WIDTH, max_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """One row per document row: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, spans.

    A window is ``width`` consecutive item words; an item of fewer words, but not none, is one
    window. ``spans`` holds the hit words as merged pairs [first, end). Null and empty texts have
    no words and no hits; null benchmark texts are no items; an item with a null id hits words but
    is in no list of items. Repeated items count once. Repeated document rows are each answered;
    for a benchmark of several blocks the documents are written once with a key for each row.
    """
    sc = docs.sparkSession.sparkContext
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    blocks = _blocks(benchmark, item_col, item_text_col, max_bytes)
    several = len(blocks) > 1
    schema = "doc_id long, n_words long, starts array<int>, sizes array<int>, items array<string>"
    if several:
        source = materialize(source.withColumn("row", F.monotonically_increasing_id()), "documents")
        schema = "row long, " + schema
    parts = []
    for block in blocks:
        windows = sc.broadcast(Windows(block, width))

        def scan(batch, windows=windows):
            found = windows.value
            out = {k: [] for k in ("n_words", "starts", "sizes", "items")}
            for text in utf8(batch.column(1)):
                words = plain_words(text)
                hits = found.hits(words) if words else []
                # Windows that touch become one span.
                starts, sizes = [], []
                for i, n, _ in sorted(hits, key=lambda h: h[0]):
                    if starts and i <= starts[-1] + sizes[-1]:
                        sizes[-1] = max(sizes[-1], i + n - starts[-1])
                    else:
                        starts.append(i)
                        sizes.append(n)
                out["n_words"].append(len(words))
                out["starts"].append(starts)
                out["sizes"].append(sizes)
                out["items"].append(sorted({str(x) for h in hits for x in h[2] if x is not None}))
            return {"doc_id": batch.column(0), **out, **({"row": batch.column(2)} if several else {})}

        parts.append(map_rows(source, scan, schema))
    rows = parts[0]
    if several:
        for part in parts[1:]:
            rows = rows.union(part)
        rows = rows.groupBy("row").agg(
            F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"), F.flatten(F.collect_list("starts")).alias("starts"),
            F.flatten(F.collect_list("sizes")).alias("sizes"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    spans = F.aggregate(
        F.array_sort(F.arrays_zip("starts", "sizes")), F.expr("cast(array() as array<struct<first:int,end:int>>)"),
        lambda done, s: F.when(
            (F.size(done) > 0) & (s["starts"] <= F.element_at(done, -1)["end"]),
            F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.struct(
                F.element_at(done, -1)["first"].alias("first"),
                F.greatest(F.element_at(done, -1)["end"], s["starts"] + s["sizes"]).alias("end")))),
        ).otherwise(F.concat(done, F.array(F.struct(
            s["starts"].alias("first"), (s["starts"] + s["sizes"]).alias("end"))))))
    rows = rows.withColumn("spans", spans)
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda t, s: t + (s["end"] - s["first"]))
    return rows.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"), "spans")


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, action: str = "document", text_col: str = "text",
    item_text_col: str = "text", width: int = WIDTH, max_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``docs`` with its own columns, without contaminated rows or without hit spans.

    ``action="document"`` drops rows with a hit; ``"span"`` cuts the hit words out of the text and
    keeps every row. All other rows, also null and empty texts, stay as they are. With several
    blocks, spans are found in the whole text by all blocks before anything is cut.
    """
    if action not in ("document", "span"):
        raise ValueError(f"action {action!r}")
    sc = docs.sparkSession.sparkContext
    at = docs.columns.index(text_col)
    blocks = _blocks(benchmark, "item_id", item_text_col, max_bytes)
    if len(blocks) > 1:
        return _by_blocks(docs, blocks, at, width, action)
    windows = sc.broadcast(Windows(next(iter(blocks)), width))

    def scan(batches):
        import pyarrow as pa

        for batch in slices(batches):
            texts = utf8(batch.column(at))
            hits = [windows.value.hits(plain_words(t)) if t else [] for t in texts]
            if action == "document":
                yield batch.filter(pa.array([not h for h in hits], pa.bool_()))
            elif any(hits):
                column = pa.array([cut(t, h) if h else t for t, h in zip(texts, hits)], pa.binary())
                yield batch.set_column(at, batch.schema.field(at), column.cast(batch.schema.field(at).type))
            else:
                yield batch

    return map_batches(docs, scan, docs.schema)


def _by_blocks(docs: DataFrame, blocks, at: int, width: int, action: str) -> DataFrame:
    """``decontaminate`` for several blocks: the documents are written once with a number for each row,
    every block is a scan of its own, and rows or spans go by the numbers of the hits of all blocks."""
    own, of, hits = free_names(docs, "_row", "_of", "_hits")
    sc = docs.sparkSession.sparkContext
    rows = materialize(docs.withColumn(own, F.monotonically_increasing_id()), "documents")
    texts = rows.select(F.col(own).alias(of), F.col(docs.columns[at]).alias("text"))
    found = []
    for block in blocks:
        windows = sc.broadcast(Windows(block, width))

        def scan(batch, windows=windows):
            own_hits = [windows.value.hits(plain_words(t)) if t else [] for t in utf8(batch.column(1))]
            some = [(row, [{"first": i, "n": n} for i, n, _ in h]) for row, h in zip(batch.column(0).to_pylist(), own_hits) if h]
            return {of: [row for row, _ in some], hits: [h for _, h in some]}

        found.append(map_rows(texts, scan, f"`{of}` long, `{hits}` array<struct<first:int,n:int>>"))
    merged = reduce(DataFrame.union, found).groupBy(of).agg(F.flatten(F.collect_list(hits)).alias(hits))
    merged = materialize(merged, "benchmark-hits")
    same = F.col(own) == F.col(of)
    if action == "document":
        return rows.join(small(merged.select(of)), same, "left_anti").drop(own)
    columns = docs.columns

    def cut_all(batches):
        import pyarrow as pa

        for batch in slices(batches):
            spans = [[(h["first"], h["n"], None) for h in x] if x else [] for x in batch.column(batch.num_columns - 1).to_pylist()]
            field = batch.schema.field(at)
            column = pa.array([cut(t, h) if h else t for t, h in zip(utf8(batch.column(at)), spans)], pa.binary())
            yield batch.set_column(at, field, column.cast(field.type)).select(columns)

    return map_batches(rows.join(small(merged), same, "left").select(*columns, hits), cut_all, docs.schema)


def cut(text: bytes, hits) -> bytes:
    """Text without its hit words and what stands between them."""
    words = [m.span() for m in _WORD.finditer(text)]
    out, at = [], 0
    for i, n, _ in sorted(hits, key=lambda h: h[0]):
        first, end = words[i][0], words[i + n - 1][1]
        if first > at:
            out.append(text[at:first])
        at = max(at, end)
    return b"".join([*out, text[at:]])


def oracle(width: int = WIDTH) -> str:
    """DuckDB SQL for the rows of ``find_hits`` without ``spans``: all windows of both tables as text."""
    words = r"""list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
  'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"""
    return f"""
WITH d AS MATERIALIZED (SELECT doc_id, {words} AS w FROM documents),
b AS (SELECT item_id, {words} AS w FROM benchmark),
bw AS (SELECT item_id, least(len(w), {width}) AS n, unnest(range(1, len(w) - least(len(w), {width}) + 2)) AS i, w FROM b WHERE len(w) > 0),
bt AS MATERIALIZED (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS t FROM bw),
sizes AS (SELECT DISTINCT n FROM bt),
dw AS (SELECT doc_id, n, w, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n),
hits AS MATERIALIZED (SELECT doc_id, dw.n, i, item_id FROM dw JOIN bt ON bt.n = dw.n AND bt.t = array_to_string(w[i:i + dw.n - 1], ' ')),
places AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS s FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS s FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN places USING (doc_id) LEFT JOIN items USING (doc_id)"""
