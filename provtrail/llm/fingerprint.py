"""I-Match document fingerprints.

Terms whose inverse document frequency lies in a band make up the lexicon; frequencies are counted
for each term over all documents. A document's distinct lexicon terms are sorted and hashed once for
each of several random subsets of the lexicon; the fingerprint is the list of these hashes. Subsets of
four densities are used, since a sparse subset tells long near copies apart and a dense one short
ones. A document without any lexicon term is fingerprinted by all its terms.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, functions as F

from provtrail.llm.common import map_batches, mixed, plain_words, utf8
from provtrail.session import materialize

#: The band: terms in two documents and this share at least, and in that share at most. As documents
#: have so many distinct terms on average, the lexicon has that many divided by the lower share at most.
MIN_SHARE, MAX_SHARE = 3e-4, 0.05
_HELD_TERMS = 2_000_000
#: Share of the lexicon in a subset, by level, and subsets at each level.
LEVELS = (1 / 2, 1 / 8, 1 / 32, 1 / 128)
SUBSETS = 16
ROWS_PER_RANGE = 20_000
_MEMORY = 500_000


class Terms:
    """Distinct term hashes of texts; remembers word hashes, up to a bound."""

    def __init__(self):
        self.known: dict[bytes, int] = {}

    def of(self, text: bytes | None) -> np.ndarray:
        words = set(plain_words(text))
        if len(self.known) > _MEMORY:
            self.known = {}
        known = self.known
        for w in words:
            if w not in known:
                known[w] = xxhash.xxh3_64_intdigest(w)
        return np.sort(np.fromiter(map(known.__getitem__, words), dtype=np.uint64, count=len(words)))


def document_frequencies(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Rows (term, n): documents that hold a term, over all documents; null texts have no terms.

    A term is the 64-bit hash of a word. Tasks add up their documents before the shuffle.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, held, n = Terms(), [], 0

        def flush():
            found, times = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(times, pa.int64())], names=["term", "n"])

        for batch in batches:
            for text in utf8(batch.column(0)):
                held.append(terms.of(text))
                n += len(held[-1])
                if n >= _HELD_TERMS:
                    yield flush()
                    held, n = [], 0
        if n:
            yield flush()

    return map_batches(docs.select(text_col), count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))


class Lexicon:
    """Fingerprints by a fixed lexicon, given as the sorted hashes of its terms."""

    def __init__(self, used: np.ndarray):
        self.used = np.append(used, ~np.uint64(0))
        self.keys = mixed(np.arange(1, len(LEVELS) * SUBSETS + 1, dtype=np.uint64))
        share = np.repeat(np.array(LEVELS), SUBSETS)
        self.limits = (share * float(1 << 63)).astype(np.uint64) * np.uint64(2)

    def fingerprint(self, terms: np.ndarray) -> str:
        """Four hex digits for each subset (0000: none of its terms); 16 more digits, of all the terms,
        if none of them is in the lexicon."""
        kept = terms[self.used[np.searchsorted(self.used[:-1], terms)] == terms]
        with np.errstate(over="ignore"):
            drawn = mixed(kept[None, :] ^ self.keys[:, None]) < self.limits[:, None]
            # The terms are distinct, so the sum of their mixed hashes stands for the sorted list.
            sums = (drawn * mixed(kept + np.uint64(0x9E3779B97F4A7C15))[None, :]).sum(axis=1, dtype=np.uint64)
        codes = (mixed(sums) >> np.uint64(48)).astype(np.int64)
        codes = np.where(drawn.any(axis=1), np.maximum(codes, 1), 0)
        out = codes.astype(">u2").tobytes().hex()
        return out if len(kept) else out + f"{xxhash.xxh3_64_intdigest(terms.tobytes()):016x}"


def likeness(a: str, b: str) -> float:
    """1 for equal fingerprints; else the share of equal hashes, among the subsets of which either
    text has terms, at the sparsest level at which those are half of the subsets and at all sparser
    levels (at all levels, if there is no such level)."""
    if a == b:
        return 1.0
    digits = 4 * len(LEVELS) * SUBSETS
    x, y = (np.frombuffer(bytes.fromhex(f[:digits]), ">u2").reshape(len(LEVELS), SUBSETS) for f in (a, b))
    some = (x > 0) | (y > 0)
    full = np.flatnonzero(2 * some.sum(axis=1) >= SUBSETS)
    low = full[-1] if len(full) else 0
    some[:low] = False
    return float((x[some] == y[some]).mean()) if some.any() else 0.0


def fit_lexicon(
    docs: DataFrame, min_share: float = MIN_SHARE, max_share: float = MAX_SHARE, text_col: str = "text",
) -> np.ndarray:
    """The lexicon as sorted term hashes, from the frequencies in all documents."""
    counts = materialize(document_frequencies(docs, text_col), "term-counts")
    n = docs.count()
    band = counts.filter((F.col("n") >= max(2, min_share * n)) & (F.col("n") <= max(2, max_share * n)))
    return np.sort(band.select("term").toArrow()["term"].to_numpy().view(np.uint64))


def fingerprint_edits(docs: DataFrame, used: np.ndarray, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """One row per document row: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The next document is the one before in ascending order of doc_id (for the first, the last); its
    first code points replace the last third of the text. Null texts are empty; null ids come first
    in ascending order; rows of one id are in any fixed order. Texts travel once, compressed, to ranges
    of ids, one task each and sorted by id; the largest row of a range is also sent to the next range.
    """
    spark = docs.sparkSession
    rows = docs.select("doc_id", "text")
    ids = docs.select("doc_id")
    parts = max(1, -(-ids.count() // rows_per_range))
    shares = [i / parts for i in range(1, parts)]
    borders = ids.agg(F.percentile_approx("doc_id", shares, max(1000, 20 * parts)).alias("b")).first()["b"] if shares else []
    borders = np.array(sorted(set(borders or [])), dtype=np.int64)

    def range_of(column: pa.Array) -> np.ndarray:
        """Ranges begin at borders; null ids are in the first."""
        filled = column.fill_null(-(1 << 63)).to_numpy(zero_copy_only=False)
        return np.searchsorted(borders, filled, side="right")

    def extent(batches):
        for batch in batches:
            place = range_of(batch.column(0))
            yield pa.RecordBatch.from_arrays([pa.array(place.astype(np.int32)), batch.column(0)], names=["r", "doc_id"])

    filled = map_batches(ids, extent, "r int, doc_id long").groupBy("r").agg(F.max("doc_id").alias("top")).collect()
    # One row per range: where its largest document is also needed, as the one before.
    order = sorted((r["r"], r["top"]) for r in filled)
    place_of = {r: i for i, (r, _) in enumerate(order)}
    top = {i: t for i, (_, t) in enumerate(order)}

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            place = [place_of[r] for r in range_of(batch.column(0)).tolist()]
            out = ([], [], [], [])
            for doc, text, r in zip(batch.column(0).to_pylist(), utf8(batch.column(1)), place):
                packed = squeeze(text or b"")
                for where, before in ((r, 0), ((r + 1) % len(top), 1)) if doc == top[r] else ((r, 0),):
                    for column, value in zip(out, (where, doc, 1 - before, packed)):
                        column.append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[0], pa.int32()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.int32()), pa.array(out[3], pa.binary())],
                names=["r", "doc_id", "own", "packed"])

    sent = map_batches(rows, send, "r int, doc_id long, own int, packed binary")
    # Rows sent ahead sort first in their range; the last of them is the one before.
    sent = sent.repartitionById(max(1, len(order)), "r").sortWithinPartitions("r", "own", "doc_id", "packed")
    shared = spark.sparkContext.broadcast(used)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon, terms = Lexicon(shared.value), Terms()
        unsqueeze = zstandard.ZstdDecompressor().decompress
        place, before, before_print = None, b"", ""
        for batch in batches:
            out = {k: [] for k in ("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")}
            for r, doc, own, packed in zip(*(c.to_pylist() for c in batch.columns)):
                if r != place:
                    place, before, before_print = r, b"", ""
                text = unsqueeze(packed)
                print_ = lexicon.fingerprint(terms.of(text))
                if own:
                    whole = text.decode()
                    third = len(whole) // 3
                    edited = (whole[:len(whole) - third] + before.decode()[:third]).encode()
                    edited_print = lexicon.fingerprint(terms.of(edited))
                    for k, v in zip(out, (doc, len(whole), hashlib.sha256(edited).hexdigest(), print_, edited_print,
                                          likeness(print_, edited_print), likeness(print_, before_print))):
                        out[k].append(v)
                before, before_print = text, print_
            yield pa.RecordBatch.from_pydict(out, schema=schema)

    schema = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
                        ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())])
    return map_batches(sent, read, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
                                 "edited_fingerprint string, near_edited double, near_next double")
