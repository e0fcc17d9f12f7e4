"""Best-fit packing of documents into sequences of at most ``capacity`` tokens.

Only the histogram of piece lengths reaches the driver, ``capacity`` numbers. Best-fit decreasing runs
over its counts: sequences with equal room form ranges, and one step fills a whole range with pieces
of one length. The plan is a table of slots, each for a range of ranks within a length; pieces are
numbered within their length and take their slots by joining with it.

A length adds at most four ranges, and a range is filled by lengths that get smaller and sum up to
``capacity`` at most; so 1,024 tokens give at most 4,096 ranges of up to 45 slots each, 9 MB, which
are broadcast.
"""

from __future__ import annotations

import json
import zlib
from array import array
from collections import Counter
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from provtrail.llm.common import map_batches, small
from provtrail.llm.tokens import _SPELLED
from provtrail.session import materialize

CAPACITY = 1024
END_ID = 2
_REMEMBERED = 400_000
#: Texts that are encoded at once, and their bytes, unless a single one has more.
_ROWS, _BYTES = 2000, 8 << 20
#: ASCII marks: a run of them without letters behind is one piece of the pattern.
_MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_SPACE = _SPELLED[32]
_TABLE = dict(enumerate(_SPELLED))


class ByteEncoder:
    """Ids of whole texts by a byte-level BPE of the tokenizers library.

    The pattern that cuts texts into pieces starts one at a space or a line feed between two characters
    that are no white space, so texts are cut there beforehand and each distinct cut is looked at
    once. Most cuts are letters or ASCII digits and marks behind them; these pieces go straight to the
    library's model, and those of letters are remembered, up to a bound. All other cuts, and texts
    with longer runs of white space, go through the whole library. Control strings are ordinary text.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        parts = json.loads(Path(path).read_text())
        own = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
        before = parts["pre_tokenizer"] or {}
        if parts["normalizer"] or parts["model"]["type"] != "BPE" or any(before.get(k) != v for k, v in own.items()):
            raise ValueError("not a plain byte-level BPE")
        self.pieces: dict[str, bytes] = {}

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """Unsigned 32-bit ids of each text; null has none."""
        texts = pc.fill_null(texts, "")
        # A space or line feed before other white space or the end.
        odd = pc.match_substring_regex(texts, r"[ \n](?:\s|$)").to_numpy(zero_copy_only=False)
        out: list = [None] * len(texts)
        for i, ids in zip(np.flatnonzero(odd), self._library(_listed(texts.filter(pa.array(odd))))):
            out[i] = np.frombuffer(ids, "<u4")
        for i, ids in zip(np.flatnonzero(~odd), self._plain(texts.filter(pa.array(~odd)))):
            out[i] = ids
        return out

    def _plain(self, texts: pa.Array) -> list[np.ndarray]:
        if not len(texts):
            return []
        lists = pc.split_pattern(pc.replace_substring(texts, "\n", " \n"), " ")
        borders = lists.offsets.to_numpy().astype(np.int64)
        flat = lists.flatten().dictionary_encode()
        index = flat.indices.to_numpy().astype(np.int64)
        # Nothing is before the first cut of a text.
        packed = self._cuts(flat.dictionary, " ") + self._cuts(pc.list_element(lists, 0), "")
        index[borders[:-1]] = np.arange(len(packed) - len(texts), len(packed))
        counts = np.array(list(map(len, packed)), dtype=np.int64) // 4
        starts, pool = np.cumsum(counts) - counts, np.frombuffer(b"".join(packed), dtype="<u4")
        own = counts[index]
        ends = np.cumsum(own)
        ids = pool[np.repeat(starts[index] - ends + own, own) + np.arange(ends[-1])]
        return np.split(ids, np.concatenate([[0], ends])[borders[1:-1]])

    def _cuts(self, cuts: pa.Array, before: str) -> list[bytes]:
        """Ids of cuts, with ``before`` before those that do not begin with a line feed."""
        lines = pc.starts_with(cuts, "\n")
        bodies = pc.if_else(lines, pc.utf8_slice_codeunits(cuts, 1), cuts)
        words = pc.ascii_rtrim(bodies, characters=_MARKS)
        simple = pc.or_(pc.utf8_is_alpha(words), pc.ascii_is_decimal(words))
        if len(self.pieces) > _REMEMBERED:
            self.pieces.clear()
        piece, lead, line = self._piece, _SPACE if before else "", self._piece("\n", "")
        out: list = [None] * len(cuts)
        rest = []
        for i, (body, word, ok, new) in enumerate(zip(*map(_listed, (bodies, words, simple, lines)))):
            if ok:
                ids = line + piece(word, "") if new else piece(word, lead)
                out[i] = ids if len(word) == len(body) else ids + piece(body[len(word):], "")
            else:
                rest.append(i)
        texts = _listed(cuts.take(pa.array(rest, pa.int64())))
        for i, ids in zip(rest, self._library([t if t[:1] == "\n" or not t else before + t for t in texts])):
            out[i] = ids
        return out

    def _library(self, texts: list[str]) -> Iterator[bytes]:
        if texts:
            for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False):
                yield np.array(e.ids, dtype="<u4").tobytes()

    def _piece(self, piece: str, lead: str) -> bytes:
        key = lead + piece
        ids = self.pieces.get(key)
        if ids is None:
            spelled = key if piece.isascii() and piece != "\n" else lead + piece.encode().decode("latin-1").translate(_TABLE)
            ids = array("I", [t.id for t in self.tokenizer.model.tokenize(spelled)]).tobytes()
            if len(key) <= 64:
                self.pieces[key] = ids
        return ids


def _listed(values: pa.Array) -> list:
    """As ``to_pylist`` for values without nulls, many times faster."""
    return values.to_numpy(zero_copy_only=False).tolist()


def some_texts(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[pa.RecordBatch]:
    """Batches in parts of _ROWS rows and _BYTES bytes of a text column at most, but for longer texts."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends, at = np.cumsum(sizes, dtype=np.int64), 0
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            to = min(at + _ROWS, max(at + 1, int(np.searchsorted(ends, before + _BYTES, side="right"))))
            yield batch.slice(at, to - at)
            at = to


_ENCODERS: dict[str, ByteEncoder] = {}


def encoder(path: str) -> ByteEncoder:
    """One encoder per worker process."""
    if path not in _ENCODERS:
        _ENCODERS[path] = ByteEncoder(path)
    return _ENCODERS[path]


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def cut_lengths(n: int, capacity: int = CAPACITY) -> list[int]:
    """Lengths of a document's pieces: whole sequences, the rest as the first piece."""
    return [n % capacity] * (n % capacity > 0) + [capacity] * (n // capacity)


def token_pieces(
    docs: DataFrame, vocabulary_path: str | None = None, end_id: int = END_ID, capacity: int = CAPACITY, with_ids: bool = False,
) -> DataFrame:
    """Written rows (doc_id, piece, start, length, ids_crc32, part, nth), with ids (binary) if wanted.

    ``nth`` counts the pieces of a length within a part (a task). A null or empty text is one piece of
    the end id. Each row of ``docs`` is a document, also repeated ones and those without doc_id.
    """
    path = vocabulary_path or vocabulary()
    schema = "doc_id long, piece int, start long, length int, ids_crc32 long, part int, nth long" + ", ids binary" * with_ids
    names = [c.split()[0] for c in schema.split(", ")]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tail, met = np.array([end_id], dtype="<u4").tobytes(), Counter()
        for batch in some_texts(batches, 1):
            columns: dict[str, list] = {name: [] for name in names}
            for doc, part, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), encoder(path).encode(batch.column(1))):
                ids = ids.tobytes() + tail
                start = 0
                for piece, length in enumerate(cut_lengths(len(ids) // 4, capacity)):
                    own = ids[4 * start:4 * (start + length)]
                    row = (doc, piece, start, length, zlib.crc32(own), part, met[length], own)
                    for name, value in zip(names, row):
                        columns[name].append(value)
                    met[length] += 1
                    start += length
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[n], type=t) for n, t in zip(names, (
                    pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.binary()))], names=names)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.spark_partition_id().alias("part"))
    return materialize(map_batches(rows, cut, schema), "packing-pieces")


def plan_slots(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing over counts: rows (length, first rank, pieces, pieces of a sequence, first
    sequence, offset) in which the pieces from the first rank on fill one sequence after the other.

    A piece goes to the sequence with the least room that holds it, which it leaves with too little
    room for its length or takes the next piece as well: so a range of sequences with equal room takes
    as many pieces each as fit.
    """
    ranges: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]
    plan, sequences = [], 0
    for length in sorted(histogram, reverse=True):
        if not 0 < length <= capacity:
            raise ValueError(f"length {length}")
        left, rank = histogram[length], 0

        def fill(first: int, n: int, room: int) -> int:
            """Fill sequences of a range; returns how many were used."""
            nonlocal left, rank
            used = 0
            for each in (room // length, left % (room // length)):
                whole = min(n - used, left // each) if each else 0
                if whole:
                    plan.append((length, rank, whole * each, each, first + used, capacity - room))
                    ranges[room - whole_room(each)].append((first + used, whole))
                    left, rank, used = left - whole * each, rank + whole * each, used + whole
            return used

        def whole_room(each: int) -> int:
            return each * length

        for room in range(length, capacity + 1):
            held = ranges[room]
            while left and held:
                first, n = held.pop()
                if (used := fill(first, n, room)) < n:
                    held.append((first + used, n - used))
            if not left:
                break
        if left:
            sequences += fill(sequences, -(-left // (capacity // length)), capacity)
    return plan


def pack(docs: DataFrame, vocabulary_path: str | None = None, end_id: int = END_ID, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """Every piece of every document with its place: doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ids).

    Sequences are gapless from offset 0. Null and empty texts are pieces of one id; repeated rows are
    documents each; an empty table gives no rows; other columns play no part. Which of two documents
    with pieces of one length takes which slot has no meaning.
    """
    pieces = token_pieces(docs, vocabulary_path, end_id, capacity, with_ids)
    spark = docs.sparkSession
    counts = materialize(pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n")), "packing-counts")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = plan_slots(histogram, capacity)
    slots = spark.createDataFrame(plan, "of_length int, first_rank long, pieces long, each long, first_sequence long, first_offset long")
    before = counts.select("part", "length", (F.sum("n").over(Window.partitionBy("length").orderBy("part")) - F.col("n")).alias("before"))
    ranked = pieces.join(small(materialize(before, "packing-before")), ["part", "length"]).withColumn("rank", F.col("nth") + F.col("before"))
    place = F.col("rank") - F.col("first_rank")
    return ranked.join(F.broadcast(slots), (F.col("length") == F.col("of_length")) & place.between(0, F.col("pieces") - 1)).select(
        "doc_id", "piece", "start", F.col("length").cast("long").alias("length"), "ids_crc32",
        (F.col("first_sequence") + F.floor(place / F.col("each"))).alias("sequence_id"),
        (F.col("first_offset") + place % F.col("each") * F.col("length")).alias("offset"), *["ids"] * with_ids)


def sequences(packed: DataFrame) -> DataFrame:
    """Rows (sequence_id, n_tokens, ids) of pieces packed with ids; a sequence has ``capacity`` ids at most."""
    held = F.array_sort(F.collect_list(F.struct("offset", "length", "ids")))
    rows = packed.groupBy("sequence_id").agg(held.alias("_p"), F.sum("length").alias("n_tokens"))
    ids = F.aggregate("_p", F.lit(b""), lambda a, p: F.concat(a, p["ids"]))
    return rows.select("sequence_id", "n_tokens", ids.alias("ids"))
