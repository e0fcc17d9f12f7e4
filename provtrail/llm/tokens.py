"""Token-id output in Simple-8b words.

A written table has one row per chunk of whole documents, in order. In a chunk, ids that occur
more than once become their frequency rank in the chunk's dictionary; the ranks are packed into
64-bit words of a 4-bit selector and up to 60 payload bits, and an id that occurs once is an
escape: a word of its own with the plain id. Every ``BLOCK`` ids start a new word, whose index is
in ``block_offsets``, so blocks decode alone and a chunk decodes in a few vector steps.

    part, seq      order of the chunks           first_id       ids of the part before the chunk
    n_ids          ids in the chunk              dictionary     uint32, by rank
    words          uint64                        block_offsets  uint32, word index of each block
    doc_ids        list of long                  doc_lengths    ids of each document
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from provtrail.llm.common import give_back, map_batches, utf8

BLOCK = 128
CHUNK_IDS = 1 << 18
#: Text whose words are Python objects at once.
SLICE_BYTES = 1 << 20
#: Ids per word and bits per id by selector, and the selector of an escape.
PACKS = ((60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6), (8, 7), (7, 8), (6, 10), (5, 12), (4, 15), (3, 20), (2, 30), (1, 60))
ESCAPE = 15
ESCAPED_BITS = 99
END_ID = 1
_CACHED = 200_000
SCHEMA = ("part int, seq int, first_id long, n_ids long, dictionary binary, words binary, "
          "block_offsets binary, doc_ids array<long>, doc_lengths array<long>")


def pack(codes: np.ndarray, widths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Simple-8b words of uint64 codes of given bit widths, and the word index of each block."""
    n = len(codes)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint32)
    bits = np.full(n + 64, ESCAPED_BITS, dtype=np.uint8)
    bits[:n] = widths
    widest = {1: bits}
    for p in (1, 2, 4, 8, 16):
        widest[2 * p] = np.maximum(widest[p][:-p], widest[p][p:])
    left = np.resize(np.arange(BLOCK, 0, -1, dtype=np.uint8), n)
    choice = np.full(n, ESCAPE, dtype=np.uint8)
    for s, (count, width) in reversed(list(enumerate(PACKS))):
        p = 1 << (count.bit_length() - 1)
        most = np.maximum(widest[p][:n], widest[p][count - p:count - p + n])
        choice[(most <= width) & (left >= count)] = s
    counts = np.array([c for c, _ in PACKS] + [0, 1], dtype=np.int64)
    # All blocks step from word to word at once.
    first = np.zeros(n, dtype=bool)
    blocks = np.arange(0, n, BLOCK)
    ends = np.minimum(blocks + BLOCK, n)
    at = blocks.copy()
    while len(at):
        first[at] = True
        at = at + counts[choice[at]]
        more = at < ends
        at, ends = at[more], ends[more]
    starts = np.flatnonzero(first)
    chosen = choice[starts]
    words = chosen.astype(np.uint64) << np.uint64(60)
    for s, (count, width) in enumerate(PACKS):
        of = np.flatnonzero(chosen == s)
        if len(of):
            steps = np.arange(count)
            shifted = codes[starts[of, None] + steps] << (steps * width).astype(np.uint64)
            words[of] |= np.bitwise_or.reduce(shifted, axis=1)
    of = np.flatnonzero(chosen == ESCAPE)
    words[of] |= codes[starts[of]]
    return words, np.searchsorted(starts, blocks).astype(np.uint32)


def unpack(words: np.ndarray, dictionary: np.ndarray) -> np.ndarray:
    """The ids of whole blocks."""
    chosen = (words >> np.uint64(60)).astype(np.int64)
    counts = np.array([c for c, _ in PACKS] + [0, 1], dtype=np.int64)[chosen]
    at = np.cumsum(counts) - counts
    out = np.zeros(int(counts.sum()), dtype=np.uint32)
    for s, (count, width) in enumerate(PACKS):
        of = np.flatnonzero(chosen == s)
        if len(of):
            steps = np.arange(count)
            codes = (words[of, None] >> (steps * width).astype(np.uint64)) & np.uint64((1 << width) - 1)
            out[at[of, None] + steps] = dictionary[codes]
    of = np.flatnonzero(chosen == ESCAPE)
    out[at[of]] = words[of] & np.uint64((1 << 60) - 1)
    return out


def encode_chunk(ids: np.ndarray) -> dict:
    """Columns of one chunk: dictionary, words, block_offsets, n_ids."""
    times = np.bincount(ids)
    often = np.flatnonzero(times > 1)
    ranked = often[np.argsort(-times[often], kind="stable")]
    code = np.arange(len(times), dtype=np.uint64)
    code[ranked] = np.arange(len(ranked), dtype=np.uint64)
    bits = np.frexp(code.astype(np.float64))[1].astype(np.uint8)
    bits[times == 1] = ESCAPED_BITS
    words, offsets = pack(code[ids], bits[ids])
    return {"dictionary": ranked.astype("<u4").tobytes(), "words": words.astype("<u8").tobytes(),
            "block_offsets": offsets.astype("<u4").tobytes(), "n_ids": len(ids)}


class _Pieces(dict):
    """Ids of pieces, found out when first asked for, in up to three parts of ``most`` pieces: those asked
    for again, such ones from before the last time that part was full, and those asked for once."""

    def __init__(self, find: Callable[[bytes], bytes], most: int):
        super().__init__()
        self.find, self.most = find, most
        self.old: dict[bytes, bytes] = {}
        self.once: dict[bytes, bytes] = {}

    def __missing__(self, piece: bytes) -> bytes:
        ids = self.once.pop(piece, None) or self.old.get(piece)
        if ids is None:
            ids = self.find(piece)
            if len(piece) <= 64:
                if len(self.once) >= self.most:
                    self.once.clear()
                self.once[piece] = ids
            return ids
        if len(self) >= self.most:
            self.old = dict(self)
            self.clear()
        self[piece] = ids
        return ids


class WordEncoder:
    """Ids of whole texts. Text is cut at ASCII white space, which no token spans, and the ids of a
    piece are remembered, up to a bound.

    Most pieces are a word of Latin letters and marks behind it. The library splits such a piece at
    that place too, so the word, lowered, goes straight to its model; all others go through the
    whole library.
    """

    def __init__(self, path: str, remembered: int = _CACHED):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.pieces = _Pieces(self._ids, remembered)

    def encode(self, texts: list[bytes | None]) -> list[np.ndarray]:
        ids = self.pieces.__getitem__
        return [np.frombuffer(b"".join(map(ids, _cut(t))), dtype="<u4") for t in texts]

    def _ids(self, raw: bytes) -> bytes:
        ids = self._simple(raw)
        if ids is None:
            ids = array("I", self.tokenizer.encode(raw.decode(), add_special_tokens=False).ids).tobytes()
        return ids

    def _simple(self, raw: bytes) -> bytes | None:
        if raw.isalpha():  # ASCII letters only
            return self._part(raw.decode().lower())
        piece = raw.decode()
        word = piece.rstrip(_MARKS)
        if len(word) > 60 or not word.isalpha() or max(word) > "\u017f" or "\u0130" in word:
            return None
        ids = self._part(word.lower())
        return ids if len(word) == len(piece) else ids + self._part(piece[len(word):])

    def _part(self, word: str) -> bytes:
        spelled = word if word.isascii() else "".join(_SPELLED[b] for b in word.encode())
        return array("I", [t.id for t in self.model.tokenize(spelled)]).tobytes()


def _cut(text: bytes | None) -> list[bytes]:
    """Pieces of a text. Lower case comes first in the library too, but for control strings."""
    if not text:
        return []
    return (text if b"<|" in text else _MARK_BEHIND.sub(rb" \g<0>", text.lower())).split()


def _spelling() -> list[str]:
    """Byte-level spelling of the 256 bytes: printable ones as themselves, the others from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in own else chr(next(others)) for b in range(256)]


_SPELLED = _spelling()
#: ASCII marks that the library keeps together behind a word. An apostrophe may begin an ending.
_MARKS = '!"#$%&()*+,-./:;<=>?@[\\]^_`{|}~'
#: A mark between a letter or digit and white space is a piece of its own in the library.
_MARK_BEHIND = re.compile(rb"[,.;:!?](?<=[a-z0-9].)(?=[ \n])")


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str, remembered: int = _CACHED) -> WordEncoder:
    """One encoder per worker process."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    _ENCODERS[path].pieces.most = remembered
    return _ENCODERS[path]


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _text_slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with at most ``SLICE_BYTES`` of text (column 1) or one row: every word becomes a
    Python object, so rows alone do not bound a worker's memory."""
    lengths = np.asarray(pc.fill_null(pc.binary_length(batch.column(1)), 0), dtype=np.int64)
    ends = np.cumsum(lengths)
    at = 0
    while at < batch.num_rows:
        before = ends[at] - lengths[at]
        to = max(at + 1, min(at + 1000, int(np.searchsorted(ends, before + SLICE_BYTES, side="right"))))
        yield batch.slice(at, to - at)
        at = to


def write_tokens(
    docs: DataFrame, path: str, order: tuple[str, ...] = ("doc_id",), vocabulary_path: str | None = None,
    end_id: int = END_ID, chunk_ids: int = CHUNK_IDS, remembered: int = _CACHED,
) -> None:
    """Encode every whole text, append ``end_id`` and write the table in the given order.

    Null and empty texts are one id, the end. Repeated rows are written each; rows of equal order
    columns go by their text. Null order values come first. ``remembered`` bounds the pieces whose
    ids a worker keeps, for speed only.
    """
    at_path = vocabulary_path or vocabulary()
    keys = [F.col(c).alias(f"_k{i}") for i, c in enumerate(order)]
    names = [f"_k{i}" for i in range(len(order))]
    rows = docs.select(*keys, F.col("doc_id").alias("doc_id"), F.col("text").alias("text"))
    rows = rows.repartitionByRange(*names).sortWithinPartitions(*names, "doc_id", "text")
    rows = rows.select("doc_id", "text", F.spark_partition_id().alias("part"))

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([
            ("part", pa.int32()), ("seq", pa.int32()), ("first_id", pa.int64()), ("n_ids", pa.int64()),
            ("dictionary", pa.binary()), ("words", pa.binary()), ("block_offsets", pa.binary()),
            ("doc_ids", pa.list_(pa.int64())), ("doc_lengths", pa.list_(pa.int64()))])
        part, seq, first, held, ids, docs_in, lengths = 0, 0, 0, 0, [], [], []

        def flush():
            columns = encode_chunk(np.concatenate(ids))
            columns |= {"part": part, "seq": seq, "first_id": first, "doc_ids": docs_in, "doc_lengths": lengths}
            return pa.RecordBatch.from_pylist([columns], schema=schema)

        tail = np.array([end_id], dtype="<u4")
        give_back()
        for whole in batches:
            for batch in _text_slices(whole):
                for doc, part, own in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(),
                                          encoder(at_path, remembered).encode(utf8(batch.column(1)))):
                    ids += [own, tail]
                    docs_in.append(doc)
                    lengths.append(len(own) + 1)
                    held += len(own) + 1
                    if held >= chunk_ids:
                        yield flush()
                        seq, first, held, ids, docs_in, lengths = seq + 1, first + held, 0, [], [], []
        if docs_in:
            yield flush()

    map_batches(rows, chunks, SCHEMA).write.parquet(path)


def _read(spark, path: str, keep, schema: str) -> DataFrame:
    """``keep(doc_ids, start, n_tokens, ids, ends)`` of each chunk of a written table, as rows."""
    table = spark.read.schema(SCHEMA).parquet(path)
    totals = table.groupBy("part").agg(F.sum("n_ids").alias("n")).orderBy("part").collect()
    before, so_far = {}, 0
    for r in totals:
        before[r["part"]] = so_far
        so_far += r["n"]
    shared = spark.sparkContext.broadcast(before)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                r = batch.slice(i, 1).to_pylist()[0]
                ids = unpack(np.frombuffer(r["words"], "<u8"), np.frombuffer(r["dictionary"], "<u4"))
                lengths = np.array(r["doc_lengths"], dtype=np.int64)
                if len(ids) != r["n_ids"] or lengths.sum() != len(ids):
                    raise ValueError("damaged chunk")
                ends = np.cumsum(lengths)
                at = shared.value[r["part"]] + r["first_id"] + ends - lengths
                yield keep(pa.array(r["doc_ids"], pa.int64()), pa.array(at), pa.array(lengths), ids, ends)

    columns = table.select("part", "first_id", "n_ids", "dictionary", "words", "doc_ids", "doc_lengths")
    return map_batches(columns, decode, schema)


def read_tokens(spark, path: str) -> DataFrame:
    """One row per document of a written table: doc_id, start, n_tokens, ids.

    ``start`` counts the ids of all documents before it. Only one total per written part reaches
    the driver.
    """
    def lists(doc_ids, start, n_tokens, ids, ends):
        of = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(ids.astype(np.int32)))
        return pa.RecordBatch.from_arrays([doc_ids, start, n_tokens, of], names=["doc_id", "start", "n_tokens", "ids"])

    return _read(spark, path, lists, "doc_id long, start long, n_tokens long, ids array<int>")


def read_digests(spark, path: str) -> DataFrame:
    """As ``read_tokens``, with the crc32 of the ids read, as little-endian 32-bit integers, in their place:
    doc_id, start, n_tokens, ids_crc32."""
    def sums(doc_ids, start, n_tokens, ids, ends):
        return pa.RecordBatch.from_arrays(
            [doc_ids, start, n_tokens, _crcs(ids, ends - n_tokens.to_numpy(), ends)], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return _read(spark, path, sums, "doc_id long, start long, n_tokens long, ids_crc32 long")


def _crcs(ids: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    values = ids.astype("<u4", copy=False)
    return pa.array([zlib.crc32(values[a:b]) for a, b in zip(starts.tolist(), ends.tolist())], pa.int64())


def digest(tokens: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and the crc32 of the ids as little-endian 32-bit integers."""

    def crc(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(3)
            offsets = lists.offsets.to_numpy()
            sums = _crcs(lists.values.to_numpy(), offsets[:-1], offsets[1:])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2), sums], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return map_batches(tokens.select("doc_id", "start", "n_tokens", "ids"), crc, "doc_id long, start long, n_tokens long, ids_crc32 long")
