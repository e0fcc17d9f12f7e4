"""Shared pieces of the corpus operators: text batches, word splitting, ordered ranges, components."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import zipfile
from collections.abc import Iterator, Sequence
from pathlib import Path

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string

from provtrail.session import materialize
from provtrail.sources.tables import plan_bytes

#: Bytes of ASCII letters (lowered), digits and everything outside ASCII stay; other bytes part words.
PLAIN_WORDS = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
#: Sides of a join up to this many bytes are broadcast; larger ones shuffle.
SMALL_BYTES = 32 << 20


def plain_words(text: bytes | None) -> list[bytes]:
    """Words of UTF-8 text: runs of digits, ASCII letters (lowered) and non-ASCII characters."""
    return text.translate(PLAIN_WORDS).split() if text else []


def space_words(text: bytes | None) -> list[bytes]:
    """Words of UTF-8 text between ASCII white space, with A-Z lowered."""
    return text.lower().split() if text else []


def utf8(column: pa.Array | pa.ChunkedArray) -> list[bytes | None]:
    """A string column as UTF-8 bytes; null stays None."""
    return column.cast(pa.binary()).to_pylist()


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per session; they may not have it installed."""
    sc = spark.sparkContext
    if getattr(sc, "_provtrail_shipped", False):
        return
    top = Path(__file__).resolve().parents[1]
    path = Path(tempfile.mkdtemp(prefix="provtrail-")) / "provtrail.zip"
    with zipfile.ZipFile(path, "w") as out:
        for source in sorted(top.rglob("*.py")):
            out.write(source, source.relative_to(top.parent))
    sc.addPyFile(str(path))
    sc._provtrail_shipped = True


def map_batches(df: DataFrame, fn, schema) -> DataFrame:
    """``mapInArrow`` with this package on the workers."""
    ship(df.sparkSession)
    return df.mapInArrow(fn, schema)


def give_back() -> None:
    """Hand memory that earlier tasks of this worker process have freed back to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    libc = ctypes.CDLL(None)
    if hasattr(libc, "malloc_trim"):
        libc.malloc_trim(0)


def slices(batches: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    """Batches in parts of few rows, so that few texts are Python objects at once."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def map_rows(df: DataFrame, fn, schema: str) -> DataFrame:
    """``mapInArrow`` for a function from one RecordBatch to a dict of columns (or None for no rows)."""
    arrow = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            columns = fn(batch)
            if columns is not None:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(columns[f.name], type=f.type) for f in arrow], schema=arrow)

    return map_batches(df, run, schema)


def fold(key: Column, modulus: int) -> Column:
    """crc32 of the key's text, modulo; null keys give null."""
    return F.crc32(key.cast("string")) % modulus


def mixed(x: np.ndarray) -> np.ndarray:
    """Mix the bits of 64-bit values (a bijection)."""
    x = x.astype(np.uint64, copy=True)
    with np.errstate(over="ignore"):
        x ^= x >> np.uint64(30)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(27)
        x *= np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    return x


def free_names(df: DataFrame, *names: str) -> list[str]:
    """The names, changed where the table has such columns already."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return out


def small(df: DataFrame, max_bytes: int = SMALL_BYTES) -> DataFrame:
    """Broadcast a side of a written table if its size allows; otherwise the join shuffles."""
    return F.broadcast(df) if plan_bytes(df) <= max_bytes else df


def number(rows: DataFrame, group: str, order: Sequence[str], keep: Sequence[str], label: str) -> DataFrame:
    """Rows (group, keep, nth, of): place in the group from 0, ascending with nulls first, and its rows.

    Rows are dealt by ranges of (group, order), so no group is in one task unless its rows agree in
    all order columns. What is summed up over a group has one row for each range.
    """
    part, row = free_names(rows, "_part", "_row")
    keys = [group, *order]
    placed = materialize(
        rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
        .select(group, *keep, F.spark_partition_id().alias(part), F.monotonically_increasing_id().alias(row)), f"{label}-placed")
    counts = placed.groupBy(group, part).agg(F.count(F.lit(1)).alias("_rows"), F.min(row).alias("_first"))
    shifts = materialize(counts.select(
        F.col(group).alias("_of_group"), F.col(part).alias("_of_part"),
        (F.sum("_rows").over(Window.partitionBy(group).orderBy(part)) - F.col("_rows") - F.col("_first")).alias("_shift"),
        F.sum("_rows").over(Window.partitionBy(group)).alias("of")), f"{label}-shifts")
    same = F.col(group).eqNullSafe(F.col("_of_group")) & (F.col(part) == F.col("_of_part"))
    return placed.join(small(shifts), same).select(group, *keep, (F.col(row) + F.col("_shift")).alias("nth"), "of")


#: Schema of count pieces: first index, packed counts, rows counted (in one piece of a task).
PIECES = "piece long, counts binary, n long"
_PIECE = 1 << 15


def count_pieces(total: np.ndarray, n: int) -> Iterator[pa.RecordBatch]:
    """A task's array of counts in packed pieces."""
    for i in range(0, len(total) if n else 0, _PIECE):
        packed = zstandard.ZstdCompressor(level=1).compress(total[i:i + _PIECE].astype("<i8").tobytes())
        yield pa.RecordBatch.from_arrays(
            [pa.array([i], pa.int64()), pa.array([packed], pa.binary()), pa.array([0 if i else n], pa.int64())],
            names=["piece", "counts", "n"])


def sum_pieces(pieces: DataFrame, size: int) -> tuple[np.ndarray, int]:
    """Sum of the tasks' arrays of ``size`` counts, and of their rows. Pieces are summed by place on
    the executors, one running sum a place; the driver gets ``size`` numbers."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        n = 0
        for batch in batches:
            for piece, counts, own in zip(*(c.to_pylist() for c in batch.columns)):
                sums[piece] = sums.get(piece, 0) + _counts(counts)
                n += own
        for piece, total in sums.items():
            for out in count_pieces(total, 1):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([piece], pa.int64()), out.column(1), pa.array([n], pa.int64())], names=["piece", "counts", "n"])
            n = 0

    total, n = np.zeros(size, dtype=np.int64), 0
    for r in map_batches(pieces.repartition("piece"), add, PIECES).collect():
        part = _counts(r["counts"])
        total[r["piece"]:r["piece"] + len(part)] += part
        n += r["n"]
    return total, n


def _counts(data: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), "<i8")


def components(edges: DataFrame, label: str) -> DataFrame:
    """Connected components of undirected edges (a, b): rows (node, component), the smallest node.

    Alternates large-star and small-star steps until the edges no longer change. Each step
    joins edges with one minimum per node, so a node of very many edges is no group in one
    task: the minimum combines map-side and the join splits. Steps are written tables.
    """
    edges = materialize(
        edges.filter("a is not null and b is not null and a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), f"{label}-edges")
    print_of = None
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("low"))
        large = both.join(low, "a").filter("b > a and b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
        large = large.distinct()
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        star = large.join(low, "a")
        edges = materialize(
            star.filter("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
            .union(low.select("a", F.col("low").alias("b"))).distinct(), f"{label}-edges")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if now == print_of:
            break
        print_of = now
    return edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("component")).union(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
