"""Collocations: phrases that occur more often than their parts let one expect.

1.  Words are counted for each language. A word is coded by a 64-bit hash of language and word; the
    seed is accepted once no frequent word shares its code with another one, so codes stand for words
    exactly.
2.  Leading pairs of words are counted by a hash of the pair: an upper bound of their occurrences,
    from which a bitmap of the pairs that may be frequent is made.
3.  A suffix pointer is a place in a text; its key is the next words, up to the longest phrase, cut at
    the end of the piece and before the first pair that is infrequent. Suffixes whose leading pair is
    infrequent are abandoned there. Each task adds up equal suffixes, and they are routed by their
    leading pair; where very many suffixes share it, by their leading three words, and so on.
4.  In a route, multikey three-way quicksort to the depth of the longest phrase: the sizes of equal
    partitions are the counts of phrases, and partitions below the least count are abandoned. The
    few phrases shorter than the words by which a suffix is routed are added up over the routes.
5.  Phrases are scored at each cut against the counts of both sides, all in exact arithmetic.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from provtrail.llm.common import map_batches, mixed, slices, small, utf8
from provtrail.session import materialize

LONGEST = 5
LEAST = 100
TOP = 2000
#: Stands between pieces; no UTF-8 text has this byte.
MARK = b"\xff"
#: A-Z lowered, ends of pieces as line feeds, tabs as spaces.
_PREPARED = bytes(
    c + 32 if 65 <= c <= 90 else 10 if c in b".,;:!?\x0a\x0b\x0c\x0d" else 32 if c == 9 else c for c in range(256))
#: Suffixes with the same leading words from which on they are routed by one word more.
HOT = 20_000
#: Bits of a bitmap, at most; beyond, it lets more pass, which costs time only.
MOST_BITS = 1 << 27
_HELD_WORDS, _HELD_PAIRS, _HELD_SUFFIXES, _HELD_ROWS = 150_000, 2_000_000, 500_000, 1_000_000


def marked_words(text: bytes | None) -> list[bytes]:
    """Words of a text, with MARK between pieces."""
    return text.translate(_PREPARED).replace(b"\n", b" " + MARK + b" ").split() if text else []


def _by_lang(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[bytes]]]:
    """Words of the documents of a language, some hundred documents at a time; MARK ends each document."""
    for batch in slices(batches):
        texts: dict[str, list] = {}
        for lang, text in zip(batch.column(0).to_pylist(), utf8(batch.column(1))):
            if text:
                texts.setdefault(lang, []).append(text)
        for lang, own in texts.items():
            yield lang, marked_words(b"\n".join(own))


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text").cast("string").alias("text"))


def count_words(docs: DataFrame) -> DataFrame:
    """Written rows (lang, word, f)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Counter] = {}

        def flush():
            for lang, words in held.items():
                words.pop(MARK, None)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(words), pa.string()), pa.array(list(words), pa.binary()).cast(pa.string()),
                     pa.array(list(words.values()), pa.int64())], names=["lang", "word", "f"])
            held.clear()

        for lang, words in _by_lang(batches):
            held.setdefault(lang, Counter()).update(words)
            if sum(map(len, held.values())) > _HELD_WORDS:
                yield from flush()
        yield from flush()

    partial = map_batches(_texts(docs), run, "lang string, word string, f long")
    return materialize(partial.groupBy("lang", "word").agg(F.sum("f").alias("f")), "collocation-words")


class Coder:
    """Codes of words of a language; remembers some."""

    def __init__(self, seed: int):
        self.seed, self.known = seed, {}

    def __call__(self, lang: str, words: list[bytes]) -> np.ndarray:
        if sum(map(len, self.known.values())) > _HELD_WORDS:
            self.known = {}
        known = self.known.setdefault(lang, {MARK: 0})
        before = lang.encode() + MARK
        for w in set(words).difference(known):
            known[w] = xxhash.xxh3_64_intdigest(before + w, self.seed) or 1
        return np.fromiter(map(known.__getitem__, words), dtype=np.uint64, count=len(words))


def code_words(words: DataFrame, least: int) -> tuple[DataFrame, int]:
    """Frequent words (lang, word, code, f), written, and the seed of the codes."""
    def run(seed: int):
        def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                codes = [xxhash.xxh3_64_intdigest(lang.encode() + MARK + word, seed) or 1
                         for lang, word in zip(batch.column(0).to_pylist(), utf8(batch.column(1)))]
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(np.array(codes, dtype=np.uint64).view(np.int64))], names=["lang", "word", "f", "code"])

        return coded

    for seed in count():
        coded = materialize(map_batches(words.select("lang", "word", "f"), run(seed), "lang string, word string, f long, code long"), "collocation-codes")
        shared = coded.groupBy("code").agg(F.count(F.lit(1)).alias("n"), F.max("f").alias("f"))
        if shared.filter((F.col("n") > 1) & (F.col("f") >= least)).isEmpty():
            return coded.filter(F.col("f") >= least), seed


def bitmap(keys: DataFrame, n: int) -> np.ndarray:
    """Bits of a ``key`` column of ``n`` longs, made by the executors; at most MOST_BITS reach the driver."""
    bits = 1 << 16
    while bits < MOST_BITS and bits < 64 * n:
        bits *= 2
    at = F.col("key").bitwiseAND(F.lit(bits - 1))
    rows = keys.select(F.shiftright(at, 6).alias("at"), F.expr("shiftleft(1L, cast(key & 63 AS int))").alias("bit"))
    found = rows.groupBy("at").agg(F.bit_or("bit").alias("bits")).toArrow()
    out = np.zeros(bits >> 6, dtype=np.uint64)
    out[found["at"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
    return out


def in_bitmap(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    at = keys & np.uint64(len(bits) * 64 - 1)
    return (bits[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)


def pair_keys(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mixed(first * np.uint64(0x9E3779B97F4A7C15) + second)


def count_pairs(docs: DataFrame, seed: int, words) -> DataFrame:
    """Rows (key, n) of pairs of words whose codes are in the broadcast bitmap ``words``, added up by task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, held, n = Coder(seed), [], 0

        def flush():
            keys, times = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(times, pa.int64())], names=["key", "n"])

        for lang, own in _by_lang(batches):
            codes = coder(lang, own)
            ok = in_bitmap(words.value, codes) & (codes != 0)
            both = ok[:-1] & ok[1:]
            held.append(pair_keys(codes[:-1][both], codes[1:][both]))
            n += len(held[-1])
            if n > _HELD_PAIRS:
                yield flush()
                held, n = [], 0
        if n:
            yield flush()

    return map_batches(_texts(docs), run, "key long, n long")


def _added_up(rows: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows in order, and the sums of their numbers."""
    order = np.lexsort(rows.T[::-1])
    rows, times = rows[order], times[order]
    new = np.ones(len(rows), dtype=bool)
    new[1:] = (rows[1:] != rows[:-1]).any(axis=1)
    starts = np.flatnonzero(new)
    return rows[starts], np.add.reduceat(times, starts) if len(starts) else times


def suffixes(codes: np.ndarray, ok: np.ndarray, longest: int) -> np.ndarray:
    """Suffixes at the places of ``ok`` (of each pair of neighbours), zeros behind their ends."""
    at = np.flatnonzero(ok)
    out = np.zeros((len(at), longest), dtype=np.uint64)
    out[:, 0], out[:, 1] = codes[at], codes[at + 1]
    ok = np.concatenate([ok, np.zeros(longest, dtype=bool)])
    on = np.ones(len(at), dtype=bool)
    for k in range(2, longest):
        on &= ok[at + k - 1]
        out[on, k] = codes[at[on] + k]
    return out


def find_suffixes(docs: DataFrame, seed: int, pairs, longest: int) -> DataFrame:
    """Written rows (w0, w1, .., n) of the suffixes whose leading pair is in the broadcast bitmap ``pairs``."""
    names = [*_words(longest), "n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, held, n = Coder(seed), [], 0
        rows, times = np.zeros((0, longest), dtype=np.uint64), np.zeros(0, dtype=np.int64)

        def merged():
            new = np.concatenate(held) if held else rows[:0]
            return _added_up(np.concatenate([rows, new]), np.concatenate([times, np.ones(len(new), dtype=np.int64)]))

        def batch():
            columns = [*[np.ascontiguousarray(rows[:, k]).view(np.int64) for k in range(longest)], times]
            return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)

        for lang, own in _by_lang(batches):
            codes = coder(lang, own)
            full = codes != 0
            ok = in_bitmap(pairs.value, pair_keys(codes[:-1], codes[1:])) & full[:-1] & full[1:]
            held.append(suffixes(codes, ok, longest))
            n += len(held[-1])
            if n > _HELD_SUFFIXES:
                (rows, times), held, n = merged(), [], 0
                if len(rows) > _HELD_ROWS:
                    yield batch()
                    rows, times = rows[:0], times[:0]
        rows, times = merged()
        if len(rows):
            yield batch()

    return materialize(map_batches(_texts(docs), run, ", ".join(f"{c} long" for c in names)), "collocation-suffixes")


def _words(n: int) -> list[str]:
    return [f"w{k}" for k in range(n)]


def route_suffixes(found: DataFrame, longest: int, hot: int = HOT) -> DataFrame:
    """Suffixes with ``depth``, the number of leading words by which they are routed, and ``route``.

    Two words, and one more as long as ``hot`` suffixes or more share these.
    """
    rows = found.withColumn("depth", F.lit(2))
    for depth in range(2, longest):
        keys = _words(depth)
        many = rows.filter(F.col("depth") == depth).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") >= hot)
        many = materialize(many.select(*keys, F.lit(1).alias("_more")), "collocation-hot")
        if many.isEmpty():
            break
        rows = rows.join(small(many), keys, "left").withColumn("depth", F.col("depth") + F.coalesce("_more", F.lit(0))).drop("_more")
    # A place behind the routed words counts as a word like any other.
    key = F.array(*[F.when(F.col("depth") > k, F.col(w)) for k, w in enumerate(_words(longest))])
    return rows.select(F.xxhash64(key).alias("route"), "depth", *_words(longest), "n")


def quicksort_counts(rows: np.ndarray, times: np.ndarray, least: int, depth: int = 2) -> Iterator[tuple[list[int], int]]:
    """(phrase, count) of all prefixes of two words or more with a count of ``least`` at least.

    Multikey three-way quicksort of pointers to the rows, column by column. Partitions whose rows
    count for less than ``least`` are abandoned, but for prefixes shorter than ``depth``, which may
    go on elsewhere; a zero is the end of a row.
    """
    longest = rows.shape[1]
    stack = [(np.arange(len(rows)), 0)]
    while stack:
        pointers, at = stack.pop()
        needed = least if at + 1 >= depth else 1
        if times[pointers].sum() < needed:
            continue
        keys = rows[pointers, at]
        pivot = np.partition(keys[[0, len(keys) // 2, -1]], 1)[1]
        equal = pointers[keys == pivot]
        if len(equal) < len(pointers):
            stack += [(pointers[keys < pivot], at), (pointers[keys > pivot], at)]
        if pivot and (n := int(times[equal].sum())) >= needed:
            if at:
                yield rows[equal[0], :at + 1].view(np.int64).tolist(), n
            if at + 1 < longest:
                stack.append((equal, at + 1))


def count_phrases(routed: DataFrame, least: int, longest: int) -> DataFrame:
    """Rows (phrase, a): codes of the words and the exact count, of all phrases that occur ``least`` times.

    A task holds one route more than _HELD_ROWS rows at most.
    """
    schema = pa.schema([("phrase", pa.list_(pa.int64())), ("a", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0

        def flush(table: np.ndarray) -> pa.RecordBatch:
            found = []
            for depth in range(2, longest + 1):
                own = table[table[:, 1] == depth]
                rows, times = np.ascontiguousarray(own[:, 2:-1]).view(np.uint64), own[:, -1]
                found += quicksort_counts(rows, times, least, depth) if len(own) else ()
            return pa.RecordBatch.from_arrays(
                [pa.array([p for p, _ in found], schema.types[0]), pa.array([a for _, a in found], pa.int64())], schema=schema)

        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(np.stack([c.to_numpy().astype(np.int64) for c in batch.columns], axis=1))
            n += batch.num_rows
            if n >= _HELD_ROWS:
                table = np.concatenate(held)
                # The last route may go on.
                end = int(np.flatnonzero(table[:, 0] == table[-1, 0])[0])
                if end:
                    yield flush(table[:end])
                held, n = [table[end:]], len(table) - end
        if n:
            yield flush(np.concatenate(held))

    rows = routed.repartition("route").sortWithinPartitions("route")
    partial = map_batches(rows, run, "phrase array<long>, a long")
    return partial.groupBy("phrase").agg(F.sum("a").alias("a")).filter(F.col("a") >= least)


def frequent_phrases(docs: DataFrame, least: int = LEAST, longest: int = LONGEST) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Written tables: words (lang, word, f) of all words, coded (lang, word, code, f) of frequent ones, phrases (phrase, a)."""
    sc = docs.sparkSession.sparkContext
    words = count_words(docs)
    coded, seed = code_words(words, least)
    known = sc.broadcast(bitmap(coded.select(F.col("code").alias("key")), coded.count()))
    pairs = materialize(count_pairs(docs, seed, known).groupBy("key").agg(F.sum("n").alias("n")).filter(F.col("n") >= least), "collocation-pairs")
    found = find_suffixes(docs, seed, sc.broadcast(bitmap(pairs, pairs.count())), longest)
    return words, coded, materialize(count_phrases(route_suffixes(found, longest), least, longest), "collocation-phrases")


def collocations(
    docs: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int | None = TOP, within: int = 100,
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of the phrases of 2 to ``longest`` words that occur ``least`` times.

    ``a`` counts the phrase, ``l`` and ``r`` the sides of its lowest-scoring cut, ``n`` all words of the
    language; the score is floor(1000 a n / (l r)). A phrase inside a longer one that has ``within``
    percent of its count is dropped. Of each language the first ``top`` are kept (None: all), by score
    and count descending, then by text. Null languages are ``und``; null and empty texts have no words;
    repeated rows count each; an empty table gives no rows. Texts are read whole.
    """
    words, coded, phrases = frequent_phrases(docs, least, longest)
    totals = words.groupBy("lang").agg(F.sum("f").alias("n"))
    counts = phrases.select(F.col("phrase").alias("part"), F.col("a").alias("f")).union(
        coded.select(F.array("code").alias("part"), "f"))
    size = F.size("phrase")
    cuts = phrases.select("phrase", "a", F.explode(F.sequence(F.lit(1), size - 1)).alias("k"))
    cuts = cuts.withColumn("left", F.slice("phrase", 1, F.col("k"))).withColumn("right", F.slice("phrase", F.col("k") + 1, size - F.col("k")))
    cuts = cuts.join(counts.select(F.col("part").alias("left"), F.col("f").alias("l")), "left")
    cuts = cuts.join(counts.select(F.col("part").alias("right"), F.col("f").alias("r")), "right")
    langs = coded.join(small(materialize(totals, "collocation-totals")), "lang").select(F.col("code").alias("_first"), "lang", "n")
    cuts = cuts.join(langs, F.col("phrase")[0] == F.col("_first"))
    score = F.expr("(1000 * cast(a AS decimal(19,0)) * cast(n AS decimal(19,0))) div (cast(l AS decimal(19,0)) * cast(r AS decimal(19,0)))")
    best = cuts.groupBy("phrase", "lang", "n", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("_c"))
    inner = phrases.filter(size > 2).select(
        "a", "phrase", F.explode(F.sequence(F.lit(2), size - 1)).alias("_len")).select(
        "a", F.explode(F.transform(F.sequence(F.lit(1), size - F.col("_len") + 1), lambda i: F.slice("phrase", i, F.col("_len")))).alias("phrase"))
    longer = inner.groupBy("phrase").agg(F.max("a").alias("_most"))
    kept = best.join(longer, "phrase", "left").filter(F.coalesce(100 * F.col("_most") < within * F.col("a"), F.lit(True)))
    spelled = kept.select("phrase", F.posexplode("phrase").alias("_at", "code")).join(coded.select("code", "word"), "code").groupBy("phrase").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_at", "word"))), lambda w: w["word"]), " ").alias("_text"))
    rows = kept.join(spelled, "phrase").select("lang", F.col("_text").alias("phrase"), "a", "_c.l", "_c.r", "n", "_c.score")
    if top is None:
        return rows
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    return rows.withColumn("rank", place).filter(F.col("rank") <= top).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def oracle(least: int = LEAST, longest: int = LONGEST, top: int = TOP) -> str:
    """The result in SQL, from all phrases of all pieces."""
    return f"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(unnest(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\\x0A-\\x0D]')), '[^\\x20\\x09]+') AS w
  FROM documents
),
starts AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM pieces),
spans AS (SELECT lang, w[i:i + k - 1] AS p, k FROM starts, (SELECT unnest(range(1, {longest} + 1)) AS k) WHERE i + k - 1 <= len(w)),
f AS (SELECT lang, array_to_string(p, ' ') AS p, k, count(*) AS f FROM spans GROUP BY ALL HAVING count(*) >= {least}),
total AS (SELECT lang, sum(len(w))::hugeint AS n FROM pieces GROUP BY lang),
candidates AS (SELECT lang, p, k AS len, f AS a, string_split(p, ' ') AS w FROM f WHERE k > 1),
cuts AS (SELECT *, unnest(range(1, len)) AS k FROM candidates),
scored AS (
  SELECT c.lang, c.p, c.len, c.a, l.f AS l, r.f AS r, t.n, c.k, (1000 * c.a::hugeint * t.n) // (l.f::hugeint * r.f) AS score
  FROM cuts c JOIN total t ON t.lang = c.lang
  JOIN f l ON l.lang = c.lang AND l.p = array_to_string(c.w[1:c.k], ' ')
  JOIN f r ON r.lang = c.lang AND r.p = array_to_string(c.w[c.k + 1:], ' ')
),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1),
kept AS (
  SELECT b.* FROM best b WHERE NOT EXISTS (
    SELECT 1 FROM candidates c WHERE c.lang = b.lang AND c.len > b.len AND c.a >= b.a
      AND contains(' ' || c.p || ' ', ' ' || b.p || ' '))
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(p)) AS rank, p AS phrase, a, l, r,
  n::bigint AS n, score::bigint AS score
FROM kept QUALIFY rank <= {top}
"""
