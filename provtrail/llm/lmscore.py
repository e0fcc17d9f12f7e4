"""Language-model scores by masked pseudo-likelihood.

Every word is masked in turn and predicted from its neighbours, as P(class | neighbours' classes)
times P(word | class); the log probabilities are summed over the document. The most frequent words of
the corpus are classes of their own, all other words share classes by their last letters. A small
network gives the first factor. It sees every window of the corpus: how often each (left, class,
right) occurs is counted on Spark over all documents, and these counts are all that the loss depends
on. The second factor comes from the counts of all words of the corpus, a table that grows with it.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from provtrail.llm.common import PIECES, count_pieces, map_batches, map_rows, plain_words, slices, sum_pieces, utf8
from provtrail.session import materialize

#: Token 0 is the border of a document, then come the frequent words, then the ending classes.
FREQUENT, ENDINGS = 95, 32
VOCAB = 1 + FREQUENT + ENDINGS
HIDDEN = 32
EPOCHS = 250
_MEMORY = 400_000
#: So many words, the most frequent ones, are looked up in a broadcast; all others are joined.
SHARED_WORDS = 2_000_000


def word_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """All words of all documents, written: rows (word, n)."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()

        def out():
            return pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())], names=["word", "n"])

        for batch in slices(batches):
            for text in utf8(batch.column(0)):
                seen.update(plain_words(text))
                if len(seen) > _MEMORY:
                    yield out()
                    seen = Counter()
        if seen:
            yield out()

    counts = map_batches(docs.select(text_col), count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return materialize(counts, "words")


def frequent_words(docs: DataFrame, text_col: str = "text", n: int = FREQUENT, counts: DataFrame | None = None) -> list[bytes]:
    """The most frequent words of all documents, ties by their bytes."""
    counts = word_counts(docs, text_col) if counts is None else counts
    return [bytes(r["word"]) for r in counts.orderBy(F.desc("n"), "word").limit(n).collect()]


def _ending(word: bytes) -> bytes:
    """The last three letters, of any script."""
    return word[-3:] if word.isascii() else word.decode(errors="replace")[-3:].encode()


def _key(word: bytes) -> int:
    """64 bits that stand for a word in tables, as a signed number."""
    return xxhash.xxh3_64_intdigest(word) - (1 << 63)


class Tokens(dict):
    """Word to token; remembers other words up to a bound."""

    def __init__(self, words: list[bytes]):
        super().__init__((w, i + 1) for i, w in enumerate(words))
        self.words = words

    def __missing__(self, word: bytes) -> int:
        if len(self) > _MEMORY:
            self.clear()
            self.update((w, i + 1) for i, w in enumerate(self.words))
        token = self[word] = 1 + FREQUENT + xxhash.xxh3_64_intdigest(_ending(word)) % ENDINGS
        return token

    def of(self, text: bytes | None) -> np.ndarray:
        """Tokens of a text between two borders."""
        words = plain_words(text)
        ids = np.zeros(len(words) + 2, dtype=np.int64)
        ids[1:-1] = np.fromiter(map(self.__getitem__, words), dtype=np.int64, count=len(words))
        return ids


def _places(ids: np.ndarray) -> np.ndarray:
    """Index of each (left, right, token) window in a table of VOCAB ** 3."""
    return (ids[:-2] * VOCAB + ids[2:]) * VOCAB + ids[1:-1]


def window_counts(docs: DataFrame, words: list[bytes], text_col: str = "text") -> np.ndarray:
    """How often each window occurs in all documents: an array of VOCAB ** 3."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, tokens, n = np.zeros(VOCAB ** 3, dtype=np.int64), Tokens(words), 0
        for batch in batches:
            for lo in range(0, batch.num_rows, 2000):
                places = [_places(tokens.of(t)) for t in utf8(batch.column(0).slice(lo, 2000))]
                total += np.bincount(np.concatenate(places), minlength=VOCAB ** 3)
                n += len(places)
        yield from count_pieces(total, n)

    return sum_pieces(map_batches(docs.select(text_col), count, PIECES), VOCAB ** 3)[0]


class Network:
    """tanh(left embedding + right embedding) to a softmax over tokens."""

    def __init__(self, seed: int = 0):
        rng = np.random.default_rng(seed)
        self.p = {"left": rng.normal(0, 0.3, (VOCAB, HIDDEN)), "right": rng.normal(0, 0.3, (VOCAB, HIDDEN)),
                  "out": rng.normal(0, 0.1, (HIDDEN, VOCAB)), "bias": np.zeros(VOCAB)}

    def log_probabilities(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        hidden = np.tanh(self.p["left"][left] + self.p["right"][right])
        logits = hidden @ self.p["out"] + self.p["bias"]
        logits -= logits.max(axis=1, keepdims=True)
        return hidden, logits - np.log(np.exp(logits).sum(axis=1, keepdims=True))

    def train(self, counts: np.ndarray, epochs: int = EPOCHS, rate: float = 0.03) -> list[float]:
        """Adam on the mean negative log-likelihood of all windows; returns its course."""
        table = counts.reshape(VOCAB * VOCAB, VOCAB)
        seen = np.flatnonzero(table.sum(axis=1))
        if not len(seen):
            return []
        left, right = seen // VOCAB, seen % VOCAB
        target = table[seen] / table.sum()
        weight = target.sum(axis=1, keepdims=True)
        first = {k: np.zeros_like(v) for k, v in self.p.items()}
        second = {k: np.zeros_like(v) for k, v in self.p.items()}
        one_left, one_right = np.eye(VOCAB), np.eye(VOCAB)
        self.p["bias"] = np.log(target.sum(axis=0) + 1e-9)
        course = []
        for step in range(1, epochs + 1):
            hidden, logp = self.log_probabilities(left, right)
            course.append(float(-(target * logp).sum()))
            at_logits = np.exp(logp) * weight - target
            at_hidden = (at_logits @ self.p["out"].T) * (1 - hidden ** 2)
            grads = {"out": hidden.T @ at_logits, "bias": at_logits.sum(axis=0),
                     "left": one_left[left].T @ at_hidden, "right": one_right[right].T @ at_hidden}
            for k, g in grads.items():
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                self.p[k] = self.p[k] - rate * (first[k] / (1 - 0.9 ** step)) / (np.sqrt(second[k] / (1 - 0.999 ** step)) + 1e-10)
        return course

    def table(self) -> np.ndarray:
        """Log probability of every window, in the order of ``_places``."""
        left, right = np.divmod(np.arange(VOCAB * VOCAB), VOCAB)
        return self.log_probabilities(left, right)[1].astype(np.float32).ravel()


def fit(docs: DataFrame, text_col: str = "text", epochs: int = EPOCHS, counts: DataFrame | None = None) -> tuple[list[bytes], Network]:
    words = frequent_words(docs, text_col, counts=counts)
    network = Network()
    network.train(window_counts(docs, words, text_col), epochs)
    return words, network


class Within:
    """log P(word | class): ``table`` has rows (key, n, log_prob) of all words that share a class,
    ``novel`` by class what a word has that was never counted, before it is spelled."""

    def __init__(self, table: DataFrame, novel: np.ndarray):
        self.table, self.novel = table, novel


def fit_within(counts: DataFrame, words: list[bytes]) -> Within:
    """Shares of all counted words in their classes.

    A class of N occurrences of T words gives n / (N + T) to a word and T / (N + T) to all other
    words, which are spelled: each byte, and their end, is one of 257.
    """
    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = Tokens(words)
        for batch in batches:
            seen = batch.column(0).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [pa.array([_key(w) for w in seen], pa.int64()), pa.array([tokens[w] for w in seen], pa.int32()), batch.column(1)],
                names=["key", "token", "n"])

    rows = map_batches(counts.select("word", "n"), keys, "key long, token int, n long").filter(F.col("token") > FREQUENT)
    rows = materialize(rows, "word-keys")
    totals = rows.groupBy("token").agg(F.sum("n").alias("n"), F.count("*").alias("t")).collect()
    novel, whole = np.zeros(VOCAB), {r["token"]: r["n"] + r["t"] for r in totals}
    for r in totals:
        novel[r["token"]] = np.log(r["t"] / whole[r["token"]])
    sums = F.element_at(F.array(*[F.lit(float(whole.get(i, 1))) for i in range(VOCAB)]), F.col("token") + 1)
    return Within(materialize(rows.select("key", "n", F.log(F.col("n") / sums).alias("log_prob")), "word-shares"), novel)


def _shared_words(within: Within, most: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Keys in order and log probabilities of the words of at least ``floor`` occurrences, the
    lowest floor that leaves ``most`` of them, and the floor."""
    sizes, floor, total = within.table.groupBy("n").count().orderBy(F.desc("n")), 1, 0
    for r in sizes.toLocalIterator():
        total += r["count"]
        if total > most:
            floor = r["n"] + 1
            break
    rows = within.table.filter(F.col("n") >= floor).select("key", "log_prob").toArrow()
    keys = rows.column(0).to_numpy()
    order = np.argsort(keys)
    return keys[order], rows.column(1).to_numpy()[order], floor


class Shares(dict):
    """Word to log P(word | class), NaN if it is not among the shared words; remembers up to a bound."""

    def __init__(self, tokens: Tokens, keys: np.ndarray, log_probs: np.ndarray):
        super().__init__()
        self.tokens, self.keys, self.log_probs = tokens, keys, log_probs

    def __missing__(self, word: bytes) -> float:
        if len(self) > _MEMORY // 2:
            self.clear()
        share = 0.0
        if self.tokens[word] > FREQUENT:
            key = _key(word)
            i = int(np.searchsorted(self.keys, key))
            share = float(self.log_probs[i]) if i < len(self.keys) and self.keys[i] == key else np.nan
        self[word] = share
        return share


def score(
    docs: DataFrame, words: list[bytes], network: Network, id_col: str = "doc_id", text_col: str = "text",
    within: Within | None = None, shared_words: int = SHARED_WORDS,
) -> DataFrame:
    """One row per document row: doc_id, n_tokens, log_prob, mean_log_prob.

    With ``within`` the scores are those of the words, without it those of their classes only. Null
    texts and texts without words have no tokens, log_prob 0 and a null mean. Whole texts are
    scored; repeated rows are each answered alike. Words are told apart by 64 bits of hash. The
    ``shared_words`` most frequent ones are broadcast; if there are more, the rest is joined.
    """
    sc = docs.sparkSession.sparkContext
    keys, log_probs, floor = _shared_words(within, shared_words) if within else (None, None, 1)
    shared = sc.broadcast((words, network.table(), keys, log_probs, within.novel if within else None))
    state: dict = {}

    def scan(batch):
        known, table, keys, log_probs, novel = shared.value
        if not state:
            state["tokens"] = Tokens(known)
            state["shares"] = Shares(state["tokens"], keys, log_probs)
        tokens, shares = state["tokens"], state["shares"]
        n, total, rest = [], [], []
        for text in utf8(batch.column(1)):
            ids = tokens.of(text)
            n.append(len(ids) - 2)
            total.append(float(table[_places(ids)].sum(dtype=np.float64)))
            rest.append([])
            if novel is None:
                continue
            seen = plain_words(text)
            own = np.fromiter(map(shares.__getitem__, seen), dtype=np.float64, count=len(seen))
            for i in np.flatnonzero(np.isnan(own)).tolist():
                own[i] = novel[ids[i + 1]] - (len(seen[i]) + 1) * np.log(257)
                if floor > 1:
                    rest[-1].append({"key": _key(seen[i]), "novel": own[i]})
                    own[i] = 0
            total[-1] += float(own.sum())
        out = {"doc_id": batch.column(0), "n_tokens": n, "log_prob": total, "rest": rest}
        return out if floor == 1 else {"row": batch.column(2), **out}

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    schema = "doc_id long, n_tokens long, log_prob double, rest array<struct<key:long,novel:double>>"
    if floor == 1:
        rows = map_rows(rows, scan, schema)
    else:
        # Rows get a key of their own, written once, since ids repeat or are null.
        rows = rows.withColumn("row", F.monotonically_increasing_id())
        rows = materialize(map_rows(rows, scan, "row long, " + schema), "scores")
        rare = within.table.filter(F.col("n") < floor).select("key", "log_prob")
        joined = rows.select("row", F.explode("rest").alias("w")).select("row", "w.key", "w.novel").join(rare, "key", "left")
        added = joined.groupBy("row").agg(F.sum(F.coalesce("log_prob", "novel")).alias("added"))
        rows = rows.drop("rest").join(added, "row", "left").withColumn("log_prob", F.col("log_prob") + F.coalesce("added", F.lit(0.0)))
    return rows.select("doc_id", "n_tokens", "log_prob", F.when(F.col("n_tokens") > 0, F.col("log_prob") / F.col("n_tokens")).alias("mean_log_prob"))
