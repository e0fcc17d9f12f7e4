"""Language identification by word-first backoff.

A known word scores by its log frequency in each language. An unseen word falls back to its
character n-grams, longest first: the first length of which any n-gram is known decides.
"""

from __future__ import annotations

import math
import re

import numpy as np
from pyspark.sql import DataFrame, functions as F

from provtrail.llm.common import map_rows
from provtrail.session import materialize

#: Parameters of the fit. Words and n-grams under the share are left out, which bounds the model
#: to 1 / share entries a language and length, whatever the corpus holds.
SAMPLE_DOCS = 3000
MIN_SHARE = 1e-5
MAX_GRAM = 4
MAX_LANGS = 400
_LETTERS = re.compile(r"[^\W\d_]+")
_CACHE = 400_000


def _grams(word: str, n: int):
    marked = f"\x02{word}\x03"
    return (marked[i:i + n] for i in range(len(marked) - n + 1)) if n > 1 else iter(word)


def fit(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, min_share: float = MIN_SHARE) -> dict:
    """Fit on labelled rows (doc_id, text, lang): about ``sample_docs`` a language, by hash of the id.

    Rows without text or lang are no examples. Word and n-gram counts are made on Spark; what
    reaches the driver is bounded by ``min_share``.
    """
    rows = docs.filter("text is not null and lang is not null")
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().limit(MAX_LANGS + 1).collect()}
    if len(sizes) > MAX_LANGS:
        raise ValueError(f"more than {MAX_LANGS} languages")
    model = {"langs": sorted(sizes), "words": {}, "grams": {}, "floor": {}}
    if not sizes:
        return model
    share = F.lit(1.0)
    for lang, n in sizes.items():
        share = F.when(F.col("lang") == lang, min(1.0, sample_docs / n)).otherwise(share)
    picked = F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(1 << 20)) < share * (1 << 20)

    def count(batch):
        seen: dict[tuple, int] = {}
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            for word in _LETTERS.findall(text.lower()):
                seen[lang, word] = seen.get((lang, word), 0) + 1
        keys = list(seen)
        return {"lang": [k[0] for k in keys], "word": [k[1] for k in keys], "n": list(seen.values())}

    words = map_rows(rows.filter(picked).select("lang", "text"), count, "lang string, word string, n long")
    words = words.groupBy("lang", "word").agg(F.sum("n").alias("n"))

    def grams(batch):
        seen: dict[tuple, int] = {}
        for lang, word, n in zip(*(batch.column(i).to_pylist() for i in range(3))):
            seen[lang, 0, word] = n
            for size in range(1, MAX_GRAM + 1):
                for gram in _grams(word, size):
                    seen[lang, size, gram] = seen.get((lang, size, gram), 0) + n
        keys = list(seen)
        return {"lang": [k[0] for k in keys], "size": [k[1] for k in keys], "gram": [k[2] for k in keys],
                "n": list(seen.values())}

    grams_of = map_rows(words, grams, "lang string, size int, gram string, n long").groupBy(
        "lang", "size", "gram").agg(F.sum("n").alias("n"))
    grams_of = materialize(grams_of, "langid-grams")
    totals = {(r["lang"], r["size"]): r["n"] for r in grams_of.groupBy("lang", "size").agg(F.sum("n").alias("n")).collect()}
    total_rows = grams_of.groupBy("lang", "size").agg(F.sum("n").alias("total"))
    kept = grams_of.join(F.broadcast(total_rows), ["lang", "size"]).filter(F.col("n") >= F.col("total") * min_share)
    at = {lang: i for i, lang in enumerate(model["langs"])}
    floors = np.array([[math.log(0.5 * min_share)] * len(at)], dtype=np.float32)
    tables: dict[int, dict[str, np.ndarray]] = {size: {} for size in range(MAX_GRAM + 1)}
    for r in kept.toLocalIterator():
        row = tables[r["size"]].setdefault(r["gram"], floors[0].copy())
        row[at[r["lang"]]] = math.log(r["n"] / totals[r["lang"], r["size"]])
    model["words"] = tables.pop(0)
    model["grams"] = tables
    return model


class _Rows(dict):
    """Word to row; an unseen word gets a new row."""

    def __init__(self, words, add):
        super().__init__((w, i) for i, w in enumerate(words))
        self.add = add

    def __missing__(self, word):
        i = self[word] = len(self)
        self.add(i, word)
        return i


class Scorer:
    """Scores texts with a fitted model; remembers words between texts, up to a bound."""

    def __init__(self, model: dict):
        self.model, self.langs = model, model["langs"]
        self._reset()

    def _reset(self) -> None:
        words = self.model["words"]
        self.at = _Rows(words, self._add)
        self.rows = np.zeros((len(words) + _CACHE, len(self.langs)), dtype=np.float32)
        if words:
            self.rows[:len(words)] = list(words.values())

    def _unseen(self, word: str) -> np.ndarray | None:
        for size in range(MAX_GRAM, 0, -1):
            table = self.model["grams"].get(size, {})
            found = [table[g] for g in _grams(word, size) if g in table]
            if found:
                return np.mean(found, axis=0)
        return None

    def _add(self, i: int, word: str) -> None:
        if (vector := self._unseen(word)) is not None:
            self.rows[i] = vector

    def predict(self, text: str | None) -> tuple[str, float]:
        words = _LETTERS.findall(text.lower()) if text else []
        if not self.langs or not any(any(map(str.isalpha, w)) for w in words):
            return "und", 0.0
        total = np.zeros(len(self.langs))
        for i in range(0, len(words), 100_000):
            part = words[i:i + 100_000]
            if len(self.at) + len(part) > len(self.rows):
                self._reset()
            index = list(map(self.at.__getitem__, part))
            total += self.rows[index].sum(axis=0, dtype=np.float64)
        odds = np.exp(total - total.max())
        best = int(np.argmax(total))
        return self.langs[best], float(odds[best] / odds.sum())


def predict(docs: DataFrame, model: dict) -> DataFrame:
    """One row per document row: doc_id, lang_pred, score.

    Null texts and texts without a letter are ``und`` with score 0. A letter no language knows
    leaves all languages equal: the alphabetically first, score 1 / languages. Ties go to the
    first language. With no learned language everything is ``und``.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    state: dict = {}

    def scan(batch):
        scorer = state.get("scorer")
        if scorer is None:
            scorer = state["scorer"] = Scorer(shared.value)
        found = [scorer.predict(t) for t in batch.column(1).to_pylist()]
        return {"doc_id": batch.column(0), "lang_pred": [f[0] for f in found], "score": [f[1] for f in found]}

    return map_rows(docs.select("doc_id", "text"), scan, "doc_id long, lang_pred string, score double")
