"""Toxicity from a weighted lexicon.

Texts are folded (lower case, look-alike letters, digits and signs that stand for letters) and
searched with Aho-Corasick. A lexicon entry is a whole word or a stem, with the log odds of its
document frequency in toxic and clean labelled documents as weight. A hit inside an exception
phrase does not count. The weights are summed and divided by the length of the text.
"""

from __future__ import annotations

import math
import re
import unicodedata

import numpy as np
from pyspark.sql import DataFrame, functions as F

from provtrail.llm.common import map_batches, map_rows, slices, small
from provtrail.llm.jaccard import jaccard_components
from provtrail.session import materialize

#: Parameters of the fit: labelled documents of each class at most (about, chosen by hash of the
#: id), entries and exceptions at most, the smallest share of toxic documents, weight and
#: log-likelihood ratio of an entry (it keeps out what is in toxic documents by chance), and the
#: shortest stem.
SAMPLE_DOCS = 10_000
MAX_ENTRIES = 2000
MIN_SHARE = 0.004
MIN_WEIGHT = 3.0
MIN_RATIO = 24.0
MIN_STEM = 4
#: Characters that are written for letters.
LOOKALIKES = {
    "0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", "|": "i",
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ј": "j", "ѕ": "s", "һ": "h", "ԁ": "d", "ԛ": "q", "ԝ": "w",
    "к": "k", "м": "m", "т": "t", "в": "b", "н": "h", "ӏ": "l", "ɡ": "g", "ı": "i",
    "α": "a", "ε": "e", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "ν": "v", "κ": "k", "ι": "i", "χ": "x",
}
_TABLE = str.maketrans(LOOKALIKES)
_INVISIBLE = dict.fromkeys((0x00AD, 0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF))
_EDGE = str.maketrans({"!": " ", "|": " ", "$": " ", "@": " "})
_WORD = re.compile(r"[^\W_]+")


def fold(text: str) -> str:
    """Fold look-alikes. Signs count as letters only inside a word, as in ``$tupid`` or ``1d!ot``."""
    if not text.isascii():
        text = unicodedata.normalize("NFKC", text).translate(_INVISIBLE)
    text = text.lower()
    if "!" in text or "|" in text or "$" in text or "@" in text:
        text = re.sub(r"[$@](?=[^\W_])|(?<=[^\W_])[!|$@](?=[^\W_])", lambda m: LOOKALIKES[m[0]], text).translate(_EDGE)
    return text.translate(_TABLE)


def _candidates(word: str):
    yield word, 0
    for n in range(MIN_STEM, min(len(word), 12)):
        yield word[:n], 1


def fit(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS, exceptions: tuple[str, ...] = ()) -> dict:
    """Fit on documents (doc_id, text) with labels (doc_id, toxic); rows with a null are no examples.

    Repeated labels of a document count once, as toxic if any is. Without both classes the lexicon
    is empty and every score 0. Counting is done on Spark; lexicon, exceptions and the sample's
    sums, each of bounded size, reach the driver.
    """
    marks = labels.filter("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    sizes = {r["toxic"]: r["count"] for r in marks.filter("toxic in (0, 1)").groupBy("toxic").count().collect()}
    model = {"words": {}, "stems": {}, "exceptions": tuple(fold(e) for e in exceptions), "cut": 1.0}
    if len(sizes) < 2:
        return model
    share = F.when(F.col("toxic") == 1, min(1.0, sample_docs / sizes[1])).otherwise(min(1.0, sample_docs / sizes[0]))
    picked = marks.filter("toxic in (0, 1)").filter(
        F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(1 << 20)) < share * (1 << 20)).select(
        F.col("doc_id").alias("_id"), F.col("toxic").alias("_toxic"))
    # At most about twice the sample of (id, label) pairs is broadcast, whatever the corpus holds.
    sample = _distinct(docs.filter("text is not null").join(
        F.broadcast(picked), F.col("doc_id") == F.col("_id")).select("doc_id", "_toxic", "text"))

    def count(batch):
        seen: dict[tuple, list] = {}
        docs_in = [0, 0]
        for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            docs_in[toxic] += 1
            for key in {c for w in set(_WORD.findall(fold(text))) for c in _candidates(w)}:
                seen.setdefault(key, [0, 0])[toxic] += 1
        seen[("", -1)] = docs_in
        return {"term": [k[0] for k in seen], "stem": [k[1] for k in seen],
                "clean": [v[0] for v in seen.values()], "bad": [v[1] for v in seen.values()]}

    counts = map_rows(sample, count, "term string, stem int, clean long, bad long").groupBy("term", "stem").agg(
        F.sum("clean").alias("clean"), F.sum("bad").alias("bad"))
    total = sample.groupBy("_toxic").count().collect()
    n = {r["_toxic"]: r["count"] for r in total}
    if len(n) < 2:
        return model
    weight = F.log((F.col("bad") + 0.5) / (n[1] + 1)) - F.log((F.col("clean") + 0.5) / (n[0] + 1))
    least = max(3, math.ceil(MIN_SHARE * n[1]))
    either, share_bad = F.col("bad") + F.col("clean"), n[1] / (n[0] + n[1])
    ratio = 2 * (F.col("bad") * F.log(F.col("bad") / (either * share_bad)) + F.when(
        F.col("clean") > 0, F.col("clean") * F.log(F.col("clean") / (either * (1 - share_bad)))).otherwise(0.0))
    kept = counts.filter((F.col("stem") >= 0) & (F.col("bad") >= least)).withColumn("weight", weight).filter(
        (F.col("weight") >= MIN_WEIGHT) & (ratio >= MIN_RATIO))
    rows = kept.orderBy(F.desc(F.col("weight") * F.col("bad")), "term", "stem").limit(MAX_ENTRIES).collect()
    # Of nested entries with the same documents the longest stays; then a stem covers what begins
    # with it, unless the longer entry is far purer.
    rows = [r for r in rows if not r["stem"] or not any(
        q is not r and q["term"].startswith(r["term"]) and q["bad"] >= 0.95 * r["bad"] and q["clean"] <= r["clean"] for q in rows)]
    stems: dict[str, float] = {}
    for r in sorted((r for r in rows if r["stem"]), key=lambda r: len(r["term"])):
        if not any(r["term"].startswith(s) and w >= r["weight"] - 1.5 for s, w in stems.items()):
            stems[r["term"]] = r["weight"]
    words = {r["term"]: r["weight"] for r in rows if not r["stem"] and not any(
        r["term"].startswith(s) and w >= r["weight"] - 1.5 for s, w in stems.items())}
    model |= {"words": words, "stems": stems}
    if not words and not stems:
        return model
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def phrases(batch):
        matcher = Matcher(shared.value)
        seen: dict[str, list] = {}
        for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            for phrase in matcher.contexts(fold(text)):
                seen.setdefault(phrase, [0, 0])[toxic] += 1
        return {"phrase": list(seen), "clean": [v[0] for v in seen.values()], "bad": [v[1] for v in seen.values()]}

    found = map_rows(sample, phrases, "phrase string, clean long, bad long").groupBy("phrase").agg(
        F.sum("clean").alias("clean"), F.sum("bad").alias("bad"))
    found = found.filter((F.col("clean") >= 3) & (F.col("clean") * n[1] >= 4 * F.col("bad") * n[0]))
    learned = [r["phrase"] for r in found.orderBy(F.desc("clean"), "phrase").limit(MAX_ENTRIES).collect()]
    model["exceptions"] = (*model["exceptions"], *learned)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def sums(batch):
        matcher = Matcher(shared.value)
        return {"x": [matcher.density(t) for t in batch.column(0).to_pylist()], "toxic": batch.column(1)}

    points = np.array([(r["x"], r["toxic"]) for r in map_rows(sample, sums, "x double, toxic int").collect()])
    model["cut"] = _cut(points[:, 0], points[:, 1])
    return model


def _distinct(sample: DataFrame) -> DataFrame:
    """Labelled texts (text, _toxic) with one of each group of near copies in a class, whose chance words
    would look like evidence otherwise.

    Near copies are linked by a similarity of 75 % of their word shingles, verified on whole texts.
    """
    rows = materialize(sample.groupBy("doc_id", "_toxic").agg(F.min("text").alias("text")), "toxicity-sample")
    groups = jaccard_components(rows.select("doc_id", "text")).select(F.col("doc_id").alias("_id"), "component_id")
    first = groups.join(rows.select("doc_id", "_toxic"), F.col("_id") == F.col("doc_id")).groupBy("component_id", "_toxic").agg(
        F.min("doc_id").alias("doc_id"))
    return rows.join(small(materialize(first.select("doc_id"), "toxicity-first")), "doc_id", "left_semi").select("text", "_toxic")


def _cut(x: np.ndarray, toxic: np.ndarray) -> float:
    """The density that divides the sample with the fewest errors, classes weighing the same."""
    levels = np.unique(x[x > 0])
    if not len(levels):
        return 1.0
    bad, clean = np.sort(x[toxic == 1]), np.sort(x[toxic == 0])
    missed = np.searchsorted(bad, levels, side="left") / max(1, len(bad))
    blamed = 1 - np.searchsorted(clean, levels, side="left") / max(1, len(clean))
    best = int(np.argmin(missed + blamed))
    below = levels[best - 1] if best else 0.0
    return float((below + levels[best]) / 2)


class Matcher:
    """Aho-Corasick over folded text."""

    def __init__(self, model: dict):
        import ahocorasick

        self.machine = ahocorasick.Automaton()
        self.cut = model["cut"]
        entries: dict[str, list] = {}
        for term, weight in model["words"].items():
            entries.setdefault(term, []).append(("word", weight))
        for term, weight in model["stems"].items():
            entries.setdefault(term, []).append(("stem", weight))
        for phrase in model["exceptions"]:
            entries.setdefault(phrase, []).append(("except", 0.0))
        for term, kinds in entries.items():
            self.machine.add_word(term, (len(term), kinds))
        self.any = bool(entries)
        if self.any:
            self.machine.make_automaton()

    def hits(self, text: str) -> list[tuple[int, int, float]]:
        """Counted hits (first, end, weight): at a word start, the heaviest of a word, outside exceptions."""
        if not self.any:
            return []
        best: dict[int, tuple[int, float]] = {}
        free: list[tuple[int, int]] = []
        n = len(text)
        for last, (size, kinds) in self.machine.iter(text):
            first, end = last - size + 1, last + 1
            if first and text[first - 1].isalnum():
                continue
            closed = end == n or not text[end].isalnum()
            for kind, weight in kinds:
                if kind == "except":
                    if closed:
                        free.append((first, end))
                elif (kind == "stem" or closed) and weight > best.get(first, (0, 0.0))[1]:
                    best[first] = (end, weight)
        return [(first, end, w) for first, (end, w) in sorted(best.items())
                if not any(a <= first and end <= b for a, b in free)]

    def contexts(self, text: str) -> set[str]:
        """The two-word phrases around hits."""
        found = set()
        for first, end, _ in self.hits(text):
            while end < len(text) and text[end].isalnum():
                end += 1
            if before := re.search(r"([^\W_]+)\s$", text[max(0, first - 40):first]):
                found.add(f"{before[1]}{text[first - 1]}{text[first:end]}")
            if after := re.match(r"\s[^\W_]+", text[end:end + 40]):
                found.add(text[first:end] + after[0])
        return found

    def density(self, text: str | None) -> float:
        if not text or not self.any:
            return 0.0
        folded = fold(text)
        hits = self.hits(folded)
        return sum(w for _, _, w in hits) / (20 + len(folded.split())) if hits else 0.0


def score(docs: DataFrame, model: dict) -> DataFrame:
    """One row per document row: doc_id, score, predicted. Null and empty texts score 0.

    The score is x / (x + cut) for the weight x per word, so 0.5 at the fitted cut. Whole texts are
    searched, and repeated rows are each answered alike.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    state: dict = {}

    def scan(batch):
        if "matcher" not in state:
            state["matcher"] = Matcher(shared.value)
        matcher = state["matcher"]
        x = np.array([matcher.density(t) for t in batch.column(1).to_pylist()])
        s = x / (x + matcher.cut)
        return {"doc_id": batch.column(0), "score": s, "predicted": (s >= 0.5).astype(np.int32)}

    return map_rows(docs.select("doc_id", "text"), scan, "doc_id long, score double, predicted int")


def reject_toxic(docs: DataFrame, model: dict) -> DataFrame:
    """``docs`` with its own columns, without rows predicted toxic."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")
    state: dict = {}

    def scan(batches):
        import pyarrow as pa

        for batch in slices(batches):
            if "matcher" not in state:
                state["matcher"] = Matcher(shared.value)
            matcher = state["matcher"]
            keep = [matcher.density(t) < matcher.cut for t in batch.column(at).to_pylist()]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return map_batches(docs, scan, docs.schema)
