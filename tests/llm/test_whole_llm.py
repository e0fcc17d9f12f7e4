"""Results that must be whole: every word scored, asked weights kept, blocks that change nothing."""

import math
from collections import Counter

from provtrail.llm import decontaminate, lmscore, mixing
from provtrail.llm.common import plain_words

TEXTS = [f"common words here {chr(97 + i % 26)}ing{i} walking talking" for i in range(300)] + ["слово другое", None, ""]


def test_every_word_has_its_share_of_its_class(spark):
    """Also with most words joined instead of broadcast; ids repeat or are null."""
    rows = [(i % 50 if i % 7 else None, t) for i, t in enumerate(TEXTS)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    counts = lmscore.word_counts(docs)
    words, network = lmscore.fit(docs, epochs=3, counts=counts)
    within = lmscore.fit_within(counts, words)
    tokens = lmscore.Tokens(words)
    seen = Counter(w for t in TEXTS for w in plain_words(t.encode() if t else None))
    classes, kinds = Counter(), Counter()
    for w, n in seen.items():
        classes[tokens[w]] += n
        kinds[tokens[w]] += 1
    odd = [(1, "walking zzzqing0"), (1, "walking zzzqing0"), (None, "аслово слово")]
    odd = docs.union(spark.createDataFrame(odd, "doc_id long, text string"))

    def want(text):
        total = 0.0
        for w in plain_words(text.encode() if text else None):
            c = tokens[w]
            if c > lmscore.FREQUENT:
                whole = classes[c] + kinds[c]
                total += math.log(seen[w] / whole) if w in seen else math.log(kinds[c] / whole) - (len(w) + 1) * math.log(257)
        return total

    place = lambda r: (r[0] is not None, r[0] or 0, r[1], round(r[2], 4))
    only = lmscore.score(odd, words, network).collect()
    expected = sorted(place((r.doc_id, c.n_tokens, c.log_prob + want(r.text))) for r, c in zip(odd.collect(), only))
    for shared in (lmscore.SHARED_WORDS, 100, 0):
        got = lmscore.score(odd, words, network, within=within, shared_words=shared).collect()
        assert sorted(place((r.doc_id, r.n_tokens, r.log_prob)) for r in got) == expected


def test_gibberish_with_the_same_endings_scores_lower(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    counts = lmscore.word_counts(docs)
    words, network = lmscore.fit(docs, epochs=3, counts=counts)
    two = spark.createDataFrame([(1, TEXTS[5]), (2, TEXTS[5].replace("fing5", "qzxqng5"))], "doc_id long, text string")
    a, b = (r.log_prob for r in lmscore.score(two, words, network, within=lmscore.fit_within(counts, words)).orderBy("doc_id").collect())
    assert b < a - 5


def test_mixing_keeps_the_weights_asked_for(spark):
    """More sources than any bound, against the weights themselves; weight 0 comes last, nothing is dropped."""
    df = spark.range(60_000).selectExpr("id AS doc_id", """CASE WHEN id % 2 = 0 THEN 'hot' WHEN id % 1001 = 1 THEN NULL
        WHEN id % 1001 = 3 THEN 'zero' ELSE 's' || (id div 2 % 500) END AS source""")
    weights = {"hot": 0.5, None: 0.0001, "zero": 0, **{f"s{i}": 0.4999 / 500 for i in range(500)}}
    rows = mixing.mix(df, weights, block_rows=4).collect()
    assert sorted(r.doc_id for r in rows) == list(range(60_000)) and len({(r.source, r.block) for r in rows}) == len({r.slot for r in rows})
    assert all(r.release <= r.slot < r.deadline for r in rows)
    assert min(r.slot for r in rows if r.source == "zero") > max(r.slot for r in rows if r.source != "zero")
    slots = {r.slot: r.source for r in rows if r.mixed}
    end, done, total = next(t for t in range(10**9) if t not in slots), Counter(), sum(weights.values())
    for t in range(end):
        done[slots[t]] += 1
        assert all(abs(done[s] - w / total * (t + 1)) < 1.001 for s, w in weights.items())
    assert end > 5000


def test_blocks_of_the_benchmark_change_nothing(spark):
    """Repeated and null ids, and spans of different blocks that overlap or would touch after a cut."""
    w = [f"w{i}" for i in range(40)]
    items = [(i, " ".join(w[2 * i:2 * i + 10])) for i in range(12)] + [(90, "left1 right1"), (None, " ".join(w[30:40]))]
    bench = spark.createDataFrame(items, "item_id long, text string")
    text = " ".join(w)
    rows = [(1, text), (1, text), (1, "other"), (None, text), (None, "w1 w2"), (None, None), (2, ""), (3, f"left1 {text} right1"), (4, f"x {' '.join(w[3:33])} y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    place = lambda rows: sorted(map(str, rows))
    hits = [place(decontaminate.find_hits(docs, bench, max_bytes=b).collect()) for b in (1 << 20, 400)]
    assert len(hits[0]) == 9 and hits[0] == hits[1]
    for action in ("span", "document"):
        kept = [place(decontaminate.decontaminate(docs, bench, action, max_bytes=b).collect()) for b in (1 << 20, 400)]
        assert kept[0] == kept[1]
