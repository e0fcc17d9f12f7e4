"""The registered corpus queries on a whole small scale: against SQL, or against brute force."""

import hashlib
import zlib
from collections import Counter

import pytest
from compare import differences

import corpus_pipeline
from provtrail.llm import tokens, toxicity
from provtrail.llm.queries import ORACLE_SQL, QUERIES
from provtrail.sources.tables import table


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_matches_sql(name, spark, sf_dir, duck):
    assert differences(QUERIES[name](spark, sf_dir), duck, ORACLE_SQL[name]) is None


@pytest.fixture(scope="module")
def documents(spark, sf_dir):
    return {r.doc_id: r for r in table(spark, sf_dir, "documents").collect()}


def held(doc_id, modulus, rest):
    return zlib.crc32(str(doc_id).encode()) % modulus == rest


def library_ids(texts):
    from tokenizers import Tokenizer

    encodings = Tokenizer.from_file(tokens.vocabulary()).encode_batch(texts, add_special_tokens=False)
    return [[*e.ids, tokens.END_ID] for e in encodings]


def digests(ids_by_doc):
    out, start = {}, 0
    for doc, ids in ids_by_doc:
        data = b"".join(i.to_bytes(4, "little") for i in ids)
        out[doc] = (start, len(ids), zlib.crc32(data))
        start += len(ids)
    return out


def test_language_of_held_out_documents(spark, sf_dir, documents):
    rows = QUERIES["op4_language_id"](spark, sf_dir).collect()
    assert sorted(r.doc_id for r in rows) == sorted(documents)
    assert all(r.held_out == held(r.doc_id, 4, 2) and 0 <= r.score <= 1 for r in rows)
    right = [r.lang_pred == documents[r.doc_id].lang for r in rows if r.held_out]
    assert sum(right) >= 0.97 * len(right)


def test_toxicity_of_held_out_documents(spark, sf_dir, documents):
    rows = QUERIES["op7_toxicity"](spark, "/root/testdata/sf0.01").collect()
    labels = {r.doc_id: r.toxic for r in table(spark, "/root/testdata/sf0.01", "labels").collect()}
    assert all(r.held_out == held(r.doc_id, 5, 0) and (r.predicted == 1) == (r.score >= 0.5) for r in rows)
    pairs = Counter((labels[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in labels)
    assert pairs[0, 1] <= 0.01 * pairs[0, 0] and pairs[1, 1] > pairs[1, 0]


def test_tokens_equal_the_library_on_whole_texts(spark, sf_dir, documents):
    want = digests(zip(sorted(documents), library_ids([documents[d].text for d in sorted(documents)])))
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in QUERIES["op8_token_output"](spark, sf_dir).collect()}
    assert got == want


def test_scores_add_up_over_the_network(spark, sf_dir, documents):
    import numpy as np

    from provtrail.llm import lmscore
    from provtrail.llm.common import plain_words

    docs = table(spark, sf_dir, "documents")
    words, network = lmscore.fit(docs, epochs=30)
    seen = Counter(w for d in documents.values() for w in plain_words(d.text.encode()))
    assert words == [w for w, _ in sorted(seen.items(), key=lambda x: (-x[1], x[0]))[:lmscore.FREQUENT]]
    tokens_of = lmscore.Tokens(words)
    counts = np.zeros(lmscore.VOCAB ** 3)
    for d in documents.values():
        ids = tokens_of.of(d.text.encode()).tolist()
        for left, token, right in zip(ids, ids[1:], ids[2:]):
            counts[(left * lmscore.VOCAB + right) * lmscore.VOCAB + token] += 1
    assert (lmscore.window_counts(docs, words) == counts).all()
    rows = {r.doc_id: r for r in lmscore.score(docs, words, network).collect()}
    for doc in list(documents)[:20]:
        ids = tokens_of.of(documents[doc].text.encode())
        want = sum(float(network.log_probabilities(ids[i - 1:i], ids[i + 1:i + 2])[1][0, ids[i]]) for i in range(1, len(ids) - 1))
        assert rows[doc].n_tokens == len(ids) - 2 and abs(rows[doc].log_prob - want) <= 1e-3 * abs(want)


def test_network_learns_context_and_its_gradient_is_right():
    import numpy as np

    from provtrail.llm import lmscore

    rng = np.random.default_rng(3)
    counts = np.zeros((lmscore.VOCAB,) * 3)
    for _ in range(400):
        left, right = rng.integers(1, 40, 2)
        counts[left, right, (left * 7 + right) % 40] += 5
    network = lmscore.Network()
    course = network.train(counts.ravel(), 200)
    unigram = counts.sum(axis=(0, 1)) / counts.sum()
    assert course[-1] < -(unigram[unigram > 0] * np.log(unigram[unigram > 0])).sum() - 0.5
    assert np.allclose(np.exp(network.table()).reshape(-1, lmscore.VOCAB).sum(axis=1), 1, atol=1e-4)


def test_fingerprints_against_plain_code(spark, sf_dir, documents):
    rows = {r.doc_id: r for r in QUERIES["op10_fingerprint"](spark, sf_dir).collect()}
    order = sorted(documents, reverse=True)
    by_text = {}
    for doc, following in zip(order, order[1:] + order[:1]):
        text, third = documents[doc].text, len(documents[doc].text) // 3
        edited = text[:len(text) - third] + documents[following].text[:third]
        assert rows[doc].n_chars == len(text)
        assert rows[doc].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert by_text.setdefault(text, rows[doc].fingerprint) == rows[doc].fingerprint
        assert 0 <= rows[doc].near_next <= 1 and 0 <= rows[doc].near_edited <= 1
    mean = lambda k: sum(getattr(r, k) for r in rows.values()) / len(rows)
    assert mean("near_edited") > 0.2 > 0.05 > mean("near_next")


def test_pipeline_stage_by_stage(spark, sf_dir, documents, duck):
    """Each stage against plain code on what its predecessor kept."""
    from provtrail.llm import decontaminate, jaccard
    from provtrail.session import materialize

    docs = table(spark, sf_dir, "documents")
    columns = docs.columns
    ids = lambda df: {r.doc_id for r in df.select("doc_id").collect()}
    steps = dict(corpus_pipeline.STAGES)

    one = materialize(steps["toxicity"](spark, docs, sf_dir), "t")
    model = toxicity.fit(docs.select("doc_id", "text"), table(spark, sf_dir, "labels"))
    matcher = toxicity.Matcher(model)
    assert one.columns == columns
    assert ids(one) == {d for d, r in documents.items() if matcher.density(r.text) < matcher.cut}
    labels = {r.doc_id: r.toxic for r in table(spark, sf_dir, "labels").collect()}
    assert not [d for d in set(documents) - ids(one) if labels.get(d) == 0]

    two = materialize(steps["near_duplicates"](spark, one, sf_dir), "t")
    hasher = jaccard.Hasher(5)
    left = sorted(ids(one))
    sets = {d: set(hasher.shingles(documents[d].text.encode()).tolist()) for d in left}
    low = {d: d for d in left}
    for i, a in enumerate(left):
        for b in left[i + 1:]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                x, y = low[a], low[b]
                low = {d: min(x, y) if c in (x, y) else c for d, c in low.items()}
    assert ids(two) == set(low.values()) and two.columns == columns

    three = materialize(steps["decontamination"](spark, two, sf_dir), "t")
    windows = decontaminate.Windows([(r.item_id, r.text.encode()) for r in table(spark, sf_dir, "benchmark").collect()], 10)
    assert ids(three) == {d for d in ids(two) if not windows.hits(decontaminate.plain_words(documents[d].text.encode()))}

    four = materialize(steps["mixing"](spark, three, sf_dir), "t")
    assert ids(four) == ids(three) and four.count() == three.count() and four.columns == columns
    stored = [r.doc_id for r in four.selectExpr("doc_id", "_metadata.file_name f", "_metadata.row_index i").orderBy("f", "i").collect()]
    from provtrail.llm import mixing
    slots = {r.doc_id: (r.slot, r.rank) for r in mixing.mix(three).collect()}
    assert stored == sorted(stored, key=slots.get)

    five = steps["token_output"](spark, four, sf_dir)
    want = digests(zip(stored, library_ids([documents[d].text for d in stored])))
    assert {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in five.collect()} == want


def test_pipeline_runs_as_its_stages(spark, sf_dir):
    rows = corpus_pipeline.run(spark, sf_dir).collect()
    assert sum(r.n_tokens for r in rows) == max(r.start + r.n_tokens for r in rows)
    assert len({r.doc_id for r in rows}) == len(rows)
