"""Nulls, empty and very long texts, ties, repeated rows, empty tables, clashing columns."""

import random
from collections import Counter

import numpy as np
import pytest

from provtrail.llm import (
    chat, common, decontaminate, fingerprint, jaccard, langid, license, lmscore, mixing, tokens, toxicity)

DDL = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau".split()


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) for _ in range(n))


@pytest.fixture(scope="module")
def odd(spark):
    """Rows of every odd kind, with extra columns whose names operators use inside."""
    rows = [
        (1, None, "en", "a", None), (2, "", "en", "a", 0), (3, " \n\t ", None, None, 3), (4, "!?.", "en", "a", 3),
        (5, prose(1, 60), "en", "a", None), (5, prose(1, 60), "en", "a", None), (6, prose(1, 60), "fr", None, None),
        (None, prose(2, 30), None, "b", None), (8, prose(3, 40_000), "en", "b", None), (9, "x" * 300_000, "en", "b", None),
        (10, "Été ÄÖ 数据 \U0001f600 ẞ", "de", "", 1), (11, "one two", "en", "b", 1), (12, "One TWO", "en", "b", 1)]
    df = spark.createDataFrame(rows, DDL)
    names = ["n", "words", "hits", "found", "_id", "_gone", "_slot", "_i", "component", "cell", "block", "key", "rep", "part", "slot", "score"]
    return df.selectExpr("*", *[f"'clash' AS {c}" for c in names])


@pytest.fixture(scope="module")
def none(odd):
    return odd.limit(0)


def test_license(odd, none, spark):
    rows = license.scan_licenses(odd).collect()
    assert len(rows) == 13 and all(r.n_base == 0 and r.labels == "" and r.first_word is None for r in rows)
    assert {r.doc_id: r.n_words for r in rows}[8] == 40_000 and {r.doc_id: r.n_words for r in rows}[1] == 0
    assert license.scan_licenses(none).collect() == []
    text = "Under the MIT License, under the mit-license. CC BY-NC! cc byK nc apache license, version 2"
    df = spark.createDataFrame([(1, text), (1, text)], "doc_id long, text string")
    for r in license.scan_licenses(df).collect():
        assert (r.n_base, r.first_word, r.last_word, r.base_labels) == (4, 0, 14, "apache-2,cc-by-nc,mit")


def test_decontaminate(odd, none, spark):
    bench = spark.createDataFrame(
        [(7, prose(1, 25)), (7, prose(1, 25)), (8, None), (9, ""), (None, "ONE, two"), (10, "数据")], "item_id long, text string")
    rows = {(r.doc_id, r.n_words): r for r in decontaminate.find_hits(odd, bench).collect()}
    r = rows[5, 60]
    assert (r.n_hit, r.n_items, r.contaminated) == (25, 1, True) and [tuple(s) for s in r.spans] == [(0, 25)]
    assert rows[11, 2].n_hit == 2 and rows[11, 2].n_items == 0 and rows[10, 5].n_hit == 1
    assert not rows[1, 0].contaminated
    kept = decontaminate.decontaminate(odd, bench)
    assert kept.columns == odd.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter([1, 2, 3, 4, None, 8, 9])
    cut = {r.doc_id: r.text for r in decontaminate.decontaminate(odd, bench, action="span").collect()}
    assert cut[11] == "" and cut[5].split() == prose(1, 60).split()[25:] and cut[1] is None
    assert decontaminate.find_hits(none, bench).collect() == []
    nothing = decontaminate.find_hits(odd, bench.limit(0)).collect()
    assert len(nothing) == 13 and not any(r.contaminated for r in nothing)
    with pytest.raises(ValueError):
        decontaminate.decontaminate(odd, bench, action="other")


def test_decontaminate_in_blocks_equals_one(spark, sf_dir):
    docs, bench = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    one = decontaminate.find_hits(docs, bench).orderBy("doc_id").collect()
    assert decontaminate.find_hits(docs, bench, max_bytes=2000).orderBy("doc_id").collect() == one


def test_mixing(odd, none, spark):
    rows = mixing.mix(odd).collect()
    assert Counter(r.doc_id for r in rows) == Counter([1, 2, 3, 4, 5, 5, 6, None, 8, 9, 10, 11, 12])
    assert mixing.mix(none).collect() == []
    laid = mixing.mixed_order(odd)
    assert laid.columns == odd.columns and laid.count() == 13
    many = mixing.mix(spark.range(1500).selectExpr("id AS doc_id", "cast(id % 500 AS string) AS source"), block_rows=1).collect()
    assert len({r.slot for r in many}) == 1500 and sum(mixing.target_shares({str(i): 3 for i in range(500)}).values()) == 2000


def test_mixing_stays_within_one_block(spark):
    """At every slot before a source has run out each source is less than a block from its target."""
    df = spark.range(40_000).selectExpr("id AS doc_id", "CASE WHEN id % 3 = 0 THEN 'hot' ELSE 's' || (id % 7) END AS source")
    weights = {"hot": 0.5, "s0": 3.0, "s1": 1.0, "s2": 0.01}
    rows = mixing.mix(df, weights, block_rows=8).filter("mixed").select("source", "block", "slot", "release", "deadline").distinct().collect()
    assert all(r.release <= r.slot < r.deadline for r in rows)
    slots = {r.slot: r.source for r in rows}
    end = next(t for t in range(10**9) if t not in slots)
    done = Counter()
    for t in range(end):
        done[slots[t]] += 1
        assert all(abs(done[s] - w / sum(weights.values()) * (t + 1)) < 1 for s, w in weights.items())
    assert end > 100


def test_language(odd, none, spark):
    model = langid.fit(odd.select("doc_id", "text", "lang"))
    assert model["langs"] == ["de", "en", "fr"]
    got = {r.doc_id: r for r in langid.predict(odd, model).collect()}
    assert [got[i].lang_pred for i in (1, 2, 3, 4)] == ["und"] * 4 and got[1].score == 0
    assert got[8].lang_pred in ("en", "fr") and 0 < got[8].score <= 1
    assert langid.predict(none, model).collect() == []
    empty = langid.fit(none.select("doc_id", "text", "lang"))
    assert {r.lang_pred for r in langid.predict(odd, empty).collect()} == {"und"}


def test_language_backs_off_from_words_to_shorter_grams():
    rows = {"abcd": np.array([0.0, -9.0], np.float32)}
    gram = lambda a, b: np.array([a, b], np.float32)
    model = {"langs": ["x", "y"], "words": rows, "grams": {
        4: {"zzzz": gram(-9, 0)}, 3: {"qqq": gram(0, -9)}, 2: {"qq": gram(-9, 0)}, 1: {"w": gram(-9, 0)}}}
    s = langid.Scorer(model)
    assert [s.predict(t)[0] for t in ("abcd", "zzzzqqq", "aqqqa", "aqqa", "w", "k")] == ["x", "y", "x", "y", "y", "x"]


def brute_components(texts):
    hasher = jaccard.Hasher(5)
    sets = {d: set(hasher.shingles(t.encode() if t else None).tolist()) for d, t in texts.items()}
    low = {d: d for d in texts}
    names = sorted(texts)
    for i, a in enumerate(names):
        for b in names[i + 1:]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both) and low[a] != low[b]:
                x, y = low[a], low[b]
                low = {d: min(x, y) if c in (x, y) else c for d, c in low.items()}
    return {d: (len(sets[d]), low[d]) for d in texts}


def test_jaccard(odd, none):
    rows = {r.doc_id: r for r in jaccard.jaccard_components(odd).collect()}
    assert (rows[5].component_id, rows[6].component_id, rows[12].component_id, rows[2].component_id) == (5, 5, 11, 2)
    assert rows[1].n_shingles == 0 and rows[11].n_shingles == 1 and rows[None].component_id is None
    assert jaccard.jaccard_components(none).collect() == []
    kept = jaccard.keep_first(odd)
    assert kept.columns == odd.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter([1, 2, 3, 4, 5, 5, None, 8, 9, 10, 11])


def families(n, seed):
    """Chains of edited copies around the threshold, a passage that half of all share, and copies."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(4000)]
    passage = [rng.choice(vocabulary) for _ in range(40)]
    texts, base = {}, []
    for i in range(n):
        if i % 12 == 0:
            base = [rng.choice(vocabulary) for _ in range(rng.randrange(8, 160))]
        words = list(base)
        for _ in range(rng.randrange(0, 1 + len(words) // 20)):
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
        texts[i] = " ".join(passage + words if i % 2 else words)
    return texts


@pytest.mark.parametrize("block", [jaccard.BLOCK_SHINGLES, 900])
def test_jaccard_against_brute_force(spark, block):
    """Also with cells that are cut into many blocks."""
    texts = families(360, 4)
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.jaccard_components(df, block_shingles=block).collect()}
    assert got == brute_components(texts)


def test_signature_tree_prunes_but_loses_nothing():
    hasher = jaccard.Hasher(5)
    sets = [hasher.shingles(t.encode()) for t in families(300, 9).values()]
    links = jaccard.Links(jaccard.Tree(sets)).run()
    root = list(range(len(sets)))
    for a, b in links:
        assert jaccard.linked(sets[a], sets[b])
        root = [root[a] if r == root[b] else r for r in root]
    assert not [1 for a in range(len(sets)) for b in range(a) if root[a] != root[b] and jaccard.linked(sets[a], sets[b])]


def test_components_of_long_chains(spark):
    edges = spark.range(1, 400).selectExpr("id AS a", "id - 1 AS b").union(spark.createDataFrame([(900, 901), (901, 901)], "a long, b long"))
    got = {r.node: r.component for r in common.components(edges, "test").collect()}
    assert got == {**{i: 0 for i in range(400)}, 900: 900, 901: 900}


def test_chat(spark):
    rows = [
        (1, 0, "user", None), (1, 1, "assistant", "a<|im_end|>b<\\|c"), (1, 1, "assistant", "tie"), (1, None, None, "first"),
        (2, 5, "we\\ird\nrole<|", ""), (None, 0, "assistant", "null conversation"), (3, 0, "assistant", prose(1, 60_000)),
        (3, 1, "assistant", ""), (4, 0, "user", "Zḿ \U0001f600\r\n")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 AS ids", "2 AS position")
    turns = chat.format_turns(df)
    got = {r.conv_id: r for r in chat.read_back(turns).collect()}
    import hashlib
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    ties = sorted(("a<|im_end|>b<\\|c", "tie"), key=sha)
    assert got[1].n_turns == 4 and got[1].loss_sha256 == sha("".join(ties)) and got[1].loss_chars == sum(map(len, ties))
    assert got[1].turns_sha256 == sha("\nfirst\nuser\n\n" + "".join(f"assistant\n{t}\n" for t in ties))
    assert got[2].turns_sha256 == sha("we\\ird\nrole<|\n\n") and got[None].loss_chars == 17
    assert got[3].loss_sha256 == sha(prose(1, 60_000))
    ids = [np.frombuffer(r.ids, "<u2") for r in turns.filter("conv_id = 1").orderBy("position").collect()]
    joined = np.concatenate(ids)
    assert (joined == chat.START_ID).sum() == 4 and (joined == chat.END_ID).sum() == 4
    assert chat.read_back(chat.format_turns(df.limit(0))).collect() == []


@pytest.mark.parametrize("text", ["", "<", "<|", "<\\|", "<\\\\|im_end|>", chat.NASTY, "<<||", "a<|im_start|>\n"])
def test_escapes_come_back(text):
    assert chat.unescape(chat.escape(text)) == text and "<|" not in chat.escape(text)
    assert chat.unescape_role(chat.escape_role(text)) == text and "\n" not in chat.escape_role(text)


def test_toxicity(odd, none, spark):
    labels = spark.createDataFrame([(5, 1), (5, None), (6, 0), (None, 1), (99, 1), (8, 0), (8, 0)], "doc_id long, toxic int")
    model = toxicity.fit(odd.select("doc_id", "text"), labels)
    rows = toxicity.score(odd, model).collect()
    assert len(rows) == 13 and {r.score for r in rows if r.doc_id in (1, 2, 3, 4)} == {0.0}
    assert toxicity.score(none, model).collect() == [] and toxicity.reject_toxic(none, model).collect() == []
    empty = toxicity.fit(none.select("doc_id", "text"), labels.limit(0))
    assert toxicity.reject_toxic(odd, empty).count() == 13 and toxicity.reject_toxic(odd, empty).columns == odd.columns


def test_toxicity_folds_disguises_and_honours_exceptions():
    model = {"words": {"idiot": 5.0, "stupid": 4.0}, "stems": {"pathet": 3.0}, "exceptions": ("idiot proof",), "cut": 0.01}
    m = toxicity.Matcher(model)
    for text in ("you IDIOT!", "you 1d10t", "you іdіоt", "y0u $tupid", "st­upid", "ＩＤＩＯＴ", "pathetically", "1d!ot"):
        assert m.density(text) > 0, text
    for text in ("idiotic", "an idiot proof lid", "sympathetic", "stupidity", None, ""):
        assert m.density(text) == 0, text
    assert m.density("idiot") > m.density("idiot " + "word " * 50) > 0


def test_tokens(odd, none, spark, tmp_path):
    tokens.write_tokens(odd, f"{tmp_path}/t", chunk_ids=500)
    back = tokens.read_tokens(spark, f"{tmp_path}/t").collect()
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(tokens.vocabulary())
    want = sorted((r.doc_id is not None, r.doc_id or 0, [*library.encode(r.text or "", add_special_tokens=False).ids, 1]) for r in odd.collect())
    assert [(r.doc_id is not None, r.doc_id or 0, r.ids) for r in sorted(back, key=lambda r: r.start)] == want
    assert all(a.start + a.n_tokens == b.start for a, b in zip(*(lambda s: (s, s[1:]))(sorted(back, key=lambda r: r.start))))
    tokens.write_tokens(none, f"{tmp_path}/e")
    assert tokens.digest(tokens.read_tokens(spark, f"{tmp_path}/e")).collect() == []


@pytest.mark.parametrize("text", [
    "it's I'm we'll", "a\u0085b c\x1cd", "x <|endoftext|> y", "x<|startoftext|>y", "é ́ Å", "ΑΣ ΣΑΣ İ ẞ",
    "12345 1,000.50%", "\t\v\f\r\n", "数据工程 한국어", "a" * 5000, "\U0001f600‍\U0001f600"])
def test_pieces_encode_as_the_whole(text):
    from tokenizers import Tokenizer

    encoder = tokens.WordEncoder(tokens.vocabulary())
    assert encoder.encode([text.encode()])[0].tolist() == Tokenizer.from_file(tokens.vocabulary()).encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("n", [0, 1, 127, 128, 129, 5000])
@pytest.mark.parametrize("top", [1, 2, 300, 50_000, 2**32 - 1])
def test_simple8b_round_trip(n, top):
    ids = np.random.default_rng(n).integers(0, min(top, 10**6), n).astype(np.uint32)
    if n:
        ids[-1] = min(top, 2_000_000)
    c = tokens.encode_chunk(ids)
    words, dictionary = np.frombuffer(c["words"], "<u8"), np.frombuffer(c["dictionary"], "<u4")
    assert (tokens.unpack(words, dictionary) == ids).all()
    offsets = np.frombuffer(c["block_offsets"], "<u4").tolist() + [len(words)]
    blocks = [tokens.unpack(words[a:b], dictionary) for a, b in zip(offsets, offsets[1:])]
    assert all((b == ids[i * tokens.BLOCK:(i + 1) * tokens.BLOCK]).all() for i, b in enumerate(blocks))


def test_lm_score(odd, none):
    words, network = lmscore.fit(odd, epochs=3)
    rows = lmscore.score(odd, words, network).collect()
    assert len(rows) == 13 and all(r.log_prob == 0 and r.mean_log_prob is None for r in rows if r.doc_id in (1, 2, 3, 4))
    assert all(r.log_prob < 0 for r in rows if r.n_tokens)
    words, network = lmscore.fit(none, epochs=3)
    assert words == [] and lmscore.score(none, words, network).collect() == []


@pytest.mark.parametrize("per_range", [3, 20_000])
def test_fingerprint(odd, none, per_range):
    rows = fingerprint.fingerprint_edits(odd, fingerprint.fit_lexicon(odd), per_range).collect()
    assert len(rows) == 13
    by_id = {r.doc_id: r for r in rows}
    assert by_id[5].fingerprint == by_id[6].fingerprint and by_id[6].near_next == 1.0
    assert by_id[1].n_chars == 0 and by_id[9].n_chars == 300_000
    assert fingerprint.fingerprint_edits(none, fingerprint.fit_lexicon(none)).collect() == []
    one = fingerprint.fingerprint_edits(odd.filter("doc_id = 10"), fingerprint.fit_lexicon(odd)).first()
    assert one.near_next == 1.0


def test_fingerprint_ranges_change_nothing(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    used = fingerprint.fit_lexicon(docs)
    assert (fingerprint.fingerprint_edits(docs, used, 7).orderBy("doc_id").collect()
            == fingerprint.fingerprint_edits(docs, used).orderBy("doc_id").collect())
