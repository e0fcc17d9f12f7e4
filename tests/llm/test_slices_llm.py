"""What bounds the memory of a worker that encodes texts."""

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from provtrail.llm import tokens


def test_slices_are_bounded_by_text_and_lose_no_row():
    texts = ["a " * 300_000] * 5 + [None, ""] + ["b"] * 2500 + ["c " * 2_000_000]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], names=["doc_id", "text"])
    parts = list(tokens._text_slices(batch))
    assert pa.Table.from_batches(parts).column(0).to_pylist() == list(range(len(texts)))
    for part in parts:
        size = sum(len(t or "") for t in part.column(1).to_pylist())
        assert part.num_rows <= 1000 and (size <= tokens.SLICE_BYTES or part.num_rows == 1)


def test_digests_are_read_by_one_python_worker_a_task(spark, tmp_path):
    docs = spark.range(300).select(F.col("id").alias("doc_id"), F.concat_ws(" ", F.lit("Some words,"), "id").alias("text"))
    tokens.write_tokens(docs, f"{tmp_path}/t", chunk_ids=200)
    found = tokens.read_digests(spark, f"{tmp_path}/t")
    # Each Python node of a stage has a worker of its own, with its own memory.
    assert found._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    assert sorted(found.collect()) == sorted(tokens.digest(tokens.read_tokens(spark, f"{tmp_path}/t")).collect())


def test_remembered_pieces_are_bounded_and_all_ids_right():
    encoder, fresh = tokens.WordEncoder(tokens.vocabulary(), remembered=50), tokens.WordEncoder(tokens.vocabulary())
    words = ["".join(w) for w in itertools.product("abc\u00e9", repeat=4)]
    words = np.random.default_rng(1).choice(words, 4000).tolist()
    got = [encoder.encode([" ".join(words[i:i + 40]).encode()])[0] for i in range(0, 4000, 40)]
    assert max(len(p) for p in (encoder.pieces, encoder.pieces.old, encoder.pieces.once)) <= 50
    assert np.concatenate(got).tolist() == [i for w in words for i in fresh.encode([w.encode()])[0].tolist()]


def test_marks_behind_words_are_cut_where_the_library_cuts():
    parts = ["Word", "it's", "5", "\u00e9t\u00e9", "e\u0301", ",", ".", "...", "'", "')", ";", "?!", "\n", "\t", " ", "\u2026", "\u00a0", "<|endoftext|>"]
    texts = ["".join(t) for t in itertools.product(parts, repeat=4)][::5] + [
        "".join(np.random.default_rng(i).choice(parts[:-1], 30)) for i in range(300)]
    encoder = tokens.WordEncoder(tokens.vocabulary())
    want = encoder.tokenizer.encode_batch(texts, add_special_tokens=False)
    for text, got, e in zip(texts, encoder.encode([t.encode() for t in texts]), want):
        assert got.tolist() == e.ids, text
