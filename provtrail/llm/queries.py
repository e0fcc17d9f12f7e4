"""Registered queries of the corpus operators, over whole tables, and their SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from provtrail.llm import (
    chat, collocations, decontaminate, fingerprint, jaccard, langid, license, lmscore, merkle, mixing, packing, tokens,
    toxicity)
from provtrail.llm.common import fold
from provtrail.session import work_dir
from provtrail.sources.tables import table


def op1_license(spark, sf_dir):
    return license.scan_licenses(table(spark, sf_dir, "documents")).drop("places")


def op2_decontaminate(spark, sf_dir):
    return decontaminate.find_hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("spans")


def op3_mix_sources(spark, sf_dir):
    return mixing.mix(table(spark, sf_dir, "documents"))


def op4_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(fold(F.col("doc_id"), 4) == 2, F.lit(False))
    model = langid.fit(docs.filter(~held_out).select("doc_id", "text", "lang"))
    return langid.predict(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op5_jaccard_join(spark, sf_dir):
    return jaccard.jaccard_components(table(spark, sf_dir, "documents"))


def op6_chat_format(spark, sf_dir):
    return chat.read_back(chat.format_turns(chat.with_nasty(spark, table(spark, sf_dir, "conversations"))))


def op7_toxicity(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = F.coalesce(fold(F.col("doc_id"), 5) == 0, F.lit(False))
    model = toxicity.fit(docs.select("doc_id", "text"), labels.filter(~held_out).select("doc_id", "toxic"))
    return toxicity.score(docs, model).select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op8_token_output(spark, sf_dir):
    path = f"{work_dir(spark)}/provtrail/tokens-{uuid.uuid4().hex}"
    tokens.write_tokens(table(spark, sf_dir, "documents"), path)
    return tokens.read_digests(spark, path)


def op9_lm_score(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    counts = lmscore.word_counts(docs)
    words, network = lmscore.fit(docs, counts=counts)
    return lmscore.score(docs, words, network, within=lmscore.fit_within(counts, words))


def op10_fingerprint(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return fingerprint.fingerprint_edits(docs, fingerprint.fit_lexicon(docs))


def op11_merkle_manifest(spark, sf_dir):
    return merkle.verify_tampered(table(spark, sf_dir, "documents"))


def op12_best_fit_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"))


def op13_collocations(spark, sf_dir):
    return collocations.collocations(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_license, op2_decontaminate, op3_mix_sources, op4_language_id, op5_jaccard_join, op6_chat_format,
    op7_toxicity, op8_token_output, op9_lm_score, op10_fingerprint, op11_merkle_manifest,
    op12_best_fit_packing, op13_collocations)}

ORACLE_SQL = {
    "op1_license": license.oracle(), "op2_decontaminate": decontaminate.oracle(), "op3_mix_sources": mixing.oracle(),
    "op5_jaccard_join": jaccard.oracle(), "op6_chat_format": chat.oracle(),
    "op11_merkle_manifest": merkle.oracle(), "op13_collocations": collocations.oracle()}
