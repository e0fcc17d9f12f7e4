"""License scans by a positional rare-token index, in DataFrame functions only.

A template is a passage of a license text or notice with mandatory key phrases in it. The index has
postings of the template words that are rarest in the corpus: word, template, offset. The highest-idf
one of each template is looked up among a file's words, which tells where the template would start;
the postings of its other rare words must agree with that place, and the key phrases are then verified
word by word at their places. Every occurrence is examined, so all places are found.

Index and templates are one literal each, so the plan is the same for any number of templates.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BASE = (("mit", "under the mit license"), ("apache-2", "apache license version 2"), ("cc-by-nc", "cc by nc"))
# Passages of license texts and notices as plain words, a label each; key phrases are in
# brackets. A passage begins with a key phrase.
PASSAGES = (
    ("mit", "[permission is hereby granted free of charge to any person obtaining a copy] of this software and associated "
            "documentation files the software [to deal in the software without restriction] including without limitation"),
    ("mit", "[the above copyright notice and this permission notice shall be included] in all copies or substantial portions"),
    ("apache-2", "[you may not use this file except in compliance with the license] you may obtain a copy of the license at"),
    ("apache-2", "[unless required by applicable law or agreed to in writing software] distributed under the license is "
                 "distributed on an as is basis [without warranties or conditions of any kind]"),
    ("cc-by-nc", "[creative commons attribution noncommercial]"),
    ("agpl-3", "[gnu affero general public license]"),
    ("gpl", "[this program is free software you can redistribute it] and or modify it under the terms of the "
            "[gnu general public license as published by the free software foundation]"),
    ("gpl-2", "[gnu general public license version 2]"),
    ("gpl-3", "[gnu general public license version 3]"),
    ("lgpl", "[gnu lesser general public license]"),
    ("bsd", "[redistribution and use in source and binary forms] with or without modification "
            "[are permitted provided that the following conditions are met]"),
    ("bsd", "[redistributions of source code must retain the above copyright notice] this list of conditions and the following disclaimer"),
    ("bsd-3", "[neither the name of the copyright holder nor the names of its contributors] may be used to endorse or promote"),
    ("cc-by", "[creative commons attribution 4 0 international]"),
    ("cc-by-sa", "[cc by sa]"),
    ("cc-by-sa", "[creative commons attribution sharealike]"),
    ("cc0", "[cc0 1 0 universal]"),
    ("isc", "[permission to use copy modify and or distribute this software] for any purpose with or without fee is hereby granted"),
    ("mpl-2", "[mozilla public license version 2]"),
    ("mpl-2", "[this source code form is subject to the terms of the mozilla public license]"),
    ("reserved", "[all rights reserved]"),
    ("unlicense", "[free and unencumbered software released into the public domain]"),
    ("zlib", "[this software is provided as is without any express or implied warranty]"),
)
#: Rare words of a template that have postings, at most.
RARE = 4


def template(label: str, passage: str, base: bool = False) -> dict:
    """A passage with key phrases in brackets (without any, all of it is one) as words and phrases with offsets."""
    if "[" not in passage:
        passage = f"[{passage}]"
    words, phrases = [], []
    for part in passage.replace("[", "\0[").replace("]", "\0").split("\0"):
        own = part.lstrip("[").split()
        if part.startswith("["):
            phrases.append({"o": len(words), "w": own})
        words += own
    if not phrases or phrases[0]["o"]:
        raise ValueError(f"no key phrase at the beginning: {passage}")
    return {"label": label, "base": base, "words": words, "phrases": phrases}


TEMPLATES = tuple(template(x, p, True) for x, p in BASE) + tuple(template(x, p) for x, p in PASSAGES)
_KIND = """array<struct<label: string, base: boolean, words: array<string>, phrases: array<struct<o: int, w: array<string>>>,
    rare: array<struct<o: int, w: string>>>>"""


def words_of(text: Column) -> Column:
    """Words of a text as an array; null and empty texts give none."""
    low = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.filter(F.split(low, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), lambda w: w != "")


def with_rare_words(docs: DataFrame, templates: Sequence[dict] = TEMPLATES, text_col: str = "text") -> list[dict]:
    """Templates with ``rare``: offsets and words of the key-phrase words that the fewest documents of the
    whole corpus have, the rarest first. Only one count for each such word reaches the driver."""
    vocabulary = sorted({w for t in templates for p in t["phrases"] for w in p["w"]})
    present = F.array_distinct(F.filter("words", lambda w: w.isin(vocabulary)))
    counts = docs.select(words_of(F.col(text_col)).alias("words")).select(F.explode(present).alias("w")).groupBy("w").count()
    df = {r["w"]: r["count"] for r in counts.collect()}
    out = []
    for t in templates:
        places = [(df.get(w, 0), p["o"] + i, w) for p in t["phrases"] for i, w in enumerate(p["w"])]
        out.append(t | {"rare": [{"o": o, "w": w} for _, o, w in sorted(places)[:RARE]]})
    return out


def scan_licenses(docs: DataFrame, templates: Sequence[dict] = TEMPLATES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document row: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, places.

    Base templates are counted by n_base; first_word and last_word are their smallest and largest start
    (null without one). ``places`` lists (label, start, share, base) of every template found: all its key
    phrases stand at their places, and ``share`` is the part of all its words that do. ``labels`` are
    those of all templates found, ``score`` the largest share. Null and empty texts have no words, no
    label and score 0. Repeated rows are answered each.
    """
    held = with_rare_words(docs, templates, text_col)
    anchors: dict[str, list] = {}
    for i, t in enumerate(held):
        anchors.setdefault(t["rare"][0]["w"], []).append({"t": i, "o": t["rare"][0]["o"]})
    table = F.from_json(F.lit(json.dumps(held)), _KIND)
    index = F.from_json(F.lit(json.dumps(anchors)), "map<string, array<struct<t: int, o: int>>>")
    rows = docs.select(F.col(id_col).alias("doc_id"), words_of(F.col(text_col)).alias("words"))
    rows = rows.withColumn("hits", F.filter(
        F.transform("words", lambda w, i: F.when(w.isin(sorted(anchors)), i).otherwise(-1)), lambda i: i >= 0))
    starts = F.flatten(F.transform("hits", lambda i: F.transform(index[F.get("words", i)], lambda a: F.struct(
        a["t"].alias("t"), (i - a["o"]).alias("start")))))

    def word_at(place: Column) -> Column:
        return F.get("words", place)

    def stands(s: Column) -> Column:
        own = F.get(table, s["t"])
        rare = F.forall(own["rare"], lambda r: F.coalesce(word_at(s["start"] + r["o"]) == r["w"], F.lit(False)))
        return (s["start"] >= 0) & rare & F.forall(
            own["phrases"], lambda p: F.slice("words", s["start"] + p["o"] + 1, F.size(p["w"])) == p["w"])

    def described(s: Column) -> Column:
        own = F.get(table, s["t"])
        same = F.size(F.filter(own["words"], lambda w, k: F.coalesce(word_at(s["start"] + k) == w, F.lit(False))))
        return F.struct(own["label"].alias("label"), s["start"].alias("start"),
                        (same / F.size(own["words"])).alias("share"), own["base"].alias("base"))

    rows = rows.withColumn("places", F.when(F.size("hits") > 0, F.transform(F.filter(starts, stands), described)).otherwise(
        F.expr("cast(array() as array<struct<label:string,start:int,share:double,base:boolean>>)")))
    base = F.transform(F.filter("places", lambda p: p["base"]), lambda p: p["start"])

    def joined(places: Column) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(F.transform(places, lambda p: p["label"]))), ",")

    return rows.select(
        "doc_id", F.size("words").cast("long").alias("n_words"), F.size(base).cast("long").alias("n_base"),
        F.array_min(base).cast("long").alias("first_word"), F.array_max(base).cast("long").alias("last_word"),
        joined(F.filter("places", lambda p: p["base"])).alias("base_labels"), joined(F.col("places")).alias("labels"),
        F.coalesce(F.array_max(F.transform("places", lambda p: p["share"])), F.lit(0.0)).alias("score"), "places")


def oracle(templates: Sequence[dict] = TEMPLATES) -> str:
    """DuckDB SQL for the rows of ``scan_licenses`` without ``places``, from plain phrase search: every place
    of a template's first word is tried."""
    def listed(words: list[str]) -> str:
        return "[" + ", ".join(f"'{w}'" for w in words) + "]"

    def phrases(t: dict) -> str:
        return "[" + ", ".join(f"{{'o': {p['o']}, 'w': {listed(p['w'])}}}" for p in t["phrases"]) + "]"

    rows = ", ".join(f"('{t['label']}', {str(t['base']).lower()}, {listed(t['words'])}, {phrases(t)})" for t in templates)
    return f"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS id, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
  '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
tpl AS (SELECT * FROM (VALUES {rows}) v(label, base, words, phrases)),
tried AS (SELECT id, i, label, base, words, phrases
  FROM (SELECT id, unnest(w) AS x, unnest(range(0, len(w))) AS i FROM d) o JOIN tpl ON o.x = tpl.words[1]),
found AS (SELECT id, i, label, base, len(list_filter(range(1, len(words) + 1), lambda j: w[i + j] = words[j])) / len(words) AS share
  FROM tried JOIN d USING (id)
  WHERE len(list_filter(phrases, lambda p: w[i + p.o + 1:i + p.o + len(p.w)] = p.w)) = len(phrases))
SELECT d.doc_id, CAST(len(any_value(w)) AS BIGINT) AS n_words, count(i) FILTER (WHERE base) AS n_base,
  min(i) FILTER (WHERE base) AS first_word, max(i) FILTER (WHERE base) AS last_word,
  coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE base), '') AS base_labels,
  coalesce(string_agg(DISTINCT label, ',' ORDER BY label), '') AS labels, coalesce(max(share), 0) AS score
FROM d LEFT JOIN found USING (id) GROUP BY id, d.doc_id"""
