"""License scan: phrases, and an exact set-similarity join of text blocks with license notices.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text lower-cased in A-Z.

Phrases: every place where a phrase's words stand consecutively.

Join. A block is a run of lines that ends at a blank line or at a line ending in
``.``, ``!`` or ``?`` (so a wrapped notice is one block); a block and a template
are sets of words. Every block that holds at least ``threshold`` of a template's
words is found, by prefix filtering:

* words are ordered by their frequency over the blocks of all documents, rarest
  first (only words of templates can count, so only they are counted);
* prefix: a block with the needed overlap o shares one of the template's first
  |T| - o + 1 words within its own first |B| - o + 1;
* length: |B| >= o;
* positional: the words after the shared one, on the shorter side, still allow o;
* candidates that pass are verified on the whole sets.

All of it is DataFrame expressions; no Python runs on the executors.

Scale. One pass tokenises the texts and writes, per document, its counts and its
blocks' template words (a few bytes a block); the join reads that. The templates
are a fixed list, so their side (prefix words) and the word order (one number for
each template word) are bounded by it, whatever the corpus. Candidates are joined
on rare words only, and an exploded block stays in its partition.

Defined cases: a null text is empty; empty templates are refused; repeated rows
give one row each; other columns are not read.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.tables import row_key, stage

#: phrase, label
PHRASES = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)

#: label, notice: short forms and the openings of the usual notices
TEMPLATES = (
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("apache", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except "
               "in compliance with the License. You may obtain a copy of the License at"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted "
            "provided that the following conditions are met"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
            "General Public License as published by the Free Software Foundation"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee "
            "is hereby granted, provided that the above copyright notice and this permission notice appear in all "
            "copies"),
    ("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU "
             "Lesser General Public License as published by the Free Software Foundation"),
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files (the \"Software\"), to deal in the Software without restriction"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
)

THRESHOLD = 0.9

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
LINE_END = r"([.!?])[ \t\r]*\n"
BLANK = r"\n[ \t\r\x0B\x0C]*\n"


@dataclass(frozen=True)
class Template:
    label: str
    words: frozenset
    need: int


def templates(notices=TEMPLATES, threshold: float = THRESHOLD) -> list[Template]:
    out = []
    for label, text in notices:
        words = frozenset(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.lower()))
        if not words:
            raise ValueError(f"a template of {label} has no words")
        out.append(Template(label, words, max(1, math.ceil(threshold * len(words) - 1e-9))))
    return out


def _spaces(x: Column) -> Column:
    return F.length(x) - F.length(F.replace(x, F.lit(" "), F.lit("")))


def _phrase_columns(spaced: Column, n_words: Column, phrases) -> list[Column]:
    """Counts and starts from the spaced text, in which every word has a space on either side."""
    count, first, last, labels = [], [], [], []
    for phrase, label in phrases:
        k = len(phrase.split(" "))
        wide = " " + phrase.replace(" ", "  ") + " "
        there = F.contains(spaced, F.lit(wide))
        left = F.length(F.replace(spaced, F.lit(wide), F.lit("")))
        count.append(F.when(there, ((F.length(spaced) - left) / len(wide)).cast("long")).otherwise(0))
        first.append(F.when(there, (_spaces(F.substring_index(spaced, wide, 1)) / 2).cast("long")))
        last.append(F.when(there, n_words - (_spaces(F.substring_index(spaced, wide, -1)) / 2).cast("long") - k))
        labels.append(F.when(there, F.lit(label)))
    none = F.lit(None).cast("long")
    return [sum(count[1:], count[0]).cast("long").alias("n_base"),
            F.least(*first, none, none).alias("first_word"),
            F.greatest(*last, none, none).alias("last_word"),
            F.array_sort(F.array_distinct(F.array_compact(F.array(*labels)))).alias("base_labels")]


def _tokenised(docs: DataFrame, phrases, vocabulary: list[str]) -> DataFrame:
    low = F.translate(F.coalesce(F.col("text"), F.lit("")), UPPER, LOWER)
    words = F.trim(F.regexp_replace(F.col("low"), BREAKS, "  "))
    spaced = F.when(F.col("words") == "", F.lit("")).otherwise(F.concat(F.lit(" "), F.col("words"), F.lit(" ")))
    blocks = F.transform(F.split(F.regexp_replace(F.col("low"), LINE_END, "$1\n\n"), BLANK),
                         lambda b: F.array_intersect(F.split(b, BREAKS), F.lit(vocabulary)))
    return (docs.select(row_key().alias("rid"), "doc_id", low.alias("low"))
            .select("rid", "doc_id", "low", words.alias("words"))
            .select("rid", "doc_id", "low", spaced.alias("spaced"))
            .select("rid", "doc_id", "low", "spaced", (_spaces(F.col("spaced")) / 2).cast("long").alias("n_words"))
            .select("rid", "doc_id", "n_words", *_phrase_columns(F.col("spaced"), F.col("n_words"), phrases),
                    blocks.alias("blocks")))


def _joined(tokens: DataFrame, notices: list[Template], vocabulary: list[str]) -> DataFrame:
    """(rid, block, template, overlap) of every block that meets a template's need."""
    spark = tokens.sparkSession
    blocks = (tokens.select("rid", F.posexplode("blocks").alias("block", "words")))
    counts = {r.word: r.n for r in blocks.select(F.explode("words").alias("word")).groupBy("word")
              .agg(F.count("*").alias("n")).collect()}  # at most one row for each template word
    rank = {w: i for i, w in enumerate(sorted(vocabulary, key=lambda w: (counts.get(w, 0), w)))}
    least = min(t.need for t in notices)
    prefix, whole = [], []
    for i, t in enumerate(notices):
        own = sorted(rank[w] for w in t.words)
        whole.append((i, own, t.need))
        prefix += [(i, r, p, len(own), t.need) for p, r in enumerate(own[:len(own) - t.need + 1])]
    left = F.broadcast(spark.createDataFrame(prefix, "template int, rank int, at int, size int, need int"))
    right = F.broadcast(spark.createDataFrame(whole, "template int, own array<int>, need int"))
    ranks = F.create_map(*(F.lit(x) for p in rank.items() for x in p))
    ordered = (blocks.filter(F.size("words") >= least)
               .withColumn("ranks", F.array_sort(F.transform("words", lambda w: ranks[w]))))
    heads = ordered.select("rid", "block", "ranks", F.posexplode(
        F.slice("ranks", 1, F.size("ranks") - least + 1)).alias("place", "rank"))
    rest = F.least(F.col("size") - F.col("at"), F.size("ranks") - F.col("place"))  # the shared word included
    candidates = (heads.join(left, "rank")
                  .filter((F.size("ranks") >= F.col("need")) & (F.col("place") <= F.size("ranks") - F.col("need"))
                          & (rest >= F.col("need")))
                  .groupBy("rid", "block", "template").agg(F.first("ranks").alias("ranks")))
    return (candidates.join(right, "template")
            .select("rid", "block", "template", F.size(F.array_intersect("ranks", "own")).alias("overlap"), "need",
                    F.size("own").alias("size"))
            .filter("overlap >= need"))


def scan(docs: DataFrame, notices=TEMPLATES, threshold: float = THRESHOLD, phrases=PHRASES) -> DataFrame:
    """One row per document row: n_words, n_base, first_word, last_word, base_labels, labels, matches, score.

    ``matches``: array of (block, label, containment), every block that meets a
    template's threshold. ``score``: 1 where a phrase stands, else the best
    containment found, else 0.
    """
    known = templates(notices, threshold)
    vocabulary = sorted(set().union(*(t.words for t in known)))
    tokens = stage(_tokenised(docs, phrases, vocabulary), "license-words")
    spark = docs.sparkSession
    labels = F.broadcast(spark.createDataFrame([(i, t.label) for i, t in enumerate(known)],
                                               "template int, label string"))
    found = (_joined(tokens.dropDuplicates(["rid"]), known, vocabulary).join(labels, "template")
             .groupBy("rid").agg(F.array_sort(F.collect_list(F.struct(
                 "block", "label", (F.col("overlap") / F.col("size")).alias("containment")))).alias("matches")))
    joined = tokens.drop("blocks").join(found, "rid", "left")
    own = F.coalesce(F.transform("matches", lambda m: m["label"]), F.array().cast("array<string>"))
    best = F.array_max(F.transform("matches", lambda m: m["containment"]))
    return joined.select("rid", "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels",
                         F.array_sort(F.array_union("base_labels", own)).alias("labels"), "matches",
                         F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce(best, F.lit(0.0))).alias("score"))


def oracle_sql(notices=TEMPLATES, threshold: float = THRESHOLD, phrases=PHRASES) -> str:
    """The query's rows in DuckDB: phrases word by word, every block against every template."""
    known = templates(notices, threshold)

    def quoted(words) -> str:
        return "[" + ", ".join(f"'{w}'" for w in words) + "]"

    def starts(phrase: str) -> str:
        words = phrase.split(" ")
        same = " AND ".join(f"w[i+{j + 1}] = '{x}'" for j, x in enumerate(words))
        return f"[i FOR i IN range(len(w)) IF {same}]"

    places = ", ".join(f"{starts(p)} AS p{i}" for i, (p, _) in enumerate(phrases))
    every = "list_concat(" + ", list_concat(".join(f"p{i}" for i in range(len(phrases) - 1)) \
        + f", p{len(phrases) - 1}" + ")" * (len(phrases) - 1)
    base = ", ".join(f"CASE WHEN len(p{i}) > 0 THEN '{label}' END" for i, (_, label) in enumerate(phrases))
    rows = ", ".join(f"('{t.label}', {quoted(sorted(t.words))}, {t.need})" for t in known)
    word = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    return f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS low
  FROM documents),
w AS (SELECT r, doc_id, low, regexp_extract_all(low, '{word}') AS w FROM d),
p AS (SELECT *, {places} FROM w),
b AS (SELECT r, doc_id, len(w) AS n_words, {every} AS spots,
        list_distinct([x FOR x IN [{base}] IF x IS NOT NULL]) AS base FROM p),
k AS (SELECT r, unnest(regexp_split_to_array(regexp_replace(low, '([.!?])[ \\t\\r]*\\n', '\\1' || chr(10) || chr(10), 'g'),
        '\\n[ \\t\\r\\x0B\\x0C]*\\n')) AS block FROM d),
s AS (SELECT r, list_distinct(regexp_extract_all(block, '{word}')) AS have FROM k),
t(label, words, need) AS (VALUES {rows}),
m AS (SELECT r, label, len(list_intersect(have, words)) / len(words) AS c FROM s, t
      WHERE len(list_intersect(have, words)) >= need),
g AS (SELECT r, list(DISTINCT label) AS own, max(c) AS best FROM m GROUP BY r)
SELECT doc_id, n_words::BIGINT AS n_words, len(spots)::BIGINT AS n_base,
  list_min(spots)::BIGINT AS first_word, list_max(spots)::BIGINT AS last_word,
  array_to_string(list_sort(base), ',') AS base_labels,
  array_to_string(list_sort(list_distinct(list_concat(base, coalesce(own, [])))), ',') AS labels,
  CASE WHEN len(spots) > 0 THEN 1.0 ELSE coalesce(best, 0.0) END::DOUBLE AS score
FROM b LEFT JOIN g USING (r)"""
