"""License scans as an exact set-similarity join of text blocks with license notices.

A block is a line with words and, since notices are wrapped over lines, as many words after it as the longest notice has, less
one. So a notice lies in the block of the line in which it begins, wherever it is broken and with comment marks or empty
lines in between. A block matches a notice if it holds at least `share` of the notice's distinct words. Words are ordered by their frequency in the documents, rarest first. By that order a block that matches must share one of the first words of the
notice (prefix filter), have enough words of the notices at all (length filter), and have enough of them left from the first
shared word on (positional filter). What passes is counted exactly. Texts are read once; the frequencies and the join work on
the notices' words found in them.

Words are runs of a-z, 0-9 and characters beyond ASCII, with A-Z in lower case. Beside the notices, fixed phrases give base
labels wherever their words stand side by side, across lines too.

Defined results: a null text is empty (no words, no labels, score 0); repeated rows are scanned alike, one row each; a null
id stays null; a notice that occurs twice is one label; labels are sorted; an empty table gives an empty result. Other
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkmill.llm.common import saved, whole_text

#: Opening sentences of public license notices, with their labels.
NOTICES = (
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "This program is free software: you can redistribute it under the terms of the GNU General Public License"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License"),
    ("isc", "Permission to use, copy, modify, and distribute this software for any purpose with or without fee"),
    ("cc", "Licensed under CC BY 4.0"),
    ("cc", "Licensed under a Creative Commons Attribution 4.0 International License"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
)
#: Phrases and their base labels.
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))
SHARE = 0.9

_WORD = r"[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _sequence(notice: str) -> list[str]:
    return "".join(c if c.isalnum() else " " for c in notice.lower()).split()


def _words(notice: str) -> list[str]:
    return sorted(set(_sequence(notice)))


def _following(notices) -> int:
    """Words after a line that its block takes in: a notice that begins in the line has no more of them left."""
    return max(len(_sequence(n)) for _, n in notices) - 1


def _array(words: list[str]) -> str:
    return "array(" + ", ".join(f"'{w}'" for w in words) + ")"


def _need(n: int, share: float) -> int:
    """Words of a notice of n that a block must hold: the ceiling of share * n, free of rounding."""
    return next(k for k in range(1, n + 1) if k >= share * n - 1e-9)


def scanned(docs: DataFrame, notices=NOTICES, phrases=PHRASES, share: float = SHARE) -> DataFrame:
    """Per document: doc_id, n_words, base (label and starts of each phrase), present (notice words in it), and blocks."""
    vocabulary = sorted({w for _, n in notices for w in _words(n)} | {w for p, _ in phrases for w in p.split()})
    least = min(_need(len(_words(n)), share) for _, n in notices)
    low = f"CASE WHEN octet_length(t) = length(t) THEN lower(t) ELSE translate(t, '{_UPPER}', '{_UPPER.lower()}') END"
    words = f"transform(split({low}, '\\n', -1), l -> regexp_extract_all(l, '{_WORD}', 0))"
    lines = docs.select("doc_id", whole_text().alias("t")).selectExpr("doc_id", f"filter({words}, l -> size(l) > 0) AS lines")
    after = _following(notices)
    flat = lines.selectExpr(
        "doc_id", "lines", "flatten(lines) AS w", f"transform(lines, l -> slice(l, 1, {after})) AS heads"
    ).selectExpr("*", f"array_intersect(w, {_array(vocabulary)}) AS present")
    bases = []
    for phrase, label in phrases:
        words = phrase.split()
        last = len(words) - 1
        before = "".join(f" AND get(w, i - {last - k}) = '{x}'" for k, x in enumerate(words[:-1]))
        ends = f"filter(sequence(0, size(w) - 1), i -> get(w, i) = '{words[-1]}'{before})"
        here = " AND ".join(f"array_contains(present, '{x}')" for x in words)
        starts = f"CASE WHEN {here} THEN transform({ends}, i -> i - {last}) ELSE array() END"
        bases.append(f"struct('{label}' AS label, {starts} AS starts)")
    # Each following line has a word, so that many lines have that many words.
    block = f"concat(l, slice(flatten(slice(heads, i + 2, {after})), 1, {after}))"
    worth = f"CASE WHEN size(present) >= {least} THEN lines ELSE cast(array() AS array<array<string>>) END"
    blocks = f"""filter(transform({worth}, (l, i) -> struct(i AS line, array_intersect({block}, {_array(vocabulary)}) AS words)),
        b -> size(b.words) >= {least})"""
    return flat.selectExpr(
        "doc_id", "cast(size(w) AS bigint) AS n_words", f"filter(array({', '.join(bases)}), b -> size(b.starts) > 0) AS base",
        "present", f"{blocks} AS blocks", "monotonically_increasing_id() AS id",
    )


def matches(scan: DataFrame, notices=NOTICES, share: float = SHARE) -> DataFrame:
    """id, line, label and containment of every block that meets the share of a notice."""
    spark = scan.sparkSession
    counts = scan.select(F.explode("present").alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    # No more rows than the notices have words.
    frequency = {r.word: r.n for r in counts.collect()}
    rank = lambda w: (frequency.get(w, 0), w)
    ordered = sorted({w for _, n in notices for w in _words(n)}, key=rank)
    prefixes, least = [], []
    for label, notice in notices:
        words = sorted(_words(notice), key=rank)
        need = _need(len(words), share)
        least.append(need)
        for at, word in enumerate(words[: len(words) - need + 1]):
            prefixes.append(
                f"struct('{word}' AS word, '{label}' AS label, {at} AS n_at, {need} AS need, {_array(words)} AS notice)"
            )
    index = spark.range(1).selectExpr(f"inline(array({', '.join(prefixes)}))")
    # Intersecting with the ordered vocabulary puts a block's words in the global order.
    blocks = scan.selectExpr("id", "inline(blocks)").selectExpr("id", "line", f"array_intersect({_array(ordered)}, words) AS words")
    starts = blocks.selectExpr(
        "id", "line", "words", f"posexplode(slice(words, 1, greatest(0, size(words) - {min(least)} + 1))) AS (b_at, word)"
    )
    pairs = starts.join(index, "word").filter(
        "b_at <= size(words) - need AND 1 + least(size(notice) - n_at - 1, size(words) - b_at - 1) >= need"
    )
    counted = pairs.withColumn("held", F.expr("size(array_intersect(notice, words))")).filter("held >= need")
    return counted.selectExpr("id", "line", "label", "held / size(notice) AS containment").distinct()


def labelled(docs: DataFrame, notices=NOTICES, phrases=PHRASES, share: float = SHARE) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels and score.

    The score is 1 with a base label, else the best containment of a block that meets the share, else 0.
    """
    scan = saved(scanned(docs, notices, phrases, share))
    found = matches(scan, notices, share).groupBy("id").agg(
        F.collect_set("label").alias("found"), F.max("containment").alias("best")
    )
    joined = scan.drop("present", "blocks").join(found, "id", "left")
    starts = joined.selectExpr(
        "doc_id", "n_words", "flatten(base.starts) AS starts", "base.label AS named",
        "coalesce(found, cast(array() AS array<string>)) AS found", "coalesce(best, 0D) AS best",
    )
    return starts.selectExpr(
        "doc_id", "n_words", "cast(size(starts) AS bigint) AS n_base",
        "cast(array_min(starts) AS bigint) AS first_word", "cast(array_max(starts) AS bigint) AS last_word",
        "array_join(array_sort(array_distinct(named)), ',') AS base_labels",
        "array_join(array_sort(array_distinct(concat(named, found))), ',') AS labels",
        "CASE WHEN size(named) > 0 THEN 1D ELSE cast(best AS double) END AS score",
    )


def query(spark, folder):
    return labelled(spark.read.parquet(f"{folder}/documents.parquet"))


_VALUES = ", ".join(f"('{label}', [{', '.join(repr(w) for w in _words(n))}], {_need(len(_words(n)), SHARE)})" for label, n in NOTICES)
ORACLE = rf"""
WITH d AS (
  SELECT doc_id, translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}') AS t FROM documents
), w AS (
  SELECT doc_id, t, regexp_extract_all(t, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM d
), p AS (
  SELECT doc_id, i, CASE WHEN i > 1 AND w[i - 1] = 'mit' THEN 'mit' WHEN i > 1 AND w[i - 1] = 'apache' THEN 'apache'
                         WHEN i > 2 AND w[i - 1] = 'public' AND w[i - 2] = 'general' THEN 'gpl' END AS label
  FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM w) WHERE w[i] = 'license'
), b AS (
  SELECT doc_id, label, i - CASE label WHEN 'gpl' THEN 3 ELSE 2 END AS start FROM p WHERE label IS NOT NULL
), lw AS (
  SELECT doc_id, line, len(regexp_extract_all(s, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS n
  FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS s, generate_subscripts(string_split(t, chr(10)), 1) AS line FROM d)
), li AS (
  SELECT doc_id, n, sum(n) OVER (PARTITION BY doc_id ORDER BY line) AS upto FROM lw
), l AS (
  SELECT doc_id, w[(upto - n + 1)::BIGINT:(upto + {_following(NOTICES)})::BIGINT] AS x FROM li JOIN w USING (doc_id) WHERE n > 0
), m AS (
  SELECT doc_id, label, len(list_intersect(n, x))::DOUBLE / len(n) AS c
  FROM l, (VALUES {_VALUES}) v(label, n, need) WHERE len(list_intersect(n, x)) >= need
), bs AS (
  SELECT doc_id, count(*) AS n_base, min(start) AS first_word, max(start) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM b GROUP BY 1
), ms AS (
  SELECT doc_id, max(c) AS best FROM m GROUP BY 1
), al AS (
  SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM (SELECT doc_id, label FROM b UNION ALL SELECT doc_id, label FROM m) GROUP BY 1
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(best, 0)::DOUBLE END AS score
FROM w LEFT JOIN bs USING (doc_id) LEFT JOIN ms USING (doc_id) LEFT JOIN al USING (doc_id)
"""
