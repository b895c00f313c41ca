"""License scans: exact set-similarity join of text blocks with license templates.

Tokens are ordered by how many documents hold them, rarest first. A block can
only contain a share t of a template's tokens if one of the template's first
n - ceil(t n) + 1 tokens is in it, so blocks and templates meet on those alone;
length and positional filters drop further pairs before the full sets are
compared. No block that meets the threshold is missed.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD_GAP, ascii_lower, pick, read, row_key, table

#: A phrase and its label.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: Notices as their publishers word them, and labels.
TEMPLATES = [
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("reserved", "All rights reserved"),
]


def normalised(text: Column) -> Column:
    """The words of a text between single spaces, with a space at both ends; a lone space if none."""
    plain = F.trim(F.regexp_replace(ascii_lower(F.coalesce(text, F.lit(""))), WORD_GAP, " "))
    return F.when(plain == "", " ").otherwise(F.concat(F.lit(" "), plain, F.lit(" ")))


def _spaces(c: Column) -> Column:
    return F.length(c) - F.length(F.replace(c, F.lit(" "), F.lit("")))


def phrase_starts(norm: Column, phrase: str) -> Column:
    """Word numbers at which the phrase begins; empty if nowhere."""
    n = phrase.count(" ") + 1
    parts = F.split(norm, f" {phrase}(?= )", -1)
    step = lambda acc, part: F.struct((acc["at"] + _spaces(part) + n).alias("at"), F.concat(acc["starts"], F.array((acc["at"] + _spaces(part)).cast("long"))).alias("starts"))
    begin = F.struct(F.lit(0).alias("at"), F.array().cast("array<bigint>").alias("starts"))
    starts = F.aggregate(parts, begin, step, lambda acc: acc["starts"])
    starts = F.slice(starts, 1, F.size(parts) - 1)  # what follows the last place is no place
    return F.when(F.contains(norm, F.lit(f" {phrase} ")), starts).otherwise(F.array().cast("array<bigint>"))


def template_sets(templates) -> list[tuple[int, str, list[str]]]:
    words = lambda t: sorted(set(re.findall(r"[0-9a-z]+", t.lower())))
    return [(k, label, words(t)) for k, (label, t) in enumerate(templates)]


def scan_licenses(docs: DataFrame, templates=TEMPLATES, threshold: float = 0.8, id_col: str = "doc_id", text_col: str = "text", wrapped: bool = False) -> DataFrame:
    """(doc_id, n_words, starts, base_labels, found, labels, score): one row per input row.

    starts holds the word numbers of all phrase places; found the templates that
    a block (a line) contains to the threshold, as (label, block, containment);
    with wrapped, a run of words that crosses lines is a block too, under the
    number of its first line: for a template of n words, of n / threshold words;
    score is the best containment, 1 where a phrase stands. Null, empty and
    wordless texts have no words and no labels. Equal rows get equal results; an
    empty table gives no rows. Templates are a parameter, and only what has as
    many rows as they have tokens comes to the driver or is broadcast.
    """
    docs = pick(docs, doc_id=id_col, text=text_col)
    sets = template_sets(templates)
    need = {k: math.ceil(threshold * len(words) - 1e-9) for k, _, words in sets}
    vocabulary = sorted({w for _, _, words in sets for w in words})
    rows = docs.select(*row_key(F.col("doc_id"), F.col("text")), "text", normalised(F.col("text")).alias("norm"))
    own = F.array_distinct(F.filter(F.split("norm", " "), lambda w: w.isin(vocabulary)))
    rows = rows.withColumn("tokens", own)
    # A document that lacks the tokens has no block that holds them.
    able = F.lit(False)
    for k, _, words in sets:
        able = able | (F.size(F.array_intersect("tokens", F.array(*map(F.lit, words)))) >= need[k])
    scanned = table(
        rows.select(
            "doc_id", "rk1", "rk2",
            F.when(F.col("norm") == " ", F.lit(0)).otherwise(_spaces(F.col("norm")) - 1).cast("long").alias("n_words"),
            *(phrase_starts(F.col("norm"), p).alias(f"at{k}") for k, p in enumerate(PHRASES)),
            "tokens",
            F.when(able, F.col("text")).alias("text"),
        ),
        "license-scan",
    )
    spans = [math.ceil(len(re.findall(r"[0-9a-z]+", t.lower())) / threshold - 1e-9) for _, t in templates]
    found = block_matches(scanned, sets, need, vocabulary, spans if wrapped else None)
    best = found.groupBy("doc_id", "rk1", "rk2").agg(F.array_sort(F.collect_set(F.struct("label", "block", "containment"))).alias("found"))
    best = best.select(F.col("doc_id").alias("doc_id2"), F.col("rk1").alias("rk12"), F.col("rk2").alias("rk22"), "found")
    out = scanned.join(best, scanned.doc_id.eqNullSafe(best.doc_id2) & (scanned.rk1 == best.rk12) & (scanned.rk2 == best.rk22), "left")
    starts = F.concat(*(F.col(f"at{k}") for k in range(len(PHRASES))))
    base = F.array_compact(F.array(*(F.when(F.size(f"at{k}") > 0, F.lit(label)) for k, label in enumerate(PHRASES.values()))))
    none = F.array().cast("array<struct<label:string,block:int,containment:double>>")
    out = out.withColumn("found", F.coalesce("found", none)).withColumn("starts", starts).withColumn("base_labels", F.array_sort(F.array_distinct(base)))
    labels = F.array_sort(F.array_union("base_labels", F.transform("found", lambda x: x["label"])))
    score = F.when(F.size("starts") > 0, F.lit(1.0)).otherwise(F.coalesce(F.array_max(F.transform("found", lambda x: x["containment"])), F.lit(0.0)))
    return out.select("doc_id", "n_words", "starts", "base_labels", "found", labels.alias("labels"), score.alias("score"))


def crossing(ranks: Column, lines: Column, size: int, least: int) -> Column:
    """(block, run) of the runs of `size` words that cross lines, begin with a known word and hold `least` known words.

    ranks has the rank of each word of the text, -1 for an unknown one, lines its line. A run that begins with an
    unknown word holds no more than the next one, and one within a line no more than the line.
    """
    end = F.size(ranks) - 1
    starts = F.filter(F.sequence(F.lit(0), end), lambda p: (F.get(ranks, p) >= 0) & (F.get(lines, p) < F.get(lines, F.least(p + size - 1, end))))
    runs = F.transform(starts, lambda p: F.struct(F.get(lines, p).alias("block"), F.slice(ranks, p + 1, size).alias("run")))
    return F.when(F.size(ranks) > 0, F.filter(runs, lambda r: F.size(known(r["run"])) >= least))


def known(run: Column) -> Column:
    return F.array_sort(F.array_distinct(F.filter(run, lambda r: r >= 0)))


def block_matches(scanned: DataFrame, sets, need, vocabulary, spans: list[int] | None = None) -> DataFrame:
    """(doc_id, rk1, rk2, label, block, containment) of every block that meets a template's threshold.

    Blocks are lines and, where spans has a number of words for each template, the runs of so many words that cross lines.
    """
    spark = scanned.sparkSession
    counts = {r.token: r.n for r in scanned.select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count("*").alias("n")).collect()}
    order = sorted(vocabulary, key=lambda w: (counts.get(w, 0), w))
    rank = {w: i for i, w in enumerate(order)}
    prefixes = []
    for k, label, words in sets:
        ranks = sorted(rank[w] for w in words)
        prefixes += [(k, label, r, i, need[k], ranks, spans[k] if spans else 0) for i, r in enumerate(ranks[: len(ranks) - need[k] + 1])]
    prefix = spark.createDataFrame(prefixes, "template int, label string, rank int, at int, need int, ranks array<int>, span int")
    texts = scanned.where(F.col("text").isNotNull()).dropDuplicates(["doc_id", "rk1", "rk2"])
    blocks = texts.select("doc_id", "rk1", "rk2", F.posexplode(F.split("text", "\n", -1)).alias("block", "line"))
    held = F.array_distinct(F.filter(F.split(normalised(F.col("line")), " "), lambda w: w.isin(vocabulary)))
    ordered = F.array(*map(F.lit, order))
    blocks = blocks.withColumn("held", F.sort_array(F.transform(held, lambda w: (F.array_position(ordered, w) - 1).cast("int"))))
    blocks = blocks.where(F.size("held") >= min(need.values())).select("doc_id", "rk1", "rk2", "block", "held", F.lit(None).cast("array<int>").alias("run"))
    if spans:
        by_line = F.transform(F.split("text", "\n", -1), lambda line: F.filter(F.split(normalised(line), " "), lambda w: w != ""))
        words = texts.select("doc_id", "rk1", "rk2", by_line.alias("by_line"))
        ranks = F.transform(F.flatten("by_line"), lambda w: (F.array_position(ordered, w) - 1).cast("int"))
        lines = F.flatten(F.transform("by_line", lambda ws, i: F.array_repeat(i, F.size(ws))))
        words = words.select("doc_id", "rk1", "rk2", ranks.alias("ranks"), lines.alias("lines"))
        runs = words.select("doc_id", "rk1", "rk2", F.explode(crossing(F.col("ranks"), F.col("lines"), max(spans), min(need.values()))).alias("r"))
        blocks = blocks.unionByName(runs.select("doc_id", "rk1", "rk2", "r.block", known(F.col("r.run")).alias("held"), "r.run"))
    met = blocks.select("doc_id", "rk1", "rk2", "block", "held", "run", F.posexplode("held").alias("pos", "rank"))
    met = met.join(F.broadcast(prefix), "rank").where((F.size("held") >= F.col("need")) & (F.least(F.size("ranks") - F.col("at"), F.size("held") - F.col("pos")) >= F.col("need")))
    # A run is as long as the longest template needs; of it, each template is compared with its own span.
    own = F.coalesce(F.slice("run", F.lit(1), F.col("span")), F.col("held"))
    met = met.withColumn("both", F.size(F.array_intersect(own, F.col("ranks")))).where(F.col("both") >= F.col("need"))
    return met.select("doc_id", "rk1", "rk2", "label", "block", (F.col("both") / F.size("ranks")).alias("containment")).groupBy("doc_id", "rk1", "rk2", "label", "block").agg(F.max("containment").alias("containment"))


def op9_license_scan(spark, sf_dir):
    out = scan_licenses(read(spark, sf_dir, "documents"), wrapped=True)
    return out.select(
        "doc_id", "n_words", F.size("starts").cast("long").alias("n_base"),
        F.array_min("starts").alias("first_word"), F.array_max("starts").alias("last_word"),
        F.array_join("base_labels", ",").alias("base_labels"), F.array_join("labels", ",").alias("labels"), "score",
    )


def op9_sql() -> str:
    """All pairs of blocks and templates, without any filter."""
    values = ", ".join(f"({k}, '{label}', [{', '.join(repr(w) for w in words)}], {math.ceil(0.8 * len(words) - 1e-9)})" for k, label, words in template_sets(TEMPLATES))
    phrases = ", ".join(f"('{p}', '{label}', {p.count(' ') + 1})" for p, label in PHRASES.items())
    fold = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    words_of = "list_filter(regexp_split_to_array(" + fold + r", '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"
    return f"""
WITH t(k, label, words, need) AS (VALUES {values}),
p(phrase, label, n) AS (VALUES {phrases}),
d AS (SELECT doc_id, {words_of.format("coalesce(text, '')")} AS w FROM documents),
hits AS (SELECT doc_id, p.label, i - 1 AS i FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM d) x, p WHERE array_to_string(w[i : i + n - 1], ' ') = phrase),
b AS (SELECT doc_id, list_distinct({words_of.format("line")}) AS w FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents)),
m AS (SELECT doc_id, label, len(list_intersect(b.w, t.words)) / len(t.words) AS c FROM b, t WHERE len(list_intersect(b.w, t.words)) >= need),
base AS (SELECT doc_id, count(*) AS n_base, min(i) AS first_word, max(i) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM hits GROUP BY doc_id),
l AS (SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM (SELECT doc_id, label FROM hits UNION ALL SELECT doc_id, label FROM m) GROUP BY doc_id),
s AS (SELECT doc_id, max(c) AS c FROM m GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(c, 0)::DOUBLE END AS score
FROM d LEFT JOIN base USING (doc_id) LEFT JOIN l USING (doc_id) LEFT JOIN s USING (doc_id)
"""
