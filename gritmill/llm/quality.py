"""Quality rules: base counts, and divergence of a document's histograms from its language's.

A document's character-class and common-word histograms are compared with those
of its language by Jensen-Shannon distance (base 2, 0 to 1). A language's
histograms come from its documents that pass the base rules and are long enough
to be judged themselves.

The cuts of 0.25 and 0.35 are set on labels.quality, rows whose crc32(doc_id)
mod 5 is not 0: of those that are judged they keep 99.6 percent of the good and
23 percent of the poor documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WS_RUN, pick, read, table

#: Frequent function words by language.
COMMON = {
    "en": "the of and to in is that it was for on are as with be by at this from or an have not you a",
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an",
    "fr": "de la le et les des en un du une que est pour qui dans par sur au avec pas ce il ne se plus",
    "es": "de la que el en y a los se del las un por con no una su para es al lo como más o",
}
WORDS = sorted({w for ws in COMMON.values() for w in ws.split()})
#: Characters of these classes are taken out one after another; what is left is punctuation.
CLASSES = {"lower": "[a-z]+", "space": WS_RUN, "upper": "[A-Z]+", "digit": "[0-9]+", "symbol": r"[#*$%&|<>]+", "letter": r"[^\x00-\x7F]+"}


def document_counts(docs: DataFrame) -> DataFrame:
    """docs(doc_id, lang, text) to one row of counts each; no text is shuffled."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", "lang", text.alias("text"))
    stages = []  # one expression a step, so that no step is evaluated twice
    rest = "text"
    for name, pattern in CLASSES.items():
        rows = rows.withColumn(f"_{name}", F.regexp_replace(rest, pattern, ""))
        stages.append((F.length(rest) - F.length(f"_{name}")).cast("long").alias(name))
        rest = f"_{name}"
    stages.append(F.length(rest).cast("long").alias("punct"))
    full = F.filter(F.split("text", "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    rows = rows.select("doc_id", "lang", *stages, F.filter(F.split("text", WS_RUN, -1), lambda w: w != "").alias("words"), full.alias("lines"))
    none = F.array().cast("array<bigint>")
    grams = F.transform(F.sequence(F.lit(0), F.size("words") - 3), lambda i: F.xxhash64(F.get("words", i), F.get("words", i + 1), F.get("words", i + 2)))
    rows = rows.withColumn("grams", F.when(F.size("words") >= 3, grams).otherwise(none))
    tidy = F.transform("words", lambda w: F.lower(F.rtrim(w, F.lit(".,;:!?"))))
    rows = rows.withColumn("common", F.sort_array(F.filter(tidy, lambda w: w.isin(WORDS))))
    # Windows that occur twice stand next to their equals when sorted with their places.
    placed = F.when(F.size(F.array_distinct("grams")) < F.size("grams"), F.sort_array(F.transform("grams", lambda g, i: F.struct(g.alias("g"), i.alias("i")))))
    rows = rows.withColumn("placed", placed)
    at = F.sequence(F.lit(0), F.size("placed") - 1)
    same = lambda i, j: F.get("placed", i)["g"] == F.get("placed", j)["g"]
    twice = F.filter(at, lambda i: F.coalesce((i > 0) & same(i, i - 1), F.lit(False)) | F.coalesce(same(i, i + 1), F.lit(False)))
    rows = rows.withColumn("twice", F.when(F.col("placed").isNotNull(), F.transform(twice, lambda i: F.get("placed", i)["i"])))
    covered = F.size(F.array_distinct(F.concat("twice", F.transform("twice", lambda i: i + 1), F.transform("twice", lambda i: i + 2))))
    firsts = F.filter(F.sequence(F.lit(0), F.size("common") - 1), lambda i: (i == 0) | (F.get("common", i) != F.get("common", i - 1)))
    rows = rows.withColumn("firsts", F.when(F.size("common") > 0, firsts).otherwise(F.array().cast("array<int>")))
    counted = F.transform("firsts", lambda i, k: F.struct(F.get("common", i).alias("word"), (F.coalesce(F.get("firsts", k + 1), F.size("common")) - i).cast("long").alias("n")))
    return rows.select(
        "doc_id", "lang", *CLASSES, "punct",
        F.size("words").cast("long").alias("n_words"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(F.col("twice").isNull(), 0).otherwise(covered).cast("long").alias("n_repeat_words"),
        counted.alias("common"),
    )


def language_references(counts: DataFrame) -> DataFrame:
    """(ref_lang, ref_docs, ref_words: map, ref_classes: array): shares over the counted documents of a language."""
    classes = [*CLASSES, "punct"]
    per = counts.groupBy("lang").agg(F.count("*").alias("ref_docs"), F.sum("n_words").alias("words"), F.array(*(F.sum(c) for c in classes)).alias("sums"), F.sum(sum((F.col(c) for c in classes[1:]), F.col(classes[0]))).alias("chars"))
    used = counts.select("lang", F.explode("common").alias("c")).groupBy("lang", F.col("c.word").alias("word")).agg(F.sum("c.n").alias("n"))
    used = used.groupBy("lang").agg(F.map_from_entries(F.collect_list(F.struct("word", "n"))).alias("ns")).toDF("lang2", "ns")
    per = per.join(used, per.lang.eqNullSafe(used.lang2), "left").withColumn("ns", F.coalesce("ns", F.create_map().cast("map<string,bigint>")))
    share = F.transform_values("ns", lambda _, n: n / F.col("words"))
    return per.select(F.col("lang").alias("ref_lang"), "ref_docs", share.alias("ref_words"), F.transform("sums", lambda s: F.when(F.col("chars") > 0, s / F.col("chars")).otherwise(F.lit(0.0))).alias("ref_classes"))


def _part(p: Column, q: Column) -> Column:
    """What one bin adds to the divergence of p and q."""
    mid = (p + q) / 2
    side = lambda x: F.when(x > 0, x * F.log2(x / mid)).otherwise(F.lit(0.0))
    return (side(p) + side(q)) / 2


def _total(parts: Column) -> Column:
    return F.aggregate(parts, F.lit(0.0), lambda a, x: a + x)


def judge_quality(docs: DataFrame, min_words: int = 50, max_class_distance: float = 0.25, max_word_distance: float = 0.35, guard_words: int = 100, guard_docs: int = 10, broadcast_langs: int = 5_000, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(doc_id, n_words, ..., base_failed, class_distance, word_distance, kept): one row per input row.

    base_failed: under min_words words, or more than half of the words in
    three-word windows that occur twice. The distances judge documents of
    guard_words words or more only; shorter ones that pass the base are kept.
    References are made of the documents of guard_words words or more that pass
    the base; a language with fewer than guard_docs of them judges nothing, and
    its documents have no distance. Null texts are empty and fail the base. A
    null lang is a language of its own. Rows with equal ids are judged one by
    one. An empty table gives no rows. References have a row a language; they
    are broadcast if there are at most broadcast_langs of them.
    """
    docs = pick(docs, doc_id=id_col, text=text_col, lang=lang_col)
    counts = table(document_counts(docs), "quality-counts")
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    solid = counts.where(~failed & (F.col("n_words") >= guard_words))
    refs = table(language_references(solid).where(F.col("ref_docs") >= guard_docs), "quality-references")
    refs = F.broadcast(refs) if refs.count() <= broadcast_langs else refs
    rows = counts.join(refs, counts.lang.eqNullSafe(refs.ref_lang), "left")
    chars = sum((F.col(c) for c in [*CLASSES][1:]), F.col([*CLASSES][0])) + F.col("punct")
    rows = rows.withColumn("chars", chars)
    mine = F.array(*(F.when(F.col("chars") > 0, F.col(c) / F.col("chars")).otherwise(F.lit(0.0)) for c in [*CLASSES, "punct"]))
    classes = _total(F.zip_with(mine, "ref_classes", _part))
    # Common words by name, all others in one bin; words that only the reference has add half their share.
    used = F.transform("common", lambda c: F.struct((c["n"] / F.col("n_words")).alias("p"), F.coalesce(F.element_at("ref_words", c["word"]), F.lit(0.0)).alias("q")))
    rows = rows.withColumn("used", used).withColumn("ref_total", _total(F.map_values("ref_words")))
    p_used, q_used = _total(F.transform("used", lambda u: u["p"])), _total(F.transform("used", lambda u: u["q"]))
    words = _total(F.transform("used", lambda u: _part(u["p"], u["q"]))) + (F.col("ref_total") - q_used) / 2 + _part(F.greatest(1 - p_used, F.lit(0.0)), F.greatest(1 - F.col("ref_total"), F.lit(0.0)))
    judged = (F.col("n_words") > 0) & F.col("ref_docs").isNotNull()
    distance = lambda c: F.when(judged, F.round(F.sqrt(F.greatest(c, F.lit(0.0))), 6))
    rows = rows.withColumn("class_distance", distance(classes)).withColumn("word_distance", distance(words))
    far = F.coalesce((F.col("n_words") >= guard_words) & ((F.col("class_distance") > max_class_distance) | (F.col("word_distance") > max_word_distance)), F.lit(False))
    return rows.select("doc_id", "n_words", (chars - F.col("space")).alias("word_chars"), F.col("symbol").alias("n_symbols"), "n_dup_lines", "n_repeat_words", failed.alias("base_failed"), "class_distance", "word_distance", (~failed & ~far).alias("kept"))


def op3_quality_rules(spark, sf_dir):
    return judge_quality(read(spark, sf_dir, "documents"))


def op3_sql() -> str:
    classes = [*CLASSES, "punct"]
    steps, rest = [], "text"
    for name, pattern in CLASSES.items():
        left = f"regexp_replace({rest}, '{pattern}', '', 'g')"
        steps.append(f"length({rest}) - length({left}) AS {name}")
        rest = left
    common = ", ".join(f"'{w}'" for w in WORDS)
    part = "((CASE WHEN {p} > 0 THEN {p} * log2({p} / (({p} + {q}) / 2)) ELSE 0 END) + (CASE WHEN {q} > 0 THEN {q} * log2({q} / (({p} + {q}) / 2)) ELSE 0 END)) / 2"
    by_class = " + ".join("(" + part.format(p=f"(c.{x} / c.chars)", q=f"(r.{x} / r.chars)") + ")" for x in classes)
    rest_part = part.format(p="greatest(1 - coalesce(s.p, 0), 0.0)", q="greatest(1 - r.total, 0.0)")
    return rf"""
WITH d AS (SELECT doc_id, lang, coalesce(text, '') AS text FROM documents),
k AS (SELECT doc_id, lang, {", ".join(steps)}, length({rest}) AS punct,
        list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
        list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
c AS (SELECT *, ({" + ".join(classes)}) AS chars, len(w) AS n FROM k),
g AS (SELECT doc_id, i, array_to_string(w[i : i + 2], ' ') AS gram FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM c)),
h AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, gram) AS m FROM g) WHERE m > 1),
rep AS (SELECT doc_id, count(DISTINCT j) AS n_repeat FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS j FROM h) GROUP BY doc_id),
u AS (SELECT doc_id, lang, x, count(*) AS m FROM (SELECT doc_id, lang, rtrim(lower(unnest(w)), '.,;:!?') AS x FROM c) WHERE x IN ({common}) GROUP BY ALL),
good AS (SELECT c.* FROM c LEFT JOIN rep USING (doc_id) WHERE n >= 100 AND 100 * coalesce(n_repeat, 0) <= 50 * n),
rl AS (SELECT lang, sum(n) AS words, sum(chars) AS chars, {", ".join(f"sum({x}) AS {x}" for x in classes)} FROM good GROUP BY lang HAVING count(*) >= 10),
rw AS (SELECT u.lang, x, sum(m) / any_value(words) AS q FROM u JOIN rl ON u.lang IS NOT DISTINCT FROM rl.lang WHERE u.doc_id IN (SELECT doc_id FROM good) GROUP BY u.lang, x),
r AS (SELECT rl.*, coalesce((SELECT sum(q) FROM rw WHERE rw.lang IS NOT DISTINCT FROM rl.lang), 0) AS total FROM rl),
s AS (SELECT doc_id, sum(m / n) AS p, sum(q) AS q, sum({part.format(p="(m / n)", q="q")}) AS js
      FROM (SELECT u.doc_id, m, n, coalesce(q, 0) AS q FROM u JOIN c USING (doc_id) LEFT JOIN rw ON u.lang IS NOT DISTINCT FROM rw.lang AND u.x = rw.x) GROUP BY doc_id),
j AS (SELECT c.doc_id, n AS n_words, chars - space AS word_chars, symbol AS n_symbols, len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n_repeat, 0) AS n_repeat_words,
        n < 50 OR 100 * coalesce(n_repeat, 0) > 50 * n AS base_failed,
        CASE WHEN n > 0 AND EXISTS (SELECT 1 FROM r WHERE r.lang IS NOT DISTINCT FROM c.lang) THEN round(sqrt(greatest((SELECT {by_class} FROM r WHERE r.lang IS NOT DISTINCT FROM c.lang), 0)), 6) END AS class_distance,
        CASE WHEN n > 0 AND EXISTS (SELECT 1 FROM r WHERE r.lang IS NOT DISTINCT FROM c.lang) THEN round(sqrt(greatest((SELECT coalesce(s.js, 0) + (r.total - coalesce(s.q, 0)) / 2 + {rest_part} FROM r WHERE r.lang IS NOT DISTINCT FROM c.lang), 0)), 6) END AS word_distance
      FROM c LEFT JOIN rep USING (doc_id) LEFT JOIN s USING (doc_id))
SELECT *, NOT base_failed AND NOT coalesce(n_words >= 100 AND (class_distance > 0.25 OR word_distance > 0.35), false) AS kept FROM j
"""
