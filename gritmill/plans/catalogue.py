"""The engine's operators as queries over the test tables, each with SQL that says the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import dedupe, external, lexicon, merge, publish, score, select, sidetables
from ..schemas import SCORES, empty, preferred_first, with_missing_columns
from ..sources import readers, writers
from ..streaming import resume

QUERIES, SQL = {}, {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- scans, projections, semi and anti joins


@query("SELECT CAST(doc_id AS VARCHAR) AS item_id, text AS description, source AS location_name, CAST(n_chars AS DOUBLE) AS size, n_chars / 2 > 500 AS large FROM documents WHERE doc_id IS NOT NULL")
def manifest_project(spark, d):
    x = table(spark, d, "documents").where(F.col("doc_id").isNotNull())
    return x.select(F.col("doc_id").cast("string").alias("item_id"), F.col("text").alias("description"), F.col("source").alias("location_name"), F.col("n_chars").cast("double").alias("size"), (F.col("n_chars") / 2 > 500).alias("large"))


@query("SELECT DISTINCT user_id AS item_id FROM events WHERE lower(trim(event_type)) IN ('error', 'signup') AND user_id IS NOT NULL")
def art_ids_distinct(spark, d):
    return dedupe.excluded_ids(table(spark, d, "events").withColumnsRenamed({"user_id": "item_id", "event_type": "keyword"}), ("error", "signup"))


def _toxic(spark, d):
    return dedupe.keys_of(table(spark, d, "labels"), "doc_id", F.col("toxic") == 1)


@query("SELECT d.doc_id, source, n_chars FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND toxic = 1)")
def filter_anti(spark, d):
    return dedupe.exclude_by_keys(table(spark, d, "documents"), _toxic(spark, d), "doc_id").select("doc_id", "source", "n_chars")


@query("SELECT d.doc_id, source, n_chars FROM documents d WHERE EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND toxic = 1)")
def filter_semi(spark, d):
    return dedupe.keep_by_keys(table(spark, d, "documents"), _toxic(spark, d), "doc_id").select("doc_id", "source", "n_chars")


@query("SELECT (SELECT count(*) FROM documents) AS total, (SELECT count(*) FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1)) AS removed, (SELECT count(*) FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)) AS kept")
def filter_split_counts(spark, d):
    ids = _toxic(spark, d).withColumn("__hit", F.lit(True))
    x = table(spark, d, "documents").select("doc_id").join(ids, "doc_id", "left")
    return x.agg(F.count("*").alias("total"), F.count("__hit").alias("removed"), F.count_if(F.col("__hit").isNull()).alias("kept"))


@query("SELECT doc_id, text, lang, source, n_chars FROM documents WHERE doc_id = 7 LIMIT 1")
def point_lookup(spark, d):
    return readers.point_lookup(table(spark, d, "documents"), "doc_id", 7)


@query("SELECT count(*) AS n, count(DISTINCT part) AS parts, min(part) AS lo, max(part) AS hi FROM (SELECT range % 8 AS part FROM range((SELECT count(*) FROM orders)))")
def shard_predicate(spark, d):
    """Each row is in one of eight hash shards, and none is empty."""
    x = table(spark, d, "orders").select(dedupe.shard_of(F.col("o_orderkey"), 8).cast("long").alias("part"))
    return x.agg(F.count("*").alias("n"), F.count_distinct("part").alias("parts"), F.min("part").alias("lo"), F.max("part").alias("hi"))


# --- keywords and conversions

KW = "SELECT user_id AS item_id, 'k' || json_extract_string(props, '$.k') AS kw, value AS conf, CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS u FROM events"
DEDUP = f"SELECT item_id, kw, max(conf) AS conf, max(u) AS u FROM ({KW}) GROUP BY item_id, kw"


def _kw(spark, d):
    x = table(spark, d, "events")
    return x.select(F.col("user_id").alias("item_id"), F.concat(F.lit("k"), F.get_json_object("props", "$.k")).alias("kw"), F.col("value").alias("conf"), F.when(F.col("event_type") == "purchase", 1).otherwise(0).alias("user"))


@query(r"""SELECT p_partkey AS item_id, regexp_replace(k, '[\t\n\f\r ]+', ' ', 'g') AS kw FROM (SELECT p_partkey, lower(trim(p_name)) AS k FROM part)
WHERE k IS NOT NULL AND length(k) BETWEEN 3 AND 80 AND k NOT IN ('', 'null', 'none', 'n/a') AND regexp_matches(k, '[a-zA-Z一-龥]')""")
def kw_clean(spark, d):
    x = table(spark, d, "part").withColumnsRenamed({"p_partkey": "item_id", "p_name": "keyword"})
    return sidetables.clean_keywords(x, 3, 80, require_letter=True).select("item_id", "kw")


@query("SELECT item_id, kw, conf, CAST(u AS BIGINT) AS user_flag FROM (" + DEDUP + ")")
def kw_dedup_max(spark, d):
    return sidetables.dedupe_keywords(_kw(spark, d)).select("item_id", "kw", "conf", F.col("user").cast("long").alias("user_flag"))


def _top(spark, d, where, n, *order):
    from pyspark.sql import Window as W

    x = sidetables.dedupe_keywords(_kw(spark, d)).where(where)
    return x.withColumn("rn", F.row_number().over(W.partitionBy("item_id").orderBy(*order)).cast("long")).where(F.col("rn") <= n).select("item_id", "kw", "rn")


def _top_sql(where, n, order):
    return f"SELECT item_id, kw, rn FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY {order}) AS rn FROM ({DEDUP}) WHERE {where}) WHERE rn <= {n}"


@query(_top_sql("true", 32, "u DESC, conf DESC, kw"))
def kw_top32(spark, d):
    return _top(spark, d, F.lit(True), 32, F.col("user").desc(), F.col("conf").desc(), "kw")


@query(_top_sql("u = 1 OR conf >= 55", 24, "conf DESC, kw"))
def kw_highconf24(spark, d):
    return _top(spark, d, (F.col("user") == 1) | (F.col("conf") >= 55), 24, F.col("conf").desc(), "kw")


@query(_top_sql("u = 1", 24, "kw"))
def kw_user24(spark, d):
    return _top(spark, d, F.col("user") == 1, 24, "kw")


def _agg_sql(all_, high, user, conf):
    return f"""WITH k AS ({DEDUP}),
r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY u DESC, conf DESC, kw) AS r0, row_number() OVER (PARTITION BY item_id ORDER BY conf DESC, kw) AS ra, row_number() OVER (PARTITION BY item_id ORDER BY kw) AS rb,
  row_number() OVER (PARTITION BY item_id, (u = 1 OR conf >= 55) ORDER BY conf DESC, kw) AS r1, row_number() OVER (PARTITION BY item_id, u = 1 ORDER BY kw) AS r2 FROM k)
SELECT item_id, count(*) FILTER (WHERE {all_}) AS keyword_count, CAST(sum(u) FILTER (WHERE {all_}) AS BIGINT) AS keyword_user_count, max(conf) FILTER (WHERE {conf}) AS keyword_ai_max_conf,
  string_agg(kw, ' | ' ORDER BY u DESC, conf DESC, kw) FILTER (WHERE {all_}) AS keywords_joined,
  string_agg(kw, ' | ' ORDER BY conf DESC, kw) FILTER (WHERE (u = 1 OR conf >= 55) AND {high}) AS keywords_highconf_joined,
  string_agg(kw, ' | ' ORDER BY kw) FILTER (WHERE u = 1 AND {user}) AS keywords_user_joined FROM r GROUP BY item_id"""


CAPPED = _agg_sql("r0 <= 32", "r1 <= 24", "r2 <= 24", "r0 <= 32")


@query(CAPPED)
def kw_agg_capped(spark, d):
    return sidetables.keyword_agg(_kw(spark, d))


@query(_agg_sql("true", "true", "true", "true"))
def kw_agg_uncapped(spark, d):
    return sidetables.keyword_agg(_kw(spark, d), caps=None)


@query(_agg_sql("r0 <= 32", "ra <= 24", "rb <= 24", "true"))
def kw_agg_rank_first(spark, d):
    return sidetables.keyword_agg(_kw(spark, d), rank_before_filter=True)


CV = f"SELECT item_id, kw, count(*) AS cnt FROM ({KW}) GROUP BY item_id, kw"


@query(CV)
def cv_counts(spark, d):
    return sidetables.conversion_counts(_kw(spark, d))


@query(f"SELECT item_id, kw, cnt, rn FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY cnt DESC, kw) AS rn FROM ({CV})) WHERE rn <= 12")
def cv_top12(spark, d):
    from pyspark.sql import Window as W

    x = sidetables.conversion_counts(_kw(spark, d))
    return x.withColumn("rn", F.row_number().over(W.partitionBy("item_id").orderBy(F.col("cnt").desc(), "kw")).cast("long")).where("rn <= 12")


CV_AGG = f"""SELECT item_id, CAST(sum(cnt) AS BIGINT) AS conv_event_count, count(*) AS conv_unique_keyword_count, string_agg(kw, ' | ' ORDER BY cnt DESC, kw) AS conv_keywords_joined, first(kw ORDER BY cnt DESC, kw) AS conv_top_keyword
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY cnt DESC, kw) AS rn FROM ({CV})) WHERE rn <= 12 GROUP BY item_id"""


@query(CV_AGG)
def cv_agg(spark, d):
    return sidetables.conversion_agg(_kw(spark, d))


@query(CV_AGG.replace("WHERE rn <= 12 ", ""))
def cv_agg_uncapped(spark, d):
    return sidetables.conversion_agg(_kw(spark, d), cap=None)


@query(f"SELECT item_id, kw, max(conf) AS conf, CAST(max(u) AS BIGINT) AS user_flag, count(*) AS n FROM ({KW}) GROUP BY item_id, kw")
def two_phase_agg(spark, d):
    """Partial aggregates of four parts, united and aggregated again."""
    x = _kw(spark, d).withColumn("part", F.pmod(F.xxhash64("item_id", "kw", "conf"), F.lit(4)))
    part = x.groupBy("part", "item_id", "kw").agg(F.max("conf").alias("conf"), F.max("user").alias("user"), F.count("*").alias("n"))
    return part.groupBy("item_id", "kw").agg(F.max("conf").alias("conf"), F.max("user").cast("long").alias("user_flag"), F.sum("n").alias("n"))


@query(f"""SELECT c.c_custkey AS item_id, c_mktsegment, n_name, keyword_count, keywords_joined, conv_event_count, conv_top_keyword FROM customer c
LEFT JOIN nation ON n_nationkey = c_nationkey LEFT JOIN ({CAPPED}) k ON k.item_id = c.c_custkey LEFT JOIN ({CV_AGG}) v ON v.item_id = c.c_custkey""")
def enrich_left_joins(spark, d):
    items = table(spark, d, "customer").join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left").withColumnRenamed("c_custkey", "item_id")
    x = sidetables.enrich(items, sidetables.keyword_agg(_kw(spark, d)), sidetables.conversion_agg(_kw(spark, d)))
    return x.select("item_id", "c_mktsegment", "n_name", "keyword_count", "keywords_joined", "conv_event_count", "conv_top_keyword")


@query("SELECT CAST(doc_id AS VARCHAR) AS item_id, source, CAST(NULL AS VARCHAR) AS aesthetic_error FROM documents")
def empty_side_table(spark, d):
    items = table(spark, d, "documents").select(F.col("doc_id").cast("string").alias("item_id"), "source")
    return sidetables.enrich(items, empty(spark, SCORES)).select("item_id", "source", "aesthetic_error")


# --- lists and text

RAW_LIST = "string_agg(CASE WHEN k % 3 = 0 THEN ' K' || k || ' ' WHEN k % 7 = 0 THEN ' ' ELSE 'k' || k END, '|' ORDER BY event_id)"
LISTS = f"""SELECT user_id AS item_id, {RAW_LIST} AS every, {RAW_LIST} FILTER (WHERE value >= 55) AS high, {RAW_LIST} FILTER (WHERE event_type = 'purchase') AS own, {RAW_LIST} FILTER (WHERE event_type = 'click') AS conv
FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events) GROUP BY user_id"""
PARSED = "list_filter(list_transform(string_split(coalesce({0}, ''), '|'), lambda x: lower(trim(x))), lambda x: x <> '')"
UNIQUE = "list_reduce(list_prepend([], list_transform({0}, lambda x: [x])), lambda a, b: CASE WHEN list_contains(a, b[1]) THEN a ELSE list_concat(a, b) END)"


def _lists(spark, d):
    k = F.get_json_object("props", "$.k").cast("int")
    x = table(spark, d, "events").withColumn("k", k)
    x = x.withColumn("cell", F.when(F.col("k") % 3 == 0, F.concat(F.lit(" K"), "k", F.lit(" "))).when(F.col("k") % 7 == 0, " ").otherwise(F.concat(F.lit("k"), "k")))

    def joined(where):
        rows = F.array_sort(F.collect_list(F.when(where, F.struct("event_id", "cell"))))
        return F.array_join(F.transform(rows, lambda r: r["cell"]), "|")

    return x.groupBy(F.col("user_id").alias("item_id")).agg(joined(F.lit(True)).alias("every"), joined(F.col("value") >= 55).alias("high"), joined(F.col("event_type") == "purchase").alias("own"), joined(F.col("event_type") == "click").alias("conv"))


@query(f"SELECT item_id, len(p) AS n_items, array_to_string({UNIQUE.format('p')}, ' | ') AS items FROM (SELECT item_id, {PARSED.format('every')} AS p FROM ({LISTS}))")
def list_parse_unique(spark, d):
    x = _lists(spark, d)
    return x.select("item_id", F.size(T.pipe_list(F.col("every"))).cast("long").alias("n_items"), T.join_list(T.unique_list(F.col("every"))).alias("items"))


@query(f"""WITH l AS (SELECT item_id, {UNIQUE.format(PARSED.format('own'))} AS u, {UNIQUE.format(PARSED.format('high'))} AS h, {UNIQUE.format(PARSED.format('every'))} AS e, {UNIQUE.format(PARSED.format('conv'))} AS c FROM ({LISTS}))
SELECT item_id, array_to_string(u, ' | ') AS keywords_user, array_to_string(list_filter(h, lambda x: NOT list_contains(u, x)), ' | ') AS keywords_highconf,
  array_to_string(list_filter(e, lambda x: NOT list_contains(u, x) AND NOT list_contains(h, x)), ' | ') AS keywords_all, array_to_string(c[1:12], ' | ') AS conv_keywords FROM l""")
def kw_group_exclusive(spark, d):
    groups = T.exclusive_groups(F.col("own"), F.col("high"), F.col("every"), F.col("conv"))
    return _lists(spark, d).select("item_id", *(T.join_list(c).alias(k) for k, c in groups.items()))


#: Braces are doubled for str.format.
SPACE = r"[\x09-\x0D\x1C-\x20\x{{85}}\x{{A0}}\x{{1680}}\x{{2000}}-\x{{200A}}\x{{2028}}\x{{2029}}\x{{202F}}\x{{205F}}\x{{3000}}]"
NORM = r"trim(regexp_replace(regexp_replace(replace(lower(coalesce({0}, '')), '|', ' '), '[_/\\]+', ' ', 'g'), '" + SPACE + r"+', ' ', 'g'))"
STRIP = "regexp_replace({0}, '^" + SPACE + "+|" + SPACE + "+$', '', 'g')"


@query(f"SELECT doc_id, {NORM.format('text')} AS norm FROM documents")
def norm_text(spark, d):
    return table(spark, d, "documents").select("doc_id", T.norm_text(F.col("text")).alias("norm"))


@query(f"SELECT doc_id, left(concat_ws(chr(10), 'description: ' || nullif({STRIP.format('text')}, ''), 'location_name: ' || nullif(source, ''), 'language: ' || CASE WHEN lang <> 'en' THEN lang END), 1800) AS text_for_cls FROM documents")
def assemble_text(spark, d):
    x = table(spark, d, "documents")
    fields = [("description", F.col("text")), ("location_name", F.col("source")), ("language", F.when(F.col("lang") != "en", F.col("lang")))]
    return x.select("doc_id", T.assemble_text(fields).alias("text_for_cls"))


@query("SELECT doc_id, left(text, 600) AS short_text, length(left(text, 1800)) AS n FROM documents")
def truncate_text(spark, d):
    x = table(spark, d, "documents")
    return x.select("doc_id", T.truncate(F.col("text"), 600).alias("short_text"), F.char_length(T.truncate(F.col("text"), 1800)).cast("long").alias("n"))


# --- lexicon

LANGUAGES = lexicon.LexiconSpec(
    labels=("en", "de", "fr", "es"),
    vocabulary={
        "en": (("the", "and", "with", "of the"), ("that", "this", "is", "to")),
        "de": (("der", "und", "nicht"), ("sich", "eine", "das")),
        "fr": (("les", "dans", "avec"), ("pour", "des", "est")),
        "es": (("los", "para", "una"), ("que", "las", "por")),
    },
    fields=(("text", 4, 1), ("source", 2, 0)),
    text_fields=(("description", "text"), ("location_name", "source")),
    reject_terms=("idiot", "moron", "scum", "token", "all rights"), anchors=("the", "und", "les", "los"), guarded="es",
)


def _q(values):
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]" if values else "CAST([] AS VARCHAR[])"


def _hits_sql(norm, words, terms):
    single, phrases = T.split_terms(terms)
    return f"(list_concat(list_filter({_q(single)}, lambda t: list_contains({words}, t)), list_filter({_q(phrases)}, lambda t: contains({norm}, t))))"


def lexicon_sql(spec=LANGUAGES, items="documents") -> str:
    """The scoring as one SELECT with a column for each rule output."""
    n = len(spec.labels)
    fields = [f for f, _, _ in spec.fields]
    norm = ", ".join(f"{NORM.format(f)} AS n{i}" for i, f in enumerate(fields))
    text = "left(concat_ws(chr(10), " + ", ".join(f"'{name}: ' || nullif({STRIP.format(f'coalesce({c}, chr(32))')}, '')" for name, c in spec.text_fields) + f"), {spec.text_chars})"
    split = r"list_distinct(list_filter(regexp_split_to_array({0}, '[^\p{{L}}\p{{N}}_]+'), lambda x: x <> ''))"
    toks = ", ".join(f"{split.format(f'n{i}')} AS t{i}" for i in range(len(fields)))
    hits = [f"len({_hits_sql(f'n{i}', f't{i}', spec.vocabulary[lab][w])}) AS {s}{k}_{i}" for k, lab in enumerate(spec.labels) for w, s in enumerate("sw") for i in range(len(fields))]
    sums = [f"{' + '.join(f'{s}{k}_{i}' for i in range(len(fields)))} AS {s}{k}" for k in range(n) for s in "sw"]
    raw = [f"{' + '.join(f'{p[1]} * s{k}_{i} + {p[2]} * w{k}_{i}' for i, p in enumerate(spec.fields))} AS r{k}" for k in range(n)]
    g = spec.labels.index(spec.guarded)
    others = f"greatest({', '.join(f'r{k}' for k in range(n) if k != g)})"
    points = [f"CASE WHEN r{g} > 0 AND NOT anchored AND s{g} = 0 THEN greatest(0, r{g} - CASE WHEN {others} >= r{g} THEN 3 ELSE 2 END) ELSE r{g} END AS p{g}" if k == g else f"r{k} AS p{k}" for k in range(n)]
    ranked = "list_sort([" + ", ".join(f"{{'neg': -p{k}, 'ord': {k}, 'label': '{lab}', 'strong': s{k}, 'weak': w{k}}}" for k, lab in enumerate(spec.labels)) + "])"
    shaky = f"(lead.label = '{spec.guarded}' AND NOT anchored AND lead.strong = 0)"
    return rf"""WITH a AS (SELECT doc_id, lang, {text} AS text_for_cls, {norm} FROM {items}),
b AS (SELECT *, {NORM.format("text_for_cls")} AS nf, {toks} FROM a),
c AS (SELECT *, {split.format("nf")} AS tf FROM b),
e AS (SELECT *, len({_hits_sql("nf", "tf", spec.anchors)}) > 0 AS anchored, list_sort({_hits_sql("nf", "tf", spec.reject_terms)}) AS rejects, {", ".join(hits)} FROM c),
f AS (SELECT *, {", ".join(sums)}, {", ".join(raw)} FROM e),
h AS (SELECT *, {", ".join(points)}, {" + ".join(f"s{k}" for k in range(n))} AS strong, {" + ".join(f"w{k}" for k in range(n))} AS weak FROM f),
i AS (SELECT *, {ranked} AS ranked FROM h),
j AS (SELECT *, ranked[1] AS lead, -ranked[1].neg AS top, -ranked[2].neg AS second FROM i),
l AS (SELECT *, top - second AS margin, list_transform(list_filter(ranked, lambda r: -r.neg >= greatest({spec.screen_score}, top - 2)), lambda r: r.label) AS cands FROM j),
m AS (SELECT *, CASE WHEN len(rejects) > 0 AND top < {spec.reject_below} THEN 'hard_reject_terms=' || array_to_string(rejects[1:6], ',') WHEN top < {spec.screen_score} THEN 'insufficient_top_score'
  WHEN strong < {spec.screen_strong} AND strong + weak < {spec.screen_total} THEN 'insufficient_evidence' WHEN len(cands) > {spec.max_candidates} THEN 'too_many_candidate_labels'
  WHEN {shaky} AND top < {spec.guard_below} THEN 'weak_portrait_only' ELSE '' END AS reason FROM l),
s AS (SELECT *, reason = '' AND top >= {spec.direct_score} AND margin >= {spec.direct_margin} AND (lead.strong >= 1 OR (lead.label <> '{spec.guarded}' AND lead.weak >= 3)) AND NOT {shaky} AS direct FROM m),
scored AS (SELECT doc_id, lang, text_for_cls, lead.label AS rule_top1_label, CAST(top AS BIGINT) AS rule_top1_score, CAST(second AS BIGINT) AS rule_top2_score, CAST(margin AS BIGINT) AS rule_margin, array_to_string(cands, ',') AS candidates,
  CAST(strong AS BIGINT) AS rule_positive_strong_hits, CAST(weak AS BIGINT) AS rule_positive_weak_hits, reason = '' AS rule_gate_pass, reason AS rule_reject_reason, reason = '' AND NOT direct AS needs_llm,
  CASE WHEN direct THEN lead.label END AS category, CASE WHEN direct THEN round(least(0.98, CAST(0.58 AS DOUBLE) + top * CAST({spec.per_point} AS DOUBLE) + margin * CAST(0.02 AS DOUBLE) + lead.strong * CAST(0.03 AS DOUBLE)), 3) END AS category_confidence,
  CASE WHEN direct THEN 'rule' END AS category_source, {", ".join(f'CAST(p{k} AS BIGINT) AS "score_{lab}"' for k, lab in enumerate(spec.labels))}, rejects FROM s)
"""


SCORED = lexicon_sql()


def _scored(spark, d):
    x = lexicon.score_lexicon(table(spark, d, "documents"), LANGUAGES)
    points = F.from_json("rule_scores_json", ", ".join(f"{lab} bigint" for lab in LANGUAGES.labels))
    x = x.withColumn("candidates", F.array_join(F.from_json("rule_candidate_labels_json", "array<string>"), ",")).withColumn("__p", points)
    return x.withColumns({f"score_{lab}": F.col(f"__p.{lab}") for lab in LANGUAGES.labels}).drop("__p")


@query(SCORED + "SELECT doc_id, score_en, score_de, score_fr, score_es, rule_positive_strong_hits, rule_positive_weak_hits FROM scored")
def lexicon_score(spark, d):
    return _scored(spark, d).select("doc_id", "score_en", "score_de", "score_fr", "score_es", "rule_positive_strong_hits", "rule_positive_weak_hits")


@query(SCORED + "SELECT doc_id, rule_top1_label, rule_top1_score, rule_top2_score, rule_margin, candidates FROM scored")
def lexicon_rank_margin(spark, d):
    return _scored(spark, d).select("doc_id", "rule_top1_label", "rule_top1_score", "rule_top2_score", "rule_margin", "candidates")


@query(SCORED + "SELECT doc_id, rule_gate_pass, rule_reject_reason FROM scored")
def lexicon_gate(spark, d):
    return _scored(spark, d).select("doc_id", "rule_gate_pass", "rule_reject_reason")


@query(SCORED + "SELECT doc_id, needs_llm, category, category_confidence, category_source FROM scored")
def lexicon_direct(spark, d):
    return _scored(spark, d).select("doc_id", "needs_llm", "category", "category_confidence", "category_source")


@query(SCORED + "SELECT rule_top1_label AS label, CASE WHEN NOT rule_gate_pass THEN 'rejected' WHEN needs_llm THEN 'need_llm' ELSE 'direct' END AS route, count(*) AS count FROM scored WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1) GROUP BY ALL")
def lexicon_route_counts(spark, d):
    """Exclusion, scoring and routing end to end."""
    items = dedupe.exclude_by_keys(table(spark, d, "documents"), _toxic(spark, d), "doc_id")
    routes = lexicon.route(lexicon.score_lexicon(items, LANGUAGES))
    parts = [df.select(F.col("rule_top1_label").alias("label"), F.lit(name).alias("route")) for name, df in routes.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).groupBy("label", "route").agg(F.count("*").alias("count"))


@query(SCORED + "SELECT doc_id, array_to_string(rejects, ',') AS hits FROM scored WHERE len(rejects) > 0")
def hard_reject_hits(spark, d):
    x = lexicon.lexicon_hits(table(spark, d, "documents"), LANGUAGES)
    x = x.withColumn("hits", F.array_join(T.term_hits(F.col("__full"), F.col("__words"), LANGUAGES.reject_terms), ","))
    return x.where("hits <> ''").select("doc_id", "hits")


LOCAL = ("token", "art", "map", "idiot", "render")


@query(f"""WITH t AS (SELECT page_id, left({STRIP.format("coalesce(url, '')")}, 600) AS x FROM pages), h AS (SELECT *, list_filter({_q(sorted(LOCAL))}, lambda t: contains(lower(x), t)) AS hits FROM t)
SELECT page_id, CASE WHEN length(x) < 40 THEN 'metadata_too_short' WHEN len(hits) > 0 THEN 'local_reject_terms=' || array_to_string(hits[1:6], ',') END AS local_reject_reason FROM h""")
def local_reject(spark, d):
    return lexicon.local_reject(table(spark, d, "pages"), "url", LOCAL, min_chars=40).select("page_id", "local_reject_reason")


# --- keys and ledgers


@query("SELECT conv_id, turn, role, text FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS r FROM conversations) WHERE r = 1")
def latest_per_key(spark, d):
    return dedupe.latest_per_key(table(spark, d, "conversations"), "conv_id", "turn").select("conv_id", "turn", "role", "text")


@query("SELECT conv_id, turn, role, text FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS r FROM conversations) WHERE r = 1")
def first_per_key(spark, d):
    return dedupe.first_per_key(table(spark, d, "conversations"), "conv_id", "turn").select("conv_id", "turn", "role", "text")


@query("SELECT d.doc_id, n_chars FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)")
def resume_pending(spark, d):
    return dedupe.pending(table(spark, d, "documents"), table(spark, d, "labels"), "doc_id").select("doc_id", "n_chars")


@query("SELECT d.doc_id, n_chars FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND quality = 1)")
def resume_retry_failed(spark, d):
    done = table(spark, d, "labels").withColumn("ok", F.col("quality") == 1)
    return dedupe.pending(table(spark, d, "documents"), done, "doc_id", ok="ok").select("doc_id", "n_chars")


# --- merging decisions

RESULTS = "SELECT doc_id, CASE WHEN toxic = 1 THEN NULL WHEN quality = 1 THEN (['en', 'de', 'fr', 'es', 'it'])[doc_id % 5 + 1] ELSE ' ' END AS llm_label, (doc_id % 11) / 10.0::DOUBLE AS llm_confidence, toxic = 1 AS llm_ok FROM labels"
RULE = "SELECT doc_id, lang AS rule_top1_label, doc_id % 3 <> 0 AS needs_llm, CASE WHEN doc_id % 3 = 0 AND doc_id % 7 <> 0 THEN lang END AS category, CASE WHEN doc_id % 3 = 0 THEN (doc_id % 13) / 12.0::DOUBLE END AS category_confidence, CASE WHEN doc_id % 3 = 0 THEN 'rule' END AS category_source, n_chars, source FROM documents"
TEST_THRESHOLDS = {"en": (0.80, 0.60), "de": (0.70, 0.50), "fr": (0.98, 0.90)}
TEST_CLASSES = ("en", "de", "fr", "es")


def _decisions(spark, d):
    x, y = table(spark, d, "documents"), table(spark, d, "labels")
    i, third = F.col("doc_id"), F.col("doc_id") % 3 == 0
    rule = x.select("doc_id", F.col("lang").alias("rule_top1_label"), (~third).alias("needs_llm"), F.when(third & (i % 7 != 0), F.col("lang")).alias("category"), F.when(third, (i % 13) / F.lit(12.0)).alias("category_confidence"), F.when(third, "rule").alias("category_source"), "n_chars", "source")
    label = F.when(F.col("toxic") == 1, None).when(F.col("quality") == 1, F.element_at(F.array(*map(F.lit, ("en", "de", "fr", "es", "it"))), (i % 5 + 1).cast("int"))).otherwise(" ")
    results = y.select("doc_id", label.alias("llm_label"), ((i % 11) / F.lit(10.0)).alias("llm_confidence"), (F.col("toxic") == 1).alias("llm_ok"), F.lit(1).alias("seq"))
    return rule, results


def merged_sql(preset):
    label = "nullif(trim(m.llm_label), '')" if preset == "quota" else "m.llm_label"
    conf = lambda which: "CASE category " + " ".join(f"WHEN '{k}' THEN {v[which]}::DOUBLE" for k, v in TEST_THRESHOLDS.items()) + f" ELSE {(0.70, 0.75)[which]}::DOUBLE END"
    return f"""WITH m AS (SELECT r.*, l.llm_label, l.llm_confidence, l.llm_ok FROM ({RULE}) r LEFT JOIN ({RESULTS}) l USING (doc_id)),
n AS (SELECT doc_id, n_chars, source, llm_confidence, needs_llm AND llm_label IS NULL AND coalesce(llm_ok, false) AS llm_rejected, CASE WHEN needs_llm THEN coalesce({label.replace('m.', '')}, rule_top1_label) ELSE category END AS category,
  CASE WHEN needs_llm AND {label.replace('m.', '')} IS NOT NULL THEN llm_confidence WHEN needs_llm THEN 0.2 ELSE category_confidence END AS category_confidence,
  CASE WHEN needs_llm AND {label.replace('m.', '')} IS NOT NULL THEN 'llm' WHEN needs_llm THEN 'fallback_rule' ELSE category_source END AS category_source FROM m),
o AS (SELECT *, {conf(0)} AS rule_min, {conf(1)} AS llm_min, coalesce(category_confidence, 0) AS cc, coalesce(llm_confidence, 0) AS lc FROM n),
merged AS (SELECT *, CASE category_source WHEN 'rule' THEN rule_min WHEN 'llm' THEN llm_min WHEN 'fallback_rule' THEN 1.0 ELSE 0.70::DOUBLE END AS least_conf FROM o)
"""


BASIC, MIN_CONF_SQL, THRESHOLDS_SQL, QUOTA = (merged_sql(p) for p in merge.PRESETS)


def _merged(spark, d, preset):
    rule, results = _decisions(spark, d)
    return merge.merge_decisions(rule, results, preset, on="doc_id", thresholds=TEST_THRESHOLDS, classes=TEST_CLASSES)


@query(BASIC + "SELECT doc_id, category, category_confidence, category_source, llm_rejected, cc < 0.7 AS review_flag FROM merged")
def merge_basic(spark, d):
    return _merged(spark, d, "basic").select("doc_id", "category", "category_confidence", "category_source", "llm_rejected", "review_flag")


@query(MIN_CONF_SQL + """SELECT doc_id, category, category_source, CASE WHEN category_source = 'rule' AND cc < 0.7 THEN 'low_rule_confidence' WHEN category_source = 'llm' AND lc < 0.5 THEN 'low_llm_confidence' WHEN category_source = 'fallback_rule' THEN 'fallback_rule'
  WHEN category IS NULL THEN 'missing_category' END AS reject_reason, category IS NOT NULL AND cc >= 0.7 AND category_source IN ('rule', 'llm') AS kept FROM merged""")
def merge_min_conf(spark, d):
    return _merged(spark, d, "min_conf").select("doc_id", "category", "category_source", "reject_reason", "kept")


REASON = "CASE WHEN category_source = 'rule' AND cc < rule_min THEN 'low_rule_confidence' WHEN category_source = 'llm' AND lc < llm_min THEN 'low_llm_confidence' WHEN category_source = 'fallback_rule' THEN 'fallback_rule' WHEN category IS NULL THEN 'missing_category' END"


@query(THRESHOLDS_SQL + f"SELECT doc_id, category, category_source, least_conf AS effective_min_conf_threshold, cc < least_conf AS review_flag, {REASON} AS reject_reason, category IS NOT NULL AND category_source IN ('rule', 'llm') AND cc >= least_conf AS kept FROM merged")
def merge_thresholds(spark, d):
    return _merged(spark, d, "thresholds").select("doc_id", "category", "category_source", "effective_min_conf_threshold", "review_flag", "reject_reason", "kept")


@query(THRESHOLDS_SQL + f"SELECT category, category_source, {REASON} AS reject_reason, count(*) AS count FROM merged GROUP BY ALL")
def merge_stats(spark, d):
    return merge.group_counts(_merged(spark, d, "thresholds"), "category", "category_source", "reject_reason")


ELIGIBLE = "category_source IN ('rule', 'llm') AND category IS NOT NULL AND category IN ('en', 'de', 'fr', 'es') AND NOT (category_source = 'rule' AND cc < rule_min) AND NOT (category_source = 'llm' AND lc < llm_min)"


@query(QUOTA + f"SELECT doc_id, category, category_source, coalesce({ELIGIBLE}, false) AS eligible, coalesce({REASON}, CASE WHEN category NOT IN ('en', 'de', 'fr', 'es') THEN 'non_target_category' END) AS reject_reason, CASE WHEN category_source = 'llm' THEN 1 ELSE 0 END AS source_priority, CASE WHEN category_source = 'llm' THEN llm_confidence ELSE category_confidence END AS effective_confidence FROM merged")
def eligibility(spark, d):
    return _merged(spark, d, "quota").select("doc_id", "category", "category_source", "eligible", "reject_reason", "source_priority", "effective_confidence")


@query(QUOTA + f"""SELECT doc_id, category, rn AS rank_in_selected_category FROM (SELECT *, row_number() OVER (PARTITION BY category ORDER BY CASE WHEN category_source = 'llm' THEN 1 ELSE 0 END DESC, CASE WHEN category_source = 'llm' THEN llm_confidence ELSE category_confidence END DESC NULLS LAST, n_chars DESC, doc_id) AS rn FROM merged WHERE {ELIGIBLE}) WHERE rn <= 25""")
def merge_quota_selected(spark, d):
    merged = _merged(spark, d, "quota").withColumn("zero", F.lit(0))
    return merge.selected_rows(merged, 25, classes=TEST_CLASSES, downloads="n_chars", views="zero", key="doc_id")[1].select("doc_id", "category", "rank_in_selected_category")


# --- quotas, samples

PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW", "6-NONE")
RANKED = "SELECT *, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice DESC NULLS LAST, o_orderkey) AS rn FROM orders"


def _quota(spark, d, k=400):
    order = select.priority_order("o_totalprice", key="o_orderkey")
    return select.select_quota(table(spark, d, "orders"), "o_orderpriority", k, order, _priorities(spark, d), "o_orderkey")


def _priorities(spark, d):
    """The classes of the test table and one that has no rows."""
    return [*(r[0] for r in table(spark, d, "orders").select("o_orderpriority").distinct().orderBy("o_orderpriority").collect()), "none"]


@query(f"SELECT o_orderkey, o_orderpriority, rn AS rank_in_selected_category, 'category_quota' AS selection_stage FROM ({RANKED}) WHERE rn <= 400")
def quota_select(spark, d):
    return _quota(spark, d)[0].select("o_orderkey", "o_orderpriority", "rank_in_selected_category", "selection_stage")


@query(f"SELECT o_orderkey, o_orderpriority, 'not_selected_by_category_quota' AS selection_stage FROM ({RANKED}) WHERE rn > 400")
def quota_leftover(spark, d):
    return _quota(spark, d)[1].select("o_orderkey", "o_orderpriority", "selection_stage")


@query("SELECT category, available, CAST(4000 AS BIGINT) AS target_quota, least(available, 4000) AS selected, CAST(greatest(4000 - available, 0) AS BIGINT) AS shortfall FROM (SELECT o_orderpriority AS category, count(*) AS available FROM orders GROUP BY 1 UNION ALL SELECT 'none', 0)")
def quota_plan(spark, d):
    return _quota(spark, d, 4000)[2]


SEGMENT_RANK = "SELECT *, row_number() OVER (PARTITION BY c_mktsegment ORDER BY md5(CAST(c_custkey AS VARCHAR) || ':20260325'), c_custkey) AS rn FROM customer"


def _sample(spark, d):
    x = table(spark, d, "customer")
    classes = [r[0] for r in x.select("c_mktsegment").distinct().orderBy("c_mktsegment").collect()]
    return select.stratified_sample(x, "c_mktsegment", 200, 20260325, classes, key="c_custkey")


@query(f"SELECT c_custkey, c_mktsegment AS sample_category, CAST(200 AS BIGINT) AS sample_quota, CAST(20260325 AS BIGINT) AS sample_random_seed FROM ({SEGMENT_RANK}) WHERE rn <= 200")
def stratified_sample(spark, d):
    return _sample(spark, d)[0].select("c_custkey", "sample_category", "sample_quota", "sample_random_seed")


@query("SELECT c_mktsegment AS category, count(*) AS available, CAST(200 AS BIGINT) AS target_sample, least(count(*), 200) AS sampled, CAST(greatest(200 - count(*), 0) AS BIGINT) AS shortfall FROM customer GROUP BY 1")
def sample_plan(spark, d):
    return _sample(spark, d)[1]


def _by_priority(spark, d):
    return table(spark, d, "orders").orderBy(F.col("o_orderpriority").asc_nulls_last(), *select.priority_order("o_totalprice", key="o_orderkey")).select("o_orderkey", "o_orderpriority", "o_totalprice")


@query("SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders")
def priority_sort(spark, d):
    """All rows in order; a comparison of rows does not see it, a test does."""
    return _by_priority(spark, d)


@query("SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders ORDER BY o_orderpriority, o_totalprice DESC NULLS LAST, o_orderkey LIMIT 500")
def priority_top(spark, d):
    """A report of the first 500 rows of priority_sort."""
    return _by_priority(spark, d).limit(500)


# --- downloads, paths, names


def _downloads(spark, d):
    ids = F.col("doc_id")
    return table(spark, d, "labels").select(ids.alias("page_id"), (F.col("quality") == 1).alias("download_ok"), F.when(F.col("toxic") == 1, "timeout").alias("download_error"), (ids % 4).alias("download_attempts"), F.lit("ledger").alias("url"))


LEDGER = "SELECT doc_id AS page_id, quality = 1 AS download_ok, CASE WHEN toxic = 1 THEN 'timeout' END AS download_error, doc_id % 4 AS download_attempts, 'ledger' AS url FROM labels"
JOINED = f"SELECT p.page_id, p.url, coalesce(l.download_ok, false) AS download_ok, coalesce(l.download_error, '') AS download_error, coalesce(l.download_attempts, 0) AS download_attempts, l.url AS url_dl FROM pages p LEFT JOIN ({LEDGER}) l USING (page_id)"


def _ledgered(spark, d):
    return publish.ledger_join(table(spark, d, "pages").select("page_id", "url"), _downloads(spark, d), "page_id")


@query(JOINED)
def ledger_merge_defaults(spark, d):
    return _ledgered(spark, d)


@query(f"WITH j AS ({JOINED}) SELECT 'classified_final_total' AS metric, count(*) AS value FROM j UNION ALL SELECT 'downloaded_ok', count(*) FROM j WHERE download_ok UNION ALL SELECT 'download_failed', count(*) FROM j WHERE NOT download_ok")
def download_stats(spark, d):
    return publish.status_stats(_ledgered(spark, d))


HOST = "regexp_extract(url, '//([^/]+)', 1)"


@query(f"SELECT regexp_extract(url, '[.](com|net|org)', 1) AS category, CASE WHEN download_ok THEN 'downloaded_ok' ELSE 'download_failed' END AS download_status, count(*) AS count FROM ({JOINED}) GROUP BY ALL")
def category_status_counts(spark, d):
    return publish.status_by_class(_ledgered(spark, d).withColumn("c", F.regexp_extract("url", "[.](com|net|org)", 1)), "c")


@query(f"SELECT page_id, url FROM ({JOINED}) WHERE NOT download_ok")
def download_failures(spark, d):
    return publish.split_status(_ledgered(spark, d))[1].select("page_id", "url")


@query(r"""SELECT page_id, coalesce(nullif(regexp_extract(split_part(lower(url), '?', 1), '([.](?:jpg|jpeg|png|webp))$', 1), ''), '.jpg') AS by_url,
CASE page_id % 4 WHEN 0 THEN '.png' WHEN 1 THEN '.jpg' ELSE coalesce(nullif(regexp_extract(split_part(lower(url), '?', 1), '([.](?:jpg|jpeg|png|webp))$', 1), ''), '.jpg') END AS by_mime FROM (SELECT page_id, url || CASE page_id % 5 WHEN 0 THEN '.JPEG' WHEN 1 THEN '.webp?w=1' ELSE '' END AS url FROM pages)""")
def url_ext(spark, d):
    x = table(spark, d, "pages").withColumn("url", F.concat("url", F.when(F.col("page_id") % 5 == 0, ".JPEG").when(F.col("page_id") % 5 == 1, ".webp?w=1").otherwise("")))
    mime = F.when(F.col("page_id") % 4 == 0, "image/png; q=1").when(F.col("page_id") % 4 == 1, "Image/JPEG").when(F.col("page_id") % 4 == 2, "")
    return x.select("page_id", T.ext_from_url(F.col("url")).alias("by_url"), T.ext_from_url(F.col("url"), mime).alias("by_mime"))


@query("SELECT p_partkey, 'raw/' || coalesce(nullif(lower(substr(p_brand, 1, 2)), ''), 'xx') || '/' || coalesce(nullif(lower(substr(p_brand, 3, 2)), ''), 'xx') || '/' || p_brand || '.jpg' AS path FROM (SELECT p_partkey, left(p_brand, CAST(p_partkey % 6 AS INT)) AS p_brand FROM part)")
def shard_path(spark, d):
    x = table(spark, d, "part").withColumn("p_brand", F.expr("left(p_brand, cast(p_partkey % 6 as int))"))
    return x.select("p_partkey", T.shard_path(F.col("p_brand"), F.lit(".jpg")).alias("path"))


@query(r"""SELECT page_id, coalesce(nullif(trim(regexp_replace(regexp_replace(trim(u), '[\\/:*?"<>|]+', '_', 'g'), '\s+', ' ', 'g')), ''), 'unknown') AS runs, coalesce(nullif(trim(regexp_replace(trim(u), '[\\/:*?"<>|]', '_', 'g')), ''), 'unknown') AS each_char, translate(u, '/\', '__') AS slashes
FROM (SELECT page_id, CASE WHEN page_id % 10 = 0 THEN '  ' ELSE url || ' a  b' END AS u FROM pages)""")
def safe_name(spark, d):
    x = table(spark, d, "pages").withColumn("u", F.when(F.col("page_id") % 10 == 0, "  ").otherwise(F.concat("url", F.lit(" a  b"))))
    return x.select("page_id", T.safe_name(F.col("u")).alias("runs"), T.safe_name(F.col("u"), "each").alias("each_char"), T.safe_name(F.col("u"), "slashes").alias("slashes"))


@query("SELECT doc_id, CASE WHEN n < 1024 THEN printf('%.2f B', n) WHEN n < 1048576 THEN printf('%.2f KB', n / 1024) ELSE printf('%.2f MB', n / 1048576) END AS size FROM (SELECT doc_id, CAST(n_chars AS DOUBLE) * 128 AS n FROM documents)")
def human_size(spark, d):
    return table(spark, d, "documents").select("doc_id", T.human_size(F.col("n_chars").cast("double") * 128).alias("size"))


@query("SELECT lang AS category, CAST(doc_id AS VARCHAR) AS id FROM documents WHERE lang = 'de'")
def ids_by_category(spark, d):
    return writers.ids_by_class(table(spark, d, "documents"), "lang", "de", "doc_id", distinct=True, ordered=True)


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, '{\"k\":' || json_extract_string(props, '$.k') || '}' AS again, CASE WHEN event_id % 5 = 0 THEN 'broken' END AS raw FROM events")
def json_fields(spark, d):
    x = table(spark, d, "events").withColumn("p", F.from_json("props", "k bigint"))
    broken = T.parsed_or_raw(F.when(F.col("event_id") % 5 == 0, "broken").otherwise(F.col("props")), "k bigint")
    return x.select("event_id", "p.k", F.to_json("p").alias("again"), F.when(F.col("event_id") % 5 == 0, broken["raw"]).alias("raw"))


# --- scores and review


@query("SELECT doc_id, n_chars FROM documents WHERE n_chars >= (SELECT round(quantile_cont(n_chars, 0.3), 9) FROM documents)")
def quantile_pass(spark, d):
    return score.quantile_keep(table(spark, d, "documents"), "n_chars", 0.3).select("doc_id", "n_chars")


WEIGHTS = [((7 * i) % 11 - 5) / 10 for i in range(64)]


@query(f"SELECT vec_id, round(list_dot_product(CAST(embedding AS DOUBLE[]), {WEIGHTS}::DOUBLE[]) / sqrt(list_dot_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[]))) + 0.25, 6) AS aesthetic_score, true AS aesthetic_ok FROM embeddings")
def vector_score(spark, d):
    return score.vector_score(table(spark, d, "embeddings"), "embedding", WEIGHTS, 0.25).select("vec_id", F.round("aesthetic_score", 6).alias("aesthetic_score"), "aesthetic_ok")


def _probs(spark, d):
    """Vectors with logits against the mean vector of each label; as many prompts as there are labels."""
    x = table(spark, d, "embeddings")
    means = x.select("label", F.posexplode("embedding").alias("i", "v")).groupBy("label", "i").agg(F.avg(F.col("v").cast("double")).alias("v"))
    means = means.groupBy("label").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "v"))), lambda r: r["v"]).alias("v")).orderBy("label")
    prompts = {f"l{r.label}": r.v for r in means.collect()}
    return score.class_probs(x.withColumn("category", F.concat(F.lit("l"), F.col("label"))), "embedding", prompts)


PROBS = """WITH v AS (SELECT vec_id, 'l' || label AS category, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
m AS (SELECT category AS label, list(a ORDER BY i) AS p FROM (SELECT category, i, avg(x) AS a FROM (SELECT category, unnest(e) AS x, generate_subscripts(e, 1) AS i FROM v) GROUP BY ALL) GROUP BY 1),
z AS (SELECT vec_id, category, label, row_number() OVER (PARTITION BY vec_id ORDER BY label) AS ord, 100 * list_dot_product(e, p) / sqrt(list_dot_product(e, e)) AS z FROM v, m),
s AS (SELECT *, exp(z - max(z) OVER (PARTITION BY vec_id)) AS x FROM z),
q AS (SELECT *, x / sum(x) OVER (PARTITION BY vec_id) AS s FROM s),
r AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY s DESC, ord) AS rn FROM q),
t AS (SELECT vec_id, any_value(category) AS category, any_value(label) FILTER (WHERE rn = 1) AS l1, any_value(label) FILTER (WHERE rn = 2) AS l2, round(any_value(s) FILTER (WHERE rn = 1), 6) AS s1, round(any_value(s) FILTER (WHERE rn = 2), 6) AS s2,
  round(any_value(s) FILTER (WHERE rn = 1) - any_value(s) FILTER (WHERE rn = 2), 6) AS margin FROM r GROUP BY vec_id),
r1 AS (SELECT *, CASE WHEN l1 = category AND s1 >= 0.55 AND margin >= 0.15 THEN 'keep' WHEN l1 <> category AND s1 >= 0.6 AND margin >= 0.2 THEN 'relabel' ELSE 'review' END AS review_action FROM t)
"""


@query(PROBS + "SELECT vec_id, l1 AS top1_label, l2 AS top2_label, s1 AS top1_score, s2 AS top2_score, margin FROM t")
def softmax_top2(spark, d):
    return _probs(spark, d).select("vec_id", score.top_two(F.col("labels"), F.col("logits"), 6).alias("t")).select("vec_id", "t.*")


def _round1(spark, d):
    return score.review(_probs(spark, d), digits=6)


@query(PROBS + "SELECT vec_id, review_action, CASE review_action WHEN 'keep' THEN category WHEN 'relabel' THEN l1 END AS review1_final_label FROM r1")
def review_round1(spark, d):
    return _round1(spark, d).select("vec_id", "review_action", "review1_final_label")


ROUND2 = PROBS + """, c AS (SELECT vec_id, category, list_distinct([category, l1, l2]) AS c FROM r1 WHERE review_action = 'review'),
z2 AS (SELECT q.vec_id, q.category, q.label, CASE WHEN q.label = q.category THEN 0 ELSE 1 END AS first_, q.s AS s_all, q.z FROM q JOIN c ON c.vec_id = q.vec_id AND list_contains(c.c, q.label)),
s2 AS (SELECT *, exp(z - max(z) OVER (PARTITION BY vec_id)) AS x FROM z2), q2 AS (SELECT *, x / sum(x) OVER (PARTITION BY vec_id) AS s FROM s2),
k2 AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY s DESC, first_) AS rn FROM q2),
t2 AS (SELECT vec_id, any_value(category) AS category, any_value(label) FILTER (WHERE rn = 1) AS l1, round(any_value(s) FILTER (WHERE rn = 1), 6) AS s1, round(any_value(s) FILTER (WHERE rn = 1) - coalesce(any_value(s) FILTER (WHERE rn = 2), 0), 6) AS margin FROM k2 GROUP BY vec_id),
r2 AS (SELECT *, CASE WHEN l1 = category AND s1 >= 0.56 AND margin >= 0.10 THEN 'keep_old' WHEN l1 <> category AND s1 >= 0.60 AND margin >= 0.12 THEN 'relabel_top1' WHEN s1 <= 0.45 AND margin <= 0.05 THEN 'drop' ELSE 'still_review' END AS review2_action FROM t2),
final AS (SELECT vec_id, CASE review_action WHEN 'keep' THEN category ELSE l1 END AS final_label, 'review_' || review_action || '_round1' AS final_source FROM r1 WHERE review_action IN ('keep', 'relabel')
  UNION ALL SELECT vec_id, CASE review2_action WHEN 'keep_old' THEN category ELSE l1 END, CASE review2_action WHEN 'keep_old' THEN 'review_keep_round2' ELSE 'review_relabel_round2' END FROM r2 WHERE review2_action IN ('keep_old', 'relabel_top1'))
"""


@query(ROUND2 + "SELECT vec_id, s1 AS review2_top1_score, margin AS review2_margin, review2_action, CASE review2_action WHEN 'keep_old' THEN category WHEN 'relabel_top1' THEN l1 END AS review2_final_label FROM r2")
def review_round2(spark, d):
    return score.review_again(_round1(spark, d), digits=6).select("vec_id", "review2_top1_score", "review2_margin", "review2_action", "review2_final_label")


def _final(spark, d):
    first = _round1(spark, d)
    return score.finalize(first, score.review_again(first, digits=6), "vec_id")


@query(ROUND2 + "SELECT * FROM final")
def review_final(spark, d):
    return _final(spark, d)[0].select("vec_id", "final_label", "final_source")


@query(ROUND2 + "SELECT vec_id, review2_action FROM r2 WHERE review2_action NOT IN ('keep_old', 'relabel_top1')")
def review_remaining(spark, d):
    return _final(spark, d)[1].select("vec_id", "review2_action")


@query(ROUND2 + "SELECT final_label, final_source, count(*) AS count FROM final GROUP BY ALL")
def final_stats(spark, d):
    x = _final(spark, d)[0].withColumns({"final_image_ok": F.lit(True), "final_image_relpath": F.lit("x"), "item_id": F.col("vec_id")})
    return publish.final_manifest(x, ["item_id"])["stats"]


@query(ROUND2 + "SELECT final_label, CAST(vec_id AS VARCHAR) AS item_id, final_source, 'images/' || final_label || '/' || vec_id || '.jpg' AS final_image_relpath FROM final")
def final_manifest_cols(spark, d):
    x = _final(spark, d)[0].select(F.col("vec_id").cast("string").alias("item_id"), "final_label", "final_source", "review_action")
    x = x.withColumns({"final_image_relpath": F.concat_ws("/", F.lit("images"), T.safe_name(F.col("final_label"), "slashes"), F.concat("item_id", F.lit(".jpg"))), "final_image_ok": F.lit(True)})
    return preferred_first(publish.final_manifest(x, ["item_id"])["metadata"], "final_label")


@query("SELECT doc_id, coalesce(toxic, -1) AS toxic, CAST(NULL AS VARCHAR) AS note FROM documents LEFT JOIN labels USING (doc_id)")
def missing_columns(spark, d):
    from pyspark.sql.types import StructType

    x = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id", "left")
    return with_missing_columns(x, StructType.fromDDL("note string"), {"toxic": -1}).select("doc_id", "toxic", "note")


# --- external calls and resumption

STUB = """SELECT CAST(doc_id AS VARCHAR) AS item_id, CASE WHEN doc_id % 17 = 3 THEN NULL ELSE lang END AS llm_label, CASE WHEN doc_id % 17 = 3 THEN 0.0 ELSE round(least(1.0, doc_id % 13 / 10.0), 3) END AS llm_confidence, doc_id % 17 <> 3 AS llm_ok FROM documents"""


class StubClassifier:
    """Stands in for a model: fails on any batch with a poisoned item."""

    def classify(self, items):
        if any(int(x["item_id"]) % 17 == 3 for x in items):
            raise ConnectionError("no answer")
        return [{"item_id": x["item_id"], "label": x["lang"], "confidence": int(x["item_id"]) % 13 / 10} for x in items]


def _classify(items: DataFrame) -> DataFrame:
    return external.classify_external(items, StubClassifier(), batch=16, policy=external.RetryPolicy(retries=2), labels=TEST_CLASSES, sleep=_no_pause)


def _no_pause(_):
    return None


@query(STUB)
def external_stub(spark, d):
    x = table(spark, d, "documents").select(F.col("doc_id").cast("string").alias("item_id"), "lang")
    return _classify(x).select("item_id", "llm_label", "llm_confidence", "llm_ok")


@query("""SELECT event_id, CASE WHEN event_type = 'error' THEN NULL WHEN event_type = 'view' THEN NULL ELSE '城市、建筑' END AS label, CASE WHEN event_type <> 'error' THEN round(least(1.0, event_id % 9 / 8.0), 3) END AS confidence, event_type NOT IN ('error', 'view') AS in_scope, CASE event_type WHEN 'view' THEN 'no' END AS reject_reason FROM events""")
def response_validation(spark, d):
    label = F.when(F.col("event_type") == "error", "zzz").when(F.col("event_type") == "view", external.REJECT_LABEL).otherwise("城市、建筑")
    raw = F.to_json(F.struct((F.col("event_type") != "view").alias("is_target"), label.alias("label"), (F.col("event_id") % 9 / 8).alias("confidence"), F.lit("no").alias("reason")))
    x = table(spark, d, "events").select("event_id", external.validate_response(raw).alias("v"))
    return x.select("event_id", "v.label", "v.confidence", "v.in_scope", "v.reject_reason")


@query(STUB)
def stream_resume(spark, d):
    """Two runs over a growing source: the second handles only what is new, and the result is that of one run."""
    base = writers.scratch(spark, "stream")
    items = table(spark, d, "documents").select(F.col("doc_id").cast("string").alias("item_id"), "lang")
    for k in (0, 1):
        items.where(F.pmod(F.xxhash64("item_id"), F.lit(2)) == k).write.mode("append").parquet(f"{base}/in")
        resume.run_incremental(spark, f"{base}/in", items.schema, _classify, f"{base}/out", f"{base}/checkpoint")
    return resume.latest_results(spark, f"{base}/out", _classify(items).schema).select("item_id", "llm_label", "llm_confidence", "llm_ok")


#: Columns of the test tables.
COLUMNS = {
    "region": "r_regionkey,r_name", "nation": "n_nationkey,n_name,n_regionkey", "customer": "c_custkey,c_name,c_nationkey,c_acctbal,c_mktsegment",
    "supplier": "s_suppkey,s_name,s_nationkey,s_acctbal", "part": "p_partkey,p_name,p_brand,p_type,p_size,p_retailprice",
    "orders": "o_orderkey,o_custkey,o_orderstatus,o_totalprice,o_orderdate,o_orderpriority", "events": "event_id,ts,user_id,event_type,value,props",
    "documents": "doc_id,text,lang,source,n_chars", "labels": "doc_id,quality,toxic", "pages": "page_id,url,html", "benchmark": "item_id,text", "conversations": "conv_id,turn,role,text",
}


@query(" UNION ALL ".join(f"SELECT '{t}.parquet' AS file, count(*) AS n_rows, {c.count(',') + 1} AS n_columns, '{c}' AS columns FROM {t}" for t, c in COLUMNS.items()))
def parquet_footers(spark, d):
    return readers.parquet_tables(spark, d).select("file", "n_rows", "n_columns", "columns").where(F.col("file").isin([f"{t}.parquet" for t in COLUMNS]))
