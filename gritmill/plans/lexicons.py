"""The two production lexicons over made-up items, held to the scoring in SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import lexicon
from .catalogue import _q, lexicon_sql, query, table

TERMS = sorted({t for spec in (lexicon.PLAIN, lexicon.ENRICHED) for pair in spec.vocabulary.values() for ts in pair for t in ts} | set(lexicon.REJECT_TERMS) | set(lexicon.ANCHORS))
#: (factor, offset) of the terms that a document's id picks for each field, and the ids (divisor) whose field is missing.
PICKS = {
    "photo_description": ([(7, 0), (13, 3), (29, 1)], 11), "ai_description": ([(5, 1), (7, 0), (13, 3)], 3), "photo_location_name": ([(11, 2)], 4), "ai_primary_landmark_name": ([(17, 5)], 5),
    "photo_location_city": ([(19, 4)], 2), "photo_location_country": ([(23, 8)], 7),
}
LISTS = {"keywords_user_joined": (31, 6), "keywords_highconf_joined": (7, 0), "keywords_joined": (41, 9), "conv_keywords_joined": (43, 2)}


def _sql() -> str:
    term = lambda k, o: f"({_q(TERMS)})[(doc_id * {k} + {o}) % {len(TERMS)} + 1]"
    cells = [f"CASE WHEN doc_id % {gap} <> 0 THEN 'a ' || {' || chr(44) || chr(32) || '.join(term(*p) for p in picks)} END AS {name}" for name, (picks, gap) in PICKS.items()]
    lists = [f"[{term(k, o)}, {term(k, o + 10)}] AS {name}" for name, (k, o) in LISTS.items()]
    unique = lambda c: f"CASE WHEN {c}[1] = {c}[2] THEN {c}[1:1] ELSE {c} END"
    return f"""(SELECT *, array_to_string(u, ' | ') AS keywords_user, array_to_string(list_filter(h, lambda x: NOT list_contains(u, x)), ' | ') AS keywords_highconf,
  array_to_string(list_filter(e, lambda x: NOT list_contains(u, x) AND NOT list_contains(h, x)), ' | ') AS keywords_all, array_to_string(c, ' | ') AS conv_keywords
FROM (SELECT *, {unique('keywords_user_joined')} AS u, {unique('keywords_highconf_joined')} AS h, {unique('keywords_joined')} AS e, {unique('conv_keywords_joined')} AS c FROM (SELECT doc_id, lang, {', '.join(cells + lists)} FROM documents)))"""


def items(spark, d):
    terms = F.array(*map(F.lit, TERMS))
    term = lambda k, o: F.get(terms, ((F.col("doc_id") * k + o) % len(TERMS)).cast("int"))
    x = table(spark, d, "documents").select("doc_id")
    cells = {name: F.when(F.col("doc_id") % gap != 0, F.concat(F.lit("a "), F.concat_ws(", ", *(term(*p) for p in picks)))) for name, (picks, gap) in PICKS.items()}
    lists = {name: F.concat_ws("|", term(k, o), term(k, o + 10)) for name, (k, o) in LISTS.items()}
    return x.withColumns({**cells, **lists})


OUT = "doc_id, rule_top1_label, rule_top1_score, rule_top2_score, rule_margin, rule_positive_strong_hits, rule_positive_weak_hits, rule_gate_pass, rule_reject_reason, needs_llm, category, category_confidence, category_source"


@query(lexicon_sql(lexicon.PLAIN, _sql()) + f"SELECT {OUT} FROM scored")
def lexicon_plain(spark, d):
    return lexicon.score_lexicon(items(spark, d), lexicon.PLAIN).select(*OUT.split(", "))


@query(lexicon_sql(lexicon.ENRICHED, _sql()) + f"SELECT {OUT} FROM scored")
def lexicon_enriched(spark, d):
    return lexicon.score_lexicon(items(spark, d), lexicon.ENRICHED).select(*OUT.split(", "))
