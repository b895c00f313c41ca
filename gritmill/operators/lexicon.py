"""Scoring items against weighted lexicons, gates, direct decisions, routing.

Each field is tokenised once; a term hits a field at most once. Scores are sums
of integer points, so that nothing depends on the order of evaluation.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import assemble_text, exclusive_groups, join_list, norm_text, py_strip, round_half_even, safe, split_terms, substring_hits, term_hits, tokens
from ..schemas import CITY, INDOOR, LABELS, NATURE, PORTRAIT, STILL

# Terms by label, strong and weak.
BASE_VOCABULARY = {
    PORTRAIT: (
        ("portrait", "selfie", "headshot", "face", "close up face", "close-up face", "profile portrait", "bride", "groom"),
        ("person", "people", "human", "woman", "man", "girl", "boy", "child", "baby", "couple", "family", "male", "female"),
    ),
    INDOOR: (
        ("interior", "indoor", "bedroom", "living room", "kitchen", "bathroom", "office", "library", "hotel room", "apartment", "hallway", "classroom", "indoor room"),
        ("room", "indoors"),
    ),
    CITY: (
        ("architecture", "skyline", "skyscraper", "building exterior", "street scene", "city street", "urban landscape", "bridge", "tower", "cathedral", "temple", "facade"),
        ("urban", "building", "downtown", "road", "station", "landmark"),
    ),
    NATURE: (
        ("landscape", "mountain", "waterfall", "forest", "beach", "ocean", "sea", "river", "lake", "sunset", "sunrise", "wildlife"),
        ("nature", "tree", "flower", "plant", "animal", "bird", "dog", "cat", "horse", "snow", "desert", "valley", "grass"),
    ),
    STILL: (
        ("still life", "product photo", "food photography", "tabletop", "product shot"),
        ("food", "drink", "coffee", "tea", "fruit", "camera", "phone", "laptop", "watch", "bottle", "cup", "plate", "product", "object", "book"),
    ),
}
MORE_WEAK = {CITY: ("cityscape", "street"), NATURE: ("woodland", "park", "grove"), STILL: ("dessert", "meal")}
PROMOTED = ("food", "drink", "coffee", "tea", "fruit")
REJECT_TERMS = (
    "art", "artwork", "painting", "illustration", "drawing", "sculpture", "mural", "graffiti", "sketch", "cartoon", "anime", "poster", "collage",
    "calligraphy", "watercolor", "oil painting", "installation", "graphic", "logo", "icon", "typography", "screenshot", "diagram", "map", "document",
    "flyer", "menu", "brochure", "handwriting", "pattern", "texture", "wallpaper", "abstract", "render", "rendering", "cgi", "3d render",
)
ANCHORS = ("portrait", "selfie", "headshot", "face", "close up face", "close-up face")
LOCAL_REJECT_TERMS = (
    "illustration", "painting", "drawing", "poster", "logo", "graphic", "diagram", "map", "screenshot", "menu", "brochure",
    "abstract", "pattern", "texture", "render", "rendering", "cgi", "3d render", "wallpaper",
)


@dataclass(frozen=True)
class LexiconSpec:
    """vocabulary: label to (strong, weak) terms. fields: column, points of a strong hit, of a weak one.

    guarded is the label that weak hits alone must not win: without an anchor
    in the text and without a strong hit it loses points.
    """

    labels: tuple[str, ...]
    vocabulary: dict
    fields: tuple[tuple[str, int, int], ...]
    text_fields: tuple[tuple[str, str], ...]
    reject_terms: tuple[str, ...] = ()
    anchors: tuple[str, ...] = ()
    guarded: str | None = None
    direct_score: int = 8
    direct_margin: int = 4
    screen_score: int = 3
    screen_strong: int = 1
    screen_total: int = 2
    max_candidates: int = 3
    reject_below: int = 8
    guard_below: int = 5
    per_point: float = 0.035
    text_chars: int = 1800
    grouped_keywords: bool = field(default=False)


_TEXT = (("photo_description", "photo_description"), ("ai_description", "ai_description"))
_PLACE = (("location_name", "photo_location_name"), ("location_city", "photo_location_city"), ("location_country", "photo_location_country"), ("landmark", "ai_primary_landmark_name"))
_KEYWORDS = tuple((k, k) for k in ("keywords_user", "keywords_highconf", "keywords_all", "conv_keywords"))

PLAIN = LexiconSpec(
    LABELS, BASE_VOCABULARY,
    (("photo_description", 4, 1), ("ai_description", 4, 1), ("photo_location_name", 2, 0), ("ai_primary_landmark_name", 3, 1)),
    _TEXT + _PLACE, REJECT_TERMS, ANCHORS, PORTRAIT,
)


def _enriched_vocabulary() -> dict:
    out = {}
    for label, (strong, weak) in BASE_VOCABULARY.items():
        weak = weak + MORE_WEAK.get(label, ())
        raised = tuple(t for t in weak if t in PROMOTED)
        out[label] = (strong + raised, tuple(t for t in weak if t not in raised))
    return out


ENRICHED = LexiconSpec(
    LABELS, _enriched_vocabulary(),
    (("photo_description", 4, 1), ("ai_description", 4, 1), ("keywords_user", 5, 1), ("keywords_highconf", 5, 1), ("keywords_all", 3, 1),
     ("photo_location_name", 2, 0), ("ai_primary_landmark_name", 2, 1), ("conv_keywords", 1, 0)),
    _TEXT + _KEYWORDS + _PLACE, REJECT_TERMS, ANCHORS, PORTRAIT,
    direct_score=10, screen_score=4, reject_below=9, guard_below=6, per_point=0.03, grouped_keywords=True,
)
FIELD_NAMES = {"photo_location_name": "location_name", "ai_primary_landmark_name": "landmark", "keywords_user": "keywords_user_joined", "keywords_highconf": "keywords_highconf_joined", "keywords_all": "keywords_joined", "conv_keywords": "conv_keywords_joined"}


def _sum(columns) -> Column:
    return reduce(lambda a, b: a + b, columns)


def fence(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """withColumns that the optimiser does not merge with what comes after.

    Later expressions name these columns many times, and filters would be pushed
    below them with a copy of the whole chain for each mention.
    """
    made = df.select("*", F.explode(F.array(F.struct(*(c.alias(n) for n, c in columns.items())))).alias("__made"))
    return made.select(*(c for c in df.columns if c not in columns), *(F.col(f"__made.{n}").alias(n) for n in columns))


def lexicon_hits(items: DataFrame, spec: LexiconSpec) -> DataFrame:
    """items with text_for_cls, __full, __words (those of it that reject or anchor) and hits: per label and strength an array of (field, term)."""
    have = set(items.columns)
    source = {c: F.col(c) if c in have else F.lit(None).cast("string") for c in {c for _, c in spec.text_fields} | {f for f, _, _ in spec.fields}}
    if spec.grouped_keywords:
        raw = {c: F.col(c) if c in have else F.lit(None).cast("string") for c in ("keywords_user_joined", "keywords_highconf_joined", "keywords_joined", "conv_keywords_joined")}
        source |= {k: join_list(v) for k, v in exclusive_groups(*raw.values()).items()}
    rows = items.withColumn("text_for_cls", assemble_text([(name, source[c]) for name, c in spec.text_fields], spec.text_chars))
    rows = rows.withColumns({"__full": norm_text(F.col("text_for_cls")), **{f"__n{i}": norm_text(source[f]) for i, (f, _, _) in enumerate(spec.fields)}})
    rows = fence(rows, {"text_for_cls": F.col("text_for_cls"), "__full": F.col("__full"), **{f"__n{i}": F.col(f"__n{i}") for i in range(len(spec.fields))}})
    # Of each text's words only those that some list holds go on: one look at the long array, not one a label and strength.
    scored = _words_among(t for pair in spec.vocabulary.values() for ts in pair for t in ts)
    rows = rows.withColumns({"__words": F.array_intersect(tokens(F.col("__full")), _words_among((*spec.anchors, *spec.reject_terms))), **{f"__t{i}": F.array_intersect(tokens(F.col(f"__n{i}")), scored) for i in range(len(spec.fields))}})
    rows = fence(rows, {c: F.col(c) for c in ("__words", *(f"__t{i}" for i in range(len(spec.fields))))})
    hits = {}
    for k, label in enumerate(spec.labels):
        for strength, terms in zip("sw", spec.vocabulary[label], strict=True):
            per = [F.transform(term_hits(F.col(f"__n{i}"), F.col(f"__t{i}"), terms), _in_field(f)) for i, (f, _, _) in enumerate(spec.fields)]
            hits[f"__{strength}{k}"] = F.concat(*per)
    return fence(rows, {**hits, "__words": F.col("__words")})


def _words_among(terms) -> Column:
    """The single words of a list of terms, as an array; phrases are looked for in the text."""
    return F.array(*map(F.lit, split_terms(terms)[0])).cast("array<string>")


def _in_field(name: str):
    return lambda t: F.struct(F.lit(name).alias("field"), t.alias("term"))


def _described(strength: str):
    return lambda h: F.concat_ws(":", _field_name(h["field"]), F.lit(strength), h["term"])


def score_lexicon(items: DataFrame, spec: LexiconSpec = PLAIN) -> DataFrame:
    """items with the rule columns: scores, margin, candidates, gate, reason, direct category, needs_llm.

    Blank and missing fields score nothing. Equal scores rank by the order of
    spec.labels. Everything is one projection chain without a Python worker.
    """
    labels, n = spec.labels, len(spec.labels)
    rows = lexicon_hits(items, spec)
    keep = [c for c in items.columns if c != "text_for_cls"]
    points = [F.create_map(*(F.lit(x) for f in spec.fields for x in (f[0], f[1 + w]))) for w in (0, 1)]
    total = lambda hits, table: F.aggregate(hits, F.lit(0), lambda a, h: a + F.element_at(table, h["field"]))
    rows = rows.withColumns({f"__r{k}": total(F.col(f"__s{k}"), points[0]) + total(F.col(f"__w{k}"), points[1]) for k in range(n)})
    anchored = F.size(term_hits(F.col("__full"), F.col("__words"), spec.anchors)) > 0 if spec.anchors else F.lit(True)
    rows = rows.withColumns({
        "__anchored": anchored,
        "__rejects": term_hits(F.col("__full"), F.col("__words"), spec.reject_terms) if spec.reject_terms else F.array().cast("array<string>"),
        "__strong": _sum(F.size(f"__s{k}") for k in range(n)), "__weak": _sum(F.size(f"__w{k}") for k in range(n)),
    })
    scores = [F.col(f"__r{k}") for k in range(n)]
    if spec.guarded is not None:
        g = labels.index(spec.guarded)
        others = F.greatest(*(s for k, s in enumerate(scores) if k != g))
        unsure = (scores[g] > 0) & ~F.col("__anchored") & (F.size(f"__s{g}") == 0)
        scores[g] = F.when(unsure, F.greatest(F.lit(0), scores[g] - F.when(others >= scores[g], 3).otherwise(2))).otherwise(scores[g])
    rows = fence(rows, {**{f"__p{k}": s for k, s in enumerate(scores)}, **{c: F.col(c) for c in ("__anchored", "__rejects", "__strong", "__weak")}})
    placed = F.array(*(F.struct((-F.col(f"__p{k}")).alias("neg"), F.lit(k).alias("ordinal"), F.lit(label).alias("label"), F.size(f"__s{k}").alias("strong"), F.size(f"__w{k}").alias("weak")) for k, label in enumerate(labels)))
    rows = rows.withColumn("__ranked", F.array_sort(placed))
    first, second = F.get("__ranked", F.lit(0)), F.get("__ranked", F.lit(1))
    rows = fence(rows, {"__ranked": F.col("__ranked"), "__first": first, "__top": -first["neg"], "__second": (-second["neg"]) if n > 1 else F.lit(0)})
    top, margin, lead = F.col("__top"), F.col("__top") - F.col("__second"), F.col("__first")
    candidates = F.transform(F.filter("__ranked", lambda r: -r["neg"] >= F.greatest(F.lit(spec.screen_score), F.col("__top") - 2)), lambda r: r["label"])
    shaky = (lead["label"] == spec.guarded) & ~F.col("__anchored") & (lead["strong"] == 0) if spec.guarded else F.lit(False)
    reason = (
        F.when((F.size("__rejects") > 0) & (top < spec.reject_below), F.concat(F.lit("hard_reject_terms="), F.array_join(F.slice("__rejects", 1, 6), ",")))
        .when(top < spec.screen_score, "insufficient_top_score")
        .when((F.col("__strong") < spec.screen_strong) & (F.col("__strong") + F.col("__weak") < spec.screen_total), "insufficient_evidence")
        .when(F.size(candidates) > spec.max_candidates, "too_many_candidate_labels")
        .when(shaky & (top < spec.guard_below), "weak_portrait_only")
        .otherwise("")
    )
    rows = fence(rows, {"rule_reject_reason": reason}).withColumn("rule_gate_pass", F.col("rule_reject_reason") == "")
    enough = (lead["strong"] >= 1) | ((lead["label"] != spec.guarded) & (lead["weak"] >= 3) if spec.guarded else lead["weak"] >= 3)
    rows = rows.withColumn("__direct", F.col("rule_gate_pass") & (top >= spec.direct_score) & (margin >= spec.direct_margin) & enough & ~shaky)
    sure = F.least(F.lit(0.98), F.lit(0.58) + top * F.lit(spec.per_point) + margin * F.lit(0.02) + lead["strong"] * F.lit(0.03))
    named = lambda k: F.concat(*(F.transform(f"__{s}{k}", _described(w)) for s, w in (("s", "strong"), ("w", "weak"))))
    return rows.select(
        *keep, "text_for_cls",
        lead["label"].alias("rule_top1_label"), top.cast("long").alias("rule_top1_score"), F.col("__second").cast("long").alias("rule_top2_score"), margin.cast("long").alias("rule_margin"),
        F.to_json(F.struct(*(F.col(f"__p{k}").alias(label) for k, label in enumerate(labels)))).alias("rule_scores_json"),
        F.to_json(candidates).alias("rule_candidate_labels_json"),
        F.to_json(F.struct(*(F.array_sort(named(k)).alias(label) for k, label in enumerate(labels)))).alias("rule_matched_terms_json"),
        F.col("__strong").cast("long").alias("rule_positive_strong_hits"), F.col("__weak").cast("long").alias("rule_positive_weak_hits"),
        "rule_gate_pass", "rule_reject_reason",
        (F.col("rule_gate_pass") & ~F.col("__direct")).alias("needs_llm"),
        F.when(F.col("__direct"), lead["label"]).alias("category"),
        F.when(F.col("__direct"), round_half_even(sure, 3)).alias("category_confidence"),
        F.when(F.col("__direct"), "rule").alias("category_source"),
    )


def _field_name(c: Column) -> Column:
    return F.coalesce(F.element_at(F.create_map(*(F.lit(x) for kv in FIELD_NAMES.items() for x in kv)), c), c)


ROUTES = ("direct", "need_llm", "rejected")


def route_name() -> Column:
    """Decided by rule, sent to the model, or rejected."""
    gate, needs = F.coalesce(F.col("rule_gate_pass"), F.lit(False)), F.coalesce(F.col("needs_llm"), F.lit(False))
    return F.when(~gate, "rejected").when(needs, "need_llm").otherwise("direct")


def route(scored: DataFrame) -> dict[str, DataFrame]:
    """The rows of each route; together all rows, none twice."""
    return {name: scored.where(route_name() == name) for name in ROUTES}


def local_reject(items: DataFrame, text: str = "text_for_cls", terms=LOCAL_REJECT_TERMS, min_chars: int = 20, max_chars: int = 600) -> DataFrame:
    """items with local_reject_reason: too short a text first, then terms found anywhere in it; null if neither."""
    cut = F.substring(py_strip(safe(F.col(text))), 1, max_chars)
    hits = substring_hits(cut, terms)
    reason = F.when(F.char_length(cut) < min_chars, "metadata_too_short").when(F.size(hits) > 0, F.concat(F.lit("local_reject_terms="), F.array_join(F.slice(hits, 1, 6), ",")))
    return items.withColumn("local_reject_reason", reason)
