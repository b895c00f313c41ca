from pyspark.sql import functions as F

from gritmill import schemas
from gritmill.operators import dedupe, external, lexicon, merge, publish, score, select, sidetables
from gritmill.plans import pipeline
from gritmill.schemas import CITY, INDOOR, NATURE, PORTRAIT, STILL


def plan_of(df):
    return df._jdf.queryExecution().toString()


def scored(spark, spec=lexicon.PLAIN, **columns):
    df = spark.createDataFrame([tuple(columns.values())], ", ".join(f"{c} string" for c in columns))
    return lexicon.score_lexicon(df, spec).first()


def test_direct_decision_and_confidence(spark):
    r = scored(spark, photo_description="mountain lake with forest", ai_description="a river")
    assert (r.rule_top1_label, r.rule_top1_score, r.rule_margin, r.category) == (NATURE, 16, 16, NATURE)
    assert r.category_confidence == 0.98 and not r.needs_llm


def test_ties_go_by_label_order(spark):
    r = scored(spark, photo_description="a bridge and a kitchen and a river")
    assert r.rule_top1_label == CITY and r.rule_margin == 0 and r.needs_llm


def test_gates(spark):
    reasons = {
        "an old painting of a river": "hard_reject_terms=painting", "nothing here at all": "insufficient_top_score",
        "woman": "insufficient_top_score", "bridge kitchen river still life": "too_many_candidate_labels",
    }
    for text, want in reasons.items():
        assert scored(spark, photo_description=text).rule_reject_reason == want


def test_weak_portrait_is_suppressed(spark):
    # four weak hits in each text, no anchor: 8 points less 2
    r = scored(spark, photo_description="woman man girl boy", ai_description="woman man girl boy")
    assert (r.rule_top1_label, r.rule_top1_score, r.category, r.rule_reject_reason) == (PORTRAIT, 6, None, "")
    assert r.needs_llm


def test_a_weak_hit_of_no_points_counts_as_evidence(spark):
    r = scored(spark, photo_location_name="downtown station")
    assert r.rule_positive_weak_hits == 2 and r.rule_top1_score == 0


def test_phrases_match_across_keywords(spark):
    r = scored(spark, lexicon.ENRICHED, keywords_user_joined="living | room")
    assert r.rule_top1_label == INDOOR and r.rule_positive_strong_hits == 1


def test_null_and_missing_fields(spark):
    df = spark.createDataFrame([(None, "x")], "photo_description string, other string")
    r = lexicon.score_lexicon(df).first()
    assert r.text_for_cls == "" and r.rule_reject_reason == "insufficient_top_score" and r.other == "x"


def test_promoted_terms(spark):
    assert "food" in lexicon.ENRICHED.vocabulary[STILL][0] and "food" not in lexicon.ENRICHED.vocabulary[STILL][1]


def test_routes_partition_the_input(spark):
    texts = ["mountain lake with forest near the river", "bridge kitchen", "nothing", None, "portrait face"]
    df = spark.createDataFrame([(t,) for t in texts], "photo_description string")
    assert sum(x.count() for x in lexicon.route(lexicon.score_lexicon(df)).values()) == len(texts)


def kw_rows(spark):
    rows = [("a", f"k{i:02d}", float(80 - i), 1 if i >= 30 else 0) for i in range(40)]
    return spark.createDataFrame(rows, "item_id string, kw string, conf double, user int")


def test_caps_differ_by_variant(spark):
    capped = sidetables.keyword_agg(kw_rows(spark)).first()
    every = sidetables.keyword_agg(kw_rows(spark), caps=None).first()
    ranked = sidetables.keyword_agg(kw_rows(spark), rank_before_filter=True).first()
    assert (capped.keyword_count, every.keyword_count, ranked.keyword_count) == (32, 40, 32)
    assert capped.keywords_user_joined == " | ".join(f"k{i}" for i in range(30, 40)) == every.keywords_user_joined
    assert ranked.keywords_user_joined is None
    assert ranked.keyword_ai_max_conf == 80.0 and capped.keywords_joined.startswith("k30 | k31")


def test_aggregation_without_binding_caps_is_uncapped(spark):
    small = kw_rows(spark).where("conf > 60")
    assert sidetables.keyword_agg(small, caps=(99, 99, 99)).first() == sidetables.keyword_agg(small, caps=None).first()


def test_aggregation_takes_one_shuffle_after_a_repartition(spark):
    plan = sidetables.keyword_agg(kw_rows(spark).repartition(4, "item_id"))
    plan.collect()
    physical = plan._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert physical.count("Exchange hashpartitioning") == 1


def test_clean_keywords(spark):
    words = ["a", "ab", "x" * 80, "x" * 81, "null", "N/A", " cat　", "two  words", None]
    df = spark.createDataFrame([("i", w) for w in words], "item_id string, keyword string")
    assert [r.kw for r in sidetables.clean_keywords(df).collect()] == ["ab", "x" * 80, "cat", "two words"]


def test_confidence_and_flag(spark):
    df = spark.createDataFrame([("", "abc", "YES"), ("7", "9", "f"), ("nan", None, None)], "a string, b string, u string")
    rows = df.select(sidetables.confidence("a", "b").alias("c"), sidetables.is_yes(F.col("u")).alias("u")).collect()
    assert [(r.c, r.u) for r in rows] == [(0.0, 1), (9.0, 0), (0.0, 0)]


def test_anti_join_is_an_anti_join(spark):
    items = spark.createDataFrame([("a",), ("b",), (None,)], "item_id string")
    out = dedupe.exclude_by_keys(items, dedupe.keys_of(items.where("item_id = 'a'"), "item_id"), "item_id")
    assert "LeftAnti" in plan_of(out) and sorted(str(r[0]) for r in out.collect()) == ["None", "b"]


def test_top_k_is_cut_before_the_shuffle(spark):
    df = spark.range(100).withColumn("c", F.col("id") % 3)
    top = select.ranked_in_class(df, "c", [F.col("id")]).where(F.col("rank_in_selected_category") <= 5)
    assert "WindowGroupLimit" in plan_of(top)


def test_split_counts_null_as_false(spark):
    df = spark.createDataFrame([(True,), (False,), (None,)], "f boolean")
    assert [x.count() for x in dedupe.split(df, F.col("f"))] == [1, 2]


def merged(spark, preset, rule, result):
    schema = "item_id string, rule_top1_label string, needs_llm boolean, category string, category_confidence double, category_source string"
    r = spark.createDataFrame([("x", *rule)], schema)
    m = spark.createDataFrame([("x", *result)] if result else [], "item_id string, llm_label string, llm_confidence double, llm_ok boolean, seq long")
    return merge.merge_decisions(r, m, preset).first()


def test_merge_variants(spark):
    need, ruled = (NATURE, True, None, None, None), (NATURE, False, NATURE, 0.97, "rule")
    assert merged(spark, "basic", need, None).category_source == "fallback_rule"
    r = merged(spark, "min_conf", need, (CITY, 0.6, True, 1))
    assert (r.category, r.reject_reason, r.kept) == (CITY, None, False)
    assert merged(spark, "min_conf", need, (CITY, 0.4, True, 1)).reject_reason == "low_llm_confidence"
    assert merged(spark, "min_conf", ruled, None).kept
    assert merged(spark, "thresholds", ruled, None).reject_reason == "low_rule_confidence"
    assert merged(spark, "thresholds", need, (STILL, 0.5, True, 1)).kept
    assert merged(spark, "quota", need, (" ", 0.9, True, 1)).category_source == "fallback_rule"
    r = merged(spark, "quota", need, ("other", 0.9, True, 1))
    assert not r.eligible and r.reject_reason == "non_target_category"
    assert merged(spark, "basic", need, (None, 0.9, True, 1)).llm_rejected


def test_latest_result_by_run_then_sequence(spark):
    df = spark.createDataFrame([("x", "r1", 9, "old"), ("x", "r2", 0, "new")], "item_id string, run_id string, seq long, v string")
    assert dedupe.latest_per_key(df, "item_id", "run_id", "seq").first().v == "new"


def test_quota_order_puts_nan_and_null_last(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", float("nan")), ("c", None), ("d", 2.0)], "item_id string, s double").withColumn("c", F.lit("k"))
    chosen, left, plan = select.select_quota(df, "c", 2, select.priority_order("s"), ["k", "none"])
    assert [r.item_id for r in chosen.orderBy("rank_in_selected_category").collect()] == ["d", "a"]
    assert left.count() == 2 and [tuple(r) for r in plan.collect()] == [("k", 4, 2, 2, 0), ("none", 0, 2, 0, 2)]


def test_selection_marks_every_row(spark):
    rows = [(str(i), NATURE, 0.99 - i / 1000, "rule", True, 0.0, 0) for i in range(5)]
    df = spark.createDataFrame(rows, "item_id string, category string, effective_confidence double, category_source string, eligible boolean, stats_downloads double, source_priority int")
    df = df.withColumns({"stats_views": F.lit(0), "reject_reason": F.lit(None).cast("string"), "selection_status": F.lit("eligible")})
    out, chosen, _ = merge.selected_rows(df, 2)
    assert chosen.count() == 2
    assert {r.selection_status for r in out.collect()} == {"selected", "eligible_but_not_selected"}


def test_sample_repeats_itself(spark):
    df = spark.range(100).select(F.col("id").cast("string").alias("item_id"), F.lit("k").alias("c"))
    a, b = (select.stratified_sample(df, "c", 10, 7, ["k"])[0].collect() for _ in range(2))
    assert a == b and len(a) == 10


def review_row(spark, logits, category="a", top=None):
    df = spark.createDataFrame([(category, ["a", "b", "c"], logits)], "category string, labels array<string>, logits array<double>")
    return score.review(df)


def test_review_rounds(spark):
    assert review_row(spark, [5.0, 0.0, 0.0]).first().review_action == "keep"
    assert review_row(spark, [0.0, 5.0, 0.0]).first().review1_final_label == "b"
    assert review_row(spark, None).first().review_action == "error"
    open_ = review_row(spark, [1.0, 0.9, 0.8])
    assert open_.first().review_action == "review"
    again = score.review_again(open_).first()
    assert again.review2_candidates == "a|b" and again.review2_action == "still_review"
    final, rest = score.finalize(open_.withColumn("item_id", F.lit("x")), score.review_again(open_.withColumn("item_id", F.lit("x"))), "item_id")
    assert final.count() == 0 and rest.count() == 1


def test_review_with_nothing_open(spark):
    first = review_row(spark, [5.0, 0.0, 0.0]).withColumn("item_id", F.lit("x"))
    final, _ = score.finalize(first, score.review_again(first), "item_id")
    assert [tuple(r) for r in final.select("final_label", "final_source").collect()] == [("a", "review_keep_round1")]


def test_quantile(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (4.0,), (10.0,), (None,)], "v double")
    assert sorted(r.v for r in score.quantile_keep(df, "v", 0.3).collect()) == [2.0, 4.0, 10.0]


def test_bad_vectors_have_an_error(spark):
    df = spark.createDataFrame([([3.0, 4.0],), ([1.0],), (None,)], "v array<double>")
    rows = score.vector_score(df, "v", [1.0, 0.0], 0.5).collect()
    assert [r.aesthetic_ok for r in rows] == [True, False, False] and abs(rows[0].aesthetic_score - 1.1) < 1e-12


class Flaky:
    def __init__(self):
        self.calls = 0

    def classify(self, items):
        self.calls += 1
        if any(x["item_id"] == "bad" for x in items):
            raise ValueError("poison")
        return [{"item_id": x["item_id"], "label": "a", "confidence": 2} for x in items if x["item_id"] != "lost" or self.calls > 2]


def test_bisection_isolates_one_bad_item():
    items = [{"item_id": str(i)} for i in range(7)] + [{"item_id": "bad"}]
    model = Flaky()
    out = external.call_with_retry(items, lambda xs: external.check_answers(xs, model.classify(xs), ("a",), False), external.RetryPolicy(retries=2), True, sleep=lambda _: None)
    assert [r["item_id"] for r in out if not r["llm_ok"]] == ["bad"] and out[0]["llm_confidence"] == 1.0


def test_missing_answers_are_asked_again():
    model = Flaky()
    out = external.call_with_retry([{"item_id": "lost"}], lambda xs: external.check_answers(xs, model.classify(xs), ("a",), False), external.RetryPolicy(), False, sleep=lambda _: None)
    assert out[0]["llm_ok"] and model.calls == 3


def test_pauses_grow_to_a_limit():
    assert [external.RetryPolicy(step=1.5, longest=4).pause(n) for n in (1, 2, 3)] == [1.5, 3.0, 4]


class Store:
    def fetch(self, url, relpath):
        if url.endswith("0"):
            raise OSError("gone")
        return {"status": 200, "size": 3, "ext": ".jpg"}


def test_download_rows(spark):
    df = spark.createDataFrame([(str(i), f"http://x/{i}", f"raw/{i}") for i in range(3)], "item_id string, photo_image_url string, relpath string")
    rows = {r.item_id: r for r in external.download(df, Store(), policy=external.RetryPolicy(step=0)).collect()}
    assert not rows["0"].download_ok and rows["0"].download_error == "gone" and rows["0"].download_attempts == 3 and rows["1"].file_size == 3


def test_ledger_join_renames_clashes(spark):
    items = spark.createDataFrame([("a", "u"), ("b", "v")], "item_id string, url string")
    ledger = spark.createDataFrame([("a", True, "w")], "item_id string, download_ok boolean, url string")
    rows = {r.item_id: r for r in publish.ledger_join(items, ledger).collect()}
    assert rows["a"].url_dl == "w" and rows["b"].download_ok is False


def test_organise_files(spark, tmp_path):
    (tmp_path / "a.png").write_bytes(b"x")
    df = spark.createDataFrame([("1", str(tmp_path / "a.png"), "l/1"), ("2", str(tmp_path / "none"), "l"), ("3", None, "l")], "item_id string, local_image_path string, final_label string")
    rows = {r.item_id: r for r in publish.organise_files(df, str(tmp_path / "out")).collect()}
    assert rows["1"].final_image_ok and (tmp_path / "out" / rows["1"].final_image_relpath).exists() and not rows["2"].final_image_ok and len(rows) == 2


def test_manifest_log_has_all_rows(spark):
    df = spark.createDataFrame([("1", "l", "s", True, "p", "keep"), ("2", "l", "s", False, "", "keep")], "item_id string, final_label string, final_source string, final_image_ok boolean, final_image_relpath string, review_action string")
    out = publish.final_manifest(df, ["item_id"])
    assert (out["manifest"].count(), out["log"].count(), out["failures"].count()) == (1, 2, 1) and "review_action" in out["log"].columns


def test_funnel_end_to_end(spark):
    items = schemas.conform(spark.createDataFrame([("1", "a mountain lake and a forest", "a river"), ("2", "a poster", None), ("3", "a room", "some building")], "item_id string, photo_description string, ai_description string"), schemas.ITEMS)
    keywords = schemas.conform(spark.createDataFrame([("2", " Poster "), ("1", "wildlife")], "item_id string, keyword string"), schemas.KEYWORDS)
    tables = {"items": items, "keywords": keywords, "conversions": schemas.empty(spark, schemas.CONVERSIONS), "results": schemas.empty(spark, schemas.MODEL_RESULTS)}
    out = pipeline.run(spark, pipeline.funnel(lexicon.ENRICHED), tables)["classified"]
    assert {r.item_id: r.category for r in out.collect()} == {"1": NATURE, "3": None}


def test_a_failing_step_ends_the_run(spark):
    import pytest

    with pytest.raises(pipeline.StepFailed, match="second"):
        pipeline.run(spark, [("first", lambda s, t: s.range(1)), ("second", lambda s, t: t["nothing"])], {})


def test_top_of_salted_classes_is_the_top_of_classes(spark):
    df = spark.range(0, 5000, 1, 7).select("id", (F.col("id") % 3).alias("c"), (F.hash("id") % 50).alias("s"))
    order = [F.col("s").desc(), F.col("id")]
    want = select.ranked_in_class(df, "c", order).where(F.col("rank_in_selected_category") <= 40)
    got = select.top_in_class(df, "c", 40, order)
    assert sorted(want.collect()) == sorted(got.collect())
    assert "[c#" in plan_of(got) and "__salt" in plan_of(got)
    chosen, left, _ = select.select_quota(df, "c", 40, order, [0, 1, 2], "id")
    assert chosen.count() == 120 and left.count() == 4880 and left.columns[:3] == ["id", "c", "s"]


def test_quantiles_narrow_to_the_exact_value(spark):
    import numpy as np

    values = np.random.default_rng(2).lognormal(size=30_000).round(3)
    values[:9000] = 1.5  # a value of very many rows
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "v double").cache()
    for q in (0.0, 0.1, 0.3, 0.5, 0.99, 1.0):
        assert abs(score.quantile(df, "v", q, exact_rows=500) - np.quantile(values, q)) < 1e-9
    assert score.quantile(df.limit(0), "v", 0.5) is None and score.quantile_keep(df.limit(0), "v").count() == 0


def test_logits_of_odd_vectors(spark):
    df = spark.createDataFrame([([3.0, 4.0],), ([0.0, 0.0],), ([1.0],), (None,), ([1.0, None],), ([],)], "v array<double>")
    got = [r.z for r in df.select(score.class_logits(F.col("v"), [[1.0, 0.0], [0.0, 2.0]], 10.0).alias("z")).collect()]
    assert [round(x, 9) for x in got[0]] == [6.0, 16.0] and got[1] == [0.0, 0.0] and got[2:] == [None] * 4
