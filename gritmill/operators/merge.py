"""Joining rule decisions with model results: override, thresholds, reasons, eligibility."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import number, py_strip
from ..schemas import DEFAULT_MODEL_CONFIDENCE, DEFAULT_RULE_CONFIDENCE, FALLBACK_CONFIDENCE, LABELS, LOW_MODEL_CONFIDENCE, MIN_CONFIDENCE, REVIEW_CONFIDENCE
from .dedupe import latest_per_key

PRESETS = ("basic", "min_conf", "thresholds", "quota")
RESULT_COLUMNS = ("llm_label", "llm_confidence", "llm_reason", "llm_ok", "llm_error")


def last_match(*rules: tuple[Column, Column | str | None]) -> Column:
    """A chain of masked assignments of which the last that applies wins."""
    out = None
    for condition, value in reversed(rules):
        value = value if isinstance(value, Column) else F.lit(value)
        out = F.when(condition, value) if out is None else out.when(condition, value)
    return out


def threshold(category: Column, which: int, thresholds=MIN_CONFIDENCE) -> Column:
    """The least confidence for a category, by rule (0) or model (1)."""
    table = F.create_map(*(F.lit(x) for k, v in thresholds.items() for x in (k, float(v[which]))))
    return F.coalesce(F.element_at(table, category), F.lit((DEFAULT_RULE_CONFIDENCE, DEFAULT_MODEL_CONFIDENCE)[which]))


def attach_results(rule: DataFrame, results: DataFrame, on: str = "item_id", order: tuple[str, ...] = ("seq",)) -> DataFrame:
    """rule ⟕ the latest result of each id. Order columns that tell runs apart come first."""
    latest = latest_per_key(results, on, *order) if order else results
    return rule.join(latest.select(on, *(c for c in RESULT_COLUMNS if c in latest.columns)), on, "left")


def merge_decisions(rule: DataFrame, results: DataFrame, preset: str = "basic", on: str = "item_id", order: tuple[str, ...] = ("seq",), thresholds=MIN_CONFIDENCE, classes=LABELS) -> DataFrame:
    """rule(on, needs_llm, category, category_confidence, category_source, rule_top1_label) with the model's say.

    Rows that need the model take its label; without one they fall back to the
    rule's first label with confidence 0.2. `basic` adds review_flag,
    `min_conf` and `thresholds` add reject_reason and kept as well, `quota` adds
    eligibility for a selection by class. llm_rejected tells a model's refusal
    from a failure, which look alike otherwise.
    """
    if preset not in PRESETS:
        raise ValueError(f"preset {preset!r} is none of {PRESETS}")
    df = attach_results(rule, results, on, order)
    df = df.withColumns({"llm_confidence": number(F.col("llm_confidence")), "category_confidence": number(F.col("category_confidence"))})
    use = F.coalesce(F.col("needs_llm"), F.lit(False))
    label = F.col("llm_label")
    if preset == "quota":
        label = F.when(py_strip(label) != "", label)
    answered = use & label.isNotNull()
    final = {
        "category": F.when(answered, label).when(use, F.col("rule_top1_label")).otherwise(F.col("category")),
        "category_confidence": F.when(answered, F.col("llm_confidence")).when(use, F.lit(FALLBACK_CONFIDENCE)).otherwise(F.col("category_confidence")),
        "category_source": F.when(answered, F.lit("llm")).when(use, F.lit("fallback_rule")).otherwise(F.col("category_source")),
    }
    if "llm_ok" in df.columns:
        final["llm_rejected"] = use & F.col("llm_label").isNull() & F.coalesce(F.col("llm_ok"), F.lit(False))
    df = df.withColumns(final)
    source = F.coalesce(F.col("category_source"), F.lit(""))
    by_rule, by_model, fallback = source == "rule", source == "llm", source == "fallback_rule"
    conf, model_conf = F.coalesce("category_confidence", F.lit(0.0)), F.coalesce("llm_confidence", F.lit(0.0))
    if preset in ("basic", "min_conf"):
        df = df.withColumn("review_flag", conf < REVIEW_CONFIDENCE)
        if preset == "basic":
            return df
        reason = last_match((F.col("category").isNull(), "missing_category"), (fallback, "fallback_rule"), (by_model & (model_conf < LOW_MODEL_CONFIDENCE), "low_llm_confidence"), (by_rule & (conf < REVIEW_CONFIDENCE), "low_rule_confidence"))
        kept = F.col("category").isNotNull() & ~F.col("review_flag") & (by_rule | (by_model & (model_conf >= LOW_MODEL_CONFIDENCE)))
        return df.withColumns({"reject_reason": reason, "kept": kept})
    rule_least, model_least = threshold(F.col("category"), 0, thresholds), threshold(F.col("category"), 1, thresholds)
    low_model, low_rule = by_model & (model_conf < model_least), by_rule & (conf < rule_least)
    least = F.when(by_rule, rule_least).when(by_model, model_least).when(fallback, F.lit(1.0)).otherwise(F.lit(DEFAULT_RULE_CONFIDENCE))
    target = F.col("category").isin(*classes)
    rules = [(F.col("category").isNull(), "missing_category"), (fallback, "fallback_rule"), (low_model, "low_llm_confidence"), (low_rule, "low_rule_confidence")]
    reason = last_match(*rules)
    common = {"rule_min_conf_threshold": rule_least, "llm_min_conf_threshold": model_least, "effective_min_conf_threshold": least}
    passed = F.col("category").isNotNull() & ((by_rule & ~low_rule) | (by_model & ~low_model))
    if preset == "thresholds":
        return df.withColumns({**common, "review_flag": conf < least, "reject_reason": reason, "kept": passed & (conf >= least)})
    eligible = passed & target
    effective = F.when(by_model, F.col("llm_confidence")).otherwise(F.col("category_confidence"))
    return df.withColumns({
        **common, "reject_reason": F.coalesce(reason, F.when(~target, F.lit("non_target_category"))), "eligible": F.coalesce(eligible, F.lit(False)),
        "effective_confidence": effective, "source_priority": F.when(by_model, 1).otherwise(0), "selection_status": F.when(F.coalesce(eligible, F.lit(False)), "eligible").otherwise("rejected"),
        "review_flag": ~F.coalesce(eligible, F.lit(False)),
        **{f"{c}_final": F.col(c) for c in ("category", "category_confidence", "category_source")},
    })


def group_counts(df: DataFrame, *by: str) -> DataFrame:
    """Rows a group, null groups too, from many to few, then by the first column."""
    return df.groupBy(*by).agg(F.count("*").alias("count")).orderBy(F.col("count").desc(), *(F.col(c).asc_nulls_last() for c in by))


def selected_rows(merged: DataFrame, k: int, by: str = "category", classes=LABELS, downloads: str = "stats_downloads", views: str = "stats_views", key: str = "item_id") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(merged with selection columns, selected, plan) of a `quota` merge: k rows a class, model decisions first."""
    from .select import class_plan, priority_order, top_in_class

    order = priority_order("source_priority", "effective_confidence", downloads, views, key=key)
    place = top_in_class(merged.where("eligible"), by, k, order, classes).select(key, "rank_in_selected_category")
    out = merged.join(place, key, "left")
    chosen = F.col("rank_in_selected_category").isNotNull()
    out = out.withColumns({
        "selected_final": chosen,
        "selection_stage": F.when(chosen, "category_quota").when(F.col("eligible"), "not_selected_by_category_quota"),
        "reject_reason": F.when(F.col("eligible") & ~chosen, F.coalesce("reject_reason", F.lit("not_selected_by_category_quota"))).otherwise(F.col("reject_reason")),
        "selection_status": F.when(chosen, "selected").when(F.col("eligible"), "eligible_but_not_selected").otherwise(F.col("selection_status")),
        "rank_in_selected_category": F.when(chosen, F.col("rank_in_selected_category")),
    })
    return out, out.where("selected_final"), class_plan(merged.where("eligible"), by, classes, k)
