"""Vector scores, quantile cuts, zero-shot class probabilities, two rounds of review."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.vector import linear, normalise, ranked, softmax
from .lexicon import fence


def vector_score(df: DataFrame, vec: str, weights: list[float], bias: float = 0.0, out: str = "aesthetic_score") -> DataFrame:
    """df with a linear score of the normalised vector; a missing or ill-sized vector gives no score and an error."""
    fits = F.coalesce(F.size(vec) == len(weights), F.lit(False))
    stem = out.removesuffix("_score")
    return df.withColumns({out: F.when(fits, linear(normalise(F.col(vec)), weights, bias)), f"{stem}_ok": fits, f"{stem}_error": F.when(fits, "").otherwise("bad vector")})


def quantile(rows: DataFrame, col: str, q: float, exact_rows: int = 1_000_000) -> float | None:
    """The q-quantile (linear interpolation) of the values that are not null; None if there are none.

    Approximate quantiles on either side of the place sought narrow the range
    until at most exact_rows rows, or values of few kinds, are in it; only those
    are ordered exactly. Each round reads one column and brings four numbers.
    """
    x = F.col(col).cast("double")
    inside, below, size = rows.where(x.isNotNull()).select(x.alias("x")), 0, None
    total = size = inside.count()
    if not total:
        return None
    place = q * (total - 1)
    while size > exact_rows:
        margin = 2e-4
        shares = [max(0.0, (place - below) / size - margin), min(1.0, (place + 1 - below) / size + margin)]
        low, high = inside.agg(F.percentile_approx("x", shares, F.lit(10_000))).first()[0]
        under, within = inside.agg(F.count_if(F.col("x") < low), F.count_if(F.col("x").between(low, high))).first()
        if not below + under <= place <= place + 1 <= below + under + within or within > size / 2:
            break
        inside, below, size = inside.where(F.col("x").between(low, high)), below + under, within
    return inside.agg(F.percentile("x", (place - below) / max(1, size - 1))).first()[0]


def quantile_keep(df: DataFrame, col: str, q: float = 0.30, ok: str | None = None, digits: int = 9, exact_rows: int = 1_000_000) -> DataFrame:
    """Rows whose value reaches the q-quantile (linear interpolation) of the rows that are ok and not null."""
    rows = df if ok is None else df.where(F.col(ok))
    cut = quantile(rows, col, q, exact_rows)
    return rows.where(F.round(col, digits) >= F.round(F.lit(cut).cast("double"), digits))


def class_logits(vec: Column, prompts: list[list[float]], scale: float) -> Column:
    """scale times the dot products of the normalised vector with each prompt; null for missing, ill-sized or broken vectors.

    A matrix product in Arrow batches: as expressions over arrays every element
    costs two interpreted lambdas for each prompt, which is ten times slower at
    10 prompts of 64 numbers.
    """
    matrix = np.asarray(prompts, float).T

    @F.pandas_udf("array<double>")
    def logits(vectors: pd.Series) -> pd.Series:
        out = np.full(len(vectors), None, object)
        rows = {i: np.asarray(v, float) for i, v in enumerate(vectors) if v is not None and len(v) == len(matrix)}
        good = [i for i, v in rows.items() if np.isfinite(v).all()]
        if good:
            x = np.stack([rows[i] for i in good])
            x /= np.maximum(np.sqrt((x * x).sum(axis=1, keepdims=True)), 1e-12)
            for i, row in zip(good, scale * (x @ matrix), strict=True):
                out[i] = row
        return pd.Series(out)

    return logits(vec)


def class_probs(df: DataFrame, vec: str, prompts: dict[str, list[float]], scale: float = 100.0) -> DataFrame:
    """df with labels and logits of its vector against one prompt vector a label."""
    return fence(df, {"labels": F.array(*map(F.lit, prompts)), "logits": class_logits(F.col(vec), list(prompts.values()), scale)})


def top_two(labels: Column, logits: Column, digits: int | None = None) -> Column:
    """A struct (top1_label, top2_label, top1_score, top2_score, margin); a missing second label scores 0."""
    best = ranked(labels, softmax(logits))
    one, two = F.get(best, F.lit(0)), F.get(best, F.lit(1))
    s1, s2 = one["score"], F.coalesce(two["score"], F.lit(0.0))
    tidy = (lambda c: F.round(c, digits)) if digits is not None else (lambda c: c)
    return F.struct(one["label"].alias("top1_label"), two["label"].alias("top2_label"), tidy(s1).alias("top1_score"), tidy(s2).alias("top2_score"), tidy(s1 - s2).alias("margin"))


@dataclass(frozen=True)
class ReviewRules:
    """Least score and margin to keep a label and to change it; at most these to drop the item."""

    keep: tuple[float, float] = (0.55, 0.15)
    relabel: tuple[float, float] = (0.60, 0.20)
    drop: tuple[float, float] | None = None


ROUND1, ROUND2 = ReviewRules(), ReviewRules((0.56, 0.10), (0.60, 0.12), (0.45, 0.05))


def review(df: DataFrame, category: str = "category", rules: ReviewRules = ROUND1, digits: int | None = None) -> DataFrame:
    """First round over labels and logits: keep, relabel or review; error where there are no logits."""
    rows = fence(df, {"__t": top_two(F.col("labels"), F.col("logits"), digits)})
    t, ok = F.col("__t"), F.coalesce(F.size("logits") > 0, F.lit(False)) & F.col(category).isNotNull()
    same, strong = t["top1_label"] == F.col(category), lambda r: (t["top1_score"] >= r[0]) & (t["margin"] >= r[1])
    action = F.when(~ok, "error").when(same & strong(rules.keep), "keep").when(~same & strong(rules.relabel), "relabel").otherwise("review")
    rows = fence(rows, {"review1_ok": ok, "review1_error": F.when(ok, "").otherwise("no scores"), **{f"review1_{c}": F.when(ok, t[c]) for c in ("top1_label", "top2_label", "top1_score", "top2_score", "margin")}, "review_action": action})
    final = F.when(F.col("review_action") == "keep", F.col(category)).when(F.col("review_action") == "relabel", F.col("review1_top1_label"))
    return rows.withColumn("review1_final_label", final).drop("__t")


def candidates(labels: Column, *likely: Column) -> Column:
    """Different valid labels among the likely ones, all if fewer than two."""
    own = F.array_distinct(F.filter(F.array(*(F.trim(c) for c in likely)), lambda x: x.isNotNull() & F.array_contains(labels, x)))
    return F.when(F.size(own) >= 2, own).otherwise(labels)


def review_again(df: DataFrame, category: str = "category", rules: ReviewRules = ROUND2, digits: int | None = None) -> DataFrame:
    """Second round, over rows of the first that stayed open: softmax over the likely labels only."""
    open_rows = df.where(F.col("review_action").isin("review", "error"))
    rows = open_rows.withColumn("__c", candidates(F.col("labels"), F.col(category), F.col("review1_top1_label"), F.col("review1_top2_label")))
    place = F.transform("__c", lambda x: F.get(F.col("logits"), (F.array_position(F.col("labels"), x) - 1).cast("int")))
    rows = rows.withColumn("__l", place)
    rows = fence(rows, {"__c": F.col("__c"), "__t": top_two(F.col("__c"), F.col("__l"), digits)})
    t, ok = F.col("__t"), F.coalesce(F.size("logits") > 0, F.lit(False))
    same, strong = t["top1_label"] == F.col(category), lambda r: (t["top1_score"] >= r[0]) & (t["margin"] >= r[1])
    drop = (t["top1_score"] <= rules.drop[0]) & (t["margin"] <= rules.drop[1]) if rules.drop else F.lit(False)
    action = F.when(~ok, "error").when(same & strong(rules.keep), "keep_old").when(~same & strong(rules.relabel), "relabel_top1").when(drop, "drop").otherwise("still_review")
    rows = fence(rows, {"review2_ok": ok, "review2_error": F.when(ok, "").otherwise("no scores"), "review2_candidates": F.array_join("__c", "|"), **{f"review2_{c}": F.when(ok, t[c]) for c in ("top1_label", "top2_label", "top1_score", "top2_score", "margin")}, "review2_action": action})
    final = F.when(F.col("review2_action") == "keep_old", F.col(category)).when(F.col("review2_action") == "relabel_top1", F.col("review2_top1_label"))
    return rows.withColumn("review2_final_label", final).drop("__c", "__l", "__t")


def finalize(first: DataFrame, second: DataFrame, on: str, category: str = "category") -> tuple[DataFrame, DataFrame]:
    """(final, remaining): rows that either round accepts, the second's word before the first's, one an id."""
    a = first.where(F.col("review_action").isin("keep", "relabel"))
    label = F.when(F.col("review_action") == "keep", F.col(category)).otherwise(F.coalesce("review1_final_label", "review1_top1_label"))
    a = a.withColumns({"final_label": label, "final_source": F.concat(F.lit("review_"), "review_action", F.lit("_round1")), "__round": F.lit(1)})
    accepted = F.col("review2_action").isin("keep_old", "relabel_top1")
    source = F.when(F.col("review2_action") == "keep_old", "review_keep_round2").otherwise("review_relabel_round2")
    b = second.where(accepted).withColumns({"final_label": F.col("review2_final_label"), "final_source": source, "__round": F.lit(2)})
    both = a.unionByName(b, allowMissingColumns=True).where(F.col("final_label").isNotNull())
    from .dedupe import latest_per_key

    return latest_per_key(both, on, "__round").drop("__round"), second.where(~F.coalesce(accepted, F.lit(False)))
