"""Many-to-one side tables: cleaning, capped aggregation, enrichment."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import collapse, number, sql_trim

# Words that stand for no keyword, and spellings of yes.
NULL_WORDS = ("", "null", "none", "n/a")
YES = ("t", "true", "1", "yes", "y")
CAPS = (32, 24, 24)


def clean_keywords(df: DataFrame, min_len: int = 2, max_len: int = 80, require_letter: bool = False, on: str = "item_id", keyword: str = "keyword") -> DataFrame:
    """df with `kw`, its keyword trimmed, folded and with white space collapsed; unusable rows are gone.

    Lengths are measured after the trim and before the collapse.
    """
    kw = F.lower(sql_trim(F.col(keyword)))
    ok = F.col(on).isNotNull() & F.col(keyword).isNotNull() & F.char_length(kw).between(min_len, max_len) & ~kw.isin(*NULL_WORDS)
    if require_letter:
        ok = ok & kw.rlike("[a-zA-Z一-龥]")
    return df.where(ok).withColumn("kw", collapse(kw))


def confidence(*columns: str) -> Column:
    return F.greatest(*(F.coalesce(number(F.col(c)), F.lit(-1.0)) for c in columns), F.lit(0.0))


def is_yes(c: Column) -> Column:
    return F.when(F.lower(sql_trim(F.coalesce(c.cast("string"), F.lit("")))).isin(*YES), 1).otherwise(0)


def dedupe_keywords(kw: DataFrame, on: str = "item_id") -> DataFrame:
    """kw(on, kw, conf, user) to one row an id and keyword, with the largest conf and user flag."""
    return kw.groupBy(on, "kw").agg(F.max("conf").alias("conf"), F.max("user").alias("user"))


def _joined(keep: Column, *order: Column) -> Column:
    """Keywords of the rows that keep selects, joined in the order of the given sort keys; null if none."""
    rows = F.array_sort(F.collect_list(F.when(keep, F.struct(*(o.alias(f"o{i}") for i, o in enumerate(order)), F.col("kw").alias("kw")))))
    return F.nullif(F.array_join(F.transform(rows, lambda r: r["kw"]), " | "), F.lit(""))


def keyword_agg(kw: DataFrame, caps: tuple[int, int, int] | None = CAPS, min_conf: float = 55, rank_before_filter: bool = False, on: str = "item_id") -> DataFrame:
    """One row an id over kw(on, kw, conf, user): counts, largest confidence and three ordered lists.

    Lists: all (user first, then confidence), those with min_conf or a user
    flag (by confidence), those with a user flag (by name). caps limits them,
    and the counts to what the first cap keeps; None leaves all. With
    rank_before_filter places are given out before the lists' own conditions,
    and the largest confidence is over all keywords. All windows and the final
    grouping share one shuffle on the id.
    """
    rows = dedupe_keywords(kw, on)
    high, user = (F.col("user") == 1) | (F.col("conf") >= min_conf), F.col("user") == 1
    if caps is None:
        top, high_top, user_top = F.lit(True), high, user
    else:
        place = lambda first, *order: F.row_number().over(W.partitionBy(on, *first).orderBy(*order))
        by_conf = (F.col("conf").desc(), F.col("kw"))
        inside = lambda c: [] if rank_before_filter else [c]
        rows = rows.withColumns({"__high": high, "__user": user})
        rows = rows.withColumns({"__r0": place([], F.col("user").desc(), *by_conf), "__r1": place(inside("__high"), *by_conf), "__r2": place(inside("__user"), F.col("kw"))})
        top, high_top, user_top = F.col("__r0") <= caps[0], high & (F.col("__r1") <= caps[1]), user & (F.col("__r2") <= caps[2])
    over = F.lit(True) if rank_before_filter else top
    by_conf = (-F.col("conf"),)
    return rows.groupBy(on).agg(
        F.count_if(top).alias("keyword_count"),
        F.sum(F.when(top, F.col("user"))).cast("long").alias("keyword_user_count"),
        F.max(F.when(over, F.col("conf"))).alias("keyword_ai_max_conf"),
        _joined(top, -F.col("user"), *by_conf).alias("keywords_joined"),
        _joined(high_top, *by_conf).alias("keywords_highconf_joined"),
        _joined(user_top).alias("keywords_user_joined"),
    )


def conversion_counts(cv: DataFrame, on: str = "item_id") -> DataFrame:
    return cv.groupBy(on, "kw").agg(F.count("*").alias("cnt"))


def conversion_agg(cv: DataFrame, cap: int | None = 12, on: str = "item_id") -> DataFrame:
    """One row an id over cv(on, kw): events, different keywords, an ordered list, the commonest keyword.

    Ties go by name. With a cap all four are over the cap's keywords.
    """
    rows = conversion_counts(cv, on)
    if cap is not None:
        w = W.partitionBy(on).orderBy(F.col("cnt").desc(), "kw")
        rows = rows.withColumn("__r", F.row_number().over(w)).where(F.col("__r") <= cap)
    return rows.groupBy(on).agg(
        F.sum("cnt").cast("long").alias("conv_event_count"),
        F.count("*").alias("conv_unique_keyword_count"),
        _joined(F.lit(True), -F.col("cnt")).alias("conv_keywords_joined"),
        F.min_by("kw", F.struct(-F.col("cnt"), F.col("kw"))).alias("conv_top_keyword"),
    )


def enrich(items: DataFrame, *sides: DataFrame, on: str = "item_id") -> DataFrame:
    """items with the columns of side tables that have one row a key; items without one keep nulls."""
    return reduce(lambda a, b: a.join(b, on, "left"), sides, items)
