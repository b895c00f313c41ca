"""Quotas, plans, stratified samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import number


def not_nan(name: str) -> Column:
    return number(F.col(name))


def priority_order(*descending: str, key: str = "item_id") -> list[Column]:
    """Each column from large to small, missing values and NaN last, then the key."""
    return [not_nan(c).desc_nulls_last() for c in descending] + [F.col(key).asc_nulls_last()]


def class_plan(df: DataFrame, by: str, classes, n: int, names: tuple[str, str] = ("target_quota", "selected")) -> DataFrame:
    """(category, available, quota, selected, shortfall) for every class, also those without rows."""
    spark = df.sparkSession
    dimension = spark.createDataFrame([(c, i) for i, c in enumerate(classes)], "category string, ordinal int")
    counts = df.where(F.col(by).isin(*classes)).groupBy(F.col(by).alias("category")).agg(F.count("*").alias("available"))
    plan = dimension.join(counts, "category", "left").withColumn("available", F.coalesce("available", F.lit(0)))
    quota = F.lit(n).cast("long")
    return plan.orderBy("ordinal").select("category", "available", quota.alias(names[0]), F.least("available", quota).alias(names[1]), F.greatest(quota - F.col("available"), F.lit(0)).cast("long").alias("shortfall"))


def ranked_in_class(df: DataFrame, by: str, order: list[Column], classes=None) -> DataFrame:
    rows = df if classes is None else df.where(F.col(by).isin(*classes))
    return rows.withColumn("rank_in_selected_category", F.row_number().over(W.partitionBy(by).orderBy(*order)).cast("long"))


def top_in_class(df: DataFrame, by: str, k: int, order: list[Column], classes=None, salts: int = 64) -> DataFrame:
    """The first k rows of every class by order, with their rank: what ranked_in_class gives up to k.

    First the best k of each of `salts` parts of a class, then the best k of
    those, so that no task sorts a whole class. order must tell any two rows apart.
    """
    rows = df if classes is None else df.where(F.col(by).isin(*classes))
    rows = rows.withColumn("__salt", F.pmod(F.monotonically_increasing_id(), F.lit(salts)))
    first = rows.withColumn("__place", F.row_number().over(W.partitionBy(by, "__salt").orderBy(*order))).where(F.col("__place") <= k)
    return ranked_in_class(first.drop("__salt", "__place"), by, order).where(F.col("rank_in_selected_category") <= k)


def select_quota(df: DataFrame, by: str, k: int, order: list[Column], classes, key: str = "item_id") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(selected, leftover, plan): the first k rows of every class by order, the rest of these classes, the plan.

    selected has selection_stage, selected_final and the rank; leftover has no
    rank. key is unique, never null, and the last of order.
    """
    chosen = top_in_class(df, by, k, order, classes)
    left = df.where(F.col(by).isin(*classes)).join(chosen.select(key), key, "left_anti").select(*df.columns)
    chosen = chosen.withColumns({"selection_stage": F.lit("category_quota"), "selected_final": F.lit(True)})
    left = left.withColumns({"selection_stage": F.lit("not_selected_by_category_quota"), "selected_final": F.lit(False)})
    return chosen, left, class_plan(df, by, classes, k)


def stratified_sample(df: DataFrame, by: str, n: int, seed: int, classes, key: str = "item_id") -> tuple[DataFrame, DataFrame]:
    """(sample, plan): n rows a class in the order of a hash of key and seed; the same rows in every run."""
    order = [F.md5(F.concat_ws(":", F.col(key).cast("string"), F.lit(str(seed)))), F.col(key)]
    rows = df.where(F.col(by).isin(*classes))
    rows = rows.withColumn("__r", F.row_number().over(W.partitionBy(by).orderBy(*order))).where(F.col("__r") <= n).drop("__r")
    rows = rows.withColumns({"sample_category": F.col(by), "sample_quota": F.lit(n).cast("long"), "sample_random_seed": F.lit(seed).cast("long")})
    return rows.orderBy(by, key), class_plan(df, by, classes, n, ("target_sample", "sampled"))
