"""Keys: distinct, first and latest per key, semi and anti splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import sql_trim


def keys_of(df: DataFrame, on: str, where: Column | None = None) -> DataFrame:
    rows = df if where is None else df.where(where)
    return rows.where(F.col(on).isNotNull()).select(on).distinct()


def excluded_ids(keywords: DataFrame, terms, on: str = "item_id", keyword: str = "keyword") -> DataFrame:
    """Ids with one of the keywords, trimmed and folded."""
    return keys_of(keywords, on, F.lower(sql_trim(F.col(keyword))).isin(*terms))


def exclude_by_keys(items: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    return items.join(keys.select(on), on, "left_anti")


def keep_by_keys(items: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    return items.join(keys.select(on), on, "left_semi")


def _nth(df: DataFrame, key: str, order: list[Column]) -> DataFrame:
    w = W.partitionBy(key).orderBy(*order)
    return df.withColumn("__nth", F.row_number().over(w)).where("__nth = 1").drop("__nth")


def first_per_key(df: DataFrame, key: str, *order: str) -> DataFrame:
    """One row a key: the first by the order columns, nulls last."""
    return _nth(df, key, [F.col(c).asc_nulls_last() for c in order])


def latest_per_key(df: DataFrame, key: str, *order: str, nulls: str = "last") -> DataFrame:
    """One row a key: the last by the order columns. nulls='last' counts a null as the latest, 'first' as the earliest."""
    return _nth(df, key, [F.col(c).desc_nulls_first() if nulls == "last" else F.col(c).desc_nulls_last() for c in order])


def split(df: DataFrame, flag: Column) -> tuple[DataFrame, DataFrame]:
    """Rows for which flag is true, and all others; null counts as false."""
    flag = F.coalesce(flag, F.lit(False))
    return df.where(flag), df.where(~flag)


def pending(items: DataFrame, ledger: DataFrame, on: str, ok: str | None = None) -> DataFrame:
    """Items without a row in the ledger; with ok, failed rows count as not done."""
    done = ledger if ok is None else ledger.where(F.col(ok))
    return items.join(done.select(on), on, "left_anti")


def shard_of(key: Column, n: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(n)).cast("int")
