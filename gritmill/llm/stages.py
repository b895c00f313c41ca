"""Putting an operator's decisions back on whole rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import position


def _plain(docs: DataFrame) -> DataFrame:
    return docs.toDF(*(f"c{i}" for i in range(len(docs.columns))))


def replace_text(docs: DataFrame, lines: DataFrame) -> DataFrame:
    """docs, all columns in order, with the texts of dedup_lines(docs, carry=True); untouched texts stay as they are."""
    at = position(docs, "text")
    text = F.when(F.col("n_dropped") > 0, F.col("text")).otherwise(F.col(f"c{at}"))
    return lines.select(*(text.alias("text") if i == at else F.col(f"c{i}") for i in range(len(docs.columns)))).toDF(*docs.columns)


def keep_rows(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """One row of docs for each kept id, and all rows with a null id; of rows that share an id the same one in every run."""
    at, names = position(docs, "doc_id"), docs.columns
    plain, ids = _plain(docs), kept.select(F.col("doc_id").alias("kept_id")).distinct()
    stays = plain.join(ids, F.col(f"c{at}") == F.col("kept_id"), "left_semi")
    order = F.xxhash64(*(c for c, kind in plain.dtypes if not kind.startswith("map")))
    stays = stays.withColumn("nth", F.row_number().over(W.partitionBy(f"c{at}").orderBy(order))).where("nth = 1").drop("nth")
    return stays.unionByName(plain.where(F.col(f"c{at}").isNull())).toDF(*names)
