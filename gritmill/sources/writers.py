"""Sinks: stage tables, routed writes, reports, id lists, JSON."""

from __future__ import annotations

import uuid
import warnings

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .readers import BOM, exists



def scratch(spark: SparkSession, name: str) -> str:
    """A new folder's path in the shared folder of the session; in the warehouse where none is set."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def write_stage(df: DataFrame, path: str, if_exists: str = "overwrite") -> DataFrame:
    """df as zstd Parquet, read again with its schema.

    'overwrite' warns and replaces a table that is there, 'reuse' keeps a whole one, 'error' refuses.
    """
    spark = df.sparkSession
    if if_exists == "overwrite" and exists(spark, path):
        warnings.warn(f"{path} is there and gets overwritten", stacklevel=2)
    if if_exists == "reuse" and exists(spark, f"{path}/_SUCCESS"):
        return spark.read.schema(df.schema).parquet(path)
    df.write.mode("overwrite" if if_exists in ("overwrite", "reuse") else "errorifexists").option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def write_routes(scored: DataFrame, route: Column, names: tuple[str, ...], directory: str) -> dict[str, DataFrame]:
    """Every row once, under its route's folder, in one pass; the whole ('all') and each named route, with its full schema also when empty."""
    scored.withColumn("route", route).write.mode("overwrite").option("compression", "zstd").partitionBy("route").parquet(directory)
    whole = scored.sparkSession.read.schema(StructType([*scored.schema.fields, StructField("route", StringType())])).parquet(directory)
    return {"all": whole.drop("route"), **{name: whole.where(F.col("route") == name).drop("route") for name in names}}


def append_ledger(df: DataFrame, path: str, run_id: str | None = None) -> str:
    """Appends rows to a Parquet ledger under a run id, by which a later reader can order runs."""
    run_id = run_id or uuid.uuid4().hex
    df.withColumn("run_id", F.lit(run_id)).write.mode("append").option("compression", "zstd").parquet(path)
    return run_id


def jsonl_to_parquet(spark: SparkSession, source: str, schema, target: str) -> DataFrame:
    from .readers import read_ledger

    return write_stage(read_ledger(spark, source, schema), target)


def write_csv(df: DataFrame, path: str, bom: bool = True) -> None:
    """A report as one CSV file with a header; with a byte order mark if asked for. For small tables."""
    first, *rest = df.columns
    named = df.withColumnRenamed(first, BOM + first) if bom else df
    named.coalesce(1).write.mode("overwrite").option("header", True).option("emptyValue", "").csv(path)


def write_json(df: DataFrame, path: str, array: bool = False) -> None:
    """JSON lines, or for small tables one array."""
    if array:
        whole = df.agg(F.to_json(F.collect_list(F.struct(*df.columns))).alias("value"))
        whole.coalesce(1).write.mode("overwrite").text(path)
    else:
        df.write.mode("overwrite").json(path)


def ids_by_class(df: DataFrame, by: str, value: str | None = None, key: str = "item_id", distinct: bool = False, ordered: bool = False) -> DataFrame:
    """(category, id) as text, for one class or all, null and blank ids left out."""
    rows = df.where(F.col(by) == value) if value is not None else df.where(F.col(by).isNotNull())
    out = rows.select(F.col(by).cast("string").alias("category"), F.trim(F.col(key).cast("string")).alias("id")).where("id <> ''")
    out = out.distinct() if distinct else out
    return out.orderBy("category", "id") if ordered else out


def write_id_lists(df: DataFrame, path: str, **options) -> None:
    """One text file an id a line under category=... folders."""
    ids_by_class(df, **options).select("category", F.col("id").alias("value")).write.mode("overwrite").partitionBy("category").text(path)


def preview(df: DataFrame, n: int = 5) -> dict:
    """Schema, types and the first rows, for a console."""
    return {"columns": df.columns, "dtypes": dict(df.dtypes), "rows": [r.asDict(recursive=True) for r in df.limit(n).collect()]}
