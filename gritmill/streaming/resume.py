"""Incremental runs: a file stream, processed to its end, into an idempotent result table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ..operators.dedupe import latest_per_key, pending
from ..sources.readers import exists


def results_so_far(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    ledger = StructType([*schema.fields, StructField("batch_id", LongType())])
    return spark.read.schema(ledger).parquet(path) if exists(spark, path) else spark.createDataFrame([], ledger)


def run_incremental(spark: SparkSession, source: str, schema: StructType, process: Callable[[DataFrame], DataFrame], results: str, checkpoint: str, on: str = "item_id", ok: str | None = None, max_files: int = 16) -> int:
    """Processes source files that no earlier run has seen; the number of batches it took.

    Each micro-batch leaves out ids that the results have already (only good
    ones with ok), appends its own under its batch id, and is safe to repeat.
    max_files bounds what is in flight.
    """
    batches = 0

    def write(batch: DataFrame, batch_id: int) -> None:
        nonlocal batches
        batches += 1
        out_schema = process(spark.createDataFrame([], schema)).schema
        done = results_so_far(spark, results, out_schema)
        todo = pending(batch.dropDuplicates([on]), done, on, ok)
        process(todo).withColumn("batch_id", F.lit(batch_id).cast("bigint")).write.mode("append").parquet(results)

    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(source)
    stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return batches


def latest_results(spark: SparkSession, results: str, schema: StructType, on: str = "item_id") -> DataFrame:
    """One row an id, of the last batch that wrote it."""
    return latest_per_key(results_so_far(spark, results, schema), on, "batch_id", nulls="first")
