"""What the operators share: column picking, character classes, tables in the shared folder."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WS_CHARS = " \t\n\x0b\x0c\r"
WS_RUN = r"[\x20\x09-\x0D]+"
WORD_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def pick(df: DataFrame, **names: str) -> DataFrame:
    """Only the columns named by the keyword values, under the keyword names.

    A column is found by its exact name, else by its name in any case; the
    first of several wins, so further columns that differ only in case, or that
    carry a name an operator uses inside, do no harm.
    """
    at = {new: position(df, old) for new, old in names.items()}
    plain = df.toDF(*(f"__c{i}" for i in range(len(df.columns))))
    return plain.select(*(F.col(f"__c{i}").alias(new) for new, i in at.items()))


def position(df: DataFrame, name: str) -> int:
    for same in (lambda c: c == name, lambda c: c.lower() == name.lower()):
        for i, c in enumerate(df.columns):
            if same(c):
                return i
    raise ValueError(f"no column {name!r} among {df.columns}")


def ascii_lower(c: Column) -> Column:
    """A-Z to a-z and nothing else; plain lower() when all characters are ASCII."""
    return F.when(F.octet_length(c) == F.length(c), F.lower(c)).otherwise(F.translate(c, UPPER, LOWER))


def row_key(doc_id: Column, text: Column) -> list[Column]:
    """Names a row by what it holds: equal rows share a key and get equal results."""
    return [doc_id.alias("doc_id"), F.xxhash64(text).alias("rk1"), F.xxhash64(F.lit(1), text).alias("rk2")]


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir of the session; a folder in the warehouse where that is unset, but on a cluster no local one."""
    given = spark.conf.get("spark.checkpoint.dir", None)
    if not given:
        given = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
        if given.startswith(("file:", "/")) and not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return given.rstrip("/")


def table(df: DataFrame, name: str, partition_by: str | None = None, rows: int | None = None, rows_per_file: int = 100_000) -> DataFrame:
    """df, written to the shared folder and read again: cuts lineage, outlives executors.

    rows, where it is known that df has no more of them, keeps small tables from being written as many files.
    """
    spark = df.sparkSession
    if rows is not None:
        df = df.coalesce(max(1, -(-rows // rows_per_file)))
    path = f"{shared_dir(spark)}/gritmill-{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    writer = df.write.option("compression", "zstd")
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, name: str, n: int, *by: str, order: tuple[str, ...] = ()) -> DataFrame:
    """df, written to the shared folder in n buckets and read again: joins of such tables by these columns need no exchange.

    Only a table can be bucketed, so there is one while it is read back; what
    stays is a folder like those of table().
    """
    spark, unique = df.sparkSession, f"gritmill_{name.replace('-', '_')}_{uuid.uuid4().hex}"
    path = f"{shared_dir(spark)}/gritmill-{spark.sparkContext.applicationId}/{unique}"
    writer = df.repartition(n, *by).write.option("compression", "zstd").option("path", path).bucketBy(n, *by)
    (writer.sortBy(*order) if order else writer).saveAsTable(unique)
    out = spark.table(unique)
    spark.sql(f"DROP TABLE {unique}")
    return out


def clear_tables(spark: SparkSession) -> None:
    """Removes every table that this application wrote with table()."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/gritmill-{spark.sparkContext.applicationId}")
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
