"""Sources: sharded CSV by header, JSON ledgers, Parquet with footers, listings."""

from __future__ import annotations

import csv
from collections import defaultdict
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..schemas import conform, empty

BOM = "\ufeff"


def _fs(spark: SparkSession, path: str):
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop, hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def list_paths(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a glob, sorted, on any file system that Spark reads."""
    path, fs = _fs(spark, pattern)
    found = fs.globStatus(path)
    return sorted(str(s.getPath()) for s in found) if found else []


def exists(spark: SparkSession, path: str) -> bool:
    hadoop, fs = _fs(spark, path)
    return fs.exists(hadoop)


def _first_line(spark: SparkSession, path: str) -> str:
    """The first line of a text file, which may be compressed; nothing else is read and no job runs."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    hadoop, fs = _fs(spark, path)
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(hadoop)
    stream = fs.open(hadoop)
    try:
        plain = codec.createInputStream(stream) if codec else stream
        return jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(plain, "UTF-8")).readLine() or ""
    finally:
        stream.close()


def read_shards(spark: SparkSession, directory: str, glob: str, schema: StructType, sep: str = ",", on_missing: str = "error", rename: dict[str, str] | None = None, provenance: bool = False, multi_line: bool = True) -> DataFrame:
    """Delimited shards as one table with exactly the schema's columns, bound by name.

    Spark binds CSV columns by place, so shards are read by groups that share a
    header. Rows of another length than their header are dropped, empty and
    quoted empty cells are null, what cannot be cast is null, columns a shard
    lacks are null. rename maps header names to schema names. Without any shard:
    an error, or an empty table with on_missing='empty'. A shard is one task
    unless multi_line is False, which forbids line breaks in cells.
    """
    paths = list_paths(spark, f"{directory.rstrip('/')}/{glob}")
    if not paths:
        if on_missing == "empty":
            return empty(spark, schema)
        raise FileNotFoundError(f"no {glob} in {directory}")
    groups: dict[str, list[str]] = defaultdict(list)
    for p in paths:
        groups[_first_line(spark, p).lstrip(BOM)].append(p)
    parts = []
    for head, members in groups.items():
        if not head:
            continue
        names = [n.strip() for n in next(csv.reader([head], delimiter=sep))]
        own = [(rename or {}).get(n, n) for n in names]
        text = StructType()
        for i in range(len(own)):
            text = text.add(f"c{i}", StringType())
        options = {"header": True, "sep": sep, "mode": "DROPMALFORMED", "enforceSchema": True, "multiLine": multi_line, "escape": '"', "emptyValue": None, "nullValue": ""}
        rows = spark.read.options(**{k: v for k, v in options.items() if v is not None}).schema(text).csv(members)
        cells = [F.nullif(F.col(f"c{i}"), F.lit("")).alias(n) for i, n in enumerate(own)]
        rows = rows.select(*cells, F.col("_metadata.file_name").alias("source_file"))
        part = conform(rows, schema)
        parts.append(rows.select(*(F.col(f.name).try_cast(f.dataType).alias(f.name) if f.name in own else F.lit(None).cast(f.dataType).alias(f.name) for f in schema), "source_file") if provenance else part)
    return reduce(DataFrame.unionByName, parts) if parts else empty(spark, schema)


def read_ledger(spark: SparkSession, path: str, schema: StructType, keep_corrupt: bool = False, on_missing: str = "empty") -> DataFrame:
    """JSON lines by a fixed schema; blank lines vanish, broken ones are dropped or kept as _corrupt."""
    if not list_paths(spark, path):
        if on_missing == "error":
            raise FileNotFoundError(path)
        return empty(spark, schema)
    whole = StructType([*schema.fields, StructField("_corrupt", StringType())])
    rows = spark.read.schema(whole).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt").json(path)
    return rows if keep_corrupt else rows.where(F.col("_corrupt").isNull()).drop("_corrupt")


def read_first(spark: SparkSession, *paths: str) -> DataFrame:
    """The first Parquet path that exists: the enriched table if there is one, else the plain one."""
    for p in paths:
        if list_paths(spark, p):
            return spark.read.parquet(p)
    raise FileNotFoundError(f"none of {paths}")


def read_stage(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def point_lookup(df: DataFrame, key: str, value, *order: Column) -> DataFrame:
    """The row of one key, the first by the order if there are several; the filter reaches the scan."""
    rows = df.where(F.col(key) == value)
    return (rows.orderBy(*order) if order else rows).limit(1)


def file_listing(spark: SparkSession, directory: str, glob: str = "*", recursive: bool = True) -> DataFrame:
    """(path, length, modificationTime) of files; contents are not read."""
    reader = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", str(recursive).lower())
    return reader.load(directory).select(F.regexp_replace("path", "^file:/*", "/").alias("path"), "length", "modificationTime")


def existing_files(df: DataFrame, path: str, listing: DataFrame) -> DataFrame:
    """Rows whose path column names a listed file."""
    return df.where(F.col(path).isNotNull()).join(listing.select(F.col("path").alias(path)), path, "left_semi")


FOOTER = "path string, n_rows bigint, n_columns int, row_groups int, size_bytes bigint, format_version string, created_by string, columns string, error string"
TABLE = "file string, n_files bigint, n_rows bigint, n_columns int, row_groups bigint, size_bytes bigint, columns string, error string"
#: Bytes read of a file at first, which hold most footers; a longer one is read again, whole.
TAIL = 8192


def _footers(spark: SparkSession, path: str, recursive: bool, glob: str) -> Iterator[tuple]:
    """(path, size, metadata, column names, error) a file, by path; a file that cannot be read has an error instead of metadata.

    Spark lists the files; threads of the driver read their ends, and nothing else
    of them, through Hadoop's file systems.
    """
    import pyarrow as pa
    import pyarrow.parquet as pq

    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    hadoop = jvm.org.apache.hadoop.fs.Path
    reader = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", str(recursive).lower())
    files = sorted(map(tuple, reader.load(path).select("path", "length").collect()))

    def end(name: str, start: int) -> bytes:
        p = hadoop(name)
        stream = p.getFileSystem(conf).open(p)
        try:
            stream.seek(start)
            return stream.readAllBytes()
        finally:
            stream.close()

    def footer(file: tuple[str, int]) -> tuple:
        name, size = file
        try:
            content = end(name, max(0, size - TAIL))
            whole = int.from_bytes(content[-8:-4], "little") + 8
            if content[-4:] == b"PAR1" and len(content) < whole <= size:
                content = end(name, size - whole)
            m = pq.read_metadata(pa.BufferReader(content))
            return name, size, m, m.schema.to_arrow_schema().names, None
        except Exception as e:  # noqa: BLE001  a broken file is a finding
            return name, size, None, None, str(e)[:500]

    with ThreadPoolExecutor(32) as pool:
        yield from pool.map(footer, files)


def parquet_summary(spark: SparkSession, directory: str, recursive: bool = False, glob: str = "*.parquet") -> DataFrame:
    """One row a file from its footer; a file that cannot be read is a row with an error."""
    rows = []
    for path, size, m, names, error in _footers(spark, directory, recursive, glob):
        if m is None:
            rows.append((path, None, None, None, size, None, None, None, error))
        else:
            rows.append((path, m.num_rows, len(names), m.num_row_groups, size, m.format_version, m.created_by, ",".join(names), None))
    return spark.createDataFrame(rows, FOOTER)


def parquet_tables(spark: SparkSession, directory: str, glob: str = "*.parquet") -> DataFrame:
    """One row a table from footers: a file, or a folder with all the files that Spark reads of it.

    Columns stand in order of the first file that has them, those of partition
    folders behind the file's. A table of which a file cannot be read has an error
    and no counts.
    """
    pattern = f"{directory.rstrip('/')}/{glob}"
    found = list_paths(spark, pattern)
    tables: dict[str, dict] = {}
    for path, size, m, names, error in _footers(spark, pattern, True, "*") if found else ():
        file, *inner = path.split("/")[found[0].count("/") :]
        if any("=" not in k for k in inner[:-1]):
            continue
        t = tables.setdefault(file, {"n_files": 0, "n_rows": 0, "row_groups": 0, "size": 0, "columns": {}, "error": None})
        t["n_files"] += 1
        t["size"] += size
        if m is None:
            t["error"] = t["error"] or f"{path}: {error}"
            continue
        t["n_rows"] += m.num_rows
        t["row_groups"] += m.num_row_groups
        t["columns"].update(dict.fromkeys([*names, *(k.partition("=")[0] for k in inner[:-1] if "=" in k)]))
    rows = []
    for file, t in tables.items():
        counts = (None, None, None) if t["error"] else (t["n_rows"], len(t["columns"]), t["row_groups"])
        rows.append((file, t["n_files"], *counts, t["size"], None if t["error"] else ",".join(t["columns"]), t["error"]))
    return spark.createDataFrame(rows, TABLE)
