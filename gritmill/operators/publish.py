"""Ledgers, status statistics, manifests, organised files."""

from __future__ import annotations

import os
import shutil
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import safe, safe_name
from ..schemas import columns_like, preferred_first

# What a missing ledger entry stands for.
DOWNLOAD_DEFAULTS = {"download_ok": False, "download_error": "", "local_image_relpath": "", "local_image_path": "", "image_ext": "", "downloaded_at": "", "download_attempts": 0, "from_cache": False}


def ledger_join(items: DataFrame, ledger: DataFrame, on: str | list[str] = "item_id", defaults: dict | None = None, suffix: str = "_dl") -> DataFrame:
    """items ⟕ ledger on one or more keys; a ledger column that items has already gets the suffix, gaps get the defaults."""
    keys = [on] if isinstance(on, str) else list(on)
    clash = {c: c + suffix for c in ledger.columns if c not in keys and c in items.columns}
    out = items.join(ledger.withColumnsRenamed(clash), keys, "left")
    fill = {c: v for c, v in (DOWNLOAD_DEFAULTS if defaults is None else defaults).items() if c in out.columns}
    return out.fillna(fill) if fill else out


def status_stats(df: DataFrame, ok: str = "download_ok", names: tuple[str, str, str] = ("classified_final_total", "downloaded_ok", "download_failed")) -> DataFrame:
    """(metric, value): all rows, rows that are ok, all others; one pass."""
    good = F.coalesce(F.col(ok), F.lit(False))
    one = df.agg(F.count("*").alias("a"), F.count_if(good).alias("b"), F.count_if(~good).alias("c"))
    return one.select(F.expr(f"stack(3, '{names[0]}', a, '{names[1]}', b, '{names[2]}', c) AS (metric, value)"))


def status_by_class(df: DataFrame, by: str, ok: str = "download_ok") -> DataFrame:
    good = F.when(F.coalesce(F.col(ok), F.lit(False)), "downloaded_ok").otherwise("download_failed")
    return df.groupBy(F.col(by).alias("category"), good.alias("download_status")).agg(F.count("*").alias("count")).orderBy(F.col("category").asc_nulls_last(), F.col("download_status").desc())


def cached_split(items: DataFrame, ledger: DataFrame, files: DataFrame, on: str = "item_id", path: str = "local_image_path") -> tuple[DataFrame, DataFrame]:
    """(done, todo): items with a good ledger row whose file is still listed, and the others."""
    good = ledger.where(F.col("download_ok")).join(files.select(F.col("path").alias(path)), path, "left_semi")
    return items.join(good.select(on), on, "left_semi"), items.join(good.select(on), on, "left_anti")


def split_status(df: DataFrame, ok: str = "download_ok") -> tuple[DataFrame, DataFrame]:
    good = F.coalesce(F.col(ok), F.lit(False))
    return df.where(good), df.where(~good)


def final_manifest(df: DataFrame, preferred: list[str], prefixes: tuple[str, ...] = ("review_", "review1_", "review2_", "aesthetic_")) -> dict[str, DataFrame]:
    """manifest (organised rows), metadata (preferred and final columns), log (all rows), failures, stats."""
    good = F.coalesce(F.col("final_image_ok"), F.lit(False))
    manifest = df.where(good)
    own = [c for c in preferred if c in df.columns]
    final = [c for c in ("final_label", "final_source", "final_image_relpath") if c in df.columns]
    base = [c for c in ("item_id", "category", "final_label", "final_source", "local_image_path", "final_image_relpath", "final_image_ok", "final_image_error") if c in df.columns]
    log = df.select(*dict.fromkeys(base + columns_like(df, *prefixes)))
    stats = manifest.groupBy("final_label", "final_source").agg(F.count("*").alias("count")).orderBy(F.col("count").desc(), "final_label", "final_source")
    return {"manifest": preferred_first(manifest, *own), "metadata": manifest.select(*dict.fromkeys(own + final)), "log": log, "failures": log.where(~good), "stats": stats}


def organise_files(df: DataFrame, root: str, on: str = "item_id", path: str = "local_image_path", label: str = "final_label", move: bool = False) -> DataFrame:
    """df with final_image_relpath, _ok, _error: each file copied or moved to root/images/label/id.ext.

    root must be a folder that all workers share; a failure is a row.
    """
    ext = F.coalesce(F.nullif(F.regexp_extract(safe(F.col(path)), r"(\.[^./\\]+)$", 1), F.lit("")), F.lit(".jpg"))
    target = F.concat_ws("/", F.lit("images"), safe_name(F.col(label), "slashes"), F.concat(F.col(on).cast("string"), ext))
    rows = df.where(F.col(label).isNotNull() & F.col(path).isNotNull()).withColumn("final_image_relpath", target)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            ok, error = [], []
            for source, rel in zip(frame[path], frame["final_image_relpath"], strict=True):
                try:
                    goal = os.path.join(root, rel)
                    os.makedirs(os.path.dirname(goal), exist_ok=True)
                    (shutil.move if move else shutil.copy2)(source, goal)
                    ok.append(True)
                    error.append("")
                except OSError as e:
                    ok.append(False)
                    error.append(str(e)[:500])
            yield frame.assign(final_image_relpath=[r if k else "" for r, k in zip(frame["final_image_relpath"], ok, strict=True)], final_image_ok=ok, final_image_error=error)

    from pyspark.sql.types import BooleanType, StringType, StructField, StructType

    schema = StructType([*rows.schema.fields, StructField("final_image_ok", BooleanType()), StructField("final_image_error", StringType())])
    return rows.mapInPandas(run, schema)
