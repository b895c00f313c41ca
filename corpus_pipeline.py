"""A corpus pipeline of five operators; each stage's rows are written and read again by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gritmill.llm import decontam, line_dedup, mixing, near_dedup, toxicity
from gritmill.llm.common import read, table
from gritmill.llm.stages import keep_rows, replace_text


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier rejects go; nulls and empty texts stay."""
    return toxicity.drop_toxic(docs, toxicity.fit(docs, read(spark, sf_dir, "labels")))


def remove_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in ten documents or more go; every document stays, if need be with an empty text."""
    return replace_text(docs, line_dedup.dedup_lines(docs, carry=True))


def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates (five-word shingles, 0.8) the document with the smallest id stays.

    Texts without words, now or before, are near nothing and stay.
    """
    kept = near_dedup.near_duplicates(docs, size=5, percent=80)
    return keep_rows(docs, kept.where("kept"))


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of the benchmark go."""
    found = decontam.find_benchmark(docs, read(spark, sf_dir, "benchmark"), whole_rows=True)
    return found.where("n_hit = 0").select(*(f"c{i}" for i in range(len(docs.columns)))).toDF(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture: a row per document with the words it gives and the place of its first copy."""
    out = mixing.mix_sources(docs).withColumn("first_position", F.round(F.get("positions", F.lit(0)), 6))
    return out.select("doc_id", "source", "size", "source_size", "target", "taken", "first_position").orderBy(F.col("first_position").asc_nulls_last(), "doc_id")


STAGES = [
    ("toxicity", remove_toxic),
    ("line_dedup", remove_repeated_lines),
    ("near_dedup", remove_near_duplicates),
    ("decontamination", remove_benchmark),
    ("mixing", mix),
]

#: No SQL says what a compressor makes of a text.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = table(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
