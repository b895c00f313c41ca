"""Mixing sources to target weights along a time-varying curriculum.

Every source has a schedule: its weight as a piecewise linear function of the
training time 0..1. The schedule's integral, scaled to the source's target, is
the cumulative demand for its words. Documents of a source are laid end to end
in a fixed pseudo-random order, pass after pass; inverting the demand at the
place where a copy begins gives the time at which training reads it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import WS_RUN, pick, read, table

#: Segments (t0, t1, weight at t0, weight at t1): light sources fade out, heavy ones fade in.
FADE_OUT, FLAT, FADE_IN = [(0.0, 1.0, 1.5, 0.5)], [(0.0, 1.0, 1.0, 1.0)], [(0.0, 1.0, 0.5, 1.5)]
WEIGHTS = (1, 2, 3)
SCHEDULES = (FADE_OUT, FLAT, FADE_IN)
MAX_PASSES = 3


def n_words(text: Column) -> Column:
    """Number of runs of characters other than white space; 0 for null."""
    gaps = F.coalesce(text, F.lit(""))
    parts = F.split(gaps, WS_RUN, -1)
    edges = F.when(F.element_at(parts, 1) == "", 1).otherwise(0) + F.when((F.size(parts) > 1) & (F.element_at(parts, -1) == ""), 1).otherwise(0)
    return (F.size(parts) - edges).cast("long")


def _ranked(sizes: DataFrame) -> DataFrame:
    """sizes with rank, the number of its source in their order, nulls last; a range sort, counted by partition."""
    lower = (1 << 33) - 1  # a monotonically increasing id is the partition and, in 33 bits, the row in it
    placed = table(sizes.orderBy(F.col("source").asc_nulls_last()).withColumn("id", F.monotonically_increasing_id()), "mix-order")
    part = F.shiftright("id", 33)
    counts = placed.groupBy(part.alias("part")).agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    counts = counts.select("part", before.alias("before"))  # a row a partition of the sort
    rows = placed.withColumn("part", part).join(F.broadcast(counts), "part")
    return rows.withColumn("rank", F.col("before") + F.col("id").bitwiseAND(lower)).drop("part", "before", "id")


def source_targets(sizes: DataFrame, weights=WEIGHTS, max_passes: int = MAX_PASSES) -> DataFrame:
    """(source, source_size, rank, target) from (source, source_size).

    Water-filling: words are shared by weight, what lies above max_passes times
    a source's size is shared again among the others. Only three sums come to
    the driver in each round. A source without words has target 0.
    """
    weight = F.element_at(F.array(*(F.lit(w) for w in weights)), (F.col("rank") % len(weights) + 1).cast("int"))
    ranked = table(_ranked(sizes).withColumn("weight", weight).withColumn("cap", F.col("source_size") * max_passes), "mix-sources")
    total = ranked.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    full, n_full = F.lit(False), -1
    while True:
        capped, open_weight, n = ranked.agg(F.coalesce(F.sum(F.when(full, F.col("cap"))), F.lit(0)), F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0)), F.count_if(full)).first()
        fair = F.col("weight") * F.lit(float(total - capped)) / F.lit(float(open_weight)) if open_weight else F.col("cap")
        if n == n_full or not open_weight:
            break
        n_full, full = n, full | (fair > F.col("cap"))
    return ranked.select("source", "source_size", "rank", F.when(full, F.col("cap")).otherwise(fair).cast("double").alias("target"))


def _segments(schedules) -> list[list[tuple]]:
    """Each schedule's segments with the share of the integral before and in them."""
    out = []
    for s in schedules:
        areas = [(t1 - t0) * (a + b) / 2 for t0, t1, a, b in s]
        done = 0.0
        rows = []
        for (t0, t1, a, b), area in zip(s, areas, strict=True):
            rows.append((t0, t1, a, b, done / sum(areas), area / sum(areas), sum(areas)))
            done += area
        out.append(rows)
    return out


def when_demanded(share: Column, rank: Column, schedules=SCHEDULES) -> Column:
    """The time t at which the integral of a schedule reaches this share of its whole."""
    chosen = F.lit(None).cast("double")
    for k, rows in enumerate(_segments(schedules)):
        t = F.lit(None).cast("double")
        for t0, t1, a, b, before, _, whole in reversed(rows):
            slope, need = (b - a) / (t1 - t0), (share - F.lit(before)) * F.lit(whole)
            at = need / F.lit(a) if slope == 0 else (F.sqrt(F.lit(a * a) + F.lit(2 * slope) * need) - F.lit(a)) / F.lit(slope)
            t = F.when(share >= before, F.lit(t0) + at).otherwise(t) if before else (F.lit(t0) + at if len(rows) == 1 else F.coalesce(t, F.lit(t0) + at))
        chosen = F.when(rank % len(schedules) == k, t).otherwise(chosen)
    return chosen


def mix_sources(docs: DataFrame, weights=WEIGHTS, schedules=SCHEDULES, max_passes: int = MAX_PASSES, rows_per_slice: int = 20_000, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(doc_id, size, source, source_size, target, taken, positions): one row per input row.

    A source's documents stand in the order of md5(doc_id); whole passes take
    every document, the last pass ends where the target is reached, inside a
    document if need be. taken counts the words of all passes, positions has the
    time of each copy that gives at least one word. Null texts and texts of
    white space have size 0 and are not taken; a null source is a source; rows
    with equal ids or equal content all count. An empty table gives no rows.

    Sums run over slices of the order, so that a source with a third of all
    rows is spread over as many tasks as it has slices of rows_per_slice rows.
    """
    docs = pick(docs, doc_id=id_col, text=text_col, source=source_col)
    sized = table(docs.select("doc_id", "source", n_words(F.col("text")).alias("size"), F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).alias("place")), "mix-sizes")
    n_slices = max(64, -(-sized.count() // rows_per_slice))
    sized = sized.withColumn("slice", F.floor(F.conv(F.substring("place", 1, 8), 16, 10).cast("long") * n_slices / 2**32).cast("long"))
    slices = table(sized.groupBy("source", "slice").agg(F.sum("size").alias("words")), "mix-slices")
    sources = source_targets(slices.groupBy("source").agg(F.sum("words").alias("source_size")), weights, max_passes)
    # A row per source and slice: what the slices before hold, and the source's figures.
    before = F.coalesce(F.sum("words").over(W.partitionBy("source").orderBy("slice").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    begun = slices.select("source", "slice", before.alias("offset"))
    sources = sources.withColumnRenamed("source", "source2")
    begun = begun.join(sources, begun.source.eqNullSafe(sources.source2)).select(F.col("source").alias("source2"), F.col("slice").alias("slice2"), "offset", "source_size", "rank", "target")
    rows = sized.join(begun, sized.source.eqNullSafe(begun.source2) & (sized.slice == begun.slice2))
    run = W.partitionBy("source", "slice").orderBy("place", "doc_id", "size").rowsBetween(W.unboundedPreceding, -1)
    rows = rows.withColumn("start", F.col("offset") + F.coalesce(F.sum("size").over(run), F.lit(0)))
    wanted = F.round("target").cast("long")
    passes = F.array(*(F.least(F.greatest(wanted - F.lit(p) * F.col("source_size") - F.col("start"), F.lit(0)), F.col("size")) for p in range(max_passes)))
    rows = rows.withColumn("passes", passes)
    places = F.array(*(F.when(F.get("passes", F.lit(p)) > 0, when_demanded((F.col("start") + F.lit(p) * F.col("source_size")) / F.col("target"), F.col("rank"), schedules)) for p in range(max_passes)))
    return rows.select("doc_id", "size", "source", "source_size", "target", F.aggregate("passes", F.lit(0).cast("long"), lambda a, x: a + x).alias("taken"), F.array_compact(places).alias("positions"))


def training_order(mixed: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """The mixture in reading order: a row per copy, range-sorted by position."""
    cols = keep or [c for c in mixed.columns if c != "positions"]
    copies = mixed.select(*cols, F.explode("positions").alias("position"))
    return copies.orderBy("position", "doc_id")


def op10_mixing(spark, sf_dir):
    out = mix_sources(read(spark, sf_dir, "documents")).withColumn("first_position", F.round(F.get("positions", F.lit(0)), 6))
    return out.select("doc_id", "size", "source_size", "target", "taken", "first_position").orderBy(F.col("first_position").asc_nulls_last(), "doc_id")


OP10_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')) AS size,
         md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS place FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source ASC NULLS LAST) - 1 AS rank FROM d GROUP BY source),
w AS (SELECT *, rank % 3 + 1 AS weight, 3 * source_size AS cap, (SELECT sum(source_size) FROM s) AS total FROM s),
fill AS (
  SELECT 0 AS step, source, source_size, rank, weight, cap, total, FALSE AS full_ FROM w
  UNION ALL
  SELECT step + 1, source, source_size, rank, weight, cap, total,
         full_ OR weight * CAST(total - coalesce(sum(CASE WHEN full_ THEN cap END) OVER (), 0) AS DOUBLE)
                  / CAST(sum(CASE WHEN full_ THEN 0 ELSE weight END) OVER () AS DOUBLE) > cap
  FROM fill WHERE step < 25),
t AS (SELECT source, source_size, rank,
        CASE WHEN full_ THEN CAST(cap AS DOUBLE)
             ELSE weight * CAST(total - coalesce(sum(CASE WHEN full_ THEN cap END) OVER (), 0) AS DOUBLE)
                  / CAST(sum(CASE WHEN full_ THEN 0 ELSE weight END) OVER () AS DOUBLE) END AS target
      FROM fill WHERE step = 25),
r AS (SELECT d.*, t.source_size, t.rank, t.target, CAST(round(t.target) AS BIGINT) AS wanted,
        CAST(coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY place, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
x AS (SELECT *, least(greatest(wanted - start, 0), size) AS p0, least(greatest(wanted - source_size - start, 0), size) AS p1,
        least(greatest(wanted - 2 * source_size - start, 0), size) AS p2, start / target AS share FROM r)
SELECT doc_id, size, source_size, target, CAST(p0 + p1 + p2 AS BIGINT) AS taken,
  CASE WHEN p0 > 0 THEN round(CASE rank % 3 WHEN 0 THEN 1.5 - sqrt(2.25 - 2 * share)
                                  WHEN 1 THEN share ELSE sqrt(0.25 + 2 * share) - 0.5 END, 6) END AS first_position
FROM x
"""
