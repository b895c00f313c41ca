"""Line dedup: levelled sorted runs of line hashes, compacted periodically.

A batch of documents first becomes a memtable (line hash, number of documents).
It is merge-anti-joined with the entries of the runs that have reached the
threshold already, and what is left is added as a sorted run of level 0. When a
level holds `fanout` runs they are merged into one run of the next level.

Runs are bucketed and sorted by line hash, all in as many buckets: a batch is
shuffled once to meet them, and runs meet each other where they lie.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WS_CHARS, ascii_lower, bucketed, position, read, row_key, table

KEY = ["h1", "h2"]


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(WS_CHARS)))


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _hashes(c: Column) -> list[Column]:
    """128 bits: at 10^12 different lines two are still unlikely to meet."""
    return [F.xxhash64(c).alias("h1"), F.xxhash64(F.lit(1), c).alias("h2")]


def memtables(docs: DataFrame, n_batches: int) -> DataFrame:
    """(batch, h1, h2, n): in how many documents of each batch a line key occurs."""
    keys = F.array_distinct(F.transform(lines_of(F.col("text")), line_key))
    lines = docs.select(F.pmod(F.xxhash64(F.lit(7), "doc_id"), F.lit(n_batches)).cast("int").alias("batch"), F.explode(keys).alias("key"))
    lines = lines.where(F.col("key") != "")
    return lines.select("batch", *_hashes(F.col("key"))).groupBy("batch", *KEY).agg(F.count("*").alias("n"))


class LineRuns:
    """Sorted runs of (h1, h2, n) by level; n is a count of documents."""

    def __init__(self, min_docs: int, fanout: int = 4, n_buckets: int = 8):
        self.min_docs, self.fanout, self.n_buckets = min_docs, fanout, n_buckets
        self.levels: list[list[DataFrame]] = [[]]

    def add(self, memtable: DataFrame) -> None:
        """One batch: lines that a run already holds often enough need no more counting."""
        memtable = memtable.select(*KEY, "n").repartition(self.n_buckets, *KEY)
        for run in (r for level in self.levels for r in level):
            known = run.where(F.col("n") >= self.min_docs).select(*KEY)
            memtable = memtable.join(known.hint("merge"), KEY, "left_anti")
        self.levels[0].append(self._run(memtable, 0))
        self._compact()

    def _run(self, rows: DataFrame, level: int) -> DataFrame:
        return bucketed(rows, f"line-run-{level}", self.n_buckets, *KEY, order=tuple(KEY))

    def _compact(self) -> None:
        for k, level in enumerate(self.levels):
            if len(level) < self.fanout:
                break
            if k + 1 == len(self.levels):
                self.levels.append([])
            self.levels[k + 1].append(self._run(self._merged(level), k + 1))
            self.levels[k] = []

    def _merged(self, runs: list[DataFrame]) -> DataFrame:
        """The runs merged by hash, bucket by bucket.

        The filter, always true, makes the scans give rows: of columnar scans the union (Spark 4.1) keeps the buckets'
        partitioning by name only and would put equal hashes into different tasks.
        """
        return reduce(DataFrame.unionByName, [r.where(F.col("n") > 0) for r in runs]).groupBy(*KEY).agg(F.sum("n").alias("n"))

    def frequent(self) -> DataFrame:
        merged = self._merged([r for level in self.levels for r in level])
        return merged.where(F.col("n") >= self.min_docs).select(*KEY)


def build_runs(docs: DataFrame, min_docs: int, n_batches: int = 4, fanout: int = 4, lines_per_bucket: int = 2_000_000) -> LineRuns:
    """Runs over docs(doc_id, text); one scan makes the memtables of all batches."""
    memory = table(memtables(docs, n_batches), "line-memtables", "batch")
    runs = LineRuns(min_docs, fanout, max(8, -(-memory.count() // lines_per_bucket)))
    for b in range(n_batches):
        runs.add(memory.where(F.col("batch") == b))
    return runs


def dedup_lines(docs: DataFrame, min_docs: int = 10, n_batches: int = 4, fanout: int = 4, broadcast_rows: int = 100_000, id_col: str = "doc_id", text_col: str = "text", carry: bool = False) -> DataFrame:
    """(doc_id, text, n_lines, n_dropped): every row, without the lines found in min_docs documents.

    A line's key is the line without white space at its ends and with A-Z in
    lower case; empty keys are never dropped. Each row counts as a document of
    its own, also when ids or whole rows repeat. A null text is one empty line;
    a text that loses all its lines becomes "". An empty table gives no rows.
    With carry the columns of docs follow, as c0, c1, ....
    The set of frequent keys is broadcast only when it has been counted and has
    at most broadcast_rows rows; beyond that a shuffled semi join is used.
    """
    columns = [f"c{i}" for i in range(len(docs.columns))]
    plain = docs.toDF(*columns).withColumns({"doc_id": F.col(f"c{position(docs, id_col)}"), "text": F.col(f"c{position(docs, text_col)}")})
    carried = columns if carry else []
    docs = plain.select("doc_id", "text")
    frequent = table(build_runs(docs, min_docs, n_batches, fanout).frequent(), "line-frequent")
    small = frequent.count() <= broadcast_rows
    keyed = docs.select(*row_key(F.col("doc_id"), F.col("text")), F.posexplode(F.transform(lines_of(F.col("text")), line_key)).alias("pos", "key"))
    keyed = keyed.where(F.col("key") != "").select("doc_id", "rk1", "rk2", "pos", *_hashes(F.col("key")))
    hits = keyed.join(F.broadcast(frequent) if small else frequent, KEY, "left_semi")
    drops = hits.groupBy("doc_id", "rk1", "rk2").agg(F.collect_set("pos").alias("drops"))
    drops = drops.toDF("doc_id2", "rk12", "rk22", "drops")
    whole = plain.select(*row_key(F.col("doc_id"), F.col("text")), "text", *carried)
    joined = whole.join(drops, F.col("doc_id").eqNullSafe(F.col("doc_id2")) & (F.col("rk1") == F.col("rk12")) & (F.col("rk2") == F.col("rk22")), "left")
    lines = lines_of(F.col("text"))
    rows = joined.withColumn("n_lines", F.size(lines).cast("long")).withColumn("lines", F.when(F.col("drops").isNotNull(), lines))
    # array_except keeps order and hashes its second argument: linear in the lines
    left = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("drops"))
    kept = F.array_join(F.transform(left, lambda i: F.get(F.col("lines"), i)), "\n")
    return rows.select(
        "doc_id",
        F.when(F.col("drops").isNull(), F.coalesce("text", F.lit(""))).otherwise(kept).alias("text"),
        "n_lines",
        F.when(F.col("drops").isNull(), F.lit(0)).otherwise(F.size("drops")).cast("long").alias("n_dropped"),
        *carried,
    )


def op1_line_dedup(spark, sf_dir):
    out = dedup_lines(read(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


OP1_SQL = r"""
WITH l AS (
  SELECT doc_id, p, x, trim(x, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS t
  FROM (SELECT doc_id, unnest(a) AS x, generate_subscripts(a, 1) AS p
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS a FROM documents))),
k AS (SELECT doc_id, p, x, translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM l),
f AS (SELECT k FROM k WHERE k <> '' GROUP BY k HAVING count(DISTINCT doc_id) >= 10)
SELECT k.doc_id, count(*) AS n_lines, count(f.k) AS n_dropped,
       sha256(coalesce(string_agg(k.x, chr(10) ORDER BY k.p) FILTER (WHERE f.k IS NULL), '')) AS kept_sha256
FROM k LEFT JOIN f ON k.k = f.k GROUP BY k.doc_id
"""
