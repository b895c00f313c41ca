"""Benchmark decontamination: one Aho-Corasick automaton over normalised windows of the benchmark.

Texts are scanned once, as normalised words between single spaces; offsets in
that form lead back to word numbers and, for the spans, to the original text.
"""

from __future__ import annotations

import re
import uuid
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import WORD_GAP, ascii_lower, pick, position, read, table

#: All ASCII but digits and letters separates words; bytes of other characters are word bytes.
TO_WORDS = bytes(c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in bytes(range(256)).lower())
WORD = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")  # in a text whose A-Z are not lower-cased yet


def windows(benchmark: DataFrame, size: int = 10, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(window, item_id), distinct: every run of `size` words of an item, or all words of a shorter one.

    Null and wordless items have no window; items with a null id are searched
    but not named.
    """
    items = pick(benchmark, item_id=id_col, text=text_col)
    words = F.filter(F.split(ascii_lower(F.col("text")), WORD_GAP, -1), lambda w: w != "")
    items = items.select(F.col("item_id").cast("string").alias("item_id"), words.alias("words")).where(F.size("words") > 0)
    starts = F.sequence(F.lit(0), F.greatest(F.size("words") - size, F.lit(0)))
    return items.select("item_id", F.explode(F.transform(starts, lambda i: F.array_join(F.slice("words", i + 1, size), " "))).alias("window")).distinct()


_BUILT: dict = {}


def _automaton(token: str, patterns):
    """The automaton over broadcast windows, built once a worker; None if there are no windows."""
    import ahocorasick

    if token not in _BUILT:
        auto = ahocorasick.Automaton()
        for window, items in patterns.value:
            key = f" {window} ".encode().decode("latin-1")
            auto.add_word(key, (len(key), window.count(" ") + 1, items))
        if len(auto):
            auto.make_automaton()
        _BUILT.clear()
        _BUILT[token] = auto if len(auto) else None
    return _BUILT[token]


def _search(spark, patterns: list[tuple[str, list[str]]]):
    """A function for mapInArrow over rows whose last column is the text: words, hits and items take its place."""
    token, patterns = uuid.uuid4().hex, spark.sparkContext.broadcast(patterns)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        auto = _automaton(token, patterns)
        for batch in batches:
            out = [[], [], [], [], []]
            for text in batch.column(batch.num_columns - 1):
                raw = text.as_py() or ""
                words = raw.encode().translate(TO_WORDS).split()
                plain = (b" " + b" ".join(words) + b" ").decode("latin-1")
                spans, named, starts = [], set(), None
                for end, (length, count, items) in auto.iter(plain) if auto else ():
                    if starts is None:  # where each word's space stands
                        starts = list(accumulate((len(w) + 1 for w in words), initial=0))
                    n = bisect_left(starts, end - length + 1)
                    spans.append((n, n + count))
                    named.update(items)
                merged = []
                for a, b in sorted(spans):
                    if merged and a <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], b)
                    else:
                        merged.append([a, b])
                places = []
                if merged:
                    at_words = [m.span() for m in WORD.finditer(raw)]
                    places = [{"start": at_words[a][0], "end": at_words[b - 1][1]} for a, b in merged]
                out[0].append(len(words))
                out[1].append(sum(b - a for a, b in merged))
                out[2].append(sorted(named))
                out[3].append([{"first": a, "last": b - 1} for a, b in merged])
                out[4].append(places)
            extra = [pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.list_(pa.string())), pa.array(out[3], WORDS), pa.array(out[4], SPANS)]
            names = ["n_words", "n_hit", "items", "hit_words", "spans"]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *extra], [*batch.schema.names[:-1], *names])

    return scan


WORDS = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))
SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
ADDED = "n_words long, n_hit long, items array<string>, hit_words array<struct<first:long,last:long>>, spans array<struct<start:long,end:long>>"


def find_benchmark(docs: DataFrame, benchmark: DataFrame, size: int = 10, max_windows: int = 2_000_000, id_col: str = "doc_id", text_col: str = "text", whole_rows: bool = False) -> DataFrame:
    """(doc_id, n_words, n_hit, items, hit_words, spans): what each row shares with the benchmark.

    spans are code point offsets in the original text. Null and empty texts
    have no words. Equal rows get equal results, an empty benchmark hits
    nothing, an empty table gives no rows. With whole_rows all columns of docs
    come first, as c0, c1, ..., in place of doc_id. The automaton goes to every
    worker, so windows are counted first; beyond max_windows the texts are
    searched for blocks of them, one after another.
    """
    found = table(windows(benchmark, size), "benchmark-windows")
    columns = [f"c{i}" for i in range(len(docs.columns))]
    plain = docs.toDF(*columns)
    text = F.col(f"c{position(docs, text_col)}").alias("text")
    rows = plain.select(*columns, text) if whole_rows else plain.select(F.col(f"c{position(docs, id_col)}").alias("doc_id"), text)
    n_blocks = -(-found.count() // max_windows)
    return _find(rows, found) if n_blocks <= 1 else _find_in_blocks(rows, found, n_blocks)


def _find(rows: DataFrame, found: DataFrame) -> DataFrame:
    patterns = [(r.window, r.ids) for r in found.groupBy("window").agg(F.array_compact(F.collect_set("item_id")).alias("ids")).collect()]
    added = StructType(rows.schema.fields[:-1] + StructType.fromDDL(ADDED).fields)
    return rows.mapInArrow(_search(rows.sparkSession, patterns), added)


def _find_in_blocks(rows: DataFrame, found: DataFrame, n_blocks: int) -> DataFrame:
    """One scan a block of windows; what the blocks find is merged by the text's hash."""
    key = [F.xxhash64("text").alias("rk1"), F.xxhash64(F.lit(1), "text").alias("rk2")]
    hits = None
    for k in range(n_blocks):
        part = _find(rows.select(*key, "text"), found.where(F.pmod(F.xxhash64("window"), F.lit(n_blocks)) == k)).where("n_hit > 0")
        hits = part if hits is None else hits.unionByName(part)
    at = lambda c, a, b: F.explode(F.flatten(F.transform(c, lambda s: F.sequence(s[a], s[b]))))
    words = hits.select("rk1", "rk2", at("hit_words", "first", "last").alias("w")).groupBy("rk1", "rk2").agg(F.array_sort(F.collect_set("w")).alias("w"))
    spans = hits.select("rk1", "rk2", F.explode("spans").alias("s")).groupBy("rk1", "rk2").agg(F.array_sort(F.collect_set("s")).alias("s"))
    items = hits.select("rk1", "rk2", F.explode_outer("items").alias("i")).groupBy("rk1", "rk2").agg(F.array_sort(F.collect_set("i")).alias("i"))
    merged = words.join(spans, ["rk1", "rk2"]).join(items, ["rk1", "rk2"])
    names = rows.columns[:-1]
    out = _find(rows.select(*names, *key, "text"), found.limit(0)).select(*names, "rk1", "rk2", "n_words").join(merged, ["rk1", "rk2"], "left")
    kinds = {f.name: f.dataType for f in StructType.fromDDL(ADDED).fields}
    empty = lambda c: F.array().cast(kinds[c])
    one = F.transform("w", lambda w: F.struct(w.alias("first"), w.alias("last")))
    return out.select(*names, "n_words", F.when(F.col("w").isNull(), 0).otherwise(F.size("w")).cast("long").alias("n_hit"), F.coalesce("i", empty("items")).alias("items"), F.coalesce(one, empty("hit_words")).alias("hit_words"), F.coalesce("s", empty("spans")).alias("spans"))


def op4_benchmark_decontamination(spark, sf_dir):
    out = find_benchmark(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


OP4_SQL = r"""
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM benchmark),
g AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i : i + 9], ' ') AS win
      FROM (SELECT item_id, w, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM g),
p AS (SELECT doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') AS win
      FROM (SELECT doc_id, w, n, unnest(generate_series(1, CAST(len(w) - n + 1 AS BIGINT))) AS i FROM d, sizes WHERE len(w) >= n)),
h AS (SELECT p.doc_id, p.i, p.n, g.item_id FROM p JOIN g ON p.win = g.win AND p.n = g.n),
c AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(generate_series(i, CAST(i + n - 1 AS BIGINT))) AS j FROM h) GROUP BY doc_id),
m AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT doc_id, item_id FROM h) GROUP BY doc_id)
SELECT d.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c USING (doc_id) LEFT JOIN m USING (doc_id)
"""
