"""MinHash near-dedup with HyperMinHash registers.

A document's shingle hashes fall into buckets; a register keeps of the smallest
hash in its bucket the number of leading zeros and the first mantissa bits.
Empty buckets borrow a register by a fixed rule (densification). Bands of
registers name the documents that may be alike; a collision-corrected estimate
from the registers drops hopeless pairs, and the full shingle sets decide.

Documents with equal sets are one class from the start. Inside a band bucket
each class is compared with one pivot first. Only classes that are then still
in different components are compared further, and only if the shingles that no
other component has leave room for a link: copies with so many edits of their
own that they are near nothing are ruled out one by one, not pair by pair. After
two more pivots the members that are left are described by their differences
from a common base; alike ones must share rare differences, which an exact
prefix and position filter looks up. So a large group of copies costs about as
many comparisons as it has members.
"""

from __future__ import annotations

import functools
import math
from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import pick, read, table

BANDS, ROWS, MANTISSA = 32, 5, 10
REGISTERS = BANDS * ROWS
_SEED = np.random.default_rng(6)
_BYTES = _SEED.integers(1, 2**63, 256, dtype=np.uint64)
_BAND = _SEED.integers(1, 2**63, (BANDS, ROWS), dtype=np.uint64) | np.uint64(1)
#: Which of the filled buckets an empty one borrows from: the one it ranks highest.
_BORROW = np.random.default_rng(16).permuted(np.tile(np.arange(REGISTERS, dtype=np.int16), (REGISTERS, 1)), axis=1)
_BASE, _M1, _M2 = 0xD6E8FEB86659FD93, np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)


@functools.lru_cache(maxsize=4)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    out = np.ones((2, n), np.uint64)
    out[0, 1:], out[1, 1:] = _BASE, pow(_BASE, -1, 2**64)
    out = np.cumprod(out, axis=1)
    return out[0], out[1]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * _M1
    x = (x ^ (x >> np.uint64(33))) * _M2
    return x ^ (x >> np.uint64(33))


def shingles(text: str | None, size: int) -> np.ndarray:
    """Sorted 64-bit hashes of a text's different shingles; a shorter text is one shingle, an empty one none.

    Words are separated by white space, A-Z are folded. A shingle's hash is that
    of its bytes with single spaces between the words.
    """
    plain = b" ".join((text or "").encode().lower().split())
    if not plain:
        return np.zeros(0, np.uint64)
    data = np.frombuffer(plain, np.uint8)
    up, down = _powers(1 << max(16, len(data).bit_length()))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTES[data] * up[: len(data)], out=sums[1:])
    gaps = np.flatnonzero(data == 32)
    starts, ends = np.concatenate([[0], gaps + 1]), np.append(gaps, len(data))
    k = min(size, len(starts))
    starts, ends = starts[: len(starts) - k + 1], ends[k - 1 :]
    hashes = (sums[ends] - sums[starts]) * down[starts]
    hashes += (ends - starts).astype(np.uint64) * _M2 + np.uint64(k)
    return np.unique(_mix(hashes))


def registers(hashes: np.ndarray) -> np.ndarray:
    """HyperMinHash registers of a sorted, non-empty set: leading zeros, then mantissa bits."""
    scaled = (hashes >> np.uint64(32)) * np.uint64(REGISTERS)
    bucket = (scaled >> np.uint64(32)).astype(np.int64)
    first = np.flatnonzero(np.diff(bucket, prepend=-1))  # sorted: the first of a bucket is its smallest
    rest = (scaled[first] & np.uint64(0xFFFFFFFF)).astype(np.float64) + 0.5
    mantissa, exponent = np.frexp(rest)  # 0.5 <= mantissa < 1
    values = ((32 - exponent) << MANTISSA) + ((mantissa * 2 - 1) * (1 << MANTISSA)).astype(np.int64)
    out = np.full(REGISTERS, -1, np.int64)
    filled = bucket[first]
    out[filled] = values
    empty = np.flatnonzero(out < 0)
    if len(empty):
        out[empty] = values[_BORROW[np.ix_(empty, filled)].argmax(axis=1)]
    return out.astype("<u2")


def band_keys(regs: np.ndarray) -> np.ndarray:
    per = regs.astype(np.uint64).reshape(BANDS, ROWS) + np.uint64(1)
    return _mix((_mix(per * _BAND) * _BAND).sum(axis=1, dtype=np.uint64) + np.arange(BANDS, dtype=np.uint64)).view(np.int64)


def estimate(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Jaccard estimates for rows of registers, less what equal registers of different hashes add."""
    chance = 0.1699 / (1 << MANTISSA)
    return np.maximum(0.0, ((a == b).mean(axis=1) - chance) / (1 - chance))


def _signatures(size: int, threshold: float):
    fewest = threshold / (1 - threshold) - 1e-9  # smaller sets are alike only if equal

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [[], [], [], [], []]
            for text in batch.column(1):
                h = shingles(text.as_py(), size)
                marks = _mix(h * np.uint64(3) + np.uint64(5))
                out[0].append(len(h))
                out[1].append(int(np.bitwise_xor.reduce(h).view(np.int64)) if len(h) else 0)
                out[2].append(int(marks.sum(dtype=np.uint64).view(np.int64)) if len(h) else 0)
                regs = registers(h) if len(h) >= fewest else None
                out[3].append(None if regs is None else regs.tobytes())
                out[4].append(None if regs is None else band_keys(regs))
            columns = [batch.column(0), pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.int64()), pa.array(out[3], pa.binary()), pa.array(out[4], pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "d1", "d2", "regs", "bands"])

    return run


def _hopeful(threshold: float):
    """Keeps pairs whose estimate is less than six standard errors below the threshold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            a, b = (np.frombuffer(b"".join(batch.column(i).to_pylist()), "<u2").reshape(-1, REGISTERS) for i in (2, 4))
            n = np.minimum(batch.column(3).to_numpy(), batch.column(5).to_numpy())
            error = np.sqrt(threshold * (1 - threshold) / np.minimum(n, REGISTERS))
            yield batch.select(["a", "b"]).filter(pa.array(estimate(a, b) >= threshold - 6 * error))

    return run


def _alike(size: int, percent: int):
    """Keeps pairs of texts with 100 * intersection >= percent * union of their shingle sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: OrderedDict = OrderedDict()

        def of(key, text):
            if key not in known:
                if len(known) > 64:
                    known.popitem(last=False)
                known[key] = shingles(text.as_py(), size)
            return known[key]

        for batch in batches:
            keep = []
            for a, b, x, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), batch.column(3), strict=True):
                p, q = of(a, x), of(b, y)
                both = len(np.intersect1d(p, q, assume_unique=True))
                keep.append(100 * both >= percent * (len(p) + len(q) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def components(edges: DataFrame) -> DataFrame:
    """(node, comp): the smallest node that each node of edges(a, b) is connected with.

    Alternating large and small stars; a star's edges are grouped by minimum and
    joined back, so a node with very many edges is split like any skewed key.
    """
    now = table(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "edges", rows=edges.count())
    while not _stars(now):
        n = now.count()
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = table(large.unionByName(least.where("m < u").select("u", F.col("m").alias("v"))).where("u <> v").distinct(), "large-star", rows=2 * n)
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = table(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "small-star", rows=4 * n)
    return now.select(F.col("u").alias("node"), F.col("v").alias("comp")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("comp")).distinct())


def _stars(edges: DataFrame) -> bool:
    """Whether each node u has one neighbour v, which is no node u itself."""
    n, nodes = edges.agg(F.count("*"), F.count_distinct("u")).first()
    return n == 0 or n == nodes and edges.join(edges.select(F.col("v").alias("u")), "u", "left_semi").isEmpty()


def _hash_sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = pa.array([shingles(t.as_py(), size).view(np.int64) for t in batch.column(1)], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), sets], ["rep", "toks"])

    return run


def private_shingles(nodes: DataFrame, docs: DataFrame, size: int, broadcast_rows: int, small: int = 64) -> DataFrame:
    """(rep, own): how many shingles of each of nodes(rep, comp) occur in no other component of nodes.

    Such shingles can't be shared with a document of another component, which
    bounds the similarity of all pairs that are still to be compared. Components
    of more than `small` classes get no count for shingles that several of their
    members share: the bound is then weaker, and still true.
    """
    kind = nodes.schema["rep"].dataType.simpleString()
    ids = F.broadcast(nodes) if nodes.count() <= broadcast_rows else nodes
    texts = docs.join(ids, docs.doc_id == ids.rep, "left_semi")
    sets = texts.select("doc_id", "text").mapInArrow(_hash_sets(size), f"rep {kind}, toks array<long>").join(ids, "rep")
    toks = sets.select("rep", "comp", F.explode("toks").alias("tok"))
    private = toks.groupBy("tok").agg(F.min("comp").alias("comp"), F.max("comp").alias("c2"), F.min("rep").alias("rep"), F.count("*").alias("m")).where("comp = c2")
    private = table(private.select("tok", "rep", "m"), "private-shingles")
    several = nodes.groupBy("comp").agg(F.count("*").alias("k")).where(F.col("k").between(2, small)).select("comp")
    shared = toks.join(several, "comp", "left_semi").join(private.where("m > 1").select("tok"), "tok", "left_semi")
    return private.where("m = 1").select("rep").unionByName(shared.select("rep")).groupBy("rep").agg(F.count("*").alias("own"))


def _with_texts(pairs: DataFrame, n: int, docs: DataFrame, broadcast_rows: int) -> DataFrame:
    """The n pairs (a, b, ...) with text_a and text_b."""
    ends = pairs.select(F.col("a").alias("doc_id")).unionByName(pairs.select(F.col("b").alias("doc_id"))).distinct()
    ends = table(ends, "pair-ends", rows=2 * n)
    texts = docs.join(F.broadcast(ends) if ends.count() <= broadcast_rows else ends, "doc_id", "left_semi")
    return pairs.join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), "b").join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), "a")


def _differences(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, base = None, np.zeros(0, np.uint64)
        for batch in batches:
            sizes, diffs = [], []
            for a, x, y in zip(batch.column(0).to_pylist(), batch.column(2), batch.column(3), strict=True):
                if a != last:
                    last, base = a, shingles(x.as_py(), size)
                own = shingles(y.as_py(), size)
                sizes.append(len(own))
                diffs.append(np.setxor1d(own, base, assume_unique=True).view(np.int64))
            columns = [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(diffs, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, ["base", "rep", "n", "toks"])

    return run


def differences(still: DataFrame, docs: DataFrame, size: int, percent: int, broadcast_rows: int) -> DataFrame:
    """(base, rep, n, g, toks) for the open members still(key, rep, comp): how each differs from its bucket's base.

    The base of a bucket is the component whose members meet the most others in
    all buckets, so that a group of copies has few bases. toks are the shingles
    that either the member or the base has. Two members differ by
    d = |toks_x| + |toks_y| - 2 |both| shingles and are alike if
    (100 + percent) d <= (100 - percent) (n_x + n_y); with
    g = (100 + percent) |toks| - (100 - percent) n this says
    g_x + g_y <= 2 (100 + percent) |both|.
    """
    kind = still.schema["rep"].dataType.simpleString()
    weighed = still.join(still.groupBy("key").agg(F.count("*").alias("m")), "key").groupBy("comp").agg(F.sum("m").alias("met"))
    base = still.join(weighed, "comp").groupBy("key").agg(F.max(F.struct("met", "comp"))["comp"].alias("a"))
    pairs = table(still.join(base, "key").select("a", F.col("rep").alias("b")).distinct(), "base-members")
    rows = _with_texts(pairs, pairs.count(), docs, broadcast_rows).select("a", "b", "text_a", "text_b")
    out = rows.mapInArrow(_differences(size), f"base {kind}, rep {kind}, n long, toks array<long>")
    return table(out.withColumn("g", (100 + percent) * F.size("toks").cast("long") - (100 - percent) * F.col("n")), "differences")


def close_pairs(diffs: DataFrame) -> DataFrame:
    """Pairs (a, b) that need no shared difference to be alike, each with the member of its group nearest to the base.

    If g_x + g_y <= 0 for any two members, both are so paired: the links join them.
    """
    nearest = diffs.groupBy("base").agg(F.min(F.struct("g", "rep", "comp")).alias("near")).select("base", "near.*").toDF("base", "g2", "rep2", "comp2")
    found = diffs.select("base", "rep", "comp", "g").join(nearest, "base").where((F.col("g") + F.col("g2") <= 0) & (F.col("comp") != F.col("comp2")))
    return found.select(F.least("rep", "rep2").alias("a"), F.greatest("rep", "rep2").alias("b")).distinct()


def _fewest(members: DataFrame, percent: int) -> DataFrame:
    """members(base, rep, comp, g, k, ...) with c, the differences that a member must share with any of another component.

    Only those that have as many (k) stay; the others are near nothing that is still apart from them.
    """
    least = members.groupBy("base", "comp").agg(F.min("g").alias("g"))
    first = least.groupBy("base").agg(F.min(F.struct("g", "comp")).alias("f")).select("base", F.col("f.g").alias("g1"), F.col("f.comp").alias("comp1"))
    second = least.join(first, "base").where("comp <> comp1").groupBy("base", "g1", "comp1").agg(F.min("g").alias("g2"))
    other = F.when(F.col("comp") == F.col("comp1"), F.col("g2")).otherwise(F.col("g1"))
    rows = members.drop("c").join(second, "base")
    return rows.withColumn("c", F.greatest(F.lit(1), F.ceil((F.col("g") + other) / (2 * (100 + percent))))).where("k >= c").drop("g1", "comp1", "g2")


def differing_alike(diffs: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of different components that may share enough differences from their base, by prefix and position.

    Differences that only one component of a group has can't be shared and don't
    count. The others are ordered rarest first.
    """
    toks = diffs.select("base", "rep", "comp", "n", "g", F.explode("toks").alias("tok"))
    common = toks.groupBy("base", "tok").agg(F.count("*").alias("m"), F.min("comp").alias("c1"), F.max("comp").alias("c2")).where("c1 <> c2").select("base", "tok", "m")
    toks = table(toks.join(common, ["base", "tok"]), "shared-differences")
    members = toks.groupBy("base", "rep", "comp", "n", "g").agg(F.count("*").alias("k"))
    for _ in range(2):  # what goes first raises what the others must share
        members = _fewest(members, percent)
    members = table(members, "differing-members")
    place = F.row_number().over(W.partitionBy("base", "rep").orderBy("m", "tok"))
    prefix = toks.select("base", "rep", "tok", "m").join(members, ["base", "rep"]).withColumn("i", place).where("i <= k - c + 1")
    prefix = table(prefix.select("base", "tok", "rep", "comp", "n", "g", (F.col("k") - F.col("i") + 1).alias("left")), "difference-prefixes")
    x, y = (prefix.select("base", "tok", *(F.col(c).alias(f"{c}_{s}") for c in ("rep", "comp", "n", "g", "left"))) for s in "xy")
    sized = 100 * F.least("n_x", "n_y") >= percent * F.greatest("n_x", "n_y")
    enough = F.col("g_x") + F.col("g_y") <= 2 * (100 + percent) * F.least("left_x", "left_y")
    near = (x.base == y.base) & (x.tok == y.tok) & (F.col("rep_x") < F.col("rep_y")) & (F.col("comp_x") != F.col("comp_y")) & sized & enough
    return x.join(y, near).select(F.col("rep_x").alias("a"), F.col("rep_y").alias("b")).distinct()


def _verified(pairs: DataFrame, reps: DataFrame, docs: DataFrame, size: int, percent: int, broadcast_rows: int) -> DataFrame:
    """The pairs (a, b) of class ids whose full sets are alike."""
    n = pairs.count()
    if not n:
        return pairs
    sig = lambda x: reps.select(F.col("rep").alias(x), F.col("regs").alias(f"regs_{x}"), F.col("n").alias(f"n_{x}"))
    pairs = pairs.join(sig("a"), "a").join(sig("b"), "b")
    pairs = pairs.where(100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b")).select("a", "b", "regs_a", "n_a", "regs_b", "n_b")
    kind = reps.schema["rep"].dataType.simpleString()
    hopeful = table(pairs.mapInArrow(_hopeful(percent / 100), f"a {kind}, b {kind}"), "hopeful-pairs", rows=n, rows_per_file=20_000)
    n = hopeful.count()
    if not n:
        return hopeful
    rows = _with_texts(hopeful, n, docs, broadcast_rows)
    return table(rows.select("a", "b", "text_a", "text_b").mapInArrow(_alike(size, percent), f"a {kind}, b {kind}"), "links")


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80, broadcast_rows: int = 1_000_000, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept): one row per input row.

    Documents are linked if 100 * intersection >= percent * union of their sets
    of `size`-word shingles; component_id is the smallest id reachable by links.
    A link at the threshold is missed by all bands with probability 7e-9 (at 85
    percent); linked pairs are always confirmed on the full sets. Texts of fewer
    words are one shingle; null texts and texts without words have none, are
    linked with nothing and kept. Rows with a null id are not linked either and
    are kept, with a null component. Rows that share an id count as one
    document; if their texts differ, links of any of them join all. An empty
    table gives no rows. Ids to look up are broadcast if counted at most
    broadcast_rows, else joined by a shuffle. Sets are sets of 64-bit hashes;
    those of one size are equal if two 64-bit digests of them are, which
    different sets of 10^10 documents are with a chance of 1e-19.
    """
    docs = pick(docs, doc_id=id_col, text=text_col)
    ids = docs.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.count("*").alias("n"))
    if ids.where("n > 1").isEmpty():
        return _near_duplicates(docs, size, percent, broadcast_rows)
    return _repeated_ids(docs, size, percent, broadcast_rows)


def _repeated_ids(docs: DataFrame, size: int, percent: int, broadcast_rows: int) -> DataFrame:
    """near_duplicates where ids repeat: rows are named by id and text, and names that share an id are tied afterwards."""
    name = F.when(F.col("doc_id").isNotNull(), F.concat_ws(":", F.col("doc_id").cast("string"), F.sha2(F.coalesce("text", F.lit("")), 256)))
    named = table(docs.withColumn("name", name), "named-rows")
    once = named.where(F.col("name").isNotNull()).dropDuplicates(["name"]).select(F.col("name").alias("doc_id"), "text")
    found = table(_near_duplicates(once, size, percent, broadcast_rows).select(F.col("doc_id").alias("name"), "n_shingles", "component_id"), "named-components")
    rows = named.select("doc_id", "name").join(found, "name", "left")
    # An id's components are tied to the first of them; rows without words have none of their own.
    own = rows.where("n_shingles > 0 AND doc_id IS NOT NULL")
    first = own.groupBy("doc_id").agg(F.min("component_id").alias("a"))
    ties = components(table(own.join(first, "doc_id").where("a <> component_id").select("a", F.col("component_id").alias("b")).distinct(), "id-ties"))
    tied = rows.join(ties, F.col("component_id") == F.col("node"), "left").withColumn("comp", F.coalesce("comp", "component_id")).drop("node")
    least = tied.where("n_shingles > 0").groupBy("comp").agg(F.min("doc_id").alias("least")).withColumnRenamed("comp", "comp2")
    out = tied.join(least, F.expr("n_shingles > 0 AND comp = comp2"), "left")
    comp = F.coalesce("least", "doc_id")
    lone = named.where(F.col("name").isNull()).select("doc_id", "text").mapInArrow(_signatures(size, percent / 100), f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n long, d1 long, d2 long, regs binary, bands array<long>")
    lone = lone.select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"), F.lit(True).alias("kept"))
    return out.where(F.col("doc_id").isNotNull()).select("doc_id", "n_shingles", comp.alias("component_id"), (F.col("doc_id") == comp).alias("kept")).unionByName(lone)


def _near_duplicates(docs: DataFrame, size: int, percent: int, broadcast_rows: int) -> DataFrame:
    """near_duplicates of docs(doc_id, text) whose ids do not repeat."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    sets = table(docs.mapInArrow(_signatures(size, percent / 100), f"doc_id {kind}, n long, d1 long, d2 long, regs binary, bands array<long>"), "signatures")
    key = ["n", "d1", "d2"]
    classes = sets.where((F.col("n") > 0) & F.col("doc_id").isNotNull()).groupBy(*key).agg(F.min("doc_id").alias("rep"), F.first("regs").alias("regs"), F.first("bands").alias("bands"))
    classes = table(classes, "set-classes")
    reps = classes.where(F.col("bands").isNotNull())
    bands = reps.select("rep", "n", F.explode("bands").alias("key"))
    shared = bands.groupBy("key").agg(F.min("rep").alias("pivot"), F.count("*").alias("m")).where("m > 1")
    members = table(bands.join(shared, "key").select("key", "rep", "n", "pivot"), "band-members")
    tested = table(members.where("rep <> pivot").select(F.col("pivot").alias("a"), F.col("rep").alias("b")).distinct(), "pivot-pairs")
    links = _verified(tested, reps, docs, size, percent, broadcast_rows)
    comps, own = components(links), None

    def join_up(fresh: DataFrame) -> None:
        nonlocal tested, comps
        fresh = table(fresh.join(tested, ["a", "b"], "left_anti"), "further-pairs")
        tested = tested.unionByName(fresh)
        links = _verified(fresh, reps, docs, size, percent, broadcast_rows)
        if not links.isEmpty():
            comps = components(comps.select(F.col("node").alias("a"), F.col("comp").alias("b")).unionByName(links))

    for salt in (1, 2, None):
        of = members.join(comps, members.rep == comps.node, "left").select("key", "rep", "n", F.coalesce("comp", "rep").alias("comp"))
        split = of.groupBy("key").agg(F.min("comp").alias("c1"), F.max("comp").alias("c2"), F.min("n").alias("n_least")).where("c1 <> c2").select("key", "n_least")
        # A table of its own: the join then has nothing after it by key, so that a bucket of very many members can be split.
        still = table(of.join(table(split, "split-keys"), "key"), "split-buckets")
        if own is None:  # components only grow, so what is private now stays so for pairs still apart
            own = table(private_shingles(table(still.select("rep", "comp").distinct(), "split-nodes"), docs, size, broadcast_rows), "own-shingles")
        # At most `most` shingles are shared with any other component; the partner has n_least or more.
        still = still.join(own, "rep", "left").withColumn("most", F.col("n") - F.coalesce("own", F.lit(0)))
        still = still.where(100 * F.col("most") >= percent * (F.col("n") + F.greatest(F.col("n_least"), F.col("most")) - F.col("most"))).select("key", "rep", "n", "comp", "most")
        still = table(still, "open-members")
        if still.isEmpty():
            break
        if salt:
            partners = still.groupBy("key").agg(*(F.min_by(c, F.xxhash64(F.lit(salt), "rep")).alias(c) for c in ("rep", "n", "comp", "most")))
            x, y = (df.select("key", *(F.col(c).alias(f"{c}_{s}") for c in ("rep", "n", "comp", "most"))) for df, s in ((still, "x"), (partners, "y")))
            both = F.least("most_x", "most_y")
            near = (F.col("comp_x") != F.col("comp_y")) & (100 * F.least("n_x", "n_y") >= percent * F.greatest("n_x", "n_y")) & (100 * both >= percent * (F.col("n_x") + F.col("n_y") - both))
            join_up(x.join(y, (x.key == y.key) & near).select(F.least("rep_x", "rep_y").alias("a"), F.greatest("rep_x", "rep_y").alias("b")).distinct())
            continue
        diffs = differences(still, docs, size, percent, broadcast_rows)
        for find in (close_pairs, lambda df: differing_alike(df, percent)):
            named = diffs.join(comps, diffs.rep == comps.node, "left").withColumn("comp", F.coalesce("comp", "rep")).drop("node")
            join_up(find(named))
    named = classes.select(*key, "rep").join(comps, F.col("rep") == F.col("node"), "left").select(*(F.col(c).alias(f"k_{c}") for c in key), F.coalesce("comp", "rep").alias("component_id"))
    out = sets.select("doc_id", *key).join(named, F.expr("n > 0 AND doc_id IS NOT NULL AND n = k_n AND d1 = k_d1 AND d2 = k_d2"), "left")
    comp = F.coalesce("component_id", "doc_id")
    return out.select("doc_id", F.col("n").alias("n_shingles"), comp.alias("component_id"), F.coalesce(F.col("doc_id") == comp, F.lit(True)).alias("kept"))


def op6_near_dedup(spark, sf_dir):
    return near_duplicates(read(spark, sf_dir, "documents"), size=3, percent=85)


OP6_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i : i + 2], ' ') AS s FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(len(w) - 2, 1))) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
x AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS m FROM s a JOIN s b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM x JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * m >= 85 * (na.n + nb.n - m)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id, doc_id AS c FROM documents UNION SELECT e.b, r.c FROM r JOIN e ON e.a = r.doc_id),
c AS (SELECT doc_id, min(c) AS c FROM r GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0) AS n_shingles, c AS component_id, doc_id = c AS kept FROM c LEFT JOIN n USING (doc_id)
"""
