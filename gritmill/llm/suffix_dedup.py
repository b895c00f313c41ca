"""Repeated 200-byte strings, by bucket-pointer refinement over all texts.

Of every 101 positions one is an anchor: the one whose 100-byte string has the
smallest bucket number (25-byte buckets refined to 50 and 100 by the bucket 25
and 50 bytes on). Any 200-byte string holds the anchor of its first 101
positions, and equal strings hold equal ones at the same place. So anchors
start in the bucket of their 100 bytes, and only buckets with more than one
member live on.

A member of a live bucket stands for a few strings of 200 bytes round its
anchor. Members with the same bytes are one class: what it stands for is
repeated. Buckets with several classes, one of which occurs once, are refined
on their bytes: 8-byte buckets are sorted on the bucket pointers 8, 16, 32, 64
and 72 bytes on, each sort updates the pointers that the next one reuses, and
buckets of one position are left alone. That compares bytes and nothing else.

Groups of live buckets go to one task each, as many as fit its memory. A bucket
of more than `split` classes is not gathered: its strings are counted one by
one, by 128-bit numbers, with partial counts before the shuffle.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bucketed, pick, read, table

START, CORE, LENGTH = 25, 100, 200
_MUL, _MUL2, _BASE = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), 0xD6E8FEB86659FD93
_BYTES = np.random.default_rng(8).integers(1, 2**63, 256, dtype=np.uint64)
#: Positions handled at a time; with what follows them they have numbers of 18 bits.
PIECE, BITS = 1 << 17, 18
#: Distances at which pointers of 8 bytes, 16, ... are refined; the last makes 200 bytes of 128.
STEPS = (8, 16, 32, 64, 72)


@functools.cache
def _powers(n: int) -> np.ndarray:
    """_BASE ** i and its inverse, modulo 2 ** 64."""
    out = np.ones((2, n), np.uint64)
    out[0, 1:], out[1, 1:] = _BASE, pow(_BASE, -1, 2**64)
    return np.cumprod(out, axis=1)


def _named(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """One number, the same in all tasks, for the bucket of positions and that at a later offset."""
    x = a * _MUL
    x ^= x >> np.uint64(29)
    x += b
    x *= _MUL2
    x ^= x >> np.uint64(32)
    return x


def core_buckets(piece: np.ndarray) -> np.ndarray:
    """Numbers of the 100-byte buckets of a piece's positions."""
    powers = _powers(PIECE + 2 * LENGTH)
    sums = np.zeros(len(piece) + 1, np.uint64)
    np.cumsum(_BYTES[piece] * powers[0, : len(piece)], out=sums[1:])
    h = (sums[START:] - sums[:-START]) * powers[1, : len(piece) - START + 1]
    h ^= h >> np.uint64(31)
    for q in (START, 2 * START):
        h = _named(h[:-q], h[q:])
    return h


def _slide(x: np.ndarray, width: int) -> np.ndarray:
    """The minimum of x[i : i + width]."""
    w = 1
    while 2 * w <= width:
        x = np.minimum(x[:-w], x[w:])
        w *= 2
    return np.minimum(x[: len(x) - (width - w)], x[width - w :]) if w < width else x


def anchors(data: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """Rows (bucket, anchor, first, last): the positions first..last begin the strings that hold the anchor.

    data is texts end to end. Of equal buckets in reach the leftmost is the anchor.
    """
    ends, out = np.cumsum(lens), []
    for at in range(0, len(data) - LENGTH + 1, PIECE):
        h = core_buckets(data[at : at + PIECE + LENGTH - 1])
        x = h >> np.uint64(BITS) << np.uint64(BITS)
        x |= np.arange(len(x), dtype=np.uint64)
        where = (_slide(x, LENGTH - CORE + 1) & np.uint64((1 << BITS) - 1)).astype(np.int64)
        p = np.arange(at, at + len(where))
        ok = np.flatnonzero(ends[np.minimum(np.searchsorted(ends, p, "right"), len(ends) - 1)] - p >= LENGTH)
        if len(ok):
            cut = np.flatnonzero((np.diff(where[ok]) != 0) | (np.diff(ok) != 1)) + 1
            first, last = ok[np.concatenate([[0], cut])], ok[np.append(cut, len(ok)) - 1]
            a = where[first]
            out.append(np.stack([h[a].view(np.int64), a + at, first + at, last + at]))
    return np.concatenate(out, axis=1).T if out else np.zeros((0, 4), np.int64)


def refined(data: np.ndarray, where: np.ndarray) -> np.ndarray:
    """Bucket pointers of the 200-byte strings that begin at `where`: equal exactly for equal strings.

    A pointer is the place of its bucket's first member in the sorted order, so
    refining a bucket changes the pointers of its members only. About 50 bytes
    of memory a byte of data, which must be shorter than 2 ** 31.
    """
    n = len(data)
    padded = np.concatenate([data, np.zeros(LENGTH, np.uint8)])
    keys = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(padded[: n + 7], 8)).view(">u8").ravel().astype(np.uint64)
    pointer = np.zeros(n + LENGTH, np.int32)
    order = np.argsort(keys).astype(np.int32)
    keys = keys[order]
    live = _renamed(pointer, order, np.zeros(n, bool), np.concatenate([[True], keys[1:] != keys[:-1]]))
    del keys, order
    for step, q in enumerate(STEPS):
        if step == len(STEPS) - 1:  # only the strings asked for need their whole length
            wanted = np.zeros(n, bool)
            wanted[where] = True
            live = live[wanted[live]]
        pairs = pointer[live].astype(np.int64) << 32 | pointer[live + q]
        order = np.argsort(pairs)
        pairs, live = pairs[order], live[order]
        del order
        live = _renamed(pointer, live, *(np.concatenate([[True], x[1:] != x[:-1]]) for x in ((pairs >> 32).astype(np.int32), pairs))) if len(live) else live
    return pointer[where]


def _renamed(pointer: np.ndarray, live: np.ndarray, bucket: np.ndarray, part: np.ndarray) -> np.ndarray:
    """Updates the pointers of live positions in sorted order, given where old buckets and their parts begin; those in parts of several."""
    begin = np.flatnonzero(part)
    sizes = np.diff(np.append(begin, len(live)))
    first = np.flatnonzero(bucket) if bucket.any() else np.zeros(1, np.int64)
    inside = begin - first[np.searchsorted(first, begin, "right") - 1]
    pointer[live] = np.repeat(pointer[live[begin]] + inside, sizes)
    return live[np.repeat(sizes > 1, sizes)]


def _segments(segment_bytes: int, ids: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        seg, names, texts, size = TaskContext.get().partitionId() << 32, [], [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
                raw = (text.as_py() or "").encode()
                names.append(doc_id.as_py())
                texts.append(raw)
                size += len(raw)
                if size >= segment_bytes:
                    yield make(seg, names, texts)
                    seg, names, texts, size = seg + 1, [], [], 0
        if names:
            yield make(seg, names, texts)

    def make(seg, names, texts):
        return pa.RecordBatch.from_arrays([pa.array([seg], pa.int64()), pa.array([names], pa.list_(ids)), pa.array([[len(t) for t in texts]], pa.list_(pa.int64())), pa.array([zstandard.compress(b"".join(texts), 3)], pa.binary())], ["seg", "ids", "lens", "blob"])

    return run


def _opened(lens: pa.Scalar, blob: pa.Scalar) -> tuple[np.ndarray, np.ndarray]:
    lens = np.asarray(lens.values, np.int64)
    n = int(lens.sum())
    return lens, np.frombuffer(zstandard.decompress(blob.as_py(), max_output_size=n), np.uint8) if n else np.zeros(0, np.uint8)


def _column(scalar: pa.Scalar, name: str) -> np.ndarray:
    """A field of a list of structs."""
    return np.asarray(scalar.values.field(name)) if scalar.is_valid else np.zeros(0, np.int64)


def _rows(batches):
    """Rows one by one, so that one segment at a time is open."""
    for batch in batches:
        yield from (tuple(c[i] for c in batch.columns) for i in range(batch.num_rows))


def _find_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(seg, lens, blob) to (seg, bucket, n, at): a bucket's anchors in a segment, as anchor, hi, lo in one number."""
    for seg, lens, blob in _rows(batches):
        lens, data = _opened(lens, blob)
        found = anchors(data, lens)
        if not len(found):
            continue
        found = found[np.argsort(found[:, 0], kind="stable")]
        begin = np.flatnonzero(np.diff(found[:, 0], prepend=found[0, 0] - 1))
        at = found[:, 1] << 16 | (found[:, 1] - found[:, 2]) << 8 | (found[:, 1] - found[:, 3])
        edges = np.append(begin, len(found)).astype(np.int32)
        columns = [pa.array(np.full(len(begin), seg.as_py())), pa.array(found[begin, 0]), pa.array(np.diff(edges)), pa.ListArray.from_arrays(pa.array(edges), pa.array(at))]
        yield pa.RecordBatch.from_arrays(columns, ["seg", "bucket", "n", "at"])


def _find_classes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(seg, lens, blob, live) to (seg, bucket, k1, k2, n, hi, lo, at): the classes of live anchors in a segment."""
    import xxhash

    for seg, lens, blob, live in _rows(batches):
        _, data = _opened(lens, blob)
        view, found = memoryview(data), {}
        lists = live.values.field("at")
        buckets = np.repeat(np.asarray(live.values.field("bucket")), np.asarray(lists.value_lengths()))
        for bucket, x in zip(buckets.tolist(), lists.flatten().to_pylist(), strict=True):
            a, hi, lo = x >> 16, x >> 8 & 255, x & 255
            key = xxhash.xxh3_128_digest(view[a - hi : a - lo + LENGTH], hi)
            if (row := found.get(key)) is None:
                found[key] = (bucket, hi, lo, [a])
            else:
                row[3].append(a)
        keys = np.frombuffer(b"".join(found), "<i8").reshape(-1, 2)
        rows = list(found.values())
        columns = [
            pa.array(np.full(len(rows), seg.as_py())), pa.array([r[0] for r in rows], pa.int64()), pa.array(np.ascontiguousarray(keys[:, 0])), pa.array(np.ascontiguousarray(keys[:, 1])),
            pa.array([len(r[3]) for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int32()), pa.array([r[2] for r in rows], pa.int32()), pa.array([r[3] for r in rows], pa.list_(pa.int64())),
        ]
        yield pa.RecordBatch.from_arrays(columns, ["seg", "bucket", "k1", "k2", "n", "hi", "lo", "at"])


CLASSES = "seg long, bucket long, k1 long, k2 long, n int, hi int, lo int, at array<long>"
TEXTS = "seg long, bucket long, m long, n_classes long, first long, text binary"


def _cut_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(seg, lens, blob, members) to the bytes that members of open buckets stand for."""
    for seg, lens, blob, members in _rows(batches):
        _, data = _opened(lens, blob)
        view, (bucket, m, n, a, hi, lo) = memoryview(data), (_column(members, c) for c in ("bucket", "m", "n_classes", "a", "hi", "lo"))
        first, texts = a - hi, [view[x:y].tobytes() for x, y in zip((a - hi).tolist(), (a - lo + LENGTH).tolist(), strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(a), seg.as_py())), pa.array(bucket), pa.array(m), pa.array(n), pa.array(first), pa.array(texts, pa.binary())], ["seg", "bucket", "m", "n_classes", "first", "text"])


def _refine(group: pa.Table) -> pa.Table:
    """Texts of some buckets, whole buckets each: the repeated runs of those that occur once, (seg, begin, end)."""
    texts = [x.as_buffer() for x in group.column("text").combine_chunks()]
    sizes = np.array([t.size for t in texts])
    data = np.frombuffer(b"".join(texts), np.uint8)
    starts, n = np.cumsum(sizes) - sizes, sizes - LENGTH + 1
    text = np.repeat(np.arange(len(texts)), n)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(n) - n, n)
    pointers = refined(data, starts[text] + nth)
    _, bucket, count = np.unique(pointers, return_inverse=True, return_counts=True)
    m = np.asarray(group.column("m"))[text]
    twice = count > 1
    twice[bucket[m > 1]] = True
    hit = np.flatnonzero(twice[bucket] & (m == 1))
    if not len(hit):
        return pa.table({"seg": pa.array([], pa.int64()), "begin": pa.array([], pa.int64()), "end": pa.array([], pa.int64())})
    new = np.flatnonzero((np.diff(hit, prepend=-2) != 1) | (np.diff(text[hit], prepend=-1) != 0))
    first, last = hit[new], hit[np.append(new[1:], len(hit)) - 1]
    base = np.asarray(group.column("first"))[text[first]]
    return pa.table({"seg": np.asarray(group.column("seg"))[text[first]], "begin": base + nth[first], "end": base + nth[last] + LENGTH})


def _strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every string of the texts of large buckets by a 128-bit number: (seg, begin, m, s1, s2)."""
    import xxhash

    for seg, _, m, _, first, text in _rows(batches):
        view = memoryview(text.as_buffer())
        n = len(view) - LENGTH + 1
        keys = np.frombuffer(b"".join(xxhash.xxh3_128_digest(view[i : i + LENGTH]) for i in range(n)), "<i8").reshape(-1, 2)
        columns = [np.full(n, seg.as_py()), np.arange(n) + first.as_py(), np.full(n, m.as_py()), np.ascontiguousarray(keys[:, 0]), np.ascontiguousarray(keys[:, 1])]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["seg", "begin", "m", "s1", "s2"])


SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _results(ids: pa.DataType, keep: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for names, lens, blob, gone in _rows(batches):
            lens, data = _opened(lens, blob)
            mark = np.zeros(len(data) + 1, np.int32)
            np.add.at(mark, _column(gone, "begin"), 1)
            np.add.at(mark, _column(gone, "end"), -1)
            mask = np.cumsum(mark, dtype=np.int32)[:-1] > 0
            out = [[], [], [], []]
            for a, n in zip((np.cumsum(lens) - lens).tolist(), lens.tolist(), strict=True):
                part = mask[a : a + n]
                edge = np.flatnonzero(np.diff(part.astype(np.int8), prepend=0, append=0)).tolist() if part.any() else []
                kept = data[a : a + n][~part].tobytes() if edge else data[a : a + n].tobytes()
                out[0].append(n)
                out[1].append([{"start": x, "end": y} for x, y in zip(edge[::2], edge[1::2], strict=True)])
                out[2].append(hashlib.sha256(kept).hexdigest())
                out[3].append(kept if keep else None)
            yield pa.RecordBatch.from_arrays([names.values.cast(ids), pa.array(out[0], pa.int64()), pa.array(out[1], SPANS), pa.array(out[2]), pa.array(out[3], pa.binary())], ["doc_id", "n_bytes", "spans", "kept_sha256", "kept"])

    return run


def find_repeats(docs: DataFrame, segment_bytes: int = 1 << 20, split: int = 10_000, keep: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, spans, kept_sha256, kept): one row per input row.

    spans are the maximal runs of bytes covered by a 200-byte string that also
    starts anywhere else, in another text or in the same; kept is what is left
    (null unless asked for: it may cut a character). Texts are UTF-8; null ones
    are empty, and those under 200 bytes lose nothing. Rows that repeat are
    copies of each other and lose all they have from 200 bytes on. An empty
    table gives no rows.

    Texts are packed into segments, shuffled once; a text longer than
    segment_bytes is a segment of its own. Classes, and strings of buckets with
    more than `split` classes, are told apart by 128-bit numbers: among 10^13
    strings two different ones share a number with probability 1e-13.
    """
    docs = pick(docs, doc_id=id_col, text=text_col)
    kind = docs.schema["doc_id"].dataType
    from pyspark.sql.pandas.types import to_arrow_type

    ids = to_arrow_type(kind)
    total = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    n_parts = max(24, min(100_000, total // (16 << 20)))
    segments = bucketed(docs.mapInArrow(_segments(segment_bytes, ids), f"seg long, ids array<{kind.simpleString()}>, lens array<long>, blob binary"), "segments", n_parts, "seg")
    by_seg = lambda df, name, what: df.repartition(n_parts, "seg").groupBy("seg").agg(what.alias(name))  # noqa: E731  as the segments lie
    found = table(segments.select("seg", "lens", "blob").mapInArrow(_find_anchors, "seg long, bucket long, n int, at array<long>"), "anchors")
    lively = found.groupBy("bucket").agg(F.sum("n").alias("m")).where("m > 1").select("bucket")
    live = by_seg(found.join(lively, "bucket", "left_semi"), "live", F.collect_list(F.struct("bucket", "at")))
    members = table(segments.select("seg", "lens", "blob").join(live, "seg").mapInArrow(_find_classes, CLASSES), "bucket-members")
    key = ["bucket", "k1", "k2"]
    one = [F.sum("n").alias("m"), F.min("seg").alias("seg"), F.min_by(F.get("at", F.lit(0)), "seg").alias("a"), *(F.min(F.col(c).cast("long")).alias(c) for c in ("hi", "lo"))]
    classes = table(members.groupBy(*key).agg(*one), "bucket-classes")
    opened = classes.groupBy("bucket").agg(F.count("*").alias("n_classes"), F.min("m").alias("least")).where("n_classes > 1 AND least = 1").select("bucket", "n_classes")
    opened = table(classes.join(opened, "bucket").select("seg", "bucket", "m", "n_classes", "a", "hi", "lo"), "open-classes")
    n_open, most = opened.agg(F.count("*"), F.coalesce(F.max("n_classes"), F.lit(0))).first()
    whole = members.join(classes.where("m > 1").select(*key), key, "left_semi")
    spans = whole.select("seg", F.transform("at", lambda a: F.struct((a - F.col("hi")).alias("begin"), (a - F.col("lo") + LENGTH).alias("end"))).alias("spans"))
    if n_open:
        lists = by_seg(opened, "members", F.collect_list(F.struct("bucket", "m", "n_classes", "a", "hi", "lo")))
        texts = segments.select("seg", "lens", "blob").join(lists, "seg").mapInArrow(_cut_texts, TEXTS)
        texts = table(texts, "open-texts") if most > split else texts
        part = F.pmod(F.xxhash64("bucket"), F.lit(max(1, 2 * n_open // split)))
        runs = texts.where(F.col("n_classes") <= split).groupBy(part).applyInArrow(_refine, "seg long, begin long, end long")
        if most > split:
            strings = table(texts.where(F.col("n_classes") > split).mapInArrow(_strings, "seg long, begin long, m long, s1 long, s2 long"), "bucket-strings")
            twice = strings.groupBy("s1", "s2").agg(F.count("*").alias("n"), F.max("m").alias("most")).where("n > 1 OR most > 1").select("s1", "s2")
            hits = strings.where("m = 1").join(twice, ["s1", "s2"], "left_semi")
            runs = runs.unionByName(hits.select("seg", "begin", (F.col("begin") + LENGTH).alias("end")))
        spans = spans.unionByName(runs.select("seg", F.array(F.struct("begin", "end")).alias("spans")))
    rows = segments.join(by_seg(spans, "gone", F.flatten(F.collect_list("spans"))), "seg", "left").select("ids", "lens", "blob", "gone")
    return rows.mapInArrow(_results(ids, keep), f"doc_id {kind.simpleString()}, n_bytes long, spans array<struct<start:long,end:long>>, kept_sha256 string, kept binary")


def op8_suffix_dedup(spark, sf_dir):
    out = find_repeats(read(spark, sf_dir, "documents"))
    n = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    return out.select("doc_id", "n_bytes", n.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), "kept_sha256")
