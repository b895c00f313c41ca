"""Toxicity by compression distance: zstandard dictionaries of toxic and of ordinary text.

A window (a word between spaces) is compressed with either dictionary; the
number of bytes that the toxic one saves against the ordinary one is its
distance. A document's features are the evidence of its windows; thresholds and
weights are calibrated on labelled documents that made no dictionary.

The toxic dictionary is trained on stretches of toxic words, those whose
5-grams stand in at least 20 times as many surroundings as in ordinary text:
trained on whole toxic text it spends its room on what all text has, and
windows of four to twelve words drown a word's few bytes in chance matches.
"""

from __future__ import annotations

import math
import pickle
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pick, read

#: Runs that compress to nothing, around a word: a short input would be stored as it is, and zstandard
#: looks for no match in the last eight bytes.
PAD = b"\0" * 16
GRAM = 5
#: ASCII that separates words; A-Z is folded, other characters stay.
FOLD = bytes(32 if c in b"\t\n\x0b\x0c\r !\"()*+,./:;<=>?[\\]^_`{|}~&%$#" else c for c in bytes(range(256)).lower())


def words_of(text: str | None) -> list[bytes]:
    """Lower-case words of the whole text, without punctuation at their sides."""
    return (text or "").lower().encode().translate(FOLD).split()


@dataclass
class ToxicityModel:
    """Two dictionaries, and what a window's pair of lengths tells.

    evidence: for (bytes saved, bytes left) of a window, how much more often (as
    a logarithm) toxic text has such windows than ordinary text, where that is
    above `least`. weights and bias turn a document's sum, largest and share of
    evidence into a score.
    """

    toxic: bytes
    ordinary: bytes
    evidence: dict[tuple[int, int], float] = field(default_factory=dict)
    weights: tuple[float, ...] = (0.0, 0.0, 0.0)
    bias: float = -5.0

    def __post_init__(self):
        self._ready = None

    def __getstate__(self):
        return self.__dict__ | {"_ready": None}

    def _compressors(self):
        if self._ready is None:
            made = []
            for content in (self.toxic, self.ordinary):
                of = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                how = zstandard.ZstdCompressionParameters.from_level(6, dict_size=len(content), source_size=64, min_match=4, write_content_size=False, write_checksum=False, write_dict_id=False)
                of.precompute_compress(compression_params=how)
                made.append(zstandard.ZstdCompressor(dict_data=of, compression_params=how))
            self._ready = made, {}
        return self._ready

    def lengths(self, words: Iterable[bytes]) -> dict[bytes, tuple[int, int]]:
        """(bytes that the toxic dictionary saves against the ordinary one, bytes it leaves) of words' windows."""
        (toxic, ordinary), known = self._compressors()
        if len(known) > 500_000:  # bounds the memory of a worker
            known.clear()
        for w in words:
            if w not in known:
                x = PAD + b" " + w + b" " + PAD
                left = len(toxic.compress(x))
                known[w] = (min(len(ordinary.compress(x)) - left, 30), min(left, 80))
        return known

    def features(self, text: str | None) -> tuple[float, float, float]:
        return self.features_of(Counter(words_of(text)))

    def features_of(self, counts: Counter) -> tuple[float, float, float]:
        known, evidence = self.lengths(counts), self.evidence
        total = top = 0.0
        for w, n in counts.items():
            e = evidence.get(known[w])
            if e is not None:
                total += e * n
                top = max(top, e)
        return math.log1p(total), top, min(1.0, 5 * total / max(20, counts.total()))

    def score(self, text: str | None) -> float:
        z = self.bias + sum(w * x for w, x in zip(self.weights, self.features(text), strict=True))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def _grams(word: bytes) -> list[bytes]:
    x = b" " + word + b" "
    return [x[i : i + GRAM] for i in range(len(x) - GRAM + 1)]


def _places(texts: list[np.ndarray], n: int, at_once: int = 4_000_000) -> np.ndarray:
    """In how many different surroundings each of n words stands; copies of a text add none."""
    out, end = np.zeros(n, np.int64), np.array([n], np.uint32)
    run = np.concatenate([end, *(x for ws in texts for x in (ws, end))])
    parts = -(-len(run) // at_once)
    for p in range(parts):
        at = np.flatnonzero((run[1:-1] != n) & (run[1:-1] % parts == p)) + 1
        _, pair = np.unique(run[at - 1].astype(np.uint64) * (n + 1) + run[at + 1], return_inverse=True)
        places = np.unique(pair.astype(np.uint64) * (n + 1) + run[at])
        out += np.bincount((places % (n + 1)).astype(np.int64), minlength=n)
    return out


def _contexts(words: list[bytes], places: np.ndarray) -> Counter:
    """In how many different surroundings each gram stands."""
    out: Counter = Counter()
    for i in np.flatnonzero(places).tolist():
        n = int(places[i])
        for g in set(_grams(words[i])):
            out[g] += n
    return out


def _telling_parts(word: bytes, telling: set[bytes]) -> list[bytes]:
    """The stretches of a word that telling grams cover."""
    out: list[bytes] = []
    x, end = b" " + word + b" ", -1
    for i in range(len(x) - GRAM + 1):
        if x[i : i + GRAM] in telling:
            out.append(x[i : i + GRAM]) if i > end else out.__setitem__(-1, out[-1] + x[end : i + GRAM])
            end = i + GRAM
    return out


def _dictionary(samples: list[bytes], size: int) -> bytes:
    try:
        return zstandard.train_dictionary(size, samples, k=32, d=6).as_bytes()
    except zstandard.ZstdError:  # too little to train on: the most frequent samples, the commonest last
        return b"".join(x for x, _ in reversed(Counter(samples).most_common(size // 8)))[-size:] or b" "


def train(toxic_texts: Iterable[str], ordinary_texts: Iterable[str], **sizes) -> ToxicityModel:
    """learn() from two sets of texts."""
    return learn(chain(((t, 1) for t in toxic_texts), ((t, 0) for t in ordinary_texts)), **sizes)


def learn(labelled: Iterable[tuple[str, int]], toxic_size: int = 8_192, ordinary_size: int = 65_536, least: float = 1.5) -> ToxicityModel:
    """Dictionaries from one half of the labelled texts (1: toxic, 0: ordinary), evidence and weights from the other.

    Without texts of both kinds nothing is toxic. Texts are read once and kept
    as numbers of words, 4 bytes each.
    """
    number: dict[bytes, int] = {}
    texts: tuple[list[np.ndarray], list[np.ndarray]] = [], []
    for text, k in labelled:
        texts[k].append(np.array([number.setdefault(w, len(number)) for w in words_of(text)], np.uint32))
    if min(map(len, texts)) < 2:
        return ToxicityModel(b" ", b" ")
    words = list(number)
    first, second = ([part[i::2] for part in texts] for i in (0, 1))
    held = [_contexts(words, _places(part, len(words))) for part in first]
    size = [max(1, sum(h.values())) for h in held]
    # Windows for the toxic dictionary: parts of words with grams that toxic text has far more often.
    telling = {g for g, n in held[1].items() if n >= 4 and n / size[1] > 20 * (held[0][g] + 0.5) / size[0]}
    parts = {i: _telling_parts(words[i], telling) for i in set(chain.from_iterable(ws.tolist() for ws in first[1]))}
    toxic = _dictionary([x for ws in first[1] for i in ws.tolist() for x in parts[i]], toxic_size)
    ordinary = _dictionary([b" " + b" ".join([words[i] for i in ws[at : at + 16].tolist()]) + b" " for ws in first[0] for at in range(0, len(ws), 16)], ordinary_size)
    # Ordinary words that look toxic so far go to the end of the ordinary dictionary, where they are cheapest.
    often = np.zeros(len(words), np.int64)
    for ws in first[0]:
        often[np.unique(ws)] += 1
    known = ToxicityModel(toxic, ordinary).lengths(words[i] for i in np.flatnonzero(often).tolist())
    hard = sorted((w for w, x in known.items() if x[0] > 0), key=lambda w: (often[number[w]], w))
    ordinary = (ordinary + b" ".join(hard) + b" ")[-2 * ordinary_size :]
    model = ToxicityModel(toxic, ordinary)
    seen = [Counter(), Counter()]
    for k, part in enumerate(second):
        places = _places(part, len(words))
        at = np.flatnonzero(places).tolist()
        known = model.lengths(words[i] for i in at)
        for i in at:
            seen[k][known[words[i]]] += int(places[i])
    size = [max(1, c.total()) for c in seen]
    tells = {x: math.log((n + 0.5) / size[1]) - math.log((seen[0][x] + 0.5) / size[0]) for x, n in seen[1].items()}
    model.evidence = {x: e for x, e in tells.items() if e >= least and x[0] > 0}
    features = np.array([model.features_of(Counter(words[i] for i in ws.tolist())) for k in (1, 0) for ws in second[k]])
    model.weights, model.bias = _logistic(features, np.array([float(k) for k in (1, 0) for _ in second[k]]))
    return model


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> tuple[tuple[float, ...], float]:
    """Newton's method with a ridge on the weights."""
    x = np.hstack([x, np.ones((len(x), 1))])
    keep, w = np.diag([ridge] * (x.shape[1] - 1) + [1e-6]), np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + keep, x.T @ (y - p) - keep @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return tuple(float(v) for v in w[:-1]), float(w[-1])


def held_out(doc_id) -> bool:
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


def fit(docs: DataFrame, labels: DataFrame, max_toxic: int = 2_000, max_ordinary: int = 3_000, max_bytes: int = 100_000, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> ToxicityModel:
    """Trains on a bounded sample of labelled rows whose crc32(id) mod 5 is not 0.

    The sample: of each label the first ids by md5 (max_toxic, max_ordinary),
    texts of at most max_bytes bytes; of rows that share an id the text with the
    smallest hash. Ids with several labels count as toxic if one of them says
    so; null labels do not count. One task gets the sample's texts and trains;
    the driver gets the model alone.
    """
    labels = pick(labels, doc_id="doc_id", label=label_col).where(F.col("doc_id").isNotNull() & F.col("label").isNotNull())
    labels = labels.groupBy("doc_id").agg(F.max("label").alias("label")).where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0)
    docs = pick(docs, doc_id=id_col, text=text_col)
    order = F.md5(F.col("doc_id").cast("string"))
    chosen = [labels.where(F.col("label") == k).orderBy(order).limit(n) for k, n in ((1, max_toxic), (0, max_ordinary))]
    ids = chosen[0].unionByName(chosen[1])
    rows = docs.where(F.octet_length("text") <= max_bytes).join(F.broadcast(ids), "doc_id")
    rows = rows.groupBy("doc_id", "label").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    key = F.col("doc_id").cast("string")
    rows = rows.repartition(1).sortWithinPartitions(F.crc32(key.cast("binary")), key).select("text", F.col("label").cast("int"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = learn((t.as_py(), k.as_py()) for batch in batches for t, k in zip(*batch.columns, strict=True))
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], ["model"])

    made = rows.mapInArrow(run, "model binary").collect()
    return pickle.loads(made[0].model) if made else train([], [])


def score_toxicity(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score): one row per input row, score 0 to 1.

    Null, empty and wordless texts get the score of a text without toxic
    windows. Nothing but id and text is read. An empty table gives no rows.
    """
    docs = pick(docs, doc_id=id_col, text=text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = pa.array([model.score(t.as_py()) for t in batch.column(1)], pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column(0), scores], ["doc_id", "score"])

    return docs.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, score double")


def drop_toxic(docs: DataFrame, model: ToxicityModel, threshold: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows of docs, all columns, whose text scores below the threshold; a map over the rows, no shuffle."""
    from .common import position

    at, names = position(docs, text_col), docs.columns
    plain = docs.toDF(*(f"c{i}" for i in range(len(names))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array([model.score(t.as_py()) < threshold for t in batch.column(at)], pa.bool_()))

    return plain.mapInArrow(run, plain.schema).toDF(*names)


def op2_toxicity(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    scored = score_toxicity(docs, fit(docs, read(spark, sf_dir, "labels")))
    out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5 == 0
    return scored.select("doc_id", out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
