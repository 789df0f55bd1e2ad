"""Toxicity by multiple-instance learning.

A document is a bag of sentences. A sentence scores sigmoid(bias + weights of
its words and of their beginnings of several lengths), each hashed to
``2 ** BITS`` places, so that forms of one stem share evidence; a document scores the noisy-or of its sentences, 1 - (1 - leak) * prod(1 - p). Only
document labels are learned from, yet the sentence scores say where the
offending sentences are.

Learning takes a bounded sample of labelled rows (``per_class`` documents of
either label, in the order of a hash of their id; a documented bound, the model
has a fixed size too). Scoring is one narrow pass over whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabula.llm import ragged

BITS = 18
BEGINNINGS = (3, 4, 5, 6, 8)  # bytes
KINDS = 1 + len(BEGINNINGS)
LONGEST = 48  # words; a longer sentence is cut
SHORTEST = 8  # words; shorter sentences are joined with their neighbours
LEAK = 1e-4

_ENDS = np.zeros(256, dtype=bool)
_ENDS[[10, 33, 46, 63]] = True  # newline ! . ?


@dataclass
class Model:
    weights: np.ndarray  # KINDS * 2**BITS, float32
    bias: float


@dataclass
class Sentences:
    """Words of some documents, grouped into sentences."""

    features: np.ndarray  # (KINDS, words) places in the weights
    first: np.ndarray  # first word of each sentence
    doc: np.ndarray  # document of each sentence
    start: np.ndarray  # bytes, in the document
    end: np.ndarray


def sentences(data: np.ndarray, offsets: np.ndarray) -> Sentences:
    """Sentences end at . ! ? and line ends, and after ``LONGEST`` words; those
    that begin in the same ``SHORTEST`` words of a document are one, so that a
    text of shouted words is not hundreds of instances."""
    part = ragged.LOWER[data]
    s, e, doc = ragged.runs(part, offsets, ragged.ALNUM)
    if not len(s):
        z = np.empty(0, np.int64)
        return Sentences(np.empty((KINDS, 0), np.int64), z, z, z, z)
    shift = np.uint64(64 - BITS)
    ends = [e, *(np.minimum(e, s + n) for n in BEGINNINGS)]
    features = np.stack([(ragged.hash_runs(part, s, end) >> shift).astype(np.int64) + (i << BITS) for i, end in enumerate(ends)])
    stops = np.cumsum(_ENDS[part], dtype=np.int64)[s]
    new = np.ones(len(s), dtype=bool)
    new[1:] = (np.diff(doc) != 0) | (np.diff(stops) != 0)
    begins = np.flatnonzero(new)
    of = doc[begins]
    place = (begins - np.searchsorted(doc, of)) // SHORTEST
    joined = np.ones(len(begins), dtype=bool)
    joined[1:] = (np.diff(of) != 0) | (np.diff(place) != 0)
    begins = begins[joined]
    inner = np.arange(len(s)) - np.repeat(begins, np.diff(np.append(begins, len(s))))
    first = np.flatnonzero(inner % LONGEST == 0)
    last = np.append(first[1:], len(s)) - 1
    d = doc[first]
    return Sentences(features, first, d, s[first] - offsets[d], e[last] - offsets[d])


def logits(found: Sentences, model: Model) -> np.ndarray:
    if not len(found.first):
        return np.empty(0)
    words = sum(model.weights[f] for f in found.features)
    return model.bias + np.add.reduceat(words.astype(np.float64), found.first)


def noisy_or(z: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    """Document scores from sentence logits; a document without sentences has the leak."""
    keep = np.bincount(doc, weights=-np.logaddexp(0, z), minlength=n) if len(z) else np.zeros(n)
    return -np.expm1(keep + np.log1p(-LEAK))


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        data, offsets = ragged.text_bytes(b.column("text"))
        labels = b.column("label").to_pylist()
        for lo, hi in ragged.slices(offsets):
            found = sentences(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo])
            place = np.searchsorted(found.doc, np.arange(hi - lo + 1))
            words = np.append(found.first, found.features.shape[1])
            rows = []
            for i in range(hi - lo):
                a, z = words[place[i]], words[place[i + 1]]
                rows.append((int(labels[lo + i]), found.features[:, a:z].astype("<i4").tobytes(), (found.first[place[i]:place[i + 1]] - a).astype("<i4").tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in rows], t) for j, t in enumerate((pa.int32(), pa.binary(), pa.binary()))], names=["label", "features", "first"])


def fit(docs: DataFrame, labels: DataFrame, *, label: str = "toxic", where: Column | None = None, per_class: int = 2000,
        epochs: int = 160, rate: float = 0.05, decay: float = 1e-3) -> Model:
    """Train from ``labels`` (doc_id, <label> 0/1) that meet ``where`` and the
    texts of ``docs`` (doc_id, text). Rows without id or label are skipped, a
    null text is empty. Without both labels every text scores the leak."""
    rows = labels.select("doc_id", F.col(label).cast("int").alias("label")).where("doc_id is not null and label in (0, 1)")
    if where is not None:
        rows = rows.where(where)
    order = [F.xxhash64("doc_id"), "doc_id", "label"]
    chosen = rows.where("label = 1").orderBy(*order).limit(per_class).unionAll(rows.where("label = 0").orderBy(*order).limit(per_class))
    # bounded: 2 * per_class ids, and the hashed words of as many documents
    chosen = docs.sparkSession.createDataFrame(chosen.distinct().collect(), rows.schema)
    schema = "label int, features binary, first binary"
    sample = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("label", "text").mapInArrow(_features, schema).collect()
    sample.sort(key=lambda r: (r.label, bytes(r.features)))
    y = np.array([r.label for r in sample], dtype=np.float64)
    if not len(y) or y.min() == y.max():
        return Model(np.zeros(KINDS << BITS, np.float32), -40.0)
    counts = np.array([len(r.features) // (4 * KINDS) for r in sample])
    at = np.cumsum(counts) - counts
    firsts = [np.frombuffer(r.first, "<i4") for r in sample]
    first = np.concatenate([f + a for f, a in zip(firsts, at, strict=True)]).astype(np.int64)
    features = np.empty((KINDS, int(counts.sum())), np.int32)
    for r, a, n in zip(sample, at.tolist(), counts.tolist(), strict=True):
        features[:, a:a + n] = np.frombuffer(r.features, "<i4").reshape(KINDS, -1)
    sample.clear()
    return train(y, features, first, np.repeat(np.arange(len(y)), [len(f) for f in firsts]), epochs, rate, decay)


def train(y: np.ndarray, features: np.ndarray, first: np.ndarray, doc: np.ndarray, epochs: int, rate: float, decay: float, min_docs: int = 5, lift: float = 0.5) -> Model:
    """Full-batch Adam on the noisy-or log-likelihood of document labels y;
    sentence i starts at word first[i] and belongs to document doc[i]. Features
    in fewer than ``min_docs`` documents have no weight; ``lift`` (0 to 1) gives
    the rarer positive documents more of it."""
    words_of = np.diff(np.append(first, features.shape[1]))
    size, owner = 1 << BITS, np.repeat(doc, words_of)
    known = np.zeros(KINDS << BITS, bool)  # others keep weight 0
    for i, f in enumerate(features):
        pairs = np.unique((f - (i << BITS)).astype(np.int64) * len(y) + owner)
        known[i << BITS:(i + 1) << BITS] = np.bincount(pairs // len(y), minlength=size) >= min_docs
    del owner, pairs
    w, bias = np.zeros(KINDS << BITS), -5.0
    m, v, mb, vb = np.zeros(len(w)), np.zeros(len(w)), 0.0, 0.0
    share = y.mean()
    balance = np.where(y == 1, share ** -lift, 1.0)
    balance /= balance.mean()
    for step in range(1, epochs + 1):
        z = bias + np.add.reduceat(sum(w[f] for f in features), first)
        p = 1 / (1 + np.exp(-np.clip(z, -40, 40)))
        total = np.clip(noisy_or(z, doc, len(y)), 1e-9, 1 - 1e-9)
        pull = balance * np.where(y == 1, -(1 - total) / total, 1.0) / len(y)
        g = pull[doc] * p
        each = np.repeat(g, words_of)
        grad = known * (np.concatenate([np.bincount(f - (i << BITS), each, size) for i, f in enumerate(features)]) + decay * w)
        gb = float(g.sum())
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        mb, vb = 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb**2
        up, down = 1 - 0.9**step, 1 - 0.999**step
        w -= rate * (m / up) / (np.sqrt(v / down) + 1e-8)
        bias -= rate * (mb / up) / (np.sqrt(vb / down) + 1e-8)
    return Model(w.astype(np.float32), float(bias))


def score(docs: DataFrame, model: Model, keep: list[str] | None = None, *, flag_at: float = 0.3) -> DataFrame:
    """The columns ``keep`` of ``docs`` (default doc_id) plus ``score`` and
    ``offending``: start, end (bytes of the text) and score of every sentence
    at ``flag_at`` or more. One row per row; null and empty texts, and texts
    without a word, score the leak and have no offending sentence. Columns of
    ``docs`` with these names are replaced."""
    keep = [c for c in (["doc_id"] if keep is None else keep) if c not in ("score", "offending")]
    kind = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offsets = ragged.text_bytes(b.column("text"))
            for lo, hi in ragged.slices(offsets):
                found = sentences(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo])
                z = logits(found, model)
                total = noisy_or(z, found.doc, hi - lo)
                p = 1 / (1 + np.exp(-np.clip(z, -40, 40)))
                spans: list = [[] for _ in range(hi - lo)]
                for i in np.flatnonzero(p >= flag_at).tolist():
                    spans[found.doc[i]].append({"start": int(found.start[i]), "end": int(found.end[i]), "score": float(p[i])})
                yield pa.RecordBatch.from_arrays([*(b.column(c).slice(lo, hi - lo) for c in keep), pa.array(total), pa.array(spans, pa.list_(kind))], names=[*keep, "score", "offending"])

    span = T.StructType().add("start", T.LongType()).add("end", T.LongType()).add("score", T.DoubleType())
    schema = T.StructType([docs.schema[c] for c in keep]).add("score", T.DoubleType()).add("offending", T.ArrayType(span))
    return docs.select(*dict.fromkeys([*keep, "text"])).mapInArrow(run, schema)


def offending_sentences(docs: DataFrame, model: Model, *, flag_at: float = 0.3) -> DataFrame:
    """doc_id, start, end, score and text of every offending sentence."""
    found = score(docs, model, ["doc_id", "text"], flag_at=flag_at).select("doc_id", F.encode("text", "utf-8").alias("_b"), F.inline("offending"))
    return found.select("doc_id", "start", "end", "score", F.decode(F.substring("_b", F.col("start").cast("int") + 1, (F.col("end") - F.col("start")).cast("int")), "utf-8").alias("text"))
