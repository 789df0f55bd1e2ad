"""Language identification by compression.

Every language gets a zstandard raw-content dictionary made of sentences of
that language. A text is cut into short pieces, each piece is compressed with
every dictionary, and the language with the fewest bytes over the whole text
wins: a compressor that already holds the words of a language needs fewer
literals. A text is rejected when the runner-up needs hardly more bytes: less
than ``min_margin`` more, or, in short texts, than ``min_bytes`` bytes more.
Both were chosen on held-out labelled rows, languages left out of the model and
noise (figures in the README).

Learning reads a bounded sample: ``sample_docs`` labelled documents of each
language in the order of a hash of their id, and ``dictionary_bytes`` of their
sentences. Prediction is one narrow pass over all documents; nothing is
shuffled, and the only broadcast values are the dictionaries (languages x
dictionary_bytes, checked against ``MAX_MODEL_BYTES``).
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

UNKNOWN = "und"
MAX_MODEL_BYTES = 64 << 20

#: ASCII letters in lower case, bytes of other characters as they are, all else a space.
_LETTERS = bytes((c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32) for c in range(256))


@dataclass(frozen=True)
class Model:
    """Dictionaries by language, in the order of ``languages``."""

    languages: tuple[str, ...]
    dictionaries: tuple[bytes, ...]
    level: int = 5
    short_level: int = 12
    short_bytes: int = 256
    piece_bytes: int = 512
    min_margin: float = 0.04
    min_bytes: int = 3


def normalize(text: str) -> bytes:
    """Lower-case letters with single spaces, also around the text; digits,
    signs and repeated white space say nothing about a language."""
    return b" " + b" ".join(text.lower().encode("utf-8", "replace").translate(_LETTERS).split()) + b" "


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def _picked(limit: int):
    """In a task: the ``limit`` sentences of each document with the least checksum."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            langs, order, picked = [], [], []
            for lang, text in zip(b.column("lang").to_pylist(), b.column("text").to_pylist(), strict=True):
                parts = {p for p in map(normalize, text.split("\n")) if p.strip()}
                for p in sorted(parts, key=lambda p: (zlib.crc32(p), p))[:limit]:
                    for at in range(0, len(p), 2048):
                        langs.append(lang)
                        picked.append(p[at:at + 2048])
                        order.append(zlib.crc32(picked[-1]))
            yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(order, pa.int64()), pa.array(picked, pa.binary())], names=["lang", "place", "piece"])
    return run


def fit(docs: DataFrame, *, label: str = "lang", where: Column | None = None, sample_docs: int = 300,
        sentences_per_doc: int = 6, dictionary_bytes: int = 65536, **options) -> Model:
    """Learn from the rows of ``docs`` (doc_id, text, <label>) that meet
    ``where`` and have a text and a label. Without such rows the model knows
    no language and answers ``und``."""
    rows = docs.select("doc_id", "text", F.col(label).cast("string").alias("lang"))
    if where is not None:
        rows = rows.where(where)
    rows = rows.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull())
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    sample = rows.select("doc_id", "lang").withColumn("_part", F.spark_partition_id() % 64)
    for keys in (["lang", "_part"], ["lang"]):  # in two steps, so that no task meets the candidates of all tasks
        first = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
        sample = sample.withColumn("_rank", first).where(F.col("_rank") <= sample_docs).drop("_rank")
    ids = [(r.doc_id, r.lang) for r in sample.select("doc_id", "lang").distinct().collect()]
    languages = sorted({lang for _, lang in ids})
    if not languages:
        return Model((), (), **options)
    if len(languages) * dictionary_bytes > MAX_MODEL_BYTES:
        raise ValueError(f"{len(languages)} languages x {dictionary_bytes} bytes exceed {MAX_MODEL_BYTES}")
    chosen = docs.sparkSession.createDataFrame(ids, rows.select("doc_id", "lang").schema)
    # bounded: languages x sample_docs ids, languages x sample_docs x sentences_per_doc pieces
    texts = rows.join(F.broadcast(chosen), ["doc_id", "lang"], "left_semi").select("lang", "text")
    pieces = texts.mapInArrow(_picked(sentences_per_doc), "lang string, place bigint, piece binary")
    held: dict[str, list[tuple[int, bytes]]] = {lang: [] for lang in languages}
    for r in pieces.distinct().collect():
        held[r.lang].append((r.place, bytes(r.piece)))
    built = tuple(b" ".join(p for _, p in sorted(held[lang]))[:dictionary_bytes] for lang in languages)
    return Model(tuple(languages), built, **options)


class Classifier:
    """The compressors of a model, made once for each Python worker."""

    def __init__(self, model: Model):
        self.model = model
        self.long, self.short = ([self._compressor(d, level) for d in model.dictionaries] for level in (model.level, model.short_level))

    def _compressor(self, dictionary: bytes, level: int) -> zstandard.ZstdCompressor:
        held = zstandard.ZstdCompressionDict(dictionary or b" ", dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        how = zstandard.ZstdCompressionParameters.from_level(
            level, source_size=self.model.piece_bytes, dict_size=len(dictionary), min_match=3,
            write_checksum=False, write_content_size=False, write_dict_id=False)
        held.precompute_compress(compression_params=how)
        return zstandard.ZstdCompressor(compression_params=how, dict_data=held)

    def sizes(self, text: str) -> np.ndarray:
        """Compressed bytes of the whole text under each language; short texts
        get the slower search for matches, since a byte decides there."""
        data, step = normalize(text), self.model.piece_bytes
        pieces = [data[at:at + step] for at in range(0, len(data), step)]
        used = self.short if len(data) <= self.model.short_bytes else self.long
        return np.array([sum(len(c.compress(p)) for p in pieces) for c in used], dtype=np.float64)

    def classify(self, text: str | None) -> tuple[str, float, float, bool]:
        """(language, score, margin, rejected). Ties go to the language that
        sorts first; one known language has margin 1."""
        if not self.long or not has_letter(text):
            return UNKNOWN, 0.0, 0.0, True
        sizes = self.sizes(text)
        best = int(sizes.argmin())
        score = 1.0 / float(np.exp2((sizes[best] - sizes) / 4).sum())
        others = np.delete(sizes, best)
        if not len(others):
            return self.model.languages[best], score, 1.0, False
        more = float(others.min() - sizes[best])
        return self.model.languages[best], score, more / max(float(sizes[best]), 1.0), more < max(self.model.min_margin * float(sizes[best]), self.model.min_bytes)


_cache: dict[int, tuple[Model, Classifier]] = {}


def _classifier(model: Model) -> Classifier:
    key = hash(model)
    if key not in _cache:
        _cache.clear()
        _cache[key] = (model, Classifier(model))
    return _cache[key][1]


def predict(docs: DataFrame, model: Model, keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` of ``docs`` (default: all) plus ``lang_pred``,
    ``score`` (0 to 1), ``margin`` (extra bytes of the runner-up, relative)
    and ``rejected``. ``docs`` needs a column ``text``. A null text, or one
    without a letter, is ``und`` with score 0 and rejected; every row gives
    one row, repeated rows too. Columns of ``docs`` with the added names are
    replaced."""
    added = ["lang_pred", "score", "margin", "rejected"]
    keep = [c for c in (docs.columns if keep is None else keep) if c not in added]
    docs = docs.select(*dict.fromkeys([*keep, "text"]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classifier = _classifier(model)
        for b in batches:
            got = [classifier.classify(x.as_py()) for x in b.column("text")]
            cols = [pa.array([g[i] for g in got], t) for i, t in enumerate((pa.string(), pa.float64(), pa.float64(), pa.bool_()))]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), *cols], names=[*keep, *added])

    schema = T.StructType([docs.schema[c] for c in keep])
    for name, kind in zip(added, (T.StringType(), T.DoubleType(), T.DoubleType(), T.BooleanType()), strict=True):
        schema = schema.add(name, kind)
    return docs.mapInArrow(run, schema)
