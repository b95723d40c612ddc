"""Quality classifier: hashed word n-gram logistic regression, trained with FTRL-proximal updates.

A document is a sparse vector in ``2**BITS`` hashed dimensions. Its n-grams
are taken over two views of its white-space separated words: the lower-cased
words (1 and 2 of them) and their shapes (1 to 3 of them; a shape keeps letter
case, digits and punctuation, and marks a word that repeats the one before).
A dimension's value is the square root of the n-gram's share of its view, so
neither length nor a repeated n-gram drowns the rest. The score is the
logistic of one sparse dot product.

Training reads at most about ``SAMPLE`` labelled rows (a documented bound; the
choice is by a hash of the id, alike on every run), whose vectors are made in
parallel. Follow-the-regularised-leader is sequential by nature, so one task
streams over the vectors; its state is two arrays of ``2**BITS`` numbers
however many rows there are. The model, at most ``2**BITS`` weights, is what
the driver collects and broadcasts. Scoring covers every row and whole texts.

Defined results: null and empty texts have no n-grams and score by the bias
alone. Labels whose id or label is null are not learnt from; of several labels
of one id the largest counts. Without labelled rows every score is 0.5.
Columns other than id, text and label are never read.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackyard.llm.common import arrow_column, map_batches, utf8

BITS = 18
SAMPLE = 8_000
ALPHA, BETA, L1, L2 = 3.0, 1.0, 0.02, 0.02
_WORDS_KEPT = 200_000
_MASK = np.uint64((1 << BITS) - 1)
_P = np.uint64(0x9E3779B97F4A7C15)
_CLASSES = bytes(0x78 if 0x61 <= b <= 0x7A or b >= 0x80 else 0x58 if 0x41 <= b <= 0x5A else
                 0x39 if 0x30 <= b <= 0x39 else b for b in range(256))
_RUN = re.compile(rb"([xX9])\1+")


def held_out(id_col: str | Column) -> Column:
    """Rows that labels are never learnt from: crc32 of the id as text is divisible by 5."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def shape_of(word: bytes) -> bytes:
    """Runs of lower-case (and non-ASCII) letters become x, of capitals X, of digits 9; the rest stays."""
    return _RUN.sub(rb"\1", word.translate(_CLASSES))[:8]


class _Shapes(dict):
    """translated word -> hash of its shape."""

    def __missing__(self, classes: bytes) -> int:
        if len(self) >= _WORDS_KEPT:
            self.clear()
        h = self[classes] = xxhash.xxh3_64_intdigest(_RUN.sub(rb"\1", classes)[:8], seed=1)
        return h


class _Words(dict):
    """word -> its place in two arrays: hashes of the lower-cased word and of its shape."""

    def __init__(self):
        super().__init__()
        self.words, self.shapes, self._shape = array("Q"), array("Q"), _Shapes()

    def __missing__(self, word: bytes) -> int:
        at = self[word] = len(self.words)
        self.words.append(xxhash.xxh3_64_intdigest(word.lower()))
        self.shapes.append(self._shape[word.translate(_CLASSES)])
        return at

    def of(self, tokens: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        if len(self) > _WORDS_KEPT:  # only between texts: places of one text stay valid
            self.clear()
            self.words, self.shapes = array("Q"), array("Q")
        places = np.fromiter(map(self.__getitem__, tokens), np.int64, len(tokens))
        return np.frombuffer(self.words, np.uint64)[places], np.frombuffer(self.shapes, np.uint64)[places]


_REPEAT = np.uint64(xxhash.xxh3_64_intdigest(b"repeated", seed=2))


def _slots(parts: list[np.ndarray], view: int) -> tuple[np.ndarray, np.ndarray]:
    h = np.concatenate(parts)
    h = ((h ^ (h >> np.uint64(31))) + np.uint64(view)) * _P
    slots, counts = np.unique(h >> np.uint64(64 - BITS), return_counts=True)
    return slots.astype(np.int32), np.sqrt(counts / len(h)).astype(np.float32)


def vector(text: bytes, words: _Words) -> tuple[np.ndarray, np.ndarray]:
    """Dimensions and values of a text; the same dimension may come from both views."""
    tokens = text.split()
    n = len(tokens)
    if n == 0:
        return np.zeros(0, np.int32), np.zeros(0, np.float32)
    w, s = words.of(tokens)
    s[1:][w[1:] == w[:-1]] = _REPEAT
    plain = [w, w[:-1] * _P + w[1:]]
    shaped = [s, s[:-1] * _P + s[1:] + np.uint64(5)]
    if n > 2:
        shaped.append((s[:-2] * _P + s[1:-1]) * _P + s[2:] + np.uint64(7))
    a, b = _slots(plain, 1), _slots(shaped, 2)
    return np.concatenate((a[0], b[0])), np.concatenate((a[1], b[1]))


class Ftrl:
    """Follow-the-regularised-leader-proximal logistic regression over sparse vectors; the last slot is the bias."""

    def __init__(self, size: int = (1 << BITS) + 1, alpha=ALPHA, beta=BETA, l1=L1, l2=L2):
        self.z, self.n = np.zeros(size), np.zeros(size)
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2

    def weights(self, i) -> np.ndarray:
        z, n = self.z[i], self.n[i]
        shrunk = np.sign(z) * np.maximum(np.abs(z) - self.l1, 0)
        return -shrunk / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)

    def learn(self, slots: np.ndarray, values: np.ndarray, label: int) -> float:
        # a slot that both views hit counts once, with its summed value
        i, where = np.unique(np.append(slots, len(self.z) - 1), return_inverse=True)
        x = np.bincount(where, np.append(values, 1.0))
        w = self.weights(i)
        p = 1 / (1 + np.exp(-np.clip(w @ x, -35, 35)))
        g = (p - label) * x
        step = (np.sqrt(self.n[i] + g * g) - np.sqrt(self.n[i])) / self.alpha
        self.z[i] += g - step * w
        self.n[i] += g * g
        return float(p)


def score(weights: np.ndarray, slots: np.ndarray, values: np.ndarray) -> float:
    return float(1 / (1 + np.exp(-np.clip(weights[slots] @ values + weights[-1], -35, 35))))


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    words = _Words()
    for whole in batches:
        for at in range(0, whole.num_rows, 256):
            batch = whole.slice(at, 256)
            made = [vector(t.as_py(), words) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([a.tobytes() for a, _ in made], pa.binary()),
                 pa.array([b.tobytes() for _, b in made], pa.binary())], names=["place", "label", "slots", "values"])


def _fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    model = Ftrl()
    for batch in batches:
        for label, slots, values in zip(*(batch.column(k) for k in (1, 2, 3)), strict=True):
            model.learn(np.frombuffer(slots.as_py(), np.int32), np.frombuffer(values.as_py(), np.float32),
                        label.as_py())
    w = model.weights(np.arange(len(model.z)))
    at = np.flatnonzero(w)
    yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(w[at])], names=["slot", "weight"])


def unit(hashed: str):
    """A 64-bit hash as a number from 0 up to 1."""
    return F.shiftrightunsigned(F.col(hashed), 11).cast("double") / float(1 << 53)


def labelled_sample(docs: DataFrame, labels: DataFrame, label_col: str, sample: int = SAMPLE, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """(place, label, text) of about ``sample`` labelled rows that are not held out; ``place`` orders them."""
    known = labels.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & ~held_out(id_col)) \
                  .groupBy(F.col(id_col).cast("bigint").alias("__id")).agg(F.max(label_col).cast("int").alias("label")) \
                  .withColumn("place", F.xxhash64("__id", F.lit(11)))
    total = known.count()
    if total > sample:
        known = known.filter(unit("place") < sample / total)
    # bounded by ``sample``, hence small enough to send to every task
    text = docs.select(F.col(id_col).cast("bigint").alias("__id"), utf8(text_col).alias("text"))
    return text.join(F.broadcast(known), "__id").select("place", "label", "text")


def train(docs: DataFrame, labels: DataFrame, label_col: str = "quality", sample: int = SAMPLE,
          id_col: str = "doc_id", text_col: str = "text") -> np.ndarray:
    """The weights, the bias last."""
    rows = labelled_sample(docs, labels, label_col, sample, id_col, text_col)
    vectors = map_batches(rows, _vectors, "place bigint, label int, slots binary, values binary")
    ordered = vectors.repartition(1).sortWithinPartitions("place", "label", "slots")
    learnt = map_batches(ordered, _fit, "slot int, weight double").toPandas()
    weights = np.zeros((1 << BITS) + 1)
    weights[learnt["slot"].to_numpy()] = learnt["weight"].to_numpy()
    return weights


def score_documents(docs: DataFrame, weights: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, w = _Words(), shared.value
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([score(w, *vector(t.as_py(), words)) for t in batch.column(1)],
                                           pa.float64())], names=["doc_id", "score"])

    return map_batches(docs.select(F.col(id_col).cast("bigint").alias("doc_id"), utf8(text_col).alias("text")), run,
                       "doc_id bigint, score double")


def keep_quality(docs: DataFrame, weights: np.ndarray, threshold: float = 0.3, text_col: str = "text") -> DataFrame:
    """The documents, all columns, that score ``threshold`` or more. Python gets the text and returns a verdict."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        words, w = _Words(), shared.value
        for texts in batches:
            yield pa.array([score(w, *vector(t.as_py(), words)) >= threshold for t in texts], pa.bool_())

    keep = arrow_column(docs.sparkSession, run, "boolean")
    return docs.filter(keep(utf8(text_col)))
