"""Toxicity: a linear-chain conditional random field over words, summed up to document scores and offsets.

Tokens get their training labels from the labelled documents: a word feature
(the word, or its first 4, 5 or 6 letters) that documents labelled toxic hold
far more often than chance and others hardly ever marks the words that have it,
in toxic documents, as toxic. The field has two states. A word's features,
hashed into ``2**BITS`` slots, weigh for the toxic state; the four transition
weights and the two starting weights make neighbours matter. It is trained by
gradient ascent on the chains' log-likelihood, with the expectations from
forward-backward, as is scoring: each word's marginal probability of being
toxic. A document's highest marginal and its sum of marginals, through a
logistic curve fitted on the same training documents, are its score; words with
a marginal of one half or more are its offending spans.

A chain is a sentence, cut after ``CHAIN`` words. The two-state recursions are
kept as odds, one number a word, for all chains of a slice at once.

Training reads about ``SAMPLE`` labelled rows of either label at most and about
``TRAIN_WORDS`` words of chains (documented bounds; both chosen by hash).
Scoring covers every row and whole texts.

Defined results: null and empty texts hold no word and score as a document
without any toxic word does. Without labelled rows of both kinds every score
is 0. Null ids or labels are not learnt from. Columns other than id, text and
label are never read.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackyard.llm.common import Scratch, map_batches, utf8
from trackyard.llm.quality import held_out, unit

BITS = 18
SAMPLE = 3_000         # training documents of each label, about
TRAIN_WORDS = 600_000  # words in the chains that the field is trained on, about
CHAIN = 128
PREFIXES = (4, 5, 6)
EPOCHS, BATCH, RATE, DECAY = 8, 2_000, 0.5, 1e-4
_WORDS_KEPT = 200_000
_SLICE = 1024
_EDGE = re.compile(r"^[\W_]+|[\W_]+$")
_ENDS = (b".", b"!", b"?")


def features(word: bytes) -> list[str]:
    """The lower-cased word without punctuation around it, and its beginnings."""
    w = _EDGE.sub("", word.decode("utf-8", "replace").lower())
    return [w, *(f"{k}^{w[:k]}" for k in PREFIXES if len(w) >= k)] if w else []


def slots(word: bytes) -> list[int]:
    return [xxhash.xxh3_64_intdigest(f.encode()) >> (64 - BITS) for f in features(word)]


@dataclass
class Field:
    """The trained model."""

    weights: np.ndarray  # of the toxic state, by slot
    bias: float
    step: np.ndarray     # 2 x 2 transition weights
    start: np.ndarray    # 2 starting weights
    curve: np.ndarray    # of (1, logit of the highest marginal, log1p of the sum)

    def emission(self, word: bytes) -> float:
        return self.bias + float(sum(self.weights[s] for s in slots(word)))


class _Emissions(dict):
    """word -> its place in the arrays of emissions and of sentence ends."""

    def __init__(self, field: Field):
        super().__init__()
        self.field, self.score, self.end = field, array("d"), array("b")

    def __missing__(self, word: bytes) -> int:
        at = self[word] = len(self.score)
        self.score.append(self.field.emission(word))
        self.end.append(word.endswith(_ENDS))
        return at

    def of(self, tokens: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        if len(self) > _WORDS_KEPT:  # only between slices
            self.clear()
            self.score, self.end = array("d"), array("b")
        at = np.fromiter(map(self.__getitem__, tokens), np.int64, len(tokens))
        return np.frombuffer(self.score)[at], np.frombuffer(self.end, np.int8)[at].astype(bool)


def chain_lengths(ends: np.ndarray, doc_sizes: np.ndarray, longest: int = CHAIN) -> np.ndarray:
    """Lengths of the chains that the concatenated documents' words are cut into."""
    n = len(ends)
    if n == 0:
        return np.zeros(0, np.int64)
    first = np.zeros(n, bool)
    first[0] = True
    first[1:] = ends[:-1]
    begins = np.cumsum(doc_sizes)[:-1]
    first[begins[begins < n]] = True
    at = np.flatnonzero(first)
    inside = np.arange(n) - np.repeat(at, np.diff(np.append(at, n)))
    return np.diff(np.append(np.flatnonzero(inside % longest == 0), n))


def forward_backward(score: np.ndarray, lengths: np.ndarray, step: np.ndarray, start: np.ndarray) \
        -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Odds of the toxic state from the left and, without the word itself, from the right, and the emissions' exp.

    The marginal odds of a word are left * right.
    """
    e = np.exp(np.clip(score, -30, 30))
    t = np.exp(step)
    order = np.argsort(-lengths, kind="stable")
    begin = (np.cumsum(lengths) - lengths)[order]
    size = lengths[order]
    left, right = np.empty(len(e)), np.ones(len(e))
    longest = int(size[0]) if len(size) else 0
    alive = np.searchsorted(-size, -np.arange(1, longest + 1), side="right")  # chains of more than k words
    r = np.exp(start[1] - start[0]) * e[begin]
    if longest:
        left[begin] = r
    for k in range(1, longest):
        at = begin[:alive[k]] + k
        r = r[:alive[k]]
        r = e[at] * (t[0, 1] + r * t[1, 1]) / (t[0, 0] + r * t[1, 0])
        left[at] = r
    for k in range(longest - 2, -1, -1):
        at = begin[:alive[k + 1]] + k
        x = e[at + 1] * right[at + 1]
        right[at] = (t[1, 0] + t[1, 1] * x) / (t[0, 0] + t[0, 1] * x)
    return left, right, e


def marginals(field: Field, texts: list[list[bytes]], emissions: _Emissions) -> list[np.ndarray]:
    """The probability of the toxic state of each word of each text."""
    sizes = np.array([len(t) for t in texts], np.int64)
    score, ends = emissions.of([w for t in texts for w in t])
    left, right, _ = forward_backward(score, chain_lengths(ends, sizes), field.step, field.start)
    odds = left * right
    return np.split(odds / (1 + odds), np.cumsum(sizes)[:-1])


def _evidence(p: np.ndarray) -> tuple[float, float]:
    top = float(np.clip(p.max(), 1e-9, 1 - 1e-9)) if len(p) else 1e-9
    return float(np.log(top / (1 - top))), float(np.log1p(p.sum()))


def spans_of(text: bytes, p: np.ndarray, least: float = 0.5) -> list[dict]:
    """Character offsets of runs of words with a marginal of ``least`` or more, and the highest of each run."""
    out: list[dict] = []
    if not len(p) or p.max() < least:
        return out
    at, byte, char = -2, 0, 0  # characters are counted on from the last find
    for k, m in enumerate(re.finditer(rb"\S+", text)):
        if p[k] < least:
            continue
        a = char + len(text[byte:m.start()].decode("utf-8", "replace"))
        b = a + len(m.group().decode("utf-8", "replace"))
        byte, char = m.end(), b
        if k == at + 1:
            out[-1] |= {"end": b, "probability": max(out[-1]["probability"], float(p[k]))}
        else:
            out.append({"start": a, "end": b, "probability": float(p[k])})
        at = k
    return out


# ---- training -----------------------------------------------------------------

def balanced_sample(docs: DataFrame, labels: DataFrame, label_col: str, sample: int, id_col: str,
                    text_col: str) -> DataFrame:
    """(place, label, text) of about ``sample`` rows of each label that are not held out."""
    known = labels.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & ~held_out(id_col)) \
                  .groupBy(F.col(id_col).cast("bigint").alias("__id")).agg(F.max(label_col).cast("int").alias("label")) \
                  .withColumn("place", F.xxhash64("__id", F.lit(13)))
    totals = {r[0]: r[1] for r in known.groupBy("label").count().collect()}
    share = F.lit(0.0)
    for label, n in totals.items():
        share = F.when(F.col("label") == label, F.lit(min(1.0, sample / n))).otherwise(share)
    # bounded by twice ``sample``, hence small enough to send to every task
    chosen = known.filter(unit("place") < share)
    text = docs.select(F.col(id_col).cast("bigint").alias("__id"), utf8(text_col).alias("text"))
    return text.join(F.broadcast(chosen), "__id").select("place", "label", "text")


def _document_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for label, text in zip(batch.column(1), batch.column(2), strict=True):
            found = sorted({f for w in set(text.as_py().split()) for f in features(w)})
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.string()),
                                              pa.array([label.as_py()] * len(found), pa.int32())],
                                             names=["feature", "label"])


def marking_features(rows: DataFrame) -> set[str]:
    """Features that toxic documents hold beyond chance, and others hardly ever."""
    n = {r[0]: r[1] for r in rows.groupBy("label").count().collect()}
    if not n.get(1) or not n.get(0):
        return set()
    share = n[1] / (n[1] + n[0])
    counts = map_batches(rows, _document_features, "feature string, label int").groupBy("feature").agg(
        F.sum(F.when(F.col("label") == 1, 1).otherwise(0)).alias("toxic"), F.count("label").alias("all"))
    total = counts.count()
    clean = F.col("all") - F.col("toxic")
    # log-likelihood ratio against the toxic share of the sample; as many chances as there are features
    ratio = F.col("toxic") * F.log(F.col("toxic") / (F.col("all") * share)) + F.when(
        clean > 0, clean * F.log(clean / (F.col("all") * (1 - share)))).otherwise(0.0)
    marked = counts.filter((F.col("toxic") > 2) & (F.col("toxic") >= 0.95 * F.col("all"))
                           & (ratio >= float(np.log(max(total, 1)))))
    return {r[0] for r in marked.select("feature").collect()}  # of a bounded sample


def _chains(marks: set[str], share: float):
    """(place, words, labels) of chains: all that hold a marked word, and a share of the others."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marked: dict[bytes, bool] = {}
        for batch in batches:
            for place, label, text in zip(*batch.columns, strict=True):
                words = text.as_py().split()
                toxic = label.as_py() == 1
                for w in set(words) - marked.keys():
                    marked[w] = any(f in marks for f in features(w))
                ends = np.array([w.endswith(_ENDS) for w in words], bool)
                at, out = 0, []
                for n in chain_lengths(ends, np.array([len(words)])).tolist():
                    chain = words[at:at + n]
                    hot = [toxic and marked[w] for w in chain]
                    own = xxhash.xxh3_64_intdigest(b" ".join(chain))
                    if any(hot) or own % 1_000_000 < share * 1_000_000:
                        out.append((own, chain, hot))
                    at += n
                if len(marked) > _WORDS_KEPT:
                    marked.clear()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([o % (1 << 62) for o, _, _ in out], pa.int64()),
                     pa.array([c for _, c, _ in out], pa.list_(pa.binary())),
                     pa.array([h for _, _, h in out], pa.list_(pa.bool_()))], names=["place", "words", "hot"])
    return run


def fit_field(chains: list[tuple[list[bytes], list[bool]]]) -> Field:
    """Gradient ascent (AdaGrad) on the log-likelihood of labelled chains."""
    weights, bias = np.zeros(1 << BITS), np.array([-2.0])
    step, start = np.zeros((2, 2)), np.zeros(2)
    seen = {k: np.full_like(v, 1e-6) for k, v in
            (("weights", weights), ("bias", bias), ("step", step), ("start", start))}
    known: dict[bytes, list[int]] = {}
    for words, _ in chains:
        for w in words:
            if w not in known:
                known[w] = slots(w)

    def move(name: str, value: np.ndarray, gradient: np.ndarray) -> None:
        g = gradient - DECAY * value
        seen[name] += g * g
        value += RATE * g / np.sqrt(seen[name])

    for _ in range(EPOCHS):
        for lo in range(0, len(chains), BATCH):
            some = chains[lo:lo + BATCH]
            words = [w for c, _ in some for w in c]
            y = np.array([h for _, hs in some for h in hs], np.float64)
            lengths = np.array([len(c) for c, _ in some], np.int64)
            counts = np.array([len(known[w]) for w in words], np.int64)
            flat = np.array([s for w in words for s in known[w]], np.int64)
            owner = np.repeat(np.arange(len(words)), counts)
            score = bias[0] + np.bincount(owner, weights[flat], len(words))
            left, right, e = forward_backward(score, lengths, step, start)
            odds = left * right
            p = odds / (1 + odds)
            first = np.zeros(len(words), bool)
            first[np.cumsum(lengths) - lengths] = True
            b = np.flatnonzero(~first)
            a = b - 1
            # expected transitions: state from the left, the step, state of the next word with all to its right
            t, r, x = np.exp(step), left[a], e[b] * right[b]
            joint = np.stack([np.full(len(b), t[0, 0]), t[0, 1] * x, r * t[1, 0], r * t[1, 1] * x])
            joint /= joint.sum(axis=0)
            ya, yb = y[a], y[b]
            real = np.array([((1 - ya) * (1 - yb)).sum(), ((1 - ya) * yb).sum(), (ya * (1 - yb)).sum(), (ya * yb).sum()])
            scale = 1 / len(some)
            residual = (y - p) * scale
            move("weights", weights, np.bincount(flat, residual[owner], len(weights)))
            move("bias", bias, np.array([residual.sum()]))
            move("step", step, (real - joint.sum(axis=1)).reshape(2, 2) * scale)
            at = np.flatnonzero(first)
            move("start", start, np.array([-(residual[at].sum()), residual[at].sum()]))
    return Field(weights, float(bias[0]), step, start, np.zeros(3))


def _train_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    chains = [(list(w), list(h)) for b in batches for w, h in
              zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True) if w]
    if not chains:
        return
    f = fit_field(chains)
    at = np.flatnonzero(f.weights)
    extra = np.concatenate(([f.bias], f.step.ravel(), f.start))
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.concatenate((at, -1 - np.arange(len(extra)))).astype(np.int32)),
         pa.array(np.concatenate((f.weights[at], extra)))], names=["slot", "weight"])


def _fit_curve(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Logistic regression by Newton steps with a slight ridge, the label classes weighed alike."""
    a = np.column_stack((np.ones(len(x)), x))
    weight = np.where(y == 1, 0.5 / max(y.mean(), 1e-9), 0.5 / max(1 - y.mean(), 1e-9))
    w = np.zeros(3)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        h = (a * (weight * p * (1 - p))[:, None]).T @ a + 1e-2 * np.eye(3)
        w += np.clip(np.linalg.solve(h, a.T @ (weight * (y - p)) - 1e-2 * w), -2, 2)
    return w


def train(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", sample: int = SAMPLE,
          train_words: int = TRAIN_WORDS, id_col: str = "doc_id", text_col: str = "text") -> Field | None:
    """The field, or None if there is nothing to learn from. The sample is written once: ``docs`` is read for it alone."""
    with Scratch(docs.sparkSession) as scratch:
        return _learnt(scratch.stored(balanced_sample(docs, labels, label_col, sample, id_col, text_col), "sample"), train_words)


def _learnt(rows: DataFrame, train_words: int) -> Field | None:
    spark = rows.sparkSession
    marks = marking_features(rows)
    if not marks:
        return None
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 1
    share = min(1.0, 6 * train_words / size)  # a word takes about six bytes
    chains = map_batches(rows, _chains(marks, share), "place bigint, words array<binary>, hot array<boolean>")
    learnt = map_batches(chains.repartition(1).sortWithinPartitions("place"), _train_task,
                         "slot int, weight double").toPandas()
    slot, value = learnt["slot"].to_numpy(), learnt["weight"].to_numpy()
    weights = np.zeros(1 << BITS)
    weights[slot[slot >= 0]] = value[slot >= 0]
    extra = value[slot < 0]
    field = Field(weights, float(extra[0]), extra[1:5].reshape(2, 2), extra[5:7], np.zeros(3))
    seen = map_batches(rows, _evidence_of(spark.sparkContext.broadcast(field)),
                       "label int, top double, total double").toPandas()  # three numbers a training document
    if len(seen):
        field.curve = _fit_curve(seen[["top", "total"]].to_numpy(), seen["label"].to_numpy(np.float64))
    return field


def _evidence_of(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field = shared.value
        emissions = _Emissions(field)
        for batch in batches:
            ps = marginals(field, [t.as_py().split() for t in batch.column(2)], emissions) if batch.num_rows else []
            got = [_evidence(p) for p in ps]
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), pa.array([g[0] for g in got], pa.float64()),
                 pa.array([g[1] for g in got], pa.float64())], names=["label", "top", "total"])
    return run


SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("probability", pa.float64())]))


def score_documents(docs: DataFrame, field: Field | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score, spans) of every row; spans are the offending runs of words with their character offsets."""
    shared = docs.sparkSession.sparkContext.broadcast(field)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        emissions = _Emissions(model) if model else None
        for whole in batches:
            for at in range(0, whole.num_rows, _SLICE):
                batch = whole.slice(at, _SLICE)
                scores, spans = [0.0] * batch.num_rows, [[]] * batch.num_rows
                if model is not None:
                    texts = [t.as_py() for t in batch.column(1)]
                    ps = marginals(model, [t.split() for t in texts], emissions)
                    x = np.array([(1.0, *_evidence(p)) for p in ps])
                    scores = 1 / (1 + np.exp(-np.clip(x @ model.curve, -30, 30)))
                    spans = [spans_of(t, p) for t, p in zip(texts, ps, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(scores, pa.float64()), pa.array(spans, SPANS)],
                    names=["doc_id", "score", "spans"])

    return map_batches(docs.select(F.col(id_col).cast("bigint").alias("doc_id"), utf8(text_col).alias("text")), run,
                       "doc_id bigint, score double, spans array<struct<start:bigint,end:bigint,probability:double>>")
