"""Target-distribution importance resampling over hashed word n-grams.

1. Features. Words and pairs of words of a text are hashed into ``BUCKETS``
   buckets; a text keeps its features as one array of 16-bit bucket numbers,
   written to the shared folder, so that texts are read and hashed once.
2. Weights. The buckets' counts over all documents and over the target's texts
   (one number a bucket, summed map-side) give each bucket a gain, the log of its
   share in the target against its share in the documents. A document's weight is the
   floored mean of the gains of its array: one numpy lookup and sum.
3. Cutoff. Scores are weights plus keyed Gumbel noise, so the k highest are a
   draw of k without replacement. A quantile sketch of the scores gives a bracket
   around the cutoff. Exact counts above and inside it tell whether the cutoff
   lies inside; if not, the bracket is widened to the side that misses it. Only the
   bracket's rows are sorted to locate the cutoff.
4. Ranks. The drawn rows, narrow ones, are numbered in order by range partitions
   and offsets; no task sees more than its range.

Defined results: a null or empty text has no words, no features, weight 0, and
isn't drawn (fewer than ``MIN_WORDS`` words), but has a score. A document
without an id is scored as if its id were the empty string and comes after
all others among ties. Rows that share an id are documents of their own; equal
rows tie, and which of them is drawn doesn't show. Texts are never
cut. An empty table gives an empty result; an empty target leaves its counts 0.
Columns beyond id and text are not read.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackyard.llm.common import Scratch, map_batches, stored, utf8
from trackyard.operators.ordinal import global_ordinal, global_ordinal_counted

BUCKETS = 10_000
MIN_WORDS = 20
PERCENT = 25
SEED = 7
SKETCH_ACCURACY = 2_000      # of approx_percentile: ranks are off by n / accuracy at most
_NO_ID = (1 << 63) - 1
_WORDS = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")  # of lower-cased UTF-8


def feature_buckets(text: bytes, buckets: int = BUCKETS) -> tuple[int, np.ndarray]:
    """The number of words, and the bucket of each word and each pair of neighbours, repeats counted."""
    words = _WORDS.findall(text.lower())  # bytes.lower changes A-Z alone
    crc = zlib.crc32
    singles = [crc(w) for w in words]
    pairs = [crc(b" " + w, c) for c, w in zip(singles, words[1:], strict=False)]
    return len(words), (np.array(singles + pairs, np.uint32) % np.uint32(buckets)).astype(np.uint16)


def _features(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                n, arrays = [], []
                for text in batch.column(1):
                    words, array = feature_buckets(text.as_py(), buckets)
                    n.append(words)
                    arrays.append(array.tobytes())
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(arrays, pa.binary())],
                                                 names=["id", "n_words", "features"])
    return run


def featured(docs: DataFrame, id_col: str, text_col: str, buckets: int = BUCKETS) -> DataFrame:
    """(id, n_words, features) of each row; ``features`` holds 16-bit bucket numbers."""
    if not 0 < buckets <= 1 << 16:
        raise ValueError("bucket numbers have 16 bits")
    rows = docs.select(F.coalesce(F.col(id_col).cast("bigint"), F.lit(_NO_ID)).alias("id"), utf8(text_col).alias("text"))
    return map_batches(rows, _features(buckets), "id bigint, n_words bigint, features binary")


def _counted(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for features in batch.column(0):
                total += np.bincount(np.frombuffer(features.as_buffer(), np.uint16), minlength=buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held.astype(np.int32)), pa.array(total[held])], names=["bucket", "n"])
    return run


def bucket_counts(featured_rows: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """How often each bucket occurs over all rows; one row a bucket reaches the driver."""
    parts = map_batches(featured_rows.select("features"), _counted(buckets), "bucket int, n bigint")
    out = np.zeros(buckets, np.int64)
    for bucket, n in parts.groupBy("bucket").agg(F.sum("n")).collect():
        out[bucket] = n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Of each bucket: the floor of 1000 times the log ratio of its smoothed shares."""
    k, s, t = len(source), int(source.sum()), int(target.sum())
    return np.array([math.floor(1000 * math.log((float(b + 1) * float(s + k)) / (float(a + 1) * float(t + k))))
                     for a, b in zip(source.tolist(), target.tolist(), strict=True)], np.int64)


def _weighted(table: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, weights = [], []
            for features in batch.column("features"):
                at = np.frombuffer(features.as_buffer(), np.uint16)
                n.append(len(at))
                weights.append(int(table[at].sum()) // len(at) if len(at) else 0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("n_words"), pa.array(n, pa.int64()), pa.array(weights, pa.int64())],
                names=["id", "n_words", "n_features", "weight"])
    return run


def _gumbel(seed: int) -> Column:
    """1000 times standard Gumbel noise, floored, from a hash of the id."""
    name = F.concat(F.lit(f"{seed}:"), F.when(F.col("id") != _NO_ID, F.col("id").cast("string")).otherwise(""))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("bigint")


def cutoff(rows: DataFrame, k: int, total: int, accuracy: int = SKETCH_ACCURACY) -> tuple[int, int] | None:
    """(score, id) of the ``k``-th row by score descending, id ascending; None if ``k`` is 0.

    Only the rows whose score lies in a bracket around the sketch's quantile are sorted.
    """
    if k <= 0:
        return None
    share, slack = 1 - (k - 0.5) / total, 2.0 / accuracy
    while True:
        ends = rows.agg(F.percentile_approx("score", [max(0.0, share - slack), min(1.0, share + slack)],
                                            accuracy).alias("q"), F.min("score").alias("least"),
                        F.max("score").alias("most")).first()
        low = ends["least"] if share - slack <= 0 else ends["q"][0]
        high = ends["most"] if share + slack >= 1 else ends["q"][1]
        above, inside = rows.agg(F.count(F.when(F.col("score") > high, 1)),
                                 F.count(F.when(F.col("score").between(low, high), 1))).first()
        if above < k <= above + inside:
            break
        slack *= 4  # the sketch missed: widen and count again; at last the bracket holds every score
    bracket = rows.filter(F.col("score").between(low, high)).select("score", "id")
    numbered, _n = global_ordinal_counted(bracket, [F.desc("score"), F.asc("id")], "place")
    return tuple(numbered.filter(F.col("place") == k - above).select("score", "id").first())


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             target_text: str = "text", percent: int = PERCENT, min_words: int = MIN_WORDS, seed: int = SEED,
             buckets: int = BUCKETS, accuracy: int = SKETCH_ACCURACY) -> DataFrame:
    """(``id_col``, n_features, weight, score, rank) of every document; ``rank`` is null where it isn't drawn."""
    with Scratch(docs.sparkSession) as scratch:
        rows = scratch.stored(featured(docs, id_col, text_col, buckets), "features")
        wanted = featured(target.select(F.lit(0).alias("id"), F.col(target_text).alias("text")), "id", "text", buckets)
        table = gains(bucket_counts(rows, buckets), bucket_counts(wanted, buckets))
        scored = stored(map_batches(rows, _weighted(table), "id bigint, n_words bigint, n_features bigint, weight bigint")
                        .withColumn("score", F.col("weight") + _gumbel(seed)), "scores")
    able = scored.filter(F.col("n_words") >= min_words)
    total = able.count()
    k = percent * total // 100
    last = cutoff(able, k, total, accuracy)
    named = F.when(F.col("id") != _NO_ID, F.col("id")).alias(id_col)
    if last is None:
        return scored.select(named, "n_features", "weight", "score", F.lit(None).cast("bigint").alias("rank"))
    score, doc = last
    within = (F.col("n_words") >= min_words) & ((F.col("score") > score)
                                               | ((F.col("score") == score) & (F.col("id") <= doc)))
    # rows of one id that tie at the cutoff are numbered too; those beyond the k-th aren't drawn
    drawn = global_ordinal(scored.filter(within), [F.desc("score"), F.asc("id")], "rank")
    drawn = drawn.withColumn("rank", F.when(F.col("rank") <= k, F.col("rank")))
    return drawn.unionByName(scored.filter(~within).withColumn("rank", F.lit(None).cast("bigint"))).select(
        named, "n_features", "weight", "score", "rank")

