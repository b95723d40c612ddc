"""Benchmark decontamination by a broadcast hash set of test n-grams.

Texts are normalised to words (A-Z lower-cased; every ASCII character that is
no letter or digit separates). A benchmark item gives its windows of ``n``
consecutive words; an item of fewer words is one window. The windows, as
tuples of word ids, are a hash set that goes to every task; each document is
scanned whole. Word ids stand for exact words, so a hit is verified by the
lookup itself; only the quick rolling hash that picks candidates can collide.

The set is broadcast whole only if the benchmark's words stay under
``max_broadcast_words``. A larger benchmark is dealt into parts of that size, and
the documents are scanned for one part after the other.

Defined results: a null text has no words; an item without words gives no
window; a null item_id counts its hits in ``n_hit`` but is no item; rows that
repeat an item_id add up to one item. Repeated documents are judged alone.
Empty tables give no rows or no hits.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackyard.llm.common import arrow_column, map_batches, stored, utf8

WINDOW = 10
MAX_BROADCAST_WORDS = 4_000_000

# byte -> byte: A-Z to a-z, separators to a space, all else as it is
_TO_WORDS = bytes(b + 32 if 0x41 <= b <= 0x5A else
                  b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))
_WORD = re.compile(rb"[^ ]+")
_MIX = np.array([pow(0x9E3779B97F4A7C15, 2 * i + 1, 1 << 64) | 1 for i in range(64)], np.uint64)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_TO_WORDS).split()


def _rolling(ids: np.ndarray, size: int) -> np.ndarray:
    """A hash of each window of ``size`` word ids."""
    n = len(ids) - size + 1
    u = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
    out = np.zeros(n, np.uint64)
    for j in range(size):
        out += (u[j:j + n] ^ (u[j:j + n] >> np.uint64(29))) * _MIX[j % 64] * np.uint64(2 * (j // 64) + 1)
    return out


class NgramSet:
    """The benchmark's windows, by length, as tuples of word ids."""

    def __init__(self, items: list[tuple[object, list[bytes]]], n: int = WINDOW):
        self.vocabulary: dict[bytes, int] = {}
        self.windows: dict[int, dict[tuple, set]] = {}
        for item_id, words in items:
            if not words:
                continue
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words]
            size = min(n, len(ids))
            table = self.windows.setdefault(size, {})
            for k in range(len(ids) - size + 1):
                table.setdefault(tuple(ids[k:k + size]), set()).add(None if item_id is None else str(item_id))
        self.hashes = {size: np.unique(np.concatenate([_rolling(np.array(w, np.int64), size) for w in table]))
                       for size, table in self.windows.items()}

    def scan(self, words: list[bytes]) -> tuple[np.ndarray, set]:
        """Which words lie inside an occurrence of a window; the items of those windows."""
        n = len(words)
        hit, items = np.zeros(n, bool), set()
        if not n or not self.windows:
            return hit, items
        ids = np.fromiter(map(self.vocabulary.get, words, _minus_ones()), np.int64, n)
        unknown = np.concatenate(([0], np.cumsum(ids < 0)))
        for size, table in self.windows.items():
            if size > n:
                continue
            whole = unknown[size:] == unknown[:-size]
            if not whole.any():
                continue
            starts = np.flatnonzero(whole)
            found = self.hashes[size]
            h = _rolling(ids, size)[starts]
            at = np.minimum(np.searchsorted(found, h), len(found) - 1)
            for k in starts[found[at] == h].tolist():
                of = table.get(tuple(ids[k:k + size].tolist()))
                if of is not None:
                    hit[k:k + size] = True
                    items |= of
        return hit, items


def _minus_ones():
    while True:
        yield -1


def _item_digest(items: set) -> tuple[int, str]:
    named = sorted(i for i in items if i is not None)
    return len(named), hashlib.sha256(",".join(named).encode()).hexdigest()


def cut_spans(raw: bytes, hit: np.ndarray) -> str:
    """The text without its hit words and what stands between neighbouring ones."""
    spans = [m.span() for m in _WORD.finditer(raw.translate(_TO_WORDS))]
    edges = np.flatnonzero(np.diff(np.concatenate(([0], hit.view(np.int8), [0]))))
    out, at = [], 0
    for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
        out.append(raw[at:spans[a][0]])
        at = spans[b - 1][1]
    return b"".join([*out, raw[at:]]).decode()


def benchmark_items(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text",
                    max_words: int = MAX_BROADCAST_WORDS) -> list[tuple[object, list[bytes]]] | None:
    """The items' words, or None if the benchmark may have more than ``max_words`` words."""
    # a word takes at least one byte and all but the last a separator
    size = benchmark.agg(F.sum(F.octet_length(text_col) + 1)).first()[0] or 0
    if size > 2 * max_words:
        return None
    return [(r[0], words_of(bytes(r[1] or b"")))
            for r in benchmark.select(F.col(id_col).cast("string"), utf8(text_col)).collect()]


REPORT_SCHEMA = ("doc_id bigint, n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, "
                 "contaminated boolean")


def contamination_report(docs: DataFrame, benchmark: DataFrame, n: int = WINDOW, id_col: str = "doc_id",
                         text_col: str = "text", max_broadcast_words: int = MAX_BROADCAST_WORDS) -> DataFrame:
    """One row per document: words, hit words, items with occurring windows and their digest."""
    items = benchmark_items(benchmark, max_words=max_broadcast_words)
    if items is None:
        return _report_by_part(docs, benchmark, n, id_col, text_col, max_broadcast_words)
    shared = docs.sparkSession.sparkContext.broadcast(NgramSet(items, n))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ngrams = shared.value
        for batch in batches:
            rows = []
            for text in batch.column(1):
                words = words_of(text.as_py())
                hit, of = ngrams.scan(words)
                n_hit = int(hit.sum())
                rows.append((len(words), n_hit, *_item_digest(of), n_hit > 0))
            cols = list(zip(*rows, strict=True)) or [[]] * 5
            types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, t) for c, t in zip(cols, types, strict=True))],
                names=["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"])

    return map_batches(docs.select(F.col(id_col).cast("bigint").alias("doc_id"), utf8(text_col).alias("text")),
                       scan, REPORT_SCHEMA)


SEGMENT_WORDS = 50_000


def _segments(n: int):
    """Items, long ones in overlapping segments that together have the same windows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, text in zip(batch.column(0), batch.column(1), strict=True):
                words = words_of(text.as_py())
                starts = range(0, max(1, len(words) - n + 1), SEGMENT_WORDS)
                parts = [b" ".join(words[k:k + SEGMENT_WORDS + n - 1]) for k in starts]
                yield pa.RecordBatch.from_arrays([pa.array([item.as_py()] * len(parts), pa.string()),
                                                  pa.array(parts, pa.binary())], names=["item", "words"])
    return run


def _hits_by_part(texts: DataFrame, benchmark: DataFrame, n: int, max_words: int) -> DataFrame:
    """(key, spans, items) of each text (key, text) with a hit: (pos, size) of its hit runs, and the items.

    The benchmark is dealt into parts of some ``max_words`` words. One part at a time is broadcast
    and all texts are scanned for it, so the texts are never shuffled.
    """
    spark = texts.sparkSession
    items = stored(map_batches(benchmark.select(F.col("item_id").cast("string").alias("item"), utf8("text").alias("text")),
                               _segments(n), "item string, words binary"), "items")
    size = items.agg(F.sum(F.octet_length("words") + 1)).first()[0] or 0
    # a word takes at least one byte and all but the last a separator
    parts = -(-size // (2 * max(max_words, 500)))
    schema = "key string, spans array<struct<pos: int, size: int>>, items array<string>"
    found = []
    for part in range(parts):
        mine = items.filter(F.pmod(F.xxhash64("item", "words"), F.lit(parts)) == part)
        shared = spark.sparkContext.broadcast(NgramSet([(r[0], bytes(r[1]).split()) for r in mine.collect()], n))

        def scan(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            ngrams = shared.value
            for batch in batches:
                keys, runs, of = [], [], []
                for key, text in zip(batch.column(0), batch.column(1), strict=True):
                    hit, held = ngrams.scan(words_of(text.as_py()))
                    if hit.any():
                        edges = np.flatnonzero(np.diff(np.concatenate(([0], hit.view(np.int8), [0])))).tolist()
                        keys.append(key.as_py())
                        runs.append([{"pos": a, "size": b - a} for a, b in zip(edges[::2], edges[1::2], strict=True)])
                        of.append([x for x in held if x is not None])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys, pa.string()),
                     pa.array(runs, pa.list_(pa.struct([("pos", pa.int32()), ("size", pa.int32())]))),
                     pa.array(of, pa.list_(pa.string()))], names=["key", "spans", "items"])

        # equal texts have equal hits: one of them is enough
        found.append(stored(map_batches(texts.select("key", "text"), scan, schema).dropDuplicates(["key"]), "hits"))
        shared.destroy()
    hits = reduce(DataFrame.unionAll, found) if found else spark.createDataFrame([], schema)
    return hits.groupBy("key").agg(F.flatten(F.collect_list("spans")).alias("spans"),
                                   F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"))


def _hit_words(n_words: int, spans: list[dict] | None) -> np.ndarray:
    hit = np.zeros(n_words, bool)
    for s in spans or []:
        hit[s["pos"]:s["pos"] + s["size"]] = True
    return hit


def _report_by_part(docs: DataFrame, benchmark: DataFrame, n: int, id_col: str, text_col: str, max_words: int) -> DataFrame:
    """The same report where the benchmark is too large to broadcast whole."""
    # repeated rows have equal digests of the text, hence equal verdicts
    tagged = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), utf8(text_col).alias("text")) \
                 .withColumn("key", F.sha2("text", 256))
    spans = _hits_by_part(tagged, benchmark, n, max_words)

    def count(batches):
        for batch in batches:
            rows = []
            for text, spans in zip(batch.column(1), batch.column(2), strict=True):
                total = len(words_of(text.as_py()))
                rows.append((total, int(_hit_words(total, spans.as_py()).sum())))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([r[0] for r in rows], pa.int64()),
                 pa.array([r[1] for r in rows], pa.int64()), batch.column(3)],
                names=["doc_id", "n_words", "n_hit", "items"])

    joined = tagged.join(spans, "key", "left").select("doc_id", "text", "spans", "items")
    counted = map_batches(joined, count, "doc_id bigint, n_words bigint, n_hit bigint, items array<string>")
    named = F.coalesce(F.sort_array("items"), F.array().cast("array<string>"))
    return counted.select("doc_id", "n_words", "n_hit", F.size(named).cast("bigint").alias("n_items"),
                          F.sha2(F.array_join(named, ",").cast("binary"), 256).alias("items_sha256"),
                          (F.col("n_hit") > 0).alias("contaminated"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, n: int = WINDOW, remove: str = "documents",
                  text_col: str = "text", max_broadcast_words: int = MAX_BROADCAST_WORDS) -> DataFrame:
    """The documents, all columns, without contaminated ones (``remove="documents"``) or without their hit
    spans (``remove="spans"``; ``n_chars`` follows the text if there, a text of hit words alone goes).

    Python gets the texts and returns, for contaminated ones alone, what is left of them.
    """
    if remove not in ("documents", "spans"):
        raise ValueError(f"remove: {remove!r}")
    spark, spans = docs.sparkSession, remove == "spans"
    items = benchmark_items(benchmark, max_words=max_broadcast_words)
    if items is None:
        rows = docs.withColumn("__key", F.sha2(utf8(text_col), 256))
        found = _hits_by_part(rows.select(F.col("__key").alias("key"), utf8(text_col).alias("text")), benchmark, n,
                              max_broadcast_words).select(F.col("key").alias("__key"), F.col("spans").alias("__spans"))
        rows = rows.join(found, "__key", "left")
        seen = F.struct(F.when(F.col("__spans").isNotNull(), utf8(text_col)).alias("text"), F.col("__spans").alias("spans"))

        def hits_of(batch: pa.StructArray) -> Iterator[tuple[bytes, np.ndarray]]:
            for text, found in zip(batch.field("text"), batch.field("spans"), strict=True):
                raw = text.as_py() or b""
                yield raw, _hit_words(len(words_of(raw)), found.as_py())
    else:
        rows, shared = docs, spark.sparkContext.broadcast(NgramSet(items, n))
        seen = utf8(text_col)

        def hits_of(batch: pa.Array) -> Iterator[tuple[bytes, np.ndarray]]:
            for text in batch:
                raw = text.as_py()
                yield raw, shared.value.scan(words_of(raw))[0]

    def left_over(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            clean, left = [], []
            for raw, hit in hits_of(batch):
                clean.append(not hit.any())
                left.append(cut_spans(raw, hit) if spans and not clean[-1] and not hit.all() else None)
            yield pa.StructArray.from_arrays([pa.array(clean, pa.bool_()), pa.array(left, pa.string())],
                                             names=["clean", "left"])

    judged = rows.withColumn("__judged", arrow_column(spark, left_over, "clean boolean, left string")(seen))
    clean, left = F.col("__judged.clean"), F.col("__judged.left")
    if not spans:
        return judged.filter(clean).select(*docs.columns)
    out = []
    for c in docs.columns:
        if c == text_col:
            out.append(F.when(clean, F.col(c)).otherwise(left).alias(c))
        elif c == "n_chars":
            changed = ~clean & (left != F.col(text_col))
            out.append(F.when(changed, F.char_length(left)).otherwise(F.col(c)).cast(docs.schema[c].dataType).alias(c))
        else:
            out.append(F.col(c))
    return judged.filter(clean | left.isNotNull()).select(*out)
