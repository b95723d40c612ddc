"""MinHash near-duplicate detection, confirmed on full shingle sets.

1. Sketch. Each document's set of distinct ``SHINGLE``-word shingles (64-bit
   hashes) gives ``BANDS * ROWS`` universal hash minima, banded into bucket
   keys, plus 16 bits of each minimum as its signature. Documents with the same
   word sequence form a class and go on as one.
2. Stars. In each bucket the smallest class is the centre; members are linked
   with it if the signatures agree well enough and the full sets have
   similarity ``SIMILARITY`` or more. This is linear in the bucket's size.
3. Components by large-star and small-star.
4. The rest. Buckets that still hold several components are searched whole:
   their members are dealt into blocks of bounded size, each pair of blocks is
   a task unit of its own, and every pair of members in different components
   whose first common bucket this is gets compared. So no link is lost to the
   choice of centres, no group meets in one task, and no pair is emitted
   unless it links two components.

Only the banding and the signature test are probabilistic. With 32 bands of 4
a pair at the threshold is missed with probability (1 - 0.75^4)^32 = 5e-6; the
signature test lets pass whatever is within five standard deviations.

Defined results: a document without words has ``n_shingles`` 0 and is its own
component. Rows that share a doc_id are judged by their own texts; equal ones
stay or go together. A null doc_id is the smallest id. Columns beyond id and
text are not read.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackyard.llm.common import Scratch, map_batches, stored, utf8
from trackyard.llm.components import connected_components

SHINGLE = 5
SIMILARITY = 75  # in hundredths
BANDS, ROWS = 32, 4
BLOCK_SHINGLES = 500_000  # of the members of a block, about
_WORDS_KEPT = 300_000     # hashes of words that a worker remembers
_LONG_MIN = -(1 << 63)

_RNG = np.random.Generator(np.random.PCG64(20240607))
_A = _RNG.integers(0, 1 << 63, BANDS * ROWS, np.uint64) * np.uint64(2) + np.uint64(1)
_B = _RNG.integers(0, 1 << 63, BANDS * ROWS, np.uint64)
_P = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= _WORDS_KEPT:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def normalised_words(text: bytes) -> list[bytes]:
    """A-Z lower-cased, split at ASCII white space."""
    return text.lower().split()


def shingle_set(words: list[bytes], hashes: dict, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles; a shorter text is one shingle, no words none."""
    n = len(words)
    if n == 0:
        return np.zeros(0, np.uint64)
    if n < size:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), seed=n)], np.uint64)
    w = np.fromiter(map(hashes.__getitem__, words), np.uint64, n)
    acc = np.zeros(n - size + 1, np.uint64)
    for j in range(size):
        acc = acc * _P + w[j:n - size + 1 + j]
    return np.unique(_mixed(acc))


def minima(shingles: np.ndarray) -> np.ndarray:
    """The least value of each universal hash function over the set."""
    low = np.full(len(_A), np.iinfo(np.uint64).max, np.uint64)
    for k in range(0, len(shingles), 512):
        np.minimum(low, (_A[:, None] * shingles[None, k:k + 512] + _B[:, None]).min(axis=1), out=low)
    return low


def bucket_keys(low: np.ndarray) -> np.ndarray:
    """One 64-bit key a band; the band's number is part of it."""
    acc = np.arange(1, BANDS + 1, dtype=np.uint64) * _P
    for column in low.reshape(BANDS, ROWS).T:
        acc = _mixed((acc ^ column) * _P)
    return acc.view(np.int64)


def signature(low: np.ndarray) -> np.ndarray:
    return ((low * _P) >> np.uint64(48)).astype(np.uint16).view(np.int16)


def _class_key(words: list[bytes]) -> bytes:
    return xxhash.xxh3_128_digest(b" ".join(words))


def _lists(arrays: list[np.ndarray], kind: np.dtype) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum([len(a) for a in arrays]))).astype(np.int32)
    values = np.concatenate(arrays) if arrays else np.zeros(0, kind)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.astype(kind, copy=False)))


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes = _WordHashes()
    none = np.zeros(0, np.int64)
    for whole in batches:
        for at in range(0, whole.num_rows, 2048):
            batch = whole.slice(at, 2048)
            keys, counts, bands, sigs = [], [], [], []
            for text in batch.column(1):
                words = normalised_words(text.as_py())
                s = shingle_set(words, hashes)
                low = minima(s) if len(s) else None
                keys.append(_class_key(words))
                counts.append(len(s))
                bands.append(none if low is None else bucket_keys(low))
                sigs.append(none.astype(np.int16) if low is None else signature(low))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(keys, pa.binary()), pa.array(counts, pa.int64()),
                 _lists(bands, np.int64), _lists(sigs, np.int16)], names=["doc", "tag", "key", "n", "bands", "sig"])


def _tag(text_col: str):
    return F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))


def sketches(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc, tag, key, n, bands, sig) of each row; ``tag`` tells apart texts of one doc_id."""
    rows = docs.select(F.coalesce(F.col(id_col).cast("bigint"), F.lit(_LONG_MIN)).alias("doc"),
                       utf8(text_col).alias("text"), _tag(text_col).alias("tag"))
    return map_batches(rows, _sketch,
                       "doc bigint, tag bigint, key binary, n bigint, bands array<bigint>, sig array<smallint>")


def _least_agreement(similarity: int) -> int:
    s, k = similarity / 100, BANDS * ROWS
    return max(0, math.floor(k * s - 5 * math.sqrt(k * s * (1 - s))))


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes = _WordHashes()
    for batch in batches:
        keep, sets = [], []
        for key, text in zip(batch.column(0), batch.column(1), strict=True):
            words = normalised_words(text.as_py())
            same = _class_key(words) == key.as_py()  # another text of the same doc_id
            keep.append(same)
            if same:
                sets.append(shingle_set(words, hashes).tobytes())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).filter(pa.array(keep, pa.bool_())), pa.array(sets, pa.binary())], names=["key", "set"])


def _similar(a: np.ndarray, b: np.ndarray, similarity: int) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= similarity * (len(a) + len(b) - both)


def _confirm(similarity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = [_similar(np.frombuffer(a.as_py(), np.uint64), np.frombuffer(b.as_py(), np.uint64), similarity)
                  for a, b in zip(batch.column(2), batch.column(3), strict=True)]
            yield batch.select(["u", "v"]).filter(pa.array(ok, pa.bool_()))
    return run


def _search(unit: list[tuple], similarity: int, least: int) -> list[tuple[bytes, bytes]]:
    """Links between components among the members of one block, or between two blocks, of a bucket.

    ``unit`` holds (h, i, j, block, key, comp, set, bands, sig) of each member.
    """
    h, lo, hi = unit[0][:3]
    members = list({row[4]: row for row in unit}.values())
    keys = [r[4] for r in members]
    # the component of each member, as a number; members of one component aren't compared
    comp = np.unique(np.array([r[5].hex() for r in members]), return_inverse=True)[1]
    block = np.array([r[3] for r in members])
    bands, sigs = np.array([r[7] for r in members], np.int64), np.array([r[8] for r in members], np.int16)
    sets = [np.frombuffer(r[6], np.uint64) for r in members]
    sizes = np.array([len(s) for s in sets])
    vocabulary, ids = np.unique(np.concatenate(sets), return_inverse=True)
    starts = np.concatenate(([0], np.cumsum(sizes)))[:-1]
    found = []
    mark = np.zeros(len(vocabulary), bool)
    for a in range(len(keys) - 1):
        rest = a + 1 + np.flatnonzero(comp[a + 1:] != comp[a])
        fit = 100 * np.minimum(sizes[rest], sizes[a]) >= similarity * np.maximum(sizes[rest], sizes[a])
        if lo != hi:
            fit &= block[rest] != block[a]
        rest = rest[fit]
        rest = rest[(sigs[rest] == sigs[a]).sum(axis=1) >= least]
        if len(rest):  # the pair's first common bucket is the one to compare it
            rest = rest[bands[a][(bands[rest] == bands[a]).argmax(axis=1)] == h]
        if not len(rest):
            continue
        mark[ids[starts[a]:starts[a] + sizes[a]]] = True
        for b in rest.tolist():
            if comp[b] == comp[a]:  # linked just now
                continue
            both = int(mark[ids[starts[b]:starts[b] + sizes[b]]].sum())
            if 100 * both >= similarity * (sizes[a] + sizes[b] - both):
                comp[comp == comp[b]] = comp[a]
                found.append((keys[a], keys[b]))
        mark[ids[starts[a]:starts[a] + sizes[a]]] = False
    return found


def _search_rarest(unit: list[tuple], similarity: int) -> list[tuple[bytes, bytes]]:
    """``_search`` for members without signatures: only sets that share one of their rarest elements are compared."""
    h, lo, hi = unit[0][:3]
    members = list({row[4]: row for row in unit}.values())
    keys = [r[4] for r in members]
    # the component of each member, as a number; members of one component aren't compared
    comp = np.unique(np.array([r[5].hex() for r in members]), return_inverse=True)[1]
    block = np.array([r[3] for r in members])
    bands = np.array([r[7] for r in members], np.int64)
    sets = [np.frombuffer(r[6], np.uint64) for r in members]
    sizes = np.array([len(s) for s in sets])
    vocabulary, ids = np.unique(np.concatenate(sets), return_inverse=True)
    starts = np.concatenate(([0], np.cumsum(sizes)))[:-1]
    found = []
    # similar sets share one of their rarest elements: as many of each as the similarity may leave out, and one more
    amount = np.bincount(ids, minlength=len(vocabulary))
    rare, owner = [], []
    for k, (at, n) in enumerate(zip(starts.tolist(), sizes.tolist(), strict=True)):
        own = ids[at:at + n]
        first = own[np.argsort(amount[own], kind="stable")][:n - -(-similarity * n // 100) + 1]
        rare.append(first)
        owner.append(np.full(len(first), k))
    rare, owner = np.concatenate(rare), np.concatenate(owner)
    order = np.lexsort((owner, rare))
    rare, owner = rare[order], owner[order]
    cuts = np.concatenate(([0], np.flatnonzero(np.diff(rare)) + 1, [len(rare)]))
    for lo_at in np.flatnonzero(np.diff(cuts) > 1).tolist():
        group = owner[cuts[lo_at]:cuts[lo_at + 1]]
        for at, a in enumerate(group[:-1].tolist()):
            rest = group[at + 1:]
            rest = rest[comp[rest] != comp[a]]
            if not len(rest):
                continue
            fit = 100 * np.minimum(sizes[rest], sizes[a]) >= similarity * np.maximum(sizes[rest], sizes[a])
            if lo != hi:
                fit &= block[rest] != block[a]
            rest = rest[fit]
            if len(rest):  # the pair's first common bucket is the one to compare it
                rest = rest[bands[a][(bands[rest] == bands[a]).argmax(axis=1)] == h]
            own = ids[starts[a]:starts[a] + sizes[a]]
            for b in rest.tolist():
                if comp[b] == comp[a]:  # linked just now
                    continue
                both = len(np.intersect1d(own, ids[starts[b]:starts[b] + sizes[b]], assume_unique=True))
                if 100 * both >= similarity * (sizes[a] + sizes[b] - both):
                    comp[comp == comp[b]] = comp[a]
                    found.append((keys[a], keys[b]))
    return found


def _search_units(similarity: int, least: int):
    """Rows come sorted by unit (h, i, j); one unit at a time is held."""
    search = partial(_search, least=least) if least else _search_rarest

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit: list[tuple] = []
        found: list[tuple[bytes, bytes]] = []
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                for row in zip(*(c.to_pylist() for c in batch.slice(at, 512).columns), strict=True):
                    if unit and unit[0][:3] != row[:3]:
                        found += search(unit, similarity)
                        unit = []
                    unit.append(row)
            if found:
                yield _links(found)
                found = []
        if unit:
            found = search(unit, similarity)
        yield _links(found)
    return run


def _links(found: list[tuple[bytes, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([u for u, _ in found], pa.binary()),
                                       pa.array([v for _, v in found], pa.binary())], names=["u", "v"])


def class_components(classes: DataFrame, load_sets: Callable[[DataFrame], DataFrame], similarity: int = SIMILARITY,
                     least: int = 0, block_shingles: int = BLOCK_SHINGLES, scratch: Scratch | None = None) -> DataFrame:
    """(u, v) of ``connected_components`` over all links between classes.

    ``classes`` (key, n, bands, sig) is a written table; ``load_sets`` gives (key, set), written too, for the
    keys it is asked for. ``least`` is the number of signature entries that must agree. Tables on the way,
    and the result's, live as long as ``scratch``.
    """
    keep = scratch.stored if scratch else stored
    placed = classes.select("key", "n", F.explode("bands").alias("h"))
    buckets = placed.groupBy("h").agg(F.count("key").alias("members"), F.min("key").alias("centre"),
                                      F.sum("n").alias("total")).filter("members > 1")
    members = keep(placed.drop("n").join(buckets, "h"), "buckets")

    sig = classes.select("key", "sig")
    stars = members.filter("key <> centre").select(F.col("centre").alias("u"), F.col("key").alias("v")).distinct()
    agree = F.size(F.filter(F.zip_with("a", "b", lambda x, y: x == y), lambda same: same))
    rated = keep(stars.join(sig.select(F.col("key").alias("u"), F.col("sig").alias("a")), "u")
                        .join(sig.select(F.col("key").alias("v"), F.col("sig").alias("b")), "v")
                        .select("u", "v", (agree >= least).alias("close")), "stars")
    close = rated.filter("close").select("u", "v")
    # a bucket of two is decided by its star; a larger one may hold links beside the centre
    doubtful = members.join(rated.filter("not close").select(F.col("u").alias("centre"), F.col("v").alias("key")),
                            ["centre", "key"], "left_semi").filter("members > 2").select("h").distinct()
    wanted = close.select(F.col("u").alias("key")).unionAll(close.select(F.col("v").alias("key"))).unionAll(
        members.filter("members > 2").join(doubtful, "h", "left_semi").select("key")).distinct()
    sets = load_sets(wanted)

    pairs = (close.join(sets.select(F.col("key").alias("u"), F.col("set").alias("a")), "u")
                  .join(sets.select(F.col("key").alias("v"), F.col("set").alias("b")), "v")
                  .select("u", "v", "a", "b"))
    links = map_batches(pairs, _confirm(similarity), "u binary, v binary")
    first = connected_components(links, scratch)

    label = first.select(F.col("u").alias("key"), F.col("v").alias("comp"))
    held = members.filter("members > 2").select("h", "key", "total").join(label, "key", "left") \
                  .withColumn("comp", F.coalesce("comp", "key"))
    mixed = held.groupBy("h").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo <> hi").select("h")
    blocks = F.ceil(F.col("total") / F.lit(block_shingles)).cast("int")
    units = (held.join(mixed, "h").withColumn("blocks", blocks)
                 .withColumn("block", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int"))
                 .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
                 .select("h", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
                         "block", "key", "comp"))
    loaded = units.join(sets, "key").join(classes.select("key", "bands", "sig"), "key").select(
        "h", "i", "j", "block", "key", "comp", "set", "bands", "sig")
    ordered = loaded.repartition("h", "i", "j").sortWithinPartitions("h", "i", "j")
    more = map_batches(ordered, _search_units(similarity, least), "u binary, v binary")
    return connected_components(first.unionAll(more), scratch)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    similarity: int = SIMILARITY, block_shingles: int = BLOCK_SHINGLES) -> DataFrame:
    """(doc, tag, n, component) of each row: its set's size and the smallest document reachable.

    The one table left in the shared folder is the narrow one that the result reads.
    """
    def load_sets(wanted: DataFrame) -> DataFrame:
        reps = classes.join(wanted, "key").select("key", F.col("rep").alias("doc"))
        texts = docs.select(F.coalesce(F.col(id_col).cast("bigint"), F.lit(_LONG_MIN)).alias("doc"),
                            utf8(text_col).alias("text")).join(reps, "doc").select("key", "text")
        return scratch.stored(map_batches(texts, _sets, "key binary, set binary").dropDuplicates(["key"]), "sets")

    with Scratch(docs.sparkSession) as scratch:
        drawn = scratch.stored(sketches(docs, id_col, text_col), "sketches")
        classes = scratch.stored(drawn.filter("n > 0").groupBy("key").agg(
            F.min("doc").alias("rep"), F.first("n").alias("n"), F.first("bands").alias("bands"),
            F.first("sig").alias("sig")), "classes")
        final = class_components(classes, load_sets, similarity, _least_agreement(similarity), block_shingles, scratch)
        roots = classes.select("key", "rep").join(final.withColumnsRenamed({"u": "key", "v": "root"}), "key", "left") \
                       .withColumn("root", F.coalesce("root", "key"))
        least_doc = roots.groupBy("root").agg(F.min("rep").alias("component"))
        named = roots.join(least_doc, "root").select("key", "component")
        judged = drawn.select("doc", "tag", "key", "n").join(named, "key", "left").select(
            "doc", "tag", "n", F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc")).alias("component"))
        return stored(judged, "near-duplicates")


def _id(c: str):
    return F.when(F.col(c) != _LONG_MIN, F.col(c))


def near_duplicate_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of each row; null ids stay null."""
    found = near_duplicates(docs, id_col, text_col, **options)
    return found.select(_id("doc").alias("doc_id"), F.col("n").alias("n_shingles"),
                        _id("component").alias("component_id"), (F.col("doc") == F.col("component")).alias("kept"))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents, all columns, one of each group: the one of the smallest id."""
    # a row goes only if its own text has lost: texts of one doc_id are judged apart
    gone = near_duplicates(docs, id_col, text_col, **options).filter("doc <> component").select(
        F.col("doc").alias("__doc"), F.col("tag").alias("__tag")).distinct()
    same = (F.coalesce(F.col(id_col).cast("bigint"), F.lit(_LONG_MIN)) == F.col("__doc")) & \
        (_tag(text_col) == F.col("__tag"))
    return docs.join(gone, same, "left_anti")
