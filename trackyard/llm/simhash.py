"""SimHash near-duplicate detection with BK-trees.

1. Fingerprints. Each word shingle's 64-bit hash votes on the 64 bits; a bit is
   set if over half the hashes have it. Documents of one fingerprint go on as one.
2. Shards. 64 bits are cut into ``RADIUS + 1`` blocks. Fingerprints that differ in
   ``RADIUS`` bits or fewer are equal in one block at least, so each fingerprint goes
   to one shard a block, by the block's value. Values are dealt to shards of about ``TREE_SIZE``
   fingerprints. A value that alone holds more (a large group of near copies) is
   refined: its other bits are cut into blocks in the same way, as often as it takes. So a
   shard is bounded, no link is lost, and a fingerprint goes to few shards.
3. BK-trees. Each shard's fingerprints form a tree: a node's children are keyed by
   their Hamming distance to it. A search from distance d follows the
   edges d - radius to d + radius only. Trees are searched for all their own fingerprints at a time,
   a level in one numpy step. The links that join two components of a shard go on.
4. Components by large-star and small-star.

All trees together grow with the documents, so they aren't broadcast whole:
each tree goes to the task that holds the fingerprints to be looked up in it.

Defined results: a null or empty text, or one without words, has fingerprint 0,
which is linked like any other. Fewer words than a shingle's are one shingle.
A null id counts as the smallest, and is returned as null. Rows that share an id
have the fingerprints of their own texts. Texts are never cut. An empty
table gives an empty result. Columns beyond id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackyard.llm.common import Scratch, map_batches, stored, utf8
from trackyard.llm.components import connected_components

SHINGLE = 3
RADIUS = 2
SEED = 42
TREE_SIZE = 1024
_QUERIES = 512  # fingerprints that are looked up at a time
_NO_ID = -(1 << 63)


def fingerprint(text: bytes, size: int = SHINGLE, seed: int = SEED) -> int:
    """The 64-bit SimHash of a text's word shingles, repeats counted; 0 without words."""
    words = text.lower().split()  # A-Z alone is lower-cased, ASCII white space alone splits
    n = len(words)
    if not n:
        return 0
    joined = b" ".join(words)
    if n <= size:
        hashes = np.array([xxhash.xxh64_intdigest(joined, seed)], np.uint64)
    else:
        ends = (np.cumsum(np.fromiter(map(len, words), np.int64, n)) + np.arange(n)).tolist()
        digest = xxhash.xxh64_intdigest
        starts = [0, *[e + 1 for e in ends[:n - size]]]
        hashes = np.fromiter((digest(joined[a:b], seed) for a, b in zip(starts, ends[size - 1:], strict=True)),
                             np.uint64, n - size + 1)
    votes = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 65536):
        part = hashes[at:at + 65536]
        votes += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return sum(1 << bit for bit in np.flatnonzero(2 * votes > len(hashes)).tolist())


def _fingerprinted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for at in range(0, whole.num_rows, 1024):
            batch = whole.slice(at, 1024)
            found = np.array([fingerprint(t.as_py()) for t in batch.column(1)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found)], names=["doc", "fp"])


class BKTree:
    """Distinct 64-bit values; children of a node are keyed by their Hamming distance to it."""

    def __init__(self, values: np.ndarray):
        self.values = values
        n = len(values)
        parent, key = np.zeros(n, np.int64), np.zeros(n, np.int64)
        waiting, above = np.arange(1, n), np.zeros(max(0, n - 1), np.int64)
        while len(waiting):  # a level at a time: the first at each distance from a node becomes its child
            distance = np.bitwise_count(values[waiting] ^ values[above]).astype(np.int64)
            _, first, group = np.unique(above * 65 + distance, return_index=True, return_inverse=True)
            child = waiting[first]
            parent[child], key[child] = above[first], distance[first]
            rest = np.ones(len(waiting), bool)
            rest[first] = False
            waiting, above = waiting[rest], child[group[rest]]
        order = np.argsort(parent[1:] * 65 + key[1:], kind="stable") + 1
        self.children, self.edges = order, parent[order] * 65 + key[order]

    def within(self, wanted: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """Places of ``wanted`` and of tree values that differ in ``radius`` bits or fewer, pair by pair."""
        query = np.arange(len(wanted))
        node = np.zeros(len(wanted), np.int64)
        found = []
        while len(query):
            distance = np.bitwise_count(wanted[query] ^ self.values[node]).astype(np.int64)
            near = distance <= radius
            found.append((query[near], node[near]))
            # the node's children on the edges distance - radius to distance + radius lie together
            lo = np.searchsorted(self.edges, node * 65 + np.maximum(distance - radius, 0), "left")
            hi = np.searchsorted(self.edges, node * 65 + np.minimum(distance + radius, 64), "right")
            many = hi - lo
            query = np.repeat(query, many)
            skipped = np.repeat(np.cumsum(many) - many, many)
            node = self.children[np.arange(len(query)) - skipped + np.repeat(lo, many)]
        return tuple(np.concatenate(x) for x in zip(*found, strict=True)) if found else (query, node)


def joining_links(values: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """Links of distinct values within ``radius`` bits, enough to join each of their components."""
    tree = BKTree(values)
    root = np.arange(len(values))

    def top(k: int) -> int:
        while root[k] != k:
            root[k] = root[root[k]]
            k = root[k]
        return k

    links = []
    for at in range(0, len(values), _QUERIES):
        a, b = tree.within(values[at:at + _QUERIES], radius)
        a = a + at
        ahead = a < b  # each pair is found from both of its ends
        a, b = a[ahead], b[ahead]
        new = root[a] != root[b]
        for x, y in zip(a[new].tolist(), b[new].tolist(), strict=True):
            p, q = top(x), top(y)
            if p != q:
                root[max(p, q)] = min(p, q)
                links.append((x, y))
        while (root != root[root]).any():
            root = root[root]
    out = np.array(links, np.int64).reshape(-1, 2)
    return values[out[:, 0]], values[out[:, 1]]


def _linked(radius: int):
    """Fingerprints come sorted by shard; one shard at a time is held."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        shard = None

        def done() -> pa.RecordBatch:
            u, v = joining_links(np.unique(np.concatenate(held)), radius)
            return pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], names=["u", "v"])

        for batch in batches:
            if not batch.num_rows:
                continue
            shards, values = batch.column(0).to_numpy(), batch.column(1).to_numpy().view(np.uint64)
            cuts = np.flatnonzero(shards[1:] != shards[:-1]) + 1
            for a, b in zip([0, *cuts], [*cuts, len(shards)], strict=True):
                if held and shards[a] != shard:
                    yield done()
                    held = []
                shard = shards[a]
                held.append(values[a:b].copy())
        if held:
            yield done()
    return run


def _masks(free: int, blocks: int) -> list[int]:
    """The set bits of ``free`` in ``blocks`` runs of nearly equal length, as masks."""
    bits = [b for b in range(64) if free >> b & 1]
    return [sum(1 << b for b in bits[len(bits) * k // blocks:len(bits) * (k + 1) // blocks]) for k in range(blocks)]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def shards(distinct: DataFrame, radius: int = RADIUS, tree_size: int = TREE_SIZE,
           scratch: Scratch | None = None) -> DataFrame:
    """(shard, fp): shards of some ``tree_size`` fingerprints such that close ones share one.

    ``distinct`` is a written table of distinct ``fp``. Its hot values are written at each refinement.
    """
    keep = scratch.stored if scratch else stored
    parts = []
    # (rows, the bits in which all rows of a group are equal): at first all rows are one group
    todo = [(distinct.select("fp", F.lit(0).cast("bigint").alias("group")), 0)]
    while todo:
        rows, fixed = todo.pop()
        free = ((1 << 64) - 1) & ~fixed
        for number, mask in enumerate(_masks(free, radius + 1)):
            shared = fixed | mask
            # what tells the groups apart: the block's place, and the value of all bits that are equal by now
            name = F.xxhash64(F.lit(_signed(fixed)), F.lit(number), F.col("fp").bitwiseAND(F.lit(_signed(shared))))
            placed = rows.select("fp", name.alias("group"))
            sizes = keep(placed.groupBy("group").count().filter("count > 1"), "shard-sizes")
            total, most = sizes.agg(F.sum("count"), F.max("count")).first()
            if not total:
                continue
            n = -(-total // tree_size)
            number_of = F.xxhash64(F.lit(_signed(shared)), F.lit(number), F.pmod(F.col("group"), F.lit(n)))
            done = most <= tree_size or not mask or shared == (1 << 64) - 1
            small = sizes if done else sizes.filter(F.col("count") <= tree_size)
            parts.append(placed.join(small.select("group"), "group").select(number_of.alias("shard"), "fp"))
            if not done:
                hot = sizes.filter(F.col("count") > tree_size).select("group")
                todo.append((keep(placed.join(hot, "group").select("fp", "group"), "hot-shards"), shared))
    if not parts:
        return distinct.select(F.lit(0).cast("bigint").alias("shard"), "fp").limit(0)
    out = parts[0]
    for part in parts[1:]:
        out = out.unionAll(part)
    return out


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS,
                       tree_size: int = TREE_SIZE) -> DataFrame:
    """(doc, fp, component) of each row: its fingerprint and the smallest document reachable over links."""
    rows = docs.select(F.coalesce(F.col(id_col).cast("bigint"), F.lit(_NO_ID)).alias("doc"), utf8(text_col).alias("text"))
    with Scratch(docs.sparkSession) as scratch:
        drawn = scratch.stored(map_batches(rows, _fingerprinted, "doc bigint, fp bigint"), "fingerprints")
        distinct = scratch.stored(drawn.groupBy("fp").agg(F.min("doc").alias("rep")), "distinct")
        placed = shards(distinct, radius, tree_size, scratch)
        ordered = placed.select("shard", "fp").repartition("shard").sortWithinPartitions("shard")
        links = map_batches(ordered, _linked(radius), "u bigint, v bigint")
        roots = connected_components(links, scratch).withColumnsRenamed({"u": "fp", "v": "root"})
        named = distinct.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
        least = named.groupBy("root").agg(F.min("rep").alias("component"))
        judged = drawn.join(named.join(least, "root").select("fp", "component"), "fp").select("doc", "fp", "component")
        return stored(judged, "components")


def _id(c: str) -> Column:
    return F.when(F.col(c) != _NO_ID, F.col(c))


def simhash_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """(doc_id, fingerprint, component_id) of each row; the fingerprint as 16 lowercase hex digits."""
    found = simhash_components(docs, id_col, text_col, **options)
    return found.select(_id("doc").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                        _id("component").alias("component_id"))
