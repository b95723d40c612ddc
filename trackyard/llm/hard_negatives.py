"""Hard-negative mining with a GNAT-style multiway hyperplane tree.

For each anchor its ``positives`` nearest rows of its own label are found, and
for each of them the ``negatives`` best rows of other labels whose score lies
in a window below the positive's. Scores are integer inner products.

1. Sphere. Vectors get one more coordinate that lifts all of them to the norm R
   of the longest; an anchor gets 0 there. An inner product is then a function
   of the angle between them, angles obey the triangle inequality, and a score
   window is an annulus of angles around the anchor.
2. Tree. A node has up to ``ARITY`` split points that lie far apart; each row
   belongs to the nearest one. The node stores, for each split point and each
   subtree, the least and greatest angle between them. The top of the tree is
   fitted on a bounded sample (16 rows a cell, ``ARITY ** LEVELS`` cells at most), the ranges are taken over
   every row. Below it a cell's rows lie in chunks of about ``CHUNK_ROWS``, each with
   a subtree of its own, written to the shared folder: so a cell that holds a
   third of all rows is many tasks' work.
3. Search. Anchors travel in blocks to the chunks that the ranges leave over: a
   subtree goes if for some split point its range of angles doesn't meet the
   annulus. Leaves are exact: all their rows' scores are computed, and the
   k-th best found so far narrows the window. First an anchor's own chunk is searched,
   which bounds its positives' window from below, then the rest.

Nothing is approximate: ranges cover all rows and the angles' rounding is
allowed for. Where vectors have no structure few subtrees go, and the search
is anchors times rows, in blocks.

Defined results: rows with a null label, a null vector, a null or non-finite
component, or a squared norm of 2^62 or more (no score fits a long) take no
part. A row without an id is no anchor, and comes after all others among ties.
Rows that share an id are one another's neither positive nor negative; each
counts otherwise. Shorter vectors count as continued by zeros. No rows or no
anchors, no result. Columns beyond id, vector and label are not read.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trackyard.llm.common import Scratch, map_batches, stored

ARITY, LEVELS = 16, 3
CHUNK_ROWS = 2048
LEAF_ROWS = 128
BLOCK_ANCHORS = 256
_NO_ID = (1 << 63) - 1
_LEAST, _MOST = -(1 << 63), (1 << 63) - 1
_EPS = 1e-6  # of an angle; far above the rounding of arccos


def _matrix(vectors: list[bytes]) -> np.ndarray:
    """Rows of int32 components, shorter ones continued by zeros."""
    rows = [np.frombuffer(v, np.int32) for v in vectors]
    out = np.zeros((len(rows), max(map(len, rows), default=0)), np.int32)
    for at, row in enumerate(rows):
        out[at, :len(row)] = row
    return out


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Approximate inner products, for angles."""
    d = min(a.shape[1], b.shape[1])
    return a[:, :d].astype(np.float64) @ b[:, :d].T.astype(np.float64)


def exact_scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer inner products as int64; floating point is used only where it is exact."""
    d = min(a.shape[1], b.shape[1])
    a, b = a[:, :d], b[:, :d]
    most = (int(np.abs(a.astype(np.int64)).max()) * int(np.abs(b.astype(np.int64)).max()) * d) if a.size and b.size else 0
    if most < 1 << 53:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    return (a.astype(object) @ b.T.astype(object)).astype(np.int64)


class Points:
    """Rows on the sphere of radius ``r``."""

    def __init__(self, vectors: np.ndarray, r: float):
        self.vectors, self.r = vectors, r
        squares = (vectors.astype(np.float64) ** 2).sum(axis=1)
        self.lift = np.sqrt(np.maximum(r * r - squares, 0.0))

    def __getitem__(self, at) -> Points:
        out = object.__new__(Points)
        out.vectors, out.lift, out.r = self.vectors[at], self.lift[at], self.r
        return out

    def __len__(self) -> int:
        return len(self.lift)

    def angles(self, other: Points) -> np.ndarray:
        both = _products(self.vectors, other.vectors) + self.lift[:, None] * other.lift[None, :]
        return np.arccos(np.clip(both / (self.r * self.r or 1.0), -1.0, 1.0))


def _far_apart(points: Points, arity: int, rng: np.random.Generator) -> np.ndarray:
    """Places of up to ``arity`` rows, each as far as can be from those before it; equal rows once."""
    candidates = rng.permutation(len(points))[:4 * arity]
    between = points[candidates].angles(points[candidates])
    chosen, nearest = [0], between[0].copy()
    while len(chosen) < arity and nearest.max() > 1e-4:
        chosen.append(int(nearest.argmax()))
        nearest = np.minimum(nearest, between[chosen[-1]])
    return candidates[chosen]


class Node:
    """Split points, their subtrees (nodes, or leaf numbers), and the angles from split point i to subtree j."""

    def __init__(self, points: Points, below: list):
        self.points, self.below = points, below
        self.lo = np.full((len(points), len(points)), np.inf)
        self.hi = np.full((len(points), len(points)), -np.inf)

    def widen(self, angles: np.ndarray, child: np.ndarray) -> None:
        """Take rows, with their ``angles`` to the split points, into the ranges of their subtrees."""
        for j in np.unique(child):
            inside = angles[child == j]
            self.lo[:, j] = np.minimum(self.lo[:, j], inside.min(axis=0))
            self.hi[:, j] = np.maximum(self.hi[:, j], inside.max(axis=0))

    def score_bounds(self, anchors: np.ndarray, norms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The least and greatest score that a row of each subtree can have with each anchor."""
        scale = norms * self.points.r
        cos = _products(anchors, self.points.vectors) / np.where(scale > 0, scale, 1.0)[:, None]
        angle = np.arccos(np.clip(cos, -1.0, 1.0))[:, :, None]
        near = np.maximum(angle - self.hi - _EPS, self.lo - angle - _EPS).max(axis=1)
        far = np.minimum(angle + self.hi, 2 * np.pi - angle - self.lo).min(axis=1) + _EPS
        least = scale[:, None] * np.cos(np.clip(far, 0.0, np.pi))
        most = scale[:, None] * np.cos(np.clip(near, 0.0, np.pi))
        empty = np.isinf(self.lo[0])
        least[:, empty], most[:, empty] = np.inf, -np.inf
        return least - 1.0, most + 1.0


def fit_top(sample: Points, levels: int, arity: int = ARITY, seed: int = 7) -> tuple[Node | None, int]:
    """The top of the tree over a sample, and the number of its cells; without levels one cell and no node."""
    rng, cells = np.random.default_rng(seed), 0

    def grow(rows: Points, depth: int):
        nonlocal cells
        if depth < levels and len(rows) > 1:
            at = _far_apart(rows, arity, rng)
            if len(at) > 1:
                node = Node(rows[at], [])
                child = rows.angles(node.points).argmin(axis=1)
                node.below = [grow(rows[child == j], depth + 1) for j in range(len(at))]
                return node
        cells += 1
        return cells - 1

    top = grow(sample, 0)
    return (top, cells) if isinstance(top, Node) else (None, 1)


def _nodes(top: Node | None) -> list[Node]:
    out = [top] if top else []
    for node in out:
        out.extend(x for x in node.below if isinstance(x, Node))
    return out


def place(top: Node | None, rows: Points, widen: bool = False) -> np.ndarray:
    """The cell of each row; with ``widen`` the nodes' ranges take the rows in."""
    cell = np.zeros(len(rows), np.int32)
    todo = [(top, np.arange(len(rows)))] if top and len(rows) else []
    while todo:
        node, at = todo.pop()
        angles = rows[at].angles(node.points)
        child = angles.argmin(axis=1)
        if widen:
            node.widen(angles, child)
        for j in np.unique(child):
            if isinstance(node.below[j], Node):
                todo.append((node.below[j], at[child == j]))
            else:
                cell[at[child == j]] = node.below[j]
    return cell


class Chunk:
    """A subtree over some rows; leaves are arrays of places."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, r: float):
        self.ids, self.labels, self.vectors = ids, labels, vectors
        points, rng = Points(vectors, r), np.random.default_rng(len(ids))

        def grow(at: np.ndarray):
            if len(at) <= LEAF_ROWS:
                return at
            rows = points[at]
            split = _far_apart(rows, ARITY, rng)
            node = Node(rows[split], [])
            angles = rows.angles(node.points)
            child = angles.argmin(axis=1)
            parts = [at[child == j] for j in range(len(split))]
            if max(map(len, parts)) == len(at):  # equal rows: nothing to split
                return at
            node.widen(angles, child)
            node.below = [grow(part) for part in parts]
            return node

        self.top = grow(np.arange(len(ids)))


class Block:
    """Anchors with score windows ``low``..``high`` (one row of windows an anchor)."""

    def __init__(self, keys, ids, labels, vectors, low, high):
        self.keys, self.ids, self.labels, self.vectors, self.low, self.high = keys, ids, labels, vectors, low, high
        self.norms = np.sqrt((vectors.astype(np.float64) ** 2).sum(axis=1))

    def __getitem__(self, at) -> Block:
        return Block(self.keys[at], self.ids[at], self.labels[at], self.vectors[at], self.low[at], self.high[at])

    def meets(self, least: np.ndarray, most: np.ndarray, low: np.ndarray | None = None) -> np.ndarray:
        """Whether scores between ``least`` and ``most`` can fall into a window of each anchor."""
        low = self.low if low is None else low
        open_ = low <= self.high
        return ((most[:, :, None] >= low[:, None, :]) & (least[:, :, None] <= self.high[:, None, :])
                & open_[:, None, :]).any(axis=2)


def cells_met(top: Node | None, block: Block) -> dict[int, np.ndarray]:
    """For each cell that may hold rows in a window: the anchors, by place."""
    if top is None:
        return {0: np.arange(len(block.keys))}
    found, todo = {}, [(top, np.arange(len(block.keys)))]
    while todo:
        node, at = todo.pop()
        part = block[at]
        meets = part.meets(*node.score_bounds(part.vectors, part.norms))
        for j, below in enumerate(node.below):
            left = at[meets[:, j]]
            if len(left):
                if isinstance(below, Node):
                    todo.append((below, left))
                else:
                    found[below] = left
    return found


def search_chunk(chunk: Chunk, block: Block, k: int, same_label: bool) -> tuple[np.ndarray, ...]:
    """The best ``k`` rows of the chunk for each anchor and window: (anchor, window, id, score) by place."""
    n, windows = block.low.shape
    low = block.low.copy()  # rises to the k-th best score once there is one
    best = tuple(np.zeros(0, np.int64) for _ in range(4))

    def take(a: np.ndarray, scores: np.ndarray, rows: np.ndarray) -> None:
        nonlocal best
        new = [best]
        for w in range(windows):
            fits = (scores >= low[a, w]) & (scores <= block.high[a, w])
            if fits.any():
                new.append((a[fits], np.full(int(fits.sum()), w), chunk.ids[rows[fits]], scores[fits]))
        if len(new) == 1:
            return
        a, w, ids, s = (np.concatenate(x) for x in zip(*new, strict=True))
        order = np.lexsort((ids, -s, w, a))
        a, w, ids, s = a[order], w[order], ids[order], s[order]
        group = a * windows + w
        first = np.concatenate(([0], np.flatnonzero(np.diff(group)) + 1))
        rank = np.arange(len(group)) - np.repeat(first, np.diff(np.concatenate((first, [len(group)]))))
        kept = rank < k
        best = a[kept], w[kept], ids[kept], s[kept]
        last = rank == k - 1
        low[a[last], w[last]] = np.maximum(low[a[last], w[last]], s[last])

    def visit(below, at: np.ndarray) -> None:
        if isinstance(below, Node):
            part = block[at]
            least, most = below.score_bounds(part.vectors, part.norms)
            for j in np.argsort(-most.sum(axis=0), kind="stable"):
                left = at[part.meets(least[:, [j]], most[:, [j]], low[at])[:, 0]]
                if len(left):
                    visit(below.below[j], left)
            return
        for k0 in range(0, len(below), 1024):
            rows = below[k0:k0 + 1024]
            scores = exact_scores(block.vectors[at], chunk.vectors[rows])
            fits = (chunk.labels[rows][None, :] == block.labels[at][:, None]) == same_label
            fits &= chunk.ids[rows][None, :] != block.ids[at][:, None]
            fits &= (scores >= low[at].min(axis=1)[:, None]) & (scores <= block.high[at].max(axis=1)[:, None])
            a, r = np.nonzero(fits)
            if len(a):
                take(at[a], scores[a, r], rows[r])

    visit(chunk.top, np.arange(n))
    return best


def _prepared(label_scale: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors, squares = [], []
            for v in batch.column(2):
                # beyond this the squared norm is out of range already, and the cast would be undefined
                x = np.clip(np.floor(label_scale * np.asarray(v.as_py(), np.float64)), -4e9, 4e9)
                fits = len(x) == 0 or np.abs(x).max() < 1 << 31
                square = sum(int(c) * int(c) for c in x) if fits and len(x) and np.abs(x).max() > 1 << 20 else \
                    int((x * x).sum()) if fits else 1 << 62
                squares.append(min(square, 1 << 62))
                vectors.append(x.astype(np.int32).tobytes() if fits else b"")
            out = pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(vectors, pa.binary()),
                                              pa.array(squares, pa.int64())], names=["id", "label", "vector", "square"])
            yield out.filter(pa.array([s < 1 << 62 for s in squares], pa.bool_()))
    return run


def _placed(top: Node | None, r: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell = place(top, Points(_matrix(batch.column("vector").to_pylist()), r))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell, pa.int32())],
                                             names=[*batch.schema.names, "cell"])
    return run


def _ranges(top: Node, r: float):
    """One row a task and slot (node, split point, subtree) that has rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place(top, Points(_matrix(batch.column(0).to_pylist()), r), widen=True)
        for at, node in enumerate(_nodes(top)):
            i, j = np.nonzero(node.lo <= node.hi)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(i), at, np.int32)), pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)),
                 pa.array(node.lo[i, j]), pa.array(node.hi[i, j])], names=["node", "i", "j", "lo", "hi"])
    return run


def _chunked(r: float):
    """Rows come sorted by (cell, piece); one chunk at a time is held."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        place_ = None

        def done() -> pa.RecordBatch:
            rows = pa.Table.from_batches(held)
            chunk = Chunk(rows["id"].to_numpy(), rows["label"].to_numpy(), _matrix(rows["vector"].to_pylist()), r)
            return pa.RecordBatch.from_arrays(
                [pa.array([place_[0]], pa.int32()), pa.array([place_[1]], pa.int32()),
                 pa.array([pickle.dumps(chunk, 5)], pa.binary())], names=["cell", "piece", "chunk"])

        for batch in batches:
            places = np.stack([batch.column("cell").to_numpy(), batch.column("piece").to_numpy()], axis=1)
            cuts = np.flatnonzero((places[1:] != places[:-1]).any(axis=1)) + 1
            for a, b in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
                if a == b:
                    continue
                now = tuple(places[a].tolist())
                if held and now != place_:
                    yield done()
                    held = []
                place_ = now
                held.append(batch.slice(a, b - a))
        if held:
            yield done()
    return run


def _routed(top: Node | None, pieces: list[int], home: bool):
    """Blocks of anchors, one row for each chunk that they have to visit (``home``: their own alone)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, BLOCK_ANCHORS):
                batch = whole.slice(at, BLOCK_ANCHORS)
                low, high = (batch.column(c).to_pylist() for c in ("low", "high"))
                width = max(map(len, low))
                block = Block(*(batch.column(c).to_numpy() for c in ("key", "id", "label")),
                              _matrix(batch.column("vector").to_pylist()),
                              np.array([x + [_MOST] * (width - len(x)) for x in low], np.int64).reshape(len(low), width),
                              np.array([x + [_LEAST] * (width - len(x)) for x in high], np.int64).reshape(len(low), width))
                if home:
                    own = np.stack([batch.column(c).to_numpy() for c in ("cell", "piece")], axis=1)
                    out = [(int(c), int(p), np.flatnonzero((own == (c, p)).all(axis=1)))
                           for c, p in np.unique(own, axis=0)]
                else:
                    out = [(c, p, anchors) for c, anchors in cells_met(top, block).items() for p in range(pieces[c])]
                for k in range(0, len(out), 64):
                    part = out[k:k + 64]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([x[0] for x in part], pa.int32()), pa.array([x[1] for x in part], pa.int32()),
                         pa.array([pickle.dumps(block[x[2]], 5) for x in part], pa.binary())],
                        names=["cell", "piece", "block"])
    return run


def _searched(k: int, same_label: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, chunk = None, None
        for batch in batches:
            for row in range(batch.num_rows):
                here = batch.column("cell")[row].as_py(), batch.column("piece")[row].as_py()
                if here != at:  # a chunk's blocks come one after the other
                    at, chunk = here, pickle.loads(batch.column("chunk")[row].as_py())
                block = pickle.loads(batch.column("block")[row].as_py())
                a, w, ids, scores = search_chunk(chunk, block, k, same_label)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(block.keys[a]), pa.array(w.astype(np.int32)), pa.array(ids), pa.array(scores)],
                    names=["key", "window", "other", "score"])
    return run


class HardNegativeIndex:
    """The tree over (id, label, vector) rows, all of them, in the shared folder."""

    def __init__(self, rows: DataFrame, id_col: str, vector_col: str, label: str | Column, scale: float = 256.0,
                 scratch: Scratch | None = None):
        spark = rows.sparkSession
        keep = scratch.stored if scratch else stored
        label = F.col(label) if isinstance(label, str) else label
        taken = rows.select(F.coalesce(F.col(id_col).cast("bigint"), F.lit(_NO_ID)).alias("id"),
                            label.cast("bigint").alias("label"), F.col(vector_col).cast("array<double>").alias("vector")) \
            .filter("label is not null and vector is not null").filter(
                F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
        points = keep(map_batches(taken, _prepared(scale), "id bigint, label bigint, vector binary, square bigint")
                        .withColumn("key", F.monotonically_increasing_id()), "points")
        n, most = points.agg(F.count("key"), F.max("square")).first()
        self.r = float(np.sqrt(most or 0)) * (1 + 1e-12)
        levels = max(x for x in range(LEVELS + 1) if not x or CHUNK_ROWS * ARITY ** x <= n)
        sample = points.select("vector").orderBy(F.xxhash64("key"), "key").limit(ARITY ** levels * 16) if levels else None
        rows_ = [bytes(x[0]) for x in sample.collect()] if levels else []
        self.top, cells = fit_top(Points(_matrix(rows_), self.r), levels)
        if self.top:
            found = map_batches(points.select("vector"), _ranges(self.top, self.r),
                                "node int, i int, j int, lo double, hi double")
            nodes = _nodes(self.top)
            # at most one row a slot of the bounded top of the tree
            for x in found.groupBy("node", "i", "j").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).collect():
                nodes[x["node"]].lo[x["i"], x["j"]], nodes[x["node"]].hi[x["i"], x["j"]] = x["lo"], x["hi"]
        placed = keep(map_batches(points, _placed(self.top, self.r),
                                    "id bigint, label bigint, vector binary, square bigint, key bigint, cell int"), "placed")
        counts = {x["cell"]: x["count"] for x in placed.groupBy("cell").count().collect()}
        self.pieces = [-(-counts.get(c, 0) // CHUNK_ROWS) for c in range(cells)]
        sizes = spark.createDataFrame([(c, max(1, p)) for c, p in enumerate(self.pieces)], "cell int, pieces int")
        self.points = placed.join(F.broadcast(sizes), "cell").withColumn(
            "piece", F.pmod(F.xxhash64("key"), "pieces").cast("int")).drop("pieces")
        ordered = self.points.select("id", "label", "vector", "cell", "piece") \
                             .repartition("cell", "piece").sortWithinPartitions("cell", "piece")
        self.chunks = keep(map_batches(ordered, _chunked(self.r), "cell int, piece int, chunk binary"), "chunks")

    def search(self, anchors: DataFrame, k: int, same_label: bool, home: bool = False) -> DataFrame:
        """(key, window, rank, other, score): the best ``k`` rows in each window of each anchor.

        ``anchors`` has (key, id, label, vector, cell, piece, low, high), the last two arrays of window bounds.
        """
        cols = ["key", "id", "label", "vector", "cell", "piece", "low", "high"]
        blocks = map_batches(anchors.filter(F.size("low") > 0).select(*cols), _routed(self.top, self.pieces, home),
                             "cell int, piece int, block binary")
        # either side may be large, whatever its estimate says
        units = blocks.join(self.chunks.hint("merge"), ["cell", "piece"])
        found = map_batches(units.select("cell", "piece", "block", "chunk"), _searched(k, same_label),
                            "key bigint, window int, other bigint, score bigint")
        best = Window.partitionBy("key", "window").orderBy(F.desc("score"), "other")
        return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)


def hard_negatives(rows: DataFrame, is_anchor: Column, id_col: str = "vec_id", vector_col: str = "embedding",
                   label: str | Column = "label", positives: int = 5, negatives: int = 3,
                   low_percent: int = 50, high_percent: int = 95) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``is_anchor`` is a condition on the column ``id``. A negative's score lies between ``low_percent`` and
    ``high_percent`` of the positive's.
    """
    with Scratch(rows.sparkSession) as scratch:
        index = HardNegativeIndex(rows, id_col, vector_col, label, scratch=scratch)
        all_scores = [F.array(F.lit(x).cast("bigint")) for x in (_LEAST, _MOST)]
        anchors = scratch.stored(index.points.filter((F.col("id") != _NO_ID) & is_anchor)
                              .withColumn("low", all_scores[0]).withColumn("high", all_scores[1]), "anchors")
        near = index.search(anchors, positives, same_label=True, home=True)
        bound = near.filter(F.col("rank") == positives).select("key", F.array("score").alias("at_least"))
        bounded = anchors.join(bound, "key", "left").withColumn("low", F.coalesce("at_least", "low")).drop("at_least")
        found = scratch.stored(index.search(bounded, positives, same_label=True), "positives")

        # floors of exact integers; a positive below zero leaves no window
        low = F.expr(f"-floor(cast(-{low_percent} * cast(score as decimal(38,0)) as decimal(38,0)) / 100)").cast("bigint")
        high = F.expr(f"floor(cast({high_percent} * cast(score as decimal(38,0)) as decimal(38,0)) / 100)").cast("bigint")
        windows = found.groupBy("key").agg(F.sort_array(F.collect_list(
            F.struct("rank", low.alias("low"), high.alias("high")))).alias("w")).select(
            "key", F.col("w.low").alias("low"), F.col("w.high").alias("high"))
        windowed = anchors.drop("low", "high").join(windows, "key")
        mined = index.search(windowed, negatives, same_label=False).select(
            "key", "window", F.col("rank").cast("int").alias("rank"), F.col("other").alias("negative"),
            F.col("score").alias("negative_score"))
        of = found.select("key", (F.col("rank") - 1).alias("window"), F.col("other").alias("positive"),
                          F.col("score").alias("positive_score"))

        def shown(c: str) -> Column:
            return F.when(F.col(c) != _NO_ID, F.col(c))

        result = mined.join(of, ["key", "window"]).join(anchors.select("key", "id"), "key").select(
            F.col("id").alias("anchor_id"), shown("positive").alias("positive_id"), "rank",
            shown("negative").alias("negative_id"), "positive_score", "negative_score")
        return stored(result, "hard-negatives")
