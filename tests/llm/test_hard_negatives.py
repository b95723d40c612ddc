import random

import pytest
from pyspark.sql import functions as F

from tests.oracle import compare, duck
from trackyard.llm import hard_negatives as H
from trackyard.llm.queries import OP11_SQL, op11_hard_negatives

COLUMNS = "vec_id bigint, embedding array<float>, label int, key string, cell int, score double, low int"


def frame(spark, rows):
    """A table like ``embeddings`` with further columns whose names clash with the operator's own."""
    return spark.createDataFrame([(*r, "k", 1, 0.5, 2) for r in rows], COLUMNS)


def brute(rows, every, positives=5, negatives=3):
    taken = [(i, [int(256 * c // 1) for c in v], y) for i, v, y in rows
             if y is not None and v is not None and all(c is not None and abs(c) < float("inf") for c in v)]
    late = lambda i: (i is None, i)
    out = []
    for i, v, y in taken:
        if i is None or i % every:
            continue
        scored = [(sum(a * b for a, b in zip(v, w, strict=False)), j, z) for j, w, z in taken if j != i]
        scored.sort(key=lambda x: (-x[0], late(x[1])))
        for s, j, _ in [x for x in scored if x[2] == y][:positives]:
            hard = [x for x in scored if x[2] != y and 50 * s <= 100 * x[0] <= 95 * s][:negatives]
            out += [(i, j, r, k, s, t) for r, (t, k, _) in enumerate(hard, 1)]
    return out


def srt(rows):
    return sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


def clustered(n, d=8, seed=1, spread=0.3):
    r = random.Random(seed)
    centres = [[r.gauss(0, 1) for _ in range(d)] for _ in range(6)]
    out = []
    for i in range(n):
        c = r.choice(centres)
        out.append((i, [float(int(1000 * (x + r.gauss(0, spread)))) / 1000 for x in c], r.randrange(3)))
    return out


AWKWARD = [(1000, None, 1), (1001, [0.5, None, 1.0], 1), (1002, [float("nan"), 1.0], 1), (1005, [float("inf")], 2),
           (1010, [0.1, 0.2], None), (1015, [], 1), (1020, [0.0] * 8, 2), (1025, [-3.0] * 8, 1), (1030, [1.0] * 3, 0),
           (None, [1.0] * 8, 0), (None, [1.0] * 8, 1), (1035, [1.0] * 8, 0), (1035, [1.0] * 8, 0),
           (1035, [0.5] * 8, 1), (1040, [3e38] * 8, 1), (1045, [1.0] * 9, 1)]


@pytest.mark.parametrize(("chunk", "leaf", "arity"), [(2048, 128, 16), (20, 4, 3)])
def test_against_brute_force(spark, monkeypatch, chunk, leaf, arity):
    for name, value in (("CHUNK_ROWS", chunk), ("LEAF_ROWS", leaf), ("ARITY", arity), ("BLOCK_ANCHORS", 7)):
        monkeypatch.setattr(H, name, value)
    r = random.Random(4)
    copies = [(2000 + k, [0.7] * 8, r.randrange(3)) for k in range(60)]  # equal rows: nothing to split
    rows = clustered(260) + AWKWARD + copies
    r.shuffle(rows)
    got = H.hard_negatives(frame(spark, rows), F.col("id") % 5 == 0).collect()
    # beyond a long's scores: takes no part
    assert srt(map(tuple, got)) == srt(brute([x for x in rows if x[0] != 1040], 5))
    assert got


def test_ranges_drop_subtrees():
    """Where rows are clustered, whole subtrees are passed over, and none that holds a row of a window."""
    import numpy as np

    r = np.random.default_rng(2)
    centres = r.normal(size=(20, 16))
    rows = np.floor(256 * (centres[r.integers(0, 20, 3000)] + 0.05 * r.normal(size=(3000, 16)))).astype(np.int32)
    radius = float(np.sqrt((rows.astype(float) ** 2).sum(axis=1).max()))
    points = H.Points(rows, radius)
    top, cells = H.fit_top(points[np.arange(400)], 1)
    cell = H.place(top, points, widen=True)
    scores = H.exact_scores(rows[:50], rows)
    high = scores.max(axis=1)
    block = H.Block(np.arange(50), np.arange(50), np.zeros(50, int), rows[:50], (high * 8 // 10)[:, None], high[:, None])
    met = H.cells_met(top, block)
    for a in range(50):
        inside = set(cell[scores[a] >= block.low[a, 0]].tolist())
        assert inside <= {c for c, anchors in met.items() if a in anchors}
    assert sum(map(len, met.values())) < 0.5 * 50 * cells


def test_exact_beyond_doubles():
    import numpy as np

    a = np.array([[1 << 30, 3]], np.int32)
    b = np.array([[(1 << 30) - 1, 1]], np.int32)
    assert H.exact_scores(a, b)[0, 0] == (1 << 30) * ((1 << 30) - 1) + 3


def test_empty_tables(spark):
    assert H.hard_negatives(frame(spark, []), F.col("id") % 5 == 0).collect() == []
    assert H.hard_negatives(frame(spark, [(1, [1.0], 1)]), F.col("id") % 5 == 0).collect() == []
    assert H.hard_negatives(frame(spark, [(5, [1.0], 1), (6, [1.0], 1)]), F.col("id") % 5 == 0).collect() == []


def test_oracle(spark):
    sf = "/root/testdata/sf0.001"
    ok, why = compare(op11_hard_negatives(spark, sf), duck(sf), OP11_SQL)
    assert ok, why
