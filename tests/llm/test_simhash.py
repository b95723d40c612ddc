import random

import numpy as np
import pytest
import xxhash

from tests.llm.conftest import docs_frame, prose
from trackyard.llm import simhash as S
from trackyard.llm.queries import op13_simhash


def slow_fingerprint(t):
    w = (t or "").encode().lower().split()
    if not w:
        return 0
    grams = [b" ".join(w[k:k + 3]) for k in range(max(1, len(w) - 2))]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(rows, radius=2):
    rank = lambda i: float("-inf") if i is None else i
    fps = [slow_fingerprint(t) for _, t in rows]
    distinct = sorted(set(fps))
    root = {f: f for f in distinct}

    def top(f):
        while root[f] != f:
            f = root[f]
        return f

    for k, a in enumerate(distinct):
        for b in distinct[:k]:
            if (a ^ b).bit_count() <= radius:
                root[top(a)] = top(b)
    least = {}
    for (i, _), f in zip(rows, fps, strict=True):
        least[top(f)] = min(least.get(top(f), float("inf")), rank(i))
    return [(i, f"{f:016x}", None if least[top(f)] == float("-inf") else least[top(f)])
            for (i, _), f in zip(rows, fps, strict=True)]


def srt(rows):
    return sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


def near_copies(n, size=120, seed=9):
    r = random.Random(seed)
    base = prose(seed, size).split()
    out = []
    for k in range(n):
        w = list(base)
        w[r.randrange(size)] = f"x{k}"
        out.append((3000 + k, " ".join(w)))
    return out


@pytest.mark.parametrize("tree_size", [S.TREE_SIZE, 6])
def test_against_brute_force(spark, awkward, tree_size):
    rows = awkward + near_copies(150) + [(500 + k, prose(40 + k, 4 + k % 9)) for k in range(120)]
    got = S.simhash_report(docs_frame(spark, rows), tree_size=tree_size).collect()
    want = brute(rows)
    assert srt(map(tuple, got)) == srt(want)
    assert len({c for _, _, c in want}) < len({f for _, f, _ in want})  # some different fingerprints are linked


def test_whole_table_against_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert srt(map(tuple, op13_simhash(spark, sf).collect())) == srt(brute(rows))


def values(n, seed, spread):
    r = random.Random(seed)
    centres = [r.getrandbits(64) for _ in range(max(1, n // 30))] + [0, (1 << 64) - 1]
    out = set(centres)
    while len(out) < n:
        v = r.choice(centres)
        for b in r.sample(range(64), r.randrange(spread + 1)):
            v ^= 1 << b
        out.add(v)
    return np.array(sorted(out), np.uint64)


@pytest.mark.parametrize("radius", [0, 1, 2, 5])
def test_tree_finds_all_within_the_radius(radius):
    v = values(600, 3, 6)
    q, node = S.BKTree(v).within(v, radius)
    near = np.bitwise_count(v[:, None] ^ v[None, :]) <= radius
    assert sorted(zip(q.tolist(), node.tolist(), strict=True)) == sorted(zip(*(x.tolist() for x in np.nonzero(near)), strict=True))


def test_tree_follows_few_edges():
    v = values(4000, 4, 40)
    tree = S.BKTree(v)
    seen = 0
    real = np.bitwise_count
    try:
        def counted(x):
            nonlocal seen
            seen += len(x)
            return real(x)
        S.np.bitwise_count = counted
        tree.within(v[:200], 2)
    finally:
        S.np.bitwise_count = real
    assert seen < 0.6 * 200 * len(v)


@pytest.mark.parametrize("tree_size", [4, 50, 1000])
def test_shards_hold_each_close_pair(spark, tree_size):
    v = values(400, 6, 4)
    placed = S.shards(spark.createDataFrame([(int(x),) for x in v.view(np.int64)], "fp bigint"), tree_size=tree_size)
    at = {}
    for shard, fp in placed.collect():
        at.setdefault(shard, set()).add(fp & (1 << 64) - 1)
    together = {(a, b) for group in at.values() for a in group for b in group if a < b and (a ^ b).bit_count() <= 2}
    ints = [int(x) for x in v]
    assert together == {(a, b) for a in ints for b in ints if a < b and (a ^ b).bit_count() <= 2}


def test_empty_table(spark):
    assert S.simhash_report(docs_frame(spark, [])).collect() == []
