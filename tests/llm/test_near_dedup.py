import random

import pytest

from tests.llm.conftest import docs_frame, words
from tests.oracle import compare, duck
from trackyard.llm import near_dedup as N
from trackyard.llm.components import connected_components
from trackyard.llm.queries import OP6_SQL, op6_minhash_near_dedup


def shingles(t):
    w = (t or "").encode().lower().split()
    return {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()


def brute(rows):
    rank = lambda i: float("-inf") if i is None else i
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def top(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= 75 * len(x | y):
                root[top(a)] = top(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        least[top(k)] = min(least.get(top(k), float("inf")), rank(i))
    out = []
    for k, (i, _) in enumerate(rows):
        c = least[top(k)]
        out.append((i, len(sets[k]), None if c == float("-inf") else c, rank(i) == c))
    return out


def srt(rows):
    return sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


def variants(n, changes, seed=5, size=150):
    """Edited copies of one text, so that some pairs are just similar enough and some are not."""
    base, r = words(seed, size), random.Random(seed)
    out = []
    for k in range(n):
        w = list(base)
        for at in r.sample(range(size), changes):
            w[at] = f"new{k}x{at}"
        out.append((1000 + k, " ".join(w)))
    return out


@pytest.mark.parametrize("block", [N.BLOCK_SHINGLES, 1500])
def test_against_brute_force(spark, awkward, block):
    rows = awkward + variants(40, 2) + [(i + 500, t) for i, t in variants(30, 4, seed=8)]
    got = N.near_duplicate_report(docs_frame(spark, rows), block_shingles=block).collect()
    assert srt(map(tuple, got)) == srt(brute(rows))


def test_one_of_each_group_stays(spark, awkward):
    docs = docs_frame(spark, awkward)
    out = N.drop_near_duplicates(docs)
    assert out.columns == docs.columns
    stay = [r for r, b in zip(awkward, brute(awkward), strict=True) if b[-1]]
    assert srt([(r.doc_id, r.text) for r in out.collect()]) == srt(stay)


def test_empty_table(spark):
    assert N.near_duplicate_report(docs_frame(spark, [])).collect() == []


def test_components(spark):
    r = random.Random(3)
    edges = [(r.randint(0, 300), r.randint(0, 300)) for _ in range(180)] + [(400 + k, 401 + k) for k in range(40)]
    edges += [(7, 7), (None, 3)]
    got = {x.u: x.v for x in connected_components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()}
    least = {x: x for e in edges if None not in e for x in e}
    for _ in range(400):
        for a, b in edges:
            if a is not None:
                least[a] = least[b] = min(least[a], least[b])
    assert got == {x: m for x, m in least.items() if x != m}


def test_oracle(spark):
    sf = "/root/testdata/sf0.001"
    ok, why = compare(op6_minhash_near_dedup(spark, sf), duck(sf), OP6_SQL)
    assert ok, why
