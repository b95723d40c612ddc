import hashlib
import re

import pytest

from tests.llm.conftest import docs_frame, prose
from tests.oracle import compare, duck
from trackyard.llm import decontamination as D
from trackyard.llm.queries import OP2_SQL, op2_decontamination

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(t):
    return WORD.findall((t or "").translate({c: c + 32 for c in range(65, 91)}))


def brute(rows, items, n=10):
    out = []
    for i, t in rows:
        w, hit, found = words(t), set(), set()
        for item, text in items:
            x = words(text)
            size = min(n, len(x))
            grams = {tuple(x[k:k + size]) for k in range(len(x) - size + 1)} if size else set()
            for k in range(len(w) - size + 1):
                if size and tuple(w[k:k + size]) in grams:
                    hit |= set(range(k, k + size))
                    if item is not None:
                        found.add(str(item))
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((i, len(w), len(hit), len(found), digest, bool(hit)))
    return out


def srt(rows):
    return sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


LONG = prose(31, 25)
ITEMS = [(1, LONG), (10, LONG.upper() + "!"), (2, "one two"), (3, None), (4, "…!?"), (None, "zwei"), (5, prose(2, 120)[200:420]),
         (2, "drei vier fünf")]
ROWS = [(100, f"pre {LONG} post"), (101, ", ".join(LONG.split()[3:14])), (102, " ".join(LONG.split()[:9])),
        (103, "drei-vier FÜNF drei vier fünf")]


@pytest.mark.parametrize("limit", [D.MAX_BROADCAST_WORDS, 0])
def test_against_brute_force(spark, awkward, limit):
    rows = ROWS + awkward
    bench = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    got = D.contamination_report(docs_frame(spark, rows), bench, max_broadcast_words=limit)
    assert srt(map(tuple, got.collect())) == srt(brute(rows, ITEMS))


@pytest.mark.parametrize("limit", [D.MAX_BROADCAST_WORDS, 0])
def test_documents_removed(spark, awkward, limit):
    rows = ROWS + awkward
    docs = docs_frame(spark, rows)
    out = D.decontaminate(docs, spark.createDataFrame(ITEMS, "item_id bigint, text string"), max_broadcast_words=limit)
    assert out.columns == docs.columns
    clean = [r for r, b in zip(rows, brute(rows, ITEMS), strict=True) if not b[-1]]
    assert srt([(r.doc_id, r.text) for r in out.collect()]) == srt(clean)


def test_spans_cut(spark):
    docs = docs_frame(spark, [(1, f"Before, {LONG}; after."), (2, LONG), (3, "clean text"), (4, None)])
    out = D.decontaminate(docs, spark.createDataFrame(ITEMS[:2], "item_id bigint, text string"), remove="spans")
    got = {r.doc_id: (r.text, r.n_chars) for r in out.collect()}
    assert got == {1: ("Before, ; after.", 16), 3: ("clean text", 10), 4: (None, None)}


def test_spans_cut_alike_with_and_without_broadcast(spark, awkward):
    docs = docs_frame(spark, ROWS + awkward + [(200, f"Before, {LONG}; after."), (201, LONG)])
    bench = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    small, large = (D.decontaminate(docs, bench, remove="spans", max_broadcast_words=limit)
                    for limit in (D.MAX_BROADCAST_WORDS, 0))
    assert large.columns == docs.columns
    got = srt(map(tuple, large.collect()))
    assert got == srt(map(tuple, small.collect()))
    assert (200, "Before, ; after.", 16) in {(r[0], r[1], r[4]) for r in got} and 201 not in {r[0] for r in got}


def test_empty_tables(spark):
    bench = spark.createDataFrame([], "item_id bigint, text string")
    assert D.contamination_report(docs_frame(spark, []), bench).collect() == []
    [row] = D.contamination_report(docs_frame(spark, [(1, "a b")]), bench).collect()
    assert (row.n_words, row.n_hit, row.contaminated) == (2, 0, False)


def test_oracle(spark):
    sf = "/root/testdata/sf0.001"
    ok, why = compare(op2_decontamination(spark, sf), duck(sf), OP2_SQL)
    assert ok, why
