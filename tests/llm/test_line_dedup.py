import hashlib
from collections import defaultdict

import pytest

from tests.llm.conftest import docs_frame, prose
from tests.oracle import compare, duck
from trackyard.llm import line_dedup
from trackyard.llm.queries import OP10_SQL, op10_line_dedup

LOW = {c: c + 32 for c in range(65, 91)}


def key(line):
    return line.strip("\t\n\x0b\x0c\r ").translate(LOW)


def brute(rows, min_chars=20, min_docs=3):
    rank = lambda i: float("-inf") if i is None else i
    held = defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= min_chars:
                held[key(line)].add(rank(i))
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        stays = [x for x in lines if not (len(held.get(key(x), ())) >= min_docs and max(held[key(x)]) > rank(i))]
        out.append((i, len(lines), len(lines) - len(stays), hashlib.sha256("\n".join(stays).encode()).hexdigest()))
    return out


def srt(rows):
    return sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


SHARED = "A line that stands in many of the documents"
ROWS = [(1, f"{SHARED}\nown {prose(1, 9)}"), (2, f"  {SHARED.upper()}\t\nx"), (3, f"x\n{SHARED}\n{SHARED}"),
        (9, SHARED), (9, SHARED), (4, "short\nshort"), (5, "short"), (6, "short"),
        (7, "ÄÖÜ äöü ist eine lange Zeile"), (8, "äöü äöü ist eine lange Zeile"), (10, "ÄÖÜ äöü IST eine lange Zeile"),
        (11, "ÄÖÜ äöü ist eine lange Zeile"), (None, f"{SHARED}\n"), (None, None), (12, "\n\n")]


@pytest.mark.parametrize("batches, fanout", [(1, 2), (3, 2), (5, 3)])
def test_against_brute_force(spark, awkward, batches, fanout):
    rows = ROWS + awkward
    got = line_dedup.line_report(docs_frame(spark, rows), n_batches=batches, fanout=fanout).collect()
    assert srt(map(tuple, got)) == srt(brute(rows))


def test_dedup_lines_keeps_columns(spark, awkward):
    docs = docs_frame(spark, ROWS + awkward)
    out = line_dedup.dedup_lines(docs)
    assert out.columns == docs.columns and out.count() == docs.count()
    assert out.filter("doc_id = 9 and n_chars is not null and n_chars <> length(text)").count() == 0
    assert {r.text for r in out.filter("doc_id = 2").collect()} >= {"x"}


def test_empty_table(spark):
    assert line_dedup.line_report(docs_frame(spark, [])).collect() == []


def test_runs_are_levelled(spark, tmp_path):
    store = line_dedup.LineRuns(spark, str(tmp_path / "runs"), fanout=2)
    for k in range(5):
        store.add_batch(spark.createDataFrame([(1, 1, 1, 10 - k), (k, 2, 1, 10 - k)], line_dedup.RUN_SCHEMA))
    assert sum(map(len, store.levels)) <= 3 and len(store.levels) >= 3
    totals = {(r.h1, r.h2): (r.n, r.owner) for r in store.totals().collect()}
    assert totals[1, 1] == (5, 10) and totals[4, 2] == (1, 6) and len(totals) == 6


def test_native_plan(spark):
    plan = line_dedup.line_report(docs_frame(spark, ROWS))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_oracle(spark):
    sf = "/root/testdata/sf0.001"
    ok, why = compare(op10_line_dedup(spark, sf), duck(sf), OP10_SQL)
    assert ok, why
