import hashlib
import math
import re
import struct

import pytest
import xxhash
from pyspark.sql import functions as F

from tests.llm.conftest import docs_frame, prose, words
from trackyard.llm import imatch


def brute(rows):
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    out = {}
    for k, (i, t) in enumerate(order):
        t, n = t or "", order[(k + 1) % len(order)][1] or ""
        q = len(t) // 4
        out[i] = (len(t), hashlib.sha256((t[:len(t) - q] + n[:q]).encode()).hexdigest())
    return out


def test_edited_texts_and_likeness(spark, awkward):
    seen, rows = set(), []
    for i, t in awkward:  # the order of rows that share an id is by hash; here ids are unique
        if i not in seen:
            seen.add(i)
            rows.append((i, t))
    rows += [(100 + k, prose(100 + k, 60 + 20 * k)) for k in range(40)]
    for ranges in (1, 7):
        got = imatch.edited_report(docs_frame(spark, rows), ranges=ranges).collect()
        assert {r.doc_id: (r.n_chars, r.edited_sha256) for r in got} == brute(rows) and len(got) == len(rows)
        plain = [r for r in got if (r.doc_id or 0) >= 100]
        assert sum(r.near_edited for r in plain) / len(plain) > 0.35
        assert all(0 <= x <= 1 for r in got for x in (r.near_edited, r.near_next))
        assert sum(r.near_next for r in plain) / len(plain) < 0.25
        prints = {}
        for r in got:
            prints.setdefault(dict(rows)[r.doc_id] or "", set()).add(r.fingerprint)
        assert all(len(p) == 1 for p in prints.values())


def test_repeated_rows(spark, awkward):
    got = imatch.edited_report(docs_frame(spark, awkward), ranges=3)
    assert got.count() == len(awkward)
    alone = imatch.edited_report(docs_frame(spark, [(5, "only one here")])).collect()
    assert alone[0].near_next == 1.0


def test_empty_table(spark):
    assert imatch.edited_report(docs_frame(spark, [])).collect() == []


def test_lexicon_is_bounded_and_banded(spark):
    docs = docs_frame(spark, [(k, f"common w{k % 7} w{k % 11}x u{k}") for k in range(100)])
    words = {r.term for r in imatch.lexicon(docs, most=0.2).collect()}
    term = lambda w: spark.range(1).select(F.xxhash64(F.lit(w))).first()[0]
    assert term("common") not in words and term("u3") not in words and term("w3") in words
    assert imatch.lexicon(docs, size=5, most=1.0).count() <= 5


def test_copies_outside_the_band_are_like_their_edited_texts(spark):
    copy, others = prose(7, 80), words(999, 80 * 60, 1500)
    rows = [(k, copy if k % 3 == 0 else " ".join(others[60 * (k * 2 // 3):][:60])) for k in range(120)]
    got = {r.doc_id: r for r in imatch.edited_report(docs_frame(spark, rows), ranges=3).collect()}
    assert len(got) == 120 and all(r.near_next < 0.4 for r in got.values())
    copies = [r.near_edited for k, r in got.items() if k % 3 == 0]
    assert min(copies) > 0.4 and sum(copies) / len(copies) > 0.6


def test_native_plan(spark):
    plan = imatch.edited_report(docs_frame(spark, [(1, "a b"), (2, "c d")]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


LOW = (1 << 64) - 1


def slow_terms(text):
    return {xxhash.xxh64_intdigest(w.encode(), 42) for w in re.findall(r"[^\W_]+", (text or "").lower())}


def slow_entries(terms):
    out = set()
    for k in {t & 63 for t in terms}:
        h = 42
        for t in sorted((t for t in terms if t & 63 == k), key=lambda t: t >> 6):
            h = xxhash.xxh64_intdigest(struct.pack("<Q", t), h)
        out.add(k * 4096 + (h & 0xFFF))
    return out


def slow_print(text, words):
    every = slow_terms(text)
    rate = math.floor(math.log2(max(len(every) / 64, 1)))
    drawn = lambda r: {t for t in every if (t >> 6) & (2 ** r - 1) == 0}
    lexical = len(drawn(rate) & words) >= imatch.FEW
    within = [slow_entries(drawn(r) & words) if lexical else set() for r in (rate, rate + 1)]
    return rate, lexical, *within, *(slow_entries(drawn(r)) for r in (rate, rate + 1))


def slow_likeness(a, b):
    if a == b:
        return 1.0
    rate = max(a[0], b[0])
    which = 2 if a[1] and b[1] else 4
    x, y = (p[which + rate - p[0]] if rate - p[0] < 2 else None for p in (a, b))
    if x is None or y is None or not x | y:
        return 0.0
    f = len(x & y) / len({e >> 12 for e in x | y})
    return 2 * f / (1 + f)


@pytest.mark.parametrize("ranges", [1, 5])
def test_likeness_against_brute_force(spark, ranges):
    """Fingerprints and likeness by sets, for texts of a few and of thousands of terms, near copies, and empty ones."""
    base = words(5, 900, 700)
    rows = [(k, " ".join(base[:10 + 7 * k] + words(k, 3 + k % 9))) for k in range(60)]
    rows += [(100 + k, prose(k % 5, 30 + k)) for k in range(30)] + [(200, None), (201, ""), (202, " ... "), (203, "one"), (204, "one")]
    rows += [(300 + k, " ".join(f"t{j}x" for j in range(5000 * k, 5000 * k + 3000))) for k in range(2)]
    texts = [t or "" for _, t in rows]
    counts = {}
    for t in texts:
        for x in slow_terms(t):
            counts[x] = counts.get(x, 0) + 1
    least = max(2, -(-sum(counts.values()) // imatch.LEXICON))
    known = {x for x, n in counts.items() if least <= n <= max(2, int(imatch.MOST * len(rows)))}
    got = {r.doc_id: r for r in imatch.edited_report(docs_frame(spark, rows), ranges=ranges).collect()}
    for k, (i, _) in enumerate(rows):
        t, n = texts[k], texts[(k + 1) % len(texts)]
        q = len(t) // 4
        p, e, other = (slow_print(x, known) for x in (t, t[:len(t) - q] + n[:q], n))
        assert got[i].near_edited == pytest.approx(slow_likeness(p, e)) and got[i].near_next == pytest.approx(slow_likeness(p, other))
    assert len({r.fingerprint for r in got.values()}) == len({slow_print(t, known).__repr__() for t in texts})
