import numpy as np
import pyarrow as pa

from tests.llm.conftest import docs_frame, prose, words
from trackyard.llm import paragraph_dedup as P

PASSAGE = prose(77, 60)
ROWS = [(20, f"{prose(21, 45)} {PASSAGE} {prose(22, 30)}"), (21, f"{prose(23, 8)} {PASSAGE}\n{prose(24, 70)}"),
        (22, f"{prose(25, 33)}\n\n  {PASSAGE.upper()}"), (23, prose(26, 200)), (24, " ".join([prose(27, 40)] * 2)),
        (25, "the " * 300)]


def test_passages_found_and_clean_left(spark):
    got = P.repeat_report(docs_frame(spark, ROWS)).collect()
    assert {r.doc_id for r in got} == {20, 21, 22}
    assert {(r.doc_id, r.removed) for r in got} == {(20, False), (21, True), (22, True)}
    texts = dict(ROWS)
    for r in got:
        assert r.component_id == 20 and r.n_words >= P.MIN_WORDS
        found = texts[r.doc_id].encode()[r.begin:r.end].decode().lower().split()
        # near-equal paragraphs at the passage's ends may differ by a word or two
        assert sum(w not in PASSAGE.split() for w in found) <= 4


def test_awkward_rows(spark, awkward):
    docs = docs_frame(spark, awkward)
    spans = P.repeat_report(docs).collect()
    assert {(r.doc_id, r.component_id) for r in spans if r.doc_id == 8} == {(8, 7)}
    assert all(r.removed == (r.doc_id != r.component_id) for r in spans)
    out = P.remove_repeats(docs)
    assert out.columns == docs.columns and out.count() == len(awkward)
    text = {r.doc_id: r.text for r in out.collect()}
    assert text[7] == dict(awkward)[7] and len(text[8].split()) < 20 and text[2] == "" and text[1] is None
    assert out.filter("n_chars <> length(text)").count() == 0


def test_near_equal_paragraphs_link(spark):
    base = ("it " * 50 + prose(3, 60)).split()  # one long paragraph: equal words cut nowhere
    other = list(base)
    other[20] = "that"
    got = P.repeat_report(docs_frame(spark, [(1, " ".join(base)), (2, " ".join(other))])).collect()
    assert {r.doc_id for r in got} == {1, 2}


def test_exact_passages_to_their_true_ends(spark):
    rows, passages = [], {}
    for k in range(40):
        passages[k] = words(500 + k, 51, 3000)
        for side in (0, 1):
            text = words(700 + 2 * k + side, 40, 3000) + passages[k] + words(900 + 2 * k + side, 30, 3000)
            rows.append((2 * k + side, " ".join(text)))
    got = P.repeat_report(docs_frame(spark, rows)).collect()
    spans = {r.doc_id: dict(rows)[r.doc_id].encode()[r.begin:r.end].decode().split() for r in got}
    assert len(got) == len(spans) == 80 and all(spans[2 * k + side] == p for k, p in passages.items() for side in (0, 1))
    left = {r.doc_id: r.text for r in P.remove_repeats(docs_frame(spark, rows)).collect()}
    assert all(len(left[2 * k].split()) == 121 and len(left[2 * k + 1].split()) == 70 for k in passages)


def test_edited_prose_links_whole(spark):
    rows, edited = [], {}
    for k, (n, edits) in enumerate([(60, (30,)), (60, (22,)), (80, (25, 52)), (100, (28, 55)), (80, (30,))] * 4):
        passage = words(1500 + k, n, 3000)
        copy = list(passage)
        for at in edits:
            copy[at] = f"edited{at}"
        for side, inner in ((0, passage), (1, copy)):
            rows.append((2 * k + side, " ".join(words(1700 + 2 * k + side, 40, 3000) + inner
                                                + words(1900 + 2 * k + side, 30, 3000))))
        edited[2 * k + 1] = copy
    got = [r for r in P.repeat_report(docs_frame(spark, rows)).collect() if r.removed]
    spans = {r.doc_id: dict(rows)[r.doc_id].encode()[r.begin:r.end].decode().split() for r in got}
    assert len(got) == len(spans) and spans == edited


def test_follow_and_match():
    a = list(range(100, 160))
    assert P.follow(a[:20], a[:20])[-1] == (20, 20, 20)
    b = [*a[:10], 1, *a[11:30], *a[32:60]]  # a word replaced, two dropped
    assert P.follow(a, b)[-1] == (60, 58, 10 + 15 + 24)
    assert P.follow(a, [7, *a[5:9], 8, 9])[-1][0] == 0  # too much is different
    own, its = [1, 2, 3, *a, 4, 5, 6], [9, 8, *b, 7]
    assert P.matched(own, 16, 30, its, 15, 29, 65) == (3, 63, 2, 60)
    # strange words beyond a passage, and passages that are too different, stay outside
    c = [x if k % 6 else -k for k, x in enumerate(a)]
    first, last, _, _ = P.matched([*a[:20], *c[20:]], 0, 20, [*a[:20], *a[20:]], 0, 20, 75)
    assert (first, last) == (0, 24)


def jaccard(a, b):
    x, y = ({tuple(w[k:k + 5]) for k in range(len(w) - 4)} for w in (a, b))
    return len(x & y) / len(x | y)


def test_edits_at_random_places_are_covered(spark):
    """Passages of 60-120 words, an edit per 35 words anywhere, ends included; at least 0.95 of the words are found."""
    import random

    r, rows, copies = random.Random(11), [], {}
    for k in range(120):
        passage = words(3000 + k, r.randint(60, 120), 3000)
        while True:
            copy = list(passage)
            for _ in range(max(1, len(passage) // 35)):
                at, kind = r.randrange(len(copy)), r.randrange(3)
                copy[at:at + (kind != 1)] = [f"edited{at}"] if kind < 2 else []
            if jaccard(passage, copy) >= 0.75:
                break
        for side, inner in ((0, passage), (1, copy)):
            rows.append((2 * k + side, " ".join(words(5000 + 2 * k + side, 40, 3000) + inner + words(7000 + 2 * k + side, 30, 3000))))
        copies[2 * k + 1] = copy
    covered = total = beyond = 0
    got = [r for r in P.repeat_report(docs_frame(spark, rows)).collect() if r.removed]
    texts = dict(rows)
    for doc, copy in copies.items():
        whole = texts[doc].encode().split()
        marked = set()
        for x in got:
            if x.doc_id == doc:
                a = len(texts[doc].encode()[:x.begin].split())
                marked |= set(range(a, a + x.n_words))
        inner = set(range(40, 40 + len(copy)))
        assert len(whole) == 70 + len(copy)
        covered, total, beyond = covered + len(marked & inner), total + len(inner), beyond + len(marked - inner)
    assert covered >= 0.95 * total and beyond <= 0.01 * total


def test_empty_table(spark):
    assert P.repeat_report(docs_frame(spark, [])).collect() == []


TEXTS = [b"", b"a", b" ", *(prose(k, n).encode() for k, n in enumerate((3, 4, 5, 9, 30, 200, 400))), b"", b"the " * 300, b"\n", PASSAGE.encode(),
         b" ".join([prose(8, 20).encode(), b"x" * 300, b" " * 700, prose(9, 90).encode()])]


def sketched(texts):
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array([7] * len(texts), pa.int64()),
                                        pa.array(texts, pa.binary())], names=["doc", "tag", "text"])
    return batch, pa.Table.from_batches(P._sketched(iter([batch]))).to_pylist()


def segments(batch, rows):
    kind = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))
    which = [[{"first": a, "last": b} for a, b in zip(r["paras"][::2], r["paras"][1::2], strict=True)][::-3] for r in rows]
    found = P._segments(iter([pa.RecordBatch.from_arrays([*batch.columns, pa.array(which, kind)], names=["doc", "tag", "text", "which"])]))
    return [{**r, "places": P._unpacked(r["begin"], r["places"]).tolist()} for b in found for r in b.to_pylist()]


def test_texts_are_hashed_together_and_cut_apart(monkeypatch):
    calls, mixed = [], P._mixed
    monkeypatch.setattr(P, "_mixed", lambda x: calls.append(len(x)) or mixed(x))
    batch, rows = sketched(TEXTS * 20)
    assert len(calls) <= 10  # not some for each of the texts
    calls.clear()
    found = segments(batch, rows)
    assert len(calls) <= 10
    alone = [sketched([t]) for t in TEXTS]
    assert [(r["paras"], r["bands"]) for r in rows] == [(a["paras"], a["bands"]) for _, (a,) in alone] * 20
    parts = [segments(b, r) for b, r in alone]
    expected = [{**x, "doc": n} for n, part in enumerate(parts * 20) for x in part]
    assert found == expected and len(found) > 100
    for text, (_, (row,)) in zip(TEXTS, alone, strict=True):  # the hashes of segments are the sketch's, their places the text's
        places, bands = [*zip(row["paras"][::2], row["paras"][1::2], strict=True)], row["bands"]
        for seg in segments(*sketched([text])):
            at = seg["places"]
            assert [text[a:b] for a, b in at] == text.split()[seg["seg"]:seg["seg"] + len(at)]
            for p in seg["paras"]:
                k = places.index((p["first"], p["last"]))
                assert p["bands"] == bands[k * P.BANDS:(k + 1) * P.BANDS]


def test_paragraphs_begin_at_the_least_pairs():
    w = np.random.default_rng(5).integers(0, 6, 3000).astype(np.uint64)  # ties: the first of equal ones
    begins = np.array([0, 1, 5, 12, 21, 22, 500, 1700, 2996])
    expected = []
    for a, b in zip(begins, [*begins[1:], len(w)], strict=True):
        v = P._mixed(w[a:b] * P._P + np.append(w[a + 1:b], np.uint64(0))).tolist()
        expected += [a + k for k in range(b - a) if k == 0 or P.REACH <= k < b - a - P.REACH and all(
            v[k] < x for x in v[k - P.REACH:k]) and all(v[k] <= x for x in v[k + 1:k + P.REACH + 1])]
    assert P.paragraph_starts(w, begins).tolist() == expected
