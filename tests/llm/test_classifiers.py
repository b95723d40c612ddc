import zlib

import numpy as np
import pytest

from tests.llm.conftest import docs_frame, prose
from trackyard.llm import quality, toxicity
from trackyard.llm.common import read_table
from trackyard.llm.queries import op4_toxicity_crf, op5_quality_classifier

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("query, label, least", [(op5_quality_classifier, "quality", 0.97),
                                                 (op4_toxicity_crf, "toxic", 0.85)])
def test_held_out_accuracy(spark, query, label, least):
    got = {r.doc_id: r for r in query(spark, SF).collect()}
    assert len(got) == read_table(spark, SF, "documents").count()
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= r.score <= 1 for i, r in got.items())
    known = [(got[r.doc_id], r[label]) for r in read_table(spark, SF, "labels").collect()]
    right = [r.predicted == y for r, y in known if r.held_out]
    assert sum(right) / len(right) >= least


def test_labels_of_held_out_rows_are_not_learnt(spark):
    rows = [(k, prose(k, 30) if k % 2 else "!! ?? " * 20) for k in range(200)]
    docs = docs_frame(spark, rows)
    labels = [(k, k % 2) for k in range(200)]
    flipped = [(k, 1 - y if zlib.crc32(str(k).encode()) % 5 == 0 else y) for k, y in labels]
    a, b = (quality.train(docs, spark.createDataFrame(x, "doc_id bigint, quality int")) for x in (labels, flipped))
    assert np.array_equal(a, b) and np.abs(a).sum() > 0


def test_awkward_rows(spark, awkward):
    docs = docs_frame(spark, awkward)
    labels = spark.createDataFrame([(4, 1, 0), (5, 0, 1), (None, 1, 1), (6, None, None), (4, 0, 1), (99, 1, 1)],
                                   "doc_id bigint, quality int, toxic int")
    weights = quality.train(docs, labels)
    scores = quality.score_documents(docs, weights).collect()
    assert len(scores) == len(awkward) and len({r.score for r in scores if r.doc_id in (1, 2, 3)}) == 1
    kept = quality.keep_quality(docs, weights, 0.0)
    assert kept.columns == docs.columns and kept.count() == len(awkward)
    field = toxicity.train(docs, labels)
    assert toxicity.score_documents(docs, field).count() == len(awkward)


def test_empty_tables(spark):
    none, labels = docs_frame(spark, []), spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    weights = quality.train(none, labels)
    assert quality.score_documents(none, weights).collect() == []
    assert [r.score for r in quality.score_documents(docs_frame(spark, [(1, "a")]), weights).collect()] == [0.5]
    assert toxicity.train(none, labels) is None
    assert [r.score for r in toxicity.score_documents(docs_frame(spark, [(1, "a")]), None).collect()] == [0.0]


def test_forward_backward_against_enumeration():
    r = np.random.default_rng(4)
    step, start = r.normal(size=(2, 2)), r.normal(size=2)
    lengths = np.array([1, 4, 2, 5])
    score = r.normal(size=12)
    left, right, _ = toxicity.forward_backward(score, lengths, step, start)
    p = left * right / (1 + left * right)
    at = 0
    for n in lengths:
        s, total, hot = score[at:at + n], 0.0, np.zeros(n)
        for path in np.ndindex(*(2,) * n):
            w = start[path[0]] + sum(s[k] for k in range(n) if path[k]) + sum(step[path[k], path[k + 1]]
                                                                               for k in range(n - 1))
            total += np.exp(w)
            hot += np.exp(w) * np.array(path)
        assert np.allclose(p[at:at + n], hot / total)
        at += n


def test_spans_point_at_the_words():
    text = "schön idiot, du clown!"
    spans = toxicity.spans_of(text.encode(), np.array([0.1, 0.9, 0.2, 0.8]))
    assert [text[s["start"]:s["end"]] for s in spans] == ["idiot,", "clown!"]


def test_chains_end_with_sentences_and_documents():
    ends = np.array([0, 1, 0, 0, 0, 0, 0], bool)
    assert toxicity.chain_lengths(ends, np.array([4, 0, 3]), longest=2).tolist() == [2, 2, 2, 1]
