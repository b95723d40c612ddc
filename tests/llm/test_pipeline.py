import numpy as np
import pytest

import corpus_pipeline
from tests.llm import test_decontamination as bench
from tests.llm import test_line_dedup as lines
from tests.llm import test_near_dedup as near
from trackyard.llm import quality
from trackyard.llm.common import read_table

pytest.importorskip("public_tokenizers")
SF = "/root/testdata/sf0.001"


def test_stages_against_brute_force(spark):
    docs = read_table(spark, SF, "documents")
    columns = docs.columns
    weights, seen = quality.train(docs, read_table(spark, SF, "labels")), quality._Words()
    rows = [(r.doc_id, r.text) for r in docs.collect()]

    def step(k, frame):
        out = corpus_pipeline.STAGES[k][1](spark, frame, SF)
        if k < 4:
            assert out.columns == columns
        return spark.createDataFrame(out.collect(), out.schema)

    docs = step(0, docs)
    rows = [(i, t) for i, t in rows if quality.score(weights, *quality.vector((t or "").encode(), seen)) >= 0.3]
    assert sorted((r.doc_id, r.text) for r in docs.collect()) == sorted(rows)

    docs = step(1, docs)
    held = {i: n for i, _, n, _ in lines.brute(rows)}
    got = {r.doc_id: r.text for r in docs.collect()}
    assert len(got) == len(rows) and all((got[i] == t) == (held[i] == 0) for i, t in rows)
    rows = list(got.items())

    docs = step(2, docs)
    stay = {b[0] for b in near.brute(rows) if b[-1]}
    rows = [r for r in rows if r[0] in stay]
    assert sorted((r.doc_id, r.text) for r in docs.collect()) == sorted(rows)

    docs = step(3, docs)
    items = [tuple(r) for r in read_table(spark, SF, "benchmark").select("item_id", "text").collect()]
    verdict = {b[0]: b for b in bench.brute(rows, items)}
    got = {r.doc_id: r.text for r in docs.collect()}
    assert set(got) == {i for i, b in verdict.items() if not b[1] or b[2] < b[1]}
    assert all(len(bench.words(t)) <= verdict[i][1] - verdict[i][2] + 1 and (t == dict(rows)[i]) == (not verdict[i][2])
               for i, t in got.items())

    from tokenizers import Tokenizer
    import public_tokenizers
    library = Tokenizer.from_file(public_tokenizers.path(corpus_pipeline.TOKENIZER))
    tokens = {r.doc_id: r.ids for r in step(4, docs).collect()}
    assert set(tokens) == set(got)
    assert all(list(tokens[i]) == library.encode(t or "", add_special_tokens=False).ids for i, t in got.items())
    whole = {r.doc_id: r.ids for r in corpus_pipeline.run(spark, SF).collect()}
    assert whole == tokens and np.sum([len(x) for x in whole.values()]) > 0
