import hashlib
import math
import random
import re
import zlib

import pytest

from tests.llm.conftest import docs_frame, prose
from tests.oracle import compare, duck
from trackyard.llm import resampling as R
from trackyard.llm.queries import OP12_SQL, op12_importance_resampling


def grams(t):
    w = re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").encode().lower())
    return len(w), w + [a + b" " + b for a, b in zip(w, w[1:], strict=False)]


def brute(rows, target, percent=25, buckets=R.BUCKETS):
    def counted(texts):
        out = [0] * buckets
        for t in texts:
            for g in grams(t)[1]:
                out[zlib.crc32(g) % buckets] += 1
        return out

    s, t = counted(x for _, x in rows), counted(target)
    gain = [math.floor(1000 * math.log((b + 1) * (sum(s) + buckets) / ((a + 1) * (sum(t) + buckets))))
            for a, b in zip(s, t, strict=True)]
    scored = []
    for i, text in rows:
        n, g = grams(text)
        weight = sum(gain[zlib.crc32(x) % buckets] for x in g) // len(g) if g else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        scored.append((i, len(g), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n))
    able = sorted((x for x in scored if x[4] >= 20), key=lambda x: (-x[3], x[0] is None, x[0]))
    k = percent * len(able) // 100
    out = [(*x[:4], None) for x in scored if x[4] < 20]
    return out + [(*x[:4], r if r <= k else None) for r, x in enumerate(able, 1)]


def srt(rows):
    return sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


TARGET = [prose(3, 60), None, "", "one two three"]


def target_frame(spark, texts):
    return spark.createDataFrame([(str(k), t, 1) for k, t in enumerate(texts)], "item_id string, text string, rank int")


@pytest.mark.parametrize("percent", [25, 0, 100])
def test_against_brute_force(spark, awkward, percent):
    rows = awkward + [(100 + k, prose(k, 15 + k % 40)) for k in range(150)]
    got = R.resample(docs_frame(spark, rows), target_frame(spark, TARGET), percent=percent).collect()
    assert srt(map(tuple, got)) == srt(brute(rows, TARGET, percent))


def test_ties(spark):
    """A third of all rows share one id and text, the cutoff lies among them; scores tie elsewhere too."""
    rows = [(5, prose(1, 30))] * 40 + [(k, prose(k % 3, 25)) for k in range(10, 90)]
    got = R.resample(docs_frame(spark, rows), target_frame(spark, TARGET)).collect()
    assert srt(map(tuple, got)) == srt(brute(rows, TARGET))


@pytest.mark.parametrize("accuracy", [3, 50, 2000])
@pytest.mark.parametrize("k", [1, 7, 500, 999, 1000])
def test_cutoff_whatever_the_sketch(spark, accuracy, k):
    """A sketch that is far off only widens the bracket."""
    r = random.Random(2)
    rows = [(r.choice([r.randrange(40), 17, 10 ** 6]), i) for i in range(1000)]
    df = spark.createDataFrame(rows, "score bigint, id bigint")
    assert R.cutoff(df, k, 1000, accuracy) == sorted(rows, key=lambda x: (-x[0], x[1]))[k - 1]


def test_empty_tables(spark):
    assert R.resample(docs_frame(spark, []), target_frame(spark, TARGET)).collect() == []
    rows = [(k, prose(k, 30)) for k in range(8)]
    got = R.resample(docs_frame(spark, rows), target_frame(spark, [])).collect()
    assert srt(map(tuple, got)) == srt(brute(rows, []))


def test_oracle(spark):
    sf = "/root/testdata/sf0.001"
    ok, why = compare(op12_importance_resampling(spark, sf), duck(sf), OP12_SQL)
    assert ok, why
