import random

import pytest

COLUMNS = ("doc_id bigint, text string, lang string, source string, n_chars bigint, h bigint, key binary, term bigint, "
           "doc string, tag int, label int, pos int, u string, score double, found string, ids string")


def docs_frame(spark, rows):
    """A table like ``documents`` with further columns whose names clash with the operators' own."""
    full = [(i, t, "en", "src", None if t is None else len(t), 1, b"k", 2, "d", 3, 4, 5, "u", 0.5, "f", "i")
            for i, t in rows]
    return spark.createDataFrame(full, COLUMNS)


def words(seed, n, size=400):
    r = random.Random(seed)
    vocabulary = ["".join(r.choice("abcdefghijklmnop") for _ in range(r.randint(3, 9))) for _ in range(size)]
    return [r.choice(vocabulary) for _ in range(n)]


def prose(seed, n):
    w = words(seed, n)
    return " ".join(w)


@pytest.fixture(scope="session")
def awkward():
    """(doc_id, text): nulls, empties, white space, repeats, one id with two texts, a very long text."""
    long = prose(1, 20_000)
    a, b = prose(2, 120), prose(3, 90)
    near = " ".join(a.split()[:60] + ["other"] + a.split()[61:])
    return [(None, a), (1, None), (2, ""), (3, " \n\t "), (4, a), (4, a), (5, b), (5, prose(5, 80)), (6, near),
            (7, long), (8, long), (9, "Über uns: 日本語   😀\nzwei\n\nzwei"), (10, "one two"), (11, "one two"),
            (12, "One  TWO"), (13, b + "\n" + prose(6, 40)), (-7, b), (14, "\n".join([prose(7, 30)] * 3))]
