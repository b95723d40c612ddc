"""Property checks of the parse functions against plain-Python statements of the same SQL semantics."""

import re
from decimal import ROUND_HALF_UP, Decimal

from hypothesis import given, settings
from hypothesis import strategies as st

from trackyard.functions import parse

_UNIT = st.sampled_from(["h", "min", "s", "ms", "sec", "m", ""])
_PART = st.tuples(st.integers(0, 99999), _UNIT, st.sampled_from(["", " ", "  "]))
DURATION_TEXT = st.one_of(
    st.lists(_PART, min_size=0, max_size=5).map(lambda ps: "".join(f"{n}{u}{sp}" for n, u, sp in ps)),
    st.text(alphabet="0123456789hmins ./", max_size=12),
    st.just("Call running..."),
)


def _first(pattern, text):
    m = re.search(pattern, text)
    return int(m.group(1)) if m else 0


def duration_expected(text, hours=False):
    """NULL without a digit; minutes*60000 + seconds*1000 + ms from the first match of each unit."""
    if text is None or not re.search(r"\d", text):
        return None
    total = _first(r"(\d+)min", text) * 60000 + _first(r"(\d+)s(?![a-z])", text) * 1000 + _first(r"(\d+)ms", text)
    if hours:
        total += _first(r"(\d+)h", text) * 3600000
    return total if -2**31 <= total < 2**31 else "overflow"


@settings(max_examples=8, deadline=None)
@given(st.lists(DURATION_TEXT, min_size=20, max_size=60))
def test_duration_matches_python(spark, texts):
    expected = [duration_expected(t) for t in texts]
    if "overflow" in expected:  # the SQL raises on integer overflow; so does ANSI Spark
        return
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, x string")
    got = [r[0] for r in df.orderBy("i").select(parse.parse_duration_ms("x")).collect()]
    assert got == expected


def rate_expected(text):
    if text is None or not re.fullmatch(r"(?s).* / .*", text):
        return (None, None, None)
    parts = text.split(" / ")
    n = int(parts[0]) if parts[0] != "" else None
    d = int(parts[1]) if parts[1] != "" else None
    if d is None or d == 0 or n is None:
        return (n, d, None)
    q = (Decimal(n) / Decimal(d)).quantize(Decimal("0.0001"), rounding=ROUND_HALF_UP)
    return (n, d, q)


RATE_TEXT = st.one_of(
    st.tuples(st.integers(-999, 999), st.integers(-999, 999)).map(lambda t: f"{t[0]} / {t[1]}"),
    st.tuples(st.integers(0, 99), st.integers(1, 99)).filter(lambda t: abs(t[0]) < 10 * abs(t[1]))
      .map(lambda t: f"{t[0]} / {t[1]}"),
    st.sampled_from(["5 / ", " / 4", "1/2", "0 / 0", "1 / 2 / 3", "7 /  8"]),
)


@settings(max_examples=8, deadline=None)
@given(st.lists(RATE_TEXT, min_size=20, max_size=60))
def test_success_rate_matches_python(spark, texts):
    expected = [rate_expected(t) for t in texts]
    if any(r[2] is not None and abs(r[2]) >= 10 for r in expected):  # DECIMAL(5,4) overflow raises
        return
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, x string")
    num, den, rate = parse.success_rate_parts("x")
    got = [tuple(r) for r in df.orderBy("i").select(num, den, rate).collect()]
    assert got == expected


@settings(max_examples=6, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 10**6).map(str), st.text(alphabet="0123456789 ,.-+a", max_size=8)),
                min_size=20, max_size=60))
def test_guarded_casts_match_python(spark, texts):
    def int_expected(t):
        s = t.strip(" ")
        return int(s) if re.fullmatch(r"\d+", s) and int(s) < 2**31 else (None if not re.fullmatch(r"\d+", s) else "big")

    def km_expected(t):
        s = t.strip(" ").replace(",", ".")
        if not re.fullmatch(r"\d+(\.\d+)?", s):
            return None
        v = Decimal(s).quantize(Decimal("0.001"), rounding=ROUND_HALF_UP)
        return v if v < Decimal("100000") else "big"

    ints, kms = [int_expected(t) for t in texts], [km_expected(t) for t in texts]
    if "big" in ints or "big" in kms:
        return
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, x string")
    got = df.orderBy("i").select(parse.guarded_int("x"), parse.guarded_decimal("x")).collect()
    assert [r[0] for r in got] == ints
    assert [r[1] for r in got] == kms
