"""Scalar parse functions as native Column expressions (no Python UDFs).

All of them stay inside whole-stage codegen; with ANSI mode on, an integer or
decimal overflow raises exactly like the SQL they reproduce.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trackyard.schemas import CALL_RUNNING, NA_TOKENS

RATE_TYPE = T.DecimalType(5, 4)
KM_TYPE = T.DecimalType(8, 3)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _unit(text: Column, pattern: str) -> Column:
    """First captured integer of ``pattern`` or 0 when the unit is absent."""
    return F.coalesce(F.nullif(F.regexp_extract(text, pattern, 1), F.lit("")).cast("int"), F.lit(0))


def parse_duration_ms(c, hours: bool = False) -> Column:
    """``'43min 16s 695ms'`` -> 2596695.

    NULL when the input is NULL or holds no digit; a missing unit counts 0, a
    digit without any unit gives 0. By default an hour part is ignored, as in
    the warehouse being reproduced (``'1h 13min 40s 49ms'`` -> 820049);
    ``hours=True`` is the corrected variant (-> 4420049).
    """
    text = _col(c)
    total = (_unit(text, r"(\d+)min") * F.lit(60000)
             + _unit(text, r"(\d+)s(?![a-z])") * F.lit(1000)
             + _unit(text, r"(\d+)ms"))
    if hours:
        total = _unit(text, r"(\d+)h") * F.lit(3600000) + total
    return F.when(text.isNotNull() & text.rlike(r"\d"), total)


def success_rate_split(c) -> tuple[Column, Column]:
    """Numerator and denominator of ``'5 / 6'``.

    Both NULL unless the text contains ``' / '`` with at least one character
    on both sides (SQL ``LIKE '% / %'``); an empty part is NULL.
    """
    text = _col(c)
    ok = text.isNotNull() & text.like("% / %")
    # field 1 = text before the first separator; field 2 as SQL split_part
    num = F.nullif(F.substring_index(text, " / ", 1), F.lit("")).cast("int")
    den = F.nullif(F.split_part(text, F.lit(" / "), F.lit(2)), F.lit("")).cast("int")
    return F.when(ok, num), F.when(ok, den)


def success_rate_value(num, den) -> Column:
    """``ROUND(num / den, 4)`` as DECIMAL(5,4); NULL when den is 0 or NULL; a ratio >= 10 raises.

    Exact rounding in integers: q = round(|n| / |d| * 10^4), half away from
    zero. For a ratio below 10 (larger ones overflow DECIMAL(5,4) either way)
    the quotient is < 2^17 while its distance to the next integer is at least
    1/(2|d|), far above the double's resolution, so floor() of the double is exact.
    Pass column references: the inputs are used several times.
    """
    n, d = _col(num), _col(den)
    an, ad = F.abs(n.cast("long")), F.abs(d.cast("long"))
    q = F.floor((an * 20000 + ad) / (ad * 2))
    signed = F.when((n < 0) != (d < 0), -q).otherwise(q)
    ratio = (signed.cast("decimal(9,0)") * F.lit(Decimal("0.0001"))).cast(RATE_TYPE)
    return F.when(d != 0, ratio)


def success_rate_parts(c) -> tuple[Column, Column, Column]:
    """``'5 / 6'`` -> (5, 6, 0.8333) in one projection (see the two-step pair above
    for wide tables: it parses each text once)."""
    num, den = success_rate_split(c)
    return num, den, success_rate_value(num, den)


def sentinel_timestamp(c, trim: bool = True) -> Column:
    """Timestamp text, NULL for the running-call sentinel.

    ``trim=True`` trims spaces before comparing (ETCS calls); ``trim=False``
    compares the raw text (transactions), so a padded sentinel raises on cast.
    """
    text = _col(c)
    if trim:
        text = F.trim(text)
    return F.nullif(text, F.lit(CALL_RUNNING)).cast(T.TimestampNTZType())


def guarded_int(c) -> Column:
    """Unsigned digit text after trimming -> INT, anything else NULL.

    ``\\z`` (not ``$``) so a trailing newline is not accepted; overflow still
    raises, as a plain cast does.
    """
    t = F.trim(_col(c))
    return F.when(t.rlike(r"^\d+\z"), t.cast("int"))


def guarded_decimal(c, dtype: T.DecimalType = KM_TYPE) -> Column:
    """``'12,5'`` -> 12.500: comma becomes dot, then unsigned decimal text only."""
    t = F.replace(F.trim(_col(c)), F.lit(","), F.lit("."))
    return F.when(t.rlike(r"^\d+(\.\d+)?\z"), t.cast(dtype))


def seconds_to_ms(c) -> Column:
    """DECIMAL seconds -> INT milliseconds, rounded (the source rounds on cast)."""
    return F.round(_col(c) * F.lit(1000)).cast("int")


def na_to_null(c) -> Column:
    """Empty or NA-token text -> NULL (a CSV reader's default NA set)."""
    text = _col(c)
    return F.when(~F.trim(text).isin(list(NA_TOKENS)), text)


# --- integral coercion ------------------------------------------------------
# A numeric text column of one file becomes integral when every non-null value
# is whole (``'13042.0'`` -> 13042). Decimal text is cast through DECIMAL so
# 15-19 digit identifiers stay exact (a DOUBLE detour would round them).

_INT_TEXT = r"^\s*[+-]?\d+\s*\z"


# A try_cast of a text that is no number throws and catches an exception, some 30 us a text: texts with a
# character that no integer or decimal has are settled before.

def try_integer(c, dtype="bigint") -> Column:
    """``try_cast`` to an integer type; a text with a point or an ASCII letter is none."""
    text = _col(c)
    return F.when(~text.rlike("[.A-Za-z]"), text.try_cast(dtype))


def try_decimal(c) -> Column:
    """``try_cast`` to DECIMAL(38,10); a text with an ASCII letter but ``e`` is none."""
    text = _col(c)
    return F.when(~text.rlike("[A-DF-Za-df-z]"), text.try_cast("decimal(38,10)"))


def is_whole(c) -> Column:
    """Null, or a whole number's text.

    Most texts are settled without a decimal: no number begins with an ASCII letter or with one of ``:;<=>?@[\\]^_`{|}~``,
    and digits alone fit an integer.
    """
    text = _col(c)
    exact = F.coalesce(try_decimal(text) % 1 == 0, F.lit(False))
    return text.isNull() | (~F.ascii(text).between(58, 127) & (try_integer(text).isNotNull() | exact))


def all_whole(c) -> Column:
    """Aggregate: every non-null text is a whole number (other text counts as not whole, not as NULL)."""
    return F.bool_and(is_whole(c))


def integral_value(c, dtype="bigint") -> Column:
    """Whole numeric text -> integer type; plain digits cast directly (exact),
    ``'13042.0'`` / ``'1.3042e4'`` via DECIMAL(38,10). Callers check wholeness first
    (:func:`all_whole`); a fractional part would be truncated."""
    text = F.trim(_col(c))
    return F.when(text.rlike(_INT_TEXT), text.cast(dtype)).otherwise(
        text.cast("decimal(38,10)").cast(dtype))


def whole_number_text(c) -> Column:
    """Canonical text of a whole number (``'13042.0'`` -> ``'13042'``)."""
    return integral_value(c, "decimal(38,0)").cast("string")
