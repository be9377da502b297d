"""Feature expressions.

All of these return `Column`s built from Spark's built-in functions, so they
stay inside whole-stage code generation.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.session import col as _c

# Month → season, as the reference defines it.
WINTER_MONTHS = [12, 1, 2]
SPRING_MONTHS = [3, 4, 5]
SUMMER_MONTHS = [6, 7, 8]
# every other month is autumn


# Fixed value: the characters that Python's str.split() and str.strip() take as white space.
BLANK = "[\\t-\\r\\x1c-\\x20\\x85\\u00a0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]"


def strip_blank(c) -> Column:
    """Text without white space (of any script) at either end."""
    return F.regexp_replace(_c(c), rf"\A{BLANK}+|{BLANK}+\z", "")


def split_token(c, i: int, pattern: str = rf"{BLANK}+") -> Column:
    """Token ``i`` (0-based) of a whitespace-split text; null when absent."""
    s = strip_blank(c)
    return F.when(s != "", F.get(F.split(s, pattern), i))


def is_nan(c) -> Column:
    """True for a floating NaN; false for null and for every other number."""
    return F.coalesce(F.isnan(_c(c).cast("double")), F.lit(False))


def yyyymm(ts) -> Column:
    """Timestamp/date → integer YYYYMM."""
    t = _c(ts)
    return (F.year(t) * 100 + F.month(t)).cast("int")


def split_yyyymm(df: DataFrame, c: str, year: str = "cont_year",
                 month: str = "cont_month", as_text: bool = False,
                 drop: bool = True) -> DataFrame:
    """Split an integer YYYYMM column into year and month columns.

    ``as_text=True`` keeps them as the text slices (``'2023'``, ``'06'``),
    which is the form period filters must compare against.
    """
    s = F.col(c).cast("string")
    y, m = F.substring(s, 1, 4), F.substring(s, 5, 2)
    if not as_text:
        y, m = y.cast("int"), m.cast("int")
    out = df.withColumns({year: y, month: m})
    return out.drop(c) if drop else out


def season(month) -> Column:
    """Month number → 'winter' | 'spring' | 'summer' | 'autumn'."""
    m = _c(month)
    return (F.when(m.isin(WINTER_MONTHS), "winter")
            .when(m.isin(SPRING_MONTHS), "spring")
            .when(m.isin(SUMMER_MONTHS), "summer")
            .otherwise("autumn"))


def in_set_flag(c, values: Iterable) -> Column:
    """1 when the value is in ``values``, else 0 (null → 0)."""
    return F.coalesce(_c(c).isin(list(values)), F.lit(False)).cast("int")


def threshold_flag(c, at_least) -> Column:
    """1 when ``c >= at_least``, else 0; a null or NaN compares false → 0."""
    return F.when((_c(c) >= F.lit(at_least)) & ~is_nan(c), 1).otherwise(0).cast("int")


def concat_key(cols: Iterable, null_as: str | None = None, sep: str = "") -> Column:
    """Concatenate text columns into one key.

    With ``null_as=None`` a null anywhere makes the key null (string ``+`` in
    the reference); with ``null_as=''`` nulls are filled first.
    """
    parts = [_c(x).cast("string") for x in cols]
    if null_as is not None:
        parts = [F.coalesce(p, F.lit(null_as)) for p in parts]
    if sep:
        out = parts[0]
        for p in parts[1:]:
            out = F.concat(out, F.lit(sep), p)
        return out
    return F.concat(*parts)


def round_half_even(c, n: int = 2) -> Column:
    """Round to ``n`` places the way NumPy does: scale, round half to even, unscale.

    ``bround`` rounds the exact decimal value instead, which differs on
    doubles whose scaled value lands near .5.
    """
    k = float(10 ** n)
    return F.rint(_c(c) * F.lit(k)) / F.lit(k)


def truncate_int(c, to: str = "bigint") -> Column:
    """Truncate toward zero (``astype(int)``)."""
    return _c(c).cast(to)


def log1p_label(c) -> Column:
    return F.log1p(_c(c))


def expm1_label(c) -> Column:
    return F.expm1(_c(c))


def ratio(num, den) -> Column:
    """num / den, null when den is 0 or null (ANSI-safe)."""
    return F.try_divide(_c(num).cast("double"), _c(den).cast("double"))


def squared_error(label, pred) -> Column:
    d = _c(label).cast("double") - _c(pred).cast("double")
    return d * d
