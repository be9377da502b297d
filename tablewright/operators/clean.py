"""Cleaning, projection and predicates.

Interpolation (O21) lives in `ordered.py`; it is re-exported here.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.functions.scalar import BLANK, is_nan, ratio
from tablewright.operators.ordered import interpolate_linear, quantile_values
from tablewright.operators.profile import null_report

__all__ = [
    "sentinels_to_null", "blank_to_null", "interpolate_linear", "fill_constant",
    "drop_sparse_columns", "cast_columns", "rename", "project", "drop", "where",
    "where_in", "trim_outliers_iqr", "iqr_bounds", "trim_outliers_bound",
    "bound_counts", "trim_outliers_ratio", "rows_missing",
]


def sentinels_to_null(df: DataFrame, sentinels: Mapping[str, Sequence]) -> DataFrame:
    """Replace exact sentinel values (e.g. ``' '``, ``'-'``) by null, per column."""
    return df.withColumns({
        c: F.when(F.col(c).isin(list(vals)), F.lit(None)).otherwise(F.col(c))
        for c, vals in sentinels.items()})


def blank_to_null(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Strings that are empty or whitespace (of any script) only become null."""
    return df.withColumns({
        c: F.when(F.col(c).rlike(rf"\A{BLANK}*\z"), F.lit(None)).otherwise(F.col(c)) for c in cols})


def fill_constant(df: DataFrame, cols: Sequence[str], value) -> DataFrame:
    """Fill nulls in the given columns with one constant."""
    return df.fillna(value, subset=list(cols))


def drop_sparse_columns(df: DataFrame, max_nulls: int | None = None,
                        max_ratio: float | None = None, nan_as_null: bool = True) -> DataFrame:
    """Drop columns with more nulls than allowed; keep iff nulls <= max_nulls.

    One aggregate pass; the collected result has one row per column.
    """
    rep = null_report(df, nan_as_null).collect()
    keep = []
    for r in rep:
        ok = True
        if max_nulls is not None and r["nulls"] > max_nulls:
            ok = False
        if max_ratio is not None and r["total"] and r["nulls"] / r["total"] > max_ratio:
            ok = False
        if ok:
            keep.append(r["column"])
    return df.select(*[c for c in df.columns if c in keep])


def cast_columns(df: DataFrame, types: Mapping[str, str], null_text: str | None = None,
                 safe: bool = True) -> DataFrame:
    """Cast columns; ``safe`` uses try_cast (null on failure, as ANSI mode would raise).

    ``null_text`` fills nulls of columns cast to string with a text such as
    ``'nan'`` (what casting a float column with NaN to str produces).
    """
    out = {}
    for c, t in types.items():
        e = F.col(c).try_cast(t) if safe else F.col(c).cast(t)
        if null_text is not None and t in ("string", "str"):
            e = F.coalesce(e, F.lit(null_text))
        out[c] = e
    return df.withColumns(out)


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(mapping))


def project(df: DataFrame, cols: Sequence) -> DataFrame:
    return df.select(*cols)


def drop(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Drop columns; names that do not exist are ignored."""
    return df.drop(*cols)


def where(df: DataFrame, cond: Column | str) -> DataFrame:
    """Row filter from a SQL expression string or a boolean column."""
    return df.where(F.expr(cond) if isinstance(cond, str) else cond)


def where_in(df: DataFrame, c, values: Sequence, negate: bool = False) -> DataFrame:
    """Rows whose value is in ``values``; with ``negate`` the complement.

    The complement keeps rows whose value is null (as a boolean-mask
    complement does), so the two results always partition the table.
    """
    e = (F.col(c) if isinstance(c, str) else c).isin(list(values))
    return df.where(~F.coalesce(e, F.lit(False)) if negate else F.coalesce(e, F.lit(False)))


def _only(only) -> Column:
    if only is None:
        return F.lit(True)
    e = F.expr(only) if isinstance(only, str) else only
    return F.coalesce(e, F.lit(False))


def iqr_bounds(df: DataFrame, c: str, k: float = 1.5, only=None,
               method: str = "auto") -> tuple[float, float]:
    """(q1 - k*iqr, q3 + k*iqr) over the rows selected by ``only``."""
    src = df.where(_only(only)) if only is not None else df
    q1, q3 = quantile_values(src, c, [0.25, 0.75], method=method)
    if q1 is None:
        return None, None
    iqr = q3 - q1
    return q1 - k * iqr, q3 + k * iqr


def trim_outliers_iqr(df: DataFrame, c: str, k: float = 1.5, only="is_test = 0",
                      method: str = "auto") -> DataFrame:
    """Remove rows outside the inclusive IQR fences, among ``only`` rows only.

    Fences come from the ``only`` rows (training rows); other rows are kept
    whole.  A null value fails the comparison and is removed from the
    ``only`` rows.  The two fences are computed by one job and applied as
    literals, so the filter reaches the scan.
    """
    lo, hi = iqr_bounds(df, c, k, only, method)
    if lo is None:
        return df.where(~_only(only))
    inside = F.coalesce((F.col(c) >= F.lit(lo)) & (F.col(c) <= F.lit(hi)), F.lit(False))
    return df.where(~_only(only) | inside)


def trim_outliers_bound(df: DataFrame, c: str, upper: float, only="is_test = 0") -> DataFrame:
    """Keep ``only`` rows with ``c < upper`` (strict); other rows untouched."""
    inside = F.coalesce(F.col(c) < F.lit(upper), F.lit(False))
    return df.where(~_only(only) | inside)


def bound_counts(df: DataFrame, c: str, upper: float, only="is_test = 0") -> DataFrame:
    """Counts around a fixed bound: above (>), at-or-above (>=), for all and ``only`` rows.

    A null or NaN is neither above nor below; the trim removes it from ``only`` rows.
    """
    o = _only(only)
    x = F.when(~is_nan(c), F.col(c))
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(x > upper).alias("above_all"),
        F.count_if(x >= upper).alias("at_or_above_all"),
        F.count_if(o & (x > upper)).alias("above_only"),
        F.count_if(o & (x >= upper)).alias("at_or_above_only"),
        F.count_if(o & ~F.coalesce(x < upper, F.lit(False))).alias("removed"))


def trim_outliers_ratio(df: DataFrame, num: str, den: str, upper: float,
                        only="is_test = 0") -> DataFrame:
    """Keep ``only`` rows with num/den < upper (a zero or null den removes the row)."""
    inside = F.coalesce(ratio(num, den) < F.lit(upper), F.lit(False))
    return df.where(~_only(only) | inside)


def rows_missing(df: DataFrame, c: str, keep: Sequence[str] | None = None) -> DataFrame:
    """Work list of rows whose ``c`` is null (or NaN), projected to ``keep``."""
    x = F.col(c)
    miss = x.isNull()
    if dict(df.dtypes).get(c) in ("double", "float"):
        miss = miss | F.isnan(x)
    out = df.where(miss)
    return out.select(*keep) if keep else out
