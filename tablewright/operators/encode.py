"""Category encoders.

A label mapping is a DataFrame ``(column, value, code)``: codes are 0-based
ranks of the distinct non-null values in sorted order (as text by code point,
or in the column's own order).  Mappings are fitted by one distributed
distinct and sort at every size and checkpointed, so applying them never
refits and measuring them before a broadcast is cheap.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.operators.ordered import sorted_rank
from tablewright.session import DEFAULT_BROADCAST_ROWS, join_bounded, materialize


def _distinct_values(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Distinct (column, value) of several columns, values as text, one shuffle."""
    structs = [F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("value")) for c in cols]
    return (df.select(F.inline(F.array(*structs)))
              .where(F.col("value").isNotNull())
              .distinct())


def _codes(values: DataFrame, order: Sequence, base: DataFrame | None = None) -> DataFrame:
    """``column, value, code``: ranks of the values in ``order`` per column, after ``base`` if given.

    One distributed sort whatever the vocabulary's size; the first rank of
    each column (one row a column) turns table ranks into codes.
    """
    r = sorted_rank(values, ["column", *order], "_rank")
    first = r.groupBy("column").agg(F.min("_rank").alias("_first"))
    if base is not None:
        first = first.join(base, "column", "left")
    shift = F.coalesce(F.col("_base"), F.lit(0)) if base is not None else F.lit(0)
    return (r.join(F.broadcast(first), "column")    # one row a column
            .select("column", "value", (F.col("_rank") - F.col("_first") + shift).cast("bigint").alias("code")))


def _coded(df: DataFrame, cols: Sequence[str], as_text: bool, known: DataFrame | None = None,
           base: DataFrame | None = None) -> DataFrame:
    if as_text:
        vals = _distinct_values(df, cols)
        if known is not None:
            vals = vals.join(known, ["column", "value"], "left_anti")
        return _codes(vals, ["value"], base)
    out = None
    for c in cols:                # each column in the order of its own type
        vals = (df.select(F.lit(c).alias("column"), F.col(f"`{c}`").alias("_v")).where(F.col("_v").isNotNull())
                .distinct().withColumn("value", F.col("_v").cast("string")))
        if known is not None:
            vals = vals.join(known, ["column", "value"], "left_anti")
        part = _codes(vals, ["_v"], base)
        out = part if out is None else out.unionByName(part)
    return out


def label_fit(df: DataFrame, cols: Sequence[str], as_text: bool = True) -> DataFrame:
    """Fit label codes for ``cols`` on all rows of ``df``; the mapping is checkpointed.

    Codes rank the values as text, by code point; with ``as_text=False`` each
    column ranks in the order of its own type (numbers by size, NaN last).
    """
    return materialize(_coded(df, list(cols), as_text))


def label_extend(mapping: DataFrame, df: DataFrame, cols: Sequence[str] | None = None,
                 as_text: bool = True) -> DataFrame:
    """Append codes for values of ``df`` absent from ``mapping``.

    Each unseen value gets its own code, numbered after the fitted ones in
    sorted order (n_fitted, n_fitted + 1, ...), per column.
    """
    base = materialize(mapping.groupBy("column").agg((F.max("code") + 1).alias("_base")))
    if not cols:
        cols = [r[0] for r in base.select("column").collect()]      # one row a column
    new = _coded(df, list(cols), as_text, mapping.select("column", "value"), base)
    return materialize(mapping.select("column", "value", "code").unionByName(new))


def _column_map(mapping: DataFrame, c: str) -> DataFrame:
    return mapping.where(F.col("column") == c).select(
        F.col("value").alias(f"_lv_{c}"), F.col("code").alias(f"_lc_{c}"))


def label_transform(df: DataFrame, mapping: DataFrame, cols: Sequence[str],
                    suffix: str | None = None,
                    max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Replace (or, with ``suffix``, add) each column by its code; unseen → null.

    Each column's mapping is broadcast when it has at most
    ``max_broadcast_rows`` entries, otherwise joined by shuffle.
    """
    out = df
    for c in cols:
        m = _column_map(mapping, c)     # checkpointed, so measuring it is cheap
        out = join_bounded(out, m, F.col(f"`{c}`").cast("string") == F.col(f"`_lv_{c}`"), "left", max_broadcast_rows)
        target = c + suffix if suffix else c
        out = out.withColumn(target, F.col(f"`_lc_{c}`")).drop(f"_lv_{c}", f"_lc_{c}")
    return out


def label_inverse(df: DataFrame, mapping: DataFrame, cols: Sequence[str] | Mapping[str, str],
                  max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Codes back to values.  ``cols`` maps code column → mapping column name
    (a list means the names are the same).  Values come back as text."""
    pairs = dict(cols) if isinstance(cols, Mapping) else {c: c for c in cols}
    out = df
    for code_col, src in pairs.items():
        m = _column_map(mapping, src)
        out = join_bounded(out, m, F.col(f"`{code_col}`") == F.col(f"`_lc_{src}`"), "left", max_broadcast_rows)
        out = out.withColumn(code_col, F.col(f"`_lv_{src}`")).drop(f"_lv_{src}", f"_lc_{src}")
    return out


def levels(df: DataFrame, c: str, max_levels: int = 1000) -> list:
    """Sorted distinct non-null values of a column, refusing more than ``max_levels``."""
    x = F.col(f"`{c}`")
    rows = (df.select(x).where(x.isNotNull()).distinct()
              .orderBy(x).limit(max_levels + 1).collect())
    if len(rows) > max_levels:
        raise ValueError(f"{c} has more than {max_levels} levels; use one_hot_vector or label codes")
    return [r[0] for r in rows]


def too_many_levels(df: DataFrame, cols: Sequence[str], max_levels: int = 1000) -> list[str]:
    """The columns with more than ``max_levels`` distinct values, all counted in one pass over the distinct values."""
    counts = _distinct_values(df, cols).groupBy("column").agg(F.count("*").alias("n"))
    return [r["column"] for r in counts.where(F.col("n") > max_levels).collect()]       # one row a column


def one_hot_names(c: str, values: Sequence, drop_first: bool = False, sep: str = "_") -> list[str]:
    vals = list(values)[1:] if drop_first else list(values)
    return [f"{c}{sep}{v}" for v in vals]


def one_hot(df: DataFrame, cols: Sequence[str], values: Mapping[str, Sequence] | None = None,
            drop_first: bool = False, sep: str = "_", max_levels: int = 1000,
            keep_original: bool = False) -> DataFrame:
    """One 0/1 int column ``<col><sep><value>`` per level, in sorted level order.

    Levels come from ``values`` (e.g. the training table's levels, so train
    and test get the same columns) or are read from ``df``; the level count
    is bounded by ``max_levels``.  A null or unseen value gives all zeros.
    The original column is removed and the new columns are appended.
    """
    values = dict(values or {})
    new = {}
    for c in cols:
        lv = values.get(c)
        if lv is None:
            lv = levels(df, c, max_levels)
        lv = sorted(lv)
        use = lv[1:] if drop_first else lv
        for v in use:
            new[f"{c}{sep}{v}"] = F.coalesce(F.col(f"`{c}`") == F.lit(v), F.lit(False)).cast("int")
    out = df.withColumns(new)
    if not keep_original:
        rest = [x for x in df.columns if x not in cols]
        out = out.select(*[f"`{x}`" for x in [*rest, *new]])
    return out


def one_hot_vector(df: DataFrame, mapping: DataFrame, cols: Sequence[str],
                   suffix: str = "_vec", drop_first: bool = False) -> DataFrame:
    """One-hot as sparse vectors for model input (one column per category column).

    Codes come from a label mapping (so train and test share positions); a
    vector has one slot per fitted level, an unseen or null value gives the
    all-zero vector, and ``drop_first`` removes the slot of code 0.  Many
    levels cost one sparse vector instead of one column per level.
    """
    from pyspark.ml.feature import OneHotEncoder

    coded = label_transform(df, mapping, cols, suffix="_code")
    sizes = {r["column"]: r["n"] for r in
             mapping.groupBy("column").agg(F.count(F.lit(1)).alias("n")).collect()}    # one row a column
    out = coded
    for c in cols:
        code = F.col(f"{c}_code")
        n = sizes.get(c, 0)
        # shift so the first level can be dropped, and send unseen/null to the
        # extra slot that the encoder drops (dropLast)
        idx = code - 1 if drop_first else code
        width = n - 1 if drop_first else n
        idx = F.when(code.isNull() | (idx < 0), F.lit(width)).otherwise(idx)
        out = out.withColumn(f"_{c}_idx", idx.cast("double"))
        enc = OneHotEncoder(inputCol=f"_{c}_idx", outputCol=c + suffix, dropLast=True,
                            handleInvalid="error")
        out = enc.fit(out.sparkSession.range(1).select(F.lit(float(width)).alias(f"_{c}_idx"))) \
                 .transform(out).drop(f"_{c}_idx", f"{c}_code")
    return out
