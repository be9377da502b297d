"""Scoring and comparison of results."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablewright.functions.scalar import is_nan, squared_error
from tablewright.operators.distribution import box_summary, histogram
from tablewright.operators.encode import label_inverse
from tablewright.session import materialize


def rmse(df: DataFrame, label: str, pred: str, group=None) -> DataFrame:
    """Root mean squared error (and row count), optionally per group."""
    G = [group] if isinstance(group, str) else list(group or [])
    return df.groupBy(*G).agg(F.sqrt(F.avg(squared_error(label, pred))).alias("rmse"),
                              F.count(F.lit(1)).alias("n"))


def with_error(df: DataFrame, label: str, pred: str, name: str = "error") -> DataFrame:
    return df.withColumn(name, squared_error(label, pred))


def extremes_by(df: DataFrame, c: str, n: int, key, largest: bool = True) -> DataFrame:
    """Top/bottom ``n`` rows by ``c``, ties broken by ``key`` (a distributed top-n).

    Null and NaN come last either way.
    """
    k = [key] if isinstance(key, str) else list(key)
    nan = [is_nan(c).asc()] if dict(df.dtypes).get(c) in ("double", "float") else []
    first = F.col(c).desc_nulls_last() if largest else F.col(c).asc_nulls_last()
    return df.orderBy(*nan, first, *[F.col(x).asc() for x in k]).limit(n)


def error_analysis(predicted: DataFrame, label: str, pred: str, key, n: int = 100, mapping: DataFrame | None = None,
                   coded: Sequence[str] = (), charts: Sequence[str] = (), bins: int = 10) -> dict[str, DataFrame]:
    """The ``n`` worst and the ``n`` best predictions, and the numbers that compare them.

    ``rows`` holds the columns of ``predicted`` with ``error`` (squared), ``side``
    ('worst' or 'best') and ``position`` (from 1, the most extreme first, ties by
    ``key``); the label codes in ``coded`` are values again, by ``mapping``.
    ``box`` is the label's box summary per side, ``histogram`` the bins of the
    label and of each column in ``charts``, common to both sides.

    Rows without a label or a prediction (null or NaN) are on neither side;
    where fewer than ``2 n`` rows are left, some are on both.  ``predicted`` is
    written once; all that follows works on at most ``2 n`` rows.
    """
    keys = [key] if isinstance(key, str) else list(key)
    scored = with_error(predicted, label, pred)
    scored = materialize(scored.where(F.col("error").isNotNull() & ~F.isnan("error")))
    rows = reduce(DataFrame.unionByName, [extremes_by(scored, "error", n, keys, side == "worst").withColumn("side", F.lit(side))
                                          for side in ("worst", "best")])
    extreme = F.when(F.col("side") == "worst", -F.col("error")).otherwise(F.col("error"))
    rows = rows.withColumn("position", F.row_number().over(Window.partitionBy("side").orderBy(extreme, *keys)).cast("bigint"))
    rows = materialize(label_inverse(rows, mapping, coded) if coded else rows)
    binned = [histogram(rows, c, bins, "side").select(F.lit(c).alias("column"), "side", "bin", "lower", "upper", "count")
              for c in dict.fromkeys([label, *charts])]
    return {"rows": rows, "box": box_summary(rows, label, "side"), "histogram": reduce(DataFrame.unionByName, binned)}


def _sides(a: DataFrame, b: DataFrame, key: str, c: str, ca: str | None, cb: str | None):
    return (a.select(key, F.col(c if ca is None else ca).alias("a"), F.lit(True).alias("_in_a")),
            b.select(key, F.col(c if cb is None else cb).alias("b"), F.lit(True).alias("_in_b")))


def compare_joined(a: DataFrame, b: DataFrame, key: str, c: str = "target",
                   ca: str | None = None, cb: str | None = None) -> DataFrame:
    """Full outer join of two result tables on ``key`` with a status per row:
    'equal', 'different' (null and NaN equal nothing), 'only_a', 'only_b'.
    ``key`` must be unique and non-null on both sides.
    """
    sa, sb = _sides(a, b, key, c, ca, cb)
    j = sa.join(sb, key, "full_outer")
    ina, inb = F.coalesce("_in_a", F.lit(False)), F.coalesce("_in_b", F.lit(False))
    same = F.col("a") == F.col("b")
    if dict(j.dtypes)["a"] in ("double", "float"):
        same = same & ~F.isnan("a")
    status = (F.when(ina & ~inb, "only_a").when(inb & ~ina, "only_b")
               .when(F.coalesce(same, F.lit(False)), "equal")
               .otherwise("different"))
    return j.select(key, "a", "b", status.alias("status"))


def compare_predictions(a: DataFrame, b: DataFrame, key: str, c: str = "target",
                        ca: str | None = None, cb: str | None = None) -> DataFrame:
    """One-row summary: equal, different, only_a, only_b counts."""
    j = compare_joined(a, b, key, c, ca, cb)
    return j.agg(*[F.count_if(F.col("status") == s).alias(s)
                   for s in ("equal", "different", "only_a", "only_b")])


def differing_rows(a: DataFrame, b: DataFrame, key: str, c: str = "target",
                   ca: str | None = None, cb: str | None = None) -> DataFrame:
    """Rows that are not equal, side by side."""
    return compare_joined(a, b, key, c, ca, cb).where(F.col("status") != "equal")


def diff_tables(a: DataFrame, b: DataFrame, key: str, cols: Sequence[str],
                suffix: str = "_diff") -> DataFrame:
    """Row-wise a - b for the given columns, matched on ``key``."""
    sa = a.select(key, *[F.col(x).alias(f"_a_{x}") for x in cols])
    sb = b.select(key, *[F.col(x).alias(f"_b_{x}") for x in cols])
    j = sa.join(sb, key, "inner")
    return j.select(key, *[(F.col(f"_a_{x}") - F.col(f"_b_{x}")).alias(x + suffix) for x in cols])


DIGIT_BITS, LEVELS = 12, 3


def content_difference(a: DataFrame, b: DataFrame, key, cols: Sequence[str], digit_bits: int = DIGIT_BITS, levels: int = LEVELS) -> DataFrame:
    """Rows (key and ``cols``) that one table holds more often than the other: ``key..., cols..., in_a, in_b``.

    Both tables are multisets here: a repeated row counts as often as it
    stands there, null equals null, NaN equals NaN, and a changed row shows up once with
    its old and once with its new values.

    Rows are dealt to buckets by the hash of their key.  Each table is reduced
    to order-free checksums per bucket (rows, and both halves of the row
    hashes summed), so only 2^digit_bits rows a table move; where checksums
    differ the next digit of the hash is compared, ``levels`` times.  Only rows
    of the buckets that differ at last are shuffled and compared in full, so
    that what moves follows the differences, not the tables.  Different
    content escapes with a probability of about 2^-64 a bucket.
    """
    keys = [key] if isinstance(key, str) else list(key)
    names = [*keys, *cols]
    sides = []
    for df in (a, b):
        kinds = dict(df.dtypes)
        plain = df.select(*[F.col(f"`{c}`") for c in names])
        # equal values hash alike: no negative zero, NaN in one form
        same = [F.when(F.isnan(f"`{c}`"), F.lit("NaN")).otherwise((F.col(f"`{c}`") + 0.0).cast("string")) if kinds[c] in ("double", "float")
                else F.col(f"`{c}`").cast("string") for c in names]
        none = [F.concat_ws(",", *[s.isNull().cast("int").cast("string") for s in same])]
        sides.append(plain.withColumns({"_k": F.xxhash64(*same[:len(keys)]), "_h": F.xxhash64(*same, *none)}))
    marks: list[int] | None = None
    for level in range(1, levels + 1):
        width = digit_bits * level
        mark = F.shiftrightunsigned("_k", 64 - width)
        half = lambda h: [F.sum(h.bitwiseAND(0xFFFFFFFF)).alias("lo"), F.sum(F.shiftrightunsigned(h, 32)).alias("hi")]
        sums = []
        for df in sides:
            held = df if marks is None else df.where(F.shiftrightunsigned("_k", 64 - width + digit_bits).isin(marks))
            sums.append(held.groupBy(mark.alias("m")).agg(F.count("*").alias("n"), *half(F.col("_h"))))
        x, y = sums[0], sums[1].withColumnsRenamed({"n": "n2", "lo": "lo2", "hi": "hi2"})
        differ = x.join(y, "m", "full_outer").where(
            ~(F.col("n").eqNullSafe(F.col("n2")) & F.col("lo").eqNullSafe(F.col("lo2")) & F.col("hi").eqNullSafe(F.col("hi2"))))
        # a bounded number of marks: beyond a digit's worth the tables differ widely, and deeper levels would not pay
        found = [r["m"] for r in differ.select("m").limit((1 << digit_bits) + 1).collect()]
        if len(found) > 1 << digit_bits:
            break
        marks, last = found, width
        if not found:
            break
    out = []
    for side, df in zip("ab", sides):
        if marks is not None:
            df = df.where(F.shiftrightunsigned("_k", 64 - last).isin(marks))
        out.append(df.select(*names, F.lit(int(side == "a")).alias("_a"), F.lit(int(side == "b")).alias("_b")))
    both = out[0].unionByName(out[1]).groupBy(*[F.col(f"`{c}`") for c in names]).agg(F.sum("_a").alias("in_a"), F.sum("_b").alias("in_b"))
    return both.where("in_a <> in_b")
