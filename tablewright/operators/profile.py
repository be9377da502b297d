"""Profiling queries (O06–O18).  Each is one aggregate pass; results have one
row per column or per value, never the data itself."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.operators.ordered import _weights, quantile_method, quantiles
from tablewright.session import (DEFAULT_BROADCAST_ROWS, attach_row, fits_broadcast, join_bounded,
                                 materialize, nullsafe_join)

_FLOATS = (T.FloatType, T.DoubleType)


def _is_null(df: DataFrame, c: str, nan_as_null: bool = True) -> Column:
    e = F.col(c).isNull()
    if nan_as_null and isinstance(df.schema[c].dataType, _FLOATS):
        e = e | F.isnan(c)
    return e


def _stack(pairs: list[tuple[str, list[Column]]], names: list[str]) -> Column:
    """``stack`` expression turning one wide row into one row per column."""
    args = []
    for label, vals in pairs:
        args.append(F.lit(label))
        args.extend(vals)
    return F.stack(F.lit(len(pairs)), *args).alias(*names)


def shape(df: DataFrame) -> DataFrame:
    """(rows, columns) as a one-row frame."""
    return df.agg(F.count(F.lit(1)).alias("rows")).withColumn(
        "columns", F.lit(len(df.columns)).cast("int"))


def column_info(df: DataFrame) -> DataFrame:
    """One row per column: name, position, Spark type, non-null count."""
    cols = df.columns
    one = df.agg(*[F.count(F.when(~_is_null(df, c), F.lit(1))).alias(f"_n{i}")
                   for i, c in enumerate(cols)])
    pairs = [(c, [F.lit(i), F.lit(df.schema[c].dataType.simpleString()), F.col(f"_n{i}")])
             for i, c in enumerate(cols)]
    return one.select(_stack(pairs, ["column", "position", "dtype", "non_null"]))


def null_report(df: DataFrame, nan_as_null: bool = True) -> DataFrame:
    """One row per column: nulls, non_null and total, from one pass."""
    cols = df.columns
    one = df.agg(F.count(F.lit(1)).alias("_total"),
                 *[F.count_if(_is_null(df, c, nan_as_null)).alias(f"_z{i}")
                   for i, c in enumerate(cols)])
    pairs = [(c, [F.col(f"_z{i}")]) for i, c in enumerate(cols)]
    return (one.select("_total", _stack(pairs, ["column", "nulls"]))
               .select("column", "nulls",
                       (F.col("_total") - F.col("nulls")).alias("non_null"),
                       F.col("_total").alias("total")))


def null_ratio(df: DataFrame, nan_as_null: bool = True) -> DataFrame:
    """Columns that have nulls, with their null share, smallest first."""
    r = null_report(df, nan_as_null)
    return (r.where(F.col("nulls") > 0)
             .select("column", "nulls", (F.col("nulls") / F.col("total")).alias("null_ratio"))
             .orderBy("null_ratio", "column"))


def column_kinds(df: DataFrame) -> DataFrame:
    """Numeric columns are 'continuous', all others 'categorical'.

    Decided from the schema alone (no data is read).
    """
    pairs = [F.struct(F.lit(f.name).alias("column"),
                      F.lit("continuous" if isinstance(f.dataType, T.NumericType)
                            else "categorical").alias("kind"))
             for f in df.schema.fields]
    # one literal row per column, built on the JVM side
    return df.sparkSession.range(1).select(F.inline(F.array(*pairs)))


def value_counts(df: DataFrame, c: str, sort: str = "count", dropna: bool = True,
                 name: str = "count") -> DataFrame:
    """Frequency table of one column (nulls and NaN skipped unless ``dropna=False``).

    Partial counts are combined map-side, so a value holding a third of the
    rows costs no more than any other.
    """
    src = df.where(~_is_null(df, c)) if dropna else df
    out = src.groupBy(c).agg(F.count(F.lit(1)).alias(name))
    if sort == "count":
        return out.orderBy(F.col(name).desc(), F.col(c).asc())
    if sort == "value":
        return out.orderBy(F.col(c).asc())
    return out


def distinct_size(df: DataFrame, cols: Sequence[str], approx: bool = False) -> DataFrame:
    """Number of distinct values per column; null and NaN together count as one value."""
    aggs = []
    for i, c in enumerate(cols):
        miss = _is_null(df, c)
        x = F.when(~miss, F.col(c))
        d = F.approx_count_distinct(x) if approx else F.count_distinct(x)
        aggs.append((d + F.coalesce(F.max(miss.cast("int")), F.lit(0))).alias(f"_d{i}"))
    one = df.agg(*aggs)
    pairs = [(c, [F.col(f"_d{i}").cast("bigint")]) for i, c in enumerate(cols)]
    return one.select(_stack(pairs, ["column", "n_distinct"]))


def rare_values(df: DataFrame, c: str, below: int) -> DataFrame:
    """Values that occur fewer than ``below`` times, with their counts."""
    return value_counts(df, c, sort=None).where(F.col("count") < below)


def keep_by_frequency(df: DataFrame, c: str, min_count: int | None = None,
                      max_count: int | None = None) -> DataFrame:
    """Rows whose value of ``c`` occurs between min_count and max_count times.

    Counts are one partial/final aggregate.  The qualifying values are
    checkpointed and counted.  Up to DEFAULT_BROADCAST_ROWS of them are
    broadcast into a left-semi join, so the rows are never shuffled.  A longer
    list is joined by shuffle, where AQE splits the partition of a hot value.
    """
    cnt = value_counts(df, c, sort=None)
    if min_count is not None:
        cnt = cnt.where(F.col("count") >= min_count)
    if max_count is not None:
        cnt = cnt.where(F.col("count") <= max_count)
    keep = materialize(cnt.select(c))
    return join_bounded(df, keep, c, "left_semi", DEFAULT_BROADCAST_ROWS)


def ambiguous_keys(df: DataFrame, key: str, value: str, min_distinct: int = 2) -> DataFrame:
    """Keys linked to at least ``min_distinct`` distinct (non-null) values."""
    return (df.where(F.col(key).isNotNull())
              .groupBy(key).agg(F.count_distinct(value).alias("n_distinct"))
              .where(F.col("n_distinct") >= min_distinct))


DEFAULT_PERCENTILES = (0.25, 0.5, 0.75)


def describe(df: DataFrame, c: str, percentiles: Sequence[float] = DEFAULT_PERCENTILES,
             as_int: bool = False, method: str = "auto", group=None) -> DataFrame:
    """count, mean, sample std, min, percentiles, max of one column.

    The moments come from one aggregate; percentiles from `quantiles`.  With
    ``as_int`` every statistic is truncated toward zero to bigint.
    """
    G = [group] if isinstance(group, str) else list(group or [])
    x = F.col(c).cast("double")
    ok = df.where(F.col(c).isNotNull() & ~F.isnan(x))
    mom = ok.groupBy(*G).agg(F.count(F.lit(1)).alias("count"), F.avg(x).alias("mean"),
                             F.stddev_samp(x).alias("std"), F.min(x).alias("min"),
                             F.max(x).alias("max"), F.approx_count_distinct(x, 0.02).alias("_d"))
    if method == "auto":
        # the same pass tells how many distinct values the quantiles would gather
        mom = materialize(mom)      # one row a group
        method = quantile_method(mom.agg(F.max("_d")).first()[0])
    ps = list(percentiles)
    qn = [f"p{round(p * 100, 6):g}".replace(".", "_") for p in ps]
    q = quantiles(ok, c, ps, G, method=method, names=qn)
    out = nullsafe_join(mom, q, G, "left") if G else attach_row(mom, q)
    stats = ["count", "mean", "std", "min", *qn, "max"]
    sel = [*G] + [F.col(s) for s in stats]
    out = out.select(*sel)
    if as_int:
        out = out.select(*G, *[F.col(s).cast("bigint").alias(s) for s in stats])
    return out


SKETCH_BUCKETS = 64


def describe_columns(df: DataFrame, cols: Sequence[str], percentiles: Sequence[float] = DEFAULT_PERCENTILES,
                     group=None, method: str = "auto", buckets: int = SKETCH_BUCKETS) -> DataFrame:
    """``describe`` of several columns, one row per group and column (``column``), in a fixed number of scans.

    Every row is read as one narrow (group, column, value) record a column.
    The first scan takes moments and a mergeable quantile sketch of every
    column and group in one aggregate.  Where no column has more distinct
    values than ``percentile`` may gather, one more scan ends it.  Else the
    sketches cut each column and group into about ``buckets`` buckets; the second scan
    counts them, which tells the buckets that hold the wanted order statistics,
    and the third ranks only these, ties collapsed.  Nulls and NaN are
    skipped; a column without any value has no row.
    """
    G = [group] if isinstance(group, str) else list(group or [])
    cols, ps = list(cols), list(percentiles)
    qn = [f"p{round(p * 100, 6):g}".replace(".", "_") for p in ps]
    long = df.select(*G, F.inline(F.array(*[F.struct(F.lit(i).alias("_col"), F.col(f"`{c}`").cast("double").alias("_x"))
                                            for i, c in enumerate(cols)]))).where(F.col("_x").isNotNull() & ~F.isnan("_x"))
    K, x = [*G, "_col"], F.col("_x")
    cuts = [i / buckets for i in range(1, buckets)]
    mom = materialize(long.groupBy(*K).agg(
        F.count(F.lit(1)).alias("count"), F.avg(x).alias("mean"), F.stddev_samp(x).alias("std"), F.min(x).alias("min"), F.max(x).alias("max"),
        F.array_distinct(F.percentile_approx(x, cuts, 20 * buckets)).alias("_cuts"), F.approx_count_distinct(x, 0.02).alias("_d")))
    if method == "auto":
        method = quantile_method(mom.agg(F.max("_d")).first()[0])
    if method == "percentile":
        q = long.groupBy(*K).agg(F.percentile(x, ps).alias("_q")).select(*K, *[F.col("_q")[i].alias(n) for i, n in enumerate(qn)])
    elif method == "select":
        q = _select_columns(long, K, mom.select(*K, "count", "_cuts"), ps, qn)
    else:
        raise ValueError(f"unknown method {method!r}")
    out = nullsafe_join(mom, q, K, "left")
    return out.select(*G, F.element_at(F.array(*[F.lit(c) for c in cols]), F.col("_col") + 1).alias("column"),
                      "count", "mean", "std", "min", *qn, "max")


def _select_columns(long: DataFrame, K: list[str], shape: DataFrame, probs: Sequence[float], names: Sequence[str]) -> DataFrame:
    """Exact quantiles per key: ``shape`` has ``count`` and the bucket bounds ``_cuts`` of each key."""
    small = fits_broadcast(shape)
    bucket = F.size(F.filter("_cuts", lambda b: b < F.col("_x")))
    counted = (nullsafe_join(long, shape.select(*K, "_cuts"), K, "inner", broadcast_right=small)
               .groupBy(*K, bucket.alias("_b")).agg(F.count(F.lit(1)).alias("_c")))
    w = Window.partitionBy(*K).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    counted = nullsafe_join(counted.withColumn("_s", F.coalesce(F.sum("_c").over(w), F.lit(0))), shape.select(*K, "count"), K, "inner")
    n1 = (F.col("count") - 1).cast("double")
    wanted = [t for p in probs for t in (F.floor(n1 * F.lit(float(p))), F.ceil(n1 * F.lit(float(p))))]
    need = reduce(lambda a, t: a | ((F.col("_s") <= t) & (t < F.col("_s") + F.col("_c"))), wanted, F.lit(False))
    # the bounds and the wanted buckets (two a probability at most) of each key in one row
    picked = counted.where(need).groupBy(*K).agg(F.map_from_entries(F.collect_list(F.struct("_b", "_s"))).alias("_need"))
    picked = materialize(nullsafe_join(picked, shape, K, "inner"))
    rows = (nullsafe_join(long, picked, K, "inner", broadcast_right=fits_broadcast(picked))
            .select(*K, "_x", "count", bucket.alias("_b"), "_need").withColumn("_s", F.element_at("_need", F.col("_b"))).where("_s is not null"))
    d = rows.groupBy(*K, "count", "_b", "_s", "_x").agg(F.count(F.lit(1)).alias("_c"))
    run = Window.partitionBy(*K, "_b").orderBy("_x").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    d = d.withColumn("_e", F.col("_s") + F.sum("_c").over(run) - 1)
    first, aggs = F.col("_e") - F.col("_c") + 1, []
    for i, p in enumerate(probs):
        h = n1 * F.lit(float(p))
        aggs += [F.max(F.when((first <= t) & (t <= F.col("_e")), F.col("_x"))).alias(f"_{n}{i}") for n, t in (("lo", F.floor(h)), ("hi", F.ceil(h)))]
        aggs.append(F.max(h).alias(f"_h{i}"))
    got = d.groupBy(*K).agg(*aggs)
    return got.select(*K, *[_weights(F.col(f"_lo{i}"), F.col(f"_hi{i}"), F.col(f"_h{i}")).alias(n) for i, n in enumerate(names)])


def compare_means(tables: Mapping[str, DataFrame], c: str | Mapping[str, str],
                  tag: str = "table") -> DataFrame:
    """Mean of a column in each of several tables, one row per table.

    ``c`` may map table name → column name when names differ.  The tables are
    unioned with a tag and averaged in one aggregate.
    """
    parts = []
    for name, df in tables.items():
        cn = c[name] if isinstance(c, Mapping) else c
        x = F.col(cn).cast("double")
        parts.append(df.select(F.lit(name).alias(tag), F.when(~F.isnan(x), x).alias("_x")))
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    return u.groupBy(tag).agg(F.avg("_x").alias("mean"), F.count("_x").alias("count"))


def count_where(df: DataFrame, conditions: Mapping[str, Column | str]) -> DataFrame:
    """Several conditional counts in one pass: {name: condition}."""
    aggs = []
    for name, cond in conditions.items():
        e = F.expr(cond) if isinstance(cond, str) else cond
        aggs.append(F.count_if(F.coalesce(e, F.lit(False))).alias(name))
    return df.agg(*aggs)


def head(df: DataFrame, n: int, order_by) -> DataFrame:
    """First ``n`` rows in an explicit order (a distributed top-n)."""
    ob = [order_by] if isinstance(order_by, (str, Column)) else list(order_by)
    return df.orderBy(*ob).limit(n)


def partition_check(df: DataFrame, c: str, groups: Mapping[str, Sequence]) -> DataFrame:
    """Check that named value lists split a column's distinct values exactly.

    One row: distinct non-null values in the column, how many fall in each
    list, how many in several lists, and how many in none (all from one
    aggregate over the distinct values).
    """
    names = list(groups)
    d = df.select(c).where(F.col(c).isNotNull()).distinct()
    member = {n: F.col(c).isin(list(groups[n])).cast("int") for n in names}
    hits = sum(member.values()) if names else F.lit(0)
    return d.agg(F.count(F.lit(1)).alias("n_distinct"),
                 *[F.sum(m).cast("bigint").alias(f"n_{n}") for n, m in member.items()],
                 F.count_if(hits > 1).alias("n_overlap"),
                 F.count_if(hits == 0).alias("n_uncovered"))
