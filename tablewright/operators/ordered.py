"""Operators that depend on a global row order (O02 row ids, O21 interpolation,
exact quantiles by rank).

A window without ``partitionBy`` runs in a single task.  Instead the rows are
range-partitioned on ``(partition_by, order_by)`` into blocks, each block is
handled by an ordinary partitioned window, and a small per-block summary
(row count, first and last non-null anchor) carries positions and values
across block borders.  With no ``partition_by`` the summary is at most
``n_blocks`` rows and is broadcast.  With groups only those above
``heavy_rows`` rows are cut into blocks, and only they have summary rows: a
group holding a third of all rows is spread over many tasks, all others are
one plain window each.

``order_by`` lists ascending columns and must be a total order (add a unique
key as the last column):
with ties the relative position of tied rows is not defined.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.session import join_bounded, materialize, shuffle_partitions

_UNB_P, _UNB_F, _CUR = Window.unboundedPreceding, Window.unboundedFollowing, Window.currentRow


def _cols(xs) -> list:
    if xs is None:
        return []
    if isinstance(xs, (str, Column)):
        return [xs]
    return list(xs)


def _names(xs) -> list[str]:
    return [x for x in xs if isinstance(x, str)]


def _reverse(o):
    """Descending counterpart of an ascending order column (nulls last)."""
    return (F.col(o) if isinstance(o, str) else o).desc_nulls_last()


def _numeric_key(df: DataFrame, o) -> Column | None:
    """A double that is non-decreasing in the order of column ``o``, if any."""
    if not isinstance(o, str) or o not in df.columns:
        return None
    t = df.schema[o].dataType
    c = F.col(o)
    if isinstance(t, T.NumericType):
        k = c.cast("double")
    elif isinstance(t, T.DateType):
        k = F.unix_date(c).cast("double")
    elif isinstance(t, T.TimestampType):
        k = F.unix_micros(c).cast("double")
    elif isinstance(t, T.TimestampNTZType):
        k = F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', `{o}`)").cast("double")
    else:
        return None
    # ascending order puts nulls first and NaN last
    return (F.when(c.isNull(), F.lit(float("-inf")))
             .when(F.isnan(k), F.lit(float("inf"))).otherwise(k))


# Block bounds come from a quantile sketch only while it is small (about 20
# entries a block).  Otherwise they come from a bounded sample.
SKETCH_MAX_BLOCKS = 2000
SAMPLE_PER_BLOCK = 50


def _bounds(probe: DataFrame, n: int) -> list[float]:
    """``n - 1`` increasing cut points splitting column ``_k`` into n near-equal parts.

    Up to SKETCH_MAX_BLOCKS parts: an approximate-quantile sketch with rank
    error 1/(20n), merged in a tree.  More parts: a count, then a seeded Bernoulli sample of about
    SAMPLE_PER_BLOCK values per block sent straight from the tasks to the
    driver (bounded by that product whatever the table size) and sorted there.
    """
    probs = [i / n for i in range(1, n)]
    if n <= SKETCH_MAX_BLOCKS:
        return probe.approxQuantile("_k", probs, 1.0 / (20 * n))
    total = probe.count()
    if total == 0:
        return []
    frac = min(1.0, SAMPLE_PER_BLOCK * n / total)
    vals = sorted(r[0] for r in probe.sample(False, frac, seed=17).collect())
    if not vals:
        return []
    return [vals[min(len(vals) - 1, int(p * len(vals)))] for p in probs]


def _blocks(df: DataFrame, order_by: list, partition_by: list,
            n_blocks: int | None) -> DataFrame:
    """Add ``_blk``: blocks that are contiguous ranges of the row order.

    Preferred: bucket the leading order column by approximate quantile bounds
    (one pass over that column; the bound list has ``n_blocks - 1`` numbers).
    The bucket is a deterministic, monotone function of the row, so the
    window's own exchange is the only shuffle and Spark can reuse it for the
    summary branch.  When the leading column is not numeric/temporal, or one
    of its values is too frequent to split (duplicate bounds), rows are range
    partitioned on the full key instead and the blocked frame is checkpointed
    in the shared folder, so that both branches read the same blocks.
    """
    n = n_blocks or shuffle_partitions(df.sparkSession)
    key = _numeric_key(df, order_by[0]) if order_by else None
    if key is not None and n > 1:
        # nulls / NaN stay in the probe as -inf / +inf: if they are many, the
        # bounds repeat and the full-key range partitioning below takes over
        bounds = _bounds(df.select(key.alias("_k")), n)
        finite = bool(bounds) and all(math.isfinite(b) for b in bounds)
        if finite and len(set(bounds)) == len(bounds):
            from pyspark.ml.feature import Bucketizer
            splits = [float("-inf"), *bounds, float("inf")]
            bz = Bucketizer(splits=splits, inputCol="_bk", outputCol="_blkd", handleInvalid="keep")
            out = bz.transform(df.withColumn("_bk", key))
            # non-nullable, so joins on it infer no not-null filter that could be
            # pushed into one branch only (which would stop exchange reuse)
            blk = F.coalesce(F.col("_blkd").cast("int"), F.lit(0))
            return out.withColumn("_blk", blk).drop("_bk", "_blkd")
    if n == 1:
        return df.withColumn("_blk", F.lit(0))
    return materialize(df.repartitionByRange(n, *partition_by, *order_by)
                       .withColumn("_blk", F.coalesce(F.spark_partition_id(), F.lit(0))))


# Groups of at most this many rows are handled whole by one task.
HEAVY_GROUP_ROWS = 1_000_000


def _group_blocks(df: DataFrame, order_by: list, K: list[str], n_blocks: int | None,
                  heavy_rows: int | None, nullsafe: bool) -> tuple[DataFrame, bool]:
    """``(frame with _blk and _heavy, whether any group is heavy)``.

    One partial aggregate finds the groups above ``heavy_rows``.  Only their
    rows get blocks; every other group is block 0 and needs no summary.
    """
    if not K:
        return _blocks(df, order_by, [], n_blocks).withColumn("_heavy", F.lit(True)), True
    limit = HEAVY_GROUP_ROWS if heavy_rows is None else heavy_rows
    heavy = materialize(df.groupBy(*K).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > limit).drop("_n"))
    if not heavy.take(1):
        return df.withColumns({"_blk": F.lit(0), "_heavy": F.lit(False)}), False
    ren = {k: f"_hk{i}" for i, k in enumerate(K)}
    cond = [F.col(k).eqNullSafe(F.col(r)) if nullsafe else F.col(k) == F.col(r) for k, r in ren.items()]
    b = _blocks(df, order_by, K, n_blocks)
    b = join_bounded(b, heavy.withColumnsRenamed(ren).withColumn("_heavy", F.lit(True)), cond, "left").drop(*ren.values())
    b = b.withColumn("_heavy", F.coalesce("_heavy", F.lit(False)))
    return b.withColumn("_blk", F.when(F.col("_heavy"), F.col("_blk")).otherwise(F.lit(0))), True


def _surrogate_default(t):
    if isinstance(t, T.StringType):
        return F.lit("")
    if isinstance(t, T.BooleanType):
        return F.lit(False)
    if isinstance(t, (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.lit(0).cast(t) if isinstance(t, T.NumericType) else \
            F.lit("1970-01-01").cast(t)
    return None


def _group_keys(df: DataFrame, partition_by: list[str]):
    """Non-null stand-ins for nullable group keys: ``(isnull(g), coalesce(g, d))``.

    Windows, the block summary and the join back all use these plain columns,
    so the rows stay hash-partitioned on exactly the join keys and only the
    small summary is moved for the join.  Returns None for key types without
    a default (the null-safe join is used then).
    """
    cols, names = {}, []
    for i, p in enumerate(partition_by):
        d = _surrogate_default(df.schema[p].dataType)
        if d is None:
            return None
        cols[f"_gn{i}"] = F.col(p).isNull()
        cols[f"_gv{i}"] = F.coalesce(F.col(p), d)
        names += [f"_gn{i}", f"_gv{i}"]
    return cols, names


def _keyed(df: DataFrame, partition_by: list):
    """(frame with group stand-ins, keys for windows/joins, stand-in names, null-safe?)."""
    names = _names(partition_by)
    if not partition_by:
        return df, [], [], False
    if len(names) != len(partition_by):
        raise ValueError("partition_by must be column names")
    gk = _group_keys(df, names)
    if gk is None:
        return df, names, [], True
    cols, keys = gk
    return df.withColumns(cols), keys, keys, False


def _join_summary(rows: DataFrame, summary: DataFrame, keys: list[str],
                  nullsafe: bool = False) -> DataFrame:
    """Attach per-(group, block) summary columns to the rows.

    Without groups the summary has one row per block, a bound fixed by
    ``n_blocks``, so it is broadcast.  With groups it has rows for heavy
    groups alone (other rows get nulls) and is joined on (keys, block), which
    the rows' partitioning already satisfies.
    """
    if not keys:
        return rows.join(F.broadcast(summary), "_blk", "inner")
    if not nullsafe:
        return rows.join(summary, [*keys, "_blk"], "left")
    ren = {p: f"_sk{i}" for i, p in enumerate(keys)}
    s = summary.withColumnsRenamed(ren)
    cond = [F.col("_blk") == F.col("_sblk")] + [
        F.col(p).eqNullSafe(F.col(ren[p])) for p in keys]
    s = s.withColumnRenamed("_blk", "_sblk")
    return rows.join(s, cond, "left").drop("_sblk", *ren.values())


def sorted_rank(df: DataFrame, order_by, name: str = "rank") -> DataFrame:
    """``df`` with the dense 0-based rank of each row in the order of the whole key, checkpointed.

    One distributed sort: Spark's range partitioner samples the full key.
    Rows number themselves inside their partition; the partition sizes (one
    number a partition) come to the driver and become offsets.
    """
    out = materialize(df.sort(*_cols(order_by)).withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftrightunsigned("_at", 33)
    sizes = {r["p"]: r["c"] for r in out.groupBy(part.alias("p")).agg(F.count(F.lit(1)).alias("c")).collect()}
    offsets, total = [], 0
    for p in range(max(sizes, default=-1) + 1):
        offsets.append(total)
        total += sizes.get(p, 0)
    start = F.get(F.array(*[F.lit(o).cast("bigint") for o in offsets] or [F.lit(0).cast("bigint")]), part.cast("int"))
    return out.withColumn(name, start + F.col("_at").bitwiseAND((1 << 33) - 1)).drop("_at")


def with_row_id(df: DataFrame, order_by, partition_by=None, name: str = "row_id",
                n_blocks: int | None = None, group_size: str | None = None,
                heavy_rows: int | None = None) -> DataFrame:
    """Add a dense 0-based position in ``order_by`` order (per group if given).

    ``group_size`` names an optional column holding the size of each row's
    group.  Groups above ``heavy_rows`` rows are cut into blocks.
    """
    O, P = _cols(order_by), _cols(partition_by)
    src, K, extra, nullsafe = _keyed(df, P)
    b, heavy = _group_blocks(src, O, K, n_blocks, heavy_rows, nullsafe)
    w = Window.partitionBy(*K, "_blk").orderBy(*O)
    x = b.withColumn("_li", F.row_number().over(w) - 1)
    if group_size:
        x = x.withColumn("_gsz", F.count(F.lit(1)).over(Window.partitionBy(*K, "_blk")))
    if not heavy:
        out = x.withColumn(name, F.col("_li").cast("bigint"))
        out = out.withColumn(group_size, F.col("_gsz")) if group_size else out
        return out.drop("_blk", "_heavy", "_li", "_gsz", *extra)
    summ = b.where("_heavy").groupBy(*K, "_blk").agg(F.count(F.lit(1)).alias("_cnt"))
    ws = Window.partitionBy(*K).orderBy("_blk")
    summ = summ.withColumn(
        "_off", F.coalesce(F.sum("_cnt").over(ws.rowsBetween(_UNB_P, -1)), F.lit(0)))
    if group_size:
        summ = summ.withColumn("_gall", F.sum("_cnt").over(Window.partitionBy(*K)))
    summ = summ.drop("_cnt")
    out = _join_summary(x, summ, K, nullsafe)
    if group_size:
        out = out.withColumn(group_size, F.coalesce("_gall", "_gsz"))
    return out.withColumn(name, (F.coalesce("_off", F.lit(0)) + F.col("_li")).cast("bigint")) \
              .drop("_blk", "_heavy", "_li", "_off", "_gsz", "_gall", *extra)


def interpolate_linear(df: DataFrame, cols: Sequence[str], order_by, partition_by=None,
                       n_blocks: int | None = None, heavy_rows: int | None = None) -> DataFrame:
    """Linear interpolation of nulls along a row order, positions equally spaced.

    Interior gaps are filled on the straight line between the neighbouring
    non-null values; nulls after the last value repeat it; nulls before the
    first value stay null.  NaN counts as null.  Filled columns become double.
    Non-null values are returned unchanged.  Groups above ``heavy_rows`` rows
    are cut into blocks; the others are filled by one window each.
    """
    O, P = _cols(order_by), _cols(partition_by)
    cols = list(cols)
    src, K, extra, nullsafe = _keyed(df, P)
    b, heavy = _group_blocks(src, O, K, n_blocks, heavy_rows, nullsafe)
    w = Window.partitionBy(*K, "_blk").orderBy(*O)
    wp = w.rowsBetween(_UNB_P, _CUR)
    # "next non-null" is a running last() over the reversed order: a growing
    # frame evaluated in one pass (a frame ending at UNBOUNDED FOLLOWING is
    # re-aggregated for every row).  Same partitioning, so only a re-sort.
    wn = Window.partitionBy(*K, "_blk").orderBy(*[_reverse(o) for o in O]).rowsBetween(_UNB_P, _CUR)
    x = b.withColumn("_li", F.row_number().over(w) - 1)
    vals = {}
    for i, c in enumerate(cols):
        d = F.col(c).cast("double")
        vals[f"_v{i}"] = F.when(~F.isnan(d), d)
    x = x.withColumns(vals)
    win = {}
    for i in range(len(cols)):
        v = F.col(f"_v{i}")
        anchor = F.when(v.isNotNull(), F.col("_li"))
        win[f"_pi{i}"] = F.last(anchor, True).over(wp)
        win[f"_pv{i}"] = F.last(v, True).over(wp)
        win[f"_ni{i}"] = F.last(anchor, True).over(wn)
        win[f"_nv{i}"] = F.last(v, True).over(wn)
    x = x.withColumns(win)

    # per block: row count, last anchor (from the block's last row), first
    # anchor (from its first row)
    aggs = [F.count(F.lit(1)).alias("_cnt")]
    for i in range(len(cols)):
        aggs += [F.max_by(f"_pi{i}", "_li").alias(f"_lpi{i}"),
                 F.max_by(f"_pv{i}", "_li").alias(f"_lpv{i}"),
                 F.min_by(f"_ni{i}", "_li").alias(f"_fni{i}"),
                 F.min_by(f"_nv{i}", "_li").alias(f"_fnv{i}")]
    s = x.where("_heavy").groupBy(*K, "_blk").agg(*aggs)
    ws = Window.partitionBy(*K).orderBy("_blk")
    s = s.withColumn("_off", F.coalesce(F.sum("_cnt").over(ws.rowsBetween(_UNB_P, -1)),
                                        F.lit(0)))
    glob = {}
    for i in range(len(cols)):
        glob[f"_lp{i}"] = F.col("_off") + F.col(f"_lpi{i}")
        glob[f"_fn{i}"] = F.col("_off") + F.col(f"_fni{i}")
    s = s.withColumns(glob)
    before, after = ws.rowsBetween(_UNB_P, -1), ws.rowsBetween(1, _UNB_F)
    carry = {}
    for i in range(len(cols)):
        carry[f"_cpp{i}"] = F.last(f"_lp{i}", True).over(before)
        carry[f"_cpv{i}"] = F.last(f"_lpv{i}", True).over(before)
        carry[f"_cnp{i}"] = F.first(f"_fn{i}", True).over(after)
        carry[f"_cnv{i}"] = F.first(f"_fnv{i}", True).over(after)
    s = s.withColumns(carry).select(
        *K, "_blk", "_off", *[f"_c{k}{i}" for i in range(len(cols)) for k in ("pp", "pv", "np", "nv")])

    if heavy:
        y = _join_summary(x, s, K, nullsafe).withColumn("_off", F.coalesce("_off", F.lit(0)))
    else:
        none = F.lit(None).cast("double")
        y = x.withColumns({"_off": F.lit(0), **{f"_c{k}{i}": none for i in range(len(cols)) for k in ("pp", "pv", "np", "nv")}})
    pos = (F.col("_off") + F.col("_li")).cast("double")
    out = {}
    for i, c in enumerate(cols):
        v = F.col(f"_v{i}")
        local_p = F.col(f"_pi{i}").isNotNull()
        local_n = F.col(f"_ni{i}").isNotNull()
        pp = F.when(local_p, F.col("_off") + F.col(f"_pi{i}")).otherwise(F.col(f"_cpp{i}")).cast("double")
        pv = F.when(local_p, F.col(f"_pv{i}")).otherwise(F.col(f"_cpv{i}"))
        np_ = F.when(local_n, F.col("_off") + F.col(f"_ni{i}")).otherwise(F.col(f"_cnp{i}")).cast("double")
        nv = F.when(local_n, F.col(f"_nv{i}")).otherwise(F.col(f"_cnv{i}"))
        slope = (nv - pv) / (np_ - pp)
        out[c] = (F.when(v.isNotNull(), v)
                   .when(pp.isNull(), F.lit(None).cast("double"))
                   .when(np_.isNull(), pv)
                   .otherwise(slope * (pos - pp) + pv))
    y = y.withColumns(out)
    keep = [c for c in df.columns]
    return y.select(*keep)


def _pname(p: float) -> str:
    s = f"{p * 100:.6f}".rstrip("0").rstrip(".")
    return "p" + s.replace(".", "_")


# `auto` uses Spark's exact `percentile` only up to this many distinct values of
# a group: one task merges the value maps of a group.
EXACT_MAP_MAX_ENTRIES = 200_000

# Largest number of (group, bucket) rows the `select` method broadcasts when
# picking the rows of the buckets it must rank.
SELECT_BROADCAST_ROWS = 200_000


def _weights(lo_v: Column, hi_v: Column, h: Column) -> Column:
    # weights form, as Spark's `percentile` and SQL engines compute it
    return F.when(F.floor(h) == F.ceil(h), lo_v).otherwise(
        (F.ceil(h) - h) * lo_v + (h - F.floor(h)) * hi_v)


def _select_quantiles(v: DataFrame, G: list, probs: Sequence[float], names: Sequence[str],
                      n_blocks: int | None = None) -> DataFrame | None:
    """Exact quantiles by selection: rank only the buckets holding the answer.

    1. Cut the value axis into about ``n_blocks`` buckets at approximate
       quantile bounds (b - 1 numbers; repeated bounds are merged, so a value
       holding a third of the rows is one bucket).
    2. Count rows per (group, bucket): one partial aggregate.  A running sum
       over the buckets gives each bucket's first position in its group, so
       the buckets holding the order statistics ``floor/ceil((n-1)p)`` are
       known: at most two per probability and group.
    3. Only rows of those buckets are read on; they are reduced to
       (value, count) per bucket (ties collapse map-side) and ranked by a
       running sum of counts inside each bucket.

    No step sorts the whole column and no task holds more than one bucket's
    distinct values.  Returns None when group keys have no non-null stand-in
    (the caller then uses the ``rank`` plan).
    """
    src, K, extra, nullsafe = _keyed(v, G)
    if nullsafe:
        return None
    n = n_blocks or shuffle_partitions(v.sparkSession)
    bounds = _bounds(v.select(F.col("_x").alias("_k")), max(n, 2)) if n > 1 else []
    cuts = sorted({float(b) for b in bounds if b is not None and math.isfinite(b)})
    if cuts:
        from pyspark.ml.feature import Bucketizer
        bz = Bucketizer(splits=[float("-inf"), *cuts, float("inf")], inputCol="_x",
                        outputCol="_bd", handleInvalid="keep")
        vb = bz.transform(src).withColumn("_b", F.col("_bd").cast("int")).drop("_bd")
    else:
        vb = src.withColumn("_b", F.lit(0))
    cnt = vb.groupBy(*K, "_b").agg(F.count(F.lit(1)).alias("_c"))
    wg = Window.partitionBy(*K)
    cnt = cnt.withColumns({
        "_n": F.sum("_c").over(wg),
        "_s": F.coalesce(F.sum("_c").over(wg.orderBy("_b").rowsBetween(_UNB_P, -1)), F.lit(0))})
    n1 = (F.col("_n") - 1).cast("double")
    need = F.lit(False)
    for p in probs:
        h = n1 * F.lit(float(p))
        for t in (F.floor(h), F.ceil(h)):
            need = need | ((F.col("_s") <= t) & (t < F.col("_s") + F.col("_c")))
    need_rows = cnt.where(need).select(*K, "_b", "_s", "_n")
    if K:
        # at most 2 x len(probs) rows per group: cut lineage, then the count
        # decides between a broadcast and a shuffle join
        need_rows = materialize(need_rows)
        picked = join_bounded(vb, need_rows, [*K, "_b"], "inner", SELECT_BROADCAST_ROWS)
    else:
        # at most 2 x len(probs) rows by construction
        picked = vb.join(F.broadcast(need_rows), "_b", "inner")
    G_names = _names(G)
    d = picked.groupBy(*K, *G_names, "_b", "_s", "_n", "_x").agg(F.count(F.lit(1)).alias("_c"))
    wb = Window.partitionBy(*K, "_b").orderBy("_x").rowsBetween(_UNB_P, _CUR)
    d = d.withColumn("_e", F.col("_s") + F.sum("_c").over(wb) - 1)   # last position of _x
    first = F.col("_e") - F.col("_c") + 1
    aggs = []
    for i, p in enumerate(probs):
        h = n1 * F.lit(float(p))
        lo, hi = F.floor(h), F.ceil(h)
        aggs += [F.max(F.when((first <= lo) & (lo <= F.col("_e")), F.col("_x"))).alias(f"_lo{i}"),
                 F.max(F.when((first <= hi) & (hi <= F.col("_e")), F.col("_x"))).alias(f"_hi{i}"),
                 F.max(h).alias(f"_h{i}")]
    a = d.groupBy(*K, *G_names).agg(*aggs)
    return a.select(*G_names, *[_weights(F.col(f"_lo{i}"), F.col(f"_hi{i}"), F.col(f"_h{i}")).alias(nm)
                                for i, nm in enumerate(names)])


def quantile_method(distinct: int | None) -> str:
    """What ``auto`` means for a column with this estimated largest distinct count."""
    return "percentile" if (distinct or 0) * 1.1 <= EXACT_MAP_MAX_ENTRIES else "select"


def quantiles(df: DataFrame, c, probs: Sequence[float], group=None,
              method: str = "auto", names: Sequence[str] | None = None,
              accuracy: int = 10000) -> DataFrame:
    """Quantiles with linear interpolation between order statistics.

    One row per group, one column per probability (named ``p25`` etc. unless
    ``names`` is given).  Nulls and NaN are skipped.

    method:
      ``auto``        (default) one HyperLogLog pass measures the largest
                      per-group distinct count D.  While D stays under
                      EXACT_MAP_MAX_ENTRIES (with a margin for the
                      estimate) ``percentile`` is used: one aggregate, the
                      fastest plan for small inputs.  Otherwise ``select``.
      ``select``      exact; counts rows per value bucket, then ranks only the
                      buckets that hold the wanted order statistics.  No full
                      sort; memory per task bounded by one bucket's distinct
                      values (``rank`` for group keys of a type without a
                      non-null stand-in).
      ``rank``        exact; sorts all values in range blocks and picks the two
                      order statistics around ``(n-1)*p``.
      ``percentile``  Spark's exact ``percentile`` aggregate; its final merge keeps
                      every distinct value of a group in one task, so use it only
                      for columns of bounded cardinality.
      ``approx``      ``percentile_approx`` (rank error about n/accuracy).
    All exact methods give identical values.
    """
    G = _cols(group)
    names = list(names or [_pname(p) for p in probs])
    x = F.col(c) if isinstance(c, str) else c
    v = df.select(*G, x.cast("double").alias("_x")).where(
        F.col("_x").isNotNull() & ~F.isnan("_x"))
    if method == "auto":
        mx = (v.groupBy(*G).agg(F.approx_count_distinct("_x", 0.02).alias("_d"))
               .agg(F.max("_d")).first()[0])
        method = quantile_method(mx)
    if method == "select":
        out = _select_quantiles(v, G, probs, names)
        if out is not None:
            return out
        method = "rank"
    if method == "percentile":
        a = v.groupBy(*G).agg(F.percentile("_x", list(probs)).alias("_q"))
        return a.select(*G, *[F.col("_q")[i].alias(n) for i, n in enumerate(names)])
    if method == "approx":
        a = v.groupBy(*G).agg(F.percentile_approx("_x", list(probs), accuracy).alias("_q"))
        return a.select(*G, *[F.col("_q")[i].cast("double").alias(n) for i, n in enumerate(names)])
    if method != "rank":
        raise ValueError(f"unknown method {method!r}")
    r = with_row_id(v, ["_x"], G, name="_pos", group_size="_n")
    n1 = (F.col("_n") - 1).cast("double")
    keep = F.lit(False)
    aggs = []
    for i, p in enumerate(probs):
        h = n1 * F.lit(float(p))
        lo, hi = F.floor(h), F.ceil(h)
        keep = keep | (F.col("_pos") == lo) | (F.col("_pos") == hi)
        aggs += [F.max(F.when(F.col("_pos") == lo, F.col("_x"))).alias(f"_lo{i}"),
                 F.max(F.when(F.col("_pos") == hi, F.col("_x"))).alias(f"_hi{i}"),
                 F.max(h).alias(f"_h{i}")]
    a = r.where(keep).groupBy(*G).agg(*aggs)
    return a.select(*G, *[_weights(F.col(f"_lo{i}"), F.col(f"_hi{i}"), F.col(f"_h{i}")).alias(n)
                          for i, n in enumerate(names)])


def quantile_values(df: DataFrame, c, probs: Sequence[float], method: str = "auto") -> list[float]:
    """Ungrouped quantiles collected to the driver (one row, len(probs) values)."""
    row = quantiles(df, c, probs, None, method, names=[f"q{i}" for i in range(len(probs))]).collect()
    if not row:
        return [None] * len(probs)
    return [row[0][f"q{i}"] for i in range(len(probs))]
