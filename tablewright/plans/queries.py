"""Driver queries: one per operator of the inventory, each with its SQL oracle.

Every query reads the given tables (whole, no row subsets) and returns a
DataFrame whose column names match its oracle.  Queries without an oracle
(seeded hashing, forests) are checked on row counts only; their exact
behaviour is covered by the repository tests.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.functions import scalar as S
from tablewright.operators import align, clean, distribution, encode, evaluate, ordered, profile, split
from tablewright.plans import standins as T
from tablewright.session import attach_row, checkpoint_dir, delete_at_exit
from tablewright.sources import ordered_sink
from tablewright.sources import tables as io

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn
    return deco


def r4(c):
    return S.round_half_even(c, 4)


# ---- SQL fragments shared by the oracles ---------------------------------
TRAIN = "o_orderdate < TIMESTAMP '2000-07-01'"
YM = "CAST(year(o_orderdate) * 100 + month(o_orderdate) AS INTEGER)"
PRIO_NULLED = "CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN o_orderpriority END"


def season_sql(m: str) -> str:
    return (f"CASE WHEN {m} IN (12, 1, 2) THEN 'winter' WHEN {m} IN (3, 4, 5) THEN 'spring' "
            f"WHEN {m} IN (6, 7, 8) THEN 'summer' ELSE 'autumn' END")


# ==== minimum slice / flagship: tag-union → bound trim → month → season ===

def season_mean_df(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = T.orders_tagged(spark, sf_dir)
    t = clean.trim_outliers_bound(t, "o_totalprice", 450000.0, only="is_test = 0")
    t = S.split_yyyymm(T.with_ym(t), "ym")
    t = t.withColumn("season", S.season("cont_month"))
    return t.groupBy("is_test", "season").agg(F.count(F.lit(1)).alias("n"),
                                              r4(F.avg("o_totalprice")).alias("mean_price"))


query("season_mean", f"""
WITH t AS (
  SELECT o_totalprice, 0 AS is_test, o_orderdate FROM orders WHERE {TRAIN}
  UNION ALL
  SELECT NULL, 1, o_orderdate FROM orders WHERE NOT ({TRAIN})),
k AS (SELECT * FROM t WHERE is_test <> 0 OR coalesce(o_totalprice < 450000.0, false)),
m AS (SELECT *, CAST(substr(CAST({YM} AS VARCHAR), 5, 2) AS INTEGER) AS cont_month FROM k)
SELECT is_test, {season_sql('cont_month')} AS season, count(*) AS n,
       round_even(avg(o_totalprice), 4) AS mean_price
FROM m GROUP BY 1, 2
""")(season_mean_df)


# ==== profiling (O06–O18) =================================================

@query("shape_orders", "SELECT count(*) AS rows, 6 AS columns FROM orders")
def _shape(spark, d):
    return profile.shape(T.table(spark, d, "orders"))


@query("column_info_orders", " UNION ALL ".join(
    f"SELECT '{c}' AS column, {i} AS position, '{t}' AS dtype, count({e}) AS non_null FROM orders"
    for i, (c, t, e) in enumerate([
        ("o_orderkey", "bigint", "o_orderkey"), ("o_custkey", "bigint", "o_custkey"),
        ("o_orderstatus", "string", "o_orderstatus"),
        ("o_totalprice", "double", "o_totalprice"),
        ("o_orderdate", "timestamp_ntz", "o_orderdate"),
        ("o_orderpriority", "string", PRIO_NULLED)])))
def _column_info(spark, d):
    return profile.column_info(T.orders_nulled(spark, d))


_ORDER_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
               "o_orderpriority"]
_NULL_REPORT_SQL = " UNION ALL ".join(
    f"SELECT '{c}' AS column, count(*) - count({PRIO_NULLED if c == 'o_orderpriority' else c}) AS nulls, "
    f"count({PRIO_NULLED if c == 'o_orderpriority' else c}) AS non_null, count(*) AS total FROM orders"
    for c in _ORDER_COLS)


@query("null_report_orders", _NULL_REPORT_SQL)
def _null_report(spark, d):
    return profile.null_report(T.orders_nulled(spark, d))


@query("null_ratio_orders", f"""
SELECT "column", nulls, round_even(CAST(nulls AS DOUBLE) / total, 6) AS null_ratio
FROM ({_NULL_REPORT_SQL}) r WHERE nulls > 0
""")
def _null_ratio(spark, d):
    r = profile.null_ratio(T.orders_nulled(spark, d))
    return r.select("column", "nulls", S.round_half_even("null_ratio", 6).alias("null_ratio"))


@query("column_kinds_orders", """
SELECT column_name AS column,
       CASE WHEN column_type IN ('BIGINT', 'INTEGER', 'DOUBLE', 'FLOAT', 'SMALLINT', 'TINYINT')
                 OR column_type LIKE 'DECIMAL%' THEN 'continuous' ELSE 'categorical' END AS kind, non_null
FROM (DESCRIBE orders) JOIN (""" + " UNION ALL ".join(
    f"SELECT '{c}' AS c, count({c}) AS non_null FROM orders" for c in (
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")) + """)
ON c = column_name
""")
def _kinds(spark, d):
    o = T.table(spark, d, "orders")
    return profile.column_kinds(o).join(profile.column_info(o).select("column", "non_null"), "column")


@query("value_counts_priority", f"""
SELECT o_orderpriority, count(*) AS count
FROM (SELECT {PRIO_NULLED} AS o_orderpriority FROM orders) t
WHERE o_orderpriority IS NOT NULL GROUP BY 1
""")
def _value_counts(spark, d):
    o = clean.sentinels_to_null(T.table(spark, d, "orders"), {"o_orderpriority": [T.SENTINEL]})
    return profile.value_counts(o, "o_orderpriority")


@query("distinct_size", f"""
SELECT 'o_orderpriority' AS column,
       CAST(count(DISTINCT p) + max(CAST(p IS NULL AS INTEGER)) AS BIGINT) AS n_distinct
FROM (SELECT {PRIO_NULLED} AS p FROM orders) t
UNION ALL
SELECT 'o_orderstatus', CAST(count(DISTINCT o_orderstatus) + max(CAST(o_orderstatus IS NULL AS INTEGER)) AS BIGINT)
FROM orders
""")
def _distinct_size(spark, d):
    return profile.distinct_size(T.orders_nulled(spark, d), ["o_orderpriority", "o_orderstatus"])


@query("rare_values", """
SELECT p_name, count(*) AS count FROM part WHERE p_name IS NOT NULL
GROUP BY 1 HAVING count(*) < 30
""")
def _rare(spark, d):
    return profile.rare_values(T.table(spark, d, "part"), "p_name", 30)


@query("keep_by_frequency", """
SELECT p_partkey, p_name FROM part
WHERE p_name IN (SELECT p_name FROM part WHERE p_name IS NOT NULL GROUP BY 1
                 HAVING count(*) >= 30 AND count(*) <= 35)
""")
def _keep_freq(spark, d):
    p = T.table(spark, d, "part")
    return profile.keep_by_frequency(p, "p_name", 30, 35).select("p_partkey", "p_name")


@query("ambiguous_names", """
SELECT p_name, count(DISTINCT p_brand) AS n_distinct FROM part WHERE p_name IS NOT NULL
GROUP BY 1 HAVING count(DISTINCT p_brand) >= 21
""")
def _ambiguous(spark, d):
    return profile.ambiguous_keys(T.table(spark, d, "part"), "p_name", "p_brand", 21)


_DESCRIBE_P = [0.1, 0.25, 0.5, 0.75, 0.8, 0.9]
_DESC_NAMES = ["p10", "p25", "p50", "p75", "p80", "p90"]


@query("describe_price", "SELECT count(*) AS count, round_even(avg(o_totalprice), 4) AS mean, "
       "round_even(stddev_samp(o_totalprice), 4) AS std, round_even(min(o_totalprice), 4) AS min, "
       + ", ".join(f"round_even(quantile_cont(o_totalprice, {p}), 4) AS {n}"
                   for p, n in zip(_DESCRIBE_P, _DESC_NAMES))
       + ", round_even(max(o_totalprice), 4) AS max FROM orders")
def _describe(spark, d):
    r = profile.describe(T.table(spark, d, "orders"), "o_totalprice", _DESCRIBE_P)
    return r.select("count", *[r4(c).alias(c) for c in ["mean", "std", "min", *_DESC_NAMES, "max"]])


@query("describe_int", "SELECT CAST(count(*) AS BIGINT) AS count, "
       "CAST(trunc(avg(l_extendedprice)) AS BIGINT) AS mean, "
       "CAST(trunc(stddev_samp(l_extendedprice)) AS BIGINT) AS std, "
       "CAST(trunc(min(l_extendedprice)) AS BIGINT) AS min, "
       + ", ".join(f"CAST(trunc(quantile_cont(l_extendedprice, {p})) AS BIGINT) AS {n}"
                   for p, n in zip([0.25, 0.5, 0.75], ["p25", "p50", "p75"]))
       + ", CAST(trunc(max(l_extendedprice)) AS BIGINT) AS max FROM lineitem")
def _describe_int(spark, d):
    return profile.describe(T.table(spark, d, "lineitem"), "l_extendedprice", as_int=True)


_MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("describe_columns", " UNION ALL ".join(f"""
SELECT l_returnflag, '{c}' AS "column", count(*) AS count, round_even(avg({c}), 6) AS mean, round_even(stddev_samp({c}), 6) AS std,
       CAST(min({c}) AS DOUBLE) AS min, round_even(quantile_cont(CAST({c} AS DOUBLE), 0.25), 6) AS p25,
       round_even(quantile_cont(CAST({c} AS DOUBLE), 0.9), 6) AS p90, CAST(max({c}) AS DOUBLE) AS max
FROM lineitem GROUP BY l_returnflag""" for c in _MEASURES))
def _describe_columns(spark, d):
    """O15 of several columns and groups at once, quantiles by selection."""
    r = profile.describe_columns(T.table(spark, d, "lineitem"), _MEASURES, [0.25, 0.9], group="l_returnflag", method="select")
    six = lambda c: S.round_half_even(c, 6).alias(c)
    return r.select("l_returnflag", "column", "count", six("mean"), six("std"), "min", six("p25"), six("p90"), "max")


@query("describe_by_segment", "SELECT c_mktsegment, count(*) AS count, "
       "round_even(avg(c_acctbal), 4) AS mean, round_even(stddev_samp(c_acctbal), 4) AS std, "
       "round_even(min(c_acctbal), 4) AS min, "
       + ", ".join(f"round_even(quantile_cont(c_acctbal, {p}), 4) AS {n}"
                   for p, n in zip([0.25, 0.5, 0.75], ["p25", "p50", "p75"]))
       + ", round_even(max(c_acctbal), 4) AS max FROM customer GROUP BY 1")
def _describe_group(spark, d):
    r = profile.describe(T.table(spark, d, "customer"), "c_acctbal", group="c_mktsegment")
    return r.select("c_mktsegment", "count",
                    *[r4(c).alias(c) for c in ["mean", "std", "min", "p25", "p50", "p75", "max"]])


@query("quantiles_select", "SELECT l_returnflag, l_linestatus, "
       + ", ".join(f"round_even(quantile_cont(l_extendedprice, {p}), 4) AS {n}"
                   for p, n in zip(_DESCRIBE_P, _DESC_NAMES))
       + " FROM lineitem GROUP BY 1, 2")
def _quantiles_select(spark, d):
    # the selection plan that `auto` picks for high-cardinality columns at scale
    li = T.table(spark, d, "lineitem")
    q = ordered.quantiles(li, "l_extendedprice", _DESCRIBE_P, ["l_returnflag", "l_linestatus"],
                          method="select", names=_DESC_NAMES)
    return q.select("l_returnflag", "l_linestatus", *[r4(c).alias(c) for c in _DESC_NAMES])


@query("compare_means", """
SELECT 'customer' AS "table", round_even(avg(c_acctbal), 4) AS mean, count(c_acctbal) AS count FROM customer
UNION ALL
SELECT 'supplier', round_even(avg(s_acctbal), 4), count(s_acctbal) FROM supplier
""")
def _compare_means(spark, d):
    r = profile.compare_means({"customer": T.table(spark, d, "customer"),
                               "supplier": T.table(spark, d, "supplier")},
                              {"customer": "c_acctbal", "supplier": "s_acctbal"})
    return r.select("table", r4("mean").alias("mean"), "count")


@query("count_where", """
SELECT count(*) FILTER (WHERE o_orderpriority = '4-NOT SPECIFIED') AS n_sentinel,
       count(*) FILTER (WHERE o_totalprice > 400000) AS n_high,
       count(*) FILTER (WHERE trim(o_orderstatus) = '') AS n_blank,
       count(*) AS n_total
FROM orders
""")
def _count_where(spark, d):
    return profile.count_where(T.table(spark, d, "orders"), {
        "n_sentinel": F.col("o_orderpriority") == T.SENTINEL,
        "n_high": "o_totalprice > 400000",
        "n_blank": F.trim("o_orderstatus") == "",
        "n_total": F.lit(True)})


@query("head_orders", """
SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20
""")
def _head(spark, d):
    o = T.table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    return profile.head(o, 20, [F.col("o_totalprice").desc(), "o_orderkey"])


# ==== cleaning, projection, predicates (O19–O32) ===========================

_BLANKS = "CASE WHEN p_size <= 5 THEN '   ' WHEN p_size <= 8 THEN '' ELSE p_type END"


@query("blank_to_null", f"""
SELECT p_partkey, CASE WHEN regexp_matches(t, '^\\s*$') THEN NULL ELSE t END AS t
FROM (SELECT p_partkey, {_BLANKS} AS t FROM part) x
""")
def _blank(spark, d):
    p = T.table(spark, d, "part").select("p_partkey", F.expr(_BLANKS).alias("t"))
    return clean.blank_to_null(p, ["t"])


@query("fill_constant", f"""
SELECT o_orderkey, coalesce({PRIO_NULLED}, 'NULL') AS o_orderpriority FROM orders
""")
def _fill(spark, d):
    o = T.orders_nulled(spark, d).select("o_orderkey", "o_orderpriority")
    return clean.fill_constant(o, ["o_orderpriority"], "NULL")


_SPARSE_FRAME = (f"SELECT o_orderkey, {PRIO_NULLED} AS prio, "
                 "CASE WHEN month(o_orderdate) = 1 THEN NULL ELSE o_orderstatus END AS status, "
                 "o_totalprice FROM orders")


@query("drop_sparse", f"""
WITH f AS ({_SPARSE_FRAME}),
r AS (
  SELECT 'o_orderkey' AS column, count(*) - count(o_orderkey) AS nulls, count(*) AS total FROM f
  UNION ALL SELECT 'prio', count(*) - count(prio), count(*) FROM f
  UNION ALL SELECT 'status', count(*) - count(status), count(*) FROM f
  UNION ALL SELECT 'o_totalprice', count(*) - count(o_totalprice), count(*) FROM f)
SELECT "column", nulls FROM r WHERE CAST(nulls AS DOUBLE) / total <= 0.15
""")
def _drop_sparse(spark, d):
    f = T.table(spark, d, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderpriority") != T.SENTINEL, F.col("o_orderpriority")).alias("prio"),
        F.when(F.month("o_orderdate") != 1, F.col("o_orderstatus")).alias("status"),
        "o_totalprice")
    kept = clean.drop_sparse_columns(f, max_ratio=0.15)
    return profile.null_report(kept).select("column", "nulls")


@query("cast_columns", """
SELECT l_orderkey, CAST(l_quantity AS VARCHAR) AS l_quantity, CAST(l_linenumber AS VARCHAR) AS l_linenumber,
       CAST(trunc(l_extendedprice) AS BIGINT) AS l_extendedprice
FROM lineitem
""")
def _cast(spark, d):
    li = T.table(spark, d, "lineitem").select("l_orderkey", "l_quantity", "l_linenumber",
                                              "l_extendedprice")
    return clean.cast_columns(li, {"l_quantity": "string", "l_linenumber": "string",
                                   "l_extendedprice": "bigint"})


@query("rename_project_drop", """
SELECT o_orderkey AS order_id, o_totalprice AS price FROM orders
""")
def _rename(spark, d):
    o = clean.project(T.table(spark, d, "orders"), ["o_orderkey", "o_totalprice", "o_orderstatus"])
    o = clean.rename(o, {"o_orderkey": "order_id", "o_totalprice": "price"})
    return clean.drop(o, ["o_orderstatus", "no_such_column"])


@query("where_expr", """
SELECT o_orderkey FROM orders WHERE o_totalprice > 300000 AND o_orderstatus = 'O'
""")
def _where(spark, d):
    o = clean.where(T.table(spark, d, "orders"), "o_totalprice > 300000 AND o_orderstatus = 'O'")
    return o.select("o_orderkey")


@query("where_in", f"""
SELECT 'in' AS part, p AS o_orderpriority, count(*) AS n FROM (SELECT {PRIO_NULLED} AS p FROM orders) t
WHERE p IN ('1-URGENT', '2-HIGH') GROUP BY 1, 2
UNION ALL
SELECT 'not_in', p, count(*) FROM (SELECT {PRIO_NULLED} AS p FROM orders) t
WHERE NOT coalesce(p IN ('1-URGENT', '2-HIGH'), false) GROUP BY 1, 2
""")
def _where_in(spark, d):
    o = T.orders_nulled(spark, d)
    vals = ["1-URGENT", "2-HIGH"]
    a = clean.where_in(o, "o_orderpriority", vals).withColumn("part", F.lit("in"))
    b = clean.where_in(o, "o_orderpriority", vals, negate=True).withColumn("part", F.lit("not_in"))
    return a.unionByName(b).groupBy("part", "o_orderpriority").agg(F.count(F.lit(1)).alias("n"))


@query("trim_iqr_events", """
WITH t AS (SELECT event_id, value,
                  CASE WHEN ts < TIMESTAMP '2024-01-25' THEN 0 ELSE 1 END AS is_test FROM events),
q AS (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3
      FROM t WHERE is_test = 0 AND value IS NOT NULL),
b AS (SELECT q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM q)
SELECT event_id, is_test, value FROM t, b
WHERE is_test <> 0 OR (value >= lo AND value <= hi)
""")
def _trim_iqr(spark, d):
    e = T.events_tagged(spark, d)
    return clean.trim_outliers_iqr(e, "value", 1.5, "is_test = 0").select(
        "event_id", "is_test", "value")


@query("trim_bound", """
SELECT l_orderkey, l_linenumber, l_quantity, is_test FROM (
  SELECT *, CASE WHEN l_shipdate < TIMESTAMP '2001-01-01' THEN 0 ELSE 1 END AS is_test FROM lineitem) t
WHERE is_test <> 0 OR coalesce(l_quantity < 45, false)
""")
def _trim_bound(spark, d):
    li = T.lineitem_tagged(spark, d)
    return clean.trim_outliers_bound(li, "l_quantity", 45.0, "is_test = 0").select(
        "l_orderkey", "l_linenumber", "l_quantity", "is_test")


@query("trim_bound_counts", """
WITH t AS (SELECT *, CASE WHEN l_shipdate < TIMESTAMP '2001-01-01' THEN 0 ELSE 1 END AS is_test FROM lineitem)
SELECT count(*) AS rows,
       count(*) FILTER (WHERE l_quantity > 45) AS above_all,
       count(*) FILTER (WHERE l_quantity >= 45) AS at_or_above_all,
       count(*) FILTER (WHERE is_test = 0 AND l_quantity > 45) AS above_only,
       count(*) FILTER (WHERE is_test = 0 AND l_quantity >= 45) AS at_or_above_only,
       count(*) FILTER (WHERE is_test = 0 AND NOT coalesce(l_quantity < 45, false)) AS removed
FROM t
""")
def _bound_counts(spark, d):
    return clean.bound_counts(T.lineitem_tagged(spark, d), "l_quantity", 45.0, "is_test = 0")


@query("trim_ratio", """
SELECT l_orderkey, l_linenumber, is_test FROM (
  SELECT *, CASE WHEN l_shipdate < TIMESTAMP '2001-01-01' THEN 0 ELSE 1 END AS is_test FROM lineitem) t
WHERE is_test <> 0 OR coalesce(l_extendedprice / nullif(l_quantity, 0) < 5000, false)
""")
def _trim_ratio(spark, d):
    li = T.lineitem_tagged(spark, d)
    return clean.trim_outliers_ratio(li, "l_extendedprice", "l_quantity", 5000.0,
                                     "is_test = 0").select("l_orderkey", "l_linenumber", "is_test")


# ==== tagged union, split, conform (O33, O34, O34b) ========================

@query("tag_union", f"""
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority, 0 AS is_test
FROM orders WHERE {TRAIN}
UNION ALL
SELECT o_orderkey, o_custkey, o_orderstatus, NULL, o_orderdate, o_orderpriority, 1
FROM orders WHERE NOT ({TRAIN})
""")
def _tag_union(spark, d):
    return T.orders_tagged(spark, d)


@query("tag_union_mixed", f"""
SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, 0 AS is_test FROM orders WHERE {TRAIN}
UNION ALL SELECT o_orderkey, 'C' || o_custkey, 1 FROM orders WHERE NOT ({TRAIN})
""")
def _tag_union_mixed(spark, d):
    """O33 with a column that is a number in train and text in test."""
    o = T.table(spark, d, "orders")
    before = T.ts_before("o_orderdate", T.ORDERS_CUTOFF)
    return align.tag_union({0: o.where(before).select("o_orderkey", "o_custkey"),
                            1: o.where(~before).select("o_orderkey", F.concat(F.lit("C"), "o_custkey").alias("o_custkey"))})


@query("split_tagged", f"""
SELECT o_orderkey, o_custkey, o_orderstatus, CAST(0 AS DOUBLE) AS o_totalprice, o_orderdate, o_orderpriority
FROM orders WHERE NOT ({TRAIN})
""")
def _split_tagged(spark, d):
    train, test = align.split_tagged(T.orders_tagged(spark, d), "is_test", "o_totalprice",
                                     test_label=0)
    assert align.same_width(train, test)
    return test


@query("conform", f"""
SELECT o_orderkey, {", ".join(f"CASE WHEN year(o_orderdate) = {y} THEN 1 ELSE 0 END AS cont_year_{y}"
                               for y in range(1995, 2001))}
FROM orders WHERE NOT ({TRAIN})
""")
def _conform(spark, d):
    o = T.table(spark, d, "orders").withColumn("cont_year", F.year("o_orderdate"))
    train = o.where(T.ts_before("o_orderdate", T.ORDERS_CUTOFF))
    test = o.where(~T.ts_before("o_orderdate", T.ORDERS_CUTOFF))
    # each table encoded alone, then test is made to look like train
    tr = encode.one_hot(train.select("o_orderkey", "cont_year"), ["cont_year"])
    te = encode.one_hot(test.select("o_orderkey", "cont_year"), ["cont_year"])
    return align.conform_to(te, tr.columns, fill=0)


# ==== encoders (O35–O38) ===================================================

@query("label_encode", """
SELECT p_partkey,
       CAST(dense_rank() OVER (ORDER BY p_brand) - 1 AS BIGINT) AS p_brand,
       CAST(dense_rank() OVER (ORDER BY p_type) - 1 AS BIGINT) AS p_type,
       CAST(dense_rank() OVER (ORDER BY CAST(p_size AS VARCHAR)) - 1 AS BIGINT) AS p_size
FROM part
""")
def _label_encode(spark, d):
    p = T.table(spark, d, "part").select("p_partkey", "p_brand", "p_type", "p_size")
    m = encode.label_fit(p, ["p_brand", "p_type", "p_size"])
    return encode.label_transform(p, m, ["p_brand", "p_type", "p_size"])


@query("label_encode_distributed", """
SELECT o_orderkey, CAST(dense_rank() OVER (ORDER BY o_custkey) - 1 AS BIGINT) AS o_custkey,
       CAST(dense_rank() OVER (ORDER BY o_orderpriority) - 1 AS BIGINT) AS o_orderpriority
FROM orders
""")
def _label_encode_distributed(spark, d):
    # a large vocabulary, each column ranked in the order of its own type
    o = T.table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    m = encode.label_fit(o, ["o_custkey", "o_orderpriority"], as_text=False)
    return encode.label_transform(o, m, ["o_custkey", "o_orderpriority"])


_YMTXT = f"CAST({YM} AS VARCHAR)"


@query("label_extend", f"""
WITH tr AS (SELECT DISTINCT {_YMTXT} AS value FROM orders WHERE {TRAIN}),
te AS (SELECT DISTINCT {_YMTXT} AS value FROM orders WHERE NOT ({TRAIN})),
n AS (SELECT count(*) AS k FROM tr)
SELECT 'ym' AS column, value, CAST(row_number() OVER (ORDER BY value) - 1 AS BIGINT) AS code FROM tr
UNION ALL
SELECT 'ym', value, CAST((SELECT k FROM n) + row_number() OVER (ORDER BY value) - 1 AS BIGINT)
FROM te WHERE value NOT IN (SELECT value FROM tr)
""")
def _label_extend(spark, d):
    o = T.with_ym(T.table(spark, d, "orders")).withColumn("ym", F.col("ym").cast("string"))
    train = o.where(T.ts_before("o_orderdate", T.ORDERS_CUTOFF))
    test = o.where(~T.ts_before("o_orderdate", T.ORDERS_CUTOFF))
    m = encode.label_fit(train, ["ym"])
    return encode.label_extend(m, test, ["ym"]).select("column", "value", "code")


@query("label_roundtrip", "SELECT p_partkey, p_brand, p_type FROM part")
def _label_roundtrip(spark, d):
    p = T.table(spark, d, "part").select("p_partkey", "p_brand", "p_type")
    m = encode.label_fit(p, ["p_brand", "p_type"])
    coded = encode.label_transform(p, m, ["p_brand", "p_type"])
    return encode.label_inverse(coded, m, ["p_brand", "p_type"])


_SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


@query("one_hot", "SELECT c_custkey, " + ", ".join(
    f"CASE WHEN c_mktsegment = '{s}' THEN 1 ELSE 0 END AS c_mktsegment_{s}" for s in _SEGMENTS)
    + " FROM customer")
def _one_hot(spark, d):
    c = T.table(spark, d, "customer").select("c_custkey", "c_mktsegment")
    return encode.one_hot(c, ["c_mktsegment"])


@query("one_hot_drop_first", "SELECT o_orderkey, " + ", ".join(
    f"CASE WHEN {season_sql('month(o_orderdate)')} = '{s}' THEN 1 ELSE 0 END AS season_{s}"
    for s in ["spring", "summer", "winter"]) + " FROM orders")
def _one_hot_drop(spark, d):
    o = T.table(spark, d, "orders").select("o_orderkey",
                                           S.season(F.month("o_orderdate")).alias("season"))
    return encode.one_hot(o, ["season"], drop_first=True)


# ==== scalar features (O39–O49) ===========================================

@query("split_token", """
SELECT p_partkey, string_split(trim(p_name), ' ')[1] AS tok0, string_split(trim(p_name), ' ')[2] AS tok1,
       string_split(trim(p_name), ' ')[3] AS tok2
FROM part
""")
def _split_token(spark, d):
    p = T.table(spark, d, "part")
    return p.select("p_partkey", *[S.split_token("p_name", i).alias(f"tok{i}") for i in range(3)])


@query("split_yyyymm", f"""
SELECT o_orderkey, CAST(substr(CAST({YM} AS VARCHAR), 1, 4) AS INTEGER) AS cont_year,
       CAST(substr(CAST({YM} AS VARCHAR), 5, 2) AS INTEGER) AS cont_month
FROM orders
""")
def _split_yyyymm(spark, d):
    o = T.with_ym(T.table(spark, d, "orders")).select("o_orderkey", "ym")
    return S.split_yyyymm(o, "ym")


_NATIONS7 = [0, 3, 5, 7, 11, 13, 17]


@query("in_set_flag", f"""
SELECT c_custkey, CASE WHEN c_nationkey IN ({", ".join(map(str, _NATIONS7))}) THEN 1 ELSE 0 END AS flag
FROM customer
""")
def _in_set(spark, d):
    c = T.table(spark, d, "customer")
    return c.select("c_custkey", S.in_set_flag("c_nationkey", _NATIONS7).alias("flag"))


_NATIONS_B = [n for n in range(25) if n not in _NATIONS7]


@query("in_set_partition_check", f"""
WITH d AS (SELECT DISTINCT c_nationkey FROM customer WHERE c_nationkey IS NOT NULL),
m AS (SELECT c_nationkey, CASE WHEN c_nationkey IN ({", ".join(map(str, _NATIONS7))}) THEN 1 ELSE 0 END AS a,
             CASE WHEN c_nationkey IN ({", ".join(map(str, _NATIONS_B))}) THEN 1 ELSE 0 END AS b FROM d)
SELECT count(*) AS n_distinct, CAST(sum(a) AS BIGINT) AS n_listed, CAST(sum(b) AS BIGINT) AS n_rest,
       count(*) FILTER (WHERE a + b > 1) AS n_overlap, count(*) FILTER (WHERE a + b = 0) AS n_uncovered
FROM m
""")
def _partition_check(spark, d):
    c = T.table(spark, d, "customer")
    return profile.partition_check(c, "c_nationkey", {"listed": _NATIONS7, "rest": _NATIONS_B})


@query("threshold_flag", """
SELECT o_orderkey, CASE WHEN year(o_orderdate) >= 1999 THEN 1 ELSE 0 END AS new_flag FROM orders
""")
def _threshold(spark, d):
    o = T.table(spark, d, "orders")
    return o.select("o_orderkey", S.threshold_flag(F.year("o_orderdate"), 1999).alias("new_flag"))


@query("concat_key", f"""
SELECT o_orderkey, o_orderstatus || {PRIO_NULLED} AS key_null,
       o_orderstatus || coalesce({PRIO_NULLED}, '') AS key_fill
FROM orders
""")
def _concat(spark, d):
    o = T.orders_nulled(spark, d)
    return o.select("o_orderkey",
                    S.concat_key(["o_orderstatus", "o_orderpriority"]).alias("key_null"),
                    S.concat_key(["o_orderstatus", "o_orderpriority"], null_as="").alias("key_fill"))


@query("round_half_even", """
SELECT l_orderkey, l_linenumber, round_even(l_extendedprice * l_discount, 2) AS r FROM lineitem
""")
def _round(spark, d):
    li = T.table(spark, d, "lineitem")
    return li.select("l_orderkey", "l_linenumber",
                     S.round_half_even(F.col("l_extendedprice") * F.col("l_discount"), 2).alias("r"))


@query("truncate_counts", """
SELECT CAST(trunc(l_extendedprice / 1000 - 50) AS BIGINT) AS bucket, count(*) AS count
FROM lineitem GROUP BY 1
""")
def _truncate(spark, d):
    li = T.table(spark, d, "lineitem").select(
        S.truncate_int(F.col("l_extendedprice") / 1000 - 50).alias("bucket"))
    return profile.value_counts(li, "bucket", sort=None)


@query("log_target", """
SELECT o_orderkey, round_even(ln(1 + o_totalprice), 4) AS log_price,
       round_even(exp(ln(1 + o_totalprice)) - 1, 2) AS back
FROM orders
""")
def _log(spark, d):
    o = T.table(spark, d, "orders")
    lp = S.log1p_label("o_totalprice")
    return o.select("o_orderkey", r4(lp).alias("log_price"),
                    S.round_half_even(S.expm1_label(lp), 2).alias("back"))


@query("price_per_unit", """
SELECT l_orderkey, l_linenumber, round_even(l_extendedprice / nullif(l_quantity, 0), 4) AS unit_price
FROM lineitem
""")
def _ratio(spark, d):
    li = T.table(spark, d, "lineitem")
    return li.select("l_orderkey", "l_linenumber",
                     r4(S.ratio("l_extendedprice", "l_quantity")).alias("unit_price"))


@query("rows_missing", """
SELECT event_id, user_id FROM events WHERE event_type = 'error'
""")
def _missing(spark, d):
    return clean.rows_missing(T.events_nulled(spark, d), "value", ["event_id", "user_id"])


# ==== ordered operators (O02, O21) =========================================

@query("row_id_orders", """
SELECT o_orderkey, CAST(row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS BIGINT) AS row_id
FROM orders
""")
def _row_id(spark, d):
    o = T.table(spark, d, "orders").select("o_orderkey", "o_orderdate")
    return ordered.with_row_id(o, ["o_orderdate", "o_orderkey"]).select("o_orderkey", "row_id")


def _interp_sql(part: str) -> str:
    pb = f"PARTITION BY {part} " if part else ""
    return f"""
WITH e AS (SELECT event_id, {part + ', ' if part else ''}CASE WHEN event_type <> 'error' THEN value END AS v,
                  row_number() OVER ({pb}ORDER BY event_id) - 1 AS pos FROM events),
a AS (SELECT *,
  last_value(CASE WHEN v IS NOT NULL THEN pos END IGNORE NULLS) OVER ({pb}ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS pp,
  last_value(v IGNORE NULLS) OVER ({pb}ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS pv,
  first_value(CASE WHEN v IS NOT NULL THEN pos END IGNORE NULLS) OVER ({pb}ORDER BY pos ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS np,
  first_value(v IGNORE NULLS) OVER ({pb}ORDER BY pos ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS nv
  FROM e)
SELECT event_id, CASE WHEN v IS NOT NULL THEN v WHEN pp IS NULL THEN NULL WHEN np IS NULL THEN pv
       ELSE ((nv - pv) / CAST(np - pp AS DOUBLE)) * CAST(pos - pp AS DOUBLE) + pv END AS value
FROM a
"""


@query("interpolate_events", _interp_sql(""))
def _interp(spark, d):
    e = T.events_nulled(spark, d).select("event_id", "value")
    return ordered.interpolate_linear(e, ["value"], ["event_id"])


@query("interpolate_by_user", _interp_sql("user_id"))
def _interp_user(spark, d):
    e = T.events_nulled(spark, d).select("event_id", "user_id", "value")
    return ordered.interpolate_linear(e, ["value"], ["event_id"], ["user_id"]).select(
        "event_id", "value")


# ==== splits (O50, O51) ====================================================

def _md5_sql(seed: int, key: str) -> str:
    return f"('0x' || substr(md5('{seed}:' || CAST({key} AS VARCHAR)), 1, 15))::BIGINT"


@query("holdout", f"""
SELECT o_orderkey, CAST(({_md5_sql(2023, 'o_orderkey')} % 1000000) < 200000 AS INTEGER) AS is_holdout
FROM orders WHERE {TRAIN}
""")
def _holdout(spark, d):
    o = T.table(spark, d, "orders").where(T.ts_before("o_orderdate", T.ORDERS_CUTOFF))
    return o.select("o_orderkey", split.holdout_mask("o_orderkey", 0.2, 2023)
                    .cast("int").alias("is_holdout"))


_A23, _B23 = split.universal_params(2023)
_A42, _B42 = split.universal_params(42)


def _uhash_sql(k: str, a: int, b: int) -> str:
    p = split.UNIVERSAL_PRIME
    return f"((((({k} % {p}) + {p}) % {p}) * {a} + {b}) % {p})"


@query("holdout_exact", f"""
SELECT o_orderkey, CAST(row_number() OVER (ORDER BY {_md5_sql(2023, 'o_orderkey')}, o_orderkey) <= ceil(0.2 * count(*) OVER ()) AS INTEGER) AS is_holdout
FROM orders WHERE {TRAIN}
""")
def _holdout_exact(spark, d):
    """O50 with exactly a fifth of the rows, rounded up."""
    o = T.table(spark, d, "orders").where(T.ts_before("o_orderdate", T.ORDERS_CUTOFF))
    return o.select("o_orderkey", split.exact_mask(o, "o_orderkey", 0.2, 2023).cast("int").alias("is_holdout"))


@query("holdout_universal", f"""
SELECT o_orderkey, CAST(({_uhash_sql('o_orderkey', _A23, _B23)} % 1000000) < 200000 AS INTEGER) AS is_holdout
FROM orders WHERE {TRAIN}
""")
def _holdout_universal(spark, d):
    o = T.table(spark, d, "orders").where(T.ts_before("o_orderdate", T.ORDERS_CUTOFF))
    return o.select("o_orderkey", split.holdout_mask("o_orderkey", 0.2, 2023, "universal")
                    .cast("int").alias("is_holdout"))


@query("sample_events_universal", f"""
SELECT event_id, value FROM events
ORDER BY {_uhash_sql('event_id', _A42, _B42)}, event_id LIMIT 1000
""")
def _sample_universal(spark, d):
    return distribution.sample_n(T.table(spark, d, "events"), 1000, seed=42, key="event_id",
                                 method="universal").select("event_id", "value")


_VALID_MONTHS = [200001, 200002, 200003, 200004, 200005, 200006]


@query("period_split", f"""
SELECT o_orderkey, CASE WHEN {YM} IN ({", ".join(map(str, _VALID_MONTHS))}) THEN 'valid' ELSE 'train' END AS part
FROM orders WHERE {TRAIN}
""")
def _period(spark, d):
    o = T.with_ym(T.table(spark, d, "orders").where(T.ts_before("o_orderdate", T.ORDERS_CUTOFF)))
    tr, va = split.period_split(o, "ym", _VALID_MONTHS)
    return (tr.select("o_orderkey", F.lit("train").alias("part"))
              .unionByName(va.select("o_orderkey", F.lit("valid").alias("part"))))


# ==== evaluation and comparison (O57–O61) ==================================

_MEAN_PRED = f"""
WITH m AS (SELECT avg(o_totalprice) AS mu FROM orders WHERE {TRAIN}),
t AS (SELECT o_orderkey, o_totalprice, mu, (o_totalprice - mu) * (o_totalprice - mu) AS err
      FROM orders, m WHERE NOT ({TRAIN}))
"""


def _mean_predicted(spark, d) -> DataFrame:
    o = T.table(spark, d, "orders")
    train = o.where(T.ts_before("o_orderdate", T.ORDERS_CUTOFF))
    test = o.where(~T.ts_before("o_orderdate", T.ORDERS_CUTOFF))
    mu = train.agg(F.avg("o_totalprice").alias("pred"))  # one row
    t = attach_row(test, mu)
    return evaluate.with_error(t, "o_totalprice", "pred")


@query("rmse_mean_predictor", _MEAN_PRED + """
SELECT round_even(sqrt(avg(err)), 4) AS rmse, count(*) AS n FROM t
""")
def _rmse(spark, d):
    r = evaluate.rmse(_mean_predicted(spark, d), "o_totalprice", "pred")
    return r.select(r4("rmse").alias("rmse"), "n")


@query("extremes_worst", _MEAN_PRED + """
SELECT o_orderkey, round_even(err, 4) AS error FROM t ORDER BY err DESC, o_orderkey LIMIT 100
""")
def _worst(spark, d):
    t = evaluate.extremes_by(_mean_predicted(spark, d), "error", 100, "o_orderkey", largest=True)
    return t.select("o_orderkey", r4("error").alias("error"))


@query("extremes_best", _MEAN_PRED + """
SELECT o_orderkey, round_even(err, 4) AS error FROM t ORDER BY err ASC, o_orderkey LIMIT 100
""")
def _best(spark, d):
    t = evaluate.extremes_by(_mean_predicted(spark, d), "error", 100, "o_orderkey", largest=False)
    return t.select("o_orderkey", r4("error").alias("error"))


_PRED_A_SQL = ("SELECT o_orderkey, CASE WHEN o_orderpriority = '5-LOW' THEN NULL "
               "ELSE CAST(trunc(o_totalprice / 1000) AS BIGINT) END AS target FROM orders")
_PRED_B_SQL = ("SELECT o_orderkey, CASE WHEN o_orderpriority IN ('5-LOW', '4-NOT SPECIFIED') THEN NULL "
               "WHEN month(o_orderdate) = 1 THEN CAST(trunc(o_totalprice / 1000) AS BIGINT) + 1 "
               "ELSE CAST(trunc(o_totalprice / 1000) AS BIGINT) END AS target FROM orders "
               "WHERE o_orderstatus <> 'P'")


def _pred_ab(spark, d):
    o = T.table(spark, d, "orders")
    base = S.truncate_int(F.col("o_totalprice") / 1000)
    a = o.select("o_orderkey", F.when(F.col("o_orderpriority") != "5-LOW", base).alias("target"))
    b = o.where(F.col("o_orderstatus") != "P").select(
        "o_orderkey",
        F.when(F.col("o_orderpriority").isin("5-LOW", T.SENTINEL), F.lit(None))
         .when(F.month("o_orderdate") == 1, base + 1).otherwise(base).alias("target"))
    return a, b


_CMP_SQL = f"""
WITH a AS ({_PRED_A_SQL}), b AS ({_PRED_B_SQL}),
j AS (SELECT coalesce(a.o_orderkey, b.o_orderkey) AS o_orderkey, a.target AS a, b.target AS b,
             CASE WHEN b.o_orderkey IS NULL THEN 'only_a' WHEN a.o_orderkey IS NULL THEN 'only_b'
                  WHEN coalesce(a.target = b.target, false) THEN 'equal' ELSE 'different' END AS status
      FROM a FULL OUTER JOIN b ON a.o_orderkey = b.o_orderkey)
"""


@query("compare_predictions", _CMP_SQL + """
SELECT count(*) FILTER (WHERE status = 'equal') AS equal,
       count(*) FILTER (WHERE status = 'different') AS different,
       count(*) FILTER (WHERE status = 'only_a') AS only_a,
       count(*) FILTER (WHERE status = 'only_b') AS only_b
FROM j
""")
def _cmp(spark, d):
    a, b = _pred_ab(spark, d)
    return evaluate.compare_predictions(a, b, "o_orderkey", "target")


def _folder(spark, name: str) -> str:
    """A new working folder that goes when the session ends."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(p)
    delete_at_exit(spark, path)
    return path


@query("compare_by_position", """
WITH a AS (SELECT row_number() OVER (ORDER BY o_orderkey) - 1 AS row_id, CAST(trunc(o_totalprice) AS BIGINT) AS target FROM orders),
b AS (SELECT row_number() OVER (ORDER BY o_orderkey) - 1 AS row_id, CAST(trunc(o_totalprice) AS BIGINT) + CAST(month(o_orderdate) = 1 AS INTEGER) AS target
      FROM orders WHERE o_orderkey % 1000 <> 500),
j AS (SELECT a.row_id AS ra, b.row_id AS rb, a.target = b.target AS same FROM a FULL OUTER JOIN b ON a.row_id = b.row_id)
SELECT count(*) FILTER (WHERE same) AS equal, count(*) FILTER (WHERE NOT same) AS different,
       count(*) FILTER (WHERE rb IS NULL) AS only_a, count(*) FILTER (WHERE ra IS NULL) AS only_b FROM j
""")
def _compare_position(spark, d):
    """Two prediction files without any key, matched by the position of their rows."""
    o = T.table(spark, d, "orders")
    second = o.where("o_orderkey % 1000 <> 500").withColumn("o_totalprice", F.col("o_totalprice").cast("bigint") + (F.month("o_orderdate") == 1).cast("int"))
    read = []
    for df in (o, second):
        path = _folder(spark, "predictions")
        io.write_predictions(df, path, "o_orderkey", "o_totalprice")
        read.append(io.read_table(spark, path, schema="target bigint", fmt="csv", row_id=True))
    return evaluate.compare_predictions(*read, "row_id", "target")


@query("ordered_sink", """
SELECT row_number() OVER (ORDER BY o_orderkey) - 1 AS row_id, CAST(trunc(o_totalprice) AS BIGINT) AS target FROM orders
""")
def _ordered_sink(spark, d):
    """A prediction file published as a whole, read back in row order."""
    path = _folder(spark, "ordered")
    ordered_sink.write_ordered(T.table(spark, d, "orders"), path, "o_orderkey", "o_totalprice")
    return ordered_sink.read_ordered(spark, path, "target bigint")


@query("file_row_ids", "SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS line FROM orders")
def _file_rows(spark, d):
    """Rows of several Parquet files numbered by their place in the files."""
    path = _folder(spark, "sorted")
    T.table(spark, d, "orders").repartitionByRange(6, "o_orderkey").sortWithinPartitions("o_orderkey").write.mode("overwrite").parquet(path)
    return io.read_table(spark, path, fmt="parquet", row_id="line").select("o_orderkey", "line")


@query("inferred_types", """
SELECT o_orderkey, CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN o_custkey END AS o_custkey, o_orderstatus,
       CAST(o_totalprice AS DOUBLE) AS o_totalprice, o_orderkey % 2 = 0 AS even,
       CASE WHEN o_orderkey % 7 = 0 THEN 'about ' || o_custkey ELSE CAST(o_custkey AS VARCHAR) END AS mixed FROM orders
""")
def _inferred(spark, d):
    """Types of a text file with null words, inferred in one pass."""
    o, path = T.table(spark, d, "orders"), _folder(spark, "text")
    key = F.col("o_custkey").cast("string")
    o.select("o_orderkey", F.when(F.col("o_orderpriority") != T.SENTINEL, key).otherwise("N/A").alias("o_custkey"), "o_orderstatus", "o_totalprice",
             F.when(F.col("o_orderkey") % 2 == 0, "True").otherwise("False").alias("even"),
             F.when(F.col("o_orderkey") % 7 == 0, F.concat(F.lit("about "), key)).otherwise(key).alias("mixed"),
             ).write.mode("overwrite").option("header", "true").csv(path)
    return io.read_table(spark, path, fmt="csv", null_words=io.PANDAS_NULLS)


_CHANGED = "CASE WHEN o_orderkey % 700 = 3 THEN o_totalprice + 1 ELSE o_totalprice END"


@query("content_difference", f"""
WITH a AS (SELECT o_orderkey, o_orderpriority, CAST(o_totalprice AS DOUBLE) AS price FROM orders WHERE o_orderkey % 900 <> 5),
b AS (SELECT o_orderkey, CASE WHEN o_orderkey % 1100 <> 7 THEN o_orderpriority END AS o_orderpriority, CAST({_CHANGED} AS DOUBLE) AS price FROM orders
      UNION ALL SELECT o_orderkey, o_orderpriority, CAST(o_totalprice AS DOUBLE) FROM orders WHERE o_orderkey % 1500 = 1)
SELECT o_orderkey, o_orderpriority, price, CAST(sum(x) AS BIGINT) AS in_a, CAST(sum(y) AS BIGINT) AS in_b
FROM (SELECT *, 1 AS x, 0 AS y FROM a UNION ALL SELECT *, 0, 1 FROM b) GROUP BY ALL HAVING sum(x) <> sum(y)
""")
def _content(spark, d):
    """O60 and O61 by checksums: rows left out, changed, nulled and repeated in a second table."""
    o = T.table(spark, d, "orders").withColumn("price", F.col("o_totalprice").cast("double"))
    cols = ["o_orderkey", "o_orderpriority", "price"]
    k = F.col("o_orderkey")
    b = o.select(k, F.when(k % 1100 != 7, F.col("o_orderpriority")).alias("o_orderpriority"),
                 F.when(k % 700 == 3, F.col("price") + 1).otherwise(F.col("price")).alias("price"))
    b = b.unionByName(o.where(k % 1500 == 1).select(*cols))
    return evaluate.content_difference(o.where(k % 900 != 5).select(*cols), b, "o_orderkey", cols[1:])


@query("differing_rows", _CMP_SQL + "SELECT o_orderkey, a, b, status FROM j WHERE status <> 'equal'")
def _diff_rows(spark, d):
    a, b = _pred_ab(spark, d)
    return evaluate.differing_rows(a, b, "o_orderkey", "target")


@query("diff_tables", """
SELECT a.o_orderkey, round_even(a.o_totalprice - b.p, 4) AS o_totalprice_diff
FROM orders a JOIN (SELECT o_orderkey, o_totalprice * 0.9 AS p FROM orders WHERE o_orderstatus <> 'F') b
  ON a.o_orderkey = b.o_orderkey
""")
def _diff(spark, d):
    o = T.table(spark, d, "orders")
    b = o.where(F.col("o_orderstatus") != "F").select(
        "o_orderkey", (F.col("o_totalprice") * 0.9).alias("o_totalprice"))
    r = evaluate.diff_tables(o, b, "o_orderkey", ["o_totalprice"])
    return r.select("o_orderkey", r4("o_totalprice_diff").alias("o_totalprice_diff"))


# ==== distribution summaries (O62–O65) =====================================

_EV = ("SELECT CASE WHEN ts < TIMESTAMP '2024-01-25' THEN 0 ELSE 1 END AS is_test, value AS x "
       "FROM events WHERE value IS NOT NULL AND NOT isnan(value)")


@query("histogram_events", f"""
WITH e AS ({_EV}),
s AS (SELECT min(x) AS lo, max(x) AS hi, (max(x) - min(x)) / 10 AS step FROM e),
b0 AS (SELECT is_test, x, lo, hi, step,
              CASE WHEN CAST(trunc(((x - lo) / (hi - lo)) * 10.0) AS INTEGER) = 10 THEN 9
                   ELSE CAST(trunc(((x - lo) / (hi - lo)) * 10.0) AS INTEGER) END AS i1 FROM e, s),
b2 AS (SELECT *, CASE WHEN x < (CASE WHEN i1 = 10 THEN hi ELSE i1 * step + lo END) THEN i1 - 1 ELSE i1 END AS i2 FROM b0),
b3 AS (SELECT *, CASE WHEN x >= (CASE WHEN i2 + 1 = 10 THEN hi ELSE (i2 + 1) * step + lo END) AND i2 <> 9
                      THEN i2 + 1 ELSE i2 END AS bin FROM b2),
c AS (SELECT is_test, bin, count(*) AS cnt FROM b3 GROUP BY 1, 2),
g AS (SELECT DISTINCT is_test FROM e),
bins AS (SELECT CAST(range AS INTEGER) AS bin FROM range(10))
SELECT g.is_test, bins.bin,
       CASE WHEN bins.bin = 10 THEN s.hi ELSE bins.bin * s.step + s.lo END AS lower,
       CASE WHEN bins.bin + 1 = 10 THEN s.hi ELSE (bins.bin + 1) * s.step + s.lo END AS upper,
       coalesce(c.cnt, 0) AS count
FROM g CROSS JOIN bins CROSS JOIN s LEFT JOIN c ON c.is_test = g.is_test AND c.bin = bins.bin
""")
def _hist(spark, d):
    return distribution.histogram(T.events_tagged(spark, d), "value", 10, group="is_test")


@query("box_summary_events", """
WITH q AS (SELECT event_type, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median,
                  quantile_cont(value, 0.75) AS q3 FROM events WHERE value IS NOT NULL GROUP BY 1),
f AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lower_fence, q3 + 1.5 * (q3 - q1) AS upper_fence FROM q)
SELECT f.event_type, round_even(q1, 4) AS q1, round_even(median, 4) AS median, round_even(q3, 4) AS q3,
       round_even(lower_fence, 4) AS lower_fence, round_even(upper_fence, 4) AS upper_fence,
       min(CASE WHEN value >= lower_fence AND value <= upper_fence THEN value END) AS whisker_low,
       max(CASE WHEN value >= lower_fence AND value <= upper_fence THEN value END) AS whisker_high,
       count(*) FILTER (WHERE NOT (value >= lower_fence AND value <= upper_fence)) AS n_outliers,
       count(*) AS n
FROM events e JOIN f ON e.event_type = f.event_type WHERE value IS NOT NULL
GROUP BY f.event_type, q1, median, q3, lower_fence, upper_fence
""")
def _box(spark, d):
    b = distribution.box_summary(T.table(spark, d, "events"), "value", group="event_type")
    return b.select("event_type", *[r4(c).alias(c) for c in
                                    ["q1", "median", "q3", "lower_fence", "upper_fence"]],
                    "whisker_low", "whisker_high", "n_outliers", "n")


@query("sample_events", f"""
SELECT event_id, value FROM events ORDER BY {_md5_sql(42, 'event_id')}, event_id LIMIT 1000
""")
def _sample(spark, d):
    return distribution.sample_n(T.table(spark, d, "events"), 1000, seed=42,
                                 key="event_id").select("event_id", "value")


@query("density_events", f"""
WITH e AS ({_EV}),
s AS (SELECT is_test, count(*) AS n, stddev_samp(x) * pow(count(*), -0.2) AS h, min(x) AS lo, max(x) AS hi
      FROM e GROUP BY 1),
g AS (SELECT is_test, n, h, lo - 3.0 * h AS a, hi + 3.0 * h AS b,
             (hi + 3.0 * h - (lo - 3.0 * h)) / 199 AS step FROM s),
p AS (SELECT g.*, CAST(range AS INTEGER) AS point,
             CASE WHEN range = 199 THEN b ELSE a + CAST(range AS DOUBLE) * step END AS px
      FROM g CROSS JOIN range(200)),
k AS (SELECT p.is_test, p.point, p.px, p.n, p.h,
             sum(exp(-0.5 * ((p.px - e.x) / p.h) * ((p.px - e.x) / p.h))) AS ks
      FROM p JOIN e ON p.is_test = e.is_test GROUP BY 1, 2, 3, 4, 5)
SELECT is_test, point, round_even(px, 6) AS x, round_even(ks / (n * h * sqrt(2 * pi())), 12) AS density FROM k
""")
def _density(spark, d):
    r = distribution.density(T.events_tagged(spark, d), "value", 200, 3.0, group="is_test")
    return r.select("is_test", "point", S.round_half_even("x", 6).alias("x"),
                    S.round_half_even("density", 12).alias("density"))


# ==== missing values that are NaN (S11, S13): clicks lose their value =======

def _nan_events(spark, d) -> DataFrame:
    e = T.table(spark, d, "events")
    return e.withColumn("value", F.when(F.col("event_type") == "click", F.lit(float("nan"))).otherwise(F.col("value")))


_NAN_EV = "SELECT event_id, event_type, CASE WHEN event_type <> 'click' THEN value END AS value FROM events"


@query("nan_threshold_flag", f"""
SELECT event_id, CASE WHEN value >= 50 THEN 1 ELSE 0 END AS flag FROM ({_NAN_EV})
""")
def _nan_flag(spark, d):
    return _nan_events(spark, d).select("event_id", S.threshold_flag("value", 50).alias("flag"))


@query("nan_distinct_and_counts", f"""
SELECT CAST(count(DISTINCT value) + max(CASE WHEN value IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_distinct,
       (SELECT CAST(sum(n) AS BIGINT) FROM (SELECT count(value) AS n FROM ({_NAN_EV}) GROUP BY value)) AS counted,
       round_even(avg(value), 6) AS mean, count(value) AS n_mean FROM ({_NAN_EV})
""")
def _nan_counts(spark, d):
    e = _nan_events(spark, d)
    one = profile.distinct_size(e, ["value"]).select("n_distinct")
    cnt = profile.value_counts(e, "value", sort=None).agg(F.sum("count").alias("counted"))
    mean = profile.compare_means({"e": e}, "value").select(S.round_half_even("mean", 6).alias("mean"),
                                                           F.col("count").alias("n_mean"))
    return attach_row(attach_row(one, cnt), mean)


@query("nan_extremes", f"""
SELECT event_id, value FROM ({_NAN_EV}) WHERE value IS NOT NULL ORDER BY value DESC, event_id LIMIT 50
""")
def _nan_extremes(spark, d):
    return evaluate.extremes_by(_nan_events(spark, d), "value", 50, "event_id").select("event_id", "value")


@query("nan_compare", f"""
SELECT count(value) AS equal, count(*) - count(value) AS different,
       CAST(0 AS BIGINT) AS only_a, CAST(0 AS BIGINT) AS only_b FROM ({_NAN_EV})
""")
def _nan_compare(spark, d):
    e = _nan_events(spark, d).select("event_id", "value")
    return evaluate.compare_predictions(e, e, "event_id", "value")


# ==== sources and sinks (O01, O03) =========================================

@query("csv_roundtrip", """
SELECT CAST(trunc(o_totalprice) AS BIGINT) AS target FROM orders
""")
def _csv_roundtrip(spark, d):
    """Write a prediction file (one truncated column, header, key order) to the
    shared checkpoint folder and read it back as a CSV source with a schema."""
    import uuid
    o = T.table(spark, d, "orders").select("o_orderkey", F.col("o_totalprice").alias("target"))
    path = checkpoint_dir(spark).rstrip("/") + f"/predictions/{uuid.uuid4().hex}"
    io.write_predictions(o, path, row_id="o_orderkey", c="target")
    delete_at_exit(spark, path)
    return io.read_table(spark, path, schema="target bigint", fmt="csv")


@query("csv_quotes_roundtrip", """
SELECT o_orderkey, '"' || o_orderpriority || '", "said" ' || chr(10) || o_orderstatus AS note,
       CASE WHEN o_orderstatus <> 'F' THEN o_totalprice END AS price FROM orders
""")
def _csv_quotes(spark, d):
    """Write text with quotes, commas and line feeds, and a pandas null word; read it back as pandas would."""
    import uuid
    o = T.table(spark, d, "orders")
    o = o.select("o_orderkey", F.concat(F.lit('"'), "o_orderpriority", F.lit('", "said" \n'), "o_orderstatus").alias("note"),
                 F.when(F.col("o_orderstatus") == "F", "NaN").otherwise(F.col("o_totalprice").cast("string")).alias("price"))
    path = checkpoint_dir(spark).rstrip("/") + f"/text/{uuid.uuid4().hex}"
    o.write.option("header", "true").option("escape", '"').csv(path)
    delete_at_exit(spark, path)
    return io.read_table(spark, path, "o_orderkey bigint, note string, price double", fmt="csv", multiline=True,
                         null_words=io.PANDAS_NULLS)
