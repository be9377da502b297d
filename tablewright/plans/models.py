"""Model queries (O04, O05, O50, O52–O56, O03) and the reference's three end-to-end jobs.

In general no SQL engine can state a forest's output, so most register without
an oracle.  The ``exact_*`` queries have one: their label is a function of one
coded column, so every tree ends in pure leaves and predictions, errors and
importances follow from the table.
"""

from __future__ import annotations

import uuid

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.functions import scalar as S
from tablewright.operators import deep_forest, encode, model
from tablewright.operators import preparation as P2
from tablewright.operators.evaluate import error_analysis, rmse
from tablewright.plans import jobs as P
from tablewright.plans import standins as T
from tablewright.plans.queries import TRAIN, query
from tablewright.session import attach_row, checkpoint_dir, delete_at_exit
from tablewright.sources import tables as io



def _orders_derived(spark: SparkSession, sf_dir: str, train: bool) -> DataFrame:
    o = T.with_ym(T.table(spark, sf_dir, "orders"))
    before = T.ts_before("o_orderdate", T.ORDERS_CUTOFF)
    o = o.where(before if train else ~before)
    o = S.split_yyyymm(o, "ym", drop=False)
    return o.withColumns({"new_flag": S.threshold_flag("cont_year", 1999),
                          "urgent": S.in_set_flag("o_orderpriority", ["1-URGENT", "2-HIGH"])})


FEATURES = ["o_custkey", "o_orderstatus", "o_orderpriority", "cont_year", "cont_month",
            "new_flag", "urgent"]
CODED = ["o_orderstatus", "o_orderpriority"]


def orders_features(spark: SparkSession, sf_dir: str, with_mapping: bool = False):
    """Numeric feature table for the forest queries (train period only).

    Label codes are fitted on the training rows and extended with the test
    rows' unseen values, so train and test codes come from one mapping.
    """
    tr = _orders_derived(spark, sf_dir, True)
    m = encode.label_fit(tr, CODED)
    m = encode.label_extend(m, _orders_derived(spark, sf_dir, False), CODED)
    out = encode.label_transform(tr, m, CODED).select("o_orderkey", "o_totalprice", *FEATURES)
    return (out, FEATURES, m) if with_mapping else (out, FEATURES)


def _refit_rmse(final, df: DataFrame) -> DataFrame:
    """Error of the refitted forest on the rows it was fitted on."""
    return rmse(model.predict(final, df), "o_totalprice", "prediction").select(F.col("rmse").alias("refit_rmse"))


@query("forest_holdout_rmse")
def _forest_rmse(spark, d):
    df, feats = orders_features(spark, d)
    final, score = model.validate_then_refit(df, feats, "o_totalprice", "o_orderkey", 0.2, 2023,
                                             seed=1)
    return attach_row(score, _refit_rmse(final, df))


@query("forest_log_target_rmse")
def _forest_log(spark, d):
    df, feats = orders_features(spark, d)
    final, score = model.validate_then_refit(df, feats, "o_totalprice", "o_orderkey", 0.2, 2023,
                                             target_transform="log1p", seed=1)
    return attach_row(score, _refit_rmse(final, df))


@query("feature_importance")
def _importance(spark, d):
    df, feats = orders_features(spark, d)
    m = deep_forest.fit_deep_forest(df, feats, "o_totalprice", "o_orderkey")
    return model.feature_importance(m, feats)


@query("permutation_importance")
def _permutation(spark, d):
    df, feats = orders_features(spark, d)
    from tablewright.operators.split import holdout_split
    tr, va = holdout_split(df, 0.2, 2023, "o_orderkey", exact=True)
    m = deep_forest.fit_deep_forest(tr, feats, "o_totalprice", "o_orderkey")
    return model.permutation_importance(m, va, "o_totalprice", feats, 3, 42, key="o_orderkey")


@query("save_load_predict")
def _save_load(spark, d):
    df, feats, mapping = orders_features(spark, d, with_mapping=True)
    m = deep_forest.fit_deep_forest(df, feats, "o_totalprice", "o_orderkey", num_trees=50)
    path = checkpoint_dir(spark).rstrip("/") + f"/models/{uuid.uuid4().hex}"
    m.save(path)
    delete_at_exit(spark, path)
    back = deep_forest.DeepForest.load(spark, path)
    test = encode.label_transform(_orders_derived(spark, d, False), mapping, CODED)
    return model.predict(back, test).select(
        "o_orderkey", S.truncate_int("prediction").alias("target"))


@query("baseline_job_predictions")
def _pipe_a(spark, d):
    return P.orders_baseline(spark, d, permutation_repeats=0)["predictions"]


@query("baseline_job_outputs")
def _pipe_a_outputs(spark, d):
    """Error, impurity importance and permutation importance of the baseline job, as (output, name, value)."""
    out = P.orders_baseline(spark, d)
    rows = out["rmse"].select(F.lit("rmse").alias("output"), F.lit("holdout").alias("name"), F.col("rmse").alias("value"))
    rows = rows.unionByName(out["importance"].select(F.lit("impurity").alias("output"), F.col("feature").alias("name"),
                                                     F.col("importance").alias("value")))
    return rows.unionByName(out["permutation"].select(F.lit("permutation").alias("output"), F.col("feature").alias("name"),
                                                      F.col("importance_mean").alias("value")))


@query("baseline_job_errors")
def _pipe_a_errors(spark, d):
    """The 100 worst and 100 best holdout predictions of the baseline job, decoded."""
    return P.orders_baseline(spark, d, permutation_repeats=0, extremes=100)["error_rows"]


@query("compact_job_predictions")
def _pipe_b(spark, d):
    return P.orders_compact(spark, d)["predictions"]


@query("period_job_predictions")
def _pipe_c(spark, d):
    return P.orders_period(spark, d)["predictions"]


@query("period_job_rmse")
def _pipe_c_rmse(spark, d):
    return P.orders_period(spark, d)["rmse"]


# ==== forests whose output SQL can state =====================================

EXACT = ["priority", "month"]
_CODE = "CAST(substr(o_orderpriority, 1, 1) AS INTEGER)"
_EXACT_SQL = f"SELECT o_orderkey, {_CODE} AS priority, CAST({_CODE} * 100 AS DOUBLE) AS label FROM orders WHERE {TRAIN}"


def _exact(spark: SparkSession, sf_dir: str, train: bool = True) -> DataFrame:
    """Orders with the label ``100 * priority``; the month has nothing to do with it."""
    o = T.table(spark, sf_dir, "orders")
    before = T.ts_before("o_orderdate", T.ORDERS_CUTOFF)
    code = F.substring("o_orderpriority", 1, 1).cast("int")
    return o.where(before if train else ~before).select(
        "o_orderkey", code.alias("priority"), F.month("o_orderdate").alias("month"), (code * 100.0).alias("label"))


def _exact_forest(df: DataFrame):
    return model.fit_forest(df, EXACT, "label", num_trees=20, max_depth=30, seed=1, key="o_orderkey")


def _rounded(c: str):
    return S.round_half_even(c, 6).alias(c)


@query("exact_predictions", f"SELECT o_orderkey, CAST({_CODE} * 100 AS DOUBLE) AS prediction FROM orders WHERE NOT ({TRAIN})")
def _exact_predictions(spark, d):
    """A forest fitted on train predicts test."""
    m = _exact_forest(_exact(spark, d))
    return model.predict(m, _exact(spark, d, False)).select("o_orderkey", _rounded("prediction"))


@query("exact_validation", f"""
SELECT CAST(0 AS DOUBLE) AS rmse, CAST(ceil(count(*) * 0.2) AS BIGINT) AS n, count(*) AS n_refit, CAST(0 AS DOUBLE) AS refit_rmse FROM ({_EXACT_SQL})
""")
def _exact_validation(spark, d):
    """Holdout error, then the model refitted on all rows."""
    df = _exact(spark, d)
    final, score = model.validate_then_refit(df, EXACT, "label", "o_orderkey", trees_validate=5, trees_final=20, seed=1, max_depth=30, fit=model.fit_forest)
    again = rmse(model.predict(final, df), "label", "prediction")
    return attach_row(score.select(_rounded("rmse"), "n"), again.select(
        F.col("n").alias("n_refit"), S.round_half_even("rmse", 6).alias("refit_rmse")))


@query("exact_saved_model", f"SELECT o_orderkey, CAST({_CODE} * 100 AS DOUBLE) AS prediction FROM orders WHERE NOT ({TRAIN})")
def _exact_saved(spark, d):
    """The forest is saved, loaded and predicts the same."""
    path = checkpoint_dir(spark).rstrip("/") + f"/models/{uuid.uuid4().hex}"
    io.save_model(_exact_forest(_exact(spark, d)), path)
    delete_at_exit(spark, path)
    return model.predict(io.load_model(path), _exact(spark, d, False)).select("o_orderkey", _rounded("prediction"))


@query("exact_importance", "SELECT 'priority' AS feature, CAST(1 AS DOUBLE) AS importance UNION ALL SELECT 'month', 0")
def _exact_importance(spark, d):
    """All impurity is removed by the one column that makes the label."""
    return model.feature_importance(_exact_forest(_exact(spark, d)), EXACT).select("feature", _rounded("importance"))


def _permutation_sql(repeats: int, seed: int) -> str:
    p = "CASE " + " ".join(f"WHEN n % {p} <> 0 THEN {p}" for p in model.PRIMES) + " END"
    rows = []
    for k in range(repeats):
        a = "p % n"
        for _ in range(k):
            a = f"(({a}) * (p % n)) % n"
        rows.append(f"""SELECT {k} AS k, avg(power(v.label - r.label, 2)) AS d FROM r JOIN n ON true
                        JOIN r v ON v.i = ((({a}) * r.i) + ({seed * (k + 1) * 7919} % n)) % n""")
    return f"""
    WITH r AS (SELECT row_number() OVER (ORDER BY o_orderkey) - 1 AS i, label FROM ({_EXACT_SQL})),
    n AS (SELECT n, {p} AS p FROM (SELECT count(*) AS n FROM r)),
    e AS ({" UNION ALL ".join(rows)})
    SELECT 'priority' AS feature, round_even(avg(d), 4) AS importance_mean, round_even(stddev_pop(d), 4) AS importance_std FROM e
    UNION ALL SELECT 'month', 0.0, 0.0"""


@query("exact_permutation", _permutation_sql(2, 42))
def _exact_permutation(spark, d):
    """Permuting the priority costs the squared label distance to the row it came from."""
    df = _exact(spark, d)
    out = model.permutation_importance(_exact_forest(df), df, "label", EXACT, 2, 42, key="o_orderkey")
    return out.select("feature", S.round_half_even("importance_mean", 4).alias("importance_mean"),
                      S.round_half_even("importance_std", 4).alias("importance_std"))


# ==== trees of unlimited depth with exact splits =============================

VECTOR = ["priority", "month", "clerk"]
_VECTOR_SQL = f"""SELECT o_orderkey, {_CODE} AS priority, month(o_orderdate) AS month, o_custkey % 97 AS clerk, o_totalprice
                  FROM orders WHERE {TRAIN}"""
TASK_ROWS = 2_000       # so that nodes above the bound occur in the test tables too


def _vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = T.table(spark, sf_dir, "orders").where(T.ts_before("o_orderdate", T.ORDERS_CUTOFF))
    return o.select("o_orderkey", F.substring("o_orderpriority", 1, 1).cast("int").alias("priority"), F.month("o_orderdate").alias("month"),
                    (F.col("o_custkey") % 97).alias("clerk"), "o_totalprice")


@query("deep_tree_means", f"""
SELECT o_orderkey, round_even(avg(o_totalprice) OVER (PARTITION BY priority, month, clerk), 6) AS prediction FROM ({_VECTOR_SQL})
""")
def _deep_means(spark, d):
    """O52 without a depth limit: a tree grown to its leaves predicts the mean of each distinct feature vector."""
    df = _vectors(spark, d)
    tree = deep_forest.fit_deep_forest(df, VECTOR, "o_totalprice", "o_orderkey", num_trees=1, bootstrap=False, max_rows=TASK_ROWS)
    return tree.predict(df).select("o_orderkey", S.round_half_even("prediction", 6).alias("prediction"))


_RAW_SQL = f"""SELECT o_orderkey, CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN o_orderpriority END AS kind, o_orderstatus AS status,
               o_custkey % 97 AS clerk, o_totalprice FROM orders WHERE {TRAIN}"""


@query("saved_preparation", f"""
SELECT o_orderkey, round_even(avg(o_totalprice) OVER (PARTITION BY kind, status, clerk), 6) AS prediction FROM ({_RAW_SQL})
""")
def _saved_preparation(spark, d):
    """One saved object prepares raw rows and predicts them."""
    o = T.table(spark, d, "orders").where(T.ts_before("o_orderdate", T.ORDERS_CUTOFF))
    raw = o.select("o_orderkey", F.when(F.col("o_orderpriority") != T.SENTINEL, F.col("o_orderpriority")).alias("kind"),
                   F.col("o_orderstatus").alias("status"), (F.col("o_custkey") % 97).alias("clerk"))
    label = o.select("o_orderkey", "o_totalprice")
    fitted = Pipeline(stages=[P2.FillText(["kind"]), P2.LabelCodes(["kind"]), P2.OneHotLevels(["status"]), P2.Conform(["o_totalprice"]),
                              P2.WholeTrees("o_totalprice", "o_orderkey", num_trees=1, bootstrap=False)]).fit(raw.join(label, "o_orderkey"))
    path = checkpoint_dir(spark).rstrip("/") + f"/models/{uuid.uuid4().hex}"
    fitted.write().save(path)
    delete_at_exit(spark, path)
    return PipelineModel.load(path).transform(raw).select("o_orderkey", S.round_half_even("prediction", 6).alias("prediction"))


@query("deep_tree_nearest", f"""
WITH t AS (SELECT o_orderkey AS k, CAST(o_totalprice AS DOUBLE) AS y FROM orders WHERE {TRAIN}),
s AS (SELECT o_orderkey FROM orders WHERE NOT ({TRAIN})),
near AS (SELECT o_orderkey, (SELECT max(k) FROM t WHERE k <= o_orderkey) AS lo, (SELECT min(k) FROM t WHERE k > o_orderkey) AS hi FROM s)
SELECT o_orderkey, t.y AS prediction FROM near
JOIN t ON t.k = CASE WHEN lo IS NULL THEN hi WHEN hi IS NULL OR o_orderkey <= (lo + hi) / 2.0 THEN lo ELSE hi END
""")
def _deep_nearest(spark, d):
    """O52 and O54 with exact thresholds: on one column, a whole tree predicts the label of the nearest fitted value."""
    o = T.table(spark, d, "orders")
    before = T.ts_before("o_orderdate", T.ORDERS_CUTOFF)
    tree = deep_forest.fit_deep_forest(o.where(before), ["o_orderkey"], "o_totalprice", "o_orderkey", num_trees=1, bootstrap=False,
                                       max_rows=TASK_ROWS)
    return tree.predict(o.where(~before)).select("o_orderkey", "prediction")


# ==== error analysis: the forest of the coded column, judged against the price ====

_ERRORS = f"""
t AS (SELECT o_orderkey, o_orderpriority, o_orderstatus, CAST(o_totalprice AS DOUBLE) AS o_totalprice, month(o_orderdate) AS month,
             CAST({_CODE} * 100 AS DOUBLE) AS prediction FROM orders WHERE NOT ({TRAIN})),
e AS (SELECT *, (o_totalprice - prediction) * (o_totalprice - prediction) AS error FROM t WHERE o_totalprice IS NOT NULL),
r AS (SELECT 'worst' AS side, row_number() OVER (ORDER BY error DESC, o_orderkey) AS position, * FROM e
      UNION ALL SELECT 'best', row_number() OVER (ORDER BY error, o_orderkey), * FROM e),
x AS (SELECT * FROM r WHERE position <= 100)"""
_BOX = ["q1", "median", "q3", "whisker_low", "whisker_high", "n_outliers"]


def _errors(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    o = T.table(spark, sf_dir, "orders")
    mapping = encode.label_fit(o, CODED)
    before = T.ts_before("o_orderdate", T.ORDERS_CUTOFF)
    o = o.withColumns({"label": F.substring("o_orderpriority", 1, 1).cast("int") * 100.0, "month": F.month("o_orderdate")})
    o = encode.label_transform(o, mapping, CODED)
    columns = ["o_orderkey", *CODED, "month", "o_totalprice", "label"]
    forest = model.fit_forest(o.where(before).select(columns), [*CODED, "month"], "label", num_trees=20, max_depth=30, seed=1, key="o_orderkey")
    test = model.predict(forest, o.where(~before).select(columns)).withColumn("prediction", _rounded("prediction"))
    return error_analysis(test, "o_totalprice", "prediction", "o_orderkey", 100, mapping, CODED, ["month"])


@query("exact_error_rows", f"""
WITH {_ERRORS} SELECT side, position, o_orderkey, o_orderpriority, o_orderstatus, month, o_totalprice, prediction FROM x
""")
def _exact_error_rows(spark, d):
    """Worst and best test rows with decoded labels."""
    return _errors(spark, d)["rows"].select("side", "position", "o_orderkey", *CODED, "month",
                                            F.col("o_totalprice").cast("double").alias("o_totalprice"), "prediction")


def _bins_sql(c: str) -> str:
    """Counts in ten common bins per side, as `histogram` defines them."""
    at = "CAST(trunc(((x - lo) / (hi - lo)) * 10.0) AS INTEGER)"
    edge = "(CASE WHEN {0} = 10 THEN hi ELSE {0} * step + lo END)".format
    return f"""
SELECT 'histogram' AS chart, '{c}' AS "column", side, CAST(k AS VARCHAR) AS name, CAST(count(*) FILTER (WHERE bin = k) AS DOUBLE) AS value
FROM (SELECT side, CASE WHEN x >= {edge("(i2 + 1)")} AND i2 <> 9 THEN i2 + 1 ELSE i2 END AS bin
      FROM (SELECT *, CASE WHEN x < {edge("i1")} THEN i1 - 1 ELSE i1 END AS i2
            FROM (SELECT *, (hi - lo) / 10 AS step, CASE WHEN {at} = 10 THEN 9 ELSE {at} END AS i1
                  FROM (SELECT side, CAST({c} AS DOUBLE) AS x, min(CAST({c} AS DOUBLE)) OVER () AS lo,
                               max(CAST({c} AS DOUBLE)) OVER () AS hi FROM x)))),
     (SELECT unnest(range(10)) AS k)
GROUP BY side, k"""


@query("exact_error_charts", f"""
WITH {_ERRORS},
q AS (SELECT side, quantile_cont(o_totalprice, 0.25) AS q1, quantile_cont(o_totalprice, 0.5) AS median,
             quantile_cont(o_totalprice, 0.75) AS q3 FROM x GROUP BY 1),
w AS (SELECT side, q1, median, q3, o_totalprice AS v, v BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS inside FROM x JOIN q USING (side)),
b AS (SELECT side, q1, median, q3, min(v) FILTER (WHERE inside) AS whisker_low, max(v) FILTER (WHERE inside) AS whisker_high,
             count(*) FILTER (WHERE NOT inside) AS n_outliers FROM w GROUP BY side, q1, median, q3)
""" + " UNION ALL ".join([
    *[f"SELECT 'box' AS chart, 'o_totalprice' AS \"column\", side, '{c}' AS name, round_even(CAST({c} AS DOUBLE), 4) AS value FROM b" for c in _BOX],
    _bins_sql("o_totalprice"), _bins_sql("month")]))
def _exact_error_charts(spark, d):
    """Box and bins of the worst and best rows."""
    out = _errors(spark, d)
    box = out["box"].select(F.lit("box").alias("chart"), F.lit("o_totalprice").alias("column"), "side",
                            F.explode(F.array(*[F.struct(F.lit(c).alias("name"), S.round_half_even(F.col(c).cast("double"), 4).alias("value"))
                                                for c in _BOX])).alias("v"))
    bins = out["histogram"].select(F.lit("histogram").alias("chart"), "column", "side", F.col("bin").cast("string").alias("name"),
                                   F.col("count").cast("double").alias("value"))
    return box.select("chart", "column", "side", "v.name", "v.value").unionByName(bins)
