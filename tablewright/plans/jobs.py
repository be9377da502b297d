"""The reference's three end-to-end jobs as compositions of operators.

A  baseline: clean → impute → IQR trim → features → label codes on the union
   → holdout → forest → RMSE, importances → predict test.
B  compact: address key → codes → rounding → year/month → season one-hot
   (first level dropped) → district one-hot → new-build flag → fixed-bound
   trim → log1p validation fit → refit on all train rows → predict test.
C  period validation: one-hot from the training levels, test conformed to
   the training columns → months held out for validation → fit → RMSE →
   predict test.

Column roles are parameters; ``orders_*`` helpers bind them to the testdata
stand-in (orders before / from 2000-07-01, label ``o_totalprice``).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.functions import scalar as S
from tablewright.operators import align, clean, encode, model, ordered, profile, split
from tablewright.operators.deep_forest import fit_deep_forest
from tablewright.operators.evaluate import error_analysis, rmse
from tablewright.plans import standins as T
from tablewright.session import materialize


@dataclass
class Roles:
    key: str                       # unique row key (row order for interpolation)
    label: str
    ym: str                        # integer YYYYMM column
    categorical: Sequence[str] = ()
    continuous: Sequence[str] = ()
    sentinels: Mapping[str, Sequence] = field(default_factory=dict)
    trim_col: str | None = None
    flag: str = "is_test"
    new_from: int = 1999           # first year that counts as new


def _engine(vectors: Sequence[str], max_depth: int | None) -> dict:
    """Whole trees on plain columns; MLlib's forest where features are sparse vectors (30 deep at most)."""
    return {"fit": model.fit_forest, "max_depth": min(max_depth or 30, 30)} if vectors else {"fit": fit_deep_forest, "max_depth": max_depth}


def _prepare_a(train: DataFrame, test: DataFrame, r: Roles, max_null_ratio: float = 0.9,
               iqr_k: float = 1.5) -> tuple[DataFrame, list[str], DataFrame, list[str]]:
    """Prepared rows, their features, the label mapping and the columns it codes."""
    u = align.tag_union({0: train, 1: test}, r.flag)
    u = clean.sentinels_to_null(u, r.sentinels)
    keep = [r.key, r.label, r.flag, r.ym]
    # written once: counted, bounded, trimmed and encoded from here
    u = materialize(u.select(*keep, *r.categorical, *r.continuous))
    u = clean.drop_sparse_columns(u, max_ratio=max_null_ratio)
    cats = [c for c in r.categorical if c in u.columns]
    conts = [c for c in r.continuous if c in u.columns]
    u = clean.fill_constant(u, cats, "NULL")
    if conts:
        u = ordered.interpolate_linear(u, conts, [r.key])
    if r.trim_col:
        u = clean.trim_outliers_iqr(u, r.trim_col, iqr_k, f"{r.flag} = 0")
    u = S.split_yyyymm(u, r.ym, "cont_year", "cont_month", drop=False)
    u = u.withColumn("new_flag", S.threshold_flag("cont_year", r.new_from))
    m = encode.label_fit(u, cats)
    u = encode.label_transform(u, m, cats)
    feats = [*cats, *conts, "cont_year", "cont_month", "new_flag"]
    return u, feats, m, cats


def baseline(train: DataFrame, test: DataFrame, r: Roles, trees: int = 100, seed: int = 1,
             holdout: float = 0.2, split_seed: int = 2023, max_depth: int | None = None,
             permutation_repeats: int = 3, extremes: int = 0) -> dict[str, DataFrame]:
    """Pipeline A.  Returns frames: predictions, rmse, importance, permutation, and
    with ``extremes`` the decoded analysis of so many worst and best holdout rows
    (error_rows, error_box, error_histogram)."""
    u, feats, mapping, cats = _prepare_a(train, test, r)
    u = materialize(u)      # read by the fit, the scoring and the importances
    tr, te = align.split_tagged(u, r.flag, r.label, test_label=0.0)
    fit_part, valid = split.holdout_split(tr, holdout, split_seed, r.key, exact=True)
    m = fit_deep_forest(fit_part, feats, r.label, r.key, num_trees=trees, seed=seed, max_depth=max_depth)
    scored_valid = model.predict(m, valid)
    out = {
        "rmse": rmse(scored_valid, r.label, "prediction"),
        "importance": model.feature_importance(m, feats),
        "predictions": model.predict(m, te).select(
            r.key, F.col("prediction").cast("bigint").alias("target")),
    }
    if permutation_repeats:
        out["permutation"] = model.permutation_importance(
            m, valid, r.label, feats, permutation_repeats, 42, key=r.key)
    if extremes:
        found = error_analysis(scored_valid, r.label, "prediction", r.key, extremes, mapping, cats, r.continuous)
        out.update({f"error_{name}": df for name, df in found.items()})
    return out


def compact(train: DataFrame, test: DataFrame, r: Roles, address: Sequence[str],
            district: str, area: str | None, bound: float | None, trees_validate: int = 5,
            trees_final: int = 50, seed: int = 1, split_seed: int = 2023,
            max_depth: int | None = None, log_target: bool = True, max_levels: int = 1000) -> dict[str, DataFrame]:
    """Pipeline B.  ``address`` columns form the label-coded key, ``district``
    is one-hot encoded; ``area`` is rounded to 2 places and trimmed at ``bound``
    (strict) on training rows."""
    u = materialize(align.tag_union({0: train, 1: test}, r.flag))
    u = u.withColumn("full_addr", S.concat_key(address, null_as=""))
    m = encode.label_fit(u, ["full_addr"])
    u = encode.label_transform(u, m, ["full_addr"], suffix="_encoded").drop("full_addr")
    # text address parts are represented by the coded key from here on
    u = u.drop(*[c for c in address if c != district and
                 dict(u.dtypes).get(c) == "string"])
    if area:
        u = u.withColumn(area, S.round_half_even(area, 2))
    u = S.split_yyyymm(u, r.ym, "cont_year", "cont_month", drop=True)
    u = u.withColumn("season", S.season("cont_month"))
    u = encode.one_hot(u, ["season"], values={"season": ["autumn", "spring", "summer", "winter"]},
                       drop_first=True)
    # a place column with very many levels becomes one sparse vector instead of a column a level
    vectors = encode.too_many_levels(u, [district], max_levels)
    u = encode.one_hot_vector(u, encode.label_fit(u, vectors), vectors).drop(district) if vectors else encode.one_hot(u, [district])
    u = u.withColumn("new_flag", S.threshold_flag("cont_year", r.new_from))
    if area and bound is not None:
        u = clean.trim_outliers_bound(u, area, bound, f"{r.flag} = 0")
    u = materialize(u)      # read by the fit, the scoring and the importances
    tr, te = align.split_tagged(u, r.flag, r.label)
    feats = [c for c in tr.columns if c not in (r.key, r.label)]
    tt = "log1p" if log_target else None
    final, score = model.validate_then_refit(
        tr, feats, r.label, r.key, 0.2, split_seed, trees_validate, trees_final,
        seed=seed, target_transform=tt, **_engine(vectors, max_depth))
    preds = model.predict(final, te).select(r.key, F.col("prediction").cast("bigint").alias("target"))
    return {"rmse": score, "predictions": preds, "model": final, "features": feats}


def period(train: DataFrame, test: DataFrame, r: Roles, onehot: Sequence[str],
           valid_months: Sequence[int], trees: int = 50, seed: int = 1,
           max_depth: int | None = None, max_levels: int = 1000) -> dict[str, DataFrame]:
    """Pipeline C.  One-hot levels are read from train only; test is conformed
    to train's columns (unseen levels dropped, missing ones zero)."""
    train, test = materialize(train), materialize(test)
    vectors = encode.too_many_levels(train, onehot, max_levels)
    if vectors:             # very many levels: one sparse vector a column; levels that train lacks are zeros there too
        m = encode.label_fit(train, vectors)
        train, test = (encode.one_hot_vector(t, m, vectors).drop(*vectors) for t in (train, test))
    lv = {c: encode.levels(train, c) for c in onehot if c not in vectors}
    tr = encode.one_hot(train, list(lv), values=lv)
    te = encode.one_hot(test, list(lv), values=lv)
    te = align.conform_to(te, [c for c in tr.columns if c != r.label], fill=0)
    tr = S.split_yyyymm(tr, r.ym, "cont_year", "cont_month", drop=False)
    te = S.split_yyyymm(te, r.ym, "cont_year", "cont_month", drop=False)
    fit_part, valid = split.period_split(tr, r.ym, valid_months)
    feats = [c for c in tr.columns if c not in (r.key, r.label, r.ym)]
    engine = _engine(vectors, max_depth)
    m = engine.pop("fit")(fit_part, feats, r.label, key=r.key, num_trees=trees, seed=seed, **engine)
    from tablewright.operators.evaluate import rmse
    return {"rmse": rmse(model.predict(m, valid), r.label, "prediction"),
            "predictions": model.predict(m, te).select(
                r.key, F.col("prediction").cast("bigint").alias("target"))}


# ---- bindings to the testdata stand-in ------------------------------------

ORDERS_ROLES = Roles(key="o_orderkey", label="o_totalprice", ym="ym",
                     categorical=["o_orderstatus", "o_orderpriority"],
                     continuous=["area"], sentinels={"o_orderpriority": [T.SENTINEL]},
                     trim_col="area")
AREA_BOUND = 250.0      # about the top twentieth of the areas


def orders_split(spark: SparkSession, sf_dir: str, gaps: bool = False) -> tuple[DataFrame, DataFrame]:
    """Train and test orders with area and place; with ``gaps`` every tenth area is missing."""
    o = T.orders_placed(spark, sf_dir)
    if gaps:
        o = o.withColumn("area", F.when(F.col("o_orderkey") % 10 != 3, F.col("area")))
    before = T.ts_before("o_orderdate", T.ORDERS_CUTOFF)
    train = o.where(before).drop("o_orderdate")
    test = o.where(~before).drop("o_orderdate", "o_totalprice")
    return train, test


def orders_baseline(spark, sf_dir, **kw):
    tr, te = orders_split(spark, sf_dir, gaps=True)
    return baseline(tr, te, ORDERS_ROLES, **kw)


def orders_compact(spark, sf_dir, **kw):
    tr, te = (d.withColumn("district", S.split_token("place", 1)).drop("place", "o_orderpriority")
              for d in orders_split(spark, sf_dir))
    return compact(tr, te, ORDERS_ROLES, address=["o_orderstatus", "o_custkey"],
                   district="district", area="area", bound=AREA_BOUND, **kw)


def orders_period(spark, sf_dir, **kw):
    def shaped(d):
        d = d.withColumns({"status": S.split_token("place", 0), "district": S.split_token("place", 1),
                           "area": S.round_half_even("area", 2)})
        return d.select("o_orderkey", *[c for c in ("o_totalprice",) if c in d.columns], "ym", "o_custkey",
                        "area", "status", "district")
    tr, te = (shaped(d) for d in orders_split(spark, sf_dir))
    return period(tr, te, ORDERS_ROLES, ["status", "district"],
                  [200001, 200002, 200003, 200004, 200005, 200006], **kw)
