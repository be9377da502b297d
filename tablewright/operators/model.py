"""Random-forest regression, importances and validation.

Two kinds of forest: ``deep_forest.fit_deep_forest`` grows whole trees with
exact splits, as the reference does, and is what the jobs use; ``fit_forest``
is MLlib's, binned and at most 30 deep.  MLlib's models are pipelines (assembler → forest → optional inverse label
transform), so saving and loading keep the whole scoring path.  Tree growth
is MLlib's own distributed algorithm: histograms per node are aggregated
across partitions, so the training set is never gathered in one place.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.regression import RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.functions.scalar import squared_error
from tablewright.operators.deep_forest import BROADCAST_BYTES, DeepForest, fit_deep_forest, vector
from tablewright.operators.evaluate import rmse
from tablewright.operators.ordered import with_row_id
from tablewright.operators.split import holdout_split
from tablewright.session import attach_row, materialize

FEATURES = "_features"
PARTITION_ROWS = 250_000


def fit_forest(df: DataFrame, features: Sequence[str], label: str, num_trees: int = 100,
               seed: int = 1, max_depth: int = 30, max_bins: int = 32,
               feature_subset: str = "all", min_instances: int = 1,
               target_transform: str | None = None,
               prediction_col: str = "prediction", num_partitions: int | None = None,
               key: str | Sequence[str] | None = None) -> PipelineModel:
    """Fit assembler + random forest (squared error) on ``df``.

    ``feature_subset='all'`` considers every feature at each split and each
    tree sees a bootstrap sample, as in the reference's forest.  MLlib caps
    depth at 30 and bins continuous features into ``max_bins`` candidate
    splits.  ``target_transform='log1p'`` fits on log1p(label) and the
    pipeline's last stage turns predictions back with expm1, so the saved
    model always predicts on the original scale.

    MLlib draws its bootstrap samples partition by partition.  The input is
    therefore hash-partitioned into ``num_partitions`` on ``key`` (all used
    columns when None) and sorted inside each partition, so the same rows give
    the same forest on any machine.  The number follows from the rows alone:
    one for each ``PARTITION_ROWS``, 16 at least.
    """
    feats = list(features)
    lab = label
    # MLlib evaluates its input several times (metadata, split candidates,
    # binning); keep the narrowed input once instead of recomputing its plan
    keys = [key] if isinstance(key, str) else list(key or [*feats, label])
    train = df.select(*[F.col(f"`{c}`") for c in dict.fromkeys([*feats, label, *keys])])
    by = [F.col(f"`{c}`") for c in dict.fromkeys(keys)]
    if num_partitions is None:
        num_partitions = max(16, -(-df.count() // PARTITION_ROWS))
    train = train.repartition(num_partitions, *by).sortWithinPartitions(*by)
    train = train.persist(StorageLevel.MEMORY_AND_DISK)
    stages = [VectorAssembler(inputCols=feats, outputCol=FEATURES)]
    if target_transform == "log1p":
        lab = "_label_t"
        train = train.withColumn(lab, F.log1p(F.col(label).cast("double")))
        stages.append(RandomForestRegressor(
            featuresCol=FEATURES, labelCol=lab, predictionCol="_pred_t", numTrees=num_trees,
            seed=seed, maxDepth=max_depth, maxBins=max_bins,
            featureSubsetStrategy=feature_subset, minInstancesPerNode=min_instances,
            subsamplingRate=1.0, bootstrap=True, impurity="variance"))
        stages.append(SQLTransformer(
            statement=f"SELECT *, expm1(_pred_t) AS {prediction_col} FROM __THIS__"))
    elif target_transform is None:
        stages.append(RandomForestRegressor(
            featuresCol=FEATURES, labelCol=lab, predictionCol=prediction_col,
            numTrees=num_trees, seed=seed, maxDepth=max_depth, maxBins=max_bins,
            featureSubsetStrategy=feature_subset, minInstancesPerNode=min_instances,
            subsamplingRate=1.0, bootstrap=True, impurity="variance"))
    else:
        raise ValueError(f"unknown target_transform {target_transform!r}")
    try:
        return Pipeline(stages=stages).fit(train)
    finally:
        train.unpersist()


def predict(model: PipelineModel | DeepForest, df: DataFrame) -> DataFrame:
    """Score ``df``; drops the assembled vector and helper columns."""
    if isinstance(model, DeepForest):
        return model.predict(df)
    out = model.transform(df)
    return out.drop(FEATURES, "_pred_t", "_label_t")


def forest_stage(model: PipelineModel) -> RandomForestRegressionModel:
    for s in model.stages:
        if isinstance(s, RandomForestRegressionModel):
            return s
    raise ValueError("no forest in pipeline")


def feature_names(model: PipelineModel | DeepForest) -> list[str]:
    if isinstance(model, DeepForest):
        return model.features
    return list(model.stages[0].getInputCols())


def validate_then_refit(df: DataFrame, features: Sequence[str], label: str, key: str,
                        frac: float = 0.2, split_seed: int = 2023, trees_validate: int = 5,
                        trees_final: int = 50, fit=fit_deep_forest, **forest_args):
    """Fit on a seeded holdout split, report RMSE, then refit on all rows.

    Returns ``(final_model, holdout_rmse_frame)``.  The same
    ``target_transform`` governs both fits; ``fit`` is ``fit_deep_forest`` or ``fit_forest``.
    """
    train, valid = holdout_split(df, frac, split_seed, key, exact=True)
    forest_args = {"key": key, **forest_args}
    m = fit(train, features, label, num_trees=trees_validate, **forest_args)
    score = rmse(predict(m, valid), label, "prediction")
    final = fit(df, features, label, num_trees=trees_final, **forest_args)
    return final, score


def feature_importance(model: PipelineModel | DeepForest, names: Sequence[str] | None = None) -> DataFrame:
    """Impurity importance per feature, largest first (one row per feature)."""
    s = SparkSession.getActiveSession()
    if isinstance(model, DeepForest):
        rows = model.importances()
    else:
        imp = forest_stage(model).featureImportances.toArray().tolist()
        rows = [(n, float(v)) for n, v in zip(list(names or feature_names(model)), imp)]
    return s.createDataFrame(rows, "feature string, importance double").orderBy(
        F.col("importance").desc(), F.col("feature"))


# Primes, of which the first that does not divide the row count multiplies.
PRIMES = (1_000_000_007, 998_244_353, 1_000_000_009, 754_974_721)


def _affine(n: int, turn: int, seed: int) -> tuple[int, int]:
    """Multiplier ``a`` coprime with ``n`` and offset ``b``: i → (a*i + b) mod n
    is a permutation of 0..n-1.

    The permutation depends on n, the seed and the turn (feature and repeat)
    in a way that SQL can state: ``a`` is the turn's power of a prime.
    """
    if n == 0:
        return 1, 0
    p = next(p for p in PRIMES if n % p)
    return pow(p, turn + 1, n), (seed * (turn + 1) * 7919) % n


def _copied_mse(model: PipelineModel | DeepForest, base: DataFrame, label: str, feats: Sequence[str], inv: Sequence[tuple], dest) -> DataFrame:
    """``_fi, _rep, _mse``: all copies of the rows are scored in one pass; feature -1 is the baseline."""
    sends = base.select(F.col("_pid").alias("_src"),
                        *[F.col(f).cast("double").alias(f"_v{i}") for i, f in enumerate(feats)])
    sends = sends.select(F.inline(F.array(*[
        F.struct(dest(a_inv, b).alias("_pid"), F.lit(fi).alias("_fi"), F.lit(k).alias("_rep"),
                 F.col(f"_v{fi}").alias("_pv"))
        for fi, k, a_inv, b in inv])))
    moved = base.join(sends, "_pid", "inner")
    moved = moved.withColumns({
        f: F.when(F.col("_fi") == i, F.col("_pv")).otherwise(F.col(f).cast("double"))
        for i, f in enumerate(feats)}).drop("_pv")
    baseline = base.withColumns({"_fi": F.lit(-1), "_rep": F.lit(-1)}).withColumns(
        {f: F.col(f).cast("double") for f in feats})
    scored = predict(model, baseline.unionByName(moved))
    return scored.groupBy("_fi", "_rep").agg(
        F.avg(squared_error(label, "prediction")).alias("_mse"))


def _moved_mse(model: DeepForest, base: DataFrame, label: str, feats: Sequence[str], inv: Sequence[tuple], dest, n: int) -> DataFrame:
    """The same for a forest too large to be broadcast: no copy of a row is shuffled, only its borrowed values and the sums over the trees."""
    own = base.select(F.col("_pid").alias("_src"), vector(model.features).alias("_x"), vector(feats).alias("_f"), F.col(label).cast("double").alias("_y"))

    def send(to, turn: int, value):
        return F.struct(to.cast("bigint").alias("_pid"), F.lit(turn).alias("_turn"), value.alias("_value"))
    sent = [send(dest(a_inv, b), turn, F.col("_f")[fi]) for turn, (fi, _, a_inv, b) in enumerate(inv)]
    sent += [send(F.col("_src"), len(inv) + i, F.col("_x")[i]) for i in range(len(model.features))]
    sent.append(send(F.col("_src"), len(inv) + len(model.features), F.col("_y")))
    moved = [model.features.index(feats[fi]) if feats[fi] in model.features else -1 for fi, *_ in inv]
    found: dict[int, list] = {c: [0.0, 0] for c in range(-1, len(inv))}
    for scored in model.predict_moved(own.select(F.inline(F.array(*sent))), moved, n):
        error = squared_error("_label", "_prediction")
        for r in scored.groupBy("_copy").agg(F.sum(error).alias("s"), F.count(error).alias("n")).collect():
            found[r["_copy"]][0] += r["s"] or 0.0
            found[r["_copy"]][1] += r["n"]
    rows = [(-1 if c < 0 else inv[c][0], -1 if c < 0 else inv[c][1], s / k if k else None) for c, (s, k) in found.items()]
    return base.sparkSession.createDataFrame(rows, "_fi int, _rep int, _mse double")


def permutation_importance(model: PipelineModel | DeepForest, df: DataFrame, label: str,
                           features: Sequence[str] | None = None, n_repeats: int = 3,
                           seed: int = 42, *, key: str, model_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Increase in MSE when one feature's values are permuted across rows.

    Rows get dense positions 0..n-1 in the order of ``key``, a unique column.  For feature f and
    repeat k a seeded permutation i → (a*i + b) mod n (gcd(a, n) = 1) says
    which row lends its value of f to row i.  The permutation is inverted
    (j → a⁻¹(j - b) mod n), so each row sends its own F x R values, as narrow
    (destination, feature, repeat, value) records, to the rows that borrow
    them.  One shuffle join on the destination position then meets each
    full-width row once with its F x R borrowed values.  The wide rows
    cross the network once, not F x R times, and every destination
    receives exactly F x R records, so no key is hot.  All copies are scored in
    one pass and reduced by one aggregate.  Whole-tree forests above ``model_bytes`` stay
    where they lie: the rows with their borrowed values are walked through
    their parts (``DeepForest.predict_moved``).  Returns ``(feature,
    importance_mean, importance_std, baseline_mse)``; std is the population
    std over repeats.
    """
    feats = list(features or feature_names(model))
    # checkpointed: read by the lenders, the borrowers and the baseline
    base = materialize(with_row_id(df, [key], name="_pid"))
    n = base.count()
    plan = [(fi, k, *_affine(n, fi * n_repeats + k, seed)) for fi in range(len(feats)) for k in range(n_repeats)]
    # inverse multipliers: row j lends to row a_inv * (j - b) mod n
    inv = [(fi, k, pow(a, -1, n) if n > 0 else 0, b) for fi, k, a, b in plan]
    wide = n * n >= 2 ** 62

    def dest(a_inv: int, b: int):
        j = F.col("_src")
        if wide:
            d = "decimal(38,0)"
            return F.pmod(F.lit(a_inv).cast(d) * (j.cast(d) - F.lit(b).cast(d)),
                          F.lit(n).cast(d)).cast("bigint")
        return F.pmod(F.lit(a_inv).cast("bigint") * (j - F.lit(b).cast("bigint")), F.lit(n))

    if n and isinstance(model, DeepForest) and model.tops and model.part_bytes() > model_bytes:
        mse = _moved_mse(model, base, label, feats, inv, dest, n)
    else:
        mse = _copied_mse(model, base, label, feats, inv, dest)
    b0 = mse.where(F.col("_fi") == -1).select(F.col("_mse").alias("baseline_mse"))
    per = mse.where(F.col("_fi") >= 0)
    out = attach_row(per, b0)  # b0 is the one baseline row
    out = out.withColumn("_imp", F.col("_mse") - F.col("baseline_mse"))
    names = F.get(F.array(*[F.lit(f) for f in feats]), F.col("_fi"))
    return out.groupBy(names.alias("feature")).agg(
        F.avg("_imp").alias("importance_mean"), F.stddev_pop("_imp").alias("importance_std"),
        F.first("baseline_mse").alias("baseline_mse"))
