"""Forest, importances, validation and persistence."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablewright.operators import evaluate, model, split
from tablewright.sources import tables as io


@pytest.fixture(scope="module")
def planted(spark):
    rng = np.random.default_rng(7)
    n = 1500
    x = rng.uniform(-1, 1, size=(n, 3))
    noise = rng.uniform(-1, 1, size=n)
    label = 3 * x[:, 0] - 2 * x[:, 1] + 0.05 * rng.normal(size=n)
    rows = [(i, float(a), float(b), float(c), float(z), float(y))
            for i, ((a, b, c), z, y) in enumerate(zip(x, noise, label))]
    return spark.createDataFrame(rows, "row_id bigint, x1 double, x2 double, x3 double, "
                                       "noise double, label double")


FEATS = ["x1", "x2", "x3", "noise"]


def test_same_seed_same_predictions(planted):
    a = model.fit_forest(planted, FEATS, "label", num_trees=5, max_depth=6, seed=1)
    b = model.fit_forest(planted, FEATS, "label", num_trees=5, max_depth=6, seed=1)
    pa = model.predict(a, planted).select("row_id", "prediction").orderBy("row_id").collect()
    pb = model.predict(b, planted).select("row_id", "prediction").orderBy("row_id").collect()
    assert pa == pb


def test_forest_beats_mean_and_importances(spark, planted):
    tr, va = split.holdout_split(planted, 0.2, 2023, "row_id")
    m = model.fit_forest(tr, FEATS, "label", num_trees=10, max_depth=8)
    r = evaluate.rmse(model.predict(m, va), "label", "prediction").first()["rmse"]
    mu = tr.agg(F.avg("label")).first()[0]
    base = evaluate.rmse(va.withColumn("p", F.lit(mu)), "label", "p").first()["rmse"]
    assert r < 0.5 * base
    imp = {x["feature"]: x["importance"] for x in model.feature_importance(m, FEATS).collect()}
    assert imp["x1"] > imp["noise"] and imp["x2"] > imp["noise"]
    perm = {x["feature"]: x for x in
            model.permutation_importance(m, va, "label", FEATS, 3, 42, key="row_id").collect()}
    assert perm["x1"]["importance_mean"] > 10 * max(perm["noise"]["importance_mean"], 1e-3)
    assert abs(perm["noise"]["importance_mean"]) < 0.05
    assert perm["x1"]["importance_std"] >= 0


def test_permutation_is_a_permutation(spark):
    for n in (1, 2, 7, 100, 1001):
        a, b = model._affine(n, n % 3, 42)
        assert sorted((a * i + b) % n for i in range(n)) == list(range(n))
        inv = pow(a, -1, n)  # the lender j sends to a^-1 (j - b) mod n
        assert all((a * ((inv * (j - b)) % n) + b) % n == j for j in range(n))


def test_permutation_importance_brute_force(spark, planted):
    m = model.fit_forest(planted, FEATS, "label", num_trees=3, max_depth=4)
    va = planted.orderBy("row_id").limit(60)  # small fixture for the brute force
    got = {x["feature"]: x for x in
           model.permutation_importance(m, va, "label", FEATS, 2, 7, key="row_id").collect()}
    pdf = va.toPandas().sort_values("row_id").reset_index(drop=True)
    n = len(pdf)

    def mse(frame):
        sdf = spark.createDataFrame(frame)
        p = model.predict(m, sdf).select("label", "prediction").toPandas()
        return float(((p["label"] - p["prediction"]) ** 2).mean())

    base = mse(pdf)
    plan = [(f, model._affine(n, 2 * i + k, 7)) for i, f in enumerate(FEATS) for k in range(2)]
    imps = {f: [] for f in FEATS}
    for f, (a, b) in plan:
        q = pdf.copy()
        q[f] = pdf[f].to_numpy()[[(a * i + b) % n for i in range(n)]]
        imps[f].append(mse(q) - base)
    for f in FEATS:
        assert got[f]["baseline_mse"] == pytest.approx(base, rel=1e-9)
        assert got[f]["importance_mean"] == pytest.approx(np.mean(imps[f]), rel=1e-9, abs=1e-9)
        assert got[f]["importance_std"] == pytest.approx(np.std(imps[f]), rel=1e-6, abs=1e-9)


def test_forest_does_not_depend_on_partitioning(planted):
    """The same rows give the same forest however they arrive (and so on any number of cores)."""
    seen = set()
    for df in (planted, planted.repartition(3), planted.repartition(8, "x2"), planted.coalesce(1).orderBy("x1")):
        for key in ("row_id", None):
            m = model.fit_forest(df, FEATS, "label", num_trees=4, max_depth=6, key=key)
            seen.add((key, model.predict(m, planted).agg(F.sum("prediction").cast("decimal(30,9)")).first()[0]))
    assert len(seen) == 2


def test_save_load_identical(spark, planted, scratch):
    m = model.fit_forest(planted, FEATS, "label", num_trees=4, max_depth=5)
    io.save_model(m, f"{scratch}/m")
    back = io.load_model(f"{scratch}/m")
    p1 = model.predict(m, planted).select("row_id", "prediction").orderBy("row_id").collect()
    p2 = model.predict(back, planted).select("row_id", "prediction").orderBy("row_id").collect()
    assert p1 == p2


def test_log_target_roundtrip(spark, planted, scratch):
    pos = planted.withColumn("label", F.col("label") + 10)
    m = model.fit_forest(pos, FEATS, "label", num_trees=4, max_depth=6, target_transform="log1p")
    io.save_model(m, f"{scratch}/ml")
    back = io.load_model(f"{scratch}/ml")
    p = model.predict(back, pos).select("label", "prediction")
    r = evaluate.rmse(p, "label", "prediction").first()["rmse"]
    assert r < 1.5
    assert "_pred_t" not in model.predict(back, pos).columns


def test_validate_then_refit(spark, planted):
    final, score = model.validate_then_refit(planted, FEATS, "label", "row_id",
                                             trees_validate=3, trees_final=6, max_depth=6, fit=model.fit_forest)
    assert score.first()["n"] > 200
    assert model.forest_stage(final).getNumTrees == 6


def test_validate_then_refit_with_whole_trees(spark, planted):
    final, score = model.validate_then_refit(planted, FEATS, "label", "row_id", trees_validate=3, trees_final=6, seed=1)
    assert len(final.tops) == 6 and score.first()["n"] > 200
    top = model.feature_importance(final).first()
    other = model.feature_importance(model.fit_forest(planted, FEATS, "label", num_trees=6)).first()
    assert top["feature"] == other["feature"]


@pytest.mark.parametrize("target", [None, "log1p"])
def test_whole_trees_do_not_depend_on_partitions(spark, planted, target):
    from tablewright.operators.deep_forest import fit_deep_forest
    sums = set()
    for n in (4, 16, 64):
        m = fit_deep_forest(planted.repartition(n), FEATS, "label", "row_id", num_trees=4, max_rows=300, target_transform=target)
        rows = model.predict(m, planted).orderBy("row_id").collect()
        sums.add(tuple(r["prediction"] for r in rows))
        assert sum(abs(r["prediction"] - r["label"]) for r in rows) / len(rows) < 1.0
    assert len(sums) == 1


@pytest.mark.parametrize("target", [None, "log1p"])
def test_permuted_copies_are_not_shuffled(spark, planted, scratch, target, monkeypatch):
    """A large forest is not sent a row for each copy: its parts are walked where they lie, block by block, with the same result."""
    from tablewright.operators import deep_forest
    df = planted.withColumns({"label": F.col("label") + 10, "x3": F.round("x3", 1), "level": F.when(F.col("row_id") % 5 > 0, F.col("row_id") % 3)})
    feats = [*FEATS, "level"]
    for i, max_rows in enumerate((200, 100_000)):
        m = deep_forest.fit_deep_forest(df.where("row_id < 900"), feats, "label", "row_id", num_trees=4, max_rows=max_rows, bins=16, target_transform=target)
        m.save(f"{scratch}/m{i}")
        m = deep_forest.DeepForest.load(spark, f"{scratch}/m{i}")
        va = df.where("row_id >= 800").withColumn("label", F.when(F.col("row_id") % 50 > 0, F.col("label")))
        asked = ["level", "x1", "row_id", "x3"]         # in another order, one that the forest does not know
        want = model.permutation_importance(m, va, "label", asked, 2, 7, key="row_id").collect()
        with monkeypatch.context() as p:
            p.setattr(deep_forest, "CHUNK", 64)
            p.setattr(deep_forest, "WALKED", 100)
            p.setattr(deep_forest, "BLOCK_BYTES", 1 << 16)
            p.setattr(deep_forest.DeepForest, "predict", None)
            got = model.permutation_importance(m, va, "label", asked, 2, 7, key="row_id", model_bytes=0).collect()
        got, want = ({r["feature"]: r for r in rows} for rows in (got, want))
        assert got.keys() == want.keys() == set(asked)
        for f in asked:
            for c in ("importance_mean", "importance_std", "baseline_mse"):
                assert got[f][c] == pytest.approx(want[f][c], rel=1e-9, abs=1e-12)
