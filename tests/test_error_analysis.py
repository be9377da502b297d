"""Worst and best predictions against pandas, on rows with ties, nulls and NaN."""

import random

import pandas as pd
import pytest

from tablewright.operators import encode
from tablewright.operators.distribution import box_summary
from tablewright.operators.evaluate import error_analysis
from tablewright.plans import jobs
from tests.conftest import SF_SMALL

SCHEMA = "id long, town string, area double, target double, prediction double"


def rows(seed, n):
    rng = random.Random(seed)
    return [(i, rng.choice(["a", "b", "c d", None]), rng.choice([None, float(rng.randrange(9))]),
             rng.choice([None, float("nan"), *map(float, range(8))]), rng.choice([None, *map(float, range(8))])) for i in range(n)]


@pytest.mark.parametrize("seed,n,most", [(1, 200, 20), (2, 30, 20), (3, 400, 7)])
def test_sides_equal_pandas(spark, seed, n, most):
    data = rows(seed, n)
    df = spark.createDataFrame(data, SCHEMA).repartition(5)
    mapping = encode.label_fit(df, ["town"])
    out = error_analysis(encode.label_transform(df, mapping, ["town"]), "target", "prediction", "id", most, mapping, ["town"], ["area"], 4)
    p = pd.DataFrame(data, columns=["id", "town", "area", "target", "prediction"])
    p["error"] = (p.target.astype(float) - p.prediction.astype(float)) ** 2
    p = p[p.error.notna()]
    got = {(r["side"], r["position"]): (r["id"], r["town"], r["error"]) for r in out["rows"].collect()}
    want = {}
    for side, up in (("worst", False), ("best", True)):
        part = p.sort_values(["error", "id"], ascending=[up, True]).head(most)
        for at, r in enumerate(part.itertuples(), 1):
            want[side, at] = (r.id, None if pd.isna(r.town) else r.town, r.error)
    assert got == want
    for r in out["box"].collect():
        ids = [k[0] for s, k in want.items() if s[0] == r["side"]]
        assert r["n"] == len(ids) and r["median"] == p[p.id.isin(ids)].target.median()
    bins = out["histogram"].toPandas()
    for c in ("target", "area"):
        for side in ("worst", "best"):
            ids = [k[0] for s, k in want.items() if s[0] == side]
            here = bins[(bins["column"] == c) & (bins["side"] == side)]
            assert len(here) == 4 and here["count"].sum() == p[p.id.isin(ids)][c].notna().sum()


def test_empty_and_unscored_rows(spark):
    df = spark.createDataFrame([(1, "a", 1.0, None, 2.0), (2, "b", 1.0, 3.0, float("nan"))], SCHEMA)
    for given in (df, df.limit(0)):
        out = error_analysis(given, "target", "prediction", "id")
        assert all(out[k].collect() == [] for k in ("rows", "box", "histogram"))


def test_baseline_job_decodes_its_errors(spark):
    out = jobs.orders_baseline(spark, SF_SMALL, trees=4, max_depth=5, permutation_repeats=0, extremes=15)
    r = out["error_rows"].toPandas().sort_values(["side", "position"])
    assert list(r.groupby("side").size()) == [15, 15]
    assert r[r.side == "worst"].error.is_monotonic_decreasing and r[r.side == "best"].error.is_monotonic_increasing
    assert r[r.side == "worst"].error.min() >= r[r.side == "best"].error.max()
    known = {x[0] for x in spark.read.parquet(f"{SF_SMALL}/orders.parquet").select("o_orderpriority").distinct().collect()}
    assert set(r["o_orderpriority"]) <= known | {"NULL"}
    assert set(out["error_box"].toPandas()["side"]) == {"worst", "best"}
    assert box_summary(out["error_rows"], "o_totalprice", "side").count() == 2
