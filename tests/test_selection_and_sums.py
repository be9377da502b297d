"""Several columns described at once, densities by moments, differences by checksums."""

import math
from collections import Counter

import numpy as np
import pandas as pd
import pytest

from tablewright.operators import distribution, evaluate, profile
from tests.conftest import SF_SMALL


@pytest.mark.parametrize("method,buckets", [("auto", 64), ("select", 64), ("select", 3)])
def test_describe_columns_equals_pandas(spark, method, buckets):
    rng = np.random.default_rng(2)
    frame = pd.DataFrame({"g": rng.choice(["x", "y"], 900), "a": rng.normal(size=900), "b": rng.integers(0, 5, 900) * 1e6,
                          "c d": np.where(rng.random(900) < 0.3, np.nan, rng.exponential(size=900)), "e": np.nan})
    frame.loc[:300, "a"] = 0.5
    df = spark.createDataFrame(frame)
    ps = [0.1, 0.25, 0.5, 0.999]
    got = profile.describe_columns(df, ["a", "b", "c d", "e"], ps, method=method, buckets=buckets).toPandas().set_index("column")
    assert sorted(got.index) == ["a", "b", "c d"]
    want = frame[["a", "b", "c d"]].describe(percentiles=ps).T.drop(columns=["50%"] if False else [])
    for c in got.index:
        assert np.allclose(got.loc[c, ["count", "mean", "std", "min", "p10", "p25", "p50", "p99_9", "max"]].astype(float), want.loc[c].astype(float))
    by = profile.describe_columns(df, ["a", "b"], [0.5], group="g", method=method, buckets=buckets).collect()
    assert {(r["g"], r["column"]): r["p50"] for r in by} == {(g, c): frame[frame.g == g][c].median() for g in "xy" for c in "ab"}
    assert profile.describe_columns(df.limit(0), ["a"]).collect() == []


def test_describe_columns_scans_are_fixed(spark, scratch):
    """As many file scans for four columns as for one."""
    def scans(cols):
        li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
        count = spark.sparkContext.statusTracker()
        group = f"scan-{len(cols)}"
        spark.sparkContext.setJobGroup(group, group)
        profile.describe_columns(li, cols, method="select").collect()
        spark.sparkContext.setJobGroup("", "")
        return len(count.getJobIdsForGroup(group))
    assert scans(["l_quantity"]) == scans(["l_quantity", "l_discount", "l_tax", "l_extendedprice"])


@pytest.mark.parametrize("shape", ["normal", "heavy", "clumps"])
def test_density_error_is_below_its_bound(spark, shape):
    rng = np.random.default_rng(5)
    x = {"normal": rng.normal(size=3000), "heavy": rng.standard_cauchy(2000), "clumps": np.r_[np.full(1000, 3.0), rng.normal(50, 0.1, 1000), 90.0]}[shape]
    got = distribution.density(spark.createDataFrame([(float(v),) for v in x], "x double"), "x", grid=120).orderBy("point").toPandas()
    h = x.std(ddof=1) * len(x) ** -0.2
    want = np.array([np.exp(-0.5 * ((p - x) / h) ** 2).sum() for p in got["x"]]) / (len(x) * h * math.sqrt(2 * math.pi))
    bound = 1.09 * sum(0.25 ** k / math.sqrt(math.factorial(k)) for k in range(16, 60))
    assert bound < 1e-15
    # the series' bound, and the rounding of sums of this size
    assert np.abs(got["density"] - want).max() <= (bound + 1e-14) / (h * math.sqrt(2 * math.pi))


def test_density_needs_no_python_worker(spark):
    df = spark.range(1000).selectExpr("id * 0.37 % 7 AS x", "id % 3 AS g")
    plan = distribution.density(df, "x", group="g")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def rows_of(df):
    return sorted((repr(tuple(r)) for r in df.collect()))


@pytest.mark.parametrize("bits,levels", [(12, 3), (2, 4), (1, 1)])
def test_content_difference_equals_multisets(spark, bits, levels):
    rng = np.random.default_rng(3)
    base = [(int(k) if k else None, f"t{v}" if v else None, float(d)) for k, v, d in zip(rng.integers(0, 300, 800), rng.integers(0, 4, 800), rng.integers(0, 3, 800))]
    other = [r for i, r in enumerate(base) if i % 97] + [(5, "new", float("nan"))] * 2 + base[:3] + [(None, None, -0.0)]
    other[10] = (other[10][0], "changed", other[10][2])
    schema = "k long, t string, d double"
    for a, b in ((base, other), (base, base[::-1]), (base, []), ([], [])):
        got = rows_of(evaluate.content_difference(spark.createDataFrame(a, schema).repartition(3), spark.createDataFrame(b, schema).repartition(5),
                                                  "k", ["t", "d"], bits, levels))
        fix = lambda rows: Counter((k, t, "nan" if d != d else d + 0.0) for k, t, d in rows)
        ca, cb = fix(a), fix(b)
        want = sorted(repr((*k[:2], float("nan") if k[2] == "nan" else k[2], ca[k], cb[k])) for k in ca.keys() | cb.keys() if ca[k] != cb[k])
        assert got == want


def test_content_difference_moves_only_what_differs(spark):
    """Two of 20,000 rows differ: the final filter names few buckets, so few rows are compared."""
    a = spark.range(20_000).selectExpr("id AS k", "id * 3 AS v")
    b = spark.range(20_000).selectExpr("id AS k", "if(id = 77 or id = 4000, 0, id * 3) AS v")
    out = evaluate.content_difference(a, b, "k", ["v"])
    assert out.count() == 4
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "shiftrightunsigned" in plan.lower() or ">>>" in plan
