"""Differential tests: operators against the pandas / NumPy behaviour they re-express."""

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tablewright.functions import scalar as S
from tablewright.operators import distribution, encode, profile

SET = settings(max_examples=12, deadline=None,
               suppress_health_check=[HealthCheck.function_scoped_fixture])
FLOATS = st.floats(-1e4, 1e4, allow_nan=False, allow_infinity=False)


@SET
@given(st.lists(FLOATS, min_size=1, max_size=80), st.integers(1, 12))
def test_histogram_matches_numpy(spark, vals, bins):
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = [r["count"] for r in distribution.histogram(df, "x", bins).orderBy("bin").collect()]
    exp, edges = np.histogram(np.array(vals), bins=bins)
    assert got == exp.tolist()
    lows = [r["lower"] for r in distribution.histogram(df, "x", bins).orderBy("bin").collect()]
    assert np.allclose(lows, edges[:-1], rtol=1e-12, atol=1e-9)


@SET
@given(st.lists(st.one_of(st.none(), st.sampled_from(["b", "a", "강남", "z z", "10", "9"])),
                min_size=1, max_size=30), st.booleans())
def test_one_hot_matches_get_dummies(spark, vals, drop_first):
    pdf = pd.DataFrame({"id": range(len(vals)), "c": vals})
    df = spark.createDataFrame(pdf.astype({"c": "object"}).where(pdf.notna(), None),
                               "id long, c string")
    if pdf["c"].notna().sum() == 0:
        return
    exp = pd.get_dummies(pdf, columns=["c"], drop_first=drop_first).astype(
        {c: "int64" for c in pd.get_dummies(pdf, columns=["c"], drop_first=drop_first).columns
         if c.startswith("c_")})
    got = encode.one_hot(df, ["c"], drop_first=drop_first).toPandas().sort_values("id")
    assert list(got.columns) == list(exp.columns)
    assert (got.drop(columns="id").to_numpy() == exp.drop(columns="id").to_numpy()).all()


@SET
@given(st.lists(st.floats(-1e6, 1e6, allow_nan=False), min_size=1, max_size=40), st.integers(0, 4))
def test_round_matches_numpy(spark, vals, n):
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = [r[0] for r in df.select(S.round_half_even("x", n)).collect()]
    assert got == np.round(np.array(vals), n).tolist()


@SET
@given(st.lists(FLOATS, min_size=2, max_size=60))
def test_describe_matches_pandas(spark, vals):
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    ps = [0.1, 0.25, 0.5, 0.75, 0.9]
    got = profile.describe(df, "x", ps).first()
    exp = pd.Series(vals).describe(percentiles=ps)
    assert got["count"] == exp["count"]
    for k, e in [("mean", "mean"), ("std", "std"), ("min", "min"), ("max", "max"),
                 ("p10", "10%"), ("p25", "25%"), ("p50", "50%"), ("p75", "75%"), ("p90", "90%")]:
        assert got[k] == pytest.approx(exp[e], rel=1e-9, abs=1e-6), k


def test_value_counts_and_null_report_match_pandas(spark):
    vals = ["a", "b", None, "a", "c", None, "a", "b"]
    pdf = pd.DataFrame({"k": vals, "x": [1.0, None, 2.0, float("nan"), 3.0, 4.0, None, 5.0]})
    df = spark.createDataFrame([(k, None if x != x else x) for k, x in zip(pdf.k, pdf.x)],
                               "k string, x double")
    vc = {r["k"]: r["count"] for r in profile.value_counts(df, "k").collect()}
    assert vc == pdf["k"].value_counts().to_dict()
    nr = {r["column"]: r["nulls"] for r in profile.null_report(df).collect()}
    assert nr == pdf.isnull().sum().to_dict()
