"""The reference's three end-to-end jobs on the testdata stand-in."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from tablewright.plans import jobs
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def n_test(spark):
    o = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    return o.where(F.col("o_orderdate") >= F.lit("2000-07-01").cast("timestamp_ntz")).count()


@pytest.mark.parametrize("name", ["baseline_job_predictions", "compact_job_predictions",
                                  "period_job_predictions", "save_load_predict"])
def test_job_predicts_every_test_row(spark, n_test, name):
    p = E.queries()[name](spark, SF_SMALL)
    assert p.columns == ["o_orderkey", "target"]
    assert p.count() == n_test == p.select("o_orderkey").distinct().count()
    assert p.where(F.col("target").isNull()).count() == 0


def test_baseline_job_reports(spark):
    out = jobs.orders_baseline(spark, SF_SMALL, trees=4, max_depth=5, permutation_repeats=2)
    assert out["rmse"].first()["rmse"] > 0
    assert out["importance"].count() == out["permutation"].count()


def test_forest_queries_rows(spark):
    q = E.queries()
    assert q["forest_holdout_rmse"](spark, SF_SMALL).count() == 1
    assert q["feature_importance"](spark, SF_SMALL).count() == 7


def test_columns_of_very_many_levels_become_vectors(spark):
    """Above ``max_levels`` the jobs go on with sparse vectors; below, with a column a level."""
    many = jobs.orders_period(spark, SF_SMALL, trees=3, max_depth=5, max_levels=4)
    assert many["rmse"].first()["rmse"] > 0 and many["predictions"].where("target is null").count() == 0
    out = jobs.orders_compact(spark, SF_SMALL, trees_validate=2, trees_final=3, max_depth=5, max_levels=4)
    assert "district_vec" in out["features"] and out["rmse"].first()["rmse"] > 0
    assert "district_vec" not in jobs.orders_compact(spark, SF_SMALL, trees_validate=1, trees_final=1, max_depth=2)["features"]
