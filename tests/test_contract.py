"""Driver contract: entry(), queries() and oracle_sql() agree with DuckDB."""

import os
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL
from tools.oracle_check import TABLES, digest

ORACLES = E.oracle_sql()


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["is_test", "season", "n", "mean_price"]


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(E.queries())


def test_other_queries_stay_without_third_party_packages():
    """Where a package of the training-data operators is missing, all other queries are registered."""
    code = ("import sys; sys.modules.update(dict.fromkeys(['zstandard', 'ahocorasick'])); import __spark_entry__ as E; "
            "q = E.queries(); print(len(q), 'pipeline' in q, set(E.oracle_sql()) <= set(q))")
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True,
                         cwd=os.path.dirname(E.__file__)).stdout.split()
    assert int(out[0]) > 80 and out[1:] == ["False", "True"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    rel = con.sql(ORACLES[name])
    orows = rel.fetchall()
    assert sorted(df.columns) == sorted(rel.columns)
    assert len(rows) == len(orows)
    assert digest(df.columns, rows) == digest(rel.columns, orows)


@pytest.mark.parametrize("name", ["describe_price", "rmse_mean_predictor", "extremes_worst",
                                  "box_summary_events", "keep_by_frequency", "quantiles_select"])
def test_no_pairwise_join_in_plan(spark, name):
    import contextlib
    import io
    df = E.queries()[name](spark, SF_SMALL)
    df.write.format("noop").mode("overwrite").save()
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    plan = buf.getvalue()
    assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan


def test_attach_row_refuses_a_second_row(spark):
    from pyspark.sql import functions as F

    from tablewright.session import attach_row
    df = spark.range(3)
    one = df.agg(F.max("id").alias("mx"))
    assert [r["mx"] for r in attach_row(df, one).collect()] == [2, 2, 2]
    with pytest.raises(Exception, match="More than one row"):
        attach_row(df, df.select(F.col("id").alias("mx"))).collect()
