"""The testdata stand-ins for the reference's transaction table.

*train/test*: orders before / from 2000-07-01, label ``o_totalprice``;
events before / from 2024-01-25 for outliers and curves; lineitem before /
from 2001-01-01 for bound trims.  ``'4-NOT SPECIFIED'`` is the sentinel.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.functions.scalar import yyyymm
from tablewright.operators.align import tag_union

# Fixed values of the stand-in set-up.
ORDERS_CUTOFF = "2000-07-01"
EVENTS_CUTOFF = "2024-01-25"
LINEITEM_CUTOFF = "2001-01-01"
SENTINEL = "4-NOT SPECIFIED"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ts_before(c: str, cutoff: str):
    return F.col(c) < F.lit(cutoff).cast("timestamp_ntz")


def orders_tagged(spark: SparkSession, sf_dir: str, label_in_test: bool = False) -> DataFrame:
    """Orders as a tagged train/test union; test rows lack the label."""
    o = table(spark, sf_dir, "orders")
    train = o.where(ts_before("o_orderdate", ORDERS_CUTOFF))
    test = o.where(~ts_before("o_orderdate", ORDERS_CUTOFF))
    if not label_in_test:
        test = test.drop("o_totalprice")
    return tag_union({0: train, 1: test})


def orders_nulled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with the priority sentinel turned into null."""
    o = table(spark, sf_dir, "orders")
    return o.withColumn("o_orderpriority",
                        F.when(F.col("o_orderpriority") != SENTINEL, F.col("o_orderpriority")))


def events_tagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.withColumn("is_test", F.when(ts_before("ts", EVENTS_CUTOFF), 0).otherwise(1))


def events_nulled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with ``value`` nulled on error events (the gaps to interpolate)."""
    e = table(spark, sf_dir, "events")
    return e.withColumn("value", F.when(F.col("event_type") != "error", F.col("value")))


def lineitem_tagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.withColumn("is_test", F.when(ts_before("l_shipdate", LINEITEM_CUTOFF), 0).otherwise(1))


def orders_placed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with an ``area`` (their summed quantity) and a two-token ``place`` text."""
    li = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.sum("l_quantity").alias("area"))
    o = with_ym(table(spark, sf_dir, "orders"))
    place = F.concat_ws(" ", "o_orderstatus", F.regexp_replace("o_orderpriority", "^[0-9]-", ""))
    return (o.join(li, F.col("o_orderkey") == F.col("l_orderkey"), "left").drop("l_orderkey")
            .withColumns({"area": F.coalesce("area", F.lit(0.0)) + F.col("o_orderkey") % 7 / 1000.0, "place": place}))


def with_ym(df: DataFrame, ts: str = "o_orderdate", name: str = "ym") -> DataFrame:
    return df.withColumn(name, yyyymm(ts))
