"""Sources and sinks: CSV with native headers, ordered prediction files, streaming."""

import os

from pyspark.sql import functions as F

from tablewright.operators import model
from tablewright.sources import tables as io
from tablewright.streaming import score_stream


def test_csv_korean_header_and_rename(spark, scratch):
    p = os.path.join(scratch, "train.csv")
    with open(p, "w", encoding="utf-8") as f:
        f.write("시군구,번지,전용면적(㎡),계약년월,target\n")
        f.write("서울특별시 강남구 개포동,658-1,79.97,202212,124000\n")
        f.write("서울특별시 강남구 개포동,,54.98,202301,\n")
    df = io.read_table(spark, p)
    assert df.columns[0] == "시군구" and dict(df.dtypes)["계약년월"] == "int"
    df2 = io.read_table(spark, p, columns=["region_path", "lot", "area", "contract_ym", "price"])
    r = df2.orderBy("contract_ym").collect()
    assert r[0]["area"] == 79.97 and r[1]["lot"] is None and r[1]["price"] is None
    typed = io.read_table(spark, p, schema="a string, b string, c double, d int, e double")
    assert typed.count() == 2


def test_nan_to_null(spark, scratch):
    df = spark.createDataFrame([(float("nan"),), (1.0,)], "x double")
    p = os.path.join(scratch, "nan.parquet")
    df.write.parquet(p)
    got = io.read_table(spark, p, nan_to_null=True).where(F.col("x").isNull()).count()
    assert got == 1


def test_write_predictions_order_and_truncation(spark, scratch):
    df = spark.createDataFrame([(i, 1000.9 - i * 0.5) for i in range(50)][::-1] + [(50, -1.9)],
                               "row_id bigint, target double").repartition(5)
    out = os.path.join(scratch, "pred")
    io.write_predictions(df, out, "row_id", "target")
    files = sorted(f for f in os.listdir(out) if f.startswith("part-"))
    vals = []
    for f in files:
        with open(os.path.join(out, f)) as fh:
            lines = fh.read().splitlines()
        assert lines[0] == "target"
        vals += [int(x) for x in lines[1:]]
    assert vals == [int(1000.9 - i * 0.5) for i in range(50)] + [-1]


def test_score_stream(spark, scratch):
    rows = [(i, float(i % 7), float(i % 3), float(i % 7) * 2 + i % 3) for i in range(200)]
    df = spark.createDataFrame(rows, "row_id bigint, a double, b double, label double")
    m = model.fit_forest(df, ["a", "b"], "label", num_trees=3, max_depth=4)
    mp = os.path.join(scratch, "model")
    io.save_model(m, mp)
    src = os.path.join(scratch, "incoming")
    df.drop("label").write.parquet(src)
    sink = os.path.join(scratch, "scored")
    q = score_stream(spark, mp, src, "row_id bigint, a double, b double", sink, ["row_id"],
                     checkpoint=os.path.join(scratch, "ck"))
    q.awaitTermination(120)
    got = spark.read.parquet(sink)
    assert got.count() == 200 and set(got.columns) == {"row_id", "target"}
