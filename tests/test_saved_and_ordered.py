"""One saved object that predicts raw rows; prediction files that are published as a whole."""

import json
import os
import subprocess
import sys

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from tablewright.operators import preparation as P
from tablewright.sources import ordered_sink as S

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="module")
def train(spark):
    rows = [(i, ["a", "b", None, "c"][i % 4], ["x", "y"][i % 2], i % 7 * 1.0, float(i % 4 * 100 + i % 7)) for i in range(400)]
    return spark.createDataFrame(rows, "id long, kind string, place string, area double, y double")


@pytest.fixture(scope="module")
def raw(spark):
    return spark.createDataFrame([(1000, "b", "y", 3.0), (1001, None, "z", 5.0), (1002, "new", None, 0.0), (1003, "zz", "x", 1.0)],
                                 "id long, kind string, place string, area double")


@pytest.fixture(scope="module")
def fitted(train):
    return Pipeline(stages=[P.FillText(["kind"]), P.LabelCodes(["kind"]), P.OneHotLevels(["place"]), P.Conform(["y"]),
                            P.WholeTrees("y", "id", num_trees=5, bootstrap=False)]).fit(train)


def test_a_new_session_loads_one_path_and_predicts_raw_rows(spark, fitted, raw, scratch):
    want = sorted((r["id"], r["prediction"]) for r in fitted.transform(raw).collect())
    path = os.path.join(scratch, "model")
    fitted.write().save(path)
    raw.write.parquet(os.path.join(scratch, "raw"))
    code = f"""
import sys; sys.path.insert(0, {ROOT!r})
from tablewright.session import get_session
from pyspark.ml import PipelineModel
s = get_session("local[2]", extra={{"spark.checkpoint.dir": {scratch!r} + "/ck", "spark.sql.warehouse.dir": {scratch!r} + "/wh"}})
m = PipelineModel.load({path!r})
rows = m.transform(s.read.parquet({scratch!r} + "/raw")).collect()
import json; print("GOT", json.dumps(sorted([r["id"], r["prediction"]] for r in rows)))
"""
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True).stdout
    got = json.loads(next(x for x in out.splitlines() if x.startswith("GOT"))[4:])
    assert [tuple(r) for r in got] == want
    assert dict(want)[1000] == 103.0 and dict(want)[1001] == 205.0


def test_stages_keep_what_they_learned(spark, fitted, raw, scratch):
    path = os.path.join(scratch, "model2")
    fitted.write().overwrite().save(path)
    back = PipelineModel.load(path)
    assert [type(s) for s in back.stages] == [type(s) for s in fitted.stages] and [s.uid for s in back.stages] == [s.uid for s in fitted.stages]
    coded = back.stages[1].transform(back.stages[0].transform(raw)).orderBy("id").collect()
    # codes of NULL, a, b, c are 0..3; values that training lacks come after them in sorted order
    assert [r["kind"] for r in coded] == [2, 0, 4, 5]
    hot = back.stages[2].transform(raw).orderBy("id").collect()
    assert [(r["place_x"], r["place_y"]) for r in hot] == [(0, 1), (0, 0), (0, 0), (1, 0)]
    shaped = back.stages[3].transform(spark.createDataFrame([(1, 2)], "place_x int, other int"))
    assert shaped.columns == ["id", "kind", "area", "place_x", "place_y"] and shaped.first()["place_x"] == 1


def listing(path):
    return sorted(os.path.join(d, f)[len(path) + 1:] for d, _, fs_ in os.walk(path) for f in fs_ if not f.endswith(".crc"))


def test_ordered_file_round_trip(spark, scratch):
    path = os.path.join(scratch, "pred")
    df = spark.range(5000).selectExpr("id * 3 AS row_id", "id * 7.9 AS target").repartition(6)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        S.write_ordered(df, path)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    got = S.read_ordered(spark, path, "target long").collect()
    assert sorted((r["row_id"], r["target"]) for r in got) == [(i, int(i * 7.9)) for i in range(5000)]
    manifest = json.load(open(os.path.join(path, "_manifest.json")))
    assert manifest["header"] == ["target"] and sum(r["rows"] for r in manifest["ranges"]) == 5000 and len(manifest["ranges"]) > 1
    whole = "".join(open(os.path.join(path, r["file"])).read() for r in manifest["ranges"])
    assert [int(x) for x in whole.split()] == [int(i * 7.9) for i in range(5000)]
    # a second write replaces the first as a whole
    S.write_ordered(df.limit(0), path)
    assert S.read_ordered(spark, path, "target long").collect() == [] and listing(path) == ["_manifest.json"]


def test_a_failed_job_leaves_the_earlier_file(spark, scratch):
    path = os.path.join(scratch, "pred")
    S.write_ordered(spark.range(100).selectExpr("id AS row_id", "id AS target"), path)
    before = listing(path)
    bad = spark.range(1000, numPartitions=4).select(F.col("id").alias("row_id"), F.when(F.col("id") == 700, F.raise_error(F.lit("lost"))).otherwise(
        F.col("id")).cast("bigint").alias("target"))
    with pytest.raises(Exception):
        S.write_ordered(bad, path)
    assert [r["target"] for r in S.read_ordered(spark, path, "target long").orderBy("row_id").collect()] == list(range(100))
    assert listing(path) == before


def test_a_retried_task_leaves_no_second_range(scratch, monkeypatch):
    import pyarrow as pa
    path = os.path.join(scratch, "retry")

    class Task:
        def partitionId(self):
            return 3
    monkeypatch.setattr(S.TaskContext, "get", staticmethod(lambda: Task()))
    w = S.OrderedWriter(path, ["target"], True)
    batch = pa.RecordBatch.from_pydict({"target": [1, 2]})
    w.write(iter([batch]))                          # this attempt's message is lost
    w.commit([w.write(iter([batch])), None])
    assert len(listing(path)) == 2 and len(json.load(open(os.path.join(path, "_manifest.json")))["ranges"]) == 1
    other = S.OrderedWriter(path, ["target"], True)
    other.write(iter([batch]))
    other.abort([None])
    assert len(listing(path)) == 2
