"""Row positions of files, inferred types, reconciled unions, exact holdouts."""

import io as stdio
import math
import os

import pandas as pd
import pytest

from tablewright.operators import align, split
from tablewright.sources import tables as io


@pytest.fixture()
def split_bytes(spark):
    """Cut files into splits of so many bytes."""
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    old = {k: spark.conf.get(k) for k in keys}

    def use(n):
        spark.conf.set(keys[0], n)
        spark.conf.set(keys[1], 1)
    yield use
    for k, v in old.items():
        spark.conf.set(k, v)


def lines(n, first=0):
    return [f"{i},name {i * 7 % 13},{'x' * (i % 50)}" for i in range(first, first + n)]


@pytest.mark.parametrize("size", [300, 1000, 1 << 20])
def test_row_ids_are_line_numbers(spark, scratch, split_bytes, size):
    path, first = os.path.join(scratch, "csv"), 0
    os.mkdir(path)
    for f, n in (("a.csv", 400), ("b.csv", 1), ("c.csv", 0), ("d.csv", 900)):
        with open(os.path.join(path, f), "w") as fh:
            fh.write("\n".join(["id,name,pad", *lines(n, first)]) + "\n")
        first += n
    split_bytes(size)
    for options in ({"schema": "id long, name string, pad string"}, {"null_words": io.PANDAS_NULLS}):
        df = io.read_table(spark, path, fmt="csv", row_id=True, **options)
        assert df.columns == ["id", "name", "pad", "row_id"]
        got = df.repartition(5).select("id", "row_id").collect()
        assert sorted((r["id"], r["row_id"]) for r in got) == [(i, i) for i in range(first)]
    flat = os.path.join(scratch, "flat")
    spark.read.schema("id long, name string, pad string").option("header", True).csv(path).repartitionByRange(7, "id").sortWithinPartitions(
        "id").write.option("parquet.block.size", 2000).parquet(flat)
    got = io.read_table(spark, flat, fmt="parquet", row_id="line").where("id % 3 = 0").collect()
    assert sorted((r["id"], r["line"]) for r in got) == [(i, i) for i in range(0, first, 3)]


def test_row_ids_of_records_with_line_feeds(spark, scratch):
    path = os.path.join(scratch, "multi.csv")
    pd.DataFrame({"id": range(50), "t": [f"a\n\"b\" {i}" for i in range(50)]}).to_csv(path, index=False)
    got = io.read_table(spark, path, multiline=True, row_id=True, columns=["n", "text"], schema="id long, t string").collect()
    assert sorted((r["n"], r["row_id"]) for r in got) == [(i, i) for i in range(50)]


TEXT = """id,price,flag,name,mixed,empty,half,big,odd,flagged,space
1,1.5,True,a,1,,1,9223372036854775807,1d,1, 7
2,-2e3,FALSE,N/A,x,NA,,9223372036854775808,2,True,8
3,nan,true,c,3.5,null,2,1,3,0, 9
4,.5,False,NULL,True,,3,2,inf,False,10
"""


def test_inferred_types_equal_pandas(spark, scratch):
    path = os.path.join(scratch, "f1.csv")
    with open(path, "w") as f:
        f.write(TEXT)
    df = io.read_table(spark, path, null_words=io.PANDAS_NULLS)
    want = pd.read_csv(stdio.StringIO(TEXT))
    kinds = {"int64": "bigint", "float64": "double", "bool": "boolean", "object": "string", "str": "string"}
    for c, k in dict(df.dtypes).items():
        p = kinds[str(want[c].dtype)] if c != "big" else "double"      # pandas: uint64; there is no such type here
        # whole numbers with gaps stay whole here, pandas has to make them decimals
        assert k == ("bigint" if c == "half" else p), (c, k, want[c].dtype)
    got = [tuple(r) for r in df.collect()]
    assert got[0] == (1, 1.5, True, "a", "1", None, 1, 9.223372036854775807e18, "1d", "1", 7) and got[1][3] is None and got[1][1] == -2000.0
    assert [r[6] for r in got] == [1, None, 2, 3]
    empty = io.infer_types(spark.createDataFrame([], "a string, b string"))
    assert [f.dataType.simpleString() for f in empty] == ["double", "double"]


def test_union_of_numbers_and_text(spark):
    a = spark.createDataFrame([(1, 2, True, 1.5)], "k int, m int, b boolean, w double")
    b = spark.createDataFrame([("x", 3, 4, 2)], "k string, m bigint, b int, w int")
    u = align.tag_union({0: a, 1: b})
    assert dict(u.dtypes) == {"k": "string", "m": "bigint", "b": "string", "w": "double", "is_test": "int"}
    assert sorted(map(tuple, u.collect())) == [("1", 2, "true", 1.5, 0), ("x", 3, "4", 2.0, 1)]
    assert align.reconciled({0: a, 1: a})[0] is a


@pytest.mark.parametrize("rows", [1, 7, 2003])
def test_exact_holdout(spark, monkeypatch, rows):
    monkeypatch.setattr(split, "BOUNDARY_ROWS", 3)          # several digits are needed
    monkeypatch.setattr(split, "DIGIT_BITS", 4)
    df = spark.range(rows).selectExpr("id * 31 AS id", "id % 3 AS h")
    for frac in (0.2, 0.5, 1.0, 0.0, 0.001):
        parts = []
        for n in (1, 6):
            train, hold = split.holdout_split(df.repartition(n), frac, 7, "id", exact=True)
            parts.append(sorted(r["id"] for r in hold.collect()))
            assert train.count() + len(parts[-1]) == rows
        assert parts[0] == parts[1] and len(parts[0]) == math.ceil(round(frac * rows, 9))
    assert split.holdout_split(df.limit(0), 0.2, 7, "id", exact=True)[1].count() == 0


def test_exact_holdout_of_a_repeated_key(spark, monkeypatch):
    monkeypatch.setattr(split, "BOUNDARY_ROWS", 10)
    df = spark.range(300).selectExpr("if(id % 3 = 0, 5, id) AS id")
    train, hold = split.holdout_split(df, 0.2, 7, "id", exact=True)
    keys = {r["id"] for r in hold.collect()}
    assert not keys & {r["id"] for r in train.collect()} and hold.count() >= 60
