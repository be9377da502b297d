import collections

import duckdb
import pytest

import __spark_entry__ as E
import corpus_pipeline as cp
from tablewright.llm import decontaminate as dc
from tablewright.llm import quality
from tablewright.llm.queries import ORACLES, QUERIES
from tests.conftest import SF_SMALL
from tools.oracle_check import TABLES, digest

from .data import documents, odd_rows
from .test_near_dedup import brute as near_brute
from .test_sharding_mixing import targets


def test_registered():
    names = [f"op{n}_" for n in range(1, 11)]
    assert [sum(q.startswith(n) for q in QUERIES) for n in names] == [1] * 10
    assert set(QUERIES) <= set(E.queries()) and set(ORACLES) <= set(E.oracle_sql())
    assert [n for n, _ in cp.STAGES] == ["quality", "near_dedup", "decontamination", "mix", "shard"]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracles(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    df = QUERIES[name](spark, SF_SMALL)
    rel = con.sql(ORACLES[name])
    assert sorted(df.columns) == sorted(rel.columns)
    assert digest(df.columns, [tuple(r) for r in df.collect()]) == digest(rel.columns, rel.fetchall())


def test_stages_equal_plain_versions(spark):
    """Each stage, run on what the one before kept, does what its plain version does."""
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    columns = docs.columns
    good = cp.stage(cp.quality_stage(spark, docs, SF_SMALL), "t")
    model = quality.train(docs, spark.read.parquet(f"{SF_SMALL}/labels.parquet"))
    want = {r["doc_id"] for r in quality.score(docs, model).where("predicted = 1").collect()}
    assert {r["doc_id"] for r in good.collect()} == want and 0 < len(want) < docs.count()

    one = cp.stage(cp.dedup_stage(spark, good, SF_SMALL), "t")
    comp = near_brute([(r["doc_id"], r["text"]) for r in good.collect()], 5)
    assert sorted(r["doc_id"] for r in one.collect()) == sorted(i for i, (_, c) in comp.items() if i == c)

    clean = cp.stage(cp.decontamination_stage(spark, one, SF_SMALL), "t")
    items = [dc.normalise(r["text"]) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    leak = {r["doc_id"] for r in one.collect() for b in items if dc.myers(b, dc.normalise(r["text"]), int(dc.ERROR_RATE * len(b)))}
    assert leak and {r["doc_id"] for r in clean.collect()} == {r["doc_id"] for r in one.collect()} - leak

    mixed = cp.stage(cp.mix_stage(spark, clean, SF_SMALL), "t")
    rows = [(r["doc_id"], r["text"], r["source"]) for r in clean.collect()]
    want, _ = targets(rows)
    taken, size = collections.Counter(), {i: (len(t.split()), s) for i, t, s in rows}
    for r in mixed.collect():
        taken[r["source"]] += len(r["text"].split())
    most = {s: max(n for n, t in size.values() if t == s) for s in want}
    # whole documents only: a source of a handful of documents may miss by half a document
    assert all(abs(taken[s] - want[s]) <= max(most[s] / 2, 0.02 * want[s]) for s in want), (taken, want, most)
    assert sum(abs(taken[s] - want[s]) for s in want) < 0.03 * sum(want.values())
    assert max(collections.Counter(r["doc_id"] for r in mixed.collect()).values()) <= 2

    last = cp.shard_stage(spark, mixed, SF_SMALL).collect()
    total = collections.Counter()
    for r in last:
        total[r["shard"]] += len(r["text"].encode())
    assert len(last) == mixed.count() and all(total[r["shard"]] == r["shard_bytes"] for r in last)
    assert all(d.columns == columns for d in (good, one, clean, mixed))
    whole = cp.run(spark, SF_SMALL).collect()
    assert sorted((r["doc_id"], r["shard"]) for r in whole) == sorted((r["doc_id"], r["shard"]) for r in last)


@pytest.mark.parametrize("rows", [odd_rows(), []])
def test_stages_take_odd_rows(spark, rows):
    df = documents(spark, rows)
    for _, stage in cp.STAGES[:-1]:
        df = cp.stage(stage(spark, df, SF_SMALL), "t")
        assert df.columns == documents(spark, []).columns
    assert cp.STAGES[-1][1](spark, df, SF_SMALL).count() == df.count()
