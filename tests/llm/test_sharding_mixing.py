import collections

import duckdb
import numpy as np

from tablewright.llm import mixing, sharding

from .data import documents, odd_rows, tokens, words


def as_set(rows, columns):
    return sorted(tuple(r[c] for c in columns) for r in rows)


def test_shards_equal_sql_and_fit(spark):
    rows = [(i, " ".join(words(i, 5 + i % 40))) for i in range(400)] + odd_rows()
    df = documents(spark, rows)
    limit = 4000
    got = sharding.shard_rows(df, limit).collect()
    con = duckdb.connect()
    documents_ = df.select("doc_id", "text").toPandas()  # noqa: F841
    con.execute("create table documents(doc_id bigint, text varchar)")
    con.executemany("insert into documents values (?, ?)", [(r[0], r[1]) for r in rows])
    rel = con.sql(sharding.oracle(limit))
    want = [dict(zip(rel.columns, r)) for r in rel.fetchall()]
    names = ["doc_id", "text_bytes", "shard", "depth", "shard_bytes", "shard_docs", "over_limit"]
    key = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted((tuple(r[c] for c in names) for r in got), key=key) == sorted((tuple(r[c] for c in names) for r in want), key=key)
    total = collections.Counter()
    for r in got:
        total[r["shard"]] += r["text_bytes"]
    assert all(total[r["shard"]] == r["shard_bytes"] and r["over_limit"] == (r["shard_bytes"] > limit) for r in got)
    assert {r["doc_id"] for r in got if r["over_limit"]} == {4, 8}
    # prefix-free: no shard is the prefix of another
    names = sorted(total)
    assert not any(b.startswith(a) for a, b in zip(names, names[1:]))


def test_repeated_rows_split_to_the_last_bit(spark):
    got = sharding.shard_rows(documents(spark, [(1, "abcdefgh")] * 5), 16).collect()
    assert {(r["depth"], r["shard_docs"], r["over_limit"]) for r in got} == {(60, 5, True)}


def test_one_shard_and_empty(spark):
    got = sharding.shard_rows(documents(spark, [(1, "a"), (2, "b")]), 100, keep=True)
    assert [r["shard"] for r in got.collect()] == ["", ""]
    assert set(documents(spark, []).columns) <= set(got.columns)
    assert sharding.shard_rows(documents(spark, []), 100).collect() == []


def test_written_shards_read_back(spark, scratch):
    df = documents(spark, [(i, " ".join(words(i, 30))) for i in range(60)])
    rows = sharding.shard_rows(df, 2000, keep=True)
    sharding.write_shards(rows.select("doc_id", "text", "shard"), f"{scratch}/shards")
    back = spark.read.schema("doc_id long, text string, shard string").parquet(f"{scratch}/shards")
    assert as_set(back.collect(), ["doc_id", "shard"]) == as_set(rows.collect(), ["doc_id", "shard"])


def targets(rows):
    size = collections.Counter()
    for _, t, s in rows:
        size[s] += len(tokens(t))
    order = sorted((s for s in size if s is not None), key=lambda s: s.encode()) + [None] * (None in size)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, full = 1.5 * sum(size.values()), set()
    while True:
        level = (total - sum(2 * size[s] for s in full)) / (sum(weight[s] for s in order if s not in full) or 1)
        new = {s for s in order if s not in full and level * weight[s] > 2 * size[s]}
        if not new:
            return {s: 2.0 * size[s] if s in full else level * weight[s] for s in order}, size
        full |= new


def test_mix_reaches_targets(spark):
    rows = [(i, " ".join(words(i, 3 + (i * 37) % 90)), f"s{min(i % 7, i % 3)}") for i in range(900)]
    rows += [(1000 + i, " ".join(words(i, 20)), None) for i in range(50)] + [(2000 + i, None, "empty") for i in range(4)]
    df = documents(spark, [])
    df = spark.createDataFrame([(*r[:2], "en", r[2], None) for r in rows], df.select(*df.columns[:5]).schema)
    got = mixing.mix(df, block_rows=64).collect()
    want, size = targets(rows)
    by = {r[0]: r for r in rows}
    taken = collections.Counter()
    for r in got:
        s = by[r["doc_id"]][2]
        assert r["size"] == len(tokens(by[r["doc_id"]][1])) and r["source_size"] == size[s]
        assert abs(r["target"] - want[s]) < 1e-6 and r["taken"] == r["size"] * r["copies"] <= 2 * r["size"]
        taken[s] += r["taken"]
    assert len(got) == len(rows)
    for s in want:
        assert abs(taken[s] - want[s]) <= max(2, 0.01 * want[s]), (s, taken[s], want[s])
    again = mixing.mix(df.repartition(5), block_rows=64).collect()
    assert as_set(got, ["doc_id", "taken"]) == as_set(again, ["doc_id", "taken"])
    # the sample carries the documents as often as it says
    copies = collections.Counter(r["doc_id"] for r in mixing.take_copies(df, mixing.mix(df, block_rows=64)).collect())
    assert copies == collections.Counter({r["doc_id"]: r["copies"] for r in got if r["copies"]})


def test_flight_keeps_both_totals_and_probabilities():
    size = np.random.default_rng(3).integers(1, 500, 200)
    start = np.full(200, 0.37)
    mean = np.zeros(200)
    for seed in range(300):
        p = mixing.flight(start, size, np.random.default_rng(seed))
        assert ((p > 0) & (p < 1)).sum() <= 2
        assert abs(p.sum() - start.sum()) < 1e-6 and abs((p * size).sum() - (start * size).sum()) < 1e-4
        mean += p / 300
    assert abs(mean - 0.37).max() < 0.15 and abs(mean.mean() - 0.37) < 1e-6
    p = mixing.landing(mixing.flight(start, size, np.random.default_rng(1)), size, start)
    assert set(p.tolist()) <= {0.0, 1.0} and abs((p * size).sum() - (start * size).sum()) < 5


def test_mix_odd_rows_and_empty(spark):
    got = mixing.mix(documents(spark, odd_rows())).collect()
    assert len(got) == len(odd_rows()) and all(r["taken"] <= 2 * r["size"] for r in got)
    mixed = mixing.mix(documents(spark, odd_rows()))
    assert mixing.take_copies(documents(spark, odd_rows()), mixed).columns == documents(spark, []).columns
    assert mixing.mix(documents(spark, [])).collect() == []


def test_rows_that_repeat_exactly_reach_the_target(spark):
    """1,000 and 300 equal rows, some equal in all but the source: every source comes within 1 % of its target."""
    rows = [(1, "four words of text", "a")] * 1000 + [(1, "four words of text", "b")] * 300
    rows += [(10 + i, " ".join(words(i, 5 + i % 40)), "b") for i in range(400)]
    df = documents(spark, rows).repartition(7)
    mixed = mixing.mix(df, block_rows=128)
    got, (want, _) = mixed.collect(), targets(rows)
    assert len(got) == len(rows)
    ordinals = sorted(r["ordinal"] for r in got if r["doc_id"] == 1 and r["source"] == "a")
    assert ordinals == list(range(1000))
    taken, out = collections.Counter(), collections.Counter()
    for r in got:
        taken[r["source"]] += r["taken"]
    for r in mixing.take_copies(df, mixed).collect():
        out[r["source"]] += len(tokens(r["text"]))
    for s in want:
        assert taken[s] == out[s] and abs(out[s] - want[s]) <= 0.01 * want[s], (s, taken[s], out[s], want[s])
    again = mixing.mix(documents(spark, rows).repartition(3), block_rows=128).collect()
    assert as_set(got, ["doc_id", "source", "taken"]) == as_set(again, ["doc_id", "source", "taken"])


def test_hot_equal_rows_are_numbered_in_many_parts(spark):
    rows = spark.range(20_000).selectExpr("if(id % 3 = 0, 7L, id) AS row_key")
    several = rows.groupBy("row_key").count().where("count > 1").select("row_key")
    got = mixing.numbered(rows, several).where("row_key = 7").select("ordinal").collect()
    assert sorted(r["ordinal"] for r in got) == list(range(6668))
