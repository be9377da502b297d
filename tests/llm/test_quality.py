import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tablewright.llm import quality as q
from tablewright.llm.common import text_bytes

from .data import documents, odd_rows, words


def good(seed, n=150):
    return " ".join(w.replace("w", "word") for w in words(seed, n)) + "."


def bad(seed, n=150):
    return " ".join(w.upper() + "!!&&" for w in words(seed, n))


def tables(spark, n=300):
    rows = [(i, bad(i) if i % 4 == 0 else good(i)) for i in range(n)]
    marks = spark.createDataFrame([(i, int(i % 4 != 0), 0) for i in range(n)], "doc_id long, quality int, toxic int")
    return documents(spark, rows), marks


def test_learns_and_ignores_held_out_labels(spark):
    docs, marks = tables(spark)
    model = q.train(docs, marks)
    got = q.score(docs, model).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got)
    out = [r for r in got if r["held_out"]]
    assert len(out) > 30 and np.mean([r["predicted"] == (r["doc_id"] % 4 != 0) for r in out]) > 0.97
    flipped = marks.withColumn("quality", F.when(q.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    other = q.train(docs, flipped)
    assert all(np.array_equal(model.params[k], other.params[k]) for k in model.params)


def test_a_bad_passage_draws_attention():
    """Labels are of documents only; attention must find the passage that decides."""
    rng = np.random.default_rng(2)
    texts, y = [], []
    for i in range(400):
        parts = [good(1000 + 10 * i + k, 96) for k in range(4)]
        y.append(i % 2)
        if i % 2 == 0:
            parts[rng.integers(4)] = bad(i, 96)
        texts.append(" ".join(parts))
    x, poff = q.passages(*text_bytes(pa.array(texts)))
    assert np.diff(poff).tolist() == [4] * 400
    cut = poff[300]
    model = q.fit(x[:cut], poff[:301], np.array(y[:300], float))
    f = model.forward(x[cut:], poff[300:] - cut)
    assert np.mean((f["y"] >= 0.5) == np.array(y[300:])) > 0.95


def test_gradients_match_differences():
    rng = np.random.default_rng(0)
    x, poff = rng.normal(size=(9, q.FEATURES)), np.array([0, 2, 3, 9])
    y, w = np.array([1.0, 0.0, 1.0]), np.array([1.0, 2.0, 0.5])
    model = q.fit(x, poff, y, epochs=1)

    def loss():
        s = model.forward(x, poff)["y"]
        return -(w * (y * np.log(s) + (1 - y) * np.log(1 - s))).mean()
    g = model.gradients(model.forward(x, poff), y, w, 0.0)
    for k in ("E", "V", "U", "w", "c", "e"):
        at = tuple(0 for _ in model.params[k].shape)
        keep = model.params[k].copy()
        model.params[k] = keep.copy()
        model.params[k][at] += 1e-5
        up = loss()
        model.params[k][at] -= 2e-5
        down = loss()
        model.params[k] = keep
        assert abs((up - down) / 2e-5 - g[k][at]) < 1e-5, k


def test_odd_rows_empty_and_no_choice(spark):
    docs, marks = tables(spark, 80)
    model = q.train(docs, marks)
    odd = documents(spark, odd_rows())
    got = q.score(odd, model).collect()
    assert len(got) == len(odd_rows()) and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in got)
    assert [r["held_out"] for r in got if r["doc_id"] is None] == [False, False]
    assert q.score(documents(spark, []), model).collect() == []
    assert q.accepted(odd, model).columns == odd.columns
    none = marks.limit(0)
    assert q.train(docs, none) == 0.5
    assert q.train(docs, marks.where("quality = 1").unionByName(marks.where("quality is null"))) > 0.9
    assert {r["score"] for r in q.score(odd, 0.5).collect()} == {0.5}
    assert q.accepted(odd, 0.5).count() == len(odd_rows()) and q.accepted(odd, 0.2).count() == 0
    assert q.train(documents(spark, []), none) == 0.5


def test_repeated_and_conflicting_labels(spark):
    docs, marks = tables(spark, 60)
    assert isinstance(q.train(docs, marks.unionByName(marks)), q.AttentionModel)


def bags_of_fit(monkeypatch):
    """Where ``fit`` is called, the passage counts of its bags and their labels."""
    seen = []
    fit = q.fit

    def spy(x, poff, y, seed):
        seen.append((np.diff(poff).tolist(), y.tolist()))
        return fit(x[:poff[4]], poff[:5], np.array([0.0, 1, 0, 1]), seed, epochs=1)
    monkeypatch.setattr(q, "fit", spy)
    return seen


def seen_ids(n):
    """Ids whose labels are read."""
    return [i for i in range(10 * n) if zlib.crc32(str(i).encode()) % 5][:n]


def test_fit_reads_every_passage_of_long_texts(spark, monkeypatch):
    seen, ids = bags_of_fit(monkeypatch), seen_ids(8)
    long = " ".join(words(3, 60 * q.PASSAGE_WORDS))
    df = documents(spark, [(i, long + f" {i}") for i in ids])
    q.train(df, spark.createDataFrame([(i, n % 2) for n, i in enumerate(ids)], "doc_id long, quality int"))
    assert seen[0][0] == [61] * 8


def test_fit_is_bounded_by_rows(spark, monkeypatch):
    seen, ids = bags_of_fit(monkeypatch), seen_ids(10)
    rows = [(i, f"text of {i}") for i in ids] + [(ids[0], f"another text {k}") for k in range(200)] + [(ids[1], f"text of {ids[1]}")] * 50
    labels = spark.createDataFrame([(i, n % 2) for n, i in enumerate(ids)], "doc_id long, quality int")
    q.train(documents(spark, rows), labels, max_documents=12)
    assert len(seen[0][1]) == 12 and sum(seen[0][1]) == 5      # every id, two more texts of the first
    q.train(documents(spark, rows), labels)
    assert len(seen[1][1]) == 210
