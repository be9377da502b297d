import random

from hypothesis import given, settings
from hypothesis import strategies as st

from tablewright.llm import decontaminate as dc

from .data import documents, odd_rows, words


def semi_global(pattern, text):
    """Least edit distance of the pattern to any stretch of the text, by the plain table."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(pattern, 1):
        new = [i]
        for j, d in enumerate(text, 1):
            new.append(min(row[j - 1] + (c != d), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


@settings(max_examples=200, deadline=None)
@given(st.text("ab c", min_size=1, max_size=12), st.text("ab c", max_size=30), st.integers(0, 6))
def test_myers_equals_table(pattern, text, most):
    want = semi_global(pattern, text)
    got = dc.myers(pattern, text, most)
    assert (got[0] if got else None) == (want if want <= most else None)


def test_pieces_cover_and_one_survives():
    for m in (1, 7, 40, 41):
        for k in range(0, min(m, 6)):
            p = dc.pieces("x" * m, k)
            assert len(p) == k + 1 and sum(len(s) for _, s in p) == m and all(s for _, s in p)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text("ab é😀", min_size=1, max_size=40), min_size=1, max_size=6), st.text("ab é😀", max_size=80),
       st.sampled_from([0.0, 0.08, 0.3]), st.sampled_from([5, 1 << 18]))
def test_hashed_pieces_give_the_hits_of_the_automaton(items, text, rate, strip):
    items, kept = list(enumerate(items)), dc.STRIP
    dc.STRIP = strip
    try:
        hashed = dc.HashedMatcher(items, rate, dc.piece_index(items, rate))
        plain = dc.Matcher(items, rate)
        assert sorted((e, *x) for e, at in hashed.hits(text) for x in at) == sorted((e, *x) for e, at in plain.hits(text) for x in at)
        assert sorted(hashed.search(text)) == sorted(plain.search(text))
    finally:
        dc.STRIP = kept


def test_leaks_equal_brute_force(spark):
    rng = random.Random(4)
    items = [(i, " ".join(words(100 + i, 12, 300))) for i in range(12)] + [(50, None), (51, ""), (52, "tiny"), (0, " ".join(words(100, 12, 300)))]
    rows = []
    for n in range(60):
        t = " ".join(words(n, 60, 300))
        if n % 3 == 0:
            item = list(items[rng.randrange(12)][1].upper())
            for _ in range(rng.randrange(0, 5)):
                at = rng.randrange(len(item))
                item[at:at + 1] = rng.choice([[], ["z"], [item[at], "q"]])
            t = t[:100] + "\n " + "".join(item) + " " + t[100:]
        rows.append((n, t))
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = {}
    for i, t in rows:
        for j, b in items:
            b, x = dc.normalise(b), dc.normalise(t)
            if b and (d := semi_global(b, x)) <= int(dc.ERROR_RATE * len(b)):
                want[i, j] = d
    assert len(want) > 10 and set(want.values()) > {0, 1}
    for block, small in ((1 << 20, 1 << 20), (150, 150), (1 << 20, 0), (700, 0)):
        got = dc.leaks(documents(spark, rows), bench, block_chars=block, automaton_chars=small).collect()
        assert {(r["doc_id"], r["item_id"]): r["distance"] for r in got} == want and len(got) == len(want)
        for r in got:
            text, item = dc.normalise(rows[r["doc_id"]][1]), dc.normalise(dict(items)[r["item_id"]])
            assert semi_global(item, text[r["start"]:r["end"]]) == r["distance"] <= r["budget"]


def test_odd_rows_and_empty(spark):
    bench = spark.createDataFrame([(1, "A null  id with some words"), (2, "equal text of two rows")], "item_id long, text string")
    got = dc.leaks(documents(spark, odd_rows()), bench).collect()
    assert sorted(((r["doc_id"], r["item_id"]) for r in got), key=str) == [(6, 2), (7, 2), (None, 1)]
    assert dc.leaks(documents(spark, []), bench).collect() == []
    assert dc.leaks(documents(spark, odd_rows()), bench.limit(0)).collect() == []


def test_ids_of_any_type(spark):
    bench = spark.createDataFrame([("first", "A null  id with some words"), (None, "equal text of two rows")], "item_id string, text string")
    docs = documents(spark, odd_rows()).withColumn("doc_id", spark_text("doc_id"))
    got = dc.leaks(docs, bench).collect()
    assert sorted(((r["doc_id"], r["item_id"]) for r in got), key=str) == [("6", None), ("7", None), (None, "first")]


def spark_text(c):
    from pyspark.sql import functions as F
    return F.col(c).cast("string")
