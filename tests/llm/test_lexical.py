import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from tablewright.llm import lexical
from tablewright.llm.kernels import Lookup, Tally
from tests.conftest import SF_SMALL

from .data import documents, odd_rows, words


def terms(text):
    lower = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return re.findall("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower)


def plain(rows, items, k=20):
    docs = [(r[0], Counter(terms(r[1]))) for r in rows]
    docs = [(i, c, sum(c.values())) for i, c in docs if c]
    corpus, length = len(docs), sum(n for _, _, n in docs)
    df = Counter(t for _, c, _ in docs for t in c)
    out = []
    for item, text in set(items):
        scored = []
        for i, c, n in docs:
            m = 100 - 25 + (25 * n * corpus) // length
            s = sum(math.floor(1000 * math.log((2 * corpus + 2) / (2 * df[t] + 1))) * (10 ** 9 * c[t] // (1000 * c[t] + 12 * m))
                    for t in terms(text) if c[t])
            if s > 0:
                scored.append((-s, i is None, i or 0, i))
        out += [(item, rank + 1, i, -s) for rank, (s, _, _, i) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=repr)


def rows_of(df):
    return sorted(map(tuple, df.select("item_id", "rank", "doc_id", "score").collect()), key=repr)


def items_table(spark, items):
    return spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "'x' AS q", "1 AS rank")


@pytest.mark.parametrize("block_docs", [3, 1 << 16])
def test_equals_plain_ranking_with_odd_rows(spark, block_docs):
    rng = random.Random(4)
    rows = odd_rows() + [(100 + i, " ".join(words(i, rng.randrange(1, 60), 90)).title()) for i in range(120)]
    rows += [(300 + i, "Équal tie text, of é words; wöürter 12 w3 w3") for i in range(30)]
    items = [(i, " ".join(words(1000 + i, 12, 90))) for i in range(8)]
    items += [(50, "w3 w3 W3 wöürter, ÉQUAL équal"), (51, None), (52, ""), (53, "nowhere found"), (None, "w5 w6"),
              (50, "another text of one id w9"), (54, "repeated row here")]
    got = rows_of(lexical.ranked(documents(spark, rows), items_table(spark, items + items[:2]), block_docs=block_docs))
    assert got == plain(rows, items)
    small = lexical.ranked(documents(spark, rows), items_table(spark, items), item_bytes=100, k=3)
    assert rows_of(small) == plain(rows, items, 3)


def test_equals_plain_ranking_on_the_tables(spark):
    docs, items = (spark.read.parquet(f"{SF_SMALL}/{t}.parquet") for t in ("documents", "benchmark"))
    want = plain([(r["doc_id"], r["text"]) for r in docs.collect()], [(r["item_id"], r["text"]) for r in items.collect()])
    assert rows_of(lexical.ranked(docs, items)) == want


def test_empty_tables(spark):
    docs, items = documents(spark, [(1, "some words")]), items_table(spark, [(1, "some words")])
    assert not lexical.ranked(docs.limit(0), items).collect()
    assert lexical.ranked(docs, items.limit(0)).columns == ["item_id", "rank", "doc_id", "score"]


def test_accumulators_are_limited_and_survivors_exact():
    """A rare term decides: documents that hold only the common one open no accumulator."""
    docs = 10_000
    doc = np.r_[np.arange(40), np.arange(docs)]
    term = np.r_[np.zeros(40, int), np.ones(docs, int)]
    index = lexical.BlockIndex(doc, term, np.r_[np.arange(40) + 1000, np.arange(docs) % 7 + 1], docs, 2)
    at, score = index.best([(0, 100), (1, 1)], 20)
    assert index.opened == 40
    want = {d: (1000 + d) * 100 + d % 7 + 1 for d in range(40)}
    assert list(zip(at, score)) == sorted(want.items(), key=lambda x: (-x[1], x[0]))[:20]
    assert not index.open.any() and not index.score.any()


def test_wide_numbers():
    n = np.array([10 ** 9, 5], np.int64)
    assert lexical.norms(n, 10 ** 11, 10 ** 13).tolist() == [75 + 25 * x * 10 ** 11 // 10 ** 13 for x in n.tolist()]
    tf = np.array([1 << 40], np.int64)
    assert lexical.impacts(tf, np.array([10 ** 9])).tolist() == [10 ** 9 * (1 << 40) // (1000 * (1 << 40) + 12 * 10 ** 9)]


def test_kernels():
    rng = np.random.default_rng(3)
    keys = np.unique(rng.integers(0, 1 << 63, 5000).astype(np.uint64) * np.uint64(2))
    probe = np.concatenate([keys[::3], rng.integers(0, 1 << 63, 1000).astype(np.uint64) | np.uint64(1)])
    at = Lookup(keys).find(probe)
    assert (at[:len(keys[::3])] == np.arange(0, len(keys), 3)).all() and (at[len(keys[::3]):] == -1).all()
    assert (Lookup(keys[:0]).find(probe) == -1).all()
    tally, out = Tally(100), Counter()
    data = rng.integers(0, 150, 5000)
    for part in np.array_split(data, 50):
        for k, c in tally.add(part):
            out.update(dict(zip(k.tolist(), c.tolist())))
    for k, c in tally.rest():
        out.update(dict(zip(k.tolist(), c.tolist())))
    assert out == Counter(data.tolist())
