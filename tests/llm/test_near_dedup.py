import random

import numpy as np
import pytest

from tablewright.llm import near_dedup as nd
from tablewright.llm.common import text_bytes

from .data import documents, odd_rows, tokens, words


def shingles(text, k):
    w = tokens(text)
    return frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])


def brute(rows, k):
    sets = {i: shingles(t, k) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    ids = sorted(sets)
    for n, i in enumerate(ids):
        for j in ids[:n]:
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


def near_copies(seed, n, length=60, edits=3):
    """A family whose members differ from a base in a few words each: links near the threshold."""
    rng = random.Random(seed)
    base = words(seed, length)
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(rng.randrange(edits + 1)):
            w[rng.randrange(length)] = f"v{rng.randrange(10_000)}"
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize("k", [2, 5])
def test_components_equal_brute_force(spark, k):
    texts = near_copies(3, 60) + near_copies(4, 40, edits=6) + [" ".join(words(s, 40)) for s in range(10, 60)]
    texts += texts[:5] + ["one", "One", "two words", ""]
    rng = random.Random(9)
    ids = rng.sample(range(1000), len(texts))
    rows = list(zip(ids, texts))
    got = nd.near_duplicates(documents(spark, rows), words=k).collect()
    want = brute(rows, k)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == want
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_blocks_meet_every_pair(spark):
    """With blocks of a few rows the result stays the same."""
    rows = list(enumerate(near_copies(5, 50, edits=7)))
    df = documents(spark, rows)
    real = nd._in_blocks
    try:
        nd._in_blocks = lambda side: real(side, most_rows=7)
        got = {r["doc_id"]: r["component_id"] for r in nd.near_duplicates(df, words=2, leader_rounds=1).collect()}
    finally:
        nd._in_blocks = real
    assert got == {i: c for i, (_, c) in brute(rows, 2).items()}


def test_odd_rows(spark):
    got = nd.near_duplicates(documents(spark, odd_rows()), words=2).collect()
    assert len(got) == len(odd_rows())
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], []).append(r)
    assert [(r["component_id"], r["kept"]) for r in by[None]] == [(None, True)] * 2
    for i in (1, 2, 3):
        assert (by[i][0]["n_shingles"], by[i][0]["component_id"], by[i][0]["kept"]) == (0, i, True)
    assert [r["component_id"] for r in by[5]] == [5, 5] and by[7][0]["component_id"] == 6 and not by[7][0]["kept"]
    assert by[8][0]["n_shingles"] == by[9][0]["n_shingles"] == 1
    one = nd.one_per_component(documents(spark, odd_rows()), words=2)
    left = sorted((r["doc_id"] for r in one.collect()), key=lambda x: (x is None, x))
    assert left == [1, 2, 3, 4, 5, 6, 8, 9, None, None] and one.columns == documents(spark, []).columns


def test_empty_table(spark):
    assert nd.near_duplicates(documents(spark, [])).collect() == []
    assert nd.one_per_component(documents(spark, [])).collect() == []


def test_odd_sketch_estimates_and_limit():
    """Sketch distances grow with dissimilarity, and pairs at the threshold stay under the limit."""
    import pyarrow as pa
    limit, seen = nd.sketch_limit(200, 0.8), {}
    for share in (0.95, 0.8, 0.3):
        d = []
        for seed in range(60):
            n = 300
            same = [f"a{seed}x{i}" for i in range(int(n * 2 * share / (1 + share)))]
            a = same + [f"b{seed}x{i}" for i in range(n - len(same))]
            b = same + [f"c{seed}x{i}" for i in range(n - len(same))]
            s, o = nd.shingle_sets(*text_bytes(pa.array([" ".join(a), " ".join(b)])), 1)
            k = nd.odd_sketch(nd.minhash(s, o, 200, 1)).view(np.uint64)
            d.append(int(np.bitwise_count(k[0] ^ k[1]).sum()))
        seen[share] = d
    assert np.mean(seen[0.95]) < np.mean(seen[0.8]) < np.mean(seen[0.3])
    assert max(seen[0.8]) <= limit < np.mean(seen[0.3]) + 20


def test_common_counts():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 300, 80)).astype(np.int64) for _ in range(20)]
    got = nd.common_counts(sets, np.arange(20), columns=16)
    assert got.tolist() == [[len(np.intersect1d(a, b)) if i != j else int(np.isin(a, np.concatenate(
        sets[:i] + sets[i + 1:])).sum()) for j, b in enumerate(sets)] for i, a in enumerate(sets)]


def test_connected_components(spark):
    from tablewright.llm.graph import connected_components
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(40)] + [(rng.randrange(100, 200), rng.randrange(100, 200)) for _ in range(60)] + [(7, 7)]
    got = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x
    for a, b in edges:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    assert got == {x: find(x) for x in root if any(x in e and e[0] != e[1] for e in edges)}


def brute_rows(rows, k, by_id):
    """Component of every row: rows are linked by their sets and, with ``by_id``, by their ids."""
    sets = [shingles(t, k) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and (100 * len(a & b) >= 80 * len(a | b) or by_id and rows[i][0] == rows[j][0]):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return sets, [find(i) for i in range(len(rows))]


def shared_ids():
    """Twenty families of near copies whose rows share ids at random, with unlike, equal and empty texts."""
    out = []
    for seed in range(20):
        rng = random.Random(seed)
        texts = near_copies(seed, 12, edits=6) + [" ".join(words(100 + seed, 30)), "", None] + near_copies(500 + seed, 4)
        texts += texts[:3]
        out += [(100 * seed + rng.randrange(12), t) for t in texts]
    return out


def test_rows_that_share_an_id_lose_no_link(spark):
    rows = shared_ids()
    for turn in range(2):           # the same in every run
        got = nd.near_duplicates(documents(spark, rows).repartition(3 + turn), words=2).collect()
        sets, roots = brute_rows(rows, 2, True)
        first = {}
        for (i, _), r in zip(rows, roots):
            first[r] = min(first.get(r, i), i)
        want = sorted((i, len(s), first[r] if s else i) for (i, _), s, r in zip(rows, sets, roots))
        assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == want
    # the same texts and links as small cases
    a, b = words(900, 60), words(901, 60)
    rows = [(1, " ".join(a)), (1, " ".join(b)), (2, " ".join(b + ["more"])), (3, " ".join(a + ["more"])), (1, "")]
    got = {(r["doc_id"], r["component_id"]) for r in nd.near_duplicates(documents(spark, rows), words=2).collect()}
    assert got == {(1, 1), (2, 1), (3, 1)}
    left = nd.one_per_component(documents(spark, rows), words=2).collect()
    assert sorted((r["doc_id"], r["text"]) for r in left) == sorted([rows[0], rows[1], rows[4]])


def test_one_per_component_keeps_unlike_texts_of_one_id(spark):
    rows = shared_ids()
    left = [(r["doc_id"], r["text"]) for r in nd.one_per_component(documents(spark, rows), words=2).collect()]
    sets, roots = brute_rows(rows, 2, False)
    assert sum(not shingles(t, 2) for _, t in left) == sum(not s for s in sets)
    of = {x: r for x, r, s in zip(rows, roots, sets) if s}
    groups = {}
    for x, r in of.items():
        groups.setdefault(r, []).append(x)
    kept = [x for x in left if x in of]
    assert sorted(of[x] for x in kept) == sorted(groups)            # one row of each group of linked texts
    assert all(x[0] == min(i for i, _ in groups[of[x]]) for x in kept)
