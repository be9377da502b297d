import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablewright.llm import divergence
from tablewright.llm.transducer import Transducer

from .data import CLASH, DOCS, words


def arrays(terms):
    off = np.r_[0, np.cumsum([len(t) for t in terms])].astype(np.int64)
    return np.frombuffer(b"".join(terms), np.uint8), off[:-1], off[1:]


def test_transducer_outputs_ranks_and_is_minimal():
    rng = random.Random(2)
    for trial in range(20):
        terms = sorted({"".join(rng.choice("abcé") for _ in range(rng.randrange(1, 9))).encode() for _ in range(150)})
        fst = Transducer.from_bytes(Transducer.build(terms).to_bytes())
        assert fst.ordinals(*arrays(terms)).tolist() == list(range(len(terms)))
        assert list(fst.terms()) == terms
        others = sorted({t[:-1] for t in terms} | {t + b"a" for t in terms} | {b"zz", b""} - set(terms))
        others = [t for t in others if t not in set(terms)]
        assert (fst.ordinals(*arrays(others)) == -1).all()
        # one state for each distinct set of endings
        ends = defaultdict(set)
        for t in terms:
            for k in range(len(t) + 1):
                ends[t[:k]].add(t[k:])
        assert len(fst.final) == len({frozenset(x) for x in ends.values()})


def test_transducer_of_no_and_one_term():
    empty = Transducer.from_bytes(Transducer.build([]).to_bytes())
    assert list(empty.terms()) == [] and (empty.ordinals(*arrays([b"a", b"bc"])) == -1).all()
    one = Transducer.build([b"abc"])
    assert list(one.terms()) == [b"abc"] and one.ordinals(*arrays([b"abc", b"ab", b"abcd"])).tolist() == [0, -1, -1]
    for bad in ([b"b", b"a"], [b"a", b"a"]):
        with pytest.raises(ValueError):
            Transducer.build(bad)


def plain(rows, min_docs, top):
    docs = []
    for lang, source, text in rows:
        lower = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        docs.append((lang or "", source or "", Counter(re.findall("[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lower))))
    df, out = defaultdict(Counter), []
    for lang, _, c in docs:
        df[lang].update(set(c))
    for lang in {d[0] for d in docs}:
        kept = sorted((t for t, n in df[lang].items() if n >= min_docs), key=lambda t: t.encode())
        group = defaultdict(Counter)
        for l, s, c in docs:
            if l == lang:
                group[s].update({t: c[t] for t in kept if c[t]})
        whole = sum((g for g in group.values()), Counter())

        def share(c):
            return {t: 1 + 10 ** 9 * (c[t] + 2) // (sum(c.values()) + 2 * len(kept)) for t in kept}
        f = lambda p, q: (p - q) ** 2 // (p + q)
        p, q = {s: share(c) for s, c in group.items()}, share(whole)
        for s in group:
            pair = sorted(((-sum(f(p[s][t], p[o][t]) for t in kept), o.encode(), o) for o in group if o != s))
            out += [(lang, s, "pair", o, -v, i + 1) for i, (v, _, o) in enumerate(pair)]
            term = sorted((-f(p[s][t], q[t]), t.encode(), t) for t in kept if group[s][t] and p[s][t] > q[t])[:top]
            out += [(lang, s, "term", t, -v, i + 1) for i, (v, _, t) in enumerate(term)]
    return sorted(out)


def table(spark, rows):
    df = spark.createDataFrame([(i, t, l, s, None) for i, (l, s, t) in enumerate(rows)], DOCS)
    return df.withColumns({c: F.lit("extra") for c in [*CLASH, "ord", "part", "term", "v", "total", "block"] if c not in df.columns})


def rows_of(df):
    return sorted(map(tuple, df.select("lang", "source", "part", "item", "value", "rank").collect()))


def corpus():
    rng = random.Random(5)
    rows = []
    for i in range(160):
        text = " ".join(w.replace("w", rng.choice(["Wort", "mot", "é", "longcommonprefix"])) + rng.choice("abc,;1") for w in words(i, 40, 40))
        rows.append((rng.choice(["de", "fr", "", None]), rng.choice(["s1", "s2", "S3", None, "é"]), text))
    rows += [("xx", "only", "alone in its language"), ("de", "quiet", "..."), ("de", "quiet", None), ("yy", "a", "x"), ("yy", "b", ""),
             ("zz", "a", "same word " * 20), ("zz", "b", "same word " * 20)]
    rows += [("fr", "copies", "mot mota motb copies of one row " * 3)] * 30 + [("fr", "long", "longcommonprefixa " * 20_000)]
    return rows


@pytest.mark.parametrize("options", [{}, {"block_terms": 7, "cells": 50}, {"block_terms": 5, "broadcast_bytes": 0, "cells": 1}])
def test_equals_plain_audit(spark, options):
    rows = corpus()
    for min_docs, top in ((3, 4), (1000, 10)):
        got = rows_of(divergence.audit(table(spark, rows), min_docs=min_docs, top=top, **options))
        assert got == plain(rows, min_docs, top)


def test_empty_table(spark):
    assert rows_of(divergence.audit(table(spark, corpus()).limit(0))) == []


def test_shares_beyond_64_bits(spark):
    counts, total = np.array([[5 * 10 ** 11, 3]]), np.array([10 ** 12])
    want = [[1 + 10 ** 9 * (c + 2) // 10 ** 12 for c in counts[0].tolist()]]
    assert divergence.shares(counts, total).tolist() == want
    df = spark.createDataFrame([(5 * 10 ** 11, 10 ** 12 - 8, 4)], "n long, total long, v long")
    assert df.select(divergence.share("n", "total", "v")).first()[0] == want[0][0]
