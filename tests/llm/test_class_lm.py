import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tablewright.llm import class_lm
from tablewright.llm.common import word_hashes, text_bytes
from tests.conftest import SF_SMALL

from .data import documents, odd_rows, tokens

END = "\0end"


def held(i, folds=10):
    return i is None or zlib.crc32(str(i).encode()) % folds == 0


def key(word):
    """The operator's hash of a word, as a signed number; 0 for the end."""
    return 0 if word == END else int(word_hashes(*text_bytes(pa.array([word])))[0].view(np.int64)[0])


def likelihood(bigrams, cls):
    n, left, right = Counter(), Counter(), Counter()
    for (a, b), c in bigrams.items():
        n[cls[a], cls[b]] += c
        left[cls[a]] += c
        right[cls[b]] += c
    f = lambda x: sum(v * math.log(v) for v in x.values() if v)
    return f(n) - f(left) - f(right)


def test_exchange_ends_at_a_local_optimum_and_finds_planted_classes():
    rng = np.random.default_rng(1)
    kind = np.r_[0, rng.integers(1, 4, 24)]
    follow = np.array([[0, 9, 1, 1], [1, 0, 40, 1], [2, 1, 0, 40], [9, 40, 1, 0]])
    bigrams = rng.poisson(follow[kind][:, kind]).astype(float)
    cls, matrix = class_lm.exchange(bigrams, 5)
    table = {(a, b): bigrams[a, b] for a in range(25) for b in range(25)}
    best = likelihood(table, cls)
    for w in range(1, 25):
        for c in (1, 2, 3):
            moved = cls.copy()
            moved[w] = c
            assert likelihood(table, moved) <= best + 1e-6
    member = np.eye(5)[cls]
    assert np.allclose(matrix, member.T @ bigrams @ member)
    pairs = [(a, b) for a in range(1, 25) for b in range(1, a)]
    assert np.mean([(kind[a] == kind[b]) == (cls[a] == cls[b]) for a, b in pairs]) > 0.95
    assert cls[0] == 0 and set(cls[1:]) <= {1, 2, 3}


def test_place_picks_the_class_of_the_largest_likelihood():
    rng = np.random.default_rng(2)
    k = 6
    matrix = rng.integers(0, 50, (k, k)).astype(float)
    word, ctx, n = [], [], []
    for w in range(40):
        for c in sorted(rng.choice(2 * k, rng.integers(1, 6), replace=False)):
            word.append(w), ctx.append(c), n.append(float(rng.integers(1, 9)))
    got = class_lm.place(matrix, np.array(word), np.array(ctx), np.array(n), 40)
    for w in range(40):
        def joined(b):
            m = {(i, j): matrix[i, j] for i in range(k) for j in range(k)}
            m = Counter(m)
            for x, c, v in zip(word, ctx, n):
                if x == w:
                    m[(c, "w") if c < k else ("w", c - k)] += v
            return likelihood(m, {**{i: i for i in range(k)}, "w": b})
        scores = [joined(b) for b in range(1, k - 1)]
        assert scores[got[w] - 1] >= max(scores) - 1e-6


def plain(rows, classes, prior, word_class):
    """Scores from the definition, given the classes of the words."""
    texts = [(i, tokens(t) + [END]) for i, t in rows]
    train = [t for i, t in texts if not held(i)]
    c = Counter(w for t in train for w in t)
    total = sum(c.values()) + 0.1 * (len(c) + 1)
    n, big, size, words = sum(c.values()), Counter(), Counter(), Counter()
    for t in train:
        big.update(zip([word_class(w) for w in [END] + t], [word_class(w) for w in t]))
    for w, v in c.items():
        size[word_class(w)] += v
        words[word_class(w)] += 1
    context = Counter()
    for (a, _), v in big.items():
        context[a] += v
    unseen = 0.1 / total
    out = []
    for i, t in texts:
        base = score = 0.0
        for a, w in zip([END] + t, t):
            base += math.log10((c[w] + 0.1) / total)
            if not c[w]:
                score += math.log10(unseen)
                continue
            a, b = word_class(a) if c[a] else None, word_class(w)
            mass = size[b] + 0.1 * words[b]
            score += math.log10((1 - unseen) * (big[a, b] + prior * mass / total / (1 - unseen)) / (context[a] + prior))
            score += math.log10((c[w] + 0.1) / mass)
        out.append((i, held(i), len(t), sum(c[w] > 0 for w in t), n, base, score))
    return out


def corpus():
    rng = random.Random(9)
    rows = odd_rows()
    for i in range(100, 260):
        text, state = [], 0
        for _ in range(rng.randrange(0, 40)):
            state = rng.choice([(state + 1) % 3] * 5 + [rng.randrange(3)])
            text.append(f"{'xyz'[state]}{min(rng.randrange(60), rng.randrange(60))}".upper() if rng.random() < 0.2
                        else f"{'xyz'[state]}{min(rng.randrange(60), rng.randrange(60))}")
        rows.append((i, " ".join(text)))
    return rows + [(300 + i, "never seen " * 5 + f"u{i} u{i} x1") for i in range(40) if held(300 + i)]


@pytest.mark.parametrize("frequent", [1 << 20, 30, 0])
def test_scores_equal_the_definition(spark, frequent):
    rows = [(r[0], r[1]) for r in corpus()]
    docs = documents(spark, rows)
    model = class_lm.train(docs.where(~class_lm.held_out(docs["doc_id"])), classes=6, core=12, frequent=frequent, prior=5.0)
    cls = {r["w"]: r["cls"] for r in model.lexicon.collect()}
    got = class_lm.score_held_out(docs, classes=6, core=12, frequent=frequent, prior=5.0).collect()
    want = plain(rows, 6, 5.0, lambda w: cls.get(key(w)))
    assert cls[0] == 0 and set(cls.values()) <= set(range(6)) and len([c for c in cls.values() if c == 0]) == 1
    order = lambda r: (repr(r[0]), r[2], round(r[5], 6))
    got, want = sorted(map(tuple, got), key=order), sorted(want, key=order)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert np.allclose([g[5:7] for g in got], [w[5:7] for w in want], atol=1e-6)
    assert np.allclose([g[7] for g in got], [10 ** (-w[6] / w[2]) for w in want])


def test_probabilities_add_up_to_one(spark):
    docs = documents(spark, corpus())
    model = class_lm.train(docs, classes=6, core=12)
    assert np.allclose((10.0 ** model.step[:, :]).sum(1)[[0, 1, 2, 3, 4, 6]], 1)
    assert abs(sum((model.counts + 0.1) / model.mass[model.cls] * (10.0 ** model.step[1])[model.cls]) + 10.0 ** model.step[1, -1] - 1) < 1e-9


def test_empty_tables(spark):
    docs = documents(spark, corpus())
    model = class_lm.train(docs.limit(0))
    got = class_lm.score(docs, model).collect()
    assert len(got) == docs.count() and all(r["score"] == r["base_score"] == 0 and r["n_known"] == 0 for r in got)
    assert class_lm.score_held_out(docs.limit(0)).collect() == []


def test_held_out_texts_are_likelier_than_by_single_words(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = class_lm.score_held_out(docs).where("held_out").collect()
    per = lambda c: sum(r[c] for r in rows) / sum(r["n_tokens"] for r in rows)
    assert per("score") > per("base_score") + 0.1
