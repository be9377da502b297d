import hashlib
import random

from hypothesis import given, settings
from hypothesis import strategies as st

from tablewright.llm import edit_embedding as ee

from tests.conftest import SF_ORACLE

from .data import documents, odd_rows, words

WALKERS = [ee.Walker(17 + i) for i in range(ee.WALKS)]
WALKER = ee.Walker()


def walk(text):
    """The embedding of a text, one step at a time."""
    symbols = [((ord(c) * 2654435761) % 2**32 >> 8) % 255 + 1 for c in text] + [0]
    at, out = 0, []
    for j in range(3 * len(text)):
        out.append(symbols[at])
        at += int(WALKER.bits[j % ee.PERIOD][symbols[at]])
    return out


def test_lockstep_equals_single_walks():
    texts = [" ".join(words(i, 3 + i * 7)) + "é\0😀" for i in range(60)] + ["", "a", "ab", " " * 70]
    got, last = WALKER.samples(texts)
    for t, row, o in zip(texts, got, last):
        full = walk(t)
        steps = [int(s) for k in range(len(full).bit_length()) for s in ee._positions(k)]
        assert [int(v) for v in row[:len(steps)]] == [full[s] if s < len(full) else 0 for s in steps]
        assert not row[len(steps):].any() and o == len(full).bit_length() - 1
    prints = ee.fingerprints(WALKER, texts)
    assert prints == [ee.fingerprints(WALKER, [t])[0] for t in texts]


def test_likeness_falls_with_edits():
    rng = random.Random(1)
    base = " ".join(words(5, 500))
    mean = []
    for edits in (0, 5, 40, 400):
        total = 0
        for _ in range(20):
            t = list(base)
            for _ in range(edits):
                t[rng.randrange(len(t))] = rng.choice("xyz")
            total += ee.likeness(*ee.fingerprints(WALKER, [base, "".join(t)]))
        mean.append(total / 20)
    assert mean[0] == 1 and mean[0] > mean[1] > mean[2] > mean[3] and mean[1] > 0.9
    assert ee.likeness("-", "-") == 1 and ee.likeness("-", ee.fingerprints(WALKER, ["abc"])[0]) == 0


@settings(max_examples=150, deadline=None)
@given(st.text("abc", max_size=10), st.text("abc", max_size=10))
def test_edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, c in enumerate(a, 1):
        new = [i]
        for j, d in enumerate(b, 1):
            new.append(min(row[j - 1] + (c != d), row[j] + 1, new[-1] + 1))
        row = new
    assert ee.edit_distance(a, b) == row[-1]


def expected(rows):
    order = sorted(rows, key=lambda r: -r[0])
    out = {}
    for n, (i, t) in enumerate(order):
        t, u = t or "", order[(n + 1) % len(order)][1] or ""
        h = len(t) // 2
        out[i] = (len(t), hashlib.sha256((t[:len(t) - h] + u[:h]).encode()).hexdigest())
    return out


def test_neighbours_over_many_buckets(spark):
    rng = random.Random(3)
    ids = rng.sample(range(-500, 5000), 200)
    rows = [(i, " ".join(words(i, rng.randrange(0, 60))) + "ü") for i in ids] + [(9000, None), (9001, "")]
    for bucket in (200, 1 << 30):
        got = ee.edited_neighbours(documents(spark, rows), bucket_bytes=bucket).collect()
        assert {r["doc_id"]: (r["n_chars"], r["edited_sha256"]) for r in got} == expected(rows) and len(got) == len(rows)
    prints = {t: ee.fingerprints(WALKER, [t or ""])[0] for _, t in rows}
    order = sorted(rows, key=lambda r: -r[0])
    nxt = {i: prints[order[(n + 1) % len(order)][1]] for n, (i, _) in enumerate(order)}
    for r in got:
        assert r["fingerprint"] == prints[dict(rows)[r["doc_id"]]]
        assert r["near_next"] == ee.likeness(r["fingerprint"], nxt[r["doc_id"]])
        assert r["near_edited"] == ee.likeness(r["fingerprint"], r["edited_fingerprint"])


def test_odd_rows_lone_and_empty(spark):
    got = ee.edited_neighbours(documents(spark, odd_rows())).collect()
    assert len(got) == len(odd_rows())
    five = [r for r in got if r["doc_id"] == 5]
    assert five[0] == five[1] or {r["near_next"] for r in five} != set()
    lone = ee.edited_neighbours(documents(spark, [(1, "abcd")])).collect()
    assert [(r["near_edited"] <= 1, r["near_next"]) for r in lone] == [(True, 1.0)]
    assert lone[0]["edited_sha256"] == hashlib.sha256(b"abab").hexdigest()
    assert ee.edited_neighbours(documents(spark, [])).collect() == []


def test_near_classes(spark):
    base = [" ".join(words(s, 60)) for s in range(5)]
    rows = [(10 * s + k, t[:20 * k] + "#" * k + t[20 * k:]) for s, t in enumerate(base) for k in range(4)]
    rows += [(100, None), (101, ""), (None, "x")]
    got = {r["doc_id"]: r["class_id"] for r in ee.near_classes(documents(spark, rows)).collect()}
    assert got == {**{i: i - i % 10 for i, _ in rows[:20]}, 100: 100, 101: 100}
    assert ee.near_classes(documents(spark, [])).collect() == []


def edited(text, rate, rng):
    """A text after ``rate`` random edits a character: substitutions, insertions and deletions."""
    t = list(text)
    for _ in range(int(rate * len(t))):
        at = rng.randrange(len(t))
        t[at:at + 1] = rng.choice([["#"], [t[at], "#"], []])
    return "".join(t)


def test_candidates_at_the_full_rate():
    rng = random.Random(11)
    for size in (4, 12, 30, 60, 300):
        base = [" ".join(words(1000 * size + i, size)) for i in range(60)]
        other = [edited(t, 0.1, rng) for t in base]
        keys = [[set(ee.candidate_keys(p)) for p in zip(*(ee.fingerprints(w, x) for w in WALKERS))] for x in (base, other)]
        met = [bool(a & b) for a, b in zip(*keys)]
        assert sum(met) >= 59, (size, sum(met))
        pairs = ee.Pairs(base[:20] + other[:20], 0.1)
        for i in range(20):
            for j in range(20, 40):
                a, b = pairs.texts[i], pairs.texts[j]
                assert pairs.near(i, j) == (ee.edit_distance(a, b) <= 0.1 * max(len(a), len(b)))


def test_bands_tell_texts_apart(spark):
    """On documents of the tables: recall at every rate by bands alone, few unlike pairs, no band past a text's end."""
    docs = spark.read.parquet(f"{SF_ORACLE}/documents.parquet").where("n_chars between 300 and 4000").orderBy("doc_id").limit(60).collect()
    base = [r["text"] for r in docs]

    def keys(texts):
        return [set(ee.candidate_keys(p)) for p in zip(*(ee.fingerprints(w, texts) for w in WALKERS))]
    mine = keys(base)
    assert not any(k.endswith(":000000") for ks in mine for k in ks)
    shared = sum(bool(mine[i] & mine[j]) for i in range(60) for j in range(i) if ee.likeness(*ee.fingerprints(WALKER, [base[i], base[j]])) < 0.5)
    assert shared <= 0.05 * 1770
    for rate in (0.01, 0.03, 0.05, 0.1):
        rng = random.Random(5)
        assert sum(bool(a & b) for a, b in zip(mine, keys([edited(t, rate, rng) for t in base]))) >= 56, rate


def test_links_beside_an_unlike_smallest_member(spark):
    rng, rows, want = random.Random(5), [], {}
    for g in range(6):
        head, tail = " ".join(words(g, 300)), " ".join(words(100 + g, 150))
        b, c = head + tail, head + edited(tail, 0.2, rng)
        assert ee.edit_distance(b, c) <= 0.1 * max(len(b), len(c))
        rows += [(10 * g, head + " ".join(words(200 + g, 150))), (10 * g + 1, b), (10 * g + 2, c)]
        want |= {10 * g: 10 * g, 10 * g + 1: 10 * g + 1, 10 * g + 2: 10 * g + 1}
    got = {r["doc_id"]: r["class_id"] for r in ee.near_classes(documents(spark, rows)).collect()}
    assert got == want
