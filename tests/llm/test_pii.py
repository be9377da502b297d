import hashlib
import math
import random
import re

import pytest

from tablewright.llm import pii
from tests.conftest import SF_ORACLE

from .data import documents, odd_rows

PLAIN = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
         ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")]


def luhn(d):
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d))) % 10 == 0


def plain(text):
    out = []
    for kind, pattern in PLAIN:
        for m in re.finditer(pattern, text or ""):
            d = re.sub("[^0-9]", "", m.group())
            if (kind == "email" or kind == "ip" and all(int(x) <= 255 for x in m.group().split("."))
                    or kind == "card" and 16 <= len(d) <= 19 and luhn(d) or kind == "phone" and 8 <= len(d) <= 15):
                out.append((kind, m.start(), m.end()))
    return out


TEXTS = ["mail a.b@c.de, a@b.c_d@e.f and @x.y a@b..c a@b-.c- é😀 q%+@1.2.3", "1.2.3.4 256.1.1.1 1.2.3.4.5.6.7.8 001.02.3.000255 1.2.3 0.0.0.0",
         "4111 1111 1111 1111 and 4111-1111-1111-1112, 4111111111111111-4, 6011000990139424 1 2 3", "+1 (555) 010-9999 +49.30.1234567 +1 2 +123456789012345678 ++1-800-5555 5",
         "12345 4111111111111111 7", "x" * 3000 + "@a.b " + "9" * 20000 + " " + "1 " * 9000 + "+" + "1" * 5000, "", None,
         "a@b.c" * 50, "+1.2.3.4@5.6.7.8 4111 1111 1111 1111.5.6.7"]


@pytest.fixture(scope="module")
def found(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(None, "z@z.org"), (50, "r@r.org"), (50, "r@r.org")]
    return rows, pii.digest_columns(pii.sanitise(documents(spark, rows))).collect()


def test_base_spans_equal_plain_scan(found):
    rows, got = found
    assert len(got) == len(rows)
    want = sorted((repr(i), hashlib.sha256(s.encode()).hexdigest(), s) for i, t in rows
                  for s in [",".join(f"{k}:{a}:{b}" for k, a, b in plain(t))])
    base = lambda r: ",".join(s for s in r["spans"].split(",") if not s.startswith("term:"))
    assert sorted((repr(r["doc_id"]), r["base_sha256"], base(r)) for r in got) == want
    assert all(r["spans"].startswith(base(r)) for r in got)     # terms follow the base spans
    for r in got:
        kinds = [s.split(":")[0] for s in r["spans"].split(",") if s]
        starts = [int(s.split(":")[1]) for s in r["spans"].split(",") if s.startswith("term:")]
        assert starts == sorted(starts)
        assert [r[f"n_{k}"] for k in pii.KINDS] == [kinds.count(k) for k in pii.KINDS]


def corpus():
    """A code name goes with one address and nothing else; a common word goes with everything."""
    rows = [(i, f"text {i} project Zeppelin lead is eve@corp.org, contact number 777 today") for i in range(4)]
    rows += [(10 + i, f"text {i} the contact today is p{i}@corp.org and nothing else of note number {i}") for i in range(30)]
    rows += [(100 + i, f"no data here but the usual words contact today number text {i}") for i in range(200)]
    rows += [(400 + i, "once only Unicorn and bob@corp.org") for i in range(5)]     # one text, copied
    return rows


def test_revealing_terms_are_disclosed(spark):
    df = documents(spark, corpus())
    found = pii.detect(df)
    got = {(r["entity"], r["term"]): r["action"] for r in pii.disclosures(df, found, support=3).collect()}
    assert got[("email:eve@corp.org", "zeppelin")] == "remove" and got[("email:eve@corp.org", "777")] == "remove"
    assert not any(t in ("contact", "today", "text", "unicorn") or "bob" in e for e, t in got)
    out = {r["doc_id"]: r for r in pii.sanitise(df, support=3).collect()}
    clean = out[0]["clean_text"]
    assert "Zeppelin" not in clean and "777" not in clean and "[EMAIL]" in clean and "contact" in clean
    assert out[100]["clean_text"] is None and out[400]["clean_text"] == "once only Unicorn and [EMAIL]"
    text = corpus()[0][1]
    assert {text[s["start"]:s["end"]] for s in out[0]["disclosed"]} >= {"Zeppelin", "777"}


def test_disclosure_values_equal_brute_force(spark):
    rows = corpus()
    df = documents(spark, rows)
    n = len(rows)
    terms = {i: {w for w in re.split(r"[\W_]+", t.lower()) if len(w) >= 3} for i, t in rows}
    for r in pii.disclosures(df, pii.detect(df), window=10_000, support=3, generalise_at=0.0, doubt=math.inf).collect():
        e = r["entity"].split(":", 1)[1]
        with_e = [i for i, t in rows if e in t.lower()]
        c = sum(r["term"] in {w for w in re.split(r"[\W_]+", re.sub(r"\S+@[\w.]+", " ", t.lower())) if len(w) >= 3}
                for i, t in rows if i in with_e)
        n_t = sum(r["term"] in s for s in terms.values())
        want = math.log2(n * c / (len(with_e) * n_t)) / math.log2(n / len(with_e))
        assert abs(r["disclosure"] - want) < 1e-9, r


def test_one_text_is_no_evidence_by_default(spark):
    df = documents(spark, corpus())
    got = {(r["entity"], r["term"]): r["action"] for r in pii.disclosures(df, pii.detect(df)).collect()}
    assert got[("email:eve@corp.org", "zeppelin")] == "remove" and not any("bob" in e for e, _ in got)
    assert not any(t in ("contact", "today") for _, t in got)
    got = {(r["entity"], r["term"]): r["action"] for r in pii.disclosures(df, pii.detect(df), support=1, doubt=math.inf).collect()}
    assert got[("email:bob@corp.org", "unicorn")] == "remove"
    alone = documents(spark, [(1, "mail bob@x.org about Zebra Quine at noon"), *[(9 + i, f"plain words {i}") for i in range(200)]])
    assert {r["clean_text"] for r in pii.sanitise(alone).collect()} == {None, "mail [EMAIL] about Zebra Quine at noon"}


def test_chance_is_no_evidence(spark):
    """Entities in a tenth of all texts, random rare words: what meets is chance, and little of it is disclosed."""
    rng = random.Random(8)
    rows = [(i, " ".join([f"w{rng.randrange(6000)}" for _ in range(30)] + [f"m{e}@x.org" for e in range(5) if rng.random() < 0.1]))
            for i in range(400)]
    df = documents(spark, rows)
    assert pii.disclosures(df, pii.detect(df), doubt=math.inf).count() > 20
    assert pii.disclosures(df, pii.detect(df)).count() <= 1
    for e, name in ((0, "Zeppelin"), (3, "Quine")):         # planted: beside one entity and nowhere else
        rows = [(i, f"{name} {t}" if f"m{e}@" in t else t) for i, t in rows]
    df = documents(spark, rows)
    got = {(r["entity"], r["term"]) for r in pii.disclosures(df, pii.detect(df)).collect()}
    assert {("email:m0@x.org", "zeppelin"), ("email:m3@x.org", "quine")} <= got


def test_few_words_of_the_tables_are_disclosed(spark):
    """At most one word in a hundred of the documents that hold an entity: nothing there is planted beside them."""
    docs = spark.read.parquet(f"{SF_ORACLE}/documents.parquet")
    shown = pii.sanitise(docs).where("size(base) > 0").select("doc_id", "disclosed").join(docs, "doc_id").collect()
    assert len(shown) > 20
    assert sum(len(r["disclosed"]) for r in shown) <= 0.01 * sum(len(r["text"].split()) for r in shown)


def test_every_kind_of_planted_entity_is_found(spark):
    """Recall by kind over values set between words, quotes and punctuation."""
    rng = random.Random(6)
    value = {"email": lambda i: f"user{i}.x@mail-{i}.example.org", "ip": lambda i: f"{i % 256}.{i * 7 % 256}.0.{i * 3 % 256}",
             "phone": lambda i: f"+{1 + i % 9} ({100 + i}) 555-{1000 + i}"}

    def card(i):
        head = [4, *(int(c) for c in f"{i:014d}")]
        last = next(d for d in range(10) if luhn("".join(map(str, [*head, d]))))
        s = "".join(map(str, [*head, last]))
        return rng.choice([s, " ".join(s[k:k + 4] for k in (0, 4, 8, 12)), "-".join(s[k:k + 4] for k in (0, 4, 8, 12))])
    value["card"] = card
    rows, kinds = [], {}
    for i in range(200):
        kind = pii.KINDS[i % 4]
        before, after = rng.choice([("see ", " now"), ("(", ")"), ("\"", "\""), ("\n", ",\n"), ("é ", "; x")])
        rows.append((i, f"text number{before}{value[kind](i)}{after} and more"))
        kinds[i] = kind
    got = {r["doc_id"]: r for r in pii.digest_columns(pii.detect(documents(spark, rows)).withColumnRenamed("spans", "base")
                                                      .selectExpr("*", "slice(base, 1, 0) AS disclosed")).collect()}
    for kind in pii.KINDS:
        assert all(got[i][f"n_{kind}"] == 1 for i in kinds if kinds[i] == kind), kind


def test_generalised_terms(spark):
    out = {r["doc_id"]: r for r in pii.sanitise(documents(spark, corpus()), remove_at=9.0, support=3).collect()}
    assert "[WORD]" in out[0]["clean_text"] and "[NUMBER]" in out[0]["clean_text"]


def test_odd_rows_and_empty(spark):
    got = pii.sanitise(documents(spark, odd_rows())).collect()
    assert len(got) == len(odd_rows()) and all(r["base"] == [] and r["clean_text"] is None for r in got)
    assert pii.sanitise(documents(spark, [])).collect() == []


def test_no_python_in_the_plan(spark):
    plan = pii.sanitise(documents(spark, corpus()))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def far_corpus():
    """A name 300 characters away from an address, and a house mark of two characters."""
    gap = " ".join(["the usual words of any text"] * 12)
    rows = [(i, f"ann@corp.org {gap} number {i} Zeppelin, house Q9, of it") for i in range(4)]
    rows += [(10 + i, f"p{i}@corp.org {gap} of it number {i}") for i in range(30)]
    return rows + [(100 + i, f"{gap} it is of number {i}") for i in range(200)]


def test_terms_anywhere_and_of_any_length_are_disclosed(spark):
    df = documents(spark, far_corpus())
    got = {(r["entity"], r["term"]): (r["action"], r["disclosure"]) for r in pii.disclosures(df, pii.detect(df)).collect()}
    assert got["email:ann@corp.org", "zeppelin"] == ("remove", 1.0) and got["email:ann@corp.org", "q9"] == ("remove", 1.0)
    assert not any(t in ("of", "it", "the", "usual", "number") for _, t in got)
    clean = {r["doc_id"]: r["clean_text"] for r in pii.sanitise(df, support=2).collect()}
    assert all("Zeppelin" not in clean[i] and "Q9" not in clean[i] and "usual words of any" in clean[i] for i in range(4))


def test_repeated_rows_count_alike(spark):
    rows = [(1, "kim@corp.org of Quux")] * 3 + [(None, "kim@corp.org of Quux")] * 2 + [(9 + i, f"plain words {i}") for i in range(60)]
    df = documents(spark, rows)
    got = {(r["entity"], r["term"]): r["disclosure"] for r in pii.disclosures(df, pii.detect(df), support=1, doubt=math.inf).collect()}
    assert abs(got["email:kim@corp.org", "quux"] - 1) < 1e-9
    assert len([r for r in pii.sanitise(df, support=1, doubt=math.inf).collect() if r["clean_text"] == "[EMAIL]  "]) == 5


def test_common_entity_with_many_terms_equals_brute_force(spark):
    rng = random.Random(4)
    rows = [(i, " ".join([f"t{rng.randrange(60)}" for _ in range(12)] + [f"m{e}@x.org" for e in range(6) if rng.random() < 0.3]))
            for i in range(150)]
    df, n = documents(spark, rows), len(rows)
    words = {i: {w for w in t.split() if "@" not in w} for i, t in rows}
    full = {i: {w for w in re.split(r"[\W_]+", t) if w} for i, t in rows}
    want = {}
    for e in range(6):
        having = [i for i, t in rows if f"m{e}@" in t]
        for term in set().union(*(words[i] for i in having)):
            c, n_t = sum(term in words[i] for i in having), sum(term in full[i] for i in full)
            d = math.log2(n * c / (len(having) * n_t)) / math.log2(n / len(having))
            if d >= 0.1:
                want[f"email:m{e}@x.org", term] = d
    got = {(r["entity"], r["term"]): r["disclosure"] for r in pii.disclosures(df, pii.detect(df), support=1, doubt=math.inf, generalise_at=0.1).collect()}
    short = {k for k in want if len(k[1]) < 3}
    assert {k: v for k, v in want.items() if k not in short}.keys() <= got.keys() <= want.keys()
    assert all(abs(got[k] - want[k]) < 1e-9 for k in got)
