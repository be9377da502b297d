"""Personal data: patterns, and information-theoretic sanitisation of what reveals them.

Four patterns find the protected entities: email, ip, card, phone.  The corpus
then tells which words give an entity e away even when e itself is masked.
With N documents, n(e) that mention e, n(t) that hold the term t and c(e, t)
that mention e and hold t outside of any entity,

    PMI(e, t) = log2(N c(e, t) / (n(e) n(t)))        IC(e) = log2(N / n(e))

the disclosure PMI / IC is 1 when t implies e.  A term whose disclosure reaches
``remove_at`` is removed, from ``generalise_at`` on it is replaced by its class,
in the documents that mention e.

A share is evidence only if chance cannot well explain it.  A pair must be met in
``support`` different texts (copies of a text count once), and against the
m = n(e) n(t) / N meetings that chance gives, c different texts must satisfy
c ln(c / m) - (c - m) >= ln(N / doubt): by Chernoff's bound fewer than
``doubt`` terms an entity reach that by chance among N.  With ``window``, c(e, t) counts only terms within that many characters of e.

Everything is DataFrame expressions.  Scale: the patterns run in the scan.
Equal texts are one row with a count, entities that the same texts mention are
one class, and a term meets a class only if its n(t) is low enough for the wanted
disclosure at any c (n(t) <= N^(1-g) n(e)^g), so common words never form pairs;
n(t) is one aggregate over the corpus.  Terms of one or two characters must be rare
enough for a disclosure of ``SHORT_AT`` even where ``generalise_at`` is lower.

Edge cases: null and empty texts have no span; a null id is carried through;
rows that repeat get equal results; an empty table gives no row; digit runs and
words of any length are matched with possessive patterns, which never
backtrack or recurse.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.session import DEFAULT_BROADCAST_BYTES, DEFAULT_BROADCAST_ROWS, join_bounded

from .common import stage

# A match can begin only where a run of its characters begins, or where the last match ended.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9]++(?:[\x20-][0-9]++)*+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
KINDS = ("email", "ip", "card", "phone")
PATTERNS = dict(zip(KINDS, (EMAIL, IP, CARD, PHONE)))
HINTS = dict(zip(KINDS, (r"@", r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]", r"[0-9](?:[\x20-]?[0-9]){15}", r"\+[0-9]")))
SPAN = "array<struct<kind:string,start:int,end:int,value:string>>"
NOT_TERM = r"[^\p{L}\p{N}]+"
ENTITY = f"{EMAIL}|{PHONE}|{IP}|(?=[0-9](?:[\\x20-]?[0-9]){{15}}){CARD}"
SHORT_AT = 0.75


def positions(text: Column, matches: Column, pieces: Column, kind: str) -> Column:
    """Spans of ``matches``, given the ``pieces`` of the text before, between and after them."""
    pairs = F.zip_with(pieces, matches, lambda p, m: F.struct(F.length(p).alias("before"), m.alias("m")))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(SPAN).alias("spans"))

    def step(s: Column, x: Column) -> Column:
        begin = s["at"] + x["before"]
        end = begin + F.length(x["m"])
        span = F.struct(F.lit(kind).alias("kind"), begin.alias("start"), end.alias("end"), x["m"].alias("value"))
        return F.struct(end.alias("at"), F.array_append(s["spans"], span).alias("spans"))
    return F.aggregate(F.filter(pairs, lambda x: x["m"].isNotNull()), start, step, lambda s: s["spans"])


def _luhn(digits: Column) -> Column:
    back = F.reverse(digits)
    total = F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), lambda s, i: s + F.when(
        i % 2 == 1, back.substr(i, F.lit(1)).cast("int")).otherwise(
        F.element_at(F.array(*[F.lit(x) for x in (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)]),
                     back.substr(i, F.lit(1)).cast("int") + 1)))
    return total % 10 == 0


def valid(kind: str, value: Column) -> Column:
    """Whether a match of ``kind`` is one: ip parts to 255, card length and Luhn sum, phone length."""
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == "ip":
        part = r"0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9]|)"
        return F.rlike(value, F.lit(rf"\A{part}(?:\.{part}){{3}}\z"))
    if kind == "card":
        return F.length(digits).between(16, 19) & _luhn(digits)
    if kind == "phone":
        return F.length(digits).between(8, 15)
    return F.lit(True)


def base_spans(text: Column, kind: str) -> Column:
    """Valid spans of one kind in ``text`` (code points, end exclusive), leftmost first."""
    pattern = F.lit(PATTERNS[kind])
    found = positions(text, F.regexp_extract_all(text, pattern, F.lit(0)), F.split(text, pattern, -1), kind)
    return F.when(F.rlike(text, F.lit(HINTS[kind])), F.filter(found, lambda s: valid(kind, s["value"]))).otherwise(
        F.array().cast(SPAN))


def terms(text: Column) -> Column:
    """Distinct lower-case runs of letters and digits."""
    return F.filter(F.array_distinct(F.split(F.lower(text), NOT_TERM)), lambda t: t != "")


def detect(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, key, spans, text``: base spans of every document, the text only where there are some."""
    docs = documents.select(F.col(f"`{id_col}`").alias("doc_id"),
                            F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    spans = F.concat(*[base_spans(F.col("text"), k) for k in KINDS])
    docs = docs.select("doc_id", F.xxhash64("text").alias("key"), spans.alias("spans"), "text")
    return docs.withColumn("text", F.when(F.size("spans") > 0, F.col("text")))


def _entity(s: Column) -> Column:
    return F.concat_ws(":", s["kind"], F.lower(s["value"]))


def _windows(texts: DataFrame, classes: DataFrame, window: int) -> DataFrame:
    """``key, copies, x1, x2, n_e, term``: terms within ``window`` characters of an entity."""
    mentions = texts.select("key", "copies", "text", F.explode("spans").alias("s"))
    begin = F.greatest(F.col("s.start") - window, F.lit(0))
    before = F.substring("text", begin + 1, F.col("s.start") - begin)
    after = F.substring("text", F.col("s.end") + 1, F.lit(window))
    # words cut by the window's edge are left out; other entities in it are no terms
    before = F.when(begin > 0, F.regexp_replace(before, r"\A[\p{L}\p{N}]+", "")).otherwise(before)
    after = F.when(F.length(after) == window, F.regexp_replace(after, r"[\p{L}\p{N}]+\z", "")).otherwise(after)
    near = F.regexp_replace(F.concat_ws(" ", before, after), ENTITY, " ")
    each = mentions.select("key", "copies", _entity(F.col("s")).alias("entity"), F.explode(terms(near)).alias("term")).distinct()
    return each.join(classes, "entity").drop("entity")


def _evidence(documents: DataFrame, found: DataFrame, window: int | None = None, support: int = 2, doubt: float = 0.05,
              generalise_at: float = 0.75, remove_at: float = 0.9, text_col: str = "text"
              ) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Distinct texts with entities, entities and texts with their classes (x1, x2), and the terms that reveal a class.

    Entities of one class are mentioned by the same texts, so all counts of theirs are equal.
    """
    texts = stage(found.where("text is not null").groupBy("key").agg(
        F.count("*").alias("copies"), F.first("text").alias("text"), F.first("spans").alias("spans")), "texts")
    mentions = texts.select("key", "copies", F.explode(F.array_distinct(F.transform("spans", _entity))).alias("entity"))
    # with windows, the same texts need not hold the same terms beside two entities
    mark = F.col("key") if window is None else F.col("entity")
    per = F.bit_xor if window is None else F.min
    classes = stage(mentions.groupBy("entity").agg(
        F.sum("copies").alias("n_e"), F.count("*").alias("texts"), *[per(F.xxhash64(mark, F.lit(i))).alias(f"x{i}") for i in (1, 2)])
        .where(F.col("texts") >= support).drop("texts"), "entities")
    held = stage(mentions.select("key", "entity").join(classes, "entity").select("key", "x1", "x2", "n_e").distinct(), "held")

    n = float(documents.count())
    most = classes.agg(F.max("n_e")).first()[0] or 0

    def bound(n_e: Column, at: float) -> Column:
        return F.pow(F.lit(n), F.lit(1 - at)) * F.pow(n_e.cast("double"), F.lit(at)) * (1 + 1e-9)
    if window is None:
        told = texts.join(held.select("key").distinct(), "key", "left_semi")
        near = told.select("key", "copies", F.explode(terms(F.regexp_replace("text", ENTITY, " "))).alias("term"))
    else:
        near = stage(_windows(texts, classes, window), "near")
    wanted = stage(near.select("term").distinct(), "terms")
    words = documents.select(F.explode(terms(F.col(f"`{text_col}`"))).alias("term"))
    size, length = wanted.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("term")), F.lit(0))).first()
    if size <= DEFAULT_BROADCAST_ROWS and 24 * size + length <= DEFAULT_BROADCAST_BYTES:
        words, wanted = words.join(F.broadcast(wanted), "term", "left_semi"), None     # before the shuffle
    n_t = words.groupBy("term").agg(F.count("*").alias("n_t"))
    n_t = stage(n_t if wanted is None else n_t.join(wanted, "term", "left_semi"), "counts")
    # a term above this bound reveals none of the classes; the most common ones are few and go before the join
    low = F.col("n_t") <= bound(F.lit(most), generalise_at)
    common = n_t.where(~low & (F.col("n_t") > n / 100)).select("term")
    near = join_bounded(near, common, "term", "left_anti").join(n_t.where(low), "term")
    if window is None:
        near = near.join(held, "key")
    short = (F.length("term") >= 3) | (F.col("n_t") <= bound(F.col("n_e"), max(generalise_at, SHORT_AT)))
    pairs = (near.where((F.col("n_t") <= bound(F.col("n_e"), generalise_at)) & short)
             .groupBy("x1", "x2", "n_e", "term", "n_t").agg(F.sum("copies").alias("c"), F.count("*").alias("texts"))
             .where(F.col("texts") >= support))
    chance = F.col("n_e") * F.col("n_t") / F.lit(n)
    surprise = F.col("texts") * F.log(F.col("texts") / chance) - (F.col("texts") - chance)
    pairs = pairs.where((F.col("texts") > chance) & (surprise >= math.log(max(n, 1.0) / doubt))) if doubt < math.inf else pairs
    ic = F.log2(F.lit(n) / F.col("n_e"))
    pairs = pairs.withColumn("disclosure", F.when(ic > 0, F.log2(F.lit(n) * F.col("c") / (F.col("n_e") * F.col("n_t"))) / ic))
    risky = pairs.where(F.col("disclosure") >= generalise_at).select(
        "x1", "x2", "term", F.when(F.col("disclosure") >= remove_at, "remove").otherwise("generalise").alias("action"), "disclosure")
    return texts, classes, held, stage(risky, "risky")


def disclosures(documents: DataFrame, found: DataFrame, window: int | None = None, support: int = 2, doubt: float = 0.05,
                generalise_at: float = 0.75, remove_at: float = 0.9, text_col: str = "text") -> DataFrame:
    """``entity, term, action, disclosure``: terms that reveal an entity too strongly."""
    _, classes, _, risky = _evidence(documents, found, window, support, doubt, generalise_at, remove_at, text_col)
    return classes.join(risky, ["x1", "x2"]).select("entity", "term", "action", "disclosure")


def _named(texts: DataFrame, held: DataFrame, risky: DataFrame) -> DataFrame:
    """``_key, named, general``: a pattern of the terms to mask in a text, and those that are only generalised.

    The pattern branches on the first and the second character, so that a word is not tried against every term.
    """
    own = texts.select("key", F.explode(terms(F.col("text"))).alias("term"))
    own = join_bounded(own, stage(risky.select("term").distinct(), "terms"), "term", "left_semi")
    named = (own.join(held, "key").join(risky, ["x1", "x2", "term"]).groupBy("key", "term").agg(F.max("action").alias("action")))
    branch = lambda c: F.concat(F.lit("(?:"), F.array_join(F.sort_array(F.collect_list(c)), "|"), F.lit(")"))
    named = (named.groupBy("key", F.substring("term", 1, 1).alias("a"), F.substring("term", 2, 1).alias("b"))
             .agg(branch(F.expr("substring(term, 3)")).alias("p"),
                  F.collect_list(F.when(F.col("action") == "generalise", F.col("term"))).alias("g"))
             .groupBy("key", "a").agg(branch(F.concat("b", "p")).alias("p"), F.flatten(F.collect_list("g")).alias("g"))
             .groupBy(F.col("key").alias("_key"))
             .agg(branch(F.concat("a", "p")).alias("named"), F.flatten(F.collect_list("g")).alias("general")))
    return stage(named, "named")


def sanitise(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Every document with its spans and its sanitised text.

    Columns: ``doc_id, base`` (pattern spans), ``disclosed`` (spans of terms to
    remove or generalise, outside the base spans) and ``clean_text``, in which
    base spans read [EMAIL], [IP], ..., removed terms are gone and generalised ones read
    [WORD] or [NUMBER]; it is null for documents without any span.
    """
    found = stage(detect(documents, id_col, text_col), "detected")
    texts, _, held, risky = _evidence(documents, found, text_col=text_col, **options)
    out = join_bounded(found, _named(texts, held, risky), F.col("key") == F.col("_key"), "left")

    word = F.concat(F.lit(r"(?iu)(?<![\p{L}\p{N}])"), F.col("named"), F.lit(r"(?![\p{L}\p{N}])"))
    raw = positions(F.col("text"), F.regexp_extract_all("text", word, F.lit(0)), F.split("text", word, -1), "term")
    free = F.filter(raw, lambda t: ~F.exists("spans", lambda b: (b["start"] < t["end"]) & (t["start"] < b["end"])))
    out = out.select("doc_id", "text", "general", F.col("spans").alias("base"),
                     F.when(F.col("named").isNotNull(), free).otherwise(F.array().cast(SPAN)).alias("disclosed"))
    return out.withColumn("clean_text", _masked()).select("doc_id", "base", "disclosed", "clean_text")


def _masked() -> Column:
    """The text with spans replaced, left to right; a base span inside another is swallowed by it."""
    spans = F.array_sort(F.concat("base", "disclosed"), lambda a, b: F.when(
        a["start"] != b["start"], a["start"] - b["start"]).otherwise(b["end"] - a["end"]))

    def mask(s: Column) -> Column:
        general = F.when(F.rlike(s["value"], F.lit(r"\A\p{N}+\z")), "[NUMBER]").otherwise("[WORD]")
        term = F.when(F.array_contains("general", F.lower(s["value"])), general).otherwise("")
        return F.when(s["kind"] == "term", term).otherwise(F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")))
    text = F.col("text")
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    done = F.aggregate(spans, start, lambda a, s: F.when(s["start"] < a["at"], a).otherwise(F.struct(
        s["end"].alias("at"), F.concat(a["out"], F.substring(text, a["at"] + 1, s["start"] - a["at"]), mask(s)).alias("out"))))
    return F.when(text.isNotNull(), F.concat(done["out"], F.substring(text, done["at"] + 1, F.length(text))))


def digest_columns(found: DataFrame) -> DataFrame:
    """Counts, the hash of the base spans, and all spans as text, from ``sanitise``'s rows."""
    def spelled(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *[count(k) for k in KINDS], F.sha2(spelled(F.col("base")), 256).alias("base_sha256"),
                        spelled(F.concat("base", "disclosed")).alias("spans"))
