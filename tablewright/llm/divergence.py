"""Audit of how sources diverge from each other and from their language.

Each language keeps the terms that enough of its documents hold.  The kept
terms, sorted, become minimal acyclic transducers, whose ordinals are the
terms' lexicographic ranks; the texts then stream through the transducers and
are counted again per (language, source, ordinal).  With count c, N the sum
over kept terms and V their number, a term's share is
``p = 1 + floor(1000000000 * (c + 2) / (N + 2V))``, and two distributions
differ in a term by ``floor((p - q)^2 / (p + q))``.  ``pair`` rows sum this
over all kept terms for every two sources of a language, ``term`` rows name
the terms in which a source exceeds its language most; ordinals break ties.

Scale: terms are counted per document in one pass over the texts and once
more by ordinal in a second, both summed inside each task before the shuffle.
The sorted terms are cut into transducers of at most ``block_terms``; none
covers the whole vocabulary.  Together they are broadcast while they stay
below ``broadcast_bytes``; beyond that each stays in its own partition and the texts' terms, counted per
task, are sent through the one that covers their range.  Source pairs are
summed over blocks of ordinals whose (sources x terms) cells are bounded.
Counts and shares that leave 64 bits are computed as decimals.

Edge cases: null text, language and source read as ''; a source whose texts
hold no kept term still has every kept term at count 0; a language without
kept terms has pairs of value 0 and no ``term`` rows; a source alone in its
language has no pairs; repeated rows count as often as they stand there; an
empty table gives no row; extra columns are not read.
"""

from __future__ import annotations

from bisect import bisect_right

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablewright.session import join_bounded

from .common import chunks, stage, text_bytes
from .kernels import LETTERS, Tally, lowered, run_hashes, runs
from .transducer import Transducer

BLOCK_TERMS = 1 << 16
BROADCAST_BYTES = 64 << 20
SALTS = 8
CELLS = 1 << 16
SCALE = 1_000_000_000
GROUP_SHIFT = np.int64(40)      # a tally key: group of the task << 40 | ordinal in the block of the language


def _texts(documents: DataFrame, text_col: str, lang_col: str, source_col: str) -> DataFrame:
    return documents.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(n)
                              for n, c in (("lang", lang_col), ("source", source_col), ("text", text_col))])


def _pick(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The byte runs as strings."""
    length = ends - starts
    off = np.r_[0, np.cumsum(length)]
    at = np.arange(off[-1]) + np.repeat(starts - off[:-1], length)
    return pa.StringArray.from_buffers(len(starts), pa.py_buffer(off.astype(np.int32)), pa.py_buffer(data[at].tobytes()))


def document_counts(texts: DataFrame) -> DataFrame:
    """``lang, term, df``: in how many of the language's documents each term occurs."""
    def run(batches):
        for b in chunks(batches, limit=2 << 20):
            data, off = text_bytes(b.column("text"))
            starts, ends, at = runs(data, off, LETTERS)
            if not len(starts):
                continue
            h = run_hashes(data, starts, ends)
            _, first, code = np.unique(h, return_index=True, return_inverse=True)
            doc = np.repeat(np.arange(b.num_rows), np.diff(at))
            held = np.unique(doc * len(first) + code)               # (document, term), once each
            lang = b.column("lang").dictionary_encode()
            key, df = np.unique(lang.indices.to_numpy()[held // len(first)].astype(np.int64) * len(first) + held % len(first),
                                return_counts=True)
            which = first[key % len(first)]
            yield pa.RecordBatch.from_arrays(
                [lang.dictionary.take(pa.array(key // len(first))), _pick(lowered(data), starts[which], ends[which]),
                 pa.array(df.astype(np.int64))], names=["lang", "term", "df"])
    counted = texts.select("lang", "text").mapInArrow(run, "lang string, term string, df long")
    return counted.groupBy("lang", "term").agg(F.sum("df").alias("df"))


def build_blocks(kept: DataFrame, block_terms: int) -> DataFrame:
    """``block, lang, base, n, first, last, fst``: transducers over ranges of each language's sorted terms.

    ``base`` is the ordinal, in the language, of the block's first term.
    """
    def run(batches):
        lang, terms = None, []

        def done():
            return pa.RecordBatch.from_arrays(
                [pa.array([lang]), pa.array([len(terms)], pa.int64()), pa.array([terms[0].decode()]), pa.array([terms[-1].decode()]),
                 pa.array([Transducer.build(terms).to_bytes()], pa.binary())], names=["lang", "n", "first", "last", "fst"])
        for b in batches:
            for name, term in zip(b.column("lang").to_pylist(), b.column("term").to_pylist()):
                if terms and (name != lang or len(terms) >= block_terms):
                    yield done()
                    terms = []
                lang = name
                terms.append(term.encode())
        if terms:
            yield done()
    made = stage(kept.select("lang", "term").sort("lang", "term").mapInArrow(
        run, "lang string, n long, first string, last string, fst binary"), "transducers")
    # the blocks' summary has one row for each `block_terms` terms
    order = Window.partitionBy("lang").orderBy("first")
    base = F.coalesce(F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    spans = made.select("lang", "first", "n", base.alias("base"), F.xxhash64("lang", "first").alias("block"))
    return stage(made.drop("n").join(spans, ["lang", "first"]).select("block", "lang", "base", "n", "first", "last", "fst"), "blocks")


class _Streamer:
    """The transducers of all languages; finds the ordinals of a chunk's terms."""

    def __init__(self, blocks: list[tuple]):
        self.by_lang: dict[str, list[tuple]] = {}
        for lang, base, first, last, fst in blocks:
            self.by_lang.setdefault(lang, []).append((base, _head(first.encode()), _head(last.encode()), Transducer.from_bytes(fst)))

    def ordinals(self, lang: str, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        blocks = self.by_lang.get(lang, [])
        if len(blocks) == 1:
            return blocks[0][3].ordinals(data, starts, ends)
        out = np.full(len(starts), -1, np.int64)
        if blocks:
            head = np.zeros(len(starts), np.uint64)
            for k in range(8):
                inside = starts + k < ends
                byte = data[np.minimum(starts + k, len(data) - 1)].astype(np.uint64)
                head = head << np.uint64(8) | np.where(inside, byte, np.uint64(0))
        for base, low, high, fst in blocks:
            some = np.flatnonzero((head >= low) & (head <= high))
            got = fst.ordinals(data, starts[some], ends[some])
            out[some[got >= 0]] = got[got >= 0] + base
        return out


def _head(term: bytes) -> np.uint64:
    return np.uint64(int.from_bytes(term[:8].ljust(8, b"\0"), "big"))


def _groups_of(b: pa.RecordBatch, names: dict[tuple, int]) -> np.ndarray:
    return np.array([names.setdefault(x, len(names)) for x in zip(b.column("lang").to_pylist(), b.column("source").to_pylist())],
                    np.int64)


def _counts_batch(part, names: dict[tuple, int]) -> pa.RecordBatch:
    keys, counts = part
    groups = list(names)
    g = keys >> GROUP_SHIFT
    lang = pa.array([x for x, _ in groups], pa.string()).take(pa.array(g))
    source = pa.array([x for _, x in groups], pa.string()).take(pa.array(g))
    return pa.RecordBatch.from_arrays([lang, source, pa.array(keys & ((np.int64(1) << GROUP_SHIFT) - np.int64(1))), pa.array(counts)],
                                      names=["lang", "source", "ord", "n"])


def _streamed(texts: DataFrame, blocks: DataFrame) -> DataFrame:
    """``lang, source, ord, n``: all texts through the broadcast transducers."""
    rows = [(r["lang"], r["base"], r["first"], r["last"], bytes(r["fst"])) for r in blocks.collect()]
    shared = texts.sparkSession.sparkContext.broadcast(rows)

    def run(batches):
        stream, tally, names = _Streamer(shared.value), Tally(), {}
        for b in chunks(batches):
            data, off = text_bytes(b.column("text"))
            starts, ends, at = runs(data, off, LETTERS)
            group = np.repeat(_groups_of(b, names), np.diff(at))
            lang = b.column("lang").dictionary_encode()
            code = np.repeat(lang.indices.to_numpy(), np.diff(at))
            data = lowered(data)
            for i, name in enumerate(lang.dictionary.to_pylist()):
                some = np.flatnonzero(code == i)
                ordinal = stream.ordinals(name, data, starts[some], ends[some])
                for part in tally.add((group[some] << GROUP_SHIFT | ordinal)[ordinal >= 0]):
                    yield _counts_batch(part, names)
        for part in tally.rest():
            yield _counts_batch(part, names)
    return texts.mapInArrow(run, "lang string, source string, ord long, n long")


def _sent(texts: DataFrame, blocks: DataFrame) -> DataFrame:
    """``lang, source, ord, n`` where the transducers stay in place and the texts' terms come to them."""
    heads = [(r["lang"], r["first"].encode(), r["block"]) for r in blocks.select("lang", "first", "block").collect()]
    shared = texts.sparkSession.sparkContext.broadcast(sorted(heads))

    def cut(batches):
        order = [(x, f) for x, f, _ in shared.value]
        for b in chunks(batches):
            data, off = text_bytes(b.column("text"))
            starts, ends, at = runs(data, off, LETTERS)
            names: dict[tuple, int] = {}
            if not len(starts):
                continue
            _, first, code = np.unique(run_hashes(data, starts, ends), return_index=True, return_inverse=True)
            key, n = np.unique(np.repeat(_groups_of(b, names), np.diff(at)) * len(first) + code, return_counts=True)
            terms = _pick(lowered(data), starts[first], ends[first]).to_pylist()
            groups, out = list(names), []
            for k, c in zip(key.tolist(), n.tolist()):
                (lang, source), term = groups[k // len(first)], terms[k % len(first)]
                i = bisect_right(order, (lang, term.encode())) - 1
                if i >= 0 and order[i][0] == lang:
                    out.append((shared.value[i][2], lang, source, term, c))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (
                    pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64()))], names=["block", "lang", "source", "term", "n"])
    terms = (texts.mapInArrow(cut, "block long, lang string, source string, term string, n long")
             .groupBy("block", "lang", "source", "term").agg(F.sum("n").alias("n"))
             .select("block", F.pmod(F.xxhash64("source", "term"), F.lit(SALTS)).cast("int").alias("salt"), F.lit(1).alias("kind"),
                     "lang", "source", "term", "n", F.lit(None).cast("binary").alias("fst"), F.lit(None).cast("long").alias("base")))
    homes = blocks.select("block", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"), F.lit(0).alias("kind"),
                          "lang", F.lit("").alias("source"), F.lit("").alias("term"), F.lit(0).cast("long").alias("n"), "fst", "base")

    def walk(batches):
        fst = base = None
        for b in batches:
            kind = b.column("kind").to_numpy()
            for s, e in zip(*(lambda c: (c[:-1], c[1:]))(np.unique(np.r_[0, np.flatnonzero(kind == 0), np.flatnonzero(kind == 0) + 1, len(kind)]))):
                part = b.slice(int(s), int(e - s))
                if kind[s] == 0:
                    fst, base = Transducer.from_bytes(part.column("fst")[0].as_py()), part.column("base")[0].as_py()
                    continue
                data, off = text_bytes(part.column("term"))
                got = fst.ordinals(data, off[:-1], off[1:])
                some = pa.array(got >= 0)
                yield pa.RecordBatch.from_arrays([part.column("lang").filter(some), part.column("source").filter(some),
                                                  pa.array(got[got >= 0] + base), part.column("n").filter(some)],
                                                 names=["lang", "source", "ord", "n"])
    return (homes.unionByName(terms).repartition("block", "salt").sortWithinPartitions("block", "salt", "kind")
            .mapInArrow(walk, "lang string, source string, ord long, n long"))


def recount(texts: DataFrame, blocks: DataFrame, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``lang, source, ord, n``: occurrences of every kept term in every source."""
    size = blocks.agg(F.coalesce(F.sum(F.octet_length("fst")), F.lit(0))).first()[0]
    rows = _streamed(texts, blocks) if size <= broadcast_bytes else _sent(texts, blocks)
    # each task has summed its rows already, so they are dealt out first and summed once
    return rows.repartition("lang", "source", "ord").groupBy("lang", "source", "ord").agg(F.sum("n").alias("n"))


def share(count: str, total: str, v: str):
    """``1 + floor(1000000000 * (count + 2) / (total + 2 * v))``, exact."""
    return F.expr(f"1 + (cast({SCALE} as decimal(20,0)) * cast({count} + 2 as decimal(18,0))) div cast({total} + 2 * {v} as decimal(20,0))")


def difference(p: str, q: str):
    return F.expr(f"(({p} - {q}) * ({p} - {q})) div ({p} + {q})")


def shares(counts: np.ndarray, total: np.ndarray) -> np.ndarray:
    """``share`` on arrays; ``total`` is N + 2V."""
    if counts.size and int(counts.max()) >= 9_000_000_000:
        return np.array([[1 + SCALE * (c + 2) // t for c in row] for row, t in zip(counts.tolist(), total.tolist())], np.int64)
    return 1 + SCALE * (counts + 2) // total[:, None]


def _pair_sums(table: pa.Table) -> pa.Table:
    """Sums of the differences of every two sources over one block of ordinals (rows: source, total, ord or -1, n)."""
    source = pc.sort_indices(table.column("source"))
    table = table.take(source)
    names = pc.unique(table.column("source"))
    row = pc.index_in(table.column("source"), names).to_numpy()
    ordinal, n = table.column("ord").to_numpy(), table.column("n").to_numpy()
    total = np.zeros(len(names), np.int64)
    total[row] = table.column("total").to_numpy()
    terms = int(table.column("terms")[0].as_py())
    value = np.zeros((len(names), len(names)), np.int64)
    if terms:
        counts = np.zeros((len(names), terms), np.int64)
        real = ordinal >= 0
        counts[row[real], ordinal[real]] = n[real]
        p = shares(counts, total)
        for i in range(len(names) - 1):
            for s in range(i + 1, len(names), 256):
                d = (p[s:s + 256] - p[i]) ** 2 // (p[s:s + 256] + p[i])
                value[i, s:s + 256] = value[s:s + 256, i] = d.sum(1)
    a, b = np.nonzero(~np.eye(len(names), dtype=bool))
    lang = pa.array([table.column("lang")[0].as_py()] * len(a), pa.string())
    return pa.table({"lang": lang, "source": names.take(pa.array(a)), "item": names.take(pa.array(b)), "value": pa.array(value[a, b])})


def _pairs(counts: DataFrame, groups: DataFrame, cells: int) -> DataFrame:
    """``lang, source, item, value`` for every ordered pair of a language's sources."""
    width = groups.groupBy("lang").agg(F.expr(f"greatest(1, {cells} div count(*))").alias("width"))
    groups = groups.join(width, "lang")
    heads = (groups.withColumn("part", F.explode(F.expr("sequence(0L, greatest(0L, (v - 1) div width))")))
             .select("lang", "part", "source", (F.col("total") + 2 * F.col("v")).alias("total"),
                     F.expr("least(width, v - part * width)").alias("terms"), F.lit(-1).cast("long").alias("ord"), F.lit(0).cast("long").alias("n")))
    rows = (join_bounded(counts, stage(groups, "widths"), ["lang", "source"], "inner")
            .select("lang", F.expr("ord div width").alias("part"), "source", (F.col("total") + 2 * F.col("v")).alias("total"),
                    F.expr("least(width, v - (ord div width) * width)").alias("terms"), F.expr("ord % width").alias("ord"), "n"))
    sums = heads.unionByName(rows).groupBy("lang", "part").applyInArrow(_pair_sums, "lang string, source string, item string, value long")
    return sums.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def _spelled(blocks: DataFrame) -> DataFrame:
    """``lang, ord, item``: the terms that the transducers hold."""
    def run(batches):
        for b in batches:
            for r in b.to_pylist():
                terms = [t.decode() for t in Transducer.from_bytes(r["fst"]).terms()]
                yield pa.RecordBatch.from_arrays([pa.array([r["lang"]] * len(terms), pa.string()), pa.array(np.arange(len(terms)) + r["base"]),
                                                  pa.array(terms, pa.string())], names=["lang", "ord", "item"])
    return blocks.select("lang", "base", "fst").mapInArrow(run, "lang string, ord long, item string")


def audit(documents: DataFrame, min_docs: int = 10, top: int = 10, block_terms: int = BLOCK_TERMS,
          broadcast_bytes: int = BROADCAST_BYTES, cells: int = CELLS, text_col: str = "text",
          lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """``lang, source, part, item, value, rank``: how sources differ in pairs, and in which terms from their language."""
    texts = _texts(documents, text_col, lang_col, source_col)
    kept = stage(document_counts(texts).where(F.col("df") >= min_docs).select("lang", "term"), "kept")
    blocks = build_blocks(kept, block_terms)
    counts = stage(recount(texts, blocks, broadcast_bytes), "counts")
    v = blocks.groupBy("lang").agg(F.sum("n").alias("v"))
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = (texts.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(v, "lang", "left")
              .na.fill(0, ["total", "v"]))
    groups = stage(groups, "groups")

    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = _pairs(counts, groups, cells).select("lang", "source", F.lit("pair").alias("part"), "item", "value",
                                                 F.row_number().over(order).alias("rank"))

    whole = counts.groupBy("lang", "ord").agg(F.sum("n").alias("n_lang"))
    langs = groups.groupBy("lang").agg(F.sum("total").alias("lang_total"))
    q = whole.join(F.broadcast(langs), "lang") if langs.count() <= 10_000 else whole.join(langs, "lang")
    terms = (join_bounded(counts.where("n > 0"), groups, ["lang", "source"], "inner").join(q, ["lang", "ord"])
             .withColumn("p", share("n", "total", "v")).withColumn("q", share("n_lang", "lang_total", "v"))
             .where("p > q").withColumn("value", difference("p", "q")))
    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "ord")
    terms = terms.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top).select("lang", "source", "ord", "value", "rank")
    terms = terms.join(_spelled(blocks), ["lang", "ord"]).select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank")
    return pairs.unionByName(terms)


def oracle(min_docs: int = 10, top: int = 10) -> str:
    """The same audit in DuckDB SQL."""
    return rf"""
    WITH docs AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM documents),
    words AS (SELECT r, lang, source, unnest(t) AS term FROM docs),
    kept AS (SELECT lang, term FROM words GROUP BY ALL HAVING count(DISTINCT r) >= {min_docs}),
    v AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
    grp AS (SELECT DISTINCT lang, source FROM docs),
    c AS (SELECT lang, source, term, count(*) AS n FROM words JOIN kept USING (lang, term) GROUP BY ALL),
    tot AS (SELECT lang, source, coalesce(sum(n), 0) AS total FROM grp LEFT JOIN c USING (lang, source) GROUP BY ALL),
    p AS (SELECT lang, source, term, coalesce(n, 0) AS n, 1 + (CAST(1000000000 AS HUGEINT) * (coalesce(n, 0) + 2)) // (total + 2 * v) AS p
          FROM tot JOIN kept USING (lang) JOIN v USING (lang) LEFT JOIN c USING (lang, source, term)),
    q AS (SELECT lang, term, 1 + (CAST(1000000000 AS HUGEINT) * (n + 2)) // (total + 2 * v) AS q
          FROM (SELECT lang, term, sum(n) AS n FROM c GROUP BY ALL) JOIN (SELECT lang, sum(total) AS total FROM tot GROUP BY ALL) USING (lang)
          JOIN v USING (lang)),
    pair AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item,
             (SELECT coalesce(sum(((x.p - y.p) * (x.p - y.p)) // (x.p + y.p)), 0) FROM p x JOIN p y ON x.term = y.term
              WHERE x.lang = a.lang AND y.lang = a.lang AND x.source = a.source AND y.source = b.source) AS value
             FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source),
    term AS (SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q)) // (p + q) AS value FROM p JOIN q USING (lang, term)
             WHERE n > 0 AND p > q),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
               FROM (SELECT * FROM pair UNION ALL SELECT * FROM term))
    SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM ranked
    WHERE part = 'pair' OR rank <= {top}"""
