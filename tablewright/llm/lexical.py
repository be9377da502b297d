"""Ranked lexical search, term at a time with limited accumulators.

A document's score for an item sums, over the item's terms (repeats
included), ``w * ((1000000000 * tf) div (1000 * tf + 12 * m))`` with
``w = floor(1000 * ln((2N + 2) / (2 df + 1)))`` and
``m = 100 - 25 + (25 * n * N) div L``.

The corpus is indexed in blocks of documents: one pass over the texts keeps,
for every document, the items' terms that it holds.  In a block an item's
terms are taken rarest first.  Each has a bound, its weight times the largest
impact of its postings in the block.  As long as the bounds of this and
all later terms together reach the k-th best partial score, a posting may
open an accumulator; then no new one can come among the best k (scores only grow, and a
document not seen so far stays below the k-th), so later postings only update the survivors, exactly.
Every block returns its best k per item and one window ranks them.

Scale: the texts are read once and not shuffled; what moves is the df of the
items' terms and k rows per item and block.  Items are taken in blocks of
``item_bytes`` of text (their terms are broadcast); more of them cost another
pass over the texts each, never a larger broadcast.  Terms are told apart by
64-bit hashes.

Edge cases: null text has no term; N counts documents with a term; items
without a term, or without a document that holds one, give no row; repeated
rows of documents are documents of their own, a null id comes last among
ties; every distinct (item_id, text) row of the items is ranked on its own,
a null item id included; empty tables give no row; extra columns are not
read; numbers stay exact for texts of any length.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import chunks, narrow, stage, text_bytes
from .kernels import ALNUM, Lookup, run_hashes, runs

ITEM_BYTES = 4 << 20
BLOCK_DOCS = 1 << 16
BLOCK_POSTINGS = 1 << 22


def _terms(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    data, off = text_bytes(texts)
    starts, ends, at = runs(data, off, ALNUM)
    return run_hashes(data, starts, ends), at


def _item_blocks(items: DataFrame, item_bytes: int) -> Iterator[list[tuple]]:
    """Distinct items, at most ``item_bytes`` of text (or one item) on the driver at a time."""
    rows, size = [], 0
    for r in items.distinct().orderBy("item_id", "text").toLocalIterator():
        n = len((r["text"] or "").encode())
        if rows and size + n > item_bytes:
            yield rows
            rows, size = [], 0
        rows.append((r["item_id"], r["text"]))
        size += n
    if rows:
        yield rows


def _postings(docs: DataFrame, vocabulary: np.ndarray) -> DataFrame:
    """``doc_id, n, terms, tfs``: number of terms of every document, and its terms of the vocabulary."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches):
        table = Lookup(shared.value)
        for b in chunks(batches):
            h, off = _terms(b.column("text"))
            found = table.find(h)
            doc = np.repeat(np.arange(b.num_rows), np.diff(off))[found >= 0]
            key, tf = np.unique(doc * len(table.keys) + found[found >= 0], return_counts=True)
            doc, term = key // max(1, len(table.keys)), key % max(1, len(table.keys))
            cut = np.searchsorted(doc, np.arange(b.num_rows + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(np.diff(off).astype(np.int64)),
                 pa.ListArray.from_arrays(cut, term.astype(np.int32)),
                 pa.ListArray.from_arrays(cut, tf.astype(np.int64))], names=["doc_id", "n", "terms", "tfs"])
    return docs.mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, n long, terms array<int>, tfs array<long>")


def weight(df: int, n: int) -> int:
    return math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))


class BlockIndex:
    """Postings of one block of documents, by term, with their impacts."""

    def __init__(self, doc: np.ndarray, term: np.ndarray, impact: np.ndarray, docs: int, vocabulary: int):
        order = np.argsort(term, kind="stable")
        self.doc, self.impact = doc[order], impact[order]
        self.start = np.searchsorted(term[order], np.arange(vocabulary + 1))
        self.score, self.open = np.zeros(docs, np.int64), np.zeros(docs, bool)
        self.opened = 0

    def best(self, query: list[tuple[int, int]], k: int) -> tuple[np.ndarray, np.ndarray]:
        """Positions and scores of the best ``k``; ``query`` has (term, weight with repeats), rarest first."""
        lists = [(self.doc[s:e], self.impact[s:e] * w) for t, w in query for s, e in [self.start[t:t + 2]] if e > s and w]
        left = sum(int(x.max()) for _, x in lists)
        seen: list[np.ndarray] = []
        limited = False
        for doc, x in lists:
            if not limited and seen:
                held = np.concatenate(seen)
                limited = len(held) >= k and left < np.partition(self.score[held], len(held) - k)[len(held) - k]
            left -= int(x.max())
            if limited:
                on = self.open[doc]
                self.score[doc[on]] += x[on]
                continue
            self.score[doc] += x
            new = doc[~self.open[doc]]
            self.open[new] = True
            seen.append(new)
        held = np.sort(np.concatenate(seen)) if seen else np.zeros(0, np.int64)
        self.opened += len(held)
        score = self.score[held]
        self.score[held], self.open[held] = 0, False
        top = np.lexsort((held, -score))[:k]
        top = top[score[top] > 0]
        return held[top], score[top]


def impacts(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """``(1000000000 * tf) div (1000 * tf + 12 * m)``, in wider numbers where 64 bits do not hold them."""
    if len(tf) and (int(tf.max()) > 1 << 32 or int(m.max()) > 1 << 58):
        return np.array([10 ** 9 * t // (1000 * t + 12 * x) for t, x in zip(tf.tolist(), m.tolist())], np.int64)
    return 1_000_000_000 * tf // (1000 * tf + 12 * m)


def norms(n: np.ndarray, corpus: int, length: int) -> np.ndarray:
    """``100 - 25 + (25 * n * N) div L``."""
    if len(n) and int(n.max()) * 25 * corpus >= 1 << 62:
        return np.array([75 + 25 * x * corpus // length for x in n.tolist()], np.int64)
    return 75 + 25 * n * corpus // max(1, length)


def _blocks(batches, most_docs: int, most_postings: int) -> Iterator[pa.Table]:
    held, rows, size = [], 0, 0
    for b in batches:
        for s in range(0, b.num_rows, 1024):
            part = b.slice(s, 1024)
            held.append(part)
            rows, size = rows + part.num_rows, size + len(part.column("terms").flatten())
            if rows >= most_docs or size >= most_postings:
                yield pa.Table.from_batches(held)
                held, rows, size = [], 0, 0
    if held:
        yield pa.Table.from_batches(held)


def _search(index: DataFrame, queries: list[list[tuple[int, int]]], vocabulary: int, corpus: int, length: int,
            k: int, block_docs: int) -> DataFrame:
    """``q, doc_id, score``: the best ``k`` of every block of documents for every query."""
    shared = index.sparkSession.sparkContext.broadcast(queries)

    def run(batches):
        for t in _blocks(batches, block_docs, BLOCK_POSTINGS):
            t = t.take(pc.sort_indices(t.column("doc_id"), null_placement="at_end"))    # ties go by position
            ids = t.column("doc_id").combine_chunks()
            terms, tfs = t.column("terms").combine_chunks(), t.column("tfs").combine_chunks()
            count = np.diff(terms.offsets.to_numpy())
            doc = np.repeat(np.arange(t.num_rows), count)
            m = norms(t.column("n").to_numpy(), corpus, length)
            block = BlockIndex(doc, terms.flatten().to_numpy(), impacts(tfs.flatten().to_numpy(), m[doc]),
                               t.num_rows, vocabulary)
            out = [(q, *block.best(query, k)) for q, query in enumerate(shared.value)]
            number = np.repeat([q for q, _, _ in out], [len(d) for _, d, _ in out]).astype(np.int32)
            at = np.concatenate([d for _, d, _ in out]) if out else np.zeros(0, np.int64)
            score = np.concatenate([s for _, _, s in out]) if out else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(number), ids.take(pa.array(at)), pa.array(score)],
                                             names=["q", "doc_id", "score"])
    return index.mapInArrow(run, f"q int, doc_id {dict(index.dtypes)['doc_id']}, score long")


def ranked(documents: DataFrame, items: DataFrame, k: int = 20, item_bytes: int = ITEM_BYTES,
           block_docs: int = BLOCK_DOCS, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` best documents of every item."""
    spark = documents.sparkSession
    docs = narrow(documents, {"doc_id": id_col, "text": text_col})
    items = narrow(items, {"item_id": item_col, "text": item_text})
    kind = dict(items.dtypes)["item_id"]
    found: DataFrame | None = None
    for rows in _item_blocks(items, item_bytes):
        h, off = _terms(pa.array([t for _, t in rows], pa.string()))
        vocabulary, code = np.unique(h, return_inverse=True)
        index = stage(_postings(docs, vocabulary), "postings")
        corpus, length = index.where("n > 0").agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
        df = np.zeros(len(vocabulary), np.int64)
        for r in index.select(F.explode("terms").alias("t")).groupBy("t").count().toLocalIterator():
            df[r["t"]] = r["count"]
        queries = []
        for s, e in zip(off[:-1], off[1:]):
            term, times = np.unique(code[s:e], return_counts=True)
            term, times = term[df[term] > 0], times[df[term] > 0]
            order = np.lexsort((term, df[term]))
            queries.append([(int(term[i]), int(times[i]) * weight(int(df[term[i]]), corpus)) for i in order])
        names = spark.createDataFrame([(q, i) for q, (i, _) in enumerate(rows)], f"q int, item_id {kind}")
        best = _search(index, queries, len(vocabulary), corpus, length, k, block_docs)
        order = Window.partitionBy("q").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        best = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        best = best.join(F.broadcast(names), "q").select("item_id", "rank", "doc_id", "score")
        found = best if found is None else found.unionByName(best)
    if found is None:
        return spark.createDataFrame([], f"item_id {kind}, rank int, doc_id {dict(docs.dtypes)['doc_id']}, score long")
    return found


def oracle(k: int = 20) -> str:
    """The same ranking in DuckDB SQL."""
    term = r"""regexp_extract_all(translate({t}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""
    return f"""
    WITH words AS (SELECT row_number() OVER () AS r, doc_id, {term.format(t='text')} AS t FROM documents),
    sizes AS (SELECT r, doc_id, len(t) AS n FROM words WHERE len(t) > 0),
    corpus AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS total FROM sizes),
    queries AS (SELECT item_id, term, count(*) AS times FROM (SELECT item_id, unnest({term.format(t='text')}) AS term FROM
                (SELECT DISTINCT item_id, text FROM benchmark)) GROUP BY ALL),
    postings AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(t) AS term FROM words)
                 WHERE term IN (SELECT term FROM queries) GROUP BY ALL),
    weights AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / (2 * df + 1))) AS BIGINT) AS w
                FROM (SELECT term, count(*) AS df FROM postings GROUP BY term), corpus),
    scored AS (SELECT item_id, r, doc_id, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // total)))) AS BIGINT) AS score
               FROM queries JOIN weights USING (term) JOIN postings USING (term) JOIN sizes USING (r), corpus GROUP BY ALL)
    SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM
      (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0)
    WHERE rank <= {k}"""
