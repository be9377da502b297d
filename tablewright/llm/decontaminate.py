"""Benchmark decontamination by pigeonhole edit matching.

A document leaks a test item when some stretch of it is within k edits of the
item, k being ``error_rate`` of the item's length.  The item is cut into k + 1
pieces: k edits cannot touch all of them, so one piece occurs unchanged.  An
Aho-Corasick automaton over all pieces finds the exact hits in one pass over
the whole text; each hit names a window of the text in which the item would
have to lie, and overlapping windows of an item are joined.  Myers' bit-parallel
distance (one machine-independent integer per text position) verifies them.

Texts are compared in lower case with each run of white space as one space;
positions in the result count code points of that form.

Scale: documents are read in place, nothing is shuffled.  The test items are
the stated query set: they are read in blocks of at most ``block_chars``
characters, each block is broadcast, and further blocks take further passes
over the documents, staged one by one.  An automaton takes some hundred bytes a
character, so a block above ``automaton_chars`` is held as sorted 64-bit hashes
of its pieces instead (three bytes a character, texts included): every
stretch of a document as long as a piece is hashed, looked up behind a bitmap,
and compared with the piece itself, which gives the same exact hits.

Edge cases: null or empty documents leak nothing, null or empty items match
nothing; items too short to afford an error are matched exactly; a null id is
carried through, and ids of items and documents may be of any type; repeated documents give repeated rows; identical items with
one id count once.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_type

from .common import U64, chunks, mix, narrow, stage

ERROR_RATE = 0.08
HASHED = 16             # pieces are hashed by this many first characters at most
STRIP = 1 << 18         # characters of a text that are hashed at once
BASE = U64(0x9E3779B97F4A7C15)
SCHEMA = "distance int, budget int, start long, end long"


def normalise(text: str | None) -> str:
    return " ".join((text or "").lower().split())


def pieces(item: str, budget: int) -> list[tuple[int, str]]:
    """``budget + 1`` pieces of nearly equal length, with their offsets."""
    cut = [i * len(item) // (budget + 1) for i in range(budget + 2)]
    return [(s, item[s:e]) for s, e in zip(cut, cut[1:])]


def myers(pattern: str, text: str, most: int) -> tuple[int, int] | None:
    """Least edit distance (at most ``most``) of ``pattern`` to a stretch of ``text``, and its first end."""
    masks: dict[str, int] = {}
    for i, c in enumerate(pattern):
        masks[c] = masks.get(c, 0) | 1 << i
    m = len(pattern)
    full, top = (1 << m) - 1, 1 << m - 1
    plus, minus, score, best = full, 0, m, None
    if m <= most:
        best = (m, 0)
    for j, c in enumerate(text, 1):
        eq = masks.get(c, 0)
        x = eq | minus
        d0 = ((((x & plus) + plus) ^ plus) | x) & full
        up = minus | ~(plus | d0) & full
        down = plus & d0
        if up & top:
            score += 1
        elif down & top:
            score -= 1
        up = up << 1 & full
        down = down << 1 & full
        plus = down | ~(d0 | up) & full
        minus = up & d0
        if score <= most and (best is None or score < best[0]):
            best = (score, j)
            if score == 0:
                break
    return best


class Matcher:
    """Finds approximate occurrences of (item_id, normalised text) items."""

    def __init__(self, items: list[tuple[int, str]], error_rate: float):
        self.items = [(i, t, int(error_rate * len(t))) for i, t in items]
        where = defaultdict(list)
        for n, (_, t, k) in enumerate(self.items):
            for offset, piece in pieces(t, k):
                where[piece].append((n, offset, len(piece)))
        self.automaton = ahocorasick.Automaton()
        for piece, at in where.items():
            self.automaton.add_word(piece, at)
        if where:
            self.automaton.make_automaton()
        self.empty = not where

    def hits(self, text: str) -> Iterator[tuple[int, list[tuple[int, int, int]]]]:
        """Last position of every piece found in ``text``, with its (item number, offset, size) entries."""
        return self.automaton.iter(text)

    def windows(self, text: str) -> dict[int, list[list[int]]]:
        """For each item number the joined stretches of ``text`` that could hold it."""
        out: dict[int, list[list[int]]] = defaultdict(list)
        for last, at in self.hits(text):
            for n, offset, size in at:
                _, t, k = self.items[n]
                s = last + 1 - size - offset - k
                out[n].append([s, s + len(t) + 2 * k])
        for n, spans in out.items():
            spans.sort()
            joined = [spans[0]]
            for s, e in spans[1:]:
                if s <= joined[-1][1]:
                    joined[-1][1] = max(e, joined[-1][1])
                else:
                    joined.append([s, e])
            out[n] = joined
        return out

    def search(self, text: str) -> Iterator[tuple[int, int, int, int, int]]:
        """``(item_id, distance, budget, start, end)`` of the best occurrence of each leaked item."""
        if self.empty or not text:
            return
        for n, spans in self.windows(text).items():
            item, t, k = self.items[n]
            at = text.find(t)
            if at >= 0:
                yield item, 0, k, at, at + len(t)
                continue
            best = None
            for s, e in spans:
                s = max(0, s)
                hit = myers(t, text[s:e], k if best is None else best[0] - 1)
                if hit:
                    best = (hit[0], s + hit[1])
                    if hit[0] == 1:
                        break
            if best:
                d, end = best
                back = text[max(0, end - len(t) - d):end][::-1]
                yield item, d, k, end - myers(t[::-1], back, d)[1], end


def codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32)


def piece_index(items: list[tuple[object, str]], error_rate: float) -> dict[int, tuple]:
    """``{characters hashed: (sorted hashes, item, offset, size, bitmap, shift)}`` of the pieces of all items."""
    found: dict[int, list[tuple]] = defaultdict(list)
    for n, (_, t) in enumerate(items):
        k = int(error_rate * len(t))
        cut = np.arange(k + 2, dtype=np.int64) * len(t) // (k + 1)
        starts, sizes, c = cut[:-1], np.diff(cut), codes(t).astype(U64) + U64(1)
        for size in np.unique(sizes):
            at, q = starts[sizes == size], min(int(size), HASHED)
            h = np.zeros(len(at), U64)
            for j in range(q):
                h = h * BASE + c[at + j]
            found[q].append((mix(h), np.full(len(at), n, np.int32), at.astype(np.int32), np.full(len(at), size, np.int32)))
    index = {}
    for q, parts in found.items():
        h, *rest = (np.concatenate(p) for p in zip(*parts))
        order = np.argsort(h, kind="stable")
        h, width = h[order], max(3, (16 * len(h)).bit_length())
        bits = np.zeros(1 << width - 3, np.uint8)
        at = h >> U64(64 - width)
        np.bitwise_or.at(bits, at >> U64(3), np.uint8(1) << (at & U64(7)).astype(np.uint8))
        index[q] = (h, *(r[order] for r in rest), bits, U64(64 - width))
    return index


class HashedMatcher(Matcher):
    """``Matcher`` whose exact hits come from a ``piece_index``."""

    def __init__(self, items: list[tuple[object, str]], error_rate: float, index: dict[int, tuple]):
        self.items = [(i, t, int(error_rate * len(t))) for i, t in items]
        self.index = index
        self.empty = not index

    def hits(self, text: str) -> Iterator[tuple[int, list[tuple[int, int, int]]]]:
        c, top = codes(text), max(self.index)
        for a in range(0, len(c), STRIP):
            part = c[a:a + STRIP + top - 1].astype(U64) + U64(1)
            n = min(STRIP, len(part))
            h = np.zeros(n, U64)
            for q in range(1, top + 1):
                n = min(n, len(part) - q + 1)
                if n <= 0:
                    break
                h = h[:n] * BASE + part[q - 1:q - 1 + n]
                if q not in self.index:
                    continue
                keys, item, offset, size, bits, shift = self.index[q]
                m = mix(h)
                at = m >> shift
                here = np.flatnonzero(bits[at >> U64(3)] >> (at & U64(7)).astype(np.uint8) & np.uint8(1))
                low, high = (np.searchsorted(keys, m[here], side) for side in ("left", "right"))
                for p, s, e in zip((here + a).tolist(), low.tolist(), high.tolist()):
                    for i, o, z in zip(item[s:e].tolist(), offset[s:e].tolist(), size[s:e].tolist()):
                        if text.startswith(self.items[i][1][o:o + z], p):
                            yield p + z - 1, [(i, o, z)]


def _blocks(benchmark: DataFrame, block_chars: int) -> Iterator[list[tuple]]:
    block, size = [], 0
    for r in benchmark.distinct().toLocalIterator():
        t = normalise(r["text"])
        if not t:
            continue
        if block and size + len(t) > block_chars:
            yield block
            block, size = [], 0
        block.append((r["item_id"], t))
        size += len(t)
    if block:
        yield block


def leaks(documents: DataFrame, benchmark: DataFrame, error_rate: float = ERROR_RATE,
          block_chars: int = 1 << 25, automaton_chars: int = 1 << 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, item_id, distance, budget, start, end``: a row per document and item it leaks."""
    spark = documents.sparkSession
    docs = narrow(documents, {"doc_id": id_col, "text": text_col})
    items = narrow(benchmark, {"item_id": "item_id", "text": "text"})
    schema = f"doc_id {dict(docs.dtypes)['doc_id']}, item_id {dict(items.dtypes)['item_id']}, {SCHEMA}"
    item_kind = to_arrow_type(items.schema["item_id"].dataType)

    def matches(block: list[tuple[int, str]]) -> DataFrame:
        large = sum(len(t) for _, t in block) > automaton_chars
        shared = spark.sparkContext.broadcast((block, piece_index(block, error_rate) if large else None))

        def run(batches):
            held, index = shared.value
            m = HashedMatcher(held, error_rate, index) if index else Matcher(held, error_rate)
            for b in chunks(batches):
                rows = [(i, *hit) for i, t in enumerate(b.column("text").to_pylist())
                        for hit in m.search(normalise(t))]
                if not rows:
                    continue
                at, *cols = zip(*rows)
                ids = b.column("doc_id").take(pa.array(at, pa.int64()))
                kinds = (item_kind, pa.int32(), pa.int32(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays([ids, *(pa.array(c, k) for c, k in zip(cols, kinds))],
                                                 names=["doc_id", "item_id", "distance", "budget", "start", "end"])
        return docs.mapInArrow(run, schema)

    found: list[DataFrame] = []
    blocks = _blocks(items, block_chars)
    block = next(blocks, [])
    while True:
        following = next(blocks, None)
        if following is None and not found:
            return matches(block)
        found.append(stage(matches(block), "leaks"))
        if following is None:
            return reduce(DataFrame.unionByName, found)
        block = following
