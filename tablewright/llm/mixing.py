"""Mixing sources to target weights by balanced sampling (the cube method).

Targets: sources in code-point order (null last) weigh ``weights`` in turn and
share ``budget`` times all words; no target exceeds ``most`` times its
source's size, and what that cuts off is shared again by weight.

Sample: a source with the ratio r = target / size takes every document
floor(r) times, and once more with probability r - floor(r).  Those
probabilities are the start of the cube method's flight: they move through
the null space of the constraint matrix (token total, document total) until
they reach 0 or 1, so both totals stay as they were in each source.  The
flight runs block by block (Chauvet and Tillé's fast form: three units at a
time for two constraints) and leaves at most two undecided units a block;
these fly again together until one block a source is left, whose last two
units are the landing problem: they are rounded, and single exchanges with
other documents of that block bring the token total back to its target.

Scale: only (id, source, size) rows move.  A source of any size is cut into
blocks of about ``block_rows`` by a hash of id, text and ordinal among equal rows; leftovers shrink by a factor of
``block_rows / 2`` a level.  Per-source tables are joined below a counted
broadcast bound, else by shuffle.  Order and random draws depend on seed,
source and block only, so reruns agree.

Edge cases: null or empty text has size 0; a source without words has target
0 and nothing is taken; null sources are one source, the last; repeated rows
are separate units, told apart by an ordinal, however many there are; an empty table gives no row.
"""

from __future__ import annotations

import zlib
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablewright.session import join_bounded

from .common import chunks, narrow, numbered, packed, stage, text_bytes, unpacked, word_starts

SNAP = 1e-9


def word_sizes(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               source_col: str = "source") -> DataFrame:
    """``doc_id, source, k, size``: number of words of each whole text; ``k`` hashes id, text and source."""
    docs = (narrow(documents, {"doc_id": id_col, "source": source_col, "text": text_col})
            .withColumn("k", F.xxhash64("doc_id", "text", "source")))

    def run(batches):
        for b in chunks(batches):
            data, off = text_bytes(b.column("text"))
            size = np.diff(np.searchsorted(np.flatnonzero(word_starts(data, off)), off))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("source"), b.column("k"), pa.array(size.astype(np.int64))],
                names=["doc_id", "source", "k", "size"])
    kind = dict(docs.dtypes)
    return docs.mapInArrow(run, f"doc_id {kind['doc_id']}, source {kind['source']}, k long, size long")


def source_targets(sizes: DataFrame, weights=(5, 2, 1), budget: float = 1.5, most: float = 2.0) -> DataFrame:
    """``source, n, source_size, target``: one row per source."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    per = stage(per.sort(F.col("source").asc_nulls_last()).withColumn("at", F.monotonically_increasing_id()), "sources")
    # rank = rows of earlier partitions + position in this one; the running sum is over one row a partition
    per = per.withColumn("part", F.shiftrightunsigned("at", 33))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = per.groupBy("part").agg(F.count("*").alias("c")).select("part", F.coalesce(F.sum("c").over(before), F.lit(0)).alias("first"))
    per = join_bounded(per, stage(starts, "starts"), "part", "inner")
    rank = F.col("first") + F.col("at").bitwiseAND((1 << 33) - 1)
    per = per.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                                                (rank % len(weights) + 1).cast("int")))
    total = budget * (per.agg(F.sum("source_size")).first()[0] or 0)
    level = 0.0
    while True:
        above = F.lit(level) * F.col("weight") > most * F.col("source_size")
        full, w = per.agg(F.coalesce(F.sum(F.when(above, most * F.col("source_size"))), F.lit(0.0)),
                          F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0.0))).first()
        new = (total - full) / w if w else level
        if new <= level:
            break
        level = new
    return per.select("source", "n", "source_size",
                      F.least(F.lit(level) * F.col("weight"), most * F.col("source_size")).alias("target"))


def flight(p: np.ndarray, size: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Move ``p`` to 0 or 1, keeping its sum and its ``size``-weighted sum; at most two stay between.

    Three undecided units span one null direction of the two constraints:
    the cross product of (size) and (1, 1, 1).
    """
    p = p.tolist()
    s = size.tolist()
    draw = iter(rng.random(len(p) + 1).tolist())
    held: list[int] = []
    for nxt in (i for i, x in enumerate(p) if 0 < x < 1):
        held.append(nxt)
        if len(held) < 3:
            continue
        i, j, k = held
        u = (s[j] - s[k], s[k] - s[i], s[i] - s[j])
        if not any(u):
            u = (1, -1, 0)
        up = min((1 - p[x]) / c if c > 0 else -p[x] / c for x, c in zip(held, u) if c)
        down = min(p[x] / c if c > 0 else (p[x] - 1) / c for x, c in zip(held, u) if c)
        step = up if next(draw) * (up + down) < down else -down
        keep = []
        for x, c in zip(held, u):
            v = p[x] + step * c
            p[x] = 0.0 if v < SNAP else 1.0 if v > 1 - SNAP else v
            if 0 < p[x] < 1:
                keep.append(x)
        held = keep
    return np.array(p, dtype=float)


def landing(p: np.ndarray, size: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Decide what ``flight`` left undecided (two units at most), near the totals of ``start``.

    The undecided units are rounded at the least cost in tokens; then, as long
    as it brings the token total nearer, one decided unit changes places with
    another, which keeps the document total.
    """
    left = np.flatnonzero((p > 0) & (p < 1))
    best = min(range(1 << len(left)), key=lambda c: (
        abs(sum(size[x] * ((c >> i & 1) - p[x]) for i, x in enumerate(left))),
        abs(sum((c >> i & 1) - p[x] for i, x in enumerate(left))), c))
    for i, x in enumerate(left):
        p[x] = best >> i & 1
    free = np.flatnonzero((start > 0) & (start < 1))
    for _ in range(8):
        short = float((size * start).sum() - (size * p).sum())
        out, taken = free[p[free] == 0], free[p[free] == 1]
        if not len(out) or not len(taken):
            break
        out = out[np.argsort(size[out], kind="stable")]
        wish = size[taken] + short                      # the size that should come in for each
        at = np.searchsorted(size[out], wish)
        near = np.stack([np.clip(at - 1, 0, len(out) - 1), np.clip(at, 0, len(out) - 1)])
        miss = np.abs(size[out][near] - wish)
        side, who = np.unravel_index(np.argmin(miss), miss.shape)
        if miss[side, who] >= abs(short):
            break
        p[taken[who]], p[out[near[side, who]]] = 0.0, 1.0
    short = float((size * start).sum() - (size * p).sum())
    if abs(short) > 0.005 * (size * start).sum():       # a source of few documents
        few = free[:12]
        change = (np.arange(1 << len(few))[:, None] >> np.arange(len(few))) & 1
        tokens = change @ (size[few] * (1 - 2 * p[few]))
        best = np.lexsort((change.sum(1), np.abs(short - tokens)))[0]
        p[few] = np.where(change[best] == 1, 1 - p[few], p[few])
    return p


def mix(documents: DataFrame, weights=(5, 2, 1), budget: float = 1.5, most: float = 2.0, seed: int = 7,
        block_rows: int = 4_000, id_col: str = "doc_id", text_col: str = "text",
        source_col: str = "source") -> DataFrame:
    """``doc_id, row_key, ordinal, source, size, source_size, target, copies, taken`` for every row.

    ``row_key`` hashes id, text and source; ``ordinal`` counts the rows that share it, which are
    equal and therefore interchangeable.  ``take_copies`` uses both.
    """
    sizes = stage(word_sizes(documents, id_col, text_col, source_col).withColumnRenamed("k", "row_key"), "sizes")
    several = sizes.groupBy("row_key").agg(F.count("*").alias("n")).where("n > 1").select("row_key")
    sizes = numbered(sizes, stage(several, "several"))
    targets = stage(source_targets(sizes, weights, budget, most), "targets")
    t = targets.select(F.col("source").alias("_source"), "n", "source_size", "target")
    units = _attach(sizes, t)
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    units = (units.withColumn("whole", F.floor(ratio + SNAP)).withColumn("p", F.greatest(F.lit(0.0), ratio - F.col("whole")))
             .withColumn("k", F.xxhash64("row_key", "ordinal", F.lit(seed))))
    parts, level = [], 0
    while True:
        units = units.withColumn("blocks", F.ceil(F.col("n") / block_rows)).drop("n")
        units = units.withColumn("block", F.pmod(F.xxhash64("k", F.lit(level)), "blocks"))
        kinds = ", ".join(f"{c} {k}" for c, k in units.dtypes)
        lvl = level

        def fly(pdf: pd.DataFrame) -> pd.DataFrame:
            pdf = pdf.sort_values(["size", "k"], ascending=[False, True], kind="stable")
            source = pdf["source"].iloc[0]
            name = repr((seed, lvl, None if pd.isna(source) else str(source), int(pdf["block"].iloc[0])))
            size = pdf["size"].to_numpy()
            start = pdf["p"].to_numpy(dtype=float)
            p = flight(start, size, np.random.default_rng(zlib.crc32(name.encode())))
            return pdf.assign(p=landing(p, size, start) if pdf["blocks"].iloc[0] == 1 else p)
        flown = stage(units.groupBy("source", "block").applyInPandas(fly, kinds), "flown")
        undecided = (F.col("p") > 0) & (F.col("p") < 1)
        parts.append(flown.where(~undecided))
        left = flown.where(undecided).drop("blocks", "block")
        if not left.take(1):
            break
        counts = stage(left.groupBy(F.col("source").alias("_source")).agg(F.count("*").alias("n")), "left")
        units, level = _attach(left, counts), level + 1
    out = reduce(DataFrame.unionByName, parts)
    copies = (F.col("whole") + F.col("p").cast("long")).alias("copies")
    return (out.select("doc_id", "row_key", "ordinal", "source", "size", "source_size", "target", copies)
            .withColumn("taken", F.col("size") * F.col("copies")))


def take_copies(documents: DataFrame, mixed: DataFrame, id_col: str = "doc_id",
                text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The rows of ``documents`` as often as ``mixed`` takes them, with their own columns."""
    per = stage(mixed.select("row_key", "ordinal", F.col("copies").cast("int").alias("copies")), "copies")
    rows = packed(documents, row_key=F.xxhash64(*[F.col(f"`{c}`") for c in (id_col, text_col, source_col)]))
    rows = numbered(rows, stage(per.where("ordinal > 0").select("row_key").distinct(), "several"))
    taken = join_bounded(rows, per.where("copies > 0"), ["row_key", "ordinal"], "inner")
    return unpacked(taken.select("row", F.explode(F.sequence(F.lit(1), "copies"))), documents)


def _attach(units: DataFrame, per_source: DataFrame) -> DataFrame:
    """Join per-source columns on a null-safe source; hot sources are no matter for a broadcast side."""
    on = [units["source"].eqNullSafe(per_source["_source"])]
    return join_bounded(units, per_source, on, "inner").drop("_source")
