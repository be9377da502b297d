"""MinHash near-duplicate detection with odd sketches.

A document's set holds the distinct ``words``-word shingles of its whole text.
Classic MinHash (one independent hash per sample) gives ``bands * rows``
samples.  They serve twice: ``rows`` samples at a time are the band keys that
find candidates, and all samples are folded into an odd sketch, a bitmap in
which each sample flips one bit.  The population count of the XOR of two
sketches estimates how many samples differ, and does so best for high
similarities (Mitzenmacher, Pagh and Pham).  Candidates whose count cannot
come from the wanted similarity are dropped; the others are compared on their
full shingle sets.

A pair at the threshold misses every band with probability
``(1 - t^rows)^bands``: 1.3e-7 for 0.8, 5 rows and 40 bands.  The sketch bound
lies six standard deviations beyond the expected count at the threshold.

Scale: documents with equal sets collapse into one class before any band row
is made.  Then, for a few rounds, every bucket names two leaders, each member
tries the one most like it by the sketches, and verified links merge
components.  Buckets that still hold several components are then
compared in full, member by member, inside tasks that hold two bounded blocks
of one bucket at most: sketches first, then full sets, as matrix products.
Out come only the links that join components, never the pairs, and no bucket
is capped.

Edge cases: null and empty texts have no shingle, are kept and linked with
nothing; a null id is linked with nothing, its row is kept with a null
component; rows that share an id are one document, so that links of
any of its texts count for it (``one_per_component`` judges texts, not ids).
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.session import join_bounded

from .common import (U64, chunks, mix, narrow, packed, stage, text_bytes, unpacked,
                     word_hashes)
from .graph import connected_components

SKETCH_BITS = 256


def shingle_sets(data: np.ndarray, off: np.ndarray, words: int
                 ) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, end to end, and n+1 offsets.

    A text of fewer than ``words`` words has its whole sequence as the one shingle.
    """
    wh, woff, _ = word_hashes(data, off)
    count = np.diff(woff)
    sets, sizes = [], np.zeros(len(count), np.int64)
    odd = mix(np.arange(1, words + 1, dtype=U64)) | U64(1)
    if len(wh) >= words:
        m = len(wh) - words + 1
        full = np.zeros(m, U64)
        for k in range(words):
            full += wh[k:k + m] * odd[k]
        full = mix(full)
    for i, c in enumerate(count):
        if c == 0:
            continue
        s = woff[i]
        if c >= words:
            u = np.unique(full[s:s + c - words + 1])
        else:
            u = mix((wh[s:s + c] * odd[:c]).sum(dtype=U64)[None] + U64(c))
        sets.append(u)
        sizes[i] = len(u)
    joined = np.concatenate(sets) if sets else np.zeros(0, U64)
    return joined, np.r_[0, np.cumsum(sizes)]


def minhash(sets: np.ndarray, off: np.ndarray, samples: int, seed: int) -> np.ndarray:
    """(documents with a non-empty set) x samples matrix of 32-bit minima."""
    size = np.diff(off)
    starts = off[:-1][size > 0]
    rng = np.random.default_rng(seed)
    a, b = rng.integers(0, 1 << 32, (2, samples), dtype=np.uint32) | np.uint32(1)
    hi, lo = (sets >> U64(32)).astype(np.uint32), sets.astype(np.uint32)
    out = np.empty((len(starts), samples), np.uint32)
    for k in range(samples):
        out[:, k] = np.minimum.reduceat(hi * a[k] + lo * b[k], starts) if len(starts) else 0
    return out


def odd_sketch(minima: np.ndarray, bits: int = SKETCH_BITS) -> np.ndarray:
    """Fold each row's samples into a parity bitmap of ``bits`` bits, as int64 words."""
    n, samples = minima.shape
    bitmap = np.zeros((n, bits), np.uint8)
    rows = np.arange(n)
    for k in range(samples):
        at = mix(minima[:, k].astype(U64) + U64(k << 32)) % U64(bits)
        bitmap[rows, at.astype(np.int64)] ^= 1
    return np.packbits(bitmap, axis=1).view(np.int64)


def sketch_limit(samples: int, threshold: float, bits: int = SKETCH_BITS, sigmas: float = 6.0) -> int:
    """Largest XOR population count that similarity ``threshold`` can give.

    ``samples * (1 - threshold)`` samples differ on average, each difference
    flips two bits, and both the number of differences and the parity of the
    bits they fall on vary.
    """
    def expected(differ: float) -> float:
        return bits / 2 * (1 - math.exp(-4 * differ / bits))
    mean = samples * (1 - threshold)
    most = min(samples, mean + sigmas * math.sqrt(samples * threshold * (1 - threshold)))
    return min(bits, math.ceil(expected(most) + sigmas / 2 * math.sqrt(expected(most) / 2)))


def signatures(docs: DataFrame, words: int = 2, bands: int = 40, rows: int = 5,
               seed: int = 11) -> DataFrame:
    """``doc_id, th, n, set_id, s0..s3, keys``: one row per document of (doc_id, th, text).

    ``th`` is passed on; ``set_id`` is a 128-bit digest of the shingle set, ``s0..s3`` the odd
    sketch and ``keys`` the band keys; they are null for an empty set.
    """
    def run(batches):
        for b in chunks(batches):
            sets, off = shingle_sets(*text_bytes(b.column("text")), words)
            size = np.diff(off)
            some = size > 0
            minima = minhash(sets, off, bands * rows, seed)
            sketch = odd_sketch(minima)
            starts = off[:-1][some]
            d = [np.add.reduceat(mix(sets + U64(k)), starts) if len(starts) else sets for k in (1, 2)]
            digest = np.stack([mix(d[0] + size[some].astype(U64)), d[1]], 1)
            key = np.zeros((len(starts), bands), U64)
            for r in range(rows):
                key = mix(key + minima[:, r::rows].astype(U64) + U64(r))
            key = mix(key + np.arange(bands, dtype=U64) * U64(0x9E3779B97F4A7C15)).view(np.int64)
            at = np.full(len(size), -1)
            at[some] = np.arange(len(starts))
            idx = pa.array(at, mask=~some)
            ids = pa.array([x.tobytes() for x in digest], pa.binary())
            lists = pa.ListArray.from_arrays(np.arange(0, key.size + 1, bands, dtype=np.int32), key.ravel())
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("th"), pa.array(size), ids.take(idx),
                 *[pa.array(np.ascontiguousarray(sketch[:, k])).take(idx) for k in range(4)],
                 lists.take(idx)],
                names=["doc_id", "th", "n", "set_id", "s0", "s1", "s2", "s3", "keys"])
    return docs.mapInArrow(run, "doc_id long, th long, n long, set_id binary, s0 long, s1 long, s2 long, "
                                "s3 long, keys array<long>")


def full_sets(texts: DataFrame, words: int) -> DataFrame:
    """``rep, shingles`` of (rep, text): the full sets as arrays of 64-bit hashes."""
    def run(batches):
        for b in chunks(batches):
            sets, off = shingle_sets(*text_bytes(b.column("text")), words)
            lists = pa.ListArray.from_arrays(off.astype(np.int32), sets.view(np.int64))
            yield pa.RecordBatch.from_arrays([b.column("rep"), lists], names=["rep", "shingles"])
    return texts.mapInArrow(run, "rep long, shingles array<long>")


def sketch_distance(a: str, b: str) -> Column:
    """Population count of the XOR of two odd sketches with these name prefixes."""
    return sum((F.bit_count(F.col(f"{a}s{k}").bitwiseXOR(F.col(f"{b}s{k}"))) for k in range(4)), F.lit(0))


def _open(member: DataFrame, roots: DataFrame, turn: int) -> tuple[DataFrame, DataFrame]:
    """Members with their component, and the buckets that hold several components, with two leaders each."""
    side = member.join(roots, "rep")
    order = F.struct(F.xxhash64("rep", F.lit(turn)).alias("h"), "rep", "root")
    buckets = (side.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi"),
                                       F.array(F.min(order), F.max(order)).alias("leaders"))
               .where("lo < hi").select("key", "leaders"))
    return side, buckets


def _merge(roots: DataFrame, links: DataFrame) -> DataFrame:
    """``rep, root`` after the links (a, b) between representatives join their components."""
    a = roots.select(F.col("rep").alias("a"), F.col("root").alias("ra"))
    b = roots.select(F.col("rep").alias("b"), F.col("root").alias("rb"))
    joined = connected_components(links.join(a, "a").join(b, "b").select(F.col("ra").alias("a"), F.col("rb").alias("b")))
    return (roots.join(joined.withColumnRenamed("root", "to"), F.col("root") == F.col("node"), "left")
            .select("rep", F.coalesce("to", "root").alias("root")))


def _in_blocks(side: DataFrame, most_rows: int = 1024, most_shingles: int = 1 << 20) -> DataFrame:
    """Rows (key, n, ...) sorted by ``key, lo, hi``: all pairs of a bucket's rows meet in some (lo, hi).

    A bucket of bounded size is one block.  A larger one is cut into blocks by
    hash and every two blocks meet in a task of their own, so no task ever
    holds more than two blocks.
    """
    size = (side.groupBy("key").agg(F.greatest(F.ceil(F.count("*") / most_rows), F.ceil(F.sum("n") / most_shingles))
                                    .alias("blocks")))
    own = F.pmod(F.xxhash64("rep"), F.col("blocks"))
    met = F.transform(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1),
                      lambda j: F.struct(F.least(j, own).alias("lo"), F.greatest(j, own).alias("hi")))
    return (side.join(size, "key").withColumn("to", F.explode(met)).drop("blocks")
            .withColumns({"lo": F.col("to.lo"), "hi": F.col("to.hi")}).drop("to")
            .repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi", "rep"))


def _blocks(batches):
    """Arrow tables of one (key, lo, hi) each, from batches in that order."""
    held = None
    for b in batches:
        t = pa.Table.from_batches([b])
        t = t if held is None else pa.concat_tables([held, t])
        at = np.stack([t.column(c).to_numpy() for c in ("key", "lo", "hi")], 1)
        cut = np.flatnonzero((at[1:] != at[:-1]).any(1)) + 1
        for s, e in zip(np.r_[0, cut[:-1]], cut):
            yield t.slice(s, e - s).combine_chunks()
        held = t.slice(cut[-1]) if len(cut) else t
    if held is not None and held.num_rows:
        yield held.combine_chunks()


def _plausible(num: int, den: int, limit: int):
    """Keeps the members that have a partner of another component within size and sketch bounds."""
    def run(batches):
        for t in _blocks(batches):
            root, n = t.column("root").to_numpy(), t.column("n").to_numpy()
            sketch = np.stack([t.column(f"s{k}").to_numpy() for k in range(4)], 1).view(U64)
            good = np.zeros(len(n), bool)
            for s in range(0, len(n), 256):
                r = slice(s, s + 256)
                ok = root[r, None] != root[None]
                ok &= np.minimum(n[r, None], n[None]) * den >= np.maximum(n[r, None], n[None]) * num
                if ok.any():
                    ok &= sum(np.bitwise_count(sketch[r, None, k] ^ sketch[None, :, k]).astype(np.int16) for k in range(4)) <= limit
                    good[r] |= ok.any(1)
            if good.any():
                yield t.select(["key", "rep"]).filter(pa.array(good)).combine_chunks().to_batches()[0]
    return run


def common_counts(sets: list[np.ndarray], rows: np.ndarray, columns: int = 8192) -> np.ndarray:
    """Sizes of the intersections of ``sets[i]``, i in ``rows``, with all sets.

    Products of incidence matrices over ``columns`` shingles at a time; the
    counts are exact, since they stay far below 2^24.
    """
    size = np.array([len(x) for x in sets])
    owner = np.repeat(np.arange(len(sets)), size)
    _, word, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    several = times > 1
    word, owner = (np.cumsum(several) - 1)[word[several[word]]], owner[several[word]]
    order = np.argsort(word, kind="stable")
    word, owner = word[order], owner[order]
    out = np.zeros((len(rows), len(sets)), np.float32)
    for s in range(0, int(several.sum()), columns):
        lo, hi = np.searchsorted(word, [s, s + columns])
        m = np.zeros((len(sets), columns), np.float32)
        m[owner[lo:hi], word[lo:hi] - s] = 1
        out += m[rows] @ m.T
    return out.astype(np.int64)


def _exact(num: int, den: int):
    """Links (a, b) that join the components of each block: as few as do it, all checked on full sets."""
    def run(batches):
        for t in _blocks(batches):
            rep, root, n = (t.column(c).to_numpy() for c in ("rep", "root", "n"))
            values, times = np.unique(root, return_counts=True)
            rows = np.flatnonzero(root != values[np.argmax(times)])
            sets = [np.asarray(x) for x in t.column("shingles").to_numpy(zero_copy_only=False)]
            parent = {r: r for r in values.tolist()}

            def find(x):
                while parent[x] != x:
                    parent[x] = parent[parent[x]]
                    x = parent[x]
                return x
            links = []
            for s in range(0, len(rows), 256):
                some = rows[s:s + 256]
                both = common_counts(sets, some)
                ok = (both * (num + den) >= (n[some, None] + n[None]) * num) & (root[some, None] != root[None])
                for i, j in zip(*np.nonzero(ok)):
                    x, y = find(int(root[some[i]])), find(int(root[j]))
                    if x != y:
                        parent[max(x, y)] = min(x, y)
                        links.append((int(rep[some[i]]), int(rep[j])))
            if links:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*links)], names=["a", "b"])
    return run


def _linked_classes(docs: DataFrame, words: int, threshold: tuple[int, int], bands: int, rows: int,
                    seed: int, leader_rounds: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Signatures of all rows, classes of equal sets, and the component of each class over links between sets.

    ``docs`` has ``doc_id, th, text`` (``th``: hash of the text).  A class is numbered by ``rep`` and knows
    its smallest row (``doc_id, th``); ``rep, root`` covers the classes that share a band with another one.
    Ids say nothing here: rows that share one may be of several classes.
    """
    num, den = threshold
    sig = stage(signatures(docs, words, bands, rows, seed), "signatures")
    real = sig.where("set_id is not null and doc_id is not null")
    shape_of = ("n", "s0", "s1", "s2", "s3")
    reps = stage(real.groupBy("set_id")
                 .agg(F.min(F.struct("doc_id", "th", *shape_of, "keys")).alias("r"))
                 .select(F.monotonically_increasing_id().alias("at"), "set_id",
                         *[f"r.{c}" for c in ("doc_id", "th", *shape_of, "keys")]), "classes")
    # the smallest id numbers a class, as neighbours in id are often alike and then pack well;
    # where ids have rows of several classes, a number of its own does
    several = reps.groupBy("doc_id").agg(F.count("*").alias("classes")).where("classes > 1").take(1)
    reps = reps.withColumn("rep", F.col("at") if several else F.col("doc_id")).drop("at")

    member = reps.select("rep", F.explode("keys").alias("key"))
    shared = member.groupBy("key").agg(F.count("*").alias("members")).where("members > 1").select("key")
    member = stage(member.join(shared, "key"), "buckets")

    shape = reps.select("rep", *shape_of)
    limit = sketch_limit(bands * rows, num / den)
    close = (F.least("n", "n2") * den >= F.greatest("n", "n2") * num) & (sketch_distance("", "o_") <= limit)
    other = shape.select(F.col("rep").alias("rep2"), F.col("n").alias("n2"),
                         *[F.col(f"s{k}").alias(f"o_s{k}") for k in range(4)])

    wanted = stage(reps.join(member.select("rep").distinct(), "rep", "left_semi").select("rep", "doc_id", "th"), "wanted")
    sets = stage(full_sets(_class_texts(docs, sig, wanted), words), "sets")

    def verified(pairs: DataFrame) -> DataFrame:
        """The pairs (rep, rep2) of plausible sketches whose full sets are similar enough."""
        a = sets.select("rep", F.col("shingles").alias("a"))
        b = sets.select(F.col("rep").alias("rep2"), F.col("shingles").alias("b"))
        both = F.size(F.array_intersect("a", "b"))
        return (pairs.join(a, "rep").join(b, "rep2")
                .where(both * (num + den) >= (F.size("a") + F.size("b")) * num)
                .select(F.col("rep").alias("a"), F.col("rep2").alias("b")))

    # rounds of stars: every member tries the likest of its buckets' leaders
    roots = member.select("rep", F.col("rep").alias("root")).distinct()
    for turn in range(leader_rounds):
        side, buckets = _open(member, roots, turn)
        tried = (side.join(buckets, "key").select("rep", "root", F.explode("leaders").alias("l"))
                 .where("root <> l.root").select("rep", F.col("l.rep").alias("rep2")).distinct())
        best = (tried.join(shape, "rep").join(other, "rep2").where(close)
                .groupBy("rep").agg(F.min(F.struct(sketch_distance("", "o_").alias("d"), "rep2")).alias("b"))
                .select("rep", "b.rep2"))
        links = stage(verified(best), "stars")
        if turn and not links.take(1):
            break
        roots = stage(_merge(roots, links), "roots")

    # what is left: all members of one bucket whose components differ
    side, buckets = _open(member, roots, leader_rounds)
    side = side.join(buckets.select("key"), "key", "left_semi").join(shape, "rep")
    plausible = stage(_in_blocks(side).mapInArrow(_plausible(num, den, limit), "key long, rep long"), "plausible")
    side = (plausible.distinct().join(roots, "rep").join(sets, "rep")
            .select("key", "rep", "root", F.size("shingles").cast("long").alias("n"), "shingles"))
    rest = stage(_in_blocks(side).mapInArrow(_exact(num, den), "a long, b long"), "rest")
    return sig, reps, stage(_merge(roots, rest), "components")


def _class_texts(docs: DataFrame, sig: DataFrame, wanted: DataFrame) -> DataFrame:
    """``rep, text``: one text of every wanted class, that of its smallest row."""
    rows = join_bounded(docs, wanted, ["doc_id", "th"], "inner").select("rep", "text")
    often = stage(join_bounded(sig.select("doc_id", "th"), wanted, ["doc_id", "th"], "inner")
                  .groupBy("rep").agg(F.count("*").alias("times")).where("times > 1").select("rep"), "repeated")
    if not often.take(1):
        return rows
    return (join_bounded(rows, often, "rep", "left_anti")
            .unionByName(join_bounded(rows, often, "rep", "left_semi").dropDuplicates(["rep"])))


def _same_id_links(sig: DataFrame, reps: DataFrame) -> DataFrame:
    """Links (a, b) that join all classes of each id that has rows of several."""
    real = sig.where("set_id is not null and doc_id is not null").select("doc_id", "set_id")
    several = (real.groupBy("doc_id").agg(F.min("set_id").alias("lo"), F.max("set_id").alias("hi"))
               .where("lo <> hi").select("doc_id", "lo"))
    pairs = real.join(several, "doc_id").where("set_id <> lo").select("set_id", "lo").distinct()
    a, b = (reps.select(F.col("set_id").alias(c), F.col("rep").alias(n)) for c, n in (("lo", "a"), ("set_id", "b")))
    return stage(pairs.join(a, "lo").join(b, "set_id").select("a", "b"), "same-id")


def _keyed(documents: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return (narrow(documents, {"doc_id": id_col, "text": text_col})
            .withColumns({"doc_id": F.col("doc_id").cast("long"), "th": F.xxhash64("text")}).select("doc_id", "th", "text"))


def near_duplicates(documents: DataFrame, words: int = 5, threshold: tuple[int, int] = (80, 100),
                    bands: int = 40, rows: int = 5, id_col: str = "doc_id",
                    text_col: str = "text", seed: int = 11, leader_rounds: int = 2) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``documents``.

    Documents are linked when ``100 * |A ∩ B| >= 80 * |A ∪ B|`` (``threshold``
    as a fraction of integers).  ``component_id`` is the smallest id reachable
    over links, ``kept`` marks the row that has it.  All rows of one id are one
    document: it is linked with whatever one of its texts is linked with.
    """
    sig, reps, roots = _linked_classes(_keyed(documents, id_col, text_col), words, threshold, bands, rows, seed, leader_rounds)
    same = _same_id_links(sig, reps)
    if same.take(1):
        roots = reps.select("rep").join(roots, "rep", "left").select("rep", F.coalesce("root", "rep").alias("root"))
        roots = stage(_merge(roots, same), "documents")
    first = roots.join(reps.select("rep", "doc_id"), "rep").groupBy("root").agg(F.min("doc_id").alias("component_id"))
    classes = (reps.select("set_id", "rep", "doc_id").join(roots, "rep", "left").join(first, "root", "left")
               .select("set_id", F.coalesce("component_id", "doc_id").alias("component_id")))
    out = sig.select("doc_id", "n", F.when(F.col("doc_id").isNotNull(), F.col("set_id")).alias("set_id"))
    return (out.join(classes, "set_id", "left")
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.coalesce("component_id", "doc_id").alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))))


def one_per_component(documents: DataFrame, words: int = 5, threshold: tuple[int, int] = (80, 100),
                      bands: int = 40, rows: int = 5, id_col: str = "doc_id", text_col: str = "text",
                      seed: int = 11, leader_rounds: int = 2) -> DataFrame:
    """``documents`` with one row of each group of linked texts, that of the smallest id.

    A row goes only because its text is linked with, or equal to, that of the
    row that stays: unlike texts that share an id all stay, as do rows
    without an id and rows without a word.
    """
    sig, reps, roots = _linked_classes(_keyed(documents, id_col, text_col), words, threshold, bands, rows, seed, leader_rounds)
    classes = reps.select("set_id", "rep", "doc_id", "th").join(roots, "rep", "left").withColumn("root", F.coalesce("root", "rep"))
    best = classes.groupBy("root").agg(F.min(F.struct("doc_id", "th")).alias("best"))
    classes = classes.join(best, "root").select("set_id", "best")
    judged = stage(sig.where("set_id is not null and doc_id is not null").select("doc_id", "th", "set_id").join(classes, "set_id")
                   .select("doc_id", "th", (F.struct("doc_id", "th") == F.col("best")).alias("stays")), "judged")
    key = ["doc_id", "th"]
    rows_ = packed(documents, doc_id=F.col(f"`{id_col}`").cast("long"), th=F.xxhash64(F.col(f"`{text_col}`")))
    rest = join_bounded(rows_, stage(judged.where("not stays").select(*key).distinct(), "dropped"), key, "left_anti")
    again = stage(judged.where("stays").groupBy(*key).agg(F.count("*").alias("times")).where("times > 1").select(*key), "repeated")
    if again.take(1):
        rest = join_bounded(rest, again, key, "left_anti").unionByName(
            join_bounded(rest, again, key, "left_semi").dropDuplicates(key))
    return unpacked(rest, documents)
