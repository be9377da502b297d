"""Document fingerprints from a randomised edit embedding.

A pointer walks over the characters of a text; at step j it writes down the
character it stands on and moves on, or stays, as a random bit shared by all
texts for (j, character) says (Chakraborty, Goldenberg and Koucký).  Two texts
at a small edit distance soon write the same characters at the same steps, so
the Hamming distance of what they write reflects their edit distance.

A text of n characters is written in at most 3n steps.  The fingerprint keeps
``SAMPLES`` fixed positions of each octave [2^o, 2^(o+1)) of the steps, for
the last ``OCTAVES`` octaves that the text reaches (31/32 of its steps), each
as one hexadecimal digit, 0 past its end.  ``likeness`` compares two
fingerprints by the share of equal steps, each sample standing for its part of
the octave.  ``near_classes`` finds candidates by bands of samples of ``WALKS``
walks with bits of their own, drops those whose common pieces prove too many
edits, and verifies the others by edit distance.

Scale: the walk runs over whole texts in lockstep with NumPy, a bounded number
of characters at a time.  The next document in descending id is found without
a global order: rows are dealt to buckets by id bounds, one shuffle of the
texts, and the first row of each bucket also goes to the bucket before it, so
that every task has its rows' neighbours.

Edge cases: null and empty texts are equal and like each other fully; rows
without an id come last; rows of one id are ordered by the hash of their text,
and identical rows are neighbours; a lone document is its own next.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.session import join_bounded, shuffle_partitions

from .common import U64, mix, narrow, stage
from .near_dedup import _blocks, _in_blocks, _merge

OCTAVES = 5
SAMPLES = 48
TOP = 40                # octaves that can occur
PERIOD = 1 << 14        # steps after which the shared bits repeat
BATCH_CHARS = 6 << 20
LOCKSTEP = 24           # texts below which single walks are faster
WALKS = 6               # walks whose bands are keys: at 0.1 edits a character one walk finds 7 texts of 10

_SYMBOL_MIX = np.uint32(2654435761)


def _positions(octave: int) -> np.ndarray:
    """The sampled steps of an octave, the same for every text."""
    first = 1 << octave
    if first <= SAMPLES:
        return np.arange(first, 2 * first)
    rng = np.random.default_rng(1000 + octave)
    return np.sort(first + (np.arange(SAMPLES) * first // SAMPLES) + rng.integers(0, first // SAMPLES, SAMPLES))


class Walker:
    """The shared walk: bits for (step, symbol) and the sampled steps up to a length."""

    def __init__(self, seed: int = 17):
        self.bits = np.random.default_rng(seed).integers(0, 2, (PERIOD, 256), dtype=np.uint8)
        self.bits[:, 0] = 0
        self.rows = [r.tobytes() for r in self.bits]

    def samples(self, texts: list[str]) -> tuple[list[np.ndarray], list[int]]:
        """Sampled symbols (0 past the end) of each text, and its last octave."""
        n = np.array([len(t) for t in texts], dtype=np.int64)
        order = np.argsort(-n, kind="stable")
        codes = np.frombuffer("\0".join([texts[i] for i in order] + [""]).encode("utf-32-le"), np.uint32)
        flat = ((codes * _SYMBOL_MIX) >> np.uint32(8)) % np.uint32(255) + np.uint32(1)
        flat = flat.astype(np.uint8)
        size = n[order]
        start = np.r_[0, np.cumsum(size + 1)[:-1]]
        flat[start + size] = 0
        longest = int(size[0]) if len(size) else 0
        last = max(0, (3 * longest).bit_length())
        steps = np.concatenate([_positions(o) for o in range(last)]) if last else np.zeros(0, np.int64)
        out = np.zeros((len(texts), len(steps)), np.uint8)
        live = np.flatnonzero(size > 0)
        pos = start[live].copy()
        column, j, total = 0, 0, 3 * longest
        while j < total and len(live) > LOCKSTEP:
            for j in range(j, min(j + 128, total)):
                c = flat[pos]
                if column < len(steps) and steps[column] == j:
                    out[live, column] = c
                    column += 1
                pos += self.bits[j % PERIOD][c]
            j += 1
            on = flat[pos] != 0
            live, pos = live[on], pos[on]
        wanted = steps[column:].tolist()
        for t, p in zip(live.tolist(), pos.tolist()):
            s = flat[start[t]:start[t] + size[t] + 1].tobytes()
            p -= int(start[t])
            at, rows, k = j, self.rows, column
            for stop in wanted:
                while at < stop:
                    p += rows[at % PERIOD][s[p]]
                    at += 1
                if not s[p]:
                    break
                out[t, k] = s[p]
                k += 1
        back = np.empty_like(order)
        back[order] = np.arange(len(order))
        return out[back], [max(0, int(3 * x).bit_length() - 1) if x else -1 for x in n]


def fingerprints(walker: Walker, texts: list[str]) -> list[str]:
    """``last octave in two digits``, then the digits of the last octaves' samples; '' has none."""
    sampled, last = walker.samples(texts)
    digits = np.where(sampled > 0, sampled % 15 + 1, 0).astype(np.uint8)
    hexed = np.frombuffer(b"0123456789abcdef", np.uint8)[digits]
    begin = np.r_[0, np.cumsum([min(1 << o, SAMPLES) for o in range(TOP)])]
    return [f"{o:02d}" + hexed[i, begin[max(0, o - OCTAVES + 1)]:begin[o + 1]].tobytes().decode() if o >= 0 else "-"
            for i, o in enumerate(last)]


def _octaves(print_: str) -> dict[int, str]:
    if print_ == "-":
        return {}
    last, digits, out = int(print_[:2]), print_[2:], {}
    for o in range(max(0, last - OCTAVES + 1), last + 1):
        k = min(1 << o, SAMPLES)
        out[o], digits = digits[:k], digits[k:]
    return out


def likeness(a: str, b: str) -> float:
    """Estimated share of the written steps on which two fingerprints agree, 0 to 1."""
    if a == b:
        return 1.0
    x, y = _octaves(a), _octaves(b)
    top = max([*x, *y])
    same = all_ = 0.0
    for o in range(max(0, top - OCTAVES + 1), top + 1):
        k = min(1 << o, SAMPLES)
        u, v = x.get(o, "0" * k), y.get(o, "0" * k)
        used = sum(c != "0" or d != "0" for c, d in zip(u, v))
        hits = sum(c == d != "0" for c, d in zip(u, v))
        all_ += used * (1 << o) / k
        same += hits * (1 << o) / k
    return same / all_ if all_ else 1.0


def _groups(batches: Iterable[pa.RecordBatch]) -> Iterator[list[dict]]:
    """Rows in order, about ``BATCH_CHARS`` characters at a time; each group starts with the last row before."""
    rows, chars = [], 0
    for b in batches:
        for s in range(0, b.num_rows, 256):
            for r in b.slice(s, 256).to_pylist():
                r["text"] = r["text"] or ""
                rows.append(r)
                chars += len(r["text"])
                if chars >= BATCH_CHARS:
                    yield rows
                    rows, chars = rows[-1:], len(rows[-1]["text"])
    if len(rows) > 1:
        yield rows


def _with_next(documents: DataFrame, bucket_bytes: int) -> DataFrame:
    """Rows in partitions of whole id buckets, ordered, each bucket closed by a copy of the row that follows it."""
    spark = documents.sparkSession
    docs = documents.withColumn("th", F.xxhash64("text")).withColumn("at", F.col("doc_id").cast("double"))
    size = documents.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = max(4 * shuffle_partitions(spark), -(-size // bucket_bytes))
    cuts = documents.where("doc_id is not null").select(F.col("doc_id").cast("double").alias("at")).approxQuantile(
        "at", [i / count for i in range(1, count)], 0.25 / count) if size else []
    splits = [-float("inf"), *sorted(set(cuts)), float("inf")]
    if len(splits) > 2:
        docs = Bucketizer(splits=splits, inputCol="at", outputCol="bucket", handleInvalid="keep").transform(docs)
    else:
        docs = docs.withColumn("bucket", F.lit(0))
    docs = docs.withColumn("bucket", F.when(F.col("doc_id").isNull(), F.lit(-1)).otherwise(F.col("bucket").cast("int"))).drop("at")
    # one row a bucket: its first, and the bucket that comes before in descending order
    heads = sorted((r["bucket"], r["h"]["doc_id"], r["h"]["th"]) for r in
                   docs.groupBy("bucket").agg(F.max(F.struct("doc_id", "th")).alias("h")).collect())
    follows = [(i, th, heads[(n + 1) % len(heads)][0]) for n, (_, i, th) in enumerate(heads)]
    kind = dict(docs.dtypes)["doc_id"]
    ghosts = F.broadcast(spark.createDataFrame(follows, f"_id {kind}, _th long, ghost int"))
    docs = docs.join(ghosts, docs["doc_id"].eqNullSafe(F.col("_id")) & (F.col("th") == F.col("_th")), "left")
    first = F.struct("bucket", F.lit(False).alias("copy"))
    again = F.struct(F.col("ghost").alias("bucket"), F.lit(True).alias("copy"))
    docs = docs.select("doc_id", "text", "th", F.explode(
        F.when(F.col("ghost").isNull(), F.array(first)).otherwise(F.array(first, again))).alias("to"))
    return (docs.select("doc_id", "text", "th", "to.bucket", "to.copy").repartition("bucket")
            .sortWithinPartitions("bucket", "copy", F.col("doc_id").desc_nulls_last(), F.desc("th")))


def edited_neighbours(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      bucket_bytes: int = 8 << 20, seed: int = 17) -> DataFrame:
    """Fingerprint of every text and of its edited text, and their likenesses.

    The edited text has its last ``floor(n / 2)`` code points replaced by the
    first as many (or all) of the next document in descending id, after the
    last the first.  Columns: ``doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next``.
    """
    docs = narrow(documents, {"doc_id": id_col, "text": text_col})

    def run(batches):
        walker = Walker(seed)
        for rows in _groups(batches):
            texts, out = [r["text"] for r in rows], []
            edited = [t[:len(t) - len(t) // 2] + f[:len(t) // 2] for t, f in zip(texts, texts[1:])]
            prints = fingerprints(walker, texts + edited)
            for i, r in enumerate(rows[:-1]):
                if not r["copy"]:
                    a, e = prints[i], prints[len(rows) + i]
                    out.append((r["doc_id"], len(texts[i]), hashlib.sha256(edited[i].encode()).hexdigest(), a, e,
                                likeness(a, e), likeness(a, prints[i + 1])))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=names)
    kind = dict(docs.dtypes)["doc_id"]
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    kinds = [{"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[kind], pa.int64(), pa.string(),
             pa.string(), pa.string(), pa.float64(), pa.float64()]
    schema = f"doc_id {kind}, n_chars long, edited_sha256 string, fingerprint string, " \
             "edited_fingerprint string, near_edited double, near_next double"
    return _with_next(docs, bucket_bytes).mapInArrow(run, schema)


def edit_distance(a: str, b: str) -> int:
    """Edit distance of two whole texts, bit-parallel over ``a``."""
    if not a or not b:
        return len(a) + len(b)
    masks: dict[str, int] = {}
    for i, c in enumerate(a):
        masks[c] = masks.get(c, 0) | 1 << i
    full, top = (1 << len(a)) - 1, 1 << len(a) - 1
    plus, minus, score = full, 0, len(a)
    for c in b:
        eq = masks.get(c, 0)
        d0 = ((((eq & plus) + plus) ^ plus) | eq | minus) & full
        up, down = minus | ~(plus | d0) & full, plus & d0
        score += bool(up & top) - bool(down & top)
        up = (up << 1 | 1) & full
        plus, minus = (down << 1 | ~(d0 | up)) & full, up & d0
    return score


def grams(text: str, q: int) -> np.ndarray:
    """Hashes of all runs of ``q`` characters, in order; of the whole text if it is shorter."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(U64)
    odd = mix(np.arange(1, q + 1, dtype=U64)) | U64(1)
    m = len(codes) - q + 1
    if m < 1:
        return mix((codes * odd[:len(codes)]).sum(dtype=U64)[None] + U64(len(codes)))
    out = np.zeros(m, U64)
    for k in range(q):
        out += codes[k:k + m] * odd[k]
    return mix(out)


def candidate_keys(prints: Sequence[str], band: int = 6) -> list[str]:
    """Bands of a text's fingerprints, one of each walk; texts that share one are compared.

    A band past the text's end says nothing and is no key.
    """
    keys = [f"{w}:{o}:{i}:{d[i:i + band]}" for w, p in enumerate(prints) for o, d in _octaves(p).items()
            for i in range(0, max(1, len(d) - band + 1), band) if d[i:i + band].strip("0")]
    return keys or ["-"]


def numbered(hashes: np.ndarray) -> np.ndarray:
    """Distinct sorted values, one for each hash and each time that it occurs."""
    h = np.sort(hashes)
    first = np.r_[True, h[1:] != h[:-1]]
    start = np.maximum.accumulate(np.where(first, np.arange(len(h)), 0))
    return np.unique(mix(h + (np.arange(len(h)) - start).astype(U64) * U64(0x9E3779B97F4A7C15)))


class Pairs:
    """Whether two texts are within ``max_rate`` edits a character; what is known of a text is kept."""

    def __init__(self, texts: list[str], max_rate: float):
        self.texts, self.rate, self.sets = texts, max_rate, {}
        self.q = max(1, min(8, int(0.5 / max_rate))) if max_rate > 0 else 8

    def _set(self, i: int) -> np.ndarray:
        if i not in self.sets:
            self.sets[i] = numbered(grams(self.texts[i], self.q))
        return self.sets[i]

    def near(self, i: int, j: int) -> bool:
        x, y = self.texts[i], self.texts[j]
        longest = max(len(x), len(y))
        if x == y:
            return True
        if abs(len(x) - len(y)) > self.rate * longest:
            return False
        # an edit destroys at most q pieces
        if min(len(x), len(y)) >= self.q:
            both = len(np.intersect1d(self._set(i), self._set(j), assume_unique=True))
            if longest - self.q + 1 - both > self.q * self.rate * longest:
                return False
        return edit_distance(x, y) <= self.rate * longest


def near_classes(documents: DataFrame, max_rate: float = 0.1, min_likeness: float = 0.0, band: int = 6,
                 id_col: str = "doc_id", text_col: str = "text", seed: int = 17) -> DataFrame:
    """``doc_id, class_id``: texts joined by chains of pairs within ``max_rate`` edits a character.

    Candidates share ``band`` neighbouring samples of the last octaves in one of ``WALKS``
    walks.  At 0.1 edits a character, dealt at random, that finds 59 of 60 texts of
    the test tables, and 2 % of the unlike pairs.  Every member of a bucket first tries
    its smallest; buckets that still hold several components are compared in
    full, in tasks that hold two bounded blocks.  ``min_likeness`` above 0 also
    asks for that likeness of the fingerprints, which loses pairs.
    """
    docs = narrow(documents, {"doc_id": id_col, "text": text_col}).where("doc_id is not null")
    docs = docs.withColumn("doc_id", F.col("doc_id").cast("long"))

    def run(batches):
        walkers = [Walker(seed + i) for i in range(WALKS)]
        for b in batches:
            for s in range(0, b.num_rows, 512):
                part = b.slice(s, 512)
                texts = [t or "" for t in part.column("text").to_pylist()]
                every = [fingerprints(w, texts) for w in walkers]
                prints, keys = every[0], [candidate_keys(p, band) for p in zip(*every)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(prints, pa.string()), pa.array(keys, pa.list_(pa.string()))],
                    names=["doc_id", "print", "keys"])
    sig = stage(docs.mapInArrow(run, "doc_id long, print string, keys array<string>"), "prints")
    member = sig.select(F.col("doc_id").alias("rep"), F.explode("keys").alias("key")).distinct().withColumn("key", F.xxhash64("key"))
    bucket = member.groupBy("key").agg(F.min("rep").alias("leader"), F.count("*").alias("members")).where("members > 1")
    member = stage(member.join(bucket, "key").select("rep", "key", "leader"), "buckets")
    roots = sig.select(F.col("doc_id").alias("rep"), F.col("doc_id").alias("root")).distinct()

    def alike(p: str, q: str) -> bool:
        return min_likeness <= 0 or likeness(p, q) >= min_likeness

    def check(batches):
        for b in batches:
            ok = []
            for r in b.to_pylist():
                ok.append(alike(r["print"], r["print2"]) and Pairs([r["text"], r["text2"]], max_rate).near(0, 1))
            yield b.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))
    side = sig.select("doc_id", "print").join(docs, "doc_id").select(
        F.col("doc_id").alias("rep"), "print", F.coalesce("text", F.lit("")).alias("text"))
    pairs = member.where("rep <> leader").select("rep", "leader").distinct()
    linked = (pairs.join(side, "rep").withColumnsRenamed({"text": "text2", "print": "print2", "rep": "b"})
              .join(side, F.col("leader") == F.col("rep"))
              .select(F.col("rep").alias("a"), "b", "text", "text2", "print", "print2")
              .mapInArrow(check, "a long, b long"))
    roots = stage(_merge(roots, stage(linked, "stars")), "roots")

    def compare(batches):
        for t in _blocks(batches):
            rep, root = t.column("rep").to_pylist(), t.column("root").to_pylist()
            prints, pair = t.column("print").to_pylist(), Pairs(t.column("text").to_pylist(), max_rate)
            parent = {r: r for r in root}

            def find(x):
                while parent[x] != x:
                    parent[x] = parent[parent[x]]
                    x = parent[x]
                return x
            links = []
            for i in range(len(rep)):
                for j in range(i):
                    x, y = find(root[i]), find(root[j])
                    if x != y and alike(prints[i], prints[j]) and pair.near(i, j):
                        parent[max(x, y)] = min(x, y)
                        links.append((rep[i], rep[j]))
            if links:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*links)], names=["a", "b"])
    side_roots = member.select("rep", "key").join(roots, "rep")
    still = side_roots.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo < hi").select("key")
    rest = side_roots.join(still, "key", "left_semi").join(side.withColumn("n", F.length("text").cast("long")), "rep")
    links = stage(_in_blocks(rest, 128).mapInArrow(compare, "a long, b long"), "rest")
    final = stage(_merge(roots, links), "classes")
    return (join_bounded(sig.select("doc_id"), final.withColumnRenamed("rep", "doc_id"), "doc_id", "left")
            .select("doc_id", F.coalesce("root", "doc_id").alias("class_id")))
