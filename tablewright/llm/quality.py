"""Quality classifier: attention-based multiple-instance learning.

A document is a bag of passages of ``PASSAGE_WORDS`` words that cover its
whole text.  Every passage is encoded as hashed byte-trigram frequencies and a
few shape figures (shares of character classes, word lengths, repetition),
then projected to a small vector h.  Gated attention (Ilse, Tomczak and
Welling) gives each passage the weight softmax(w . (tanh(V h) * sigmoid(U h)))
over its bag, and the weighted sum of the h is scored by a logistic unit.
Only document labels are used; which passages matter is learned.

Scale: scoring maps over Arrow batches in place, with a model of a few
thousand numbers.  Training uses at most ``max_documents`` labelled documents
(different rows of id and text), taken by hash, with all their passages; that
is the documented bound of the fit.  The sampled ids and the hashes of their
texts are broadcast to the scan of the texts.

Edge cases: null and empty texts are a bag of one empty passage and get a
score; a null id is scored and counts as not held out; several labels of one
document are averaged and rounded; with no label, or one class only, the score
is the smoothed share of label 1.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import chunks, narrow, text_bytes, word_hashes

PASSAGE_WORDS = 96
HASHED = 256
KEEP_FROM = 0.3

_CLASS = np.full(256, 5, np.int32)          # other marks
_CLASS[65:91] = 0                           # A-Z
_CLASS[97:123] = 1                          # a-z
_CLASS[48:58] = 2                           # digits
_CLASS[[0x20, *range(0x09, 0x0E)]] = 3      # white space
_CLASS[[0x2C, 0x2E]] = 4                    # comma, full stop
_CLASS[128:] = 6                            # beyond ASCII
_CLASS[[0x0A]] = 7                          # line feed
CLASSES = 8
FEATURES = HASHED + CLASSES + 5


def held_out(doc_id: Column, folds: int = 5) -> Column:
    """True for the rows whose labels training must not see."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == 0, F.lit(False))


def passages(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Feature rows of all passages of the texts, and the n+1 passage offsets (one passage at least each)."""
    words, woff, starts = word_hashes(data, off, lower=False)
    n = len(off) - 1
    count = np.maximum(1, -(-np.diff(woff) // PASSAGE_WORDS))
    poff = np.r_[0, np.cumsum(count)]
    total = int(poff[-1])
    owner = np.repeat(np.arange(n), np.diff(woff))
    at = poff[owner] + (np.arange(len(words)) - woff[owner]) // PASSAGE_WORDS
    x = np.zeros((total, FEATURES), np.float32)
    if len(data):
        # a byte belongs to the passage of the last word that started, or to its text's first
        own = np.zeros(len(data) + 1, np.int32)
        np.maximum.at(own, off[:-1], poff[:-1].astype(np.int32))
        np.maximum.at(own, starts, at.astype(np.int32))
        own = np.maximum.accumulate(own)[:-1]
        tri = data.astype(np.uint32)
        tri[:-1] += data[1:] * np.uint32(256)
        tri[:-2] += data[2:] * np.uint32(65536)
        tri *= np.uint32(2654435761)
        tri >>= np.uint32(24)
        code = tri.astype(np.int32)
        x[:, :HASHED] = np.bincount(np.int32(HASHED) * own + code, minlength=total * HASHED).reshape(total, HASHED)
        kinds = np.bincount(np.int32(CLASSES) * own + _CLASS[data], minlength=total * CLASSES).reshape(total, CLASSES)
        size = np.maximum(1, kinds.sum(1, keepdims=True))
        x[:, :HASHED] = np.sqrt(x[:, :HASHED] / (size + 100))  # a short passage says little
        x[:, HASHED:HASHED + CLASSES] = kinds / size
        w = np.bincount(at, minlength=total)
        pair = np.unique(at.astype(np.uint64) << np.uint64(40) | words >> np.uint64(24))
        distinct = np.bincount((pair >> np.uint64(40)).astype(np.int64), minlength=total)
        some = np.maximum(w, 1)
        x[:, -5] = distinct / some
        x[:, -4] = np.log1p(w) / np.log(PASSAGE_WORDS + 1)
        x[:, -3] = np.log1p(size[:, 0] / some) / 4
        x[:, -2] = kinds[:, 0] / np.maximum(1, kinds[:, :2].sum(1))
        x[:, -1] = kinds[:, 5] / some
    return x, poff


@dataclass
class AttentionModel:
    """Weights of the encoder, the gated attention and the scoring unit."""

    params: dict[str, np.ndarray]
    mean: np.ndarray
    scale: np.ndarray

    def forward(self, x: np.ndarray, poff: np.ndarray) -> dict[str, np.ndarray]:
        p = self.params
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        h = np.tanh(z @ p["E"] + p["e"])
        t, g = np.tanh(h @ p["V"]), 1 / (1 + np.exp(-(h @ p["U"])))
        raw = (t * g) @ p["w"]
        bag = np.repeat(np.arange(len(poff) - 1), np.diff(poff))
        ex = np.exp(raw - np.maximum.reduceat(raw, poff[:-1])[bag])
        a = ex / np.add.reduceat(ex, poff[:-1])[bag]
        b = np.add.reduceat(a[:, None] * h, poff[:-1], axis=0)
        y = 1 / (1 + np.exp(-np.clip(b @ p["c"] + p["d"], -30, 30)))
        return {"z": z, "h": h, "t": t, "g": g, "a": a, "b": b, "y": y, "bag": bag}

    def scores(self, x: np.ndarray, poff: np.ndarray) -> np.ndarray:
        return self.forward(x, poff)["y"].astype(np.float64)

    def gradients(self, f: dict, y: np.ndarray, weight: np.ndarray, decay: float) -> dict[str, np.ndarray]:
        p, bag, h = self.params, f["bag"], f["h"]
        dy = weight * (f["y"] - y) / len(y)
        db = dy[:, None] * p["c"]
        dh = f["a"][:, None] * db[bag]
        da = (h * db[bag]).sum(1)
        dr = f["a"] * (da - np.bincount(bag, f["a"] * da, minlength=len(y))[bag])
        dt, dg = dr[:, None] * p["w"] * f["g"] * (1 - f["t"] ** 2), dr[:, None] * p["w"] * f["t"] * f["g"] * (1 - f["g"])
        dh = (dh + dt @ p["V"].T + dg @ p["U"].T) * (1 - h ** 2)
        g = {"c": f["b"].T @ dy, "d": dy.sum(), "w": (f["t"] * f["g"]).T @ dr, "V": h.T @ dt, "U": h.T @ dg,
             "E": f["z"].T @ dh, "e": dh.sum(0)}
        return {k: v + decay * p[k] * (k in "EVUc") for k, v in g.items()}


def fit(x: np.ndarray, poff: np.ndarray, y: np.ndarray, seed: int = 5, hidden: int = 16, gate: int = 8,
        epochs: int = 40, batch: int = 128, rate: float = 0.004, decay: float = 2e-4) -> AttentionModel:
    """Fit on bags (feature rows, offsets, labels 0/1) with Adam and balanced class weights."""
    rng = np.random.default_rng(seed)
    init = {"E": (FEATURES, hidden), "e": (hidden,), "V": (hidden, gate), "U": (hidden, gate), "w": (gate,),
            "c": (hidden,), "d": ()}
    p = {k: rng.normal(0, 1 / np.sqrt(s[0]), s) if s and k != "e" else np.zeros(s) for k, s in init.items()}
    model = AttentionModel(p, x.mean(0), x.std(0) + 1e-3)
    share = np.clip(y.mean(), 1e-6, 1 - 1e-6)
    weight = np.where(y == 1, 0.5 / share, 0.5 / (1 - share))
    m, v, step = {k: 0.0 for k in p}, {k: 0.0 for k in p}, 0
    epochs = max(epochs, min(400, -(-4000 * batch // (10 * max(1, len(y))))))
    for epoch in range(epochs):
        order = rng.permutation(len(y))
        for s in range(0, len(order), batch):
            docs = order[s:s + batch]
            size = poff[docs + 1] - poff[docs]
            off = np.r_[0, np.cumsum(size)]
            rows = np.repeat(poff[docs] - off[:-1], size) + np.arange(off[-1])
            g = model.gradients(model.forward(x[rows], off), y[docs], weight[docs], decay)
            step += 1
            now = rate * (1 - epoch / epochs)
            for k in p:
                m[k] = 0.9 * m[k] + 0.1 * g[k]
                v[k] = 0.999 * v[k] + 0.001 * g[k] ** 2
                p[k] = p[k] - now * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.999 ** step)) + 1e-8)
    return model


def train(documents: DataFrame, labels: DataFrame, max_documents: int = 6000,
          label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text",
          seed: int = 5) -> AttentionModel | float:
    """Fit on a bounded, hashed sample of the labelled documents that are not held out.

    Rows of one id and text count once.  Where an id has several texts, each id
    has one of them in the sample before any has a second.
    Returns the share of label 1 (smoothed) if there is no choice to learn.
    """
    docs = narrow(documents, {"doc_id": id_col, "text": text_col})
    marks = (narrow(labels, {"doc_id": id_col, "y": label_col}).where(F.col("y").isin(0, 1) & ~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.round(F.avg("y")).cast("int").alias("y"), F.xxhash64("doc_id", F.lit(seed)).alias("k")))
    ids = [(r["doc_id"], r["y"]) for r in marks.orderBy("k", "doc_id").limit(max_documents).collect()]
    spark, kind = documents.sparkSession, dict(docs.dtypes)["doc_id"]
    docs = docs.withColumn("th", F.xxhash64("text"))
    texts = docs.select("doc_id", "th").join(
        F.broadcast(spark.createDataFrame(ids, marks.select("doc_id", "y").schema)), "doc_id").distinct()
    first = texts.groupBy("doc_id").agg(F.min("th").alias("first"))
    chosen = (texts.join(first, "doc_id").orderBy(F.col("th") != F.col("first"), F.xxhash64("doc_id", "th", F.lit(seed)), "doc_id", "th")
              .select("doc_id", "y", "th").limit(max_documents).collect())
    sample = spark.createDataFrame([tuple(r) for r in chosen], texts.select("doc_id", "y", "th").schema)
    bags = (docs.join(F.broadcast(sample), ["doc_id", "th"]).groupBy("doc_id", "th", "y").agg(F.first("text").alias("text"))
            .select("doc_id", "y", "text"))

    def run(batches):
        for b in chunks(batches):
            x, poff = passages(*text_bytes(b.column("text")))
            rows = [x[s:e].astype(np.float16).tobytes() for s, e in zip(poff, poff[1:])]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("y"), pa.array(rows, pa.binary())],
                                             names=["doc_id", "y", "x"])
    got = bags.mapInArrow(run, f"doc_id {kind}, y int, x binary").toArrow()
    order = pc.sort_indices(got, sort_keys=[("doc_id", "ascending"), ("x", "ascending")])
    got = got.take(order)
    y = np.array(got.column("y").to_pylist(), dtype=float)
    if len(set(y.tolist())) < 2:
        return float((y.sum() + 1) / (len(y) + 2))
    parts = [np.frombuffer(v, np.float16).reshape(-1, FEATURES) for v in got.column("x").to_pylist()]
    poff = np.r_[0, np.cumsum([len(v) for v in parts])]
    return fit(np.concatenate(parts).astype(np.float32), poff, y, seed)


def score(documents: DataFrame, model: AttentionModel | float, id_col: str = "doc_id",
          text_col: str = "text", threshold: float = KEEP_FROM) -> DataFrame:
    """``doc_id, held_out, score, predicted, n_passages, top_passage, top_weight`` per document.

    ``top_passage`` is the number of the passage with the largest attention weight.
    """
    docs = narrow(documents, {"doc_id": id_col, "text": text_col})

    def run(batches):
        for b in chunks(batches):
            x, poff = passages(*text_bytes(b.column("text")))
            n = len(poff) - 1
            if isinstance(model, float):
                y, a = np.full(n, model), np.repeat(1 / np.diff(poff), np.diff(poff))
            else:
                f = model.forward(x, poff)
                y, a = f["y"].astype(np.float64), f["a"]
            most = np.maximum.reduceat(a, poff[:-1])
            first = np.full(n, len(a))
            hit = np.flatnonzero(a == np.repeat(most, np.diff(poff)))
            np.minimum.at(first, np.searchsorted(poff, hit, side="right") - 1, hit)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(y), pa.array((y >= threshold).astype(np.int32)),
                 pa.array(np.diff(poff)), pa.array(first - poff[:-1]), pa.array(most.astype(np.float64))],
                names=["doc_id", "score", "predicted", "n_passages", "top_passage", "top_weight"])
    kind = dict(docs.dtypes)["doc_id"]
    out = docs.mapInArrow(run, f"doc_id {kind}, score double, predicted int, n_passages long, "
                               "top_passage long, top_weight double")
    return out.withColumn("held_out", held_out(F.col("doc_id")))


def accepted(documents: DataFrame, model: AttentionModel | float, text_col: str = "text",
             threshold: float = KEEP_FROM) -> DataFrame:
    """The rows of ``documents``, all columns, whose text scores at least ``threshold``."""
    def run(batches):
        for b in chunks(batches, text_col):
            x, poff = passages(*text_bytes(b.column(text_col)))
            y = np.full(len(poff) - 1, model) if isinstance(model, float) else model.scores(x, poff)
            yield b.filter(pa.array(y >= threshold))
    return documents.mapInArrow(run, documents.schema)
