"""Language-model scores from Brown's class-based bigrams.

Every word has one class; a text's probability is the product over its tokens
(its words, then an end) of ``P(class | class before) * P(word | class)``.
Both factors are counted on the training texts.

Classes come from the exchange algorithm, which moves a word to the class that
raises the likelihood of the training bigrams most.  First the ``core`` most
frequent words are exchanged to a local optimum, on the matrix of their own bigrams,
which is counted over all texts and bounded by ``core`` squared.  Then every
other word is exchanged once, from no class to the best one, given how often it
stands beside words of each class; these moves are independent, so they run in
parallel.  The end has a class of its own, words that never stand beside a core
word share the last class.

Smoothing: a token's probability is mixed with ``prior`` pseudo-counts of the
add-``ADD`` unigram model, P(word) = (c + ADD) / (N + ADD (V + 1)), from which
the class model differs only by what classes tell.  A word unseen in
training has its unigram probability in every context.

Scale: words are 64-bit hashes.  The texts are read five times and never
shuffled.  Word counts and neighbour classes are summed in each task, then by
key.  Frequent words (at most ``frequent`` of them, 17 bytes each) are broadcast, and
tokens of them are counted and scored inside the tasks.  Bigrams with a rarer or unseen
word leave the task, find its count and class by a join with the whole vocabulary and are
summed back; such words are rare, so no key of that join is hot.  No word or
count is dropped, the split only says how it is looked up.

Edge cases: null and empty texts are one end token; a null id is held out
from training, as no remainder exists; repeated rows are texts of their own;
without training texts every probability is the unigram model's (1); an empty
table gives no row; extra columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import U64, chunks, narrow, stage, text_bytes, word_hashes
from .kernels import Lookup, Tally

END = U64(0)            # the end token; also stands before a text's first word
ADD = 0.1
FOLDS = 10
CLASSES = 64
CORE = 512
FREQUENT = 1 << 20
PRIOR = 64.0
SWEEPS = 20


def held_out(doc_id: Column, folds: int = FOLDS) -> Column:
    """Rows kept from training: crc32 of the id as text is divisible by ``folds``, or the id is null."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == 0, F.lit(True))


def sequence(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All tokens of the texts, an end before each text and after the last; and the n+1 places of these ends.

    Every token but the first has its predecessor right before it.
    """
    words, off, _ = word_hashes(*text_bytes(texts))
    n = len(off) - 1
    at = off + np.arange(n + 1)
    out = np.full(len(words) + n + 1, END, U64)
    place = np.ones(len(out), bool)
    place[at] = False
    out[place] = np.where(words == END, U64(1), words)
    return out, at


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1))


def exchange(bigrams: np.ndarray, classes: int, sweeps: int = SWEEPS) -> tuple[np.ndarray, np.ndarray]:
    """Classes of words 0..m-1 (0 is the end and stays alone in class 0; the last class stays empty), and the class matrix.

    Each word in turn moves to the class with the largest
    ``sum n(c, d) log n(c, d) - sum n(c) log n(c) - sum n(d) log n(d)``, until
    a sweep moves none.
    """
    m, open_ = len(bigrams), max(1, classes - 2)
    word_class = np.r_[0, 1 + np.arange(m - 1) % open_][:m]
    member = np.eye(classes)[word_class]
    matrix = member.T @ bigrams @ member
    for _ in range(sweeps):
        moved = 0
        for w in range(1, m):
            a, own = word_class[w], float(bigrams[w, w])
            member[w] = 0
            left, right = bigrams[:, w] @ member, bigrams[w] @ member       # before and after w, w itself apart
            matrix[:, a] -= left
            matrix[a] -= right
            matrix[a, a] -= own
            gain = insertion_gain(matrix, left, right, own)[1:1 + open_]
            best = 1 + int(np.argmax(gain))
            if gain[best - 1] <= gain[a - 1] + 1e-9:
                best = a
            moved += best != a
            word_class[w] = best
            member[w, best] = 1
            matrix[:, best] += left
            matrix[best] += right
            matrix[best, best] += own
        if not moved:
            break
    return word_class, matrix


def insertion_gain(matrix: np.ndarray, left: np.ndarray, right: np.ndarray, own: float = 0.0) -> np.ndarray:
    """What the likelihood gains if a word with these neighbour counts joins each class, up to a constant."""
    gain = (_xlogx(matrix + left[:, None]) - _xlogx(matrix)).sum(0) + (_xlogx(matrix + right[None]) - _xlogx(matrix)).sum(1)
    return gain + _common_gain(matrix, left, right, own)


def _common_gain(matrix: np.ndarray, left: np.ndarray, right: np.ndarray, own: float) -> np.ndarray:
    """The diagonal, which takes both sides at once, and the class totals; works on rows of words too."""
    d, before, after = np.diag(matrix), matrix.sum(1) + left, matrix.sum(0) + right
    out = _xlogx(d + left + right + own) + _xlogx(d) - _xlogx(d + left) - _xlogx(d + right)
    out -= _xlogx(before + right.sum(-1, keepdims=True) + own) - _xlogx(before)
    return out - (_xlogx(after + left.sum(-1, keepdims=True) + own) - _xlogx(after))


def place(matrix: np.ndarray, word: np.ndarray, context: np.ndarray, n: np.ndarray, words: int) -> np.ndarray:
    """Best open class of each of ``words`` words, from rows (word, context, n) sorted by word.

    ``context`` is the class before the word, or the number of classes plus the class after it.
    """
    k = len(matrix)
    left, right = np.zeros((words, k)), np.zeros((words, k))
    before = context < k
    left[word[before], context[before]] = n[before]
    right[word[~before], context[~before] - k] = n[~before]
    both = np.concatenate([matrix, matrix.T])[context]
    grown = _xlogx(both + n[:, None]) - _xlogx(both)
    gain = np.add.reduceat(grown, np.searchsorted(word, np.arange(words))) + _common_gain(matrix, left, right, 0.0)
    return 1 + np.argmax(gain[:, 1:max(2, k - 1)], 1)


def _word_counts(train: DataFrame) -> DataFrame:
    """``w, c``: how often every word, and the end, occurs."""
    def run(batches):
        tally = Tally()
        for b in chunks(batches):
            for part in tally.add(sequence(b.column("text"))[0][1:]):
                yield out(part)
        for part in tally.rest():
            yield out(part)

    def out(part):
        return pa.RecordBatch.from_arrays([pa.array(part[0].view(np.int64)), pa.array(part[1])], names=["w", "c"])
    return train.mapInArrow(run, "w long, c long").groupBy("w").agg(F.sum("c").alias("c"))


def _core_bigrams(train: DataFrame, core: np.ndarray) -> np.ndarray:
    """Bigram counts among the core words (in the order of ``core``): at most its square of rows come back."""
    order = np.argsort(core)
    shared, m = train.sparkSession.sparkContext.broadcast(core[order]), len(core)

    def run(batches):
        table, total = Lookup(shared.value), np.zeros(m * m, np.int64)
        for b in chunks(batches):
            at = table.find(sequence(b.column("text"))[0]).astype(np.int64)
            both = (at[1:] >= 0) & (at[:-1] >= 0)
            total += np.bincount(at[:-1][both] * m + at[1:][both], minlength=m * m)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["pair", "n"])
    got = train.mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(m * m)
    out[got.column("pair").to_numpy()] = got.column("n").to_numpy()
    back = np.argsort(order)
    return out.reshape(m, m)[np.ix_(back, back)]


def _contexts(train: DataFrame, core: np.ndarray, core_class: np.ndarray, frequent: np.ndarray, classes: int) -> DataFrame:
    """``w, ctx, n``: how often a word outside of the core stands after and before core words of each class."""
    order = np.argsort(core)
    shared = train.sparkSession.sparkContext.broadcast((core[order], core_class[order], frequent))

    def rows(w, ctx, n):
        return pa.RecordBatch.from_arrays([pa.array(w.view(np.int64)), pa.array(ctx.astype(np.int32)), pa.array(n)], names=["w", "ctx", "n"])

    def run(batches):
        core, core_class, frequent = shared.value
        table, known, tally = Lookup(core), Lookup(frequent), Tally()

        def spelled(part):
            return rows(frequent[part[0] // (2 * classes)], part[0] % (2 * classes), part[1])
        for b in chunks(batches):
            seq, _ = sequence(b.column("text"))
            at = table.find(seq)
            cls = np.where(at >= 0, core_class[at], -1)
            mid = np.flatnonzero(at < 0)                    # never the first or the last token: these are ends
            word = np.concatenate([mid[cls[mid - 1] >= 0], mid[cls[mid + 1] >= 0]])
            ctx = np.concatenate([cls[mid - 1][cls[mid - 1] >= 0], cls[mid + 1][cls[mid + 1] >= 0] + classes])
            which = known.find(seq[word])
            for part in tally.add(which[which >= 0].astype(np.int64) * (2 * classes) + ctx[which >= 0]):
                yield spelled(part)
            rare = which < 0
            yield rows(seq[word[rare]], ctx[rare], np.ones(int(rare.sum()), np.int64))
        for part in tally.rest():
            yield spelled(part)
    return train.mapInArrow(run, "w long, ctx int, n long")


def _placed(contexts: DataFrame, matrix: np.ndarray) -> DataFrame:
    """``w, cls``: the class that each word is exchanged to."""
    shared = contexts.sparkSession.sparkContext.broadcast(matrix)

    def run(batches):
        for b in batches:
            lists = b.column("ctx")
            size = np.diff(lists.offsets.to_numpy())
            entry = lists.flatten()
            cls = place(shared.value, np.repeat(np.arange(b.num_rows), size), entry.field("ctx").to_numpy().astype(np.int64),
                        entry.field("n").to_numpy().astype(float), b.num_rows) if b.num_rows else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([b.column("w"), pa.array(cls.astype(np.int32))], names=["w", "cls"])
    # at most 2 * classes entries a word; both sums use one shuffle by word
    each = contexts.repartition("w").groupBy("w", "ctx").agg(F.sum("n").alias("n"))
    return each.groupBy("w").agg(F.collect_list(F.struct("ctx", "n")).alias("ctx")).mapInArrow(run, "w long, cls int")


class Model:
    """Counts and classes of the training texts.

    ``lexicon``: ``w, c, cls`` of every word.  ``words, counts, cls``: the frequent ones as arrays.
    ``step[a, b]``: log10 probability of class b after a; the last class stands for unseen words.
    ``mass[b]``: denominator of word probabilities in class b.
    """

    def __init__(self, lexicon: DataFrame, frequent_from: int, classes: int):
        self.lexicon, self.frequent_from, self.classes = lexicon, frequent_from, classes
        got = lexicon.where((F.col("c") >= frequent_from) | (F.col("w") == 0)).toArrow()
        words = got.column("w").to_numpy().view(U64)
        order = np.argsort(words)
        self.words, self.counts = words[order], got.column("c").to_numpy()[order]
        self.cls = got.column("cls").to_numpy()[order].astype(np.int8)
        self.class_count, self.class_words = np.zeros(classes + 1), np.zeros(classes + 1)
        for r in lexicon.groupBy("cls").agg(F.sum("c").alias("c"), F.count("*").alias("v")).collect():
            self.class_count[r["cls"]], self.class_words[r["cls"]] = r["c"], r["v"]
        self.tokens, self.vocabulary = int(self.class_count.sum()), int(self.class_words.sum())
        self.total = self.tokens + ADD * (self.vocabulary + 1)
        self.class_words[classes] = 1                       # the one unseen word
        self.mass = self.class_count + ADD * self.class_words

    def finish(self, bigrams: np.ndarray, prior: float) -> Model:
        """Transition probabilities from the class bigram counts."""
        unigram = self.mass / self.total
        unseen = unigram[-1]
        follow = np.zeros_like(bigrams)
        for a, row in enumerate(bigrams):
            share = unigram[:-1] / max(1e-300, 1 - unseen)
            follow[a, :-1] = (1 - unseen) * (row[:-1] + prior * share) / (row[:-1].sum() + prior)
            follow[a, -1] = unseen
        with np.errstate(divide="ignore"):
            self.step = np.log10(follow)
        return self


def _edges(seq: np.ndarray, at: np.ndarray, cls: np.ndarray) -> list[pa.Array]:
    """Bigrams that end at ``at`` as arrays a, ac, b, bc: hashes of words without a class, classes of the others."""
    out = []
    for place_ in (at - 1, at):
        rare = cls[place_] < 0
        out += [pa.array(seq[place_].view(np.int64), mask=~rare), pa.array(cls[place_].astype(np.int32), mask=rare)]
    return out


def _class_bigrams(train: DataFrame, model: Model) -> np.ndarray:
    """Counts of class bigrams over all training texts."""
    k = model.classes
    shared = train.sparkSession.sparkContext.broadcast((model.words, model.cls))

    def run(batches):
        words, of = shared.value
        table, total = Lookup(words), np.zeros(k * k, np.int64)
        for b in chunks(batches):
            seq, _ = sequence(b.column("text"))
            found = table.find(seq)
            cls = np.where(found >= 0, of[found] if len(of) else -1, -1).astype(np.int64)
            both = (cls[1:] >= 0) & (cls[:-1] >= 0)
            total += np.bincount(cls[:-1][both] * k + cls[1:][both], minlength=k * k)
            open_ = 1 + np.flatnonzero(~both)
            yield pa.RecordBatch.from_arrays([*_edges(seq, open_, cls), pa.array(np.ones(len(open_), np.int64))],
                                             names=["a", "ac", "b", "bc", "n"])
        some = np.flatnonzero(total)
        nothing = pa.nulls(len(some), pa.int64())
        yield pa.RecordBatch.from_arrays([nothing, pa.array((some // k).astype(np.int32)), nothing,
                                          pa.array((some % k).astype(np.int32)), pa.array(total[some])], names=["a", "ac", "b", "bc", "n"])
    edges = stage(train.mapInArrow(run, "a long, ac int, b long, bc int, n long"), "bigrams")
    out = np.zeros((k + 1, k + 1))
    for r in resolved(edges, model).groupBy("ac", "bc").agg(F.sum("n").alias("n")).collect():
        out[r["ac"], r["bc"]] = r["n"]
    return out


def resolved(edges: DataFrame, model: Model) -> DataFrame:
    """Bigrams with the classes of both words, and ``b_count`` where the second was looked up (0: unseen)."""
    for word, cls, count in (("a", "ac", "a_count"), ("b", "bc", "b_count")):
        known = edges.where(F.col(word).isNull()).withColumn(count, F.lit(None).cast("long"))
        table = model.lexicon.select(F.col("w").alias(word), F.col("cls").alias("_cls"), F.col("c").alias(count))
        found = edges.where(F.col(word).isNotNull()).join(table, word, "left").withColumns(
            {cls: F.coalesce("_cls", F.lit(model.classes)), count: F.coalesce(count, F.lit(0))}).drop("_cls")
        edges = known.unionByName(found)
    return edges


def train(documents: DataFrame, classes: int = CLASSES, core: int = CORE, frequent: int = FREQUENT, prior: float = PRIOR,
          text_col: str = "text") -> Model:
    """Fit classes and counts on all ``documents``."""
    texts = narrow(documents, {"text": text_col})
    vocab = stage(_word_counts(texts), "vocabulary")
    # the smallest count from which on at most `frequent` words are left, in steps of a sixteenth of a power of two
    step = F.floor(F.log2("c") * 16)
    steps = vocab.groupBy(step.alias("s")).agg(F.min("c").alias("c"), F.count("*").alias("v")).collect()
    frequent_from, left = 1 << 62, frequent
    for r in sorted(steps, key=lambda r: -r["s"]):
        left -= r["v"]
        if left < 0:
            break
        frequent_from = r["c"]
    top = vocab.where("w <> 0").orderBy(F.desc("c"), "w").limit(core).toArrow()
    core_words = np.r_[END, top.column("w").to_numpy().view(U64)]
    bigrams = _core_bigrams(texts, core_words)
    core_class, matrix = exchange(bigrams, classes)
    often = vocab.where(F.col("c") >= frequent_from).select("w").toArrow().column("w").to_numpy().view(U64)
    placed = _placed(_contexts(texts, core_words, core_class, np.sort(often), classes), matrix)
    spark = documents.sparkSession
    fixed = spark.createDataFrame(list(zip(core_words.view(np.int64).tolist(), core_class.tolist())), "w long, core int")
    lexicon = (vocab.join(F.broadcast(fixed), "w", "left").join(placed, "w", "left")
               .select("w", "c", F.coalesce("core", "cls", F.lit(classes - 1)).alias("cls")))
    model = Model(stage(lexicon, "lexicon"), frequent_from, classes)
    return model.finish(_class_bigrams(texts, model), prior)


def score(documents: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_tokens, n_known, base_score, score, perplexity`` of every text, in log10."""
    docs = narrow(documents, {"doc_id": id_col, "text": text_col})
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((model.words, model.counts, model.cls, model.step, model.mass, model.total))

    def run(batches):
        words, counts, of, step, mass, total = shared.value
        table, row = Lookup(words), TaskContext.get().partitionId() << 40
        word = np.log10((counts + ADD) / total)
        emit = np.log10((counts + ADD) / mass[of])
        for b in chunks(batches):
            seq, ends = sequence(b.column("text"))
            found = table.find(seq)
            known = found >= 0
            cls = np.where(known, of[found] if len(of) else -1, -1).astype(np.int64)
            both = known[1:] & known[:-1]
            base, own = np.zeros(len(seq) - 1), np.zeros(len(seq) - 1)
            here = np.flatnonzero(known[1:])
            base[here], own[here] = word[found[1:][here]], emit[found[1:][here]]
            own[both] += step[cls[:-1][both], cls[1:][both]]
            # bigrams with a word to look up: once for each text, with their number
            at = 1 + np.flatnonzero(~both)
            doc = np.searchsorted(ends, at) - 1
            order = np.lexsort((seq[at], seq[at - 1], doc))
            at, doc = at[order], doc[order]
            new = np.ones(len(at), bool)
            new[1:] = (doc[1:] != doc[:-1]) | (seq[at[1:]] != seq[at[:-1]]) | (seq[at[1:] - 1] != seq[at[:-1] - 1])
            first = np.flatnonzero(new)
            times = np.diff(np.r_[first, len(at)])
            edges = pa.StructArray.from_arrays([*_edges(seq, at[first], cls), pa.array(times)], names=["a", "ac", "b", "bc", "n"])
            cut = np.searchsorted(doc[first], np.arange(b.num_rows + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(row + np.arange(b.num_rows)), b.column("doc_id"), pa.array(np.diff(ends)),
                 pa.array(np.add.reduceat(known[1:].astype(np.int64), ends[:-1])), pa.array(np.add.reduceat(base, ends[:-1])),
                 pa.array(np.add.reduceat(own, ends[:-1])), pa.ListArray.from_arrays(cut, edges)],
                names=["row", "doc_id", "n_tokens", "n_known", "base_score", "score", "edges"])
            row += b.num_rows
    rows = stage(docs.mapInArrow(run, f"row long, doc_id {dict(docs.dtypes)['doc_id']}, n_tokens long, n_known long, base_score double, "
                                      "score double, edges array<struct<a:long,ac:int,b:long,bc:int,n:long>>"), "scores")
    k = model.classes
    steps = [(a, b, float(model.step[a, b]), float(model.mass[b])) for a in range(k + 1) for b in range(k + 1)
             if np.isfinite(model.step[a, b])]
    steps = F.broadcast(spark.createDataFrame(steps, "ac int, bc int, step double, mass double"))
    looked = F.col("b_count").isNotNull()
    emission = F.when(looked & (F.col("b_count") > 0), F.log10((F.col("b_count") + ADD) / F.col("mass"))).otherwise(0.0)
    base = F.when(looked, F.log10((F.col("b_count") + ADD) / F.lit(float(model.total)))).otherwise(0.0)
    more = (resolved(rows.select("row", F.inline("edges")), model).join(steps, ["ac", "bc"])
            .groupBy("row").agg(F.sum(F.when(F.col("b_count") > 0, F.col("n")).otherwise(0)).alias("more_known"),
                                F.sum(base * F.col("n")).alias("more_base"),
                                F.sum((F.col("step") + emission) * F.col("n")).alias("more_score")))
    out = rows.drop("edges").join(more, "row", "left").na.fill(0, ["more_known", "more_base", "more_score"])
    return out.select("doc_id", "n_tokens", (F.col("n_known") + F.col("more_known")).alias("n_known"),
                      (F.col("base_score") + F.col("more_base")).alias("base_score"),
                      (F.col("score") + F.col("more_score")).alias("score"),
                      F.pow(F.lit(10.0), -(F.col("score") + F.col("more_score")) / F.col("n_tokens")).alias("perplexity"))


def score_held_out(documents: DataFrame, folds: int = FOLDS, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Train on the rows outside of the held-out fold, score all: ``doc_id, held_out, n_tokens, n_known, train_tokens, ...``."""
    out = held_out(F.col(f"`{id_col}`"), folds)
    model = train(documents.where(~out), text_col=text_col, **options)
    scored = score(documents, model, id_col, text_col)
    return scored.select("doc_id", held_out(F.col("doc_id"), folds).alias("held_out"), "n_tokens", "n_known",
                         F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score", "perplexity")
