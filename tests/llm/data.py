"""Small hand-made tables for the training-data tests."""

import random
import re

CLASH = ["key", "h", "row", "bucket", "size", "target", "k", "p", "shard", "score", "spans", "kind", "rep", "root",
         "n", "copies", "row_key", "cell", "s0", "to", "th", "copy", "at", "y", "x", "_id", "s", "blocks", "sha", "first"]
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, rows):
    """Rows (doc_id, text[, source]) as a documents table with clashing extra columns."""
    from pyspark.sql import functions as F
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", None) for r in rows]
    df = spark.createDataFrame(full, DOCS)
    return df.withColumns({c: F.lit("extra") for c in CLASH})


def words(seed, n, vocabulary=400):
    rng = random.Random(seed)
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


def odd_rows():
    """Null id, null text, empty text, blanks, a very long text, a repeated row, equal texts."""
    long = " ".join(words(1, 30_000, 5000))
    return [(None, "a null id with some words"), (1, None), (2, ""), (3, " \t\n "), (4, long), (5, "repeated row here"),
            (5, "repeated row here"), (6, "equal text of two rows", None), (7, "equal text of two rows", None),
            (8, "x" * 50_000), (9, "one"), (None, None, None)]


def tokens(text):
    lower = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return re.findall("[^\x20\x09-\x0D]+", lower)
