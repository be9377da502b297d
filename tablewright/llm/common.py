"""Helpers shared by the training-data operators.

``stage`` cuts lineage by writing a Parquet table into the shared folder that
the cluster names in ``spark.checkpoint.dir``; a lost executor then never
re-runs the work above it.  The byte kernels work on whole Arrow batches and
never hold more than ``CHUNK_BYTES`` of text (or one longer text) at a time.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablewright.session import checkpoint_dir, delete_at_exit, join_bounded

CHUNK_BYTES = 1 << 20
SALTS = 256             # parts in which rows of one key are numbered
U64 = np.uint64


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder; nothing is created."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back; it goes when the session ends."""
    spark, path = df.sparkSession, scratch(df.sparkSession, name)
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(folder)
    delete_at_exit(spark, path)         # known before the write, so a failed one goes too
    df.write.mode("overwrite").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._tw_path = path
    return out


def discard(*staged: DataFrame) -> None:
    """Delete staged tables that no later plan reads."""
    for df in staged:
        spark = df.sparkSession
        p = spark._jvm.org.apache.hadoop.fs.Path(df._tw_path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def narrow(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """``{new: old}`` columns of ``df`` only, so that extra columns never clash."""
    return df.select(*[F.col(f"`{old}`").alias(new) for new, old in columns.items()])


def packed(df: DataFrame, **keys) -> DataFrame:
    """``row`` (all columns of ``df`` as one struct) beside key columns, for joins that must not clash."""
    return df.select(F.struct("*").alias("row"), *[c.alias(n) for n, c in keys.items()])


def unpacked(df: DataFrame, like: DataFrame) -> DataFrame:
    """The columns of ``like`` out of ``row``."""
    return df.select(*[F.col("row").getField(c).alias(c) for c in like.columns])


def numbered(rows: DataFrame, several: DataFrame) -> DataFrame:
    """``rows`` with ``ordinal``: 0, 1, ... among the rows of one ``row_key``; ``several`` has the keys of more than one row.

    Rows of a key are dealt to ``SALTS`` parts, numbered there, and shifted by the sizes of the parts before.
    """
    if not several.take(1):
        return rows.withColumn("ordinal", F.lit(0).cast("long"))
    once = join_bounded(rows, several, "row_key", "left_anti").withColumn("ordinal", F.lit(0).cast("long"))
    many = join_bounded(rows, several, "row_key", "left_semi").withColumn("_at", F.monotonically_increasing_id())
    many = many.withColumn("_salt", F.pmod(F.xxhash64("_at"), F.lit(SALTS)))
    many = stage(many.withColumn("_local", F.row_number().over(Window.partitionBy("row_key", "_salt").orderBy("_at"))), "repeated")
    before = Window.partitionBy("row_key").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    parts = (many.groupBy("row_key", "_salt").agg(F.count("*").alias("_n"))
             .withColumn("_first", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n"))
    many = join_bounded(many, stage(parts, "parts"), ["row_key", "_salt"], "inner")
    return once.unionByName(many.withColumn("ordinal", F.col("_first") + F.col("_local") - 1).select(*once.columns))


def chunks(batches: Iterable[pa.RecordBatch], column: str = "text",
           limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that ``column`` holds about ``limit`` bytes in each.

    A single text longer than the limit is a batch of its own.
    """
    for b in batches:
        col = b.column(column)
        if len(col) == 0:
            continue
        size = np.asarray(pc.fill_null(pc.binary_length(col), 0), dtype=np.int64)
        part = np.cumsum(size) // limit
        cut = np.flatnonzero(np.diff(part)) + 1
        for s, e in zip(np.r_[0, cut], np.r_[cut, len(size)]):
            yield b.slice(int(s), int(e - s))


def text_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string array laid end to end, and the n+1 offsets; null is empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = pc.fill_null(col, "").cast(pa.large_binary())
    n = len(col)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(col.buffers()[1], dtype=np.int64, count=n + 1 + col.offset)[col.offset:]
    buf = col.buffers()[2]
    data = np.frombuffer(buf, dtype=np.uint8) if buf is not None else np.zeros(0, np.uint8)
    return data[off[0]:off[-1]], off - off[0]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit changes about half the output bits."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTE_HASH = mix(np.arange(1, 257, dtype=U64) * U64(0x9E3779B97F4A7C15))
_BYTE_HASH[_SPACE] = 0
_LOWER_HASH = _BYTE_HASH[_LOWER]
_BASE = U64(0xD1342543DE82EF95)


def word_starts(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Mask of the bytes at which a word ``[^\\x20\\x09-\\x0D]+`` of a text begins."""
    word = ~_SPACE[data]
    first = np.zeros(len(data) + 1, bool)
    first[off] = True
    word[1:] &= _SPACE[data[:-1]] | first[1:-1]
    return word


def word_hashes(data: np.ndarray, off: np.ndarray, lower: bool = True
                ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """64-bit hashes of the words ``[^\\x20\\x09-\\x0D]+`` of every text.

    Returns the hashes in order, the n+1 word offsets of the texts, and the
    byte position at which each word starts.
    """
    n = len(off) - 1
    if len(data) == 0:
        return np.zeros(0, U64), np.zeros(n + 1, np.int64), np.zeros(0, np.int64)
    word = ~_SPACE[data]
    starts_here = word_starts(data, off)
    starts = np.flatnonzero(starts_here)
    if len(starts) == 0:
        return np.zeros(0, U64), np.zeros(n + 1, np.int64), starts
    run = np.cumsum(starts_here, dtype=np.int32) - 1
    at = np.arange(len(data), dtype=np.int32) - starts.astype(np.int32)[np.maximum(run, 0)]
    at *= word
    power = np.cumprod(np.full(int(at.max()) + 1, _BASE, U64))
    value = (_LOWER_HASH if lower else _BYTE_HASH)[data]
    value *= power[at]
    return mix(np.add.reduceat(value, starts)), np.searchsorted(starts, off), starts
