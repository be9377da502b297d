"""The corpus pipeline: documents in, sharded training documents out.

Stages, each over all rows the one before kept: documents the quality
classifier rejects go; of each group of near duplicates (five-word shingles,
similarity 0.8) one stays; documents that leak a benchmark item go; sources
are mixed to their target weights, which drops some documents and repeats
others; the rest is dealt into byte-limited shards.

Edge cases, for every stage: an empty table gives an empty table; columns beside
those of ``documents`` stay, whatever their names.  A null or empty text is
judged by the classifier like any other, is near no text, leaks nothing, has
size 0 in the mix and no bytes in its shard.  Rows without an id are kept
apart: deduplication leaves them, the others judge them by their text.  Equal
rows are one document to deduplication and separate units to the mix; unlike
texts that share an id all stay.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.llm import decontaminate, mixing, near_dedup, quality, sharding
from tablewright.llm.common import packed, stage, unpacked
from tablewright.session import join_bounded

SHARD_BYTES = 1 << 20

# the classifier and the mix are no SQL; the stages are tested against plain versions
ORACLE_SQL = None


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.accepted(docs, quality.train(docs, labels))


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return near_dedup.one_per_component(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak no benchmark item; those without an id are judged by their text's hash."""
    key = F.xxhash64("doc_id", "text")
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontaminate.leaks(docs.select(key.alias("key"), "text"), items, id_col="key")
    hit = stage(found.select(F.col("doc_id").alias("key")).distinct(), "leaking")
    return unpacked(join_bounded(packed(docs, key=key), hit, "key", "left_anti"), docs)


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the balanced sample takes them."""
    return mixing.take_copies(docs, mixing.mix(docs))


def shard_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their shard."""
    return sharding.shard_rows(docs, SHARD_BYTES, keep=True)


STAGES = [("quality", quality_stage), ("near_dedup", dedup_stage), ("decontamination", decontamination_stage),
          ("mix", mix_stage), ("shard", shard_stage)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``; each result but the last is staged and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
