"""The registered queries of the training-data operators, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline

from . import (class_lm, decontaminate, divergence, edit_embedding, lexical, licenses, mixing, pii, quality, sharding, url_filter,
               warc_zst)
from .near_dedup import near_duplicates

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f
    return add


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


@query("op6_near_dedup")
def op6_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose two-word shingle sets are similar to 0.8."""
    return near_duplicates(read(spark, sf_dir, "documents"), words=2)


@query("op1_quality")
def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    docs = read(spark, sf_dir, "documents")
    model = quality.train(docs, read(spark, sf_dir, "labels"))
    return quality.score(docs, model).select("doc_id", "held_out", "score", "predicted", "n_passages",
                                             "top_passage", "top_weight")


@query("op5_decontaminate")
def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that leak benchmark items, with the edit distance of each leak."""
    return decontaminate.leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


@query("op2_edit_fingerprint")
def op2_edit_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and its edited text, and their likenesses."""
    return edit_embedding.edited_neighbours(read(spark, sf_dir, "documents"))


@query("op3_warc")
def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's record, as read back from the written archives."""
    return warc_zst.round_trip(read(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "verified")


@query("op4_pii")
def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document, with the terms that reveal it."""
    return pii.digest_columns(pii.sanitise(read(spark, sf_dir, "documents")))


@query("op7_url_filter", url_filter.oracle())
def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's verdict under the lists as of its fetch day."""
    pages = read(spark, sf_dir, "pages")
    return url_filter.evaluate(url_filter.dated_pages(pages), url_filter.entries_from(pages))


@query("op8_license_scan", licenses.oracle())
def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licenses of every document by its sequence of license sentences."""
    return licenses.scan(read(spark, sf_dir, "documents"))


@query("op9_mix")
def op9_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words taken of every document when sources are mixed to their targets."""
    return mixing.mix(read(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken", "source", "copies")


@query("op10_shard", sharding.oracle(corpus_pipeline.SHARD_BYTES))
def op10_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard of every document, by extendible hashing under a byte limit."""
    return sharding.shard_rows(read(spark, sf_dir, "documents"), corpus_pipeline.SHARD_BYTES)


@query("op11_class_lm")
def op11_class_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class-bigram and unigram log probabilities of every document."""
    return class_lm.score_held_out(read(spark, sf_dir, "documents"))


@query("op12_divergence_audit", divergence.oracle())
def op12_divergence_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How sources differ in pairs, and in which terms they exceed their language."""
    return divergence.audit(read(spark, sf_dir, "documents"))


@query("op13_lexical_search", lexical.oracle())
def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best documents of every benchmark item."""
    return lexical.ranked(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


@query("pipeline")
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)
