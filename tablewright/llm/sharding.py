"""Sharding by extendible hashing.

The directory is indexed by leading bits of each row's hash.  It starts as one
bucket (no bit); every bucket over the byte limit splits on its next bit, and
only those, until each fits.  The splits need only byte totals: rows are
summed once into fine cells (a prefix a few bits longer than an even spread
needs), every cell adds itself to all its prefixes, and a row's shard is its
shortest prefix that fits.  Cells that are still too large are split further,
with their rows alone.

Scale: totals are partial aggregates, so the directory costs one narrow
shuffle whatever its depth; it is joined to the rows on the cell number,
broadcast only below a counted bound.

Edge cases: the hash covers id and text, null counting as empty.  A row that
alone exceeds the limit gets a shard of its own; repeated rows (same id, same
text) cannot be told apart by any hash and share one shard.  Such shards have
``over_limit`` true, no others.  An empty table gives no row.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.session import join_bounded

from .common import stage

HASH_BITS = 60


def _prefix(h, bits):
    return F.shiftrightunsigned(h, HASH_BITS - bits) if bits else F.lit(0).cast("long")


def _hash(id_col: str, text_col: str):
    """The first ``HASH_BITS`` bits of an MD5 over id and text."""
    text, key = F.coalesce(F.col(f"`{text_col}`"), F.lit("")), F.col(f"`{id_col}`")
    digest = F.md5(F.concat(F.coalesce(key.cast("string"), F.lit("")), F.lit(":"), F.md5(text)))
    return F.conv(F.substring(digest, 1, HASH_BITS // 4), 16, 10).cast("long")


def build_directory(documents: DataFrame, limit_bytes: int, id_col: str = "doc_id",
                    text_col: str = "text", spare_bits: int = 3) -> list[tuple[int, DataFrame]]:
    """Directory levels ``(bits, table of cell, s)``, s the shard of the cell's rows.

    The first level has the cells of the first split; a further one holds
    only cells inside those that were still too large.
    """
    rows = stage(documents.select(F.octet_length(F.coalesce(F.col(f"`{text_col}`"), F.lit(""))).cast("long").alias("b"),
                                  _hash(id_col, text_col).alias("h")), "rows")
    total = rows.agg(F.sum("b")).first()[0] or 0
    low, high = 0, min(HASH_BITS, math.ceil(math.log2(max(1, total / limit_bytes))) + spare_bits)
    levels = []
    while True:
        cells = stage(rows.groupBy(_prefix(F.col("h"), high).alias("cell"))
                      .agg(F.sum("b").alias("b"), F.count("*").alias("n")), "cells")
        above = (cells.withColumn("d", F.explode(F.sequence(F.lit(low), F.lit(high))))
                 .withColumn("p", F.expr(f"cell div cast(power(2, {high} - d) as bigint)")))
        fits = (F.col("shard_bytes") <= limit_bytes) | (F.col("shard_docs") == 1)
        if high == HASH_BITS:
            fits = fits | (F.col("d") == high)
        sums = above.groupBy("d", "p").agg(F.sum("b").alias("shard_bytes"), F.sum("n").alias("shard_docs")).where(fits)
        directory = stage(above.select("cell", "d", "p").join(sums, ["d", "p"]).groupBy("cell")
                          .agg(F.min(F.struct("d", "p", "shard_bytes", "shard_docs")).alias("s")), "directory")
        levels.append((high, directory))
        large = stage(cells.join(directory, "cell", "left_anti").select("cell"), "large")
        if not large.take(1):
            return levels
        rows = stage(join_bounded(rows.withColumn("cell", _prefix(F.col("h"), high)), large, "cell", "left_semi")
                     .drop("cell"), "rows")
        low, high = high + 1, min(HASH_BITS, high + 8)


def shard_rows(documents: DataFrame, limit_bytes: int, id_col: str = "doc_id",
               text_col: str = "text", keep: bool = False) -> DataFrame:
    """Every row with ``shard, depth, shard_bytes, shard_docs, over_limit``.

    ``shard`` spells the hash prefix in binary digits, empty for a lone shard.
    The other columns are ``doc_id, text_bytes``, or with ``keep`` all those of
    ``documents`` (of equal names the shard's remain).
    """
    levels = build_directory(documents, limit_bytes, id_col, text_col)
    text_size = F.octet_length(F.coalesce(F.col(f"`{text_col}`"), F.lit(""))).cast("long")
    held = (F.struct("*") if keep else F.struct(F.col(f"`{id_col}`").alias("doc_id"), text_size.alias("text_bytes")))
    rows = documents.select(held.alias("row"), _hash(id_col, text_col).alias("h"))
    for i, (bits, directory) in enumerate(levels):
        rows = join_bounded(rows.withColumn("cell", _prefix(F.col("h"), bits)),
                            directory.withColumnRenamed("s", f"s{i}"), "cell", "left").drop("cell")
    s = F.coalesce(*[F.col(f"s{i}") for i in range(len(levels))])
    out = rows.select("row", s.alias("s"))
    found = {"shard": F.when(F.col("s.d") == 0, "").otherwise(F.expr("lpad(bin(s.p), s.d, '0')")),
             "depth": F.col("s.d"), "shard_bytes": F.col("s.shard_bytes"), "shard_docs": F.col("s.shard_docs"),
             "over_limit": F.col("s.shard_bytes") > limit_bytes}
    others = [c for c in out.schema["row"].dataType.names if c not in found]
    return out.select(*[F.col("row").getField(c).alias(c) for c in others], *[c.alias(n) for n, c in found.items()])


def write_shards(rows: DataFrame, path: str, shard_col: str = "shard") -> None:
    """Write ``rows`` with one Parquet folder per shard, each shard by one task."""
    rows.repartition(shard_col).write.partitionBy(shard_col).parquet(path)


def oracle(limit_bytes: int) -> str:
    """DuckDB SQL for ``shard_rows`` over the table ``documents``."""
    return f"""
    with k as (select row_number() over () as r, doc_id, strlen(coalesce(text, ''))::bigint as text_bytes,
                      ('0x' || substr(md5(coalesce(doc_id::varchar, '') || ':' || md5(coalesce(text, ''))), 1, 15))::bigint as h
               from documents),
    a as (select k.*, d, h >> ({HASH_BITS} - d) as p from k, (select unnest(range(0, {HASH_BITS + 1})) as d)),
    s as (select d, p, sum(text_bytes)::bigint as shard_bytes, count(*) as shard_docs from a group by d, p),
    f as (select a.*, shard_bytes, shard_docs, row_number() over (partition by r order by a.d) as i
          from a join s on a.d = s.d and a.p = s.p
          where shard_bytes <= {limit_bytes} or shard_docs = 1 or a.d = {HASH_BITS})
    select doc_id, text_bytes,
           case when d = 0 then '' else substr(lpad(bin(p), {HASH_BITS}, '0'), {HASH_BITS} - d::int + 1) end as shard,
           d::int as depth, shard_bytes, shard_docs, shard_bytes > {limit_bytes} as over_limit
    from f where i = 1"""
