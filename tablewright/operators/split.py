"""Train/validation splits.

Assignment is a function of a key column, never of partition layout, so a
recomputed partition (lost executor, AQE re-plan) lands rows in the same part.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.operators.clean import where_in

RESOLUTION = 1_000_000


# Fixed values of the universal hash family: the Mersenne prime 2^31 - 1.
UNIVERSAL_PRIME = 2_147_483_647


def universal_params(seed: int) -> tuple[int, int]:
    """Seeded (a, b) with 1 <= a < p and 0 <= b < p."""
    import random
    rng = random.Random(int(seed))
    return rng.randrange(1, UNIVERSAL_PRIME), rng.randrange(0, UNIVERSAL_PRIME)


def universal_hash(key, seed: int) -> Column:
    """((a * (k mod p)) + b) mod p for an integer key: exact 64-bit integer
    arithmetic (a, k mod p < 2^31), so any SQL engine reproduces it."""
    a, b = universal_params(seed)
    p = F.lit(UNIVERSAL_PRIME).cast("bigint")
    k = F.pmod(F.col(key) if isinstance(key, str) else key, p)
    return F.pmod(k * F.lit(a).cast("bigint") + F.lit(b).cast("bigint"), p)


def mixing_hash(key, seed: int) -> Column:
    """60 bits of MD5 over ``seed:key[:key...]``: any SQL engine reproduces it, any key mixes well.

    A null key column is spelled as the empty text.
    """
    k = [key] if isinstance(key, (str, Column)) else list(key)
    parts = [F.coalesce((F.col(x) if isinstance(x, str) else x).cast("string"), F.lit("")) for x in k]
    text = F.concat(F.lit(f"{int(seed)}"), *[F.concat(F.lit(":"), p) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def holdout_mask(key, frac: float = 0.2, seed: int = 2023, method: str = "md5") -> Column:
    """True for the rows that go to the holdout (about ``frac`` of them).

    ``md5`` and ``xxhash64`` work for any key columns; ``md5`` and
    ``universal`` (one integer key) are reproducible outside Spark.
    """
    if method == "md5":
        return F.pmod(mixing_hash(key, seed), F.lit(RESOLUTION)) < F.lit(int(round(frac * RESOLUTION)))
    if method == "universal":
        u = F.pmod(universal_hash(key, seed), F.lit(RESOLUTION))
        return u < F.lit(int(round(frac * RESOLUTION)))
    k = [key] if isinstance(key, (str, Column)) else list(key)
    u = F.pmod(F.xxhash64(*k, F.lit(int(seed))), F.lit(RESOLUTION))
    return u < F.lit(int(round(frac * RESOLUTION)))


def holdout_split(df: DataFrame, frac: float = 0.2, seed: int = 2023,
                  key="row_id", method: str = "md5", exact: bool = False) -> tuple[DataFrame, DataFrame]:
    """(train, holdout): seeded hash of ``key``; holdout size is about ``frac``, or with ``exact`` ceil(frac * rows)."""
    m = exact_mask(df, key, frac, seed) if exact else holdout_mask(key, frac, seed, method)
    return df.where(~m), df.where(m)


HASH_BITS, DIGIT_BITS = 60, 15
BOUNDARY_ROWS = 10_000


def exact_mask(df: DataFrame, key, frac: float = 0.2, seed: int = 2023) -> Column:
    """True for exactly ceil(frac * rows) rows of ``df``: those with the smallest hashes of the unique ``key``.

    The threshold is an order statistic of the hash, found without a sort:
    counts per leading digit (32,768 of them) show the one digit in which the
    wanted rank falls; its rows are counted by their next digit, until at most
    ``BOUNDARY_ROWS`` are left, which are ranked.  Equal hashes are told
    apart by the key; rows that share a key stay together.
    """
    k = [key] if isinstance(key, (str, Column)) else list(key)
    names = [F.coalesce((F.col(x) if isinstance(x, str) else x).cast("string"), F.lit("")) for x in k]
    h = mixing_hash(key, seed)
    left = df.select(h.alias("h"), *[n.alias(f"k{i}") for i, n in enumerate(names)])
    want = math.ceil(Decimal(str(frac)) * left.count())
    if want <= 0:
        return F.lit(False)
    low, bits = 0, HASH_BITS
    while bits > 0:
        bits -= DIGIT_BITS
        digit = F.shiftright(F.col("h") - F.lit(low), bits)
        rows = sorted(left.groupBy(digit.alias("d")).agg(F.count("*").alias("n")).collect(), key=lambda r: r["d"])
        for r in rows:
            if want <= r["n"]:
                break
            want -= r["n"]
        else:
            return F.lit(True)
        low += r["d"] << bits
        left = left.where((F.col("h") >= low) & (F.col("h") < low + (1 << bits)))
        if r["n"] <= BOUNDARY_ROWS:
            break
    ks = [f"k{i}" for i in range(len(k))]
    if r["n"] > BOUNDARY_ROWS:          # so many rows of one hash share their key
        edge = left.orderBy("h", *ks).first()
    else:
        edge = left.orderBy("h", *ks).limit(want).collect()[-1]
    same = F.struct(*names) <= F.struct(*[F.lit(edge[c]) for c in ks])
    return (h < F.lit(edge["h"])) | ((h == F.lit(edge["h"])) & same)


def period_split(df: DataFrame, c, values: Sequence) -> tuple[DataFrame, DataFrame]:
    """(train, validation): rows whose period is in ``values`` validate, the rest train."""
    return where_in(df, c, values, negate=True), where_in(df, c, values)
