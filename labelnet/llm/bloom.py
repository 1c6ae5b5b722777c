"""A blocked Bloom filter as a table: one row for each block of 4 words, built and probed with built-in functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS_A_KEY, WORDS, PROBES = 16, 4, 6          # blocks of 4 words of 64 bits; 6 bits of a block for each key
MOST_BLOCKS = 1 << 16                         # 2 MB of words: the most that is broadcast


def _or(cols: list[Column]) -> Column:
    out = cols[0]
    for c in cols[1:]:
        out = out.bitwiseOR(c)
    return out


def _word_bits(key: Column) -> list[Column]:
    """The four words of a block in which the bits of a key are set."""
    h = F.xxhash64(key, F.lit(1))
    spots = [F.shiftrightunsigned(h, 8 * i).bitwiseAND(F.lit(WORDS * 64 - 1)) for i in range(PROBES)]
    none, one = F.lit(0).cast("long"), F.lit(1).cast("long")
    return [_or([F.when(F.shiftright(s, 6) == w, F.call_function("shiftleft", one, s.bitwiseAND(F.lit(63)).cast("int"))).otherwise(none)
                 for s in spots]) for w in range(WORDS)]


def _block(key: Column, n: int) -> Column:
    # ``pmod`` may be null for Spark: a join on it would first compute the key, and all it is made of, for a null test
    return F.coalesce(F.pmod(F.xxhash64(key, F.lit(2)), F.lit(n)).cast("int"), F.lit(0))


def build(keys: DataFrame, n_keys: int, most: int | None = None) -> tuple[DataFrame, int]:
    """``keys`` (key) -> (one row for each block in use: block, w0..w3; number of blocks). ``most``: at most so
    many blocks; beyond that the filter lets more through, and never loses a key."""
    n = max(1, -(-n_keys * BITS_A_KEY // (WORDS * 64)))
    n = min(n, most) if most else n
    k = keys.select(_block(F.col("key"), n).alias("block"), *[b.alias(f"w{i}") for i, b in enumerate(_word_bits(F.col("key")))])
    return k.groupBy("block").agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(WORDS)]), n


def may_hold(candidates: DataFrame, bloom: DataFrame, n: int, small: bool, key: str = "key", outer: str | None = None) -> DataFrame:
    """Rows of ``candidates`` whose key's bits are all set in its block. ``small``: the filter is broadcast.
    ``outer``: keep all rows and say so in this column instead."""
    cols = candidates.columns
    c = candidates.withColumn("block", _block(F.col(key), n))
    hit = c.join(F.broadcast(bloom) if small else bloom, "block", "left" if outer else "inner")
    ok = F.lit(True)
    for i, b in enumerate(_word_bits(F.col(key))):
        ok = ok & (F.col(f"w{i}").bitwiseAND(b) == b)
    if outer:
        return hit.select(*cols, F.coalesce(ok, F.lit(False)).alias(outer))
    return hit.where(ok).select(*cols)
