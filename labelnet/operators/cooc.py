"""Tag co-occurrence in posts and tag usage over time.

Co-occurrence counts are the Gram matrix ``X^T X`` of the post x tag
incidence matrix X. It is computed as a sum of blocked products: posts are
hashed into chunks, tags are numbered and cut into blocks, and each
``(chunk, tag block i, tag block j)`` task multiplies two dense incidence
blocks in numpy and emits the non-zero counts; a partial + final sum then
adds the chunks. A row is copied only to the tag blocks that its own post has.
No per-post list of tag pairs is built, and a post that holds a third of all
rows is spread over its tag-block pairs (its cost per task is bounded by the
block size, not by its tag count).
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelnet.session import cut
from labelnet.util import dense_index

TAG_BLOCK = 256
ROWS_PER_CHUNK = 20_000


def gram_copies(x: DataFrame, tag_block: int) -> DataFrame:
    """``x(post_id, t)`` -> one row per tag block ``p`` that the post has (``tb``: the row's own)."""
    x = x.select("post_id", "t", (F.col("t") / tag_block).cast("int").alias("tb"))
    own = x.groupBy("post_id").agg(F.collect_set("tb").alias("blocks"))     # at most n_tags / tag_block
    return x.join(own, "post_id").withColumn("p", F.explode("blocks")).drop("blocks")


def _gram_blocks(x: DataFrame, n_rows: int, tag_block: int, rows_per_chunk: int) -> DataFrame:
    """``(a, b, n)`` partial counts, a < b, from ``x(post_id, t)`` distinct rows."""
    chunks = max(1, math.ceil(n_rows / rows_per_chunk))
    x = gram_copies(x, tag_block).withColumn("c", F.pmod(F.xxhash64("post_id"), F.lit(chunks)).cast("int"))
    rep = x.select("c", F.least("tb", "p").alias("bi"), F.greatest("tb", "p").alias("bj"),
                   F.when(F.col("tb") == F.least("tb", "p"), 0).otherwise(1).alias("side"), "post_id", "t")

    def block(pdf: pd.DataFrame) -> pd.DataFrame:
        bi, bj = int(pdf["bi"].iloc[0]), int(pdf["bj"].iloc[0])
        posts, prow = np.unique(pdf["post_id"].to_numpy(), return_inverse=True)
        t = pdf["t"].to_numpy().astype(np.int64)
        side = pdf["side"].to_numpy()
        a = np.zeros((len(posts), tag_block), dtype=np.float32)
        left = side == 0
        a[prow[left], t[left] - bi * tag_block] = 1.0
        if bi == bj:
            g = a.T @ a
            ii, jj = np.nonzero(np.triu(g, k=1))
        else:
            b = np.zeros((len(posts), tag_block), dtype=np.float32)
            b[prow[~left], t[~left] - bj * tag_block] = 1.0
            g = a.T @ b
            ii, jj = np.nonzero(g)
        return pd.DataFrame({"a": ii + bi * tag_block, "b": jj + bj * tag_block,
                             "n": g[ii, jj].astype(np.int64)})

    return rep.groupBy("c", "bi", "bj").applyInPandas(block, "a long, b long, n long")


def distinct_baskets(baskets: DataFrame) -> DataFrame:
    """``(post_id, tag)`` distinct, written once."""
    return cut(baskets.select("post_id", "tag").distinct(), "baskets")


def _pair_counts(pt: DataFrame, tag_block: int, rows_per_chunk: int) -> DataFrame:
    idx = cut(dense_index(pt, "tag", "t", start=0), "tag_index")
    n_rows = pt.count()
    x = pt.join(idx, "tag").select("post_id", "t")
    counts = _gram_blocks(x, n_rows, tag_block, rows_per_chunk).groupBy("a", "b").agg(F.sum("n").alias("n"))
    na = idx.select(F.col("t").alias("a"), F.col("tag").alias("tag_a"))
    nb = idx.select(F.col("t").alias("b"), F.col("tag").alias("tag_b"))
    return counts.join(na, "a").join(nb, "b").select("tag_a", "tag_b", "n")


def cooccurrence(baskets: DataFrame, tag_block: int = TAG_BLOCK, rows_per_chunk: int = ROWS_PER_CHUNK) -> DataFrame:
    """``(tag_a, tag_b, n)``: number of posts carrying both tags, ``tag_a < tag_b``."""
    return _pair_counts(distinct_baskets(baskets), tag_block, rows_per_chunk)


def cooccurrence_normalized(baskets: DataFrame) -> DataFrame:
    """Co-occurrence divided by ``sqrt(count_a * count_b)`` (usage frequency as a weight)."""
    pt = distinct_baskets(baskets)
    c = _pair_counts(pt, TAG_BLOCK, ROWS_PER_CHUNK)
    cnt = pt.groupBy("tag").agg(F.count(F.lit(1)).alias("count"))
    ca = cnt.select(F.col("tag").alias("tag_a"), F.col("count").alias("ca"))
    cb = cnt.select(F.col("tag").alias("tag_b"), F.col("count").alias("cb"))
    return (c.join(ca, "tag_a").join(cb, "tag_b")
            .select("tag_a", "tag_b", "n", (F.col("n") / F.sqrt(F.col("ca") * F.col("cb"))).alias("weight")))


def usage_trend(usage: DataFrame, every: str = "1 day") -> DataFrame:
    """``(window_start, tag, n)``: uses per tag per tumbling time window."""
    g = usage.groupBy(F.window("ts", every).alias("w"), "tag").agg(F.count(F.lit(1)).alias("n"))
    return g.select(F.col("w.start").alias("window_start"), "tag", "n")


def usage_schema() -> T.StructType:
    return T.StructType([T.StructField("ts", T.TimestampNTZType()), T.StructField("tag", T.StringType())])
