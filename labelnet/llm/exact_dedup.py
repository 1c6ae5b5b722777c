"""Exact dedup against immutable snapshots.

A snapshot holds the digests of its texts in buckets of the digest's hash, and for each bucket a
static 3-wise binary-fuse filter of 16-bit fingerprints. New digests are grouped among themselves
first; the distinct ones are screened by the filter of their bucket (about 1 in 65,000 false hits),
and what passes joins the bucket's exact digests. Rows of a group are then compared with one of
its texts byte by byte, so that a digest alone never makes two texts equal.

Defined cases: a null text is empty, and all empty texts are equal; of equal texts the row with the
largest doc_id stays (a null doc_id is smallest; of rows with the same doc_id, one stays); an empty
table gives an empty result; an empty snapshot passes nothing. A text of any length is hashed and compared whole. Other
columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, bucket_count, saved, text_or_empty


def _mix(x: np.ndarray, seed: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = x + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & 0xFFFFFFFFFFFFFFFF)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def _slots(keys: np.ndarray, seed: int, seg: int, n_seg: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Three slots in three neighbouring segments, and the 16-bit fingerprint."""
    h = _mix(keys, seed)
    first = (h >> np.uint64(33)) % np.uint64(n_seg)
    out = [((first + np.uint64(j)) * np.uint64(seg) + (_mix(h, j + 1) & np.uint64(seg - 1))).astype(np.int64) for j in range(3)]
    return out, (_mix(h, 7) & np.uint64(0xFFFF)).astype(np.uint16)


def fuse_build(keys: np.ndarray) -> tuple[int, int, int, np.ndarray]:
    """``(seed, segment size, segments, table)`` of a filter that holds every key (uint64).
    Keys are peeled in rounds, all that stand alone in a slot at once; a seed that leaves a core is replaced."""
    keys = np.unique(keys)
    n = max(1, len(keys))
    seg = 1 << max(2, int(np.floor(np.log(n) / np.log(3.33) + 2.25)))
    seg = min(seg, 1 << 18)
    need = int(n * max(1.125, 0.875 + 0.25 * max(1.0, np.log(1e6) / np.log(max(n, 2)))))
    n_seg = max(1, -(-need // seg))
    for seed in range(1000):
        if seed and seed % 20 == 0:
            n_seg += 1 + n_seg // 10
        slots, fp = _slots(keys, seed, seg, n_seg)
        size = (n_seg + 2) * seg
        m = np.stack(slots)                                     # 3 x n
        count = np.bincount(m.ravel(), minlength=size)
        ident = np.arange(len(keys))
        xors = np.zeros(size, np.int64)
        for j in range(3):
            np.bitwise_xor.at(xors, m[j], ident)
        alive, order, at = np.ones(len(keys), bool), [], []
        while True:
            single = np.flatnonzero(count == 1)
            if not len(single):
                break
            k, first = np.unique(xors[single], return_index=True)
            order.append(k)
            at.append(single[first])
            alive[k] = False
            for j in range(3):
                np.subtract.at(count, m[j][k], 1)
                np.bitwise_xor.at(xors, m[j][k], k)
        if alive.any():
            continue
        table = np.zeros(size, np.uint16)
        for k, own in zip(reversed(order), reversed(at)):       # keys of one round never share the slot they own
            v = fp[k].copy()
            for j in range(3):
                s = m[j][k]
                v ^= np.where(s == own, np.uint16(0), table[s])
            table[own] = v
        return seed, seg, n_seg, table
    raise RuntimeError("no seed peels the filter")


def fuse_has(keys: np.ndarray, seed: int, seg: int, n_seg: int, table: np.ndarray) -> np.ndarray:
    slots, fp = _slots(keys, seed, seg, n_seg)
    return (table[slots[0]] ^ table[slots[1]] ^ table[slots[2]]) == fp


def digests(docs: DataFrame) -> DataFrame:
    """``(doc_id, norm, digest)``: the text with A-Z lower-cased, and its SHA-256 in hex."""
    d = docs.select("doc_id", ascii_lower(text_or_empty()).alias("norm"))
    return d.withColumn("digest", F.sha2(F.col("norm"), 256))


def _key64():
    return F.xxhash64("digest")


def build_snapshot(groups: DataFrame, per_bucket: int = 50_000) -> tuple[DataFrame, DataFrame, int]:
    """``groups`` (digest and any columns, one row for each digest) -> (exact buckets, filters, number of buckets)."""
    n = bucket_count(groups.count(), per_bucket)
    exact = saved(groups.withColumn("bucket", F.pmod(F.col("key"), F.lit(n)).cast("int")), "snapshot")

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        seed, seg, n_seg, table = fuse_build(pdf["key"].to_numpy(np.int64).view(np.uint64))
        return pd.DataFrame({"bucket": [pdf["bucket"].iloc[0]], "seed": [seed], "seg": [seg], "n_seg": [n_seg],
                             "cells": [table.tobytes()]})
    filters = saved(exact.select("bucket", "key").groupBy("bucket")
                    .applyInPandas(build, "bucket int, seed int, seg int, n_seg int, cells binary"), "filters")
    return exact, filters, n


def screen(incoming: DataFrame, filters: DataFrame, n: int) -> DataFrame:
    """Rows of ``incoming`` (distinct digests with their ``key``) that the filter of their bucket may hold."""
    cols = incoming.columns
    inc = incoming.withColumn("bucket", F.pmod(F.col("key"), F.lit(n)).cast("int"))

    def probe(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(right) or not len(left):
            return left.iloc[:0]
        f = right.iloc[0]
        hit = fuse_has(left["key"].to_numpy(np.int64).view(np.uint64), int(f["seed"]), int(f["seg"]), int(f["n_seg"]),
                       np.frombuffer(f["cells"], np.uint16))
        return left[hit]
    return (inc.groupBy("bucket").cogroup(filters.groupBy("bucket"))
            .applyInPandas(probe, inc.schema).select(*cols))


def exact_dedup(docs: DataFrame, in_snapshot) -> DataFrame:
    """One row for each row of ``docs``: ``doc_id, keep_id, group_size, kept, text_sha256``.

    ``in_snapshot``: a condition on doc_id; rows that meet it are the immutable snapshot, the rest the new batch.
    """
    rows = digests(docs)
    meta = saved(rows.select("doc_id", "digest", _key64().alias("key"), F.monotonically_increasing_id().alias("uid"),
                             F.coalesce(in_snapshot, F.lit(False)).alias("old")), "digests")
    per = meta.groupBy("old", "digest").agg(F.first("key").alias("key"), F.max("doc_id").alias("top"), F.count(F.lit(1)).alias("n"))
    per = saved(per, "digest-groups")
    exact, filters, n = build_snapshot(per.where("old").drop("old"))
    new = per.where(~F.col("old")).drop("old")
    hits = screen(new, filters, n).select("digest", F.col("top").alias("new_top"), F.col("n").alias("new_n"))
    # exact buckets: what the filter let through by mistake finds no digest here
    both = exact.join(hits, "digest").select(
        "digest", F.greatest("top", "new_top").alias("top"), (F.col("n") + F.col("new_n")).alias("n"))
    alone = per.drop("old", "key").join(both.select("digest"), "digest", "left_anti")
    groups = saved(alone.select("digest", "top", "n").unionByName(both), "exact-groups")
    shared = groups.where("n > 1")
    out = meta.select("doc_id", "uid", "digest").join(groups, "digest")
    # byte check: every text of a group against one of them. The rows that differ (none, unless SHA-256
    # fails) are grouped by their bytes
    texts = rows.join(shared.select("digest", "top"), "digest")
    one = texts.where(F.col("doc_id").eqNullSafe(F.col("top"))).groupBy("digest").agg(F.min("norm").alias("one"))
    odd = texts.join(one, "digest").where(F.col("norm") != F.col("one")).select("digest").distinct()
    odd = saved(odd, "collisions")
    if odd.limit(1).count():
        t = rows.join(odd, "digest").groupBy("digest", "norm").agg(F.max("doc_id").alias("top"), F.count(F.lit(1)).alias("n"))
        named = rows.join(odd, "digest").join(t, ["digest", "norm"]).select("doc_id", "digest", "top", "n")
        out = out.join(odd, "digest", "left_anti").unionByName(named.withColumn("uid", F.monotonically_increasing_id()).select(*out.columns))
    # of rows with the same doc_id and text, one stays
    first = out.where(F.col("doc_id").eqNullSafe(F.col("top"))).groupBy("digest", "top").agg(F.min("uid").alias("first"))
    first = first.withColumnRenamed("digest", "d2").withColumnRenamed("top", "t2")
    out = out.join(first, (F.col("digest") == F.col("d2")) & F.col("top").eqNullSafe(F.col("t2")))
    return out.select("doc_id", F.col("top").alias("keep_id"), F.col("n").alias("group_size"),
                      (F.col("uid") == F.col("first")).alias("kept"), F.col("digest").alias("text_sha256"))
