"""Cosine similarity: vector expressions and the all-pairs products.

All pairs of N vectors are exact N^2/2 dot products, computed as matrix
products in numpy inside Spark tasks, emitting only the pairs the caller
asked for (over a threshold, or a top-k per row). There is one physical form
at every size: rows are hashed into B blocks, each row is shuffled to the
tiles (block pairs) it takes part in (N*B rows, never N^2), and each tile is
one ``applyInPandas``/``cogroup`` call. B comes from the rows that are there,
the memory budget of a dense block and the number of tasks the cluster can
run at once. Within a tile the left block is scored in slices, so the score
matrix keeps to the same budget.

No cross join, no pair list per group and no collected side is ever built.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BLOCK_BYTES = 64 * 1024 * 1024   # memory budget of one dense block, and of one slice of scores
PAIR_SLICE_BYTES = 8 * 1024 * 1024   # of one slice of scores whose pairs go out before the next
MIN_BLOCK_ROWS = 64              # blocks aren't made smaller than this to get more tiles
ROUND = 6                        # places that scores are rounded to before they are ranked


# ---- column expressions ------------------------------------------------------

def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda acc, x: acc + x)


def l2(a: Column) -> Column:
    return F.sqrt(F.aggregate(a, F.lit(0.0), lambda acc, x: acc + x * x))


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two array columns; 0.0 when either norm is zero (no division by 0)."""
    a = a.cast("array<double>")
    b = b.cast("array<double>")
    den = l2(a) * l2(b)
    return F.when(den == 0, F.lit(0.0)).otherwise(dot(a, b) / den)


def normalize_arrays(df: DataFrame, vals: str = "vals") -> DataFrame:
    """Scale ``vals`` to unit length; zero vectors stay zero."""
    n = l2(F.col(vals))
    return df.withColumn(vals, F.when(n == 0, F.col(vals)).otherwise(F.transform(vals, lambda x: x / n)))


def sendable(vecs: DataFrame) -> tuple[DataFrame, int]:
    """``vecs`` with ``vals`` as floats if these hold every number, and how many rows it has. For vectors that are copied to
    many tasks: these find the unit length themselves (``_unit``), as scaled numbers take twice the bytes."""
    floats = F.col("vals").cast("array<float>")
    rows, fit = vecs.agg(F.count(F.lit(1)), F.bool_and(floats.cast("array<double>") == F.col("vals"))).first()
    return (vecs.withColumn("vals", floats) if fit else vecs), rows


# ---- the blocked product -------------------------------------------------------

def _dense(pdf: pd.DataFrame, dim: int) -> np.ndarray:
    n = len(pdf)
    m = np.zeros((n, dim), dtype=np.float64)
    if n == 0:
        return m
    idxs = pdf["idxs"].to_numpy()
    vals = pdf["vals"].to_numpy()
    lens = np.fromiter((len(x) for x in idxs), dtype=np.int64, count=n)
    if lens.sum() == 0:
        return m
    rows = np.repeat(np.arange(n), lens)
    m[rows, np.concatenate(idxs).astype(np.int64)] = np.concatenate(vals).astype(np.float64)
    return m


def _unit(m: np.ndarray) -> np.ndarray:
    """Rows scaled to unit length, added up in order as ``l2`` does; zero rows stay zero."""
    for part in _slices(len(m), m.shape[1] or 1, PAIR_SLICE_BYTES):
        n = np.sqrt(np.add.accumulate(m[part] ** 2, axis=1)[:, -1:]) if m.shape[1] else 1.0
        m[part] /= np.where(n == 0, 1.0, n)
    return m


def _passes(s: np.ndarray, threshold: float, inclusive: bool) -> np.ndarray:
    return s >= threshold if inclusive else s > threshold


def _topk_rows(s: np.ndarray, k: int):
    """Per row: the k best columns plus every column whose score may round to
    that of the k-th, so that the exact tie-break (rounded score, key) done later
    in Spark sees every candidate that could win it."""
    if s.shape[1] <= k:
        return np.nonzero(np.ones_like(s, dtype=bool))
    kth = -np.partition(-s, k - 1, axis=1)[:, k - 1]
    return np.nonzero(s >= (kth - 1.01 * 10.0 ** -ROUND)[:, None])


def block_rows_for(dim: int) -> int:
    """Rows per block so that one dense block stays under ``BLOCK_BYTES``."""
    return max(1, BLOCK_BYTES // (8 * max(1, dim)))


def num_blocks(n: int, dim: int, tasks: int, block_rows: int | None = None) -> int:
    """Blocks of ``n`` rows: enough for the byte budget, and up to ``tasks`` of them as long as a block keeps
    ``MIN_BLOCK_ROWS``. ``block_rows`` sets the rows of a block instead (tests)."""
    if block_rows:
        return max(1, math.ceil(n / block_rows))
    return max(1, math.ceil(n / block_rows_for(dim)), min(tasks, n // MIN_BLOCK_ROWS))


def _tasks(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _key_fields(df: DataFrame, keys: list[str]) -> list[T.StructField]:
    return [T.StructField(k, df.schema[k].dataType) for k in keys]


def _slices(n_left: int, n_right: int, most: int | None = None):
    """Slices of the left rows whose scores against the right rows keep to ``most`` bytes (``BLOCK_BYTES``)."""
    step = max(1, (most or BLOCK_BYTES) // (8 * max(1, n_right)))
    for i in range(0, n_left, step):
        yield slice(i, min(n_left, i + step))


def similar_pairs(vecs: DataFrame, key: str, dim: int, threshold: float, inclusive: bool = False,
                  block_rows: int | None = None, normalized: bool = False) -> DataFrame:
    """Unordered pairs ``(src, dst, weight)`` with ``src < dst`` and cosine over
    ``threshold`` (``>`` or ``>=``).

    ``vecs``: ``(key, idxs array<int>, vals array<double>)``. Tiles are block
    pairs ``(bi, bj)`` with ``bi <= bj``; a row of block b goes to ``(b, j)`` for
    j >= b as the left side and to ``(i, b)`` for i < b as the right side. A tile
    whose right block has no rows gives nothing, unless it is on the diagonal.
    """
    v, rows = sendable(vecs.select(F.col(key).alias("id"), "idxs", "vals"))
    key_type = vecs.schema[key].dataType
    schema = T.StructType([T.StructField("src", key_type), T.StructField("dst", key_type),
                           T.StructField("weight", T.DoubleType())])
    tasks = _tasks(vecs)
    B = num_blocks(rows, dim, math.ceil(math.sqrt(2 * tasks)), block_rows)   # B (B + 1) / 2 tiles
    v = v.withColumn("b", F.pmod(F.xxhash64("id"), F.lit(B)).cast("int"))
    v = v.withColumn("p", F.explode(F.sequence(F.lit(0), F.lit(B - 1))))
    rep = v.select(F.least("b", "p").alias("bi"), F.greatest("b", "p").alias("bj"),
                   F.when(F.col("b") == F.least("b", "p"), 0).otherwise(1).alias("side"),
                   "id", "idxs", "vals")

    def block(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # a frame of rows is dense numbers before the next one comes, and a slice's pairs go out before the next slice's
        parts, same = {0: [], 1: []}, True
        for pdf in frames:
            same = pdf["bi"].iloc[0] == pdf["bj"].iloc[0]
            for side in (0, 1):
                some = pdf[pdf["side"] == side]
                m = _dense(some, dim)
                parts[side].append((some["id"].to_numpy(), m if normalized else _unit(m)))
        ids_a, a = (np.concatenate(x) for x in zip(*parts[0]))
        ids_b, b = (ids_a, a) if same else (np.concatenate(x) for x in zip(*parts[1]))
        parts.clear()
        for part in _slices(len(a), len(b), PAIR_SLICE_BYTES):
            s = a[part] @ b.T
            ii, jj = np.nonzero(_passes(s, threshold, inclusive))
            x, y, w = ids_a[part][ii], ids_b[jj], s[ii, jj]
            keep = x < y if same else np.ones(len(x), dtype=bool)
            swap = x > y
            yield pd.DataFrame({"src": np.where(swap, y, x)[keep], "dst": np.where(swap, x, y)[keep], "weight": w[keep]})

    # dealt by number, which AQE doesn't merge: tiles are small in bytes and large in work
    return rep.repartition(min(tasks, B * (B + 1) // 2), "bi", "bj").groupBy("bi", "bj").applyInPandas(block, schema)


def _select(s: np.ndarray, lk: dict, rk: dict, *, top_k, threshold, inclusive, positive_only,
            exclude_same_key) -> pd.DataFrame:
    """Rows ``lkeys + rkeys + score`` chosen from one score block."""
    mask = np.ones_like(s, dtype=bool)
    if threshold is not None:
        mask &= _passes(s, threshold, inclusive)
    if positive_only:
        mask &= s > 0
    if exclude_same_key and len(lk) == 1 and len(rk) == 1:
        mask &= next(iter(lk.values()))[:, None] != next(iter(rk.values()))[None, :]
    if top_k is not None:
        masked = np.where(mask, s, -np.inf)
        ii, jj = _topk_rows(masked, top_k)
        ok = np.isfinite(masked[ii, jj])
        ii, jj = ii[ok], jj[ok]
    else:
        ii, jj = np.nonzero(mask)
    out = {k: v[ii] for k, v in lk.items()}
    out.update({k: v[jj] for k, v in rk.items()})
    out["score"] = s[ii, jj]
    return pd.DataFrame(out)


def block_scores(left: DataFrame, right: DataFrame, lkeys: list[str], rkeys: list[str], dim: int, *,
                 top_k: int | None = None, threshold: float | None = None, inclusive: bool = False,
                 positive_only: bool = False, exclude_same_key: bool = False,
                 block_rows: int | None = None, normalized: bool = False) -> DataFrame:
    """Cosine of every left row against every right row.

    Emits ``lkeys + rkeys + [score]`` for: all pairs (no filter), pairs over
    ``threshold``, and/or the ``top_k`` right rows per left row (rounded score
    desc, right key asc). A per-tile top-k with its ties is a superset of the
    global top-k; the caller finishes with a window over ``top_k`` rows and ties
    per key and right block.
    """
    if not normalized:
        left, right = normalize_arrays(left), normalize_arrays(right)
    schema = T.StructType(_key_fields(left, lkeys) + _key_fields(right, rkeys)
                          + [T.StructField("score", T.DoubleType())])
    opts = dict(top_k=top_k, threshold=threshold, inclusive=inclusive, positive_only=positive_only,
                exclude_same_key=exclude_same_key)
    tasks = _tasks(left)
    # the right side is cut for memory only: each of its blocks copies the left side once
    br = num_blocks(right.count(), dim, 1, block_rows)
    bl = num_blocks(left.count(), dim, math.ceil(tasks / br), block_rows)
    # int like the exploded block numbers: both sides of the cogroup must hash alike
    lh = F.pmod(F.xxhash64(*lkeys), F.lit(bl)).cast("int")
    rh = F.pmod(F.xxhash64(*rkeys), F.lit(br)).cast("int")
    # fresh aliases: both sides may come from one plan (a self product)
    L = left.select(*[F.col(k).alias(k) for k in lkeys], F.col("idxs").alias("idxs"), F.col("vals").alias("vals"),
                    lh.alias("bl"), F.explode(F.sequence(F.lit(0), F.lit(br - 1))).alias("br"))
    R = right.select(*[F.col(k).alias(k) for k in rkeys], F.col("idxs").alias("idxs"), F.col("vals").alias("vals"),
                     rh.alias("br"), F.explode(F.sequence(F.lit(0), F.lit(bl - 1))).alias("bl"))

    def block(lp: pd.DataFrame, rp: pd.DataFrame) -> pd.DataFrame:
        if len(lp) == 0 or len(rp) == 0:
            return pd.DataFrame({f.name: pd.Series(dtype="object") for f in schema.fields})
        a, b = _dense(lp, dim), _dense(rp, dim)
        rk = {k: rp[k].to_numpy() for k in rkeys}
        return pd.concat([_select(a[part] @ b.T, {k: lp[k].to_numpy()[part] for k in lkeys}, rk, **opts)
                          for part in _slices(len(a), len(b))], ignore_index=True)

    n = min(tasks, bl * br)
    return (L.repartition(n, "bl", "br").groupBy("bl", "br")
            .cogroup(R.repartition(n, "bl", "br").groupBy("bl", "br")).applyInPandas(block, schema))
