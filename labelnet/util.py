"""Small DataFrame helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# AQE broadcasts on its own below this size; explicit broadcast() calls in
# this package are only made for sides whose row count is bounded by a
# parameter (vocabulary size, request count), and are checked against it.
BROADCAST_ROW_LIMIT = 2_000_000


def dense_index(df: DataFrame, col: str, out: str, start: int = 1, unique: bool = False) -> DataFrame:
    """Number the distinct values of ``col`` in ascending order: start, start+1, ...

    Equal to ``dense_rank() over (order by col) - 1 + start`` without a global
    window (which would pull every row into one task). The distinct values
    are range-partitioned and sorted within partitions; a row's number is
    its position inside its partition (the low bits of
    ``monotonically_increasing_id``) plus the row count of all earlier
    partitions (one row per partition, combined on the driver side of a tiny
    aggregate). The numbered table is materialised once so both uses see the
    same partitioning. ``unique=True``: ``col`` is already a key of ``df``;
    every column of ``df`` is kept (one pass over ``df`` instead of two).
    """
    from labelnet.session import cut
    spark = df.sparkSession
    parts = max(1, spark.sparkContext.defaultParallelism)
    keep = df.columns if unique else [col]
    base = df.where(F.col(col).isNotNull())
    base = base if unique else base.select(col).distinct()
    vals = (base.repartitionByRange(parts, col).sortWithinPartitions(col)
            .select(*keep, F.spark_partition_id().alias("_pid"), F.monotonically_increasing_id().alias("_mid")))
    vals = cut(vals, "dense-index")
    sizes = vals.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    # exclusive running total over partitions: bounded by the partition count
    offs = sizes.select("_pid", (F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1))).alias("_off"))
    pos = F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), 33)
    return (vals.join(F.broadcast(offs), "_pid")
            .select(*keep, (F.coalesce(F.col("_off"), F.lit(0)) + pos + F.lit(start)).cast("long").alias(out)))


def spread_rank(df: DataFrame, keys: list[str], order: list, out: str = "rank", parts: int | None = None) -> DataFrame:
    """``out``: each row's place (1, 2, ...) among the rows of its ``keys`` by ``order``, in two levels.

    Equal to ``row_number()`` over a window by ``keys``, which needs all rows of a key in one task. Here the rows are
    range-partitioned by keys and order together, so that a key with many rows lies in several partitions; a row's rank
    is its place in its partition's share of the key plus the sizes of the key's shares before it. ``order`` should end
    in a unique column; equal rows are ranked in any order. Keys may be null (one key).
    """
    from labelnet.session import cut
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by = [*[F.col(k) for k in keys], *order]
    d = (df.repartitionByRange(parts, *by).sortWithinPartitions(*by)
         .select("*", F.spark_partition_id().alias("_pid"), F.monotonically_increasing_id().alias("_mid")))
    d = cut(d, "spread-rank")
    # one row for each key and partition that has some of it: at most keys + parts rows
    shares = d.groupBy(*keys, "_pid").agg(F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_first"))
    before = Window.partitionBy(*keys).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    shares = shares.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_pid").alias("_p"), "_first",
                           F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    on = F.col("_pid") == F.col("_p")
    for i, k in enumerate(keys):
        on &= F.col(k).eqNullSafe(F.col(f"_k{i}"))
    return d.join(shares, on).select(*df.columns, (F.col("_off") + F.col("_mid") - F.col("_first") + 1).cast("int").alias(out))


def checked_broadcast(df: DataFrame, max_rows: int, limit: int = BROADCAST_ROW_LIMIT) -> DataFrame:
    """Broadcast ``df`` only when its row count is bounded by a parameter below the limit.

    ``max_rows`` is the caller's proven bound (e.g. the vocabulary size);
    past the limit the join is left to the planner (shuffle join).
    """
    return F.broadcast(df) if max_rows <= limit else df


def spread(df: DataFrame) -> DataFrame:
    """Round-robin ``df`` over the cluster's cores when its scan has fewer
    splits than cores (e.g. one large parquet row group), so that CPU-heavy
    text cleaning is not stuck in a few tasks. A scan of a large table
    already has more splits than cores and is returned unchanged (no
    shuffle of the raw text)."""
    try:
        target = df.sparkSession.sparkContext.defaultParallelism
        narrow = df.rdd.getNumPartitions() < target
    except Exception:  # noqa: BLE001 - sessions without RDD access: leave the scan as is
        return df
    return df.repartition(target) if narrow else df
