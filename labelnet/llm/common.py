"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from labelnet.session import scratch_path

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def saved(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared checkpoint folder and read back: cuts the
    lineage, survives a lost executor, and fixes values such as row numbers that
    would differ if the plan ran twice."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def give_back() -> None:
    """What a Python worker freed goes back to the system: workers live on beside the next stage's."""
    import ctypes

    import pyarrow as pa
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)      # glibc only
    if trim:
        trim(0)


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col), F.lit(""))


def ascii_lower(c: Column) -> Column:
    """A-Z only. An ASCII string takes the fast ``lower``; others keep every other letter as it is."""
    return F.when(F.octet_length(c) == F.length(c), F.lower(c)).otherwise(F.translate(c, UPPER, LOWER))


def bucket_count(rows: int, per_bucket: int) -> int:
    """Buckets so that each holds about ``per_bucket`` rows (keys spread by a hash)."""
    return max(1, -(-rows // per_bucket))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until no column of ``df`` is called so (in any case)."""
    have = {c.lower() for c in df.columns}
    while name.lower() in have:
        name = "_" + name
    return name


def running_rank(df: DataFrame, order: str, weight: str | None, out: str, per_bucket: int = 50_000) -> DataFrame:
    """Adds ``out``: the sum of ``weight`` (count where None) over all rows before this one, without a
    global window. Rows go to hash buckets of ``order`` (a unique key); a window numbers each bucket,
    and the totals of the buckets (one row for each) are summed up beside it."""
    from pyspark.sql import Window
    n = bucket_count(df.count(), per_bucket)
    w = F.col(weight) if weight else F.lit(1)
    d = df.withColumn("_bk", F.pmod(F.xxhash64(F.col(order)), F.lit(n)).cast("int"))
    offs = d.groupBy("_bk").agg(F.sum(w.cast("long")).alias("_t"))
    offs = offs.select("_bk", F.coalesce(F.sum("_t").over(Window.orderBy("_bk").rowsBetween(Window.unboundedPreceding, -1)),
                                         F.lit(0)).alias("_off"))
    win = Window.partitionBy("_bk").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    d = d.withColumn(out, F.coalesce(F.sum(w.cast("long")).over(win), F.lit(0)))
    return d.join(offs, "_bk").withColumn(out, F.col(out) + F.col("_off")).drop("_bk", "_off")
