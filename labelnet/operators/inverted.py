"""Top-k by cosine over sparse vectors: an inverted index of terms with upper bounds.

The index holds, for every term, the rows that have it (``postings``: term, row, weight of the unit-length row) and the
largest weight among them (``tops``). A query's score against a row is the sum over the terms they share, so only
postings of the query's own terms are read; rows that share none have score 0 and appear nowhere.

Pruning before the top k, exact for weights that aren't negative: a term can add at most ``query weight x largest
weight``. A query's terms stand by that bound, the largest first.

1. The first ``HEADS`` terms are scored alone. The k-th best of these partial sums is a floor: a row below it can't be
   among the k best.
2. The query's last terms whose bounds together stay below the floor are its tail. A row that shares tail terms only is
   out, so only the other terms' postings are opened; a row whose sum and tail bound stay below the floor is out, too.
3. The tail's weights are looked up for the rows that are left, by (term, row).

A term's postings are dealt into ``shard`` by hash of the row, so a term that is in every row isn't one task's.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from labelnet.session import cut
from labelnet.util import checked_broadcast

HEADS = 4                 # terms that give the floor
PER_SHARD = 200_000       # postings of a term in one shard, about
MARGIN = 1.01e-6          # scores are ranked by six places: what may round alike stays


@dataclass
class Index:
    postings: DataFrame     # (idx, shard, row, w): rows of unit length
    tops: DataFrame         # (idx, top): largest weight of each term; at most ``size`` rows
    size: int               # number of terms, a bound
    shards: int


def unit_rows(long: DataFrame, keys: list[str]) -> DataFrame:
    """``(keys, idx, w)`` at unit length; a row has at most as many entries as there are terms."""
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy(*keys)))
    return long.where("w <> 0").select(*keys, "idx", (F.col("w") / norm).alias("w"))


def build(vectors: DataFrame, key: str, size: int) -> Index:
    """Index of ``vectors`` (key, idx, w; w >= 0) over at most ``size`` terms, written once."""
    rows = cut(unit_rows(vectors, [key]).withColumnRenamed(key, "row"), "postings")
    tops = cut(rows.groupBy("idx").agg(F.max("w").alias("top"), F.count(F.lit(1)).alias("n")), "posting-tops")
    return _sharded(rows, tops, size)


def _sharded(rows: DataFrame, tops: DataFrame, size: int) -> Index:
    most = tops.agg(F.max("n")).first()[0] or 0
    shards = max(1, -(-most // PER_SHARD))
    return Index(rows.withColumn("shard", F.pmod(F.xxhash64("row"), F.lit(shards)).cast("int")), tops.select("idx", "top"), size, shards)


def save(index: Index, path: str) -> None:
    index.postings.select("idx", "row", "w").write.mode("overwrite").parquet(f"{path}/postings")
    index.postings.groupBy("idx").agg(F.max("w").alias("top"), F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(f"{path}/tops")


def load(spark, path: str, size: int) -> Index:
    rows = spark.read.schema("idx int, row bigint, w double").parquet(f"{path}/postings")
    return _sharded(rows, spark.read.schema("idx int, top double, n bigint").parquet(f"{path}/tops"), size)


def _open(terms: DataFrame, index: Index) -> DataFrame:
    """``terms`` (.., idx, q) with the rows and weights of their postings."""
    spread = F.explode(F.sequence(F.lit(0), F.lit(index.shards - 1))).alias("shard")
    t = terms.select("*", spread) if index.shards > 1 else terms.withColumn("shard", F.lit(0))
    return t.join(index.postings, ["idx", "shard"])


def top_k(queries: DataFrame, keys: list[str], index: Index, k: int, heads: int = HEADS) -> DataFrame:
    """``keys, row, score`` for each of ``queries`` (keys, idx, w; w >= 0): its k best rows with a score over 0, and rows
    whose rounded score may tie with the k-th (the caller ranks them)."""
    q = unit_rows(queries, keys).join(checked_broadcast(index.tops, index.size), "idx")
    q = q.select(*keys, "idx", F.col("w").alias("q"), (F.col("w") * F.col("top")).alias("u"))
    order = Window.partitionBy(*keys).orderBy(F.desc("u"), "idx")
    q = q.select(*keys, "idx", "q", "u", F.sum("u").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing)).alias("rest"))
    # one row for each query: its terms by bound, ``rest``: the bounds of a term and all after it together
    q = q.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct((-F.col("u")).alias("u"), "idx", "q", "rest"))).alias("t"))
    q = cut(q, "query-terms")
    first = q.select(*keys, F.explode(F.slice("t", 1, heads)).alias("x")).select(*keys, F.col("x.idx").alias("idx"), F.col("x.q").alias("q"))
    part = _open(first, index).groupBy(*keys, "row").agg(F.sum(F.col("q") * F.col("w")).alias("s"))
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("s")))
    floor = part.withColumn("n", nth).where(F.col("n") <= k).groupBy(*keys).agg(F.max("n").alias("n"), F.min("s").alias("s")).where(F.col("n") == k)
    q = q.join(floor.select(*keys, (F.col("s") - MARGIN).alias("floor")), keys, "left").withColumn("floor", F.coalesce("floor", F.lit(0.0)))
    q = q.withColumns({"head": F.filter("t", lambda x: x["rest"] >= F.col("floor")), "tail": F.filter("t", lambda x: x["rest"] < F.col("floor"))})
    q = cut(q.select(*keys, "floor", "head", "tail", F.coalesce(F.get("tail", F.lit(0))["rest"], F.lit(0.0)).alias("rest")), "query-parts")
    own = q.select(*keys, "floor", "rest", F.explode("head").alias("x")).select(*keys, "floor", "rest", F.col("x.idx").alias("idx"), F.col("x.q").alias("q"))
    hits = _open(own, index).groupBy(*keys, "row").agg(F.sum(F.col("q") * F.col("w")).alias("s"), F.max("floor").alias("floor"), F.max("rest").alias("rest"))
    hits = hits.where(F.col("s") + F.col("rest") >= F.col("floor"))
    if q.where(F.size("tail") > 0).isEmpty():
        return hits.where("s > 0").select(*keys, "row", F.col("s").alias("score"))
    hits = cut(hits, "query-hits")
    late = hits.where("rest > 0").select(*keys, "row").join(q.select(*keys, "tail"), keys).select(*keys, "row", F.explode("tail").alias("x"))
    late = late.select(*keys, "row", F.col("x.idx").alias("idx"), F.col("x.q").alias("q")).join(index.postings.drop("shard"), ["idx", "row"])
    every = hits.select(*keys, "row", "s").unionByName(late.select(*keys, "row", (F.col("q") * F.col("w")).alias("s")))
    return every.groupBy(*keys, "row").agg(F.sum("s").alias("score")).where("score > 0")
