"""Graph rounds that move labels only: the edges lie still, dealt by their source.

``build`` writes each vertex's neighbours once, as rows (src, part, neighbours) of at most about ``ARC`` neighbours: a hub
with a third of all edges has many parts. The table is bucketed by (src, part), so Spark knows how it lies and a join by
these columns sorts and shuffles the labels only; the edges are read where they are, in every round.

Messages go to the neighbours as partial aggregates. States are written to the shared checkpoint folder each round.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelnet.session import cut, discard, scratch_path

ARC = 4096        # neighbours in one row, about


@dataclass
class Adjacency:
    table: DataFrame      # (src, part, nbrs array<struct<dst, w>>), bucketed by src and part
    hubs: DataFrame       # (src, parts) of vertices with more than one part: at most edges / ARC rows
    name: str
    path: str


def build(und: DataFrame, arc: int = ARC) -> Adjacency:
    """``und``: edges (src, dst, weight) both ways."""
    spark = und.sparkSession
    und = cut(und.select("src", "dst", "weight"), "undirected")
    hubs = cut(und.groupBy("src").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > arc)
               .select("src", F.ceil(F.col("n") / arc).cast("int").alias("parts")), "hubs")
    rows = und.join(hubs, "src", "left")
    part = F.pmod(F.xxhash64("dst"), F.coalesce("parts", F.lit(1))).cast("int")
    rows = rows.select("src", part.alias("part"), F.struct("dst", F.col("weight").alias("w")).alias("e"))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name, path = f"adjacency_{uuid.uuid4().hex}", scratch_path(spark, "adjacency")
    (rows.groupBy("src", "part").agg(F.collect_list("e").alias("nbrs")).repartition(n, "src", "part")
     .write.bucketBy(n, "src", "part").option("path", path).saveAsTable(name))
    discard(und)
    return Adjacency(spark.table(name), hubs, name, path)


def drop(adj: Adjacency) -> None:
    """Forget the table and delete its files, once nothing reads them."""
    spark = adj.table.sparkSession
    spark.sql(f"DROP TABLE IF EXISTS {adj.name}")
    adj.table._cut_path = adj.path
    discard(adj.table)
    discard(adj.hubs)


def messages(labels: DataFrame, adj: Adjacency, value: str) -> DataFrame:
    """``(id, value, w)``: each vertex's ``value`` (labels: id, value, parts) at every neighbour ``id``. Only ``labels`` move."""
    out = labels.select(F.col("id").alias("src"), value, F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    met = adj.table.join(out.hint("shuffle_hash"), ["src", "part"])
    return met.select(value, F.explode("nbrs").alias("e")).select(F.col("e.dst").alias("id"), value, F.col("e.w").alias("w"))


def with_parts(vertices: DataFrame, adj: Adjacency) -> DataFrame:
    return vertices.join(adj.hubs.withColumnRenamed("src", "id"), "id", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))


def propagate(vertices: DataFrame, adj: Adjacency, max_iter: int, weighted: bool, stop_early: bool = True) -> DataFrame:
    """Synchronous label propagation ``(id, label)``: see ``graph.label_propagation``."""
    labels = old = cut(with_parts(vertices.select("id"), adj).select("id", F.col("id").alias("label"), "parts"), "labels")
    pop = F.sum("w") if weighted else F.count(F.lit(1))
    for r in range(max_iter):
        votes = messages(labels, adj, "label").groupBy("id", "label").agg(pop.alias("pop"))
        best = votes.groupBy("id").agg(F.max(F.struct("pop", (-F.col("label")).alias("neg"))).alias("b")).select("id", (-F.col("b.neg")).alias("new"))
        # written with a changed flag: the fixpoint test is a filtered count of the table just written
        labels = cut(labels.join(best, "id", "left").select("id", F.coalesce("new", "label").alias("label"), "parts",
                                                            (F.coalesce("new", "label") != F.col("label")).alias("changed")), "labels")
        discard(old)
        old = labels
        if stop_early and r < max_iter - 1 and labels.where("changed").isEmpty():
            break
    return labels.select("id", "label")


def components(vertices: DataFrame, adj: Adjacency, max_rounds: int = 100) -> DataFrame:
    """``(id, component)``, the smallest id of each component, on a fixed edge table (after FastSV, Zhang et al. 2020).

    Each vertex points to a smaller one of its component. A round takes every vertex's grandparent to its neighbours; the
    smallest that arrives becomes a pointer of the vertex and of its parent, and pointers are shortened. Pointers only get
    smaller, and when none changes, all of a component point to its smallest vertex.
    """
    f = old = cut(with_parts(vertices.select("id"), adj).select("id", F.col("id").alias("f"), F.col("id").alias("g"), "parts"), "pointers")
    for _ in range(max_rounds):
        low = messages(f, adj, "g").groupBy("id").agg(F.min("g").alias("low"))
        met = cut(f.join(low, "id", "left").select("id", "f", "g", "parts", F.least("g", F.coalesce("low", "g")).alias("low")), "pointers-met")
        hook = met.groupBy(F.col("f").alias("id")).agg(F.min("low").alias("hook"))
        new = met.join(hook, "id", "left").select("id", F.least("f", "low", F.coalesce("hook", "low")).alias("n"), F.col("f").alias("was"), "parts")
        new = cut(new, "pointers-new")
        up = new.select(F.col("id").alias("n"), F.col("n").alias("g"))
        # written with the grandparents of the next round; unchanged pointers have unchanged grandparents
        f = cut(new.join(up, "n").select("id", F.col("n").alias("f"), "g", "parts", (F.col("n") != F.col("was")).alias("changed")), "pointers")
        for x in (old, met, new):
            discard(x)
        old = f
        if f.where("changed or f <> g").isEmpty():
            return f.select("id", F.col("f").alias("component"))
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
