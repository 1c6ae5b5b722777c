"""Graph operators on plain DataFrames: vertices ``(id, name)``, edges ``(src, dst, weight)``.

Iterative algorithms keep only counters on the driver. Every round is
written to the shared checkpoint folder (``session.cut``), so plans do not
grow and a lost executor does not lose the state. All per-vertex choices
are partial + final aggregates (``max(struct(...))``), never a collected
neighbour list, so a hub vertex holding a third of all edges is combined
map-side before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelnet.operators import adjacency, blocks
from labelnet.session import cut, discard
from labelnet.util import dense_index


def undirected(edges: DataFrame) -> DataFrame:
    """Each stored edge in both directions ``(src, dst, weight)``."""
    e = edges.select("src", "dst", "weight")
    return e.unionByName(e.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "weight"))


def written(edges: DataFrame) -> DataFrame:
    """``edges`` as a table that is cheap to read more than once."""
    return edges if getattr(edges, "_cut_path", None) else cut(edges.select("src", "dst", "weight"), "edges")


def both_ways_with_loops(edges: DataFrame, vertices: DataFrame) -> DataFrame:
    """Directed pairs both ways plus a self loop of weight 1.0 per given vertex
    (pass the vertices with a non-zero vector: a zero vector's self cosine is 0)."""
    loops = vertices.select(F.col("id").alias("src"), F.col("id").alias("dst"), F.lit(1.0).alias("weight"))
    return undirected(edges).unionByName(loops)


def endpoint_vertices(edges: DataFrame) -> DataFrame:
    """Distinct edge endpoints ``(id)``."""
    return edges.select(F.col("src").alias("id")).unionByName(edges.select(F.col("dst").alias("id"))).distinct()


def label_propagation(vertices: DataFrame, edges: DataFrame, max_iter: int = 5, weighted: bool = False,
                      stop_early: bool = True) -> DataFrame:
    """Synchronous label propagation ``(id, label)``; starting label = own id.

    Each round every vertex takes the label most popular among its
    neighbours (count of edges, or the decimal sum of edge weights when
    ``weighted``); ties go to the smallest label; a vertex without
    neighbours keeps its label. Stops after ``max_iter`` rounds or at a
    fixpoint (same result as running on).
    """
    if weighted:                      # millionths, whole: sums are exact
        edges = edges.withColumn("weight", F.col("weight").cast("decimal(18,6)") * 1000000)
    dealt = blocks.build(edges, "long" if weighted else None, both=True)      # the edges are dealt once; a round moves labels only
    labels = cut(blocks.propagate(vertices, dealt, max_iter, stop_early), "labels")
    blocks.drop(dealt)
    return labels


def components(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """``(id, component)`` as ``connected_components``, on edges that stay where they are (for graphs whose edges are many
    for their vertices; the stars of ``connected_components`` move a shrinking edge table instead)."""
    adj = adjacency.build(undirected(edges.where("src <> dst")))
    out = adjacency.components(vertices, adj)
    adjacency.drop(adj)
    return out


def split_communities(labels: DataFrame, edges: DataFrame) -> DataFrame:
    """``(id, label)`` with every community that is not connected parted into its connected pieces (the other half of
    merging): edges between communities are left out, and a piece is named by its smallest vertex. A connected community
    is one piece, a vertex without an edge to its own community is alone."""
    lab = labels.select("id", "label")
    inside = (edges.join(lab.select(F.col("id").alias("src"), F.col("label").alias("ls")), "src")
              .join(lab.select(F.col("id").alias("dst"), F.col("label").alias("ld")), "dst").where("ls = ld").select("src", "dst", "weight"))
    return components(lab, inside).withColumnRenamed("component", "label")


def _is_star_forest(e: DataFrame) -> bool:
    """Edges ``(u < v)`` form stars around their smallest vertex: no vertex is both a
    centre and a leaf, and no leaf has two centres. This is exactly the fixpoint of
    large-star / small-star, so no confirming round is needed. One aggregation over
    the roles of each vertex (one shuffle of the small written edge table)."""
    roles = (e.select(F.col("u").alias("x"), F.lit(0).alias("leaf"))
             .unionByName(e.select(F.col("v").alias("x"), F.lit(1).alias("leaf"))))
    per = roles.groupBy("x").agg(F.sum("leaf").alias("nl"), F.min("leaf").alias("minleaf"))
    bad = per.where((F.col("nl") > 1) | ((F.col("nl") >= 1) & (F.col("minleaf") == 0)))
    return bad.limit(1).count() == 0


def connected_components(vertices: DataFrame, edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """``(id, component)`` with component = smallest id in the component.

    Alternating large-star / small-star (Kiveris et al., 2014) on the edge
    set; every round is a group-by min plus a join, and the edge set shrinks
    to stars around the smallest ids. Isolated vertices get their own id.
    """
    e = edges.select(F.least("src", "dst").alias("u"), F.greatest("src", "dst").alias("v")).where(F.col("u") != F.col("v"))
    e = cut(e.distinct(), "components")
    converged = False
    for _ in range(max_rounds):
        if _is_star_forest(e):
            converged = True
            break
        # large-star: link every larger neighbour of u to m(u) = min(N(u) + u)
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        m = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        # written: small-star reads it twice
        large = cut(both.join(m, "u").where(F.col("v") > F.col("u"))
                    .select(F.least("v", "m").alias("u"), F.greatest("v", "m").alias("v"))
                    .where(F.col("u") != F.col("v")).distinct(), "components")
        discard(e)
        # small-star: link u and its smaller neighbours to m(u) = min(smaller N(u) + u)
        down = large.select(F.col("v").alias("u"), F.col("u").alias("v"))  # v < u
        m = down.groupBy("u").agg(F.min("v").alias("m"))
        linked = down.join(m, "u").select("v", "m").unionByName(m.select(F.col("u").alias("v"), "m"))
        e = cut(linked.select(F.least("v", "m").alias("u"), F.greatest("v", "m").alias("v"))
                .where(F.col("u") != F.col("v")).distinct(), "components")
        discard(large)
    if not converged:
        # O(log^2 n) rounds suffice; never return a partial labelling silently
        raise RuntimeError(f"connected components did not converge in {max_rounds} rounds")
    # converged: every edge is (center, member); the center is the component minimum
    comp = e.groupBy(F.col("v").alias("id")).agg(F.min("u").alias("component"))
    return (vertices.select("id").join(comp, "id", "left")
            .select("id", F.coalesce("component", "id").alias("component")))


def dense_labels(labels: DataFrame, label: str = "label", start: int = 0) -> DataFrame:
    """Renumber the labels ``start, start+1, ...`` in ascending order (dense rank)."""
    idx = dense_index(labels, label, "_dense", start)
    return labels.join(idx, label).withColumn(label, F.col("_dense")).drop("_dense")


def modularity(edges: DataFrame, labels: DataFrame, label: str = "label") -> DataFrame:
    """Weighted modularity ``Q = sum_c [ in_c / m - (deg_c / 2m)^2 ]`` as one row.

    ``edges`` stored once per unordered pair; m = total weight. Two group-bys
    (per label, then global); no join of the totals back onto the rows.
    """
    lab = labels.select("id", F.col(label).alias("c"))
    e = edges.select("src", "dst", "weight")
    e = (e.join(lab.withColumnRenamed("id", "src").withColumnRenamed("c", "cs"), "src")
         .join(lab.withColumnRenamed("id", "dst").withColumnRenamed("c", "cd"), "dst"))
    inside = e.where(F.col("cs") == F.col("cd")).groupBy(F.col("cs").alias("c")).agg(F.sum("weight").alias("inw"))
    deg = (undirected(edges).join(lab.withColumnRenamed("id", "src"), "src")
           .groupBy("c").agg(F.sum("weight").alias("deg")))
    per = deg.join(inside, "c", "left").fillna(0.0, ["inw"])
    tot = per.agg(F.sum("inw").alias("inw"), F.sum(F.col("deg") * F.col("deg")).alias("d2"),
                  (F.sum("deg") / 2).alias("m"))
    q = F.when(F.col("m") == 0, F.lit(0.0)).otherwise(
        F.col("inw") / F.col("m") - F.col("d2") / (F.lit(4.0) * F.col("m") * F.col("m")))
    return tot.select(F.round(q, 6).alias("modularity"))


def merge_small_communities(labels: DataFrame, edges: DataFrame, min_size: int) -> DataFrame:
    """One pass: every community with fewer than ``min_size`` members moves to the
    neighbouring community it shares the heaviest total edge weight with
    (ties: smallest label). Targets are taken from the labels before the
    pass (no chaining). A small community without outside edges stays."""
    lab = labels.select("id", "label")
    size = lab.groupBy("label").agg(F.count(F.lit(1)).alias("size"))
    e = (undirected(edges).join(lab.select(F.col("id").alias("src"), F.col("label").alias("ls")), "src")
         .join(lab.select(F.col("id").alias("dst"), F.col("label").alias("ld")), "dst")
         .where(F.col("ls") != F.col("ld")))
    small = size.where(F.col("size") < min_size).select(F.col("label").alias("ls"))
    tie = (e.join(small, "ls", "left_semi").groupBy("ls", "ld")
           .agg(F.sum(F.col("weight").cast("decimal(18,6)")).alias("w")))
    best = tie.groupBy("ls").agg(F.max(F.struct("w", (-F.col("ld")).alias("neg"))).alias("b"))
    target = best.select(F.col("ls").alias("label"), (-F.col("b.neg")).alias("target"))
    return (lab.join(target, "label", "left")
            .select("id", F.coalesce("target", "label").alias("label")))
