from collections import Counter, defaultdict

import pytest

from pyspark.sql import functions as F

from labelnet.operators import adjacency
from labelnet.operators import graph as gr
from labelnet.operators import louvain as lv

# isolated 1; isolated edge 2-3; triangle 4-5-6; 4-cycle 7-8-9-10;
# two triangles 11-12-13 and 14-15-16 joined by 13-14
EDGES = [(2, 3), (4, 5), (5, 6), (4, 6), (7, 8), (8, 9), (9, 10), (7, 10),
         (11, 12), (12, 13), (11, 13), (14, 15), (15, 16), (14, 16), (13, 14)]
VERTS = list(range(1, 17))


def graph(spark, edges=EDGES, verts=VERTS, w=None):
    v = spark.createDataFrame([(i, str(i)) for i in verts], "id long, name string")
    e = spark.createDataFrame([(a, b, (w or {}).get((a, b), 1.0)) for a, b in edges], "src long, dst long, weight double")
    return v, e


def brute_lp(verts, edges, rounds, w=None):
    nb = defaultdict(list)
    for a, b in edges:
        x = (w or {}).get((a, b), 1.0)
        nb[a].append((b, x))
        nb[b].append((a, x))
    lab = {v: v for v in verts}
    for _ in range(rounds):
        new = {}
        for v in verts:
            if not nb[v]:
                new[v] = lab[v]
                continue
            c = Counter()
            for u, x in nb[v]:
                c[lab[u]] += x
            best = max(c.values())
            new[v] = min(l for l, n in c.items() if n == best)
        lab = new
    return lab


def brute_cc(verts, edges):
    parent = {v: v for v in verts}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x
    for a, b in edges:
        ra, rb = find(a), find(b)
        parent[max(ra, rb)] = min(ra, rb)
    return {v: find(v) for v in verts}


@pytest.mark.parametrize("rounds", [1, 2, 5])
def test_label_propagation_matches_brute_force(spark, rounds):
    v, e = graph(spark)
    got = {r.id: r.label for r in gr.label_propagation(v, e, rounds).collect()}
    assert got == brute_lp(VERTS, EDGES, rounds)
    assert got[1] == 1                                  # isolated vertex keeps its label
    assert {got[2], got[3]} == {2, 3}                   # isolated edge swaps each round


def test_weighted_propagation(spark):
    w = {(13, 14): 5.0}
    v, e = graph(spark, w=w)
    got = {r.id: r.label for r in gr.label_propagation(v, e, 3, weighted=True).collect()}
    assert got == brute_lp(VERTS, EDGES, 3, w)


def test_connected_components(spark):
    v, e = graph(spark)
    got = {r.id: r.component for r in gr.connected_components(v, e).collect()}
    assert got == brute_cc(VERTS, EDGES)


def test_components_long_path(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, 50), (50, 70)]
    verts = list(range(1, 41)) + [50, 70, 100]
    v, e = graph(spark, edges, verts)
    got = {r.id: r.component for r in gr.connected_components(v, e).collect()}
    assert got == brute_cc(verts, edges)


def test_same_result_under_many_partitions(spark):
    v, e = graph(spark)
    a = sorted(gr.label_propagation(v.repartition(1), e.repartition(1), 4).collect())
    b = sorted(gr.label_propagation(v.repartition(13), e.repartition(13), 4).collect())
    assert a == b


def brute_q(edges, lab, w=None):
    m = sum((w or {}).get(x, 1.0) for x in edges)
    deg, inside = Counter(), Counter()
    for a, b in edges:
        x = (w or {}).get((a, b), 1.0)
        deg[lab[a]] += x
        deg[lab[b]] += x
        if lab[a] == lab[b]:
            inside[lab[a]] += x
    return sum(inside[c] / m - (deg[c] / (2 * m)) ** 2 for c in deg)


def test_modularity_and_louvain(spark):
    v, e = graph(spark)
    lab = {i: (i - 1) // 4 for i in VERTS}
    labels = spark.createDataFrame(list(lab.items()), "id long, label long")
    q = gr.modularity(e, labels).first()[0]
    assert abs(q - brute_q(EDGES, lab)) < 1e-6
    comm = {r.id: r.label for r in lv.louvain(v, e).collect()}
    assert set(comm) == set(VERTS)
    assert brute_q(EDGES, comm) >= brute_q(EDGES, {i: i for i in VERTS})
    # the two joined triangles end up as two communities, the 4-cycle as one
    assert comm[11] == comm[12] == comm[13] and comm[14] == comm[15] == comm[16]
    assert comm[7] == comm[8] == comm[9] == comm[10]


def test_dense_labels_and_merge(spark):
    labels = spark.createDataFrame([(1, 10), (2, 10), (3, 7), (4, 42)], "id long, label long")
    got = {r.id: r.label for r in gr.dense_labels(labels).collect()}
    assert got == {1: 1, 2: 1, 3: 0, 4: 2}
    edges = spark.createDataFrame([(1, 3, 0.5), (2, 3, 0.9), (3, 4, 0.2)], "src long, dst long, weight double")
    small = spark.createDataFrame([(1, 1), (2, 1), (3, 3), (4, 4)], "id long, label long")
    merged = {r.id: r.label for r in gr.merge_small_communities(small, edges, 2).collect()}
    # community 3 (one member) links to 1 with 1.4 and to 4 with 0.2; community 4 links only to 3
    assert merged == {1: 1, 2: 1, 3: 1, 4: 3}


def test_dense_index_matches_dense_rank(spark):
    from pyspark.sql import functions as F
    from labelnet.util import dense_index
    names = [f"n{i % 37:03d}" for i in range(500)]
    df = spark.createDataFrame([(n,) for n in names], "name string").repartition(9)
    got = {r.name: r.k for r in dense_index(df, "name", "k", start=1).collect()}
    want = {n: i + 1 for i, n in enumerate(sorted(set(names)))}
    assert got == want


def test_components_on_still_edges(spark):
    import random
    rng = random.Random(9)
    path = [(i, i + 1) for i in range(100, 130)]                     # long, in shuffled order of ids
    ids = list(range(100, 131))
    rng.shuffle(ids)
    path = [(ids[a - 100], ids[b - 100]) for a, b in path]
    hub = [(200, 200 + i) for i in range(1, 60)]
    loose = [(300 + rng.randrange(80), 300 + rng.randrange(80)) for _ in range(45)]
    edges = EDGES + path + hub + loose
    verts = VERTS + list(range(100, 131)) + list(range(200, 260)) + list(range(300, 380))
    v, e = graph(spark, edges, verts)
    assert {r.id: r.component for r in gr.components(v, e).collect()} == brute_cc(verts, edges)
    adj = adjacency.build(gr.undirected(e.where("src <> dst")), arc=7)           # the hub has parts
    assert adj.hubs.count() >= 1 and adj.table.agg(F.max(F.size("nbrs"))).first()[0] < 59
    assert {r.id: r.component for r in adjacency.components(v, adj).collect()} == brute_cc(verts, edges)
    lp = {r.id: r.label for r in adjacency.propagate(v, adj, 3, False).collect()}
    assert lp == brute_lp(verts, [x for x in edges if x[0] != x[1]], 3)
    adjacency.drop(adj)
    assert gr.components(v, e.limit(0)).where("id <> component").count() == 0 and gr.components(v.limit(0), e.limit(0)).count() == 0


def test_a_round_moves_labels_and_no_edges(spark):
    v, e = graph(spark)
    adj = adjacency.build(gr.undirected(e))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        labels = adjacency.with_parts(v.select("id"), adj).withColumn("label", F.col("id"))
        labels = spark.createDataFrame(labels.collect(), labels.schema)
        plan = adjacency.messages(labels, adj, "label")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "ShuffledHashJoin" in plan and plan.count("Exchange") == 1            # the labels'; the edge scan lies under none
    left = plan[plan.index("ShuffledHashJoin"):plan.index("Exchange")]
    assert adj.name in left or "Bucketed: true" in left
    adjacency.drop(adj)


def test_split_communities_parts_what_is_not_connected(spark):
    v, e = graph(spark)
    labels = v.select("id", F.when(F.col("id") <= 6, 1).otherwise(F.when(F.col("id").isin(11, 12, 15, 16), 2).otherwise(3)).cast("long").alias("label"))
    got = {r.id: r.label for r in gr.split_communities(labels, e).collect()}
    assert got == {1: 1, 2: 2, 3: 2, 4: 4, 5: 4, 6: 4, 7: 7, 8: 7, 9: 7, 10: 7, 11: 11, 12: 11, 13: 13, 14: 13, 15: 15, 16: 15}
