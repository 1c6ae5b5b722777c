import numpy as np
import pytest
from pyspark.sql import functions as F

from labelnet.operators import features as fe
from labelnet.operators import similarity as sim


def arrays(spark, vecs):
    rows = [(i, [float(x) for x in v]) for i, v in vecs.items()]
    df = spark.createDataFrame(rows, "tag_id long, vector array<double>")
    return fe.array_to_sparse(df)


def brute_cos(vecs):
    out = {}
    ids = sorted(vecs)
    for a in ids:
        for b in ids:
            x, y = np.asarray(vecs[a], float), np.asarray(vecs[b], float)
            d = np.linalg.norm(x) * np.linalg.norm(y)
            out[(a, b)] = 0.0 if d == 0 else float(x @ y / d)
    return out


TINY = {1: [0, 0, 0], 2: [1, 2, 0], 3: [1, 2, 0], 4: [0, 0, 5], 5: [1, 1, 0], 6: [1, 0, 0]}


def test_cosine_expression(spark):
    df = spark.createDataFrame([([1.0, 0.0], [0.0, 0.0]), ([1.0, 1.0], [2.0, 2.0]), ([1.0, 0.0], [0.0, 1.0])],
                               "a array<double>, b array<double>")
    got = [r.c for r in df.select(sim.cosine(F.col("a"), F.col("b")).alias("c")).collect()]
    assert got[0] == 0.0 and abs(got[1] - 1.0) < 1e-12 and got[2] == 0.0


@pytest.mark.parametrize("inclusive,rows", [(False, 2), (True, 2), (False, None), (True, None)])
def test_threshold_strict_or_inclusive(spark, inclusive, rows):
    # cos(5, 6) = 1/sqrt(2) exactly on the threshold
    t = float(np.float64(1.0) / np.sqrt(2.0))
    e = sim.similar_pairs(arrays(spark, TINY), "tag_id", 3, t, inclusive=inclusive, block_rows=rows)
    got = {(r.src, r.dst) for r in e.collect()}
    bf = brute_cos(TINY)
    want = {(a, b) for (a, b), c in bf.items() if a < b and (c >= t if inclusive else c > t)}
    assert got == want
    assert (2, 3) in got                      # identical pair
    assert all(1 not in p for p in got)       # zero vector never links


@pytest.mark.parametrize("block_rows", [0.02, 1, 3, 1000, None])     # 0.02: 50 blocks for each row, so nearly all are empty
def test_tiles_equal_brute_force(spark, block_rows):
    rng = np.random.default_rng(7)
    n = 6 if block_rows == 0.02 else 40
    vecs = {int(i): rng.random(6) * (rng.random(6) > 0.4) for i in range(n)}
    e = sim.similar_pairs(arrays(spark, vecs), "tag_id", 6, 0.6, block_rows=block_rows)
    rows = [(r.src, r.dst, r.weight) for r in e.collect()]
    bf = brute_cos(vecs)
    want = {(a, b): c for (a, b), c in bf.items() if a < b and c > 0.6}
    assert sorted((a, b) for a, b, _ in rows) == sorted(want)          # as a list: no pair twice
    assert all(abs(w - want[a, b]) < 1e-9 for a, b, w in rows)


@pytest.mark.parametrize("block_rows", [2, 1000, None])
def test_block_scores_topk(spark, block_rows):
    rng = np.random.default_rng(3)
    left = {int(i): rng.random(5) for i in range(12)}
    right = {int(i): rng.random(5) for i in range(100, 130)}
    L = arrays(spark, left).withColumnRenamed("tag_id", "q")
    R = arrays(spark, right).withColumnRenamed("tag_id", "o")
    sc = sim.block_scores(L, R, ["q"], ["o"], 5, top_k=3, block_rows=block_rows)
    from labelnet.plans.flows import ranked
    rows = ranked(sc, ["q"], "o", "score", 3).collect()
    got = {(r.q, r.rank): r.o for r in rows}
    assert len(rows) == len(got) == 36
    allv = {**left, **right}
    bf = brute_cos(allv)
    for q in left:
        order = sorted(right, key=lambda o: (-round(bf[(q, o)], 6), o))[:3]
        assert [got[(q, k)] for k in (1, 2, 3)] == order


@pytest.mark.parametrize("block_rows", [1, 1000])
def test_topk_keeps_scores_that_round_alike(spark, block_rows):
    # cosines 0.5000002 (id 10) and 0.5000004 (id 11) round to the same six places: the smaller id is first
    def unit(c):
        return [c, float(np.sqrt(1 - c * c))]
    L = arrays(spark, {1: [1.0, 0.0]}).withColumnRenamed("tag_id", "q")
    R = arrays(spark, {10: unit(0.5000002), 11: unit(0.5000004), 12: unit(0.4)}).withColumnRenamed("tag_id", "o")
    sc = sim.block_scores(L, R, ["q"], ["o"], 2, top_k=1, block_rows=block_rows)
    from labelnet.plans.flows import ranked
    assert [r.o for r in ranked(sc, ["q"], "o", "score", 1).collect()] == [10]


def test_blocks_follow_dimension_rows_and_tasks():
    for dim in (64, 1000, 1_000_000):
        assert sim.block_rows_for(dim) * 8 * dim <= sim.BLOCK_BYTES
    assert sim.num_blocks(0, 64, 100) == 1
    assert sim.num_blocks(10 ** 7, 1000, 8) >= 10 ** 7 / sim.block_rows_for(1000)
    assert sim.num_blocks(2000, 64, 8) == 8
    assert all((p.stop - p.start) * 500_000 * 8 <= sim.BLOCK_BYTES for p in sim._slices(1000, 500_000))


def test_pairs_go_out_slice_by_slice(spark, monkeypatch):
    monkeypatch.setattr(sim, "PAIR_SLICE_BYTES", 100)      # one row of a tile at a time
    rng = np.random.default_rng(5)
    vecs = {int(i): rng.random(6) for i in range(30)}
    e = sim.similar_pairs(arrays(spark, vecs), "tag_id", 6, 0.8, block_rows=15)
    bf = brute_cos(vecs)
    assert sorted((r.src, r.dst) for r in e.collect()) == sorted((a, b) for (a, b), c in bf.items() if a < b and c > 0.8)
    assert [p.stop - p.start for p in sim._slices(3, 12, 100)] == [1, 1, 1]


def test_vectors_go_to_the_tiles_as_floats_if_these_hold_them(spark):
    rng = np.random.default_rng(3)
    vecs = {i: np.round(rng.standard_normal(6) * 64) / 64 for i in range(40)} | {90: np.zeros(6)}
    for rows, kind in ((vecs, "array<float>"), ({i: x / 3 for i, x in vecs.items()}, "array<double>")):
        e = sim.similar_pairs(arrays(spark, rows), "tag_id", 6, 0.3, block_rows=15)
        plan = e._jdf.queryExecution().optimizedPlan()
        while plan.nodeName() != "RepartitionByExpression":
            plan = plan.children().apply(0)
        assert kind in [x.dataType().simpleString() for x in (plan.output().apply(i) for i in range(plan.output().size())) if x.name() == "vals"]
        got = {(r.src, r.dst): r.weight for r in e.collect()}
        want = {p: c for p, c in brute_cos(rows).items() if p[0] < p[1] and c > 0.3}
        assert set(got) == set(want) and all(abs(got[p] - want[p]) < 1e-12 for p in want)
