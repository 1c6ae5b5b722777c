import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from labelnet.operators import candidates as cand
from labelnet.util import spread_rank

from .test_similarity import arrays, brute_cos


def clustered(n=240, dim=16, seed=5):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((12, dim))
    return {i: centres[i % 12] + rng.standard_normal(dim) * 0.45 for i in range(n)}


def found(df):
    rows = [(r.src, r.dst, r.weight) for r in df.collect()]
    assert max(Counter((a, b) for a, b, _ in rows).values(), default=1) == 1      # a pair is given once
    return {(a, b): w for a, b, w in rows}


def test_bands_follow_from_the_recall():
    bands = cand.bands_for(0.5, 4, 0.9)                    # a sign agrees with probability 2/3 at 60 degrees
    assert 1 - (1 - (2 / 3) ** 4) ** bands >= 0.9 > 1 - (1 - (2 / 3) ** 4) ** (bands - 1)
    assert cand.bits_for(10) == 1 and cand.bits_for(256 * 1024) == 10
    with pytest.raises(ValueError):
        cand.bands_for(0.0, 4, 0.9)


@pytest.mark.parametrize("bits,tile_rows", [(6, 2048), (6, 7), (3, 2048)])
def test_recall_and_exact_weights(spark, bits, tile_rows):
    vecs = clustered()
    t = 0.6
    want = {p: c for p, c in brute_cos(vecs).items() if p[0] < p[1] and c > t}
    got = found(cand.banded_pairs(arrays(spark, vecs), "tag_id", 16, t, recall=0.95, bits=bits, tile_rows=tile_rows))
    assert set(got) <= set(want) and all(math.isclose(w, want[p], abs_tol=1e-9) for p, w in got.items())
    assert len(got) >= 0.9 * len(want)


def test_tiles_of_a_large_bucket_lose_nothing(spark):
    vecs = clustered(60)
    vecs |= {i: np.ones(16) for i in range(1000, 1060)}    # one bucket in each band
    whole = found(cand.banded_pairs(arrays(spark, vecs), "tag_id", 16, 0.6, bits=5))
    tiled = found(cand.banded_pairs(arrays(spark, vecs), "tag_id", 16, 0.6, bits=5, tile_rows=4))
    assert set(whole) == set(tiled)
    assert sum(a >= 1000 for a, b in tiled) == 60 * 59 // 2


def test_zero_vectors_empty_table_and_one_row(spark):
    vecs = {1: [0, 0, 0], 2: [1, 2, 0], 3: [1, 2, 0], 4: [0, 0, 5]}
    assert set(found(cand.banded_pairs(arrays(spark, vecs), "tag_id", 3, 0.5))) == {(2, 3)}
    for few in (F.lit(False), F.col("tag_id") == 2):
        assert not found(cand.banded_pairs(arrays(spark, vecs).where(few), "tag_id", 3, 0.5))


def test_spread_rank_equals_the_window(spark):
    rng = np.random.default_rng(1)
    rows = [(None if i % 11 == 0 else 7 if i % 3 else i % 5, round(float(rng.random()), 1), i) for i in range(3000)]
    d = spark.createDataFrame(rows, "k long, s double, o long")
    got = spread_rank(d, ["k"], [F.desc("s"), F.asc("o")], parts=6).collect()
    assert len(got) == len(rows)
    for k in {r[0] for r in rows}:
        order = sorted((r for r in rows if r[0] == k), key=lambda r: (-r[1], r[2]))
        assert [r.o for r in sorted((g for g in got if g.k == k), key=lambda g: g["rank"])] == [r[2] for r in order]
        assert sorted(g["rank"] for g in got if g.k == k) == list(range(1, len(order) + 1))


def test_spread_rank_deals_a_hot_key_over_tasks(spark):
    d = spark.range(20000).select(F.lit(1).alias("k"), F.xxhash64("id").alias("s"), "id")
    spread_rank(d, ["k"], [F.asc("s"), F.asc("id")], parts=8)
    dealt = d.repartitionByRange(8, "k", F.asc("s"), F.asc("id")).groupBy(F.spark_partition_id()).count()
    assert dealt.agg(F.max("count")).first()[0] < 20000 / 4
    assert spread_rank(d.where("id < 0"), ["k"], [F.asc("s")]).count() == 0


def test_ranking_of_requested_tags(spark):
    from labelnet.plans import flows as pl
    lv = pl.label_vectors(spark, "/root/testdata/sf0.001", 200)
    tags = [(r.id, r.tag_name) for r in lv.tags.select("id", "tag_name").collect()]
    whole = {(r.tag_id, r["rank"]): (r.neighbour_id, r.sim) for r in pl.tag_ranking(lv).collect()}
    assert len(whole) == len(tags) ** 2
    old = {(r.tag_id, r["rank"]): (r.neighbour_id, r.sim) for r in pl.tag_neighbours(lv, None).collect()}
    assert whole == old
    asked = spark.createDataFrame([(tags[0][1],), (tags[0][1],), (tags[3][1],), ("no such tag",), (None,)], "tag_name string")
    got = {(r.tag_id, r["rank"]): (r.neighbour_id, r.sim) for r in pl.tag_ranking(lv, asked).collect()}
    assert got == {k: v for k, v in whole.items() if k[0] in (tags[0][0], tags[3][0])}


def test_rows_are_dealt_by_blocks_and_not_by_bands(spark):
    vecs = clustered(300)
    plans, got = [], []
    for recall in (0.5, 0.99):                             # many more bands, no more rows in the tiles
        df = cand.banded_pairs(arrays(spark, vecs), "tag_id", 16, 0.6, recall=recall, bits=6, tile_rows=100)
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        got.append(found(df))
    assert all("posexplode" not in p and "band" not in p.replace("banded", "") for p in plans)
    assert set(got[0]) < set(got[1])
    bits = cand.bits_for(300)                              # every pair over the threshold that shares a bucket, and no other
    bands = cand.bands_for(0.6, bits, 0.5)
    code = {r.id: r.codes for r in cand.with_codes(arrays(spark, vecs).selectExpr("tag_id as id", "idxs", "vals"), 16, bits, bands).collect()}
    want = {p for p, c in brute_cos(vecs).items() if p[0] < p[1] and c > 0.6 and any(x == y for x, y in zip(code[p[0]], code[p[1]]))}
    assert set(found(cand.banded_pairs(arrays(spark, vecs), "tag_id", 16, 0.6, recall=0.5, tile_rows=70))) == want


def test_only_vectors_move_to_the_tiles(spark):
    vecs = {i: np.round(x * 64) / 64 for i, x in clustered(120).items()} | {500: np.zeros(16)}    # as floats hold them
    thirds = {i: x / 3 for i, x in vecs.items()}
    found_in = []
    for rows, kind in ((vecs, "array<float>"), (thirds, "array<double>")):
        df = cand.banded_pairs(arrays(spark, rows), "tag_id", 16, 0.6, recall=0.95, bits=4, tile_rows=50)
        plan = df._jdf.queryExecution().optimizedPlan()
        while plan.nodeName() != "RepartitionByExpression":
            plan = plan.children().apply(0)
        sent = {x.name(): x.dataType().simpleString() for x in (plan.output().apply(i) for i in range(plan.output().size()))}
        assert sent["vals"] == kind and "codes" not in sent
        found_in.append(found(df))
    want = {p: c for p, c in brute_cos(vecs).items() if p[0] < p[1] and c > 0.6}
    assert set(found_in[0]) == set(found_in[1]) <= set(want) and len(found_in[0]) >= 0.9 * len(want)
    assert all(math.isclose(w, want[p], abs_tol=1e-12) for x in found_in for p, w in x.items())


def test_codes_of_many_bits_and_ready_unit_vectors(spark):
    vecs = clustered(60)
    unit = {i: x / np.linalg.norm(x) for i, x in vecs.items()}
    a, b = (found(cand.banded_pairs(arrays(spark, x), "tag_id", 16, 0.6, bits=18, recall=0.6, normalized=n)) for x, n in ((vecs, False), (unit, True)))
    assert set(a) == set(b) and a
