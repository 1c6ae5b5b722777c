import random

import pytest
from pyspark.sql import functions as F

from labelnet.operators import inverted as inv
from labelnet.plans import flows as pl


def vectors(n, dim, seed, zipf=True):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        for j in rng.sample(range(dim), rng.randint(1, dim // 3)):
            out.append((i, j, round(rng.random() * (8 / (1 + j) if zipf else 1) + 0.01, 3)))
    return out


def brute(queries, rows, k):
    def units(v):
        norm, by = {}, {}
        for i, j, w in v:
            norm[i] = norm.get(i, 0) + w * w
            by.setdefault(i, {})[j] = w
        return {i: {j: w / norm[i] ** 0.5 for j, w in x.items()} for i, x in by.items()}
    a, b, out = units(queries), units(rows), {}
    for i, x in a.items():
        s = [(-round(sum(w * y.get(j, 0) for j, w in x.items()), 6), r) for r, y in b.items() if set(x) & set(y)]
        out[i] = [(r, -v) for v, r in sorted(s)[:k]]
    return out


@pytest.mark.parametrize("k,heads,per_shard", [(3, 4, 200_000), (10, 1, 7), (50, 4, 200_000)])
def test_top_k_is_brute_force(spark, monkeypatch, k, heads, per_shard):
    monkeypatch.setattr(inv, "PER_SHARD", per_shard)
    rows, queries = vectors(60, 40, 1), vectors(40, 40, 2)
    queries += [(900, 39, 1.0), (901, 77, 2.0)]              # a term in few rows, a term in none
    rows += [(100 + i, 5, 1.0 + i) for i in range(5)]         # equal at unit length: ties go to the smaller id
    index = inv.build(spark.createDataFrame(rows, "tag_id long, idx int, w double"), "tag_id", 40)
    assert (index.shards > 1) == (per_shard == 7)
    got = inv.top_k(spark.createDataFrame(queries, "p long, idx int, w double"), ["p"], index, k, heads)
    out = {}
    for r in pl.ranked(got, ["p"], "row", "score", k).orderBy("p", "rank").collect():
        out.setdefault(r.p, []).append((r.row, round(r.score, 6)))
    want = {i: x for i, x in brute(queries, rows, k).items() if x}
    assert set(out) == set(want)
    for i in want:
        assert [r for r, _ in out[i]] == [r for r, _ in want[i]] and all(abs(a - b) < 2e-6 for (_, a), (_, b) in zip(out[i], want[i]))


def test_pruning_opens_fewer_postings(spark):
    """A frequent term of small weight is a tail: rows that share nothing else are never scored."""
    rows = [(i, 0, 0.05) for i in range(300)] + [(i, 1 + i % 40, 1.0) for i in range(300)]
    index = inv.build(spark.createDataFrame(rows, "tag_id long, idx int, w double"), "tag_id", 50)
    q = spark.createDataFrame([(1, 0, 0.05), (1, 7, 1.0), (1, 8, 0.9)], "p long, idx int, w double")
    got = inv.top_k(q, ["p"], index, 5).select("row", "score").collect()
    assert len(got) <= 20 and min(r.score for r in got) > 0.5


def test_padding_and_saved_model(spark, tmp_path):
    tags = spark.createDataFrame([(i, f"t{i}") for i in range(1, 8)], "tag_id long, tag_name string")
    index = inv.build(spark.createDataFrame([(2, 0, 1.0), (5, 0, 1.0), (5, 1, 2.0)], "tag_id long, idx int, w double"), "tag_id", 2)
    vocab = spark.createDataFrame([("apple", 0, 1.0), ("pear", 1, 2.0)], "term string, idx int, idf double")
    model = pl.TaggingModel(vocab, 2, tags, index)
    posts = spark.createDataFrame([(1, "apple"), (2, "pear apple"), (3, "nothing known"), (4, None)], "p long, body string")

    def rows(m, pad):
        out = {}
        for r in pl.suggest_tags(posts, ["p"], m, 4, pad).orderBy("p", "rank").collect():
            out.setdefault(r.p, []).append((r["rank"], r.tag_id, r.sim > 0))
        return out
    plain = {1: [(1, 2, True), (2, 5, True)], 2: [(1, 5, True), (2, 2, True)]}
    assert rows(model, False) == plain
    pads = lambda have, ids: have + [(len(have) + 1 + i, t, False) for i, t in enumerate(ids)]
    assert rows(model, True) == {1: pads(plain[1], [1, 3]), 2: pads(plain[2], [1, 3]), 3: pads([], [1, 2, 3, 4]), 4: pads([], [1, 2, 3, 4])}
    pl.save_model(model, str(tmp_path / "m"))
    assert rows(pl.load_model(spark, str(tmp_path / "m")), False) == plain


@pytest.mark.parametrize("folder", [True, False])
def test_tagging_stream_of_a_folder_or_a_file_is_the_batch(spark, tmp_path, folder):
    import glob
    import shutil
    from labelnet.streaming import tagging
    model = pl.fe.TfidfModel(spark.createDataFrame([("apple", 0, 1.0), ("pear", 1, 1.0)], "term string, idx int, idf double"), 2)
    vecs = spark.createDataFrame([(1, 0, 1.0), (2, 1, 1.0)], "tag_id long, idx int, w double")
    tags = spark.createDataFrame([(1, "a"), (2, "b")], "id long, tag_name string")
    turns = [(i, 0, "user" if i % 3 else "assistant", "apple pear" if i % 2 else "pear") for i in range(12)]
    df = spark.createDataFrame(turns, tagging.CONVERSATIONS)
    lv = pl.LabelVectors(vecs, tags, model, None, None)
    where = tmp_path / "conversations.parquet"
    if folder:
        df.repartition(2).write.parquet(str(where))
    else:
        df.coalesce(1).write.parquet(str(tmp_path / "one"))
        shutil.copy(glob.glob(str(tmp_path / "one" / "*.parquet"))[0], where)
    got = spark.read.parquet(tagging.run_tagging_stream(spark, str(tmp_path), lv, 2, "conversations.parquet")).drop("batch_id")
    posts = df.where("role = 'user'").select("conv_id", "turn", F.col("text").alias("body"))
    want = pl.suggest_tags(posts, ["conv_id", "turn"], pl.tagging_model(lv), 2).select(*got.columns)
    assert sorted(tuple(r) for r in got.collect()) == sorted(tuple(r) for r in want.collect()) != []
