from collections import Counter
from itertools import combinations

import numpy as np
from pyspark.sql import functions as F
import pytest

from labelnet.operators import cooc


def brute(rows):
    posts = {}
    for p, t in rows:
        posts.setdefault(p, set()).add(t)
    c = Counter()
    for ts in posts.values():
        for a, b in combinations(sorted(ts), 2):
            c[(a, b)] += 1
    return dict(c)


@pytest.mark.parametrize("tag_block,rows_per_chunk", [(256, 20000), (3, 7), (1, 1000)])
def test_cooccurrence_equals_brute_force(spark, tag_block, rows_per_chunk):
    rng = np.random.default_rng(11)
    tags = [f"t{i:02d}" for i in range(12)]
    rows = [(int(rng.integers(0, 40)), tags[int(rng.integers(0, 12))]) for _ in range(150)]
    rows += [(999, t) for t in tags] * 2          # one hot post carrying every tag, duplicated
    df = spark.createDataFrame(rows, "post_id long, tag string")
    got = {(r.tag_a, r.tag_b): r.n for r in cooc.cooccurrence(df, tag_block, rows_per_chunk).collect()}
    assert got == brute(rows)


def test_rows_are_copied_to_their_posts_blocks_only(spark):
    rows = [(1, 0), (1, 1), (1, 9), (2, 5), (3, 0), (3, 3), (3, 6), (3, 9)]
    x = spark.createDataFrame(rows, "post_id long, t long")
    copies = Counter((r.post_id, r.t) for r in cooc.gram_copies(x, 3).collect())
    assert copies == {(p, t): len({u // 3 for q, u in rows if q == p}) for p, t in rows}


def test_usage_trend(spark):
    import datetime as dt
    rows = [(dt.datetime(2024, 1, 1, 5), "a"), (dt.datetime(2024, 1, 1, 23), "a"), (dt.datetime(2024, 1, 2, 0), "a")]
    df = spark.createDataFrame(rows, cooc.usage_schema())
    got = sorted((r.window_start.day, r.tag, r.n) for r in cooc.usage_trend(df).collect())
    assert got == [(1, "a", 2), (2, "a", 1)]


def test_usage_stream_matches_batch(spark, tmp_path):
    import datetime as dt
    from pyspark.sql import functions as F
    from labelnet.streaming import usage
    rows = [(i, dt.datetime(2024, 1, 1 + i % 3, i % 24), 7, ["a", "b"][i % 2], 1.0, "{}") for i in range(40)]
    src = spark.createDataFrame(rows, usage.EVENTS)
    src.where(F.col("event_id") < 20).coalesce(1).write.parquet(str(tmp_path / "part1"))
    src.where(F.col("event_id") >= 20).coalesce(1).write.parquet(str(tmp_path / "part2"))
    # two input files arrive as two micro-batches
    import glob
    import shutil
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    for i, f in enumerate(sorted(glob.glob(str(tmp_path / "part*" / "*.parquet")))):
        shutil.copy(f, inbox / f"events-{i}.parquet")
    out = usage.run_usage_stream(spark, str(inbox))
    got = sorted((r.window_start, r.tag, r.n) for r in usage.latest_counts(spark, out).collect())
    want = sorted((r.window_start, r.tag, r.n) for r in cooc.usage_trend(src.select("ts", F.col("event_type").alias("tag"))).collect())
    assert got == want


def test_usage_stream_takes_late_files_and_repeated_batches(spark, tmp_path):
    import datetime as dt
    import glob
    import shutil
    from labelnet.streaming import usage
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    frames = []
    for i, day in enumerate((20, 2, 3)):                 # the first file is the latest in time
        rows = [(j, dt.datetime(2024, 1, day, j % 24), 7, "a", 1.0, "{}") for j in range(4 + i)]
        f = spark.createDataFrame(rows, usage.EVENTS)
        frames.append(f)
        f.coalesce(1).write.parquet(str(tmp_path / f"p{i}"))
        shutil.copy(glob.glob(str(tmp_path / f"p{i}" / "*.parquet"))[0], inbox / f"events-{i}.parquet")
    every = frames[0].union(frames[1]).union(frames[2])
    want = sorted(tuple(r) for r in cooc.usage_trend(every.select("ts", F.col("event_type").alias("tag"))).collect())
    out = usage.run_usage_stream(spark, str(inbox), out=str(tmp_path / "out"), checkpoint=str(tmp_path / "c1"))
    assert sorted(tuple(r) for r in usage.latest_counts(spark, out).collect()) == want
    # all batches once more, as after a lost commit: each replaces itself
    usage.run_usage_stream(spark, str(inbox), out=out, checkpoint=str(tmp_path / "c2"))
    assert sorted(tuple(r) for r in usage.latest_counts(spark, out).collect()) == want


def test_same_results_under_1_and_50_shuffle_partitions(spark):
    from labelnet.operators import features as fe
    from labelnet.operators import graph as gr
    from labelnet.operators import similarity as sim
    rng = np.random.default_rng(5)
    vec_rows = [(int(i), [float(x) for x in rng.random(8) * (rng.random(8) > 0.5)]) for i in range(60)]
    basket_rows = [(int(rng.integers(0, 30)), f"t{int(rng.integers(0, 9))}") for _ in range(120)]
    old = spark.conf.get("spark.sql.shuffle.partitions")
    results = []
    try:
        for parts in ("1", "50"):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            vecs = fe.array_to_sparse(spark.createDataFrame(vec_rows, "tag_id long, vector array<double>"))
            e = sim.similar_pairs(vecs, "tag_id", 8, 0.5, block_rows=7)
            v = vecs.select(F.col("tag_id").alias("id"))
            lab = sorted(tuple(r) for r in gr.label_propagation(v, e, 3).collect())
            edges = sorted((r.src, r.dst, round(r.weight, 9)) for r in e.collect())
            co = sorted(tuple(r) for r in cooc.cooccurrence(
                spark.createDataFrame(basket_rows, "post_id long, tag string"), 4, 25).collect())
            results.append((edges, lab, co))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert results[0] == results[1]


def test_usage_stream_reads_a_table_that_is_a_folder(spark, tmp_path):
    import datetime as dt
    from labelnet.streaming import usage
    rows = [(i, dt.datetime(2024, 1, 1 + i % 3, i % 24), 7, "ab"[i % 2], 1.0, "{}") for i in range(30)]
    src = spark.createDataFrame(rows, usage.EVENTS)
    src.repartition(3).write.parquet(str(tmp_path / "events.parquet"))
    src.coalesce(1).write.parquet(str(tmp_path / "other_events.parquet"))
    out = usage.run_usage_stream(spark, str(tmp_path), "events.parquet")
    want = sorted(tuple(r) for r in cooc.usage_trend(src.select("ts", F.col("event_type").alias("tag"))).collect())
    assert sorted(tuple(r) for r in usage.latest_counts(spark, out).collect()) == want
    (tmp_path / "none" / "events.parquet").mkdir(parents=True)
    assert usage.latest_counts(spark, usage.run_usage_stream(spark, str(tmp_path / "none"), "events.parquet")).count() == 0
