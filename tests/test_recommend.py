from labelnet.plans import flows as pl

from .test_graph import graph


def test_recommend_same_community_heaviest_first(spark):
    v = spark.createDataFrame([(i, str(i)) for i in range(1, 7)], "id long, name string")
    e = spark.createDataFrame([(1, 2, 0.9), (1, 3, 0.7), (1, 4, 0.95), (2, 3, 0.7), (5, 6, 0.6)],
                              "src long, dst long, weight double")
    labels = spark.createDataFrame([(1, 1), (2, 1), (3, 1), (4, 4), (5, 5), (6, 5)], "id long, label long")
    recs = pl.recommend(v, e, labels, k=10)
    got = {(r.tag_id, r.rank): r.rec_id for r in recs.collect()}
    assert got[(1, 1)] == 2 and got[(1, 2)] == 3        # 4 is heavier but in another community
    assert (4, 1) not in got                            # alone in its community: nothing
    assert got[(2, 1)] == 1


def test_precision_at_k_edge_cases(spark):
    recs = spark.createDataFrame(
        [(1, 1, 2), (1, 2, 3), (1, 3, 9), (2, 1, 1)],      # tag 1: 3 returned, 2 relevant; tag 2: 1 of 1
        "tag_id long, rank int, rec_id long")
    truth = spark.createDataFrame([(1, "a"), (2, "a"), (3, "a"), (9, "b"), (4, "a")], "tag_id long, key string")
    row = pl.precision_at_k(recs, truth, 5).first()
    # tag 1: 2/3, tag 2: 1/1, tags 3, 9, 4: nothing returned -> 0
    assert row.n_tags == 5
    assert abs(row.precision - round((2 / 3 + 1) / 5, 6)) < 1e-9


def test_recommend_on_propagated_labels(spark):
    v, e = graph(spark)
    from labelnet.operators import graph as gr
    labels = gr.label_propagation(v, e, 5)
    recs = pl.recommend(v, e, labels, 10)
    lab = {r.id: r.label for r in labels.collect()}
    for r in recs.collect():
        assert lab[r.tag_id] == lab[r.rec_id]


def test_recommend_for_requests_unknown_name(spark):
    v = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id long, name string")
    e = spark.createDataFrame([(1, 2, 0.9), (2, 3, 0.8)], "src long, dst long, weight double")
    labels = spark.createDataFrame([(1, 1), (2, 1), (3, 1)], "id long, label long")
    recs = pl.recommend(v, e, labels, 10)
    req = spark.createDataFrame([("b",), ("zzz",)], "tag_name string")
    got = [(r.tag_name, r.rank, r.rec_name) for r in pl.recommend_for(req, v, recs).orderBy("rank").collect()]
    assert got == [("b", 1, "a"), ("b", 2, "c")]


def test_precision_with_truth_pairs(spark):
    recs = spark.createDataFrame([(1, 1, 2), (1, 2, 3), (1, 3, 9), (2, 1, 1)], "tag_id long, rank int, rec_id long")
    truth = spark.createDataFrame([(1, 2), (1, 3), (1, 3), (2, 5), (4, 1)], "tag_id long, relevant_id long")
    row = pl.precision_at_k_pairs(recs, truth, 5).first()
    # tag 1: 2 of 3; tag 2: 0 of 1; tag 4: nothing returned
    assert row.n_tags == 3 and abs(row.precision - round((2 / 3) / 3, 6)) < 1e-9


def test_readers_take_uris(spark):
    from labelnet.sources import io
    df = io.read_table(spark, "parquet", "file:///root/testdata/sf0.001/part.parquet")
    assert df.count() > 0
