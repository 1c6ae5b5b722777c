from pyspark.sql import functions as F

from labelnet.operators import relate as rl
from labelnet.sources import io

POSTS = [
    (1, "t1", "b1", None, None, 1),
    (2, "t2", "b2", "", None, 0),
    (3, "t3", "b3", "java", None, None),
    (10, "  ", None, "java|spring|jvm", None, 1),
]
TAGS = [(1, "java", 100, None, None), (2, "spring", 5, 7, None), (3, "unused", 1, None, None)]


def frames(spark):
    p = spark.createDataFrame(POSTS, "id long, title string, body string, tags string, parent_id long, score int")
    t = spark.createDataFrame(TAGS, "id long, tag_name string, count long, excerpt_post_id long, wiki_post_id long")
    return p, t


def test_tagged_posts_drop_null_and_empty(spark):
    p, _ = frames(spark)
    assert sorted(r.id for r in rl.tagged_posts(p).collect()) == [3, 10]


def test_tag_posts_inner_join_and_sorted_ids(spark):
    p, t = frames(spark)
    got = {r.tag_name: (r.tag_id, r.post_ids) for r in rl.tag_posts(p, t).collect()}
    # 'jvm' is missing from the tags table and 'unused' has no post: both dropped
    assert got == {"java": (1, [3, 10]), "spring": (2, [10])}


def test_id_lists_numeric_not_lexicographic(spark):
    df = spark.createDataFrame([("['10', '2']",), ("2,10,x",)], "s string")
    parsed = df.select(io.parse_post_id_list(F.col("s")).alias("a")).collect()
    assert parsed[0].a == [10, 2]
    split = df.select(io.split_id_list(F.col("s")).alias("a")).collect()
    assert split[1].a == [2, 10, None]          # a bad piece becomes null, no ANSI error


def test_union_typed_nulls(spark):
    p, _ = frames(spark)
    ex = spark.createDataFrame([(1000000001, "excerpt")], "id long, body string")
    u = rl.post_text_union(p, ex, ex.limit(0))
    assert dict(u.dtypes) == {"post_id": "bigint", "body": "string", "title": "string", "score": "int"}
    assert u.count() == 5


def test_overwrite_first_n(spark):
    df = spark.createDataFrame([(i, str(i)) for i in (5, 1, 3, 2)], "k long, v string")
    got = {r.k: r.v for r in rl.overwrite_first_n(df, 2, "k", "v", "X").collect()}
    assert got == {1: "X", 2: "X", 3: "3", 5: "5"}


def test_large_ids_split_lists_but_not_counts(spark):
    big = 3_000_000
    p = spark.createDataFrame([(i, "t", "b", "java", None, 1) for i in (1, 2, big, 2 * big)],
                              "id long, title string, body string, tags string, parent_id long, score int")
    t = spark.createDataFrame(TAGS, "id long, tag_name string, count long, excerpt_post_id long, wiki_post_id long")
    tp = rl.tag_posts(p, t)
    assert sorted((r.tag_id, r.id_block, r.post_ids) for r in tp.collect()) == [(1, 0, [1, 2]), (1, 3, [big]), (1, 6, [2 * big])]
    assert rl.memberships(p, t).agg(F.count_distinct("tag_id")).first()[0] == 1
    over = rl.overwrite_first_n(rl.post_ids_text(tp).select("tag_id", "id_block", "post_ids"), 1, "tag_id", "post_ids", "X")
    assert [r.post_ids for r in over.collect()] == ["X", "X", "X"]       # all rows of the first tag
