"""Explicit schemas of the data model (never inferred)."""

from pyspark.sql import types as T

POSTS = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("title", T.StringType()),
    T.StructField("body", T.StringType()),
    T.StructField("tags", T.StringType()),
    T.StructField("parent_id", T.LongType()),
    T.StructField("score", T.IntegerType()),
])

TAGS = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("tag_name", T.StringType()),
    T.StructField("count", T.LongType()),
    T.StructField("excerpt_post_id", T.LongType()),
    T.StructField("wiki_post_id", T.LongType()),
])

TEXTS = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("body", T.StringType()),
])

# curated tag -> posts table as persisted on disk (list literal of quoted ids)
TAG_POST_CSV = T.StructType([
    T.StructField("tag_name", T.StringType()),
    T.StructField("tag_id", T.LongType()),
    T.StructField("count", T.LongType()),
    T.StructField("excerpt_post_id", T.DoubleType()),
    T.StructField("wiki_post_id", T.DoubleType()),
    T.StructField("post_ids_array", T.StringType()),
])

# vector store: one row per label, ``ord`` keeps "first N" meaningful
VECTORS = T.StructType([
    T.StructField("tag_id", T.LongType()),
    T.StructField("ord", T.LongType()),
    T.StructField("vector", T.ArrayType(T.DoubleType())),
])

DICTIONARY = T.StructType([
    T.StructField("tag_id", T.LongType()),
    T.StructField("tag_name", T.StringType()),
])

EDGES = T.StructType([
    T.StructField("src", T.LongType()),
    T.StructField("dst", T.LongType()),
    T.StructField("weight", T.DoubleType()),
])

VERTICES = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("name", T.StringType()),
])

# truth of the evaluation: relevant ids of a tag, long form
TRUTH = T.StructType([
    T.StructField("tag_id", T.LongType()),
    T.StructField("relevant_id", T.LongType()),
])
