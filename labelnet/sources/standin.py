"""Map the shared test tables onto the data model (see FIXTURES.md).

posts      <- documents (+ labels for the score)
tags       <- distinct tags of those posts
excerpts   <- benchmark, wikis <- pages
new posts  <- conversations (user turns)
vectors    <- embeddings
baskets    <- lineitem x part
usage      <- events
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelnet.sources.io import read_table
from labelnet.util import dense_index, spread

# fixed id offsets of the stand-in excerpt and wiki rows (FIXTURES.md)
EXCERPT_ID_OFFSET = 1000000000
WIKI_ID_OFFSET = 2000000000


TEXT_TABLES = {"documents", "pages", "conversations", "benchmark"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A shared table; text tables are spread over the cores when their scan is narrow."""
    df = read_table(spark, "parquet", f"{sf_dir.rstrip('/')}/{name}.parquet")
    return spread(df) if name in TEXT_TABLES else df


def posts(spark: SparkSession, sf_dir: str, with_score: bool = True) -> DataFrame:
    """``id, title, body, tags, parent_id, score``.

    title = first line of the text; tags = ``lang-source|lang``; score =
    labels.quality (null when the document has no label row).
    """
    d = table(spark, sf_dir, "documents")
    base = d.select(
        F.col("doc_id").alias("id"),
        F.substring_index("text", "\n", 1).alias("title"),
        F.col("text").alias("body"),
        F.concat_ws("|", F.concat_ws("-", "lang", "source"), F.col("lang")).alias("tags"),
        F.lit(None).cast("bigint").alias("parent_id"),
    )
    if not with_score:
        return base.withColumn("score", F.lit(None).cast("int"))
    lab = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"), F.col("quality").cast("int").alias("score"))
    return base.join(lab, "id", "left")


def tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``id, tag_name, count, excerpt_post_id, wiki_post_id``; id = dense rank of the name."""
    p = posts(spark, sf_dir, with_score=False)
    pairs = p.select(F.explode(F.split("tags", r"\|")).alias("tag_name")).where(F.col("tag_name") != "")
    counts = pairs.groupBy("tag_name").agg(F.count(F.lit(1)).alias("count"))
    return (dense_index(counts, "tag_name", "id", start=1, unique=True)
            .select("id", "tag_name", "count",
                    F.lit(None).cast("bigint").alias("excerpt_post_id"),
                    F.lit(None).cast("bigint").alias("wiki_post_id")))


def excerpts(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = table(spark, sf_dir, "benchmark")
    return b.select((F.col("item_id") + F.lit(EXCERPT_ID_OFFSET)).alias("id"), F.col("text").alias("body"))


def wikis(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "pages")
    return p.select((F.col("page_id") + F.lit(WIKI_ID_OFFSET)).alias("id"), F.col("html").alias("body"))


def new_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posts to tag: user turns of the conversations, keyed by ``(conv_id, turn)``."""
    c = table(spark, sf_dir, "conversations")
    return c.where(F.col("role") == "user").select("conv_id", "turn", F.col("text").alias("body"))


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ready-made vector store ``(tag_id, ord, vector array<double>, label)``."""
    e = table(spark, sf_dir, "embeddings")
    return e.select(F.col("vec_id").alias("tag_id"), F.col("vec_id").alias("ord"),
                    F.col("embedding").cast("array<double>").alias("vector"), F.col("label").cast("bigint").alias("label"))


def baskets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(post_id, tag)``: an order is a post, ``brand/type`` of its parts are its tags."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    pa = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type")
    return (li.join(pa, li.l_partkey == pa.p_partkey)
            .select(F.col("l_orderkey").alias("post_id"), F.concat_ws("/", "p_brand", "p_type").alias("tag")))


def usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(ts, tag)``: one usage event per row; the event type is the tag."""
    return table(spark, sf_dir, "events").select("ts", F.col("event_type").alias("tag"))
