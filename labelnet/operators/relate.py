"""Relational layer: posts <-> tags, the text union, filters, counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelnet.functions import text as tx
from labelnet.util import checked_broadcast


def tagged_posts(posts: DataFrame) -> DataFrame:
    """Posts that carry tags. ``null <> ''`` is null, so null tags go too."""
    return posts.where(F.col("tags") != "")


def post_tag_pairs(posts: DataFrame) -> DataFrame:
    """``(post_id, tag_name)``: split the pipe-delimited tag string and explode."""
    return (tagged_posts(posts)
            .select(F.col("id").alias("post_id"), F.explode(F.split("tags", r"\|")).alias("tag_name")))


ID_BLOCK = 1_000_000


def tag_posts(posts: DataFrame, tags: DataFrame, id_block: int = ID_BLOCK) -> DataFrame:
    """``tag_name, tag_id, count, excerpt_post_id, wiki_post_id, id_block, post_ids array<bigint>``.

    Post ids per tag, sorted (collect_list order is not defined), one row per
    tag and block of ``id_block`` consecutive post ids: a tag holding a third
    of all posts is spread over many groups and no list exceeds ``id_block``
    ids. A tag has one row for each block in which it has posts, at any size;
    ``id_block`` is part of the key of every table made from this one, and
    counts of tags go by ``memberships``, the long form.
    """
    grouped = (post_tag_pairs(posts)
               .groupBy("tag_name", F.floor(F.col("post_id") / id_block).cast("bigint").alias("id_block"))
               .agg(F.array_sort(F.collect_list("post_id")).alias("post_ids")))
    t = tags.select(F.col("id").alias("tag_id"), "tag_name", "count", "excerpt_post_id", "wiki_post_id")
    return t.join(grouped, "tag_name", "inner")


def memberships(posts: DataFrame, tags: DataFrame) -> DataFrame:
    """``(tag_id, post_id)`` long form of ``tag_posts``: an inner join on the name."""
    t = tags.select(F.col("id").alias("tag_id"), "tag_name")
    return post_tag_pairs(posts).join(t, "tag_name").select("tag_id", "post_id")


def post_ids_text(tp: DataFrame) -> DataFrame:
    """Persisted shape: ``post_ids`` joined by commas."""
    return tp.withColumn("post_ids", F.concat_ws(",", F.col("post_ids").cast("array<string>")))


def post_text_union(posts: DataFrame, excerpts: DataFrame, wikis: DataFrame) -> DataFrame:
    """``post_id, body, title, score`` of posts, wiki excerpts and wikis (typed nulls)."""
    p = posts.select(F.col("id").alias("post_id"), "body", "title", F.col("score").cast("int").alias("score"))

    def side(df: DataFrame) -> DataFrame:
        return df.select(F.col("id").alias("post_id"), "body",
                         F.lit(None).cast("string").alias("title"), F.lit(None).cast("int").alias("score"))

    return p.unionByName(side(excerpts)).unionByName(side(wikis))


def clean_columns(texts: DataFrame, cols=("body", "title"), url_first: bool = False, tag_sep: str = "") -> DataFrame:
    """Apply the cleaning chain (without stem/lemma) to several text columns."""
    return texts.withColumns({c: tx.clean_text(F.col(c), url_first, tag_sep) for c in cols})


def usable_posts(texts: DataFrame, min_score: int = 1, url_first: bool = False) -> DataFrame:
    """Cleaned ``post_id, body, title, score`` with score >= min and non-blank title and body.

    The non-blank test runs inside a one-element array filter + explode: a
    plain Filter on the cleaned columns would be pushed below the projection
    and run the cleaning chain twice.
    """
    c = clean_columns(texts.where(F.col("score") >= min_score), url_first=url_first)
    row = F.array(F.struct("post_id", "body", "title", "score"))
    keep = F.filter(row, lambda r: (F.trim(r["title"]) != "") & (F.trim(r["body"]) != ""))
    return c.select(F.explode(keep).alias("r")).select("r.*")


def cap_rows(df: DataFrame, n: int, order_by: str = "id") -> DataFrame:
    """Row cap per source on a defined order (a feature of the dataset builder)."""
    return df.orderBy(order_by).limit(n)


def overwrite_first_n(df: DataFrame, n: int, order_cols, target: str, value) -> DataFrame:
    """Overwrite ``target`` with ``value`` on all rows of the first ``n`` keys by ``order_cols``.
    The keys come from a top-n of the distinct keys (bounded by ``n``),
    joined back; no global window."""
    keys = [order_cols] if isinstance(order_cols, str) else list(order_cols)
    first = df.select(*keys).distinct().orderBy(*keys).limit(n).withColumn("_first", F.lit(True))
    out = df.join(checked_broadcast(first, n), keys, "left")
    return (out.withColumn(target, F.when(F.col("_first"), F.lit(value)).otherwise(F.col(target)))
            .drop("_first"))
