"""End-to-end flows: documents -> label vectors -> label graph -> communities.

Default parameters are the reference's: 1,000 features, threshold 0.5
(strict), 5 propagation rounds, minimum score 1.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelnet.operators import features as fe
from labelnet.operators import graph as gr
from labelnet.operators import inverted as inv
from labelnet.operators import relate as rl
from labelnet.operators import similarity as sim
from labelnet.session import cut
from labelnet.sources import standin
from labelnet.util import checked_broadcast, spread_rank


@dataclass
class LabelVectors:
    vectors: DataFrame      # (tag_id, idx, w) long form, zero vectors have no rows
    tags: DataFrame         # (id, tag_name, count, excerpt_post_id, wiki_post_id)
    model: fe.TfidfModel    # fitted vocabulary (term, idx, idf)
    tf: DataFrame           # (post_id, term, tf) of the usable corpus
    members: DataFrame      # (tag_id, post_id) restricted to usable posts


def corpus_tf(spark: SparkSession, sf_dir: str, min_score: int = 1, stem: bool = False,
              url_first: bool = False, full: bool = False) -> DataFrame:
    """``(post_id, term, tf)`` of usable posts of the post/excerpt/wiki union, materialised once."""
    posts = standin.posts(spark, sf_dir)
    texts = rl.post_text_union(posts, standin.excerpts(spark, sf_dir), standin.wikis(spark, sf_dir))
    return cut(fe.term_counts(fe.usable_terms(texts, min_score=min_score, url_first=url_first, stem=stem, full=full)), "tf")


def label_vectors(spark: SparkSession, sf_dir: str, vocab_size: int = 1000, min_score: int = 1,
                  stem: bool = False, full: bool = False) -> LabelVectors:
    """TF-IDF of usable posts, averaged per tag (zero vector for tags without a usable post)."""
    tf = corpus_tf(spark, sf_dir, min_score=min_score, stem=stem, full=full)
    model = fe.fit_tfidf(tf, vocab_size)
    # fitted once: every user of the lazy table would compute the corpus statistics again
    model = fe.TfidfModel(cut(model.vocab, "vocabulary"), model.size)
    weights = fe.tfidf_transform(tf, model)
    posts = standin.posts(spark, sf_dir, with_score=False)
    tags = cut(standin.tags(spark, sf_dir))
    members = rl.memberships(posts, tags).join(fe.document_ids(tf), "post_id", "left_semi")
    vecs = cut(fe.label_means(weights, members))
    return LabelVectors(vecs, tags, model, tf, members)


def label_graph(lv: LabelVectors, threshold: float = 0.5, inclusive: bool = False,
                keep_isolated: bool = True) -> tuple[DataFrame, DataFrame]:
    """Vertices ``(id, name)`` and edges ``(src, dst, weight)`` over the label vectors."""
    arrays = cut(fe.sparse_arrays(lv.vectors, "tag_id"), "label-arrays")
    edges = cut(sim.similar_pairs(arrays, "tag_id", lv.model.size, threshold, inclusive), "edges")
    vertices = lv.tags.select("id", F.col("tag_name").alias("name"))
    if not keep_isolated:
        vertices = vertices.join(gr.endpoint_vertices(edges), "id", "left_semi")
    return vertices, edges


def first_tags(lv: LabelVectors, tag_count: int | None) -> LabelVectors:
    """Keep the first ``tag_count`` tags of the store (tag id order), as the flow's ``tag_count``."""
    if tag_count is None:
        return lv
    tags = lv.tags.where(F.col("id") <= F.lit(tag_count))
    vecs = lv.vectors.join(tags.select(F.col("id").alias("tag_id")), "tag_id", "left_semi")
    return LabelVectors(vecs, tags, lv.model, lv.tf, lv.members)


def communities(vertices: DataFrame, edges: DataFrame, algo: str = "label_propagation", max_iter: int = 5,
                weighted: bool = False) -> DataFrame:
    """``(id, label)`` by the chosen algorithm: label propagation, components or Louvain."""
    if algo == "label_propagation":
        return gr.label_propagation(vertices, edges, max_iter=max_iter, weighted=weighted)
    if algo == "components":
        return gr.connected_components(vertices, edges).withColumnRenamed("component", "label")
    if algo == "louvain":
        from labelnet.operators import louvain
        return louvain.louvain(vertices, edges)
    raise ValueError(f"unknown algorithm {algo!r}")


def tag_communities(spark: SparkSession, sf_dir: str, vocab_size: int = 1000, threshold: float = 0.5,
                    max_iter: int = 5, min_score: int = 1, weighted: bool = False, stem: bool = False,
                    tag_count: int | None = None, algo: str = "label_propagation", full: bool = False) -> DataFrame:
    """``(id, name, label)``: communities of the tag similarity graph (the flow of
    ``(tag_count, threshold, iterations, algorithm)``)."""
    lv = first_tags(label_vectors(spark, sf_dir, vocab_size, min_score, stem, full), tag_count)
    vertices, edges = label_graph(lv, threshold)
    labels = communities(vertices, edges, algo, max_iter, weighted)
    return vertices.join(labels, "id").select("id", "name", "label")


# ---- the ready-made vector store (embeddings) ----------------------------------

def embedding_graph(spark: SparkSession, sf_dir: str, threshold: float, inclusive: bool = False,
                    first_n: int | None = None, once: bool = False) -> tuple[DataFrame, DataFrame]:
    """Vertices ``(id, name)`` and edges over the stored vectors (64-dim, exact cosine).

    ``once``: the caller reads the edges only once, so that they needn't be written."""
    from labelnet.sources import io
    v = standin.vectors(spark, sf_dir)
    if first_n is not None:
        v = io.first_n_vectors(v, first_n)
    v = cut(v, "vectors")
    dim = v.select(F.max(F.size("vector"))).first()[0] or 0
    arrays = fe.array_to_sparse(v.select("tag_id", "vector"))
    edges = sim.similar_pairs(arrays, "tag_id", dim, threshold, inclusive)
    edges = edges if once else cut(edges, "edges")
    vertices = v.select(F.col("tag_id").alias("id"), F.col("tag_id").cast("string").alias("name"))
    return vertices, edges


def label_arrays(lv: LabelVectors) -> DataFrame:
    """``(tag_id, idxs, vals)`` for every tag; zero vectors as empty arrays."""
    arr = fe.sparse_arrays(lv.vectors, "tag_id")
    return (lv.tags.select(F.col("id").alias("tag_id")).join(arr, "tag_id", "left")
            .select("tag_id", F.coalesce("idxs", F.array().cast("array<int>")).alias("idxs"),
                    F.coalesce("vals", F.array().cast("array<double>")).alias("vals")))


def ranked(scores: DataFrame, key: list[str], other: str, score: str, k: int | None) -> DataFrame:
    """``rank`` per key by (rounded score desc, other asc); top ``k`` when given.

    Rounding to 6 places before ranking makes floating-point noise between
    engines unable to swap two near-equal scores.
    """
    from pyspark.sql import Window
    s = scores.withColumn(score, F.round(score, 6))
    w = Window.partitionBy(*key).orderBy(F.desc(score), F.asc(other))
    s = s.withColumn("rank", F.row_number().over(w))
    return s.where(F.col("rank") <= k) if k is not None else s


def tag_ranking(lv: LabelVectors, requests: DataFrame | None = None) -> DataFrame:
    """``(tag_id, rank, neighbour_id, sim)``: all tags ranked against each requested tag.

    ``requests``: a column ``tag_name``, one row or many (repeated names count once, unknown ones give no rows); None:
    every tag. Only the requested rows of the similarity product are computed, and no task holds all rows of one.
    """
    arr = cut(label_arrays(lv), "label_arrays")
    left = arr
    if requests is not None:
        asked = requests.select("tag_name").distinct().join(lv.tags, "tag_name").select(F.col("id").alias("tag_id"))
        left = arr.join(asked, "tag_id", "left_semi")
    sc = sim.block_scores(left, arr.withColumnRenamed("tag_id", "neighbour_id"), ["tag_id"], ["neighbour_id"], lv.model.size)
    sc = sc.select("tag_id", "neighbour_id", F.round("score", 6).alias("sim"))
    return spread_rank(sc, ["tag_id"], [F.desc("sim"), F.asc("neighbour_id")]).select("tag_id", "rank", "neighbour_id", "sim")


def tag_neighbours(lv: LabelVectors, k: int | None = 10, include_self: bool = True) -> DataFrame:
    """``(tag_id, rank, neighbour_id, sim)``: nearest tags by cosine for every tag.

    ``k=None`` is the full ranking of all tags against each tag.
    """
    arr = cut(label_arrays(lv), "label_arrays")
    left = arr.withColumnRenamed("tag_id", "q_id")
    right = arr.withColumnRenamed("tag_id", "neighbour_id")
    sc = sim.block_scores(left, right, ["q_id"], ["neighbour_id"], lv.model.size, top_k=k,
                          exclude_same_key=not include_self)
    return ranked(sc.withColumnRenamed("q_id", "tag_id").withColumnRenamed("score", "sim"),
                  ["tag_id"], "neighbour_id", "sim", k)


@dataclass
class TaggingModel:
    """What later posts are tagged with: the fitted vocabulary and the inverted index of the tag vectors."""
    vocab: DataFrame        # (term, idx, idf)
    size: int
    tags: DataFrame         # (tag_id, tag_name)
    index: inv.Index


def tagging_model(lv: LabelVectors) -> TaggingModel:
    return TaggingModel(lv.model.vocab, lv.model.size, lv.tags.select(F.col("id").alias("tag_id"), "tag_name"),
                        inv.build(lv.vectors, "tag_id", lv.model.size))


def save_model(model: TaggingModel, path: str) -> None:
    """Fit once, tag later: the model as Parquet tables under ``path``."""
    model.vocab.select("term", F.col("idx").cast("int"), "idf").write.mode("overwrite").parquet(f"{path}/vocabulary")
    model.tags.write.mode("overwrite").parquet(f"{path}/tags")
    inv.save(model.index, f"{path}/index")


def load_model(spark: SparkSession, path: str) -> TaggingModel:
    vocab = spark.read.schema("term string, idx int, idf double").parquet(f"{path}/vocabulary")
    tags = spark.read.schema("tag_id bigint, tag_name string").parquet(f"{path}/tags")
    size = max(1, vocab.count())
    return TaggingModel(vocab, size, tags, inv.load(spark, f"{path}/index", size))


def new_post_vectors(posts: DataFrame, keys: list[str], model: TaggingModel) -> DataFrame:
    """TF-IDF weights ``(keys, idx, w)`` of the posts' ``body`` with the fitted vocabulary; scoring brings them to unit length."""
    from labelnet.functions import text as tx
    long = posts.select(*keys, F.explode(fe.tf_tokens(tx.clean_tokens("body"))).alias("term"))
    tf = long.groupBy(*keys, "term").agg(F.count(F.lit(1)).alias("tf"))
    return tf.join(checked_broadcast(model.vocab, model.size), "term").select(*keys, "idx", (F.col("tf") * F.col("idf")).alias("w"))


def suggest_tags(posts: DataFrame, keys: list[str], model: TaggingModel, k: int = 20, pad_zero: bool = False) -> DataFrame:
    """``(keys, rank, tag_id, sim)``: the k most similar tags of each of ``posts`` (keys, body).

    Tags with similarity 0 are dropped unless ``pad_zero`` (the reference pads): then a post with fewer than k gets the
    first tags by id that it hasn't got. A post with m < k of its own misses at most m of the first k + m tags, so the
    first 2k tags are enough, and only such posts meet them.
    """
    found = inv.top_k(new_post_vectors(posts, keys, model), keys, model.index, k)
    best = ranked(found.select(*keys, F.col("row").alias("tag_id"), F.col("score").alias("sim")), keys, "tag_id", "sim", k)
    if not pad_zero:
        return best
    best = cut(best, "post-tags")
    first = model.tags.select("tag_id").orderBy("tag_id").limit(2 * k).agg(F.sort_array(F.collect_list("tag_id")).alias("first"))
    have = best.groupBy(*keys).agg(F.collect_list("tag_id").alias("have"))            # at most k each
    short = posts.select(*keys).distinct().join(have, keys, "left").withColumn("have", F.coalesce("have", F.array().cast("array<bigint>")))
    short = short.where(F.size("have") < k).select(*keys, "have", first.select("first").scalar().alias("first"))
    more = F.slice(F.filter("first", lambda t: ~F.array_contains("have", t)), F.lit(1), F.lit(k) - F.size("have"))
    pads = short.select(*keys, F.size("have").alias("n"), F.posexplode(more).alias("i", "tag_id"))
    return best.select(*keys, "rank", "tag_id", "sim").unionByName(
        pads.select(*keys, (F.col("n") + F.col("i") + 1).cast("int").alias("rank"), "tag_id", F.lit(0.0).alias("sim")))


def post_tags(spark: SparkSession, sf_dir: str, lv: LabelVectors, k: int = 20, pad_zero: bool = False) -> DataFrame:
    """``(conv_id, turn, rank, tag_id, sim)``: the k most similar tags per new post."""
    return suggest_tags(standin.new_posts(spark, sf_dir), ["conv_id", "turn"], tagging_model(lv), k, pad_zero)


def recommend(vertices: DataFrame, edges: DataFrame, labels: DataFrame, k: int = 10) -> DataFrame:
    """``(tag_id, rank, rec_id, weight)``: neighbours in the same community,
    heaviest edge first (ties: smaller id), for every vertex at once."""
    lab = labels.select("id", "label")
    und = gr.undirected(edges)
    same = (und.join(lab.select(F.col("id").alias("src"), F.col("label").alias("ls")), "src")
            .join(lab.select(F.col("id").alias("dst"), F.col("label").alias("ld")), "dst")
            .where(F.col("ls") == F.col("ld"))
            .select(F.col("src").alias("tag_id"), F.col("dst").alias("rec_id"), "weight"))
    return ranked(same, ["tag_id"], "rec_id", "weight", k)


def recommend_for(requests: DataFrame, vertices: DataFrame, recs: DataFrame) -> DataFrame:
    """Recommendations for a request table of tag names (one row or many).

    ``(tag_name, rank, rec_id, rec_name, weight)``; an unknown name gives no rows.
    """
    ids = vertices.select(F.col("id").alias("tag_id"), F.col("name").alias("tag_name"))
    names = vertices.select(F.col("id").alias("rec_id"), F.col("name").alias("rec_name"))
    return (requests.select("tag_name").join(ids, "tag_name").join(recs, "tag_id").join(names, "rec_id")
            .select("tag_name", "rank", "rec_id", "rec_name", "weight"))


def precision_at_k(recs: DataFrame, truth_keys: DataFrame, k: int = 5) -> DataFrame:
    """Mean precision@k over the tags of ``truth_keys (tag_id, key)``.

    A recommendation is relevant when it shares the tag's truth key (e.g.
    the language); precision = hits / returned among the first k; a tag
    with nothing returned scores 0.
    """
    tk = truth_keys.select("tag_id", F.col("key").alias("tkey"))
    rk = truth_keys.select(F.col("tag_id").alias("rec_id"), F.col("key").alias("rkey"))
    top = recs.where(F.col("rank") <= k).join(rk, "rec_id", "left")
    per = top.join(tk, "tag_id").groupBy("tag_id").agg(
        F.sum(F.when(F.col("rkey") == F.col("tkey"), 1).otherwise(0)).alias("hits"),
        F.count(F.lit(1)).alias("returned"))
    allt = tk.join(per, "tag_id", "left").select(
        "tag_id", F.when(F.col("returned") > 0, F.col("hits") / F.col("returned")).otherwise(F.lit(0.0)).alias("p"))
    return allt.agg(F.count(F.lit(1)).alias("n_tags"), F.round(F.avg("p"), 6).alias("precision"))


def precision_at_k_pairs(recs: DataFrame, truth: DataFrame, k: int = 5) -> DataFrame:
    """Mean precision@k against explicit truth lists ``truth(tag_id, relevant_id)``
    (long form of the reference's tag -> relevant ids map).

    Hits come from a left join of the top-k rows to the distinct truth pairs;
    the mean runs over the tags of the truth table (nothing returned -> 0).
    """
    t = truth.select("tag_id", F.col("relevant_id").alias("rec_id")).distinct().withColumn("hit", F.lit(1))
    top = recs.where(F.col("rank") <= k).select("tag_id", "rec_id")
    per = top.join(t, ["tag_id", "rec_id"], "left").groupBy("tag_id").agg(
        F.count("hit").alias("hits"), F.count(F.lit(1)).alias("returned"))
    tags = truth.select("tag_id").distinct()
    allt = tags.join(per, "tag_id", "left").select(
        "tag_id", F.when(F.col("returned") > 0, F.col("hits") / F.col("returned")).otherwise(F.lit(0.0)).alias("p"))
    return allt.agg(F.count(F.lit(1)).alias("n_tags"), F.round(F.avg("p"), 6).alias("precision"))
