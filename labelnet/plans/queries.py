"""Named queries: one per operator of the inventory, each ``(spark, sf_dir) -> DataFrame``.

Every query reads the shared tables (or data Spark derives from them) in
full; doubles are rounded to 6 places at the query boundary only.
Parameters are the reference's defaults unless a fixture needs another
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelnet.functions import text as tx
from labelnet.operators import candidates as cand
from labelnet.operators import cooc as co
from labelnet.operators import features as fe
from labelnet.operators import graph as gr
from labelnet.operators import louvain as lv_
from labelnet.operators import relate as rl
from labelnet.operators import similarity as sim
from labelnet.plans import flows as pl
from labelnet.session import cut, scratch_path
from labelnet.sources import io, standin

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

# parameters of the registered queries (the oracle SQL uses the same ones)
DOC_VOCAB = 1000          # reference default feature count
DOC_THRESHOLD = 0.5       # reference default, strict
ROUNDS = 5                # reference default propagation rounds
EMB_EDGE_T = 0.4          # embeddings: threshold with a useful edge set
EMB_LP_T = 0.3            # embeddings: threshold for propagation
BAND_RECALL = 0.95        # share of pairs at the threshold that candidates are meant to find
FIRST_N = 150             # first vectors of the store (below every fixture's row count)
CAP = 100                 # row cap of the dataset builder
OVERWRITE_N = 10          # rows overwritten by the draft flow
OVERWRITE_VALUE = "11,22,33"
TOP_RECS = 10             # recommendations per tag
TOP_POST_TAGS = 20        # tags suggested per post
PREC_K = 5                # precision@5
TRUTH_NEAR = 10           # truth pairs: so many ids of the same label on either side
MIN_COMMUNITY = 3         # merge communities smaller than this
HASH_FEATURES = 20        # hashed draft feature count
TAG_COUNT = 20            # reference default of the community flow's first tags
ENDPOINT_T = 0.99         # documents: threshold that leaves some tags without an edge


def register(name: str):
    def deco(fn: Query) -> Query:
        REGISTRY[name] = fn
        return fn
    return deco


def _r(c):
    return F.round(c, 6)


# ---- sources and sinks -----------------------------------------------------------

@register("scan_posts")
def q_scan_posts(spark, d):
    from labelnet import schemas
    return io.conform(standin.posts(spark, d), schemas.POSTS)


@register("scan_csv_tags")
def q_scan_csv_tags(spark, d):
    from labelnet import schemas
    path = scratch_path(spark, "tags-csv")
    standin.tags(spark, d).write.option("header", True).csv(path)
    return io.read_csv_table(spark, path, schemas.TAGS)


@register("parse_post_id_list")
def q_parse_post_id_list(spark, d):
    from labelnet import schemas
    tp = rl.tag_posts(standin.posts(spark, d, with_score=False), standin.tags(spark, d))
    lit = F.concat(F.lit("["), F.array_join(F.transform("post_ids", lambda x: F.concat(F.lit("'"), x.cast("string"), F.lit("'"))), ", "), F.lit("]"))
    out = tp.select("tag_name", "tag_id", "count", F.col("excerpt_post_id").cast("double"),
                    F.col("wiki_post_id").cast("double"), lit.alias("post_ids_array"))
    keyed = tp.select("tag_id", F.col("post_ids")[0].alias("first_id"), "id_block")   # the list's block, by its first id
    path = scratch_path(spark, "tag-post-csv")
    out.write.option("header", True).csv(path)
    back = io.read_csv_table(spark, path, schemas.TAG_POST_CSV)
    back = back.select("tag_id", "tag_name", io.parse_post_id_list(F.col("post_ids_array")).alias("post_ids"))
    return (back.withColumn("first_id", F.col("post_ids")[0]).join(keyed, ["tag_id", "first_id"])
            .select("tag_id", "tag_name", "id_block", "post_ids"))


@register("first_n_vectors")
def q_first_n_vectors(spark, d):
    return io.first_n_vectors(standin.vectors(spark, d), FIRST_N).select("tag_id", "ord", "vector")


@register("tag_dictionary")
def q_tag_dictionary(spark, d):
    path = scratch_path(spark, "dict-json")
    io.write_dictionary(standin.tags(spark, d).select(F.col("id").alias("tag_id"), "tag_name"), path, "json")
    return io.read_dictionary(spark, path, "json")


@register("dictionary_roundtrip")
def q_dictionary_roundtrip(spark, d):
    path = scratch_path(spark, "dict-parquet")
    io.write_dictionary(standin.tags(spark, d).select(F.col("id").alias("tag_id"), "tag_name"), path)
    return io.read_dictionary(spark, path)


@register("vector_roundtrip")
def q_vector_roundtrip(spark, d):
    lv = pl.label_vectors(spark, d, DOC_VOCAB)
    dense = fe.dense_vectors(lv.vectors, "tag_id", DOC_VOCAB)
    full = (lv.tags.select(F.col("id").alias("tag_id")).join(dense, "tag_id", "left")
            .select("tag_id", F.col("tag_id").alias("ord"),
                    F.coalesce("vector", F.array_repeat(F.lit(0.0), DOC_VOCAB)).alias("vector")))
    path = scratch_path(spark, "vectors")
    io.write_vectors(full, path)
    back = io.read_vectors(spark, path)
    return back.select("tag_id", "ord", F.transform("vector", lambda x: F.round(x, 6)).alias("vector"))


# ---- relational layer ---------------------------------------------------------------

@register("cap_rows")
def q_cap_rows(spark, d):
    return rl.cap_rows(standin.posts(spark, d), CAP).select("id", "title", "tags", "score")


@register("post_text_union")
def q_post_text_union(spark, d):
    return rl.post_text_union(standin.posts(spark, d), standin.excerpts(spark, d), standin.wikis(spark, d))


@register("tagged_posts")
def q_tagged_posts(spark, d):
    return rl.tagged_posts(standin.posts(spark, d, with_score=False)).select("id", "tags")


@register("usable_posts")
def q_usable_posts(spark, d):
    texts = rl.post_text_union(standin.posts(spark, d), standin.excerpts(spark, d), standin.wikis(spark, d))
    return rl.usable_posts(texts)


@register("post_tag_pairs")
def q_post_tag_pairs(spark, d):
    return rl.post_tag_pairs(standin.posts(spark, d, with_score=False))


@register("tag_posts")
def q_tag_posts(spark, d):
    return rl.tag_posts(standin.posts(spark, d, with_score=False), standin.tags(spark, d))


@register("tag_posts_csv")
def q_tag_posts_csv(spark, d):
    tp = rl.post_ids_text(rl.tag_posts(standin.posts(spark, d, with_score=False), standin.tags(spark, d)))
    return tp.select("tag_id", "tag_name", "id_block", "post_ids", io.split_id_list(F.col("post_ids")).alias("parsed"))


@register("overwrite_first_n")
def q_overwrite_first_n(spark, d):
    tp = rl.post_ids_text(rl.tag_posts(standin.posts(spark, d, with_score=False), standin.tags(spark, d)))
    return rl.overwrite_first_n(tp.select("tag_id", "tag_name", "id_block", "post_ids"), OVERWRITE_N,
                                "tag_id", "post_ids", OVERWRITE_VALUE)


@register("dataset_counts")
def q_dataset_counts(spark, d):
    posts = standin.posts(spark, d)
    n_tags = rl.memberships(posts, standin.tags(spark, d)).agg(F.count_distinct("tag_id").alias("n_tags"))
    n_posts = rl.post_text_union(posts, standin.excerpts(spark, d), standin.wikis(spark, d)).agg(
        F.count(F.lit(1)).alias("n_posts"))
    return n_tags.select("n_tags", n_posts.select("n_posts").scalar().alias("n_posts"))


@register("lookup_tag")
def q_lookup_tag(spark, d):
    requests = standin.table(spark, d, "documents").select(F.col("lang").alias("tag_name")).distinct()
    tags = standin.tags(spark, d)
    return tags.join(requests, "tag_name").select(F.col("id").alias("tag_id"), "tag_name", "count")


# ---- text ---------------------------------------------------------------------------------

@register("html_to_text")
def q_html_to_text(spark, d):
    return standin.table(spark, d, "pages").select("page_id", tx.html_to_text("html").alias("text"))


@register("normalize_text")
def q_normalize_text(spark, d):
    return standin.table(spark, d, "documents").select("doc_id", tx.normalize_text("text").alias("text"))


@register("strip_urls")
def q_strip_urls(spark, d):
    return standin.table(spark, d, "pages").select(
        "page_id", tx.strip_urls(tx.normalize_text("url")).alias("url"))


@register("remove_stopwords")
def q_remove_stopwords(spark, d):
    toks = tx.word_tokens(tx.normalize_text("text"))
    return standin.table(spark, d, "documents").select(
        "doc_id", F.array_join(tx.remove_stopwords(toks), " ").alias("text"))


@register("clean_text")
def q_clean_text(spark, d):
    return standin.table(spark, d, "documents").select("doc_id", tx.clean_text("text").alias("text"))


def _doc_terms(spark, d):
    docs = standin.table(spark, d, "documents").select(F.col("doc_id").alias("post_id"), tx.clean_tokens("text").alias("tokens"))
    return docs.select("post_id", F.explode("tokens").alias("term"))


@register("stem_vocabulary")
def q_stem_vocabulary(spark, d):
    return fe.stem_vocabulary(_doc_terms(spark, d))


@register("lexicon_normalize")
def q_lexicon_normalize(spark, d):
    return fe.lexicon_from_corpus(_doc_terms(spark, d))


@register("lemmatise_vocabulary")
def q_lemmatise_vocabulary(spark, d):
    """Noun lemmas of the documents' words, with the words of all texts as the dictionary and the irregular nouns."""
    terms = cut(_doc_terms(spark, d), "doc-terms")
    return fe.lemma_map(terms, terms.select(F.col("term").alias("word")))


@register("clean_text_full")
def q_clean_text_full(spark, d):
    """The whole cleaning chain of the reference, stems and lemmas included: one token map for the corpus, joined once."""
    docs = standin.table(spark, d, "documents").select("doc_id", tx.clean_tokens("text").alias("tokens"))
    docs = fe.chunked(docs.select("doc_id", F.coalesce("tokens", F.array().cast("array<string>")).alias("tokens")), "doc-tokens")
    words = fe.chunk_words(docs)
    return fe.mapped_text(docs, "doc_id", fe.token_map(words), words)


# ---- features --------------------------------------------------------------------------

@register("vocabulary")
def q_vocabulary(spark, d):
    tf = pl.corpus_tf(spark, d)
    return fe.vocabulary(tf, DOC_VOCAB).select("term", "idx", "freq", "df")


@register("idf")
def q_idf(spark, d):
    m = fe.fit_tfidf(pl.corpus_tf(spark, d), DOC_VOCAB)
    return m.vocab.select("term", "idx", _r("idf").alias("idf"))


@register("post_tfidf")
def q_post_tfidf(spark, d):
    tf = pl.corpus_tf(spark, d)
    m = fe.fit_tfidf(tf, DOC_VOCAB)
    return fe.tfidf_transform(tf, m).select("post_id", "idx", _r("w").alias("w"))


@register("tag_vectors")
def q_tag_vectors(spark, d):
    lv = pl.label_vectors(spark, d, DOC_VOCAB)
    return lv.vectors.select("tag_id", "idx", _r("w").alias("w"))


@register("dense_vectors")
def q_dense_vectors(spark, d):
    lv = pl.label_vectors(spark, d, DOC_VOCAB)
    dense = fe.dense_vectors(lv.vectors, "tag_id", DOC_VOCAB)
    return (lv.tags.select(F.col("id").alias("tag_id")).join(dense, "tag_id", "left")
            .select("tag_id", F.transform(F.coalesce("vector", F.array_repeat(F.lit(0.0), DOC_VOCAB)),
                                          lambda x: F.round(x, 6)).alias("vector")))


@register("hashed_tfidf")
def q_hashed_tfidf(spark, d):
    from pyspark.ml.feature import IDF, HashingTF
    from pyspark.ml.functions import vector_to_array
    texts = rl.post_text_union(standin.posts(spark, d), standin.excerpts(spark, d), standin.wikis(spark, d))
    usable = rl.usable_posts(texts)
    words = usable.select("post_id", F.filter(F.split("title", " "), lambda w: w != "").alias("title_words"))
    tf = HashingTF(inputCol="title_words", outputCol="raw", numFeatures=HASH_FEATURES).transform(words)
    tf = cut(tf, "hashed-counts")      # fit and transform both read it
    model = IDF(inputCol="raw", outputCol="tfidf").fit(tf)
    return model.transform(tf).select("post_id", vector_to_array("tfidf").alias("tfidf"))


@register("cosine_pairs")
def q_cosine_pairs(spark, d):
    """Each stored vector against the mean vector of its label group."""
    v = standin.vectors(spark, d)
    long = v.select("label", F.posexplode("vector").alias("pos", "x"))
    cent = (long.groupBy("label", "pos").agg(F.avg("x").alias("x"))
            .groupBy("label").agg(F.array_sort(F.collect_list(F.struct("pos", "x"))).alias("c"))
            .select("label", F.col("c.x").alias("centroid")))
    return v.join(cent, "label").select("tag_id", "label", _r(sim.cosine(F.col("vector"), F.col("centroid"))).alias("cos"))


# ---- similarity graph -----------------------------------------------------------------

@register("similarity_edges")
def q_similarity_edges(spark, d):
    _, e = pl.embedding_graph(spark, d, EMB_EDGE_T)
    return e.select("src", "dst", _r("weight").alias("weight"))


@register("similarity_edges_all")
def q_similarity_edges_all(spark, d):
    """Directed pairs both ways plus self pairs, inclusive threshold (draft flow)."""
    lv = pl.label_vectors(spark, d, DOC_VOCAB)
    _, e = pl.label_graph(lv, DOC_THRESHOLD, inclusive=True)
    nonzero = lv.vectors.select(F.col("tag_id").alias("id")).distinct()
    return gr.both_ways_with_loops(e, nonzero).select("src", "dst", _r("weight").alias("weight"))


@register("similarity_edges_banded")
def q_similarity_edges_banded(spark, d):
    """The edges by candidates (signed random projections) in place of all pairs."""
    v = cut(standin.vectors(spark, d), "vectors")
    dim = v.select(F.max(F.size("vector"))).first()[0] or 0
    e = cand.banded_pairs(fe.array_to_sparse(v.select("tag_id", "vector")), "tag_id", dim, EMB_EDGE_T, recall=BAND_RECALL)
    return e.select("src", "dst", _r("weight").alias("weight"))


@register("tag_pairs_count")
def q_tag_pairs_count(spark, d):
    lv = pl.label_vectors(spark, d, DOC_VOCAB)
    _, e = pl.label_graph(lv, DOC_THRESHOLD)
    n = lv.tags.agg(F.count(F.lit(1)).alias("n_tags"))
    return n.select("n_tags", (F.col("n_tags") * (F.col("n_tags") - 1) / 2).cast("bigint").alias("n_pairs"),
                    e.select(F.count(F.lit(1))).scalar().alias("n_edges"))


@register("graph_vertices")
def q_graph_vertices(spark, d):
    lv = pl.label_vectors(spark, d, DOC_VOCAB)
    v, e = pl.label_graph(lv, DOC_THRESHOLD)
    ends = gr.endpoint_vertices(e).withColumn("has_edge", F.lit(True))
    return v.join(ends, "id", "left").select("id", "name", F.coalesce("has_edge", F.lit(False)).alias("has_edge"))


@register("graph_endpoints")
def q_graph_endpoints(spark, d):
    """The vertex table of the scripts: tags with an edge only."""
    lv = pl.label_vectors(spark, d, DOC_VOCAB)
    v, _ = pl.label_graph(lv, ENDPOINT_T, keep_isolated=False)
    return v.select("id", "name")


@register("undirected_edges")
def q_undirected_edges(spark, d):
    _, e = pl.embedding_graph(spark, d, EMB_EDGE_T)
    return gr.undirected(e).select("src", "dst", _r("weight").alias("weight"))


@register("incident_edges")
def q_incident_edges(spark, d):
    _, e = pl.embedding_graph(spark, d, EMB_EDGE_T)
    u = gr.undirected(e)
    return u.select(F.col("src").alias("id"), F.col("dst").alias("other"), _r("weight").alias("weight"))


@register("connected_components")
def q_connected_components(spark, d):
    v, e = pl.embedding_graph(spark, d, EMB_EDGE_T)
    return gr.components(v, e)


@register("connected_components_stars")
def q_connected_components_stars(spark, d):
    """By alternating stars, on an edge table that shrinks."""
    v, e = pl.embedding_graph(spark, d, EMB_EDGE_T)
    return gr.connected_components(v, e)


@register("split_communities")
def q_split_communities(spark, d):
    """Communities of the stored vectors by their group's label, parted where they hang together by no edge of their own."""
    v, e = pl.embedding_graph(spark, d, EMB_LP_T)
    return gr.split_communities(standin.vectors(spark, d).select(F.col("tag_id").alias("id"), "label"), e)


@register("label_propagation")
def q_label_propagation(spark, d):
    v, e = pl.embedding_graph(spark, d, EMB_LP_T, once=True)
    return gr.label_propagation(v, e, ROUNDS)


@register("label_propagation_weighted")
def q_label_propagation_weighted(spark, d):
    v, e = pl.embedding_graph(spark, d, EMB_LP_T, once=True)
    return gr.label_propagation(v, e, ROUNDS, weighted=True)


@register("community_dense_labels")
def q_community_dense_labels(spark, d):
    v, e = pl.embedding_graph(spark, d, EMB_LP_T, once=True)
    return gr.dense_labels(gr.label_propagation(v, e, ROUNDS), "label", 0)


@register("community_counts")
def q_community_counts(spark, d):
    v, e = pl.embedding_graph(spark, d, EMB_EDGE_T)
    comps = gr.connected_components(v, e)
    labs = gr.label_propagation(v, e, ROUNDS)
    n_comp = comps.agg(F.count_distinct("component").alias("components"))
    return n_comp.select("components", labs.select(F.count_distinct("label")).scalar().alias("communities"))


@register("modularity")
def q_modularity(spark, d):
    """Modularity of the language split of the document tag graph."""
    lv = pl.label_vectors(spark, d, DOC_VOCAB)
    v, e = pl.label_graph(lv, DOC_THRESHOLD)
    labels = v.select("id", F.split("name", "-").getItem(0).alias("label"))
    return gr.modularity(e, labels)


@register("merge_small_communities")
def q_merge_small_communities(spark, d):
    v, e = pl.embedding_graph(spark, d, EMB_LP_T)
    return gr.merge_small_communities(gr.label_propagation(v, e, ROUNDS), e, MIN_COMMUNITY)


@register("louvain")
def q_louvain(spark, d):
    v, e = pl.embedding_graph(spark, d, EMB_LP_T, once=True)
    return lv_.louvain(v, e)


@register("tag_communities")
def q_tag_communities(spark, d):
    return pl.tag_communities(spark, d, vocab_size=DOC_VOCAB, threshold=DOC_THRESHOLD, max_iter=ROUNDS)


@register("tag_communities_first_tags")
def q_tag_communities_first_tags(spark, d):
    """The flow over the first tags of the store only (``tag_count``)."""
    return pl.tag_communities(spark, d, vocab_size=DOC_VOCAB, threshold=DOC_THRESHOLD, max_iter=ROUNDS, tag_count=TAG_COUNT)


@register("tag_communities_stemmed")
def q_tag_communities_stemmed(spark, d):
    """The cleaning chain with the Porter stemmer."""
    return pl.tag_communities(spark, d, vocab_size=DOC_VOCAB, threshold=DOC_THRESHOLD, max_iter=ROUNDS, stem=True)


@register("tag_communities_full")
def q_tag_communities_full(spark, d):
    """The community flow behind the whole cleaning chain (stems and lemmas), as the reference always runs it."""
    return pl.tag_communities(spark, d, vocab_size=DOC_VOCAB, threshold=DOC_THRESHOLD, max_iter=ROUNDS, full=True)


# ---- recommendation and evaluation ---------------------------------------------------------

def _doc_graph_labels(spark, d):
    lv = pl.label_vectors(spark, d, DOC_VOCAB)
    v, e = pl.label_graph(lv, DOC_THRESHOLD)
    return lv, v, e, gr.label_propagation(v, e, ROUNDS)


@register("recommend_tags")
def q_recommend_tags(spark, d):
    _, v, e, labels = _doc_graph_labels(spark, d)
    recs = pl.recommend(v, e, labels, TOP_RECS)
    names = v.select(F.col("id").alias("rec_id"), F.col("name").alias("rec_name"))
    return recs.join(names, "rec_id").select("tag_id", "rank", "rec_id", "rec_name", "weight")


@register("recommend_requests")
def q_recommend_requests(spark, d):
    """Recommendations for a request table of tag names (the languages named in the documents)."""
    _, v, e, labels = _doc_graph_labels(spark, d)
    recs = pl.recommend(v, e, labels, TOP_RECS)
    requests = standin.table(spark, d, "documents").select(F.col("lang").alias("tag_name")).distinct()
    return pl.recommend_for(requests, v, recs)


@register("precision_at_k")
def q_precision_at_k(spark, d):
    _, v, e, labels = _doc_graph_labels(spark, d)
    recs = pl.recommend(v, e, labels, TOP_RECS)
    truth = v.select(F.col("id").alias("tag_id"), F.split("name", "-").getItem(0).alias("key"))
    return pl.precision_at_k(recs, truth, PREC_K)


@register("precision_at_k_pairs")
def q_precision_at_k_pairs(spark, d):
    """Against truth pairs as data: each vector's relevant ids are the ``TRUTH_NEAR`` next ids of its own label before and
    after it, written as a table and read back with its schema."""
    from pyspark.sql import Window
    from labelnet import schemas
    v, e = pl.embedding_graph(spark, d, EMB_LP_T)
    recs = pl.recommend(v, e, gr.label_propagation(v, e, ROUNDS), TOP_RECS)
    w = Window.partitionBy("label").orderBy("tag_id")
    near = F.array(*[f("tag_id", i).over(w) for i in range(1, TRUTH_NEAR + 1) for f in (F.lag, F.lead)])
    path = scratch_path(spark, "truth")
    (standin.vectors(spark, d).select("tag_id", near.alias("near"))
     .select("tag_id", F.explode("near").alias("relevant_id")).where("relevant_id is not null").write.parquet(path))
    truth = io.read_table(spark, "parquet", path, schema=schemas.TRUTH)
    return pl.precision_at_k_pairs(recs, truth, PREC_K)


@register("tag_neighbours")
def q_tag_neighbours(spark, d):
    lv = pl.label_vectors(spark, d, DOC_VOCAB)
    nb = pl.tag_neighbours(lv, TOP_RECS)
    names = lv.tags.select(F.col("id").alias("neighbour_id"), F.col("tag_name").alias("neighbour_name"))
    return nb.join(names, "neighbour_id").select("tag_id", "rank", "neighbour_id", "neighbour_name", "sim")


@register("tag_ranking")
def q_tag_ranking(spark, d):
    lv = pl.label_vectors(spark, d, DOC_VOCAB)
    return pl.tag_ranking(lv)


@register("tag_ranking_requests")
def q_tag_ranking_requests(spark, d):
    """All tags ranked against those of a request table of names (the languages named in the documents)."""
    lv = pl.label_vectors(spark, d, DOC_VOCAB)
    requests = standin.table(spark, d, "documents").select(F.col("lang").alias("tag_name"))
    names = lv.tags.select(F.col("id").alias("tag_id"), "tag_name")
    return pl.tag_ranking(lv, requests).join(names, "tag_id").select("tag_name", "rank", "neighbour_id", "sim")


@register("post_tags")
def q_post_tags(spark, d):
    lv = pl.label_vectors(spark, d, DOC_VOCAB)
    pt = pl.post_tags(spark, d, lv, TOP_POST_TAGS)
    names = lv.tags.select(F.col("id").alias("tag_id"), "tag_name")
    return pt.join(names, "tag_id").select("conv_id", "turn", "rank", "tag_id", "tag_name", "sim")


@register("post_tags_padded")
def q_post_tags_padded(spark, d):
    """Every post gets all its places: tags of similarity 0 fill up, in order of their ids."""
    lv = pl.label_vectors(spark, d, DOC_VOCAB)
    return pl.post_tags(spark, d, lv, TOP_POST_TAGS, pad_zero=True).select("conv_id", "turn", "rank", "tag_id", "sim")


@register("post_tags_saved_model")
def q_post_tags_saved_model(spark, d):
    """The model is fitted, written and read back; the posts are tagged with what was read."""
    path = scratch_path(spark, "tagging-model")
    pl.save_model(pl.tagging_model(pl.label_vectors(spark, d, DOC_VOCAB)), path)
    model = pl.load_model(spark, path)
    pt = pl.suggest_tags(standin.new_posts(spark, d), ["conv_id", "turn"], model, TOP_POST_TAGS)
    return pt.join(model.tags, "tag_id").select("conv_id", "turn", "rank", "tag_id", "tag_name", "sim")


# ---- described in the README -----------------------------------------------------------------

@register("cooccurrence")
def q_cooccurrence(spark, d):
    return co.cooccurrence(standin.baskets(spark, d))


@register("cooccurrence_normalized")
def q_cooccurrence_normalized(spark, d):
    c = co.cooccurrence_normalized(standin.baskets(spark, d))
    return c.select("tag_a", "tag_b", "n", _r("weight").alias("weight"))


@register("usage_trend")
def q_usage_trend(spark, d):
    return co.usage_trend(standin.usage(spark, d), "1 day")


# ---- streaming forms (same results as the batch queries) -----------------------------------------

@register("usage_trend_stream")
def q_usage_trend_stream(spark, d):
    from labelnet.streaming import usage
    out = usage.run_usage_stream(spark, d, "events.parquet", "1 day")
    return usage.latest_counts(spark, out)


@register("post_tags_stream")
def q_post_tags_stream(spark, d):
    from labelnet.streaming import tagging
    lv = pl.label_vectors(spark, d, DOC_VOCAB)
    out = tagging.run_tagging_stream(spark, d, lv, TOP_POST_TAGS, "conversations.parquet")
    names = lv.tags.select(F.col("id").alias("tag_id"), "tag_name")
    return (spark.read.parquet(out).join(names, "tag_id")
            .select("conv_id", "turn", "rank", "tag_id", "tag_name", "sim"))
