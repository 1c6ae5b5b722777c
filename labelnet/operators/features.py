"""Features: term counts, vocabulary, idf, TF-IDF, per-label means, stemming jobs.

Vectors stay in long form ``(key, idx, w)`` until the similarity step, so
sparse documents never become 1,000-wide dense rows.

TF-IDF follows the reference's vectoriser: raw counts, top-N terms by corpus
frequency (ties broken by term, ascending), smoothed idf
``ln((1+n)/(1+df)) + 1``, L2-normalised rows. Term index = position of the
term in alphabetical order among the kept terms.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelnet.functions import porter
from labelnet.functions import text as tx
from labelnet.session import cut
from labelnet.util import checked_broadcast

MIN_TOKEN_LEN = 2  # the vectoriser keeps tokens of 2+ word characters


def tf_tokens(tokens: Column) -> Column:
    return F.filter(tokens, lambda t: F.length(t) >= MIN_TOKEN_LEN)


def usable_terms(texts: DataFrame, min_score: int = 1, url_first: bool = False, stem: bool = False,
                 key: str = "post_id", full: bool = False) -> DataFrame:
    """``(key, term)`` rows of usable posts (score >= min, non-blank cleaned title
    and body), plus one null-term marker row per usable post. ``stem``: terms are stemmed; ``full``: stemmed and
    lemmatised (``token_map``, with the corpus' own words as dictionary).

    The usability test sits inside the generator instead of a Filter: a
    Filter on the token columns would be pushed below the projection and
    run the whole cleaning chain a second time.
    """
    if full and stem:
        raise ValueError("the full chain stems already")
    t = (texts.where(F.col("score") >= min_score)
         .select(key, tx.clean_tokens(F.col("body"), url_first).alias("tokens"),
                 tx.clean_tokens(F.col("title"), url_first).alias("tt")))
    ok = (F.size("tokens") > 0) & (F.size("tt") > 0)
    none = F.array().cast("array<string>")
    if stem or full:
        # the words are mapped before they are counted, so that no row of an occurrence is sorted or hashed by its word
        t = chunked(t.select(key, F.when(ok, F.col("tokens")).otherwise(none).alias("tokens")), "usable-tokens")
        words = chunk_words(t)
        # the stems are written: the filter on them would move into the stemmer's steps, each of which names the last many times
        mapped = token_map(words) if full else cut(stem_vocabulary(words).withColumnRenamed("stem", "token"), "term-stems")
        t, ok = map_tokens(t, words, mapped), F.size("tokens") > 0
    gen = F.when(ok, F.concat(F.array(F.lit(None).cast("string")), tf_tokens(F.col("tokens")))).otherwise(none)
    return t.select(key, F.explode(gen).alias("term"))


def term_counts(long: DataFrame, key: str = "post_id") -> DataFrame:
    """``(key, term, tf)`` from ``(key, term)`` rows (marker rows keep tf = 1, term null)."""
    return long.groupBy(key, "term").agg(F.count(F.lit(1)).alias("tf"))


def document_ids(tf: DataFrame, key: str = "post_id") -> DataFrame:
    """The documents of a term-count table (one marker row each)."""
    return tf.where(F.col("term").isNull()).select(key)


def term_stats(tf: DataFrame) -> DataFrame:
    """``(term, freq, df)``: corpus frequency and document frequency."""
    return (tf.where(F.col("term").isNotNull()).groupBy("term")
            .agg(F.sum("tf").alias("freq"), F.count(F.lit(1)).alias("df")))


def vocabulary(tf: DataFrame, size: int) -> DataFrame:
    """``(term, idx, freq, df)``: the ``size`` most frequent terms.

    Top-N is a TakeOrderedAndProject (bounded by ``size``); the index window
    runs over those ``size`` rows only.
    """
    top = term_stats(tf).orderBy(F.desc("freq"), F.asc("term")).limit(size)
    return top.withColumn("idx", (F.row_number().over(Window.orderBy("term")) - 1).cast("int"))


def n_documents(tf: DataFrame, key: str = "post_id") -> Column:
    """Number of documents (marker rows) as a scalar subquery column."""
    return tf.where(F.col("term").isNull()).select(F.count(F.lit(1))).scalar()


def idf_column(df_col: Column, n_docs: Column) -> Column:
    return F.log((F.lit(1.0) + n_docs) / (F.lit(1.0) + df_col)) + F.lit(1.0)


@dataclass
class TfidfModel:
    """Fitted vocabulary ``(term, idx, idf)``; ``size`` bounds its row count."""
    vocab: DataFrame
    size: int


def fit_tfidf(tf: DataFrame, size: int, key: str = "post_id") -> TfidfModel:
    v = vocabulary(tf, size)
    v = v.select("term", "idx", idf_column(F.col("df"), n_documents(tf, key)).alias("idf"))
    return TfidfModel(v, size)


def tfidf_transform(tf: DataFrame, model: TfidfModel, key: str = "post_id") -> DataFrame:
    """``(key, idx, w)`` L2-normalised TF-IDF weights of the terms in the vocabulary.

    The vocabulary side is at most ``size`` rows (checked broadcast); the
    norm is a window per document (at most ``size`` rows each).
    """
    j = tf.join(checked_broadcast(model.vocab, model.size), "term")
    w = F.col("tf") * F.col("idf")
    j = j.select(key, "idx", w.alias("w"))
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy(key)))
    return j.select(key, "idx", (F.col("w") / norm).alias("w"))


def label_means(weights: DataFrame, members: DataFrame, key: str = "post_id", label: str = "tag_id") -> DataFrame:
    """Element-wise mean vector per label ``(label, idx, w)``.

    ``members``: ``(label, key)`` pairs restricted to usable documents. The
    divisor counts every member, including members whose vector is zero.
    Both sums are partial + final aggregates, so a label holding a third of
    all rows is combined map-side before the shuffle.
    """
    n = members.groupBy(label).agg(F.count(F.lit(1)).alias("n_posts"))
    sums = members.join(weights, key).groupBy(label, "idx").agg(F.sum("w").alias("s"))
    return sums.join(n, label).select(label, "idx", (F.col("s") / F.col("n_posts")).alias("w"))


def dense_vectors(long: DataFrame, key: str, dim: int) -> DataFrame:
    """Long form -> ``(key, vector array<double>)`` of length ``dim`` (zeros filled).

    One group per key holding at most ``dim`` entries.
    """
    m = long.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("idx", "w"))).alias("m"))
    return m.select(key, F.transform(F.sequence(F.lit(0), F.lit(dim - 1)),
                                     lambda i: F.coalesce(F.element_at("m", i), F.lit(0.0))).alias("vector"))


def sparse_arrays(long: DataFrame, key) -> DataFrame:
    """Long form -> ``(key..., idxs array<int>, vals array<double>)``, bounded by the dimension."""
    keys = [key] if isinstance(key, str) else list(key)
    return (long.groupBy(*keys)
            .agg(F.collect_list(F.struct(F.col("idx").cast("int").alias("i"), F.col("w").cast("double").alias("v"))).alias("e"))
            .select(*keys, F.col("e.i").alias("idxs"), F.col("e.v").alias("vals")))


def array_to_sparse(df: DataFrame, vec: str = "vector") -> DataFrame:
    """Dense ``array<double>`` column -> ``idxs, vals`` columns (all positions)."""
    return (df.withColumn("vals", F.col(vec).cast("array<double>"))
            .withColumn("idxs", F.sequence(F.lit(0), F.size(vec) - 1)).drop(vec))


# ---- stemming and lemmas as vocabulary jobs ---------------------------------

def stem_vocabulary(tokens_long: DataFrame, term: str = "term") -> DataFrame:
    """``(term, stem)`` for each distinct term: the stemmer's expressions run once per distinct word, not once per
    occurrence, and no Python runs at all."""
    return porter.stems(tokens_long.select(term).where(F.col(term).isNotNull()).distinct(), term)


# WordNet's noun detachment rules (suffix -> replacement), in its order.
NOUN_DETACHMENT = [("s", ""), ("ses", "s"), ("xes", "x"), ("zes", "z"), ("ches", "ch"),
                   ("shes", "sh"), ("men", "man"), ("ies", "y")]


def lexicon_from_corpus(terms: DataFrame, term: str = "term") -> DataFrame:
    """``(form, lemma)`` from the corpus itself: a form maps to the result of the
    first detachment rule whose output is also a corpus word (the dictionary
    check of the noun lemmatiser, with the corpus vocabulary as dictionary)."""
    # the vocabulary is written once (the corpus is cleaned once), and every form names all its candidates in one pass
    vocab = cut(terms.select(F.col(term).alias("form")).where(F.col("form").isNotNull()).distinct(), "lexicon-vocabulary")
    rules = [F.when(F.col("form").endswith(suf) & (F.length("form") > len(suf)),
                    F.struct(F.lit(rank).alias("rank"), F.concat(F.expr(f"left(form, length(form) - {len(suf)})"), F.lit(rep)).alias("lemma")))
             for rank, (suf, rep) in enumerate(NOUN_DETACHMENT)]
    cands = vocab.select("form", F.explode(F.array_compact(F.array(*rules))).alias("c")).select("form", "c.rank", "c.lemma")
    known = cands.join(vocab.select(F.col("form").alias("lemma")), "lemma", "left_semi")
    best = known.groupBy("form").agg(F.min(F.struct("rank", "lemma")).alias("b"))
    return best.select("form", F.col("b.lemma").alias("lemma"))


# Irregular plurals (form, lemma), looked up before the rules; callers with a whole exception list pass it as a table.
IRREGULAR_NOUNS = [("children", "child"), ("oxen", "ox"), ("feet", "foot"), ("teeth", "tooth"), ("geese", "goose"), ("mice", "mouse"),
                   ("lice", "louse"), ("dice", "die"), ("data", "datum"), ("media", "medium"), ("criteria", "criterion"),
                   ("phenomena", "phenomenon"), ("indices", "index"), ("matrices", "matrix"), ("vertices", "vertex"), ("axes", "axis"),
                   ("analyses", "analysis"), ("wolves", "wolf"), ("leaves", "leaf"), ("knives", "knife"), ("lives", "life"), ("selves", "self")]


def irregular_nouns(spark) -> DataFrame:
    return spark.createDataFrame(IRREGULAR_NOUNS, "form string, lemma string")


def lemma_map(terms: DataFrame, dictionary: DataFrame, exceptions: DataFrame | None = None, term: str = "term") -> DataFrame:
    """``(form, lemma)`` for each distinct term: the noun lemmatiser with a dictionary given as data.

    ``dictionary``: (word); ``exceptions``: (form, lemma), irregular forms. A form in the exceptions can become itself or
    one of those lemmas; any other can become itself or what a detachment rule leaves of it, and only if none of these is a
    dictionary word, what further detachments leave. Of the first candidates that the dictionary has, the shortest wins
    (then the one with fewer detachments, then in alphabetical order); without one, the form stays as it is.
    """
    spark = terms.sparkSession
    exceptions = irregular_nouns(spark) if exceptions is None else exceptions
    forms = cut(terms.select(F.col(term).alias("form")).where(F.col("form").isNotNull()).distinct(), "lemma-forms")
    odd = exceptions.select("form", F.col("lemma").alias("word")).distinct()
    rules = [F.when(F.col("word").endswith(suf) & (F.length("word") > len(suf)),
                    F.concat(F.expr(f"left(word, length(word) - {len(suf)})"), F.lit(rep))) for suf, rep in NOUN_DETACHMENT]
    step = forms.join(odd.select("form").distinct(), "form", "left_anti").select("form", F.col("form").alias("word"), F.lit(0).alias("depth"))
    every = forms.select("form", F.col("form").alias("word"), F.lit(0).alias("depth")).unionByName(
        odd.join(forms, "form", "left_semi").select("form", "word", F.lit(1).alias("depth")))
    while True:                               # a word gets shorter with each detachment but ``men``, which is the last
        step = cut(step.select("form", F.explode(F.array_compact(F.array(*rules))).alias("word"), (F.col("depth") + 1).alias("depth")).distinct(), "lemma-step")
        if step.isEmpty():
            break
        every = every.unionByName(step)
    known = every.join(dictionary.select("word").distinct(), "word", "left_semi")
    first = F.struct(F.greatest("depth", F.lit(1)).alias("round"), F.length("word").alias("n"), "depth", "word")
    best = known.groupBy("form").agg(F.min(first).alias("b"))
    return forms.join(best, "form", "left").select("form", F.coalesce("b.word", "form").alias("lemma"))


def token_map(terms: DataFrame, dictionary: DataFrame | None = None, exceptions: DataFrame | None = None, term: str = "term") -> DataFrame:
    """``(term, token)`` for each distinct term: stemmed, then lemmatised, once for the whole corpus; texts, vocabularies and
    later posts are mapped by one join with it. Without a ``dictionary`` the corpus' own words are it."""
    words = cut(terms.select(F.col(term).alias("term")).where(F.col("term").isNotNull()).distinct(), "map-words")
    stems = cut(porter.stems(words, "term"), "map-stems")
    own = words.select(F.col("term").alias("word")) if dictionary is None else dictionary
    lemmas = lemma_map(stems, own, exceptions, "stem")
    return stems.join(lemmas.withColumnRenamed("form", "stem"), "stem").select("term", F.col("lemma").alias("token"))


CHUNK_BITS = 11               # 2 ** 11 rows at most have their words mapped at a time
PART_TOKENS = 2_000_000       # tokens that a task maps, about


def chunked(rows: DataFrame, name: str = "chunked") -> DataFrame:
    """``rows`` (..., tokens) written once, with ``chunk``: the same number for up to 2 ** CHUNK_BITS rows that a task wrote in a row."""
    return cut(rows.withColumn("chunk", F.shiftright(F.monotonically_increasing_id(), CHUNK_BITS)), name)


def chunk_words(rows: DataFrame) -> DataFrame:
    """``(chunk, term)``: the distinct words of each chunk of ``chunked`` rows."""
    return cut(rows.select("chunk", F.explode("tokens").alias("term")).distinct(), "chunk-words")


def _map_chunk(left: pa.Table, right: pa.Table) -> pa.Table:
    """The rows of one chunk with the words that ``right`` (term, token) holds replaced."""
    left, right = left.combine_chunks(), right.combine_chunks()
    lists = pc.fill_null(pc.list_value_length(left["tokens"]), 0).to_numpy()
    flat = pc.list_flatten(left["tokens"])
    token = pc.coalesce(right["token"].take(pc.index_in(flat, value_set=right["term"])), flat).combine_chunks()
    ends = np.concatenate([[0], np.cumsum(lists)]).astype(np.int32)
    done = pa.ListArray.from_arrays(pa.array(ends, mask=np.append(left["tokens"].is_null().to_numpy(), False)), token)
    left = left.drop_columns(["chunk"])
    return left.set_column(left.schema.get_field_index("tokens"), "tokens", done)


def map_tokens(rows: DataFrame, words: DataFrame, mapping: DataFrame) -> DataFrame:
    """``chunked`` rows without ``chunk``, their ``tokens`` mapped by ``mapping`` (term, token); unknown words stay.

    ``words``: their ``chunk_words``. A chunk's distinct words meet the mapping, not every occurrence, and then the
    chunk's rows. The partitions are as many as the tokens ask for, so that a task's share doesn't grow with the corpus.
    """
    total = rows.agg(F.sum(F.size("tokens"))).first()[0] or 0
    parts = max(rows.sparkSession.sparkContext.defaultParallelism, -(-total // PART_TOKENS))
    pairs = words.join(mapping, "term").where("token <> term").select("chunk", "term", "token")
    schema = T.StructType([f for f in rows.schema.fields if f.name != "chunk"])
    return rows.repartition(parts, "chunk").groupBy("chunk").cogroup(pairs.groupBy("chunk")).applyInArrow(_map_chunk, schema)


def mapped_text(tokens: DataFrame, key: str, mapping: DataFrame, words: DataFrame | None = None) -> DataFrame:
    """``(key, text)``: rows of (key, tokens array) with every token mapped, in order, joined by blanks. Rows of one key
    share the text of all their tokens, by place; a null key has none. ``words``: the ``chunk_words`` of ``tokens``,
    if these are ``chunked`` already."""
    if words is None:
        tokens = chunked(tokens.select(key, "tokens"))
        words = chunk_words(tokens)
    done = map_tokens(tokens.select(key, "tokens", "chunk"), words, mapping)
    again = cut(tokens.groupBy(key).count().where(F.col(key).isNotNull() & (F.col("count") > 1)).select(key), "repeated-keys")
    text = F.when(F.col(key).isNotNull(), F.coalesce(F.array_join("tokens", " "), F.lit(""))).otherwise(F.lit(""))
    if again.isEmpty():
        return done.select(key, text.alias("text"))
    done = cut(done, "mapped-tokens")
    each = F.struct("at", "token")
    long = done.join(again, key, "left_semi").select(key, F.posexplode("tokens").alias("at", "token"))
    both = long.groupBy(key).agg(F.array_join(F.transform(F.sort_array(F.collect_list(each)), lambda x: x["token"]), " ").alias("text"))
    shared = done.join(again, key, "left_semi").select(key).join(both, key, "left").select(key, F.coalesce("text", F.lit("")).alias("text"))
    return done.join(again, key, "left_anti").select(key, text.alias("text")).unionByName(shared)


def apply_lexicon(long: DataFrame, lexicon: DataFrame, term: str = "term") -> DataFrame:
    """Left join tokens to a ``(form, lemma)`` table; unknown forms stay."""
    lx = lexicon.select(F.col("form").alias(term), "lemma")
    return long.join(lx, term, "left").withColumn(term, F.coalesce("lemma", term)).drop("lemma")
