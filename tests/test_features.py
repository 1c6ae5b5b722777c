import math

from pyspark.sql import functions as F

from labelnet.operators import features as fe
from labelnet.operators import relate as rl

DOCS = [
    (1, "apple banana apple", "head", 1),
    (2, "banana cherry", "head", 1),
    (3, "x z", "head", 1),                 # only 1-letter tokens: usable, but no term rows
    (4, "apple", "   ", 1),             # blank title: not usable
    (5, "cherry date", "head", 0),         # score 0: not usable
    (6, "cherry", "head", None),           # no score: not usable
]


def texts(spark):
    return spark.createDataFrame(DOCS, "post_id long, body string, title string, score int")


def test_usable_terms_and_counts(spark):
    tf = fe.term_counts(fe.usable_terms(texts(spark)))
    rows = {(r.post_id, r.term): r.tf for r in tf.collect()}
    assert rows == {(1, None): 1, (1, "apple"): 2, (1, "banana"): 1, (2, None): 1, (2, "banana"): 1,
                    (2, "cherry"): 1, (3, None): 1}
    assert sorted(r.post_id for r in fe.document_ids(tf).collect()) == [1, 2, 3]
    # same rows as the string form of the filter
    assert sorted(r.post_id for r in rl.usable_posts(texts(spark)).collect()) == [1, 2, 3]


def test_vocabulary_ties_and_idf(spark):
    tf = fe.term_counts(fe.usable_terms(texts(spark)))
    # freq: apple 2, banana 2, cherry 1 -> top 2 cut inside no tie; top 1 cut inside a tie (apple < banana)
    v1 = [r.term for r in fe.vocabulary(tf, 1).collect()]
    assert v1 == ["apple"]
    m = fe.fit_tfidf(tf, 3)
    got = {r.term: (r.idx, r.idf) for r in m.vocab.collect()}
    n = 3  # documents, including the one without terms
    assert got["apple"][0] == 0 and got["banana"][0] == 1 and got["cherry"][0] == 2
    assert math.isclose(got["banana"][1], math.log((1 + n) / (1 + 2)) + 1)
    assert math.isclose(got["apple"][1], math.log((1 + n) / (1 + 1)) + 1)


def test_tfidf_rows_are_unit_length(spark):
    tf = fe.term_counts(fe.usable_terms(texts(spark)))
    w = fe.tfidf_transform(tf, fe.fit_tfidf(tf, 10))
    norms = w.groupBy("post_id").agg(F.sum(F.col("w") * F.col("w")).alias("n")).collect()
    assert {r.post_id for r in norms} == {1, 2}
    assert all(math.isclose(r.n, 1.0) for r in norms)


def test_label_means_count_zero_vectors(spark):
    weights = spark.createDataFrame([(1, 0, 1.0), (2, 1, 1.0)], "post_id long, idx int, w double")
    members = spark.createDataFrame([(10, 1), (10, 2), (10, 3), (20, 3)], "tag_id long, post_id long")
    got = {(r.tag_id, r.idx): r.w for r in fe.label_means(weights, members).collect()}
    # post 3 has a zero vector: tag 10 divides by 3; tag 20 has no rows (zero vector)
    assert got == {(10, 0): 1 / 3, (10, 1): 1 / 3}


def test_dense_vectors(spark):
    long = spark.createDataFrame([(1, 0, 0.5), (1, 2, 0.25)], "k long, idx int, w double")
    assert fe.dense_vectors(long, "k", 4).first().vector == [0.5, 0.0, 0.25, 0.0]


def test_stem_and_lexicon(spark):
    long = spark.createDataFrame([(1, "ponies"), (1, "cats"), (2, "cat"), (2, "boxes"), (2, "box")],
                                 "post_id long, term string")
    stems = {r.term: r.stem for r in fe.stem_vocabulary(long).collect()}
    assert stems["ponies"] == "poni" and stems["cats"] == "cat"
    lex = {r.form: r.lemma for r in fe.lexicon_from_corpus(long).collect()}
    assert lex == {"cats": "cat", "boxes": "box"}   # 'ponies' -> 'pony' is not a corpus word
    applied = {r.term for r in fe.apply_lexicon(long, fe.lexicon_from_corpus(long)).collect()}
    assert applied == {"ponies", "cat", "box"}


def test_lemmas_of_irregular_and_unknown_nouns(spark):
    forms = "feet foots cats cat glasses glass classes women boxes ponies geese mens buses mss zzzs men data s analyses".split()
    terms = spark.createDataFrame([(t,) for t in forms] + [(None,), ("cats",)], "term string")
    words = spark.createDataFrame([(w,) for w in "foot cat glass glasse class woman box pony man men bus ms analysis".split()], "word string")
    got = {r.form: r.lemma for r in fe.lemma_map(terms, words).collect()}
    assert got == {"feet": "foot", "foots": "foot", "cats": "cat", "cat": "cat", "glasses": "glass", "glass": "glass", "classes": "class",
                   "women": "woman", "boxes": "box", "ponies": "pony", "geese": "geese",      # goose isn't in the dictionary
                   "mens": "men", "buses": "bus", "mss": "ms", "zzzs": "zzzs", "men": "men",   # of equal length, the form itself
                   "data": "data", "s": "s", "analyses": "analysis"}
    own = spark.createDataFrame([("geese", "man"), ("geese", "cat")], "form string, lemma string")
    assert {r.form: r.lemma for r in fe.lemma_map(terms, words, own).collect()}["geese"] == "cat"
    twice = fe.lemma_map(spark.createDataFrame([("catss",)], "term string"), words)
    assert twice.first().lemma == "cat"                    # no dictionary word after one detachment, one after two
    assert fe.lemma_map(terms.limit(0), words).count() == 0


def test_full_chain_maps_every_token_in_order(spark):
    docs = spark.createDataFrame([(1, ["running", "cats", "cats", "relational"]), (2, []), (3, ["women"])], "k long, tokens array<string>")
    long = docs.select(F.explode("tokens").alias("term")).unionByName(spark.createDataFrame([("woman",)], "term string"))
    m = fe.token_map(long)
    assert {r.term: r.token for r in m.collect()} == {"running": "run", "cats": "cat", "relational": "relat", "women": "women", "woman": "woman"}
    got = {r.k: r.text for r in fe.mapped_text(docs, "k", m).collect()}
    assert got == {1: "run cat cat relat", 2: "", 3: "women"}     # equally long: the word itself


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_words_are_mapped_by_chunks_not_by_occurrence(spark):
    """only a chunk's distinct words meet the mapping; no occurrence becomes a row of its own."""
    many = [(i, ["cats", "run", f"w{i % 7}"] * 50) for i in range(300)]
    odd = [(900, None), (901, []), (902, ["unknown"]), (903, ["b", "a"]), (903, ["cats", "z"]), (None, ["cats"])]
    rows = spark.createDataFrame(many + odd, "k long, tokens array<string>")
    mapping = spark.createDataFrame([("cats", "cat"), ("run", "run"), ("w3", "three"), ("never", "seen")], "term string, token string")
    out = fe.mapped_text(rows.where("k is null or k <> 903"), "k", mapping)
    assert "posexplode" not in plan_of(out) and out.columns == ["k", "text"]
    got = {r.k: r.text for r in out.collect()}
    to = {"cats": "cat", "w3": "three"}
    assert got == {k: " ".join(to.get(t, t) for t in ts) for k, ts in many} | {900: "", 901: "", 902: "unknown", None: ""}
    # rows of one key share the text of all their tokens, by place and then by token
    both = [(r.k, r.text) for r in fe.mapped_text(rows, "k", mapping).collect()]
    assert sorted(x for x in both if x[0] == 903) == [(903, "b cat a z")] * 2 and len(both) == len(many) + len(odd)


def test_chunks_hold_few_rows_and_their_own_words(spark, monkeypatch):
    monkeypatch.setattr(fe, "CHUNK_BITS", 3)
    monkeypatch.setattr(fe, "PART_TOKENS", 40)
    rows = fe.chunked(spark.createDataFrame([(i, ["as", f"x{i}s", "as"]) for i in range(100)], "k long, tokens array<string>"))
    assert max(r["count"] for r in rows.groupBy("chunk").count().collect()) <= 8
    words = fe.chunk_words(rows)
    assert words.count() == words.distinct().count() == 100 + rows.select("chunk").distinct().count()
    mapping = words.select("term").distinct().select("term", F.expr("left(term, length(term) - 1)").alias("token"))
    out = fe.map_tokens(rows, words, mapping)
    assert out.rdd.getNumPartitions() == 8              # 300 tokens of 40 for each
    assert {r.k: r.tokens for r in out.collect()} == {i: ["a", f"x{i}", "a"] for i in range(100)}


def test_stemmed_and_full_terms_are_mapped_before_they_are_rows(spark):
    """the words of a post are mapped while they are its array; its rows go straight into their counts."""
    docs = [(1, "cats running cats", "head", 1), (1, "cats", "head", 1), (2, "x z", "head", 1), (3, "ponies", "  ", 1), (4, "cats", "head", 0),
            (None, "cat flies", "head", 2), (5, None, "head", 1)]
    df = spark.createDataFrame(docs, "post_id long, body string, title string, score int")
    for kind, other in (("stem", "fli"), ("full", "fli")):
        long = fe.usable_terms(df, **{kind: True})
        assert "Generate explode" in plan_of(long)
        got = sorted((str(r.post_id), str(r.term), r.tf) for r in fe.term_counts(long).collect())
        assert got == sorted([("1", "None", 2), ("1", "cat", 3), ("1", "run", 1), ("2", "None", 1), ("None", "None", 1), ("None", "cat", 1), ("None", other, 1)])
