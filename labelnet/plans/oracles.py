"""Oracle SQL per named query (DuckDB over the raw tables).

Queries without an entry here are checked rows-only: ``hashed_tfidf``
(Spark ML hashing), ``louvain`` (iterative with accept/reject rounds).
"""

from __future__ import annotations

from labelnet.operators.features import NOUN_DETACHMENT
from labelnet.plans import queries as Q
from labelnet.plans import sqlparts as S

ORACLES: dict[str, str] = {}


def oracle(name: str):
    def deco(fn):
        ORACLES[name] = fn()
        return fn
    return deco


B = S.base_parts
W = S.with_

TP = ("tp", """SELECT tag_name, CAST(floor(post_id / 1000000) AS BIGINT) AS id_block, list_sort(list(post_id)) AS post_ids
FROM post_tags_raw GROUP BY tag_name, floor(post_id / 1000000)""")

EMB = [
    ("emb", """SELECT vec_id AS tag_id, vec_id AS ord, CAST(embedding AS DOUBLE[]) AS vector, CAST(label AS BIGINT) AS label
FROM embeddings"""),
    ("emb_long", """SELECT tag_id, label, unnest(generate_series(0, len(vector) - 1)) AS idx, unnest(vector) AS w FROM emb"""),
    ("evert", "SELECT tag_id AS id, CAST(tag_id AS VARCHAR) AS name FROM emb"),
]


def emb_graph(threshold: float, inclusive: bool = False):
    return EMB + S.pair_edges_parts("emb_long", "tag_id", threshold, inclusive)


def doc_graph(inclusive: bool = False, stem: bool = False, full: bool = False):
    return S.label_vector_parts(Q.DOC_VOCAB, stem=stem, full=full) + S.pair_edges_parts("tv", "tag_id", Q.DOC_THRESHOLD, inclusive)


UND = ("ue", "SELECT src, dst, weight FROM edges UNION ALL SELECT dst, src, weight FROM edges")

DENSE = ("dense", f"""SELECT t.id AS tag_id, list(round(coalesce(tv.w, 0.0), 6) ORDER BY i.idx) AS vector
FROM tags t CROSS JOIN (SELECT CAST(range AS INTEGER) AS idx FROM range({Q.DOC_VOCAB})) i
LEFT JOIN tv ON tv.tag_id = t.id AND tv.idx = i.idx GROUP BY t.id""")


# ---- sources and sinks ----------------------------------------------------------------

@oracle("scan_posts")
def _():
    return W(B(), "SELECT id, title, body, tags, parent_id, score FROM posts")


@oracle("scan_csv_tags")
def _():
    return W(B(), "SELECT id, tag_name, count, excerpt_post_id, wiki_post_id FROM tags")


@oracle("parse_post_id_list")
def _():
    return W(B() + [TP], "SELECT t.id AS tag_id, t.tag_name, tp.id_block, tp.post_ids FROM tags t JOIN tp USING (tag_name)")


@oracle("first_n_vectors")
def _():
    return f"""SELECT vec_id AS tag_id, vec_id AS ord, CAST(embedding AS DOUBLE[]) AS vector
FROM embeddings WHERE vec_id < {Q.FIRST_N}"""


@oracle("tag_dictionary")
def _():
    return W(B(), "SELECT id AS tag_id, tag_name FROM tags")


@oracle("dictionary_roundtrip")
def _():
    return W(B(), "SELECT id AS tag_id, tag_name FROM tags")


@oracle("vector_roundtrip")
def _():
    return W(S.label_vector_parts(Q.DOC_VOCAB) + [DENSE], "SELECT tag_id, tag_id AS ord, vector FROM dense")


# ---- relational layer ---------------------------------------------------------------------

@oracle("cap_rows")
def _():
    return W(B(), f"SELECT id, title, tags, score FROM posts ORDER BY id LIMIT {Q.CAP}")


@oracle("post_text_union")
def _():
    return W(B() + [S.TEXTS], "SELECT post_id, body, title, score FROM texts")


@oracle("tagged_posts")
def _():
    return W(B(), "SELECT id, tags FROM posts WHERE tags <> ''")


@oracle("usable_posts")
def _():
    return W(B() + [S.TEXTS, ("c", f"""SELECT post_id, {S.clean_text_sql('body')} AS body, {S.clean_text_sql('title')} AS title, score
FROM texts WHERE score >= 1""")],
             "SELECT post_id, body, title, score FROM c WHERE trim(title) <> '' AND trim(body) <> ''")


@oracle("post_tag_pairs")
def _():
    return W(B(), "SELECT post_id, tag_name FROM post_tags_raw")


@oracle("tag_posts")
def _():
    return W(B() + [TP], """SELECT t.tag_name, t.id AS tag_id, t.count, t.excerpt_post_id, t.wiki_post_id, tp.id_block, tp.post_ids
FROM tags t JOIN tp USING (tag_name)""")


@oracle("tag_posts_csv")
def _():
    return W(B() + [TP], """SELECT t.id AS tag_id, t.tag_name, tp.id_block, array_to_string(tp.post_ids, ',') AS post_ids, tp.post_ids AS parsed
FROM tags t JOIN tp USING (tag_name)""")


@oracle("overwrite_first_n")
def _():
    v = S.q(Q.OVERWRITE_VALUE)
    return W(B() + [TP, ("x", """SELECT t.id AS tag_id, t.tag_name, tp.id_block, array_to_string(tp.post_ids, ',') AS post_ids
FROM tags t JOIN tp USING (tag_name)""")],
             f"""SELECT tag_id, tag_name, CASE WHEN tag_id IN (SELECT DISTINCT tag_id FROM x ORDER BY tag_id LIMIT {Q.OVERWRITE_N})
THEN {v} ELSE post_ids END AS post_ids, id_block FROM x""")


@oracle("dataset_counts")
def _():
    return W(B() + [TP, S.TEXTS], """SELECT (SELECT count(*) FROM tags t JOIN tp USING (tag_name)) AS n_tags,
       (SELECT count(*) FROM texts) AS n_posts""")


@oracle("lookup_tag")
def _():
    return W(B(), """SELECT id AS tag_id, tag_name, count FROM tags
WHERE tag_name IN (SELECT DISTINCT lang FROM documents)""")


# ---- text ---------------------------------------------------------------------------------------

@oracle("html_to_text")
def _():
    return f"SELECT page_id, {S.html_sql('html')} AS text FROM pages"


@oracle("normalize_text")
def _():
    return f"SELECT doc_id, {S.normalize_sql('text')} AS text FROM documents"


@oracle("strip_urls")
def _():
    return f"SELECT page_id, {S.strip_urls_sql(S.normalize_sql('url'))} AS url FROM pages"


@oracle("remove_stopwords")
def _():
    toks = S.tokens_sql(S.normalize_sql("text"))
    return (f"SELECT doc_id, array_to_string(list_filter({toks}, lambda t: NOT list_contains({S.stop_list()}, t)), ' ') AS text "
            "FROM documents")


@oracle("clean_text")
def _():
    return f"SELECT doc_id, {S.clean_text_sql('text')} AS text FROM documents"


@oracle("lexicon_normalize")
def _():
    rules = ", ".join(f"({S.q(s)}, {S.q(r)}, {i})" for i, (s, r) in enumerate(NOUN_DETACHMENT))
    return W([
        ("terms", f"SELECT DISTINCT unnest({S.clean_tokens_sql('text')}) AS form FROM documents"),
        ("rules", f"SELECT * FROM (VALUES {rules}) AS r(suf, rep, rnk)"),
        ("cands", """SELECT form, substr(form, 1, length(form) - length(suf)) || rep AS lemma, rnk
FROM terms CROSS JOIN rules WHERE ends_with(form, suf) AND length(form) > length(suf)"""),
        ("known", "SELECT * FROM cands WHERE lemma IN (SELECT form FROM terms)"),
    ], "SELECT form, arg_min(lemma, rnk) AS lemma FROM known GROUP BY form")


@oracle("stem_vocabulary")
def _():
    return W([("words", f"SELECT DISTINCT unnest({S.clean_tokens_sql('text')}) AS term FROM documents")] + S.stem_parts("words", "term", "st"),
             "SELECT term, stem FROM st")


@oracle("lemmatise_vocabulary")
def _():
    return W([("words", f"SELECT DISTINCT unnest({S.clean_tokens_sql('text')}) AS term FROM documents")]
             + S.lemma_parts("words", "term", "words", "term", "lem"), "SELECT form, lemma FROM lem", recursive=True)


@oracle("clean_text_full")
def _():
    return W([("t", f"SELECT row_number() OVER () AS n, doc_id, {S.clean_tokens_sql('text')} AS ts FROM documents"),
              ("x", "SELECT n, unnest(ts) AS term, unnest(range(len(ts))) AS place FROM t"),
              ("words", "SELECT DISTINCT term FROM x")] + S.token_map_parts("words", "m") + [
              ("y", "SELECT n, string_agg(token, ' ' ORDER BY place) AS text FROM x JOIN m USING (term) GROUP BY n")],
             "SELECT doc_id, coalesce(y.text, '') AS text FROM t LEFT JOIN y USING (n)", recursive=True)


# ---- features ------------------------------------------------------------------------------------

def _tfidf():
    return B() + S.usable_parts() + S.tfidf_parts(Q.DOC_VOCAB)


@oracle("vocabulary")
def _():
    return W(_tfidf(), """SELECT v.term, v.idx, CAST(s.freq AS BIGINT) AS freq, CAST(s.df AS BIGINT) AS df
FROM vocab v JOIN vocab0 s USING (term)""")


@oracle("idf")
def _():
    return W(_tfidf(), "SELECT term, idx, round(idf, 6) AS idf FROM vocab")


@oracle("post_tfidf")
def _():
    return W(_tfidf(), "SELECT post_id, idx, round(w, 6) AS w FROM w")


@oracle("tag_vectors")
def _():
    return W(S.label_vector_parts(Q.DOC_VOCAB), "SELECT tag_id, idx, round(w, 6) AS w FROM tv")


@oracle("dense_vectors")
def _():
    return W(S.label_vector_parts(Q.DOC_VOCAB) + [DENSE], "SELECT tag_id, vector FROM dense")


@oracle("cosine_pairs")
def _():
    return W(EMB + [
        ("cent", "SELECT label, idx, avg(w) AS c FROM emb_long GROUP BY label, idx"),
        ("dots", """SELECT e.tag_id, any_value(e.label) AS label, sum(e.w * c.c) AS d,
       sqrt(sum(e.w * e.w)) AS na, sqrt(sum(c.c * c.c)) AS nb
FROM emb_long e JOIN cent c USING (label, idx) GROUP BY e.tag_id"""),
    ], "SELECT tag_id, label, round(CASE WHEN na * nb = 0 THEN 0.0 ELSE d / (na * nb) END, 6) AS cos FROM dots")


# ---- similarity graph -------------------------------------------------------------------------------

@oracle("similarity_edges")
def _():
    return W(emb_graph(Q.EMB_EDGE_T), "SELECT src, dst, round(weight, 6) AS weight FROM edges")


@oracle("similarity_edges_all")
def _():
    return W(doc_graph(inclusive=True), """SELECT src, dst, round(weight, 6) AS weight FROM edges
UNION ALL SELECT dst, src, round(weight, 6) FROM edges
UNION ALL SELECT DISTINCT tag_id, tag_id, 1.0 FROM tv""")


@oracle("tag_pairs_count")
def _():
    return W(doc_graph(), """SELECT n AS n_tags, CAST(n * (n - 1) / 2 AS BIGINT) AS n_pairs, (SELECT count(*) FROM edges) AS n_edges
FROM (SELECT count(*) AS n FROM tags)""")


@oracle("graph_vertices")
def _():
    return W(doc_graph(), """SELECT id, name, id IN (SELECT src FROM edges UNION SELECT dst FROM edges) AS has_edge
FROM vertices""")


@oracle("graph_endpoints")
def _():
    return W(S.label_vector_parts(Q.DOC_VOCAB) + S.pair_edges_parts("tv", "tag_id", Q.ENDPOINT_T),
             "SELECT id, name FROM vertices WHERE id IN (SELECT src FROM edges UNION SELECT dst FROM edges)")


@oracle("undirected_edges")
def _():
    return W(emb_graph(Q.EMB_EDGE_T) + [UND], "SELECT src, dst, round(weight, 6) AS weight FROM ue")


@oracle("incident_edges")
def _():
    return W(emb_graph(Q.EMB_EDGE_T) + [UND], "SELECT src AS id, dst AS other, round(weight, 6) AS weight FROM ue")


def _components():
    return [UND, ("reach(id, comp)", """SELECT id, id FROM evert
UNION SELECT u.dst, r.comp FROM reach r JOIN ue u ON u.src = r.id""")]


@oracle("connected_components")
def _():
    return "WITH RECURSIVE " + W(emb_graph(Q.EMB_EDGE_T) + _components(),
                                 "SELECT id, min(comp) AS component FROM reach GROUP BY id")[len("WITH "):]


@oracle("split_communities")
def _():
    return W(emb_graph(Q.EMB_LP_T) + [
        UND,
        ("lab", "SELECT tag_id AS id, label FROM emb"),
        ("inn", "SELECT u.src, u.dst FROM ue u JOIN lab a ON a.id = u.src JOIN lab b ON b.id = u.dst WHERE a.label = b.label"),
        ("reach(id, comp)", "SELECT id, id FROM lab UNION SELECT i.dst, r.comp FROM reach r JOIN inn i ON i.src = r.id"),
    ], "SELECT id, min(comp) AS label FROM reach GROUP BY id", recursive=True)


@oracle("label_propagation")
def _():
    return W(emb_graph(Q.EMB_LP_T) + S.label_propagation_parts("evert", "edges", Q.ROUNDS),
             f"SELECT id, label FROM lp{Q.ROUNDS}")


@oracle("label_propagation_weighted")
def _():
    return W(emb_graph(Q.EMB_LP_T) + S.label_propagation_parts("evert", "edges", Q.ROUNDS, weighted=True),
             f"SELECT id, label FROM lp{Q.ROUNDS}")


@oracle("community_dense_labels")
def _():
    return W(emb_graph(Q.EMB_LP_T) + S.label_propagation_parts("evert", "edges", Q.ROUNDS),
             f"SELECT id, CAST(dense_rank() OVER (ORDER BY label) - 1 AS BIGINT) AS label FROM lp{Q.ROUNDS}")


@oracle("community_counts")
def _():
    parts = emb_graph(Q.EMB_EDGE_T) + _components() + S.label_propagation_parts("evert", "edges", Q.ROUNDS)
    return "WITH RECURSIVE " + W(parts, f"""SELECT (SELECT count(DISTINCT comp) FROM (SELECT id, min(comp) AS comp FROM reach GROUP BY id)) AS components,
       (SELECT count(DISTINCT label) FROM lp{Q.ROUNDS}) AS communities""")[len("WITH "):]


@oracle("modularity")
def _():
    return W(doc_graph() + [
        ("lab", "SELECT id, split_part(name, '-', 1) AS c FROM vertices"),
        ("ein", """SELECT sum(e.weight) AS inw FROM edges e JOIN lab a ON a.id = e.src JOIN lab b ON b.id = e.dst
WHERE a.c = b.c"""),
        ("deg", """SELECT l.c, sum(u.weight) AS deg FROM (SELECT src, weight FROM edges UNION ALL SELECT dst, weight FROM edges) u
JOIN lab l ON l.id = u.src GROUP BY l.c"""),
        ("tot", "SELECT sum(deg * deg) AS d2, sum(deg) / 2 AS m FROM deg"),
    ], "SELECT round(CASE WHEN m = 0 OR m IS NULL THEN 0.0 ELSE coalesce(inw, 0) / m - d2 / (4 * m * m) END, 6) AS modularity FROM tot, ein")


@oracle("merge_small_communities")
def _():
    lp = f"lp{Q.ROUNDS}"
    return W(emb_graph(Q.EMB_LP_T) + S.label_propagation_parts("evert", "edges", Q.ROUNDS) + [
        UND,
        ("sz", f"SELECT label, count(*) AS size FROM {lp} GROUP BY label"),
        ("x", f"""SELECT a.label AS ls, b.label AS ld, sum(CAST(u.weight AS DECIMAL(18,6))) AS w
FROM ue u JOIN {lp} a ON a.id = u.src JOIN {lp} b ON b.id = u.dst
WHERE a.label <> b.label AND a.label IN (SELECT label FROM sz WHERE size < {Q.MIN_COMMUNITY})
GROUP BY a.label, b.label"""),
        ("best", """SELECT ls, ld FROM (SELECT ls, ld, row_number() OVER (PARTITION BY ls ORDER BY w DESC, ld ASC) AS rn FROM x)
WHERE rn = 1"""),
    ], f"SELECT l.id, coalesce(b.ld, l.label) AS label FROM {lp} l LEFT JOIN best b ON b.ls = l.label")


@oracle("tag_communities")
def _():
    parts = doc_graph() + S.label_propagation_parts("vertices", "edges", Q.ROUNDS)
    return W(parts, f"SELECT v.id, v.name, l.label FROM vertices v JOIN lp{Q.ROUNDS} l USING (id)")


@oracle("tag_communities_first_tags")
def _():
    parts = S.label_vector_parts(Q.DOC_VOCAB) + [
        ("tvn", f"SELECT * FROM tv WHERE tag_id <= {Q.TAG_COUNT}"),
        ("vn", f"SELECT id, name FROM vertices WHERE id <= {Q.TAG_COUNT}"),
    ] + S.pair_edges_parts("tvn", "tag_id", Q.DOC_THRESHOLD) + S.label_propagation_parts("vn", "edges", Q.ROUNDS)
    return W(parts, f"SELECT v.id, v.name, l.label FROM vn v JOIN lp{Q.ROUNDS} l USING (id)")


@oracle("tag_communities_stemmed")
def _():
    parts = doc_graph(stem=True) + S.label_propagation_parts("vertices", "edges", Q.ROUNDS)
    return W(parts, f"SELECT v.id, v.name, l.label FROM vertices v JOIN lp{Q.ROUNDS} l USING (id)")


@oracle("tag_communities_full")
def _():
    parts = doc_graph(full=True) + S.label_propagation_parts("vertices", "edges", Q.ROUNDS)
    return W(parts, f"SELECT v.id, v.name, l.label FROM vertices v JOIN lp{Q.ROUNDS} l USING (id)", recursive=True)


# ---- recommendation and evaluation -----------------------------------------------------------------

def _recs():
    lp = f"lp{Q.ROUNDS}"
    return doc_graph() + S.label_propagation_parts("vertices", "edges", Q.ROUNDS) + [
        UND,
        ("same", f"""SELECT u.src AS tag_id, u.dst AS rec_id, round(u.weight, 6) AS weight
FROM ue u JOIN {lp} a ON a.id = u.src JOIN {lp} b ON b.id = u.dst WHERE a.label = b.label"""),
        ("r", "SELECT *, row_number() OVER (PARTITION BY tag_id ORDER BY weight DESC, rec_id ASC) AS rank FROM same"),
    ]


@oracle("recommend_tags")
def _():
    return W(_recs(), f"""SELECT r.tag_id, r.rank, r.rec_id, v.name AS rec_name, r.weight
FROM r JOIN vertices v ON v.id = r.rec_id WHERE r.rank <= {Q.TOP_RECS}""")


@oracle("recommend_requests")
def _():
    return W(_recs(), f"""SELECT v.name AS tag_name, r.rank, r.rec_id, w.name AS rec_name, r.weight
FROM r JOIN vertices v ON v.id = r.tag_id JOIN vertices w ON w.id = r.rec_id
WHERE r.rank <= {Q.TOP_RECS} AND v.name IN (SELECT DISTINCT lang FROM documents)""")


@oracle("precision_at_k")
def _():
    return W(_recs() + [
        ("truth", "SELECT id AS tag_id, split_part(name, '-', 1) AS key FROM vertices"),
        ("top", f"SELECT tag_id, rec_id FROM r WHERE rank <= {Q.PREC_K}"),
        ("per", """SELECT top.tag_id, sum(CASE WHEN tr.key = tt.key THEN 1 ELSE 0 END) AS hits, count(*) AS returned
FROM top JOIN truth tt ON tt.tag_id = top.tag_id LEFT JOIN truth tr ON tr.tag_id = top.rec_id GROUP BY top.tag_id"""),
        ("allt", """SELECT t.tag_id, CASE WHEN p.returned > 0 THEN CAST(p.hits AS DOUBLE) / p.returned ELSE 0.0 END AS p
FROM truth t LEFT JOIN per p USING (tag_id)"""),
    ], "SELECT count(*) AS n_tags, round(avg(p), 6) AS precision FROM allt")


@oracle("precision_at_k_pairs")
def _():
    lp = f"lp{Q.ROUNDS}"
    return W(emb_graph(Q.EMB_LP_T) + S.label_propagation_parts("evert", "edges", Q.ROUNDS) + [
        UND,
        ("same", f"""SELECT u.src AS tag_id, u.dst AS rec_id, round(u.weight, 6) AS weight
FROM ue u JOIN {lp} a ON a.id = u.src JOIN {lp} b ON b.id = u.dst WHERE a.label = b.label"""),
        ("r", "SELECT *, row_number() OVER (PARTITION BY tag_id ORDER BY weight DESC, rec_id ASC) AS rank FROM same"),
        ("n", "SELECT tag_id, label, row_number() OVER (PARTITION BY label ORDER BY tag_id) AS rn FROM emb"),
        ("truth", f"""SELECT a.tag_id, b.tag_id AS relevant_id FROM n a JOIN n b ON a.label = b.label AND a.rn <> b.rn
AND abs(a.rn - b.rn) <= {Q.TRUTH_NEAR}"""),
        ("top", f"SELECT tag_id, rec_id FROM r WHERE rank <= {Q.PREC_K}"),
        ("per", """SELECT top.tag_id, count(t.tag_id) AS hits, count(*) AS returned FROM top
LEFT JOIN truth t ON t.tag_id = top.tag_id AND t.relevant_id = top.rec_id GROUP BY top.tag_id"""),
        ("allt", """SELECT t.tag_id, CASE WHEN p.returned > 0 THEN CAST(p.hits AS DOUBLE) / p.returned ELSE 0.0 END AS p
FROM (SELECT DISTINCT tag_id FROM truth) t LEFT JOIN per p USING (tag_id)"""),
    ], "SELECT count(*) AS n_tags, round(avg(p), 6) AS precision FROM allt")


def _ranking():
    return S.label_vector_parts(Q.DOC_VOCAB) + [
        ("tn", "SELECT tag_id, sqrt(sum(w * w)) AS n FROM tv GROUP BY tag_id"),
        ("dots", "SELECT a.tag_id AS q, b.tag_id AS o, sum(a.w * b.w) AS d FROM tv a JOIN tv b ON a.idx = b.idx GROUP BY a.tag_id, b.tag_id"),
        ("s", """SELECT t1.id AS tag_id, t2.id AS neighbour_id,
       round(CASE WHEN coalesce(n1.n, 0) * coalesce(n2.n, 0) = 0 THEN 0.0 ELSE coalesce(d.d, 0) / (n1.n * n2.n) END, 6) AS sim
FROM tags t1 CROSS JOIN tags t2 LEFT JOIN dots d ON d.q = t1.id AND d.o = t2.id
LEFT JOIN tn n1 ON n1.tag_id = t1.id LEFT JOIN tn n2 ON n2.tag_id = t2.id"""),
        ("r", "SELECT *, row_number() OVER (PARTITION BY tag_id ORDER BY sim DESC, neighbour_id ASC) AS rank FROM s"),
    ]


@oracle("tag_neighbours")
def _():
    return W(_ranking(), f"""SELECT r.tag_id, r.rank, r.neighbour_id, v.name AS neighbour_name, r.sim
FROM r JOIN vertices v ON v.id = r.neighbour_id WHERE r.rank <= {Q.TOP_RECS}""")


@oracle("tag_ranking")
def _():
    return W(_ranking(), "SELECT tag_id, rank, neighbour_id, sim FROM r")


@oracle("tag_ranking_requests")
def _():
    return W(_ranking(), """SELECT v.name AS tag_name, r.rank, r.neighbour_id, r.sim
FROM r JOIN vertices v ON v.id = r.tag_id WHERE v.name IN (SELECT lang FROM documents)""")


def _post_scores():
    return S.label_vector_parts(Q.DOC_VOCAB) + [
        ("npost", "SELECT conv_id, turn, text FROM conversations WHERE role = 'user'"),
        ("ntok", f"SELECT conv_id, turn, unnest({S.clean_tokens_sql('text')}) AS term FROM npost"),
        ("ntf", "SELECT conv_id, turn, term, count(*) AS tf FROM ntok WHERE length(term) >= 2 GROUP BY conv_id, turn, term"),
        ("nw", "SELECT conv_id, turn, idx, tf * idf AS w FROM ntf JOIN vocab USING (term)"),
        ("nn", "SELECT conv_id, turn, sqrt(sum(w * w)) AS n FROM nw GROUP BY conv_id, turn"),
        ("tn", "SELECT tag_id, sqrt(sum(w * w)) AS n FROM tv GROUP BY tag_id"),
        ("pdot", """SELECT nw.conv_id, nw.turn, tv.tag_id, sum(nw.w * tv.w) AS d FROM nw JOIN tv USING (idx)
GROUP BY nw.conv_id, nw.turn, tv.tag_id"""),
        ("ps", """SELECT p.conv_id, p.turn, p.tag_id, round(p.d / (nn.n * tn.n), 6) AS sim
FROM pdot p JOIN nn USING (conv_id, turn) JOIN tn USING (tag_id) WHERE p.d > 0"""),
    ]


@oracle("post_tags")
def _():
    return W(_post_scores() + [
        ("r", "SELECT *, row_number() OVER (PARTITION BY conv_id, turn ORDER BY sim DESC, tag_id ASC) AS rank FROM ps"),
    ], f"""SELECT r.conv_id, r.turn, r.rank, r.tag_id, t.tag_name, r.sim FROM r JOIN tags t ON t.id = r.tag_id
WHERE r.rank <= {Q.TOP_POST_TAGS}""")


@oracle("post_tags_padded")
def _():
    return W(_post_scores() + [
        ("al", """SELECT n.conv_id, n.turn, t.id AS tag_id, coalesce(ps.sim, 0.0) AS sim, ps.sim IS NULL AS pad
FROM (SELECT DISTINCT conv_id, turn FROM npost) n CROSS JOIN tags t LEFT JOIN ps ON ps.conv_id = n.conv_id AND ps.turn = n.turn AND ps.tag_id = t.id"""),
        ("r", "SELECT *, row_number() OVER (PARTITION BY conv_id, turn ORDER BY pad, sim DESC, tag_id ASC) AS rank FROM al"),
    ], f"SELECT conv_id, turn, rank, tag_id, sim FROM r WHERE rank <= {Q.TOP_POST_TAGS}")


ORACLES["post_tags_saved_model"] = ORACLES["post_tags"]


# ---- described in the README ----------------------------------------------------------------------------

BASKETS = ("pt", """SELECT DISTINCT l.l_orderkey AS post_id, concat_ws('/', p.p_brand, p.p_type) AS tag
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey""")
COOC = ("cooc", """SELECT a.tag AS tag_a, b.tag AS tag_b, count(*) AS n FROM pt a JOIN pt b
ON a.post_id = b.post_id AND a.tag < b.tag GROUP BY a.tag, b.tag""")


@oracle("cooccurrence")
def _():
    return W([BASKETS, COOC], "SELECT tag_a, tag_b, n FROM cooc")


@oracle("cooccurrence_normalized")
def _():
    return W([BASKETS, COOC, ("cnt", "SELECT tag, count(*) AS c FROM pt GROUP BY tag")],
             """SELECT x.tag_a, x.tag_b, x.n, round(x.n / sqrt(CAST(a.c AS DOUBLE) * b.c), 6) AS weight
FROM cooc x JOIN cnt a ON a.tag = x.tag_a JOIN cnt b ON b.tag = x.tag_b""")


@oracle("usage_trend")
def _():
    return """SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS window_start, event_type AS tag, count(*) AS n
FROM events GROUP BY date_trunc('day', ts), event_type"""


ORACLES["connected_components_stars"] = ORACLES["connected_components"]
ORACLES["usage_trend_stream"] = ORACLES["usage_trend"]
ORACLES["post_tags_stream"] = ORACLES["post_tags"]
