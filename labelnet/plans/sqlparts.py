"""SQL text of the oracle queries (DuckDB dialect), built from shared CTE parts.

These strings are the independent check of the Spark plans: the same
semantics written as plain SQL over the raw tables. The fixed values
(stop words, punctuation, entity table, id offsets) come from the same
constants as the Spark side, so a change to one is a change to both.
"""

from __future__ import annotations

from labelnet.functions import porter
from labelnet.functions import text as tx
from labelnet.operators.features import IRREGULAR_NOUNS, NOUN_DETACHMENT
from labelnet.sources.standin import EXCERPT_ID_OFFSET, WIKI_ID_OFFSET


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def with_(parts: list[tuple[str, str]], final: str, recursive: bool = False) -> str:
    ctes = ",\n".join(f"{n} AS (\n{b}\n)" for n, b in parts)
    return f"WITH {'RECURSIVE ' * recursive}{ctes}\n{final}" if parts else final


def stop_list() -> str:
    return "[" + ", ".join(q(w) for w in tx.STOP_WORDS) + "]"


def html_sql(e: str, tag_sep: str = "") -> str:
    for p in tx.HTML_BLOCKS:
        e = f"regexp_replace({e}, {q(p)}, {q(tag_sep)}, 'g')"
    ref = f"""CASE WHEN substr(r, 2, 1) <> '#' THEN coalesce({q(tx.NAMED)}::JSON ->> ('$."' || substr(r, 2) || '"'), r)
      WHEN lower(substr(r, 3, 1)) = 'x' THEN chr(('0x' || substr(r, 4, length(r) - 4))::INTEGER) ELSE chr(substr(r, 3, length(r) - 3)::INTEGER) END"""
    refs = f"list_filter(list_distinct(regexp_extract_all({e}, {q(tx.REFERENCE)})), lambda r: NOT regexp_matches(r, {q('^' + tx.AMPERSAND + '$')}))"
    e = f"list_reduce(list_prepend({e}, {refs}), lambda acc, r: replace(acc, r, {ref}))"
    return f"regexp_replace({e}, {q(tx.AMPERSAND)}, '&', 'g')"


def split_sql(e: str) -> str:
    e = f"(' ' || {e} || ' ')"
    for pattern, to in tx.SPLITS + tx.CONTRACTIONS:
        e = f"regexp_replace({e}, {q(pattern)}, {q(to)}, 'g')"
    return e


def normalize_sql(e: str) -> str:
    e = f"translate(lower(trim({e})), {q(tx.PUNCTUATION)}, '')"
    return f"regexp_replace({e}, {q(tx.NON_ASCII)}, ' ', 'g')"


def strip_urls_sql(e: str) -> str:
    return f"regexp_replace({e}, {q(tx.URL_PIECE)}, '', 'g')"


def tokens_sql(e: str) -> str:
    return f"regexp_extract_all({e}, {q(tx.TOKEN)})"


def clean_tokens_sql(e: str) -> str:
    t = strip_urls_sql(normalize_sql(split_sql(html_sql(e))))
    return f"list_filter({tokens_sql(t)}, lambda t: NOT list_contains({stop_list()}, t))"


def clean_text_sql(e: str) -> str:
    return f"coalesce(array_to_string({clean_tokens_sql(e)}, ' '), '')"


SHAPE = ("list_reduce(list_prepend('', string_split({w}, '')), lambda a, x: a || CASE WHEN x IN ('a', 'e', 'i', 'o', 'u', '#') "
         "OR (x = 'y' AND right(a, 1) = 'c') THEN 'v' ELSE 'c' END)")


def stem_parts(words: str, term: str, out: str) -> list[tuple[str, str]]:
    """``out(term, stem)`` for the distinct ``words.term``: the published steps, one after the other."""
    parts, last = [(f"{out}_0", f"SELECT {term} AS term, lower({term}) AS w, {SHAPE.format(w=f'lower({term})')} AS s FROM {words}")], f"{out}_0"
    for i, step in enumerate(porter.steps(), 1):
        parts.append((f"{out}_{i}", f"SELECT term, w, {SHAPE.format(w='w')} AS s FROM (SELECT term, {step} AS w FROM {last})"))
        last = f"{out}_{i}"
    return parts + [(out, f"SELECT term, CASE WHEN length(term) <= 2 THEN lower(term) ELSE w END AS stem FROM {last}")]


def lemma_parts(forms: str, form: str, dictionary: str, word: str, out: str) -> list[tuple[str, str]]:
    """``out(form, lemma)`` for the distinct ``forms.form``; the list needs WITH RECURSIVE."""
    odd = ", ".join(f"({q(a)}, {q(b)})" for a, b in IRREGULAR_NOUNS)
    rules = ", ".join(f"({q(a)}, {q(b)})" for a, b in NOUN_DETACHMENT)
    return [
        (f"{out}_odd", f"SELECT * FROM (VALUES {odd}) AS x(form, word)"),
        (f"{out}_rules", f"SELECT * FROM (VALUES {rules}) AS x(suf, rep)"),
        (f"{out}_cut(form, word, depth)", f"""SELECT {form}, {form}, 0 FROM {forms} WHERE {form} NOT IN (SELECT form FROM {out}_odd)
UNION SELECT c.form, left(c.word, length(c.word) - length(suf)) || rep, depth + 1 FROM {out}_cut c, {out}_rules
WHERE ends_with(c.word, suf) AND length(c.word) > length(suf)"""),
        (f"{out}_all", f"""SELECT form, word, depth FROM {out}_cut UNION ALL SELECT {form}, {form}, 0 FROM {forms} WHERE {form} IN (SELECT form FROM {out}_odd)
UNION ALL SELECT form, word, 1 FROM {out}_odd WHERE form IN (SELECT {form} FROM {forms})"""),
        (f"{out}_best", f"""SELECT form, arg_min(word, (greatest(depth, 1), length(word), depth, word)) AS lemma FROM {out}_all
WHERE word IN (SELECT {word} FROM {dictionary}) GROUP BY form"""),
        (out, f"SELECT f.{form} AS form, coalesce(b.lemma, f.{form}) AS lemma FROM {forms} f LEFT JOIN {out}_best b ON b.form = f.{form}"),
    ]


def token_map_parts(words: str, out: str) -> list[tuple[str, str]]:
    """``out(term, token)`` for the distinct ``words.term``, which are the dictionary, too."""
    return stem_parts(words, "term", f"{out}_st") + [(f"{out}_stems", f"SELECT DISTINCT stem FROM {out}_st")] + lemma_parts(
        f"{out}_stems", "stem", words, "term", f"{out}_lem") + [
        (out, f"SELECT s.term, l.lemma AS token FROM {out}_st s JOIN {out}_lem l ON l.form = s.stem")]


# ---- the stand-in data model ---------------------------------------------------

POSTS = ("posts", """SELECT d.doc_id AS id, split_part(d.text, chr(10), 1) AS title, d.text AS body,
       concat_ws('|', concat_ws('-', d.lang, d.source), d.lang) AS tags,
       CAST(NULL AS BIGINT) AS parent_id, CAST(l.quality AS INTEGER) AS score
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""")

POST_TAGS = ("post_tags_raw", """SELECT id AS post_id, unnest(string_split(tags, '|')) AS tag_name
FROM posts WHERE tags <> ''""")

TAGS = ("tags", """SELECT CAST(dense_rank() OVER (ORDER BY tag_name) AS BIGINT) AS id, tag_name,
       CAST(count(*) AS BIGINT) AS count,
       CAST(NULL AS BIGINT) AS excerpt_post_id, CAST(NULL AS BIGINT) AS wiki_post_id
FROM post_tags_raw WHERE tag_name <> '' GROUP BY tag_name""")

TEXTS = ("texts", f"""SELECT id AS post_id, body, title, score FROM posts
UNION ALL SELECT {EXCERPT_ID_OFFSET} + item_id, text, CAST(NULL AS VARCHAR), CAST(NULL AS INTEGER) FROM benchmark
UNION ALL SELECT {WIKI_ID_OFFSET} + page_id, html, CAST(NULL AS VARCHAR), CAST(NULL AS INTEGER) FROM pages""")


def base_parts() -> list[tuple[str, str]]:
    return [POSTS, POST_TAGS, TAGS]


def usable_parts(min_score: int = 1) -> list[tuple[str, str]]:
    return [
        TEXTS,
        ("usable0", f"""SELECT post_id, {clean_tokens_sql('body')} AS tokens, {clean_tokens_sql('title')} AS title_tokens
FROM texts WHERE score >= {min_score}"""),
        ("usable", "SELECT post_id, tokens FROM usable0 WHERE len(tokens) > 0 AND len(title_tokens) > 0"),
    ]


def tfidf_parts(vocab_size: int, docs: str = "usable", stem: bool = False, full: bool = False) -> list[tuple[str, str]]:
    """Parts: tf (post_id, term, tf), vocab (term, idx, idf), w (post_id, idx, w)."""
    toks = [("toks", f"SELECT post_id, unnest(tokens) AS term FROM {docs}")]
    if stem:
        toks = [("toks_raw", toks[0][1]), ("toks_words", "SELECT DISTINCT term FROM toks_raw"), *stem_parts("toks_words", "term", "toks_stems"),
                ("toks", "SELECT post_id, stem AS term FROM toks_raw JOIN toks_stems USING (term)")]
    if full:
        toks = [("toks_raw", toks[0][1]), ("toks_words", "SELECT DISTINCT term FROM toks_raw"), *token_map_parts("toks_words", "toks_map"),
                ("toks", "SELECT post_id, token AS term FROM toks_raw JOIN toks_map USING (term)")]
    return toks + [
        ("tf", "SELECT post_id, term, count(*) AS tf FROM toks WHERE length(term) >= 2 GROUP BY post_id, term"),
        ("ndocs", f"SELECT CAST(count(*) AS DOUBLE) AS n FROM {docs}"),
        ("stats", "SELECT term, sum(tf) AS freq, count(*) AS df FROM tf GROUP BY term"),
        ("vocab0", f"SELECT term, freq, df FROM stats ORDER BY freq DESC, term ASC LIMIT {vocab_size}"),
        ("vocab", """SELECT term, CAST(row_number() OVER (ORDER BY term) - 1 AS INTEGER) AS idx,
       ln((1 + n) / (1 + CAST(df AS DOUBLE))) + 1 AS idf FROM vocab0, ndocs"""),
        ("w0", "SELECT tf.post_id, v.idx, tf.tf * v.idf AS w FROM tf JOIN vocab v USING (term)"),
        ("w", "SELECT post_id, idx, w / sqrt(sum(w * w) OVER (PARTITION BY post_id)) AS w FROM w0"),
    ]


def label_vector_parts(vocab_size: int, min_score: int = 1, stem: bool = False, full: bool = False) -> list[tuple[str, str]]:
    """Parts through ``tv (tag_id, idx, w)`` and ``vertices (id, name)``."""
    return base_parts() + usable_parts(min_score) + tfidf_parts(vocab_size, stem=stem, full=full) + [
        ("members", """SELECT t.id AS tag_id, p.post_id FROM post_tags_raw p JOIN tags t USING (tag_name)
WHERE p.post_id IN (SELECT post_id FROM usable)"""),
        ("nposts", "SELECT tag_id, count(*) AS n FROM members GROUP BY tag_id"),
        ("tv", """SELECT m.tag_id, w.idx, sum(w.w) / any_value(np.n) AS w
FROM members m JOIN w USING (post_id) JOIN nposts np USING (tag_id) GROUP BY m.tag_id, w.idx"""),
        ("vertices", "SELECT id, tag_name AS name FROM tags"),
    ]


def pair_edges_parts(vec: str, key: str, threshold: float, inclusive: bool = False, out: str = "edges") -> list[tuple[str, str]]:
    """All unordered pairs over a long-form vector table ``vec(key, idx, w)``."""
    op = ">=" if inclusive else ">"
    return [
        (f"{out}_norms", f"SELECT {key} AS k, sqrt(sum(w * w)) AS nrm FROM {vec} GROUP BY {key}"),
        (f"{out}_dots", f"""SELECT a.{key} AS src, b.{key} AS dst, sum(a.w * b.w) AS d
FROM {vec} a JOIN {vec} b ON a.idx = b.idx AND a.{key} < b.{key} GROUP BY a.{key}, b.{key}"""),
        (f"{out}_cos", f"""SELECT src, dst, CASE WHEN na.nrm * nb.nrm = 0 THEN 0.0 ELSE d / (na.nrm * nb.nrm) END AS weight
FROM {out}_dots JOIN {out}_norms na ON na.k = src JOIN {out}_norms nb ON nb.k = dst"""),
        (out, f"SELECT src, dst, weight FROM {out}_cos WHERE weight {op} {threshold}"),
    ]


def label_propagation_parts(vertices: str, edges: str, rounds: int, weighted: bool = False,
                            prefix: str = "lp") -> list[tuple[str, str]]:
    """Unrolled synchronous rounds; the result is ``{prefix}{rounds}(id, label)``."""
    pop = "sum(CAST(u.weight AS DECIMAL(18,6)))" if weighted else "count(*)"
    parts = [
        (f"{prefix}_und", f"SELECT src, dst, weight FROM {edges} UNION ALL SELECT dst, src, weight FROM {edges}"),
        (f"{prefix}0", f"SELECT id, id AS label FROM {vertices}"),
    ]
    for r in range(1, rounds + 1):
        prev = f"{prefix}{r - 1}"
        parts += [
            (f"{prefix}_v{r}", f"""SELECT u.dst AS id, l.label, {pop} AS pop
FROM {prefix}_und u JOIN {prev} l ON l.id = u.src GROUP BY u.dst, l.label"""),
            (f"{prefix}_b{r}", f"""SELECT id, label AS new FROM (
  SELECT id, label, row_number() OVER (PARTITION BY id ORDER BY pop DESC, label ASC) AS rn FROM {prefix}_v{r})
WHERE rn = 1"""),
            (f"{prefix}{r}", f"""SELECT l.id, coalesce(b.new, l.label) AS label
FROM {prev} l LEFT JOIN {prefix}_b{r} b ON l.id = b.id"""),
        ]
    return parts
