"""One query for each operator, over its whole table, and its SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (exact_dedup, fingerprints, id_coder, language_id, line_dedup, merge_replay, merkle, minhash, packing, recurrent_lm, spelling,
               subword_sampling, tokens, url_filter)
from .common import table

_LOW = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"), url_filter.rule_table(spark))


_RULES = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in url_filter.RULES)
OP7_SQL = f"""
WITH r(rh, rp, rv) AS (VALUES {_RULES}),
a AS (SELECT row_number() OVER () AS n, page_id, CASE WHEN strpos(coalesce(url, ''), '://') > 0
             THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
u AS (SELECT n, page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM a),
m AS (SELECT n, arg_max(rh || rp, length(rh || rp)) AS rule, arg_max(rv, length(rh || rp)) AS rv
      FROM u, r WHERE (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp) GROUP BY n)
SELECT page_id, host, path, rule, coalesce(rv, 'allow') AS verdict FROM u LEFT JOIN m USING (n)
"""


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The older half of the id range is the snapshot, the rest the new batch."""
    docs = table(spark, sf_dir, "documents")
    lo, hi = docs.agg(F.min("doc_id"), F.max("doc_id")).first()
    middle = 0 if lo is None else (lo + hi) // 2
    return exact_dedup.exact_dedup(docs, F.col("doc_id") <= F.lit(middle))


OP8_SQL = f"""
WITH d AS (SELECT doc_id, sha256({_LOW}) AS text_sha256 FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       row_number() OVER (PARTITION BY text_sha256 ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256)
"""

def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokens.vocabulary("byte_bpe_50k.json"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(table(spark, sf_dir, "documents"))


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return id_coder.round_trip(table(spark, sf_dir, "documents"), tokens.vocabulary("word_bpe_49k.json"))


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprints(table(spark, sf_dir, "documents"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.deduped(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", F.size(F.split("text", "\n")).cast("long").alias("n_left"), "n_removed", F.sha2("text", 256).alias("text_sha256"))


_NORM = r"trim(regexp_replace(" + _LOW.replace("coalesce(text, '')", "line") + r", '[ \t\r\x{A0}]+', ' ', 'g'), ' ')"
OP5_SQL = rf"""
WITH s AS (SELECT doc_id, text, string_split(text, chr(10)) AS ls FROM documents),
r AS (SELECT doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS place FROM s),
n AS (SELECT doc_id, place, line, {_NORM} AS t FROM r WHERE regexp_matches(line, '[\p{{L}}\p{{N}}]')),
f AS (SELECT t, min(struct_pack(d := doc_id, p := place)) AS fst, length(t) AS len FROM n GROUP BY t),
h AS (SELECT t, fst, len, unnest(list_distinct([(len - 1) // 2, (len - 2) // 2])) AS q FROM f WHERE len >= {line_dedup.LEAST}),
k AS (SELECT *, q || '<' || substr(t, 1, q) AS key FROM h UNION ALL SELECT *, q || '>' || substr(t, len - q + 1) FROM h),
near AS (SELECT DISTINCT a.t FROM k a JOIN k b ON a.key = b.key AND b.fst < a.fst AND abs(a.len - b.len) <= 1
         AND levenshtein(a.t, b.t) <= 1),
gone AS (SELECT n.doc_id, n.place FROM n JOIN f USING (t)
         WHERE struct_pack(d := n.doc_id, p := n.place) <> f.fst OR n.t IN (SELECT t FROM near)),
x AS (SELECT r.doc_id, string_agg(r.line, chr(10) ORDER BY r.place) AS left_text, count(*) AS n_left FROM r
      LEFT JOIN gone g ON r.doc_id = g.doc_id AND r.place = g.place WHERE g.doc_id IS NULL GROUP BY r.doc_id)
SELECT s.doc_id, coalesce(x.n_left, 1)::BIGINT AS n_left, (len(s.ls) - coalesce(x.n_left, 0))::BIGINT AS n_removed,
       sha256(coalesce(x.left_text, '')) AS text_sha256
FROM s LEFT JOIN x USING (doc_id)
"""

def op10_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


OP10_SQL = """
WITH RECURSIVE w AS (SELECT doc_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[ \\t\\n\\r\\f\\v]+'), lambda x: x <> '') AS ws FROM documents),
n AS (SELECT min(doc_id) AS rep, ws FROM w GROUP BY ws),
s AS (SELECT rep, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
      ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END) AS sh FROM n),
c AS (SELECT rep, sh, count(*) AS m FROM s GROUP BY ALL),
z AS (SELECT rep, sum(m) AS size FROM c GROUP BY rep),
i AS (SELECT a.rep AS a, b.rep AS b, sum(least(a.m, b.m)) AS common FROM c a JOIN c b ON a.sh = b.sh AND a.rep < b.rep GROUP BY ALL),
l AS (SELECT a, b FROM i JOIN z x ON x.rep = a JOIN z y ON y.rep = b WHERE common >= 0.8 * (x.size + y.size - common)),
e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
r(src, dst) AS (SELECT rep, rep FROM n UNION SELECT r.src, e.b FROM r JOIN e ON e.a = r.dst),
k AS (SELECT src, min(dst) AS class_id FROM r GROUP BY src),
m AS (SELECT w.doc_id, class_id FROM w JOIN n ON n.ws = w.ws JOIN k ON k.src = n.rep)
SELECT doc_id, class_id, count(*) OVER (PARTITION BY class_id) AS class_size, doc_id = class_id AS kept FROM m
"""

def op2_recurrent_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recurrent_lm.score(table(spark, sf_dir, "documents"))


def op4_subword_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return subword_sampling.sample_segmentations(table(spark, sf_dir, "documents"), tokens.vocabulary("piece_bpe_32k.model"))


def op11_merge_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = tokens.vocabulary("byte_bpe_50k.tiktoken")
    d = merge_replay.encode(table(spark, sf_dir, "documents"), path, tokens.pattern())
    d = d.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"), "ids")
    d = merge_replay.decode_ids(d, path, keep=False)       # the ids needn't come back
    return d.select("doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.tampered_manifest(table(spark, sf_dir, "documents"))


# crc32 of a list of bytes: the list, then the register's eight steps for each byte
_CRC = ("xor(list_reduce(list_prepend(4294967295::UBIGINT, {bytes}), lambda c, b: list_reduce(list_prepend(xor(c, b), [0::UBIGINT for _ in range(8)]), "
        "lambda x, _i: xor(x // 2, 3988292384::UBIGINT * (x % 2)))), 4294967295::UBIGINT)")
_FIELD = "CASE WHEN {c} IS NULL THEN '-' ELSE strlen({c}::VARCHAR) || ':' || {c} END"
_FIELDS = " || ".join(_FIELD.format(c=c) for c in merkle.FIELDS)
_ID_BYTES = "list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::UBIGINT)"
OP12_SQL = f"""
WITH RECURSIVE l AS (SELECT doc_id, coalesce('=' || lang, '') AS g, sha256({_FIELDS}) AS leaf,
       CASE WHEN n_chars IS NOT NULL AND {_CRC.format(bytes=_ID_BYTES)} % 7 = 0
            THEN sha256({_FIELDS.replace('n_chars', '(n_chars + 1)')}) END AS changed FROM documents),
r AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY g) AS n FROM l),
t(g, lev, pos, h, n) AS (SELECT g, 0, pos, leaf, n FROM r
  UNION ALL SELECT g, lev + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), (n + 1) // 2 FROM t WHERE n > 1 GROUP BY g, lev, pos // 2, n),
s AS (SELECT g, h, row_number() OVER (ORDER BY g) - 1 AS pos, count(*) OVER () AS n FROM t WHERE n = 1),
u(lev, pos, h, n) AS (SELECT 0, pos, h, n FROM s
  UNION ALL SELECT lev + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), (n + 1) // 2 FROM u WHERE n > 1 GROUP BY lev, pos // 2, n),
a AS (SELECT g, max(lev) AS high FROM t GROUP BY g),
step AS (SELECT r.g, r.pos AS leaf_pos, t1.lev, t1.pos % 2 AS side, t2.h AS sib
         FROM r JOIN t t1 ON t1.g = r.g AND t1.n > 1 AND t1.pos = r.pos >> t1.lev
         LEFT JOIN t t2 ON t2.g = t1.g AND t2.lev = t1.lev AND t2.pos = xor(t1.pos, 1)
         UNION ALL
         SELECT r.g, r.pos, a.high + u1.lev, u1.pos % 2, u2.h
         FROM r JOIN a ON a.g = r.g JOIN s ON s.g = r.g JOIN u u1 ON u1.n > 1 AND u1.pos = s.pos >> u1.lev
         LEFT JOIN u u2 ON u2.lev = u1.lev AND u2.pos = xor(u1.pos, 1)),
p AS (SELECT g, leaf_pos AS pos, string_agg(coalesce(sib, ''), '' ORDER BY lev) AS proof FROM step GROUP BY ALL),
f(g, pos, lev, h) AS (SELECT g, pos, 0, coalesce(changed, leaf) FROM r
  UNION ALL SELECT f.g, f.pos, f.lev + 1, sha256(CASE WHEN side = 1 THEN sib || h ELSE h || coalesce(sib, '') END)
  FROM f JOIN step ON step.g = f.g AND step.leaf_pos = f.pos AND step.lev = f.lev),
e AS (SELECT g, pos, arg_max(h, lev) AS folded FROM f GROUP BY ALL)
SELECT r.doc_id, r.leaf, s.h AS subroot, root.h AS root, sha256(coalesce(p.proof, '')) AS proof_sha256, e.folded AS folded_root, e.folded = root.h AS verified
FROM r JOIN s ON s.g = r.g JOIN e ON e.g = r.g AND e.pos = r.pos LEFT JOIN p ON p.g = r.g AND p.pos = r.pos
CROSS JOIN (SELECT h FROM u WHERE n = 1) root
"""


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.grouped(table(spark, sf_dir, "documents"))


_RUN_BYTES = ("list_concat(list_transform(string_split(id || ':', ''), lambda x: ascii(x)::UBIGINT), flatten(list_transform(string_split(low, ''), "
              "lambda x: CASE WHEN unicode(x) < 128 THEN [unicode(x)::UBIGINT] ELSE [(192 + unicode(x) // 64)::UBIGINT, (128 + unicode(x) % 64)::UBIGINT] END)))")
OP13_SQL = f"""
WITH RECURSIVE b AS (SELECT doc_id, coalesce(doc_id::VARCHAR, '') AS id, unnest(regexp_extract_all(coalesce(text, ''), '[{spelling.LETTERS}]+')) AS run FROM documents),
k AS (SELECT id, {_LOW.replace("coalesce(text, '')", "run")} AS low, count(*) AS m FROM b WHERE length(run) >= {spelling.LEAST} GROUP BY ALL),
h AS (SELECT low, m, {_CRC.format(bytes=_RUN_BYTES)} AS h FROM k),
c AS (SELECT CASE WHEN h % 31 = 0 THEN substr(low, 1, (h % length(low))::BIGINT) || substr(low, (h % length(low))::BIGINT + 2) ELSE low END AS word, m FROM h),
w AS (SELECT word, sum(m)::BIGINT AS n FROM c WHERE length(word) >= {spelling.LEAST} GROUP BY word HAVING sum(m) >= {spelling.SEEN}),
v AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS less FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM w)),
e AS (SELECT x.word, x.n, y.word AS near, y.n AS m FROM v x JOIN v y ON x.less = y.less AND x.i = y.i AND x.word <> y.word
      UNION SELECT x.word, x.n, y.word, y.n FROM v x JOIN w y ON x.less = y.word
      UNION SELECT y.word, y.n, x.word, x.n FROM v x JOIN w y ON x.less = y.word),
g AS (SELECT word, n, count(DISTINCT near) AS n_near, max(m) AS top FROM e GROUP BY word, n),
f AS (SELECT g.word, g.n_near, min(near) AS form, top FROM g JOIN e ON e.word = g.word AND e.m = top WHERE top >= {spelling.RATIO} * g.n GROUP BY ALL),
t(word, root) AS (SELECT word, form FROM f UNION ALL SELECT t.word, f.form FROM t JOIN f ON f.word = t.root),
z AS (SELECT word, root FROM t WHERE root NOT IN (SELECT word FROM f))
SELECT w.word, f.form, coalesce(z.root, w.word) AS root, w.n, coalesce(g.n_near, 0)::BIGINT AS n_near, f.top::BIGINT AS form_n
FROM w LEFT JOIN g ON g.word = w.word LEFT JOIN f ON f.word = w.word LEFT JOIN z ON z.word = w.word
"""


REGISTRY = {"op11_merge_replay": op11_merge_replay, "op12_merkle_manifest": op12_merkle_manifest, "op13_spelling_variants": op13_spelling_variants,
            "op4_subword_sampling": op4_subword_sampling, "op2_recurrent_lm": op2_recurrent_lm, "op10_minhash": op10_minhash, "op5_line_dedup": op5_line_dedup, "op1_fingerprints": op1_fingerprints, "op6_language_id": op6_language_id, "op9_token_files": op9_token_files, "op3_packing": op3_packing, "op7_url_filter": op7_url_filter, "op8_exact_dedup": op8_exact_dedup}
ORACLES = {"op12_merkle_manifest": OP12_SQL, "op13_spelling_variants": OP13_SQL, "op10_minhash": OP10_SQL, "op5_line_dedup": OP5_SQL, "op7_url_filter": OP7_SQL, "op8_exact_dedup": OP8_SQL}
