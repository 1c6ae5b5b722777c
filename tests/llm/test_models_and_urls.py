import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from labelnet.llm import bloom, language_id, recurrent_lm, subword_sampling, tokens, url_filter

from .fixture import empty, frame, rows

SF = "/root/testdata/sf0.001"


def test_language_id_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    lang = {r.doc_id: r.lang for r in docs.collect()}
    out = language_id.identify(docs).collect()
    held = [r for r in out if r.held_out]
    assert {r.doc_id for r in held} == {d for d in lang if zlib.crc32(str(d).encode()) % 4 == 2}
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in held]) > 0.95
    assert all(0 <= r.score <= 1 for r in out)


def test_language_id_of_odd_tables(spark):
    out = language_id.identify(frame(spark)).collect()
    assert len(out) == len(rows())
    und = {r.doc_id for r in out if r.lang_pred == "und"}
    assert {40, 41, 42, 50} <= und and {r.lang_pred for r in out} <= {"aa", "bb", "und"}
    assert language_id.identify(empty(spark)).count() == 0
    none = frame(spark).selectExpr("doc_id", "text", "cast(null as string) lang")
    assert {r.lang_pred for r in language_id.identify(none).collect()} == {"und"}


def test_language_id_learns_from_every_document(spark):
    """Documents dealt over many shards all count: a language of few documents and a word of one shard are learned."""
    words = {"aa": "lorem ipsum dolor sit amet", "bb": "ξεσκεπάζω την ψυχοφθόρα βδελυγμία", "cc": "съешь же ещё этих мягких"}
    data = [(i, words["cc" if i % 100 == 0 else "aa" if i % 2 else "bb"] + " " + "xyz"[i % 3] * (i % 7), "cc" if i % 100 == 0 else "aa" if i % 2 else "bb")
            for i in range(600)]
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string")
    model = language_id.train(docs, F.lit(True), 20)
    assert model["langs"] == ["aa", "bb", "cc"] and 0 < model["usual"] <= 1
    out = {r.doc_id: r for r in language_id.predict(docs, model, told=True).collect()}
    assert all(out[i].lang_pred == y for i, _, y in data) and all(0 <= r.score <= 1 for r in out.values())
    again = language_id.train(docs, F.lit(True), 20)
    assert np.array_equal(model["weights"], again["weights"]) and model["temperature"] == again["temperature"] and model["usual"] == again["usual"]


def test_language_model_sees_what_few_documents_have(spark):
    """A language of which one document in three thousand is: no sample of 4000 is sure to hold it twice, the model does."""
    docs = spark.range(12000).selectExpr("id as doc_id", "if(id % 3000 = 7, 'щука щит', 'abc def ghi') as text", "if(id % 3000 = 7, 'cc', 'aa') as lang")
    model = language_id.train(docs, F.lit(True))
    cols = language_id.grams(["щука щит"])[0]
    assert model["langs"] == ["aa", "cc"] and model["known"][cols].mean() > 0.9


def counted(data):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    toks = [re.findall("[^\x20\x09-\x0D]+", (t or "").translate(low)) for _, t in data]
    held = [d is not None and zlib.crc32(str(d).encode()) % 7 == 2 for d, _ in data]
    c = Counter()
    for x, h, (d, _) in zip(toks, held, data):
        if not h and d is not None:
            c.update(x + ["\n"])
    return toks, held, c


def test_lm_counts_are_exact_and_the_network_beats_them(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    data = sorted((r.doc_id, r.text) for r in docs.collect())
    toks, held, c = counted(data)
    n, v = sum(c.values()), len(c)
    out = {r.doc_id: r for r in recurrent_lm.score(docs).collect()}
    for (d, _), x, h in zip(data, toks, held):
        r = out[d]
        base = sum(math.log10((c[w] + 1) / (n + 1 * (v + 1))) for w in x + ["\n"])
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (h, len(x) + 1, sum(c[w] > 0 for w in x + ["\n"]), n)
        assert abs(r.base_score - base) < 1e-6 * max(1, abs(base))
    own = [r for r in out.values() if r.held_out]
    assert sum(r.score for r in own) > sum(r.base_score for r in own)


def test_lm_of_odd_tables(spark):
    out = recurrent_lm.score(frame(spark)).collect()
    assert len(out) == len(rows()) and all(np.isfinite(r.score) and r.score < 0 for r in out)
    assert np.ptp([r.score for r in out if r.doc_id == 1]) < 1e-4          # up to the rounding of single precision
    assert recurrent_lm.score(empty(spark)).count() == 0


def test_network_gradients_and_states():
    rng = np.random.default_rng(0)
    w = {k: v.astype(float) for k, v in recurrent_lm.start_weights(rng.integers(1, 99, recurrent_lm.TOP).astype(float),
                                                                  rng.integers(1, 99, recurrent_lm.CLASSES).astype(float)).items()}
    docs = [rng.integers(0, recurrent_lm.SYMBOLS - 1, n) for n in (5, 3, 9, 1, 0)]
    whole = recurrent_lm.score_docs(w, docs)
    assert np.allclose(whole, [recurrent_lm.score_docs(w, [d])[0] for d in docs], rtol=1e-4)   # abreast as alone
    memory = {k: np.zeros(s) for k, s in recurrent_lm.SHAPES.items()}
    new = {k: v.copy() for k, v in w.items()}
    m = recurrent_lm.train_docs(new, docs, memory)
    for k in recurrent_lm.SHAPES:
        i = np.unravel_index(int(memory[k].argmax()), memory[k].shape)
        up, down = ({q: v.copy() for q, v in w.items()} for _ in range(2))
        up[k][i] += 1e-3
        down[k][i] -= 1e-3
        slope = -(recurrent_lm.score_docs(up, docs).sum() - recurrent_lm.score_docs(down, docs).sum()) / 2e-3 / m
        assert abs(abs(slope) - math.sqrt(memory[k][i])) < 1e-3 * max(1, abs(slope)) and np.sign(slope) == np.sign(w[k][i] - new[k][i])


def test_probabilities_of_the_next_word_sum_to_one():
    w = recurrent_lm.start_weights(np.arange(1.0, recurrent_lm.TOP + 1), np.ones(recurrent_lm.CLASSES))
    h = np.random.default_rng(0).standard_normal((1, recurrent_lm.HIDDEN)).astype(np.float32)
    logp, _, _ = recurrent_lm._outputs(w, np.repeat(h, recurrent_lm.SYMBOLS, axis=0), np.arange(recurrent_lm.SYMBOLS), False)
    assert abs(np.exp(logp.astype(float)).sum() - 1) < 1e-4


def test_lm_vocabulary_and_bands_grow_with_the_corpus(spark, monkeypatch):
    assert [recurrent_lm.top_words(n) for n in (0, 10**6, 10**8, 6 * 10**9)] == [1024, 1024, 2048, 8192]
    top, classes = 8192, 64 + 30 * recurrent_lm.KINDS + 1
    w = recurrent_lm.start_weights(np.arange(1.0, top + 1), np.ones(classes))
    symbols = np.arange(len(w["x"]))
    h = np.random.default_rng(0).standard_normal((1, recurrent_lm.HIDDEN)).astype(np.float32)
    logp, _, _ = recurrent_lm._outputs(w, np.repeat(h, len(symbols), axis=0), symbols, False)
    assert len(symbols) == top + 30 * recurrent_lm.KINDS + 1 and abs(np.exp(logp.astype(float)).sum() - 1) < 1e-4

    started, start = [], recurrent_lm.start_weights
    monkeypatch.setattr(recurrent_lm, "start_weights", lambda *a: started.append(a) or start(*a))
    monkeypatch.setattr(recurrent_lm, "TOP", 64)
    monkeypatch.setattr(recurrent_lm, "GROWTH", 0)
    words = ["".join("abcdefgh"[int(c)] for c in np.base_repr(64 + i, 8)) for i in range(64)]
    text = " ".join(words * 30 + ["big"] * 25 + ["mid"] * 2)
    docs = spark.createDataFrame([(i, text) for i in range(200) if zlib.crc32(str(i).encode()) % 7 != 2][:100], "doc_id long, text string")
    assert all(np.isfinite(r.score) for r in recurrent_lm.score(docs).collect())
    counts, classes = started[0]                           # 3000 of each first word, 2500 and 200 of the others
    assert counts.tolist() == [3000] * 64 and len(classes) == 1 + 12 * recurrent_lm.KINDS + 1
    assert classes[1 + 11 * recurrent_lm.KINDS] == 2500 and classes[1 + 7 * recurrent_lm.KINDS] == 200

    monkeypatch.undo()
    monkeypatch.setattr(recurrent_lm, "GROWTH", 64)
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    out = recurrent_lm.score(docs).collect()
    assert recurrent_lm.top_words(out[0].train_tokens) > recurrent_lm.TOP
    own = [r for r in out if r.held_out]
    assert sum(r.score for r in own) > sum(r.base_score for r in own)


def segmentations(sp, s):
    if not s:
        yield ()
    for n in range(1, min(16, len(s)) + 1):
        i = sp.piece_to_id(s[:n])
        if i != sp.unk_id():
            for r in segmentations(sp, s[n:]):
                yield (i,) + r


def test_sampling_without_replacement_has_the_right_distribution():
    import sentencepiece
    path = tokens.vocabulary("piece_bpe_32k.model")
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    p = subword_sampling.pieces(path, subword_sampling.ALPHA)
    every = list(segmentations(sp, "▁the▁a"))
    w = np.exp([sum(p.weight[i] for i in x) for x in every])
    prob = dict(zip(every, w / w.sum()))
    n = 8000
    batch = pa.record_batch({"doc_id": pa.array(range(n)), "text": pa.array(["the a"] * n)})
    got = [r for b in subword_sampling.sampler(path, 3, subword_sampling.ALPHA, True)([batch]) for r in b.to_pylist()]
    of = defaultdict(list)
    for r in got:
        of[r["doc_id"]].append(tuple(r["ids"]))
        assert abs(r["log_prob"] - math.log(prob[tuple(r["ids"])])) < 1e-4
    assert all(len(set(v)) == 3 for v in of.values())
    first, second = Counter(v[0] for v in of.values()), Counter(v[1] for v in of.values())
    for x, q in prob.items():
        assert abs(first[x] / n - q) < 0.02
        assert abs(second[x] / n - sum(prob[y] * q / (1 - prob[y]) for y in prob if y != x)) < 0.02
    weights = defaultdict(float)
    for r in got:
        weights[r["doc_id"]] += math.exp(r["log_prob"] - r["log_inclusion"])
    assert abs(np.mean(list(weights.values())) - 1) < 0.01


def test_lattices_are_learned_once_and_what_is_kept_changes_no_row(monkeypatch):
    path = tokens.vocabulary("piece_bpe_32k.model")
    batch = pa.record_batch({"doc_id": pa.array([1, 2, None, 4], pa.int64()), "text": ["the cat sat", "sat the 漢字 \U0001F600 zq", None, "the cat  é sat"]})
    learned, learn = [], subword_sampling.Lattices._learn
    monkeypatch.setattr(subword_sampling.Lattices, "_learn", lambda self, units: (learned.append(list(units)), learn(self, units))[1])
    out = []
    for slice_, nodes in ((500_000, 1_000_000), (8, 1_000_000), (8, 1), (8, 20)):       # one slice; a slice for each text; nothing is kept; some are
        monkeypatch.setattr(subword_sampling, "SLICE", slice_)
        monkeypatch.setattr(subword_sampling, "NODES", nodes)
        learned.clear()
        subword_sampling._LATTICES.clear()
        for _ in range(2):
            got = [r for b in subword_sampling.sampler(path, 3, subword_sampling.ALPHA, True)([batch]) for r in b.to_pylist()]
            out.append(sorted(got, key=lambda r: (r["doc_id"] or -1, r["sample"])))
        every = [u for x in learned for u in x]
        assert (len(every) == len(set(every))) == (nodes > 100)
    for o in out[1:]:
        assert [(r["doc_id"], r["sample"], r["ids"], r["ids_crc32"], r["n_pieces"]) for r in o] == [
            (r["doc_id"], r["sample"], r["ids"], r["ids_crc32"], r["n_pieces"]) for r in out[0]]
        for c in ("log_prob", "score", "log_inclusion"):
            assert np.allclose([r[c] for r in o], [r[c] for r in out[0]], rtol=1e-5, atol=1e-5)


def test_sampled_pieces_decode_to_the_text(spark):
    import hashlib
    import sentencepiece
    path = tokens.vocabulary("piece_bpe_32k.model")
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    out = subword_sampling.sample_segmentations(frame(spark), path, ids=True).collect()
    texts = defaultdict(set)
    for r in rows():
        texts[r[0]].add((r[1] or "").replace("▁", " "))
    for r in out:
        t = sp.decode(list(r.ids))
        assert t in texts[r.doc_id] and r.decoded_sha256 == hashlib.sha256(t.encode()).hexdigest()
        assert r.log_inclusion <= 0 and r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
    again = subword_sampling.sample_segmentations(frame(spark).repartition(3), path).collect()
    key = lambda r: (r.doc_id or -1, r.sample, r.ids_crc32)
    assert sorted(map(key, again)) == sorted(map(key, out))                   # seeded by the row, not by the task
    assert sum(r.doc_id == 1 for r in out) == 6 and subword_sampling.sample_segmentations(empty(spark), path).count() == 0


def test_rows_of_ids_decode_to_the_librarys_texts(spark):
    import sentencepiece
    path = tokens.vocabulary("piece_bpe_32k.model")
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    lists = [sp.encode(r[1]) for r in rows() if r[1]] + [[], None]
    df = spark.createDataFrame([(i, x, "t") for i, x in enumerate(lists)], "k long, ids array<int>, own string").repartition(3)
    out = subword_sampling.decode_ids(df, path)
    assert out.columns == ["k", "own", "text"]
    assert {r.k: r.text for r in out.collect()} == {i: None if x is None else sp.decode(x) for i, x in enumerate(lists)}
    assert subword_sampling.decode_ids(df.limit(0), path).count() == 0


URLS = ["https://example.org/es/1", "http://a.b.example.org/en/12?x#y", "https://EXAMPLE.org/en/2", "https://example.org", "https://badexample.org/es/",
        "x.com/fr/", "https://x.com/fr/a", "https://com/de/", "ftp://x.com/de", "https://x.net/a/b?c", None, "", "://", "https://x.com/fr/a", "https://u@h:80/p;q"]


def brute_url(u):
    rest = u.split("://", 1)[1] if u and "://" in u else ""
    host = re.match("[^/?#]*", rest).group()
    path = re.match("[^?#]*", rest[len(host):]).group()
    host = host.lower()
    fit = [(len(h) + len(p), h + p, v) for h, p, v in url_filter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, max(fit)[1] if fit else None, max(fit)[2] if fit else "allow")


def test_url_rules(spark):
    pages = spark.createDataFrame([(i, u, 1, "b") for i, u in enumerate(URLS)], "page_id long, url string, `key` int, block string")
    out = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judge(pages, url_filter.rule_table(spark)).collect()}
    assert out == {i: brute_url(u) for i, u in enumerate(URLS)}
    none = url_filter.judge(pages, url_filter.rule_table(spark).limit(0), "block").collect()
    assert {r.verdict for r in none} == {"block"} and len(none) == len(URLS)
    assert url_filter.judge(pages.limit(0), url_filter.rule_table(spark)).count() == 0


@pytest.mark.parametrize("most", [None, 4])
def test_bloom_loses_no_key(spark, most):
    keys = spark.range(0, 4000, 2).selectExpr("concat('k', id) as key")
    words, n = bloom.build(keys, 2000, most)
    hit = {r.key for r in bloom.may_hold(spark.range(4000).selectExpr("concat('k', id) as key"), words, n, True).collect()}
    assert {f"k{i}" for i in range(0, 4000, 2)} <= hit
    assert most or len(hit) < 2100


def test_pipeline_stages(spark):
    import corpus_pipeline
    d = frame(spark)
    none = empty(spark)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        d, none = stage(spark, d, SF), stage(spark, none, SF)
        assert d.columns == none.columns == frame(spark).columns and none.count() == 0
        d = spark.createDataFrame(d.collect(), d.schema)
        if name == "language_id":
            assert not {40, 41, 42, 50} & {r.doc_id for r in d.collect()}
    left = d.collect()
    assert len({r.doc_id for r in left if r.doc_id in (3, 30)}) == 1          # an exact copy is gone
    packed = corpus_pipeline.STAGES[-1][1](spark, d, SF)
    assert {r.doc_id for r in packed.collect()} == {r.doc_id for r in left}
    assert corpus_pipeline.run(spark, SF).count() > 0


UNLEARNED = ["Съешь же ещё этих мягких французских булок да выпей чаю", "Ξεσκεπάζω την ψυχοφθόρα βδελυγμία και πηγαίνω στο σπίτι", "你好世界我们今天去北京看朋友然后回家吃饭睡觉",
             "Yksinkertainen hyökkäys järjestelmään epäonnistui täysin koska käyttäjät eivät hyväksyneet muutosta",
             "Zażółć gęślą jaźń wszyscy ludzie rodzą się wolni i równi pod względem swej godności", "xqzvk wjxqpz kkvzxj qwzzx vxkqj zzkwq pqxvz kjwqx zvqkx"]


@pytest.mark.parametrize("langs", [("en", "fr", "de", "es"), ("en", "fr", "de"), ("en",)])
def test_pipeline_rejects_unlearned_languages_and_keeps_short_clean_texts(spark, langs):
    import corpus_pipeline
    docs = spark.read.parquet(f"{SF}/documents.parquet").where(F.col("lang").isin(*langs)).select("doc_id", "text", "lang")
    clean = [r.text for r in docs.where("length(text) > 400").orderBy("doc_id").limit(20).collect()]
    short = [" ".join(t.split()[:6]) for t in clean]
    planted = [(-1 - i, t, None) for i, t in enumerate(UNLEARNED)] + [(-101 - i, t, None) for i, t in enumerate(short)]
    both = docs.unionByName(spark.createDataFrame(planted, docs.schema))
    left = {r.doc_id for r in corpus_pipeline.identify_language(spark, both, SF).collect()}
    assert not {-1 - i for i in range(len(UNLEARNED))} & left
    assert {-101 - i for i in range(len(short))} <= left
    assert {r.doc_id for r in docs.where(F.col("text").rlike(r"\p{L}")).collect()} <= left


def test_pipeline_without_a_learned_language_rejects_only_texts_without_a_letter(spark):
    import corpus_pipeline
    none = frame(spark).selectExpr("doc_id", "text", "cast(null as string) lang")
    left = corpus_pipeline.identify_language(spark, none, SF).collect()
    want = [(r[0], r[1]) for r in rows() if r[1] and any(c.isalpha() for c in r[1])]
    assert Counter((r.doc_id, r.text) for r in left) == Counter(want)
    digits = frame(spark).selectExpr("doc_id", "if(doc_id > 10, text, '12 34') as text", "if(doc_id > 10, null, 'aa') lang")
    left = corpus_pipeline.identify_language(spark, digits, SF).collect()
    assert Counter((r.doc_id, r.text) for r in left) == Counter(x for x in want if x[0] and x[0] > 10)


def test_a_blooms_keys_are_computed_once(spark):
    lines = spark.createDataFrame([("a b",), ("c",), (None,)], "t string").withColumn("key", F.xxhash64(F.upper("t")))
    words, n = bloom.build(lines.limit(2).select("key"), 2)
    hit = bloom.may_hold(lines, words, n, True)
    below = hit._jdf.queryExecution().optimizedPlan().toString()
    assert below.count("upper(t") == 1 + words._jdf.queryExecution().optimizedPlan().toString().count("upper(t")
    assert {"a b", "c"} <= {r.t for r in hit.collect()}
