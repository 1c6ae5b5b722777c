"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Features are the 1- to 3-grams of the lower-cased text (what isn't a letter counts as a space), hashed
to ``DIMS`` columns; a value is the n-gram's share of the text times its inverse document frequency.
Document frequencies come from every learning document, by partial sums in the tasks, and so does the rest of the
model: a fifth of the documents (by a hash) is kept out of the fit, the others are dealt into shards of about ``SHARD``
by a hash, each shard's weights are fitted in one task by follow-the-regularised-leader with elastic-net penalties, and
the model is their mean, weighted by documents (parameter mixing, McDonald et al. 2009; up to ``SHARD`` documents are
one shard). The kept-out fifth, in partial sums too, sets the temperature that calibrates the scores. Prediction reads
every whole text.

The scores of the learned languages sum up to 1 whatever the text is, so they don't tell an unlearned language.
``evidence`` does: the share of a text's 3-grams in columns that two documents of the fit have, less what chance
gives (the share of such columns), 1 at most. ``usual`` is its median over the kept-out fifth (to ``PLACES``).

Defined cases: a text that is null or without a letter is ``und`` with score 0, and isn't learned from;
neither is a document with a null lang or doc_id; without any learning document all is ``und``; an
empty table gives an empty result; other columns are ignored; a text longer than a slice is a slice of its own and is read whole.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import tokens
from .common import give_back

DIMS, SHARD, EPOCHS, KEPT = 1 << 15, 4000, 3, 5
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.01, 0.1
SCALE = 30.0               # shares are small; this brings features to about 1
CHARS = 1_000_000          # characters looked at in one go

PLACES = 10_000            # evidence is counted in steps of 1 / PLACES for its median
TEMPERATURES = np.exp(np.linspace(-3, 3, 121))

_ALPHA: list = []


def _letters() -> np.ndarray:
    if not _ALPHA:
        _ALPHA.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000))
    return _ALPHA[0]


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Columns of the n-grams (3 x positions), where each text's positions begin (one more at the end), has a letter, letters."""
    low = [" " + t.lower() + " " for t in texts]
    cp = np.frombuffer(("".join(low) + "  ").encode("utf-32-le", "surrogatepass"), np.uint32)
    ends = np.concatenate([[0], np.cumsum(np.fromiter(map(len, low), np.int64, len(low)))])
    letter = _letters()[cp]
    cp = np.where(letter, cp, np.uint32(32))
    a, b, c = cp[:-2], cp[1:-1], cp[2:]
    one = a * np.uint32(2654435761)
    two = (one ^ (one >> np.uint32(15))) + b * np.uint32(2246822519)
    three = (two ^ (two >> np.uint32(13))) + c * np.uint32(3266489917)
    shift = np.uint32(32 - DIMS.bit_length() + 1)
    cols = np.stack([(h * np.uint32(668265263)) >> shift for h in (one, two, three)])
    return cols, ends, np.add.reduceat(letter[:-2], ends[:-1]) > 0 if len(low) else np.zeros(0, bool), letter


def evidence(cols: np.ndarray, ends: np.ndarray, letter: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Each text's; ``known``: the columns that the fit has met."""
    at = letter[:-2] | letter[1:-1] | letter[2:]
    at[ends[1:] - 1] = False                       # the last 3-gram reaches into the next text
    n = np.add.reduceat(at, ends[:-1], dtype=np.int64)
    share = np.add.reduceat(at & known[cols[2]], ends[:-1], dtype=np.int64) / np.maximum(n, 1)
    return 1 - (1 - share) / max(1 - known.mean(), 1e-9)


def learns(docs: DataFrame, fold: Column) -> DataFrame:
    return docs.where(fold & F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull())


def _frequencies(batches):
    """Documents that have a gram, and those among them that are fitted; gram -1 counts the documents."""
    df, met, n, m = np.zeros(DIMS, np.int64), np.zeros(DIMS, np.int64), 0, 0
    for big in batches:
        for b in tokens.slices(big, chars=CHARS):
            cols, ends, ok, _ = grams(b.column("text").to_pylist())
            fit = b.column("fit").to_numpy(zero_copy_only=False)
            for i in np.flatnonzero(ok):
                seen = np.zeros(DIMS, bool)
                seen[cols[:, ends[i]:ends[i + 1]]] = True
                df += seen
                n += 1
                if fit[i]:
                    met += seen
                    m += 1
    cols = ends = ok = None
    give_back()
    at = np.flatnonzero(df)
    yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1).astype(np.int32)), pa.array(np.append(df[at], n)), pa.array(np.append(met[at], m))],
                                     names=["gram", "df", "met"])


def _bag(texts: list[str], idf: np.ndarray):
    cols, ends, ok, _ = grams(texts)
    for i in range(len(texts)):
        at, n = np.unique(cols[:, ends[i]:ends[i + 1]], return_counts=True)
        yield ok[i], at, (SCALE / max(1, n.sum()) * n * idf[at]).astype(np.float64)


def _fit(idf: np.ndarray, langs: list[str]):
    """One shard's rows (lang, gram, weight times documents); gram -1 is the bias, -2 the documents."""
    def run(f):
        f = f.sort_values(["h", "text", "lang"], kind="stable")     # whatever order they came in
        used, wait = [], []

        def flat():                                    # in long arrays, which go back to the system when the fit is over
            ends = np.cumsum([0] + [len(at) for at, _, _ in wait])
            ats, xs = (np.concatenate([w[i] for w in wait]) for i in (0, 1))
            used.extend((ats[i:j], xs[i:j], y) for i, j, (_, _, y) in zip(ends[:-1], ends[1:], wait))
            wait.clear()
        for (ok, at, x), y in zip(_bag_all(f["text"], idf), f["lang"]):
            if ok:
                wait.append((at.astype(np.int32), x, langs.index(y)))
                if len(wait) == 200:
                    flat()
        if wait:
            flat()
        k = len(langs)
        z, n = np.zeros((DIMS + 1, k)), np.zeros((DIMS + 1, k))

        def weights(at):
            zz = z[at]
            return -np.sign(zz) * np.maximum(np.abs(zz) - L1, 0) / ((BETA + np.sqrt(n[at])) / ALPHA + L2)

        rng = np.random.default_rng(7)
        for _ in range(EPOCHS):
            for i in rng.permutation(len(used)):
                at, x, y = used[i]
                at, x = np.append(at, DIMS), np.append(x, 1.0)
                w = weights(at)
                s = x @ w
                p = np.exp(s - s.max())
                p /= p.sum()
                p[y] -= 1
                g = x[:, None] * p
                sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA
                z[at] += g - sigma * w
                n[at] += g * g
        w = weights(slice(None))
        out, m = [], len(used)
        for j, lang in enumerate(langs):
            at = np.flatnonzero(w[:DIMS, j])
            out.append(pd.DataFrame({"lang": lang, "gram": np.append(at, [-1, -2]).astype(np.int32), "weight": np.append(w[at, j] * m, [w[DIMS, j] * m, m])}))
        used = z = n = w = None
        give_back()
        return pd.concat(out, ignore_index=True)
    return run


def _bag_all(texts, idf):
    for t in texts:
        yield from _bag([t], idf)


def _logits(model: dict, cols: np.ndarray, ends: np.ndarray) -> np.ndarray:
    w = model["weights"]
    each = w[cols[0]]
    each += w[cols[1]]
    each += w[cols[2]]
    s = np.add.reduceat(each, ends[:-1], axis=0, dtype=np.float64) / (3 * np.diff(ends))[:, None]
    return s + model["bias"]


def _calibrate(model: dict):
    """Sums over kept-out documents: ``at`` is a temperature's place (value: the log loss), or, past them, an evidence (value: documents)."""
    place = {y: j for j, y in enumerate(model["langs"])}

    def run(batches):
        losses, counts = np.zeros(len(TEMPERATURES)), np.zeros(2 * PLACES + 1)
        for big in batches:
            for b in tokens.slices(big, chars=CHARS):
                cols, ends, ok, letter = grams(b.column("text").to_pylist())
                ys = np.array([place[y] for y in b.column("lang").to_pylist()], int)[ok]
                logits = _logits(model, cols, ends)[ok]
                for i, t in enumerate(TEMPERATURES):
                    s = logits / t
                    m = s.max(axis=1, keepdims=True)
                    losses[i] += (np.log(np.exp(s - m).sum(axis=1)) + m[:, 0] - s[np.arange(len(ys)), ys]).sum()
                share = np.clip(evidence(cols, ends, letter, model["known"])[ok], -1, 1)
                np.add.at(counts, np.rint((share + 1) * PLACES).astype(int), 1)
                cols = ends = letter = logits = None
        give_back()
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(np.arange(len(losses)), at + len(losses)).astype(np.int32)),
                                          pa.array(np.append(losses, counts[at]))], names=["at", "value"])
    return run


def train(docs: DataFrame, fold: Column, shard: int = SHARD) -> dict:
    """``fold``: condition on the documents to learn from. The model: languages, weights (idf included), bias, temperature, columns met, usual evidence."""
    h = F.xxhash64("doc_id", "text")
    known = learns(docs, fold).select("doc_id", F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"),
                                      h.alias("h"), (F.pmod(h, F.lit(KEPT)) != 0).alias("fit"))
    rows = (known.select("text", "fit").mapInArrow(_frequencies, "gram int, df long, met long")
            .groupBy("gram").agg(F.sum("df").alias("df"), F.sum("met").alias("met")).collect())
    n, m = next(((r["df"], r["met"]) for r in rows if r["gram"] == -1), (0, 0))
    few = m == 0 or m == n                              # hardly any document: all are fitted, and all calibrate
    idf, met = np.full(DIMS, np.log(1 + n) + 1), np.zeros(DIMS, np.int64)
    for r in rows:
        if r["gram"] >= 0:
            idf[r["gram"]] = np.log((1 + n) / (1 + r["df"])) + 1
            met[r["gram"]] = r["df"] if few else r["met"]
    langs = sorted(r["lang"] for r in known.select("lang").distinct().collect()) if n else []
    model = {"langs": langs, "weights": np.zeros((DIMS, len(langs)), np.float32), "bias": np.zeros(len(langs)), "temperature": 1.0,
             "known": met > 1, "usual": 0.0}
    if not langs:
        return model
    shards = -(-(n if few else m) // shard)
    dealt = F.pmod(F.xxhash64("h", F.lit(1)), F.lit(shards)).cast("int").alias("shard")
    got = (known.where(F.lit(True) if few else F.col("fit")).select(dealt, "h", "text", "lang").groupBy("shard")
           .applyInPandas(_fit(idf, langs), "lang string, gram int, weight double")
           .groupBy("lang", "gram").agg(F.sum("weight").alias("weight")).collect())
    total = max(r["weight"] for r in got if r["gram"] == -2)
    place = {y: j for j, y in enumerate(langs)}
    for r in got:
        if r["gram"] == -1:
            model["bias"][place[r["lang"]]] = r["weight"] / total
        elif r["gram"] >= 0:
            model["weights"][r["gram"], place[r["lang"]]] = r["weight"] / total * idf[r["gram"]] * SCALE
    kept = known.where(F.lit(True) if few else ~F.col("fit")).select("text", "lang")
    sums = {r["at"]: r["value"] for r in kept.mapInArrow(_calibrate(model), "at int, value double").groupBy("at").agg(F.sum("value").alias("value")).collect()}
    losses = [sums.get(i, 0.0) for i in range(len(TEMPERATURES))]
    model["temperature"] = float(TEMPERATURES[int(np.argmin(losses))])
    shares = sorted((at - len(TEMPERATURES), c) for at, c in sums.items() if at >= len(TEMPERATURES))
    upto = np.cumsum([c for _, c in shares])
    middle = [shares[int(np.searchsorted(upto, x, "right"))][0] / PLACES - 1 for x in ((upto[-1] - 1) // 2, upto[-1] // 2)]
    model["usual"] = max(0.0, float(np.mean(middle)))
    return model


def _predict(model: dict, told: bool):
    langs, temp, known = (model[k] for k in ("langs", "temperature", "known"))

    def run(batches):
        for big in batches:
            for b in tokens.slices(big, chars=CHARS):
                cols, ends, text, letter = grams([t or "" for t in b.column("text").to_pylist()])
                pred, score, seen, ok = np.zeros(len(b), int), np.zeros(len(b)), np.ones(len(b)), text
                if langs and len(b):
                    s = _logits(model, cols, ends) / temp
                    p = np.exp(s - s.max(axis=1, keepdims=True))
                    p /= p.sum(axis=1, keepdims=True)
                    pred, score = p.argmax(axis=1), p.max(axis=1)
                    if told:
                        seen = evidence(cols, ends, letter, known)
                else:
                    ok = np.zeros(len(b), bool)
                yield pa.RecordBatch.from_arrays(
                    [*[b.column(i) for i in range(b.num_columns) if b.schema.names[i] != "text"],
                     pa.array([langs[j] if k else "und" for j, k in zip(pred, ok)], pa.string()), pa.array(np.where(ok, score, 0.0)),
                     *([pa.array(seen, mask=~text)] if told else [])],
                    names=[x for x in b.schema.names if x != "text"] + ["lang_pred", "score"] + ["evidence"] * told)
                del cols, ends, text, letter, pred, score, seen, ok
                s = p = None
            give_back()
    return run


def predict(docs: DataFrame, model: dict, keys: list[str] = ("doc_id",), told: bool = False) -> DataFrame:
    """``keys, lang_pred, score`` for every row; if ``told`` also ``evidence``: null without a letter, 1 without a learned language."""
    d = docs.select(*keys, F.col("text").cast("string").alias("text"))
    kinds = ", ".join(f"`{k}` {docs.schema[k].dataType.simpleString()}" for k in keys)
    return d.mapInArrow(_predict(model, told), f"{kinds}, lang_pred string, score double" + ", evidence double" * told)


def fold_of(n: int, rest: int) -> Column:
    """crc32 of doc_id as text, modulo n, is ``rest``; null where doc_id is."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % n == rest


def identify(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, lang_pred, score``; learns from the three quarters that aren't held out."""
    model = train(docs, ~fold_of(4, 2))
    return predict(docs, model).select("doc_id", F.coalesce(fold_of(4, 2), F.lit(False)).alias("held_out"), "lang_pred", "score")
