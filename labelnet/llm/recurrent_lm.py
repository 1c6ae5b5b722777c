"""Language-model scoring with a gated recurrent network and a class-factored softmax, in NumPy.

Counts. Documents go to chunks of about ``CHUNK`` bytes by hash. A chunk lists its words with their counts in
its learning documents; a window over each word (a row for each chunk that has it) sums them up, so every
chunk gets back the corpus counts of its own words, and no task or driver ever holds the whole vocabulary.

Symbols. The most frequent words are symbols of their own: as many as the largest power of two up to ``GROWTH``
times the cube root of the learning tokens, ``TOP`` at least. They are in output classes by rank, of about the square
root of their number (``PER_CLASS`` at least), so a step's cost grows with the square root, too. Any other word is a
class by its count (powers of two, as many as the largest count of such a word needs) and its letters (plain, other
script or accent, with signs); within it, a word's probability is its share of the class's counts plus one. Words never
seen are the class of count 0. The end of a text is a class of its own. A learning document's own words are never
unseen, so in training each word has the class of its count less one: the network learns how often words that the
other documents don't have come up.

Network. The state h of a gated recurrent unit reads a symbol at a time, and predicts the class of the next
word and, for the most frequent words, the word within its class; so each output costs two small softmaxes
instead of one over the vocabulary. It is trained on every learning document by backpropagation through time,
truncated at ``WINDOW`` symbols, with the state carried on from window to window; so are states in scoring, so
a text is scored as a whole whatever its length. Documents of a batch run abreast, the longest first. Every
task trains on its own part, from the same start (the corpus frequencies); the mean of their weights, weighted
by tokens and formed in steps of ``FAN`` parts, is the model.

Defined cases: a null text is empty, and is the end alone; a null doc_id is not held out, and isn't learned
from either; without any learning document all scores are those of unseen words; repeated rows are
scored alike up to rounding, and learned from as often as they occur; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import saved, text_or_empty
from .language_id import fold_of

CHUNK = 12_000_000
TOP, PER_CLASS, BANDS, KINDS = 1024, 64, 8, 3
HIDDEN, WINDOW, BATCH, RATE = 16, 24, 512, 0.08
GROWTH = 8
FAN, FAN_BYTES, PART = 64, 128_000_000, 2_000_000     # parts merged at once and their size; words in a part at least
# the least network; classes of frequent words, then BANDS * KINDS classes, then the end's
CLASSES = TOP // PER_CLASS + BANDS * KINDS + 1
SYMBOLS = TOP + BANDS * KINDS + 1             # as input: words, classes, the end


def top_words(tokens: int) -> int:
    """Words that are symbols of their own in a corpus of so many learning tokens."""
    return max(TOP, 1 << max(0, int(GROWTH * tokens ** (1 / 3))).bit_length() >> 1)


def shapes(top: int, classes: int) -> dict[str, tuple]:
    per = max(PER_CLASS, 1 << top.bit_length() // 2)
    return {"x": (top + classes - top // per, 3 * HIDDEN), "u": (HIDDEN, 3 * HIDDEN), "wc": (HIDDEN, classes), "bc": (classes,),
            "wo": (top // per, HIDDEN, per), "bo": (top // per, per)}


SHAPES = shapes(TOP, CLASSES)


# ---- words and counts ------------------------------------------------------------------------------

def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts in a row, and each text's number of words."""
    parts = pc.ascii_split_whitespace(pc.ascii_lower(texts.cast(pa.large_string())))
    at = parts.offsets.to_numpy() - parts.offsets[0].as_py()
    flat = parts.flatten()
    real = pc.not_equal(flat, "").to_numpy(zero_copy_only=False)
    upto = np.concatenate([[0], np.cumsum(real)])
    return flat.filter(pa.array(real)), np.diff(upto[at])


def _lexicon(words: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Distinct words in ascending order, and the place of each word in them."""
    coded = words.dictionary_encode()
    order = pc.sort_indices(coded.dictionary).to_numpy()
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    return coded.dictionary.take(pa.array(order)), place[coded.indices.to_numpy(zero_copy_only=False)] if len(words) else np.zeros(0, np.int64)


def _one(table: pa.Table, col: str) -> pa.Array:
    return pa.concat_arrays(table.column(col).chunks) if table.column(col).num_chunks else pa.array([], table.schema.field(col).type)


def _count(table: pa.Table) -> pa.Table:
    """A chunk -> its words with counts in its learning documents."""
    words, n = words_of(_one(table, "text"))
    lex, at = _lexicon(words)
    learn = np.repeat(_one(table, "learn").to_numpy(zero_copy_only=False), n)
    c = np.bincount(at[learn], minlength=len(lex))
    return pa.table({"chunk": pa.array(np.full(len(lex), table["chunk"][0].as_py()), pa.int32()),
                     "place": pa.array(np.arange(len(lex)), pa.int32()), "word": lex.cast(pa.string()), "c": pa.array(c, pa.int64())})


def _kind(symbols: int) -> str:
    return "<u2" if symbols <= 1 << 16 else "<u4"


def _encode(top: list[str], size: int, kind: str, logs: np.ndarray, denominator: float):
    """(a chunk's documents, its words' counts and classes) -> symbols and the sums that need no network."""
    def run(docs: pa.Table, info: pa.Table) -> pa.Table:
        words, n = words_of(_one(docs, "text"))
        lex, at = _lexicon(words)
        c, cls, less = (np.zeros(len(lex), np.int64) for _ in range(3))
        place = _one(info, "place").to_numpy(zero_copy_only=False)
        for to, name in ((c, "c"), (cls, "cls"), (less, "less")):
            to[place] = _one(info, name).to_numpy(zero_copy_only=False)
        rank = pc.fill_null(pc.index_in(lex.cast(pa.string()), value_set=pa.array(top, pa.string())), -1).to_numpy(zero_copy_only=False)
        symbol = np.where(rank >= 0, rank, size + cls).astype(kind)
        # a word of a class: its share; a word never seen has its class to itself
        share = np.where((rank >= 0) | (c == 0), 0.0, np.log10(c + 1.0) - logs[cls])
        base = np.log10((c + 1.0) / denominator)
        upto = np.concatenate([[0], np.cumsum(n)])
        begin, full = upto[:-1], np.flatnonzero(n)

        def total(v):                              # each text by itself, so that equal texts get equal sums
            out = np.zeros(len(n))
            out[full] = np.add.reduceat(v[at], begin[full]) if len(full) else 0.0
            return out
        flat, learn = symbol[at], _one(docs, "learn").to_numpy(zero_copy_only=False)
        other = np.where(rank >= 0, rank, size + less).astype(kind)[at]
        return pa.table({"doc_id": _one(docs, "doc_id"), "held_out": _one(docs, "held_out"),
                         "n_words": pa.array(n, pa.int64()), "known_words": pa.array(total((c > 0).astype(float)).astype(np.int64)),
                         "base": pa.array(total(base)), "share": pa.array(total(share)),
                         "symbols": pa.array([flat[a:b].tobytes() for a, b in zip(upto[:-1], upto[1:])], pa.binary()),
                         "lesson": pa.array([other[a:b].tobytes() if y else None for a, b, y in zip(upto[:-1], upto[1:], learn)], pa.binary())})
    return run


# ---- network -----------------------------------------------------------------------------------------

def class_of(symbol: np.ndarray, freq: int, per: int) -> np.ndarray:
    return np.where(symbol < freq * per, symbol // per, symbol - freq * per + freq)


def start_weights(word_counts: np.ndarray, class_counts: np.ndarray, seed: int = 5) -> dict[str, np.ndarray]:
    """Random and small but for the output biases, which are the logs of the corpus frequencies."""
    rng = np.random.default_rng(seed)
    form = shapes(len(word_counts), len(class_counts))
    w = {k: (rng.standard_normal(s) * (0.3 if k == "u" else 0.1)).astype(np.float32) for k, s in form.items()}
    w["x"][:, :HIDDEN] += 1.0
    w["bc"] = np.log(class_counts + 0.5).astype(np.float32)
    w["bo"] = np.log(word_counts.reshape(form["bo"]) + 0.5).astype(np.float32)
    return w


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def _layout(docs: list[np.ndarray], end: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(order, longest first; lengths with the end; symbols of all in a row, each led and closed by the end; starts)."""
    size = np.fromiter(map(len, docs), np.int64, len(docs)) + 1
    order = np.argsort(-size, kind="stable")
    flat = np.concatenate([np.append(np.append(end, docs[i]), end) for i in order]).astype(np.int64)
    return order, size[order], flat, np.concatenate([[0], np.cumsum(size[order] + 1)])[:-1]


def _steps(w, h, flat, starts, size, t0: int, t1: int, keep: bool):
    """Runs steps t0..t1-1 on the states ``h`` (changed in place); the states after each step, and what backpropagation needs."""
    out, saved_, H = [], [], HIDDEN
    for t in range(t0, t1):
        n = int(np.searchsorted(-size, -t, "left"))          # documents longer than t
        s = flat[starts[:n] + t]
        x, hp = w["x"][s], h[:n]
        a = hp @ w["u"]
        g = _sigmoid(x[:, :2 * H] + a[:, :2 * H])
        z, r = g[:, :H], g[:, H:]
        q = a[:, 2 * H:]
        c = np.tanh(x[:, 2 * H:] + r * q)
        new = c + z * (hp - c)
        if keep:
            saved_.append((s, hp.copy(), z, r, q, c))
        h[:n] = new
        out.append(new)
    return out, saved_


def _outputs(w, hs: np.ndarray, target: np.ndarray, learn: bool):
    """Natural-log probabilities of the targets; with ``learn`` also the gradients of their negative sum."""
    m = np.arange(len(target))
    freq, per = w["bo"].shape
    cls = class_of(target, freq, per)
    lc = hs @ w["wc"] + w["bc"]
    lc -= lc.max(axis=1, keepdims=True)
    own = lc[m, cls].copy()
    e = np.exp(lc, out=lc)
    tot = e.sum(axis=1)
    logp = own - np.log(tot)
    grad = {}
    if learn:
        e /= tot[:, None]
        e[m, cls] -= 1
        grad["wc"], grad["bc"], dh = hs.T @ e, e.sum(axis=0), e @ w["wc"].T
        grad["wo"], grad["bo"] = np.zeros(w["wo"].shape, np.float32), np.zeros(w["bo"].shape, np.float32)
    order = np.argsort(cls, kind="stable")
    cut = np.searchsorted(cls[order], np.arange(freq + 1))
    for g in range(freq):
        i = order[cut[g]:cut[g + 1]]
        if not len(i):
            continue
        k, word, sub = np.arange(len(i)), target[i] % per, hs[i]
        lo = sub @ w["wo"][g] + w["bo"][g]
        lo -= lo.max(axis=1, keepdims=True)
        own = lo[k, word].copy()
        e = np.exp(lo, out=lo)
        tot = e.sum(axis=1)
        logp[i] += own - np.log(tot)
        if learn:
            e /= tot[:, None]
            e[k, word] -= 1
            grad["wo"][g], grad["bo"][g] = sub.T @ e, e.sum(axis=0)
            dh[i] += e @ w["wo"][g].T
    return (logp, grad, dh) if learn else (logp, None, None)


def score_docs(w: dict, docs: list[np.ndarray]) -> np.ndarray:
    """Natural-log probability of each document's symbols and end."""
    if not docs:
        return np.zeros(0)
    order, size, flat, starts = _layout(docs, len(w["x"]) - 1)
    h, total = np.zeros((len(docs), HIDDEN), np.float32), np.zeros(len(docs))
    t = 0
    while t < size[0]:
        n = int(np.searchsorted(-size, -t, "left"))
        span = int(np.clip(60_000 // max(n, 1), 4, 512))      # steps whose outputs are computed together
        stop = min(t + span, int(size[0]))
        out, _ = _steps(w, h, flat, starts, size, t, stop, False)
        target = np.concatenate([flat[starts[:len(o)] + t + 1 + i] for i, o in enumerate(out)])
        logp, _, _ = _outputs(w, np.concatenate(out), target, False)
        at = 0
        for o in out:
            total[:len(o)] += logp[at:at + len(o)]
            at += len(o)
        t = stop
    result = np.empty(len(docs))
    result[order] = total
    return result


def train_docs(w: dict, docs: list[np.ndarray], memory: dict) -> int:
    """Truncated backpropagation over the documents, ``BATCH`` abreast; changes ``w``. ``memory``: Adagrad's squares."""
    H, seen = HIDDEN, 0
    by_size = sorted(range(len(docs)), key=lambda i: len(docs[i]))
    groups = [by_size[i:i + BATCH] for i in range(0, len(by_size), BATCH)]
    rng = np.random.default_rng(len(docs))
    for gi in rng.permutation(len(groups)):
        _, size, flat, starts = _layout([docs[i] for i in groups[gi]], len(w["x"]) - 1)
        h = np.zeros((len(size), H), np.float32)
        for t in range(0, int(size[0]), WINDOW):
            stop = min(t + WINDOW, int(size[0]))
            out, kept = _steps(w, h, flat, starts, size, t, stop, True)
            target = np.concatenate([flat[starts[:len(o)] + t + 1 + i] for i, o in enumerate(out)])
            _, grad, dhs = _outputs(w, np.concatenate(out), target, True)
            m = len(target)
            seen += m
            ends = np.cumsum([len(o) for o in out])
            du, dx, sym = np.zeros(w["u"].shape, np.float32), [], []
            carry = np.zeros((0, H), np.float32)
            for i in range(len(out) - 1, -1, -1):
                s, hp, z, r, q, c = kept[i]
                dh = dhs[ends[i] - len(s):ends[i]]
                dh[:len(carry)] += carry
                dc = dh * (1 - z) * (1 - c * c)
                dq = dc * r
                da = np.concatenate([dh * (hp - c) * z * (1 - z), dc * q * r * (1 - r), dc], axis=1)
                back = np.concatenate([da[:, :2 * H], dq], axis=1)
                du += hp.T @ back
                carry = dh * z + back @ w["u"].T
                dx.append(da)
                sym.append(s)
            grad["u"] = du
            sym, dx = np.concatenate(sym), np.concatenate(dx)
            o = np.argsort(sym, kind="stable")
            rows, first = np.unique(sym[o], return_index=True)
            gx = np.add.reduceat(dx[o], first, axis=0) / m
            memory["x"][rows] += gx * gx
            w["x"][rows] -= RATE * gx / (np.sqrt(memory["x"][rows]) + 1e-6)
            for k, g in grad.items():
                g = g / m
                memory[k] += g * g
                w[k] -= RATE * g / (np.sqrt(memory[k]) + 1e-6)
    return seen


def _symbols(column: pa.Array, w: dict) -> list[np.ndarray]:
    return [np.frombuffer(b, _kind(len(w["x"]))) for b in column.to_pylist()]


def _groups(batches, most: int = 1_500_000):
    """Record batches in parts of at most about ``most`` symbols."""
    for b in batches:
        n = b.column("n_words").to_numpy()
        upto, at = np.cumsum(n), 0
        while at < len(n):
            end = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + most, "right")))
            yield b.slice(at, end - at)
            at = end


def flat_weights(w: dict) -> np.ndarray:
    return np.concatenate([w[k].ravel() for k in SHAPES]).astype(np.float64)


def from_flat(v: np.ndarray, form: dict[str, tuple]) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for k, s in form.items():
        n = int(np.prod(s))
        out[k] = v[at:at + n].reshape(s).astype(np.float32)
        at += n
    return out


def _trainer(start: dict):
    def run(batches):
        from pyspark import TaskContext
        w = {k: v.copy() for k, v in start.items()}
        memory = {k: np.full(v.shape, 1e-8, np.float32) for k, v in start.items()}
        seen = 0
        for b in _groups(batches):
            docs = _symbols(b.column("lesson").drop_null(), w)
            if docs:
                seen += train_docs(w, docs, memory)
        if seen:
            yield pa.RecordBatch.from_arrays(
                [pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([float(seen)]), pa.array([(flat_weights(w) * seen).tobytes()], pa.binary())],
                names=["part", "n", "sums"])
    return run


def _merge(table: pa.Table) -> pa.Table:
    sums = _one(table, "sums")
    total = np.zeros(len(sums[0].as_py()) // 8)
    for b in sums:
        total += np.frombuffer(b.as_py())
    return pa.table({"part": pa.array([table["part"][0].as_py()], pa.int64()), "n": [float(pc.sum(table["n"]).as_py())],
                     "sums": pa.array([total.tobytes()], pa.binary())})


def train(symbols: DataFrame, start: dict) -> dict:
    """The mean of what the tasks have learned from ``symbols`` (n_words, lesson)."""
    kind = "part long, n double, sums binary"
    total = symbols.agg(F.sum("n_words")).first()[0] or 0
    symbols = symbols.coalesce(max(1, -(-total // PART)))          # too little in a part learns too little
    fan = max(2, min(FAN, FAN_BYTES // flat_weights(start).nbytes))
    parts = saved(symbols.select("n_words", "lesson").mapInArrow(_trainer(start), kind), "lm-parts")
    while parts.count() > 1:
        parts = saved(parts.withColumn("part", F.expr(f"part div {fan}")).groupBy("part").applyInArrow(_merge, kind), "lm-means")
    got = parts.collect()
    return from_flat(np.frombuffer(got[0]["sums"]) / got[0]["n"], {k: v.shape for k, v in start.items()}) if got else start


def _scorer(w: dict):
    def run(batches):
        for b in _groups(batches):
            got = score_docs(w, _symbols(b.column("symbols"), w)) / np.log(10)
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("doc_id", "held_out", "n_words", "known_words", "base", "share")), pa.array(got)],
                                             names=["doc_id", "held_out", "n_words", "known_words", "base", "share", "net"])
    return run


def score(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` for every row; learns from
    the rows whose crc32(doc_id as text) modulo 7 isn't 2. Logarithms are to base 10."""
    held = fold_of(7, 2)
    text = text_or_empty().cast("string")
    size, n_learn = docs.agg(F.sum(F.octet_length(text).cast("long")), F.sum((~held).cast("long"))).first()
    chunks = max(1, -(-(size or 0) // CHUNK))
    d = docs.select("doc_id", F.coalesce(held, F.lit(False)).alias("held_out"), F.coalesce(~held, F.lit(False)).alias("learn"), text.alias("text"),
                    F.pmod(F.xxhash64("doc_id", text), F.lit(chunks)).cast("int").alias("chunk"))
    w = d.select("chunk", "learn", "text").groupBy("chunk").applyInArrow(_count, "chunk int, place int, word string, c long")
    win = Window.partitionBy("word")
    kind = F.when(F.octet_length("word") != F.length("word"), 1).when(F.col("word").rlike("^[a-z]*$"), 0).otherwise(2)
    band = F.floor(F.log2(F.col("c") + 1))
    w = w.select("chunk", "place", "word", F.sum("c").over(win).alias("c"), (F.min("chunk").over(win) == F.col("chunk")).alias("first"))
    less = F.floor(F.log2(F.greatest(F.col("c"), F.lit(1))))
    w = saved(w.withColumns({"cls": (band * KINDS + kind).cast("int"), "less": (less * KINDS + kind).cast("int")}), "lm-words")
    seen = w.where("first and c > 0")
    lessons = {r["less"]: r["c"] for r in seen.groupBy("less").agg(F.sum("c").alias("c")).collect()}
    per = {r["cls"]: (r["n"], r["c"]) for r in seen.groupBy("cls").agg(F.count(F.lit(1)).alias("n"), F.sum("c").alias("c")).collect()}
    ends = n_learn or 0
    tokens_, kinds = sum(c for _, c in per.values()) + ends, sum(n for n, _ in per.values()) + (1 if ends else 0)
    size = top_words(tokens_)
    top = seen.select("word", "c", "cls", "less").orderBy(F.col("c").desc(), "word").limit(size).collect()
    every = max([BANDS * KINDS, *(k + KINDS for k in per)]) // KINDS * KINDS
    left, sums, plain = np.zeros(every), np.zeros(every), np.zeros(every)       # words; of counts plus one; of counts, by the class in training
    for k, (n, c) in per.items():
        left[k], sums[k] = n, n + c
    for k, c in lessons.items():
        plain[k] = c
    for r in top:
        left[r["cls"]] -= 1
        sums[r["cls"]] -= r["c"] + 1
        plain[r["less"]] -= r["c"]
    denominator = float(tokens_ + kinds + 1)
    counts = np.zeros(size)
    counts[:len(top)] = [r["c"] for r in top]
    bands = max([BANDS, *(np.flatnonzero(left) // KINDS + 1)])           # no class is kept for the first words' counts
    start = start_weights(counts, np.concatenate([counts.reshape(shapes(size, 0)["bo"]).sum(axis=1), plain[:bands * KINDS], [ends]]))
    coded = d.select("doc_id", "held_out", "learn", "text", "chunk").groupBy("chunk").cogroup(w.select("chunk", "place", "c", "cls", "less").groupBy("chunk")).applyInArrow(
        _encode([r["word"] for r in top], size, _kind(len(start["x"])), np.log10(np.maximum(sums, 1)), denominator),
        "doc_id long, held_out boolean, n_words long, known_words long, base double, share double, symbols binary, lesson binary")
    coded = saved(coded, "lm-symbols")
    model = train(coded, start)
    out = coded.drop("lesson").mapInArrow(_scorer(model), "doc_id long, held_out boolean, n_words long, known_words long, base double, share double, net double")
    return out.select("doc_id", "held_out", (F.col("n_words") + 1).alias("n_tokens"), (F.col("known_words") + (1 if ends else 0)).alias("n_known"),
                      F.lit(tokens_).cast("long").alias("train_tokens"),
                      (F.col("base") + float(np.log10((ends + 1) / denominator))).alias("base_score"), (F.col("net") + F.col("share")).alias("score"))
