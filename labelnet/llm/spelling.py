"""Groups of spelling variants: words one edit apart, each with its most frequent near word as its form.

Vocabulary: maximal runs of letters, A-Z lower-cased, counted over all texts (Spark aggregates only).

Near pairs: the sorted list of words is scanned with a banded edit matrix. The row of a shared prefix is computed once
for all words behind it: a range of the sorted list with equal first characters (by the lengths of the common prefixes of
neighbours, LCP) is split by its next character, each part extends its range's row by one cell each way, and a part is
skipped as soon as its row exceeds one edit. All words are scanned as queries abreast, so a step is some array operations.

Lists are cut by halves: two near words share their first half or their last (of the shorter one's length), so each word
goes to the lists of its halves, under its own length and that less one; lists of last halves hold reversed words. A pair
counts in the one list where its first difference lies, so no pair is found twice. A list with more than ``LIMIT`` words
is halved again inside the part that may differ, until one character is left there; such a list is bounded by the
alphabet. So each list fits a task, no pairs of a group are listed, and nothing is dropped.

Roots: counts grow by ``ratio`` from a word to its form, so chains are short and are followed by doubling.

Defined cases: a null or empty text has no words; a null doc_id counts as empty in the deletion rule; repeated rows count
twice; ties go to the smallest word in code-point order; an empty table or one without a word twice gives an empty result;
runs of any length are words (a run as long as its text, too); other columns are ignored, whatever their names.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, saved

LEAST = 7          # code points of a word
SEEN = 2           # occurrences of a word
RATIO = 10         # of a form's count to its word's
LIMIT = 4096       # words of a list before it is cut again
QUERIES = 20_000   # words that are scanned abreast
FAR = 64           # characters after which a lone candidate is compared as a whole
LETTERS = "A-Za-zÀ-ÿ"


def vocabulary(docs: DataFrame, least: int = LEAST, seen: int = SEEN, every: int = 31) -> DataFrame:
    """word, n: runs of letters with at least ``least`` code points and ``seen`` occurrences. In a row where ``every``
    divides the crc32 of ``<doc_id>:<run>``, the run lacks one code point (its place: that number modulo the length)."""
    runs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"),
                       F.explode(F.regexp_extract_all(F.col("text").cast("string"), F.lit(f"[{LETTERS}]{{{least},}}"), F.lit(0))).alias("run"))
    runs = runs.select("id", ascii_lower(F.col("run")).alias("low"))
    runs = runs.select("low", F.crc32(F.concat_ws(":", "id", "low")).alias("h"))
    at = F.pmod(F.col("h"), F.length("low").cast("long")).cast("int")
    cut = F.concat(F.substring("low", F.lit(1), at), F.substring(F.col("low"), at + 2, F.length("low")))
    words = runs.select(F.when(F.pmod("h", F.lit(every)) == 0, cut).otherwise(F.col("low")).alias("word"))
    return words.where(F.length("word") >= least).groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= seen)


# --- scanning sorted lists -------------------------------------------------------------------------------------------

class Words:
    """Words in a row as code points."""

    def __init__(self, words: pa.Array):
        self.text = words.to_pylist()
        self.size = np.fromiter(map(len, self.text), np.int64, len(self.text))
        self.start = np.cumsum(self.size) - self.size
        self.cp = np.frombuffer("".join(self.text).encode("utf-32-le"), np.uint32)

    def common(self, i: np.ndarray, j: np.ndarray, back: bool = False) -> np.ndarray:
        """Length of the common prefix (``back``: suffix) of each pair of words."""
        out, live, d = np.zeros(len(i), np.int64), np.arange(len(i)), 0
        most = np.minimum(self.size[i], self.size[j])
        while len(live):
            live = live[most[live] > d]
            if d >= FAR:
                for k in live:
                    u, v = self.text[i[k]], self.text[j[k]]
                    out[k] = _common(u[::-1], v[::-1]) if back else _common(u, v)
                break
            a, b = i[live], j[live]
            x = self.start[a] + self.size[a] - 1 - d if back else self.start[a] + d
            y = self.start[b] + self.size[b] - 1 - d if back else self.start[b] + d
            live = live[self.cp[x] == self.cp[y]]
            d += 1
            out[live] = d
        return out


def _common(u: str, v: str) -> int:
    lo, hi = 0, min(len(u), len(v))
    while lo < hi:
        mid = (lo + hi + 1) // 2
        lo, hi = (mid, hi) if u[lo:mid] == v[lo:mid] else (lo, mid - 1)
    return lo


def one_edit(u: str, v: str) -> bool:
    if len(u) > len(v):
        u, v = v, u
    i = _common(u, v)
    return u != v and len(v) - len(u) <= 1 and (u[i + 1:] == v[i + 1:] if len(u) == len(v) else u[i:] == v[i + 1:])


def near_pairs(w: Words, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``w``: sorted by ``key`` and word, words of a key distinct. Pairs i < j of one key that are one edit apart."""
    n = len(key)
    empty = np.zeros(0, np.int64)
    if n < 2:
        return empty, empty
    same = key[1:] == key[:-1]
    lcp = np.full(n, -1, np.int64)
    pos = np.flatnonzero(same) + 1
    lcp[pos] = w.common(pos - 1, pos)
    head = np.flatnonzero(lcp < 0)                        # where each list begins
    ends = np.concatenate([head[1:], [n]])
    of = np.repeat(np.arange(len(head)), ends - head)
    least = np.minimum.reduceat(np.where(lcp < 0, np.iinfo(np.int64).max, lcp), head)
    # the places where a range of depth d is split, by (d, place)
    order = np.lexsort((pos, lcp[pos]))
    split_at, split_key = pos[order], lcp[pos][order] * (n + 1) + pos[order]
    got_i, got_j = [], []
    todo = np.flatnonzero(np.arange(n) + 1 < ends[of])    # the last word of a list has none behind it
    for part in np.array_split(todo, max(1, -(-len(todo) // QUERIES))):
        q, lo, hi, d = part, part + 1, ends[of[part]], least[of[part]]
        e0, e1, e2 = (np.full(len(q), x, np.int64) for x in (1, 0, 1))    # edits to the query's first d-1, d, d+1 characters
        e0[d == 0] = 9
        e2[w.size[q] <= d] = 9
        while len(q):
            done = w.size[lo] == d                         # a word ends here: it is the first of its range
            if done.any():
                gap = w.size[q] - d
                e = np.where(gap == 0, e1, np.where(gap == 1, e2, np.where(gap == -1, e0, 9)))
                hit = done & (e <= 1)
                got_i.append(q[hit])
                got_j.append(lo[hit])
                lo = lo + done
            far = (hi - lo == 1) & (w.size[np.minimum(lo, n - 1)] - d > FAR)
            for k in np.flatnonzero(far):
                if one_edit(w.text[q[k]], w.text[lo[k]]):
                    got_i.append(q[k:k + 1])
                    got_j.append(lo[k:k + 1])
            on = (lo < hi) & ~far
            if not on.all():
                q, lo, hi, d, e0, e1, e2 = (x[on] for x in (q, lo, hi, d, e0, e1, e2))
            # parts of each range: one from its start, one from each split inside it
            a = np.searchsorted(split_key, d * (n + 1) + lo, "right")
            count = np.searchsorted(split_key, d * (n + 1) + hi, "left") - a
            upto = np.cumsum(count + 1)
            which = np.repeat(np.arange(len(q)), count + 1)
            step = np.arange(len(which)) - (upto - count - 1)[which]
            begin = np.where(step == 0, lo[which], split_at[np.minimum(a[which] + step - 1, max(len(split_at) - 1, 0))] if len(split_at) else lo[which])
            end = np.empty(len(which), np.int64)
            end[:-1] = begin[1:]
            end[upto - 1] = hi
            q, d, e0, e1, e2 = q[which], d[which], e0[which], e1[which], e2[which]
            c = w.cp[w.start[begin] + d]
            size, first = w.size[q], w.start[q]
            last = len(w.cp) - 1

            def differs(y):
                return (w.cp[np.minimum(first + y, last)] != c) | (y >= size)

            f0 = np.minimum(e1 + 1, np.where(d > 0, e0 + differs(np.maximum(d - 1, 0)), 9))
            f1 = np.where(d + 1 > size, 9, np.minimum(np.minimum(e2, f0) + 1, e1 + differs(d)))
            f2 = np.where(d + 2 > size, 9, np.minimum(f1 + 1, e2 + differs(d + 1)))
            f0 = np.where(d > size, 9, f0)
            keep = np.minimum(np.minimum(f0, f1), f2) <= 1
            q, lo, hi, d, e0, e1, e2 = (x[keep] for x in (q, begin, end, d + 1, f0, f1, f2))
    return (np.concatenate(got_i), np.concatenate(got_j)) if got_i else (empty, empty)


_PAIRS = "u string, nu long, v string, nv long"


def _scan(batches):
    names = ["u", "nu", "v", "nv"]

    def found(t: pa.Table):
        w = Words(t.column("s"))
        size, back = w.size, t.column("back").to_numpy(zero_copy_only=False)
        n, c, a, z = (t.column(x).to_numpy() for x in ("n", "c", "a", "z"))
        i, j = near_pairs(w, t.column("key").to_numpy())
        p = np.zeros(len(i), np.int64)                    # the first difference, in the words as they are written
        for side in (False, True):
            of = np.flatnonzero(back[i] == side)
            p[of] = w.common(i[of], j[of], bool(side))
        own = (np.minimum(size[i], size[j]) == c[i]) & (p >= a[i]) & ((z[i] == 0) | (p < c[i] - z[i]))
        i, j = i[own], j[own]
        written = [x[::-1] if b else x for x, b in zip(w.text, back.tolist())] if len(i) else []
        return pa.RecordBatch.from_arrays([pa.array([written[k] for k in i], pa.string()), pa.array(n[i]),
                                           pa.array([written[k] for k in j], pa.string()), pa.array(n[j])], names=names)

    rest = None
    for b in batches:
        t = pa.Table.from_batches([b])
        t = t if rest is None else pa.concat_tables([rest, t])
        t = t.combine_chunks()
        key = t.column("key").to_numpy()
        if not len(key):
            continue
        cut = int(np.flatnonzero(key == key[-1])[0])      # the last list may go on in the next batch
        rest = t.slice(cut)
        if cut:
            yield found(pa.Table.from_batches(t.slice(0, cut).combine_chunks().to_batches()))
    if rest is not None:
        yield found(rest.combine_chunks())


def _keyed(rows: DataFrame) -> DataFrame:
    same = (F.substring(F.col("word"), F.lit(1), F.col("a")), F.when(F.col("z") > 0, F.expr("right(word, z)")).otherwise(""))
    return rows.withColumn("key", F.xxhash64("c", "a", "z", *same))


def _lists(words: DataFrame, limit: int) -> DataFrame:
    """A row for each word and list: word, n, c (length of the shorter word of a pair), a and z (characters that are
    shared in front and at the end), key. No list of more than ``limit`` words but where one character may differ."""
    c = F.explode(F.filter(F.array(F.length("word"), F.length("word") - 1), lambda x: x > 0)).alias("c")
    half = F.floor(F.col("c") / 2).cast("int")
    window = F.array(F.struct(half.alias("a"), F.lit(0).alias("z")), F.struct(F.lit(0).alias("a"), (F.col("c") - half).alias("z")))
    rows = words.select("word", "n", c).select("word", "n", "c", F.explode(window).alias("x")).select("word", "n", "c", "x.a", "x.z")
    rows, ready = _keyed(rows), None
    while True:
        hot = rows.where(F.col("c") - F.col("a") - F.col("z") > 1).groupBy("key").agg(F.count(F.lit(1)).alias("m")).where(F.col("m") > limit)
        hot = saved(hot.select("key"), "spelling-hot")
        cool = rows if hot.isEmpty() else rows.join(hot, "key", "left_anti")
        ready = cool if ready is None else ready.unionByName(cool)
        if hot.isEmpty():
            return ready
        more = F.floor((F.col("c") - F.col("a") - F.col("z")) / 2).cast("int")
        window = F.array(F.struct((F.col("a") + more).alias("a"), F.col("z").alias("z")),
                         F.struct(F.col("a").alias("a"), (F.col("c") - F.col("a") - more).alias("z")))
        rows = rows.join(hot, "key", "left_semi").select("word", "n", "c", F.explode(window).alias("x")).select("word", "n", "c", "x.a", "x.z")
        rows = saved(_keyed(rows), "spelling-cut")


def near_words(words: DataFrame, limit: int = LIMIT) -> DataFrame:
    """u, nu, v, nv: every pair of ``words`` (word, n; distinct) that one inserted, deleted or replaced character tells
    apart, once."""
    rows = _lists(words, limit)
    back = F.col("z") > F.col("a")
    rows = rows.select("key", F.when(back, F.reverse("word")).otherwise(F.col("word")).alias("s"), "n", "c", "a", "z", back.alias("back"))
    return rows.repartition("key").sortWithinPartitions("key", "s").mapInArrow(_scan, _PAIRS)


def variants(words: DataFrame, ratio: int = RATIO, limit: int = LIMIT) -> DataFrame:
    """word, form, root, n, n_near, form_n for each of ``words``."""
    words = saved(words, "spelling-words")
    pairs = near_words(words, limit).select(F.explode(F.array(
        F.struct(F.col("u").alias("word"), F.col("v").alias("near"), F.col("nv").alias("m")),
        F.struct(F.col("v").alias("word"), F.col("u").alias("near"), F.col("nu").alias("m")))).alias("x")).select("x.*")
    best = pairs.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("m")).alias("m"), "near")).alias("best"))
    takes = -F.col("best.m") >= F.col("n") * ratio
    out = words.join(best, "word", "left").select(
        "word", F.when(takes, F.col("best.near")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(takes, -F.col("best.m")).alias("form_n"))
    out = saved(out, "spelling-forms")
    most = words.agg(F.max("n")).first()[0] or 1
    steps = max(1, math.ceil(math.log(most, ratio)) + 1)   # forms in a row: each has at least ratio times the count
    root = out.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    for _ in range(math.ceil(math.log2(steps)) if steps > 1 else 0):
        root = saved(root, "spelling-roots")
        to = root.select(F.col("word").alias("root"), F.col("root").alias("next"))
        root = root.join(to, "root", "left").select("word", F.coalesce("next", "root").alias("root"))
    return out.join(root, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def grouped(docs: DataFrame) -> DataFrame:
    """Spelling variants among the words of ``docs``."""
    return variants(vocabulary(docs))
