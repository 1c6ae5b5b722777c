import hashlib
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from labelnet.llm import exact_dedup, fingerprints, line_dedup, minhash

from .fixture import empty, frame, rows

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def test_fuse_filter_holds_its_keys_and_little_else():
    rng = np.random.default_rng(3)
    for n in (0, 1, 2, 3, 10, 1000, 50_000):
        keys = rng.integers(0, 1 << 63, n, dtype=np.uint64)
        f = exact_dedup.fuse_build(np.concatenate([keys, keys[:5]]))
        assert exact_dedup.fuse_has(keys, *f).all()
        assert exact_dedup.fuse_has(rng.integers(0, 1 << 63, 100_000, dtype=np.uint64), *f).mean() < 1e-3


@pytest.mark.parametrize("middle", [-1, 20, 1000])
def test_exact_dedup_is_grouping_by_lower_cased_text(spark, middle):
    out = exact_dedup.exact_dedup(frame(spark), F.col("doc_id") <= middle).collect()
    group = {}
    for r in rows():
        group.setdefault((r[1] or "").translate(LOW), []).append(r[0])
    sha = {hashlib.sha256(t.encode()).hexdigest(): t for t in group}
    assert len(out) == len(rows())
    for r in out:
        ids = group[sha[r.text_sha256]]
        top = max((i for i in ids if i is not None), default=None)
        assert (r.keep_id, r.group_size) == (top, len(ids)) and (not r.kept or r.doc_id == top)
    assert sum(r.kept for r in out) == len(group)
    assert exact_dedup.exact_dedup(empty(spark), F.col("doc_id") <= 3).count() == 0


def near(a, b):
    """Within one edit."""
    if abs(len(a) - len(b)) > 1:
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    return a[i + (len(a) >= len(b)):] == b[i + (len(b) >= len(a)):]


def brute_lines(data):
    """What stays of each text, in the order of (doc_id, hash)."""
    def normal(line):
        return re.sub("[ \t\r ]+", " ", line.translate(LOW)).strip(" ")
    occurrences = [(d, p, normal(x)) for d, t in data for p, x in enumerate((t or "").split("\n")) if re.search(r"[^\W_]", x)]
    first = {}
    for d, p, t in occurrences:
        first.setdefault(t, (d, p))
    order = list(first)
    gone = {t for i, t in enumerate(order) if len(t) >= 16 and any(len(u) >= 16 and near(t, u) for u in order[:i])}
    keep = {}
    for d, p, t in occurrences:
        if first[t] != (d, p) or t in gone:
            keep.setdefault(d, set()).add(p)
    return {d: None if t is None else "\n".join(x for p, x in enumerate(t.split("\n")) if p not in keep.get(d, ())) for d, t in data}


def test_line_dedup_is_brute_force(spark):
    data = [(r[0], r[1]) for r in rows() if r[0] is not None]
    data = sorted({d: t for d, t in reversed(data)}.items())                 # one text for each id
    rng = np.random.default_rng(5)
    line = "a line of some length, to be edited in one place or in two"
    for i in range(40):                                                       # substitutions, insertions, deletions, two edits
        s = list(line)
        for _ in range(1 + i % 2):
            p = int(rng.integers(0, len(s)))
            s[p:p + int(rng.integers(0, 2))] = ["z"] * int(rng.integers(0, 2))
        data.append((100 + i, "".join(s) + f"\nown line number {i} {i * 7919} of the document"))
    data += [(200, "x" * 300 + "y"), (201, "x" * 301 + "y"), (202, "y" + "x" * 300), (203, "short\nshort\nshorx\n%%%\n%%%")]
    docs = spark.createDataFrame(data, "doc_id long, text string")
    got = {r.doc_id: r.text for r in line_dedup.deduped(docs).collect()}
    want = brute_lines(data)
    assert got == want
    assert any(want[100 + i].startswith("own") for i in range(40))


def test_line_dedup_of_odd_tables(spark):
    d = frame(spark)
    out = line_dedup.deduped(d)
    assert out.columns == d.columns + ["_n_removed"]                          # the name n_removed is taken
    got = out.collect()
    assert len(got) == len(rows())
    again = [r for r in got if r.doc_id == 1]                                 # the same row three times
    full = next(r[1] for r in rows() if r[0] == 1)
    assert sorted(r.text for r in again) == ["", "", full] and all(r.k == 1 and r.row == "r" for r in again)
    assert [r.text for r in got if r.doc_id == 50] == [None]
    assert line_dedup.deduped(empty(spark)).count() == 0


def shingles(t):
    w = (t or "").lower().split()
    return Counter(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter()


def jaccard(a, b):
    a, b = shingles(a), shingles(b)
    both = sum((a | b).values())
    return sum((a & b).values()) / both if both else 1.0


def brute_classes(data, bound=0.8):
    up = list(range(len(data)))

    def find(i):
        while up[i] != i:
            i = up[i]
        return i
    for i in range(len(data)):
        for j in range(i):
            if find(i) != find(j) and jaccard(data[i], data[j]) >= bound:
                up[max(find(i), find(j))] = min(find(i), find(j))
    return [find(i) for i in range(len(data))]


def test_signatures_agree_as_often_as_the_weighted_jaccard_index():
    rng = np.random.default_rng(0)
    pool = [f"w{i}" for i in range(400)]
    a = [" ".join(rng.choice(pool, 300)) for _ in range(60)]
    b = [t + " " + " ".join(rng.choice(pool, n)) for t, n in zip(a, rng.integers(0, 300, 60))]
    (ra, ba), (rb, bb) = minhash.cells(pa.array(a)), minhash.cells(pa.array(b))
    agree = (minhash.signatures(ra, ba) == minhash.signatures(rb, bb)).mean(axis=1)
    want = np.array([jaccard(x, y) for x, y in zip(a, b)])
    assert np.allclose(minhash.similarity(pa.array(a), pa.array(b)), want)
    assert abs((agree - want).mean()) < 0.02 and np.abs(agree - want).max() < 0.2


def test_near_duplicates_are_the_components_of_brute_force(spark):
    rng = np.random.default_rng(1)
    base = [f"v{i}" for i in rng.integers(0, 1000, 150)]
    data = [(r[0], r[1]) for r in rows() if r[0] is not None and r[0] not in (1, 2)]
    for i in range(60):                                      # a hot group: some pairs lie below the bound, all are linked
        w = list(base)
        for p in rng.integers(0, 150, 1 + i % 3):
            w[p] = f"e{i}"
        data.append((300 + i, " ".join(w)))
    docs = spark.createDataFrame(data, "doc_id long, text string")
    got = {r.doc_id: (r.class_id, r.class_size, r.kept) for r in minhash.near_duplicates(docs).collect()}
    cls = brute_classes([t for _, t in data])
    for i, (d, _) in enumerate(data):
        members = [data[j][0] for j in range(len(data)) if cls[j] == cls[i]]
        assert got[d] == (min(members), len(members), d == min(members))


def test_first_regions_meet_for_every_pair_at_the_bound():
    rng = np.random.default_rng(7)
    often = rng.integers(0, 50, 64)
    sets = []
    for _ in range(60):
        base = rng.integers(0, 1 << 63, int(rng.integers(1, 40)), dtype=np.uint64)
        for _ in range(4):
            sets.append(np.unique(np.concatenate([base[rng.random(len(base)) < 0.95], rng.integers(0, 1 << 63, int(rng.integers(0, 4)), dtype=np.uint64)])))
    begin = np.concatenate([[0], np.cumsum([len(x) for x in sets])])
    got, at, index, n = minhash.first_regions(np.concatenate(sets), begin, often, 0.8)
    seen = 0
    for i, x in enumerate(sets):
        for j, y in enumerate(sets):
            same = len(np.intersect1d(x, y))
            if i != j and (len(x), i) < (len(y), j) and same and same >= 0.8 * (len(x) + len(y) - same):
                seen += 1
                assert np.isin(got[at[i]:at[i] + index[i]], got[at[j]:at[j + 1]]).any()
    assert seen > 50


def templates(n, words=150, own=17, seed=0):
    """Texts of one template whose last words are their own: every pair is just under the bound."""
    rng = np.random.default_rng(seed)
    base = [f"v{i}" for i in rng.integers(0, 1000, words)]
    return [" ".join(base[:words - own] + [f"o{i}x{j}" for j in range(own)]) for i in range(n)]


def star(n, words=150, seed=1):
    """A text and copies of it that are near to it and, mostly, not to each other."""
    rng = np.random.default_rng(seed)
    base, out = [f"s{i}" for i in rng.integers(0, 1000, words)], []
    for i in range(n):
        w, p = list(base), int(rng.integers(0, words - 10))
        w[p:p + 10] = [f"q{i}y{j}" for j in range(10)]
        out.append(" ".join(w))
    return [" ".join(base)] + out


def test_a_template_is_not_paired_with_itself(spark):
    """Candidates stay in proportion to the rows, where all pairs are just under the bound or linked by one text only."""
    assert 0.75 < jaccard(*templates(2)) < 0.8
    counts = {}
    for n in (150, 600):
        data = list(enumerate(templates(n) + star(n)))
        docs = spark.createDataFrame(data, "uid long, text string")
        member = docs.select("uid", F.when(F.col("uid") < n, F.col("uid")).otherwise(n).alias("component"))      # the star is known
        counts[n] = minhash.sharing_pairs(member, docs, 0.8).count()
        assert counts[n] <= 4 * len(data)
    data = list(enumerate(templates(80) + star(80)))
    got = minhash.near_duplicates(spark.createDataFrame(data, "doc_id long, text string")).collect()
    cls = brute_classes([t for _, t in data])
    assert {r.doc_id: r.class_id for r in got} == {i: cls[i] for i, _ in data}


def test_near_dedup_of_odd_tables(spark):
    d = frame(spark)
    out = minhash.near_duplicates(d).collect()
    assert len(out) == len(rows())
    kept = minhash.deduped(d)
    assert kept.columns == d.columns and kept.count() == sum(r.kept for r in out)
    assert [r.kept for r in out if r.doc_id == 1].count(True) == 1            # of equal rows one stays
    assert minhash.near_duplicates(empty(spark)).count() == 0 and minhash.deduped(empty(spark)).count() == 0


def lanes(spark, text):
    d = spark.createDataFrame([(1, text)], "k long, text string")
    return fingerprints.vector_sums(d, ["k"]).collect()[0]


def test_fingerprints_are_sums_over_paragraphs(spark):
    a, b, ab, ba = (lanes(spark, t) for t in ("one two three four", "five six", "one two three four\nfive six", "five six\none two three four"))
    assert (ab.equal, ab.signs) == (ba.equal, ba.signs)
    d = spark.createDataFrame([(a.equal, a.signs, b.equal, b.signs)], "ae array<long>, as array<short>, be array<long>, bs array<short>")
    r = d.select(fingerprints.combine(F.col("ae"), F.col("be"), 1, 32).alias("e"), fingerprints.combine(F.col("as"), F.col("bs"), 1, 16).alias("s")).collect()[0]
    assert (r.e, r.s) == (ab.equal, ab.signs)
    d = spark.createDataFrame([(ab.equal, ab.signs, b.equal, b.signs)], "ae array<long>, as array<short>, be array<long>, bs array<short>")
    r = d.select(fingerprints.combine(F.col("ae"), F.col("be"), -1, 32).alias("e"), fingerprints.combine(F.col("as"), F.col("bs"), -1, 16).alias("s")).collect()[0]
    assert (r.e, r.s) == (a.equal, a.signs)


def test_lanes_of_copies_are_divided_exactly(spark):
    """Sums beyond 2**53, as 2 M short paragraphs and some copies give them."""
    rng = np.random.default_rng(2)
    for copies in (3, 11, 922):
        lanes = [int(x) for x in rng.integers(1 << 44, 1 << 52, 20)]
        d = spark.createDataFrame([(copies, [x * copies for x in lanes])], "copies long, a array<long>")
        assert d.select(F.expr("transform(a, v -> v div copies)")).first()[0] == lanes
    text = "\n".join(str(i % 97) for i in range(3000))
    one, three = (fingerprints.vector_sums(spark.createDataFrame([(1, text)] * n, "k long, text string"), ["k"]).first() for n in (1, 3))
    assert (one.equal, one.signs, one.copies, three.copies) == (three.equal, three.signs, 1, 3)
    wide = spark.createDataFrame([([1, -128, 127],), ([300, 2, -5],)], "x array<short>")
    assert [r[0] for r in wide.select(fingerprints.wide(fingerprints.narrow(F.col("x")))).collect()] == [[1, -128, 127], [300, 2, -5]]


def test_fingerprint_query_is_brute_force(spark):
    seen, data = set(), []
    for r in rows():
        if r[0] is not None and r[0] not in seen:
            seen.add(r[0])
            data.append((r[0], r[1]))
    out = {r.doc_id: r for r in fingerprints.fingerprints(spark.createDataFrame(data, "doc_id long, text string")).collect()}
    order = sorted(data, reverse=True)

    def triples(t):
        c = Counter()
        for p in t.split("\n"):
            w = p.split(" ")
            c.update(tuple(w[i:i + 3]) for i in range(max(1, len(w) - 2)))
        return c
    miss = []
    for i, (d, t) in enumerate(order):
        t, nxt = t or "", order[(i + 1) % len(order)][1] or ""
        edited = t[:len(t) - len(t) // 2] + nxt[:len(t) // 2]
        r = out[d]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        for other, got in ((edited, r.near_edited), (nxt, r.near_next)):
            a, b = triples(t), triples(other)
            far = sum((a[x] - b[x]) ** 2 for x in set(a) | set(b)) / (sum(v * v for v in a.values()) + sum(v * v for v in b.values()))
            miss.append(got - max(0.0, 1 - far))
    assert np.abs(miss).max() < 0.4 and np.abs(miss).mean() < 0.08
    same = {t or "": out[d].fingerprint for d, t in data}
    assert all(same[t or ""] == out[d].fingerprint for d, t in data) and len(set(same.values())) == len(same)


def test_fingerprints_of_odd_tables(spark):
    out = fingerprints.fingerprints(frame(spark)).collect()
    assert len(out) == len(rows()) and len({r.fingerprint for r in out if r.doc_id == 1}) == 1
    assert fingerprints.fingerprints(empty(spark)).count() == 0
