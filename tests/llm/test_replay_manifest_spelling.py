import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import functions as F

from labelnet.llm import merge_replay, merkle, spelling, tokens

from .fixture import empty, frame, rows

RANKS, MULTI = tokens.vocabulary("byte_bpe_50k.tiktoken"), tokens.vocabulary("byte_bpe_multi_50k.tiktoken")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def library(path):
    return tiktoken.Encoding("own", pat_str=tokens.pattern(), mergeable_ranks=merge_replay.ranks_of(path).ids, special_tokens={})


# --- merge replay ----------------------------------------------------------------------------------------------------

def test_replayed_ids_are_the_librarys_ids():
    rng = random.Random(4)
    texts = [r[1] or "" for r in rows()] + ["", " ", "  ", "a  b", "\n\na \nb  ", "x ", "é ü  b　　c d", "aaaaaaaaaaa" * 50, "ab" * 1000,
                                            "I'll don't 's's", "\x1c\x1d a\x1e \x1f", "日本語 テキスト 123 ١٢٣ ", "a\u0085 b   c", "🤗🤗 x🤗", "\r\n\r\n\tx"]
    texts += ["".join(rng.choice(" \n\tab'sé 　.,1９日l") for _ in range(rng.randint(1, 40))) for _ in range(500)]
    texts += ["".join(chr(rng.choice([rng.randrange(0, 0xD800), rng.randrange(0xE000, 0x30000)])) for _ in range(20)) for _ in range(500)]
    words, seq, at = merge_replay.words_of(pa.array(texts), merge_replay.splitter(tokens.pattern()))
    for path in (RANKS, MULTI):
        enc, ranks = library(path), merge_replay.ranks_of(path)
        ids, of = merge_replay.encode_words(words, ranks)
        for i, t in enumerate(texts):
            got = [int(x) for w in seq[at[i]:at[i + 1]] for x in ids[of[w]:of[w + 1]]]
            assert got == enc.encode_ordinary(t), t
        for w in words.to_pylist():
            assert w.encode() in ranks.ids or ranks.alone(w.encode()) == enc.encode_ordinary(w)


def test_words_are_the_librarys_for_every_character():
    """Each character between letters, digits, marks and blanks: the ids of single bytes tell nothing, so ranks are used in
    which any two neighbours of a match may merge."""
    ids = {bytes([b]): b for b in range(256)}
    for lead in range(0xC2, 0xF5):
        for p in b"b1!":
            ids[bytes([p, lead])] = len(ids)
    enc, split = tiktoken.Encoding("own", pat_str=tokens.pattern(), mergeable_ranks=ids, special_tokens={}), merge_replay.splitter(tokens.pattern())
    for c in [*range(0x80, 0x20000), *range(0x20000, 0x110000, 97)]:
        if not 0xD800 <= c < 0xE000:
            text = f"b{chr(c)}1{chr(c)}!{chr(c)}"
            got = split.findall(text)
            assert sum(len(w.encode()) for w in got) == len(text.encode())
            one = sum(len(enc.encode_ordinary(w)) for w in got)
            assert one == len(enc.encode_ordinary(text)), hex(c)


def test_packed_numbers_come_back():
    for x in ([], [0], [255, 256, 3], [2 ** 32 - 1, 0, 7]):
        assert merge_replay.unpack_ints(merge_replay.pack_ints(np.array(x, np.int64))).tolist() == x
    assert merge_replay.parted(merge_replay.joined(b"", b"ab", b"c")) == [b"", b"ab", b"c"] and merge_replay.parted(b"") == []


def test_replay_of_ranks_that_go_back():
    """A vocabulary in which a merge makes a pair of a lower rank: those words are done in their own order."""
    ranks = merge_replay.Ranks.__new__(merge_replay.Ranks)
    ids = {bytes([b]): b for b in range(256)} | {b"cab": 256, b"ab": 257, b"xy": 258}
    ranks.ids, ranks.count, ranks.byte = ids, 259, np.arange(256, dtype=np.int32)
    pairs = {(ids[t[:i]], ids[t[i:]]): r for t, r in ids.items() for i in range(1, len(t)) if t[:i] in ids and t[i:] in ids}
    ranks.keys = np.array(sorted(a << 32 | b for a, b in pairs), np.int64)
    ranks.rank = np.array([pairs[int(k) >> 32, int(k) & 0xFFFFFFFF] for k in ranks.keys], np.int32)
    b = np.arange(256)
    ranks.byte_pair = ranks.pair(ranks.byte[np.repeat(b, 256)], ranks.byte[np.tile(b, 256)])
    words = ["cabab", "xycab", "zab", "ccabxy"]
    got, at = merge_replay.encode_words(pa.array(words), ranks)
    assert [got[at[i]:at[i + 1]].tolist() for i in range(4)] == [ranks.alone(w.encode()) for w in words]
    assert ranks.alone(b"cabab") == [256, 257]


def test_encode_and_decode_whole_tables(spark):
    enc = library(RANKS)
    long = "".join(random.Random(1).choice("abc de\n") for _ in range(200)) * 45_000        # longer than a slice
    docs = frame(spark).select("doc_id", "text", "k").unionByName(
        spark.createDataFrame([(900, long, 900)], "doc_id long, text string, k long"))
    out = merge_replay.decode_ids(merge_replay.encode(docs, RANKS, tokens.pattern(), keep=("doc_id", "k")), RANKS)
    assert out.columns == ["doc_id", "k", "ids", "decoded"]
    want = Counter((r[0], r[0], zlib.crc32(str(enc.encode_ordinary(r[1] or "")).encode()), (r[1] or "").encode()) for r in rows())
    want[900, 900, zlib.crc32(str(enc.encode_ordinary(long)).encode()), long.encode()] = 1
    assert Counter((r.doc_id, r.k, zlib.crc32(str(r.ids).encode()), bytes(r.decoded)) for r in out.collect()) == want
    assert merge_replay.encode(empty(spark), RANKS, tokens.pattern()).count() == 0
    odd = spark.createDataFrame([([31373, -1, 10 ** 6, 995],), ([],), (None,)], "ids array<int>")
    assert [r.decoded and bytes(r.decoded) for r in merge_replay.decode_ids(odd, RANKS).collect()] == [b"hello world", b"", None]


# --- manifest --------------------------------------------------------------------------------------------------------

def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def brute_manifest(data, fanout=2):
    """(leaf, subroot, root, levels of siblings as (before, after)) for rows (group, order, leaf), in their order."""
    def tree(nodes):
        paths, at = [[] for _ in nodes], list(range(len(nodes)))
        while len(nodes) > 1:
            for i, p in enumerate(at):
                run = p - p % fanout
                paths[i].append(("".join(nodes[run:p]), "".join(nodes[p + 1:run + fanout])))
            nodes = [sha(*nodes[i:i + fanout]) for i in range(0, len(nodes), fanout)]
            at = [p // fanout for p in at]
        return nodes[0], paths
    groups = {}
    for g, o, leaf in data:
        groups.setdefault("" if g is None else "=" + g, []).append((o is not None, o or 0, leaf))
    names = sorted(groups, key=str.encode)
    trees = {g: tree([x[2] for x in sorted(groups[g])]) for g in names}
    root, above = tree([trees[g][0] for g in names])
    return Counter((x[2], trees[g][0], root, tuple(trees[g][1][i] + above[k]))
                   for k, g in enumerate(names) for i, x in enumerate(sorted(groups[g])))


def leaf_text(r):
    vals = dict(zip(("doc_id", "text", "lang", "source", "n_chars"), r))
    return sha(*("-" if vals[c] is None else f"{len(str(vals[c]).encode())}:{vals[c]}" for c in merkle.FIELDS))


def test_manifest_is_the_tree_built_by_hand(spark):
    rng = random.Random(2)
    data = [(rng.choice([None, "", "a", "é", "-"] + ["hot"] * 6), rng.choice([None, *range(40)]), sha(str(i))) for i in range(400)]
    data += [("one", 1, sha("x")), ("two", 1, sha("y")), ("two", 1, sha("y"))]
    df = spark.createDataFrame(data, "g string, o long, leaf string")
    for fanout in (2, 3):
        out = merkle.manifest(df, "g", "o", fanout=fanout).withColumn("folded", merkle.fold(F.col("leaf"), F.col("path"))).collect()
        assert Counter((r.leaf, r.subroot, r.root, tuple((p.before, p.after) for p in r.path)) for r in out) == brute_manifest(data, fanout)
        assert all(r.folded == r.root for r in out)
    one = merkle.manifest(df.where("g = 'one'"), "g", "o").collect()
    assert [(r.leaf, r.subroot, r.root, r.path) for r in one] == [(sha("x"), sha("x"), sha("x"), [])]


def test_tampered_rows_are_found(spark):
    out = merkle.tampered_manifest(frame(spark)).collect()
    want = brute_manifest([(r[2], r[0], leaf_text(r)) for r in rows()])
    assert Counter((r.leaf, r.subroot, r.root, r.proof_sha256) for r in out) == Counter(
        (a, b, c, sha(*(x for p in path for x in p))) for a, b, c, path in want.elements())
    hit = {r[0] for r in rows() if r[0] is not None and r[4] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0}
    assert hit and {r.doc_id for r in out if not r.verified} == hit
    assert all((r.folded_root == r.root) == r.verified for r in out)
    assert merkle.tampered_manifest(empty(spark)).count() == 0


# --- spelling variants -----------------------------------------------------------------------------------------------

def brute_variants(count):
    near = {u: [v for v in count if abs(len(u) - len(v)) < 2 and spelling.one_edit(u, v)] for u in count}
    form = {}
    for u, vs in near.items():
        top = min(vs, key=lambda v: (-count[v], v), default=None)
        if top and count[top] >= 10 * count[u]:
            form[u] = top
    def root(u):
        while u in form:
            u = form[u]
        return u
    return {(u, form.get(u), root(u), count[u], len(near[u]), count.get(form.get(u))) for u in count}


def test_one_edit_is_levenshtein_one_and_scans_find_all():
    rng = random.Random(1)

    def edits(u, v):
        p = list(range(len(v) + 1))
        for i, a in enumerate(u, 1):
            c = [i]
            for j, b in enumerate(v, 1):
                c.append(min(p[j] + 1, c[-1] + 1, p[j - 1] + (a != b)))
            p = c
        return p[-1]
    base = "".join(rng.choice("abc") for _ in range(3000))
    lists = [sorted({"".join(rng.choice("abcé") for _ in range(rng.randint(0, 6))) for _ in range(rng.randint(1, 40))}) for _ in range(80)]
    lists.append(sorted({base, base + "a", base[:2000] + base[2001:], base[:1000] + "z" + base[1001:], "q" + base, base[:100], base[::-1]}))
    key = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
    words = [w for x in lists for w in x]
    i, j = spelling.near_pairs(spelling.Words(pa.array(words)), key)
    got = [(key[a], words[a], words[b]) for a, b in zip(i, j)]
    want = {(k, u, v) for k, x in enumerate(lists) for n, u in enumerate(x) for v in x[n + 1:]
            if (edits(u, v) == 1 if len(u) < 50 else spelling.one_edit(u, v))}
    assert len(got) == len(set(got)) and set(got) == want and sum(k == len(lists) - 1 for k, *_ in want) >= 4


def test_variants_are_brute_force_whatever_the_lists_bound(spark):
    rng = random.Random(3)
    words = {"".join(rng.choice("abé") for _ in range(rng.randint(1, 9))) for _ in range(500)} | {"prefix" + x + y for x in "abcdefgh" for y in "abcdefgh"}
    count = {w: int(10 ** rng.uniform(0.31, 3.5)) for w in sorted(words)}
    count |= {"linked": 3, "linkedx": 40, "linkedxy": 500}       # a form that has a form, whatever was drawn
    df = spark.createDataFrame(sorted(count.items()), "word string, n long")
    want = brute_variants(count)
    for limit in (4096, 5):
        out = spelling.variants(df, limit=limit).collect()
        assert len(out) == len(want) and {tuple(r) for r in out} == want
    assert len({r[2] for r in want if r[1]}) > 3 and any(r[1] != r[2] for r in want if r[1])


def test_spelling_groups_of_odd_tables(spark):
    data = [(r[0], r[1]) for r in rows()]
    data += [(300 + i, "Straßen straßen STRASSEN naïvement xnaïvement ×÷×÷×÷× " * 12 + "naivement " + "q" * 5000) for i in range(2)]
    docs = spark.createDataFrame([(d, t, 1) for d, t in data], "doc_id long, text string, word int")
    count = Counter()
    for d, t in data:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            low = run.translate(LOW)
            h = zlib.crc32(f"{'' if d is None else d}:{low}".encode())
            if h % 31 == 0:
                low = low[:h % len(low)] + low[h % len(low) + 1:]
            count[low] += len(low) >= 7
    want = brute_variants({w: n for w, n in count.items() if n >= 2})
    out = spelling.grouped(docs).collect()
    assert len(out) == len(want) and {tuple(r) for r in out} == want and any(r[1] for r in want) and any(len(r[0]) == 5000 for r in want)
    assert spelling.grouped(empty(spark)).count() == 0
    assert spelling.grouped(docs.where("doc_id = 40")).count() == 0
