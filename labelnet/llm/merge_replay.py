"""Byte-level BPE encoding and decoding by replaying the merges over the corpus' distinct words.

A text is cut into words by a published pattern (``tokens.pattern``); each word is encoded for itself, so equal words
have equal ids and each distinct one is replayed once for the whole corpus:

1. Texts are cut in slices (``chunk``). Of a chunk's distinct words those that are no token go out in lists by hash
   ``bucket`` of the word; a text is kept as positions among the chunk's words. One write holds both, so they fit
   together whatever task fails. Positions and lists are packed (byte planes, zstd).
2. The lists of a bucket meet in one group. Its distinct words lie in one row of bytes, an inverted index leads from
   each rank of a token pair to the positions where the pair stands, and the ranks are applied in order: all positions
   of a rank at once (the leftmost first where they overlap), after which only the touched neighbours get new pairs and
   new entries of the index. A word that is a token itself is that token, as in the ``tiktoken`` library.
3. The ids of the words go back to their chunk, where each text's ids are put together.

Nothing is sized by a hot word: a word is in a chunk's table once, so its bucket gets it at most once for each chunk.
Buckets grow with the text; chunks are bounded by bytes (one text at least).

Defined cases: a null or empty text has no ids; repeated rows and a null or repeated doc_id are rows like others; an
empty table gives an empty result; a text longer than a slice is a slice of its own and is encoded whole; other columns
are ignored, whatever their names, unless ``keep`` names them. ``decode_ids`` gives the bytes of rows of ids: null for
null, none for none, and unknown ids are nothing.
"""

from __future__ import annotations

import base64
import heapq

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import tokens
from .common import give_back, saved, text_or_empty

SLICE = 10_000_000             # bytes of text in a chunk
BUCKET = 48_000_000            # bytes of text for each bucket of words
STEP = 400_000                 # ids that are decoded at a time (one row at least)
SEGMENTS = 20_000              # segments that are split into words at a time
NONE = np.int32(2 ** 31 - 1)   # no rank
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_WIDE_SPACE = "[\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]"


class Ranks:
    """A file of ranks: tokens' bytes, and the id that each mergeable pair of ids becomes."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.ids = {base64.b64decode(t): int(r) for t, r in (line.split() for line in f if line.strip())}
        self.count = max(self.ids.values()) + 1
        raw = [b""] * self.count
        for t, r in self.ids.items():
            raw[r] = t
        self.size = np.fromiter(map(len, raw), np.int64, self.count)
        self.start = np.cumsum(self.size) - self.size
        self.flat = np.frombuffer(b"".join(raw), np.uint8)
        self.byte = np.array([self.ids[bytes([b])] for b in range(256)], np.int32)
        pairs = {(self.ids[t[:i]], self.ids[t[i:]]): r for t, r in self.ids.items() for i in range(1, len(t))
                 if t[:i] in self.ids and t[i:] in self.ids}
        keys = np.array([a << 32 | b for a, b in pairs], np.int64)
        order = np.argsort(keys)
        self.keys, self.rank = keys[order], np.fromiter(pairs.values(), np.int32, len(pairs))[order]
        b = np.arange(256)
        self.byte_pair = self.pair(self.byte[np.repeat(b, 256)], self.byte[np.tile(b, 256)])

    def pair(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair of ids, ``NONE`` if the two don't merge."""
        key = a.astype(np.int64) << 32 | b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.rank[at], NONE)

    def alone(self, word: bytes) -> list[int]:
        """Ids of one word, always merging the lowest rank, the leftmost of equals."""
        tok, nxt, prv = [int(self.byte[b]) for b in word], list(range(1, len(word) + 1)), list(range(-1, len(word) - 1))
        raw = [bytes([b]) for b in word]
        heap = [(self.ids[word[i:i + 2]], i, 1, 1) for i in range(len(word) - 1) if word[i:i + 2] in self.ids]
        heapq.heapify(heap)
        while heap:
            r, p, m, n = heapq.heappop(heap)
            q = nxt[p]
            if tok[p] < 0 or q >= len(word) or len(raw[p]) != m or len(raw[q]) != n:
                continue
            tok[p], raw[p], tok[q], nxt[p] = r, raw[p] + raw[q], -1, nxt[q]
            if nxt[q] < len(word):
                prv[nxt[q]] = p
            for x in (prv[p], p):
                if x >= 0 and nxt[x] < len(word) and raw[x] + raw[nxt[x]] in self.ids:
                    heapq.heappush(heap, (self.ids[raw[x] + raw[nxt[x]]], x, len(raw[x]), len(raw[nxt[x]])))
        return [t for t in tok if t >= 0]


def replay(flat: np.ndarray, start: np.ndarray, ranks: Ranks) -> tuple[np.ndarray, np.ndarray]:
    """``flat``: bytes of all words in a row, ``start``: where each begins. Ids of all words in a row and their word."""
    n = len(flat)
    if not n:
        return np.zeros(0, np.int32), np.zeros(0, np.int64)
    kind = np.int32 if n < 2 ** 31 - 1 else np.int64
    word = np.zeros(n, kind)
    word[start[1:]] = 1
    np.cumsum(word, out=word)
    tok = ranks.byte[flat]
    nxt, prv = np.arange(1, n + 1, dtype=kind), np.arange(-1, n - 1, dtype=kind)
    ends = np.concatenate([start[1:], [n]]) - 1
    nxt[ends], prv[start] = -1, -1
    pair = np.full(n, NONE)
    inner = np.flatnonzero(nxt >= 0)
    pair[inner] = ranks.byte_pair[flat[inner].astype(np.int64) * 256 + flat[inner + 1]]
    # the index: positions of each rank, first those of bytes, later what merges add
    first = inner[pair[inner] != NONE]
    first = first[np.argsort(pair[first], kind="stable")]
    cut = np.searchsorted(pair[first], np.arange(ranks.count + 1))
    later: list = [None] * ranks.count
    alive, odd = np.ones(n, bool), []
    for r in range(ranks.count):
        add = later[r]
        if add is None and cut[r] == cut[r + 1]:
            continue
        at = first[cut[r]:cut[r + 1]]
        if add is not None:
            at = np.sort(np.concatenate([at, np.array(add, np.int64)]))
            later[r] = None
        at = at[pair[at] == r]
        if not len(at):
            continue
        if len(at) > 1:                                    # of overlapping positions every other one, from the left
            joint = nxt[at[:-1]] == at[1:]
            if joint.any():
                i = np.arange(len(at))
                head = np.ones(len(at), bool)
                head[1:] = ~joint
                at = at[(i - np.maximum.accumulate(np.where(head, i, 0))) % 2 == 0]
        gone = nxt[at]
        after = nxt[gone]
        tok[at], nxt[at], pair[gone], alive[gone] = r, after, NONE, False
        has = after >= 0
        prv[after[has]] = at[has]
        before = prv[at]
        touched = np.unique(np.concatenate([at, before[before >= 0]]))
        right = nxt[touched]
        new = np.where(right >= 0, ranks.pair(tok[touched], tok[right]), NONE)
        pair[touched] = new
        on = new != NONE
        if on.any():
            touched, new = touched[on], new[on]
            low = new < r
            if low.any():                                  # a rank that is past: such words are done for themselves
                odd.append(word[touched[low]])
                touched, new = touched[~low], new[~low]
            for k, p in zip(new.tolist(), touched.tolist()):
                if later[k] is None:
                    later[k] = [p]
                else:
                    later[k].append(p)
    if odd:
        words = np.unique(np.concatenate(odd))
        alive[np.isin(word, words)] = False
        own = [ranks.alone(flat[start[w]:ends[w] + 1].tobytes()) for w in words]
        ids = np.concatenate([tok[alive], np.array([i for x in own for i in x], np.int32)])
        of = np.concatenate([word[alive], np.repeat(words, [len(x) for x in own])])
        order = np.argsort(of, kind="stable")
        return ids[order], of[order]
    return tok[alive], word[alive]


def encode_words(words: pa.Array, ranks: Ranks) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all (distinct) words in a row, and where each word's begin (one more at the end)."""
    raw = [w if isinstance(w, bytes) else w.encode() for w in words.to_pylist()]
    whole = np.fromiter((ranks.ids.get(w, -1) for w in raw), np.int32, len(raw))
    rest = np.flatnonzero(whole < 0)
    size = np.fromiter((len(raw[i]) for i in rest), np.int64, len(rest))
    rest, size = rest[size > 0], size[size > 0]
    ids, of = replay(np.frombuffer(b"".join(raw[i] for i in rest), np.uint8), np.cumsum(size) - size, ranks)
    count = (whole >= 0).astype(np.int64)
    count[rest] = np.bincount(of, minlength=len(rest)) if len(rest) else 0
    at = np.concatenate([[0], np.cumsum(count)])
    out = np.empty(at[-1], np.int32)
    out[at[:-1][whole >= 0]] = whole[whole >= 0]
    out[spread(at[rest], count[rest])] = ids
    return out, at


def spread(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for ``size`` places, for each pair in turn."""
    upto = np.cumsum(size)
    return np.repeat(start - (upto - size), size) + np.arange(upto[-1] if len(upto) else 0)


_LOADED: dict = {}


def ranks_of(path: str) -> Ranks:
    """One per Python worker."""
    if path not in _LOADED:
        _LOADED[path] = Ranks(path)
    return _LOADED[path]


def segments(texts: pa.Array) -> tuple[pa.LargeStringArray, np.ndarray]:
    """Texts cut in front of each run of white space, and where each text's segments begin (one more at the end).

    No match of the pattern goes from other characters into white space, and none looks beyond the character after a
    run, so the matches of the segments are the matches of the text. Texts with white space beyond ASCII stay whole.
    """
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    texts = pa.concat_arrays([texts])                      # offsets from 0
    offs = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    flat = np.frombuffer(data, np.uint8)[:offs[-1]] if data is not None else np.zeros(0, np.uint8)
    space = _SPACE[flat]
    border = space.copy()
    border[1:] &= ~space[:-1]
    wide = np.flatnonzero(pc.match_substring_regex(texts, _WIDE_SPACE).to_numpy(zero_copy_only=False)) if (flat >= 0x80).any() else ()
    for i in wide:
        border[offs[i]:offs[i + 1]] = False
    full = np.flatnonzero(np.diff(offs))
    border[offs[:-1][full]] = True
    begin = np.flatnonzero(border)
    cuts = np.concatenate([begin, [len(flat)]]).astype(np.int64)
    out = pa.LargeStringArray.from_buffers(len(begin), pa.py_buffer(cuts), pa.py_buffer(flat) if len(flat) else pa.py_buffer(b""))
    return out, np.searchsorted(begin, offs)


class Splitter:
    """Matches of the pattern, with the library's classes of characters.

    The ``regex`` module's table of characters is newer than the library's. Characters that Python's own (older) table
    doesn't know are asked of the library, once for each, and stand as a letter, digit or mark of its kind in the match."""

    def __init__(self, pattern: str):
        import re
        import unicodedata

        import regex
        self.pattern, self.compiled, self.stand_in = pattern, regex.compile(pattern), {}
        new = np.fromiter((unicodedata.category(chr(c)) == "Cn" for c in range(0x110000)), bool, 0x110000)
        edge = np.flatnonzero(np.diff(np.concatenate([[0], new.astype(np.int8), [0]])))
        self.new = re.compile("[" + "".join(f"{chr(a)}-{chr(b - 1)}" for a, b in zip(edge[::2].tolist(), edge[1::2].tolist())) + "]")
        self.probe = None

    def _kind(self, char: str) -> str:
        """``b``, ``1`` or ``!``: what goes with the character in one match. The probe's only merges are of those with a
        character's first byte, so ids are fewer than bytes only within one match."""
        if self.probe is None:
            import tiktoken
            ranks = {bytes([b]): b for b in range(256)}
            for lead in range(0xC2, 0xF5):
                for mark in b"b1":
                    ranks[bytes([mark, lead])] = len(ranks)
            self.probe = tiktoken.Encoding("probe", pat_str=self.pattern, mergeable_ranks=ranks, special_tokens={})
        return next((m for m in "b1" if len(self.probe.encode_ordinary(m + char)) <= len(char.encode())), "!")

    def findall(self, s: str) -> list[str]:
        if s.isascii():
            if (s[1:] if s[:1] == " " else s).isalpha():
                return [s]
        elif self.new.search(s):
            for c in set(self.new.findall(s)):
                if c not in self.stand_in:
                    self.stand_in[c] = self._kind(c)
            like = "".join(self.stand_in.get(c, c) for c in s)
            return [s[m.start():m.end()] for m in self.compiled.finditer(like)]
        return self.compiled.findall(s)


_SPLITTERS: dict = {}


def splitter(pattern: str) -> Splitter:
    """One per Python worker."""
    if pattern not in _SPLITTERS:
        _SPLITTERS[pattern] = Splitter(pattern)
    return _SPLITTERS[pattern]


def words_of(texts: pa.Array, pattern: Splitter) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct words of all texts, each text's words as positions among them in a row, and where each text's begin."""
    segs, at = segments(texts)
    coded = segs.dictionary_encode()
    sizes, found = [np.zeros(0, np.int64)], []
    for i in range(0, len(coded.dictionary), SEGMENTS):    # few words are Python strings at a time
        parts = [pattern.findall(s) for s in coded.dictionary[i:i + SEGMENTS].to_pylist()]
        sizes.append(np.fromiter(map(len, parts), np.int64, len(parts)))
        found.append(pa.array([w for p in parts for w in p], pa.large_string()))
    size = np.concatenate(sizes)
    flat = pa.concat_arrays([pa.array([], pa.large_string()), *found]).dictionary_encode()
    code = flat.indices.to_numpy(zero_copy_only=False)
    of = coded.indices.to_numpy(zero_copy_only=False)
    seq = code[spread((np.cumsum(size) - size)[of], size[of])].astype(np.int64) if len(of) else np.zeros(0, np.int64)
    upto = np.concatenate([[0], np.cumsum(size[of])]) if len(of) else np.zeros(1, np.int64)
    return flat.dictionary, seq, upto[at]


# --- packed columns: what goes to disk is small ----------------------------------------------------------------------

def pack_ints(x: np.ndarray) -> bytes:
    """Numbers from 0 on: how many bits each has, then for each number of bits what follows the first, in byte planes;
    all compressed. Small numbers, which are the frequent ones, don't blur the planes of the others."""
    x = np.ascontiguousarray(x, np.int64)
    bits = np.searchsorted(1 << np.arange(33), x, "right").astype(np.uint8)
    parts = [_squeezed(bits.tobytes())]
    for k in range(2, int(bits.max(initial=0)) + 1):
        low = (x[bits == k] - (1 << (k - 1))).astype("<u4")
        parts.append(_squeezed(low.view(np.uint8).reshape(-1, 4)[:, :(k + 6) // 8].T.tobytes()))
    return joined(*parts)


def unpack_ints(raw: bytes) -> np.ndarray:
    first, *parts = parted(raw)
    bits = np.frombuffer(_restored(first), np.uint8)
    out = (bits > 0).astype(np.int64)
    for k, part in enumerate(parts, 2):
        at = np.flatnonzero(bits == k)
        if len(at):
            low = np.zeros((len(at), 4), np.uint8)
            low[:, :(k + 6) // 8] = np.frombuffer(_restored(part), np.uint8).reshape(-1, len(at)).T
            out[at] = low.view("<u4").reshape(-1) + np.int64(1 << (k - 1))
    return out


def _squeezed(raw: bytes) -> bytes:
    import zstandard
    return zstandard.ZstdCompressor(level=6, write_content_size=True).compress(raw)


def _restored(raw: bytes) -> bytes:
    import zstandard
    return zstandard.ZstdDecompressor().decompress(raw)


def joined(*parts: bytes) -> bytes:
    return b"".join(len(p).to_bytes(8, "little") + p for p in parts)


def parted(raw: bytes) -> list[bytes]:
    out, at = [], 0
    while at < len(raw):
        n = int.from_bytes(raw[at:at + 8], "little")
        out.append(raw[at + 8:at + 8 + n])
        at += 8 + n
    return out


# --- the job ---------------------------------------------------------------------------------------------------------

def _cut(pattern: str, path: str, buckets: int, schema: pa.Schema):
    """Rows of three kinds for each chunk: one for each text (place in the chunk, words), one with the words of all
    texts (``blob``), and one for each bucket with its words, in the order of their first appearance."""
    def rows(chunk, n, schema, **cols):
        return pa.RecordBatch.from_arrays([pa.array(np.full(n, chunk)) if f.name == "chunk" else cols[f.name].cast(f.type) if f.name in cols
                                           else pa.nulls(n, f.type) for f in schema], schema=schema)

    def run(batches):
        import xxhash
        from pyspark import TaskContext
        task, n = TaskContext.get().partitionId() << 32, 0
        pat, ranks = splitter(pattern), ranks_of(path)
        for big in batches:
            for b in tokens.slices(big, chars=SLICE):
                chunk, n = task + n, n + 1
                words, seq, at = words_of(b.column("text"), pat)
                raw = [w.encode() for w in words.to_pylist()]
                whole = np.fromiter((ranks.ids.get(w, -1) for w in raw), np.int64, len(raw))
                rest = np.flatnonzero(whole < 0)           # tokens are known everywhere, only the other words go out
                bucket = np.fromiter((xxhash.xxh3_64_intdigest(raw[i]) % buckets for i in rest), np.int64, len(rest))
                seen = np.maximum.accumulate(np.concatenate([[-1], seq]))[:-1]
                blob = joined(pack_ints(np.where(seq > seen, 0, seq + 1)), pack_ints(whole + 1), pack_ints(bucket))   # 0: a word's first appearance
                yield rows(chunk, len(b), schema, place=pa.array(np.arange(len(b))), size=pa.array(np.diff(at)),
                           **{schema.names[i + 4]: b.column(i) for i in range(1, b.num_columns)})
                yield rows(chunk, 1, schema, blob=pa.array([blob], pa.binary()))
                order = np.argsort(bucket, kind="stable")
                had = np.unique(bucket)
                cuts = np.searchsorted(bucket[order], had, "right")
                lists = [[raw[i] for i in rest[part]] for part in np.split(order, cuts[:-1])] if len(had) else []
                packed = [joined(pack_ints(np.fromiter(map(len, x), np.int64, len(x))), _squeezed(b"".join(x))) for x in lists]
                yield rows(chunk, len(had), schema, bucket=pa.array(had), blob=pa.array(packed, pa.binary()))
                del words, seq, at, raw, whole, rest, bucket, seen, blob, order, lists, packed
                give_back()
    return run


def _replay(path: str):
    def run(t: pa.Table) -> pa.Table:
        sizes, raw = [], []
        for x in t.column("blob").to_pylist():
            size, text = parted(x)
            sizes.append(unpack_ints(size))
            raw.append(_restored(text))
        n = np.concatenate([[0], np.cumsum([len(x) for x in sizes])])
        offs = np.concatenate([[0], np.cumsum(np.concatenate(sizes))]).astype(np.int64)
        flat = pa.LargeBinaryArray.from_buffers(pa.large_binary(), int(n[-1]), [None, pa.py_buffer(offs), pa.py_buffer(b"".join(raw))])
        coded = flat.dictionary_encode()
        ids, at = encode_words(coded.dictionary, ranks_of(path))
        count, code, out = np.diff(at), coded.indices.to_numpy(zero_copy_only=False), []
        for i in range(len(sizes)):
            c = code[n[i]:n[i + 1]]
            out.append(joined(pack_ints(count[c]), pack_ints(ids[spread(at[:-1][c], count[c])])))
        del sizes, raw, flat, coded, ids, at, count, code
        give_back()
        return pa.table([t.column("chunk"), t.column("bucket"), pa.array(out, pa.binary())], names=["chunk", "bucket", "ids"])
    return run


def _whole(keep: list[str]):
    def run(docs: pa.Table, words: pa.Table) -> pa.Table:
        blob = pc.drop_null(docs.column("blob"))[0].as_py()
        docs = docs.filter(pc.is_valid(docs.column("place"))).sort_by("place")
        seq, whole, bucket = map(unpack_ints, parted(blob))
        new = seq == 0
        seq = np.where(new, np.cumsum(new) - 1, seq - 1)
        size, got = (whole > 0).astype(np.int64), np.zeros(0, np.int64)
        rest = np.flatnonzero(whole == 0)[np.argsort(bucket, kind="stable")]
        if len(rest):
            pairs = [parted(x) for x in words.sort_by("bucket").column("ids").to_pylist()]
            size[rest] = np.concatenate([unpack_ints(n) for n, _ in pairs])
            got = np.concatenate([unpack_ints(x) for _, x in pairs])
        start = np.cumsum(size) - size                     # ids of all words of the chunk in a row
        ids = np.zeros(int(size.sum()), np.int32)
        ids[start[whole > 0]] = whole[whole > 0] - 1
        ids[spread(start[rest], size[rest])] = got
        upto = np.concatenate([[0], np.cumsum(size[seq])])
        ends = np.concatenate([[0], np.cumsum(docs.column("size").to_numpy())]).astype(np.int64)
        flat = np.empty(upto[-1], np.int32)
        for i in range(0, len(seq), STEP):
            part = seq[i:i + STEP]
            flat[upto[i]:upto[i + len(part)]] = ids[spread(start[part], size[part])]
        lists = pa.ListArray.from_arrays(pa.array(upto[ends], pa.int32()), pa.array(flat))
        del seq, whole, bucket, new, size, got, rest, start, ids, upto
        give_back()
        return pa.table([*(docs.column(c) for c in keep), lists], names=[*keep, "ids"])
    return run


def encode(docs: DataFrame, path: str, pattern: str, keep: tuple = ("doc_id",), text_col: str = "text") -> DataFrame:
    """Columns ``keep`` and ``ids`` (array<int>) for every row of ``docs``, by the rank file at ``path``."""
    body = docs.select(text_or_empty(f"`{text_col}`").cast("string").alias("text"), *[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)])
    size = body.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    kinds = body.schema.fields[1:]
    names = [f.name for f in kinds]
    out = T.StructType([T.StructField("chunk", T.LongType()), T.StructField("bucket", T.LongType()), T.StructField("place", T.LongType()),
                        T.StructField("size", T.LongType()), T.StructField("blob", T.BinaryType()), *kinds])
    from pyspark.sql.pandas.types import to_arrow_schema
    cut = saved(body.mapInArrow(_cut(pattern, path, max(8, -(-size // BUCKET)), to_arrow_schema(out)), out), "replay-words")
    words = cut.where("bucket IS NOT NULL").select("chunk", "bucket", "blob")
    ids = words.groupBy("bucket").applyInArrow(_replay(path), "chunk long, bucket long, ids binary")
    texts = cut.where("bucket IS NULL").select("chunk", "place", "size", "blob", *names)
    done = texts.groupBy("chunk").cogroup(ids.groupBy("chunk")).applyInArrow(
        _whole(names), T.StructType([*kinds, T.StructField("ids", T.ArrayType(T.IntegerType()))]))
    return done.select(*[F.col(n).alias(c) for n, c in zip(names, keep)], "ids")


def _decode(path: str, at: int, keep: bool):
    def run(batches):
        p = ranks_of(path)
        for big in batches:
            n = pc.fill_null(pc.list_value_length(big.column(at)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            upto, done = np.cumsum(n), 0
            while done < len(n):                           # some rows at a time, one at least
                end = max(done + 1, int(np.searchsorted(upto, (upto[done - 1] if done else 0) + STEP, "right")))
                b = big.slice(done, end - done)
                ids = b.column(at)
                flat = pc.fill_null(ids.flatten(), -1).to_numpy(zero_copy_only=False)
                known = (flat >= 0) & (flat < p.count)
                flat = np.where(known, flat, 0)
                size = np.where(known, p.size[flat], 0)
                raw = p.flat[spread(p.start[flat], size)].tobytes()
                cuts = np.concatenate([[0], np.cumsum(size)])[np.concatenate([[0], np.cumsum(n[done:end])])]
                got = [raw[x:y] if ok else None for x, y, ok in zip(cuts[:-1], cuts[1:], ids.is_valid().to_pylist())]
                stay = [i for i in range(b.num_columns) if keep or i != at]
                yield pa.RecordBatch.from_arrays([*(b.column(i) for i in stay), pa.array(got, pa.binary())],
                                                 names=[*(b.schema.names[i] for i in stay), "decoded"])
                done = end
    return run


def decode_ids(df: DataFrame, path: str, keep: bool = True) -> DataFrame:
    """``df`` with ``decoded``: the bytes that its ``ids`` stand for (``keep=False``: without the ids)."""
    d = df.withColumn("ids", F.col("ids").cast("array<int>"))
    left = [f for f in d.schema.fields if keep or f.name != "ids"]
    return d.mapInArrow(_decode(path, d.columns.index("ids"), keep), T.StructType([*left, T.StructField("decoded", T.BinaryType())]))
