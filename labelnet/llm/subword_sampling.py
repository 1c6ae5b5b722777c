"""SentencePiece encoding by sampled segmentations without replacement (Gumbel top-k), and decoding.

A text, with a blank in front and blanks as U+2581, has a lattice: an arc for each vocabulary piece that fits at
a place; a character that is no piece has its UTF-8 byte pieces. A piece's weight is ``(rank + 2) ** -ALPHA``, and
a segmentation's probability the product of its pieces' weights, normalised. No piece goes on past a border
between another character and a blank, so the lattice is a chain of the lattices of units (blanks and what
follows them), and equal units share theirs.

Sampling is a perturbed search from the best downwards. A node is a beginning of a segmentation, with the
largest Gumbel-perturbed log-probability of all segmentations that begin so; the root's is drawn from a Gumbel
distribution. On the way down, the child that has its parent's value is drawn by probability, and the best value
of all other children together is drawn from a Gumbel distribution cut off at the parent's value. That value
waits in the queue; its owner among the children is drawn only when it comes up. So the first k segmentations
that come up are a sample without replacement, and the best value left in the queue, t, gives each one's
inclusion score ``1 - exp(-exp(log_prob - t))`` (reported as its logarithm). All draws are hashes of the row's
key, the sample's number and the place, so a row gives the same samples on any machine.

All units of many documents go down abreast, a NumPy operation for each step.

Defined cases: a null text is empty, and its one segmentation has the one piece of the leading blank; a text
with fewer segmentations than asked for gives them all, with inclusion score 1; U+2581 in a text is a blank;
a null doc_id has a key of its own; repeated rows give equal rows; an empty table gives an empty result; a text longer
than a slice is one of its own, with lattices in proportion to its distinct units; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import tokens
from .common import give_back
from .minhash import mix

ALPHA, SAMPLES = 1.5, 2
ROWS = 256                     # rows that are decoded at a time
SLICE = 250_000                # bytes of text that are sampled at once (one text at least)
NODES = 3_000_000              # nodes of lattices that a Python worker keeps (those of one slice at least)
BASE = np.uint64(0x9E3779B97F4A7C15)
NULL_KEY = -(1 << 63)
_NEG = -np.inf


class Pieces:
    """Vocabulary of a model: prefixes by hash, weights, bytes."""

    def __init__(self, path: str, alpha: float):
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        names = [sp.id_to_piece(i) for i in range(n)]
        self.byte_id, self.raw = np.zeros(256, np.int64), [b""] * n
        weight = np.zeros(n)
        prefixes: dict[str, int] = {}
        normal = []
        for i, p in enumerate(names):
            if sp.is_byte(i):
                self.byte_id[int(p[3:5], 16)], self.raw[i] = i, bytes([int(p[3:5], 16)])
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                if "▁" in p.lstrip("▁"):
                    raise ValueError("a piece goes on past a blank: units would not be independent")
                normal.append(i)
                self.raw[i] = p.replace("▁", " ").encode()
        ranked = sorted(normal, key=lambda i: -sp.get_score(i))
        for r, i in enumerate(ranked):
            weight[i] = -alpha * np.log(r + 2.0)
        self.byte_weight = -alpha * np.log(len(ranked) + 2.0)
        self.longest = max(len(names[i]) for i in normal)
        for i in normal:
            for k in range(1, len(names[i])):
                prefixes.setdefault(names[i][:k], -1)
        for i in normal:
            prefixes[names[i]] = i
        self.weight = weight
        self.tables = []                                   # for each length: sorted hashes, piece (-1: prefix only)
        for k in range(1, self.longest + 1):
            items = [(self.hash(p), i) for p, i in prefixes.items() if len(p) == k]
            h = np.array([x[0] for x in items], np.uint64)
            if len(np.unique(h)) != len(h):
                raise ValueError("hashes of pieces collide")
            o = np.argsort(h)
            self.tables.append((h[o], np.array([x[1] for x in items], np.int64)[o]))
        self.one = np.full(0x110000, -2, np.int32)         # of each character: piece (-1: prefix only, -2: none)
        for x, i in prefixes.items():
            if len(x) == 1:
                self.one[ord(x)] = i
        self.raw_size = np.fromiter(map(len, self.raw), np.int64, n)
        self.raw_start = np.cumsum(self.raw_size) - self.raw_size
        self.raw_flat = np.frombuffer(b"".join(self.raw), np.uint8)

    @staticmethod
    def hash(piece: str) -> int:
        h = 0
        for c in piece:
            h = (h * int(BASE) + ord(c) + 1) & 0xFFFFFFFFFFFFFFFF
        return h

    def decode(self, ids: np.ndarray) -> bytes:
        """UTF-8 of the text: the pieces' bytes without a leading blank."""
        size = self.raw_size[ids]
        upto = np.cumsum(size)
        at = np.repeat(self.raw_start[ids] - (upto - size), size) + np.arange(upto[-1] if len(upto) else 0)
        return self.raw_flat[at].tobytes().removeprefix(b" ")


_MODELS: dict = {}


def pieces(path: str, alpha: float) -> Pieces:
    if (path, alpha) not in _MODELS:
        _MODELS[path, alpha] = Pieces(path, alpha)
    return _MODELS[path, alpha]


def units_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Units of all texts in a row without their first blank, and where each text's begin (one more at the end)."""
    texts = pc.replace_substring(pc.fill_null(texts.cast(pa.large_string()), ""), "▁", " ")
    odd = np.flatnonzero(pc.or_(pc.match_substring(texts, "  "), pc.starts_with(texts, " ")).to_numpy(zero_copy_only=False))
    parts = pc.split_pattern(texts, " ")
    if not len(odd):
        at = parts.offsets.to_numpy() - parts.offsets[0].as_py()
        return parts.flatten(), at
    lists = parts.to_pylist()
    for i in odd:                                          # several blanks belong to the unit after them
        lists[i] = [u[1:] for u in re.findall(r" +[^ ]*", " " + texts[int(i)].as_py())]
    at = np.concatenate([[0], np.cumsum([len(x) for x in lists])])
    return pa.array([u for x in lists for u in x], pa.large_string()), at


class Column:
    """An array that grows at its end."""

    def __init__(self, kind):
        self.room, self.n = np.zeros(1024, kind), 0

    def extend(self, x: np.ndarray) -> np.ndarray:
        """The whole array with ``x`` at its end."""
        if self.n + len(x) > len(self.room):
            self.room = np.concatenate([self.room[:self.n], np.zeros(self.n // 2 + len(x), self.room.dtype)])
        self.room[self.n:self.n + len(x)] = x
        self.n += len(x)
        return self.room[:self.n]


class Lattices:
    """Lattices of distinct units, all nodes in a row: a unit of n characters has the nodes 0..n. A node's arcs lie in a
    row, too, the shortest first. Units are kept for the slices to come; beyond ``NODES`` nodes only those that came first
    stay, as frequent units do."""

    def __init__(self, p: Pieces):
        self.p, kind = p, np.int16 if len(p.raw) < 32768 else np.int32
        # of units: first node, characters; of nodes: first arc, number of arcs, character, its bytes;
        # of arcs: characters, piece (-2: byte pieces), log of the conditional probability, sum of it and the arcs before
        self.kinds = {"first": np.int64, "size": np.int64, "at": np.int32, "arcs": np.int8, "cp": np.uint32, "width": np.int8,
                      "length": np.int8, "piece": kind, "logp": np.float32, "cdf": np.float32}
        self.place: dict[str, int] = {}
        self.columns = {c: Column(k) for c, k in self.kinds.items()}
        for c, column in self.columns.items():
            setattr(self, c, column.room[:0])

    def _keep(self, nodes: int) -> None:
        """Only the units in the first ``nodes`` nodes stay."""
        units = int(np.searchsorted(self.first + self.size + 1, nodes, "right"))
        nodes = int(self.first[units]) if units < len(self.first) else len(self.at)
        arcs = int(self.at[nodes]) if nodes < len(self.at) else len(self.piece)
        self.place = dict(islice(self.place.items(), units))
        for c, column in self.columns.items():
            column.n = units if c in ("first", "size") else nodes if c in ("at", "arcs", "cp", "width") else arcs
            setattr(self, c, column.room[:column.n])

    def places(self, units: list[str]) -> np.ndarray:
        """The place of each of the distinct ``units``, which learns those that are new."""
        at = list(map(self.place.get, units))
        new = [u for u, i in zip(units, at) if i is None]
        if new:
            if len(self.cp) + sum(map(len, new)) + 2 * len(new) > NODES:
                self._keep(NODES // 2)
                new = [u for u in units if u not in self.place]
            self.place.update(zip(new, range(len(self.size), len(self.size) + len(new))))
            self._learn(new)
            at = list(map(self.place.__getitem__, units))
        return np.array(at, np.int64)

    def _learn(self, units: list[str]) -> None:
        p = self.p
        full = "▁".join(["", *units]).replace(" ", "▁")
        size = np.fromiter(map(len, units), np.int64, len(units)) + 1
        cp = np.frombuffer(full.encode("utf-32-le", "surrogatepass"), np.uint32)
        first = np.cumsum(size + 1) - size - 1                                 # the first node of each unit
        total = int((size + 1).sum())
        char = np.arange(len(cp))
        node = char + np.repeat(np.arange(len(size)), size)                    # the node in front of a character
        left = np.repeat(np.cumsum(size), size) - char                         # characters up to the unit's end
        c, piece = cp.astype(np.uint64) + np.uint64(1), p.one[cp]
        width = np.where(piece >= 0, 1, 1 + (cp > 0x7F).astype(np.int8) + (cp > 0x7FF) + (cp > 0xFFFF)).astype(np.int8)
        # arcs by length; one character always has one, if of byte pieces
        found = [(node, np.where(piece < 0, -2, piece), np.where(piece < 0, width * p.byte_weight, p.weight[np.maximum(piece, 0)]))]
        live = np.flatnonzero((piece > -2) & (left > 1))
        h = c[live]
        with np.errstate(over="ignore"):
            for n in range(2, p.longest + 1):
                if not len(live):
                    break
                h = h * BASE + c[live + n - 1]
                keys, ids = p.tables[n - 1]
                i = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
                known = np.flatnonzero(keys[i] == h)
                live, h, piece = live[known], h[known], ids[i[known]]
                w = piece >= 0
                at, w = live[w], piece[w]
                found.append((node[at], w, p.weight[w]))
                go = left[live] > n
                live, h = live[go], h[go]
        # the longest piece in use; 8 at least, as NumPy adds up shorter rows in another order: so units that are learned
        # together don't change each other's last digits
        k = max(8, *(n for n, (at, _, _) in enumerate(found, 1) if len(at)))
        weight, arcs = np.full((total, k), -np.inf, np.float32), np.zeros(total, np.int8)
        for n, (at, _, w) in enumerate(found[:k]):
            weight[at, n] = w
            arcs[at] += 1
        # from the end: log of the summed weights of all ways to the unit's end
        dist = np.zeros(total, np.int64)
        dist[node] = left
        beta = np.zeros(total, np.float32)
        order = np.argsort(dist.astype(np.uint16) if dist.max(initial=0) < 65536 else dist, kind="stable")     # a radix sort
        cut = np.searchsorted(dist[order], np.arange(int(dist.max(initial=0)) + 2))
        cdf = np.empty((total, k), np.float32)
        steps = np.arange(1, k + 1)
        for d in range(1, len(cut) - 1):
            v = order[cut[d]:cut[d + 1]]
            m = min(k, d)
            w = weight[v, :m]
            s = w + beta.take(v[:, None] + steps[:m])
            s -= s[:, :1]                                      # one character always fits: relative to it nothing overflows
            e = np.exp(s)
            tot = e.sum(axis=1)
            low = np.log(tot)
            beta[v] = w[:, 0] + beta[v + 1] + low
            s -= low[:, None]
            weight[v, :m] = s
            e /= tot[:, None]
            cdf[v, :m] = np.cumsum(e, axis=1)
        # a node's arcs in a row
        begin = np.cumsum(arcs, dtype=np.int64) - arcs
        some = int(begin[-1] + arcs[-1])
        to, length, kind = begin.copy(), np.zeros(some, np.int8), np.zeros(some, self.kinds["piece"])
        logp, upto = np.zeros(some, np.float32), np.zeros(some, np.float32)
        for n, (at, piece, _) in enumerate(found[:k]):
            i = to[at]
            length[i], kind[i], logp[i], upto[i] = n + 1, piece, weight[at, n], cdf[at, n]
            to[at] += 1
        upto[to[node] - 1] = np.inf                            # nothing is beyond a node's last arc
        chars, bytes_ = np.zeros(total, np.uint32), np.ones(total, np.int8)
        chars[node], bytes_[node] = cp, width
        for column, x in (("first", first + len(self.cp)), ("size", size), ("at", begin + len(self.piece)), ("arcs", arcs), ("cp", chars), ("width", bytes_),
                          ("length", length), ("piece", kind), ("logp", logp), ("cdf", upto)):
            setattr(self, column, self.columns[column].extend(x))

    def pick(self, node: np.ndarray, u: np.ndarray) -> np.ndarray:
        """Arc of each node, by probability."""
        arc = self.at[node].astype(np.int64)
        on = np.flatnonzero(self.cdf[arc] < u)
        while len(on):
            arc[on] += 1
            on = on[self.cdf[arc[on]] < u[on]]
        return arc

    def rows(self, node: np.ndarray) -> np.ndarray:
        """The logarithms of the probabilities of each node's arcs, side by side (-inf: no arc)."""
        n = self.arcs[node]
        j = np.arange(int(n.max(initial=1)))
        return np.where(j < n[:, None], self.logp.take(self.at[node][:, None] + j, mode="clip"), _NEG).astype(np.float64)


_LATTICES: dict = {}


def lattices(p: Pieces) -> Lattices:
    """One for each Python worker and model: workers serve many tasks."""
    if _LATTICES.get("of") is not p:
        _LATTICES.update(of=p, all=Lattices(p))
    return _LATTICES["all"]


def hashed(key: np.ndarray, *parts, done: int = 0) -> np.ndarray:
    """Hash of the key and numbers, ``done`` of which are in the key already."""
    with np.errstate(over="ignore"):
        for i, x in enumerate(parts, done):
            key = mix(key + np.asarray(x).astype(np.uint64) * BASE + np.uint64(i + 1))
    return key


def uniform(key: np.ndarray, *parts, done: int = 0) -> np.ndarray:
    """In (0, 1), by hash of the key and numbers."""
    return ((hashed(key, *parts, done=done) >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0 ** -53


class Path:
    """One segmentation of each document, all steps in a row: node, arc, unit, log-probability before the step,
    arcs taken out (bits, by their place among the node's), and the best value of what is left at the node."""

    def __init__(self, doc, unit, node, arc, before, out, value, total):
        self.doc, self.unit, self.node, self.arc, self.before, self.out, self.value, self.total = doc, unit, node, arc, before, out, value, total


def _walk(lat: Lattices, key, sample: int, unit, start, of):
    """From node ``start`` of each unit to its end: unit (index into the input), node, arc, hash of the place, in order."""
    n = len(unit)
    first = lat.first[of]
    here, end, key = start.copy(), first + lat.size[of], hashed(key, unit)
    got, counts = [], np.zeros(n, np.int64)
    live = np.flatnonzero(here < end)
    while len(live):
        v = here[live]
        spot = hashed(key[live], v - first[live], done=1)
        a = lat.pick(v, uniform(spot, sample * 4 + 1, done=2))
        got.append((live, v, a, spot))
        counts[live] += 1
        v = v + lat.length[a]
        here[live] = v
        live = live[v < end[live]]
    offs = np.cumsum(counts) - counts
    total = int(counts.sum())
    who, node, arc, spots = np.repeat(np.arange(n), counts), np.zeros(total, np.int64), np.zeros(total, np.int64), np.zeros(total, np.uint64)
    for step, (w, v, a, spot) in enumerate(got):
        to = offs[w] + step
        node[to], arc[to], spots[to] = v, a, spot
    return who, node, arc, spots


def _truncated(phi, g, u):
    """Maximum of a subtree of log-mass ``phi``, given that it is below ``g``."""
    with np.errstate(over="ignore", divide="ignore", invalid="ignore"):
        v = phi - np.log(np.exp(np.minimum(phi - g, 700)) - np.log(u))
    return np.where(np.isneginf(phi), _NEG, v)


def _lay(lat, spots, sample, doc, unit, node, arc, before0, out, g, n_docs):
    """A Path from steps in order; ``before0``: log-probability of each document's part before its first step here;
    ``out``: arcs that are taken out at a step besides the one taken."""
    lp = lat.logp[arc].astype(np.float64)
    upto = np.concatenate([[0.0], np.cumsum(lp)])
    cut = np.searchsorted(doc, np.arange(n_docs + 1))
    begin, ends = cut[:-1], cut[1:]
    before = upto[:-1] + (before0 - upto[begin])[doc]
    place = arc - lat.at[node]
    value = np.full(len(node), _NEG)
    some = np.flatnonzero(lat.arcs[node] > 1)              # a node's only arc leaves nothing behind
    l, v, taken = lp[some], node[some], out[some]
    rest = -np.expm1(np.minimum(l, 0.0))
    near = np.flatnonzero((l > -0.005) | (taken != 0))     # 1 - p would lose digits here, or more is taken out (one step of a document)
    rest[near] = 0
    arcs, own, at, gone, j = lat.arcs[v[near]], place[some[near]], lat.at[v[near]], taken[near], 0
    while len(near):                                       # the other arcs' shares, one arc of each node at a time
        share = np.exp(lat.logp[at + j].astype(np.float64))
        share[(own == j) | (gone >> j & 1 != 0)] = 0
        rest[near] += share
        j += 1
        go = np.flatnonzero(arcs > j)
        near, arcs, own, at, gone = near[go], arcs[go], own[go], at[go], gone[go]
    with np.errstate(divide="ignore"):
        phi = before[some] + np.log(rest)
    value[some] = _truncated(phi, g[doc[some]], uniform(spots[some], sample * 4 + 2, done=2))
    total = np.zeros(n_docs)
    has = ends > begin
    total[has] = (before + lp)[ends[has] - 1]
    return Path(doc, unit, node, arc, before, out | (1 << place), value, np.where(has, total, before0))


def sample(units: np.ndarray, at: np.ndarray, lat: Lattices, key: np.ndarray, k: int):
    """``units``: lattice of each unit of all documents; ``at``: where each document's begin. Yields for each sample
    (documents that have it, Path, perturbed scores), then the best value left for each document."""
    n = len(at) - 1
    doc = np.repeat(np.arange(n), np.diff(at))
    place = np.arange(len(units)) - at[:-1][doc]
    g = -np.log(-np.log(uniform(key, 0, 0, 0)))
    who, node, arc, spots = _walk(lat, key[doc], 0, place, lat.first[units], units)
    path = _lay(lat, spots, 0, doc[who], place[who], node, arc, np.zeros(n), np.zeros(len(who), np.int64), g, n)
    paths, alive = [path], np.ones(n, bool)
    yield alive, path, g

    def best():
        """The best waiting value of each document, and its path and step."""
        value, which, step = np.full(n, _NEG), np.zeros(n, np.int64), np.zeros(n, np.int64)
        for j, p in enumerate(paths):
            begin = np.searchsorted(p.doc, np.arange(n + 1))
            has = np.flatnonzero(begin[1:] > begin[:-1])
            if not len(has):
                continue
            top = np.full(n, _NEG)
            top[has] = np.maximum.reduceat(p.value, begin[has])
            at_top = np.flatnonzero((p.value == top[p.doc]) & (p.value > np.maximum(value[p.doc], _NEG)))[::-1]
            d = p.doc[at_top]                              # backwards, so that the first of equal values stays
            value[d], which[d], step[d] = top[d], j, at_top
        return value, which, step

    for s in range(1, k):
        g, which, step = best()
        alive = g > _NEG
        docs = np.flatnonzero(alive)
        node0, arc0, unit0, out0, before0 = (np.zeros(n, np.int64) for _ in range(5))
        before0 = np.zeros(n)
        for j, p in enumerate(paths):
            d = docs[which[docs] == j]
            i = step[d]
            node0[d], unit0[d], out0[d], before0[d] = p.node[i], p.unit[i], p.out[i], p.before[i]
            p.value[i] = _NEG
        # the owner of the value among the arcs left
        prob = np.exp(lat.rows(node0[docs]))
        prob *= (out0[docs][:, None] >> np.arange(prob.shape[1]) & 1) == 0
        c = np.cumsum(prob, axis=1)
        spot0 = hashed(key[docs], unit0[docs], node0[docs] - lat.first[units[at[:-1][docs] + unit0[docs]]])
        u = uniform(spot0, s * 4 + 3, done=2) * c[:, -1]
        a = np.minimum((c <= u[:, None]).sum(axis=1), prob.shape[1] - 1)
        bad = prob[np.arange(len(docs)), a] <= 0
        a[bad] = prob[bad].argmax(axis=1)
        arc0[docs] = lat.at[node0[docs]] + a
        # then on to the unit's end and through the units after it
        rest = np.flatnonzero(alive[doc] & (place >= unit0[doc]))
        begin = lat.first[units[rest]].copy()
        head = place[rest] == unit0[doc[rest]]
        begin[head] = node0[doc[rest][head]] + lat.length[arc0[doc[rest][head]]]
        who, node, arc, spots = _walk(lat, key[doc[rest]], s, place[rest], begin, units[rest])
        d2, u2 = doc[rest][who], place[rest][who]
        lead = np.searchsorted(d2, docs)                   # the popped step comes first in its document
        d2, node, arc = np.insert(d2, lead, docs), np.insert(node, lead, node0[docs]), np.insert(arc, lead, arc0[docs])
        u2, spots = np.insert(u2, lead, unit0[docs]), np.insert(spots, lead, spot0)
        out = np.zeros(len(d2), np.int64)
        out[lead + np.arange(len(docs))] = out0[docs]
        tail = _lay(lat, spots, s, d2, u2, node, arc, before0, out, g, n)
        # the steps before the popped one are its parent's; what waits there stays with the parent
        keep = []
        for j, p in enumerate(paths):
            mine = alive[p.doc] & (which[p.doc] == j)
            i = np.flatnonzero(mine)
            i = i[i < step[p.doc[i]]]
            keep.append((p.doc[i], p.unit[i], p.node[i], p.arc[i], p.before[i], p.out[i], np.full(len(i), _NEG)))
        cols = [np.concatenate(x) for x in zip(*keep, (tail.doc, tail.unit, tail.node, tail.arc, tail.before, tail.out, tail.value))]
        o = np.argsort(cols[0], kind="stable")
        path = Path(*[c[o] for c in cols], tail.total)
        paths.append(path)
        yield alive, path, g
    yield best()[0], None, None


def _ids(lat: Lattices, path: Path, p: Pieces) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all documents in a row, and the document of each."""
    piece = lat.piece[path.arc].astype(np.int64)
    byte = np.flatnonzero(piece == -2)
    if not len(byte):
        return piece, path.doc
    n = np.ones(len(piece), np.int64)
    n[byte] = lat.width[path.node[byte]]
    ids = np.repeat(piece, n)
    begin = (np.cumsum(n) - n)[byte]
    c, w = lat.cp[path.node[byte]].astype(np.int64), n[byte]
    for j in range(int(w.max())):                          # UTF-8
        i = np.flatnonzero(w > j)
        b = c[i] >> 6 * (w[i] - 1 - j)
        ids[begin[i] + j] = p.byte_id[b & 0x3F | 0x80 if j else b | np.array([0, 0, 0xC0, 0xE0, 0xF0])[w[i]]]
    return ids, np.repeat(path.doc, n)


SCHEMA = "doc_id long, sample int, n_pieces long, ids_crc32 long, log_prob double, score double, log_inclusion double"


def sampler(path: str, k: int, alpha: float, ids_out: bool = False):
    names = [x.split()[0] for x in SCHEMA.split(", ")] + ["ids"] * ids_out
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64()] + [pa.list_(pa.int32())] * ids_out

    def run(batches):
        p = pieces(path, alpha)
        lat = lattices(p)
        for big in batches:
            for b in tokens.slices(big, chars=SLICE):
                flat, at = units_of(b.column("text"))
                coded = flat.dictionary_encode()
                units = lat.places(coded.dictionary.to_numpy(zero_copy_only=False).tolist())[coded.indices.to_numpy(zero_copy_only=False)]
                own = b.column("doc_id")
                key = mix(np.array([NULL_KEY if d is None else d for d in own.to_pylist()], np.int64).view(np.uint64) + BASE)
                parts = []                                     # of each sample: documents, lengths, ids, checksums, log-probabilities, scores
                for alive, got, g in sample(units, at, lat, key, k):
                    if got is None:
                        left = alive
                        break
                    ids, doc = _ids(lat, got, p)
                    cut = np.searchsorted(doc, np.arange(len(b) + 1))
                    d = np.flatnonzero(alive)
                    n = (cut[1:] - cut[:-1])[d]
                    ids = ids[np.repeat(alive, cut[1:] - cut[:-1])].astype(np.int32)
                    raw, ends = memoryview(np.ascontiguousarray(ids, "<i4")).cast("B"), np.cumsum(n)
                    crc = [zlib.crc32(raw[4 * (y - x):4 * y]) for x, y in zip(n.tolist(), ends.tolist())]
                    parts.append((d, n, ids, np.array(crc, np.int64), got.total[d], g[d]))
                d, n, ids, crc, total, score = (np.concatenate(x) for x in zip(*parts))
                x = total - left[d]
                with np.errstate(divide="ignore"):
                    inclusion = np.where(x < -30, x, np.log(-np.expm1(-np.exp(np.minimum(x, 700.0)))))
                cols = [own.take(pa.array(d)), np.repeat(np.arange(len(parts)), [len(q[0]) for q in parts]), n, crc, total, score,
                        np.where(np.isinf(x), 0.0, inclusion)]
                cols += [pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]), pa.int32()), pa.array(ids, pa.int32()))] * ids_out
                out = pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, t) for c, t in zip(cols, kinds)], names=names)
                flat = coded = units = got = ids = doc = parts = raw = cols = None
                yield out
            give_back()
    return run


def sample_segmentations(docs: DataFrame, path: str, k: int = SAMPLES, alpha: float = ALPHA, ids: bool = False) -> DataFrame:
    """One row for each sample of each row of ``docs``; ``ids``: with the pieces' ids."""
    d = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    out = d.mapInArrow(sampler(path, k, alpha, True), SCHEMA + ", ids array<int>")
    own = [c for c in out.columns if c != "ids"] + ["ids"] * ids
    text = decode_ids(out.withColumn("own", F.struct(*own)).select("ids", "own"), path)
    own.insert(len(SCHEMA.split(", ")), "decoded_sha256")
    return text.withColumn("decoded_sha256", F.sha2("text", 256)).select(*[c if c == "decoded_sha256" else f"own.{c}" for c in own])


def _decoder(path: str, at: int):
    def run(batches):
        p = pieces(path, ALPHA)
        for big in batches:
            for first in range(0, len(big), ROWS):
                b = big.slice(first, ROWS)
                ids = b.column(at)
                flat = ids.flatten().to_numpy(zero_copy_only=False)
                size = pc.fill_null(pc.list_value_length(ids), 0).to_numpy(zero_copy_only=False)
                ends = np.cumsum(size)
                texts = [p.decode(flat[e - n:e]).decode("utf-8", "replace") if ok else None
                         for n, e, ok in zip(size, ends, ids.is_valid().to_pylist())]
                yield pa.RecordBatch.from_arrays([*(c for i, c in enumerate(b.columns) if i != at), pa.array(texts, pa.string())],
                                                 names=[c for i, c in enumerate(b.schema.names) if i != at] + ["text"])
    return run


def decode_ids(df: DataFrame, path: str) -> DataFrame:
    """Rows of ``ids`` -> the same rows with ``text`` in their place, as last column. Null ids give a null text, none an
    empty one; control and unknown ids are nothing; byte pieces that aren't UTF-8 become U+FFFD."""
    d = df.withColumn("ids", F.col("ids").cast("array<int>"))
    left = [f for f in d.schema.fields if f.name != "ids"]
    return d.mapInArrow(_decoder(path, d.columns.index("ids")), T.StructType([*left, T.StructField("text", T.StringType())]))
