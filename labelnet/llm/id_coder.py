"""Token-id files by an adaptive context-mixing range coder, in independently reset, checksummed blocks.

A block holds up to ``BLOCK`` ids of one segment. For every id three predictions are mixed:
order 2 (the id that last followed the two ids before), order 1 (the id that last followed the one
before) and order 0 (the segment's own counts, which the segment carries). How far orders 2 and 1 are
trusted is learned within the block: counters of their hits, by how often in a row each has been right
and whether they agree. The mixture gives each id an integer share of ``2**24``, and a range coder with
56 bits (of which the range keeps 40) narrows its range by that share. Tables and coder start anew in every block, and each
block has the CRC-32 of its ids, so any block can be read alone and a damaged one is found.

Blocks are independent, so all blocks of a segment are coded abreast: each step is a NumPy operation
over one id of every block.

A file is a Parquet folder with one row for each segment (whole documents in ascending doc_id order):
shard, seq, the documents' ids and lengths, the order-0 counts, and the blocks' lengths, checksums and
payload. Only Spark reads or writes it, so it may lie in any store.

Defined cases: a null text is empty and is its end id alone; rows with equal doc_id are ordered by
their text; an empty table gives an empty file and result; very long texts make a long segment; other columns are
ignored, whatever their names.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from labelnet.session import scratch_path

from . import tokens

BLOCK, SLOTS = 2048, 4096                # ids in a block; cells of each context table
TOTAL0, SHARES = 1 << 18, 64              # order-0 counts sum up to TOTAL0; a share is 1/64 of the whole
SEGMENT_CHARS = 12_000_000                # text in a segment, one document at least


def order0(ids: np.ndarray, n_ids: int) -> np.ndarray:
    """Counts scaled to sum up to TOTAL0, at least 1 for every id of the vocabulary."""
    c = np.bincount(ids, minlength=n_ids).astype(np.float64)
    room = TOTAL0 - n_ids
    f = 1 + np.floor(c * (room / max(c.sum(), 1))).astype(np.int64)
    f[int(f.argmax())] += TOTAL0 - int(f.sum())
    return f


class _Model:
    """Predictions of all blocks abreast. A cell holds ``id * 4 + confidence``, or -1."""

    def __init__(self, lanes: int):
        self.t1, self.t2 = np.full(lanes * SLOTS, -1, np.int32), np.full(lanes * SLOTS, -1, np.int32)
        self.base = np.arange(lanes, dtype=np.int64) * SLOTS
        self.seen = np.zeros(lanes * 32, np.int64)            # 16 bits each: tries, hits of order 2, hits of order 1
        self.lane = np.arange(lanes, dtype=np.int64) * 32
        self.a, self.h = np.zeros(lanes, np.int64), np.zeros(lanes, np.int64)     # the last id, and the hash of the one before

    def predict(self, n: int):
        """For the first n lanes: the two predicted ids (-1: none) and their shares of 64."""
        x = self.a[:n] * 40503
        self.i1 = self.base[:n] + ((x >> 4) & (SLOTS - 1))
        self.i2 = self.base[:n] + ((x + self.h[:n] >> 6) & (SLOTS - 1))
        c1, c2 = self.t1.take(self.i1, mode="clip"), self.t2.take(self.i2, mode="clip")
        p1, p2 = c1 >> 2, c2 >> 2
        self.c1, self.c2, self.p1, self.p2 = c1, c2, p1, p2
        self.same = p1 == p2
        self.q = self.lane[:n] + ((c2 & 3) << 3 | (c1 & 3) << 1 | self.same)
        self.s = s = self.seen.take(self.q, mode="clip")
        # exact small integers: single precision divides alike on every machine
        tries = ((s & 0xFFFF) + 2).astype(np.float32)
        w2 = (((s >> 16 & 0xFFFF) * 58 + 20).astype(np.float32) / tries).astype(np.int64)
        w1 = (((s >> 32) * 58 + 10).astype(np.float32) / tries).astype(np.int64)
        w2 *= c2 >= 0
        w1 *= (c1 >= 0) & ~self.same
        np.minimum(w2, 62, out=w2)
        np.minimum(w1, 62 - w2, out=w1)
        return p1, p2, w1, w2

    def update(self, ids: np.ndarray) -> None:
        n = len(ids)
        hit1, hit2 = self.p1 == ids, self.p2 == ids
        self.seen[self.q] = self.s + 1 + (hit2.astype(np.int64) << 16) + ((hit1 & ~self.same).astype(np.int64) << 32)
        new = (ids << 2).astype(np.int32)
        top = new | 3
        self.t1[self.i1] = np.where(hit1, np.minimum(self.c1 + 1, top), new)
        self.t2[self.i2] = np.where(hit2, np.minimum(self.c2 + 1, top), new)
        self.h[:n] = self.a[:n] * 2654435
        self.a[:n] = ids


def _lanes(n: int) -> np.ndarray:
    """Lengths of the blocks of n ids; only the last is shorter."""
    k = -(-n // BLOCK)
    out = np.full(k, BLOCK, np.int64)
    if n % BLOCK:
        out[-1] = n % BLOCK
    return out


def encode(ids: np.ndarray, f0: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
    """(CRC-32 of each block, payload of each block)."""
    size = _lanes(len(ids))
    k = len(size)
    if not k:
        return np.zeros(0, np.uint32), []
    cum = np.concatenate([[0], np.cumsum(f0)])
    pad = np.zeros(k * BLOCK, np.int32)
    pad[: len(ids)] = ids
    grid = np.ascontiguousarray(pad.reshape(k, BLOCK).T)
    model, mask = _Model(k), (1 << 56) - 1
    low, rng = np.zeros(k, np.int64), np.full(k, 1 << 56, np.int64)
    out, n_out = np.zeros((k, BLOCK * 2 + 8), "<u2"), np.zeros(k, np.int64)
    for t in range(int(size[0])):
        n = k if t < size[-1] else k - 1
        x = grid[t, :n].astype(np.int64)
        p1, p2, w1, w2 = model.predict(n)
        w0 = SHARES - w1 - w2
        start = cum.take(x, mode="clip") * w0 + (w1 * (p1 < x) + w2 * (p2 < x) << 18)
        freq = f0.take(x, mode="clip") * w0 + (w1 * (p1 == x) + w2 * (p2 == x) << 18)
        lo, rg = low[:n], rng[:n]
        r = rg >> 24
        lo += r * start
        np.multiply(r, freq, out=rg)
        need = np.flatnonzero(rg < (1 << 40))
        while len(need):
            lw, rw = lo[need], rg[need]
            top = lw >> 40
            # a range across a border of the top 16 bits is cut off there, so that no carry can follow
            rw = np.minimum(rw, (top + 1 << 40) - lw)
            out[need, n_out[need]] = top
            n_out[need] += 1
            rw <<= 16
            lo[need], rg[need] = (lw << 16) & mask, rw
            need = need[rw < (1 << 40)]
        model.update(x)
    crcs, parts = np.zeros(k, np.uint32), []
    raw = ids.astype("<u4")
    # two words more, from the middle of what is left of the range: zeros after them decode alike
    end = low + (rng >> 1)
    for j in range(k):
        crcs[j] = zlib.crc32(raw[j * BLOCK:j * BLOCK + size[j]].tobytes())
        out[j, n_out[j]:n_out[j] + 2] = (int(end[j]) >> 40) & 0xFFFF, (int(end[j]) >> 24) & 0xFFFF
        parts.append(out[j, : n_out[j] + 2].tobytes())
    return crcs, parts


def decode(n_ids: int, f0: np.ndarray, crcs: np.ndarray, parts: list[bytes]) -> np.ndarray:
    """The ids; a block whose checksum differs raises."""
    size = _lanes(n_ids)
    k = len(size)
    if not k:
        return np.zeros(0, np.uint32)
    cum = np.concatenate([[0], np.cumsum(f0)])
    owner = np.repeat(np.arange(len(f0), dtype=np.int32), f0)        # the id that owns each of the order-0 counts
    longest = max(map(len, parts)) // 2 + 8
    words = np.zeros((k, longest), np.int64)
    for j, b in enumerate(parts):
        w = np.frombuffer(b, "<u2")
        words[j, : len(w)] = w
    flat, row = words.ravel(), np.arange(k, dtype=np.int64) * longest
    model, mask = _Model(k), (1 << 56) - 1
    low, rng = np.zeros(k, np.int64), np.full(k, 1 << 56, np.int64)
    # the 56 bits of the code end within the fourth word; ``at``: words taken since
    code = (words[:, 0] << 40) | (words[:, 1] << 24) | (words[:, 2] << 8) | (words[:, 3] >> 8)
    at = np.zeros(k, np.int64)
    out = np.zeros((BLOCK, k), np.int32)
    for t in range(int(size[0])):
        n = k if t < size[-1] else k - 1
        p1, p2, w1, w2 = model.predict(n)
        w0 = SHARES - w1 - w2
        lo, rg, cd = low[:n], rng[:n], code[:n]
        r = rg >> 24
        v = (cd - lo) // r
        # shares below each of the two predicted ids; the smaller id comes first
        first = p1 < p2
        pa_, wa = np.where(first, p1, p2), np.where(first, w1, w2) << 18
        pb_, wb = np.where(first, p2, p1), np.where(first, w2, w1) << 18
        ea = cum.take(pa_ + 1, mode="clip") * w0 + wa             # where the first prediction's share ends
        eb = cum.take(pb_ + 1, mode="clip") * w0 + wa + wb
        in_a = (v < ea) & (wa > 0) & (v >= ea - wa - f0.take(pa_, mode="clip") * w0)
        in_b = (v < eb) & (wb > 0) & (v >= eb - wb - f0.take(pb_, mode="clip") * w0)
        less = wa * (v >= ea) + wb * (v >= eb)
        # below 2**24 over at most 64: double precision divides exactly enough for the floor
        x = owner.take(((v - less) / w0).astype(np.int64), mode="clip").astype(np.int64)
        x = np.where(in_b, pb_, np.where(in_a, pa_, x))
        start = cum.take(x, mode="clip") * w0 + (w1 * (p1 < x) + w2 * (p2 < x) << 18)
        freq = f0.take(x, mode="clip") * w0 + (w1 * (p1 == x) + w2 * (p2 == x) << 18)
        lo += r * start
        np.multiply(r, freq, out=rg)
        need = np.flatnonzero(rg < (1 << 40))
        while len(need):
            lw, rw = lo[need], rg[need]
            rw = np.minimum(rw, ((lw >> 40) + 1 << 40) - lw)
            at[need] += 1
            i = row[need] + at[need] + 2
            cd[need] = ((cd[need] << 16) & mask) | ((flat[i] & 0xFF) << 8) | (flat[i + 1] >> 8)
            rw <<= 16
            lo[need], rg[need] = (lw << 16) & mask, rw
            need = need[rw < (1 << 40)]
        model.update(x)
        out[t, :n] = x
    ids = np.ascontiguousarray(out.T).ravel()[: (k - 1) * BLOCK + int(size[-1])].astype("<u4")
    for j in range(k):
        if zlib.crc32(ids[j * BLOCK:j * BLOCK + int(size[j])].tobytes()) != int(crcs[j]):
            raise ValueError(f"block {j}: checksum differs")
    return ids


SCHEMA = ("seq long, n_ids long, doc_ids binary, lengths binary, order0 binary, block_sizes binary, block_crcs binary, payload binary")


def _pack_counts(f0: np.ndarray) -> bytes:
    import zstandard
    return zstandard.compress(f0.astype("<u4").tobytes(), 1)


def _unpack_counts(b: bytes) -> np.ndarray:
    import zstandard
    return np.frombuffer(zstandard.decompress(b), "<u4").astype(np.int64)


def segment(ids: np.ndarray, doc_ids: np.ndarray, lengths: np.ndarray, n_vocab: int) -> dict:
    f0 = order0(ids, n_vocab)
    crcs, parts = encode(ids, f0)
    return {"n_ids": len(ids), "doc_ids": doc_ids.astype("<i8").tobytes(), "lengths": lengths.astype("<i8").tobytes(),
            "order0": _pack_counts(f0), "block_sizes": np.array([len(p) for p in parts], "<u4").tobytes(),
            "block_crcs": crcs.astype("<u4").tobytes(), "payload": b"".join(parts)}


def read_segment(s: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids, doc_ids, lengths) of one row of the file."""
    cuts = np.concatenate([[0], np.cumsum(np.frombuffer(s["block_sizes"], "<u4").astype(np.int64))])
    view = memoryview(s["payload"])
    parts = [bytes(view[a:b]) for a, b in zip(cuts[:-1], cuts[1:])]
    ids = decode(s["n_ids"], _unpack_counts(s["order0"]), np.frombuffer(s["block_crcs"], "<u4"), parts)
    return ids, np.frombuffer(s["doc_ids"], "<i8"), np.frombuffer(s["lengths"], "<i8")


NULL_ID = -(1 << 63)      # stands for a null doc_id in the file


def _writer(path: str, end: int):
    names = [x.split()[0] for x in SCHEMA.split(", ")]
    kinds = [pa.int64(), pa.int64()] + [pa.binary()] * 6

    def run(batches):
        cache, seq = tokens.cached(path, False), 0
        for big in batches:
            for b in tokens.slices(big, chars=SEGMENT_CHARS):
                flat, offs = cache.encode(b.column("text"))
                n = np.diff(offs) + 1
                ids = np.insert(flat, offs[1:], end).astype(np.uint32)
                docs = np.array([NULL_ID if d is None else d for d in b.column("doc_id").to_pylist()], np.int64)
                s = {"seq": seq} | segment(ids, docs, n, len(cache.border))
                seq += 1
                yield pa.RecordBatch.from_arrays([pa.array([s[c]], k) for c, k in zip(names, kinds)], names=names)
    return run


def write(docs: DataFrame, tokenizer: str, out: str, end: int = 2, parts: int | None = None) -> None:
    """Documents in ascending doc_id order to a token file: shard after shard, segments by ``seq`` in a shard."""
    parts = parts or max(2 * docs.sparkSession.sparkContext.defaultParallelism, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    d = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    d = d.repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", "text")
    coded = d.mapInArrow(_writer(tokenizer, end), SCHEMA).withColumn("shard", F.spark_partition_id())
    coded.write.option("compression", "none").parquet(out)


def _reader(batches):
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64()]
    for b in batches:
        for s in b.to_pylist():
            ids, docs, n = read_segment(s)
            upto = np.concatenate([[0], np.cumsum(n)])
            raw = memoryview(np.ascontiguousarray(ids, "<u4")).cast("B")
            crc = [zlib.crc32(raw[4 * x:4 * y]) for x, y in zip(upto[:-1], upto[1:])]
            yield pa.RecordBatch.from_arrays(
                [pa.array([None if x == NULL_ID else x for x in docs.tolist()], kinds[0]),
                 pa.array(s["first"] + upto[:-1], kinds[1]), pa.array(n, kinds[2]), pa.array(crc, kinds[3])],
                names=["doc_id", "start", "n_tokens", "ids_crc32"])


def read(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` from the file alone."""
    f = spark.read.parquet(path)
    shards = f.groupBy("shard").agg(F.sum("n_ids").alias("t"))     # one row for each shard
    shards = shards.select("shard", F.coalesce(F.sum("t").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    inside = Window.partitionBy("shard").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    firsts = f.select("shard", "seq", "n_ids").withColumn("in", F.coalesce(F.sum("n_ids").over(inside), F.lit(0)))
    firsts = firsts.join(shards, "shard").select("shard", "seq", (F.col("base") + F.col("in")).alias("first"))
    f = f.join(firsts, ["shard", "seq"]).drop("shard", "seq")
    return f.mapInArrow(_reader, "doc_id long, start long, n_tokens long, ids_crc32 long")


def round_trip(docs: DataFrame, tokenizer: str, end: int = 2) -> DataFrame:
    out = scratch_path(docs.sparkSession, "token-ids")
    write(docs, tokenizer, out, end)
    return read(docs.sparkSession, out)
