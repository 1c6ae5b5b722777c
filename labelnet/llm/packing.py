"""Packing of documents into sequences by the cutting-stock problem.

A document of n tokens gives ``n // size`` full sequences; the rest is an item of 1..size-1 tokens.
Items are counted by length in units of ``size / bins`` tokens, rounded down (at most ``bins`` counts,
whatever the corpus). The histogram goes to the driver, where column generation solves the linear
program over patterns: the dual prices of the lengths go to an unbounded knapsack solved by dynamic
programming, whose best filling enters the basis. Patterns that fill all units are used as often as
their rounded-down share. Items are ranked within their length (a two-level rank, no global sort);
rank and pattern give sequence and slot by arithmetic. Lengths are rounded down, so the items of a
sequence reach its end or pass it; what passes is cut off. What is cut off, items under one unit, items
that the rounding leaves over, and all items of patterns that don't fill their sequence (about half of all
items if a third has one length of 700) are laid end to end and cut at the sequence borders; the end of
that stream, shorter than one sequence, is cut into powers of two. So there is no padding at all.

Defined cases: a null text is empty and packs as its end id alone; repeated rows are packed each for
itself; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import tokens
from .common import bucket_count, running_rank, saved

SIZE, END, BINS = 1024, 0, 64


def crc(ids: np.ndarray) -> int:
    return zlib.crc32(np.ascontiguousarray(ids, "<u4").tobytes())


def _measure(path: str, size: int, end: int):
    """Arrow batches (doc_id, text) -> tokens, crc of each full piece, and the rest's ids and crc."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("n_full", pa.int64()), ("rest", pa.int32()),
                        ("crcs", pa.list_(pa.int64())), ("rest_crc", pa.int64()), ("rest_ids", pa.binary())])

    def run(batches):
        cache = tokens.cached(path, True)
        kind = "<u2" if len(cache.border) <= 65536 else "<u4"
        for big in batches:
            for b in tokens.slices(big):
                flat, offs = cache.encode(b.column("text"))
                out = []
                for d, lo, hi in zip(b.column("doc_id").to_pylist(), offs[:-1], offs[1:]):
                    ids = np.append(flat[lo:hi], np.uint32(end)).astype("<u4")
                    n = len(ids)
                    k, tail = n // size, ids[n - n % size:]
                    raw = memoryview(ids).cast("B")
                    out.append((d, n, k, n % size, [zlib.crc32(raw[i * size * 4:(i + 1) * size * 4]) for i in range(k)],
                                crc(tail), tail.astype(kind).tobytes()))
                cols = list(zip(*out)) or [[]] * 7
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, schema.types)], schema=schema)
    return run, "doc_id long, n_tokens long, n_full long, rest int, crcs array<long>, rest_crc long, rest_ids binary"


def best_filling(price: np.ndarray, lens: np.ndarray, size: int) -> tuple[float, np.ndarray]:
    """Unbounded knapsack: the dearest multiset of ``lens`` (ascending) with a sum of at most ``size``, as counts."""
    best, last = np.zeros(size + 1), np.full(size + 1, -1, np.int64)
    fit = np.searchsorted(lens, np.arange(size + 1), "right")
    for c in range(1, size + 1):
        best[c], k = best[c - 1], fit[c]
        if k:
            v = best[c - lens[:k]] + price[:k]
            i = int(v.argmax())
            if v[i] > best[c] + 1e-12:
                best[c], last[c] = v[i], i
    counts, c = np.zeros(len(lens), np.int64), size
    while c > 0:
        if last[c] < 0:
            c -= 1
        else:
            counts[last[c]] += 1
            c -= lens[last[c]]
    return float(best[size]), counts


def solve(lens: np.ndarray, need: np.ndarray, size: int, gap: float) -> list[tuple[np.ndarray, float]]:
    """Patterns (counts of each length) and how often the linear program uses them, by column generation
    from the patterns of one length; ends when the objective is within ``gap`` of a lower bound."""
    m = len(lens)
    cols = np.diag(size // lens)
    inv = np.diag(1.0 / (size // lens))
    x = inv @ need
    bound = float(lens @ need) / size
    while m:
        price = inv.sum(axis=0)
        value, a = best_filling(price, lens, size)
        bound = max(bound, x.sum() / max(value, 1.0))          # Farley's bound
        if value <= 1 + 1e-9 or x.sum() <= bound * (1 + gap):
            break
        d = inv @ a
        ok = d > 1e-9
        ratio = np.full(m, np.inf)
        ratio[ok] = x[ok] / d[ok]
        r = int(ratio.argmin())
        step = ratio[r]
        x -= step * d
        x[r] = step
        np.maximum(x, 0, out=x)
        row = inv[r] / d[r]
        inv -= np.outer(d, row)
        inv[r] = row
        cols[:, r] = a
    return [(cols[:, j], x[j]) for j in range(m)]


def plan(hist: dict[int, int], bins: int = BINS, gap: float = 0.001) -> tuple[dict[int, np.ndarray], dict[int, int], int]:
    """From counts by length in units: for each length the runs of ranks that patterns take (first rank, first
    sequence, items of this length in a sequence, slot of the first), the ranks taken, and the number of sequences."""
    lens = np.array(sorted(n for n in hist if n > 0), np.int64)
    need = np.array([hist[n] for n in lens], np.int64)
    used, seqs, runs = np.zeros(len(lens), np.int64), 0, {int(n): [] for n in lens}
    for counts, share in solve(lens, need.astype(float), bins, gap):
        has = counts > 0
        if int(counts @ lens) != bins:
            continue
        times = min(int(share + 1e-6), int(((need - used)[has] // counts[has]).min()))
        if times <= 0:
            continue
        slot = 0
        for i in np.flatnonzero(has):
            runs[int(lens[i])].append((int(used[i]), seqs, int(counts[i]), slot))
            slot += int(counts[i])
        used += counts * times
        seqs += times
    return {n: np.array(r, np.int64).reshape(-1, 4) for n, r in runs.items()}, dict(zip(lens.tolist(), used.tolist())), seqs


def _place(runs: dict, used: dict):
    """(uid, rest, unit, rank) -> with sequence and slot; sequence -1: no pattern takes it."""
    def run(frames):
        for f in frames:
            unit, rank = f["unit"].to_numpy(), f["rank"].to_numpy(np.int64)
            seq, slot = np.full(len(f), -1, np.int64), np.zeros(len(f), np.int64)
            for n in np.unique(unit):
                w = np.flatnonzero((unit == n) & (rank < used.get(int(n), 0)))
                if len(w):
                    r = runs[int(n)]
                    k = np.searchsorted(r[:, 0], rank[w], "right") - 1
                    j = rank[w] - r[k, 0]
                    seq[w], slot[w] = r[k, 1] + j // r[k, 2], r[k, 3] + j % r[k, 2]
            yield pd.DataFrame({"uid": f["uid"], "rest": f["rest"], "seq": seq, "slot": slot})
    return run


def borders(total: int, size: int) -> np.ndarray:
    """Borders in the tail of a stream of ``total`` tokens: parts of powers of two, the largest first."""
    tail = total % size
    parts = [1 << b for b in range(tail.bit_length() - 1, -1, -1) if tail >> b & 1]
    return total - tail + np.concatenate([[0], np.cumsum(parts)]).astype(np.int64)


def stream_cuts(total: int, size: int, ends: np.ndarray, pos: int, n: int) -> list[tuple[int, int, int, int]]:
    """``(start within, length, sequence, offset)`` of what lies at ``pos``, ``n`` tokens long, in the stream."""
    out, at, full = [], pos, total // size
    while at < pos + n:
        if at < full * size:
            seq, lo, hi = at // size, at // size * size, at // size * size + size
        else:
            k = int(np.searchsorted(ends, at, "right")) - 1
            seq, lo, hi = full + k, int(ends[k]), int(ends[k + 1])
        hi = min(hi, pos + n)
        out.append((at - pos, hi - at, seq, at - lo))
        at = hi
    return out


def _cut(total: int, size: int, seqs: int):
    ends = borders(total, size)

    def run(frames):
        for f in frames:
            rows = [(u, a + c[0], c[1], seqs + c[2], c[3]) for u, a, n, pos in zip(f["uid"], f["at"], f["length"], f["pos"])
                    for c in stream_cuts(total, size, ends, int(pos), int(n))]
            yield pd.DataFrame(rows, columns=["uid", "at", "length", "sequence_id", "offset"])
    return run


def _part_crc(frames):
    for f in frames:
        f["ids_crc32"] = [crc(np.frombuffer(b, "<u2" if len(b) == 2 * n else "<u4")[a:a + k])
                          for b, n, a, k in zip(f["rest_ids"], f["rest"], f["at"], f["length"])]
        yield f[["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]]


def ranked(items: DataFrame, key: str, uid: str, rows: int) -> DataFrame:
    """Adds ``rank`` (from 0) within ``key``. A key may hold most rows: buckets of it are numbered apart."""
    n = bucket_count(rows, 50_000)
    d = items.withColumn("_bk", F.pmod(F.xxhash64(uid), F.lit(n)).cast("int"))
    offs = d.groupBy(key, "_bk").agg(F.count(F.lit(1)).alias("_n"))
    offs = offs.select(key, "_bk", F.coalesce(F.sum("_n").over(Window.partitionBy(key).orderBy("_bk").rowsBetween(
        Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"))
    d = d.withColumn("_r", F.row_number().over(Window.partitionBy(key, "_bk").orderBy(uid)))
    return d.join(offs, [key, "_bk"]).withColumn("rank", F.col("_off") + F.col("_r") - 1).drop("_bk", "_off", "_r")


def pack(docs: DataFrame, path: str, size: int = SIZE, end: int = END, bins: int = BINS) -> DataFrame:
    """One row for each piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    run, schema = _measure(path, size, end)
    meta = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, schema)
    meta = saved(meta.withColumn("uid", F.monotonically_increasing_id()), "pack-docs")
    unit = F.floor(F.col("rest") * bins / size).cast("int")
    items = meta.where("rest > 0").select("uid", "rest", unit.alias("unit"))
    hist = {r["unit"]: r["n"] for r in items.groupBy("unit").agg(F.count(F.lit(1)).alias("n")).collect()}
    runs, used, seqs = plan(hist, bins)
    placed = saved(ranked(items, "unit", "uid", sum(hist.values())).select("uid", "rest", "unit", "rank").mapInPandas(
        _place(runs, used), "uid long, rest int, seq long, slot long"), "pack-slots")
    before = Window.partitionBy("seq").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    fits = placed.where("seq >= 0").withColumn("offset", F.coalesce(F.sum("rest").over(before), F.lit(0)))
    fits = saved(fits.withColumn("length", F.greatest(F.lit(0), F.least(F.lit(size) - F.col("offset"), F.col("rest"))).cast("long")), "pack-fits")
    late = (placed.where("seq < 0").select("uid", F.lit(0).cast("long").alias("at"), F.col("rest").cast("long").alias("length"))
            .unionByName(fits.where("length < rest").select("uid", F.col("length").alias("at"), (F.col("rest") - F.col("length")).alias("length"))))
    late = saved(running_rank(late, "uid", "length", "pos"), "pack-stream")
    total = late.agg(F.sum("length")).first()[0] or 0
    cut = late.select("uid", "at", "length", "pos").mapInPandas(
        _cut(total, size, seqs), "uid long, at long, length long, sequence_id long, offset long")
    placed = saved(cut.unionByName(fits.where("length > 0").select("uid", F.lit(0).cast("long").alias("at"), "length",
                                   F.col("seq").alias("sequence_id"), "offset")), "pack-items")
    info = meta.select("uid", "doc_id", "rest", (F.col("n_tokens") - F.col("rest")).alias("base"), F.col("n_tokens").alias("doc_tokens"), "rest_crc")
    j = placed.join(info, "uid").withColumn("start", F.col("base") + F.col("at"))
    cols = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    whole = j.where(F.col("length") == F.col("rest")).withColumnRenamed("rest_crc", "ids_crc32").select(*cols)
    parts = (j.where(F.col("length") < F.col("rest")).join(meta.select("uid", "rest_ids"), "uid")
             .select("doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "rest", "at", "rest_ids")
             .mapInPandas(_part_crc, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"))
    base = seqs + total // size + len(borders(total, size)) - 1
    full = running_rank(meta.where("n_full > 0").select("uid", "n_full"), "uid", "n_full", "first").select("uid", "first")
    full = meta.where("n_full > 0").select("uid", "doc_id", F.col("n_tokens").alias("doc_tokens"), "crcs").join(full, "uid")
    full = full.select("doc_id", "doc_tokens", "first", F.posexplode("crcs").alias("i", "ids_crc32"))
    full = full.select("doc_id", (F.col("i") * size).cast("long").alias("start"), F.lit(size).cast("long").alias("length"), "ids_crc32",
                       "doc_tokens", (F.lit(base) + F.col("first") + F.col("i")).cast("long").alias("sequence_id"),
                       F.lit(0).cast("long").alias("offset"))
    return full.unionByName(whole).unionByName(parts)
