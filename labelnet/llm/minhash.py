"""Near-duplicate documents by DartMinHash signatures and a banded join.

A document is a weighted set: its shingles of five words (lower-cased, split at white space; all words, if
fewer), weighted by how often they occur. Similarity is the weighted Jaccard index; the bound is 0.8.

Signature: each unit of a shingle's weight is a region, into which hashed darts are thrown in the order of a
Poisson process: the n-th dart of a region has a rank that depends on the region and n alone. Darts up to a
rank T are thrown, T being so that about ``K * (ln K + 3)`` hit a document of its weight, whatever its length;
each dart falls on one of ``K`` coordinates by hash, and the earliest dart on each coordinate is kept. If one
stays empty, T is doubled for that document. Two documents agree on a coordinate with a probability equal to
their weighted Jaccard index.

Join: documents with equal words are one representative first. Representatives that agree on all ``ROWS``
coordinates of one of ``BANDS`` bands are candidates (0.8: found with probability 0.99995). Candidates are never
listed as all pairs of a group: in the rounds of ``LEADERS`` every member of a band's bucket is compared with one or two
leaders of it, as long as the two aren't known to be in one class. The first round's leader is the member whose own
buckets are the largest, as the original of many copies agrees with more of them than they do with each other, and as it
leads most of its buckets, a copy meets it once; the next round's are picked by hash. What then still lies in one bucket but not in one known class is compared pair by pair in buckets of up to
``SMALL`` members. Members of larger ones meet by their rarest regions instead: two sets of similarity 0.8 share one of
the first regions in any order (of the smaller set's ninth and the larger's fifth), and in rarest-first order texts of one
template that differ in more than that have no such region in common. Regions that only members of one class have, and
pairs of the class that holds most of a region's members, are left out, so a large class isn't paired with itself.
Pairs are screened by their signatures (agreement of half the coordinates; a pair at 0.8 fails that with less than 1e-9)
and then verified on the whole texts. Classes are the connected components of the links.

Defined cases: a null text is empty; all texts without a word are one class; rows that share a doc_id
are told apart by their text, and equal rows are in one class, of which one row stays; a null doc_id counts as
smallest; an empty table gives an empty result; a text longer than a slice is a slice of its own and is read whole;
other columns are ignored, or kept by ``deduped``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from labelnet.operators.graph import connected_components

from . import tokens
from .common import saved

SHINGLE, BOUND = 5, 0.8
K, BANDS, ROWS = 128, 25, 5
LEADERS = (("pop",), (2, 3))      # leaders of each round: by popularity, or the seed of a hash
SMALL = 16                    # members of a bucket that are compared pair by pair after the leaders
COUNTERS = 1 << 20            # counters that order regions by how often they occur (a hash may share one: only speed)
SCREEN = 0.5
FIRST = -(1 << 63)            # stands for a null doc_id
_MUL = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def cells(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the unit regions of all texts in a row, sorted within each text, and where each text's begin."""
    import xxhash
    parts = pc.ascii_split_whitespace(pc.utf8_trim_whitespace(pc.utf8_lower(pc.fill_null(texts.cast(pa.large_string()), ""))))
    ends = parts.offsets.to_numpy() - parts.offsets[0].as_py()
    coded = parts.flatten().dictionary_encode()
    own = np.fromiter((xxhash.xxh64_intdigest(w) for w in coded.dictionary.to_pylist()), np.uint64, len(coded.dictionary))
    word = own[coded.indices.to_numpy(zero_copy_only=False)] if len(own) else np.zeros(0, np.uint64)
    empty = (np.diff(ends) == 1) & (word[ends[:-1]] == np.uint64(xxhash.xxh64_intdigest(""))) if len(word) else np.zeros(len(ends) - 1, bool)
    n = np.diff(ends)
    m = np.where(empty | (n == 0), 0, np.maximum(n - SHINGLE + 1, 1))       # shingles of each text
    begin = np.concatenate([[0], np.cumsum(m)])
    doc = np.repeat(np.arange(len(n)), m)
    at = np.arange(begin[-1]) - begin[:-1][doc] + ends[:-1][doc]
    last = ends[1:][doc]
    h = np.zeros(len(at), np.uint64)
    with np.errstate(over="ignore"):
        padded = np.concatenate([word, np.zeros(SHINGLE, np.uint64)])
        for j in range(SHINGLE):
            h += np.where(at + j < last, mix(padded[at + j] + np.uint64(j + 1)), np.uint64(0)) * _MUL[j]
        h = mix(h)
        order = np.lexsort((h, doc))
        h, doc = h[order], doc[order]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
        run = np.arange(len(h)) - np.maximum.accumulate(np.where(new, np.arange(len(h)), 0))
        out = mix(h + run.astype(np.uint64) * _MUL[0] + np.uint64(1))
    return out, begin


def signatures(region: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Documents x K: the earliest dart on each coordinate (its rank's bits above its id); documents without a region: all ones."""
    n = np.diff(begin)
    sig = np.full((len(n), K), np.uint64(0xFFFFFFFFFFFFFFFF))
    flat = sig.reshape(-1)
    todo = np.flatnonzero(n)
    reach = K * (np.log(K) + 3.0)
    while len(todo):
        size = n[todo]
        doc = np.repeat(todo, size)
        cell = region[np.repeat(begin[:-1][todo], size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)]
        stop = (reach / n)[doc] if len(doc) else np.zeros(0)
        rank, j = np.zeros(len(cell)), 0
        with np.errstate(over="ignore"):
            while len(cell):
                j += 1
                d = mix(cell + np.uint64(j) * _MUL[1])
                rank = rank - np.log(((d >> np.uint64(11)).astype(np.float64) + 1.0) * (2.0 ** -53))
                on = rank < stop
                if not on.all():
                    cell, rank, stop, doc, d = cell[on], rank[on], stop[on], doc[on], d[on]
                e = mix(d + _MUL[2])
                key = doc * K + (e >> np.uint64(32)).astype(np.int64) % K
                dart = (rank.astype(np.float32).view(np.uint32).astype(np.uint64) << np.uint64(32)) | (e & np.uint64(0xFFFFFFFF))
                np.minimum.at(flat, key, dart)
        todo = todo[(sig[todo] == np.uint64(0xFFFFFFFFFFFFFFFF)).any(axis=1)]
        reach *= 2
    return sig


def _sign(batches):
    import xxhash
    names = ["k", "th", "digest", "weight", "sig", "bands"]
    for big in batches:
        for b in tokens.slices(big, chars=8_000_000):
            texts = b.column("text")
            region, begin = cells(texts)
            sig = signatures(region, begin)
            ids = (sig & np.uint64(0xFFFFFFFF)).astype("<u4")
            with np.errstate(over="ignore"):
                band = np.zeros((len(sig), BANDS), np.uint64)
                for r in range(ROWS):
                    band = mix(band * _MUL[3] + sig[:, r:BANDS * ROWS:ROWS] + np.uint64(1))
                band += np.arange(BANDS, dtype=np.uint64) * _MUL[4]
            digest = [xxhash.xxh3_128_hexdigest(" ".join((t or "").lower().split())) for t in texts.to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("k"), b.column("th"), pa.array(digest), pa.array(np.diff(begin)), pa.array([x.tobytes() for x in ids], pa.binary()),
                 pa.array(list(band.view(np.int64)), pa.list_(pa.int64()))], names=names)


def _agree(batches):
    for b in batches:
        a = np.frombuffer(b"".join(b.column("sa").to_pylist()), "<u4").reshape(-1, K)
        c = np.frombuffer(b"".join(b.column("sb").to_pylist()), "<u4").reshape(-1, K)
        on = pa.array((a == c).mean(axis=1) >= SCREEN)
        yield pa.RecordBatch.from_arrays([b.column("a").filter(on), b.column("b").filter(on)], names=["a", "b"])


def similarity(left: pa.Array, right: pa.Array) -> np.ndarray:
    """Weighted Jaccard index of each pair of texts; two texts without a word: 1."""
    (x, xb), (y, yb) = cells(left), cells(right)
    out = np.zeros(len(left))
    for i in range(len(left)):
        p, q = x[xb[i]:xb[i + 1]], y[yb[i]:yb[i + 1]]
        same = len(np.intersect1d(p, q, assume_unique=True))
        both = len(p) + len(q) - same
        out[i] = same / both if both else 1.0
    return out


def _verify(bound: float):
    def run(batches):
        for big in batches:
            for b in tokens.slices(big, "ta", 4_000_000):
                on = pa.array(similarity(b.column("ta"), b.column("tb")) >= bound)
                yield pa.RecordBatch.from_arrays([b.column("a").filter(on), b.column("b").filter(on)], names=["a", "b"])
    return run


def _texts(uids: DataFrame, sigs: DataFrame, texts: DataFrame) -> DataFrame:
    """uid, text of the given documents, written once."""
    return saved(uids.join(sigs.select("uid", "k", "th"), "uid").join(texts, ["k", "th"]).select("uid", "text").dropDuplicates(["uid"]), "near-texts")


def _links(pairs: DataFrame, sigs: DataFrame, texts: DataFrame, bound: float) -> DataFrame:
    """Pairs ``a, b`` (uids) whose texts are similar enough."""
    d = pairs.join(sigs.select(F.col("uid").alias("a"), F.col("sig").alias("sa")), "a").join(
        sigs.select(F.col("uid").alias("b"), F.col("sig").alias("sb")), "b")
    d = saved(d.select("a", "b", "sa", "sb").mapInArrow(_agree, "a long, b long"), "near-pairs")
    need = _texts(d.select(F.col("a").alias("uid")).union(d.select("b")).distinct(), sigs, texts)
    d = d.join(need.select(F.col("uid").alias("a"), F.col("text").alias("ta")), "a").join(
        need.select(F.col("uid").alias("b"), F.col("text").alias("tb")), "b")
    return saved(d.select("a", "b", "ta", "tb").mapInArrow(_verify(bound), "a long, b long"), "near-links")


def _region_counts(batches):
    total = np.zeros(COUNTERS, np.int64)
    for big in batches:
        for b in tokens.slices(big, chars=8_000_000):
            region, _ = cells(b.column("text"))
            total += np.bincount((region % np.uint64(COUNTERS)).astype(np.int64), minlength=COUNTERS)
    slot = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(slot), pa.array(total[slot])], names=["slot", "n"])


def first_regions(region: np.ndarray, begin: np.ndarray, often: np.ndarray, bound: float):
    """Of each set, the regions that one of its partners must share one of, in rarest-first order, and where they begin;
    how many of them if the partner is larger; and the sets' sizes."""
    n = np.diff(begin)
    doc = np.repeat(np.arange(len(n)), n)
    order = np.lexsort((region, often[(region % np.uint64(len(often))).astype(np.int64)], doc))
    probe = np.where(n, n - np.ceil(bound * n - 1e-9).astype(np.int64) + 1, 0)
    index = np.where(n, n - np.ceil(2 * bound / (1 + bound) * n - 1e-9).astype(np.int64) + 1, 0)
    ends = np.cumsum(probe)
    at = np.repeat(begin[:-1] - (ends - probe), probe) + np.arange(ends[-1] if len(ends) else 0)
    return region[order][at], np.concatenate([[0], ends]), index, n


def _first(bound: float, often):
    def run(batches):
        for big in batches:
            for b in tokens.slices(big, chars=8_000_000):
                got, begin, index, n = first_regions(*cells(b.column("text")), often.value, bound)
                lists = pa.ListArray.from_arrays(pa.array(begin.astype(np.int32)), pa.array(got.view(np.int64)))
                yield pa.RecordBatch.from_arrays([b.column("uid"), pa.array(n), pa.array(index), lists], names=["uid", "size", "n_index", "cells"])
    return run


def sharing_pairs(member: DataFrame, texts: DataFrame, bound: float) -> DataFrame:
    """``u, u2`` of different components that may be similar: every pair at the bound or above is among them. ``member``:
    uid, component; ``texts``: uid, text."""
    spark = member.sparkSession
    rows = texts.mapInArrow(_region_counts, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).collect()   # at most COUNTERS rows
    often = np.zeros(COUNTERS, np.int64)
    for r in rows:
        often[r["slot"]] = r["n"]
    first = texts.mapInArrow(_first(bound, spark.sparkContext.broadcast(often)), "uid long, size long, n_index long, cells array<long>")
    first = saved(first.join(member.select("uid", "component").distinct(), "uid"), "near-regions")
    rows = first.select("uid", "size", "component", "n_index", F.posexplode("cells").alias("at", "cell"))
    per = rows.groupBy("cell", "component").agg(F.count(F.lit(1)).alias("m"), F.max((F.col("at") < F.col("n_index")).cast("int")).alias("ix"))
    per = per.groupBy("cell").agg(F.max_by("component", "m").alias("most"), F.count(F.lit(1)).alias("groups"), F.max("ix").alias("ix"))
    rows = saved(rows.join(per.where("groups > 1 and ix = 1").select("cell", "most"), "cell"), "near-shared-regions")
    x = rows.where("at < n_index").select("cell", F.col("uid").alias("u"), F.col("size").alias("n"), F.col("component").alias("c"), F.col("at").alias("i"), "most")
    y = rows.select("cell", F.col("uid").alias("u2"), F.col("size").alias("n2"), F.col("component").alias("c2"), F.col("at").alias("i2"), F.col("most").alias("most2"))
    fits = (F.col("c") != F.col("c2")) & ((F.col("n") < F.col("n2")) | ((F.col("n") == F.col("n2")) & (F.col("u") < F.col("u2"))))
    fits &= F.least(F.col("n") - F.col("i"), F.col("n2") - F.col("i2")) >= F.lit(bound / (1 + bound)) * (F.col("n") + F.col("n2")) - F.lit(1e-6)
    found = x.where("c <> most").join(y, "cell").where(fits).select("u", "u2").unionByName(
        x.where("c = most").join(y.where("c2 <> most2"), "cell").where(fits).select("u", "u2"))
    return found.distinct()


def _known(comp: DataFrame, links: DataFrame) -> DataFrame:
    """Two steps of smallest labels along the links: members of a class share a label more often than before, and never
    with another class. (Only to spare comparisons; the classes come from all links at the end.)"""
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    for _ in range(2):
        low = both.join(comp.withColumnRenamed("uid", "b"), "b").groupBy(F.col("a").alias("uid")).agg(F.min("component").alias("low"))
        comp = comp.join(low, "uid", "left").select("uid", F.least("component", F.coalesce("low", "component")).alias("component"))
    return comp


def _keyed(docs: DataFrame) -> DataFrame:
    t = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(FIRST)).alias("k"), F.xxhash64(t).alias("th"), t.alias("text"))


def classes(docs: DataFrame, bound: float = BOUND) -> DataFrame:
    """One row for each of ``docs``: k, th, class_id (smallest doc_id of the class), class_size, kept (one row of each class)."""
    keyed = _keyed(docs)
    meta = keyed.mapInArrow(_sign, "k long, th long, digest string, weight long, sig binary, bands array<long>")
    meta = saved(meta.withColumn("uid", F.monotonically_increasing_id()), "near-docs")
    reps = saved(meta.groupBy("digest").agg(F.min("uid").alias("uid")), "near-reps")
    sigs = saved(meta.where("weight > 0").join(reps.select("uid"), "uid").select("uid", "k", "th", "sig", "bands"), "near-signatures")
    rows = sigs.select("uid", F.explode("bands").alias("key"))
    shared = rows.groupBy("key").agg(F.count(F.lit(1)).alias("m")).where("m > 1")
    rows = rows.join(shared, "key").withColumn("pop", F.sum("m").over(Window.partitionBy("uid")))      # a document has BANDS rows
    rows = saved(rows, "near-bands")
    nodes = rows.select(F.col("uid").alias("id")).distinct()
    comp, found, done = None, None, None
    for leaders in (*LEADERS, None):
        member = rows.withColumn("component", F.col("uid")) if comp is None else rows.join(comp, "uid")
        picks = [F.max_by(F.struct("uid", "component"), F.struct("pop", "uid") if s == "pop" else F.xxhash64("uid", F.lit(s))).alias(f"x{i}")
                 for i, s in enumerate(leaders or ())]
        open_ = member.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), *picks).where("lo < hi")
        if leaders:
            lead = open_.select("key", F.explode(F.array(*[f"x{i}" for i in range(len(leaders))])).alias("x"))
            lead = lead.select("key", F.col("x.uid").alias("u2"), F.col("x.component").alias("c2"))
            pairs = member.join(lead, "key").where("component <> c2").select("uid", "u2")
        else:
            rest = saved(member.join(open_.select("key"), "key", "left_semi"), "near-open")
            few = rest.where(F.col("m") <= SMALL)
            other = few.select("key", F.col("uid").alias("u2"), F.col("component").alias("c2"))
            pairs = few.join(other, "key").where("component <> c2 and uid < u2").select("uid", "u2")
            many = rest.where(F.col("m") > SMALL).select("uid", "component").distinct()
            if not many.isEmpty():
                many = saved(many, "near-many")
                pairs = pairs.unionByName(sharing_pairs(many, _texts(many.select("uid"), sigs, keyed), bound).withColumnRenamed("u", "uid"))
        pairs = pairs.select(F.least("uid", "u2").alias("a"), F.greatest("uid", "u2").alias("b")).distinct()
        if done is not None:
            pairs = pairs.join(done, ["a", "b"], "left_anti")
        pairs = saved(pairs, "near-candidates")
        done = pairs if done is None else done.unionByName(pairs)
        new = _links(pairs, sigs, keyed, bound)
        found = new if found is None else found.unionByName(new)
        if leaders:
            comp = saved(_known(member.select("uid", "component").distinct(), found), "near-known")
    comp = connected_components(nodes, found.select(F.col("a").alias("src"), F.col("b").alias("dst")))
    all_reps = reps.join(comp.withColumnRenamed("id", "uid"), "uid", "left").select("digest", F.coalesce("component", "uid").alias("c"))
    out = saved(meta.select("uid", "k", "th", "digest").join(all_reps, "digest"), "near-members")
    per = out.groupBy("c").agg(F.min(F.struct("k", "uid")).alias("first"), F.count(F.lit(1)).alias("class_size"))
    out = out.join(per, "c")
    return out.select("k", "th", F.when(F.col("first.k") != FIRST, F.col("first.k")).alias("class_id"), "class_size",
                      (F.col("uid") == F.col("first.uid")).alias("kept"))


def near_duplicates(docs: DataFrame, bound: float = BOUND) -> DataFrame:
    """``doc_id, class_id, class_size, kept`` for every row of ``docs``."""
    return classes(docs, bound).select(F.when(F.col("k") != FIRST, F.col("k")).alias("doc_id"), "class_id", "class_size", "kept")


def deduped(docs: DataFrame, bound: float = BOUND) -> DataFrame:
    """``docs`` with one document of each class: the one with the smallest doc_id."""
    keep = saved(classes(docs, bound).where("kept").select("k", "th"), "near-kept")
    body = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    d = docs.select(body, F.coalesce(F.col("doc_id").cast("long"), F.lit(FIRST)).alias("k"),
                    F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("th"))
    d = d.join(keep, ["k", "th"], "left_semi").withColumn("n", F.row_number().over(Window.partitionBy("k", "th").orderBy(F.lit(1))))
    return d.where("n = 1").select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
