"""Line dedup by a deletion-neighbourhood join, at an edit bound of one character.

Two lines are within one edit when they are equal, or have the same length and agree after deleting the
character at the same place from both (a substitution), or one equals the other after deleting one of
its characters (an insertion). So a line of n characters stands for n + 1 hashed keys: itself, and itself
without each character. Most lines have no partner, so the neighbourhood is emitted from coarse to fine,
without loss:
- an edit spares the beginning or the end of a line, so partners share a hash of nearly half a line. Lines
  that share neither are done;
- the others are cut into blocks of about ``BLOCK`` characters, with a key for the line without each block;
- only blocks whose key another line has too emit a key for each of their characters.
Keys are joined by aggregation (the earliest line of a key, the earliest shorter one), never by listing the
pairs of a key, and the edit distance of what is found is verified at the end.

A line is a duplicate when an earlier line (by doc_id, then text's hash, then place) is within the bound,
whether that one stays or not; the earliest stays. Lines are compared in normal form: A-Z lower-cased, blanks
at both ends cut off, runs of blanks as one. Below ``LEAST`` characters only equal lines match. Lines without a
letter or digit are layout and always stay.

Whole texts are shuffled only where something may change: bounded Bloom filters (2 MB at most) let the
other rows pass by; when they saturate, more rows are shuffled, and the result is the same.

Defined cases: a null text stays null; a null doc_id comes first; repeated rows are duplicates of the first
one; an empty table gives an empty result; other columns are kept as they are, whatever their names; a text of any length
is split whole (a row for each line), and a long line is keyed and compared as a whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import bloom
from .common import ascii_lower, free_name, saved

BLOCK, LEAST = 48, 16
FIRST = -(1 << 63)            # stands for a null doc_id


def normal(line: Column) -> Column:
    low = ascii_lower(line)
    odd = line.contains("  ") | line.contains("\t") | line.contains("\r") | line.contains("\u00a0") | line.startswith(" ") | line.endswith(" ")
    return F.when(odd, F.trim(F.regexp_replace(low, "[ \t\r\u00a0]+", " "))).otherwise(low)


def _keyed(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) -> k, th, text."""
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(FIRST)).alias("k"), F.xxhash64("text").alias("th"), "text")


def _lines(keyed: DataFrame) -> DataFrame:
    d = keyed.select("k", "th", F.posexplode(F.split("text", "\n")).alias("at", "line"))
    d = d.where(F.col("line").rlike(r"[\p{L}\p{N}]")).select("k", "th", "at", normal(F.col("line")).alias("t"))
    return d.withColumns({"h1": F.xxhash64("t"), "h2": F.xxhash64("t", F.lit(1))})


def _half_keys(lines: DataFrame) -> DataFrame:
    """Adds ``halves``: hashes of the beginning and the end of ``t``, nearly half of it, for its length and the length
    before. Beginnings grow in steps, so that for most lengths the two are the same."""
    def size(n: Column) -> Column:
        step = F.call_function("shiftleft", F.lit(1), F.floor(F.log2(F.greatest(F.lit(1.0), n / 16))).cast("int"))
        return (F.floor((n - 1) / 2 / step) * step).cast("int")
    n = F.length("t")
    d = lines.withColumns({"_q": size(n), "_r": size(F.greatest(n - 1, F.lit(1)))})
    pair = lambda q: [F.xxhash64(F.lit(0), q, F.call_function("left", F.col("t"), F.col(q))),
                      F.xxhash64(F.lit(1), q, F.call_function("right", F.col("t"), F.col(q)))]
    halves = F.when(n < LEAST, F.array().cast("array<bigint>")).when(F.col("_q") == F.col("_r"), F.array(*pair("_q"))).otherwise(
        F.array(*pair("_q"), *pair("_r")))
    return d.withColumn("halves", halves).drop("_q", "_r")


def block_keys(d: DataFrame) -> DataFrame:
    """``d`` (id, t) -> id, role, a, z, key: the blocks a..z-1 of a line, with a hash of the line without that block.
    Role 0: as the line is. Role 1: as a longer line, cut like the lines that are one character shorter; its block has
    one character more."""
    r = d.select("id", "t", F.explode(F.array(F.lit(0), F.lit(1))).alias("role"))
    r = r.withColumn("n", F.length("t") - F.col("role")).where(f"n >= {LEAST}")
    r = r.withColumn("b", F.expr(f"cast(greatest(1, n div {BLOCK}) as int)")).withColumn("w", F.expr("cast(ceil(n / b) as int)"))
    r = r.withColumn("j", F.explode(F.expr("sequence(0, b - 1)")))
    r = r.withColumn("a", F.expr("least(j * w, n)")).withColumn("z", F.expr("if(j = b - 1, n, least((j + 1) * w, n))"))
    return r.select("id", "role", "a", "z", F.xxhash64("n", "j", F.expr("left(t, a)"), F.expr("substring(t, z + role + 1)")).alias("key"))


def neighbours(left: DataFrame) -> DataFrame:
    """``left`` (id, t; ids in order of first occurrence, texts distinct) -> ``id, other``: for every line that has
    an earlier one within one edit, the earliest of those."""
    keys = block_keys(left)
    n = keys.groupBy("key").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).where("lo < hi").select("key")
    f = keys.join(n, "key", "left_semi").join(left, "id")
    f = f.select("id", "key", "role", F.expr("substring(t, a + 1, z - a + role)").alias("blk"))
    # within a block: role 0 whole (the shorter line), role 0 without each character (a substitution, with its place),
    # role 1 without each character (an insertion, seen from the longer line)
    f = f.select("*", F.explode(F.expr("sequence(role, greatest(role, length(blk)))")).alias("p"))
    cut = F.concat(F.expr("left(blk, p - 1)"), F.expr("substring(blk, p + 1)"))
    subst = (F.col("role") == 0) & (F.col("p") > 0)
    short = (F.col("role") == 0) & (F.col("p") == 0)
    v = f.select("id", F.when(subst, F.xxhash64("key", F.lit(2), "p", cut)).when(short, F.xxhash64("key", F.lit(1), "blk"))
                 .otherwise(F.xxhash64("key", F.lit(1), cut)).alias("v"), subst.alias("subst"), short.alias("short")).distinct()
    v = saved(v, "line-variants")
    # the lines of a substitution key are all neighbours; under an insertion key the longer ones only of the shorter
    g = v.groupBy("v").agg(F.min("id").alias("lo"), F.max("id").alias("hi"), F.min(F.when(F.col("short"), F.col("id"))).alias("s"),
                           F.min(F.when(~F.col("short"), F.col("id"))).alias("l")).where("lo < hi")
    c = v.join(g, "v").select("id", F.when(F.col("subst"), F.col("lo")).when(F.col("short"), F.col("l")).otherwise(F.col("s")).alias("other"))
    c = c.where("other < id").distinct()
    ok = (c.join(left.select("id", F.col("t").alias("t1")), "id")
          .join(left.select(F.col("id").alias("other"), F.col("t").alias("t2")), "other")
          .where(F.levenshtein("t1", "t2", 1) >= 0))
    return ok.groupBy("id").agg(F.min("other").alias("other"))


def _filtered(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows of ``rows`` whose ``key`` is in ``keys`` (one column, distinct), behind a bounded Bloom filter. An inner join:
    a semi join would be moved in front of the filter."""
    words, n = bloom.build(keys.select(F.col(key).alias("key")), keys.count(), bloom.MOST_BLOCKS)
    return bloom.may_hold(rows, words, n, True, key=key).join(keys, key)


def decisions(docs: DataFrame) -> DataFrame:
    """``k, th, gone, copies``: for documents that lose lines (or repeat as rows), the places of the lines that go."""
    keyed = _keyed(docs)
    meta = saved(_half_keys(_lines(keyed)).select("k", "th", "at", "h1", "h2", "halves"), "lines")
    # near lines
    halves = meta.select("h1", F.explode("halves").alias("key"))
    shared = saved(halves.groupBy("key").agg(F.min("h1").alias("lo"), F.max("h1").alias("hi")).where("lo < hi").select("key"), "line-halves")
    maybe = saved(_filtered(halves, shared, "key").select("h1").distinct(), "lines-maybe")
    texts = _filtered(_lines(keyed), maybe, "h1")
    left = saved(texts.groupBy("t").agg(F.min(F.struct("k", "th", "at")).alias("id"), F.first("h1").alias("h1"), F.first("h2").alias("h2")), "lines-left")
    near = saved(neighbours(left.select("id", "t")).join(left, "id").select("h1", "h2").withColumn("near", F.lit(True)), "lines-near")
    # equal lines: all but the first go; of near lines all go
    many = meta.groupBy("h1", "h2").agg(F.min("k").alias("fk"), F.count(F.lit(1)).alias("c")).where("c > 1").select("h1", "h2", "fk")
    many = saved(many.join(near, ["h1", "h2"], "full").select("h1", "h2", "fk", F.coalesce("near", F.lit(False)).alias("near")), "lines-many")
    words, n = bloom.build(many.select(F.col("h1").alias("key")), many.count(), bloom.MOST_BLOCKS)
    occ = bloom.may_hold(meta.select("k", "th", "at", "h1", "h2"), words, n, True, key="h1").join(many, ["h1", "h2"])
    occ = saved(occ, "line-copies")
    first = occ.where("not near and k = fk").groupBy("h1", "h2").agg(F.min(F.struct("th", "at")).alias("first"))
    occ = occ.join(first, ["h1", "h2"], "left")
    gone = F.col("near") | (F.col("k") != F.col("fk")) | (F.struct("th", "at") != F.col("first"))
    per = occ.groupBy("k", "th", "at").agg(F.max(gone).alias("gone"), F.count(F.lit(1)).alias("copies"))
    return per.groupBy("k", "th").agg(F.collect_list(F.when(F.col("gone"), F.col("at"))).alias("gone"), F.max("copies").alias("copies")).where(
        "size(gone) > 0 or copies > 1")


def deduped(docs: DataFrame) -> DataFrame:
    """``docs`` with the duplicate lines taken out of ``text``, and how many lines went, in a column ``n_removed``
    (under another name if there is one)."""
    dec = saved(decisions(docs.select("doc_id", "text")).withColumn("key", F.xxhash64("k", "th")), "line-decisions")
    n_removed = free_name(docs, "n_removed")
    body = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    d = docs.select(body, F.coalesce(F.col("doc_id").cast("long"), F.lit(FIRST)).alias("k"), F.xxhash64("text").alias("th"))
    words, n = bloom.build(dec.select("key"), dec.count(), bloom.MOST_BLOCKS)
    d = bloom.may_hold(d.withColumn("key", F.xxhash64("k", "th")), words, n, True, outer="hit")
    same = d.where("not hit").select("row", F.lit(0).cast("long").alias("n"))
    change = d.where("hit").join(dec.select("k", "th", "gone", "copies"), ["k", "th"], "left")
    change = change.withColumn("copy", F.row_number().over(Window.partitionBy("k", "th").orderBy(F.lit(1))))
    change = change.withColumn("ls", F.split("row.text", "\n"))
    places = F.expr("sequence(0, size(ls) - 1)")
    layout = F.filter(places, lambda i: ~F.get("ls", i).rlike(r"[\p{L}\p{N}]"))
    stay = F.when(F.col("copy") > 1, layout).otherwise(F.array_except(places, F.coalesce("gone", F.array().cast("array<int>"))))
    change = change.withColumn("stay", F.when(F.col("gone").isNotNull(), stay))
    text = F.when(F.col("stay").isNull(), F.col("row.text")).otherwise(F.array_join(F.transform("stay", lambda i: F.get("ls", i)), "\n"))
    change = change.select(F.col("row").withField("text", text).alias("row"),
                           F.when(F.col("stay").isNull(), F.lit(0)).otherwise(F.size("ls") - F.size("stay")).cast("long").alias("n"))
    both = same.unionByName(change)
    return both.select(*[F.col("row").getField(c).alias(c) for c in docs.columns], F.col("n").alias(n_removed))
