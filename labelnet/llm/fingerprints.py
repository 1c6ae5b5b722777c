"""Document fingerprints: a homomorphic multiset hash of paragraphs.

A paragraph (what lies between line feeds) is hashed to a wide vector, and a document's fingerprint is
the sum of its paragraphs' vectors. So the order of the paragraphs doesn't matter, and inserting or
deleting a paragraph adds or subtracts its vector, without the rest of the text. The vector has
- 16 lanes modulo 2**32 expanded from the paragraph's SHA-256: equality;
- 128 lanes modulo 2**16: every three words in a row of the paragraph (all words, if there are fewer) add a random
  sign to a random lane (xxHash64). The squared difference of two documents over these lanes is on average the
  squared distance of their word-triple counts, which gives their likeness
  ``1 - |a - b|^2 / (|a|^2 + |b|^2)``, cut off below at 0. With 128 lanes its error is about 0.09 or less.

Everything is built-in column expressions. What a text adds to its lanes is one number each, with the lane in its
low bits; texts are dealt by their key before, so those rows are summed where they arise and never shuffled.

Defined cases: a null text is empty, and the empty text is one empty paragraph; documents that share a
doc_id share the next document (the next smaller doc_id's; of several texts of that one, the smallest);
a null doc_id comes last; repeated rows give equal rows; an empty table gives an empty result; a text of any
length is summed whole, a row for each triple; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelnet.util import dense_index

from .common import text_or_empty

EQUAL, SIGNS, WORDS = 16, 128, 3
LAST = -(1 << 63)                 # stands for a null doc_id


# what is added: bits 0-7 the lane. Lanes below 128 are signs: bit 8 says which, bit 9 that nothing is added. From
# 128 on, the bits above 7 are the number: equality lanes, then copies, length and the SHA-256 of the whole text
_EQUAL, _COPIES, _LENGTH, _WHOLE = 128, 144, 145, 146


def _triples(words: Column) -> Column:
    n = F.size(words)
    steps = F.sequence(F.lit(0), F.greatest(n - F.lit(WORDS), F.lit(0)))
    return F.transform(steps, lambda i: F.xxhash64(*[F.get(words, i + j) for j in range(WORDS)]).bitwiseAND(F.lit(~0x280)))


def _number(value: Column, lane: int) -> Column:
    return F.shiftleft(value.cast("long"), 8) + F.lit(lane)


def vector_sums(texts: DataFrame, keys: list[str], whole: bool = False) -> DataFrame:
    """``texts`` (keys, text; dealt by the first key) -> keys, ``equal`` (16 lanes), ``signs`` (128 lanes), ``copies``;
    with ``whole`` also ``n_chars`` and ``sha256`` of the text. Equal rows under a key add up and are divided again."""
    d = texts.select(*keys, F.length("text").alias("_n"), (F.sha2("text", 256) if whole else F.lit("")).alias("_sha"),
                     F.posexplode(F.split("text", "\n")).alias("_p", "_par"))
    # columns of their own: inside the array functions below, an expression would be computed again for every element
    d = d.withColumns({"_words": F.split("_par", " "), "_digest": F.unhex(F.sha2(F.col("_par"), 256))})
    digest = F.col("_digest")
    hashes = [F.xxhash64(digest, F.lit(i)) for i in range(EQUAL // 2)]
    low32 = F.lit(0xFFFFFFFF)
    equal = [_number(x, _EQUAL + 2 * i + j) for i, h in enumerate(hashes) for j, x in enumerate((h.bitwiseAND(low32), F.shiftrightunsigned(h, 32)))]
    once = [_number(F.lit(1), _COPIES)] + [F.lit(0x200 + i).cast("long") for i in range(SIGNS)]
    if whole:
        once += [_number(F.col("_n"), _LENGTH)] + [_number(F.conv(F.substring("_sha", 1 + 8 * i, 8), 16, 10), _WHOLE + i) for i in range(8)]
    adds = F.concat(F.array(*equal), F.when(F.col("_p") == 0, F.array(*once)).otherwise(F.array().cast("array<bigint>")),
                    _triples(F.col("_words")))
    d = d.select(*keys, F.explode(adds).alias("_x"))
    x, bit = F.col("_x"), lambda m: F.col("_x").bitwiseAND(F.lit(m)) != 0
    value = F.when(bit(0x80), F.shiftrightunsigned(x, 8)).when(bit(0x200), F.lit(0)).when(bit(0x100), F.lit(1)).otherwise(F.lit(-1))
    g = d.groupBy(*keys, x.bitwiseAND(F.lit(0xFF)).cast("int").alias("_lane")).agg(F.sum(value.cast("long")).alias("_s"))
    g = g.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("_lane", "_s"))).alias("_all"))       # all lanes of a text, in order
    g = g.withColumn("copies", F.get(F.col("_all"), F.lit(_COPIES))["_s"])
    # ``div``: a quotient of doubles would be off by one beyond 2**53
    part = lambda at, n, to: F.expr(f"transform(slice(_all, {at + 1}, {n}), v -> {to.format('v._s div copies')})")
    out = [part(_EQUAL, EQUAL, "pmod({}, 4294967296)").alias("equal"),
           part(0, SIGNS, "cast(pmod({} + 32768, 65536) - 32768 AS short)").alias("signs"), "copies"]
    if whole:
        out += [F.expr(f"get(_all, {_LENGTH})._s div copies").alias("n_chars"),
                F.array_join(part(_WHOLE, 8, "lpad(lower(hex({})), 8, '0')"), "").alias("sha256")]
    return g.select(*keys, *out)


def _wrap(x: Column) -> Column:
    """Modulo 2**16, in -32768..32767."""
    return (F.pmod(x + F.lit(32768), F.lit(65536)) - F.lit(32768)).cast("short")


def narrow(signs: Column) -> Column:
    """Sign lanes for a shuffle: a byte each, if all of them fit."""
    fit = F.forall(signs, lambda x: x.between(-128, 127))
    return F.struct(F.when(fit, signs.cast("array<tinyint>")).alias("b"), F.when(~fit, signs).alias("s"))


def wide(lanes: Column) -> Column:
    return F.coalesce(lanes["b"].cast("array<short>"), lanes["s"])


def packed(equal: Column) -> Column:
    """Two equality lanes in each number: half the bytes to shuffle."""
    return F.transform(F.sequence(F.lit(0), F.lit(EQUAL // 2 - 1)),
                       lambda i: F.shiftleft(F.get(equal, i * 2), 32).bitwiseOR(F.get(equal, i * 2 + 1)))


def to_text(equal: Column, signs: Column) -> Column:
    """The fingerprint as 640 hex digits: 8 for each equality lane (given ``packed``), 4 for each sign lane."""
    return F.concat(F.array_join(F.transform(equal, lambda x: F.lpad(F.lower(F.hex(x)), 16, "0")), ""),
                    F.array_join(F.transform(signs, lambda x: F.lpad(F.lower(F.hex(F.pmod(x.cast("long"), F.lit(65536)))), 4, "0")), ""))


def combine(a: Column, b: Column, sign: int, bits: int) -> Column:
    """Lanes of a document with a paragraph's lanes inserted (``sign`` 1) or deleted (-1), modulo 2**bits
    (16: sign lanes; 32: equality lanes)."""
    both = F.zip_with(a, b, lambda x, y: x.cast("long") + y.cast("long") * sign)
    return F.transform(both, _wrap if bits == 16 else (lambda x: F.pmod(x, F.lit(1 << 32))))


def likeness(a: str, b: str) -> Column:
    """Of two fingerprints, given as the prefixes of their columns ``<prefix>equal`` and ``<prefix>signs``."""
    x, y = F.col(a + "signs"), F.col(b + "signs")
    square = lambda v: F.aggregate(v, F.lit(0.0), lambda s, e: s + e.cast("double") * e.cast("double"))
    far = square(F.zip_with(x, y, lambda p, q: _wrap(p.cast("int") - q.cast("int"))))
    both = square(x) + square(y)
    like = F.when(both > 0, 1.0 - far / both).otherwise(F.lit(0.0))
    return F.when(F.col(a + "equal") == F.col(b + "equal"), F.lit(1.0)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), like)))


def next_keys(docs: DataFrame) -> DataFrame:
    """``k, next_k``: the next smaller key, and the largest after the smallest."""
    ids = dense_index(docs.select("k"), "k", "r", start=0)
    n = ids.count()
    after = ids.select(F.col("k").alias("next_k"), F.pmod(F.col("r") + 1, F.lit(max(n, 1))).alias("r"))
    return ids.join(after, "r").select("k", "next_k")


def fingerprints(docs: DataFrame) -> DataFrame:
    """One row for each of ``docs``: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text has its second half replaced by as much of the beginning of the next document, in descending doc_id.
    """
    d = docs.select(F.coalesce(F.col("doc_id"), F.lit(LAST)).cast("long").alias("k"), text_or_empty().alias("text"))
    by_key = d.repartition("k")
    own = vector_sums(by_key.withColumn("th", F.xxhash64("text")), ["k", "th"]).withColumn("equal", packed(F.col("equal")))
    follows = next_keys(d)
    heads = d.select("k", F.xxhash64("text").alias("e_th"), F.expr("length(text) div 2").cast("int").alias("half"), F.length("text").alias("n"),
                     F.expr("left(text, cast(length(text) - length(text) div 2 as int))").alias("head")).join(follows, "k")
    after = by_key.groupBy(F.col("k").alias("next_k")).agg(F.min(F.struct(F.xxhash64("text").alias("th"), "text"))["text"].alias("next_text"))
    edited = heads.join(after, "next_k").select("next_k", "k", "e_th", "n", F.concat("head", F.expr("left(next_text, half)")).alias("text"))
    new = vector_sums(edited, ["next_k", "k", "e_th", "n"], whole=True)
    new = new.select(F.col("k").alias("e_k"), "e_th", F.col("n").cast("long").alias("n_chars"), F.unhex("sha256").alias("sha"),
                     packed(F.col("equal")).alias("e_equal"), narrow(F.col("signs")).alias("e_lanes"))
    first = own.groupBy(F.col("k").alias("f_k")).agg(F.min(F.struct("th", "equal", "signs")).alias("x"))
    # joined by k alone, for which the own lanes lie right; texts of one doc_id are told apart after that
    out = own.join(new, (F.col("k") == F.col("e_k")) & (F.col("th").bitwiseXOR(F.col("e_th")) == 0))
    # the next document's lanes go to the key of the document before it; nothing wider moves
    after = first.join(follows, F.col("f_k") == F.col("next_k")).select(
        F.col("k").alias("b_k"), F.col("x.equal").alias("n_equal"), narrow(F.col("x.signs")).alias("n_lanes"))
    out = out.join(after, F.col("k") == F.col("b_k")).withColumns({"e_signs": wide(F.col("e_lanes")), "n_signs": wide(F.col("n_lanes"))})
    out = out.select(F.when(F.col("k") != LAST, F.col("k")).alias("doc_id"), "n_chars",
                     F.lower(F.hex("sha")).alias("edited_sha256"), to_text(F.col("equal"), F.col("signs")).alias("fingerprint"),
                     to_text(F.col("e_equal"), F.col("e_signs")).alias("edited_fingerprint"),
                     likeness("", "e_").alias("near_edited"), likeness("", "n_").alias("near_next"), "copies")
    return out.withColumn("_c", F.explode(F.expr("sequence(1L, copies)"))).drop("copies", "_c")
