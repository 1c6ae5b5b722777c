"""URL rules by longest match: a blocked Bloom filter of the listed URLs in front of an exact hash join.

A listed URL is a host, a path and a verdict. It fits a URL whose host is the same or a subdomain and
whose path starts with the listed one; of those that fit, the longest wins (then the longer host).
Every URL names its candidates: each suffix of its host at a label border, with each prefix of its
path that is as long as some listed path. Candidates that the filter may hold join the list itself,
which removes the false positives. A URL that no listed one fits gets ``otherwise``.

Defined cases: a null url, or one without ``://``, has an empty host and path and fits nothing; equal
rows each get a row; an empty list gives ``otherwise`` for all; an empty table an empty result. A list
that names a key twice keeps its smallest verdict (allow before block). A url of any length is judged whole; other columns
are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bloom
from .common import ascii_lower, saved

BROADCAST_KEYS = 100_000                      # a list up to this many keys (a few MB) is broadcast

RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
         ("com", "/fr/", "allow"), ("com", "/de/", "block")]


def split_url(url: Column) -> tuple[Column, Column]:
    """(host, path) columns."""
    u = F.coalesce(url, F.lit(""))
    at = F.instr(u, "://")
    rest = F.when(at > 0, F.substring(u, at + 3, F.length(u))).otherwise(F.lit(""))
    host = ascii_lower(F.regexp_extract(rest, r"(?s)\A([^/?#]*)", 1))
    path = F.regexp_extract(rest, r"(?s)\A[^/?#]*([^?#]*)", 1)
    return host, path


def rule_table(spark: SparkSession, rules=RULES) -> DataFrame:
    return spark.createDataFrame(rules, "host string, path string, verdict string")


def judge(pages: DataFrame, listed: DataFrame, otherwise: str = "allow") -> DataFrame:
    """One row for each of ``pages``: ``page_id, host, path, rule, verdict``."""
    host, path = split_url(F.col("url"))
    rows = saved(pages.select("page_id", host.alias("host"), path.alias("path")), "urls")
    lst = (listed.where("host is not null and path is not null")
           .select(F.concat(ascii_lower(F.col("host")), F.lit(" "), F.col("path")).alias("key"), ascii_lower(F.col("host")).alias("lhost"),
                   F.col("path").alias("lpath"), "verdict"))
    lst = saved(lst.groupBy("key").agg(F.first("lhost").alias("lhost"), F.first("lpath").alias("lpath"), F.min("verdict").alias("verdict")), "listed")
    n_keys = lst.count()
    small = n_keys <= BROADCAST_KEYS
    # path lengths in use: at most as many as the longest listed path has characters
    lens = sorted(r[0] for r in lst.select(F.length("lpath")).distinct().collect())
    words, blocks = bloom.build(lst, n_keys)
    urls = rows.distinct()
    labels = F.split("host", "\\.")
    c = urls.select("host", "path", F.explode(F.transform(F.sequence(F.lit(1), F.size(labels)),
                    lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))).alias("suffix"))
    c = c.select("host", "path", "suffix", F.explode(F.filter(F.array(*[F.lit(x) for x in lens] or [F.lit(0)]),
                 lambda x: x <= F.length("path"))).alias("n"))
    c = c.select("host", "path", F.concat("suffix", F.lit(" "), F.expr("substring(path, 1, n)")).alias("key"))
    hits = bloom.may_hold(c, words, blocks, small).join(F.broadcast(lst) if small else lst, "key")
    size = F.length("lhost") + F.length("lpath")
    best = hits.groupBy("host", "path").agg(F.max(F.struct(size.alias("n"), F.length("lhost").alias("h"), F.concat("lhost", "lpath").alias("rule"), "verdict")).alias("b"))
    out = rows.join(best, ["host", "path"], "left")
    return out.select("page_id", "host", "path", F.col("b.rule").alias("rule"), F.coalesce("b.verdict", F.lit(otherwise)).alias("verdict"))
