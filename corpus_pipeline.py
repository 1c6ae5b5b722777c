"""Corpus pipeline over ``documents``: language ID, line dedup, MinHash near-dedup, packing.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is written as Parquet and reread as the
next one's ``docs``. All but the last return the columns of ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelnet.llm import language_id, line_dedup, minhash, packing, tokens
from labelnet.llm.common import free_name, saved
from labelnet.session import ship_package

EVIDENCE = 0.5     # a text is rejected below this part of the evidence that is usual in the model's languages


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the model knows: without a letter, or with less than ``EVIDENCE`` of the usual, they go.

    Without a learned language (no lang in the learning fold) only texts that are null or without a letter go.
    A score isn't evidence: the scores of the learned languages sum up to 1 for any text, at any number of languages.
    The model learns from the same documents' lang as ``op6`` does. The text itself is the key of a decision, as the
    prediction depends on nothing else.
    """
    ship_package(spark)
    model = language_id.train(docs, ~language_id.fold_of(4, 2))
    key = free_name(docs, "text_key")
    keyed = docs.withColumn(key, F.struct(F.xxhash64("text").alias("a"), F.xxhash64("text", F.lit(1)).alias("b")))
    found = language_id.predict(keyed.select(F.col(key).getField("a").alias("a"), F.col(key).getField("b").alias("b"), "text"), model, ["a", "b"], told=True)
    gone = found.where(F.col("evidence").isNull() | (F.col("evidence") < EVIDENCE * model["usual"])).select(F.struct("a", "b").alias(key)).distinct()
    return keyed.join(saved(gone, "languages-rejected"), key, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Duplicate lines go (the earliest stays); a document of which only layout is left goes, as its lines are elsewhere.

    Null and empty texts stay, a null doc_id comes first, of repeated rows the first keeps its lines and the others go
    (unless they have none), long texts are split whole, an empty table stays empty, other columns stay as they are.
    """
    ship_package(spark)
    out = line_dedup.deduped(docs)
    removed = [c for c in out.columns if c not in docs.columns][0]
    lost = (F.col(f"`{removed}`") > 0) & ~F.col("text").rlike(r"[\p{L}\p{N}]")
    return out.where(~lost | F.col("text").isNull()).select(*[F.col(f"`{c}`") for c in docs.columns])


def dedup_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates stays: the one with the smallest doc_id (null is smallest).

    Null and empty texts are one class, of equal rows one stays, long texts are compared whole, an empty table stays empty,
    other columns stay as they are.
    """
    ship_package(spark)
    return minhash.deduped(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 1024 tokens.

    A null or empty text is its end id alone, repeated rows are packed like others, a long text is cut into pieces, an empty
    table gives no pieces, other columns are ignored.
    """
    ship_package(spark)
    return packing.pack(docs, tokens.vocabulary("byte_bpe_50k.json"))


STAGES = [("language_id", identify_language), ("line_dedup", dedup_lines), ("minhash_near_dedup", dedup_near), ("packing", pack)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


ORACLE_SQL = None      # sampling fits and packing have no SQL form; tests hold the stages against brute force
