"""Table scans and sinks: CSV, warehouse formats, vector store, dictionary."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelnet import schemas


def read_csv_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with header and an explicit schema; bodies may hold newlines and quotes."""
    return (spark.read.schema(schema).option("header", True).option("multiLine", True)
            .option("escape", '"').csv(path))


def read_table(spark: SparkSession, fmt: str, path: str | None = None, schema: T.StructType | None = None, **options) -> DataFrame:
    """Any registered source by format name (parquet, orc, json, a warehouse connector...), held against ``schema`` at load."""
    r = spark.read.format(fmt).options(**options)
    df = r.load(path) if path is not None else r.load()
    return conform(df, schema) if schema is not None else df


def table_glob(folder: str, name: str) -> str:
    """The path of a stream over the tables of ``folder`` called ``name`` (a glob), each a file or a folder of files.

    A filter on file names misses a table that is a folder, as its files have other names; a stream's plain path can't be a
    file. A pattern in braces meets both."""
    return f"{folder.rstrip('/')}/{{{name}}}"


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of ``schema`` in its order; a column that is missing or has another type raises at load, not in a task."""
    have = {f.name: f.dataType for f in df.schema.fields}
    wrong = [f"{f.name}: {have[f.name].simpleString() if f.name in have else 'missing'} instead of {f.dataType.simpleString()}"
             for f in schema.fields if have.get(f.name) != f.dataType]
    if wrong:
        raise ValueError("table doesn't have its schema: " + "; ".join(wrong))
    return df.select(*[f.name for f in schema.fields])


def parse_post_id_list(c) -> "F.Column":
    """Python-list literal of quoted ids (``"['1', '22']"``) -> array<bigint>."""
    return F.transform(F.regexp_extract_all(c, F.lit("[0-9]+"), 0), lambda x: x.cast("bigint"))


def split_id_list(c, sep: str = ",") -> "F.Column":
    """Comma-joined ids -> array<bigint>; bad pieces become null (no ANSI error)."""
    return F.transform(F.split(c, sep), lambda x: x.try_cast("bigint"))


def write_vectors(df: DataFrame, path: str) -> None:
    """Vector store as parquet ``(tag_id, ord, vector array<double>)``."""
    (df.select(F.col("tag_id").cast("bigint"), F.col("ord").cast("bigint"),
               F.col("vector").cast("array<double>"))
     .write.mode("overwrite").parquet(path))


def read_vectors(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.VECTORS).parquet(path)


def first_n_vectors(vectors: DataFrame, n: int) -> DataFrame:
    """The first ``n`` vectors of the store in insertion order (a pushed-down filter)."""
    return vectors.where(F.col("ord") < n)


def write_dictionary(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    df.select(F.col("tag_id").cast("bigint"), "tag_name").write.mode("overwrite").format(fmt).save(path)


def read_dictionary(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.schema(schemas.DICTIONARY).format(fmt).load(path)
