"""Suggest tags for posts as they arrive.

The fitted vocabulary and the tag vectors are a static side; each
micro-batch of new posts is cleaned, weighted with the fitted idf and
scored against the inverted index of the tag vectors (the same code as
the batch ``post_tags``), and its top-k rows are written under its batch id in
the shared folder (a repeated batch replaces itself). Scoring one post does not depend on any other post, so
the union of the batches equals the batch result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelnet.plans import flows as pl
from labelnet.session import scratch_path
from labelnet.sources.io import table_glob

CONVERSATIONS = T.StructType([
    T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()),
    T.StructField("role", T.StringType()), T.StructField("text", T.StringType()),
])


def run_tagging_stream(spark: SparkSession, source_dir: str, lv: pl.LabelVectors, k: int = 20,
                       file_glob: str = "conversations*.parquet", max_files: int = 1) -> str:
    out = scratch_path(spark, "tagging-stream-out")
    ckpt = scratch_path(spark, "tagging-stream-ckpt")
    model = pl.tagging_model(lv)
    src = (spark.readStream.schema(CONVERSATIONS).option("maxFilesPerTrigger", max_files)
           .parquet(table_glob(source_dir, file_glob)))

    def user_posts(turns: DataFrame) -> DataFrame:
        return turns.where(F.col("role") == "user").select("conv_id", "turn", F.col("text").alias("body"))
    posts = user_posts(src)

    def sink(batch: DataFrame, batch_id: int) -> None:
        # a batch that is run again overwrites its own folder
        pl.suggest_tags(batch, ["conv_id", "turn"], model, k).select("conv_id", "turn", "rank", "tag_id", "sim").write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    sink(user_posts(spark.createDataFrame([], CONVERSATIONS)), -1)      # a stream without any file gives no rows, not no table
    q = (posts.writeStream.option("checkpointLocation", ckpt).foreachBatch(sink)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return out
