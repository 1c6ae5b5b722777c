"""Tag usage over time as a stream of mergeable counts.

Events arrive as parquet files, in any order of their times. Each micro-batch
is counted per ``(window, tag)`` and written under its batch id in the shared
folder; counts add up, so the sum over the batches is the batch query's
``usage_trend`` whatever the order, no event is ever too late, and no state is
kept. A batch that is run again replaces its own counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelnet.session import scratch_path
from labelnet.sources.io import table_glob

EVENTS = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()), T.StructField("props", T.StringType()),
])


def batch_counts(events: DataFrame, every: str = "1 day") -> DataFrame:
    """``(window_start, tag, n)`` of one batch. Windows are cut on the wall clock (``timestamp_ntz``): no session zone matters."""
    g = events.groupBy(F.window("ts", every).alias("w"), F.col("event_type").alias("tag")).agg(F.count(F.lit(1)).alias("n"))
    return g.select(F.col("w.start").alias("window_start"), "tag", "n")


def run_usage_stream(spark: SparkSession, source_dir: str, file_glob: str = "events*.parquet",
                     every: str = "1 day", max_files: int = 1, out: str | None = None, checkpoint: str | None = None) -> str:
    """Run the stream over the files present now (availableNow) and return the output folder."""
    out = out or scratch_path(spark, "usage-stream-out")
    checkpoint = checkpoint or scratch_path(spark, "usage-stream-ckpt")
    src = (spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", max_files)
           .parquet(table_glob(source_dir, file_glob)))

    def sink(batch: DataFrame, batch_id: int) -> None:
        batch_counts(batch, every).write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    sink(spark.createDataFrame([], EVENTS), -1)      # a stream without any file gives no rows, not no table
    q = (src.writeStream.option("checkpointLocation", checkpoint).foreachBatch(sink)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return out


def latest_counts(spark: SparkSession, out: str) -> DataFrame:
    """Current count per ``(window_start, tag)``: the sum over the batches."""
    return spark.read.parquet(out).groupBy("window_start", "tag").agg(F.sum("n").alias("n"))
