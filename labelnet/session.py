"""Session helpers: a local session for tests/bench, and the checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int = 8, shuffle_partitions: int = 8, app: str = "labelnet",
                  extra: dict | None = None) -> SparkSession:
    """Local session for tests and the bench (never used on a cluster)."""
    b = (SparkSession.builder.master(f"local[{cores}]").appName(app)
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.driver.memory", "8g")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.driver.bindAddress", "127.0.0.1")
         .config("spark.driver.host", "127.0.0.1")
         .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true"))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ship_package(spark)
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers (once per context).

    The pandas UDFs and grouped-map functions refer to ``labelnet`` modules;
    executors on a cluster (or workers started outside the repo folder)
    import them from this zip, distributed by Spark itself (``addPyFile``).
    """
    sc = spark.sparkContext
    key = sc.applicationId
    if key in _SHIPPED:
        return
    import os
    import shutil
    pkg = os.path.dirname(os.path.abspath(__file__))
    base = os.path.join(tempfile.mkdtemp(prefix="labelnet-pkg-"), "labelnet")
    archive = shutil.make_archive(base, "zip", root_dir=os.path.dirname(pkg), base_dir="labelnet")
    sc.addPyFile(archive)
    _SHIPPED.add(key)


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of this session.

    Order: the folder already set on the context, then ``spark.checkpoint.dir``
    from the session conf. Only a local-mode session (tests, bench) may fall
    back to a fresh scratch folder; on a cluster an unset folder is an error,
    because a machine-local folder would not survive losing that machine.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d
    conf = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if conf:
        sc.setCheckpointDir(conf)
        return sc.getCheckpointDir() or conf
    if not _is_local(spark):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS/object store) for graph loops")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="labelnet-ckpt-"))
    return sc.getCheckpointDir()


def cut(df: DataFrame, name: str = "cut") -> DataFrame:
    """Materialise ``df`` as a parquet table in the shared checkpoint folder and
    read it back: the lineage is cut, a lost executor does not lose the data,
    loops do not grow their plans, and AQE sees real sizes.

    (``DataFrame.checkpoint`` would compute the plan twice, once for the
    action and once more to write the RDD; the executor-local variant does
    not survive a lost executor.)
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back._cut_path = path
    return back


def discard(df: DataFrame | None) -> None:
    """Delete the table that ``cut`` wrote for ``df``, once nothing reads it any more (the state of a loop's
    last round but one). A frame that ``cut`` did not return is left alone."""
    path = getattr(df, "_cut_path", None)
    if path:
        spark = df.sparkSession
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for written tables."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex}"
