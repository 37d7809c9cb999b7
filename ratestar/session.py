"""Session settings and the one place where lineage is cut."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Splits a hot join key over many tasks; every star join here is inner or
    # left outer with the fact on the left, which is the side that may be split.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # Checkpoint files go when the frames that read them are gone.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.checkpoint.compress": "true",
}

#: Bytes; spark.sql.defaultSizeInBytes unless it is set.
LARGEST_ESTIMATE = 2 ** 63 - 1


def build_session(master: str | None = None, name: str = "ratestar", **settings: str) -> SparkSession:
    """A session with the settings above.

    Pass ``spark_sql_shuffle_partitions="8"`` style keywords to add settings.
    On a cluster leave the broadcast threshold at its default: it is the size
    check that decides which dimension tables are broadcast.
    """
    builder = SparkSession.builder.appName(name)
    if master is not None:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in settings.items():
        builder = builder.config(key.replace("_", "."), value)
    return builder.getOrCreate()


def checkpoint_folder(spark: SparkSession) -> str:
    """The folder shared by all executors, as named in ``spark.checkpoint.dir``."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError("name a folder shared by all executors in spark.checkpoint.dir")
    folder = tempfile.mkdtemp(prefix="ratestar-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder in the checkpoint folder, which goes with its files when the application ends."""
    folder = f"{checkpoint_folder(spark)}/{name}-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(path)
    files.deleteOnExit(path)
    return folder


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the checkpoint folder and go on from the files.

    Unlike a cached frame the result survives the loss of executors, and it is
    the same on every read, which a range-partitioned frame is not: its bounds
    are sampled anew each time it runs.

    Spark keeps its estimate of the size with the written frame, and that of a
    join is the product of both sides. Frames made of each other in turns would
    square it each time, until the numbers alone fill the driver. From 8 EB on,
    Spark's own figure for an unknown size, it counts as unknown.
    """
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(checkpoint_folder(spark))
    written = df.checkpoint()
    plan = written._jdf.queryExecution().logical()
    if plan.stats().sizeInBytes() < LARGEST_ESTIMATE:
        return written
    jvm, session = spark._jvm, spark._jsparkSession
    unknown = jvm.org.apache.spark.sql.execution.LogicalRDD(
        plan.output(), plan.rdd(), plan.outputPartitioning(), plan.outputOrdering(), False, plan.stream(), session,
        jvm.scala.Option.empty(), jvm.scala.Option.apply(plan.constraints()))
    return DataFrame(jvm.org.apache.spark.sql.classic.Dataset.ofRows(session, unknown), spark)


def collect_garbage(spark: SparkSession) -> None:
    """Let go of frames, shuffles and checkpoint files that nothing refers to any more.

    Spark does so when the driver's collector happens to come by, which lets the
    heap grow to its limit first. Loops of many small jobs call this each time.
    """
    spark._jvm.System.gc()
