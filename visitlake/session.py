"""Session settings every job relies on, and the shared scratch folder."""

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    # Results depend on these.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    # Speed at scale depends on these: runtime broadcast choice, skewed joins and skewed writes split.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder on the storage shared by all executors.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session, where driver and executors are one
    process, may fall back to the machine's temporary folder.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that every executor can reach")
        shared = _local_fallback()
    below = _run_folders[-1] if _run_folders else f"{shared.rstrip('/')}/visitlake"
    return f"{below}/{name}-{uuid.uuid4().hex}"


_local_folder = None
_run_folders: list[str] = []


@contextmanager
def run_scratch(spark: SparkSession):
    """Scratch folders asked for inside lie in one folder, which is removed at the end, also after a failure.

    No frame that reads from it may be used afterwards.
    """
    folder = scratch_folder(spark, "run")
    _run_folders.append(folder)
    try:
        yield folder
    finally:
        _run_folders.remove(folder)
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def _local_fallback() -> str:
    global _local_folder
    if _local_folder is None:
        _local_folder = tempfile.mkdtemp(prefix="visitlake-")
    return _local_folder


def shuffled(frame: DataFrame) -> DataFrame:
    """The frame, for a join that shuffles both sides whatever their sizes.

    Spark sizes exploded rows as if none were added, and stored rows by their compressed files, so it may take millions of rows
    for a few megabytes and build a broadcast of them on the driver.
    """
    return frame.hint("merge")


def staged(frame: DataFrame, name: str) -> DataFrame:
    """Write a frame to the scratch folder and read it back: computed once, and safe when executors are lost."""
    path = scratch_folder(frame.sparkSession, name)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)
