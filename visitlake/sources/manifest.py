"""What data files a table has, before and after an operation."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

UNCHANGED, CHANGED, ADDED, REMOVED = "unchanged", "changed", "added", "removed"


def file_manifest(frame: DataFrame, *columns: str) -> DataFrame:
    """One row per data file behind a scan that has rows: path, size, modification time, ``record_count``, and the given columns,
    which must be constant in a file (partition columns). Filter the frame by month first to prune partitions."""
    file = [F.col(f"_metadata.{name}").alias(name) for name in ("file_path", "file_size", "file_modification_time")]
    return frame.groupBy(*columns, *file).agg(F.count("*").alias("record_count"))


def manifest_difference(before: DataFrame, after: DataFrame, *columns: str) -> DataFrame:
    """One row per file of either side, by path: the given columns, ``status``, and ``record_count`` (after, else before).

    A file is changed if its size, its time or its number of rows is another one.
    """
    facts = ["file_size", "file_modification_time", "record_count"]
    left = before.select("file_path", F.struct(*columns, *facts).alias("old"))
    right = after.select("file_path", F.struct(*columns, *facts).alias("new"))
    same = F.col("old").eqNullSafe(F.col("new"))
    status = (F.when(F.col("old").isNull(), ADDED).when(F.col("new").isNull(), REMOVED).when(same, UNCHANGED).otherwise(CHANGED))
    known = F.coalesce("new", "old")
    return left.join(right, "file_path", "full_outer").select(
        "file_path", *[known[name].alias(name) for name in columns], status.alias("status"), known["record_count"].alias("record_count"))


def files_with_status(difference: DataFrame, *statuses: str) -> DataFrame:
    """One row with ``value``: files of the given statuses; no fact (a missing value) if no side has any file."""
    wanted = F.count_if(F.col("status").isin(*statuses))
    return difference.agg(F.when(F.count("*") > 0, wanted).alias("value"))


def order_in_files(frame: DataFrame, key: list[str | Column], *columns: str) -> DataFrame:
    """How the rows of each file are ordered: the given columns, ``rows``, and ``inversions``, rows with a smaller key than the row
    before them in their file. Rows are compared by their index in the file, within row ranges whose ends meet."""
    size = 1 << 16
    place = frame.select(*columns, F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("place"),
                         F.struct(*key).alias("key"))
    # The last row of a range is also the row before the next range.
    chunk = F.floor(F.col("place") / size)
    ends = F.col("place") % size == size - 1
    handed = place.withColumn("chunk", F.explode(F.when(ends, F.array(chunk, chunk + 1)).otherwise(F.array(chunk))))
    before = F.lag("key").over(Window.partitionBy("file", "chunk").orderBy("place"))
    return (handed.withColumn("inverted", F.coalesce(F.col("key") < before, F.lit(False))).filter(F.col("chunk") == chunk)
            .groupBy(*columns).agg(F.count("*").alias("rows"), F.count_if("inverted").alias("inversions")))
