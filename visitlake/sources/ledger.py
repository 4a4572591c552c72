"""Which landed files have been processed already."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitlake.sources.landing import path_exists

LEDGER_SCHEMA = "path string, modificationTime timestamp, length bigint"


def list_files(spark: SparkSession, landing: str) -> DataFrame:
    """One row per landed file with its month. Only file status is read, not content."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").option("recursiveFileLookup", True)
            .load(landing).select("path", "modificationTime", "length")
            .withColumn("source_month", F.regexp_extract("path", r"source_month=([^/]+)/", 1)))


def new_files(spark: SparkSession, landing: str, ledger: str) -> DataFrame:
    """Files that are not in the ledger. A file rewritten in place has a new time or length and counts as new."""
    listing = list_files(spark, landing)
    if not path_exists(spark, ledger):
        return listing
    seen = spark.read.schema(LEDGER_SCHEMA).parquet(ledger)
    return listing.join(seen, ["path", "modificationTime", "length"], "left_anti")


def touched_months(files: DataFrame) -> list[str]:
    """Months that must be reprocessed: a month is always rebuilt from all its files. One short value per month."""
    return sorted(row["source_month"] for row in files.select("source_month").distinct().collect())


def mark_processed(files: DataFrame, ledger: str) -> None:
    """Advance the ledger. Called after all writes succeeded, so a failed run is repeated, never skipped."""
    files.select("path", "modificationTime", "length").write.mode("append").parquet(ledger)
