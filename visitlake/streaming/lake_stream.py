"""Lake runs driven by a file stream: each batch of landed files is one run."""

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitlake import schemas as S
from visitlake.plans.journal import Journal
from visitlake.plans.lake import Lake, run_increment
from visitlake.session import run_scratch, staged
from visitlake.sources.ledger import list_files, mark_processed
from visitlake.sources.raw_clicks import read_raw_clicks
from visitlake.streaming.new_files import process_available, stream_raw_clicks


def run_stream(spark: SparkSession, lake: Lake, checkpoint: str, run_time: datetime, files_per_batch: int | None = None,
               seed: int = S.DEFAULT_SEED) -> None:
    """Process every landed file that the stream has not seen, then stop.

    A batch may hold a part of a month only, so its run reads the batch's months whole. The batch's number and files are
    the key of its run in the lake's journal: a batch that is handed over again after a failure goes on behind the last
    finished step of its run, and changes nothing if that run has ended. Its files are marked in the ledger as well.
    """
    rows = stream_raw_clicks(spark, lake.landing, files_per_batch).select(
        "source_month", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_modification_time").alias("time"))
    process_available(rows, checkpoint, lambda batch, number: run_batch(batch, number, lake, run_time, seed))


def run_batch(batch: DataFrame, number: int, lake: Lake, run_time: datetime, seed: int = S.DEFAULT_SEED) -> None:
    """One batch of ``source_month``, ``path``, ``time`` rows as a lake run."""
    spark = batch.sparkSession
    with run_scratch(spark):
        files = staged(batch.distinct(), "batch-files")
        months = sorted(row[0] for row in files.select("source_month").distinct().collect())
        if not months:
            return
        key = files.agg(F.hex(F.bit_xor(F.xxhash64("path", "time"))), F.count("*")).first()
        journal = Journal(spark, lake.journal, f"batch-{number}-{key[0]}-{key[1]}")
        if journal.facts("ledger") is not None:
            return
        read = staged(list_files(spark, lake.landing).filter(F.col("source_month").isin(months)), "read-files")
        run_increment(spark, read_raw_clicks(spark, lake.landing, months), lake, run_time, months, seed, journal)
        mark_processed(read, lake.ledger)
        journal.finish("ledger", {})
