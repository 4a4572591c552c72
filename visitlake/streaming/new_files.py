"""Append-only variant of the incremental run: a file stream that handles each landed file once and then stops."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from visitlake import schemas as S


def stream_raw_clicks(spark: SparkSession, landing: str, files_per_batch: int | None = None) -> DataFrame:
    """Landed files as a stream of raw rows. Which files were handled is kept in the query's checkpoint.

    A file rewritten in place is not seen again; use ``run_new_files`` where landed months are rewritten.
    """
    schema = T.StructType(S.RAW_SCHEMA.fields + [T.StructField("source_month", T.StringType(), True)])
    reader = (spark.readStream.schema(schema).option("sep", S.SOURCE_SEPARATOR).option("header", True)
              .option("pathGlobFilter", "*.csv"))
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.csv(landing)


def process_available(stream: DataFrame, checkpoint: str, handle: Callable[[DataFrame, int], None]) -> None:
    """Hand every file that is there now to ``handle`` in batches, then stop. A batch may repeat after a failure."""
    query = (stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()
