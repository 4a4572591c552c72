"""Visits that were erased on request and must not come back."""

from pyspark.sql import DataFrame


def deleted_visit_ids(deleted_visits: DataFrame) -> DataFrame:
    return deleted_visits.select("visit_id").distinct()


def remove_deleted_visits(frame: DataFrame, deleted: DataFrame) -> DataFrame:
    """Rows of all other visits. Spark decides at run time whether the list is small enough to broadcast."""
    return frame.join(deleted, "visit_id", "left_anti").select(frame.columns)
