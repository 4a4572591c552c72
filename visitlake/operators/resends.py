"""Resent clicks: keep the earliest copy of each click."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

IDENTITY = ["click_id", "visit_id", "click_number_in_visit"]


def has_identity():
    """Rows that can be told apart. Rows with a missing part are never treated as copies of each other."""
    known = F.lit(True)
    for name in IDENTITY:
        known = known & F.col(name).isNotNull()
    return known


def keep_earliest(bronze: DataFrame) -> DataFrame:
    """One row per click: the earliest received, equal times decided by the row's content.

    A click id is made of its visit and click number; these two sort much faster than the text. Filtering on the first
    row number lets Spark drop later copies on the map side, before the shuffle, so a click resent millions of times
    does not fill one task.
    """
    content = F.xxhash64(*[name for name in bronze.columns if not name.startswith("_")])
    earliest = Window.partitionBy("visit_id", "click_number_in_visit").orderBy("received_time", content)
    return (bronze.filter(has_identity())
            .withColumn("_copy", F.row_number().over(earliest))
            .filter(F.col("_copy") == 1).drop("_copy"))


def without_identity(bronze: DataFrame) -> DataFrame:
    return bronze.filter(~has_identity())


def remove_resends(bronze: DataFrame) -> DataFrame:
    """All rows that Silver has to judge: one copy per click, and every row without a full identity."""
    return keep_earliest(bronze).unionByName(without_identity(bronze))


def count_resends(bronze: DataFrame) -> DataFrame:
    """One row: ``duplicates_removed``."""
    copies = bronze.filter(has_identity()).groupBy("visit_id", "click_number_in_visit").agg(F.count("*").alias("copies"))
    return copies.agg(F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("duplicates_removed"))
