"""Reconciliation: expected against actual counts, release checks, and the pick of one clean visit."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def reconcile(expected: DataFrame, actual: DataFrame, key: str, value: str) -> DataFrame:
    """One row per key of either side. A key present on one side only is a mismatch."""
    left = expected.select(key, F.col(value).alias("expected"))
    right = actual.select(key, F.col(value).alias("actual"))
    return (left.join(right, key, "full_outer")
            .withColumn("matches", F.col("expected").eqNullSafe(F.col("actual"))))


def mismatched_rows(frame: DataFrame, value: Column, rule: Column) -> DataFrame:
    """One row: how many rows carry a value that differs from the rule (a NULL value differs)."""
    return frame.agg(F.count_if(~value.eqNullSafe(rule)).alias("mismatched_rows"),
                     F.count("*").alias("rows_checked"))


def rows_of_visits(visits: DataFrame, **tables: DataFrame) -> DataFrame:
    """Rows of the given visits in each named table: ``table_name, row_count``. Every table is listed."""
    counted = [table.join(visits.select("visit_id").distinct(), "visit_id", "left_semi")
               .agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
               for name, table in tables.items()]
    return reduce(DataFrame.unionByName, counted)


def pick_visit(clicks: DataFrame, seed: int, excluded_month: str) -> DataFrame:
    """One clean visit outside a month, the same one for the same seed. Each task keeps only its best candidate."""
    order = F.md5(F.concat_ws("|", F.lit(str(seed)), F.col("visit_id").cast("string")))
    return (clicks.filter(F.col("click_month") != excluded_month)
            .select("visit_id", "click_month", order.alias("order"))
            .orderBy("order", "click_month").limit(1)
            .select("visit_id", "click_month"))


def check(name: str, expected: Column, actual: DataFrame) -> DataFrame:
    """One release check. ``actual`` has at most one row with column ``value``; no row means the fact is missing."""
    fact = actual.select(F.col("value").cast("string").alias("value"))
    wanted = expected.cast("string")
    found = fact.agg(F.max("value").alias("actual"))
    return found.select(F.lit(name).alias("check"), wanted.alias("expected"), "actual",
                        F.coalesce(wanted == F.col("actual"), F.lit(False)).alias("pass"))


def check_counts(name: str, expected: DataFrame, actual: DataFrame, key: str, value: str) -> DataFrame:
    """A check that all per-key counts agree: expected 0 mismatching keys. Nothing on either side fails."""
    compared = reconcile(expected, actual, key, value)
    bad = compared.agg(F.when(F.count("*") > 0, F.count_if(~F.col("matches"))).alias("value"))
    return check(name, F.lit(0), bad)


def all_checks(checks: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, checks)
