"""Quality counts and findings, always as tables: nothing here collects rows to the driver."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitlake import schemas as S
from visitlake.session import staged

# Names of what a profile counts besides the values of columns.
DAY, REPEATS = "(day)", "(repeated rows)"
# Columns of which a profile combines the values before it lists them: those of a product, and others by themselves.
TOGETHER = [
    ["category_code", "product_code", "colour_code", "photo_position_code", "photo_angle_code", "price_usd",
     "price_above_category_average_code", "page_number_in_shop"],
    ["visit_id"], ["country_code"], ["click_number_in_visit"],
]


def category_mismatches(clicks: DataFrame, products: DataFrame) -> DataFrame:
    """Clicks whose category differs from their product's. Reported, not rejected."""
    of_product = products.select("product_code", F.col("category").alias("product_category"))
    return (clicks.select("click_id", "product_code", F.col("category").alias("click_category"))
            .join(of_product, "product_code")
            .filter("click_category != product_category")
            .select("click_id", "product_code", "click_category", "product_category"))


def rejections_by_reason(rejected: DataFrame) -> DataFrame:
    return (rejected.groupBy("rejection_reason").agg(F.count("*").alias("rejected"))
            .orderBy(F.desc("rejected"), "rejection_reason"))


def rows_by_month(frame: DataFrame, month_column: str, name: str = "row_count") -> DataFrame:
    return frame.groupBy(month_column).agg(F.count("*").alias(name)).orderBy(month_column)


def null_share_by_month(frame: DataFrame, column: str, month_column: str = "click_month") -> DataFrame:
    """Share of rows per month with no value in the column: 1.0 for every row, 0.0 for none."""
    return (frame.groupBy(month_column)
            .agg(F.avg(F.col(column).isNull().cast("double")).alias("null_share")).orderBy(month_column))


def metric(frame: DataFrame, **values: Column) -> DataFrame:
    """One pass over a frame, one ``metric, value`` row per named aggregate."""
    totals = frame.agg(*[F.coalesce(value, F.lit(0)).cast("bigint").alias(name) for name, value in values.items()])
    return totals.unpivot([], list(values), "metric", "value")


def quality_counts(source: DataFrame, bronze: DataFrame, duplicates_removed: DataFrame, rejected: DataFrame,
                   clicks: DataFrame, visits: DataFrame, mismatches: DataFrame) -> DataFrame:
    """The reconciliation counts of a run as ``metric, value`` rows."""
    count = F.count("*")
    parts = [
        metric(source, source_rows=count),
        metric(bronze, bronze_rows=count),
        metric(duplicates_removed, duplicates_removed=F.sum("duplicates_removed")),
        metric(rejected, rejected_rows=count),
        metric(clicks, silver_clicks=count),
        metric(visits, visits=count, one_click_visits=F.count_if("bounced")),
        metric(mismatches, category_mismatches=count),
    ]
    return reduce(DataFrame.unionByName, parts)


def value_counts(clicks: DataFrame, month: Column | None = None) -> DataFrame:
    """What a profile is made of: ``column, item, rows`` of a plain click table, and ``source_month`` if it is given.

    One row per column and value with its rows, and under names of their own one per day and one with the number of
    repeated rows. Equal rows lie in one month, so counts of months are merged by summing their rows. Columns that hang
    together are combined before they are listed: a visit, a date, a product or a click number that fills the table costs one
    row per task, and what is listed is a few values of each combination, not of each click.
    """
    names = [name for name in S.PLAIN_COLUMNS if name in clicks.columns]
    keys = [] if month is None else ["source_month"]
    with_month = clicks if month is None else clicks.withColumn("source_month", month)
    day = F.to_json(F.struct(F.array("year", "month", "day").alias("day")))

    def listed(some: list[str], *more: Column) -> DataFrame:
        counted = with_month.groupBy(*keys, *some).agg(F.count("*").alias("copies"))
        texts = counted.select(*keys, "copies", *more, *[F.col(name).cast("string").alias(name) for name in some])
        return texts.unpivot([*keys, "copies"], texts.columns[len(keys) + 1:], "column", "item")

    # A column that is counted by itself has each of its values once: visits, most of the items, are not merged again.
    found = [some for some in ([name for name in names if name in together] for together in TOGETHER) if some]
    parts = [listed(["year", "month", "day"], day.alias(DAY)), *[listed(some) for some in found if len(some) > 1]]
    merged = reduce(DataFrame.unionByName, parts).groupBy(*keys, "column", "item").agg(F.sum("copies").alias("rows"))
    alone = [listed(some).select(*keys, "column", "item", F.col("copies").alias("rows")) for some in found if len(some) == 1]
    values = reduce(DataFrame.unionByName, alone, merged)
    rows = with_month.groupBy(*keys, *names).agg(F.count("*").alias("copies"))
    repeats = rows.groupBy(*keys).agg(F.sum(F.col("copies") - 1).alias("rows")).select(
        *keys, F.lit(REPEATS).alias("column"), F.lit(None).cast("string").alias("item"), "rows")
    return values.unionByName(repeats)


def merged_profile(counts: DataFrame) -> DataFrame:
    """The profile of all rows that the counts stand for, as ``metric, value`` rows: sizes, missing values, repeats, visits,
    distinct values. Values are double, as a median may lie between two counts."""
    # Visits are most of the items: merged once, not for each of the parts below.
    merged = staged(counts.groupBy("column", "item").agg(F.sum("rows").alias("rows")), "merged-profile")
    values = merged.filter(~F.col("column").isin(DAY, REPEATS))
    of_column = values.groupBy("column").agg(
        F.count("item").alias("distinct"), F.sum("rows").alias("rows"),
        F.sum(F.when(F.col("item").isNull(), F.col("rows")).otherwise(0)).alias("nulls"))
    distinct = of_column.select(F.concat(F.lit("distinct_"), "column").alias("metric"), F.col("distinct").alias("value"))
    sizes = metric(of_column, rows=F.max("rows"), nulls=F.sum("nulls"))
    repeats = metric(merged.filter(F.col("column") == REPEATS), duplicate_rows=F.sum("rows"))
    lengths = (values.filter((F.col("column") == "visit_id") & F.col("item").isNotNull())
               .groupBy(F.col("rows").alias("clicks")).agg(F.count("*").alias("visits")))
    visits = metric(lengths, visits=F.sum("visits"), longest_visit=F.max("clicks"),
                    one_click_visits=F.sum(F.when(F.col("clicks") == 1, F.col("visits"))))
    median = lengths.agg(F.percentile("clicks", 0.5, F.col("visits")).alias("value")).select(
        F.lit("median_visit").alias("metric"), F.coalesce("value", F.lit(0.0)).alias("value"))
    days = metric(merged.filter(F.col("column") == DAY), days=F.count("*"))
    counted = reduce(DataFrame.unionByName, [sizes, repeats, visits, days, distinct])
    return counted.withColumn("value", F.col("value").cast("double")).unionByName(median)


def dataset_profile(clicks: DataFrame) -> DataFrame:
    """Profile of a plain click table as ``metric, value`` rows."""
    return merged_profile(value_counts(staged(clicks, "profiled")))


def constancy_violations(clicks: DataFrame) -> DataFrame:
    """Keys whose attribute takes more than one value: country per visit, six attributes per product.

    Distinct (key, value) pairs come first, so a key with many rows is spread before it is counted.
    """
    def varying(key: str, columns: list[str]) -> DataFrame:
        pairs = clicks.filter(F.col(key).isNotNull()).select(
            F.lit(key).alias("key_name"), F.col(key).cast("string").alias("key"),
            *[F.col(name).cast("string").alias(name) for name in columns])
        return pairs.unpivot(["key_name", "key"], columns, "attribute", "item")

    product = ["colour_code", "price_usd", "price_above_category_average_code", "photo_position_code",
               "photo_angle_code", "page_number_in_shop"]
    long = varying("visit_id", ["country_code"]).unionByName(varying("product_code", product))
    return (long.filter("item IS NOT NULL").distinct()
            .groupBy("key_name", "key", "attribute").agg(F.count("*").alias("distinct_values"))
            .filter("distinct_values > 1"))
