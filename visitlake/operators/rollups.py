"""Month roll-ups: small per-month partial results from which the whole-dataset tables are merged.

An increment recomputes the roll-ups of its own months only. Rebuilding products, calendar and summaries then reads a
few rows per month instead of the whole lake, and gives the same tables as computing them from all clicks and visits.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitlake import schemas as S
from visitlake.operators.gold import category_counts
from visitlake.operators.summaries import funnel_of_depths

DAY, DEPTH, ENTRY_PRODUCT, ORIGIN = "day", "depth", "entry product", "origin"


def product_months(clicks: DataFrame) -> DataFrame:
    """Clicks per month, product, category and attribute values, with the place of the first of them."""
    return category_counts(clicks, "click_month").select(S.PRODUCT_MONTHS_SCHEMA.fieldNames())


def click_days(clicks: DataFrame) -> DataFrame:
    return clicks.select("click_date", "click_month").distinct()


def visit_months(visits: DataFrame) -> DataFrame:
    """Visits, clicks and bounces of each month by day, by depth, by entry product and by origin, in one pass."""
    month, keys = "visit_month", ["visit_date", "deepest", "product_code", "country_code", "device_type_synthetic"]
    narrow = visits.select(
        month, "visit_date", F.least("deepest_page_reached", F.lit(S.SHOP_PAGES)).alias("deepest"),
        F.col("first_product_viewed").alias("product_code"), "country_code", "device_type_synthetic",
        "clicks_in_visit", F.col("bounced").cast("bigint").alias("bounce"))
    sets = {DAY: ["visit_date"], DEPTH: ["deepest"], ENTRY_PRODUCT: ["product_code"],
            ORIGIN: ["country_code", "device_type_synthetic"]}
    return (narrow.groupingSets([[month, *columns] for columns in sets.values()], month, *keys)
            .agg(_kind(sets).alias("kind"), F.count("*").alias("visits"),
                 F.sum("clicks_in_visit").alias("clicks"), F.sum("bounce").alias("bounced"))
            .select(S.VISIT_MONTHS_SCHEMA.fieldNames()))


def _kind(sets: dict[str, list[str]]) -> Column:
    """Which grouping a row belongs to: the one whose first column takes part in it."""
    kind = None
    for name, columns in sets.items():
        grouped = F.grouping(columns[0]) == 0
        kind = F.when(grouped, name) if kind is None else kind.when(grouped, name)
    return kind


def _of(rollup: DataFrame, kind: str) -> DataFrame:
    return rollup.filter(F.col("kind") == kind)


def _rate() -> Column:
    return F.round(F.sum("bounced").cast("double") / F.sum("visits"), 4)


def by_day(rollup: DataFrame) -> DataFrame:
    """Rows by day, in which every visit and every clean click is counted once."""
    return _of(rollup, DAY)


def mismatched_clicks(product_months: DataFrame, products: DataFrame) -> DataFrame:
    """Rows of the product roll-up whose category is not the product's."""
    known = products.select("product_code", F.col("category").alias("product_category"))
    return product_months.join(known, "product_code").filter("category <> product_category")


def daily_visits(rollup: DataFrame) -> DataFrame:
    return (_of(rollup, DAY).groupBy("visit_date")
            .agg(_rate().alias("bounce_rate"), F.sum("visits").alias("visits"), F.sum("clicks").alias("clicks"))
            .select("visit_date", "visits", "clicks", "bounce_rate").orderBy("visit_date"))


def visit_depth_funnel(rollup: DataFrame) -> DataFrame:
    return funnel_of_depths(_of(rollup, DEPTH).groupBy("deepest").agg(F.sum("visits").alias("visits")))


def bounce_rate_by_product(rollup: DataFrame) -> DataFrame:
    return (_of(rollup, ENTRY_PRODUCT).groupBy("product_code")
            .agg(F.sum("visits").alias("visits_started"), F.sum("bounced").alias("visits_bounced"),
                 _rate().alias("bounce_rate"))
            .orderBy(F.desc("visits_started"), "product_code"))


def visits_by_country_and_device(rollup: DataFrame, countries: DataFrame) -> DataFrame:
    counted = _of(rollup, ORIGIN).groupBy("country_code", "device_type_synthetic").agg(F.sum("visits").alias("visits"))
    return (counted.join(countries, "country_code")
            .select("country_code", "country_name", "device_type_synthetic", "visits")
            .orderBy(F.desc("visits"), "country_code", "device_type_synthetic"))
