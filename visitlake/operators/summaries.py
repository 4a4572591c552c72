"""The four dashboard summaries, computed on doubles and whole numbers so that every engine rounds the same way."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitlake import schemas as S

SUMMARY_NAMES = ["daily_visits", "visit_depth_funnel", "bounce_rate_by_product", "visits_by_country_and_device"]


def bounces() -> Column:
    return F.sum(F.col("bounced").cast("bigint"))


def bounce_rate() -> Column:
    return F.round(bounces().cast("double") / F.count("*"), 4)


def daily_visits(visits: DataFrame) -> DataFrame:
    return (visits.groupBy("visit_date")
            .agg(F.count("*").alias("visits"), F.sum("clicks_in_visit").alias("clicks"),
                 bounce_rate().alias("bounce_rate"))
            .orderBy("visit_date"))


def funnel_of_depths(counted: DataFrame) -> DataFrame:
    """Funnel from ``deepest, visits`` counts. Each count belongs to every page up to its depth; all pages are listed."""
    pages = counted.sparkSession.range(1, S.SHOP_PAGES + 1).withColumnRenamed("id", "shop_page")
    up_to = F.sequence(F.lit(1).cast("bigint"), F.col("deepest"))
    reached = (counted.filter("deepest >= 1").select("visits", F.explode(up_to).alias("shop_page"))
               .groupBy("shop_page").agg(F.sum("visits").alias("visits")))
    return (pages.join(reached, "shop_page", "left")
            .select("shop_page", F.coalesce("visits", F.lit(0)).alias("visits_reaching_page")).orderBy("shop_page"))


def visit_depth_funnel(visits: DataFrame) -> DataFrame:
    """Visits that reached at least each shop page. Counted per depth first, so no visit is paired with a page."""
    depth = F.least("deepest_page_reached", F.lit(S.SHOP_PAGES)).alias("deepest")
    return funnel_of_depths(visits.groupBy(depth).agg(F.count("visit_id").alias("visits")))


def bounce_rate_by_product(visits: DataFrame) -> DataFrame:
    return (visits.groupBy(F.col("first_product_viewed").alias("product_code"))
            .agg(F.count("*").alias("visits_started"), bounces().alias("visits_bounced"),
                 bounce_rate().alias("bounce_rate"))
            .orderBy(F.desc("visits_started"), "product_code"))


def visits_by_country_and_device(visits: DataFrame, countries: DataFrame) -> DataFrame:
    """Counted before the join: the join then sees one row per country and device instead of every visit."""
    counted = visits.groupBy("country_code", "device_type_synthetic").agg(F.count("*").alias("visits"))
    return (counted.join(countries, "country_code")
            .select("country_code", "country_name", "device_type_synthetic", "visits")
            .orderBy(F.desc("visits"), "country_code", "device_type_synthetic"))


def standard_types(frame: DataFrame) -> DataFrame:
    """Decimals and floats as double, small whole numbers as bigint."""
    targets = {"float": "double", "int": "bigint", "smallint": "bigint", "tinyint": "bigint"}
    return frame.select([
        F.col(name).cast("double" if kind.startswith("decimal") else targets.get(kind, kind)).alias(name)
        for name, kind in frame.dtypes])


def run_summaries(visits: DataFrame, countries: DataFrame) -> dict[str, DataFrame]:
    frames = {
        "daily_visits": daily_visits(visits),
        "visit_depth_funnel": visit_depth_funnel(visits),
        "bounce_rate_by_product": bounce_rate_by_product(visits),
        "visits_by_country_and_device": visits_by_country_and_device(visits, countries),
    }
    return {name: standard_types(frames[name]) for name in SUMMARY_NAMES}


def run_summary_sql(tables: dict[str, DataFrame], texts: dict[str, str]) -> dict[str, DataFrame]:
    """Run the caller's own summary SQL over named frames, with the same output types."""
    if not tables:
        return {}
    spark = next(iter(tables.values())).sparkSession
    for name, frame in tables.items():
        frame.createOrReplaceTempView(name)
    return {name: standard_types(spark.sql(text)) for name, text in texts.items()}
