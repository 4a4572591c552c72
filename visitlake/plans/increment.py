"""One increment: raw rows of whole months to Bronze, Silver and Gold frames."""

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitlake import schemas as S
from visitlake.functions import source_month
from visitlake.operators import rollups
from visitlake.operators.gold import build_calendar_days, build_gold_clicks, build_visits, products_from_counts
from visitlake.operators.silver import Silver, build_silver
from visitlake.operators.synthetic import add_synthetic_fields
from visitlake.session import staged
from visitlake.sources.raw_clicks import add_arrival, to_plain_columns
from visitlake.sources.reference import build_countries, build_devices


@dataclass(frozen=True)
class Increment:
    source: DataFrame
    bronze: DataFrame
    source_months: DataFrame
    silver: Silver
    gold_clicks: DataFrame
    visits: DataFrame
    bronze_rows: int


def source_months(source: DataFrame) -> DataFrame:
    """Months present in plain source rows, one row each."""
    return source.select(source_month().alias("source_month")).distinct()


def build_bronze(source: DataFrame, received_time: datetime, seed: int = S.DEFAULT_SEED) -> DataFrame:
    return add_arrival(add_synthetic_fields(source, seed), received_time)


def build_increment(raw: DataFrame, received_time: datetime, run_time: datetime | None = None,
                    seed: int = S.DEFAULT_SEED, erased: DataFrame | None = None) -> Increment:
    """Frames of every layer for the months of the raw rows. A landing month in the raw rows is carried along, and a row of
    another month is rejected. Rows of erased visits go no further than Bronze."""
    return increment_of(staged_source(raw), received_time, run_time, seed, erased)


def staged_source(raw: DataFrame) -> DataFrame:
    """Raw rows under plain names, with their landing month if they have one. Click files are parsed for this write only."""
    return staged(to_plain_columns(raw, keep=("source_month",) if "source_month" in raw.columns else ()), "source")


def increment_of(source: DataFrame, received_time: datetime, run_time: datetime | None = None,
                 seed: int = S.DEFAULT_SEED, erased: DataFrame | None = None) -> Increment:
    """The same of staged source rows (see ``staged_source``). Bronze has one row for each of them, so they are what is counted;
    Silver's judged rows are staged from Bronze in one go, as Bronze lies by click already when resends are removed."""
    bronze = build_bronze(source, received_time, seed)
    silver = build_silver(bronze, run_time or received_time, erased=erased)
    return Increment(source, bronze, source_months(source), silver,
                     build_gold_clicks(silver.clicks), build_visits(silver.clicks), source.count())


def build_whole_dataset(spark: SparkSession, product_months: DataFrame, click_days: DataFrame,
                        visit_months: DataFrame) -> dict[str, DataFrame]:
    """Tables that depend on every month, by their name below the Gold folder, merged from the month roll-ups."""
    countries = build_countries(spark)
    return {
        "products": products_from_counts(product_months),
        "countries": countries,
        "calendar_days": build_calendar_days(click_days),
        "devices": build_devices(spark),
        "summaries/daily_visits": rollups.daily_visits(visit_months),
        "summaries/visit_depth_funnel": rollups.visit_depth_funnel(visit_months),
        "summaries/bounce_rate_by_product": rollups.bounce_rate_by_product(visit_months),
        "summaries/visits_by_country_and_device": rollups.visits_by_country_and_device(visit_months, countries),
    }


def month_filter(frame: DataFrame, month_column: str, months: list[str]) -> DataFrame:
    """Rows of some months. On a month-partitioned table this prunes partitions."""
    return frame.filter(F.col(month_column).isin(months))
