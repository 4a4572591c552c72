"""Click rows from an event table: a visit is one user on one shop-local day.

Defects are injected by remainders of the ids, so that every quality rule that can fail does fail somewhere. Months are
spread by moving a user's days.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitlake import schemas as S
from visitlake.functions import click_id, shop_local_time
from visitlake.operators.sequence import with_position
from visitlake.operators.synthetic import device
from visitlake.sources.raw_clicks import append_resends

RECEIVED_TEXT = "2024-07-01 12:00:00"
RESEND_EVERY = 100


def event_clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plain source columns plus ``event_id`` and ``click_time``."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "ts", "user_id", "props")
    shift = F.col("user_id") % 5 * 31
    placed = events.select(
        "event_id", "user_id", F.col("ts").cast("timestamp").alias("ts"),
        F.get_json_object("props", "$.k").cast("bigint").alias("k")).withColumn(
        "day0", F.to_date(shop_local_time("ts")))
    ranked = with_position(placed, ["user_id", "day0"], F.lit(0), ["ts", "event_id"]).withColumns({
        "visit_id": F.col("user_id") * 100 + F.dayofmonth("day0"),
        "date": F.date_add("day0", shift.cast("int")),
        "click_time": F.timestamp_add("DAY", shift.cast("int"), F.col("ts")),
    })
    every = lambda n: F.col("event_id") % n == 0
    k, position = F.col("k"), F.col("position")
    number = (F.when(F.col("visit_id") % 59 == 0, F.col("group_rows") + 1 - position)
              .when((F.col("visit_id") % 53 == 0) & (position >= 2), position + 1)
              .otherwise(position))
    return ranked.select(
        "event_id",
        F.year("date").cast("bigint").alias("year"),
        F.when(every(401), 13).otherwise(F.month("date")).cast("bigint").alias("month"),
        F.when(every(419), 31).otherwise(F.dayofmonth("date")).cast("bigint").alias("day"),
        number.cast("bigint").alias("click_number_in_visit"),
        F.when(every(211), 99).otherwise(F.col("user_id") % 47 + 1).cast("bigint").alias("country_code"),
        "visit_id",
        F.when(every(499), (k + 1) % 4 + 1).otherwise(k % 4 + 1).alias("category_code"),
        F.when(~every(307), F.concat(F.lit("P"), F.lpad(k.cast("string"), 2, "0"))).alias("product_code"),
        F.when(every(503), 15).otherwise(k % 14 + 1).cast("bigint").alias("colour_code"),
        (k % 6 + 1).alias("photo_position_code"),
        (k % 2 + 1).alias("photo_angle_code"),
        (k * 7 % 73 + 10).alias("price_usd"),
        F.when(k >= 50, 1).otherwise(2).cast("bigint").alias("price_above_category_average_code"),
        (k % 5 + 1).alias("page_number_in_shop"),
        "click_time")


def plain_clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 14 plain source columns."""
    return event_clicks(spark, sf_dir).select(S.PLAIN_COLUMNS)


def raw_text_clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows as the raw file holds them: source column names, all text."""
    plain = plain_clicks(spark, sf_dir)
    return plain.select([F.col(name).cast("string").alias(source) for source, name in S.SOURCE_TO_PLAIN.items()])


def bronze_clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze rows with the event time as click time, and every hundredth event received again a second later."""
    bronze = event_clicks(spark, sf_dir).withColumns({
        "click_id": click_id(),
        "click_time_synthetic": F.col("click_time"),
        "device_type_synthetic": device(S.DEFAULT_SEED),
        "received_time": F.lit(RECEIVED_TEXT).cast("timestamp"),
        "data_source": F.lit(S.DATA_SOURCE),
    })
    return append_resends(bronze, F.col("event_id") % RESEND_EVERY == 0).select(*S.BRONZE_COLUMNS)
