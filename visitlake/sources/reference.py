"""Reference tables that come from the code tables."""

from pyspark.sql import DataFrame, SparkSession

from visitlake import schemas as S
from visitlake.functions import country_kind


def build_countries(spark: SparkSession) -> DataFrame:
    """One row per country code with its kind: country, web domain or unknown."""
    named = spark.createDataFrame(list(S.COUNTRIES.items()), "country_code bigint, country_name string")
    return named.withColumn("kind", country_kind("country_code"))


def build_devices(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(device,) for device in S.DEVICE_WEIGHTS], S.DEVICES_SCHEMA)
