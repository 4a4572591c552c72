from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from visitlake import functions as fn
from visitlake import schemas as S


def values(frame, column):
    return [row[0] for row in frame.select(column).collect()]


@pytest.mark.parametrize("year, month, day, expected", [
    (2008, 4, 30, date(2008, 4, 30)), (2008, 4, 31, None), (2008, 13, 1, None), (2008, 2, 29, date(2008, 2, 29)),
    (1900, 2, 29, None), (2000, 2, 29, date(2000, 2, 29)), (0, 1, 1, None), (2008, 1, 0, None), (None, 1, 1, None),
    (2008, None, 1, None), (2008, 1, None, None), (10000, 1, 1, None), (2 ** 40, 1, 1, None)])
def test_real_date_exists_or_is_null(spark, year, month, day, expected):
    frame = spark.createDataFrame([(year, month, day)], "year bigint, month bigint, day bigint")
    assert values(frame, fn.real_date()) == [expected]


def test_shop_wall_clock_to_utc_at_clock_changes(spark):
    walls = ["2008-03-30 02:30:00", "2008-10-26 02:30:00", "2008-04-01 10:00:00", "2008-12-01 10:00:00",
             "2008-10-26 03:00:00", "2008-10-26 01:59:59", "2008-03-30 01:59:59", "2008-03-30 03:00:00"]
    frame = spark.createDataFrame([(wall,) for wall in walls], "wall string").withColumn("wall", F.col("wall").cast("timestamp"))
    found = values(frame, F.date_format(fn.shop_time_to_utc("wall"), "yyyy-MM-dd HH:mm:ss"))
    assert found == ["2008-03-30 01:00:00", "2008-10-26 01:30:00", "2008-04-01 08:00:00", "2008-12-01 09:00:00",
                     "2008-10-26 02:00:00", "2008-10-25 23:59:59", "2008-03-30 00:59:59", "2008-03-30 01:00:00"]


def test_missing_wall_clock_stays_missing(spark):
    frame = spark.createDataFrame([(None,)], "wall timestamp")
    assert values(frame, fn.shop_time_to_utc("wall")) == [None]


def test_click_id_needs_both_parts(spark):
    frame = spark.createDataFrame([(7, 1), (None, 1), (7, None)], "visit_id bigint, click_number_in_visit bigint")
    assert values(frame, fn.click_id()) == ["uci553-7-1", None, None]


def test_month_keys(spark):
    frame = spark.createDataFrame([(2008, 4), (2008, 13), (None, 4), (2008, None)], "year bigint, month bigint")
    assert values(frame, fn.source_month()) == ["2008-04", "2008-13", S.UNKNOWN_MONTH, S.UNKNOWN_MONTH]
    dates = spark.createDataFrame([(date(2008, 8, 13),), (None,)], "d date")
    assert values(dates, fn.month_of("d")) == ["2008-08", None]


def test_unknown_code_decodes_to_null(spark):
    frame = spark.createDataFrame([(1,), (4,), (9,), (None,)], "code bigint")
    assert values(frame, fn.decode(S.CATEGORIES, "code")) == ["trousers", "sale", None, None]


def test_weekend_is_saturday_and_sunday(spark):
    frame = spark.createDataFrame([(date(2008, 4, day),) for day in (4, 5, 6, 7)], "d date")
    assert values(frame, fn.is_weekend("d")) == [False, True, True, False]


def test_seconds_between_cuts_the_fraction_off(spark):
    late, early = datetime(2008, 4, 1, 12, 0, 2, 100000), datetime(2008, 4, 1, 12, 0, 0, 900000)
    frame = spark.createDataFrame([(early, late), (late, early)], "a timestamp_ntz, b timestamp_ntz")
    assert values(frame, fn.seconds_between("a", "b")) == [1, -1]


def test_draws_are_repeatable_and_spread(spark):
    frame = spark.range(2000).withColumnRenamed("id", "visit_id")
    one = values(frame, fn.draw(553, "visit_id", "hour"))
    assert one == values(frame, fn.draw(553, "visit_id", "hour"))
    assert one != values(frame, fn.draw(554, "visit_id", "hour"))
    assert all(0 <= number < 1 for number in one) and 0.45 < sum(one) / len(one) < 0.55
