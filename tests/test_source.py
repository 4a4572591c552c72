from datetime import datetime

import pytest
from conftest import RECEIVED, bronze_frame, click, raw_frame, rows_of

from visitlake import schemas as S
from visitlake.sources import raw_clicks


def test_plain_columns_are_typed_and_bad_numbers_become_null(spark):
    raw = raw_frame(spark, [click(1, 1, price_usd="free"), click(1, 2)])
    plain = raw_clicks.to_plain_columns(raw)
    assert plain.schema.simpleString() == S.SOURCE_SCHEMA.simpleString()
    assert rows_of(plain, "click_number_in_visit", "price_usd") == [(1, None), (2, 28)]


def test_missing_column_is_an_error(spark):
    with pytest.raises(raw_clicks.SourceColumnsError, match="page"):
        raw_clicks.to_plain_columns(raw_frame(spark, [click(1, 1)]).drop("page"))


def test_arrival_needs_a_time_zone(spark):
    with pytest.raises(ValueError, match="time zone"):
        bronze_frame(spark, [click(1, 1)], datetime(2024, 9, 1))


def test_bronze_columns(spark):
    assert bronze_frame(spark, [click(1, 1)]).schema.simpleString() == S.BRONZE_SCHEMA.simpleString()


def test_raw_files_round_trip(spark, tmp_path):
    rows = [click(1, 1), click(1, 2, product_code=None)]
    raw_frame(spark, rows).write.option("sep", ";").option("header", True).csv(f"{tmp_path}/a/b")
    again = raw_clicks.to_plain_columns(raw_clicks.read_raw_files(spark, str(tmp_path)))
    assert rows_of(again.fillna(""), *S.PLAIN_COLUMNS) == [
        tuple("" if row[name] is None else row[name] for name in S.PLAIN_COLUMNS) for row in rows]


def test_resends_are_copies_one_second_later(spark):
    once = bronze_frame(spark, [click(visit, 1) for visit in range(40)])
    twice = raw_clicks.with_resends(once, 1)
    assert twice.count() == 80
    assert raw_clicks.with_resends(once, 0).count() == 40
    assert 40 < raw_clicks.with_resends(once, 4).count() < 80
    late = twice.selectExpr("max(received_time) - min(received_time) = INTERVAL 1 SECOND AS one_second").head()[0]
    assert late and RECEIVED.second == 0
