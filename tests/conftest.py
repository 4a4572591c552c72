import sys
from datetime import date, datetime, timedelta, timezone
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from visitlake import schemas as S  # noqa: E402

RECEIVED = datetime(2024, 9, 1, 12, 0, tzinfo=timezone.utc)
RUN = datetime(2024, 9, 1, 12, 5, tzinfo=timezone.utc)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    from visitlake.session import configure
    session = (SparkSession.builder.master("local[8]").appName("visitlake-tests")
               .config("spark.sql.shuffle.partitions", "2").config("spark.ui.enabled", "false")
               .config("spark.driver.memory", "6g").config("spark.python.sql.dataFrameDebugging.enabled", "false")
               .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
               .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
               .getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    yield configure(session)
    session.stop()


def click(visit, number, **changes):
    """A valid source row in plain names; tests change single fields."""
    row = {"year": 2008, "month": 4, "day": 1, "click_number_in_visit": number, "country_code": 29, "visit_id": visit,
           "category_code": 1, "product_code": "A13", "colour_code": 1, "photo_position_code": 5, "photo_angle_code": 1,
           "price_usd": 28, "price_above_category_average_code": 2, "page_number_in_shop": 1}
    return {**row, **changes}


def raw_frame(spark, rows):
    """The rows as the source file gives them: source column names, all text."""
    values = [[None if row[plain] is None else str(row[plain]) for plain in S.PLAIN_COLUMNS] for row in rows]
    return spark.createDataFrame(values, S.RAW_SCHEMA)


def local(spark, frame):
    """The same rows as a local frame, so that later steps do not compute them again."""
    return spark.createDataFrame([tuple(row) for row in frame.collect()], frame.schema)


def bronze_frame(spark, rows, received=RECEIVED):
    from visitlake.plans.increment import build_bronze
    from visitlake.sources.raw_clicks import to_plain_columns
    return local(spark, build_bronze(to_plain_columns(raw_frame(spark, rows)), received))


def silver(spark, rows):
    from visitlake.operators.silver import build_silver
    found = build_silver(bronze_frame(spark, rows), RUN)
    found.clicks, found.rejected = local(spark, found.clicks), local(spark, found.rejected)
    return found


def clean_clicks(spark, rows):
    """Silver rows made by hand from valid source rows: a click a minute from noon."""
    made = []
    for row in rows:
        day = date(row["year"], row["month"], row["day"])
        time = datetime.combine(day, datetime.min.time()) + timedelta(hours=12, minutes=row["click_number_in_visit"])
        made.append((
            f"uci553-{row['visit_id']}-{row['click_number_in_visit']}", row["visit_id"], row["click_number_in_visit"], day,
            time, 14, row["product_code"], S.CATEGORIES[row["category_code"]], S.COLOURS[row["colour_code"]],
            row["price_usd"], row["price_above_category_average_code"] == 1, row["page_number_in_shop"],
            S.PHOTO_POSITIONS[row["photo_position_code"]], S.PHOTO_ANGLES[row["photo_angle_code"]], row["country_code"],
            "tablet" if row["visit_id"] % 3 else "mobile", time, 0, f"{day:%Y-%m}"))
    return spark.createDataFrame(made, S.SILVER_SCHEMA)


def reasons(frame):
    """Sorted (visit, click number, reason) of reject rows."""
    found = frame.select("visit_id", "click_number_in_visit", "rejection_reason").collect()
    return sorted((tuple(row) for row in found), key=str)


def rows_of(frame, *columns):
    return sorted(tuple(row) for row in frame.select(*columns).collect())
