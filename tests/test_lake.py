import pytest
from conftest import RUN, clean_clicks, click, raw_frame, rows_of
from pyspark.sql import functions as F
from pyspark.sql import types as T

from visitlake import schemas as S
from visitlake.operators.silver import add_weekend_click
from visitlake.plans import lake as lakes
from visitlake.plans.increment import build_increment
from visitlake.sources import landing, ledger, tables
from visitlake.sources.raw_clicks import read_raw_clicks
from visitlake.streaming.new_files import process_available, stream_raw_clicks

APRIL = [click(visit, number) for visit in range(1, 6) for number in (1, 2)]
AUGUST = [click(visit, 1, month=8, day=13) for visit in range(10, 13)]
FIRST, SECOND = "first source", "second source"


@pytest.fixture
def lake(spark, tmp_path):
    return new_lake(spark, tmp_path)


@pytest.fixture(scope="module")
def two_runs(spark, tmp_path_factory):
    """A lake after April and then August, both reports, and April's Silver files between the runs."""
    lake = new_lake(spark, tmp_path_factory.mktemp("two_runs"))
    first = run(spark, lake, APRIL)
    april = files(spark, lake.tables.clicks, "2008-04")
    return lake, first, run(spark, lake, AUGUST), april


def new_lake(spark, tmp_path):
    database = f"lake_{abs(hash(str(tmp_path)))}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{tmp_path}/tables'")
    names = tables.LakeTables.within(database)
    tables.create_lake_tables(spark, names)
    return lakes.Lake(f"{tmp_path}/landing", names, f"{tmp_path}/gold", f"{tmp_path}/ledger")


def run(spark, lake, rows):
    return dict(rows_of(lakes.run_increment(spark, raw_frame(spark, rows), lake, RUN), "metric", "value"))


def months(spark, table, column="click_month"):
    return dict(tuple(row) for row in spark.table(table).groupBy(column).count().collect())


def files(spark, table, month):
    return sorted(row[0] for row in tables.data_files(
        spark.table(table).filter(F.col("click_month") == month)).select("file_path").collect())


def source_file(spark, tmp_path, name, rows):
    raw_frame(spark, rows).coalesce(1).write.option("sep", ";").option("header", True).csv(f"{tmp_path}/{name}")
    return f"{tmp_path}/{name}"


def test_second_month_leaves_the_first_alone(spark, two_runs):
    lake, first, second, april = two_runs
    assert first["source_month: 2008-04"] == 1 and "source_month: 2008-08" not in first
    assert (second["source_rows"], second["total_silver_clicks"], second["total_visits"]) == (3, 13, 8)
    assert (second["silver_clicks"], second["visits"], second["one_click_visits"]) == (3, 3, 3)
    assert months(spark, lake.tables.clicks) == {"2008-04": 10, "2008-08": 3}
    assert files(spark, lake.tables.clicks, "2008-04") == april
    assert second["deleted_visits_removed"] == 0
    assert rows_of(spark.read.parquet(f"{lake.gold}/summaries/visit_depth_funnel"), "shop_page", "visits_reaching_page") == [
        (1, 8), (2, 0), (3, 0), (4, 0), (5, 0)]


def test_tables_keep_wall_clock_timestamps(spark, two_runs):
    stored = spark.table(two_runs[0].tables.clicks)
    assert isinstance(stored.schema["received_time"].dataType, T.TimestampNTZType)
    assert {str(row[0]) for row in stored.select("received_time").distinct().collect()} == {"2024-09-01 12:05:00"}


def test_report_is_written_as_json(spark, two_runs, tmp_path):
    report = spark.createDataFrame(list(two_runs[2].items()), "metric string, value bigint")
    lakes.write_report(report, f"{tmp_path}/report")
    assert dict(rows_of(spark.read.json(f"{tmp_path}/report"), "metric", "value")) == two_runs[2]


def test_compaction_keeps_rows(spark, two_runs):
    table = two_runs[0].tables.clicks
    rows, august = sorted(spark.table(table).collect()), files(spark, table, "2008-08")
    tables.write_months_to_table(spark.table(table).filter("click_month = '2008-04'"), table)
    tables.compact_month(spark, table, "2008-04")
    assert sorted(spark.table(table).collect()) == rows
    assert len(files(spark, table, "2008-04")) == 1 and files(spark, table, "2008-08") == august


def test_landed_files_are_parsed_for_one_write_only(spark, tmp_path):
    source = source_file(spark, tmp_path, "source", APRIL)
    landing.land_months(spark, source, f"{tmp_path}/landing", ["2008-04"], FIRST)
    built = build_increment(read_raw_clicks(spark, f"{tmp_path}/landing", ["2008-04"]), RUN)
    for frame in (built.source, built.bronze, built.source_months, built.silver.clicks):
        assert "FileScan csv" not in frame._jdf.queryExecution().executedPlan().toString()
    assert built.bronze_rows == built.bronze.count() == len(APRIL)


def test_nothing_to_do(spark, lake):
    assert run(spark, lake, []) == {"status: nothing new landed": 0, "source_rows": 0}
    no_columns = spark.createDataFrame([], "x string").select()
    assert lakes.run_increment(spark, no_columns, lake, RUN).head()["metric"] == "status: nothing new landed"


def test_month_that_becomes_empty_is_removed_from_every_layer(spark, lake):
    run(spark, lake, APRIL + AUGUST)
    report = run(spark, lake, [click(1, 1, country_code=99)])
    assert (report["rejected_rows"], report["silver_clicks"]) == (1, 0)
    assert report["rejected: country_code outside 1-47"] == 1
    assert report["total_silver_clicks"] == 3 and report["total_visits"] == 3
    assert months(spark, lake.tables.clicks) == months(spark, lake.tables.gold_clicks) == {"2008-08": 3}
    assert months(spark, lake.tables.gold_visits, "visit_month") == {"2008-08": 3}
    assert months(spark, lake.tables.rejected, "source_month") == {"2008-04": 1}
    days = spark.read.parquet(f"{lake.gold}/summaries/daily_visits")
    assert rows_of(days.select(F.col("visit_date").cast("string")), "visit_date") == [("2008-08-13",)]


def test_writer_follows_the_table_columns(spark, lake):
    table = lake.tables.clicks
    april = add_weekend_click(clean_clicks(spark, APRIL))
    august = add_weekend_click(clean_clicks(spark, [click(10, 1, month=8, day=16), click(11, 1, month=8, day=13)]))
    tables.write_months_to_table(april, table)
    assert "weekend_click" not in spark.table(table).columns
    april = files(spark, table, "2008-04")
    tables.add_column(spark, table, "weekend_click", "boolean")
    tables.add_column(spark, table, "weekend_click", "boolean")
    tables.write_months_to_table(august, table)
    assert dict(rows_of(spark.table(table).filter("visit_id > 5"), "visit_id", "weekend_click")) == {10: True, 11: False}
    assert {row[0] for row in spark.table(table).filter("visit_id <= 5").select("weekend_click").collect()} == {None}
    assert files(spark, table, "2008-04") == april
    with pytest.raises(tables.MissingColumnError, match="weekend_click"):
        tables.write_months_to_table(spark.table(table).drop("weekend_click"), table)


def land(spark, lake, month, rows):
    raw_frame(spark, rows).coalesce(1).write.option("sep", ";").option("header", True).csv(f"{lake.landing}/source_month={month}")


def test_stray_row_is_rejected_and_leaves_its_own_month_alone(spark, lake):
    land(spark, lake, "2008-05", [click(20, number, month=5) for number in range(1, 6)])
    lakes.run_new_files(spark, lake, RUN)
    land(spark, lake, "2008-04", APRIL + [click(21, 1, month=5)])
    report = dict(rows_of(lakes.run_new_files(spark, lake, RUN), "metric", "value"))
    assert months(spark, lake.tables.clicks) == {"2008-04": 10, "2008-05": 5}
    assert rows_of(spark.table(lake.tables.rejected), "visit_id", "rejection_reason", "source_month") == [
        (21, S.OTHER_MONTH, "2008-04")]
    assert (report["source_rows"], report["bronze_rows"], report["silver_clicks"], report["rejected_rows"]) == (11, 11, 10, 1)
    assert (report["deleted_visits_removed"], report["unaccounted"]) == (0, 0)


def test_run_stops_before_writing_months_it_was_not_given(spark, lake):
    run(spark, lake, AUGUST)
    with pytest.raises(lakes.UnreadMonthError, match="2008-08"):
        lakes.run_increment(spark, raw_frame(spark, APRIL + [click(30, 1, month=8)]), lake, RUN, ["2008-04"])
    assert months(spark, lake.tables.clicks) == {"2008-08": 3}


def test_erased_visits_are_left_nowhere_however_they_are_written(spark, lake, tmp_path, monkeypatch):
    shared = tmp_path / "shared"
    monkeypatch.setattr("visitlake.session._run_folders", [f"file://{shared}"])
    header = ";".join(S.SOURCE_TO_PLAIN)
    line = "2008;4;{day};1;29;{visit};1;A13;1;5;1;28;2;1"
    lines = [line.format(day=n, visit=visit) for n, visit in enumerate(["42", "042", " 42", '"42"', "421", "7"], 1)]
    (tmp_path / "landing" / "source_month=2008-04").mkdir(parents=True)
    (tmp_path / "landing" / "source_month=2008-04" / "a.csv").write_text("\n".join([header, *lines]))
    lakes.run_new_files(spark, lake, RUN)
    lakes.erase_visits(spark, lake, spark.createDataFrame([(42,)], "visit_id bigint"), RUN, "request")
    kept = sorted(row.value for row in spark.read.text(f"{lake.landing}/source_month=2008-04").collect())
    assert kept == sorted([header, lines[4], lines[5]])
    places = [spark.table(name) for name in (lake.tables.clicks, lake.tables.rejected, lake.tables.gold_clicks, lake.tables.gold_visits)]
    assert [place.filter("visit_id = 42").count() for place in places] == [0] * 4
    assert not [path for path in shared.rglob("*") if path.is_file()]


def test_mixed_headers_stop_an_erasure(spark, lake, tmp_path):
    folder = tmp_path / "landing" / "source_month=2008-04"
    folder.mkdir(parents=True)
    header = list(S.SOURCE_TO_PLAIN)
    for name, names in (("a", header), ("b", header[::-1])):
        (folder / f"{name}.csv").write_text(";".join(names) + "\n")
    with pytest.raises(landing.LandingError, match="share one header"):
        landing.erase_visit_lines(spark, lake.landing, ["2008-04"], spark.createDataFrame([(1,)], "visit_id bigint"))


def test_listed_visit_stays_out_and_others_are_identical(spark, lake):
    run(spark, lake, APRIL)
    before = {name: spark.table(table).collect() for name, table in
              (("clicks", lake.tables.clicks), ("visits", lake.tables.gold_visits))}
    entry = spark.sql("SELECT 3L AS visit_id, TIMESTAMP_NTZ '2024-09-02 00:00:00' AS deleted_time, 'x' AS reason, 'y' AS bronze_key")
    tables.fit_to_table(entry, lake.tables.deleted_visits).write.insertInto(lake.tables.deleted_visits)
    rerun = run(spark, lake, APRIL)
    assert (rerun["deleted_visits_removed"], rerun["total_silver_clicks"], rerun["unaccounted"]) == (2, 8, 0)
    for name, table in (("clicks", lake.tables.clicks), ("visits", lake.tables.gold_visits)):
        after = spark.table(table).collect()
        assert sorted(after) == sorted(row for row in before[name] if row.visit_id != 3)


def test_land_run_and_erase(spark, lake, tmp_path):
    rows = APRIL + AUGUST + [click(7, 1), click(7, 3)]
    source = source_file(spark, tmp_path, "source", rows)
    report = landing.land_months(spark, source, lake.landing, ["2008-04", "2008-08"], FIRST)
    assert [tuple(row) for row in report.collect()] == [("2008-04", 12, "written"), ("2008-08", 3, "written")]
    again = landing.land_months(spark, source, lake.landing, ["2008-04"], FIRST)
    assert [tuple(row) for row in again.collect()] == [("2008-04", 12, "already landed")]
    first = dict(rows_of(lakes.run_new_files(spark, lake, RUN), "metric", "value"))
    assert (first["rejected_rows"], first["silver_clicks"]) == (2, 13)
    assert "status: nothing new landed" in dict(rows_of(lakes.run_new_files(spark, lake, RUN), "metric", "value"))

    wanted = spark.createDataFrame([(3,), (7,)], "visit_id bigint")
    august = files(spark, lake.tables.clicks, "2008-08")
    assert lakes.erase_visits(spark, lake, wanted, RUN, "request") == ["2008-04"]
    listed = rows_of(spark.table(lake.tables.deleted_visits), "visit_id", "bronze_key", "reason")
    assert listed == [(3, "source_month=2008-04", "request"), (7, "source_month=2008-04", "request")]

    def holding():
        places = [spark.table(name) for name in (lake.tables.clicks, lake.tables.rejected, lake.tables.gold_clicks,
                                                 lake.tables.gold_visits)]
        raw = read_raw_clicks(spark, lake.landing).select(F.col("`session ID`").cast("bigint").alias("visit_id"))
        return [place.filter("visit_id IN (3, 7)").count() for place in [*places, raw]]

    assert holding() == [0] * 5
    assert files(spark, lake.tables.clicks, "2008-08") == august
    landed = spark.read.text(f"{lake.landing}/source_month=2008-04").collect()
    assert len(landed) == 9 and sum(row.value.startswith("year;month") for row in landed) == 1
    rerun = dict(rows_of(lakes.run_new_files(spark, lake, RUN), "metric", "value"))
    assert "source_month: 2008-04" in rerun and "source_month: 2008-08" not in rerun
    assert (rerun["source_rows"], rerun["total_silver_clicks"], rerun["rejected_rows"]) == (8, 11, 0)
    assert holding() == [0] * 5
    lakes.erase_visits(spark, lake, wanted, RUN, "request")
    assert spark.table(lake.tables.deleted_visits).count() == 2


def test_erasing_the_only_visit_of_a_month(spark, lake, tmp_path):
    source = source_file(spark, tmp_path, "source", APRIL + [click(9, 1, month=5)])
    landing.land_months(spark, source, lake.landing, ["2008-04", "2008-05"], FIRST)
    lakes.run_new_files(spark, lake, RUN)
    lakes.erase_visits(spark, lake, spark.createDataFrame([(9,)], "visit_id bigint"), RUN, "request")
    assert months(spark, lake.tables.clicks) == {"2008-04": 10}
    assert read_raw_clicks(spark, lake.landing, ["2008-05"]).count() == 0
    lakes.run_new_files(spark, lake, RUN)
    assert months(spark, lake.tables.gold_visits, "visit_month") == {"2008-04": 5}


def test_landing_keeps_lines_and_replaces_months(spark, lake, tmp_path):
    folder = tmp_path / "lines"
    folder.mkdir()
    header = ";".join(S.SOURCE_TO_PLAIN)
    lines = [header, "2008;4;1;  odd, \"text\" ;x", "", "2008;5;1;a", "2008;9;1;b"]
    (folder / "clicks.csv").write_bytes("\r\n".join(lines).encode())
    report = landing.land_months(spark, str(folder), lake.landing, ["2008-04", "2008-05", "2008-06"], FIRST)
    assert [tuple(row)[:2] for row in report.collect()] == [("2008-04", 1), ("2008-05", 1), ("2008-06", 0)]
    landed = {month: sorted(row.value for row in spark.read.text(f"{lake.landing}/source_month={month}").collect())
              for month in ("2008-04", "2008-05", "2008-06")}
    assert landed == {"2008-04": sorted([header, lines[1]]), "2008-05": sorted([header, lines[3]]), "2008-06": [header]}
    (folder / "clicks.csv").write_text("\n".join([header, "2008;5;1;c"]))
    spark.catalog.clearCache()
    landing.land_months(spark, str(folder), lake.landing, ["2008-04", "2008-05"], SECOND)
    assert spark.read.text(f"{lake.landing}/source_month=2008-04").count() == 1
    assert sorted(row.value for row in spark.read.text(f"{lake.landing}/source_month=2008-05").collect()) == ["2008;5;1;c", header]


def test_source_files_with_different_headers_are_not_landed(spark, lake, tmp_path):
    folder = tmp_path / "source"
    folder.mkdir()
    header = list(S.SOURCE_TO_PLAIN)
    for name, names in (("a", header), ("b", header[::-1])):
        (folder / f"{name}.csv").write_text(";".join(names) + "\n2008;4;1;1\n")
    with pytest.raises(landing.LandingError, match="share one header"):
        landing.land_months(spark, str(folder), lake.landing, ["2008-04"], FIRST)
    assert not (tmp_path / "landing").exists()


@pytest.mark.parametrize("asked, allowed", [([], None), (["2008-09"], ["2008-04"])])
def test_landing_refuses_bad_requests(spark, lake, asked, allowed):
    with pytest.raises(landing.LandingError):
        landing.land_months(spark, "unused", lake.landing, asked, FIRST, allowed)


def test_rewritten_file_counts_as_new(spark, lake, tmp_path):
    source = source_file(spark, tmp_path, "source", APRIL + AUGUST)
    landing.land_months(spark, source, lake.landing, ["2008-04", "2008-08"], FIRST)
    found = ledger.new_files(spark, lake.landing, lake.ledger)
    assert ledger.touched_months(found) == ["2008-04", "2008-08"]
    ledger.mark_processed(found, lake.ledger)
    assert ledger.touched_months(ledger.new_files(spark, lake.landing, lake.ledger)) == []
    landing.land_months(spark, source, lake.landing, ["2008-08"], SECOND)
    assert ledger.touched_months(ledger.new_files(spark, lake.landing, lake.ledger)) == ["2008-08"]


def test_stream_hands_over_each_file_once(spark, lake, tmp_path):
    source = source_file(spark, tmp_path, "source", APRIL + AUGUST)
    seen = []
    handle = lambda batch, _: seen.append(batch.count())
    landing.land_months(spark, source, lake.landing, ["2008-04"], FIRST)
    for _ in range(2):
        process_available(stream_raw_clicks(spark, lake.landing), f"{tmp_path}/checkpoint", handle)
    landing.land_months(spark, source, lake.landing, ["2008-08"], FIRST)
    process_available(stream_raw_clicks(spark, lake.landing, 1), f"{tmp_path}/checkpoint", handle)
    assert [count for count in seen if count] == [10, 3]


def test_month_folders_read_with_a_declared_schema(spark, tmp_path):
    assert tables.read_months(spark, f"{tmp_path}/none", S.VISITS_SCHEMA).count() == 0
    frame = spark.createDataFrame([(1, "2008-04"), (2, "2008-05")], "n bigint, month string")
    tables.write_months(frame, f"{tmp_path}/m", "month")
    tables.write_months(frame.filter("month = '2008-04'").withColumn("n", F.lit(9).cast("bigint")), f"{tmp_path}/m", "month")
    assert rows_of(tables.read_months(spark, f"{tmp_path}/m", frame.schema), "n", "month") == [(2, "2008-05"), (9, "2008-04")]


def test_weekend_helper_needs_only_a_date(spark):
    assert add_weekend_click(spark.sql("SELECT DATE '2008-04-05' AS click_date")).head()["weekend_click"] is True
