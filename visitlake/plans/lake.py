"""Lake runs: process new files, rebuild what depends on every month, report, erase visits, compact."""

import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from visitlake import schemas as S
from visitlake.functions import source_month
from visitlake.operators import rollups
from visitlake.operators.erasure import deleted_visit_ids, remove_deleted_visits
from visitlake.operators.gold import build_gold_clicks, build_visits
from visitlake.operators.quality import merged_profile, metric, value_counts
from visitlake.operators.rules import all_reasons
from visitlake.operators.silver import add_weekend_click
from visitlake.plans.increment import build_whole_dataset, increment_of, month_filter, staged_source
from visitlake.plans.journal import Journal
from visitlake.session import run_scratch, scratch_folder, staged
from visitlake.sources.landing import erase_visit_lines
from visitlake.sources.ledger import mark_processed, new_files, touched_months
from visitlake.sources.raw_clicks import read_raw_clicks, to_plain_columns, utc_literal
from visitlake.sources.tables import (
    NEW, LakeTables, fit_to_table, remove_old_versions, replace_months_in_table, write_whole,
)

CLICK_ORDER = ["visit_id", "click_number_in_visit"]


@dataclass(frozen=True)
class Lake:
    """Where a lake lives: landing folder, catalog tables, folder of whole-dataset tables, ledger of processed files."""

    landing: str
    tables: LakeTables
    gold: str
    ledger: str

    @property
    def journal(self) -> str:
        return f"{self.ledger}-journal"


class UnreadMonthError(Exception):
    """Rows belong to a month that the run did not read whole."""


def run_new_files(spark: SparkSession, lake: Lake, run_time: datetime, seed: int = S.DEFAULT_SEED,
                  on_step: Callable[[str], None] = lambda step: None) -> DataFrame:
    """Process landed files that are new or rewritten. The ledger moves forward only after every write succeeded.

    Finished steps are noted in the lake's journal under the set of files. A run that died is repeated from the step that it
    did not finish, if the same files are new; with other files it starts again. ``on_step`` is told each finished step.
    """
    with run_scratch(spark):
        files = staged(new_files(spark, lake.landing, lake.ledger), "new-files")
        months = touched_months(files)
        if not months:
            return _nothing_new(spark)
        run_id = files.agg(F.hex(F.bit_xor(F.xxhash64("path", "modificationTime", "length"))), F.count("*")).first()
        journal = Journal(spark, lake.journal, f"files-{run_id[0]}-{run_id[1]}")
        report = run_increment(spark, read_raw_clicks(spark, lake.landing, months), lake, run_time, months, seed, journal, on_step)
        mark_processed(files, lake.ledger)
        return report


def run_increment(spark: SparkSession, raw: DataFrame, lake: Lake, run_time: datetime,
                  months: list[str] | None = None, seed: int = S.DEFAULT_SEED, journal: Journal | None = None,
                  on_step: Callable[[str], None] = lambda step: None) -> DataFrame:
    """Replace the months of the raw rows in every layer, rebuild the whole-dataset tables and report.

    The frame must hold whole months, and only those months are rebuilt. A verdict depends on all clicks of a visit, so the
    visits of these months, as they are now and as they were before, are judged with their clicks of all other landed months
    (see ``linked_clicks``). Of those months just the rows of these visits are replaced; they count as received by this run.
    One run, several runs and a run after an erasure therefore give the same rows. Rows without a landing month come
    without that context.

    A row whose date lies outside its landing month becomes a reject; if rows without a landing month lie outside the given
    months, the run stops before it writes. A month that ends up empty in a layer is removed there. Everything staged on the
    way is removed at the end. With a journal, steps that it knows as finished are not done again.
    """
    with run_scratch(spark):
        if not raw.columns or raw.isEmpty():
            return _nothing_new(spark)
        journal = journal or Journal(spark, scratch_folder(spark, "journal"), "run")
        facts = {}
        for step, work in (("silver", lambda: _silver_step(spark, raw, lake, run_time, months, seed, journal)),
                           ("gold", lambda: refresh_gold(spark, lake, facts["written"], journal.kept("affected-visits")))):
            done = journal.facts(step)
            if done is None:
                done = work()
                journal.finish(step, done)
                on_step(step)
            facts |= done
        report = run_report(spark, lake, facts)
        journal.forget()
        return report


def _silver_step(spark: SparkSession, raw: DataFrame, lake: Lake, run_time: datetime, months: list[str] | None, seed: int,
                 journal: Journal) -> dict:
    """Write Silver and the table of landed visits. Gives the run's months, those written, and the rows that were counted; the
    affected visits are kept with the journal."""
    tables = lake.tables
    for table in versioned(tables):
        remove_old_versions(spark, table)
    source = staged_source(raw)
    landed = staged(visit_months_of(source), "landed-visits")
    months = months or sorted(row[0] for row in landed.select("source_month").distinct().collect())
    # Also those of an attempt that died: it may have changed the table of landed visits already.
    before = month_filter(spark.table(tables.landed_visits), "source_month", months)
    known = landed.select("visit_id").unionByName(before.select("visit_id")).filter("visit_id IS NOT NULL").distinct()
    affected = journal.keep(known, "affected-visits")
    linked, context = linked_clicks(spark, lake, affected, months) if "source_month" in source.columns else ([], None)
    deleted = staged(deleted_visit_ids(spark.table(tables.deleted_visits)), "deleted-visits")
    judged = source if context is None else source.unionByName(staged_source(context))
    increment = increment_of(judged, run_time, seed=seed, erased=deleted)
    silver, written = increment.silver, sorted({*months, *linked})
    clicks, rejected = add_weekend_click(silver.clicks), silver.rejected
    # A row with a landing month becomes a click or a reject of that month, so the few landed months tell first.
    if "source_month" not in source.columns or not landed.filter(~F.col("source_month").isin(written)).isEmpty():
        _stop_at_unread_months(clicks, "click_month", written)
        _stop_at_unread_months(rejected, "source_month", written)
    found = {"months": months, "written": written, "source_rows": landed.agg(F.sum("rows")).first()[0],
             "bronze_rows": increment.bronze_rows}
    if context is not None:
        found["context_rows"] = increment.bronze_rows - found["source_rows"]
    observed = [Observation(f"{name}-{uuid.uuid4().hex}") for name in ("clicks", "rejected")]
    new = F.col(NEW)
    reasons = [F.count_if(new & (F.col("rejection_reason") == reason)).alias(reason) for reason in all_reasons()]

    def others(table: str, column: str) -> DataFrame | None:
        """Rows of linked months that belong to other visits."""
        kept = month_filter(spark.table(table), column, linked).join(affected, "visit_id", "left_anti")
        return kept if linked else None

    # The profile is of what landed, so it holds the rows of these months and not their context.
    profiled = month_filter(source.select(*S.PLAIN_COLUMNS, _landing_month(source).alias("source_month")), "source_month", months)
    together(
        lambda: replace_months_in_table(clicks, tables.clicks, written, CLICK_ORDER, others(tables.clicks, "click_month"),
                                        observed[0], (F.count_if(new).alias("silver_clicks"),)),
        lambda: replace_months_in_table(rejected, tables.rejected, written, CLICK_ORDER, others(tables.rejected, "source_month"),
                                        observed[1], (F.count_if(new).alias("rejected_rows"), *reasons)),
        lambda: replace_months_in_table(value_counts(profiled, F.col("source_month")), tables.profile_months, months))
    # Last, so that an attempt that dies before it still finds the visits that the months held.
    replace_months_in_table(_index(landed, deleted), tables.landed_visits, months, ["visit_id"])
    return found | silver.counts | observed[0].get | observed[1].get


def visit_months_of(plain: DataFrame) -> DataFrame:
    """``visit_id``, ``source_month``, ``rows``: the rows of each visit in each landing month of plain source rows."""
    return plain.groupBy("visit_id", _landing_month(plain).alias("source_month")).agg(F.count("*").alias("rows"))


def _landing_month(rows: DataFrame) -> Column:
    return F.col("source_month") if "source_month" in rows.columns else source_month()


def lake_profile(spark: SparkSession, lake: Lake) -> DataFrame:
    """The profile of all landed rows, merged from the counts of their months. No landed file is read."""
    return merged_profile(spark.table(lake.tables.profile_months))


def _index(landed: DataFrame, deleted: DataFrame) -> DataFrame:
    return remove_deleted_visits(landed.filter("visit_id IS NOT NULL").select("visit_id", "source_month"), deleted)


def linked_clicks(spark: SparkSession, lake: Lake, visits: DataFrame, months: list[str]) -> tuple[list[str], DataFrame | None]:
    """Other landed months that hold clicks of the visits, and those clicks as raw rows.

    The table of landed visits tells them: narrow, sorted by visit, one row per visit and month. Raw files of other
    months are not read, and of these months only the visits' rows are kept.
    """
    index = spark.table(lake.tables.landed_visits)
    hits = staged(index.filter(~F.col("source_month").isin(months)).join(visits, "visit_id", "left_semi"), "linked-visits")
    linked = sorted(row[0] for row in hits.select("source_month").distinct().collect())
    if not linked:
        return [], None
    raw = read_raw_clicks(spark, lake.landing, linked)
    visit = F.col(f"`{S.SOURCE_VISIT_COLUMN}`").try_cast("bigint")
    wanted = hits.select(F.col("visit_id").alias("_visit")).distinct()
    return linked, raw.join(wanted, visit == F.col("_visit"), "left_semi")


def _stop_at_unread_months(rows: DataFrame, month_column: str, months: list[str]) -> None:
    other = rows.filter(~F.col(month_column).isin(months)).select(month_column).limit(1).collect()
    if other:
        raise UnreadMonthError(f"rows of {other[0][0]} are in a run over {months}; nothing was written")


def refresh_gold(spark: SparkSession, lake: Lake, months: list[str], affected: DataFrame) -> dict[str, int]:
    """Gold and roll-ups of the given months from the Silver just written, then every whole-dataset table.

    Rows of visits other than the affected ones stay as they are, since a visit may have clicks in months that are not
    read. The cost follows the given months: the whole-dataset tables are merged from the roll-ups. Gives the number of
    affected visits and of those with one click, as their write observed them.
    """
    tables = lake.tables
    clicks = month_filter(spark.table(tables.clicks), "click_month", months)
    rebuilt = build_visits(clicks.join(affected, "visit_id", "left_semi"))
    kept = month_filter(spark.table(tables.gold_visits), "visit_month", months).join(affected, "visit_id", "left_anti")
    observed, new = Observation(f"visits-{uuid.uuid4().hex}"), F.col(NEW)

    def write_visits() -> None:
        replace_months_in_table(rebuilt, tables.gold_visits, months, ["visit_id"], kept, observed,
                                (F.count_if(new).alias("visits"), F.count_if(new & F.col("bounced")).alias("one_click_visits")))
        visits = month_filter(spark.table(tables.gold_visits), "visit_month", months)
        replace_months_in_table(rollups.visit_months(visits), tables.visit_months, months)

    together(
        write_visits,
        lambda: replace_months_in_table(build_gold_clicks(clicks), tables.gold_clicks, months, CLICK_ORDER),
        lambda: replace_months_in_table(rollups.product_months(clicks), tables.product_months, months),
        lambda: replace_months_in_table(rollups.click_days(clicks), tables.click_days, months))
    whole = build_whole_dataset(spark, spark.table(tables.product_months), spark.table(tables.click_days),
                                spark.table(tables.visit_months))
    together(*[lambda frame=frame, name=name: write_whole(frame, f"{lake.gold}/{name}") for name, frame in whole.items()])
    return observed.get


def together(*jobs) -> None:
    """Run independent Spark jobs at the same time; the first failure is raised once all have ended."""
    with ThreadPoolExecutor(max_workers=4) as pool:
        for done in [pool.submit(job) for job in jobs]:
            done.result()


def run_report(spark: SparkSession, lake: Lake, found: dict) -> DataFrame:
    """``metric, value`` rows of one run from the facts of its steps. No layer is scanned for it: rows were counted by the writes themselves, and what
    concerns all months is summed from the roll-ups. ``unaccounted`` is what Bronze holds beyond the counted outputs, and
    must be 0.
    """
    tables = lake.tables
    products = spark.read.schema(S.PRODUCTS_SCHEMA).parquet(f"{lake.gold}/products")
    of_months = month_filter(spark.table(tables.product_months), "click_month", found["written"])
    totals = reduce(DataFrame.unionByName, [
        metric(rollups.mismatched_clicks(of_months, products), category_mismatches=F.sum("clicks")),
        metric(rollups.by_day(spark.table(tables.visit_months)), total_silver_clicks=F.sum("clicks"), total_visits=F.sum("visits"))])
    known = ["source_rows", "context_rows", "bronze_rows", "rejected_rows", "silver_clicks", "visits", "one_click_visits"]
    values = {name: found[name] for name in known if name in found} | {row["metric"]: row["value"] for row in totals.collect()}
    values["duplicates_removed"] = found["bronze_rows"] - found["judged_rows"]
    values["deleted_visits_removed"] = found["erased_rows"]
    outputs = ("duplicates_removed", "deleted_visits_removed", "rejected_rows", "silver_clicks")
    values["unaccounted"] = values["bronze_rows"] - sum(values[name] for name in outputs)
    reasons = [(f"rejected: {reason}", found[reason]) for reason in all_reasons() if found.get(reason)]
    rows = list(values.items()) + reasons + [(f"source_month: {month}", 1) for month in found["months"]]
    return spark.createDataFrame(rows, "metric string, value bigint")


def write_report(report: DataFrame, path: str) -> None:
    """The report as JSON lines. It has a few dozen rows."""
    report.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "static").json(path)


def erase_visits(spark: SparkSession, lake: Lake, visits: DataFrame, deleted_time: datetime, reason: str) -> list[str]:
    """Erase visits from every layer and keep them erased; return the months that were touched.

    Order: the list first, so that any later run leaves the visits out even if this one stops half-way; then Silver,
    Gold, and the landed lines. The rewritten landing months count as new files for the next run. Staged copies are
    removed at the end.
    """
    with run_scratch(spark):
        return _erase(spark, lake, visits, deleted_time, reason)


def _erase(spark: SparkSession, lake: Lake, visits: DataFrame, deleted_time: datetime, reason: str) -> list[str]:
    tables = lake.tables
    wanted = staged(visits.select("visit_id").distinct(), "erased-visits")
    landed = to_plain_columns(read_raw_clicks(spark, lake.landing), keep=("source_month",)).select("visit_id", "source_month")
    hits = staged(landed.join(wanted, "visit_id", "left_semi").distinct(), "erased-months")
    months = sorted(row[0] for row in hits.select("source_month").distinct().collect())
    listed = wanted.join(hits, "visit_id", "left").groupBy("visit_id").agg(F.min("source_month").alias("source_month"))
    entries = listed.select(
        "visit_id", utc_literal(deleted_time).alias("deleted_time"), F.lit(reason).alias("reason"),
        F.concat(F.lit("source_month="), "source_month").alias("bronze_key"))
    new = entries.join(deleted_visit_ids(spark.table(tables.deleted_visits)), "visit_id", "left_anti")
    staged_entries = staged(new.select(S.ERASED_VISITS_SCHEMA.fieldNames()), "erased-entries")
    fit_to_table(staged_entries, tables.deleted_visits).write.insertInto(tables.deleted_visits)
    holding = ((tables.clicks, "click_month"), (tables.rejected, "source_month"), (tables.landed_visits, "source_month"))
    together(*[lambda table=table, column=column: erase_from_table(spark, table, column, months, wanted) for table, column in holding])
    refresh_gold(spark, lake, months, wanted)
    if months:
        erase_visit_lines(spark, lake.landing, months, wanted)
        left = staged(to_plain_columns(read_raw_clicks(spark, lake.landing, months), keep=("source_month",)), "left-clicks")
        replace_months_in_table(value_counts(left, F.col("source_month")), tables.profile_months, months)
    # Versions from before the erasure must not outlive it.
    for table in versioned(tables):
        remove_old_versions(spark, table)
    return months


def versioned(tables: LakeTables) -> list[str]:
    """Every table whose months are replaced."""
    return [tables.clicks, tables.rejected, tables.landed_visits, tables.profile_months, tables.gold_clicks, tables.gold_visits,
            tables.product_months, tables.click_days, tables.visit_months]


def erase_from_table(spark: SparkSession, table: str, month_column: str, months: list[str], visits: DataFrame) -> None:
    """Rewrite the months of a table that hold one of the visits; other months keep their files."""
    present = month_filter(spark.table(table), month_column, months)
    hit = sorted(row[0] for row in present.join(visits, "visit_id", "left_semi").select(month_column).distinct().collect())
    if hit:
        kept = remove_deleted_visits(month_filter(spark.table(table), month_column, hit), visits)
        replace_months_in_table(kept, table, hit, [name for name in CLICK_ORDER if name in kept.columns])


def _nothing_new(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([("status: nothing new landed", 0), ("source_rows", 0)], "metric string, value bigint")
