"""Silver: one clean, decoded row per click; failing clicks are kept with a reason."""

import uuid
from datetime import datetime
from functools import cached_property

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from visitlake import schemas as S
from visitlake.functions import decode, is_weekend, month_of, seconds_between, shop_local_time, source_month
from visitlake.operators.resends import has_identity, remove_resends
from visitlake.operators.rules import (
    failing_visits, find_problems, late_clicks, reason_of_joined_row, with_row_rules,
)
from visitlake.operators.sequence import PIECE_BITS
from visitlake.session import staged
from visitlake.sources.raw_clicks import utc_literal


class Silver:
    """Clean clicks, rejects and the number of resends of a Bronze frame, each built when it is asked for.

    The rows left without resends are written to the scratch folder with their findings, and so are the failing clicks.
    All outputs read those: Bronze is read once and resends are removed once, however many outputs follow. Rows of erased
    visits, if a list of them is given, are left out there. ``counts``, once the rows are judged, has ``judged_rows`` (all
    rows left without resends) and ``erased_rows`` (those of erased visits among them), as the write itself observed them.
    """

    def __init__(self, bronze: DataFrame, run_time: datetime, bits: int = PIECE_BITS, erased: DataFrame | None = None):
        self._bronze, self._run_time, self._bits, self._erased = bronze, run_time, bits, erased
        self._observed = Observation(f"judged-{uuid.uuid4().hex}")

    @cached_property
    def _judged(self) -> tuple[DataFrame, DataFrame]:
        judged = judge(self._bronze)
        if self._erased is None:
            marked = judged.withColumn("_erased", F.lit(False))
        else:
            listed = self._erased.select("visit_id").distinct().withColumn("_erased", F.lit(True))
            marked = judged.join(listed, "visit_id", "left").withColumn("_erased", F.coalesce("_erased", F.lit(False)))
        # Observed behind the last shuffle, in the stage that writes.
        observed = marked.observe(self._observed, F.count("*").alias("judged_rows"), F.count_if("_erased").alias("erased_rows"))
        rows = staged(observed.filter("NOT _erased").select(judged.columns), "judged")
        return rows.filter(has_identity()), rows.filter(~has_identity())

    @property
    def counts(self) -> dict[str, int]:
        self._judged  # noqa: B018  the write is what is observed
        return self._observed.get

    @cached_property
    def problems(self) -> DataFrame:
        return staged(find_problems(*self._judged, self._bits), "problems")

    @cached_property
    def clicks(self) -> DataFrame:
        return clean_clicks(self._judged[0], self.problems)

    @cached_property
    def rejected(self) -> DataFrame:
        return rejected_clicks(*self._judged, self.problems, self._run_time)

    @cached_property
    def duplicates_removed(self) -> DataFrame:
        """One row: ``duplicates_removed``."""
        left = self._judged[0].agg(F.count("*").alias("rows")).unionByName(self._judged[1].agg(F.count("*").alias("rows")))
        counted = self._bronze.agg(F.count("*").alias("rows")).unionByName(left.select((-F.col("rows")).alias("rows")))
        return counted.agg(F.sum("rows").alias("duplicates_removed"))


def judge(bronze: DataFrame) -> DataFrame:
    """Rows with their own findings: the earliest copies of clicks, and rows without a full identity."""
    return remove_resends(with_row_rules(bronze))


def build_silver(bronze: DataFrame, run_time: datetime, bits: int = PIECE_BITS, erased: DataFrame | None = None) -> Silver:
    """Bronze to clean clicks and rejects. ``bits`` is the size of the pieces that ordered rules look at."""
    return Silver(bronze, run_time, bits, erased)


def clean_clicks(clicks: DataFrame, problems: DataFrame) -> DataFrame:
    """Clicks of visits without any failing click, decoded."""
    passing = clicks.join(failing_visits(problems).select("visit_id"), "visit_id", "left_anti")
    local = shop_local_time("click_time_synthetic")
    return passing.withColumns({
        "click_date": F.col("_real_date"),
        "click_hour_shop_time_synthetic": F.hour(local).cast("bigint"),
        "category": decode(S.CATEGORIES, "category_code"),
        "colour": decode(S.COLOURS, "colour_code"),
        "priced_above_category_average": F.col("price_above_category_average_code") == 1,
        "photo_position_on_page": decode(S.PHOTO_POSITIONS, "photo_position_code"),
        "photo_angle": decode(S.PHOTO_ANGLES, "photo_angle_code"),
        "seconds_late": seconds_between("click_time_synthetic", "received_time"),
        "click_month": month_of("_real_date"),
    }).select(S.SILVER_COLUMNS)


def rejected_clicks(clicks: DataFrame, nameless: DataFrame, problems: DataFrame, run_time: datetime) -> DataFrame:
    """Every click of a failing visit with its reason, and every row without a full identity.

    The landing month is kept when the frame carries it; otherwise it follows from the row's year and month.
    """
    in_failing_visit = (clicks.join(failing_visits(problems), "visit_id")
                        .join(late_clicks(problems), ["visit_id", "click_number_in_visit"], "left")
                        .withColumn("rejection_reason", reason_of_joined_row()))
    nameless = nameless.withColumn("rejection_reason", F.col("_row_reason"))
    month = F.col("source_month") if "source_month" in clicks.columns else source_month()
    return (in_failing_visit.select(*clicks.columns, "rejection_reason")
            .unionByName(nameless.select(*clicks.columns, "rejection_reason"))
            .withColumns({"rejected_time": utc_literal(run_time), "source_month": month})
            .select(S.REJECTED_COLUMNS))


def add_weekend_click(clicks: DataFrame) -> DataFrame:
    return clicks.withColumn("weekend_click", is_weekend("click_date"))
