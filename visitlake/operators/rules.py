"""Quality rules: the first failing rule is the recorded reason, and one failing click rejects its whole visit.

A rule that cannot be decided counts as failed. The rules come in this order: required fields, real date, seven code
ranges, the landing month where there is one, contiguous click numbers, time on the real date, increasing time, another
click of the visit rejected.

Rules about one row are plain expressions. Rules about neighbours look at one piece of a visit at a time
(``sequence``), on four narrow columns. What a visit needs to know about its other clicks is the short list of failing
visits, pre-aggregated before its shuffle and joined back; Spark broadcasts that list at run time when it is small
and otherwise splits skewed visits in the sort-merge join.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitlake import schemas as S
from visitlake.functions import real_date, shop_local_time
from visitlake.operators.resends import has_identity
from visitlake.operators.sequence import PIECE_BITS, with_previous_click


def range_reason(column: str) -> str:
    low, high = S.CODE_RANGES[column]
    return f"{column} outside {low}-{high}"


def row_rules() -> list[tuple[str, str]]:
    """Reason and failing condition of the rules before the contiguity rule. Conditions may be NULL."""
    missing = " OR ".join(f"{column} IS NULL" for column in S.REQUIRED_COLUMNS)
    ranges = [(range_reason(column), f"{column} NOT BETWEEN {low} AND {high}")
              for column, (low, high) in S.CODE_RANGES.items()]
    return [(S.MISSING_FIELD, missing), (S.INVALID_DATE, "_real_date IS NULL"), *ranges]


def all_reasons() -> list[str]:
    """Every reason that a reject can have."""
    return [reason for reason, _ in row_rules()] + [
        S.OTHER_MONTH, S.NOT_CONTIGUOUS, S.OUTSIDE_DATE, S.NOT_INCREASING, S.OTHER_CLICK]


def with_row_rules(clicks: DataFrame) -> DataFrame:
    """Add what each row shows by itself.

    ``_real_date``; ``_row_reason`` from the rules before the contiguity rule; ``_off_date`` from the rule about the
    time's date; ``_row_fails`` when any of them fails, so that narrow steps can leave the reason's text behind.
    """
    rules = row_rules()
    if "source_month" in clicks.columns:
        rules.append((S.OTHER_MONTH, "date_format(_real_date, 'yyyy-MM') <> source_month"))
    branches = " ".join(f"WHEN coalesce({failed}, TRUE) THEN '{reason}'" for reason, failed in rules)
    reason = F.expr(f"CASE {branches} END")
    off_date = F.coalesce(F.to_date(shop_local_time("click_time_synthetic")) != F.col("_real_date"), F.lit(True))
    return clicks.withColumn("_real_date", real_date()).withColumns({
        "_row_reason": reason, "_off_date": off_date, "_row_fails": reason.isNotNull() | off_date})


def with_neighbour_rules(identified: DataFrame, bits: int = PIECE_BITS) -> DataFrame:
    """Keys of identified rows with ``row_fails``, ``breaks_sequence`` and ``not_later``.

    Click numbers of a visit are 1..n exactly when each click either is number 1 or directly follows its predecessor,
    so a gap, a repeat or a wrong start shows at some click.
    """
    keys = identified.select("visit_id", "click_number_in_visit", "click_time_synthetic",
                             F.col("_row_fails").alias("row_fails"))
    number, previous = F.col("click_number_in_visit"), F.col("previous_number")
    first = previous.isNull() & (number == 1)
    follows = F.coalesce(F.try_add(previous, F.lit(1)) == number, F.lit(False))
    later = F.coalesce(F.col("click_time_synthetic") > F.col("previous_time"), F.lit(True))
    return with_previous_click(keys, bits).select(
        "visit_id", "click_number_in_visit", "row_fails",
        (~first & ~follows).alias("breaks_sequence"), (~later).alias("not_later"))


def find_problems(identified: DataFrame, nameless: DataFrame, bits: int = PIECE_BITS) -> DataFrame:
    """Only the failing clicks: ``visit_id, click_number_in_visit, row_fails, breaks_sequence, not_later``.

    ``nameless`` rows lack a part of their identity. One whose visit is known but whose number is missing breaks the
    sequence of that visit.
    """
    neighbours = with_neighbour_rules(identified, bits).filter("row_fails OR breaks_sequence OR not_later")
    of_visits = nameless.filter(F.col("visit_id").isNotNull()).select(
        "visit_id", "click_number_in_visit", F.lit(True).alias("row_fails"),
        F.col("click_number_in_visit").isNull().alias("breaks_sequence"), F.lit(False).alias("not_later"))
    return neighbours.unionByName(of_visits)


def failing_visits(problems: DataFrame) -> DataFrame:
    """One row per visit with a failing click: ``visit_id, broken``."""
    return problems.groupBy("visit_id").agg(F.max("breaks_sequence").alias("broken"))


def late_clicks(problems: DataFrame) -> DataFrame:
    """Clicks whose only own failure is not coming after their predecessor: the rule is the last one about a row."""
    return (problems.filter("not_later AND NOT breaks_sequence AND NOT row_fails")
            .select("visit_id", "click_number_in_visit", "not_later"))


def reason_of_joined_row() -> Column:
    """Reason of a row joined with ``failing_visits`` and ``late_clicks``."""
    return (F.when(F.col("_row_reason").isNotNull(), F.col("_row_reason"))
            .when(F.col("broken"), S.NOT_CONTIGUOUS)
            .when(F.col("_off_date"), S.OUTSIDE_DATE)
            .when(F.col("not_later"), S.NOT_INCREASING)
            .when(F.col("broken").isNotNull(), S.OTHER_CLICK))


def with_rejection_reason(clicks: DataFrame) -> DataFrame:
    """Every row of a frame without resends, with ``rejection_reason`` (NULL for a clean click)."""
    judged = with_row_rules(clicks)
    problems = find_problems(judged.filter(has_identity()), judged.filter(~has_identity()))
    return (judged
            .join(failing_visits(problems), "visit_id", "left")
            .join(late_clicks(problems), ["visit_id", "click_number_in_visit"], "left")
            .withColumn("rejection_reason", reason_of_joined_row())
            .select(*clicks.columns, "rejection_reason"))
