"""Column expressions. All of them are built-in functions, so they stay inside generated code."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from visitlake import schemas as S


def decode(labels: dict, code: Column | str) -> Column:
    """Label of a code, NULL when the code is not in the table."""
    pairs = ", ".join(f"{key}L, '{label}'" for key, label in labels.items())
    return F.try_element_at(F.expr(f"map({pairs})"), _col(code))


def real_date(year: str = "year", month: str = "month", day: str = "day") -> Column:
    """The calendar date, NULL when there is no such date (month 13, 31 April)."""
    leap = f"({year} % 4 = 0 AND {year} % 100 <> 0 OR {year} % 400 = 0)"
    last_day = f"CASE WHEN {month} = 2 THEN IF({leap}, 29, 28) WHEN {month} IN (4, 6, 9, 11) THEN 30 ELSE 31 END"
    exists = f"{year} BETWEEN 1 AND 9999 AND {month} BETWEEN 1 AND 12 AND {day} BETWEEN 1 AND {last_day}"
    return F.expr(f"CASE WHEN {exists} THEN make_date(CAST({year} AS INT), CAST({month} AS INT), CAST({day} AS INT)) END")


def month_of(date: Column | str) -> Column:
    """Month partition of a date, such as 2008-04."""
    return F.date_format(_col(date), "yyyy-MM")


def source_month(year="year", month="month") -> Column:
    """Month partition of a raw row. Years of other than four digits and months beyond 13 go to one named partition.

    A month 13 is kept as it is: such rows are known to occur and stay apart from rows that say nothing.
    """
    year, month = _col(year), _col(month)
    known = year.between(1000, 9999) & month.between(1, 13)
    return F.when(known, F.format_string("%04d-%02d", year, month)).otherwise(F.lit(S.UNKNOWN_MONTH))


def shop_local_time(utc: Column | str) -> Column:
    return F.from_utc_timestamp(_col(utc), S.SHOP_TIMEZONE)


def shop_time_to_utc(local: Column | str) -> Column:
    """Shop-local wall clock to UTC.

    A wall-clock time skipped by the spring change becomes the first valid instant after the gap; a time that
    happens twice in autumn means the second one (standard time). Shifts are whole hours on the hour.
    """
    local = _col(local)
    utc = F.to_utc_timestamp(local, S.SHOP_TIMEZONE)
    one_hour = F.expr("INTERVAL 1 HOUR")
    skipped = shop_local_time(utc) != local
    repeated = shop_local_time(utc + one_hour) == local
    first_valid = F.to_utc_timestamp(F.date_trunc("hour", local) + one_hour, S.SHOP_TIMEZONE)
    return F.when(skipped, first_valid).when(repeated, utc + one_hour).otherwise(utc)


def click_id(visit="visit_id", number="click_number_in_visit") -> Column:
    """Stable click id, NULL when either part is missing."""
    return F.concat(F.lit(S.CLICK_ID_PREFIX + "-"), _col(visit).cast("string"), F.lit("-"), _col(number).cast("string"))


def is_weekend(date: Column | str) -> Column:
    sunday, saturday = 1, 7
    return F.dayofweek(_col(date)).isin(sunday, saturday)


def seconds_between(start: Column | str, end: Column | str) -> Column:
    """Whole seconds from start to end, the fraction cut off. Lake tables hold UTC wall clock, so both kinds are read."""
    micros = F.unix_micros(_col(end).cast("timestamp")) - F.unix_micros(_col(start).cast("timestamp"))
    return F.call_function("div", micros, F.lit(1_000_000))


def country_kind(code: Column | str) -> Column:
    code = _col(code)
    return (F.when(code.isin(S.UNKNOWN_COUNTRY_CODES), "unknown")
            .when(code.isin(S.WEB_DOMAIN_COUNTRY_CODES), "web domain")
            .otherwise("country"))


def draw(seed: int, visit: Column | str, slot: Column | str) -> Column:
    """A repeatable number in [0, 1) for one visit and one purpose."""
    slot = F.lit(slot) if isinstance(slot, str) else slot
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), _col(visit).cast("string"), slot))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") / F.lit(2.0 ** 32)


def _col(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column
