"""Independent SQL for the registered queries, run by another engine on the same tables. It shares no values with the jobs.

Every text is a chain of common table expressions over ``events`` (or ``documents``) and one final SELECT.
"""

from itertools import accumulate

from visitlake.plans import oracle_values as S

MONTHS = ["2024-01", "2024-02", "2024-03", "2024-04", "2024-05", "2024-06"]
MONTH_LIST = ", ".join(f"'{month}'" for month in MONTHS)
PICK_SEED = 20261020
ERASED_COUNTRY = 12

RAW = """
e AS (
  SELECT event_id, user_id, ts, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, user_id % 5 AS shift FROM events),
l AS (
  SELECT *, CAST(timezone('Europe/Warsaw', timezone('UTC', ts)) AS DATE) AS d0 FROM e),
n AS (
  SELECT *, user_id * 100 + CAST(extract(day FROM d0) AS BIGINT) AS visit_id,
    d0 + CAST(31 * shift AS INTEGER) AS rd, ts + to_days(CAST(31 * shift AS INTEGER)) AS click_time,
    CAST(row_number() OVER (PARTITION BY user_id, d0 ORDER BY ts, event_id) AS BIGINT) AS n_asc,
    CAST(row_number() OVER (PARTITION BY user_id, d0 ORDER BY ts DESC, event_id DESC) AS BIGINT) AS n_desc FROM l),
raw AS (
  SELECT event_id,
    CAST(extract(year FROM rd) AS BIGINT) AS year,
    CASE WHEN event_id % 401 = 0 THEN 13 ELSE CAST(extract(month FROM rd) AS BIGINT) END AS month,
    CASE WHEN event_id % 419 = 0 THEN 31 ELSE CAST(extract(day FROM rd) AS BIGINT) END AS day,
    CASE WHEN visit_id % 59 = 0 THEN n_desc WHEN visit_id % 53 = 0 AND n_asc >= 2 THEN n_asc + 1 ELSE n_asc END
      AS click_number_in_visit,
    CASE WHEN event_id % 211 = 0 THEN 99 ELSE 1 + user_id % 47 END AS country_code,
    visit_id,
    CASE WHEN event_id % 499 = 0 THEN 1 + (k + 1) % 4 ELSE 1 + k % 4 END AS category_code,
    CASE WHEN event_id % 307 = 0 THEN NULL ELSE concat('P', lpad(CAST(k AS VARCHAR), 2, '0')) END AS product_code,
    CASE WHEN event_id % 503 = 0 THEN 15 ELSE 1 + k % 14 END AS colour_code,
    1 + k % 6 AS photo_position_code,
    1 + k % 2 AS photo_angle_code,
    10 + (k * 7) % 73 AS price_usd,
    CAST(CASE WHEN k >= 50 THEN 1 ELSE 2 END AS BIGINT) AS price_above_category_average_code,
    1 + k % 5 AS page_number_in_shop,
    click_time
  FROM n)"""

REAL_DATE = "try_cast(printf('%04d-%02d-%02d', year, month, day) AS DATE)"
SOURCE_MONTH = "printf('%04d-%02d', year, month)"
PLAIN = ", ".join(S.PLAIN_COLUMNS)
TEXT_COLUMNS = ", ".join(f'CAST({plain} AS VARCHAR) AS "{source}"' for source, plain in S.SOURCE_TO_PLAIN.items())


def to_local(time):
    return f"timezone('{S.SHOP_TIMEZONE}', timezone('UTC', {time}))"


def to_utc(local):
    plain = f"timezone('UTC', timezone('{S.SHOP_TIMEZONE}', {local}))"
    next_hour = f"date_trunc('hour', {local}) + INTERVAL 1 HOUR"
    return (f"CASE WHEN {to_local(plain)} <> {local} THEN timezone('UTC', timezone('{S.SHOP_TIMEZONE}', {next_hour})) "
            f"WHEN {to_local(f'({plain} + INTERVAL 1 HOUR)')} = {local} THEN {plain} + INTERVAL 1 HOUR ELSE {plain} END")


def draw(slot, seed=S.DEFAULT_SEED):
    return f"(('0x' || substr(md5(concat_ws('|', '{seed}', visit_id, {slot})), 1, 8))::BIGINT / 4294967296.0)"


def decode(labels, column):
    return f"CASE {column} " + " ".join(f"WHEN {code} THEN '{label}'" for code, label in labels.items()) + " END"


def whole_seconds(start, end):
    return f"CAST(trunc((epoch_us({end}) - epoch_us({start})) / 1000000.0) AS BIGINT)"


DEVICE = (f"CASE WHEN {draw(repr('device'))} < 0.85 THEN 'desktop' "
          f"WHEN {draw(repr('device'))} < 0.95 THEN 'mobile' ELSE 'tablet' END")
HOUR = "CASE " + " ".join(
    f"WHEN {draw(repr('hour'))} * {sum(S.HOUR_WEIGHTS)} < {bound} THEN {hour}"
    for hour, bound in enumerate(accumulate(S.HOUR_WEIGHTS))) + " END"

ONCE = f"""
once AS (
  SELECT {PLAIN}, concat('uci553-', visit_id, '-', click_number_in_visit) AS click_id,
    click_time AS click_time_synthetic, {DEVICE} AS device_type_synthetic,
    TIMESTAMP '2024-07-01 12:00:00' AS received_time, 'uci553' AS data_source, event_id
  FROM raw)"""
BRONZE = f"""{ONCE},
bronze AS (
  SELECT * FROM once
  UNION ALL
  SELECT * REPLACE (received_time + INTERVAL 1 SECOND AS received_time) FROM once WHERE event_id % 100 = 0)"""

MISSING = " OR ".join(f"{column} IS NULL" for column in S.REQUIRED_COLUMNS)
RANGES = "\n      ".join(f"WHEN {column} NOT BETWEEN {low} AND {high} THEN '{column} outside {low}-{high}'"
                         for column, (low, high) in S.CODE_RANGES.items())
JUDGED = f"""
unique_clicks AS (
  SELECT * FROM bronze QUALIFY row_number() OVER (PARTITION BY click_id ORDER BY received_time) = 1),
seen AS (
  SELECT *, {REAL_DATE} AS real_date, {to_local("click_time_synthetic")} AS local_time,
    min(click_number_in_visit) OVER v = 1 AND max(click_number_in_visit) OVER v = count(*) OVER v AS contiguous,
    lag(click_time_synthetic) OVER (PARTITION BY visit_id ORDER BY click_number_in_visit) AS previous_time
  FROM unique_clicks WINDOW v AS (PARTITION BY visit_id)),
own AS (
  SELECT *, CASE WHEN {MISSING} THEN '{S.MISSING_FIELD}'
      WHEN real_date IS NULL THEN '{S.INVALID_DATE}'
      {RANGES}
      WHEN NOT contiguous THEN '{S.NOT_CONTIGUOUS}'
      WHEN coalesce(CAST(local_time AS DATE) <> real_date, TRUE) THEN '{S.OUTSIDE_DATE}'
      WHEN click_time_synthetic <= previous_time THEN '{S.NOT_INCREASING}' END AS own_reason
  FROM seen),
judged AS (
  SELECT *, CASE WHEN own_reason IS NOT NULL THEN own_reason
      WHEN bool_or(own_reason IS NOT NULL) OVER (PARTITION BY visit_id) THEN '{S.OTHER_CLICK}' END AS rejection_reason
  FROM own),
rejected AS (
  SELECT * EXCLUDE (real_date, local_time, contiguous, previous_time, own_reason, event_id),
    TIMESTAMP '2024-07-02 00:00:00' AS rejected_time, {SOURCE_MONTH} AS source_month
  FROM judged WHERE rejection_reason IS NOT NULL),
clicks AS (
  SELECT click_id, visit_id, click_number_in_visit, real_date AS click_date, click_time_synthetic,
    CAST(extract(hour FROM local_time) AS BIGINT) AS click_hour_shop_time_synthetic, product_code,
    {decode(S.CATEGORIES, "category_code")} AS category, {decode(S.COLOURS, "colour_code")} AS colour, price_usd,
    price_above_category_average_code = 1 AS priced_above_category_average, page_number_in_shop,
    {decode(S.PHOTO_POSITIONS, "photo_position_code")} AS photo_position_on_page,
    {decode(S.PHOTO_ANGLES, "photo_angle_code")} AS photo_angle, country_code, device_type_synthetic, received_time,
    {whole_seconds("click_time_synthetic", "received_time")} AS seconds_late,
    strftime(real_date, '%Y-%m') AS click_month
  FROM judged WHERE rejection_reason IS NULL)"""
VISITS = f"""
visits AS (
  SELECT visit_id, arg_min(click_date, click_number_in_visit) AS visit_date,
    arg_min(country_code, click_number_in_visit) AS country_code,
    arg_min(device_type_synthetic, click_number_in_visit) AS device_type_synthetic,
    min(click_time_synthetic) AS visit_start_time_synthetic, max(click_time_synthetic) AS visit_end_time_synthetic,
    {whole_seconds("min(click_time_synthetic)", "max(click_time_synthetic)")} AS visit_length_seconds_synthetic,
    count(*) AS clicks_in_visit, count(DISTINCT product_code) AS products_viewed,
    count(DISTINCT category) AS categories_viewed, max(page_number_in_shop) AS deepest_page_reached,
    count(*) = 1 AS bounced, arg_min(product_code, click_number_in_visit) AS first_product_viewed,
    arg_max(product_code, click_number_in_visit) AS last_product_viewed,
    strftime(arg_min(click_date, click_number_in_visit), '%Y-%m') AS visit_month
  FROM clicks GROUP BY visit_id)"""
PRODUCTS = """
per_category AS (
  SELECT product_code, category, count(*) AS clicks FROM clicks GROUP BY ALL),
winner AS (
  SELECT product_code, category FROM per_category
  QUALIFY row_number() OVER (PARTITION BY product_code ORDER BY clicks DESC, category) = 1),
first_click AS (
  SELECT * FROM clicks QUALIFY row_number() OVER (PARTITION BY product_code ORDER BY visit_id, click_number_in_visit) = 1),
products AS (
  SELECT f.product_code, w.category, f.colour, f.price_usd, f.priced_above_category_average, f.page_number_in_shop,
    f.photo_position_on_page, f.photo_angle
  FROM first_click f JOIN winner w USING (product_code)),
mismatches AS (
  SELECT c.click_id, c.product_code, c.category AS click_category, p.category AS product_category
  FROM clicks c JOIN products p USING (product_code) WHERE c.category <> p.category)"""
COUNTRIES = "\ncountries AS (SELECT * FROM (VALUES " + ", ".join(
    "({}, '{}', '{}')".format(
        code, name, "unknown" if code in S.UNKNOWN_COUNTRY_CODES
        else "web domain" if code in S.WEB_DOMAIN_COUNTRY_CODES else "country")
    for code, name in S.COUNTRIES.items()) + ") t(country_code, country_name, kind))"
PICKED = f"""
picked AS (
  SELECT visit_id, click_month FROM clicks WHERE click_month <> '2024-06'
  ORDER BY md5(concat_ws('|', '{PICK_SEED}', visit_id)), click_month LIMIT 1)"""
# The generated fields, and Bronze and Silver built on them (no resends: one arrival time per run).
GENERATED = f"""
dated AS (
  SELECT visit_id, click_number_in_visit, min({REAL_DATE}) AS d FROM raw
  WHERE {REAL_DATE} IS NOT NULL GROUP BY visit_id, click_number_in_visit),
gaps AS (
  SELECT *, 5 + CAST(floor({draw("'gap' || click_number_in_visit")} * 296) AS BIGINT) AS gap FROM dated),
offsets AS (
  SELECT *, CAST(sum(gap) OVER o AS BIGINT) - first_value(gap) OVER o AS elapsed, first_value(d) OVER o AS first_day
  FROM gaps WINDOW o AS (PARTITION BY visit_id ORDER BY click_number_in_visit)),
placed AS (
  SELECT *, greatest(0, least({HOUR} * 3600 + CAST(floor({draw("'sec'")} * 3600) AS BIGINT),
    86399 - max(elapsed) OVER (PARTITION BY visit_id))) + elapsed AS second_of_day FROM offsets),
walls AS (
  SELECT visit_id, click_number_in_visit, CAST(first_day AS TIMESTAMP) + to_seconds(second_of_day) AS wall FROM placed),
times AS (
  SELECT visit_id, click_number_in_visit, {to_utc("wall")} AS generated_time FROM walls),
generated AS (
  SELECT {PLAIN}, concat('uci553-', visit_id, '-', click_number_in_visit) AS click_id,
    CASE WHEN {REAL_DATE} IS NOT NULL THEN generated_time END AS click_time_synthetic,
    CASE WHEN {REAL_DATE} IS NOT NULL THEN {DEVICE} END AS device_type_synthetic
  FROM raw LEFT JOIN times USING (visit_id, click_number_in_visit))"""
LANDED_BRONZE = f"""
bronze AS (
  SELECT *, TIMESTAMP '2024-07-02 00:00:00' AS received_time, 'uci553' AS data_source, 0 AS event_id
  FROM generated)"""
# A run with a list of erased visits: they are counted and left out.
LISTED_BRONZE = LANDED_BRONZE.replace("bronze AS", "all_bronze AS") + f""",
listed AS (SELECT DISTINCT visit_id FROM raw WHERE country_code = {ERASED_COUNTRY}),
bronze AS (SELECT * FROM all_bronze WHERE visit_id NOT IN (SELECT visit_id FROM listed))"""

FLOW = [RAW, BRONZE, JUDGED]
GOLD = FLOW + [VISITS]
LANDED = [RAW, GENERATED, LANDED_BRONZE, JUDGED]
LAKE = LANDED + [VISITS]
REPORTED = [RAW, GENERATED, LISTED_BRONZE, JUDGED, VISITS, PRODUCTS]


def text(parts, select):
    return "WITH " + ",".join(parts) + "\n" + select


def metrics(**values):
    return "\nUNION ALL\n".join(
        f"SELECT '{name}' AS metric, CAST(({value}) AS BIGINT) AS value" for name, value in values.items())


def totals(**tables):
    return metrics(**{name: f"SELECT count(*) FROM {source}" for name, source in tables.items()})


# The masking patterns without look-around: the character before a match is captured and put back.
def _masked(column):
    bucket = r"(^|[^a-zA-Z0-9-])[a-zA-Z0-9][a-zA-Z0-9-]*?-{role}bucket-[a-zA-Z0-9]+"
    any_role = bucket.replace("{role}", "((?i:bronze|silver|gold|athenaresults))")
    out = rf"regexp_replace({column}, '{any_role}', '\1' || chr(57344) || '\2' || chr(57344), 'g')"
    for role, label in (("bronze", "bronze"), ("silver", "silver"), ("gold", "gold"), ("athenaresults", "athena-results")):
        out = f"regexp_replace({out}, chr(57344) || '(?i:{role})' || chr(57344), '<{label}-bucket>', 'g')"
    out = mask_arn(out)
    out = mask_email(out)
    account = r"(^|[^0-9])[0-9]{12}([^0-9]|$)"
    for _ in range(2):
        out = rf"regexp_replace({out}, '{account}', '\1<account-id>\2', 'g')"
    return out


def mask_arn(column):
    return rf"""regexp_replace({column}, 'arn:aws[a-z-]*:[^\s"'']+', '<arn>', 'g')"""


def mask_email(column):
    return rf"regexp_replace({column}, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{{2,}}', '<email>', 'g')"


def mask_version(column):
    return rf"""regexp_replace({column}, '("?VersionId"?\s*[:=]\s*"?)([^\s",}}]+)', '\1<version-id>', 'g')"""


# Texts with identifiers behind them; each kind has a near miss.
TAGGED = """
ids AS (SELECT doc_id, text, CAST(doc_id AS VARCHAR) AS d, lpad(CAST(doc_id AS VARCHAR), 12, '7') AS account FROM documents),
tagged AS (
  SELECT doc_id, text || ' arn:aws:s3:::b' || d || '/k arn:awful x' || d || '-Silverbucket-q' || d || ' silverbucket-z '
    || account || ' 1' || account || ' u' || d || '@mail.example u' || d || '@x uci553-' || d || '-3 uci553-' || d
    || '1-3 "VersionId": "v' || d || '" {"visit_id": ' || d || ', "visit_id":"' || d || '", "id": ' || d || '}' AS text
  FROM ids)"""

SILVER_LIST = ", ".join(S.SILVER_COLUMNS)
REJECTED_LIST = ", ".join(S.REJECTED_COLUMNS)
WEEKEND = "extract(isodow FROM click_date) IN (6, 7)"
EVOLVED = f"""
evolved AS (
  SELECT *, CASE WHEN click_month IN ('2024-05', '2024-06') THEN {WEEKEND} END AS weekend_click FROM clicks)"""
ERASED = f"""
kept AS (
  SELECT * FROM clicks WHERE visit_id NOT IN (SELECT visit_id FROM visits WHERE country_code = {ERASED_COUNTRY}))"""
BY_MONTH = "SELECT {month}, count(*) AS {name} FROM {table} GROUP BY {month}"
RATE = "round(CAST(sum(CASE WHEN bounced THEN 1 ELSE 0 END) AS DOUBLE) / count(*), 4)"

CALENDAR = "SELECT DISTINCT click_date AS calendar_date, dayname(click_date) AS day_of_week, CAST(weekofyear(click_date) AS BIGINT) AS week_number, monthname(click_date) AS month_name FROM clicks"
DAILY = f"SELECT visit_date, count(*) AS visits, CAST(sum(clicks_in_visit) AS BIGINT) AS clicks, {RATE} AS bounce_rate FROM visits GROUP BY visit_date"
FUNNEL = "SELECT p.shop_page, count(v.visit_id) AS visits_reaching_page FROM (SELECT unnest(range(1, 6)) AS shop_page) p LEFT JOIN visits v ON v.deepest_page_reached >= p.shop_page GROUP BY p.shop_page"
BY_PRODUCT = f"SELECT first_product_viewed AS product_code, count(*) AS visits_started, CAST(sum(CASE WHEN bounced THEN 1 ELSE 0 END) AS BIGINT) AS visits_bounced, {RATE} AS bounce_rate FROM visits GROUP BY 1"
BY_COUNTRY = "SELECT v.country_code, n.country_name, v.device_type_synthetic, count(*) AS visits FROM visits v JOIN countries n ON n.country_code = v.country_code GROUP BY ALL"
REPORT = totals(
    source_rows="all_bronze", bronze_rows="all_bronze", rejected_rows="rejected", silver_clicks="clicks", visits="visits",
    category_mismatches="mismatches", total_silver_clicks="clicks", total_visits="visits") + "\nUNION ALL\n" + metrics(
    duplicates_removed="SELECT count(*) - count(DISTINCT click_id) FROM all_bronze",
    deleted_visits_removed="SELECT count(*) FROM all_bronze WHERE visit_id IN (SELECT visit_id FROM listed)",
    one_click_visits="SELECT count(*) FROM visits WHERE bounced",
    unaccounted="SELECT count(DISTINCT click_id) - count(DISTINCT click_id) FILTER (visit_id IN (SELECT visit_id FROM listed))"
                " - (SELECT count(*) FROM rejected) - (SELECT count(*) FROM clicks) FROM all_bronze") + f"""
UNION ALL SELECT 'rejected: ' || rejection_reason, count(*) FROM rejected GROUP BY rejection_reason
UNION ALL SELECT DISTINCT 'source_month: ' || {SOURCE_MONTH}, 1 FROM raw"""
LAKE_COUNTS = totals(total_silver_clicks="clicks", total_visits="visits", total_rejected="rejected", products="products", calendar_days="(SELECT DISTINCT click_date FROM clicks)") + "\nUNION ALL\n" + metrics(
    clicks_of_may="SELECT count(*) FROM clicks WHERE click_month = '2024-05'", weekend_clicks=f"SELECT count(*) FROM clicks WHERE {WEEKEND}", seconds_late="SELECT sum(seconds_late) FROM clicks")
FROM_SOURCE = "\nUNION ALL\n".join(
    f"SELECT '{name}' AS metric, count(*) AS value, '{scope}' AS scope FROM {table} WHERE {kept}"
    for scope, kept in (("all", "TRUE"), ("without_visit", "visit_id NOT IN (SELECT visit_id FROM picked)"))
    for name, table in (("bronze_rows", "bronze"), ("silver_clicks", "clicks"), ("rejected_rows", "rejected"), ("visits", "visits")))

def by_month(table, month, name):
    return BY_MONTH.format(table=table, month=month, name=name)


def oracle_sql() -> dict[str, str]:
    rejected_for = lambda *reasons: (
        "SELECT click_id, rejection_reason FROM rejected WHERE rejection_reason IN ("
        + ", ".join(f"'{reason}'" for reason in reasons) + ")")
    profile = metrics(
        rows="SELECT count(*) FROM raw",
        nulls="SELECT " + " + ".join(f"count(*) FILTER ({name} IS NULL)" for name in S.PLAIN_COLUMNS) + " FROM raw",
        duplicate_rows=f"SELECT count(*) - (SELECT count(*) FROM (SELECT DISTINCT {PLAIN} FROM raw)) FROM raw",
        visits="SELECT count(*) FROM lengths", longest_visit="SELECT max(clicks) FROM lengths",
        one_click_visits="SELECT count(*) FROM lengths WHERE clicks = 1",
        days="SELECT count(*) FROM (SELECT DISTINCT year, month, day FROM raw)",
        **{f"distinct_{name}": f"SELECT count(DISTINCT {name}) FROM raw" for name in S.PLAIN_COLUMNS})
    constancy = [("visit_id", "country_code")] + [("product_code", name) for name in (
        "colour_code", "price_usd", "price_above_category_average_code", "photo_position_code", "photo_angle_code",
        "page_number_in_shop")]
    profile_text = text([RAW, "\nlengths AS (SELECT visit_id, count(*) AS clicks FROM raw GROUP BY visit_id)"],
                        f"SELECT metric, CAST(value AS DOUBLE) AS value FROM ({profile}) UNION ALL SELECT 'median_visit', median(clicks) FROM lengths")
    return {
        # Scans, sources, sinks
        "source_scan": text([RAW], f"SELECT {TEXT_COLUMNS} FROM raw"),
        "source_plain": text([RAW], f"SELECT * REPLACE (CASE WHEN price_usd < 20 THEN NULL ELSE price_usd END AS price_usd) FROM (SELECT {PLAIN} FROM raw)"),
        "incremental_new_files": text([RAW], f"SELECT {SOURCE_MONTH} AS source_month, count(*) AS row_count FROM raw WHERE {SOURCE_MONTH} IN ('2024-04', '2024-05', '2024-06') GROUP BY 1"),
        "stream_new_files": text([RAW], f"SELECT {SOURCE_MONTH} AS source_month, count(*) AS row_count, CAST(sum(price_usd) AS BIGINT) AS price_usd FROM raw GROUP BY 1"),
        "land_by_month": text([RAW], f"SELECT {TEXT_COLUMNS}, {SOURCE_MONTH} AS source_month FROM raw WHERE {SOURCE_MONTH} IN ({MONTH_LIST})"),
        "month_overwrite": text(FLOW, "SELECT click_id, click_month, price_usd + CASE WHEN click_month = '2024-02' THEN 1000 ELSE 0 END AS price_usd FROM clicks"),
        "whole_rebuild": text(FLOW + [PRODUCTS], "SELECT * FROM products"),
        "schema_following_write": text(FLOW, f"SELECT {SILVER_LIST} FROM clicks"),
        "read_all_months": text(GOLD, "SELECT * FROM visits"),
        "month_scan": text(FLOW, f"SELECT {SILVER_LIST} FROM clicks WHERE click_month = '2024-03'"),
        "schema_evolution": text(FLOW + [EVOLVED], f"SELECT {SILVER_LIST}, weekend_click FROM evolved"),
        "ref_countries": text(FLOW + [COUNTRIES], "SELECT n.country_code, n.country_name, n.kind, count(c.click_id) AS clicks FROM countries n LEFT JOIN clicks c USING (country_code) GROUP BY ALL"),
        "ref_devices": text(FLOW, "SELECT d.device_type, count(c.click_id) AS clicks FROM (VALUES ('desktop'), ('mobile'), ('tablet')) d(device_type) LEFT JOIN clicks c ON c.device_type_synthetic = d.device_type GROUP BY ALL"),
        # Projections and scalar functions
        "bronze_arrival": text([RAW, ONCE], f"SELECT {', '.join(S.BRONZE_COLUMNS)} FROM once"),
        "decode_codes": text([RAW], f"SELECT event_id, {decode(S.CATEGORIES, 'category_code')} AS category, {decode(S.COLOURS, 'colour_code')} AS colour, {decode(S.PHOTO_POSITIONS, 'photo_position_code')} AS photo_position, {decode(S.PHOTO_ANGLES, 'photo_angle_code')} AS photo_angle FROM raw"),
        "real_date": text([RAW], f"SELECT event_id, {REAL_DATE} AS real_date FROM raw"),
        "shop_local_hour": text([RAW], f"SELECT event_id, {to_local('click_time')} AS shop_time, CAST(extract(hour FROM {to_local('click_time')}) AS BIGINT) AS shop_hour FROM raw"),
        "local_to_utc": text([RAW, f"\nwalls AS (SELECT event_id, CASE WHEN price_usd % 2 = 0 THEN click_time + to_days(240) ELSE click_time END AS wall FROM raw)"], f"SELECT event_id, {to_utc('wall')} AS utc_time FROM walls"),
        "click_id": text([RAW], "SELECT event_id, CASE WHEN product_code IS NOT NULL THEN concat('uci553-', visit_id, '-', click_number_in_visit) END AS click_id FROM raw"),
        "month_key": text([RAW], f"SELECT event_id, strftime({REAL_DATE}, '%Y-%m') AS click_month, CASE WHEN product_code IS NULL THEN 'unknown' ELSE {SOURCE_MONTH} END AS source_month FROM raw"),
        "weekend_click": text(FLOW, f"SELECT click_id, {WEEKEND} AS weekend_click FROM clicks"),
        "seconds_late": text(FLOW, "SELECT click_id, seconds_late FROM clicks"),
        "calendar_days": text(FLOW, CALENDAR),
        "summary_types": text(GOLD, "SELECT visit_month, CAST(sum(clicks_in_visit) AS DOUBLE) / 100 AS hundred_clicks, count(*) AS visits FROM visits GROUP BY visit_month"),
        "reject_missing": text(FLOW, rejected_for(S.MISSING_FIELD, S.INVALID_DATE)),
        "reject_ranges": text(FLOW, "SELECT click_id, rejection_reason FROM rejected WHERE rejection_reason LIKE '% outside %-%'"),
        "gold_clicks": text(FLOW, f"SELECT {', '.join(S.GOLD_CLICK_COLUMNS)} FROM clicks"),
        # Joins
        "category_mismatches": text(FLOW + [PRODUCTS], "SELECT * FROM mismatches"),
        "remove_deleted_visits": text(GOLD + [ERASED], f"SELECT {SILVER_LIST} FROM kept"),
        "visits_by_country_and_device": text(GOLD + [COUNTRIES], BY_COUNTRY),
        "visit_depth_funnel": text(GOLD, FUNNEL),
        "reconcile_months": text(FLOW + [f"\na AS (SELECT {SOURCE_MONTH} AS m, count(*) AS expected FROM raw GROUP BY 1)", "\nb AS (SELECT click_month AS m, count(*) AS actual FROM clicks GROUP BY 1)"], "SELECT coalesce(a.m, b.m) AS month, expected, actual, expected IS NOT DISTINCT FROM actual AS matches FROM a FULL OUTER JOIN b ON a.m = b.m"),
        # Aggregations
        "visits": text(GOLD, "SELECT * FROM visits"),
        "products": text(FLOW + [PRODUCTS], "SELECT * FROM products"),
        "bronze_rows_by_month": text([RAW, BRONZE], f"SELECT {SOURCE_MONTH} AS source_month, count(*) AS row_count FROM bronze GROUP BY 1"),
        "silver_clicks_by_month": text(FLOW, by_month("clicks", "click_month", "clicks")),
        "rejected_by_month": text(FLOW, by_month("rejected", "source_month", "rejected")),
        "gold_visits_by_month": text(GOLD, by_month("visits", "visit_month", "visits")),
        "gold_clicks_by_month": text(FLOW, by_month("clicks", "click_month", "clicks")),
        "daily_visits": text(GOLD, DAILY),
        "bounce_rate_by_product": text(GOLD, BY_PRODUCT),
        "null_share_by_month": text(FLOW + [EVOLVED], "SELECT click_month, avg(CASE WHEN weekend_click IS NULL THEN 1.0 ELSE 0.0 END) AS null_share FROM evolved GROUP BY 1"),
        "quality_counts": text(GOLD + [PRODUCTS], totals(source_rows="raw", bronze_rows="bronze", rejected_rows="rejected", silver_clicks="clicks", visits="visits", category_mismatches="mismatches") + "\nUNION ALL\n" + metrics(duplicates_removed="SELECT (SELECT count(*) FROM bronze) - count(*) FROM unique_clicks", one_click_visits="SELECT count(*) FROM visits WHERE bounced")),
        "rejections_by_reason": text(FLOW, "SELECT rejection_reason, count(*) AS rejected FROM rejected GROUP BY 1"),
        "source_months": text([RAW], f"SELECT DISTINCT {SOURCE_MONTH} AS source_month FROM raw"),
        "rejected_rows": text(FLOW, "SELECT 'all' AS scope, count(*) AS rejected FROM rejected"),
        "visit_row_counts": text(GOLD + [PICKED], "\nUNION ALL\n".join(f"SELECT '{name}' AS table_name, count(*) AS row_count FROM {table} WHERE visit_id IN (SELECT visit_id FROM picked)" for name, table in (("silver_clicks", "clicks"), ("silver_clicks_rejected", "rejected"), ("gold_visits", "visits")))),
        "weekend_mismatches": text(FLOW + [EVOLVED], f"SELECT count(*) FILTER (weekend_click IS DISTINCT FROM ({WEEKEND})) AS mismatched_rows, count(*) AS rows_checked FROM evolved"),
        "dataset_profile": profile_text,
        "lake_profile": profile_text,
        "constancy_violations": text([RAW], "\nUNION ALL\n".join(f"SELECT '{key}' AS key_name, CAST({key} AS VARCHAR) AS key, '{name}' AS attribute, count(DISTINCT {name}) AS distinct_values FROM raw WHERE {key} IS NOT NULL GROUP BY {key} HAVING count(DISTINCT {name}) > 1" for key, name in constancy)),
        # Windows
        "dedup_resends": text([RAW, BRONZE, "\nunique_clicks AS (SELECT * FROM bronze QUALIFY row_number() OVER (PARTITION BY click_id ORDER BY received_time) = 1)"], f"SELECT {', '.join(S.BRONZE_COLUMNS)} FROM unique_clicks"),
        "duplicates_removed": text([RAW, BRONZE], "SELECT count(*) - count(DISTINCT click_id) AS duplicates_removed FROM bronze"),
        "reject_contiguity": text(FLOW, rejected_for(S.NOT_CONTIGUOUS)),
        "reject_time_order": text(FLOW, rejected_for(S.OUTSIDE_DATE, S.NOT_INCREASING)),
        "reject_whole_visit": text(FLOW, rejected_for(S.OTHER_CLICK)),
        # Sort, limit, set operations
        "pick_visit": text(FLOW + [PICKED], "SELECT * FROM picked"),
        "simulate_resends": text([RAW, ONCE], "SELECT click_id, received_time FROM once UNION ALL SELECT click_id, received_time + INTERVAL 1 SECOND FROM once WHERE ('0x' || substr(md5(click_id), 1, 8))::BIGINT % 50 = 0"),
        # Composite operators
        "rejection_reasons": text(FLOW, "SELECT click_id, rejection_reason FROM judged"),
        "rejected_clicks": text(FLOW, f"SELECT {REJECTED_LIST} FROM rejected"),
        "silver_clicks": text(FLOW, f"SELECT {SILVER_LIST} FROM clicks"),
        "synthetic_fields": text([RAW, GENERATED], "SELECT * FROM generated"),
        "increment": text(LANDED + [VISITS], totals(source_rows="bronze", bronze_rows="bronze", silver_clicks="clicks", rejected_rows="rejected", gold_clicks="clicks", visits="visits", source_months=f"(SELECT DISTINCT {SOURCE_MONTH} FROM bronze)")),
        "run_increment": text(LAKE + [PRODUCTS], LAKE_COUNTS),
        "stream_increment": text(LAKE + [PRODUCTS], LAKE_COUNTS),
        "run_resume": text(LAKE + [PRODUCTS], f"SELECT metric, value, stopped_after FROM ({LAKE_COUNTS}) CROSS JOIN (VALUES ('silver'), ('gold')) s(stopped_after)"),
        "atomic_month": text(FLOW, f"SELECT {SILVER_LIST} FROM clicks"),
        "file_difference": text(FLOW, "SELECT click_month, status, count(*) AS record_count FROM clicks JOIN (VALUES ('added'), ('removed'), ('unchanged')) s(status) ON CASE click_month WHEN '2024-02' THEN status <> 'unchanged' WHEN '2024-03' THEN status = 'removed' ELSE status = 'unchanged' END GROUP BY ALL"),
        "silver_file_order": text(LAKE, "SELECT click_month, count(*) AS rows, count(*) FILTER (visit_id IS NULL) AS inversions FROM clicks GROUP BY 1"),
        "erase_visit": text(LANDED + [VISITS, ERASED], f"SELECT {SILVER_LIST} FROM kept"),
        "compact_month": text(FLOW, f"SELECT {SILVER_LIST} FROM clicks"),
        "run_report": text(REPORTED, REPORT),
        "lake_products": text(LAKE + [PRODUCTS], "SELECT * FROM products"),
        "lake_calendar": text(LAKE, CALENDAR),
        "lake_daily_visits": text(LAKE, DAILY),
        "lake_visit_depth_funnel": text(LAKE, FUNNEL),
        "lake_bounce_rate_by_product": text(LAKE, BY_PRODUCT),
        "lake_visits_by_country_and_device": text(LAKE + [COUNTRIES], BY_COUNTRY),
        "files_for_month": text(FLOW, "SELECT click_month, count(*) AS record_count, count(*) > 0 AS sound FROM clicks GROUP BY 1"),
        "mask_email": text([TAGGED], f"SELECT doc_id, {mask_email('text')} AS masked FROM tagged"),
        "mask_arn": text([TAGGED], f"SELECT doc_id, {mask_arn('text')} AS masked FROM tagged"),
        "mask_text": text([TAGGED], f"SELECT doc_id, {_masked('text')} AS masked FROM tagged"),
        "mask_visit": text([TAGGED], f"SELECT doc_id, replace({mask_version(_masked('text'))}, 'uci553-' || doc_id || '-', 'uci553-visit A-') AS masked FROM tagged"),
        "mask_visit_fields": text([TAGGED], "SELECT doc_id, regexp_replace(text, '(\"visit_id\"\\s*:\\s*)(\"[^\"]*\"|-?[0-9.]+)', '\\1\"visit A\"', 'g') AS masked FROM tagged"),
        "counts_from_source": text(GOLD + [PICKED], FROM_SOURCE),
        "gate_checks": text(GOLD + [EVOLVED, PICKED], GATE),
        "counts_without_visit": text(GOLD + [PICKED], "SELECT click_month, count(*) AS clicks FROM clicks WHERE visit_id NOT IN (SELECT visit_id FROM picked) GROUP BY 1"),
    }


GATE = f"""
SELECT 'visits_match_clicks' AS "check", '0' AS expected, CAST((
    SELECT count(*) FROM (SELECT click_month AS m, count(DISTINCT visit_id) AS a FROM clicks GROUP BY 1) x
    FULL OUTER JOIN (SELECT visit_month AS m, count(*) AS b FROM visits GROUP BY 1) y USING (m)
    WHERE a IS DISTINCT FROM b) AS VARCHAR) AS actual, (SELECT count(DISTINCT visit_id) FROM clicks)
    = (SELECT count(*) FROM visits) AS pass
UNION ALL
SELECT 'weekend_values', '0', CAST((SELECT count(*) FROM evolved WHERE weekend_click IS DISTINCT FROM ({WEEKEND})) AS VARCHAR),
    (SELECT count(*) FROM evolved WHERE weekend_click IS DISTINCT FROM ({WEEKEND})) = 0
UNION ALL
SELECT 'no_rejects', '0', CAST((SELECT count(*) FROM rejected) AS VARCHAR), (SELECT count(*) FROM rejected) = 0
UNION ALL
SELECT 'visit_removed', '0', CAST(n AS VARCHAR), n = 0 FROM (
    SELECT count(*) FILTER (visit_id IN (SELECT visit_id FROM picked)) AS n FROM clicks ANTI JOIN picked USING (visit_id))
UNION ALL
SELECT 'missing_fact', '1', fact, coalesce(fact = '1', FALSE) FROM (
    SELECT max('1') AS fact FROM rejected WHERE rejection_reason IS NULL)
UNION ALL
SELECT 'files_unchanged_across_migration', '0', CAST(count(*) FILTER (click_id IS NULL) AS VARCHAR), count(*) > 0 FROM clicks
UNION ALL
SELECT 'files_replaced', '0', CAST(count(*) FILTER (click_id IS NULL) AS VARCHAR), count(*) > 0 FROM clicks
UNION ALL
SELECT 'run_input_files', '4', CAST(n AS VARCHAR), n = 4 FROM (
    SELECT count(DISTINCT month_name) AS n FROM (SELECT printf('%04d-%02d', year, month) AS month_name FROM raw)
    WHERE month_name NOT IN ('2024-01', '2024-02', '2024-03'))
UNION ALL
SELECT 'other_visits_unchanged', '0', CAST(n AS VARCHAR), n = 0 FROM (
    SELECT count(*) FILTER (a IS DISTINCT FROM b) AS n
    FROM (SELECT visit_id, count(*) AS a FROM clicks WHERE visit_id NOT IN (SELECT visit_id FROM picked) GROUP BY 1) x
    FULL OUTER JOIN (SELECT visit_id, count(*) AS b FROM clicks ANTI JOIN picked USING (visit_id) GROUP BY 1) y USING (visit_id))
UNION ALL
SELECT 'final_clicks', CAST(a AS VARCHAR), CAST(b AS VARCHAR), a = b FROM (
    SELECT (SELECT count(*) FROM clicks) - (SELECT count(*) FROM clicks SEMI JOIN picked USING (visit_id)) AS a,
           (SELECT count(*) FROM clicks ANTI JOIN picked USING (visit_id)) AS b)"""
