"""Column contracts, code tables and output shapes shared by every job."""

from pyspark.sql import types as T

# Source file columns and the plain names they take.
SOURCE_TO_PLAIN = {
    "year": "year",
    "month": "month",
    "day": "day",
    "order": "click_number_in_visit",
    "country": "country_code",
    "session ID": "visit_id",
    "page 1 (main category)": "category_code",
    "page 2 (clothing model)": "product_code",
    "colour": "colour_code",
    "location": "photo_position_code",
    "model photography": "photo_angle_code",
    "price": "price_usd",
    "price 2": "price_above_category_average_code",
    "page": "page_number_in_shop",
}
PLAIN_COLUMNS = list(SOURCE_TO_PLAIN.values())
SOURCE_VISIT_COLUMN = "session ID"
SOURCE_SEPARATOR = ";"

# Code tables of the source data set.
CATEGORIES = {1: "trousers", 2: "skirts", 3: "blouses", 4: "sale"}
COLOURS = {
    1: "beige", 2: "black", 3: "blue", 4: "brown", 5: "burgundy", 6: "gray", 7: "green", 8: "navy blue",
    9: "of many colors", 10: "olive", 11: "pink", 12: "red", 13: "violet", 14: "white",
}
PHOTO_POSITIONS = {
    1: "top left", 2: "top in the middle", 3: "top right",
    4: "bottom left", 5: "bottom in the middle", 6: "bottom right",
}
PHOTO_ANGLES = {1: "front", 2: "side"}
COUNTRIES = {
    1: "Australia", 2: "Austria", 3: "Belgium", 4: "British Virgin Islands", 5: "Cayman Islands",
    6: "Christmas Island", 7: "Croatia", 8: "Cyprus", 9: "Czech Republic", 10: "Denmark",
    11: "Estonia", 12: "unidentified", 13: "Faroe Islands", 14: "Finland", 15: "France",
    16: "Germany", 17: "Greece", 18: "Hungary", 19: "Iceland", 20: "India",
    21: "Ireland", 22: "Italy", 23: "Latvia", 24: "Lithuania", 25: "Luxembourg",
    26: "Mexico", 27: "Netherlands", 28: "Norway", 29: "Poland", 30: "Portugal",
    31: "Romania", 32: "Russia", 33: "San Marino", 34: "Slovakia", 35: "Slovenia",
    36: "Spain", 37: "Sweden", 38: "Switzerland", 39: "Ukraine", 40: "United Arab Emirates",
    41: "United Kingdom", 42: "USA", 43: "biz (*.biz)", 44: "com (*.com)", 45: "int (*.int)",
    46: "net (*.net)", 47: "org (*.org)",
}
UNKNOWN_COUNTRY_CODES = [12]
WEB_DOMAIN_COUNTRY_CODES = [43, 44, 45, 46, 47]

# How the fields missing from the source are generated.
SHOP_TIMEZONE = "Europe/Warsaw"
DEFAULT_SEED = 553
HOUR_WEIGHTS = [1, 1, 1, 1, 1, 1, 2, 3, 4, 5, 6, 6, 6, 6, 6, 6, 7, 8, 9, 10, 10, 8, 5, 2]
SECONDS_BETWEEN_CLICKS = (5, 300)
DEVICE_WEIGHTS = {"desktop": 0.85, "mobile": 0.10, "tablet": 0.05}
CLICK_ID_PREFIX = "uci553"
DATA_SOURCE = "uci553"

# Quality rules.
REQUIRED_COLUMNS = [
    "click_id", "visit_id", "year", "month", "day", "click_number_in_visit", "country_code", "category_code",
    "product_code", "colour_code", "photo_position_code", "photo_angle_code", "price_usd",
    "price_above_category_average_code", "page_number_in_shop", "received_time",
]
CODE_RANGES = {
    "country_code": (1, 47),
    "category_code": (1, 4),
    "colour_code": (1, 14),
    "photo_position_code": (1, 6),
    "photo_angle_code": (1, 2),
    "price_above_category_average_code": (1, 2),
    "page_number_in_shop": (1, 5),
}
MISSING_FIELD = "missing required field"
INVALID_DATE = "invalid real date"
OTHER_MONTH = "row outside its landing month"
NOT_CONTIGUOUS = "click numbers not contiguous in visit"
OUTSIDE_DATE = "synthetic time outside real date"
NOT_INCREASING = "synthetic time not increasing"
OTHER_CLICK = "other click in visit rejected"
SHOP_PAGES = 5

# Month partition used where the source row does not say which month it belongs to.
UNKNOWN_MONTH = "unknown"

_LONG, _TEXT, _TIME, _DATE, _FLAG = T.LongType(), T.StringType(), T.TimestampType(), T.DateType(), T.BooleanType()


def _schema(*groups):
    return T.StructType([T.StructField(name, kind, True) for kind, names in groups for name in names.split()])


SOURCE_SCHEMA = T.StructType(
    [T.StructField(name, _TEXT if name == "product_code" else _LONG, True) for name in PLAIN_COLUMNS])
RAW_SCHEMA = T.StructType([T.StructField(name, _TEXT, True) for name in SOURCE_TO_PLAIN])
ENRICHED_SCHEMA = T.StructType(
    SOURCE_SCHEMA.fields
    + _schema((_TEXT, "click_id"), (_TIME, "click_time_synthetic"), (_TEXT, "device_type_synthetic")).fields)
BRONZE_SCHEMA = T.StructType(
    ENRICHED_SCHEMA.fields + _schema((_TIME, "received_time"), (_TEXT, "data_source")).fields)
REJECTED_SCHEMA = T.StructType(
    BRONZE_SCHEMA.fields
    + _schema((_TEXT, "rejection_reason"), (_TIME, "rejected_time"), (_TEXT, "source_month")).fields)
SILVER_SCHEMA = _schema(
    (_TEXT, "click_id"), (_LONG, "visit_id click_number_in_visit"), (_DATE, "click_date"),
    (_TIME, "click_time_synthetic"), (_LONG, "click_hour_shop_time_synthetic"),
    (_TEXT, "product_code category colour"), (_LONG, "price_usd"), (_FLAG, "priced_above_category_average"),
    (_LONG, "page_number_in_shop"), (_TEXT, "photo_position_on_page photo_angle"), (_LONG, "country_code"),
    (_TEXT, "device_type_synthetic"), (_TIME, "received_time"), (_LONG, "seconds_late"), (_TEXT, "click_month"))
ERASED_VISITS_SCHEMA = _schema(
    (_LONG, "visit_id"), (_TIME, "deleted_time"), (_TEXT, "reason"), (_TEXT, "bronze_key"))
GOLD_CLICKS_SCHEMA = _schema(
    (_TEXT, "click_id"), (_LONG, "visit_id click_number_in_visit"), (_DATE, "click_date"),
    (_TIME, "click_time_synthetic"), (_TEXT, "product_code"), (_LONG, "country_code"),
    (_TEXT, "device_type_synthetic"), (_LONG, "price_usd"), (_TEXT, "click_month"))
VISITS_SCHEMA = _schema(
    (_LONG, "visit_id"), (_DATE, "visit_date"), (_LONG, "country_code"), (_TEXT, "device_type_synthetic"),
    (_TIME, "visit_start_time_synthetic visit_end_time_synthetic"),
    (_LONG, "visit_length_seconds_synthetic clicks_in_visit products_viewed categories_viewed deepest_page_reached"),
    (_FLAG, "bounced"), (_TEXT, "first_product_viewed last_product_viewed visit_month"))
PRODUCTS_SCHEMA = _schema(
    (_TEXT, "product_code category colour"), (_LONG, "price_usd"), (_FLAG, "priced_above_category_average"),
    (_LONG, "page_number_in_shop"), (_TEXT, "photo_position_on_page photo_angle"))
COUNTRIES_SCHEMA = _schema((_LONG, "country_code"), (_TEXT, "country_name kind"))
DEVICES_SCHEMA = _schema((_TEXT, "device_type"))
CALENDAR_SCHEMA = _schema((_DATE, "calendar_date"), (_TEXT, "day_of_week"), (_LONG, "week_number"), (_TEXT, "month_name"))

PRODUCT_MONTHS_SCHEMA = T.StructType(
    PRODUCTS_SCHEMA.fields + _schema((_LONG, "clicks"), (T.DecimalType(38, 0), "seen"), (_TEXT, "click_month")).fields)
LANDED_VISITS_SCHEMA = _schema((_LONG, "visit_id"), (_TEXT, "source_month"))
PROFILE_MONTHS_SCHEMA = _schema((_TEXT, "column item"), (_LONG, "rows"), (_TEXT, "source_month"))
CLICK_DAYS_SCHEMA = _schema((_DATE, "click_date"), (_TEXT, "click_month"))
VISIT_MONTHS_SCHEMA = _schema(
    (_TEXT, "kind"), (_DATE, "visit_date"), (_LONG, "deepest"), (_TEXT, "product_code"), (_LONG, "country_code"),
    (_TEXT, "device_type_synthetic"), (_LONG, "visits clicks bounced"), (_TEXT, "visit_month"))

BRONZE_COLUMNS = BRONZE_SCHEMA.fieldNames()
REJECTED_COLUMNS = REJECTED_SCHEMA.fieldNames()
SILVER_COLUMNS = SILVER_SCHEMA.fieldNames()
GOLD_CLICK_COLUMNS = GOLD_CLICKS_SCHEMA.fieldNames()
VISIT_COLUMNS = VISITS_SCHEMA.fieldNames()
PRODUCT_COLUMNS = PRODUCTS_SCHEMA.fieldNames()
PRODUCT_ATTRIBUTES = PRODUCT_COLUMNS[2:]
