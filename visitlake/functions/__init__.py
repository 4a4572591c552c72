from visitlake.functions.columns import (
    click_id, country_kind, decode, draw, is_weekend, month_of, real_date, seconds_between, shop_local_time,
    shop_time_to_utc, source_month,
)
from visitlake.functions.masking import (
    mask_accounts, mask_arns, mask_buckets, mask_emails, mask_text, mask_versions, mask_visit, mask_visit_fields,
)

__all__ = [
    "click_id", "country_kind", "decode", "draw", "is_weekend", "month_of", "real_date", "seconds_between",
    "shop_local_time", "shop_time_to_utc", "source_month", "mask_accounts", "mask_arns", "mask_buckets",
    "mask_emails", "mask_text", "mask_versions", "mask_visit", "mask_visit_fields",
]
