"""Column functions. All are built from Spark expressions, so they stay inside generated code."""

from farebox.functions.fields import message_text, json_fields
from farebox.functions.hashing import decimal_text, double_text, row_id, surrogate_key
from farebox.functions.labels import tip_bucket, tip_bucket_rank, vendor_name
from farebox.functions.times import (
    between_closed,
    day_of,
    hours_between,
    in_half_open,
    in_month,
    in_range_of_days,
    minute_boundaries,
    month_start,
    on_day,
    parse_event_time,
)

__all__ = [
    "between_closed", "day_of", "decimal_text", "double_text", "hours_between", "in_half_open", "in_month",
    "in_range_of_days", "json_fields", "message_text", "minute_boundaries", "month_start", "on_day",
    "parse_event_time", "row_id", "surrogate_key", "tip_bucket", "tip_bucket_rank", "vendor_name",
]
