"""Column functions: calendar, text and key expressions."""

from starmart.functions.keys import md5_of, sequence_id, wide_key
from starmart.functions.text import (
    blank_to_null,
    clean_strings,
    remove_chars,
    split_once,
    strip,
    truncate_to,
    upper_name,
)
from starmart.functions.times import (
    CALENDAR_PARTS,
    calendar,
    millis_to_timestamp,
    sas_days_to_date,
    seconds_timestamp,
)

__all__ = [
    "CALENDAR_PARTS",
    "blank_to_null",
    "calendar",
    "clean_strings",
    "md5_of",
    "millis_to_timestamp",
    "remove_chars",
    "sas_days_to_date",
    "seconds_timestamp",
    "sequence_id",
    "split_once",
    "strip",
    "truncate_to",
    "upper_name",
    "wide_key",
]
