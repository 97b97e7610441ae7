from brookmart.functions.dates import (
    DATETIME, datetime_text, day_text, event_time, millis_of, now_millis, parse_time, seconds_of,
)
from brookmart.functions.names import camel_case, camel_case_columns
from brookmart.functions.text import tokenize

__all__ = [
    "DATETIME", "camel_case", "camel_case_columns", "datetime_text", "day_text", "event_time", "millis_of",
    "now_millis", "parse_time", "seconds_of", "tokenize",
]
