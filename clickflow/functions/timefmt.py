"""Date and time helpers as column expressions. All keys use the session zone (UTC)."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed text formats of the click log.
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
DATE_FORMAT = "yyyy-MM-dd"
DATEKEY_FORMAT = "yyyyMMdd"
MINUTE_KEY_FORMAT = "yyyyMMddHHmm"
DATE_HOUR_FORMAT = "yyyy-MM-dd_HH"


def parse_time(text: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` text → timestamp (null if malformed). One-digit hours,
    minutes or seconds (``2024-01-01 5:03:02``) are accepted, as the log writes them."""
    return text.try_cast("timestamp")


def format_time(ts: Column) -> Column:
    return F.date_format(ts, TIME_FORMAT)


def format_date(ts: Column) -> Column:
    return F.date_format(ts, DATE_FORMAT)


def format_date_key(ts: Column) -> Column:
    return F.date_format(ts, DATEKEY_FORMAT)


def parse_date_key(text: Column) -> Column:
    return F.try_to_timestamp(text, F.lit(DATEKEY_FORMAT)).cast("date")


def format_minute_key(ts: Column) -> Column:
    return F.date_format(ts, MINUTE_KEY_FORMAT)


def date_hour(time_text: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` → ``yyyy-MM-dd_HH``."""
    return F.date_format(parse_time(time_text), DATE_HOUR_FORMAT)


def before(t1: Column, t2: Column) -> Column:
    return parse_time(t1) < parse_time(t2)


def after(t1: Column, t2: Column) -> Column:
    return parse_time(t1) > parse_time(t2)


def minus_seconds(t1: Column, t2: Column) -> Column:
    """Whole seconds from ``t2`` to ``t1``."""
    return F.unix_timestamp(parse_time(t1)) - F.unix_timestamp(parse_time(t2))


def millis_to_timestamp(millis: Column) -> Column:
    return F.timestamp_millis(millis)


def today() -> Column:
    return F.current_date()


def yesterday() -> Column:
    return F.date_sub(F.current_date(), 1)
