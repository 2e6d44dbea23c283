"""Days and validity stamps that arrive as text. Nothing here raises under ANSI mode."""

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# The accepted shapes of a day and of a validity stamp.
DAY_SHAPE = r"^( ?[0-9]|[0-9]{2})-[0-9]{1,2}-[0-9]{4}$"
STAMP_SHAPE = r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2} [0-9]{1,2}:[0-9]{1,2}:[0-9]{1,2}$"


def parse_day(text: Column) -> Column:
    """``day-month-year`` text, padded or not, to a date; null when it is not a real day."""
    return F.when(text.rlike(DAY_SHAPE), F.try_to_date(F.ltrim(text), "d-M-yyyy"))


def format_day(day: Column) -> Column:
    """A date as ``yyyy-MM-dd``."""
    return F.date_format(day, "yyyy-MM-dd")


def day_bounds(day: Column) -> tuple[Column, Column]:
    """First and last second of a day as UTC stamps."""
    text = format_day(day)
    return F.concat(text, F.lit("T00:00:00Z")), F.concat(text, F.lit("T23:59:59Z"))


def parse_stamp(text: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` text to a zone-free timestamp, else null."""
    return F.when(text.rlike(STAMP_SHAPE), text.try_cast("timestamp_ntz"))


def parse_validity(start: Column, end: Column, as_of: dt.datetime) -> tuple[Column, Column]:
    """Validity range of a station. A null or empty end means "until ``as_of``";

    an end that is present but unreadable stays null, so the station is never valid.
    """
    open_end = end.isNull() | (end == "")
    # written through text so that a naive stamp stays zone-free
    now = F.lit(as_of.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")
    return parse_stamp(start), F.when(open_end, now).otherwise(parse_stamp(end))
