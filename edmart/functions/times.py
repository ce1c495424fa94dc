"""Timestamp formats of the marts. Sessions run in UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from edmart.functions.text import as_col

# Output formats.
MINUTE_FORMAT = "yyyy-MM-dd HH:mm"
HYPHEN_MINUTE_FORMAT = "yyyy-MM-dd HH-mm"
NO_TIME = "0"


def minute_text(ts: Column | str) -> Column:
    """``yyyy-MM-dd HH:mm``, or the text ``0`` for a missing time."""
    return F.coalesce(F.date_format(as_col(ts), MINUTE_FORMAT), F.lit(NO_TIME))


def hyphen_minute_text(ts: Column | str) -> Column:
    return F.date_format(as_col(ts), HYPHEN_MINUTE_FORMAT)


def clock_duration(start: Column | str, end: Column | str) -> Column:
    """Second boundaries between two times as ``hh:mm:ss``, wrapping at 24 hours."""
    seconds = F.unix_seconds(as_col(end).cast("timestamp")) - F.unix_seconds(as_col(start).cast("timestamp"))
    of_day = F.pmod(seconds, F.lit(86400))
    text = F.format_string(
        "%02d:%02d:%02d",
        F.floor(of_day / 3600),
        F.floor(F.pmod(of_day, F.lit(3600)) / 60),
        F.pmod(of_day, F.lit(60)),
    )
    return F.when(of_day.isNotNull(), text)


def server_datetime_text(ts: Column | str) -> Column:
    """Default server text of a datetime, e.g. ``Jun  5 2025  3:07PM``."""
    ts = as_col(ts)
    return F.concat(
        F.date_format(ts, "MMM"),
        F.lit(" "),
        F.lpad(F.date_format(ts, "d"), 2, " "),
        F.date_format(ts, " yyyy "),
        F.lpad(F.date_format(ts, "h:mm"), 5, " "),
        F.date_format(ts, "a"),
    )
