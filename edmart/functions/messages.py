"""Log messages: the predicates on them and the numbers inside them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from edmart.functions.text import as_col, text_contains

# Message fragments written by the collection programs.
SCRAPED = "records scraped"
SCRAPE_STARTED = "no data found, scraping"
SLOTS_MESSAGE = "scrape (slots left:"
SLOTS_OPEN = "(slots left:"
WRITING_PREFIX = "writing records"


def is_scraped(message: Column | str, case_insensitive: bool = False) -> Column:
    """Completion message; one mart lowers the message first, the others do not."""
    message = as_col(message)
    return text_contains(F.lower(message) if case_insensitive else message, F.lit(SCRAPED))


def is_scrape_start(message: Column | str) -> Column:
    return text_contains(message, F.lit(SCRAPE_STARTED))


def is_slots(message: Column | str) -> Column:
    return text_contains(message, F.lit(SLOTS_MESSAGE))


def is_not_writing(message: Column | str) -> Column:
    """NULL for a NULL message, so such rows are not kept by a filter."""
    return ~F.startswith(as_col(message), F.lit(WRITING_PREFIX))


def _server_int(text: Column) -> Column:
    """Text to integer with blank text read as 0 and anything else unreadable as NULL."""
    return F.when(F.trim(text) == "", F.lit(0)).otherwise(text.try_cast("int"))


def extracted_count(message: Column | str) -> Column:
    """The integer before `` records scraped``; NULL unless the whole prefix is one."""
    message = as_col(message)
    at = F.locate(" " + SCRAPED, F.lower(message))
    return F.when(at > 0, _server_int(F.substring(message, F.lit(1), at - 1)))


def slots_left(message: Column | str) -> Column:
    """The integer inside ``(slots left: n)``; 0 without a closed bracket, NULL for NULL."""
    message = as_col(message)
    opened = F.locate(SLOTS_OPEN, F.lower(message))
    start = opened + F.lit(len(SLOTS_OPEN))
    closed = F.position(F.lit(")"), message, F.greatest(opened, F.lit(1)))
    inner = F.when((opened > 0) & (closed > start), F.substring(message, start, closed - start))
    value = _server_int(F.coalesce(inner, F.lit("")))
    return F.when(message.isNotNull(), value)
