"""Date/time helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: destination timestamp format (ISO-8601, milliseconds, UTC
# offset), as the interaction schema states it. Event times are UTC wall
# clock (timestamp_ntz), so the offset is written as a literal.
ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSS'+0000'"
# Plain text form used for timestamps in result tables (microseconds kept).
TEXT_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def iso8601_utc(c) -> Column:
    """Event time (UTC wall clock) -> ISO-8601 text with '+0000'. A
    timestamp_ntz is formatted as is, so the result does not depend on the
    session time zone."""
    return F.date_format(_c(c), ISO_FORMAT)


def ts_text(c) -> Column:
    return F.date_format(_c(c), TEXT_FORMAT)


def epoch_millis_to_ts(c) -> Column:
    """Epoch milliseconds -> whole seconds -> timestamp."""
    return F.timestamp_seconds(F.floor(_c(c) / 1000))
