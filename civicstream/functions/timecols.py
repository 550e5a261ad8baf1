"""PRJ-2 / PRJ-3 / PRJ-12: event time from ISO-8601 text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def event_time(c) -> Column:
    """ISO-8601 text (trailing ``Z`` allowed) -> TIMESTAMP; unparsable text -> null.

    ANSI mode makes a plain cast throw on bad text, so ``try_cast`` is used.
    """
    return _c(c).try_cast("timestamp")


def epoch_ms(c) -> Column:
    """TIMESTAMP, TIMESTAMP_NTZ (read as UTC wall time; the session zone is UTC) or ISO
    text -> epoch milliseconds, truncated toward the past like an integer conversion."""
    return F.floor(F.unix_micros(_c(c).cast("timestamp")) / 1000).cast("long")


def window_date(c) -> Column:
    """Calendar date of a window start (PRJ-12); session time zone is pinned to UTC."""
    return F.to_date(_c(c))
