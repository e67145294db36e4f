"""Calendar helpers. Timestamps are TIMESTAMP_NTZ: raw files carry wall-clock times without a zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def days_between(start, end) -> Column:
    """Number of midnights crossed, not elapsed 24-hour spans."""
    return F.datediff(F.to_date(end), F.to_date(start)).cast("bigint")


def months_between_boundaries(start, end) -> Column:
    """Number of month boundaries crossed: 31 Jan to 1 Feb is 1."""
    years = F.year(end) - F.year(start)
    return (years * 12 + F.month(end) - F.month(start)).cast("bigint")


def instant(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def in_window(ts: str, window: tuple[str, str] | None) -> Column:
    """Half-open ``[start, end)`` on the stored column, so that the range reaches the file scan."""
    if window is None:
        return F.lit(True)
    start, end = window
    return (F.col(ts) >= instant(start)) & (F.col(ts) < instant(end))


def year_month(ts) -> Column:
    return F.date_format(ts, "yyyy-MM")
