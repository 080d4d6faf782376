"""Column rules of the cleaning step. All are built-in expressions and stay inside code generation."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

UNKNOWN_SEGMENT = "Unknown"


def as_column(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def today(as_of: date | None) -> Column:
    """The job's "today": a fixed parameter, or the session's current date."""
    return F.current_date() if as_of is None else F.lit(as_of)


def amount_sanitise(amount: str | Column, amount_max: float = 1_000_000.0) -> Column:
    """NULL for amounts that are not positive or above the limit; the limit itself is kept."""
    c = as_column(amount)
    return F.when((c > 0) & (c <= F.lit(amount_max)), c)


def date_sanitise(day: str | Column, floor: date = date(2010, 1, 1), as_of: date | None = None) -> Column:
    """NULL for dates before ``floor`` or later than tomorrow."""
    c = as_column(day)
    return F.when((c >= F.lit(floor)) & (c <= F.date_add(today(as_of), 1)), c)


def segment_default(segment: str | Column) -> Column:
    """``'Unknown'`` for a missing or blank segment, otherwise the value as it is (not trimmed)."""
    c = as_column(segment)
    return F.when(F.trim(c) != "", c).otherwise(UNKNOWN_SEGMENT)


def one_hot(segment: str | Column, value: str) -> Column:
    """1 where the segment equals ``value``, else 0 (also for a missing segment)."""
    return F.when(as_column(segment) == F.lit(value), 1).otherwise(0)


def one_hot_name(value: str) -> str:
    return "is_" + "_".join(value.lower().split())


def outside_fence(value: str | Column, q1: str | Column, q3: str | Column, factor: float = 1.5) -> Column:
    """TRUE when the value lies outside ``[q1 - f*iqr, q3 + f*iqr]``; FALSE when that is unknown."""
    v, low, high = as_column(value), as_column(q1), as_column(q3)
    reach = F.lit(factor) * (high - low)
    return F.coalesce((v < low - reach) | (v > high + reach), F.lit(False))


def count_where(condition: Column) -> Column:
    """Rows that satisfy the condition; NULL (not 0) over an empty input."""
    return F.sum(F.when(condition, 1).otherwise(0))


def percent(part: str | Column, total: str | Column) -> Column:
    """``part`` as a percentage of ``total``, two digits half up; NULL when the total is 0."""
    ratio = as_column(part) * F.lit(100.0) / F.nullif(as_column(total), F.lit(0))
    return F.round(ratio, 2)


def days_between(start: str | Column, end: str | Column) -> Column:
    """Calendar days from ``start`` to ``end``; timestamps are cut to their date first."""
    return F.datediff(as_column(end).cast("date"), as_column(start).cast("date")).cast("long")


def text_or_none(value: str | Column) -> Column:
    """The value as text; a missing one becomes the text ``'None'``."""
    return F.coalesce(as_column(value).cast("string"), F.lit("None"))
