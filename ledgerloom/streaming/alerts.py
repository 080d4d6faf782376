"""Alerts over event counts and expiry dates."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.cleaning import days_between, today

# Fixed values of the recommended alerts: kind, look-back and limit per second.
AUTH_FAILURES = ("401", "5 minutes", 10.0)
FORBIDDEN = ("403", "5 minutes", 5.0)
POD_RESTARTS = ("restart", "1 hour", 5.0)


def rate_alert(
    events: DataFrame,
    kind: str,
    limit_per_second: float,
    window: str = "5 minutes",
    slide: str = "1 minute",
    delay: str = "10 minutes",
    time_column: str = "ts",
    kind_column: str = "event_type",
    by: tuple[str, ...] = (),
) -> DataFrame:
    """Windows in which events of ``kind`` come faster than the limit, per ``by`` columns.

    The same plan serves a table and a stream. On a stream a window is given out once the watermark,
    ``delay`` behind the newest event, has passed its end; events later than that are dropped.
    """
    chosen = events.where(F.col(kind_column) == kind).select(
        F.col(time_column).cast("timestamp").alias("_at"), *by
    )
    spans = chosen.withWatermark("_at", delay).groupBy(F.window("_at", window, slide).alias("span"), *by)
    counts = spans.agg(F.count("*").alias("n_events"))
    seconds = F.unix_timestamp(F.col("span.end")) - F.unix_timestamp(F.col("span.start"))
    return counts.select(
        *by, F.col("span.start").alias("window_start"), F.col("span.end").alias("window_end"), "n_events",
        (F.col("n_events") / seconds).alias("per_second"),
    ).where(F.col("per_second") > limit_per_second)


def expiry_alert(df: DataFrame, column: str, days: int = 30, as_of: date | None = None) -> DataFrame:
    """Rows whose expiry is less than ``days`` away (or past), with ``days_left``."""
    left = df.withColumn("days_left", days_between(today(as_of), column))
    return left.where(F.col("days_left") < days)
