"""Extraction of the raw rows: transactions of the look-back window with campaigns and profiles."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.skew import key_counts, left_join
from ledgerloom.params import RunParams
from ledgerloom.session import checkpoint

RAW_COLUMNS = [
    "transaction_id", "customer_id", "product_id", "amount", "transaction_date",
    "campaign_id", "channel", "customer_segment",
]


def lookback_filter(
    df: DataFrame, run_date: date, days: int = 30, column: str = "transaction_date", until: date | None = None
) -> DataFrame:
    """Rows from ``days`` before the run date on. Open upwards unless ``until`` is given."""
    kept = df.where(F.col(column) >= F.date_sub(F.lit(run_date), days))
    return kept if until is None else kept.where(F.col(column) <= F.lit(until))


def join_campaigns(transactions: DataFrame, campaigns: DataFrame) -> DataFrame:
    """Left join: several campaigns of a customer multiply the customer's transactions."""
    return left_join(transactions, campaigns.select("customer_id", "campaign_id", "channel"), "customer_id")


def join_profiles(transactions: DataFrame, profiles: DataFrame) -> DataFrame:
    return left_join(transactions, profiles.select("customer_id", "customer_segment"), "customer_id")


def project_training_cols(joined: DataFrame) -> DataFrame:
    return joined.select(*RAW_COLUMNS)


def extract_raw(
    transactions: DataFrame, campaigns: DataFrame, profiles: DataFrame, params: RunParams
) -> DataFrame:
    """The raw rows of one run day.

    Both joins are on the customer, so the transactions are shuffled once for them unless customers are
    hot. The transactions of a customer are counted once, on the key column of the window.
    """
    window = lookback_filter(transactions, params.run_date, params.lookback_days, until=params.until)
    counts = checkpoint(key_counts(window, "customer_id"))
    segments = profiles.select("customer_id", "customer_segment")
    contacts = campaigns.select("customer_id", "campaign_id", "channel")
    joined = left_join(window, segments, "customer_id", left_counts=counts)
    return project_training_cols(left_join(joined, contacts, "customer_id", left_counts=counts))
