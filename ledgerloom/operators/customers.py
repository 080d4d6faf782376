"""Per-customer metrics, outlier flags and the training table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.cleaning import (
    amount_sanitise, date_sanitise, days_between, one_hot, one_hot_name, outside_fence, segment_default, today,
)
from ledgerloom.operators.extract import lookback_filter
from ledgerloom.operators.ranks import aggregate_with_quantiles
from ledgerloom.operators.skew import hot_keys, left_join, small_side, total_bytes
from ledgerloom.params import RunParams
from ledgerloom.session import BROADCAST_BYTES, TASK_ROWS, checkpoint

GROUP = ["customer_id", "customer_segment"]
METRIC_COLUMNS = [
    "customer_id", "avg_transaction_amount", "median_transaction_amount", "std_transaction_amount",
    "transaction_count", "last_transaction_date", "first_transaction_date", "customer_duration_days",
    "customer_segment", "campaign_exposure_count", "channel_count", "is_outlier",
]
QUARTERS = [0.25, 0.5, 0.75]


def clean_transactions(raw: DataFrame, params: RunParams) -> DataFrame:
    """Rows with a customer; impossible amounts and dates are NULL, blank segments ``'Unknown'``."""
    return raw.where(F.col("customer_id").isNotNull()).withColumns(
        {
            "amount": amount_sanitise("amount", params.amount_max),
            "transaction_date": date_sanitise("transaction_date", params.date_floor, params.as_of),
            "customer_segment": segment_default("customer_segment"),
        }
    )


def _spread(first: str = "transaction_date", last: str = "transaction_date") -> list[Column]:
    return [
        F.avg("amount").alias("avg_transaction_amount"),
        F.stddev_pop("amount").alias("std_transaction_amount"),
        F.max(last).alias("last_transaction_date"),
        F.min(first).alias("first_transaction_date"),
    ]


def _finish(grouped: DataFrame, params: RunParams) -> DataFrame:
    """Customers with enough transactions, their duration and the flag of the mean against their fence."""
    quarter = F.col("quantiles")
    return (
        grouped.where(F.col("transaction_count") >= params.min_transactions)
        .withColumns(
            {
                "median_transaction_amount": quarter[1],
                "customer_duration_days": days_between("first_transaction_date", "last_transaction_date"),
                "is_outlier": outside_fence("avg_transaction_amount", quarter[0], quarter[2]),
            }
        )
        .select(*METRIC_COLUMNS)
    )


def customer_metrics(raw: DataFrame, params: RunParams, task_rows: int = TASK_ROWS) -> DataFrame:
    """Metrics per customer and segment over the extracted rows.

    ``raw`` should be the stored rows, as they are read three times. Rows count as often as the campaign
    join repeated them. With ``dedupe_fanout`` each transaction that has an id
    counts once, while campaigns and channels are still counted over all rows.
    """
    valid = clean_transactions(raw, params).where(F.col("amount").isNotNull())
    rows = valid
    if params.dedupe_fanout:  # a row without an id cannot be told from a copy and does not count
        rows = valid.where(F.col("transaction_id").isNotNull()).dropDuplicates(["transaction_id", *GROUP])
    grouped = aggregate_with_quantiles(
        rows, GROUP, "amount", QUARTERS, [*_spread(), F.count("*").alias("transaction_count")], task_rows=task_rows
    )
    # Counted apart: in one aggregation each distinct count would repeat every row, amounts included.
    contacts = valid.select(*GROUP, "campaign_id", "channel").distinct()
    exposure = contacts.groupBy(*GROUP).agg(
        F.count_distinct("campaign_id").alias("campaign_exposure_count"),
        F.count_distinct("channel").alias("channel_count"),
    )
    return _finish(grouped.join(exposure, GROUP), params)


def customer_attributes(campaigns: DataFrame, profiles: DataFrame) -> DataFrame:
    """Per customer: segments with the number of profile rows, campaign rows, distinct campaigns and channels."""
    seen = campaigns.where(F.col("customer_id").isNotNull()).groupBy("customer_id").agg(
        F.count("*").alias("_campaign_rows"),
        F.count_distinct("campaign_id").alias("campaign_exposure_count"),
        F.count_distinct("channel").alias("channel_count"),
    )
    segments = (
        profiles.where(F.col("customer_id").isNotNull())
        .groupBy("customer_id", segment_default("customer_segment").alias("customer_segment"))
        .agg(F.count("*").alias("_profile_rows"))
    )
    return segments.join(seen, "customer_id", "full_outer")


def customer_metrics_from_sources(
    transactions: DataFrame,
    campaigns: DataFrame,
    profiles: DataFrame,
    params: RunParams,
    task_rows: int = TASK_ROWS,
) -> DataFrame:
    """The same metrics straight from the three sources, without building the multiplied rows.

    All rows of one customer and segment are repeated equally often, so each transaction carries that
    number as a weight. The work grows with the transactions, not with transactions times campaigns.
    """
    customers = customer_attributes(campaigns, profiles)
    window = lookback_filter(transactions, params.run_date, params.lookback_days, until=params.until)
    if params.dedupe_fanout:
        window = window.where(F.col("transaction_id").isNotNull())
    rows = window.select(
        "customer_id",
        amount_sanitise("amount", params.amount_max).alias("amount"),
        date_sanitise("transaction_date", params.date_floor, params.as_of).alias("transaction_date"),
    ).where(F.col("customer_id").isNotNull() & F.col("amount").isNotNull())
    return metrics_of_rows(rows, customers, params, task_rows)


def metrics_of_rows(
    rows: DataFrame, customers: DataFrame, params: RunParams, task_rows: int = TASK_ROWS,
    first: str = "transaction_date", last: str = "transaction_date",
) -> DataFrame:
    """The metrics of cleaned rows (customer_id, amount) with the attributes of their customers.

    ``first`` and ``last`` name the columns, of either side, whose least and largest values are the customer's dates.
    """
    repeats = F.coalesce("_campaign_rows", F.lit(1)) * F.coalesce("_profile_rows", F.lit(1))
    aggregates = [
        *_spread(first, last),
        F.sum("_copies").alias("transaction_count"),
        F.max("campaign_exposure_count").alias("campaign_exposure_count"),
        F.max("channel_count").alias("channel_count"),
    ]

    def grouped(joined: DataFrame, limit: int | None) -> DataFrame:
        weighted = joined.select(
            "customer_id", "amount", *dict.fromkeys([first, last]),
            segment_default("customer_segment").alias("customer_segment"),
            (F.lit(1).cast("long") if params.dedupe_fanout else repeats).alias("_copies"),
            F.coalesce("campaign_exposure_count", F.lit(0)).alias("campaign_exposure_count"),
            F.coalesce("channel_count", F.lit(0)).alias("channel_count"),
        )
        return aggregate_with_quantiles(
            weighted, GROUP, "amount", QUARTERS, aggregates, weight="_copies", task_rows=limit
        )

    hot = hot_keys(rows, "customer_id", task_rows)
    if hot.isEmpty():
        return _finish(grouped(rows.join(customers, "customer_id", "left"), None), params)
    # Hot customers stay where they are: their list and their few customer rows come to them.
    listed = small_side(hot, total_bytes(hot))
    few = checkpoint(customers.join(listed, "customer_id", "left_semi"))
    heavy = rows.join(listed, "customer_id", "left_semi")
    if total_bytes(few) <= BROADCAST_BYTES:
        heavy = heavy.join(F.broadcast(few), "customer_id", "left")
    else:
        heavy = left_join(heavy, few, "customer_id", unique_right=True)
    light = rows.join(listed, "customer_id", "left_anti").join(customers, "customer_id", "left")
    return _finish(grouped(light, None).unionByName(grouped(heavy, task_rows)), params)


def outlier_exclude(metrics: DataFrame) -> DataFrame:
    return metrics.where(~F.col("is_outlier"))


def minmax_normalise(df: DataFrame, column: str, alias: str) -> DataFrame:
    """``(x - min) / (max - min)`` over all rows; NULL when the column is constant.

    The two numbers come from one aggregation and are joined as a single row: a window over everything
    would move all rows into one task.
    """
    ends = df.agg(F.min(column).alias("_low"), F.max(column).alias("_high"))
    share = (F.col(column) - F.col("_low")) / F.nullif(F.col("_high") - F.col("_low"), F.lit(0.0))
    return df.crossJoin(F.broadcast(ends)).withColumn(alias, share).drop("_low", "_high")


def training_table(metrics: DataFrame, params: RunParams) -> DataFrame:
    """One row per customer that is no outlier: metrics, recency, normalised amount, segment columns."""
    kept = outlier_exclude(metrics)
    normalised = minmax_normalise(kept, "avg_transaction_amount", "normalized_amount")
    return normalised.select(
        "customer_id", "avg_transaction_amount", "median_transaction_amount", "std_transaction_amount",
        "transaction_count", "customer_duration_days", "customer_segment", "campaign_exposure_count",
        "channel_count",
        days_between("last_transaction_date", today(params.as_of)).alias("days_since_last_transaction"),
        "normalized_amount",
        *[one_hot("customer_segment", s).alias(one_hot_name(s)) for s in params.segments],
        "is_outlier",
    )
