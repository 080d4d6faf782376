"""Date parts and customer aggregates as feature columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType

from ledgerloom.operators.skew import left_join

CUSTOMER_FEATURES = [
    "customer_avg_amount", "customer_std_amount", "customer_transaction_count", "customer_total_amount",
]


def date_features(df: DataFrame, date_columns: tuple[str, ...] | list[str]) -> DataFrame:
    """``_year``, ``_month`` and ``_dayofweek`` (Monday 0) of each configured column that exists.

    The source column stays, parsed when it is text; text that is no date raises.
    """
    for name in date_columns:
        if name not in df.columns:
            continue
        if isinstance(df.schema[name].dataType, StringType):
            df = df.withColumn(name, F.to_timestamp(name))
        day = F.col(name) if isinstance(df.schema[name].dataType, DateType) else F.col(name).cast("date")
        df = df.withColumns(
            {f"{name}_year": F.year(day), f"{name}_month": F.month(day), f"{name}_dayofweek": F.weekday(day)}
        )
    return df


def customer_stats(df: DataFrame) -> DataFrame:
    """Mean, sample deviation, count and sum of ``amount`` per customer; the sum of nothing is 0."""
    amount = F.col("amount").cast("double")
    return (
        df.where(F.col("customer_id").isNotNull())
        .groupBy("customer_id")
        .agg(
            F.avg(amount).alias("customer_avg_amount"),
            F.stddev_samp(amount).alias("customer_std_amount"),
            F.count("amount").alias("customer_transaction_count"),
            F.coalesce(F.sum(amount), F.lit(0.0)).alias("customer_total_amount"),
        )
    )


def join_customer_stats(df: DataFrame, stats: DataFrame) -> DataFrame:
    """The customer's aggregates on every row; NULL for a row without customer."""
    return left_join(df, stats, "customer_id", unique_right=True)


def customer_features(df: DataFrame, stats: DataFrame | None = None) -> DataFrame:
    """Adds the aggregates when both columns exist, computed over ``df`` unless given."""
    if not {"customer_id", "amount"} <= set(df.columns):
        return df
    order = [*df.columns, *CUSTOMER_FEATURES]
    return join_customer_stats(df, customer_stats(df) if stats is None else stats).select(*order)


def split_target(df: DataFrame, target: str) -> tuple[DataFrame, DataFrame | None]:
    """All columns but the target, and the target alone; None when there is no target column."""
    return df.drop(target), (df.select(target) if target in df.columns else None)
