"""The driver tables in the shape of the three sources.

T1 takes orders as transactions, with missing and negative values set by rule because the tables hold
none. T2 takes events, whose dates fill a real 30-day window.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.params import RunParams
from ledgerloom.sources.files import load_parquet

T1 = RunParams(
    run_date=date(2001, 8, 1), as_of=date(2001, 8, 1), lookback_days=2400, date_floor=date(1996, 1, 1),
    segments=("BUILDING", "MACHINERY"),
)
T2 = RunParams(run_date=date(2024, 1, 31), as_of=date(2024, 1, 31), segments=("BUILDING", "MACHINERY"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return load_parquet(spark, f"{sf_dir}/{name}.parquet")


def t1_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        key.alias("transaction_id"),
        F.when(key % 97 != 0, F.col("o_custkey")).alias("customer_id"),
        (key % 1000).alias("product_id"),
        F.when(key % 89 == 0, F.lit(None).cast("double"))
        .when(key % 83 == 0, -F.col("o_totalprice"))
        .otherwise(F.col("o_totalprice"))
        .alias("amount"),
        F.col("o_orderdate").cast("date").alias("transaction_date"),
    )


def t1_campaigns(spark: SparkSession, sf_dir: str) -> DataFrame:
    user = F.col("user_id")
    return (
        table(spark, sf_dir, "events")
        .select(user.alias("customer_id"), (user % 7).alias("campaign_id"), F.col("event_type").alias("channel"))
        .distinct()
    )


def profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("customer_id"), F.col("c_mktsegment").alias("customer_segment")
    )


def t1_sources(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return t1_transactions(spark, sf_dir), t1_campaigns(spark, sf_dir), profiles(spark, sf_dir)


def t2_sources(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    transactions = table(spark, sf_dir, "events").select(
        F.col("event_id").alias("transaction_id"),
        F.col("user_id").alias("customer_id"),
        (F.col("event_id") % 1000).alias("product_id"),
        F.col("value").alias("amount"),
        F.col("ts").cast("date").alias("transaction_date"),
    )
    campaigns = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("customer_id"),
        (F.col("o_orderkey") % 5).alias("campaign_id"),
        F.col("o_orderpriority").alias("channel"),
    )
    return transactions, campaigns, profiles(spark, sf_dir)


T1_TRANSACTIONS_SQL = """
SELECT o_orderkey AS transaction_id,
       CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE o_custkey END AS customer_id,
       o_orderkey % 1000 AS product_id,
       CASE WHEN o_orderkey % 89 = 0 THEN NULL
            WHEN o_orderkey % 83 = 0 THEN -o_totalprice ELSE o_totalprice END AS amount,
       CAST(o_orderdate AS DATE) AS transaction_date
FROM orders"""
T1_CAMPAIGNS_SQL = "SELECT DISTINCT user_id AS customer_id, user_id % 7 AS campaign_id, event_type AS channel FROM events"
T2_TRANSACTIONS_SQL = """
SELECT event_id AS transaction_id, user_id AS customer_id, event_id % 1000 AS product_id, value AS amount,
       CAST(ts AS DATE) AS transaction_date FROM events"""
T2_CAMPAIGNS_SQL = "SELECT o_custkey AS customer_id, o_orderkey % 5 AS campaign_id, o_orderpriority AS channel FROM orders"
PROFILES_SQL = "SELECT c_custkey AS customer_id, c_mktsegment AS customer_segment FROM customer"
