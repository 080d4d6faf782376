"""One-row quality reports before and after cleaning."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.cleaning import count_where, percent

# Column order of the stored report; a report that lacks a column shows NULL there.
REPORT_COLUMNS = {
    "dataset_type": "string", "total_rows": "long", "unique_customers": "long", "null_customer_ids": "long",
    "null_amounts": "long", "non_positive_amounts": "long", "null_dates": "long", "min_date": "date",
    "max_date": "date", "pct_null_customers": "double", "pct_null_amounts": "double",
    "pct_non_positive_amounts": "double", "avg_transactions_per_customer": "double",
    "avg_amount_per_customer": "double", "outlier_customers": "long", "pct_outliers": "double",
}


def _typed(report: DataFrame) -> DataFrame:
    return report.select(
        *[F.col(c).cast(kind).alias(c) for c, kind in REPORT_COLUMNS.items() if c in report.columns]
    )


def dq_raw(raw: DataFrame) -> DataFrame:
    """Counts and shares of missing and non-positive values; NULL sums over an empty table."""
    counts = raw.agg(
        F.count("*").alias("total_rows"),
        F.count_distinct("customer_id").alias("unique_customers"),
        count_where(F.col("customer_id").isNull()).alias("null_customer_ids"),
        count_where(F.col("amount").isNull()).alias("null_amounts"),
        count_where(F.col("amount") <= 0).alias("non_positive_amounts"),
        count_where(F.col("transaction_date").isNull()).alias("null_dates"),
        F.min("transaction_date").alias("min_date"),
        F.max("transaction_date").alias("max_date"),
    )
    report = counts.withColumns(
        {
            "dataset_type": F.lit("raw_data"),
            "pct_null_customers": percent("null_customer_ids", "total_rows"),
            "pct_null_amounts": percent("null_amounts", "total_rows"),
            "pct_non_positive_amounts": percent("non_positive_amounts", "total_rows"),
        }
    )
    return _typed(report)


def dq_clean(metrics: DataFrame) -> DataFrame:
    """The same report over customer metrics, with averages and the share of outliers."""
    counts = metrics.agg(
        F.count("*").alias("total_rows"),
        F.count_distinct("customer_id").alias("unique_customers"),
        count_where(F.col("avg_transaction_amount").isNull()).alias("null_amounts"),
        count_where(F.col("is_outlier")).alias("outlier_customers"),
        F.min("last_transaction_date").alias("min_date"),
        F.max("last_transaction_date").alias("max_date"),
        F.avg("transaction_count").alias("avg_transactions_per_customer"),
        F.avg("avg_transaction_amount").alias("avg_amount_per_customer"),
    )
    settled = {  # cleaning has removed these already
        c: F.lit(0)
        for c in ("null_customer_ids", "non_positive_amounts", "null_dates", "pct_null_customers",
                  "pct_non_positive_amounts")
    }
    report = counts.withColumns(
        {
            "dataset_type": F.lit("clean_data"),
            "pct_null_amounts": percent("null_amounts", "total_rows"),
            "pct_outliers": percent("outlier_customers", "total_rows"),
            **settled,
        }
    )
    return _typed(report)


def dq_report(raw_report: DataFrame, clean_report: DataFrame) -> DataFrame:
    """Both reports in one table, matched by column name."""
    both = raw_report.unionByName(clean_report, allowMissingColumns=True)
    return both.select(*REPORT_COLUMNS)
