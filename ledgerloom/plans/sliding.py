"""Customer metrics over a sliding window, kept up by the day that enters and the day that leaves.

Each day's amounts are stored as counts per customer and value. The window is the sum of its days' counts: the next
day's window is the last one plus the day that enters, less the day that leaves, whatever its length. Counts of values
lose nothing, so means, deviations and quartiles are exact. Campaigns and profiles come in when the metrics are asked for.
"""

from __future__ import annotations

from dataclasses import replace
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.cleaning import amount_sanitise, date_sanitise
from ledgerloom.operators.customers import customer_attributes, metrics_of_rows
from ledgerloom.params import RunParams
from ledgerloom.session import TASK_ROWS
from ledgerloom.sources.tables import read_run_table, run_days, write_run_table

RUN = 10_000  # copies of a value that are made at once


def write_day(spark: SparkSession, root: str, day: date, transactions: DataFrame, params: RunParams) -> DataFrame:
    """Store (customer_id, amount, n) of the cleaned transactions of ``day``."""
    rows = transactions.where(F.col("transaction_date") == F.lit(day))
    if params.dedupe_fanout:
        rows = rows.where(F.col("transaction_id").isNotNull())
    cleaned = rows.select("customer_id", amount_sanitise("amount", params.amount_max).alias("amount"))
    cleaned = cleaned.where(F.col("customer_id").isNotNull() & F.col("amount").isNotNull())
    return write_run_table(cleaned.groupBy("customer_id", "amount").agg(F.count("*").alias("n")), f"{root}/day_values", day)


def _signed(rows: DataFrame, sign: int) -> DataFrame:
    return rows.select("customer_id", "amount", (F.lit(sign) * F.col("n")).alias("n"))


def _summed(rows: DataFrame) -> DataFrame:
    """Counts per customer and value; a value that has left is dropped, and less than none is an error."""
    counts = rows.groupBy("customer_id", "amount").agg(F.sum("n").alias("n"))
    stale = F.raise_error(F.lit("a stored day has changed since it entered the window: build the window again"))
    return counts.withColumn("n", F.when(F.col("n") < 0, stale.cast("long")).otherwise(F.col("n"))).where("n <> 0")


def _seen(rows: DataFrame, day: date) -> DataFrame:
    return rows.select("customer_id", F.lit(day).alias("day")).distinct()


def advance_window(spark: SparkSession, root: str, day: date, params: RunParams, rebuild: bool = False) -> tuple[DataFrame, DataFrame]:
    """The stored window that ends with ``day``: (customer_id, amount, n), and (customer_id, day) of the days with rows.

    With yesterday's window in store, only that and the two days that enter and leave are read. Otherwise, or with
    ``rebuild`` (after a day's rows were corrected), the window is summed from its days. A day without a stored table
    counts as empty.
    """
    low = day - timedelta(days=params.lookback_days)
    values, days, stored = f"{root}/window_values", f"{root}/window_days", f"{root}/day_values"
    known = run_days(spark, stored)
    if not known:
        raise ValueError(f"{stored} holds no day")
    before = day - timedelta(days=1)
    entering = read_run_table(spark, stored, day)
    if not rebuild and before in run_days(spark, values) and before in run_days(spark, days):
        leaving = read_run_table(spark, stored, low - timedelta(days=1))
        summed = _summed(read_run_table(spark, values, before).unionByName(_signed(entering, 1)).unionByName(_signed(leaving, -1)))
        seen = read_run_table(spark, days, before).where(F.col("day") >= F.lit(low)).unionByName(_seen(entering, day))
    else:
        window, seen = entering, _seen(entering, day)
        for d in known:
            if low <= d < day:
                part = read_run_table(spark, stored, d)
                window, seen = window.unionByName(part), seen.unionByName(_seen(part, d))
        summed = _summed(window)
    return write_run_table(summed, values, day), write_run_table(seen, days, day)


def window_metrics(
    spark: SparkSession, root: str, day: date, campaigns: DataFrame, profiles: DataFrame, params: RunParams, task_rows: int = TASK_ROWS
) -> DataFrame:
    """Customer metrics of the stored window of ``day``, as ``customer_metrics_from_sources`` gives them for its rows."""
    params = replace(params, run_date=day, until=day)
    valid = date_sanitise("day", params.date_floor, params.as_of)
    dates = read_run_table(spark, f"{root}/window_days", day).groupBy("customer_id").agg(F.min(valid).alias("_first"), F.max(valid).alias("_last"))
    customers = customer_attributes(campaigns, profiles).join(dates, "customer_id", "full_outer")
    values = read_run_table(spark, f"{root}/window_values", day)
    runs = values.withColumn("_run", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / RUN))))
    rows = runs.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.least(F.lit(RUN).cast("long"), F.col("n") - F.col("_run") * RUN))))
    return metrics_of_rows(rows.select("customer_id", "amount"), customers, params, task_rows, "_first", "_last")
