"""A window that moves by days against the same window computed at once."""

import random
from dataclasses import replace
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import customers
from ledgerloom.params import RunParams
from ledgerloom.plans import sliding
from ledgerloom.session import new_shared_path

START = date(2024, 1, 1)
PARAMS = RunParams(run_date=START, lookback_days=3, min_transactions=3)


@pytest.fixture(scope="module")
def sources(spark):
    rng = random.Random(6)
    rows = [
        (i, rng.choice([1, 1, 2, 3, 4, None]), rng.choice([None, -1.0, 2e6, 10.0, 20.0, round(rng.uniform(1, 99), 2)]), START + timedelta(days=rng.randint(0, 9)))
        for i in range(900)
    ]
    rows += [(None, 1, 10.0, START + timedelta(days=6))] * 3
    transactions = spark.createDataFrame(rows, "transaction_id long, customer_id long, amount double, transaction_date date")
    campaigns = spark.createDataFrame([(1, 1, "a"), (1, 2, "a"), (2, 1, "b"), (9, 1, "c")], "customer_id long, campaign_id long, channel string")
    profiles = spark.createDataFrame([(1, "Premium"), (2, None), (2, "Standard"), (4, " ")], "customer_id long, customer_segment string")
    return transactions, campaigns, profiles


def shown(df):
    return sorted(tuple(round(x, 6) if isinstance(x, float) else str(x) for x in r) for r in df.collect())


@pytest.mark.parametrize("dedupe, task_rows", [(False, 100_000), (True, 20)])
def test_moved_windows_equal_whole_ones(spark, sources, dedupe, task_rows):
    transactions, campaigns, profiles = sources
    root, params = new_shared_path(spark, "sliding"), replace(PARAMS, dedupe_fanout=dedupe)
    for i in range(9):
        if i != 4:  # a day that was never stored is empty
            sliding.write_day(spark, root, START + timedelta(days=i), transactions, params)
    rows = transactions.where(F.col("transaction_date") != F.lit(START + timedelta(days=4)))
    for i in range(6, 9):
        day = START + timedelta(days=i)
        sliding.advance_window(spark, root, day, params)
        if i == 7:
            sliding.advance_window(spark, root, day, params)  # a rerun
        today = replace(params, as_of=day)
        got = sliding.window_metrics(spark, root, day, campaigns, profiles, today, task_rows)
        whole = customers.customer_metrics_from_sources(rows, campaigns, profiles, replace(today, run_date=day, until=day))
        assert shown(got) == shown(whole.select(*got.columns)) and got.count() >= 4


def test_only_two_days_are_read(spark, sources):
    transactions, _, _ = sources
    root = new_shared_path(spark, "sliding")
    for i in range(4, 10):
        sliding.write_day(spark, root, START + timedelta(days=i), transactions, PARAMS)
    sliding.advance_window(spark, root, START + timedelta(days=8), PARAMS)
    read = []
    original = sliding.read_run_table

    def noted(spark, path, day):
        read.append((path.rsplit("/", 1)[1], (day - START).days))
        return original(spark, path, day)

    sliding.read_run_table = noted
    try:
        sliding.advance_window(spark, root, START + timedelta(days=9), PARAMS)
    finally:
        sliding.read_run_table = original
    assert sorted(read) == [("day_values", 5), ("day_values", 9), ("window_days", 8), ("window_values", 8)]


def test_a_changed_day_is_noticed_and_the_window_built_again(spark, sources):
    transactions, campaigns, profiles = sources
    root = new_shared_path(spark, "sliding")
    for i in range(4, 10):
        sliding.write_day(spark, root, START + timedelta(days=i), transactions, PARAMS)
    sliding.advance_window(spark, root, START + timedelta(days=8), PARAMS)
    more = transactions.where("customer_id = 1").withColumn("amount", F.lit(77.77)).withColumn("transaction_date", F.lit(START + timedelta(days=5)))
    sliding.write_day(spark, root, START + timedelta(days=5), more, PARAMS)
    with pytest.raises(Exception, match="build the window again"):
        sliding.advance_window(spark, root, START + timedelta(days=9), PARAMS)
    day = START + timedelta(days=8)
    sliding.advance_window(spark, root, day, PARAMS, rebuild=True)
    rows = transactions.where(F.col("transaction_date") != F.lit(START + timedelta(days=5))).unionByName(more)
    today = replace(PARAMS, as_of=day)
    whole = customers.customer_metrics_from_sources(rows, campaigns, profiles, replace(today, run_date=day, until=day))
    assert shown(sliding.window_metrics(spark, root, day, campaigns, profiles, today)) == shown(whole)


def test_no_days(spark):
    with pytest.raises(ValueError, match="no day"):
        sliding.advance_window(spark, new_shared_path(spark, "sliding"), START, PARAMS)


def test_many_copies_of_a_value(spark, monkeypatch):
    monkeypatch.setattr(sliding, "RUN", 7)
    root, day = new_shared_path(spark, "sliding"), START
    rows = spark.range(50).select("id", F.lit(1).cast("long").alias("customer_id"), F.lit(5.0).alias("amount"), F.lit(day).alias("transaction_date")).withColumnRenamed("id", "transaction_id")
    sliding.write_day(spark, root, day, rows, PARAMS)
    sliding.advance_window(spark, root, day, PARAMS)
    none = spark.createDataFrame([], "customer_id long, campaign_id long, channel string")
    found = sliding.window_metrics(spark, root, day, none, none.select("customer_id", F.col("channel").alias("customer_segment")), replace(PARAMS, as_of=day)).collect()
    assert [(r["transaction_count"], r["median_transaction_amount"], r["first_transaction_date"]) for r in found] == [(50, 5.0, day)]
