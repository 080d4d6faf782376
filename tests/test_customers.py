from dataclasses import replace
from datetime import date

import pytest
from pyspark.sql import functions as F

from checks import mappings as m
from ledgerloom.operators import customers, extract, quality
from ledgerloom.params import RunParams

DAY = date(2024, 1, 31)
RUN = RunParams(run_date=DAY, as_of=DAY)
TX = "transaction_id long, customer_id long, product_id long, amount double, transaction_date date"
CAMPAIGNS = "customer_id long, campaign_id long, channel string"
PROFILES = "customer_id long, customer_segment string"


def sources(spark, tx, campaigns=(), profiles=()):
    return (
        spark.createDataFrame([(i, cust, 1, amount, day) for i, (cust, amount, day) in enumerate(tx)], TX),
        spark.createDataFrame(list(campaigns), CAMPAIGNS),
        spark.createDataFrame(list(profiles), PROFILES),
    )


def both(spark, src, run=RUN, **kwargs):
    """Metrics by the extracted rows and straight from the sources; they must agree."""
    by_rows = customers.customer_metrics(extract.extract_raw(*src, run), run, **kwargs)
    by_sources = customers.customer_metrics_from_sources(*src, run, **kwargs)
    order = ["customer_id", "customer_segment"]
    first, second = (df.orderBy(*order).collect() for df in (by_rows, by_sources))
    for a, b in zip(first, second, strict=True):
        for column in customers.METRIC_COLUMNS:
            assert a[column] == (pytest.approx(b[column]) if isinstance(b[column], float) else b[column]), column
    return first


def test_minimum_count(spark):
    tx = [(k, 10.0, DAY) for k in (4, 5, 6) for _ in range(k)] + [(4, None, DAY), (4, -3.0, DAY), (4, 2e6, DAY)]
    found = both(spark, sources(spark, tx))
    assert [(r["customer_id"], r["transaction_count"], r["customer_segment"]) for r in found] == [(5, 5, "Unknown"), (6, 6, "Unknown")]


@pytest.mark.parametrize("task_rows", [1, 100_000])
def test_campaigns_multiply_rows(spark, task_rows):
    tx = [(1, 1.0, DAY), (1, 2.0, DAY), (1, 9.0, date(2024, 1, 2))]
    campaigns = [(1, 7, "mail"), (1, 8, "mail"), (None, 9, "web")]
    row, = both(spark, sources(spark, tx, campaigns), task_rows=task_rows)
    assert row["transaction_count"] == 6
    assert (row["campaign_exposure_count"], row["channel_count"]) == (2, 1)
    assert row["customer_duration_days"] == 29
    assert row["median_transaction_amount"] == 2.0


def test_dedupe_counts_each_transaction_once(spark):
    tx = [(1, float(x), DAY) for x in range(1, 6)]
    campaigns = [(1, 7, "mail"), (1, 8, "web")]
    row, = both(spark, sources(spark, tx, campaigns), replace(RUN, dedupe_fanout=True))
    assert (row["transaction_count"], row["campaign_exposure_count"]) == (5, 2)


def test_two_segments_give_two_rows(spark):
    tx = [(1, float(x), DAY) for x in range(1, 6)]
    found = both(spark, sources(spark, tx, (), [(1, "A"), (1, None), (1, " "), (2, "B")]))
    assert [(r["customer_segment"], r["transaction_count"]) for r in found] == [("A", 5), ("Unknown", 10)]


def test_mean_outside_its_own_fence(spark):
    tx = [(1, 1.0, DAY)] * 9 + [(1, 1000.0, DAY)] + [(2, float(x), DAY) for x in range(1, 8)]
    src = sources(spark, tx)
    found = both(spark, src)
    assert [r["is_outlier"] for r in found] == [True, False]
    training = customers.training_table(customers.customer_metrics(extract.extract_raw(*src, RUN), RUN), RUN)
    row, = training.collect()
    # The range is taken over the kept rows only, so a single one has no scale.
    assert row["customer_id"] == 2 and row["normalized_amount"] is None
    assert row["days_since_last_transaction"] == 0 and (row["is_premium"], row["is_standard"]) == (0, 0)


def test_lookback_has_no_upper_bound(spark):
    tx = [(1, 1.0, date(2023, 12, 31)), (1, 1.0, date(2024, 1, 1)), (1, 1.0, date(2030, 1, 1)), (1, 1.0, None)]
    df = sources(spark, tx)[0]
    assert extract.lookback_filter(df, DAY).count() == 2
    assert extract.lookback_filter(df, DAY, until=DAY).count() == 1


def test_extract_keeps_unmatched_and_null_customers(spark):
    tx = [(1, 1.0, DAY), (2, 1.0, DAY), (None, 1.0, DAY)]
    src = sources(spark, tx, [(1, 5, "x"), (3, 6, "y"), (None, 1, "z")], [(2, "S"), (None, "T")])
    raw = extract.extract_raw(*src, RUN)
    assert raw.columns == extract.RAW_COLUMNS
    found = {(r["customer_id"], r["campaign_id"], r["customer_segment"]) for r in raw.collect()}
    assert found == {(1, 5, None), (2, None, "S"), (None, None, None)}
    chained = extract.join_profiles(extract.join_campaigns(src[0], src[1]), src[2])
    assert sorted(map(str, extract.project_training_cols(chained).collect())) == sorted(map(str, raw.collect()))


def test_reports_over_nothing(spark):
    raw = extract.extract_raw(*sources(spark, []), RUN)
    row = quality.dq_raw(raw).first()
    assert (row["total_rows"], row["null_amounts"], row["pct_null_amounts"]) == (0, None, None)
    clean = quality.dq_clean(customers.customer_metrics(raw, RUN)).first()
    assert (clean["total_rows"], clean["outlier_customers"], clean["null_dates"]) == (0, None, 0)


def test_report_has_both_rows_and_all_columns(spark):
    raw = extract.extract_raw(*sources(spark, [(1, 5.0, DAY)] * 5 + [(None, -1.0, None)]), replace(RUN, lookback_days=400))
    report = quality.dq_report(quality.dq_raw(raw), quality.dq_clean(customers.customer_metrics(raw, RUN)))
    assert report.columns == list(quality.REPORT_COLUMNS) and len(report.columns) == 16
    rows = {r["dataset_type"]: r for r in report.collect()}
    assert rows["raw_data"]["pct_outliers"] is None and rows["clean_data"]["pct_outliers"] == 0.0


def test_constant_column_has_no_share(spark):
    df = spark.createDataFrame([(1, 5.0), (2, 5.0)], "id int, v double")
    assert {r["s"] for r in customers.minmax_normalise(df, "v", "s").collect()} == {None}


# Known results of the chain over the driver tables.
GOLDEN = {
    "t1": (2022, 147, 1, 146, 1947, 226862, 15, 75, 76.75, 34),
    "t2": (8931, 15, 0, 15, 8931, 434, 63, 59, 7.85, 5),
}


@pytest.mark.parametrize("name, run", [("t1", m.T1), ("t2", m.T2)])
def test_known_results(spark, sf, name, run):
    src = getattr(m, f"{name}_sources")(spark, sf)
    raw = extract.extract_raw(*src, run)
    metrics = customers.customer_metrics(raw, run)
    training = customers.training_table(metrics, run)
    sums = training.agg(
        F.count("*"), F.sum("transaction_count"), F.sum("customer_duration_days"), F.sum("campaign_exposure_count"),
        F.sum("channel_count"), F.round(F.sum(F.round("normalized_amount", 4)), 2), F.sum("is_building"),
    ).first()
    outliers = metrics.where("is_outlier").count()
    assert (raw.count(), metrics.count(), outliers, *sums) == GOLDEN[name]
