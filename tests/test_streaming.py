from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import features, model
from ledgerloom.params import FeatureParams, ModelParams
from ledgerloom.plans import features as plan
from ledgerloom.session import new_shared_path
from ledgerloom.streaming import alerts, arrivals

START = datetime(2024, 1, 1)
EVENTS = "ts timestamp, event_type string"


def events(spark, seconds, kind="401"):
    return spark.createDataFrame([(START + timedelta(seconds=s), kind) for s in seconds], EVENTS)


def run(query):
    query.awaitTermination()


def test_rate_is_per_second(spark):
    df = events(spark, [i / 2 for i in range(600)]).union(events(spark, range(300), "403"))
    found = alerts.rate_alert(df, "401", 1.9, "5 minutes", "5 minutes").collect()
    assert [(r["n_events"], r["per_second"]) for r in found] == [(600, 2.0)]
    assert alerts.rate_alert(df, "401", 2.0, "5 minutes", "5 minutes").isEmpty()
    assert alerts.AUTH_FAILURES == ("401", "5 minutes", 10.0)


def test_late_events_are_dropped(spark):
    folder, out, state = (new_shared_path(spark, n) for n in ("in", "out", "state"))

    def take():
        source = arrivals.arrival_source(spark, folder, EVENTS, files_per_batch=1)
        found = alerts.rate_alert(source, "401", 0.0, "1 minute", "1 minute", "2 minutes")
        run(arrivals.write_stream(found, out, state))

    events(spark, [0, 10, 20, 600]).coalesce(1).write.mode("append").parquet(folder)
    take()
    events(spark, [30, 700]).coalesce(1).write.mode("append").parquet(folder)  # 30 lies before the watermark
    take()
    events(spark, [2000]).coalesce(1).write.mode("append").parquet(folder)
    take()
    found = {r["window_start"]: r["n_events"] for r in spark.read.parquet(out).collect()}
    minute = timedelta(minutes=1)
    assert found == {START: 3, START + 10 * minute: 1, START + 11 * minute: 1}


def test_stream_equals_table(spark):
    df = events(spark, [i * 7 for i in range(400)])
    folder, out, state = (new_shared_path(spark, n) for n in ("in", "out", "state"))
    df.write.parquet(folder)
    stream = alerts.rate_alert(arrivals.arrival_source(spark, folder, EVENTS), "401", 0.1)
    run(arrivals.write_stream(stream, out, state))
    closed = START + timedelta(seconds=399 * 7) - timedelta(minutes=10)
    table = alerts.rate_alert(df, "401", 0.1).where(F.col("window_end") <= F.lit(closed))
    assert sorted(map(str, spark.read.parquet(out).collect())) == sorted(map(str, table.collect()))


def test_only_new_files_are_taken(spark):
    folder, out, state = (new_shared_path(spark, n) for n in ("in", "out", "state"))
    for batch in ([(1, 1.0), (2, float("nan"))], [(3, 3.0)]):
        spark.createDataFrame(batch, "id long, v double").coalesce(1).write.mode("append").parquet(folder)
        source = arrivals.arrival_source(spark, folder, "id long, v double")
        run(arrivals.write_stream(source, out, state))
    assert sorted(map(tuple, spark.read.parquet(out).collect())) == [(1, 1.0), (2, None), (3, 3.0)]


@pytest.mark.parametrize("with_stats", [False, True])
def test_arriving_records_are_scored_as_in_batch(spark, transactions, with_stats):
    rows = transactions if with_stats else transactions.drop("customer_id")
    params = FeatureParams(key_columns=("transaction_id", "customer_id"))
    fitted, prepared = plan.fit_features(rows, params)
    forest = model.train(prepared, fitted.feature_columns(), "target", ModelParams(n_estimators=5, max_depth=4))
    stats = features.customer_stats(rows) if with_stats else None
    folder, out, state = (new_shared_path(spark, n) for n in ("in", "out", "state"))
    rows.drop("target").write.parquet(folder)
    source = arrivals.arrival_source(spark, folder, rows.drop("target").schema)
    run(arrivals.stream_score(source, forest, out, state, fitted, "transaction_id", stats))
    batch = model.batch_score(rows.drop("target"), forest, fitted, "transaction_id", stats)
    a, b = ({r["transaction_id"]: (r["prediction"], tuple(r["probability"])) for r in df.collect()} for df in (spark.read.parquet(out), batch))
    assert a == b and len(a) == 100


def test_expiry(spark):
    df = spark.createDataFrame([(i, date(2024, 1, 1) + timedelta(days=d)) for i, d in enumerate([-1, 0, 29, 30])], "i int, expiry date")
    found = alerts.expiry_alert(df, "expiry", 30, date(2024, 1, 1)).orderBy("i").collect()
    assert [(r["i"], r["days_left"]) for r in found] == [(0, -1), (1, 0), (2, 29)]
