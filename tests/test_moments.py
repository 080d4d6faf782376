"""Moments that merge: over parts, over days, in arrival order, and as state of a stream."""

import random
import statistics
from datetime import date

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from ledgerloom.operators import model, moments
from ledgerloom.operators.features import CUSTOMER_FEATURES
from ledgerloom.params import FeatureParams, ModelParams
from ledgerloom.plans import features as plan
from ledgerloom.session import new_shared_path
from ledgerloom.sources import tables
from ledgerloom.streaming import arrivals, running

SCHEMA = "at long, customer_id long, amount double, note string, big long"


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(8)
    found = [(i, rng.choice([1, 1, 1, 1, 2, 3, 4, None]), rng.choice([None, 1e6 + rng.random(), rng.uniform(-5, 5)]), f"n{i}", rng.choice([None, 2**60 + i])) for i in range(200)]
    return found + [(200, 9, None, "only a gap", 1), (201, 8, 5.0, "only one", None)]


def stats(amounts):
    a = [x for x in amounts if x is not None]
    return (statistics.fmean(a) if a else None, statistics.stdev(a) if len(a) > 1 else None, len(a), sum(a))


def close(got, expected):
    return all((g is None) == (e is None) and (g is None or g == pytest.approx(e, rel=1e-9, abs=1e-6)) for g, e in zip(got, expected))


def by_customer(df):
    return {r.customer_id: tuple(r[c] for c in CUSTOMER_FEATURES) for r in df.collect()}


def test_parts_merge_into_one_pass(spark, rows):
    parts = [spark.createDataFrame([r for r in rows if r[0] % 4 == i], SCHEMA) for i in range(4)]
    got = by_customer(moments.stats_of_moments(moments.merge_moments(*map(moments.customer_moments, parts))))
    assert set(got) == {1, 2, 3, 4, 8, 9}
    for c, found in got.items():
        assert close(found, stats([r[2] for r in rows if r[1] == c]))
    assert got[9] == (None, None, 0, 0.0) and got[8] == (5.0, None, 1, 5.0)


def test_days_are_merged_once_and_may_be_rerun(spark, rows):
    path, days = new_shared_path(spark, "moments"), [date(2024, 1, d) for d in (1, 2, 3)]
    parts = [spark.createDataFrame([r for r in rows if r[0] % 3 == i], SCHEMA) for i in range(3)]
    for day, part in zip(days, parts):
        moments.update_customer_moments(spark, path, day, part)
    for _ in range(2):
        moments.update_customer_moments(spark, path, days[1], parts[1])
    last = moments.update_customer_moments(spark, path, days[2], parts[2])
    for c, found in by_customer(moments.stats_of_moments(last)).items():
        assert close(found, stats([r[2] for r in rows if r[1] == c]))
    before = by_customer(moments.stats_of_moments(tables.read_run_table(spark, path, days[0])))
    assert close(before[1], stats([r[2] for r in rows if r[1] == 1 and r[0] % 3 == 0]))


def running_by_hand(rows, seed=()):
    seen, out = {}, {}
    for at, customer, amount, *_ in sorted([(-1, *s) for s in seed] + [r[:3] for r in rows], key=lambda r: r[0]):
        seen.setdefault(customer, []).append(amount)
        out[at] = stats(seen[customer]) if customer is not None else (None,) * 4
    return out


@pytest.mark.parametrize("seed", [(), [(1, 100.0), (1, 300.0), (3, 7.0)]])
def test_running_features(spark, rows, seed):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    seeds = moments.customer_moments(spark.createDataFrame(seed, "customer_id long, amount double")) if seed else None
    got = moments.running_customer_features(df, ["at"], seeds)
    assert got.columns == [*df.columns, *CUSTOMER_FEATURES] and got.count() == len(rows)
    expected = running_by_hand(rows, seed)
    for r in got.collect():
        assert close([r[c] for c in CUSTOMER_FEATURES], expected[r["at"]])
    plan_text = got._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan_text


def test_stream_with_state_equals_table(spark, rows):
    """Files arrive one by one; the query is started again for the last ones and repeats nothing."""
    seed = [(1, 100.0), (1, 300.0), (3, 7.0), (77, 1.0)]
    seeds = moments.customer_moments(spark.createDataFrame(seed, "customer_id long, amount double"))
    folder, out, state = (new_shared_path(spark, n) for n in ("in", "out", "state"))
    for low in (0, 70, 140):
        part = [r for r in rows if low <= r[0] < low + 70]
        random.Random(low).shuffle(part)
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(folder)
        if low:
            source = arrivals.arrival_source(spark, folder, SCHEMA, files_per_batch=1)
            found = running.running_stream_features(source, ["at"], seeds)
            arrivals.write_stream(found, out, state, conf=running.STATE_CONF).awaitTermination()
    got, expected = spark.read.parquet(out).collect(), running_by_hand(rows, seed)
    assert sorted(r["at"] for r in got) == list(range(202))
    for r in got:
        assert close([r[c] for c in CUSTOMER_FEATURES], expected[r["at"]])
    assert {r["at"]: r["big"] for r in got} == {r[0]: r[4] for r in rows}  # whole numbers beyond 2^53, and gaps
    assert spark.conf.get("spark.sql.streaming.noDataMicroBatches.enabled") == "true"


class KeptState:
    """A customer's state without a store."""

    def __init__(self):
        self.value = None

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value


def test_state_moves_row_by_row_without_a_table_per_customer():
    """Rows come and go as they are: a table per customer and batch cost more than the work. Missing places go last."""
    mover = running.RunningMoments(["day", "at"], None)
    mover.state = KeptState()
    mover.handleInitialState((1,), Row(customer_id=1, n=2, total=10.0, m2=2.0), None)
    mover.handleInitialState((1,), Row(customer_id=1, n=9, total=1.0, m2=1.0), None)
    days = [(None, 1), (date(2024, 1, 2), None), (date(2024, 1, 2), 7), (date(2024, 1, 1), 9)]
    amounts = [8.0, None, float("nan"), 5.0]
    rows = [Row(day=d, at=a, customer_id=1, amount=x) for (d, a), x in zip(days, amounts)]
    got = list(mover.handleInputRows((1,), iter(rows), None))
    assert [(r["day"], r["at"]) for r in got] == [days[3], days[2], days[1], days[0]]
    assert [r["customer_transaction_count"] for r in got] == [3, 3, 3, 4]
    assert [r["customer_total_amount"] for r in got] == [15.0, 15.0, 15.0, 23.0]
    assert close([got[-1][c] for c in CUSTOMER_FEATURES], stats([4.0, 6.0, 5.0, 8.0]))
    assert mover.state.value[:2] == (4, 23.0)


def fitted(spark, transactions):
    params = FeatureParams(key_columns=("transaction_id", "customer_id"))
    model_, prepared = plan.fit_features(transactions, params)
    return model_, model.train(prepared, model_.feature_columns(), "target", ModelParams(n_estimators=5, max_depth=4))


def scores(df):
    return {r["transaction_id"]: (r["prediction"], tuple(r["probability"])) for r in df.collect()}


def test_a_record_scores_the_same_alone_in_a_batch_and_in_a_stream(spark, transactions):
    features, forest = fitted(spark, transactions)
    rows = transactions.drop("target")
    batch = scores(model.batch_score(rows, forest, features, "transaction_id"))
    path = new_shared_path(spark, "features")
    features.save(path)
    again = plan.load_feature_model(spark, path)
    for i in (1, 50):
        assert scores(model.batch_score(rows.where(F.col("transaction_id") == i), forest, again, "transaction_id")) == {i: batch[i]}
    folder, out, state = (new_shared_path(spark, n) for n in ("in", "out", "state"))
    rows.repartition(4).write.parquet(folder)
    source = arrivals.arrival_source(spark, folder, rows.schema, files_per_batch=1)
    arrivals.stream_score(source, forest, out, state, features, "transaction_id").awaitTermination()
    assert scores(spark.read.parquet(out)) == batch


def test_stream_score_with_running_aggregates(spark, transactions):
    features, forest = fitted(spark, transactions)
    later = transactions.drop("target").withColumn("transaction_id", F.col("transaction_id") + 1000)
    folder, out, state = (new_shared_path(spark, n) for n in ("in", "out", "state"))
    later.coalesce(1).write.parquet(folder)
    source = arrivals.arrival_source(spark, folder, later.schema)
    arrivals.stream_score(source, forest, out, state, features, "transaction_id", running_order=["transaction_id"]).awaitTermination()
    table = moments.running_customer_features(features.fill(later), ["transaction_id"], features.customers)
    got, expected = scores(spark.read.parquet(out)), scores(model.batch_score(table, forest, features, "transaction_id"))
    assert set(got) == set(expected) and len(got) == 100
    assert sum(got[i][0] == expected[i][0] for i in got) >= 99  # a sum in another order may cross a split
    moved = features.with_new_rows(later)
    assert moved.customers.agg(F.sum("n")).first()[0] == 100 + features.customers.agg(F.sum("n")).first()[0]


def test_running_aggregates_need_a_fit(spark, transactions):
    with pytest.raises(ValueError, match="fitted"):
        arrivals.stream_score(transactions, None, "x", "y", running_order=["transaction_id"])
