import math
import statistics
from datetime import date, datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.functions.schema import numeric_columns, string_columns
from ledgerloom.operators import encode, features, impute, outliers, skew, split
from ledgerloom.operators.split import stratified_split
from ledgerloom.params import FeatureParams
from ledgerloom.plans import features as plan

CRITICAL = ("transaction_id", "customer_id", "amount")
SAMPLE = FeatureParams(
    critical_columns=CRITICAL, key_columns=("transaction_id",), categorical_columns=("merchant_category",)
)


def column(df, name, order="transaction_id"):
    return [r[name] for r in df.orderBy(order).select(name).collect()]


def test_critical_nulls(spark):
    rows = [(i or None, None if i % 3 == 1 else 70 + i, None) for i in range(11)]
    df = spark.createDataFrame(rows, "transaction_id long, customer_id long, amount double")
    kept = impute.drop_critical_nulls(df, ["transaction_id", "customer_id"])
    assert column(kept, "transaction_id") == [2, 3, 5, 6, 8, 9]
    assert impute.drop_critical_nulls(df, []).count() == 11


def test_large_ids_stay_apart(spark):
    ids = [9007199254740992, 9007199254740993, 9007199254740994, 9007199254740995]
    df = spark.createDataFrame([(i, n, 2 * n) for n, i in enumerate(ids)] + [(ids[0], None, 0)], "customer_id long, gap int, even int")
    fills = impute.fit_impute(df)
    filled = impute.apply_impute(df, fills)
    assert filled.select("customer_id").distinct().count() == 4
    assert dict(filled.dtypes) == {"customer_id": "bigint", "gap": "double", "even": "int"} and fills["gap"] == 1.5


def test_columns_by_type(spark):
    df = spark.createDataFrame([(1, 1.0, "a", True, date(2024, 1, 1))], "i int, d double, s string, b boolean, t date")
    assert (numeric_columns(df), string_columns(df)) == (["i", "d"], ["s"])
    assert numeric_columns(df, ("i",)) == ["d"]


def test_modes(spark):
    df = spark.createDataFrame([("b", None), ("a", None), ("b", "x"), ("a", None), (None, None), (None, None), (None, None)], "t string, u string")
    assert impute.column_mode(df, ["t", "u"]) == {"t": "a", "u": "x"}


def test_fill(spark, transactions_with_nulls):
    fills = impute.fit_impute(transactions_with_nulls)
    amounts = [x for x in column(transactions_with_nulls, "amount") if x is not None]
    assert fills["amount"] == pytest.approx(statistics.median(amounts))
    filled = impute.apply_impute(transactions_with_nulls, fills)
    assert filled.where("amount IS NULL OR merchant_category IS NULL").isEmpty()
    assert filled.columns == transactions_with_nulls.columns


def test_nothing_to_learn_from_raises_with_the_column(spark):
    df = spark.createDataFrame([(1, None, None)], "a int, empty string, hollow double")
    with pytest.raises(ValueError, match="empty"):
        impute.fit_impute(df.drop("hollow"))
    with pytest.raises(ValueError, match="hollow"):
        impute.fit_impute(df.drop("empty"))
    with pytest.raises(ValueError, match="hollow"):
        outliers.iqr_filter_onepass(df)


def sequential(rows, names):
    for i in range(len(names)):
        values = [r[i] for r in rows]
        q1, q3 = np.quantile(values, [0.25, 0.75])
        rows = [r for r in rows if q1 - 1.5 * (q3 - q1) <= r[i] <= q3 + 1.5 * (q3 - q1)]
    return rows


@pytest.mark.parametrize("task_rows", [10, 100_000])
def test_sequential_filter(spark, transactions, task_rows):
    names = numeric_columns(transactions)
    rows = [tuple(float(x) for x in r) for r in transactions.select(*names).collect()]
    kept = outliers.iqr_filter_sequential(transactions, task_rows=task_rows).select(*names).collect()
    assert sorted(tuple(map(float, r)) for r in kept) == sorted(sequential(rows, names))
    # The label counts as a number there, so its rare class disappears.
    assert {r["target"] for r in kept} == {0}


def test_onepass_filter_spares_label_and_keys(spark, transactions):
    kept = outliers.iqr_filter_onepass(transactions, ["target", "transaction_id"])
    assert {r["target"] for r in kept.select("target").collect()} == {0, 1}
    df = spark.createDataFrame([(float(x),) for x in [1, 2, 3, 4, 100]] + [(None,)], "v double")
    assert sorted(column(outliers.iqr_filter_onepass(df), "v", "v")) == [1, 2, 3, 4]


@pytest.mark.parametrize("task_rows", [4, 100_000])
@pytest.mark.parametrize("missing", [0, 1, 7, 60])
@pytest.mark.parametrize("n", [1, 2, 5, 40, 41])
def test_medians_and_fences_from_one_search(spark, n, missing, task_rows):
    rng = np.random.default_rng(n)
    values = [float(x) for x in rng.normal(0, 3, n).round(1)]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)] * missing, "v double")
    medians, fences = outliers.fit_filled_fences(df, ["v"], task_rows)
    middle = statistics.median(values)
    q1, q3 = np.quantile(values + [middle] * missing, [0.25, 0.75])
    assert medians["v"] == pytest.approx(middle)
    assert fences["v"] == pytest.approx((q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)))


def test_date_parts(spark):
    df = spark.createDataFrame([("2024-01-01",), ("2024-01-07 23:30:00",)], "d string")
    rows = features.date_features(df, ["d", "nowhere"]).orderBy("d").collect()
    assert [(r["d_year"], r["d_month"], r["d_dayofweek"]) for r in rows] == [(2024, 1, 0), (2024, 1, 6)]
    assert rows[0]["d"] == datetime(2024, 1, 1)
    with pytest.raises(Exception, match="(?i)cast|parse"):
        features.date_features(spark.createDataFrame([("soon",)], "d string"), ["d"]).collect()


def test_customer_aggregates(spark):
    df = spark.createDataFrame([(1, 2.0), (1, 4.0), (2, 5.0), (3, None), (None, 7.0)], "customer_id long, amount double")
    rows = {(r[0], r[1]): tuple(r[2:]) for r in features.customer_features(df).collect()}
    assert rows[1, 2.0] == (3.0, pytest.approx(math.sqrt(2)), 2, 6.0)
    assert rows[2, 5.0] == (5.0, None, 1, 5.0)
    assert rows[3, None] == (None, None, 0, 0.0)
    assert rows[None, 7.0] == (None,) * 4
    assert features.customer_features(df.drop("amount")).columns == ["customer_id"]


def test_encoding(spark):
    df = spark.createDataFrame([("b", 1), ("a", 2), (None, 3), ("c", 4), ("a", 5)], "s string, id int")
    classes = encode.label_encode_fit(df, ["s"])
    assert [(r["value"], r["index"]) for r in classes.orderBy("index").collect()] == [("None", 0), ("a", 1), ("b", 2), ("c", 3)]
    assert column(encode.label_encode_apply(df, classes), "s", "id") == [2, 1, 0, 3, 1]
    other = spark.createDataFrame([("zz", 1), ("a", 2)], "s string, id int")
    assert column(encode.label_encode_apply(other, classes), "s", "id") == [-1, 1]
    assert column(encode.isin_known(other, "s", classes), "is_known", "id") == [False, True]
    assert encode.label_encode_apply(df.drop("s"), classes).columns == ["id"]


def test_long_class_list_joins_by_shuffle(spark, monkeypatch):
    monkeypatch.setattr(encode, "BROADCAST_BYTES", 1)
    df = spark.createDataFrame([("b", 1), ("a", 2), ("x", 3)], "s string, id int")
    classes = encode.label_encode_fit(df.where("id < 3"), ["s"])
    assert column(encode.label_encode_apply(df, classes), "s", "id") == [1, 0, -1]


def test_scaling(spark):
    df = spark.createDataFrame([(1, 10.0, 3), (2, 20.0, 3), (3, None, 3), (4, 60.0, 3)], "id int, v double, c int")
    scales = encode.standard_scale_fit(df, ["v", "c"])
    assert scales["v"] == (30.0, pytest.approx(np.std([10, 20, 60]))) and scales["c"] == (3.0, 1.0)
    out = encode.standard_scale_apply(df, scales)
    assert column(out, "c", "id") == [0.0] * 4
    assert column(out, "v", "id")[2] is None
    with pytest.raises(ValueError, match="missing"):
        encode.standard_scale_apply(df.drop("v"), scales)


def test_fitted_row_must_be_one(spark):
    df = spark.createDataFrame([(1,), (2,)], "a int")
    assert encode.join_fitted_params(df, df.agg(F.max("a").alias("m"))).count() == 2
    with pytest.raises(ValueError, match="one row"):
        encode.join_fitted_params(df, df.toDF("m"))


def test_split_target(spark, transactions):
    kept, target = features.split_target(transactions, "target")
    assert "target" not in kept.columns and target.columns == ["target"]
    assert features.split_target(kept, "target")[1] is None


@pytest.mark.parametrize("task_rows", [5, 100_000])
def test_split_sizes(spark, transactions, task_rows):
    marked = stratified_split(transactions, "transaction_id", "target", 0.2, 42, task_rows)
    assert marked.columns == [*transactions.columns, "is_test"]
    counts = {r["target"]: (r["n"], r["t"]) for r in marked.groupBy("target").agg(F.count("*").alias("n"), F.count_if("is_test").alias("t")).collect()}
    assert sum(n for n, _ in counts.values()) == 100 and sum(t for _, t in counts.values()) == 20
    assert all(abs(t - 0.2 * n) < 1 for n, t in counts.values())
    chosen = {r[0] for r in marked.where("is_test").select("transaction_id").collect()}
    again = stratified_split(transactions.repartition(7), "transaction_id", "target", 0.2, 42, 100_000)
    assert chosen == {r[0] for r in again.where("is_test").select("transaction_id").collect()}
    other = stratified_split(transactions, "transaction_id", "target", 0.2, 43)
    assert chosen != {r[0] for r in other.where("is_test").select("transaction_id").collect()}


def test_split_with_rows_tied_at_the_border(spark, transactions, monkeypatch):
    """Positions that collide: the seats left at the border go by key."""
    monkeypatch.setattr(split, "split_order", lambda keys, seed: F.pmod(F.col(keys[0]), F.lit(3)))
    marked = split.stratified_split(transactions, "transaction_id", "target", 0.4).collect()
    assert sum(r["is_test"] for r in marked) == 40
    for label in (0, 1):
        rows = sorted((r["transaction_id"] % 3, r["transaction_id"], r["is_test"]) for r in marked if r["target"] == label)
        flags = [r[2] for r in rows]
        assert flags == sorted(flags, reverse=True)


def test_split_refuses_what_it_cannot_divide(spark):
    df = spark.createDataFrame([(i, "ab"[i > 3]) for i in range(5)], "id int, c string")
    with pytest.raises(ValueError, match="1 member"):
        stratified_split(df, "id", "c")
    with pytest.raises(ValueError, match="empty"):
        stratified_split(df.where("id < 0"), "id", "c")
    with pytest.raises(ValueError, match="missing"):
        stratified_split(df.withColumn("c", F.lit(None).cast("string")), "id", "c")
    many = spark.createDataFrame([(i, str(i // 2)) for i in range(8)], "id int, c string")
    with pytest.raises(ValueError, match="classes"):
        stratified_split(many, "id", "c", 0.1)


def test_prepare_training_then_inference(spark, transactions):
    rows, target, fitted = plan.prepare_dataframe(transactions, SAMPLE, is_training=True)
    assert target.columns == ["target"] and "target" not in rows.columns
    assert set(features.CUSTOMER_FEATURES) <= set(rows.columns)
    means = rows.agg(*[F.avg(c) for c in fitted.feature_columns()]).first()
    assert all(abs(x) < 1e-9 for x in means)
    assert "transaction_id" not in fitted.feature_columns() and column(rows, "transaction_id")[0] == 1

    record = spark.createDataFrame(
        [(7, 3, None, "never seen", 5, 1, 0, 9e9)], transactions.drop("target").schema
    )
    scored, no_target, _ = plan.prepare_dataframe(record, SAMPLE, fitted=fitted)
    row = scored.first()
    assert no_target is None and row["transaction_id"] == 7  # neither unseen nor extreme values drop a row
    mean, std = fitted.scales["merchant_category"]
    assert row["merchant_category"] == pytest.approx((-1 - mean) / std)
    with pytest.raises(ValueError, match="fitted"):
        plan.prepare_dataframe(record, SAMPLE)


def test_strict_mode_filters_keys_and_label(spark, transactions):
    strict = FeatureParams(critical_columns=CRITICAL, strict_reference=True)
    rows, target, fitted = plan.prepare_dataframe(transactions, strict, is_training=True)
    assert {r[0] for r in target.distinct().collect()} == {0}
    batch, _, _ = plan.prepare_dataframe(transactions, strict, fitted=fitted)
    assert batch.count() == rows.count() < 100


def test_feature_model_survives_storage(spark, transactions, tmp_path):
    _, _, fitted = plan.prepare_dataframe(transactions, SAMPLE, is_training=True)
    fitted.save(str(tmp_path / "f"))
    again = plan.load_feature_model(spark, str(tmp_path / "f"))
    assert (again.params, again.fills, again.scales, again.sizes) == (fitted.params, fitted.fills, fitted.scales, fitted.sizes)
    a, b = (f.transform(transactions).orderBy("transaction_id").collect() for f in (fitted, again))
    assert a == b


def test_prepare_data_from_files(spark, transactions, tmp_path):
    csv, parquet = str(tmp_path / "t.csv"), str(tmp_path / "t.parquet")
    transactions.write.option("header", True).csv(csv)
    transactions.write.parquet(parquet)
    results = [
        plan.prepare_data(spark, path, SAMPLE, schema=transactions.schema if path == csv else None)[0]
        for path in (csv, parquet)
    ]
    a, b = (r.orderBy("transaction_id").toPandas() for r in results)
    np.testing.assert_allclose(a.to_numpy(float), b.to_numpy(float), rtol=1e-9, atol=1e-9)


@pytest.mark.parametrize("name", ["rank", "ties", "below", "n", "quota"])
def test_labels_may_have_any_name(spark, name):
    df = spark.createDataFrame([(i, i % 2) for i in range(40)], f"id long, {name} int")
    placed = stratified_split(df, "id", name, task_rows=3)
    assert placed.columns == ["id", name, "is_test"] and placed.where("is_test").groupBy(name).count().collect() == [(0, 4), (1, 4)]


@pytest.mark.parametrize("broadcast_bytes", [64 << 20, 0])
def test_split_of_many_classes(spark, monkeypatch, broadcast_bytes):
    """20,000 classes of few rows and a hot one: the quotas are those of largest remainders, smaller label on ties."""
    monkeypatch.setattr(split, "BROADCAST_BYTES", broadcast_bytes)
    monkeypatch.setattr(skew, "BROADCAST_BYTES", broadcast_bytes)
    classes, hot = 20_000, 30_000
    few = spark.range(classes).select(F.explode(F.sequence(F.lit(1), 2 + F.col("id") % 3)).alias("i"), F.col("id").alias("c"))
    many = spark.range(hot).select(F.col("id").alias("i"), F.lit(-1).cast("long").alias("c"))
    df = few.union(many).select("c", F.concat_ws("/", "c", "i").alias("k"))
    found = {r["c"]: r["t"] for r in split.stratified_split(df, "k", "c", 0.4).groupBy("c").agg(
        F.count_if("is_test").alias("t")).collect()}
    sizes = {c: 2 + c % 3 for c in range(classes)} | {-1: hot}
    n = sum(sizes.values())
    total = -(-n * 4 // 10)
    want = {c: size * total // n for c, size in sizes.items()}
    for c in sorted(sizes, key=lambda c: (-(sizes[c] * total % n), c))[: total - sum(want.values())]:
        want[c] += 1
    assert found == want


def test_quotas_of_very_large_classes_are_whole_numbers(spark):
    """Counts whose product with the test rows leaves 64 bits; equal remainders go by label."""
    counts = spark.createDataFrame([("b", 10**15 + 1), ("a", 10**15 + 1), ("c", 5)], "c string, n long")
    n, share = 2 * 10**15 + 7, 0.25
    total = math.ceil(n * share)
    sizes = {"a": 10**15 + 1, "b": 10**15 + 1, "c": 5}
    want = {c: size * total // n for c, size in sizes.items()}
    for c in sorted(sizes, key=lambda c: (-(sizes[c] * total % n), c))[: total - sum(want.values())]:
        want[c] += 1
    assert {r["c"]: r["quota"] for r in split.class_quotas(counts, "c", n, share).collect()} == want


def test_split_refuses_a_key_that_repeats_at_a_border(spark):
    df = spark.createDataFrame([(1, "a")] * 10, "k int, c string")
    with pytest.raises(ValueError, match="not unique"):
        split.stratified_split(df, "k", "c", 0.3)
