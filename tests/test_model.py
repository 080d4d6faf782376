from datetime import date

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import model
from ledgerloom.params import FeatureParams, ModelParams
from ledgerloom.plans import features as plan
from ledgerloom.plans import retraining
from ledgerloom.sources import tables
from checks import mappings as m

COLUMNS = [f"feature_{i}" for i in range(1, 6)]
FOREST = ModelParams(n_estimators=10, max_depth=5)
LOGISTIC = ModelParams(model_type="logistic_regression", max_iter=100)


@pytest.fixture(scope="module", params=[FOREST, LOGISTIC], ids=["forest", "logistic"])
def trained(request, model_rows):
    return model.train(model_rows, COLUMNS, "target", request.param)


def test_defaults():
    forest = model.create_model(ModelParams(), 10)
    assert (forest.getNumTrees(), forest.getMaxDepth(), forest.getSeed()) == (100, 30, 42)
    assert model.create_model(ModelParams(model_type="logistic_regression"), 10).getMaxIter() == 1000
    with pytest.raises(ValueError, match="unsupported"):
        model.create_model(ModelParams(model_type="svm"), 10)


def test_scores(trained, model_rows):
    rows = trained.score(model_rows).collect()
    assert len(rows) == 300
    for r in rows:
        assert r["prediction"] in (0, 1) and sum(r["probability"]) == pytest.approx(1)
        assert r["prediction"] == int(np.argmax(r["probability"]))
    assert "probability" not in trained.predict(model_rows).columns
    assert "prediction" not in trained.predict_proba(model_rows).columns


def test_measures_in_range(trained, model_rows):
    metrics = model.evaluate(trained, model_rows, "target")
    assert set(metrics) == {"accuracy", "precision", "recall", "f1_score", "auc"}
    assert all(0 <= v <= 1 for v in metrics.values()) and metrics["accuracy"] > 0.85 and metrics["auc"] > 0.9
    assert trained.metrics == metrics and trained.seconds > 0


def test_same_seed_same_model(trained, model_rows):
    again = model.train(model_rows, COLUMNS, "target", trained.params)
    a, b = (t.score(model_rows).orderBy("row_id").collect() for t in (trained, again))
    assert a == b


def test_logistic_optimum(spark, model_rows):
    """Newton's method on the summed loss plus half the squared weights gives the same coefficients."""
    data = np.array([tuple(r) for r in model_rows.select(*COLUMNS, "target").collect()])
    x, y = np.c_[data[:, :5], np.ones(len(data))], data[:, 5]
    w, ridge = np.zeros(6), np.diag([1.0] * 5 + [0.0])
    for _ in range(30):
        p = 1 / (1 + np.exp(-x @ w))
        w -= np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, x.T @ (p - y) + ridge @ w)
    fitted = model.train(model_rows, COLUMNS, "target", LOGISTIC).model
    np.testing.assert_allclose([*fitted.coefficients, fitted.intercept], w, rtol=1e-3, atol=1e-3)


def test_text_labels_and_many_classes(model_rows):
    named = model_rows.withColumn("target", F.when(F.col("feature_1") < 0.3, "low").when(F.col("feature_1") < 0.6, "mid").otherwise("top"))
    forest = model.train(named, COLUMNS, "target", FOREST)
    assert forest.classes == ["low", "mid", "top"]
    metrics = model.evaluate(forest, named, "target")
    assert metrics["auc"] > 0.9
    with pytest.raises(ValueError, match="classes in the labels"):
        model.evaluate(forest, named.where("target = 'low'"), "target")


def test_untrained(model_rows):
    empty = model.Classifier(FOREST, COLUMNS, [0, 1])
    for action in (empty.predict, empty.predict_proba, lambda d: model.evaluate(empty, d, "target")):
        with pytest.raises(ValueError, match="trained"):
            action(model_rows)
    with pytest.raises(ValueError, match="trained"):
        empty.save("nowhere")
    with pytest.raises(ValueError, match="no model"):
        model.batch_score(model_rows, None)


def test_bad_training_rows(spark, model_rows):
    with pytest.raises(ValueError, match="empty"):
        model.train(model_rows.where("row_id < 0"), COLUMNS, "target", FOREST)
    with pytest.raises(ValueError, match="not numeric"):
        model.train(model_rows, ["feature_9"], "target", FOREST)
    with pytest.raises(ValueError, match="missing values"):
        model.train(model_rows.withColumn("target", F.nullif("target", F.lit(1))), COLUMNS, "target", FOREST)


def test_save_and_load(spark, trained, model_rows, tmp_path):
    model.evaluate(trained, model_rows, "target")
    path = trained.save(str(tmp_path / "m"))
    again = model.load_model(spark, path)
    assert (again.params, again.columns, again.classes, again.metrics) == (trained.params, trained.columns, trained.classes, trained.metrics)
    a, b = (t.score(model_rows).orderBy("row_id").collect() for t in (trained, again))
    assert a == b
    with pytest.raises(Exception):
        model.load_model(spark, str(tmp_path / "absent"))


@pytest.mark.parametrize("n", [1, 2, 50])
def test_batches(trained, model_rows, n):
    rows = model.batch_score(model_rows.where(F.col("row_id") < n).drop("target"), trained, key="row_id").collect()
    assert sorted(r["row_id"] for r in rows) == list(range(n))
    assert all(len(r["probability"]) == 2 and r["scored_at"] is not None for r in rows)


def test_empty_batch(trained, model_rows):
    with pytest.raises(ValueError, match="no records"):
        model.batch_score(model_rows.where("row_id < 0"), trained)


def test_gate(trained, model_rows):
    share = model.validation_gate(trained, model_rows, 0.85)
    assert model.validation_gate(trained, model_rows, share) == share  # equal passes
    with pytest.raises(ValueError, match="not accepted"):
        model.validation_gate(trained, model_rows, share + 1e-6)
    with pytest.raises(ValueError, match="empty"):
        model.validation_gate(trained, model_rows.where("row_id < 0"), 0.5)


def test_gate_of_a_stored_run(spark, transactions, tmp_path):
    params = FeatureParams(key_columns=("transaction_id", "customer_id"))
    fitted, prepared = plan.fit_features(transactions, params)
    forest = model.train(prepared, fitted.feature_columns(), "target", FOREST)
    forest.save(f"{tmp_path}/classifier")
    fitted.save(f"{tmp_path}/features")
    transactions.write.parquet(f"{tmp_path}/rows.parquet")
    share = model.validation_gate(forest, transactions, 0.0, features=fitted)
    assert retraining.validate_stored(spark, str(tmp_path), f"{tmp_path}/rows.parquet", share) == share
    with pytest.raises(ValueError, match="not accepted"):
        retraining.validate_stored(spark, str(tmp_path), f"{tmp_path}/rows.parquet", share + 1e-6)


def test_any_python_model(model_rows):
    def loader():
        def score(batch):
            return batch[["row_id"]].assign(prediction=(batch["feature_1"] > 0.5).astype("int64"))
        return score

    rows = model.score_with_callable(model_rows, loader, "row_id long, prediction long").collect()
    expected = {r["row_id"]: int(r["feature_1"] > 0.5) for r in model_rows.collect()}
    assert {r["row_id"]: r["prediction"] for r in rows} == expected


def test_single_record_with_features(spark, transactions):
    params = FeatureParams(key_columns=("transaction_id", "customer_id"))
    fitted, prepared = plan.fit_features(transactions, params)
    train_rows, test_rows = plan.split_data(prepared, "transaction_id", params)
    assert (train_rows.count(), test_rows.count()) == (prepared.count() - -(-prepared.count() // 5), -(-prepared.count() // 5))
    forest = model.train(train_rows, fitted.feature_columns(), "target", FOREST)
    one = transactions.drop("target").where("transaction_id = 5")
    row, = model.batch_score(one, forest, fitted, "transaction_id").collect()
    assert row["transaction_id"] == 5 and sum(row["probability"]) == pytest.approx(1)


def test_daily_run(spark, sf, tmp_path):
    root = str(tmp_path / "run")
    labels = m.table(spark, sf, "customer").select(F.col("c_custkey").alias("customer_id"), (F.col("c_acctbal") > 4500).cast("int").alias("target"))
    params = FeatureParams(key_columns=("customer_id",))

    def run(accept):
        return retraining.run_retraining(
            spark, m.t1_sources(spark, sf), labels, root, m.T1, params,
            ModelParams(n_estimators=5, max_depth=3, min_accuracy=accept),
        )

    first = run(0.0)
    assert first.training.count() == 146 and first.report.count() == 2
    assert 0 <= first.accuracy <= 1 and first.accuracy == pytest.approx(first.metrics["accuracy"])
    names = {(r["kind"], r["name"]) for r in first.log.collect()}
    assert {("param", "n_estimators"), ("metric", "training_time_seconds"), ("metric", "auc"), ("artifact", "model")} <= names
    saved = retraining.run_model_path(spark, root, date(2001, 8, 1))
    stored = spark.read.json(f"{saved}/metrics")
    assert {r["metric"] for r in stored.collect()} == set(first.metrics)

    with pytest.raises(ValueError, match="not accepted"):
        run(1.01)
    # The second run of the day replaced its tables and logged itself as a new run.
    assert tables.read_run_table(spark, f"{root}/clean_training_data").count() == 146
    assert tables.read_run_log(spark, f"{root}/runs").select("run_id").distinct().count() == 2
    again = model.load_model(spark, f"{saved}/classifier")
    fitted = plan.load_feature_model(spark, f"{saved}/features")
    training = tables.read_run_table(spark, f"{root}/clean_training_data", date(2001, 8, 1))
    assert model.batch_score(training, again, fitted, "customer_id").count() == 146
