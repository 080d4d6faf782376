"""The daily retraining run: extract, report, clean, report, train, accept."""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.operators.customers import customer_metrics, training_table
from ledgerloom.operators.extract import extract_raw
from ledgerloom.operators.model import Classifier, evaluate, load_model, train, validation_gate
from ledgerloom.operators.quality import dq_clean, dq_raw, dq_report
from ledgerloom.params import FeatureParams, ModelParams, RunParams
from ledgerloom.plans.features import FeatureModel, fit_features, load_feature_model, split_data
from ledgerloom.sources import versions
from ledgerloom.sources.files import load_table
from ledgerloom.sources.tables import append_run_log, read_run_log, save_metrics, write_run_table


@dataclass(frozen=True)
class RunResult:
    training: DataFrame
    report: DataFrame
    features: FeatureModel
    classifier: Classifier
    metrics: dict
    accuracy: float
    log: DataFrame


def write_tables(
    transactions: DataFrame, campaigns: DataFrame, profiles: DataFrame, root: str, run: RunParams
) -> tuple[DataFrame, DataFrame]:
    """The stored tables of one day: raw rows, quality report, customer metrics and training rows.

    Each write is a restart point, and the next step reads only the columns it needs from it.
    """
    day = run.run_date
    raw = write_run_table(extract_raw(transactions, campaigns, profiles, run), f"{root}/raw_data", day)
    metrics = write_run_table(customer_metrics(raw, run), f"{root}/intermediate_data", day)
    report = write_run_table(dq_report(dq_raw(raw), dq_clean(metrics)), f"{root}/data_quality_metrics", day)
    training = write_run_table(training_table(metrics, run), f"{root}/clean_training_data", day)
    return training, report


def run_retraining(
    spark: SparkSession,
    sources: tuple[DataFrame, DataFrame, DataFrame],
    labels: DataFrame,
    root: str,
    run: RunParams,
    features: FeatureParams,
    model: ModelParams,
    validation: DataFrame | None = None,
) -> RunResult:
    """All steps of one day. ``labels`` holds ``customer_id`` and the target column. The key columns of
    ``features`` must name a training row: add the segment where a customer may have several.

    Without a validation table the held-out rows of the split serve for the acceptance test. The model,
    its metrics and the run log are written before the test, so a refused model can be inspected.
    """
    training, report = write_tables(*sources, root, run)
    labelled = training.drop("is_outlier").join(labels, "customer_id")
    fitted, prepared = fit_features(labelled, features)
    prepared = write_run_table(prepared, f"{root}/prepared_data", run.run_date)
    train_rows, test_rows = split_data(prepared, list(features.key_columns) or ["customer_id"], features)
    classifier = train(train_rows, fitted.feature_columns(), features.target_column, model)
    metrics = evaluate(classifier, test_rows, features.target_column)

    day = run.run_date
    model_path = save_run_model(spark, root, day, classifier, fitted, metrics)
    append_run_log(
        spark, f"{root}/runs", uuid.uuid4().hex, day, params=model.as_dict(),
        metrics={"training_time_seconds": classifier.seconds, **metrics}, artifacts={"model": model_path},
    )
    if validation is None:
        value = validation_gate(classifier, test_rows, model.min_accuracy, features.target_column)
    else:
        value = validation_gate(classifier, validation, model.min_accuracy, features.target_column, fitted)
    return RunResult(
        training, report, fitted, classifier, metrics, value, read_run_log(spark, f"{root}/runs")
    )


def save_run_model(
    spark: SparkSession, root: str, day: date, classifier: Classifier, fitted: FeatureModel, metrics: dict
) -> str:
    """Model, features and metrics of a day in one folder, which becomes the day's model once all three are written."""

    def write(folder: str) -> None:
        classifier.save(f"{folder}/classifier")
        fitted.save(f"{folder}/features")
        save_metrics(spark, f"{folder}/metrics", day, metrics)

    return versions.put_folder(spark, f"{root}/models", {"run_date": day.isoformat()}, write)


def run_model_path(spark: SparkSession, root: str, day: date) -> str:
    """The folder of the day's current model."""
    return versions.folder_of(spark, f"{root}/models", {"run_date": day.isoformat()})


def validate_stored(
    spark: SparkSession, model_path: str, data_path: str, threshold: float, target: str = "target", schema=None
) -> float:
    """The acceptance test of a stored run: model and features below ``model_path``, raw rows of a file."""
    classifier = load_model(spark, f"{model_path}/classifier")
    fitted = load_feature_model(spark, f"{model_path}/features")
    return validation_gate(classifier, load_table(spark, data_path, schema), threshold, target, fitted)
