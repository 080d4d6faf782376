"""Training, prediction, evaluation and acceptance of classifiers."""

from __future__ import annotations

import json
import time
from dataclasses import dataclass, field

from typing import TYPE_CHECKING

from pyspark.ml import Model
from pyspark.ml.classification import (
    LogisticRegression, LogisticRegressionModel, RandomForestClassificationModel, RandomForestClassifier,
)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.schema import numeric_columns
from ledgerloom.operators.evaluate import (
    accuracy, auc_binary, auc_ovr_weighted, class_count, confusion_counts, weighted_scores,
)
from ledgerloom.params import ModelParams
from ledgerloom.session import checkpoint

if TYPE_CHECKING:
    from ledgerloom.plans.features import FeatureModel

FEATURES = "features"
DEEPEST_TREE = 30  # fixed limit of the tree learner; "no limit" is asked for as this


def assemble(df: DataFrame, columns: list[str]) -> DataFrame:
    """Adds the ``features`` vector. A gap (say the deviation of a single transaction) counts as 0."""
    strange = [c for c in columns if c not in numeric_columns(df)]
    if strange:
        raise ValueError(f"feature column(s) missing or not numeric: {', '.join(strange)}")
    numbers = F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in columns])
    return df.withColumn(FEATURES, array_to_vector(numbers))


def create_model(params: ModelParams, n_rows: int):
    """The estimator of the configured type."""
    if params.model_type == "random_forest":
        return RandomForestClassifier(
            labelCol="_label", featuresCol=FEATURES, numTrees=params.n_estimators,
            maxDepth=DEEPEST_TREE if params.max_depth is None else params.max_depth,
            maxBins=params.max_bins, seed=params.random_state, cacheNodeIds=False, **params.extra,
        )
    if params.model_type == "logistic_regression":
        # Unit inverse penalty over the summed loss equals 1/n over the mean loss.
        return LogisticRegression(
            labelCol="_label", featuresCol=FEATURES, maxIter=params.max_iter, regParam=1.0 / max(n_rows, 1),
            elasticNetParam=0.0, standardization=False, **params.extra,
        )
    raise ValueError(f"unsupported model type: {params.model_type}")


@dataclass
class Classifier:
    """A trained model with the columns and class values it was trained on."""

    params: ModelParams
    columns: list[str]
    classes: list
    model: Model | None = None
    seconds: float = 0.0
    metrics: dict = field(default_factory=dict)

    def score(self, df: DataFrame) -> DataFrame:
        """Adds ``prediction`` (a class value) and ``probability`` (one number per class, sum 1)."""
        if self.model is None:
            raise ValueError("the model must be trained before it predicts")
        values = F.array(*[F.lit(v) for v in self.classes])
        scored = self.model.transform(assemble(df, self.columns))
        return scored.select(
            *df.columns,
            F.get(values, F.col("prediction").cast("int")).alias("prediction"),
            vector_to_array("probability").alias("probability"),
        )

    def predict(self, df: DataFrame) -> DataFrame:
        return self.score(df).drop("probability")

    def predict_proba(self, df: DataFrame) -> DataFrame:
        return self.score(df).drop("prediction")

    def save(self, path: str) -> str:
        """Model, class values and metrics below ``path``; an earlier model there is replaced."""
        if self.model is None:
            raise ValueError("the model must be trained before it is saved")
        spark = SparkSession.getActiveSession()
        self.model.write().overwrite().save(f"{path}/model")
        state = {
            "params": self.params.as_dict(), "columns": self.columns, "classes": self.classes,
            "seconds": self.seconds, "metrics": self.metrics,
        }
        spark.createDataFrame([(json.dumps(state),)], "value string").coalesce(1).write.mode("overwrite").text(
            f"{path}/state"
        )
        return path


def load_model(spark: SparkSession, path: str) -> Classifier:
    """Reload a saved classifier; a missing path raises."""
    state = json.loads(spark.read.text(f"{path}/state").first()["value"])
    known = {k: v for k, v in state["params"].items() if k in ModelParams.__dataclass_fields__}
    extra = {k: v for k, v in state["params"].items() if k not in known}
    params = ModelParams(**known, extra=extra)
    kind = RandomForestClassificationModel if params.model_type == "random_forest" else LogisticRegressionModel
    return Classifier(
        params, state["columns"], state["classes"], kind.load(f"{path}/model"), state["seconds"], state["metrics"]
    )


def train(df: DataFrame, columns: list[str], label: str, params: ModelParams) -> Classifier:
    """Fit the configured classifier. Classes are the sorted distinct labels."""
    labels = df.groupBy(label).agg(F.count("*").alias("n"))
    n_rows, n_classes, n_null = labels.agg(F.sum("n"), F.count("*"), F.count_if(F.col(label).isNull())).first()
    if not n_rows:
        raise ValueError("cannot train on an empty table")
    if n_null:
        raise ValueError(f"{label} has missing values")
    estimator = create_model(params, n_rows)
    classes = [row[0] for row in labels.select(label).orderBy(label).collect()]
    index = F.create_map(*[part for i, v in enumerate(classes) for part in (F.lit(v), F.lit(float(i)))])
    # Plain columns out of storage: every iteration of the learner reads them, so they are kept.
    rows = assemble(df, columns).select(FEATURES, index[F.col(label)].alias("_label")).persist()
    started = time.time()
    try:
        model = estimator.fit(rows)
    finally:
        rows.unpersist()
    return Classifier(params, list(columns), classes, model, time.time() - started)


def evaluate(classifier: Classifier, df: DataFrame, label: str) -> dict[str, float]:
    """Accuracy, weighted precision, recall and F1, and AUC (one against the rest beyond two classes)."""
    scored = classifier.score(df).select(label, "prediction", "probability").persist()
    try:
        counts = checkpoint(confusion_counts(scored, label, "prediction"))
        n_classes = class_count(counts, "label").first()[0]
        if n_classes == 2:
            if len(classifier.classes) < 2:
                raise ValueError("the model knows one class only")
            area = auc_binary(scored.withColumn("_p", F.get("probability", F.lit(1))), label, "_p",
                              classifier.classes[1])
        elif n_classes != len(classifier.classes):
            raise ValueError(f"{n_classes} classes in the labels, {len(classifier.classes)} in the model")
        else:
            spread = scored.select(
                label, *[F.get("probability", F.lit(i)).alias(f"_p{i}") for i in range(n_classes)]
            )
            area = auc_ovr_weighted(spread, label, {v: f"_p{i}" for i, v in enumerate(classifier.classes)})
        hits = F.sum(F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0))
        share = counts.agg((hits / F.sum("n")).alias("accuracy"))
        metrics = {**share.first().asDict(), **weighted_scores(counts).first().asDict(), **area.first().asDict()}
    finally:
        scored.unpersist()
    classifier.metrics = metrics
    return metrics


def batch_score(
    df: DataFrame, classifier: Classifier | None, features: FeatureModel | None = None, key: str | None = None,
    customer_stats: DataFrame | None = None,
) -> DataFrame:
    """``(key, prediction, probability, scored_at)`` for every record, prepared first when a feature
    model is given. A single record is a table of one row; an empty table is an error."""
    if classifier is None or classifier.model is None:
        raise ValueError("no model available")
    if not df.isStreaming and df.isEmpty():
        raise ValueError("no records to score")
    prepared = df if features is None else features.transform(df, customer_stats)
    kept = [key] if key else []
    return classifier.score(prepared).select(
        *kept, F.col("prediction"), "probability", F.current_timestamp().alias("scored_at")
    )


def validation_gate(
    classifier: Classifier, validation: DataFrame, threshold: float, target: str = "target",
    features: FeatureModel | None = None,
) -> float:
    """Accuracy on the validation table; below the threshold raises, equal passes."""
    prepared = validation if features is None else features.transform(validation)
    value = accuracy(classifier.score(prepared), target, "prediction").first()[0]
    if value is None:
        raise ValueError("the validation table is empty")
    if value < threshold:
        raise ValueError(f"model not accepted: accuracy {value} < {threshold}")
    return value


def score_with_callable(df: DataFrame, loader, schema: str) -> DataFrame:
    """Score with any Python model: ``loader()`` runs once per task and returns a function from a pandas
    frame to a pandas frame of ``schema``. For models that are not Spark ML."""

    def score_batches(batches):
        score = loader()
        for batch in batches:
            yield score(batch)

    return df.mapInPandas(score_batches, schema)
