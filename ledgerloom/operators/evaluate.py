"""Exact classification measures from counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.ranks import running_totals
from ledgerloom.session import checkpoint


def join_pred_truth(truth: DataFrame, predicted: DataFrame, key: str) -> DataFrame:
    """Truth and prediction of the same key. A key that misses on either side, or repeats, raises."""
    left = truth.withColumn("_in_truth", F.lit(1))
    right = predicted.withColumn("_in_prediction", F.lit(1))
    counted = (
        left.select(key, "_in_truth").unionByName(right.select(key, "_in_prediction"), allowMissingColumns=True)
        .groupBy(key).agg(F.count("_in_truth").alias("t"), F.count("_in_prediction").alias("p"))
    )
    n_wrong = counted.where((F.col("t") != 1) | (F.col("p") != 1) | F.col(key).isNull()).count()
    if n_wrong:
        raise ValueError(f"truth and prediction differ: {n_wrong} key(s) without exactly one partner")
    return truth.join(predicted, key)


def confusion_counts(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """``(label, prediction, n)``: one shuffle of counts, from which the class measures follow."""
    return df.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(
        F.count("*").alias("n")
    )


def accuracy(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """One row: the share of equal pairs. A missing prediction is wrong; a missing label raises."""
    unlabelled = F.count_if(F.col(label).isNull())
    right = F.avg(F.coalesce(F.col(label) == F.col(prediction), F.lit(False)).cast("double"))
    refused = F.raise_error(F.concat(unlabelled.cast("string"), F.lit(f" row(s) without {label}"))).cast("double")
    return df.agg(F.when(unlabelled > 0, refused).otherwise(right).alias("accuracy"))


def class_count(df: DataFrame, label: str) -> DataFrame:
    """One row: the number of distinct labels."""
    return df.agg(F.count_distinct(label).alias("class_count"))


def _ratio(part, whole):
    return F.coalesce(part / F.nullif(whole, F.lit(0)), F.lit(0.0))


def class_scores(counts: DataFrame) -> DataFrame:
    """Precision, recall, F1 and support of every class in the :func:`confusion_counts`.

    A class may occur as label or prediction only; an undefined ratio is 0.
    """
    n = F.col("n")
    sides = counts.select(
        F.explode(
            F.array(
                F.struct(
                    F.col("label").alias("class"), n.alias("support"), F.lit(0).cast("long").alias("predicted"),
                    F.when(F.col("label") == F.col("prediction"), n).otherwise(0).alias("hits"),
                ),
                F.struct(
                    F.col("prediction").alias("class"), F.lit(0).cast("long").alias("support"),
                    n.alias("predicted"), F.lit(0).cast("long").alias("hits"),
                ),
            )
        ).alias("side")
    ).select("side.*")
    sums = sides.groupBy("class").agg(
        F.sum("support").alias("support"), F.sum("predicted").alias("predicted"), F.sum("hits").alias("hits")
    )
    precision, recall = _ratio(F.col("hits"), F.col("predicted")), _ratio(F.col("hits"), F.col("support"))
    return sums.select(
        "class", precision.alias("precision"), recall.alias("recall"),
        _ratio(2 * F.col("hits"), F.col("predicted") + F.col("support")).alias("f1"), "support",
    )


def _weighted(column: str):
    return F.sum(F.col(column) * F.col("support")) / F.nullif(F.sum("support"), F.lit(0))


def weighted_prf(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """One row: precision, recall and F1, averaged over the classes by their support."""
    return weighted_scores(confusion_counts(df, label, prediction))


def weighted_scores(counts: DataFrame) -> DataFrame:
    return class_scores(counts).agg(
        _weighted("precision").alias("precision"),
        _weighted("recall").alias("recall"),
        _weighted("f1").alias("f1_score"),
    )


def classification_report(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """One row per class, then accuracy, macro and weighted means under ``class``."""
    counts = checkpoint(confusion_counts(df, label, prediction))
    scores = class_scores(counts)
    total = F.sum("support").alias("support")
    macro = scores.agg(
        F.lit("macro avg").alias("class"),
        *[F.avg(c).alias(c) for c in ("precision", "recall", "f1")], total,
    )
    weighted = scores.agg(
        F.lit("weighted avg").alias("class"),
        *[_weighted(c).alias(c) for c in ("precision", "recall", "f1")], total,
    )
    hits = F.sum(F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0))
    share = counts.agg(
        F.lit("accuracy").alias("class"), F.lit(None).cast("double").alias("precision"),
        F.lit(None).cast("double").alias("recall"), (hits / F.sum("n")).alias("f1"), F.sum("n").alias("support"),
    )
    per_class = scores.withColumn("class", F.col("class").cast("string"))
    return per_class.unionByName(share).unionByName(macro).unionByName(weighted)


def _auc(scored: DataFrame) -> DataFrame:
    """``(class, auc, support)`` from rows ``(class, score, hit)``; ties count half.

    Rows are reduced to counts per distinct score before anything is ordered.
    """
    counts = scored.groupBy("class", "score").agg(
        F.sum("hit").alias("hits"), F.sum(1 - F.col("hit")).alias("others")
    )
    ranked = running_totals(counts, "class", "score", ["others"])
    wins = F.sum(F.col("hits").cast("double") * (F.col("others_before") + F.col("others") / 2))
    sums = ranked.groupBy("class").agg(
        wins.alias("wins"), F.sum("hits").alias("support"), F.sum("others").alias("rest")
    )
    pairs = F.nullif(F.col("support").cast("double") * F.col("rest"), F.lit(0.0))
    return sums.select("class", (F.col("wins") / pairs).alias("auc"), "support")


def auc_binary(df: DataFrame, label: str, score: str, positive=1) -> DataFrame:
    """One row: ROC AUC of the score of the positive class; NULL when only one class occurs."""
    rows = df.select(
        F.lit(0).alias("class"), F.col(score).alias("score"), (F.col(label) == F.lit(positive)).cast("long").alias("hit")
    )
    return _auc(rows).select("auc")


def auc_ovr_weighted(df: DataFrame, label: str, scores: dict) -> DataFrame:
    """One row: each class against the rest, weighted by its support. ``scores`` maps class to column."""
    sides = F.array(
        *[
            F.struct(
                F.lit(i).alias("class"), F.col(column).cast("double").alias("score"),
                (F.col(label) == F.lit(value)).cast("long").alias("hit"),
            )
            for i, (value, column) in enumerate(scores.items())
        ]
    )
    per_class = _auc(df.select(F.explode(sides).alias("side")).select("side.*"))
    return per_class.agg((F.sum(F.col("auc") * F.col("support")) / F.sum("support")).alias("auc"))
