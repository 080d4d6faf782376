import random

import pytest

from ledgerloom.operators import evaluate


def pairs(spark, truth, guess):
    return spark.createDataFrame(list(zip(truth, guess, strict=True)), "t int, p int")


@pytest.mark.parametrize(
    "truth, guess, expected",
    [([3, 7, 7], [3, 7, 7], 1.0), ([2, 9], [9, 2], 0.0), ([5, 5, 6, 8, 8], [5, 8, 6, None, 8], 0.6)],
)
def test_accuracy(spark, truth, guess, expected):
    assert evaluate.accuracy(pairs(spark, truth, guess), "t", "p").first()[0] == expected


def test_missing_truth_raises(spark):
    with pytest.raises(Exception, match="2 row.s. without t"):
        evaluate.accuracy(pairs(spark, [4, None, None], [4, 4, 4]), "t", "p").first()


def test_unequal_lengths_raise(spark):
    truth = spark.createDataFrame([(i, i % 2) for i in range(4)], "k int, t int")
    guess = spark.createDataFrame([(i, i % 2) for i in range(2)], "k int, p int")
    with pytest.raises(ValueError, match="2 key"):
        evaluate.join_pred_truth(truth, guess, "k")
    with pytest.raises(ValueError, match="1 key"):
        evaluate.join_pred_truth(truth.where("k < 2"), guess.union(guess.where("k = 0")), "k")
    with pytest.raises(ValueError, match="1 key"):
        evaluate.join_pred_truth(truth.selectExpr("nullif(k, 0) k", "t").where("k IS NULL OR k < 2"), guess.where("k = 1"), "k")
    assert evaluate.join_pred_truth(truth.where("k < 2"), guess, "k").count() == 2


def by_hand(truth, guess):
    scores = {}
    for c in set(truth) | set(guess):
        hits = sum(t == p == c for t, p in zip(truth, guess))
        predicted, support = guess.count(c), truth.count(c)
        scores[c] = (
            hits / predicted if predicted else 0, hits / support if support else 0,
            2 * hits / (predicted + support), support,
        )
    return scores


def test_class_measures(spark):
    rng = random.Random(3)
    truth = [rng.choice([0, 0, 0, 1, 2]) for _ in range(200)]
    guess = [rng.choice([t, t, 0, 3]) for t in truth]  # class 3 is only ever guessed
    scores = by_hand(truth, guess)
    df = pairs(spark, truth, guess)
    found = {r["class"]: tuple(r)[1:] for r in evaluate.class_scores(evaluate.confusion_counts(df, "t", "p")).collect()}
    assert found == {c: pytest.approx(s) for c, s in scores.items()}
    row = evaluate.weighted_prf(df, "t", "p").first()
    weighted = [sum(s[i] * s[3] for s in scores.values()) / 200 for i in range(3)]
    assert list(row) == pytest.approx(weighted)
    report = {r["class"]: r for r in evaluate.classification_report(df, "t", "p").collect()}
    assert report["macro avg"]["f1"] == pytest.approx(sum(s[2] for s in scores.values()) / 4)
    assert list(report["weighted avg"])[1:4] == pytest.approx(weighted)
    assert report["accuracy"]["f1"] == pytest.approx(sum(t == p for t, p in zip(truth, guess)) / 200)
    assert report["accuracy"]["precision"] is None and report["3"]["support"] == 0


def area(truth, score):
    good = [s for t, s in zip(truth, score) if t]
    bad = [s for t, s in zip(truth, score) if not t]
    return sum((g > b) + (g == b) / 2 for g in good for b in bad) / (len(good) * len(bad))


def test_areas(spark):
    rng = random.Random(4)
    truth = [rng.choice("xyz") for _ in range(150)]
    p = [[round(rng.random(), 1) for _ in "xyz"] for _ in truth]
    df = spark.createDataFrame([(t, *q) for t, q in zip(truth, p)], "t string, x double, y double, z double")
    per_class = {c: area([t == c for t in truth], [q[i] for q in p]) for i, c in enumerate("xyz")}
    found = evaluate.auc_binary(df, "t", "y", "y").first()[0]
    assert found == pytest.approx(per_class["y"])
    weighted = sum(per_class[c] * truth.count(c) for c in "xyz") / 150
    assert evaluate.auc_ovr_weighted(df, "t", {c: c for c in "xyz"}).first()[0] == pytest.approx(weighted)


def test_area_needs_two_classes(spark):
    df = spark.createDataFrame([(1, 0.3), (1, 0.6)], "t int, s double")
    assert evaluate.auc_binary(df, "t", "s").first()[0] is None
    assert evaluate.class_count(df, "t").first()[0] == 1
