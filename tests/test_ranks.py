import random

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerloom.operators.ranks import aggregate_with_quantiles, column_quantiles, index_sorted, running_totals

QS = [0.0, 0.25, 0.5, 0.75, 1.0]


def expected(values):
    return list(np.quantile(values, QS)) if values else None


def check(found, values):
    if not values:
        assert found is None or all(x is None for x in found)
    else:
        np.testing.assert_allclose(found, expected(values), rtol=1e-12, atol=1e-12)


DATA = {
    "uniform": lambda r: r.uniform(-5, 5),
    "long tail": lambda r: r.choice([-1, 1]) * 10.0 ** r.uniform(-200, 200),
    "few values": lambda r: float(r.randint(1, 3)),
    "one value": lambda r: 4.25,
    "huge ends": lambda r: r.choice([-1.7e308, 1.7e308, 0.0, 1e-300, 5.0]),
}


@pytest.mark.parametrize("task_rows", [1, 7, 100_000])
@pytest.mark.parametrize("kind", DATA)
def test_group_quantiles_by_brute_force(spark, kind, task_rows):
    rng = random.Random(1)
    rows = [(rng.choice("abc") if rng.random() < 0.6 else "hot", DATA[kind](rng)) for _ in range(400)]
    rows += [(None, 1.0), (None, 2.0), ("a", None), ("empty", None)]
    df = spark.createDataFrame(rows, "k string, v double").repartition(4)
    grouped = aggregate_with_quantiles(df, ["k"], "v", QS, [F.count("*").alias("n")], task_rows=task_rows)
    found = {r["k"]: r for r in grouped.collect()}
    groups = {}
    for k, v in rows:
        groups.setdefault(k, []).append(v)
    assert found.keys() == groups.keys()
    for k, values in groups.items():
        assert found[k]["n"] == len(values)
        check(found[k]["quantiles"], [v for v in values if v is not None])


@pytest.mark.parametrize("task_rows", [2, 100_000])
def test_weights_count_rows_several_times(spark, task_rows):
    rng = random.Random(2)
    copies = {"a": 1, "b": 2, "c": 5}
    rows = [(k, rng.uniform(0, 9), copies[k]) for k in "abc" for _ in range(11)]
    df = spark.createDataFrame(rows, "k string, v double, w long")
    found = aggregate_with_quantiles(df, ["k"], "v", QS, weight="w", task_rows=task_rows).collect()
    for r in found:
        check(r["quantiles"], [v for k, v, w in rows if k == r["k"] for _ in range(w)])


@pytest.mark.parametrize("task_rows", [3, 100_000])
def test_column_quantiles_skip_nulls(spark, task_rows):
    rng = random.Random(3)
    rows = [(rng.gauss(0, 1), rng.randint(0, 9) if rng.random() < 0.8 else None, None) for _ in range(200)]
    df = spark.createDataFrame(rows, "a double, b int, c double")
    found = column_quantiles(df, ["a", "b", "c"], QS, task_rows)
    for i, name in enumerate("abc"):
        check(found[name], [r[i] for r in rows if r[i] is not None])


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(allow_nan=False, allow_infinity=False, width=64), min_size=1, max_size=40))
def test_any_numbers(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    found = column_quantiles(df, ["v"], [0.0, 1.0], 1)["v"]
    assert found == [min(values), max(values)]


def test_index_sorted_numbers_each_group(spark):
    rng = random.Random(4)
    rows = [(rng.choice("xy"), f"v{rng.randint(0, 60):03d}") for _ in range(500)]
    df = spark.createDataFrame(rows, "column string, value string").repartition(6)
    found = {(r["column"], r["value"]): r["index"] for r in index_sorted(df, "column", "value").collect()}
    for group in "xy":
        values = sorted({v for k, v in rows if k == group})
        assert [found[group, v] for v in values] == list(range(len(values)))
    assert len(found) == len(set(rows))


def test_running_totals(spark):
    rng = random.Random(5)
    rows = [(g, i, rng.randint(0, 9)) for g in (0, 1, 2) for i in range(150 if g else 3)]
    df = spark.createDataFrame(rows, "g int, o int, a long").repartition(5)
    found = {(r["g"], r["o"]): r["a_before"] for r in running_totals(df, "g", "o", ["a"]).collect()}
    for g, o, _ in rows:
        assert found[g, o] == sum(a for h, p, a in rows if h == g and p < o)


@pytest.mark.parametrize("name", ["rank", "value", "ties", "below", "_lo", "_n", "quantile"])
def test_keys_may_have_any_name(spark, name):
    df = spark.createDataFrame([("k", float(i)) for i in range(20)], f"{name} string, v double")
    for task_rows in (5, 100):
        rows = aggregate_with_quantiles(df, [name], "v", [0.5], task_rows=task_rows).collect()
        assert [tuple(r) for r in rows] == [("k", [9.5])]
