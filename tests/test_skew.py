import random

import pytest

from ledgerloom.operators import skew
from ledgerloom.operators.skew import left_join


@pytest.mark.parametrize("broadcast_bytes", [0, 1 << 20])
@pytest.mark.parametrize("hot_rows", [1, 20, 1_000_000])
def test_same_rows_as_a_plain_left_join(spark, hot_rows, broadcast_bytes, monkeypatch):
    monkeypatch.setattr(skew, "BROADCAST_BYTES", broadcast_bytes)
    rng = random.Random(9)
    # 1 is hot on the left, 2 on both sides, 6 on the right, 4 and 99 have no partner.
    left_rows = [(i, rng.choice([1, 1, 1, 2, 2, 3, 4, None, None, 99])) for i in range(300)] + [(900, 6), (901, 6)]
    left = spark.createDataFrame(left_rows, "id int, k long")
    right_keys = [1, 1, 3, 5, None, None] + [2] * 30 + [6] * 40
    right = spark.createDataFrame([(k, f"n{i}") for i, k in enumerate(right_keys)], "k long, name string")
    found = sorted(map(str, left_join(left, right, "k", hot_rows).select("id", "k", "name").collect()))
    plain = sorted(map(str, left.join(right, "k", "left").select("id", "k", "name").collect()))
    assert found == plain


def test_hot_by_product_only_and_equal_rows(spark):
    left = spark.range(0, 400, 1, 4).selectExpr("1L AS k", "'same' AS a")
    right = spark.range(0, 400, 1, 4).selectExpr("1L AS k", "'also' AS b")
    parts = skew._parts(left, right, "k", 500, None, False).first()
    assert parts["_l"] * parts["_r"] >= 32
    assert left_join(left, right, "k", 500).count() == 160_000


def test_one_scan_per_side_and_salted_join_keys(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(skew, "BROADCAST_BYTES", 0)
    spark.range(100).selectExpr("id % 2 AS k", "id").write.parquet(f"{tmp_path}/l")
    spark.range(100).selectExpr("id % 2 AS k", "map('x', id) AS m").write.parquet(f"{tmp_path}/r")
    joined = left_join(spark.read.parquet(f"{tmp_path}/l"), spark.read.parquet(f"{tmp_path}/r"), "k", 10)
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parquet") == 2
    assert "_row" in plan and "Union" not in plan
    assert joined.count() == 5000


def test_nested_columns_are_measured(spark):
    rows = spark.range(3).selectExpr("array_repeat('abcdefgh', 1000) AS a")
    assert skew.total_bytes(rows) > 3 * 8000
