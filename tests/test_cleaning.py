from datetime import date

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import cleaning as c


def values(df, column):
    return [r[column] for r in df.orderBy("i").collect()]


def frame(spark, items, kind):
    return spark.createDataFrame(list(enumerate(items)), f"i int, v {kind}")


def test_amount_limits(spark):
    df = frame(spark, [None, -1.0, 0.0, 0.01, 1_000_000.0, 1_000_000.01], "double")
    assert values(df.select("i", c.amount_sanitise("v").alias("v")), "v") == [None, None, None, 0.01, 1_000_000.0, None]


def test_date_limits(spark):
    as_of = date(2024, 1, 31)
    days = [None, date(2009, 12, 31), date(2010, 1, 1), as_of, date(2024, 2, 1), date(2024, 2, 2)]
    df = frame(spark, days, "date")
    kept = values(df.select("i", c.date_sanitise("v", as_of=as_of).alias("v")), "v")
    assert kept == [None, None, date(2010, 1, 1), as_of, date(2024, 2, 1), None]


def test_date_limit_defaults_to_the_current_date(spark):
    df = spark.range(3).select(F.col("id").cast("int").alias("i"), F.date_add(F.current_date(), F.col("id").cast("int")).alias("v"))
    assert [v is None for v in values(df.select("i", c.date_sanitise("v").alias("v")), "v")] == [False, False, True]


def test_segments_and_one_hot(spark):
    df = frame(spark, [None, "", "  ", " Premium ", "Premium"], "string")
    out = df.select("i", c.segment_default("v").alias("v"), c.one_hot("v", "Premium").alias("h"))
    assert values(out, "v") == ["Unknown", "Unknown", "Unknown", " Premium ", "Premium"]
    assert values(out, "h") == [0, 0, 0, 0, 1]
    assert c.one_hot_name("Very Good") == "is_very_good"


def test_fence_is_false_when_unknown(spark):
    df = spark.createDataFrame(
        [(0, 100.9, 1.0, 1.0), (1, 1.0, 1.0, 1.0), (2, None, 1.0, 2.0), (3, -1.0, 1.0, 2.0)],
        "i int, v double, q1 double, q3 double",
    )
    assert values(df.select("i", c.outside_fence("v", "q1", "q3").alias("f")), "f") == [True, False, False, True]


@pytest.mark.parametrize("part, total, expected", [(1, 800, 0.13), (5, 800, 0.63), (1, 0, None), (0, 5, 0.0), (2, 3, 66.67)])
def test_percent(spark, part, total, expected):
    df = spark.createDataFrame([(part, total)], "p long, t long")
    assert df.select(c.percent("p", "t")).first()[0] == expected


def test_count_where_of_nothing_is_null(spark):
    df = spark.range(0).toDF("x")
    assert df.agg(c.count_where(F.col("x") > 0)).first()[0] is None


def test_days_between_counts_calendar_days(spark):
    df = spark.sql("SELECT TIMESTAMP '2024-01-01 23:00:00' a, TIMESTAMP '2024-01-02 01:00:00' b")
    assert df.select(c.days_between("a", "b")).first()[0] == 1


def test_missing_text(spark):
    df = frame(spark, [None, "a"], "string")
    assert values(df.select("i", c.text_or_none("v").alias("v")), "v") == ["None", "a"]
