"""Bucketed customer tables: plans without a shuffle of the table, appends, hot and missing keys."""

import pytest
from pyspark.sql import functions as F

from ledgerloom.session import new_shared_path
from ledgerloom.sources import bucketed


@pytest.fixture
def path(spark):
    made = new_shared_path(spark, "bucketed")
    profiles = spark.range(100).select(F.col("id").alias("c"), F.concat(F.lit("s"), F.col("id") % 3).alias("segment"))
    bucketed.write_bucketed(profiles, made, "c", 16)
    return made


def shuffles(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def transactions(spark):
    return spark.range(500).select((F.col("id") % 120).alias("c"), F.col("id").alias("t"))


def plain(left, spark, path):
    copy = spark.createDataFrame(bucketed.read_bucketed(spark, path, "c").collect(), "c long, segment string")
    return left.join(copy, "c", "left")


def test_only_the_transactions_are_shuffled(spark, path):
    left = transactions(spark)
    joined = bucketed.join_bucketed(left, path, "c")
    assert shuffles(joined) == 1
    assert rows(joined) == rows(plain(left, spark, path))


def test_appends_are_read_at_once_and_compacted(spark, path):
    more = spark.createDataFrame([("late", 110), ("late", 5)], "segment string, c long")  # columns by name
    bucketed.add_bucketed(more, path, "c")
    left = transactions(spark)
    before = bucketed.join_bucketed(left, path, "c")
    assert shuffles(before) == 1 and rows(before) == rows(plain(left, spark, path))
    assert before.count() == 505  # customer 5 has two rows now
    bucketed.compact(spark, path, "c")
    after = bucketed.join_bucketed(left, path, "c")
    files = bucketed.read_bucketed(spark, path, "c").select(F.input_file_name().alias("f")).distinct().count()
    assert files <= 16 and shuffles(after) == 1
    assert rows(after) == rows(before)


def test_hot_and_missing_keys(spark, path):
    hot = spark.range(1000).select(F.lit(7).cast("long").alias("c"), F.col("id").alias("t"))
    none = spark.range(300).select(F.lit(None).cast("long").alias("c"), F.col("id").alias("t"))
    left = transactions(spark).union(hot).union(none)
    joined = bucketed.join_bucketed(left, path, "c", hot_rows=100)
    assert joined.columns == ["c", "t", "segment"]
    assert rows(joined) == rows(plain(left, spark, path))


def test_another_session_finds_the_table(spark, path):
    other = spark.newSession()
    assert bucketed.read_bucketed(other, path, "c").count() == 100


def test_empty_tables_and_clashing_columns(spark):
    path = new_shared_path(spark, "bucketed-empty")
    with pytest.raises(ValueError, match="no bucketed table"):
        bucketed.read_bucketed(spark, path, "c")
    bucketed.write_bucketed(spark.createDataFrame([], "c long, segment string"), path, "c", 4)
    joined = bucketed.join_bucketed(transactions(spark), path, "c")
    assert joined.count() == 500 and joined.where("segment is not null").isEmpty()
    with pytest.raises(ValueError, match="segment"):
        bucketed.join_bucketed(transactions(spark).withColumn("segment", F.lit("x")), path, "c")
