"""Mergeable moments of a customer's amounts: learned once, moved on day by day, or row by row in arrival order.

A customer's state is (n, total, m2): the number of amounts, their sum, and the sum of squared distances from their
mean. Two states merge by the parallel variance formula without looking at the rows again.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerloom.session import checkpoint
from ledgerloom.sources import tables

MOMENTS = ["n", "total", "m2"]
STATE = "struct<n:bigint,total:double,m2:double>"


def _aggregates(amount: Column) -> list[Column]:
    return [
        F.count(amount).alias("n"),
        F.coalesce(F.sum(amount), F.lit(0.0)).alias("total"),
        F.coalesce(F.var_pop(amount) * F.count(amount), F.lit(0.0)).alias("m2"),
    ]


def customer_moments(df: DataFrame) -> DataFrame:
    """(customer_id, n, total, m2) of the amounts; missing ones do not count. One aggregation."""
    rows = df.where(F.col("customer_id").isNotNull())
    return rows.groupBy("customer_id").agg(*_aggregates(F.col("amount").cast("double")))


def _merged(a: Column, b: Column) -> Column:
    n = a["n"] + b["n"]
    apart = F.try_divide(a["total"], a["n"]) - F.try_divide(b["total"], b["n"])  # NULL if one of them is empty
    between = F.coalesce(apart * apart * a["n"] * b["n"] / F.nullif(n, F.lit(0)), F.lit(0.0))
    return F.struct(n.alias("n"), (a["total"] + b["total"]).alias("total"), (a["m2"] + b["m2"] + between).alias("m2"))


def _folded(states: Column) -> Column:
    """The states of an array of (order, state), merged in that order."""
    nothing = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0.0).alias("total"), F.lit(0.0).alias("m2"))
    return F.aggregate(F.array_sort(states), nothing, lambda whole, x: _merged(whole, x["state"]))


def merge_moments(*parts: DataFrame) -> DataFrame:
    """The moments of all parts together. Each part has one row per customer, so a group has no more rows than there are parts."""
    marked = [p.select("customer_id", F.struct(F.lit(i).alias("at"), F.struct(*MOMENTS).alias("state")).alias("s")) for i, p in enumerate(parts)]
    whole = marked[0]
    for p in marked[1:]:
        whole = whole.unionByName(p)
    merged = whole.groupBy("customer_id").agg(_folded(F.collect_list("s")).alias("m"))
    return merged.select("customer_id", *[F.col("m")[c].alias(c) for c in MOMENTS])


def _stats(n: Column, total: Column, m2: Column) -> list[Column]:
    return [
        F.try_divide(total, n).alias("customer_avg_amount"),
        F.when(n > 1, F.sqrt(m2 / (n - 1))).alias("customer_std_amount"),
        n.alias("customer_transaction_count"), total.alias("customer_total_amount"),
    ]


def stats_of_moments(moments: DataFrame) -> DataFrame:
    """Mean, sample deviation, count and sum per customer, as ``customer_stats`` gives them for the rows."""
    return moments.select("customer_id", *_stats(F.col("n"), F.col("total"), F.col("m2")))


def update_customer_moments(spark: SparkSession, path: str, day: date, rows: DataFrame) -> DataFrame:
    """The stored state of ``day``: that of the last day before it, merged with the day's rows. Only those are read.

    A rerun of a day starts from the same earlier state and gives the same rows.
    """
    before = [d for d in tables.run_days(spark, path) if d < day]
    parts = [tables.read_run_table(spark, path, before[-1])] if before else []
    return tables.write_run_table(merge_moments(*parts, customer_moments(rows)), path, day)


def running_customer_features(df: DataFrame, order: list[str], seeds: DataFrame | None = None) -> DataFrame:
    """Each row with the customer's aggregates up to and with it, in the given order, after the moments of ``seeds``.

    This is what a stream with state gives when rows arrive in this order, which must be total within a customer. Rows
    are sorted over ranges; ranges of a customer pass on merged moments, so a customer with most of the rows is worked on
    by many tasks. Rows without customer have NULL aggregates.
    """
    amount = F.col("amount").cast("double")
    known = df.where(F.col("customer_id").isNotNull())
    blocks = checkpoint(known.repartitionByRange("customer_id", *order).withColumn("_block", F.spark_partition_id()))
    of_block = blocks.groupBy("customer_id", "_block").agg(*_aggregates(amount))
    states = of_block.select("customer_id", "_block", F.struct(F.col("_block").alias("at"), F.struct(*MOMENTS).alias("state")).alias("s"))
    if seeds is not None:
        first = seeds.select("customer_id", F.lit(-1).alias("_block"), F.struct(F.lit(-1).alias("at"), F.struct(*MOMENTS).alias("state")).alias("s"))
        states = states.unionByName(first.join(of_block.select("customer_id").distinct(), "customer_id", "left_semi"))
    earlier = Window.partitionBy("customer_id").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    passed = checkpoint(states.withColumn("_before", _folded(F.collect_list("s").over(earlier))).where("_block >= 0").select("customer_id", "_block", "_before"))
    here = Window.partitionBy("customer_id", "_block").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = blocks.withColumn("_here", F.struct(*[
        (c.over(here)).alias(name) for c, name in ((F.count(amount), "n"), (F.sum(amount), "total"), (F.var_pop(amount), "v"))
    ]))
    n = F.col("_here")["n"]
    state = F.struct(n.alias("n"), F.coalesce(F.col("_here")["total"], F.lit(0.0)).alias("total"), F.coalesce(F.col("_here")["v"] * n, F.lit(0.0)).alias("m2"))
    joined = running.withColumn("_state", state).join(passed, ["customer_id", "_block"]).withColumn("_now", _merged(F.col("_before"), F.col("_state")))
    featured = joined.select(*df.columns, *_stats(*[F.col("_now")[c] for c in MOMENTS]))
    lone = df.where(F.col("customer_id").isNull())
    return featured.unionByName(lone, allowMissingColumns=True)
