"""Exact stratified split, the same for every run with the same seed."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.operators.ranks import index_sorted, values_at_ranks
from ledgerloom.operators.skew import left_join, small_side, total_bytes
from ledgerloom.session import BROADCAST_BYTES, TASK_ROWS, checkpoint


HIGHEST = (1 << 60) - 1


def split_order(keys: list[str], seed: int) -> Column:
    """Pseudo-random position of a row: 60 bits of a digest of seed and keys, equal on every engine."""
    digest = F.md5(F.concat_ws("-", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys]))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def class_quotas(counts: DataFrame, label: str, n: int, test_size: float) -> DataFrame:
    """``(label, quota)``: proportional shares that add up to ``ceil(n * test_size)``.

    Whole parts first, then one more for the largest remainders (smaller label on ties), in whole numbers. ``counts``
    has one row per class; the remainders are numbered by a global sort, so no task holds all classes.
    """
    total = math.ceil(n * test_size)
    share = F.col("n").cast("decimal(19,0)") * F.lit(total).cast("decimal(19,0)")
    rest = share % F.lit(n).cast("decimal(19,0)")
    whole = ((share - rest) / F.lit(n).cast("decimal(19,0)")).cast("long")
    parts = checkpoint(counts.select(label, whole.alias("_whole"), rest.cast("long").alias("_rest")))
    spare = total - (parts.agg(F.sum("_whole")).first()[0] or 0)
    if spare <= 0:
        return parts.select(label, F.col("_whole").alias("quota"))
    by_rest = F.struct((-F.col("_rest")).alias("rest"), F.col(label).alias("label"))
    ranked = index_sorted(parts.select(F.lit(0).alias("_all"), by_rest.alias("_by")), "_all", "_by")
    more = ranked.where(F.col("index") < spare).select(F.col("_by")["label"].alias(label), F.lit(1).alias("_more"))
    return parts.join(more, label, "left").select(label, (F.col("_whole") + F.coalesce("_more", F.lit(0))).alias("quota"))


def stratified_split(
    df: DataFrame,
    key: str | list[str],
    label: str,
    test_size: float = 0.2,
    seed: int = 42,
    task_rows: int = TASK_ROWS,
) -> DataFrame:
    """Adds ``is_test``. Each class gives its quota of rows, the lowest in the seeded order.

    ``key`` must be unique; repeats at a border, where they would break the quota, raise. The border of each class is
    an order statistic found by counting, so a class that holds most rows is neither sorted nor gathered; only rows
    tied at the border are numbered. Lists with a row per class are broadcast when they were measured and are small.
    """
    keys = [key] if isinstance(key, str) else list(key)
    name = F.struct(*keys)
    ordered = df.withColumn("_order", split_order(keys, seed)).withColumn("_label", F.col(label))
    named, label = label, "_label"  # a label may be called like a column of the search
    counts = checkpoint(ordered.groupBy(label).agg(F.count("*").alias("n")))
    n, n_classes, smallest, n_null = counts.agg(
        F.sum("n"), F.count("*"), F.min("n"), F.count_if(F.col(label).isNull())
    ).first()
    if not n:
        raise ValueError("cannot split an empty table")
    if n_null:
        raise ValueError(f"{named} has missing values")
    if smallest < 2:
        raise ValueError("the least populated class has only 1 member, too few for a stratified split")
    n_test = math.ceil(n * test_size)
    if n_test < n_classes or n - n_test < n_classes:
        raise ValueError(f"{n_test} test and {n - n_test} train rows cannot hold all {n_classes} classes")

    quotas = checkpoint(class_quotas(counts, label, n, test_size).where("quota > 0"))
    spans = counts.join(small_side(quotas, total_bytes(quotas)), label).select(
        label, F.col("n").alias("_n"), F.lit(0).cast("long").alias("_lo"), F.lit(HIGHEST).alias("_hi"),
        F.array(F.col("quota") - 1).alias("_ranks"),
    )
    borders = values_at_ranks(ordered, [label], "_order", checkpoint(spans), task_rows)
    limits = borders.select(
        label, F.col("value").alias("_border"), (F.col("rank") + 1 - F.col("below")).alias("_seats"), "ties",
    )
    limits = checkpoint(limits.withColumn("_last_key", F.lit(None).cast(df.select(name.alias("k")).schema["k"].dataType)))
    open_limits = limits.where("ties > _seats")
    if not open_limits.isEmpty():  # rows that share the border's position: by key
        seats = Window.partitionBy(label).orderBy(name)
        tied = ordered.join(small_side(open_limits, total_bytes(open_limits)), label).where(F.col("_order") == F.col("_border"))
        if not tied.groupBy(label, name.alias("_key")).count().where("count > 1").isEmpty():
            raise ValueError(f"{', '.join(keys)} is not unique")
        last = (
            tied.withColumn("_seat", F.row_number().over(seats))
            .where(F.col("_seat") == F.col("_seats"))
            .select(label, name.alias("_key"))
        )
        limits = checkpoint(limits.drop("_last_key").join(last.withColumnRenamed("_key", "_last_key"), label, "left"))
    limits = limits.select(label, "_border", "_last_key")  # one row per class
    size = total_bytes(limits)
    order, border = F.col("_order"), F.col("_border")
    seated = F.col("_last_key").isNull() | (name <= F.col("_last_key"))
    is_test = (order < border) | ((order == border) & seated)
    if size <= BROADCAST_BYTES:
        placed = ordered.join(F.broadcast(limits), label, "left")
    else:  # by shuffle, hot classes in parts
        placed = left_join(ordered, limits, label, left_counts=counts.withColumnRenamed("n", "_n"), unique_right=True)
    placed = placed.withColumn("is_test", F.coalesce(is_test, F.lit(False)))
    return placed.select(*df.columns, "is_test")
