"""Left join that keeps a hot key, of either side, out of any single task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, MapType, NumericType, StringType, StructType

from ledgerloom.session import BROADCAST_BYTES, TASK_ROWS, checkpoint

HOT_ROWS = 10 * TASK_ROWS


def row_bytes(df: DataFrame) -> Column:
    """About the size of a row: text by its length, nested values as JSON, 16 for a number, 32 for the row."""
    size = F.lit(32)
    for field in df.schema:
        if isinstance(field.dataType, (StringType, BinaryType)):
            size = size + F.coalesce(F.octet_length(field.name), F.lit(0))
        elif isinstance(field.dataType, (ArrayType, MapType, StructType)):
            size = size + F.coalesce(F.octet_length(F.to_json(F.struct(field.name))), F.lit(0))
        else:
            size = size + (16 if isinstance(field.dataType, NumericType) else 64)
    return size


def total_bytes(df: DataFrame) -> int:
    """Measured size of a side that may be broadcast; one aggregation."""
    return df.agg(F.sum(row_bytes(df))).first()[0] or 0


def small_side(df: DataFrame, measured: int) -> DataFrame:
    """Broadcast hint for a side that was measured and found small; no hint otherwise."""
    return F.broadcast(df) if measured <= BROADCAST_BYTES else df


def hot_keys(df: DataFrame, key: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """The keys with more than ``hot_rows`` rows, NULL included. Counts are combined before the shuffle."""
    return checkpoint(key_counts(df, key).where(F.col("_n") > hot_rows).select(key))


def key_counts(df: DataFrame, key: str) -> DataFrame:
    """Rows per key as ``_n``, NULL included."""
    return df.groupBy(key).agg(F.count("*").alias("_n"))


def _parts(
    left: DataFrame, right: DataFrame, key: str, hot_rows: int, left_counts: DataFrame | None, unique_right: bool
) -> DataFrame:
    """The hot keys with the numbers of parts that their left and right rows are cut into.

    A part holds about ``hot_rows`` rows, and a pair of parts makes about ten times as many rows. The side
    with more rows is cut first, since each side is repeated as often as the other one is cut.
    """
    counts = key_counts(left, key) if left_counts is None else left_counts
    if unique_right:
        counts = counts.withColumn("_m", F.lit(1))
    else:
        of_right = key_counts(right, key).withColumnRenamed("_n", "_m")
        counts = counts.join(of_right, key, "full_outer")
    n = F.coalesce("_n", F.lit(0)).cast("double")
    m = F.when(F.col(key).isNull(), 0).otherwise(F.coalesce("_m", F.lit(0))).cast("double")
    pairs = F.ceil(n * m / (10 * hot_rows))
    cut = F.least(pairs, F.ceil(F.sqrt(pairs * n / F.greatest(m, F.lit(1.0)))))
    counts = counts.select(key, m.alias("_m"), pairs.alias("_pairs"), F.greatest(F.lit(1), F.ceil(n / hot_rows), cut).alias("_l"))
    counts = counts.withColumn("_r", F.greatest(F.lit(1), F.ceil(F.col("_m") / hot_rows), F.ceil(F.col("_pairs") / F.col("_l"))))
    return checkpoint(counts.where((F.col("_l") > 1) | (F.col("_r") > 1)).select(key, "_l", "_r"))


def _tagged(df: DataFrame, key: str, parts: DataFrame, slices: int) -> DataFrame:
    """Adds ``_l`` and ``_r`` of the row's key, 1 for keys that are not hot. The list comes in slices that fit a broadcast."""
    cuts = {"_l": [], "_r": []}
    for i in range(slices):
        names = {c: f"{c}{i}" for c in cuts}
        some = parts.where(F.pmod(F.xxhash64(key), F.lit(slices)) == i)
        some = some.select(F.col(key).alias("_hot"), *[F.col(c).alias(name) for c, name in names.items()])
        df = df.join(F.broadcast(some), F.col(key).eqNullSafe(F.col("_hot")), "left").drop("_hot")
        for c, name in names.items():
            cuts[c].append(name)
    for c, found in cuts.items():
        df = df.withColumn(c, F.coalesce(*found, F.lit(1))).drop(*found)
    return df


def _place(df: DataFrame, cuts: str) -> Column:
    """Part of a row: from its content and its partition, so equal rows spread and a rerun task repeats its choice."""
    plain = [f.name for f in df.schema if not any(t in f.dataType.simpleString() for t in ("map<", "variant"))]
    return F.pmod(F.xxhash64(*plain, F.spark_partition_id()), F.col(cuts))


def _every(cuts: str) -> Column:
    return F.explode(F.sequence(F.lit(0).cast("long"), F.col(cuts) - 1))


def left_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    hot_rows: int = HOT_ROWS,
    left_counts: DataFrame | None = None,
    unique_right: bool = False,
) -> DataFrame:
    """``left.join(right, key, "left")`` in one shuffle join, with the rows of hot keys spread over salts.

    A key is hot by its rows on either side or by their product. Left rows are cut into parts and right rows
    repeated for each of them, and the other way round; all other keys have one part. NULL keys match
    nothing and are only spread. Without hot keys it is the plain join. ``left_counts`` may hand in
    ``key_counts`` of the left side; ``unique_right`` says that the right side has one row per key and need
    not be counted.
    """
    if left.isStreaming:
        return left.join(right, key, "left")
    right = right.where(F.col(key).isNotNull())
    parts = _parts(left, right, key, hot_rows, left_counts, unique_right)
    listed = parts.agg(F.count("*"), F.sum(row_bytes(parts))).first()
    if listed[0] == 0:
        return left.join(right, key, "left")
    slices = min(listed[0], listed[1] // max(BROADCAST_BYTES, 1) + 1)
    rows = _tagged(left, key, parts, slices)
    rows = rows.withColumn("_row", _place(rows, "_l")).withColumn("_col", _every("_r")).drop("_l")
    cols = _tagged(right, key, parts, slices)
    cols = cols.withColumn("_col", _place(cols, "_r")).withColumn("_row", _every("_l")).drop("_l", "_r")
    joined = rows.join(cols.withColumn("_here", F.lit(True)), [key, "_row", "_col"], "left")
    # A repeated left row may meet a part without rows; its key exists on the right, so that is no gap.
    return joined.where((F.col("_r") == 1) | F.col("_here")).drop("_row", "_col", "_r", "_here")
