"""Label encoding and scaling with fitted state kept as data."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.cleaning import text_or_none
from ledgerloom.functions.schema import unpivot
from ledgerloom.operators.ranks import index_sorted
from ledgerloom.operators.skew import left_join, row_bytes
from ledgerloom.session import BROADCAST_BYTES

UNSEEN = -1


def column_classes(df: DataFrame, columns: list[str]) -> DataFrame:
    """``(column, value, index)``: the sorted distinct texts of each column, numbered from 0."""
    texts = df.select(*[text_or_none(c).alias(c) for c in columns])
    return index_sorted(unpivot(texts, columns, "string"), "column", "value")


def class_sizes(classes: DataFrame) -> dict[str, int]:
    """Measured bytes of the class list of each encoded column."""
    sizes = classes.groupBy("column").agg(F.sum(row_bytes(classes)).alias("size"))
    return {row["column"]: row["size"] for row in sizes.collect()}


def label_encode_fit(df: DataFrame, columns: list[str]) -> DataFrame:
    return column_classes(df, columns)


def label_encode_apply(df: DataFrame, classes: DataFrame, sizes: dict[str, int] | None = None) -> DataFrame:
    """Replaces each fitted column by the index of its value, ``-1`` for a value not seen in the fit.

    A class list is broadcast while it is small; a long one is joined by shuffle with its hot values
    apart. Columns that were not fitted stay as they are.
    """
    sizes = class_sizes(classes) if sizes is None else sizes
    order = df.columns
    for column, size in sizes.items():
        if column not in order:
            continue
        known = classes.where(F.col("column") == column).select(
            F.col("value").alias("_text"), F.col("index").alias("_index")
        )
        keyed = df.withColumn("_text", text_or_none(column))
        if size <= BROADCAST_BYTES:
            joined = keyed.join(F.broadcast(known), "_text", "left")
        else:
            joined = left_join(keyed, known, "_text", unique_right=True)
        df = joined.withColumn(column, F.coalesce("_index", F.lit(UNSEEN)).cast("long")).drop("_text", "_index")
    return df.select(*order)


def isin_known(df: DataFrame, column: str, classes: DataFrame, alias: str = "is_known") -> DataFrame:
    """Adds whether the value belongs to the fitted classes of its column."""
    encoded = label_encode_apply(df.withColumn("_kept", F.col(column)), classes.where(F.col("column") == column))
    return encoded.withColumn(alias, F.col(column) != UNSEEN).withColumn(column, F.col("_kept")).drop("_kept")


def column_mean_std(df: DataFrame, columns: list[str]) -> DataFrame:
    """``(column, mean, std)`` per numeric column with the population deviation; one aggregation."""
    if not columns:
        return df.sparkSession.createDataFrame([], "column string, mean double, std double")
    moments = df.agg(
        *[
            F.struct(
                F.lit(c).alias("column"),
                F.avg(F.col(c).cast("double")).alias("mean"),
                F.stddev_pop(F.col(c).cast("double")).alias("std"),
            ).alias(f"m{i}")
            for i, c in enumerate(columns)
        ]
    )
    return moments.select(F.inline(F.array(*moments.columns)))


def standard_scale_fit(df: DataFrame, columns: list[str]) -> dict[str, tuple[float, float]]:
    """Mean and divisor per column; a constant column divides by 1, NULL is left out of the fit."""
    fitted = {row["column"]: (row["mean"], row["std"]) for row in column_mean_std(df, columns).collect()}
    return {
        c: (0.0 if mean is None else mean, std if std else 1.0) for c, (mean, std) in fitted.items()
    }


def standard_scale_apply(df: DataFrame, scales: dict[str, tuple[float, float]]) -> DataFrame:
    """``(x - mean) / std`` per fitted column; a missing column is an error."""
    missing = [c for c in scales if c not in df.columns]
    if missing:
        raise ValueError(f"column(s) to scale are missing: {', '.join(missing)}")
    return df.withColumns(
        {c: (F.col(c).cast("double") - F.lit(mean)) / F.lit(std) for c, (mean, std) in scales.items()}
    )


def join_fitted_params(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Every row next to the single row of fitted numbers. More than one row is refused."""
    if one_row.limit(2).count() != 1:
        raise ValueError("fitted parameters must be exactly one row")
    return df.crossJoin(F.broadcast(one_row))
