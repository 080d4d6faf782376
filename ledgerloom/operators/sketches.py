"""Distinct counts that merge: one sketch per group and day, united over any days without reading the rows again."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.sources.tables import read_run_table, run_days, write_run_table

PRECISION = 12  # 2^12 registers


def error_bound(precision: int = PRECISION, deviations: float = 3.0) -> float:
    """Relative error that an estimate stays below: ``deviations`` standard errors of a sketch of this size."""
    return deviations * 1.04 / 2 ** (precision / 2)


def distinct_sketches(df: DataFrame, by: list[str], columns: list[str], precision: int = PRECISION) -> DataFrame:
    """One row per group with a sketch of the distinct values of each column; NULL does not count.

    A sketch has a fixed size and is built before the shuffle, while an exact count ships every distinct value.
    """
    return df.groupBy(*by).agg(*[F.hll_sketch_agg(F.col(c).cast("string"), F.lit(precision)).alias(c) for c in columns])


def united(sketches: DataFrame, by: list[str], columns: list[str]) -> DataFrame:
    """The sketches of all rows of a group as one; equal to the sketch of all their values."""
    return sketches.groupBy(*by).agg(*[F.hll_union_agg(c).alias(c) for c in columns])


def estimates(sketches: DataFrame, columns: list[str]) -> DataFrame:
    """The sketches as numbers of distinct values."""
    return sketches.withColumns({c: F.hll_sketch_estimate(c) for c in columns})


def write_day_sketches(
    spark: SparkSession, path: str, day: date, rows: DataFrame, by: list[str], columns: list[str], precision: int = PRECISION
) -> DataFrame:
    """Store the sketches of one day's rows; a rerun replaces them."""
    return write_run_table(distinct_sketches(rows, by, columns, precision), path, day)


def distinct_over_days(spark: SparkSession, path: str, first: date, last: date, by: list[str], columns: list[str]) -> DataFrame:
    """About how many distinct values each column has over the stored days from ``first`` to ``last``, per group.

    Only the sketches of those days are read.
    """
    parts = [read_run_table(spark, path, d) for d in run_days(spark, path) if first <= d <= last]
    if not parts:
        raise ValueError(f"{path} has no day from {first} to {last}")
    whole = parts[0]
    for p in parts[1:]:
        whole = whole.unionByName(p)
    return estimates(united(whole, by, columns), columns)
