"""Missing values: critical-row drop, medians and modes."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from ledgerloom.functions.schema import numeric_columns, string_columns, unpivot
from ledgerloom.operators.ranks import column_quantiles


def drop_critical_nulls(df: DataFrame, critical_columns: tuple[str, ...] | list[str]) -> DataFrame:
    """Drops rows with a NULL in any critical column; an empty list drops nothing."""
    return df.na.drop(subset=list(critical_columns)) if critical_columns else df


def column_median(df: DataFrame, columns: list[str], task_rows: int | None = None) -> dict[str, float | None]:
    """Exact median per numeric column."""
    found = column_quantiles(df, columns, [0.5], task_rows)
    return {c: None if q is None else q[0] for c, q in found.items()}


def column_mode(df: DataFrame, columns: list[str]) -> dict[str, str | None]:
    """Most frequent value per string column, the smallest on ties; NULL does not count.

    Values are counted in their own shuffle first, so a column of many distinct values spreads out and
    only one row per column comes back.
    """
    if not columns:
        return {}
    counts = unpivot(df, columns, "string").groupBy("column", "value").agg(F.count("*").alias("n"))
    best = counts.groupBy("column").agg(F.min(F.struct(-F.col("n"), F.col("value"))).alias("best"))
    found = {row["column"]: row["value"] for row in best.select("column", "best.value").collect()}
    return {c: found.get(c) for c in columns}


def fit_impute(
    df: DataFrame, keep: tuple[str, ...] | list[str] = (), task_rows: int | None = None
) -> dict[str, float | int | str]:
    """Fill value per column: median of numbers, mode of strings. Columns in ``keep`` get none.

    A column that holds no value at all has neither, and raises. The fill of a whole-number column is whole,
    so that the column keeps its type, unless it has gaps and a fractional median.
    """
    numbers = numeric_columns(df, keep)
    fills = {
        **_whole_fills(df, column_median(df, numbers, task_rows)),
        **column_mode(df, string_columns(df, keep)),
    }
    empty = [c for c, value in fills.items() if value is None]
    if empty:
        raise ValueError(f"no value to learn a fill from in column(s): {', '.join(empty)}")
    return fills


def _whole_fills(df: DataFrame, medians: dict[str, float | None]) -> dict[str, float | int | None]:
    """Medians of whole-number columns as whole numbers where the type may stay."""
    kinds = {f.name: f.dataType for f in df.schema}
    whole = [c for c, m in medians.items() if m is not None and isinstance(kinds[c], IntegralType)]
    if not whole:
        return medians
    fractional = [c for c in whole if medians[c] != math.floor(medians[c])]
    gaps = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in fractional]).first() if fractional else {}
    return {
        c: math.floor(m) if c in whole and not (c in fractional and gaps[c]) else m for c, m in medians.items()
    }


def apply_impute(df: DataFrame, fills: dict[str, float | int | str]) -> DataFrame:
    """Fill missing values. A whole fill keeps the column's type; a fractional one makes it double."""
    kinds = {f.name: f.dataType for f in df.schema}

    def filled(c: str):
        if isinstance(fills[c], float):
            return F.coalesce(F.col(c).cast("double"), F.lit(fills[c])).alias(c)
        return F.coalesce(F.col(c), F.lit(fills[c]).cast(kinds[c])).alias(c)

    return df.select(*[filled(c) if c in fills else F.col(c) for c in df.columns])
