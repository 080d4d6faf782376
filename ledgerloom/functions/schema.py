"""Column choice by type, done on the schema only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.types import NumericType, StringType


def numeric_columns(df: DataFrame, exclude: tuple[str, ...] | list[str] = ()) -> list[str]:
    """Numeric columns in schema order; booleans do not count as numbers."""
    return [f.name for f in df.schema if isinstance(f.dataType, NumericType) and f.name not in exclude]


def string_columns(df: DataFrame, exclude: tuple[str, ...] | list[str] = ()) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, StringType) and f.name not in exclude]


def unpivot(df: DataFrame, columns: list[str], type_name: str) -> DataFrame:
    """``(column, value)`` rows of the given columns without the missing values; a narrow step."""
    from pyspark.sql import functions as F

    pairs = F.explode(
        F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast(type_name).alias("value")) for c in columns])
    )
    return df.select(pairs.alias("pair")).select("pair.column", "pair.value").where("value IS NOT NULL")
