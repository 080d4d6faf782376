"""Row filters by the interquartile fence of whole columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.schema import numeric_columns
from ledgerloom.operators.ranks import between, column_quantiles, column_values, neighbours

Fence = tuple[float, float]


def _fence(quartiles: list[float] | None, column: str) -> Fence:
    if quartiles is None or quartiles[0] is None:
        raise ValueError(f"no value to learn a fence from in column {column}")
    q1, q3 = quartiles
    reach = 1.5 * (q3 - q1)
    return q1 - reach, q3 + reach


def fit_fences(df: DataFrame, columns: list[str], task_rows: int | None = None) -> dict[str, Fence]:
    """Fences of all columns from the same rows."""
    quartiles = column_quantiles(df, columns, [0.25, 0.75], task_rows)
    return {c: _fence(quartiles[c], c) for c in columns}


def fit_filled_fences(
    df: DataFrame, columns: list[str], task_rows: int | None = None
) -> tuple[dict[str, float], dict[str, Fence]]:
    """Medians, and the fences of the columns after their gaps are filled with them, from one search.

    The filled column holds the values in order with the copies of the median in their middle, so each of
    its ranks is either such a copy or a rank among the values themselves.
    """

    def original(n: int, missing: int, rank: int) -> int | None:
        """Rank among the values; None for a copy of the median."""
        if rank < n // 2:
            return rank
        return None if rank < n // 2 + missing else rank - missing

    def ranks_of(n: int, missing: int) -> list[int]:
        quartiles = [original(n, missing, r) for p in (0.25, 0.75) for r in neighbours(n + missing, p)[:2]]
        return [*neighbours(n, 0.5)[:2], *[r for r in quartiles if r is not None]]

    medians, fences = {}, {}
    for column, (n, missing, value) in column_values(df, columns, ranks_of, task_rows).items():
        if not n:
            raise ValueError(f"no value to learn from in column {column}")
        low, high, share = neighbours(n, 0.5)
        medians[column] = between(value[low], value[high], share)
        quartiles = []
        for p in (0.25, 0.75):
            low, high, share = neighbours(n + missing, p)
            ends = [original(n, missing, r) for r in (low, high)]
            quartiles.append(between(*[medians[column] if r is None else value[r] for r in ends], share))
        fences[column] = _fence(quartiles, column)
    return medians, fences


def apply_fences(df: DataFrame, fences: dict[str, Fence]) -> DataFrame:
    """Rows within every fence, ends included; a NULL is outside. Literal bounds reach the scan."""
    for column, (low, high) in fences.items():
        df = df.where(F.col(column).between(F.lit(low), F.lit(high)))
    return df


def iqr_filter_onepass(
    df: DataFrame, exclude: tuple[str, ...] | list[str] = (), task_rows: int | None = None
) -> DataFrame:
    """All fences from the input at once, then one filter. ``exclude`` spares keys and the target."""
    return apply_fences(df, fit_fences(df, numeric_columns(df, exclude), task_rows))


def iqr_filter_sequential(
    df: DataFrame, exclude: tuple[str, ...] | list[str] = (), task_rows: int | None = None
) -> DataFrame:
    """Column by column in schema order, each fence over the rows that the earlier ones left.

    A column's fence depends on its predecessors, so this takes one pass per column; each pass reads only
    the columns up to its own, with the earlier bounds as literal filters.
    """
    for column in numeric_columns(df, exclude):
        df = apply_fences(df, fit_fences(df, [column], task_rows))
    return df
