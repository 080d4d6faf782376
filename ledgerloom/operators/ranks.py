"""Exact order statistics that never sort or collect a large group in one task.

``percentile`` keeps every distinct value of a group in one buffer, which is right for the many small
groups and wrong for a hot customer or a whole column. Groups above ``task_rows`` are therefore narrowed
by counting: each pass splits the open value range of a group into cells, counts them (combined before
the shuffle, at most ``CELLS`` rows per group and task) and keeps only the cells that hold a wanted rank.
The passes end when a cell is small or holds one value. Rows are never shuffled, only counts are.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from ledgerloom.functions.schema import unpivot
from ledgerloom.operators.skew import row_bytes, small_side, total_bytes
from ledgerloom.session import TASK_ROWS, checkpoint

CELLS = 1024
_LARGEST = 1.7976931348623157e308


def _same_keys(keys: list[str], prefix: str) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(prefix + k)) for k in keys])


def _renamed(df: DataFrame, keys: list[str], prefix: str, others: list[str]) -> DataFrame:
    return df.select(*[F.col(k).alias(prefix + k) for k in keys], *others)


def _scale(value: Column, logarithmic: bool) -> Column:
    """A number that never falls while ``value`` rises, halved so that differences cannot overflow."""
    number = F.least(F.greatest(value.cast("double"), F.lit(-_LARGEST)), F.lit(_LARGEST))
    if not logarithmic:
        return number / 2
    # The logarithm of the smallest double is above -745, so positive numbers stay above 0.
    return F.when(number == 0, 0.0).otherwise(F.signum(number) * (F.ln(F.abs(number)) + 746))


def _cell(value: Column, low: Column, high: Column, logarithmic: bool) -> Column:
    """Position of ``value`` among ``CELLS`` cells of ``[low, high]``."""
    start = _scale(low, logarithmic)
    width = _scale(high, logarithmic) - start
    share = (_scale(value, logarithmic) - start) / F.nullif(width, F.lit(0.0))
    # Neighbours that look equal as doubles still part: the lowest value keeps a cell of its own.
    return F.when(value == low, 0).otherwise(
        F.least(F.lit(CELLS), F.coalesce(F.floor(share * (CELLS - 1)), F.lit(0)) + 1)
    )


def _inside(rows: DataFrame, keys: list[str], value: str, ranges: DataFrame, measured: int) -> DataFrame:
    """Rows that fall into an open range of their group. Ranges are disjoint: a row matches one at most."""
    side = small_side(_renamed(ranges, keys, "_r_", ["_lo", "_hi"]), measured)
    hit = _same_keys(keys, "_r_") & F.col(value).between(F.col("_lo"), F.col("_hi"))
    return rows.join(side, hit).drop(*["_r_" + k for k in keys])


def group_spans(rows: DataFrame, keys: list[str], value: str, copies: Column | None = None) -> DataFrame:
    """Number of rows with a value, lowest and highest value per group; ``_copies`` as often a row counts."""
    present = F.col(value).isNotNull()
    return rows.groupBy(*keys).agg(
        F.count(value).alias("_n"), F.min(value).alias("_lo"), F.max(value).alias("_hi"),
        (F.lit(1) if copies is None else F.max(F.when(present, copies))).cast("long").alias("_copies"),
    )


def values_at_ranks(
    rows: DataFrame, keys: list[str], value: str, spans: DataFrame, task_rows: int = TASK_ROWS
) -> DataFrame:
    """The value at each wanted 0-based rank of each group.

    ``rows`` holds the keys and a number. ``spans`` holds the :func:`group_spans` of the wanted groups
    and the few wanted ``_ranks`` of each as an array; it must be stored or cheap. The result has the
    columns of ``spans``, ``rank``, ``value``, ``ties``, the number of rows with that value, and
    ``below``, the number of smaller ones. ``rows`` is read once per pass, so it should come from storage.
    """
    rows = rows.select(*keys, value)
    carried = [c for c in spans.columns if c not in (*keys, "_lo", "_hi", "_n")]

    def holding(parts: DataFrame, ranges: DataFrame, measured: int) -> DataFrame:
        """Parts of ranges, in order of ``_at``, with the wanted ranks that they hold; others go."""
        side = small_side(
            _renamed(ranges, keys, "_r_", [F.col("_lo").alias("_r_lo"), F.col("_below").alias("_start"), *carried]),
            measured,
        )
        order = Window.partitionBy(*keys, "_lo").orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
        ended = parts.withColumn("_end", F.sum("_n").over(order))
        placed = ended.join(side, _same_keys(keys, "_r_") & (F.col("_lo") == F.col("_r_lo")))
        below = F.col("_start") + F.col("_end") - F.col("_n")
        return (
            placed.withColumn("_below", below)
            .withColumn(
                "_ranks",
                F.filter("_ranks", lambda r: (r >= F.col("_below")) & (r < F.col("_below") + F.col("_n"))),
            )
            .where(F.size("_ranks") > 0)
            .drop("_end", "_start", "_r_lo", *["_r_" + k for k in keys])
        )

    ranges = spans.withColumn("_below", F.lit(0).cast("long"))
    is_open = (F.col("_lo") < F.col("_hi")) & (F.col("_n") > task_rows)
    logarithmic = False  # by turns, so that a few extreme values cannot hold up the narrowing
    while True:
        n_open, measured = ranges.agg(F.count_if(is_open), F.sum(row_bytes(ranges))).first()
        measured = measured or 0
        if not n_open:
            break
        cells = (
            _inside(rows, keys, value, ranges.where(is_open), measured)
            .withColumn("_at", _cell(F.col(value), F.col("_lo"), F.col("_hi"), logarithmic))
            .groupBy(*keys, "_lo", "_at")
            .agg(F.min(value).alias("_min"), F.max(value).alias("_max"), F.count("*").alias("_n"))
        )
        narrowed = holding(cells, ranges.where(is_open), measured).select(
            *keys, F.col("_min").alias("_lo"), F.col("_max").alias("_hi"), "_n", "_below", *carried
        )
        ranges = checkpoint(ranges.where(~is_open).unionByName(narrowed))
        logarithmic = not logarithmic

    several = ranges.where(F.col("_lo") < F.col("_hi"))
    counted = (
        _inside(rows, keys, value, several, measured)
        .groupBy(*keys, "_lo", F.col(value).alias("_at"))
        .agg(F.count("*").alias("_n"))
    )
    result = [*keys, *carried, F.col("_below").alias("below"), F.col("_n").alias("ties")]
    solved = ranges.where(F.col("_lo") == F.col("_hi")).select(*result, F.col("_lo").alias("value"))
    sorted_out = holding(counted, several, measured).select(*result, F.col("_at").alias("value"))
    return solved.unionByName(sorted_out).withColumn("rank", F.explode("_ranks")).drop("_ranks")


def _interpolated(
    rows: DataFrame, keys: list[str], value: str, probabilities: list[float], spans: DataFrame, task_rows: int
) -> DataFrame:
    """Keys and ``quantiles`` of large groups, from the two neighbouring ranks of each probability."""
    spots = []
    for p in probabilities:
        at = F.lit(float(p)) * (F.col("_size") * F.col("_copies") - 1)
        down, up = F.floor(at), F.ceil(at)
        # `_copies` equal copies of each row sit side by side, so a rank divides by their number.
        low, high = (F.floor(r / F.col("_copies")).cast("long") for r in (down, up))
        spots.append((low, F.when(down == up, 1.0).otherwise(up - at), high, at - down))
    wanted = F.array_distinct(F.array(*[rank for spot in spots for rank in (spot[0], spot[2])]))
    sized = spans.withColumn("_size", F.col("_n")).withColumn("_ranks", wanted)
    found = values_at_ranks(rows, keys, value, sized, task_rows)
    parts = [
        F.sum(
            F.when(F.col("rank") == low, share_low * F.col("value")).otherwise(0.0)
            + F.when((F.col("rank") == high) & (share_high > 0), share_high * F.col("value")).otherwise(0.0)
        )
        for low, share_low, high, share_high in spots
    ]
    return found.groupBy(*keys).agg(F.array(*parts).alias("quantiles"))


def aggregate_with_quantiles(
    df: DataFrame,
    keys: list[str],
    value: str,
    probabilities: list[float],
    aggregates: list[Column] | None = None,
    weight: str | None = None,
    task_rows: int | None = TASK_ROWS,
) -> DataFrame:
    """Group by ``keys``: the given aggregates and ``quantiles``, exact and linearly interpolated.

    ``weight`` names an integer column, equal within a group, that says how often each row counts. Rows
    without a value do not count for the quantiles. The groups above ``task_rows`` are found by one scan
    whose counts are combined before the shuffle; without any, all is one aggregation. ``task_rows=None``
    says that no group is large.
    """
    aggregates = list(aggregates or [])
    copies = F.col(weight) if weight else None
    builtin = F.percentile(value, probabilities, F.lit(1) if copies is None else copies).alias("quantiles")
    if task_rows is None:
        return df.groupBy(*keys).agg(*aggregates, builtin)
    # The search runs under names of its own: a key may be called like one of its columns.
    inner = [f"_key{i}" for i in range(len(keys))]
    under = df.select(
        *[F.col(k).alias(i) for k, i in zip(keys, inner)], F.col(value).alias("_value"),
        (F.lit(1) if copies is None else copies).alias("_weight"),
    )
    spans = group_spans(under, inner, "_value", None if copies is None else F.col("_weight"))
    hot = checkpoint(spans.where(F.col("_n") > task_rows))
    if hot.isEmpty():
        return df.groupBy(*keys).agg(*aggregates, builtin)

    listed = small_side(hot.select(*[F.col(i).alias("_h_" + k) for k, i in zip(keys, inner)]), total_bytes(hot))
    on_hot = _same_keys(keys, "_h_")
    light = df.join(listed, on_hot, "left_anti").groupBy(*keys).agg(*aggregates, builtin)
    heavy = df.join(listed, on_hot, "left_semi")
    quantiles = _interpolated(under.drop("_weight"), inner, "_value", probabilities, hot, task_rows)
    quantiles = quantiles.select(*[F.col(i).alias(k) for k, i in zip(keys, inner)], "quantiles")
    if aggregates:
        others = _renamed(quantiles, keys, "_h_", ["quantiles"])
        quantiles = heavy.groupBy(*keys).agg(*aggregates).join(others, on_hot).drop(*["_h_" + k for k in keys])
    return light.unionByName(quantiles)


def column_values(
    df: DataFrame,
    columns: list[str],
    ranks_of: Callable[[int, int], list[int]],
    task_rows: int | None = None,
) -> dict[str, tuple[int, int, dict[int, float]]]:
    """Values at chosen ranks of whole columns: ``(filled, missing, {rank: value})`` per column.

    ``ranks_of(filled, missing)`` names the few 0-based ranks wanted among the values of a column. Columns
    of up to ``task_rows`` values are sorted by one aggregation; longer ones are narrowed together, one
    scan per pass for all columns.
    """
    if not columns:
        return {}
    if task_rows is None:  # a few columns share one task, where grouped buffers may be a hundred
        task_rows = 20 * TASK_ROWS // len(columns)
    numbers = [F.col(c).cast("double") for c in columns]
    total, *ends = df.agg(F.count("*"), *[F.struct(F.count(x), F.min(x), F.max(x)) for x in numbers]).first()
    wanted = {c: sorted(set(ranks_of(n, total - n))) if n else [] for c, (n, low, high) in zip(columns, ends)}
    if max(n for n, low, high in ends) <= task_rows:
        ordered = [F.sort_array(F.collect_list(x)) for x in numbers]
        picked = df.agg(
            *[
                F.array(*[F.get(values, F.lit(r)) for r in wanted[c]]).cast("array<double>")
                for c, values in zip(columns, ordered)
            ]
        ).first()
        found = {c: dict(zip(wanted[c], values)) for c, values in zip(columns, picked)}
    else:
        spans = df.sparkSession.createDataFrame(
            [(c, n, low, high, wanted[c]) for c, (n, low, high) in zip(columns, ends) if n],
            "column string, _n long, _lo double, _hi double, _ranks array<long>",
        )
        found = {c: {} for c in columns}
        for row in values_at_ranks(unpivot(df, columns, "double"), ["column"], "value", spans, task_rows).collect():
            found[row["column"]][row["rank"]] = row["value"]
    return {c: (n, total - n, found[c]) for c, (n, low, high) in zip(columns, ends)}


def neighbours(n: int, p: float) -> tuple[int, int, float]:
    """The two ranks around probability ``p`` of ``n`` values, and the share of the upper one."""
    at = p * (n - 1)
    return math.floor(at), math.ceil(at), at - math.floor(at)


def between(low: float, high: float, share: float) -> float:
    return low if share == 0 else (1 - share) * low + share * high


def column_quantiles(
    df: DataFrame, columns: list[str], probabilities: list[float], task_rows: int | None = None
) -> dict[str, list[float] | None]:
    """Exact, linearly interpolated quantiles of whole columns; None for a column without values."""

    def ranks_of(n: int, missing: int) -> list[int]:
        return [r for p in probabilities for r in neighbours(n, p)[:2]]

    quantiles = {}
    for c, (n, _, value) in column_values(df, columns, ranks_of, task_rows).items():
        spots = [neighbours(n, p) for p in probabilities] if n else []
        quantiles[c] = [between(value[low], value[high], share) for low, high, share in spots] or None
    return quantiles


def index_sorted(df: DataFrame, group: str, value: str) -> DataFrame:
    """0-based ``index`` of each distinct ``(group, value)`` in the sorted values of its group.

    A global sort numbers the rows block by block, so no window holds a whole group. The checkpoint fixes
    the blocks before their sizes are used. ``group`` must have few values (one per encoded column).
    """
    numbered = checkpoint(
        df.select(group, value).distinct().orderBy(group, value).withColumn("_id", F.monotonically_increasing_id())
    )
    block, place = F.shiftright("_id", 33), F.col("_id").bitwiseAND(F.lit((1 << 33) - 1).cast(LongType()))
    sizes = numbered.groupBy(block.alias("_block")).agg(F.count("*").alias("_n"))
    # One row per sorted block: a window over them is as small as the list of partitions.
    before = F.sum("_n").over(Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, 0)) - F.col("_n")
    starts = sizes.select("_block", before.alias("_start"))
    placed = numbered.withColumn("_block", block).join(F.broadcast(starts), "_block")
    placed = placed.select(group, value, (F.col("_start") + place).alias("_at"))
    first = placed.groupBy(group).agg(F.min("_at").alias("_first"))
    return placed.join(F.broadcast(first), group).select(
        group, value, (F.col("_at") - F.col("_first")).alias("index")
    )


def running_totals(df: DataFrame, group: str, order: str, amounts: list[str]) -> DataFrame:
    """Adds ``<amount>_before``: the total of each amount over the smaller ``order`` values of the group.

    ``(group, order)`` must be distinct. Works like :func:`index_sorted`: sorted blocks, their totals, and
    a running sum inside each block only.
    """
    numbered = checkpoint(
        df.orderBy(group, order).withColumn("_block", F.shiftright(F.monotonically_increasing_id(), 33))
    )
    per_block = numbered.groupBy(group, "_block").agg(*[F.sum(a).alias(f"_{a}") for a in amounts])
    blocks = Window.partitionBy(group).orderBy("_block").rowsBetween(Window.unboundedPreceding, 0)
    offsets = per_block.select(
        group, "_block", *[(F.sum(f"_{a}").over(blocks) - F.col(f"_{a}")).alias(f"_{a}_start") for a in amounts]
    )
    inside = Window.partitionBy(group, "_block").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return numbered.join(offsets, [group, "_block"]).select(
        *df.columns,
        *[(F.col(f"_{a}_start") + F.sum(a).over(inside) - F.col(a)).alias(f"{a}_before") for a in amounts],
    )
