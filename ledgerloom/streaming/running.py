"""Customer aggregates of a stream, kept as state per customer."""

from __future__ import annotations

import math
import sys

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import DecimalType, IntegralType, StructField, StructType

from ledgerloom.operators.features import CUSTOMER_FEATURES
from ledgerloom.operators.moments import MOMENTS

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers need no copy of this package

# What a query with this state needs of its session when it starts. Empty batches would go on for ever under a
# trigger that ends, as state with a time-to-live asks for them.
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
}
DAY_MS = 86_400_000


def _missing(x) -> bool:
    return x is None or x != x


class RunningMoments(StatefulProcessor):
    """(n, total, m2) of each customer, moved on by every arriving row; dropped after ``ttl_ms`` without one."""

    def __init__(self, order: list[str], ttl_ms: int | None):
        self.order, self.ttl_ms = order, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("moments", "n long, total double, m2 double", self.ttl_ms)

    def handleInitialState(self, key, initialState, timerValues) -> None:
        if not self.state.exists():  # of several rows the first counts
            self.state.update(tuple(initialState[c] for c in MOMENTS))

    def handleInputRows(self, key, rows, timerValues):
        """The customer's rows of one micro-batch, in order; their number is bounded by the files of a batch."""
        n, total, m2 = self.state.get() if self.state.exists() else (0, 0.0, 0.0)
        found = sorted(rows, key=self._place)
        moved = Row(*found[0].__fields__, *CUSTOMER_FEATURES)
        for row in found:
            x = row["amount"]
            if not _missing(x):
                if n:
                    m2 += (x - total / n) ** 2 * n / (n + 1)
                n, total = n + 1, total + x
            yield moved(*row, total / n if n else None, math.sqrt(m2 / (n - 1)) if n > 1 else None, n, total)
        self.state.update((n, total, m2))

    def _place(self, row) -> tuple:
        """By the order's columns, missing values last."""
        values = [row[c] for c in self.order]
        return tuple((True, 0) if _missing(x) else (False, x) for x in values)

    def close(self) -> None:
        pass


def running_stream_features(
    source: DataFrame, order: list[str], seeds: DataFrame | None = None, ttl_ms: int | None = 90 * DAY_MS
) -> DataFrame:
    """Each arriving row with its customer's aggregates up to and with it, starting from the moments of ``seeds``.

    Rows of one customer in one micro-batch go in the given order, micro-batches as they arrive. A customer unheard of
    for ``ttl_ms`` starts again from nothing; None keeps all. Rows without customer form no state and have NULL aggregates.
    The query must start under ``STATE_CONF``; ``write_stream`` sees to that. A restart from the checkpoint repeats no row.
    """
    names = source.columns
    # Whole numbers that may be missing would pass through floating point on the way: they travel as text.
    textual = [f.name for f in source.schema if isinstance(f.dataType, (IntegralType, DecimalType)) and f.name not in ("customer_id", "amount", *order)]
    carried = source.withColumns({c: F.col(c).cast("string") for c in textual}).withColumn("amount", F.col("amount").cast("double"))
    schema = StructType([StructField(f.name, f.dataType, True) for f in carried.schema])
    for name, kind in zip(CUSTOMER_FEATURES, ("double", "double", "long", "double")):
        schema = schema.add(name, kind)
    known = carried.where(F.col("customer_id").isNotNull())
    initial = None if seeds is None else seeds.select("customer_id", *MOMENTS).groupBy("customer_id")
    running = known.groupBy("customer_id").transformWithState(
        RunningMoments(order, ttl_ms), schema, outputMode="append",
        timeMode="none" if ttl_ms is None else "processingTime", initialState=initial,
    )
    lone = carried.where(F.col("customer_id").isNull()).withColumns({c: F.lit(None).cast(schema[c].dataType) for c in CUSTOMER_FEATURES})
    both = running.select(*schema.fieldNames()).unionByName(lone)
    return both.select(*[F.col(c).cast(source.schema[c].dataType).alias(c) for c in names], *CUSTOMER_FEATURES)
