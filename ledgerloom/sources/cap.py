"""A run-time cap on the actions of a frame."""

from __future__ import annotations

import functools
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.classic.dataframe import DataFrame as ClassicDataFrame
from pyspark.sql.readwriter import DataFrameWriter, DataFrameWriterV2

ACTIONS = {
    "checkpoint", "collect", "count", "first", "foreach", "foreachPartition", "head", "isEmpty", "show", "tail", "take",
    "toArrow", "toPandas",
}


@contextmanager
def time_cap(spark: SparkSession, seconds: float) -> Iterator[None]:
    """Ends what this thread runs on Spark inside the block once ``seconds`` are over, and raises ``TimeoutError``.

    The block's jobs carry a tag of their own, so other work of the session goes on. An action may run several jobs one
    after the other: whichever runs when the time is over, or starts later, is ended.
    """
    context = spark.sparkContext
    tag, done, over = f"cap-{uuid.uuid4().hex}", threading.Event(), threading.Event()

    def watch() -> None:
        if done.wait(seconds):
            return
        over.set()
        while True:
            context.cancelJobsWithTag(tag)
            if done.wait(0.2):
                return

    watcher = threading.Thread(target=watch, daemon=True)
    context.addJobTag(tag)  # the tags of a session cannot be interrupted from another thread, those of the context can
    watcher.start()
    try:
        yield
    except Exception as error:
        if over.is_set():
            raise TimeoutError(f"ended after the run-time cap of {seconds} s") from error
        raise
    else:
        if over.is_set():
            raise TimeoutError(f"not finished within the run-time cap of {seconds} s")
    finally:
        done.set()
        context.removeJobTag(tag)
        watcher.join()


class CappedDataFrame(ClassicDataFrame):
    """A frame each of whose actions, and those of frames made from it, ends after ``seconds``.

    Building and analysing a plan is not capped, nor is ``toLocalIterator``, whose reader sets the pace. A frame made by another frame from this one (``other.join(this)``) is not.
    """

    def __init__(self, df: DataFrame, seconds: float):
        super().__init__(df._jdf, df.sparkSession)
        self._cap_seconds = seconds

    def __new__(cls, df: DataFrame, seconds: float):
        return object.__new__(cls)

    def __getattribute__(self, name: str):
        value = super().__getattribute__(name)
        if name.startswith("_"):
            return value
        if isinstance(value, (DataFrameWriter, DataFrameWriterV2)):
            return _CappedWriter(value, self.sparkSession, self._cap_seconds)
        return _capped(value, self, name) if callable(value) else value


def _capped(method, frame: CappedDataFrame, name: str):
    @functools.wraps(method)
    def run(*args, **kwargs):
        if name in ACTIONS:
            with time_cap(frame.sparkSession, frame._cap_seconds):
                found = method(*args, **kwargs)
        else:
            found = method(*args, **kwargs)
        if isinstance(found, (DataFrameWriter, DataFrameWriterV2)):
            return _CappedWriter(found, frame.sparkSession, frame._cap_seconds)
        return cap_frame(found, frame._cap_seconds) if isinstance(found, DataFrame) else found

    return run


class _CappedWriter:
    """A writer whose last call runs under the cap."""

    def __init__(self, writer, spark: SparkSession, seconds: float):
        self._writer, self._spark, self._seconds = writer, spark, seconds

    def __getattr__(self, name: str):
        method = getattr(self._writer, name)

        def run(*args, **kwargs):
            with time_cap(self._spark, self._seconds):
                found = method(*args, **kwargs)
            return self if found is self._writer else found

        return run


def cap_frame(df: DataFrame, seconds: float) -> DataFrame:
    """``df`` with the cap on its actions; a stream, whose query has no end, stays as it is."""
    if df.isStreaming:
        return df
    return CappedDataFrame(df, seconds)
