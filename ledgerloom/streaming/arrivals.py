"""Files that arrive in a folder, as a stream."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ledgerloom.operators.model import Classifier, batch_score
from ledgerloom.plans.features import FeatureModel
from ledgerloom.sources.files import nan_to_null, object_store_path
from ledgerloom.streaming.running import DAY_MS, STATE_CONF, running_stream_features


def arrival_source(
    spark: SparkSession, folder: str, schema: StructType | str, pattern: str = "*.parquet",
    files_per_batch: int | None = None,
) -> DataFrame:
    """Every new Parquet file of the folder, once."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return nan_to_null(reader.parquet(object_store_path(folder)))


def write_stream(
    df: DataFrame, path: str, checkpoint_path: str, continuous: str | None = None, conf: dict[str, str] | None = None
) -> StreamingQuery:
    """Append to a Parquet folder, exactly once. Without ``continuous`` it takes what is there and ends.

    ``conf`` holds for this query only: a query keeps the settings that its session had when it started.
    """
    writer = df.writeStream.format("parquet").option("checkpointLocation", checkpoint_path).outputMode("append")
    writer = writer.trigger(processingTime=continuous) if continuous else writer.trigger(availableNow=True)
    with session_conf(df.sparkSession, conf or {}):
        return writer.start(path)


@contextmanager
def session_conf(spark: SparkSession, conf: dict[str, str]) -> Iterator[None]:
    """Settings of the session for the time of a block."""
    before = {key: spark.conf.get(key, None) for key in conf}
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def stream_score(
    source: DataFrame,
    classifier: Classifier,
    path: str,
    checkpoint_path: str,
    features: FeatureModel | None = None,
    key: str | None = None,
    customer_stats: DataFrame | None = None,
    continuous: str | None = None,
    running_order: list[str] | None = None,
    ttl_ms: int | None = 90 * DAY_MS,
) -> StreamingQuery:
    """Score each arriving file with the fitted features and the model.

    The customer aggregates are those of the fit, or of ``customer_stats``, so a record scores the same as in a batch.
    With ``running_order`` they move on with every arriving row instead, from the fitted ones on, as state of the stream.
    """
    if running_order is None:
        return write_stream(batch_score(source, classifier, features, key, customer_stats), path, checkpoint_path, continuous)
    if features is None:
        raise ValueError("running aggregates need a fitted feature model")
    running = running_stream_features(features.fill(source), running_order, features.customers, ttl_ms)
    scored = batch_score(running, classifier, features, key)
    return write_stream(scored, path, checkpoint_path, continuous, STATE_CONF)
