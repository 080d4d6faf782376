"""Run-dated tables: one table per dataset, one partition per run day, replaced at once and safe to rerun."""

from __future__ import annotations

from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.sources import versions

RUN_LOG_SCHEMA = "run_id string, run_date date, kind string, name string, value string, logged_at timestamp"


def write_run_table(df: DataFrame, path: str, run_date: date, part: str | None = None) -> DataFrame:
    """Replace the rows of ``run_date`` and return them as read back from storage.

    The day changes at once, when its folder is complete: a write that fails leaves the earlier rows of the day, a reader
    sees one version, and a rerun gives the same rows, also by a result without rows. With ``part`` only that part of the
    day is replaced, so steps that add to a day can be rerun one by one. The write is also the restart point of the
    steps behind it.
    """
    key = {"run_date": run_date.isoformat()} | ({} if part is None else {"part": part})
    return versions.put(df, path, key)


def read_run_table(spark: SparkSession, path: str, run_date: date | None = None, version: int | None = None) -> DataFrame:
    """One run day (only its folders are opened), or the whole table with its ``run_date`` column; parts as one.

    ``version`` reads the table as it was then.
    """
    day = None if run_date is None else {"run_date": run_date.isoformat()}
    table = versions.read(spark, path, day, version)
    parted = any("/part=" in key for key in versions.snapshot(spark, path, version).keys)
    return table.drop("part") if parted else table


def run_days(spark: SparkSession, path: str) -> list[date]:
    """The days of a run table, from its log alone."""
    keys = versions.snapshot(spark, path).keys
    return sorted({date.fromisoformat(key.split("/")[0].removeprefix("run_date=")) for key in keys})


def metrics_frame(spark: SparkSession, run_date: date, metrics: dict[str, float]) -> DataFrame:
    """Metrics as rows ``(run_date, metric, value)``."""
    return spark.createDataFrame(
        [(run_date, name, float(value)) for name, value in metrics.items()],
        "run_date date, metric string, value double",
    )


def save_metrics(spark: SparkSession, path: str, run_date: date, metrics: dict[str, float]) -> None:
    """Write the metrics as JSON lines next to the model."""
    metrics_frame(spark, run_date, metrics).coalesce(1).write.mode("overwrite").json(path)


def append_run_log(
    spark: SparkSession,
    path: str,
    run_id: str,
    run_date: date,
    params: dict | None = None,
    metrics: dict | None = None,
    artifacts: dict | None = None,
) -> None:
    """Add the parameters, metrics and model reference of one training run.

    Each run owns the partition ``(run_date, run_id)``, so a retried run replaces its own rows only.
    """
    now = datetime.now(timezone.utc)
    kinds = {"param": params or {}, "metric": metrics or {}, "artifact": artifacts or {}}
    rows = [
        (run_id, run_date, kind, name, None if value is None else str(value), now)
        for kind, entries in kinds.items()
        for name, value in entries.items()
    ]
    frame = spark.createDataFrame(rows, RUN_LOG_SCHEMA).coalesce(1).drop("run_id", "run_date")
    versions.put(frame, path, {"run_date": run_date.isoformat(), "run_id": run_id})


def read_run_log(spark: SparkSession, path: str) -> DataFrame:
    columns = [f.split()[0] for f in RUN_LOG_SCHEMA.split(", ")]
    return versions.read(spark, path).select(*columns)
