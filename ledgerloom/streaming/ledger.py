"""Arriving files with a ledger: each content is taken once, and a file of another schema is listed instead of read.

The stream carries names of files, not rows. Each micro-batch looks at the footers of its files, reads the good ones and
writes two versioned tables below one root, each in one step: ``rows``, and ``ledger`` with one row per file (file, bytes,
n_rows, status ``taken``, ``repeat`` or ``rejected``, reason, content). Both are keyed by the stream and its batch, so a
batch that is replayed after a failure replaces its own rows. A file whose rows are those of an earlier one, under any
name and in any order, is a ``repeat``. Rows are compared by their number and two sums of 64-bit hashes.

Defined cases. A file without rows is taken. Columns may come in any order; a missing, additional or otherwise typed
column, or a file that is no Parquet, makes it ``rejected``. A changed file under a name that the stream has seen is not
looked at again. One stream writes a root at a time.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ledgerloom.sources import versions
from ledgerloom.sources.files import nan_to_null, object_store_path

LEDGER = "file string, bytes long, n_rows long, status string, reason string, content string"
NOTICE = "path string, modificationTime timestamp, length long, content binary"
FOOTERS = 16  # footers that are read at the same time


def arrival_notices(spark: SparkSession, folder: str, pattern: str = "*.parquet", files_per_batch: int = 1000) -> DataFrame:
    """(path, file, length) of every new file; the files themselves are not opened."""
    reader = spark.readStream.format("binaryFile").schema(NOTICE).option("pathGlobFilter", pattern)
    reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(object_store_path(folder)).select("path", F.col("_metadata.file_path").alias("file"), "length")


def _fault(spark: SparkSession, path: str, wanted: StructType) -> str | None:
    """Why a file cannot be read under the schema; None if it can."""
    try:
        found = {f.name: f.dataType.simpleString() for f in spark.read.parquet(path).schema}
    except Exception as error:  # the stream goes on, the ledger holds the reason
        return f"not readable: {str(error).splitlines()[0]}"
    expected = {f.name: f.dataType.simpleString() for f in wanted}
    if found == expected:
        return None
    parts = [f"{c} missing" for c in expected if c not in found]
    parts += [f"{c} {found[c]} instead of {expected[c]}" for c in expected if c in found and found[c] != expected[c]]
    return "; ".join(parts + [f"{c} not expected" for c in found if c not in expected])


def _contents(spark: SparkSession, paths: list[str], schema: StructType) -> dict[str, tuple[int, str]]:
    """{file: (rows, content)} of the files that hold rows: sums of row hashes, whatever the order of the rows."""
    rows = spark.read.schema(schema).parquet(*paths)
    columns = [F.col("`" + c.replace("`", "``") + "`") for c in schema.names]
    sums = [F.sum(F.xxhash64(F.lit(seed), *columns).cast("decimal(38,0)")).cast("string") for seed in (1, 2)]
    found = rows.groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.count("*").alias("n"), F.concat_ws(":", F.count("*").cast("string"), *sums).alias("content")
    )
    return {r["file"]: (r["n"], r["content"]) for r in found.collect()}  # one row per file of the batch


def _known(spark: SparkSession, root: str, key: dict, contents: set[str]) -> set[str]:
    """Those contents that other batches have taken."""
    if not contents or not versions.numbers(spark, f"{root}/ledger"):
        return set()
    ledger = versions.read(spark, f"{root}/ledger").where("status = 'taken'")
    own = F.lit(True)
    for name, value in key.items():
        own = own & (F.col(name) == F.lit(value))
    listed = spark.createDataFrame([(c,) for c in contents], "content string")
    return {r["content"] for r in ledger.where(~own).join(F.broadcast(listed), "content", "left_semi").select("content").distinct().collect()}


def take_batch(notices: DataFrame, stream: str, batch: int, root: str, schema: StructType) -> None:
    """Take the files of one micro-batch; the same stream and batch number again replaces what they wrote."""
    spark, key = notices.sparkSession, {"stream": stream, "batch": str(batch)}
    files = sorted(notices.select("path", "file", "length").distinct().collect())  # files_per_batch rows at most
    with ThreadPoolExecutor(FOOTERS) as pool:
        faults = dict(zip((f.file for f in files), pool.map(lambda f: _fault(spark, f.path, schema), files)))
    good = [f for f in files if faults[f.file] is None]
    contents = _contents(spark, [f.path for f in good], schema) if good else {}
    seen = _known(spark, root, key, {c for _, c in contents.values()})
    entries, taken = [], []
    for f in files:
        n, content = contents.get(f.file, (0, None))
        if faults[f.file] is not None:
            entries.append((f.file, f.length, None, "rejected", faults[f.file], None))
            continue
        status = "repeat" if content in seen else "taken"
        if status == "taken":
            taken.append(f.path)
        if content is not None:
            seen.add(content)
        entries.append((f.file, f.length, n, status, None, content))
    rows = nan_to_null(spark.read.schema(schema).parquet(*taken)) if taken else spark.createDataFrame([], schema)
    versions.put(rows, f"{root}/rows", key)
    versions.put(spark.createDataFrame(entries, LEDGER).coalesce(1), f"{root}/ledger", key)


def take_arrivals(
    spark: SparkSession, folder: str, schema: StructType | str, root: str, checkpoint_path: str, pattern: str = "*.parquet",
    files_per_batch: int = 1000, continuous: str | None = None,
) -> StreamingQuery:
    """Take every new file of the folder into the tables below ``root``; without ``continuous`` what is there, then end."""
    root = root.rstrip("/")
    wanted = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)

    def take(notices: DataFrame, batch: int) -> None:
        stream = notices.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        take_batch(notices, stream, batch, root, wanted)

    writer = arrival_notices(spark, folder, pattern, files_per_batch).writeStream.foreachBatch(take)
    writer = writer.option("checkpointLocation", checkpoint_path)
    return (writer.trigger(processingTime=continuous) if continuous else writer.trigger(availableNow=True)).start()


def taken_rows(spark: SparkSession, root: str) -> DataFrame:
    """All rows that were taken, each content once."""
    return versions.read(spark, f"{root.rstrip('/')}/rows").drop("stream", "batch")


def ledger(spark: SparkSession, root: str, status: str | None = None) -> DataFrame:
    """One row per file that a stream has looked at, or those of one status."""
    table = versions.read(spark, f"{root.rstrip('/')}/ledger")
    return table if status is None else table.where(F.col("status") == status)
