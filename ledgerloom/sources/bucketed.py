"""Customer tables kept bucketed and sorted by their key, so that a daily join shuffles the transactions only.

A table is a folder with a log, as in ``versions``: a write fills a fresh folder and becomes visible at once. Appends
add files to the current folder; a bucket with several files is still joined without a shuffle but has to be sorted
again, until ``compact`` writes one sorted file a bucket. One writer at a time. An empty table keeps its columns.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerloom.operators.skew import HOT_ROWS, key_counts, left_join, small_side, total_bytes
from ledgerloom.session import checkpoint
from ledgerloom.sources import versions

BUCKETS = 64


def write_bucketed(df: DataFrame, path: str, key: str, buckets: int = BUCKETS) -> None:
    """Make ``df`` the whole table."""
    spark = df.sparkSession

    def write(folder: str) -> None:
        name = f"bucketed_{uuid.uuid4().hex}"
        spread = df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key)
        spread.option("path", folder).saveAsTable(name)
        spark.sql(f"DROP TABLE {name}")  # an external table: its files stay

    versions.put_folder(spark, path, {"buckets": buckets}, write, df.schema)


def _current(spark: SparkSession, path: str) -> tuple[str, int, StructType]:
    """Folder, number of buckets and columns of the table."""
    if not versions.numbers(spark, path):
        raise ValueError(f"{path} holds no bucketed table")
    entries = versions.snapshot(spark, path).keys
    if len(entries) != 1:
        raise ValueError(f"{path} was written with different numbers of buckets")
    ((part, entry),) = entries.items()
    folder = f"{path.rstrip('/')}/{entry['folder']}"
    return folder, int(part.removeprefix("buckets=")), StructType.fromJson(entry["schema"])


def read_bucketed(spark: SparkSession, path: str, key: str) -> DataFrame:
    """The table, through a catalog entry that is made again by a session that lacks it."""
    folder, buckets, schema = _current(spark, path)
    name = f"bucketed_{hashlib.md5(folder.encode()).hexdigest()}"
    if spark.catalog.tableExists(name):
        spark.catalog.refreshTable(name)  # another session may have added files
        return spark.table(name)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    spark.sql(
        f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (`{key}`) SORTED BY (`{key}`) "
        f"INTO {buckets} BUCKETS LOCATION '{folder}'"
    )
    return spark.table(name)


def add_bucketed(df: DataFrame, path: str, key: str) -> None:
    """Append rows: one more file for each bucket that they fall into."""
    spark = df.sparkSession
    folder, buckets, schema = _current(spark, path)
    read_bucketed(spark, path, key)  # makes the catalog entry
    rows = df.select(*schema.names).repartition(buckets, key)
    rows.write.insertInto(f"bucketed_{hashlib.md5(folder.encode()).hexdigest()}")


def compact(spark: SparkSession, path: str, key: str) -> None:
    """One sorted file a bucket again, in a fresh folder; readers of the old one are not disturbed."""
    folder, buckets, schema = _current(spark, path)
    # Read as plain files: the planner drops the shuffle of a bucketed scan and then reads it without its buckets.
    write_bucketed(spark.read.schema(schema).parquet(folder), path, key, buckets)


def join_bucketed(left: DataFrame, path: str, key: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """``left`` joined with the table at ``path``, all its rows kept. The table is not shuffled.

    Rows of hot keys go apart through ``left_join``, which cuts them into parts; of the table only their rows are
    shuffled then. Rows without a key match nothing, and many of them do not pass the join at all. Other columns of
    the same name on both sides raise.
    """
    side = read_bucketed(left.sparkSession, path, key)
    both = sorted((set(left.columns) & set(side.columns)) - {key})
    if both:
        raise ValueError(f"columns on both sides: {', '.join(both)}")
    hot = checkpoint(key_counts(left, key).where(F.col("_n") > hot_rows))
    if hot.isEmpty():
        return left.join(side.hint("merge"), key, "left")
    named = hot.where(F.col(key).isNotNull())
    listed = small_side(named.select(key), total_bytes(named.select(key)))
    cold = left.where(F.col(key).isNotNull()).join(listed, key, "left_anti").join(side.hint("merge"), key, "left")
    warm = left_join(
        left.join(listed, key, "left_semi"), side.join(listed, key, "left_semi"), key, hot_rows, left_counts=named
    )
    keyless = left.where(F.col(key).isNull())
    return cold.unionByName(warm).unionByName(keyless, allowMissingColumns=True)
