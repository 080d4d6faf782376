"""Exact deduplication against a persistent index of text digests.

The index is a table bucketed and sorted by digest. A batch is reduced to one row per digest, meets the index in a
sort-merge anti-join (the index side is not shuffled) and what is left is appended. A later batch never replaces a
document that an earlier one kept.

Defined cases. NULL text counts as empty, and all empty texts are equal. Rows that repeat both id and text are one
document; ``group_size`` counts their rows. The smallest id stays, a NULL id only when the group has no other. An
empty batch leaves the index as it is. Further columns of the input are not looked at and may have any names.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerloom.llm.text import SPACE, packed, stored, text_of
from ledgerloom.operators.skew import left_join
from ledgerloom.session import shared_root
from ledgerloom.sources import versions

BUCKETS = 64
MOST_APPENDS = 8  # then an index is made compact: as many files a bucket


def digest_of(text_col: str) -> Column:
    """SHA-256 of the text with each run of white space as one space."""
    return F.unhex(F.sha2(F.regexp_replace(text_of(text_col), SPACE, " ").cast("binary"), 256))


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, digest, n): n rows repeat both."""
    rows = docs.select(F.col(id_col).alias("doc_id"), digest_of(text_col).alias("digest"))
    return rows.groupBy("doc_id", "digest").agg(F.count("*").alias("n"))


def _plain(path: str) -> str:
    """A folder's name without the scheme of local files."""
    return re.sub(r"^file:/+", "/", path).rstrip("/")


class DigestIndex:
    """A bucketed, sorted table ``(digest, keep_id)`` that outlives the job and the session.

    What holds the index is the folder: a log there names the current files, their schema and the number of buckets.
    The catalog entry ``table`` only points at them and is made again by a session that lacks it, or that finds it at
    files which were replaced by ``compact``. Without ``path`` the folder follows from the table's name. One writer
    at a time; a batch that fails half-way leaves no rows and may be added again.
    """

    def __init__(self, spark: SparkSession, table: str, path: str | None = None, buckets: int = BUCKETS):
        self.spark, self.table, self.buckets = spark, table, buckets
        self.path = path or f"{shared_root(spark).rstrip('/')}/digest-index-{table}"

    @classmethod
    def fresh(cls, spark: SparkSession, buckets: int = BUCKETS) -> DigestIndex:
        return cls(spark, f"digest_index_{uuid.uuid4().hex}", buckets=buckets)

    def exists(self) -> bool:
        return bool(versions.numbers(self.spark, self.path))

    def read(self) -> DataFrame:
        self._register()
        return self.spark.table(self.table)

    def _place(self) -> str | None:
        """The folder that the catalog entry points at, if there is an entry."""
        if not self.spark.catalog.tableExists(self.table):
            return None
        rows = self.spark.sql(f"DESCRIBE FORMATTED {self.table}").where("col_name = 'Location'")
        return _plain(rows.first()["data_type"])

    def _register(self) -> None:
        """Point the catalog at the current files; the number of buckets is the one they were made with."""
        if not self.exists():
            raise ValueError(f"{self.path} holds no digest index")
        ((key, entry),) = versions.snapshot(self.spark, self.path).keys.items()
        self.buckets, folder = int(key.removeprefix("buckets=")), f"{self.path.rstrip('/')}/{entry['folder']}"
        place = self._place()
        if place is not None and place != _plain(folder):
            if not place.startswith(_plain(self.path) + "/"):
                raise ValueError(f"the table {self.table} exists already at {place}")
            self.spark.sql(f"DROP TABLE {self.table}")  # an external table: its files stay
            place = None
        if place is not None:
            self.spark.catalog.refreshTable(self.table)  # another session may have added files
            return
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in StructType.fromJson(entry["schema"]))
        self.spark.sql(
            f"CREATE TABLE {self.table} ({columns}) USING parquet CLUSTERED BY (digest) SORTED BY (digest) "
            f"INTO {self.buckets} BUCKETS LOCATION '{folder}'"
        )

    def _put(self, rows: DataFrame) -> None:
        """Make ``rows`` the whole index: a fresh folder, seen at once when its log entry is there."""

        def write(folder: str) -> None:
            name = f"digest_index_{uuid.uuid4().hex}"
            spread = rows.repartition(self.buckets, "digest").write.bucketBy(self.buckets, "digest").sortBy("digest")
            spread.option("path", folder).saveAsTable(name)
            self.spark.sql(f"DROP TABLE {name}")

        versions.put_folder(self.spark, self.path, {"buckets": self.buckets}, write, rows.schema)

    def _appends(self) -> str:
        """A log beside the current files with one entry for each append; Spark passes over its name."""
        (entry,) = versions.snapshot(self.spark, self.path).keys.values()
        return f"{self.path.rstrip('/')}/{entry['folder']}/_appends"

    def compact(self) -> None:
        """One sorted file a bucket again."""
        self._put(self.read().groupBy("digest").agg(F.min("keep_id").alias("keep_id")))

    def add(self, batch: DataFrame) -> None:
        """Append the digests of ``batch`` (as from ``digests``) that the index lacks, each with its smallest id."""
        firsts = batch.groupBy("digest").agg(F.min("doc_id").alias("keep_id"))
        if not self.exists():
            self._put(firsts)
            return
        if len(versions.numbers(self.spark, self._appends())) >= MOST_APPENDS:
            self.compact()
        new = firsts.join(self.read().select("digest").hint("merge"), "digest", "left_anti")
        new.repartition(self.buckets, "digest").write.insertInto(self.table)
        versions.put_folder(self.spark, self._appends(), {"append": uuid.uuid4().hex}, lambda folder: None)


def exact_dedup(
    docs: DataFrame, index: DigestIndex, batches: int = 1, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, digest, times (rows that repeat both). New digests are appended to ``index``.

    ``batches`` cuts the input into ranges of ids that are added one after the other, so the smallest id of a
    group is always added first. ``group_size`` counts the rows of this input.
    """
    rows = stored(digests(docs, id_col, text_col), "digests")
    ends = rows.agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).first()
    if batches == 1 or ends["low"] is None:
        index.add(rows)
    else:
        width = (ends["high"] - ends["low"]) // batches + 1
        number = F.coalesce(F.floor((F.col("doc_id") - F.lit(ends["low"])) / width), F.lit(batches - 1))
        for i in range(batches):
            index.add(rows.where(number == i))
    groups = rows.groupBy("digest").agg(F.sum("n").alias("group_size"), F.min("doc_id").alias("first_id"), F.count("*").alias("_n"))
    known = index.read().groupBy("digest").agg(F.min("keep_id").alias("keep_id"))
    groups = stored(groups.join(known, "digest"), "digest-groups")
    counts = groups.select("digest", "_n")
    return (
        left_join(rows, groups.drop("_n"), "digest", left_counts=counts, unique_right=True)
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("keep_id")) & F.col("first_id").eqNullSafe(F.col("keep_id")))
        .select("doc_id", "keep_id", "group_size", "kept", "digest", F.col("n").alias("times"))
    )


def keep_first(docs: DataFrame, index: DigestIndex, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that stay, with all their columns; of rows that repeat id and normalised text, one."""
    kept = stored(exact_dedup(docs, index, 1, id_col, text_col).where("kept").select("doc_id", "digest", "times"), "kept")
    rows = packed(docs, row_id=F.col(id_col), row_digest=digest_of(text_col))
    same = F.col("row_id").eqNullSafe(F.col("doc_id")) & (F.col("row_digest") == F.col("digest"))
    once = rows.join(kept.where("times = 1"), same, "left_semi").select("doc.*")
    several = kept.where("times > 1")
    if several.isEmpty():
        return once
    return once.unionByName(rows.join(several, same).dropDuplicates(["doc_id", "digest"]).select("doc.*"))
