"""What the text operators share: narrow inputs under reserved names, normal forms, hashes and restart points."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.session import new_shared_path

# Fixed values of the query contracts.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
BATCH_ROWS = 1000  # whole texts that travel to Python at a time: what is held on both sides follows the batch
BATCH_CONF = "spark.sql.execution.arrow.maxRecordsPerBatch"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write to a fresh folder of the shared store and read back: a restart point that outlives executors."""
    spark = df.sparkSession
    path = new_shared_path(spark, name)
    df.write.parquet(path)
    made = spark.read.schema(df.schema).parquet(path)
    made._stored_at = path
    return made


def discard(*tables: DataFrame) -> None:
    """Deletes tables that ``stored`` has made and nothing reads any more. Spark keeps the shuffle files of finished queries
    until the driver collects its garbage, so that is done too."""
    for table in tables:
        jvm, sc = table.sparkSession._jvm, table.sparkSession.sparkContext
        path = jvm.org.apache.hadoop.fs.Path(table._stored_at)
        path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)
        jvm.System.gc()


@contextmanager
def text_batches(spark: SparkSession):
    """Whole texts travel to Python ``BATCH_ROWS`` at a time, or fewer if the session says so, in what runs inside."""
    before = spark.conf.get(BATCH_CONF)
    spark.conf.set(BATCH_CONF, str(min(BATCH_ROWS, int(before)) if int(before) > 0 else BATCH_ROWS))
    try:
        yield
    finally:
        spark.conf.set(BATCH_CONF, before)


def strings(column) -> list[str | None]:
    """The values of a pandas column of text, missing ones as None."""
    return [x if isinstance(x, str) else None for x in column]


def text_of(name: str) -> Column:
    """The text; NULL counts as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def text_digest(name: str) -> Column:
    """MD5 of the text, which tells rows with the same id, or none, apart; NULL counts as empty."""
    return F.unhex(F.md5(text_of(name).cast("binary")))


def packed(docs: DataFrame, **columns: Column) -> DataFrame:
    """Each row as one struct ``doc`` beside the given columns, so no column of ``docs`` can clash with a name used here."""
    return docs.select(F.struct("*").alias("doc"), *[c.alias(name) for name, c in columns.items()])


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z and nothing else."""
    return F.translate(text, UPPER, LOWER)


def word_count(text: Column) -> Column:
    """Number of runs without white space."""
    return F.size(F.array_remove(F.split(text, SPACE), "")).cast("long")


def crc(text: Column) -> Column:
    """CRC-32 of the UTF-8 bytes, unsigned."""
    return F.crc32(text.cast("binary"))


def hash60(*columns: Column) -> Column:
    """The first 60 bits of the MD5 of the columns' text, joined by '|'; NULL is written as an empty text."""
    joined = F.concat_ws("|", *[F.coalesce(c.cast("string"), F.lit("")) for c in columns])
    return F.conv(F.substring(F.md5(joined.cast("binary")), 1, 15), 16, 10).cast("long")


def source_key(name: str) -> Column:
    """A source as a key that is never NULL and sorts by code point, the NULL source last."""
    return F.when(F.col(name).isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), F.col(name).cast("string")))
