"""Shards that all hold the mixture of the whole: proportional stratified interleaving.

Rows are shuffled by a seeded hash and ranked within their source; the fractional rank spreads every source evenly
over (0, 1); the rows sorted by it are cut into equal runs. Both rankings are exact and hold no source together:
rows meet only in cells of about ``CELL_ROWS``, and the cells' offsets are running totals of counts.

Defined cases. A NULL source is a source of its own, a NULL text counts as empty, repeated rows are rows like any
other, and an empty input gives no rows. Ties in the shuffle go by id, checksum and size. Further columns of the
input are not looked at, and ``write_shards`` keeps them.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.text import crc, hash60, source_key, stored, text_of

CELL_ROWS = 4096
SEED = 17


def _ranked(rows: DataFrame, group: list[str], cell: str, order: list[Column], name: str) -> DataFrame:
    """``rows`` with their exact rank, from 0, within the group. ``cell`` must rise with the order."""
    counts = rows.groupBy(*group, cell).agg(F.count("*").alias("_n"))
    before = counts.select(
        *group, cell, (F.sum("_n").over(Window.partitionBy(*group).orderBy(cell)) - F.col("_n")).alias("_before")
    )
    place = F.row_number().over(Window.partitionBy(*group, cell).orderBy(*order))
    return rows.join(before, [*group, cell]).withColumn(name, F.col("_before") + place - 1).drop("_before")


def shard(
    docs: DataFrame, shards: int = 8, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """One row per document: doc_id, size (bytes and one), text_crc32, shard, slot. Shards differ by one row at most."""
    text = text_of(text_col)
    rows = docs.select(
        F.col(id_col).alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
        crc(text).alias("text_crc32"), source_key(source_col).alias("_source"),
    )
    rows = rows.withColumn("_h", hash60(F.lit(seed), F.col("doc_id"), F.col("text_crc32")))
    rows = stored(rows, "shard-rows")
    total = rows.count()
    bits = max(0, math.ceil(math.log2(max(total, 1) / CELL_ROWS)))
    order = [F.col("_h"), F.col("doc_id"), F.col("text_crc32"), F.col("size")]
    rows = rows.withColumn("_cell", F.shiftright("_h", 60 - bits) if bits else F.lit(0).cast("long"))
    rows = _ranked(rows, ["_source"], "_cell", order, "_rank").drop("_cell")
    sizes = rows.groupBy("_source").agg(F.count("*").alias("_of"))
    phase = hash60(F.lit(seed), F.col("_source")) / F.lit(float(1 << 60))  # else all small sources meet in the middle
    share = stored(
        rows.join(sizes, "_source").withColumn("_share", (F.col("_rank") + phase) / F.col("_of")), "shard-shares"
    )
    share = share.withColumn("_cell", F.least(F.floor(F.col("_share") * (1 << bits)), F.lit((1 << bits) - 1)))
    placed = _ranked(share, [], "_cell", [F.col("_share"), *order], "_place")
    number = F.expr(f"_place * {shards}L div {max(total, 1)}L")
    return placed.withColumn("_number", number).select(
        "doc_id", "size", "text_crc32", F.col("_number").cast("int").alias("shard"),
        (F.col("_place") - F.expr(f"(_number * {total}L + {shards - 1}) div {shards}L")).alias("slot"),
    )


def write_shards(docs: DataFrame, plan: DataFrame, path: str, id_col: str = "doc_id") -> None:
    """One folder per shard, its rows in the order of their slots. Ids must be unique."""
    places = plan.select(F.col("doc_id").alias("_id"), F.col("shard").alias("_shard"), F.col("slot").alias("_slot"))
    placed = docs.join(places, docs[id_col] == places["_id"]).drop("_id")
    (
        placed.repartitionByRange("_shard", "_slot").sortWithinPartitions("_shard", "_slot")
        .write.partitionBy("_shard").parquet(path)
    )
