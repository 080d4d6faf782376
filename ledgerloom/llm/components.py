"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.text import stored


def _large_star(links: DataFrame) -> DataFrame:
    """Each node's larger neighbours are linked to its smallest neighbour (or itself)."""
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Each node's smaller neighbours and the node are linked to its smallest neighbour. Links go down: a > b."""
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    rows = links.join(least, "a")
    return (
        rows.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
        .where("a <> b").distinct()
    )


def components(links: DataFrame) -> DataFrame:
    """(a, b) links between longs -> (node, root): every linked node with the smallest node it reaches.

    A node with very many neighbours is only ever a grouped key of a minimum and one side of a join on that key,
    so its rows can be split. Each round is stored, and a round that changes nothing ends the loop; the number of
    rounds grows with the logarithm of the number of nodes.
    """
    links = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    links, mark = stored(links, "links"), None
    while True:
        seen = links.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
        if (seen["n"], seen["s"]) == mark or not seen["n"]:
            break
        mark = (seen["n"], seen["s"])
        links = stored(_small_star(_large_star(links)), "links")
    roots = links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
