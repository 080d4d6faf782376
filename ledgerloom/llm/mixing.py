"""Mixing sources to target weights by pivotal dependent rounding.

Every document of a source is due ``target / source size`` copies. The whole part is given at once; the fractions
are rounded in pairs: of two documents one takes the mass of the other until one of them is 0 or 1, and the other
goes on with the rest. Documents of like size are paired, so the words taken stay near the target. The work is a
reduction tree: blocks of a source, a size class and a hash prefix are folded on the executors, each hands one
residual document on, and a level works on the residuals of the one below. No source is ever together.

Defined cases. A NULL source is a source of its own and sorts last; NULL and empty texts have size 0 and are taken
0 times if their whole source is empty; every row is a unit of its own, rows that repeat an id included; an empty
input gives no rows. Same rows and seed give the same mix. Further columns of the input are not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.text import hash60, packed, source_key, stored, text_digest, text_of, word_count
from ledgerloom.operators.skew import small_side, total_bytes
from ledgerloom.session import checkpoint

ONE = 1 << 30  # copy probabilities in units, so that masses add up exactly
BLOCK_BITS = 6  # about 64 documents to a block
RUN_BITS = 12  # repeats of a row are counted out by 4,096
CLASSES = 8  # size classes to a doubling
WEIGHTS = (5, 2, 1)
BUDGET = 1.5
MOST_COPIES = 2.0
SEED = 29

UNIT = "struct<size:bigint,h:bigint,row:struct<doc_id:bigint,size:bigint,digest:binary,n:bigint>,whole:bigint,p:bigint>"


def targets(
    sizes: DataFrame, weights: Sequence[float] = WEIGHTS, budget: float = BUDGET, most: float = MOST_COPIES
) -> DataFrame:
    """(_source, source_size) -> with target: shares by weight, none above ``most`` times its size.

    Weights repeat along the sources in code-point order. The excess of capped sources goes to the others by weight,
    again and again until none is above; a round needs two sums, and a round without a new capped source ends it.
    """
    place = F.row_number().over(Window.orderBy("_source")) - 1  # one row per source
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place % len(weights) + 1).cast("int"))
    rows = checkpoint(sizes.withColumn("_weight", weight).withColumn("_cap", F.col("source_size") * most))
    total = (rows.agg(F.sum("source_size")).first()[0] or 0) * budget
    level, capped = 0.0, -1
    while True:
        full = F.col("_cap") <= F.col("_weight") * level
        sums = rows.agg(
            F.sum(F.when(full, F.col("_cap")).otherwise(0.0)).alias("held"),
            F.sum(F.when(full, 0.0).otherwise(F.col("_weight"))).alias("open"),
            F.sum(full.cast("long")).alias("n"),
        ).first()
        if not sums["open"] or sums["n"] == capped:
            break
        capped, level = sums["n"], max(level, (total - sums["held"]) / sums["open"])
    return rows.withColumn("target", F.least(F.col("_cap"), F.col("_weight") * level) if sums["open"] else F.col("_cap"))


def _fold(units: Column, seed: int) -> Column:
    """Pivotal rounding along the sorted units: struct(carry, done)."""

    def step(state: Column, x: Column) -> Column:
        c = state["carry"]
        mass = c["p"] + x["p"]
        draw = F.pmod(F.xxhash64(c["h"], x["h"], F.lit(seed)), F.lit(ONE))
        low = mass < ONE
        # Which of the two is decided: below one the loser gets nothing, from one on the winner gets a copy.
        x_goes_on = F.when(low, draw * mass < x["p"] * ONE).otherwise(draw * (2 * ONE - mass) < (ONE - x["p"]) * ONE)
        rest = F.when(low, mass).otherwise(mass - ONE)
        on, off = F.when(x_goes_on, x).otherwise(c), F.when(x_goes_on, c).otherwise(x)
        carry = F.struct(on["size"].alias("size"), on["h"].alias("h"), on["row"].alias("row"), on["whole"].alias("whole"), rest.alias("p"))
        copies = off["whole"] + F.when(low, F.lit(0).cast("long")).otherwise(F.lit(1).cast("long"))
        done = F.concat(state["done"], F.array(F.struct(off["row"].alias("row"), copies.alias("copies"))))
        first = F.struct(x.alias("carry"), state["done"].alias("done"))
        return F.when(c.isNull(), first).otherwise(F.struct(carry.alias("carry"), done.alias("done")))

    row = "struct<doc_id:bigint,size:bigint,digest:binary,n:bigint>"
    zero = F.struct(
        F.lit(None).cast(UNIT).alias("carry"), F.array().cast(f"array<struct<row:{row},copies:bigint>>").alias("done")
    )
    return F.aggregate(units, zero, step)


def _level(units: DataFrame, block: list[str], number: int, seed: int) -> DataFrame:
    """One level of the tree: the units of a block, about 64, folded in the order of their sizes."""
    blocks = units.groupBy(*block).agg(F.array_sort(F.collect_list("unit")).alias("units"))
    return stored(blocks.select(*block, _fold(F.col("units"), seed * 1000 + number).alias("state")), f"mix-{number}")


def _counted_out(rows: DataFrame) -> DataFrame:
    """Each row ``_times`` times, numbered ``n`` from 1; in two steps, so no array holds all repeats of a row."""
    last = F.col("_times") - 1
    runs = rows.withColumn("_run", F.explode(F.sequence(F.lit(0).cast("long"), F.shiftright(last, RUN_BITS))))
    low = F.shiftleft(F.col("_run"), RUN_BITS)
    high = F.least(low + ((1 << RUN_BITS) - 1), last)
    return runs.withColumn("n", F.explode(F.sequence(low + 1, high + 1))).drop("_run")


def mix(
    docs: DataFrame, weights: Sequence[float] = WEIGHTS, budget: float = BUDGET, most: float = MOST_COPIES,
    seed: int = SEED, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, copies, taken (= copies * size), text_md5."""
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), word_count(text_of(text_col)).alias("size"),
        text_digest(text_col).alias("digest"), source_key(source_col).alias("_source"),
    )
    # Rows that repeat everything are one row with a count here and are counted out again as units.
    rows = stored(rows.groupBy("doc_id", "size", "digest", "_source").agg(F.count("*").alias("_times")), "mix-rows")
    sizes = rows.groupBy("_source").agg(F.sum(F.col("size") * F.col("_times")).alias("source_size"))
    plan = checkpoint(targets(sizes, weights, budget, most))

    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    due = F.round(rate * ONE).cast("long")
    whole = F.shiftright(due, 30)
    units = (
        _counted_out(rows)
        .join(small_side(plan.select("_source", whole.alias("whole"), (due - whole * ONE).alias("p")), total_bytes(plan)), "_source")
        .withColumn("h", hash60(F.lit(seed), F.col("doc_id"), F.hex("digest"), F.col("size"), F.col("n")))
        .select(
            "_source", F.floor(F.log2(F.col("size") + 1) * CLASSES).alias("_class"),
            F.struct("size", "h", F.struct("doc_id", "size", "digest", "n").alias("row"), "whole", "p").alias("unit"),
        )
    )
    most_rows = rows.groupBy("_source", F.floor(F.log2(F.col("size") + 1) * CLASSES)).agg(F.sum("_times").alias("n"))
    bits = max(0, math.ceil(math.log2(max(most_rows.agg(F.max("n")).first()[0] or 1, 1)))) - BLOCK_BITS
    bits = max(bits, 0)

    done, number = [], 0
    while True:
        units = units.withColumn("_prefix", F.shiftright(F.col("unit")["h"], 60 - bits) if bits else F.lit(0).cast("long"))
        level = _level(units, ["_source", "_class", "_prefix"], number, seed)
        done.append(level)
        units = level.select("_source", "_class", F.col("state")["carry"].alias("unit"))
        number += 1
        if bits == 0:
            break
        bits = max(0, bits - BLOCK_BITS)
    level = _level(units, ["_source"], number, seed)  # a residual of each size class
    done.append(level)
    last = level.select("_source", F.col("state")["carry"].alias("unit")).select(
        "_source", F.col("unit")["row"].alias("row"),
        (
            F.col("unit")["whole"]
            + (F.pmod(F.xxhash64(F.col("unit")["h"], F.lit(seed)), F.lit(ONE)) < F.col("unit")["p"]).cast("long")
        ).alias("copies"),
    )
    parts = last
    for level in done:
        decided = level.select("_source", F.explode(F.col("state")["done"]).alias("d"))
        parts = parts.unionByName(decided.select("_source", F.col("d")["row"].alias("row"), F.col("d")["copies"].alias("copies")))
    return parts.join(small_side(plan.select("_source", "source_size", "target"), total_bytes(plan)), "_source").select(
        F.col("row")["doc_id"].alias("doc_id"), F.col("row")["size"].alias("size"), "source_size", "target", "copies",
        (F.col("copies") * F.col("row")["size"]).alias("taken"), F.col("row")["digest"].alias("text_md5"),
        F.when(F.col("_source") == "1", F.lit(None)).otherwise(F.substring("_source", 2, 1 << 30)).alias("source"),
    )


def mixed_documents(
    docs: DataFrame, weights: Sequence[float] = WEIGHTS, budget: float = BUDGET, most: float = MOST_COPIES,
    seed: int = SEED, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
) -> DataFrame:
    """The mix itself: every document as often as it is taken, with the columns of ``docs``.

    Rows that repeat an id, a text and a source are one document here, taken as often as all of them together; texts
    are told apart by their MD5. Only such rows are shuffled twice with their texts. Columns may have any names.
    """
    identity = ["doc_id", "text_md5", "source"]
    plan = mix(docs, weights, budget, most, seed, id_col, text_col, source_col)
    plan = plan.groupBy(*identity).agg(F.sum("copies").cast("int").alias("copies"), F.count("*").alias("rows"))
    plan = stored(plan.where("copies > 0"), "mix-plan")
    rows = packed(
        docs, row_id=F.col(id_col).cast("long"), row_md5=text_digest(text_col), row_source=F.col(source_col).cast("string")
    )
    same = F.col("row_id").eqNullSafe(F.col("doc_id")) & (F.col("row_md5") == F.col("text_md5"))
    same = same & F.col("row_source").eqNullSafe(F.col("source"))

    def repeated(taken: DataFrame) -> DataFrame:
        return taken.select("doc", F.explode(F.array_repeat(F.lit(0), F.col("copies"))).alias("copy")).select("doc.*")

    once = repeated(rows.join(plan.where("rows = 1"), same))
    several = plan.where("rows > 1")
    if several.isEmpty():
        return once
    return once.unionByName(repeated(rows.join(several, same).dropDuplicates(identity)))
