"""Removes documents or spans that hold windows of benchmark words.

The windows of the benchmark are a set of hashes that is broadcast when its measured size allows it, and joined by
shuffle beyond that. Every window of a document is looked up by hash; hits are verified word by word in a second look
at the few documents that have any.

Defined cases. NULL texts and texts without words have no windows and are never contaminated; an item without words
is ignored; an item of fewer than ``n`` words is one window. Items that repeat, share windows or have NULL ids are
fine (a NULL id counts as the text 'null'). Rows of ``docs`` that repeat an id and a text are one document; rows
that share an id, or have none, with other texts are documents of their own, told apart by a digest. Empty tables
give no hits. Further columns are not looked at, and the removing forms keep them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.text import ascii_lower, stored, text_digest, text_of
from ledgerloom.operators.skew import small_side, total_bytes

WINDOW = 10
BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """Words of letters a-z, digits and anything beyond ASCII; expects lower case."""
    return F.array_remove(F.split(text, BREAK), "")


def _hashed(words: Column, start: Column, n: Column | int) -> Column:
    return F.xxhash64(F.slice(words, start + 1, n))


def benchmark_windows(benchmark: DataFrame, n: int, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(length, words, items): each distinct window with the items that hold it."""
    items = benchmark.select(
        F.coalesce(F.col(id_col).cast("string"), F.lit("null")).alias("item"), words_of(ascii_lower(text_of(text_col))).alias("w")
    ).where(F.size("w") > 0)
    length = F.least(F.size("w"), F.lit(n))
    starts = F.explode(F.sequence(F.lit(0), F.size("w") - length))
    windows = items.select("item", "w", length.alias("length"), starts.alias("at"))
    windows = windows.select("item", "length", F.slice("w", F.col("at") + 1, F.col("length")).alias("words"))
    return windows.groupBy("length", "words").agg(F.collect_set("item").alias("items"))


def hits(
    docs: DataFrame, benchmark: DataFrame, n: int = WINDOW, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text",
) -> tuple[DataFrame, DataFrame]:
    """(documents, hits): doc_id, digest, n_words for all, and doc_id, digest, at, length, items for each verified window.

    Both looks lower A-Z and nothing else, by hash and then word by word.
    """
    windows = stored(benchmark_windows(benchmark, n, item_col, item_text_col), "benchmark-windows")
    lengths = [r[0] for r in windows.select("length").distinct().orderBy("length").collect()]  # n values at most
    marks = windows.select(F.col("length").alias("m_length"), F.xxhash64("words").alias("m_hash")).distinct()
    marks = small_side(marks, total_bytes(marks))

    rows = docs.select(F.col(id_col).alias("doc_id"), text_digest(text_col).alias("digest"), text_of(text_col).alias("_text"))
    looked = rows.select("doc_id", "digest", words_of(ascii_lower(F.col("_text"))).alias("w"))

    def windows_of(length: int) -> Column:
        starts = F.when(F.size("w") >= length, F.sequence(F.lit(0), F.size("w") - length)).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.struct(F.lit(length).alias("length"), i.alias("at"), _hashed(F.col("w"), i, length).alias("hash")))

    parts = [windows_of(k) for k in lengths]
    empty = F.array().cast("array<struct<length:int,at:int,hash:bigint>>")
    every = F.concat(*parts) if len(parts) > 1 else parts[0] if parts else empty
    spread = looked.select("doc_id", "digest", F.explode(every).alias("p")).select("doc_id", "digest", F.col("p")["length"].alias("length"), F.col("p")["at"].alias("at"), F.col("p")["hash"].alias("hash"))
    found = spread.join(marks, (F.col("hash") == F.col("m_hash")) & (F.col("length") == F.col("m_length")), "left_semi")
    found = stored(found.groupBy("doc_id", "digest").agg(F.collect_set(F.struct("length", "at")).alias("places")), "window-hits")

    some = small_side(found, total_bytes(found.select("doc_id", "digest")) + 16 * (found.agg(F.sum(F.size("places"))).first()[0] or 0))
    again = rows.join(some.withColumnsRenamed(HIT), _same_document())
    again = again.select("doc_id", "digest", words_of(ascii_lower(F.col("_text"))).alias("w"), "places")
    cut = F.transform("places", lambda p: F.struct(p["at"].alias("at"), F.slice(F.col("w"), p["at"] + 1, p["length"]).alias("words")))
    cut = again.select("doc_id", "digest", F.explode(cut).alias("c")).select("doc_id", "digest", F.col("c")["at"].alias("at"), F.col("c")["words"].alias("words"))
    sure = cut.join(small_side(windows, total_bytes(windows) + 64 * n * windows.count()), "words").select("doc_id", "digest", "at", "length", "items").distinct()
    counted = looked.select("doc_id", "digest", F.size("w").cast("long").alias("n_words"))
    return counted, sure


HIT = {"doc_id": "_hit_id", "digest": "_hit_digest"}


def _same_document() -> Column:
    return F.col("doc_id").eqNullSafe(F.col("_hit_id")) & (F.col("digest") == F.col("_hit_digest"))


def contamination(
    docs: DataFrame, benchmark: DataFrame, n: int = WINDOW, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items (sorted ids), places (hit word numbers)."""
    return _contamination(docs, benchmark, n, id_col, text_col, item_col, item_text_col).drop("digest")


def _contamination(
    docs: DataFrame, benchmark: DataFrame, n: int, id_col: str, text_col: str, item_col: str, item_text_col: str
) -> DataFrame:
    """``contamination`` with the digests."""
    counted, sure = hits(docs, benchmark, n, id_col, text_col, item_col, item_text_col)
    span = F.sequence(F.col("at"), F.col("at") + F.col("length") - 1)
    per = sure.groupBy("doc_id", "digest").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list(span)))).alias("places"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
    )
    per = stored(per, "contaminated")
    known = small_side(per, total_bytes(per.select("doc_id", "digest")) + (per.agg(F.sum(4 * F.size("places") + 32 * F.size("items"))).first()[0] or 0))
    known = known.withColumnsRenamed(HIT)
    none = F.array().cast("array<string>")
    return counted.distinct().join(known, _same_document(), "left").select(
        "doc_id", "digest", "n_words", F.coalesce(F.size("places"), F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"), F.coalesce("items", none).alias("items"),
        F.coalesce("places", F.array().cast("array<int>")).alias("places"),
    )


def drop_contaminated(
    docs: DataFrame, benchmark: DataFrame, n: int = WINDOW, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """The documents without a hit, with all their columns."""
    _, sure = hits(docs, benchmark, n, id_col, text_col, item_col, item_text_col)
    bad = stored(sure.select("doc_id", "digest").distinct().withColumnsRenamed(HIT), "contaminated")
    bad = small_side(bad, total_bytes(bad))
    same = docs[id_col].eqNullSafe(bad["_hit_id"]) & (text_digest(text_col) == bad["_hit_digest"])
    return docs.join(bad, same, "left_anti")


def cut_contaminated(
    docs: DataFrame, benchmark: DataFrame, n: int = WINDOW, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """(doc_id, text): each contaminated document as its words without the hit ones, others with their whole text."""
    marked = _contamination(docs, benchmark, n, id_col, text_col, item_col, item_text_col).select("doc_id", "digest", "places")
    rows = docs.select(F.col(id_col).alias("doc_id"), text_digest(text_col).alias("digest"), text_of(text_col).alias("text"))
    joined = rows.join(marked.withColumnsRenamed(HIT), _same_document())
    words = words_of(ascii_lower(F.col("text")))
    left = F.filter(words, lambda w, i: ~F.array_contains(F.col("places"), i))
    return joined.select("doc_id", F.when(F.size("places") == 0, F.col("text")).otherwise(F.array_join(left, " ")).alias("text"))
