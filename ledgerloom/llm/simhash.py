"""SimHash near-duplicates through a byte-position inverted index with count filtering.

Two fingerprints within three bits differ in at most three of their eight bytes, so they share at least five bytes
at the same positions. The index keys are four bytes with their positions: of the 70 choices the 14 whose positions
have the exclusive-or 0 are enough, since any three positions are avoided by one of them. Fingerprints that meet
under a key have their shared positional bytes tallied; pairs with fewer than five are dropped, the others are
verified by their bits. Equal fingerprints are one entry, whatever the number of their documents.

A key with many fingerprints is cut into blocks, and blocks meet in pairs, so no task holds a hot key. A block pair
returns links that connect what is connected in it, not all pairs.

Defined cases. NULL and empty texts, and texts of white space, have fingerprint 0 and link like any other. Rows that
repeat an id and a text are one document; other rows that share an id, or have none, are told apart by a digest. A NULL id is a member but never a smallest id. An empty input gives no
rows. Further columns of the input are not looked at and may have any names.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.components import components
from ledgerloom.llm.text import packed, stored, strings, text_batches, text_digest

SHINGLE = 3
DISTANCE = 3
BLOCK = 1024
KEYS = [c for c in itertools.combinations(range(8), 4) if c[0] ^ c[1] ^ c[2] ^ c[3] == 0]


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = 42) -> int:
    """Bit i is 1 if it is set in more than half of the hashes of the word shingles; no words: 0."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined, ends, at = b" ".join(words), [], -1
    for w in words:
        at += len(w) + 1
        ends.append(at)
    n = max(1, len(words) - shingle + 1)
    starts = [0, *[e + 1 for e in ends]]
    stops = ends[min(shingle, len(words)) - 1:]
    view, digest = memoryview(joined), xxhash.xxh64_intdigest
    votes = np.zeros(64, np.int64)
    for low in range(0, n, 65536):  # bounded memory for very long texts
        part = range(low, min(n, low + 65536))
        h = np.fromiter((digest(view[starts[i]:stops[i]], seed) for i in part), np.uint64, len(part))
        votes += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(votes * 2 > n, bitorder="little").view(np.uint64)
    return int(bits[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, digest, fp): the 64 bits as a signed long, and the MD5 of the text."""
    rows = docs.select(
        F.col(id_col).cast("string").alias("doc_id"), text_digest(text_col).alias("digest"), F.col(text_col).cast("string").alias("text")
    )

    def run(batches):
        for batch in batches:
            marks = np.fromiter((fingerprint(t, shingle) for t in strings(batch["text"])), np.uint64, len(batch))
            yield pd.DataFrame({"doc_id": strings(batch["doc_id"]), "digest": batch["digest"], "fp": marks.view(np.int64)})

    return rows.mapInPandas(run, "doc_id string, digest binary, fp long").withColumn("doc_id", F.col("doc_id").cast("long"))


def _verified(rows: pd.DataFrame, distance: int) -> pd.DataFrame:
    """Links that connect the fingerprints of one group which lie within the distance under a shared key.

    Rows of a key are adjacent; row i is compared with row i + d, all rows at once, for each d up to the longest
    run. A link whose ends the group has already connected is not returned.
    """
    rows = rows.sort_values(["key", "fp"], kind="stable")
    key, fp = rows["key"].to_numpy(), rows["fp"].to_numpy().view(np.uint64)
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    links = []
    for d in range(1, len(key)):
        near = np.flatnonzero(key[d:] == key[:-d])
        if not len(near):
            break
        differ = fp[near] ^ fp[near + d]
        shared = (differ.view(np.uint8).reshape(-1, 8) == 0).sum(axis=1)  # the tally of shared positional bytes
        near, differ = near[shared >= 8 - distance], differ[shared >= 8 - distance]
        for i in near[np.bitwise_count(differ) <= distance]:
            a, b = int(fp[i]), int(fp[i + d])
            x, y = find(a), find(b)
            if x != y:
                parent[x] = y
                links.append((a, b))
    pairs = np.array(links, np.uint64).reshape(-1, 2).view(np.int64)
    return pd.DataFrame({"a": pairs[:, 0], "b": pairs[:, 1]})


def fingerprint_links(fps: DataFrame, distance: int = DISTANCE, block: int = BLOCK) -> DataFrame:
    """Distinct fingerprints (fp) -> links (a, b) that connect exactly those within ``distance`` (3 at most) bits."""
    if not 0 <= distance <= 3:
        raise ValueError("the keys guarantee a shared one up to 3 differing bits")
    byte = [F.shiftrightunsigned("fp", 8 * i).bitwiseAND(255) for i in range(8)]
    keys = F.array(*[
        sum(F.shiftleft(byte[p], 8 * k) for k, p in enumerate(places)).bitwiseOR(F.lit(number << 32))
        for number, places in enumerate(KEYS)
    ])
    posted = fps.select("fp", F.explode(keys).alias("key"))
    lists = posted.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    entries = posted.join(lists, "key").select("fp", "key", F.ceil(F.col("n") / block).cast("int").alias("blocks"))
    entries = stored(entries, "simhash-postings")
    packs = max(1, math.ceil(entries.count() / (4 * block)))
    own = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    meet = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1), lambda x: F.struct(F.least(own, x).alias("i"), F.greatest(own, x).alias("j"))
    )
    # Short lists share a task with others; each pair of blocks of a long one is a group of its own.
    short = entries.where("blocks = 1").select("fp", "key", F.pmod(F.xxhash64("key"), F.lit(packs)).alias("group"), F.lit(-1).alias("i"), F.lit(-1).alias("j"))
    long = entries.where("blocks > 1").select("fp", "key", F.explode(meet).alias("m")).select(
        "fp", "key", F.col("key").alias("group"), F.col("m")["i"].alias("i"), F.col("m")["j"].alias("j")
    )
    grouped = short.unionByName(long).groupBy("group", "i", "j")
    return grouped.applyInPandas(lambda rows: _verified(rows, distance), "a long, b long")


def simhash_groups(
    docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: doc_id, fp (signed long), component_id (the smallest id reachable by links)."""
    with text_batches(docs.sparkSession):
        marks = stored(fingerprints(docs, shingle, id_col, text_col).select("doc_id", "fp").distinct(), "fingerprints")
    return _grouped(marks, distance).drop("root")


def _grouped(marks: DataFrame, distance: int) -> DataFrame:
    """Adds to each fingerprint (doc_id, fp) the root of its group and component_id."""
    classes = stored(marks.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "fingerprint-classes")
    roots = components(fingerprint_links(classes.select("fp"), distance))
    reached = classes.join(roots, classes["fp"] == roots["node"], "left").withColumn("root", F.coalesce("root", "fp"))
    least = reached.groupBy("root").agg(F.min("first_id").alias("component_id"))
    of = reached.select("fp", "root").join(least, "root").select("fp", "component_id", "root")
    return marks.join(of, "fp").withColumn("component_id", F.coalesce("component_id", "doc_id"))


def keep_one(
    docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One document of every group, with all its columns: the one with the smallest id.

    Of several texts under that id, and in a group without ids, it is the one whose digest sorts first. Of rows that
    repeat an id and a text one is kept.
    """
    marks = fingerprints(docs, shingle, id_col, text_col).groupBy("doc_id", "digest", "fp").agg(F.count("*").alias("rows"))
    with text_batches(docs.sparkSession):
        marks = stored(marks, "fingerprints")
    groups = _grouped(marks, distance)
    kept = groups.where(F.col("component_id").eqNullSafe(F.col("doc_id"))).groupBy("root").agg(
        F.min(F.struct("digest", "doc_id", "rows")).alias("k")
    )
    kept = stored(kept.select("k.*"), "kept")
    rows = packed(docs, row_id=F.col(id_col).cast("long"), row_digest=text_digest(text_col))
    same = F.col("row_id").eqNullSafe(F.col("doc_id")) & (F.col("row_digest") == F.col("digest"))
    once = rows.join(kept.where("rows = 1"), same, "left_semi").select("doc.*")
    several = kept.where("rows > 1")
    if several.isEmpty():
        return once
    return once.unionByName(rows.join(several, same).dropDuplicates(["doc_id", "digest"]).select("doc.*"))
