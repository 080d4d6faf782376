"""MinHash near-duplicates through a multi-index Hamming join of b-bit signatures.

A document's set is its distinct shingles as 64-bit hashes. Its signature has 32 symbols of 16 bits, one per hash
function, and the distance of two signatures is the number of symbols that differ. The signature is split into 8
chunks of 4 symbols. Two signatures that differ in at most 15 symbols agree in some chunk but for one symbol (if all
8 chunks had two errors there would be 16), so a document is indexed under each chunk with each one of its symbols
left out, 32 keys, and all pairs within the distance share a key. Sets with a similarity of 0.85 differ in 4.8 symbols
on average, and in 16 or more with a probability of 4e-6.

Documents with equal sets are one class. Classes that share a key are dealt into blocks, those of a bucket next to each
other, and links are confirmed on the full sets inside a block, then between blocks that a bucket reaches across. A
block returns links that connect what it found connected, never all pairs. Blocks have a bounded number of shingles
and rows, so a hot bucket is many blocks; what the first rounds have connected is not compared again:
1. inside each block; 2. one class for each connected part of a bucket that spans blocks; 3. whatever pairs of blocks
still hold classes of one bucket that are not connected.

Defined cases. NULL texts, empty ones and texts of white space have an empty set and link with nothing. A text of
fewer words than a shingle is one shingle. There is one row for each row of the input, repeated ones too. A NULL id is a
member but never the smallest id of its component; a component without ids has the component_id NULL and keeps its
rows. An empty input gives no rows. Further columns of the input are not looked at.
"""

from __future__ import annotations

import hashlib
import itertools
import re

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.components import components
from ledgerloom.llm.text import stored, strings
from ledgerloom.operators.skew import left_join, small_side, total_bytes

SHINGLE = 5
SIMILAR = 85  # percent of the union
CHUNKS, WIDTH, ERRORS = 8, 4, 1  # 8 chunks of 4 symbols, of which one may differ
SYMBOLS = CHUNKS * WIDTH
DISTANCE = CHUNKS * (ERRORS + 1) - 1  # signatures that differ in at most so many symbols always share a key
BLOCK = 1 << 18  # shingles of a block; a class counts as 512 at least, which bounds the classes too
LEAST = 512
PIECE = 1 << 20  # bytes of text that are split into words at once

_MIX = np.random.default_rng(42).integers(1 << 62, 1 << 63, (3, SYMBOLS), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


class _Hashes(dict):
    """Word -> 64-bit hash, of a bounded number of words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 500_000:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word, 42)
        return value


def word_hashes(text: str | None, known: dict) -> np.ndarray:
    """The hashes of the words, A-Z lowered, piece by piece."""
    data, parts, at = (text or "").encode("utf-8", "surrogatepass"), [], 0
    while at < len(data):
        end = at + PIECE
        if end < len(data):
            space = re.compile(rb"[\x20\x09-\x0D]").search(data, end)
            end = space.end() if space else len(data)
        words = data[at:end].lower().split()
        parts.append(np.fromiter(map(known.__getitem__, words), np.uint64, len(words)))
        at = end
    return np.concatenate(parts) if parts else np.empty(0, np.uint64)


def shingle_set(text: str | None, known: dict | None = None, shingle: int = SHINGLE) -> np.ndarray:
    """The sorted distinct shingles as 64-bit hashes; fewer words than a shingle are one."""
    words = word_hashes(text, _Hashes() if known is None else known)
    if not len(words):
        return words
    size = min(shingle, len(words))
    n = len(words) - size + 1
    h = np.full(n, size, np.uint64)
    for i in range(size):
        h = (h ^ words[i:i + n]) * _MIX[0, i]
        h ^= h >> np.uint64(29)
    return np.unique(h)


def signature(values: np.ndarray) -> np.ndarray:
    """The symbols of a set that is not empty."""
    least = np.full(SYMBOLS, np.iinfo(np.uint64).max, np.uint64)
    for low in range(0, len(values), 4096):
        part = (values[low:low + 4096, None] ^ _MIX[1]) * _MIX[2]
        part ^= part >> np.uint64(32)
        least = np.minimum(least, (part * _MIX[1]).min(axis=0))
    return (least * _MIX[2]) >> np.uint64(48)


def chunk_keys(symbols: np.ndarray) -> np.ndarray:
    """Each chunk without each choice of the symbols that may differ: its number, then what is left of it."""
    left = list(itertools.combinations(range(WIDTH), WIDTH - ERRORS))
    keys = []
    for c, chunk in enumerate(symbols.reshape(CHUNKS, WIDTH)):
        for number, places in enumerate(left):
            key = np.uint64(c * len(left) + number)
            for p in places:
                key = (key << np.uint64(16)) | chunk[p]
            keys.append(key)
    return np.array(keys, np.uint64).view(np.int64)


def _set_rows(docs: DataFrame, shingle: int, id_col: str, text_col: str, whole: bool) -> DataFrame:
    """(doc_id, digest of the set, n), with the keys, or with the whole set."""
    rows = docs.select(F.col(id_col).cast("string").alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def run(batches):
        known = _Hashes()
        for batch in batches:
            out = []
            for doc_id, text in zip(strings(batch["doc_id"]), strings(batch["text"])):
                s = shingle_set(text, known, shingle)
                data = s.tobytes()
                more = data if whole else chunk_keys(signature(s)) if len(s) else []
                out.append((doc_id, hashlib.md5(data).digest(), len(s), more))
            yield pd.DataFrame(out, columns=["doc_id", "digest", "n", "set" if whole else "keys"])

    kind = "set binary" if whole else "keys array<long>"
    return rows.mapInPandas(run, f"doc_id string, digest binary, n long, {kind}").withColumn("doc_id", F.col("doc_id").cast("long"))


def _shared(values: np.ndarray, owner: np.ndarray, rows: int) -> np.ndarray:
    """How many values each two rows share. Rare values are paired one by one, common ones as a 0/1 matrix."""
    order = np.argsort(values, kind="stable")
    v, o = values[order], owner[order]
    starts = np.flatnonzero(np.r_[True, v[1:] != v[:-1]])
    runs = np.diff(np.r_[starts, len(v)])
    both = np.zeros(rows * rows, np.int64)
    length = np.repeat(runs, runs)
    rare = np.flatnonzero((length > 1) & (length <= 32))
    rv, ro = v[rare], o[rare]
    for d in range(1, 32):
        same = np.flatnonzero(rv[d:] == rv[:-d])
        if not len(same):
            break
        both += np.bincount(ro[same] * rows + ro[same + d], minlength=rows * rows)
    both = both.reshape(rows, rows)
    both = both + both.T
    common = np.flatnonzero(runs > 32)
    for low in range(0, len(common), 2048):
        some = common[low:low + 2048]
        grid = np.zeros((rows, len(some)), np.float32)
        for column, r in enumerate(some):
            grid[o[starts[r]:starts[r] + runs[r]], column] = 1
        both += (grid @ grid.T).astype(np.int64)
    return both


def confirmed(rows: pd.DataFrame, percent: int = SIMILAR, across: bool = False) -> pd.DataFrame:
    """Links that connect the classes of one group whose full sets are similar.

    ``rows``: cls, comp, block, set. With ``across`` only classes of different blocks are compared. Classes of one ``comp`` are
    connected already.
    """
    rows = rows.drop_duplicates("cls").sort_values("cls")
    sets = [np.frombuffer(s, np.uint64) for s in rows["set"]]
    sizes = np.array([len(s) for s in sets], np.int64)
    count = len(sets)
    both = _shared(np.concatenate(sets), np.repeat(np.arange(count), sizes), count)
    near = 100 * both >= percent * (sizes[:, None] + sizes[None, :] - both)
    part, block = rows["comp"].to_numpy(), rows["block"].to_numpy()
    if across:
        near &= block[:, None] != block[None, :]
    known = part[:, None] == part[None, :]
    ids, seen, links = rows["cls"].to_numpy(), np.zeros(count, bool), []
    for start in range(count):
        if seen[start]:
            continue
        seen[start], reached = True, [start]
        while reached:
            at = reached.pop()
            new = np.flatnonzero((near[at] | known[at]) & ~seen)
            seen[new] = True
            reached.extend(new)
            links.extend((ids[at], ids[x]) for x in new if not known[at, x])
    return pd.DataFrame(links, columns=["a", "b"], dtype=np.int64)


def _weight() -> Column:
    return F.sum(F.greatest(F.col("n"), F.lit(LEAST)))


def _dealt(rows: DataFrame, block: int) -> DataFrame:
    """Adds ``block`` to (cls, label, comp, n): a connected part beyond the size of a block has blocks of its own, then what is
    left of a label beyond it, and small labels share blocks."""
    parts = rows.groupBy("label", "comp").agg(_weight().alias("w"))
    large = parts.where(F.col("w") > block).select("label", "comp", F.ceil(F.col("w") / block).alias("cut"))
    rest = parts.where(F.col("w") <= block).groupBy("label").agg(F.sum("w").alias("w"))
    packs = max(1, -(-(rest.agg(F.sum("w")).first()[0] or 0) // block))
    wide = rest.where(F.col("w") > block).select("label", F.ceil(F.col("w") / block).alias("cut_rest"))
    rows = rows.join(large, ["label", "comp"], "left").join(wide, "label", "left")
    salt = F.xxhash64("cls")
    own = F.when(F.col("cut").isNotNull(), F.xxhash64("label", "comp", F.pmod(salt, F.col("cut"))))
    shared = F.when(F.col("cut_rest").isNotNull(), F.xxhash64("label", F.pmod(salt, F.col("cut_rest"))))
    return rows.withColumn("block", F.coalesce(own, shared, F.pmod(F.xxhash64("label"), F.lit(packs)))).drop("cut", "cut_rest")


def _inside(rows: DataFrame, percent: int) -> DataFrame:
    few = rows.groupBy("block").agg(F.min("comp").alias("c0"), F.max("comp").alias("c1")).where("c0 <> c1").select("block")
    return rows.join(few, "block").groupBy("block").applyInPandas(lambda g: confirmed(g, percent), "a long, b long")


def _between(rows: DataFrame, entries: DataFrame, percent: int) -> DataFrame:
    """Links in and between the blocks of ``rows`` that one bucket of ``entries`` (key, cls) reaches."""
    parts = rows.groupBy("block").agg(F.min("comp").alias("c0"), F.max("comp").alias("c1"))
    held = entries.join(rows.select("cls", "block"), "cls").select("key", "block").distinct().join(parts, "block")
    left, right = (held.select("key", *[F.col(c).alias(f"{side}_{c}") for c in ("block", "c0", "c1")]) for side in ("i", "j"))
    pairs = left.join(right, "key").where("i_block <= j_block AND NOT (i_c0 = i_c1 AND i_c1 = j_c0 AND j_c0 = j_c1)")
    pairs = stored(pairs.select("i_block", "j_block").distinct(), "minhash-block-pairs")
    narrow = rows.select("cls", "comp", "block", "set")
    first = narrow.join(pairs, narrow["block"] == pairs["i_block"])
    second = narrow.join(pairs.where("i_block <> j_block"), F.col("block") == F.col("j_block"))

    def run(group: pd.DataFrame) -> pd.DataFrame:
        return confirmed(group, percent, across=group["i_block"].iat[0] != group["j_block"].iat[0])

    return first.unionByName(second).groupBy("i_block", "j_block").applyInPandas(run, "a long, b long")


def _with_parts(rows: DataFrame, links: DataFrame) -> DataFrame:
    """Sets ``comp`` of each class to the smallest class that the links connect it with."""
    roots = components(links)
    joined = rows.drop("comp").join(roots, rows["cls"] == roots["node"], "left")
    return joined.withColumn("comp", F.coalesce("root", "cls")).drop("node", "root")


def class_links(entries: DataFrame, sets: DataFrame, percent: int = SIMILAR, block: int = BLOCK) -> DataFrame:
    """Buckets (key, cls, leader) and (cls, n, set) -> links (a, b) that connect exactly the similar classes of a bucket."""
    labels = entries.groupBy("cls").agg(F.min("leader").alias("label"))
    rows = sets.select("cls", "n").join(labels, "cls").withColumn("comp", F.col("cls"))
    rows = stored(_dealt(rows, block), "minhash-blocks")
    links = stored(_inside(rows.join(sets.select("cls", "set"), "cls"), percent), "minhash-links")

    spread = entries.join(rows.select("cls", "block"), "cls").groupBy("key").agg(F.min("block").alias("b0"), F.max("block").alias("b1"))
    cross = stored(entries.join(spread.where("b0 <> b1").select("key"), "key"), "minhash-cross")
    if cross.isEmpty():
        return links
    reach = cross.groupBy("cls").agg(F.min("leader").alias("label"))
    held = sets.select("cls", "n").join(reach, "cls").withColumn("comp", F.col("cls"))
    held = stored(_with_parts(held, links), "minhash-parts")
    first = held.groupBy("label", "comp").agg(F.min("cls").alias("cls")).drop("comp")
    first = _dealt(first.join(sets.select("cls", "n"), "cls").withColumn("comp", F.col("cls")), block)
    links = stored(links.unionByName(_inside(first.join(sets.select("cls", "set"), "cls"), percent)), "minhash-links")

    held = stored(_with_parts(held, links), "minhash-parts")
    of = cross.join(held.select("cls", "comp"), "cls")
    open_keys = of.groupBy("key").agg(F.min("comp").alias("c0"), F.max("comp").alias("c1")).where("c0 <> c1").select("key")
    still = stored(cross.join(open_keys, "key").select("key", "cls"), "minhash-open")
    rest = stored(_dealt(held.join(still.select("cls").distinct(), "cls"), block), "minhash-blocks")
    more = _between(rest.join(sets.select("cls", "set"), "cls"), still, percent)
    return stored(links.unionByName(more), "minhash-links")


def near_duplicates(
    docs: DataFrame, shingle: int = SHINGLE, percent: int = SIMILAR, block: int = BLOCK, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (the smallest id reachable by links), kept."""
    marks = stored(_set_rows(docs, shingle, id_col, text_col, whole=False), "minhash-signatures")
    found = marks.where("n > 0").groupBy("digest").agg(
        F.min("doc_id").alias("first_id"), F.first("n").alias("n"), F.first("keys").alias("keys")
    )
    classes = stored(found.withColumn("cls", F.monotonically_increasing_id()), "minhash-classes")  # numbers are fixed by the write
    posts = classes.select("cls", F.explode("keys").alias("key"))
    lists = stored(posts.groupBy("key").agg(F.count("*").alias("_n"), F.min("cls").alias("leader")).where("_n > 1"), "minhash-buckets")
    entries = left_join(posts, lists.select("key", "leader"), "key", left_counts=lists.select("key", "_n"), unique_right=True)
    entries = stored(entries.where("leader IS NOT NULL").select("key", "cls", "leader"), "minhash-entries")
    roots = classes.select("cls", "digest", "first_id").withColumn("root", F.col("cls"))
    if not entries.isEmpty():
        mates = stored(classes.join(entries.select("cls").distinct(), "cls").select("cls", "digest", "first_id", "n"), "minhash-mates")
        ids = mates.select(F.col("first_id").alias("_mate")).distinct()
        chosen = docs.join(small_side(ids, total_bytes(ids)), docs[id_col].cast("long").eqNullSafe(F.col("_mate")), "left_semi")
        sets = _set_rows(chosen, shingle, id_col, text_col, whole=True).select("digest", "set")
        sets = stored(sets.join(mates.select("cls", "digest", "n"), "digest").dropDuplicates(["digest"]).drop("digest"), "minhash-sets")
        reached = components(class_links(entries, sets, percent, block))
        roots = classes.select("cls", "digest", "first_id").join(reached, F.col("cls") == F.col("node"), "left").select(
            "digest", "first_id", F.coalesce("root", "cls").alias("root")
        )
    least = roots.groupBy("root").agg(F.min("first_id").alias("component_id"))
    of = stored(roots.select("digest", "root").join(least, "root").select("digest", "component_id"), "minhash-components")
    rows = left_join(marks.select("doc_id", "digest", "n"), of, "digest", unique_right=True)
    reached = F.coalesce("component_id", "doc_id")
    return rows.select("doc_id", F.col("n").alias("n_shingles"), reached.alias("component_id"), reached.eqNullSafe(F.col("doc_id")).alias("kept"))
