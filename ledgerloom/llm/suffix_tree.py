"""A probabilistic suffix tree over words, fitted on the training part and used to score every text.

Contexts are the last one or two words. A sequence counts
that occurs ``LEAST`` times, and a context is a state of the tree when its continuations diverge enough from the
shorter context. A state keeps the continuations that it makes likelier, discounted, and hands the rest of its mass to
the shorter context; the root is the add-one distribution of words. So the probabilities after every context add up to
one, and a text is scored along the longest states: its log10 probability is the sum of the weights of the words,
pairs and triples in it.

Passes over the corpus: every chunk reports all its words and all its triples, packed by ranges of keys, and the ranges
sum them; the tree is made of these counts by joins and aggregates, and is a table of weights; the texts are scored.
What makes up a share of FLOOR of the corpus is broadcast with its weight; all other words, and the pairs and triples
that may be in the tree by a filter of at most FILTER_BITS, meet their weights in a shuffle. FLOOR and the filter decide
what travels, not what is scored. Tokens travel as arrays of 64-bit hashes.

Defined cases. NULL text counts as empty and holds the end token alone. A NULL id is the text '' for the choice of
training rows. Repeated rows are scored, and learned from, as often as they occur. Without training rows N and V are
0 and all tokens are unknown. An empty input gives no rows. Further columns are not looked at.
"""

from __future__ import annotations

import math
import zlib
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.text import stored, strings

FLOOR = 8e-6  # what makes up this share of the corpus is looked up at once, all else in a shuffle
LEAST = 4  # a sequence must occur this often, however small or large the corpus
RATIO = 1.05  # a continuation is kept when its state makes it likelier by this factor
GAIN = 2.0  # nats that a state must gain on the training part for each continuation it keeps
DISCOUNT = 0.5
CHUNK = 3 << 18
FRAME_BYTES = 2 << 20  # that a chunk hands on at a time
COUNT_BYTES, SCORE_BYTES = 3 << 20, 8 << 20  # text for each range of keys: a range is one group, held whole on both sides
FILTER_BITS = 1 << 28
PROBES = 31, 7  # which bits of a key the filter is asked with
FOLDS, HELD = 7, 2
END = 0x9E3779B97F4A7C15  # stands for the end token; no word hashes to it but by chance


def held_out(doc_id: str | None) -> bool:
    return zlib.crc32((doc_id or "").encode()) % FOLDS == HELD


def token_hashes(text: str | None) -> np.ndarray:
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    out = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    return np.append(out, np.uint64(END))


def _mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """One hash of two, in order."""
    x = a * np.uint64(0x9FB21C651E98DF25) + (b ^ (b >> np.uint64(29)))
    x ^= x >> np.uint64(32)
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _sequences(h: np.ndarray, starts: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(keys, places of the last token) of all sequences of depth + 1 tokens that stay within a document."""
    key = h
    for d in range(1, depth + 1):
        key = _mix(key[:-1], h[d:])
    first = np.zeros(len(h) + 1, np.int64)
    first[starts] = 1
    doc = np.cumsum(first[:-1], dtype=np.int32)
    inside = np.flatnonzero(doc[depth:] == doc[: len(doc) - depth]) if len(h) > depth else np.zeros(0, np.int64)
    return key[inside], inside + depth


def _chunks(batches, training: bool):
    """Arrays of about CHUNK tokens: hashes, starts of documents, ids. ``training``: only rows to learn from."""
    held, ids, size = [], [], 0
    for batch in batches:
        for doc_id, text in zip(strings(batch["doc_id"]), strings(batch["text"])):
            if training and held_out(doc_id):
                continue
            h = token_hashes(text)
            held.append(h)
            ids.append(doc_id)
            size += len(h)
            if size >= CHUNK:
                yield np.concatenate(held), np.cumsum([0, *map(len, held[:-1])]), ids
                held, ids, size = [], [], 0
    if held:
        yield np.concatenate(held), np.cumsum([0, *map(len, held[:-1])]), ids


def _range_of(keys: np.ndarray, ranges: int) -> np.ndarray:
    return (keys & np.uint64(0x7FFFFFFF)).astype(np.int64) % ranges


def _by_range(keys: np.ndarray, ranges: int):
    """(range, places) of the keys, grouped."""
    r = _range_of(keys, ranges).astype(np.min_scalar_type(ranges))  # small numbers are sorted by their digits
    order = np.argsort(r, kind="stable").astype(np.int32)
    cuts = np.append(0, np.cumsum(np.bincount(r, minlength=ranges)))
    for i in range(ranges):
        if cuts[i] < cuts[i + 1]:
            yield i, order[cuts[i]:cuts[i + 1]]


def _frames(rows, columns: list[str], blobs: list[int]):
    """Rows as frames of about FRAME_BYTES in the columns ``blobs``, so that neither side holds those of a chunk at once."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += sum(len(row[i]) for i in blobs)
        if size >= FRAME_BYTES:
            yield pd.DataFrame(held, columns=columns)
            held, size = [], 0
    if held:
        yield pd.DataFrame(held, columns=columns)


COUNTS = "depth int, range int, parts binary, counts binary"


def _packs(depth: int, h: np.ndarray, keys: np.ndarray, ends: np.ndarray, ranges: int):
    """Each key once with its tokens, a column after the other, and its count; one row for a range, made by itself."""
    def row(r, at):
        _, first, counts = np.unique(keys[at], return_index=True, return_counts=True)
        last = ends[at[first]]
        lead = np.argsort(h[last - depth], kind="stable")  # equal first tokens together pack well
        last, counts = last[lead], counts[lead].astype(np.int32)
        return depth, r, b"".join(h[last - d].tobytes() for d in range(depth, -1, -1)), counts.tobytes()

    return _frames((row(r, at) for r, at in _by_range(keys, ranges)), ["depth", "range", "parts", "counts"], [2, 3])


def _report(ranges: int):
    """Per chunk and range: the counts of all words and pairs."""

    def run(batches):
        for h, starts, _ in _chunks(batches, training=True):
            yield from _packs(0, h, h, np.arange(len(h)), ranges)
            yield from _packs(1, h, *_sequences(h, starts, 1), ranges)

    return run


def _report_triples(shared, ranges: int):
    """Per chunk and range: the counts of the triples whose pairs may both be frequent; others are not."""

    def run(batches):
        pairs = Filter(**shared.value)
        for h, starts, _ in _chunks(batches, training=True):
            frequent = np.zeros(len(h), bool)  # by the place of the last token
            keys, ends = _sequences(h, starts, 1)
            frequent[ends] = pairs.maybe(keys)
            keys, ends = _sequences(h, starts, 2)
            both = frequent[ends] & frequent[ends - 1]
            yield from _packs(2, h, keys[both], ends[both], ranges)

    return run


def _u64(blob: bytes) -> np.ndarray:
    return np.frombuffer(blob, np.uint64)


def _i64(blob: bytes) -> np.ndarray:
    return np.frombuffer(blob, np.int64)


def _total(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each key once: keys, the place of one occurrence, sums of the counts."""
    order = np.argsort(keys)
    keys = keys[order]
    cuts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    return keys[cuts], order[cuts], np.add.reduceat(counts[order], cuts) if len(cuts) else np.zeros(0, np.int64)


GRAMS = "depth int, key long, context long, low long, near long, last long, n long"


def _counted(rows: pd.DataFrame) -> pd.DataFrame:
    """One depth and range: its words, or the pairs or triples that occur LEAST times, with their counts."""
    depth = int(rows["depth"].iloc[0])
    columns = [_u64(x).reshape(depth + 1, -1) for x in rows["parts"]]
    parts = np.concatenate(columns, axis=1).T
    key, at, n = _total(_chain(parts), np.concatenate([np.frombuffer(x, np.int32) for x in rows["counts"]]).astype(np.int64))
    kept = n >= (LEAST if depth else 1)
    key, parts, n = key[kept], parts[at[kept]], n[kept]
    none = np.zeros(len(key), np.uint64)  # words are their key, and pairs need no more than their two words
    named = {"key": key, "context": none, "low": none, "near": none, "last": none}
    if depth:
        named |= {"context": _chain(parts[:, :depth]), "last": parts[:, depth]}
    if depth == 2:
        named |= {"low": _chain(parts[:, 1:]), "near": parts[:, 1]}
    return pd.DataFrame({"depth": depth, **{c: x.astype(np.uint64).view(np.int64) for c, x in named.items()}, "n": n})


@dataclass
class Tree:
    """Sorted arrays: frequent words, states by context with the logarithm of their handed-on mass, entries by
    sequence with the logarithm of their gain over the root. Depth 1 and 2."""

    tokens: int
    types: int
    words: np.ndarray
    word_counts: np.ndarray
    states: list[np.ndarray]
    rest: list[np.ndarray]
    entries: list[np.ndarray]
    gain: list[np.ndarray]
    ranges: int = 1  # of the table of word counts


def _find(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Places of the keys in a sorted table, -1 where they are not in it."""
    if not len(table):
        return np.full(len(keys), -1)
    at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return np.where(table[at] == keys, at, -1)


def _sorted(keys, *others):
    order = np.argsort(keys)
    return [x[order] for x in (keys, *others)]


def build_tree(tokens: int, types: int, words, counts, grams) -> Tree:
    """``grams``: for depth 1 and 2, (parts as rows of hashes, exact counts) of the sequences that reach the floor."""
    words, counts = _sorted(np.asarray(words, np.uint64), np.asarray(counts, np.int64))
    tree = Tree(tokens, types, words, counts, [], [], [], [])
    base = np.log((counts + 1) / (tokens + types + 1))
    above_keys, above_count = words, counts  # contexts of the depth at hand, with their counts
    for depth, (parts, n) in enumerate(grams, 1):
        keys, parts, n = _chain(parts), np.asarray(parts, np.uint64).reshape(-1, depth + 1), np.asarray(n, np.int64)
        context = _chain(parts[:, :-1])
        at = _find(above_keys, context)
        last = _find(words, parts[:, -1])
        ok = (at >= 0) & (last >= 0)
        keys, parts, n, context, at, last = (x[ok] for x in (keys, parts, n, context, at, last))
        of = above_count[at]
        parent = base[last]
        if depth == 2:  # by the state of the nearer word, if it is one
            s = _find(tree.states[0], parts[:, 1])
            e = _find(tree.entries[0], _chain(parts[:, 1:]))
            handed = np.where(s >= 0, tree.rest[0][s] if len(tree.rest[0]) else 0.0, 0.0)
            parent = parent + np.where((s >= 0) & (e >= 0), tree.gain[0][e] if len(tree.gain[0]) else 0.0, handed)
        kept = n / of >= RATIO * np.exp(parent)
        keys, n, context, of, last, parent = (x[kept] for x in (keys, n, context, of, last, parent))
        group, first, back = np.unique(context, return_index=True, return_inverse=True)
        own = (n - DISCOUNT) / of
        mass = np.bincount(back, own, len(group)) if len(group) else np.zeros(0)
        rest = np.maximum(1 - mass, 1e-12)
        log_p = np.log(own + rest[back] * np.exp(parent)) if len(group) else np.zeros(0)
        won = np.bincount(back, n * (log_p - parent), len(group)) if len(group) else np.zeros(0)
        size = np.bincount(back, minlength=len(group))
        rested = of[first] - np.bincount(back, n, len(group)) if len(group) else np.zeros(0)
        state = won + rested * np.log(rest) >= GAIN * size  # the divergence test
        entry = state[back] if len(group) else np.zeros(0, bool)
        states, left = _sorted(group[state], np.log(rest[state]))
        entries, gain = _sorted(keys[entry], (log_p - base[last])[entry])
        tree.states.append(states)
        tree.rest.append(left)
        tree.entries.append(entries)
        tree.gain.append(gain)
        above_keys, above_count = _sorted(_chain(np.asarray(grams[0][0], np.uint64).reshape(-1, 2)), np.asarray(grams[0][1], np.int64))
    return tree


def _chain(parts) -> np.ndarray:
    parts = np.asarray(parts, np.uint64)
    if parts.ndim == 1:
        return parts
    key = parts[:, 0]
    for d in range(1, parts.shape[1]):
        key = _mix(key, parts[:, d])
    return key


def adjustments(tree: Tree, h: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """For each token the natural logarithm of P(token | longest state) over P(token)."""
    out = np.zeros(len(h))
    for depth in (1, 2):
        keys, ends = _sequences(h, starts, depth)
        contexts = h[ends - 1] if depth == 1 else _mix(h[ends - 2], h[ends - 1])
        state, entry = _find(tree.states[depth - 1], contexts), _find(tree.entries[depth - 1], keys)
        known = state >= 0
        ends, state, entry = ends[known], state[known], entry[known]
        if len(ends):
            out[ends] += tree.rest[depth - 1][state]
            direct = entry >= 0
            out[ends[direct]] = tree.gain[depth - 1][entry[direct]]
    return out


def _narrow(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("string").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def _level(grams: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(states: context, of, rest), (entries: key, n, rest, gain, handed) of the sequences of one depth.

    ``grams``: key, context, n, of, base, parent; the last two are logarithms, as are rest, gain and
    handed, which is parent above base. The sums by context
    are aggregates that Spark makes in part before it shuffles, so a frequent context is no burden.
    """
    kept = grams.where(F.col("n") / F.col("of") >= RATIO * F.exp("parent")).withColumn("own", (F.col("n") - DISCOUNT) / F.col("of"))
    mass = kept.groupBy("context").agg(F.greatest(1 - F.sum("own"), F.lit(1e-12)).alias("left"))
    likely = kept.join(mass, "context").withColumn("log_p", F.log(F.col("own") + F.col("left") * F.exp("parent")))
    likely = _kept(likely.select("key", "context", "n", "of", "base", "parent", "left", "log_p"), "likely")
    won = likely.groupBy("context").agg(
        F.sum(F.col("n") * (F.col("log_p") - F.col("parent"))).alias("won"), F.count("*").alias("size"),
        F.sum("n").alias("in"), F.first("of").alias("of"), F.log(F.first("left")).alias("rest"),
    )
    rested = (F.col("of") - F.col("in")) * F.col("rest")
    states = won.where(F.col("won") + rested >= GAIN * F.col("size")).select("context", "of", "rest")
    entries = likely.join(states.drop("of"), "context").select(
        "key", "n", "rest", (F.col("log_p") - F.col("base")).alias("gain"), (F.col("parent") - F.col("base")).alias("handed")
    )
    return states, entries


KEPT_CONF = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",  # whole texts are carried
}


def _kept(df: DataFrame, name: str) -> DataFrame:
    """``stored``; the files of the shuffles that led to it go at once."""
    conf = df.sparkSession.conf
    before = {key: conf.get(key) for key in KEPT_CONF}
    for key, value in KEPT_CONF.items():
        conf.set(key, value)
    try:
        return stored(df, name)
    finally:
        for key, value in before.items():
            conf.set(key, value)


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[int, int, DataFrame]:
    """(N, V, weights) of the training rows. ``weights``: key, n, count, weight of every word and of all of the tree;
    a key's count (of a word) and weight are the sums over its rows, n is its count in each of them.

    The logarithm of a text's adjustments is the sum of the weights of all words, pairs and triples that occur in it: a
    word hands on the mass of its state, a pair replaces that by its gain and hands on the mass of its own state, and
    so does a triple.
    """
    spark, rows = docs.sparkSession, _narrow(docs, id_col, text_col)
    ranges = _ranges(rows, COUNT_BYTES)

    def counted(report, name):
        return _kept(rows.mapInPandas(report, COUNTS).groupBy("depth", "range").applyInPandas(_counted, GRAMS), name)

    table = counted(_report(ranges), "pairs")
    pairs, words = table.where("depth = 1"), table.where("depth = 0").select(F.col("key").alias("word"), F.col("n").alias("count"))
    sums = words.agg(F.sum("count").alias("n"), F.count("*").alias("v")).first()
    tokens, types = sums["n"] or 0, sums["v"] or 0
    triples = counted(_report_triples(spark.sparkContext.broadcast(_filter(pairs.select("key"))), ranges), "triples")
    often = words.where(F.col("count") >= LEAST)
    last = often.select(F.col("word").alias("last"), F.log((F.col("count") + 1) / F.lit(float(tokens + types + 1))).alias("base"))
    first = pairs.select("key", "context", "last", "n").join(last, "last")
    first = first.join(often.select(F.col("word").alias("context"), F.col("count").alias("of")), "context")
    states_1, entries_1 = (_kept(x, "tree") for x in _level(first.withColumn("parent", F.col("base"))))
    second = triples.select("key", "context", "low", "near", "last", "n").join(last, "last").drop("last")
    second = second.join(states_1.select(F.col("context").alias("near"), F.col("rest").alias("near_rest")), "near", "left").drop("near")
    second = second.join(entries_1.select(F.col("key").alias("low"), F.col("gain").alias("low_gain")), "low", "left")
    second = second.select(
        "key", "context", "n", "base", (F.col("base") + F.coalesce("low_gain", "near_rest", F.lit(0.0))).alias("parent")
    ).join(pairs.select(F.col("key").alias("context"), F.col("n").alias("of")), "context")
    states_2, entries_2 = (_kept(x, "tree") for x in _level(second))
    zero = F.lit(0).cast("long").alias("count")
    parts = [
        words.select(F.col("word").alias("key"), F.col("count").alias("n"), "count", F.lit(0.0).alias("weight")),
        entries_1.select("key", "n", zero, (F.col("gain") - F.col("rest")).alias("weight")),
        entries_2.select("key", "n", zero, (F.col("gain") - F.col("rest") - F.col("handed")).alias("weight")),
        *[x.select(F.col("context").alias("key"), F.col("of").alias("n"), zero, F.col("rest").alias("weight")) for x in (states_1, states_2)],
    ]
    return tokens, types, reduce(DataFrame.unionByName, parts)


def _ranges(rows: DataFrame, size: int) -> int:
    """Ranges of keys for about ``size`` bytes of text each, so that a range stays small however large the corpus."""
    total = rows.agg(F.sum(F.octet_length("text") + 1)).first()[0] or 0
    return max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), total // size)


def _range_column(ranges: int):
    return (F.col("key").bitwiseAND(F.lit(0x7FFFFFFF)) % ranges).cast("int").alias("range")


def _u64_column(values: pd.Series) -> np.ndarray:
    return values.to_numpy(np.int64).view(np.uint64)


def _bits(most: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        keys = _u64_column(rows["key"])
        bits = np.zeros(min(most, 16 * len(keys)), np.uint8)
        for shift in PROBES:
            bits[(keys >> np.uint64(shift)) % np.uint64(len(bits))] = 1
        return pd.DataFrame({"range": [int(rows["range"].iloc[0])], "size": [len(bits)], "bits": [np.packbits(bits, bitorder="little").tobytes()]})

    return run


def _filter(keys: DataFrame) -> dict:
    """Bits, made by ranges and at most FILTER_BITS together, that all of the keys pass and most others fail."""
    ranges = int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    made = keys.select("key", _range_column(ranges)).groupBy("range").applyInPandas(_bits(FILTER_BITS // ranges), "range int, size long, bits binary")
    bits, sizes = [b"\0"] * ranges, np.ones(ranges, np.uint64)
    for row in made.collect():  # bounded by FILTER_BITS
        bits[row["range"]], sizes[row["range"]] = bytes(row["bits"]), row["size"]
    offsets = np.cumsum([0, *[8 * len(x) for x in bits[:-1]]])
    return vars(Filter(np.frombuffer(b"".join(bits), np.uint8), offsets, sizes))


@dataclass
class Filter:
    bits: np.ndarray
    offsets: np.ndarray
    sizes: np.ndarray

    def maybe(self, keys: np.ndarray) -> np.ndarray:
        r = _range_of(keys, len(self.sizes))
        out = np.ones(len(keys), bool)
        for shift in PROBES:
            at = self.offsets[r] + ((keys >> np.uint64(shift)) % self.sizes[r]).astype(np.int64)
            out &= (self.bits[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)
        return out


def _packed(rows: pd.DataFrame) -> pd.DataFrame:
    """The weights of one range, sorted."""
    packed = {c: [x.tobytes()] for c, x in zip(("keys", "counts", "weights"), _merged(rows))}
    return pd.DataFrame({"range": [int(rows["range"].iloc[0])], **packed})


def _merged(rows: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys in order, each once, with their counts and weights."""
    keys = _u64_column(rows["key"])
    unique, _, counts = _total(keys, rows["count"].to_numpy(np.int64))
    return unique, counts, _total(keys, rows["weight"].to_numpy(np.float64))[2].astype(np.float64)


PACKED = "range int, keys binary, counts binary, weights binary"


POSTINGS = "chunk string, range int, keys binary, at binary, docs binary, times binary, facts binary, names array<string>"


def _tally(shared, ranges: int):
    """Per chunk: one row of facts about its documents, and by range the rarer keys with where they occur."""

    def run(batches):
        (table, counts, weights), rest = shared.value
        rest, part, logs = Filter(**rest), TaskContext.get().partitionId(), np.log10(counts + 1)
        for number, (h, starts, ids) in enumerate(_chunks(batches, training=False)):
            doc = np.repeat(np.arange(len(starts), dtype=np.int32), np.diff(np.append(starts, len(h))))
            at = _find(table, h)
            seen = at >= 0
            base = np.bincount(doc[seen], logs[at[seen]], len(starts))
            known = np.bincount(doc[seen], minlength=len(starts))
            gain = np.bincount(doc[seen], weights[at[seen]], len(starts))
            rare, where = [h[~seen]], [doc[~seen]]
            for depth in (1, 2):
                keys, ends = _sequences(h, starts, depth)
                at = _find(table, keys)
                seen = at >= 0
                gain += np.bincount(doc[ends[seen]], weights[at[seen]], len(starts))
                left = np.flatnonzero(~seen)
                left = left[rest.maybe(keys[left])]
                rare.append(keys[left])
                where.append(doc[ends[left]])
            facts = np.stack([np.diff(np.append(starts, len(h))), known, base, gain]).astype(np.float64)
            name = f"{part}-{number}"
            yield pd.DataFrame([(name, -1, b"", b"", b"", b"", facts.tobytes(), ids)], columns=columns)
            rare, where = np.concatenate(rare), np.concatenate(where)
            rows = ((name, r, *_sent(*_postings(rare[own], where[own])), b"", None) for r, own in _by_range(rare, ranges))
            yield from _frames(rows, columns, [2, 3, 4, 5])

    columns = ["chunk", "range", "keys", "at", "docs", "times", "facts", "names"]
    return run


def _postings(keys: np.ndarray, docs: np.ndarray) -> list[bytes]:
    """Occurrences of the keys of a range -> each key once, in how many documents, which, and how often in each."""
    order = np.argsort(keys, kind="stable")  # by key, and by document as they came
    keys, docs = keys[order], docs[order]
    new_key = np.append(True, keys[1:] != keys[:-1])
    at = np.flatnonzero(new_key | np.append(True, docs[1:] != docs[:-1]))
    lengths = np.diff(np.append(np.flatnonzero(new_key[at]), len(at)))
    times = np.diff(np.append(at, len(keys)))
    return [keys[new_key].tobytes(), *(x.astype(np.int32).tobytes() for x in (lengths, docs[at], times))]


def _sent(keys: bytes, lengths: bytes, docs: bytes, times: bytes) -> list[bytes]:
    """Postings as they travel: sorted keys as steps, all lowest bytes first, since the highest ones are zeros; whole
    numbers in the fewest bytes that hold the largest."""
    steps = np.diff(_u64(keys), prepend=np.uint64(0))
    numbers = (np.frombuffer(x, np.int32) for x in (lengths, docs, times))
    return [steps.view(np.uint8).reshape(-1, 8).T.tobytes(), *(x.astype(np.min_scalar_type(x.max())).tobytes() for x in numbers)]


def _whole(blob: bytes, n: int) -> np.ndarray:
    return np.frombuffer(blob, f"u{len(blob) // n}").astype(np.int32)


def _received(keys: bytes, lengths: bytes, docs: bytes, times: bytes) -> list[np.ndarray]:
    """What ``_sent`` was given, as arrays."""
    keys = np.cumsum(np.frombuffer(keys, np.uint8).reshape(8, -1).T.copy().view(np.uint64).reshape(-1), dtype=np.uint64)
    lengths = _whole(lengths, len(keys))
    n = int(lengths.sum())
    return [keys, lengths, _whole(docs, n), _whole(times, n)]


def _weighed(rows: pd.DataFrame) -> pd.DataFrame:
    """One range: what its keys add to the documents of each chunk. The facts of a chunk pass."""
    if rows["names"].notna().any():
        return rows[["chunk", "docs", "facts", "names"]]
    table = rows[rows["chunk"].isna()]
    keys, counts, weights = (np.frombuffer(table[c].iloc[0] if len(table) else b"", t) for c, t in (("keys", np.uint64), ("at", np.int64), ("docs", np.float64)))
    out = []
    for row in rows[rows["chunk"].notna()].itertuples():
        asked, lengths, docs, times = _received(row.keys, row.at, row.docs, row.times)
        at = _find(keys, asked)
        c = np.where(at >= 0, counts[at] if len(counts) else 0, 0)
        w = np.where(at >= 0, weights[at] if len(weights) else 0.0, 0.0)
        c, w = (np.repeat(x, lengths) for x in (c, w))
        docs, back = np.unique(docs, return_inverse=True)
        more = [np.bincount(back, x, len(docs)) for x in ((c > 0) * times, np.log10(c + 1) * times, w * times)]
        out.append((row.chunk, docs.astype(np.int32).tobytes(), np.stack(more).tobytes(), None))
    return pd.DataFrame(out, columns=["chunk", "docs", "facts", "names"])


def _scored(tokens: int, types: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        """One chunk: its facts and what the ranges add to them."""
        own = rows[rows["names"].notna()].iloc[0]
        names = list(own["names"])
        n, known, base, gain = np.frombuffer(own["facts"]).reshape(4, -1).copy()
        for row in rows[rows["names"].isna()].itertuples():
            docs = np.frombuffer(row.docs, np.int32)
            more = np.frombuffer(row.facts).reshape(3, -1)
            known[docs] += more[0]
            base[docs] += more[1]
            gain[docs] += more[2]
        base = base - n * math.log10(tokens + types + 1)
        return pd.DataFrame({
            "doc_id": names, "held_out": [held_out(x) for x in names], "n_tokens": n.astype(np.int64),
            "n_known": known.astype(np.int64), "train_tokens": tokens, "base_score": base, "score": base + gain / math.log(10),
        })

    return run


def score(
    docs: DataFrame, tokens: int, types: int, weights: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10)."""
    spark, rows = docs.sparkSession, _narrow(docs, id_col, text_col)
    ranges = _ranges(rows, SCORE_BYTES)
    often = F.col("n") >= max(1.0, FLOOR * tokens)
    found = weights.where(often).select("key", "count", "weight").toPandas()  # bounded by FLOOR
    in_tree = weights.where((F.col("count") == 0) & ~often)  # the words among them pass as well, and are never asked for
    shared = spark.sparkContext.broadcast((_merged(found), _filter(in_tree)))
    table = weights.where(~often).select("key", "count", "weight", _range_column(ranges)).groupBy("range").applyInPandas(_packed, PACKED)
    parts = rows.mapInPandas(_tally(shared, ranges), POSTINGS)
    own_weights = table.select(
        F.lit(None).cast("string").alias("chunk"), "range", "keys", F.col("counts").alias("at"), F.col("weights").alias("docs"),
        *[F.lit(None).cast(kind).alias(c) for c, kind in (("times", "binary"), ("facts", "binary"), ("names", "array<string>"))],
    )
    # The facts of each chunk are a group of their own, so one shuffle serves both.
    own = F.when(F.col("range") < 0, F.col("chunk"))
    weighed = parts.unionByName(own_weights).groupBy("range", own.alias("own")).applyInPandas(
        _weighed, "chunk string, docs binary, facts binary, names array<string>"
    )
    scored = _kept(weighed, "weighed").groupBy("chunk").applyInPandas(
        _scored(tokens, types),
        "doc_id string, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double",
    )
    return scored.withColumn("doc_id", F.col("doc_id").cast("long"))


def fit_and_score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    return score(docs, *fit(docs, id_col, text_col), id_col, text_col)
