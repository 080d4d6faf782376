"""Exact dedup, mixing, sharding and decontamination against plain Python."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from checks.compare import connect, sorted_rows
from ledgerloom.llm import decontaminate, exact_dedup, mixing, queries, sharding
from ledgerloom.llm.text import documents


def distinct_rows(corpus):
    return {(r[0], r[1]): r for r in corpus}.values()


def test_exact_dedup(spark, docs, corpus):
    got = {(r.doc_id, bytes(r.digest)): r for r in exact_dedup.exact_dedup(docs, exact_dedup.DigestIndex.fresh(spark, 4), 3).collect()}
    groups = defaultdict(list)
    for r in corpus:
        text = re.sub(r"[\x20\x09-\x0D]+", " ", r[1] or "")
        groups[hashlib.sha256(text.encode()).digest()].append(r[0])
    assert len(got) == len(distinct_rows(corpus))
    for (doc_id, digest), r in got.items():
        ids = [i for i in groups[digest] if i is not None]
        keep = min(ids) if ids else None
        assert (r.keep_id, r.group_size, r.kept) == (keep, len(groups[digest]), doc_id == keep)


def test_index_keeps_what_came_first(spark, docs):
    index = exact_dedup.DigestIndex.fresh(spark, 4)
    index.add(exact_dedup.digests(docs.where("doc_id >= 20")))
    before = index.read().count()
    later = exact_dedup.exact_dedup(docs, index).where("doc_id = 0").first()
    assert later.keep_id == 40 and not later.kept  # a copy of document 0 was there before it
    assert index.read().count() > before
    assert index.read().groupBy("digest").count().where("count > 1").isEmpty()
    plan = docs.sparkSession.table(index.table).select("digest").join(
        exact_dedup.digests(docs).hint("merge"), "digest", "left_anti"
    )._jdf.queryExecution().toString()
    assert "SortMergeJoin" in plan


def test_keep_first(spark, docs):
    kept = exact_dedup.keep_first(docs, exact_dedup.DigestIndex.fresh(spark, 4))
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert len(ids) == len(set(ids)) and 0 in ids and 41 not in ids


def test_shards(docs, corpus):
    rows = sharding.shard(docs, 8).collect()
    assert len(rows) == len(corpus)
    text = Counter((r[0], zlib.crc32((r[1] or "").encode()), len((r[1] or "").encode()) + 1) for r in corpus)
    assert Counter((r.doc_id, r.text_crc32, r.size) for r in rows) == text
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert sorted(slots) == list(range(8))
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    source = {r[0]: r[3] for r in corpus}
    total = Counter(source.values())
    for s in range(8):
        held = Counter(source[r.doc_id] for r in rows if r.shard == s)
        assert all(abs(held[k] - total[k] / 8) <= 2 for k in total)
    again = {(r.doc_id, r.text_crc32): (r.shard, r.slot) for r in sharding.shard(docs.repartition(3), 8).collect()}
    assert {v for k, v in again.items() if k[0] != 5} == {(r.shard, r.slot) for r in rows if r.doc_id != 5}


def test_small_cells_rank_alike(docs, monkeypatch):
    whole = {(r.doc_id, r.shard, r.slot) for r in sharding.shard(docs).collect()}
    monkeypatch.setattr(sharding, "CELL_ROWS", 4)
    assert {(r.doc_id, r.shard, r.slot) for r in sharding.shard(docs).collect()} == whole


def water(sizes, budget=1.5, most=2.0):
    """Targets by filling up, source after source."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5.0, 2.0, 1.0)[i % 3] for i, s in enumerate(order)}
    open_, target, left = set(order), {}, budget * sum(sizes.values())
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if weight[s] * level >= most * sizes[s]}
        if not full:
            return target | {s: weight[s] * level for s in open_}
        for s in full:
            target[s] = most * sizes[s]
            left -= target[s]
        open_ -= full
    return target


@pytest.mark.parametrize("block_bits", [6, 2])
def test_mix(docs, corpus, monkeypatch, block_bits):
    monkeypatch.setattr(mixing, "BLOCK_BITS", block_bits)
    rows = mixing.mix(docs).collect()
    size = {(r[0], r[1]): len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or "")) for r in corpus}
    assert Counter(r.doc_id for r in rows) == Counter(r[0] for r in corpus)
    sizes = Counter()
    for r in corpus:
        sizes[r[3]] += size[r[0], r[1]]
    expected = water(sizes)
    copies, due = Counter(), Counter()
    for r in rows:
        assert r.target == pytest.approx(expected[r.source]) and r.source_size == sizes[r.source]
        rate = r.target / r.source_size
        assert int(rate) <= r.copies <= min(2, int(rate) + 1) and r.taken == r.copies * r.size
        copies[r.source] += r.copies
        due[r.source] += rate
    assert all(abs(copies[s] - due[s]) < 1 + 1e-6 for s in due)  # the pairing keeps the sum
    assert sorted(map(str, mixing.mix(docs.repartition(2)).collect())) == sorted(map(str, rows))


def test_mix_is_fair(spark):
    """Over many seeds every document is taken as often as it is due."""
    docs = spark.createDataFrame([(i, "w " * (i + 1), "a" if i < 12 else "b") for i in range(16)], "doc_id long, text string, source string")
    taken = Counter()
    for seed in range(25):
        for r in mixing.mix(docs, seed=seed).collect():
            taken[r.doc_id] += r.copies - r.target / r.source_size
    assert abs(sum(taken.values())) < 25 and max(map(abs, taken.values())) < 12


def test_mixed_documents(docs):
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    got = Counter(r.doc_id for r in mixed.collect())
    for r in mixing.mix(docs).groupBy("doc_id").agg(F.sum("copies").alias("n")).collect():
        assert got[r.doc_id] == r.n


def test_decontamination(spark, docs, corpus):
    texts = {r[0]: r[1] for r in corpus}
    items = [
        (1, " ".join(texts[3].split()[4:24]).upper()), (2, "ÄÖ straße"), (3, None), (4, "..."), (5, " ".join(texts[3].split()[10:20])),
        (None, " ".join(texts[4].split()[:12])), (1, " ".join(texts[3].split()[4:24])),
    ]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(lower))
    windows = defaultdict(set)
    for item, t in items:
        w = split(t)
        for i in range(max(0, len(w) - min(10, len(w)) + 1) if w else 0):
            windows[tuple(w[i:i + 10])].add("null" if item is None else str(item))
    for r in decontaminate.contamination(docs, benchmark).collect():
        w, places, held = split(texts[r.doc_id]), set(), set()
        for k in {len(x) for x in windows}:
            for i in range(len(w) - k + 1):
                if tuple(w[i:i + k]) in windows:
                    places |= set(range(i, i + k))
                    held |= windows[tuple(w[i:i + k])]
        assert (r.n_words, r.n_hit, r.n_items, r["items"], r.places) == (len(w), len(places), len(held), sorted(held), sorted(places))
    left = {r.doc_id for r in decontaminate.drop_contaminated(docs, benchmark).collect()}
    assert 3 not in left and 4 not in left and 6 in left and None in left
    cut = {r.doc_id: r.text for r in decontaminate.cut_contaminated(docs, benchmark).collect()}
    assert cut[6] == texts[6] and len(cut[3].split()) == len(split(texts[3])) - 20


def test_empty_tables(spark, docs, nothing):
    benchmark = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contamination(docs, benchmark).where("n_hit > 0").isEmpty()
    assert decontaminate.contamination(nothing, benchmark).isEmpty()
    assert exact_dedup.exact_dedup(nothing, exact_dedup.DigestIndex.fresh(spark, 2), 2).isEmpty()
    assert sharding.shard(nothing).isEmpty() and mixing.mix(nothing).isEmpty()


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_its_sql(spark, sf, name):
    frame = queries.QUERIES[name](spark, sf)
    result = connect(sf).execute(queries.ORACLES[name])
    assert sorted_rows(frame.columns, frame.collect()) == sorted_rows([d[0] for d in result.description], result.fetchall())


def test_native_plans_hold_no_python(spark, sf):
    docs = documents(spark, sf)
    for df in (exact_dedup.digests(docs), sharding.shard(docs), mixing.mix(docs)):
        plan = df._jdf.queryExecution().toString()
        assert not re.search("Python|Pandas|Arrow", plan)
