"""Near-duplicates by signatures against all pairs of plain sets."""

import itertools
import random

import numpy as np
import pandas as pd
import pytest

from ledgerloom.llm import minhash
from ledgerloom.llm.minhash import chunk_keys, confirmed, near_duplicates, shingle_set, signature, word_hashes

SPACES = " \t\n\x0b\x0c\r"


def slow_set(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in SPACES:
        low = low.replace(c, " ")
    w = [x for x in low.split(" ") if x]
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def slow_components(rows):
    """id -> smallest reachable id, for rows whose ids are not NULL; ids of equal rows are one."""
    sets = {(i, t): slow_set(t) for i, t in rows}
    keys = list(sets)
    parent = {k: k for k in keys}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(keys, 2):
        x, y = sets[a], sets[b]
        if x and y and 100 * len(x & y) >= 85 * len(x | y):
            parent[find(a)] = find(b)
    groups = {}
    for k in keys:
        groups.setdefault(find(k), []).append(k)
    least = {}
    for members in groups.values():
        ids = [i for i, _ in members if i is not None]
        for m in members:
            least[m] = min(ids) if ids else None
    return {k: (len(sets[k]), least[k] if sets[k] else k[0]) for k in keys}


def family(rng, size, words, changes):
    """Near copies of one text and near copies of those, with similarities on both sides of the threshold."""
    texts = [[f"w{rng.randint(0, 400)}" for _ in range(words)]]
    while len(texts) < size:
        t = list(rng.choice(texts[-40:]))
        for _ in range(rng.randint(0, changes)):
            t[rng.randrange(len(t))] = f"x{rng.randint(0, 10_000)}"
        texts.append(t)
    return [" ".join(t) for t in texts]


@pytest.fixture(scope="module")
def families(corpus):
    rng = random.Random(3)
    rows = [(r[0], r[1]) for r in corpus]
    at = 1000
    for size, words, changes in ((60, 120, 3), (40, 60, 2), (12, 9, 1), (30, 300, 12)):
        for t in family(rng, size, words, changes):
            rows.append((at, t))
            at += 1
    rows += [(None, rows[100][1]), (None, "one of no id"), (None, "one of no id"), (7, "another text under the id seven"), (5000, "A b C"), (5001, "a B\tc")]
    return rows


@pytest.mark.parametrize("block", [minhash.BLOCK, 4 * minhash.LEAST])
def test_equals_all_pairs(spark, families, block):
    docs = spark.createDataFrame([(i, t, 1, "k") for i, t in families], "doc_id long, text string, n int, cls string").repartition(6)
    got = near_duplicates(docs, block=block).collect()
    assert len(got) == len(families)
    slow = slow_components(families)
    expected = sorted(((i, *slow[i, t]) for i, t in families), key=str)
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == expected
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)
    assert 40 < len({r.component_id for r in got}) < len(families) - 80


def test_empty(spark, nothing):
    assert near_duplicates(nothing).collect() == []
    lonely = spark.createDataFrame([(1, None), (2, " \n"), (3, ""), (4, "x y")], "doc_id long, text string")
    assert sorted(map(tuple, near_duplicates(lonely).collect())) == [(1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True), (4, 1, 4, True)]


def test_all_pairs_within_the_distance_share_a_key():
    rng = np.random.default_rng(1)
    for _ in range(300):
        a = rng.integers(0, 1 << 16, minhash.SYMBOLS).astype(np.uint64)
        b = a.copy()
        places = rng.choice(minhash.SYMBOLS, minhash.DISTANCE, replace=False)
        b[places] ^= rng.integers(1, 1 << 16, len(places)).astype(np.uint64)
        assert set(chunk_keys(a)) & set(chunk_keys(b))
    spaced = a.copy()
    spaced[[c * minhash.WIDTH + i for c in range(minhash.CHUNKS) for i in range(2)]] ^= np.uint64(1)  # two in every chunk
    assert not set(chunk_keys(a)) & set(chunk_keys(spaced))
    assert len(chunk_keys(a)) == 32


def test_similar_sets_lie_within_the_distance():
    rng = np.random.default_rng(2)
    far = []
    for _ in range(300):
        values = rng.integers(0, 1 << 63, 400, dtype=np.uint64)
        far.append(int((signature(values[:370]) != signature(values[30:])).sum()))  # similarity 0.85
    assert max(far) <= minhash.DISTANCE and 4 < np.mean(far) < 5.6


def test_long_texts_are_cut_between_words(monkeypatch):
    text = " ".join(f"Word{i}\n" for i in range(5000))
    whole = word_hashes(text, minhash._Hashes())
    monkeypatch.setattr(minhash, "PIECE", 37)
    assert np.array_equal(whole, word_hashes(text, minhash._Hashes())) and len(whole) == 5000
    assert len(shingle_set(text)) == 4996


def test_confirmed_counts_rare_and_common_values():
    rng = np.random.default_rng(4)
    sets = [np.unique(rng.choice(200, rng.integers(1, 120))).astype(np.uint64) for _ in range(70)]
    sets += [np.unique(np.r_[s, np.uint64(1000 + i)]) for i, s in enumerate(sets[:30])]
    rows = pd.DataFrame({"cls": range(100), "comp": range(100), "block": [i % 2 for i in range(100)], "set": [s.tobytes() for s in sets]})
    both = minhash._shared(np.concatenate(sets), np.repeat(np.arange(100), [len(s) for s in sets]), 100)
    for i, j in itertools.combinations(range(100), 2):
        assert both[i, j] == len(set(sets[i].tolist()) & set(sets[j].tolist()))
    links = confirmed(rows, 85)
    assert len(links) >= 20 and len(links) < 100
    across = confirmed(rows, 85, across=True)
    assert all((a + b) % 2 for a, b in across.itertuples(index=False))
    assert confirmed(rows.assign(comp=1), 85).empty
