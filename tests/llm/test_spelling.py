"""Spelling variants against all pairs of words."""

import itertools
import random
import re
import zlib
from collections import Counter

import pytest

from ledgerloom.llm import spelling

SCHEMA = "doc_id long, text string, word string, n int, key string"


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    long, short = (a, b) if len(a) > len(b) else (b, a)
    return any(long[:i] + long[i + 1:] == short for i in range(len(long)))


def slow_counts(rows, damage):
    n = Counter()
    for doc_id, text in rows:
        for r in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            r = "".join(c.lower() if "A" <= c <= "Z" else c for c in r)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{r}".encode())
            if damage and h % damage == 0:
                r = r[:h % len(r)] + r[h % len(r) + 1:]
            n[r] += 1
    return {w: k for w, k in n.items() if len(w) >= 5 and k >= 3}


def slow_variants(n):
    near = {w: [] for w in n}
    for a, b in itertools.combinations(n, 2):
        if one_edit(a, b):
            near[a].append(b)
            near[b].append(a)
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-n[o], o), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return {w: (form[w], root(w), n[w], len(near[w]), form[w] and n[form[w]]) for w in n}


@pytest.fixture(scope="module")
def texts():
    """Words of few letters, so that many are near, with chains of forms, ties and letters beyond ASCII."""
    rng = random.Random(9)
    stems = ["".join(rng.choice("abcé") for _ in range(rng.randint(4, 12))) for _ in range(120)]
    rows = []
    for i in range(250):
        w = []
        for _ in range(40):
            s = stems[int(rng.random() ** 2 * len(stems))]
            if rng.random() < 0.3:
                k = rng.randrange(len(s) + 1)
                s = rng.choice([s[:k] + s[k + 1:], s[:k] + rng.choice("abcÿ×") + s[k:], s[:k] + "b" + s[k + 1:], s.upper()])
            w.append(s)
        rows.append((i, rng.choice([" ", "-", "3", "\n"]).join(w)))
    rows += [(None, "aaaaaaaa aaaaaaaa aaaaaaa aaaaaaa aaaaaaa"), (1000, None), (1001, ""), (1002, "ab " * 50), rows[3], rows[3]]
    rows += [(2000 + i, "qqqqqqr " * (i < 9) + "qqqqqqs " * (i < 30) + "qqqqqss") for i in range(90)]  # a form that has a form
    rows += [(1003, "x" * 3000 + " " + "x" * 2999 + " " + "x" * 3000 + " " + ("x" * 2999 + " ") * 2 + "x" * 3000)]
    return rows


@pytest.mark.parametrize("limit, most", [(2, 10_000), (2, 5)])
def test_equals_all_pairs(spark, texts, limit, most):
    docs = spark.createDataFrame([(i, t, "w", 1, "k") for i, t in texts], SCHEMA).repartition(3)
    words = spelling.word_counts(docs, damage=7)
    expected = slow_variants(slow_counts(texts, 7))
    got = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in spelling.variants(words, limit, most).collect()}
    assert got == expected
    assert len(got) > 200 and sum(v[0] is not None for v in got.values()) > 50
    assert any(v[0] is not None and v[0] != v[1] for v in got.values())  # a form that has a form


def test_without_damage_and_without_words(spark, texts):
    docs = spark.createDataFrame([(i, t, "w", 1, "k") for i, t in texts], SCHEMA)
    assert {r.word: r.n for r in spelling.word_counts(docs).collect()} == slow_counts(texts, None)
    assert spelling.variants(spelling.word_counts(docs.limit(0), 97)).collect() == []


def test_one_edit_leaves_a_merged_list_whole():
    rng = random.Random(2)
    for _ in range(400):
        word = "".join(rng.choice("ab") for _ in range(rng.randint(5, 14)))
        s = spelling.START + word + spelling.END
        frequent = {s[i:i + q]: rng.randint(1, 99) for q in range(2, 8) for i in range(len(s)) if rng.random() < 0.7}
        grams = spelling.decompose(word, frequent)
        assert spelling.affected(grams) < len(grams)
        assert all(s[i:i + len(g)] == g and len(g) <= len(s) // 2 for i, g in grams)
        two = spelling.merged_lists(grams, frequent)
        assert len(two) == 2 and spelling.affected(two) == 1
        for a, b in itertools.combinations(grams, 2):  # none holds another
            assert not (a[0] >= b[0] and a[0] + len(a[1]) <= b[0] + len(b[1]))


def test_the_limit_rises_until_the_grams_fit(spark):
    words = spark.createDataFrame([("".join(p),) for p in itertools.product("abc", repeat=6)], "word string")
    every = spelling.frequent_grams(words, 1, 10_000)
    few = spelling.frequent_grams(words, 1, 20)
    assert len(few) <= 20 < len(every)
    assert all(n == every[g] for g, n in few.items())
    assert every["ab"] == sum("ab" in "".join(p) for p in itertools.product("abc", repeat=6))


def test_no_side_that_grows_with_the_words_is_broadcast(spark, monkeypatch):
    """Stored words look small to Spark, and their exploded keys no larger: it would broadcast them."""
    plans = []
    store = spelling.stored

    def noted(df, name):
        plans.append((name, df._jdf.queryExecution().sparkPlan().toString()))
        return store(df, name)

    monkeypatch.setattr(spelling, "stored", noted)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")
    try:
        rows = [(a + "".join(p), 1 + 4 * (p[0] == "a")) for a in "xyz" for p in itertools.product("abc", repeat=5)]
        made = spelling.variants(spark.createDataFrame(rows, "word string, n long"))
        plans.append(("result", made._jdf.queryExecution().sparkPlan().toString()))
        assert made.count() == len(rows)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert {"near-words", "roots", "forms", "result"} <= {name for name, plan in plans if "Join" in plan}
    assert [name for name, plan in plans if "Broadcast" in plan] == []
