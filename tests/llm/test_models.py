"""SimHash, scoring, personal data, toxicity, passages and token files against plain Python."""

import itertools
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash

import corpus_pipeline
from ledgerloom.llm import passages, pii, queries, simhash, suffix_tree, text, token_files, toxicity
from ledgerloom.llm.components import components
from ledgerloom.session import new_shared_path


def slow_fingerprint(text):
    w = (text or "").encode().lower().split()
    hashes = [xxhash.xxh64_intdigest(b" ".join(w[i:i + 3]), 42) for i in range(max(1, len(w) - 2))] if w else []
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(pairs, nodes):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("block", [1024, 4])
def test_simhash(docs, corpus, monkeypatch, block):
    monkeypatch.setattr(simhash.fingerprint_links, "__defaults__", (3, block))
    got = {r.doc_id: r for r in simhash.simhash_groups(docs).collect()}
    marks = {r[0]: slow_fingerprint(r[1]) for r in corpus}
    assert {i: r.fp % (1 << 64) for i, r in got.items()} == marks
    ids = [i for i in marks if i is not None]
    expected = classes([p for p in itertools.combinations(ids, 2) if (marks[p[0]] ^ marks[p[1]]).bit_count() <= 3], ids)
    assert {i: got[i].component_id for i in ids} == expected
    assert len(set(expected.values())) < len(ids) - 30


def test_keys_meet_all_close_pairs():
    rng = random.Random(1)
    for places in itertools.combinations(range(8), 3):
        assert any(not set(places) & set(k) for k in simhash.KEYS)
    assert len(simhash.KEYS) == 14 and rng


def test_keep_one_and_empty(docs, nothing):
    kept = simhash.keep_one(docs)
    ids = [r.doc_id for r in kept.collect()]
    assert kept.columns == docs.columns and 0 in ids and 40 not in ids
    assert simhash.simhash_groups(nothing).isEmpty()


def test_components(spark):
    rng = random.Random(3)
    pairs = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 180)] + [(rng.randrange(200, 400), rng.randrange(200, 400)) for _ in range(120)]
    nodes = {n for a, b in pairs if a != b for n in (a, b)}
    got = {r.node: r.root for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {n: r for n, r in classes(pairs, nodes).items()}


def tokens_of(text):
    return [*(text or "").encode().lower().split(), None]


def test_scores(docs, corpus):
    rows = suffix_tree.fit_and_score(docs).collect()
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2
    counts = Counter(t for r in corpus if not held(r[0]) for t in tokens_of(r[1]))
    n, v = sum(counts.values()), len(counts)
    assert Counter(r.doc_id for r in rows) == Counter(r[0] for r in corpus)
    texts = {r[0]: r[1] for r in corpus}
    for r in rows:
        own = tokens_of(texts[r.doc_id])
        assert (r.n_tokens, r.n_known, r.train_tokens, r.held_out) == (len(own), sum(counts[t] > 0 for t in own), n, held(r.doc_id))
        assert r.base_score == pytest.approx(sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in own), rel=1e-9)
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows)


def test_tree_is_a_distribution_and_counts_are_exact():
    """After every context the probabilities of all words, and of an unknown one, add up to one."""
    rng = random.Random(9)
    vocabulary = [f"w{i}" for i in range(12)]
    docs, w = [], "w0"
    for _ in range(60):
        own = []
        for _ in range(40):
            w = rng.choice([w, vocabulary[(int(w[1:]) + 1) % 12], rng.choice(vocabulary)])
            own.append(w)
        docs.append(" ".join(own))
    hashes = [suffix_tree.token_hashes(d) for d in docs]
    words = Counter(int(x) for h in hashes for x in h)
    grams = []
    for d in (1, 2):
        c = Counter(tuple(map(int, h[i:i + d + 1])) for h in hashes for i in range(len(h) - d))
        c = {k: n for k, n in c.items() if n >= 4}
        grams.append((np.array(list(c), np.uint64).reshape(-1, d + 1), np.array(list(c.values()))))
    n, v = sum(words.values()), len(words)
    tree = suffix_tree.build_tree(n, v, list(words), list(words.values()), grams)
    assert len(tree.states[0]) and len(tree.entries[0])
    known = np.array(list(words), np.uint64)
    for context in itertools.product(known[:6], known[:6]):
        total = 0.0
        for x in [*known, np.uint64(12345)]:
            h = np.array([*context, x], np.uint64)
            gain = suffix_tree.adjustments(tree, h, np.array([0]))[2]
            total += (words.get(int(x), 0) + 1) / (n + v + 1) * math.exp(gain)
        assert total == pytest.approx(1.0)


def test_scores_without_rows(nothing, spark):
    assert suffix_tree.fit_and_score(nothing).isEmpty()


def test_scores_follow_the_whole_tree_whatever_the_share_of_the_corpus(spark):
    """Sequences that occur seldom in a million tokens, below 8e-6 of them, belong to the tree."""
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(3000)]
    texts = [" ".join(rng.choices(vocabulary, k=900)) for _ in range(1200)]
    for i in range(0, 1200, 75):
        texts[i] += " omega beta sigma" if i % 150 else " alpha beta gamma"
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(6)
    got = {r.doc_id: r for r in suffix_tree.fit_and_score(rows).collect()}
    hashes = [suffix_tree.token_hashes(t) for t in texts]
    training = [h.tolist() for i, h in enumerate(hashes) if not suffix_tree.held_out(str(i))]
    words = Counter(w for h in training for w in h)
    grams = []
    for d in (1, 2):
        c = {k: n for k, n in Counter(k for h in training for k in zip(*[h[j:] for j in range(d + 1)])).items() if n >= 4}
        grams.append((np.array(list(c), np.uint64).reshape(-1, d + 1), np.array(list(c.values()))))
    n, v = sum(words.values()), len(words)
    assert 4 <= words[int(hashes[0][-2])] < 8e-6 * n - 0.1
    tree = suffix_tree.build_tree(n, v, list(words), list(words.values()), grams)
    assert len(tree.states[0]) and len(tree.states[1])
    for i, h in enumerate(hashes):
        gain = suffix_tree.adjustments(tree, h, np.array([0])).sum() / math.log(10)
        assert got[i].score == pytest.approx(got[i].base_score + gain, rel=1e-9)
        assert i % 75 or gain > 3


PII_TEXTS = [
    "mail to a.b@mail.example.com, or c@d.e.f. now", "ip 10.0.0.255 and 300.1.1.1 and 1.2.3.4.5", "card 4111 1111 1111 1111.",
    "4111-1111-1111-1112 5500005555555559", "+1 (555) 555-0199 or +49 30 1234567890123456", "call (555) 123-4567 today", "password=abc123def",
    "x@y a@b.c@d.e é@b.co ü a@b.c", None, "", "+", "1" * 50, "é 4111111111111111 " * 40,
]


def test_personal_data(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(PII_TEXTS * 3)] + [(0, PII_TEXTS[0])], "doc_id long, text string")
    got = pii.find(docs).select("doc_id", "base", pii.written("spans").alias("spans")).collect()
    assert len(got) == len(PII_TEXTS) * 3 + 1
    for r in got:
        text, base = PII_TEXTS[r.doc_id % len(PII_TEXTS)] or "", []
        for kind, form in (("email", pii.EMAIL), ("ip", pii.IP), ("card", pii.CARD), ("phone", pii.PHONE)):
            base += [(m.start(), kind, m.end()) for m in form.finditer(text) if pii.valid(kind, m.group())]
        base = sorted(base, key=lambda x: (x[0], pii.KINDS.index(x[1])))
        assert [(x.start, pii.KINDS[x.kind], x.end) for x in r.base] == base
        spans = [x.split(":") for x in r.spans.split(",") if x]
        assert {(int(s), k, int(e)) for k, s, e in spans} >= set(base)


def test_reliabilities_find_the_good_labelers():
    rng = np.random.default_rng(0)
    truth = rng.random(4000) < 0.4
    given = np.stack([np.where(rng.random(4000) < p, np.where(truth, 1, -1), np.where(truth, -1, 1)) for p in (0.95, 0.9, 0.55, 0.9)], axis=1)
    patterns, counts = np.unique(given, axis=0, return_counts=True)
    p, prior, table = pii.reliabilities(patterns, counts.astype(float))
    right = table[1, :, 2]
    assert prior == pytest.approx(0.4, abs=0.05) and right[0] > 0.9 and right[2] < 0.65


def test_redaction(spark, nothing):
    docs = spark.createDataFrame([(1, "to a@b.co and +1 555 555 0199!"), (2, None)], "doc_id long, text string")
    out = {r.doc_id: r.text for r in pii.redact(docs).collect()}
    assert out == {1: "to [email] and [phone]!", 2: ""}
    assert pii.find(nothing).isEmpty()


def toxic_rows(n=400):
    rng = random.Random(2)
    rows, labels = [], []
    for i in range(n):
        w = [f"{rng.choice('abcdefgh')}{rng.choice('aeiou')}{rng.choice('klmnop')}{rng.randint(0, 99)}" for _ in range(rng.randint(30, 80))]
        bad = i % 8 == 0
        if bad:
            for _ in range(4):
                w[rng.randrange(len(w))] = "vilest" + rng.choice(["", "ly", "ness", "ish"])
        rows.append((i, " ".join(w)))
        labels.append((i, int(bad)))
    return rows, labels


def test_toxicity(spark):
    rows, labels = toxic_rows()
    docs = spark.createDataFrame([*rows, (1000, None), (1001, ""), (None, "x")], "doc_id long, text string")
    marks = spark.createDataFrame([*labels, (0, None), (None, 1), (9, 0)], "doc_id long, toxic int")
    model = toxicity.fit(docs, marks)
    got = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    assert len(got) == len(rows) + 3 and all(0 <= r.score <= 1 for r in got.values())
    held = [r for i, r in got.items() if i is not None and i < 400 and r.held_out]
    right = sum(r.predicted == dict(labels)[r.doc_id] for r in held)
    assert right / len(held) > 0.95 and any(r.predicted for r in held)
    assert got[1000].score == got[1001].score < 0.5
    assert all(not toxicity.held_out(str(i)) for i in model.ids)
    kept = {r.doc_id for r in toxicity.drop_toxic(docs, marks).collect()}
    assert kept == {i for i, r in got.items() if not r.predicted}


def test_nearest_is_exact():
    rng = np.random.default_rng(4)
    model = toxicity.Index({f"t{i}": i for i in range(50)}, rng.random(51) + 0.5, list(range(300)), np.zeros(300), np.ones(300))
    made = []
    for _ in range(300):
        at = rng.choice(51, rng.integers(1, 8), replace=False)
        w = rng.random(len(at))
        made.append((at, w / np.linalg.norm(w)))
    model.fill(made)
    dense = np.zeros((300, 51))
    for i, (at, w) in enumerate(made):
        dense[i, at] = w
    for at, w in made[:60]:
        q = np.zeros(51)
        q[at] = w
        near, cosine = model.nearest(at, w, 15)
        assert np.allclose(cosine, np.sort(dense @ q)[::-1][: len(near)])
    model.vocabulary["t1*"] = 1
    assert toxicity.sharpest({"long*": 5.0, "longe*": 7.0, "other": 1.0}) == ["longe*", "other"]


def test_toxicity_without_labels(spark, nothing, docs):
    marks = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r.score for r in toxicity.score(docs, toxicity.fit(docs, marks)).collect()} == {0.0}
    assert toxicity.score(nothing, toxicity.fit(nothing, marks)).isEmpty()


def test_passages(spark):
    rng = random.Random(8)
    word = lambda: f"{rng.choice('abcdefgh')}{rng.randint(0, 100000)}"
    plain = [[word() for _ in range(rng.randint(80, 200))] for _ in range(60)]
    shared = [word() for _ in range(70)]
    for i in range(10, 40):  # one passage in half of the documents
        at = rng.randrange(len(plain[i]))
        plain[i][at:at] = shared
    fuzzy = list(shared)
    for k in (12, 27, 44):
        fuzzy[k] = "changed"
    plain[50][20:20] = fuzzy + [word() for _ in range(3)]
    short = [word() for _ in range(30)]
    plain[1][5:5], plain[2][9:9] = short, short
    rows = [(i, " ".join(w)) for i, w in enumerate(plain)] + [(100, " ".join(plain[0])), (101, None), (102, ""), (None, " ".join(plain[0]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = passages.passages(docs).collect()
    found = {r.doc_id: r for r in got}
    assert set(found) == {*range(11, 40), 50, 100}
    for i in range(11, 40):
        r = found[i]
        assert r.other_id == 10 and plain[i][r.start:r.end] == shared == plain[10][r.other_start:r.other_end]
    assert 0.9 < found[50].similarity < 1 and found[50].start <= 22 and found[50].end >= 88
    assert (found[100].start, found[100].end, found[100].other_id) == (0, len(plain[0]), 0)
    cut = {r.doc_id: r.text for r in passages.cut_passages(docs).collect()}
    assert cut[10] == " ".join(plain[10]) and " ".join(shared) not in cut[11] and cut[100] == ""


def slow_chain(x, y):
    """Best score of a collinear chain, by looking at every pair."""
    order = sorted(range(len(x)), key=lambda i: (x[i], y[i]))
    best = {}
    for i in order:
        best[i] = 1 + max([0.0, *(best[j] - passages.GAP_COST * (x[i] - x[j] + y[i] - y[j]) for j in best if x[j] < x[i] and y[j] < y[i])])
    return max(best.values())


def test_chains_are_best():
    rng = np.random.default_rng(6)
    for _ in range(40):
        x, y = rng.integers(0, 60, 25), rng.integers(0, 60, 25)
        chain = passages.chains(x, y)[0]
        score = len(chain) - passages.GAP_COST * ((x[chain][-1] - x[chain][0]) + (y[chain][-1] - y[chain][0]))
        assert score == pytest.approx(slow_chain(x.tolist(), y.tolist()))
        assert (np.diff(x[chain]) > 0).all() and (np.diff(y[chain]) > 0).all()


def test_passages_of_nothing(nothing):
    assert passages.passages(nothing).isEmpty()


def test_elias_fano():
    rng = random.Random(1)
    for values in ([], [0], [5, 5, 5], list(range(1000)), sorted(rng.randrange(1 << 40) for _ in range(700)), [0] * 300 + [1 << 50]):
        data = token_files.EliasFano.encode(values)
        back = token_files.EliasFano(data)
        assert back.all().tolist() == values == [back.select(i) for i in range(len(back))]
    dense = sorted(rng.randrange(1 << 21) for _ in range(5000))
    assert len(token_files.EliasFano.encode(dense)) < 5000 * 1.7  # against 8 bytes each
    with pytest.raises(ValueError):
        token_files.EliasFano.encode([2, 1])


ODD_TEXTS = [
    " lead", "two  spaces", "tab\tand \n\n lines\n", "end ", "it's we'll wide", "a.b, c! d?\ne\r\nf", "<|endoftext|> x<|endoftext|>", "日本語 テキスト。",
    "é́ ñ ÿ ɐ", "\x1c \x1cx \x85y", "1,234.5 a1b2", "don't stop.\nNow. ...", " ", "\n", "a\nb\nc", "x \ty", "don’t “quote” ½ ²", "ﬀ ǅ ʰ ª º",
]


def test_pieces_equal_the_whole_tokenizer():
    from tokenizers import Tokenizer

    path = queries.tokenizer_path()
    plain, encoder = Tokenizer.from_file(path), token_files.PieceEncoder(path, 2, limit=20)
    rng = random.Random(3)
    alphabet = list("ab .,;'\n\t  é1  A!?-")
    texts = ODD_TEXTS + ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(1500)]
    for text, blob in zip(texts, encoder.encode(texts)):
        assert np.frombuffer(blob, "<u2").tolist() == [*plain.encode(text, add_special_tokens=False).ids, 2], repr(text)


def test_token_files(spark, docs, corpus, nothing, monkeypatch):
    from tokenizers import Tokenizer

    monkeypatch.setattr(token_files, "PART_BYTES", 4096)
    plain = Tokenizer.from_file(queries.tokenizer_path())
    path = new_shared_path(spark, "tokens")
    token_files.write_tokens(docs, path, queries.tokenizer_path())
    got = sorted(token_files.read_tokens(spark, path).collect(), key=lambda r: r.start)
    rows = sorted(corpus, key=lambda r: (r[0] is not None, r[0] or 0))
    at = 0
    for r, row in zip(got, rows, strict=True):
        ids = [*plain.encode(row[1] or "", add_special_tokens=False).ids, 2]
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (row[0], at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
    path = new_shared_path(spark, "tokens")
    token_files.write_tokens(nothing, path, queries.tokenizer_path())
    assert token_files.read_tokens(spark, path).isEmpty()


def test_pipeline(spark, sf):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "near_duplicates", "decontamination", "mixing", "token_output"]
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    step = docs
    for name, stage in corpus_pipeline.STAGES[:4]:
        after = stage(spark, step, sf)
        assert after.columns == docs.columns
        ids = [r.doc_id for r in after.collect()]
        assert set(ids) <= {r.doc_id for r in step.collect()}
        if name == "near_duplicates":
            groups = {r.doc_id: r.component_id for r in simhash.simhash_groups(step).collect()}
            assert sorted(ids) == sorted(set(groups.values()))
        step = after
    expected = Counter(r.doc_id for r in step.collect())
    rows = corpus_pipeline.run(spark, sf).collect()
    assert Counter(r.doc_id for r in rows) == expected
    rows.sort(key=lambda r: r.start)
    assert all(a.start + a.n_tokens == b.start for a, b in zip(rows, rows[1:])) and re.match("", "")


def test_stages_hand_whole_texts_on_in_small_batches(spark, sf, monkeypatch):
    """Documents travel to Python BATCH_ROWS at a time in the stages that look at texts; the session keeps its own setting."""
    seen, before = [], spark.conf.get(text.BATCH_CONF)

    def spy(module):
        plain = module.stored
        monkeypatch.setattr(module, "stored", lambda df, name: seen.append((name, spark.conf.get(text.BATCH_CONF))) or plain(df, name))

    for module in (corpus_pipeline, simhash):
        spy(module)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    corpus_pipeline.drop_near_duplicates(spark, corpus_pipeline.drop_toxic(spark, docs, sf), sf)
    assert [x for x in seen if x[0] in ("not-toxic", "fingerprints")] == [(n, str(text.BATCH_ROWS)) for n in ("not-toxic", "fingerprints")]
    assert spark.conf.get(text.BATCH_CONF) == before
    spark.conf.set(text.BATCH_CONF, "7")
    try:
        with text.text_batches(spark):
            assert spark.conf.get(text.BATCH_CONF) == "7"
    finally:
        spark.conf.set(text.BATCH_CONF, before)


def test_marks_behind_letters_are_cut_off():
    """A run of marks that ends a piece is encoded once, whatever the words before it."""
    encoder = token_files.PieceEncoder(queries.tokenizer_path())
    runs = ["###", ".&&&", ",%%%", "$$$", "?!", ":", "\"", ")", "->", "--", "'s", "',", ">"]
    words = ["haend", "Öbesch", "x"]
    texts = [f"{w}{r} {w}{r}\n{w}{r} ({w}{r}" for w in words for r in runs]
    for t, blob in zip(texts, encoder.encode(texts)):
        assert np.frombuffer(blob, "<u2").tolist() == [*encoder.tokenizer.encode(t, add_special_tokens=False).ids, 2], t
    assert {"###", ".&&&", ",%%%", "$$$", "?!"} <= encoder.bare.keys()
    assert {"haend", "Öbesch", "x"} <= encoder.known.keys()


def test_a_chunk_is_handed_on_in_small_frames(monkeypatch):
    """Ranges are packed one by one, and what a chunk makes goes in frames; together they are the counts of all keys."""
    rng = np.random.default_rng(5)
    h = rng.integers(0, 2**63, 500).astype(np.uint64)[rng.zipf(1.3, 20_000) % 500]
    starts = np.array([0, 7, 7, 5000, 19_999])
    monkeypatch.setattr(suffix_tree, "FRAME_BYTES", 10_000)
    for depth in (0, 1, 2):
        keys, ends = (h, np.arange(len(h))) if not depth else suffix_tree._sequences(h, starts, depth)
        frames = list(suffix_tree._packs(depth, h, keys, ends, 40))
        size = [sum(map(len, f["parts"])) + sum(map(len, f["counts"])) for f in frames]
        assert max(size) < 10_000 + max(len(p) + len(c) for f in frames for p, c in zip(f["parts"], f["counts"]))
        assert depth == 0 or len(frames) > 1
        got = Counter()
        for row in (r for f in frames for r in f.itertuples()):
            parts = np.frombuffer(row.parts, np.uint64).reshape(depth + 1, -1).T
            assert (suffix_tree._range_of(suffix_tree._chain(parts), 40) == row.range).all()
            got.update(dict(zip(map(tuple, parts.tolist()), np.frombuffer(row.counts, np.int32).tolist(), strict=True)))
        assert got == Counter(tuple(h[e - depth:e + 1].tolist()) for e in ends)


def test_postings_of_a_range():
    keys, docs = np.array([9, 4, 9, 9, 4, 7], np.uint64), np.array([0, 0, 0, 2, 3, 3], np.int32)
    k, lengths, where, times = suffix_tree._postings(keys, docs)
    assert np.frombuffer(k, np.uint64).tolist() == [4, 7, 9]
    assert [np.frombuffer(x, np.int32).tolist() for x in (lengths, where, times)] == [[2, 1, 2], [0, 3, 3, 0, 2], [1, 1, 1, 2, 1]]


def test_postings_travel_in_few_bytes():
    """Steps of sorted keys have zeros in front and small numbers take a byte or two; what arrives is what was sent."""
    rng = np.random.default_rng(3)
    keys, docs = rng.integers(0, 2**63, 3000).astype(np.uint64) * np.uint64(2), np.sort(rng.integers(0, 1500, 9000)).astype(np.int32)
    keys[:2] = 0, 2**64 - 1
    own = keys[rng.integers(0, 3000, 9000)]
    for some in (slice(None), slice(0, 1), slice(0, 600)):
        plain = suffix_tree._postings(own[some], docs[some])
        sent = suffix_tree._sent(*plain)
        got = suffix_tree._received(*sent)
        assert [g.tolist() for g in got] == [np.frombuffer(b, t).tolist() for b, t in zip(plain, (np.uint64, *[np.int32] * 3))]
    assert sum(map(len, sent)) < 0.7 * sum(map(len, plain))
    big = suffix_tree._postings(np.array([5, 5], np.uint64), np.array([0, 70_000], np.int32))
    assert suffix_tree._received(*suffix_tree._sent(*big))[2].tolist() == [0, 70_000]
