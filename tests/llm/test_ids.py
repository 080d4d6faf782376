"""Verdicts on rows whose ids are NULL or repeat."""

import random

from ledgerloom.llm import decontaminate, simhash

SCHEMA = "doc_id long, text string, tag string"


def made(seed, n=60):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))


def test_clean_rows_beside_contaminated_ones(spark):
    leak = made(1, 20)
    benchmark = spark.createDataFrame([(1, leak)], "item_id long, text string")
    rows = [(None, made(2) + " " + leak, "bad"), (None, made(3), "good"), (7, made(4) + " " + leak, "bad"), (7, made(5), "good"), (8, None, "good")]
    docs = spark.createDataFrame(rows, SCHEMA)
    left = decontaminate.drop_contaminated(docs, benchmark).collect()
    assert sorted(r.text or "" for r in left) == sorted(r[1] or "" for r in rows if r[2] == "good")
    assert sorted(r.n_hit for r in decontaminate.contamination(docs, benchmark).collect()) == [0, 0, 0, 20, 20]
    cut = [r.text for r in decontaminate.cut_contaminated(docs, benchmark).collect()]
    assert sorted(cut) == sorted([made(2), made(3), made(4), made(5), ""])


def test_one_of_each_group_stays(spark):
    near = made(6, 200)
    rows = [(None, near, "a"), (None, near + " ", "b"), (None, made(7), "c"), (3, made(8), "d"), (4, made(8) + " ", "e"), (None, made(8), "f")]
    rows += [(9, made(10), "g"), (9, made(11), "h"), (9, made(11), "h"), (9, made(11) + "\t", "i")]
    kept = simhash.keep_one(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(" ".join(r.text.split()) for r in kept) == sorted([near, made(7), made(8), made(10), made(11)])
    assert [r.tag for r in kept if r.text == made(8)] == ["d"]


def test_capital_sigma(spark):
    """Its lower case depends on what follows, beyond the word."""
    text = " ".join(f"ΟΔΟΣ{c}Α{i} ΛΟΓΟΣ.Β" for i, c in enumerate("'.:’'.':.'"))
    table = spark.createDataFrame([(1, text)], "doc_id long, text string")
    benchmark = table.withColumnRenamed("doc_id", "item_id")
    assert decontaminate.drop_contaminated(table, benchmark).isEmpty()
