"""The digest index across sessions, and documents kept by id and text."""

import uuid

import pytest

from ledgerloom.llm import exact_dedup, mixing, simhash
from ledgerloom.session import new_shared_path

SCHEMA = "doc_id long, text string"


def table(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture
def place(spark):
    return f"index_{uuid.uuid4().hex}", new_shared_path(spark, "index")


def ids(index):
    return sorted(r.keep_id for r in index.read().collect())


def test_a_session_that_lacks_the_entry_finds_the_index(spark, place):
    name, path = place
    first = exact_dedup.DigestIndex(spark, name, path, buckets=4)
    first.add(exact_dedup.digests(table(spark, [(i, f"text {i}") for i in range(10)])))
    spark.sql(f"DROP TABLE IF EXISTS {name}")  # a catalog without a metastore ends with its session
    second = exact_dedup.DigestIndex(spark, name, path, buckets=8)
    rows = [(100 + i, f"text {i}") for i in range(5)] + [(200 + i, f"new {i}") for i in range(5)]
    kept = exact_dedup.keep_first(table(spark, rows), second)
    assert sorted(r.doc_id for r in kept.collect()) == list(range(200, 205))
    assert ids(second) == [*range(10), *range(200, 205)] and second.buckets == 4
    plan = second.read().select("digest")._jdf.queryExecution().toString()
    assert "Bucketed: " in plan


def test_compacting_keeps_the_rows(spark, place, monkeypatch):
    name, path = place
    index = exact_dedup.DigestIndex(spark, name, path, buckets=2)
    for i in range(4):
        index.add(exact_dedup.digests(table(spark, [(j, f"t {j}") for j in range(10 * i, 10 * i + 10)])))
    assert len(index.read().inputFiles()) == 8
    index.compact()
    assert ids(index) == list(range(40)) and len(index.read().inputFiles()) == 2
    monkeypatch.setattr(exact_dedup, "MOST_APPENDS", 1)
    for i in range(2):
        index.add(exact_dedup.digests(table(spark, [(40 + i, f"t {40 + i}"), (0, "t 0")])))
    assert ids(index) == list(range(42)) and len(index.read().inputFiles()) in (3, 4)


def test_a_failed_batch_can_be_added_again(spark, place):
    name, path = place
    index = exact_dedup.DigestIndex(spark, name, path, buckets=2)
    batch = exact_dedup.digests(table(spark, [(1, "a"), (2, "b")]))
    index.add(batch)
    broken = exact_dedup.digests(table(spark, [(3, "c")]).selectExpr("doc_id", "raise_error('lost') AS text"))
    with pytest.raises(Exception, match="lost"):
        index.add(broken)
    index.add(batch)
    assert ids(index) == [1, 2]


def test_a_foreign_table_is_not_touched(spark, place):
    name, path = place
    table(spark, [(1, "a")]).write.saveAsTable(name)
    index = exact_dedup.DigestIndex(spark, name, path, buckets=2)
    with pytest.raises(ValueError, match="exists already"):
        exact_dedup.exact_dedup(table(spark, [(1, "a")]), index)
    assert spark.table(name).columns == ["doc_id", "text"]


def test_kept_by_id_and_text(spark):
    rows = [(3, "y"), (7, "x"), (7, "y"), (None, "a b"), (None, "a  b"), (9, "z"), (9, "z")]
    kept = exact_dedup.keep_first(table(spark, rows), exact_dedup.DigestIndex.fresh(spark, 2)).collect()
    found = sorted((r.doc_id or 0, " ".join(r.text.split())) for r in kept)
    assert found == [(0, "a b"), (3, "y"), (7, "x"), (9, "z")]


def test_texts_with_one_checksum_are_mixed_apart(spark):
    """Two texts under no id with the same CRC-32, each due one copy."""
    rows = [(None, "plumless", "s"), (None, "buckeroo", "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    mixed = mixing.mixed_documents(docs, budget=1.0)
    assert sorted(r.text for r in mixed.collect()) == ["buckeroo", "plumless"]


def test_many_repeats_of_a_row_are_counted_out(spark, monkeypatch):
    monkeypatch.setattr(mixing, "RUN_BITS", 2)
    docs = spark.createDataFrame([(1, "a b", "s")] * 23 + [(2, "c", "s")] * 4 + [(3, "d", None)], "doc_id long, text string, source string")
    rows = mixing.mix(docs, budget=1.0).collect()
    assert sorted(r.doc_id for r in rows) == [1] * 23 + [2] * 4 + [3]


NAMES = (
    "_kept _kept_id _id _copies _copy _crc _src _rows _times _source _class _prefix doc docs row_id row_md5 row_source row_digest rows copies "
    "digest text_md5 root fp component_id first_id size target source_size taken n unit state times group_size keep_id kept copy k"
).split()


def test_columns_with_any_name_stay(spark):
    long_text = " ".join(f"w{i}" for i in range(60))
    rows = [(1, long_text, "s"), (2, long_text + " ", "s"), (3, "other words", "t"), (3, "other words", "t"), (None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    wide = docs.selectExpr("*", *[f"'{name}' AS {name}" for name in NAMES])
    operators = {
        "simhash": simhash.keep_one,
        "mixing": lambda d: mixing.mixed_documents(d, budget=1.0),
        "exact": lambda d: exact_dedup.keep_first(d, exact_dedup.DigestIndex.fresh(spark, 2)),
    }
    for name, operator in operators.items():
        got, plain = operator(wide), operator(docs)
        assert got.columns == wide.columns, name
        found = got.collect()
        assert all(r[c] == c for r in found for c in NAMES), name
        assert sorted(map(str, plain.collect())) == sorted(str(r) for r in got.select(*docs.columns).collect()), name
