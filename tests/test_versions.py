"""Versioned tables: writes that fail, run at the same time, or are read meanwhile."""

import threading
from datetime import date

import pytest
from pyspark.sql import functions as F

from ledgerloom.session import new_shared_path
from ledgerloom.sources import tables, versions

ONE, TWO = date(2024, 1, 1), date(2024, 1, 2)


@pytest.fixture
def path(spark):
    return new_shared_path(spark, "versioned")


@pytest.fixture
def rows(spark):
    return spark.range(10).select("id", (F.col("id") * 1.5).alias("v"))


def ids(df):
    return sorted(r["id"] for r in df.select("id").collect())


def test_a_failed_write_leaves_the_day_as_it_was(spark, path, rows):
    tables.write_run_table(rows, path, ONE)
    broken = rows.repartition(4, "id").withColumn("v", F.when(F.col("id") == 7, F.raise_error(F.lit("broken row")).cast("double")).otherwise(0.0))
    with pytest.raises(Exception, match="broken row"):
        tables.write_run_table(broken, path, ONE)
    assert ids(tables.read_run_table(spark, path, ONE)) == list(range(10))
    assert tables.read_run_table(spark, path, ONE).agg(F.sum("v")).first()[0] == 67.5
    assert versions.numbers(spark, path) == [1]


def test_a_reader_sees_one_version(spark, path, rows):
    tables.write_run_table(rows, path, ONE)
    before = tables.read_run_table(spark, path)
    tables.write_run_table(rows.where("id > 7"), path, ONE)
    tables.write_run_table(rows.where("id > 8"), path, TWO)
    assert ids(before) == list(range(10))  # read after both writes
    assert ids(tables.read_run_table(spark, path)) == [8, 9, 9]
    assert ids(tables.read_run_table(spark, path, ONE, version=1)) == list(range(10))
    assert ids(tables.read_run_table(spark, path, version=2)) == [8, 9]
    with pytest.raises(ValueError, match="no version 9"):
        tables.read_run_table(spark, path, version=9)
    assert tables.run_days(spark, path) == [ONE, TWO]


def test_writers_at_the_same_time_all_succeed(spark, path, rows):
    days = [date(2024, 2, d) for d in range(1, 9)]
    failed = []

    def write(day):
        try:
            tables.write_run_table(rows.where(F.col("id") < day.day), path, day)
        except Exception as error:
            failed.append(error)

    threads = [threading.Thread(target=write, args=(d,)) for d in days]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not failed
    assert versions.numbers(spark, path) == list(range(1, 9))
    counts = {r["run_date"]: r["count"] for r in tables.read_run_table(spark, path).groupBy("run_date").count().collect()}
    assert counts == {d: d.day for d in days}


def test_a_number_is_taken_once(spark, path, rows):
    tables.write_run_table(rows, path, ONE)
    assert not versions._create(spark, f"{path}/log/{1:020d}.json", "{}")
    assert ids(tables.read_run_table(spark, path)) == list(range(10))
    assert [n for n, _ in versions._names(spark, f"{path}/log")] == [f"{1:020d}.json"]  # no draft is left


def test_half_a_log_file_is_not_a_version(spark, path, rows, monkeypatch):
    tables.write_run_table(rows, path, ONE)
    monkeypatch.setattr(versions, "_create", lambda *a: (_ for _ in ()).throw(OSError("driver lost")))
    with pytest.raises(OSError):
        tables.write_run_table(rows.limit(0), path, ONE)
    monkeypatch.undo()
    assert ids(tables.read_run_table(spark, path, ONE)) == list(range(10))


def test_parts_of_a_day(spark, path, rows):
    tables.write_run_table(rows.where("id = 1"), path, ONE, part="raw")
    for _ in range(2):  # a rerun of the second step adds nothing twice
        tables.write_run_table(rows.where("id = 2").withColumn("more", F.lit("x")), path, ONE, part="clean")
    found = tables.read_run_table(spark, path, ONE)
    assert found.columns == ["id", "v", "more"]
    assert sorted((r["id"], r["more"]) for r in found.collect()) == [(1, None), (2, "x")]


def test_days_of_different_columns_and_no_rows(spark, path, rows):
    assert tables.write_run_table(rows.limit(0), path, ONE).columns == ["id", "v"]
    assert tables.read_run_table(spark, path, ONE).count() == 0
    tables.write_run_table(rows.select("id", F.lit("a").alias("name")), path, TWO)
    whole = tables.read_run_table(spark, path)
    assert whole.columns == ["id", "v", "name", "run_date"] and whole.count() == 10
    assert tables.read_run_table(spark, path, date(2030, 1, 1)).count() == 0  # a day that was never written
    with pytest.raises(ValueError, match="no version"):
        tables.read_run_table(spark, path + "-absent")
    versions.remove(spark, path, {"run_date": TWO.isoformat()})
    assert tables.read_run_table(spark, path).count() == 0


def test_key_values_survive(spark, path, rows):
    for name in ("a/b=c", "007", "ä %"):
        versions.put(rows.limit(1), path, {"run_date": "2024-01-01", "run_id": name})
    assert {r["run_id"] for r in versions.read(spark, path).collect()} == {"a/b=c", "007", "ä %"}
    with pytest.raises(ValueError, match="not NULL"):
        versions.put(rows, path, {"run_date": None})


def test_expire(spark, path, rows):
    for n in range(1, 6):
        tables.write_run_table(rows.where(F.col("id") < n), path, ONE)
    tables.write_run_table(rows, path, TWO)
    assert versions.expire(spark, path, keep=2) == 0  # all folders are young
    assert versions.numbers(spark, path) == [5, 6]
    assert versions.expire(spark, path, keep=1, older_than=-60) == 4
    assert tables.read_run_table(spark, path, ONE).count() == 5 and tables.read_run_table(spark, path, TWO).count() == 10


def test_a_folder_of_files_is_put_as_a_whole(spark, path, rows):
    def write(folder):
        rows.write.parquet(f"{folder}/a")
        rows.write.parquet(f"{folder}/b")

    def fail(folder):
        rows.write.parquet(f"{folder}/a")
        raise RuntimeError("half-way")

    key = {"run_date": "2024-01-01"}
    first = versions.put_folder(spark, path, key, write)
    with pytest.raises(RuntimeError):
        versions.put_folder(spark, path, key, fail)
    assert versions.folder_of(spark, path, key) == first
    with pytest.raises(ValueError):
        versions.folder_of(spark, path, {"run_date": "2024-01-02"})
