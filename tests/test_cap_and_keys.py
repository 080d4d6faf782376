"""Run-time caps of extracts, keys found in records, sketches of distinct values."""

import json
import random
import threading
import time
from datetime import date

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import sketches
from ledgerloom.session import new_shared_path
from ledgerloom.sources import files, sql
from ledgerloom.sources.cap import CappedDataFrame, time_cap

# About half a minute of work, so a cap that does not work fails the test and does not hold it up.
SLOW = "SELECT sum(a.id * b.id % 7) AS s FROM range(0, 300000, 1, 40) a JOIN range(0, 300000, 1, 4) b ON a.id % 20 = b.id % 20"


def test_a_query_over_its_cap_is_ended_and_others_go_on(spark):
    slow = sql.extract_sql(spark, SLOW, max_seconds=1)
    assert slow.columns == ["s"]  # analysis is not capped
    others = []

    def other():
        others.append(spark.range(30, numPartitions=2).select(F.sum("id")).first()[0])

    thread = threading.Thread(target=other)
    started = time.time()
    thread.start()
    with pytest.raises(TimeoutError, match="cap of 1 s"):
        slow.collect()
    thread.join()
    assert time.time() - started < 15 and others == [435]
    assert not [t for t in spark.sparkContext.getJobTags() if t.startswith("cap-")]
    assert spark.range(5).count() == 5


def test_the_cap_follows_the_frame(spark, tmp_path):
    slow = sql.extract_sql(spark, SLOW, max_seconds=1)
    with pytest.raises(TimeoutError):
        slow.select((F.col("s") + 1).alias("s")).where("s > 0").write.mode("overwrite").parquet(str(tmp_path / "out"))
    quick = sql.extract_sql(spark, "SELECT id, double('NaN') AS v FROM range(10)", max_seconds=60)
    assert isinstance(quick.groupBy("id").count(), object) and isinstance(quick.limit(3), CappedDataFrame)
    assert quick.count() == 10 and quick.agg(F.count("v")).first()[0] == 0
    quick.write.mode("overwrite").partitionBy("id").parquet(str(tmp_path / "quick"))
    assert spark.read.parquet(str(tmp_path / "quick")).count() == 10
    assert quick.join(spark.range(5), "id").count() == 5 and len(quick.toPandas()) == 10
    assert not isinstance(sql.extract_sql(spark, "SELECT 1 AS one", max_seconds=None), CappedDataFrame)


def test_an_error_of_the_query_stays_itself(spark):
    with pytest.raises(Exception, match="(?i)divi"):
        sql.extract_sql(spark, "SELECT 1 / (id - id) AS x FROM range(3)", max_seconds=60).collect()
    with pytest.raises(KeyError), time_cap(spark, 60):
        raise KeyError("own")


def records(path, rows):
    path.write_text("\n".join(rows))
    return str(path)


def test_keys_are_the_union_over_all_records(spark, tmp_path):
    rows = [
        {"id": 1, "amount": 2, "tags": ["a"], "who": {"x": 1}}, {"id": 2, "amount": 2.5, "mixed": 1, "gone": None},
        {"id": 3, "mixed": "one", "flag": True, "odd key.x": 7, "nested": [[1]]}, {"amount": None, "mixed": False, "numbers": [1, 2.5]}, {},
    ]
    path = records(tmp_path / "r.json", [json.dumps(r) for r in rows] + [""])
    found = files.records_to_frame(spark, path)
    assert dict(found.dtypes) == {
        "amount": "double", "flag": "boolean", "gone": "string", "id": "bigint", "mixed": "string", "nested": "string",
        "numbers": "array<double>", "odd key.x": "bigint", "tags": "array<string>", "who": "string",
    }
    assert found.columns == sorted(found.columns)
    got = sorted((r.asDict() for r in found.collect()), key=lambda r: (r["id"] is None, r["id"] or 0, r["amount"] is None, r["mixed"] or ""))
    assert [r["id"] for r in got] == [1, 2, 3, None, None]
    assert [r["amount"] for r in got] == [2.0, 2.5, None, None, None]
    assert json.loads(got[0]["who"]) == {"x": 1} and got[0]["tags"] == ["a"] and got[2]["odd key.x"] == 7 and got[2]["nested"] == "[[1]]"
    assert [r["mixed"] for r in got][1:3] == ["1", "one"] and {r["mixed"] for r in got[3:]} == {None, "false"}


@pytest.mark.parametrize("line, message", [("[1, 2]", "no object"), ("{\"a\": ", "(?i)malformed|parse"), ("7", "no object")])
def test_what_is_no_record_raises(spark, tmp_path, line, message):
    with pytest.raises(Exception, match=message):
        files.records_to_frame(spark, records(tmp_path / "r.json", ['{"a": 1}', line])).collect()


def test_no_records(spark, tmp_path):
    with pytest.raises(ValueError, match="no keys"):
        files.records_to_frame(spark, records(tmp_path / "r.json", [""]))


def test_sketches_of_days_equal_one_sketch(spark):
    rng = random.Random(1)
    rows = [(rng.choice("ab"), rng.choice([None, rng.randrange(20_000)]), rng.randrange(50), i % 4) for i in range(30_000)]
    df = spark.createDataFrame(rows, "g string, big long, small long, day int")
    path, columns = new_shared_path(spark, "sketches"), ["big", "small"]
    for i in range(4):
        for _ in range(2 if i == 1 else 1):  # a rerun
            sketches.write_day_sketches(spark, path, date(2024, 1, i + 1), df.where(F.col("day") == i), ["g"], columns)
    merged = {r["g"]: r for r in sketches.distinct_over_days(spark, path, date(2024, 1, 1), date(2024, 1, 4), ["g"], columns).collect()}
    whole = {r["g"]: r for r in sketches.estimates(sketches.distinct_sketches(df, ["g"], columns), columns).collect()}
    for g in "ab":
        exact = len({r[1] for r in rows if r[0] == g and r[1] is not None})
        assert abs(merged[g]["big"] - exact) <= sketches.error_bound() * exact
        assert merged[g]["small"] == 50
        assert abs(merged[g]["big"] - whole[g]["big"]) <= sketches.error_bound() * exact
    first = sketches.distinct_over_days(spark, path, date(2024, 1, 1), date(2024, 1, 1), ["g"], columns).where("g = 'a'").first()
    assert first["big"] < merged["a"]["big"]
    assert 0.048 < sketches.error_bound() < 0.05
    with pytest.raises(ValueError, match="no day"):
        sketches.distinct_over_days(spark, path, date(2025, 1, 1), date(2025, 1, 4), ["g"], columns)
