"""Arriving files with a ledger."""

import pytest
from pyspark.sql.types import StructType

from ledgerloom.session import new_shared_path
from ledgerloom.streaming import ledger

SCHEMA = "id long, v double"


def send(spark, folder, rows, schema=SCHEMA, part=1):
    spark.createDataFrame(rows, schema).coalesce(part).write.mode("append").parquet(folder)


@pytest.fixture
def places(spark):
    return tuple(new_shared_path(spark, n) for n in ("in", "out", "state"))


def take(spark, places, state=None, **more):
    folder, root, first = places
    ledger.take_arrivals(spark, folder, SCHEMA, root, state or first, **more).awaitTermination()
    taken = sorted(map(tuple, ledger.taken_rows(spark, root).collect()))
    return taken, sorted(r.status for r in ledger.ledger(spark, root).collect())


def test_a_file_sent_again_adds_no_row(spark, places):
    send(spark, places[0], [(1, 1.0), (2, float("nan"))])
    rows = [(1, 1.0), (2, None)]
    assert take(spark, places) == (rows, ["taken"])
    send(spark, places[0], [(2, float("nan")), (1, 1.0)])  # another name and order
    assert take(spark, places) == (rows, ["repeat", "taken"])
    send(spark, places[0], [(3, 3.0)])
    send(spark, places[0], [(3, 3.0)])  # twice within a batch
    assert take(spark, places) == ([*rows, (3, 3.0)], ["repeat", "repeat", "taken", "taken"])


def test_rows_that_repeat_within_a_file_stay(spark, places):
    send(spark, places[0], [(1, 1.0)] * 3)
    send(spark, places[0], [(1, 1.0)])
    assert take(spark, places) == ([(1, 1.0)] * 4, ["taken", "taken"])


def test_a_bad_file_is_listed_and_the_stream_goes_on(spark, places):
    send(spark, places[0], [(1, "x")], "id long, v string")
    send(spark, places[0], [(1, 1.0, 2)], "id long, v double, more int")
    send(spark, places[0], [(1,)], "id long")
    send(spark, places[0], [(1.5, 1)], "v double, id long")  # another order only
    spark.createDataFrame([("no table",)], "value string").coalesce(1).write.mode("append").text(places[0])
    taken, status = take(spark, places, pattern="part-*", files_per_batch=2)
    assert taken == [(1, 1.5)] and status == ["rejected"] * 4 + ["taken"]
    reasons = sorted(r.reason.split(":")[0] for r in ledger.ledger(spark, places[1], "rejected").collect())
    assert reasons == ["more not expected", "not readable", "v missing", "v string instead of double"]


def test_a_replayed_batch_adds_no_row(spark, places):
    folder, root, _ = places
    send(spark, folder, [(1, 1.0)])
    notices = spark.read.format("binaryFile").load(folder).selectExpr("path", "_metadata.file_path AS file", "length")
    wanted = StructType.fromDDL(SCHEMA)
    for _ in range(2):
        ledger.take_batch(notices, "s", 0, root, wanted)
    assert [tuple(r) for r in ledger.taken_rows(spark, root).collect()] == [(1, 1.0)]
    assert [r.status for r in ledger.ledger(spark, root).collect()] == ["taken"]


def test_a_stream_that_lost_its_checkpoint_adds_no_row(spark, places):
    send(spark, places[0], [(1, 1.0)])
    send(spark, places[0], [], part=1)
    take(spark, places)
    taken, _ = take(spark, places, state=new_shared_path(spark, "state"))
    assert taken == [(1, 1.0)]
