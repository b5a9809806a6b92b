import datetime
import random

import pytest

from doorstep import schemas
from doorstep.streaming import held

from conftest import rows_of

T0 = datetime.datetime(2026, 1, 1, 12, 0)
CHANGE = "boundary_change_set_changed"  # routed to one layer
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def at(minutes):
    return T0 + datetime.timedelta(minutes=minutes)


def events(*rows):
    """(minutes, content) as change events."""
    return [(i, at(m), CHANGE, c) for i, (m, c) in enumerate(rows)]


def plain(rows):
    """Requests of (ts, content) in order of time, by going through them."""
    found, seen, now = [], {}, None
    for ts, content in sorted(rows, key=lambda r: r[0]):
        repeat = content in seen and ts - seen[content] < held.HOLD
        seen[content] = ts
        if repeat:
            continue
        if now and ts < now[1] + held.HOLD:
            now[1], now[2] = ts, now[2] + 1
        else:
            now = [ts, ts, 1]
            found.append(now)
    return sorted((("boundary_reviews", a, b, b + held.HOLD, n) for a, b, n in found), key=repr)


CASES = {
    "one request across a border": [(4.983, "x"), (5.017, "y")],
    "a border of windows is none here": [(0, "x"), (4.983, "y"), (9.9, "z")],
    "exactly five minutes are two": [(0, "x"), (5, "y")],
    "a repeat does not hold back": [(0, "x"), (3, "x"), (6, "y")],
    "repeats across a border": [(4.9, "x"), (5.1, "x"), (9.9, "x"), (20, "x")],
    "null content repeats too": [(0, None), (1, None), (30, None)],
}


@pytest.mark.parametrize("case", CASES)
def test_table(spark, case):
    rows = events(*CASES[case])
    found = rows_of(held.held_requests(spark.createDataFrame(rows, schemas.CHANGE_EVENTS)))
    assert found == plain([(r[1], r[3]) for r in rows])


def test_table_of_many_events(spark):
    rng = random.Random(6)
    rows = events(*[(round(rng.uniform(0, 900), 3), rng.choice(["x", "x", "x", "y", "z", None])) for _ in range(600)])
    found = rows_of(held.held_requests(spark.createDataFrame(rows, schemas.CHANGE_EVENTS)))
    assert found == plain([(r[1], r[3]) for r in rows]) and len(found) > 20


def test_table_without_events(spark):
    assert held.held_requests(spark.createDataFrame([], schemas.CHANGE_EVENTS)).collect() == []
    other = [(1, at(0), "something_else", "x"), (2, None, CHANGE, "x"), (3, at(0), None, "x")]
    assert held.held_requests(spark.createDataFrame(other, schemas.CHANGE_EVENTS)).collect() == []


class Stream:
    """Runs a stream over files as they are added; each run stops and starts again."""

    def __init__(self, spark, folder):
        self.spark, self.folder = spark, folder

    def add(self, *rows):
        df = self.spark.createDataFrame(events(*rows), schemas.CHANGE_EVENTS)
        df.coalesce(1).write.mode("append").parquet(f"{self.folder}/in")
        source = (
            self.spark.readStream.schema(schemas.CHANGE_EVENTS).option("maxFilesPerTrigger", 1)
            .parquet(f"{self.folder}/in")
        )
        held.start_held_requests(
            source, f"{self.folder}/out", f"{self.folder}/check", {"availableNow": True}
        ).awaitTermination()
        return rows_of(self.spark.read.schema(held.REQUEST).parquet(f"{self.folder}/out"))


@pytest.fixture
def stream(spark, folder):
    former, parts = spark.conf.get(PROVIDER), spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set(PROVIDER, ROCKS)
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield Stream(spark, folder)
    spark.conf.set(PROVIDER, former)
    spark.conf.set("spark.sql.shuffle.partitions", parts)


def test_stream_with_restarts_and_late_events(stream):
    assert stream.add((4.983, "x")) == []
    # after a restart the held request is joined, and repeats are known
    assert stream.add((5.017, "y"), (5.1, "x")) == []
    # an event that comes late, but within the lateness, is joined as well
    assert stream.add((3, "z")) == []
    # the watermark passes 5.017 + 5 minutes: one request for all of them
    found = stream.add((30, "x"))
    assert found == [("boundary_reviews", at(3), at(5.017), at(10.017), 3)]
    # too late: left out
    assert stream.add((1, "q")) == found
    assert stream.add((60, "end")) == found + [("boundary_reviews", at(30), at(30), at(35), 1)]


def test_stream_equals_table(spark, stream):
    rng = random.Random(3)
    rows = sorted((round(rng.uniform(0, 120), 3), rng.choice("xxyz")) for _ in range(60))
    for k in range(0, 60, 30):
        stream.add(*rows[k : k + 30])
    found = stream.add((1000, "end"))
    assert found == plain([(at(m), c) for m, c in rows])
