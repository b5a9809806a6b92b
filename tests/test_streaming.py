import datetime

from doorstep import schemas
from doorstep.streaming import triggers

from conftest import rows_of

T0 = datetime.datetime(2026, 1, 1, 12, 0)


def at(minutes):
    return T0 + datetime.timedelta(minutes=minutes)


EVENTS = [
    (1, at(0), "elections_set_changed", "x"),
    (2, at(1), "elections_set_changed", "x"),
    (3, at(2), "boundary_change_set_changed", "y"),
    (4, at(4.9), "elections_set_changed", "z"),
    (5, at(5), "elections_set_changed", "x"),
    (6, at(21), "boundary_change_set_changed", None),
    (7, at(22), "something_else", "x"),
    (8, at(23), None, "x"),
]
EXPECTED = [
    ("boundary_reviews", at(0), 4, 3),
    ("boundary_reviews", at(5), 1, 1),
    ("boundary_reviews", at(20), 1, 1),
    ("current_elections", at(0), 3, 2),
    ("current_elections", at(5), 1, 1),
]


def test_batch(spark):
    events = spark.createDataFrame(EVENTS, schemas.CHANGE_EVENTS)
    assert rows_of(triggers.rebuild_requests(events)) == sorted(EXPECTED, key=repr)


def test_stream_equals_batch(spark, folder):
    # The last event only moves the watermark past the others' windows.
    later = (99, at(600), "something_else", "end")
    for i, part in enumerate((EVENTS[:3], EVENTS[3:6], EVENTS[6:] + [later])):
        spark.createDataFrame(part, schemas.CHANGE_EVENTS).coalesce(1).write.mode(
            "append"
        ).parquet(f"{folder}/in")
    events = (
        spark.readStream.schema(schemas.CHANGE_EVENTS)
        .option("maxFilesPerTrigger", 1)
        .parquet(f"{folder}/in")
    )
    query = triggers.start_rebuild_requests(
        events, f"{folder}/out", f"{folder}/check", {"availableNow": True}
    )
    query.awaitTermination()
    assert rows_of(spark.read.parquet(f"{folder}/out")) == sorted(EXPECTED, key=repr)
