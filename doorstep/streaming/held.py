"""Rebuild requests that are held back until a layer's events have been quiet.

A layer's request goes out ``HOLD`` after its last event, so events that follow one
another within that time become one request, wherever five-minute borders lie.  An event
that repeats the content of one less than ``HOLD`` before it is dropped: it is not counted
and does not hold the request back any longer.

``held_requests`` answers for a table, ``start_held_requests`` for a stream, with state per
layer: the request being held, and when each content was last seen.  A timer per layer
sends the request, and another forgets contents that are out of date, so the state does
not grow.
"""

import datetime

from pyspark.sql import Row, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from .triggers import route_events

HOLD = datetime.timedelta(minutes=5)
_HOLD = HOLD.total_seconds()
_MICROS = int(_HOLD * 1_000_000)
REQUEST = "layer string, first_ts timestamp, last_ts timestamp, requested_at timestamp, n_events long"


def held_requests(events):
    """One row per request of a table of events.

    Events of one content within five minutes' border count as one from the start, since
    only the first of them can be no repeat; so a content, or a layer, that holds most of
    the events brings at most a row per five minutes to the windows over it.
    """
    hold = F.expr(f"INTERVAL {int(_HOLD)} SECONDS")
    slot = F.floor(F.unix_timestamp("ts") / int(_HOLD))
    routed = route_events(events.where(F.col("ts").isNotNull()))
    per_slot = routed.groupBy("layer", "content", slot.alias("slot")).agg(
        F.min("ts").alias("first"), F.max("ts").alias("last")
    )
    before = Window.partitionBy("layer", "content").orderBy("slot")
    fresh = F.coalesce(F.col("first") >= F.lag("last").over(before) + hold, F.lit(True))
    accepted = per_slot.withColumn("fresh", fresh).where("fresh").groupBy("layer", "slot").agg(
        F.min("first").alias("first"), F.max("first").alias("last"), F.count(F.lit(1)).alias("n_events")
    )
    order = Window.partitionBy("layer").orderBy("slot")
    so_far = order.rowsBetween(Window.unboundedPreceding, -1)
    earlier = F.max("last").over(so_far)
    # a slot holds one request at most: events in it are less than HOLD apart
    begins = F.coalesce(F.col("first") >= earlier + hold, F.lit(True))
    numbered = accepted.withColumn("_begins", begins.cast("int"))
    numbered = numbered.withColumn(
        "_request", F.sum("_begins").over(order.rowsBetween(Window.unboundedPreceding, 0))
    )
    return numbered.groupBy("layer", "_request").agg(
        F.min("first").alias("first_ts"), F.max("last").alias("last_ts"),
        (F.max("last") + hold).alias("requested_at"),
        F.sum("n_events").alias("n_events"),
    ).drop("_request")


class HoldBack(StatefulProcessor):
    """Events of a layer to its requests; all times are event times in microseconds."""

    def init(self, handle):
        self.handle = handle
        self.held = handle.getValueState("held", "first long, last long, n long")
        self.seen = handle.getMapState("seen", "content string", "at long")

    def handleInputRows(self, key, rows, timerValues):
        # rows of a micro-batch come in any order
        for row in sorted(rows, key=lambda r: r.at):
            request = self._add(key[0], row.at, row.content)
            if request is not None:
                yield request
        self._set_timers()

    def _add(self, layer, at, content):
        """Take an event in; the former request, if this event comes too late for it."""
        last = self.seen.getValue((content,))[0] if self.seen.containsKey((content,)) else None
        if last is None or at > last:
            self.seen.updateValue((content,), (at,))
        if last is not None and abs(at - last) < _MICROS:
            return None
        if not self.held.exists():
            self.held.update((at, at, 1))
            return None
        first, until, n = self.held.get()
        if at >= until + _MICROS:
            self.held.update((at, at, 1))
            return _request(layer, first, until, n)
        if at <= first - _MICROS:
            # an event before the request that is held: its own is due already
            return _request(layer, at, at, 1)
        self.held.update((min(first, at), max(until, at), n + 1))
        return None

    def _set_timers(self):
        for at in list(self.handle.listTimers()):
            self.handle.deleteTimer(at)
        due = [self.held.get()[1]] if self.held.exists() else []
        due += [at[0] for _, at in self.seen.iterator()]
        if due:
            self.handle.registerTimer((min(due) + _MICROS) // 1000)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        now = expiredTimerInfo.getExpiryTimeInMs()
        if self.held.exists() and (self.held.get()[1] + _MICROS) // 1000 <= now:
            held = self.held.get()
            self.held.clear()
            yield _request(key[0], *held)
        for content, at in list(self.seen.iterator()):
            if (at[0] + _MICROS) // 1000 <= now:
                self.seen.removeKey(content)
        self._set_timers()

    def close(self):
        pass


_RAW = "layer string, first long, last long, n_events long"


def _request(layer, first, last, n):
    return Row(layer=layer, first=first, last=last, n_events=n)


def held_stream(events, lateness="5 minutes"):
    """The requests of a stream; events later than ``lateness`` are left out.

    Needs the state store that has timers:
    ``spark.sql.streaming.stateStore.providerClass`` set to Spark's RocksDB provider.
    """
    routed = route_events(events.where(F.col("ts").isNotNull())).withWatermark("ts", lateness)
    requests = routed.withColumn("at", F.unix_micros("ts")).groupBy("layer").transformWithState(
        statefulProcessor=HoldBack(), outputStructType=_RAW, outputMode="append", timeMode="eventTime"
    )
    return requests.select(
        "layer", F.timestamp_micros("first").alias("first_ts"), F.timestamp_micros("last").alias("last_ts"),
        F.timestamp_micros(F.col("last") + _MICROS).alias("requested_at"), "n_events",
    )


def start_held_requests(events, path, checkpoint, trigger=None, lateness="5 minutes"):
    """Write the requests of a stream of events to Parquet as they become due."""
    return (
        held_stream(events, lateness)
        .writeStream.outputMode("append")
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "1 minute"}))
        .start()
    )
