"""Which layers to rebuild, from a stream of change events.

An event names the layers it invalidates.  Events of one layer within the same five
minutes become one rebuild request; repeats of one content count once in it.
"""

from pyspark.sql import functions as F

# Event names and the layers each of them invalidates.
ROUTES = {
    "elections_set_changed": ["current_elections", "boundary_reviews"],
    "boundary_change_set_changed": ["boundary_reviews"],
}
WINDOW = "5 minutes"


def route_events(events):
    """One row per (event, layer); events that invalidate nothing are dropped."""
    layers = F.create_map(
        *[
            item
            for name, targets in ROUTES.items()
            for item in (F.lit(name), F.array(*[F.lit(t) for t in targets]))
        ]
    )
    return events.select(
        "ts",
        "content",
        F.explode(F.try_element_at(layers, F.col("event_type"))).alias("layer"),
    )


def rebuild_requests(events):
    """One row per layer and window: (layer, window_start, n_events, n_contents).

    Works on a batch and on a stream.  On a stream the windows close with a watermark
    of one window.  Counting per content first drops the repeats and, unlike keeping
    rows by key, is combined before the shuffle when one content dominates.
    """
    if events.isStreaming:
        events = events.withWatermark("ts", WINDOW)
    per_content = (
        route_events(events)
        .groupBy(F.window("ts", WINDOW), "layer", "content")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return (
        per_content.groupBy("window", "layer")
        .agg(F.sum("n").alias("n_events"), F.count(F.lit(1)).alias("n_contents"))
        .select(
            "layer", F.col("window.start").alias("window_start"), "n_events",
            "n_contents",
        )
    )


def start_rebuild_requests(events, path, checkpoint, trigger=None):
    """Write the requests of a stream of events to Parquet as their windows close."""
    return (
        rebuild_requests(events)
        .writeStream.outputMode("append")
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "1 minute"}))
        .start()
    )
