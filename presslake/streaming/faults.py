"""Streams of fetch events: windowed fault counts, exact dedup on the way in, and the pace of each host."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import faults


def windowed(events: DataFrame, window: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """window_start, kind, n, severity of events(at TIMESTAMP, kind, n); events later than `late` are dropped by the watermark."""
    counts = events.withWatermark("at", late).groupBy(F.window("at", window).alias("w"), "kind").agg(F.sum("n").alias("n"))
    return counts.select(F.col("w.start").alias("window_start"), "kind", "n", faults.severity(F.col("kind")).alias("severity"))


def first_seen(events: DataFrame, key: str = "url_hash", late: str = "1 hour") -> DataFrame:
    """Each key once within the watermark, so state doesn't grow with the stream."""
    return events.withWatermark("at", late).dropDuplicatesWithinWatermark([key])


def write_batches(stream: DataFrame, sink, checkpoint: str):
    """Each micro-batch goes to sink(DataFrame), all that is there once; the checkpoint folder makes it exactly-once for an idempotent sink."""
    return stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(lambda batch, _: sink(batch)).start()
