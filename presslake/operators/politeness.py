"""Pacing over a log of fetches: latency medians, the adaptive delay of each host, and a check of the gaps kept."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

# ---- fixed values: the rules of pacing
DELAY_S, DELAY_MAX_S, SLOW_MAX_S, SLOW_FACTOR, WAIT_MAX_S, REFUSALS, COOLDOWN_S = 5.0, 300.0, 120.0, 2.0, 3600.0, 5, 3600.0
# ---- end of fixed values


def rolling_median(log: DataFrame) -> DataFrame:
    """p50: upper median of a domain's last 20 latencies, once there are 5."""
    last = F.collect_list("elapsed_s").over(Window.partitionBy("domain").orderBy("at", "url").rowsBetween(-19, 0))
    ordered = F.sort_array(last)
    return log.withColumn("p50", F.when(F.size(ordered) >= 5, F.element_at(ordered, F.floor(F.size(ordered) / 2).cast("int") + 1)))


class Pace:
    """State of one host; step() is the whole rule."""

    def __init__(self) -> None:
        self.delay, self.failures, self.blocked, self.latencies = DELAY_S, 0, None, []

    def step(self, at: float, status: int | None, wall: str | None, retry_after: float | None, elapsed: float | None, cached: bool) -> None:
        status = status or 0
        if status in (429, 503):
            self.blocked = at + min(60.0 if retry_after is None else max(0.0, retry_after), WAIT_MAX_S)
            self.delay, self.failures = min(self.delay * 2, DELAY_MAX_S), self.failures + 1
        elif status == 403 or wall:
            self.delay, self.failures = min(self.delay * 2, DELAY_MAX_S), self.failures + 1
            if self.failures >= REFUSALS:
                self.blocked = at + COOLDOWN_S
        elif 200 <= status < 300 or cached:
            self.failures = 0
            known = sorted(self.latencies)
            p50 = known[len(known) // 2] if len(known) >= 5 else None
            if p50 and elapsed is not None and elapsed > p50 * SLOW_FACTOR:
                self.delay = min(self.delay * 2, SLOW_MAX_S)
            elif self.delay > DELAY_S:
                self.delay = max(DELAY_S, self.delay - 1.0)
        if elapsed is not None and status:
            self.latencies = [*self.latencies, elapsed][-20:]


PACED = pa.schema([("domain", pa.string()), ("event", pa.string()), ("delay_s", pa.float64()), ("failures", pa.int32()), ("blocked_until", pa.float64())])


def paced(log: DataFrame) -> DataFrame:
    """domain, event, delay_s, failures, blocked_until after each fetch of log(domain, event, at_s, status, wall, retry_after_s, elapsed_s, from_cache).

    Rows are dealt by domain and sorted by time; one pass keeps one host's state, so a domain of any length needs no more memory.
    """
    columns = ["domain", "event", "at_s", "status", "wall", "retry_after_s", "elapsed_s", "from_cache"]
    rows = log.where("domain IS NOT NULL").select(*columns).repartition("domain").sortWithinPartitions("domain", "at_s", "event")

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        host, state = None, Pace()
        for batch in batches:
            out = []
            for domain, event, at, status, wall, retry, elapsed, cached in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if domain != host:
                    host, state = domain, Pace()
                state.step(at, status, wall, retry, elapsed, bool(cached))
                out.append((domain, event, state.delay, state.failures, state.blocked))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*out, strict=True), PACED, strict=True)], schema=PACED)

    return rows.mapInArrow(fold, from_arrow_schema(PACED))


def gaps(log: DataFrame) -> DataFrame:
    """log(domain, arrived_at, finished_at) with the gap since the last fetch finished, and whether it overlaps it."""
    w = Window.partitionBy("domain").orderBy("arrived_at", "finished_at")
    before = F.max("finished_at").over(w.rowsBetween(Window.unboundedPreceding, -1))
    return log.withColumn("gap_s", F.col("arrived_at") - before).withColumn("overlaps", F.coalesce(F.col("arrived_at") < before, F.lit(False)))


def schedule(requests: DataFrame, delay: str = "delay_s", jitter: float = 0.3) -> DataFrame:
    """Earliest start of each request(domain, seq, delay_s): the delays before it, each off by up to 30 % by the hash of its place."""
    noise = 1 + jitter * (F.pmod(F.xxhash64("domain", "seq"), F.lit(2001)) / 1000.0 - 1)
    w = Window.partitionBy("domain").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    return requests.withColumn("starts_at", F.coalesce(F.sum(F.col(delay) * noise).over(w), F.lit(0.0)))


def resolver_alarm(log: DataFrame, above: float = 0.25) -> DataFrame:
    failed = F.count_if(F.coalesce(F.col("error").startswith("DNSError"), F.lit(False)))
    return log.agg(F.count("*").alias("attempted"), failed.alias("failed")).withColumn("alarm", F.col("failed") > above * F.col("attempted"))
