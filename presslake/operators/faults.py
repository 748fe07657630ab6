"""Faults: aggregates of a run, ranked by breadth and ownership."""

from __future__ import annotations

import json
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import KEEP_RUNS, NOTABLE_AT, NOT_FAILURES, OWNER, OWNER_WEIGHT, OWNERS, SEVERITY, URGENT_AT
from .columns import lookup


def severity(kind: Column) -> Column:
    """0 to 3; a kind that isn't mapped is loud."""
    return lookup(kind, SEVERITY, 3)


def owner(kind: Column) -> Column:
    """us, site or policy; a kind that isn't mapped is ours. Access verdicts may be asked for too."""
    return lookup(kind, OWNER, "us")


def attention(kind: Column, domains: Column) -> Column:
    """Severity times breadth times whose problem it is; occurrences never multiply."""
    return severity(kind) * domains * lookup(owner(kind), OWNER_WEIGHT, 1.0)


def band(score: Column) -> Column:
    return F.when(score >= URGENT_AT, "urgent").when(score >= NOTABLE_AT, "notable").otherwise("minor")


def record(occurrences: DataFrame) -> DataFrame:
    """One row per (run_id, kind, domain) of occurrences(run_id, kind, domain, a_id, n, at, url, detail): n added up, the first sample kept.

    Counts merge map-side, so a kind with most of the rows costs no skewed shuffle.
    """
    first = F.min_by(F.struct("a_id", "url", "detail"), F.struct("at", "url", "detail"))
    out = occurrences.groupBy("run_id", "kind", "domain").agg(F.sum("n").alias("n"), F.min("at").alias("first_at"), F.max("at").alias("last_at"), first.alias("_s"))
    return out.select("run_id", "kind", "domain", F.col("_s.a_id").alias("a_id"), "n", "first_at", "last_at", F.col("_s.url").alias("sample_url"), F.col("_s.detail").alias("sample_detail"))


def add(stored: DataFrame, new: DataFrame) -> DataFrame:
    """Upsert of recorded rows: counts add up, the earlier sample stays."""
    first = F.min_by(F.struct("a_id", "sample_url", "sample_detail"), F.struct("first_at", "sample_url"))
    both = stored.unionByName(new).groupBy("run_id", "kind", "domain").agg(F.sum("n").alias("n"), F.min("first_at").alias("first_at"), F.max("last_at").alias("last_at"), first.alias("_s"))
    return both.select("run_id", "kind", "domain", "_s.a_id", "n", "first_at", "last_at", "_s.sample_url", "_s.sample_detail")


def rows(faults: DataFrame, run_id: str | None = None, kind: str | None = None, domain: str | None = None, by: str | None = None) -> DataFrame:
    """Faults with derived severity and owner, filtered; filters on stored columns reach the scan."""
    for column, value in (("run_id", run_id), ("kind", kind), ("domain", domain)):
        if value is not None:
            faults = faults.where(F.col(column) == value)
    out = faults.withColumn("severity", severity(F.col("kind"))).withColumn("owner", owner(F.col("kind")))
    return out.where(F.col("owner") == by) if by is not None else out


def tally(faults: DataFrame, policy: bool = True, listed: int = 1000) -> DataFrame:
    """One ranked row per kind: its domains (sorted, the first `listed`; tally_domains has them all), breadth, occurrences, first sample, score
    and band. Score first, then occurrences, then name.
    """
    sample = F.min_by(F.struct("sample_url", "sample_detail"), F.when(F.col("sample_detail").isNotNull(), F.struct("first_at", "domain", "run_id")))
    out = faults.groupBy("kind").agg(F.count_distinct("domain").alias("breadth"), F.sum("n").alias("occurrences"), sample.alias("_s"))
    nth = F.row_number().over(Window.partitionBy("kind").orderBy("domain"))  # a limit that works before the shuffle
    first = tally_domains(faults).select("kind", "domain").withColumn("_n", nth).where(F.col("_n") <= listed)
    out = out.join(first.groupBy("kind").agg(F.sort_array(F.collect_list("domain")).alias("domains")), "kind")
    out = out.withColumn("score", attention(F.col("kind"), F.col("breadth"))).withColumn("severity", severity(F.col("kind"))).withColumn("owner", owner(F.col("kind")))
    out = out.withColumn("band", band(F.col("score"))).select("kind", "domains", "breadth", "occurrences", "severity", "owner", "score", "band", "_s.sample_url", "_s.sample_detail")
    out = out if policy else out.where(F.col("owner") != "policy")
    return out.orderBy(F.desc("score"), F.desc("occurrences"), "kind")


def tally_domains(faults: DataFrame) -> DataFrame:
    """kind, domain, occurrences: the domains of each kind as rows, as many as there are."""
    return faults.groupBy("kind", "domain").agg(F.sum("n").alias("occurrences"))


def summarise(faults: DataFrame) -> DataFrame:
    """One row: kinds, domains, occurrences and the occurrences of each owner, none of them missing."""
    own = owner(F.col("kind"))
    return faults.agg(
        F.count_distinct("kind").alias("kinds"),
        F.count_distinct("domain").alias("domains"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("occurrences"),
        *[F.coalesce(F.sum(F.when(own == o, F.col("n"))), F.lit(0)).alias(o) for o in OWNERS],
    )


def worst_domains(faults: DataFrame, limit: int = 10) -> DataFrame:
    """domain, score, kinds: severity summed over different kinds, policy and successes aside; the report's top rows."""
    kinds = faults.where((owner(F.col("kind")) != "policy") & ~F.col("kind").isin(*NOT_FAILURES)).select("domain", "kind").distinct()
    out = kinds.groupBy("domain").agg(F.sum(severity(F.col("kind"))).alias("score"), F.sort_array(F.collect_set("kind")).alias("kinds"))  # kinds are a closed vocabulary
    return out.orderBy(F.desc("score"), "domain").limit(limit)


def worst_for_agency(faults: DataFrame) -> DataFrame:
    """a_id, fault_kind, fault_detail: the severest, ours before others, the earliest of equals."""
    ours = (owner(F.col("kind")) == "us").cast("int")
    key = F.struct((-severity(F.col("kind"))).alias("s"), (-ours).alias("o"), F.col("first_at"), F.col("run_id"), F.col("kind"), F.col("domain"))
    best = F.min_by(F.struct("kind", F.coalesce("sample_detail", F.lit("")).alias("detail")), key)
    return faults.where("a_id IS NOT NULL").groupBy("a_id").agg(best.alias("_b")).select("a_id", F.col("_b.kind").alias("fault_kind"), F.col("_b.detail").alias("fault_detail"))


def newest_runs(runs: DataFrame, keep: int = KEEP_RUNS) -> DataFrame:
    return runs.orderBy(F.desc("started_at"), F.desc("run_id")).limit(keep)


def prune(faults: DataFrame, runs: DataFrame, keep: int = KEEP_RUNS) -> tuple[DataFrame, DataFrame]:
    """Both tables without all but the newest runs."""
    kept = newest_runs(runs, keep).select("run_id")
    return faults.join(kept, "run_id", "left_semi"), runs.join(kept, "run_id", "left_semi")


def published(faults: DataFrame, run_id: str) -> DataFrame:
    """The table the website reads: the ranked kinds of one run, numbered."""
    ranked = tally(faults.where(F.col("run_id") == run_id))
    order = Window.orderBy(F.desc("score"), F.desc("occurrences"), "kind")  # over kinds, a closed vocabulary
    return ranked.withColumn("position", F.row_number().over(order)).withColumn("run_id", F.lit(run_id)).withColumn("domains", F.array_join("domains", ","))


# ---- runs
def start_run(runs: DataFrame, run_id: str, started_at: datetime, command: str, scope: str | None = None) -> DataFrame:
    """runs with a row for the run, in place of one of the same id."""
    new = runs.sparkSession.createDataFrame([(run_id, started_at, command, scope)], "run_id string, started_at timestamp_ntz, command string, scope string")
    return runs.where(F.col("run_id") != run_id).unionByName(new, allowMissingColumns=True)


def finish_run(runs: DataFrame, run_id: str, ended_at: datetime, domains: int = 0, targets: int = 0, stats: dict | None = None) -> DataFrame:
    """runs with the outcome of one noted; a run that was never started isn't added."""
    own = F.col("run_id") == run_id
    said = None if stats is None else json.dumps(stats)
    new = {"ended_at": F.lit(ended_at), "domains": F.lit(domains), "targets": F.lit(targets), "stats_json": F.lit(said).cast("string")}
    return runs.withColumns({c: F.when(own, v.cast(dict(runs.dtypes)[c])).otherwise(F.col(c)) for c, v in new.items()})


def new_run_id(now: datetime) -> str:
    return now.strftime("%Y%m%d-%H%M%S")


def run(runs: DataFrame, run_id: str) -> DataFrame:
    """The one row of a run, or none."""
    return runs.where(F.col("run_id") == run_id).limit(1)


def of_kind(published_rows: DataFrame, kind: str) -> DataFrame:
    """The published row of one kind, or none."""
    return published_rows.where(F.col("kind") == kind).limit(1)


def recent(faults: DataFrame, runs: DataFrame, newest: int = 1, **filters) -> DataFrame:
    """Faults of the newest runs, filtered and ordered as a reader sees them."""
    kept = newest_runs(runs, newest).select("run_id")
    return rows(faults.join(kept, "run_id", "left_semi"), **filters).orderBy("kind", "domain", "run_id")
