"""The frontier: which domains are due, leases, and what a pass leaves behind. State in, state out."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.responses import backoff_seconds

EPOCH = datetime(1970, 1, 1)


def _after(now: datetime, seconds: Column) -> Column:
    return (F.lit(now).cast("timestamp") + F.make_interval(secs=seconds.cast("decimal(18,6)"))).cast("timestamp_ntz")


def is_due(now: datetime, scheduled: bool = True) -> Column:
    """Enabled, free of a lease and, with the schedule on, past its time."""
    free = F.coalesce(F.col("leased_until"), F.lit(EPOCH)) <= F.lit(now)
    return F.col("enabled") & free & ((F.col("next_allowed_at") <= F.lit(now)) if scheduled else F.lit(True))


def due(state: DataFrame, now: datetime, limit: int, shards: tuple[int, int] = (0, 1024), scheduled: bool = True) -> DataFrame:
    """The next domains of a range of shards, the longest due first, then by name: a top-k, no full sort."""
    low, high = shards
    return state.where((F.col("shard") >= low) & (F.col("shard") < high) & is_due(now, scheduled)).orderBy("next_allowed_at", "domain").limit(limit)


def lease(state: DataFrame, chosen: DataFrame, owner: str, now: datetime, seconds: int = 1800) -> DataFrame:
    """state with the chosen domains leased; one driver commits the result."""
    out = state.join(chosen.select("domain").distinct().withColumn("_mine", F.lit(True)), "domain", "left")
    return out.withColumns({"leased_until": F.when(F.col("_mine"), _after(now, F.lit(seconds))).otherwise(F.col("leased_until")), "lease_owner": F.when(F.col("_mine"), F.lit(owner)).otherwise(F.col("lease_owner"))}).drop("_mine")


def acquire_named(state: DataFrame, names: list[str], now: datetime) -> DataFrame:
    """Named domains whatever the schedule says, if no lease holds them."""
    return state.where(F.col("domain").isin(names) & (F.coalesce(F.col("leased_until"), F.lit(EPOCH)) <= F.lit(now)))


def release(state: DataFrame, outcomes: DataFrame, now: datetime) -> DataFrame:
    """state after outcomes(domain, ok, crawl_delay_s, needs_browser, access, ...): success waits one period and clears the
    streak, failure backs off by it; NULL fields of an outcome change nothing; a new access verdict is stamped."""
    patch = ("crawl_delay_s", "needs_browser", "access", "revisit_period_s")
    out = state.join(outcomes.select("domain", "ok", *[F.col(p).alias(f"_{p}") for p in patch if p in outcomes.columns]), "domain", "left")
    failures = F.when(F.col("ok"), F.lit(0)).otherwise(F.col("consec_failures") + 1)
    period = F.coalesce(F.col("_revisit_period_s"), F.col("revisit_period_s")) if "revisit_period_s" in outcomes.columns else F.col("revisit_period_s")
    wait = F.when(F.col("ok"), period).otherwise(backoff_seconds(period, failures))
    done = F.col("ok").isNotNull()
    new = {
        "consec_failures": F.when(done, failures).otherwise(F.col("consec_failures")),
        "next_allowed_at": F.when(done, _after(now, wait)).otherwise(F.col("next_allowed_at")),
        "last_success_at": F.when(F.col("ok"), F.lit(now)).otherwise(F.col("last_success_at")),
        "leased_until": F.when(done, F.lit(EPOCH)).otherwise(F.col("leased_until")),
        "lease_owner": F.when(~done, F.col("lease_owner")),
    } | {p: F.coalesce(f"_{p}", p) for p in patch if p in outcomes.columns}
    if "access" in outcomes.columns:
        new["access_probed_at"] = F.when(F.col("_access").isNotNull(), F.lit(now)).otherwise(F.col("access_probed_at"))
    return out.withColumns(new).select(*state.columns)


def reclaim(state: DataFrame, now: datetime) -> DataFrame:
    """Leases that ran out are given back."""
    over = (F.col("leased_until") > F.lit(EPOCH)) & (F.col("leased_until") < F.lit(now))
    return state.withColumns({"leased_until": F.when(over, F.lit(EPOCH)).otherwise(F.col("leased_until")), "lease_owner": F.when(~F.coalesce(over, F.lit(False)), F.col("lease_owner"))})


def seed(state: DataFrame, targets: DataFrame, now: datetime) -> DataFrame:
    """state with a row for each new domain of targets(domain, newsroom_url, a_id, shard); what is scheduled stays."""
    new = targets.groupBy("domain").agg(F.min("shard").alias("shard")).join(state.select("domain"), "domain", "left_anti")
    first = {"enabled": F.lit(True), "next_allowed_at": F.lit(now).cast("timestamp_ntz"), "leased_until": F.lit(EPOCH).cast("timestamp_ntz"), "consec_failures": F.lit(0), "revisit_period_s": F.lit(86400)}
    return state.unionByName(new.withColumns(first), allowMissingColumns=True)


def upsert_targets(stored: DataFrame, new: DataFrame) -> DataFrame:
    """One row per newsroom_url; a seed changes a_id and domain only, what discovery learned stays."""
    incoming = new.groupBy("newsroom_url").agg(F.min_by(F.struct("a_id", "domain"), "pos").alias("_n"))
    both = stored.join(incoming, "newsroom_url", "full")
    return both.withColumns({c: F.coalesce(f"_n.{c}", c) for c in ("a_id", "domain")}).drop("_n")


def make_due(state: DataFrame, now: datetime, domains: list[str] | None = None) -> DataFrame:
    scope = F.lit(True) if domains is None else F.col("domain").isin(domains)
    return state.withColumn("next_allowed_at", F.when(scope, F.lit(now)).otherwise(F.col("next_allowed_at")))


def forget(targets: DataFrame, domains: list[str] | None = None) -> DataFrame:
    """What discovery cached about the targets is dropped."""
    scope = F.lit(True) if domains is None else F.col("domain").isin(domains)
    gone = {c: F.when(~scope, F.col(c)) for c in ("discovery_method", "feed_url", "probed_at", "etag", "last_modified") if c in targets.columns}
    return targets.withColumns(gone | ({"feed_absent": F.col("feed_absent") & ~scope} if "feed_absent" in targets.columns else {}))


def release_target(targets: DataFrame, outcomes: DataFrame, now: datetime) -> DataFrame:
    """targets after outcomes(newsroom_url, success, and any of discovery_method, feed_url, etag, last_modified, p50_body_len, feed_absent).

    Success clears the streak and stamps last_success_at, failure adds one; NULL fields change nothing; a verdict on
    the feed's absence is stamped with its time, so that it can expire. One outcome of each target.
    """
    patch = [c for c in ("discovery_method", "feed_url", "etag", "last_modified", "p50_body_len", "feed_absent") if c in outcomes.columns]
    out = targets.join(outcomes.select("newsroom_url", F.col("success").alias("_ok"), *[F.col(c).alias(f"_{c}") for c in patch]), "newsroom_url", "left")
    known, ok = F.col("_ok").isNotNull(), F.coalesce("_ok", F.lit(False))
    new = {
        "consec_failures": F.when(ok, F.lit(0)).when(known, F.coalesce("consec_failures", F.lit(0)) + 1).otherwise(F.col("consec_failures")),
        "last_success_at": F.when(ok, F.lit(now)).otherwise(F.col("last_success_at")),
    } | {c: F.coalesce(f"_{c}", c) if c in targets.columns else F.col(f"_{c}") for c in patch}
    if "feed_absent" in patch:
        new["probed_at"] = F.when(F.col("_feed_absent").isNotNull(), F.lit(now)).otherwise(F.col("probed_at"))
    return out.withColumns(new).select(*targets.columns, *[c for c in patch if c not in targets.columns])


def targets_for(targets: DataFrame, domains: DataFrame) -> DataFrame:
    """The enabled targets of each of domains(domain), ordered by URL within the domain."""
    return targets.where("enabled").join(domains.select("domain").distinct(), "domain", "left_semi").orderBy("domain", "newsroom_url")


def target(targets: DataFrame, newsroom_url: str) -> DataFrame:
    """One target, or none."""
    return targets.where(F.col("newsroom_url") == newsroom_url).limit(1)


def acquire(state: DataFrame, targets: DataFrame, owner: str, now: datetime, limit: int = 32, shards: tuple[int, int] = (0, 1024), seconds: int = 600, scheduled: bool = True) -> tuple[DataFrame, DataFrame]:
    """(state with the next domains leased, a row for each enabled target of the leased domains: domain, newsroom_url, a_id, leased_until).

    A leased domain without targets has one row with a NULL newsroom_url. Both come from the same state, so commit the first before
    anything else changes it: one writer.
    """
    chosen = due(state, now, limit, shards, scheduled)
    leased = lease(state, chosen, owner, now, seconds)
    mine = leased.join(chosen.select("domain"), "domain", "left_semi").select("domain", "next_allowed_at", "leased_until")
    own = targets.where("enabled").select("domain", "newsroom_url", "a_id")
    return leased, mine.join(own, "domain", "left").orderBy("next_allowed_at", "domain", "newsroom_url").select("domain", "newsroom_url", "a_id", "leased_until")


def make_due_for_agency(state: DataFrame, targets: DataFrame, a_id: int, now: datetime) -> DataFrame:
    """state with the domains of an agency's targets brought forward: due now, free of leases and of their streak."""
    own = targets.where(F.col("a_id") == a_id).select("domain").distinct().withColumn("_own", F.lit(True))
    out, mine = state.join(own, "domain", "left"), F.coalesce("_own", F.lit(False))
    new = {"next_allowed_at": F.lit(now), "leased_until": F.lit(EPOCH), "lease_owner": F.lit(None).cast("string"), "consec_failures": F.lit(0)}
    return out.withColumns({c: F.when(mine, v).otherwise(F.col(c)) for c, v in new.items()}).drop("_own")


def agency_ids(targets: DataFrame) -> DataFrame:
    return targets.where("a_id IS NOT NULL").select("a_id").distinct()


def domains_for(targets: DataFrame, a_id: int) -> DataFrame:
    return targets.where(F.col("a_id") == a_id).select("domain").distinct()


def reset(state: DataFrame, targets: DataFrame, articles: DataFrame, now: datetime, domains: list[str] | None = None, relearn: bool = False, delete: bool = False, confirmed: bool = False) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(state, targets, articles) with domains due again and, if asked for, what discovery learned and what was stored of them dropped. Without
    a scope it touches everything, and so has to be confirmed."""
    if domains is None and not confirmed:
        raise ValueError("a reset of all domains has to be confirmed")
    left = articles if not delete else articles.limit(0) if domains is None else articles.where(~F.col("domain").isin(domains))
    return make_due(state, now, domains), forget(targets, domains) if relearn else targets, left


def disable(state: DataFrame, domain: str) -> DataFrame:
    return state.withColumn("enabled", F.col("enabled") & (F.col("domain") != domain))


def stats(state: DataFrame, targets: DataFrame, now: datetime, scheduled: bool = True) -> DataFrame:
    """One row of counters from one scan of each table; leased counts leases that ran out too."""
    c = F.col
    counts = state.agg(
        F.count("*").alias("domains"),
        F.count_if(c("enabled")).alias("enabled"),
        F.count_if(is_due(now, scheduled)).alias("due"),
        F.count_if(c("leased_until") > F.lit(EPOCH)).alias("leased"),
        F.count_if(c("consec_failures") > 0).alias("failing"),
        F.count_if(c("needs_browser")).alias("needs_browser"),
        F.count_if(c("last_success_at").isNotNull()).alias("succeeded"),
    )
    return counts.join(F.broadcast(targets.agg(F.count("*").alias("targets"))))  # one row each


def status_rows(targets: DataFrame, state: DataFrame) -> DataFrame:
    """Targets with their domain's state, enabled only if both are."""
    keep = ["crawl_delay_s", "revisit_period_s", "needs_browser", "access", F.col("next_allowed_at").alias("next_due_at"), F.col("enabled").alias("_on")]
    out = targets.join(state.select("domain", *keep), "domain", "left")
    return out.withColumn("enabled", F.col("enabled") & F.coalesce("_on", F.lit(True))).drop("_on")


def remove_agency(targets: DataFrame, state: DataFrame, a_id: int) -> tuple[DataFrame, DataFrame]:
    """Both tables without the agency; a domain goes when its last target does."""
    left = targets.where(F.col("a_id") != a_id)
    touched = targets.where(F.col("a_id") == a_id).select("domain").distinct()
    orphans = touched.join(left.select("domain"), "domain", "left_anti")
    return left, state.join(orphans, "domain", "left_anti")
