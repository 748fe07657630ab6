"""The two shared lists - agencies removed, sites requested - and their reconciliation with the stores."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import urls


def add(rows: DataFrame, key: str, new: DataFrame) -> DataFrame:
    """Upsert: the row added last under a key stands."""
    return rows.join(new.select(key), key, "left_anti").unionByName(new)


def drop(rows: DataFrame, key: str, value) -> DataFrame:
    return rows.where(F.col(key) != value)


def newest(rows: DataFrame, stamp: str, key: str) -> DataFrame:
    return rows.orderBy(F.desc(stamp), key)


def reconcile_requests(requests: DataFrame, removed: DataFrame) -> DataFrame:
    """Each request with its canonical URL, domain and outcome: invalid, refused (its agency is removed) or seed."""
    out = requests.withColumn("url", urls.canonical(F.col("newsroom_url")))
    out = out.withColumn("domain", urls.registrable_domain(F.col("url"))).join(removed.select("a_id", F.lit(True).alias("_gone")).distinct(), "a_id", "left")
    outcome = F.when((F.col("url") == "") | ~F.contains("domain", F.lit(".")), "invalid").when(F.col("_gone"), "refused").otherwise("seed")
    return out.withColumn("outcome", outcome).drop("_gone")


def seeds(listed: DataFrame, requests: DataFrame, removed: DataFrame) -> DataFrame:
    """Seed rows and requests in one list (a_id, newsroom_url, domain), once per URL, without removed agencies; seed rows win."""
    wanted = reconcile_requests(requests, removed).where("outcome = 'seed'").select("a_id", F.col("url").alias("newsroom_url"), "domain", F.lit(1).alias("_from"))
    own = listed.select("a_id", urls.canonical(F.col("newsroom_url")).alias("newsroom_url"), F.coalesce("domain", urls.registrable_domain(F.col("newsroom_url"))).alias("domain"), F.lit(0).alias("_from"))
    both = own.unionByName(wanted).join(removed.select("a_id"), "a_id", "left_anti")
    return both.groupBy("newsroom_url").agg(F.min_by(F.struct("a_id", "domain"), F.struct("_from", "a_id")).alias("s")).select("s.a_id", "newsroom_url", "s.domain")


def removal_effect(removed: DataFrame, articles: DataFrame, targets: DataFrame) -> DataFrame:
    """a_id, articles, targets that a removal would still take; nothing left to do gives zeros, so it can run again."""
    per = [t.groupBy("a_id").agg(F.count("*").alias(n)) for t, n in ((articles, "articles"), (targets, "targets"))]
    out = removed.select("a_id").distinct()
    for p in per:
        out = out.join(p, "a_id", "left")
    return out.fillna(0, ["articles", "targets"])


def removed_since(removed: DataFrame, since: datetime) -> DataFrame:
    return removed.where(F.col("removed_at") >= F.lit(since))


def members(rows: DataFrame, key: str, asked: DataFrame) -> DataFrame:
    """asked(key) with `listed`: whether the list holds each."""
    return asked.join(rows.select(key, F.lit(True).alias("listed")).distinct(), key, "left").withColumn("listed", F.coalesce("listed", F.lit(False)))


def without_removed(rows: DataFrame, removed: DataFrame) -> DataFrame:
    """rows of agencies that weren't removed; rows without an agency stay."""
    return rows.join(removed.select("a_id").distinct(), "a_id", "left_anti")


def reconcile(removed: DataFrame, stores: dict[str, Callable[[DataFrame], None]]) -> list[tuple[str, str | None]]:
    """Applies the removals to each store by its own function; (store, error or None) of each, so that one store's failure doesn't spare the
    others. Doing it again changes nothing."""
    out: list[tuple[str, str | None]] = []
    for name, apply in stores.items():
        try:
            apply(removed)
        except Exception as e:  # noqa: BLE001 - any failure of a store is its own
            out.append((name, f"{type(e).__name__}: {e}"))
        else:
            out.append((name, None))
    return out
