"""One crawl pass over captures: references are gated, unseen ones parsed, records judged, outcomes counted. Nothing is fetched."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text, urls
from ..operators import articles, discover, extract, faults
from ..sources import pages
from ..storage import checkpointed


def gate(refs: DataFrame, targets: DataFrame) -> DataFrame:
    """refs with drop_reason: the newsroom itself, another publisher, not news, or (from maps and listings) not article-shaped; NULL goes on."""
    per = targets.select("target", urls.registrable_domain(F.col("newsroom_url")).alias("_own"), urls.canonical(F.col("newsroom_url")).alias("_seed"))
    u = F.col("url")
    reason = (
        F.when(urls.canonical(u) == F.col("_seed"), "seed")
        .when(urls.registrable_domain(u) != F.col("_own"), "publisher")
        .when(urls.is_non_news(u), "non_news")
        .when(F.col("source").isin("sitemap", "listing") & ~urls.classify(u)["is_article"], "not_article")
    )
    return refs.join(per, "target").withColumn("drop_reason", reason).drop("_own", "_seed")


def run(refs: DataFrame, targets: DataFrame, captures: DataFrame, stored: DataFrame, as_of: datetime, max_age_days: int = 30) -> dict[str, DataFrame]:
    """articles to append, faults to record and outcomes of refs(target, pos, url, source, ...) against captures(page_id, url, html) and the store.

    Native gates and the anti-join with the store come before the one Python parse. Outcomes are written once to the
    shared folder, since three readers follow.
    """
    gated = gate(discover.prefer_section(refs, targets), targets)
    open_ = articles.unseen(gated.where("drop_reason IS NULL"), stored)
    wanted = open_.select(urls.canonical(F.col("url")).alias("_key"), "target", "pos", "source")
    found = captures.withColumn("_key", urls.canonical(F.col("url")))
    records = extract.records(pages.parse(found.join(wanted.select("_key").distinct(), "_key", "left_semi")), as_of)
    joined = records.withColumn("_key", urls.canonical(F.col("url"))).join(wanted, "_key")
    old = F.col("date.value") < F.lit(as_of) - F.expr(f"INTERVAL {max_age_days} DAYS")
    outcomes = checkpointed(joined.withColumn("outcome", F.when(F.col("unusable").isNotNull(), F.col("unusable")).when(old, "too_old").otherwise("stored")))
    new = outcomes.where("outcome = 'stored'").select("url", "headline", "body", F.col("date.value").alias("published_at"), "target", urls.url_hash(F.col("url")).alias("url_hash"), text.content_hash(F.col("body")).alias("content_hash"), F.lit(as_of).alias("first_seen_at"))
    run_id = as_of.strftime("%Y%m%d-%H%M%S")
    failed = outcomes.where("outcome LIKE 'extract%'")
    seen = failed.select(F.lit(run_id).alias("run_id"), F.col("outcome").alias("kind"), urls.registrable_domain(F.col("url")).alias("domain"), F.lit(None).cast("int").alias("a_id"), F.lit(1).alias("n"), F.lit(as_of).alias("at"), "url", F.lit(None).cast("string").alias("detail"))
    counts = outcomes.groupBy("outcome").agg(F.count("*").alias("n")).unionAll(gated.where("drop_reason IS NOT NULL").groupBy("drop_reason").agg(F.count("*").alias("n")))
    return {"articles": articles.new_articles(new, stored), "faults": faults.record(seen), "outcomes": counts}
