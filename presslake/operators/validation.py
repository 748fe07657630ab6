"""Post-store validation: what was stored of a target against what its listing shows."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import urls
from ..storage import upsert

KEYS = ("a_id", "newsroom_url")

# ---- fixed values
THIN_BODY, SPREAD_DAYS, LOW, SLUG_LONGER_THAN = 500, 120, 0.5, 18
# ---- end of fixed values


def matched(stored: DataFrame, listing: DataFrame) -> DataFrame:
    """stored(target, url, ...) with matched: its comparison key or, failing that, its slug is in the target's listing(target, url).

    Two equi-joins in place of one with OR, which would compare all pairs.
    """
    keys = listing.select("target", urls.comparison_key(F.col("url")).alias("_key")).distinct().withColumn("_k", F.lit(True))
    slugs = listing.select("target", urls.slug(F.col("url")).alias("_slug")).where("_slug <> ''").distinct().withColumn("_s", F.lit(True))
    out = stored.withColumn("_key", urls.comparison_key(F.col("url"))).withColumn("_slug", urls.slug(F.col("url")))
    out = out.join(keys, ["target", "_key"], "left").join(slugs, ["target", "_slug"], "left")
    return out.withColumn("matched", F.coalesce("_k", "_s", F.lit(False))).drop("_key", "_slug", "_k", "_s")


def section_prefix(refs: DataFrame) -> DataFrame:
    """target, section: the first path segment most of a target's URLs share, the first met of equals; '/' if most stand at the root."""
    segments = urls.segments(urls.path(F.col("url")))
    prefix = F.when(F.size(segments) >= 2, F.concat(F.lit("/"), F.element_at(F.concat(segments, F.array(F.lit(""))), 1))).otherwise("/")
    per = refs.groupBy("target", prefix.alias("prefix")).agg(F.count("*").alias("n"), F.min("pos").alias("first"))
    return per.groupBy("target").agg(F.max_by("prefix", F.struct("n", -F.col("first"))).alias("section"))


def common_prefix(rows: DataFrame, value: str = "url") -> DataFrame:
    """target, prefix: the longest prefix that all values share, from the least and the greatest of them."""
    ends = rows.groupBy("target").agg(F.min(value).alias("a"), F.max(value).alias("b"))
    size = F.size(F.filter(F.sequence(F.lit(1), F.greatest(F.length("a"), F.lit(1))), lambda i: F.substr(F.col("a"), F.lit(1), i) == F.substr(F.col("b"), F.lit(1), i)))
    return ends.select("target", F.substr("a", F.lit(1), size).alias("prefix"))


def score(stored: DataFrame, listing: DataFrame) -> DataFrame:
    """target, n_stored, overlap, codes and verdict (ok, drift, unverifiable, broken) of stored(target, url, headline, published_at, body_len)."""
    per = (
        matched(stored, listing)
        .groupBy("target")
        .agg(
            F.count("*").alias("n_stored"),
            F.round(F.avg(F.col("matched").cast("int")), 3).alias("overlap"),
            F.count_distinct(urls.registrable_domain(F.col("url"))).alias("_hosts"),
            F.count_distinct("headline").alias("_heads"),
            F.count_if(F.col("published_at").isNull()).alias("_undated"),
            F.count_if(F.col("body_len") < THIN_BODY).alias("_thin"),
            F.datediff(F.max("published_at"), F.min("published_at")).alias("_days"),
            F.count_if(~urls.classify(F.col("url"))["is_article"]).alias("_index"),
        )
    )
    listed = listing.groupBy("target").agg(F.count("*").alias("_listed"))
    out = per.join(listed, "target", "full").fillna(0, ["n_stored", "_listed"])
    n = F.col("n_stored")
    rules = (
        (n == 0, "zero_yield"),
        (F.col("_listed") == 0, "no_listing"),
        ((F.col("_listed") > 0) & (F.col("overlap") == 0), "low_overlap"),
        ((F.col("_listed") > 0) & (F.col("overlap") > 0) & (F.col("overlap") < LOW), "selection_order"),
        (F.col("_hosts") > 1, "off_host"),
        ((n >= 3) & (F.col("_heads") == 1), "headline_boilerplate"),
        (F.col("_index") > 0, "index_page"),
        (F.col("_undated") > 0, "undated"),
        (F.col("_thin") > 0, "thin_body"),
        (F.col("_days") > SPREAD_DAYS, "stale_spread"),
    )
    out = out.withColumn("codes", F.array_compact(F.array(*[F.when(holds, F.lit(code)) for holds, code in rules])))
    hard = F.arrays_overlap("codes", F.array(*map(F.lit, ("zero_yield", "low_overlap", "headline_boilerplate"))))
    verdict = F.when(F.array_contains("codes", "no_listing") & (n > 0), "unverifiable").when(hard, "broken").when(F.size("codes") > 0, "drift").otherwise("ok")
    return out.select("target", "n_stored", "overlap", "codes", verdict.alias("verdict"))


def progress(ledger: DataFrame) -> DataFrame:
    """kind (verdict or code), word, n of ledger(verdict, codes CSV)."""
    words = F.concat(F.array(F.struct(F.lit("verdict").alias("kind"), F.col("verdict").alias("word"))), F.transform(F.filter(F.split(F.coalesce("codes", F.lit("")), ","), lambda x: x != ""), lambda x: F.struct(F.lit("code").alias("kind"), x.alias("word"))))
    return ledger.select(F.explode(words).alias("w")).groupBy("w.kind", "w.word").agg(F.count("*").alias("n"))


def content_links(page_links: DataFrame, home_links: DataFrame) -> DataFrame:
    """target, url: what a newsroom page links of its own: on its host, long enough to be a headline, and not linked from the homepage.

    page_links(target, newsroom_url, url), home_links(target, url); both once for each URL.
    """
    host = F.regexp_replace(urls.host(F.col("newsroom_url")), r"^www\.", "")
    last = F.element_at(F.split(F.regexp_replace(urls.path(F.col("url")), "/+$", ""), "/"), -1)
    own = page_links.where(F.contains("url", host) & (F.length(last) > SLUG_LONGER_THAN)).select("target", "url").distinct()
    return own.join(home_links.select("target", "url").distinct(), ["target", "url"], "left_anti")


def scraped_links(pages: DataFrame) -> DataFrame:
    """target, url of pages(target, url, html) by a plain pattern over the markup, fragments aside; canonical, once each."""
    hrefs = F.explode(F.regexp_extract_all("html", F.lit(r"href=[\x22\x27]([^\x22\x27#]+)"), F.lit(1)))
    return pages.select("target", F.col("url").alias("_base"), hrefs.alias("_href")).select("target", urls.let(urls.join(F.col("_base"), F.col("_href")), urls.canonical).alias("url")).where("url <> ''").distinct()


def record_evidence(evidence: DataFrame, new: DataFrame) -> DataFrame:
    """Evidence of a run replaces what was held of the same targets (a_id, newsroom_url)."""
    return upsert(evidence, new, *KEYS)


def record_verdicts(ledger: DataFrame, scored: DataFrame, at: datetime, source: str = "auto") -> DataFrame:
    """ledger with the outcome of scored(a_id, newsroom_url, verdict, codes CSV, overlap, ...) in the rows of its targets; others, and other columns, stay."""
    patch = [c for c in scored.columns if c not in KEYS and c in ledger.columns]
    out = ledger.join(scored.select(*KEYS, *[F.col(c).alias(f"_{c}") for c in patch], F.lit(True).alias("_hit")), [*KEYS], "left")
    stamped = {"state": F.lit("done"), "tested_at": F.lit(at), "source": F.lit(source)}
    new = {c: F.col(f"_{c}") for c in patch} | {c: v.cast(dict(ledger.dtypes)[c]) for c, v in stamped.items() if c in ledger.columns}
    return out.withColumns({c: F.when(F.col("_hit"), v).otherwise(F.col(c)) for c, v in new.items()}).select(*ledger.columns)


def to_rescore(evidence: DataFrame, ledger: DataFrame) -> DataFrame:
    """Evidence of targets that the ledger holds, with the verdict they had."""
    return evidence.join(ledger.select(*KEYS, F.col("verdict").alias("was")), [*KEYS])
