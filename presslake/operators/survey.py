"""Survey: what a sample of sites can do: a row of measurements for each site, then shares of three denominators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .columns import percent, upper_median

# ---- fixed values
ARTICLE_TYPES = ("newsarticle", "article", "blogposting", "report", "pressrelease", "reportagenewsarticle", "analysisnewsarticle")
SHELL_CHARS, SMALL_HTML, MANY_SCRIPTS = 200, 1000, 3
# ---- end of fixed values


def winner(has_news_sitemap: Column, cms_api: Column, feed: Column, sitemap: Column) -> Column:
    """The source that a site would be read by, the best it offers."""
    there = lambda c: F.coalesce(c, F.lit("")) != ""
    return F.when(F.coalesce(has_news_sitemap, F.lit(False)), "news_sitemap").when(there(cms_api), "cms_api").when(there(feed), "rss").when(there(sitemap), "sitemap").otherwise("listing")


def needs_browser(text_chars: Column, structured: Column, html_chars: Column, notice: Column, scripts: Column) -> Column:
    """STRUCT<needed, reason>; as extraction has it, but many scripts are named in place of a payload."""
    low = lambda *tail: F.concat(F.lit("low text"), *tail)
    n = text_chars.cast("string")
    # ---- fixed values: reasons
    reason = (
        F.when((text_chars >= SHELL_CHARS) | structured, F.lit(None).cast("string"))
        .when(F.coalesce(html_chars, F.lit(0)) == 0, "empty response")
        .when(notice, "noscript js-required notice")
        .when(html_chars < SMALL_HTML, "html under 1KB")
        .when(scripts >= MANY_SCRIPTS, low(F.lit(" ("), n, F.lit(" chars) with "), scripts.cast("string"), F.lit(" scripts")))
        .otherwise(low(F.lit(" yield ("), n, F.lit(" chars)")))
    )
    # ---- end of fixed values
    return F.struct(reason.isNotNull().alias("needed"), reason.alias("reason"))


def probe_rows(sites: DataFrame, articles: DataFrame) -> DataFrame:
    """A row of measurements for each site: sites(domain, newsroom_status, ok, wall, robots_allows, resolved_ip, has_news_sitemap, sitemap_url, feed_url, feed_source,
    feed_full, cms_api_url, wp_detected, wp_json_reachable) and the parsed article of it, articles(domain, article_status, jsonld, body, html_chars, script_notice, hydration, scripts)."""
    chars = F.length(F.coalesce("body", F.lit("")))
    typed = F.arrays_overlap("jsonld.types", F.array(*map(F.lit, ARTICLE_TYPES)))
    told = lambda c: F.coalesce(typed & F.col(f"jsonld.{c}").isNotNull(), F.lit(False))
    need = needs_browser(chars, told("body"), F.col("html_chars"), F.col("script_notice"), F.col("scripts"))
    measured = articles.select("domain", "article_status", F.coalesce(typed, F.lit(False)).alias("has_jsonld"), told("headline").alias("jsonld_has_headline"), told("date_raw").alias("jsonld_has_date"), told("body").alias("jsonld_has_articlebody"), chars.alias("text_chars"), need.alias("_b"), F.col("hydration").alias("has_hydration_payload"))
    out = sites.join(measured, "domain", "left").withColumn("discovery_method", winner(*map(F.col, ("has_news_sitemap", "cms_api_url", "feed_url", "sitemap_url"))))
    return out.withColumns({"needs_browser": F.coalesce("_b.needed", F.lit(False)), "needs_browser_reason": F.col("_b.reason")}).drop("_b")


def summarise(rows: DataFrame) -> DataFrame:
    """One row: shares of all sites, of reachable sites with an article, of WordPress sites; the upper median of their text; how many sites share an address."""
    c = F.col
    n = F.count("*")
    reachable = F.coalesce(c("ok") & (c("newsroom_status") == 200), F.lit(False))
    tested = reachable & F.coalesce(c("article_status") == 200, F.lit(False))
    given = lambda name: F.coalesce(c(name), F.lit("")) != ""
    of_all = {
        "reachable": reachable, "walls": given("wall"), "robots_disallow": ~c("robots_allows"), "news_sitemap": c("has_news_sitemap"), "any_sitemap": given("sitemap_url"),
        "rss_autodiscovered": c("feed_source") == "autodiscovery", "rss_via_probe": c("feed_source") == "probe", "rss_full_content": c("feed_full"), "cms_api": given("cms_api_url"),
        "listing_only": c("discovery_method") == "listing", "wordpress": c("wp_detected"),
    }
    of_tested = {"jsonld_article_type": "has_jsonld", "has_headline": "jsonld_has_headline", "has_datepublished": "jsonld_has_date", "has_articlebody": "jsonld_has_articlebody", "needs_browser": "needs_browser", "has_hydration_payload": "has_hydration_payload"}
    out = rows.withColumn("_chars", F.when(tested, c("text_chars"))).agg(
        n.alias("domains_sampled"),
        *[percent(F.count_if(holds), n).alias(name) for name, holds in of_all.items()],
        F.count_if(tested).alias("article_pages_tested"),
        *[percent(F.count_if(tested & c(column)), F.count_if(tested)).alias(name) for name, column in of_tested.items()],
        percent(F.count_if(c("wp_detected") & c("wp_json_reachable")), F.count_if(c("wp_detected"))).alias("wp_json_reachable"),
        F.coalesce(upper_median("_chars"), F.lit(0)).alias("median_text_chars"),
    )
    return out.join(F.broadcast(shared_addresses(rows))).withColumn("domains_on_shared_ip", percent(c("on_shared_ip"), c("domains_sampled"))).drop("on_shared_ip")  # one row each


def shared_addresses(rows: DataFrame) -> DataFrame:
    """One row: distinct_ips, on_shared_ip (sites whose address another has too) and largest_cluster."""
    per = rows.where("resolved_ip IS NOT NULL AND resolved_ip <> ''").groupBy("resolved_ip").agg(F.count("*").alias("c"))
    return per.agg(F.count("*").alias("distinct_ips"), F.coalesce(F.sum(F.when(F.col("c") > 1, F.col("c"))), F.lit(0)).alias("on_shared_ip"), F.coalesce(F.max("c"), F.lit(0)).alias("largest_cluster"))
