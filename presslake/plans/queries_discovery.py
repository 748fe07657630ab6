"""Queries of extraction, discovery, survey and validation over tables derived from the benchmark tables, each with its DuckDB SQL.

The SQL is written out by hand: it shares no constant with the operators it is held against.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import languages, responses, text, urls
from ..operators import articles, audit, discover, extract, politeness, survey, validation
from ..operators.columns import spread
from ..sources import feeds, pages, tables
from .inputs import cte, load
from .queries import AS_OF, query


# ---- extraction
@query(cte("article_pages") + """, v AS (SELECT page_id, page_id % 8 AS v, CAST(page_id AS VARCHAR) AS n FROM article_pages)
SELECT page_id, CASE v WHEN 0 THEN 'Bridge number ' || n || ' opens' WHEN 1 THEN 'Structured headline ' || n WHEN 2 THEN 'Harbour plan ' || n || ' wins the vote' WHEN 3 THEN 'Mayor wins - a story of hope ' || n
    WHEN 4 THEN 'Weak name ' || n WHEN 5 THEN 'Card title ' || n WHEN 6 THEN 'The bridge over the river ' || n END AS headline,
  CASE v WHEN 0 THEN 'trafilatura' WHEN 1 THEN 'jsonld' WHEN 2 THEN 'trafilatura' WHEN 3 THEN 'opengraph' WHEN 4 THEN 'jsonld' WHEN 5 THEN 'opengraph' WHEN 6 THEN 'trafilatura' ELSE 'none' END AS headline_source,
  CASE v WHEN 1 THEN 'jsonld' WHEN 2 THEN 'opengraph' WHEN 3 THEN 'time_element' WHEN 4 THEN 'time_element' WHEN 5 THEN 'url_path' WHEN 6 THEN 'htmldate' ELSE 'none' END AS date_source,
  CASE v WHEN 1 THEN '2026-08-11' WHEN 2 THEN '2026-08-20' WHEN 3 THEN '2026-08-12' WHEN 4 THEN '2026-08-05' WHEN 5 THEN '2026-08-17' WHEN 6 THEN '2026-08-21' END AS day,
  CASE WHEN v = 7 THEN 'none' ELSE 'trafilatura' END AS body_source, CASE v WHEN 0 THEN 'extract_no_date' WHEN 7 THEN 'extract_no_headline' END AS unusable,
  CASE WHEN v <> 7 THEN 'en' END AS language, v = 4 AS weak_only, CASE v WHEN 0 THEN 'no date' WHEN 7 THEN 'empty html' WHEN 4 THEN 'date sources disagree by 12d' ELSE '' END AS warnings,
  v = 7 AS needs_browser FROM v""")
def article_cascades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """EXT1-EXT9, EXT18-EXT21, EXT25-EXT31: headline, date, body and language with provenance, from eight kinds of page."""
    out = extract.records(pages.parse(load(spark, sf_dir, "article_pages")), AS_OF)
    day = F.date_format("date.value", "yyyy-MM-dd").alias("day")
    return out.select("page_id", "headline", "headline_source", F.col("date.source").alias("date_source"), day, "body_source", "unusable", "language", F.coalesce("quality.jsonld_weak_only", F.lit(False)).alias("weak_only"), F.array_join("warnings", "; ").alias("warnings"), F.col("browser.needed").alias("needs_browser"))


@query(cte("walls") + """ SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN 'just a moment...' WHEN 1 THEN 'js challenge (awswaf)' WHEN 2 THEN 'access denied' END AS wall FROM walls""")
def page_wall(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRD3."""
    return load(spark, sf_dir, "walls").select("doc_id", responses.detect_wall(F.col("html")).alias("wall"))


@query("""SELECT page_id, len(regexp_extract_all(html, '<a href="[^"]+"')) AS n_links, len(regexp_extract_all(html, '<a href="[^"]+"')) AS n_chrome,
  len(list_distinct(regexp_extract_all(html, '<a href="([^"]+)"', 1))) AS n_scraped FROM pages""")
def page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC13, HLP19: the links of a page stand in its navigation; the plain pattern finds the same ones."""
    raw = spark.read.parquet(f"{sf_dir}/pages.parquet")
    facts = pages.parse(raw).select("page_id", F.size("links").cast("long").alias("n_links"), F.size(F.filter("links", lambda x: x["in_chrome"])).cast("long").alias("n_chrome"))
    scraped = validation.scraped_links(raw.select(F.col("page_id").alias("target"), F.lit("https://x.org/").alias("url"), F.regexp_replace("html", "<(?:link|base)[^>]*>", "").alias("html")))
    return facts.join(scraped.groupBy(F.col("target").alias("page_id")).agg(F.count("*").alias("n_scraped")), "page_id")


_WORDS = """VALUES ('en', 'the of and to in that is for it was with as on by at from this are be which'), ('de', 'der die und das den von zu mit sich des auf nicht ein eine im dem ist auch es'),
  ('fr', 'le la les de des et un une du dans est pour que qui sur pas au avec ce en'), ('es', 'el los las de y que en un una del por con para es se al lo como su no'), ('it', 'il di che e la per un una in del della con sono le dei al nel non gli si'),
  ('pt', 'o os as de e que do da em um uma para com por dos das ao na no se'), ('nl', 'de het een en van in is dat op te met voor zijn niet aan er ook bij door'), ('sv', 'och att det som en på är av för med den till inte om ett har de var sig')"""


@query(f"""WITH l AS (SELECT column0 AS lang, string_split(column1, ' ') AS own FROM ({_WORDS}) t(column0, column1)),
d AS (SELECT doc_id, text, regexp_extract_all(lower(substr(text, 1, 2000)), '[\\p{{L}}]+') AS w FROM documents),
s AS (SELECT doc_id, text, lang, len(list_filter(w, lambda x: list_contains(own, x))) / greatest(len(w), 1) AS share FROM d, l),
r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY share DESC, lang DESC) AS n, lead(share) OVER (PARTITION BY doc_id ORDER BY share DESC, lang DESC) AS next FROM s)
SELECT doc_id, CASE WHEN length(trim(text)) >= 40 AND share >= 0.08 AND share >= 1.25 * next THEN lang END AS language FROM r WHERE n = 1""")
def doc_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """EXT18."""
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", languages.detect(F.col("text")).alias("language"))


@query(r"""WITH w AS (SELECT doc_id, list_distinct(regexp_extract_all(lower(text), '[\p{L}\p{N}_]+')) AS a, list_distinct(regexp_extract_all(lower(substr(text, 1, 400)), '[\p{L}\p{N}_]+')) AS b FROM documents)
SELECT doc_id, CASE WHEN len(a) = 0 OR len(b) = 0 THEN 0.0 ELSE round(len(list_intersect(a, b)) / (len(a) + len(b) - len(list_intersect(a, b))), 9) END AS overlap FROM w""")
def doc_token_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """EXT12: a text against its own beginning."""
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", F.round(text.overlap(F.col("text"), F.substring("text", 1, 400)), 9).alias("overlap"))


# ---- discovery
def _link(href: str, in_chrome: bool) -> F.Column:
    return F.struct(F.lit(href).alias("href"), F.lit(in_chrome).alias("in_chrome"))


@query(cte("solved") + """, c AS (SELECT *, CAST(substr(target, 2) AS BIGINT) % 12 AS k FROM solved)
SELECT target, CASE WHEN k % 4 = 0 AND k % 3 = 0 THEN 'cms_api' WHEN k % 4 = 1 AND (k % 3 = 0 OR k % 2 = 0 OR k >= 6) THEN 'rss' WHEN k % 4 = 2 THEN 'sitemap' WHEN k % 4 = 3 THEN 'listing' END AS method,
  k % 3 = 0 OR (k % 3 = 1 AND k >= 6) AS scoped, k % 3 <> 0 AND k < 6 AS root_feed FROM c""")
def discovery_fast_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DSC2, DSC3, DSC7."""
    rows = load(spark, sf_dir, "solved").withColumn("section", discover.section(F.col("newsroom_url")))
    told = rows.select("target", discover.declaration_is_scoped(F.col("feed_url"), F.col("section")).alias("scoped"), discover.is_root_feed(F.col("feed_url"), F.col("section")).alias("root_feed"))
    return discover.fast_path(rows).join(told, "target")


@query(cte("solved") + """, c AS (SELECT *, CAST(substr(target, 2) AS BIGINT) AS i FROM solved)
SELECT target, CASE WHEN i % 5 = 0 THEN 'https://site' || i || '.org/declared.xml' WHEN i % 5 = 1 THEN 'https://site' || i || '.org/rss.xml' WHEN i % 5 = 2 THEN 'https://site' || i || '.org/known.xml' END AS feed_url,
  i % 5 = 0 AS declared, i % 5 = 4 AND i % 2 = 0 AS probed_empty FROM c""")
def feed_finder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC12, DSC11, PRD8: declared, probed, known and absent feeds; an absence found 40 days ago is asked for again."""
    i = F.substring("target", 2, 20).cast("long")
    site = F.concat(F.lit("https://site"), i.cast("string"), F.lit(".org"))
    rows = spread(load(spark, sf_dir, "solved"), "target").withColumn("i", i)
    days = F.when(i % 2 == 0, 40).otherwise(3)
    targets = rows.select("target", F.concat(site, F.lit("/news/")).alias("newsroom_url"), F.concat(site, F.lit("/news/")).alias("base_url"), F.when(i % 5 == 2, F.concat(site, F.lit("/known.xml"))).alias("feed_url"), (i % 5 == 4).alias("feed_absent"), F.timestamp_add("DAY", -days, F.lit(AS_OF)).alias("probed_at"))
    declared = rows.where("i % 5 = 0").select("target", F.explode(F.array(F.struct(F.lit(1).alias("pos"), F.lit("/other.xml").alias("href")), F.struct(F.lit(0).alias("pos"), F.lit("../declared.xml").alias("href")))).alias("d")).select("target", "d.*")
    probes = rows.where("i % 5 IN (1, 3)").select(F.explode(F.array(*[F.struct(F.concat(site, F.lit(p)).alias("url"), ((i % 5 == 1) & F.lit(good)).alias("ok"), F.lit(good).alias("is_feed")) for p, good in (("/feed", False), ("/rss.xml", True), ("/index.xml", True))])).alias("p")).select("p.*")
    out = discover.find_feeds(targets, declared, probes, AS_OF)
    return out.select("target", "feed_url", "declared", F.when(F.substring("target", 2, 20).cast("long") % 5 == 3, F.lit(False)).otherwise(F.col("probed_empty")).alias("probed_empty"))


@query(cte("solved") + """ SELECT target, CASE CAST(substr(target, 2) AS BIGINT) % 6 WHEN 0 THEN 'rss' WHEN 1 THEN 'listing' WHEN 2 THEN 'sitemap' WHEN 3 THEN 'none' WHEN 4 THEN 'cms_api' ELSE 'sitemap' END AS method,
  CASE CAST(substr(target, 2) AS BIGINT) % 6 WHEN 0 THEN 3 WHEN 1 THEN 2 WHEN 2 THEN 2 WHEN 3 THEN 0 WHEN 4 THEN 3 ELSE 1 END AS n FROM solved""")
def discovery_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DSC1, DSC4, DSC6, DSC8, DSC10: a scoped feed, a site-wide feed that the page doesn't link to, a scoped and an unscoped sitemap, others' content, a linked CMS."""
    rows = spread(load(spark, sf_dir, "solved"), "target")
    i = F.substring("target", 2, 20).cast("long")
    site = F.concat(F.lit("https://site"), i.cast("string"), F.lit(".org"))
    targets = rows.select("target", F.concat(site, F.lit("/press")).alias("newsroom_url"))

    press, blog = [f"/press/2026/08/story-of-day-{k}" for k in range(3)], [f"/blog/2026/08/story-of-day-{k}" for k in range(3)]
    kinds = [
        (0, "rss", press, True, "/press/feed"), (0, "listing", press[:2], False, ""),
        (1, "rss", blog, True, "/feed"), (1, "listing", press[:2], False, ""),
        (2, "sitemap", press[:2] + blog, False, ""), (2, "listing", press, False, ""),
        (3, "rss", ["//elsewhere.com" + p for p in press + blog], True, "/press/feed"),
        (4, "cms_api", press, False, ""),
        (5, "sitemap", blog[:1], False, ""), (5, "listing", ["/press"], False, ""),
    ]
    table = spark.createDataFrame([(k, m, m, p, d, f) for k, m, paths, d, f in kinds for p in paths], "k long, method string, source string, path string, declared boolean, feed string")
    url = F.when(F.col("path").startswith("//"), F.concat(F.lit("https:"), "path")).otherwise(F.concat("site", F.col("path")))
    found = rows.select("target", site.alias("site"), (i % 6).alias("k")).join(F.broadcast(table), "k").select("target", "method", "source", "declared", url.alias("url"), F.concat("site", "feed").alias("feed_url"))
    links = rows.select("target", F.explode(F.array(F.concat(site, F.lit(press[0])), *[F.concat(site, F.lit(f"/page/{k}")) for k in range(25)])).alias("url"))
    return discover.cascade(found, targets, links)


@query(cte("solved") + """ SELECT target, 'https://site' || substr(target, 2) || '.org/' || p AS url FROM solved, (VALUES (0), (1), (2), (3)) k(k), (VALUES ('news-map'), ('post-map'), ('archive-2026')) m(m),
  (SELECT 'ref-' AS r) r, LATERAL (SELECT m || '/ref-' || k AS p) l WHERE k < 2""")
def sitemap_walk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC9-SRC11: the three best children of an index are read, and nothing below them."""
    rows = load(spark, sf_dir, "solved").select("target", F.concat(F.lit("https://site"), F.substring("target", 2, 20), F.lit(".org")).alias("base"))
    names = ["page-map", "archive-2026", "post-map", "news-map", "other"]
    children = rows.select(F.concat("base", F.lit("/sitemap.xml")).alias("map"), F.lit("child").alias("kind"), F.posexplode(F.array(*map(F.lit, names))).alias("pos", "name"), "base")
    children = children.select("map", "kind", F.concat("base", F.lit("/"), "name").alias("url"), "pos")
    refs = children.select(F.col("url").alias("map"), F.lit("ref").alias("kind"), F.explode(F.array(*[F.concat("url", F.lit(f"/ref-{k}")) for k in range(2)])).alias("url"), F.lit(0).alias("pos"))
    below = children.select(F.col("url").alias("map"), F.lit("child").alias("kind"), F.concat("url", F.lit("/deeper-news")).alias("url"), F.lit(0).alias("pos"))
    deep = below.select(F.col("url").alias("map"), F.lit("ref").alias("kind"), F.concat("url", F.lit("/never")).alias("url"), F.lit(0).alias("pos"))
    starts = feeds.roots(rows.withColumn("section", F.lit(None).cast("string")), spark.createDataFrame([], "target string, pos int, url string"))
    return feeds.walk(starts, children.unionAll(refs).unionAll(below).unionAll(deep)).select("target", "url")


@query(cte("solved") + """ SELECT target, 'https://site' || substr(target, 2) || CASE WHEN CAST(substr(target, 2) AS BIGINT) % 2 = 0 THEN '.org/news/2026/08/first-long-story' ELSE '.org/releases/the-council-opens' END AS url FROM solved""")
def listing_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DSC5, URL9, DSC3: links resolve against where the page came from; those of the section, else those outside navigation."""
    i = F.substring("target", 2, 20).cast("long")
    site = F.concat(F.lit("https://site"), i.cast("string"), F.lit(".org"))
    rows = load(spark, sf_dir, "solved").select("target", i.alias("i"), site.alias("site"))
    hrefs = F.when(F.col("i") % 2 == 0, F.array(_link("2026/08/first-long-story/", True), _link("/markets/some-other-long-page", False))).otherwise(
        F.array(_link("/releases/the-council-opens", False), _link("/menu/some-other-long-page", True), _link("mailto:x@y.org", False), _link("https://elsewhere.com/a-b-c-d", False))
    )
    captures = rows.select(F.concat("site", F.lit("/news")).alias("url"), F.concat(F.lit("https://www.site"), F.col("i").cast("string"), F.lit(".org/news/")).alias("final_url"))
    targets = discover.adopted(rows.select("target", F.concat("site", F.lit("/news")).alias("newsroom_url"), "i", hrefs.alias("h")), captures)
    links = targets.select("target", "newsroom_url", "base_url", F.posexplode("h").alias("pos", "x")).select("target", "newsroom_url", "base_url", "pos", "x.*")
    return discover.harvest(links).select("target", "url")


@query(cte("responses") + """, g AS (SELECT domain, count(*) AS n, count(*) FILTER (status >= 400) AS bad FROM responses GROUP BY domain) SELECT domain AS target, n >= 3 AND bad / n > 0.6 AS js_rendered FROM g""")
def shell_majorities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG26."""
    return discover.shell_majority(load(spark, sf_dir, "responses").select(F.col("domain").alias("target"), (F.col("status") >= 400).alias("needs_browser")))


@query(cte("responses") + """, o AS (SELECT domain, event_id, status = 200 AS stored, status = 304 OR status = 0 AS seen, row_number() OVER (PARTITION BY domain ORDER BY stamp, event_id) AS pos FROM responses),
a AS (SELECT *, coalesce(max(CASE WHEN NOT seen THEN pos END) OVER (PARTITION BY domain ORDER BY pos), 0) AS broke, sum(CASE WHEN stored THEN 1 ELSE 0 END) OVER (PARTITION BY domain ORDER BY pos) AS got FROM o),
s AS (SELECT domain, min(pos) AS stop FROM a WHERE pos - broke >= 3 OR got >= 4 GROUP BY domain)
SELECT a.domain AS target, event_id FROM a LEFT JOIN s USING (domain) WHERE stop IS NULL OR pos <= stop""")
def stop_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ORD7."""
    from pyspark.sql import Window

    rows = load(spark, sf_dir, "responses")
    pos = F.row_number().over(Window.partitionBy("domain").orderBy("stamp", "event_id"))
    rows = rows.select(F.col("domain").alias("target"), "event_id", pos.alias("pos"), F.col("status").isin(304, 0).alias("seen"), (F.col("status") == 200).alias("stored"))
    return discover.streak_cut(rows, 4, 3).select("target", "event_id")


@query(cte("targets") + " SELECT DISTINCT newsroom_url, dense_rank() OVER (PARTITION BY domain ORDER BY newsroom_url) AS wave FROM targets")
def crawl_waves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ORD9."""
    return audit.waves(load(spark, sf_dir, "targets").select("domain", "newsroom_url").distinct()).select("newsroom_url", "wave")


@query("SELECT CAST(w AS INT) AS worker, CAST(floor(w * 1024 / 7) AS INT) AS low, CAST(floor((w + 1) * 1024 / 7) AS INT) AS high FROM range(7) t(w)")
def shard_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """URL14: contiguous ranges whose sizes differ by one at most."""
    return spark.createDataFrame([(k, *r) for k, r in enumerate(urls.shard_ranges(7))], "worker int, low int, high int")


# ---- survey and validation
@query(cte("sites") + """, t AS (SELECT *, ok AND newsroom_status = 200 AND article_status = 200 AS tested FROM sites), i AS (SELECT resolved_ip, count(*) AS c FROM sites WHERE resolved_ip IS NOT NULL GROUP BY 1)
SELECT count(*) AS domains_sampled, round(100.0 * count(*) FILTER (ok AND newsroom_status = 200) / count(*), 1) AS reachable, round(100.0 * count(wall) / count(*), 1) AS walls, round(100.0 * count(*) FILTER (NOT robots_allows) / count(*), 1) AS robots_disallow,
  round(100.0 * count(*) FILTER (discovery_method = 'listing') / count(*), 1) AS listing_only, round(100.0 * count(*) FILTER (feed_source = 'probe') / count(*), 1) AS rss_via_probe, round(100.0 * count(*) FILTER (wp_detected AND wp_json_reachable) / count(*) FILTER (wp_detected), 1) AS wp_json_reachable,
  count(*) FILTER (tested) AS article_pages_tested, round(100.0 * count(*) FILTER (tested AND has_jsonld) / count(*) FILTER (tested), 1) AS jsonld_article_type, list_sort(list(text_chars) FILTER (tested))[CAST(floor(count(*) FILTER (tested) / 2) AS INT) + 1] AS median_text_chars,
  (SELECT count(*) FROM i) AS distinct_ips, (SELECT max(c) FROM i) AS largest_cluster, round(100.0 * (SELECT coalesce(sum(c), 0) FROM i WHERE c > 1) / count(*), 1) AS domains_on_shared_ip FROM t""")
def survey_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG16, CLS9's winner."""
    rows = load(spark, sf_dir, "sites")
    rows = rows.withColumn("discovery_method", survey.winner(*map(F.col, ("has_news_sitemap", "cms_api_url", "feed_url", "sitemap_url"))))
    return survey.summarise(rows).select("domains_sampled", "reachable", "walls", "robots_disallow", "listing_only", "rss_via_probe", "wp_json_reachable", "article_pages_tested", "jsonld_article_type", "median_text_chars", "distinct_ips", "largest_cluster", "domains_on_shared_ip")


@query(cte("sites", "article_pages") + """ SELECT domain, discovery_method, page_id % 8 = 1 AS has_jsonld, page_id % 8 = 7 AS needs_browser, CASE WHEN page_id % 8 = 7 THEN 'empty response' END AS reason
FROM sites JOIN article_pages ON page_id = site_id""")
def survey_probes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CLS9, HLP17: a row of measurements for each site that has an article."""
    sites = load(spark, sf_dir, "sites")
    parsed = pages.parse(load(spark, sf_dir, "article_pages")).join(sites.select("domain", F.col("site_id").alias("page_id"), "article_status"), "page_id")
    rows = survey.probe_rows(sites.drop("article_status", "has_jsonld", "jsonld_has_headline", "jsonld_has_date", "jsonld_has_articlebody", "text_chars", "needs_browser", "has_hydration_payload"), parsed)
    return rows.where("article_status IS NOT NULL").join(parsed.select("domain"), "domain", "left_semi").select("domain", "discovery_method", "has_jsonld", "needs_browser", F.col("needs_browser_reason").alias("reason"))


@query(cte("articles") + """, s AS (SELECT *, domain AS target, string_split(url, '/')[-1] AS slug FROM articles), l AS (SELECT DISTINCT target, slug FROM s WHERE doc_id % 3 = 0),
g AS (SELECT s.target, count(*) AS n_stored, round(avg(CASE WHEN l.slug IS NULL THEN 0 ELSE 1 END), 3) AS overlap, count(DISTINCT headline) AS heads, count(*) FILTER (published_at IS NULL) AS undated, count(*) FILTER (body_len < 500) AS thin,
  date_diff('day', min(published_at), max(published_at)) AS days, count(*) FILTER (s.doc_id % 3 = 0) AS listed FROM s LEFT JOIN l ON s.target = l.target AND s.slug = l.slug GROUP BY s.target)
SELECT target, n_stored, overlap, concat_ws(',', CASE WHEN listed = 0 THEN 'no_listing' END, CASE WHEN listed > 0 AND overlap = 0 THEN 'low_overlap' END, CASE WHEN listed > 0 AND overlap > 0 AND overlap < 0.5 THEN 'selection_order' END,
  CASE WHEN n_stored >= 3 AND heads = 1 THEN 'headline_boilerplate' END, CASE WHEN undated > 0 THEN 'undated' END, CASE WHEN thin > 0 THEN 'thin_body' END, CASE WHEN days > 120 THEN 'stale_spread' END) AS codes FROM g""")
def validation_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CLS7, JN12, URL11: articles of each domain against every third of them as listing."""
    rows = load(spark, sf_dir, "articles").withColumnRenamed("domain", "target")
    out = validation.score(rows, rows.where("doc_id % 3 = 0").select("target", "url"))
    return out.select("target", "n_stored", "overlap", F.array_join("codes", ",").alias("codes"))


@query(cte("refs") + """, u AS (SELECT target, 'https://www.example.org/news/' || pos || '-the-long-story-of-a-day' AS url, pos FROM refs WHERE pos % 2 = 0)
SELECT target, 'https://example.org/news/' || pos || '-the-long-story-of-a-day' AS url FROM refs WHERE pos % 2 = 0 AND pos % 6 <> 0""")
def own_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN13: links of a page less those of the homepage, long slugs only."""
    rows = load(spark, sf_dir, "refs").select("target", "pos")
    long = F.concat(F.lit("https://example.org/news/"), F.col("pos").cast("string"), F.lit("-the-long-story-of-a-day"))
    page = rows.select("target", F.lit("https://www.example.org/news").alias("newsroom_url"), F.when(F.col("pos") % 2 == 0, long).otherwise("https://example.org/about").alias("url"))
    return validation.content_links(page, rows.where("pos % 6 = 0").select("target", long.alias("url")))


@query(cte("targets") + """, l AS (SELECT a_id, newsroom_url, CASE WHEN a_id % 2 = 0 THEN 'ok' END AS verdict FROM targets), e AS (SELECT a_id, newsroom_url FROM targets WHERE a_id % 3 = 0)
SELECT l.a_id, l.newsroom_url, CASE WHEN l.a_id % 3 = 0 THEN 'drift' ELSE verdict END AS verdict, CASE WHEN l.a_id % 3 = 0 THEN 'undated,thin_body' END AS codes, CASE WHEN l.a_id % 3 = 0 THEN 'done' ELSE 'open' END AS state FROM l""")
def verdict_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK15, JN3, CLS8: stored evidence is scored again and the ledger's rows replaced."""
    t = load(spark, sf_dir, "targets").select("a_id", "newsroom_url")
    ledger = t.select("*", F.when(F.col("a_id") % 2 == 0, "ok").alias("verdict"), F.lit(None).cast("string").alias("codes"), F.lit("open").alias("state"))
    evidence = validation.record_evidence(t.where("a_id % 9 = 0").withColumn("n_content", F.lit(1)), t.where("a_id % 3 = 0").withColumn("n_content", F.lit(2)))
    scored = validation.to_rescore(evidence.where("n_content = 2"), ledger).select("a_id", "newsroom_url", F.lit("drift").alias("verdict"), F.lit("undated,thin_body").alias("codes"))
    return validation.record_verdicts(ledger, scored, AS_OF).select("a_id", "newsroom_url", "verdict", "codes", "state")


@query(cte("refs") + """, s AS (SELECT target, CASE WHEN pos % 3 = 0 THEN '/a/x' || pos WHEN pos % 3 = 1 THEN '/b/y' || pos ELSE '/root' || pos END AS p, pos FROM refs),
k AS (SELECT target, CASE WHEN pos % 3 = 0 THEN '/a' WHEN pos % 3 = 1 THEN '/b' ELSE '/' END AS prefix, count(*) AS n, min(pos) AS f FROM s GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY target ORDER BY n DESC, f) AS rn FROM k)
SELECT target, prefix AS section FROM r WHERE rn = 1""")
def section_prefixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """URL13."""
    i = F.col("pos")
    p = F.when(i % 3 == 0, F.concat(F.lit("/a/x"), i.cast("string"))).when(i % 3 == 1, F.concat(F.lit("/b/y"), i.cast("string"))).otherwise(F.concat(F.lit("/root"), i.cast("string")))
    return validation.section_prefix(load(spark, sf_dir, "refs").select("target", "pos", F.concat(F.lit("https://x.org"), p).alias("url")))


@query("""WITH r AS (SELECT *, 'conv-' || conv_id AS url FROM conversations), k AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS rn FROM r) SELECT url, turn AS pos, role FROM k WHERE rn = 1""")
def latest_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC4: the last record of each key stands."""
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return articles.latest(rows.select(F.concat(F.lit("conv-"), F.col("conv_id").cast("string")).alias("url"), F.lit("f").alias("file"), F.col("turn").alias("pos"), "role", "text")).select("url", "pos", "role")


@query(cte("legacy") + """, p AS (SELECT 'field_count' AS problem, count(*) AS n FROM legacy WHERE fields <> 3 UNION ALL SELECT 'bad_a_id', count(*) FROM legacy WHERE TRY_CAST(a_id AS INT) IS NULL UNION ALL SELECT 'bad_url', count(*) FROM legacy WHERE newsroom_url = 'nothing'
UNION ALL SELECT 'duplicate_a_id', sum(c - 1) FROM (SELECT count(*) AS c FROM legacy WHERE a_id IS NOT NULL GROUP BY a_id HAVING count(*) > 1) UNION ALL SELECT 'duplicate_newsroom_url', sum(c - 1) FROM (SELECT count(*) AS c FROM legacy GROUP BY newsroom_url HAVING count(*) > 1))
SELECT problem, CAST(n AS BIGINT) AS n FROM p WHERE n > 0""")
def list_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC3, AGG22."""
    return tables.quality_report(load(spark, sf_dir, "legacy"))


@query(cte("responses") + """ SELECT count(*) AS attempted, count(*) FILTER (starts_with(error, 'DNSError')) AS failed, count(*) FILTER (starts_with(error, 'DNSError')) > 0.25 * count(*) AS alarm FROM responses""")
def resolver_alarm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG25."""
    return politeness.resolver_alarm(load(spark, sf_dir, "responses"))


# ---- text
@query(r"""WITH l AS (SELECT doc_id, text, list_filter(list_transform(string_split(text, chr(10)), lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')), lambda x: x <> '') AS ls,
  list_filter(regexp_extract_all(lower(substr(text, 1600, 80)), '[\p{L}\p{N}_]+'), lambda w: length(w) > 2 AND w NOT IN ('the', 'and', 'for', 'with', 'from', 'that', 'this', 'are', 'was', 'has', 'its', 'new', 'will', 'after', 'over', 'into')) AS hw,
  lower(substr(text, 1, 1500)) AS opening FROM documents)
SELECT doc_id, CASE WHEN text IS NULL OR len(ls) = 0 THEN 0.0 ELSE round_even((len(list_filter(ls, lambda x: length(x) >= 60)) / len(ls) + least(1.0, len(regexp_extract_all(text, '(?:^|[^A-Z])[.!?](?:\s+[A-Z"“]|\s*$)')) / greatest(1.0, length(text) / 150.0))) / 2, 3) END AS prose_ratio,
  CASE WHEN len(hw) = 0 THEN 1.0 ELSE round_even(len(list_filter(hw, lambda w: contains(opening, w))) / len(hw), 3) END AS coherence FROM l""")
def prose_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """EXT15, EXT23: the lookbehind of sentence ends is restated as a character in front; a headline from the middle of a text against its opening."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return docs.select("doc_id", text.prose_ratio(F.col("text")).alias("prose_ratio"), text.coherence(F.substring("text", 1600, 80), F.col("text")).alias("coherence"))
