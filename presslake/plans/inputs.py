"""The engine's input tables derived from the benchmark tables, in SQL that Spark and DuckDB both read.

One text serves both sides, so a query and its oracle start from the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

NOW = "2026-08-29 12:00:00"
_KINDS = ("dns", "circuit", "error", "tls", "http2", "http_4xx", "connect", "timeout", "http_5xx", "wall", "robots", "discover_failed", "extract_no_headline", "extract_body_too_short", "extract_no_date", "extract_body_is_chrome", "admin_list_failed", "brand_new_kind", "ok")


def _pick(expression: str, words) -> str:
    cases = " ".join(f"WHEN {i} THEN {'NULL' if w is None else repr(w)}" for i, w in enumerate(words))
    return f"CASE CAST(({expression}) % {len(words)} AS INT) {cases} END"


INPUTS: dict[str, str] = {
    "refs": """SELECT page_id AS pos, url AS raw_url, 'https://Example.org/' || CAST(page_id % 7 AS STRING) AS target,
        CASE CAST(page_id % 12 AS INT)
          WHEN 0 THEN url
          WHEN 1 THEN 'HTTPS://WWW.News' || CAST(page_id % 40 AS STRING) || '.co.uk:443//press-releases//2026/08/0' || CAST(1 + page_id % 9 AS STRING) || '/mayor-opens-new-bridge/?b=2&utm_source=x&a=1#top'
          WHEN 2 THEN 'http://site' || CAST(page_id % 40 AS STRING) || '.edu:80/news/' || CAST(page_id AS STRING) || '/'
          WHEN 3 THEN 'https://www.gov.uk/government/news/' || CAST(2000 + page_id % 26 AS STRING)
          WHEN 4 THEN 'https://site' || CAST(page_id % 40 AS STRING) || '.org/category/page/2?page=' || CAST(page_id AS STRING)
          WHEN 5 THEN 'https://site' || CAST(page_id % 40 AS STRING) || '.com/about/who-we-are/our-long-story'
          WHEN 6 THEN 'https://site' || CAST(page_id % 40 AS STRING) || '.com/about/news/chief-visits-harbour-town.html'
          WHEN 7 THEN 'https://site' || CAST(page_id % 40 AS STRING) || '.gov/events/2026-08/welcome-week-' || CAST(page_id AS STRING)
          WHEN 8 THEN 'https://site' || CAST(page_id % 40 AS STRING) || '.com/node/' || CAST(350000 + page_id AS STRING)
          WHEN 9 THEN 'https://site' || CAST(page_id % 40 AS STRING) || '.com/newsroom'
          WHEN 10 THEN 'https://a.b.site' || CAST(page_id % 40 AS STRING) || '.com.au:8443/20260817/first_second_third?ref=q&z'
          ELSE 'site' || CAST(page_id AS STRING) || ' no url' END AS url
      FROM pages""",
    "articles": f"""SELECT doc_id, CASE WHEN doc_id % 31 = 0 THEN NULL ELSE CAST(doc_id % 60 AS INT) END AS a_id, source AS domain,
        'https://www.' || source || '.example.org/' || lang || '/news/' || CAST(doc_id % 700 AS STRING) || '-story-of-day' AS url,
        text AS body, substr(text, 1, 60) AS headline, length(text) AS body_len,
        CASE WHEN doc_id % 9 = 0 THEN NULL ELSE CAST(DATE '2026-08-29' - CAST(doc_id % 200 AS INT) AS TIMESTAMP) END AS published_at,
        CAST(DATE '2026-08-29' - CAST(doc_id % 100 AS INT) AS TIMESTAMP) AS first_seen_at,
        {_pick("doc_id", (None, "loaded", "rejected:too_short", "error", "loaded"))} AS tns_state
      FROM documents""",
    "targets": f"""SELECT CAST(c_custkey % 300 AS INT) AS a_id, 'site' || CAST(c_custkey % 500 AS STRING) || '.org' AS domain,
        'https://site' || CAST(c_custkey % 500 AS STRING) || '.org/news/' || CAST(c_custkey AS STRING) AS newsroom_url,
        c_custkey % 13 <> 0 AS enabled, {_pick("c_custkey", (None, "rss", "sitemap", "listing", "cms_api"))} AS discovery_method,
        CASE WHEN c_custkey % 5 = 1 THEN 'feed' || CAST(c_custkey AS STRING) ELSE NULL END AS feed_url, c_custkey % 5 = 2 AS feed_absent,
        CAST(NULL AS TIMESTAMP) AS probed_at, CASE WHEN c_custkey % 3 = 0 THEN 'etag' ELSE NULL END AS etag, CAST(NULL AS STRING) AS last_modified,
        CAST(c_custkey % 6 AS INT) AS consec_failures, c_custkey % 19 = 0 AS needs_browser,
        {_pick("c_custkey", ("refused", "unresolved", "challenge", "js_rendered", *[None] * 20))} AS access,
        CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE CAST(DATE '2026-08-29' - CAST(c_custkey % 40 AS INT) AS TIMESTAMP) END AS last_success_at,
        CAST(DATE '2026-08-25' + CAST(c_custkey % 9 AS INT) AS TIMESTAMP) AS next_due_at, CAST(2 + c_custkey % 8 AS DOUBLE) AS crawl_delay_s, CAST(43200 * (1 + c_custkey % 3) AS INT) AS revisit_period_s
      FROM customer""",
    "domain_state": """SELECT 'd' || CAST(c_custkey AS STRING) AS domain, CAST(c_custkey * 7 % 1024 AS INT) AS shard, c_custkey % 13 <> 0 AS enabled,
        CAST(DATE '2026-08-25' + CAST(c_custkey % 9 AS INT) AS TIMESTAMP) AS next_allowed_at,
        CASE WHEN c_custkey % 5 = 0 THEN CAST(DATE '2026-08-28' + CAST(c_custkey % 4 AS INT) AS TIMESTAMP) ELSE TIMESTAMP '1970-01-01 00:00:00' END AS leased_until,
        CAST(NULL AS STRING) AS lease_owner, CAST(c_custkey % 9 AS INT) AS consec_failures, 86400 AS revisit_period_s, CAST(5 AS DOUBLE) AS crawl_delay_s,
        CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE CAST(DATE '2026-08-20' AS TIMESTAMP) END AS last_success_at, c_custkey % 19 = 0 AS needs_browser, CAST(NULL AS STRING) AS access
      FROM customer""",
    "occurrences": f"""SELECT 'run-' || CAST(CAST(ts AS DATE) AS STRING) AS run_id, {_pick("event_id * 7 + user_id", _KINDS)} AS kind, 'host' || CAST(user_id % 60 AS STRING) AS domain,
        CASE WHEN user_id % 11 = 0 THEN NULL ELSE CAST(user_id % 60 AS INT) END AS a_id, 1 + event_id % 3 AS n, event_id AS seq, CAST(ts AS TIMESTAMP) AS stamp,
        'https://host' || CAST(user_id % 60 AS STRING) || '/' || CAST(event_id AS STRING) AS url, CASE WHEN event_id % 4 = 0 THEN NULL ELSE 'detail ' || CAST(event_id AS STRING) END AS detail
      FROM events""",
    "responses": f"""SELECT event_id, 'host' || CAST(user_id % 60 AS STRING) AS domain, CAST(ts AS TIMESTAMP) AS stamp, {_pick("event_id", (200, 200, 304, 404, 503, 403, 0, 0, 0, 0, 0, 200, 301))} AS status,
        {_pick("event_id", (None, None, None, None, None, None, "DNSError: no answer", "CertificateVerifyError: expired", "HTTPError: HTTP/2 stream", "Timeout: read", "robots-disallow", None, None))} AS error,
        CASE WHEN event_id % 13 = 11 THEN 'Just a moment...' ELSE NULL END AS wall, event_id % 13 = 2 AS from_cache, value AS elapsed_s FROM events""",
    "measurements": f"""SELECT o_orderkey AS a_id, 'site' || CAST(o_orderkey AS STRING) || {_pick("o_orderkey", (".edu", ".gov", ".org", ".com", ".edu"))} AS domain, o_orderkey % 10 <> 0 AS reachable,
        CASE WHEN o_orderkey % 10 = 0 THEN {_pick("o_custkey", ("robots", "dns", "circuit", "http_4xx", "timeout"))} ELSE NULL END AS unreachable_kind, CAST(404 AS INT) AS status,
        {_pick("o_orderkey", ("rss", "sitemap", "listing", "cms_api", "none", "rss", "news_sitemap"))} AS method, CAST(o_custkey % 23 AS INT) AS n_articles, CAST(o_custkey % 61 AS INT) AS n_page_links,
        CASE WHEN o_orderkey % 8 = 0 THEN NULL ELSE CAST(o_custkey % 11 AS DOUBLE) / 10 END AS overlap, CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE CAST(o_orderkey % 21 AS DOUBLE) / 20 END AS concentration,
        '/news' AS top_prefix, CAST(o_orderkey % 6 AS INT) AS n_non_news, CASE WHEN o_orderkey % 17 = 0 THEN 2 ELSE 0 END AS n_off_domain, CASE WHEN o_orderkey % 14 = 0 THEN 1 ELSE 0 END AS n_seed_echo,
        o_orderkey % 5 <> 0 AS scoped, CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_custkey % 12 <> 0 END AS extracted, CAST(500 AS INT) AS extract_status,
        o_custkey % 5 <> 0 AS got_headline, o_custkey % 6 <> 0 AS got_body, o_custkey % 7 <> 0 AS got_date, CAST(o_custkey % 900 AS INT) AS body_chars, (o_custkey % 5 <> 0 AND o_custkey % 6 <> 0 AND o_custkey % 7 <> 0) AS usable
      FROM orders""",
}

_PROSE = "repeat('The council of the town opened a new bridge over the river on Monday, and the mayor said that it would help people get to work. ', 6)"
#: Braces as chr(), since Spark's parameters are written in braces too.
_LD = """'<script type="application/ld+json">' || chr(123) || '"@type": "{0}", "{1}": "{2} ' || CAST(doc_id AS STRING) || '", "datePublished": "{3}"' || chr(125) || '</script>'"""
_ID = "CAST(doc_id AS STRING)"
INPUTS |= {
    "article_pages": f"""SELECT doc_id AS page_id, 'https://site.org/' || CASE WHEN doc_id % 8 = 5 THEN '2026/08/17/' ELSE 'news/' END || {_ID} || '-story-of-day' AS url,
        CASE CAST(doc_id % 8 AS INT)
          WHEN 0 THEN '<title>Bridge number ' || {_ID} || ' opens | Newsroom</title>'
          WHEN 1 THEN '<title>Other title of page</title>' || {_LD.format("NewsArticle", "headline", "Structured headline", "2026-08-11")}
          WHEN 2 THEN '<meta property="og:title" content="News | Site ' || {_ID} || '"><meta property="og:site_name" content="Site ' || {_ID} || '"><meta property="article:published_time" content="2026-08-20T10:00:00Z"><title>Harbour plan ' || {_ID} || ' wins the vote - Site ' || {_ID} || '</title>'
          WHEN 3 THEN '<meta property="og:title" content="Mayor wins - a story of hope ' || {_ID} || '"><time pubdate datetime="2026-08-12">today</time>'
          WHEN 4 THEN {_LD.format("WebPage", "name", "Weak name", "2026-08-17")} || '<time class="x published">August 5, 2026</time>'
          WHEN 5 THEN '<meta name="twitter:title" content="Card title ' || {_ID} || '">'
          WHEN 6 THEN '<h1>The bridge over the river ' || {_ID} || '</h1><p>Posted on August 21, 2026</p>'
          ELSE '' END || CASE WHEN doc_id % 8 = 7 THEN '' ELSE '<article><p>' || {_PROSE} || '</p></article>' END AS html
      FROM documents""",
    "walls": f"""SELECT doc_id, CASE CAST(doc_id % 5 AS INT) WHEN 0 THEN '<html><title>Just a moment...</title>' WHEN 1 THEN '<p>x</p><script src="https://x.AwsWaf.com/a.js"></script>' WHEN 2 THEN '<title lang="en"> Access Denied </title>'
          WHEN 3 THEN '<title>News of the day</title>' || repeat('x', 9000) || 'awswaf' ELSE '<title>News</title><p>just a moment</p>' END AS html FROM documents""",
    "solved": """SELECT 't' || CAST(c_custkey AS STRING) AS target, CASE WHEN c_custkey % 3 = 0 THEN 'https://site.org/' ELSE 'https://site.org/News/' END AS newsroom_url,
        CASE CAST(c_custkey % 4 AS INT) WHEN 0 THEN 'cms_api' WHEN 1 THEN 'rss' WHEN 2 THEN 'sitemap' ELSE 'listing' END AS discovery_method,
        CASE WHEN c_custkey % 12 < 6 THEN 'https://site.org/feed' WHEN c_custkey % 3 = 1 THEN 'https://site.org/news/feed/' ELSE 'https://site.org/other/feed.xml' END AS feed_url FROM customer""",
    "sites": """SELECT c_custkey AS site_id, 'site' || CAST(c_custkey AS STRING) || '.org' AS domain, c_custkey % 11 <> 0 AS ok, CAST(CASE WHEN c_custkey % 7 = 0 THEN 404 ELSE 200 END AS INT) AS newsroom_status,
        CASE WHEN c_custkey % 13 = 0 THEN 'just a moment' ELSE NULL END AS wall, c_custkey % 17 <> 0 AS robots_allows, CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE '10.0.0.' || CAST(c_custkey % 97 AS STRING) END AS resolved_ip,
        c_custkey % 10 = 0 AS has_news_sitemap, CASE WHEN c_custkey % 4 = 0 THEN 'https://s/sitemap.xml' ELSE NULL END AS sitemap_url, CASE WHEN c_custkey % 3 = 0 THEN 'https://s/feed' ELSE NULL END AS feed_url,
        CASE CAST(c_custkey % 6 AS INT) WHEN 0 THEN 'autodiscovery' WHEN 3 THEN 'probe' ELSE NULL END AS feed_source, c_custkey % 12 = 0 AS feed_full, CASE WHEN c_custkey % 9 = 0 THEN 'https://s/wp-json' ELSE NULL END AS cms_api_url,
        CASE WHEN c_custkey % 10 = 0 THEN 'news_sitemap' WHEN c_custkey % 9 = 0 THEN 'cms_api' WHEN c_custkey % 3 = 0 THEN 'rss' WHEN c_custkey % 4 = 0 THEN 'sitemap' ELSE 'listing' END AS discovery_method,
        c_custkey % 3 = 1 AS wp_detected, c_custkey % 2 = 0 AS wp_json_reachable, CAST(CASE WHEN c_custkey % 8 = 0 THEN 500 ELSE 200 END AS INT) AS article_status, c_custkey % 5 = 1 AS has_jsonld, c_custkey % 6 = 1 AS jsonld_has_headline, c_custkey % 7 = 1 AS jsonld_has_date,
        c_custkey % 50 = 1 AS jsonld_has_articlebody, CAST(c_custkey * 37 % 5000 AS INT) AS text_chars, c_custkey % 14 = 0 AS needs_browser, c_custkey % 15 = 0 AS has_hydration_payload FROM customer""",
    "legacy": """SELECT CASE WHEN o_orderkey % 19 = 0 THEN 'x' || CAST(o_orderkey AS STRING) ELSE CAST(o_orderkey % 5000 AS STRING) END AS a_id, CASE WHEN o_orderkey % 23 = 0 THEN 'nothing' ELSE 'https://site' || CAST(o_custkey AS STRING) || '.org/news' END AS newsroom_url,
        CAST(CASE WHEN o_orderkey % 29 = 0 THEN 2 ELSE 3 END AS INT) AS fields FROM orders""",
    "agency_rows": """SELECT c_custkey AS a_id, CASE WHEN c_custkey % 11 = 0 THEN '' ELSE ' p' || CAST(c_custkey AS STRING) END AS filename, CASE WHEN c_custkey % 7 = 0 THEN NULL WHEN c_custkey % 2 = 0 THEN 'WASHINGTON, DATE -- ' ELSE 'No dateline' END AS leads,
        CAST(c_nationkey AS INT) AS ug_id, CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_name END AS agency_name FROM customer""",
    "group_rows": """SELECT CAST(n_nationkey AS INT) AS ug_id, CASE WHEN n_nationkey % 3 = 0 THEN '' ELSE 'user' || CAST(n_nationkey AS STRING) END AS uname, n_name AS descrip FROM nation""",
    "wire": f"""SELECT doc_id AS pr_id, CASE WHEN doc_id % 17 = 0 THEN '' ELSE {_pick("doc_id", ("D", "P", None, "D"))} END AS status, CAST(DATE '2026-08-29' - CAST(doc_id % 3 AS INT) AS TIMESTAMP) AS create_date, '$H ' || {_ID} AS filename, CAST(doc_id % 60 AS INT) AS a_id FROM documents""",
    "requests": """SELECT CAST(o_orderkey % 400 AS INT) AS a_id, CASE WHEN o_orderkey % 13 = 0 THEN 'nowhere' ELSE 'https://www.site' || CAST(o_custkey % 200 AS STRING) || '.org/news/' END AS newsroom_url, o_orderkey AS seq FROM orders""",
}

_TABLES = ("nation", "pages", "documents", "customer", "events", "orders")


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One derived table; the scan reads only the columns that the query needs."""
    sql = INPUTS[name]
    table = next(t for t in _TABLES if sql.rstrip().endswith(f"FROM {t}"))
    return spark.sql(sql[: sql.rstrip().rindex(table)] + "{source}", source=spark.read.parquet(f"{sf_dir}/{table}.parquet"))


def cte(*names: str) -> str:
    """The same tables as common table expressions for an oracle."""
    return "WITH RECURSIVE " + ", ".join(f"{n} AS ({INPUTS[n]})" for n in names)
