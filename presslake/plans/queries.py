"""Queries over the benchmark tables, one or more for each group of operators, each with its DuckDB SQL."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates, responses, text, urls
from ..operators import articles, audit, extract, faults, frontier, politeness, records, status, validation
from ..schemas import HEALTH_SEVERITY, OWNER, OWNER_WEIGHT, SEVERITY
from ..sources import pages
from .inputs import NOW, cte, load

AS_OF = datetime.fromisoformat(NOW)
QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return register


# ---- SQL twins of the URL and vocabulary expressions
def _sql_map(column: str, values: dict, unknown) -> str:
    cases = " ".join(f"WHEN '{k}' THEN {v!r}" for k, v in values.items())
    return f"(CASE {column} {cases} ELSE {unknown!r} END)"


def _re(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


_PARTS = r"^(?:([A-Za-z][A-Za-z0-9+.-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#.*)?$"
#: Written by hand: the second levels that the hosts of these tables have.
_SUFFIX = r"'^(co|com|org|net|ac|edu|gov)\.[a-z][a-z]$'"
URL_MACRO = rf"""
u1 AS (SELECT *, regexp_extract(trim(url), '{_PARTS}', 1) AS p1, regexp_extract(trim(url), '{_PARTS}', 2) AS p2, regexp_extract(trim(url), '{_PARTS}', 3) AS p3, regexp_extract(trim(url), '{_PARTS}', 4) AS p4 FROM src),
u2 AS (SELECT *, regexp_replace(lower(regexp_replace(regexp_replace(p2, '^.*@', ''), ':\d*$', '')), '\.+$', '') AS host, regexp_extract(p2, ':(\d+)$', 1) AS port,
   CASE WHEN p1 = '' THEN 'https' ELSE lower(p1) END AS scheme, regexp_replace(p3, '/{{2,}}', '/', 'g') AS pa,
   array_to_string(list_sort(list_transform(list_filter(string_split(p4, '&'), lambda x: x <> '' AND NOT regexp_matches(regexp_extract(x, '^([^=]*)', 1), {_re(urls.JUNK_PARAM)})), lambda x: CASE WHEN contains(x, '=') THEN x ELSE x || '=' END)), '&') AS qs FROM u1),
u3 AS (SELECT *, CASE WHEN starts_with(host, 'www.') AND NOT regexp_matches(substr(host, 5), {_SUFFIX}) AND contains(substr(host, 5), '.') THEN substr(host, 5) ELSE host END AS chost,
   CASE WHEN length(pa) > 1 THEN CASE WHEN regexp_replace(pa, '/+$', '') = '' THEN '/' ELSE regexp_replace(pa, '/+$', '') END WHEN pa = '' THEN '/' ELSE pa END AS cpath FROM u2),
u4 AS (SELECT *, CASE WHEN host = '' THEN '' ELSE scheme || '://' || chost || CASE WHEN port IN ('', '0') OR (scheme = 'https' AND port = '443') OR (scheme = 'http' AND port = '80') THEN '' ELSE ':' || port END || cpath || CASE WHEN qs = '' THEN '' ELSE '?' || qs END END AS canonical,
   string_split(CASE WHEN contains(url, '//') THEN host ELSE regexp_replace(lower(trim(url)), '\.+$', '') END, '.') AS labels FROM u3),
u5 AS (SELECT *, CASE WHEN len(labels) <= 2 OR regexp_matches(array_to_string(labels, '.'), '^[\d.]+$') OR contains(array_to_string(labels, '.'), ':') THEN array_to_string(labels, '.')
   WHEN regexp_matches(array_to_string(labels[-2:], '.'), {_SUFFIX}) THEN array_to_string(labels[greatest(len(labels) - 2, 1):], '.') ELSE array_to_string(labels[-2:], '.') END AS domain,
   CASE WHEN host = '' THEN '' ELSE cpath END AS cp FROM u4)"""


@query(cte("refs") + ", src AS (SELECT * FROM refs)," + URL_MACRO + r"""
SELECT pos, canonical, host, domain, sha256(canonical) AS url_hash, CASE WHEN contains(domain, '.') THEN '.' || string_split(domain, '.')[-1] ELSE '?' END AS tld,
  coalesce(nullif(regexp_extract(regexp_replace(p3, '/+$', ''), '^(.*)/[^/]*$', 1), ''), '/') AS parent,
  lower(coalesce(list_filter(string_split(p3, '/'), lambda s: s <> '')[-1], '')) AS slug
FROM u5""")
def url_algebra(spark: SparkSession, sf_dir: str) -> DataFrame:
    """URL1-URL6, URL10, URL12, URL15."""
    u = F.col("url")
    d = urls.registrable_domain(u)
    return load(spark, sf_dir, "refs").select("pos", urls.canonical(u).alias("canonical"), urls.host(u).alias("host"), d.alias("domain"), urls.url_hash(u).alias("url_hash"), urls.tld(d).alias("tld"), urls.parent_path(u).alias("parent"), urls.slug(u).alias("slug"))


def _rx(p: str) -> str:
    return f"regexp_matches(cp, {_re(p)})"


_CLASSIFY = f"""
c1 AS (SELECT *, list_filter(string_split(cp, '/'), lambda s: s <> '') AS seg FROM u5),
c2 AS (SELECT *, len(seg) AS n, coalesce(seg[-1], '') AS last, regexp_replace(coalesce(seg[-1], ''), '(?i)\\.(html?|php|aspx?)$', '') AS sl FROM c1),
c3 AS (SELECT *, len(list_filter(regexp_split_to_array(sl, '[-_]'), lambda w: w <> '')) AS words, regexp_matches(sl, '^\\d+$') AS digits, {_rx(urls.NON_ARTICLE_SECTION)} AS hard,
  {_rx(urls.SOFT_NON_NEWS)} AND NOT {_rx(urls.NEWS_SEGMENT)} AS soft, {_rx(urls.DATE_IN_PATH)} OR {_rx(urls.COMPACT_DATE)} AS dated, regexp_matches(sl, {_re(urls.BARE_YEAR)}) AS yr,
  len(list_filter(string_split(qs, '&'), lambda q: regexp_matches(q, '=.') AND regexp_matches(regexp_extract(q, '^([^=]*)', 1), {_re(urls.LISTING_QUERY)}))) > 0 AND host <> '' AS paged FROM c2),
c4 AS (SELECT *, n > 0 AND words >= 3 AND NOT digits AS worded, n > 0 AND digits AND length(sl) >= 4 AS numbered FROM c3),
c5 AS (SELECT *, dated OR worded OR (numbered AND NOT yr) AS signal,
  CASE WHEN {_rx(urls.LISTING_PATH)} THEN -3.0 ELSE 0 END + CASE WHEN hard OR soft THEN -10.0 ELSE 0 END + CASE WHEN paged THEN -3.0 ELSE 0 END + CASE WHEN n > 0 AND regexp_matches(last, {_re(urls.SECTION_INDEX)}) THEN -3.0 ELSE 0 END
  + CASE WHEN dated THEN 2.5 ELSE 0 END + CASE WHEN n >= 3 THEN 0.5 WHEN n <= 1 THEN -1.0 ELSE 0 END + CASE WHEN worded THEN 2.0 ELSE 0 END + CASE WHEN n > 0 AND words = 1 AND NOT digits THEN -0.5 ELSE 0 END
  + CASE WHEN numbered AND yr THEN -3.0 WHEN numbered THEN 1.0 ELSE 0 END AS score FROM c4)"""


@query(cte("refs") + ", src AS (SELECT * FROM refs)," + URL_MACRO + "," + _CLASSIFY + """
SELECT pos, CAST(score AS DOUBLE) AS score, score > 0 AND signal AS is_article, hard OR soft AS non_news FROM c5""")
def url_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """URL7, URL8."""
    rows = load(spark, sf_dir, "refs").withColumn("c", urls.classify(F.col("url")))
    return rows.select("pos", "c.score", "c.is_article", urls.is_non_news(F.col("url")).alias("non_news"))


@query(r"""SELECT doc_id, sha256(trim(regexp_replace(lower(text), '[^a-z0-9]+', ' ', 'g'))) AS content_hash,
  len(list_distinct(regexp_extract_all(lower(text), '[\p{L}\p{N}_]+'))) AS n_words,
  round(list_sum(list_transform(string_split(text, chr(10)), lambda l: CASE WHEN length(l) >= 60 THEN 1 ELSE 0 END)) / len(string_split(text, chr(10))), 6) AS long_lines FROM documents""")
def text_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """EXT12, REC12 and a part of EXT15."""
    t = F.col("text")
    lines = F.split(t, "\n")
    share = F.size(F.filter(lines, lambda x: F.length(x) >= 60)) / F.size(lines)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return docs.select("doc_id", text.content_hash(t).alias("content_hash"), F.size(text.word_set(t)).cast("long").alias("n_words"), F.round(share, 6).alias("long_lines"))


@query()
def text_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """EXT13-EXT17, EXT22, EXT23: cleaned body, prose ratio, coherence (lookbehind keeps the pattern out of DuckDB)."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    body = text.clean_body(F.col("text"))
    ratio = text.prose_ratio(F.col("text"))
    return docs.select("doc_id", F.length(body).alias("body_chars"), ratio.alias("prose_ratio"), (ratio < text.CHROME_BELOW).alias("chrome"), text.coherence(F.substring("text", 1, 60), F.col("text")).alias("coherence"))


@query(cte("articles") + """ SELECT a_id, count(*) AS articles, count(*) FILTER (coalesce(published_at, first_seen_at) >= TIMESTAMP '2026-07-30 12:00:00') AS articles_recent,
  CAST(max(published_at) AS VARCHAR)[1:10] AS last_article, CAST(max(first_seen_at) AS VARCHAR)[1:10] AS last_stored, CAST(min(first_seen_at) AS VARCHAR)[1:10] AS first_stored,
  count(*) FILTER (tns_state = 'loaded') AS tns_loaded, count(*) FILTER (tns_state IS NULL OR tns_state <> 'loaded') AS tns_pending FROM articles WHERE a_id IS NOT NULL GROUP BY a_id""")
def article_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG1, AGG2."""
    rows = load(spark, sf_dir, "articles")
    day = lambda c: F.date_format(c, "yyyy-MM-dd")
    stats = articles.article_stats(rows, AS_OF - timedelta(days=30)).join(articles.inventory_stats(rows), "a_id")
    return stats.select("a_id", "articles", "articles_recent", day("last_article_at").alias("last_article"), day("last_stored_at").alias("last_stored"), day("first_stored_at").alias("first_stored"), "tns_loaded", "tns_pending")


_HASH = "sha256(trim(regexp_replace(lower(coalesce(body, '')), '[^a-z0-9]+', ' ', 'g')))"


@query(cte("articles") + f""", h AS (SELECT *, {_HASH} AS ch FROM articles)
SELECT count(*) AS articles, count(DISTINCT domain) AS domains, (SELECT count(*) FROM (SELECT ch FROM h GROUP BY ch HAVING count(*) > 1)) AS body_text_dupes FROM h""")
def store_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG3."""
    return articles.store_stats(load(spark, sf_dir, "articles").withColumn("content_hash", text.content_hash(F.col("body"))))


@query(cte("articles") + " SELECT coalesce(tns_state, 'not attempted') AS state, count(*) AS n FROM articles GROUP BY 1")
def load_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG3, AGG19."""
    return articles.by_state(load(spark, sf_dir, "articles"))


@query(cte("articles") + f""", h AS (SELECT *, {_HASH} AS ch FROM articles), s AS (SELECT * FROM h WHERE doc_id % 2 = 0), i AS (SELECT * FROM h WHERE doc_id % 2 = 1),
f AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY first_seen_at, url, headline) AS rn FROM i) WHERE rn = 1 AND url NOT IN (SELECT url FROM s)),
t AS (SELECT ch, arg_min(url, CAST(first_seen_at AS VARCHAR) || url) AS twin_url FROM s GROUP BY ch)
SELECT f.url, CAST(f.first_seen_at AS VARCHAR)[1:10] AS seen, t.twin_url FROM f LEFT JOIN t ON f.ch = t.ch""")
def store_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK1, JN6, JN7: odd rows are written to a store of the even ones."""
    rows = articles.keyed(load(spark, sf_dir, "articles"))
    stored, incoming = rows.where("doc_id % 2 = 0"), rows.where("doc_id % 2 = 1")
    new = articles.twins(articles.new_articles(incoming, stored), stored)
    return new.select("url", F.date_format("first_seen_at", "yyyy-MM-dd").alias("seen"), "twin_url")


_FAULTS = f""", o AS (SELECT run_id, kind, domain, sum(n) AS n, min(stamp) AS first_at, arg_min(detail, seq) FILTER (detail IS NOT NULL) AS any_detail FROM occurrences GROUP BY ALL),
f AS (SELECT *, {_sql_map("kind", SEVERITY, 3)} AS sev, {_sql_map("kind", OWNER, "us")} AS own FROM o)"""


def _faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    return faults.record(load(spark, sf_dir, "occurrences").withColumnRenamed("stamp", "at"))


@query(cte("occurrences") + """ SELECT run_id, kind, domain, CAST(sum(n) AS BIGINT) AS n, strftime(min(stamp), '%Y-%m-%d %H:%M:%S') AS first_at, strftime(max(stamp), '%Y-%m-%d %H:%M:%S') AS last_at FROM occurrences GROUP BY ALL""")
def fault_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK9, AGG18."""
    at = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c)
    return _faults(spark, sf_dir).select("run_id", "kind", "domain", "n", at("first_at"), at("last_at"))


@query(cte("occurrences") + _FAULTS + f""" SELECT kind, count(DISTINCT domain) AS breadth, CAST(sum(n) AS BIGINT) AS occurrences, any_value(sev) AS severity, any_value(own) AS owner,
  CAST(any_value(sev) * count(DISTINCT domain) * {_sql_map("any_value(own)", OWNER_WEIGHT, 1.0)} AS DOUBLE) AS score,
  CASE WHEN any_value(sev) * count(DISTINCT domain) * {_sql_map("any_value(own)", OWNER_WEIGHT, 1.0)} >= 18 THEN 'urgent' WHEN any_value(sev) * count(DISTINCT domain) * {_sql_map("any_value(own)", OWNER_WEIGHT, 1.0)} >= 10 THEN 'notable' ELSE 'minor' END AS band,
  array_to_string(list_sort(list_distinct(list(domain))), ',') AS domains FROM f GROUP BY kind""")
def fault_tally(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG6, CLS3, ORD4."""
    return faults.tally(_faults(spark, sf_dir)).select("kind", "breadth", "occurrences", "severity", "owner", "score", "band", F.array_join("domains", ",").alias("domains"))


@query(cte("occurrences") + _FAULTS + """ SELECT count(DISTINCT kind) AS kinds, count(DISTINCT domain) AS domains, CAST(sum(n) AS BIGINT) AS occurrences,
  CAST(coalesce(sum(n) FILTER (own = 'us'), 0) AS BIGINT) AS us, CAST(coalesce(sum(n) FILTER (own = 'site'), 0) AS BIGINT) AS site, CAST(coalesce(sum(n) FILTER (own = 'policy'), 0) AS BIGINT) AS policy FROM f""")
def fault_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG7, AGG12."""
    return faults.summarise(_faults(spark, sf_dir))


@query(cte("occurrences") + _FAULTS + """, k AS (SELECT DISTINCT domain, kind, sev FROM f WHERE own <> 'policy' AND kind NOT IN ('ok', 'not_modified'))
SELECT domain, CAST(sum(sev) AS BIGINT) AS score, array_to_string(list_sort(list(kind)), ',') AS kinds FROM k GROUP BY domain ORDER BY score DESC, domain LIMIT 10""")
def fault_worst_domains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG8."""
    return faults.worst_domains(_faults(spark, sf_dir)).withColumn("kinds", F.array_join("kinds", ","))


@query(cte("occurrences") + _FAULTS + """, r AS (SELECT DISTINCT run_id FROM f ORDER BY run_id DESC LIMIT 30), p AS (SELECT f.* FROM f JOIN r USING (run_id))
SELECT run_id, count(*) AS faults, CAST(sum(n) AS BIGINT) AS n FROM p GROUP BY run_id""")
def fault_retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK11, ORD5."""
    rows = _faults(spark, sf_dir)
    runs = rows.groupBy("run_id").agg(F.first("run_id").alias("started_at"))
    return faults.prune(rows, runs)[0].groupBy("run_id").agg(F.count("*").alias("faults"), F.sum("n").alias("n"))


@query(cte("occurrences") + """, o AS (SELECT DISTINCT kind, domain FROM occurrences)
SELECT CAST(substr(domain, 5) AS INT) AS host, max(""" + _sql_map("kind", SEVERITY, 3) + """) AS severity FROM o GROUP BY 1""")
def fault_severity_by_host(spark: SparkSession, sf_dir: str) -> DataFrame:
    """HLP3, the ranking key of AGG9."""
    return _faults(spark, sf_dir).groupBy(F.substring("domain", 5, 9).cast("int").alias("host")).agg(F.max(faults.severity(F.col("kind"))).alias("severity"))


_ACC = _sql_map("access", {"js_rendered": 1, "unresolved": 2, "challenge": 3, "refused": 4}, 0)
_FOLD = f""", w AS (SELECT *, row_number() OVER o AS rn, max(last_success_at) OVER (PARTITION BY a_id ORDER BY domain, newsroom_url ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS bef FROM targets WINDOW o AS (PARTITION BY a_id ORDER BY domain, newsroom_url)),
b AS (SELECT *, CASE WHEN rn = 1 OR (last_success_at IS NOT NULL AND (bef IS NULL OR last_success_at > bef)) THEN rn END AS k FROM w),
g AS (SELECT a_id, arg_min(domain, rn) AS domain, arg_max(newsroom_url, k) AS newsroom_url, arg_max(discovery_method, CASE WHEN discovery_method IS NOT NULL THEN k END) AS discovery_method, count(*) AS targets, count(discovery_method) AS targets_cached,
  bool_or(enabled) AS enabled, bool_or(needs_browser) AS needs_browser, max(consec_failures) AS consec_failures, max({_ACC}) AS acc, max(last_success_at) AS ls, max(crawl_delay_s) AS crawl_delay_s, max(revisit_period_s) AS revisit_period_s FROM b GROUP BY a_id),
s AS (SELECT a_id, count(*) AS articles, count(*) FILTER (coalesce(published_at, first_seen_at) >= TIMESTAMP '2026-07-30 12:00:00') AS articles_recent, max(published_at) AS la, max(first_seen_at) AS lst FROM articles WHERE a_id IS NOT NULL GROUP BY a_id),
j AS (SELECT g.*, coalesce(articles, 0) AS articles, coalesce(articles_recent, 0) AS articles_recent, la, greatest(ls, lst) AS lsu FROM g LEFT JOIN s USING (a_id)),
d AS (SELECT *, CAST(floor((epoch(TIMESTAMP '{NOW}') - epoch(lsu)) / 86400) AS INT) AS age, CAST(floor((epoch(TIMESTAMP '{NOW}') - epoch(la)) / 86400) AS INT) AS art FROM j),
h AS (SELECT *, CASE WHEN NOT enabled THEN 'disabled' WHEN lsu IS NULL THEN 'never' WHEN acc = 4 THEN 'refused' WHEN acc = 2 THEN 'unresolved' WHEN consec_failures >= 3 THEN 'failing' WHEN needs_browser OR acc IN (1, 3) THEN 'blocked'
  WHEN age >= 14 THEN 'stale' WHEN articles = 0 THEN 'empty' WHEN art >= 90 THEN 'quiet' ELSE 'healthy' END AS health FROM d),
e AS (SELECT *, {_sql_map("health", HEALTH_SEVERITY, "warn")} AS severity FROM h)"""


def _grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = load(spark, sf_dir, "articles")
    return status.compose(load(spark, sf_dir, "targets"), articles.article_stats(stored, AS_OF - timedelta(days=30)), articles.inventory_stats(stored), AS_OF)


@query(cte("targets", "articles") + _FOLD + " SELECT a_id, domain, newsroom_url, discovery_method, targets, targets_cached, consec_failures, articles, articles_recent, crawl_delay_s, revisit_period_s, health, severity FROM e")
def status_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG5, CLS1, CLS2, JN1, JN4."""
    return _grid(spark, sf_dir).select("a_id", "domain", "newsroom_url", "discovery_method", "targets", "targets_cached", "consec_failures", "articles", "articles_recent", "crawl_delay_s", "revisit_period_s", "health", "severity")


@query(cte("targets", "articles") + _FOLD + """, m AS (SELECT 'health' AS kind, health AS word, count(*) AS n FROM e GROUP BY health UNION ALL SELECT 'severity', severity, count(*) FROM e GROUP BY severity)
SELECT * FROM m UNION ALL SELECT 'severity', b, 0 FROM (VALUES ('error'), ('warn'), ('ok')) v(b) WHERE b NOT IN (SELECT word FROM m WHERE kind = 'severity')""")
def status_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG10, AGG11."""
    return status.summary(_grid(spark, sf_dir))


@query(cte("targets", "articles") + _FOLD + " SELECT a_id, health, articles FROM e WHERE severity = 'error' AND (contains(lower(newsroom_url), 'site1') OR contains(lower(domain), 'site1')) ORDER BY domain NULLS LAST, a_id LIMIT 25 OFFSET 2")
def status_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRD10, ORD2, ORD3, AGG23."""
    rows = status.order(status.select(_grid(spark, sf_dir), severity="error", text="Site1"), "domain")
    return status.page(rows, 25, 2).select("a_id", "health", "articles")


_FIND = """, v AS (SELECT *, coalesce(unreachable_kind, '') AS uk FROM measurements),
c AS (SELECT *, list_filter([
  CASE WHEN NOT reachable AND uk IN ('dns', 'circuit') THEN {'c': uk, 's': 1} END, CASE WHEN NOT reachable AND uk NOT IN ('robots', 'dns', 'circuit') THEN {'c': 'unreachable', 's': 3} END,
  CASE WHEN reachable AND n_articles = 0 THEN {'c': 'no_articles', 's': 3} END,
  CASE WHEN reachable AND n_articles > 0 AND overlap IS NOT NULL AND n_page_links < 20 THEN {'c': 'page_too_thin', 's': 1} END,
  CASE WHEN reachable AND n_articles > 0 AND n_page_links >= 20 AND overlap = 0 THEN {'c': 'no_overlap', 's': 3} END, CASE WHEN reachable AND n_articles > 0 AND n_page_links >= 20 AND overlap > 0 AND overlap < 0.2 THEN {'c': 'low_overlap', 's': 2} END,
  CASE WHEN reachable AND n_articles > 0 AND concentration < 0.4 THEN {'c': 'scattered', 's': 2} END, CASE WHEN reachable AND n_articles > 0 AND n_non_news / n_articles > 0.3 THEN {'c': 'non_news_heavy', 's': 2} END,
  CASE WHEN reachable AND n_articles > 0 AND n_off_domain > 0 THEN {'c': 'off_domain', 's': 3} END, CASE WHEN reachable AND n_articles > 0 AND n_seed_echo > 0 THEN {'c': 'seed_echo', 's': 1} END,
  CASE WHEN reachable AND n_articles > 0 AND NOT scoped THEN {'c': 'unscoped', 's': 1} END, CASE WHEN reachable AND n_articles > 0 AND method = 'listing' THEN {'c': 'last_resort', 's': 1} END,
  CASE WHEN reachable AND n_articles > 0 AND NOT extracted THEN {'c': 'article_unfetchable', 's': 3} END, CASE WHEN reachable AND n_articles > 0 AND extracted AND NOT usable THEN {'c': 'extract_failed', 's': 3} END], lambda x: x IS NOT NULL) AS fs FROM v),
k AS (SELECT *, coalesce(list_sum(list_transform(fs, lambda x: x.s)), 0) AS sc, array_to_string(list_transform(fs, lambda x: x.c), ',') AS codes FROM c),
a AS (SELECT *, CASE WHEN len(list_filter(fs, lambda x: x.s >= 3)) > 0 THEN 'broken' WHEN sc >= 2 THEN 'suspicious' WHEN sc >= 1 THEN 'check' ELSE 'ok' END AS verdict FROM k)"""


def _judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.judge(load(spark, sf_dir, "measurements"))


@query(cte("measurements") + _FIND + " SELECT a_id, codes, CAST(sc AS INT) AS score, verdict FROM a")
def audit_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CLS4, CLS5, CLS8."""
    return _judged(spark, sf_dir).select("a_id", F.array_join(F.transform("findings", lambda f: f["code"]), ",").alias("codes"), "score", "verdict")


@query(cte("measurements") + _FIND + """ SELECT count(*) AS targets, count(*) FILTER (verdict = 'broken') AS broken, count(*) FILTER (verdict = 'suspicious') AS suspicious, count(*) FILTER (verdict = 'check') AS "check", count(*) FILTER (verdict = 'ok') AS ok,
  list_sort(list(overlap) FILTER (overlap IS NOT NULL))[CAST(floor(count(overlap) / 2) AS INT) + 1] AS median_overlap, count(*) FILTER (reachable AND n_articles = 0) AS zero_yield, count(*) FILTER (NOT reachable) AS unreachable,
  round(100.0 * count(*) FILTER (verdict = 'ok') / count(*), 1) AS pct_clean FROM a""")
def audit_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG13."""
    return audit.summarise(_judged(spark, sf_dir))


@query(cte("measurements") + _FIND + """ SELECT 'verdict' AS kind, verdict AS word, count(*) AS n FROM a GROUP BY ALL UNION ALL SELECT 'method', method, count(*) FROM a GROUP BY ALL
UNION ALL SELECT 'finding', c, count(*) FROM (SELECT unnest(list_transform(fs, lambda x: x.c)) AS c FROM a) GROUP BY ALL""")
def audit_histograms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG13, AGG21."""
    return audit.histogram(_judged(spark, sf_dir))


@query(cte("measurements") + _FIND + """ SELECT '.' || string_split(domain, '.')[-1] AS tld, count(*) AS targets, count(*) FILTER (verdict = 'ok') AS ok, count(*) FILTER (verdict IN ('ok', 'check')) AS workable,
  round(100.0 * count(*) FILTER (verdict IN ('ok', 'check')) / count(*), 1) AS pct_workable FROM a GROUP BY 1""")
def audit_by_tld(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG14, AGG22."""
    return audit.by_tld(_judged(spark, sf_dir))


@query(cte("measurements") + _FIND + """ SELECT count(*) AS probed, count(*) FILTER (extracted) AS article_fetched, count(*) FILTER (extracted AND got_headline) AS got_headline, count(*) FILTER (extracted AND got_body) AS got_body,
  count(*) FILTER (extracted AND got_date) AS got_date, count(*) FILTER (extracted AND usable) AS usable, round(100.0 * count(*) FILTER (extracted) / count(*), 1) AS pct_fetched, round(100.0 * count(*) FILTER (extracted AND usable) / count(*), 1) AS pct_usable_of_probed FROM a WHERE extracted IS NOT NULL""")
def audit_funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG15."""
    return audit.funnel(_judged(spark, sf_dir))


_DUE = f"enabled AND leased_until <= TIMESTAMP '{NOW}' AND next_allowed_at <= TIMESTAMP '{NOW}'"


@query(cte("domain_state") + f" SELECT domain, shard FROM domain_state WHERE shard >= 100 AND shard < 900 AND {_DUE} ORDER BY next_allowed_at, domain LIMIT 20")
def frontier_due(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ORD1, FRN2."""
    return frontier.due(load(spark, sf_dir, "domain_state"), AS_OF, 20, (100, 900)).select("domain", "shard")


@query(cte("domain_state", "targets") + f""" SELECT count(*) AS domains, count(*) FILTER (enabled) AS enabled, count(*) FILTER ({_DUE}) AS due, count(*) FILTER (leased_until > TIMESTAMP '1970-01-01') AS leased,
  count(*) FILTER (consec_failures > 0) AS failing, count(*) FILTER (needs_browser) AS needs_browser, count(last_success_at) AS succeeded, (SELECT count(*) FROM targets) AS targets FROM domain_state""")
def frontier_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG4."""
    return frontier.stats(load(spark, sf_dir, "domain_state"), load(spark, sf_dir, "targets"), AS_OF)


@query(cte("domain_state") + f""" SELECT domain, CASE WHEN c % 3 = 0 THEN consec_failures WHEN c % 3 = 1 THEN 0 ELSE consec_failures + 1 END AS consec_failures,
  strftime(CASE WHEN c % 3 = 0 THEN next_allowed_at WHEN c % 3 = 1 THEN TIMESTAMP '{NOW}' + to_seconds(86400) ELSE TIMESTAMP '{NOW}' + to_seconds(CAST(86400 * pow(2, least(consec_failures + 1, 6)) AS BIGINT)) END, '%Y-%m-%d %H:%M:%S') AS next_allowed_at
FROM (SELECT *, CAST(substr(domain, 2) AS BIGINT) AS c FROM domain_state)""")
def frontier_release(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FRN4, PRD9: of three domains one is untouched, one succeeded, one failed."""
    state = load(spark, sf_dir, "domain_state")
    c = F.substring("domain", 2, 20).cast("long")
    state = state.withColumn("access_probed_at", F.lit(None).cast("timestamp"))
    done = frontier.release(state, state.where(c % 3 != 0).select("domain", (c % 3 == 1).alias("ok")), AS_OF)
    return done.select("domain", "consec_failures", F.date_format("next_allowed_at", "yyyy-MM-dd HH:mm:ss").alias("next_allowed_at"))


_KIND = """CASE WHEN coalesce(wall, '') <> '' THEN 'wall' WHEN starts_with(error, 'robots-disallow') THEN 'robots' WHEN starts_with(error, 'circuit-open') THEN 'circuit' WHEN starts_with(error, 'DNSError') THEN 'dns'
  WHEN regexp_matches(error, '^(SSLError|CertificateVerifyError)') THEN 'tls' WHEN starts_with(error, 'HTTPError') AND contains(error, 'HTTP/2') THEN 'http2' WHEN regexp_matches(error, '^(ConnectionError|ConnectTimeout)') THEN 'connect'
  WHEN regexp_matches(error, '^(Timeout|browser-timeout)') THEN 'timeout' WHEN coalesce(error, '') <> '' THEN 'error' WHEN from_cache THEN 'not_modified' WHEN status BETWEEN 200 AND 299 THEN 'ok' WHEN status BETWEEN 400 AND 499 THEN 'http_4xx' WHEN status >= 500 THEN 'http_5xx' ELSE 'error' END"""


@query(cte("responses") + f" SELECT {_KIND} AS kind, count(*) AS n, count(DISTINCT domain) AS domains FROM responses GROUP BY 1")
def failure_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRD1, PRD2."""
    kind = responses.failure_kind(*map(F.col, ("wall", "error", "from_cache", "status")))
    return load(spark, sf_dir, "responses").groupBy(kind.alias("kind")).agg(F.count("*").alias("n"), F.count_distinct("domain").alias("domains"))


@query(cte("responses") + """ SELECT event_id, CASE WHEN len(l) >= 5 THEN list_sort(l)[CAST(floor(len(l) / 2) AS INT) + 1] END AS p50 FROM
  (SELECT event_id, list(elapsed_s) OVER (PARTITION BY domain ORDER BY stamp, event_id ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS l FROM responses)""")
def latency_medians(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG24."""
    return politeness.rolling_median(load(spark, sf_dir, "responses").withColumnsRenamed({"stamp": "at"}).withColumn("url", F.col("event_id"))).select("event_id", "p50")


@query()
def adaptive_pacing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FRN9: an ordered fold, which SQL can't say."""
    rows = load(spark, sf_dir, "responses")
    at = F.col("stamp").cast("double")
    return politeness.paced(rows.select("domain", F.lpad(F.col("event_id").cast("string"), 12, "0").alias("event"), at.alias("at_s"), "status", "wall", F.lit(None).cast("double").alias("retry_after_s"), "elapsed_s", "from_cache"))


@query(cte("refs") + """, r AS (SELECT page_id, 'https://x.org/' || CASE CAST(page_id % 4 AS INT) WHEN 0 THEN '2026/08/' || lpad(CAST(1 + page_id % 28 AS VARCHAR), 2, '0') || '/story' WHEN 1 THEN 'news/2025-11/title' WHEN 2 THEN '20240' || CAST(1 + page_id % 9 AS VARCHAR) || '15-x' ELSE 'none/here' END AS url FROM pages)
SELECT page_id, CASE CAST(page_id % 4 AS INT) WHEN 0 THEN '2026-08-' || lpad(CAST(1 + page_id % 28 AS VARCHAR), 2, '0') WHEN 1 THEN '2025-11-01' WHEN 2 THEN '2024-0' || CAST(1 + page_id % 9 AS VARCHAR) || '-15' END AS found FROM r""")
def dates_in_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """EXT26."""
    i = F.col("page_id")
    s = lambda c: c.cast("string")
    tail = F.when(i % 4 == 0, F.concat(F.lit("2026/08/"), F.lpad(s(1 + i % 28), 2, "0"), F.lit("/story"))).when(i % 4 == 1, F.lit("news/2025-11/title")).when(i % 4 == 2, F.concat(F.lit("20240"), s(1 + i % 9), F.lit("15-x"))).otherwise("none/here")
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", F.concat(F.lit("https://x.org/"), tail).alias("url"))
    return pages.select("page_id", F.date_format(dates.from_url(F.col("url"), AS_OF), "yyyy-MM-dd").alias("found"))


@query(cte("refs") + ", src AS (SELECT * FROM refs)," + URL_MACRO + """, p AS (SELECT target, coalesce(nullif(regexp_extract(regexp_replace(p3, '/+$', ''), '^(.*)/[^/]*$', 1), ''), '/') AS prefix, count(*) AS n, min(pos) AS f FROM u5 GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY target ORDER BY n DESC, f) AS rn, sum(n) OVER (PARTITION BY target) AS t FROM p)
SELECT target, prefix AS top_prefix, round(n / t, 3) AS concentration FROM r WHERE rn = 1""")
def path_concentration(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG17, URL13."""
    return audit.concentration(load(spark, sf_dir, "refs"))


@query()
def validation_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CLS7, JN12, URL11: articles of each domain against every third of them as listing."""
    rows = load(spark, sf_dir, "articles").withColumnRenamed("domain", "target")
    return validation.score(rows, rows.where("doc_id % 3 = 0").select("target", "url"))


def _agencies(spark: SparkSession) -> DataFrame:
    n = F.col("id")
    return spark.range(60).select(n.cast("int").alias("a_id"), F.concat(F.lit("p"), n.cast("string")).alias("prefix"), F.when(n % 10 == 0, F.lit("")).otherwise(F.concat(F.lit("TOWN"), n.cast("string"), F.lit(", DATE -- "))).alias("lede"), F.when(n % 7 == 0, F.lit("-1")).otherwise(F.lit("user")).alias("uname"))


def _built(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = load(spark, sf_dir, "articles")
    return records.build(rows.select("a_id", "headline", "body", F.coalesce("published_at", "first_seen_at").cast("date").alias("published"), "url"), _agencies(spark))


@query()
def wire_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """REC1-REC8, JN5."""
    return _built(spark, sf_dir).select("a_id", "url", "published", "filename", "status", "word_count", "reject_reason", F.sha2("body_txt", 256).alias("body_sha256"))


@query()
def wire_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """REC9, REC10: filename collisions settled rung by rung."""
    rows = _built(spark, sf_dir).where("reject_reason IS NULL")
    none = rows.select("filename", "a_id", "headline").limit(0)
    return records.resolve(rows.select("a_id", "url", "published", "prefix", "headline", "headline_full"), none).select("a_id", "url", "published", "filename", "outcome", "width")


@query(r"""SELECT page_id, trim(regexp_replace(replace(replace(replace(replace(replace(regexp_extract(html, '<h1>(.*?)</h1>', 1), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#x27;', chr(39)), '&amp;', '&'), '\s+', ' ', 'g')) AS h1,
  len(regexp_extract_all(html, '<a href="[^"]+"')) AS n_links, len(regexp_extract_all(html, '<script')) AS scripts FROM pages""")
def page_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """EXT1-EXT6, SRC13: the one parse of each page."""
    facts = pages.parse(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    return facts.select("page_id", "h1", F.size("links").cast("long").alias("n_links"), F.col("scripts").cast("long").alias("scripts"))


@query()
def page_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """EXT7-EXT10, EXT19-EXT32: records with provenance, dates, quality and usability."""
    out = extract.records(pages.parse(spark.read.parquet(f"{sf_dir}/pages.parquet")), AS_OF)
    return out.select("page_id", "headline", "headline_source", "body_source", F.length("body").alias("body_chars"), F.col("date.source").alias("date_source"), "unusable", F.col("browser.needed").alias("needs_browser"), "quality.prose_ratio", F.size("warnings").alias("n_warnings"))
