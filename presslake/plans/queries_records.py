"""Queries of the stores, the frontier, faults, lists and the wire over tables derived from the benchmark tables, each with its DuckDB SQL.

The SQL is written out by hand: it shares no constant with the operators it is held against.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import agencies, articles, faults, frontier, lists, records, status
from ..operators.columns import relative_age
from .inputs import NOW, cte, load
from .queries import AS_OF, _faults, _grid, query


def _day(column: str) -> F.Column:
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss").alias(column)


# ---- agencies
@query(cte("agency_rows", "group_rows") + """ SELECT CAST(a_id AS INT) AS a_id, trim(filename) AS prefix, trim(coalesce(leads, '')) AS lede, nullif(uname, '') AS uname, coalesce(agency_name, '') AS name,
  CASE WHEN starts_with(leads, 'WASHINGTON') THEN 'WASHINGTON' END AS location, trim(filename) <> '' AND leads IS NOT NULL AS usable FROM agency_rows JOIN group_rows USING (ug_id) WHERE descrip LIKE '%A%'""")
def agency_directory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC6, JN2, HLP13."""
    return agencies.directory(load(spark, sf_dir, "agency_rows"), load(spark, sf_dir, "group_rows"), "%A%")


@query(cte("agency_rows", "group_rows") + """, d AS (SELECT a_id, trim(filename) AS p, trim(coalesce(leads, '')) AS l, uname FROM agency_rows JOIN group_rows USING (ug_id) WHERE descrip LIKE '%_1%'), w AS (SELECT DISTINCT a_id FROM agency_rows)
SELECT count(*) AS wanted, count(d.a_id) AS known, count(*) - count(d.a_id) AS missing, count(*) FILTER (d.a_id IS NOT NULL AND coalesce(uname, '') = '') AS no_uname, count(*) FILTER (d.a_id IS NOT NULL AND (p = '' OR l = '')) AS unusable,
  (SELECT coalesce(string_agg(CAST(a_id AS VARCHAR), ',' ORDER BY a_id), '') FROM (SELECT w.a_id FROM w ANTI JOIN d ON w.a_id = d.a_id ORDER BY 1 LIMIT 20)) AS missing_ids FROM w LEFT JOIN d USING (a_id)""")
def agency_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG20."""
    rows = load(spark, sf_dir, "agency_rows")
    out = records.coverage(rows.select(F.col("a_id").cast("int").alias("a_id")), agencies.directory(rows, load(spark, sf_dir, "group_rows"), "%_1%"))
    return out.withColumn("missing_ids", F.array_join("missing_ids", ","))


# ---- frontier
_STATE = f"""CASE WHEN c % 3 = 0 THEN consec_failures WHEN c % 3 = 1 THEN 0 ELSE consec_failures + 1 END"""


@query(cte("targets") + f""", o AS (SELECT newsroom_url, a_id % 2 = 0 AS ok, a_id % 5 = 0 AS absent FROM targets WHERE a_id % 3 <> 0)
SELECT t.newsroom_url, CASE WHEN o.ok IS NULL THEN consec_failures WHEN o.ok THEN 0 ELSE consec_failures + 1 END AS consec_failures, CASE WHEN o.ok THEN TIMESTAMP '{NOW}' ELSE last_success_at END = TIMESTAMP '{NOW}' AS stamped,
  CASE WHEN o.ok IS NULL OR a_id % 7 = 0 THEN discovery_method ELSE 'listing' END AS discovery_method, CASE WHEN o.absent IS NULL THEN feed_absent ELSE o.absent END AS feed_absent, o.absent IS NOT NULL AS probed FROM targets t LEFT JOIN o USING (newsroom_url)""")
def target_release(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FRN5: of three targets one is untouched; success, failure, a NULL patch and the stamp of a feed's absence."""
    t = load(spark, sf_dir, "targets")
    done = t.where("a_id % 3 <> 0").select("newsroom_url", (F.col("a_id") % 2 == 0).alias("success"), F.when(F.col("a_id") % 7 != 0, "listing").alias("discovery_method"), (F.col("a_id") % 5 == 0).alias("feed_absent"))
    out = frontier.release_target(t, done, AS_OF)
    return out.select("newsroom_url", "consec_failures", (F.col("last_success_at") == F.lit(AS_OF)).alias("stamped"), "discovery_method", "feed_absent", F.col("probed_at").isNotNull().alias("probed"))


@query(cte("targets", "domain_state") + f""", s AS (SELECT 'site' || CAST(CAST(substr(domain, 2) AS BIGINT) % 500 AS VARCHAR) || '.org' AS domain, min(next_allowed_at) AS first_due FROM domain_state WHERE enabled AND leased_until <= TIMESTAMP '{NOW}' AND next_allowed_at <= TIMESTAMP '{NOW}' GROUP BY 1 ORDER BY first_due, domain LIMIT 20)
SELECT s.domain, t.newsroom_url, t.a_id FROM s LEFT JOIN (SELECT * FROM targets WHERE enabled) t USING (domain)""")
def frontier_acquire(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FRN2, FRN8: the next domains with their enabled targets."""
    state = load(spark, sf_dir, "domain_state")
    site = F.concat(F.lit("site"), (F.substring("domain", 2, 20).cast("long") % 500).cast("string"), F.lit(".org"))
    free = state.where(frontier.is_due(AS_OF)).groupBy(site.alias("domain")).agg(F.min("next_allowed_at").alias("next_allowed_at"))
    free = free.withColumns({"shard": F.lit(0), "enabled": F.lit(True), "leased_until": F.lit(frontier.EPOCH), "lease_owner": F.lit(None).cast("string")})
    return frontier.acquire(free, load(spark, sf_dir, "targets"), "me", AS_OF, limit=20)[1].select("domain", "newsroom_url", "a_id")


@query(cte("targets", "domain_state") + f""", own AS (SELECT DISTINCT 'd' || CAST(a_id + 1 AS VARCHAR) AS domain FROM targets WHERE a_id IN (7, 8))
SELECT domain, CASE WHEN domain IN (SELECT domain FROM own WHERE domain = 'd8') THEN 0 ELSE consec_failures END AS consec_failures, domain = 'd8' OR next_allowed_at = TIMESTAMP '{NOW}' AS due_now FROM domain_state""")
def due_for_agency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN10, AGG23: an agency's domains are brought forward."""
    t = load(spark, sf_dir, "targets").withColumn("domain", F.concat(F.lit("d"), (F.col("a_id") + 1).cast("string")))
    out = frontier.make_due_for_agency(load(spark, sf_dir, "domain_state"), t, 7, AS_OF)
    return out.select("domain", "consec_failures", (F.col("next_allowed_at") == F.lit(AS_OF)).alias("due_now"))


@query(cte("domain_state") + f""" SELECT domain, CASE WHEN leased_until > TIMESTAMP '1970-01-01' AND leased_until < TIMESTAMP '{NOW}' THEN TIMESTAMP '1970-01-01' ELSE leased_until END = TIMESTAMP '1970-01-01' AS free FROM domain_state""")
def lease_reclaim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FRN6."""
    return frontier.reclaim(load(spark, sf_dir, "domain_state"), AS_OF).select("domain", (F.col("leased_until") == F.lit(frontier.EPOCH)).alias("free"))


@query(cte("targets") + """, t AS (SELECT a_id, 'site' || a_id % 299 AS domain FROM targets) SELECT DISTINCT domain FROM t WHERE a_id = 17 AND domain NOT IN (SELECT domain FROM t WHERE a_id <> 17)""")
def orphan_domains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN9, SNK8: what a removed agency leaves without targets."""
    t = load(spark, sf_dir, "targets").withColumn("domain", F.concat(F.lit("site"), (F.col("a_id") % 299).cast("string")))
    state = t.select("domain").distinct()
    return state.join(frontier.remove_agency(t, state, 17)[1], "domain", "left_anti")


@query(cte("targets", "domain_state") + """ SELECT t.newsroom_url, t.enabled AND coalesce(s.enabled, true) AS enabled, s.crawl_delay_s IS NOT NULL AS known FROM targets t LEFT JOIN (SELECT 'site' || substr(domain, 2) || '.org' AS domain, enabled, crawl_delay_s FROM domain_state) s USING (domain)""")
def status_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN1: targets with their domain's state; one that was never leased stays."""
    state = load(spark, sf_dir, "domain_state").withColumn("domain", F.concat(F.lit("site"), F.substring("domain", 2, 20), F.lit(".org")))
    own = load(spark, sf_dir, "targets").drop("crawl_delay_s", "revisit_period_s", "needs_browser", "access", "next_due_at")
    return frontier.status_rows(own, state).select("newsroom_url", "enabled", F.col("crawl_delay_s").isNotNull().alias("known"))


# ---- faults and runs
@query(cte("occurrences") + f""", x AS (SELECT *, row_number() OVER (PARTITION BY run_id, kind, domain ORDER BY stamp, url, detail NULLS FIRST) AS rn, min(stamp) OVER (PARTITION BY run_id, kind, domain) AS first_at FROM occurrences),
f AS (SELECT run_id, kind, domain, a_id, first_at, detail, CASE WHEN kind IN ('dns', 'circuit', 'error', 'discover_failed', 'extract_body_is_chrome', 'admin_list_failed', 'brand_new_kind') THEN 3 WHEN kind IN ('wall', 'robots') THEN 1 WHEN kind = 'ok' THEN 0 ELSE 2 END AS sev,
  CASE WHEN kind IN ('robots', 'wall') THEN 'policy' WHEN kind IN ('tls', 'connect', 'timeout', 'http_5xx', 'discover_failed', 'extract_no_headline', 'extract_body_too_short', 'extract_no_date') THEN 'site' ELSE 'us' END AS own FROM x WHERE rn = 1),
r AS (SELECT *, row_number() OVER (PARTITION BY a_id ORDER BY sev DESC, CASE WHEN own = 'us' THEN 0 ELSE 1 END, first_at, run_id, kind, domain) AS n FROM f WHERE a_id IS NOT NULL)
SELECT a_id, kind AS fault_kind, coalesce(detail, '') AS fault_detail FROM r WHERE n = 1""")
def fault_worst_for_agency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG9."""
    return faults.worst_for_agency(_faults(spark, sf_dir))


@query(cte("occurrences") + """, r AS (SELECT run_id, min(stamp) AS s FROM occurrences GROUP BY run_id), o AS (SELECT run_id, kind, domain, sum(n) AS n FROM occurrences GROUP BY ALL)
SELECT o.run_id, kind, domain, CAST(n AS BIGINT) AS n FROM o WHERE run_id IN (SELECT run_id FROM r ORDER BY s DESC, run_id DESC LIMIT 2) AND kind IN ('dns', 'brand_new_kind')""")
def recent_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRD11, ORD5, JN: faults of the two newest runs that are ours and of two kinds."""
    rows = _faults(spark, sf_dir)
    runs = rows.groupBy("run_id").agg(F.min("first_at").alias("started_at"))
    return faults.recent(rows, runs, 2, by="us").where("kind IN ('dns', 'brand_new_kind')").select("run_id", "kind", "domain", "n")


@query("""SELECT * FROM (VALUES ('20260829-120000', 'crawl', 'site', 7, 9, '{"stored": 3}', true), ('old', 'crawl', NULL, NULL, NULL, NULL, false)) t(run_id, command, scope, domains, targets, stats_json, ended)""")
def run_bookkeeping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK10, HLP2, HLP4."""
    runs = spark.createDataFrame([("old", datetime(2026, 8, 1), None, "crawl", None, None, None, None)], "run_id string, started_at timestamp_ntz, ended_at timestamp_ntz, command string, scope string, domains int, targets int, stats_json string")
    name = faults.new_run_id(AS_OF)
    runs = faults.start_run(faults.start_run(runs, name, AS_OF, "audit"), name, AS_OF, "crawl", "site")
    runs = faults.finish_run(faults.finish_run(runs, name, AS_OF, 7, 9, {"stored": 3}), "unknown", AS_OF, 1, 1)
    both = faults.run(runs, name).unionByName(faults.run(runs, "old")).unionByName(faults.run(runs, "unknown"))
    return both.select("run_id", "command", "scope", "domains", "targets", "stats_json", F.col("ended_at").isNotNull().alias("ended"))


# ---- articles and the wire
@query(cte("articles") + """, p AS (SELECT doc_id, url, domain, a_id FROM articles WHERE tns_state IS NULL OR tns_state = 'error'), r AS (SELECT url, max(doc_id) AS last FROM articles WHERE doc_id % 2 = 0 GROUP BY url)
SELECT p.doc_id AS h, p.url, coalesce(nullif(r.last % 60, 0), p.a_id, 0) AS a_id, r.last IS NOT NULL AND r.last % 9 <> 0 AS ready FROM p LEFT JOIN r USING (url)""")
def wire_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN14, ORD6, SRC4: what waits to be loaded, with its body where the archive has one."""
    rows = load(spark, sf_dir, "articles")
    archive = articles.latest(rows.where("doc_id % 2 = 0").select("url", F.lit("f").alias("file"), F.col("doc_id").alias("pos"), (F.col("doc_id") % 60).cast("int").alias("a_id"), "headline", F.lit("body").alias("body"), F.when(F.col("doc_id") % 9 != 0, F.col("first_seen_at")).alias("published_at")))
    waiting = articles.pending(rows.withColumn("url_hash", F.col("doc_id")))
    return articles.backfill(waiting, archive).select(F.col("url_hash").alias("h"), "url", "a_id", "ready")


@query(cte("wire") + """ SELECT 'rows' AS kind, '' AS word, count(*) AS n FROM wire UNION ALL SELECT 'today', '', count(*) FILTER (create_date >= TIMESTAMP '2026-08-29') FROM wire UNION ALL SELECT 'status', coalesce(nullif(status, ''), '(null)'), count(*) FROM wire GROUP BY 2""")
def wire_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG19."""
    return articles.wire_counts(load(spark, sf_dir, "wire"), date(2026, 8, 29))


@query(cte("wire") + " SELECT pr_id, filename FROM wire WHERE a_id = 7 ORDER BY pr_id DESC LIMIT 5")
def wire_newest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ORD10."""
    return articles.newest_wire(load(spark, sf_dir, "wire"), 5, 7).select("pr_id", "filename")


@query(cte("wire") + " SELECT DISTINCT '$H ' || CAST(doc_id AS VARCHAR) AS filename FROM documents WHERE doc_id % 3 <> 0")
def wire_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN8, REC11: loads whose row isn't there."""
    wire = load(spark, sf_dir, "wire")
    return articles.missing_filenames(wire.select(F.col("filename").alias("tns_filename")), wire.where("pr_id % 3 = 0"))


@query(cte("articles") + """, n AS (SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN 'loaded' WHEN 1 THEN 'error' WHEN 2 THEN 'rejected:no_lede' END AS s FROM articles WHERE doc_id % 5 < 2)
SELECT a.doc_id, coalesce(n.s, a.tns_state) AS tns_state FROM articles a LEFT JOIN n USING (doc_id)""")
def load_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK2, REC10: states after loads; a NULL outcome changes nothing."""
    rows = load(spark, sf_dir, "articles").withColumns({"url_hash": F.col("doc_id"), "tns_filename": F.lit(None).cast("string"), "tns_at": F.lit(None).cast("timestamp")})
    i = F.col("doc_id")
    outcome = F.when(i % 4 == 0, "inserted").when(i % 4 == 1, "insert_error").when(i % 4 == 2, "no_lede")
    done = rows.where("doc_id % 5 < 2").select("url_hash", F.when(outcome.isNotNull(), records.load_state(outcome)).alias("state"), F.lit("f").alias("filename"), F.lit(AS_OF).cast("timestamp").alias("at"))
    return articles.mark_loaded(rows, done).select("doc_id", "tns_state")


@query(cte("articles") + " SELECT doc_id FROM articles WHERE a_id IN (3, 5, 8)")
def articles_by_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN17: rows of named agencies; no names, no rows."""
    rows = load(spark, sf_dir, "articles")
    return articles.by_ids(rows, [5, 3, 8, 3]).unionByName(articles.by_ids(rows, [])).select("doc_id")


@query(cte("articles") + " SELECT doc_id FROM articles WHERE a_id IS NULL OR a_id NOT IN (3, 5)")
def scoped_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK6, SNK8."""
    rows = load(spark, sf_dir, "articles")
    return articles.remove_agency(articles.delete(articles.delete(rows, []), [3]), 5).select("doc_id")


# ---- lists
_REMOVED = "removed AS (SELECT DISTINCT a_id FROM requests WHERE a_id % 9 = 0)"


@query(cte("requests") + f", {_REMOVED}" + """ SELECT seq, CASE WHEN newsroom_url = 'nowhere' THEN 'invalid' WHEN a_id IN (SELECT a_id FROM removed) THEN 'refused' ELSE 'seed' END AS outcome FROM requests""")
def request_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN15, ADM1."""
    rows = load(spark, sf_dir, "requests")
    return lists.reconcile_requests(rows, rows.where("a_id % 9 = 0").select("a_id").distinct()).select("seq", "outcome")


@query(cte("requests", "targets") + f", {_REMOVED}" + """, own AS (SELECT a_id, newsroom_url, domain, 0 AS f FROM targets), w AS (SELECT a_id, regexp_replace(replace(newsroom_url, 'www.', ''), '/$', '') AS newsroom_url, regexp_extract(newsroom_url, 'site[0-9]+\\.org') AS domain, 1 AS f FROM requests WHERE newsroom_url <> 'nowhere'),
b AS (SELECT *, row_number() OVER (PARTITION BY newsroom_url ORDER BY f, a_id) AS rn FROM (SELECT * FROM own UNION ALL SELECT * FROM w) WHERE a_id NOT IN (SELECT a_id FROM removed)) SELECT a_id, newsroom_url, domain FROM b WHERE rn = 1""")
def seed_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN16, AGG23, HLP22: seed rows and requests once per URL, without removed agencies."""
    rows = load(spark, sf_dir, "requests")
    return lists.seeds(load(spark, sf_dir, "targets").select("a_id", "newsroom_url", "domain"), rows, rows.where("a_id % 9 = 0").select("a_id").distinct())


@query(cte("requests") + """, r AS (SELECT DISTINCT a_id FROM requests WHERE a_id % 9 = 0) SELECT DISTINCT a_id, a_id % 9 = 0 AS listed FROM requests""")
def list_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ADM2, HLP6."""
    rows = load(spark, sf_dir, "requests")
    return lists.members(rows.where("a_id % 9 = 0"), "a_id", rows.select("a_id").distinct())


# ---- what readers are given
@query(cte("targets") + f""" SELECT newsroom_url, CASE WHEN discovery_method IS NULL THEN 'not solved' WHEN a_id % 3 < 2 THEN discovery_method || ' (' || a_id % 3 || '/2)' ELSE discovery_method END AS source,
  CASE WHEN epoch(next_due_at) > epoch(TIMESTAMP '{NOW}') THEN 'in ' || CASE WHEN epoch(next_due_at) - epoch(TIMESTAMP '{NOW}') < 86400 THEN CAST(floor((epoch(next_due_at) - epoch(TIMESTAMP '{NOW}')) / 3600) AS INT) || 'h' ELSE CAST(floor((epoch(next_due_at) - epoch(TIMESTAMP '{NOW}')) / 86400) AS INT) || 'd' END
    ELSE CASE WHEN epoch(TIMESTAMP '{NOW}') - epoch(next_due_at) < 86400 THEN CAST(floor((epoch(TIMESTAMP '{NOW}') - epoch(next_due_at)) / 3600) AS INT) || 'h' ELSE CAST(floor((epoch(TIMESTAMP '{NOW}') - epoch(next_due_at)) / 86400) AS INT) || 'd' END || ' ago' END AS due FROM targets""")
def row_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """HLP8, HLP9."""
    return load(spark, sf_dir, "targets").select("newsroom_url", status.source_label(F.col("discovery_method"), F.col("a_id") % 3, F.lit(2)).alias("source"), relative_age(F.col("next_due_at"), F.lit(AS_OF)).alias("due"))


@query(cte("targets") + """ SELECT newsroom_url, CAST(enabled AS INT) AS enabled, CAST(needs_browser AS INT) AS needs_browser, enabled AS enabled_again, strftime(next_due_at, '%Y-%m-%dT%H:%M:%S') AS next_due_at, health IS NULL AS no_health FROM (SELECT *, NULL AS health FROM targets)""")
def row_encoders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """HLP10, PRD14: rows as stored, and as readers want them."""
    stored = status.as_rows(load(spark, sf_dir, "targets"))
    read = status.cast_rows(stored).select("newsroom_url", F.col("enabled").alias("enabled_again"), "next_due_at")
    return stored.select("newsroom_url", "enabled", "needs_browser", F.col("health").isNull().alias("no_health")).join(read, "newsroom_url")


@query(cte("targets", "articles") + """, g AS (SELECT a_id FROM targets GROUP BY a_id) SELECT count(*) AS total, 3 AS bands FROM g""")
def grid_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG10, HLP5: the summary above the grid counts every agency once, and has every band."""
    return status.summary_row(_grid(spark, sf_dir)).select("total", F.size(F.map_keys("severity")).alias("bands"))
