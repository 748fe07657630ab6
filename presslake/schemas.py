"""Closed vocabularies and the schemas of the engine's tables.

Every vocabulary has a defined answer for a word it doesn't know; tests hold each map to be total.
"""

from __future__ import annotations

# ---- fixed values: vocabularies
PRECISIONS = ("second", "minute", "day", "month")
PROVENANCE = ("wrapper", "jsonld", "microdata", "opengraph", "feed", "cms_api", "sitemap", "trafilatura", "htmldate", "url_path", "time_element", "http_header", "llm", "none")
METHODS = ("none", "cms_api", "rss", "sitemap", "news_sitemap", "listing")
UNUSABLE = ("extract_no_headline", "extract_body_too_short", "extract_no_date", "extract_body_is_chrome")
FAILURES = ("dns", "circuit", "error", "tls", "http2", "http_4xx", "connect", "timeout", "http_5xx", "wall", "robots", "not_modified", "ok")
NOT_FAILURES = ("ok", "not_modified")
ACCESS = ("js_rendered", "unresolved", "challenge", "refused")  # mildest first
ADMIN = ("admin_target_crashed", "admin_list_unreachable", "admin_list_failed", "admin_status_unpublished", "admin_faults_unrecorded", "admin_resolver_failing")
FAULT_KINDS = tuple(k for k in FAILURES if k not in NOT_FAILURES) + ("discover_failed",) + UNUSABLE + ADMIN
SEVERITY = {
    "dns": 3, "circuit": 3, "error": 3, "tls": 2, "http2": 2, "http_4xx": 2, "connect": 2, "timeout": 2, "http_5xx": 2, "wall": 1, "robots": 1, "discover_failed": 3,
    "extract_body_is_chrome": 3, "extract_no_headline": 2, "extract_body_too_short": 2, "extract_no_date": 2,
    "admin_target_crashed": 3, "admin_list_failed": 3, "admin_status_unpublished": 3, "admin_faults_unrecorded": 3, "admin_list_unreachable": 2, "admin_resolver_failing": 3,
    "ok": 0, "not_modified": 0,
}
OWNER = {
    "robots": "policy", "wall": "policy", "refused": "policy", "challenge": "policy",
    "tls": "site", "connect": "site", "timeout": "site", "http_5xx": "site", "discover_failed": "site", "extract_no_headline": "site",
    "extract_body_too_short": "site", "extract_no_date": "site", "js_rendered": "site",
}
OWNERS = ("us", "site", "policy")
OWNER_WEIGHT = {"us": 3.0, "site": 1.0, "policy": 0.0}
URGENT_AT, NOTABLE_AT, KEEP_RUNS = 18.0, 10.0, 30
HEALTH_SEVERITY = {
    "healthy": "ok", "quiet": "ok", "disabled": "warn", "stale": "warn", "blocked": "warn", "empty": "warn", "refused": "warn",
    "never": "error", "failing": "error", "unresolved": "error",
}
BANDS = ("error", "warn", "ok")
FAILING_AFTER, STALE_AFTER_DAYS, QUIET_AFTER_DAYS, RECENT_DAYS = 3, 14, 90, 30
AUDIT_VERDICTS = ("broken", "suspicious", "check", "ok")
# ---- end of fixed values

RESPONSE = "url STRING, final_url STRING, status INT, text STRING, headers MAP<STRING,STRING>, elapsed_s DOUBLE, from_cache BOOLEAN, wall STRING, error STRING"
ARTICLE = "url_hash STRING, content_hash STRING, domain STRING, a_id INT, url STRING, headline STRING, published_at TIMESTAMP_NTZ, body_len INT, first_seen_at TIMESTAMP_NTZ, tns_state STRING, tns_filename STRING, tns_at TIMESTAMP_NTZ"
FAULT = "run_id STRING, kind STRING, domain STRING, a_id INT, n BIGINT, first_at TIMESTAMP_NTZ, last_at TIMESTAMP_NTZ, sample_url STRING, sample_detail STRING"
DOMAIN_STATE = "domain STRING, shard INT, enabled BOOLEAN, next_allowed_at TIMESTAMP_NTZ, leased_until TIMESTAMP_NTZ, lease_owner STRING, consec_failures INT, revisit_period_s INT, crawl_delay_s DOUBLE, last_success_at TIMESTAMP_NTZ, needs_browser BOOLEAN, access STRING, access_probed_at TIMESTAMP_NTZ"
TARGET = "newsroom_url STRING, a_id INT, domain STRING, enabled BOOLEAN, discovery_method STRING, feed_url STRING, feed_absent BOOLEAN, probed_at TIMESTAMP_NTZ, etag STRING, last_modified STRING, consec_failures INT, last_success_at TIMESTAMP_NTZ"
REF = "url STRING, headline STRING, date_raw STRING, body_html STRING, source STRING"
