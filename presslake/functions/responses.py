"""What a captured response was: failure kind, bot wall, verdict on the host, waiting times."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ---- fixed values
WALL_TITLES = ("just a moment", "access denied", "attention required", "are you human", "verify you are human", "checking your browser", "security check", "ddos protection", "one more step")
WALL_SCRIPTS = ("triggerinterstitialchallenge", "_cf_chl_opt", "__cf_chl", "challenge-platform", "_incapsula_resource", "awswaf", "_pxhd", "px-captcha", "kpsdk")
CHALLENGES = ("just a moment", "checking your browser", "are you human", "verify you are human", "security check", "one more step", "js challenge")
WALL_PAGE_MAX, TITLE_WITHIN, FRESH_DAYS = 8192, 4096, 30
# ---- end of fixed values


def ok(error: Column, wall: Column, status: Column) -> Column:
    return _blank(error) & _blank(wall) & status.between(200, 299)


def reached(error: Column, wall: Column, status: Column) -> Column:
    return ok(error, wall, status) | (_blank(error) & _blank(wall) & (status == 304))


def _blank(c: Column) -> Column:
    return F.coalesce(c, F.lit("")) == ""


def failure_kind(wall: Column, error: Column, from_cache: Column, status: Column) -> Column:
    """One word of a closed vocabulary; the order of the questions is the contract."""
    starts = lambda *words: F.coalesce(error, F.lit("")).rlike("^(" + "|".join(words) + ")")
    return (
        F.when(~_blank(wall), "wall")
        .when(starts("robots-disallow"), "robots")
        .when(starts("circuit-open"), "circuit")
        .when(starts("DNSError"), "dns")
        .when(starts("SSLError", "CertificateVerifyError"), "tls")
        .when(starts("HTTPError") & F.contains(error, F.lit("HTTP/2")), "http2")
        .when(starts("ConnectionError", "ConnectTimeout"), "connect")
        .when(starts("Timeout", "browser-timeout"), "timeout")
        .when(~_blank(error), "error")
        .when(F.coalesce(from_cache, F.lit(False)), "not_modified")
        .when(status.between(200, 299), "ok")
        .when(status.between(400, 499), "http_4xx")
        .when(status >= 500, "http_5xx")
        .otherwise("error")
    )


def detect_wall(html: Column) -> Column:
    """The marker that gives a challenge page away, NULL for other pages: a script on a small page, or a title."""
    small = F.lower(html)
    script = F.filter(F.array(*map(F.lit, WALL_SCRIPTS)), lambda m: F.contains(small, m))
    head = F.lower(F.substring(html, 1, TITLE_WITHIN))
    title = F.trim(F.regexp_extract(head, r"(?s)<title[^>]*>(.*?)</title>", 1))
    told = F.exists(F.array(*map(F.lit, WALL_TITLES)), lambda m: F.contains(title, m))
    by_script = F.when((F.length(html) <= WALL_PAGE_MAX) & (F.size(script) > 0), F.concat(F.lit("js challenge ("), F.element_at(script, 1), F.lit(")")))
    return F.coalesce(by_script, F.when(told, F.substring(title, 1, 120)))


def host_verdicts(responses: DataFrame) -> DataFrame:
    """domain, access, reason, failures of responses(domain, at, status, error, wall): what each host last did to us.

    failures counts refusals since the last good answer. Hosts without a verdict have no row.
    """
    refused = F.coalesce(F.col("wall"), F.lit("")) != ""
    refused |= F.col("status").isin(403, 429, 503)
    good = ok(F.col("error"), F.col("wall"), F.col("status")) | (F.col("status") == 304)
    last_good = F.max(F.when(good, F.col("at")))
    per = responses.groupBy("domain").agg(last_good.alias("good_at"), F.bool_or(F.coalesce(F.col("error").startswith("DNSError"), F.lit(False))).alias("dns"))
    since = responses.join(per, "domain").where(refused & (F.col("good_at").isNull() | (F.col("at") > F.col("good_at"))))
    since = since.groupBy("domain").agg(F.count("*").alias("failures"), F.max_by(F.nullif("wall", F.lit("")), F.when(F.nullif("wall", F.lit("")).isNotNull(), F.col("at"))).alias("wall"), F.max_by("status", "at").alias("status"))
    both = per.select("domain", "dns").join(since, "domain", "left")
    challenge = F.exists(F.array(*map(F.lit, CHALLENGES)), lambda m: F.contains(F.lower("wall"), m))
    access = F.when(F.col("dns"), "unresolved").when(F.col("wall").isNotNull(), F.when(challenge, "challenge").otherwise("refused")).when(F.col("status") == 403, "refused")
    reason = F.when(F.col("dns"), "our resolver could not resolve this host").when(F.col("wall").isNotNull(), F.col("wall")).otherwise(F.lit("HTTP 403"))
    return both.select("domain", access.alias("access"), reason.alias("reason"), F.coalesce("failures", F.lit(0)).alias("failures")).where("access IS NOT NULL")


def retry_after(value: Column, as_of: Column) -> Column:
    """Seconds to wait: a number, or an HTTP date less as_of; 60 if it can't be read, never below 0."""
    date = F.try_to_timestamp(F.regexp_replace(value, r"^\w{3},\s*", ""), F.lit("dd MMM yyyy HH:mm:ss z"))
    wait = F.coalesce(value.try_cast("double"), (date.cast("long") - as_of.cast("timestamp").cast("long")).cast("double"), F.lit(60.0))
    return F.greatest(wait, F.lit(0.0))


def is_fresh(flag: Column, stamp: Column, as_of: Column, days: int = FRESH_DAYS) -> Column:
    """A remembered verdict holds for less than `days` days; without a stamp not at all."""
    age = as_of.cast("timestamp").cast("long") - stamp.cast("timestamp").cast("long")
    return F.coalesce(flag & (age < days * 86400), F.lit(False))


def backoff_seconds(revisit: Column, failures: Column) -> Column:
    return (revisit * F.pow(F.lit(2), F.least(failures, F.lit(6)))).cast("long")


def timestamp(text: Column) -> Column:
    """Either of the stored encodings, with or without fractions or a time; NULL otherwise."""
    plain = F.regexp_replace(F.regexp_replace(text, "T", " "), r"(Z|[+-]\d{2}:?\d{2})$", "")
    formats = ("yyyy-MM-dd HH:mm:ss.SSSSSS", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd HH:mm", "yyyy-MM-dd")
    return F.coalesce(*[F.try_to_timestamp(plain, F.lit(f)) for f in formats])


def should_escalate(enabled: Column, used: Column, budget: Column, wall: Column, status: Column, needs_browser: Column) -> Column:
    """Whether a page is worth a browser: enabled, within budget, no refusal, and empty without scripts."""
    return enabled & (used < budget) & _blank(wall) & ~status.isin(401, 403, 429, 451) & needs_browser
