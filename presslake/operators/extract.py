"""From raw page facts to a record: cascades with provenance, dates, quality and usability, all plain columns."""

from __future__ import annotations

import re
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dates, languages, text, windows
from ..functions.urls import let
from ..sources.pages import META_DATES

# ---- fixed values
SEPARATORS = (" | ", " - ", " — ", " – ", " :: ", " » ", " > ", "|")
CHROME_WORDS = (
    "news", "newsroom", "press", "press releases", "press release", "pressroom",
    "press room", "media", "media centre", "media center", "blog", "blogs",
    "insights", "stories", "updates", "announcements", "home", "latest",
    "news releases", "news release", "articles", "publications", "events",
)
MIN_BODY, MIN_HEADLINE, MAX_HEADLINE, SWAP_BELOW, SWAP_ABOVE, JSONLD_OVERLAP, SHELL_CHARS, SMALL_HTML, SECOND_OVERLAP = 300, 10, 250, 0.1, 0.3, 0.4, 200, 1000, 0.5
# ---- end of fixed values


def _stripped(value: Column) -> Column:
    return F.regexp_replace(value, r"^\s+|\s+$", "")


def _splitter(pattern: str):
    return lambda p: F.split(p, pattern, -1)


def title_parts(title: Column) -> Column:
    """The parts between separators, each separator in turn; blank parts stay."""
    parts = F.array(title)
    for separator in SEPARATORS:
        parts = F.flatten(F.transform(parts, _splitter(re.escape(separator))))
    return F.transform(parts, _stripped)


def _furniture(part: Column, site: Column | None) -> Column:
    known = F.lower(part).isin(*CHROME_WORDS)
    return known if site is None else known | F.coalesce((F.lower(part) == F.lower(_stripped(site))) & (_stripped(site) != ""), F.lit(False))


def _longest(parts: Column) -> Column:
    """The longest part, the first of equals."""
    return F.aggregate(parts, F.lit(""), lambda a, p: F.when(F.length(p) > F.length(a), p).otherwise(a))


def headline_from_title(title: Column, site: Column | None = None) -> Column:
    """The longest part of a title that isn't site furniture; the whole title if all is."""
    return let(title_parts(title), lambda parts: let(F.filter(parts, lambda p: (p != "") & ~_furniture(p, site)), lambda kept: F.when(F.size(kept) > 0, _longest(kept)).otherwise(_stripped(title))))


def strip_title_chrome(title: Column, site: Column | None = None) -> Column:
    """A title is left alone unless one of its parts is furniture or blank; then it is its longest other part, NULL if there is none."""

    def chosen(parts: Column) -> Column:
        kept = F.filter(parts, lambda p: (p != "") & ~_furniture(p, site))
        return F.when((F.size(parts) < 2) | (F.size(kept) == F.size(parts)), title).when(F.size(kept) > 0, _longest(kept))

    return let(title_parts(title), chosen)


def site_name(title: Column) -> Column:
    """The tail of a title that says it twice."""
    named = lambda parts: F.when((F.size(parts) >= 3) & (F.element_at(parts, -1) == F.try_element_at(parts, F.lit(-2))), F.element_at(parts, -1))
    return let(F.filter(title_parts(title), lambda p: p != ""), named)


def _cascade(*pairs: tuple[str, Column]) -> Column:
    """The first value that isn't NULL or empty, with its source."""
    return F.coalesce(*[F.when(F.coalesce(v, F.lit("")) != "", F.struct(v.alias("value"), F.lit(s).alias("source"))) for s, v in pairs], F.struct(F.lit(None).cast("string").alias("value"), F.lit("none").alias("source")))


def needs_browser(body: Column, structured: Column, html_chars: Column, notice: Column, hydration: Column) -> Column:
    """STRUCT<needed, reason>, judged by what came out: no page of SHELL_CHARS of text, or with a structured body, needs one."""
    size = F.length(F.coalesce(body, F.lit("")))
    # ---- fixed values: reasons
    reason = (
        F.when((size >= SHELL_CHARS) | structured, F.lit(None).cast("string"))
        .when(F.coalesce(html_chars, F.lit(0)) == 0, "empty response")
        .when(notice, "noscript js-required notice")
        .when(html_chars < SMALL_HTML, "html under 1KB")
        .when(hydration, "hydration payload present - mine it before launching a browser")
        .otherwise(F.concat(F.lit("low text yield ("), size.cast("string"), F.lit(" chars)")))
    )
    # ---- end of fixed values
    return F.struct(reason.isNotNull().alias("needed"), reason.alias("reason"))


def unusable(headline: Column, body: Column, date: Column, best: Column) -> Column:
    """The first reason why a record can't be used, NULL if it can. best: the prose ratio of the body's best window."""
    return (
        F.when(F.coalesce(headline, F.lit("")) == "", "extract_no_headline")
        .when(F.length(F.coalesce(body, F.lit(""))) < MIN_BODY, "extract_body_too_short")
        .when(date.isNull(), "extract_no_date")
        .when(best < text.CHROME_BELOW, "extract_body_is_chrome")
    )


def records(facts: DataFrame, as_of: datetime) -> DataFrame:
    """One record of each parsed page, with what fed it: facts may carry feed_headline, feed_date, feed_body, sitemap_lastmod, http_last_modified."""
    for c in ("feed_headline", "feed_date", "feed_body", "sitemap_lastmod", "http_last_modified"):
        if c not in facts.columns:
            facts = facts.withColumn(c, F.lit(None).cast("string"))
    c, meta = F.col, lambda k: F.element_at("meta", k)
    facts = facts.withColumn("_site", F.coalesce(F.nullif(meta("og:site_name"), F.lit("")), site_name(c("title"))))
    site = c("_site")
    h1 = F.when(F.length("h1").between(MIN_HEADLINE, MAX_HEADLINE), c("h1"))
    facts = facts.withColumn("_dom", F.coalesce(h1, headline_from_title(c("title"), site)))
    said = lambda v: F.nullif(_stripped(v), F.lit(""))
    og = F.coalesce(meta("og:title"), meta("twitter:title"))
    heads = [(s, strip_title_chrome(said(v), site)) for s, v in (("feed", c("feed_headline")), ("jsonld", c("jsonld.headline")), ("opengraph", og))]
    out = facts.withColumn("_head", _cascade(*heads, ("trafilatura", c("_dom"))))
    # named columns in steps keep the expressions small: each is used several times by the next
    size = lambda x: F.length(F.coalesce(x, F.lit("")))
    part = lambda v, s: F.struct(v.alias("value"), F.lit(s).alias("source"))
    out = out.withColumn("_raw", F.when(size(c("feed_body")) > size(c("body")), part(c("feed_body"), "feed")).otherwise(part(c("body"), "trafilatura")))
    ld = c("jsonld.body")
    fits = (size(ld) > size(c("_raw.value"))) & ((size(c("_raw.value")) == 0) | (text.overlap(ld, F.coalesce(c("_raw.value"), F.lit(""))) >= JSONLD_OVERLAP))
    out = out.withColumn("_body", F.when(fits, part(ld, "jsonld")).otherwise(c("_raw")))
    out = out.withColumn("_clean", text.clean_body(c("_body.value")))
    out = out.withColumn("_own", text.strip_leading_headline(c("_clean"), F.coalesce(c("_head.value"), F.lit(""))))
    out = out.withColumn("_now", text.coherence(c("_head.value"), c("_own"))).withColumn("_other", text.coherence(c("_dom"), c("_own")))
    swap = F.coalesce((c("_now") <= SWAP_BELOW) & (c("_other") >= SWAP_ABOVE) & (c("_dom") != c("_head.value")), F.lit(False))
    out = out.withColumn("_swap", swap)
    out = out.withColumn("headline", F.when(c("_swap"), c("_dom")).otherwise(c("_head.value"))).withColumn("headline_source", F.when(c("_swap"), "trafilatura").otherwise(c("_head.source")))
    out = out.withColumn("body_clean", F.when(c("_swap"), text.strip_leading_headline(c("_own"), c("_dom"))).otherwise(c("_own")))
    out = out.withColumn("body_source", F.when(size(c("body_clean")) > 0, c("_body.source")).otherwise("none"))
    raw = [("feed", c("feed_date")), ("jsonld", c("jsonld.date_raw")), ("opengraph", F.coalesce(*[meta(k) for k in META_DATES])), ("time_element", c("time_raw")), ("htmldate", c("searched_date")), ("sitemap", c("sitemap_lastmod")), ("http_header", c("http_last_modified"))]
    found = [F.struct(F.lit(s).alias("source"), dates.parse(v, as_of).alias("value"), v.alias("raw")) for s, v in raw]
    found.append(F.struct(F.lit("url_path").alias("source"), dates.from_url(c("url"), as_of).alias("value"), c("url").alias("raw")))
    out = out.withColumn("_dates", F.array(*found))
    out = out.withColumn("date", dates.resolve(c("_dates"), F.coalesce(c("jsonld.weak_only"), F.lit(False))))
    out = out.withColumn("_best", windows.best_prose_ratio(c("body_clean")))
    out = out.withColumn("unusable", unusable(c("headline"), c("body_clean"), c("date.value"), c("_best")))
    out = out.withColumn("_second", text.overlap(F.coalesce(c("body_clean"), F.lit("")), F.coalesce(c("body_second"), F.lit(""))))
    out = out.withColumn("browser", needs_browser(c("body_clean"), c("jsonld.body").isNotNull(), c("html_chars"), c("script_notice"), c("hydration")))
    out = out.withColumn("_prose", text.prose_ratio(c("body_clean"))).withColumn("_chrome", (size(c("body_clean")) > 0) & (c("_best") < text.CHROME_BELOW))
    quality = F.struct(
        size(c("body_clean")).alias("body_len"), c("html_chars").alias("html_len"), c("jsonld.is_article").alias("jsonld_is_article"), c("jsonld.weak_only").alias("jsonld_weak_only"), c("jsonld.types").alias("jsonld_types"),
        c("browser.needed").alias("needs_browser"), c("browser.reason").alias("needs_browser_reason"), F.round("_second", 3).alias("second_opinion_overlap"), size(c("body_second")).alias("second_opinion_len"),
        F.when(c("_swap"), F.concat(c("_head.source"), F.lit(" scored "), c("_now").cast("string"), F.lit(" against the body; dom h1 scored "), c("_other").cast("string"))).alias("headline_replaced"),
        text.coherence(c("headline"), c("body_clean")).alias("headline_in_body"), c("_prose").alias("prose_ratio"), c("_chrome").alias("looks_like_navigation"),
    )
    full = F.array_compact(F.array(*_warnings(size)))
    warnings = F.when(F.coalesce(c("html_chars"), F.lit(0)) == 0, F.array(F.lit("empty html"))).otherwise(full)
    language = F.coalesce(languages.detect(c("body_clean")), c("jsonld.language"), meta("og:locale"))
    return out.select("page_id", "url", "headline", "headline_source", c("body_clean").alias("body"), "body_source", "date", language.alias("language"), quality.alias("quality"), warnings.alias("warnings"), "unusable", "browser")


def _warnings(size) -> list[Column]:
    c = F.col
    # ---- fixed values: wording
    return [
        F.when((size(c("body_second")) > MIN_BODY) & (c("_second") < SECOND_OVERLAP), F.format_string("low second-opinion overlap (%.2f)", c("_second"))),
        F.when(c("_chrome"), F.concat(F.lit("body looks like page chrome (prose ratio "), c("_prose").cast("string"), F.lit(")"))),
        F.when(size(c("headline")) == 0, F.lit("no headline")).when(F.length("headline") > MAX_HEADLINE, F.lit("headline over 250 chars")),
        F.when(size(c("body_clean")) < MIN_BODY, F.lit("body under 300 chars")),
        F.when(c("date.value").isNull(), F.lit("no date")).when(c("date.disagreement_days").isNotNull(), F.concat(F.lit("date sources disagree by "), c("date.disagreement_days").cast("string"), F.lit("d"))),
        F.when(c("browser.needed"), F.concat(F.lit("needs browser: "), c("browser.reason"))),
    ]
    # ---- end of fixed values
