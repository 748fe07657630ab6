"""Dates: parsing, dates in URLs, precision, and the choice among sources. `as_of` stands in for the clock."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values
FIRST_YEAR, TOLERANCE, DISAGREEMENT_DAYS = 1995, "48 HOURS", 7
SOURCES = ("feed", "jsonld", "opengraph", "time_element", "htmldate", "url_path", "sitemap", "http_header")
SOURCES_WEAK_JSONLD = ("feed", "opengraph", "time_element", "htmldate", "jsonld", "url_path", "sitemap", "http_header")
URL_DATES = (
    r"/((?:19|20)\d{2})[/-](0?[1-9]|1[0-2])[/-](0?[1-9]|[12]\d|3[01])(?:/|$|[-.])",
    r"/((?:19|20)\d{2})[/-](0?[1-9]|1[0-2])()(?:/|$|[-.])",
    r"/((?:19|20)\d{2})(\d{2})(\d{2})(?:/|$|[-.])",
)
PLAIN_FORMATS = ("yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd HH:mm", "yyyy-MM-dd", "yyyy/MM/dd", "MMMM d, yyyy", "MMM d, yyyy", "d MMMM yyyy", "d MMM yyyy", "dd MMM yyyy HH:mm:ss", "MM/dd/yyyy")
OFFSET = r"(Z|[+-]\d{2}:?\d{2}|\s(?:GMT|UTC))$"
# ---- end of fixed values


def in_window(t: Column, as_of: datetime) -> Column:
    return (F.year(t) >= FIRST_YEAR) & (t <= F.lit(as_of) + F.expr(f"INTERVAL {TOLERANCE}"))


def parse(raw: Column, as_of: datetime) -> Column:
    """ISO and the common written forms as naive UTC; NULL if unreadable or outside 1995 to as_of plus two days."""
    text = F.regexp_replace(F.trim(raw), r"^(?:Mon|Tue|Wed|Thu|Fri|Sat|Sun)[a-z]*,\s*", "")
    zone = F.regexp_extract(text, OFFSET, 1)
    bare = F.regexp_replace(F.regexp_replace(F.regexp_replace(text, OFFSET, ""), r"(\d)T(\d)", "$1 $2"), r"\.\d+$", "")
    local = F.coalesce(*[F.try_to_timestamp(bare, F.lit(f)) for f in PLAIN_FORMATS])
    sign = F.when(zone.startswith("-"), -1).otherwise(1)
    minutes = F.when(zone.rlike(r"^[+-]"), sign * (F.substring(zone, 2, 2).cast("int") * 60 + F.right(zone, F.lit(2)).cast("int"))).otherwise(0)
    t = F.timestamp_add("MINUTE", -minutes, local)
    return F.when(in_window(t, as_of), t)


def from_url(url: Column, as_of: datetime) -> Column:
    """A date in the path; month patterns give the first. All four digits of the year count, also before 2000."""
    found = []
    for pattern in URL_DATES:
        y, m, d = (F.regexp_extract(url, pattern, k) for k in (1, 2, 3))
        day = F.coalesce(F.nullif(d, F.lit("")), F.lit("1"))
        t = F.try_to_timestamp(F.concat_ws("-", y, m, day), F.lit("y-M-d"))
        found.append(F.when((y != "") & in_window(t, as_of), t))
    return F.coalesce(*found)


def precision(raw: Column) -> Column:
    return (
        F.when(raw.rlike(r"\d{2}:\d{2}:\d{2}"), "second")
        .when(raw.rlike(r"\d{2}:\d{2}"), "minute")
        .when(raw.rlike(r"\d{4}-\d{2}-\d{2}") | raw.rlike(r"\d{1,2}\s+\w+\s+\d{4}"), "day")
        .otherwise("month")
    )


def resolve(candidates: Column, weak_jsonld: Column) -> Column:
    """STRUCT<value, source, raw, precision, had_offset, disagreement_days> of ARRAY<STRUCT<source, value, raw>>, NULL values left out.

    The first source by trust wins; a weak JSON-LD date ranks behind what the page shows. Disagreement is the widest
    gap in whole days (rounded down) between the winner and another source, if over 7.
    """
    known = F.filter(candidates, lambda c: c["value"].isNotNull())
    rank = lambda names, c: F.array_position(F.array(*map(F.lit, names)), c["source"])
    ranked = F.transform(known, lambda c: F.struct(F.when(weak_jsonld, rank(SOURCES_WEAK_JSONLD, c)).otherwise(rank(SOURCES, c)).alias("rank"), c["source"].alias("source"), c["value"].alias("value"), c["raw"].alias("raw")))
    win = F.array_min(ranked)
    seconds = lambda t: t.cast("timestamp").cast("long")
    gaps = F.transform(F.filter(ranked, lambda c: c["source"] != win["source"]), lambda c: F.abs(F.floor((seconds(win["value"]) - seconds(c["value"])) / 86400)))
    worst = F.array_max(gaps)
    return F.struct(
        win["value"].alias("value"),
        F.coalesce(win["source"], F.lit("none")).alias("source"),
        win["raw"].alias("raw"),
        F.when(win.isNotNull(), precision(F.coalesce(win["raw"], F.lit("")))).alias("precision"),
        F.coalesce(F.trim(win["raw"]).rlike(r"(?:Z|[+-]\d{2}:?\d{2})$"), F.lit(False)).alias("had_offset"),
        F.when(worst > DISAGREEMENT_DAYS, worst.cast("int")).alias("disagreement_days"),
    )
