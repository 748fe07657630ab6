"""Text measures and cleaning as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values: patterns of page furniture and of prose
TAIL_HEADING = r"(?i)^\s*(related|more from|read next|read more|share this|share it|comments?|newsletter|subscribe|sign up|follow us|about the author|tags?|you may also like|recommended|trending|most read)\b"
FURNITURE = (r"(?m)^\s*#\s?#\s?#\s*$", r"(?m)^\s*-30-\s*$", r"(?i)FOR IMMEDIATE RELEASE:?\s*", r"(?i)\(link is external\)", r"(?im)^\s*Opens in (a )?new (window|tab)\s*$")
DATELINE = r"^\s*[A-Z][A-Za-z.\s]{2,30}?(?:,\s*[A-Z][A-Za-z.\s]{2,20})?\s*[-–—]{1,3}\s+"
SENTENCE_END = r'(?<![A-Z])[.!?](?:\s+[A-Z"“]|\s*$)'
CHROME_BELOW, WINDOW_CHARS = 0.30, 1500
# ---- end of fixed values
_STRIP = r"^[\s 　]+|[\s 　]+$"


def strip(text: Column) -> Column:
    return F.regexp_replace(text, _STRIP, "")


def word_set(text: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}_]+"), F.lit(0)))


def overlap(a: Column, b: Column) -> Column:
    """Jaccard of the two texts' word sets; 0 if either has none."""
    x, y = word_set(a), word_set(b)
    both = F.size(F.array_intersect(x, y))
    return F.when((F.size(x) == 0) | (F.size(y) == 0), F.lit(0.0)).otherwise(both / (F.size(x) + F.size(y) - both))


def cut_tail(text: Column) -> Column:
    """Up to the first short line that heads a non-article section, once 300 characters stand before it."""
    start = F.struct(F.array().cast("array<string>").alias("kept"), F.lit(0).alias("chars"), F.lit(False).alias("over"))

    def step(acc, line):
        bare = strip(line)
        over = acc["over"] | ((bare != "") & (F.length(bare) <= 60) & bare.rlike(TAIL_HEADING) & (acc["chars"] >= 300))
        return F.struct(
            F.when(over, acc["kept"]).otherwise(F.concat(acc["kept"], F.array(line))).alias("kept"),
            F.when(over, acc["chars"]).otherwise(acc["chars"] + F.length(line)).alias("chars"),
            over.alias("over"),
        )

    cut = F.aggregate(F.split(text, "\n"), start, step)
    return F.when(cut["over"], F.regexp_replace(F.array_join(cut["kept"], "\n"), r"\s+$", "")).otherwise(text)


def clean_body(text: Column, dateline: bool = True) -> Column:
    """Line ends, release furniture, tail sections, dateline and blank runs put right; NULL if nothing is left."""
    out = F.regexp_replace(text, "\r\n?", "\n")
    for pattern in FURNITURE:
        out = F.regexp_replace(out, pattern, "")
    out = cut_tail(out)
    if dateline:
        out = F.regexp_replace(out, DATELINE, "")
    for pattern, new in ((r"\n{3,}", "\n\n"), (r"[ \t]+\n", "\n"), (r"[ \t]{2,}", " ")):
        out = F.regexp_replace(out, pattern, new)
    return F.nullif(strip(out), F.lit(""))


def prose_ratio(text: Column) -> Column:
    """Mean of the share of long lines and of the sentence ends found against those expected, to three places."""
    lines = F.filter(F.transform(F.split(text, "\n"), strip), lambda x: x != "")
    long_share = F.size(F.filter(lines, lambda x: F.length(x) >= 60)) / F.size(lines)
    expected = F.greatest(F.lit(1.0), F.length(text) / 150.0)
    sentences = F.least(F.lit(1.0), F.regexp_count(text, F.lit(SENTENCE_END)) / expected)
    return F.when(text.isNull() | (F.size(lines) == 0), F.lit(0.0)).otherwise(F.bround((long_share + sentences) / 2, 3))


def content_hash(body: Column) -> Column:
    """sha256 of the lower-cased body with runs of anything but ASCII letters and digits as one blank. Bodies
    without ASCII letters or digits all hash alike; unicode_hash tells them apart."""
    return F.sha2(F.trim(F.regexp_replace(F.lower(F.coalesce(body, F.lit(""))), "[^A-Za-z0-9]+", " ")), 256)


def unicode_hash(body: Column) -> Column:
    return F.sha2(F.trim(F.regexp_replace(F.lower(F.coalesce(body, F.lit(""))), r"[^\p{L}\p{N}]+", " ")), 256)


def coherence(headline: Column, body: Column) -> Column:
    """Share of the headline's words of more than two letters, stop words aside, that the body's first 1,500 characters hold."""
    stop = ("the", "and", "for", "with", "from", "that", "this", "are", "was", "has", "its", "new", "will", "after", "over", "into")
    words = F.filter(F.regexp_extract_all(F.lower(headline), F.lit(r"[\p{L}\p{N}_]+"), F.lit(0)), lambda w: (F.length(w) > 2) & ~w.isin(*stop))
    lead = F.lower(F.substring(body, 1, 1500))
    found = F.size(F.filter(words, lambda w: F.contains(lead, w)))
    return F.when(F.size(words) == 0, F.lit(1.0)).otherwise(F.bround(found / F.size(words), 3))


def strip_leading_headline(body: Column, headline: Column) -> Column:
    starts = F.lower(body).startswith(F.lower(headline)) & (F.length(headline) > 0)
    return F.when(starts, F.regexp_replace(F.substr(body, F.length(headline) + 1), r"^[\s\-–—:|]+", "")).otherwise(body)


def strip_tags(text: Column) -> Column:
    """Markup out, the commonest character references decoded."""
    out = F.regexp_replace(text, "<[^>]+>", "")
    for name, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")):
        out = F.regexp_replace(out, name, char)
    return strip(out)
