"""Wire records: build a row or say why not, and settle filename collisions."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..storage import checkpointed

# ---- fixed values: house style
MONTHS = ("Jan.", "Feb.", "March", "April", "May", "June", "July", "Aug.", "Sept.", "Oct.", "Nov.", "Dec.")
STRIPPED = (r"#\s?#\s?#", r"\*\s?\*\s?\*\s", r"##\s\s", r"\s~~~~\s", r"(__)_*", r"FOR IMMEDIATE RELEASE(:)?", r"For Immediate Release", r"IMMEDIATE RELEASE", r"\(link is external\)", r"[Oo]pens in new window")
SPACING = ((r"\n\s*\n", "\n\n"), (r"(\r\n|\r|\n)+", "\n\n"), (r"\.[^\S\n]+", ". "), (r"[^\S\n]*\.", "."), (r"[^\S\n]*,", ","), (r"  ", " "), (r"\.\"[^\S\n]+", '." '))
TAIL_WIDTHS = (10, 15, 20, 25, 30, 40)
MIN_WORDS, SHORT_WORDS, BODY_MAX, HEADLINE_MAX, NAME_MAX = 100, 250, 65_535, 254, 100
PUNCTUATION = {"‘": "'", "’": "'", "‚": ",", "“": '"', "”": '"', "„": ",,", "–": "-", "—": "--", "…": "...", " ": " ", "•": "*", "€": "EUR", "™": "(tm)", "©": "(c)", "®": "(r)", "ß": "ss", "Æ": "AE", "æ": "ae", "Ø": "O", "ø": "o", "Œ": "OE", "œ": "oe"}
# ---- end of fixed values


def transliterate(value: str) -> str:
    out = "".join(PUNCTUATION.get(c, c) for c in value)
    return unicodedata.normalize("NFKD", out).encode("ascii", "ignore").decode()


@F.pandas_udf(StringType())
def _ascii(values: pd.Series) -> pd.Series:
    return values.map(lambda v: v if v is None or v.isascii() else transliterate(v))


def to_ascii(text: Column) -> Column:
    """ASCII form; only texts that aren't ASCII cross to Python, the others cross as NULL."""
    odd = F.when(text.rlike(r"[^\x00-\x7F]"), text)
    return F.coalesce(_ascii(odd), text, F.lit(""))


def lede(template: Column, published: Column) -> Column:
    """The template with its DATE as the house writes it, without a year."""
    day = F.concat(F.element_at(F.array(*map(F.lit, MONTHS)), F.month(published)), F.lit(" "), F.dayofmonth(published).cast("string"))
    return F.replace(F.coalesce(template, F.lit("")), F.lit("DATE"), day)


def location(template: Column) -> Column:
    """The place a template opens with, NULL without one."""
    return F.nullif(F.substring(F.trim(F.regexp_extract(F.coalesce(template, F.lit("")), r"^(.{1,100}?),\s*DATE\b", 1)), 1, 100), F.lit(""))


def filename(prefix: Column, published: Column, headline: Column, width: int = 10) -> Column:
    tail = F.when(F.length(headline) <= width, headline).otherwise(F.right(headline, F.lit(width)))
    date = F.coalesce(F.date_format(published, "yyMMdd"), F.lit("000000"))
    return F.substring(F.concat(F.lit("$H "), prefix, date, F.coalesce(tail, F.lit(""))), 1, NAME_MAX)


def clean(text: Column) -> Column:
    for pattern in STRIPPED:
        text = F.regexp_replace(text, pattern, "")
    return F.regexp_replace(text, r"--(\s)?", "-")


def normalise(body: Column) -> Column:
    for pattern, new in SPACING:
        body = F.regexp_replace(body, pattern, new)
    return body


def compose(lede_: Column, headline: Column, description: Column, url: Column) -> Column:
    return normalise(F.concat(lede_, F.lit("\n\n* * *\n\n"), headline, F.lit("\n*\n"), description, F.lit("\n\n***\n\nOriginal text here: "), url))


def build(articles: DataFrame, agencies: DataFrame, status: str = "D") -> DataFrame:
    """A row of each article (a_id, headline, body, published, url): composed, or with reject_reason.

    Reasons, in order: no_agency, no_lede, no_headline, too_short (once every copy of the headline is out of the body), too_long.
    agencies(a_id, prefix, lede, uname) joins by a_id; Spark broadcasts it only where its size allows.
    """
    out = articles.join(agencies.select("a_id", "prefix", "lede", "uname", F.lit(True).alias("_known")), "a_id", "left")
    out = out.withColumn("headline", F.trim(to_ascii(F.col("headline")))).withColumn("_text", clean(to_ascii(F.col("body"))))
    out = out.withColumn("_text", F.when(F.col("headline") != "", F.replace("_text", F.col("headline"), F.lit(""))).otherwise(F.col("_text")))
    out = out.withColumn("word_count", F.regexp_count("_text", F.lit(r"\S+")))
    out = out.withColumn("body_txt", compose(lede(F.col("lede"), F.col("published")), F.col("headline"), F.col("_text"), F.col("url")))
    reason = (
        F.when(F.col("_known").isNull(), "no_agency")
        .when(F.coalesce("lede", F.lit("")) == "", "no_lede")
        .when(F.col("headline") == "", "no_headline")
        .when(F.col("word_count") <= MIN_WORDS, "too_short")
        .when(F.length("body_txt") > BODY_MAX, "too_long")
    )
    short = F.col("word_count") <= SHORT_WORDS
    out = out.withColumns({"reject_reason": reason, "status": F.when(short, "W").otherwise(status), "headline2": F.when(short, "short doc").otherwise(""), "location": location(F.col("lede")), "headline_full": F.col("headline")})
    out = out.withColumns({"filename": filename(F.col("prefix"), F.col("published"), F.col("headline")), "headline": F.substring("headline", 1, HEADLINE_MAX)})
    kept = [F.when(F.col("reject_reason").isNull(), F.col(c)).alias(c) for c in ("body_txt", "status", "headline2", "filename", "location")]
    return out.select("a_id", "url", "published", "prefix", "uname", "headline", "headline_full", "word_count", *kept, "reject_reason")


def load_state(outcome: Column) -> Column:
    """What the article store notes of a load: only our own errors may be tried again."""
    return F.when(outcome == "inserted", "loaded").when(outcome == "duplicate", "loaded").when(outcome == "insert_error", "error").otherwise(F.concat(F.lit("rejected:"), outcome))


def resolve(rows: DataFrame, existing: DataFrame) -> DataFrame:
    """rows with outcome (inserted or duplicate), filename and width against existing(filename, a_id, headline).

    One rung of tail widths after the other, six at most: a name that is free goes to the first claimant by
    (published, url), then by the other columns; the same agency and headline under that name is a duplicate; losers try the next width,
    and are duplicates when a wider tail adds nothing. Claims are picked by pre-aggregating minima. Rows equal in all
    columns climb as one; each keeps its row, and all but one are duplicates.
    """
    columns = [c for c in rows.columns if c != "filename"]
    open_ = rows.groupBy(*columns).agg(F.count("*").alias("_n")).withColumn("_key", F.struct("published", "url", *sorted({*columns} - {"published", "url"})))
    taken = existing.select("filename", "a_id", "headline")
    settled = None
    for rung, width in enumerate(TAIL_WIDTHS):
        name = filename(F.col("prefix"), F.col("published"), F.col("headline_full"), width)
        exhausted = (F.length("headline_full") <= TAIL_WIDTHS[rung - 1]) if rung else F.lit(False)
        tried = open_.withColumn("filename", name).withColumn("_spent", exhausted)
        owners = taken.groupBy("filename").agg(F.first("a_id").alias("_a"), F.first("headline").alias("_h"))
        firsts = tried.where("NOT _spent").join(owners, "filename", "left_anti").groupBy("filename").agg(F.min_by(F.struct("a_id", "headline", "_key"), "_key").alias("_w"))
        claims = owners.select("filename", "_a", "_h", F.lit(None).alias("_by")).unionAll(firsts.select("filename", "_w.a_id", "_w.headline", "_w._key"))
        judged = tried.join(claims.select("filename", F.col("_a").alias("_ca"), F.col("_h").alias("_ch"), F.col("_by").alias("_cb")), "filename", "left")
        won = ~F.col("_spent") & F.coalesce(F.col("_cb") == F.col("_key"), F.lit(False))
        same = ~F.col("_spent") & (F.col("_ca") == F.col("a_id")) & (F.col("_ch") == F.col("headline"))
        last = rung == len(TAIL_WIDTHS) - 1
        outcome = F.when(won, "inserted").when(F.col("_spent") | F.coalesce(same, F.lit(False)) | F.lit(last), "duplicate")
        judged = judged.withColumn("outcome", outcome).withColumn("width", F.lit(width))
        judged = checkpointed(judged)  # each rung reads the last several times
        done = judged.where("outcome IS NOT NULL").select(*columns, "filename", "outcome", "width", "_n")
        settled = done if settled is None else settled.unionByName(done)
        taken = taken.unionByName(judged.where("outcome = 'inserted'").select("filename", "a_id", "headline"))
        open_ = judged.where("outcome IS NULL").select(*open_.columns)
    each = settled.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_n"))))
    return each.withColumn("outcome", F.when(F.col("_copy") == 1, F.col("outcome")).otherwise("duplicate")).drop("_n", "_copy")


def coverage(wanted: DataFrame, agencies: DataFrame) -> DataFrame:
    """One row: wanted agencies known, missing, without a byline and unusable, with the first 20 missing ids."""
    both = wanted.select("a_id").distinct().join(agencies, "a_id", "left").withColumn("_known", F.col("prefix").isNotNull() | F.col("lede").isNotNull() | F.col("uname").isNotNull())
    blank = lambda c: F.coalesce(F.col(c), F.lit("")) == ""
    counts = both.agg(F.count("*").alias("wanted"), F.count_if("_known").alias("known"), F.count_if(~F.col("_known")).alias("missing"), F.count_if(F.col("_known") & (blank("uname") | (F.col("uname") == "-1"))).alias("no_uname"), F.count_if(F.col("_known") & (blank("prefix") | blank("lede"))).alias("unusable"))
    first = both.where(~F.col("_known")).orderBy("a_id").limit(20).agg(F.sort_array(F.collect_list("a_id")).alias("missing_ids"))  # 20 rows at most
    return counts.join(F.broadcast(first))
