"""The article store: exact dedup on write, load states, statistics, purge."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text, urls


def keyed(articles: DataFrame) -> DataFrame:
    """articles(url, body, ...) with url_hash, content_hash and body_len."""
    return articles.withColumn("url_hash", urls.url_hash(F.col("url"))).withColumn("content_hash", text.content_hash(F.col("body"))).withColumn("body_len", F.length(F.coalesce("body", F.lit(""))))


def unseen(refs: DataFrame, stored: DataFrame) -> DataFrame:
    """refs whose URL isn't stored yet: asked before any page is parsed."""
    return refs.join(stored.select(F.col("url_hash").alias("_seen")).distinct(), urls.url_hash(F.col("url")) == F.col("_seen"), "left_anti")


def new_articles(incoming: DataFrame, stored: DataFrame) -> DataFrame:
    """Rows to append: of each URL the first by (first_seen_at, url, headline, content_hash), if it isn't stored. The limit of
    one works before the shuffle too, so a URL with many rows is cheap and a body travels once."""
    first = Window.partitionBy("url_hash").orderBy("first_seen_at", "url", "headline", "content_hash")
    rows = incoming.join(stored.select("url_hash").distinct(), "url_hash", "left_anti")
    return rows.withColumn("_n", F.row_number().over(first)).where("_n = 1").drop("_n")


def twins(incoming: DataFrame, stored: DataFrame) -> DataFrame:
    """incoming with twin_url: another stored URL with the same content, the first seen."""
    first = stored.groupBy("content_hash").agg(F.min_by("url", F.struct("first_seen_at", "url")).alias("twin_url"))
    return incoming.join(first, "content_hash", "left")


def article_stats(stored: DataFrame, since: datetime) -> DataFrame:
    recent = F.count_if(F.coalesce("published_at", "first_seen_at") >= F.lit(since))
    return stored.where("a_id IS NOT NULL").groupBy("a_id").agg(F.count("*").alias("articles"), recent.alias("articles_recent"), F.max("published_at").alias("last_article_at"), F.max("first_seen_at").alias("last_stored_at"))


def inventory_stats(stored: DataFrame) -> DataFrame:
    """Pending is all that isn't loaded, rejected rows included."""
    loaded = F.coalesce(F.col("tns_state") == "loaded", F.lit(False))
    return stored.where("a_id IS NOT NULL").groupBy("a_id").agg(F.min("first_seen_at").alias("first_stored_at"), F.count_if(loaded).alias("tns_loaded"), F.count_if(~loaded).alias("tns_pending"))


def store_stats(stored: DataFrame) -> DataFrame:
    """One row: articles, domains, and how many content hashes stand in more than one row."""
    dupes = stored.groupBy("content_hash").count().where("count > 1").agg(F.count("*").alias("body_text_dupes"))
    return stored.agg(F.count("*").alias("articles"), F.count_distinct("domain").alias("domains")).join(F.broadcast(dupes))  # one row each


def by_state(stored: DataFrame) -> DataFrame:
    return stored.groupBy(F.coalesce("tns_state", F.lit("not attempted")).alias("state")).agg(F.count("*").alias("n"))


def mark_loaded(stored: DataFrame, outcomes: DataFrame) -> DataFrame:
    """stored with outcomes(url_hash, state, filename, at) applied; a NULL state changes nothing."""
    new = outcomes.where("state IS NOT NULL").groupBy("url_hash").agg(F.max_by(F.struct("state", "filename", "at"), "at").alias("_o"))
    out = stored.join(new, "url_hash", "left")
    return out.withColumns({"tns_state": F.coalesce("_o.state", "tns_state"), "tns_filename": F.coalesce("_o.filename", "tns_filename"), "tns_at": F.coalesce("_o.at", "tns_at")}).drop("_o")


def pending(stored: DataFrame, limit: int | None = None) -> DataFrame:
    """Never attempted or failed for our own reasons, oldest first; what was rejected stays out."""
    out = stored.where("tns_state IS NULL OR tns_state = 'error'").orderBy("first_seen_at", "url_hash")
    return out if limit is None else out.limit(limit)


def reset_missing(stored: DataFrame, filenames: DataFrame) -> DataFrame:
    """Loads whose row has gone from the wire table are forgotten."""
    there = filenames.select(F.col("filename").alias("tns_filename")).distinct().withColumn("_there", F.lit(True))
    out = stored.join(there, "tns_filename", "left")
    gone = (F.col("tns_state") == "loaded") & F.col("_there").isNull()
    return out.withColumns({c: F.when(~F.coalesce(gone, F.lit(False)), F.col(c)) for c in ("tns_state", "tns_filename", "tns_at")}).select(*stored.columns)


def remove_agency(rows: DataFrame, a_id: int) -> DataFrame:
    return rows.where(F.col("a_id").isNull() | (F.col("a_id") != a_id))


def purge_archive(lines: DataFrame, a_id: int) -> DataFrame:
    """Archive lines (value STRING) without the agency's; a line that is no JSON stays."""
    own = F.get_json_object("value", "$.a_id").try_cast("long")
    return lines.where(own.isNull() | (own != a_id))


def latest(records: DataFrame) -> DataFrame:
    """Of each url the record that came last by (file, pos)."""
    last = Window.partitionBy("url").orderBy(F.desc("file"), F.desc("pos"))
    return records.withColumn("_n", F.row_number().over(last)).where("_n = 1").drop("_n")


def delete(rows: DataFrame, a_ids: list[int] | None) -> DataFrame:
    """None deletes all rows, an empty list none."""
    return rows.limit(0) if a_ids is None else rows.where(~F.col("a_id").isin(a_ids) | F.col("a_id").isNull()) if a_ids else rows


def backfill(pending_rows: DataFrame, archive: DataFrame) -> DataFrame:
    """Rows of the store waiting to be loaded, with headline, body and date of the archive (one record of each url, see latest) and `ready`:
    without a body or a date there the row is left pending."""
    found = archive.select("url", F.col("a_id").alias("_a"), F.col("headline").alias("_h"), F.col("body").alias("_b"), F.col("published_at").alias("_p"))
    out = pending_rows.select("url_hash", "url", "domain", "a_id").join(found, "url", "left")
    ready = (F.coalesce("_b", F.lit("")) != "") & F.col("_p").isNotNull()
    a_id = F.coalesce(F.nullif("_a", F.lit(0)), "a_id", F.lit(0))
    return out.select("url_hash", "url", "domain", a_id.alias("a_id"), F.coalesce("_h", F.lit("")).alias("headline"), F.col("_b").alias("body"), F.col("_p").alias("published_at"), ready.alias("ready"))


def wire_counts(wire: DataFrame, today: date) -> DataFrame:
    """kind, word, n of the wire table wire(status, create_date): all rows, those of today, and those of each status."""
    said = lambda kind, word, holds: F.struct(F.lit(kind).alias("kind"), word.alias("word"), holds.alias("holds"))
    late = F.coalesce(F.to_date("create_date") >= F.lit(today), F.lit(False))
    own = F.array(said("rows", F.lit(""), F.lit(True)), said("today", F.lit(""), late), said("status", F.coalesce(F.nullif("status", F.lit("")), F.lit("(null)")), F.lit(True)))
    counts = wire.select(F.explode(own).alias("w")).groupBy("w.kind", "w.word").agg(F.count_if("w.holds").alias("n"))
    return counts.where("n > 0 OR kind <> 'status'")


def newest_wire(wire: DataFrame, limit: int = 10, a_id: int | None = None) -> DataFrame:
    """The rows loaded last, by pr_id, of all agencies or of one."""
    return (wire if a_id is None else wire.where(F.col("a_id") == a_id)).orderBy(F.desc("pr_id")).limit(limit)


def missing_filenames(loaded: DataFrame, wire: DataFrame) -> DataFrame:
    """filename of loads whose row isn't in the wire table (any more)."""
    return loaded.where("tns_filename IS NOT NULL").select(F.col("tns_filename").alias("filename")).distinct().join(wire.select("filename"), "filename", "left_anti")


def by_ids(rows: DataFrame, ids: Iterable[int], column: str = "a_id") -> DataFrame:
    """Rows of the named ids; no ids, no rows."""
    wanted = sorted({int(i) for i in ids})
    return rows.where(F.col(column).isin(wanted)) if wanted else rows.limit(0)


def search(records: DataFrame, domain_part: str | None = None, last: int | None = None) -> DataFrame:
    """Archive records whose domain holds a text, the newest `last` of them by (file, pos)."""
    out = records if domain_part is None else records.where(F.contains(F.lower("domain"), F.lit(domain_part.lower())))
    out = out.orderBy(F.desc("file"), F.desc("pos"))
    return out if last is None else out.limit(last)
