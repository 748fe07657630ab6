"""The per-agency grid: targets folded to agencies, joined with what is stored, classified."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import ACCESS, BANDS, FAILING_AFTER, HEALTH_SEVERITY, QUIET_AFTER_DAYS, RECENT_DAYS, STALE_AFTER_DAYS
from .columns import days_between, lookup, plural, rank_in

#: Columns a grid may be sorted or filtered by; anything else is refused.
SORTABLE = ("a_id", "domain", "newsroom_url", "health", "severity", "articles", "articles_recent", "last_success_at", "last_article_at", "last_stored_at", "next_due_at", "consec_failures", "targets", "tns_loaded", "tns_pending", "fault_kind", "discovery_method")


def severity(health: Column) -> Column:
    """ok, warn or error; an unknown word warns."""
    return lookup(health, HEALTH_SEVERITY, "warn")


def fold_targets(targets: DataFrame) -> DataFrame:
    """One row per agency of targets(a_id, domain, newsroom_url, enabled, discovery_method, ...).

    Flags are or-ed, failures and paces take the worst, the soonest due time counts, and what belongs
    together (URL, feed, conditional headers) comes from the target that last succeeded - the first by
    (domain, newsroom_url) if none did. A later record without a method keeps the method before it.
    Everything is one pre-aggregating groupBy behind a running maximum; no agency's targets are gathered.
    """
    order = Window.partitionBy("a_id").orderBy("domain", "newsroom_url")
    before = F.max("last_success_at").over(order.rowsBetween(Window.unboundedPreceding, -1))
    rows = targets.withColumn("_n", F.row_number().over(order)).withColumn("_before", before)
    record = (F.col("_n") == 1) | F.coalesce(F.col("last_success_at") > F.col("_before"), F.col("last_success_at").isNotNull() & F.col("_before").isNull())
    rows = rows.withColumn("_at", F.when(record, F.col("_n"))).withColumn("_rank", rank_in(F.col("access"), ACCESS))
    bundle = F.max_by(F.struct("newsroom_url", "feed_url", F.coalesce("feed_absent", F.lit(False)).alias("feed_absent"), "probed_at", (F.col("etag").isNotNull() | F.col("last_modified").isNotNull()).alias("conditional_get")), "_at")
    return (
        rows.groupBy("a_id")
        .agg(
            F.min_by("domain", "_n").alias("domain"),
            bundle.alias("_b"),
            F.max_by("discovery_method", F.when(F.col("discovery_method").isNotNull(), F.col("_at"))).alias("discovery_method"),
            F.count("*").alias("targets"),
            F.count("discovery_method").alias("targets_cached"),
            F.bool_or(F.coalesce("enabled", F.lit(False))).alias("enabled"),
            F.bool_or(F.coalesce("needs_browser", F.lit(False))).alias("needs_browser"),
            F.max(F.coalesce("consec_failures", F.lit(0))).alias("consec_failures"),
            F.max("_rank").alias("_rank"),
            F.max("last_success_at").alias("last_success_at"),
            F.min("next_due_at").alias("next_due_at"),
            F.coalesce(F.max("crawl_delay_s"), F.lit(5.0)).alias("crawl_delay_s"),
            F.coalesce(F.max("revisit_period_s"), F.lit(86400)).alias("revisit_period_s"),
        )
        .select("*", "_b.*", F.when(F.col("_rank") > 0, F.element_at(F.array(*map(F.lit, ACCESS)), F.greatest("_rank", F.lit(1)))).alias("access"))
        .drop("_b", "_rank")
    )


def classify(now: Column, enabled: Column, failures: Column, needs_browser: Column, access: Column, last_success: Column, last_article: Column, articles: Column) -> Column:
    """STRUCT<health, reason>, the most conclusive question first."""
    age, article_age = days_between(now, last_success), days_between(now, last_article)
    said = lambda health, reason: F.struct(F.lit(health).alias("health"), reason.alias("reason"))
    never = F.when(failures == 0, F.lit("never crawled successfully")).otherwise(F.concat(F.lit("never crawled successfully, "), plural(failures, "attempt"), F.lit(" failed")))
    ago = F.concat(plural(age, "day"), F.lit(" ago"))
    access = F.coalesce(access, F.lit(""))
    return (
        F.when(~enabled, said("disabled", F.lit("not being crawled")))
        .when(last_success.isNull(), said("never", never))
        .when(access == "refused", said("refused", F.lit("the publisher's CDN is declining an identified crawler")))
        .when(access == "unresolved", said("unresolved", F.lit("our resolver cannot resolve this host")))
        .when(failures >= FAILING_AFTER, said("failing", F.concat(plural(failures, "crawl"), F.lit(" in a row failed"))))
        .when(needs_browser | access.isin("challenge", "js_rendered"), said("blocked", F.lit("the page needs a browser to render its articles")))
        .when(age >= STALE_AFTER_DAYS, said("stale", F.concat(F.lit("last crawled successfully "), ago)))
        .when(articles == 0, said("empty", F.lit("crawled successfully, but no article was ever stored")))
        .when(article_age >= QUIET_AFTER_DAYS, said("quiet", F.concat(F.lit("crawling fine; nothing published for "), plural(article_age, "day"))))
        .otherwise(said("healthy", F.when(age == 0, F.lit("crawled successfully today")).otherwise(F.concat(F.lit("crawled successfully "), ago))))
    )


def compose(targets: DataFrame, article_stats: DataFrame, inventory: DataFrame, now: datetime, faults: DataFrame | None = None) -> DataFrame:
    """The grid: folded targets with article counts, inventory and worst faults (all by a_id), health, reason and severity.

    A stored article is evidence of a successful crawl. All sides are aggregates by a_id, so the joins share one partitioning.
    """
    out = fold_targets(targets).join(article_stats, "a_id", "left").join(inventory, "a_id", "left")
    zero = {c: F.coalesce(c, F.lit(0)) for c in ("articles", "articles_recent", "tns_loaded", "tns_pending")}
    out = out.withColumns(zero).withColumn("last_success_at", F.greatest("last_success_at", "last_stored_at"))
    if faults is not None:
        out = out.join(faults, "a_id", "left")
    as_of = F.lit(now)
    c = F.col
    told = classify(as_of, c("enabled"), c("consec_failures"), c("needs_browser"), c("access"), c("last_success_at"), c("last_article_at"), c("articles"))
    out = out.withColumn("_c", told).select("*", "_c.health", "_c.reason").drop("_c")
    return out.withColumn("severity", severity(F.col("health"))).withColumn("updated_at", as_of)


def summary(grid: DataFrame) -> DataFrame:
    """kind ('health' or 'severity'), word, n: the counts of each health word and of every severity band, empty bands included."""
    spark = grid.sparkSession
    bands = spark.createDataFrame([("severity", b) for b in BANDS], "kind string, word string")
    words = F.array(*[F.struct(F.lit(k).alias("kind"), F.col(k).alias("word")) for k in ("health", "severity")])
    marginals = grid.select(F.explode(words).alias("m")).groupBy("m.kind", "m.word").agg(F.count("*").alias("n"))
    zero = bands.join(marginals, ["kind", "word"], "left_anti").withColumn("n", F.lit(0).cast("long"))
    return marginals.unionByName(zero).orderBy("kind", F.desc("n"), "word")


def select(grid: DataFrame, severity: str | None = None, health: str | None = None, text: str | None = None, uncached: bool = False, due: datetime | None = None) -> DataFrame:
    """The filters of the grid readers; text is looked for in domain and newsroom_url, whatever its case."""
    for column, value in (("severity", severity), ("health", health)):
        if value is not None:
            grid = grid.where(F.col(column) == value)
    if text:
        grid = grid.where(F.contains(F.lower("domain"), F.lit(text.lower())) | F.contains(F.lower("newsroom_url"), F.lit(text.lower())))
    if uncached:
        grid = grid.where("targets_cached < targets")
    return grid if due is None else grid.where(F.col("next_due_at") <= F.lit(due))


def order(grid: DataFrame, by: str | None = None, descending: bool = False) -> DataFrame:
    """Worst first by default; else by a known column, nulls last both ways, text without case, a_id on ties."""
    if by is None:
        return grid.orderBy(F.array_position(F.array(*map(F.lit, BANDS)), F.col("severity")), F.desc("articles"), "a_id")
    if by not in SORTABLE:
        raise ValueError(f"unknown column: {by}")
    key = F.lower(by) if dict(grid.dtypes)[by] == "string" else F.col(by)
    return grid.orderBy(key.desc_nulls_last() if descending else key.asc_nulls_last(), "a_id")


def page(grid: DataFrame, limit: int, offset: int = 0) -> DataFrame:
    return grid.offset(offset).limit(limit)


def to_json(rows: DataFrame) -> DataFrame:
    """One JSON document per row, as the payload export writes them."""
    return rows.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("json"))


def recent_since(now: datetime) -> Column:
    return F.lit(now) - F.expr(f"INTERVAL {RECENT_DAYS} DAYS")


def html(grid: DataFrame, title: str = "Agency status", most: int = 20_000) -> str:
    """A page that shows the grid by itself: the rows as JSON in a script element, `</` escaped. A report for people: beyond `most` rows it refuses."""
    rows = [r.json for r in to_json(order(grid)).limit(most + 1).collect()]
    if len(rows) > most:
        raise ValueError(f"over {most} rows; filter the grid first")
    data = ("[" + ",".join(rows) + "]").replace("</", "<\\/")
    show = "const t=document.querySelector('table');for(const r of JSON.parse(document.getElementById('rows').textContent)){const l=t.insertRow();for(const k of ['severity','health','a_id','domain','articles','reason'])l.insertCell().textContent=r[k]}"
    return f"<!doctype html><meta charset=utf-8><title>{title}</title><table></table><script type=application/json id=rows>{data}</script><script>{show}</script>"


# ---- what readers of the grid are given
COLUMNS = ("a_id", "domain", "newsroom_url", "health", "severity", "reason", "discovery_method", "targets", "targets_cached", "enabled", "needs_browser", "consec_failures", "articles", "articles_recent", "last_article_at", "last_success_at", "next_due_at", "crawl_delay_s", "revisit_period_s")


def source_label(method: Column, cached: Column, targets: Column) -> Column:
    """The source an agency is solved by, with how many of its targets are where not all: '2/3 solved' isn't solved."""
    part = F.concat(method, F.lit(" ("), cached.cast("string"), F.lit("/"), targets.cast("string"), F.lit(")"))
    return F.when(F.coalesce(method, F.lit("")) == "", "not solved").when(cached < targets, part).otherwise(method)


def as_rows(grid: DataFrame) -> DataFrame:
    """The grid as its table holds it: the columns in order (NULL where the grid has none), booleans as 0 and 1."""
    have = dict(grid.dtypes)
    one = lambda c: F.col(c).cast("int") if have.get(c) == "boolean" else F.col(c) if c in have else F.lit(None)
    return grid.select(*[one(c).alias(c) for c in COLUMNS])


def cast_rows(rows: DataFrame, flags: tuple[str, ...] = ("enabled", "needs_browser")) -> DataFrame:
    """Rows as readers want them: flags that came as numbers are booleans, times are ISO text."""
    new = {c: F.col(c) != 0 for c in flags if c in rows.columns and dict(rows.dtypes)[c] != "boolean"}
    new |= {c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss") for c, t in rows.dtypes if t.startswith("timestamp")}
    return rows.withColumns(new)


def summary_row(grid: DataFrame, updated_at: str = "updated_at") -> DataFrame:
    """One row: total, health and severity as maps of counts (all bands there), and when the grid was last written."""
    counts = summary(grid)
    named = lambda kind: F.map_from_entries(F.sort_array(F.collect_list(F.when(F.col("kind") == kind, F.struct("word", "n")))))
    out = counts.agg(F.coalesce(F.sum(F.when(F.col("kind") == "severity", F.col("n"))), F.lit(0)).alias("total"), named("health").alias("health"), named("severity").alias("severity"))  # closed vocabularies
    fresh = grid.agg(F.max(updated_at).alias("updated_at")) if updated_at in grid.columns else grid.agg(F.max(F.lit(None).cast("timestamp")).alias("updated_at"))
    return out.join(F.broadcast(fresh))  # one row each


def grid_payload(grid: DataFrame, now: datetime, rows: str = "agencies") -> DataFrame:
    """JSON lines of a payload: first generated_at and summary, then each row under the payload's name, worst first; a page that shows it
    joins them. Lines, so that no task holds them all."""
    head = summary_row(grid).select(F.lit(0).alias("_o"), F.to_json(F.struct(F.lit(now.strftime("%Y-%m-%d %H:%M:%S")).alias("generated_at"), F.struct("*").alias("summary")), {"ignoreNullFields": "false"}).alias("json"))
    each = cast_rows(grid).select(F.lit(1).alias("_o"), F.to_json(F.struct(F.struct("*").alias(rows)), {"ignoreNullFields": "false"}).alias("json"))
    return head.unionAll(each).select("json")


def grid_view(grid: DataFrame, health: str | None = None, unsolved: bool = False, text: str | None = None, by: str | None = None, descending: bool = False) -> DataFrame:
    """What the interactive grid shows: health, unsolved and text (an exact a_id, or a part of domain or reason) together, in any order of columns."""
    if health is not None:
        grid = grid.where(F.col("health") == health)
    if unsolved:
        grid = grid.where("targets_cached < targets")
    if text:
        low = text.strip().lower()
        part = lambda c: F.contains(F.lower(F.coalesce(c, F.lit(""))), F.lit(low))
        grid = grid.where((F.col("a_id").cast("string") == low) | part("domain") | (part("reason") if "reason" in grid.columns else F.lit(False)))
    return order(grid, by, descending)


def agency(grid: DataFrame, a_id: int) -> DataFrame:
    """The row of one agency, or none."""
    return grid.where(F.col("a_id") == a_id).limit(1)
