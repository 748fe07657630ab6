"""Audit: measurements judged into findings, a score and a verdict. Measurements are stored, verdicts derived."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import urls
from .columns import percent, upper_median

# ---- fixed values: thresholds
LOW_OVERLAP, SCATTERED_BELOW, NON_NEWS_HEAVY, MIN_PAGE_LINKS = 0.20, 0.40, 0.30, 20
# ---- end of fixed values


def _pct(ratio: Column) -> Column:
    return F.concat(F.bround(ratio * 100, 0).cast("int").cast("string"), F.lit("%"))


def findings(c=F.col) -> Column:
    """ARRAY<STRUCT<code, detail, severity>> of one row of measurements, in the order of the rules."""

    def flag(holds: Column, code, severity: int, *detail) -> Column:
        text = F.concat(*[x if isinstance(x, Column) else F.lit(x) for x in detail])
        return F.when(holds, F.struct((code if isinstance(code, Column) else F.lit(code)).alias("code"), text.alias("detail"), F.lit(severity).alias("severity")))

    kind = F.coalesce(c("unreachable_kind"), F.lit(""))
    out = ~c("reachable") & (kind != "robots")
    ours = kind.isin("dns", "circuit")
    empty = c("reachable") & (c("n_articles") == 0)
    live = c("reachable") & (c("n_articles") > 0)
    thin = c("n_page_links") < MIN_PAGE_LINKS
    known = live & c("overlap").isNotNull()
    s = lambda name: c(name).cast("string")
    other = F.when((kind != "") & (kind != "http_4xx"), F.concat(F.lit(" ("), kind, F.lit(")"))).otherwise(F.lit(""))
    missing = F.array_join(F.array_compact(F.array(*[F.when(~c(f"got_{x}"), F.lit(x)) for x in ("headline", "body", "date")])), ", ")
    why = F.when(missing != "", F.concat(F.lit("missing "), missing)).otherwise(F.concat(F.lit("body rejected as page chrome ("), s("body_chars"), F.lit(" chars)")))
    rules = (
        flag(out & ours, kind, 1, F.when(kind == "dns", "our resolver could not resolve this host").otherwise("we stopped asking before the site answered")),
        flag(out & ~ours, "unreachable", 3, "newsroom page returned ", s("status"), other),
        flag(empty, "no_articles", 3, "discovery returned nothing"),
        flag(known & thin, "page_too_thin", 1, "newsroom page exposed only ", s("n_page_links"), " link(s), so overlap (", _pct(c("overlap")), ") proves nothing"),
        flag(known & ~thin & (c("overlap") == 0), "no_overlap", 3, "none of ", s("n_articles"), " results are linked from the newsroom page"),
        flag(known & ~thin & (c("overlap") > 0) & (c("overlap") < LOW_OVERLAP), "low_overlap", 2, "only ", _pct(c("overlap")), " of results are linked from the newsroom page"),
        flag(live & (c("concentration") < SCATTERED_BELOW), "scattered", 2, "results spread across many paths; biggest is ", F.coalesce(c("top_prefix"), F.lit("None")), " at ", _pct(c("concentration"))),
        flag(live & (c("n_non_news") / F.when(c("n_articles") > 0, c("n_articles")) > NON_NEWS_HEAVY), "non_news_heavy", 2, s("n_non_news"), "/", s("n_articles"), " results look like events or staff pages"),
        flag(live & (c("n_off_domain") > 0), "off_domain", 3, s("n_off_domain"), " result(s) belong to another publisher"),
        flag(live & (c("n_seed_echo") > 0), "seed_echo", 1, "discovery returned the newsroom page itself"),
        flag(live & ~c("scoped"), "unscoped", 1, "source could not be narrowed to the target's section"),
        flag(live & (c("method") == "listing"), "last_resort", 1, "only the listing page worked - no feed, no usable sitemap"),
        flag(live & ~c("extracted"), "article_unfetchable", 3, "the first article returned ", F.when(c("extract_status") > 0, s("extract_status")).otherwise("no response")),
        flag(live & c("extracted") & ~c("usable"), "extract_failed", 3, why),
    )
    return F.array_compact(F.array(*rules))


def judge(measured: DataFrame) -> DataFrame:
    """Measurements with findings, score (severities summed) and verdict. Judging again by today's rules needs no fetch."""
    out = measured.withColumn("findings", findings())
    out = out.withColumn("score", F.aggregate("findings", F.lit(0), lambda a, f: a + f["severity"]))
    broken = F.exists("findings", lambda f: f["severity"] >= 3)
    return out.withColumn("verdict", F.when(broken, "broken").when(F.col("score") >= 2, "suspicious").when(F.col("score") >= 1, "check").otherwise("ok"))


def summarise(judged: DataFrame) -> DataFrame:
    return judged.agg(
        F.count("*").alias("targets"),
        *[F.count_if(F.col("verdict") == v).alias(v) for v in ("broken", "suspicious", "check", "ok")],
        upper_median("overlap").alias("median_overlap"),
        F.count_if(F.col("reachable") & (F.col("n_articles") == 0)).alias("zero_yield"),
        F.count_if(~F.col("reachable")).alias("unreachable"),
        percent(F.count_if(F.col("verdict") == "ok"), F.count("*")).alias("pct_clean"),
    )


def histogram(judged: DataFrame) -> DataFrame:
    """kind (verdict, method, finding), word, n."""
    words = F.concat(
        F.array(F.struct(F.lit("verdict").alias("kind"), F.col("verdict").alias("word")), F.struct(F.lit("method").alias("kind"), F.col("method").alias("word"))),
        F.transform("findings", lambda f: F.struct(F.lit("finding").alias("kind"), f["code"].alias("word"))),
    )
    return judged.select(F.explode(words).alias("w")).groupBy("w.kind", "w.word").agg(F.count("*").alias("n"))


def by_tld(judged: DataFrame) -> DataFrame:
    workable = F.count_if(F.col("verdict").isin("ok", "check"))
    out = judged.groupBy(urls.tld(F.col("domain")).alias("tld")).agg(F.count("*").alias("targets"), F.count_if(F.col("verdict") == "ok").alias("ok"), workable.alias("workable"))
    return out.withColumn("pct_workable", percent(F.col("workable"), F.col("targets"))).orderBy(F.desc("targets"), "tld")


def funnel(judged: DataFrame) -> DataFrame:
    """Probed, fetched and usable articles, each also as a share of the probed."""
    f = F.col("extracted")
    got = [F.count_if(f & F.col(c)).alias(c) for c in ("got_headline", "got_body", "got_date", "usable")]
    out = judged.where("extracted IS NOT NULL").agg(F.count("*").alias("probed"), F.count_if(f).alias("article_fetched"), *got)
    return out.withColumn("pct_fetched", percent(F.col("article_fetched"), F.col("probed"))).withColumn("pct_usable_of_probed", percent(F.col("usable"), F.col("probed")))


def concentration(refs: DataFrame) -> DataFrame:
    """target, top_prefix, concentration of refs(target, pos, url): the commonest parent path, the first met of equals, and its share."""
    per = refs.groupBy("target", urls.parent_path(F.col("url")).alias("prefix")).agg(F.count("*").alias("n"), F.min("pos").alias("first"))
    out = per.groupBy("target").agg(F.max_by("prefix", F.struct("n", -F.col("first"))).alias("top_prefix"), F.max("n").alias("top"), F.sum("n").alias("all"))
    return out.select("target", "top_prefix", F.round(F.col("top") / F.col("all"), 3).alias("concentration"))


def measure(targets: DataFrame, refs: DataFrame, links: DataFrame) -> DataFrame:
    """Ratios of each target of targets(target, domain, newsroom_url) from what was found (refs) and what its page links to (links(target, url)).

    Links and refs meet by (target, canonical url), so a target with very many links is dealt over that key.
    """
    found = refs.select("target", "pos", "url", urls.canonical(F.col("url")).alias("key"))
    linked = links.select("target", urls.canonical(F.col("url")).alias("key")).distinct().withColumn("hit", F.lit(1))
    per_target = targets.select("target", urls.registrable_domain(F.col("newsroom_url")).alias("own"), urls.canonical(F.col("newsroom_url")).alias("seed"))
    rows = found.join(linked, ["target", "key"], "left").join(per_target, "target")
    counted = rows.groupBy("target").agg(
        F.count("*").alias("n_articles"),
        F.count("hit").alias("n_hit"),
        F.count_if(urls.is_non_news(F.col("url"))).alias("n_non_news"),
        F.count_if(urls.registrable_domain(F.col("url")) != F.col("own")).alias("n_off_domain"),
        F.count_if(F.col("key") == F.col("seed")).alias("n_seed_echo"),
    )
    page = linked.groupBy("target").agg(F.count("*").alias("n_page_links"))
    out = targets.join(counted, "target", "left").join(page, "target", "left").join(concentration(refs), "target", "left")
    zero = {c: F.coalesce(c, F.lit(0)) for c in ("n_articles", "n_page_links", "n_non_news", "n_off_domain", "n_seed_echo")}
    return out.withColumn("overlap", F.round(F.col("n_hit") / F.col("n_articles"), 3)).withColumns(zero).drop("n_hit")


def sample(targets: DataFrame, limit: int, seed: int = 0) -> DataFrame:
    """One target a domain in a seeded order: the sampling operator of the audit."""
    first = Window.partitionBy("domain").orderBy("newsroom_url")
    one = targets.withColumn("_n", F.row_number().over(first)).where("_n = 1").drop("_n")
    return one.orderBy(F.xxhash64("domain", F.lit(seed)), "domain").limit(limit)


def waves(targets: DataFrame) -> DataFrame:
    """wave: at most one target of each domain in each."""
    return targets.withColumn("wave", F.row_number().over(Window.partitionBy("domain").orderBy("newsroom_url")))


def unreachable(audited: DataFrame, targets: DataFrame) -> DataFrame:
    """The targets that an earlier run couldn't reach, to be audited again."""
    return targets.join(audited.where(~F.col("reachable")).select("a_id", "newsroom_url").distinct(), ["a_id", "newsroom_url"], "left_semi")
