"""Functions and operators on cases as the survey lists them, against small models."""

import json
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

import __spark_entry__
from presslake import schemas, storage
from presslake.functions import dates, responses, shards, text, urls
from presslake.operators import articles, audit, discover, extract, faults, frontier, lists, politeness, records, status, validation
from presslake.plans import crawl
from presslake.sources import feeds, pages, tables
from presslake.streaming import faults as stream

NOW = datetime(2026, 8, 29, 12)


def values(spark, rows, schema, **columns):
    return spark.createDataFrame(rows, schema).withColumns(columns).collect()


def test_canonical_urls(spark):
    cases = {
        "HTTPS://WWW.Example.com:443//a//b/?utm_source=x&b=2&a=1#top": "https://example.com/a/b?a=1&b=2",
        "http://example.com:80": "http://example.com/",
        "http://example.com:8080/x/": "http://example.com:8080/x",
        "https://www.gov.uk/news": "https://www.gov.uk/news",
        "//example.com/a|b c%": "https://example.com/a|b c%",
        "mailto:x": "",
        "https://e.org/p?z&ref=1": "https://e.org/p?z=",
    }
    for r in values(spark, list(cases.items()), "url string, want string", got=urls.canonical(F.col("url"))):
        assert r.got == r.want, r.url


def test_registrable_domains(spark):
    cases = {"https://news.bbc.co.uk/x": "bbc.co.uk", "www.example.com": "example.com", "gov.uk": "gov.uk", "127.0.0.1": "127.0.0.1", "intranet": "intranet", "": "", "A.B.Example.Org.": "example.org"}
    for r in values(spark, list(cases.items()), "url string, want string", got=urls.registrable_domain(F.col("url"))):
        assert r.got == r.want


def test_article_urls(spark):
    cases = {
        "https://x.org/news/2026/08/mayor-opens-bridge": True, "https://x.org/newsroom": False, "https://x.org/news/2026": False, "https://x.org/node/352363": True,
        "https://x.org/event/2026-08/welcome-week": False, "https://x.org/about/edison-foundation/1879-society-page": False, "https://x.org/about/news/mayor-visits-town": True, "https://x.org/category/some-long-topic-name": False,
    }
    for r in values(spark, list(cases.items()), "url string, want boolean", got=urls.classify(F.col("url"))["is_article"]):
        assert r.got == r.want, r.url


def test_url_join(spark):
    cases = [("https://a.org/x/y", "../z", "https://a.org/z"), ("https://a.org/x/y", "z?q", "https://a.org/x/z?q"), ("https://a.org/x/", "//b.org/c", "https://b.org/c"), ("https://a.org/x", "/r/./s", "https://a.org/r/s"), ("https://a.org", "p", "https://a.org/p"), ("https://a.org/x", "https://c.org/", "https://c.org/")]
    for r in values(spark, cases, "base string, ref string, want string", got=urls.join(F.col("base"), F.col("ref"))):
        assert r.got == r.want, (r.base, r.ref)


def test_shards(spark):
    got = {r.url: r.got for r in values(spark, [("a.org",), ("b.org",), (None,)], "url string", got=shards.shard(F.col("url")))}
    assert got[None] is None and got["a.org"] == shards.shard_of("a.org") and 0 <= got["b.org"] < 1024
    ranges = urls.shard_ranges(7)
    assert ranges[0][0] == 0 and ranges[-1][1] == 1024 and {b - a for a, b in ranges} <= {146, 147} and all(x[1] == y[0] for x, y in zip(ranges, ranges[1:]))


def test_body_cleaning(spark):
    long = "A sentence of the story that goes on for a while and then ends. " * 8
    rows = [("FOR IMMEDIATE RELEASE: \r\nCHICAGO, Ill. -- " + long + "\n\n\n\nRelated stories\nmore", long.strip()), ("Related\nshort", "Related\nshort"), ("", None), (None, None)]
    for r in values(spark, rows, "body string, want string", got=text.clean_body(F.col("body"))):
        assert r.got == r.want


def test_prose_ratio(spark):
    prose = ("This is a long line of prose that goes on and on until it ends here. " * 3 + "\n") * 4
    got = values(spark, [(prose,), ("Home\nNews\nAbout\nContact",), (None,)], "body string", got=text.prose_ratio(F.col("body")))
    assert got[0].got > 0.8 and got[1].got < 0.3 and got[2].got == 0.0


def test_dates(spark):
    cases = {"2026-08-20T10:00:00+02:00": "2026-08-20 08:00:00", "Thu, 20 Aug 2026 10:00:00 GMT": "2026-08-20 10:00:00", "August 5, 2026": "2026-08-05 00:00:00", "2031-01-01": None, "1980-01-01": None, "nonsense": None}
    for r in values(spark, list(cases.items()), "raw string, want string", got=F.date_format(dates.parse(F.col("raw"), NOW), "yyyy-MM-dd HH:mm:ss")):
        assert r.got == r.want, r.raw
    found = values(spark, [("https://x.org/1999/05/03/a",), ("https://x.org/20260817-b",), ("https://x.org/2026/13/a",)], "url string", got=F.date_format(dates.from_url(F.col("url"), NOW), "yyyy-MM-dd"))
    assert [r.got for r in found] == ["1999-05-03", "2026-08-17", None]


def test_date_priority(spark):
    c = lambda s, d: F.struct(F.lit(s).alias("source"), F.to_timestamp(F.lit(d)).alias("value"), F.lit(d).alias("raw"))
    all_ = F.array(c("sitemap", "2026-08-01"), c("jsonld", "2026-08-20"), c("htmldate", "2026-08-19"))
    strong, weak = spark.range(1).select(dates.resolve(all_, F.lit(False)).alias("s"), dates.resolve(all_, F.lit(True)).alias("w")).first()
    assert (strong.source, strong.disagreement_days, strong.precision) == ("jsonld", 19, "day") and weak.source == "htmldate"


def test_failure_kinds_and_walls(spark):
    rows = [(None, "DNSError: x", 0, "dns"), (None, "robots-disallow", 0, "robots"), ("Just a moment", None, 200, "wall"), (None, None, 503, "http_5xx"), (None, "Whatever", 0, "error"), (None, None, 204, "ok"), (None, None, 301, "error")]
    for r in values(spark, rows, "wall string, error string, status int, want string", got=responses.failure_kind(F.col("wall"), F.col("error"), F.lit(False), F.col("status"))):
        assert r.got == r.want
    walls = values(spark, [("<title>Just a moment...</title>",), ("<script src=awswaf>",), ("<title>News</title>" + "x" * 9000 + "awswaf",)], "html string", got=responses.detect_wall(F.col("html")))
    assert [r.got for r in walls] == ["just a moment...", "js challenge (awswaf)", None]
    waits = values(spark, [("120",), ("-5",), ("Sat, 29 Aug 2026 12:01:30 GMT",), ("soon",), (None,)], "v string", got=responses.retry_after(F.col("v"), F.lit(NOW)))
    assert [r.got for r in waits] == [120.0, 0.0, 90.0, 60.0, 60.0]


def test_vocabularies_are_total():
    assert set(schemas.FAULT_KINDS) <= set(schemas.SEVERITY) and set(schemas.HEALTH_SEVERITY.values()) == set(schemas.BANDS) and set(schemas.OWNER.values()) <= set(schemas.OWNERS)


def test_breadth_beats_volume_and_policy_scores_nothing(spark):
    rows = [("r", "timeout", f"d{i}", i, 1) for i in range(9)] + [("r", "error", "d0", 0, 500), ("r", "robots", "d1", 1, 900), ("r", "brand_new", "d2", 2, 1)]
    f = spark.createDataFrame(rows, "run_id string, kind string, domain string, a_id int, n int").withColumns({"first_at": F.lit(NOW), "last_at": F.lit(NOW), "sample_url": F.lit("u"), "sample_detail": F.lit("x")})
    got = {r.kind: r for r in faults.tally(f).collect()}
    assert got["timeout"].score == 18 and got["timeout"].band == "urgent" and got["error"].score == 9 and got["robots"].score == 0 and (got["brand_new"].severity, got["brand_new"].owner) == (3, "us")
    assert faults.worst_for_agency(f).where("a_id = 0").first().fault_kind == "error"
    twice = faults.add(f, f).agg(F.sum("n")).first()[0]
    assert twice == 2 * sum(r[4] for r in rows)


@pytest.mark.parametrize(
    "row, want",
    [((False, 0, False, None, NOW, NOW, 5), "disabled"), ((True, 2, False, None, None, None, 0), "never"), ((True, 9, False, "refused", NOW, NOW, 5), "refused"), ((True, 3, False, None, NOW, NOW, 5), "failing"), ((True, 0, True, None, NOW, NOW, 5), "blocked"),
     ((True, 0, False, None, datetime(2026, 8, 1), NOW, 5), "stale"), ((True, 0, False, None, NOW, None, 0), "empty"), ((True, 0, False, None, NOW, datetime(2026, 1, 1), 5), "quiet"), ((True, 0, False, None, NOW, NOW, 5), "healthy")],
)
def test_health(spark, row, want):
    df = spark.createDataFrame([row], "enabled boolean, f int, b boolean, access string, ls timestamp, la timestamp, n int")
    assert df.select(status.classify(F.lit(NOW), *map(F.col, ("enabled", "f", "b", "access", "ls", "la", "n")))["health"]).first()[0] == want


def test_upper_median_and_audit(spark):
    from presslake.operators.columns import upper_median

    assert spark.createDataFrame([(1.0,), (2.0,), (2.0,), (5.0,), (None,)], "v double").agg(upper_median("v")).first()[0] == 2.0
    assert spark.createDataFrame([(1.0,), (3.0,)], "v double").agg(upper_median("v")).first()[0] == 3.0


def test_filename_ladder(spark):
    day = date(2026, 8, 1)
    heads = ["Mayor opens the new bridge", "Council closes the new bridge", "Mayor opens the new bridge", "new bridge"]
    rows = [(1, f"u{i}", day, "pre", h, h) for i, h in enumerate(heads)]
    out = {r.url: r for r in records.resolve(spark.createDataFrame(rows, "a_id int, url string, published date, prefix string, headline string, headline_full string"), spark.createDataFrame([], "filename string, a_id int, headline string")).collect()}
    assert (out["u0"].outcome, out["u0"].width) == ("inserted", 10) and out["u2"].outcome == "duplicate"
    assert out["u1"].outcome == "inserted" and out["u1"].width == 15 and out["u3"].outcome == "duplicate"


def test_wire_rejections(spark):
    body = "word " * 300
    rows = [(1, "Title — “x”", body, "u1"), (1, "", body, "u2"), (2, "T", body, "u3"), (9, "T", body, "u4"), (1, "T", "few", "u5")]
    art = spark.createDataFrame(rows, "a_id int, headline string, body string, url string").withColumn("published", F.lit(date(2026, 9, 1)))
    ag = spark.createDataFrame([(1, "p", "TOWN, DATE -- ", "u"), (2, "p", "", "u")], "a_id int, prefix string, lede string, uname string")
    got = {r.url: r for r in records.build(art, ag).collect()}
    assert [got[f"u{i}"].reject_reason for i in range(1, 6)] == [None, "no_headline", "no_lede", "no_agency", "too_short"]
    assert got["u1"].headline == 'Title -- "x"' and got["u1"].body_txt.startswith("TOWN, Sept. 1") and got["u1"].location == "TOWN"


def test_feeds_sitemaps_and_robots(spark):
    rss = "<rss><channel><item><title>A &amp; B</title><link>https://x.org/a</link><pubDate>d</pubDate><content:encoded><![CDATA[<p>long</p>]]></content:encoded><description>short</description></item><item><guid>https://x.org/g</guid><title>broken"
    atom = '<feed><entry><title>T</title><link rel="self" href="s"/><link href="https://x.org/e"/><updated>2026</updated></entry></feed>'
    assert [(i["url"], i["headline"], i["body_html"]) for i in feeds.feed_items(rss)] == [("https://x.org/a", "A & B", "<p>long</p>"), ("https://x.org/g", None, None)]
    assert feeds.feed_items(atom)[0]["url"] == "https://x.org/e" and feeds.feed_items(None) == []
    site = "<urlset><url><loc>https://x.org/1</loc><lastmod>2025</lastmod><news:news><news:publication_date>2026</news:publication_date><news:title>N</news:title></news:news></url><sitemap><loc>https://x.org/s.xml</loc></sitemap></urlset>"
    got = feeds.sitemap_items(site)
    assert {g["kind"] for g in got} == {"ref", "child"} and next(g for g in got if g["kind"] == "ref")["source"] == "news_sitemap"
    robots = "User-agent: *\nDisallow: /a\nAllow: /a/b\nContent-Signal: search=yes, ai-train=no\nSitemap: https://x.org/s.xml\nCrawl-delay: 7"
    assert not feeds.allows(robots, "/a/x") and feeds.allows(robots, "/a/b/c") and feeds.allows(robots, "/a", status=404)
    r = values(spark, [(robots,)], "b string", s=feeds.robots_sitemaps(F.col("b")), d=feeds.crawl_delay(F.col("b")), c=feeds.content_signals(F.col("b")))[0]
    assert r.s == ["https://x.org/s.xml"] and r.d == 7.0 and r.c == {"search": True, "ai-train": False}
    assert feeds.items(spark.createDataFrame([(1, rss), (2, None)], "doc long, body string"), "feed").count() == 2
    wp = json.dumps([{"link": "https://x.org/p", "date_gmt": "2026", "title": {"rendered": "<b>T</b>"}, "content": {"rendered": "c"}}, {"x": 1}])
    assert [(x.url, x.headline) for x in feeds.wordpress_refs(spark.createDataFrame([(1, wp), (2, "{}")], "doc long, body string")).collect()] == [("https://x.org/p", "T")]


def _broadcasts(df):
    return df._jdf.queryExecution().executedPlan().toString().count("BroadcastExchange")


def test_links_are_resolved_once(spark):
    links = spark.createDataFrame([("t", "https://a.org/news", "https://a.org/news/", "../news/2026/08/a-long-story", False, 0), ("t", "https://a.org/news", "https://a.org/news/", "/x/2026/08/b-long-story", False, 1)], "target string, newsroom_url string, base_url string, href string, in_chrome boolean, pos int")
    found = discover.harvest(links)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("mailto:") == 1 and len(plan) < 60_000
    assert [r.url for r in found.collect()] == ["https://a.org/news/2026/08/a-long-story"]
    assert [r.url for r in discover.harvest(links.where("pos = 1")).collect()] == ["https://a.org/x/2026/08/b-long-story"]


def test_links_of_targets_are_not_broadcast(spark):
    targets = spark.createDataFrame([("t", "https://a.org/press")], "target string, newsroom_url string")
    refs = spark.createDataFrame([("t", "rss", "rss", "https://a.org/blog/2026/08/a-long-story", True, "https://a.org/feed")], "target string, method string, source string, url string, declared boolean, feed_url string")
    links = targets.select("target", F.explode(F.array(*[F.lit(f"https://a.org/page/{k}") for k in range(25)])).alias("url"))
    assert _broadcasts(discover.cascade(refs, targets, links)) == 0
    assert [tuple(r) for r in discover.cascade(refs, targets, links).collect()] == [("t", "none", 0)]


def test_answers_are_dealt_to_paths(spark):
    schema = "target string, newsroom_url string, base_url string, feed_url string, feed_absent boolean, probed_at timestamp"
    targets = spark.createDataFrame([("t", "https://a.org/news/", "https://a.org/news/", None, False, None), ("u", "https://b.org/", "https://b.org/", None, False, None)], schema)
    probes = spark.createDataFrame([("https://a.org/news/feed", True, True), ("https://a.org/rss.xml", True, True), ("https://a.org/feed", False, True), ("https://b.org/x/feed", True, True)], "url string, ok boolean, is_feed boolean")
    found = discover.find_feeds(targets, spark.createDataFrame([], "target string, pos int, href string"), probes, NOW)
    assert {tuple(r) for r in found.collect()} == {("t", "https://a.org/rss.xml", False, False), ("u", None, False, True)}
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    probing = next(line for line in plan.splitlines() if "posexplode" in line)
    assert "newsroom_url" not in probing and _broadcasts(found) == 0


def test_a_year_in_the_host_ranks_no_sitemap(spark):
    rows = spark.createDataFrame([("https://site2012.org/page-map",), ("https://site2012.org/archive-2026",), ("https://site2012.org/map?y=2026",), ("https://news.site.org/map",)], "url string")
    assert [r.p for r in rows.select(feeds.sitemap_priority(F.col("url"), F.lit(None).cast("string")).alias("p")).collect()] == [4, 3, 3, 1]


def test_page_facts_and_record(spark):
    ld = json.dumps({"@graph": [{"@type": ["NewsArticle"], "headline": "Harbour bridge opens", "datePublished": "2026-08-20"}]})
    body = "The harbour bridge opens to traffic on Monday after long works in the town. " * 8
    html = f"<html><head><title>Harbour bridge opens | News</title><script type='application/ld+json'>{ld}</script><script type='application/ld+json'>{{bad</script></head><body><nav><a href='/n'>menu</a></nav><article><h1>Harbour bridge opens</h1><p>{body}</p></article></body></html>"
    parsed = pages.parse(spark.createDataFrame([(1, "https://x.org/a", html), (2, "https://x.org/b", None)], "page_id long, url string, html string"))
    got = {r.page_id: r for r in extract.records(parsed, NOW).collect()}
    assert got[1].headline == "Harbour bridge opens" and got[1].headline_source == "jsonld" and got[1].date.source == "jsonld" and got[1].unusable is None
    assert got[2].unusable == "extract_no_headline"


def test_discovery(spark):
    targets = spark.createDataFrame([("t", "https://x.org/press")], "target string, newsroom_url string")
    links = spark.createDataFrame([("t", "https://x.org/press", h, c) for h, c in [("/press/2026/08/a-b-c", False), ("/other/2026/08/d-e-f", False), ("https://y.org/2026/08/g-h-i", False), ("/press", False)]], "target string, newsroom_url string, href string, in_chrome boolean")
    assert [r.url for r in discover.harvest(links).collect()] == ["https://x.org/press/2026/08/a-b-c"]
    refs = spark.createDataFrame([("t", "rss", f"https://y.org/{i}", False) for i in range(6)] + [("t", "sitemap", "https://x.org/press/1", False)], "target string, method string, url string, declared boolean")
    assert [r.method for r in discover.usable(refs, targets).collect()] == ["sitemap"]
    assert discover.choose(spark.createDataFrame([("t", "listing", None), ("t", "sitemap", False)], "target string, method string, scoped boolean")).first().method == "listing"
    seen = spark.createDataFrame([("t", i, i in (1, 2, 3), i not in (1, 2, 3)) for i in range(8)], "target string, pos int, seen boolean, stored boolean")
    assert [r.pos for r in discover.streak_cut(seen, 9, 3).orderBy("pos").collect()] == [0, 1, 2, 3]


def test_pacing(spark):
    rows = [("d", str(i), float(i), s, None, None, 1.0, False) for i, s in enumerate([200, 503, 403, 200, 200])]
    out = politeness.paced(spark.createDataFrame(rows, "domain string, event string, at_s double, status int, wall string, retry_after_s double, elapsed_s double, from_cache boolean")).orderBy("event").collect()
    assert [r.delay_s for r in out] == [5.0, 10.0, 20.0, 19.0, 18.0] and [r.failures for r in out] == [0, 1, 2, 0, 0]


def test_frontier_and_lists(spark):
    state = spark.createDataFrame([("a", 1, True, datetime(2026, 8, 1), datetime(1970, 1, 1), 0, 86400), ("b", 2, True, datetime(2027, 1, 1), datetime(1970, 1, 1), 0, 86400), ("c", 3, True, datetime(2026, 8, 2), datetime(2026, 9, 1), 0, 86400)], "domain string, shard int, enabled boolean, next_allowed_at timestamp, leased_until timestamp, consec_failures int, revisit_period_s int")
    assert [r.domain for r in frontier.due(state, NOW, 5).collect()] == ["a"] and {r.domain for r in frontier.due(state, NOW, 5, scheduled=False).collect()} == {"a", "b"}
    removed = spark.createDataFrame([(1,)], "a_id int")
    asked = spark.createDataFrame([(1, "https://x.org/n"), (2, "https://y.org/n"), (3, "nope")], "a_id int, newsroom_url string")
    assert {r.a_id: r.outcome for r in lists.reconcile_requests(asked, removed).collect()} == {1: "refused", 2: "seed", 3: "invalid"}


def test_archive_purge_and_storage(spark, tmp_path):
    lines = spark.createDataFrame([('{"a_id": 1}',), ('{"a_id": 2}',), ("no json",)], "value string")
    assert articles.purge_archive(lines, 1).count() == 2
    path = str(tmp_path / "table")
    for n in (3, 2):
        storage.publish(spark.range(n), path)
    assert storage.published(spark, path, "id long, more string").columns == ["id", "more"] and storage.published(spark, path, "id long").count() == 2
    log = f"{path}-log"
    for n in (2, 4):
        storage.append_new(spark.range(n), log, "id")
    assert spark.read.parquet(log).count() == 4


def test_sites(spark):
    lines = spark.createDataFrame([(0, "# c"), (1, "www.a.org/news"), (2, "9,https://a.org/x"), (3, "x,https://b.co.uk/n"), (4, "")], "line_no int, value string")
    assert {r.domain: r.url for r in tables.sites(lines).collect()} == {"a.org": "https://www.a.org/news", "b.co.uk": "https://b.co.uk/n"}


def test_crawl_pass(spark):
    body = "The harbour bridge opens to traffic on Monday after long works in the town. " * 8
    html = f"<h1>Harbour bridge opens to traffic</h1><article><p>{body}</p></article><time datetime='2026-08-20'></time>"
    targets = spark.createDataFrame([("t", "https://x.org/news")], "target string, newsroom_url string")
    refs = spark.createDataFrame([("t", i, u, "listing") for i, u in enumerate(["https://x.org/news/harbour-bridge-opens", "https://x.org/news", "https://y.org/news/a-b-c", "https://x.org/news/seen-it-already"])], "target string, pos int, url string, source string")
    captures = spark.createDataFrame([(1, "https://x.org/news/harbour-bridge-opens", html)], "page_id long, url string, html string")
    stored = spark.createDataFrame([("https://x.org/news/seen-it-already",)], "url string").withColumn("url_hash", urls.url_hash(F.col("url")))
    out = crawl.run(refs, targets, captures, stored, NOW)
    assert [r.url for r in out["articles"].collect()] == ["https://x.org/news/harbour-bridge-opens"] and out["faults"].count() == 0


def test_streaming_windows(spark, tmp_path):
    src = str(tmp_path / "in")
    spark.createDataFrame([(datetime(2026, 8, 1, 0, 10), "dns", 1), (datetime(2026, 8, 1, 0, 50), "dns", 2), (datetime(2026, 8, 1, 3), "tls", 1)], "at timestamp, kind string, n int").write.parquet(src)
    got = []
    q = stream.write_batches(stream.windowed(spark.readStream.schema("at timestamp, kind string, n int").parquet(src)), lambda b: got.extend(b.collect()), str(tmp_path / "cp"))
    q.awaitTermination(60)
    assert [(r.kind, r.n, r.severity) for r in got] == [("dns", 3, 3)]


def test_validation_and_waves(spark):
    stored = spark.createDataFrame([("t", "https://x.org/n/a-b-c", "h", NOW, 900), ("t", "https://x.org/n/d-e-f", "i", None, 900)], "target string, url string, headline string, published_at timestamp, body_len int")
    listing = spark.createDataFrame([("t", "http://www.x.org/n/a-b-c/"), ("t", "https://x.org/other/d-e-f")], "target string, url string")
    r = validation.score(stored, listing).first()
    assert (r.overlap, r.codes, r.verdict) == (1.0, ["undated"], "drift")
    assert validation.common_prefix(stored).first().prefix == "https://x.org/n/"
    assert audit.waves(spark.createDataFrame([("a", "u1"), ("a", "u2"), ("b", "u3")], "domain string, newsroom_url string")).where("wave = 1").count() == 2


def test_entry_and_contract(spark):
    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_best_window_and_html(spark):
    from presslake.functions import windows

    prose = "This is a long line of prose that goes on and on until it ends here. " * 3
    release = "\n".join([prose] * 10 + [f"Signatory {i}" for i in range(140)])
    got = values(spark, [(release,), ("Home\nNews",), (None,)], "body string", got=windows.best_prose_ratio(F.col("body")), nav=windows.looks_like_navigation(F.col("body")), plain=text.prose_ratio(F.col("body")))
    assert got[0].got > 0.8 > got[0].plain and [r.nav for r in got] == [False, True, True]
    assert windows.ratio(prose) == spark.createDataFrame([(prose,)], "b string").select(text.prose_ratio(F.col("b"))).first()[0]
    grid = spark.createDataFrame([(1, "d</script>", "u", "ok", "healthy", "r", 3)], "a_id int, domain string, newsroom_url string, severity string, health string, reason string, articles int")
    assert "d<\\/script>" in status.html(grid)
