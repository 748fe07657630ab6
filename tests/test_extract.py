"""Headline, body, date and browser cascades, and structured data, case by case."""

import json
from datetime import datetime

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from presslake.functions import languages
from presslake.operators import extract
from presslake.sources import pages

NOW = datetime(2026, 8, 29, 12)
PROSE = "The council opened a new bridge over the river on Monday, and the mayor said that it would help people get to work. " * 6


def ask(spark, rows, **columns):
    return spark.createDataFrame(rows).withColumns(columns).collect()


TITLES = [
    ("Mayor wins - a story of hope", None, "Mayor wins - a story of hope", "a story of hope"),
    ("City opens park|Newsroom", None, "City opens park", "City opens park"),
    ("Council > News", None, "Council", "Council"),
    ("Press Releases | American Lung Association", "American Lung Association", None, "Press Releases | American Lung Association"),
    ("Center for Food Safety | Press Releases |  | Lawsuit Filed to Stop the Plan", None, "Lawsuit Filed to Stop the Plan", "Lawsuit Filed to Stop the Plan"),
    ("Plain headline of an article", "Site", "Plain headline of an article", "Plain headline of an article"),
    ("News | Media Centre", None, None, "News | Media Centre"),
    ("One part : with a colon", None, "One part : with a colon", "One part : with a colon"),
]


def test_title_furniture(spark):
    rows = [{"t": t, "s": s, "n": i} for i, (t, s, _, _) in enumerate(TITLES)]
    got = ask(spark, spark.createDataFrame(rows, "t string, s string, n int").collect(), stripped=extract.strip_title_chrome(F.col("t"), F.col("s")), headline=extract.headline_from_title(F.col("t"), F.col("s")))
    for r in got:
        assert (r.stripped, r.headline) == TITLES[r.n][2:], r.t


def test_site_names(spark):
    cases = {"Headline | Site | Site": "Site", "Headline | Site": None, "A - B - B": "B", "Site | Site": None, "x": None}
    for r in ask(spark, [(t,) for t in cases], got=extract.site_name(F.col("_1"))):
        assert r.got == cases[r._1]


LD = [
    ([{"@type": "WebPage", "name": "Weak", "datePublished": "2026-01-01"}], (False, True, "Weak", "2026-01-01")),
    ([{"@type": "NewsArticle", "headline": "Strong"}, {"@type": "WebPage", "name": "Weak", "datePublished": "2026-01-02"}], (True, True, "Strong", "2026-01-02")),
    ([{"@graph": [{"@type": ["Thing", "BlogPosting"], "alternativeHeadline": "Alt", "datePosted": "2026-02-02"}]}], (True, False, "Alt", "2026-02-02")),
    ([{"@type": "SocialMediaPosting", "headline": ["", " Listed "]}], (True, False, "Listed", None)),
    ([{"@type": "ScholarlyArticle", "headline": "Not news"}], (False, False, None, None)),
    (["{broken"], (False, False, None, None)),
    ([{"@type": "Article", "headline": {"@value": "object"}}], (True, False, None, None)),
]


@pytest.mark.parametrize("blocks, want", LD)
def test_structured_data(blocks, want):
    page = "".join(f'<script type="application/ld+json">{b if isinstance(b, str) else json.dumps(b)}</script>' for b in blocks)
    got = pages.facts(page)["jsonld"]
    assert (got["is_article"], got["weak_only"], got["headline"], got["date_raw"]) == want


@pytest.mark.parametrize(
    "html, want",
    [
        ("<time>2026-01-01</time><time datetime='2026-01-02'>x</time>", None),
        ("<time class='x published'>May 3, 2026</time>", "May 3, 2026"),
        ("<time pubdate datetime='2026-05-04'>today</time><time class=published>no</time>", "2026-05-04"),
        ("<span itemprop=datePublished> 5 <b>May</b> 2026</span>", "5May2026"),
        ("<time pubdate datetime=2026-05-06></time><meta itemprop=datePublished content=2026-05-07>", "2026-05-07"),
        ("<time itemprop=datePublished></time><time class=entry-date>2026-05-08</time>", "2026-05-08"),
    ],
)
def test_dates_that_name_themselves(html, want):
    assert pages.facts(html)["time_raw"] == want


def test_meta_and_searched_dates():
    got = pages.facts("<meta property='og:title' content=' '><meta property='OG:Title ' content=' Second '><meta name=x content=''>")
    assert dict(got["meta"]) == {"og:title": "Second"}
    assert pages.facts("<p>Founded May 1, 1999.</p><p>Published: Aug. 3, 2026</p>")["searched_date"] == "Aug 3, 2026"
    assert pages.facts("<p>On 4 August 2026 it rained</p>")["searched_date"] == "4 August 2026" and pages.facts("<p>no date</p>")["searched_date"] is None


@pytest.mark.parametrize(
    "body, structured, chars, notice, hydration, want",
    [(200, False, 5000, True, True, None), (199, True, 5000, True, True, None), (10, False, 0, False, False, "empty response"), (10, False, 500, True, False, "noscript js-required notice"), (10, False, 999, False, True, "html under 1KB"),
     (10, False, 1000, False, True, "hydration payload present - mine it before launching a browser"), (10, False, 1000, False, False, "low text yield (10 chars)"), (None, False, 1000, False, False, "low text yield (0 chars)")],
)
def test_browser_need(spark, body, structured, chars, notice, hydration, want):
    got = spark.range(1).select(extract.needs_browser(F.lit(None if body is None else "x" * body).cast("string"), F.lit(structured), F.lit(chars), F.lit(notice), F.lit(hydration)).alias("b")).first().b
    assert (got.needed, got.reason) == (want is not None, want)


def record(spark, html, **feed):
    facts = pages.parse(spark.createDataFrame([(1, "https://x.org/news/a-b-c", html)], "page_id long, url string, html string"))
    for name, value in feed.items():
        facts = facts.withColumn(name, F.lit(value))
    return extract.records(facts, NOW).first()


def test_bodies_and_provenance(spark):
    page = f"<title>Bridge opens over the river | News</title><article><p>{PROSE}</p></article>"
    got = record(spark, page)
    assert (got.headline, got.headline_source, got.body_source, got.language) == ("Bridge opens over the river", "trafilatura", "trafilatura", "en")
    assert got.warnings == ["no date"] and got.unusable == "extract_no_date"
    longer = PROSE + "And the feed has one sentence more than the page, which makes it the longer one."
    ld = f'<script type="application/ld+json">{json.dumps({"@type": "Article", "articleBody": PROSE + "x"})}</script>'
    got = record(spark, page + ld, feed_body=longer, feed_headline="Newsroom | Feed says the bridge opens", feed_date="2026-08-20")
    assert (got.body_source, got.headline, got.headline_source, got.date.source) == ("feed", "Feed says the bridge opens", "feed", "feed") and got.unusable is None
    assert record(spark, page + ld).body_source == "jsonld"
    assert record(spark, "").warnings == ["empty html"] and record(spark, None).headline_source == "none"


def test_a_headline_that_the_body_never_mentions_gives_way(spark):
    page = f"<meta property='og:title' content='Quarterly zebra xylophone'><h1>The council opened a new bridge</h1><article><p>{PROSE}</p></article><p>Posted on August 20, 2026</p>"
    got = record(spark, page)
    assert got.headline == "The council opened a new bridge" and got.quality.headline_replaced.startswith("opengraph scored 0.0") and got.date.source == "htmldate"


def test_languages(spark):
    texts = {"en": PROSE, "de": "Der Rat hat die neue Brücke eröffnet und der Bürgermeister sagte, dass es den Menschen auf dem Weg zu der Arbeit hilft.", "fr": "Le conseil a ouvert un pont sur la rivière et le maire dit que cela aide les gens dans la ville avec des bus.", "es": "El consejo abrió un puente en la ciudad y el alcalde dijo que es bueno para los vecinos de las zonas del sur."}
    for r in ask(spark, [(k, t) for k, t in texts.items()] + [("", "short"), ("", "zzz qqq " * 20), ("", None)], got=languages.detect(F.col("_2"))):
        assert (r.got or "") == r._1


def test_heading_cut_off_within_a_reference():
    assert pages.facts("<h1>a &amp;&amp; b&amp</h1>")["h1"] == "a && b&amp"
    assert pages.facts("<h1 class=x>R&D &copy2026 &#39;x&#x27; &lt;</h1>")["h1"] == "R&D &copy2026 'x' <"
    got = pages.facts('<script type="application/ld+json">{"@type": "Article", "headline": "<h1>A & B</h1>"}</script><!-- <h1> --><h1>C & D</h1><p>x &amp y</p>')
    assert got["jsonld"]["headline"] == "<h1>A & B</h1>" and got["h1"] == "C & D"
    assert pages.facts("<h1>open & shut")["h1"] is None


def test_long_pages_come_in_small_batches(spark):
    rows = spark.range(12).select(F.col("id").alias("page_id"), F.lit("u").alias("url"), F.repeat(F.lit("<p>x</p>"), 250_000).alias("html")).coalesce(1)
    pages.parse(rows)

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_pydict({"n": [b.num_rows]})

    assert max(r.n for r in rows.mapInArrow(sizes, "n long").collect()) <= 9
