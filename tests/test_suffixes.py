"""Registrable domains by patterns and by a published list."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from presslake.functions import suffixes, urls

CASES = {
    "https://www.city.toronto.on.ca/x": "toronto.on.ca", "a.qc.ca": "a.qc.ca", "https://www.foo.k12.ca.us": "foo.k12.ca.us", "www.ci.boston.ma.us": "boston.ma.us", "https://news.bbc.co.uk": "bbc.co.uk",
    "www.health.vic.gov.au": "health.vic.gov.au", "www.health.nsw.gov.au": "nsw.gov.au", "www.gov.uk": "www.gov.uk", "example.com": "example.com", "a.b.example.com.br": "example.com.br", "x.gouv.fr": "x.gouv.fr", "10.0.0.1": "10.0.0.1", "on.ca": "on.ca", "localhost": "localhost",
}
LIST = "// a comment\ncom\nuk\nco.uk\ngov.uk\n\nca\non.ca\n*.ck\n!www.ck\n// ===BEGIN PRIVATE DOMAINS===\nblogspot.com\n"


def test_patterns(spark):
    rows = spark.createDataFrame(list(CASES.items()), "url string, want string")
    for r in rows.withColumn("got", urls.registrable_domain(F.col("url"))).collect():
        assert r.got == r.want, r.url


def test_a_published_list(spark):
    rules, public = suffixes.parse(LIST), suffixes.parse(LIST, private=False)
    cases = {"a.b.co.uk": "b.co.uk", "x.y.z.ck": "y.z.ck", "a.www.ck": "www.ck", "me.blogspot.com": "me.blogspot.com", "www.city.on.ca": "city.on.ca", "gov.uk": "gov.uk", "a.unknown": "a.unknown", "a.b.unknown": "b.unknown"}
    assert {h: rules.registrable(h) for h in cases} == cases
    assert public.registrable("me.blogspot.com") == "blogspot.com" and rules.registrable("::1") == "::1" and rules.registrable(None) is None
    rows = spark.createDataFrame([(f"https://{h}/p", w) for h, w in cases.items()] + [("", ""), (None, None)], "url string, want string")
    for r in rows.withColumn("got", urls.registrable_domain(F.col("url"), rules)).collect():
        assert r.got == r.want, r.url


@pytest.mark.skipif(not Path(suffixes.SYSTEM_FILE).exists(), reason="no list on this system")
def test_patterns_agree_with_the_system_list():
    rules = suffixes.load()
    hosts = [u.removeprefix("https://").split("/")[0] for u in CASES]
    assert len(rules.plain) > 1000
    assert [rules.registrable(h) for h in hosts if h not in ("www.gov.uk", "www.ci.boston.ma.us")] == [CASES[u] for u in CASES if u not in ("www.gov.uk", "www.ci.boston.ma.us")]
