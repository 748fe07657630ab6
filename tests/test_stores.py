"""Settings, publishing, runs, lists, feeds' sitemaps and the readers of stores, case by case."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from presslake import settings, storage
from presslake.operators import articles, audit, discover, faults, frontier, lists, status, survey
from presslake.operators.columns import relative_age, upper_median
from presslake.sources import feeds, tables

NOW = datetime(2026, 8, 29, 12)


def test_settings_read_and_refuse(tmp_path):
    (tmp_path / ".env").write_text("﻿# comment\nexport PRESSLAKE_KEEP_RUNS='7'\nPRESSLAKE_STATUS=on\nOTHER=1\n\nbroken\n")
    got = settings.load({"PRESSLAKE_HOST_DELAY_S": "2.5", "PRESSLAKE_FAULTS": "off", "PRESSLAKE_SINK": "tns"}, str(tmp_path / ".env"))
    assert (got.keep_runs, got.status, got.host_delay_s, got.faults, got.wire_sink, got.lease_s) == (7, True, 2.5, False, True, 600)
    with pytest.raises(ValueError, match="PRESSLAKE_PER_HOST"):
        settings.load({"PRESSLAKE_PER_HOST": "many"}, None)
    assert settings.Settings(contact="a@b.org").headers() == {"User-Agent": "presslake (+a@b.org)", "From": "a@b.org"}


def test_doctor(spark):
    report = settings.doctor(spark, settings.Settings(data_dir="/nowhere/at/all"))
    assert report["data_dir"] == "missing" and report["pyspark"] and report["java"] and report["checkpoints"]


def test_publish_switches_versions(spark, tmp_path):
    path = f"{tmp_path}/table"
    assert storage.published(spark, path, "a int, b string").count() == 0
    for n in range(4):
        storage.publish(spark.createDataFrame([(n,)], "a int"), path)
        assert [tuple(r) for r in storage.published(spark, path, "a int, b string").collect()] == [(n, None)]
    assert len([p for p in (tmp_path / "table").iterdir() if p.name.startswith("v")]) == 2
    assert storage.safe_identifier("ab_1") == "ab_1"
    with pytest.raises(ValueError):
        storage.safe_identifier("a;b")


def test_exact_upper_medians(spark):
    rows = [(g, float(v)) for g in range(1, 8) for v in range(g)] + [(9, None)]
    got = {r.g: r.m for r in spark.createDataFrame(rows, "g int, v double").groupBy("g").agg(upper_median("v").alias("m")).collect()}
    assert got == {g: float(g // 2) for g in range(1, 8)} | {9: None}


def test_relative_ages(spark):
    cases = {"2026-08-29 11:58:30": "1m ago", "2026-08-29 13:00:00": "in 1h", "2026-08-27 11:00:00": "2d ago", None: "-", "2026-08-29 12:00:00": "0m ago"}
    rows = spark.createDataFrame([(k, v) for k, v in cases.items()], "at string, want string").withColumn("got", relative_age(F.to_timestamp("at"), F.lit(NOW)))
    assert all(r.got == r.want for r in rows.collect())


def test_tallies_list_the_first_domains_and_count_all(spark):
    f = spark.createDataFrame([("r", "timeout", f"d{i:02d}", i, 1) for i in range(9)], "run_id string, kind string, domain string, a_id int, n int").withColumns({"first_at": F.lit(NOW), "last_at": F.lit(NOW), "sample_url": F.lit("u"), "sample_detail": F.lit("x")})
    got = faults.tally(f, listed=3).first()
    assert got.domains == ["d00", "d01", "d02"] and got.breadth == 9 and faults.tally_domains(f).count() == 9
    assert faults.of_kind(faults.published(f, "r"), "timeout").first().position == 1


def test_picks_keep_whole_rows(spark):
    rows = [("h", 2, "u2", "b"), ("h", 1, "u1", "a"), ("k", 1, "u3", "c")]
    new = spark.createDataFrame([(h, datetime(2026, 1, d), u, "hl", u, b) for h, d, u, b in rows], "url_hash string, first_seen_at timestamp, url string, headline string, content_hash string, body string")
    assert sorted((r.url, r.body) for r in articles.new_articles(new, new.where("url_hash = 'x'")).collect()) == [("u1", "a"), ("u3", "c")]
    log = spark.createDataFrame([("u", "f1", 9, "old"), ("u", "f2", 1, "new")], "url string, file string, pos int, body string")
    assert articles.latest(log).first().body == "new" and articles.search(log.withColumn("domain", F.lit("News.org")), "news", 1).first().file == "f2"


def test_one_failing_store_spares_no_other(spark):
    done = []

    def fails(_):
        raise RuntimeError("down")

    removed = spark.createDataFrame([(1,)], "a_id int")
    assert lists.reconcile(removed, {"a": fails, "b": lambda r: done.append(r.count())}) == [("a", "RuntimeError: down"), ("b", None)] and done == [1]
    assert lists.without_removed(spark.createDataFrame([(1,), (2,), (None,)], "a_id int"), removed).count() == 2


def test_resets_need_a_scope_or_a_word(spark):
    state = spark.createDataFrame([("a", datetime(2027, 1, 1)), ("b", datetime(2027, 1, 1))], "domain string, next_allowed_at timestamp_ntz")
    targets = spark.createDataFrame([("a", "rss", True)], "domain string, discovery_method string, feed_absent boolean")
    stored = spark.createDataFrame([("a",), ("b",)], "domain string")
    with pytest.raises(ValueError):
        frontier.reset(state, targets, stored, NOW)
    s, t, left = frontier.reset(state, targets, stored, NOW, ["a"], relearn=True, delete=True)
    assert {r.domain: r.next_allowed_at for r in s.collect()} == {"a": NOW, "b": datetime(2027, 1, 1)}
    assert (t.first().discovery_method, t.first().feed_absent) == (None, False) and [r.domain for r in left.collect()] == ["b"]


def test_sitemaps_are_read_two_levels_deep(spark):
    starts = spark.createDataFrame([("t", None, f"r{i}", i) for i in range(7)], "target string, section string, root string, pos int")
    parsed = [(f"r{i}", "child", f"c{i}{k}-{'news' if k == 3 else 'x'}", k) for i in range(7) for k in range(5)] + [(f"c{i}{k}-{'news' if k == 3 else 'x'}", "ref", f"u{i}{k}", 0) for i in range(7) for k in range(5)]
    parsed += [("c03-news", "child", "deep", 0), ("deep", "ref", "never", 0)]
    got = {r.url for r in feeds.walk(starts, spark.createDataFrame(parsed, "map string, kind string, url string, pos int")).collect()}
    assert got == {"u03", "u00", "u01", "u13", "u10"}  # the best three of the first root, then of the second: five maps
    listed = spark.createDataFrame([("t", i, f"s{i}") for i in range(9)], "target string, pos int, url string")
    bases = spark.createDataFrame([("t", None, "https://x.org"), ("u", None, "https://y.org")], "target string, section string, base string")
    roots = [(r.target, r.root) for r in feeds.roots(bases, listed).orderBy("target", "pos").collect()]
    assert [r for t, r in roots if t == "t"] == [f"s{i}" for i in range(5)] and ("u", "https://y.org/sitemap.xml") in roots and len(roots) == 10


def test_cached_listings_and_redirects(spark):
    targets = spark.createDataFrame([("t", "https://old.org/news", "listing", None, "/news"), ("u", "https://u.org/news", "rss", "https://u.org/feed", "/news")], "target string, newsroom_url string, discovery_method string, feed_url string, section string")
    same = spark.createDataFrame([("https://old.org/news", True)], "url string, from_cache boolean")
    assert [r.target for r in discover.not_modified(targets, same).collect()] == ["t"]
    moved = discover.adopted(targets.select("target", "newsroom_url"), spark.createDataFrame([("https://old.org/news", "https://www.new.gov/press/")], "url string, final_url string"))
    got = {r.target: r for r in moved.collect()}
    assert (got["t"].own_domain, got["t"].section, got["t"].base_url) == ("new.gov", "/press", "https://www.new.gov/press/") and got["u"].seed == "https://u.org/news"


def test_survey_reasons(spark):
    cases = [(250, False, 5000, False, 9, None), (10, True, 5000, False, 9, None), (10, False, 0, False, 0, "empty response"), (10, False, 5000, True, 9, "noscript js-required notice"), (10, False, 900, False, 9, "html under 1KB"), (10, False, 5000, False, 3, "low text (10 chars) with 3 scripts"), (10, False, 5000, False, 2, "low text yield (10 chars)")]
    rows = spark.createDataFrame(cases, "t int, s boolean, h int, n boolean, k int, want string").withColumn("got", survey.needs_browser(*map(F.col, "tshnk")))
    assert all(r.got.reason == r.want and r.got.needed == (r.want is not None) for r in rows.collect())


def test_grid_readers(spark):
    grid = spark.createDataFrame([(1, "a.org", "u1", "healthy", "ok", 2, 1, 5, "why", True), (12, "b.org", "u2", "failing", "error", 1, 1, 9, "because of 1", False)], "a_id int, domain string, newsroom_url string, health string, severity string, targets int, targets_cached int, articles int, reason string, enabled boolean")
    assert [r.a_id for r in status.grid_view(grid, text="1").collect()] == [12, 1] and [r.a_id for r in status.grid_view(grid, unsolved=True).collect()] == [1] and status.agency(grid, 12).first().domain == "b.org"
    lines = [r.json for r in status.grid_payload(grid, NOW).collect()]
    assert len(lines) == 3 and '"total":2' in lines[0] and '"generated_at":"2026-08-29 12:00:00"' in lines[0] and '"agencies"' in lines[1]


def test_legacy_lists(spark):
    rows = spark.createDataFrame([("1", "https://a.org/n", 3), ("2", "https://a.org/n", 3), ("x", "https://b.org", 3), ("3", "nothing", 3)], "a_id string, newsroom_url string, fields int")
    assert sorted((r.a_id, r.domain) for r in tables.clean_targets(rows).where("a_id IS NOT NULL").collect()) == [(1, "a.org")] and tables.clean_targets(rows, sample=1).count() == 1
    assert [(r.newsroom_url, r.n) for r in tables.top_counts(rows, "newsroom_url", 1).collect()] == [("https://a.org/n", 2)]
    audited = spark.createDataFrame([(1, "u1", False), (2, "u2", True)], "a_id int, newsroom_url string, reachable boolean")
    assert [r.a_id for r in audit.unreachable(audited, audited.drop("reachable")).collect()] == [1]
