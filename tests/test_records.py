"""Loads in which records share their URL and day."""

from collections import Counter
from datetime import date

from presslake.operators import records
from presslake.plans import queries


def test_each_record_of_one_url_and_day_gets_an_outcome(spark):
    heads = ["Mayor opens the new bridge", "Council closes the new bridge", "Mayor opens the new bridge", "Rain over the new bridge"]
    rows = [(1, "u", date(2026, 8, 1), "pre", h, h) for h in heads] + [(2, None, None, "pre", heads[0], heads[0])] * 2
    table = spark.createDataFrame(rows, "a_id int, url string, published date, prefix string, headline string, headline_full string")
    out = records.resolve(table, table.selectExpr("'' AS filename", "a_id", "headline").limit(0)).collect()
    assert len(out) == 6 and len({r.filename for r in out if r.outcome == "inserted"}) == 4
    assert Counter((r.headline, r.a_id, r.outcome) for r in out) == Counter([(h, 1, "inserted") for h in {*heads}] + [(heads[0], 1, "duplicate"), (heads[0], 2, "inserted"), (heads[0], 2, "duplicate")])


def test_wire_loads_settles_every_accepted_record(spark):
    sf = "/root/testdata/sf0.1"
    accepted = queries.QUERIES["wire_records"](spark, sf).where("reject_reason IS NULL").count()
    out = queries.QUERIES["wire_loads"](spark, sf)
    assert out.count() == accepted and out.where("outcome = 'inserted'").select("filename").distinct().count() == out.where("outcome = 'inserted'").count()
