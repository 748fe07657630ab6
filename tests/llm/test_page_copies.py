"""Copies of an article in plain markup."""

from presslake.llm import page_text


def test_copies_in_plain_markup_keep_their_text(spark):
    page = "<div>Frame</div><div>{} text</div><div>Foot</div>"
    rows = [(i, f"http://h/a{i}", page.format("one")) for i in range(5)] + [(9, "http://h/b", page.format("two"))] + [(i, f"http://k/{i}", page.format("lone")) for i in (20, 21)]
    got = {r.page_id: r.text for r in page_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {**{i: "one text" for i in range(5)}, 9: "two text", 20: "Frame\nlone text\nFoot", 21: "Frame\nlone text\nFoot"}
