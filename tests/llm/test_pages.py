"""Page differencing: pairing against brute force, broken markup, and what the alignment decides on real pages."""

import re
import time

import pytest

from presslake.llm import page_text

REAL = "/root/testdata/sf0.001/pages.parquet"


def brute(rows):
    """Text of each (page_id, url, html) by walking the sorted pages of each host."""
    ordered = sorted(((page_text.split_url(u), u or "", i), page_text.lines(h)) for i, u, h in rows)
    runs = []
    for ((host, _), _, i), own in ordered:
        if runs and runs[-1][0] == host and runs[-1][1] == own:
            runs[-1][2].append(i)
        else:
            runs.append((host, own, [i]))
    out = {}
    for n, (host, own, ids) in enumerate(runs):
        others = [runs[m][1] for m in (n - 1, n + 1) if 0 <= m < len(runs) and runs[m][0] == host]
        out |= dict.fromkeys(ids, page_text.main_text(own, *others))
    return out


def plain(page):
    """A real page without the markup that names its parts."""
    return re.sub(r"<(/?)(?:article|nav|footer)>", r"<\1div>", page).replace(' class="ad"', "")


@pytest.mark.parametrize("stretches", [1, 5, 60])
def test_pairing_equals_brute_force_for_any_number_of_stretches(spark, stretches):
    real = [(r.page_id, r.url, plain(r.html)) for r in spark.read.parquet(REAL).collect()]
    rows = real + [(1000 + i, "http://one.org/x", "<p>Same frame</p><p>same story</p>") for i in range(40)]  # a run that fills stretches of its own
    rows += [(2000 + i, None, f"<p>Top</p><p>own text {i // 2}</p>") for i in range(9)] + [(3000, "http://alone.org/", "<p>a</p>"), (3001, "http://x.org/", None)]
    table = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, lines string")
    assert {r.page_id: r.text for r in page_text.extract(table, stretches).collect()} == brute(rows)


def test_alignment_decides_on_real_pages_in_plain_markup(spark):
    rows = [(r.page_id, f"http://h.org/{r.page_id}", plain(r.html)) for r in spark.read.parquet(REAL).collect()]
    without = {i: page_text.main_text(page_text.lines(h)) for i, _, h in rows}
    assert sum(without[i] != t for i, t in brute(rows).items()) > 0


def test_what_is_left_of_pages():
    text = lambda page, *others: page_text.main_text(page_text.lines(page), *map(page_text.lines, others))
    assert text("<article><p>teaser only</p></article><div><p>Long main story of this page</p></div>") == "teaser only\nLong main story of this page"
    assert text("<p>Intro</p><svg/><p>Body text one</p><p>two</p><svg><text>x</text></svg><p>End</p>") == "Intro\nBody text one\ntwo\nEnd"
    assert text("<p>Look <svg><g>no</g></svg>here<button>no</button></p>") == "Look here"
    assert text("<article><p>T</p><section class='related-work'><p>Earlier studies</p></section><div class='relatedPosts'>x</div><aside>y</aside></article>") == "T\nEarlier studies"
    page = "<article><header><h1>{0}</h1><p>By the desk</p></header><p>Story {0} runs on and on</p><div class=share-price>Up</div></article>"
    assert text(page.format("one"), page.format("two")) == "one\nStory one runs on and on"
    # copies in plain markup: nothing is lost, and what a third page shares too goes
    one, near, other = (f"<p>Frame</p><p>{x}</p>" for x in ("a story told in many words", "a story told in many words</p><p>!", "another thing"))
    assert text(one, one) == text(one, near) == "Frame\na story told in many words"
    assert text(one, near, other) == "a story told in many words"
    assert text("<form><article><p>in a form of the whole page</p></article></form><p>x</p>") == "in a form of the whole page"


@pytest.mark.parametrize("unit", ["<a b='c ", "<a b='c >", '<a b="x>" ', "<div></p>", "<textarea>x", "<a \"'=x", "<svg></div>", "<!--", "<"])
def test_broken_pages_take_linear_time(unit):
    began = time.perf_counter()
    page_text.lines(unit * (1_000_000 // len(unit)))
    assert time.perf_counter() - began < 4  # about one second on a free core


def test_long_pages_of_equal_lines():
    a, b = ["a", "b", "c"] * 4000, ["b", "a", "d"] * 4000
    assert len(page_text.shared(a, b)) == 7999
