"""URL algebra as Column expressions: parts, canonical form, hash, registrable domain, article test.

Everything runs in the JVM. URLs are split by one generic pattern rather than parse_url, which gives
NULL for pipes, blanks and bare percent signs. Deviation from percent-encoding libraries: a query's names and values
are kept as written instead of being decoded and encoded again, so `%20` and `+` stay apart.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .suffixes import THREE_LABELS, TWO_LABELS, Rules, by_list

# ---- fixed values: patterns and words that decide what a URL is
JUNK_PARAM = r"(?i)^(utm_|ic[ei]d$|mc_|pk_|fbclid$|gclid$|dclid$|msclkid$|yclid$|_ga$|_gl$|ref$|referrer$|source$|cmpid$|CMP$|sr_share$|at_medium$|at_campaign$)"
DATE_IN_PATH = r"/(19|20)\d{2}[/-](0?[1-9]|1[0-2])([/-](0?[1-9]|[12]\d|3[01]))?(/|$|-)"
COMPACT_DATE = r"/(19|20)\d{6}(/|$|-)"
LISTING_PATH = r"(?i)(^|/)(category|categories|tag|tags|topic|topics|author|authors|archive|archives|page|pages|search|feed|rss|amp|print)(/|$)"
SECTION_INDEX = r"(?i)^(news|newsroom|press|press-releases|press-release|pressroom|press-room|media|media-centre|media-center|media-room|blog|blogs|insights|stories|updates|announcements|publications|resources|events|latest|all-news|news-releases|news-release|newsreleases|releases)$"
LISTING_QUERY = r"(?i)^(page|paged|p|offset|start|pagenum)$"
BARE_YEAR = r"^(19|20)\d{2}$"
NON_ARTICLE_SECTION = (
    r"(?i)(^|/)(event|events|calendar|webinar|webinars|conference|people|person|staff|faculty|directory|profile|profiles|bio|bios"
    r"|course|courses|program|programs|programme|degree|degrees|curriculum|job|jobs|career|careers|vacancy|vacancies|employment"
    r"|location|locations|campus|facility|facilities|product|products|service|services|shop|store|cart|checkout"
    r"|login|register|account|donate|give|giving|contact|privacy|terms|video|videos|photo|photos|gallery|galleries|multimedia"
    r"|podcast|podcasts|audio|webcast|webcasts|faq|faqs|sitemap|search-results)(/|$)"
)
NEWS_SEGMENT = r"(?i)(^|/)(news|newsroom|press|press-release[s]?|news-release[s]?|releases|story|stories|article|articles|blog|media|announcement[s]?|bulletin)(/|$)"
SOFT_NON_NEWS = r"(?i)(^|/)(about|about-us|who-we-are|our-story|leadership|governance|foundation|alumni|admissions|academics|research-areas|support-us)(/|$)"
#: Public suffixes of two labels beside the patterns of suffixes.py. Pass others, or the rules of a whole list, as `suffixes`.
SUFFIXES = ("gc.ca", "nic.in")
# ---- end of fixed values

_PARTS = r"^(?:([A-Za-z][A-Za-z0-9+.-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#.*)?$"


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with value evaluated once, however often use mentions it: keeps nested expressions, and what the
    optimiser makes of them when it moves filters, small."""
    return F.element_at(F.transform(F.array(value), use), 1)


def once(rows: DataFrame, **columns: Column) -> DataFrame:
    """rows with these columns, each row's evaluated once: filters and columns that build on them later are not folded into their
    expressions, as the optimiser does with plain ones, because rows with them come out of a generator."""
    return rows.select("*", F.inline(F.array(F.struct(*[c.alias(name) for name, c in columns.items()]))))


def _part(url: Column, group: int) -> Column:
    return F.regexp_extract(F.trim(url), _PARTS, group)


def host(url: Column) -> Column:
    """Lower-cased host without credentials, port and a trailing dot; '' if there is none."""
    authority = F.regexp_replace(_part(url, 2), r"^.*@", "")
    return F.regexp_replace(F.lower(F.regexp_replace(authority, r":\d*$", "")), r"\.+$", "")


def path(url: Column) -> Column:
    return _part(url, 3)


def query(url: Column) -> Column:
    return _part(url, 4)


def registrable_domain(url_or_host: Column, suffixes: tuple[str, ...] | Rules = SUFFIXES) -> Column:
    """The label in front of the longest public suffix, with it; a host that is all suffix, an IP or a single label stays whole.

    suffixes: more suffixes of two labels beside those of the patterns, or the rules of a whole list.
    """
    bare = F.regexp_replace(F.lower(F.trim(url_or_host)), r"\.+$", "")
    h = F.when(F.contains(url_or_host, F.lit("//")), host(url_or_host)).otherwise(bare)
    if isinstance(suffixes, Rules):
        return by_list(h, suffixes)

    def of_labels(labels: Column) -> Column:
        n = F.size(labels)
        tail = lambda k: F.array_join(F.slice(labels, F.greatest(n - k + 1, F.lit(1)), F.lit(k)), ".")
        whole = F.array_join(labels, ".")
        ip = whole.rlike(r"^[\d.]+$") | F.contains(whole, F.lit(":"))
        long = (n > 3) & tail(3).rlike(THREE_LABELS)
        return F.when(ip | (n <= 2), whole).when(long, tail(4)).when(tail(3).rlike(THREE_LABELS), whole).when(_is_suffix(tail(2), suffixes), tail(3)).otherwise(tail(2))

    return let(F.split(h, r"\."), of_labels)


def _is_suffix(two: Column, suffixes: tuple[str, ...]) -> Column:
    return two.rlike(TWO_LABELS) | two.isin(*suffixes) if suffixes else two.rlike(TWO_LABELS)


def strip_www(h: Column, suffixes: tuple[str, ...] = SUFFIXES) -> Column:
    """Without www., where that leaves the registrable domain as it is (so www.gov.uk stays)."""
    bare = F.substr(h, F.lit(5))
    return F.when(h.startswith("www.") & ~_is_suffix(bare, suffixes) & ~bare.rlike(THREE_LABELS) & F.contains(bare, F.lit(".")), bare).otherwise(h)


def canonical(url: Column) -> Column:
    """The form that equal pages share: see the module's note on the query. '' if the URL has no host."""
    parts = F.struct(host(url).alias("host"), F.lower(_part(url, 1)).alias("scheme"), F.regexp_extract(_part(url, 2), r":(\d+)$", 1).alias("port"), F.regexp_replace(path(url), r"/{2,}", "/").alias("path"), query(url).alias("query"))
    return let(parts, _canonical)


def _canonical(part: Column) -> Column:
    scheme = F.when(part["scheme"] == "", F.lit("https")).otherwise(part["scheme"])
    port = part["port"]
    default = ((scheme == "https") & (port == "443")) | ((scheme == "http") & (port == "80")) | (port == "") | (port == "0")
    clean = F.when(F.length(part["path"]) > 1, F.regexp_replace(part["path"], r"/+$", "")).otherwise(part["path"])
    clean = F.when(F.length(clean) == 0, F.lit("/")).otherwise(clean)
    named = lambda pair: F.regexp_extract(pair, r"^([^=]*)", 1)
    pairs = F.filter(F.split(part["query"], "&"), lambda pair: (pair != "") & ~named(pair).rlike(JUNK_PARAM))
    pairs = F.transform(pairs, lambda pair: F.when(F.contains(pair, F.lit("=")), pair).otherwise(F.concat(pair, F.lit("="))))
    kept = F.array_join(F.array_sort(pairs), "&")
    tail = F.when(F.size(pairs) == 0, F.lit("")).otherwise(F.concat(F.lit("?"), kept))
    with_port = F.when(default, F.lit("")).otherwise(F.concat(F.lit(":"), port))
    return F.when(part["host"] == "", F.lit("")).otherwise(F.concat(scheme, F.lit("://"), strip_www(part["host"]), with_port, clean, tail))


def url_hash(url: Column) -> Column:
    """sha256 of the canonical form, in hex."""
    return F.sha2(canonical(url), 256)


def origin(url: Column) -> Column:
    return F.concat(_part(url, 1), F.lit("://"), _part(url, 2))


def segments(p: Column) -> Column:
    return F.filter(F.split(p, "/"), lambda s: s != "")


def is_non_news(url: Column) -> Column:
    """Hard sections always; soft ones unless a news segment stands in the path too."""
    return let(path(canonical(url)), lambda p: p.rlike(NON_ARTICLE_SECTION) | (p.rlike(SOFT_NON_NEWS) & ~p.rlike(NEWS_SEGMENT)))


def classify(url: Column) -> Column:
    """STRUCT<score DOUBLE, is_article BOOLEAN, reasons ARRAY<STRING>> from the URL's shape alone."""
    return let(let(canonical(url), lambda u: F.struct(path(u).alias("p"), query(u).alias("q"))), lambda s: _shape(s["p"], s["q"]))


def _shape(p: Column, q: Column) -> Column:
    """In steps, each evaluated once: what the path holds, which rules hold, the score."""
    parts = F.struct(p.alias("p"), q.alias("q"), F.concat(F.array(F.lit("")), segments(p)).alias("parts"))
    return let(let(let(let(parts, _slugged), _held), _scored), lambda s: F.struct(s["score"].alias("score"), ((s["score"] > 0) & s["signal"]).alias("is_article"), s["reasons"].alias("reasons")))


def _slugged(s: Column) -> Column:
    last = F.element_at(s["parts"], -1)
    return F.struct(s["p"].alias("p"), s["q"].alias("q"), (F.size(s["parts"]) - 1).alias("n"), last.alias("last"), F.regexp_replace(last, r"(?i)\.(html?|php|aspx?)$", "").alias("slug"))


def _held(s: Column) -> Column:
    p, slug, some = s["p"], s["slug"], s["n"] > 0
    names = F.transform(F.filter(F.split(s["q"], "&"), lambda x: x.rlike("=.")), lambda x: F.regexp_extract(x, "^([^=]*)", 1))
    holds = {
        "listing": p.rlike(LISTING_PATH), "hard": p.rlike(NON_ARTICLE_SECTION), "soft": p.rlike(SOFT_NON_NEWS) & ~p.rlike(NEWS_SEGMENT), "paged": F.exists(names, lambda x: x.rlike(LISTING_QUERY)), "index": some & s["last"].rlike(SECTION_INDEX),
        "dated": p.rlike(DATE_IN_PATH) | p.rlike(COMPACT_DATE), "digits": slug.rlike(r"^\d+$"), "year": slug.rlike(BARE_YEAR), "long": F.length(slug) >= 4, "n": s["n"], "last": s["last"], "words": F.size(F.filter(F.split(slug, "[-_]"), lambda w: w != "")),
    }
    return F.struct(*[c.alias(k) for k, c in holds.items()])


def _scored(s: Column) -> Column:
    n, words, digits, year, hard, dated = (s[k] for k in ("n", "words", "digits", "year", "hard", "dated"))
    worded, numbered = (n > 0) & (words >= 3) & ~digits, (n > 0) & digits & s["long"]
    rules = [  # (what holds, what it adds, how it reads), in the order of the reasons
        (s["listing"], -3.0, F.lit("listing path segment")),
        (hard, -10.0, F.lit("non-news section")),
        (~hard & s["soft"], -10.0, F.lit("static institutional section")),
        (s["paged"], -3.0, F.lit("pagination query param")),
        (s["index"], -3.0, F.concat(F.lit("section index: /"), s["last"])),
        (dated, 2.5, F.lit("date in path")),
        (n >= 3, 0.5, F.lit("deep path")),
        (n <= 1, -1.0, F.lit("shallow path")),
        (worded, 2.0, F.concat(F.lit("slug has "), words.cast("string"), F.lit(" words"))),
        ((n > 0) & (words == 1) & ~digits, -0.5, F.lit("single-word slug")),
        (numbered & year, -3.0, F.lit("date archive index")),
        (numbered & ~year, 1.0, F.lit("numeric article id")),
    ]
    signal = dated | worded | (numbered & ~year)
    score = reduce(lambda a, b: a + b, [F.when(holds, F.lit(v)).otherwise(F.lit(0.0)) for holds, v, _ in rules])
    reasons = F.array_compact(F.array(*[F.when(holds, text) for holds, _, text in rules], F.when(~signal, F.lit("no positive article signal"))))
    return F.struct(score.alias("score"), signal.alias("signal"), reasons.alias("reasons"))


def parent_path(url: Column) -> Column:
    """Directory of the path, '/' at the top."""
    p = F.regexp_replace(path(url), r"/+$", "")
    return F.coalesce(F.nullif(F.regexp_extract(p, r"^(.*)/[^/]*$", 1), F.lit("")), F.lit("/"))


def comparison_key(url: Column) -> Column:
    """Host without www. and port, lower-cased path without a trailing slash, sorted lower-cased query."""
    h = F.regexp_replace(host(url), r"^www\.", "")
    q = F.array_join(F.array_sort(F.filter(F.split(F.lower(query(url)), "&"), lambda x: x != "")), "&")
    tail = F.when(q == "", F.lit("")).otherwise(F.concat(F.lit("?"), q))
    return F.concat(h, F.regexp_replace(F.lower(path(url)), r"/+$", ""), tail)


def slug(url: Column) -> Column:
    """Last path segment in lower case, '' if there is none."""
    return F.lower(F.element_at(F.concat(F.array(F.lit("")), segments(path(url))), -1))


def tld(domain: Column) -> Column:
    return F.when(F.contains(domain, F.lit(".")), F.concat(F.lit("."), F.element_at(F.split(domain, r"\."), -1))).otherwise(F.lit("?"))


def with_www(url: Column) -> Column:
    """The same URL on the www. host; NULL if it is there already."""
    return F.when(~host(url).startswith("www."), F.regexp_replace(url, r"^([A-Za-z][A-Za-z0-9+.-]*://)", "$1www."))


def join(base: Column, reference: Column) -> Column:
    """Reference resolved against base; dot segments are removed by repeated replacement, eight levels deep, where there are any."""
    folder = F.regexp_extract(path(base), r"^(.*/)", 1)
    absolute = reference.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:")
    start = (
        F.when(reference.startswith("//"), F.concat(_part(base, 1), F.lit(":"), reference))
        .when(reference.startswith("/"), F.concat(origin(base), reference))
        .when(reference.startswith("?"), F.concat(origin(base), path(base), reference))
        .when(reference.startswith("#") | (reference == ""), base)
        .otherwise(F.concat(origin(base), F.when(folder == "", F.lit("/")).otherwise(folder), reference))
    )
    whole = let(start, lambda s: F.concat(origin(s), F.when(F.contains(path(s), F.lit("/.")), _undotted(path(s))).otherwise(path(s)), F.regexp_extract(s, r"([?#].*)$", 1)))
    return F.when(absolute, reference).otherwise(whole)


def _undotted(p: Column) -> Column:
    p = F.regexp_replace(F.regexp_replace(p, r"/(?:\./)+", "/"), r"/\.$", "/")
    for _ in range(8):
        p = F.regexp_replace(p, r"^((?:/(?!\.\.(?:/|$))[^/]*)*?)/(?!\.\.(?:/|$))[^/]+/\.\.(?:/|$)", "$1/")
    return F.regexp_replace(p, r"^(?:/\.\.)+(?=/|$)", "")


def shard_ranges(workers: int, shards: int = 1024) -> list[tuple[int, int]]:
    """[low, high) of each worker's shards; sizes differ by one at most."""
    return [(k * shards // workers, (k + 1) * shards // workers) for k in range(workers)]
