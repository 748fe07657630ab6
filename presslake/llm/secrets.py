"""Secret scan: all rules in one deterministic automaton, one pass over the bytes of each text.

The automaton reads the text backwards: it accepts where some rule's match can begin. The longest
match from there, by the rule's own automaton, gives leftmost non-overlapping spans, as a regular
expression would. Both automata are built on the driver and travel as arrays (a few hundred kB,
whatever the data); no row is shuffled.
"""

from __future__ import annotations

import hashlib
import operator
import re
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .automaton import compile_rules, parse
from .common import map_batches


@dataclass(frozen=True)
class Rule:
    """pattern finds; a match is kept if it, or the value behind its `:` or `=`, has `least` characters.

    begin: what the one pass looks for, where that is stricter than pattern without losing a kept match.
    """

    kind: str
    pattern: str
    least: int
    ignore_case: bool = False
    value: bool = False
    begin: str = ""


BASE = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]+""", 6, ignore_case=True, value=True),
    Rule("access", r"AKIA[A-Z0-9]+", 20),
    Rule("hex", r"[0-9a-f]+", 24, begin=r"[0-9a-f]{24,}"),
)
#: Published token forms besides the base ones.
MORE = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]+", 40),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]+", 15),
    Rule("google", r"AIza[A-Za-z0-9_-]+", 39),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 40),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 27),
)



class Scanner:
    """Compiled rules; picklable, built once on the driver. Value letters of `assign` hold both cases already, so folding all is the same."""

    def __init__(self, rules: tuple[Rule, ...] = BASE + MORE) -> None:
        self.rules = rules
        self.starts = compile_rules([parse(r.begin or r.pattern, r.ignore_case) for r in rules], backwards=True, anywhere=True)
        self.ends = [compile_rules([parse(r.pattern, r.ignore_case)]) for r in rules]

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if not k.startswith("_")}

    def _ready(self):
        """Rows of the combined automaton as lists of lists: stepping is then one index a byte, run by accumulate in C.

        A row's length tells what its state accepts, so map(len) reads that off without a Python step.
        """
        if "_rows" not in self.__dict__:
            width = self.starts.next.shape[1]
            kinds = sorted(set(self.starts.accepts.tolist()) - {0})
            rows: list[list] = [[] for _ in self.starts.accepts]
            for row, to, bits in zip(rows, self.starts.next.tolist(), self.starts.accepts.tolist(), strict=True):
                row.extend(rows[t] for t in to)
                row.extend([None] * (kinds.index(bits) + 1 if bits else 0))
            self._rows, self._width, self._kinds = rows, width, kinds
            self._hit = re.compile(b"[^" + re.escape(bytes([width])) + b"]") if width + len(kinds) < 256 else None
        return self._rows[0]

    def _marked(self, data: bytes):
        """(place, row length) wherever, reading backwards, a state accepts; lengths that fit no byte are numbers of four."""
        lengths = map(len, accumulate(data.translate(self.starts.classes)[::-1], operator.getitem, initial=self._ready()))
        if self._hit is not None:
            marks = bytes(lengths)
            return ((m.start(), marks[m.start()]) for m in self._hit.finditer(marks))
        marks = np.fromiter(lengths, np.int32, len(data) + 1)
        places = np.flatnonzero(marks != self._width)
        return zip(places.tolist(), marks[places].tolist(), strict=True)

    def spans(self, text: str) -> list[tuple[int, str, int]]:
        """(start, kind, end) of all kept matches in code points, by start and then by the order of the rules."""
        self._ready()
        data = text.encode("utf-8", "surrogatepass")
        hits: list[list[int]] = [[] for _ in self.rules]
        for place, mark in self._marked(data):
            bits = self._kinds[mark - self._width - 1]
            for k in range(len(self.rules)):
                if bits >> k & 1:
                    hits[k].append(len(data) - place)
        found = []
        for k, (rule, starts) in enumerate(zip(self.rules, hits, strict=True)):
            behind = 0
            for start in reversed(starts):
                if start >= behind and (end := self.ends[k].longest(data, start)) > 0:
                    behind = end
                    if self._length(rule, data[start:end]) >= rule.least:
                        found.append((start, k, end))
        if not found:
            return []
        found.sort()
        if len(data) != len(text):
            points = np.concatenate([[0], np.cumsum((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)])
            return [(int(points[s]), self.rules[k].kind, int(points[e])) for s, k, e in found]
        return [(s, self.rules[k].kind, e) for s, k, e in found]

    @staticmethod
    def _length(rule: Rule, match: bytes) -> int:
        """All characters are ASCII here. The value starts behind the first : or =, spaces and a quote."""
        if not rule.value:
            return len(match)
        rest = match[re.search(b"[:=]", match).end() :].lstrip(b" ")
        return len(rest) - (rest[:1] in (b'"', b"'"))


def joined(spans: list[tuple[int, str, int]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, kind, end in spans)


def redacted(text: str, spans: list[tuple[int, str, int]]) -> str:
    """text with each span, or run of overlapping spans, replaced by <secret>."""
    parts, at = [], 0
    for start, _, end in spans:
        if start >= at:
            parts += [text[at:start], "<secret>"]
        at = max(at, end)
    return "".join([*parts, text[at:]]) if spans else text


SCANNED = pa.schema([("doc_id", pa.int64()), ("n_assign", pa.int64()), ("n_access", pa.int64()), ("n_hex", pa.int64()), ("base_sha256", pa.string()), ("spans", pa.string())])


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", scanner: Scanner | None = None) -> DataFrame:
    """Spans of secrets in every whole text: id, counts of the base kinds, a digest of the base spans and all spans.

    Null text counts as empty (no spans, digest of the empty string); a null id stays null; repeated
    rows each give a row; an empty table gives none; other columns, whatever their names, are not read.
    """
    scanner = scanner or Scanner()
    base = {r.kind for r in BASE}

    def start():
        def f(batch):
            out = [scanner.spans(t) if t else [] for t in batch.column(1).to_pylist()]
            own = [[s for s in spans if s[1] in base] for spans in out]
            count = lambda kind: [sum(s[1] == kind for s in spans) for spans in own]
            return [batch.column(0), count("assign"), count("access"), count("hex"), [hashlib.sha256(joined(s).encode()).hexdigest() for s in own], [joined(s) for s in out]]

        return f

    return map_batches(docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text")), SCANNED, start)


def redact(docs: DataFrame, scanner: Scanner | None = None) -> DataFrame:
    """docs with secrets of text replaced by <secret> and n_chars counted anew where text changed; every row and column stays."""
    from pyspark.sql.pandas.types import to_arrow_schema

    scanner = scanner or Scanner()
    names = docs.columns
    schema = to_arrow_schema(docs.schema)

    def start():
        def f(batch):
            columns = list(batch.columns)
            texts = columns[names.index("text")].to_pylist()
            changed = {i: redacted(t, spans) for i, t in enumerate(texts) if t and (spans := scanner.spans(t))}
            if changed:
                columns[names.index("text")] = pa.array([changed.get(i, t) for i, t in enumerate(texts)], pa.string())
                if "n_chars" in names:
                    counts = columns[names.index("n_chars")].to_pylist()
                    columns[names.index("n_chars")] = pa.array([len(changed[i]) if i in changed else n for i, n in enumerate(counts)], pa.int64())
            return columns

        return f

    return map_batches(docs, schema, start)


def _sql() -> str:
    """DuckDB SQL of the query's rows: matches and the pieces between them, as lists, give the places."""
    found = []
    for k, rule in enumerate(BASE + MORE):
        pattern = ("(?i:password|passwd|secret|token|api_?key)" + rule.pattern.partition(")")[2] if rule.ignore_case else rule.pattern).replace("'", "''")
        length = "len(s.m)"
        if rule.value:  # the value starts behind the first : or =
            length = "len(regexp_replace(regexp_extract(s.m, '[:=]\\x20*(.*)$', 1), '^[\"'']', ''))"
        found.append(
            f"""SELECT doc_id, rid, {k} AS k, '{rule.kind}' AS kind, s.a AS a, s.b AS b FROM (
  SELECT doc_id, rid, unnest(list_transform(range(1, len(ms) + 1), lambda i: {{'m': ms[i],
      'a': CAST(coalesce(list_sum(list_transform(ps[1:i], lambda x: len(x))), 0) + coalesce(list_sum(list_transform(ms[1:i-1], lambda x: len(x))), 0) AS BIGINT),
      'b': CAST(coalesce(list_sum(list_transform(ps[1:i], lambda x: len(x))), 0) + coalesce(list_sum(list_transform(ms[1:i], lambda x: len(x))), 0) AS BIGINT)}})) AS s
      FROM (SELECT doc_id, rid, regexp_extract_all(t, '{pattern}') AS ms, string_split_regex(t, '{pattern}') AS ps FROM d)) WHERE {length} >= {rule.least}"""
        )
    spans = "string_agg(kind || ':' || a || ':' || b, ',' ORDER BY a, k)"
    return f"""WITH d AS (SELECT doc_id, row_number() OVER () AS rid, coalesce(text, '') AS t FROM documents),
f AS ({" UNION ALL ".join(found)}),
g AS (SELECT rid, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
  {spans} FILTER (k < {len(BASE)}) AS base, {spans} AS spans FROM f GROUP BY rid)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN g ON d.rid = g.rid"""


SQL = _sql()
