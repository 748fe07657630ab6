"""Public suffixes: rules that cover most of the public list natively, and the list itself, read from a file, for those who need all of it.

The published list has some ten thousand entries; it isn't part of this package. `load` reads it (the file that operating systems
ship, or any copy), and `registrable_domain` then answers exactly by it, in one Arrow pass over the hosts. Without a file the
patterns below stand in: second levels that country domains share, and the regional levels of those countries that have them.
"""

from __future__ import annotations

from dataclasses import dataclass
from pathlib import Path

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: Where systems keep the list; a parameter of load.
SYSTEM_FILE = "/usr/share/publicsuffix/public_suffix_list.dat"

# ---- fixed values: shapes of public suffixes
_GENERIC = "ac|co|com|edu|gob|gouv|gov|govt|go|gv|info|ltd|med|mil|ne|net|nom|or|org|plc|pro|sch"
_CANADA = "ab|bc|gc|mb|nb|nf|nl|ns|nt|nu|on|pe|qc|sk|yk"
_STATES = "ak|al|ar|as|az|ca|co|ct|dc|de|fl|ga|gu|hi|ia|id|il|in|ks|ky|la|ma|md|me|mi|mn|mo|ms|mt|nc|nd|ne|nh|nj|nm|nv|ny|oh|ok|or|pa|pr|ri|sc|sd|tn|tx|ut|va|vi|vt|wa|wi|wv|wy"
_AUSTRALIA = "act|nsw|nt|qld|sa|tas|vic|wa"
TWO_LABELS = rf"^(?:(?:{_GENERIC})\.[a-z]{{2}}|(?:{_CANADA})\.ca|(?:{_STATES}|fed|isa|nsn|dni|kids)\.us|(?:nhs|me|police)\.uk|(?:asn|id|{_AUSTRALIA})\.au|(?:ac|cri|geek|gen|iwi|kiwi|maori|school|health)\.nz|nic\.in|firm\.in|re\.kr|ad\.jp|gr\.jp|lg\.jp|ed\.jp)$"
THREE_LABELS = rf"^(?:(?:k12|cc|lib)\.(?:{_STATES})\.us|(?:{_AUSTRALIA})\.edu\.au|(?:qld|sa|tas|vic|wa)\.gov\.au|[a-z]+\.sch\.uk)$"
# ---- end of fixed values


@dataclass(frozen=True)
class Rules:
    """A public suffix list: plain rules, bases of wildcard rules (`ck` for `*.ck`) and exceptions."""

    plain: frozenset[str]
    wild: frozenset[str]
    excepted: frozenset[str]

    def suffix_labels(self, labels: list[str]) -> int:
        """How many labels of a host make up its public suffix; one for a host that no rule covers."""
        best = 1
        for n in range(1, len(labels) + 1):
            tail = ".".join(labels[-n:])
            if tail in self.excepted:
                return n - 1
            if tail in self.plain or (n > 1 and ".".join(labels[1 - n :]) in self.wild):
                best = max(best, n)
        return best

    def registrable(self, host: str | None) -> str | None:
        """The label in front of the public suffix, with it; a host that is all suffix, an address or a single label stays whole."""
        if not host or ":" in host or host.replace(".", "").isdigit():
            return host
        labels = host.split(".")
        n = self.suffix_labels(labels)
        return ".".join(labels[-n - 1 :]) if len(labels) > n else host


def parse(text: str, private: bool = True) -> Rules:
    """Rules of a list as it is published; private: those that companies give out below their own names too."""
    plain, wild, excepted = set(), set(), set()
    for line in text.splitlines():
        if not private and "BEGIN PRIVATE DOMAINS" in line:
            break
        rule = line.strip().split(" ")[0].lower() if line.strip() else ""
        if not rule or rule.startswith("//"):
            continue
        ascii_rule = ".".join(_ascii(label) for label in rule.lstrip("!").split("."))
        (excepted if rule.startswith("!") else wild if rule.startswith("*.") else plain).add(ascii_rule.removeprefix("*."))
    return Rules(frozenset(plain), frozenset(wild), frozenset(excepted))


def _ascii(label: str) -> str:
    """The form in which a label stands in URLs; the host is matched as written too, so one that can't be encoded stays."""
    try:
        return label.encode("idna").decode() if not label.isascii() else label
    except UnicodeError:
        return label


def load(path: str = SYSTEM_FILE, private: bool = False) -> Rules:
    """Read on the driver; executors get the rules, some hundred kB whatever the data."""
    return parse(Path(path).read_text("utf-8"), private)


def by_list(host: Column, rules: Rules) -> Column:
    """registrable() of each host: one Arrow pass, which remembers the hosts it has met."""

    @F.pandas_udf(StringType())
    def answer(hosts: pd.Series) -> pd.Series:
        known = {h: rules.registrable(h) for h in hosts.unique()}
        return hosts.map(known)

    return answer(host)
