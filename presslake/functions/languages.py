"""Language of a body by its function words, a Column expression.

The opening of a body is split into words; the language whose function words make the largest share of them wins. No
model is trained or shipped, so short or mixed texts give NULL rather than a guess.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .urls import let

# ---- fixed values: how much is read, and what decides
MIN_CHARS, READ_CHARS, LEAST_SHARE, LEAST_LEAD = 40, 2000, 0.08, 1.25
FUNCTION_WORDS = {
    "en": "the of and to in that is for it was with as on by at from this are be which",
    "de": "der die und das den von zu mit sich des auf nicht ein eine im dem ist auch es",
    "fr": "le la les de des et un une du dans est pour que qui sur pas au avec ce en",
    "es": "el los las de y que en un una del por con para es se al lo como su no",
    "it": "il di che e la per un una in del della con sono le dei al nel non gli si",
    "pt": "o os as de e que do da em um uma para com por dos das ao na no se",
    "nl": "de het een en van in is dat op te met voor zijn niet aan er ook bij door",
    "sv": "och att det som en på är av för med den till inte om ett har de var sig",
}
# ---- end of fixed values


def shares(body: Column) -> Column:
    """ARRAY<STRUCT<share, language>>: for each language the share of the opening's words that are its function words."""
    words = F.regexp_extract_all(F.lower(F.substring(body, 1, READ_CHARS)), F.lit(r"[\p{L}]+"), F.lit(0))

    def rated(w: Column, name: str, own: str) -> Column:
        known = F.array(*map(F.lit, own.split()))
        return F.struct((F.size(F.filter(w, lambda x: F.array_contains(known, x))) / F.greatest(F.size(w), F.lit(1))).alias("share"), F.lit(name).alias("language"))

    return let(words, lambda w: F.array(*[rated(w, name, own) for name, own in FUNCTION_WORDS.items()]))


def detect(body: Column) -> Column:
    """Code of the language of a body of MIN_CHARS or more; NULL for shorter ones and where no language leads clearly."""
    best = lambda s: F.when((s[0]["share"] >= LEAST_SHARE) & (s[0]["share"] >= LEAST_LEAD * s[1]["share"]), s[0]["language"])
    return F.when(F.length(F.trim(body)) >= MIN_CHARS, let(F.reverse(F.array_sort(shares(body))), best))
