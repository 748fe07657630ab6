"""Small helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def lookup(word: Column, values: Mapping, unknown) -> Column:
    """The value of a word in a small fixed map; `unknown` for any other word and for NULL."""
    found = F.element_at(F.create_map(*[F.lit(x) for pair in values.items() for x in pair]), word)
    return F.coalesce(found, F.lit(unknown))


def rank_in(word: Column, words: tuple[str, ...]) -> Column:
    """1 for the first of words and so on; 0 for any other word and for NULL."""
    return F.coalesce(F.array_position(F.array(*[F.lit(w) for w in words]), word), F.lit(0)).cast("int")


def days_between(later: Column, earlier: Column) -> Column:
    """Whole days, rounded down also below zero."""
    return F.floor((later.cast("timestamp").cast("long") - earlier.cast("timestamp").cast("long")) / 86400).cast("int")


def plural(n: Column, noun: str) -> Column:
    return F.concat(n.cast("string"), F.lit(f" {noun}"), F.when(n == 1, F.lit("")).otherwise(F.lit("s")))


def percent(part: Column, whole: Column, digits: int = 1) -> Column:
    return F.round(100 * part / F.when(whole > 0, whole).otherwise(F.lit(1)), digits)


def upper_median(value: str) -> Column:
    """Element n // 2 of the sorted values of a column; nulls don't count, none gives NULL.

    Exact, from counts by value, which merge before the shuffle: memory follows the number of different values, not of rows.
    """
    return F.expr(f"percentile_disc(0.5) WITHIN GROUP (ORDER BY `{value}` DESC)")


def relative_age(at: Column, now: Column) -> Column:
    """How far a time is from now, in whole minutes, hours or days, signed by words; '-' for NULL."""
    seconds = at.cast("timestamp").cast("double") - now.cast("timestamp").cast("double")
    gap = F.abs(seconds)
    whole = lambda unit, mark: F.concat(F.floor(gap / unit).cast("string"), F.lit(mark))
    size = F.when(gap < 3600, whole(60, "m")).when(gap < 86400, whole(3600, "h")).otherwise(whole(86400, "d"))
    return F.when(at.isNull(), F.lit("-")).when(seconds > 0, F.concat(F.lit("in "), size)).otherwise(F.concat(size, F.lit(" ago")))


def spread(rows: DataFrame, *keys: str) -> DataFrame:
    """rows dealt by keys over the session's shuffle partitions: for rows that give many others or much work, as Spark deals out files by their bytes."""
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def large(side: DataFrame) -> DataFrame:
    """A side of a join that grows with the input: sorted, never broadcast. Spark guesses a side by the bytes of its files, takes
    what is exploded from a small one for small, and would bring it all to the driver."""
    return side.hint("merge")
