"""The most prose-like stretch of a text. Windows advance by what they hold, so this measure runs in Arrow batches."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from .text import SENTENCE_END, WINDOW_CHARS

_END = re.compile(SENTENCE_END)


def ratio(text: str | None) -> float:
    """The same measure as text.prose_ratio."""
    lines = [line for line in map(str.strip, (text or "").split("\n")) if line]
    if not lines:
        return 0.0
    long_share = sum(len(line) >= 60 for line in lines) / len(lines)
    sentences = min(1.0, len(_END.findall(text)) / max(1.0, len(text) / 150))
    return round((long_share + sentences) / 2, 3)


def best(text: str | None, size: int = WINDOW_CHARS) -> float:
    """The best ratio of windows of whole lines, each at least `size` characters and half over the one before; a short text is one window."""
    if not text or len(text) <= size:
        return ratio(text)
    lines = [line for line in text.split("\n") if line.strip()]
    top, start = 0.0, 0
    while start < len(lines):
        end, chars = start, 0
        while end < len(lines) and chars < size:
            chars += len(lines[end]) + 1
            end += 1
        if chars < size and start:
            break  # what is left was in the window before
        top = max(top, ratio("\n".join(lines[start:end])))
        if chars < size:
            break
        start += max(1, (end - start) // 2)
    return top


@F.pandas_udf(DoubleType())
def _best(texts: pd.Series) -> pd.Series:
    return texts.map(best)


def best_prose_ratio(text: Column) -> Column:
    return _best(text)


def looks_like_navigation(text: Column, below: float = 0.30) -> Column:
    """True also for a NULL or empty text."""
    return F.coalesce(F.nullif(text, F.lit("")).isNull() | (_best(text) < below), F.lit(True))
