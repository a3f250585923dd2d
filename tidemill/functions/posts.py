"""Expressions on social posts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD = r"[\p{L}\p{N}_]+"


def tags(text: Column, mark: str) -> Column:
    """Distinct lower-case words that follow ``mark`` ('#' or '@')."""
    found = F.regexp_extract_all(text, F.lit(f"{mark}({WORD})"), F.lit(1))
    return F.array_distinct(F.transform(found, F.lower))


def hashtags(text: Column) -> Column:
    return tags(text, "#")


def mentions(text: Column) -> Column:
    return tags(text, "@")


def language(lang: Column, default: str = "und") -> Column:
    """Primary language subtag in lower case."""
    return F.lower(F.coalesce(F.split(lang, "[-_]").getItem(0), F.lit(default)))


def bounded_sentiment(sentiment: Column) -> Column:
    return F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.coalesce(sentiment, F.lit(0.0))))
