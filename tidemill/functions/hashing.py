"""Seeded draws that any SQL engine can repeat."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DRAWS = 2**32


def hash_draw(key: Column, seed: int) -> Column:
    """A whole number in [0, 2^32) from the md5 of ``key:seed``."""
    text = F.concat(key.cast("string"), F.lit(f":{seed}"))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def hash_bucket(key: Column, seed: int, buckets: int) -> Column:
    return F.pmod(hash_draw(key, seed), F.lit(buckets))


def hash_unit(key: Column, seed: int) -> Column:
    """A double in [0, 1)."""
    return hash_draw(key, seed).cast("double") / F.lit(float(DRAWS))


def wide_draw(key: Column, seed: int) -> Column:
    """A whole number in [0, 2^60), for draws over ranges beyond 2^32."""
    text = F.concat(key.cast("string"), F.lit(f":{seed}"))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")
