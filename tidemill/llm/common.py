"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def without(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """``df`` less the columns whose names clash with ``names``, whatever their case."""
    taken = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])


def id_remainder(id_col: str, modulus: int) -> Column:
    """``crc32`` of the id written as text, modulo ``modulus``; null ids count as remainder 0."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % modulus, F.lit(0))


def hash_share(*parts: Column) -> Column:
    """A number in [0, 1) from the first 52 bits of the MD5 of the parts joined by colons."""
    text = F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("null")) for p in parts])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("bigint") / F.lit(float(2**52))


def give_back() -> None:
    """Freed memory goes back to the system at the end of a task, since a worker that waits for the next one keeps it else."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU C library
    if trim is not None:
        trim(0)
