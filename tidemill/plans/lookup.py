"""Lookups in dimension and parameter tables without guessing their size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.plans.scratch import materialize

BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 256 * 1024 * 1024


def _bytes(column: str, kind: T.DataType) -> Column:
    """About what a value takes in memory."""
    if isinstance(kind, (T.StringType, T.BinaryType)):
        size = F.octet_length(column)
    elif isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.NumericType):
        size = F.size(column) * 8
    elif isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
        size = F.octet_length(F.to_json(F.struct(column)))
    else:
        size = F.lit(0)
    return F.coalesce(size, F.lit(0)) + 16


def fits_broadcast(
    df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES
) -> bool:
    """True if rows and bytes of ``df`` stay within the limits; both are summed up task by task."""
    width = sum((_bytes(f.name, f.dataType) for f in df.schema.fields), F.lit(0))
    size = df.agg(F.count(F.lit(1)).alias("n"), F.sum(width.cast("bigint")).alias("b")).first()
    return size["n"] <= max_rows and (size["b"] or 0) <= max_bytes


def lookup_join(
    big: DataFrame,
    dim: DataFrame,
    on: Sequence[str],
    how: str = "left",
    max_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Join ``big`` to ``dim`` (unique on ``on``), ``how`` being ``left`` or ``inner``.

    ``dim`` is broadcast after a check of its rows and bytes. Beyond the limit both sides shuffle once,
    and Spark's adaptive execution splits the partitions of hot keys by their measured size.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"unsupported join type {how!r}")
    return big.join(F.broadcast(dim) if fits_broadcast(dim, max_rows) else dim, list(on), how)


def lookup_rows(
    big: DataFrame, asked: DataFrame, on: Sequence[str], max_rows: int = BROADCAST_ROWS, partitions: int | None = None
) -> DataFrame:
    """All pairs of a wide table and the rows that ask for it: these travel to the table where they are few. Else both are
    shuffled, into ``partitions`` if given."""
    on = list(on)
    if fits_broadcast(asked, max_rows):
        return big.join(F.broadcast(asked), on)
    if partitions:
        big, asked = big.repartition(partitions, *on), asked.repartition(partitions, *on)
    return big.join(asked, on)


def param_join(df: DataFrame, params: DataFrame, on: Sequence[str], how: str = "left") -> DataFrame:
    """Join a fitted parameter table, which is worked out and written once."""
    return lookup_join(df, materialize(params, "params"), on, how)
