"""Exponentially decayed running sums."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

SPAN = 100.0  # decay units per block: exp(100) stays far inside the range of a double
LOOKBACK = 8  # blocks: weights beyond exp(-700) are below the smallest double


def decayed_sum(
    df: DataFrame, by: Sequence[str], at: str, value: str, rate: float, out: str
) -> DataFrame:
    """Add ``out`` = sum over earlier and equal rows of ``value * exp(-rate * (at - at_i))``.

    ``at`` is a number, unique within ``by``. Rows are cut into blocks of fixed length on that
    axis, so the running part is a plain window per (key, block) and a long history of one key is
    shared by many tasks. Only block totals are carried from block to block.
    """
    by = list(by)
    length = SPAN / rate
    cut = df.withColumn("_block", F.floor(F.col(at) / F.lit(length)).cast("bigint"))
    start = F.col("_block") * F.lit(length)
    grown = F.col(value) * F.exp(F.lit(rate) * (F.col(at) - start))
    here = W.partitionBy(*by, "_block").orderBy(at).rowsBetween(W.unboundedPreceding, 0)
    totals = cut.groupBy(*by, "_block").agg(F.sum(grown).alias("_total"))
    back = W.partitionBy(*by).orderBy("_block").rowsBetween(-LOOKBACK, -1)
    carried = totals.select(
        *by, "_block", F.collect_list(F.struct("_block", "_total")).over(back).alias("_past")
    ).select(
        *by,
        "_block",
        F.aggregate(
            "_past",
            F.lit(0.0),
            lambda acc, p: acc
            + p["_total"] * F.exp(F.lit(-SPAN) * (F.col("_block") - p["_block"]).cast("double")),
        ).alias("_carry"),
    )
    return (
        cut.withColumn("_local", F.sum(grown).over(here))
        .join(carried, [*by, "_block"])
        .withColumn(
            out,
            (F.col("_local") + F.col("_carry")) * F.exp(F.lit(-rate) * (F.col(at) - start)),
        )
        .select(*df.columns, out)
    )
