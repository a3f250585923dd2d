"""Order-dependent results over tables that do not fit one task.

All helpers share one idea: cut the ordering column at approximate quantiles, summarise every
range, carry the summaries forward over the short list of ranges, and finish inside each range.
The cut points are plain numbers in the plan, so a recomputed task lands in the same range, and the
results are exact whatever the quality of the cuts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemill.plans.scratch import materialize

ROWS_PER_RANGE = 5_000_000


def range_count(df: DataFrame) -> int:
    """Ranges to begin with: one per shuffle partition."""
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(8, partitions)


def cut_points(
    df: DataFrame, key: Column, ranges: int | None = None, rows_per_range: int = ROWS_PER_RANGE
) -> list[float]:
    """Increasing approximate quantiles of a numeric key.

    Without a given number, a large table gets as many ranges as keep a range sortable by one task;
    a second pass is needed only where the shuffle partitions are too few for that.
    """
    keys = df.select(key.cast("double").alias("_key"))

    def quantiles(n: int):
        probs = ", ".join(f"{i / n!r}D" for i in range(1, n))
        cuts = F.expr(f"percentile_approx(_key, array({probs}), {max(10_000, 4 * n)})")
        return keys.agg(F.count(F.lit(1)).alias("n"), cuts.alias("c")).first()

    if ranges == 1:
        return []
    begin = ranges or range_count(df)
    row = quantiles(begin)
    wanted = row["n"] // rows_per_range
    if ranges is None and wanted > begin:
        row = quantiles(wanted)
    return sorted({float(c) for c in (row["c"] or [])})


def with_range(df: DataFrame, key: Column, cuts: Sequence[float], out: str) -> DataFrame:
    """Add the index of the range that holds ``key``. Equal keys always share a range."""
    if not cuts:
        return df.withColumn(out, F.lit(0))
    splits = [float("-inf"), *cuts, float("inf")]
    cutter = Bucketizer(splits=splits, inputCol="_key", outputCol="_range", handleInvalid="keep")
    cut = cutter.transform(df.withColumn("_key", key.cast("double")))
    return cut.withColumn(out, F.col("_range").cast("int")).drop("_key", "_range")


COMBINE = {"sum": F.sum, "max": F.max, "min": F.min}


def running(
    df: DataFrame,
    order: str,
    outputs: dict[str, tuple[str, str]],
    by: Sequence[str] = (),
    descending: bool = False,
    inclusive: bool = True,
    ranges: int | None = None,
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """Add running sums, maxima or minima, ``outputs`` being ``{out: (kind, column)}``.

    ``order`` is a numeric column, unique within ``by``: aggregate equal keys first, which also
    removes hot keys. Without ``inclusive`` the own row is left out.
    """
    by = list(by)
    cuts = cut_points(df, F.col(order), ranges, rows_per_range)
    cut = with_range(df, F.col(order), cuts, "_r")
    direction = F.col("_r").desc() if descending else F.col("_r").asc()
    before = W.partitionBy(*by).orderBy(direction).rowsBetween(W.unboundedPreceding, -1)
    totals = [COMBINE[kind](value).alias(f"_t_{out}") for out, (kind, value) in outputs.items()]
    carries = [
        COMBINE[kind](f"_t_{out}").over(before).alias(f"_o_{out}")
        for out, (kind, _) in outputs.items()
    ]
    offsets = cut.groupBy(*by, "_r").agg(*totals).select(*by, "_r", *carries)
    if not by:
        offsets = F.broadcast(offsets)  # one row per range
    inner = F.col(order).desc() if descending else F.col(order).asc()
    last = 0 if inclusive else -1
    local = W.partitionBy(*by, "_r").orderBy(inner).rowsBetween(W.unboundedPreceding, last)

    def joined(out: str, kind: str, value: str) -> Column:
        here, carry = COMBINE[kind](value).over(local), F.col(f"_o_{out}")
        if kind == "sum":
            return F.coalesce(carry, F.lit(0)) + F.coalesce(here, F.lit(0))
        return (F.greatest if kind == "max" else F.least)(carry, here)

    return cut.join(offsets, [*by, "_r"]).select(
        *df.columns, *[joined(out, k, v).alias(out) for out, (k, v) in outputs.items()]
    )


def prefix_sum(
    df: DataFrame,
    order: str,
    values: Sequence[str],
    by: Sequence[str] = (),
    descending: bool = False,
    ranges: int | None = None,
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """Add ``cum_<v>``, the inclusive running sum of each value; see :func:`running`."""
    outputs = {f"cum_{v}": ("sum", v) for v in values}
    return running(
        df,
        order,
        outputs,
        by,
        descending,
        ranges=ranges,
        rows_per_range=rows_per_range,
    )


def previous(
    df: DataFrame,
    order: str,
    values: Sequence[str],
    by: Sequence[str] = (),
    ranges: int | None = None,
) -> DataFrame:
    """Add ``prev_<v>`` from the row before in ``order`` (numeric, unique within ``by``)."""
    by = list(by)
    cuts = cut_points(df, F.col(order), ranges)
    cut = with_range(df, F.col(order), cuts, "_r").withColumn("_v", F.struct(*values))
    back = W.partitionBy(*by).orderBy("_r")
    carried = (
        cut.groupBy(*by, "_r")
        .agg(F.max_by("_v", order).alias("_last"))
        .select(*by, "_r", F.lag("_last").over(back).alias("_carry"))
    )
    local = W.partitionBy(*by, "_r").orderBy(order)
    return (
        cut.join(carried, [*by, "_r"])
        .withColumn("_p", F.coalesce(F.lag("_v").over(local), F.col("_carry")))
        .select(*df.columns, *[F.col(f"_p.{v}").alias(f"prev_{v}") for v in values])
    )


def exact_quantiles(
    df: DataFrame,
    value: str,
    probs: Sequence[float],
    names: Sequence[str],
    by: Sequence[str] = (),
    ranges: int | None = None,
) -> DataFrame:
    """Interpolated quantiles per group, one column per probability, without gathering a group.

    Equal values are counted before anything moves. Range totals tell which ranges hold the wanted
    ranks; only those ranges are ordered.
    """
    by = list(by)
    counted = materialize(
        df.where(F.col(value).isNotNull())
        .select(*by, F.col(value).cast("double").alias("_v"))
        .groupBy(*by, "_v")
        .agg(F.count(F.lit(1)).alias("_n")),
        "quantile",
    )
    cuts = cut_points(counted, F.col("_v"), ranges)
    cut = with_range(counted, F.col("_v"), cuts, "_r")
    group = W.partitionBy(*by)
    upto = group.orderBy("_r").rowsBetween(W.unboundedPreceding, -1)

    def target(i: int, prob: float, total: Column) -> list[Column]:
        spot = F.lit(float(prob)) * (total - 1)
        return [
            F.struct(
                F.lit(i).alias("i"),
                F.lit(side).alias("side"),
                edge(spot).cast("bigint").alias("rank"),
                (spot - F.floor(spot)).alias("frac"),
            )
            for side, edge in (("lo", F.floor), ("hi", F.ceil))
        ]

    totals = (
        cut.groupBy(*by, "_r")
        .agg(F.sum("_n").alias("_t"))
        .select(
            *by,
            "_r",
            "_t",
            F.coalesce(F.sum("_t").over(upto), F.lit(0)).alias("_before"),
            F.sum("_t").over(group).alias("_total"),
        )
        .withColumn(
            "_targets",
            F.array(*[t for i, p in enumerate(probs) for t in target(i, p, F.col("_total"))]),
        )
        .withColumn(
            "_targets",
            F.filter(
                "_targets",
                lambda t: (t["rank"] >= F.col("_before"))
                & (t["rank"] < F.col("_before") + F.col("_t")),
            ),
        )
        .where(F.size("_targets") > 0)
        .select(*by, "_r", "_before", "_targets")
    )
    if not by:
        totals = F.broadcast(totals)  # at most two ranges per probability
    local = W.partitionBy(*by, "_r").orderBy("_v").rowsBetween(W.unboundedPreceding, 0)
    ranked = (
        cut.join(totals, [*by, "_r"])
        .withColumn("_end", F.col("_before") + F.sum("_n").over(local))
        .withColumn(
            "_hit",
            F.explode(
                F.filter(
                    "_targets",
                    lambda t: (t["rank"] < F.col("_end")) & (t["rank"] >= F.col("_end") - F.col("_n")),
                )
            ),
        )
    )

    def pick(i: int, side: str) -> Column:
        return F.max(F.when((F.col("_hit.i") == i) & (F.col("_hit.side") == side), F.col("_v")))

    def frac(i: int) -> Column:
        return F.max(F.when(F.col("_hit.i") == i, F.col("_hit.frac")))

    return ranked.groupBy(*by).agg(
        *[
            (pick(i, "lo") + (pick(i, "hi") - pick(i, "lo")) * frac(i)).alias(name)
            for i, name in enumerate(names)
        ]
    )


def micros(ts: Column) -> Column:
    """Microseconds since 1970 of a time-zone-free timestamp."""
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), ts)


def asof_fill(
    df: DataFrame,
    by: Sequence[str],
    ts: str,
    tie: str,
    values: Sequence[str],
    ranges: int | None = None,
) -> DataFrame:
    """Replace nulls in a whole-row ``values`` struct by the latest earlier one of the same key.

    ``tie`` orders rows of equal time. Time is cut into ranges so that a hot key spreads over many
    tasks; each (key, range) passes on only its last value.
    """
    by = list(by)
    cuts = cut_points(df, micros(F.col(ts)), ranges)
    packed = with_range(df, micros(F.col(ts)), cuts, "_r").withColumn(
        "_value", F.when(F.col(tie) == 0, F.struct(*values))
    )
    latest = packed.where(F.col("_value").isNotNull()).groupBy(*by, "_r").agg(
        F.max_by("_value", ts).alias("_last")
    )
    present = packed.select(*by, "_r").distinct().join(latest, [*by, "_r"], "left")
    back = W.partitionBy(*by).orderBy("_r").rowsBetween(W.unboundedPreceding, -1)
    carried = present.select(*by, "_r", F.last("_last", True).over(back).alias("_carry"))
    local = W.partitionBy(*by, "_r").orderBy(ts, tie).rowsBetween(W.unboundedPreceding, 0)
    others = [c for c in df.columns if c not in values]
    return (
        packed.join(carried, [*by, "_r"])
        .withColumn("_value", F.coalesce(F.last("_value", True).over(local), F.col("_carry")))
        .select(*others, *[F.col(f"_value.{v}").alias(v) for v in values])
    )


def ranked_ids(df: DataFrame, key: str, out: str, ranges: int | None = None) -> DataFrame:
    """Number distinct non-null strings from 0 in code-point order without a global sort task.

    Spark deals the strings into ranges; the dealt table is written, so every later read sees the same.
    """
    dealt = df.select(key).repartitionByRange(ranges or range_count(df), key)
    dealt = materialize(dealt.withColumn("_r", F.spark_partition_id()), "ids")
    before = W.orderBy("_r").rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        dealt.groupBy("_r")
        .agg(F.count(F.lit(1)).alias("_t"))
        .select("_r", F.coalesce(F.sum("_t").over(before), F.lit(0)).alias("_o"))
    )
    local = W.partitionBy("_r").orderBy(key)
    return dealt.join(F.broadcast(offsets), "_r").select(
        key, (F.col("_o") + F.row_number().over(local) - 1).cast("bigint").alias(out)
    )
