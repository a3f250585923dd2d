"""Exploratory statistics. Columns are scanned once; long results are unpivoted afterwards."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.plans import exact_quantiles


def _long(one_row: DataFrame, fields: dict[str, list[Column]], names: Sequence[str]) -> DataFrame:
    """Turn one wide row into one row per key; ``fields`` holds the values in the order of names."""
    rows = [
        F.struct(F.lit(key).alias("column"), *[v.alias(n) for v, n in zip(vals, names, strict=True)])
        for key, vals in fields.items()
    ]
    return one_row.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def schema_info(df: DataFrame) -> DataFrame:
    """Type and non-null count of every column."""
    types = dict(df.dtypes)
    counts = df.agg(*[F.count(c).alias(c) for c in df.columns])
    fields = {c: [F.lit(types[c]), F.col(c)] for c in df.columns}
    return _long(counts, fields, ["dtype", "non_null"])


def unpivot(df: DataFrame, columns: Sequence[str], kind: str, keep: Sequence[str] = ()) -> DataFrame:
    cast = [F.col(c).cast(kind).alias(c) for c in columns]
    return df.select(*keep, *cast).unpivot(list(keep), list(columns), "column", "value")


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, sample deviation, exact quartiles and range per numeric column."""
    long = unpivot(df, columns, "double").where(F.col("value").isNotNull())
    basic = long.groupBy("column").agg(
        F.count("value").alias("count"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    quartiles = exact_quantiles(long, "value", [0.25, 0.5, 0.75], ["q25", "q50", "q75"], ["column"])
    return basic.join(F.broadcast(quartiles), "column")  # one row per profiled column


def class_balance(df: DataFrame, label: str) -> DataFrame:
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    total = df.agg(F.count(F.lit(1)).alias("total"))
    return counts.withColumn("share", F.col("n") / total.scalar())


def missing_pct(df: DataFrame) -> DataFrame:
    shares = df.agg(*[(F.avg(F.col(c).isNull().cast("int")) * 100).alias(c) for c in df.columns])
    return _long(shares, {c: [F.col(c)] for c in df.columns}, ["missing_pct"])


def missing_pattern(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows per combination of missing columns."""
    flags = [F.col(c).isNull().cast("int").alias(f"{c}_missing") for c in columns]
    names = [f"{c}_missing" for c in columns]
    return df.select(*flags).groupBy(*names).agg(F.count(F.lit(1)).alias("n"))


def histogram(df: DataFrame, columns: Sequence[str], bins: int = 10) -> DataFrame:
    """Counts in ``bins`` equal intervals between minimum and maximum of each column."""
    ends = df.agg(
        *[F.min(c).cast("double").alias(f"lo_{c}") for c in columns],
        *[F.max(c).cast("double").alias(f"hi_{c}") for c in columns],
    ).first()
    long = unpivot(df, columns, "double").where(F.col("value").isNotNull())

    def per_column(prefix: str) -> Column:
        return F.coalesce(
            *[F.when(F.col("column") == c, F.lit(ends[f"{prefix}_{c}"])) for c in columns]
        )

    width = (F.col("hi") - F.col("lo")) / bins
    at = F.when(F.col("hi") == F.col("lo"), F.lit(0)).otherwise(
        F.least(F.lit(bins - 1), F.floor((F.col("value") - F.col("lo")) / width))
    )
    return (
        long.withColumns({"lo": per_column("lo"), "hi": per_column("hi")})
        .withColumn("bin", at.cast("int"))
        .groupBy("column", "bin")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min(F.col("lo") + F.col("bin") * width).alias("bin_start"),
        )
    )


def category_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return unpivot(df, columns, "string").groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))


def rate_by_feature(df: DataFrame, columns: Sequence[str], label: str) -> DataFrame:
    """Share of positive labels for every value of every feature."""
    return (
        unpivot(df.withColumn("_y", F.col(label)), columns, "string", ["_y"])
        .groupBy(F.col("column").alias("feature"), "value")
        .agg(F.avg("_y").alias("rate"), F.count(F.lit(1)).alias("n"))
    )


def corr_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of all column pairs in one pass, both orders and the diagonal."""
    pairs = list(combinations(columns, 2))
    row = df.agg(*[F.corr(a, b).alias(f"c{i}") for i, (a, b) in enumerate(pairs)])
    cells = [(a, b, F.col(f"c{i}")) for i, (a, b) in enumerate(pairs)]
    cells += [(b, a, v) for a, b, v in cells] + [(c, c, F.lit(1.0)) for c in columns]
    entries = [
        F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), v.alias("corr")) for a, b, v in cells
    ]
    return row.select(F.explode(F.array(*entries)).alias("r")).select("r.*")


def corr_with_label(df: DataFrame, columns: Sequence[str], label: str) -> DataFrame:
    """Features by strength of their correlation with the label."""
    row = df.agg(*[F.corr(c, label).alias(c) for c in columns])
    return _long(row, {c: [F.col(c)] for c in columns}, ["corr"]).orderBy(F.abs("corr").desc(), "column")


def corr_warning(df: DataFrame, columns: Sequence[str], limit: float) -> DataFrame:
    """Pairs of selected columns with too high a correlation."""
    return corr_matrix(df, columns).where((F.col("a") < F.col("b")) & (F.abs("corr") > limit))


def dataset_fingerprint(df: DataFrame, method: str = "xxhash64") -> DataFrame:
    """Row count plus xor and sum of row hashes: the same for any order or partitioning of the rows.

    The sum tells duplicate rows apart, which cancel out in the xor. ``method='md5'`` gives a hash
    that other engines can repeat.
    """
    if method == "xxhash64":
        key = F.xxhash64(*df.columns)
    else:
        text = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in df.columns])
        key = F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")
    return df.select(key.alias("h")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.bit_xor("h").alias("hash_xor"),
        F.sum(F.col("h").cast("decimal(38,0)")).cast("string").alias("hash_sum"),
    )
