"""Row rules, quality reports and entity checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Accepted ranges (low, high), None meaning open.
RANGES: dict[str, tuple[float | None, float | None]] = {
    "age": (0, 80),
    "fare": (0, None),
    "sibsp": (0, 8),
    "parch": (0, 6),
}

# Derived feature -> the inputs it is made from, and what counts as demographic.
REQUIRES = {
    "family_size": ["sibsp", "parch"],
    "is_alone": ["sibsp", "parch"],
    "age_bin": ["age"],
    "age_missing": ["age"],
}
DEMOGRAPHIC = ["age", "sex", "pclass"]
MIN_FEATURES = 3


def validate_rows(df: DataFrame, ranges: dict = RANGES) -> DataFrame:
    """Add ``violations``, the names of the columns out of range. Missing values are accepted."""

    def broken(column: str) -> Column:
        low, high = ranges[column]
        out = F.lit(False)
        if low is not None:
            out = out | (F.col(column) < low)
        if high is not None:
            out = out | (F.col(column) > high)
        return F.when(out, F.lit(column))

    return df.withColumn("violations", F.array_compact(F.array(*[broken(c) for c in ranges])))


def split_valid(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid rows, quarantined rows) of :func:`validate_rows`."""
    ok = F.size("violations") == 0
    return checked.where(ok).drop("violations"), checked.where(~ok)


def quality_report(df: DataFrame) -> DataFrame:
    """Per column: nulls left, numeric or not, rows, mean, min and max (numeric columns)."""
    numeric = {"int", "bigint", "double", "float", "smallint", "tinyint"}
    types = dict(df.dtypes)

    def stat(fn, c: str) -> Column:
        return fn(F.col(c).cast("double")) if types[c] in numeric else F.lit(None).cast("double")

    entries = [
        F.struct(
            F.lit(c).alias("column"),
            F.count_if(F.col(c).isNull()).alias("nulls"),
            F.lit(types[c] in numeric).alias("is_numeric"),
            F.count(F.lit(1)).alias("n_rows"),
            stat(F.avg, c).alias("mean"),
            stat(F.min, c).alias("min"),
            stat(F.max, c).alias("max"),
        ).alias(c)
        for c in df.columns
    ]
    return (
        df.agg(*entries)
        .select(F.explode(F.array(*[F.col(c) for c in df.columns])).alias("r"))
        .select("r.*")
    )


def entity_checks(df: DataFrame, entity: str, required: Sequence[str], expected: dict[str, str]) -> DataFrame:
    """Counts of broken import rules: null or repeated ids, null required fields, wrong types."""
    types = dict(df.dtypes)
    repeated = (
        df.where(F.col(entity).isNotNull())
        .groupBy(entity)
        .agg(F.count(F.lit(1)).alias("n"))
        .agg(F.count_if(F.col("n") > 1).alias("broken"))
        .select(F.lit("unique_id").alias("rule"), "broken")
    )
    nulls = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in [entity, *required]])
    wrong = {c: int(types.get(c) != t) for c, t in expected.items()}
    rules = [("id_present", F.col(entity))]
    rules += [(f"not_null:{c}", F.col(c)) for c in required]
    rules += [(f"type:{c}", F.lit(bad).cast("bigint")) for c, bad in wrong.items()]
    entries = F.array(*[F.struct(F.lit(k).alias("rule"), v.alias("broken")) for k, v in rules])
    return nulls.select(F.explode(entries).alias("r")).select("r.*").unionByName(repeated)


def error_filter(log: DataFrame, status: int = 500) -> DataFrame:
    return log.where(F.col("status") >= status)


def select_features(df: DataFrame, features: Sequence[str]) -> DataFrame:
    return df.select(*features)


def feature_dependency(selections: DataFrame, by: Sequence[str], requires: dict = REQUIRES) -> DataFrame:
    """Drop derived features that have lost all their inputs, and judge what is left.

    ``selections`` holds one row per selected feature of each choice; the result adds ``n_features``
    and ``valid`` (enough features, one of them demographic). The list of a choice is bounded by
    the number of features.
    """
    derived = [x for f, inputs in requires.items() for x in (F.lit(f), F.lit(inputs))]
    needs = F.create_map(*derived)
    chosen = selections.groupBy(*by).agg(F.collect_set("feature").alias("_all"))

    def kept(f: Column) -> Column:
        return needs[f].isNull() | F.arrays_overlap(needs[f], F.col("_all"))

    demographic = F.arrays_overlap("features", F.lit(DEMOGRAPHIC))
    return chosen.withColumn("features", F.sort_array(F.filter("_all", kept))).select(
        *by,
        "features",
        F.size("features").alias("n_features"),
        ((F.size("features") >= MIN_FEATURES) & demographic).alias("valid"),
    )
