"""Tabular feature preparation: ``fit_*`` on training rows, ``apply`` anywhere.

A fit yields a small parameter table. Applying it never shuffles the data: scalars enter as scalar
subqueries and grouped parameters as a size-checked broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, fields

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.functions.hashing import hash_bucket
from tidemill.plans import exact_quantiles, materialize, param_join
from tidemill.plans.ordered import ranked_ids

# Names and borders of the bins, and the final feature set.
FARE_BINS = ["cheap", "medium", "expensive", "very expensive"]
AGE_BINS = [(17, "Child"), (33, "Young Adult"), (49, "Adult")]
SENIOR = "Senior"
SCALED = ["age", "fare", "family_size"]
RARE = "Rare"
UNKNOWN_DECK = "Unknown"
SEED = 42


# --- splits ---------------------------------------------------------------------------------------


def split_random(df: DataFrame, key: str, train_percent: int = 80, seed: int = SEED) -> DataFrame:
    """Add ``split``; a row keeps its side whatever the partitioning."""
    side = F.when(hash_bucket(F.col(key), seed, 100) < train_percent, "train").otherwise("test")
    return df.withColumn("split", side)


def kfold(df: DataFrame, key: str, k: int = 5, seed: int = SEED) -> DataFrame:
    return df.withColumn("fold", hash_bucket(F.col(key), seed, k).cast("int"))


def train_rows(df: DataFrame, key: str, seed: int = SEED) -> DataFrame:
    return split_random(df, key, seed=seed).where(F.col("split") == "train").drop("split")


# --- missing values -------------------------------------------------------------------------------


def fit_median(train: DataFrame, value: str, by: Sequence[str] = (), method: str = "exact") -> DataFrame:
    """Median per group; ``method='approx'`` trades exactness for a single pass."""
    if method == "approx":
        return train.groupBy(*by).agg(F.percentile_approx(value, 0.5, 10_000).cast("double").alias("median"))
    return exact_quantiles(train, value, [0.5], ["median"], by)


def fit_medians(train: DataFrame, series: dict[str, tuple[str, Sequence[str]]]) -> DataFrame:
    """Several medians in one pass: ``{name: (value, by)}`` -> (series, k0, k1, ..., median)."""
    width = max(len(by) for _, by in series.values())

    def entry(name: str, value: str, by: Sequence[str]) -> Column:
        keys = [F.col(k).cast("string") for k in by] + [F.lit("")] * (width - len(by))
        named = [k.alias(f"k{i}") for i, k in enumerate(keys)]
        return F.struct(F.lit(name).alias("series"), *named, F.col(value).cast("double").alias("value"))

    entries = F.array(*[entry(name, value, by) for name, (value, by) in series.items()])
    long = train.select(F.explode(entries).alias("e")).select("e.*")
    return exact_quantiles(long, "value", [0.5], ["median"], ["series", *[f"k{i}" for i in range(width)]])


def pick_medians(medians: DataFrame, name: str, train: DataFrame, by: Sequence[str]) -> DataFrame:
    """The (by..., median) table of one series, with the key types of the training rows."""
    types = dict(train.dtypes)
    keys = [F.col(f"k{i}").cast(types[k]).alias(k) for i, k in enumerate(by)]
    return medians.where(F.col("series") == name).select(*keys, "median")


def impute_group_median(df: DataFrame, value: str, by: Sequence[str], groups: DataFrame, overall: DataFrame) -> DataFrame:
    """Fill by the median of the group, then by the overall median."""
    joined = param_join(df, groups, by)
    filled = F.coalesce(F.col(value), F.col("median"), overall.select("median").scalar())
    return joined.withColumn(value, filled).drop("median")


def fit_mean(train: DataFrame, value: str) -> DataFrame:
    return train.agg(F.avg(value).alias("mean"))


def impute_scalar(df: DataFrame, value: str, param: DataFrame) -> DataFrame:
    """Fill by the single value of a one-row, one-column table."""
    return df.withColumn(value, F.coalesce(F.col(value), param.scalar()))


def fit_mode(train: DataFrame, value: str) -> DataFrame:
    """Most frequent value; the smallest one among equals."""
    return (
        train.where(F.col(value).isNotNull())
        .groupBy(value)
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.col("n").desc(), F.col(value))
        .limit(1)
        .select(F.col(value).alias("mode"))
    )


def drop_null_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.na.drop(subset=list(columns))


def missing_flag(df: DataFrame, value: str) -> DataFrame:
    return df.withColumn(f"{value}_missing", F.col(value).isNull().cast("int"))


# --- derived columns ------------------------------------------------------------------------------


def has_cabin(df: DataFrame) -> DataFrame:
    return df.withColumn("has_cabin", F.col("cabin").isNotNull().cast("int"))


def deck(df: DataFrame) -> DataFrame:
    return df.withColumn("deck", F.coalesce(F.substring("cabin", 1, 1), F.lit(UNKNOWN_DECK)))


def family_size(df: DataFrame) -> DataFrame:
    return df.withColumn("family_size", F.col("sibsp") + F.col("parch") + 1)


def is_alone(df: DataFrame) -> DataFrame:
    return df.withColumn("is_alone", (F.col("sibsp") + F.col("parch") == 0).cast("int"))


def raw_title(df: DataFrame) -> DataFrame:
    return df.withColumn("title", F.regexp_extract("name", r",\s*([^.]+)\.", 1))


def fit_titles(train: DataFrame, min_share: float = 0.02) -> DataFrame:
    """Titles frequent enough to stand for themselves."""
    counts = raw_title(train).groupBy("title").agg(F.count(F.lit(1)).alias("n"))
    total = train.agg(F.count(F.lit(1)).alias("total"))
    return counts.where(F.col("n") >= F.lit(min_share) * total.scalar()).select("title")


def title(df: DataFrame, kept: DataFrame) -> DataFrame:
    joined = param_join(raw_title(df), kept.withColumn("_known", F.lit(True)), ["title"])
    named = F.when(F.col("_known"), F.col("title")).otherwise(RARE)
    return joined.withColumn("title", named).drop("_known")


def fit_fare_bins(train: DataFrame) -> DataFrame:
    return exact_quantiles(train, "fare", [0.25, 0.5, 0.75], ["q25", "q50", "q75"])


def fare_bins(df: DataFrame, cuts: DataFrame) -> DataFrame:
    """Quartile names, right-closed; null stays null."""
    fare, cuts = F.col("fare"), _local(cuts)
    q = {c: cuts.select(c).scalar() for c in ("q25", "q50", "q75")}
    name = (
        F.when(fare.isNull(), F.lit(None))
        .when(fare <= q["q25"], FARE_BINS[0])
        .when(fare <= q["q50"], FARE_BINS[1])
        .when(fare <= q["q75"], FARE_BINS[2])
        .otherwise(FARE_BINS[3])
    )
    return df.withColumn("fare_bin", name)


def age_bins(df: DataFrame) -> DataFrame:
    name = F.when(F.col("age").isNull(), F.lit(None))
    for below, label in AGE_BINS:
        name = name.when(F.col("age") < below, label)
    return df.withColumn("age_bin", name.otherwise(SENIOR))


# --- encoders and scaler --------------------------------------------------------------------------


def encode_binary(df: DataFrame, column: str = "sex", one: str = "male") -> DataFrame:
    return df.withColumn(column, F.when(F.col(column).isNotNull(), (F.col(column) == one).cast("int")))


def encode_ordinal(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(column, F.col(column).cast("int"))


def fit_categories(train: DataFrame, column: str) -> DataFrame:
    return train.where(F.col(column).isNotNull()).select(F.col(column).alias("category")).distinct()


def category_list(categories: DataFrame) -> list[str]:
    """Sorted categories, which become names of columns: as many as a table may have columns."""
    return [row["category"] for row in categories.orderBy("category").collect()]


def encode_onehot(df: DataFrame, column: str, categories: Sequence[str], drop_first: bool = False) -> DataFrame:
    """0/1 columns ``<column>_<category>``; a value unseen in the fit gives all zeros."""
    shown = list(categories)[1:] if drop_first else list(categories)
    flags = {
        f"{column}_{c}": F.coalesce((F.col(column) == c).cast("int"), F.lit(0)) for c in shown
    }
    return df.withColumns(flags)


def fit_labels(train: DataFrame, column: str) -> DataFrame:
    """(category, label): sorted categories numbered from 0, of any number."""
    return ranked_ids(fit_categories(train, column), "category", "label")


def encode_label(df: DataFrame, column: str, labels: DataFrame) -> DataFrame:
    renamed = labels.select(F.col("category").alias(column), F.col("label").alias(f"{column}_label"))
    return param_join(df, renamed, [column])


def fit_scaler(train: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Mean and population deviation of each column, one row in all."""
    return train.agg(
        *[F.avg(c).alias(f"{c}_mean") for c in columns],
        *[F.stddev_pop(c).alias(f"{c}_std") for c in columns],
    )


def scale_standard(df: DataFrame, columns: Sequence[str], scaler: DataFrame) -> DataFrame:
    def scaled(c: str) -> Column:
        std = scaler.select(F.when(F.col(f"{c}_std") == 0, 1.0).otherwise(F.col(f"{c}_std"))).scalar()
        return (F.col(c) - scaler.select(f"{c}_mean").scalar()) / std

    return df.withColumns({c: scaled(c) for c in columns})


# --- the whole preparation ------------------------------------------------------------------------


@dataclass(frozen=True)
class FeatureBundle:
    """Everything learned from the training rows."""

    age_median: DataFrame
    age_median_all: DataFrame
    fare_median: DataFrame
    fare_median_all: DataFrame
    embarked_mode: DataFrame
    titles: DataFrame
    title_categories: DataFrame
    embarked_categories: DataFrame
    scaler: DataFrame

    def save(self, path: str) -> None:
        for f in fields(self):
            getattr(self, f.name).write.mode("errorifexists").parquet(f"{path}/{f.name}")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> FeatureBundle:
        return cls(**{f.name: spark.read.parquet(f"{path}/{f.name}") for f in fields(cls)})


def _filled(df: DataFrame, b) -> DataFrame:
    df = is_alone(family_size(has_cabin(missing_flag(df, "age"))))
    df = impute_group_median(df, "age", ["pclass", "sex"], b["age_median"], b["age_median_all"])
    df = impute_group_median(df, "fare", ["pclass"], b["fare_median"], b["fare_median_all"])
    return title(impute_scalar(df, "embarked", b["embarked_mode"]), b["titles"])


def _local(df: DataFrame) -> DataFrame:
    """Write a fitted table so that later uses do not fit again."""
    return materialize(df, "fitted")


MEDIANS = {
    "age_median": ("age", ["pclass", "sex"]),
    "age_median_all": ("age", []),
    "fare_median": ("fare", ["pclass"]),
    "fare_median_all": ("fare", []),
}


def fit_features(train: DataFrame) -> FeatureBundle:
    medians = _local(fit_medians(train, MEDIANS))
    b = {name: pick_medians(medians, name, train, by) for name, (_, by) in MEDIANS.items()}
    b["embarked_mode"] = _local(fit_mode(train, "embarked"))
    b["titles"] = _local(fit_titles(train))
    filled = _filled(train, b)
    return FeatureBundle(
        **b,
        title_categories=_local(fit_categories(filled, "title")),
        embarked_categories=_local(fit_categories(filled, "embarked")),
        scaler=_local(fit_scaler(filled, SCALED)),
    )


def apply_features(df: DataFrame, bundle: FeatureBundle, drop_first: bool = False) -> DataFrame:
    """Rows -> id, label and the model-ready numeric columns."""
    b = {f.name: getattr(bundle, f.name) for f in fields(bundle)}
    out = encode_ordinal(encode_binary(_filled(df, b)), "pclass")
    shown: list[str] = []
    for column in ("embarked", "title"):
        names = category_list(b[f"{column}_categories"])
        out = encode_onehot(out, column, names, drop_first)
        shown += [f"{column}_{n}" for n in (names[1:] if drop_first else names)]
    out = scale_standard(out, SCALED, b["scaler"])
    flags = ["sex", "is_alone", "has_cabin", "age_missing"]
    return out.select("passenger_id", "survived", *SCALED, "pclass", *flags, *shown)


# --- leakage and skew -----------------------------------------------------------------------------


def leakage_check(train: DataFrame, test: DataFrame, key: str, features: Sequence[str]) -> DataFrame:
    """How many ids, and how many distinct feature rows, occur on both sides."""

    def shared(columns: Sequence[str], what: str) -> DataFrame:
        sides = train.select(*columns, F.lit(1).alias("a"), F.lit(0).alias("b")).unionAll(
            test.select(*columns, F.lit(0).alias("a"), F.lit(1).alias("b"))
        )
        met = sides.groupBy(*columns).agg(F.max("a").alias("a"), F.max("b").alias("b"))
        return met.agg(
            F.count_if((F.col("a") == 1) & (F.col("b") == 1)).alias("shared")
        ).select(F.lit(what).alias("kind"), "shared")

    return shared([key], "id").unionAll(shared(features, "features"))


def train_serve_skew(train: DataFrame, serve: DataFrame, key: str) -> DataFrame:
    """Per column: differing values on common ids, and whether names and types agree."""
    left, right = dict(train.dtypes), dict(serve.dtypes)
    names = sorted((set(left) | set(right)) - {key})
    common = [c for c in names if c in left and c in right]
    both = train.select(key, *[F.col(c).alias(f"l_{c}") for c in common], F.lit(1).alias("_l")).join(
        serve.select(key, *[F.col(c).alias(f"r_{c}") for c in common], F.lit(1).alias("_r")),
        key,
        "full_outer",
    )
    matched = F.col("_l").isNotNull() & F.col("_r").isNotNull()

    def differing(c: str) -> Column:
        if c not in common:
            return F.lit(None).cast("bigint")
        return F.count_if(matched & ~F.col(f"l_{c}").eqNullSafe(F.col(f"r_{c}")))

    wide = both.agg(
        F.count_if(F.col("_r").isNull()).alias("only_train"),
        F.count_if(F.col("_l").isNull()).alias("only_serve"),
        *[differing(c).alias(f"d_{c}") for c in names],
    )
    entries = [
        F.struct(
            F.lit(c).alias("column"),
            F.lit(left.get(c) == right.get(c)).alias("same_type"),
            F.col(f"d_{c}").alias("n_diff"),
            F.col("only_train"),
            F.col("only_serve"),
        )
        for c in names
    ]
    return wide.select(F.explode(F.array(*entries)).alias("r")).select("r.*")
