"""Feature lookups by entity and time, exports and model comparisons."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.plans import asof_fill, lookup_join, materialize, param_join


def feature_import(
    rows: DataFrame, mapping: dict[str, str], types: dict[str, str], entity: str, ts: str
) -> DataFrame:
    """Rename source columns to registered features and cast them to the registered types."""
    return rows.select(
        F.col(entity).cast("bigint").alias("entity_id"),
        F.col(ts).cast("timestamp_ntz").alias("feature_ts"),
        *[F.col(source).cast(types[name]).alias(name) for source, name in mapping.items()],
    )


def latest_features(values: DataFrame) -> DataFrame:
    """Last version per entity; merged inside each task first, so a busy entity is no hot spot."""
    names = [c for c in values.columns if c != "entity_id"]
    return (
        values.groupBy("entity_id")
        .agg(F.max_by(F.struct(*names), "feature_ts").alias("_v"))
        .select("entity_id", "_v.*")
    )


def feature_lookup(requests: DataFrame, values: DataFrame) -> DataFrame:
    """Latest features for every requested entity; unknown entities get nulls."""
    return lookup_join(requests, materialize(latest_features(values), "latest"), ["entity_id"])


def feature_asof(labels: DataFrame, values: DataFrame, ts: str = "label_ts") -> DataFrame:
    """Feature values as of each label time (a value of the same instant counts)."""
    features = [c for c in values.columns if c != "entity_id"]
    timeline = (
        values.withColumn(ts, F.col("feature_ts"))
        .withColumn("_tie", F.lit(0))
        .unionByName(labels.withColumn("_tie", F.lit(1)), allowMissingColumns=True)
    )
    timeline = materialize(timeline, "timeline")  # read three times
    filled = asof_fill(timeline, ["entity_id"], ts, "_tie", features)
    return filled.where(F.col("_tie") == 1).drop("_tie")


def feature_export(requests: DataFrame, values: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(features of the requested entities, requested entities without any)."""
    wanted = requests.select("entity_id").distinct()
    known = latest_features(values)
    return wanted.join(known, "entity_id"), wanted.join(known, "entity_id", "left_anti")


def compare_models(versions: DataFrame, metrics: Sequence[str], baseline: int = 1) -> DataFrame:
    """Metrics per version with the difference to the baseline version of the same model."""
    base = versions.where(F.col("version") == baseline).select(
        "name", *[F.col("metrics")[m].alias(f"_base_{m}") for m in metrics]
    )
    return param_join(versions, base, ["name"]).select(
        "name",
        "version",
        *[F.col("metrics")[m].alias(m) for m in metrics],
        *[(F.col("metrics")[m] - F.col(f"_base_{m}")).alias(f"{m}_delta") for m in metrics],
    )


def side_by_side(versions: DataFrame, metric: str, shown: Sequence[int]) -> DataFrame:
    """One row per model, one column per listed version."""
    return (
        versions.groupBy("name")
        .pivot("version", list(shown))
        .agg(F.first(F.col("metrics")[metric]))
        .select("name", *[F.col(str(v)).alias(f"v{v}") for v in shown])
    )
