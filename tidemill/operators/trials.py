"""Experiment tables: runs, studies, trials, loss histories and model registries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemill.plans import (
    exact_quantiles,
    lookup_join,
    materialize,
    param_join,
    prefix_sum,
    previous,
    running,
)


def head(df: DataFrame, key: str, n: int = 5) -> DataFrame:
    return df.orderBy(key).limit(n)


def best_trial(trials: DataFrame, value: str, direction: str = "maximize") -> DataFrame:
    """Best trial per study; the earliest one among equals."""
    score = F.col(value) if direction == "maximize" else -F.col(value)
    best = F.max_by(F.struct("*"), F.struct(score, -F.col("trial")))
    return trials.groupBy("study").agg(best.alias("b")).select("b.*")


def running_best(trials: DataFrame, value: str) -> DataFrame:
    """Best value so far, in the order of the trials of each study."""
    return running(trials, "trial", {"best_so_far": ("max", value)}, ["study"])


def metric_rows(versions: DataFrame) -> DataFrame:
    """Long table (name, version, trained_at, stage, metric, value)."""
    return versions.select(
        "name", "version", "trained_at", "stage", F.explode("metrics").alias("metric", "value")
    )


def delta_prev(metrics: DataFrame) -> DataFrame:
    """Change of every metric from the version before, with a verdict."""
    change = F.col("value") - F.col("prev_value")
    verdict = F.when(change > 0, "improved").when(change < 0, "degraded").when(change == 0, "same")
    return (
        previous(metrics, "version", ["value"], ["name", "metric"])
        .withColumn("delta", change)
        .withColumn("verdict", verdict)
    )


def metric_trend(versions: DataFrame) -> DataFrame:
    return metric_rows(versions).select(
        "name",
        "metric",
        "version",
        "trained_at",
        "value",
        (F.col("stage") == "Production").alias("production"),
    ).orderBy("name", "metric", "version")


def loss_history(losses: DataFrame, interval: int) -> DataFrame:
    """Train and validation loss at every ``interval`` steps and at the last step."""
    last = losses.agg(F.max("step").alias("last"))
    shown = (F.col("step") % interval == 0) | (F.col("step") == last.scalar())
    return (
        losses.where(shown)
        .groupBy(F.col("step").alias("epoch"))
        .agg(
            F.avg(F.when(F.col("split") == "train", F.col("loss"))).alias("train_loss"),
            F.avg(F.when(F.col("split") == "val", F.col("loss"))).alias("val_loss"),
        )
    )


def retention_rank(versions: DataFrame, now: str, keep: int = 3, months: int = 6) -> DataFrame:
    """Keep the newest staging versions per model; archive the others and all old versions.

    Only the ``keep`` newest versions per model are ranked: the limit applies before the shuffle.
    """
    newest = W.partitionBy("name").orderBy(F.col("version").desc())
    staging = F.col("stage") == "Staging"
    border = (
        versions.where(staging)
        .select("name", "version")
        .withColumn("rank", F.row_number().over(newest))
        .where(F.col("rank") <= keep)
        .groupBy("name")
        .agg(F.min("version").alias("oldest_kept"))
    )
    oldest = F.lit(now).cast("timestamp_ntz") - F.expr(f"INTERVAL {months} MONTHS")
    action = (
        F.when(F.col("stage") == "Production", "keep")
        .when(F.col("trained_at") < oldest, "archive")
        .when(staging & (F.col("version") >= F.col("oldest_kept")), "keep")
        .otherwise("archive")
    )
    return param_join(versions, border, ["name"]).withColumn("action", action).drop("oldest_kept")


def current_production(versions: DataFrame) -> DataFrame:
    """Latest production version per model and the one to fall back to."""
    newest = W.partitionBy("name").orderBy(F.col("version").desc())
    top = (
        versions.where(F.col("stage") == "Production")
        .select("name", "version")
        .withColumn("rank", F.row_number().over(newest))
        .where(F.col("rank") <= 2)
    )
    return top.groupBy("name").agg(
        F.max(F.when(F.col("rank") == 1, F.col("version"))).alias("production_version"),
        F.max(F.when(F.col("rank") == 2, F.col("version"))).alias("fallback_version"),
    )


def runs_table(runs: DataFrame, params: Sequence[str], metrics: Sequence[str], *keep: str) -> DataFrame:
    """Parameter and metric maps as plain columns."""
    return runs.select(
        *keep,
        *[F.col("params")[p].alias(f"param_{p}") for p in params],
        *[F.col("metrics")[m].alias(f"metric_{m}") for m in metrics],
    )


def _mid_ranks(trials: DataFrame, column: str, out: str) -> DataFrame:
    """Average rank of each value within its study, from counts of distinct values."""
    counts = materialize(trials.groupBy("study", column).agg(F.count(F.lit(1)).alias("n")), "ranks")
    summed = prefix_sum(counts, column, ["n"], ["study"])
    rank = F.col("cum_n") - (F.col("n") - 1) / 2
    return materialize(summed.select("study", column, rank.alias(out)), "ranks")


def param_importance(trials: DataFrame, params: Sequence[str], value: str) -> DataFrame:
    """Absolute Spearman correlation of each parameter with the objective, per study."""
    ranked = lookup_join(trials, _mid_ranks(trials, value, "_rank_value"), ["study", value])
    for p in params:
        ranked = lookup_join(ranked, _mid_ranks(trials, p, f"_rank_{p}"), ["study", p])
    wide = ranked.groupBy("study").agg(
        *[F.abs(F.corr(f"_rank_{p}", "_rank_value")).alias(p) for p in params]
    )
    return wide.unpivot("study", list(params), "param", "importance")


def _bin(column: str, width: float) -> Column:
    return F.floor(F.col(column) / width).cast("int")


def slice_effect(trials: DataFrame, param: str, width: float, value: str) -> DataFrame:
    return trials.groupBy("study", _bin(param, width).alias("bin")).agg(
        F.avg(value).alias("mean"), F.max(value).alias("best"), F.count(F.lit(1)).alias("n")
    )


def contour_effect(trials: DataFrame, params: dict[str, float], value: str) -> DataFrame:
    """Mean and best objective over the grid of two binned parameters, given their bin widths."""
    bins = [_bin(p, w).alias(f"{p}_bin") for p, w in params.items()]
    return trials.groupBy("study", *bins).agg(
        F.avg(value).alias("mean"), F.max(value).alias("best"), F.count(F.lit(1)).alias("n")
    )


def pareto_front(trials: DataFrame, gain: str, cost: str) -> DataFrame:
    """Trials that no other trial of the study beats in both objectives.

    A cost level survives if its best gain exceeds the best gain of all cheaper levels.
    """
    levels = materialize(trials.groupBy("study", cost).agg(F.max(gain).alias(gain)), "levels")
    beaten = running(levels, cost, {"_cheaper": ("max", gain)}, ["study"], inclusive=False)
    front = beaten.where(F.col("_cheaper").isNull() | (F.col(gain) > F.col("_cheaper")))
    return param_join(trials, front.drop("_cheaper"), ["study", cost, gain], "inner")


def median_prune(steps: DataFrame, warmup: int) -> DataFrame:
    """First step, after the warm-up, at which a trial is below the median of its study."""
    medians = exact_quantiles(steps, "value", [0.5], ["median"], ["study", "step"])
    medians = materialize(medians, "medians")
    late = steps.where(F.col("step") > warmup)
    return (
        lookup_join(late, medians, ["study", "step"])
        .where(F.col("value") < F.col("median"))
        .groupBy("study", "trial")
        .agg(F.min("step").alias("pruned_at"))
    )
