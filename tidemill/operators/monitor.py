"""Monitoring of request logs: rates, latency, alerts, drift and A/B comparisons."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemill.functions.hashing import hash_bucket
from tidemill.plans import exact_quantiles, materialize, prefix_sum
from tidemill.plans.ordered import micros

# Alert limits.
ERROR_SHARE = 0.05
ERRORS_PER_MINUTE = 10
LATENCY_MS = 500.0
SIGNIFICANT_Z = 1.96


def _windowed(log: DataFrame, width: str) -> DataFrame:
    return log.withColumn("window_start", F.window("ts", width).start)


def latency_percentiles(
    log: DataFrame, width: str, by: Sequence[str] = ("model_version",), method: str = "exact"
) -> DataFrame:
    """p50, p95 and p99 per window and group; ``method='approx'`` for streams and dashboards."""
    keys, probs = ["window_start", *by], [0.5, 0.95, 0.99]
    rows = _windowed(log, width)
    if method == "approx":
        cut = F.percentile_approx("latency_ms", probs, 10_000)
        return rows.groupBy(*keys).agg(cut.alias("p")).select(
            *keys, *[F.col("p")[i].alias(n) for i, n in enumerate(("p50", "p95", "p99"))]
        )
    return exact_quantiles(rows, "latency_ms", probs, ["p50", "p95", "p99"], keys)


SKETCH_K = 800  # size of a sketch: ranks are right within about half a percent


def sketched(value: str) -> list[Column]:
    """Count and KLL sketch of a numeric column, for streams and for tables that are merged later."""
    return [F.count(value).alias("n"), F.kll_sketch_agg_double(F.col(value).cast("double"), F.lit(SKETCH_K)).alias("sketch")]


def merged_sketches(sketches: DataFrame, width: str, by: Sequence[str] = ("model_version",)) -> DataFrame:
    """Sketches ``(window_start, by, n, sketch)`` of short windows merged to those of longer ones."""
    wide = sketches.withColumn("window_start", F.window("window_start", width).start)
    return wide.groupBy("window_start", *by).agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch", SKETCH_K).alias("sketch"))


def sketch_percentiles(sketches: DataFrame) -> DataFrame:
    """p50, p95 and p99 in place of the sketch."""
    cuts = [F.kll_sketch_get_quantile_double("sketch", F.lit(p)).alias(name) for name, p in (("p50", 0.5), ("p95", 0.95), ("p99", 0.99))]
    return sketches.select(*[c for c in sketches.columns if c != "sketch"], *cuts)


def request_rate(log: DataFrame, width: str = "1 minute") -> DataFrame:
    return (
        _windowed(log, width)
        .groupBy("window_start")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.avg((F.col("status") < 500).cast("int")).alias("success_rate"),
        )
    )


def error_rates(log: DataFrame, width: str) -> DataFrame:
    failed = F.col("status") >= 500
    return (
        _windowed(log, width)
        .groupBy("window_start")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count_if(failed).alias("errors"),
            F.avg(failed.cast("int")).alias("error_rate"),
        )
    )


def error_rate_alert(log: DataFrame, width: str, limit: float = ERROR_SHARE) -> DataFrame:
    return error_rates(log, width).where(F.col("error_rate") > limit)


def error_count_alert(log: DataFrame, width: str = "1 minute", limit: int = ERRORS_PER_MINUTE) -> DataFrame:
    return error_rates(log, width).where(F.col("errors") > limit).select("window_start", "errors")


def latency_alert(log: DataFrame, width: str, limit: float = LATENCY_MS) -> DataFrame:
    """Windows whose 95th percentile is above the limit."""
    return (
        latency_percentiles(log, width, by=()).where(F.col("p95") > limit).select("window_start", "p95")
    )


def confidence_avg(log: DataFrame, width: str) -> DataFrame:
    return (
        _windowed(log, width)
        .groupBy("window_start", "model_version")
        .agg(F.avg("confidence").alias("confidence"), F.count(F.lit(1)).alias("n"))
    )


def sustained_alert(samples: DataFrame, width: str, limit: float, at_least: int) -> DataFrame:
    """Runs of at least ``at_least`` consecutive windows whose mean value is above ``limit``.

    ``samples`` is (resource, ts, value). Only window means are ordered; a missing window ends a run.
    """
    step = F.expr(f"timestampdiff(MICROSECOND, window_start, window_start + INTERVAL {width})")
    means = (
        _windowed(samples, width)
        .groupBy("resource", "window_start")
        .agg(F.avg("value").alias("value"))
        .where(F.col("value") > limit)
    )
    order = W.partitionBy("resource").orderBy("window_start")
    slot = (micros(F.col("window_start")) / step).cast("bigint")
    runs = means.withColumn("_run", slot - F.row_number().over(order))
    return (
        runs.groupBy("resource", "_run")
        .agg(
            F.min("window_start").alias("run_start"),
            F.max("window_start").alias("run_end"),
            F.count(F.lit(1)).alias("n_windows"),
            F.max("value").alias("peak"),
        )
        .where(F.col("n_windows") >= at_least)
        .drop("_run")
    )


def feature_drift(reference: DataFrame, current: DataFrame, value: str, bins: int = 10) -> DataFrame:
    """Population stability index over reference quantile bins, and the largest CDF difference."""
    probs = [i / bins for i in range(1, bins)]
    names = [f"c{i}" for i in range(1, bins)]
    cuts = exact_quantiles(reference, value, probs, names).first()
    edges = [cuts[n] for n in names]
    both = reference.select(F.col(value).alias("v"), F.lit(1).alias("a"), F.lit(0).alias("b")).unionAll(
        current.select(F.col(value).alias("v"), F.lit(0).alias("a"), F.lit(1).alias("b"))
    )
    counted = materialize(
        both.where(F.col("v").isNotNull())
        .groupBy(F.col("v").cast("double").alias("v"))
        .agg(F.sum("a").alias("a"), F.sum("b").alias("b")),
        "drift",
    )
    totals = counted.agg(F.sum("a").alias("a"), F.sum("b").alias("b")).first()
    part = F.size(F.filter(F.lit(edges), lambda e: e < F.col("v")))
    floor = F.lit(1e-6)
    expected = F.greatest(F.col("a") / F.lit(totals["a"]), floor)
    actual = F.greatest(F.col("b") / F.lit(totals["b"]), floor)
    psi = (
        counted.groupBy(part.alias("part"))
        .agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
        .agg(F.sum((actual - expected) * F.ln(actual / expected)).alias("psi"))
    )
    gap = F.abs(F.col("cum_a") / F.lit(totals["a"]) - F.col("cum_b") / F.lit(totals["b"]))
    ks = prefix_sum(counted, "v", ["a", "b"]).agg(F.max(gap).alias("ks"))
    return psi.select(F.lit(value).alias("feature"), "psi", ks.scalar().alias("ks"))


def ab_summary(log: DataFrame, key: str, outcome: str, seed: int = 42, share: int = 50) -> DataFrame:
    """Success rates of two arms split by id hash, and the two-proportion z statistic."""
    arm = hash_bucket(F.col(key), seed, 100) < share
    won = F.col(outcome) == 1
    sums = log.agg(
        F.count_if(arm).alias("n_a"),
        F.count_if(~arm).alias("n_b"),
        F.count_if(arm & won).alias("x_a"),
        F.count_if(~arm & won).alias("x_b"),
    )
    one = F.lit(1.0)
    pooled = F.try_divide(F.col("x_a") + F.col("x_b"), F.col("n_a") + F.col("n_b"))
    per_arm = F.try_divide(one, F.col("n_a")) + F.try_divide(one, F.col("n_b"))
    spread = F.sqrt(pooled * (1 - pooled) * per_arm)
    return (
        sums.withColumns(
            {
                "rate_a": F.try_divide("x_a", "n_a"),
                "rate_b": F.try_divide("x_b", "n_b"),
            }
        )
        .withColumn("z", F.try_divide(F.col("rate_b") - F.col("rate_a"), spread))
        .withColumn("significant", F.abs("z") >= SIGNIFICANT_Z)
    )


def retrain_trigger(versions: DataFrame, metric: str, better: float = 0.01, worse: float = 0.05) -> DataFrame:
    """Newest version against the production version of each model, with a decision."""
    score = F.col("metrics")[metric]
    live = F.col("stage") == "Production"
    pair = versions.groupBy("name").agg(
        F.max_by(F.struct("version", score.alias("m")), "version").alias("new"),
        F.max_by(F.when(live, F.struct("version", score.alias("m"))), F.when(live, F.col("version"))).alias(
            "live"
        ),
    )
    change = F.col("new.m") - F.col("live.m")
    decision = (
        F.when(change.isNull(), "no production model")
        .when(change >= better, "promote")
        .when(change <= -worse, "retrain")
        .otherwise("keep")
    )
    return pair.select(
        "name",
        F.col("new.version").alias("new_version"),
        F.col("live.version").alias("live_version"),
        change.alias("change"),
        decision.alias("decision"),
    )
