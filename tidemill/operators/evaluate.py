"""Ranking, probability and threshold metrics of binary predictions ``(label, score)``.

Scores are counted per distinct value before anything is ordered, so ties and hot scores collapse;
cumulative counts come from the range-wise prefix sum.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemill.plans import materialize, prefix_sum

CLIP = 1e-15


def _ratio(a: Column, b: Column) -> Column:
    """a / b with 0/0 = 0."""
    return F.when(b != 0, a / b).otherwise(F.lit(0.0))


def score_counts(predictions: DataFrame) -> DataFrame:
    """Positives and negatives per distinct score, written once: every curve reads it repeatedly."""
    label = F.col("label")
    counted = predictions.groupBy(F.col("score").cast("double").alias("score")).agg(
        F.count_if(label == 1).alias("pos"), F.count_if(label != 1).alias("neg")
    )
    return materialize(counted, "scores")


def cumulative(counts: DataFrame) -> DataFrame:
    """Counts at or above each score, with the totals ``p_all`` and ``n_all``."""
    totals = counts.agg(F.sum("pos").alias("p"), F.sum("neg").alias("n")).first()
    summed = prefix_sum(counts, "score", ["pos", "neg"], descending=True)
    return summed.withColumns(
        {"p_all": F.lit(totals["p"] or 0), "n_all": F.lit(totals["n"] or 0)}
    )


def confusion_matrix(predictions: DataFrame, threshold: float = 0.5) -> DataFrame:
    positive, guess = F.col("label") == 1, F.col("score") >= threshold
    cells = {
        "tp": positive & guess,
        "tn": ~positive & ~guess,
        "fp": ~positive & guess,
        "fn": positive & ~guess,
    }
    counts = predictions.agg(
        F.count(F.lit(1)).alias("n"), *[F.count_if(c).alias(k) for k, c in cells.items()]
    )
    return counts.withColumns(
        {f"{k}_pct": _ratio(F.col(k) * 100, F.col("n")) for k in cells}
    )


def classification_metrics(
    predictions: DataFrame, threshold: float = 0.5, beta: float = 2.0
) -> DataFrame:
    tp, tn, fp, fn = (F.col(c) for c in ("tp", "tn", "fp", "fn"))
    precision, recall = F.col("precision"), F.col("recall")
    weight = F.lit(beta * beta)
    return (
        confusion_matrix(predictions, threshold)
        .select(
            _ratio(tp + tn, F.col("n")).alias("accuracy"),
            _ratio(tp, tp + fp).alias("precision"),
            _ratio(tp, tp + fn).alias("recall"),
            _ratio(tn, tn + fp).alias("specificity"),
        )
        .withColumns(
            {
                "balanced_accuracy": (recall + F.col("specificity")) / 2,
                "f1": _ratio(2 * precision * recall, precision + recall),
                "f_beta": _ratio((1 + weight) * precision * recall, weight * precision + recall),
            }
        )
    )


def roc_curve(predictions: DataFrame) -> DataFrame:
    return cumulative(score_counts(predictions)).select(
        F.col("score").alias("threshold"),
        _ratio(F.col("cum_neg"), F.col("n_all")).alias("fpr"),
        _ratio(F.col("cum_pos"), F.col("p_all")).alias("tpr"),
    )


def auc_roc(predictions: DataFrame) -> DataFrame:
    """Probability that a positive outranks a negative, ties counting half; null for one class."""
    beaten = F.col("n_all") - F.col("cum_neg") + F.col("neg") / 2
    return cumulative(score_counts(predictions)).agg(
        F.try_divide(
            F.sum(F.col("pos") * beaten),
            F.max("p_all").cast("double") * F.max("n_all").cast("double"),
        ).alias("auc_roc")
    )


def auc_roc_by(predictions: DataFrame, by: str) -> DataFrame:
    """``(by, n, auc_roc)``: the same for each group, whose scores are cut into ranges, not gathered."""
    label = F.col("label")
    counted = predictions.groupBy(by, F.col("score").cast("double").alias("score")).agg(
        F.count_if(label == 1).alias("pos"), F.count_if(label != 1).alias("neg")
    )
    summed = prefix_sum(materialize(counted, "scores"), "score", ["neg"], by=[by])
    won = F.sum(F.col("pos") * (F.col("cum_neg") - F.col("neg") / 2))
    pairs = F.sum("pos").cast("double") * F.sum("neg").cast("double")
    return summed.groupBy(by).agg(F.sum(F.col("pos") + F.col("neg")).alias("n"), F.try_divide(won, pairs).alias("auc_roc"))


def pr_curve(predictions: DataFrame) -> DataFrame:
    return cumulative(score_counts(predictions)).select(
        F.col("score").alias("threshold"),
        _ratio(F.col("cum_pos"), F.col("cum_pos") + F.col("cum_neg")).alias("precision"),
        _ratio(F.col("cum_pos"), F.col("p_all")).alias("recall"),
    )


def auc_pr(predictions: DataFrame) -> DataFrame:
    """Average precision: each score adds its share of the positives times its precision."""
    precision = _ratio(F.col("cum_pos"), F.col("cum_pos") + F.col("cum_neg"))
    return cumulative(score_counts(predictions)).agg(
        F.sum(_ratio(F.col("pos"), F.col("p_all")) * precision).alias("auc_pr")
    )


def optimal_threshold(predictions: DataFrame) -> DataFrame:
    """Threshold with the largest tpr - fpr; the highest one among equals."""
    gain = F.round(F.col("tpr") - F.col("fpr"), 12)
    best = F.max_by(
        F.struct("threshold", "tpr", "fpr", gain.alias("youden")), F.struct(gain, "threshold")
    )
    return roc_curve(predictions).agg(best.alias("b")).select("b.*")


def log_loss(predictions: DataFrame) -> DataFrame:
    p = F.least(F.lit(1 - CLIP), F.greatest(F.lit(CLIP), F.col("score")))
    loss = -F.when(F.col("label") == 1, F.ln(p)).otherwise(F.ln(1 - p))
    return predictions.agg(F.avg(loss).alias("log_loss"))


def brier(predictions: DataFrame) -> DataFrame:
    return predictions.agg(F.avg(F.pow(F.col("score") - F.col("label"), F.lit(2.0))).alias("brier"))


def calibration(predictions: DataFrame, bins: int = 10) -> DataFrame:
    at = F.least(F.lit(bins - 1), F.floor(F.col("score") * bins)).cast("int")
    return predictions.groupBy(at.alias("bin")).agg(
        F.avg("score").alias("mean_score"),
        F.avg("label").alias("positive_rate"),
        F.count(F.lit(1)).alias("n"),
    )


def lift_curve(predictions: DataFrame, parts: int = 10) -> DataFrame:
    """Lift and cumulative gain per score part, best scores first; equal scores stay together."""
    size = F.col("p_all") + F.col("n_all")
    above = F.col("cum_pos") + F.col("cum_neg") - F.col("pos") - F.col("neg")
    part = (F.floor(above * parts / size) + 1).cast("int")
    grouped = (
        cumulative(score_counts(predictions))
        .groupBy(part.alias("part"))
        .agg(
            F.sum(F.col("pos") + F.col("neg")).alias("n"),
            F.sum("pos").alias("positives"),
            F.max("cum_pos").alias("_cum"),
            F.max("p_all").alias("_p"),
            F.max(size).alias("_size"),
        )
    )
    return grouped.select(
        "part",
        "n",
        "positives",
        _ratio(F.col("positives") / F.col("n"), F.col("_p") / F.col("_size")).alias("lift"),
        _ratio(F.col("_cum"), F.col("_p")).alias("gain"),
    )


def cost_benefit(predictions: DataFrame, values: dict[str, float], threshold: float = 0.5) -> DataFrame:
    """Total and mean value of the decisions, given the value of each confusion cell."""
    total = sum((F.col(k) * F.lit(float(v)) for k, v in values.items()), F.lit(0.0))
    return confusion_matrix(predictions, threshold).select(
        total.alias("total_value"), _ratio(total, F.col("n")).alias("mean_value")
    )


def prediction_rate(predictions: DataFrame, train: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Predicted positive share next to the positive share of the training labels."""
    guessed = predictions.agg(F.avg((F.col("score") >= threshold).cast("int")).alias("predicted_rate"))
    known = train.agg(F.avg("label").alias("rate"))
    return guessed.withColumn("train_rate", known.scalar()).withColumn(
        "difference", F.col("predicted_rate") - F.col("train_rate")
    )


def slice_metrics(rows: DataFrame, slices: dict[str, Column]) -> DataFrame:
    """Mean score and label per named, possibly overlapping slice."""
    names = F.array_compact(F.array(*[F.when(cond, F.lit(k)) for k, cond in slices.items()]))
    return (
        rows.withColumn("slice", F.explode(names))
        .groupBy("slice")
        .agg(
            F.avg("score").alias("mean_score"),
            F.avg("label").alias("positive_rate"),
            F.count(F.lit(1)).alias("n"),
        )
    )


def top_features(attributions: DataFrame, key: str, k: int = 5) -> DataFrame:
    """The k strongest attributions of every row; a row has one entry per feature."""
    best = W.partitionBy(key).orderBy(F.abs("value").desc(), "feature")
    return attributions.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def top_features_overall(attributions: DataFrame, k: int = 10) -> DataFrame:
    """The k features with the largest mean absolute attribution."""
    return (
        attributions.groupBy("feature")
        .agg(F.avg(F.abs("value")).alias("importance"))
        .orderBy(F.col("importance").desc(), "feature")
        .limit(k)
    )
