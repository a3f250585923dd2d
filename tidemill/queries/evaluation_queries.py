"""Named queries on predictions, request logs and model versions."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.functions.hashing import hash_bucket
from tidemill.operators import boosting
from tidemill.operators import evaluate as ev
from tidemill.operators import features as ft
from tidemill.operators import models as mo
from tidemill.operators import monitor as mn
from tidemill.operators.boosting import Booster, TreeParams
from tidemill.operators.features import split_random, train_rows
from tidemill.plans.scratch import materialize, scratch_path
from tidemill.queries import checks as sql
from tidemill.queries.registry import query, r
from tidemill.sources import views

DAY = "1 day"


def _pred(spark, folder) -> DataFrame:
    return views.predictions(spark, folder)


def _log(spark, folder) -> DataFrame:
    return views.request_log(spark, folder)


CELLS = f"""{sql.PREDICTIONS},
cells AS (SELECT count(*) AS n, count(*) FILTER (label = 1 AND score >= 0.5) AS tp,
  count(*) FILTER (label = 0 AND score < 0.5) AS tn, count(*) FILTER (label = 0 AND score >= 0.5) AS fp,
  count(*) FILTER (label = 1 AND score < 0.5) AS fn FROM predictions)"""


@query(
    "confusion_matrix",
    f"""WITH {CELLS}
SELECT n, tp, tn, fp, fn, round(100 * tp / n, 6) AS tp_pct, round(100 * tn / n, 6) AS tn_pct,
  round(100 * fp / n, 6) AS fp_pct, round(100 * fn / n, 6) AS fn_pct FROM cells""",
)
def confusion_matrix(spark, folder):
    out = ev.confusion_matrix(_pred(spark, folder))
    return out.withColumns({c: F.round(c, 6) for c in out.columns if c.endswith("_pct")})


@query(
    "classification_metrics",
    f"""WITH {CELLS},
m AS (SELECT (tp + tn) / n AS accuracy, tp / (tp + fp) AS p, tp / (tp + fn) AS c, tn / (tn + fp) AS s FROM cells)
SELECT round(accuracy, 6) AS accuracy, round(p, 6) AS precision, round(c, 6) AS recall, round(s, 6) AS specificity,
  round((c + s) / 2, 6) AS balanced_accuracy, round(2 * p * c / (p + c), 6) AS f1,
  round(5 * p * c / (4 * p + c), 6) AS f_beta FROM m""",
)
def classification_metrics(spark, folder):
    out = ev.classification_metrics(_pred(spark, folder))
    return out.select(*[r(c) for c in out.columns])


CURVE = f"""{sql.PREDICTIONS},
by_score AS (SELECT score, count(*) FILTER (label = 1) AS pos, count(*) FILTER (label = 0) AS neg
FROM predictions GROUP BY score),
curve AS (SELECT *, sum(pos) OVER w AS cp, sum(neg) OVER w AS cn, sum(pos) OVER () AS p, sum(neg) OVER () AS n
FROM by_score WINDOW w AS (ORDER BY score DESC))"""


@query(
    "roc_curve",
    f"WITH {CURVE} SELECT score AS threshold, round(cn / n, 9) AS fpr, round(cp / p, 9) AS tpr FROM curve",
)
def roc_curve(spark, folder):
    return ev.roc_curve(_pred(spark, folder)).select("threshold", r("fpr", 9), r("tpr", 9))


@query(
    "auc_roc",
    f"""WITH {sql.PREDICTIONS},
ranked AS (SELECT label, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0::DOUBLE AS mid
FROM predictions)
SELECT round((sum(mid) FILTER (label = 1) - count(*) FILTER (label = 1) * (count(*) FILTER (label = 1) + 1) / 2)
  / (count(*) FILTER (label = 1) * count(*) FILTER (label = 0)), 9) AS auc_roc FROM ranked""",
)
def auc_roc(spark, folder):
    return ev.auc_roc(_pred(spark, folder)).select(r("auc_roc", 9))


@query(
    "pr_curve",
    f"""WITH {CURVE}
SELECT score AS threshold, round(cp / (cp + cn), 9) AS precision, round(cp / p, 9) AS recall FROM curve""",
)
def pr_curve(spark, folder):
    return ev.pr_curve(_pred(spark, folder)).select("threshold", r("precision", 9), r("recall", 9))


@query(
    "auc_pr",
    f"""WITH {CURVE},
steps AS (SELECT cp / (cp + cn) AS precision, cp / p AS recall, lag(cp / p, 1, 0) OVER (ORDER BY score DESC) AS before
FROM curve)
SELECT round(sum((recall - before) * precision), 9) AS auc_pr FROM steps""",
)
def auc_pr(spark, folder):
    return ev.auc_pr(_pred(spark, folder)).select(r("auc_pr", 9))


@query(
    "optimal_threshold",
    f"""WITH {CURVE}
SELECT score AS threshold, round(cp / p, 9) AS tpr, round(cn / n, 9) AS fpr, round(cp / p - cn / n, 9) AS youden
FROM curve ORDER BY round(cp / p - cn / n, 12) DESC, score DESC LIMIT 1""",
)
def optimal_threshold(spark, folder):
    return ev.optimal_threshold(_pred(spark, folder)).select(
        "threshold", r("tpr", 9), r("fpr", 9), r("youden", 9)
    )


@query(
    "log_loss",
    f"""WITH {sql.PREDICTIONS},
p AS (SELECT label, least(1 - 1e-15::DOUBLE, greatest(1e-15::DOUBLE, score)) AS q FROM predictions)
SELECT round(avg(-CASE WHEN label = 1 THEN ln(q) ELSE ln(1 - q) END), 6) AS log_loss FROM p""",
)
def log_loss(spark, folder):
    return ev.log_loss(_pred(spark, folder)).select(r("log_loss"))


@query(
    "brier",
    f"WITH {sql.PREDICTIONS} SELECT round(avg((score - label) * (score - label)), 6) AS brier FROM predictions",
)
def brier(spark, folder):
    return ev.brier(_pred(spark, folder)).select(r("brier"))


@query(
    "calibration",
    f"""WITH {sql.PREDICTIONS}
SELECT CAST(least(9, floor(score * 10)) AS INT) AS bin, round(avg(score), 6) AS mean_score,
  round(avg(label), 6) AS positive_rate, count(*) AS n FROM predictions GROUP BY 1""",
)
def calibration(spark, folder):
    return ev.calibration(_pred(spark, folder)).select("bin", r("mean_score"), r("positive_rate"), "n")


@query(
    "lift_curve",
    f"""WITH {CURVE},
parts AS (SELECT *, CAST((cp + cn - pos - neg) * 10 // (p + n) + 1 AS INT) AS part FROM curve)
SELECT part, CAST(sum(pos + neg) AS BIGINT) AS n, CAST(sum(pos) AS BIGINT) AS positives,
  round(sum(pos) / sum(pos + neg) / (max(p) / max(p + n)), 6) AS lift, round(max(cp) / max(p), 6) AS gain
FROM parts GROUP BY part""",
)
def lift_curve(spark, folder):
    return ev.lift_curve(_pred(spark, folder)).select("part", "n", "positives", r("lift"), r("gain"))


@query(
    "cost_benefit",
    f"""WITH {CELLS}
SELECT round(tp * 10.0::DOUBLE - fp * 4 - fn * 6 + tn, 6) AS total_value,
  round((tp * 10.0::DOUBLE - fp * 4 - fn * 6 + tn) / n, 6) AS mean_value FROM cells""",
)
def cost_benefit(spark, folder):
    values = {"tp": 10.0, "tn": 1.0, "fp": -4.0, "fn": -6.0}
    return ev.cost_benefit(_pred(spark, folder), values).select(r("total_value"), r("mean_value"))


@query(
    "prediction_rate",
    f"""WITH {sql.PREDICTIONS},
a AS (SELECT avg(CASE WHEN score >= 0.5 THEN 1 ELSE 0 END) AS predicted_rate FROM predictions),
b AS (SELECT avg(label) AS train_rate FROM predictions WHERE {sql.bucket("passenger_id", 42, 100)} < 80)
SELECT round(predicted_rate, 6) AS predicted_rate, round(train_rate, 6) AS train_rate,
  round(predicted_rate - train_rate, 6) + 0.0 AS difference FROM a, b""",
)
def prediction_rate(spark, folder):
    rows = _pred(spark, folder)
    out = ev.prediction_rate(rows, train_rows(rows, "passenger_id"))
    return out.select(r("predicted_rate"), r("train_rate"), r("difference"))


@query(
    "slice_metrics",
    f"""WITH {sql.PASSENGERS}, {sql.PREDICTIONS},
rows AS (SELECT * FROM passengers JOIN predictions USING (passenger_id)),
sliced AS (
SELECT 'female first class' AS slice, score, label FROM rows WHERE sex = 'female' AND pclass = 1
UNION ALL SELECT 'male third class', score, label FROM rows WHERE sex = 'male' AND pclass = 3
UNION ALL SELECT 'child', score, label FROM rows WHERE age < 16
UNION ALL SELECT 'large family', score, label FROM rows WHERE sibsp + parch + 1 >= 7)
SELECT slice, round(avg(score), 6) AS mean_score, round(avg(label), 6) AS positive_rate, count(*) AS n
FROM sliced GROUP BY slice""",
)
def slice_metrics(spark, folder):
    rows = views.passengers(spark, folder).join(_pred(spark, folder), "passenger_id")
    slices = {
        "female first class": (F.col("sex") == "female") & (F.col("pclass") == 1),
        "male third class": (F.col("sex") == "male") & (F.col("pclass") == 3),
        "child": F.col("age") < 16,
        "large family": F.col("sibsp") + F.col("parch") + 1 >= 7,
    }
    return ev.slice_metrics(rows, slices).select("slice", r("mean_score"), r("positive_rate"), "n")


# --- monitoring -----------------------------------------------------------------------------------


@query(
    "latency_percentiles",
    f"""WITH {sql.REQUEST_LOG}
SELECT time_bucket(INTERVAL 1 DAY, ts) AS window_start, model_version, round(quantile_cont(latency_ms, 0.5), 6) AS p50,
  round(quantile_cont(latency_ms, 0.95), 6) AS p95, round(quantile_cont(latency_ms, 0.99), 6) AS p99
FROM request_log GROUP BY ALL""",
)
def latency_percentiles(spark, folder):
    return mn.latency_percentiles(_log(spark, folder), DAY).select(
        "window_start", "model_version", r("p50"), r("p95"), r("p99")
    )


@query(
    "error_rate_alert",
    f"""WITH {sql.REQUEST_LOG}
SELECT time_bucket(INTERVAL 1 DAY, ts) AS window_start, count(*) AS n, count(*) FILTER (status >= 500) AS errors,
  round(avg(CASE WHEN status >= 500 THEN 1 ELSE 0 END), 6) AS error_rate
FROM request_log GROUP BY 1 HAVING avg(CASE WHEN status >= 500 THEN 1 ELSE 0 END) > 0.05::DOUBLE""",
)
def error_rate_alert(spark, folder):
    return mn.error_rate_alert(_log(spark, folder), DAY).withColumn("error_rate", r("error_rate"))


@query(
    "error_count_alert",
    f"""WITH {sql.REQUEST_LOG}
SELECT time_bucket(INTERVAL 6 HOUR, ts) AS window_start, count(*) AS errors FROM request_log
WHERE status >= 500 GROUP BY 1 HAVING count(*) > 10""",
)
def error_count_alert(spark, folder):
    return mn.error_count_alert(_log(spark, folder), "6 hours")


@query(
    "latency_alert",
    f"""WITH {sql.REQUEST_LOG}
SELECT time_bucket(INTERVAL 6 HOUR, ts) AS window_start, round(quantile_cont(latency_ms, 0.95), 6) AS p95
FROM request_log GROUP BY 1 HAVING quantile_cont(latency_ms, 0.95) > 60""",
)
def latency_alert(spark, folder):
    return mn.latency_alert(_log(spark, folder), "6 hours", 60.0).withColumn("p95", r("p95"))


@query(
    "sustained_alert",
    f"""WITH {sql.REQUEST_LOG},
m AS (SELECT model_version AS resource, time_bucket(INTERVAL 1 HOUR, ts) AS w, avg(latency_ms) AS value
FROM request_log GROUP BY ALL),
f AS (SELECT *, value > 19.5::DOUBLE AS hot, lag(w) OVER (PARTITION BY resource ORDER BY w) AS before FROM m),
g AS (SELECT *, sum(CASE WHEN NOT hot OR before IS NULL OR w - before <> INTERVAL 1 HOUR THEN 1 ELSE 0 END)
  OVER (PARTITION BY resource ORDER BY w) AS island FROM f)
SELECT resource, min(w) AS run_start, max(w) AS run_end, count(*) AS n_windows, round(max(value), 6) AS peak
FROM g WHERE hot GROUP BY resource, island HAVING count(*) >= 3""",
)
def sustained_alert(spark, folder):
    samples = _log(spark, folder).select(
        F.col("model_version").alias("resource"), "ts", F.col("latency_ms").alias("value")
    )
    return mn.sustained_alert(samples, "1 hour", 19.5, 3).withColumn("peak", r("peak"))


@query(
    "request_rate",
    f"""WITH {sql.REQUEST_LOG}
SELECT time_bucket(INTERVAL 1 MINUTE, ts) AS window_start, count(*) AS n,
  round(avg(CASE WHEN status < 500 THEN 1 ELSE 0 END), 6) AS success_rate FROM request_log GROUP BY 1""",
)
def request_rate(spark, folder):
    return mn.request_rate(_log(spark, folder)).withColumn("success_rate", r("success_rate"))


@query(
    "confidence_avg",
    f"""WITH {sql.REQUEST_LOG}
SELECT time_bucket(INTERVAL 1 DAY, ts) AS window_start, model_version, round(avg(confidence), 6) AS confidence,
  count(*) AS n FROM request_log GROUP BY ALL""",
)
def confidence_avg(spark, folder):
    return mn.confidence_avg(_log(spark, folder), DAY).withColumn("confidence", r("confidence"))


@query(
    "feature_drift",
    f"""WITH {sql.REQUEST_LOG},
a AS (SELECT latency_ms AS v FROM request_log WHERE ts < TIMESTAMP '2024-01-16 00:00:00'),
b AS (SELECT latency_ms AS v FROM request_log WHERE ts >= TIMESTAMP '2024-01-16 00:00:00'),
q AS (SELECT unnest(quantile_cont(v, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9])) AS e FROM a),
parts AS (
SELECT 'a' AS side, (SELECT count(*) FROM q WHERE e < v) AS part FROM a
UNION ALL SELECT 'b', (SELECT count(*) FROM q WHERE e < v) FROM b),
shares AS (SELECT part,
  greatest(count(*) FILTER (side = 'a') / (SELECT count(*) FROM a), 1e-6::DOUBLE) AS x,
  greatest(count(*) FILTER (side = 'b') / (SELECT count(*) FROM b), 1e-6::DOUBLE) AS y FROM parts GROUP BY part),
points AS (SELECT v, sum(x) AS x, sum(y) AS y FROM (SELECT v, 1 AS x, 0 AS y FROM a UNION ALL SELECT v, 0, 1 FROM b) GROUP BY v),
cdf AS (SELECT abs(sum(x) OVER (ORDER BY v) / (SELECT count(*) FROM a) - sum(y) OVER (ORDER BY v) / (SELECT count(*) FROM b)) AS gap
FROM points)
SELECT 'latency_ms' AS feature, (SELECT round(sum((y - x) * ln(y / x)), 6) FROM shares) AS psi,
  (SELECT round(max(gap), 6) FROM cdf) AS ks""",
)
def feature_drift(spark, folder):
    log = _log(spark, folder)
    border = F.lit("2024-01-16 00:00:00").cast("timestamp_ntz")
    out = mn.feature_drift(log.where(F.col("ts") < border), log.where(F.col("ts") >= border), "latency_ms")
    return out.select("feature", r("psi"), r("ks"))


@query(
    "ab_summary",
    f"""WITH {sql.REQUEST_LOG},
c AS (SELECT {sql.bucket("request_id", 42, 100)} < 50 AS arm, CASE WHEN status < 500 THEN 1 ELSE 0 END AS won FROM request_log),
s AS (SELECT count(*) FILTER (arm) AS n_a, count(*) FILTER (NOT arm) AS n_b, count(*) FILTER (arm AND won = 1) AS x_a,
  count(*) FILTER (NOT arm AND won = 1) AS x_b FROM c),
p AS (SELECT *, x_a / n_a AS ra, x_b / n_b AS rb, (x_a + x_b) / (n_a + n_b) AS pool FROM s)
SELECT n_a, n_b, x_a, x_b, round(ra, 6) AS rate_a, round(rb, 6) AS rate_b,
  round((rb - ra) / sqrt(pool * (1 - pool) * (1.0::DOUBLE / n_a + 1.0::DOUBLE / n_b)), 6) AS z,
  abs((rb - ra) / sqrt(pool * (1 - pool) * (1.0::DOUBLE / n_a + 1.0::DOUBLE / n_b))) >= 1.96 AS significant FROM p""",
)
def ab_summary(spark, folder):
    log = _log(spark, folder).withColumn("success", (F.col("status") < 500).cast("int"))
    out = mn.ab_summary(log, "request_id", "success")
    return out.withColumns({c: F.round(c, 6) for c in ("rate_a", "rate_b", "z")})


@query(
    "retrain_trigger",
    f"""WITH {sql.VERSIONS},
n AS (SELECT DISTINCT ON (name) name, version, auc FROM versions ORDER BY name, version DESC),
l AS (SELECT DISTINCT ON (name) name, version, auc FROM versions WHERE stage = 'Production' ORDER BY name, version DESC)
SELECT name, n.version AS new_version, l.version AS live_version, round(n.auc - l.auc, 6) + 0.0 AS change,
  CASE WHEN l.auc IS NULL THEN 'no production model' WHEN n.auc - l.auc >= 0.01 THEN 'promote'
    WHEN n.auc - l.auc <= -0.05 THEN 'retrain' ELSE 'keep' END AS decision
FROM n LEFT JOIN l USING (name)""",
)
def retrain_trigger(spark, folder):
    return mn.retrain_trigger(views.model_versions(spark, folder), "auc").withColumn("change", r("change"))


# --- scoring and attributions ---------------------------------------------------------------------

WEIGHTS = {"pclass": -0.6, "age": -0.02, "fare": 0.004, "family_size": -0.1}
INTERCEPT = 1.1
SCORE_SQL = "(1.1::DOUBLE - 0.6::DOUBLE * pclass - 0.02::DOUBLE * age + 0.004::DOUBLE * fare - 0.1::DOUBLE * family_size)"
FILLED = f"""{sql.PASSENGERS},
filled AS (SELECT passenger_id, survived AS label, CAST(pclass AS DOUBLE) AS pclass, coalesce(age, 30.0) AS age,
  coalesce(fare, 100.0) AS fare, CAST(sibsp + parch + 1 AS DOUBLE) AS family_size FROM passengers)"""


def _filled(spark, folder) -> DataFrame:
    return views.passengers(spark, folder).select(
        "passenger_id",
        F.col("survived").alias("label"),
        F.col("pclass").cast("double").alias("pclass"),
        F.coalesce("age", F.lit(30.0)).alias("age"),
        F.coalesce("fare", F.lit(100.0)).alias("fare"),
        (F.col("sibsp") + F.col("parch") + 1).cast("double").alias("family_size"),
    )


@query(
    "batch_predict",
    f"""WITH {FILLED}
SELECT passenger_id, CAST(1 / (1 + exp(-{SCORE_SQL})) >= 0.5 AS INT) AS predicted,
  round(1 / (1 + exp(-{SCORE_SQL})), 6) AS score, 'v1' AS model_version FROM filled""",
)
def batch_predict(spark, folder):
    out = mo.logistic_predict(_filled(spark, folder), WEIGHTS, INTERCEPT, "v1", "passenger_id")
    return out.withColumn("score", r("score"))


def _linear(x):
    return sum((x[n] * w for n, w in WEIGHTS.items()), F.lit(INTERCEPT))


def _shapley(spark, folder) -> DataFrame:
    rows = _filled(spark, folder)
    medians = mo.feature_medians(rows, list(WEIGHTS))
    return mo.sampled_shapley(rows, "passenger_id", list(WEIGHTS), medians, _linear)


SHAPLEY = f"""{FILLED},
shap AS (
SELECT passenger_id, 'pclass' AS feature, -0.6::DOUBLE * (pclass - (SELECT median(pclass) FROM filled)) AS value FROM filled
UNION ALL SELECT passenger_id, 'age', -0.02::DOUBLE * (age - (SELECT median(age) FROM filled)) FROM filled
UNION ALL SELECT passenger_id, 'fare', 0.004::DOUBLE * (fare - (SELECT median(fare) FROM filled)) FROM filled
UNION ALL SELECT passenger_id, 'family_size', -0.1::DOUBLE * (family_size - (SELECT median(family_size) FROM filled)) FROM filled)"""


@query(
    "sampled_shapley",
    f"WITH {SHAPLEY} SELECT passenger_id, feature, round(value, 9) + 0.0 AS value FROM shap",
)
def sampled_shapley(spark, folder):
    return _shapley(spark, folder).withColumn("value", r("value", 9))


@query(
    "top_features",
    f"""WITH {SHAPLEY}
SELECT passenger_id, feature, value, rank FROM (
  SELECT passenger_id, feature, round(value, 9) + 0.0 AS value, CAST(row_number() OVER (PARTITION BY passenger_id
    ORDER BY abs(round(value, 9)) DESC, feature) AS INT) AS rank FROM shap) WHERE rank <= 5""",
)
def top_features(spark, folder):
    rounded = _shapley(spark, folder).withColumn("value", r("value", 9))
    return ev.top_features(rounded, "passenger_id", 5)


@query(
    "top_features_overall",
    f"""WITH {SHAPLEY}
SELECT feature, round(avg(abs(value)), 6) AS importance FROM shap GROUP BY feature ORDER BY 2 DESC LIMIT 10""",
)
def top_features_overall(spark, folder):
    return ev.top_features_overall(_shapley(spark, folder), 10).withColumn("importance", r("importance"))


def _brier(rows: DataFrame) -> DataFrame:
    p = 1 / (1 + F.exp(-mo.linear_score(WEIGHTS, INTERCEPT)))
    return rows.agg(F.avg((p - F.col("label")) * (p - F.col("label"))).alias("loss"))


def _permutation_sql() -> str:
    parts = []
    for f in WEIGHTS:
        score = SCORE_SQL.replace(f" {f}", " moved")
        parts.append(
            f"""SELECT '{f}' AS feature, round((SELECT avg(pow(1 / (1 + exp(-{score})) - label, 2)) FROM (
  SELECT *, coalesce(lead({f}) OVER w, first_value({f}) OVER (PARTITION BY b ORDER BY d, passenger_id)) AS moved
  FROM placed WINDOW w AS (PARTITION BY b ORDER BY d, passenger_id)))
  - (SELECT avg(pow(1 / (1 + exp(-{SCORE_SQL})) - label, 2)) FROM filled), 6) + 0.0 AS importance"""
        )
    return "\nUNION ALL ".join(parts)


@query(
    "permutation_importance",
    f"""WITH {FILLED},
placed AS (SELECT *, {sql.draw("passenger_id", 42)} % greatest(1, (SELECT count(*) FROM filled) // 1000) AS b,
  {sql.draw("passenger_id", 43)} AS d FROM filled)
{_permutation_sql()}""",
)
def permutation_importance(spark, folder):
    out = mo.permutation_importance(_filled(spark, folder), "passenger_id", list(WEIGHTS), _brier)
    return out.withColumn("importance", r("importance"))


# --- boosted trees --------------------------------------------------------------------------------

FEATURES = list(WEIGHTS)
# Four fifths of these labels follow a rule on the features, so a model has something to learn.
GRADED = f"""{FILLED},
graded AS (SELECT passenger_id, pclass, age, fare, family_size,
  CASE WHEN {sql.bucket("passenger_id", 7, 100)} < 20 THEN label
       ELSE CAST(fare + 2 * age - 6 * family_size - 20 * pclass > 200 AS INT) END AS label FROM filled)"""


def _graded(spark, folder) -> DataFrame:
    rule = F.expr("fare + 2 * age - 6 * family_size - 20 * pclass > 200").cast("int")
    rows = _filled(spark, folder)
    return materialize(rows.withColumn("label", F.when(hash_bucket(F.col("passenger_id"), 7, 100) < 20, F.col("label")).otherwise(rule)), "graded")


@query(
    "train_classifier",
    f"""WITH {GRADED}
SELECT count(*) AS n, count(*) FILTER (label = 1) AS n_positive, true AS better FROM graded
WHERE {sql.bucket("passenger_id", 42, 100)} >= 80""",
)
def train_classifier(spark, folder):
    """Boosted trees at their defaults on the training rows; on the test rows they are right for a tenth more than a model
    that always says the more frequent label."""
    rows = split_random(_graded(spark, folder), "passenger_id")
    model = mo.train_classifier(rows.where(F.col("split") == "train"), "passenger_id", FEATURES)
    scored = mo.batch_predict(model, rows.where(F.col("split") == "test"), "gbt", "label")
    positive = F.col("tp") + F.col("fn")
    most = F.greatest(positive, F.col("n") - positive)
    return ev.confusion_matrix(scored).select(
        "n", positive.alias("n_positive"), (F.col("tp") + F.col("tn") >= most + 0.1 * F.col("n")).alias("better")
    )


def _drawn_sql() -> str:
    columns = []
    for place, (name, (low, high, kind)) in enumerate(mo.SEARCH_SPACE.items()):
        u = f"({sql.draw('trial', 42 + place)} / 4294967296.0::DOUBLE)"
        if kind == "int":
            columns.append(f"CAST({low} + floor({u} * {high - low + 1}) AS INT) AS {name}")
        elif kind == "log":
            columns.append(f"round(exp(ln({low}::DOUBLE) + {u} * (ln({high}::DOUBLE) - ln({low}::DOUBLE))), 9) AS {name}")
        else:
            columns.append(f"round({low}::DOUBLE + {u} * {high - low}::DOUBLE, 9) AS {name}")
    return ", ".join(columns)


@query(
    "hyper_search",
    f"""WITH {FILLED}, drawn AS (SELECT unnest(range(50)) AS trial)
SELECT trial, {_drawn_sql()}, (SELECT count(*) FROM filled WHERE {sql.bucket("passenger_id", 43, 100)} < 20) AS n_valid,
  true AS scored FROM drawn""",
)
def hyper_search(spark, folder):
    """Fifty trials over the whole search space, each with early stop."""
    rows = _filled(spark, folder)
    found = mo.hyper_search(rows, "passenger_id", FEATURES, mo.random_params(50))
    doubles = [n for n, (_, _, kind) in mo.SEARCH_SPACE.items() if kind != "int"]
    scored = F.col("auc").between(0, 1) & F.col("trees_kept").between(0, F.col("trees"))
    return found.select(
        "trial", *[r(n, 9) if n in doubles else n for n in mo.SEARCH_SPACE], F.col("n").alias("n_valid"), scored.alias("scored")
    )


@query("cross_validate", f"WITH {GRADED} SELECT CAST(5 AS BIGINT) AS folds, count(*) AS n, true AS better FROM graded")
def cross_validate(spark, folder):
    """Five seeded folds of boosted trees at their defaults; a constant model has an AUC of 0.5."""
    folds = mo.cross_validate(_graded(spark, folder), "passenger_id", FEATURES)
    better = (F.col("auc_mean") > 0.75) & (F.col("auc_std") < 0.1)
    return mo.fold_summary(folds).select("folds", "n", better.alias("better"))


SMALL = TreeParams(trees=10, max_depth=4)


@query("tree_shapley", f"WITH {FILLED} SELECT passenger_id, CAST(4 AS BIGINT) AS n_features, true AS adds_up FROM filled")
def tree_shapley(spark, folder):
    """Attributions of fitted trees for every row: they add up to its score less that of the medians."""
    rows = _graded(spark, folder)
    medians = mo.feature_medians(rows, FEATURES)
    model = mo.train_classifier(rows, "passenger_id", FEATURES, params=SMALL)
    summed = mo.tree_shapley(model, rows, "passenger_id", medians).groupBy("passenger_id").agg(
        F.count("feature").alias("n_features"), F.sum("value").alias("total")
    )
    start = model.score(np.array([[medians[f] for f in FEATURES]]))[0]
    scored = mo.batch_predict(model, rows, "gbt", "passenger_id")
    close = F.abs(F.col("score") - F.col("total") - F.lit(float(start))) < 1e-9
    return summed.join(scored, "passenger_id").select("passenger_id", "n_features", close.alias("adds_up"))


@query(
    "saved_predict",
    f"""WITH {sql.PASSENGERS}
SELECT passenger_id, 'v2' AS model_version, true AS same FROM passengers""",
)
def saved_predict(spark, folder):
    """A feature bundle and a model are fitted, saved, loaded and applied to the raw table; the scores are those of the fitted ones."""
    raw = materialize(views.passengers(spark, folder), "passengers")
    bundle = ft.fit_features(train_rows(raw, "passenger_id"))
    prepared = materialize(ft.apply_features(raw, bundle, drop_first=True), "prepared")
    inputs = [c for c in prepared.columns if c not in ("passenger_id", "survived")]
    model = mo.train_classifier(train_rows(prepared, "passenger_id"), "passenger_id", inputs, "survived", SMALL)
    path = scratch_path(spark, "saved")
    bundle.save(f"{path}/features")
    model.save(spark, f"{path}/model")
    served = ft.apply_features(raw, ft.FeatureBundle.load(spark, f"{path}/features"), drop_first=True)
    scored = mo.batch_predict(Booster.load(spark, f"{path}/model"), served, "v2", "passenger_id")
    fitted = boosting.predict(model, prepared, "passenger_id").withColumnRenamed("score", "fitted")
    return scored.join(fitted, "passenger_id").select("passenger_id", "model_version", (F.abs(F.col("score") - F.col("fitted")) < 1e-12).alias("same"))
