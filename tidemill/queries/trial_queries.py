"""Named queries on trials, loss histories and the model registry."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemill.operators import trials as tr
from tidemill.queries import checks as sql
from tidemill.queries import corpus_queries as cq
from tidemill.queries.registry import query, r
from tidemill.sources import views


@query("head", "SELECT doc_id, lang, source FROM documents ORDER BY doc_id LIMIT 5")
def head(spark, folder):
    return tr.head(views.table(spark, folder, "documents"), "doc_id").select("doc_id", "lang", "source")


@query(
    "best_trial",
    f"""WITH {sql.TRIALS}
SELECT DISTINCT ON (study) study, trial, max_depth, round(learning_rate, 9) AS learning_rate, auc, model_kb
FROM trials ORDER BY study, auc DESC, trial""",
)
def best_trial(spark, folder):
    return tr.best_trial(views.trials(spark, folder), "auc").withColumn(
        "learning_rate", r("learning_rate", 9)
    )


@query(
    "running_best",
    f"""WITH {sql.TRIALS}
SELECT study, trial, auc, max(auc) OVER (PARTITION BY study ORDER BY trial) AS best_so_far FROM trials""",
)
def running_best(spark, folder):
    return tr.running_best(views.trials(spark, folder), "auc").select(
        "study", "trial", "auc", "best_so_far"
    )


METRICS = f"""{sql.VERSIONS},
metric_rows AS (SELECT name, version, trained_at, stage, 'auc' AS metric, auc AS value FROM versions
UNION ALL SELECT name, version, trained_at, stage, 'model_kb', model_kb FROM versions)"""


@query(
    "delta_prev",
    f"""WITH {METRICS},
d AS (SELECT *, lag(value) OVER (PARTITION BY name, metric ORDER BY version) AS prev_value FROM metric_rows)
SELECT name, metric, version, value, round(value - prev_value, 6) + 0.0 AS delta,
  CASE WHEN value > prev_value THEN 'improved' WHEN value < prev_value THEN 'degraded'
    WHEN value = prev_value THEN 'same' END AS verdict FROM d""",
)
def delta_prev(spark, folder):
    out = tr.delta_prev(tr.metric_rows(views.model_versions(spark, folder)))
    return out.select("name", "metric", "version", "value", r("delta"), "verdict")


@query(
    "metric_trend",
    f"""WITH {METRICS}
SELECT name, metric, version, trained_at, value, stage = 'Production' AS production FROM metric_rows""",
)
def metric_trend(spark, folder):
    return tr.metric_trend(views.model_versions(spark, folder))


@query(
    "loss_history",
    f"""WITH {cq.SAMPLES},
{cq.PAIR_COUNTS},
drawn_pairs AS (
SELECT split, step, c AS prev, lead(c) OVER (PARTITION BY split, step, row ORDER BY s) AS next FROM sampled_ids),
per_batch AS (
SELECT split, step,
  avg(-ln((coalesce(n, 0) + 1) / (coalesce(c_prev, 0) + (SELECT count(*) FROM vocab)))) AS loss
FROM drawn_pairs LEFT JOIN counts USING (prev, next) LEFT JOIN row_totals USING (prev)
WHERE next IS NOT NULL GROUP BY ALL)
SELECT step AS epoch, round(avg(loss) FILTER (split = 'train'), 6) AS train_loss,
  round(avg(loss) FILTER (split = 'val'), 6) AS val_loss
FROM per_batch WHERE step % 10 = 0 OR step = (SELECT max(step) FROM per_batch) GROUP BY step""",
)
def loss_history(spark, folder):
    losses = cq.batch_losses(spark, folder).withColumnRenamed("batch_loss", "loss")
    return tr.loss_history(losses, 10).select("epoch", r("train_loss"), r("val_loss"))


@query(
    "retention_rank",
    f"""WITH {sql.VERSIONS},
s AS (SELECT name, version, row_number() OVER (PARTITION BY name ORDER BY version DESC) AS k FROM versions
WHERE stage = 'Staging')
SELECT v.name, v.version, stage, CASE WHEN stage = 'Production' THEN 'keep'
  WHEN trained_at < TIMESTAMP '2025-01-01 00:00:00' - INTERVAL 6 MONTH THEN 'archive'
  WHEN k <= 3 THEN 'keep' ELSE 'archive' END AS action
FROM versions v LEFT JOIN s USING (name, version)""",
)
def retention_rank(spark, folder):
    out = tr.retention_rank(views.model_versions(spark, folder), "2025-01-01 00:00:00")
    return out.select("name", "version", "stage", "action")


@query(
    "current_production",
    f"""WITH {sql.VERSIONS},
p AS (SELECT name, version, row_number() OVER (PARTITION BY name ORDER BY version DESC) AS k FROM versions
WHERE stage = 'Production')
SELECT name, max(version) FILTER (k = 1) AS production_version, max(version) FILTER (k = 2) AS fallback_version
FROM p GROUP BY name""",
)
def current_production(spark, folder):
    return tr.current_production(views.model_versions(spark, folder))


@query(
    "runs_table",
    f"""WITH {sql.VERSIONS}
SELECT name, version, CAST(max_depth AS VARCHAR) AS param_max_depth, CAST(trial AS VARCHAR) AS param_trial,
  auc AS metric_auc, model_kb AS metric_model_kb FROM versions""",
)
def runs_table(spark, folder):
    runs = views.model_versions(spark, folder)
    return tr.runs_table(runs, ["max_depth", "trial"], ["auc", "model_kb"], "name", "version")


@query(
    "param_importance",
    f"""WITH {sql.TRIALS},
ranked AS (SELECT study,
  rank() OVER (PARTITION BY study ORDER BY auc) + (count(*) OVER (PARTITION BY study, auc) - 1) / 2.0::DOUBLE AS rv,
  rank() OVER (PARTITION BY study ORDER BY max_depth) + (count(*) OVER (PARTITION BY study, max_depth) - 1) / 2.0::DOUBLE AS r1,
  rank() OVER (PARTITION BY study ORDER BY learning_rate) + (count(*) OVER (PARTITION BY study, learning_rate) - 1) / 2.0::DOUBLE AS r2
FROM trials)
SELECT study, 'max_depth' AS param, round(abs(corr(r1, rv)), 6) AS importance FROM ranked GROUP BY study
UNION ALL SELECT study, 'learning_rate', round(abs(corr(r2, rv)), 6) FROM ranked GROUP BY study""",
)
def param_importance(spark, folder):
    trials = views.trials(spark, folder)
    return tr.param_importance(trials, ["max_depth", "learning_rate"], "auc").select(
        "study", "param", r("importance")
    )


@query(
    "slice_effect",
    f"""WITH {sql.TRIALS}
SELECT study, CAST(floor(learning_rate / 0.05::DOUBLE) AS INT) AS bin, round(avg(auc), 6) AS mean, max(auc) AS best,
  count(*) AS n FROM trials GROUP BY ALL""",
)
def slice_effect(spark, folder):
    out = tr.slice_effect(views.trials(spark, folder), "learning_rate", 0.05, "auc")
    return out.withColumn("mean", r("mean"))


@query(
    "contour_effect",
    f"""WITH {sql.TRIALS}
SELECT study, CAST(floor(learning_rate / 0.1::DOUBLE) AS INT) AS learning_rate_bin,
  CAST(floor(max_depth / 2) AS INT) AS max_depth_bin, round(avg(auc), 6) AS mean, max(auc) AS best, count(*) AS n
FROM trials GROUP BY ALL""",
)
def contour_effect(spark, folder):
    widths = {"learning_rate": 0.1, "max_depth": 2}
    return tr.contour_effect(views.trials(spark, folder), widths, "auc").withColumn("mean", r("mean"))


@query(
    "pareto_front",
    f"""WITH {sql.TRIALS}
SELECT study, trial, auc, model_kb FROM trials a WHERE NOT EXISTS (
  SELECT 1 FROM trials b WHERE b.study = a.study AND b.auc >= a.auc AND b.model_kb <= a.model_kb
    AND (b.auc > a.auc OR b.model_kb < a.model_kb))""",
)
def pareto_front(spark, folder):
    front = tr.pareto_front(views.trials(spark, folder), "auc", "model_kb")
    return front.select("study", "trial", "auc", "model_kb")


def _steps(spark, folder):
    """Ten intermediate values per trial, rising to its final one."""
    step = F.explode(F.sequence(F.lit(1), F.lit(10))).alias("step")
    rows = views.trials(spark, folder).select("study", "trial", "auc", step)
    wobble = ((F.col("trial") * F.col("step")) % 7).cast("double") / 10
    return rows.select("study", "trial", "step", (F.col("auc") * F.col("step") / 10 + wobble).alias("value"))


@query(
    "median_prune",
    f"""WITH {sql.TRIALS},
steps AS (SELECT study, trial, step, auc * step / 10.0::DOUBLE + (trial * step) % 7 / 10.0::DOUBLE AS value
FROM trials, (SELECT unnest(range(1, 11)) AS step)),
m AS (SELECT study, step, median(value) AS median FROM steps GROUP BY ALL)
SELECT study, trial, CAST(min(step) AS INT) AS pruned_at FROM steps JOIN m USING (study, step)
WHERE step > 3 AND value < median GROUP BY study, trial""",
)
def median_prune(spark, folder):
    return tr.median_prune(_steps(spark, folder), 3)
