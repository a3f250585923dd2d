"""Named queries on post streams, in one-day windows (the event table spans a month)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.operators import trends
from tidemill.queries import checks as sql
from tidemill.queries.registry import query, r
from tidemill.sources import views

DAY = "1 day"


def _tagged(spark: SparkSession, folder: str) -> DataFrame:
    return trends.extract_hashtags(views.posts(spark, folder))


def _counts(spark: SparkSession, folder: str) -> DataFrame:
    return trends.tumbling_counts(_tagged(spark, folder), DAY)


def _dense(spark: SparkSession, folder: str) -> DataFrame:
    return trends.densify_windows(_counts(spark, folder), DAY)


def _stats(spark: SparkSession, folder: str) -> DataFrame:
    return trends.rolling_stats(_dense(spark, folder))


def _scored(spark: SparkSession, folder: str) -> DataFrame:
    return trends.zscore(_stats(spark, folder))


def _active(spark: SparkSession, folder: str) -> DataFrame:
    """Scores of the windows that have posts; only those can be alerts."""
    return trends.zscore(trends.active_stats(_counts(spark, folder), DAY))


@query(
    "parse_record",
    f"""WITH {sql.POSTS}
SELECT 'good' AS kind, post_id, text, lang, round(sentiment, 6) AS sentiment FROM posts WHERE post_id % 50 <> 0
UNION ALL SELECT 'bad', post_id, NULL, NULL, NULL FROM posts WHERE post_id % 50 = 0""",
)
def parse_record(spark, folder):
    good, bad = trends.parse_posts(views.raw_messages(views.posts(spark, folder)))
    return good.select(
        F.lit("good").alias("kind"), "post_id", "text", "lang", r("sentiment")
    ).unionByName(
        bad.select(F.lit("bad").alias("kind"), F.col("offset").alias("post_id")),
        allowMissingColumns=True,
    )


@query(
    "normalize_lang",
    f"""WITH {sql.POSTS}
SELECT post_id, lower(coalesce(regexp_split_to_array(lang, '[-_]')[1], 'und')) AS lang FROM posts""",
)
def normalize_lang(spark, folder):
    return trends.normalize_lang(views.posts(spark, folder)).select("post_id", "lang")


@query(
    "fill_sentiment",
    f"""WITH {sql.POSTS}
SELECT post_id, round(greatest(-1, least(1, coalesce(sentiment, 0))), 6) AS sentiment FROM posts""",
)
def fill_sentiment(spark, folder):
    return trends.fill_sentiment(views.posts(spark, folder)).select("post_id", r("sentiment"))


@query("extract_hashtags", f"WITH {sql.TAGGED} SELECT post_id, hashtag FROM tagged")
def extract_hashtags(spark, folder):
    return _tagged(spark, folder).select("post_id", "hashtag")


@query(
    "extract_mentions",
    f"""WITH {sql.POSTS}
SELECT DISTINCT post_id, lower(raw) AS mention
FROM (SELECT post_id, unnest(regexp_extract_all(text, '@([\\p{{L}}\\p{{N}}_]+)', 1)) AS raw FROM posts)""",
)
def extract_mentions(spark, folder):
    return trends.extract_mentions(views.posts(spark, folder)).select("post_id", "mention")


@query(
    "tumbling_counts",
    f"""WITH {sql.TAGGED}
SELECT hashtag, window_start, n, round(sentiment_sum, 6) AS sentiment_sum, sentiment_n FROM counts""",
)
def tumbling_counts(spark, folder):
    return _counts(spark, folder).withColumn("sentiment_sum", r("sentiment_sum"))


@query(
    "sliding_counts",
    f"""WITH {sql.TAGGED}
SELECT hashtag, window_start, count(*) AS n, round(coalesce(sum(sentiment), 0), 6) AS sentiment_sum,
  count(sentiment) AS sentiment_n
FROM (SELECT hashtag, sentiment,
        unnest([time_bucket(INTERVAL 12 HOUR, ts), time_bucket(INTERVAL 12 HOUR, ts) - INTERVAL 12 HOUR])
          AS window_start FROM tagged)
GROUP BY ALL""",
)
def sliding_counts(spark, folder):
    return trends.tumbling_counts(_tagged(spark, folder), DAY, "12 hours").withColumn(
        "sentiment_sum", r("sentiment_sum")
    )


@query(
    "densify_windows",
    f"""WITH {sql.DENSE}
SELECT hashtag, window_start, n, round(sentiment_sum, 6) AS sentiment_sum, sentiment_n FROM dense""",
)
def densify_windows(spark, folder):
    return _dense(spark, folder).withColumn("sentiment_sum", r("sentiment_sum"))


@query(
    "rolling_stats",
    f"""WITH {sql.SCORED}
SELECT hashtag, window_start, n, history, round(baseline_mean, 6) AS baseline_mean,
  round(baseline_std, 6) AS baseline_std, round(baseline_sentiment, 10) + 0.0 AS baseline_sentiment
FROM stats""",
)
def rolling_stats(spark, folder):
    return _stats(spark, folder).select(
        "hashtag",
        "window_start",
        "n",
        "history",
        r("baseline_mean"),
        r("baseline_std"),
        r("baseline_sentiment", 10),
    )


@query(
    "zscore",
    f"""WITH {sql.SCORED}
SELECT hashtag, window_start, n, round(zscore, 6) + 0.0 AS zscore FROM scored""",
)
def zscore(spark, folder):
    return _scored(spark, folder).select("hashtag", "window_start", "n", r("zscore"))


@query(
    "active_stats",
    f"""WITH {sql.SCORED}
SELECT hashtag, window_start, n, history, round(baseline_mean, 6) AS baseline_mean,
  round(baseline_std, 6) AS baseline_std, round(baseline_sentiment, 10) + 0.0 AS baseline_sentiment
FROM stats WHERE n > 0""",
)
def active_stats(spark, folder):
    return trends.active_stats(_counts(spark, folder), DAY).select(
        "hashtag",
        "window_start",
        "n",
        "history",
        r("baseline_mean"),
        r("baseline_std"),
        r("baseline_sentiment", 10),
    )


EWMA = f"""{sql.DENSE},
numbered AS (SELECT *, row_number() OVER (PARTITION BY hashtag ORDER BY window_start) AS i FROM dense),
smooth AS (
SELECT hashtag, window_start, n, i, CAST(n AS DOUBLE) AS ewma FROM numbered WHERE i = 1
UNION ALL
SELECT d.hashtag, d.window_start, d.n, d.i, (d.n + 2 * s.ewma) / 3
FROM smooth s JOIN numbered d ON d.hashtag = s.hashtag AND d.i = s.i + 1)"""


@query(
    "ewma",
    f"""WITH RECURSIVE {EWMA}
SELECT hashtag, window_start, n, round(ewma, 6) AS ewma FROM smooth""",
)
def ewma(spark, folder):
    return trends.ewma(_dense(spark, folder), DAY).select("hashtag", "window_start", "n", r("ewma"))


@query(
    "decayed_count",
    f"""WITH RECURSIVE {sql.TAGGED},
numbered AS (SELECT *, row_number() OVER (PARTITION BY hashtag ORDER BY window_start) AS i FROM counts),
faded AS (
SELECT hashtag, window_start, n, i, CAST(n AS DOUBLE) AS decayed FROM numbered WHERE i = 1
UNION ALL
SELECT d.hashtag, d.window_start, d.n, d.i,
  f.decayed * exp(-date_diff('second', f.window_start, d.window_start) / 21600.0::DOUBLE) + d.n
FROM faded f JOIN numbered d ON d.hashtag = f.hashtag AND d.i = f.i + 1)
SELECT hashtag, window_start, n, round(decayed, 6) AS decayed FROM faded""",
)
def decayed_count(spark, folder):
    return trends.decayed_count(_counts(spark, folder), 21_600).select(
        "hashtag", "window_start", "n", r("decayed")
    )


@query(
    "score_anomaly",
    f"""WITH RECURSIVE {EWMA},
{sql.STATS},
prior AS (SELECT hashtag, window_start, lag(ewma) OVER (PARTITION BY hashtag ORDER BY window_start) AS ewma_before
FROM smooth)
SELECT hashtag, window_start, s.n, round(zscore, 6) AS zscore, round(ewma_before, 6) AS ewma_before
FROM scored s JOIN prior USING (hashtag, window_start)
WHERE zscore >= 3 OR s.n >= 2 * ewma_before""",
)
def score_anomaly(spark, folder):
    smooth = trends.ewma(_scored(spark, folder), DAY)
    before = trends.with_previous(smooth, "ewma", "ewma_before")
    return trends.score_anomaly(before, ewma_limit=2.0).select(
        "hashtag", "window_start", "n", r("zscore"), r("ewma_before")
    )


@query(
    "adaptive_threshold",
    f"""WITH {sql.SCORED}
SELECT hashtag, window_start, round(zscore, 6) + 0.0 AS zscore,
  round(greatest(quantile_cont(zscore, 0.95) OVER (PARTITION BY hashtag ORDER BY window_start
    ROWS BETWEEN 14 PRECEDING AND 1 PRECEDING), 1.0), 6) AS threshold
FROM scored""",
)
def adaptive_threshold(spark, folder):
    return trends.adaptive_threshold(_scored(spark, folder)).select(
        "hashtag", "window_start", r("zscore"), r("threshold")
    )


@query(
    "cooldown",
    f"""WITH RECURSIVE {sql.SCORED},
hits AS (SELECT hashtag, window_start, n FROM scored WHERE zscore >= 0.5),
kept AS (
SELECT hashtag, min(window_start) AS window_start FROM hits GROUP BY hashtag
UNION ALL
SELECT k.hashtag, (SELECT min(h.window_start) FROM hits h
  WHERE h.hashtag = k.hashtag AND h.window_start >= k.window_start + INTERVAL 4 DAY)
FROM kept k WHERE EXISTS (SELECT 1 FROM hits h
  WHERE h.hashtag = k.hashtag AND h.window_start >= k.window_start + INTERVAL 4 DAY))
SELECT hashtag, window_start, n FROM hits JOIN kept USING (hashtag, window_start)""",
)
def cooldown(spark, folder):
    hits = trends.score_anomaly(_active(spark, folder), 0.5)
    return trends.cooldown(hits.select("hashtag", "window_start", "n"), 4 * 86_400)


@query(
    "sentiment_shift",
    f"""WITH {sql.SCORED}
SELECT hashtag, window_start, round(sentiment_shift, 10) + 0.0 AS sentiment_shift FROM scored""",
)
def sentiment_shift(spark, folder):
    return trends.sentiment_shift(_stats(spark, folder)).select(
        "hashtag", "window_start", r("sentiment_shift", 10)
    )


@query(
    "spike_magnitude",
    f"""WITH {sql.SCORED}
SELECT hashtag, window_start, round(magnitude, 6) AS magnitude FROM scored""",
)
def spike_magnitude(spark, folder):
    return trends.spike_magnitude(_stats(spark, folder)).select(
        "hashtag", "window_start", r("magnitude")
    )


REPRESENTATIVE = """
ranked AS (
SELECT hashtag, window_start, post_id, row_number() OVER (
  PARTITION BY hashtag, window_start ORDER BY coalesce(abs(sentiment), 0) DESC, post_id) AS rank
FROM (SELECT *, time_bucket(INTERVAL 1 DAY, ts) AS window_start FROM tagged)
SEMI JOIN (SELECT * FROM scored WHERE zscore >= 3) USING (hashtag, window_start)),
pointers AS (
SELECT hashtag, window_start, string_agg(CAST(post_id AS VARCHAR), ' ' ORDER BY rank) AS post_ids
FROM ranked WHERE rank <= 3 GROUP BY ALL)"""


def _ids(df: DataFrame) -> DataFrame:
    return df.withColumn("post_ids", F.array_join("post_ids", " "))


@query(
    "representative_posts",
    f"""WITH {sql.SCORED}, {REPRESENTATIVE}
SELECT * FROM pointers""",
)
def representative_posts(spark, folder):
    alerts = trends.score_anomaly(_active(spark, folder))
    return _ids(trends.representative_posts(_tagged(spark, folder), alerts, DAY))


@query(
    "trend_alerts",
    f"""WITH {sql.SCORED}, {REPRESENTATIVE}
SELECT hashtag, window_start, n, round(baseline_mean, 6) AS baseline_mean,
  round(baseline_std, 6) AS baseline_std, round(zscore, 6) AS zscore, round(magnitude, 6) AS magnitude,
  round(sentiment_shift, 10) + 0.0 AS sentiment_shift, post_ids
FROM scored LEFT JOIN pointers USING (hashtag, window_start) WHERE zscore >= 3""",
)
def trend_alerts(spark, folder):
    return _ids(trends.trend_alerts(views.posts(spark, folder), DAY)).select(
        "hashtag",
        "window_start",
        "n",
        r("baseline_mean"),
        r("baseline_std"),
        r("zscore"),
        r("magnitude"),
        r("sentiment_shift", 10),
        "post_ids",
    )


@query(
    "hashtag_sketch",
    f"WITH {sql.TAGGED} SELECT hashtag, count(*) AS n FROM tagged GROUP BY hashtag ORDER BY n DESC, hashtag LIMIT 10",
)
def hashtag_sketch(spark, folder):
    return trends.hashtag_top(_tagged(spark, folder))


@query("hashtag_estimates", f"WITH {sql.TAGGED} SELECT hashtag, count(*) AS n FROM tagged GROUP BY hashtag")
def hashtag_estimates(spark, folder):
    """All tags from the count-min sketch, which is exact as long as they are few."""
    return trends.hashtag_estimates(_tagged(spark, folder))


@query(
    "sentiment_drift",
    f"""WITH {sql.DENSE}
SELECT hashtag, window_start,
  round(CASE WHEN sum(sentiment_n) OVER a > 0 THEN sum(sentiment_sum) OVER a / sum(sentiment_n) OVER a END
      - CASE WHEN sum(sentiment_n) OVER b > 0 THEN sum(sentiment_sum) OVER b / sum(sentiment_n) OVER b END, 10)
    + 0.0 AS drift
FROM dense
WINDOW a AS (PARTITION BY hashtag ORDER BY window_start ROWS BETWEEN 2 PRECEDING AND CURRENT ROW),
       b AS (PARTITION BY hashtag ORDER BY window_start ROWS BETWEEN 13 PRECEDING AND CURRENT ROW)""",
)
def sentiment_drift(spark, folder):
    return trends.sentiment_drift(_dense(spark, folder)).select("hashtag", "window_start", r("drift", 10))


@query(
    "ingest_quality",
    f"""WITH {sql.POSTS}
SELECT time_bucket(INTERVAL 1 DAY, ts) AS window_start, count(*) AS n,
  round(avg(CASE WHEN post_id % 50 = 0 THEN 1 ELSE 0 END), 6) AS bad_share,
  round(avg(CASE WHEN lang IS NULL THEN 1 ELSE 0 END) FILTER (post_id % 50 <> 0), 6) AS null_lang_share,
  round(avg(CASE WHEN sentiment IS NULL THEN 1 ELSE 0 END) FILTER (post_id % 50 <> 0), 6)
    AS null_sentiment_share
FROM posts GROUP BY 1""",
)
def ingest_quality(spark, folder):
    return trends.ingest_quality(views.raw_messages(views.posts(spark, folder))).select(
        "window_start", "n", r("bad_share"), r("null_lang_share"), r("null_sentiment_share")
    )


@query(
    "alert_truth_join",
    f"""WITH {sql.SCORED},
truth AS (
SELECT hashtag, window_start FROM counts JOIN (SELECT hashtag, avg(n) AS m FROM counts GROUP BY 1) USING (hashtag)
WHERE n > 1.2::DOUBLE * m),
both_sides AS (
SELECT coalesce(a.hashtag, t.hashtag) AS hashtag, a.hashtag IS NOT NULL AS a, t.hashtag IS NOT NULL AS t
FROM (SELECT hashtag, window_start FROM scored WHERE zscore >= 1.5) a FULL JOIN truth t USING (hashtag, window_start))
SELECT hashtag, count(*) FILTER (a AND t) AS tp, count(*) FILTER (a AND NOT t) AS fp,
  count(*) FILTER (t AND NOT a) AS fn,
  round(count(*) FILTER (a AND t) / nullif(count(*) FILTER (a), 0), 6) AS precision,
  round(count(*) FILTER (a AND t) / nullif(count(*) FILTER (t), 0), 6) AS recall
FROM both_sides GROUP BY hashtag""",
)
def alert_truth_join(spark, folder):
    alerts = trends.score_anomaly(_active(spark, folder), 1.5)
    counts = _counts(spark, folder)
    means = counts.groupBy("hashtag").agg(F.avg("n").alias("m"))
    truth = counts.join(means, "hashtag").where(F.col("n") > 1.2 * F.col("m"))
    return trends.alert_truth_join(alerts, truth).select(
        "hashtag", "tp", "fp", "fn", r("precision"), r("recall")
    )
