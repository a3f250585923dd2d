"""Named streaming queries. Each drains its files and returns the written result."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.operators import monitor as mn
from tidemill.operators import trends
from tidemill.plans import materialize, param_join
from tidemill.plans.scratch import scratch_path
from tidemill.queries import checks as sql
from tidemill.queries.registry import query, r
from tidemill.sources import readers, views
from tidemill.streaming import jobs
from tidemill.streaming.trend_state import TrendState, score_stream

DAY = "1 day"
DAY_US = 86_400_000_000


def _events(spark, folder) -> DataFrame:
    schema = views.table(spark, folder, "events").schema
    # a pattern, since the table may be one file and a file source expects folders or patterns
    return readers.file_stream(spark, f"{folder}/events[.]parquet", schema)


def _posts(spark, folder) -> DataFrame:
    return views.posts_from(_events(spark, folder), views.table(spark, folder, "documents"))


CLOSED = f"""{sql.SCORED},
edge AS (SELECT max(ts) - INTERVAL 2 DAY AS watermark FROM tagged),
closed AS (SELECT scored.* FROM scored, edge WHERE window_start + INTERVAL 1 DAY <= watermark AND n > 0)"""

WINDOWS_SQL = f"""WITH {CLOSED}
SELECT hashtag, window_start, n, round(sentiment_sum, 6) AS sentiment_sum, sentiment_n FROM closed"""


@query("src_stream_files", "SELECT event_id, event_type, user_id FROM events")
def src_stream_files(spark, folder):
    return jobs.drained(_events(spark, folder).select("event_id", "event_type", "user_id"), "files")


@query("stream_process", f"WITH {sql.POSTS} SELECT text FROM posts")
def stream_process(spark, folder):
    return jobs.drained(jobs.process_texts(_posts(spark, folder)), "process")


ENRICHED_SQL = f"""WITH {sql.POSTS}
SELECT post_id, lower(coalesce(regexp_split_to_array(lang, '[-_]')[1], 'und')) AS lang,
  round(greatest(-1, least(1, coalesce(sentiment, 0))), 6) AS sentiment,
  '#' || event_type || CASE WHEN text LIKE '%#Breaking%' THEN '#breaking' ELSE '' END AS tags
FROM posts JOIN events ON post_id = event_id WHERE post_id % 50 <> 0"""


def _enriched(df: DataFrame) -> DataFrame:
    tags = F.concat(F.lit("#"), F.array_join("hashtags", "#"))
    return df.select("post_id", "lang", r("sentiment"), tags.alias("tags"))


@query("src_kafka", ENRICHED_SQL)
def src_kafka(spark, folder):
    """Records in the shape of a topic, from files, through the job that reads a topic."""
    path = scratch_path(spark, "topic")
    views.raw_messages(views.posts(spark, folder)).write.parquet(path)
    raw = readers.file_stream(spark, path, readers.TOPIC_SCHEMA)
    return _enriched(jobs.drained(jobs.enrich_stream(raw), "kafka"))


@query("stream_enrich", ENRICHED_SQL)
def stream_enrich(spark, folder):
    raw = views.raw_messages(_posts(spark, folder))
    return _enriched(jobs.drained(jobs.enrich_stream(raw), "enrich"))


def _windows(df: DataFrame) -> DataFrame:
    return df.withColumn("sentiment_sum", r("sentiment_sum"))


@query("stream_tumbling", WINDOWS_SQL)
def stream_tumbling(spark, folder):
    """All closed windows; the batch twin has the last, still open ones as well."""
    return _windows(jobs.drained(jobs.tumbling_stream(_posts(spark, folder), DAY), "tumbling"))


def _scored(spark, folder, width: str, processor: TrendState) -> DataFrame:
    """Two jobs with the table of closed windows between them. A last row without a tag says how far the first one came."""
    counts = jobs.tumbling_stream(_posts(spark, folder), width)
    table = scratch_path(spark, "windows")
    done = jobs.run_to_files(counts, table, scratch_path(spark, "windows-checkpoint"))
    edge = F.lit(jobs.watermark(done)).cast("timestamp") + F.make_dt_interval(secs=F.lit(processor.delay_us / 1_000_000))
    mark = spark.range(1).select(jobs.wall_time(edge).alias("window_start"), F.lit(0).cast("bigint").alias("n"))
    marks = scratch_path(spark, "marks")
    spark.createDataFrame([], counts.schema).unionByName(mark, allowMissingColumns=True).coalesce(1).write.parquet(marks)
    closed = readers.file_stream(spark, table, counts.schema).unionByName(readers.file_stream(spark, marks, counts.schema))
    with jobs.rocksdb_state(spark):
        return jobs.drained(score_stream(closed, processor), "scored")


@query(
    "stream_trend_state",
    f"""WITH RECURSIVE {CLOSED},
hits AS (SELECT * FROM closed WHERE zscore >= 0.5),
kept AS (
SELECT hashtag, min(window_start) AS window_start FROM hits GROUP BY hashtag
UNION ALL
SELECT k.hashtag, (SELECT min(h.window_start) FROM hits h
  WHERE h.hashtag = k.hashtag AND h.window_start >= k.window_start + INTERVAL 4 DAY)
FROM kept k WHERE EXISTS (SELECT 1 FROM hits h
  WHERE h.hashtag = k.hashtag AND h.window_start >= k.window_start + INTERVAL 4 DAY))
SELECT hashtag, window_start, n, history, round(baseline_mean, 6) AS baseline_mean, round(baseline_std, 6) AS baseline_std,
  round(zscore, 6) AS zscore, round(sentiment_shift, 10) + 0.0 AS sentiment_shift
FROM hits SEMI JOIN kept USING (hashtag, window_start)""",
)
def stream_trend_state(spark, folder):
    processor = TrendState(DAY_US, 7, 0.5, 4 * DAY_US, delay_us=2 * DAY_US)
    out = _scored(spark, folder, DAY, processor).where("emitted")
    return out.select(
        "hashtag",
        "window_start",
        "n",
        "history",
        r("baseline_mean"),
        r("baseline_std"),
        r("zscore"),
        r("sentiment_shift", 10),
    )


@query(
    "state_ttl",
    f"""WITH {sql.TAGGED},
edge AS (SELECT max(ts) - INTERVAL 2 HOUR AS watermark FROM tagged),
hourly AS (SELECT hashtag, time_bucket(INTERVAL 1 HOUR, ts) AS window_start, count(*) AS n FROM tagged GROUP BY ALL),
marked AS (SELECT *, CASE WHEN window_start - lag(window_start) OVER w > INTERVAL 2 HOUR THEN 1 ELSE 0 END AS fresh
FROM hourly WINDOW w AS (PARTITION BY hashtag ORDER BY window_start)),
eras AS (SELECT *, sum(fresh) OVER (PARTITION BY hashtag ORDER BY window_start) AS era FROM marked)
SELECT hashtag, window_start, n, least(7, date_diff('hour', min(window_start) OVER (PARTITION BY hashtag, era), window_start))
  AS history FROM eras, edge WHERE window_start + INTERVAL 1 HOUR <= watermark""",
)
def state_ttl(spark, folder):
    """Hourly windows; a tag silent for more than one whole hour is forgotten."""
    hour = DAY_US // 24
    processor = TrendState(hour, 7, 3.0, 0, forget=1, delay_us=2 * hour)
    return _scored(spark, folder, "1 hour", processor).select(
        "hashtag", "window_start", "n", "history"
    )


def _halves(spark, folder) -> tuple[DataFrame, DataFrame]:
    events = views.table(spark, folder, "events")
    border = F.lit("2024-01-16 00:00:00").cast("timestamp_ntz")
    return events.where(F.col("ts") < border), events.where(F.col("ts") >= border)


@query("state_recovery", WINDOWS_SQL)
def state_recovery(spark, folder):
    """Stop after the first half of the events, restart from the checkpoint with the second."""
    source, out, checkpoint = (scratch_path(spark, f"recovery-{x}") for x in ("in", "out", "state"))
    documents = views.table(spark, folder, "documents")
    for half in _halves(spark, folder):
        half.write.mode("append").parquet(source)
        stream = views.posts_from(readers.file_stream(spark, source, half.schema), documents)
        counts = jobs.tumbling_stream(stream, DAY)
        with jobs.rocksdb_state(spark):
            jobs.run_to_files(counts, out, checkpoint)
    return _windows(spark.read.schema(counts.schema).parquet(out))


@query("delivery", ENRICHED_SQL)
def delivery(spark, folder):
    """The checkpoint is lost and all files come again, in batches of another size: each row is delivered once."""
    raw = views.raw_messages(views.posts(spark, folder))
    topic, out = scratch_path(spark, "topic"), scratch_path(spark, "delivery")
    raw.repartition(12).write.parquet(topic)
    for files in (5, 3):
        records = readers.file_stream(spark, topic, readers.TOPIC_SCHEMA, files, "source_file")
        enriched = trends.enrich(trends.parse_posts(records, ["source_file"])[0])
        jobs.deliver_by_source(enriched, out, scratch_path(spark, "delivery-checkpoint"))
    return _enriched(spark.read.parquet(out))


@query(
    "scorer_recovery",
    f"""WITH {CLOSED}
SELECT hashtag, window_start, n, history, round(zscore, 6) AS zscore FROM closed""",
)
def scorer_recovery(spark, folder):
    """The keyed scorer stops with windows held in its state, and starts again from the checkpoint with the rest."""
    processor = TrendState(DAY_US, 7, 0.5, 4 * DAY_US, delay_us=2 * DAY_US)
    counts = jobs.tumbling_stream(_posts(spark, folder), DAY)
    table, source, out, check = (scratch_path(spark, f"scorer-{x}") for x in ("windows", "in", "out", "state"))
    jobs.run_to_files(counts, table, scratch_path(spark, "windows-checkpoint"))
    closed = spark.read.schema(counts.schema).parquet(table)
    border = F.lit("2024-01-16 00:00:00").cast("timestamp_ntz")
    last = closed.agg(F.max("window_start").alias("w")).first()["w"]
    mark = spark.range(1).select((F.lit(last) + F.make_dt_interval(days=F.lit(3))).alias("window_start"), F.lit(0).cast("bigint").alias("n"))
    end = spark.createDataFrame([], counts.schema).unionByName(mark, allowMissingColumns=True)
    for part in (closed.where(F.col("window_start") < border), closed.where(F.col("window_start") >= border), end):
        part.coalesce(1).write.mode("append").parquet(source)
        with jobs.rocksdb_state(spark):
            scored = score_stream(readers.file_stream(spark, source, counts.schema), processor)
            jobs.run_to_files(scored, out, check)
    found = spark.read.schema(scored.schema).parquet(out)
    return found.select("hashtag", "window_start", "n", "history", r("zscore"))


@query(
    "stream_latency",
    f"""WITH {sql.REQUEST_LOG},
edge AS (SELECT max(ts) - INTERVAL 2 HOUR AS watermark FROM request_log)
SELECT time_bucket(INTERVAL 1 DAY, ts) AS window_start, model_version, count(*) AS n, true AS close FROM request_log, edge
WHERE time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR <= watermark GROUP BY ALL""",
)
def stream_latency(spark, folder):
    """Hourly sketches of a stream, merged to days: the ranks of the percentiles are right within one percent."""
    events = _events(spark, folder)
    log = events.select(
        "ts", F.when(F.col("user_id") % 2 == 0, "v1").otherwise("v2").alias("model_version"), F.col("value").cast("double").alias("latency_ms")
    )
    hours = jobs.drained(jobs.latency_stream(log, "1 hour", "2 hours"), "latency")
    days = materialize(mn.sketch_percentiles(mn.merged_sketches(hours, DAY)), "days")
    border = hours.agg(F.max("window_start")).first()[0]
    exact = views.request_log(spark, folder).where(F.col("ts") < F.lit(border) + F.make_dt_interval(hours=F.lit(1)))
    exact = exact.select(F.window("ts", DAY).start.alias("window_start"), "model_version", F.col("latency_ms").cast("double").alias("latency_ms"))
    ranked = param_join(exact, days, ["window_start", "model_version"], "inner").groupBy("window_start", "model_version", "n")

    def close(name: str, p: float) -> Column:
        below, upto = F.avg((F.col("latency_ms") < F.col(name)).cast("int")), F.avg((F.col("latency_ms") <= F.col(name)).cast("int"))
        slack = 0.01 + 1 / F.count(F.lit(1))  # one row of a small group
        return (below <= p + slack) & (upto >= p - slack)

    return ranked.agg((close("p50", 0.5) & close("p95", 0.95) & close("p99", 0.99)).alias("close"))


@query(
    "late_rows",
    """WITH edge AS (SELECT max(ts) - INTERVAL 2 DAY AS watermark FROM events WHERE ts >= TIMESTAMP '2024-01-16 00:00:00')
SELECT time_bucket(INTERVAL 1 DAY, ts) AS window_start, count(*) AS n FROM events, edge
WHERE ts < TIMESTAMP '2024-01-16 00:00:00' AND time_bucket(INTERVAL 1 DAY, ts) + INTERVAL 1 DAY <= watermark GROUP BY ALL""",
)
def late_rows(spark, folder):
    """Events of the older half that come too late, kept in a table and counted by day."""
    source, out, checkpoint = (scratch_path(spark, f"late-rows-{x}") for x in ("in", "out", "state"))
    older, newer = _halves(spark, folder)
    for half in (newer, older):
        half.select("event_id", "ts").write.mode("append").parquet(source)
        stream = readers.file_stream(spark, source, half.select("event_id", "ts").schema)
        jobs.split_late(stream, out, checkpoint, DAY, 2 * 86_400)
    rows = spark.read.parquet(f"{out}/rows/*").where("late")
    return rows.groupBy(F.window("ts", DAY).start.alias("window_start")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "late_data",
    f"""WITH {sql.TAGGED},
edge AS (SELECT max(ts) - INTERVAL 2 DAY AS watermark FROM tagged),
kept AS (SELECT hashtag, time_bucket(INTERVAL 1 DAY, ts) AS window_start, count(*) AS n FROM tagged
WHERE ts >= TIMESTAMP '2024-01-16 00:00:00' GROUP BY ALL)
SELECT hashtag, window_start, n FROM kept, edge WHERE window_start + INTERVAL 1 DAY <= watermark""",
)
def late_data(spark, folder):
    """The older half of the events arrives after the newer one and is too late."""
    source, out, checkpoint = (scratch_path(spark, f"late-{x}") for x in ("in", "out", "state"))
    documents = views.table(spark, folder, "documents")
    older, newer = _halves(spark, folder)
    for half in (newer, older):
        half.write.mode("append").parquet(source)
        stream = views.posts_from(readers.file_stream(spark, source, half.schema), documents)
        counts = jobs.tumbling_stream(stream, DAY)
        jobs.run_to_files(counts, out, checkpoint)
    return spark.read.schema(counts.schema).parquet(out).select("hashtag", "window_start", "n")
