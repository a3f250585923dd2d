"""Continuous jobs: enrich posts, count tags per window, deliver, restart.

Every job is a plain transformation plus :func:`run_to_files`, which drains what the source offers
and stops. Long-running use starts the same transformation with a processing-time trigger.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.functions.posts import hashtags
from tidemill.operators import monitor, trends
from tidemill.plans.ordered import micros
from tidemill.plans.scratch import scratch_path

ROCKS_DB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"


def instant(ts: Column) -> Column:
    """Zone-free time as an instant, read as UTC; watermarks need instants."""
    return F.timestamp_micros(micros(ts))


def wall_time(ts: Column) -> Column:
    """The inverse of :func:`instant`, whatever the session time zone."""
    seconds = F.unix_micros(ts) / F.lit(1_000_000)
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return epoch + F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))


@contextmanager
def rocksdb_state(spark: SparkSession) -> Iterator[None]:
    """Keep the state of queries started inside on local disk with changelog checkpoints."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKS_DB)
    try:
        yield
    finally:
        spark.conf.unset(PROVIDER) if before is None else spark.conf.set(PROVIDER, before)


def run_to_files(stream: DataFrame, out: str, checkpoint: str, mode: str = "append"):
    """Drain the source into Parquet files, exactly once per checkpoint."""
    query = (
        stream.writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .outputMode(mode)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def drained(stream: DataFrame, name: str) -> DataFrame:
    """Run a stream to its end in fresh folders and read the result."""
    spark = stream.sparkSession
    out = scratch_path(spark, name)
    run_to_files(stream, out, scratch_path(spark, f"{name}-checkpoint"))
    return spark.read.schema(stream.schema).parquet(out)


def process_texts(stream: DataFrame) -> DataFrame:
    """Each record's text, unchanged."""
    return stream.select("text")


def enrich_stream(raw: DataFrame) -> DataFrame:
    """Raw topic records -> enriched posts; unreadable records go to :func:`rejected_stream`."""
    return trends.enrich(trends.parse_posts(raw)[0])


def rejected_stream(raw: DataFrame) -> DataFrame:
    return trends.parse_posts(raw)[1]


def tumbling_stream(posts: DataFrame, width: str, delay: str | None = None) -> DataFrame:
    """Closed windows per tag. A window closes, and its state goes, once the watermark passes it.

    The watermark trails the latest post by two windows unless ``delay`` says otherwise; posts older
    than that are dropped and show up in the query progress.
    """
    if delay is None:
        count, unit = width.split(maxsplit=1)
        delay = f"{2 * int(count)} {unit}"
    tagged = (
        posts.withColumn("at", instant(F.col("ts")))
        .withWatermark("at", delay)
        .select("at", "sentiment", F.explode(hashtags(F.col("text"))).alias("hashtag"))
    )
    return (
        tagged.groupBy(F.window("at", width).alias("w"), "hashtag")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.coalesce(F.sum("sentiment"), F.lit(0.0)).alias("sentiment_sum"),
            F.count("sentiment").alias("sentiment_n"),
        )
        .select(
            "hashtag",
            wall_time(F.col("w.start")).alias("window_start"),
            "n",
            "sentiment_sum",
            "sentiment_n",
        )
    )


def late_rows(query) -> int:
    """Late rows in the recent progress reports of a query, as its operators count them: a stateful aggregation counts what
    is left after its tasks have added up, and Spark keeps the last reports only. :func:`split_late` counts all rows."""
    return sum(
        op["numRowsDroppedByWatermark"]
        for progress in query.recentProgress
        for op in progress["stateOperators"]
    )


def split_late(stream: DataFrame, out: str, checkpoint: str, width: str, delay_seconds: int, ts: str = "ts"):
    """Write every row of a stream with ``late``: its window was over before its batch, by the watermark that
    :func:`tumbling_stream` works with.

    The latest time of each batch is written beside its rows (``_marks``), so the watermark of a batch is known from the
    batches before it, after restarts as well. A repeated batch replaces its folders.
    """
    spark = stream.sparkSession
    end = F.unix_micros(F.window(instant(F.col(ts)), width).end)

    def write(batch: DataFrame, batch_id: int) -> None:
        spark.createDataFrame([(batch_id, None)], "id bigint, latest bigint").coalesce(1).write.mode("overwrite").parquet(f"{out}/_marks/batch={batch_id}")
        marks = spark.read.schema("id bigint, latest bigint").parquet(f"{out}/_marks/*")
        latest = marks.where(F.col("id") < batch_id).agg(F.max("latest")).first()[0]
        edge = None if latest is None else latest - delay_seconds * 1_000_000
        late = F.lit(False) if edge is None else F.coalesce(end <= edge, F.lit(False))
        batch.withColumn("late", late).write.mode("overwrite").parquet(f"{out}/rows/batch={batch_id}")
        mark = batch.agg(F.lit(batch_id).cast("bigint").alias("id"), F.max(micros(F.col(ts))).alias("latest"))
        mark.coalesce(1).write.mode("overwrite").parquet(f"{out}/_marks/batch={batch_id}")

    query = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def latency_stream(log: DataFrame, width: str, delay: str, by: str = "model_version") -> DataFrame:
    """Closed windows of a request log with the count and a mergeable sketch of the latencies of each group."""
    timed = log.withColumn("at", instant(F.col("ts"))).withWatermark("at", delay)
    sketched = timed.groupBy(F.window("at", width).alias("w"), by).agg(*monitor.sketched("latency_ms"))
    return sketched.select(wall_time(F.col("w.start")).alias("window_start"), by, "n", "sketch")


def watermark(query) -> str:
    """The last event-time watermark of a query; what lies before it is closed."""
    known = (p["eventTime"]["watermark"] for p in query.recentProgress if "watermark" in p["eventTime"])
    return max(known, default="1970-01-01T00:00:00.000Z")


def deliver_by_source(stream: DataFrame, out: str, checkpoint: str, source: str = "source_file"):
    """``foreachBatch`` sink that may run again, with other batches as well, without losing or doubling rows.

    ``source`` names the file that a row was read from. A file is read by one batch as a whole, whatever the size of
    batches; what comes of it owns a folder, which is replaced as a whole when the file is read again.
    """
    kept = [c for c in stream.columns if c != source]

    def write(batch: DataFrame, batch_id: int) -> None:
        owned = batch.select(*kept, F.sha1(source).alias("source"))
        owned.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("source").parquet(out)

    query = (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query
