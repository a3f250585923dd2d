"""Streams against their batch twins, restarts and late posts."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemill.operators import monitor as mn
from tidemill.operators import trends
from tidemill.plans.scratch import scratch_path
from tidemill.sources import readers, views
from tidemill.streaming import jobs
from tidemill.streaming.trend_state import TrendState, score_stream

T0 = datetime(2024, 1, 1)
SCHEMA = "post_id bigint, ts timestamp_ntz, user_id bigint, text string, lang string, sentiment double"


def write(spark, path, rows):
    df = spark.createDataFrame([(i, T0 + timedelta(seconds=s), 1, t, "en", 0.5) for i, (s, t) in enumerate(rows)], SCHEMA)
    df.coalesce(1).write.mode("append").parquet(path)


def closed(spark, folder_in, out, checkpoint):
    stream = jobs.tumbling_stream(readers.file_stream(spark, folder_in, SCHEMA, 1), "60 seconds")
    query = jobs.run_to_files(stream, out, checkpoint)
    rows = spark.read.schema(stream.schema).parquet(out).collect()
    return query, sorted((r["hashtag"], (r["window_start"] - T0).seconds, r["n"]) for r in rows)


def test_times_survive_the_detour(spark):
    df = spark.createDataFrame([(T0,), (datetime(1969, 12, 31, 23, 59, 59, 500_000),)], "ts timestamp_ntz")
    back = df.select(jobs.wall_time(jobs.instant(F.col("ts"))).alias("b"), "ts")
    assert back.where("b = ts").count() == 2


def test_windows_close_restart_and_drop_late_posts(spark):
    source, out, check = (scratch_path(spark, x) for x in ("in", "out", "check"))
    write(spark, source, [(5, "#a"), (6, "#A #b"), (70, "#a"), (200, "#c")])
    _, first = closed(spark, source, out, check)
    # watermark 200 - 120 = 80: only the first minute is over
    assert first == [("a", 0, 2), ("b", 0, 1)]
    write(spark, source, [(71, "#a"), (400, "#c")])
    query, second = closed(spark, source, out, check)
    assert second == [("a", 0, 2), ("a", 60, 2), ("b", 0, 1), ("c", 180, 1)]
    write(spark, source, [(10, "#late"), (700, "#c")])
    query, third = closed(spark, source, out, check)
    assert ("late", 0, 1) not in third and ("c", 360, 1) in third
    assert jobs.late_rows(query) == 1


def test_state_scores_like_the_batch(spark, folder):
    """The same windows in several micro-batches, with a gap between them."""
    rows = [(t, m, 1 + (m * m * k) % 17) for k, t in ((3, "a"), (5, "b")) for m in range(40) if m % 9 != 4 and not 20 < m < 24]
    counts = spark.createDataFrame(
        [(t, T0 + timedelta(minutes=m), n, 0.25 * n, n) for t, m, n in rows],
        "hashtag string, window_start timestamp_ntz, n bigint, sentiment_sum double, sentiment_n bigint",
    )
    source, out, check = (scratch_path(spark, x) for x in ("counts", "scored", "check"))
    for low, high in ((0, 15), (15, 28), (28, 40)):
        part = counts.where(F.minute("window_start").between(low, high - 1))
        part.coalesce(1).write.mode("append").parquet(source)
        stream = readers.file_stream(spark, source, counts.schema)
        with jobs.rocksdb_state(spark):
            scored = score_stream(stream, TrendState(60_000_000, 5, 1.0, 300_000_000))
            jobs.run_to_files(scored, out, check)
    got = spark.read.schema(scored.schema).parquet(out)
    batch = trends.zscore(trends.rolling_stats(trends.densify_windows(counts, "1 minute"), 5)).where("n > 0")
    cols = ["hashtag", "window_start", "n", "history", "zscore"]
    a, b = (sorted(map(tuple, df.select(*cols).collect()), key=lambda r: r[:2]) for df in (got, batch))
    for x, y in zip(a, b, strict=True):
        assert x[:4] == y[:4]
        assert (x[4] is None and y[4] is None) or x[4] == pytest.approx(y[4])
    kept = trends.cooldown(trends.score_anomaly(batch, 1.0).select("hashtag", "window_start", "n"), 300)
    emitted = got.where("emitted").select("hashtag", "window_start", "n")
    assert sorted(map(tuple, kept.collect())) == sorted(map(tuple, emitted.collect()))


def test_repeated_delivery_leaves_each_row_once(spark):
    """The same files in batches of other sizes, one more file, and a checkpoint that goes on."""
    source, out, check = (scratch_path(spark, x) for x in ("in", "out", "check"))
    for k in range(7):
        write(spark, source, [(k, f"#t{k}"), (k, f"#u{k}"), (k, f"#t{k}")])  # equal rows are rows of their own

    def deliver(per_batch, checkpoint):
        jobs.deliver_by_source(readers.file_stream(spark, source, SCHEMA, per_batch, "source_file"), out, checkpoint)
        return sorted(r["text"] for r in spark.read.parquet(out).collect())

    once = sorted(t for k in range(7) for t in (f"#t{k}", f"#u{k}", f"#t{k}"))
    assert deliver(2, check) == once
    assert deliver(3, scratch_path(spark, "check")) == once
    assert deliver(1, scratch_path(spark, "check")) == once
    write(spark, source, [(9, "#new")])
    assert deliver(2, check) == sorted([*once, "#new"])


def test_late_rows_are_kept_and_counted(spark):
    """Many batches, a restart, and a progress history that is too short for them."""
    source, out, check = (scratch_path(spark, x) for x in ("in", "out", "check"))
    seconds = [10, 200, 30, 205, 70, 400, 130, 100, 410, 275, 420, 500, 10, 375]
    late, latest = [], None
    for s in seconds:
        if latest is not None and s // 60 * 60 + 60 <= latest - 120:
            late.append(s)
        latest = s if latest is None else max(latest, s)
    for part in (seconds[:8], seconds[8:]):
        for s in part:
            write(spark, source, [(s, "#a"), (s, "#b #c")])
        stream = readers.file_stream(spark, source, SCHEMA, 1)
        jobs.split_late(stream, out, check, "60 seconds", 120)
    rows = spark.read.parquet(f"{out}/rows/*")
    got = sorted((r["ts"] - T0).seconds for r in rows.where("late").collect())
    assert got == sorted(2 * late) and rows.count() == 2 * len(seconds)


def test_scorer_restarts_with_windows_held(spark):
    """Its state holds windows when it stops; after the restart the rows are those of one run."""
    schema = "hashtag string, window_start timestamp_ntz, n bigint, sentiment_sum double, sentiment_n bigint"
    files = [[1, 2, 4], [3, 5], [8], [7, 20]]
    found = {}
    for name, stops in (("once", [4]), ("restarted", [2, 3, 4])):
        source, out, check = (scratch_path(spark, x) for x in ("counts", "scored", "check"))
        begun = 0
        for stop in stops:
            for days in files[begun:stop]:
                rows = [(t, T0 + timedelta(days=d), 1 + (d * d * k) % 7, 0.5, 1) for d in days for k, t in ((3, "a"), (5, "b"))]
                spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
            begun = stop
            with jobs.rocksdb_state(spark):
                processor = TrendState(86_400_000_000, 5, 0.5, 0, delay_us=3 * 86_400_000_000)
                scored = score_stream(readers.file_stream(spark, source, schema, 1), processor)
                jobs.run_to_files(scored, out, check)
                if stop == 2:
                    held = spark.read.format("statestore").option("stateVarName", "held").load(check)
                    assert held.count() > 0
        found[name] = sorted(map(str, spark.read.schema(scored.schema).parquet(out).collect()))
    assert found["restarted"] == found["once"] and len(found["once"]) == 14


def test_sketches_merge(spark):
    """Percentiles of hours merged to a day are within the rank error of the day."""
    log = spark.range(20_000).select(
        (F.lit(T0).cast("timestamp_ntz") + F.make_dt_interval(secs=(F.col("id") * 4).cast("decimal(18,6)"))).alias("ts"),
        F.lit("v1").alias("model_version"),
        F.pow(F.col("id") * 7919 % 20_011, F.lit(1.5)).alias("latency_ms"),
    )
    path = scratch_path(spark, "log")
    log.write.parquet(path)
    hours = jobs.drained(jobs.latency_stream(readers.file_stream(spark, path, log.schema), "1 hour", "2 hours"), "latency")
    [day] = mn.sketch_percentiles(mn.merged_sketches(hours, "1 day")).collect()
    closed = sorted(r["latency_ms"] for r in log.where(F.col("ts") < hours.agg(F.max("window_start")).first()[0] + timedelta(hours=1)).collect())
    assert day["n"] == len(closed)
    for name, p in (("p50", 0.5), ("p95", 0.95), ("p99", 0.99)):
        rank = sum(x <= day[name] for x in closed) / len(closed)
        assert abs(rank - p) < 0.01


def test_topic_records_are_split(spark, folder):
    path = scratch_path(spark, "raw")
    raw = views.raw_messages(views.posts(spark, folder))
    raw.write.parquet(path)
    stream = readers.file_stream(spark, path, readers.TOPIC_SCHEMA)
    good = jobs.drained(jobs.enrich_stream(stream), "good").count()
    bad = jobs.drained(jobs.rejected_stream(stream), "bad").count()
    assert good + bad == raw.count() and bad == raw.where("offset % 50 = 0").count()


def test_batches_do_not_change_scores(spark):
    """Windows out of order in many batches against all in one; what comes after the watermark is counted."""
    schema = "hashtag string, window_start timestamp_ntz, n bigint, sentiment_sum double, sentiment_n bigint"
    files = [[1, 3], [2], [6, 4], [5], [9], [12, 11], [10], [20]]
    runs = {}
    for name, per_batch, delay, parts in (("one", None, 3, files), ("many", 1, 3, files), ("late", 1, 3, [*files, [2, 8], [30]]), ("arrival", 1, None, files)):
        source, out, check = (scratch_path(spark, x) for x in ("counts", "scored", "check"))
        for days in parts:
            rows = [(t, T0 + timedelta(days=d), 1 + (d * d * k) % 7, 0.5, 1) for d in days for k, t in ((3, "a"), (5, "b"))]
            spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
        processor = TrendState(86_400_000_000, 5, 0.5, 0, delay_us=delay and delay * 86_400_000_000)
        with jobs.rocksdb_state(spark):
            scored = score_stream(readers.file_stream(spark, source, schema, per_batch), processor)
            query = jobs.run_to_files(scored, out, check)
        found = spark.read.schema(scored.schema).parquet(out).collect()
        runs[name] = sorted((tuple(r) for r in found), key=lambda r: r[:2]), jobs.late_rows(query)
    assert runs["one"] == runs["many"] and runs["one"][1] == 0
    assert [(r[1] - T0).days for r in runs["one"][0] if r[0] == "a"] == [1, 2, 3, 4, 5, 6, 9, 10, 11, 12]
    assert runs["late"][1] == 4 and [r for r in runs["late"][0] if r[1] < T0 + timedelta(days=20)] == runs["one"][0]
    assert {(r[1] - T0).days for r in runs["arrival"][0] if r[-1]} == {2, 5, 10}  # marked, not lost in silence
