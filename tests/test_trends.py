from __future__ import annotations

import math
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemill.operators import trends

T0 = datetime(2024, 1, 1)


def posts(spark, rows):
    return spark.createDataFrame(
        rows, "post_id bigint, ts timestamp_ntz, user_id bigint, text string, lang string, sentiment double"
    )


def counts_frame(spark, rows):
    """rows of (tag, minute, n)."""
    return spark.createDataFrame(
        [(t, T0 + timedelta(minutes=m), n, 0.5 * n, n) for t, m, n in rows],
        "hashtag string, window_start timestamp_ntz, n bigint, sentiment_sum double, sentiment_n bigint",
    )


def test_hashtags_of_a_post(spark):
    df = posts(spark, [(1, T0, 1, "#Bär #bär x#Y_1 # #😀 @Ann", None, None), (2, T0, 1, "none", None, None)])
    assert sorted(r["hashtag"] for r in trends.extract_hashtags(df).collect()) == ["bär", "y_1"]
    assert [r["mention"] for r in trends.extract_mentions(df).collect()] == ["ann"]


def test_parse_splits_bad_records(spark):
    values = ['{"post_id": 1, "ts": "2024-01-01T00:00:01", "user_id": 2, "text": "#a", "lang": "en", "sentiment": 0.5}', "{bad", "", '{"text": "no id"}']
    raw = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "offset bigint, value string")
    good, bad = trends.parse_posts(raw.withColumn("value", F.col("value").cast("binary")))
    assert [r["post_id"] for r in good.collect()] == [1]
    assert sorted(r["offset"] for r in bad.collect()) == [1, 2, 3]


def test_enrich(spark):
    rows = [(1, T0, 1, "#A #b", "EN-us", 7.0), (2, T0, 1, "x", None, None), (3, T0, 1, "x", "pt_BR", -3.0)]
    out = trends.enrich(posts(spark, rows)).orderBy("post_id").collect()
    assert [(r["lang"], r["sentiment"], r["hashtags"]) for r in out] == [
        ("en", 1.0, ["a", "b"]),
        ("und", 0.0, []),
        ("pt", -1.0, []),
    ]


def test_densify_fills_gaps_only_inside_the_life_of_a_tag(spark):
    dense = trends.densify_windows(counts_frame(spark, [("a", 0, 5), ("a", 3, 1), ("b", 2, 2)]), "1 minute")
    got = sorted((r["hashtag"], (r["window_start"] - T0).seconds // 60, r["n"]) for r in dense.collect())
    assert got == [("a", 0, 5), ("a", 1, 0), ("a", 2, 0), ("a", 3, 1), ("b", 2, 2)]


def test_zscore_needs_history_and_spread(spark):
    flat = counts_frame(spark, [("a", m, 4) for m in range(5)] + [("a", 5, 9)])
    scored = trends.zscore(trends.rolling_stats(trends.densify_windows(flat, "1 minute"), 3))
    assert all(r["zscore"] is None for r in scored.collect())
    rough = counts_frame(spark, [("a", 0, 1), ("a", 1, 3), ("a", 2, 8)])
    scored = trends.zscore(trends.rolling_stats(trends.densify_windows(rough, "1 minute"), 3))
    last = scored.orderBy(F.col("window_start").desc()).first()
    assert last["zscore"] == pytest.approx((8 - 2) / 2**0.5)


def test_active_stats_agree_with_the_dense_ones(spark):
    rng = random.Random(5)
    rows = [(t, m, rng.randrange(1, 50)) for t in "abc" for m in rng.sample(range(300), 80)]
    counts = counts_frame(spark, rows)
    dense = trends.rolling_stats(trends.densify_windows(counts, "1 minute"), 6).where("n > 0")
    sparse = trends.active_stats(counts, "1 minute", 6)
    cols = ["hashtag", "window_start", "n", "history", "baseline_mean", "baseline_std", "baseline_sentiment"]
    a, b = (sorted(map(tuple, df.select(*cols).collect()), key=lambda r: r[:2]) for df in (dense, sparse))
    for x, y in zip(a, b, strict=True):
        assert x[:4] == y[:4]
        for p, q in zip(x[4:], y[4:], strict=True):
            assert (p is None and q is None) or p == pytest.approx(q, abs=1e-9)


@pytest.mark.parametrize("limit", [1, 7, 100, 5000])
def test_cooldown_follows_a_long_run_through_many_ranges(spark, limit):
    """One tag with adjacent candidates in all ranges, one with gaps longer than ranges, one with a single row."""
    rng = random.Random(limit)
    minutes = {"hot": list(range(6000)), "gaps": sorted(rng.sample(range(6000), 40)), "one": [17]}
    frame = counts_frame(spark, [(t, m, 1) for t, ms in minutes.items() for m in ms]).repartition(3)
    kept = trends.cooldown(frame, limit * 60, ranges=25)
    got = sorted((r["hashtag"], round((r["window_start"] - T0).total_seconds() / 60)) for r in kept.collect())
    expected = []
    for t, ms in minutes.items():
        last = -math.inf
        for m in ms:
            if m - last >= limit:
                expected.append((t, m))
                last = m
    assert got == sorted(expected)


def test_cooldown_of_a_million_adjacent_candidates(spark):
    at = F.lit(T0).cast("timestamp_ntz") + F.make_dt_interval(secs=F.col("id").cast("decimal(18,6)"))
    frame = spark.range(1_000_000).select(F.lit("hot").alias("hashtag"), at.alias("window_start"), F.lit(1).alias("n"))
    kept = trends.cooldown(frame, 3)
    assert kept.agg(F.count(F.lit(1)), F.sum((F.unix_timestamp(F.col("window_start").cast("timestamp")) % 3))).first()[0] == 333_334


def test_cooldown_without_candidates(spark):
    assert trends.cooldown(counts_frame(spark, [("a", 1, 1)]).limit(0), 60).isEmpty()


def test_cooldown_is_greedy(spark):
    rng = random.Random(7)
    minutes = {t: sorted(rng.sample(range(400), 120)) for t in ("hot", "b")}
    frame = counts_frame(spark, [(t, m, 1) for t, ms in minutes.items() for m in ms]).repartition(5)
    got = sorted((r["hashtag"], (r["window_start"] - T0).total_seconds() / 60) for r in trends.cooldown(frame, 600).collect())
    expected = []
    for t, ms in minutes.items():
        last = None
        for m in ms:
            if last is None or m - last >= 10:
                expected.append((t, m))
                last = m
    assert got == sorted(expected)


def test_ewma_follows_the_recursion(spark):
    values = [4, 0, 0, 9, 1, 7]
    dense = trends.densify_windows(counts_frame(spark, [("a", i, v) for i, v in enumerate(values) if v]), "1 minute")
    out = [r["ewma"] for r in trends.ewma(dense, "1 minute", 0.3).orderBy("window_start").collect()]
    s = None
    for v, got in zip(values, out, strict=True):
        s = v if s is None else 0.3 * v + 0.7 * s
        assert got == pytest.approx(s)


def test_planted_burst_is_the_top_alert(spark, folder):
    from __spark_entry__ import entry

    top = entry(spark).orderBy(F.col("zscore").desc()).first()
    assert (top["hashtag"], top["window_start"], top["n"]) == ("breaking", datetime(2024, 1, 15), 26)
    assert top["zscore"] == pytest.approx(63.120067)
    assert entry(spark).count() == 4


def test_alerts_do_not_depend_on_the_partitioning(spark, folder):
    from tidemill.sources import views

    base = views.posts(spark, folder)
    results = [
        sorted(str(r[:3]) for r in trends.trend_alerts(base.repartition(n), "1 day").collect()) for n in (1, 16)
    ]
    assert results[0] == results[1]


def test_alert_precision(spark):
    a = counts_frame(spark, [("a", 0, 1), ("a", 1, 1), ("b", 0, 1)])
    t = counts_frame(spark, [("a", 1, 1), ("a", 2, 1)])
    got = {r["hashtag"]: (r["tp"], r["fp"], r["fn"], r["precision"], r["recall"]) for r in trends.alert_truth_join(a, t).collect()}
    assert got == {"a": (1, 1, 1, 0.5, 0.5), "b": (0, 1, 0, 0.0, None)}


def test_sketch_is_one_small_value(spark):
    df = spark.createDataFrame([(f"t{i % 7}",) for i in range(500)], "hashtag string")
    rows = trends.hashtag_sketch(df).collect()
    assert len(rows) == 1 and len(rows[0]["sketch"]) > 0
    assert {r["hashtag"]: r["n"] for r in trends.hashtag_top(df, 7).collect()}["t0"] == 72


def test_every_tag_gets_an_estimate(spark):
    df = spark.range(60_000).selectExpr("concat('täg', CAST(floor(sqrt(id)) * 20 + id % 20 AS STRING)) AS hashtag")
    exact = {r["hashtag"]: r["count"] for r in df.groupBy("hashtag").count().collect()}
    got = {r["hashtag"]: r["n"] for r in trends.hashtag_estimates(df).collect()}
    assert len(exact) > 4000 and got.keys() == exact.keys()
    assert all(got[t] >= n for t, n in exact.items())
    assert sum(got[t] - n > 60 for t, n in exact.items()) <= 0.01 * len(exact)
