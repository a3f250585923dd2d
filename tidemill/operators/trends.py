"""Surges of hashtags: parse, enrich, count per window, score, alert.

Posts are counted per (tag, window) with map-side partial sums before any shuffle by tag, so a hot
tag costs no more than a cold one. Everything after the count works on at most one row per tag and
window.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemill.functions import posts as px
from tidemill.plans import decayed_sum, lookup_join, materialize, param_join
from tidemill.plans.ordered import cut_points, micros, with_range

# Default window length and alert threshold of the settings.
ROLLING_WINDOW = "60 seconds"
Z_THRESHOLD = 3.0

POST_SCHEMA = (
    "post_id bigint, ts timestamp_ntz, user_id bigint, text string, lang string, sentiment double"
)


def parse_posts(raw: DataFrame, keep: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Topic records -> (typed posts, rejected records). Columns in ``keep`` stay with the posts."""
    parsed = raw.withColumn(
        "_p",
        F.from_json(
            F.col("value").cast("string"),
            f"{POST_SCHEMA}, _bad string",
            {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"},
        ),
    )
    bad = F.col("_p").isNull() | F.col("_p._bad").isNotNull() | F.col("_p.post_id").isNull()
    good_rows = parsed.where(~bad).select("_p.*", *keep).drop("_bad")
    bad_rows = parsed.where(bad).select(*raw.columns)
    return good_rows, bad_rows


def enrich(posts: DataFrame) -> DataFrame:
    """Canonical language, bounded sentiment, hashtags."""
    return posts.withColumns(
        {
            "lang": px.language(F.col("lang")),
            "sentiment": px.bounded_sentiment(F.col("sentiment")),
            "hashtags": px.hashtags(F.col("text")),
        }
    )


def normalize_lang(posts: DataFrame, column: str = "lang") -> DataFrame:
    return posts.withColumn(column, px.language(F.col(column)))


def fill_sentiment(posts: DataFrame, column: str = "sentiment") -> DataFrame:
    return posts.withColumn(column, px.bounded_sentiment(F.col(column)))


def extract_hashtags(posts: DataFrame) -> DataFrame:
    """One row per (post, tag)."""
    return posts.withColumn("hashtag", F.explode(px.hashtags(F.col("text"))))


def extract_mentions(posts: DataFrame) -> DataFrame:
    return posts.withColumn("mention", F.explode(px.mentions(F.col("text"))))


def tumbling_counts(
    tagged: DataFrame, width: str = ROLLING_WINDOW, slide: str | None = None
) -> DataFrame:
    """Posts and sentiment sums per (tag, window); ``slide`` gives overlapping windows."""
    return (
        tagged.groupBy(F.window("ts", width, slide).alias("w"), "hashtag")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.coalesce(F.sum("sentiment"), F.lit(0.0)).alias("sentiment_sum"),
            F.count("sentiment").alias("sentiment_n"),
        )
        .select("hashtag", F.col("w.start").alias("window_start"), "n", "sentiment_sum", "sentiment_n")
    )


def densify_windows(counts: DataFrame, width: str = ROLLING_WINDOW) -> DataFrame:
    """Add zero rows for empty windows between the first and last activity of a tag.

    Each row fills the gap up to the next one, so no array ever spans a whole history.
    """
    step = F.expr(f"INTERVAL {width}")
    following = F.lead("window_start").over(W.partitionBy("hashtag").orderBy("window_start"))
    own = F.col("slot") == F.col("window_start")
    return (
        counts.withColumn("_until", F.coalesce(following - step, F.col("window_start")))
        .withColumn("slot", F.explode(F.sequence("window_start", "_until", step)))
        .select(
            "hashtag",
            F.col("slot").alias("window_start"),
            F.when(own, F.col("n")).otherwise(0).alias("n"),
            F.when(own, F.col("sentiment_sum")).otherwise(0.0).alias("sentiment_sum"),
            F.when(own, F.col("sentiment_n")).otherwise(0).alias("sentiment_n"),
        )
    )


def _previous(n_windows: int):
    return W.partitionBy("hashtag").orderBy("window_start").rowsBetween(-n_windows, -1)


def _weighted(frame) -> Column:
    posts = F.sum("sentiment_n").over(frame)
    return F.when(posts > 0, F.sum("sentiment_sum").over(frame) / posts)


def rolling_stats(dense: DataFrame, n_windows: int = 7) -> DataFrame:
    """Mean and sample deviation of the counts, and mean sentiment, of the previous windows."""
    back = _previous(n_windows)
    return dense.withColumns(
        {
            "history": F.count(F.lit(1)).over(back),
            "baseline_mean": F.avg("n").over(back),
            "baseline_std": F.stddev_samp("n").over(back),
            "baseline_sentiment": _weighted(back),
        }
    )


def zscore(stats: DataFrame, min_history: int = 2) -> DataFrame:
    known = (F.col("history") >= min_history) & (F.col("baseline_std") > 0)
    score = (F.col("n") - F.col("baseline_mean")) / F.col("baseline_std")
    return stats.withColumn("zscore", F.when(known, score))


def ewma(dense: DataFrame, width: str, alpha: float = 1 / 3, value: str = "n", out: str = "ewma") -> DataFrame:
    """s_0 = x_0, s_t = alpha x_t + (1 - alpha) s_(t-1), as a decayed sum over the window number."""
    first = F.min("window_start").over(W.partitionBy("hashtag"))
    step = F.expr(f"timestampdiff(MICROSECOND, window_start, window_start + INTERVAL {width})")
    seated = dense.withColumn(
        "_i", (F.timestamp_diff("MICROSECOND", first, F.col("window_start")) / step).cast("bigint")
    ).withColumn(
        "_x", F.when(F.col("_i") == 0, F.col(value).cast("double")).otherwise(F.col(value) * alpha)
    )
    return decayed_sum(seated, ["hashtag"], "_i", "_x", -math.log(1.0 - alpha), out).drop("_i", "_x")


def decayed_count(counts: DataFrame, tau_seconds: float, value: str = "n") -> DataFrame:
    """c_t = c_(t-1) exp(-dt / tau) + n_t at every window with posts."""
    timed = counts.withColumn("_t", micros(F.col("window_start")) / F.lit(1e6))
    return decayed_sum(timed, ["hashtag"], "_t", value, 1.0 / tau_seconds, "decayed").drop("_t")


def score_anomaly(
    scored: DataFrame, z_threshold: float = Z_THRESHOLD, ewma_limit: float | None = None
) -> DataFrame:
    """Candidate alerts: high z-score, or a count beyond ``ewma_limit`` times the previous EWMA."""
    hit = F.col("zscore") >= z_threshold
    if ewma_limit is not None:
        hit = hit | (F.col("n") >= F.lit(ewma_limit) * F.col("ewma_before"))
    return scored.where(hit)


def with_previous(dense: DataFrame, column: str, out: str) -> DataFrame:
    order = W.partitionBy("hashtag").orderBy("window_start")
    return dense.withColumn(out, F.lag(column).over(order))


def adaptive_threshold(
    scored: DataFrame, prob: float = 0.95, n_windows: int = 14, floor: float = 1.0
) -> DataFrame:
    """A threshold per tag and window: a quantile of its previous z-scores, at least ``floor``."""
    past = F.percentile("zscore", F.lit(prob)).over(_previous(n_windows))
    return scored.withColumn("threshold", F.greatest(past, F.lit(floor)))


def sentiment_shift(stats: DataFrame) -> DataFrame:
    now = F.when(F.col("sentiment_n") > 0, F.col("sentiment_sum") / F.col("sentiment_n"))
    return stats.withColumn("sentiment_shift", now - F.col("baseline_sentiment"))


def spike_magnitude(stats: DataFrame) -> DataFrame:
    return stats.withColumn("magnitude", F.try_divide(F.col("n"), F.col("baseline_mean")))


def sentiment_drift(dense: DataFrame, short: int = 3, long: int = 14) -> DataFrame:
    """Mean sentiment of the last ``short`` windows less that of the last ``long`` ones."""
    order = W.partitionBy("hashtag").orderBy("window_start")
    near = order.rowsBetween(1 - short, 0)
    far = order.rowsBetween(1 - long, 0)
    return dense.withColumn("drift", _weighted(near) - _weighted(far))


def _heads(slim: DataFrame, limit: int) -> DataFrame:
    """``(hashtag, _r, heads)``: for each range of a tag, the candidates by which it can be entered, and when the next one may be
    kept after the range, if it is entered there.

    An earlier range lets nothing pass before its last kept candidate plus ``limit``, so only candidates within ``limit`` of
    the first one, and the next after these, can be entries.
    """

    def summary(key: tuple, times: list[int]) -> pa.RecordBatch:
        at = np.array(times, np.int64)
        following = np.searchsorted(at, at + limit)
        leave = (at + limit).tolist()
        for i in range(len(leave) - 1, -1, -1):
            if following[i] < len(leave):
                leave[i] = leave[following[i]]
        n = min(int(np.searchsorted(at, at[0] + limit)) + 1, len(leave))
        heads = [{"at": t, "leave": e} for t, e in zip(times[:n], leave[:n], strict=True)]
        kind = pa.list_(pa.struct([("at", pa.int64()), ("leave", pa.int64())]))
        return pa.RecordBatch.from_arrays([pa.array([key[0]], pa.string()), pa.array([key[1]], pa.int32()), pa.array([heads], kind)], names=["hashtag", "_r", "heads"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, times = None, []
        for batch in batches:
            for tag, r, at in zip(*[batch.column(c).to_pylist() for c in ("hashtag", "_r", "_at")], strict=True):
                if (tag, r) != now:
                    if times:
                        yield summary(now, times)
                    now, times = (tag, r), []
                times.append(at)
        if times:
            yield summary(now, times)

    return slim.mapInArrow(run, "hashtag string, _r int, heads array<struct<at: bigint, leave: bigint>>")


def cooldown(candidates: DataFrame, seconds: float, ranges: int | None = None) -> DataFrame:
    """Keep a candidate only if ``seconds`` have passed since the last kept one of its tag.

    What is kept is the orbit of the first candidate under "the next one that may be kept". Time is cut into ranges, so a tag
    of any length spreads over tasks: each (tag, range) tells for its few possible entries when it is left again, these are
    followed from range to range, and then every range marks its own rows. All steps are linear.
    """
    limit = int(seconds * 1_000_000)
    placed = candidates.withColumn("_at", micros(F.col("window_start")))
    cut = materialize(with_range(placed, F.col("_at"), cut_points(placed, F.col("_at"), ranges), "_r"), "candidates")
    order = ["hashtag", "_r", "_at"]
    heads = _heads(cut.select(*order).repartition("hashtag", "_r").sortWithinPartitions(*order), limit)
    start = F.struct(F.lit(-(2**62)).cast("bigint").alias("allowed"), F.array().cast("array<struct<_r: int, allowed: bigint>>").alias("entered"))

    def through(acc: Column, x: Column) -> Column:
        entry = F.get(F.filter(x["heads"], lambda h: h["at"] >= acc["allowed"]), F.lit(0))
        seen = F.concat(acc["entered"], F.array(F.struct(x["_r"].alias("_r"), acc["allowed"].alias("allowed"))))
        return F.struct(F.coalesce(entry["leave"], acc["allowed"]).alias("allowed"), seen.alias("entered"))

    listed = heads.groupBy("hashtag").agg(F.sort_array(F.collect_list(F.struct("_r", "heads"))).alias("x"))  # a few entries per range
    entered = listed.select("hashtag", F.explode(F.aggregate("x", start, through, lambda acc: acc["entered"])).alias("e")).select("hashtag", "e.*")
    ready = param_join(cut, entered, ["hashtag", "_r"], "inner").repartition("hashtag", "_r").sortWithinPartitions(*order)

    names = candidates.columns

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, allowed = None, 0
        for batch in batches:
            keep = []
            for tag, r, at, first in zip(*[batch.column(c).to_pylist() for c in (*order, "allowed")], strict=True):
                if (tag, r) != now:
                    now, allowed = (tag, r), first
                keep.append(at >= allowed)
                if keep[-1]:
                    allowed = at + limit
            yield batch.select(names).filter(pa.array(keep, pa.bool_()))

    return ready.select(*names, *[c for c in (*order, "allowed") if c not in names]).mapInArrow(mark, candidates.schema)


def representative_posts(tagged: DataFrame, alerts: DataFrame, width: str, k: int = 3) -> DataFrame:
    """Ids of the ``k`` most opinionated posts of every alert window.

    The rank limit is applied before the shuffle as well, so a hot tag sends ``k`` rows per task.
    """
    windows = alerts.select("hashtag", "window_start").distinct()
    slotted = tagged.withColumn("window_start", F.window("ts", width).start)
    chosen = lookup_join(slotted, windows, ["hashtag", "window_start"], "inner")
    best = W.partitionBy("hashtag", "window_start").orderBy(
        F.coalesce(F.abs("sentiment"), F.lit(0.0)).desc(), "post_id"
    )
    return (
        chosen.select("hashtag", "window_start", "post_id", "sentiment")
        .withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .groupBy("hashtag", "window_start")
        .agg(F.sort_array(F.collect_list(F.struct("rank", "post_id"))).alias("_p"))
        .select(
            "hashtag", "window_start", F.transform("_p", lambda p: p["post_id"]).alias("post_ids")
        )
    )


def active_stats(counts: DataFrame, width: str = ROLLING_WINDOW, n_windows: int = 7) -> DataFrame:
    """:func:`rolling_stats` of the windows that have posts, without writing out the empty ones.

    Empty windows add nothing to the sums, so a range frame over the active windows and the number
    of windows since the first one give the same mean and deviation. A rare tag with a long life
    costs a few rows instead of one per window. Sums of squares are decimals, so nothing cancels.
    """
    step = pd.Timedelta(width).value // 1000
    tag = W.partitionBy("hashtag").orderBy("_at")
    back = tag.rangeBetween(-n_windows * step, -step)
    first = F.min("_at").over(W.partitionBy("hashtag").orderBy("_at").rowsBetween(W.unboundedPreceding, 0))
    k = F.least(F.lit(n_windows), ((F.col("_at") - first) / step).cast("bigint"))
    whole = F.col("n").cast("decimal(18,0)")
    zero = F.lit(0).cast("decimal(38,0)")
    sums = counts.withColumn("_at", micros(F.col("window_start"))).withColumns(
        {
            "history": k,
            "_s1": F.coalesce(F.sum(whole).over(back).cast("decimal(18,0)"), zero.cast("decimal(18,0)")),
            "_s2": F.coalesce(F.sum(whole * whole).over(back).cast("decimal(38,0)"), zero),
            "baseline_sentiment": _weighted(back),
        }
    )
    spread = (F.col("_s2") * F.col("history") - F.col("_s1") * F.col("_s1")).cast("double")
    pairs = F.col("history") * (F.col("history") - 1)
    return sums.withColumns(
        {
            "baseline_mean": F.try_divide(F.col("_s1").cast("double"), F.col("history")),
            "baseline_std": F.sqrt(F.try_divide(spread, pairs)),
        }
    ).drop("_at", "_s1", "_s2")


def score_windows(posts: DataFrame, width: str = ROLLING_WINDOW, n_windows: int = 7) -> DataFrame:
    """Posts -> scored windows per tag. Only windows with posts can be alerts."""
    counts = tumbling_counts(extract_hashtags(posts), width)
    return zscore(active_stats(counts, width, n_windows))


def trend_alerts(
    posts: DataFrame,
    width: str = ROLLING_WINDOW,
    n_windows: int = 7,
    z_threshold: float = Z_THRESHOLD,
    k: int = 3,
) -> DataFrame:
    """Posts -> alert rows with magnitude, sentiment shift and pointers to posts."""
    hits = score_anomaly(score_windows(posts, width, n_windows), z_threshold)
    alerts = spike_magnitude(sentiment_shift(hits)).select(
        "hashtag",
        "window_start",
        "n",
        "baseline_mean",
        "baseline_std",
        "zscore",
        "magnitude",
        "sentiment_shift",
    )
    alerts = materialize(alerts, "alerts")
    pointers = representative_posts(extract_hashtags(posts), alerts, width, k)
    return alerts.join(pointers, ["hashtag", "window_start"], "left")


def hashtag_top(tagged: DataFrame, k: int = 10, tracked: int = 10_000) -> DataFrame:
    """Approximate counts of the most frequent tags from a bounded sketch."""
    return tagged.agg(F.expr(f"approx_top_k(hashtag, {k}, {tracked})").alias("top")).select(
        F.explode("top").alias("t")
    ).select(F.col("t.item").alias("hashtag"), F.col("t.count").alias("n"))


def hashtag_sketch(tagged: DataFrame, eps: float = 0.001, confidence: float = 0.99) -> DataFrame:
    """A mergeable count-min sketch of all tags, as one binary value."""
    return tagged.agg(
        F.count_min_sketch("hashtag", F.lit(eps), F.lit(confidence), F.lit(1)).alias("sketch")
    )


HASH_ZERO = -1693959553  # Spark's hash of this number is 0, so it sets the seed for the columns after it


def hashtag_estimates(tagged: DataFrame, eps: float = 0.001, confidence: float = 0.99) -> DataFrame:
    """Every tag with its count as the sketch has it: never too low, and too high by more than ``eps`` times all
    rows with a probability of ``1 - confidence`` at most."""
    first, second = (F.hash(F.lit(HASH_ZERO), *["hashtag"] * k).cast("bigint") for k in (1, 2))
    tags = tagged.select("hashtag").distinct().select("hashtag", first.alias("h1"), second.alias("h2"))
    sketch = hashtag_sketch(tagged, eps, confidence)

    def number(at: str, size: int) -> str:
        return f"CAST(conv(hex(substring(sketch, CAST({at} AS INT), {size})), 16, 10) AS BIGINT)"

    # the sketch's layout: version, total, depth, width, a number per row, the rows
    rows = sketch.select("sketch", F.expr(number("13", 4)).alias("depth"), F.expr(number("17", 4)).alias("width"))
    cell = "abs(shiftright(shiftleft(h1 + i * h2, 32), 32) % width)"
    found = f"array_min(transform(sequence(0L, depth - 1), i -> {number(f'21 + 8 * (depth + i * width + {cell})', 8)}))"
    return tags.crossJoin(F.broadcast(rows)).select("hashtag", F.expr(found).alias("n"))


def ingest_quality(raw: DataFrame, width: str = "1 day") -> DataFrame:
    """Share of unreadable records, and of posts without language or sentiment, per window."""
    good, bad = parse_posts(raw)
    marked = good.select(
        "ts",
        F.lit(0).alias("bad"),
        F.col("lang").isNull().cast("int").alias("no_lang"),
        F.col("sentiment").isNull().cast("int").alias("no_sentiment"),
    ).unionByName(
        bad.select(F.col("timestamp").alias("ts"), F.lit(1).alias("bad")), allowMissingColumns=True
    )
    return (
        marked.groupBy(F.window("ts", width).start.alias("window_start"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.avg("bad").alias("bad_share"),
            F.avg("no_lang").alias("null_lang_share"),
            F.avg("no_sentiment").alias("null_sentiment_share"),
        )
    )


def alert_truth_join(alerts: DataFrame, truth: DataFrame) -> DataFrame:
    """Hits, false alarms and misses per tag; precision and recall, 0/0 being null."""
    keys = ["hashtag", "window_start"]
    both = alerts.select(*keys, F.lit(1).alias("a")).join(
        truth.select(*keys, F.lit(1).alias("t")), keys, "full_outer"
    )
    counts = both.groupBy("hashtag").agg(
        F.count_if(F.col("a").isNotNull() & F.col("t").isNotNull()).alias("tp"),
        F.count_if(F.col("t").isNull()).alias("fp"),
        F.count_if(F.col("a").isNull()).alias("fn"),
    )
    return counts.withColumns(
        {
            "precision": F.try_divide(F.col("tp"), F.col("tp") + F.col("fp")),
            "recall": F.try_divide(F.col("tp"), F.col("tp") + F.col("fn")),
        }
    )
