"""Range-wise plans against brute force, with hot keys and many ranges."""

from __future__ import annotations

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemill.plans import asof_fill, decayed_sum, exact_quantiles, lookup_join, prefix_sum, previous, running
from tidemill.plans.ordered import ranked_ids


@pytest.fixture(scope="module")
def keyed(spark):
    rng = random.Random(1)
    rows = [("hot" if rng.random() < 0.4 else f"k{rng.randrange(20)}", i, rng.randrange(100)) for i in rng.sample(range(10_000), 1_500)]
    return spark.createDataFrame(rows, "k string, i bigint, v bigint").repartition(7)


@pytest.mark.parametrize("ranges", [1, 3, 16])
@pytest.mark.parametrize("descending", [False, True])
def test_prefix_sum(keyed, ranges, descending):
    out = prefix_sum(keyed, "i", ["v"], ["k"], descending, ranges).toPandas()
    expected = keyed.toPandas().sort_values("i", ascending=not descending)
    expected["cum_v"] = expected.groupby("k")["v"].cumsum()
    pd.testing.assert_frame_equal(
        out.sort_values("i").reset_index(drop=True), expected.sort_values("i").reset_index(drop=True)
    )


def test_prefix_sum_over_everything(keyed):
    out = prefix_sum(keyed, "i", ["v"], ranges=9).toPandas().sort_values("i")
    assert out["cum_v"].tolist() == out["v"].cumsum().tolist()


def test_running_max_of_earlier_rows(keyed):
    out = running(keyed, "i", {"m": ("max", "v")}, ["k"], inclusive=False, ranges=6).toPandas().sort_values("i")
    expected = out.groupby("k")["v"].transform(lambda v: v.cummax().shift())
    assert out["m"].astype("float").fillna(-1).tolist() == expected.fillna(-1).tolist()


def test_previous(keyed):
    out = previous(keyed, "i", ["v"], ["k"], ranges=6).toPandas().sort_values("i")
    expected = out.groupby("k")["v"].shift()
    assert out["prev_v"].astype("float").fillna(-1).tolist() == expected.fillna(-1).tolist()


@pytest.mark.parametrize("ranges", [None, 1, 5, 40])
def test_exact_quantiles(keyed, ranges):
    probs = [0.0, 0.1, 0.5, 0.95, 1.0]
    out = exact_quantiles(keyed, "v", probs, ["a", "b", "c", "d", "e"], ["k"], ranges).toPandas()
    values = keyed.toPandas().groupby("k")["v"]
    assert len(out) == values.ngroups
    for row in out.itertuples():
        np.testing.assert_allclose(row[2:], np.quantile(values.get_group(row.k), probs))


def test_exact_quantiles_ignore_nulls_and_take_doubles(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,), (None,)], "v double")
    assert exact_quantiles(df, "v", [0.5], ["m"]).first()["m"] == 2.5


def test_ranges_give_the_same_result_for_any_partitioning(keyed):
    rows = [
        sorted(map(tuple, prefix_sum(keyed.repartition(n), "i", ["v"], ["k"], ranges=5).collect()))
        for n in (1, 7, 64)
    ]
    assert rows[0] == rows[1] == rows[2]


@pytest.mark.parametrize("ranges", [1, 8])
def test_asof_fill(spark, ranges):
    rng = random.Random(2)
    rows, n = [], 0
    for _ in range(600):
        key = 0 if rng.random() < 0.4 else rng.randrange(1, 9)
        rows.append((key, pd.Timestamp("2024-01-01") + pd.Timedelta(minutes=n), rng.randrange(2), n))
        n += 1
    rng.shuffle(rows)
    pdf = pd.DataFrame(rows, columns=["k", "ts", "tie", "n"])
    pdf["val"] = pdf["n"].where(pdf["tie"] == 0)
    df = spark.createDataFrame(
        [(int(k), ts.to_pydatetime(), int(t), int(i), None if t else int(i)) for k, ts, t, i in rows],
        "k int, ts timestamp_ntz, tie int, n int, val int",
    )
    got = {r["n"]: r["val"] for r in asof_fill(df, ["k"], "ts", "tie", ["val"], ranges).collect()}
    last: dict = {}
    for row in pdf.sort_values("n").itertuples():
        if row.tie == 0:
            last[row.k] = row.n
        assert got[row.n] == last.get(row.k)


@pytest.mark.parametrize("rate", [0.01, 0.4, 3.0])
def test_decayed_sum(spark, rate):
    rng = random.Random(3)
    rows = [(k, float(t), float(rng.randrange(1, 9))) for k in "ab" for t in rng.sample(range(5_000), 300)]
    df = spark.createDataFrame(rows, "k string, t double, x double")
    got = {(r["k"], r["t"]): r["s"] for r in decayed_sum(df, ["k"], "t", "x", rate, "s").collect()}
    for key in "ab":
        state, before = 0.0, None
        for _, t, x in sorted(r for r in rows if r[0] == key):
            state = x + (state * np.exp(-rate * (t - before)) if before is not None else 0.0)
            before = t
            assert got[(key, t)] == pytest.approx(state, rel=1e-9)


def test_ranked_ids(spark):
    words = sorted({f"{chr(97 + i % 26)}{i * 7919 % 1000}" for i in range(700)} | {"é", "Z", "😀", ""})
    df = spark.createDataFrame([(w,) for w in words], "w string").repartition(5)
    got = {r["w"]: r["id"] for r in ranked_ids(df, "w", "id", ranges=9).collect()}
    assert got == {w: i for i, w in enumerate(sorted(words, key=lambda w: w.encode()))}


@pytest.mark.parametrize("how", ["left", "inner"])
def test_lookup_beyond_the_broadcast_limit(spark, how):
    big = spark.createDataFrame(
        [("hot" if i % 3 == 0 else f"k{i % 50}", i) for i in range(900)] + [(None, -1)], "k string, i int"
    )
    dim = spark.createDataFrame([("hot", 1)] + [(f"k{j}", j) for j in range(40)], "k string, d int")
    expected = sorted(map(str, big.join(dim, ["k"], how).collect()))
    assert sorted(map(str, lookup_join(big, dim, ["k"], how, max_rows=5).collect())) == expected
    assert sorted(map(str, lookup_join(big, dim, ["k"], how).collect())) == expected


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def gathered(df) -> list[str]:
    """What each single-partition exchange of a plan gathers."""
    lines = plan(df).splitlines()
    return [lines[i + 1].strip() for i, line in enumerate(lines) if "Exchange SinglePartition" in line]


def test_no_large_table_in_one_task(spark, keyed, folder):
    """Only tables of one row per range, and final aggregates, may meet in a single partition."""
    from tidemill.operators import corpus as co
    from tidemill.operators import evaluate as ev
    from tidemill.operators import trends
    from tidemill.sources import views

    placed = co.placed(views.corpus(spark, folder))
    curve = prefix_sum(ev.score_counts(views.predictions(spark, folder)), "score", ["pos"], ranges=8)
    tagged = trends.extract_hashtags(views.posts(spark, folder))
    dense = trends.densify_windows(trends.tumbling_counts(tagged, "1 day"), "1 day")
    smooth = trends.ewma(dense, "1 day")
    cuts = exact_quantiles(views.passengers(spark, folder), "fare", [0.25, 0.5], ["a", "b"], ranges=8)
    groups = exact_quantiles(keyed, "v", [0.5], ["m"], ["k"], ranges=8)
    assert "Window" not in plan(placed)  # texts are not put in order, only their lengths were
    for df in (prefix_sum(keyed, "i", ["v"], ranges=8), curve):
        assert gathered(df) and all("HashAggregate(keys=[_r" in line for line in gathered(df))
    for df in (smooth, groups, placed):
        assert gathered(df) == []
    assert all("HashAggregate(keys=[" in line for line in gathered(cuts))


def test_rank_limit_applies_before_the_shuffle(spark, folder):
    from tidemill.operators import trends
    from tidemill.sources import views

    tagged = trends.extract_hashtags(views.posts(spark, folder))
    alerts = trends.score_anomaly(trends.score_windows(views.posts(spark, folder), "1 day"))
    text = plan(trends.representative_posts(tagged, alerts, "1 day"))
    assert "WindowGroupLimit" in text and "Partial" in text


def test_scans_read_only_what_is_needed(spark, folder):
    from tidemill.operators import trends
    from tidemill.sources import views

    text = plan(trends.tumbling_counts(trends.extract_hashtags(views.posts(spark, folder)), "1 day"))
    assert "props" not in text
    assert "n_chars" not in text and "source" not in text


def test_large_tables_get_more_ranges_than_partitions(keyed):
    from tidemill.plans.ordered import cut_points

    assert len(cut_points(keyed, F.col("i"))) == 7
    many = cut_points(keyed, F.col("i"), rows_per_range=20)
    assert 60 < len(many) < 75 and many == sorted(set(many))
    assert cut_points(keyed.where("i < 0"), F.col("i")) == []
