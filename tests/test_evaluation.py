from __future__ import annotations

import itertools
import math
import random
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from tidemill.functions.hashing import hash_bucket
from tidemill.operators import boosting as bo
from tidemill.operators import evaluate as ev
from tidemill.operators import models as mo
from tidemill.operators import monitor as mn
from tidemill.operators import trials as tr
from tidemill.sources import views

T0 = datetime(2024, 1, 1)


def scored(spark, rows):
    return spark.createDataFrame(rows, "label int, score double")


@pytest.fixture(scope="module")
def random_scores(spark):
    rng = random.Random(3)
    rows = [(int(rng.random() < 0.4), round(rng.random(), 2)) for _ in range(800)] + [(1, 0.5)] * 300
    return rows


def brute_auc(rows):
    pos = [s for y, s in rows if y == 1]
    neg = [s for y, s in rows if y == 0]
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


def test_auc_with_a_hot_tied_score(spark, random_scores):
    assert ev.auc_roc(scored(spark, random_scores)).first()[0] == pytest.approx(brute_auc(random_scores))


def test_auc_is_unchanged_by_a_monotone_map(spark, random_scores):
    mapped = [(y, math.exp(5 * s) - 7) for y, s in random_scores]
    assert ev.auc_roc(scored(spark, mapped)).first()[0] == pytest.approx(brute_auc(random_scores))


def test_known_auc(spark, folder):
    preds = views.predictions(spark, folder)
    assert ev.auc_roc(preds).first()[0] == pytest.approx(0.791041815, abs=1e-9)
    judge = BinaryClassificationEvaluator(labelCol="label", rawPredictionCol="score", numBins=0)
    assert judge.evaluate(preds) == pytest.approx(0.791041815, abs=1e-6)


def test_one_class_has_no_auc(spark):
    assert ev.auc_roc(scored(spark, [(1, 0.2), (1, 0.3)])).first()[0] is None
    assert ev.auc_pr(scored(spark, [(1, 0.2), (1, 0.3)])).first()[0] == 1.0


def test_average_precision(spark, random_scores):
    total, found, out = sum(y for y, _ in random_scores), 0, 0.0
    for s in sorted({s for _, s in random_scores}, reverse=True):
        above = [y for y, t in random_scores if t >= s]
        gained = sum(above) - found
        found = sum(above)
        out += gained / total * found / len(above)
    assert ev.auc_pr(scored(spark, random_scores)).first()[0] == pytest.approx(out)


def test_threshold_metrics(spark):
    rows = scored(spark, [(1, 0.9), (1, 0.5), (1, 0.4), (0, 0.6), (0, 0.1)])
    cells = ev.confusion_matrix(rows).first()
    assert (cells["tp"], cells["tn"], cells["fp"], cells["fn"]) == (2, 1, 1, 1)
    m = ev.classification_metrics(rows, beta=2.0).first()
    assert (m["accuracy"], m["precision"], m["recall"], m["specificity"]) == (0.6, 2 / 3, 2 / 3, 0.5)
    assert m["f1"] == pytest.approx(2 / 3) and m["f_beta"] == pytest.approx(2 / 3)
    nothing = ev.classification_metrics(scored(spark, [(0, 0.1)])).first()
    assert (nothing["precision"], nothing["recall"], nothing["f1"]) == (0.0, 0.0, 0.0)


def test_lift_parts_cover_all_rows(spark, random_scores):
    parts = ev.lift_curve(scored(spark, random_scores)).orderBy("part").collect()
    assert sum(p["n"] for p in parts) == len(random_scores)
    assert parts[-1]["gain"] == 1.0


def test_log_loss_clips(spark):
    assert ev.log_loss(scored(spark, [(1, 0.0)])).first()[0] == pytest.approx(-math.log(1e-15))


def log(spark, rows):
    return spark.createDataFrame(
        [(i, T0 + timedelta(seconds=s), "v1", st, ms) for i, (s, st, ms) in enumerate(rows)],
        "request_id bigint, ts timestamp_ntz, model_version string, status int, latency_ms double",
    )


def test_alerts(spark):
    rows = [(i, 500 if i < 11 else 200, 100.0) for i in range(50)] + [(60 + i, 200, 900.0) for i in range(20)]
    frame = log(spark, rows)
    assert [r["errors"] for r in mn.error_count_alert(frame).collect()] == [11]
    assert [r["window_start"] for r in mn.error_rate_alert(frame, "1 minute").collect()] == [T0]
    assert [r["window_start"] for r in mn.latency_alert(frame, "1 minute").collect()] == [T0 + timedelta(minutes=1)]


def test_sustained_alert_needs_consecutive_windows(spark):
    hot = {0, 1, 2, 4, 5, 9, 10, 11, 12}
    rows = [("cpu", T0 + timedelta(minutes=m), 95.0 if m in hot else 10.0) for m in range(14) if m != 11]
    frame = spark.createDataFrame(rows, "resource string, ts timestamp_ntz, value double")
    got = sorted((r["run_start"].minute, r["n_windows"]) for r in mn.sustained_alert(frame, "1 minute", 90.0, 2).collect())
    assert got == [(0, 3), (4, 2), (9, 2)]


def test_drift_is_zero_for_equal_periods(spark):
    a = spark.createDataFrame([(float(i % 37),) for i in range(500)], "x double")
    same = mn.feature_drift(a, a, "x").first()
    assert (same["psi"], same["ks"]) == (0.0, 0.0)
    moved = mn.feature_drift(a, a.select((F.col("x") + 100).alias("x")), "x").first()
    assert moved["ks"] == 1.0 and moved["psi"] > 1


def test_pareto_against_all_pairs(spark, folder):
    trials = views.trials(spark, folder)
    rows = [(r["study"], r["trial"], r["auc"], r["model_kb"]) for r in trials.collect()]
    expected = {
        r[:2]
        for r in rows
        if not any(q[0] == r[0] and q[2] >= r[2] and q[3] <= r[3] and (q[2] > r[2] or q[3] < r[3]) for q in rows)
    }
    assert {(r["study"], r["trial"]) for r in tr.pareto_front(trials, "auc", "model_kb").collect()} == expected


def test_best_trial_ties_and_direction(spark):
    rows = spark.createDataFrame([(1, 0, 0.5), (1, 1, 0.9), (1, 2, 0.9), (1, 3, 0.1)], "study int, trial int, auc double")
    assert tr.best_trial(rows, "auc").first()["trial"] == 1
    assert tr.best_trial(rows, "auc", "minimize").first()["trial"] == 3


def test_retention(spark):
    rows = [("m", v, "Production" if v == 2 else "Staging", datetime(2024, v, 1)) for v in range(1, 8)]
    frame = spark.createDataFrame(rows, "name string, version int, stage string, trained_at timestamp_ntz")
    got = {r["version"]: r["action"] for r in tr.retention_rank(frame, "2024-07-15 00:00:00").collect()}
    assert got == {1: "archive", 2: "keep", 3: "archive", 4: "archive", 5: "keep", 6: "keep", 7: "keep"}


def test_loss_history_has_the_last_step(spark):
    rows = [(s, split, s + d) for s in range(8) for split, d in (("train", 0.0), ("val", 0.5))]
    frame = spark.createDataFrame(rows, "step bigint, split string, loss double")
    got = sorted(map(tuple, tr.loss_history(frame, 3).collect()))
    assert got == [(s, float(s), s + 0.5) for s in (0, 3, 6, 7)]


def test_shapley_values_add_up(spark):
    names = ["a", "b", "c"]
    rows = spark.createDataFrame([(1, 1.0, 2.0, 3.0), (2, -1.0, 0.5, 0.0)], "id int, a double, b double, c double")
    base = {"a": 0.5, "b": 1.0, "c": -1.0}

    def score(x):
        return x["a"] * x["b"] + x["c"] * x["c"]

    got = mo.sampled_shapley(rows, "id", names, base, score, 20).collect()
    for row in rows.collect():
        total = sum(r["value"] for r in got if r["id"] == row["id"])
        assert total == pytest.approx(row["a"] * row["b"] + row["c"] ** 2 - (0.5 + 1.0))


def test_permutation_keeps_values_and_finds_the_feature(spark):
    rows = spark.range(3000).select("id", (F.col("id") % 100 / 100).alias("a"), F.rand(1).alias("b")).withColumn(
        "label", (F.col("a") > 0.5).cast("int")
    )
    moved = mo.permuted(rows, "id", "a", 3)
    assert rows.select("a").exceptAll(moved.select("a")).count() == 0
    assert moved.join(rows.select("id", F.col("a").alias("old")), "id").where("a <> old").count() > 2500

    def loss(df):
        return df.agg(F.avg(F.pow(F.col("a") - F.col("label"), F.lit(2.0)) + 0 * F.col("b")))

    got = {r["feature"]: r["importance"] for r in mo.permutation_importance(rows, "id", ["a", "b"], loss).collect()}
    assert got["a"] > 0.1 and got["b"] == pytest.approx(0.0)


def table(spark, n=600):
    rows = spark.range(n).select("id", (F.col("id") % 10).cast("double").alias("a"), F.rand(3).alias("b"))
    return rows.withColumn("label", (F.col("a") + F.col("b") >= 5).cast("int"))


def test_models_learn(spark):
    rows = table(spark).withColumn("a", F.when(F.col("id") % 50 != 0, F.col("a")))
    model = mo.train_classifier(rows, "id", ["a", "b"], params=bo.TreeParams(trees=4, max_depth=3))
    out = mo.batch_predict(model, rows, "v1", "id", "label")
    assert ev.auc_roc(out).first()[0] > 0.97
    assert out.where((F.col("predicted") == 1) != (F.col("score") >= 0.5)).isEmpty()


def grown_plainly(rows, params, trees):
    """A learner without histograms: every cut of every node tried on all rows. Rows are (values, label)."""

    def total(part, margin):
        p = [1 / (1 + math.exp(-margin[i])) for i in part]
        return sum(p) - sum(rows[i][1] for i in part), sum(q * (1 - q) for q in p)

    def shrunk(g):
        return math.copysign(max(abs(g) - params.reg_alpha, 0.0), g)

    def score(g, h):
        return shrunk(g) ** 2 / (h + params.reg_lambda) if h + params.reg_lambda else 0.0

    def split(part, margin, depth):
        g, h = total(part, margin)
        best = None
        if depth < params.max_depth:
            for f in range(len(rows[0][0])):
                for cut in sorted({rows[i][0][f] for i in part}):
                    left = [i for i in part if rows[i][0][f] <= cut]
                    right = [i for i in part if rows[i][0][f] > cut]
                    (gl, hl), (gr, hr) = total(left, margin), total(right, margin)
                    gain = 0.5 * (score(gl, hl) + score(gr, hr) - score(g, h)) - params.gamma
                    if right and min(hl, hr) >= params.min_child_weight and gain > 1e-9 and (best is None or round(gain, 9) > best[0]):
                        best = (round(gain, 9), left, right)
        if best is None:
            for i in part:
                added[i] = -params.learning_rate * shrunk(g) / (h + params.reg_lambda)
        else:
            split(best[1], margin, depth + 1)
            split(best[2], margin, depth + 1)

    margin = [0.0] * len(rows)
    for _ in range(trees):
        added = [0.0] * len(rows)
        split(list(range(len(rows))), margin, 0)
        margin = [m + a for m, a in zip(margin, added, strict=True)]
    return [1 / (1 + math.exp(-m)) for m in margin]


def small(seed, n=120):
    rng = random.Random(seed)
    rows = [((float(rng.randint(0, 9)), float(rng.randint(0, 4)), float(rng.randint(0, 1))), 0) for _ in range(n)]
    return [(x, int(x[0] + 2 * x[1] * x[2] + rng.random() * 4 > 7)) for x, _ in rows]


PLAIN = [
    {"max_depth": 3},
    {"max_depth": 4, "gamma": 0.3, "reg_alpha": 0.5, "min_child_weight": 2.0},
    {"max_depth": 2, "reg_lambda": 0.0, "learning_rate": 0.3},
]


@pytest.mark.parametrize("node_rows", [50_000, 40, 0])
def test_trees_grown_together_equal_a_plain_learner(spark, node_rows):
    """Whole trees in tasks, small nodes in tasks, and all nodes level by level."""
    rows = small(1)
    df = spark.createDataFrame([(i, *x, y) for i, (x, y) in enumerate(rows)], "id bigint, a double, b double, c double, label int").repartition(3)
    params = [bo.TreeParams(trees=3, subsample=1.0, colsample=1.0, patience=0, **p) for p in PLAIN]
    models = [bo.Model(i, p) for i, p in enumerate(params)]
    boosters = bo.fit_many(df, "id", ["a", "b", "c"], models, "label", F.lit(0), node_rows=node_rows)
    for p, booster in zip(params, boosters, strict=True):
        got = {r["id"]: r["score"] for r in bo.predict(booster, df, "id").collect()}
        assert [got[i] for i in range(len(rows))] == pytest.approx(grown_plainly(rows, p, 3), abs=1e-6)


def test_folds_equal_separately_fitted_models(spark):
    rows = table(spark, 400)
    params = bo.TreeParams(trees=3, max_depth=2)
    folds = {r["fold"]: r for r in mo.cross_validate(rows, "id", ["a", "b"], 3, params=params).collect()}
    fold = hash_bucket(F.col("id"), mo.SEED, 3).cast("int")
    for k in range(3):
        model = bo.Model(0, params, k)
        [alone] = bo.fit_many(rows, "id", ["a", "b"], [model], "label", fold)
        left = bo.predict(alone, rows.where(fold == k), "label")
        assert folds[k]["auc"] == pytest.approx(ev.auc_roc(left).first()[0]) and folds[k]["n"] == left.count()
        assert folds[k]["auc"] > 0.9


def test_training_stops_without_gain(spark):
    noise = spark.range(500).select("id", F.rand(1).alias("a"), (F.rand(2) > 0.5).cast("int").alias("label"))
    model = bo.Model(0, bo.TreeParams(trees=60, max_depth=4, learning_rate=0.3, patience=3), 1)
    [fitted] = bo.fit_many(noise, "id", ["a"], [model], "label", mo.validation_part("id"))
    assert len(model.trees) < 60 and len(fitted.trees) == model.best <= len(model.trees) - 3


def test_saved_models_score_alike(spark, tmp_path):
    rows = table(spark, 200).withColumn("b", F.when(F.col("id") % 7 != 0, F.col("b")))
    model = mo.train_classifier(rows, "id", ["b", "a"], params=bo.TreeParams(trees=3, max_depth=3))
    model.save(spark, str(tmp_path / "m"))
    loaded = bo.Booster.load(spark, str(tmp_path / "m"))
    assert bo.predict(loaded, rows, "id").exceptAll(bo.predict(model, rows, "id")).isEmpty()


def test_tree_attributions(spark):
    """All orders of four features give the exact values; sampled ones add up as well."""
    rng = np.random.default_rng(1)
    x = rng.random((60, 4))
    data = [(i, *map(float, r), int(r[0] + r[1] * r[2] > 0.8)) for i, r in enumerate(x)]
    df = spark.createDataFrame(data, "id bigint, a double, b double, c double, d double, label int")
    names = ["a", "b", "c", "d"]
    model = mo.train_classifier(df, "id", names, params=bo.TreeParams(trees=4, max_depth=3, min_child_weight=0.5))
    base = dict.fromkeys(names, 0.5)
    start = model.score(np.full((1, 4), 0.5))[0]
    few = mo.tree_shapley(model, df, "id", base, permutations=7).groupBy("id").agg(F.sum("value").alias("v"))
    ends = model.score(x)
    assert [r["v"] for r in few.orderBy("id").collect()] == pytest.approx([e - start for e in ends])
    exact = {}
    for i in range(5):
        for order in itertools.permutations(range(4)):
            z = np.full((1, 4), 0.5)
            for f in order:
                before = model.score(z)[0]
                z[0, f] = x[i, f]
                exact[i, names[f]] = exact.get((i, names[f]), 0.0) + (model.score(z)[0] - before) / 24
    many = {(r["id"], r["feature"]): r["value"] for r in mo.tree_shapley(model, df.limit(5), "id", base, 2000).collect()}
    assert many == pytest.approx(exact, abs=0.05)


def test_grouped_auc(spark, random_scores):
    rows = scored(spark, random_scores)
    both = rows.withColumn("g", F.lit(1)).unionByName(rows.withColumn("label", 1 - F.col("label")).withColumn("g", F.lit(2)))
    one = brute_auc(random_scores)
    got = {r["g"]: r["auc_roc"] for r in ev.auc_roc_by(both, "g").collect()}
    assert got == pytest.approx({1: one, 2: 1 - one})


def test_draws_cover_all_nine_ranges():
    draws = mo.random_params(300)
    assert draws == mo.random_params(300) and len(mo.SEARCH_SPACE) == 9
    for name, (low, high, kind) in mo.SEARCH_SPACE.items():
        values = [d[name] for d in draws]
        assert low <= min(values) and max(values) <= high and max(values) - min(values) > 0.8 * (high - low)
        assert kind != "int" or {min(values), max(values)} <= set(range(low, high + 1))


def test_binned_trees_find_the_leaves_that_walking_finds():
    """Trees of at most 64 leaves by words of bits, larger ones step by step."""
    rng = np.random.default_rng(3)
    bins = rng.integers(0, 66, (3, 5000)).astype(np.uint8)
    label = (bins[0] + bins[1] * rng.random(5000) > 60).astype(float)
    for depth, most in ((0, 1), (3, 8), (6, 64), (9, 512)):
        tree = bo.grow_subtree(bins, 0.5 - label, np.full(5000, 0.25), bo.TreeParams(min_child_weight=0.5), depth, 66).arrays()
        found = bo.BinnedTree(tree, 3, 66)
        assert len(found.leaves) <= most and (found.masks is None) == (len(found.leaves) > 64)
        plain = []
        for row in bins.T:
            k = 0
            while tree[0][k] >= 0:
                k = tree[2][k] + int(row[tree[0][k]] > tree[1][k])
            plain.append(k)
        assert found.nodes(bins).tolist() == plain


def test_trees_of_a_small_table_take_one_job_each(spark, monkeypatch):
    monkeypatch.setattr(bo, "_sums", None)  # the sums of single levels
    rows = table(spark, 60_000)
    [fitted] = bo.fit_many(rows, "id", ["a", "b"], [bo.Model(0, bo.TreeParams(trees=1, max_depth=2, colsample=1.0))], "label", F.lit(0))
    assert ev.auc_roc(bo.predict(fitted, rows, "label")).first()[0] > 0.9


def test_rows_that_agree_share_an_entry(spark):
    """However many rows agree, ranges stay about equal; each row is in an entry of its bins and label once."""
    rows = [(i if i % 9 else None, 1.0 if i < 3000 else float(i % 7), None if i % 5 == 0 else float(i % 3), None if i == 8 else int(i % 2)) for i in range(4000)]
    df = spark.createDataFrame(rows, "id bigint, a double, b double, label int").repartition(3)
    cuts, part = bo.fit_cuts(df, ["a", "b"]), F.when(F.col("id") % 4 == 0, 1).otherwise(0)
    blocks = bo.pack(bo.bin_rows(df, "id", ["a", "b"], "label", part, cuts), 2)
    found, n, per_task = [], 0, {}
    for b in blocks.withColumn("task", F.spark_partition_id()).collect():
        cells = np.frombuffer(b["bins"] + b["label"], np.uint8).reshape(3, b["n"]).T
        starts = np.frombuffer(b["starts"], np.int32) if b["starts"] else np.arange(b["n"])
        sizes = np.diff(np.append(starts, len(b["part"])))
        found += zip(map(tuple, np.repeat(cells, sizes, 0).tolist()), np.frombuffer(b["ids"], "<i8").tolist(), list(b["part"]), strict=True)
        n, per_task[b["task"]] = n + b["n"], per_task.get(b["task"], 0) + len(b["part"])
    keys = {r["id"]: r["h"] for r in df.select("id", F.xxhash64("id").alias("h")).distinct().collect()}
    place = [[0 if v is None else 1 + sum(c < v for c in cut) for v in column] for cut, column in zip(cuts, list(zip(*rows, strict=True))[1:3], strict=True)]
    wanted = [((x, y, r[3]), keys[r[0]], int(r[0] is not None and r[0] % 4 == 0)) for x, y, r in zip(*place, rows, strict=True) if r[3] is not None]
    assert sorted(found) == sorted(wanted)
    assert n <= len({w[0] for w in wanted}) + 4 + len(blocks.collect())
    assert len(per_task) == 4 and max(per_task.values()) < 1800


@pytest.mark.parametrize("node_rows", [50_000, 40, 0])
def test_repeated_rows_count_as_often_as_they_come(spark, node_rows):
    rows = [r for k, r in enumerate(small(2)) for _ in range(1 + k % 3)]
    df = spark.createDataFrame([(i, *x, y) for i, (x, y) in enumerate(rows)], "id bigint, a double, b double, c double, label int").repartition(3)
    params = bo.TreeParams(trees=3, max_depth=3, subsample=1.0, colsample=1.0, patience=0)
    [booster] = bo.fit_many(df, "id", ["a", "b", "c"], [bo.Model(0, params)], "label", F.lit(0), node_rows=node_rows)
    got = {r["id"]: r["score"] for r in bo.predict(booster, df, "id").collect()}
    assert [got[i] for i in range(len(rows))] == pytest.approx(grown_plainly(rows, params, 3), abs=1e-6)


@pytest.mark.parametrize("node_rows", [50_000, 0])
def test_samples_and_losses_count_rows(spark, node_rows):
    """One feature of few values: the same model when a second, useless one keeps rows apart."""
    rows = spark.range(3000).select("id", (F.col("id") % 5).cast("double").alias("a"), F.col("id").cast("double").alias("z"))
    rows = rows.withColumn("label", ((F.col("a") + F.rand(5) * 4) > 4).cast("int"))
    fitted = []
    for cuts in ([list(map(float, range(5))), []], [list(map(float, range(5))), [40.0 * k for k in range(63)]]):
        model = bo.Model(0, bo.TreeParams(trees=9, max_depth=1, colsample=1.0, min_child_weight=200.0, gamma=1.0), 1)
        bo.fit_many(rows, "id", ["a", "z"], [model], "label", mo.validation_part("id"), cuts, node_rows)
        fitted.append(model)
    assert {f for t in fitted[1].trees for f in t.feature} == {-1, 0}
    assert [t.feature for t in fitted[0].trees] == [t.feature for t in fitted[1].trees]
    assert [v for t in fitted[0].trees for v in t.value] == pytest.approx([v for t in fitted[1].trees for v in t.value])
    assert len(fitted[0].losses) == 10 and fitted[0].losses == pytest.approx(fitted[1].losses)


def test_trees_of_many_rows_with_few_values_take_one_job_each(spark, monkeypatch):
    monkeypatch.setattr(bo, "_sums", None)  # the sums of single levels
    rows = table(spark, 300_000).withColumn("b", F.round("b", 1))
    [fitted] = bo.fit_many(rows, "id", ["a", "b"], [bo.Model(0, bo.TreeParams(trees=2, max_depth=2, colsample=1.0))], "label", F.lit(0))
    assert ev.auc_roc(bo.predict(fitted, rows, "label")).first()[0] > 0.9


def test_margins_are_written_seldom_where_entries_have_many_rows(spark, monkeypatch):
    assert [bo._keep_rounds(*x) for x in ((0, 0, 1), (100, 100, 1), (100, 40, 1), (10**9, 100, 1), (10**9, 100, 5), (10**9, 100, 50))] == [4, 4, 8, 32, 6, 4]
    writes, write = [], bo._with_margins
    monkeypatch.setattr(bo, "_with_margins", lambda *a: writes.append(1) or write(*a))
    rows = table(spark, 2000).withColumn("b", F.round("b", 1))
    bo.fit_many(rows, "id", ["a", "b"], [bo.Model(0, bo.TreeParams(trees=8, max_depth=2))], "label", F.lit(0))
    assert not writes


def test_models_of_a_small_table_take_one_job_together(spark, monkeypatch):
    """The same trees and losses as tree by tree, with samples of rows and columns and an early stop, in one job for all trees."""
    rows = table(spark, 3000).withColumns({"c": F.round(F.rand(8), 1), "b": F.when(F.col("id") % 7 != 0, F.col("b"))})
    rows = rows.withColumn("label", F.when(F.rand(9) < 0.5, F.col("id") % 2).otherwise(F.col("label")).cast("int"))
    rows = rows.unionByName(rows.limit(50)).repartition(3).localCheckpoint()
    params = [bo.TreeParams(trees=40, max_depth=4, learning_rate=0.5, patience=2), bo.TreeParams(trees=6, max_depth=2, learning_rate=0.3, colsample=0.5), bo.TreeParams(trees=3, max_depth=0)]

    def fitted(part):
        models = [bo.Model(i, p, part, 7 + i) for i, p in enumerate(params)]
        bo.fit_many(rows, "id", ["a", "b", "c"], models, "label", mo.validation_part("id"))
        return models

    for part in (1, None):
        with monkeypatch.context() as patch:
            patch.setattr(bo, "MODEL_ROWS", 0)
            single = fitted(part)
        with monkeypatch.context() as patch:
            patch.setattr(bo, "_subtrees", None)  # the job of a round
            together = fitted(part)
        for a, b in zip(single, together, strict=True):
            assert [list(t.feature) for t in a.trees] == [list(t.feature) for t in b.trees]
            assert [(list(t.cut), list(t.left)) for t in a.trees] == [(list(t.cut), list(t.left)) for t in b.trees]
            assert [v for t in a.trees for v in t.value] == pytest.approx([v for t in b.trees for v in t.value])
            assert a.losses == pytest.approx(b.losses) and a.best == b.best and a.done == b.done
        assert part is None or len(together[0].trees) < 40
