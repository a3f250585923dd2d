from __future__ import annotations

import statistics

import pytest
from pyspark.sql import functions as F

from tidemill.operators import features as ft
from tidemill.operators import lookups as lk
from tidemill.operators import profile as pf
from tidemill.operators import validation as va
from tidemill.plans.scratch import scratch_path
from tidemill.sources import views


@pytest.fixture(scope="module")
def people(spark):
    rows = [
        (1, 0, 3, "A, Mr. X", "male", 20.0, 1, 0, "t1", 5.0, None, "S"),
        (2, 1, 1, "B, Mrs. Y", "female", None, 0, 0, "t2", 80.0, "C85", "C"),
        (3, 1, 1, "C, Miss. Z", "female", 30.0, 0, 2, "t3", None, "D1", "S"),
        (4, 0, 3, "D, the Countess. Q", "male", None, 0, 0, "t1", 7.0, None, None),
        (5, 0, 3, "E, Mr. W", "male", 40.0, 4, 1, "t5", 9.0, None, "C"),
        (6, 1, 2, "F, Mr. V", "male", None, 0, 0, "t6", 9.0, None, "Q"),
    ]
    schema = (
        "passenger_id bigint, survived int, pclass int, name string, sex string, age double, sibsp int,"
        " parch int, ticket string, fare double, cabin string, embarked string"
    )
    return spark.createDataFrame(rows, schema)


def values(df, column, key="passenger_id"):
    return {r[key]: r[column] for r in df.select(key, column).collect()}


def test_group_median_falls_back_to_the_overall_one(people):
    keys = ["pclass", "sex"]
    out = ft.impute_group_median(people, "age", keys, ft.fit_median(people, "age", keys), ft.fit_median(people, "age"))
    assert values(out, "age") == {1: 20.0, 2: 30.0, 3: 30.0, 4: 30.0, 5: 40.0, 6: 30.0}


def test_medians_in_one_pass(people):
    medians = ft.fit_medians(people, ft.MEDIANS)
    groups = ft.pick_medians(medians, "fare_median", people, ["pclass"])
    assert dict(groups.dtypes) == {"pclass": "int", "median": "double"}
    assert {r["pclass"]: r["median"] for r in groups.collect()} == {1: 80.0, 2: 9.0, 3: 7.0}
    overall = ft.pick_medians(medians, "age_median_all", people, [])
    assert overall.first()["median"] == 30.0


def test_mode_takes_the_smallest_of_equals(people):
    assert ft.fit_mode(people, "embarked").first()["mode"] == "C"
    filled = ft.impute_scalar(people, "embarked", ft.fit_mode(people, "embarked"))
    assert values(filled, "embarked")[4] == "C"


def test_titles(people):
    kept = ft.fit_titles(people, 0.3)
    assert [r["title"] for r in kept.collect()] == ["Mr"]
    out = values(ft.title(people, kept), "title")
    assert out == {1: "Mr", 2: "Rare", 3: "Rare", 4: "Rare", 5: "Mr", 6: "Mr"}
    assert values(ft.raw_title(people), "title")[4] == "the Countess"


def test_bins(spark):
    ages = spark.createDataFrame([(i, a) for i, a in enumerate([0.0, 16.5, 17.0, 32.9, 33.0, 48.99, 49.0, None])], "passenger_id int, age double")
    assert list(values(ft.age_bins(ages), "age_bin").values()) == ["Child", "Child", "Young Adult", "Young Adult", "Adult", "Adult", "Senior", None]
    fares = spark.createDataFrame([(i, float(i)) for i in range(1, 6)] + [(9, None)], "passenger_id int, fare double")
    assert list(values(ft.fare_bins(fares, ft.fit_fare_bins(fares)), "fare_bin").values()) == ["cheap", "cheap", "medium", "expensive", "very expensive", None]


def test_onehot_of_unseen_and_null(people, spark):
    names = ft.category_list(ft.fit_categories(people, "embarked"))
    assert names == ["C", "Q", "S"]
    rows = spark.createDataFrame([(1, "C"), (2, "X"), (3, None)], "passenger_id int, embarked string")
    out = ft.encode_onehot(rows, "embarked", names).orderBy("passenger_id").collect()
    assert [tuple(r)[2:] for r in out] == [(1, 0, 0), (0, 0, 0), (0, 0, 0)]
    assert ft.encode_onehot(rows, "embarked", names, drop_first=True).columns[2:] == ["embarked_Q", "embarked_S"]


def test_every_category_gets_a_column(spark):
    df = spark.range(1_200).select(F.concat(F.lit("c"), F.col("id").cast("string")).alias("c"))
    names = ft.category_list(ft.fit_categories(df, "c"))
    assert len(names) == 1_200 and names == sorted(names)
    assert len(ft.encode_onehot(df.limit(1), "c", names).columns) == 1_201


def test_scaler_divides_by_population_deviation(people, spark):
    out = ft.scale_standard(people, ["sibsp"], ft.fit_scaler(people, ["sibsp"]))
    data = [1, 0, 0, 0, 4, 0]
    mean, std = statistics.fmean(data), statistics.pstdev(data)
    assert values(out, "sibsp")[5] == pytest.approx((4 - mean) / std)
    flat = spark.createDataFrame([(1, 2.0), (2, 2.0)], "passenger_id int, x double")
    assert values(ft.scale_standard(flat, ["x"], ft.fit_scaler(flat, ["x"])), "x") == {1: 0.0, 2: 0.0}


def test_prepared_features_have_no_nulls_and_survive_a_reload(spark, folder):
    rows = views.passengers(spark, folder)
    bundle = ft.fit_features(ft.train_rows(rows, "passenger_id"))
    out = ft.apply_features(rows, bundle)
    assert out.count() == rows.count()
    report = va.quality_report(out).collect()
    assert all(r["nulls"] == 0 and r["is_numeric"] for r in report)
    path = scratch_path(spark, "bundle")
    bundle.save(path)
    again = ft.apply_features(rows, ft.FeatureBundle.load(spark, path))
    assert out.exceptAll(again).count() == 0


def test_split_is_stable_and_disjoint(spark, folder):
    rows = views.passengers(spark, folder)
    a = values(ft.split_random(rows, "passenger_id"), "split")
    b = values(ft.split_random(rows.repartition(13), "passenger_id"), "split")
    assert a == b
    assert 0.75 < sum(s == "train" for s in a.values()) / len(a) < 0.85


def test_leakage_sees_null_features(people):
    train, test = people.where("passenger_id <= 3"), people.where("passenger_id >= 3")
    got = {r["kind"]: r["shared"] for r in ft.leakage_check(train, test, "passenger_id", ["pclass", "cabin"]).collect()}
    assert got == {"id": 1, "features": 2}


def test_skew(people):
    serve = people.where("passenger_id <> 1").withColumn("fare", F.col("fare").cast("float")).withColumn("age", F.col("age") + 1).drop("name")
    got = {r["column"]: r for r in ft.train_serve_skew(people, serve, "passenger_id").collect()}
    assert (got["age"]["n_diff"], got["age"]["only_train"], got["age"]["only_serve"]) == (2, 1, 0)
    assert got["fare"]["same_type"] is False and got["fare"]["n_diff"] == 0
    assert got["name"]["n_diff"] is None and got["name"]["same_type"] is False


def test_rules(spark):
    rows = spark.createDataFrame(
        [(1, 80.0, 0.0, 8, 6), (2, 80.5, -1.0, 9, 7), (3, None, None, 0, 0)], "id int, age double, fare double, sibsp int, parch int"
    )
    checked = va.validate_rows(rows)
    assert values(checked, "violations", "id") == {1: [], 2: ["age", "fare", "sibsp", "parch"], 3: []}
    good, bad = va.split_valid(checked)
    assert (good.count(), bad.count()) == (2, 1)


def test_dependencies(spark):
    picks = {1: ["sibsp", "family_size", "sex", "age_bin"], 2: ["family_size", "is_alone", "fare"], 3: ["age", "age_bin", "fare"]}
    rows = spark.createDataFrame([(i, f) for i, fs in picks.items() for f in fs], "id int, feature string")
    got = {r["id"]: (r["features"], r["valid"]) for r in va.feature_dependency(rows, ["id"]).collect()}
    assert got == {1: (["family_size", "sex", "sibsp"], True), 2: (["fare"], False), 3: (["age", "age_bin", "fare"], True)}


def test_fingerprint_ignores_order_and_sees_duplicates(people):
    a = pf.dataset_fingerprint(people).first()
    assert pf.dataset_fingerprint(people.repartition(5).orderBy("fare")).first() == a
    doubled = pf.dataset_fingerprint(people.unionAll(people).unionAll(people)).first()
    assert doubled["hash_xor"] == a["hash_xor"] and doubled["hash_sum"] != a["hash_sum"]


def test_histogram_of_a_constant_column(spark):
    flat = spark.createDataFrame([(2.0,), (2.0,), (None,)], "x double")
    assert [(r["bin"], r["n"]) for r in pf.histogram(flat, ["x"]).collect()] == [(0, 2)]


def test_lookup_and_asof(spark):
    from datetime import datetime as dt

    vals = spark.createDataFrame(
        [(1, dt(2024, 1, 1), 10), (1, dt(2024, 1, 3), 30), (2, dt(2024, 1, 2), None)], "entity_id bigint, feature_ts timestamp_ntz, x int"
    )
    asked = spark.createDataFrame([(1,), (2,), (9,)], "entity_id bigint")
    assert values(lk.feature_lookup(asked, vals), "x", "entity_id") == {1: 30, 2: None, 9: None}
    known, missing = lk.feature_export(asked, vals)
    assert known.count() == 2 and [r[0] for r in missing.collect()] == [9]
    labels = spark.createDataFrame(
        [(1, dt(2023, 12, 31)), (1, dt(2024, 1, 1)), (1, dt(2024, 1, 2)), (1, dt(2024, 1, 9)), (9, dt(2024, 1, 9))],
        "entity_id bigint, label_ts timestamp_ntz",
    )
    rows = lk.feature_asof(labels, vals).orderBy("entity_id", "label_ts").collect()
    assert [r["x"] for r in rows] == [None, 10, 10, 30, None]
