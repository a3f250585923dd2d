"""Poisson replication."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from tidemill.llm import mixing


def test_inverse_matches_the_distribution(spark):
    shares = [0.0, 1e-9, 0.3, 0.5, 0.999, 1 - 2**-52]
    rates = [0.0, 0.2, 1.0, 17.5, 256.0]
    df = spark.createDataFrame([(r, u) for r in rates for u in shares], "r double, u double")
    for row in df.withColumn("n", mixing.poisson_inverse(F.col("r"), F.col("u"))).collect():
        p, c, n = math.exp(-row["r"]), math.exp(-row["r"]), 0
        while c <= row["u"] and p > 0:
            n += 1
            p *= row["r"] / n
            c += p
        assert row["n"] == n or row["u"] > 1 - 1e-12, row


def test_mean_rate_and_shares(spark):
    df = spark.range(6000).select(F.col("id").alias("doc_id"), F.lit("x" * 10).alias("text"), F.when(F.col("id") < 5000, "big").otherwise("small").alias("source"))
    out = mixing.poisson_mix(df, targets={"big": 1.0, "small": 1.0}).groupBy("source").count().collect()
    got = {r["source"]: r["count"] for r in out}
    assert got["big"] == pytest.approx(3000, abs=200) and got["small"] == pytest.approx(3000, abs=200)
    large = mixing.poisson_mix(df.where("doc_id >= 5990"), targets={"small": 1.0}, flatten=1).select("rate").first()
    assert large["rate"] == pytest.approx(1)


def test_large_rates_are_sums(spark):
    df = spark.createDataFrame([(i, "x", "rare") for i in range(20)] + [(100, "y" * 20_000, "dropped")], "doc_id bigint, text string, source string")
    out = mixing.poisson_mix(df, targets={"rare": 1.0}).groupBy("doc_id").count().collect()
    assert len(out) == 20  # the other source has no weight
    assert sum(r["count"] for r in out) / 20 == pytest.approx(1001, rel=0.05)


def test_the_same_again_and_edge_rows(spark):
    rows = [(1, "aa", "s"), (1, "aa", "s"), (2, None, None), (3, "", "empty"), (None, "bb", "s")]
    df = spark.createDataFrame([(*r, 9.0, "c") for r in rows], "doc_id bigint, text string, source string, rate double, Copy string")
    first, second = (sorted(map(str, mixing.poisson_mix(df.repartition(n)).collect())) for n in (1, 5))
    assert first == second
    out = mixing.poisson_mix(df)
    assert sorted(out.columns) == sorted(["doc_id", "text", "source", *mixing.ADDED])
    copies = [r["copies"] for r in out.where("doc_id = 1").collect()]
    assert len(copies) == 2 * sum(copies[:1])
    assert {r["rate"] for r in out.where("source = 'empty' OR source IS NULL").collect()} <= {1.0}
    assert mixing.poisson_mix(df.limit(0)).collect() == []


def test_copies_are_dealt_and_ordered(spark):
    df = spark.range(2000).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"), F.lit("s").alias("source"))
    parts = mixing.poisson_mix(df).select(F.spark_partition_id().alias("p"), "shuffle_key", "doc_id").collect()
    by = {}
    for r in parts:
        by.setdefault(r["p"], []).append(r["shuffle_key"])
    assert all(keys == sorted(keys) for keys in by.values())
    ids = [r["doc_id"] for r in parts]
    assert sum(a < b for a, b in zip(ids, ids[1:], strict=False)) / len(ids) == pytest.approx(0.5, abs=0.06)
