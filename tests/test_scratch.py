from __future__ import annotations

from types import SimpleNamespace

import pytest

from tidemill.plans import scratch
from tidemill.plans.scratch import SETTING, WAREHOUSE, materialize, scratch_path


def fake(master="spark://host", **settings):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default: settings.get(key, default)),
        sparkContext=SimpleNamespace(applicationId="app-7", _jsc=None, master=master),
    )


def test_the_folder_of_the_cluster_is_used():
    path = scratch_path(fake(**{SETTING: "hdfs://shared/checkpoints/", WAREHOUSE: "hdfs://w"}), "x")
    assert path.startswith("hdfs://shared/checkpoints/tidemill/app-7/x-")


def test_the_warehouse_where_none_is_named():
    first, second = (scratch_path(fake(**{WAREHOUSE: "hdfs://w"}), "x") for _ in range(2))
    assert first != second
    assert first.rsplit("/", 1)[0] == second.rsplit("/", 1)[0] == "hdfs://w/tidemill/app-7"
    for settings in ({}, {WAREHOUSE: "spark-warehouse"}, {WAREHOUSE: "file:/tmp/spark-warehouse"}):
        with pytest.raises(ValueError, match="shared folder"):
            scratch_path(fake(**settings), "x")
    assert scratch_path(fake(master="local[2]", **{WAREHOUSE: "file:/w"}), "x").startswith("file:/w/")


def test_tables_are_deleted_at_the_end(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(scratch, "_written", {})
    path = scratch_path(spark, "gone")
    spark.range(3).write.parquet(path)
    folder = path.rsplit("/", 1)[0]
    monkeypatch.setattr(scratch, "_written", {path: spark})  # this table only
    scratch.clean_up()
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)
    assert scratch._written == {} and folder.endswith(spark.sparkContext.applicationId)


def test_materialized_rows(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "i int, s string")
    stored = materialize(df)
    assert stored.schema == df.schema and df.exceptAll(stored).count() == 0
    assert "Scan parquet" in stored._jdf.queryExecution().executedPlan().toString()
