from __future__ import annotations

import hashlib
import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tidemill.queries import source_queries
from tidemill.sources import readers, views, writers


def test_whole_text_keeps_newlines(spark, tmp_path):
    (tmp_path / "a.txt").write_text("one\ntwo\n\n", encoding="utf-8")
    rows = readers.read_corpus(spark, str(tmp_path)).collect()
    assert [r["text"] for r in rows] == ["one\ntwo\n\n"]


def test_csv_rejects_bad_lines(spark, tmp_path):
    (tmp_path / "p.csv").write_text('passenger_id,name,age\n1,"Doe, Mr. X",20.5\n2,Y,old\n3,Z,\n')
    good, bad = readers.read_csv(spark, str(tmp_path), "passenger_id bigint, name string, age double")
    assert good.select("passenger_id").count() == 2
    good, bad = good.collect(), bad.collect()
    assert sorted(tuple(r) for r in good) == [(1, "Doe, Mr. X", 20.5), (3, "Z", None)]
    assert [r["line"] for r in bad] == ["2,Y,old"]


def test_run_documents_of_both_ages(spark, tmp_path):
    for name, key in (("old", "max_iters"), ("new", "max_epochs")):
        doc = {
            "train_config": {"batch_size": 64, "block_size": 128, key: 5000, "learning_rate": 0.0003},
            "model_config": {"vocab_size": 65, "bias": True},
            "vocab_size": 65,
            "train_tokens": 1_003_854,
            "val_tokens": 111_540,
        }
        (tmp_path / f"{name}.json").write_text(json.dumps(doc, indent=2))
    rows = readers.read_runs(spark, str(tmp_path)).collect()
    assert [r["steps"] for r in rows] == [5000, 5000]
    assert all(r["train_tokens"] + r["val_tokens"] == 1_115_394 for r in rows)


def test_loss_history_and_vocab_documents(spark, tmp_path):
    losses = [{"epoch": e, "train_loss": 4.0 - e, "val_loss": 4.1 - e, "wall_time": "2026-01-01T00:00:00"} for e in range(3)]
    (tmp_path / "loss.json").write_text(json.dumps(losses, indent=2))
    assert readers.read_loss_history(spark, str(tmp_path / "loss.json")).count() == 3
    (tmp_path / "vocab.json").write_text(json.dumps({"stoi": {"\n": 0, "a": 1}, "itos": {"0": "\n", "1": "a"}}, indent=2))
    got = {r["token"]: r["id"] for r in readers.read_vocab(spark, str(tmp_path / "vocab.json")).collect()}
    assert got == {"\n": 0, "a": 1}


def test_exports_never_overwrite(spark, tmp_path):
    df = spark.createDataFrame([("auc", 0.8)], "metric string, value double")
    paths = writers.export_metrics(df, str(tmp_path), "3", "2024-01-01T00:00:00")
    assert spark.read.json(paths["json"]).first()["version"] == "3"
    assert "metric,value,version,exported_at" in "".join(p.read_text() for p in Path(paths["csv"]).glob("*.csv"))
    with pytest.raises(Exception, match="(?i)already exists"):
        writers.export_metrics(df, str(tmp_path), "3", "2024-01-01T00:00:00")


def test_topic_rows(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "hashtag string, n int")
    rows = writers.topic_rows(df, F.col("hashtag")).collect()
    assert [(r["key"], json.loads(r["value"])) for r in rows] == [
        ("a", {"hashtag": "a", "n": 1}),
        ("b", {"hashtag": "b", "n": 2}),
    ]


def test_processed_rows_are_pruned_by_split(spark, tmp_path):
    df = spark.createDataFrame([(1, "train"), (2, "test")], "id int, split string")
    writers.write_processed(df, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out")).where("split = 'test'")
    assert [r["id"] for r in back.collect()] == [2]
    assert "PartitionFilters: [isnotnull(split" in back._jdf.queryExecution().executedPlan().toString()


def test_artifacts(spark, tmp_path):
    for name, text in (("a.bin", "x"), ("b.bin", "y"), ("c.bin", "z")):
        (tmp_path / name).write_text(text)
    hashes = readers.artifact_hashes(spark, str(tmp_path))
    known = {r["file"]: r["sha256"] for r in hashes.collect()}
    manifest = spark.createDataFrame([("a.bin", known["a.bin"]), ("b.bin", "0"), ("gone.bin", "1")], "file string, sha256 string")
    got = {r["file"]: r["status"] for r in readers.verify_artifacts(hashes, manifest).collect()}
    assert got == {"a.bin": "ok", "b.bin": "changed", "gone.bin": "missing", "c.bin": "unlisted"}


def plain_tree(lines, block_bytes, fanout):
    """Root and leaves of one group's sorted lines."""
    blocks, at = {}, 0
    for line in lines:
        blocks.setdefault(at // block_bytes, []).append(line + "\n")
        at += len(line.encode()) + 1
    leaves = {i: hashlib.sha256("".join(b).encode()).hexdigest() for i, b in blocks.items()}
    level = dict(leaves)
    while max(level) > 0:
        up = {}
        for i in sorted(level):
            up[i // fanout] = up.get(i // fanout, "") + level[i]
        level = {i: hashlib.sha256(text.encode()).hexdigest() for i, text in up.items()}
    return level[0], leaves


def test_trees_locate_the_first_changed_block(spark):
    """Groups of many heights; one line differs, one group is longer, one missing, one unlisted."""
    sizes = {"a": 1, "b": 40, "c": 1000, "d": 1000, "e": 300, "f": 5, "long line": 3}
    listed = {g: [f"{g}é{i}" * (200 if g == "long line" else 1) for i in range(n)] for g, n in sizes.items()}
    found = {g: list(v) for g, v in listed.items()}
    found["c"][777] = found["c"][777][:-1] + "x"
    found["e"] += [f"more{i}" for i in range(900)]
    found["new"] = found.pop("f")

    def tree(groups):
        rows = [(g, i, line, "clash") for g, v in groups.items() for i, line in enumerate(v)]
        lines = spark.createDataFrame(rows, "g string, o bigint, line string, i string").repartition(4)
        return readers.digest_tree(readers.block_digests(lines, "g", "o", "line", 64), "g", 3)

    got = {r["g"]: tuple(r)[1:] for r in readers.compare_trees(tree(found), tree(listed), "g", 3).collect()}
    expected = {}
    for g in {*found, *listed}:
        a, b = (plain_tree(side[g], 64, 3) if g in side else None for side in (found, listed))
        if a and b:
            first = min((i for i in {*a[1], *b[1]} if a[1].get(i) != b[1].get(i)), default=None)
            expected[g] = ("ok" if first is None else "changed", a[0], first)
        else:
            expected[g] = ("unlisted", a[0], None) if a else ("missing", b[0], None)
    assert got == expected


def test_blocks_are_bounded(spark):
    """A task that hashes a block holds its bytes and one line, not its group."""
    lines = spark.range(50_000).select(F.lit("hot").alias("g"), F.col("id").alias("o"), F.col("id").cast("string").alias("line"))
    leaves = readers.block_digests(lines, "g", "o", "line", 1000)
    assert leaves.count() == -(-sum(len(str(i)) + 1 for i in range(50_000)) // 1000)


def test_no_lines_no_trees(spark):
    none = spark.createDataFrame([], "g string, o bigint, line string")
    tree = readers.digest_tree(readers.block_digests(none, "g", "o", "line"), "g")
    assert readers.compare_trees(tree, tree, "g").isEmpty()


def test_text_files_are_bounded_by_bytes(spark, folder, monkeypatch):
    """Small files give the same counts; none holds more than its bytes and one document."""
    whole = sorted(map(tuple, source_queries.src_text(spark, folder).collect()))
    seen = []
    read = readers.read_corpus

    def watched(*args):
        seen.append(read(*args))
        return seen[-1]

    monkeypatch.setattr(readers, "read_corpus", watched)
    monkeypatch.setattr(source_queries, "FILE_BYTES", 20_000)
    assert sorted(map(tuple, source_queries.src_text(spark, folder).collect())) == whole
    longest = views.table(spark, folder, "documents").agg(F.max(F.octet_length("text"))).first()[0]
    sizes = [r[0] for r in seen[0].select(F.octet_length("text")).collect()]
    assert len(sizes) > 10 and max(sizes) <= 20_000 + longest + 1
