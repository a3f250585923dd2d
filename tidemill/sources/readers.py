"""Readers with declared schemas."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.plans import materialize, prefix_sum

PASSENGER_SCHEMA = (
    "passenger_id bigint, survived int, pclass int, name string, sex string, age double, sibsp int,"
    " parch int, ticket string, fare double, cabin string, embarked string"
)
TOPIC_SCHEMA = (
    "key binary, value binary, topic string, partition int, offset bigint, timestamp timestamp_ntz"
)
# The fields of a run document.
RUN_SCHEMA = """
train_config struct<
  batch_size: int, block_size: int, max_iters: int, max_epochs: int, eval_interval: int, eval_iters: int,
  learning_rate: double, weight_decay: double, beta1: double, beta2: double,
  n_layer: int, n_head: int, n_embd: int, dropout: double, device: string, seed: int>,
model_config struct<
  block_size: int, vocab_size: int, n_layer: int, n_head: int, n_embd: int, dropout: double, bias: boolean>,
dataset_path string, output_dir string, vocab_size int, train_tokens bigint, val_tokens bigint
"""
LOSS_SCHEMA = "epoch int, train_loss double, val_loss double, wall_time timestamp"


def read_corpus(spark: SparkSession, path: str) -> DataFrame:
    """Whole text files, newlines kept: ``(path, text)``."""
    files = spark.read.text(path, wholetext=True)
    return files.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))


def read_csv(spark: SparkSession, path: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """(typed rows, rejected lines) of CSV files with a header.

    The parser only checks columns that the plan reads, so the test below names all of them: a line
    is good or bad whatever columns are used later. Its second half alone decides.
    """
    rows = spark.read.option("escape", '"').csv(
        path,
        schema=f"{schema}, _bad string",
        header=True,
        mode="PERMISSIVE",
        columnNameOfCorruptRecord="_bad",
    )
    typed = [F.col(c).cast("string") for c in rows.columns if c != "_bad"]
    bad = F.coalesce("_bad", *typed).isNotNull() & F.col("_bad").isNotNull()
    return rows.where(~bad).drop("_bad"), rows.where(bad).select(F.col("_bad").alias("line"))


def read_runs(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Run documents, one row each. The number of steps goes by either of its two names."""
    runs = spark.read.schema(RUN_SCHEMA).json(path, multiLine=multi_line)
    steps = F.coalesce("train_config.max_epochs", "train_config.max_iters")
    return runs.withColumn("steps", steps)


def read_loss_history(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LOSS_SCHEMA).json(path, multiLine=True)


def read_vocab(spark: SparkSession, path: str) -> DataFrame:
    """Vocabulary documents ``{"stoi": {token: id}}`` as (token, id)."""
    doc = spark.read.schema("stoi map<string,int>").json(path, multiLine=True)
    return doc.select(F.explode("stoi").alias("token", "id"))


def topic_stream(spark: SparkSession, brokers: str, topic: str) -> DataFrame:
    """Subscribe to a topic. Needs the Kafka connector on the class path."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", brokers)
        .option("subscribe", topic)
        .load()
    )


def topic_replay(spark: SparkSession, brokers: str, topic: str) -> DataFrame:
    """Everything a topic still retains, as a batch."""
    return (
        spark.read.format("kafka")
        .option("kafka.bootstrap.servers", brokers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .option("endingOffsets", "latest")
        .load()
    )


def file_stream(spark: SparkSession, path: str, schema, files_per_batch: int | None = None, source: str | None = None) -> DataFrame:
    """Parquet files as a stream; a bounded run uses the ``availableNow`` trigger. ``source`` names a column for the file."""
    reader = spark.readStream.schema(schema)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    rows = reader.parquet(path)
    return rows if source is None else rows.select("*", F.col("_metadata.file_path").alias(source))


def artifact_hashes(spark: SparkSession, path: str) -> DataFrame:
    """SHA-256 and size of every file below ``path``, named by its place below that folder."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select(
        F.substring_index("path", f"{path.rstrip('/')}/", -1).alias("file"),
        "length",
        F.sha2("content", 256).alias("sha256"),
    )


BLOCK_BYTES, FANOUT = 1_000_000, 16


def block_digests(lines: DataFrame, group: str, order: str, line: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``(group, level, i, digest)`` of blocks of whole lines, cut by the bytes before them: no value is longer than a block
    and one line, however large a group. ``order`` is numeric and unique within a group."""
    sized = lines.select(group, F.col(order).alias("_o"), F.concat(line, F.lit("\n")).alias("_line"))
    sized = materialize(sized.withColumn("_n", F.octet_length("_line").cast("bigint")), "lines")
    places = prefix_sum(sized.select(group, "_o", "_n"), "_o", ["_n"], by=[group])
    block = F.floor((F.col("cum__n") - F.col("_n")) / block_bytes).cast("bigint")
    cut = sized.join(places.select(group, "_o", block.alias("i")), [group, "_o"])
    rows = F.sort_array(F.collect_list(F.struct("_o", "_line")))
    text = F.array_join(F.transform(rows, lambda x: x["_line"]), "")
    return cut.groupBy(group, "i").agg(F.sha2(text, 256).alias("digest")).select(group, F.lit(0).alias("level"), "i", "digest")


def digest_tree(leaves: DataFrame, group: str, fanout: int = FANOUT) -> list[DataFrame]:
    """Levels of a Merkle tree for each group: a parent is the hash of up to ``fanout`` digests. A group is in the levels up
    to its root."""
    levels = [materialize(leaves, "digests")]
    while True:
        unfinished = levels[-1].groupBy(group).agg(F.max("i").alias("_most")).where("_most > 0").select(group)
        rows = F.sort_array(F.collect_list(F.struct("i", "digest")))
        joined = F.array_join(F.transform(rows, lambda x: x["digest"]), "")
        up = levels[-1].join(unfinished, group, "left_semi")
        up = up.groupBy(group, F.floor(F.col("i") / fanout).cast("bigint").alias("i")).agg(F.sha2(joined, 256).alias("digest"))
        up = materialize(up.select(group, F.lit(len(levels)).alias("level"), "i", "digest"), "digests")
        if up.isEmpty():
            return levels
        levels.append(up)


def tree_roots(levels: list[DataFrame], group: str) -> DataFrame:
    """``(group, root, height)``."""
    firsts = reduce(DataFrame.unionByName, [level.where("i = 0") for level in levels])
    return firsts.groupBy(group).agg(F.max_by("digest", "level").alias("root"), F.max("level").alias("height"))


def compare_trees(found: list[DataFrame], listed: list[DataFrame], group: str, fanout: int = FANOUT) -> DataFrame:
    """``(group, status, root, changed)``: ok, changed, missing or unlisted, and the first leaf that differs.

    Only children of differing nodes are compared on the way down, which begins at the lower of both roots.
    """
    one, two = (tree_roots(levels, group) for levels in (found, listed))
    roots = one.join(two.select(group, F.col("root").alias("expected"), F.col("height").alias("other")), group, "full_outer")
    status = F.when(F.col("root").isNull(), "missing").when(F.col("expected").isNull(), "unlisted")
    status = status.when(F.col("root") == F.col("expected"), "ok").otherwise("changed")
    roots = roots.select(group, status.alias("status"), F.coalesce("root", "expected").alias("root"), F.least("height", "other").alias("start"))
    roots = materialize(roots, "roots")
    changed = roots.where("status = 'changed'").select(group, "start")
    differing: DataFrame | None = None
    for level in reversed(range(min(len(found), len(listed)))):
        left, right = (levels[level].select(group, "i", F.col("digest").alias(name)) for levels, name in ((found, "a"), (listed, "b")))
        nodes = left.join(right, [group, "i"], "full_outer").where("NOT a <=> b")
        nodes = nodes.select(group, "i", F.floor(F.col("i") / fanout).cast("bigint").alias("parent"))
        begun = nodes.join(changed.where(F.col("start") == level).select(group), group, "left_semi")
        if differing is not None:
            begun = begun.unionByName(nodes.join(differing.select(group, F.col("i").alias("parent")), [group, "parent"], "left_semi"))
        differing = materialize(begun.select(group, "i"), "differing")
    return roots.select(group, "status", "root").join(differing.groupBy(group).agg(F.min("i").alias("changed")), group, "left")


def verify_artifacts(hashes: DataFrame, manifest: DataFrame) -> DataFrame:
    """ok, changed, missing or unlisted for every file in the manifest ``(file, sha256)`` or on disk."""
    listed = manifest.select("file", F.col("sha256").alias("expected"))
    status = (
        F.when(F.col("sha256").isNull(), "missing")
        .when(F.col("expected").isNull(), "unlisted")
        .when(F.col("sha256") == F.col("expected"), "ok")
        .otherwise("changed")
    )
    both = listed.join(hashes.select("file", "sha256"), "file", "full_outer")
    return both.select("file", status.alias("status"))
