"""Sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def topic_rows(df: DataFrame, key: Column) -> DataFrame:
    """Rows as topic records: the key decides the partition, the value is the row as JSON."""
    return df.select(key.cast("string").alias("key"), F.to_json(F.struct("*")).alias("value"))


def write_topic(df: DataFrame, key: Column, brokers: str, topic: str) -> None:
    """Publish a batch. Needs the Kafka connector on the class path."""
    writer = topic_rows(df, key).write.format("kafka")
    writer.option("kafka.bootstrap.servers", brokers).option("topic", topic).save()


def write_topic_files(df: DataFrame, key: Column, path: str) -> None:
    topic_rows(df, key).write.mode("errorifexists").parquet(path)


def export_metrics(df: DataFrame, base: str, version: str, at: str, formats=("json", "csv")) -> dict[str, str]:
    """Write a metrics table below a path of its own version; an existing version is an error."""
    stamped = df.withColumns({"version": F.lit(version), "exported_at": F.lit(at)})
    paths = {}
    for kind in formats:
        paths[kind] = f"{base}/{version}/{kind}"
        writer = stamped.write.mode("errorifexists")
        writer.json(paths[kind]) if kind == "json" else writer.csv(paths[kind], header=True)
    return paths


def write_processed(df: DataFrame, path: str) -> None:
    """Prepared rows, one folder per split."""
    df.write.mode("errorifexists").partitionBy("split").parquet(path)


def console(stream: DataFrame, checkpoint: str):
    """Print every record of a stream."""
    return (
        stream.writeStream.format("console")
        .option("truncate", "false")
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .start()
    )
