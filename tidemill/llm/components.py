"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.plans.scratch import materialize


def written(df: DataFrame, name: str, files: int | None) -> DataFrame:
    """``df`` written once. A table of few rows becomes few files, as tasks and files of a handful of rows cost more than
    what is in them; ``files`` None keeps the shuffle partitions."""
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return materialize(df.coalesce(files) if files is not None and files < partitions else df, name)


def connected_components(links: DataFrame, a: str = "a", b: str = "b", files: int | None = None) -> DataFrame:
    """``(node, component)`` of all nodes of undirected ``links``; the component is its smallest node.

    Each round gives a node the smallest label among itself and its neighbours and then the label of
    that label, so long chains shrink by halves. Every round is a written table: a lost executor costs
    a part of one round. Minima combine before the shuffle, so a node with very many links is no burden.
    """
    both = links.select(F.col(a).alias("node"), F.col(b).alias("other"))
    both = both.unionByName(links.select(F.col(b).alias("node"), F.col(a).alias("other"))).where("node <> other")
    both = written(both.distinct(), "links", files)
    labels = both.groupBy("node").agg(F.min("other").alias("other")).select("node", F.least("node", "other").alias("component"))
    labels = written(labels, "labels", files)
    while True:
        near = both.join(labels.withColumnRenamed("node", "other"), "other").select("node", "component")
        own = labels.withColumn("before", F.col("component"))
        least = own.unionByName(near, allowMissingColumns=True).groupBy("node")
        least = least.agg(F.min("component").alias("component"), F.min("before").alias("before"))
        least = written(least, "labels", files)
        if least.where("component <> before").isEmpty():
            return least.select("node", "component")
        jump = least.select(F.col("node").alias("component"), F.col("component").alias("further"))
        labels = least.join(jump, "component", "left").select("node", F.least("component", "further").alias("component"))
        labels = written(labels, "labels", files)
