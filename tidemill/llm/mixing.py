"""Mixing sources to target weights by Poisson replication.

Each source gets a target share of the mixture; its mean repetition rate is the characters it should
contribute over the characters it has. Every document draws its number of copies from a Poisson
distribution with that mean, by inverting the distribution function at a number hashed from seed and
id, so a rerun or a recomputed task gives the same copies. Copies are then dealt by a hash to all
partitions and ordered by it there: a global shuffle without a driver-side permutation.

Defined results: a null source is a source of its own; null texts have no characters; documents of a
source without characters keep one expected copy; with explicit targets, a source that is not listed
has weight 0. Repeated ids draw the same number. Input columns called like an added one are replaced.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.llm.common import hash_share, without
from tidemill.plans.lookup import lookup_join
from tidemill.plans.scratch import materialize

ADDED = ("rate", "copies", "copy", "shuffle_key")
PIECE = 256  # larger rates are sums of independent draws, so that exp(-rate) stays a normal number


def poisson_inverse(rate: Column, share: Column) -> Column:
    """Smallest n with P(X <= n) > share. The sum goes so far that a 52-bit share never lies beyond."""
    steps = F.ceil(rate + 12 * F.sqrt(rate) + 40).cast("int")
    start = F.struct(F.exp(-rate).alias("p"), F.exp(-rate).alias("c"), F.lit(0).alias("n"))

    def step(acc: Column, k: Column) -> Column:
        p = acc["p"] * rate / k
        return F.struct(p.alias("p"), (acc["c"] + p).alias("c"), (acc["n"] + (acc["c"] <= share).cast("int")).alias("n"))

    return F.aggregate(F.sequence(F.lit(1), steps), start, step, lambda acc: acc["n"])


def source_rates(
    docs: DataFrame, targets: Mapping[str, float] | None, flatten: float, source_col: str, text_col: str
) -> DataFrame:
    """``(source_key, rate)``. Without targets, shares follow the sizes to the power ``flatten``."""
    key = F.coalesce(F.concat(F.lit("s"), F.col(source_col).cast("string")), F.lit("null")).alias("source_key")
    chars = F.coalesce(F.length(F.col(text_col)), F.lit(0)).cast("bigint")
    sizes = docs.select(key, chars.alias("_c")).groupBy("source_key").agg(F.sum("_c").alias("chars"))
    if targets is None:
        weight = F.pow(F.col("chars").cast("double"), F.lit(flatten))
    else:
        pairs = [x for name, w in targets.items() for x in (F.lit(f"s{name}"), F.lit(float(w)))]
        listed = F.create_map(*pairs) if pairs else F.create_map().cast("map<string,double>")
        weight = F.coalesce(F.element_at(listed, F.col("source_key")), F.lit(0.0))
    sizes = materialize(sizes.withColumn("weight", weight), "sources")
    total = sizes.agg(F.sum("chars").cast("double").alias("chars")).scalar()
    weights = sizes.agg(F.sum("weight").alias("weight")).scalar()
    rate = F.when(F.col("chars") > 0, F.col("weight") / weights * total / F.col("chars")).otherwise(F.lit(1.0))
    return sizes.select("source_key", F.coalesce(rate, F.lit(0.0)).alias("rate"))


def poisson_mix(
    docs: DataFrame,
    targets: Mapping[str, float] | None = None,
    flatten: float = 0.5,
    seed: int = 42,
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
) -> DataFrame:
    """The columns of ``docs`` and ``rate``, ``copies``, ``copy`` (from 0) and ``shuffle_key``."""
    docs = without(docs, [*ADDED, "source_key"])
    rates = source_rates(docs, targets, flatten, source_col, text_col)
    key = F.coalesce(F.concat(F.lit("s"), F.col(source_col).cast("string")), F.lit("null"))
    rated = lookup_join(docs.withColumn("source_key", key), rates, ["source_key"], "inner").drop("source_key")
    rate, doc = F.col("rate"), F.col(id_col)
    pieces = F.greatest(F.ceil(rate / PIECE).cast("int"), F.lit(1))
    copies = F.aggregate(
        F.sequence(F.lit(1), pieces),
        F.lit(0),
        lambda acc, piece: acc + poisson_inverse(rate / pieces, hash_share(F.lit(seed), doc, piece)),
    )
    drawn = rated.withColumn("copies", copies).where("copies > 0")
    every = drawn.withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))
    label = F.concat_ws(":", F.lit("order"), F.lit(str(seed)), F.coalesce(doc.cast("string"), F.lit("null")), F.col("copy").cast("string"))
    keyed = every.withColumn("shuffle_key", F.substring(F.md5(label.cast("binary")), 1, 16))
    return keyed.repartition("shuffle_key").sortWithinPartitions("shuffle_key")
