"""A training-data pipeline: every stage reads what its predecessor wrote and hands on all it keeps."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm import byte_cnn, language_id, mixing, near_dedup
from tidemill.llm.queries import bpe_digests, held_out, read
from tidemill.plans.scratch import materialize

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

SURE_ENOUGH = 0.4  # language confidence; texts in two languages get about 0.5


def apart(docs: DataFrame) -> DataFrame:
    """``docs`` with column names that no operator adds, so that extra columns pass through unharmed."""
    return docs.toDF(*[f"in_{c}" for c in docs.columns])


def back(docs: DataFrame, columns: list[str]) -> DataFrame:
    return docs.select(*[F.col(f"`in_{c}`").alias(c) for c in columns])


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents that the classifier predicts to be of quality 1."""
    net = byte_cnn.fit(docs.where(~held_out(4, 2)), read(spark, sf_dir, "labels"))
    return back(byte_cnn.score(apart(docs), net, text_col="in_text").where("predicted = 1"), docs.columns)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents with a language that is sure enough."""
    model = language_id.fit(docs.where(~held_out(3, 1)))
    known = (F.col("lang_pred") != language_id.UNDETERMINED) & (F.col("score") >= SURE_ENOUGH)
    return back(language_id.identify(apart(docs), model, "in_text").where(known), docs.columns)


def one_of_each_class(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the smallest id of each near-duplicate class."""
    return back(near_dedup.keep_one(apart(docs), near_dedup.near_duplicates(docs), "in_doc_id"), docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat documents so that sources come near their target weights."""
    mixed = mixing.poisson_mix(apart(docs), id_col="in_doc_id", source_col="in_source", text_col="in_text")
    return back(mixed, docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the encoded and decoded texts, one row per copy."""
    return bpe_digests(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", quality),
    ("language ID", language),
    ("MinHash near-dedup", one_of_each_class),
    ("mixing sources", mix_sources),
    ("byte-level BPE", tokens),
]

ORACLE_SQL = None  # learned stages and signatures; tests/llm/test_pipeline.py has the brute-force version


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``; each result is written and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
