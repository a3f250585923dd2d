"""The pipeline against plain versions of its stages, and odd tables."""

from __future__ import annotations

import hashlib
from collections import Counter

import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline
from tests.llm.test_near_dedup import brute_classes
from tidemill.llm import byte_bpe, mixing
from tidemill.llm.queries import bpe_ranks

FOLDER = "/root/testdata/sf0.01"


def test_stages(spark):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality classifier", "language ID", "MinHash near-dedup", "mixing sources", "byte-level BPE"]
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, kept = docs.columns, {}
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r["doc_id"]: r for r in docs.collect()}
        docs = corpus_pipeline.materialize(stage(spark, docs, FOLDER), "stage")
        rows = docs.collect()
        assert docs.columns == columns and all(before[r["doc_id"]] == r for r in rows)
        kept[name] = Counter(r["doc_id"] for r in rows)
        if name == "quality classifier":
            good = [i for i, y in labels.items() if y == 1]
            assert sum(i in kept[name] for i in good) > 0.97 * len(good)
            assert sum(i in kept[name] for i, y in labels.items() if y == 0) < 0.1 * len(labels)
        if name == "language ID":
            assert len(rows) > 0.98 * len(before)
        if name == "MinHash near-dedup":
            classes = brute_classes([(i, r["text"]) for i, r in before.items()])
            assert set(kept[name]) == set(classes.values())
        if name == "mixing sources":
            rate = {r["doc_id"]: r["copies"] for r in mixing.poisson_mix(spark.createDataFrame(list(before.values()), docs.schema)).collect()}
            assert kept[name] == rate
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.read_ranks(bpe_ranks()), special_tokens={})
    out = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER).collect()
    assert Counter(r["doc_id"] for r in out) == kept["mixing sources"]
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in out:
        ids = library.encode_ordinary(texts[r["doc_id"]])
        assert (r["n_tokens"], r["ids_sha256"]) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    """Nulls in any column, empty and long texts, repeated rows and columns with clashing names."""
    folder = str(tmp_path_factory.mktemp("odd"))
    good = "The house and the tree are of one and the same kind, as was said before. "
    rows = [(i, f"{good}{i} {good}", "en", "s", 9) for i in range(40)]
    rows += [(1, rows[1][1], "en", "s", 9), (None, good, None, None, None), (90, None, "en", "s", 0), (91, "", "en", None, 0), (92, good * 3000, None, "t", 1)]
    extra = [(*r, 0.1, 5, b"n", "c", 1, 2, "k") for r in rows]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, score double, predicted int, node binary, lang_pred string, rate int, copies int, shuffle_key string"
    spark.createDataFrame(extra, schema).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, i % 2, 0) for i in range(0, 40, 3)] + [(None, 1, 1), (2, None, 0)], "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder


def test_odd_tables(spark, odd):
    docs = spark.read.parquet(f"{odd}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, odd)
        if name != "byte-level BPE":
            assert out.columns == docs.columns
        out.collect()
    rows = {r["doc_id"]: r["score"] for r in corpus_pipeline.one_of_each_class(spark, docs, odd).collect()}
    assert set(rows.values()) == {0.1}  # the table's own column, not one of an operator
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, odd).collect() == []
    corpus_pipeline.run(spark, odd).collect()
