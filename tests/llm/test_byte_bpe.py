"""Byte-level BPE against the public library and exact round trips."""

from __future__ import annotations

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemill.llm import blocks, byte_bpe
from tidemill.llm.queries import bpe_digests, bpe_ranks


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.read_ranks(bpe_ranks()), special_tokens={})


ODD = [
    "", " ", "  ", "\n", " \n", "a\n\n b", "it's we'll they've I'm 'dare 'they 's's ''s x' s", "  x  y　", "\x1c\x1dfile", "'S 'LL",
    "naïve 日本語 テスト 12½ ①② ΑΒΓ", "😀😀👩‍👩‍👧", "a" * 700, "!" * 300, "\t\t x\r\n", "<|endoftext|>", "don't", "'", " '", "'s", "'re'", "x'tis", "ͅa",
]


def pieces(texts):
    out = []
    for _, _, data, offsets in blocks.text_blocks(pa.array(texts, pa.string())):
        starts, ends, owner = byte_bpe.cut(data, offsets)
        whole = data.tobytes()
        out += [(int(o), whole[a:b].decode()) for a, b, o in zip(starts, ends, owner, strict=True)]
    return out


def test_pattern_is_the_public_one():
    assert byte_bpe.PATTERN == public_tokenizers.PATTERN


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from("aL'stlvd  \n\t1.é  日😀"), st.characters(codec="utf-8")), max_size=25), min_size=1, max_size=5))
def test_ids_match_the_library(library, texts):
    for text in texts:
        assert "".join(p for _, p in pieces([text])) == text
    ids = [encoded(t) for t in texts]
    assert ids == [library.encode_ordinary(t) for t in texts]


def encoded(text):
    out: list[int] = []
    for _, _, data, offsets in blocks.text_blocks(pa.array([text], pa.string())):
        starts, ends, _ = byte_bpe.cut(data, offsets)
        out += byte_bpe.fold(data, starts, ends, bpe_ranks())[0].tolist()
    return out


def test_odd_texts(library):
    assert [encoded(t) for t in ODD] == [library.encode_ordinary(t) for t in ODD]


def test_heap_and_column_give_the_same_ids(spark, library):
    ranks = byte_bpe.read_ranks(bpe_ranks())
    words = [" thwhtior", "x", "erstntha", "日本", "aaaaaaa", "\n\n\n", " Schachbergerüch"]
    expected = [library.encode_ordinary(w) if len(pieces([w])) == 1 else None for w in words]
    assert None not in expected
    assert [byte_bpe.merge_piece(w.encode(), ranks) for w in words] == expected
    df = spark.createDataFrame([(i, w.encode()) for i, w in enumerate(words)], "i int, piece binary")
    found = df.select("i", byte_bpe.fold_merges(F.col("piece"), byte_bpe.rank_table(bpe_ranks())).alias("ids")).collect()
    assert [r["ids"] for r in sorted(found)] == expected


def test_rank_table_finds_every_pair():
    ranks, table = byte_bpe.read_ranks(bpe_ranks()), byte_bpe._arrays(bpe_ranks())
    some = [t for t in ranks if len(t) > 1][::97]
    pairs = [(ranks[t[:k]], ranks[t[k:]], ranks[t]) for t in some for k in range(1, len(t)) if t[:k] in ranks and t[k:] in ranks]
    left, right, merged = map(np.array, zip(*pairs, strict=True))
    assert (table.rank(left, right) == merged).all()
    assert (table.rank(merged, merged) != 0).all()


def test_whole_table_round_trip(spark, library):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    rows = byte_bpe.decode(byte_bpe.encode(docs, bpe_ranks()), bpe_ranks()).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert r["tokens"] == library.encode_ordinary(texts[r["doc_id"]])
        assert bytes(r["decoded"]).decode() == texts[r["doc_id"]]


def test_edge_rows(spark):
    rows = [(1, None), (2, ""), (3, "a b"), (3, "a b"), (None, "c")]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id bigint, text string, tokens string, decoded int")
    found = sorted((str(r["doc_id"]), r["tokens"], bytes(r["decoded"])) for r in byte_bpe.decode(byte_bpe.encode(df, bpe_ranks()), bpe_ranks()).collect())
    assert found == [("1", [], b""), ("2", [], b""), ("3", [64, 275], b"a b"), ("3", [64, 275], b"a b"), ("None", [66], b"c")]
    assert byte_bpe.encode(df.limit(0), bpe_ranks()).collect() == []


def test_round_trip_is_both_steps_in_one_worker(spark):
    rows = [(1, None), (2, ""), (3, "a b"), (3, "a b"), (None, "c"), (4, "x y " * 200_000)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    apart = byte_bpe.decode(byte_bpe.encode(df, bpe_ranks()), bpe_ranks())
    once = byte_bpe.round_trip(df, bpe_ranks())
    assert once.schema == apart.schema and sorted(map(str, once.collect())) == sorted(map(str, apart.collect()))
    plan = bpe_digests(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1
