from __future__ import annotations

import math
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemill.operators import corpus as co
from tidemill.plans import materialize


def corpus(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)


def test_vocab_orders_by_code_point(spark):
    vocab = co.build_vocab(corpus(spark, ["ba\n", "", "é😀a", "Z"]))
    assert [(r["token"], r["id"]) for r in vocab.orderBy("id").collect()] == [
        (c, i) for i, c in enumerate(sorted(set("ba\né😀aZ")))
    ]
    assert co.vocab_size(corpus(spark, ["ba\n", "é😀a"])).first()[0] == 5


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(max_size=30).filter(lambda t: "\x00" not in t), min_size=1, max_size=4))
def test_round_trip(spark, texts):
    texts = [t.encode("utf-8", "ignore").decode() for t in texts] + ["hello"]
    docs = corpus(spark, texts)
    vocab = co.build_vocab(docs)
    got = {r["doc_id"]: r["text"] for r in co.decode(co.encode(docs, vocab), vocab).collect()}
    assert got == dict(enumerate(texts))


def test_unknown_characters(spark):
    vocab = co.build_vocab(corpus(spark, ["ab"]))
    odd = corpus(spark, ["axb😀"])
    assert co.encode(odd, vocab, "null").first()["ids"] == [0, None, 1, None]
    with pytest.raises(Exception, match="outside the vocabulary"):
        co.encode(odd, vocab).collect()


def test_known_split_size():
    assert int(0.9 * 1_115_394) == 1_003_854


TEXTS = ["this is a great day", "", "to be", "x", "or not to be, that is the question " * 3]


@pytest.mark.parametrize("ratio", [0.0, 0.3, 0.9, 1.0])
def test_prefix_split(spark, ratio):
    docs = corpus(spark, TEXTS)
    sizes = co.split_sizes(docs, ratio)
    stream = "".join(TEXTS)
    cut = int(ratio * len(stream))
    assert (sizes.train, sizes.val) == (cut, len(stream) - cut)
    for split, expected in (("train", stream[:cut]), ("val", stream[cut:])):
        rows = sorted((r["spos"], r["text"]) for r in co.split_prefix(docs, sizes).where(F.col("split") == split).collect())
        assert "".join(t for _, t in rows) == expected
        assert all(expected[s : s + len(t)] == t for s, t in rows)


def sequential(ids, batch, block):
    """Index rules written out: a batch starts at every multiple of the span below n - span."""
    span = batch * block
    out = {}
    for number, i in enumerate(range(0, len(ids) - span, span)):
        for row in range(batch):
            s = i + row * block
            out[(number, row)] = (ids[s : s + block], ids[s + 1 : s + block + 1])
    return out


@pytest.mark.parametrize("batch,block", [(1, 3), (2, 8), (4, 5), (3, 40)])
def test_sequential_batches(spark, batch, block):
    docs = corpus(spark, TEXTS)
    vocab = co.build_vocab(docs)
    table = {r["token"]: r["id"] for r in vocab.collect()}
    sizes = co.split_sizes(docs, 1.0)
    ids = [table[c] for c in "".join(TEXTS)]
    out = co.seq_batches(co.split_prefix(docs, sizes), sizes, vocab, ["train"], batch, block).collect()
    assert {(r["batch_id"], r["row"]): (r["x"], r["y"]) for r in out} == sequential(ids, batch, block)
    stream = "".join(TEXTS)
    for r in out:
        s = (r["batch_id"] * batch + r["row"]) * block
        assert r["original_text"] == stream[s : s + block]


def test_batch_counts():
    assert [co.batch_count(n, 10) for n in (11, 20, 21, 30, 31)] == [1, 1, 2, 2, 3]
    with pytest.raises(ValueError):
        co.batch_count(10, 10)


def test_first_contexts(spark):
    docs = corpus(spark, ["this is a great day"])
    sizes = co.split_sizes(docs, 1.0)
    block = co.blocks(co.split_prefix(docs, sizes), 8).where("block = 0").first()["text"]
    assert (block[:8], block[1:]) == ("this is ", "his is a")


def test_sampled_windows_come_from_the_stream(spark):
    docs = corpus(spark, TEXTS)
    sizes = co.split_sizes(docs, 0.8)
    pieces = co.split_prefix(docs, sizes)
    stream = "".join(TEXTS)[: sizes.train]
    rows = co.sample_batches(pieces, sizes, {"train": 40}, 4, 6).collect()
    assert len(rows) == 160
    starts = [r["start"] for r in rows]
    assert min(starts) >= 0 and max(starts) < sizes.train - 6
    assert all(r["text"] == stream[r["start"] : r["start"] + 7] for r in rows)
    expected = (sizes.train - 6 - 1) / 2
    assert abs(sum(starts) / len(starts) - expected) < 4 * sizes.train / math.sqrt(12 * len(starts))


def test_bigrams(spark):
    docs = corpus(spark, ["bigram", "b", "😀é😀"])
    pairs = sorted((r["doc_id"], r["pos"], r["pair"]) for r in co.bigram_pairs(docs, "doc_id").collect())
    assert [p[2] for p in pairs if p[0] == 0] == ["bi", "ig", "gr", "ra", "am"]
    assert [p[1:] for p in pairs if p[0] == 2] == [(0, "😀é"), (1, "é😀")]
    model = {(r["prev"], r["next"]): r["p"] for r in co.bigram_model(corpus(spark, ["abacab"])).collect()}
    assert model == {("a", "b"): 2 / 3, ("a", "c"): 1 / 3, ("b", "a"): 1.0, ("c", "a"): 1.0}


def test_bigram_loss(spark):
    docs = corpus(spark, ["abababba", "aabbc"])
    sizes = co.split_sizes(docs, 0.6)
    got = {r["split"]: r["loss"] for r in co.bigram_loss(co.split_prefix(docs, sizes), 3).collect()}
    train = "abababb"
    counts: dict = {}
    for p in zip(train, train[1:], strict=False):
        counts[p] = counts.get(p, 0) + 1
    totals = {c: sum(n for (a, _), n in counts.items() if a == c) for c in "abc"}

    def nll(stream):
        pairs = list(zip(stream, stream[1:], strict=False))
        return sum(-math.log((counts.get(p, 0) + 1) / (totals[p[0]] + 3)) for p in pairs) / len(pairs)

    assert sizes.train == 7
    assert got["train"] == pytest.approx(nll(train))
    assert got["val"] == pytest.approx(nll("aaabbc"))  # one stream, across documents


def test_top_k_keeps_ties(spark):
    probs = spark.createDataFrame([("a", "x", 0.4), ("a", "y", 0.25), ("a", "z", 0.25), ("a", "w", 0.1)], "prev string, next string, p double")
    got = {r["next"]: r["p"] for r in co.topk_next(probs, 2, 0.5).collect()}
    total = 0.4**2 + 2 * 0.25**2
    assert got == {"x": pytest.approx(0.16 / total), "y": pytest.approx(0.0625 / total), "z": pytest.approx(0.0625 / total)}


def test_sampling_follows_the_weights(spark):
    weights = spark.createDataFrame([("a", "x", 3), ("a", "y", 1), ("b", "q", 5)], "prev string, next string, n bigint")
    contexts = spark.range(4000).select("id", F.when(F.col("id") % 4 == 0, "b").otherwise("a").alias("prev"))
    drawn = co.sample_next(contexts, weights).groupBy("prev", "next").count().collect()
    got = {(r["prev"], r["next"]): r["count"] for r in drawn}
    assert got[("b", "q")] == 1000
    assert abs(got[("a", "x")] - 2250) < 120 and got[("a", "x")] + got[("a", "y")] == 3000


def test_crop_and_pad(spark):
    df = spark.createDataFrame([(0, 0, [1, 2, 3]), (0, 1, [4]), (1, 0, [5, 6])], "b int, t int, ids array<bigint>")
    cropped = df.select("b", "t", co.crop_context(F.col("ids"), 2).alias("ids")).collect()
    assert [r["ids"] for r in sorted(cropped)] == [[2, 3], [4], [5, 6]]
    padded = co.pad_sequences(df, "b").collect()
    assert {(r["b"], r["t"]): r["ids"] for r in padded} == {(0, 0): [1, 2, 3], (0, 1): [4, 0, 0], (1, 0): [5, 6]}


def test_words_and_vectors(spark):
    texts = corpus(spark, [" the cat  the\nhat ", "a cat"])
    tokens = co.word_tokens(texts, "doc_id")
    got = sorted((r["doc_id"], r["pos"], r["word"], r["id"]) for r in tokens.collect())
    order = {w: i for i, w in enumerate(["a", "cat", "hat", "the"])}
    assert got == [(0, i, w, order[w]) for i, w in enumerate(["the", "cat", "the", "hat"])] + [(1, 0, "a", 0), (1, 1, "cat", 1)]
    vectors = spark.createDataFrame([(i, [float(i), 1.0], 0) for i in range(3)], "vec_id bigint, embedding array<float>, label int")
    places = co.words(texts).select("pos").distinct()
    rows = co.encoder_input(co.embedding_lookup(tokens, vectors), places, 2).collect()
    for r in rows:
        if r["id"] == 3:  # the table has no such row
            assert r["vector"] is None
        else:
            assert r["vector"] == pytest.approx([r["id"] + math.sin(r["pos"]), 1 + math.cos(r["pos"])])


def test_positional_vector(spark):
    row = spark.range(1).select(co.positional_vector(F.lit(7), 6).alias("v")).first()["v"]
    expected = [f(7 / 10000 ** (2 * (i // 2) / 6)) for i, f in enumerate([math.sin, math.cos] * 3)]
    assert row == pytest.approx(expected)


def test_batches_tile_long_documents(spark):
    rng = random.Random(4)
    texts = ["".join(rng.choice("abcé😀\n") for _ in range(n)) for n in (500, 1, 3, 90)]
    docs = corpus(spark, texts)
    sizes = co.split_sizes(docs, 1.0)
    blocks = co.blocks(co.split_prefix(docs, sizes), 16, overlap=False).orderBy("block").collect()
    assert "".join(r["text"] for r in blocks) == "".join(texts)


def streamed(docs):
    return "".join(r["text"] for r in docs.orderBy("doc_id").collect())


def test_blocks_of_all_alignments(spark):
    """Pieces shorter and longer than blocks, some starting or ending at borders."""
    rng = random.Random(9)
    texts = ["".join(rng.choice("abcdé漢") for _ in range(rng.choice([0, 1, 2, 7, 8, 9, 16, 24, 50, 200]))) for _ in range(80)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)
    stream = streamed(docs)
    sizes = co.SplitSizes(len(stream), 0)
    pieces = co.split_prefix(docs, sizes)
    for overlap in (True, False):
        got = {r["block"]: r["text"] for r in co.blocks(pieces, 8, overlap).collect()}
        assert got == {k: stream[8 * k : 8 * k + 8 + overlap] for k in range(-(-len(stream) // 8))}


def test_blocks_inside_a_text_are_not_shuffled(spark):
    docs = spark.createDataFrame([(i, "xy" * 50_000) for i in range(6)], "doc_id bigint, text string")
    pieces = materialize(co.split_prefix(docs, co.SplitSizes(600_000, 0)))
    sized = pieces.withColumn("n", F.char_length("text").cast("bigint")).withColumn("head", F.least(F.pmod(-F.col("spos"), F.lit(128)).cast("bigint"), "n"))
    moved = co._border_parts(sized, 128, True).agg(F.sum(F.char_length("part"))).first()[0]
    assert moved <= 6 * 2 * 128
    plan = co._whole_blocks(sized, 128, True)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_windows_are_cut_from_the_pieces_they_touch(spark):
    rng = random.Random(4)
    texts = ["".join(rng.choice("abcd") for _ in range(rng.choice([1, 2, 3, 40, 300]))) for _ in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)
    stream = streamed(docs)
    sizes = co.SplitSizes(len(stream), 0)
    pieces = co.split_prefix(docs, sizes)
    rows = co.sample_batches(pieces, sizes, {"train": 30}, 4, 50).collect()
    assert len(rows) == 120 and all(r["text"] == stream[r["start"] : r["start"] + 51] for r in rows)
    spans = pieces.select("split", "spos", (F.col("spos") + F.char_length("text")).alias("end"))
    windows = spark.createDataFrame([("train", r["row"], r["start"]) for r in rows], "split string, row int, start bigint")
    few = co.touched(windows, spans, 51, bin_size=16)
    assert sorted(map(tuple, few.collect())) == sorted(map(tuple, co.touched(windows, spans, 51).collect()))


def test_ids_are_worked_out_once(spark):
    docs = spark.createDataFrame([(0, "abc"), (1, "cab")], "doc_id bigint, text string")
    plan = co.global_position(docs, co.build_vocab(docs))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("raise_error") <= 1 and "size(" not in plan


def test_losses_of_many_windows_take_many_small_tasks(spark, monkeypatch):
    """Tasks follow the characters drawn, and so do those that add up the pairs of a batch."""
    monkeypatch.setattr(co, "WINDOW_CHARS", 1000)
    text = "".join(random.Random(5).choice("abc ") for _ in range(3000))
    pieces = spark.createDataFrame([("train", 0, text[:1000]), ("train", 1000, text[1000:])], "split string, spos bigint, text string")
    windows = co.sample_batches(pieces, co.SplitSizes(3000, 0), {"train": 40}, 8, 31)
    assert windows.rdd.getNumPartitions() == 11  # 40 x 8 x 32 characters
    assert co.bigram_counts(windows, "split", "step", tasks=11).groupBy("split", "step").agg(F.sum("n")).rdd.getNumPartitions() == 11
    counts = co.bigram_counts(pieces)
    known = {r["prev"] + r["next"]: r["n"] for r in counts.collect()}
    total = {c: sum(n for p, n in known.items() if p[0] == c) for c in "abc "}
    expected: dict[int, list[float]] = {}
    for r in windows.collect():
        nll = [-math.log((known.get(p, 0) + 1) / (total[p[0]] + 4)) for p in map("".join, zip(r["text"], r["text"][1:], strict=False))]
        expected.setdefault(r["step"], []).extend(nll)
    got = {r["step"]: r["batch_loss"] for r in co.batch_losses(windows, counts, 4, 11).collect()}
    assert got == pytest.approx({s: sum(v) / len(v) for s, v in expected.items()}) and len(got) == 40


@pytest.mark.parametrize("most", [1, 20, 1_000_000])
def test_pairs_are_counted_in_blocks_of_any_size(spark, monkeypatch, most):
    monkeypatch.setattr(co, "PAIR_BYTES", most)
    rows = [(None, "ab\U0001f600ab"), ("x", "é"), ("x", ""), ("y", None), ("x", "ab\nab"), (None, "ab")]
    got = co.bigram_counts(spark.createDataFrame(rows, "k string, text string").coalesce(1), "k").collect()
    expected: dict[tuple, int] = {}
    for k, t in rows:
        for p in zip(t or "", (t or "")[1:], strict=False):
            expected[(k, *p)] = expected.get((k, *p), 0) + 1
    assert {tuple(r)[:3]: r["n"] for r in got} == expected and len(got) == len(expected)
