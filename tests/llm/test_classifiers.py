"""Quality classifier and language ID: held-out accuracy, gradients and edge rows."""

from __future__ import annotations

import zlib

import numpy as np
import pytest

from tidemill.llm import byte_cnn, language_id
from tidemill.llm.queries import QUERIES
from tidemill.llm.sampling import bounded_sample

FOLDER = "/root/testdata/sf0.01"


def block(texts):
    data = [t.encode() for t in texts]
    return np.frombuffer(b"".join(data), np.uint8), np.concatenate([[0], np.cumsum([len(d) for d in data])])


def test_gradients_by_differences():
    rng = np.random.default_rng(0)
    net = byte_cnn.new_net(3)
    net.hidden_bias += 0.3
    data, offsets = block(["".join(chr(c) for c in rng.integers(97, 123, n)) for n in (5, 700, 1500)])
    y, weight = np.array([1.0, 0.0, 1.0]), np.array([0.2, 0.5, 0.3])

    def loss():
        p = byte_cnn.probabilities(net, data, offsets)
        return -(weight * (y * np.log(p) + (1 - y) * np.log(1 - p))).sum()

    found = byte_cnn._gradients(net, data, offsets, y, weight)
    for values, gradient in zip(net.parameters(), found, strict=True):
        flat, slope = values.reshape(-1), gradient.reshape(-1)
        for i in np.argsort(-np.abs(slope))[:3]:
            step, before = 1e-2, flat[i]
            flat[i] = before + step
            up = loss()
            flat[i] = before - step
            down = loss()
            flat[i] = before
            assert (up - down) / (2 * step) == pytest.approx(slope[i], rel=0.1, abs=2e-4)


def test_chunks_cover_every_byte_and_overlap():
    for size in (0, 1, 128, 511, 513, 5000):
        data, offsets = block(["a" * size, "b"])
        _, first_unit, n_units = byte_cnn.units(data, offsets)
        first, last, owner = byte_cnn.chunks(first_unit, n_units)
        spans = [(a, b) for a, b, o in zip(first, last, owner, strict=True) if o == 0]
        assert spans[0][0] == 0 and spans[-1][1] == n_units[0] == max(-(-size // 128), 1)
        assert all(b > c for (_, b), (c, _) in zip(spans, spans[1:], strict=False))


def test_score_does_not_depend_on_neighbours():
    net = byte_cnn.new_net(1)
    texts = ["short", "x" * 3000, "", "y z " * 200]
    together = byte_cnn.probabilities(net, *block(texts))
    alone = np.concatenate([byte_cnn.probabilities(net, *block([t])) for t in texts])
    assert together == pytest.approx(alone, abs=1e-6)


@pytest.fixture(scope="module")
def quality(spark):
    return {r["doc_id"]: r for r in QUERIES["op1_byte_cnn_quality"](spark, FOLDER).collect()}


def test_held_out_quality(spark, quality):
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    assert len(quality) == 1000
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in quality.items())
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in quality.values())
    held = [(quality[i]["score"], y) for i, y in labels.items() if quality[i]["held_out"]]
    good, bad = ([s for s, y in held if y == k] for k in (1, 0))
    assert np.mean([a > b for a in good for b in bad]) > 0.97
    assert np.mean([s >= 0.7 for s in good]) > 0.95 and np.mean([s < 0.7 for s in bad]) > 0.8


def test_held_out_language(spark):
    docs = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    rows = QUERIES["op2_language_id"](spark, FOLDER).collect()
    assert len(rows) == 1000
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    held = [r["lang_pred"] == docs[r["doc_id"]] for r in rows if r["held_out"]]
    assert np.mean(held) > 0.97
    assert all(0 <= r["score"] <= 1 for r in rows)


EDGE = [(1, None), (2, ""), (3, " 12 !? \n"), (4, "the house and the tree " * 5000), (5, "é"), (5, "é"), (None, "und der die das ist nicht")]


def test_edge_rows_of_languages(spark):
    words = {"en": "the house and of with there", "de": "und der die das ist nicht ein", "fr": "le la les des est une dans", "xx": "qpqp zpzp qzqz pqpq"}
    train = spark.createDataFrame([(i * 10 + k, f"{words[x]} {k}", x) for k in range(12) for i, x in enumerate(words)] + [(999, None, "en"), (998, "zz", None)], "doc_id bigint, text string, lang string")
    model = language_id.fit(train)
    assert [name for name, _ in model.families] == ["germanic", "only xx", "romance"]
    df = spark.createDataFrame([(*r, "x", 7) for r in EDGE], "doc_id bigint, text string, lang_pred string, Score int")
    found = language_id.identify(df, model).collect()
    assert [c.lower() for c in language_id.identify(df, model).columns] == ["doc_id", "text", "lang_pred", "score"]
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in found}
    assert len(found) == len(EDGE) and got[1] == got[2] == got[3] == ("und", 0.0)
    assert got[4][0] == "en" and got[None][0] == "de" and got[5][0] in words
    nothing = language_id.fit(train.limit(0))
    assert {r["lang_pred"] for r in language_id.identify(df, nothing).collect()} == {"und"}
    assert language_id.identify(df.limit(0), model).collect() == []


def test_edge_rows_of_quality(spark):
    docs = spark.createDataFrame(EDGE, "doc_id bigint, text string")
    none = spark.createDataFrame([], "doc_id bigint, quality int")
    assert {r["score"] for r in byte_cnn.score(docs, byte_cnn.fit(docs, none)).collect()} == {0.5}
    one = spark.createDataFrame([(4, 1), (4, 1), (77, 0), (5, None)], "doc_id bigint, quality int")
    assert {r["score"] for r in byte_cnn.score(docs, byte_cnn.fit(docs.where("doc_id <> 4 OR doc_id = 4"), one, max_train_chars=10**9)).collect()} == {1.0}
    net = byte_cnn.new_net(5)
    rows = byte_cnn.score(docs, net).collect()
    by = {}
    for r in rows:
        by.setdefault(r["doc_id"], set()).add(r["score"])
    assert len(rows) == len(EDGE) and by[1] == by[2] and len(by[5]) == 1
    assert byte_cnn.score(docs.limit(0), net).collect() == []


def test_sample_is_bounded_and_whole_when_small(spark):
    df = spark.range(20_000).selectExpr("id", "CASE WHEN id < 19990 THEN 'a' ELSE 'b' END AS g")
    got = {r["g"]: r["count"] for r in bounded_sample(df, "id", "g", 500, 1).groupBy("g").count().collect()}
    assert got["b"] == 10 and 400 < got["a"] < 600


def plain_probability(net, text: bytes) -> float:
    """The network in loops: each chunk's windows one by one, the largest answers, the largest hidden values."""
    step, unit = byte_cnn.STEP, byte_cnn.UNIT
    size = max(1, -(-len(text) // unit))
    padded = text + bytes((size + 1) * unit - len(text))
    wide, hop = byte_cnn.CHUNK // unit, byte_cnn.HOP // unit
    document = np.zeros(byte_cnn.HIDDEN)
    for number in range(max(0, -(-(size - wide) // hop)) + 1):
        start, end = number * hop * unit, min(number * hop + wide, size) * unit
        best = np.full(byte_cnn.FILTERS, -np.inf)
        for at in range(start, end, step):
            one, two = (np.concatenate([net.embed[b] for b in padded[k : k + step]]) for k in (at, at + step))
            best = np.maximum(best, one @ net.first + two @ net.second)
        hidden = np.maximum(np.maximum(best + net.bias, 0) @ net.hidden + net.hidden_bias, 0)
        document = np.maximum(document, hidden)
    return 1 / (1 + np.exp(-float(np.clip(document @ net.out + net.out_bias[0], -30, 30))))


def test_probabilities_equal_the_network_in_loops():
    rng = np.random.default_rng(4)
    net = byte_cnn.new_net(3)
    net.bias += 0.1
    net.hidden_bias += 0.05
    texts = [rng.integers(0, 256, n, dtype=np.uint8).tobytes() for n in (0, 1, 5, 127, 128, 129, 511, 512, 513, 900, 1500, 4000)]
    offsets = np.cumsum([0, *map(len, texts)])
    found = byte_cnn.probabilities(net, np.frombuffer(b"".join(texts), np.uint8), offsets)
    assert found == pytest.approx([plain_probability(net, t) for t in texts], abs=1e-5)


def test_votes_equal_a_count_in_loops():
    """Family by its largest margin, then one vote for the winner of each pair; ties by the sum of margins."""
    rng = np.random.default_rng(8)
    size = (1 << language_id.BITS) + 1
    names = {"one": ["a", "b", "c"], "two": ["d"], "three": ["e", "f"]}
    model = language_id.LanguageModel(list(names.items()), rng.standard_normal((3, size)).astype(np.float32))
    for langs in names.values():
        for i, a in enumerate(langs):
            for b in langs[i + 1 :]:
                model.pair_weights[a, b] = rng.standard_normal(size).astype(np.float32)
    x = language_id.features(*block([f"text {k} of some words {k * 37}" for k in range(40)]))
    found, _ = model.predict(x)
    for row, lang in zip(x, found, strict=True):
        margins = [float(row @ w[:-1] + w[-1]) for w in model.family_weights]
        langs = list(names.values())[int(np.argmax(margins))]
        votes = dict.fromkeys(langs, 0)
        for i, a in enumerate(langs):
            for b in langs[i + 1 :]:
                w = model.pair_weights[a, b]
                votes[a if float(row @ w[:-1] + w[-1]) > 0 else b] += 1
        assert lang in langs and votes[lang] == max(votes.values())
