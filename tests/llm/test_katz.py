"""Katz scores against a dictionary version."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemill.llm import katz
from tidemill.llm.common import id_remainder

START, END = object(), object()


def tokens(text):
    lower = "".join(c.lower() if c.isascii() else c for c in text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", lower), END]


class Model:
    def __init__(self, texts, split):
        self.c1, self.c2, self.hist = Counter(), Counter(), Counter()
        for text in texts:
            before = START
            for t in tokens(text):
                self.c1[t] += 1
                self.c2[before, t] += 1
                self.hist[before] += 1
                before = t
        self.n, self.v = sum(self.c1.values()), len(self.c1)
        times = Counter(self.c1.values())
        self.d1 = katz.good_turing([times[r] for r in range(1, katz.K + 2)])
        times = Counter(self.c2.values())
        self.d2 = katz.good_turing([times[r] for r in range(1, katz.K + 2)])
        freed = sum((1 - self.d(self.d1, c)) * c for c in self.c1.values())
        self.total = self.n if freed > 0 else self.n + 1
        self.unknown = 1 - sum(self.d(self.d1, c) * c for c in self.c1.values()) / self.total if self.n else 1.0
        self.after = defaultdict(dict)
        for (h, w), c in self.c2.items():
            self.after[h][w] = c
        self.bottom, self.alpha = {}, {}
        for h, seen in self.after.items():
            plus = self.hist[h] > split or all(c > katz.K for c in seen.values())
            self.bottom[h] = self.hist[h] + plus
            used = sum(self.d(self.d2, c) * c for c in seen.values()) / self.bottom[h]
            self.alpha[h] = (1 - used) / (1 - sum(self.p1(w) for w in seen))

    @staticmethod
    def d(discounts, c):
        return discounts[c - 1] if c <= katz.K else 1.0

    def p1(self, w):
        c = self.c1.get(w, 0)
        return self.d(self.d1, c) * c / self.total if c else self.unknown

    def p(self, w, h):
        c = self.c2.get((h, w), 0)
        if c:
            return self.d(self.d2, c) * c / self.bottom[h]
        return self.alpha.get(h, 1.0) * self.p1(w)

    def score(self, text):
        before, out, base, known = START, 0.0, 0.0, 0
        for t in tokens(text):
            out += math.log10(self.p(t, before))
            base += math.log10((self.c1[t] + 1) / (self.n + self.v + 1))
            known += self.c1[t] > 0
            before = t
        return len(tokens(text)), known, base, out


def check(rows, found, split=10**9, modulus=7, remainder=2):
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % modulus == remainder
    model = Model([t for i, t in rows if not held(i)], split)
    assert len(found) == len(rows)
    expected = sorted((str(i), held(i), *model.score(t)) for i, t in rows)
    got = sorted((str(r["doc_id"]), r["held_out"], r["n_tokens"], r["n_known"], r["base_score"], r["score"]) for r in found)
    for e, g in zip(expected, got, strict=True):
        assert e[:4] == g[:4]
        assert g[4] == pytest.approx(e[4], rel=1e-9, abs=1e-9)
        assert g[5] == pytest.approx(e[5], rel=1e-9, abs=1e-9)
    assert {r["train_tokens"] for r in found} <= {model.n}
    return model


def held_out():
    return id_remainder("doc_id", 7) == 2


@pytest.mark.parametrize("small", [False, True])
def test_whole_table(spark, monkeypatch, small):
    """Once as it is, and once with split histories, few frequent words, small chunks and many flushes."""
    split = 10**9
    if small:
        monkeypatch.setattr(katz, "BUCKET_TOKENS", 2000)
        monkeypatch.setattr(katz, "MIN_BUCKETS", 16)
        monkeypatch.setattr(katz, "FREQUENT", 500)
        split = 2000
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = katz.katz_scores(docs, held_out()).collect()
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    model = check(rows, found, split)
    if small:
        assert sum(c > split for c in model.hist.values()) > 3
    for h in [START, *list(model.after)[:20]]:
        vocabulary = [*model.c1, "a word never seen"]
        assert sum(model.p(w, h) for w in vocabulary) == pytest.approx(1)


def test_edge_rows(spark):
    rows = [(1, None), (2, ""), (3, "A a a b"), (3, "A a a b"), (None, "c\x0bd é É"), (4, " \t\n"), (16, "zzz a"), (5, "x " * 5000)]
    df = spark.createDataFrame([(*r, 1.0, "n") for r in rows], "doc_id bigint, text string, score double, key string")
    check(rows, katz.katz_scores(df, held_out()).collect())


def test_no_training_rows_and_empty_table(spark):
    df = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id bigint, text string")
    found = katz.katz_scores(df, F.lit(True)).collect()
    assert [(r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"], r["score"]) for r in sorted(found)] == [(3, 0, 0, 0, 0), (1, 0, 0, 0, 0)]
    assert katz.katz_scores(df.limit(0), held_out()).collect() == []


def test_every_pair_seen_often(spark):
    """Nothing is discounted: one is added to each history's count."""
    rows = [(i, "a b c " * 4) for i in range(60)] + [(100, "a c"), (101, "c c d")]
    rows = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 7 != 2 or r[0] >= 100]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    check(rows, katz.katz_scores(df, held_out()).collect())


def test_scores_do_not_depend_on_the_size_of_batches(spark):
    """More short texts in an Arrow batch than a chunk can number."""
    docs = spark.range(40_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("w"), F.col("id") % 7, F.lit(" a"), F.col("id") % 3).alias("text")).coalesce(1)
    key, before = "spark.sql.execution.arrow.maxRecordsPerBatch", spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    found = []
    try:
        for rows in (10_000, 40_000):
            spark.conf.set(key, rows)
            scored = katz.katz_scores(docs, F.col("doc_id") % 5 == 0)
            found.append(scored.agg(F.count(F.lit(1)), F.round(F.sum("score"), 6)).first())
    finally:
        spark.conf.set(key, before)
    assert found[0] == found[1] and found[0][0] == 40_000


def test_sums_follow_what_texts_get():
    """Many buckets of a task that touch few of many texts: added up in place, one short row a chunk at the end."""
    sums = katz._Sums()
    for bucket in range(50):
        first = sums.places([7, 9], [16_000, 12_000])
        assert first.tolist() == [0, 16_000] and sums.scores.shape[1] == 28_000
        np.add.at(sums.scores[0], first[1] + np.array([3, 3, 11_999]), [0.5, 0.25, bucket])
        np.add.at(sums.counts[2], first[1] + np.array([3]), 10)
    [(kind, chunk, _, _, data)] = sums.rows()
    text, base, score, small, wide = katz._unpack(data, ["u2", "f8", "f8", "u1", "i4"])
    assert (kind, chunk, text.tolist(), base.tolist(), score.tolist(), len(small)) == ("sums", 9, [3, 11_999], [37.5, 1225.0], [0, 0], 0)
    assert wide.reshape(1 + katz.K, 2)[2].tolist() == [500, 0] and wide.sum() == 500
    assert len(data) < 200 and list(sums.rows()) == [] and sums.size == 0
