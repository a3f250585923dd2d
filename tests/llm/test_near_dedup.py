"""Near-duplicate classes against all pairs of a small table."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from tidemill.llm import blocks, near_dedup


def weights(text):
    words = [w for w in "".join(c.lower() if c.isascii() else c for c in (text or "")).replace("\n", " ").replace("\t", " ").split(" ") if w]
    if not words:
        return Counter()
    if len(words) < 5:
        return Counter([tuple(words)])
    return Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def slow_jp(a, b):
    total = 0.0
    for i in a.keys() & b.keys():
        total += 1 / sum(max(a[j] / a[i], b[j] / b[i]) for j in a.keys() | b.keys())
    return total


def fast_jp(a, b):
    """The same where most weights are one: used for the whole table."""
    keys = list(a.keys() | b.keys())
    x, y = np.array([a[k] for k in keys], float), np.array([b[k] for k in keys], float)
    return sum(1 / np.maximum(x / x[i], y / y[i]).sum() for i in range(len(keys)) if x[i] and y[i])


def brute_classes(rows):
    """Class of every (id, text): components of all pairs of at least 0.8."""
    sets = [weights(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    holders = defaultdict(list)
    for i, s in enumerate(sets):
        for g in s:
            holders[g].append(i)
    near = {(i, j) for h in holders.values() for k, i in enumerate(h) for j in h[k + 1 :]}
    for i, j in sorted(near):
        if root(i) != root(j):
            small, large = sorted((len(sets[i]), len(sets[j])))
            same = sets[i] == sets[j]
            if same or (len(sets[i].keys() & sets[j].keys()) >= 0.3 * large and fast_jp(sets[i], sets[j]) >= 0.8):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    members = defaultdict(list)
    for i in range(len(rows)):
        members[root(i)].append(i)
    return {i: min(rows[k][0] for k in m) for m in members.values() for i in m}


def test_probability_jaccard():
    rng = random.Random(3)
    for _ in range(200):
        a = Counter({k: rng.randint(1, 4) for k in range(12) if rng.random() < 0.7})
        b = Counter({k: rng.randint(1, 4) for k in range(12) if rng.random() < 0.7})
        assert near_dedup.probability_jaccard(dict(a), dict(b)) == pytest.approx(slow_jp(a, b))


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(5)
    common, own_a, own_b = (rng.integers(0, 2**63, k, dtype=np.uint64) for k in (300, 60, 60))
    a, b = np.concatenate([common, own_a]), np.concatenate([common, own_b])
    agreement = []
    for seed in range(20):
        x, y = (v + np.uint64(seed) for v in (a, b))
        owner = np.repeat([0, 1], [len(x), len(y)])
        found = near_dedup.signatures(owner, np.concatenate([x, y]), np.ones(len(owner)), 2)
        agreement.append((found[0] == found[1]).mean())
    assert np.mean(agreement) == pytest.approx(300 / 420, abs=0.03)


def test_fingerprints_ignore_spacing_and_ascii_case():
    texts = pa.array(["The cat  sat\n", " the CAT sat", "the cat sat down", None, "", " \n"])
    prints = [p for _, _, d, o in blocks.text_blocks(texts) for p in near_dedup.shingles(d, o)[3]]
    assert prints[0] == prints[1] != prints[2]
    assert prints[3:] == [None, None, None]


def test_whole_table(spark):
    import duckdb

    rows = duckdb.sql("SELECT doc_id, text FROM '/root/testdata/sf0.01/documents.parquet' ORDER BY doc_id").fetchall()
    truth = brute_classes(rows)
    found = near_dedup.near_duplicates(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).collect()
    assert len(found) == len(rows)
    assert {r["doc_id"]: r["class_id"] for r in found} == {rows[i][0]: c for i, c in truth.items()}


def test_chains_hubs_and_edge_rows(spark):
    """A chain whose ends are unlike, a group larger than a block, nulls, blanks, repeats and clashing names."""
    rng = random.Random(11)
    vocab = [f"w{k}" for k in range(4000)]
    base = [rng.choice(vocab) for _ in range(120)]
    rows, chain = [], list(base)
    for i in range(12):  # each step changes three words at the end
        rows.append((i, " ".join(chain)))
        chain = chain[3:] + [rng.choice(vocab) for _ in range(3)]
    group = [rng.choice(vocab) for _ in range(200)]
    for i in range(300):
        one = list(group)
        one[i % 200] = f"x{i}"
        rows.append((100 + i, " ".join(one)))
    rows += [(900, None), (901, ""), (902, " \n\t"), (903, "one two"), (904, "One  two"), (904, "One  two"), (905, "ähnlich é")]
    schema = "doc_id bigint, text string, class_id string, node string, signature string"
    df = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], schema)
    truth = brute_classes([r for r in rows if r[0] < 900])
    found = defaultdict(set)
    for r in near_dedup.near_duplicates(df).collect():
        found[r["doc_id"]].add((r["class_id"], r["class_size"]))
    got = {k: {c for c, _ in v} for k, v in found.items()}
    assert all(got[rows[i][0]] == {c} for i, c in truth.items())
    assert found[100] == {(100, 300)}
    assert got[900] == {900} and got[901] == {901} and got[902] == {902} and got[905] == {905}
    assert found[903] == {(903, 3)} and found[904] == {(903, 3)}
    kept = near_dedup.keep_one(df, near_dedup.near_duplicates(df)).select("doc_id").collect()
    assert sorted(r["doc_id"] for r in kept) == sorted({c for v in got.values() for c in v})


def test_empty_table_and_null_ids(spark):
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    assert near_dedup.near_duplicates(empty).collect() == []
    df = spark.createDataFrame([(None, "a b c d e f"), (7, "a b c d e f"), (None, None)], "doc_id bigint, text string")
    found = sorted((str(r["doc_id"]), str(r["class_id"])) for r in near_dedup.near_duplicates(df).collect())
    assert found == [("7", "7"), ("None", "7"), ("None", "None")]
