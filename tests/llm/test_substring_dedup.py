from __future__ import annotations

import random
from collections import Counter

import pytest

from tidemill.llm import substring_dedup

SCHEMA = "doc_id bigint, text string, n_words string, block int"


def plain(rows: list[tuple], window: int) -> Counter:
    least: dict[tuple, int] = {}
    for i, text in rows:
        words = (text or "").encode().split()
        if i is not None:
            for k in range(len(words) - window + 1):
                v = tuple(words[k : k + window])
                least[v] = min(i, least.get(v, i))
    out = []
    for i, text in rows:
        words = (text or "").encode().split()
        gone = set()
        if i is not None:
            for k in range(len(words) - window + 1):
                if least[tuple(words[k : k + window])] < i:
                    gone |= set(range(k, k + window))
        out.append((i, len(words), len(gone), b" ".join(w for k, w in enumerate(words) if k not in gone).decode()))
    return Counter(out)


def texts(seed: int, n: int) -> list[tuple]:
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(300)] + ["é", "漢字", "a.b", "x" * 40]
    passages = [[rng.choice(vocabulary) for _ in range(rng.randint(13, 80))] for _ in range(6)]
    rows = []
    for i in range(n):
        words: list[str] = []
        for _ in range(rng.randint(0, 4)):
            words += rng.choice(passages) if rng.random() < 0.4 else [rng.choice(vocabulary) for _ in range(rng.randint(0, 50))]
        rows.append((i, rng.choice([" ", "\n", "\t\x0b\x0c\r "]).join(words)))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize(("window", "width_bits", "max_bytes"), [(13, 28, 500_000), (13, 16, 2_000), (3, 16, 300)])
def test_equals_brute_force(spark, window, width_bits, max_bytes):
    """The narrow sketches are full, so nearly all windows reach the exact grouping; the results are the same."""
    rows = texts(window + width_bits, 150)
    rows += [rows[5], rows[5], (rows[7][0], rows[9][1]), (None, rows[5][1]), (None, None), (900, None), (901, ""), (902, " \n\t ")]
    rows += [(903, " ".join(["same"] * 3000)), (904, " ".join(["same"] * 20)), (905, " ".join(f"u{k}" for k in range(20_000)))]
    docs = spark.createDataFrame([(i, t, "clash", 1) for i, t in rows], SCHEMA).repartition(5)
    found = substring_dedup.substring_dedup(docs, window=window, width_bits=width_bits, max_bytes=max_bytes)
    assert Counter(tuple(r) for r in found.collect()) == plain(rows, window)


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert substring_dedup.substring_dedup(docs).collect() == []


def test_estimates_are_never_too_low(spark):
    rows = texts(1, 200)
    packs = substring_dedup.packed(spark.createDataFrame(rows, "id bigint, text string"), "id", "text", 1_000)
    seen: dict[int, set] = {}
    for r in packs.collect():
        import pyarrow as pa

        block = substring_dedup.Block(pa.array(r["ids"], pa.int64()), pa.array(r["texts"], pa.string()), 13)
        for h, t in zip(block.a.tolist(), block.text.tolist(), strict=True):
            seen.setdefault(h, set()).add(r["ids"][t])
    import numpy as np

    found = substring_dedup.sketch(packs, 13, 20)
    hashes = np.array(sorted(seen), np.uint64)
    yes = substring_dedup.maybe_repeated(found, hashes, 20)
    repeated = np.array([len(seen[h]) > 1 for h in hashes.tolist()])
    assert yes[repeated].all() and yes[~repeated].mean() < 0.05
