from __future__ import annotations

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from tidemill.llm import merkle

SCHEMA = "doc_id bigint, source string, lang string, n_chars bigint, text string, leaf string, I int"


def H(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(v) -> str:
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def plain(rows: list[tuple]) -> list[tuple]:
    """All levels of all trees in lists; proofs by walking up."""
    trees: dict[str, list] = {}
    for r in rows:
        i, source, lang, n, text = r[:5]
        leaf = H(*[field(v) for v in (i, source, lang, n, text)])
        odd = i is not None and text is not None and "\n" in text and zlib.crc32(str(i).encode()) % 2 == 0
        found = H(*[field(v) for v in (i, source, lang, n, text.replace("\n", ""))]) if odd else None
        trees.setdefault("" if source is None else "s" + source, []).append(((i is not None, i or 0), found or "", leaf, i))

    def levels(leaves: list[str]) -> list[list[str]]:
        out = [leaves]
        while len(out[-1]) > 1:
            out.append([H(*out[-1][k : k + 3]) for k in range(0, len(out[-1]), 3)])
        return out

    def path(all_levels, i):
        for level in all_levels[:-1]:
            start = i // 3 * 3
            run = level[start : start + 3]
            yield "".join(run[: i - start]), "".join(run[i - start + 1 :])
            i //= 3

    names = sorted(trees, key=str.encode)
    whole = {n: levels([x[2] for x in sorted(trees[n])]) for n in names}
    top = levels([whole[n][-1][0] for n in names])
    out = []
    for k, n in enumerate(names):
        for i, (_, found, leaf, doc_id) in enumerate(sorted(trees[n])):
            steps = [*path(whole[n], i), *path(top, k)]
            node = found or leaf
            for left, right in steps:
                node = H(left, node, right)
            root = top[-1][0]
            out.append((doc_id, leaf, whole[n][-1][0], root, H(*[x for s in steps for x in s]), node, node == root))
    return sorted(out, key=str)


def verified(spark, rows, levels):
    docs = spark.createDataFrame(rows, SCHEMA)
    altered = (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0) & F.col("text").contains("\n")
    found = F.when(altered, F.replace("text", F.lit("\n"), F.lit("")))
    return merkle.verified(merkle.build(merkle.document_leaves(docs, found), levels))


def test_positions_are_those_of_the_log():
    for n in [*range(1, 40), 81, 82, 243, 250]:
        for extra in (0, 2):
            levels = merkle.height(n) + extra
            leaves = [H(str(i)).encode() for i in range(n)]
            log = merkle.append_log(leaves, levels)
            nodes, seen = leaves, 0
            for level in range(levels + 1):
                for j, node in enumerate(nodes):
                    assert log[merkle.position(level, j, n)] == node
                    seen += 1
                nodes = [merkle.digest(nodes[k : k + 3]) for k in range(0, len(nodes), 3)]
            assert seen == len(log)


@pytest.mark.parametrize("levels", [2, 7])
def test_equals_the_plain_version(spark, levels):
    rng = random.Random(levels)
    rows = []
    for i in range(60):
        source = rng.choice(["hot"] * 6 + ["b", "é", "z", "", None, f"one{i}"])
        text = rng.choice([None, "", "a\nb", f"text {i}\n\n", "x" * 5000, "é\n" * 3])
        rows.append((i, source, rng.choice(["en", None]), rng.choice([None, i]), text, "clash", 1))
    rows += [rows[3], rows[3], (None, "hot", None, None, "null id\n", "clash", 1), (5, "hot", "other", 1, "same id\n", "clash", 1)]
    found = sorted((tuple(r) for r in verified(spark, rows, levels).collect()), key=str)
    assert found == plain(rows)
    assert not all(r[-1] for r in found) and any(r[-1] for r in found)


def test_paths_lead_to_the_root(spark):
    docs = spark.createDataFrame([(i, f"s{i % 4}", "en", 1, f"t{i}", "", 0) for i in range(50)], SCHEMA)
    leaves = merkle.document_leaves(docs, F.lit(None).cast("string"))
    made = merkle.build(leaves, 2)
    rows = merkle.proofs(made).collect()
    assert len(rows) == 50
    for r in rows:
        node = r["leaf"].encode()
        for left, right in merkle.unpacked(bytes(r["path"])):
            node = merkle.digest((left, node, right))
        assert node.decode() == r["root"]


@pytest.mark.parametrize("rows", [[], [(1, None, None, None, None, "", 0)], [(1, "a", "en", 1, "x\n", "", 0), (2, "a", "en", 1, "x\n", "", 0)]])
def test_small_tables(spark, rows):
    assert sorted((tuple(r) for r in verified(spark, rows, 7).collect()), key=str) == plain(rows)
