from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest

from tidemill.llm import conversation_repair as cr

SCHEMA = "conv_id bigint, turn bigint, role string, text string, cost string, _x int"
SPACES = " \t\n\x0b\x0c\r"


def cheapest(rows: list[tuple[str, str, bool]]) -> tuple[int, str]:
    """Dynamic program over suffixes; rows are (initial, fault, ...) and states N, S, U, A."""
    far = (10**9, "")
    best = {"N": (0, ""), "S": far, "U": far, "A": (0, "")}
    follow = {"N": "U", "S": "U", "U": "A", "A": "U"}

    def inserted(best):
        for _ in range(4):
            for q in "NSUA":
                c, s = best[follow[q]]
                best[q] = min(best[q], (c + 2, "I" + s))
        return best

    best = inserted(best)
    for initial, fault in reversed(rows):
        new = {}
        for q in "NSUA":
            options = [(best[q][0] + 3, "D" + best[q][1])]
            if fault not in ("blank", "duplicate"):
                extra = fault == "truncated"
                allowed = {"s": "N", "u": "NSA", "a": "U"}.get(initial, "")
                if q in allowed:
                    c, s = best[initial.upper()]
                    options.append((c + extra, "K" + s))
                c, s = best[follow[q]]
                options.append((c + 2 + extra, "R" + s))
            new[q] = min(options)
        best = inserted(new)
    return best["N"]


def plain(rows: list[tuple]) -> dict:
    convs: dict = {}
    for conv, turn, role, text in rows:
        live = convs.setdefault(conv, [])
        a, b = ("" " " if v is None else str(v) for v in (conv, turn))
        kind = zlib.crc32(f"{a}:{b}".encode()) % 20
        role, text = (" " if v is None else v for v in (role, text))
        if kind == 1:
            text = ""
        if kind == 2:
            text = "".join(c for c in text if c not in ".!?")
        if kind == 4:
            role = "user"
        live += [(turn, role, text)] * {0: 0, 3: 2}.get(kind, 1)
    out = {}
    for conv, live in convs.items():
        live.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        seen, faults = set(), []
        for _, role, text in live:
            shown = text.rstrip(SPACES)
            faults.append("blank" if not shown else "duplicate" if (role, text) in seen else "truncated" if shown[-1] not in ".!?" else "")
            seen.add((role, text))
        cost, audit = cheapest([(r[1][:1], f) for r, f in zip(live, faults, strict=True)])
        texts, roles, at = [], [], 0
        for e in audit:
            follow = "assistant" if roles and roles[-1][0] == "u" else "user"
            if e != "D":
                name = live[at][1] if e == "K" else follow
                roles.append(name)
                texts.append(f"{name}:{'' if e == 'I' else live[at][2]}")
            at += e != "I"
        assert "".join(r[0] for r in roles).removeprefix("s").replace("ua", "") == ""
        turns = {r[0] for r in live if r[0] is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(live, live[1:], strict=False))
        counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
        out[conv] = (gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(texts).encode()).hexdigest())
    return out


def conversations(seed: int, n: int, longest: int) -> list[tuple]:
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        size = rng.choice([1, 2, 3, 5, 8, longest])
        for t in range(size):
            role = rng.choice(["system", "user", "assistant", "user", "assistant", "tool", "", None])
            if rng.random() < 0.7:
                role = ("user", "assistant")[t % 2]
            text = rng.choice(["Yes.", "What? ", "no end", f"text {t}!", f"other {t}", "", " \n", None, f"é{t}."])
            rows.append((c, rng.choice([t, t, t, t, None, t + 2, rng.randint(0, 9)]), role, text))
    return rows


def test_auction_equals_the_dynamic_program():
    rng = random.Random(5)
    sequences = [np.array([rng.choice([0, 1, 2, 1, 2, 3, 9, 10, 8, 11, 4, 5, 6, 7]) for _ in range(rng.choice([0, 1, 2, 7, 24, 25, 90]))], np.uint8) for _ in range(300)]
    names = {0: "s", 1: "u", 2: "a", 3: "x"}
    found = cr.edits(sequences, np.tile(cr._ACCEPTED, (len(sequences), 1)))
    for s, [(letters, _, cost)] in zip(sequences, found, strict=True):
        rows = [(names[c & 3], "blank" if c & 4 else "truncated" if c & 8 else "") for c in s.tolist()]
        assert (cost, letters.decode()) == cheapest(rows)


def test_prices_are_feasible_and_paths_tight():
    rng = np.random.default_rng(3)
    codes, sizes = rng.choice([0, 1, 2, 9, 10, 4, 3], (50, 12)).astype(np.uint8), rng.integers(0, 13, 50)
    lattices = cr.Lattices(codes, sizes, np.tile(cr._ACCEPTED, (50, 1)))
    lattices.converge()
    for k in range(50):
        for layer in range(sizes[k] + 1):
            for state in range(4):
                value, _ = lattices.arcs(np.array([k]), np.array([layer]), np.array([state]))
                assert lattices.price[k, layer, state] <= value.min()


@pytest.mark.parametrize(("max_rows", "max_bytes"), [(4096, 4_000_000), (6, 4_000_000), (3, 20)])
def test_equals_the_plain_version(spark, max_rows, max_bytes):
    rows = conversations(max_rows, 60, 40)
    rows += rows[:4] + [rows[9]] * 30 + [(None, 1, "user", "no id."), (None, None, None, None), (777, 4, "user", "x" * 10_000)]
    drop = next(i for i in range(10_000, 20_000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    rows += [(drop, 0, "user", "dropped.")]
    docs = spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA).repartition(3)
    found = cr.repaired_conversations(cr.damaged(docs), max_rows, max_bytes).collect()
    expected = plain(rows)
    assert len(found) == len(expected)
    assert {r["conv_id"]: tuple(r)[1:] for r in found} == expected
    assert expected[drop] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_empty_table(spark):
    assert cr.repaired_conversations(cr.damaged(spark.createDataFrame([], SCHEMA))).collect() == []
