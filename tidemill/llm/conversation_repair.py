"""Cheapest repair of conversations by an auction algorithm for shortest paths.

A conversation is a lattice: node ``(i, state)`` says that ``i`` rows are behind and what the last role kept was
(none, system, user, assistant). Arcs are edits: Keep a row (0) where its role may follow, Rerole it to
user or assistant (2), Delete it (3; the only arc of blank and duplicate rows), Insert an empty user or
assistant turn (2). A truncated row that is not deleted adds 1. Roles must end up as ``(s?(ua)+)?``.

The auction keeps a price for each node and one path. The path's last node looks for the cheapest
``cost + price`` among its successors: if its own price is lower, it is raised to that and the path contracts by one
node, else the path is extended by the best successor, until it reaches the end. Prices never exceed ``cost +
price`` of a successor, so all arcs of all cheapest paths are tight when it is done. They are traced from the
start by the least letter (D, I, K, R) whose arc is tight and leads to the end through tight arcs.

Many lattices are priced at a time. Long conversations are cut into *cells* of ``CELL`` rows: the auction gives the
16 distances from each state at a cell's start to each at its end, their min-plus products give the
prices at the borders, and a second auction in each cell with these as prices of its end gives the arcs.
Conversations beyond ``LONG_ROWS`` rows or ``LONG_BYTES`` bytes are spread over tasks in blocks in the same way; only the
hash of their repaired text, which is sequential, streams through one task.

Null roles and texts count as one space, rows are ordered by turn (nulls first), then role, then text.
Equal rows are duplicates of the first. A null conversation id is a conversation of its own. Conversations that
lose all rows give zeros. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.llm import blocks
from tidemill.plans.lookup import lookup_join
from tidemill.plans.ordered import range_count
from tidemill.plans.scratch import materialize

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
CELL = 24
LONG_ROWS, LONG_BYTES = 4096, 4_000_000
FAR = np.int64(1) << np.int64(40)

NONE, SYSTEM, USER, ASSISTANT = range(4)
FORCED, CUT = 4, 8  # flags of a row's code; the lowest two bits say s, u, a or another initial
_INITIALS = {"s": 0, "u": 1, "a": 2}
_NEXT = np.array([USER, USER, ASSISTANT, USER])
_ACCEPTED = np.array([0, FAR, FAR, 0])
_LEGAL = {"su", "ua", "au"}
SPACES = " \t\n\x0b\x0c\r"


def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """By code and state: cost and target of Keep, cost of Rerole."""
    keep, target, rerole = np.full((16, 4), FAR), np.zeros((16, 4), np.int64), np.full((16, 4), FAR)
    for code in range(16):
        extra = TRUNCATED if code & CUT else 0
        if code & FORCED:
            continue
        rerole[code] = REROLE + extra
        for state, follow in ((0, (NONE,)), (1, (NONE, SYSTEM, ASSISTANT)), (2, (USER,))):
            if code & 3 == state:
                keep[code, list(follow)] = KEEP + extra
                target[code, list(follow)] = state + 1
    return keep, target, rerole


_KEEP, _TARGET, _REROLE = _tables()


# --- lattices -------------------------------------------------------------------------------------


class Lattices:
    """Lattices of equal depth: ``codes`` is padded, ``sizes`` are their rows, ``end`` the prices of the last layer."""

    def __init__(self, codes: np.ndarray, sizes: np.ndarray, end: np.ndarray) -> None:
        self.codes, self.sizes, self.end = codes, sizes, np.minimum(end, FAR)
        self.count, depth = codes.shape
        self.layers = depth + 1
        # One more layer stands for "no such node": its price is out of reach.
        self.price = np.zeros((self.count, self.layers + 1, 4), np.int64)
        self.price[:, -1] = FAR
        lost = (self.end[:, USER] >= FAR) & (self.end[:, ASSISTANT] >= FAR)
        self.price[lost, :, USER:] = FAR  # from here an end without user and assistant can't be reached

    def arcs(self, which: np.ndarray, layer: np.ndarray, state: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Cost plus price, and target state, of the five arcs of some nodes: end, Delete, Insert, Keep, Rerole."""
        last = layer >= self.sizes[which]
        code = self.codes[which, np.minimum(layer, self.layers - 2)] if self.layers > 1 else np.zeros(len(which), np.uint8)
        below = np.where(last, self.layers, layer + 1)
        after, target = _NEXT[state], _TARGET[code, state]
        value = np.stack(
            [
                np.where(last, self.end[which, state], FAR),
                DELETE + self.price[which, below, state],
                INSERT + self.price[which, layer, after],
                _KEEP[code, state] + self.price[which, below, target],
                _REROLE[code, state] + self.price[which, below, after],
            ],
            1,
        )
        return np.minimum(value, FAR), np.stack([state, state, after, target, after], 1)

    def run(self, origin: int) -> None:
        """The auction from one state of the first layer, for all lattices at a time."""
        active = np.arange(self.count)
        path = np.zeros((self.count, 4 * self.layers + 1, 2), np.int64)
        path[:, 0, 1] = origin
        tip = np.zeros(self.count, np.int64)
        while len(active):
            at = tip[active]
            layer, state = path[active, at, 0], path[active, at, 1]
            value, target = self.arcs(active, layer, state)
            best = value.argmin(1)
            pick = np.arange(len(active))
            least = value[pick, best]
            raised = self.price[active, layer, state] < least
            self.price[active[raised], layer[raised], state[raised]] = least[raised]
            tip[active] = np.where(raised, np.maximum(at - 1, 0), at)
            grown = ~raised & (best > 0) & (least < FAR)
            who = active[grown]
            tip[who] = at[grown] + 1
            path[who, tip[who], 0] = layer[grown] + (best[grown] != 2)
            path[who, tip[who], 1] = target[pick[grown], best[grown]]
            active = active[~((~raised & ((best == 0) | (least >= FAR))))]

    def converge(self) -> None:
        for origin in range(4):
            self.run(origin)

    def leads(self) -> np.ndarray:
        """Nodes from which the end is reached through tight arcs."""
        good = np.zeros((self.count, self.layers + 1, 4), bool)
        everyone = np.arange(self.count)
        for layer in range(self.layers - 1, -1, -1):
            here = np.full(self.count, layer)
            below = np.where(layer >= self.sizes, self.layers, layer + 1)
            inserted = []
            for state in range(4):
                value, target = self.arcs(everyone, here, np.full(self.count, state))
                own = self.price[:, layer, state]
                tight = (value == own[:, None]) & (own < FAR)[:, None]
                good[:, layer, state] = tight[:, 0]
                for arc in (1, 3, 4):
                    good[:, layer, state] |= tight[:, arc] & good[everyone, below, target[:, arc]]
                inserted.append(tight[:, 2])
            for _ in range(3):  # a chain of tight inserts visits three states at most
                for state in range(4):
                    good[:, layer, state] |= inserted[state] & good[:, layer, _NEXT[state]]
        return good

    def trace(self, good: np.ndarray, entry: int) -> tuple[list[bytes], np.ndarray]:
        """Least letters of a cheapest path from ``entry``, and the state at its end."""
        letters = np.zeros((self.count, 4 * self.layers), np.uint8)
        size = np.zeros(self.count, np.int64)
        layer, state = np.zeros(self.count, np.int64), np.full(self.count, entry)
        active = np.flatnonzero(good[:, 0, entry])
        names = np.frombuffer(b".DIKR", np.uint8)
        while len(active):
            i, q = layer[active], state[active]
            value, target = self.arcs(active, i, q)
            below = np.where(i >= self.sizes[active], self.layers, i + 1)
            fits = value == self.price[active, i, q][:, None]
            for arc in range(1, 5):
                fits[:, arc] &= good[active, i if arc == 2 else below, target[:, arc]]
            best = fits.argmax(1)
            go = best > 0
            who, arc = active[go], best[go]
            letters[who, size[who]] = names[arc]
            size[who] += 1
            layer[who] += arc != 2
            state[who] = target[go, arc]
            active = who
        return [letters[k, : size[k]].tobytes() for k in range(self.count)], state


def _cells(sequences: Sequence[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Padded codes and sizes of all cells, and the number of the first cell of each sequence."""
    parts = [max(1, -(-len(s) // CELL)) for s in sequences]
    first = np.concatenate([[0], np.cumsum(parts)])
    pieces = [s[k : k + CELL] for s, n in zip(sequences, parts, strict=True) for k in range(0, n * CELL, CELL)]
    sizes = np.array([len(p) for p in pieces])
    codes = np.zeros((len(pieces), max(1, int(sizes.max()))), np.uint8)
    for k, p in enumerate(pieces):
        codes[k, : len(p)] = p
    return codes, sizes, first


def distances(codes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Cheapest costs from each state at the start to each state at the end of some cells."""
    out = np.empty((len(codes), 4, 4), np.int64)
    for state in range(4):
        end = np.full((len(codes), 4), FAR)
        end[:, state] = 0
        lattices = Lattices(codes, sizes, end)
        lattices.converge()
        out[:, :, state] = lattices.price[:, 0]
    return np.minimum(out, FAR)


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.minimum((a[:, :, None] + b[None]).min(1), FAR)


def whole_distances(codes: np.ndarray) -> np.ndarray:
    """The same for one sequence of any length."""
    cells, sizes, _ = _cells([codes])
    out = None
    for m in distances(cells, sizes):
        out = m if out is None else product(out, m)
    return out


def edits(sequences: Sequence[np.ndarray], ends: np.ndarray, entries: Sequence[int] = (NONE,)) -> list[list[tuple[bytes, int, int]]]:
    """For each sequence and entry state: letters, state at the end and cost of the least cheapest path."""
    if not len(sequences):
        return []
    codes, sizes, first = _cells(sequences)
    end = np.empty((len(codes), 4), np.int64)
    end[first[1:] - 1] = ends
    several = np.ones(len(codes), bool)
    several[first[:-1][np.diff(first) == 1]] = False
    if several.any():
        known = np.zeros((len(codes), 4, 4), np.int64)
        known[several] = distances(codes[several], sizes[several])
        for a, b in zip(first[:-1], first[1:], strict=True):
            for k in range(b - 1, a, -1):
                end[k - 1] = np.minimum((known[k] + end[k]).min(1), FAR)
    lattices = Lattices(codes, sizes, end)
    lattices.converge()
    good = lattices.leads()
    traced = {q: lattices.trace(good, q) for q in (range(4) if several.any() else entries)}
    out = []
    for a, b in zip(first[:-1], first[1:], strict=True):
        found = []
        for entry in entries:
            state, letters = entry, []
            for k in range(a, b):
                letters.append(traced[state][0][k])
                state = int(traced[state][1][k])
            found.append((b"".join(letters), state, int(lattices.price[a, 0, entry])))
        out.append(found)
    return out


# --- rows -----------------------------------------------------------------------------------------


def code_of(role: str, text: str, again: bool) -> tuple[int, int]:
    """Code of a row and its fault: 0 none, 1 blank, 2 duplicate, 3 truncated."""
    initial = _INITIALS.get(role[:1], 3)
    shown = text.rstrip(SPACES)
    if not shown:
        return initial | FORCED, 1
    if again:
        return initial | FORCED, 2
    return (initial, 0) if shown[-1] in ".!?" else (initial | CUT, 3)


def repaired(letters: bytes, roles: Sequence[str], texts: Sequence[str], state: int) -> Iterator[str]:
    """``role:text`` of the rows that a path leaves, ``state`` being the one before its first letter."""
    row = 0
    for letter in letters.decode():
        if letter == "D":
            row += 1
            continue
        if letter == "K":
            state = {"s": SYSTEM, "u": USER, "a": ASSISTANT}[roles[row][0]]
        else:
            state = ASSISTANT if state == USER else USER
        name = roles[row] if letter == "K" else "assistant" if state == ASSISTANT else "user"
        yield f"{name}:{texts[row] if letter != 'I' else ''}"
        row += letter != "I"


def _keyed(messages: DataFrame, conv_col: str) -> DataFrame:
    key = F.coalesce(F.concat(F.lit("c"), F.col(conv_col).cast("string")), F.lit(""))
    return messages.withColumn("_key", key)


RESULT = "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string"
NAMES = [f.split()[0] for f in RESULT.split(", ")]


def _short(rows: DataFrame) -> DataFrame:
    """Whole conversations, one per row: ``_key`` and the results."""
    packed = rows.groupBy("_key").agg(
        F.sort_array(F.collect_list(F.when(F.col("copies") > 0, F.struct("turn", "role", "text", "copies")))).alias("rows")
    )
    packed = packed.select("_key", "rows.turn", "rows.role", "rows.text", "rows.copies")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in NAMES]
            sequences, kept = [], []
            for turns, roles, texts, copies in zip(*[batch.column(c).to_pylist() for c in ("turn", "role", "text", "copies")], strict=True):
                if max(copies, default=1) > 1:
                    turns, roles, texts = ([v for v, n in zip(x, copies, strict=True) for _ in range(n)] for x in (turns, roles, texts))
                seen: set[tuple[str, str]] = set()
                codes, faults = [], [0, 0, 0, 0]
                for role, text in zip(roles, texts, strict=True):
                    code, fault = code_of(role, text, (role, text) in seen)
                    seen.add((role, text))
                    codes.append(code)
                    faults[fault] += 1
                known = {t for t in turns if t is not None}
                gaps = max(known) - min(known) + 1 - len(known) if known else 0
                illegal = sum(a[:1] + b[:1] not in _LEGAL for a, b in zip(roles, roles[1:], strict=False))
                for column, value in zip(out, [gaps, *faults[1:], illegal], strict=False):
                    column.append(value)
                sequences.append(np.array(codes, np.uint8))
                kept.append((roles, texts))
            for [(letters, _, cost)], (roles, texts) in zip(edits(sequences, np.tile(_ACCEPTED, (len(sequences), 1))), kept, strict=True):
                whole = "\n".join(repaired(letters, roles, texts, NONE))
                for column, value in zip(out[5:], (cost, letters.decode(), hashlib.sha256(whole.encode()).hexdigest()), strict=True):
                    column.append(value)
            arrays = [pa.array(v, pa.string() if n in NAMES[-2:] else pa.int64()) for n, v in zip(NAMES, out, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("_key"), *arrays], names=["_key", *NAMES])
            blocks.give_back()

    return packed.mapInArrow(run, f"_key string, {RESULT}")


# --- conversations beyond one task ----------------------------------------------------------------

_SUMMARY = (
    "_key string, place bigint, codes binary, copies array<bigint>, roles array<string>, texts array<string>, "
    "first_turn bigint, last_turn bigint, turns bigint, first_role string, last_role string, faults array<bigint>, illegal bigint, moves array<bigint>"
)


def _long_blocks(rows: DataFrame, max_rows: int, max_bytes: int) -> DataFrame:
    """Rows of long conversations in order, cut into blocks with their 16 distances.

    Equal rows are counted first: after the first copy all others are forced deletions. The first row of each role
    and text is found by grouping and matched by its place, so no join meets a hot key.
    """
    group = ["_key", "turn", "role", "text"]
    live = rows.where("copies > 0").select(*group, "copies")
    first = live.groupBy("_key", "role", "text").agg(F.min(F.struct("turn")).alias("m"))
    first = first.select("_key", F.col("m.turn").alias("turn"), "role", "text", F.lit(0).cast("bigint").alias("copies"), F.lit(1).alias("first"))
    both = live.select(*group, F.col("copies").cast("bigint"), F.lit(0).alias("first")).unionByName(first)
    runs = both.groupBy(*group).agg(F.sum("copies").alias("copies"), F.max("first").alias("first"))
    runs = materialize(runs, "runs")
    dealt = runs.repartitionByRange(range_count(runs), "_key", "turn", "role", F.substring("text", 1, 1024))
    dealt = dealt.sortWithinPartitions(*group)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = TaskContext.get().partitionId() << 32
        held: list[dict] = []
        size = 0

        def done() -> pa.RecordBatch:
            nonlocal place
            place += 1
            codes, faults, illegal, extra = [], [0, 0, 0, 0], 0, 0
            for k, r in enumerate(held):
                code, fault = code_of(r["role"], r["text"], not r["first"])
                codes.append(code)
                faults[fault] += 1
                faults[1 if fault == 1 else 2] += r["copies"] - 1
                extra += r["copies"] - 1
                illegal += r["copies"] - 1
                illegal += k > 0 and held[k - 1]["role"][:1] + r["role"][:1] not in _LEGAL
            turns = [r["turn"] for r in held if r["turn"] is not None]
            moves = np.minimum(whole_distances(np.array(codes, np.uint8)) + DELETE * extra, FAR)
            row = {
                "_key": held[0]["_key"],
                "place": place,
                "codes": bytes(codes),
                "copies": [r["copies"] for r in held],
                "roles": [r["role"] for r in held],
                "texts": [r["text"] for r in held],
                "first_turn": turns[0] if turns else None,
                "last_turn": turns[-1] if turns else None,
                "turns": len(set(turns)),
                "first_role": held[0]["role"][:1],
                "last_role": held[-1]["role"][:1],
                "faults": faults[1:],
                "illegal": illegal,
                "moves": moves.reshape(-1).tolist(),
            }
            return pa.RecordBatch.from_pylist([row], schema)

        schema = _arrow(_SUMMARY)
        for batch in batches:
            for r in batch.to_pylist():
                if held and (r["_key"] != held[0]["_key"] or len(held) >= max_rows or size >= max_bytes):
                    yield done()
                    held, size = [], 0
                held.append(r)
                size += len(r["text"])
        if held:
            yield done()

    return dealt.select("_key", "turn", "role", "text", "copies", "first").mapInArrow(run, _SUMMARY)


def _arrow(schema: str) -> pa.Schema:
    kinds = {"string": pa.string(), "bigint": pa.int64(), "binary": pa.binary()}
    kinds |= {f"array<{k}>": pa.list_(v) for k, v in kinds.items()}
    return pa.schema([(f.split()[0], kinds[f.split()[1]]) for f in schema.split(", ")])


def _grouped(summaries: DataFrame, *columns: str) -> DataFrame:
    """One row for each long conversation: lists of ``columns`` in order. Blocks are few: one for thousands of rows."""
    rows = F.sort_array(F.collect_list(F.struct("place", *columns))).alias("rows")
    return summaries.groupBy("_key").agg(rows).select("_key", "rows.place", *[f"rows.{c}" for c in columns])


def _long(rows: DataFrame, max_rows: int, max_bytes: int) -> DataFrame:
    made = materialize(_long_blocks(rows, max_rows, max_bytes), "blocks")
    columns = ["first_turn", "last_turn", "turns", "first_role", "last_role", "faults", "illegal", "moves"]

    def carry(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Prices at the end of each block, from the last to the first, and the counts of the whole."""
        schema = _arrow("_key string, place array<bigint>, ends array<bigint>, counts array<bigint>")
        for batch in batches:
            for r in batch.to_pylist():
                end, ends = _ACCEPTED.astype(np.int64), []
                for moves in reversed(r["moves"]):
                    ends.append(end)
                    end = np.minimum((np.array(moves).reshape(4, 4) + end).min(1), FAR)
                known = [k for k, t in enumerate(r["first_turn"]) if t is not None]
                gaps = 0
                if known:
                    shared = sum(r["last_turn"][a] == r["first_turn"][b] for a, b in zip(known, known[1:], strict=False))
                    gaps = r["last_turn"][known[-1]] - r["first_turn"][known[0]] + 1 - (sum(r["turns"]) - shared)
                borders = zip(r["last_role"], r["first_role"][1:], strict=False)
                illegal = sum(r["illegal"]) + sum(a + b not in _LEGAL for a, b in borders)
                counts = [gaps, *[sum(f) for f in zip(*r["faults"], strict=True)], illegal, int(end[NONE])]
                row = {"_key": r["_key"], "place": r["place"], "ends": np.concatenate(ends[::-1]).tolist(), "counts": counts}
                yield pa.RecordBatch.from_pylist([row], schema)

    carried = _grouped(made, *columns).mapInArrow(carry, "_key string, place array<bigint>, ends array<bigint>, counts array<bigint>")
    carried = materialize(carried, "carried")
    places = carried.select("_key", F.posexplode("place").alias("k", "place"), "ends")
    places = places.select("_key", "place", F.slice("ends", 4 * F.col("k") + 1, F.lit(4)).alias("ends"))

    def trace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The path through each block from each state that may be before it."""
        schema = _arrow("_key string, place bigint, letters array<binary>, states array<bigint>")
        for batch in batches:
            for r in batch.to_pylist():
                [found] = edits([np.frombuffer(r["codes"], np.uint8)], np.array([r["ends"]]), range(4))
                row = {"_key": r["_key"], "place": r["place"], "letters": [f[0] for f in found], "states": [f[1] for f in found]}
                yield pa.RecordBatch.from_pylist([row], schema)

    traced = lookup_join(made.select("_key", "place", "codes"), places, ["_key", "place"], "inner")
    traced = materialize(traced.mapInArrow(trace, "_key string, place bigint, letters array<binary>, states array<bigint>"), "traced")
    entry = F.aggregate(
        "states", F.array(F.lit(0).cast("bigint")), lambda acc, s: F.concat(acc, F.array(F.get(s, F.element_at(acc, -1).cast("int"))))
    )
    entries = _grouped(traced, "states").select("_key", F.posexplode("place").alias("k", "place"), entry.alias("entry"))
    entries = entries.select("_key", "place", F.get("entry", F.col("k")).alias("entry"))
    chosen = lookup_join(traced, materialize(entries, "entries"), ["_key", "place"], "inner")
    chosen = chosen.select("_key", "place", "entry", F.get("letters", F.col("entry").cast("int")).alias("letters"))
    ordered = made.select("_key", "place", "copies", "roles", "texts").join(chosen, ["_key", "place"])
    ordered = ordered.repartition("_key").sortWithinPartitions("_key", "place")

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Audit and hash of each conversation, its blocks streaming by."""
        now, audit, state = None, [], hashlib.sha256()
        begun = False
        schema = _arrow("_key string, audit string, repaired_sha256 string")

        def done() -> pa.RecordBatch:
            row = {"_key": now, "audit": b"".join(audit).decode(), "repaired_sha256": state.hexdigest()}
            return pa.RecordBatch.from_pylist([row], schema)

        for batch in batches:
            for r in batch.to_pylist():
                if r["_key"] != now:
                    if now is not None:
                        yield done()
                    now, audit, state, begun = r["_key"], [], hashlib.sha256(), False
                audit.append(_with_copies(r["letters"], r["copies"]))
                for line in repaired(r["letters"], r["roles"], r["texts"], r["entry"]):
                    state.update((b"\n" if begun else b"") + line.encode())
                    begun = True
        if now is not None:
            yield done()

    hashed = ordered.select("_key", "copies", "roles", "texts", "letters", "entry").mapInArrow(digest, "_key string, audit string, repaired_sha256 string")
    counts = [F.get("counts", F.lit(k)).alias(name) for k, name in enumerate(NAMES[:6])]
    return carried.select("_key", *counts).join(hashed, "_key").select("_key", *NAMES)


def _with_copies(letters: bytes, copies: Sequence[int]) -> bytes:
    """Letters with the deletions of further copies, which come before any insert."""
    if max(copies) == 1:
        return letters
    out, row = [], 0
    for k in range(len(letters)):
        out.append(letters[k : k + 1])
        if letters[k] != ord("I"):
            out.append(b"D" * (copies[row] - 1))
            row += 1
    return b"".join(out)


def repair(rows: DataFrame, max_rows: int = LONG_ROWS, max_bytes: int = LONG_BYTES) -> DataFrame:
    """One row for each ``_key`` of ``(_key, turn, role, text, copies)``; rows with no copies only name their key."""
    size = rows.groupBy("_key").agg(F.sum("copies").alias("n"), F.sum(F.col("copies") * F.octet_length("text")).alias("b"))
    long = materialize(size.where((F.col("n") > max_rows) | (F.col("b") > max_bytes)).select("_key"), "long")
    if long.isEmpty():
        return _short(rows)
    marked = lookup_join(rows, long.withColumn("long", F.lit(True)), ["_key"], "left")
    short = _short(marked.where("long IS NULL").drop("long"))
    return short.unionByName(_long(marked.where("long").drop("long"), max_rows, max_bytes))


def damaged(messages: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Messages with seeded faults: by the CRC-32 of ``conv:turn`` modulo 20 a row is dropped (0), emptied (1), loses its
    sentence ends (2), comes twice (3) or gets the role user (4)."""

    def part(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(part(conv_col), F.lit(":"), part(turn_col)).cast("binary")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(part(text_col), "[.!?]", "")).otherwise(part(text_col))
    return _keyed(messages, conv_col).select(
        "_key",
        F.col(conv_col).alias("conv_id"),
        F.col(turn_col).cast("bigint").alias("turn"),
        F.when(kind == 4, "user").otherwise(part(role_col)).alias("role"),
        text.alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"),
    )


def repaired_conversations(rows: DataFrame, max_rows: int = LONG_ROWS, max_bytes: int = LONG_BYTES) -> DataFrame:
    """The results of :func:`repair` by ``conv_id``; ``rows`` as :func:`damaged` gives them."""
    id_type = rows.schema["conv_id"].dataType.simpleString()
    conv_id = F.when(F.col("_key") != "", F.expr("substring(_key, 2)").cast(id_type))
    return repair(rows.drop("conv_id"), max_rows, max_bytes).select(conv_id.alias("conv_id"), *NAMES)
