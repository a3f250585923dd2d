"""Byte-level BPE with the ranks of a public vocabulary file.

Encoding cuts each text into pieces, lists the distinct pieces of a block of documents and folds the
ranked merges over all of them at once: a piece is an array of token ids, beside it the ranks of its
neighbouring pairs; each step merges the leftmost pair of the lowest rank of every piece that still
has one and looks up the two new pairs. The rank map (pair of ids to merged id) is a constant hash
table without collisions. The ids are then put back in the order of the text. Decoding looks up the
bytes of each id and concatenates them.

The steps run on numpy arrays inside ``mapInArrow``. ``fold_merges`` is the same fold as one Spark
column, made of higher-order functions over a literal rank map. It gives the same ids but takes about
a hundred times longer, as such functions are interpreted; the README has the figures.

Null texts count as empty; empty texts have no token and decode to no bytes. Repeated rows and null ids
pass through. Only the id and the text are read. Pieces longer than ``LONG_PIECE`` bytes are merged with
a heap, as the fold takes a step for each merge.
"""

from __future__ import annotations

import base64
import heapq
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from tidemill.llm import blocks

LONG_PIECE = 256
DECODED_ROWS = 256  # rows decoded at a time
ENCODED_BYTES = 400_000  # text encoded at a time
NO_PAIR = 2**31 - 1
SPACE, LETTER, NUMBER, OTHER = 0, 1, 2, 3
# The public pattern that `cut` implements, its contractions, and Unicode's White_Space.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
CONTRACTIONS = (b"'s", b"'t", b"'re", b"'ve", b"'m", b"'ll", b"'d")
WHITE_SPACE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]


@lru_cache(maxsize=1)
def kinds() -> np.ndarray:
    """The kind of every code point."""
    table = np.full(0x110000, OTHER, np.uint8)
    for code in range(0x110000):
        first = unicodedata.category(chr(code))[0]
        if first in "LN":
            table[code] = LETTER if first == "L" else NUMBER
    table[WHITE_SPACE] = SPACE
    return table


def cut(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and text numbers of the pieces that ``PATTERN`` cuts a block into.

    Runs of one kind are pieces, with two exceptions. Of white space before something else, the last
    character is cut off; a plain space joins what follows. A lone apostrophe that no space joins takes
    the letters of a contraction.
    """
    if len(data) == 0:
        empty = np.empty(0, np.int64)
        return empty, empty, empty
    codes = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
    at = np.flatnonzero((data & 0xC0) != 0x80)  # first byte of each character
    kind = kinds()[codes]
    border = np.zeros(len(data) + 1, bool)
    border[offsets] = True
    first = border[at]  # first character of a text
    start = first.copy()
    start[0] = True
    start[1:] |= kind[1:] != kind[:-1]
    last = np.append(first[1:], True)  # last character of a text
    ends_run = np.append(start[1:], True)
    # The last white space before something else in the same text stands alone ...
    tail = (kind == SPACE) & ends_run & ~last
    start |= tail
    # ... and a plain space takes what follows.
    joined = np.append(False, (tail & (codes == 32))[:-1])
    start &= ~joined
    quote = np.flatnonzero((codes == 39) & start & ends_run & ~last)
    quote = quote[(kind[np.minimum(quote + 1, len(kind) - 1)] == LETTER)]
    if len(quote):
        padded = np.append(codes, [0, 0, 0])
        room = np.searchsorted(np.flatnonzero(np.append(first, True)), quote, "right")
        text_end = np.flatnonzero(np.append(first, True))[room]
        for word in CONTRACTIONS:
            hit = np.ones(len(quote), bool)
            for k, letter in enumerate(word):
                hit &= padded[quote + k] == letter
            hit &= quote + len(word) <= text_end
            where = quote[hit]
            start[where + 1] = False
            after = where + len(word)
            inside = after < len(start)
            start[after[inside]] = True
    starts = at[start]
    ends = np.append(starts[1:], len(data))
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


@lru_cache(maxsize=4)
def read_ranks(content: bytes) -> dict[bytes, int]:
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in content.splitlines() if line.strip())}


def merge_piece(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same merges with a heap of candidate pairs: n log n for a piece of n bytes."""
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    n = len(piece)
    part: list[bytes | None] = [piece[i : i + 1] for i in range(n)]
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap: list[tuple[int, int, bytes]] = []

    def offer(i: int) -> None:
        if i >= 0 and after[i] < n:
            both = part[i] + part[after[i]]
            if (rank := ranks.get(both)) is not None:
                heapq.heappush(heap, (rank, i, both))

    for i in range(n):
        offer(i)
    while heap:
        _, i, both = heapq.heappop(heap)
        if part[i] is None or after[i] >= n or part[i] + part[after[i]] != both:
            continue
        gone = after[i]
        part[i], part[gone] = both, None
        after[i] = after[gone]
        if after[i] < n:
            before[after[i]] = i
        offer(before[i])
        offer(i)
    return [ranks[p] for p in part if p is not None]


@dataclass(frozen=True)
class RankTable:
    """Pair of ids (left * 65536 + right) to merged id, as a hash table without collisions."""

    seeds: list[int]
    keys: list[int]
    merged: list[int]
    byte_ids: list[int]
    odd: dict[bytes, int]  # tokens that their own merges do not reach


def _slots(key: int, seed: int, size: int) -> int:
    return ((key * seed) >> 13) % size  # 32 and 30 bits: the product is a positive long


@lru_cache(maxsize=2)
def rank_table(content: bytes) -> RankTable:
    ranks = read_ranks(content)
    pairs = {}
    for token, rank in ranks.items():
        for cut in range(1, len(token)):
            left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
            if left is not None and right is not None:
                pairs[left * 65536 + right] = rank
    n_buckets, size = len(pairs) // 3 + 1, int(len(pairs) * 1.4) + 1
    buckets: list[list[int]] = [[] for _ in range(n_buckets)]
    for key in pairs:
        buckets[key % n_buckets].append(key)
    seeds, keys, merged = [1] * n_buckets, [-1] * size, [NO_PAIR] * size
    for b in sorted(range(n_buckets), key=lambda b: -len(buckets[b])):
        if not buckets[b]:
            continue
        for k in range(1, 1_000_000):
            seed = xxhash.xxh64_intdigest(str(k)) >> 34 | 1
            slots = [_slots(key, seed, size) for key in buckets[b]]
            if len(set(slots)) == len(slots) and all(keys[s] < 0 for s in slots):
                break
        seeds[b] = seed
        for key, s in zip(buckets[b], slots, strict=True):
            keys[s], merged[s] = key, pairs[key]
    shorter = {t: r for t, r in ranks.items() if len(t) > 1}
    odd = {t: r for t, r in shorter.items() if _plain_merge(t, ranks) != [r]}
    return RankTable(seeds, keys, merged, [ranks.get(bytes([b]), -1) for b in range(256)], odd)


def _plain_merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    parts = [piece[i : i + 1] for i in range(len(piece))]
    while len(parts) > 1:
        found = [(ranks.get(a + b, NO_PAIR), i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False))]
        rank, i = min(found)
        if rank == NO_PAIR:
            break
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
    return [ranks[p] for p in parts]


def _numbers(values: list[int], kind: str) -> Column:
    """A literal array, folded from one string."""
    return F.split(F.lit(" ".join(map(str, values))), " ").cast(f"array<{kind}>")


def fold_merges(piece: Column, table: RankTable) -> Column:
    """Token ids of a binary piece of at least one byte."""
    seeds, keys, merged = _numbers(table.seeds, "bigint"), _numbers(table.keys, "bigint"), _numbers(table.merged, "int")
    byte_ids = _numbers(table.byte_ids, "int")
    n_buckets, size = len(table.seeds), len(table.keys)

    def rank(left: Column, right: Column) -> Column:
        key = left * F.lit(65536).cast("bigint") + right
        slot = F.shiftrightunsigned(key * F.get(seeds, (key % n_buckets).cast("int")), 13) % size
        slot = slot.cast("int")
        return F.when(F.get(keys, slot) == key, F.get(merged, slot)).otherwise(F.lit(NO_PAIR))

    def with_place(parts: Column, ranks: Column) -> Column:
        """Parts, ranks, and the position of the lowest rank, 0 if no pair is left."""
        made = F.transform(
            F.array(F.struct(parts.alias("parts"), ranks.alias("ranks"))),
            lambda s: F.struct(
                s["parts"].alias("parts"),
                s["ranks"].alias("ranks"),
                F.when(F.array_min(s["ranks"]) < NO_PAIR, F.array_position(s["ranks"], F.array_min(s["ranks"])).cast("int")).otherwise(0).alias("at"),
            ),
        )
        return F.get(made, 0)

    def step(acc: Column, _: Column) -> Column:
        parts, ranks, at = acc["parts"], acc["ranks"], acc["at"]
        new, n = F.get(ranks, at - 1), F.size(parts)
        left = F.when(at > 1, F.array(rank(F.get(parts, at - 2), new))).otherwise(F.array().cast("array<int>"))
        right = F.when(at + 2 <= n, rank(new, F.get(parts, at + 1))).otherwise(F.lit(NO_PAIR))
        merged_parts = F.concat(F.slice(parts, F.lit(1), at - 1), F.array(new), F.slice(parts, at + 2, n))
        merged_ranks = F.concat(F.slice(ranks, F.lit(1), F.greatest(at - 2, F.lit(0))), left, F.array(right), F.slice(ranks, at + 2, n))
        return F.when(at == 0, acc).otherwise(with_place(merged_parts, merged_ranks))

    code = F.hex(piece)
    n_bytes = F.octet_length(piece)
    digits = "0123456789ABCDEF"
    nibble = lambda c: F.locate(c, F.lit(digits)) if isinstance(c, str) else F.instr(F.lit(digits), c) - 1
    byte = lambda i: (nibble(F.substring(code, 2 * i - 1, F.lit(1))) * 16 + nibble(F.substring(code, 2 * i, F.lit(1))))
    first = F.transform(F.sequence(F.lit(1), n_bytes), lambda i: F.get(byte_ids, byte(i)))
    start = F.get(
        F.transform(
            F.array(first),
            lambda p: with_place(
                p,
                F.transform(p, lambda a, i: F.when(i + 1 < F.size(p), rank(a, F.get(p, i + 1))).otherwise(F.lit(NO_PAIR))),
            ),
        ),
        0,
    )
    folded = F.aggregate(F.sequence(F.lit(1), n_bytes), start, step, lambda acc: acc["parts"])
    for token, token_rank in table.odd.items():
        folded = F.when(piece == F.lit(token), F.array(F.lit(token_rank))).otherwise(folded)
    return folded


@dataclass
class _Arrays:
    """A rank table as arrays."""

    seeds: np.ndarray
    keys: np.ndarray
    merged: np.ndarray
    byte_ids: np.ndarray

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left.astype(np.int64) * 65536 + right
        slot = ((key * self.seeds[key % len(self.seeds)]) >> 13) % len(self.keys)
        return np.where(self.keys[slot] == key, self.merged[slot], NO_PAIR).astype(np.int32)


@lru_cache(maxsize=2)
def _arrays(content: bytes) -> _Arrays:
    t = rank_table(content)
    return _Arrays(np.array(t.seeds, np.int64), np.array(t.keys, np.int64), np.array(t.merged, np.int32), np.array(t.byte_ids, np.int32))


def fold(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, content: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all pieces one after another, and how many each piece has."""
    table, ranks, n = _arrays(content), read_ranks(content), len(starts)
    done_ids: list[np.ndarray] = []
    done_owner: list[np.ndarray] = []
    whole = data.tobytes()
    by_hand = set(np.flatnonzero(ends - starts > LONG_PIECE).tolist())
    if odd := rank_table(content).odd:
        by_hand |= {i for i in range(n) if whole[starts[i] : ends[i]] in odd}
    for i in by_hand:
        done_ids.append(np.array(merge_piece(whole[starts[i] : ends[i]], ranks), np.int32))
        done_owner.append(np.full(len(done_ids[-1]), i))
    live = np.setdiff1d(np.arange(n), np.fromiter(by_hand, np.int64, len(by_hand)))
    size = (ends - starts)[live]
    owner = np.repeat(live, size)
    first = np.concatenate([[0], np.cumsum(size)[:-1]]) if len(live) else np.empty(0, np.int64)
    part = table.byte_ids[data[np.repeat(starts[live] - first, size) + np.arange(len(owner))]]
    rank = np.full(len(part), NO_PAIR, np.int32)
    if len(part) > 1:
        rank[:-1] = np.where(owner[:-1] == owner[1:], table.rank(part[:-1], part[1:]), NO_PAIR)
    while len(part):
        begin = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
        lowest = np.minimum.reduceat(rank, begin)
        length = np.diff(np.append(begin, len(part)))
        ready = np.repeat(lowest == NO_PAIR, length)
        if ready.any():
            done_ids.append(part[ready])
            done_owner.append(owner[ready])
            part, rank, owner = part[~ready], rank[~ready], owner[~ready]
            if not len(part):
                break
            going = lowest < NO_PAIR
            lowest, length = lowest[going], length[going]
        hit = np.flatnonzero(rank == np.repeat(lowest, length))
        hit = hit[np.append(True, owner[hit[1:]] != owner[hit[:-1]])]  # the leftmost of each piece
        part[hit] = rank[hit]
        keep = np.ones(len(part), bool)
        keep[hit + 1] = False
        moved = np.cumsum(keep) - 1
        part, rank, owner, hit = part[keep], rank[keep], owner[keep], moved[hit]
        for left in (hit[hit > 0] - 1, hit[hit < len(part) - 1]):
            same = owner[left] == owner[left + 1]
            rank[left] = np.where(same, table.rank(part[left], part[left + 1]), NO_PAIR)
        rank[-1] = NO_PAIR
    owner = np.concatenate([*done_owner, np.empty(0, np.int64)]).astype(np.int64)
    ids = np.concatenate([*done_ids, np.empty(0, np.int32)]).astype(np.int32)
    order = np.argsort(owner, kind="stable")
    return ids[order], np.bincount(owner, minlength=n)


def _encoded(batches: Iterator[pa.RecordBatch], ranks: bytes) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a, b, data, offsets in blocks.text_blocks(batch.column("text"), ENCODED_BYTES):
            starts, ends, owner = cut(data, offsets)
            _, one, which = np.unique(blocks.span_hashes(data, starts, ends), return_index=True, return_inverse=True)
            ids, n = fold(data, starts[one], ends[one], ranks)
            begin = np.concatenate([[0], np.cumsum(n)])
            count = n[which]
            stop = np.cumsum(count)
            flat = ids[np.repeat(begin[which] - (stop - count), count) + np.arange(stop[-1] if len(stop) else 0)]
            cuts = np.concatenate([[0], stop])[np.searchsorted(owner, np.arange(b - a + 1))]
            tokens = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(flat, pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(a, b - a), tokens], names=["doc_id", "tokens"])


def _decoded(batches: Iterator[pa.RecordBatch], ranks: bytes) -> Iterator[pa.RecordBatch]:
    table = read_ranks(ranks)
    pieces = [b""] * (max(table.values()) + 1)
    for token, rank in table.items():
        pieces[rank] = token
    sizes = np.array([len(p) for p in pieces])
    begin = np.concatenate([[0], np.cumsum(sizes)])
    every = np.frombuffer(b"".join(pieces), np.uint8)
    for batch in batches:
        for first in range(0, len(batch), DECODED_ROWS):
            rows = batch.slice(first, DECODED_ROWS)
            tokens = rows.column("tokens")
            ids = tokens.flatten().to_numpy(zero_copy_only=False)
            size = sizes[ids]
            stop = np.cumsum(size)
            place = np.repeat(begin[ids] - (stop - size), size) + np.arange(stop[-1] if len(stop) else 0)
            lengths = tokens.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            cuts = np.concatenate([[0], stop])[np.concatenate([[0], np.cumsum(lengths)])]
            whole = every[place].tobytes()
            known = tokens.is_valid().to_pylist()
            decoded = [whole[a:b] if k else None for a, b, k in zip(cuts[:-1].tolist(), cuts[1:].tolist(), known, strict=True)]
            yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(decoded, pa.binary())], names=[*rows.schema.names, "decoded"])


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def encode(docs: DataFrame, ranks: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``tokens`` (array of ids) of every row. ``ranks`` is the content of a rank file."""
    return _texts(docs, id_col, text_col).mapInArrow(lambda batches: _encoded(batches, ranks), "doc_id bigint, tokens array<int>")


def decode(encoded: DataFrame, ranks: bytes) -> DataFrame:
    """``encoded`` and the column ``decoded``: the bytes of its ``tokens``. Null tokens decode to null."""
    schema = StructType([*encoded.schema.fields, StructField("decoded", BinaryType())])
    return encoded.mapInArrow(lambda batches: _decoded(batches, ranks), schema)


def round_trip(docs: DataFrame, ranks: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """What ``decode`` makes of ``encode``, by the same two steps in one Python worker a task instead of two: each holds the
    tables of ranks, and blocks of ids need no way through the JVM."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _decoded(_encoded(batches, ranks), ranks)

    return _texts(docs, id_col, text_col).mapInArrow(run, "doc_id bigint, tokens array<int>, decoded binary")
