"""Removal of repeated passages: windows of words that also start in a document with a smaller id.

1. Texts are packed into written blocks of about 0.5 MB, the unit that later answers are addressed to.
2. Every task counts the windows of its blocks, once for each document, in a count-min sketch of
   ``ROWS`` rows of ``2**width_bits`` counters that stop at two. Parts of the sketch are merged cell by cell,
   spread by part. Estimates are never too low, so a window that is in two documents is always
   estimated so. Only one bit for each counter goes on: 64 MB at the default width, whatever the input.
3. A second pass sends the windows estimated repeated, once for each block with the block's smallest id, to
   buckets of 96-bit keys, where they are grouped exactly. A window of very many documents is one
   entry for each block. Each entry gets one bit back: is there a smaller id in another block.
4. The last pass works out the same entries again, combines their bits with the ids inside the block
   and covers the words.

Beyond about ``2**width_bits`` windows the sketch lets more windows through to the exact grouping, up to all of
them; results never depend on its width.

Texts that are null, empty or shorter than a window are kept whole. Rows without an id neither lose words nor
make others lose any. Rows with equal ids do not remove from each other. Each input row gives one row.
Columns other than id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm import blocks
from tidemill.plans.lookup import lookup_join
from tidemill.plans.scratch import materialize, scratch_path

WINDOW = 13
WIDTH_BITS = 28
ROWS = 2
SHARD_BITS = 16
PACKED_BYTES = 500_000
FLUSH = 3_000_000  # windows that a task counts before it writes its part of the sketch
BUCKET_BYTES = 24_000_000  # text whose windows share a bucket

_U = np.uint64
_ESCAPE = 255
_SEEDS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_NO_ID = np.iinfo(np.int64).max



# --- blocks of texts ------------------------------------------------------------------------------


def packed(docs: DataFrame, id_col: str, text_col: str, max_bytes: int = PACKED_BYTES) -> DataFrame:
    """``(block, bytes, ids, texts)``, one row for each run of rows of about ``max_bytes``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            for a, b, data, _ in blocks.text_blocks(batch.column("text"), max_bytes):
                rows = batch.slice(a, b - a)
                border = pa.array([0, b - a], pa.int32())
                lists = [pa.ListArray.from_arrays(border, rows.column(c)) for c in ("id", "text")]
                yield pa.RecordBatch.from_arrays([pa.array([block]), pa.array([len(data)]), *lists], names=["block", "bytes", "ids", "texts"])
                block += 1

    slim = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"))
    return slim.mapInArrow(run, "block bigint, bytes bigint, ids array<bigint>, texts array<string>")


class Block:
    """The windows of one packed row."""

    def __init__(self, ids: pa.Array, texts: pa.Array, window: int) -> None:
        whole = list(blocks.text_blocks(texts, max_bytes=2**62))
        self.data, self.offsets = whole[0][2:] if whole else (np.empty(0, np.uint8), np.zeros(1, np.int64))
        null = ids.is_null().to_numpy(zero_copy_only=False)
        self.ids = ids.fill_null(_NO_ID).to_numpy(zero_copy_only=False)
        self.starts, self.ends, self.owner = blocks.words(self.data, self.offsets)
        self.word = blocks.span_hashes(self.data, self.starts, self.ends)
        n = max(0, len(self.word) - window + 1)
        inside = self.owner[:n] == self.owner[window - 1 :] if n else np.empty(0, bool)
        self.first = np.flatnonzero(inside & ~null[self.owner[:n]])
        self.text = self.owner[self.first]
        self.window = window
        self.a = self._hashes(self.word)[self.first]

    def _hashes(self, word: np.ndarray) -> np.ndarray:
        """Hashes of all windows, from running sums."""
        size = (len(self.data) // blocks.BLOCK_BYTES + 1) * blocks.BLOCK_BYTES
        up, down = blocks._powers(size)
        sums = np.zeros(len(word) + 1, _U)
        np.cumsum(word * up[: len(word)], out=sums[1:])
        n = max(0, len(word) - self.window + 1)
        return blocks.mix((sums[self.window :][:n] - sums[:n]) * down[:n])

    def b(self, chosen: np.ndarray) -> np.ndarray:
        """The other 32 bits of the keys of some windows."""
        return (self._hashes(blocks.mix(self.word ^ _U(_SEEDS[0])))[self.first[chosen]] >> _U(32)).astype(np.uint32)


def _blocks(batch: pa.RecordBatch, window: int) -> Iterator[Block]:
    ids, texts = batch.column("ids"), batch.column("texts")
    for k in range(len(batch)):
        yield Block(ids[k].values, texts[k].values, window)
    blocks.give_back()


# --- sketch ---------------------------------------------------------------------------------------


def _cells(hashes: np.ndarray, row: int, bits: int) -> np.ndarray:
    return (blocks.mix(hashes ^ _U(_SEEDS[row])) >> _U(64 - bits)).astype(np.uint32)


def _distinct(a: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes and whether they have several ids."""
    order = np.argsort(a, kind="stable")
    a, doc = a[order], doc[order]
    new = np.flatnonzero(np.append(True, a[1:] != a[:-1])) if len(a) else np.empty(0, np.int64)
    low, high = (f.reduceat(doc, new) if len(new) else doc for f in (np.minimum, np.maximum))
    return a[new], low != high


def _encoded(places: np.ndarray) -> bytes:
    """Sorted distinct places as gaps of one byte each; 255 stands for a longer way to the next."""
    gaps = np.diff(places.astype(np.int64), prepend=0)
    more = gaps // _ESCAPE
    out = np.full(int(more.sum()) + len(gaps), _ESCAPE, np.uint8)
    out[np.cumsum(more + 1) - 1] = gaps % _ESCAPE
    return out.tobytes()


def _decoded(value: bytes) -> np.ndarray:
    data = np.frombuffer(value, np.uint8)
    return np.cumsum(data, dtype=np.int64)[data != _ESCAPE]


def partial_sketches(packs: DataFrame, window: int, bits: int) -> DataFrame:
    """``(shard, once, more)``: the counters of a task that are one, and those that are two or more."""

    def flush(hashes: list[np.ndarray], several: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        whole, twice = np.concatenate(hashes), np.concatenate(several)
        for row in range(ROWS):
            cells = _cells(whole, row, bits)
            again = np.sort(np.concatenate([cells, cells[twice]]))
            new = np.flatnonzero(np.append(True, again[1:] != again[:-1]))
            count = np.diff(np.append(new, len(again)))
            cells = again[new]
            shard = cells >> np.uint32(SHARD_BITS)
            cut = np.flatnonzero(np.append(True, shard[1:] != shard[:-1]))
            end = np.append(cut[1:], len(cells))
            for i in range(0, len(cut), 1024):
                ranges = list(zip(cut[i : i + 1024], end[i : i + 1024], strict=True))
                place = [(cells[s:e] & np.uint32(2**SHARD_BITS - 1), count[s:e] == 1) for s, e in ranges]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([int(shard[s]) + (row << (bits - SHARD_BITS)) for s, _ in ranges], pa.int32()),
                        pa.array([_encoded(p[one]) for p, one in place], pa.binary()),
                        pa.array([_encoded(p[~one]) for p, one in place], pa.binary()),
                    ],
                    names=["shard", "once", "more"],
                )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes: list[np.ndarray] = []
        several: list[np.ndarray] = []
        size = 0
        for batch in batches:
            for block in _blocks(batch, window):
                a, many = _distinct(block.a, block.ids[block.text])
                hashes.append(a)
                several.append(many)
                size += len(a)
                if size >= FLUSH:
                    yield from flush(hashes, several)
                    hashes, several, size = [], [], 0
        if size:
            yield from flush(hashes, several)

    return packs.select("ids", "texts").mapInArrow(run, "shard int, once binary, more binary")


def sketch(packs: DataFrame, window: int, bits: int) -> np.ndarray:
    """Bits of the counters that reach two; rows one after the other.

    Only these ``ROWS * 2**bits`` bits reach the driver. Parts of a shard stream through their task one by one.
    """
    parts = partial_sketches(packs, window, bits).repartition("shard").sortWithinPartitions("shard")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, seen, more = None, np.zeros(2**SHARD_BITS, bool), np.zeros(2**SHARD_BITS, bool)

        def done() -> pa.RecordBatch:
            bitmap = np.packbits(more, bitorder="little").tobytes()
            return pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([bitmap], pa.binary())], names=["shard", "bits"])

        for batch in batches:
            for shard, once, twice in zip(*[batch.column(c) for c in ("shard", "once", "more")], strict=True):
                if shard.as_py() != now:
                    if now is not None and more.any():
                        yield done()
                    now = shard.as_py()
                    seen[:], more[:] = False, False
                here = _decoded(once.as_py())
                more[here[seen[here]]] = True
                seen[here] = True
                here = _decoded(twice.as_py())
                seen[here], more[here] = True, True
        if now is not None and more.any():
            yield done()

    size = 2**SHARD_BITS // 8
    out = np.zeros(ROWS * 2**bits // 8, np.uint8)
    for row in parts.mapInArrow(run, "shard int, bits binary").collect():
        out[row["shard"] * size : (row["shard"] + 1) * size] = np.frombuffer(row["bits"], np.uint8)
    return out


def maybe_repeated(found: np.ndarray, hashes: np.ndarray, bits: int) -> np.ndarray:
    """Windows whose estimate, the least of their counters, is two or more."""
    yes = np.ones(len(hashes), bool)
    for row in range(ROWS):
        at = _cells(hashes, row, bits).astype(np.int64) + (row << bits)
        yes &= (found[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
    return yes


# --- exact grouping -------------------------------------------------------------------------------


@dataclass
class Entries:
    """Distinct windows of a block, ordered by the first 64 bits ``a`` of their keys, with the smallest id of each."""

    a: np.ndarray
    b: np.ndarray
    doc: np.ndarray

    def part(self, start: int, end: int) -> bytes:
        """Three columns; ids as distances from their smallest, in 32 bits where they fit."""
        doc = self.doc[start:end]
        low = int(doc.min())
        far = doc - low
        kind = "<u4" if int(doc.max()) - low < 2**32 else "<u8"
        return np.int64(low).tobytes() + self.a[start:end].tobytes() + self.b[start:end].tobytes() + far.astype(kind).tobytes()


def _parsed(value: bytes, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    low = np.frombuffer(value, "<i8", 1)[0]
    a = np.frombuffer(value, "<u8", size, 8)
    b = np.frombuffer(value, "<u4", size, 8 + 8 * size)
    at = 8 + 12 * size
    kind = "<u4" if len(value) - at == 4 * size else "<u8"
    return a, b, np.frombuffer(value, kind, size, at).astype(np.int64) + low


def _groups(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order by key, and where a new key begins in it."""
    order = np.argsort(a, kind="stable")
    same = a[order[1:]] == a[order[:-1]]
    if (same & (b[order[1:]] != b[order[:-1]])).any():  # 64 bits are not enough here
        order = np.lexsort((b, a))
        same = (a[order[1:]] == a[order[:-1]]) & (b[order[1:]] == b[order[:-1]])
    return order, np.append(np.ones(min(1, len(a)), bool), ~same)


def _entries(block: Block, found: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, Entries]:
    """Windows estimated repeated: their numbers, the entry of each, and the entries."""
    chosen = np.flatnonzero(maybe_repeated(found, block.a, bits))
    a, b, doc = block.a[chosen], block.b(chosen), block.ids[block.text[chosen]]
    order, new = _groups(a, b)
    number = np.empty(len(order), np.int64)
    number[order] = np.cumsum(new) - 1
    first = order[new]
    least = np.minimum.reduceat(doc[order], np.flatnonzero(new)) if len(first) else doc
    return chosen, number, Entries(a[first], b[first], least)


def _bucket_borders(entries: Entries, bucket_bits: int) -> np.ndarray:
    """Entries are ordered by key, so a bucket, the highest bits of the key, is a slice."""
    bucket = (entries.a >> _U(64 - bucket_bits)).astype(np.int64) if bucket_bits else np.zeros(len(entries.a), np.int64)
    return np.searchsorted(bucket, np.arange(2**bucket_bits + 1))


def _send(packs: DataFrame, found, window: int, bits: int, bucket_bits: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.column("block").to_pylist()
            for name, block in zip(names, _blocks(batch, window), strict=True):
                entries = _entries(block, found.value, bits)[2]
                border = _bucket_borders(entries, bucket_bits)
                used = np.flatnonzero(np.diff(border))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(used.astype(np.int32)),
                        pa.array(np.full(len(used), name, np.int64)),
                        pa.array(np.diff(border)[used].astype(np.int32)),
                        pa.array([entries.part(border[k], border[k + 1]) for k in used], pa.binary()),
                    ],
                    names=["bucket", "block", "size", "entries"],
                )

    return packs.select("block", "ids", "texts").mapInArrow(run, "bucket int, block bigint, size int, entries binary")


def _answer(sent: DataFrame) -> DataFrame:
    """``(block, bucket, flags)``: for each entry, whether another block has its window with a smaller id."""

    def decide(bucket: int, names: list[int], parts: list[tuple]) -> pa.RecordBatch:
        a, b, doc = (np.concatenate(x) for x in zip(*parts, strict=True))
        order, new = _groups(a, b)
        least = np.minimum.reduceat(doc[order], np.flatnonzero(new))[np.cumsum(new) - 1]
        later = np.empty(len(a), bool)
        later[order] = doc[order] > least
        flags = [f if f.any() else None for f in np.split(later, np.cumsum([len(p[0]) for p in parts])[:-1])]
        kept = [k for k, f in enumerate(flags) if f is not None]
        return pa.RecordBatch.from_arrays(
            [
                pa.array([names[k] for k in kept], pa.int64()),
                pa.array([bucket] * len(kept), pa.int32()),
                pa.array([np.packbits(flags[k]).tobytes() for k in kept], pa.binary()),
            ],
            names=["block", "bucket", "flags"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, names, parts = None, [], []
        for batch in batches:
            for bucket, block, size, entries in zip(*[batch.column(c) for c in ("bucket", "block", "size", "entries")], strict=True):
                if bucket.as_py() != now:
                    if parts:
                        yield decide(now, names, parts)
                    now, names, parts = bucket.as_py(), [], []
                names.append(block.as_py())
                parts.append(_parsed(entries.as_py(), size.as_py()))
        if parts:
            yield decide(now, names, parts)
        blocks.give_back()

    return sent.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(run, "block bigint, bucket int, flags binary")


# --- result ---------------------------------------------------------------------------------------


def _removed(block: Block, found: np.ndarray, bits: int, bucket_bits: int, answers: list[dict]) -> np.ndarray:
    """Per word of the block: is it covered by a window of a document with a smaller id."""
    chosen, number, entries = _entries(block, found, bits)
    border = _bucket_borders(entries, bucket_bits)
    earlier = np.zeros(len(entries.a), bool)
    for answer in answers:
        a, b = border[answer["bucket"]], border[answer["bucket"] + 1]
        earlier[a:b] = np.unpackbits(np.frombuffer(answer["flags"], np.uint8), count=b - a)
    hit = earlier[number] | (block.ids[block.text[chosen]] > entries.doc[number])
    at = block.first[chosen[hit]]
    change = np.zeros(len(block.starts) + 1, np.int64)
    np.add.at(change, at, 1)
    np.add.at(change, at + block.window, -1)
    return np.cumsum(change)[:-1] > 0


def substring_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, width_bits: int = WIDTH_BITS, max_bytes: int = PACKED_BYTES
) -> DataFrame:
    """``(doc_id, n_words, n_removed, kept_text)``, one row for each input row; kept words are joined by one space."""
    spark = docs.sparkSession
    path = scratch_path(spark, "packed")
    packed(docs, id_col, text_col, max_bytes).write.option("compression", "zstd").parquet(path)
    packs = spark.read.parquet(path)
    size = packs.agg(F.sum("bytes").alias("b")).first()["b"] or 0
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), size // BUCKET_BYTES)
    bucket_bits = max(buckets - 1, 0).bit_length()
    found = spark.sparkContext.broadcast(sketch(packs, window, width_bits))
    answers = _answer(_send(packs, found, window, width_bits, bucket_bits))
    answers = answers.groupBy("block").agg(F.collect_list(F.struct("bucket", "flags")).alias("answers"))  # at most one for each bucket
    joined = lookup_join(packs, materialize(answers, "answers"), ["block"], "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            replies = batch.column("answers").to_pylist()
            for k, block in enumerate(_blocks(batch, window)):
                removed = _removed(block, found.value, width_bits, bucket_bits, replies[k] or [])
                cut = np.searchsorted(block.owner, np.arange(len(block.ids) + 1))
                lost = np.diff(np.append(0, np.cumsum(removed))[cut])
                texts = []
                for i in range(len(block.ids)):
                    words = block.data[block.offsets[i] : block.offsets[i + 1]].tobytes().split()
                    kept = compress(words, (~removed[cut[i] : cut[i + 1]]).tolist()) if lost[i] else words
                    texts.append(b" ".join(kept))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("ids")[k].values,
                        pa.array(np.diff(cut)),
                        pa.array(lost),
                        pa.array(texts, pa.binary()).cast(pa.string()),
                    ],
                    names=["doc_id", "n_words", "n_removed", "kept_text"],
                )

    return joined.select("ids", "texts", "answers").mapInArrow(run, "doc_id bigint, n_words bigint, n_removed bigint, kept_text string")
