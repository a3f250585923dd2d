"""Near-duplicate classes by ProbMinHash signatures, banding and exact verification.

A text is a weighted set: its five-word shingles (ASCII case ignored) with their counts. Each shingle
emits arrivals of a Poisson process whose rate is its weight; an arrival at time ``t`` falls into one of
``REGISTERS`` registers, which keeps the shingle of the earliest arrival. Two texts agree in a register with
probability J_P, the probability Jaccard similarity of their weights. Later arrivals are not drawn once
they are past the latest register of the text.

1. Texts with the same words are copies and count as one node (a 128-bit fingerprint).
2. Signatures are cut into ``BANDS`` bands; nodes that share a band are candidates. Similarity 0.8 misses
   all bands with probability below 1e-4.
3. In each band bucket all nodes are verified by their exact J_P against one hub: the node that shares
   the most bands with others, which in a group of copies is the likeliest original. Buckets that still
   hold several components are compared block by block on whole signatures, inside tasks, and what may
   reach the threshold (four standard deviations of a longer signature below it) is verified exactly too: first the likeliest
   ``FIRST_PARTNERS`` of each node, as they join most components, then all that are still apart.
4. Components of the verified links are the classes.

No bucket is cut or skipped, and no pair is written that is not verified. Texts of one to four words are
one shingle. Rows without a word (null, empty, blank) are classes of their own; rows without an id join
the class of their exact copies only. Repeated rows get the same class. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm import blocks
from tidemill.llm.components import connected_components, written
from tidemill.plans.lookup import lookup_join
from tidemill.plans.scratch import materialize

SHINGLE = 5
BANDS, ROWS = 24, 5
REGISTERS = BANDS * ROWS
BLOCK = 256  # nodes of a bucket compared at a time
FIRST_PARTNERS = 4
FILE_ROWS = 20_000  # documents behind one file of an intermediate table
LONG = 4 * REGISTERS  # registers of the nodes that are compared pair by pair
NODES = "doc_id bigint, node binary, bands array<bigint>"

_U = np.uint64


def shingles(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[bytes | None]]:
    """Text number, hash and count of the distinct shingles of a block; the fingerprints of its texts."""
    n = len(offsets) - 1
    data = blocks.ASCII_LOWER[data]
    starts, ends, owner = blocks.words(data, offsets)
    word = blocks.span_hashes(data, starts, ends)
    count = np.bincount(owner, minlength=n)
    first = np.concatenate([[0], np.cumsum(count)[:-1]])
    place = (np.arange(len(owner)) - first[owner]).astype(_U)
    print_a, print_b = np.zeros(n, _U), np.zeros(n, _U)
    np.add.at(print_a, owner, blocks.mix(word + place * _U(0x9E3779B97F4A7C15)))
    np.add.at(print_b, owner, blocks.mix(word ^ blocks.mix(place + _U(0x51ED270B))))
    prints = [a + b if c else None for a, b, c in zip(_bytes(print_a), _bytes(print_b), count.tolist(), strict=True)]
    at, window = blocks.window_hashes(word, owner, SHINGLE)
    short = np.flatnonzero((count > 0) & (count < SHINGLE))
    owners = np.concatenate([owner[at], short])
    hashes = np.concatenate([window, print_a[short]])
    order = np.lexsort((hashes, owners))
    owners, hashes = owners[order], hashes[order]
    new = np.flatnonzero(np.append(True, (owners[1:] != owners[:-1]) | (hashes[1:] != hashes[:-1]))) if len(owners) else np.empty(0, np.int64)
    return owners[new], hashes[new], np.diff(np.append(new, len(owners))), prints


def _bytes(values: np.ndarray) -> list[bytes]:
    whole = values.astype(">u8").tobytes()
    return [whole[i : i + 8] for i in range(0, len(whole), 8)]


def signatures(owner: np.ndarray, element: np.ndarray, weight: np.ndarray, n: int, registers: int = REGISTERS) -> np.ndarray:
    """``n`` x ``registers`` winning shingles. Arrival number k of a shingle depends on nothing but both."""
    time, winner = np.full(n * registers, np.inf), np.zeros(n * registers, _U)
    now = np.zeros(len(owner))
    k = 0
    while len(owner):
        k += 1
        draw = blocks.mix(element + _U(k * 0xA24BAED4963EE407 % 2**64))
        now = now - np.log(((draw >> _U(11)).astype(np.float64) + 1) * 2.0**-53) / weight
        slot = owner * registers + (blocks.mix(draw ^ _U(0xC2B2AE3D27D4EB4F)) % _U(registers)).astype(np.int64)
        np.minimum.at(time, slot, now)
        won = now == time[slot]
        winner[slot[won]] = element[won]
        latest = time.reshape(n, registers).max(1)
        go_on = now < latest[owner]
        owner, element, weight, now = owner[go_on], element[go_on], weight[go_on], now[go_on]
    return winner.reshape(n, registers)


def band_hashes(found: np.ndarray) -> np.ndarray:
    """One hash for each band of each signature."""
    factors = np.array([pow(0x9E3779B97F4A7C15, k + 1, 2**64) for k in range(ROWS)], _U)
    cut = found.reshape(len(found), BANDS, ROWS)
    return blocks.mix((cut * factors).sum(2, dtype=_U) + np.arange(BANDS, dtype=_U) * _U(0xD6E8FEB86659FD93)).view(np.int64)


def nodes(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc_id``, ``node`` (fingerprint, null without words) and the hashes of its bands."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in blocks.text_blocks(batch.column("text")):
                owner, element, weight, prints = shingles(data, offsets)
                found = signatures(owner, element, weight, b - a)
                bands = band_hashes(found)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(a, b - a),
                        pa.array(prints, pa.binary()),
                        pa.FixedSizeListArray.from_arrays(pa.array(bands.reshape(-1)), BANDS).cast(pa.list_(pa.int64())),
                    ],
                    names=["doc_id", "node", "bands"],
                )

    slim = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return slim.mapInArrow(run, NODES)


def probability_jaccard(a: dict[int, int], b: dict[int, int]) -> float:
    """Exact J_P of two weighted sets: the sum over common i of 1 / sum over j of max(a_j / a_i, b_j / b_i).

    With weights ordered by a_j / b_j, the inner sum takes a_j from i on and b_j before it.
    """
    if not a or not b:
        return 0.0
    keys = list(a.keys() | b.keys())
    x = np.array([a.get(k, 0) for k in keys], float)
    y = np.array([b.get(k, 0) for k in keys], float)
    ratio = np.divide(x, y, out=np.full(len(x), np.inf), where=y > 0)
    order = np.argsort(ratio, kind="stable")
    x, y, ratio = x[order], y[order], ratio[order]
    group = np.searchsorted(ratio, ratio, "left")
    x_from = (np.append(np.cumsum(x[::-1])[::-1], 0.0))[group]
    y_before = np.concatenate([[0.0], np.cumsum(y)])[group]
    both = (x > 0) & (y > 0)
    return float((1 / (x_from[both] / x[both] + y_before[both] / y[both])).sum())


def _verify(pairs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """The pairs ``(a, b)`` of nodes whose texts reach the threshold. Both joins are plain equi-joins of
    two shuffled tables, in which Spark splits a hub's many pairs."""
    left = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    rows = pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, dict[int, int]] = {}  # the last few texts, as hubs come again and again

        def weights(node: bytes, text: str) -> dict[int, int]:
            if node not in known:
                if len(known) >= 64:
                    known.clear()
                data = np.frombuffer(text.encode(), np.uint8)
                _, element, weight, _ = shingles(data, np.array([0, len(data)]))
                known[node] = dict(zip(element.tolist(), weight.tolist(), strict=True))
            return known[node]

        for batch in batches:
            a, b = batch.column("a").to_pylist(), batch.column("b").to_pylist()
            keep = []
            for k in range(len(batch)):
                x = weights(a[k], batch.column("text_a")[k].as_py())
                y = weights(b[k], batch.column("text_b")[k].as_py())
                keep.append(probability_jaccard(x, y) >= threshold - 1e-12)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))
            blocks.give_back()

    return rows.mapInArrow(run, "a binary, b binary")


def _parts(rows: list[dict]) -> tuple[np.ndarray, np.ndarray]:
    """Long signatures and band hashes of some nodes."""
    whole = np.frombuffer(b"".join(r["signature"] for r in rows), np.uint8).reshape(len(rows), -1)
    registers, bands = np.ascontiguousarray(whole[:, : 4 * LONG]), np.ascontiguousarray(whole[:, 4 * LONG :])
    return registers.view(np.uint32), bands.view(np.int64)


def _cross_pairs(members: DataFrame, threshold: float, most: int | None, files: int) -> DataFrame:
    """Pairs of nodes of one bucket but of different components whose signatures may reach the threshold.

    ``members`` has ``band, n, node, component, signature``. A bucket is dealt into blocks of about
    ``BLOCK`` nodes; each pair of blocks is one row, compared inside its task. With ``most``, a node gives
    its likeliest pairs with each block only. A pair that shares several buckets comes from the first only.
    """
    n_blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    dealt = members.withColumn("n_blocks", n_blocks).withColumn("block", F.pmod(F.xxhash64("node"), F.col("n_blocks")).cast("int"))
    packed = dealt.groupBy("band", "n_blocks", "block").agg(F.collect_list(F.struct("node", "component", "signature")).alias("rows"))
    packed = written(packed, "blocks", files)  # both sides of the join read it
    left = packed.select("band", F.col("rows").alias("rows_a"), F.col("block").alias("i"), F.explode(F.sequence("block", F.col("n_blocks") - 1)).alias("j"))
    right = packed.select("band", F.col("block").alias("j"), F.col("rows").alias("rows_b"))
    least = (threshold - 4 * (threshold * (1 - threshold) / LONG) ** 0.5) * LONG

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(len(batch)):
                x, y = batch.column("rows_a")[k].as_py(), batch.column("rows_b")[k].as_py()
                band = batch.column("band")[k].as_py()
                one, bands_one = _parts(x)
                two, bands_two = _parts(y)
                number: dict[bytes, int] = {}
                c = np.array([number.setdefault(r["component"], len(number)) for r in x])
                d = np.array([number.setdefault(r["component"], len(number)) for r in y])
                found = []
                for i in range(len(x)):
                    agree = (one[i] == two).sum(1)
                    apart = np.flatnonzero((agree >= least) & (d != c[i]))
                    shared = bands_two[apart] == bands_one[i]
                    apart = apart[bands_one[i][shared.argmax(1)] == band]
                    if most is not None:
                        apart = apart[np.argsort(-agree[apart], kind="stable")[:most]]
                    found += [(x[i]["node"], y[j]["node"]) for j in apart]
                found = [(min(p), max(p)) for p in found]
                yield pa.RecordBatch.from_arrays([pa.array([p[s] for p in found], pa.binary()) for s in (0, 1)], names=["a", "b"])

    return left.join(right, ["band", "j"]).select("band", "rows_a", "rows_b").mapInArrow(run, "a binary, b binary").distinct()


def near_duplicates(docs: DataFrame, threshold: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id``, ``class_id`` (the smallest id of its class) and ``class_size`` (rows)."""
    spark = docs.sparkSession
    rows = materialize(nodes(docs, id_col, text_col), "nodes")
    files = max(spark.sparkContext.defaultParallelism, -(-rows.count() // FILE_ROWS))
    one = rows.where("node IS NOT NULL AND doc_id IS NOT NULL").groupBy("node").agg(F.min("doc_id").alias("doc_id"))
    # Copies have equal bands: distinct (band, node) pairs combine before the shuffle.
    banded = written(rows.where("node IS NOT NULL").select(F.explode("bands").alias("band"), "node").distinct(), "bands", files)
    buckets = banded.groupBy("band").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    crowd = written(banded.join(buckets, "band"), "crowd", files)
    shared = written(crowd.groupBy("node").agg(F.sum("n").alias("shared")), "shared", files)
    hubs = crowd.join(shared, "node").groupBy("band").agg(F.max(F.struct("shared", "node"))["node"].alias("hub"))
    members = written(crowd.join(hubs, "band"), "members", files)
    pairs = members.where("node <> hub").select(F.least("hub", "node").alias("a"), F.greatest("hub", "node").alias("b")).distinct()
    tested = written(pairs, "pairs", files)
    wanted = written(one.join(shared.select("node"), "node"), "candidates", files)
    texts = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    texts = _own_texts(lookup_join(texts, wanted, ["doc_id"], "inner"))
    texts = written(texts, "texts", files)
    links = written(_verify(tested, texts, threshold), "verified", files)
    parts = connected_components(links, files=files)
    prints: DataFrame | None = None
    for most in (FIRST_PARTNERS, None):
        parted = members.join(parts, "node", "left").withColumn("component", F.coalesce("component", "node"))
        parted = written(parted.select("band", "n", "node", "component"), "parted", files)
        mixed = parted.groupBy("band").agg(F.min("component").alias("c"), F.max("component").alias("d"), F.count(F.lit(1)).alias("k"))
        crowded = written(parted.join(mixed.where("c <> d AND k > 2").select("band"), "band", "left_semi"), "crowded", files)
        if crowded.isEmpty():
            break
        if prints is None:  # the second round needs no other nodes
            prints = written(_long_signatures(texts.join(crowded.select("node").distinct(), "node", "left_semi")), "signatures", files)
        signed = crowded.join(prints, "node")
        more = _cross_pairs(signed, threshold, most, files)
        more = written(more.join(tested, ["a", "b"], "left_anti"), "pairs", files)
        further = written(_verify(more, texts, threshold), "verified", files)
        tested, links = tested.unionByName(more), links.unionByName(further)
        if not further.isEmpty():
            parts = connected_components(links, files=files)

    placed = rows.select("doc_id", "node").join(parts, "node", "left").withColumn("component", F.coalesce("component", "node"))
    placed = written(placed.select("doc_id", "component"), "placed", files)
    classes = placed.where("component IS NOT NULL").groupBy("component").agg(F.min("doc_id").alias("class_id"), F.count(F.lit(1)).alias("class_size"))
    found = placed.join(classes, "component", "left")
    alone = F.col("component").isNull()
    return found.select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.when(alone, F.lit(1)).otherwise(F.col("class_size")).cast("bigint").alias("class_size"),
    )


def _long_signatures(texts: DataFrame) -> DataFrame:
    """``(node, signature)``: 32 bits of each register of a long signature, and the hashes of the bands."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in blocks.text_blocks(batch.column("text")):
                owner, element, weight, _ = shingles(data, offsets)
                found = signatures(owner, element, weight, b - a, LONG).astype(np.uint32)
                bands = band_hashes(signatures(owner, element, weight, b - a))
                both = [x.tobytes() + y.tobytes() for x, y in zip(found, bands, strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column("node").slice(a, b - a), pa.array(both, pa.binary())], names=["node", "signature"])

    return texts.mapInArrow(run, "node binary, signature binary")


def _own_texts(rows: DataFrame) -> DataFrame:
    """``(node, text)``, one row per node: of rows with one id, those whose text is the node's."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints: list[bytes | None] = []
            for _, _, data, offsets in blocks.text_blocks(batch.column("text")):
                prints += shingles(data, offsets)[3]
            keep = [p == n for p, n in zip(prints, batch.column("node").to_pylist(), strict=True)]
            yield batch.select(["node", "text"]).filter(pa.array(keep, pa.bool_()))

    return rows.select("node", "text").mapInArrow(run, "node binary, text string").dropDuplicates(["node"])


def keep_one(docs: DataFrame, classes: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` that stand for their class: those with the class's smallest id, once each.

    Rows without an id have no class to stand for and stay.
    """
    named = classes.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("_id"))
    kept = named.agg(F.max((F.col("doc_id") == F.col("class_id")).cast("int")).alias("_stays"), F.count(F.lit(1)).alias("_rows"))
    kept = materialize(kept.where("_stays = 1").select("_id", "_rows"), "kept")
    found = lookup_join(docs.withColumn("_id", F.col(id_col).cast("bigint")), kept, ["_id"], "inner")
    once = found.where("_rows = 1").drop("_id", "_rows")
    again = found.where("_rows > 1").dropDuplicates(["_id"]).drop("_id", "_rows")
    return once.unionByName(again).unionByName(docs.where(F.col(id_col).isNull()))
