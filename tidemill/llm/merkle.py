"""A Merkle manifest of a data set, kept as postorder logs, with proofs read from computed positions.

Every row is a leaf: the SHA-256 of its fields, each ``-`` if null, else its UTF-8 byte count, ``:`` and
its value. The leaves of one tree (here: of one source) stand in the order of their ids; every
``RUN`` consecutive nodes become their hash, the last run may be shorter, until one node remains. The
roots of the trees, ordered by their names, are the leaves of one more tree.

* A *builder* takes ``RUN**levels`` leaves that start at a multiple of that number, so that its subtree is a
  subtree of the whole. It appends each node to a log when the node is complete. The last entry of its log is the
  root of its subtree and a leaf of the next round of builders; rounds go on until each tree has one builder.
  A tree of any size is thus spread over tasks, and no task holds more than one builder's log at a time.
* A node completes with its last leaf ``e``. Before it came all leaves up to ``e``, ``e // RUN`` runs,
  ``e // RUN**2`` runs of runs and so on, and below it one node for each level: the sum is its position in the log.
  Siblings of a proof are read from these positions, no links are stored.

Rows without a source form a tree of their own, which comes first. Rows without an id come first in
their tree; rows of equal ids stand in the order of what they load and of their digests, so repeated rows
get neighbouring leaves. Empty tables give empty results. Columns that are not named are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.plans.lookup import lookup_join
from tidemill.plans.ordered import range_count
from tidemill.plans.scratch import materialize

RUN = 3
LEVELS = 7  # levels of one builder: 2,187 leaves
HEX = 64
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(parts: Sequence[bytes]) -> bytes:
    return hashlib.sha256(b"".join(parts)).hexdigest().encode()


def height(leaves: int) -> int:
    """Levels above the leaves of a tree."""
    up = 0
    while leaves > 1:
        leaves = -(-leaves // RUN)
        up += 1
    return up


def append_log(leaves: Sequence[bytes], levels: int) -> list[bytes]:
    """The nodes of ``levels`` levels above ``leaves`` in the order of their completion."""
    log: list[bytes] = []
    begun: list[list[bytes]] = [[] for _ in range(levels)]
    for i, node in enumerate(leaves):
        log.append(node)
        for run in begun:
            run.append(node)
            if len(run) < RUN and i < len(leaves) - 1:
                break
            node = digest(run)
            run.clear()
            log.append(node)
    return log


def position(level: int, index: int, leaves: int) -> int:
    """Place in the log of node ``index`` of a level, counted from 0."""
    last = min((index + 1) * RUN**level, leaves) - 1
    place = level
    while last:
        place += last
        last //= RUN
    return place


@dataclass
class Segment:
    """The log of one builder, read by position."""

    log: bytes
    leaves: int
    levels: int

    def node(self, level: int, index: int) -> bytes:
        at = position(level, index, self.leaves) * HEX
        return self.log[at : at + HEX]

    def steps(self) -> list[list[tuple[bytes, bytes]]]:
        """For each level the digests left and right of each node within its run."""
        out, count = [], self.leaves
        for level in range(self.levels):
            nodes = [self.node(level, i) for i in range(count)]
            runs = [nodes[i : i + RUN] for i in range(0, count, RUN)]
            out.append([(b"".join(run[:k]), b"".join(run[k + 1 :])) for run in runs for k in range(len(run))])
            count = len(runs)
        return out


def _pack(left: bytes, right: bytes) -> bytes:
    return bytes((len(left) // HEX, len(right) // HEX)) + left + right


def unpacked(path: bytes) -> Iterator[tuple[bytes, bytes]]:
    """The digests left and right of the node on each level of a written path."""
    at = 0
    while at < len(path):
        middle = at + 2 + path[at] * HEX
        end = middle + path[at + 1] * HEX
        yield path[at + 2 : middle], path[middle:end]
        at = end


def _packed_paths(segment: Segment, up: bytes) -> list[bytes]:
    levels = [[_pack(*step) for step in level] for level in segment.steps()]
    return [b"".join(level[i // RUN**k] for k, level in enumerate(levels)) + up for i in range(segment.leaves)]


# --- leaves ---------------------------------------------------------------------------------------


def leaf(fields: Sequence[Column]) -> Column:
    """Digest of a row's fields as lowercase hex."""
    texts = [f.cast("string") for f in fields]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]), 256)


def tree_name(source: Column) -> Column:
    """A name that orders like the source, with null first, and is never null."""
    return F.coalesce(F.concat(F.lit("s"), source.cast("string")), F.lit(""))


def numbered(nodes: DataFrame, order: Sequence[str]) -> DataFrame:
    """``nodes`` (``tree``, ...) with ``i``, the place within the tree, and ``n``, the size of the tree.

    Spark deals the rows into sorted ranges, so a tree of any size spreads over many; the dealt table is
    written with its places, and only the counts of (tree, range) are carried forward.
    """
    nodes = materialize(nodes.withColumn("_row", F.monotonically_increasing_id()), "digests")
    keys = ["tree", *order, "_row"]
    dealt = nodes.repartitionByRange(range_count(nodes), *keys).sortWithinPartitions(*keys).drop("_row")
    dealt = materialize(dealt.withColumn("_at", F.monotonically_increasing_id()), "dealt")
    dealt = dealt.withColumn("_range", F.shiftright("_at", 33))
    spans = dealt.groupBy("tree", "_range").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    whole = W.partitionBy("tree")
    before = whole.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    spans = spans.select(
        "tree", "_range", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"), F.sum("_n").over(whole).alias("n")
    )
    placed = lookup_join(dealt, materialize(spans, "spans"), ["tree", "_range"], "inner")
    return placed.withColumn("i", F.col("_at") + F.col("_shift")).drop("_at", "_range", "_shift")


# --- builders -------------------------------------------------------------------------------------


def _round(nodes: DataFrame, levels: int) -> DataFrame:
    """``(tree, n, chunk, load, leaves, log)``, one row per builder, of ``(tree, n, i, digest, load)``."""
    rows = F.sort_array(F.collect_list(F.struct("i", "digest", "load")))
    packed = nodes.groupBy("tree", "n", F.expr(f"i div {RUN**levels}").alias("chunk")).agg(rows.alias("rows"))
    packed = packed.select(
        "tree", "n", "chunk", F.col("rows.load").alias("load"), F.size("rows").alias("leaves"), F.array_join("rows.digest", "").alias("digests")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            logs = []
            for n, value in zip(batch.column("n").to_pylist(), batch.column("digests"), strict=True):
                data = value.as_py().encode()
                leaves = [data[k : k + HEX] for k in range(0, len(data), HEX)]
                logs.append(b"".join(append_log(leaves, min(height(n), levels))).decode())
            kept = batch.drop_columns(["digests"])
            yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(logs, pa.string())], names=[*kept.schema.names, "log"])

    kept = packed.drop("digests").schema
    return packed.mapInArrow(run, kept.add("log", T.StringType()))


def rounds(nodes: DataFrame, levels: int) -> list[DataFrame]:
    """The logs of all builders, round by round; each round is ``RUN**levels`` times smaller than the one before."""
    made, width = [], RUN**levels
    while True:
        made.append(materialize(_round(nodes, levels), "log"))
        rest = made[-1].where(F.col("n") > width)
        nodes = rest.select("tree", F.ceil(F.col("n") / width).cast("bigint").alias("n"), F.col("chunk").alias("i"), _root().alias("digest"))
        nodes = nodes.withColumn("load", F.lit(None).cast("string"))
        if rest.isEmpty():
            return made


def _root() -> Column:
    return F.substring("log", -HEX, HEX)


def roots(made: list[DataFrame], levels: int) -> DataFrame:
    """``(tree, root)``."""
    tops = [m.where(F.col("n") <= RUN**levels).select("tree", _root().alias("root")) for m in made]
    out = tops[0]
    for t in tops[1:]:
        out = out.unionByName(t)
    return out


# --- proofs ---------------------------------------------------------------------------------------


def _upper(made: list[DataFrame], above: DataFrame, levels: int) -> DataFrame:
    """``(tree, chunk, up, ...)`` for the builders of the first round: the path from a builder's root to the
    end of the path of its tree, ``above`` being ``(tree, up, ...)``."""
    up: DataFrame | None = None
    for k in reversed(range(len(made))):
        top = made[k].where(F.col("n") <= RUN**levels).select("tree", "chunk")
        here = lookup_join(top, above, ["tree"], "inner")
        up = here if up is None else up.unionByName(here)
        up = materialize(up, "up")
        if k == 0:
            return up
        carried = [c for c in up.columns if c not in ("tree", "chunk", "up")]
        paths = _with_paths(lookup_join(made[k], up, ["tree", "chunk"], "inner").drop("load"), levels)
        up = paths.select("tree", "chunk", F.posexplode("paths").alias("slot", "up"), *carried)
        up = up.withColumn("chunk", F.col("chunk") * RUN**levels + F.col("slot")).drop("slot")
    raise ValueError("no rounds")


def _with_paths(packed: DataFrame, levels: int) -> DataFrame:
    """``packed`` less its logs, with ``leaf`` and ``paths``: digest and written path of each leaf."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaves, paths = [], []
            for segment, up in _segments(batch, levels):
                leaves.append([segment.node(0, i).decode() for i in range(segment.leaves)])
                paths.append(_packed_paths(segment, up))
            kept = batch.drop_columns(["log", "up"])
            lists = [pa.array(leaves, pa.list_(pa.string())), pa.array(paths, pa.list_(pa.binary()))]
            yield pa.RecordBatch.from_arrays([*kept.columns, *lists], names=[*kept.schema.names, "leaf", "paths"])

    return packed.mapInArrow(run, packed.drop("log", "up").schema.add("leaf", T.ArrayType(T.StringType())).add("paths", T.ArrayType(T.BinaryType())))


def _segments(batch: pa.RecordBatch, levels: int) -> Iterator[tuple[Segment, bytes]]:
    for n, leaves, log, up in zip(*[batch.column(c).to_pylist() for c in ("n", "leaves", "log", "up")], strict=True):
        yield Segment(log.encode(), leaves, min(height(n), levels)), up


@dataclass
class Manifest:
    """Logs of the trees and of the tree of their roots; ``root`` is a table of one row."""

    trees: list[DataFrame]
    top: list[DataFrame]
    levels: int

    @property
    def root(self) -> DataFrame:
        return roots(self.top, self.levels).select("root")


def build(leaves: DataFrame, levels: int = LEVELS) -> Manifest:
    """The logs of ``(tree, load, digest)`` rows, ordered by ``load`` and digest within a tree."""
    trees = rounds(numbered(leaves, ["load", "digest"]), levels)
    names = roots(trees, levels).select(F.lit("").alias("tree"), F.struct("tree", "root").alias("load"), F.col("root").alias("digest"))
    return Manifest(trees, rounds(numbered(names, ["load"]), levels), levels)


def proofs(made: Manifest) -> DataFrame:
    """``(load, leaf, subroot, root, path)`` of every leaf; ``unpacked(path)`` gives the siblings up to the root."""
    rows = _with_paths(_located(made), made.levels).select("subroot", "root", F.explode(F.arrays_zip("load", "leaf", "paths")).alias("x"))
    return rows.select("x.load", "x.leaf", "subroot", "root", F.col("x.paths").alias("path"))


def _located(made: Manifest) -> DataFrame:
    """The first round's logs with the path from each builder's root to the manifest's."""
    end = made.root.select(F.lit("").alias("tree"), "root", F.lit(b"").alias("up"))
    top = lookup_join(made.top[0], _upper(made.top, end, made.levels), ["tree", "chunk"], "inner")
    named = _with_paths(top, made.levels).select("root", F.explode(F.arrays_zip("load", "paths")).alias("x"))
    above = named.select(F.col("x.load.tree").alias("tree"), F.col("x.load.root").alias("subroot"), "root", F.col("x.paths").alias("up"))
    return lookup_join(made.trees[0], _upper(made.trees, materialize(above, "above"), made.levels), ["tree", "chunk"], "inner")


def verified(made: Manifest) -> DataFrame:
    """``(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified)`` of a manifest whose ``load`` is
    ``(doc_id, found)``: ``found`` is the digest of a row as it is found now, null if unchanged. It is folded
    with the siblings that the log has, and ``verified`` tells whether that gives the root."""
    packed = _located(made).select(
        "n", "leaves", "log", "up", "subroot", "root", F.col("load.doc_id").alias("ids"), F.col("load.found").alias("found")
    )
    levels = made.levels

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaves, hashes, folds = [], [], []
            for (segment, up), found in zip(_segments(batch, levels), batch.column("found").to_pylist(), strict=True):
                steps, rest = segment.steps(), list(unpacked(up))
                own, proof, folded = [], [], []
                for i in range(segment.leaves):
                    path = [level[i // RUN**k] for k, level in enumerate(steps)] + rest
                    node = segment.node(0, i)
                    own.append(node.decode())
                    proof.append(digest([d for step in path for d in step]).decode())
                    node = found[i].encode() if found[i] else node
                    for left, right in path:
                        node = digest((left, node, right))
                    folded.append(node.decode())
                leaves.append(own)
                hashes.append(proof)
                folds.append(folded)
            lists = [pa.array(x, pa.list_(pa.string())) for x in (leaves, hashes, folds)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("ids"), batch.column("subroot"), batch.column("root"), *lists], names=["ids", "subroot", "root", "leaf", "proof", "folded"]
            )

    id_type = packed.schema["ids"].dataType.simpleString()
    lists = packed.mapInArrow(
        run, f"ids {id_type}, subroot string, root string, leaf array<string>, proof array<string>, folded array<string>"
    )
    rows = lists.select("subroot", "root", F.explode(F.arrays_zip("ids", "leaf", "proof", "folded")).alias("x"))
    return rows.select(
        F.col("x.ids").alias("doc_id"),
        F.col("x.leaf").alias("leaf"),
        "subroot",
        "root",
        F.col("x.proof").alias("proof_sha256"),
        F.col("x.folded").alias("folded_root"),
        (F.col("x.folded") == F.col("root")).alias("verified"),
    )


def document_leaves(docs: DataFrame, found_text: Column, fields: Sequence[str] = FIELDS, source_col: str = "source") -> DataFrame:
    """Leaves of documents; ``found_text`` is the text as it is found now, null where it is the same."""
    now = [found_text if f == "text" else F.col(f) for f in fields]
    found = F.when(found_text.isNotNull(), leaf(now))
    load = F.struct(F.col(fields[0]).alias("doc_id"), found.alias("found"))
    return docs.select(tree_name(F.col(source_col)).alias("tree"), load.alias("load"), leaf([F.col(f) for f in fields]).alias("digest"))
