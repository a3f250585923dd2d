"""Quality classifier: a byte-level convolutional network in numpy.

A text is read as bytes in chunks of ``CHUNK`` bytes, each starting ``HOP`` bytes after the last, so that
neighbours overlap and the whole text is covered. Learned filters look at ``2 * STEP`` bytes at every
``STEP``-th position; each filter's maximum over a chunk feeds a hidden layer, the maxima of the hidden
units over all chunks feed one logistic unit. A chunk's hidden unit can react to what is there (symbols,
capitals) and to what is not (a chunk of repeated words excites few filters).

``fit`` trains on a bounded sample of labelled rows (``per_class`` rows of each class or about as many, texts of at most
``max_train_chars`` characters, whole); ``score`` reads every whole text. Null and empty texts are one
chunk of padding and get the score of that. Without labels of both classes the score is the share of
label 1, 0.5 if there are none. Repeated rows score alike; only the text is read, the
other columns pass through.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from tidemill.llm import blocks
from tidemill.llm.sampling import bounded_sample

STEP = 4
UNIT = 128  # bytes between places where chunks may start or end
CHUNK, HOP = 4 * UNIT, 3 * UNIT
EMBED, FILTERS, HIDDEN = 8, 24, 16
ADDED = StructType([StructField("score", DoubleType()), StructField("predicted", IntegerType())])


@dataclass
class ByteNet:
    """The parameters; ``constant`` replaces the network where there was nothing to learn from."""

    embed: np.ndarray
    first: np.ndarray  # filters on the first STEP bytes of a window
    second: np.ndarray  # and on the next
    bias: np.ndarray
    hidden: np.ndarray
    hidden_bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray
    constant: float | None = None

    def parameters(self) -> list[np.ndarray]:
        return [self.embed, self.first, self.second, self.bias, self.hidden, self.hidden_bias, self.out, self.out_bias]


def new_net(seed: int) -> ByteNet:
    rng = np.random.default_rng(seed)
    draw = lambda *shape, scale: (rng.standard_normal(shape) * scale).astype(np.float32)
    wide = STEP * EMBED
    return ByteNet(
        draw(256, EMBED, scale=0.5),
        draw(wide, FILTERS, scale=(2 * wide) ** -0.5),
        draw(wide, FILTERS, scale=(2 * wide) ** -0.5),
        np.zeros(FILTERS, np.float32),
        draw(FILTERS, HIDDEN, scale=FILTERS**-0.5),
        np.zeros(HIDDEN, np.float32),
        draw(HIDDEN, scale=HIDDEN**-0.5),
        np.zeros(1, np.float32),
    )


def units(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of all texts, each padded with zeros to whole units; each text's first unit and its units.

    A unit of zeros stands between texts, so that no window looks into a neighbour.
    """
    n_units = np.maximum(-(-np.diff(offsets) // UNIT), 1)
    first = np.concatenate([[0], np.cumsum(n_units + 1)])
    padded = np.zeros(first[-1] * UNIT, np.uint8)
    place = np.repeat(first[:-1] * UNIT - offsets[:-1], np.diff(offsets)) + np.arange(len(data))
    padded[place] = data
    return padded, first[:-1], n_units


def chunks(first_unit: np.ndarray, n_units: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First unit, unit after the last, and text of every chunk; the last chunk may be shorter."""
    wide, hop = CHUNK // UNIT, HOP // UNIT
    count = np.maximum(-(-(n_units - wide) // hop), 0) + 1
    owner = np.repeat(np.arange(len(n_units)), count)
    number = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    first = first_unit[owner] + number * hop
    return first, np.minimum(first + wide, (first_unit + n_units)[owner]), owner


def unit_maxima(net: ByteNet, padded: np.ndarray) -> np.ndarray:
    """Each filter's largest answer within each unit but the last, which only ends the last text."""
    x = net.embed[padded[: len(padded) - UNIT + STEP]].reshape(-1, STEP * EMBED)
    answer = x[:-1] @ net.first
    answer += x[1:] @ net.second
    return answer.reshape(-1, UNIT // STEP, FILTERS).max(1) + net.bias


def probabilities(net: ByteNet, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The probability of label 1 for each text of a block."""
    if net.constant is not None:
        return np.full(len(offsets) - 1, net.constant)
    padded, first_unit, n_units = units(data, offsets)
    best = unit_maxima(net, padded)
    first, last, owner = chunks(first_unit, n_units)
    pooled = best[first]
    for k in range(1, CHUNK // UNIT):
        np.maximum(pooled, best[np.minimum(first + k, last - 1)], out=pooled)
    hidden = np.maximum(np.maximum(pooled, 0) @ net.hidden + net.hidden_bias, 0)
    starts = np.searchsorted(owner, np.arange(len(offsets) - 1))
    document = np.maximum.reduceat(hidden, starts, axis=0)
    logit = np.clip(document @ net.out + net.out_bias[0], -30, 30)
    return 1 / (1 + np.exp(-logit.astype(np.float64)))


def _gradients(net: ByteNet, data: np.ndarray, offsets: np.ndarray, y: np.ndarray, weight: np.ndarray) -> list[np.ndarray]:
    padded, first_unit, n_units = units(data, offsets)
    first, last, owner = chunks(first_unit, n_units)
    per, n = CHUNK // STEP, len(y)
    at = first[:, None] * (UNIT // STEP) + np.arange(per)  # positions of each chunk, in steps
    at = np.minimum(at, last[:, None] * (UNIT // STEP) - 1)
    x = net.embed[padded].reshape(-1, STEP * EMBED)
    answer = x[:-1] @ net.first + x[1:] @ net.second
    in_chunks = answer[np.minimum(at, len(answer) - 1)]
    where = in_chunks.argmax(1)
    pooled = np.take_along_axis(in_chunks, where[:, None, :], 1)[:, 0, :] + net.bias
    active = np.maximum(pooled, 0)
    raw = active @ net.hidden + net.hidden_bias
    hidden = np.maximum(raw, 0)
    starts = np.searchsorted(owner, np.arange(n))
    document = np.maximum.reduceat(hidden, starts, axis=0)
    p = 1 / (1 + np.exp(-np.clip(document @ net.out + net.out_bias[0], -30, 30)))
    d_logit = ((p - y) * weight).astype(np.float32)
    d_out, d_out_bias = d_logit @ document, d_logit.sum(keepdims=True)
    top = (hidden == document[owner]) & (raw > 0)
    top &= np.cumsum(top, 0) - np.concatenate([np.zeros((1, HIDDEN), int), np.cumsum(top, 0)])[starts][owner] == 1  # the first of equals
    d_raw = top * (d_logit[owner][:, None] * net.out)
    d_hidden, d_hidden_bias = active.T @ d_raw, d_raw.sum(0)
    d_pooled = (d_raw @ net.hidden.T) * (pooled > 0)
    position = np.take_along_axis(at, where, 1)  # chunk x filter
    one, two = x[position], x[position + 1]
    d_first, d_second = np.einsum("cf,cfw->wf", d_pooled, one), np.einsum("cf,cfw->wf", d_pooled, two)
    byte = padded.reshape(-1, STEP)
    d_embed = np.zeros_like(net.embed)
    for shift, filters in ((0, net.first), (1, net.second)):
        d_x = (d_pooled[:, :, None] * filters.T[None]).reshape(-1, EMBED)
        codes = byte[position + shift].reshape(-1)
        for e in range(EMBED):
            d_embed[:, e] += np.bincount(codes, d_x[:, e], 256).astype(np.float32)
    return [d_embed, d_first, d_second, d_pooled.sum(0), d_hidden, d_hidden_bias, d_out, d_out_bias]


def train(texts: list[bytes], labels: np.ndarray, epochs: int = 12, batch: int = 32, rate: float = 4e-3, seed: int = 42, min_steps: int = 500) -> ByteNet:
    """Adam on the logistic loss, both classes weighing the same. Small samples get more epochs."""
    epochs = max(epochs, -(-min_steps // -(-len(texts) // batch)))
    net, rng = new_net(seed), np.random.default_rng(seed)
    weight = np.where(labels > 0, 0.5 / max((labels > 0).mean(), 1e-9), 0.5 / max((labels == 0).mean(), 1e-9))
    slow = [np.zeros_like(p) for p in net.parameters()]
    square = [np.zeros_like(p) for p in net.parameters()]
    steps, total = 0, epochs * -(-len(texts) // batch)
    for _ in range(epochs):
        order = rng.permutation(len(texts))
        for k in range(0, len(order), batch):
            rows = order[k : k + batch]
            data = np.frombuffer(b"".join(texts[i] for i in rows), np.uint8)
            offsets = np.concatenate([[0], np.cumsum([len(texts[i]) for i in rows])]).astype(np.int64)
            found = _gradients(net, data, offsets, labels[rows], weight[rows] / len(rows))
            steps += 1
            now = rate * min(1.0, 2 * (1 - steps / (total + 1)))
            for p, g, m, v in zip(net.parameters(), found, slow, square, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= (now * (m / (1 - 0.9**steps)) / (np.sqrt(v / (1 - 0.999**steps)) + 1e-8)).astype(np.float32)
    return net


def fit(
    docs: DataFrame,
    labels: DataFrame,
    per_class: int = 2000,
    max_train_chars: int = 20_000,
    epochs: int = 12,
    seed: int = 42,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
) -> ByteNet:
    """Train on rows of ``docs`` that ``labels`` marks 0 or 1; an id with several labels has the smallest."""
    marked = labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_label")).where("_label IN (0, 1)")
    marked = marked.groupBy("_id").agg(F.min("_label").alias("_label"))
    short = docs.where(F.length(F.col(text_col)) <= max_train_chars)
    known = short.select(F.col(id_col).alias("_id")).join(marked, "_id")
    picked = bounded_sample(known, "_id", "_label", per_class, seed).dropDuplicates(["_id"])  # about 2 * per_class ids
    rows = short.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).join(F.broadcast(picked), "_id")
    rows = sorted(rows.dropDuplicates(["_id"]).collect(), key=lambda r: r["_id"])  # no text is longer than max_train_chars
    y = np.array([r["_label"] for r in rows], np.float32)
    if len(set(y.tolist())) < 2:
        net = new_net(seed)
        net.constant = float(y.mean()) if len(y) else 0.5
        return net
    return train([r["_text"].encode() for r in rows], y, epochs, seed=seed)


def score(docs: DataFrame, net: ByteNet, threshold: float = 0.7, text_col: str = "text") -> DataFrame:
    """``docs`` and the columns ``score`` and ``predicted`` (1 from ``threshold`` on)."""

    def compute(_: pa.Array, data: np.ndarray, offsets: np.ndarray) -> list[pa.Array]:
        p = probabilities(net, data, offsets)
        return [pa.array(p, pa.float64()), pa.array((p >= threshold).astype(np.int32))]

    return blocks.with_text_columns(docs, text_col, ADDED, compute)
