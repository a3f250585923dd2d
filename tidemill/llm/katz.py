"""Scoring texts with a Katz back-off bigram model.

Tokens are words (ASCII letters lower-cased) and one end per text. With counts c, a history h and the
Good-Turing discounts d_1 .. d_k (1 beyond k):

* seen pair: P(w | h) = d_c(h,w) c(h,w) / C(h)
* unseen pair, known history: P(w | h) = alpha(h) P(w), and P(w | h) = P(w) after an unknown one
* known word: P(w) = d_c(w) c(w) / N; all unknown words share what that leaves

alpha(h) = (1 - sum of P(w | h) over seen w) / (1 - sum of P(w) over the same w), so every distribution sums to
one exactly. C(h) is c(h), or c(h) + 1 where no seen pair is discounted and for histories that are split.

Plan: (1) word counts, a table; (2) all occurrences go to *buckets* of histories, packed as bytes, pairs of
a text once with their count. Histories with more than ``SPLIT`` occurrences are split by the next word.
A bucket counts its pairs over training texts, then scores all its occurrences in place. What needs
numbers from elsewhere leaves as rows of a table partitioned by kind: sums per text (a task adds up all its buckets, and
sends the texts that got something), histories that an
unseen pair backs off from, and rare words. (3) Rare words meet the word counts, histories get their
alpha, and the parts of a text are added up. The counts of the ``FREQUENT`` most frequent words travel with
the plan: a fixed bound; all other words are joined.

Words are 64-bit hashes; the second word of a pair keeps 48 bits. Null texts count as empty (one token,
the end). Rows with equal ids are scored one by one; a null id is scored like others. Without training
texts every unknown word has probability one, so scores are 0. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm import blocks
from tidemill.llm.common import give_back
from tidemill.plans.scratch import materialize, scratch_path

K = 5  # counts up to K are discounted
CHUNK_TOKENS, CHUNK_TEXTS, PART_TEXTS = 1_200_000, 1 << 14, 1 << 13
BUCKET_TOKENS, MIN_BUCKETS, MAX_BUCKETS = 400_000, 512, 1 << 20
TASK_TOKENS, MIN_TASKS = 24_000_000, 16
FREQUENT = 1 << 18
CODE_BYTES = 6
FLUSH_TEXTS = 3_500_000  # texts whose sums a task holds, 40 bytes each
HAND_ON = 1 << 23  # bytes of sums in a batch
BATCH_ROWS = 256  # packed rows of an Arrow batch: each may have many kilobytes
START, END = np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F)
HELD, SAME = 1 << 14, 1 << 15  # flags beside the text's number
RECORDS = "spark.sql.execution.arrow.maxRecordsPerBatch"
PACKED = "bucket int, chunk bigint, kind string, data binary"
PARTS = "kind string, key bigint, items array<bigint>, amount double, data binary"
_U = np.uint64


def short(words: np.ndarray) -> np.ndarray:
    """The bits of a word that stand for it as the second of a pair."""
    return (words >> _U(64 - 8 * CODE_BYTES)).astype(np.int64)


def good_turing(n: list[int]) -> list[float]:
    """Discounts d_1 .. d_K from the numbers of items seen 1 .. K + 1 times.

    Katz's formula where it lies strictly between 0 and 1, else (r - 1/2) / r, which always does.
    """
    out = []
    tail = (K + 1) * n[K] / n[0] if n[0] else 1.0
    for r in range(1, K + 1):
        d = 0.0
        if n[r - 1] and n[r] and tail < 1:
            d = ((r + 1) * n[r] / n[r - 1] / r - tail) / (1 - tail)
        out.append(d if 0 < d < 1 else (r - 0.5) / r)
    return out


@dataclass
class Words:
    """What is known of the words before pairs are counted."""

    n: int  # tokens
    v: int  # distinct tokens
    texts: int
    discounts: list[float]
    total: int  # denominator: n, or n + 1 where nothing is discounted
    unknown: float
    codes: np.ndarray  # codes of frequent words, ascending
    shares: np.ndarray  # their probabilities
    split_words: np.ndarray  # words split by the next word, ascending
    split_counts: np.ndarray

    def buckets(self) -> int:
        return int(min(max(self.n // BUCKET_TOKENS, MIN_BUCKETS), MAX_BUCKETS))

    def limit(self) -> int:
        return max(BUCKET_TOKENS, self.n // MAX_BUCKETS)

    def probability(self, count: np.ndarray) -> np.ndarray:
        d = np.ones(len(count))
        for r, x in enumerate(self.discounts, 1):
            d[count == r] = x
        return np.where(count > 0, d * count / max(self.total, 1), self.unknown)

    def column(self, count: Column) -> Column:
        """``probability`` as a column; null counts are unknown words."""
        d = F.lit(1.0)
        for r, x in enumerate(self.discounts, 1):
            d = F.when(count == r, F.lit(x)).otherwise(d)
        return F.when(count > 0, d * count / F.lit(float(max(self.total, 1)))).otherwise(F.lit(self.unknown))


@dataclass
class Chunk:
    ids: list
    held: np.ndarray
    lengths: np.ndarray
    history: np.ndarray
    word: np.ndarray
    text: np.ndarray


def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[Chunk]:
    """Occurrences of some texts: each word and the end after what precedes it."""
    parts: list[tuple] = []

    def joined() -> Chunk:
        ids, held, lengths, history, word, text = zip(*parts, strict=True)
        first = np.cumsum([0, *map(len, lengths)])
        text = np.concatenate([t + f for t, f in zip(text, first, strict=False)])
        return Chunk(sum(ids, []), np.concatenate(held), np.concatenate(lengths), np.concatenate(history), np.concatenate(word), text)

    for batch in (b.slice(k, PART_TEXTS) for b in batches for k in range(0, len(b), PART_TEXTS)):
        for a, b, data, offsets in blocks.text_blocks(batch.column("text")):
            data = blocks.ASCII_LOWER[data]
            starts, ends, owner = blocks.words(data, offsets)
            lengths = np.bincount(owner, minlength=b - a) + 1
            word = np.full(len(owner) + b - a, END)
            word[np.arange(len(owner)) + owner] = blocks.span_hashes(data, starts, ends)
            history = np.empty_like(word)
            history[1:] = word[:-1]
            history[np.cumsum(lengths) - lengths] = START
            rows = batch.slice(a, b - a)
            held = rows.column("held").to_numpy(zero_copy_only=False)
            parts.append((rows.column("id").to_pylist(), held, lengths, history, word, np.repeat(np.arange(b - a), lengths)))
            if sum(len(p[4]) for p in parts) >= CHUNK_TOKENS or sum(len(p[2]) for p in parts) + PART_TEXTS > CHUNK_TEXTS:
                yield joined()
                parts.clear()
    if parts:
        yield joined()
        parts.clear()
    give_back()


@contextmanager
def _small_batches(spark: SparkSession) -> Iterator[None]:
    """What is written meanwhile hands packed rows to Python a few megabytes at a time."""
    before = spark.conf.get(RECORDS)
    spark.conf.set(RECORDS, BATCH_ROWS)
    try:
        yield
    finally:
        spark.conf.set(RECORDS, before)


def _slim(docs: DataFrame, held: Column, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("bigint").alias("id"), F.coalesce(held, F.lit(False)).alias("held"), F.col(text_col).cast("string").alias("text"))


def count_words(slim: DataFrame, path: str) -> Words:
    """Writes the table of ``word, n`` at ``path`` and sums it up."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batches):
            word, n = np.unique(chunk.word[~chunk.held[chunk.text]], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(word.view(np.int64)), pa.array(n, pa.int64())], names=["word", "n"])

    spark = slim.sparkSession
    slim.mapInArrow(run, "word bigint, n bigint").groupBy("word").agg(F.sum("n").alias("n")).write.parquet(path)
    words = spark.read.parquet(path)
    times = [F.sum((F.col("n") == r).cast("bigint")).alias(f"n{r}") for r in range(1, K + 2)]
    end = F.max(F.when(F.col("word") == int(END.view(np.int64)), F.col("n"))).alias("texts")
    s = words.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v"), end, *times).first()
    n_times = [s[f"n{r}"] or 0 for r in range(1, K + 2)]
    n, discounts = s["n"] or 0, good_turing(n_times)
    freed = sum((1 - d) * r * n_times[r - 1] for r, d in enumerate(discounts, 1))
    total = n if freed > 0 else n + 1
    found = Words(n, s["v"], s["texts"] or 0, discounts, total, (freed + total - n) / max(total, 1), *[np.empty(0)] * 4)
    top = words.orderBy(F.desc("n"), "word").limit(FREQUENT).toArrow()
    word, count = top.column("word").to_numpy().view(_U), top.column("n").to_numpy()
    code, one = np.unique(short(word), return_index=True)
    found.codes, found.shares = code, found.probability(count[one])
    many = count > found.limit()
    word, count = word[many], count[many]
    if found.texts > found.limit():
        word, count = np.append(word, START), np.append(count, found.texts)
    order = np.argsort(word)
    found.split_words, found.split_counts = word[order], count[order]
    return found


def _look_up(keys: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Places in an ascending table, -1 where absent."""
    if not len(table):
        return np.full(len(keys), -1)
    at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return np.where(table[at] == keys, at, -1)


def _pack(arrays: list[np.ndarray]) -> bytes:
    return b"".join([np.array([len(arrays), *(len(a) for a in arrays)], np.int32).tobytes(), *(a.tobytes() for a in arrays)])


def _unpack(data: bytes, kinds: list[str]) -> list[np.ndarray]:
    n = np.frombuffer(data, np.int32, 1)[0]
    at, out = 4 * (n + 1), []
    for size, kind in zip(np.frombuffer(data, np.int32, n, 4), kinds, strict=True):
        out.append(np.frombuffer(data, kind, size, at))
        at += size * np.dtype(kind).itemsize
    return out


def pack_occurrences(slim: DataFrame, known: Words) -> DataFrame:
    """Rows for buckets: the pairs of a chunk in order of history and word, and the texts that have them."""
    n_buckets, limit = known.buckets(), known.limit()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number = TaskContext.get().partitionId(), 0
        for chunk in chunks(batches):
            name, number = task * 2**20 + number, number + 1
            code = short(chunk.word)
            place = _look_up(chunk.history, known.split_words)
            parts = np.ones(len(code), np.int64)
            parts[place >= 0] = known.split_counts[place[place >= 0]] // limit + 1
            bucket = ((blocks.mix(chunk.history) >> _U(20)).astype(np.int64) + code % parts * 7919) % n_buckets
            order = np.lexsort((chunk.text, code, chunk.history, bucket))
            bucket, history, code, text = bucket[order], chunk.history[order], code[order], chunk.text[order]
            new_history = np.append(True, (history[1:] != history[:-1]) | (bucket[1:] != bucket[:-1]))
            new_pair = new_history | np.append(True, code[1:] != code[:-1])
            entry = np.flatnonzero(new_pair | np.append(True, text[1:] != text[:-1]))
            times = np.diff(np.append(entry, len(code)))
            bucket, history, code, text, new_pair, new_history = (x[entry] for x in (bucket, history, code, text, new_pair, new_history))
            mark = (text + HELD * chunk.held[text] + SAME * ~new_pair).astype(np.uint16)
            cut = np.append(np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])), len(bucket))
            rows: tuple[list, list] = ([], [])
            texts = np.array([len(chunk.ids)], np.int32)
            for a, b in zip(cut[:-1], cut[1:], strict=True):
                first = np.flatnonzero(new_history[a:b])
                packed = code[a:b][new_pair[a:b]].astype("<i8").view(np.uint8).reshape(-1, 8)[:, :CODE_BYTES].reshape(-1)
                often = np.flatnonzero(times[a:b] > 1)
                arrays = [history[a:b][first], np.diff(np.append(first, b - a)).astype(np.int32), packed, mark[a:b], often.astype(np.int32), times[a:b][often].astype(np.int32), texts]
                rows[0].append(int(bucket[a]))
                rows[1].append(_pack(arrays))
            about = _pack([np.array([i if i is not None else 0 for i in chunk.ids], np.int64), np.array([i is None for i in chunk.ids], np.uint8), chunk.held.astype(np.uint8), chunk.lengths.astype(np.int32)])
            rows[0].append(n_buckets + name % n_buckets)
            rows[1].append(about)
            kinds = ["pairs"] * (len(rows[0]) - 1) + ["texts"]
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows[0], pa.int32()), pa.array([name] * len(kinds), pa.int64()), pa.array(kinds), pa.array(rows[1], pa.binary())],
                names=["bucket", "chunk", "kind", "data"],
            )

    return slim.mapInArrow(run, PACKED)


def _read_bucket(rows: list[tuple[int, bytes]]) -> tuple[np.ndarray, ...]:
    """History, code, chunk, text, held and count of all entries of a bucket, and the number of texts of each chunk."""
    out, sizes_of = [], []
    for k, (_, data) in enumerate(rows):
        histories, sizes, packed, mark, often, times, texts = _unpack(data, ["u8", "i4", "u1", "u2", "i4", "i4", "i4"])
        codes = np.zeros((len(packed) // CODE_BYTES, 8), np.uint8)
        codes[:, :CODE_BYTES] = packed.reshape(-1, CODE_BYTES)
        codes = codes.reshape(-1).view("<i8")
        count = np.ones(len(mark), np.int32)
        count[often] = times
        pair = np.cumsum((mark & SAME) == 0) - 1
        out.append((np.repeat(histories, sizes), codes[pair], np.full(len(mark), k, np.int32), (mark & (HELD - 1)).astype(np.int32), (mark & HELD) > 0, count))
        sizes_of.append(int(texts[0]))
    return *(np.concatenate(x) for x in zip(*out, strict=True)), sizes_of


class _Sums:
    """Sums per text: base score and score, known tokens and seen pairs of each discounted count."""

    def __init__(self) -> None:
        self.at: dict[int, tuple[int, int]] = {}  # first text and number of texts of a chunk
        self.size = 0
        self.scores, self.counts = np.zeros((2, 0)), np.zeros((1 + K, 0), np.int32)

    def places(self, chunks: list[int], sizes: list[int]) -> np.ndarray:
        """The first place of each chunk."""
        for chunk, n in zip(chunks, sizes, strict=True):
            if chunk not in self.at:
                self.at[chunk] = self.size, n
                self.size += n
        if self.size > self.scores.shape[1]:
            more = max(self.size, min(2 * self.scores.shape[1], FLUSH_TEXTS)) - self.scores.shape[1]
            self.scores, self.counts = (np.pad(x, ((0, 0), (0, more))) for x in (self.scores, self.counts))
        return np.array([self.at[c][0] for c in chunks])

    def rows(self) -> Iterator[tuple]:
        """What each chunk's texts have got, without those that got nothing."""
        for chunk, (first, n) in self.at.items():
            scores, counts = self.scores[:, first : first + n], self.counts[:, first : first + n]
            some = np.flatnonzero(scores.any(0) | counts.any(0))
            if len(some):
                counts = counts[:, some]
                small = counts.max() < 256
                flat = [counts.astype(np.uint8) if small else np.empty(0, np.uint8), np.empty(0, np.int32) if small else counts]
                yield ("sums", chunk, None, None, _pack([some.astype(np.uint16), *scores[:, some], *(x.reshape(-1) for x in flat)]))
        self.__init__()


def _score_bucket(rows: list[tuple[int, bytes]], known: Words, sums: _Sums) -> Iterator[tuple]:
    history, code, chunk, text, held, count, sizes = _read_bucket(rows)
    order = np.lexsort((code, history))
    history, code, chunk, text, held, count = (x[order] for x in (history, code, chunk, text, held, count))
    first_h = np.append(True, history[1:] != history[:-1])
    first_p = first_h | np.append(True, code[1:] != code[:-1])
    pair, hist = np.cumsum(first_p, dtype=np.int32) - 1, np.cumsum(first_h, dtype=np.int32) - 1
    seen = np.bincount(pair, count * ~held).astype(np.int64)
    pair_hist, pair_code, hist_word = hist[first_p], code[first_p], history[first_h]
    n_hist = len(hist_word)
    total = np.bincount(pair_hist, seen, n_hist).astype(np.int64)
    split = _look_up(hist_word, known.split_words)
    total[split >= 0] = known.split_counts[split[split >= 0]]
    low = (seen > 0) & (seen <= K)
    plus = ((np.bincount(pair_hist, low, n_hist) == 0) | (split >= 0)) & (total > 0)
    yield ("counts", 0, [int((seen == r).sum()) for r in range(1, K + 2)], None, None)

    # What an entry adds follows from its pair or its history.
    bottom = np.where(total > 0, np.log10(np.maximum(total + plus, 1)), 0.0)
    top = np.where(seen > K, np.log10(np.maximum(seen, 1)), 0.0)
    share_at = _look_up(pair_code, known.codes)
    pair_share = np.where(share_at >= 0, known.shares[share_at] if len(known.shares) else 0.0, 0.0)
    frequent = share_at >= 0
    unseen = np.where(frequent, np.log10(np.where(pair_share > 0, pair_share, 1.0)), 0.0)
    pair_score = np.where(seen > 0, top - bottom[pair_hist], unseen)
    is_word = hist_word != START
    base = np.where(is_word, np.log10(total + 1.0), 0.0)
    place = sums.places([name for name, _ in rows], sizes)[chunk] + text
    np.add.at(sums.scores[0], place, count * base[hist])
    np.add.at(sums.scores[1], place, count * pair_score[pair])
    at = np.flatnonzero((is_word & (total > 0))[hist])
    np.add.at(sums.counts[0], place[at], count[at])
    for r in range(1, K + 1):
        at = np.flatnonzero((seen == r)[pair])
        np.add.at(sums.counts[r], place[at], count[at])
    del place, at
    c, h = seen[pair], total[hist]

    names = np.array([name for name, _ in rows], np.int64)
    key = names[chunk] * CHUNK_TEXTS + text
    del text, chunk
    late = np.flatnonzero((c == 0) & ~frequent[pair])  # an unseen pair with a word that is not frequent
    for group in np.split(late, np.flatnonzero(np.diff(pair[late])) + 1) if len(late) else []:
        yield ("late", int(code[group[0]]), np.repeat(key[group], count[group]).tolist(), None, None)
    back = np.flatnonzero((c == 0) & (h > 0))  # backs off from a known history
    needed = np.unique(hist[back])
    starts = np.flatnonzero(first_h[np.flatnonzero(first_p)])
    stops = np.append(starts[1:], len(seen))
    for group in np.split(back, np.flatnonzero(np.diff(hist[back])) + 1) if len(back) else []:
        yield ("back", int(history[group[0]].view(np.int64)), np.repeat(key[group], count[group]).tolist(), None, None)
    # A split history is needed as a whole if any of its parts is, so each part tells of itself.
    for i in np.union1d(needed, np.flatnonzero(split >= 0)):
        mine = slice(starts[i], stops[i])
        s, common = seen[mine], frequent[mine]
        name = int(hist_word[i].view(np.int64))
        stats = [int(total[i]), int(plus[i]), *(int((s == r).sum()) for r in range(1, K + 1))]
        yield ("history", name, stats, float(pair_share[mine][(s > 0) & common].sum()), None)
        rare = pair_code[mine][(s > 0) & ~common]
        if len(rare):
            yield ("rare", name, rare.tolist(), None, None)


def _score_task(batches: Iterator[pa.RecordBatch], known: Words) -> Iterator[pa.RecordBatch]:
    """Rows come in order of bucket. A bucket is held whole; sums are passed on when there are many."""
    sums, waiting, current = _Sums(), [], None
    names = [c.split()[0] for c in PARTS.split(", ")]
    types = [pa.string(), pa.int64(), pa.list_(pa.int64()), pa.float64(), pa.binary()]

    def made(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

    def handed_on() -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for row in sums.rows():
            rows.append(row)
            size += len(row[4])
            if size >= HAND_ON:
                yield made(rows)
                rows, size = [], 0
        if rows:
            yield made(rows)

    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("bucket", "chunk", "kind", "data")]
        for bucket, chunk, kind, data in zip(*columns, strict=True):
            if bucket != current and waiting:
                yield made(list(_score_bucket(waiting, known, sums)))
                waiting = []
                if sums.size > FLUSH_TEXTS:
                    yield from handed_on()
            current = bucket
            if kind == "texts":
                yield made([("texts", chunk, None, None, data)])
            else:
                waiting.append((chunk, data))
    if waiting:
        yield made(list(_score_bucket(waiting, known, sums)))
        waiting = []
    yield from handed_on()
    give_back()


def _add_up(batches: Iterator[pa.RecordBatch], known: Words, discounts: list[float]) -> Iterator[pa.RecordBatch]:
    """Rows come in order of chunk; its texts come with their ids, its sums in parts."""
    weights = np.log10([d * r for r, d in enumerate(discounts, 1)])
    about: list[np.ndarray] = []
    total = np.zeros((3 + K, 0))

    def made(chunk: int) -> pa.RecordBatch:
        ids, null_ids, held, lengths = about
        base = total[0] + np.log10(known.texts + 1) - lengths * np.log10(known.n + known.v + 1)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(chunk * CHUNK_TEXTS + np.arange(len(ids)), pa.int64()),
                pa.array(ids, pa.int64(), mask=null_ids.astype(bool)),
                pa.array(held.astype(bool)),
                pa.array(lengths, pa.int64()),
                pa.array(total[2] + (known.texts > 0), pa.int64(), safe=False),
                pa.array(base, pa.float64()),
                pa.array(total[1] + weights @ total[3:], pa.float64()),
            ],
            names=["key", "id", "held", "n_tokens", "n_known", "base", "score"],
        )

    current = None
    for batch in batches:
        for kind, chunk, data in zip(*(batch.column(c).to_pylist() for c in ("kind", "key", "data")), strict=True):
            if chunk != current and about:
                yield made(current)
                about = []
            current = chunk
            if kind == "texts":
                about = _unpack(data, ["i8", "u1", "u1", "i4"])
                total = np.zeros((3 + K, len(about[0])))
            else:
                text, base, score, small, wide = _unpack(data, ["u2", "f8", "f8", "u1", "i4"])
                total[:, text] += np.stack([base, score, *(small if len(small) else wide).reshape(1 + K, -1)])
    if about:
        yield made(current)
    give_back()


def _alphas(parts: DataFrame, counts: DataFrame, known: Words, discounts: list[float]) -> DataFrame:
    """``key`` (history) and ``log_alpha``, from what the parts of a history say and the words met elsewhere."""
    rare = parts.where("kind = 'rare'").select(F.col("key").alias("history"), F.explode("items").alias("code"))
    rare = rare.join(counts, "code").select(F.col("history").alias("key"), known.column(F.col("n")).alias("mass"))
    rare = rare.groupBy("key").agg(F.sum("mass").alias("rare_mass"))
    items = [F.get("items", i) for i in range(2 + K)]
    stats = parts.where("kind = 'history'").select("key", *[x.alias(f"i{i}") for i, x in enumerate(items)], "amount")
    stats = stats.groupBy("key").agg(
        F.max("i0").alias("total"), F.max("i1").alias("plus"), *[F.sum(f"i{1 + r}").alias(f"n{r}") for r in range(1, K + 1)], F.sum("amount").alias("mass")
    )
    freed = sum((F.col(f"n{r}") * F.lit((1 - d) * r) for r, d in enumerate(discounts, 1)), F.lit(0.0))
    left = (F.col("plus") + freed) / (F.col("total") + F.col("plus"))
    rest = 1 - F.col("mass") - F.coalesce("rare_mass", F.lit(0.0))
    return stats.join(rare, "key", "left").select("key", F.log10(left / rest).alias("log_alpha"))


def katz_scores(docs: DataFrame, held: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Scores of all rows by a model of the rows that are not ``held``: ``doc_id, held_out, n_tokens, n_known,
    train_tokens, base_score, score``."""
    spark: SparkSession = docs.sparkSession
    slim = _slim(docs, held, id_col, text_col)
    words = scratch_path(spark, "words")
    known = count_words(slim, words)
    counts = spark.read.parquet(words).select(F.shiftrightunsigned("word", 64 - 8 * CODE_BYTES).alias("code"), "n").groupBy("code").agg(F.max("n").alias("n"))

    tasks = max(MIN_TASKS, known.n // TASK_TOKENS)
    packed = pack_occurrences(slim, known).repartition(tasks, "bucket").sortWithinPartitions("bucket")
    path = scratch_path(spark, "katz")
    with _small_batches(spark):
        packed.mapInArrow(lambda batches: _score_task(batches, known), PARTS).write.partitionBy("kind").parquet(path)
    schema = "key bigint, items array<bigint>, amount double, data binary, kind string"
    parts = spark.read.schema(schema).parquet(path)
    seen = parts.where("kind = 'counts'").agg(*[F.sum(F.get("items", r)).alias(f"n{r}") for r in range(K + 1)]).first()
    discounts = good_turing([x or 0 for x in seen])

    log_alpha = _alphas(parts, counts, known, discounts)
    back = parts.where("kind = 'back'").select("key", "items").join(log_alpha, "key").select(F.explode("items").alias("key"), F.col("log_alpha").alias("more"))
    late = parts.where("kind = 'late'").select(F.col("key").alias("code"), "items").join(counts, "code", "left")
    late = late.select(F.log10(known.column(F.col("n"))).alias("more"), F.explode("items").alias("key"))
    more = back.unionByName(late).groupBy("key").agg(F.sum("more").alias("more"))

    ordered = parts.where("kind IN ('texts', 'sums')").select("kind", "key", "data").repartition(tasks, "key").sortWithinPartitions("key", F.desc("kind"))
    sums = ordered.mapInArrow(
        lambda batches: _add_up(batches, known, discounts),
        "key bigint, id bigint, held boolean, n_tokens bigint, n_known bigint, base double, score double",
    )
    with _small_batches(spark):
        sums = materialize(sums, "sums")
    return sums.join(more, "key", "left").select(
        F.col("id").alias("doc_id"),
        F.col("held").alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(known.n).cast("bigint").alias("train_tokens"),
        F.col("base").alias("base_score"),
        (F.col("score") + F.coalesce("more", F.lit(0.0))).alias("score"),
    )
