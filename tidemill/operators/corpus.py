"""Character and word corpora: vocabulary, encoding, splits, batches, bigram statistics.

A corpus is a table ``(doc_id, text)`` read as one long stream in the order of ``doc_id``. Batches
are built from pieces of text cut at block borders, not from one row per character: what shuffles is
about the size of the text itself.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.functions.hashing import hash_unit, wide_draw
from tidemill.plans import lookup_join, materialize, param_join, prefix_sum, previous
from tidemill.plans.lookup import lookup_rows
from tidemill.plans.ordered import ranked_ids

# Defaults of the training set-up.
SPLIT_RATIO = 0.9
BATCH_SIZE = 64
BLOCK_SIZE = 128
EVAL_ITERS = 200
SEED = 1337
SPLITS = ("train", "val")

CODE_POINTS = 0x110000  # no alphabet can have more characters
PAGE = 256  # code points of one page of a codec
PAIR_BYTES = 1_000_000  # bytes of text whose pairs are counted at a time
WINDOW_CHARS = 4_000_000  # characters of drawn windows in one task
SPAN_BIN = 65_536  # characters of the stream in one bin of the index of pieces


def chars(text: Column | str) -> Column:
    """Characters of a non-empty text."""
    return F.split(text, "")


def non_empty(corpus: DataFrame) -> DataFrame:
    return corpus.where(F.col("text") != "")


# --- vocabulary, encoding -------------------------------------------------------------------------


def alphabet(corpus: DataFrame) -> DataFrame:
    """Distinct characters; repeats within a text go before any row leaves it."""
    return (
        non_empty(corpus)
        .select(F.explode(F.array_distinct(chars("text"))).alias("token"))
        .distinct()
    )


def build_vocab(corpus: DataFrame) -> DataFrame:
    """Characters numbered from 0 in code-point order. The window sees the alphabet only."""
    order = W.orderBy("token")
    return alphabet(corpus).select("token", (F.row_number().over(order) - 1).cast("int").alias("id"))


def vocab_size(corpus: DataFrame) -> DataFrame:
    return alphabet(corpus).agg(F.count(F.lit(1)).alias("vocab_size"))


def _folded(numbers: Sequence[int]) -> Column:
    """A constant array of integers: one text literal that Spark folds, whatever its length."""
    return F.split(F.lit(" ".join(map(str, numbers))), " ").cast("array<int>")


@dataclass(frozen=True)
class CharCodec:
    """Column expressions between characters and ids.

    Ids sit in pages of ``PAGE`` code points; page 0 stands for all pages without a character. A lookup
    is two array accesses, and the literals hold the used pages only.
    """

    page_of: list[int]
    table: list[int]
    tokens: str

    @classmethod
    def of(cls, vocab: DataFrame) -> CharCodec:
        rows = vocab.limit(CODE_POINTS + 1).collect()
        if len(rows) > CODE_POINTS:
            raise ValueError("a character vocabulary has at most one entry per code point")
        ids = {ord(r["token"]): r["id"] for r in rows}
        used = {page: k + 1 for k, page in enumerate(sorted({c // PAGE for c in ids}))}
        # the last slot stands for everything outside the alphabet
        page_of = [used.get(page, 0) for page in range(max(used, default=-1) + 2)]
        table = [-1] * PAGE * (len(used) + 1)
        for code, i in ids.items():
            table[used[code // PAGE] * PAGE + code % PAGE] = i
        return cls(page_of, table, "".join(chr(c) for c in sorted(ids, key=ids.__getitem__)))

    def ids(self, text: Column, on_unknown: str = "error") -> Column:
        """``text`` -> array of ids; an unknown character raises or becomes null."""
        page_of, table, last = _folded(self.page_of), _folded(self.table), F.lit(len(self.page_of) - 1)

        def one(c: Column) -> Column:
            code = F.ascii(c)
            page = F.get(page_of, F.least(F.shiftright(code, 8), last))
            return F.get(table, page * PAGE + code.bitwiseAND(F.lit(PAGE - 1)))

        found = F.transform(chars(text), one)
        if on_unknown == "null":
            found = F.transform(found, lambda i: F.nullif(i, F.lit(-1)))
        else:
            error = F.raise_error(F.lit("text has characters outside the vocabulary"))
            # a one-element array binds the ids, so they are worked out once
            checked = F.transform(
                F.array(found),
                lambda ids: F.when(F.array_contains(ids, -1), error.cast("array<int>")).otherwise(ids),
            )
            found = checked[0]
        return F.when(text == "", F.array().cast("array<int>")).otherwise(found)

    def text(self, ids: Column) -> Column:
        names = chars(F.lit(self.tokens))
        return F.array_join(F.transform(ids, lambda i: F.get(names, i)), "")


def encode(corpus: DataFrame, vocab: DataFrame, on_unknown: str = "error") -> DataFrame:
    """(doc_id, ids): one array of ids per document."""
    codec = CharCodec.of(vocab)
    return corpus.select("doc_id", codec.ids(F.col("text"), on_unknown).alias("ids"))


def decode(encoded: DataFrame, vocab: DataFrame) -> DataFrame:
    return encoded.select("doc_id", CharCodec.of(vocab).text(F.col("ids")).alias("text"))


def tokens(encoded: DataFrame) -> DataFrame:
    """Long form (doc_id, pos, id)."""
    return encoded.select("doc_id", F.posexplode("ids").alias("pos", "id"))


# --- positions and splits -------------------------------------------------------------------------


def corpus_length(corpus: DataFrame) -> DataFrame:
    return corpus.agg(F.coalesce(F.sum(F.char_length("text")), F.lit(0)).alias("n_chars"))


def placed(corpus: DataFrame) -> DataFrame:
    """Documents with their length ``n`` and position ``start`` in the whole stream.

    Only ids and lengths are put in order; the starts then meet the texts where those are.
    """
    sized = non_empty(corpus).select(
        "doc_id", "text", F.char_length("text").cast("bigint").alias("n")
    )
    summed = prefix_sum(sized.select("doc_id", "n"), "doc_id", ["n"])
    starts = summed.select("doc_id", (F.col("cum_n") - F.col("n")).alias("start"))
    return lookup_join(sized, materialize(starts, "starts"), ["doc_id"], "inner")


def global_position(corpus: DataFrame, vocab: DataFrame) -> DataFrame:
    """Long token table with ``gpos``, the position in the whole stream."""
    codec = CharCodec.of(vocab)
    ids = placed(corpus).select("doc_id", "start", codec.ids(F.col("text")).alias("ids"))
    # The outer form: else Spark filters by the array's size first, and works the ids out for that filter as well.
    return ids.select("doc_id", "start", F.posexplode_outer("ids").alias("pos", "id")).select(
        "doc_id", "pos", "id", (F.col("start") + F.col("pos")).alias("gpos")
    )


@dataclass(frozen=True)
class SplitSizes:
    train: int
    val: int

    def of(self, split: str) -> int:
        return {"train": self.train, "val": self.val}[split]


def split_sizes(corpus: DataFrame, ratio: float = SPLIT_RATIO) -> SplitSizes:
    """Truncate ``ratio * n`` in double arithmetic, as the stream length is a whole number."""
    n = corpus_length(corpus).first()["n_chars"]
    cut = int(ratio * n)
    return SplitSizes(cut, n - cut)


def split_prefix(corpus: DataFrame, sizes: SplitSizes) -> DataFrame:
    """Text pieces ``(split, doc_id, spos, text)``; ``spos`` is the position within the split.

    The document that straddles the cut gives two pieces.
    """
    cut = F.lit(sizes.train).cast("bigint")
    inside = F.greatest(F.lit(0), F.least(F.col("n"), cut - F.col("start"))).cast("int")
    parts = F.array(
        F.struct(
            F.lit("train").alias("split"),
            F.col("start").alias("spos"),
            F.expr("substring(text, 1, inside)").alias("text"),
        ),
        F.struct(
            F.lit("val").alias("split"),
            F.greatest(F.lit(0), F.col("start") - cut).alias("spos"),
            F.expr("substring(text, inside + 1)").alias("text"),
        ),
    )
    return (
        placed(corpus)
        .withColumn("inside", inside)
        .select("doc_id", F.explode(parts).alias("p"))
        .select("p.split", "doc_id", "p.spos", "p.text")
        .where(F.col("text") != "")
    )


def split_stats(pieces: DataFrame) -> DataFrame:
    """Token counts per split and size of the joint vocabulary."""
    size = vocab_size(pieces)
    return pieces.groupBy("split").agg(
        F.sum(F.char_length("text")).cast("bigint").alias("n_tokens")
    ).withColumn("vocab_size", size.scalar())


# --- batches --------------------------------------------------------------------------------------


def _whole_blocks(pieces: DataFrame, block_size: int, overlap: bool) -> DataFrame:
    """Blocks that lie inside one piece, with the next character where they overlap; nothing is shuffled."""
    rest = F.expr("substring(text, head + 1)")
    parts = F.regexp_extract_all(rest, F.lit(f"(?s).{{1,{block_size}}}"), F.lit(0))
    length = block_size + int(overlap)

    def opened(all_parts: Column) -> Column:
        def part(p: Column, i: Column) -> Column:
            following = F.substring(F.coalesce(F.get(all_parts, i + 1), F.lit("")), 1, 1)
            return F.concat(p, following) if overlap else p

        return F.filter(F.transform(all_parts, part), lambda p: F.char_length(p) == length)

    # a one-element array binds the parts, so they are worked out once
    bound = F.transform(F.array(parts), opened)[0]
    cut = pieces.where(F.col("n") - F.col("head") >= length)
    cut = cut.select("split", "spos", "head", F.posexplode_outer(bound).alias("i", "text"))
    block = ((F.col("spos") + F.col("head")) / block_size).cast("bigint") + F.col("i")
    return cut.select("split", block.alias("block"), "text")


def _border_parts(pieces: DataFrame, block_size: int, overlap: bool) -> DataFrame:
    """``(split, block, at, part)`` of blocks that several pieces share: at most three short parts of a piece."""
    size = F.lit(block_size)
    inside = F.greatest(F.col("n") - F.col("head"), F.lit(0))
    whole = F.floor((inside - int(overlap)) / size).cast("bigint")  # whole blocks, as above
    whole = F.greatest(whole, F.lit(0))
    last = F.expr("substring(text, cast(head + whole * size + 1 as int))")
    parts = [
        F.struct(F.col("spos").alias("at"), F.expr("substring(text, 1, cast(head as int))").alias("part"), F.lit(0).alias("back")),
        F.struct((F.col("spos") + F.col("head") + F.col("whole") * size).alias("at"), last.alias("part"), F.lit(0).alias("back")),
    ]
    if overlap:
        first = F.expr("substring(text, cast(head + 1 as int), 1)")
        parts.append(F.struct((F.col("spos") + F.col("head")).alias("at"), first.alias("part"), F.lit(1).alias("back")))
    sized = pieces.withColumn("whole", whole).withColumn("size", size)
    cut = sized.select("split", F.explode_outer(F.array(*parts)).alias("p")).select("split", "p.*")
    block = F.floor(F.col("at") / size).cast("bigint") - F.col("back")
    return cut.where("part != ''").select("split", block.alias("block"), "at", "part").where("block >= 0")


def blocks(pieces: DataFrame, block_size: int, overlap: bool = True) -> DataFrame:
    """Stream cut into blocks of ``block_size`` characters: ``(split, block, text)``.

    With ``overlap`` every block also holds the first character of the next one. Blocks inside one piece are cut
    where the piece is; only the parts of blocks that cross a border are shuffled, each shorter than two blocks. A
    block gathers at most ``block_size + 1`` parts, since each holds at least one character.
    """
    head = F.pmod(-F.col("spos"), F.lit(block_size)).cast("bigint")
    sized = pieces.withColumn("n", F.char_length("text").cast("bigint")).withColumn("head", F.least(head, F.col("n")))
    border = _border_parts(sized, block_size, overlap).groupBy("split", "block").agg(
        F.sort_array(F.collect_list(F.struct("at", "part"))).alias("_p")
    )
    joined = F.array_join(F.transform("_p", lambda p: p["part"]), "")
    return _whole_blocks(sized, block_size, overlap).unionByName(border.select("split", "block", joined.alias("text")))


def batch_count(n: int, span: int) -> int:
    """Batches that start at 0, span, 2 span, ... while the start stays below ``n - span``."""
    if n < span + 1:
        raise ValueError(f"split of {n} tokens is too short for batches of {span}")
    return -(-(n - span) // span)


def seq_batches(
    pieces: DataFrame,
    sizes: SplitSizes,
    vocab: DataFrame,
    splits: Sequence[str] = SPLITS,
    batch_size: int = BATCH_SIZE,
    block_size: int = BLOCK_SIZE,
) -> DataFrame:
    """Non-overlapping batches ``(split, batch_id, row, x, y, original_text)``; y is x moved by one.

    All splits are cut in the same pass. A split too short for one batch is an error.
    """
    span = batch_size * block_size
    counts = {split: batch_count(sizes.of(split), span) for split in splits}
    whole = F.lit(False)
    for split, count in counts.items():
        whole = whole | ((F.col("split") == split) & (F.col("block") < count * batch_size))
    chosen = pieces.where(F.col("split").isin(*splits))
    ids = (
        blocks(chosen, block_size)
        .where(whole)
        .select("split", "block", "text", CharCodec.of(vocab).ids(F.col("text")).alias("ids"))
    )
    return ids.select(
        "split",
        F.floor(F.col("block") / batch_size).cast("bigint").alias("batch_id"),
        (F.col("block") % batch_size).cast("int").alias("row"),
        F.slice("ids", 1, block_size).alias("x"),
        F.slice("ids", 2, block_size).alias("y"),
        F.substring("text", 1, block_size).alias("original_text"),
    )


def batch_cursor(batches: DataFrame, requests: DataFrame, n_batches: int) -> DataFrame:
    """Serve batch ``step mod n_batches`` to every request."""
    asked = requests.select("step", F.pmod("step", F.lit(n_batches)).alias("batch_id"))
    return asked.join(batches, "batch_id")


def sample_windows(
    spark, split: str, n: int, steps: int, batch_size: int, block_size: int, seed: int
) -> DataFrame:
    """Random starts in [0, n - block_size) for every (step, row), repeatable from the seed."""
    slots = spark.range(steps * batch_size).select(
        F.lit(split).alias("split"),
        F.floor(F.col("id") / batch_size).cast("bigint").alias("step"),
        (F.col("id") % batch_size).cast("int").alias("row"),
    )
    key = F.concat_ws(":", "split", F.col("step").cast("string"), F.col("row").cast("string"))
    return slots.withColumn("start", F.pmod(wide_draw(key, seed), F.lit(n - block_size)))


def sample_batches(
    pieces: DataFrame,
    sizes: SplitSizes,
    steps: dict[str, int],
    batch_size: int = BATCH_SIZE,
    block_size: int = BLOCK_SIZE,
    seed: int = SEED,
) -> DataFrame:
    """Random windows of ``block_size + 1`` characters, drawn with replacement.

    ``steps`` says how many batches to draw from each split. Positions alone tell which pieces a window touches;
    then the windows are cut out of the texts, and only what is cut out is shuffled. All windows of a batch meet in
    one task, and the number of tasks follows what is drawn.
    """
    spark = pieces.sparkSession
    tasks = window_tasks(spark, sum(steps.values()) * batch_size * (block_size + 1))
    drawn = []
    for split, count in steps.items():
        n = sizes.of(split)
        if n <= block_size:
            raise ValueError(f"split {split!r} of {n} tokens is too short for windows of {block_size}")
        drawn.append(sample_windows(spark, split, n, count, batch_size, block_size, seed))
    wanted = reduce(DataFrame.unionByName, drawn)
    length = block_size + 1
    held = pieces.where(F.col("split").isin(*steps))
    spans = held.select("split", "spos", (F.col("spos") + F.char_length("text")).alias("end"))
    cuts = lookup_rows(held, materialize(touched(wanted, spans, length), "touched"), ["split", "spos"], partitions=tasks)
    part = F.expr(f"substring(text, cast(greatest(start - spos, 0) + 1 as int), cast({length} - greatest(spos - start, 0) as int))")
    return (
        cuts.select("split", "step", "row", "start", "spos", part.alias("part"))
        .repartition(tasks, "split", "step")
        .groupBy("split", "step", "row", "start")
        .agg(F.sort_array(F.collect_list(F.struct("spos", "part"))).alias("_p"))
        .select("split", "step", "row", "start", F.array_join(F.transform("_p", lambda p: p["part"]), "").alias("text"))
    )


def window_tasks(spark, chars: int) -> int:
    """Tasks that share this many characters of windows, at least the shuffle partitions."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-chars // WINDOW_CHARS))


def touched(windows: DataFrame, spans: DataFrame, length: int, bin_size: int = SPAN_BIN) -> DataFrame:
    """Windows ``(split, ..., start)`` with the ``spos`` of each piece they touch, found from positions alone.

    The stream is cut into bins; a piece is listed in every bin it covers and a window looks into its one or two.
    """
    listed = spans.withColumn("_bin", F.explode_outer(F.sequence(F.floor(F.col("spos") / bin_size), F.floor((F.col("end") - 1) / bin_size))))
    first, last = F.floor(F.col("start") / bin_size), F.floor((F.col("start") + length - 1) / bin_size)
    looking = windows.withColumn("_bin", F.explode_outer(F.sequence(first, last)))
    met = looking.join(listed, ["split", "_bin"]).where((F.col("spos") < F.col("start") + length) & (F.col("end") > F.col("start")))
    once = F.col("_bin") == F.greatest(first, F.floor(F.col("spos") / bin_size))  # the first bin that both are in
    return met.where(once).select(*windows.columns, "spos")


def with_xy(windows: DataFrame, vocab: DataFrame, block_size: int = BLOCK_SIZE) -> DataFrame:
    """Add ids ``x`` and the ids one step later, ``y``."""
    ids = windows.withColumn("ids", CharCodec.of(vocab).ids(F.col("text")))
    return ids.withColumns(
        {"x": F.slice("ids", 1, block_size), "y": F.slice("ids", 2, block_size)}
    ).drop("ids")


# --- bigrams --------------------------------------------------------------------------------------


def _two_sweeps() -> Column:
    """All adjacent pairs of a text: those that start at even places, then those at odd ones."""
    two = F.lit("(?s)..")
    return F.concat(
        F.regexp_extract_all("text", two, F.lit(0)),
        F.regexp_extract_all(F.expr("substring(text, 2)"), two, F.lit(0)),
    )


def bigram_pairs(corpus: DataFrame, *keep: str) -> DataFrame:
    """Adjacent character pairs ``(pos, pair)``."""
    even = F.floor(F.char_length("text") / 2).cast("int")
    i = F.col("i")
    place = F.when(i < F.col("even"), 2 * i).otherwise(2 * (i - F.col("even")) + 1)
    return (
        non_empty(corpus)
        .select(*keep, even.alias("even"), F.posexplode(_two_sweeps()).alias("i", "pair"))
        .select(*keep, place.alias("pos"), "pair")
    )


def _pair_counts(rows: pa.RecordBatch, by: Sequence[str], codes: np.ndarray, row: np.ndarray) -> pa.RecordBatch:
    """Counts of the adjacent characters of some texts; ``row`` says which row each character is from."""
    seen: dict[tuple, int] = {}
    group = np.array([seen.setdefault(k, len(seen)) for k in zip(*[rows.column(b).to_pylist() for b in by], strict=True)] if by else [0] * len(rows), np.int64)
    inside = np.flatnonzero(row[1:] == row[:-1])
    pairs, n = np.unique(group[row[inside]] << 42 | codes[inside] << 21 | codes[inside + 1], return_counts=True)
    _, first = np.unique(group, return_index=True)
    owner = pa.array(first[pairs >> 42])
    names = [np.unique(x, return_inverse=True) for x in (pairs >> 21 & 0x1FFFFF, pairs & 0x1FFFFF)]
    texts = [pa.array([chr(c) for c in used], pa.string()).take(pa.array(at)) for used, at in names]
    return pa.RecordBatch.from_arrays([*[rows.column(b).take(owner) for b in by], *texts, pa.array(n, pa.int64())], names=[*by, "prev", "next", "n"])


def bigram_counts(corpus: DataFrame, *by: str, tasks: int | None = None) -> DataFrame:
    """Counts per pair, summed inside each task first, over blocks of texts; then in ``tasks`` by ``by``, if given."""
    slim = non_empty(corpus).select(*by, "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends = np.cumsum(pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False).astype(np.int64))
            first = 0
            while first < len(batch):
                before = ends[first - 1] if first else 0
                last = max(first + 1, int(np.searchsorted(ends, before + PAIR_BYTES, "right")))
                rows = batch.slice(first, last - first)
                texts = rows.column("text").to_pylist()
                codes = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32).astype(np.int64)
                yield _pair_counts(rows, by, codes, np.repeat(np.arange(len(texts)), [len(t) for t in texts]))
                first = last

    kinds = [slim.schema[b] for b in by] + [T.StructField(c, T.StringType()) for c in ("prev", "next")]
    counted = slim.mapInArrow(run, T.StructType([*kinds, T.StructField("n", T.LongType())]))
    if tasks:
        counted = counted.repartition(tasks, *by)
    return counted.groupBy(*by, "prev", "next").agg(F.sum("n").alias("n"))


def bigram_model(corpus: DataFrame) -> DataFrame:
    """P(next | prev). The window holds at most one row per pair of characters."""
    total = F.sum("n").over(W.partitionBy("prev"))
    return bigram_counts(corpus).withColumn("p", F.col("n") / total)


def _smoothed(pairs: DataFrame, train_counts: DataFrame, size: int, how_many: Column) -> DataFrame:
    """Attach -ln of the add-one probability to pair rows."""
    row_total = train_counts.groupBy("prev").agg(F.sum("n").alias("c_prev"))
    model = train_counts.withColumnRenamed("n", "c")
    seen = lookup_join(pairs, model, ["prev", "next"])
    placed_pairs = lookup_join(seen, row_total, ["prev"])
    p = (F.coalesce("c", F.lit(0)) + 1) / (F.coalesce("c_prev", F.lit(0)) + size)
    return placed_pairs.withColumn("weight", how_many).withColumn("nll", -F.ln(p))


def stream_bigram_counts(pieces: DataFrame) -> DataFrame:
    """Counts per split of all adjacent pairs of its stream, those across piece borders included.

    A border needs the ends of two pieces only, so one row per piece is put in order.
    """
    ends = pieces.select(
        "split", "spos", F.substring("text", 1, 1).alias("first"), F.expr("right(text, 1)").alias("last")
    )
    across = previous(ends, "spos", ["last"], ["split"]).where("prev_last IS NOT NULL")
    counted = across.groupBy("split", F.col("prev_last").alias("prev"), F.col("first").alias("next"))
    both = bigram_counts(pieces, "split").unionByName(counted.agg(F.count(F.lit(1)).alias("n")))
    return both.groupBy("split", "prev", "next").agg(F.sum("n").alias("n"))


def bigram_loss(pieces: DataFrame, size: int) -> DataFrame:
    """Mean cross-entropy of the next character per split, under add-one smoothed train counts.

    ``size`` is the number of symbols. Equal pairs are counted first, so the join runs on distinct
    pairs, not on tokens.
    """
    counts = materialize(stream_bigram_counts(pieces), "bigrams")
    train = counts.where(F.col("split") == "train").drop("split")
    rated = _smoothed(counts, train, size, F.col("n"))
    return rated.groupBy("split").agg(
        F.sum("weight").alias("n"),
        (F.sum(F.col("nll") * F.col("weight")) / F.sum("weight")).alias("loss"),
    )


def batch_losses(windows: DataFrame, train_counts: DataFrame, size: int, tasks: int | None = None) -> DataFrame:
    """Mean loss of every sampled batch under add-one smoothed train counts.

    The pairs of a batch meet in one of ``tasks``; only the losses, one row per batch, are written.
    """
    train = materialize(train_counts, "bigrams")
    rated = _smoothed(bigram_counts(windows, "split", "step", tasks=tasks), train, size, F.col("n"))
    mean = (F.sum(F.col("nll") * F.col("weight")) / F.sum("weight")).alias("batch_loss")
    return materialize(rated.groupBy("split", "step").agg(mean), "losses")


def sampled_loss(losses: DataFrame) -> DataFrame:
    """Mean over sampled batches of the batch loss, per split."""
    return losses.groupBy("split").agg(
        F.count(F.lit(1)).alias("n_batches"), F.avg("batch_loss").alias("loss")
    )


def topk_next(probs: DataFrame, k: int, temperature: float = 1.0) -> DataFrame:
    """Keep the k likeliest next symbols per context (ties stay), soften, normalise."""
    context = W.partitionBy("prev")
    best = (
        probs.withColumn("logit", F.ln("p") / temperature)
        .withColumn("rank", F.rank().over(context.orderBy(F.col("p").desc())))
        .where(F.col("rank") <= k)
    )
    weight = F.exp(F.col("logit") - F.max("logit").over(context))
    return best.withColumn("_w", weight).select(
        "prev", "next", (F.col("_w") / F.sum("_w").over(context)).alias("p")
    )


def sample_next(contexts: DataFrame, weights: DataFrame, seed: int = SEED) -> DataFrame:
    """Draw one next symbol for every row of ``contexts (id, prev)`` from ``weights (prev, next, n)``.

    Each context symbol has one row with its cumulative weights (at most one entry per symbol of
    the alphabet), so no context is joined to all its candidates.
    """
    upto = W.partitionBy("prev").orderBy("next").rowsBetween(W.unboundedPreceding, 0)
    wheel = (
        weights.withColumn("upto", F.sum("n").over(upto))
        .groupBy("prev")
        .agg(
            F.sort_array(F.collect_list(F.struct("upto", "next"))).alias("wheel"),
            F.sum("n").alias("total"),
        )
    )
    spin = hash_unit(F.col("id"), seed) * F.col("total")
    return (
        lookup_join(contexts, materialize(wheel, "wheel"), ["prev"], "inner")
        .withColumn("_spin", spin)
        .select(
            "id",
            "prev",
            F.expr("filter(wheel, w -> w.upto > _spin)[0].next").alias("next"),
        )
    )


def crop_context(ids: Column, block_size: int = BLOCK_SIZE) -> Column:
    """The last ``block_size`` ids."""
    return F.slice(ids, F.greatest(F.lit(1), F.size(ids) - block_size + 1), F.lit(block_size))


# --- words and vectors ----------------------------------------------------------------------------


def words(texts: DataFrame, *keys: str) -> DataFrame:
    """Whitespace-separated words with their position."""
    parts = F.filter(F.split("text", r"\s+"), lambda w: w != "")
    return texts.select(*keys, F.posexplode(parts).alias("pos", "word"))


def word_vocab(texts: DataFrame) -> DataFrame:
    """Words numbered from 0 in code-point order; the vocabulary may be of any size."""
    parts = F.array_distinct(F.filter(F.split("text", r"\s+"), lambda w: w != ""))
    return ranked_ids(texts.select(F.explode(parts).alias("word")).distinct(), "word", "id")


def word_tokens(texts: DataFrame, *keys: str) -> DataFrame:
    return lookup_join(words(texts, *keys), word_vocab(texts), ["word"])


def embedding_lookup(token_ids: DataFrame, embeddings: DataFrame) -> DataFrame:
    """Attach the vector of every token; an id that the table does not have gets null."""
    vectors = embeddings.select(
        F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("vector")
    )
    return lookup_join(token_ids, vectors, ["id"])


def positional_vector(pos: Column, width: int) -> Column:
    """Sine at even and cosine at odd dimensions of pos / 10000^(2 floor(i/2) / width)."""

    def one(i: Column) -> Column:
        angle = pos / F.pow(F.lit(10000.0), F.lit(2.0) * F.floor(i / 2) / width)
        return F.when(i % 2 == 0, F.sin(angle)).otherwise(F.cos(angle))

    return F.transform(F.sequence(F.lit(0), F.lit(width - 1)), one)


def positional_encoding(positions: DataFrame, width: int) -> DataFrame:
    """Long table (pos, dim, value) for a table of positions."""
    return positions.select(
        "pos", F.posexplode(positional_vector(F.col("pos"), width)).alias("dim", "value")
    )


def encoder_input(embedded: DataFrame, positions: DataFrame, width: int) -> DataFrame:
    """Token vector plus position vector, element by element.

    Vectors are worked out once for each row of ``positions (pos)`` and looked up. The caller takes the
    positions from the texts, so that the token vectors are not joined twice.
    """
    encoded = positions.withColumn("_place", positional_vector(F.col("pos"), width))
    return (
        param_join(embedded, encoded, ["pos"])
        .withColumn("vector", F.zip_with("vector", "_place", lambda a, b: a + b))
        .drop("_place")
    )


def pad_sequences(sequences: DataFrame, batch: str, pad: int = 0) -> DataFrame:
    """Right-pad ``ids`` to the longest sequence of the same batch."""
    longest = sequences.groupBy(batch).agg(F.max(F.size("ids")).alias("_len"))
    missing = F.col("_len") - F.size("ids")
    return (
        lookup_join(sequences, materialize(longest, "longest"), [batch])
        .withColumn("ids", F.concat("ids", F.array_repeat(F.lit(pad).cast("bigint"), missing)))
        .drop("_len")
    )
