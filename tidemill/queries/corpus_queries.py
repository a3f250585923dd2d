"""Named queries on the document and conversation corpora."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.operators import corpus as co
from tidemill.queries import checks as sql
from tidemill.queries.registry import query, r
from tidemill.sources import views

WIDTH = 64  # dimensions of the embedding table


def joined(column: str) -> Column:
    return F.array_join(F.col(column).cast("array<string>"), " ").alias(column)


CHARS = """
chars AS (
SELECT doc_id, unnest(string_split(text, '')) AS c, unnest(range(CAST(length(text) AS BIGINT))) AS p
FROM documents WHERE text <> ''),
vocab AS (SELECT c AS token, CAST(row_number() OVER (ORDER BY c) - 1 AS INT) AS id
FROM (SELECT DISTINCT c FROM chars))"""

STREAM = (
    CHARS
    + """,
total AS (SELECT CAST(count(*) AS BIGINT) AS n, CAST(floor(count(*) * 0.9::DOUBLE) AS BIGINT) AS cut FROM chars),
stream AS (
SELECT doc_id, p, c, id, CAST(row_number() OVER (ORDER BY doc_id, p) - 1 AS BIGINT) AS g
FROM chars JOIN vocab ON c = token),
split_stream AS (
SELECT *, CASE WHEN g < cut THEN 'train' ELSE 'val' END AS split,
  CASE WHEN g < cut THEN g ELSE g - cut END AS s,
  CASE WHEN g < cut THEN cut ELSE n - cut END AS m
FROM stream, total)"""
)

# span = 64 rows of 128 characters
BATCHES = (
    STREAM
    + """,
ahead AS (SELECT split, s, m, c, id, lead(id) OVER (PARTITION BY split ORDER BY s) AS next_id FROM split_stream),
batch_rows AS (
SELECT split, CAST(s // 8192 AS BIGINT) AS batch_id, CAST(s // 128 % 64 AS INT) AS row,
  string_agg(CAST(id AS VARCHAR), ' ' ORDER BY s) AS x,
  string_agg(CAST(next_id AS VARCHAR), ' ' ORDER BY s) AS y,
  string_agg(c, '' ORDER BY s) AS original_text
FROM ahead WHERE s // 8192 < ceil((m - 8192) / 8192.0) GROUP BY ALL)"""
)

WORDS = """
word_rows AS (
SELECT conv_id, turn, unnest(list_words) AS word, unnest(range(len(list_words))) AS pos
FROM (SELECT conv_id, turn, regexp_extract_all(text, '[^\\s]+') AS list_words FROM conversations)),
word_vocab AS (SELECT word, row_number() OVER (ORDER BY word) - 1 AS id FROM (SELECT DISTINCT word FROM word_rows)),
word_ids AS (SELECT conv_id, turn, CAST(pos AS INT) AS pos, word, id FROM word_rows JOIN word_vocab USING (word))"""

PAIR_COUNTS = """
pairs AS (
SELECT doc_id, split, s, c AS prev, lead(c) OVER (PARTITION BY split ORDER BY s) AS next FROM split_stream),
counts AS (SELECT prev, next, count(*) AS n FROM pairs WHERE split = 'train' AND next IS NOT NULL GROUP BY ALL),
row_totals AS (SELECT prev, sum(n) AS c_prev FROM counts GROUP BY prev)"""

PAIRS = f"{STREAM},{PAIR_COUNTS}"

DOC_PAIRS = (
    CHARS
    + """,
doc_pairs AS (
SELECT doc_id, prev, next FROM (
  SELECT doc_id, c AS prev, lead(c) OVER (PARTITION BY doc_id ORDER BY p) AS next FROM chars)
WHERE next IS NOT NULL),
pair_counts AS (SELECT prev, next, count(*) AS n FROM doc_pairs GROUP BY ALL),
model AS (SELECT prev, next, n, n / sum(n) OVER (PARTITION BY prev) AS p FROM pair_counts)"""
)


def _stream(spark, folder) -> tuple[DataFrame, DataFrame, co.SplitSizes]:
    corpus = views.corpus(spark, folder)
    sizes = co.split_sizes(corpus)
    return corpus, co.split_prefix(corpus, sizes), sizes


@query("build_vocab", f"WITH {CHARS} SELECT token, id FROM vocab")
def build_vocab(spark, folder):
    return co.build_vocab(views.corpus(spark, folder))


@query("vocab_size", f"WITH {CHARS} SELECT count(DISTINCT c) AS vocab_size FROM chars")
def vocab_size(spark, folder):
    return co.vocab_size(views.corpus(spark, folder))


@query(
    "encode",
    f"""WITH {CHARS}
SELECT d.doc_id, coalesce(e.ids, '') AS ids FROM documents d LEFT JOIN (
  SELECT doc_id, string_agg(CAST(id AS VARCHAR), ' ' ORDER BY p) AS ids
  FROM chars JOIN vocab ON c = token GROUP BY doc_id) e USING (doc_id)""",
)
def encode(spark, folder):
    corpus = views.corpus(spark, folder)
    return co.encode(corpus, co.build_vocab(corpus)).select("doc_id", joined("ids"))


@query("decode", "SELECT doc_id, text FROM documents")
def decode(spark, folder):
    corpus = views.corpus(spark, folder)
    vocab = co.build_vocab(corpus)
    return co.decode(co.encode(corpus, vocab), vocab)


@query("corpus_length", "SELECT CAST(sum(length(text)) AS BIGINT) AS n_chars FROM documents")
def corpus_length(spark, folder):
    return co.corpus_length(views.corpus(spark, folder))


@query(
    "global_position",
    f"""WITH {STREAM}
SELECT doc_id, min(g) AS first_pos, max(g) AS last_pos, CAST(sum(g) AS BIGINT) AS pos_sum,
  CAST(sum(g % 1000 * id) AS BIGINT) AS id_sum FROM stream GROUP BY doc_id""",
)
def global_position(spark, folder):
    corpus = views.corpus(spark, folder)
    long = co.global_position(corpus, co.build_vocab(corpus))
    return long.groupBy("doc_id").agg(
        F.min("gpos").alias("first_pos"),
        F.max("gpos").alias("last_pos"),
        F.sum("gpos").alias("pos_sum"),
        F.sum(F.col("gpos") % 1000 * F.col("id")).alias("id_sum"),
    )


@query(
    "split_prefix",
    f"""WITH {STREAM}
SELECT split, doc_id, min(s) AS spos, string_agg(c, '' ORDER BY s) AS text FROM split_stream GROUP BY ALL""",
)
def split_prefix(spark, folder):
    return _stream(spark, folder)[1]


@query(
    "split_stats",
    f"""WITH {STREAM}
SELECT split, count(*) AS n_tokens, (SELECT count(*) FROM vocab) AS vocab_size FROM split_stream GROUP BY split""",
)
def split_stats(spark, folder):
    return co.split_stats(_stream(spark, folder)[1])


def _batches(spark, folder, splits=co.SPLITS) -> DataFrame:
    corpus, pieces, sizes = _stream(spark, folder)
    return co.seq_batches(pieces, sizes, co.build_vocab(corpus), splits)


@query("seq_batches", f"WITH {BATCHES} SELECT split, batch_id, row, x, y FROM batch_rows")
def seq_batches(spark, folder):
    return _batches(spark, folder).select("split", "batch_id", "row", joined("x"), joined("y"))


@query("batch_text", f"WITH {BATCHES} SELECT split, batch_id, row, original_text FROM batch_rows")
def batch_text(spark, folder):
    return _batches(spark, folder).select("split", "batch_id", "row", "original_text")


@query(
    "batch_cursor",
    f"""WITH {BATCHES},
n_batches AS (SELECT count(DISTINCT batch_id) AS k FROM batch_rows WHERE split = 'val'),
requests AS (SELECT c_custkey AS step, c_custkey % k AS batch_id FROM customer, n_batches)
SELECT step, batch_id, row, original_text FROM requests JOIN batch_rows USING (batch_id) WHERE split = 'val'""",
)
def batch_cursor(spark, folder):
    """One validation batch for every customer in turn."""
    sizes = co.split_sizes(views.corpus(spark, folder))
    n_batches = co.batch_count(sizes.val, co.BATCH_SIZE * co.BLOCK_SIZE)
    batches = _batches(spark, folder, ["val"])
    requests = views.table(spark, folder, "customer").select(F.col("c_custkey").alias("step"))
    served = co.batch_cursor(batches, requests, n_batches)
    return served.select("step", "batch_id", "row", "original_text")


def _epoch(sizes: co.SplitSizes, split: str) -> int:
    """Steps that draw about as many characters as the split holds."""
    return sizes.of(split) // (co.BATCH_SIZE * co.BLOCK_SIZE)


SAMPLES = (
    STREAM
    + """,
sizes AS (SELECT split, any_value(m) AS m FROM split_stream GROUP BY split),
slots AS (SELECT split, m, unnest(range(m // 8192)) AS step FROM sizes),
drawn AS (
SELECT split, m, step, CAST(row AS INT) AS row,
  CAST(('0x' || substr(md5(concat(split, ':', step, ':', row, ':1337')), 1, 15)) AS BIGINT) % (m - 128) AS start
FROM slots, (SELECT unnest(range(64)) AS row)),
sampled AS (
SELECT d.split, d.step, d.row, d.start, d.start + o AS s
FROM drawn d, (SELECT unnest(range(129)) AS o)),
sampled_ids AS (
SELECT a.split, a.step, a.row, a.start, a.s, b.c, b.id FROM sampled a JOIN split_stream b ON a.split = b.split AND a.s = b.s)"""
)


def _windows(pieces, sizes) -> DataFrame:
    return co.sample_batches(pieces, sizes, {split: _epoch(sizes, split) for split in co.SPLITS})


@query(
    "sample_batches",
    f"""WITH {SAMPLES}
SELECT split, step, row, start, string_agg(CAST(id AS VARCHAR), ' ' ORDER BY s) FILTER (s < start + 128) AS x,
  string_agg(CAST(id AS VARCHAR), ' ' ORDER BY s) FILTER (s > start) AS y
FROM sampled_ids GROUP BY ALL""",
)
def sample_batches(spark, folder):
    corpus, pieces, sizes = _stream(spark, folder)
    drawn = co.with_xy(_windows(pieces, sizes), co.build_vocab(corpus))
    return drawn.select("split", "step", "row", "start", joined("x"), joined("y"))


@query(
    "bigram_pairs",
    f"""WITH {CHARS},
ordered AS (SELECT doc_id, p, c, lead(c) OVER (PARTITION BY doc_id ORDER BY p) AS d FROM chars)
SELECT doc_id, count(*) AS n_pairs, CAST(sum((p + 1) * unicode(c)) AS BIGINT) AS prev_sum,
  CAST(sum((p + 1) * unicode(d)) AS BIGINT) AS next_sum, count(DISTINCT c || d) AS n_distinct
FROM ordered WHERE d IS NOT NULL GROUP BY doc_id""",
)
def bigram_pairs(spark, folder):
    """Every pair with its position, summed up per document."""
    pairs = co.bigram_pairs(views.corpus(spark, folder), "doc_id")
    place = F.col("pos").cast("bigint") + 1
    per_pair = pairs.groupBy("doc_id", "pair").agg(
        F.count(F.lit(1)).alias("n"), F.sum(place).alias("places")
    )
    return per_pair.groupBy("doc_id").agg(
        F.sum("n").alias("n_pairs"),
        F.sum(F.col("places") * F.ascii("pair")).alias("prev_sum"),
        F.sum(F.col("places") * F.ascii(F.substring("pair", 2, 1))).alias("next_sum"),
        F.count(F.lit(1)).alias("n_distinct"),
    )


@query("bigram_model", f"WITH {DOC_PAIRS} SELECT prev, next, n, round(p, 9) AS p FROM model")
def bigram_model(spark, folder):
    return co.bigram_model(views.corpus(spark, folder)).select("prev", "next", "n", r("p", 9))


@query(
    "bigram_loss",
    f"""WITH {PAIRS}
SELECT split, count(*) AS n,
  round(avg(-ln((coalesce(n, 0) + 1) / (coalesce(c_prev, 0) + (SELECT count(*) FROM vocab)))), 6) AS loss
FROM pairs LEFT JOIN counts USING (prev, next) LEFT JOIN row_totals USING (prev)
WHERE next IS NOT NULL GROUP BY split""",
)
def bigram_loss(spark, folder):
    corpus, pieces, _ = _stream(spark, folder)
    size = co.vocab_size(corpus).first()["vocab_size"]
    return co.bigram_loss(pieces, size).select("split", "n", r("loss"))


@query(
    "sampled_loss",
    f"""WITH {SAMPLES},
{PAIR_COUNTS},
drawn_pairs AS (
SELECT split, step, c AS prev, lead(c) OVER (PARTITION BY split, step, row ORDER BY s) AS next FROM sampled_ids),
per_batch AS (
SELECT split, step,
  avg(-ln((coalesce(n, 0) + 1) / (coalesce(c_prev, 0) + (SELECT count(*) FROM vocab)))) AS batch_loss
FROM drawn_pairs LEFT JOIN counts USING (prev, next) LEFT JOIN row_totals USING (prev)
WHERE next IS NOT NULL GROUP BY ALL)
SELECT split, count(*) AS n_batches, round(avg(batch_loss), 6) AS loss FROM per_batch GROUP BY split""",
)
def sampled_loss(spark, folder):
    return co.sampled_loss(batch_losses(spark, folder)).select("split", "n_batches", r("loss"))


def batch_losses(spark, folder) -> DataFrame:
    corpus, pieces, sizes = _stream(spark, folder)
    size = co.vocab_size(corpus).first()["vocab_size"]
    train = co.stream_bigram_counts(pieces.where(F.col("split") == "train")).drop("split")
    drawn = sum(_epoch(sizes, split) for split in co.SPLITS) * co.BATCH_SIZE * (co.BLOCK_SIZE + 1)
    return co.batch_losses(_windows(pieces, sizes), train, size, co.window_tasks(spark, drawn))


@query(
    "topk_next",
    f"""WITH {DOC_PAIRS},
best AS (SELECT *, rank() OVER (PARTITION BY prev ORDER BY p DESC) AS place FROM model),
powered AS (SELECT prev, next, pow(p, 1 / 0.8) AS w FROM best WHERE place <= 5)
SELECT prev, next, round(w / sum(w) OVER (PARTITION BY prev), 6) AS p FROM powered""",
)
def topk_next(spark, folder):
    model = co.bigram_model(views.corpus(spark, folder))
    return co.topk_next(model, 5, 0.8).select("prev", "next", r("p"))


@query(
    "sample_next",
    f"""WITH {DOC_PAIRS},
ends AS (SELECT doc_id AS id, right(text, 1) AS prev FROM documents WHERE text <> ''),
wheel AS (
SELECT prev, next, sum(n) OVER (PARTITION BY prev ORDER BY next) AS upto, sum(n) OVER (PARTITION BY prev) AS total
FROM pair_counts)
SELECT id, prev, min_by(next, upto) AS next FROM ends JOIN wheel USING (prev)
WHERE upto > {sql.draw("id", 1337)} / 4294967296.0::DOUBLE * total GROUP BY id, prev""",
)
def sample_next(spark, folder):
    corpus = views.corpus(spark, folder)
    ends = co.non_empty(corpus).select(
        F.col("doc_id").alias("id"), F.expr("right(text, 1)").alias("prev")
    )
    return co.sample_next(ends, co.bigram_counts(corpus))


@query(
    "crop_context",
    f"""WITH {CHARS}
SELECT doc_id, string_agg(CAST(id AS VARCHAR), ' ' ORDER BY p) AS ids
FROM (SELECT *, max(p) OVER (PARTITION BY doc_id) AS last_p FROM chars) JOIN vocab ON c = token
WHERE p > last_p - 128 GROUP BY doc_id""",
)
def crop_context(spark, folder):
    corpus = co.non_empty(views.corpus(spark, folder))
    tail = corpus.select("doc_id", F.expr(f"right(text, {co.BLOCK_SIZE})").alias("text"))
    encoded = co.encode(tail, co.build_vocab(corpus))
    return encoded.withColumn("ids", co.crop_context(F.col("ids"))).select("doc_id", joined("ids"))


def _word_ids(spark, folder) -> DataFrame:
    return co.word_tokens(views.conversations(spark, folder), "conv_id", "turn")


@query("word_tokens", f"WITH {WORDS} SELECT conv_id, turn, pos, word, id FROM word_ids")
def word_tokens(spark, folder):
    return _word_ids(spark, folder)


def _wrapped_ids(spark, folder, vectors: DataFrame) -> DataFrame:
    """Word ids modulo the size of the vector table, which has fewer rows than there are words."""
    size = vectors.agg(F.count(F.lit(1)).alias("n")).scalar()
    return _word_ids(spark, folder).withColumn("id", F.pmod("id", size))


def _vector_check(df: DataFrame) -> DataFrame:
    """Whole vectors reduced to a sum weighted by dimension, plus both ends."""
    weighted = F.zip_with(
        "vector", F.sequence(F.lit(1), F.lit(WIDTH)), lambda v, i: v * i.cast("double")
    )
    return df.select(
        "conv_id",
        "turn",
        "pos",
        F.round(F.element_at("vector", 1), 6).alias("first"),
        F.round(F.element_at("vector", -1), 6).alias("last"),
        F.round(F.aggregate(weighted, F.lit(0.0), lambda a, b: a + b), 6).alias("total"),
    )


@query(
    "embedding_lookup",
    f"""WITH {WORDS},
dims AS (SELECT vec_id, CAST(unnest(embedding) AS DOUBLE) AS v, unnest(range(len(embedding))) AS i FROM embeddings),
sums AS (SELECT vec_id, round(max(v) FILTER (i = 0), 6) + 0.0 AS first, round(max(v) FILTER (i = 63), 6) + 0.0 AS last,
  round(sum(v * (i + 1)), 6) + 0.0 AS total FROM dims GROUP BY vec_id)
SELECT conv_id, turn, pos, first, last, total
FROM word_ids JOIN sums ON vec_id = id % (SELECT count(*) FROM embeddings)""",
)
def embedding_lookup(spark, folder):
    vectors = views.table(spark, folder, "embeddings")
    return _vector_check(co.embedding_lookup(_wrapped_ids(spark, folder, vectors), vectors))


@query(
    "positional_encoding",
    f"""WITH {WORDS},
grid AS (SELECT DISTINCT pos, CAST(i AS INT) AS dim FROM word_rows, (SELECT unnest(range(64)) AS i))
SELECT CAST(pos AS INT) AS pos, dim,
  round(CASE WHEN dim % 2 = 0 THEN sin(pos / pow(10000, 2 * (dim // 2) / 64.0::DOUBLE))
    ELSE cos(pos / pow(10000, 2 * (dim // 2) / 64.0::DOUBLE)) END, 9) + 0.0 AS value FROM grid""",
)
def positional_encoding(spark, folder):
    words = co.words(views.conversations(spark, folder), "conv_id", "turn")
    table = co.positional_encoding(words.select("pos").distinct(), WIDTH)
    return table.select("pos", "dim", r("value", 9))


@query(
    "encoder_input",
    f"""WITH {WORDS},
dims AS (SELECT vec_id, CAST(unnest(embedding) AS DOUBLE) AS v, unnest(range(len(embedding))) AS i FROM embeddings),
inputs AS (
SELECT conv_id, turn, pos, i, v + CASE WHEN i % 2 = 0 THEN sin(pos / pow(10000, 2 * (i // 2) / 64.0::DOUBLE))
  ELSE cos(pos / pow(10000, 2 * (i // 2) / 64.0::DOUBLE)) END AS v
FROM word_ids JOIN dims ON vec_id = id % (SELECT count(*) FROM embeddings))
SELECT conv_id, turn, pos, round(max(v) FILTER (i = 0), 6) + 0.0 AS first,
  round(max(v) FILTER (i = 63), 6) + 0.0 AS last, round(sum(v * (i + 1)), 6) + 0.0 AS total
FROM inputs GROUP BY ALL""",
)
def encoder_input(spark, folder):
    vectors = views.table(spark, folder, "embeddings")
    embedded = co.embedding_lookup(_wrapped_ids(spark, folder, vectors), vectors)
    positions = co.words(views.conversations(spark, folder)).select("pos").distinct()
    return _vector_check(co.encoder_input(embedded, positions, WIDTH))


@query(
    "pad_sequences",
    f"""WITH {WORDS},
turns AS (SELECT conv_id, turn, string_agg(CAST(id AS VARCHAR), ' ' ORDER BY pos) AS ids, count(*) AS k
FROM word_ids GROUP BY ALL)
SELECT conv_id, turn, ids || repeat(' 0', max(k) OVER (PARTITION BY conv_id) - k) AS ids FROM turns""",
)
def pad_sequences(spark, folder):
    turns = (
        _word_ids(spark, folder)
        .groupBy("conv_id", "turn")
        .agg(F.sort_array(F.collect_list(F.struct("pos", "id"))).alias("_p"))
        .select("conv_id", "turn", F.transform("_p", lambda p: p["id"]).alias("ids"))
    )
    return co.pad_sequences(turns, "conv_id").select("conv_id", "turn", joined("ids"))
