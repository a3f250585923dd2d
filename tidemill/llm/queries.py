"""The named queries of this subpackage and the SQL that checks them."""

from __future__ import annotations

import re
from collections.abc import Callable
from pathlib import Path

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm import byte_bpe, byte_cnn, chat_format, conversation_repair, html_extract, katz, language_id, line_cleaning, merkle, mixing, near_dedup, substring_dedup, topk_search
from tidemill.llm.common import id_remainder

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle.strip()
        return fn

    return register


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _quoted(values: tuple[str, ...]) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


_R = line_cleaning.LineRules()
_MARK_CLASS = "[" + "".join("\\" + c for c in line_cleaning.MARKS) + "]"
LINE_CLEANING_SQL = rf"""
WITH d AS (SELECT rowid AS rid, doc_id, coalesce(text, '') AS text FROM (SELECT row_number() OVER () AS rowid, * FROM documents)),
w AS (SELECT rid, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM d),
win AS (SELECT rid, i, array_to_string(ws[i:i+{_R.window - 1}], ' ') AS v
        FROM w, unnest(range(1, len(ws) - {_R.window - 2})) AS t(i)),
rep AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, v) AS n FROM win) WHERE n > 1),
cov AS (SELECT rid, count(DISTINCT i + k) AS n FROM rep, range({_R.window}) AS r(k) GROUP BY rid),
l0 AS (SELECT rid, n, line FROM (SELECT rid, unnest(string_split(text, chr(10))) AS line,
       generate_subscripts(string_split(text, chr(10)), 1) AS n FROM d)),
l1 AS (SELECT rid, n, line, regexp_extract_all(line, '[^\x20\x09-\x0D]+') AS ws FROM l0),
l2 AS (SELECT rid, n, line, len(ws) AS nw, length(array_to_string(ws, '')) AS chars,
       length(line) - length(regexp_replace(line, '{_MARK_CLASS}', '', 'g')) AS marks,
       len(list_filter(ws, lambda x: x IN ({_quoted(line_cleaning.SEPARATORS)}))) AS seps,
       row_number() OVER (PARTITION BY rid, line ORDER BY n) > 1 AS again
       FROM l1 WHERE len(ws) > 0),
l3 AS (SELECT *, 1000 * marks > {_R.marks_per_1000} * chars
       OR (nw < {_R.short_line} AND NOT regexp_matches(line, '{line_cleaning.SENTENCE_END.replace("'", "''")}'))
       OR (seps >= {_R.min_separators} AND 1000 * seps >= {_R.separators_per_1000} * nw)
       OR regexp_matches(line, '(?i){"|".join(line_cleaning.PHRASES)}') AS bad FROM l2),
s AS (SELECT rid, count(*) AS n_lines, count(*) FILTER (bad) AS n_failed_lines, count(*) FILTER (again) AS n_dup,
      sum(chars) AS chars, coalesce(sum(chars) FILTER (bad), 0) AS lost FROM l3 GROUP BY rid),
j AS (SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(chars, 0) AS BIGINT) AS word_chars,
      CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
      CAST(coalesce(n_dup, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(cov.n, 0) AS BIGINT) AS n_repeat_words,
      CAST(coalesce(n_lines, 0) AS BIGINT) AS n_lines, CAST(coalesce(n_failed_lines, 0) AS BIGINT) AS n_failed_lines,
      CAST(coalesce(lost, 0) AS BIGINT) AS lost_chars
      FROM d JOIN w USING (rid) LEFT JOIN s USING (rid) LEFT JOIN cov USING (rid)),
f AS (SELECT *, n_words < {_R.min_words} OR 100 * n_repeat_words > {_R.repeat_percent} * n_words AS base_failed FROM j)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND 1000 * lost_chars <= {_R.lost_per_1000} * word_chars AS kept, n_lines, n_failed_lines, lost_chars
FROM f
"""


@query("op10_line_cleaning", LINE_CLEANING_SQL)
def op10_line_cleaning(spark: SparkSession, folder: str) -> DataFrame:
    return line_cleaning.line_cleaning(read(spark, folder, "documents")).drop("clean_text")


MIXING_SQL = """
WITH d AS (SELECT *, coalesce('s' || source, 'null') AS k FROM documents),
s AS (SELECT k, CAST(sum(coalesce(length(text), 0)) AS DOUBLE) AS chars FROM d GROUP BY k),
r AS (SELECT k, CASE WHEN chars > 0 THEN pow(chars, 0.5) / (SELECT sum(pow(chars, 0.5)) FROM s) * (SELECT sum(chars) FROM s) / chars
      ELSE 1.0 END AS rate FROM s),
p AS (SELECT k, rate, n, exp(-rate) * pow(rate, n) / gamma(n + 1.0) AS mass FROM r, range(0, 150) AS t(n)),
c AS (SELECT k, rate, n, sum(mass) OVER (PARTITION BY k ORDER BY n) AS cdf FROM p),
u AS (SELECT *, CAST(CAST('0x' || substr(md5('42:' || doc_id || ':1'), 1, 13) AS BIGINT) AS DOUBLE) / 4503599627370496.0 AS u FROM d),
n AS (SELECT u.doc_id, u.text, u.lang, u.source, u.n_chars, any_value(c.rate) AS rate, CAST(count(*) FILTER (c.cdf <= u.u) AS INTEGER) AS copies
      FROM u JOIN c USING (k) GROUP BY ALL)
SELECT doc_id, text, lang, source, n_chars, round(rate, 9) AS rate, copies, CAST(i AS INTEGER) AS copy,
       substr(md5('order:42:' || doc_id || ':' || i), 1, 16) AS shuffle_key
FROM n, range(0, copies) AS t(i)
"""


@query("op8_poisson_mix", MIXING_SQL)
def op8_poisson_mix(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.poisson_mix(read(spark, folder, "documents"))
    return mixed.withColumn("rate", F.round("rate", 9))


def held_out(modulus: int, remainder: int) -> Column:
    return (id_remainder("doc_id", modulus) == remainder).alias("held_out")


@query("op1_byte_cnn_quality")
def op1_byte_cnn_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Trained on labelled documents outside the held-out quarter; scores all."""
    docs = read(spark, folder, "documents")
    net = byte_cnn.fit(docs.where(~held_out(4, 2)), read(spark, folder, "labels"))
    return byte_cnn.score(docs.select("doc_id", "text"), net).select("doc_id", held_out(4, 2), "score", "predicted")


@query("op2_language_id")
def op2_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """Trained on documents with a language outside the held-out third; predicts all."""
    docs = read(spark, folder, "documents")
    model = language_id.fit(docs.where(~held_out(3, 1)))
    return language_id.identify(docs.select("doc_id", "text"), model).select("doc_id", held_out(3, 1), "lang_pred", "score")


def bpe_ranks() -> bytes:
    """Content of the public rank file that goes with the pattern of `byte_bpe`."""
    return Path(public_tokenizers.path("byte_bpe_50k.tiktoken")).read_bytes()


def bpe_digests(docs: DataFrame) -> DataFrame:
    ranks = bpe_ranks()
    return byte_bpe.round_trip(docs, ranks).select(
        "doc_id",
        F.size("tokens").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join("tokens", " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query("op5_byte_bpe")
def op5_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe_digests(read(spark, folder, "documents"))


@query("op9_minhash_dedup")
def op9_minhash_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_dedup.near_duplicates(read(spark, folder, "documents"))


TOPK_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS q FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
e AS (SELECT vec_id, unnest(q) AS x, generate_subscripts(q, 1) AS d FROM v),
s AS (SELECT a.vec_id AS query_id, b.vec_id, CAST(sum(a.x * b.x) AS BIGINT) AS score
      FROM e a JOIN e b ON a.d = b.d AND a.vec_id % 20 = 0 AND a.vec_id <> b.vec_id GROUP BY ALL),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""


@query("op3_topk_search", TOPK_SQL)
def op3_topk_search(spark: SparkSession, folder: str) -> DataFrame:
    return topk_search.top_k(read(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0, 20)


CHAT_SQL = r"""
WITH c AS (SELECT conv_id, turn, role, text, len(regexp_extract_all(text, '[^ \n]+')) AS words FROM conversations),
calls AS (SELECT conv_id, turn, conv_id || '-' || turn AS call_id, text, words FROM c WHERE role = 'user'),
results AS (SELECT conv_id, turn, conv_id || '-' || (turn - 1) AS call_id, text FROM c WHERE role = 'assistant'),
e AS (
  SELECT conv_id, 2 * turn AS place, 0 AS step, 'message' AS kind, NULL AS call_id, NULL AS name, 'plain' AS status, '' AS errors,
         '{"content":' || to_json(text) || ',"role":' || to_json(role) || '}' AS json FROM c WHERE role <> 'assistant'
  UNION ALL
  SELECT conv_id, 2 * turn + 1, 1, 'call', call_id, 'answer',
         CASE WHEN EXISTS (SELECT 1 FROM results r WHERE r.conv_id = calls.conv_id AND r.call_id = calls.call_id) THEN 'answered' ELSE 'open' END,
         concat_ws('; ', CASE WHEN length(text) < 1 THEN 'question is too short' END, CASE WHEN length(text) > 1000 THEN 'question is too long' END,
                   CASE WHEN words < 1 THEN 'words is too small' END, CASE WHEN words > 200 THEN 'words is too large' END),
         '{"arguments":{"question":' || to_json(text) || ',"words":' || words || '},"id":"' || call_id || '","name":"answer","role":"assistant"}' FROM calls
  UNION ALL
  SELECT conv_id, 2 * turn, 0, 'result', call_id, NULL,
         CASE WHEN EXISTS (SELECT 1 FROM calls q WHERE q.conv_id = r.conv_id AND q.call_id = r.call_id) THEN 'linked' ELSE 'orphan' END, '',
         '{"content":' || to_json(text) || ',"role":"tool","tool_call_id":"' || call_id || '"}' FROM results r)
SELECT conv_id, CAST(place AS BIGINT) AS place, step, kind, call_id, name, status, errors, json FROM e
"""


@query("op7_chat_format", CHAT_SQL)
def op7_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    """Conversations as tool calls and results, linked, ordered, validated and written as JSON."""
    messages = chat_format.as_tool_messages(read(spark, folder, "conversations"))
    return chat_format.format_chat(messages, chat_format.ANSWER_SCHEMA).withColumn("errors", F.array_join("errors", "; "))


@query("op4_html_extract")
def op4_html_extract(spark: SparkSession, folder: str) -> DataFrame:
    found = html_extract.extract(read(spark, folder, "pages"))
    return found.withColumn("n_chars", F.char_length("text").cast("bigint"))


@query("op6_katz_scores")
def op6_katz_scores(spark: SparkSession, folder: str) -> DataFrame:
    return katz.katz_scores(read(spark, folder, "documents"), held_out(7, 2))


MERKLE_SQL = """
WITH RECURSIVE d AS (SELECT row_number() OVER () AS rid, *, coalesce('s' || source, '') AS k FROM documents),
c AS (SELECT *, text IS NOT NULL AND xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT),
        list_transform(range(1, length(CAST(doc_id AS VARCHAR)) + 1), lambda i: CAST(ascii(CAST(doc_id AS VARCHAR)[i]) AS BIGINT))),
        lambda a, b: list_reduce(list_prepend(xor(a, b), [CAST(0 AS BIGINT) FOR z IN range(8)]),
                                 lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)), 4294967295) % 2 = 0 AS odd
      FROM d),
h AS (SELECT rid, doc_id, k, sha256(start || body(text)) AS leaf, sha256(start || body(now)) AS found
      FROM (SELECT rid, doc_id, k, text, CASE WHEN odd THEN replace(text, chr(10), '') ELSE text END AS now,
                   body(CAST(doc_id AS VARCHAR)) || body(source) || body(lang) || body(CAST(n_chars AS VARCHAR)) AS start FROM c)),
l AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM h),
t(k, level, i, digest) AS (
  SELECT k, 0, i, leaf FROM l
  UNION ALL
  SELECT k, level + 1, i // 3, sha256(string_agg(digest, '' ORDER BY i))
  FROM (SELECT *, count(*) OVER (PARTITION BY k) AS n FROM t) WHERE n > 1 GROUP BY k, level, i // 3),
r AS (SELECT k, max_by(digest, level) AS subroot, max(level) AS top FROM t GROUP BY k),
u(level, i, digest) AS (
  SELECT 0, row_number() OVER (ORDER BY k) - 1, subroot FROM r
  UNION ALL
  SELECT level + 1, i // 3, sha256(string_agg(digest, '' ORDER BY i)) FROM (SELECT *, count(*) OVER () AS n FROM u) WHERE n > 1 GROUP BY level, i // 3),
nodes AS (SELECT k, level, i, digest, top FROM t JOIN r USING (k)
          UNION ALL SELECT 'top', level, i, digest, (SELECT max(level) FROM u) FROM u),
s AS (SELECT a.k, a.level, a.i, coalesce(string_agg(b.digest, '' ORDER BY b.i) FILTER (b.i < a.i), '') AS lft,
             coalesce(string_agg(b.digest, '' ORDER BY b.i) FILTER (b.i > a.i), '') AS rgt
      FROM nodes a JOIN nodes b ON a.k = b.k AND a.level = b.level AND a.i // 3 = b.i // 3 AND a.level < a.top GROUP BY ALL),
f(rid, k, level, i, node, sibs) AS (
  SELECT rid, k, 0, i, found, '' FROM l
  UNION ALL
  SELECT rid, f.k, f.level + 1, f.i // 3, sha256(lft || node || rgt), sibs || lft || rgt FROM f JOIN s ON f.k = s.k AND f.level = s.level AND f.i = s.i),
m AS (SELECT rid, k, max_by(node, level) AS node, max_by(sibs, level) AS sibs FROM f GROUP BY rid, k),
g(rid, level, i, node, sibs) AS (
  SELECT rid, 0, x.i, node, sibs FROM m JOIN (SELECT k, row_number() OVER (ORDER BY k) - 1 AS i FROM r) x USING (k)
  UNION ALL
  SELECT rid, g.level + 1, g.i // 3, sha256(lft || node || rgt), sibs || lft || rgt FROM g JOIN s ON s.k = 'top' AND g.level = s.level AND g.i = s.i),
e AS (SELECT rid, max_by(node, level) AS folded, max_by(sibs, level) AS sibs FROM g GROUP BY rid),
o AS (SELECT max_by(digest, level) AS root FROM u)
SELECT doc_id, leaf, subroot, root, sha256(sibs) AS proof_sha256, folded AS folded_root, folded = root AS verified
FROM l JOIN r USING (k) JOIN e USING (rid), o
"""


@query("op12_merkle_manifest", re.sub(r"body\(((?:[^()]|\([^()]*\))*)\)", r"coalesce(strlen(\1) || ':' || \1, '-')", MERKLE_SQL))
def op12_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """Every document checked against the manifest; where 2 divides the CRC-32 of the id, its line feeds are gone when found."""
    docs = read(spark, folder, "documents")
    altered = (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0) & F.col("text").contains("\n")
    found = F.when(altered, F.replace("text", F.lit("\n"), F.lit("")))
    return merkle.verified(merkle.build(merkle.document_leaves(docs, found)))


SUBSTRING_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
w AS (SELECT rid, doc_id, i, array_to_string(ws[i:i+12], ' ') AS v FROM d, unnest(range(1, len(ws) - 11)) AS t(i) WHERE doc_id IS NOT NULL),
m AS (SELECT rid, i FROM (SELECT rid, i, doc_id, min(doc_id) OVER (PARTITION BY v) AS least FROM w) WHERE least < doc_id),
r AS (SELECT rid, list(DISTINCT i + k) AS gone FROM m, range(13) AS t(k) GROUP BY rid)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(len(gone), 0) AS BIGINT) AS n_removed,
       sha256(CASE WHEN gone IS NULL THEN array_to_string(ws, ' ')
              ELSE array_to_string([ws[j] FOR j IN range(1, len(ws) + 1) IF NOT list_contains(gone, j)], ' ') END) AS kept_sha256
FROM d LEFT JOIN r USING (rid)
"""


@query("op13_substring_dedup", SUBSTRING_SQL)
def op13_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    kept = substring_dedup.substring_dedup(read(spark, folder, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@query("op11_conversation_repair")
def op11_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    return conversation_repair.repaired_conversations(conversation_repair.damaged(read(spark, folder, "conversations")))
