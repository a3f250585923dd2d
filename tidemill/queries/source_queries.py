"""Named queries that write tables with a sink and read them back with a source."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.operators import evaluate as ev
from tidemill.operators import trends
from tidemill.operators.features import split_random
from tidemill.plans import lookup_join, prefix_sum
from tidemill.plans.scratch import materialize, scratch_path
from tidemill.queries import checks as sql
from tidemill.queries.registry import query, r
from tidemill.queries.trend_queries import DAY
from tidemill.sources import readers, views, writers


FILE_BYTES = 32_000_000  # a file is read as one value


@query(
    "src_text",
    """SELECT lang, CAST(sum(length(text) + 1) AS BIGINT) AS n_chars,
  CAST(sum(length(text) - length(replace(text, chr(10), '')) + 1) AS BIGINT) AS n_lines FROM documents GROUP BY lang""",
)
def src_text(spark, folder):
    """Documents written as text files per language, of bounded bytes unless one document is longer, then read as whole files."""
    path = scratch_path(spark, "texts")
    docs = views.table(spark, folder, "documents").select("doc_id", "lang", "text")
    sizes = docs.select("doc_id", (F.octet_length("text") + 1).cast("bigint").alias("n"))
    place = F.floor((F.col("cum_n") - F.col("n")) / FILE_BYTES).alias("file")
    files = materialize(prefix_sum(sizes, "doc_id", ["n"]).select("doc_id", place), "files")
    placed = lookup_join(docs, files, ["doc_id"], "inner").select("lang", "file", "text")
    placed.repartition("lang", "file").write.partitionBy("lang", "file").text(path)
    files = readers.read_corpus(spark, f"{path}/*/*/*.txt")
    lang = F.regexp_extract("path", "lang=([^/]+)/", 1)
    lines = F.char_length("text") - F.char_length(F.replace("text", F.lit("\n")))
    return files.groupBy(lang.alias("lang")).agg(
        F.sum(F.char_length("text")).cast("bigint").alias("n_chars"),
        F.sum(lines).cast("bigint").alias("n_lines"),
    )


@query(
    "src_csv",
    f"""WITH {sql.PASSENGERS}
SELECT passenger_id, survived, pclass, name, sex, age, sibsp, parch, ticket, round(fare, 6) AS fare, cabin, embarked
FROM passengers""",
)
def src_csv(spark, folder):
    path = scratch_path(spark, "passengers-csv")
    columns = [c.split()[0] for c in readers.PASSENGER_SCHEMA.split(", ")]
    columns = [c.strip() for c in columns]
    views.passengers(spark, folder).select(*columns).write.csv(path, header=True, escape='"')
    good, _ = readers.read_csv(spark, path, readers.PASSENGER_SCHEMA)
    return good.withColumn("fare", r("fare"))


@query(
    "src_json_docs",
    f"""WITH {sql.TRIALS}
SELECT 'run-' || study || '-' || trial AS output_dir, CAST(100 + trial AS INT) AS steps,
  CAST(max_depth AS INT) AS n_layer, round(learning_rate, 9) AS learning_rate, CAST(model_kb AS INT) AS vocab_size,
  CAST(trial * 900 AS BIGINT) AS train_tokens FROM trials""",
)
def src_json_docs(spark, folder):
    """Run documents, half of them with the older name of the step count."""
    path = scratch_path(spark, "runs")
    steps = (F.col("trial") + 100).cast("int")
    even = F.col("trial") % 2 == 0
    views.trials(spark, folder).select(
        F.struct(
            F.when(even, steps).alias("max_iters"),
            F.when(~even, steps).alias("max_epochs"),
            "learning_rate",
            F.col("max_depth").cast("int").alias("n_layer"),
        ).alias("train_config"),
        F.format_string("run-%d-%d", "study", "trial").alias("output_dir"),
        F.col("model_kb").alias("vocab_size"),
        (F.col("trial") * 900).alias("train_tokens"),
    ).write.json(path)
    return readers.read_runs(spark, path, multi_line=False).select(
        "output_dir",
        "steps",
        F.col("train_config.n_layer").alias("n_layer"),
        F.round("train_config.learning_rate", 9).alias("learning_rate"),
        "vocab_size",
        "train_tokens",
    )


@query(
    "src_replay",
    f"""WITH {sql.POSTS}
SELECT post_id, user_id, text, lang, round(sentiment, 6) AS sentiment FROM posts WHERE post_id % 50 <> 0""",
)
def src_replay(spark, folder):
    """Retained raw records read again from the start."""
    path = scratch_path(spark, "bronze")
    views.raw_messages(views.posts(spark, folder)).write.parquet(path)
    retained = spark.read.schema(readers.TOPIC_SCHEMA).parquet(path)
    good, _ = trends.parse_posts(retained)
    return good.select("post_id", "user_id", "text", "lang", r("sentiment"))


@query(
    "snk_topic",
    f"""WITH {sql.SCORED}
SELECT hashtag AS key, hashtag, n, round(zscore, 6) AS zscore FROM scored WHERE zscore >= 3""",
)
def snk_topic(spark, folder):
    """Alerts published under their tag and parsed again."""
    path = scratch_path(spark, "alerts-topic")
    alerts = trends.trend_alerts(views.posts(spark, folder), DAY)
    writers.write_topic_files(alerts, F.col("hashtag"), path)
    parsed = F.from_json("value", "hashtag string, n bigint, zscore double")
    return (
        spark.read.schema("key string, value string")
        .parquet(path)
        .select("key", parsed.alias("v"))
        .select("key", "v.hashtag", "v.n", F.round("v.zscore", 6).alias("zscore"))
    )


@query(
    "snk_json",
    f"""WITH {sql.PREDICTIONS},
m AS (SELECT model, count(*) AS n, round(avg(label), 6) AS rate FROM
  (SELECT label, CASE WHEN passenger_id % 2 = 0 THEN 'v1' ELSE 'v2' END AS model FROM predictions) GROUP BY model)
SELECT 'json' AS kind, model, n, rate, '7' AS version FROM m UNION ALL SELECT 'csv', model, n, rate, '7' FROM m""",
)
def snk_json(spark, folder):
    """Metrics exported as JSON and CSV below a version path, read back from both."""
    model = F.when(F.col("passenger_id") % 2 == 0, "v1").otherwise("v2").alias("model")
    metrics = (
        views.predictions(spark, folder)
        .groupBy(model)
        .agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("label"), 6).alias("rate"))
    )
    base = scratch_path(spark, "metrics")
    paths = writers.export_metrics(metrics, base, "7", "2024-01-31T00:00:00")
    schema = "model string, n bigint, rate double, version string, exported_at string"
    found = spark.read.schema(schema).json(paths["json"]).withColumn("kind", F.lit("json"))
    found = found.unionByName(
        spark.read.csv(paths["csv"], schema=schema, header=True).withColumn("kind", F.lit("csv"))
    )
    return found.select("kind", "model", "n", "rate", "version")


@query(
    "snk_processed",
    f"""WITH {sql.PASSENGERS}
SELECT CASE WHEN {sql.bucket("passenger_id", 42, 100)} < 80 THEN 'train' ELSE 'test' END AS split,
  passenger_id, survived, pclass FROM passengers""",
)
def snk_processed(spark, folder):
    path = scratch_path(spark, "processed")
    rows = split_random(views.passengers(spark, folder), "passenger_id")
    writers.write_processed(rows.select("passenger_id", "survived", "pclass", "split"), path)
    schema = "passenger_id bigint, survived int, pclass int, split string"
    return spark.read.schema(schema).parquet(path)


BLOCK_BYTES, FANOUT = 4096, 4  # small blocks: a change is located to some hundred lines


def _tree_sql(rows: str, name: str) -> str:
    """Blocks and levels of the lines ``(day, o, line)`` of a table, and its roots."""
    return f"""
{name}_b AS (SELECT day, o, line || chr(10) AS line,
  (sum(strlen(line) + 1) OVER (PARTITION BY day ORDER BY o) - strlen(line) - 1) // {BLOCK_BYTES} AS i FROM {rows}),
{name}(day, level, i, digest) AS (
  SELECT day, 0, CAST(i AS BIGINT), sha256(string_agg(line, '' ORDER BY o)) FROM {name}_b GROUP BY day, i
  UNION ALL
  SELECT day, level + 1, i // {FANOUT}, sha256(string_agg(digest, '' ORDER BY i))
  FROM (SELECT *, max(i) OVER (PARTITION BY day) AS most FROM {name}) WHERE most > 0 GROUP BY day, level, i // {FANOUT}),
{name}_r AS (SELECT day, max_by(digest, level) AS root FROM {name} GROUP BY day)"""


@query(
    "src_artifact_hash",
    f"""WITH RECURSIVE listed_lines AS (
  SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, event_id AS o, CAST(event_id AS VARCHAR) || ':' || CAST(user_id AS VARCHAR) AS line FROM events),
ends AS (SELECT min(day) AS low, max(day) AS high FROM listed_lines),
planted AS (SELECT max(o) AS o FROM listed_lines, ends WHERE day = low),
found_lines AS (
  SELECT day, o, CASE WHEN o = (SELECT o FROM planted)
    THEN split_part(line, ':', 1) || ':' || translate(split_part(line, ':', 2), '0123456789', '1234567890') ELSE line END AS line
  FROM listed_lines, ends WHERE day < high
  UNION ALL SELECT '1970-01-01', o, line FROM listed_lines, ends WHERE day = high),
{_tree_sql("listed_lines", "listed")}, {_tree_sql("found_lines", "found")},
low AS (SELECT f.day, min(f.i) AS changed FROM found f JOIN listed l USING (day, level, i) WHERE level = 0 AND f.digest <> l.digest GROUP BY f.day)
SELECT day, CASE WHEN f.root IS NULL THEN 'missing' WHEN l.root IS NULL THEN 'unlisted' WHEN f.root = l.root THEN 'ok' ELSE 'changed' END AS status,
  coalesce(f.root, l.root) AS root, changed
FROM listed_r l FULL JOIN found_r f USING (day) LEFT JOIN low USING (day)""",
)
def src_artifact_hash(spark, folder):
    """Files of one day each, verified against Merkle trees made from the events. The files lack the last day, have it again
    under another name, and one line of the first day is changed; the trees tell these and the block of the line."""
    events = views.table(spark, folder, "events").select(F.to_date("ts").cast("string").alias("day"), "event_id", "user_id")
    events = materialize(events, "events")
    line = F.concat(F.col("event_id").cast("string"), F.lit(":"), F.col("user_id").cast("string"))
    ends = events.agg(F.min("day").alias("low"), F.max("day").alias("high")).first()
    planted = events.where(F.col("day") == ends["low"]).agg(F.max("event_id")).first()[0]
    swapped = F.concat(F.col("event_id").cast("string"), F.lit(":"), F.translate(F.col("user_id").cast("string"), "0123456789", "1234567890"))
    path = scratch_path(spark, "artifacts")
    day = F.when(F.col("day") == ends["high"], "1970-01-01").otherwise(F.col("day"))
    value = F.when(F.col("event_id") == planted, swapped).otherwise(line)
    events.select(value.alias("value"), day.alias("day")).write.partitionBy("day").text(path)

    def tree(lines: DataFrame) -> list[DataFrame]:
        return readers.digest_tree(readers.block_digests(lines, "day", "o", "line", BLOCK_BYTES), "day", FANOUT)

    listed = tree(events.select("day", F.col("event_id").alias("o"), line.alias("line")))
    files = spark.read.schema("value string, day string").text(path)
    found = tree(files.select("day", F.substring_index("value", ":", 1).cast("bigint").alias("o"), F.col("value").alias("line")))
    return readers.compare_trees(found, listed, "day", FANOUT)


@query(
    "monitor_export",
    f"""WITH {sql.PREDICTIONS}
SELECT count(*) AS n, count(*) FILTER (label = 1 AND score >= 0.5) AS tp FROM predictions""",
)
def monitor_export(spark, folder):
    """A metrics row exported and read back."""
    base = scratch_path(spark, "confusion")
    cells = ev.confusion_matrix(views.predictions(spark, folder)).select("n", "tp")
    paths = writers.export_metrics(cells, base, "1", "2024-01-31T00:00:00", ["json"])
    return spark.read.schema("n bigint, tp bigint").json(paths["json"])
