"""Input tables of the jobs, derived from the star-schema and event tables in a folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.plans.lookup import lookup_join


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Share rows with heavy work among all cores when the scan has fewer tasks than that.

    A large table has far more tasks than cores and is left alone.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, *keys) if df.rdd.getNumPartitions() < cores else df


def corpus(spark: SparkSession, folder: str) -> DataFrame:
    return spread(table(spark, folder, "documents").select("doc_id", "text"), "doc_id")


def conversations(spark: SparkSession, folder: str) -> DataFrame:
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "text")
    return spread(turns, "conv_id", "turn")


def posts(spark: SparkSession, folder: str) -> DataFrame:
    """One post per event."""
    return posts_from(table(spark, folder, "events"), table(spark, folder, "documents"))


def posts_from(events: DataFrame, documents: DataFrame) -> DataFrame:
    """Works on a batch or a streaming ``events`` frame.

    A post takes its language from the document whose id is the event's modulo the number of documents,
    which is counted once; a post without such a document has no language.
    """
    n = documents.count()
    langs = documents.select(F.col("doc_id").alias("_doc"), F.col("lang").alias("_lang"))
    keyed = events.withColumn("_doc", F.try_mod("event_id", F.lit(n)))
    return lookup_join(keyed, langs, ["_doc"]).selectExpr(
        "event_id AS post_id",
        "ts",
        "user_id",
        """concat('post ', CAST(event_id AS STRING), ' #', event_type,
            CASE WHEN event_id % 17 = 0 OR CAST(ts AS DATE) = DATE '2024-01-15'
                 THEN ' #Breaking' ELSE '' END,
            CASE WHEN event_id % 10 = 0 THEN ' @user7' ELSE '' END) AS text""",
        """CASE WHEN event_id % 7 = 0 THEN CAST(NULL AS STRING)
                WHEN event_id % 7 = 1 THEN 'EN-us' ELSE _lang END AS lang""",
        """CASE WHEN event_id % 4 = 0 THEN CAST(NULL AS DOUBLE)
                ELSE least(value / CAST(100 AS DOUBLE) - CAST(0.5 AS DOUBLE), CAST(1 AS DOUBLE))
           END AS sentiment""",
    )


def raw_messages(posts: DataFrame) -> DataFrame:
    """Posts as they arrive on a topic; every 50th payload is cut off and cannot be parsed."""
    payload = F.to_json(F.struct("post_id", "ts", "user_id", "text", "lang", "sentiment"))
    cut = F.when(F.col("post_id") % 50 == 0, F.substring(payload, 1, 20)).otherwise(payload)
    return posts.select(
        F.col("user_id").cast("string").cast("binary").alias("key"),
        cut.cast("binary").alias("value"),
        F.lit("posts.raw").alias("topic"),
        (F.col("user_id") % 4).cast("int").alias("partition"),
        F.col("post_id").alias("offset"),
        F.col("ts").alias("timestamp"),
    )


def passengers(spark: SparkSession, folder: str) -> DataFrame:
    """One passenger per order, with nulls in age, cabin, embarked and fare."""
    return spark.sql(
        """
        SELECT o_orderkey AS passenger_id,
          CAST(CASE WHEN o_orderstatus='F' THEN 1 ELSE 0 END AS INT) AS survived,
          least(CAST(substr(o_orderpriority,1,1) AS INT),3) AS pclass,
          CASE WHEN o_custkey % 3 = 0 THEN 'female' ELSE 'male' END AS sex,
          concat('Surname', CAST(o_custkey AS STRING), ', ',
            CASE WHEN o_orderkey % 101 = 0 THEN 'Dr' WHEN o_orderkey % 103 = 0 THEN 'Rev'
                 WHEN o_orderkey % 107 = 0 THEN 'the Countess'
                 WHEN o_custkey % 3 = 0 AND o_orderkey % 2 = 0 THEN 'Mrs'
                 WHEN o_custkey % 3 = 0 THEN 'Miss'
                 WHEN o_orderkey % 11 = 0 THEN 'Master' ELSE 'Mr' END, '. Given') AS name,
          CASE WHEN o_orderkey % 5 = 0 THEN CAST(NULL AS DOUBLE)
               ELSE CAST(o_custkey % 80 AS DOUBLE)
                    + CAST(o_orderkey % 4 AS DOUBLE) * CAST(0.25 AS DOUBLE) END AS age,
          CAST(o_orderkey % 9 AS INT) AS sibsp, CAST(o_custkey % 7 AS INT) AS parch,
          concat('T', CAST(o_orderkey % 1000 AS STRING)) AS ticket,
          CASE WHEN o_orderkey % 97 = 0 THEN CAST(NULL AS DOUBLE)
               ELSE o_totalprice / CAST(1000 AS DOUBLE) END AS fare,
          CASE WHEN o_orderkey % 13 < 10 THEN CAST(NULL AS STRING)
               ELSE concat(substr('ABCDEFG', CAST(o_custkey % 7 AS INT) + 1, 1),
                           CAST(o_orderkey % 120 AS STRING)) END AS cabin,
          CASE WHEN o_orderkey % 500 = 0 THEN CAST(NULL AS STRING)
               WHEN c_mktsegment = 'AUTOMOBILE' THEN 'C'
               WHEN c_mktsegment = 'BUILDING' THEN 'Q' ELSE 'S' END AS embarked
        FROM {orders} JOIN {customer} ON o_custkey = c_custkey
        """,
        orders=table(spark, folder, "orders"),
        customer=table(spark, folder, "customer"),
    )


def request_log(spark: SparkSession, folder: str) -> DataFrame:
    return spark.sql(
        """
        SELECT event_id AS request_id, ts,
          CASE WHEN user_id % 2 = 0 THEN 'v1' ELSE 'v2' END AS model_version,
          CASE WHEN event_type='error' THEN 500 ELSE 200 END AS status, value AS latency_ms,
          CAST((event_id * 7919) % 1000 AS DOUBLE) / CAST(1000 AS DOUBLE) AS confidence
        FROM {events}
        """,
        events=table(spark, folder, "events"),
    )


def predictions(spark: SparkSession, folder: str) -> DataFrame:
    return spark.sql(
        """
        SELECT o_orderkey AS passenger_id,
          CAST(CASE WHEN o_orderstatus='F' THEN 1 ELSE 0 END AS INT) AS label,
          CAST((o_orderkey * 7919) % 750 + CASE WHEN o_orderstatus='F' THEN 249 ELSE 0 END AS DOUBLE)
            / CAST(1000 AS DOUBLE) AS score
        FROM {orders}
        """,
        orders=table(spark, folder, "orders"),
    )


def trials(spark: SparkSession, folder: str) -> DataFrame:
    return spark.sql(
        """
        SELECT p_partkey % 50 AS trial, CAST(floor(p_partkey / 50) AS BIGINT) AS study,
          3 + p_size % 8 AS max_depth, CAST(p_size AS DOUBLE) / CAST(170 AS DOUBLE) AS learning_rate,
          CAST((p_partkey * 7919) % 1000 AS DOUBLE) / CAST(1000 AS DOUBLE) AS auc,
          CAST((p_partkey * 104729) % 97 AS INT) AS model_kb
        FROM {part}
        """,
        part=table(spark, folder, "part"),
    )


def feature_values(spark: SparkSession, folder: str) -> DataFrame:
    return (
        table(spark, folder, "lineitem")
        .groupBy(F.col("l_suppkey").alias("entity_id"), F.col("l_shipdate").alias("feature_ts"))
        .agg(F.max("l_quantity").alias("quantity"), F.count(F.lit(1)).alias("n_items"))
    )


def model_versions(spark: SparkSession, folder: str) -> DataFrame:
    """A registry manifest: one model per study, one version per trial of that study."""
    return trials(spark, folder).select(
        F.concat(F.lit("model"), F.col("study").cast("string")).alias("name"),
        (F.col("trial") + 1).cast("int").alias("version"),
        F.expr(
            "CASE WHEN trial % 7 = 3 THEN 'Production' WHEN trial % 7 = 5 THEN 'Archived'"
            " ELSE 'Staging' END"
        ).alias("stage"),
        F.expr(
            "CAST(TIMESTAMP_NTZ '2024-01-01 00:00:00' + make_dt_interval(CAST(trial * 7 AS INT))"
            " AS TIMESTAMP_NTZ)"
        ).alias("trained_at"),
        F.create_map(
            F.lit("auc"), F.col("auc"), F.lit("model_kb"), F.col("model_kb").cast("double")
        ).alias("metrics"),
        F.create_map(
            F.lit("max_depth"),
            F.col("max_depth").cast("string"),
            F.lit("trial"),
            F.col("trial").cast("string"),
        ).alias("params"),
    )
