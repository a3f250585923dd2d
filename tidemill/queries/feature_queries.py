"""Named queries on the passenger table: profile, validation, feature preparation, lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.operators import features as ft
from tidemill.operators import lookups as lk
from tidemill.operators import profile as pf
from tidemill.operators import validation as va
from tidemill.plans import materialize
from tidemill.queries import checks as sql
from tidemill.queries.registry import query, r
from tidemill.sources import views

NUMERIC = ["age", "fare", "sibsp", "parch", "pclass", "survived"]
MEASURES = ["age", "fare", "sibsp", "parch"]
CATEGORIES = ["sex", "embarked", "pclass"]


def _all(spark, folder) -> DataFrame:
    return views.passengers(spark, folder)


def _train(spark, folder) -> DataFrame:
    return ft.train_rows(_all(spark, folder), "passenger_id")


def unioned(template: str, columns: list[str]) -> str:
    return "\nUNION ALL ".join(template.replace("{c}", c) for c in columns)


TRAIN = f"""{sql.PASSENGERS},
train AS (SELECT * FROM passengers WHERE {sql.bucket("passenger_id", 42, 100)} < 80),
test AS (SELECT * FROM passengers WHERE {sql.bucket("passenger_id", 42, 100)} >= 80)"""

# --- profile --------------------------------------------------------------------------------------

TYPES = {
    "passenger_id": "bigint", "survived": "int", "pclass": "int", "sex": "string", "name": "string",
    "age": "double", "sibsp": "int", "parch": "int", "ticket": "string", "fare": "double",
    "cabin": "string", "embarked": "string",
}


@query(
    "schema_info",
    f"WITH {sql.PASSENGERS} "
    + "\nUNION ALL ".join(
        f"SELECT '{c}' AS \"column\", '{t}' AS dtype, count({c}) AS non_null FROM passengers"
        for c, t in TYPES.items()
    ),
)
def schema_info(spark, folder):
    return pf.schema_info(_all(spark, folder))


@query(
    "describe",
    f"WITH {sql.PASSENGERS} "
    + unioned(
        """SELECT '{c}' AS "column", count({c}) AS "count", round(avg({c}), 6) AS mean,
  round(stddev_samp({c}), 6) AS std, CAST(min({c}) AS DOUBLE) AS min,
  round(quantile_cont(CAST({c} AS DOUBLE), 0.25), 6) AS q25, round(quantile_cont(CAST({c} AS DOUBLE), 0.5), 6) AS q50,
  round(quantile_cont(CAST({c} AS DOUBLE), 0.75), 6) AS q75, CAST(max({c}) AS DOUBLE) AS max FROM passengers""",
        NUMERIC,
    ),
)
def describe(spark, folder):
    return pf.describe(_all(spark, folder), NUMERIC).select(
        "column", "count", r("mean"), r("std"), "min", r("q25"), r("q50"), r("q75"), "max"
    )


@query(
    "class_balance",
    f"""WITH {sql.PASSENGERS}
SELECT survived, count(*) AS n, round(count(*) / (SELECT count(*) FROM passengers), 6) AS share
FROM passengers GROUP BY survived""",
)
def class_balance(spark, folder):
    return pf.class_balance(_all(spark, folder), "survived").select("survived", "n", r("share"))


@query(
    "missing_pct",
    f"WITH {sql.PASSENGERS} "
    + unioned(
        """SELECT '{c}' AS "column",
  round(100 * avg(CASE WHEN {c} IS NULL THEN 1.0::DOUBLE ELSE 0 END), 6) AS missing_pct FROM passengers""",
        list(TYPES),
    ),
)
def missing_pct(spark, folder):
    return pf.missing_pct(_all(spark, folder)).select("column", r("missing_pct"))


@query(
    "missing_pattern",
    f"""WITH {sql.PASSENGERS}
SELECT CAST(age IS NULL AS INT) AS age_missing, CAST(cabin IS NULL AS INT) AS cabin_missing,
  CAST(embarked IS NULL AS INT) AS embarked_missing, CAST(fare IS NULL AS INT) AS fare_missing, count(*) AS n
FROM passengers GROUP BY ALL""",
)
def missing_pattern(spark, folder):
    return pf.missing_pattern(_all(spark, folder), ["age", "cabin", "embarked", "fare"])


@query(
    "histogram",
    f"WITH {sql.PASSENGERS} "
    + unioned(
        """SELECT * FROM (SELECT '{c}' AS "column", CAST(least(9, floor(({c} - lo) / ((hi - lo) / 10.0::DOUBLE))) AS INT) AS bin,
  count(*) AS n FROM passengers, (SELECT CAST(min({c}) AS DOUBLE) AS lo, CAST(max({c}) AS DOUBLE) AS hi FROM passengers)
  WHERE {c} IS NOT NULL GROUP BY ALL)
  JOIN (SELECT unnest(range(10)) AS bin, CAST(min({c}) AS DOUBLE) AS lo, CAST(max({c}) AS DOUBLE) AS hi FROM passengers) USING (bin)""",
        MEASURES,
    ).replace("SELECT * FROM (SELECT", 'SELECT "column", bin, n, round(lo + bin * ((hi - lo) / 10), 6) AS bin_start FROM (SELECT'),
)
def histogram(spark, folder):
    return pf.histogram(_all(spark, folder), MEASURES).select("column", "bin", "n", r("bin_start"))


@query(
    "category_counts",
    f"WITH {sql.PASSENGERS} "
    + unioned(
        """SELECT '{c}' AS "column", CAST({c} AS VARCHAR) AS value, count(*) AS n FROM passengers GROUP BY ALL""",
        CATEGORIES,
    ),
)
def category_counts(spark, folder):
    return pf.category_counts(_all(spark, folder), CATEGORIES)


@query(
    "rate_by_feature",
    f"WITH {sql.PASSENGERS} "
    + unioned(
        """SELECT '{c}' AS feature, CAST({c} AS VARCHAR) AS value, round(avg(survived), 6) AS rate, count(*) AS n
  FROM passengers GROUP BY ALL""",
        CATEGORIES,
    ),
)
def rate_by_feature(spark, folder):
    return pf.rate_by_feature(_all(spark, folder), CATEGORIES, "survived").select(
        "feature", "value", r("rate"), "n"
    )


def _corr_sql() -> str:
    cells = []
    for a in NUMERIC:
        for b in NUMERIC:
            value = "1.0::DOUBLE" if a == b else f"corr({a}, {b})"
            cells.append(f"SELECT '{a}' AS a, '{b}' AS b, round({value}, 6) + 0.0 AS corr FROM passengers")
    cells = [c + " LIMIT 1" if "1.0::" in c else c for c in cells]
    return "\nUNION ALL ".join(f"({c})" for c in cells)


@query("corr_matrix", f"WITH {sql.PASSENGERS} {_corr_sql()}")
def corr_matrix(spark, folder):
    return pf.corr_matrix(_all(spark, folder), NUMERIC).select("a", "b", r("corr"))


@query(
    "corr_with_label",
    f"WITH {sql.PASSENGERS} "
    + unioned(
        """SELECT '{c}' AS "column", round(corr({c}, survived), 6) + 0.0 AS corr FROM passengers""",
        NUMERIC[:-1],
    ),
)
def corr_with_label(spark, folder):
    return pf.corr_with_label(_all(spark, folder), NUMERIC[:-1], "survived").select(
        "column", r("corr")
    )


@query(
    "corr_warning",
    f"WITH {sql.PASSENGERS}, m AS ({_corr_sql()}) SELECT * FROM m WHERE a < b AND abs(corr) > 0.005",
)
def corr_warning(spark, folder):
    return pf.corr_warning(_all(spark, folder), NUMERIC, 0.005).select("a", "b", r("corr"))


@query(
    "dataset_fingerprint",
    """SELECT count(*) AS n_rows, bit_xor(h) AS hash_xor, CAST(sum(h) AS VARCHAR) AS hash_sum FROM (
SELECT CAST('0x' || substr(md5(concat_ws('|', doc_id, text, lang, source, n_chars)), 1, 15) AS BIGINT) AS h
FROM documents)""",
)
def dataset_fingerprint(spark, folder):
    return pf.dataset_fingerprint(views.table(spark, folder, "documents"), "md5")


# --- validation -----------------------------------------------------------------------------------

ODD = f"""{sql.PASSENGERS},
odd AS (SELECT passenger_id, CASE WHEN passenger_id % 200 = 1 THEN age + 80 ELSE age END AS age,
  CASE WHEN passenger_id % 300 = 2 THEN -fare ELSE fare END AS fare,
  sibsp + CASE WHEN passenger_id % 250 = 8 THEN 9 ELSE 0 END AS sibsp,
  parch + CASE WHEN passenger_id % 400 = 8 THEN 7 ELSE 0 END AS parch FROM passengers)"""


def _odd(spark, folder) -> DataFrame:
    """Passengers with planted range errors."""
    pid = F.col("passenger_id")
    return _all(spark, folder).select(
        "passenger_id",
        F.when(pid % 200 == 1, F.col("age") + 80).otherwise(F.col("age")).alias("age"),
        F.when(pid % 300 == 2, -F.col("fare")).otherwise(F.col("fare")).alias("fare"),
        (F.col("sibsp") + F.when(pid % 250 == 8, 9).otherwise(0)).alias("sibsp"),
        (F.col("parch") + F.when(pid % 400 == 8, 7).otherwise(0)).alias("parch"),
    )


@query(
    "validate_rows",
    f"""WITH {ODD}
SELECT passenger_id, concat_ws(',', CASE WHEN age < 0 OR age > 80 THEN 'age' END, CASE WHEN fare < 0 THEN 'fare' END,
  CASE WHEN sibsp < 0 OR sibsp > 8 THEN 'sibsp' END, CASE WHEN parch < 0 OR parch > 6 THEN 'parch' END) AS violations
FROM odd""",
)
def validate_rows(spark, folder):
    checked = va.validate_rows(_odd(spark, folder))
    return checked.select("passenger_id", F.array_join("violations", ",").alias("violations"))


@query(
    "quality_report",
    f"WITH {sql.PASSENGERS} "
    + unioned(
        """SELECT '{c}' AS "column", count(*) - count({c}) AS nulls, true AS is_numeric, count(*) AS n_rows,
  round(avg({c}), 6) AS mean, CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max FROM passengers""",
        NUMERIC,
    )
    + "\nUNION ALL "
    + unioned(
        """SELECT '{c}' AS "column", count(*) - count({c}) AS nulls, false AS is_numeric, count(*) AS n_rows,
  NULL, NULL, NULL FROM passengers""",
        ["sex", "embarked", "cabin"],
    ),
)
def quality_report(spark, folder):
    df = _all(spark, folder).select(*NUMERIC, "sex", "embarked", "cabin")
    return va.quality_report(df).withColumn("mean", r("mean"))


@query(
    "entity_checks",
    f"""WITH {sql.PASSENGERS},
rows AS (SELECT CASE WHEN passenger_id % 90 = 0 THEN NULL ELSE passenger_id // 2 END AS entity_id, age, fare, sex
FROM passengers)
SELECT 'id_present' AS rule, count(*) - count(entity_id) AS broken FROM rows
UNION ALL SELECT 'not_null:age', count(*) - count(age) FROM rows
UNION ALL SELECT 'not_null:sex', count(*) - count(sex) FROM rows
UNION ALL SELECT 'type:fare', 0 UNION ALL SELECT 'type:age', 1
UNION ALL SELECT 'unique_id', count(*) FROM (SELECT entity_id FROM rows WHERE entity_id IS NOT NULL
  GROUP BY entity_id HAVING count(*) > 1)""".replace(", 0 ", ", CAST(0 AS BIGINT) ").replace(
        ", 1\n", ", CAST(1 AS BIGINT)\n"
    ),
)
def entity_checks(spark, folder):
    pid = F.col("passenger_id")
    rows = _all(spark, folder).select(
        F.when(pid % 90 != 0, F.floor(pid / 2)).alias("entity_id"), "age", "fare", "sex"
    )
    return va.entity_checks(rows, "entity_id", ["age", "sex"], {"fare": "double", "age": "int"})


@query(
    "error_filter",
    f"WITH {sql.REQUEST_LOG} SELECT request_id, ts, model_version, status FROM request_log WHERE status >= 500",
)
def error_filter(spark, folder):
    return va.error_filter(views.request_log(spark, folder)).select(
        "request_id", "ts", "model_version", "status"
    )


@query(
    "select_features",
    f"WITH {sql.PASSENGERS} SELECT pclass, sex, age, fare, survived FROM passengers",
)
def select_features(spark, folder):
    return va.select_features(_all(spark, folder), ["pclass", "sex", "age", "fare", "survived"])


FEATURE_NAMES = ["age", "sex", "pclass", "sibsp", "parch", "fare", "family_size", "is_alone", "age_bin"]


@query(
    "feature_dependency",
    f"""WITH {sql.TRIALS},
names AS (SELECT unnest({FEATURE_NAMES}) AS feature, unnest(range({len(FEATURE_NAMES)})) AS i),
chosen AS (SELECT study, trial, feature FROM trials, names WHERE (study * 50 + trial + i * i) % 3 <> 0 OR (trial % 5 = i % 5)),
left_over AS (
SELECT study, trial, feature FROM chosen c WHERE NOT (
  feature IN ('family_size', 'is_alone') AND NOT EXISTS (SELECT 1 FROM chosen x WHERE x.study = c.study AND x.trial = c.trial
    AND x.feature IN ('sibsp', 'parch'))
  OR feature = 'age_bin' AND NOT EXISTS (SELECT 1 FROM chosen x WHERE x.study = c.study AND x.trial = c.trial
    AND x.feature = 'age')))
SELECT study, trial, string_agg(feature, ' ' ORDER BY feature) AS features, CAST(count(*) AS INT) AS n_features,
  count(*) >= 3 AND bool_or(feature IN ('age', 'sex', 'pclass')) AS valid
FROM left_over GROUP BY study, trial""",
)
def feature_dependency(spark, folder):
    pick = F.posexplode(F.lit(FEATURE_NAMES)).alias("i", "feature")
    grid = views.trials(spark, folder).select("study", "trial", pick)
    on = ((F.col("study") * 50 + F.col("trial") + F.col("i") * F.col("i")) % 3 != 0) | (
        F.col("trial") % 5 == F.col("i") % 5
    )
    kept = va.feature_dependency(grid.where(on), ["study", "trial"])
    return kept.withColumn("features", F.array_join("features", " "))


# --- preparation ----------------------------------------------------------------------------------


@query(
    "impute_group_median",
    f"""WITH {TRAIN},
g AS (SELECT pclass, sex, median(age) AS m FROM train GROUP BY ALL)
SELECT passenger_id, round(coalesce(age, m, (SELECT median(age) FROM train)), 6) AS age
FROM passengers LEFT JOIN g USING (pclass, sex)""",
)
def impute_group_median(spark, folder):
    train = _train(spark, folder)
    groups = ft.fit_median(train, "age", ["pclass", "sex"])
    filled = ft.impute_group_median(
        _all(spark, folder), "age", ["pclass", "sex"], groups, ft.fit_median(train, "age")
    )
    return filled.select("passenger_id", r("age"))


@query(
    "impute_class_median",
    f"""WITH {TRAIN},
g AS (SELECT pclass, median(fare) AS m FROM train GROUP BY ALL)
SELECT passenger_id, round(coalesce(fare, m, (SELECT median(fare) FROM train)), 6) AS fare
FROM passengers LEFT JOIN g USING (pclass)""",
)
def impute_class_median(spark, folder):
    train = _train(spark, folder)
    filled = ft.impute_group_median(
        _all(spark, folder),
        "fare",
        ["pclass"],
        ft.fit_median(train, "fare", ["pclass"]),
        ft.fit_median(train, "fare"),
    )
    return filled.select("passenger_id", r("fare"))


@query(
    "impute_mean",
    f"WITH {TRAIN} SELECT passenger_id, round(coalesce(age, (SELECT avg(age) FROM train)), 6) AS age FROM passengers",
)
def impute_mean(spark, folder):
    mean = ft.fit_mean(_train(spark, folder), "age")
    return ft.impute_scalar(_all(spark, folder), "age", mean).select("passenger_id", r("age"))


@query(
    "impute_mode",
    f"""WITH {TRAIN}
SELECT passenger_id, coalesce(embarked, (SELECT embarked FROM train WHERE embarked IS NOT NULL
  GROUP BY embarked ORDER BY count(*) DESC, embarked LIMIT 1)) AS embarked FROM passengers""",
)
def impute_mode(spark, folder):
    mode = ft.fit_mode(_train(spark, folder), "embarked")
    return ft.impute_scalar(_all(spark, folder), "embarked", mode).select("passenger_id", "embarked")


@query(
    "drop_null_rows",
    f"WITH {sql.PASSENGERS} SELECT passenger_id, embarked, fare FROM passengers WHERE embarked IS NOT NULL AND fare IS NOT NULL",
)
def drop_null_rows(spark, folder):
    return ft.drop_null_rows(_all(spark, folder), ["embarked", "fare"]).select(
        "passenger_id", "embarked", "fare"
    )


@query(
    "missing_flag",
    f"WITH {sql.PASSENGERS} SELECT passenger_id, CAST(age IS NULL AS INT) AS age_missing FROM passengers",
)
def missing_flag(spark, folder):
    return ft.missing_flag(_all(spark, folder), "age").select("passenger_id", "age_missing")


@query(
    "has_cabin",
    f"WITH {sql.PASSENGERS} SELECT passenger_id, CAST(cabin IS NOT NULL AS INT) AS has_cabin FROM passengers",
)
def has_cabin(spark, folder):
    return ft.has_cabin(_all(spark, folder)).select("passenger_id", "has_cabin")


@query(
    "deck",
    f"WITH {sql.PASSENGERS} SELECT passenger_id, coalesce(substr(cabin, 1, 1), 'Unknown') AS deck FROM passengers",
)
def deck(spark, folder):
    return ft.deck(_all(spark, folder)).select("passenger_id", "deck")


@query(
    "family_size",
    f"WITH {sql.PASSENGERS} SELECT passenger_id, sibsp + parch + 1 AS family_size FROM passengers",
)
def family_size(spark, folder):
    return ft.family_size(_all(spark, folder)).select("passenger_id", "family_size")


@query(
    "is_alone",
    f"WITH {sql.PASSENGERS} SELECT passenger_id, CAST(sibsp + parch = 0 AS INT) AS is_alone FROM passengers",
)
def is_alone(spark, folder):
    return ft.is_alone(_all(spark, folder)).select("passenger_id", "is_alone")


TITLES = """
titles AS (SELECT regexp_extract(name, ',\\s*([^.]+)\\.', 1) AS title FROM train GROUP BY 1
HAVING count(*) >= 0.02::DOUBLE * (SELECT count(*) FROM train))"""


@query(
    "title",
    f"""WITH {TRAIN}, {TITLES}
SELECT passenger_id, CASE WHEN t IN (SELECT title FROM titles) THEN t ELSE 'Rare' END AS title
FROM (SELECT passenger_id, regexp_extract(name, ',\\s*([^.]+)\\.', 1) AS t FROM passengers)""",
)
def title(spark, folder):
    kept = ft.fit_titles(_train(spark, folder))
    return ft.title(_all(spark, folder), kept).select("passenger_id", "title")


@query(
    "fare_bins",
    f"""WITH {TRAIN},
q AS (SELECT quantile_cont(fare, 0.25) AS a, quantile_cont(fare, 0.5) AS b, quantile_cont(fare, 0.75) AS c FROM train)
SELECT passenger_id, CASE WHEN fare IS NULL THEN NULL WHEN fare <= a THEN 'cheap' WHEN fare <= b THEN 'medium'
  WHEN fare <= c THEN 'expensive' ELSE 'very expensive' END AS fare_bin FROM passengers, q""",
)
def fare_bins(spark, folder):
    cuts = ft.fit_fare_bins(_train(spark, folder))
    return ft.fare_bins(_all(spark, folder), cuts).select("passenger_id", "fare_bin")


@query(
    "age_bins",
    f"""WITH {sql.PASSENGERS}
SELECT passenger_id, CASE WHEN age IS NULL THEN NULL WHEN age < 17 THEN 'Child' WHEN age < 33 THEN 'Young Adult'
  WHEN age < 49 THEN 'Adult' ELSE 'Senior' END AS age_bin FROM passengers""",
)
def age_bins(spark, folder):
    return ft.age_bins(_all(spark, folder)).select("passenger_id", "age_bin")


@query(
    "encode_binary",
    f"WITH {sql.PASSENGERS} SELECT passenger_id, CAST(sex = 'male' AS INT) AS sex FROM passengers",
)
def encode_binary(spark, folder):
    return ft.encode_binary(_all(spark, folder)).select("passenger_id", "sex")


@query(
    "encode_onehot",
    f"""WITH {sql.PASSENGERS}
SELECT passenger_id, CAST(coalesce(embarked = 'C', false) AS INT) AS "embarked_C",
  CAST(coalesce(embarked = 'Q', false) AS INT) AS "embarked_Q",
  CAST(coalesce(embarked = 'S', false) AS INT) AS "embarked_S" FROM passengers""",
)
def encode_onehot(spark, folder):
    names = ft.category_list(ft.fit_categories(_train(spark, folder), "embarked"))
    shown = [f"embarked_{n}" for n in names]
    return ft.encode_onehot(_all(spark, folder), "embarked", names).select("passenger_id", *shown)


@query("encode_ordinal", f"WITH {sql.PASSENGERS} SELECT passenger_id, pclass FROM passengers")
def encode_ordinal(spark, folder):
    texts = _all(spark, folder).withColumn("pclass", F.col("pclass").cast("string"))
    return ft.encode_ordinal(texts, "pclass").select("passenger_id", "pclass")


@query(
    "encode_label",
    f"""WITH {TRAIN},
labels AS (SELECT ticket, row_number() OVER (ORDER BY ticket) - 1 AS ticket_label FROM (SELECT DISTINCT ticket FROM train))
SELECT passenger_id, ticket, ticket_label FROM passengers LEFT JOIN labels USING (ticket)""",
)
def encode_label(spark, folder):
    labels = ft.fit_labels(_train(spark, folder), "ticket")
    return ft.encode_label(_all(spark, folder), "ticket", labels).select(
        "passenger_id", "ticket", "ticket_label"
    )


@query(
    "scale_standard",
    f"""WITH {TRAIN},
s AS (SELECT avg(age) AS am, stddev_pop(age) AS sd, avg(fare) AS fm, stddev_pop(fare) AS fs FROM train)
SELECT passenger_id, round((age - am) / sd, 6) + 0.0 AS age, round((fare - fm) / fs, 6) + 0.0 AS fare
FROM passengers, s""",
)
def scale_standard(spark, folder):
    scaler = ft.fit_scaler(_train(spark, folder), ["age", "fare"])
    return ft.scale_standard(_all(spark, folder), ["age", "fare"], scaler).select(
        "passenger_id", r("age"), r("fare")
    )


FEATURE_TABLE = f"""{TRAIN}, {TITLES},
am AS (SELECT pclass, sex, median(age) AS age_m FROM train GROUP BY ALL),
fm AS (SELECT pclass, median(fare) AS fare_m FROM train GROUP BY ALL),
filled AS (
SELECT passenger_id, survived, pclass, CAST(sex = 'male' AS INT) AS sex, CAST(age IS NULL AS INT) AS age_missing,
  coalesce(age, age_m, (SELECT median(age) FROM train)) AS age,
  coalesce(fare, fare_m, (SELECT median(fare) FROM train)) AS fare,
  sibsp + parch + 1 AS family_size, CAST(sibsp + parch = 0 AS INT) AS is_alone, CAST(cabin IS NOT NULL AS INT) AS has_cabin,
  coalesce(embarked, (SELECT embarked FROM train WHERE embarked IS NOT NULL
    GROUP BY embarked ORDER BY count(*) DESC, embarked LIMIT 1)) AS embarked,
  CASE WHEN regexp_extract(name, ',\\s*([^.]+)\\.', 1) IN (SELECT title FROM titles)
    THEN regexp_extract(name, ',\\s*([^.]+)\\.', 1) ELSE 'Rare' END AS title
FROM passengers LEFT JOIN am USING (pclass, sex) LEFT JOIN fm USING (pclass)),
s AS (SELECT avg(age) AS a1, stddev_pop(age) AS a2, avg(fare) AS f1, stddev_pop(fare) AS f2,
  avg(family_size) AS z1, stddev_pop(family_size) AS z2
FROM filled SEMI JOIN train USING (passenger_id)),
prepared AS (
SELECT passenger_id, survived, round((age - a1) / a2, 6) + 0.0 AS age, round((fare - f1) / f2, 6) + 0.0 AS fare,
  round((family_size - z1) / z2, 6) + 0.0 AS family_size, pclass, sex, is_alone, has_cabin, age_missing,
  CAST(embarked = 'Q' AS INT) AS "embarked_Q", CAST(embarked = 'S' AS INT) AS "embarked_S",
  CAST(title = 'Miss' AS INT) AS "title_Miss", CAST(title = 'Mr' AS INT) AS "title_Mr",
  CAST(title = 'Mrs' AS INT) AS "title_Mrs", CAST(title = 'Rare' AS INT) AS "title_Rare"
FROM filled, s)"""


@query("feature_table", f"WITH {FEATURE_TABLE} SELECT * FROM prepared")
def feature_table(spark, folder):
    rows = materialize(_all(spark, folder), "passengers")  # read by every fit
    bundle = ft.fit_features(ft.train_rows(rows, "passenger_id"))
    out = ft.apply_features(rows, bundle, drop_first=True)
    return out.withColumns({c: F.round(c, 6) for c in ft.SCALED})


@query(
    "leakage_check",
    f"""WITH {TRAIN}
SELECT 'id' AS kind, count(*) AS shared FROM train SEMI JOIN test USING (passenger_id)
UNION ALL SELECT 'features', count(*) FROM (
  SELECT pclass, sex, age, sibsp, parch FROM train INTERSECT SELECT pclass, sex, age, sibsp, parch FROM test)""",
)
def leakage_check(spark, folder):
    halves = ft.split_random(_all(spark, folder), "passenger_id")
    train, test = (halves.where(F.col("split") == s) for s in ("train", "test"))
    return ft.leakage_check(train, test, "passenger_id", ["pclass", "sex", "age", "sibsp", "parch"])


@query(
    "train_serve_skew",
    f"""WITH {sql.PASSENGERS},
t AS (SELECT * FROM passengers WHERE passenger_id % 10 <> 9),
v AS (SELECT passenger_id, CASE WHEN passenger_id % 20 = 0 THEN age + 1 ELSE age END AS age, CAST(fare AS FLOAT) AS fare,
  coalesce(embarked, 'S') AS embarked FROM passengers WHERE passenger_id % 10 <> 8),
b AS (SELECT t.age AS ta, v.age AS va, t.fare AS tf, v.fare AS vf, t.embarked AS te, v.embarked AS ve,
  t.passenger_id AS ti, v.passenger_id AS vi FROM t FULL JOIN v USING (passenger_id))
SELECT 'age' AS "column", true AS same_type,
  count(*) FILTER (ti IS NOT NULL AND vi IS NOT NULL AND ta IS DISTINCT FROM va) AS n_diff,
  count(*) FILTER (vi IS NULL) AS only_train, count(*) FILTER (ti IS NULL) AS only_serve FROM b
UNION ALL SELECT 'embarked', true, count(*) FILTER (ti IS NOT NULL AND vi IS NOT NULL AND te IS DISTINCT FROM ve),
  count(*) FILTER (vi IS NULL), count(*) FILTER (ti IS NULL) FROM b
UNION ALL SELECT 'fare', false, count(*) FILTER (ti IS NOT NULL AND vi IS NOT NULL AND tf IS DISTINCT FROM CAST(vf AS DOUBLE)),
  count(*) FILTER (vi IS NULL), count(*) FILTER (ti IS NULL) FROM b""",
)
def train_serve_skew(spark, folder):
    rows = _all(spark, folder).select("passenger_id", "age", "fare", "embarked")
    pid = F.col("passenger_id")
    serve = rows.where(pid % 10 != 8).select(
        "passenger_id",
        F.when(pid % 20 == 0, F.col("age") + 1).otherwise(F.col("age")).alias("age"),
        F.col("fare").cast("float").alias("fare"),
        F.coalesce("embarked", F.lit("S")).alias("embarked"),
    )
    return ft.train_serve_skew(rows.where(pid % 10 != 9), serve, "passenger_id")


@query(
    "split_random",
    f"""WITH {sql.PASSENGERS}
SELECT passenger_id, CASE WHEN {sql.bucket("passenger_id", 42, 100)} < 80 THEN 'train' ELSE 'test' END AS split
FROM passengers""",
)
def split_random(spark, folder):
    return ft.split_random(_all(spark, folder), "passenger_id").select("passenger_id", "split")


@query(
    "kfold",
    f"""WITH {sql.PASSENGERS}
SELECT passenger_id, CAST({sql.bucket("passenger_id", 42, 5)} AS INT) AS fold FROM passengers""",
)
def kfold(spark, folder):
    return ft.kfold(_all(spark, folder), "passenger_id").select("passenger_id", "fold")


# --- lookups --------------------------------------------------------------------------------------


@query(
    "src_feature_import",
    """SELECT CAST(l_suppkey AS BIGINT) AS entity_id, l_shipdate AS feature_ts, l_quantity AS quantity,
  CAST(l_linenumber AS BIGINT) AS line, l_returnflag = 'R' AS returned FROM lineitem""",
)
def src_feature_import(spark, folder):
    rows = views.table(spark, folder, "lineitem").withColumn("flag", F.col("l_returnflag") == "R")
    return lk.feature_import(
        rows,
        {"l_quantity": "quantity", "l_linenumber": "line", "flag": "returned"},
        {"quantity": "double", "line": "bigint", "returned": "boolean"},
        "l_suppkey",
        "l_shipdate",
    )


REQUESTS = "requests AS (SELECT c_custkey AS request_id, c_custkey % (SELECT count(*) + 20 FROM supplier) AS entity_id FROM customer)"
LATEST = f"""{sql.FEATURE_VALUES},
latest AS (SELECT DISTINCT ON (entity_id) * FROM feature_values ORDER BY entity_id, feature_ts DESC)"""


def _requests(spark, folder) -> DataFrame:
    size = views.table(spark, folder, "supplier").agg((F.count(F.lit(1)) + 20).alias("n"))
    return views.table(spark, folder, "customer").select(
        F.col("c_custkey").alias("request_id"), (F.col("c_custkey") % size.scalar()).alias("entity_id")
    )


@query(
    "feature_lookup",
    f"""WITH {LATEST}, {REQUESTS}
SELECT request_id, entity_id, feature_ts, quantity, n_items FROM requests LEFT JOIN latest USING (entity_id)""",
)
def feature_lookup(spark, folder):
    return lk.feature_lookup(_requests(spark, folder), views.feature_values(spark, folder))


@query(
    "feature_asof",
    f"""WITH {sql.FEATURE_VALUES},
labels_at AS (SELECT o_orderkey AS label_id, o_custkey % (SELECT count(*) + 20 FROM supplier) AS entity_id,
  o_orderdate AS label_ts FROM orders)
SELECT label_id, l.entity_id, label_ts, feature_ts, quantity, n_items
FROM labels_at l ASOF LEFT JOIN feature_values f ON l.entity_id = f.entity_id AND l.label_ts >= f.feature_ts""",
)
def feature_asof(spark, folder):
    size = views.table(spark, folder, "supplier").agg((F.count(F.lit(1)) + 20).alias("n"))
    labels = views.table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("label_id"),
        (F.col("o_custkey") % size.scalar()).alias("entity_id"),
        F.col("o_orderdate").alias("label_ts"),
    )
    return lk.feature_asof(labels, views.feature_values(spark, folder)).select(
        "label_id", "entity_id", "label_ts", "feature_ts", "quantity", "n_items"
    )


@query(
    "feature_export",
    f"""WITH {LATEST}, {REQUESTS}
SELECT DISTINCT r.entity_id, feature_ts, quantity, n_items, feature_ts IS NULL AS missing
FROM requests r LEFT JOIN latest l ON r.entity_id = l.entity_id""",
)
def feature_export(spark, folder):
    known, missing = lk.feature_export(_requests(spark, folder), views.feature_values(spark, folder))
    return known.withColumn("missing", F.lit(False)).unionByName(
        missing.withColumn("missing", F.lit(True)), allowMissingColumns=True
    )


@query(
    "compare_models",
    f"""WITH {sql.VERSIONS}
SELECT v.name, v.version, v.auc, v.model_kb, round(v.auc - b.auc, 6) + 0.0 AS auc_delta,
  v.model_kb - b.model_kb AS model_kb_delta
FROM versions v LEFT JOIN (SELECT * FROM versions WHERE version = 1) b USING (name)""",
)
def compare_models(spark, folder):
    out = lk.compare_models(views.model_versions(spark, folder), ["auc", "model_kb"])
    return out.withColumn("auc_delta", r("auc_delta"))
