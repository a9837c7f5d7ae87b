"""Mappings F and G: run tables, scoring requests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortflow import defaults
from cohortflow.operators import runs, validate
from cohortflow.sources import scratch
from workload.base import flag, query, r6, table, ts

# Runs: one per user, parameters and metrics from the user's events.

METRICS = ["click", "error", "view"]
PARAMS = ["model_learning_rate", "model_n_estimators"]


def run_rows(spark: SparkSession, d: str) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("int")
    user = F.col("user_id")
    means = {m: F.avg(F.when(F.col("event_type") == m, F.col("value"))) for m in METRICS}
    odd = F.when(user % 3 == 0, F.lit(float("nan"))).when(user % 3 == 1, F.lit(float("inf")))
    return (
        table(spark, d, "events")
        .groupBy("user_id")
        .agg(
            F.min("ts").alias("start_time"),
            F.min(k).cast("string").alias("rate"),
            F.max(k).cast("string").alias("trees"),
            F.count("*").cast("string").alias("seed"),
            *[mean.alias(name) for name, mean in means.items()],
        )
        .select(
            F.concat(F.lit("run_"), user.cast("string")).alias("run_id"),
            F.when(user % 4 != 0, F.concat(F.lit("training_"), user.cast("string"))).alias("run_name"),
            "start_time",
            F.when(user % 5 == 0, "FAILED").otherwise("FINISHED").alias("status"),
            F.create_map(
                F.lit("model_learning_rate"), "rate", F.lit("model_n_estimators"), "trees",
                F.lit("random_seed"), "seed",
            ).alias("params"),
            F.create_map(
                *[part for m in METRICS for part in (F.lit(m), F.col(m))],
                F.lit("odd"), odd.otherwise(F.col("view")),
            ).alias("metrics"),
            F.create_map(F.lit("source"), F.lit("events")).alias("tags"),
        )
    )


SQL_RUNS = (
    """
runs AS (SELECT 'run_' || user_id AS run_id,
    CASE WHEN user_id % 4 <> 0 THEN 'training_' || user_id END AS run_name, min(ts) AS start_time,
    CASE WHEN user_id % 5 = 0 THEN 'FAILED' ELSE 'FINISHED' END AS status, user_id,
    CAST(min(CAST(json_extract_string(props, '$.k') AS INTEGER)) AS VARCHAR) AS rate,
    CAST(max(CAST(json_extract_string(props, '$.k') AS INTEGER)) AS VARCHAR) AS trees,
    CAST(count(*) AS VARCHAR) AS seed, """
    + ", ".join(f"avg(value) FILTER (WHERE event_type = '{m}') AS {m}" for m in METRICS)
    + " FROM events GROUP BY user_id)"
)


def stored_runs(spark: SparkSession, d: str) -> DataFrame:
    """Logged in two batches, one of them twice, then read back."""
    path, rows = scratch.scratch_path(spark, "runs"), run_rows(spark, d)
    for status in ("FINISHED", "FAILED", "FINISHED"):
        runs.log_runs(rows.where(F.col("status") == status), path, status)
    return spark.read.schema(rows.schema).parquet(path)


@query(
    "run_log",
    f"WITH {SQL_RUNS}, entries AS ("
    + " UNION ALL ".join(f"SELECT run_id, '{m}' AS key, {m} AS value FROM runs" for m in METRICS)
    + " UNION ALL SELECT run_id, 'odd', view FROM runs WHERE user_id % 3 = 2) "
    f"SELECT run_id, 'eval_' || key AS key, {r6('value')} AS value FROM entries WHERE value IS NOT NULL",
)
def run_log(spark, d):
    named = stored_runs(spark, d).withColumn(
        "metrics", runs.prefixed(F.col("metrics"), F.lit("eval"))
    )
    return runs.metric_rows(named)


@query(
    "best_run",
    f"WITH {SQL_RUNS} SELECT run_id, status, {r6('view')} AS view FROM runs "
    "ORDER BY view DESC NULLS LAST, run_id LIMIT 1",
)
def best_run(spark, d):
    best = runs.best_run(run_rows(spark, d), "view")
    return best.select("run_id", "status", F.col("metrics")["view"].alias("view"))


METRICS_OUT = ", ".join(f"{r6(m)} AS metric_{m}" for m in METRICS)


@query(
    "compare_runs",
    f"WITH {SQL_RUNS} SELECT run_id, coalesce(run_name, 'Unknown') AS run_name, "
    f"{ts('start_time')} AS start_time, status, {METRICS_OUT}, rate AS param_model_learning_rate, "
    "trees AS param_model_n_estimators, seed AS param_random_seed FROM runs WHERE status = 'FAILED'",
)
def compare_runs(spark, d):
    rows = run_rows(spark, d)
    failed = rows.where(F.col("status") == "FAILED").select("run_id")
    return runs.compare_runs(rows, failed, METRICS, [*PARAMS, "random_seed"])


@query(
    "run_entries",
    f"WITH {SQL_RUNS} "
    + " UNION ALL ".join(
        [f"SELECT run_id, 'metric' AS kind, '{m}' AS key, NULL AS text, {r6(m)} AS number FROM runs WHERE {m} IS NOT NULL" for m in METRICS]
        + ["SELECT run_id, 'metric', 'odd', NULL, round(view, 6) FROM runs WHERE user_id % 3 = 2 AND view IS NOT NULL"]
        + [
            f"SELECT run_id, 'param', '{key}', {column}, NULL FROM runs"
            for key, column in (("model_learning_rate", "rate"), ("model_n_estimators", "trees"), ("random_seed", "seed"))
        ]
    ),
)
def run_entries(spark, d):
    return runs.run_entries(stored_runs(spark, d))


@query(
    "compare_experiment",
    f"WITH {SQL_RUNS} SELECT run_id, {ts('start_time')} AS start_time, status, "
    + ", ".join(f"{r6(m)} AS {m}" for m in METRICS)
    + ", rate AS param_model_learning_rate, trees AS param_model_n_estimators FROM runs",
)
def compare_experiment(spark, d):
    return runs.compare_experiment(run_rows(spark, d), METRICS, [*PARAMS, "random_seed"])


@query(
    "model_versions",
    f"SELECT CAST(event_id AS VARCHAR) AS version, CASE WHEN value > 100 THEN 'Production' "
    f"ELSE 'Staging' END AS stage, {ts('ts')} AS creation_timestamp, 'run_' || user_id AS run_id, "
    "'READY' AS status FROM events WHERE event_type = 'purchase'",
)
def model_versions(spark, d):
    versions = table(spark, d, "events").select(
        F.col("event_type").alias("name"),
        F.col("event_id").cast("string").alias("version"),
        F.when(F.col("value") > 100, "Production").otherwise("Staging").alias("current_stage"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("creation_timestamp"),
        F.concat(F.lit("run_"), F.col("user_id").cast("string")).alias("run_id"),
        F.lit("READY").alias("status"),
    )
    return runs.model_versions(versions, "purchase")


@query(
    "flatten_params",
    "SELECT c_custkey, 'cfg_segment' AS key, c_mktsegment AS value FROM customer UNION ALL "
    "SELECT c_custkey, 'cfg_account_nation', CAST(c_nationkey AS VARCHAR) FROM customer UNION ALL "
    "SELECT c_custkey, 'cfg_account_name_text', c_name FROM customer",
)
def flatten_params(spark, d):
    name = F.struct(F.col("c_name").alias("text"))
    account = F.struct(F.col("c_nationkey").alias("nation"), name.alias("name"))
    nested = table(spark, d, "customer").select(
        "c_custkey", F.struct(F.col("c_mktsegment").alias("segment"), account.alias("account")).alias("cfg")
    )
    return runs.flatten_params(nested, "cfg", ["c_custkey"], "cfg_")


# Requests: one per customer; a nation's customers form a batch.


def requests(spark: SparkSession, d: str) -> DataFrame:
    key = F.col("c_custkey")

    def unless(divisor: int, value):
        return F.when(key % divisor != 0, value)

    return table(spark, d, "customer").select(
        F.col("c_nationkey").alias("batch_id"),
        F.when(key % 97 == 0, "")
        .when(key % 101 == 0, F.repeat(F.lit("x"), 101))
        .otherwise(F.concat(F.lit("patient_"), (key % 1400).cast("string")))
        .alias("patient_id"),
        F.when(key % 4 == 0, "2024-1-5").when(key % 4 == 1, "2024-02-30").when(key % 4 == 2, "2024-06-01")
        .alias("as_of_date"),
        (key % 1200).alias("n_observations_180d"),
        unless(23, key % 110).alias("n_encounters_180d"),
        (key % 52 - 1).alias("n_active_meds_180d"),
        unless(7, F.lit(2.0) + (key % 140) / 10.0).alias("hba1c_last"),
        unless(11, F.lit(2.0) + (key % 90) / 10.0).alias("hba1c_mean"),
        unless(13, (key % 60) / 10.0).alias("hba1c_std"),
        unless(17, (key % 220 + 50).cast("double")).alias("sbp_last"),
        unless(19, (key % 130 + 35).cast("double")).alias("dbp_last"),
        key.alias("request"),
    )


SQL_REQUESTS = """
requests AS (SELECT c_custkey AS request, c_nationkey AS batch_id,
    CASE WHEN c_custkey % 97 = 0 THEN '' WHEN c_custkey % 101 = 0 THEN repeat('x', 101)
      ELSE 'patient_' || (c_custkey % 1400) END AS patient_id,
    CASE c_custkey % 4 WHEN 0 THEN '2024-1-5' WHEN 1 THEN '2024-02-30' WHEN 2 THEN '2024-06-01' END
      AS as_of_date,
    c_custkey % 1200 AS n_observations_180d,
    CASE WHEN c_custkey % 23 <> 0 THEN c_custkey % 110 END AS n_encounters_180d,
    c_custkey % 52 - 1 AS n_active_meds_180d,
    CASE WHEN c_custkey % 7 <> 0 THEN 2::DOUBLE + (c_custkey % 140) / 10::DOUBLE END AS hba1c_last,
    CASE WHEN c_custkey % 11 <> 0 THEN 2::DOUBLE + (c_custkey % 90) / 10::DOUBLE END AS hba1c_mean,
    CASE WHEN c_custkey % 13 <> 0 THEN (c_custkey % 60) / 10::DOUBLE END AS hba1c_std,
    CASE WHEN c_custkey % 17 <> 0 THEN (c_custkey % 220 + 50)::DOUBLE END AS sbp_last,
    CASE WHEN c_custkey % 19 <> 0 THEN (c_custkey % 130 + 35)::DOUBLE END AS dbp_last
    FROM customer)"""


def _range_sql() -> str:
    parts = []
    for feature, (low, high, required) in defaults.FEATURE_RANGES.items():
        if required:
            parts.append(f"CASE WHEN {feature} IS NULL THEN '{feature}:missing' END")
        parts.append(
            f"CASE WHEN NOT {feature} BETWEEN {low} AND {high} THEN '{feature}:range' END"
        )
    return ", ".join(parts)


CROSS_SQL = """
CASE WHEN hba1c_mean BETWEEN 3 AND 15 AND hba1c_last BETWEEN 3 AND 15
  AND abs(hba1c_mean - hba1c_last) > 3::DOUBLE THEN 'hba1c_mean:inconsistent' END,
CASE WHEN dbp_last BETWEEN 40 AND 150 AND sbp_last BETWEEN 60 AND 250
  AND dbp_last >= sbp_last THEN 'dbp_last:not_below_sbp' END"""
REQUEST_SQL = """
CASE WHEN length(patient_id) NOT BETWEEN 1 AND 100 THEN 'patient_id:length' END,
CASE WHEN as_of_date IS NOT NULL AND try_strptime(as_of_date, '%Y-%m-%d') IS NULL
  THEN 'as_of_date:format' END"""


def _checked(parts: str) -> str:
    return (
        f"WITH {SQL_REQUESTS} SELECT request, errors, {flag('length(errors) = 0')} AS valid "
        f"FROM (SELECT request, concat_ws(',', {parts}) AS errors FROM requests)"
    )


def _checks(spark, d, errors):
    text = F.concat_ws(",", errors)
    return requests(spark, d).select(
        "request", text.alias("errors"), (F.length(text) == 0).alias("valid")
    )


@query("range_checks", _checked(_range_sql()))
def range_checks(spark, d):
    return _checks(spark, d, validate.range_errors())


@query("cross_field_checks", _checked(CROSS_SQL))
def cross_field_checks(spark, d):
    return _checks(spark, d, validate.cross_field_errors())


@query("request_checks", _checked(REQUEST_SQL))
def request_checks(spark, d):
    return _checks(spark, d, validate.request_errors())


@query(
    "batch_checks",
    f"WITH {SQL_REQUESTS} SELECT batch_id, CAST(sum(n) AS BIGINT) AS n_requests, "
    "count(*) FILTER (WHERE n > 1) AS n_duplicate_ids, "
    f"{flag('sum(n) BETWEEN 1 AND 1000')} AS size_ok, "
    f"{flag('count(*) FILTER (WHERE n > 1) = 0')} AS unique_ok FROM "
    "(SELECT batch_id, patient_id, count(*) AS n FROM requests GROUP BY 1, 2) GROUP BY 1",
)
def batch_checks(spark, d):
    return validate.batch_checks(requests(spark, d))


@query(
    "canonical_features",
    f"WITH {SQL_REQUESTS} SELECT request, "
    + ", ".join(
        f"{r6('NULL' if f == 'hba1c_std' else f)} AS {f}" for f in defaults.FEATURES
    )
    + " FROM requests",
)
def canonical_features(spark, d):
    return validate.canonical_features(requests(spark, d).drop("hba1c_std"), ["request"])


def responses(spark: SparkSession, d: str) -> DataFrame:
    raw = F.coalesce(F.col("hba1c_last") / 16.0, F.lit(0.2))
    return validate.batch_response(
        validate.check_requests(requests(spark, d)), raw, F.lit(0.1) + F.lit(0.8) * raw
    )


SQL_RESPONSES = f"""{SQL_REQUESTS},
responses AS (SELECT *, CASE WHEN length(errors) = 0 THEN 0.1::DOUBLE + 0.8::DOUBLE
      * coalesce(hba1c_last / 16::DOUBLE, 0.2::DOUBLE) END AS risk_score
    FROM (SELECT *, concat_ws(',', {REQUEST_SQL}, {_range_sql()}, {CROSS_SQL}) AS errors
          FROM requests))"""


@query(
    "batch_response",
    f"WITH {SQL_RESPONSES} SELECT request, {r6('risk_score')} AS risk_score, "
    "CASE WHEN risk_score >= 0.5 THEN 'high' WHEN risk_score >= 0.25 THEN 'medium' "
    "WHEN risk_score IS NOT NULL THEN 'low' END AS risk_level, "
    f"{r6('CASE WHEN risk_score IS NOT NULL THEN least(0.5::DOUBLE + abs(risk_score - 0.5::DOUBLE), 1) END')}"
    " AS confidence FROM responses",
)
def batch_response(spark, d):
    return responses(spark, d).select("request", "risk_score", "risk_level", "confidence")


@query(
    "quarantine",
    f"WITH {SQL_RESPONSES} SELECT request, errors FROM responses WHERE risk_score IS NULL",
)
def quarantine(spark, d):
    bad = validate.quarantine(responses(spark, d))
    return bad.select("request", F.concat_ws(",", "errors").alias("errors"))


@query(
    "batch_score_summary",
    f"WITH {SQL_RESPONSES} SELECT batch_id, count(risk_score) AS processed_count, "
    "count(*) - count(risk_score) AS failed_count FROM responses GROUP BY 1",
)
def batch_score_summary(spark, d):
    return validate.batch_score_summary(responses(spark, d))
