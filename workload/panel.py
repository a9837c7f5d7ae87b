"""Mapping B: many index dates per entity - users x days, events as clinical tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortflow.operators import features, labels, quality, train, windows
from cohortflow.sources import scratch
from workload.base import flag, query, r6, table, ts


FIRST_DAY, LAST_DAY = "2024-01-08", "2024-01-28"
LOOKBACK = 7
HBA1C, SBP, DBP = ["view", "signup"], ["click"], ["purchase"]


def index(spark: SparkSession, d: str) -> DataFrame:
    first, last = (F.lit(day).cast("timestamp_ntz") for day in (FIRST_DAY, LAST_DAY))
    day_list = F.sequence(first, last, F.expr("INTERVAL 1 DAY"))
    users = table(spark, d, "events").select(F.col("user_id").alias("patient")).distinct()
    # Windows read their index several times, so it is stored first.
    return scratch.settle(users.select("patient", F.explode(day_list).alias("as_of")), "index")


def offgrid_index(spark: SparkSession, d: str) -> DataFrame:
    """The index with a time of day: midnight, 05:37:11, 11:14:22 or 16:51:33."""
    seconds = (F.col("patient") + F.dayofmonth("as_of")) % 4 * 20_231
    moved = F.col("as_of") + F.make_dt_interval(secs=seconds.cast("decimal(18, 6)"))
    return scratch.settle(index(spark, d).select("patient", moved.alias("as_of")), "index")


def observations(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select(
        F.col("user_id").alias("patient"),
        F.col("ts").alias("Date"),
        F.col("event_type").alias("Code"),
        F.col("event_type").alias("Description"),
        F.when(F.col("event_id") % 11 == 0, "n/a")
        .otherwise(F.col("value").cast("string"))
        .alias("Value"),
        "event_id",
    )


def encounters(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select(
        F.col("user_id").alias("patient"),
        F.col("ts").alias("Start"),
        F.col("event_type").alias("EncounterClass"),
    )


def medications(spark: SparkSession, d: str) -> DataFrame:
    key = F.col("event_id")
    length = F.make_dt_interval((key % 5).cast("int"))
    return table(spark, d, "events").select(
        F.col("user_id").alias("patient"),
        F.col("ts").alias("Start"),
        F.when(key % 7 != 0, F.col("ts") + length).alias("Stop"),
        F.when(key % 13 != 0, F.concat(F.lit("item"), (key % 40).cast("string"))).alias("Description"),
    )


def feature_rows(spark: SparkSession, d: str, rows: DataFrame | None = None) -> DataFrame:
    return features.rolling_features(
        rows or index(spark, d), observations(spark, d), encounters(spark, d), medications(spark, d),
        LOOKBACK, HBA1C, SBP, DBP, ties=["event_id"],
    )


def label_rows(spark: SparkSession, d: str, rows: DataFrame | None = None) -> DataFrame:
    return labels.make_labels(rows or index(spark, d), encounters(spark, d), 1, ["Error"])


def training_rows(spark: SparkSession, d: str) -> DataFrame:
    rows = index(spark, d)
    return feature_rows(spark, d, rows).join(windows.dealt(label_rows(spark, d, rows)), ["patient", "as_of"])


SQL_INDEX = f"""
idx AS (SELECT patient, as_of FROM (SELECT DISTINCT user_id AS patient FROM events),
    (SELECT unnest(generate_series(TIMESTAMP '{FIRST_DAY}', TIMESTAMP '{LAST_DAY}',
     INTERVAL 1 DAY)) AS as_of))"""
SQL_OFFGRID = f"""
days AS (SELECT patient, day FROM (SELECT DISTINCT user_id AS patient FROM events),
    (SELECT unnest(generate_series(TIMESTAMP '{FIRST_DAY}', TIMESTAMP '{LAST_DAY}',
     INTERVAL 1 DAY)) AS day)),
idx AS (SELECT patient, day + ((patient + day(day)) % 4 * 20231) * INTERVAL 1 SECOND AS as_of
    FROM days)"""
SQL_LABELS = """
labels AS (SELECT patient, as_of, CAST(count(e.ts) > 0 AS INTEGER) AS label_90d FROM idx
    LEFT JOIN events e ON user_id = patient AND event_type = 'error'
      AND ts > as_of AND ts <= as_of + INTERVAL 1 DAY GROUP BY patient, as_of)"""
SEEN = f"""
seen AS (SELECT patient, as_of, event_id, ts, event_type,
    CASE WHEN event_id % 11 <> 0 THEN value END AS num
    FROM idx JOIN events ON user_id = patient
      AND ts BETWEEN as_of - INTERVAL {LOOKBACK} DAY AND as_of)"""
SQL_FEATURES = f"""{SEEN},
counts AS (SELECT patient, as_of, count(*) AS n,
    avg(num) FILTER (WHERE event_type IN ('view', 'signup')) AS mean,
    stddev_pop(num) FILTER (WHERE event_type IN ('view', 'signup')) AS std,
    arg_max(num, ts) FILTER (WHERE event_type IN ('view', 'signup') AND num IS NOT NULL) AS h,
    arg_max(num, ts) FILTER (WHERE event_type = 'click' AND num IS NOT NULL) AS s,
    arg_max(num, ts) FILTER (WHERE event_type = 'purchase' AND num IS NOT NULL) AS p
    FROM seen GROUP BY patient, as_of),
meds AS (SELECT patient, as_of, count(DISTINCT 'item' || (event_id % 40)) AS n
    FROM idx JOIN events ON user_id = patient AND event_id % 13 <> 0 AND ts <= as_of
      AND (event_id % 7 = 0 OR ts + (event_id % 5) * INTERVAL 1 DAY
           >= as_of - INTERVAL {LOOKBACK} DAY) GROUP BY patient, as_of),
features AS (SELECT patient, as_of,
    CAST(coalesce(counts.n, 0) AS BIGINT) AS n_observations_180d,
    CAST(coalesce(counts.n, 0) AS BIGINT) AS n_encounters_180d,
    CAST(coalesce(meds.n, 0) AS BIGINT) AS n_active_meds_180d,
    h AS hba1c_last, mean AS hba1c_mean, std AS hba1c_std, s AS sbp_last, p AS dbp_last
    FROM idx LEFT JOIN counts USING (patient, as_of) LEFT JOIN meds USING (patient, as_of))"""


def sql(body: str, *extra: str) -> str:
    return f"WITH {SQL_INDEX}{''.join(',' + e for e in extra)}\n{body}"


KEYS_OUT = f"patient, {ts('as_of')} AS as_of"
COUNTS = ["n_observations_180d", "n_encounters_180d", "n_active_meds_180d"]
DOUBLES = ["hba1c_last", "hba1c_mean", "hba1c_std", "sbp_last", "dbp_last"]


def off_the_grid(text: str) -> str:
    """The SQL over the index rows that have a time of day."""
    return text.replace(SQL_INDEX, SQL_OFFGRID)


PANEL_LABELS = sql(f"SELECT {KEYS_OUT}, label_90d FROM labels", SQL_LABELS)
PANEL_FEATURES = sql(
    f"SELECT {KEYS_OUT}, {', '.join(COUNTS)}, "
    + ", ".join(f"{r6(f)} AS {f}" for f in DOUBLES)
    + " FROM features",
    SQL_FEATURES,
)
PANEL_HORIZONS = sql(
    f"SELECT {KEYS_OUT}, "
    + ", ".join(
        f"CAST(count(ts) FILTER (WHERE ts >= as_of - INTERVAL {h} DAY) AS BIGINT) AS n_obs_{h}d"
        for h in (1, 3, 7)
    )
    + " FROM idx LEFT JOIN events ON user_id = patient "
    "AND ts BETWEEN as_of - INTERVAL 7 DAY AND as_of GROUP BY patient, as_of"
)
PANEL_AUDIT = sql(
    f"SELECT {KEYS_OUT}, "
    f"count(*) FILTER (WHERE ts BETWEEN as_of - INTERVAL {LOOKBACK} DAY AND as_of) "
    "AS n_in_window, count(*) FILTER (WHERE ts > as_of) AS n_after, "
    f"count(*) FILTER (WHERE ts < as_of - INTERVAL {LOOKBACK} DAY) AS n_before "
    "FROM idx JOIN events ON user_id = patient GROUP BY patient, as_of"
)


@query("make_labels_panel", PANEL_LABELS)
def make_labels_panel(spark, d):
    return label_rows(spark, d)


@query("make_labels_offgrid", off_the_grid(PANEL_LABELS))
def make_labels_offgrid(spark, d):
    return label_rows(spark, d, offgrid_index(spark, d))


@query("rolling_features_panel", PANEL_FEATURES)
def rolling_features_panel(spark, d):
    return feature_rows(spark, d)


@query("rolling_features_offgrid", off_the_grid(PANEL_FEATURES))
def rolling_features_offgrid(spark, d):
    return feature_rows(spark, d, offgrid_index(spark, d))


@query(
    "future_window_join_panel",
    sql(
        f"SELECT {KEYS_OUT}, {ts('ts')} AS start, event_type AS encounterclass FROM idx "
        "JOIN events ON user_id = patient AND ts > as_of AND ts <= as_of + INTERVAL 1 DAY"
    ),
)
def future_window_join_panel(spark, d):
    joined = windows.future_window_join(index(spark, d), encounters(spark, d), "Start", 1)
    return joined.select(
        "patient", "as_of", F.col("Start").alias("start"),
        F.col("EncounterClass").alias("encounterclass"),
    )


def horizon_rows(spark: SparkSession, d: str, rows: DataFrame) -> DataFrame:
    return windows.count_horizons(rows, observations(spark, d), "Date", [1, 3, 7], "n_obs")


def audit_rows(spark: SparkSession, d: str, rows: DataFrame) -> DataFrame:
    return quality.leakage_audit(rows, observations(spark, d), "Date", LOOKBACK)


@query("multi_horizon_counts_panel", PANEL_HORIZONS)
def multi_horizon_counts_panel(spark, d):
    return horizon_rows(spark, d, index(spark, d))


@query("multi_horizon_counts_offgrid", off_the_grid(PANEL_HORIZONS))
def multi_horizon_counts_offgrid(spark, d):
    return horizon_rows(spark, d, offgrid_index(spark, d))


@query("leakage_audit_panel", PANEL_AUDIT)
def leakage_audit_panel(spark, d):
    return audit_rows(spark, d, index(spark, d))


@query("leakage_audit_offgrid", off_the_grid(PANEL_AUDIT))
def leakage_audit_offgrid(spark, d):
    return audit_rows(spark, d, offgrid_index(spark, d))


@query(
    "stratified_split",
    sql(
        f"SELECT {KEYS_OUT}, label_90d, CAST(k <= ceil(0.25::DOUBLE * n) AS INTEGER) AS is_validation "
        "FROM (SELECT *, count(*) OVER (PARTITION BY label_90d) AS n, row_number() OVER "
        "(PARTITION BY label_90d ORDER BY md5('42:' || patient || ':' || CAST(as_of AS VARCHAR))) "
        "AS k FROM labels)",
        SQL_LABELS,
    ),
)
def stratified_split(spark, d):
    # The split reads its input three times, so it gets a stored table.
    rows = scratch.settle(label_rows(spark, d), "labels")
    return train.stratified_split(rows, ["patient", "as_of"])


@query(
    "split_by_time",
    sql(
        f"SELECT {KEYS_OUT}, label_90d, {flag(f'''as_of >= TIMESTAMP '2024-01-22' ''')} "
        "AS is_validation FROM labels",
        SQL_LABELS,
    ),
)
def split_by_time(spark, d):
    cutoff = F.lit("2024-01-22").cast("timestamp_ntz")
    return train.split_by_time(label_rows(spark, d), cutoff)


@query(
    "time_folds",
    sql(
        f"""SELECT CAST(fold AS INTEGER) AS fold, {ts('valid_from')} AS valid_from, {ts('valid_until')} AS valid_until,
          (SELECT count(*) FROM labels WHERE as_of < valid_from) AS n_train,
          (SELECT count(*) FROM labels WHERE as_of >= valid_from AND as_of < valid_until) AS n_valid FROM (
          SELECT fold, low + to_microseconds(CAST(fold * part AS BIGINT)) AS valid_from,
            low + to_microseconds(CAST((fold + 1) * part AS BIGINT)) AS valid_until FROM (
            SELECT min(as_of) AS low, ceil((epoch_us(max(as_of)) - epoch_us(min(as_of)) + 1) / 5.0) AS part FROM labels),
            range(1, 5) t(fold))""",
        SQL_LABELS,
    ),
)
def time_folds(spark, d):
    return train.fold_bounds(scratch.settle(label_rows(spark, d), "labels"), 4)


@query(
    "class_weights",
    sql(
        f"SELECT label_90d AS label, count(*) AS n, "
        f"{r6('(SELECT count(*) FROM labels) / (2.0::DOUBLE * count(*))')} AS weight "
        "FROM labels GROUP BY 1",
        SQL_LABELS,
    ),
)
def class_weights(spark, d):
    return train.class_weights(label_rows(spark, d))
