"""Mapping A: clinical tables on the star schema, one as_of for everybody."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortflow.functions.scalars import age_on, tolerant_number
from cohortflow.operators import cohort, features, labels, merge, quality, windows
from cohortflow.sources import scratch, tables
from workload.base import flag, query, r6, table, ts

AS_OF = "1998-06-30"
CODES = ["Brand#7"]
HBA1C, SBP, DBP = ["ECONOMY", "PROMO"], ["LARGE"], ["SMALL"]
POSITIVE = "1-urgent, 2-HIGH"
LOOKBACK, WINDOW = 180, 90
TIES = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
NUMERIC = "'^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$'"


def patients(spark: SparkSession, d: str) -> DataFrame:
    key = F.col("c_custkey")
    shift = F.pmod(key * 7919, F.lit(29000)).cast("int")
    return table(spark, d, "customer").select(
        key.alias("Id"), F.date_add(F.lit("1920-02-29").cast("date"), shift).alias("BirthDate")
    )


def lines(spark: SparkSession, d: str) -> DataFrame:
    """Order lines with their order and part."""
    item, order, part = (table(spark, d, n) for n in ("lineitem", "orders", "part"))
    return item.join(order, item.l_orderkey == order.o_orderkey).join(
        part, item.l_partkey == part.p_partkey
    )


def conditions(spark: SparkSession, d: str) -> DataFrame:
    """Lines meet their parts first: a filter on the code then leaves few to be joined with orders."""
    item, order, part = (table(spark, d, n) for n in ("lineitem", "orders", "part"))
    found = item.join(part, item.l_partkey == part.p_partkey).join(order, item.l_orderkey == order.o_orderkey)
    return found.select(F.col("o_custkey").alias("Patient"), F.col("p_brand").alias("Code"))


def encounters(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").select(
        F.col("o_custkey").alias("patient"),
        F.col("o_orderdate").alias("Start"),
        F.col("o_orderpriority").alias("EncounterClass"),
    )


def observations(spark: SparkSession, d: str) -> DataFrame:
    unusable = (F.col("l_returnflag") == "R") & (F.col("l_linenumber") == 1)
    return lines(spark, d).select(
        F.col("o_custkey").alias("patient"),
        F.col("l_shipdate").alias("Date"),
        F.col("p_type").alias("Code"),
        F.col("p_name").alias("Description"),
        F.when(unusable, "n/a").otherwise(F.col("l_quantity").cast("string")).alias("Value"),
        *TIES,
    )


def medications(spark: SparkSession, d: str) -> DataFrame:
    stop = F.when(F.col("l_linestatus") != "O", F.greatest("o_orderdate", "l_shipdate"))
    return lines(spark, d).select(
        F.col("o_custkey").alias("patient"),
        F.col("o_orderdate").alias("Start"),
        stop.alias("Stop"),
        F.col("p_name").alias("Description"),
    )


def index(spark: SparkSession, d: str) -> DataFrame:
    return cohort.build_cohort(
        patients(spark, d), conditions(spark, d), AS_OF, 18, CODES, time_type="timestamp_ntz"
    )


def feature_rows(spark: SparkSession, d: str, rows: DataFrame | None = None) -> DataFrame:
    return features.rolling_features(
        rows or index(spark, d), observations(spark, d), encounters(spark, d), medications(spark, d),
        LOOKBACK, HBA1C, SBP, DBP, ties=TIES, at=AS_OF,
    )


def label_rows(spark: SparkSession, d: str, rows: DataFrame | None = None) -> DataFrame:
    rows = rows or index(spark, d)
    return labels.make_labels(rows, encounters(spark, d), WINDOW, POSITIVE, at=AS_OF)


# The same tables in SQL.

AT = f"TIMESTAMP '{AS_OF}'"
AGE = (
    "CAST(year({on}) - year({born}) - CASE WHEN month({on}) * 100 + day({on}) < "
    "month({born}) * 100 + day({born}) THEN 1 ELSE 0 END AS INTEGER)"
)
AGE_AT = AGE.format(on=AT, born="birthdate")
LINES = (
    "lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey"
)
SQL_TABLES = f"""
patients AS (SELECT c_custkey AS id,
    DATE '1920-02-29' + CAST((c_custkey * 7919) % 29000 AS INTEGER) AS birthdate FROM customer),
conditions AS (SELECT o_custkey AS patient, p_brand AS code FROM {LINES}),
encounters AS (SELECT o_custkey AS patient, o_orderdate AS start,
    o_orderpriority AS encounterclass FROM orders),
observations AS (SELECT o_custkey AS patient, l_shipdate AS date, p_type AS code,
    p_name AS description,
    CASE WHEN l_returnflag = 'R' AND l_linenumber = 1 THEN 'n/a'
         ELSE CAST(l_quantity AS VARCHAR) END AS value,
    l_orderkey, l_linenumber, l_partkey, l_suppkey FROM {LINES}),
medications AS (SELECT o_custkey AS patient, o_orderdate AS start,
    CASE WHEN l_linestatus <> 'O' THEN greatest(o_orderdate, l_shipdate) END AS stop,
    p_name AS description FROM {LINES}),
cohort AS (SELECT id AS patient, {AGE_AT} AS age, {AT} AS as_of FROM patients
    WHERE {AGE_AT} >= 18 AND id IN (SELECT patient FROM conditions WHERE code = 'Brand#7'))"""
SQL_LABELS = f"""
labels AS (SELECT patient, as_of, CAST(EXISTS (SELECT 1 FROM encounters e
    WHERE e.patient = c.patient AND e.start > c.as_of
      AND e.start <= c.as_of + INTERVAL {WINDOW} DAY
      AND lower(e.encounterclass) IN ('1-urgent', '2-high')) AS INTEGER) AS label_90d
    FROM cohort c)"""
SQL_SEEN = f"""
seen AS (SELECT o.*, CASE WHEN regexp_matches(trim(value), {NUMERIC})
      THEN TRY_CAST(trim(value) AS DOUBLE) END AS num
    FROM observations o JOIN cohort c ON o.patient = c.patient
    WHERE o.date BETWEEN c.as_of - INTERVAL {LOOKBACK} DAY AND c.as_of)"""
RECENT = "date, l_orderkey, l_linenumber, l_partkey, l_suppkey"


def last_sql(codes: list[str], name: str) -> str:
    listed = ", ".join(f"'{c}'" for c in codes)
    newest = ", ".join(f"{c} DESC" for c in RECENT.split(", "))
    return f"""
{name} AS (SELECT patient, num AS v FROM (SELECT patient, num,
    row_number() OVER (PARTITION BY patient ORDER BY {newest}) AS k
    FROM seen WHERE code IN ({listed}) AND num IS NOT NULL) WHERE k = 1)"""


SQL_FEATURES = f"""{SQL_SEEN},
n_obs AS (SELECT patient, count(*) AS n FROM seen GROUP BY patient),
n_enc AS (SELECT c.patient, count(*) AS n FROM cohort c JOIN encounters e
    ON e.patient = c.patient AND e.start BETWEEN c.as_of - INTERVAL {LOOKBACK} DAY AND c.as_of
    GROUP BY c.patient),
n_med AS (SELECT c.patient, count(DISTINCT m.description) AS n FROM cohort c JOIN medications m
    ON m.patient = c.patient AND m.start <= c.as_of
      AND (m.stop IS NULL OR m.stop >= c.as_of - INTERVAL {LOOKBACK} DAY) GROUP BY c.patient),
hba AS (SELECT patient, avg(num) AS mean, stddev_pop(num) AS std FROM seen
    WHERE code IN ('ECONOMY', 'PROMO') AND num IS NOT NULL GROUP BY patient),
{last_sql(HBA1C, "hba_last")}, {last_sql(SBP, "sbp")}, {last_sql(DBP, "dbp")},
features AS (SELECT c.patient, c.as_of,
    CAST(coalesce(n_obs.n, 0) AS BIGINT) AS n_observations_180d,
    CAST(coalesce(n_enc.n, 0) AS BIGINT) AS n_encounters_180d,
    CAST(coalesce(n_med.n, 0) AS BIGINT) AS n_active_meds_180d,
    hba_last.v AS hba1c_last, hba.mean AS hba1c_mean, hba.std AS hba1c_std,
    sbp.v AS sbp_last, dbp.v AS dbp_last
    FROM cohort c LEFT JOIN n_obs USING (patient) LEFT JOIN n_enc USING (patient)
    LEFT JOIN n_med USING (patient) LEFT JOIN hba USING (patient)
    LEFT JOIN hba_last USING (patient) LEFT JOIN sbp USING (patient)
    LEFT JOIN dbp USING (patient))"""
FEATURE_NAMES = (
    "n_observations_180d n_encounters_180d n_active_meds_180d "
    "hba1c_last hba1c_mean hba1c_std sbp_last dbp_last"
).split()
DOUBLES = FEATURE_NAMES[3:]
FEATURE_OUTPUT = ", ".join(
    [f"{ts('as_of')} AS as_of", "patient", *FEATURE_NAMES[:3], *[f"{r6(f)} AS {f}" for f in DOUBLES]]
)


def sql(body: str, *extra: str) -> str:
    return f"WITH {SQL_TABLES}{''.join(',' + e for e in extra)}\n{body}"


# Cohort.


@query("code_filter", sql("SELECT patient, code FROM conditions WHERE code = 'Brand#7'"))
def code_filter(spark, d):
    return cohort.with_code(conditions(spark, d), CODES).toDF("patient", "code")


@query(
    "distinct_patients",
    sql("SELECT DISTINCT patient, 1 AS diabetes FROM conditions WHERE code = 'Brand#7'"),
)
def distinct_patients(spark, d):
    return cohort.code_holders(conditions(spark, d), CODES).toDF("patient", "diabetes")


@query("age_on", sql(f"SELECT id, {AGE_AT} AS age FROM patients"))
def age_query(spark, d):
    on = F.lit(AS_OF).cast("date")
    return patients(spark, d).select(F.col("Id").alias("id"), age_on(F.col("BirthDate"), on).alias("age"))


@query(
    "age_filter",
    sql(
        f"SELECT id, strftime(birthdate, '%Y-%m-%d') AS birthdate, {AGE_AT} AS age "
        f"FROM patients WHERE {AGE_AT} >= 18"
    ),
)
def age_filter(spark, d):
    return cohort.filter_by_age(patients(spark, d), AS_OF, 18).toDF("id", "birthdate", "age")


@query(
    "cohort_semi_join",
    sql(
        "SELECT id, strftime(birthdate, '%Y-%m-%d') AS birthdate FROM patients "
        "JOIN (SELECT DISTINCT patient FROM conditions WHERE code = 'Brand#7') ON id = patient"
    ),
)
def cohort_semi_join(spark, d):
    holders = cohort.code_holders(conditions(spark, d), CODES)
    return cohort.join_holders(patients(spark, d), holders).toDF("id", "birthdate")


@query("build_cohort", sql(f"SELECT patient, age, {ts('as_of')} AS as_of FROM cohort"))
def build_cohort(spark, d):
    return index(spark, d)


OWN_DATE = "DATE '1996-01-01' + CAST(id % 900 AS INTEGER)"


@query(
    "build_cohort_own_dates",
    sql(
        f"SELECT id AS patient, {AGE.format(on='day', born='birthdate')} AS age, "
        f"{ts('CAST(day AS TIMESTAMP)')} AS as_of FROM (SELECT *, CASE WHEN id % 11 <> 0 THEN {OWN_DATE} END AS day "
        f"FROM patients) WHERE {AGE.format(on='day', born='birthdate')} >= 18 "
        "AND id IN (SELECT patient FROM conditions WHERE code = 'Brand#7')"
    ),
)
def build_cohort_own_dates(spark, d):
    """Each patient's own reference date; some have none."""
    key = F.col("Id")
    own = F.when(key % 11 != 0, F.date_add(F.lit("1996-01-01").cast("date"), (key % 900).cast("int")))
    rows = patients(spark, d).withColumn("day", own)
    return cohort.build_cohort(rows, conditions(spark, d), F.col("day"), 18, CODES, time_type="timestamp_ntz")


# Labels.


@query(
    "class_counts",
    sql(
        "SELECT lower(encounterclass) AS encounter_class, count(*) AS n FROM encounters GROUP BY 1"
    ),
)
def class_counts(spark, d):
    return labels.class_counts(encounters(spark, d))


@query(
    "future_window_join",
    sql(
        f"SELECT c.patient, age, {ts('as_of')} AS as_of, {ts('start')} AS start, "
        "encounterclass FROM cohort c JOIN encounters e ON e.patient = c.patient "
        f"AND start > as_of AND start <= as_of + INTERVAL {WINDOW} DAY"
    ),
)
def future_window_join(spark, d):
    joined = windows.future_window_join(
        index(spark, d), encounters(spark, d), "Start", WINDOW, at=AS_OF
    )
    return joined.toDF("patient", "age", "as_of", "start", "encounterclass")


@query(
    "make_labels", sql(f"SELECT patient, {ts('as_of')} AS as_of, label_90d FROM labels", SQL_LABELS)
)
def make_labels(spark, d):
    return label_rows(spark, d)


@query(
    "label_distribution",
    sql(
        "SELECT label_90d AS label, count(*) AS n, "
        + r6("count(*) / (SELECT count(*) FROM labels)::DOUBLE")
        + " AS share FROM labels GROUP BY 1",
        SQL_LABELS,
    ),
)
def label_distribution(spark, d):
    return labels.label_distribution(label_rows(spark, d))


# Features.

OBS_OUT = f"patient, {ts('date')} AS date, code, description, value"


def _obs_out(df: DataFrame) -> DataFrame:
    return df.select(
        "patient", F.col("Date").alias("date"), F.col("Code").alias("code"),
        F.col("Description").alias("description"), F.col("Value").alias("value"),
    )


@query("obs_by_code", sql(f"SELECT {OBS_OUT} FROM observations WHERE code IN ('ECONOMY', 'PROMO')"))
def obs_by_code(spark, d):
    return _obs_out(features.observations_by_code(observations(spark, d), HBA1C))


@query(
    "obs_by_description",
    sql(f"SELECT {OBS_OUT} FROM observations WHERE regexp_matches(description, '(?i)RING')"),
)
def obs_by_description(spark, d):
    return _obs_out(features.observations_by_description(observations(spark, d), "RING"))


def _count_in_lookback(index_rows, events, time, name):
    return windows.lookback_aggregates(
        index_rows.select("patient", "as_of"), events, [windows.Count(name)], time, LOOKBACK, at=AS_OF
    )


@query(
    "lookback_obs_counts",
    sql(
        f"SELECT c.patient, {ts('as_of')} AS as_of, count(date) AS n_observations "
        "FROM cohort c LEFT JOIN observations o ON o.patient = c.patient "
        f"AND date BETWEEN as_of - INTERVAL {LOOKBACK} DAY AND as_of GROUP BY ALL"
    ),
)
def lookback_obs_counts(spark, d):
    return _count_in_lookback(index(spark, d), observations(spark, d), "Date", "n_observations")


@query(
    "lookback_enc_counts",
    sql(
        f"SELECT c.patient, {ts('as_of')} AS as_of, count(start) AS n_encounters "
        "FROM cohort c LEFT JOIN encounters e ON e.patient = c.patient "
        f"AND start BETWEEN as_of - INTERVAL {LOOKBACK} DAY AND as_of GROUP BY ALL"
    ),
)
def lookback_enc_counts(spark, d):
    return _count_in_lookback(index(spark, d), encounters(spark, d), "Start", "n_encounters")


@query(
    "interval_overlap_meds",
    sql(
        f"SELECT c.patient, {ts('as_of')} AS as_of, count(DISTINCT description) AS n_active_meds "
        "FROM cohort c LEFT JOIN medications m ON m.patient = c.patient AND start <= as_of "
        f"AND (stop IS NULL OR stop >= as_of - INTERVAL {LOOKBACK} DAY) GROUP BY ALL"
    ),
)
def interval_overlap_meds(spark, d):
    rows = index(spark, d).select("patient", "as_of")
    return windows.active_distinct(
        rows, medications(spark, d), "Start", "Stop", "Description", LOOKBACK, "n_active_meds", at=AS_OF
    )


MESSY_SQL = """CASE l_linenumber WHEN 1 THEN 'n/a' WHEN 2 THEN q || 'd' WHEN 3 THEN ' ' || q || ' '
    WHEN 4 THEN '-' || q WHEN 5 THEN q || 'e-1' WHEN 6 THEN '.' || l_suppkey ELSE q END"""


@query(
    "tolerant_numeric",
    f"""WITH texts AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, {MESSY_SQL} AS text
    FROM (SELECT *, CAST(l_quantity AS VARCHAR) AS q FROM lineitem))
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, text, {r6(
        f"CASE WHEN regexp_matches(trim(text), {NUMERIC}) THEN TRY_CAST(trim(text) AS DOUBLE) END"
    )} AS num FROM texts""",
)
def tolerant_numeric(spark, d):
    q, line = F.col("l_quantity").cast("string"), F.col("l_linenumber")
    text = (
        F.when(line == 1, "n/a")
        .when(line == 2, F.concat(q, F.lit("d")))
        .when(line == 3, F.concat(F.lit(" "), q, F.lit(" ")))
        .when(line == 4, F.concat(F.lit("-"), q))
        .when(line == 5, F.concat(q, F.lit("e-1")))
        .when(line == 6, F.concat(F.lit("."), F.col("l_suppkey").cast("string")))
        .otherwise(q)
    )
    rows = table(spark, d, "lineitem").select(*TIES, text.alias("text"))
    return rows.withColumn("num", tolerant_number(F.col("text")))


def _measures(spark, d, measures):
    return windows.lookback_aggregates(
        index(spark, d).select("patient", "as_of"), observations(spark, d), measures, "Date",
        LOOKBACK, at=AS_OF,
    )


@query(
    "last_numeric_value",
    sql(
        f"SELECT patient, {ts('as_of')} AS as_of, {r6('v')} AS hba1c_last "
        "FROM cohort LEFT JOIN hba_last USING (patient)",
        SQL_SEEN, last_sql(HBA1C, "hba_last"),
    ),
)
def last_numeric_value(spark, d):
    chosen = features.selector(HBA1C, "RING")
    return _measures(
        spark, d, [windows.Last("hba1c_last", tolerant_number(F.col("Value")), chosen, TIES)]
    )


@query(
    "numeric_stats",
    sql(
        f"SELECT c.patient, {ts('as_of')} AS as_of, {r6('avg(num)')} AS hba1c_mean, "
        f"{r6('stddev_pop(num)')} AS hba1c_std FROM cohort c LEFT JOIN seen s "
        "ON s.patient = c.patient AND code IN ('ECONOMY', 'PROMO') GROUP BY c.patient, as_of",
        SQL_SEEN,
    ),
)
def numeric_stats(spark, d):
    chosen = features.selector(HBA1C, "RING")
    return _measures(
        spark, d,
        [windows.Stats("hba1c_mean", "hba1c_std", tolerant_number(F.col("Value")), chosen)],
    )


@query(
    "selector_fallback",
    sql(
        f"SELECT c.patient, {ts('as_of')} AS as_of, "
        "CAST(count(*) FILTER (WHERE regexp_matches(description, '(?i)RING')) AS BIGINT) AS n_by_term, "
        "CAST(count(*) FILTER (WHERE code = 'LARGE') AS BIGINT) AS n_by_code "
        "FROM cohort c LEFT JOIN seen s ON s.patient = c.patient GROUP BY c.patient, as_of",
        SQL_SEEN,
    ),
)
def selector_fallback(spark, d):
    return _measures(
        spark, d,
        [
            windows.Count("n_by_term", features.selector("", "RING")),
            windows.Count("n_by_code", features.selector("LARGE", "RING")),
        ],
    )


@query("rolling_features", sql(f"SELECT {FEATURE_OUTPUT} FROM features", SQL_FEATURES))
def rolling_features(spark, d):
    return feature_rows(spark, d)


def _union(parts: list[str]) -> str:
    return " UNION ALL ".join(parts)


@query(
    "feature_nonnull",
    sql(
        _union(
            f"SELECT '{f}' AS feature, count({f}) AS n_nonnull, count(*) AS n_rows FROM features"
            for f in FEATURE_NAMES
        ),
        SQL_FEATURES,
    ),
)
def feature_nonnull(spark, d):
    return features.nonnull_counts(feature_rows(spark, d), FEATURE_NAMES)


HORIZONS = [30, 90, 180]


@query(
    "multi_horizon_counts",
    sql(
        f"SELECT c.patient, {ts('as_of')} AS as_of, "
        + ", ".join(
            f"CAST(count(*) FILTER (WHERE date >= as_of - INTERVAL {h} DAY) AS BIGINT) "
            f"AS n_obs_{h}d"
            for h in HORIZONS
        )
        + " FROM cohort c LEFT JOIN observations o ON o.patient = c.patient "
        "AND date BETWEEN as_of - INTERVAL 180 DAY AND as_of GROUP BY ALL"
    ),
)
def multi_horizon_counts(spark, d):
    rows = index(spark, d).select("patient", "as_of")
    return windows.count_horizons(
        rows, observations(spark, d), "Date", HORIZONS, "n_obs", at=AS_OF
    )


def _bands_sql(value: str, bands) -> str:
    whens = " ".join(f"WHEN {value} < {upper}::DOUBLE THEN '{n}'" for upper, n in bands[:-1])
    return f"CASE WHEN {value} IS NULL THEN NULL {whens} ELSE '{bands[-1][1]}' END"


def _banded_sql() -> str:
    from cohortflow import defaults as fixed

    # Quantities run from 1 to 50; these scales spread them over the bands.
    h, s, p = "hba1c_last / 4", "60 + 2 * sbp_last", "50 + dbp_last"
    return (
        f"SELECT patient, {r6(h)} AS hba1c, {r6(s)} AS sbp, {r6(p)} AS dbp, "
        f"{_bands_sql(h, fixed.HBA1C_BANDS)} AS hba1c_band, "
        f"{_bands_sql(s, fixed.SBP_BANDS)} AS sbp_band, "
        f"{_bands_sql(p, fixed.DBP_BANDS)} AS dbp_band FROM features"
    )


@query("clinical_bands", sql(_banded_sql(), SQL_FEATURES))
def clinical_bands(spark, d):
    scaled = feature_rows(spark, d).select(
        "patient",
        (F.col("hba1c_last") / 4).alias("hba1c"),
        (60 + 2 * F.col("sbp_last")).alias("sbp"),
        (50 + F.col("dbp_last")).alias("dbp"),
    )
    return features.clinical_bands(scaled, "hba1c", "sbp", "dbp")


# Merge and quality.


@query(
    "duplicate_keys",
    "SELECT CAST(sum(n - 1) AS BIGINT) AS n_duplicates FROM "
    "(SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)",
)
def duplicate_keys(spark, d):
    return merge.duplicate_keys(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


def _key_sides(spark, d):
    orders = table(spark, d, "orders").withColumnsRenamed(
        {"o_custkey": "patient", "o_orderdate": "as_of"}
    )
    urgent = orders.where(F.col("o_orderpriority") == "1-URGENT")
    filled = orders.where(F.col("o_orderstatus") == "F")
    return urgent.select("patient", "as_of"), filled.select("patient", "as_of")


SQL_SIDES = (
    "WITH l AS (SELECT DISTINCT o_custkey AS patient, o_orderdate AS as_of FROM orders "
    "WHERE o_orderpriority = '1-URGENT'), r AS (SELECT DISTINCT o_custkey AS patient, "
    "o_orderdate AS as_of FROM orders WHERE o_orderstatus = 'F') "
)


@query(
    "key_overlap",
    SQL_SIDES + "SELECT (SELECT count(*) FROM (FROM l INTERSECT FROM r)) AS n_both, "
    "(SELECT count(*) FROM (FROM l EXCEPT FROM r)) AS n_left_only, "
    "(SELECT count(*) FROM (FROM r EXCEPT FROM l)) AS n_right_only",
)
def key_overlap(spark, d):
    return merge.key_overlap(*_key_sides(spark, d))


@query(
    "keys_intersect",
    SQL_SIDES + f"SELECT patient, {ts('as_of')} AS as_of FROM (FROM l INTERSECT FROM r)",
)
def keys_intersect(spark, d):
    return merge.keys_intersect(*_key_sides(spark, d))


@query(
    "keys_except", SQL_SIDES + f"SELECT patient, {ts('as_of')} AS as_of FROM (FROM l EXCEPT FROM r)"
)
def keys_except(spark, d):
    return merge.keys_except(*_key_sides(spark, d))


def training_rows(spark, d):
    """Labels of every 17th patient are unknown, so that dropping them shows."""
    # Labels and features share one stored cohort, as separate stages would.
    rows = scratch.settle(index(spark, d), "cohort")
    known = label_rows(spark, d, rows).withColumn(
        "label_90d", F.when(F.col("patient") % 17 != 0, F.col("label_90d"))
    )
    return merge.merge_training(feature_rows(spark, d, rows), known)


SQL_TRAIN = f"""{SQL_LABELS},{SQL_FEATURES},
train AS (SELECT f.*, CASE WHEN patient % 17 <> 0 THEN label_90d END AS label_90d
    FROM features f JOIN labels USING (patient, as_of) WHERE patient % 17 <> 0)"""


@query("merge_training", sql(f"SELECT {FEATURE_OUTPUT}, label_90d FROM train", SQL_TRAIN))
def merge_training(spark, d):
    return training_rows(spark, d)


@query(
    "feature_completeness",
    sql(
        _union(
            f"SELECT '{f}' AS feature, {r6(f'100.0 * count({f}) / count(*)')} AS nonnull_pct, "
            f"count(*) - count({f}) AS n_missing, {flag(f'count({f}) = 0')} AS is_empty FROM train"
            for f in FEATURE_NAMES
        ),
        SQL_TRAIN,
    ),
)
def feature_completeness(spark, d):
    return quality.feature_completeness(training_rows(spark, d), FEATURE_NAMES)


@query(
    "empty_features",
    sql(
        "SELECT 'never_measured' AS feature FROM features "
        "HAVING count(CASE WHEN hba1c_last < 0 THEN 1 END) = 0",
        SQL_FEATURES,
    ),
)
def empty_features(spark, d):
    impossible = F.when(F.col("hba1c_last") < 0, F.col("hba1c_last"))
    rows = feature_rows(spark, d).withColumn("never_measured", impossible)
    return quality.empty_features(rows, [*FEATURE_NAMES, "never_measured"])


@query(
    "dataset_overview",
    sql(
        _union(
            f"SELECT '{name}' AS dataset, count(*) AS n_rows, 8 AS n_features, "
            f"{r6('avg(label_90d)')} AS positive_rate FROM train WHERE {where}"
            for name, where in (
                ("train", "n_observations_180d >= 2"), ("validation", "n_observations_180d < 2")
            )
        ),
        SQL_TRAIN,
    ),
)
def dataset_overview(spark, d):
    rows = scratch.settle(training_rows(spark, d), "training")
    often = F.col("n_observations_180d") >= 2
    return quality.dataset_overview(
        {"train": rows.where(often), "validation": rows.where(~often)}, FEATURE_NAMES
    )


@query(
    "sample_rows",
    sql(
        f"SELECT patient, label_90d, {r6('hba1c_last')} AS hba1c_last FROM train "
        "ORDER BY patient LIMIT 5",
        SQL_TRAIN,
    ),
)
def sample_rows(spark, d):
    wanted = ["patient", "label_90d", "hba1c_last", "prediction_proba"]
    return quality.sample_rows(training_rows(spark, d), wanted, ["patient"])


@query(
    "leakage_audit",
    sql(
        f"SELECT c.patient, {ts('as_of')} AS as_of, "
        f"count(*) FILTER (WHERE date BETWEEN as_of - INTERVAL {LOOKBACK} DAY AND as_of) "
        "AS n_in_window, count(*) FILTER (WHERE date > as_of) AS n_after, "
        f"count(*) FILTER (WHERE date < as_of - INTERVAL {LOOKBACK} DAY) AS n_before "
        "FROM cohort c LEFT JOIN observations o ON o.patient = c.patient GROUP BY c.patient, as_of"
    ),
)
def leakage_audit(spark, d):
    return quality.leakage_audit(index(spark, d), observations(spark, d), "Date", LOOKBACK, at=AS_OF)


@query(
    "target_correlation",
    sql(
        _union(
            f"SELECT '{f}' AS feature, {r6(f'corr({f}, label_90d)')} AS correlation, "
            f"{flag(f'abs(corr({f}, label_90d)) > 0.9')} AS leaks FROM train"
            for f in FEATURE_NAMES
        ),
        SQL_TRAIN,
    ),
)
def target_correlation(spark, d):
    return quality.target_correlation(training_rows(spark, d), FEATURE_NAMES)


# Sources and sinks.

ORDER_OUT = (
    "o_orderkey, o_custkey, o_orderstatus, round(o_totalprice, 6) + 0.0::DOUBLE AS o_totalprice, "
    f"{ts('o_orderdate')} AS o_orderdate, o_orderpriority"
)


@query("parquet_scan", f"SELECT {ORDER_OUT} FROM orders")
def parquet_scan(spark, d):
    return tables.read_parquet(spark, f"{d}/orders.parquet")


@query("parquet_roundtrip", f"SELECT {ORDER_OUT} FROM orders")
def parquet_roundtrip(spark, d):
    path = scratch.scratch_path(spark, "orders")
    tables.write_parquet(table(spark, d, "orders"), path)
    return tables.read_parquet(spark, path)


@query("csv_roundtrip", f"SELECT {ORDER_OUT} FROM orders")
def csv_roundtrip(spark, d):
    orders, path = table(spark, d, "orders"), scratch.scratch_path(spark, "orders-csv")
    tables.write_csv(orders, path)
    return tables.read_csv(spark, path, orders.schema)


@query(
    "events_by_month",
    sql(
        "SELECT patient, encounterclass, " + ts("start") + " AS start FROM encounters "
        f"WHERE start BETWEEN {AT} - INTERVAL {LOOKBACK} DAY AND {AT}"
    ),
)
def events_by_month(spark, d):
    path, rows = scratch.scratch_path(spark, "encounters"), encounters(spark, d)
    tables.land_events(rows, path, "Start")
    high = F.lit(AS_OF).cast("timestamp_ntz")
    found = tables.read_events(spark, path, "Start", high - F.expr(f"INTERVAL {LOOKBACK} DAYS"), high)
    return found.select("patient", "EncounterClass", "Start").toDF("patient", "encounterclass", "start")


TRAIN_COLUMNS = ["patient", "as_of", *FEATURE_NAMES, "label_90d"]


@query(
    "table_profile",
    sql(
        _union(
            f"SELECT '{c}' AS column_name, count(*) AS n_rows, 11 AS n_columns, "
            f"count(*) - count({c}) AS n_null FROM train"
            for c in TRAIN_COLUMNS
        ),
        SQL_TRAIN,
    ),
)
def table_profile(spark, d):
    return tables.table_profile(training_rows(spark, d))
