"""Mappings D, E and F: drift, group bias, metric history and retraining."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortflow import defaults
from cohortflow.functions.pvalues import KOLMOGOROV_ONE_BELOW, KOLMOGOROV_TERMS
from cohortflow.functions.scalars import ERFC_COEFFICIENTS, ERFC_P
from cohortflow.operators import drift, fairness, performance, quality, report
from cohortflow.sources import reports, scratch
from workload.base import flag, query, r6, table

# D: lines before and after a date.

FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "taxed"]
SPLIT = "1998-07-01"


def line_sides(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    rows = table(spark, d, "lineitem").withColumn("taxed", F.nullif("l_tax", F.lit(0.0)))
    early = F.col("l_shipdate") < F.lit(SPLIT).cast("timestamp_ntz")
    return rows.where(early).select(*FEATURES), rows.where(~early).select(*FEATURES)


def event_sides(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """The later events' values grow by a fifth, which is drift."""
    rows = table(spark, d, "events")
    early = F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz")
    late = rows.where(~early).select((F.col("value") * 1.2).alias("value"))
    return rows.where(early).select("value"), late


def _long_sql(source: str, features: list[str], side: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{f}' AS feature, {f} AS v, {side} AS ref FROM {source} WHERE {f} IS NOT NULL"
        for f in features
    )


SQL_LINES = f"""
rows AS (SELECT *, nullif(l_tax, 0) AS taxed, l_shipdate < TIMESTAMP '{SPLIT}' AS early
    FROM lineitem),
long AS ({_long_sql("rows", FEATURES, "CAST(early AS INTEGER)")})"""
SQL_EVENTS = """
long AS (SELECT 'value' AS feature,
    CASE WHEN ts < TIMESTAMP '2024-01-16' THEN value ELSE value * 1.2::DOUBLE END AS v,
    CAST(ts < TIMESTAMP '2024-01-16' AS INTEGER) AS ref FROM events)"""


def erfc_sql(x: str) -> str:
    t = f"(1.0::DOUBLE / (1.0::DOUBLE + {ERFC_P}::DOUBLE * {x}))"
    polynomial = "0.0::DOUBLE"
    for c in reversed(ERFC_COEFFICIENTS):
        polynomial = f"(({polynomial} + {c}::DOUBLE) * {t})"
    return f"({polynomial} * exp(-{x} * {x}))"


KOLMOGOROV = (
    f"CASE WHEN lambda_ < {KOLMOGOROV_ONE_BELOW} THEN 1.0::DOUBLE ELSE greatest(0.0::DOUBLE, "
    "least(1.0::DOUBLE, 2.0::DOUBLE * (SELECT sum(CASE WHEN k % 2 = 1 THEN 1.0::DOUBLE "
    "ELSE -1.0::DOUBLE END * exp(-2.0::DOUBLE * k * k * lambda_ * lambda_)) "
    f"FROM range(1, {KOLMOGOROV_TERMS + 1}) t(k)))) END"
)
TESTS = f"""
counts AS (SELECT feature, v, sum(ref)::DOUBLE AS a, sum(1 - ref)::DOUBLE AS b
    FROM long GROUP BY 1, 2),
placed AS (SELECT *, sum(a) OVER w AS ca, sum(b) OVER w AS cb,
    sum(a) OVER (PARTITION BY feature) AS n1, sum(b) OVER (PARTITION BY feature) AS n2
    FROM counts WINDOW w AS (PARTITION BY feature ORDER BY v)),
sums AS (SELECT feature, max(n1) AS n1, max(n2) AS n2, max(abs(ca / n1 - cb / n2)) AS dist,
    sum(a * (ca - a + cb - b + (a + b + 1) / 2)) - max(n1) * (max(n1) + 1) / 2 AS u,
    sum((a + b) ** 3 - (a + b)) AS ties FROM placed GROUP BY feature),
stats AS (SELECT *, (sqrt(n1 * n2 / (n1 + n2)) + 0.12::DOUBLE
      + 0.11::DOUBLE / sqrt(n1 * n2 / (n1 + n2))) * dist AS lambda_,
    (greatest(u, n1 * n2 - u) - n1 * n2 / 2 - 0.5) / sqrt(n1 * n2 / 12
      * ((n1 + n2 + 1) - ties / ((n1 + n2) * (n1 + n2 - 1)))) AS z FROM sums),
tests AS (SELECT feature, dist AS ks_statistic, {KOLMOGOROV} AS ks_p_value, u AS mw_statistic,
    z AS mw_z, least(1.0::DOUBLE, {erfc_sql("(greatest(z, 0) / sqrt(2::DOUBLE))")}) AS mw_p_value
    FROM stats)"""
EDGES = " + ".join(
    f"CAST(v >= lo + {i}::DOUBLE * ((hi - lo) / 10::DOUBLE) AS INTEGER)" for i in range(1, 10)
)
PSI = f"""
ranges AS (SELECT feature, min(v) FILTER (WHERE ref = 1) AS lo, max(v) FILTER (WHERE ref = 1) AS hi,
    sum(ref)::DOUBLE AS n1, sum(1 - ref)::DOUBLE AS n2 FROM long GROUP BY feature),
shares AS (SELECT feature, greatest(sum(ref) / max(n1), CASE WHEN sum(ref) = 0 THEN 0.0001 ELSE 0 END)
      AS r, CASE WHEN sum(1 - ref) = 0 THEN 0.0001::DOUBLE ELSE sum(1 - ref) / max(n2) END AS c
    FROM (SELECT feature, ref, n1, n2, {EDGES} AS bin FROM long JOIN ranges USING (feature))
    GROUP BY feature, bin),
psi AS (SELECT feature, sum((c - r) * ln(c / r)) AS psi FROM shares GROUP BY feature)"""
MOMENTS = """
moments AS (SELECT feature,
    avg(v) FILTER (WHERE ref = 1) AS ref_mean, stddev_samp(v) FILTER (WHERE ref = 1) AS ref_std,
    count(v) FILTER (WHERE ref = 1) AS ref_count,
    avg(v) FILTER (WHERE ref = 0) AS cur_mean, stddev_samp(v) FILTER (WHERE ref = 0) AS cur_std,
    count(v) FILTER (WHERE ref = 0) AS cur_count FROM long GROUP BY feature)"""
KS_OUT = (
    f"{r6('ks_statistic')} AS ks_statistic, {r6('ks_p_value')} AS ks_p_value"
)
MW_OUT = (
    f"{r6('mw_statistic')} AS mw_statistic, {r6('mw_z')} AS mw_z, {r6('mw_p_value')} AS mw_p_value"
)
FIRED = "(ks_p_value < 0.05 OR mw_p_value < 0.05 OR psi > 0.1)"


def drift_sql(long: str, body: str) -> str:
    return f"WITH {long},{TESTS},{PSI},{MOMENTS}\n{body}"


DRIFT_OUT = (
    "SELECT feature, "
    + ", ".join(f"{r6(c)} AS {c}" for c in ("ref_mean", "ref_std", "cur_mean", "cur_std"))
    + f", ref_count, cur_count, {KS_OUT}, {MW_OUT}, {r6('psi')} AS psi, "
    f"{flag('psi > 0.1')} AS psi_drift, {flag(FIRED)} AS drift_detected "
    "FROM moments JOIN tests USING (feature) JOIN psi USING (feature)"
)
QUARTILES = " ".join(
    f", quantile_cont({{v}}, {share}) AS {name}"
    for name, share in (("q1", 0.25), ("median", 0.5), ("q3", 0.75))
)


@query(
    "reference_stats",
    f"WITH {SQL_LINES.split('long AS')[0].rstrip().rstrip(',')} "
    + " UNION ALL ".join(
        f"SELECT '{f}' AS feature, {r6(f'avg({f})')} AS mean, {r6(f'stddev_samp({f})')} AS std, "
        f"{r6(f'quantile_cont({f}, 0.5)')} AS median, {r6(f'quantile_cont({f}, 0.25)')} AS q25, "
        f"{r6(f'quantile_cont({f}, 0.75)')} AS q75, {r6(f'min({f})')} AS min, "
        f"{r6(f'max({f})')} AS max, count({f}) AS count, "
        f"{r6(f'(count(*) - count({f})) / count(*)::DOUBLE')} AS missing_rate FROM rows WHERE early"
        for f in FEATURES
    ),
)
def reference_stats(spark, d):
    return drift.reference_stats(line_sides(spark, d)[0], FEATURES)


@query(
    "ks_two_sample",
    drift_sql(
        SQL_LINES, f"SELECT feature, {KS_OUT}, {flag('ks_p_value < 0.05')} AS ks_drift FROM tests"
    ),
)
def ks_two_sample(spark, d):
    return drift.ks_two_sample(*line_sides(spark, d), FEATURES)


@query(
    "mann_whitney",
    drift_sql(
        SQL_LINES, f"SELECT feature, {MW_OUT}, {flag('mw_p_value < 0.05')} AS mw_drift FROM tests"
    ),
)
def mann_whitney(spark, d):
    return drift.mann_whitney(*line_sides(spark, d), FEATURES)


@query(
    "psi",
    drift_sql(SQL_LINES, f"SELECT feature, {r6('psi')} AS psi, {flag('psi > 0.1')} AS psi_drift FROM psi"),
)
def psi(spark, d):
    return drift.psi(*line_sides(spark, d), FEATURES)


@query("feature_drift", drift_sql(SQL_LINES, DRIFT_OUT))
def feature_drift(spark, d):
    return drift.feature_drift(*line_sides(spark, d), FEATURES)


@query("feature_drift_events", drift_sql(SQL_EVENTS, DRIFT_OUT))
def feature_drift_events(spark, d):
    reference, current = event_sides(spark, d)
    return drift.feature_drift(reference, current, drift.monitored_features(reference))


SUMMARY = (
    f"(SELECT CAST(count(*) FILTER (WHERE {FIRED}) AS BIGINT) AS drifted_features "
    "FROM tests JOIN psi USING (feature))"
)


def line_summary(spark: SparkSession, d: str) -> DataFrame:
    """One monitored feature is missing from the current lines; it still counts."""
    reference, current = line_sides(spark, d)
    wanted = drift.monitored_features(reference)
    changes = drift.feature_drift(reference, current.drop("l_discount"), wanted)
    return drift.drift_summary(changes, len(wanted))


@query(
    "drift_summary",
    drift_sql(
        SQL_LINES,
        "SELECT 4 AS total_features, drifted_features, "
        f"{r6('drifted_features / 4.0')} AS drift_rate, "
        f"{flag('drifted_features / 4.0 > 0.1')} AS overall_drift_detected FROM "
        + SUMMARY.replace("USING (feature))", "USING (feature) WHERE feature <> 'l_discount')"),
    ),
)
def drift_summary(spark, d):
    return line_summary(spark, d)


HISTOGRAM_EDGES = " + ".join(
    f"CAST(v >= lo + {i}::DOUBLE * ((hi - lo) / 30::DOUBLE) AS INTEGER)" for i in range(1, 30)
)


@query(
    "feature_histogram",
    f"WITH {SQL_LINES}, span AS (SELECT feature, min(v) AS lo, max(v) AS hi FROM long GROUP BY 1), "
    f"binned AS (SELECT feature, lo, hi, {HISTOGRAM_EDGES} AS bin FROM long JOIN span USING (feature)) "
    f"SELECT feature, bin, {r6('lo + bin::DOUBLE * ((hi - lo) / 30::DOUBLE)')} AS bin_low, "
    "count(*) AS n FROM binned GROUP BY feature, bin, lo, hi",
)
def feature_histogram(spark, d):
    rows = table(spark, d, "lineitem").withColumn("taxed", F.nullif("l_tax", F.lit(0.0)))
    return quality.feature_histogram(rows, FEATURES)


@query(
    "feature_boxstats",
    f"WITH {SQL_LINES}, box AS (SELECT feature{QUARTILES.format(v='v')} FROM long GROUP BY 1), "
    "marked AS (SELECT *, v BETWEEN q1 - (q3 - q1) * 1.5::DOUBLE AND q3 + (q3 - q1) * 1.5::DOUBLE "
    f"AS inside FROM long JOIN box USING (feature)) SELECT feature, {r6('q1')} AS q1, "
    f"{r6('median')} AS median, {r6('q3')} AS q3, "
    f"{r6('min(v) FILTER (WHERE inside)')} AS low_whisker, "
    f"{r6('max(v) FILTER (WHERE inside)')} AS high_whisker, "
    "count(*) FILTER (WHERE NOT inside) AS n_outliers FROM marked GROUP BY feature, q1, median, q3",
)
def feature_boxstats(spark, d):
    rows = table(spark, d, "lineitem").withColumn("taxed", F.nullif("l_tax", F.lit(0.0)))
    return quality.feature_boxstats(rows, FEATURES)


# E: customers by segment and nation.

ATTRIBUTES = ["c_mktsegment", "n_name", "no_such_column"]


def groups(spark: SparkSession, d: str) -> DataFrame:
    customer, nation = table(spark, d, "customer"), table(spark, d, "nation")
    balance = F.col("c_acctbal")
    # Nations are a fixed list; the join picks its own strategy by size.
    return customer.join(nation, customer.c_nationkey == nation.n_nationkey).select(
        F.when(F.col("c_custkey") % 50 != 0, F.col("c_mktsegment")).alias("c_mktsegment"),
        "n_name",
        ((balance + 1000.0) / 11000.0).alias("prediction_proba"),
        (balance > 5000.0).cast("int").alias("label_90d"),
    )


SQL_GROUPS = """
scored AS (SELECT CASE WHEN c_custkey % 50 <> 0 THEN c_mktsegment END AS c_mktsegment, n_name,
    (c_acctbal + 1000::DOUBLE) / 11000::DOUBLE AS p, CAST(c_acctbal > 5000 AS INTEGER) AS y
    FROM customer JOIN nation ON c_nationkey = n_nationkey),
stats AS (SELECT attribute, grp, count(*) AS n, avg(y) AS rate, avg(p) AS mean,
    stddev_samp(p) AS std FROM (
    SELECT 'c_mktsegment' AS attribute, c_mktsegment AS grp, p, y FROM scored
    UNION ALL SELECT 'n_name', n_name, p, y FROM scored) WHERE grp IS NOT NULL GROUP BY 1, 2),
metrics AS (SELECT attribute, count(*) AS n_groups, max(mean) - min(mean) AS diff,
    var_pop(mean) AS var FROM stats GROUP BY 1)"""


def group_stats(spark, d):
    return fairness.bias_group_stats(groups(spark, d), ATTRIBUTES)


@query(
    "bias_group_stats",
    f'WITH {SQL_GROUPS} SELECT attribute, grp AS "group", n, {r6("rate")} AS positive_rate, '
    f"{r6('mean')} AS prediction_mean, {r6('std')} AS prediction_std FROM stats",
)
def bias_group_stats(spark, d):
    return group_stats(spark, d)


@query(
    "bias_metrics",
    f"WITH {SQL_GROUPS} SELECT attribute, n_groups, {r6('diff')} AS demographic_parity_diff, "
    f"{r6('var')} AS prediction_variance, {flag('diff > 0.1 OR var > 0.01')} AS bias_detected "
    "FROM metrics",
)
def bias_metrics(spark, d):
    return fairness.bias_metrics(group_stats(spark, d))


def group_summary(spark, d):
    return fairness.bias_summary(fairness.bias_metrics(group_stats(spark, d)), len(ATTRIBUTES))


BIASED = "count(*) FILTER (WHERE diff > 0.1 OR var > 0.01)"


@query(
    "bias_summary",
    f"WITH {SQL_GROUPS} SELECT 3 AS total_attributes, {BIASED} AS biased_attributes, "
    f"{flag(BIASED + ' > 0')} AS bias_detected FROM metrics",
)
def bias_summary(spark, d):
    return group_summary(spark, d)


# F: daily metric history. 'error' is the metric for which lower is better.

LOWER = ("error",)


def history(spark: SparkSession, d: str) -> DataFrame:
    day = F.datediff(F.col("ts"), F.lit("2024-01-01").cast("date"))
    return (
        table(spark, d, "events")
        .groupBy(F.col("event_type").alias("metric"), day.cast("long").alias("seq"))
        .agg((F.avg("value") / 100.0).alias("value"))
    )


SQL_HISTORY = """
history AS (SELECT event_type AS metric, CAST(ts AS DATE) - DATE '2024-01-01' AS seq,
    avg(value) / 100::DOUBLE AS value FROM events GROUP BY 1, 2)"""


@query(
    "metric_history",
    f"WITH {SQL_HISTORY} SELECT metric, CAST(seq AS BIGINT) AS seq, {r6('value')} AS value, "
    "'daily mean' AS analysis, CASE WHEN seq < 15 THEN 'first' ELSE 'second' END AS batch FROM history",
)
def metric_history(spark, d):
    path, rows = scratch.scratch_path(spark, "history"), history(spark, d)
    halves = {"first": F.col("seq") < 15, "second": F.col("seq") >= 15}
    for batch in ("first", "second", "second"):  # a batch that comes again replaces itself
        performance.append_measurements(rows.where(halves[batch]), path, batch, analysis=F.lit("daily mean"))
    return performance.read_history(spark, path).select("metric", "seq", "value", "analysis", "batch")


def degradation(spark: SparkSession, d: str) -> DataFrame:
    """The first week's means as the baseline, the last week's as the current values."""
    rows = history(spark, d)

    def mean(part):
        return rows.where(part).groupBy("metric").agg(F.avg("value").alias("value"))

    return performance.metric_degradation(mean(F.col("seq") < 7), mean(F.col("seq") >= 23), LOWER, 0.01)


SQL_DEGRADATION = f"""{SQL_HISTORY},
pairs AS (SELECT metric, avg(value) FILTER (WHERE seq < 7) AS baseline,
    avg(value) FILTER (WHERE seq >= 23) AS current FROM history GROUP BY metric),
degradation AS (SELECT *, CASE WHEN metric = 'error' THEN current - baseline
    ELSE baseline - current END AS change FROM pairs)"""


@query(
    "metric_degradation",
    f"WITH {SQL_DEGRADATION} SELECT metric, {r6('baseline')} AS baseline, {r6('current')} AS current, "
    f"{r6('change')} AS change, {flag('change > 0.01')} AS degraded FROM degradation",
)
def metric_degradation(spark, d):
    return degradation(spark, d)


ALERT = (
    "printf('Performance degradation detected in %s: %.3f → %.3f (change: %+.3f)', "
    "metric, baseline, current, change)"
)


@query(
    "metric_alerts",
    f"WITH {SQL_DEGRADATION} SELECT metric, {ALERT} AS alert FROM degradation WHERE change > 0.01",
)
def metric_alerts(spark, d):
    return performance.metric_alerts(degradation(spark, d))


@query(
    "metric_trend",
    f"""WITH {SQL_HISTORY}, recent AS (SELECT *, row_number() OVER
      (PARTITION BY metric ORDER BY seq DESC) AS back FROM history QUALIFY back <= 10),
    slopes AS (SELECT metric, count(*) AS n_recent, regr_slope(value, -back::DOUBLE) AS slope
      FROM recent GROUP BY metric)
    SELECT metric, n_recent, {r6('slope')} AS slope, CASE WHEN abs(slope) < 0.001 THEN 'stable'
      WHEN (slope > 0) = (metric <> 'error') THEN 'improving' ELSE 'degrading' END AS trend
    FROM slopes""",
)
def metric_trend(spark, d):
    return performance.metric_trend(history(spark, d), lower_is_better=LOWER)


@query(
    "metric_recent",
    f"""WITH {SQL_HISTORY} SELECT metric, CAST(seq AS BIGINT) AS seq, {r6('value')} AS value,
      strftime(TIMESTAMP '2024-01-01' + seq * INTERVAL 1 DAY, '%Y-%m-%d %H:%M:%S') AS measured_at,
      CAST(row_number() OVER (PARTITION BY metric ORDER BY seq DESC) AS INTEGER) AS back
    FROM history QUALIFY back <= 10""",
)
def metric_recent(spark, d):
    path, rows = scratch.scratch_path(spark, "history"), history(spark, d)
    start = F.lit("2024-01-01 00:00:00").cast("timestamp")
    at = start + F.make_dt_interval(F.col("seq").cast("int"))
    performance.append_measurements(rows, path, "all", at)
    recent = performance.recent_measurements(performance.read_history(spark, path))
    return recent.select("metric", "seq", "value", "measured_at", "back")


def _status_sql() -> str:
    drifted = drift_sql(SQL_LINES, f"SELECT * FROM {SUMMARY}").replace(
        "USING (feature))", "USING (feature) WHERE feature <> 'l_discount')"
    )
    declined = f"WITH {SQL_DEGRADATION} SELECT count(*) FILTER (WHERE change > 0.01) AS n FROM degradation"
    biased = f"WITH {SQL_GROUPS} SELECT {BIASED} AS n FROM metrics"
    return f"""SELECT CASE WHEN p.n > 0 THEN 'critical' WHEN d.n > 0 OR b.n > 0 THEN 'warning'
      ELSE 'healthy' END AS status, CASE WHEN p.n > 0 THEN 2 WHEN d.n > 0 OR b.n > 0 THEN 1
      ELSE 0 END AS severity, CAST((CASE WHEN d.n > 0 THEN 1 ELSE 0 END) + p.n
      + (CASE WHEN b.n > 0 THEN 1 ELSE 0 END) AS INTEGER) AS n_alerts,
      CASE WHEN b.n > 0 THEN 'warning' WHEN p.n > 0 THEN 'critical' WHEN d.n > 0 THEN 'warning'
      ELSE 'healthy' END AS reference_status
    FROM (SELECT drifted_features AS n FROM ({drifted})) d, ({declined}) p, ({biased}) b"""


def summaries(spark: SparkSession, d: str) -> list[DataFrame]:
    """One row each, stored: the status and the document read them several times."""
    declined = performance.degradation_summary(degradation(spark, d))
    return [scratch.settle(df, "summary") for df in (line_summary(spark, d), declined, group_summary(spark, d))]


@query("monitoring_status", _status_sql())
def monitoring_status(spark, d):
    drifted, declined, biased = summaries(spark, d)
    worst = report.monitoring_status(drifted, declined, biased)
    lowered = report.monitoring_status(drifted, declined, biased, reference_precedence=True)
    return worst.select(
        "status", "severity", F.size("alerts").alias("n_alerts"),
        lowered.select("status").scalar().alias("reference_status"),
    )


def _report_sql() -> str:
    """A row per entry of the document: the summaries' counts, then features, metrics and attributes."""
    lines = drift_sql(SQL_LINES, "SELECT feature, psi, " + FIRED + " AS fired FROM tests JOIN psi USING (feature) "
                      "WHERE feature <> 'l_discount'")
    declined = f"WITH {SQL_DEGRADATION} SELECT metric, change FROM degradation"
    biased = f"WITH {SQL_GROUPS} SELECT attribute, diff, diff > 0.1 OR var > 0.01 AS found FROM metrics"
    return f"""WITH d AS ({lines}), p AS ({declined}), b AS ({biased}),
    n AS (SELECT (SELECT count(*) FROM d WHERE fired) AS d, (SELECT count(*) FROM p WHERE change > 0.01) AS p,
      (SELECT count(*) FROM b WHERE found) AS b)
    SELECT CASE WHEN n.p > 0 THEN 'critical' WHEN n.d > 0 OR n.b > 0 THEN 'warning' ELSE 'healthy' END AS overall_status,
      part, name, {r6('number')} AS number, CAST(found AS INTEGER) AS found FROM n, (
      SELECT 'feature' AS part, feature AS name, psi AS number, fired AS found FROM d
      UNION ALL SELECT 'metric', metric, change, change > 0.01 FROM p
      UNION ALL SELECT 'attribute', attribute, diff, coalesce(found, false) FROM b)"""


@query("monitoring_report", _report_sql())
def monitoring_report(spark, d):
    """The document is written, read back and taken apart again."""
    reference, current = line_sides(spark, d)
    wanted = drift.monitored_features(reference)
    changes = scratch.settle(drift.feature_drift(reference, current.drop("l_discount"), wanted), "drift")
    metrics = scratch.settle(degradation(spark, d), "metrics")
    attributes = scratch.settle(fairness.bias_metrics(group_stats(spark, d)), "bias")
    drifted = scratch.settle(drift.drift_summary(changes, len(wanted)), "summary")
    declined = scratch.settle(performance.degradation_summary(metrics), "summary")
    biased = scratch.settle(fairness.bias_summary(attributes, len(ATTRIBUTES)), "summary")
    status = report.monitoring_status(drifted, declined, biased)
    path = scratch.scratch_path(spark, "monitoring-report")
    document = report.monitoring_report(status, drifted, declined, biased, changes, metrics, attributes, F.current_timestamp())
    reports.write_report(document, path)
    stored = reports.read_report(spark, path, document.schema)

    def rows(part, entries, name, number, found):
        entry = F.struct(F.lit(part).alias("part"), F.col(f"e.{name}").alias("name"), F.col(f"e.{number}").alias("number"), F.col(f"e.{found}").alias("found"))
        return stored.select("overall_status", F.explode(entries).alias("e")).select("overall_status", entry.alias("r")).select("overall_status", "r.*")

    parts = rows("feature", "drift_analysis.features", "feature", "psi", "drift_detected")
    parts = parts.unionByName(rows("metric", "performance_analysis.metrics", "metric", "change", "degraded"))
    return parts.unionByName(rows("attribute", "bias_analysis.attributes", "attribute", "demographic_parity_diff", "bias_detected"))


NOW = "2024-02-10 00:00:00"


@query(
    "retrain_decision",
    f"""WITH {SQL_HISTORY}, facts AS (SELECT metric, CAST(seq AS BIGINT) AS seq,
      value > 0.55 AS drifted, value < 0.45 AS critical,
      TIMESTAMP '2024-01-01' + seq * INTERVAL 1 DAY AS trained_at FROM history),
    judged AS (SELECT metric, seq, CASE WHEN drifted THEN 'drift' WHEN critical THEN 'critical'
      WHEN TIMESTAMP '{NOW}' > trained_at + INTERVAL 30 DAY THEN 'age' ELSE 'none' END AS reason
      FROM facts) SELECT metric, seq, reason, {flag("reason <> 'none'")} AS retrain FROM judged""",
)
def retrain_decision(spark, d):
    start = F.lit("2024-01-01").cast("timestamp_ntz")
    facts = history(spark, d).select(
        "metric",
        "seq",
        (F.col("value") > 0.55).alias("drifted"),
        F.when(F.col("value") < 0.45, "critical").otherwise("healthy").alias("status"),
        (start + F.make_dt_interval(F.col("seq").cast("int"))).alias("trained_at"),
    )
    now = F.lit(NOW).cast("timestamp_ntz")
    decided = report.retrain_decision(
        facts, F.col("drifted"), F.col("status"), F.col("trained_at"), now, defaults.RETRAIN_AFTER_DAYS
    )
    return decided.select("metric", "seq", "reason", "retrain")
