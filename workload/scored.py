"""Mapping C: scored rows - calibration, metrics, thresholds, reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortflow import defaults, schemas
from cohortflow.functions.scalars import advice, confidence, risk_band
from cohortflow.operators import calibrate, evaluate
from cohortflow.sources import reports, scratch
from workload.base import flag, query, r6, table

THRESHOLDS = defaults.THRESHOLDS
SCORES = ["p", "p_cal"]


def scored(spark: SparkSession, d: str) -> DataFrame:
    value = F.col("value")
    return (
        table(spark, d, "events")
        .select(
            "event_id",
            (value / (value + 50.0)).alias("p"),
            F.col("event_type").isin("error", "purchase").cast("int").alias("y"),
        )
        .withColumn("p_cal", F.lit(0.2) + F.lit(0.4) * F.col("p"))
    )


SCORED = """
raw AS (SELECT event_id, value / (value + 50::DOUBLE) AS p,
    CAST(event_type IN ('error', 'purchase') AS INTEGER) AS y FROM events),
scored AS (SELECT *, 0.2::DOUBLE + 0.4::DOUBLE * p AS p_cal FROM raw),
long AS (SELECT 'p' AS series, p AS s, y FROM scored
    UNION ALL SELECT 'p_cal', p_cal, y FROM scored),
ranks AS (SELECT *, sum(pos) OVER w - pos AS pos_below, sum(neg) OVER w - neg AS neg_below,
    sum(pos) OVER (PARTITION BY series) AS np, sum(neg) OVER (PARTITION BY series) AS nn
    FROM (SELECT series, s, sum(y)::DOUBLE AS pos, sum(1 - y)::DOUBLE AS neg
          FROM long GROUP BY 1, 2)
    WINDOW w AS (PARTITION BY series ORDER BY s)),
auroc AS (SELECT series, sum(pos * (neg_below + neg / 2)) / (max(np) * max(nn)) AS auroc
    FROM ranks GROUP BY 1),
ap AS (SELECT series, sum(pos / np * (np - pos_below) / (np - pos_below + nn - neg_below)) AS ap
    FROM ranks GROUP BY 1),
brier AS (SELECT series, avg((s - y) * (s - y)) AS brier FROM long GROUP BY 1)"""


def sql(body: str, *extra: str) -> str:
    return f"WITH {SCORED}{''.join(',' + e for e in extra)}\n{body}"


# The isotonic fit as max over starts of min over ends of the mean between them.
ISOTONIC = """
points AS (SELECT p, row_number() OVER (ORDER BY p) AS i, sum(sum(y)) OVER (ORDER BY p) AS sy,
    sum(count(*)) OVER (ORDER BY p) AS sn FROM scored GROUP BY p),
means AS (SELECT a.i AS first, b.i AS last, (b.sy - coalesce(z.sy, 0))::DOUBLE
      / (b.sn - coalesce(z.sn, 0))::DOUBLE AS m
    FROM points a JOIN points b ON b.i >= a.i LEFT JOIN points z ON z.i = a.i - 1),
lowest AS (SELECT first, last, min(m) OVER (PARTITION BY first ORDER BY last DESC) AS m FROM means),
fitted AS (SELECT last AS i, max(m) AS calibrated FROM lowest GROUP BY last)"""


@query(
    "isotonic_fit",
    sql(
        f"SELECT {r6('calibrated')} AS calibrated, {r6('min(p)')} AS min_score, "
        f"{r6('max(p)')} AS max_score, count(*) AS n_scores "
        "FROM points JOIN fitted USING (i) GROUP BY 1",
        ISOTONIC,
    ).replace("GROUP BY 1", "GROUP BY round(calibrated, 6), calibrated"),
)
def isotonic_fit(spark, d):
    rows = scored(spark, d)
    model = calibrate.fit_isotonic(rows, "p", "y")
    fitted = calibrate.apply_isotonic(model, rows.select("p").distinct(), "p", "calibrated")
    return (
        fitted.groupBy(F.round("calibrated", 6).alias("calibrated"))
        .agg(
            F.min("p").alias("min_score"), F.max("p").alias("max_score"), F.count("*").alias("n_scores")
        )
    )


@query(
    "isotonic_apply",
    sql(
        f"SELECT event_id, {r6('p')} AS p, {r6('calibrated')} AS calibrated "
        "FROM scored JOIN points USING (p) JOIN fitted USING (i)",
        ISOTONIC,
    ),
)
def isotonic_apply(spark, d):
    rows = scored(spark, d)
    model = calibrate.fit_isotonic(rows, "p", "y")
    return calibrate.apply_isotonic(model, rows, "p", "calibrated").select(
        "event_id", "p", "calibrated"
    )


def _edge(i: int) -> str:
    return f"({i}::DOUBLE * 0.1::DOUBLE)"


def _bin_sql(operator: str) -> str:
    return " + ".join(f"CAST(p {operator} {_edge(i)} AS INTEGER)" for i in range(1, 10))


@query(
    "reliability_left_closed",
    sql(
        f"SELECT {_bin_sql('>=')} AS bin, count(*) AS n, {r6('avg(y)')} AS true_rate, "
        f"{r6('avg(p)')} AS mean_raw, {r6('avg(p_cal)')} AS mean_calibrated "
        "FROM scored WHERE p >= 0 AND p < 1 GROUP BY 1"
    ),
)
def reliability_left_closed(spark, d):
    return calibrate.reliability_left_closed(scored(spark, d), "p", "p_cal", "y")


@query(
    "reliability_right_closed",
    sql(
        f"SELECT {_bin_sql('>')} AS bin, {r6('((' + _bin_sql('>') + ') + 0.5) / 10')} AS centre, "
        f"{r6('avg(y)')} AS true_rate, count(*) AS n FROM scored WHERE p > 0 AND p <= 1 GROUP BY 1, 2"
    ),
)
def reliability_right_closed(spark, d):
    return calibrate.reliability_right_closed(scored(spark, d), "p", "y")


@query(
    "score_range",
    sql(
        f"SELECT y AS label, count(*) AS n, {r6('min(p)')} AS min_score, {r6('max(p)')} AS max_score "
        "FROM scored GROUP BY y"
    ),
)
def score_range(spark, d):
    return calibrate.score_range(scored(spark, d), "p", "y")


@query("auroc", sql(f"SELECT series, {r6('auroc')} AS auroc FROM auroc"))
def auroc(spark, d):
    return evaluate.auroc(scored(spark, d), SCORES, "y")


@query("average_precision", sql(f"SELECT series, {r6('ap')} AS average_precision FROM ap"))
def average_precision(spark, d):
    return evaluate.average_precision(scored(spark, d), SCORES, "y")


@query("brier", sql(f"SELECT series, {r6('brier')} AS brier FROM brier"))
def brier(spark, d):
    return evaluate.brier(scored(spark, d), SCORES, "y")


@query(
    "roc_curve",
    sql(
        f"SELECT {r6('s')} AS threshold, {r6('(nn - neg_below) / nn')} AS fpr, "
        f"{r6('(np - pos_below) / np')} AS tpr FROM ranks WHERE series = 'p'"
    ),
)
def roc_curve(spark, d):
    return evaluate.roc_curve(scored(spark, d), "p", "y")


CUTS = ", ".join(f"('{n}', {t}::DOUBLE)" for n, t in THRESHOLDS.items())
CONFUSION = f"""
cuts(name, threshold) AS (VALUES {CUTS}),
confusion AS (SELECT name, threshold,
    count(*) FILTER (WHERE p_cal >= threshold AND y = 1) AS tp,
    count(*) FILTER (WHERE p_cal >= threshold AND y = 0) AS fp,
    count(*) FILTER (WHERE p_cal < threshold AND y = 1) AS fn,
    count(*) FILTER (WHERE p_cal < threshold AND y = 0) AS tn
    FROM scored, cuts GROUP BY 1, 2)"""
DERIVED = ", ".join(
    f"{r6(f'CASE WHEN {low} > 0 THEN {top} / ({low})::DOUBLE ELSE 0 END')} AS {name}"
    for name, top, low in (
        ("sensitivity", "tp", "tp + fn"),
        ("specificity", "tn", "tn + fp"),
        ("ppv", "tp", "tp + fp"),
        ("npv", "tn", "tn + fn"),
        ("f1", "2 * tp", "2 * tp + fp + fn"),
    )
)


def confusion(spark, d):
    return evaluate.confusion_at_thresholds(scored(spark, d), THRESHOLDS, "p_cal", "y")


@query("confusion_at_thresholds", sql("SELECT * FROM confusion", CONFUSION))
def confusion_at_thresholds(spark, d):
    return confusion(spark, d)


@query("threshold_metrics", sql(f"SELECT *, {DERIVED} FROM confusion", CONFUSION))
def threshold_metrics(spark, d):
    return evaluate.threshold_metrics(confusion(spark, d))


SWEEP_STEP = (defaults.SWEEP_RANGE[1] - defaults.SWEEP_RANGE[0]) / (defaults.SWEEP_STEPS - 1)


@query(
    "threshold_sweep",
    sql(
        f"""SELECT {r6('threshold')} AS threshold, {r6('avg(f1)')} AS mean_f1 FROM (
        SELECT threshold, fold, CASE WHEN 2 * tp + fp + fn > 0
            THEN 2 * tp / (2 * tp + fp + fn)::DOUBLE ELSE 0 END AS f1
        FROM (SELECT threshold, fold, count(*) FILTER (WHERE p >= threshold AND y = 1) AS tp,
            count(*) FILTER (WHERE p >= threshold AND y = 0) AS fp,
            count(*) FILTER (WHERE p < threshold AND y = 1) AS fn FROM folds, steps GROUP BY 1, 2))
        GROUP BY threshold""",
        f"steps AS (SELECT 0.1::DOUBLE + i * {SWEEP_STEP!r}::DOUBLE AS threshold "
        f"FROM range({defaults.SWEEP_STEPS}) r(i))",
        "folds AS (SELECT p, y, CAST('0x' || substr(md5(CAST(event_id AS VARCHAR)), 1, 8) "
        "AS BIGINT) % 5 AS fold FROM scored)",
    ),
)
def threshold_sweep(spark, d):
    return evaluate.threshold_sweep(scored(spark, d), F.col("event_id"), score="p", label="y")


def report(spark, d):
    metrics = evaluate.metrics_row(scored(spark, d), "p", "p_cal", "y")
    return evaluate.metrics_report(metrics, evaluate.threshold_metrics(confusion(spark, d)))


def _report_rows(documents: DataFrame) -> DataFrame:
    """A row per threshold block, beside the document's metrics."""
    return documents.select("metrics.*", F.explode("confusion_matrices").alias("name", "b")).select(
        "name", "auroc_raw", "auroc_calibrated", "auprc_raw", "auprc_calibrated", "brier_raw",
        "brier_calibrated", "b.threshold", "b.confusion_matrix.*", "b.metrics.*",
    )


METRIC_COLUMNS = ", ".join(
    f"{r6(f'(SELECT {column} FROM {source} WHERE series = {series!r})')} AS {name}_{suffix}"
    for name, source, column in (
        ("auroc", "auroc", "auroc"), ("auprc", "ap", "ap"), ("brier", "brier", "brier")
    )
    for suffix, series in (("raw", "p"), ("calibrated", "p_cal"))
)
REPORT_SQL = sql(f"SELECT *, {DERIVED}, {METRIC_COLUMNS} FROM confusion", CONFUSION)


@query("metrics_report", REPORT_SQL)
def metrics_report(spark, d):
    return _report_rows(report(spark, d))


@query("report_json", REPORT_SQL)
def report_json(spark, d):
    path = scratch.scratch_path(spark, "metrics-report")
    reports.write_report(report(spark, d), path)
    return _report_rows(reports.read_report(spark, path, schemas.METRICS_REPORT))


@query(
    "report_lookup",
    sql(
        f"SELECT {r6('(SELECT auroc FROM auroc WHERE series = {})'.format(repr('p')))} AS auroc_raw, "
        "0.7::DOUBLE AS accuracy"
    ),
)
def report_lookup(spark, d):
    """A nested look-up in the JSON text, with a default for what it lacks."""
    text = report(spark, d).select(F.to_json(F.struct("*")).alias("doc"))
    found = reports.lookup(F.col("doc"), "$.metrics.auroc_raw").cast("double")
    absent = reports.lookup(F.col("doc"), "$.metrics.accuracy", F.lit("0.7")).cast("double")
    return text.select(found.alias("auroc_raw"), absent.alias("accuracy"))


@query(
    "quality_gate",
    f"""WITH m AS (SELECT * FROM ({sql(f'SELECT {METRIC_COLUMNS}')}))
    SELECT {flag('auroc_calibrated >= 0.65')} AS auroc_ok,
    {flag('auprc_calibrated >= 0.3')} AS auprc_ok, {flag('brier_calibrated <= 0.3')} AS brier_ok,
    {flag('brier_calibrated <= brier_raw')} AS calibration_ok FROM m""",
)
def quality_gate(spark, d):
    return evaluate.quality_gate(evaluate.metrics_row(scored(spark, d), "p", "p_cal", "y"))


ADVICE_SQL = " ".join(f"WHEN '{n}' THEN '{t}'" for n, t in defaults.ADVICE.items())


@query(
    "risk_band",
    sql(
        f"SELECT event_id, band, strict_band, {r6('least(0.5::DOUBLE + abs(p - 0.5::DOUBLE), 1)')} "
        f"AS confidence, CASE band {ADVICE_SQL} END AS advice FROM (SELECT *, "
        "CASE WHEN p >= 0.5 THEN 'high' WHEN p >= 0.25 THEN 'medium' ELSE 'low' END AS band, "
        "CASE WHEN p > 0.5 THEN 'high' WHEN p > 0.25 THEN 'medium' ELSE 'low' END AS strict_band "
        "FROM scored)"
    ),
)
def risk_bands(spark, d):
    p = F.col("p")
    rows = scored(spark, d).select(
        "event_id", risk_band(p).alias("band"), risk_band(p, strict=True).alias("strict_band"),
        confidence(p).alias("confidence"),
    )
    return rows.withColumn("advice", advice(F.col("band")))
