"""The stages from source files to reports, each reading and writing shared storage.

Stage tables end lineage: a stage restarts from its inputs, never from the sources.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortflow import defaults, schemas
from cohortflow.functions.scalars import split_names
from cohortflow.functions.trees import load_forest
from cohortflow.operators import (
    calibrate,
    cohort,
    drift,
    evaluate,
    explain,
    fairness,
    features,
    labels,
    merge,
    performance,
    report,
    runs,
    train,
)
from cohortflow.operators.windows import shared_as_of
from cohortflow.sources.models import load_calibrator, load_classifier, save_calibrator, save_model
from cohortflow.sources.reports import read_report, write_report
from cohortflow.sources.scratch import discard, settle, stored
from cohortflow.sources.tables import land_bucketed, read_bucketed, read_parquet, read_source, write_parquet


#: Event tables with the time that their windows look at.
EVENTS = {"encounters": "Start", "observations": "Date", "medications": "Start"}
#: What a landed folder says of itself.
LANDED = "buckets int"


def _by_patient(df: DataFrame) -> DataFrame:
    return df.withColumnRenamed("Patient", "patient")


def land_sources(spark: SparkSession, input_dir: str, output: str, buckets: int = 0) -> None:
    """Parses the source files once: patients and conditions as they are, event tables dealt out by patient and month
    (``buckets`` of patients, as many as shuffle partitions unless given). The other stages take this folder for
    their ``input_dir``."""
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    for name in schemas.SOURCES:
        table = read_source(spark, input_dir, name)
        if name in EVENTS:
            land_bucketed(_by_patient(table), f"{output}/{name}", "patient", EVENTS[name], buckets)
        else:
            write_parquet(table, f"{output}/{name}")
    write_report(spark.range(1).select(F.lit(buckets).alias("buckets")), f"{output}/landed")


def _source(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table without a time, landed or not."""
    landed = stored(spark, f"{folder}/landed")
    return read_parquet(spark, f"{folder}/{name}") if landed else read_source(spark, folder, name)


def _events(
    spark: SparkSession, folder: str, name: str, low: Column | None = None, high: Column | None = None
) -> DataFrame:
    """An event table, landed or not; of a landed one only the months between the bounds."""
    if not stored(spark, f"{folder}/landed"):
        return _by_patient(read_source(spark, folder, name))
    buckets = read_report(spark, f"{folder}/landed", LANDED).first()["buckets"]
    schema = schemas.SOURCES[name].replace("Patient string", "patient string")
    return read_bucketed(spark, f"{folder}/{name}", schema, "patient", buckets, EVENTS[name], low, high)


def _bounds(at: str | None, before: int = 0, after: int = 0) -> tuple[Column | None, Column | None]:
    """Days around a shared date; none without one."""
    if at is None:
        return None, None
    moment = F.lit(at).cast("timestamp")
    return moment - F.expr(f"INTERVAL {int(before)} DAYS"), moment + F.expr(f"INTERVAL {int(after)} DAYS")


def build_cohort(
    spark: SparkSession, input_dir: str, reference_date: str, output: str,
    min_age: int = defaults.MIN_AGE,
) -> None:
    found = cohort.build_cohort(
        _source(spark, input_dir, "patients"),
        _source(spark, input_dir, "conditions"),
        reference_date,
        min_age,
    )
    write_parquet(found, output)


def make_labels(
    spark: SparkSession, input_dir: str, cohort_path: str, output: str,
    prediction_window_days: int = defaults.PREDICTION_DAYS,
    positive_classes: str | Sequence[str] = defaults.POSITIVE_CLASSES,
) -> None:
    index = read_parquet(spark, cohort_path)
    at = shared_as_of(index)
    encounters = _events(spark, input_dir, "encounters", *_bounds(at, after=prediction_window_days))
    made = labels.make_labels(index, encounters, prediction_window_days, positive_classes, at=at)
    write_parquet(made, output)


def rolling_features(
    spark: SparkSession, input_dir: str, cohort_path: str, output: str,
    lookback_days: int = defaults.LOOKBACK_DAYS,
    hba1c_codes: str | Sequence[str] = "", sbp_codes: str | Sequence[str] = "",
    dbp_codes: str | Sequence[str] = "",
) -> None:
    index = read_parquet(spark, cohort_path)
    at = shared_as_of(index)
    bounds = _bounds(at, before=lookback_days)
    observations, encounters = (_events(spark, input_dir, name, *bounds) for name in ("observations", "encounters"))
    medications = _events(spark, input_dir, "medications", None, bounds[1])  # what began long ago may still run
    made = features.rolling_features(
        index, observations, encounters, medications, lookback_days,
        hba1c_codes, sbp_codes, dbp_codes, ties=["Code", "Value"], at=at,
    )
    write_parquet(made, output)


def merge_training_table(
    spark: SparkSession, features_path: str, labels_path: str, output: str
) -> None:
    merged = merge.merge_training(
        read_parquet(spark, features_path), read_parquet(spark, labels_path)
    )
    write_parquet(merged, output)


def train_classifier(
    spark: SparkSession, dataset: str, output_dir: str, target: str = defaults.TARGET,
    id_columns: str | Sequence[str] = defaults.ID_COLUMNS,
    validation_split: float = defaults.VALIDATION_SHARE, stratify: bool = True,
    seed: int = defaults.SEED, **params,
) -> None:
    """Writes ``<output>/model`` and the scored ``<output>/validation``, ids included."""
    table, ids = read_parquet(spark, dataset), split_names(id_columns)
    names = train.feature_columns(table, target, ids)
    split = train.stratified_split(table, ids, target, validation_split, seed, stratify)
    model = train.fit_classifier(
        split.where(~F.col("is_validation")), names, target, seed, **params
    )
    save_model(model, f"{output_dir}/model")
    held_out = split.where("is_validation").drop("is_validation")
    write_parquet(train.score(model, held_out, names), f"{output_dir}/validation")


def calibrate_model(
    spark: SparkSession, validation: str, output: str, target: str = defaults.TARGET,
    calibration_split: float = 0.0, id_columns: str | Sequence[str] = defaults.ID_COLUMNS,
    seed: int = defaults.SEED,
) -> None:
    """Fits on all scored rows, or on a stratified share of them; the others then go to ``<output>_rest``, on which
    the evaluation does not meet rows that the calibrator has seen."""
    scored = read_parquet(spark, validation)
    if calibration_split:
        parts = train.stratified_split(scored, split_names(id_columns), target, calibration_split, seed)
        rest = parts.where(~F.col("is_validation")).drop("is_validation")
        write_parquet(rest, f"{output.rstrip('/')}_rest")
        scored = parts.where("is_validation")
    save_calibrator(calibrate.fit_isotonic(scored, label=target), output)


def evaluate_model(
    spark: SparkSession, calibrator: str, validation: str, output: str,
    thresholds: Mapping[str, float] = defaults.THRESHOLDS, target: str = defaults.TARGET,
) -> None:
    scored = calibrate.apply_isotonic(
        load_calibrator(spark, calibrator), read_parquet(spark, validation)
    )
    metrics = evaluate.metrics_row(scored, "prediction_proba", "prediction_calibrated", target)
    confusion = evaluate.threshold_metrics(
        evaluate.confusion_at_thresholds(scored, thresholds, "prediction_calibrated", target)
    )
    write_report(evaluate.metrics_report(metrics, confusion), output)


def reported_metrics(spark: SparkSession, path: str) -> DataFrame:
    """(metric, value) of a metrics report, the calibrated numbers under their short names."""
    names = {
        "auroc": "auroc_calibrated", "auprc": "auprc_calibrated", "brier_score": "brier_calibrated"
    }
    rows = [
        F.struct(F.lit(short).alias("metric"), F.col(f"metrics.{full}").alias("value"))
        for short, full in names.items()
    ]
    return read_report(spark, path, schemas.METRICS_REPORT).select(F.inline(F.array(*rows)))


def monitor(
    spark: SparkSession, reference: str, current: str, baseline_metrics: str,
    current_metrics: str, output: str, protected: Sequence[str] = (),
    history: str = "", batch: str = "", now: str = "",
) -> int:
    """Writes the monitoring report with its per-feature, per-metric and per-attribute parts; returns 0, 1 or 2 for
    healthy, warning, critical. With ``history`` the current metrics join that table under the name ``batch`` (the
    report's path unless given); ``now`` is the time of writing unless given."""
    old, new = read_parquet(spark, reference), read_parquet(spark, current)
    names = drift.monitored_features(old)
    changes = settle(drift.feature_drift(old, new, names), "drift")
    drifted = settle(drift.drift_summary(changes, len(names)), "summary")
    measured = reported_metrics(spark, current_metrics)
    metrics = settle(performance.metric_degradation(reported_metrics(spark, baseline_metrics), measured), "metrics")
    declined = settle(performance.degradation_summary(metrics), "summary")
    present = [a for a in protected if a in new.columns]
    attributes = settle(fairness.bias_metrics(fairness.bias_group_stats(new, present)), "bias") if present else None
    if attributes is not None:
        biased = settle(fairness.bias_summary(attributes, len(protected)), "summary")
    else:
        biased = settle(
            spark.range(1).select(
                F.lit(len(protected)).alias("total_attributes"),
                F.lit(0).cast("long").alias("biased_attributes"),
                F.lit(False).alias("bias_detected"),
            ),
            "summary",
        )
    at = _instant(now)
    status = settle(report.monitoring_status(drifted, declined, biased), "status")
    document = report.monitoring_report(status, drifted, declined, biased, changes, metrics, attributes, at)
    write_report(document, output)
    if history:
        analysis = status.select(F.to_json(F.struct("status", "alerts"))).scalar()
        rows = measured.withColumn("seq", F.unix_micros(at))
        performance.append_measurements(rows, history, batch or output, at, analysis)
    severity = status.first()["severity"]
    discard(*[t for t in (changes, drifted, metrics, declined, biased, status, attributes) if t is not None])
    return severity


def _instant(now: str) -> Column:
    return F.lit(now).cast("timestamp") if now else F.current_timestamp()


MONITORED = """overall_status string, alerts array<string>,
    drift_analysis struct<overall_drift_detected: boolean, drifted_features: bigint>"""


def decide_retraining(
    spark: SparkSession, report_path: str, model_path: str, output: str, history: str = "",
    max_age_days: int = defaults.RETRAIN_AFTER_DAYS, now: str = "",
) -> int:
    """Writes (retrain, reason, trained_at, decided_at, trends) from a monitoring report, the time the
    model was saved and, if given, the metric history; returns 1 if the model is to be trained again."""
    saved = spark.read.schema("timestamp bigint").json(f"{model_path.rstrip('/')}/metadata")
    facts = read_report(spark, report_path, MONITORED).select(
        "overall_status",
        F.col("drift_analysis.overall_drift_detected").alias("drifted"),
        F.timestamp_millis(saved.agg(F.max("timestamp")).scalar()).alias("trained_at"),
        _instant(now).alias("decided_at"),
    )
    decided = report.retrain_decision(
        facts, F.col("drifted"), F.col("overall_status"), F.col("trained_at"), F.col("decided_at"), max_age_days
    )
    columns = ["retrain", "reason", "trained_at", "decided_at"]
    if history:
        table = performance.read_history(spark, history)
        trend, recent = performance.metric_trend(table), performance.recent_measurements(table)
        recent = recent.groupBy("metric").agg(
            F.sort_array(F.collect_list(F.struct("seq", "measured_at", "value"))).alias("recent")
        )
        rows = trend.join(recent, "metric")
        trends = rows.agg(F.sort_array(F.collect_list(F.struct("metric", "trend", "slope", "recent")))).scalar()
        decided, columns = decided.withColumn("trends", trends), [*columns, "trends"]
    write_report(decided.select(*columns), output)
    return int(read_report(spark, output, "retrain boolean").first()["retrain"])


def log_run(
    spark: SparkSession, runs_path: str, run_id: str, model_path: str, metrics_path: str,
    run_name: str = "", now: str = "",
) -> None:
    """Adds a run to the runs table: the classifier's parameters, the metrics of its report, and the model's place.
    A run that is logged again replaces itself."""
    classifier = load_classifier(model_path).stages[-1]
    params = {p.name: str(v) for p, v in sorted(classifier.extractParamMap().items(), key=lambda x: x[0].name)}
    params = {**params, "learning_rate": params["stepSize"], "n_estimators": params["maxIter"], "max_depth": params["maxDepth"]}
    document = read_report(spark, metrics_path, schemas.METRICS_REPORT)
    fields = [f.name for f in document.schema["metrics"].dataType.fields]
    pairs = lambda names, value: F.create_map(*[c for n in names for c in (F.lit(n), value(n))])
    row = document.select(
        F.lit(run_id).alias("run_id"),
        F.lit(run_name or None).cast("string").alias("run_name"),
        _instant(now).alias("start_time"),
        F.lit("FINISHED").alias("status"),
        pairs(params, lambda n: F.lit(params[n])).alias("params"),
        pairs(fields, lambda n: F.col(f"metrics.{n}")).alias("metrics"),
        pairs(["model"], lambda _: F.lit(model_path)).alias("tags"),
    )
    runs.log_runs(row, runs_path, run_id)


def compare_logged_runs(spark: SparkSession, runs_path: str, output: str, run_ids: str | Sequence[str] = "") -> None:
    """Writes the runs side by side (all, or those named), and ``<output>_entries``: all they hold, as rows."""
    table, names = runs.read_runs(spark, runs_path), split_names(run_ids)
    compared = runs.compare_runs(table, names) if names else runs.compare_experiment(table)
    write_parquet(compared, output)
    write_parquet(runs.run_entries(table, names or None), f"{output.rstrip('/')}_entries")


def explain_high_risk(
    spark: SparkSession, model_path: str, validation: str, output: str,
    threshold: float = 0.5, subject: str = "patient", target: str = defaults.TARGET,
) -> None:
    """Explanations of every validation row scored at or above the threshold."""
    model, table = load_classifier(model_path), read_parquet(spark, validation)
    names = train.feature_columns(table, target)
    risky = table.where(F.col("prediction_proba") >= threshold).drop(
        "prediction_proba", "prediction"
    )
    explained = explain.tree_shap(
        train.assembled(model, risky, names), load_forest(spark, model.stages[-1]), names
    )
    write_parquet(
        explain.high_risk_explanations(explained, subject, F.current_timestamp(), threshold), output
    )
