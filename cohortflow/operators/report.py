"""Monitoring roll-up and the retraining decision."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortflow import defaults

# Severity codes, lowest first.
STATUSES = ("healthy", "warning", "critical")


def _status(severity: Column) -> Column:
    return F.element_at(F.array(*[F.lit(s) for s in STATUSES]), severity + 1)


def monitoring_status(
    drift: DataFrame,
    performance: DataFrame,
    bias: DataFrame | None = None,
    reference_precedence: bool = False,
) -> DataFrame:
    """(status, severity, alerts) from the three one-row summaries.

    The worst finding sets the status. ``reference_precedence`` lets a bias finding
    lower a critical status to warning.
    """
    d = drift.select(F.struct("overall_drift_detected", "drifted_features")).scalar()
    b = (
        bias.select(F.struct("bias_detected", "biased_attributes")).scalar()
        if bias is not None
        else F.lit(None).cast("struct<bias_detected: boolean, biased_attributes: bigint>")
    )
    drifted = F.coalesce(d["overall_drift_detected"], F.lit(False))
    biased = F.coalesce(b["bias_detected"], F.lit(False))
    facts = performance.select(
        F.coalesce("degradation_detected", F.lit(False)).alias("declined"),
        F.coalesce("alerts", F.array().cast("array<string>")).alias("declines"),
        drifted.alias("drifted"),
        biased.alias("biased"),
        F.format_string(defaults.DRIFT_ALERT, d["drifted_features"].cast("string")).alias("drift_text"),
        F.format_string(defaults.BIAS_ALERT, b["biased_attributes"].cast("string")).alias("bias_text"),
    )
    declined, warned = F.col("declined"), F.col("drifted") | F.col("biased")
    if reference_precedence:
        severity = (
            F.when(F.col("biased"), 1).when(declined, 2).when(F.col("drifted"), 1).otherwise(0)
        )
    else:
        severity = F.when(declined, 2).when(warned, 1).otherwise(0)
    none = F.array().cast("array<string>")
    alerts = F.concat(
        F.when(F.col("drifted"), F.array("drift_text")).otherwise(none),
        F.when(declined, F.col("declines")).otherwise(none),
        F.when(F.col("biased"), F.array("bias_text")).otherwise(none),
    )
    return facts.select(
        _status(severity).alias("status"), severity.cast("int").alias("severity"), alerts.alias("alerts")
    )


def monitoring_report(
    status: DataFrame,
    drift: DataFrame,
    performance: DataFrame,
    bias: DataFrame,
    features: DataFrame | None = None,
    metrics: DataFrame | None = None,
    attributes: DataFrame | None = None,
    generated: Column | None = None,
) -> DataFrame:
    """One document row: the status with the three summaries it rests on and, as far as they are given, the
    rows behind those: ``features`` of ``feature_drift``, ``metrics`` of ``metric_degradation`` and ``attributes``
    of ``bias_metrics``, a row per monitored column, metric and attribute; and when it was written.
    """
    def block(df: DataFrame, name: str, rows: DataFrame | None, key: str) -> Column:
        summary = df.select(F.struct(*df.columns)).scalar()
        fields = [summary[c].alias(c) for c in df.columns]
        if rows is not None:  # few by nature: columns, metrics, attributes
            ordered = [key, *[c for c in rows.columns if c != key]]
            fields.append(rows.agg(F.sort_array(F.collect_list(F.struct(*ordered)))).scalar().alias(name))
        return F.struct(*fields)

    return status.select(
        *[generated.alias("generated_at")] * (generated is not None),
        F.col("status").alias("overall_status"),
        "severity",
        "alerts",
        block(drift, "features", features, "feature").alias("drift_analysis"),
        block(performance, "metrics", metrics, "metric").alias("performance_analysis"),
        block(bias, "attributes", attributes, "attribute").alias("bias_analysis"),
    )


def retrain_decision(
    facts: DataFrame,
    drifted: Column,
    status: Column,
    trained_at: Column,
    now: Column,
    max_age_days: int = defaults.RETRAIN_AFTER_DAYS,
) -> DataFrame:
    """Adds ``retrain`` and ``reason``: drift, then critical status, then the model's age.

    The age counts fractions of a day, so it must exceed the limit, not just reach it.
    """
    expired = now > trained_at + F.expr(f"INTERVAL {int(max_age_days)} DAYS")
    reason = (
        F.when(F.coalesce(drifted, F.lit(False)), "drift")
        .when(F.coalesce(status == "critical", F.lit(False)), "critical")
        .when(F.coalesce(expired, F.lit(False)), "age")
        .otherwise("none")
    )
    return facts.withColumn("reason", reason).withColumn("retrain", F.col("reason") != "none")
