"""Metric history, decline against a baseline, and trends."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortflow import defaults
from cohortflow.functions.scalars import nan_to_null
from cohortflow.sources.tables import append_batch


HISTORY = "metric string, seq bigint, value double, measured_at timestamp, analysis string, batch string"


def append_measurements(
    measurements: DataFrame,
    path: str,
    batch: str,
    measured_at: Column | None = None,
    analysis: Column | None = None,
) -> None:
    """(metric, seq, value) rows added to the history table under a batch's name, with the time
    and a text of what was found. Writing a batch again replaces it."""
    at = F.current_timestamp() if measured_at is None else measured_at
    text = F.lit(None) if analysis is None else analysis
    rows = measurements.select(
        "metric",
        F.col("seq").cast("bigint").alias("seq"),
        F.col("value").cast("double").alias("value"),
        at.cast("timestamp").alias("measured_at"),
        text.cast("string").alias("analysis"),
    )
    append_batch(rows, path, batch)


def read_history(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(HISTORY).parquet(path)


def recent_measurements(history: DataFrame, window: int = defaults.TREND_WINDOW) -> DataFrame:
    """``history`` reduced to each metric's last measurements, with ``back``, 1 for the last one.

    The rank filter keeps ``window`` rows per metric and task before the shuffle.
    """
    latest = Window.partitionBy("metric").orderBy(F.desc("seq"))
    return history.withColumn("back", F.row_number().over(latest)).where(F.col("back") <= window)


def metric_degradation(
    baseline: DataFrame,
    current: DataFrame,
    lower_is_better: tuple[str, ...] = defaults.LOWER_IS_BETTER,
    limit: float = defaults.DEGRADATION_LIMIT,
) -> DataFrame:
    """(metric, baseline, current, change, degraded) for metrics known to both.

    ``change`` is the loss: positive means worse, whichever way the metric points.
    """
    joined = baseline.select("metric", nan_to_null(F.col("value").cast("double")).alias("baseline")).join(
        current.select("metric", nan_to_null(F.col("value").cast("double")).alias("current")), "metric"
    )
    rise = F.col("current") - F.col("baseline")
    fall = F.col("baseline") - F.col("current")
    change = F.when(F.col("metric").isin(list(lower_is_better)), rise).otherwise(fall)
    return joined.withColumn("change", change).withColumn("degraded", F.col("change") > limit)


def metric_alerts(degradation: DataFrame) -> DataFrame:
    """(metric, alert) for each degraded metric."""
    text = F.format_string(
        defaults.DEGRADATION_ALERT, "metric", "baseline", "current", "change"
    )
    return degradation.where("degraded").select("metric", text.alias("alert"))


def degradation_summary(degradation: DataFrame) -> DataFrame:
    """(degradation_detected, alerts): one row; there is one alert per named metric."""
    alerts = metric_alerts(degradation).agg(
        F.sort_array(F.collect_list("alert")).alias("alerts")
    )
    return alerts.select((F.size("alerts") > 0).alias("degradation_detected"), "alerts")


def metric_trend(
    history: DataFrame,
    window: int = defaults.TREND_WINDOW,
    lower_is_better: tuple[str, ...] = defaults.LOWER_IS_BETTER,
) -> DataFrame:
    """(metric, n_recent, slope, trend) over each metric's last measurements."""
    recent = recent_measurements(history, window)
    position = (F.lit(0) - F.col("back")).cast("double")
    slopes = recent.groupBy("metric").agg(
        F.count("*").alias("n_recent"), F.regr_slope(F.col("value"), position).alias("slope")
    )
    inverted = F.col("metric").isin(list(lower_is_better))
    up = F.when(inverted, "degrading").otherwise("improving")
    down = F.when(inverted, "improving").otherwise("degrading")
    trend = (
        F.when(F.col("n_recent") < 2, "insufficient_data")
        .when(F.abs("slope") < defaults.TREND_FLAT, "stable")
        .when(F.col("slope") > 0, up)
        .otherwise(down)
    )
    return slopes.withColumn("trend", trend)
