"""Isotonic calibration of scores and reliability tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortflow import defaults
from cohortflow.functions import isotonic
from cohortflow.functions.bins import unit_bin_left_closed, unit_bin_right_closed
from cohortflow.functions.scalars import nan_as_missing
from cohortflow.operators.merge import require_columns
from cohortflow.sources.scratch import discard, settle


def fit_isotonic(
    scored: DataFrame,
    score: str = "prediction_proba",
    label: str = defaults.TARGET,
    points_per_range: int = isotonic.POINTS_PER_RANGE,
) -> DataFrame:
    """(score, calibrated): the break points of the isotonic fit of label on score.

    Equal scores become one weighted point first; the fit is the same and a score shared by many
    rows costs one row. Violators are pooled inside ranges of ``points_per_range`` scores and then across
    their seams, so no task and not the driver holds all of them. Without rows there are no points.
    """
    require_columns(scored, [score, label], "scored rows")
    points = (
        nan_as_missing(scored).where(F.col(score).isNotNull() & F.col(label).isNotNull())
        .groupBy(F.col(score).cast("double").alias("score"))
        .agg(F.sum(F.col(label).cast("double")).alias("total"), F.count("*").cast("double").alias("weight"))
    )
    points = settle(points, "points")
    blocks = isotonic.fit_blocks(points, points_per_range)
    discard(points)
    return isotonic.break_points(blocks)


def apply_isotonic(
    points: DataFrame, scored: DataFrame, score: str = "prediction_proba", name: str = "prediction_calibrated"
) -> DataFrame:
    """Adds the calibrated score: linear between the fitted points, clipped outside."""
    return isotonic.interpolated(points, scored, score, name)


def reliability_left_closed(
    scored: DataFrame, raw: str, calibrated: str, label: str = defaults.TARGET
) -> DataFrame:
    """(bin, n, true_rate, mean_raw, mean_calibrated) over tenths [lo, hi) of the raw score."""
    return (
        nan_as_missing(scored).withColumn("bin", unit_bin_left_closed(F.col(raw)))
        .where(F.col("bin").isNotNull())
        .groupBy("bin")
        .agg(
            F.count("*").alias("n"),
            F.avg(F.col(label).cast("double")).alias("true_rate"),
            F.avg(raw).alias("mean_raw"),
            F.avg(calibrated).alias("mean_calibrated"),
        )
    )


def reliability_right_closed(
    scored: DataFrame, score: str = "prediction_proba", label: str = defaults.TARGET
) -> DataFrame:
    """(bin, centre, true_rate, n) over tenths (lo, hi] of the score."""
    return (
        nan_as_missing(scored).withColumn("bin", unit_bin_right_closed(F.col(score)))
        .where(F.col("bin").isNotNull())
        .groupBy("bin")
        .agg(F.avg(F.col(label).cast("double")).alias("true_rate"), F.count("*").alias("n"))
        .select("bin", ((F.col("bin") + 0.5) / 10).cast("double").alias("centre"), "true_rate", "n")
    )


def score_range(
    scored: DataFrame, score: str = "prediction_proba", label: str = defaults.TARGET
) -> DataFrame:
    """(label, n, min_score, max_score)."""
    return nan_as_missing(scored).groupBy(F.col(label).cast("int").alias("label")).agg(
        F.count("*").alias("n"), F.min(score).alias("min_score"), F.max(score).alias("max_score")
    )
