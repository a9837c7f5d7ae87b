"""Score differences between groups of protected attributes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortflow import defaults
from cohortflow.functions.scalars import nan_as_missing


def bias_group_stats(
    scored: DataFrame,
    attributes: Sequence[str],
    score: str = "prediction_proba",
    label: str = defaults.TARGET,
) -> DataFrame:
    """(attribute, group, n, positive_rate, prediction_mean, prediction_std).

    Attributes the table lacks are skipped, as are rows without a group.
    """
    present = [a for a in attributes if a in scored.columns]
    if not present:
        raise ValueError(f"none of {list(attributes)} is a column")
    parts = [
        F.struct(F.lit(a).alias("attribute"), F.col(a).cast("string").alias("group"))
        for a in present
    ]
    rate = F.avg(F.col(label).cast("double")) if label in scored.columns else F.lit(None).cast("double")
    kept = [c for c in (score, label) if c in scored.columns]
    return (
        nan_as_missing(scored).select(*kept, F.inline(F.array(*parts)))
        .where(F.col("group").isNotNull())
        .groupBy("attribute", "group")
        .agg(
            F.count("*").alias("n"),
            rate.alias("positive_rate"),
            F.avg(score).alias("prediction_mean"),
            F.stddev_samp(score).alias("prediction_std"),
        )
    )


def bias_metrics(groups: DataFrame) -> DataFrame:
    """(attribute, n_groups, demographic_parity_diff, prediction_variance, bias_detected)."""
    mean = F.col("prediction_mean")
    enough = F.count(mean) >= 2
    measured = groups.groupBy("attribute").agg(
        F.count("*").alias("n_groups"),
        F.when(enough, F.max(mean) - F.min(mean)).alias("demographic_parity_diff"),
        F.when(enough, F.var_pop(mean)).alias("prediction_variance"),
    )
    verdict = (F.col("demographic_parity_diff") > defaults.PARITY_LIMIT) | (
        F.col("prediction_variance") > defaults.GROUP_VARIANCE_LIMIT
    )
    return measured.withColumn("bias_detected", F.coalesce(verdict, F.lit(False)))


def bias_summary(metrics: DataFrame, total_attributes: int) -> DataFrame:
    """(total_attributes, biased_attributes, bias_detected)."""
    biased = F.count_if("bias_detected")
    return metrics.agg(
        F.lit(total_attributes).alias("total_attributes"),
        biased.alias("biased_attributes"),
        (biased > 0).alias("bias_detected"),
    )
