"""Classifier metrics over scored rows. Labels are 0/1, scores lie in [0, 1]."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortflow import defaults
from cohortflow.functions.ranks import ranked_values
from cohortflow.functions.scalars import nan_as_missing, ratio


def score_ranks(
    scored: DataFrame,
    scores: Sequence[str],
    label: str = defaults.TARGET,
    parts: int | None = None,
) -> DataFrame:
    """Distinct scores with positives and negatives at, below and overall, per score column."""
    positive = F.col(label).cast("long")
    labelled = nan_as_missing(scored).where(F.col(label).isNotNull())
    weights = {"pos": positive, "neg": F.lit(1) - positive}
    return ranked_values(labelled, scores, weights, parts)


def auroc_from_ranks(ranks: DataFrame) -> DataFrame:
    """(series, auroc): ties count half, a single class gives NULL."""
    pairs = F.col("pos").cast("double") * (F.col("neg_below") + F.col("neg") / F.lit(2.0))
    return ranks.groupBy("series").agg(
        F.try_divide(
            F.sum(pairs), F.max("pos_all").cast("double") * F.max("neg_all")
        ).alias("auroc")
    )


def average_precision_from_ranks(ranks: DataFrame) -> DataFrame:
    """(series, average_precision): step sum over descending distinct scores."""
    true_above = F.col("pos_all") - F.col("pos_below")
    all_above = true_above + F.col("neg_all") - F.col("neg_below")
    step = ratio(F.col("pos"), F.col("pos_all")) * ratio(true_above, all_above)
    return ranks.groupBy("series").agg(F.sum(step).alias("average_precision"))


def auroc(scored: DataFrame, scores: Sequence[str], label: str = defaults.TARGET, **kw) -> DataFrame:
    return auroc_from_ranks(score_ranks(scored, scores, label, **kw))


def average_precision(
    scored: DataFrame, scores: Sequence[str], label: str = defaults.TARGET, **kw
) -> DataFrame:
    return average_precision_from_ranks(score_ranks(scored, scores, label, **kw))


def brier(scored: DataFrame, scores: Sequence[str], label: str = defaults.TARGET) -> DataFrame:
    """(series, brier) for every score column, one aggregate."""
    y = F.col(label).cast("double")
    means = nan_as_missing(scored).agg(*[F.avg(F.pow(F.col(s) - y, F.lit(2.0))).alias(s) for s in scores])
    rows = [F.struct(F.lit(s).alias("series"), F.col(s).alias("brier")) for s in scores]
    return means.select(F.inline(F.array(*rows)))


def roc_curve(
    scored: DataFrame,
    score: str = "prediction_proba",
    label: str = defaults.TARGET,
    parts: int | None = None,
) -> DataFrame:
    """(threshold, fpr, tpr) at every distinct score; no rows for a single class.

    The curve's origin (0, 0) lies above the largest score and has no row.
    """
    ranks = score_ranks(scored, [score], label, parts)
    return ranks.where((F.col("pos_all") > 0) & (F.col("neg_all") > 0)).select(
        F.col("value").alias("threshold"),
        ((F.col("neg_all") - F.col("neg_below")) / F.col("neg_all")).alias("fpr"),
        ((F.col("pos_all") - F.col("pos_below")) / F.col("pos_all")).alias("tpr"),
    )


def confusion_at_thresholds(
    scored: DataFrame,
    thresholds: Mapping[str, float],
    score: str = "prediction_proba",
    label: str = defaults.TARGET,
    by: Sequence[str] = (),
) -> DataFrame:
    """(*by, name, threshold, tp, fp, fn, tn) with ``score >= threshold`` as positive.

    Rows are counted by how many thresholds they reach, so the table is read once
    whatever the number of thresholds; the rest works on (thresholds + 1) rows.
    """
    ordered = sorted(thresholds.items(), key=lambda item: item[1])
    reached = F.lit(0)
    for _, cut in ordered:
        reached = reached + (F.col(score) >= F.lit(float(cut))).cast("int")
    y = F.col(label)
    levels = (
        nan_as_missing(scored).where(y.isNotNull() & F.col(score).isNotNull())
        .groupBy(*by, reached.alias("_level"))
        .agg(F.count_if(y == 1).alias("_pos"), F.count_if(y == 0).alias("_neg"))
    )
    rows = [
        F.struct(
            F.lit(name).alias("name"),
            F.lit(float(cut)).alias("threshold"),
            F.when(F.col("_level") > i, F.col("_pos")).otherwise(0).alias("_tp"),
            F.when(F.col("_level") > i, F.col("_neg")).otherwise(0).alias("_fp"),
        )
        for i, (name, cut) in enumerate(ordered)
    ]
    return (
        levels.select(*by, "_pos", "_neg", F.inline(F.array(*rows)))
        .groupBy(*by, "name", "threshold")
        .agg(
            F.sum("_tp").alias("tp"),
            F.sum("_fp").alias("fp"),
            (F.sum("_pos") - F.sum("_tp")).alias("fn"),
            (F.sum("_neg") - F.sum("_fp")).alias("tn"),
        )
    )


def threshold_metrics(confusion: DataFrame) -> DataFrame:
    """Adds sensitivity, specificity, ppv, npv and f1; 0.0 where undefined."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return confusion.select(
        "*",
        ratio(tp, tp + fn, 0.0).alias("sensitivity"),
        ratio(tn, tn + fp, 0.0).alias("specificity"),
        ratio(tp, tp + fp, 0.0).alias("ppv"),
        ratio(tn, tn + fn, 0.0).alias("npv"),
        ratio(2 * tp, 2 * tp + fp + fn, 0.0).alias("f1"),
    )


def sweep_thresholds(
    low: float = defaults.SWEEP_RANGE[0],
    high: float = defaults.SWEEP_RANGE[1],
    steps: int = defaults.SWEEP_STEPS,
) -> dict[str, float]:
    """Evenly spaced thresholds, both ends included."""
    step = (high - low) / (steps - 1)
    return {f"t{i:02d}": low + i * step for i in range(steps)}


def threshold_sweep(
    scored: DataFrame,
    key: Column,
    thresholds: Mapping[str, float] | None = None,
    folds: int = defaults.SWEEP_FOLDS,
    score: str = "prediction_proba",
    label: str = defaults.TARGET,
) -> DataFrame:
    """(threshold, mean_f1) over folds. A row's fold comes from the hash of its key."""
    fold = F.pmod(F.conv(F.substring(F.md5(key.cast("string")), 1, 8), 16, 10).cast("long"), F.lit(folds))
    cuts = thresholds or sweep_thresholds()
    confusion = confusion_at_thresholds(
        scored.withColumn("fold", fold), cuts, score, label, by=["fold"]
    )
    return threshold_metrics(confusion).groupBy("threshold").agg(F.avg("f1").alias("mean_f1"))


def best_threshold(sweep: DataFrame) -> DataFrame:
    return sweep.orderBy(F.desc("mean_f1"), "threshold").limit(1)


def metrics_row(
    scored: DataFrame,
    raw: str,
    calibrated: str,
    label: str = defaults.TARGET,
    parts: int | None = None,
) -> DataFrame:
    """One row: auroc, auprc and brier, each for the raw and the calibrated score."""
    scores = {"raw": raw, "calibrated": calibrated}
    ranks = score_ranks(scored, list(scores.values()), label, parts)
    pairs = F.col("pos").cast("double") * (F.col("neg_below") + F.col("neg") / F.lit(2.0))
    true_above = F.col("pos_all") - F.col("pos_below")
    all_above = true_above + F.col("neg_all") - F.col("neg_below")
    step = ratio(F.col("pos"), F.col("pos_all")) * ratio(true_above, all_above)
    ranked = []
    for suffix, column in scores.items():
        mine = F.col("series") == column
        ranked += [
            F.try_divide(
                F.sum(F.when(mine, pairs)),
                F.max(F.when(mine, F.col("pos_all"))).cast("double")
                * F.max(F.when(mine, F.col("neg_all"))),
            ).alias(f"auroc_{suffix}"),
            F.sum(F.when(mine, step)).alias(f"auprc_{suffix}"),
        ]
    y = F.col(label).cast("double")
    errors = nan_as_missing(scored).agg(
        F.struct(
            *[
                F.avg(F.pow(F.col(column) - y, F.lit(2.0))).alias(suffix)
                for suffix, column in scores.items()
            ]
        )
    ).scalar()
    return ranks.agg(*ranked).select(
        "auroc_raw",
        "auroc_calibrated",
        "auprc_raw",
        "auprc_calibrated",
        errors["raw"].alias("brier_raw"),
        errors["calibrated"].alias("brier_calibrated"),
    )


def metrics_report(metrics: DataFrame, confusion_metrics: DataFrame) -> DataFrame:
    """One row in the shape of ``schemas.METRICS_REPORT``."""
    block = F.struct(
        "threshold",
        F.struct("tn", "fp", "fn", "tp").alias("confusion_matrix"),
        F.struct("sensitivity", "specificity", "ppv", "npv", "f1").alias("metrics"),
    )
    # One entry per named threshold.
    blocks = confusion_metrics.agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("name", block.alias("block")))))
    ).scalar()
    return metrics.select(
        F.struct(*metrics.columns).alias("metrics"), blocks.alias("confusion_matrices")
    )


def quality_gate(metrics: DataFrame) -> DataFrame:
    """Boolean verdicts on a ``metrics_row``; an unknown metric fails its gate."""
    gates = {
        "auroc_ok": F.col("auroc_calibrated") >= defaults.GATE_AUROC,
        "auprc_ok": F.col("auprc_calibrated") >= defaults.GATE_AUPRC,
        "brier_ok": F.col("brier_calibrated") <= defaults.GATE_BRIER,
        "calibration_ok": F.col("brier_calibrated") <= F.col("brier_raw"),
    }
    return metrics.select(*[F.coalesce(g, F.lit(False)).alias(n) for n, g in gates.items()])
