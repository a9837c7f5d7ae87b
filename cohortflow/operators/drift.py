"""Distribution drift between a reference and a current table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortflow import defaults
from cohortflow.functions.bins import bin_of, widened
from cohortflow.functions.pvalues import ks_p_value, two_sided_normal_p
from cohortflow.functions.ranks import exact_quantiles, moments, running_totals, value_table
from cohortflow.operators.quality import numeric_columns
from cohortflow.sources.scratch import settle


def monitored_features(reference: DataFrame) -> list[str]:
    """Numeric columns other than ids, target and predictions."""
    return numeric_columns(reference)


def value_counts(
    reference: DataFrame, current: DataFrame, features: Sequence[str], parts: int | None = None
) -> DataFrame:
    """(series, value, ref, cur, part): how often each side has each value of each feature, stored.

    The one read of both tables that all statistics below rest on. Features that the current
    table lacks are missing in all its rows.
    """
    present = [c for c in features if c in current.columns]
    left = reference.select(*features, F.lit(1).cast("long").alias("ref"), F.lit(0).cast("long").alias("cur"))
    right = current.select(*present, F.lit(0).cast("long").alias("ref"), F.lit(1).cast("long").alias("cur"))
    both = left.unionByName(right, allowMissingColumns=True)
    return value_table(both, features, {"ref": F.col("ref"), "cur": F.col("cur")}, parts)


def reference_stats(
    reference: DataFrame, features: Sequence[str], parts: int | None = None
) -> DataFrame:
    """(feature, mean, std, median, q25, q75, min, max, count, missing_rate)."""
    table = value_table(reference, features, {"n": F.lit(1).cast("long")}, parts)
    quantiles = exact_quantiles(
        running_totals(table, ["n"]), "n", {"median": 0.5, "q25": 0.25, "q75": 0.75}
    )
    missing = F.try_divide(F.col("n_missing").cast("double"), F.col("n_missing") + F.col("n_count"))
    return moments(table, ["n"]).join(quantiles, "series", "left").select(
        F.col("series").alias("feature"),
        *[F.col(f"n_{m}").alias(m) for m in ("mean", "std")],
        "median",
        "q25",
        "q75",
        *[F.col(f"n_{m}").alias(m) for m in ("min", "max", "count")],
        missing.alias("missing_rate"),
    )


def rank_tests(
    reference: DataFrame, current: DataFrame, features: Sequence[str], parts: int | None = None
) -> DataFrame:
    """Kolmogorov-Smirnov and Mann-Whitney numbers per feature from one set of ranks.

    (feature, ks_statistic, ks_p_value, mw_statistic, mw_z, mw_p_value); features with
    no values on either side are left out.
    """
    return _rank_tests(value_counts(reference, current, features, parts))


def _rank_tests(table: DataFrame) -> DataFrame:
    ranks = running_totals(table, ["ref", "cur"])
    n1, n2 = F.col("ref_all").cast("double"), F.col("cur_all").cast("double")
    gap = F.abs(
        F.try_divide(F.col("ref_below") + F.col("ref"), n1)
        - F.try_divide(F.col("cur_below") + F.col("cur"), n2)
    )
    tied = (F.col("ref") + F.col("cur")).cast("double")
    middle_rank = F.col("ref_below") + F.col("cur_below") + (tied + 1.0) / 2.0
    sums = (
        ranks.where((F.col("ref_all") > 0) & (F.col("cur_all") > 0))
        .groupBy(F.col("series").alias("feature"))
        .agg(
            F.max(gap).alias("ks_statistic"),
            F.max(n1).alias("n1"),
            F.max(n2).alias("n2"),
            F.sum(F.col("ref") * middle_rank).alias("rank_sum"),
            F.sum(tied * tied * tied - tied).alias("ties"),
        )
    )
    n1, n2 = F.col("n1"), F.col("n2")
    n = n1 + n2
    u = F.col("rank_sum") - n1 * (n1 + 1.0) / 2.0
    tie_part = F.coalesce(F.try_divide(F.col("ties"), n * (n - 1.0)), F.lit(0.0))
    sigma = F.sqrt(F.greatest(F.lit(0.0), n1 * n2 / 12.0 * (n + 1.0 - tie_part)))
    z = F.try_divide(F.greatest(u, n1 * n2 - u) - n1 * n2 / 2.0 - 0.5, sigma)
    return sums.select(
        "feature",
        "ks_statistic",
        ks_p_value(F.col("ks_statistic"), n1, n2).alias("ks_p_value"),
        u.alias("mw_statistic"),
        z.alias("mw_z"),
        F.coalesce(two_sided_normal_p(z), F.lit(1.0)).alias("mw_p_value"),
    )


def ks_two_sample(
    reference: DataFrame,
    current: DataFrame,
    features: Sequence[str],
    alpha: float = defaults.SIGNIFICANCE,
    **kw,
) -> DataFrame:
    return rank_tests(reference, current, features, **kw).select(
        "feature", "ks_statistic", "ks_p_value", (F.col("ks_p_value") < alpha).alias("ks_drift")
    )


def mann_whitney(
    reference: DataFrame,
    current: DataFrame,
    features: Sequence[str],
    alpha: float = defaults.SIGNIFICANCE,
    **kw,
) -> DataFrame:
    return rank_tests(reference, current, features, **kw).select(
        "feature", "mw_statistic", "mw_z", "mw_p_value",
        (F.col("mw_p_value") < alpha).alias("mw_drift"),
    )


def psi(
    reference: DataFrame,
    current: DataFrame,
    features: Sequence[str],
    bins: int = defaults.PSI_BINS,
    parts: int | None = None,
) -> DataFrame:
    """(feature, psi, psi_drift). Equal-width bins over the reference's range.

    Values beyond that range fall into the outer bins, as if those reached out to them.
    """
    table = value_counts(reference, current, features, parts)
    return _psi(table, _comparable(table), bins)


def _comparable(table: DataFrame) -> DataFrame:
    """Both sides' moments, a row per feature that both have values of."""
    found = moments(table, ["ref", "cur"]).withColumnRenamed("series", "feature")
    return found.where((F.col("ref_count") > 0) & (F.col("cur_count") > 0))


def _psi(table: DataFrame, sides: DataFrame, bins: int = defaults.PSI_BINS) -> DataFrame:
    # One row per feature.
    ranges = sides.select(F.col("feature").alias("series"), "ref_count", "cur_count", "ref_min", "ref_max")
    low, high = widened(F.col("ref_min"), F.col("ref_max"))
    placed = (
        table.where(F.col("value").isNotNull())
        .join(F.broadcast(ranges), "series")
        .withColumn("bin", bin_of(F.col("value"), low, high, bins))
    )
    counts = placed.groupBy("series", "bin", "ref_count", "cur_count").agg(
        F.sum("ref").alias("ref"), F.sum("cur").alias("cur")
    )
    # Bins that neither side reaches add nothing: both shares are the floor.
    r = _floored(F.col("ref"), F.col("ref_count"))
    c = _floored(F.col("cur"), F.col("cur_count"))
    return (
        counts.groupBy(F.col("series").alias("feature"))
        .agg(F.sum((c - r) * F.ln(c / r)).alias("psi"))
        .withColumn("psi_drift", F.col("psi") > defaults.PSI_LIMIT)
    )


def _floored(count: Column, total: Column) -> Column:
    return F.when(count == 0, F.lit(defaults.PSI_FLOOR)).otherwise(count.cast("double") / total)


def feature_drift(
    reference: DataFrame,
    current: DataFrame,
    features: Sequence[str],
    alpha: float = defaults.SIGNIFICANCE,
    parts: int | None = None,
) -> DataFrame:
    """Per feature: both sides' mean, std and count, the three tests and the verdict. Each
    table is read once."""
    table = value_counts(reference, current, features, parts)
    sides = settle(_comparable(table), "moments")  # a row per feature
    fired = (
        F.coalesce(F.col("ks_p_value") < alpha, F.lit(False))
        | F.coalesce(F.col("mw_p_value") < alpha, F.lit(False))
        | F.coalesce(F.col("psi_drift"), F.lit(False))
    )
    # One row per feature on every side.
    return (
        sides.drop("ref_min", "ref_max", "cur_min", "cur_max", "ref_missing", "cur_missing")
        .join(F.broadcast(_rank_tests(table)), "feature", "left")
        .join(F.broadcast(_psi(table, sides)), "feature", "left")
        .withColumn("drift_detected", fired)
    )


def drift_summary(drift: DataFrame, total_features: int) -> DataFrame:
    """(total_features, drifted_features, drift_rate, overall_drift_detected).

    Monitored features without values stay in the denominator.
    """
    drifted = F.count_if("drift_detected")
    rate = drifted.cast("double") / F.lit(float(total_features))
    return drift.agg(
        F.lit(total_features).alias("total_features"),
        drifted.alias("drifted_features"),
        rate.alias("drift_rate"),
        (rate > defaults.DRIFT_RATE_LIMIT).alias("overall_drift_detected"),
    )
