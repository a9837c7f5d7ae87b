"""Checks on scoring requests and the batch response."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortflow import defaults
from cohortflow.functions.scalars import confidence, nan_to_null, risk_band

DATE_TEXT = r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$"


def _errors(checks: dict[str, Column]) -> Column:
    """Names of the checks that fired, in order."""
    fired = F.array(*[F.when(bad, F.lit(name)) for name, bad in checks.items()])
    return F.filter(fired, lambda name: name.isNotNull())


def _in_range(feature: str) -> Column:
    low, high, _ = defaults.FEATURE_RANGES[feature]
    return F.coalesce(F.col(feature).between(low, high), F.lit(False))


def range_errors() -> Column:
    checks = {}
    for feature, (low, high, required) in defaults.FEATURE_RANGES.items():
        if required:
            checks[f"{feature}:missing"] = nan_to_null(F.col(feature)).isNull()
        checks[f"{feature}:range"] = ~nan_to_null(F.col(feature)).between(low, high)
    return _errors(checks)


def cross_field_errors() -> Column:
    """Consistency of pairs of features; a pair with a missing or bad side is skipped."""
    means = _in_range("hba1c_mean") & _in_range("hba1c_last")
    pressures = _in_range("dbp_last") & _in_range("sbp_last")
    return _errors(
        {
            "hba1c_mean:inconsistent": means
            & (F.abs(F.col("hba1c_mean") - F.col("hba1c_last")) > defaults.HBA1C_MEAN_GAP),
            "dbp_last:not_below_sbp": pressures & (F.col("dbp_last") >= F.col("sbp_last")),
        }
    )


def request_errors(patient_id: str = "patient_id", as_of_date: str = "as_of_date") -> Column:
    shortest, longest = defaults.ID_LENGTH
    text = F.col(as_of_date)
    date_ok = text.rlike(DATE_TEXT) & F.try_to_timestamp(text, F.lit("yyyy-M-d")).isNotNull()
    return _errors(
        {
            "patient_id:length": ~F.coalesce(
                F.length(patient_id).between(shortest, longest), F.lit(False)
            ),
            "as_of_date:format": text.isNotNull() & ~date_ok,
        }
    )


def check_requests(
    requests: DataFrame, patient_id: str = "patient_id", as_of_date: str = "as_of_date"
) -> DataFrame:
    """Adds ``errors`` (all checks) and ``valid``."""
    found = F.concat(request_errors(patient_id, as_of_date), range_errors(), cross_field_errors())
    return requests.withColumn("errors", found).withColumn("valid", F.size("errors") == 0)


def batch_checks(
    requests: DataFrame, batch: str = "batch_id", patient_id: str = "patient_id"
) -> DataFrame:
    """(batch, n_requests, n_duplicate_ids, size_ok, unique_ok) per batch."""
    smallest, largest = defaults.BATCH_SIZE
    per_id = requests.groupBy(batch, patient_id).agg(F.count("*").alias("_n"))
    return (
        per_id.groupBy(batch)
        .agg(F.sum("_n").alias("n_requests"), F.count_if(F.col("_n") > 1).alias("n_duplicate_ids"))
        .withColumn("size_ok", F.col("n_requests").between(smallest, largest))
        .withColumn("unique_ok", F.col("n_duplicate_ids") == 0)
    )


def canonical_features(
    df: DataFrame, ids: Sequence[str], features: Sequence[str] = defaults.FEATURES
) -> DataFrame:
    """Ids, then the features in model order; an absent one is NULL."""
    return df.select(
        *ids,
        *[
            (F.col(f) if f in df.columns else F.lit(None)).cast("double").alias(f)
            for f in features
        ],
    )


def batch_response(checked: DataFrame, raw: Column, calibrated: Column) -> DataFrame:
    """Response columns for every request; a bad request has NULLs instead of a score."""
    ok = F.col("valid")
    scored = checked.withColumn("raw_score", F.when(ok, raw)).withColumn(
        "risk_score", F.when(ok, calibrated)
    )
    done = F.col("risk_score").isNotNull()
    return scored.withColumn(
        "risk_level", F.when(done, risk_band(F.col("risk_score")))
    ).withColumn("confidence", confidence(F.col("risk_score")))


def quarantine(responses: DataFrame) -> DataFrame:
    return responses.where(F.col("risk_score").isNull())


def batch_score_summary(responses: DataFrame, batch: str = "batch_id") -> DataFrame:
    """(batch, processed_count, failed_count)."""
    done = F.col("risk_score").isNotNull()
    return responses.groupBy(batch).agg(
        F.count_if(done).alias("processed_count"), F.count_if(~done).alias("failed_count")
    )
