"""The look-back feature vector of each index row."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortflow import defaults
from cohortflow.functions.scalars import (
    band,
    code_in,
    nan_as_missing,
    split_names,
    text_matches,
    tolerant_number,
)
from cohortflow.operators.windows import (
    DAY,
    Count,
    Last,
    Stats,
    active_distinct,
    lookback_aggregates,
)


def observations_by_code(
    observations: DataFrame, codes: Sequence[str], code: str = "Code"
) -> DataFrame:
    return observations.where(code_in(F.col(code), codes))


def observations_by_description(
    observations: DataFrame, term: str, description: str = "Description"
) -> DataFrame:
    return observations.where(text_matches(F.col(description), term))


def selector(
    codes: str | Iterable[str] | None,
    term: str,
    code: str = "Code",
    description: str = "Description",
) -> Column:
    """Rows of a measurement: by code, or by description when no code is given."""
    names = split_names(codes)
    return code_in(F.col(code), names) if names else text_matches(F.col(description), term)


def rolling_features(
    index: DataFrame,
    observations: DataFrame,
    encounters: DataFrame,
    medications: DataFrame,
    lookback_days: int = defaults.LOOKBACK_DAYS,
    hba1c_codes: str | Iterable[str] | None = None,
    sbp_codes: str | Iterable[str] | None = None,
    dbp_codes: str | Iterable[str] | None = None,
    entity: str = "patient",
    as_of: str = "as_of",
    terms: Sequence[str] = (defaults.HBA1C_TERM, defaults.SBP_TERM, defaults.DBP_TERM),
    ties: Sequence[str] = (),
    at: datetime | str | None = None,
    grain: int = DAY,
) -> DataFrame:
    """(entity, as_of, eight features), one row per index row.

    Event tables use the source column names and carry the entity column. Each is
    aggregated by itself and joined to the index afterwards; one join of all three
    would multiply their rows. ``ties`` orders observations of the same instant.
    """
    number = tolerant_number(F.col("Value"))
    hba1c, sbp, dbp = (
        selector(codes, term) for codes, term in zip((hba1c_codes, sbp_codes, dbp_codes), terms)
    )
    keys = index.select(entity, as_of)
    where = {"entity": entity, "as_of": as_of, "at": at, "grain": grain}
    measures = [
        Count("n_observations_180d"),
        Last("hba1c_last", number, hba1c, ties),
        Stats("hba1c_mean", "hba1c_std", number, hba1c),
        Last("sbp_last", number, sbp, ties),
        Last("dbp_last", number, dbp, ties),
    ]
    rows = lookback_aggregates(keys, observations, measures, "Date", lookback_days, **where)
    rows = lookback_aggregates(
        keys, encounters, [Count("n_encounters_180d")], "Start", lookback_days, onto=rows, **where
    )
    rows = active_distinct(
        keys, medications, "Start", "Stop", "Description", lookback_days,
        "n_active_meds_180d", onto=rows, **where,
    )
    return rows.select(entity, as_of, *defaults.FEATURES)


def clinical_bands(
    features: DataFrame, hba1c: str = "hba1c_last", sbp: str = "sbp_last", dbp: str = "dbp_last"
) -> DataFrame:
    return nan_as_missing(features).select(
        "*",
        band(F.col(hba1c), defaults.HBA1C_BANDS).alias("hba1c_band"),
        band(F.col(sbp), defaults.SBP_BANDS).alias("sbp_band"),
        band(F.col(dbp), defaults.DBP_BANDS).alias("dbp_band"),
    )


def nonnull_counts(features: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature, n_nonnull, n_rows) from one aggregate."""
    counts = nan_as_missing(features).agg(F.count("*").alias("_rows"), *[F.count(c).alias(c) for c in columns])
    rows = [
        F.struct(
            F.lit(c).alias("feature"),
            F.col(c).alias("n_nonnull"),
            F.col("_rows").alias("n_rows"),
        )
        for c in columns
    ]
    return counts.select(F.inline(F.array(*rows)))
