"""Joining features with labels, and the checks around it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortflow import defaults

KEYS = defaults.ID_COLUMNS


def require_columns(df: DataFrame, columns: Sequence[str], table: str) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"Missing required columns {missing} in {table}")


def duplicate_keys(df: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """(n_duplicates): rows beyond the first of each key."""
    groups = df.groupBy(*keys).agg(F.count("*").alias("n"))
    return groups.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("n_duplicates"))


def _tagged(df: DataFrame, keys: Sequence[str], left: int) -> DataFrame:
    return df.select(*keys, F.lit(left).alias("_left"), F.lit(1 - left).alias("_right"))


def key_overlap(left: DataFrame, right: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """(n_both, n_left_only, n_right_only) over distinct keys.

    The tagged union is aggregated once; a key's copies meet as partial aggregates.
    """
    sides = (
        _tagged(left, keys, 1)
        .unionByName(_tagged(right, keys, 0))
        .groupBy(*keys)
        .agg(F.max("_left").alias("l"), F.max("_right").alias("r"))
    )
    return sides.agg(
        F.count_if((F.col("l") == 1) & (F.col("r") == 1)).alias("n_both"),
        F.count_if(F.col("r") == 0).alias("n_left_only"),
        F.count_if(F.col("l") == 0).alias("n_right_only"),
    )


def _distinct(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Set operations join on the keys; distinct ones first, so that copies never travel."""
    return df.select(*keys).distinct()


def keys_intersect(left: DataFrame, right: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    return _distinct(left, keys).intersect(_distinct(right, keys))


def keys_except(left: DataFrame, right: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    return _distinct(left, keys).subtract(_distinct(right, keys))


def merge_training(
    features: DataFrame,
    labels: DataFrame,
    keys: Sequence[str] = KEYS,
    target: str = defaults.TARGET,
) -> DataFrame:
    """Features with their label; rows whose label is missing are dropped."""
    require_columns(features, keys, "features")
    require_columns(labels, keys, "labels")
    known = labels.where(F.col(target).isNotNull()) if target in labels.columns else labels
    return features.join(known, list(keys), "inner")
