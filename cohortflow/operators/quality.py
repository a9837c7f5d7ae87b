"""Profiles, distributions and leakage audits of the training table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortflow import defaults
from cohortflow.functions.bins import bin_of, edge, widened
from cohortflow.functions.ranks import (
    exact_quantiles,
    long_values,
    running_totals,
    value_table,
)
from cohortflow.functions.scalars import days, nan_as_missing, time_literal
from cohortflow.operators.windows import (
    DAY,
    cut_events,
    exact_grain,
    instant,
    running_counts,
    span_cells,
    time_cell,
)

NUMERIC = (T.LongType, T.IntegerType, T.DoubleType, T.FloatType)
WHISKER = 1.5


def numeric_columns(df: DataFrame, exclude: Sequence[str] = defaults.NOT_FEATURES) -> list[str]:
    return [
        f.name for f in df.schema if isinstance(f.dataType, NUMERIC) and f.name not in exclude
    ]


def _per_column(df: DataFrame, aggregates: Mapping[str, Column], rows: list[Column]) -> DataFrame:
    """One aggregate over the table, turned into a row per column."""
    return df.agg(*[a.alias(n) for n, a in aggregates.items()]).select(F.inline(F.array(*rows)))


def feature_completeness(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature, nonnull_pct, n_missing, is_empty); the share of an empty table is NULL."""
    df = nan_as_missing(df)
    counts = {"_rows": F.count("*"), **{c: F.count(c) for c in columns}}
    rows = [
        F.struct(
            F.lit(c).alias("feature"),
            F.try_divide(F.lit(100.0) * F.col(c), F.col("_rows")).alias("nonnull_pct"),
            (F.col("_rows") - F.col(c)).alias("n_missing"),
            (F.col(c) == 0).alias("is_empty"),
        )
        for c in columns
    ]
    return _per_column(df, counts, rows)


def empty_features(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return feature_completeness(df, columns).where("is_empty").select("feature")


def dataset_overview(
    datasets: Mapping[str, DataFrame], features: Sequence[str], target: str = defaults.TARGET
) -> DataFrame:
    """(dataset, n_rows, n_features, positive_rate) per named table."""
    parts = [
        df.agg(
            F.lit(name).alias("dataset"),
            F.count("*").alias("n_rows"),
            F.lit(len(features)).alias("n_features"),
            F.avg(F.col(target).cast("double")).alias("positive_rate"),
        )
        for name, df in datasets.items()
    ]
    overview = parts[0]
    for part in parts[1:]:
        overview = overview.unionByName(part)
    return overview


def feature_histogram(df: DataFrame, columns: Sequence[str], bins: int = 30) -> DataFrame:
    """(feature, bin, bin_low, n): equal-width bins between a feature's min and max."""
    values = long_values(df, columns, {}, "feature").where(F.col("value").isNotNull())
    # One row per feature.
    ranges = values.groupBy("feature").agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    low, high = widened(F.col("lo"), F.col("hi"))
    ranges = ranges.select("feature", low.alias("low"), high.alias("high"))
    low, high = F.col("low"), F.col("high")
    placed = values.join(F.broadcast(ranges), "feature").select(
        "feature", "low", "high", bin_of(F.col("value"), low, high, bins).alias("bin")
    )
    return placed.groupBy("feature", "bin", "low", "high").agg(F.count("*").alias("n")).select(
        "feature", "bin", edge(low, high, bins, F.col("bin")).alias("bin_low"), "n"
    )


def feature_boxstats(df: DataFrame, columns: Sequence[str], parts: int | None = None) -> DataFrame:
    """(feature, q1, median, q3, low_whisker, high_whisker, n_outliers), exact.

    Whiskers are the furthest values within 1.5 interquartile ranges of the box. The table
    is read once; a feature without values has no row.
    """
    table = value_table(df, columns, {"n": F.lit(1).cast("long")}, parts)
    boxes = exact_quantiles(running_totals(table, ["n"]), "n", {"q1": 0.25, "median": 0.5, "q3": 0.75})
    reach = (F.col("q3") - F.col("q1")) * WHISKER
    inside = F.col("value").between(F.col("q1") - reach, F.col("q3") + reach)
    # One row per feature on the broadcast side.
    return (
        table.where(F.col("value").isNotNull())
        .join(F.broadcast(boxes), "series")
        .groupBy(F.col("series").alias("feature"), "q1", "median", "q3")
        .agg(
            F.min(F.when(inside, F.col("value"))).alias("low_whisker"),
            F.max(F.when(inside, F.col("value"))).alias("high_whisker"),
            F.sum(F.when(inside, 0).otherwise(F.col("n"))).alias("n_outliers"),
        )
    )


def sample_rows(
    df: DataFrame, columns: Sequence[str], order_by: Sequence[str], n: int = 5
) -> DataFrame:
    """The first n rows by key, with those of the columns that exist."""
    return df.orderBy(*order_by).select(*[c for c in columns if c in df.columns]).limit(n)


def leakage_audit(
    index: DataFrame,
    events: DataFrame,
    event_time: str,
    lookback_days: int = defaults.LOOKBACK_DAYS,
    entity: str = "patient",
    as_of: str = "as_of",
    at: datetime | str | None = None,
    grain: int = DAY,
) -> DataFrame:
    """(entity, as_of, n_in_window, n_after, n_before): an entity's events by position."""
    names = ["n_in_window", "n_after", "n_before"]
    time = F.col(event_time)
    if at is not None:
        high = time_literal(at, events, event_time)
        low = high - days(lookback_days)
        found = events.groupBy(entity).agg(
            F.count_if(time.between(low, high)).alias(names[0]),
            F.count_if(time > high).alias(names[1]),
            F.count_if(time < low).alias(names[2]),
        )
        return index.select(entity, as_of).join(found, entity, "left").fillna(0, names)
    cells = (
        events.where(time.isNotNull())
        .groupBy(entity, time_cell(time, grain).alias("_cell"))
        .agg(F.count("*").alias("_upto"))
    )
    # A cell enters "before the lookback" one window and one cell later.
    shift = span_cells(lookback_days, grain) + 1
    entered = cells.select(entity, "_cell", "_upto", F.lit(0).cast("long").alias("_old"))
    left = cells.select(
        entity,
        (F.col("_cell") + shift).alias("_cell"),
        F.lit(0).cast("long").alias("_upto"),
        F.col("_upto").alias("_old"),
    )
    steps = (
        entered.unionByName(left)
        .groupBy(entity, "_cell")
        .agg(F.sum("_upto").alias("_upto"), F.sum("_old").alias("_old"))
    )
    found = running_counts(index, steps, ["_upto", "_old"], entity, as_of, grain)
    if exact_grain(index, as_of, grain) != grain:
        # Of the two cells that hold a window's ends, only a part lies before them.
        ends = [-span_cells(lookback_days, grain), 0]
        cut = cut_events(index, events, event_time, ends, entity, as_of, grain)
        here, end = instant(time), instant(F.col("_as_of"))
        parts = cut.groupBy(entity, F.col("_as_of").alias(as_of)).agg(
            F.count_if((F.col("_offset") == 0) & (here > end)).alias("_late"),
            F.count_if((F.col("_offset") != 0) & (here < end - lookback_days * DAY)).alias("_early"),
        )
        found = (
            found.join(parts, [entity, as_of], "left")
            .fillna(0, ["_late", "_early"])
            .select(
                entity,
                as_of,
                (F.col("_upto") - F.col("_late")).alias("_upto"),
                (F.col("_old") + F.col("_early")).alias("_old"),
            )
        )
    totals = cells.groupBy(entity).agg(F.sum("_upto").alias("_all"))
    return (
        index.select(entity, as_of)
        .join(found, [entity, as_of], "left")
        .join(totals, entity, "left")
        .fillna(0, ["_upto", "_old", "_all"])
        .select(
            entity,
            as_of,
            (F.col("_upto") - F.col("_old")).alias(names[0]),
            (F.col("_all") - F.col("_upto")).alias(names[1]),
            F.col("_old").alias(names[2]),
        )
    )


def target_correlation(
    df: DataFrame,
    columns: Sequence[str],
    target: str = defaults.TARGET,
    limit: float = 0.9,
) -> DataFrame:
    """(feature, correlation, leaks): all features against the target in one aggregate."""
    df = nan_as_missing(df)
    correlations = {
        c: F.corr(F.col(c).cast("double"), F.col(target).cast("double")) for c in columns
    }
    rows = [
        F.struct(
            F.lit(c).alias("feature"),
            F.col(c).alias("correlation"),
            F.coalesce(F.abs(F.col(c)) > limit, F.lit(False)).alias("leaks"),
        )
        for c in columns
    ]
    return _per_column(df, correlations, rows)


def target_like_columns(df: DataFrame, target: str = defaults.TARGET) -> list[str]:
    """Columns other than the target whose name betrays a label."""
    return [c for c in df.columns if "label" in c.lower() and c != target]
