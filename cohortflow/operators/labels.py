"""Outcome labels from events after the index date."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortflow import defaults
from cohortflow.functions.scalars import days, split_names, time_literal
from cohortflow.operators.windows import (
    DAY,
    cut_events,
    dealt,
    exact_grain,
    index_bounds,
    instant,
    join_cells,
    span_cells,
    time_cell,
)


def class_counts(encounters: DataFrame, event_class: str = "EncounterClass") -> DataFrame:
    """(encounter_class, n), most frequent first."""
    return (
        encounters.groupBy(F.lower(event_class).alias("encounter_class"))
        .agg(F.count("*").alias("n"))
        .orderBy(F.desc("n"), "encounter_class")
    )


def make_labels(
    index: DataFrame,
    encounters: DataFrame,
    window_days: int = defaults.PREDICTION_DAYS,
    positive_classes: str | Iterable[str] = defaults.POSITIVE_CLASSES,
    entity: str = "patient",
    as_of: str = "as_of",
    event_time: str = "Start",
    event_class: str = "EncounterClass",
    label: str = defaults.TARGET,
    at: datetime | str | None = None,
    grain: int = DAY,
) -> DataFrame:
    """(entity, as_of, label): 1 if a positive event lies in (as_of, as_of + window].

    ``at`` states the one as_of all index rows share; without it each row has its own.
    """
    wanted = [name.lower() for name in split_names(positive_classes)]
    time = F.col(event_time)
    positive = encounters.where(F.lower(event_class).isin(wanted))
    if at is not None:
        low = time_literal(at, encounters, event_time)
        keys = [entity]
        hits = positive.where((time > low) & (time <= low + days(window_days))).select(entity)
    else:
        first, last = index_bounds(index, as_of)
        keys = [entity, as_of]
        ahead = positive.where((time > first) & (time <= last + days(window_days)))
        cells = (
            ahead.select(entity, time_cell(time, grain).alias("_cell"))
            .distinct()
        )
        hits = join_cells(
            index, cells, entity, as_of, 1, span_cells(window_days, grain), grain
        ).select(*keys)
        if exact_grain(index, as_of, grain) != grain:
            ends = [0, span_cells(window_days, grain)]
            cut = cut_events(index, ahead, event_time, ends, entity, as_of, grain)
            since = instant(time) - instant(F.col("_as_of"))
            inside = cut.where((since > 0) & (since <= window_days * DAY))
            hits = hits.unionByName(inside.select(entity, F.col("_as_of").alias(as_of)))
    flagged = hits.distinct().withColumn(label, F.lit(1))
    return (
        index.select(entity, as_of)
        .join(flagged if at is not None else dealt(flagged), keys, "left")
        .select(entity, as_of, F.coalesce(label, F.lit(0)).alias(label))
    )


def label_distribution(labels: DataFrame, label: str = defaults.TARGET) -> DataFrame:
    """(label, n, share) by label."""
    counts = labels.groupBy(label).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    return counts.select(
        F.col(label).cast("int").alias("label"),
        "n",
        F.try_divide(F.col("n").cast("double"), total.cast("double")).alias("share"),
    ).orderBy("label")


def positive_rate(labels: DataFrame, label: str = defaults.TARGET) -> DataFrame:
    return labels.agg(F.avg(F.col(label)).alias("positive_rate"))
