"""Statistics of columns from one stored table of distinct values.

1. A table is read once: its rows collapse to one row per distinct value of each column
   (partial aggregation first, so a value held by a third of all rows costs one row per
   task) with whatever is counted of it.
2. The distinct values are dealt out by ranges and stored with the number of their range.
   Every statistic reads that table: moments, quantiles, ranks and bins are sums over it.
3. Running totals are windows inside a range plus what lies in the ranges below, which is
   a row per column and range, joined on them. There are as many ranges as shuffle
   partitions, so neither their number nor their size has a ceiling.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortflow.functions.scalars import nan_to_null
from cohortflow.sources.scratch import settle


def _number(name: str) -> Column:
    return nan_to_null(F.col(name).cast("double")).alias(name)


def in_ranges(df: DataFrame, columns: Sequence[str], label: str, parts: int | None = None) -> DataFrame:
    """``df`` dealt out by ranges of ``columns`` and stored, with ``part``, the number of the range."""
    ranged = df.repartitionByRange(*[parts] * (parts is not None), *columns)
    return settle(ranged.withColumn("part", F.spark_partition_id()), label)


def long_values(
    df: DataFrame, columns: Sequence[str], keep: Mapping[str, Column], series: str = "series"
) -> DataFrame:
    """(*keep, series, value): one row per column and input row, NaN as NULL."""
    wide = df.select(
        *[_number(name) for name in columns], *[c.alias(name) for name, c in keep.items()]
    )
    return wide.unpivot(list(keep), list(columns), series, "value")


def value_table(
    df: DataFrame, columns: Sequence[str], weights: Mapping[str, Column], parts: int | None = None
) -> DataFrame:
    """(series, value, *weights, part): the weights summed per distinct value of each column, stored.

    Missing values (NULL and NaN) of a column are one row with a NULL value.
    """
    counts = long_values(df, columns, weights).groupBy("series", "value")
    return in_ranges(counts.agg(*[F.sum(w).alias(w) for w in weights]), ["series", "value"], "values", parts)


def running_totals(table: DataFrame, weights: Sequence[str]) -> DataFrame:
    """The rows of a ``value_table`` that have a value with, for every weight, ``<weight>_below``,
    its sum over all smaller values of the series, and ``<weight>_all``."""
    values = table.where(F.col("value").isNotNull())
    inside = (
        Window.partitionBy("series", "part")
        .orderBy("value")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    whole = Window.partitionBy("series")  # a row per range
    earlier = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    offsets = values.groupBy("series", "part").agg(*[F.sum(w).alias(w) for w in weights]).select(
        "series",
        "part",
        *[(F.sum(w).over(earlier) - F.col(w)).alias(f"_{w}_offset") for w in weights],
        *[F.sum(w).over(whole).alias(f"{w}_all") for w in weights],
    )
    return (
        values.select(
            "*", *[(F.sum(w).over(inside) - F.col(w)).alias(f"_{w}_inside") for w in weights]
        )
        .join(offsets, ["series", "part"])
        .select(
            "series",
            "value",
            *weights,
            *[(F.col(f"_{w}_inside") + F.col(f"_{w}_offset")).alias(f"{w}_below") for w in weights],
            *[f"{w}_all" for w in weights],
        )
    )


def ranked_values(
    df: DataFrame, columns: Sequence[str], weights: Mapping[str, Column], parts: int | None = None
) -> DataFrame:
    """``running_totals`` of a table's columns."""
    return running_totals(value_table(df, columns, weights, parts), list(weights))


def moments(table: DataFrame, weights: Sequence[str]) -> DataFrame:
    """(series, then for every weight <w>_count, _missing, _mean, _std, _min, _max) of a
    ``value_table``: a row per series. Squares are taken from the mean, so nothing cancels."""
    value = F.col("value")
    sums = []
    for w in weights:
        held = F.when(value.isNotNull(), F.col(w)).otherwise(0)
        present = F.when(F.col(w) > 0, value)
        sums += [
            F.sum(held).alias(f"{w}_count"),
            F.sum(F.when(value.isNull(), F.col(w)).otherwise(0)).alias(f"{w}_missing"),
            F.try_divide(F.sum(F.col(w) * value), F.sum(held)).alias(f"{w}_mean"),
            F.min(present).alias(f"{w}_min"),
            F.max(present).alias(f"{w}_max"),
        ]
    first = table.groupBy("series").agg(*sums)
    # One row per series on the broadcast side.
    means = first.select("series", *[F.col(f"{w}_mean").alias(f"_{w}") for w in weights])
    spread = table.where(value.isNotNull()).join(F.broadcast(means), "series").groupBy("series").agg(
        *[
            F.sqrt(
                F.try_divide(F.sum(F.col(w) * F.pow(value - F.col(f"_{w}"), F.lit(2.0))), F.sum(w) - 1)
            ).alias(f"{w}_std")
            for w in weights
        ]
    )
    return first.join(F.broadcast(spread), "series", "left")


def exact_quantiles(totals: DataFrame, weight: str, shares: Mapping[str, float]) -> DataFrame:
    """Linearly interpolated quantiles per series from ``running_totals`` rows.

    Two order statistics per share are picked out of the ranks, so no task ever
    holds the value distribution of a whole column.
    """
    last = F.col(f"{weight}_all") - 1
    first = F.col(f"{weight}_below")

    def value_at(position: Column) -> Column:
        here = (first <= position) & (position < first + F.col(weight))
        return F.max(F.when(here, F.col("value")))

    sides = []
    for name, share in shares.items():
        position = last * F.lit(float(share))
        sides += [
            value_at(F.floor(position)).alias(f"_{name}_low"),
            value_at(F.ceil(position)).alias(f"_{name}_high"),
            F.max(position - F.floor(position)).alias(f"_{name}_part"),
        ]
    return totals.groupBy("series").agg(*sides).select(
        "series",
        *[
            (
                F.col(f"_{name}_low")
                + (F.col(f"_{name}_high") - F.col(f"_{name}_low")) * F.col(f"_{name}_part")
            ).alias(name)
            for name in shares
        ],
    )
