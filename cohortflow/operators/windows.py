"""Aggregates of the events inside a window around each index row.

An index row is (entity, as_of). There are two plans.

*One as_of for all rows* (``at`` is given): the window is a pair of literals, the
scan is pruned by them and events are aggregated per entity before anything is
joined, so an entity holding a third of all events costs a partial aggregate.

*An as_of per row*: time is cut into cells, two per grain - the grain's first
instant, and the rest of it. Events collapse into one mergeable state per
(entity, cell), again by partial aggregation, and index rows meet states instead
of events: equal (entity, stretch of cells), then a comparison of cells. How many
pairs that makes depends on the calendar, not on the number of events. Windows of
whole grains around an as_of on the grid are unions of whole cells. Where an as_of
lies off the grid its window cuts two cells; the events of those, and of no others,
meet the index row themselves, by an equi-join on (entity, cell), and are aggregated
as they meet. Results are exact for every as_of.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortflow.functions.scalars import days, time_literal

DAY = 24 * 3600 * 1_000_000
#: Cells of a block, and blocks of the next larger one.
RADIX = 4
#: An hour, half an hour, a minute, a second, a millisecond.
DIVISIONS = (3600 * 1_000_000, 1800 * 1_000_000, 60 * 1_000_000, 1_000_000, 1_000)


@dataclass(frozen=True)
class Count:
    """Rows satisfying ``where``; 0 where there are none."""

    name: str
    where: Column | None = None


@dataclass(frozen=True)
class Last:
    """Latest non-null ``value`` by (time, ``ties``)."""

    name: str
    value: Column
    where: Column
    ties: Sequence[str] = ()


@dataclass(frozen=True)
class Stats:
    """Mean and population standard deviation of the non-null values."""

    mean: str
    std: str
    value: Column
    where: Column


Measure = Count | Last | Stats


def time_cell(time: Column, grain: int = DAY) -> Column:
    """Cell number of an instant: even on a grid point, odd between two of them."""
    micros = F.unix_micros(time.cast("timestamp"))
    rest = F.pmod(micros, F.lit(grain))
    return (F.call_function("div", micros - rest, F.lit(grain)) * 2 + (rest > 0).cast("int")).cast(
        "long"
    )


def instant(time: Column) -> Column:
    """Microseconds since the epoch."""
    return F.unix_micros(time.cast("timestamp"))


def exact_grain(index: DataFrame, as_of: str, grain: int = DAY) -> int:
    """The coarsest of ``grain`` and its usual divisions that has every as_of on its grid.

    One aggregate of a row; it decides how windows are computed, not what they hold.
    """
    choices = [grain] + [g for g in DIVISIONS if g < grain and grain % g == 0]
    at = instant(F.col(as_of))
    fits = index.agg(*[F.bool_and(F.pmod(at, F.lit(g)) == 0) for g in choices]).first()
    return next(g for g, fit in zip([*choices, 1], [*fits, True]) if fit or fit is None)


def span_cells(span_days: int, grain: int = DAY) -> int:
    if span_days * DAY % grain:
        raise ValueError("the window is not a whole number of grains")
    return 2 * (span_days * DAY // grain)


def index_bounds(index: DataFrame, as_of: str) -> tuple[Column, Column]:
    """Smallest and largest as_of as scalar subqueries, for filters that reach the scan."""
    return index.agg(F.min(as_of)).scalar(), index.agg(F.max(as_of)).scalar()


def shared_as_of(index: DataFrame, as_of: str = "as_of") -> str | None:
    """The as_of of a stored index if all its rows have the same one: one small aggregate.

    It comes back as text, which no clock of the driver's can shift.
    """
    first, last = index.agg(*[f(as_of).cast("string") for f in (F.min, F.max)]).first()
    return first if first == last else None


def dealt(df: DataFrame) -> DataFrame:
    """A side of a join that is to be shuffled by key, never broadcast. Until a shuffle has counted the rows
    Spark takes a stored index for as large as its file; runs of days unpack to dozens of times that, and to
    hundreds as blocks or stretches."""
    return df.hint("merge")


def _where(measure: Measure) -> Column:
    if isinstance(measure, Count):
        return F.lit(True) if measure.where is None else measure.where
    return measure.where & measure.value.isNotNull()


def _latest(measure: Last, time: str) -> Column:
    return F.max(
        F.when(
            _where(measure),
            F.struct(
                F.col(time).alias("time"),
                *[F.col(t).alias(f"tie{i}") for i, t in enumerate(measure.ties)],
                measure.value.alias("value"),
            ),
        )
    )


def _direct(measure: Measure, time: str) -> list[Column]:
    if isinstance(measure, Count):
        return [F.count_if(_where(measure)).alias(measure.name)]
    if isinstance(measure, Last):
        return [_latest(measure, time)["value"].alias(measure.name)]
    value = F.when(_where(measure), measure.value)
    return [F.avg(value).alias(measure.mean), F.stddev_pop(value).alias(measure.std)]


def _states(measures: Sequence[Measure], time: str) -> list[Column]:
    states = []
    for i, measure in enumerate(measures):
        if isinstance(measure, Count):
            state = F.count_if(_where(measure))
        elif isinstance(measure, Last):
            state = _latest(measure, time)
        else:
            value = F.when(_where(measure), measure.value)
            n = F.count(value)
            state = F.struct(n.alias("n"), F.avg(value).alias("mean"), (F.var_pop(value) * n).alias("spread"))
        states.append(state.alias(f"_s{i}"))
    return states


def _joined(a: Column, b: Column) -> Column:
    """Count, mean and squared distance from it of two groups together: no difference of large
    sums is taken."""
    n = a["n"] + b["n"]
    step = b["mean"] - a["mean"]
    share = b["n"] / n
    both = F.struct(
        n.alias("n"),
        (a["mean"] + step * share).alias("mean"),
        (a["spread"] + b["spread"] + step * step * a["n"] * share).alias("spread"),
    )
    return F.when(b["n"] == 0, a).when(a["n"] == 0, b).otherwise(both)


def _merged(measures: Sequence[Measure]) -> list[Column]:
    """States of a group of states, under the same names. Spreads are put together one after
    another; the lists hold a state per block of one window, or per cell of one block."""
    merged = []
    for i, measure in enumerate(measures):
        state = F.col(f"_s{i}")
        if isinstance(measure, Count):
            merged.append(F.sum(state).alias(f"_s{i}"))
        elif isinstance(measure, Last):
            merged.append(F.max(state).alias(f"_s{i}"))
        else:
            none = F.expr("named_struct('n', 0L, 'mean', 0D, 'spread', 0D)")
            held = F.collect_list(F.when(state["n"] > 0, state))
            merged.append(F.aggregate(held, none, _joined).alias(f"_s{i}"))
    return merged


def _values(measures: Sequence[Measure]) -> list[Column]:
    """What the measures of a state are."""
    found = []
    for i, measure in enumerate(measures):
        state = F.col(f"_s{i}")
        if isinstance(measure, Count):
            found.append(state.alias(measure.name))
        elif isinstance(measure, Last):
            found.append(state["value"].alias(measure.name))
        else:
            found += [
                F.when(state["n"] > 0, state["mean"]).alias(measure.mean),
                F.sqrt(F.try_divide(state["spread"], state["n"])).alias(measure.std),
            ]
    return found


def _passes(measures: Sequence[Measure]) -> list[tuple[list[Measure], Column | None]]:
    """Measures to compute together, with a filter for the rows they need.

    Latest values make Spark aggregate by sorting, so measures of selected rows go by
    themselves over those rows; plain counts then hash two columns of all rows.
    """
    if not any(isinstance(m, Last) for m in measures):
        return [(list(measures), None)]
    plain = [m for m in measures if isinstance(m, Count) and m.where is None]
    chosen = [m for m in measures if not (isinstance(m, Count) and m.where is None)]
    wanted = chosen[0].where
    for measure in chosen[1:]:
        wanted = wanted | measure.where
    return [(plain, None)] * bool(plain) + [(chosen, wanted)]


def join_cells(
    index: DataFrame,
    cells: DataFrame,
    entity: str,
    as_of: str,
    first: int,
    last: int,
    grain: int = DAY,
) -> DataFrame:
    """Distinct index rows with the cells from ``first`` to ``last`` relative to theirs.

    A row off the grid leaves out the cells its window cuts; see ``cut_events``.
    Both sides carry a stretch number of the window's width, so a window touches at
    most two stretches and the join stays an equi-join.
    """
    width = last - first + 1
    windows = (
        index.select(entity, as_of)
        .distinct()
        .withColumn("_at", time_cell(F.col(as_of), grain))
        .withColumn(
            "_stretch",
            F.explode(
                F.sequence(
                    F.floor((F.col("_at") + first) / width), F.floor((F.col("_at") + last) / width)
                )
            ),
        )
    )
    stretched = cells.withColumn("_stretch", F.floor(F.col("_cell") / width))
    joined = windows.join(dealt(stretched), [entity, "_stretch"])
    off = (F.pmod(F.col("_at"), F.lit(2)) != 0).cast("int")
    opens = F.col("_at") + first + (off if first % 2 == 0 else F.lit(0))
    return joined.where(F.col("_cell").between(opens, F.col("_at") + last - off)).drop("_stretch")


def block_sizes(first: int, last: int) -> list[int]:
    """Sizes of the blocks that a window of the cells from ``first`` to ``last`` can hold."""
    sizes = [1]
    while sizes[-1] * RADIX <= last - first + 1:
        sizes.append(sizes[-1] * RADIX)
    return sizes


def window_blocks(
    index: DataFrame, entity: str, as_of: str, first: int, last: int, grain: int = DAY
) -> DataFrame:
    """(entity, as_of, _size, _block): the fewest blocks that make up the cells from ``first`` to
    ``last`` relative to each distinct index row's; at most 2 (RADIX - 1) of each size, and as
    many again of the largest. A row off the grid leaves out the cells its window cuts."""
    sizes = block_sizes(first, last)
    at = time_cell(F.col(as_of), grain)
    off = (F.pmod(F.col("_at"), F.lit(2)) != 0).cast("int")
    opens = F.col("_at") + first + (off if first % 2 == 0 else F.lit(0))
    closes = F.col("_at") + last - off

    def ends(size: int) -> tuple[Column, Column]:
        """First and last block of a size that lie inside the window."""
        return F.ceil(opens / size), F.floor((closes + 1) / size) - 1

    def run(size: int, start: Column, stop: Column) -> Column:
        blocks = F.when(start <= stop, F.sequence(start, stop)).otherwise(F.array().cast("array<bigint>"))
        return F.transform(blocks, lambda b: F.struct(F.lit(size).alias("size"), b.alias("block")))

    parts = []
    for size in sizes:
        start, stop = ends(size)
        if size == sizes[-1]:
            parts.append(run(size, start, stop))
            continue
        low, high = ends(size * RADIX)
        none = low > high  # no larger block: all of this size
        parts.append(run(size, start, F.when(none, stop).otherwise(low * RADIX - 1)))
        parts.append(run(size, F.when(none, stop + 1).otherwise((high + 1) * RADIX), stop))
    windows = index.select(entity, as_of).distinct().withColumn("_at", at)
    return windows.select(entity, as_of, F.explode(F.concat(*parts)).alias("_b")).select(
        entity, as_of, F.col("_b.size").alias("_size"), F.col("_b.block").alias("_block")
    )


def block_states(cells: DataFrame, entity: str, measures: Sequence[Measure], sizes: Sequence[int]) -> DataFrame:
    """(entity, _size, _block, states) from (entity, _cell, states)."""
    size = F.explode(F.array(*[F.lit(s) for s in sizes]))
    spread = cells.withColumn("_size", size).withColumn("_block", F.floor(F.col("_cell") / F.col("_size")))
    return spread.groupBy(entity, "_size", "_block").agg(*_merged(measures))


def cut_events(
    index: DataFrame,
    events: DataFrame,
    event_time: str,
    offsets: Sequence[int],
    entity: str,
    as_of: str,
    grain: int = DAY,
) -> DataFrame:
    """Events with each off-grid index row, as ``_as_of``, that has them in one of the cells at
    ``offsets`` from its own; ``_offset`` tells which. The caller compares the instants."""
    at = time_cell(F.col(as_of), grain)
    cut = (
        index.select(entity, F.col(as_of).alias("_as_of"), at.alias("_at"))
        .where(F.pmod(F.col("_at"), F.lit(2)) != 0)
        .distinct()
        .select(
            entity,
            "_as_of",
            "_at",
            F.explode(F.array(*[F.lit(o).cast("long") for o in offsets])).alias("_offset"),
        )
        .withColumn("_cell", F.col("_at") + F.col("_offset"))
        .drop("_at")
    )
    return events.withColumn("_cell", time_cell(F.col(event_time), grain)).join(dealt(cut), [entity, "_cell"])


def lookback_aggregates(
    index: DataFrame,
    events: DataFrame,
    measures: Sequence[Measure],
    event_time: str,
    lookback_days: int,
    entity: str = "patient",
    as_of: str = "as_of",
    at: datetime | str | None = None,
    grain: int = DAY,
    onto: DataFrame | None = None,
) -> DataFrame:
    """Index rows with the measures over events in [as_of - lookback, as_of], both closed.

    Index rows without events keep NULL measures and zero counts. ``onto`` is a frame
    of the same index rows that already has other columns; it is extended instead.
    """
    rows = index if onto is None else onto
    time = F.col(event_time)
    if at is not None:
        high = time_literal(at, events, event_time)
        low = high - days(lookback_days)
    else:
        earliest, high = index_bounds(index, as_of)
        low = earliest - days(lookback_days)
    seen = events.where(time.between(low, high))
    off_grid = at is None and exact_grain(index, as_of, grain) != grain
    ends = [-span_cells(lookback_days, grain), 0] if at is None else []
    for group, wanted in _passes(measures):
        chosen = seen if wanted is None else seen.where(wanted)
        if at is not None:
            keys = [entity]
            found = chosen.groupBy(entity).agg(
                *[c for m in group for c in _direct(m, event_time)]
            )
        else:
            keys = [entity, as_of]
            cells = (
                chosen.withColumn("_cell", time_cell(time, grain))
                .groupBy(entity, "_cell")
                .agg(*_states(group, event_time))
            )
            first = -span_cells(lookback_days, grain)
            states = block_states(cells, entity, group, block_sizes(first, 0))
            blocks = window_blocks(index, entity, as_of, first, 0, grain)
            met = blocks.join(dealt(states), [entity, "_size", "_block"]).drop("_size", "_block")
            if off_grid:
                before = instant(F.col("_as_of")) - instant(time)
                parts = (
                    cut_events(index, chosen, event_time, ends, entity, as_of, grain)
                    .where(before.between(0, lookback_days * DAY))
                    .groupBy(entity, F.col("_as_of").alias(as_of))
                    .agg(*_states(group, event_time))
                )
                met = met.select(*parts.columns).unionByName(parts)
            found = met.groupBy(*keys).agg(*_merged(group)).select(*keys, *_values(group))
        rows = rows.join(found if at is not None else dealt(found), keys, "left")
    return rows.fillna({m.name: 0 for m in measures if isinstance(m, Count)})


def count_horizons(
    index: DataFrame,
    events: DataFrame,
    event_time: str,
    horizons: Sequence[int],
    prefix: str,
    entity: str = "patient",
    as_of: str = "as_of",
    at: datetime | str | None = None,
    grain: int = DAY,
) -> DataFrame:
    """``<prefix>_<h>d`` for every horizon h, from one scan over the longest one."""
    names = [f"{prefix}_{h}d" for h in horizons]
    if at is not None:
        high = time_literal(at, events, event_time)
        since = [F.col(event_time) >= high - days(h) for h in horizons]
        measures = [Count(n, w) for n, w in zip(names, since)]
        return lookback_aggregates(
            index, events, measures, event_time, max(horizons), entity, as_of, at
        )
    low, high = index_bounds(index, as_of)
    seen = events.where(F.col(event_time).between(low - days(max(horizons)), high))
    cells = (
        seen.withColumn("_cell", time_cell(F.col(event_time), grain))
        .groupBy(entity, "_cell")
        .agg(F.count("*").alias("_n"))
    )
    longest = span_cells(max(horizons), grain)
    pairs = join_cells(index, cells, entity, as_of, -longest, 0, grain)
    off = (F.pmod(F.col("_at"), F.lit(2)) != 0).cast("int")
    found = pairs.groupBy(entity, as_of).agg(
        *[
            F.sum(
                F.when(F.col("_cell") >= F.col("_at") - span_cells(h, grain) + off, F.col("_n"))
            ).alias(n)
            for h, n in zip(horizons, names)
        ]
    )
    if exact_grain(index, as_of, grain) != grain:
        ends = sorted({0, *[-span_cells(h, grain) for h in horizons]})
        cut = cut_events(index, seen, event_time, ends, entity, as_of, grain)
        before = instant(F.col("_as_of")) - instant(F.col(event_time))
        parts = cut.groupBy(entity, F.col("_as_of").alias(as_of)).agg(
            *[
                F.count_if(
                    F.col("_offset").isin(0, -span_cells(h, grain)) & before.between(0, h * DAY)
                ).alias(n)
                for h, n in zip(horizons, names)
            ]
        )
        both = found.unionByName(parts)
        found = both.groupBy(entity, as_of).agg(*[F.sum(n).alias(n) for n in names])
    return index.join(found, [entity, as_of], "left").fillna(0, names)


def future_window_join(
    index: DataFrame,
    events: DataFrame,
    event_time: str,
    window_days: int,
    entity: str = "patient",
    as_of: str = "as_of",
    at: datetime | str | None = None,
) -> DataFrame:
    """Index rows with each of their events in (as_of, as_of + window].

    This one returns event rows. Its keys are the entity and a stretch of time as
    wide as the window, which also cuts a busy entity into many groups.
    """
    time = F.col(event_time)
    if at is not None:
        low = time_literal(at, events, event_time)
        ahead = events.where((time > low) & (time <= low + days(window_days)))
        return index.join(ahead, entity)
    low, high = index_bounds(index, as_of)
    width = window_days * DAY

    def stretch(instant: Column) -> Column:
        micros = F.unix_micros(instant.cast("timestamp"))
        return F.call_function("div", micros - F.pmod(micros, F.lit(width)), F.lit(width))

    ahead = events.where((time > low) & (time <= high + days(window_days))).withColumn(
        "_stretch", stretch(time)
    )
    opened = index.withColumn(
        "_stretch",
        F.explode(
            F.sequence(stretch(F.col(as_of)), stretch(F.col(as_of) + days(window_days)))
        ),
    )
    inside = (time > F.col(as_of)) & (time <= F.col(as_of) + days(window_days))
    return opened.join(ahead, [entity, "_stretch"]).where(inside).drop("_stretch")


def running_counts(
    index: DataFrame,
    cells: DataFrame,
    amounts: Sequence[str],
    entity: str,
    as_of: str,
    grain: int = DAY,
) -> DataFrame:
    """(entity, as_of, *amounts): per index row the sums over all cells up to as_of.

    ``cells`` has one row per (entity, _cell), so a window per entity holds at most
    one row per cell of the calendar and one per index row.
    """
    points = index.select(entity, as_of).distinct().select(
        entity,
        time_cell(F.col(as_of), grain).alias("_cell"),
        F.col(as_of),
        *[F.lit(0).cast("long").alias(a) for a in amounts],
    )
    none = F.lit(None).cast(index.schema[as_of].dataType).alias(as_of)
    rows = points.unionByName(cells.select(entity, "_cell", none, *amounts))
    # The default range frame takes in every row of the same cell.
    upto = Window.partitionBy(entity).orderBy("_cell")
    return rows.select(
        entity, as_of, *[F.sum(a).over(upto).alias(a) for a in amounts]
    ).where(F.col(as_of).isNotNull())


def active_distinct(
    index: DataFrame,
    intervals: DataFrame,
    start: str,
    stop: str,
    item: str,
    lookback_days: int,
    name: str,
    entity: str = "patient",
    as_of: str = "as_of",
    at: datetime | str | None = None,
    grain: int = DAY,
    onto: DataFrame | None = None,
) -> DataFrame:
    """Distinct non-null items whose interval meets [as_of - lookback, as_of].

    An interval counts if start <= as_of and it is open (NULL stop) or
    stop >= as_of - lookback. ``onto`` is as in ``lookback_aggregates``. With an as_of per
    row, cells are made as fine as the finest as_of needs.
    """
    rows = index if onto is None else onto
    named = intervals.where(F.col(item).isNotNull())
    if at is not None:
        high = time_literal(at, intervals, start)
        low = time_literal(at, intervals, stop) - days(lookback_days)
        met = (F.col(start) <= high) & (F.col(stop).isNull() | (F.col(stop) >= low))
        # Distinct pairs first: partial aggregation removes a busy entity's repeats.
        found = (
            named.where(met)
            .select(entity, item)
            .distinct()
            .groupBy(entity)
            .agg(F.count("*").alias(name))
        )
        return rows.join(found, entity, "left").fillna(0, [name])

    low, high = index_bounds(index, as_of)
    grain = exact_grain(index, as_of, grain)
    # As as_of cells an item is active from its start to its stop plus the lookback.
    never = F.lit(1 << 60)
    until = F.when(
        F.col(stop).isNotNull(),
        time_cell(F.col(stop), grain) + span_cells(lookback_days, grain),
    ).otherwise(never)
    reach = (
        named.where(
            (F.col(start) <= high)
            & (F.col(stop).isNull() | (F.col(stop) >= low - days(lookback_days)))
        )
        .withColumn("_from", time_cell(F.col(start), grain))
        .withColumn("_until", until)
        .where(F.col("_from") <= F.col("_until"))
        .groupBy(entity, item, "_from")
        .agg(F.max("_until").alias("_until"))
    )
    # Overlapping intervals of one item become one stretch: +1 where it opens, -1 after it.
    order = Window.partitionBy(entity, item).orderBy("_from")
    furthest = F.max("_until").over(order.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.col("_before").isNull() | (F.col("_from") > F.col("_before"))
    closes = F.col("_next").isNull() | (F.col("_next") > F.col("_so_far"))
    so_far = F.greatest(F.col("_until"), F.coalesce(F.col("_before"), F.col("_until")))
    def step(cell: Column, by: int) -> Column:
        return F.struct(cell.alias("cell"), F.lit(by).alias("by"))

    changes = (
        reach.withColumn("_before", furthest)
        .withColumn("_next", F.lead("_from").over(order))
        .withColumn("_so_far", so_far)
        .select(
            entity,
            F.explode(
                F.array(
                    F.when(opens, step(F.col("_from"), 1)),
                    F.when(closes, step(F.col("_so_far") + 1, -1)),
                )
            ).alias("_change"),
        )
        .where(F.col("_change").isNotNull() & (F.col("_change.cell") < never))
        .groupBy(entity, F.col("_change.cell").alias("_cell"))
        .agg(F.sum("_change.by").alias(name))
    )
    found = running_counts(index, changes, [name], entity, as_of, grain)
    return rows.join(dealt(found), [entity, as_of], "left").fillna(0, [name])
