"""Bins by their edges.

A value's bin is the number of inner edges it has reached, the edges being
``low + i * step`` in double arithmetic. ``floor((v - low) / step)`` and
``width_bucket`` disagree with those edges in the last bit.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _step(low: Column, high: Column, bins: int) -> Column:
    return (high - low) / F.lit(float(bins))


def edge(low: Column, high: Column, bins: int, index: Column) -> Column:
    return low + index.cast("double") * _step(low, high, bins)


def bin_of(value: Column, low: Column, high: Column, bins: int) -> Column:
    """0-based bin, left-closed, the last bin closed on both sides; low < high.

    The division gives the bin to within one; the edges beside it decide. Products of
    0/1 instead of conditions let generated code compute the shared parts once.
    """
    guess = F.floor((value - low) / _step(low, high, bins))
    near = F.greatest(F.lit(0), F.least(F.lit(bins - 1), guess)).cast("int")

    def both(one: Column, other: Column) -> Column:
        return one.cast("int") * other.cast("int")

    down = both(near > 0, value < edge(low, high, bins, near))
    up = both(near < bins - 1, value >= edge(low, high, bins, near + 1))
    return near - down + up


def unit_bin_left_closed(value: Column, bins: int = 10) -> Column:
    """Bin of [i/n, (i+1)/n); NULL outside [0, 1)."""
    inside = (value >= 0.0) & (value < 1.0)
    return F.when(inside, bin_of(value, F.lit(0.0), F.lit(1.0), bins))


def unit_bin_right_closed(value: Column, bins: int = 10) -> Column:
    """Bin of (i/n, (i+1)/n]; NULL outside (0, 1]."""
    passed = F.lit(0)
    for i in range(1, bins):
        passed = passed + (value > F.lit(i * (1.0 / bins))).cast("int")
    return F.when((value > 0.0) & (value <= 1.0), passed)


def widened(low: Column, high: Column) -> tuple[Column, Column]:
    """A constant column still gets a range: half a unit to either side."""
    flat = low == high
    return (
        F.when(flat, low - F.lit(0.5)).otherwise(low),
        F.when(flat, high + F.lit(0.5)).otherwise(high),
    )
