"""Rows of one bucket side by side, however large the bucket."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortflow.sources.scratch import settle


def with_block_pairs(rows: DataFrame, key: str, spread: Column, block_rows: int) -> DataFrame:
    """``rows`` with columns ``_pair`` and ``_block``, a row for each pair of blocks it takes part in.

    A bucket (rows of one ``key``) of up to ``block_rows`` rows is one block. A larger one is cut into
    blocks by ``spread`` and every two of its blocks meet under one ``_pair``, so that all its pairs
    are compared, each in one place, by as many tasks as there are pairs of blocks. Only the sizes of
    the large buckets are joined to the rows.
    """
    large = rows.groupBy(key).count().where(F.col("count") > block_rows)
    large = settle(large.select(key, F.ceil(F.col("count") / block_rows).cast("int").alias("_blocks")), "large")
    n = F.coalesce(F.col("_blocks"), F.lit(1))
    cut = rows.join(large, key, "left").withColumn("_block", F.pmod(F.xxhash64(spread, F.lit("block")), n).cast("int"))
    # A block meets itself where it meets its successor, or alone if it is the only one.
    others = F.transform(
        F.sequence(F.lit(0), n - 1), lambda o: F.least(o, F.col("_block")) * n + F.greatest(o, F.col("_block"))
    )
    return cut.withColumn("_pair", F.explode(others)).drop("_blocks")


def grouped_batches(
    batches: Iterator[pa.RecordBatch], keys: list[str]
) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Rows that are sorted by ``keys`` in tables that hold whole groups, with the place at which each
    group begins (and the number of rows at the end)."""
    kept: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        kept.append(batch)
        start = _starts(batch, keys)[-1]
        if start == 0 and (len(kept) == 1 or not _differs(kept[-2], batch, keys)):
            continue  # the last group fills this batch, it may go on
        whole = kept[:-1] + [batch.slice(0, start)]
        kept = [batch.slice(start)]
        yield from _table(whole, keys)
    yield from _table(kept, keys)


def _table(batches: list[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    batches = [b for b in batches if b.num_rows]
    if batches:
        table = pa.Table.from_batches(batches).combine_chunks()
        yield table, np.r_[_starts(table, keys), table.num_rows]


def _starts(rows: pa.Table | pa.RecordBatch, keys: list[str]) -> np.ndarray:
    new = np.zeros(rows.num_rows, bool)
    new[0] = True
    for k in keys:
        values = rows.column(k).to_numpy(zero_copy_only=False) if isinstance(rows, pa.RecordBatch) else rows.column(k).to_numpy()
        new[1:] |= values[1:] != values[:-1]
    return np.flatnonzero(new)


def _differs(one: pa.RecordBatch, other: pa.RecordBatch, keys: list[str]) -> bool:
    return any(one.column(k)[-1].as_py() != other.column(k)[0].as_py() for k in keys)


class Forest:
    """Union of the rows of a table, vectorised where links are many."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def find(self, rows: np.ndarray) -> np.ndarray:
        roots = self.root[rows]
        while True:
            above = self.root[roots]
            if np.array_equal(above, roots):
                return roots
            roots = above

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        """Joins row ``a[i]`` with row ``b[i]``; a root is the smallest row of its tree."""
        while len(a):
            a, b = self.find(a), self.find(b)
            open_ = a != b
            a, b = a[open_], b[open_]
            if not len(a):
                return
            low, high = np.minimum(a, b), np.maximum(a, b)
            order = np.lexsort((low, high))
            low, high = low[order], high[order]
            first = np.r_[True, high[1:] != high[:-1]]
            self.root[high[first]] = low[first]
            a, b = low, high

    def roots(self) -> np.ndarray:
        self.root = self.find(np.arange(len(self.root)))
        return self.root


Grouped = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]
