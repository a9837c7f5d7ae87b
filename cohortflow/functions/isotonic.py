"""Isotonic regression of weighted points without a place that holds them all.

1. Points are dealt out by ranges of the score, and each range pools its adjacent violators.
2. Neighbouring ranges are merged level by level. Both sides are isotonic, so at most one block runs across
   the seam: it takes all blocks of the left side whose mean is at least m and all of the right side
   whose mean is at most m, where m is the mean of what it takes. The balance
   g(m) = sum over the left of w (mean - m)+ less sum over the right of w (m - mean)+ falls with m,
   so histograms of the means that overlap, refined where g changes its sign, find the block. A seam costs
   BINS rows a round, however many blocks overlap.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortflow.functions.ranks import in_ranges
from cohortflow.sources.scratch import discard, settle

POINTS_PER_RANGE = 1_000_000
BINS = 1024
#: Break points up to this many (40 bytes each) are broadcast.
SHIPPED_POINTS = 100_000

BLOCK = "range int, first double, last double, total double, weight double"


class Pool:
    """Blocks of rising means; a point that breaks the order is pooled with what is before it."""

    def __init__(self):
        self.blocks: list[list[float]] = []  # first, last, total, weight

    def add(self, score: np.ndarray, total: np.ndarray, weight: np.ndarray) -> None:
        blocks = self.blocks
        for s, t, w in zip(score.tolist(), total.tolist(), weight.tolist()):
            first = s
            while blocks and blocks[-1][2] * w >= t * blocks[-1][3]:
                first, _, more, heavier = blocks.pop()
                t += more
                w += heavier
            blocks.append([first, s, t, w])


def fit_blocks(points: DataFrame, points_per_range: int = POINTS_PER_RANGE) -> DataFrame:
    """(range, first, last, total, weight): the blocks of the isotonic fit of points (score, total, weight)
    with distinct scores; a block's level is total / weight."""
    ranges = max(1, -(-points.count() // points_per_range))

    def pool(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = Pool()
        for batch in batches:
            found.add(*[batch.column(i).to_numpy() for i in range(3)])
        own = TaskContext.get().partitionId()
        columns = list(zip(*found.blocks)) or [()] * 4
        yield pa.RecordBatch.from_arrays(
            [pa.array([own] * len(found.blocks), pa.int32()), *[pa.array(c, pa.float64()) for c in columns]],
            names=["range", "first", "last", "total", "weight"],
        )

    dealt = points.select("score", "total", "weight").repartitionByRange(ranges, "score").sortWithinPartitions("score")
    blocks = settle(dealt.mapInArrow(pool, BLOCK), "blocks")
    width = 1
    while width < ranges:
        merged = _merged(blocks, width)
        if merged is not blocks:
            discard(blocks)
        blocks, width = merged, 2 * width
    return blocks


def _merged(blocks: DataFrame, width: int) -> DataFrame:
    """Every two neighbouring groups of ``width`` ranges made isotonic across their seam."""
    left = F.floor(F.col("range") / width) % 2 == 0
    rows = blocks.select(
        "*", F.floor(F.col("range") / (2 * width)).alias("seam"), left.alias("left"), (F.col("total") / F.col("weight")).alias("mean")
    )
    lowest, highest = F.min(F.when(~F.col("left"), F.col("mean"))), F.max(F.when(F.col("left"), F.col("mean")))
    none = F.lit(None).cast("double")
    overlaps = rows.groupBy("seam").agg(lowest.alias("lo"), highest.alias("hi")).where("hi >= lo")
    # Taken for certain: total and weight, from which mean on of the left, up to which of the right.
    seams = settle(overlaps.select("seam", "lo", "hi", F.lit(0.0).alias("t"), F.lit(0.0).alias("w"), none.alias("start"), none.alias("stop")), "seams")
    cuts: list[DataFrame] = []
    while not seams.isEmpty():
        found = settle(_refined(rows, seams), "seams")
        cuts.append(found.where("done"))
        seams = found.where("not done")
    if not cuts:
        return blocks
    taken = cuts[0]
    for more in cuts[1:]:
        taken = taken.unionByName(more)
    rows = rows.join(taken.select("seam", "start", "stop"), "seam", "left")
    across = F.coalesce(F.when(F.col("left"), F.col("mean") >= F.col("start")).otherwise(F.col("mean") <= F.col("stop")), F.lit(False))
    rows = rows.withColumn("across", across)
    names = ["range", "first", "last", "total", "weight"]
    pooled = rows.where("across").groupBy("seam").agg(
        F.min("range").alias("range"), F.min("first").alias("first"), F.max("last").alias("last"),
        F.sum("total").alias("total"), F.sum("weight").alias("weight"),
    )
    return settle(rows.where("not across").select(*names).unionByName(pooled.select(*names)), "blocks")


def _refined(rows: DataFrame, seams: DataFrame) -> DataFrame:
    """``seams`` with bounds around the bin in which the balance changes its sign, or ``done``."""
    zone = rows.join(seams, "seam").where(F.col("mean").between(F.col("lo"), F.col("hi")))
    share = (F.col("mean") - F.col("lo")) / (F.col("hi") - F.col("lo"))
    zone = zone.withColumn("bin", F.when(F.col("hi") > F.col("lo"), F.least(F.floor(share * BINS), F.lit(BINS - 1))).otherwise(0))
    side = {"l": F.col("left"), "r": ~F.col("left")}
    hist = zone.groupBy("seam", "t", "w", "start", "stop", "bin").agg(
        *[F.sum(F.when(c, F.col(v)).otherwise(0.0)).alias(f"{k}_{v}") for k, c in side.items() for v in ("total", "weight")],
        F.min(F.when(side["l"], F.col("mean"))).alias("l_low"),
        F.max(F.when(side["r"], F.col("mean"))).alias("r_high"),
        F.min("mean").alias("low"),
        F.max("mean").alias("high"),
    )
    order = Window.partitionBy("seam").orderBy("bin")  # BINS rows a seam at most
    below, above = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(1, Window.unboundedFollowing)

    def outside(v: str) -> Column:
        return F.coalesce(F.sum(f"l_{v}").over(above), F.lit(0.0)) + F.coalesce(F.sum(f"r_{v}").over(below), F.lit(0.0))

    hist = hist.select(
        "*",
        (F.col("t") + outside("total")).alias("out_t"),
        (F.col("w") + outside("weight")).alias("out_w"),
        F.coalesce(F.min("l_low").over(above), F.col("start")).alias("from_left"),
        F.coalesce(F.max("r_high").over(below), F.col("stop")).alias("to_right"),
    )
    at_low = F.col("out_t") + F.col("l_total") - F.col("low") * (F.col("out_w") + F.col("l_weight"))
    at_high = F.col("out_t") + F.col("r_total") - F.col("high") * (F.col("out_w") + F.col("r_weight"))
    done = (at_high >= 0) | (F.col("low") == F.col("high"))  # the change lies behind this bin, which is taken on the right
    kept = F.struct(
        "low", "high", "out_t", "out_w", "from_left", done.alias("done"),
        F.when(done, F.coalesce("r_high", "to_right")).otherwise(F.col("to_right")).alias("to_right"),
    )
    last = hist.where((at_low >= 0) | (F.col("bin") == 0)).groupBy("seam").agg(F.max_by(kept, "bin").alias("k"))
    return last.select(
        "seam", F.col("k.low").alias("lo"), F.col("k.high").alias("hi"), F.col("k.out_t").alias("t"), F.col("k.out_w").alias("w"),
        F.col("k.from_left").alias("start"), F.col("k.to_right").alias("stop"), F.col("k.done").alias("done"),
    )


def break_points(blocks: DataFrame) -> DataFrame:
    """(score, calibrated): the ends of every block at its level."""
    ends = F.explode(F.array_distinct(F.array("first", "last"))).alias("score")
    return blocks.select(ends, (F.col("total") / F.col("weight")).alias("calibrated"))


def interpolated(points: DataFrame, df: DataFrame, column: str, name: str, shipped: int = SHIPPED_POINTS, parts: int | None = None) -> DataFrame:
    """``df`` with ``name``: linear between the break points (score, calibrated) around ``column``, level outside
    them; null for null and NaN, and if there are no points. More points than ``shipped`` stay a table
    that is met by range."""
    if points.count() > shipped:
        return _met(points, df, column, name, parts)
    rows = sorted((r["score"], r["calibrated"]) for r in points.collect())
    x = F.col(column).cast("double")
    if not rows:
        return df.withColumn(name, F.lit(None).cast("double"))
    # The interval of a value, by binary search, and a row of its two ends for each interval.
    scores = [s for s, _ in rows]
    search = Bucketizer(splits=[float("-inf"), *scores, float("inf")], inputCol="_x", outputCol="_at", handleInvalid="keep")
    ends = [(float(i), *rows[max(i - 1, 0)], *rows[min(i, len(rows) - 1)]) for i in range(len(rows) + 1)]
    ends = df.sparkSession.createDataFrame(ends, "_at double, _a double, _la double, _b double, _lb double")
    part = (F.col("_x") - F.col("_a")) / (F.col("_b") - F.col("_a"))
    level = F.when(F.col("_a") == F.col("_b"), F.col("_la")).otherwise(F.col("_la") + (F.col("_lb") - F.col("_la")) * part)
    found = search.transform(df.drop(name).withColumn("_x", x)).join(F.broadcast(ends), "_at", "left")
    return found.withColumn(name, level).select(*[c for c in df.columns if c != name], name)


def _met(points: DataFrame, df: DataFrame, column: str, name: str, parts: int | None = None) -> DataFrame:
    """The same by windows inside ranges of the score; what lies in other ranges comes from a row per range."""
    value = F.col(column).cast("double")
    asked = df.select(value.alias("score")).where(F.col("score").isNotNull() & ~F.isnan("score")).distinct()
    both = points.withColumn("point", F.struct("score", "calibrated")).drop("calibrated").unionByName(asked, allowMissingColumns=True)
    both = in_ranges(both, ["score"], "points", parts)
    order = Window.partitionBy("part").orderBy("score")
    below = F.last("point", ignorenulls=True).over(order.rangeBetween(Window.unboundedPreceding, Window.currentRow))
    above = F.first("point", ignorenulls=True).over(order.rangeBetween(Window.currentRow, Window.unboundedFollowing))
    own = both.select("part", "score", "point", below.alias("below"), above.alias("above")).where("point is null")
    ends = both.groupBy("part").agg(F.min("point").alias("lowest"), F.max("point").alias("highest"))
    row = Window.orderBy("part")  # a row per range
    ends = ends.select(
        "part",
        F.last("highest", ignorenulls=True).over(row.rowsBetween(Window.unboundedPreceding, -1)).alias("before"),
        F.first("lowest", ignorenulls=True).over(row.rowsBetween(1, Window.unboundedFollowing)).alias("behind"),
    )
    found = own.join(ends, "part").select(
        "score", F.coalesce("below", "before").alias("a"), F.coalesce("above", "behind").alias("b")
    )
    part = (F.col("score") - F.col("a.score")) / (F.col("b.score") - F.col("a.score"))
    level = F.when(F.col("a.score") == F.col("b.score"), F.col("a.calibrated")).otherwise(
        F.col("a.calibrated") + (F.col("b.calibrated") - F.col("a.calibrated")) * part
    )
    found = found.select(F.col("score").alias("_score"), F.coalesce(level, "a.calibrated", "b.calibrated").alias(name))
    return df.drop(name).join(found, value == F.col("_score"), "left").drop("_score")
