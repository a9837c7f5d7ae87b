"""Exact search for the highest inner products: a ball tree per shard, branch and bound.

Vectors are whole numbers, so scores are exact. A node of a tree is a run of vectors with a centre and
a radius; no vector in it scores more than ``q.centre + |q| radius``. Queries meet shards in blocks. A
block first searches a few shards; the score of its k-th best so far then goes with every query to
all other shards, where nodes that cannot reach it are left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cohortflow.llm.clustering import whole_numbers
from cohortflow.llm.common import quoted
from cohortflow.llm.mixing import numbered
from cohortflow.sources.scratch import settle

BEST, EVERY, SCALE = 10, 100, 1024
#: Vectors of a shard and queries of a block, at most about.
SHARD_ROWS, BLOCK_QUERIES = 65_536, 16_384
#: A table of fewer shards than shuffle partitions has smaller shards, down to this.
SMALL_SHARD = 1024
#: One shard in so many is searched before the others.
FIRST_SHARE = 16
#: Blocks that meet the shards in one job; each copies every vector once.
BLOCKS_AT_ONCE = 4
#: Vectors of a leaf, and queries that go down a tree together.
LEAF, TOGETHER = 128, 2048

FOUND = "query_no long, vec_id long, score long"


def top_k(
    vectors: DataFrame,
    best: int = BEST,
    every: int = EVERY,
    scale: int = SCALE,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    shard_rows: int = SHARD_ROWS,
    block_queries: int = BLOCK_QUERIES,
) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id``, ``score``: for every row whose id is divisible by
    ``every``, the ``best`` other rows with the highest inner product of ``floor(scale * x)``, equal
    scores by smaller id; all others if they are fewer.

    Vectors that are null or hold null or non-finite components take no part, neither do rows
    without an id, which a result could not name. Vectors of different lengths do not meet; empty ones
    score 0 with one another. Rows that repeat an id are rows like any other: each is a query of its
    own, and an equal row is another row. An empty table gives an empty one; other columns are not read,
    whatever their names. Scores that could leave 64 bits raise an error.

    Shards are dealt by a hash of id and vector after equal rows have become one with a count, so no
    shard is hot; many equal vectors under different ids lie in leaves without radius, in the order of
    their ids, of which the bounds leave out all but the first.
    """
    parts = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    x = whole_numbers(F.col(quoted(vector_col)), scale)
    rows = vectors.select(F.col(quoted(id_col)).cast("long").alias("vec_id"), x.alias("x")).where("vec_id is not null and x is not null")
    classes = settle(rows.groupBy("vec_id", "x").agg(F.count("*").alias("copies")), "vectors")
    n = classes.count()
    shards = max(1, -(-n // shard_rows), min(parts, -(-n // SMALL_SHARD)))
    queries = numbered(classes.where(F.col("vec_id") % every == 0), F.col("vec_id"), F.col("x"))
    queries = settle(queries.withColumnRenamed("number", "query_no"), "queries")
    blocks = -(-queries.count() // block_queries)
    queries = queries.withColumn("block", F.floor(F.col("query_no") / block_queries).cast("int"))
    shard = F.pmod(F.xxhash64("vec_id", "x"), F.lit(shards)).cast("int")
    first = -(-shards // FIRST_SHARE)
    found: list[DataFrame] = []
    for start in range(0, blocks, BLOCKS_AT_ONCE):
        some = range(start, min(start + BLOCKS_AT_ONCE, blocks))
        mine = queries.where(F.col("block").between(some[0], some[-1]))
        near = settle(_searched(classes, mine, shard, shards, some, range(first), best), "first")
        found.append(near)
        if first < shards:
            near = _best(near, best).where(F.col("rank") == best)
            least = near.select("query_no", F.col("score").alias("least"), F.col("vec_id").alias("least_id"))
            mine = mine.join(least, "query_no", "left")
            found.append(settle(_searched(classes, mine, shard, shards, some, range(first, shards), best), "rest"))
    all_found = classes.sparkSession.createDataFrame([], FOUND)
    for part in found:
        all_found = all_found.unionByName(part)
    named = queries.select("query_no", F.col("vec_id").alias("query_id"), F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return _best(all_found, best).join(named, "query_no").select("query_id", "rank", "vec_id", "score")


def _best(found: DataFrame, best: int) -> DataFrame:
    order = Window.partitionBy("query_no").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best)


def _searched(
    classes: DataFrame, queries: DataFrame, shard: Column, shards: int, blocks: range, places: range, best: int
) -> DataFrame:
    """What the queries of ``blocks`` find in the shards at ``places`` of their order, which begins
    elsewhere for each block, so that the first searches of several blocks spread over all shards."""
    turn = lambda number: F.pmod(number, F.lit(shards)).cast("int")
    each = F.explode(F.sequence(F.lit(blocks[0]), F.lit(blocks[-1])))
    dealt = classes.withColumn("shard", shard).withColumn("block", each)
    dealt = dealt.where(turn(F.col("shard") - _start(shards)).between(places[0], places[-1]))
    asked = queries.withColumn("place", F.explode(F.sequence(F.lit(places[0]), F.lit(places[-1]))))
    asked = asked.withColumn("shard", turn(F.col("place") + _start(shards)))
    if "least" not in asked.columns:
        asked = asked.withColumn("least", F.lit(None).cast("long")).withColumn("least_id", F.lit(None).cast("long"))
    cells = len(blocks) * len(places)
    asked = asked.select("block", "shard", "query_no", "vec_id", "x", "least", "least_id").repartition(cells, "block", "shard")
    dealt = dealt.select("block", "shard", "vec_id", "x", "copies").repartition(cells, "block", "shard")

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        return pa.Table.from_batches(list(cell(left, right, best)) or [_no_rows()])

    return asked.groupBy("block", "shard").cogroup(dealt.groupBy("block", "shard")).applyInArrow(meet, FOUND)


def _start(shards: int) -> Column:
    """The shard a block begins with."""
    return F.pmod(F.xxhash64(F.col("block")), F.lit(shards))


def _no_rows() -> pa.RecordBatch:
    return _rows(*[np.zeros(0, np.int64)] * 3)


def _rows(query: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(query), pa.array(ids), pa.array(scores)], names=["query_no", "vec_id", "score"])


def cell(queries: pa.Table, vectors: pa.Table, best: int) -> Iterator[pa.RecordBatch]:
    """The best of one shard's vectors for each query of one block."""
    queries, vectors = queries.combine_chunks(), vectors.combine_chunks()
    widths = [pc.list_value_length(t.column("x")).to_numpy() for t in (queries, vectors)]
    for width in np.unique(widths[0]):
        q, v = (t.filter(pa.array(w == width)) for t, w in zip((queries, vectors), widths))
        if not v.num_rows:
            continue
        x, asked = (_matrix(t, int(width)) for t in (v, q))
        top = float(max(np.abs(x.astype(float)).max(initial=0), 1)) * float(max(np.abs(asked.astype(float)).max(initial=0), 1)) * max(width, 1)
        if top >= 2.0**62:
            raise OverflowError("a score could leave 64 bits")
        exact = np.float64 if top < 2.0**52 else np.int64
        ids, copies = v.column("vec_id").to_numpy(), v.column("copies").to_numpy()
        tree = Tree.of(x.astype(exact), ids, np.minimum(copies, best + 1))
        least = q.column("least").fill_null(np.iinfo(np.int64).min).to_numpy()
        least_id = q.column("least_id").fill_null(np.iinfo(np.int64).max).to_numpy()
        numbers, names = q.column("query_no").to_numpy(), q.column("vec_id").to_numpy()
        for i in range(0, len(asked), TOGETHER):
            s = slice(i, i + TOGETHER)
            row, ids_found, scores = tree.search(asked[s].astype(exact), names[s], least[s], least_id[s], best)
            yield _rows(numbers[s][row], ids_found, scores)


def _matrix(table: pa.Table, width: int) -> np.ndarray:
    column = table.column("x").combine_chunks()
    column = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(table.num_rows, width)


@dataclass
class Tree:
    """Vectors in an order in which every node is a run; nodes 2 i + 1 and 2 i + 2 halve node i."""

    x: np.ndarray
    ids: np.ndarray
    again: np.ndarray  # not the first of several equal rows
    first: np.ndarray  # where a node begins, and ends
    end: np.ndarray
    centre: np.ndarray
    radius: np.ndarray
    least_id: np.ndarray

    @classmethod
    def of(cls, x: np.ndarray, ids: np.ndarray, copies: np.ndarray) -> Tree:
        order = np.argsort(ids, kind="stable")
        depth = max(0, int(np.ceil(np.log2(max(len(x), 1) / LEAF))))
        nodes = 2 ** (depth + 1) - 1
        first, end = np.zeros(nodes, np.int64), np.zeros(nodes, np.int64)
        centre, radius = np.zeros((nodes, x.shape[1])), np.zeros(nodes)
        least_id = np.full(nodes, np.iinfo(np.int64).max)
        end[0] = len(x)
        for node in range(nodes):
            run = order[first[node] : end[node]]
            if len(run):
                own = x[run].astype(float)
                centre[node] = own.mean(0)
                away = ((own - centre[node]) ** 2).sum(1)
                radius[node] = np.sqrt(away.max())
                least_id[node] = ids[run].min()
                if 2 * node + 2 < nodes:  # halved across the line between two far vectors
                    one = own[away.argmax()]
                    other = own[((own - one) ** 2).sum(1).argmax()]
                    order[first[node] : end[node]] = run[np.argsort(own @ (other - one), kind="stable")]
            if 2 * node + 2 < nodes:
                middle = (first[node] + end[node]) // 2
                first[2 * node + 1], end[2 * node + 1] = first[node], middle
                first[2 * node + 2], end[2 * node + 2] = middle, end[node]
        times = copies[order]
        place = np.r_[0, np.cumsum(times)]
        again = np.ones(place[-1], bool)
        again[place[:-1]] = False
        spread = np.repeat(order, times)
        return cls(x[spread], ids[spread], again, place[first], place[end], centre, radius, least_id)

    def search(
        self, q: np.ndarray, names: np.ndarray, least: np.ndarray, least_id: np.ndarray, best: int
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row of the query, id and score of what is better than (``least``, ``least_id``), ``best`` a
        query at most. A query does not find the row it is itself."""
        least, least_id = least.copy(), least_id.copy()
        length = np.sqrt((q.astype(float) ** 2).sum(1))
        row, node = np.arange(len(q)), np.zeros(len(q), np.int64)
        bound = np.full(len(q), np.inf)
        leaves = len(self.first) // 2  # the first leaf
        while len(node) and node[0] < leaves:
            row = np.repeat(row, 2)
            node = (2 * node[:, None] + [1, 2]).ravel()
            bound = self._bounds(q, length, row, node)
            keep = self._open(bound, node, least[row], least_id[row])
            row, node, bound = row[keep], node[keep], bound[keep]
        order = np.lexsort((-bound, row))  # each query's leaves by what they can hold
        row, node, bound = row[order], node[order], bound[order]
        turn = np.arange(len(row)) - np.searchsorted(row, row)
        held = [np.zeros(0, np.int64)] * 3
        taken, width = 0, 1
        while len(row):
            now = turn < taken + width
            live = self._open(bound, node, least[row], least_id[row])
            held = self._merged(q, names, row[now & live], node[now & live], least, least_id, held, best)
            row, node, bound, turn = (a[~now & live] for a in (row, node, bound, turn))
            taken, width = taken + width, width * 2
        return held[0], held[1], held[2]

    def _bounds(self, q: np.ndarray, length: np.ndarray, row: np.ndarray, node: np.ndarray) -> np.ndarray:
        """The most that a vector of the node can score, and a little more for rounding."""
        found = np.empty(len(row))
        order = np.argsort(node, kind="stable")
        cuts = np.flatnonzero(np.r_[True, node[order][1:] != node[order][:-1]])
        for some in np.split(order, cuts[1:]):
            if len(some):
                at = node[some[0]]
                found[some] = q[row[some]] @ self.centre[at] + length[row[some]] * self.radius[at]
        reach = length[row] * (np.sqrt((self.centre[node] ** 2).sum(1)) + self.radius[node])
        return np.floor(found + 1e-9 * reach + 1e-3)

    def _open(self, bound: np.ndarray, node: np.ndarray, least: np.ndarray, least_id: np.ndarray) -> np.ndarray:
        """Whether a node can hold what is better than the k-th best so far."""
        filled = self.end[node] > self.first[node]
        return filled & ((bound > least) | ((bound == least) & (self.least_id[node] < least_id)))

    def _merged(self, q, names, row, node, least, least_id, held, best):
        """The best of ``held`` and of the rows of some leaves; the k-th best goes to ``least``."""
        parts = [held]
        order = np.argsort(node, kind="stable")
        row, node = row[order], node[order]
        cuts = np.flatnonzero(np.r_[True, node[1:] != node[:-1]]) if len(node) else []
        for rows, at in zip(np.split(row, cuts[1:]), node[cuts] if len(node) else []):
            run = slice(self.first[at], self.end[at])
            scores = (q[rows] @ self.x[run].T).astype(np.int64)
            floor, floor_id = least[rows][:, None], least_id[rows][:, None]
            i, j = np.nonzero((scores > floor) | ((scores == floor) & (self.ids[run] < floor_id)))
            own = (self.ids[run][j] == names[rows[i]]) & ~self.again[run][j]
            own[own] = (self.x[run][j[own]] == q[rows[i[own]]]).all(1)
            i, j = i[~own], j[~own]
            parts.append([rows[i], self.ids[run][j], scores[i, j]])
        who, ids, scores = (np.concatenate(p) for p in zip(*parts))
        order = np.lexsort((ids, -scores, who))
        who, ids, scores = who[order], ids[order], scores[order]
        place = np.arange(len(who)) - np.searchsorted(who, who)
        kth = place == best - 1
        least[who[kth]], least_id[who[kth]] = scores[kth], ids[kth]
        kept = place < best
        return [who[kept], ids[kept], scores[kept]]


#: The same in DuckDB's SQL over ``embeddings``: every query with every other row.
SQL = """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda c: floor(1024 * CAST(c AS DOUBLE))) AS x
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
scored AS (
  SELECT q.r, q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.x, c.x) AS BIGINT) AS score
  FROM v q JOIN v c ON q.r <> c.r AND len(q.x) = len(c.x) WHERE q.vec_id % 100 = 0),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""
