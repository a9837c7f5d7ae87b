"""Centroid clustering on exact integers with a distance matrix that is kept up to date.

Every vector carries its integer dot products with all centroids. A round changes a product by the
components in which its centroid moved and by no others, then takes the nearest centroid anew:
``|x|^2 - 2 x.c + |c|^2`` needs nothing but the products and ``|c|^2``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortflow.llm.common import quoted
from cohortflow.sources.scratch import discard, settle

DIMENSIONS, CENTROIDS, ROUNDS, SCALE, SEED = 64, 16, 3, 64, 1
#: Largest size of an integer component: distances of vectors up to it fit in 64 bits many times over.
LARGEST = 1 << 24

STATE = "vec_id {}, x array<bigint>, dots array<bigint>, cluster int, distance bigint"


def whole_numbers(vector: Column, scale: int) -> Column:
    """``floor(scale * x)`` of every component, null for vectors that are null or hold null or
    non-finite components."""
    doubles = vector.cast("array<double>")
    finite = F.forall(doubles, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    return F.when(finite, F.transform(doubles, lambda x: F.floor(x * F.lit(float(scale)))))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Lists of one length as the rows of a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def lists(values: np.ndarray) -> pa.Array:
    """Rows of a matrix as lists."""
    offsets = np.arange(len(values) + 1, dtype=np.int32) * values.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.ravel()))


def cluster(
    vectors: DataFrame,
    centroids: int = CENTROIDS,
    rounds: int = ROUNDS,
    dimensions: int = DIMENSIONS,
    scale: int = SCALE,
    seed: int = SEED,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """A row per vector kept: its id, ``cluster``, ``distance`` (squared), ``cluster_inertia`` and
    ``inertia`` (distances summed over its cluster and over all), ``centroid_sha256``.

    Vectors of another length, null ones and those with null or non-finite components are left out.
    Centroids start as the vectors whose ``<seed>:<id>`` has the smallest SHA-256; vectors under one id
    are told apart by their components, and those without an id come last. With fewer vectors than
    ``centroids`` there are as many centroids as vectors. Equal distances go to the smaller number,
    empty clusters keep their centroid. Rows that repeat an id or a vector are rows like any other.
    An empty table gives an empty one; other columns are not read, whatever their names. Components
    beyond ``LARGEST`` after scaling raise an error, as sums of their squares would leave 64 bits.

    What reaches the driver is a row of sums for each centroid; vectors and products stay in a table
    that each round writes anew. A cluster with most of the rows costs partial sums only.
    """
    kept = vectors.select(F.col(quoted(id_col)).alias("vec_id"), whole_numbers(F.col(quoted(vector_col)), scale).alias("x"))
    kept = kept.where(F.size("x") == dimensions)
    drawn = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = kept.select(drawn.alias("drawn"), "x").orderBy(F.col("drawn").asc_nulls_last(), "x").limit(centroids)
    places = [list(r["x"]) for r in first.collect()]
    kind = kept.schema["vec_id"].dataType
    if not places:
        return _empty(vectors.sparkSession, kind, id_col)
    rows, before = kept, [[0] * dimensions for _ in places]
    for step in range(rounds + 1):
        last = step == rounds
        moved = settle(_assigned(rows, before, places, kind, last), "distances")
        if step:
            discard(rows)
        rows, before = moved, places
        if not last:
            places = _means(rows, places)
    sums = {r["cluster"]: r["inertia"] for r in rows.groupBy("cluster").agg(F.sum("distance").alias("inertia")).collect()}
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in places]
    of = lambda values: F.element_at(F.array(*map(F.lit, values)), F.col("cluster") + 1)  # noqa: E731 - one value a centroid
    return rows.select(
        F.col("vec_id").alias(id_col),
        "cluster",
        "distance",
        of([sums.get(i, 0) for i in range(len(places))]).cast("bigint").alias("cluster_inertia"),
        F.lit(sum(sums.values())).cast("bigint").alias("inertia"),
        of(digests).alias("centroid_sha256"),
    )


def _assigned(rows: DataFrame, before: list, now: list, kind: T.DataType, last: bool) -> DataFrame:
    """``rows`` with products brought from the centroids ``before`` to those ``now`` (a vector without
    products has them with centroids of zeros), the nearest centroid and the distance to it."""
    known = "dots" in rows.columns
    change = np.array(now, np.int64) - np.array(before, np.int64)
    parts = [(np.flatnonzero(row), row[np.flatnonzero(row)]) for row in change]
    norms = (np.array(now, np.int64) ** 2).sum(1)
    kept = ["vec_id", "cluster", "distance"] if last else ["vec_id", "x", "dots", "cluster", "distance"]
    schema = T.StructType([f for f in T._parse_datatype_string(STATE.format(kind.simpleString())) if f.name in kept])

    def update(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column("x"), change.shape[1])
            if len(x) and np.abs(x).max() > LARGEST:
                raise OverflowError("a component is too large for exact distances in 64 bits")
            dots = matrix(batch.column("dots"), len(norms)).copy() if known else np.zeros((len(x), len(norms)), np.int64)
            for centroid, (at, by) in enumerate(parts):
                if len(at):
                    dots[:, centroid] += x[:, at] @ by
            far = norms - 2 * dots
            nearest = far.argmin(1)
            found = {
                "vec_id": batch.column("vec_id"),
                "x": batch.column("x"),
                "dots": lists(dots),
                "cluster": pa.array(nearest.astype(np.int32)),
                "distance": pa.array((x * x).sum(1) + far[np.arange(len(x)), nearest]),
            }
            yield pa.RecordBatch.from_arrays([found[c] for c in kept], names=kept)

    return rows.select("vec_id", "x", *["dots"] * known).mapInArrow(update, schema)


def _means(rows: DataFrame, places: list[list[int]]) -> list[list[int]]:
    """Componentwise floors of the means of the clusters."""
    sums = [F.sum(F.col("x")[i]).alias(f"_{i}") for i in range(len(places[0]))]
    found = list(places)
    for r in rows.groupBy("cluster").agg(F.count("*").alias("rows"), *sums).collect():
        found[r["cluster"]] = [r[f"_{i}"] // r["rows"] for i in range(len(places[0]))]
    return found


def _empty(spark, kind: T.DataType, id_col: str) -> DataFrame:
    rest = "cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string"
    return spark.createDataFrame([], T.StructType([T.StructField(id_col, kind), *T._parse_datatype_string(rest)]))


def sql() -> str:
    """The same in DuckDB's SQL over ``embeddings``: distances worked out afresh in every round."""
    head = """
WITH kept AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda c: CAST(floor(64 * CAST(c AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda c: c IS NOT NULL AND isfinite(c))) = 64),
c0 AS (
  SELECT row_number() OVER (ORDER BY sha256('1:' || CAST(vec_id AS VARCHAR)), x) - 1 AS k, x
  FROM kept ORDER BY k LIMIT 16)"""
    distance = "list_sum(list_transform(list_zip(v.x, c.x), lambda p: (p[1] - p[2]) * (p[1] - p[2])))"
    nearest = """,
a{i} AS (
  SELECT v.r, arg_min(c.k, CAST({distance} AS BIGINT) * 16 + c.k) AS k, CAST(min({distance}) AS BIGINT) AS distance
  FROM kept v, c{i} c GROUP BY v.r)"""
    means = """,
s{i} AS (
  SELECT k, j, CAST(sum(x[j]) AS BIGINT) AS s, count(*) AS n
  FROM a{i} JOIN kept USING (r), range(1, 65) t(j) GROUP BY k, j),
m{i} AS (SELECT k, list((s - ((s % n) + n) % n) // n ORDER BY j) AS x FROM s{i} GROUP BY k),
c{next} AS (SELECT c.k, coalesce(m.x, c.x) AS x FROM c{i} c LEFT JOIN m{i} m USING (k))"""
    text = head
    for i in range(3):
        text += nearest.format(i=i, distance=distance) + means.format(i=i, next=i + 1)
    return text + nearest.format(i=3, distance=distance) + """
SELECT v.vec_id, CAST(a.k AS INTEGER) AS cluster, a.distance,
       CAST(sum(a.distance) OVER (PARTITION BY a.k) AS BIGINT) AS cluster_inertia,
       CAST(sum(a.distance) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.x, ',')) AS centroid_sha256
FROM a3 a JOIN kept v USING (r) JOIN c3 c ON a.k = c.k"""
