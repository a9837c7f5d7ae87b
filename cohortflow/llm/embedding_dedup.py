"""Near duplicates among vectors: random hyperplanes, exact cosines, connected components.

The signs of some random projections make a bucket, in several tables. Two vectors at the least cosine
(0.93, an angle of 21.6 degrees) agree on a sign with probability 0.88, and nearer ones more surely. The number of
signs of a bucket follows from the number of vectors of the largest label, so that a bucket holds some
hundred of them, and the number of tables from the signs, so that vectors at the least cosine share a
bucket with the wanted recall: 1 - (1 - 0.88 ** signs) ** tables.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from cohortflow.llm.blocks import Forest, grouped_batches, with_block_pairs
from cohortflow.llm.common import quoted
from cohortflow.llm.components import connected_components
from cohortflow.sources.scratch import settle

LEAST_COSINE = 0.93
#: Of pairs at the least cosine, the share that meet in a bucket; of nearer pairs more do.
RECALL = 0.995
#: Vectors of one label that fall into a bucket on average, about.
BUCKET_ROWS = 512
#: Signs of a bucket, at least and at most.
LEAST_BITS, MOST_BITS = 4, 30
SEED = 20
BLOCK_ROWS = 2048
#: Rows of a group that are multiplied with the whole group at once.
ROWS_AT_ONCE = 512
#: Groups up to this size are compared by lag, many groups at once.
SMALL_GROUP = 24


def plan(vectors: int, least_cosine: float = LEAST_COSINE, recall: float = RECALL, bucket_rows: int = BUCKET_ROWS) -> tuple[int, int]:
    """Signs of a bucket and number of tables for so many vectors of one label."""
    bits = min(MOST_BITS, max(LEAST_BITS, math.ceil(math.log2(max(1, vectors / bucket_rows)))))
    meet = (1 - math.acos(max(-1.0, min(1.0, least_cosine))) / math.pi) ** bits
    return bits, 1 if meet >= 1 else max(1, math.ceil(math.log(1 - recall) / math.log(1 - meet)))


def planes(dim: int, bits: int, tables: int, seed: int = SEED) -> np.ndarray:
    return np.random.default_rng([seed, dim]).standard_normal((dim, bits * tables))


def sign_buckets(vector: Column, bits: int, tables: int, seed: int = SEED) -> Column:
    """The signs of each vector, eight to a byte, and its bucket in each table."""

    @arrow_udf("struct<signs binary, buckets array<bigint>>")
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in batches:
            sizes = pc.list_value_length(column).to_numpy(zero_copy_only=False).astype(int)
            flat = column.flatten().to_numpy(zero_copy_only=False).astype(float)
            starts = np.r_[0, np.cumsum(sizes)]
            found = np.zeros((len(column), -(-bits * tables // 8)), np.uint8)
            for dim in np.unique(sizes):
                own = np.flatnonzero(sizes == dim)
                x = flat[(starts[own][:, None] + np.arange(dim)).ravel()].reshape(len(own), dim)
                found[own] = np.packbits(x @ planes(int(dim), bits, tables, seed) >= 0, axis=1, bitorder="little")
            offsets = pa.array(np.arange(len(found) + 1, dtype=np.int32) * tables)
            buckets = pa.ListArray.from_arrays(offsets, pa.array(bucket_numbers(found, bits, tables).ravel()))
            yield pa.StructArray.from_arrays([pa.array([row.tobytes() for row in found], pa.binary()), buckets], names=["signs", "buckets"])

    return of(vector)


def bucket_numbers(signs: np.ndarray, bits: int, tables: int) -> np.ndarray:
    """(rows, tables): the bucket in each table, from rows of packed signs."""
    found = np.unpackbits(signs, axis=1, count=bits * tables, bitorder="little").reshape(len(signs), tables, bits)
    return found.astype(np.int64) @ (1 << np.arange(bits, dtype=np.int64))


def usable(vector: Column) -> Column:
    """Neither null nor zero, with finite components only."""
    finite = F.forall(vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def near_vectors(
    vectors: DataFrame,
    least_cosine: float = LEAST_COSINE,
    recall: float = RECALL,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    block_rows: int = BLOCK_ROWS,
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """A row per row of ``vectors``: the id, ``n_links`` (other rows linked directly), ``component_id``
    (the smallest id reachable by links, its own included), ``kept`` (id = component_id).

    Vectors are linked if their labels are equal and not null and their cosine in double precision is
    at least ``least_cosine``. Vectors that are null, empty, zero or hold null or non-finite components,
    and rows without a label, link with nothing. So do rows without an id, whose component_id is null
    and which are kept. Vectors of different lengths do not link. Rows that repeat an id are rows like
    any other: each has the links of its own vector and label. An empty table gives an empty one;
    other columns are not read, whatever their names.

    Equal vectors of a label are one class from the start and count as often as they occur; a class has
    a number of its own. A pair is counted in the first table in which its buckets agree. Rows find
    their class by two 64-bit hashes of label and vector, so vectors are shuffled for the classes and for
    the tables only.
    """
    vector, label = F.col(quoted(vector_col)), F.col(quoted(label_col))
    wide = vectors.schema[vector_col].dataType.elementType.simpleString() != "float"
    fit = F.col(quoted(id_col)).isNotNull() & label.isNotNull() & usable(vector.cast("array<double>"))
    rows = vectors.select(
        F.col(quoted(id_col)).alias("vec_id"),
        label.alias("label"),
        (vector.cast("array<double>") if wide else vector).alias("v"),
        F.coalesce(fit, F.lit(False)).alias("fit"),
    )
    hashes = {"h1": F.xxhash64("label", "v"), "h2": F.xxhash64(F.lit(1), "v", "label")}
    joined = rows.where("fit").withColumns(hashes)
    classes = joined.groupBy("h1", "h2", "label", "v").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"))
    classes = settle(classes.withColumn("class", F.monotonically_increasing_id()), "classes")
    most = classes.groupBy("label").count().agg(F.max("count")).first()[0] or 0
    bits, tables = plan(most, least_cosine, recall, bucket_rows)
    found = settle(_links(classes, least_cosine, bits, tables, block_rows), "links")
    links = found.groupBy("class").agg(F.sum("links").alias("links"))
    edges = found.where("class <> root").select(F.col("class").alias("a"), F.col("root").alias("b"))
    parts = settle(connected_components(edges).select(F.col("node").alias("class"), "component"), "parts")
    names = classes.select("class", "h1", "h2", "rep", "copies")
    least = names.join(parts, "class").groupBy("component").agg(F.min("rep").alias("least"))
    by_class = names.join(links, "class", "left").join(parts.join(least, "component"), "class", "left")
    by_class = by_class.select(
        "h1",
        "h2",
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).cast("long").alias("n_links"),
        F.coalesce("least", "rep").alias("component_id"),
    )
    linked = joined.select("vec_id", "h1", "h2").join(settle(by_class, "by_class"), ["h1", "h2"]).select("vec_id", "n_links", "component_id")
    alone = rows.where("not fit").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    kept = F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True))
    return linked.unionByName(alone).select(F.col("vec_id").alias(id_col), "n_links", "component_id", kept.alias("kept"))


def _links(classes: DataFrame, least_cosine: float, bits: int, tables: int, block_rows: int) -> DataFrame:
    """class, links (rows it is linked to that were found here), root (a class it is linked to)."""
    signed = classes.select("class", "copies", "v", F.xxhash64("label").alias("label"), sign_buckets(F.col("v"), bits, tables).alias("found"))
    rows = signed.select("class", "copies", "v", "label", "found.signs", F.posexplode("found.buckets").alias("table", "sign"))
    rows = rows.withColumn("bucket", F.xxhash64("label", F.size("v"), "table", "sign")).drop("sign")
    rows = with_block_pairs(rows, "bucket", F.col("class"), block_rows)
    keys = ["bucket", "_pair"]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in grouped_batches(batches, keys):
            sizes = np.diff(starts)
            several = np.repeat(sizes > 1, sizes)
            if not several.any():
                continue
            table = table.filter(pa.array(several)).combine_chunks()
            starts = np.r_[0, np.cumsum(sizes[sizes > 1])]
            copies = table.column("copies").to_numpy()
            links, forest = np.zeros(len(copies), np.int64), Forest(len(copies))
            for a, b in _near_pairs(table, starts, least_cosine, bits, tables):
                np.add.at(links, a, copies[b])
                np.add.at(links, b, copies[a])
                forest.link(a, b)
            names, roots = table.column("class").to_numpy(), forest.roots()
            out = np.flatnonzero(links)
            if len(out):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names[out]), pa.array(links[out]), pa.array(names[roots[out]])], names=["class", "links", "root"]
                )

    return (
        rows.select(*keys, "_block", "class", "copies", "label", "table", "v", "signs")
        .repartition(*keys)
        .sortWithinPartitions(*keys)
        .mapInArrow(compare, "class long, links long, root long")
    )


def _near_pairs(table: pa.Table, starts: np.ndarray, least: float, bits: int, tables: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows of one group at the cosine or above whose buckets agree in no earlier table."""
    lists, signs = table.column("v").chunk(0), table.column("signs").chunk(0)
    flat, sizes = lists.flatten().to_numpy().astype(float), np.diff(lists.offsets.to_numpy())
    at = lists.offsets.to_numpy() - lists.offsets[0].as_py()
    sign = bucket_numbers(np.frombuffer(b"".join(signs.to_pylist()), np.uint8).reshape(len(table), -1), bits, tables)
    number = table.column("table").to_numpy()
    label = table.column("label").to_numpy()
    block = table.column("_block").to_numpy()
    before = np.arange(sign.shape[1])

    def fresh(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        earlier = ((sign[a] == sign[b]) & (before < number[a][:, None])).any(1)
        ok = ~earlier & (label[a] == label[b]) & (number[a] == number[b])
        return a[ok], b[ok]

    group_sizes = np.diff(starts)
    small = np.repeat(group_sizes <= SMALL_GROUP, group_sizes)
    two = np.repeat(
        np.minimum.reduceat(block, starts[:-1]) != np.maximum.reduceat(block, starts[:-1]), group_sizes
    )
    for dim in np.unique(sizes):
        rows = np.flatnonzero(sizes == dim)
        x = flat[(at[rows][:, None] + np.arange(dim)).ravel()].reshape(len(rows), dim)
        scale = np.abs(x).max(axis=1, keepdims=True)  # so that no square overflows
        x = x / scale
        x /= np.sqrt((x * x).sum(1, keepdims=True))
        unit = np.zeros((len(sizes), dim)) if len(rows) < len(sizes) else x
        if len(rows) < len(sizes):
            unit[rows] = x
        last = np.repeat(starts[1:], group_sizes)
        place = np.flatnonzero(small & (sizes == dim))
        for lag in range(1, SMALL_GROUP):
            place = place[place + lag < last[place]]
            if not len(place):
                break
            near = place[np.einsum("ij,ij->i", unit[place], unit[place + lag]) >= least]
            near = near[~two[near] | (block[near] != block[near + lag])]
            yield fresh(near, near + lag)
        for g in np.flatnonzero(group_sizes > SMALL_GROUP):
            first, end = starts[g], starts[g + 1]
            if sizes[first] != dim:
                continue
            for i in range(first, end, ROWS_AT_ONCE):
                some = np.arange(i, min(i + ROWS_AT_ONCE, end))
                cosines = unit[some] @ unit[i:end].T
                a, b = np.nonzero(cosines >= least)
                a, b = some[a], i + b
                ok = (a < b) & (~two[a] | (block[a] != block[b]))
                yield fresh(a[ok], b[ok])
