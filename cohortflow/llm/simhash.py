"""SimHash fingerprints and groups of documents whose fingerprints are near, compared in bit slices.

Fingerprints within ``radius`` bits agree on all of ``radius + 2`` parts but at most ``radius``, so
they share at least two whole parts: every pair of parts is a table, and equal values in it are a
bucket. No pair within the radius is missed. In a bucket, bit planes are stored vertically: a word
of a plane holds one bit of 64 fingerprints. Rows are compared with those that lie ``lag`` places on,
64 pairs to a word, differing bits are summed by carry-save counters, and words whose pairs all
differ in more bits than the radius are left behind.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from cohortflow.llm.blocks import Forest, grouped_batches, with_block_pairs
from cohortflow.llm.common import quoted, texts_in_slices, unused
from cohortflow.llm.pieces import release
from cohortflow.llm.components import connected_components
from cohortflow.sources.scratch import settle

SHINGLE_WORDS = 4
RADIUS = 4
SEED = 42
BLOCK_ROWS = 4096
#: Shingles whose hashes are unpacked to bits at once.
HASHES_AT_ONCE = 32_768
#: Planes between two looks at which words are still open.
PLANES_AT_ONCE = 8


def fingerprint(text: str, shingle_words: int = SHINGLE_WORDS) -> int:
    """A bit is set if it is set in over half the hashes of the shingles; no words give zero."""
    words = text.encode().lower().split()  # bytes: A-Z alone change, and only the six separators split
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    n = max(1, len(words) - shingle_words + 1)
    starts, ends = starts[:n], ends[min(shingle_words, len(words)) - 1 :]
    set_bits = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for i in range(0, n, HASHES_AT_ONCE):
        part = slice(i, i + HASHES_AT_ONCE)
        hashes = [digest(joined[a:b], SEED) for a, b in zip(starts[part].tolist(), ends[part].tolist())]
        bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        set_bits += bits.sum(0, dtype=np.int64)
    return int(np.packbits(set_bits * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(text: Column, shingle_words: int = SHINGLE_WORDS) -> Column:
    """Fingerprints of a text column as signed 64-bit integers; null counts as empty."""

    @arrow_udf("long")
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        release()
        for column in batches:
            found = [fingerprint(t, shingle_words) for texts in texts_in_slices(column) for t in texts]
            yield pa.array(np.array(found, np.uint64).view(np.int64), pa.int64())

    return of(text)


def part_masks(radius: int) -> list[int]:
    """Masks of the tables: all choices of two of ``radius + 2`` parts of the 64 bits."""
    edges = np.linspace(0, 64, radius + 3).round().astype(int).tolist()
    parts = [(1 << b) - (1 << a) for a, b in zip(edges[:-1], edges[1:])]
    return [a | b for a, b in combinations(parts, 2)]


def bit_planes(values: np.ndarray) -> np.ndarray:
    """64 rows of words; word ``w`` of row ``b`` has bit ``b`` of values ``64 w`` to ``64 w + 63``. One
    word of zeros follows, for shifts."""
    n = -(-len(values) // 64)
    held = np.zeros((n + 1) * 64, np.uint64)
    held[: len(values)] = values
    bits = np.unpackbits(held.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view("<u8").astype(np.uint64)


def words_of(flags: np.ndarray) -> np.ndarray:
    """Flags as words of 64."""
    held = np.zeros(-(-len(flags) // 64) * 64, bool)
    held[: len(flags)] = flags
    return np.packbits(held, bitorder="little").view("<u8").astype(np.uint64)


def pairs_at_lag(planes: np.ndarray, lag: int, wanted: np.ndarray, radius: int) -> np.ndarray:
    """Rows ``i`` for which ``wanted`` (flags as words) is set and rows ``i`` and ``i + lag`` differ in at
    most ``radius`` bits."""
    skip, shift = divmod(lag, 64)
    words = np.flatnonzero(wanted)
    open_ = wanted[words]
    counters = [np.zeros(len(words), np.uint64) for _ in range(radius.bit_length())]
    over = np.zeros(len(words), np.uint64)
    for start in range(0, 64, PLANES_AT_ONCE):
        here = planes[start : start + PLANES_AT_ONCE]
        there = here[:, words + skip] >> np.uint64(shift)
        if shift:
            there |= here[:, words + skip + 1] << np.uint64(64 - shift)
        differ = here[:, words] ^ there
        for k in range(0, PLANES_AT_ONCE, 2):
            # Carry-save: two planes and the lowest counter give a new lowest one and one carry.
            x, y, z = differ[k], differ[k + 1], counters[0]
            half = x ^ y
            carry = (x & y) | (half & z)
            counters[0] = half ^ z
            for c in range(1, len(counters)):
                counters[c], carry = counters[c] ^ carry, counters[c] & carry
            over |= carry
        alive = open_ & ~(over | _above(counters, radius))
        still = np.flatnonzero(alive)
        if not len(still):
            return still
        if len(still) < len(words):
            words, open_, over = words[still], open_[still], over[still]
            counters = [c[still] for c in counters]
            alive = alive[still]
    flags = np.unpackbits(alive.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    word, bit = np.nonzero(flags)
    return words[word] * 64 + bit


def _above(counters: list[np.ndarray], radius: int) -> np.ndarray:
    """Where the number in the counters is larger than ``radius``."""
    larger = np.zeros_like(counters[0])
    equal = ~larger
    for c in range(len(counters) - 1, -1, -1):
        if radius >> c & 1:
            equal = equal & counters[c]
        else:
            larger = larger | (equal & counters[c])
            equal = equal & ~counters[c]
    return larger


def near_roots(values: np.ndarray, starts: np.ndarray, radius: int, block: np.ndarray) -> np.ndarray:
    """For rows in groups that begin at ``starts``, the first row each is linked to within its group.
    Rows of different groups are not compared; in a group of two blocks, only rows of different ones,
    as each block meets itself elsewhere."""
    sizes = np.diff(starts)
    last = np.repeat(starts[1:], sizes)
    group = np.repeat(np.arange(len(sizes)), sizes)
    two = np.minimum.reduceat(block, starts[:-1]) != np.maximum.reduceat(block, starts[:-1])
    two = two[group]
    place = np.arange(len(values))
    planes = bit_planes(values)
    forest = Forest(len(values))
    for lag in range(1, int(sizes.max(initial=1))):
        fits = place + lag < last
        if two.any():
            other = block[np.minimum(place + lag, len(values) - 1)]
            fits &= ~two | (block != other)
        wanted = words_of(fits)
        planes_needed = (len(values) + lag) // 64 + 2
        if planes.shape[1] < planes_needed:
            planes = np.pad(planes, ((0, 0), (0, planes_needed - planes.shape[1])))
        hits = pairs_at_lag(planes, lag, wanted, radius)
        forest.link(hits, hits + lag)
    return forest.roots()


def near_edges(prints: DataFrame, radius: int = RADIUS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Edges (a, b) that connect distinct fingerprints (column ``fp``) exactly as all pairs within the
    radius would. Each bucket gives a tree of what it links, never all its pairs."""
    masks = F.array(*[F.lit(m - (1 << 64) if m >> 63 else m) for m in part_masks(radius)])
    rows = prints.select("fp", F.posexplode(masks).alias("table", "mask"))
    rows = rows.select("fp", F.xxhash64("table", F.col("fp").bitwiseAND(F.col("mask"))).alias("bucket"))
    rows = with_block_pairs(rows, "bucket", F.col("fp"), block_rows)
    keys = ["bucket", "_pair"]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in grouped_batches(batches, keys):
            sizes = np.diff(starts)
            several = np.repeat(sizes > 1, sizes)
            if not several.any():
                continue
            table = table.filter(pa.array(several))
            starts = np.r_[0, np.cumsum(sizes[sizes > 1])]
            values = table.column("fp").to_numpy()
            block = table.column("_block").to_numpy()
            roots = near_roots(values.view(np.uint64), starts, radius, block)
            linked = np.flatnonzero(roots != np.arange(len(roots)))
            if len(linked):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(values[linked]), pa.array(values[roots[linked]])], names=["a", "b"]
                )

    return (
        rows.select("bucket", "_pair", "_block", "fp")
        .repartition(*keys)
        .sortWithinPartitions(*keys)
        .mapInArrow(compare, "a long, b long")
    )


def near_duplicates(
    docs: DataFrame,
    shingle_words: int = SHINGLE_WORDS,
    radius: int = RADIUS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """A row per row of ``docs``: the id, ``fingerprint`` (16 hex digits), ``component_id`` (the smallest
    id reachable over fingerprints that differ in at most ``radius`` bits, its own included).

    Null and empty texts have fingerprint zero and link like any other. Rows with a null id take part
    and get their component, but name none: a component of null ids alone has a null component_id.
    Rows that are equal each get their row. Texts of any length are read whole. An empty table gives an empty one.
    Other columns are not read, whatever their names. Equal fingerprints are one from the start, so copies cost a minimum.
    """
    docs = docs.select(F.col(quoted(id_col)).alias("doc_id"), F.col(quoted(text_col)).alias("text"))
    rows = settle(docs.select("doc_id", fingerprints(F.col("text"), shingle_words).alias("fp")), "simhash")
    by_print = _groups(rows, radius)
    return rows.join(by_print, "fp").select(
        F.col("doc_id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def _groups(rows: DataFrame, radius: int) -> DataFrame:
    """(fp, part, component_id) of each fingerprint of ``rows`` (doc_id, fp): a fingerprint of its group,
    and the smallest id in it."""
    prints = settle(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "prints")
    edges = settle(near_edges(prints, radius).distinct(), "near")
    linked = connected_components(edges)
    parts = prints.join(linked.withColumnRenamed("node", "fp"), "fp", "left")
    parts = settle(parts.select("fp", "least", F.coalesce("component", "fp").alias("part")), "parts")
    # Stored by itself, so that a group of very many fingerprints can be split where it is joined.
    smallest = settle(parts.groupBy("part").agg(F.min("least").alias("component_id")), "smallest")
    return settle(parts.join(smallest, "part").select("fp", "part", "component_id"), "by_print")


def drop_near_duplicates(
    docs: DataFrame, shingle_words: int = SHINGLE_WORDS, radius: int = RADIUS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``docs``, all columns, with one row of each group of near duplicates: that with the smallest id, a null id
    after all others, and of rows that share it the one whose text has the smallest hash. Rows that are equal in id
    and text are one document, of which one row stays. Null and empty texts are a group of their own; an empty
    table gives an empty one.
    """
    id_, text = F.col(quoted(id_col)), F.col(quoted(text_col))
    own = F.xxhash64(F.coalesce(text, F.lit("")))
    rows = docs.select(id_.alias("doc_id"), own.alias("own"), fingerprints(text, shingle_words).alias("fp"))
    rows = settle(rows, "simhash")
    keys = rows.groupBy("fp", "doc_id", "own").agg(F.count("*").alias("copies"))
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "own")
    kept = keys.join(_groups(rows, radius).select("fp", "part"), "fp")
    kept = kept.groupBy("part").agg(F.min(F.struct(order.alias("order"), "copies")).alias("k"))
    kept = settle(kept.select(F.col("k.order.doc_id").alias("_id"), F.col("k.order.own").alias("_own"), F.col("k.copies").alias("_copies")), "kept")
    names = {c: unused(docs, c) for c in ("id", "own", "copies")}
    kept = kept.select(*[F.col(f"_{c}").alias(f"{name}_k") for c, name in names.items()])
    hashed = docs.withColumn(names["own"], own)
    same = id_.eqNullSafe(F.col(f"{names['id']}_k")) & (F.col(names["own"]) == F.col(f"{names['own']}_k"))
    found = hashed.join(kept, same)
    copies, columns = F.col(f"{names['copies']}_k"), [F.col(quoted(c)) for c in docs.columns]
    several = found.where(copies > 1).dropDuplicates([id_col, names["own"]])
    return found.where(copies == 1).select(*columns).unionByName(several.select(*columns))
