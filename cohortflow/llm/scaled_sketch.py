"""Threshold-scaled sketches: all shingle hashes below a fixed fraction of their range.

A hash is kept or not whatever else the text holds. So the sketch of two texts together is the union
of theirs, and the part of a short text's sketch that is found in a long one's estimates containment
without a bound on how unequal the two are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cohortflow.llm.common import quoted
from cohortflow.sources.scratch import settle

SHINGLE_WORDS = 5
#: One hash in so many is kept by ``sketch`` unless told otherwise.
SCALE = 8
#: Fingerprints and edited pairs keep every hash: with any lower share a text of s distinct shingles
#: has an empty sketch with probability (1 - share)^s, whatever the texts compared.
PAIR_SCALE = 1
#: Ranges of ids for each shuffle partition, so that partitions come out even.
RANGES_PER_PARTITION = 4


def let(value: Column, body) -> Column:
    """``body`` of a value that is worked out once, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def shingle_hashes(text: Column, shingle_words: int = SHINGLE_WORDS) -> Column:
    """Hashes of all word shingles in order; a text of fewer words has one, of all its words, and one
    without words none."""
    words = F.filter(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    hashes = F.transform(words, lambda w: F.xxhash64(w))

    def shingles(h: Column) -> Column:
        n = F.size(h)
        starts = F.when(n > 0, F.sequence(F.lit(0), F.greatest(n - shingle_words, F.lit(0))))
        starts = F.coalesce(starts, F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(shingle_words)]))

    return let(hashes, shingles)


def sketch(text: Column, scale: int = SCALE, shingle_words: int = SHINGLE_WORDS) -> Column:
    """The distinct shingle hashes below 1 / ``scale`` of the range, ascending."""
    last = -(1 << 63) + (1 << 64) // scale - 1
    return F.sort_array(F.array_distinct(F.filter(shingle_hashes(text, shingle_words), lambda h: h <= F.lit(last))))


def fingerprint(whole: Column, kept: Column) -> Column:
    """A hash of the whole text, a colon and the kept hashes, in hexadecimal."""
    digits = F.transform(kept, lambda h: F.lpad(F.hex(h), 16, "0"))
    return F.lower(F.concat(F.lpad(F.hex(whole), 16, "0"), F.lit(":"), F.array_join(digits, "")))


def containment(a: Column, b: Column) -> Column:
    """Of two sketches, the part of the smaller one that the larger one has; 0 if one is empty."""
    least = F.least(F.size(a), F.size(b))
    return F.when(least > 0, F.size(F.array_intersect(a, b)) / least).otherwise(F.lit(0.0))


def likeness(whole_a: Column, a: Column, whole_b: Column, b: Column) -> Column:
    """1 for equal texts, else the containment of their sketches."""
    return F.when(whole_a == whole_b, F.lit(1.0)).otherwise(containment(a, b))


def fingerprints(
    docs: DataFrame, scale: int = PAIR_SCALE, shingle_words: int = SHINGLE_WORDS, text_col: str = "text", out: str = "fingerprint"
) -> DataFrame:
    """``docs`` with the fingerprint of every whole text; null counts as empty, which has no kept hash.
    A column named ``out`` is replaced."""
    text = F.coalesce(F.col(quoted(text_col)), F.lit(""))
    kept = [F.col(quoted(c)) for c in docs.columns if c.lower() != out.lower()]
    return docs.select(*kept, fingerprint(F.xxhash64(text), sketch(text, scale, shingle_words)).alias(out))


def with_next(docs: DataFrame, payload: list[str], order_col: str, tie_col: str) -> DataFrame:
    """``docs`` with ``next_`` + c for each c of ``payload``: its value in the next row in descending order
    of ``order_col`` (null last, ties by ``tie_col``), after the last row that of the first one.

    Rows are dealt out by ranges of the order, and each range gets a copy of the row that opens the
    next one, so windows stay inside a range.
    """
    spark = docs.sparkSession
    n = RANGES_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = docs.select(F.percentile_approx(order_col, [i / n for i in range(1, n)], 20 * n)).first()[0] or []
    docs = docs.withColumn("_range", range_of(F.col(order_col), sorted(set(cuts))))
    order = [F.col(order_col).desc_nulls_last(), F.col(tie_col).desc()]
    keys = docs.select("_range", order_col, tie_col)
    heads = keys.groupBy("_range").agg(F.max(F.struct(F.coalesce(order_col, F.lit(0)).alias("o"), F.col(tie_col).alias("t"))).alias("h"))
    ranges = Window.orderBy(F.col("_range").desc())  # a row per range
    before = F.coalesce(F.lag("_range").over(ranges), F.min("_range").over(Window.partitionBy()))
    heads = settle(heads.select(F.col("_range").alias("_of"), "h", before.alias("_before")), "heads")
    match = (F.col("_range") == F.col("_of")) & (F.col(tie_col) == F.col("h.t")) & (
        F.coalesce(order_col, F.lit(0)) == F.col("h.o")
    )
    opening = docs.join(heads, match).dropDuplicates(["_of"])
    copies = opening.withColumn("_range", F.col("_before")).drop("_of", "h", "_before").withColumn("_copy", F.lit(True))
    rows = docs.withColumn("_copy", F.lit(False)).unionByName(copies.select(*docs.columns, "_copy"))
    following = F.lead(F.struct(*payload)).over(Window.partitionBy("_range").orderBy("_copy", *order))
    rows = rows.withColumn("_next", following).where(~F.col("_copy"))
    return rows.select(*[c for c in docs.columns if c != "_range"], *[F.col("_next")[c].alias(f"next_{c}") for c in payload])


def range_of(value: Column, cuts: list) -> Column:
    """The number of cuts at or below a value, -1 for null: first among every few, then within."""
    if not cuts:
        return F.when(value.isNull(), -1).otherwise(0)
    step = max(1, int(len(cuts) ** 0.5))
    groups = [cuts[i : i + step] for i in range(0, len(cuts), step)]
    heads = F.array(*[F.lit(g[0]) for g in groups])
    fine = F.array(*[F.array(*[F.lit(c) for c in g]) for g in groups])

    def within(k: Column) -> Column:
        own = F.size(F.filter(F.element_at(fine, k), lambda c: c <= value))
        return F.when(k > 0, (k - 1) * step + own).otherwise(0)

    group = F.size(F.filter(heads, lambda c: c <= value))
    return F.when(value.isNull(), -1).otherwise(let(group, lambda k: F.when(k > 0, within(F.greatest(k, F.lit(1)))).otherwise(0)))


def edited_pairs(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", scale: int = PAIR_SCALE
) -> DataFrame:
    """A row per row of ``docs``: the id, ``n_chars`` (code points), ``edited_sha256``, ``fingerprint``,
    ``edited_fingerprint``, ``near_edited``, ``near_next``.

    The edited text has the first floor(n_chars / 2) code points of the next document (or all, if it
    has fewer) in place of as many at its end. Next is the order of descending ids, null last, equal
    ids by a hash of their texts, and the first document follows the last. A null text counts as
    empty, texts of any length are taken whole. A single row is its own next. An empty table gives an empty one. Other columns are not
    read, whatever their names. At scale 1 both likenesses are exact but for collisions of 64-bit
    hashes. Sketches are worked out after the shuffle, which so moves texts only.
    """
    text = F.coalesce(F.col(quoted(text_col)), F.lit(""))
    rows = docs.select(F.col(quoted(id_col)).cast("long").alias("doc_id"), text.alias("text"))
    rows = with_next(rows.withColumn("whole", F.xxhash64("text")), ["text", "whole"], "doc_id", "whole")
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - half), F.substring(F.col("next_text"), F.lit(1), half))
    rows = rows.withColumn("n_chars", n.cast("long")).withColumn("edited", edited)
    rows = rows.withColumns({
        "kept": sketch(F.col("text"), scale),
        "next_kept": sketch(F.col("next_text"), scale),
        "edited_kept": sketch(F.col("edited"), scale),
        "edited_whole": F.xxhash64("edited"),
        "edited_sha256": F.sha2("edited", 256),
    }).drop("text", "next_text", "edited")
    return rows.select(
        F.col("doc_id").alias(id_col),
        "n_chars",
        "edited_sha256",
        fingerprint(F.col("whole"), F.col("kept")).alias("fingerprint"),
        fingerprint(F.col("edited_whole"), F.col("edited_kept")).alias("edited_fingerprint"),
        likeness(F.col("whole"), F.col("kept"), F.col("edited_whole"), F.col("edited_kept")).alias("near_edited"),
        likeness(F.col("whole"), F.col("kept"), F.col("next_whole"), F.col("next_kept")).alias("near_next"),
    )
