"""Mixing sources to target weights with hash thresholds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from cohortflow.llm.common import n_words, quoted, unused
from cohortflow.sources.scratch import settle

#: Weights of the sources in order, repeated as often as needed.
WEIGHTS = (5, 2, 1)
#: A document is taken at most so many times.
MOST = 3
#: A hash has LEVELS x LEVEL_BITS bits; each level's histogram has 2^LEVEL_BITS buckets a source.
LEVEL_BITS, LEVELS = 12, 5
HASH_BITS = LEVEL_BITS * LEVELS


def mix(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    most: int = MOST,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """A row per row of ``docs``: the id, ``size`` (words), ``source_size``, ``target`` (of its source) and
    ``taken`` (words the mix takes, repeats counted).

    Sources in code-point order, null last, have the ``weights`` in turn and share the sum of all
    sizes; a target stops at ``most`` times its source's size and the excess goes to the others by
    weight. A source is taken whole as often as its target allows; of the rest, the documents below
    a hash threshold are taken once more, and the document at the threshold if that comes nearer to
    the target. The hash is that of the id, so reruns agree and rows that share an id share their
    lot; rows without an id go by their text. Null and empty texts have size 0 and take 0 words, texts
    of any length count whole. An empty table gives an empty one. Other columns are not read, whatever their names.

    Per level, one histogram of size by source and hash bucket finds the bucket in which the threshold
    lies, and only that bucket is looked at in the next level; nothing is sorted but buckets.
    """
    id_, text = F.col(quoted(id_col)), F.col(quoted(text_col))
    rows = settle(
        docs.select(
            id_.alias("doc_id"),
            F.col(quoted(source_col)).cast("string").alias("source"),
            n_words(text).alias("size"),
            mix_hash(F.coalesce(id_.cast("string"), text, F.lit(""))).alias("hash"),
        ),
        "sizes",
    )
    sources = settle(_targets(rows, weights, most), "sources")
    plan = sources.select("source", "source_no", "source_size", "target", "whole", "rest")
    same = rows["source"].eqNullSafe(plan["source"])
    rows = settle(rows.join(plan, same).drop(plan["source"]).drop("source"), "sized")
    cut = _thresholds(rows, sources.where("rest > 0"))
    below = (F.col("hash") < F.col("cut")) | ((F.col("hash") == F.col("cut")) & F.col("cut_taken"))
    times = F.col("whole") + F.when(below, 1).otherwise(0)  # no threshold, none below it
    return rows.join(cut, "source_no", "left").select(
        F.col("doc_id").alias(id_col), "size", "source_size", "target", (F.col("size") * times).cast("long").alias("taken")
    )


def mixed(docs: DataFrame, id_col: str = "doc_id", **settings) -> DataFrame:
    """``docs``, all columns, each row as often as the mix takes it. Documents without words, which no
    mix of words needs, stay once; so do rows without an id."""
    found = mix(docs, id_col=id_col, **settings).where(F.col(quoted(id_col)).isNotNull())
    held, times = unused(docs, "id"), unused(docs, "times")
    found = found.groupBy(F.col(quoted(id_col)).alias(held)).agg(
        F.max(F.when(F.col("size") > 0, F.col("taken") / F.col("size")).otherwise(1)).cast("int").alias(times)
    )
    repeated = docs.join(found, F.col(quoted(id_col)) == F.col(held), "left").withColumn(
        times, F.coalesce(F.col(times), F.lit(1))
    )
    copies = F.when(F.col(times) > 0, F.sequence(F.lit(1), F.col(times)))
    return repeated.withColumn(times, F.explode(copies)).select(*[F.col(quoted(c)) for c in docs.columns])


def mix_hash(key: Column) -> Column:
    """The first 60 bits of the MD5 of a string."""
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, HASH_BITS // 4), 16, 10).cast("long")


def numbered(df: DataFrame, *order: Column) -> DataFrame:
    """``df`` with ``number``, its place from 0 on in the given order of distinct rows: ranges are
    numbered in parallel, and only their sizes are added up in one place."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = settle(df.repartitionByRange(parts, *order).withColumn("_part", F.spark_partition_id()), "ranges")
    sizes = ranged.groupBy("_part").count()
    before = F.coalesce(F.sum("count").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sizes = sizes.select("_part", before.alias("_before"))
    place = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    return ranged.join(sizes, "_part").withColumn("number", place - 1 + F.col("_before")).drop("_part", "_before")


def _targets(rows: DataFrame, weights: tuple[int, ...], most: int) -> DataFrame:
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    sizes = numbered(sizes, F.col("source").asc_nulls_last()).withColumnRenamed("number", "source_no")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.pmod("source_no", F.lit(len(weights))) + 1).cast("int"))
    sizes = settle(sizes.withColumn("weight", weight.cast("long")), "weights")
    # The level every weight is filled to; sources that a level fills beyond their cap leave it.
    level, capped = 0.0, -1
    while True:
        full = F.col("source_size") * most <= F.col("weight") * F.lit(level)
        total, taken, left, n = sizes.agg(
            F.sum("source_size"),
            F.sum(F.when(full, F.col("source_size") * most).otherwise(0)),
            F.sum(F.when(full, 0).otherwise(F.col("weight"))),
            F.count_if(full),
        ).first()
        if n == capped or not left:
            break
        level, capped = (total - taken) / left, n
    target = F.least(F.col("weight") * F.lit(level), (F.col("source_size") * most).cast("double"))
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    return (
        sizes.withColumn("target", target)
        .withColumn("whole", whole)
        .withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size"))
    )


def _thresholds(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """source_no, cut, cut_taken: documents whose hash is below ``cut`` fit in the source's rest, and
    the one at ``cut`` is taken if that comes nearer to it."""
    found = sources.select("source_no", F.col("rest").alias("left"), F.lit(0).cast(T.LongType()).alias("cut"))
    for level in range(LEVELS):
        shift = HASH_BITS - LEVEL_BITS * (level + 1)
        bucket = F.shiftright("hash", shift)
        inside = rows.withColumn("bucket", bucket).select("source_no", "bucket", "size")
        if level:
            inside = inside.withColumn("above", F.shiftright("bucket", LEVEL_BITS)).join(
                found.select("source_no", F.col("cut").alias("above")), ["source_no", "above"]
            )
        sums = inside.groupBy("source_no", "bucket").agg(F.sum("size").alias("size")).where("size > 0")
        upto = F.sum("size").over(Window.partitionBy("source_no").orderBy("bucket"))
        # The first bucket that the rest ends in, with what is left for it.
        ends = sums.withColumn("upto", upto).join(found.select("source_no", "left"), "source_no").where("upto > left")
        first = ends.groupBy("source_no").agg(F.min(F.struct("bucket", "upto", "size", "left")).alias("b"))
        found = settle(
            first.select(
                "source_no",
                (F.col("b.left") - (F.col("b.upto") - F.col("b.size"))).alias("left"),
                F.col("b.bucket").alias("cut"),
                F.col("b.size").alias("at_cut"),
            ),
            "cuts",
        )
    return found.select("source_no", "cut", (F.col("at_cut") <= 2 * F.col("left")).alias("cut_taken"))


#: The same in DuckDB's SQL over ``documents``: thresholds as running sums in the order of the hash.
SQL = """
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size,
         ('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), text, '')), 1, 15))::BIGINT AS h
  FROM documents),
sources AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighted AS (
  SELECT *, [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INTEGER]::BIGINT AS weight FROM sources),
capped AS (
  SELECT *, sum(3 * source_size) OVER w - 3 * source_size AS size_before, sum(weight) OVER w - weight AS weight_before,
         row_number() OVER w AS place, sum(source_size) OVER () AS total, sum(weight) OVER () AS weights
  FROM weighted
  WINDOW w AS (ORDER BY 3.0 * source_size / weight, source NULLS LAST ROWS UNBOUNDED PRECEDING)),
levels AS (
  SELECT arg_min(level, place) AS level FROM (
    SELECT *, CAST(total - size_before AS DOUBLE) / CAST(weights - weight_before AS DOUBLE) AS level FROM capped)
  WHERE level * weight <= 3 * source_size),
targets AS (
  SELECT source, source_size, least(weight * level, CAST(3 * source_size AS DOUBLE)) AS target FROM weighted, levels),
split AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS whole FROM targets),
summed AS (
  SELECT s.*, p.source_size, p.target, p.whole, p.target - p.whole * p.source_size AS rest,
         sum(s.size) OVER (PARTITION BY s.source ORDER BY s.h RANGE UNBOUNDED PRECEDING) AS upto,
         sum(s.size) OVER (PARTITION BY s.source, s.h) AS here
  FROM sized s JOIN split p ON s.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
       CAST(size * (whole + CASE WHEN rest > 0 AND 2 * upto - here <= 2 * rest THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM summed
"""
