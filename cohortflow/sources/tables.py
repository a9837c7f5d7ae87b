"""CSV and Parquet tables."""

from __future__ import annotations

from collections.abc import Sequence
from hashlib import md5

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortflow import schemas
from cohortflow.functions.scalars import nan_as_missing


def read_csv(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """Typed scan: codes stay text, dates are dates, an empty field and NaN are NULL.

    Header names are checked against the schema, a malformed line fails the job.
    """
    return nan_as_missing(
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "FAILFAST")
        .csv(path)
    )


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return nan_as_missing(spark.read.parquet(path))


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def append_batch(df: DataFrame, path: str, batch: str) -> None:
    """Adds rows to a history under the name of their batch. A batch that is written again, as by a job that
    ran twice, takes the place of its earlier rows and leaves all others alone."""
    (
        df.withColumn("batch", F.lit(batch))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("batch")
        .parquet(path)
    )


def read_source(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """One of the five source tables, from ``<folder>/<table>.csv``."""
    return read_csv(spark, f"{folder.rstrip('/')}/{table}.csv", schemas.SOURCES[table])


def land_events(df: DataFrame, path: str, time: str) -> None:
    """An event table laid out by month, so that a window reads only its months."""
    month = F.date_format(time, "yyyy-MM")
    df.withColumn("month", month).write.mode("overwrite").partitionBy("month").parquet(path)


def read_events(
    spark: SparkSession, path: str, time: str, low: Column | None = None, high: Column | None = None
) -> DataFrame:
    """A table written by ``land_events``; bounds prune whole months as well as rows."""
    df = spark.read.option("recursiveFileLookup", False).parquet(path)
    month = F.col("month").cast("string")
    if low is not None:
        df = df.where((F.col(time) >= low) & (month >= F.date_format(low, "yyyy-MM")))
    if high is not None:
        df = df.where((F.col(time) <= high) & (month <= F.date_format(high, "yyyy-MM")))
    return df.drop("month")


def land_bucketed(df: DataFrame, path: str, entity: str, time: str, buckets: int) -> None:
    """An event table dealt out once and for all: files by month of ``time``, in each ``buckets`` files by a
    hash of the entity, sorted by it. Later stages that group or join by the entity need no shuffle of events, and
    a window reads only its months."""
    name = _landed_name(path)
    df.sparkSession.sql(f"DROP TABLE IF EXISTS {name}")
    (
        df.withColumn("month", F.date_format(time, "yyyy-MM"))
        .repartition(buckets, entity)  # one task a bucket, so a month has at most so many files
        .write.mode("overwrite")
        .format("parquet")
        .option("path", path)
        .partitionBy("month")
        .bucketBy(buckets, entity)
        .sortBy(entity)
        .saveAsTable(name)
    )


def read_bucketed(
    spark: SparkSession, path: str, schema: str | T.StructType, entity: str, buckets: int,
    time: str | None = None, low: Column | None = None, high: Column | None = None,
) -> DataFrame:
    """A table written by ``land_bucketed`` with its buckets, also in a session that did not write it; bounds on
    ``time`` prune whole months as well as rows. Rows without a time are read if there are no bounds."""
    name = _landed_name(path)
    fields = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    if not spark.catalog.tableExists(name):
        spark.sql(
            f"CREATE TABLE {name} ({columns}, month string) USING parquet PARTITIONED BY (month) "
            f"CLUSTERED BY (`{entity}`) SORTED BY (`{entity}`) INTO {int(buckets)} BUCKETS LOCATION '{path}'"
        )
        spark.catalog.recoverPartitions(name)
    df = nan_as_missing(spark.table(name))
    if low is not None:
        df = df.where((F.col(time) >= low) & (F.col("month") >= F.date_format(low, "yyyy-MM")))
    if high is not None:
        df = df.where((F.col(time) <= high) & (F.col("month") <= F.date_format(high, "yyyy-MM")))
    return df.drop("month")


def _landed_name(path: str) -> str:
    return "landed_" + md5(path.rstrip("/").encode()).hexdigest()


def table_profile(df: DataFrame) -> DataFrame:
    """(column_name, n_rows, n_columns, n_null): one aggregate over one scan."""
    counts = nan_as_missing(df).agg(
        F.count("*").alias("_rows"), *[F.count(F.col(f"`{c}`")).alias(c) for c in df.columns]
    )
    rows = [
        F.struct(
            F.lit(name).alias("column_name"),
            F.col("_rows").alias("n_rows"),
            F.lit(len(df.columns)).alias("n_columns"),
            (F.col("_rows") - F.col(f"`{name}`")).alias("n_null"),
        )
        for name in df.columns
    ]
    return counts.select(F.inline(F.array(*rows)))
