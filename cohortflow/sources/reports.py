"""JSON documents: reports written once, looked up later."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def write_report(df: DataFrame, path: str) -> None:
    """A report frame has one row per document."""
    df.write.mode("overwrite").json(path)


def read_report(
    spark: SparkSession, path: str, schema: str | T.StructType, indented: bool = False
) -> DataFrame:
    """``indented`` reads one document spread over the lines of a file."""
    return spark.read.schema(schema).option("multiLine", indented).json(path)


def lookup(document: Column, path: str, default: Column | None = None) -> Column:
    """Value at a JSON path of a text document, or the default."""
    found = F.get_json_object(document, path)
    return found if default is None else F.coalesce(found, default)
