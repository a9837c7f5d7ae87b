"""Registry of queries and the helpers that make both sides comparable."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortflow.session import pin_time_zone, ship_package

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Registers a query; results leave it with plain column types."""

    def register(build: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return plain(build(pin_time_zone(ship_package(spark)), sf_dir))

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def plain(df: DataFrame) -> DataFrame:
    """Doubles to 6 places, flags as 0/1, dates and timestamps as text."""
    columns = []
    for field in df.schema:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            column = F.round(column, 6) + F.lit(0.0)
        elif isinstance(field.dataType, T.BooleanType):
            column = column.cast("int")
        elif isinstance(field.dataType, T.DateType):
            column = F.date_format(column, "yyyy-MM-dd")
        elif isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss")
        columns.append(column.alias(field.name))
    return df.select(*columns)


def r6(expression: str) -> str:
    """SQL counterpart of the rounding in ``plain``."""
    return f"(round(CAST({expression} AS DOUBLE), 6) + 0.0::DOUBLE)"


def ts(expression: str) -> str:
    return f"strftime({expression}, '%Y-%m-%d %H:%M:%S')"


def flag(expression: str) -> str:
    return f"CAST(coalesce({expression}, false) AS INTEGER)"


def with_ctes(ctes: dict[str, str], names: list[str], body: str) -> str:
    listed = ",\n".join(f"{name} AS ({ctes[name]})" for name in names)
    return f"WITH {listed}\n{body}"
