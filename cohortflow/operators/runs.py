"""Tables of training runs: parameters and metrics as maps, one row per run."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortflow import defaults
from cohortflow.sources.tables import append_batch

RUNS = """run_id string, run_name string, start_time timestamp, status string,
params map<string, string>, metrics map<string, double>, tags map<string, string>"""


def flattened(column: str, schema: T.StructType, prefix: str = "") -> dict[str, Column]:
    """Leaves of a struct column by prefixed key, values as text."""
    leaves = {}
    for field in schema.fields:
        path, key = f"{column}.{field.name}", f"{prefix}{field.name}"
        if isinstance(field.dataType, T.StructType):
            leaves.update(flattened(path, field.dataType, f"{key}_"))
        else:
            leaves[key] = F.col(path).cast("string")
    return leaves


def flatten_params(
    df: DataFrame, column: str, ids: Sequence[str], prefix: str = ""
) -> DataFrame:
    """(*ids, key, value): one row per leaf of a nested configuration."""
    leaves = flattened(column, df.schema[column].dataType, prefix)
    rows = [F.struct(F.lit(k).alias("key"), v.alias("value")) for k, v in leaves.items()]
    return df.select(*ids, F.inline(F.array(*rows)))


def params_map(df: DataFrame, column: str, prefix: str = "") -> Column:
    leaves = flattened(column, df.schema[column].dataType, prefix)
    return F.create_map(*[part for k, v in leaves.items() for part in (F.lit(k), v)])


def finite_metrics(metrics: Column) -> Column:
    """The map without NULL, NaN and infinite entries."""
    return F.map_filter(
        metrics, lambda _, v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))
    )


def prefixed(metrics: Column, prefix: Column) -> Column:
    """Keys ``<prefix>_<key>``, as threshold metrics are named."""
    return F.transform_keys(metrics, lambda k, _: F.concat(prefix, F.lit("_"), k))


def log_runs(runs: DataFrame, path: str, batch: str) -> None:
    """Adds runs to the runs table under a batch's name; unusable metrics are dropped. Logging a batch
    again replaces it."""
    append_batch(runs.withColumn("metrics", finite_metrics(F.col("metrics"))), path, batch)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RUNS).parquet(path)


def metric_rows(runs: DataFrame) -> DataFrame:
    return runs.select("run_id", F.explode("metrics").alias("key", "value"))


def best_run(runs: DataFrame, metric: str, ascending: bool = False) -> DataFrame:
    """The run with the best value of a metric; runs without it come last."""
    value = F.col("metrics")[metric]
    order = value.asc_nulls_last() if ascending else value.desc_nulls_last()
    return runs.orderBy(order, "run_id").limit(1)


def _chosen(runs: DataFrame, run_ids: Sequence[str] | DataFrame | None) -> DataFrame:
    if run_ids is None:
        return runs
    if isinstance(run_ids, DataFrame):
        return runs.join(run_ids.select("run_id"), "run_id", "left_semi")
    return runs.where(F.col("run_id").isin(list(run_ids)))


def compare_runs(
    runs: DataFrame,
    run_ids: Sequence[str] | DataFrame,
    metrics: Sequence[str] = defaults.RUN_METRICS,
    params: Sequence[str] = defaults.KEY_PARAMETERS,
) -> DataFrame:
    """The given runs side by side, a column per named metric and parameter.

    Runs are named in a list, or by the ``run_id`` column of a frame. Columns come from map look-ups,
    so nothing is shuffled; ``run_entries`` has whatever else the runs hold, as rows.
    """
    return _chosen(runs, run_ids).select(
        "run_id",
        F.coalesce("run_name", F.lit("Unknown")).alias("run_name"),
        "start_time",
        "status",
        *[F.col("metrics")[m].alias(f"metric_{m}") for m in metrics],
        *[F.col("params")[p].alias(f"param_{p}") for p in params],
    )


def run_entries(runs: DataFrame, run_ids: Sequence[str] | DataFrame | None = None) -> DataFrame:
    """(run_id, kind, key, text, number): a row for every metric and parameter of the given runs, or
    of all, whatever their names."""
    chosen = _chosen(runs, run_ids)
    no_text, no_number = F.lit(None).cast("string"), F.lit(None).cast("double")
    metrics = chosen.select("run_id", F.explode("metrics").alias("key", "number")).select(
        "run_id", F.lit("metric").alias("kind"), "key", no_text.alias("text"), "number"
    )
    params = chosen.select("run_id", F.explode("params").alias("key", "text")).select(
        "run_id", F.lit("param").alias("kind"), "key", "text", no_number.alias("number")
    )
    return metrics.unionByName(params)


def compare_experiment(
    runs: DataFrame,
    metrics: Sequence[str] = defaults.RUN_METRICS,
    params: Sequence[str] = defaults.KEY_PARAMETERS,
    key_parameters: Sequence[str] = defaults.KEY_PARAMETERS,
) -> DataFrame:
    """All runs, newest first, with the named metrics and those of the named parameters whose name
    holds a key parameter's."""
    kept = [p for p in params if any(key in p for key in key_parameters)]
    return runs.select(
        "run_id",
        "start_time",
        "status",
        *[F.col("metrics")[m].alias(m) for m in metrics],
        *[F.col("params")[p].alias(f"param_{p}") for p in kept],
    ).orderBy(F.desc("start_time"), "run_id")


def model_versions(versions: DataFrame, name: str) -> DataFrame:
    """(version, stage, creation_timestamp, run_id, status) of a registered model."""
    return versions.where(F.col("name") == name).select(
        "version",
        F.col("current_stage").alias("stage"),
        F.timestamp_millis("creation_timestamp").alias("creation_timestamp"),
        "run_id",
        "status",
    )
