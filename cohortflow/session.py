"""Session settings the operators are written for."""

from __future__ import annotations

import os
import shutil
import tempfile

from pyspark.sql import SparkSession

_archives: dict[str, str] = {}

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(
    app_name: str = "cohortflow",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    **extra: str,
) -> SparkSession:
    """A session with the settings above.

    On a cluster leave ``master`` to spark-submit and give ``shuffle_partitions``
    generously (about 200 MB of shuffle data each): adaptive execution merges
    the small ones, it cannot split an ordinary large one.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ship_package(spark: SparkSession) -> SparkSession:
    """Lets executors import this package where their Python path does not hold it already, as it does
    after spark-submit with ``--py-files``."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    if root in os.environ.get("PYTHONPATH", "").split(os.pathsep):
        return spark
    archive = _archives.get(root)
    if archive is None:
        base = os.path.join(tempfile.mkdtemp(), "cohortflow")
        archive = _archives[root] = shutil.make_archive(base, "zip", root, "cohortflow")
    spark.sparkContext.addPyFile(archive)  # nothing happens if it was added before
    return spark


def pin_time_zone(spark: SparkSession) -> SparkSession:
    """Day boundaries are UTC midnights, whatever the caller's session had."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark
