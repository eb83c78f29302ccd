"""What the package needs of a Spark session."""

from __future__ import annotations

import tempfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

ROOT = str(Path(__file__).resolve().parent.parent)
_own_folders: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder of this application in the one that driver and executors share, spark.checkpoint.dir.

    Where that is unset, a local master gets a temporary folder of its own; any other is an error, for executors could
    not read each other's files.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        if context.applicationId not in _own_folders:
            _own_folders[context.applicationId] = f"file://{tempfile.mkdtemp(prefix='turnloom-')}"
        folder = _own_folders[context.applicationId]
    return f"{folder.rstrip('/')}/turnloom/{context.applicationId}"


def importable(spark: SparkSession) -> None:
    """Lets Python workers find this package where it lies at the same place as on the driver.

    On a cluster ship it with --py-files or in the executors' environment; then this changes nothing that matters.
    """
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(":") if p]
    if ROOT not in paths:
        environment["PYTHONPATH"] = ":".join([*paths, ROOT])


def map_arrow(df: DataFrame, run: Callable, schema: str) -> DataFrame:
    """mapInArrow with this package importable in the workers."""
    importable(df.sparkSession)
    return df.mapInArrow(run, schema)
