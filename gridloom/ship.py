"""Sends the package to the executors, so that their Python workers need no install."""

from __future__ import annotations

import shutil
import tempfile
from collections.abc import Callable
from functools import wraps
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Adds the package as a zip, once for each application; executors fetch it from the driver."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parent
    if root.parent.suffix != ".zip":
        with tempfile.TemporaryDirectory(prefix="gridloom-ship-") as staging:
            shutil.copytree(root, f"{staging}/source/{root.name}", ignore=shutil.ignore_patterns("__pycache__"))
            kept = tempfile.mkdtemp(prefix="gridloom-ship-")
            context.addPyFile(shutil.make_archive(f"{kept}/{root.name}", "zip", f"{staging}/source"))
    _shipped.add(context.applicationId)


def shipped(query: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """A query that ships the package before it runs; its first argument is the session."""
    @wraps(query)
    def run(spark: SparkSession, *args) -> DataFrame:
        ship(spark)
        return query(spark, *args)

    return run
