"""Stripe-wise compositing that resumes: finished stripes are partitions, and a signature guards them.

The signature is what a stripe's values depend on (scenes, bands, stripe height, the whole
grid, clear codes). Where it differs from the stored one, or none is stored, all stripes are made anew;
otherwise only the missing ones are, and each overwrites its own partition.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Sequence
from dataclasses import asdict
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.grid import Grid
from gridloom.operators import composite
from gridloom.sources.layers import exists

STRIPE = 512


def signature(scenes: Sequence[str], grid: Grid, stripe: int, clear: Sequence[int], bands: Sequence[str] = ()) -> str:
    return hashlib.sha256(json.dumps([sorted(scenes), list(bands), stripe, asdict(grid), sorted(clear)]).encode()).hexdigest()


def row_ranges(stripes: Sequence[int], height: int) -> Column:
    """A predicate on row that reaches the scan: a range for each run of neighbouring stripes."""
    runs: list[list[int]] = []
    for s in sorted(stripes):
        if runs and runs[-1][1] == s - 1:
            runs[-1][1] = s
        else:
            runs.append([s, s])
    return reduce(lambda a, b: a | b, [F.col("row").between(a * height, (b + 1) * height - 1) for a, b in runs])


def finished(spark: SparkSession, path: str, sign: str) -> set[int]:
    """Stripes that are done under this signature."""
    if not exists(spark, f"{path}/signature") or not exists(spark, f"{path}/pixels"):
        return set()
    if spark.read.text(f"{path}/signature").first()["value"] != sign:
        return set()
    return {r["stripe"] for r in spark.read.parquet(f"{path}/pixels").select("stripe").distinct().collect()}


def run(looks: DataFrame, grid: Grid, bands: Sequence[str], path: str, stripe: int = STRIPE, clear: Sequence[int] = composite.CLEAR, stripes: int | None = None, at_once: int = 64, scenes: int | None = None) -> list[int]:
    """Makes the stripes that are missing, at_once in a job, and returns their numbers. looks: scene, row, col, scl and bands.

    ``stripes`` and ``scenes`` limit a trial run to the first of both.

    A job's stripes appear when it commits, so what an interrupted run has finished stays finished.
    """
    spark = looks.sparkSession
    known = sorted(r["scene"] for r in looks.select("scene").distinct().collect())
    if scenes is not None:
        known = known[:scenes]
        looks = looks.filter(F.col("scene").isin(known))
    sign = signature([str(x) for x in known], grid, stripe, clear, bands)
    done = finished(spark, path, sign)
    todo = [s for s in range(len(grid.stripes(stripe)))[:stripes] if s not in done]
    number = F.expr(f"CAST(row DIV {stripe} AS INT)")
    mode = "dynamic" if done else "static"  # the first job of a new signature clears what another left
    for start in range(0, len(todo), at_once):
        part = todo[start : start + at_once]
        rows = looks.filter(row_ranges(part, stripe))
        made = composite.on_grid(composite.median_composite(rows, bands, clear), grid, bands).withColumn("stripe", number).filter(F.col("stripe").isin(part))
        if mode == "static":
            spark.createDataFrame([("",)], "value string").write.mode("overwrite").text(f"{path}/signature")
        made.repartition("stripe").sortWithinPartitions("row", "col").write.mode("overwrite").option("partitionOverwriteMode", mode).partitionBy("stripe").parquet(f"{path}/pixels")
        if mode == "static":
            spark.createDataFrame([(sign,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/signature")
        mode = "dynamic"
    return todo
