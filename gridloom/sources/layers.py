"""Layer tables: Parquet by region and stripe of rows, with a grid header beside them.

A window becomes ranges on the stripe partitions and on row and col, so it prunes
directories first and row groups then. Values are null where there is none.
"""

from __future__ import annotations

import json
from dataclasses import asdict
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.grid import Grid, Window

STRIPE = 512
NAMES = ("slope", "landcover", "elevation", "dist_road", "dist_water")
SENTINELS = {"slope": -9999.0, "elevation": -9999.0, "landcover": 0, "dist_road": -1.0, "dist_water": -1.0}


def without_sentinel(value: F.Column, sentinel: float) -> F.Column:
    """Null for the sentinel and for NaN, which equals no sentinel."""
    return F.when(~F.isnan(value.cast("double")) & (value != sentinel), value)


def with_sentinel(value: F.Column, sentinel: float) -> F.Column:
    return F.coalesce(value, F.lit(sentinel))


def path_of(root: str, region: str, name: str) -> str:
    return f"{root}/region={region}/{name}"


def write(layer: DataFrame, root: str, region: str, name: str, grid: Grid) -> None:
    """Writes a layer and its header, then reads it back and checks that it covers the grid."""
    spark = layer.sparkSession
    at = path_of(root, region, name)
    rows = layer.withColumn("stripe", F.expr(f"CAST(row DIV {STRIPE} AS INT)"))
    rows.repartition("stripe").sortWithinPartitions("row", "col").write.mode("overwrite").partitionBy("stripe").parquet(f"{at}/pixels")
    spark.createDataFrame([(json.dumps(asdict(grid)),)], "value string").coalesce(1).write.mode("overwrite").text(f"{at}/header")
    check(spark, root, region, name, grid)


def header(spark: SparkSession, root: str, region: str, name: str) -> Grid:
    return Grid(**json.loads(spark.read.text(f"{path_of(root, region, name)}/header").first()["value"]))


def check(spark: SparkSession, root: str, region: str, name: str, grid: Grid) -> None:
    """The stored header and extent must be the grid's."""
    grid.require(header(spark, root, region, name), name)
    got = spark.read.parquet(f"{path_of(root, region, name)}/pixels").agg(F.count(F.lit(1)), F.min("row"), F.max("row"), F.min("col"), F.max("col")).first()
    if tuple(got) != (grid.width * grid.height, 0, grid.height - 1, 0, grid.width - 1):
        raise ValueError(f"{name}: {got[0]} pixels, rows {got[1]}..{got[2]}, columns {got[3]}..{got[4]}; expected all of {grid.height} x {grid.width}")


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def missing(spark: SparkSession, root: str, region: str, names: tuple[str, ...] = NAMES) -> list[str]:
    return [n for n in names if not exists(spark, f"{path_of(root, region, n)}/header")]


def scan(spark: SparkSession, root: str, region: str, name: str, window: Window | None = None) -> DataFrame:
    rows = spark.read.parquet(f"{path_of(root, region, name)}/pixels")
    if window is None:
        return rows
    stripes = F.col("stripe").between(window.row // STRIPE, (window.row + window.height - 1) // STRIPE)
    return rows.filter(stripes & window.condition())


def load(spark: SparkSession, root: str, region: str, grid: Grid, window: Window | None = None) -> DataFrame:
    """All five layers aligned by row and col, with ``valid``: one aggregation over the five scans' rows, so one shuffle.

    Every stored layer holds each pixel of the grid once (``check``), so no row is missing on any side.
    """
    if gone := missing(spark, root, region):
        raise FileNotFoundError(f"region {region} lacks {', '.join(gone)}")
    scans = {}
    for name in NAMES:
        grid.require(header(spark, root, region, name), name)
        scans[name] = scan(spark, root, region, name, window)
    types = {name: rows.schema[name].dataType for name, rows in scans.items()}
    rows = [own.select("stripe", "row", "col", *[F.col(n) if n == name else F.lit(None).cast(types[n]).alias(n) for n in NAMES]) for name, own in scans.items()]
    stack = reduce(DataFrame.unionByName, rows).groupBy("stripe", "row", "col").agg(*[F.max(n).alias(n) for n in NAMES])
    valid = F.lit(True)
    for name in NAMES:
        valid = valid & F.col(name).isNotNull()
    return stack.withColumn("valid", valid)


def probe(spark: SparkSession, root: str, region: str, name: str, grid: Grid, size: int = 64) -> DataFrame:
    """A window of size x size at the centre, clamped to the grid."""
    row, col = max((grid.height - size) // 2, 0), max((grid.width - size) // 2, 0)
    return scan(spark, root, region, name, Window(col, row, min(size, grid.width), min(size, grid.height)))


def health(spark: SparkSession, checks: dict[str, object]) -> DataFrame:
    """(name, ok, detail) of independent checks, each a function that returns a detail or raises."""
    rows = []
    for name, run in checks.items():
        try:
            rows.append((name, True, str(run())))
        except Exception as e:  # a failed check is a row, not the end of the others
            rows.append((name, False, f"{type(e).__name__}: {e}"))
    return spark.createDataFrame(rows, "name string, ok boolean, detail string")
