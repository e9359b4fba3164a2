"""Virtual rasters: deterministic layers over the driver's tables, on one small grid."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.grid import Grid

SIDE = 128
GRID = Grid(32644, 186140.0, 3378690.0, 10.0, SIDE, SIDE)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def looks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Single observations of a pixel: scene, quality code and two bands."""
    return table(spark, sf_dir, "lineitem").select(
        (F.col("l_orderkey") % SIDE).cast("int").alias("row"),
        (F.col("l_partkey") % SIDE).cast("int").alias("col"),
        F.col("l_linenumber").alias("scene"),
        (F.col("l_quantity").cast("int") % 12).alias("scl"),
        F.floor(F.col("l_extendedprice") / 10).cast("int").alias("red"),
        F.floor(F.col("l_extendedprice") / 7).cast("int").alias("nir"),
        F.col("l_quantity").alias("q"),
    )


def pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each pixel with what its looks give; all layers come from this single aggregation."""
    seen = looks(spark, sf_dir).groupBy("row", "col").agg(
        F.avg("q").alias("mean_q"),
        F.bool_or((F.col("q") >= 50) & (F.col("scene") == 1)).alias("is_built"),
        F.bool_or((F.col("scene") == 7) & (F.col("q") >= 48)).alias("is_water"),
        F.bool_or((F.col("scene") == 3) & (F.col("q") >= 49)).alias("is_road"),
    )
    return GRID.pixels(spark).join(seen, ["row", "col"], "left")


def layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """row, col, elevation, landcover, water, road."""
    r, c = F.col("row"), F.col("col")
    elevation = F.lit(500.0) + (1 + 3 * F.expr("row DIV 32")) * F.abs(r % 32 - 16) + (1 + 2 * F.expr("col DIV 48")) * F.abs(c % 48 - 24) + F.coalesce("mean_q", F.lit(0.0)) / 50
    cover = F.when(F.coalesce("is_built", F.lit(False)), 4).otherwise(1 + (F.expr("row DIV 8") * 7 + F.expr("col DIV 8") * 13) % 6)
    return pixels(spark, sf_dir).select("row", "col", elevation.alias("elevation"), cover.cast("int").alias("landcover"), F.coalesce("is_water", F.lit(False)).alias("water"), F.coalesce("is_road", F.lit(False)).alias("road"))
