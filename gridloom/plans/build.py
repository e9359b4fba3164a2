"""Layer builders: from tiles, extracts and composites to the five factor layers, and to training statistics."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.grid import Grid
from gridloom.operators import distance, landcover, resample, scenes, splits, stats, terrain
from gridloom.sources import layers
from gridloom.sources.layers import exists

COVERAGE = {"dist_road": (0.90, True), "dist_water": (0.50, False)}  # Fixed values: the share of cells with a feature, and whether less is fatal.
CELLS = 4  # Fixed value: cells along a side.


def written(spark: SparkSession, root: str, region: str, name: str) -> DataFrame:
    """A stored layer to two places: what its summary counts, so that it has few different values and nothing is computed twice."""
    return layers.scan(spark, root, region, name).select(F.round(name, 2).alias(name))


def build_terrain(mosaic: DataFrame, source: Grid, grid: Grid, root: str, region: str) -> DataFrame:
    """Elevation by cubic resampling, slope at 30 m with a margin brought back by lines; returns the slope's summary."""
    dem = resample.resample(mosaic, "elevation", source, grid, "cubic")
    full = grid.pixels(mosaic.sparkSession).join(dem, ["row", "col"], "left")
    coarse = grid.coarsened(3, 4)
    down = coarse.pixels(mosaic.sparkSession).join(resample.resample(mosaic, "elevation", source, coarse, "bilinear"), ["row", "col"], "left")
    back = resample.resample(terrain.horn_slope(down, "elevation", coarse), "slope", coarse, grid, "bilinear")
    slope = grid.pixels(mosaic.sparkSession).join(back, ["row", "col"], "left")
    layers.write(full, root, region, "elevation", grid)
    layers.write(slope, root, region, "slope", grid)
    return terrain.summary(written(slope.sparkSession, root, region, "slope"), "slope", above=(5.0, 10.0, 15.0))


def build_landcover(mosaic: DataFrame, source: Grid, grid: Grid, root: str, region: str) -> DataFrame:
    """Merged classes by nearest resampling; returns the histogram. Nodata is stored as null."""
    near = resample.resample(mosaic, "code", source, grid, "nearest").select("row", "col", F.nullif(landcover.merged(F.col("code")), F.lit(0)).alias("landcover"))
    full = grid.pixels(mosaic.sparkSession).join(near, ["row", "col"], "left")
    layers.write(full, root, region, "landcover", grid)
    return landcover.histogram(layers.scan(full.sparkSession, root, region, "landcover").select(F.coalesce("landcover", F.lit(0)).alias("landcover")))


def build_distance(features: DataFrame, grid: Grid, root: str, region: str, name: str, areas: DataFrame | None = None) -> DataFrame:
    """Burns lines (id, points) and areas, checks coverage, measures distances; returns their summary."""
    cells = resample.touched_by_segments(resample.segments_of(features, grid), grid)
    if areas is not None:
        cells = cells.union(resample.filled_polygons(resample.segments_of(areas, grid), grid)).distinct()
    burnt = grid.pixels(features.sparkSession).join(cells.withColumn("f", F.lit(True)), ["row", "col"], "left").select("row", "col", F.coalesce("f", F.lit(False)).alias("f"))
    floor, fatal = COVERAGE[name]
    distance.require_coverage(distance.coverage(burnt, "f", grid, CELLS, floor), name, fatal)
    out = distance.nearest(burnt, "f", grid).select("row", "col", F.col("distance").alias(name))
    layers.write(out, root, region, name, grid)
    return terrain.summary(written(out.sparkSession, root, region, name), name, (50, 90, 99), up_to=(500.0, 1000.0, 5000.0))


def roads_and_water() -> tuple[F.Column, F.Column]:
    return scenes.is_road(F.col("tags")), scenes.is_water(F.col("tags"))


def freeze_statistics(composite: DataFrame, split: DataFrame, bands: tuple[str, ...], path: str) -> DataFrame:
    """Writes training and whole-region statistics as JSON and returns the drift between them."""
    both = composite.join(split, ["row", "col"])
    table = stats.band_statistics(both, bands, {"train": F.col("split") == splits.TRAIN, "whole": F.lit(True)})
    table.coalesce(1).write.mode("overwrite").json(path)
    return stats.drift(composite.sparkSession.read.schema(table.schema).json(path))


def frozen_statistics(spark: SparkSession, path: str) -> DataFrame:
    if not exists(spark, path):
        raise FileNotFoundError(f"no frozen stats at {path}")
    return spark.read.json(path)


def split_document(split: DataFrame, grid: Grid, labels: DataFrame, seed: int = splits.SEED, block: int = splits.BLOCK, buffer_px: int = splits.BUFFER_PX, patch: int = splits.PATCH) -> str:
    """Shares, class balance and patch counts as JSON; each is a few rows."""
    return json.dumps({
        "seed": seed, "block_px": block, "buffer_px": buffer_px, "patch_px": patch,
        "shares": {r["split"]: r["pct"] for r in splits.shares(split).collect()},
        "balance": [r.asDict() for r in splits.class_balance(split, labels).collect()],
        "patches": {name: splits.patch_origins(split, grid, value, patch).count() for name, value in (("train", splits.TRAIN), ("val", splits.VAL))},
    }, indent=2)
